"""Structured Streaming drivers for the batch operators (no stream-only operators)."""

from ratesmith.streaming.scoring import item_predictor, score_stream  # noqa: F401
