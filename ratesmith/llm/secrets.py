"""Secrets: base patterns, and character Markov models for what they miss.

Two first-order Markov models over the characters of keys and identifiers are
trained from labelled samples: one of random strings, one of ordinary words
and identifiers.  A token's score is the logarithm of the likelihood ratio of
its character transitions, and long tokens that look random by it are added to
the base spans.  Samples, counts and scores are column expressions; the driver
holds the transition counts only (a bounded alphabet, squared).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratesmith.llm.spans import let, locate, overlaps_any

BASE = ("assign", "access", "hex")
EXTRA = "random"
KINDS = (*BASE, EXTRA)
#: Bounds of the training sample: documents of the smallest id hashes whose
#: words are samples of ordinary text, and secrets of the smallest hashes.
WORD_DOCS, MAX_SECRETS = 2_000, 20_000
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=.-"
#: Transitions added to every count: many for random strings, as any may
#: follow any, few for words.
RANDOM_PRIOR, WORD_PRIOR = 5.0, 0.1
#: A token is random from this log-likelihood ratio on, a transition and whole.
MIN_MEAN, MIN_TOTAL = 1.0, 20.0

_ASSIGN = (r"(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
           r"[A-Za-z0-9+/_.=-]+")
_ASSIGNED = (r"^(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
             r"([A-Za-z0-9+/_.=-]+)$")
_ACCESS = r"AKIA[A-Z0-9]{16,}+"
_HEX = r"[0-9a-f]{24,}+"
_TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+(?![A-Za-z0-9+/_=-])"


def base_spans(text: Column) -> dict[str, Column]:
    """Valid spans of the base kinds.  A hex or access match below its least
    length cannot hide a longer one behind it, so the length is in the
    pattern; an assignment's value is measured after the match."""
    return {
        "assign": F.filter(locate(text, _ASSIGN, text.rlike("[:=]")), lambda s: F.length(
            F.regexp_extract(s["match"], _ASSIGNED, 1)) >= 6),
        "access": locate(text, _ACCESS, F.contains(text, F.lit("AKIA"))),
        "hex": locate(text, _HEX),
    }


def _transitions(token: Column) -> Column:
    """Array of two-character strings of a token of two characters or more."""
    return let(F.split(token, ""), lambda chars: F.zip_with(
        F.slice(chars, F.lit(1), F.size(chars) - 1), F.slice(chars, F.lit(2), F.size(chars) - 1),
        lambda a, b: F.concat(a, b)))


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio per transition (row-major over ALPHABET) from
    labelled samples (token, is_secret); other characters are skipped."""
    size = len(ALPHABET)
    counts = {True: [[RANDOM_PRIOR] * size for _ in range(size)],
              False: [[WORD_PRIOR] * size for _ in range(size)]}
    index = {c: i for i, c in enumerate(ALPHABET)}
    pairs = (samples.filter(F.length("token") >= 2)
             .select("is_secret", F.explode(_transitions(F.col("token"))).alias("pair"))
             .filter(F.col("pair").rlike(r"^[A-Za-z0-9+/_=.-]{2}$"))
             .groupBy("is_secret", "pair").agg(F.count(F.lit(1)).alias("n")))
    for row in pairs.toLocalIterator():  # at most 2 * len(ALPHABET)^2 rows
        counts[row["is_secret"]][index[row["pair"][0]]][index[row["pair"][1]]] += row["n"]
    ratio = []
    for rand, word in zip(counts[True], counts[False], strict=True):
        all_rand, all_word = sum(rand), sum(word)
        ratio += [math.log(r / all_rand) - math.log(w / all_word)
                  for r, w in zip(rand, word, strict=True)]
    return ratio


def randomness(token: Column, ratio: Sequence[float]) -> Column:
    """Log-likelihood ratio of a token over its transitions."""
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in ratio)), ",").cast("array<double>")

    def at(char: Column) -> Column:
        return F.instr(F.lit(ALPHABET), char) - 1

    return F.aggregate(_transitions(token), F.lit(0.0), lambda total, pair: total + F.get(
        table, at(F.substring(pair, 1, 1)) * len(ALPHABET) + at(F.substring(pair, 2, 1))))


def labelled_samples(docs: DataFrame, word_docs: int = WORD_DOCS,
                     max_secrets: int = MAX_SECRETS) -> DataFrame:
    """Samples (token, is_secret) from documents (doc_id, text, base kinds).

    Secrets are the values of base spans; ordinary tokens are words of a
    bounded number of documents, base spans left out.
    """
    def values(kind: str) -> Column:
        return F.transform(kind, lambda s: F.regexp_extract(s["match"], _ASSIGNED, 1)
                           if kind == "assign" else s["match"])

    by_hash = F.xxhash64("token")
    secrets = (docs.select(F.explode(F.concat(*[values(k) for k in BASE])).alias("token"))
               .distinct().orderBy(by_hash, "token").limit(max_secrets))
    # broadcast: at most word_docs ids
    chosen = F.broadcast(docs.select("doc_id").dropna().distinct()
                         .orderBy(F.xxhash64("doc_id"), "doc_id").limit(word_docs))
    words = (docs.select("doc_id", "text").join(chosen, "doc_id", "left_semi")
             .select(F.explode(F.regexp_extract_all(
                 "text", F.lit(r"(?<![\p{L}\p{N}_])[A-Za-z_-]{3,}(?![\p{L}\p{N}_])"), F.lit(0))
                 ).alias("token")))
    return (secrets.select("token", F.lit(True).alias("is_secret"))
            .union(words.select("token", F.lit(False))))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return doc_id, text and, per kind, an array of (start, end, match).

    Offsets are code points, the end exclusive; an assignment's span is the
    whole match, key word included.  Null texts count as empty; null ids and
    repeated rows are kept; other columns are ignored; an empty table, or one
    without base secrets, adds nothing by the models.
    """
    text = F.col("text")
    base = docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = base.select("*", *[c.alias(k) for k, c in base_spans(text).items()])
    ratio = train(labelled_samples(base))

    def looks_random(s: Column) -> Column:
        def enough(score: Column) -> Column:
            return (score >= MIN_TOTAL) & (score >= MIN_MEAN * (s["end"] - s["start"] - 1))

        mixed = s["match"].rlike("[A-Za-z]") & s["match"].rlike("[0-9]")
        return F.when(mixed & ~overlaps_any(s, [F.col(k) for k in BASE]),
                      let(randomness(s["match"], ratio), enough)).otherwise(False)

    return base.withColumn(EXTRA, F.filter(locate(text, _TOKEN), looks_random))


def ordered_spans(kinds: Sequence[str]) -> Column:
    """"kind:start:end" by start, then kind as listed, joined by commas."""
    def numbered(no: int, kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(
            s["start"].alias("start"), F.lit(no).alias("no"), s["end"].alias("end")))

    names = F.array(*[F.lit(k) for k in kinds])
    spans = F.array_sort(F.concat(*[numbered(no, k) for no, k in enumerate(kinds)]))
    return F.array_join(F.transform(spans, lambda s: F.concat(
        F.get(names, s["no"]), F.lit(":"), s["start"].cast("string"), F.lit(":"),
        s["end"].cast("string"))), ",")


def digest_columns(found: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, the base spans' hash, and all spans."""
    return found.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE],
                        F.sha2(ordered_spans(BASE), 256).alias("base_sha256"),
                        ordered_spans(KINDS).alias("spans"))
