"""Toxicity by non-negative positive-unlabelled learning.

Known: texts confirmed toxic, and unlabelled text that holds toxic documents
at some prior rate.  The classifier minimises the class-prior-corrected risk

    prior * E_p[loss(z)] + max(0, E_u[loss(-z)] - prior * E_p[loss(-z)])

over confirmed (p) and unlabelled (u) documents; while the second term, the
estimated risk on clean text, is negative, its gradient is reversed, so a
flexible model cannot drive it below zero.  Each of a few linear classifiers
is trained in numpy in a Spark task of its own on a bag of the documents, and
a text's score is their mean probability.

Features are words of a text, lower-cased, and word beginnings of 4 to 6
letters, each counted once; those kept are more frequent among confirmed than
among unlabelled documents by a clear margin.  Whole texts are read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bounds of the training set and of the feature list: the documents that are
#: confirmed, and the unlabelled ones, of the smallest id hashes.
MAX_CONFIRMED, MAX_UNLABELLED, MAX_FEATURES = 8_000, 16_000, 8_192
MEMBERS, STEPS, RATE, RIDGE = 5, 400, 0.1, 1e-4
#: A feature is kept from this many confirmed documents on (at least this
#: share of them), if at least this share of the texts that hold it is toxic
#: (one standard deviation in the unlabelled count's disfavour), and at this
#: many standard deviations above the unlabelled rate.
MIN_DOCS, MIN_SHARE, MIN_PURITY, MIN_DEVIATIONS = 4, 0.03, 0.5, 6.0
BEGINNINGS = (4, 5, 6)
#: "^" marks a word's beginning; words hold letters only.
_WORD = regex.compile(r"\p{L}+")


def features(text: str | None) -> set[str]:
    """Distinct lower-case words, and their beginnings marked by "^"."""
    words = set(_WORD.findall((text or "").lower()))
    found = set(words)
    for n in BEGINNINGS:
        found.update({"^" + w[:n] for w in words if len(w) >= n})
    return found


@dataclass
class ToxicityModel:
    """Feature list, per member a weight row and a bias, and the prior."""

    names: list[str]
    weights: np.ndarray
    bias: np.ndarray
    prior: float

    def scorer(self):
        index = {name: i for i, name in enumerate(self.names)}
        words = {n for n in index if not n.startswith("^")}
        starts = [(n, {x[1:] for x in index if x.startswith("^") and len(x) == n + 1})
                  for n in BEGINNINGS]

        def score(text: str | None) -> float:
            held = set(_WORD.findall((text or "").lower()))
            hits = [index[w] for w in held & words]
            for n, known in starts:
                if known:
                    hits += [index["^" + w] for w in {w[:n] for w in held} & known]
            z = self.bias + self.weights[:, sorted(hits)].sum(axis=1)
            return float((1 / (1 + np.exp(-np.clip(z, -30, 30)))).mean())

        return score


def train_member(hits: list[np.ndarray], confirmed: np.ndarray, size: int, prior: float
                 ) -> tuple[np.ndarray, float]:
    """One linear classifier: full-batch Adam on the non-negative risk."""
    lens = np.array([len(h) for h in hits])
    flat = np.concatenate([*hits, np.zeros(0, np.int64)]).astype(np.int64)
    owner = np.repeat(np.arange(len(hits)), lens)
    n_p, n_u = max(1, confirmed.sum()), max(1, (~confirmed).sum())
    w = np.zeros(size + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, STEPS + 1):
        z = np.clip(w[-1] + np.bincount(owner, w[flat], minlength=len(hits)), -30, 30)
        toxic = 1 / (1 + np.exp(-z))  # d/dz loss(-z); d/dz loss(z) is toxic - 1
        clean_risk = (np.logaddexp(0, z[~confirmed]).sum() / n_u
                      - prior * np.logaddexp(0, z[confirmed]).sum() / n_p)
        clean = np.where(confirmed, -prior * toxic / n_p, toxic / n_u)
        if clean_risk >= 0:
            clean = clean + np.where(confirmed, prior * (toxic - 1) / n_p, 0)
        else:
            clean = -clean
        grad = np.append(np.bincount(flat, clean[owner], minlength=size), clean.sum())
        grad[:-1] += RIDGE * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        w -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", max_confirmed: int = MAX_CONFIRMED,
        max_unlabelled: int = MAX_UNLABELLED, members: int = MEMBERS) -> ToxicityModel:
    """Train on the documents confirmed by ``label_col`` = 1 and on all others.

    The prior is the share of 1 among the labelled documents.  The training
    set is bounded by ``max_confirmed`` and ``max_unlabelled``, the documents
    of the smallest id hashes; only their feature counts and a bounded feature
    list reach the driver.  Null ids, texts and labels are skipped; a document
    labelled more than once counts as toxic if any label says so.  Without
    confirmed documents the model has no features and scores the prior.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    known = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("toxic"))
             .dropna().groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    share, total = known.agg(F.avg(F.col("toxic").cast("double")), F.count(F.lit(1))).first()
    prior = min(max(share or 0.0, 1e-3), 0.9)
    if not share:
        return ToxicityModel([], np.zeros((1, 0)), np.full(1, -30.0 if total else np.log(prior)), prior)

    by_hash = F.xxhash64("doc_id")
    confirmed = known.filter("toxic = 1").orderBy(by_hash, "doc_id").limit(max_confirmed)
    # the risk needs unlabelled text as it comes, so it may hold confirmed texts
    others = (source.select("doc_id").dropna().distinct()
              .orderBy(by_hash, "doc_id").limit(max_unlabelled))
    # broadcast: at most max_confirmed + max_unlabelled ids
    chosen = F.broadcast(confirmed.select("doc_id", F.lit(True).alias("confirmed"))
                         .union(others.select("doc_id", F.lit(False))))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["confirmed"],
                 pa.array([sorted(features(t.as_py())) for t in batch["text"]], pa.list_(pa.string()))],
                names=["doc_id", "confirmed", "names"])

    kind = source.schema["doc_id"].dataType.simpleString()
    chosen_texts = source.join(chosen, "doc_id").dropna()
    bags = chosen_texts.mapInArrow(spread, f"doc_id {kind}, confirmed boolean, names array<string>")
    n_p, n_u = chosen_texts.agg(F.count_if("confirmed"), F.count_if(~F.col("confirmed"))).first()
    n_p, n_u = max(1, n_p), max(1, n_u)
    rate_p, rate_u = F.col("p") / n_p, (F.col("u") + 0.5) / n_u
    noise = F.sqrt(rate_u * n_p)
    purity = prior * rate_p / ((F.col("u") + 1 + F.sqrt(F.col("u") + 1)) / n_u)
    kept = (bags.select("confirmed", F.explode("names").alias("name")).groupBy("name")
            .agg(F.count_if("confirmed").alias("p"), F.count_if(~F.col("confirmed")).alias("u"))
            .filter((F.col("p") >= max(MIN_DOCS, MIN_SHARE * n_p)) & (purity >= MIN_PURITY)
                    & (F.col("p") - rate_u * n_p >= MIN_DEVIATIONS * noise))
            .orderBy(F.desc((F.col("p") - rate_u * n_p) / noise), "name").limit(MAX_FEATURES))
    names = sorted(r["name"] for r in kept.select("name").toLocalIterator())
    index = {name: i for i, name in enumerate(names)}

    # from the texts again: on top of the bags it would hold two workers a task
    def to_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [sorted(index[n] for n in features(t.as_py()) if n in index) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["confirmed"], pa.array(hits, pa.list_(pa.int32()))],
                names=["doc_id", "confirmed", "hits"])

    rows = chosen_texts.mapInArrow(to_rows, f"doc_id {kind}, confirmed boolean, hits array<int>")
    # a member leaves out every members-th document; a bag has bounded rows
    dealt = rows.withColumn("member", F.explode(F.sequence(F.lit(0), F.lit(members - 1)))).filter(
        (F.lit(members) == 1) | (F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(members))
                                 != F.col("member")))

    def train(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["confirmed", "doc_id"], kind="stable")
        hits = [np.asarray(h, np.int64) for h in group["hits"]]
        w, b = train_member(hits, group["confirmed"].to_numpy(bool), len(names), prior)
        return pd.DataFrame({"member": [group["member"].iloc[0]], "weights": [w.tolist()], "bias": [b]})

    trained = dealt.groupBy("member").applyInPandas(
        train, "member int, weights array<double>, bias double").orderBy("member").toLocalIterator()
    trained = list(trained)
    if not trained:
        return ToxicityModel([], np.zeros((1, 0)), np.full(1, -30.0), prior)
    return ToxicityModel(names, np.array([r["weights"] for r in trained]).reshape(len(trained), -1),
                         np.array([r["bias"] for r in trained]), prior)


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id",
          text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """Return doc_id, score (0 to 1, higher: likelier toxic) and the columns
    named in ``carry``, one row per input row.  Null and empty texts are scored
    as texts without words; null ids and repeated rows are kept; all other
    columns are ignored."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"),
                         *[F.col(c) for c in carry])
    fields = [f for f in source.schema.fields if f.name != "_text"]
    out = T.StructType([fields[0], T.StructField("score", T.DoubleType()), *fields[1:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rate = model.scorer()
        for batch in batches:
            scores = pa.array([rate(t.as_py()) for t in batch["_text"]], pa.float64())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], scores, *batch.columns[2:]],
                                             names=out.names)

    return source.mapInArrow(run, out)
