"""End-to-end pipelines Q1-Q7 over one set of inputs.

``Inputs`` holds the reference's six inputs as DataFrames, from files
(``load_files``) or from the test fixtures (``from_fixtures``).  Every
pipeline returns DataFrames; writing them is the caller's choice
(``sources.sinks.write_predictions``).
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratesmith.functions.scalars import DEFAULT_AS_OF, UNKNOWN
from ratesmith.operators import blend as BL
from ratesmith.operators import encoders as EN
from ratesmith.operators import evaluate as EV
from ratesmith.operators import features as FT
from ratesmith.operators import boosting as BO
from ratesmith.operators import models as MD
from ratesmith.operators import neighbors as NB
from ratesmith.operators import profile as PR
from ratesmith.operators.dedupe import last_by_ordinal
from ratesmith.session import stored
from ratesmith.sources import readers as RD
from ratesmith.sources import schemas as S


@dataclass
class Inputs:
    user: DataFrame
    business: DataFrame
    review: DataFrame
    photo: DataFrame
    tip: DataFrame
    train_raw: DataFrame   # every training row (duplicates kept)
    train: DataFrame       # last rating per (user, business)
    val: DataFrame         # (user_id, business_id[, stars]) to predict
    order: tuple[str, ...] = ("user_id", "business_id")  # train_raw's line order
    null_place: str | None = UNKNOWN  # what a null city or state counts as; None: nothing


def _with_line_order(df: DataFrame) -> DataFrame:
    """Ordinal of each line in its file: (path, block start, position in block)."""
    return df.select("*", F.col("_metadata.file_path").alias("_file"),
                     F.col("_metadata.file_block_start").alias("_block"),
                     F.monotonically_increasing_id().alias("_pos"))


def load_files(spark: SparkSession, folder: str, val_path: str, absent_place: str | None = None) -> Inputs:
    """The reference's folder layout (JSON lines + CSV with header).

    With ``absent_place`` ('Unknown'), a city or state whose key is absent reads
    as that, and a null one stays NULL and out of the vocabularies; without, both
    read as NULL and count as 'Unknown'.
    """
    p = lambda name: os.path.join(folder, name)
    user = RD.read_json(spark, p("user.json"), S.USER_SCHEMA, required=S.REQUIRED["user"])
    if absent_place is None:
        business = RD.read_json(spark, p("business.json"), S.BUSINESS_SCHEMA, required=S.REQUIRED["business"])
    else:
        business = RD.read_json_keys(spark, p("business.json"), S.BUSINESS_SCHEMA,
                                     dict.fromkeys(("city", "state"), absent_place), S.REQUIRED["business"])
    review = RD.read_json(spark, p("review_train.json"), S.REVIEW_SCHEMA, required=S.REQUIRED["review"])
    photo = RD.read_json(spark, p("photo.json"), S.PHOTO_SCHEMA)
    tip = RD.read_json(spark, p("tip.json"), S.TIP_SCHEMA)
    raw = _with_line_order(RD.read_ratings(spark, p("yelp_train.csv")))
    train = last_by_ordinal(raw, ["user_id", "business_id"], ["stars"], ["_file", "_block", "_pos"])
    val = RD.read_ratings(spark, val_path)
    return Inputs(user, business, review, photo, tip, raw, train, val, ("_file", "_block", "_pos"),
                  UNKNOWN if absent_place is None else None)


def from_fixtures(spark: SparkSession, sf_dir: str, item: str = "dense") -> Inputs:
    from ratesmith.sources.fixtures import ORDINAL, dataset
    d = dataset(spark, sf_dir, item)
    return Inputs(d.user, d.business, d.review, d.photo, d.tip, d.train_raw, d.train, d.val_pairs, ORDINAL)


def write_inputs(inp: Inputs, folder: str) -> str:
    """Write inputs in the layout that ``load_files`` reads (JSON lines, CSV
    with header, ids as text); returns the validation file's path.  Training
    rows go out in line order, one range of it a file."""
    def text(df: DataFrame, *ids: str) -> DataFrame:
        return df.withColumns({c: F.col(c).cast("string") for c in ids})

    at = lambda name: os.path.join(folder, name)
    text(inp.user, "user_id").write.json(at("user.json"))
    text(inp.business, "business_id").write.json(at("business.json"))
    text(inp.review, "business_id").write.json(at("review_train.json"))
    text(inp.photo, "business_id").write.json(at("photo.json"))
    text(inp.tip, "business_id").write.json(at("tip.json"))
    columns = ("user_id", "business_id", "stars")
    (text(inp.train_raw, *columns[:2]).orderBy(*inp.order, "stars").select(*columns)
     .write.option("header", True).csv(at("yelp_train.csv")))
    (text(inp.val, *columns[:2]).select(*columns).write.option("header", True).csv(at("yelp_val.csv")))
    return at("yelp_val.csv")


def _side(inp: Inputs, feature_set: str) -> DataFrame:
    return FT.business_side(inp.business, inp.review, inp.photo, inp.tip, feature_set, null_as=inp.null_place)


def features(inp: Inputs, pairs: DataFrame, feature_set: str, label: bool,
             as_of: str = DEFAULT_AS_OF, side: DataFrame | None = None, carry: tuple[str, ...] = ()
             ) -> DataFrame:
    if side is None:
        side = _side(inp, feature_set)
    return FT.feature_table(pairs, inp.user, inp.business, inp.review, inp.photo, inp.tip,
                            feature_set=feature_set, as_of=as_of, label="stars" if label else None,
                            side=side, carry=carry)


def _train_val_features(inp: Inputs, feature_set: str, as_of: str, carry: tuple[str, ...] = ()
                        ) -> tuple[DataFrame, DataFrame]:
    """Train and validation feature tables over one shared business-side table."""
    side = _side(inp, feature_set)
    return (features(inp, inp.train_raw, feature_set, True, as_of, side, carry),
            features(inp, inp.val, feature_set, False, as_of, side))


def model_based(inp: Inputs, feature_set: str = "fs7", scale: bool = False,
                preset: str | None = None, as_of: str = DEFAULT_AS_OF, **params) -> DataFrame:
    """Q1 (fs7, unscaled) and Q2 (fs23 / fs23l, min-max scaled): fit on train, predict val.

    ``preset`` defaults to the reference's size for the feature set.  The
    training table is kept for the scaling pass and the fit.
    """
    cols = FT.FEATURE_SETS[feature_set]
    tr, va = _train_val_features(inp, feature_set, as_of)
    tr = tr.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fitted = tr
        if scale:
            # one row, computed before the table is released
            row = EN.minmax_stats(tr, cols).first()
            stats = tr.sparkSession.range(1).select(
                *[F.lit(v).cast("double").alias(n) for n, v in row.asDict().items()])
            fitted, va = EN.minmax_scale(tr, cols, stats), EN.minmax_scale(va, cols, stats)
        model = MD.fit(fitted, cols, "stars", preset or MD.PRESET_OF[feature_set], kept=True, **params)
    finally:
        tr.unpersist()
    return MD.predict(model, va)


def item_based(inp: Inputs, k: int = NB.DEFAULT_K) -> DataFrame:
    """Q3."""
    return NB.predict(inp.val, inp.train, inp.train_raw, k)


def hybrid(inp: Inputs, preset: str | None = None) -> DataFrame:
    """Q4: item-based blended with the FS7 model by per-business alpha."""
    item = item_based(inp)
    model = model_based(inp, "fs7", preset=preset)
    return BL.blend(item, model, inp.review).select("user_id", "business_id", "prediction")


def tuned_model(inp: Inputs, grid: dict[str, list] = MD.FULL_GRID, feature_set: str = "fs20l",
                k: int = 5, as_of: str = DEFAULT_AS_OF) -> tuple[DataFrame, MD.GridResult]:
    """Q5: min-max scaled features, k-fold grid search in line order, best model predicts val."""
    cols = FT.FEATURE_SETS[feature_set]
    tr, va = _train_val_features(inp, feature_set, as_of, inp.order)
    tr = stored(tr, "training")  # read for the scale, the order's sample and the folds
    stats = EN.minmax_stats(tr, cols)
    tr, va = EN.minmax_scale(tr, cols, stats), EN.minmax_scale(va, cols, stats)
    res = MD.grid_search(tr, cols, grid, k=k, order_by=[*inp.order, "user_id", "business_id", "stars"])
    return MD.predict(res.model, va), res


def _scaled_features(inp: Inputs, feature_set: str, as_of: str, carry: tuple[str, ...] = ()
                     ) -> tuple[DataFrame, DataFrame]:
    """Min-max scaled train and validation features (M1, fitted on train)."""
    cols = FT.FEATURE_SETS[feature_set]
    tr, va = _train_val_features(inp, feature_set, as_of, carry)
    stats = EN.minmax_stats(tr, cols)
    return EN.minmax_scale(tr, cols, stats), EN.minmax_scale(va, cols, stats)


def penalised_model(inp: Inputs, feature_set: str = "fs23", params: BO.Params = BO.PENALISED["final"],
                    as_of: str = DEFAULT_AS_OF) -> DataFrame:
    """Q2 with the reference's leaf penalties: fit on scaled train rows, predict val."""
    tr, va = _scaled_features(inp, feature_set, as_of)
    return BO.predict(BO.fit(tr, FT.FEATURE_SETS[feature_set], params), va)


def penalised_search(inp: Inputs, grid: dict[str, list] = BO.FULL_GRID, feature_set: str = "fs20l",
                     k: int = 5, as_of: str = DEFAULT_AS_OF) -> tuple[DataFrame, BO.SearchResult]:
    """Q5 with the reference's whole grid, penalties and all: every candidate
    scored on k folds in line order, the best one predicts val."""
    tr, va = _scaled_features(inp, feature_set, as_of, inp.order)
    folded = MD.contiguous_folds(tr, [*inp.order, "user_id", "business_id", "stars"], k)
    found = BO.staged_search(folded, FT.FEATURE_SETS[feature_set], grid, "fold", k)
    return BO.predict(found.model, va), found


def onehot_model(inp: Inputs, params: BO.Params = BO.PENALISED["notebook"],
                 as_of: str = DEFAULT_AS_OF) -> DataFrame:
    """The notebook's model on its whole feature set (FS-EDA with one-hot
    categories): fit on train, predict val."""
    tr, va, _ = PR.eda_sparse(inp.train_raw, inp.val, inp.business, inp.user, as_of)
    return BO.predict(BO.fit(tr, PR.EDA_FEATURES, params, labels="labels"), va)


def profile(inp: Inputs, as_of: str = DEFAULT_AS_OF) -> DataFrame:
    """Q6: correlation of the profiling features with the rating."""
    eda = PR.eda_features(inp.train_raw, inp.business, inp.user, as_of)
    return PR.label_correlations(eda, PR.EDA_FEATURES, "stars")


def evaluate(pred: DataFrame, truth: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Q7: error histogram and RMSE."""
    return EV.error_distribution(pred, truth), EV.rmse(pred, truth)
