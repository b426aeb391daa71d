"""Scan and sink queries (S1-S7): fixture data written to files, read back.

Files go under the session's shared checkpoint folder (never a
machine-local temp dir), one fresh folder per call.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ratesmith.functions import scalars as fx
from ratesmith.operators import encoders as EN
from ratesmith.operators import neighbors as NB
from ratesmith.plans.registry import register
from ratesmith.session import scratch_path
from ratesmith.sources import readers as RD
from ratesmith.sources import schemas as S
from ratesmith.sources.fixtures import dataset
from ratesmith.sources.sinks import write_predictions

JSON_FIELDS = ("business_id", "stars", "city", "neighborhood")


def _write_business_json(spark, sf_dir) -> str:
    """business.json with latitude/longitude as JSON numbers where they parse,
    and as text (or absent) where they do not – the mixed input the reader
    must accept."""
    b = dataset(spark, sf_dir).business
    path = scratch_path(spark, "business-json")
    lat, lon = F.col("latitude").try_cast("double"), F.col("longitude").try_cast("double")
    numeric = b.where(lat.isNotNull() & lon.isNotNull()).withColumns({"latitude": lat, "longitude": lon})
    textual = b.where(lat.isNull() | lon.isNull())
    numeric.write.mode("overwrite").json(path + "/numeric")
    textual.write.mode("overwrite").json(path + "/textual")
    return path + "/*"


@register("scan_json", """
    SELECT CAST(business_id AS VARCHAR) AS business_id, stars, review_count, is_open, city, state,
           categories, attributes_count,
           coalesce(TRY_CAST(latitude AS DOUBLE), 0.0) AS latitude,
           coalesce(TRY_CAST(longitude AS DOUBLE), 0.0) AS longitude
    FROM f_business""", doubles=("stars", "latitude", "longitude"))
def q_scan_json(spark, sf_dir):
    """JSON lines with a declared schema (map attributes, mixed lat/lon)."""
    path = _write_business_json(spark, sf_dir)
    b = RD.read_json(spark, path, S.BUSINESS_SCHEMA, required=S.REQUIRED["business"])
    return b.select("business_id", "stars", "review_count", "is_open", "city", "state", "categories",
                    fx.map_key_count("attributes").alias("attributes_count"),
                    fx.safe_double("latitude").alias("latitude"),
                    fx.safe_double("longitude").alias("longitude"))


@register("scan_json_fields", """
    SELECT CAST(business_id AS VARCHAR) AS business_id, stars, city,
           CAST(NULL AS VARCHAR) AS neighborhood FROM f_business""", doubles=("stars",))
def q_scan_json_fields(spark, sf_dir):
    """JSON lines restricted to a field list; absent keys read as NULL."""
    path = _write_business_json(spark, sf_dir)
    return RD.read_json(spark, path, S.BUSINESS_SCHEMA, fields=JSON_FIELDS)


_KEYED_CITY = """SELECT business_id, CASE WHEN city IS NULL AND business_id % 2 = 1 THEN 'Unknown'
                                     ELSE city END AS city FROM f_business"""


@register("scan_json_keys", f"""
    SELECT CAST(k.business_id AS VARCHAR) AS business_id, k.city, coalesce(c.code, -1) AS city_code
    FROM ({_KEYED_CITY}) k
    LEFT JOIN (SELECT v, CASE WHEN v = 'Unknown' THEN -1 ELSE row_number() OVER (ORDER BY v) - 1 END AS code
               FROM (SELECT DISTINCT city AS v FROM ({_KEYED_CITY}) z
                     WHERE city IS NOT NULL AND city <> 'None') d) c ON c.v = k.city""")
def q_scan_json_keys(spark, sf_dir):
    """S1 + W1: a missing city reads as 'Unknown', a null one as NULL; both get
    -1, and only the former puts 'Unknown' into the vocabulary.  Businesses
    with an even id are written with their null keys, others without."""
    b = dataset(spark, sf_dir).business
    path = scratch_path(spark, "business-keys")
    for rest, ignore in ((0, False), (1, True)):
        (b.where(F.col("business_id") % 2 == rest).withColumn("business_id", F.col("business_id").cast("string"))
         .write.option("ignoreNullFields", ignore).json(f"{path}/{rest}"))
    read = RD.read_json_keys(spark, path + "/*", S.BUSINESS_SCHEMA, absent={"city": "Unknown"},
                             required=S.REQUIRED["business"])
    return EN.sentinel_encode(read.select("business_id", "city"), "city", "city_code", null_as=None)


@register("scan_csv", """
    SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(business_id AS VARCHAR) AS business_id, stars
    FROM f_train_raw""", doubles=("stars",))
def q_scan_csv(spark, sf_dir):
    """Ratings CSV with header and declared types."""
    path = scratch_path(spark, "train-csv")
    dataset(spark, sf_dir).train_raw.select("user_id", "business_id", "stars") \
        .write.mode("overwrite").option("header", True).csv(path)
    return RD.read_ratings(spark, path)


@register("scan_csv_headers", """
    SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(business_id AS VARCHAR) AS business_id, stars
    FROM f_train_raw""", doubles=("stars",))
def q_scan_csv_headers(spark, sf_dir):
    """S3: ratings CSV whose header line stands in the first file and again
    among the rows (behind those of every user with an id divisible by 10)."""
    path, header = scratch_path(spark, "train-headers"), "user_id,business_id,stars"
    raw = dataset(spark, sf_dir).train_raw
    line = F.concat_ws(",", "user_id", "business_id", F.coalesce(F.col("stars").cast("string"), F.lit("")))
    again = F.when(F.col("user_id") % 10 == 0, F.array(line, F.lit(header))).otherwise(F.array(line))
    spark.createDataFrame([(header,)], "value string").write.text(path + "/0")
    raw.select(F.explode(again).alias("value")).write.text(path + "/1")
    return RD.read_ratings(spark, path + "/*")


@register("csv_min_columns", """
    SELECT 'user_id' AS c0, 'business_id' AS c1, 'stars' AS c2
    UNION ALL
    SELECT CAST(user_id AS VARCHAR), CAST(business_id AS VARCHAR), CAST(stars AS VARCHAR)
    FROM f_val WHERE stars IS NOT NULL""")
def q_csv_min_columns(spark, sf_dir):
    """Keep lines with at least three comma fields (the header passes)."""
    v = dataset(spark, sf_dir).val_pairs
    lines = v.select(F.when(F.col("stars").isNull(), F.concat_ws(",", "user_id", "business_id"))
                      .otherwise(F.concat_ws(",", "user_id", "business_id", F.col("stars").cast("string")))
                      .alias("value"))
    header = spark.createDataFrame([("user_id,business_id,stars",)], "value string")
    path = scratch_path(spark, "val-lines")
    header.unionByName(lines).write.mode("overwrite").text(path)
    return RD.read_lines_min_columns(spark, path, 3)


@register("sink_predictions", """
    SELECT CAST(v.user_id AS VARCHAR) AS user_id, CAST(v.business_id AS VARCHAR) AS business_id,
           coalesce(m.avg_rating, 3.0) AS prediction
    FROM f_val v LEFT JOIN (SELECT user_id, avg(stars) AS avg_rating FROM f_train_raw GROUP BY user_id) m
      ON m.user_id = v.user_id""", doubles=("prediction",))
def q_sink_predictions(spark, sf_dir):
    """Predictions written as CSV part files (CRLF, header) and read back."""
    d = dataset(spark, sf_dir)
    means = NB.entity_means(d.train_raw, "user_id", "prediction")
    pred = (d.val_pairs.select("user_id", "business_id").join(means, "user_id", "left")
            .fillna({"prediction": NB.UNKNOWN_PREDICTION}))
    path = scratch_path(spark, "predictions")
    write_predictions(pred, path)
    return RD.read_csv(spark, path, S.PREDICTIONS_SCHEMA)
