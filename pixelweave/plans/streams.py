"""Queries that run the row-wise steps on a file stream and read the sink back."""

from __future__ import annotations

from pyspark.sql import functions as F

from pixelweave.functions.labels import norm_label
from pixelweave.plans.bindings import CLASSES, INT_CLASSES, SQL_INDEX, SQL_KEPT, SQL_SPLIT, kept, split_of, table
from pixelweave.plans.learning import SQL_SCORES, mean_model, probability_rows
from pixelweave.plans.registry import query
from pixelweave.sinks import tables
from pixelweave.streaming import build, quality
from pixelweave.workspace import fresh_path


def _landed(spark, sink, columns):
    """Rows committed to a stream sink."""
    return spark.read.parquet(sink).select(*columns)


@query(f"""
SELECT event_id, label, {SQL_SPLIT} AS split, CAST({SQL_INDEX} AS INTEGER) AS label_idx FROM ({SQL_KEPT})
""")
def stream_build(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    arriving = build.read_table_stream(spark, sf_dir, "events.parquet", schema)
    sink = fresh_path(spark, "stream-build")

    def prepare(rows):
        return rows.select(
            "event_id", norm_label("event_type").alias("label"), split_of("event_id").alias("split")
        )

    run = build.stream_build(arriving, sink, fresh_path(spark, "stream-state"), CLASSES, prepare)
    run.awaitTermination()
    return _landed(spark, sink, ["event_id", "label", "split", "label_idx"])


@query(f"SELECT vec_id, class_idx, round(p, 4) AS p FROM ({SQL_SCORES})")
def stream_scoring(spark, sf_dir):
    schema = table(spark, sf_dir, "embeddings").schema
    arriving = build.read_table_stream(spark, sf_dir, "embeddings.parquet", schema)
    rows = arriving.select("vec_id", F.col("embedding").alias("features"))
    sink = fresh_path(spark, "stream-score")
    run = build.stream_score(rows, mean_model(spark, sf_dir), sink, fresh_path(spark, "stream-state"))
    run.awaitTermination()
    return probability_rows(_landed(spark, sink, ["vec_id", "probs"]))


@query(f"""
SELECT event_id, label, split, pos, pos // 50 AS chunk_id, pos // 500 AS batch_id, true AS replay_skipped
FROM (
  SELECT *, row_number() OVER (PARTITION BY split ORDER BY event_id) - 1 AS pos
  FROM (SELECT event_id, label, {SQL_SPLIT} AS split FROM ({SQL_KEPT}))
)
""")
def stream_layout(spark, sf_dir):
    """Samples that arrive in three parts, one of them twice, numbered per split."""
    samples = kept(spark, sf_dir).withColumn("split", split_of("event_id"))
    arrived, root = fresh_path(spark, "arrived"), fresh_path(spark, "stream-layout")
    bounds = samples.approxQuantile("event_id", [1 / 3, 2 / 3], 0.01)
    part = sum((F.col("event_id") > b).cast("int") for b in bounds)
    for i in range(3):
        samples.where(part == i).coalesce(1).write.mode("append").parquet(arrived)
    arriving = build.read_stream(spark, arrived, samples.schema, files_per_trigger=1)
    state = fresh_path(spark, "stream-state")
    build.stream_layout(arriving, root, state, "event_id", "split").awaitTermination()
    again = build.land(samples.where(part == 1), 1, root, "event_id", "split")
    return tables.read_table(spark, root).withColumn("replay_skipped", F.lit(not again))


_SQL_PART = "vec_id * 3 // (SELECT max(vec_id) + 1 FROM embeddings)"


@query(f"""
WITH arrived AS (
  SELECT *, CASE WHEN part = 0 AND vec_id % 50 = 7 THEN 2 ELSE part END AS batch
  FROM (SELECT vec_id, label, {_SQL_PART} AS part FROM embeddings WHERE label < {len(INT_CLASSES)})
),
kept AS (
  SELECT *, vec_id * 10 // 600 AS w FROM arrived
  WHERE batch < 2 OR (vec_id * 10 // 600 + 1) * 600 > (SELECT max(vec_id) * 10 - 900 FROM arrived WHERE batch < 2)
),
scores AS (
  SELECT k.vec_id, k.label, w, batch, class_idx, CASE WHEN batch = 0 THEN p ELSE p * p END AS p
  FROM kept AS k JOIN ({SQL_SCORES}) AS s USING (vec_id)
),
rows AS (
  SELECT vec_id, w, batch, arg_max(class_idx, p) AS predicted, any_value(label) AS label,
         sum(p) FILTER (class_idx = label) / sum(p) AS p_true
  FROM scores GROUP BY ALL
)
SELECT CAST(w * 600 AS BIGINT) AS at, CAST(CASE WHEN batch = 0 THEN 1 ELSE 2 END AS BIGINT) AS model, count(*) AS n,
       round(avg(CAST(predicted = label AS DOUBLE)), 4) AS accuracy,
       round(avg(-ln(least(greatest(p_true, 1e-7), 1 - 1e-7))), 4) AS loss
FROM rows GROUP BY 1, 2
""")
def stream_quality(spark, sf_dir):
    """Labelled vectors in three arrivals, the last with late rows, under two versions of a model."""
    last = table(spark, sf_dir, "embeddings").agg(F.max("vec_id")).first()[0]
    part = F.expr(f"vec_id * 3 div {last + 1}")
    late = (part == 0) & (F.col("vec_id") % 50 == 7)
    samples = table(spark, sf_dir, "embeddings").where(F.col("label") < len(INT_CLASSES)).select(
        F.timestamp_seconds(F.col("vec_id") * 10).alias("time"), F.col("embedding").alias("features"),
        F.col("label").cast("int").alias("label_idx"), F.when(late, 2).otherwise(part).alias("batch"),
    )
    arrived, models, root, state = (fresh_path(spark, f"quality-{n}") for n in ("in", "models", "table", "state"))
    weights = mean_model(spark, sf_dir)

    def arrive(*batches):
        for i in batches:
            samples.where(F.col("batch") == i).drop("batch").coalesce(1).write.mode("append").parquet(arrived)
        source = build.read_stream(spark, arrived, samples.drop("batch").schema, files_per_trigger=1)
        quality.stream_quality(source, models, root, state, "10 minutes", 900).awaitTermination()

    quality.publish_model(spark, weights, models)
    arrive(0)
    quality.publish_model(spark, weights * 2, models)
    arrive(1, 2)
    found = quality.quality_over_time(spark, root)
    return found.select(
        F.unix_seconds("start").alias("at"), "model", "n",
        F.round("accuracy", 4).alias("accuracy"), F.round("loss", 4).alias("loss"),
    )
