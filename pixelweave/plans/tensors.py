"""Queries on small tensors: byte codec, channel order, scaling and resizing."""

from __future__ import annotations

from pyspark.sql import functions as F

from pixelweave import fixed
from pixelweave.functions import tensors as T
from pixelweave.functions.tensors import axis_taps
from pixelweave.operators import filters
from pixelweave.operators.images import augment as augment_tensors
from pixelweave.plans.bindings import (
    INT_CLASSES,
    SHAPE,
    SQL_TENSORS,
    VALUES,
    exploded,
    table,
    tensors,
    vectors,
)
from pixelweave.plans.registry import query
from pixelweave.sinks import tables
from pixelweave.workspace import fresh_path

_MEAN = "([" + ", ".join(str(m) for m in fixed.CHANNEL_MEAN) + "]::DOUBLE[])"
_STD = "([" + ", ".join(str(s) for s in fixed.CHANNEL_STD) + "]::DOUBLE[])"

# Adding 0.0 to a rounded value turns a negative zero into zero.

# Every pixel value with its 0-based index; DuckDB lists count from 1.
_SQL_PIXELS = f"""
  SELECT vec_id, CAST(i AS INTEGER) AS i, embedding[i + 1] AS x, embedding
  FROM {SQL_TENSORS}, range({VALUES}) AS r(i)
"""


def sql_resize(source: str, h: int, w: int) -> str:
    """SQL of a bilinear resize of list column ``px`` of 8 x 8 x 3 doubles to h x w."""
    height, width, channels = SHAPE

    def taps(n_in: int, n_out: int) -> str:
        low, high, weight = axis_taps(n_in, n_out)
        rows = zip(range(n_out), low.tolist(), high.tolist(), weight.tolist())
        return "VALUES " + ", ".join(f"({o}, {a}, {b}, {u!r}::DOUBLE)" for o, a, b, u in rows)

    def at(y: str, x: str) -> str:
        return f"px[({y} * {width} + {x}) * {channels} + c + 1]"

    return f"""
      SELECT vec_id, CAST((oy * {w} + ox) * {channels} + c AS INTEGER) AS i,
             ({at('y0', 'x0')} * (1 - u) + {at('y0', 'x1')} * u) * (1 - v)
             + ({at('y1', 'x0')} * (1 - u) + {at('y1', 'x1')} * u) * v AS value
      FROM ({source}) AS s, ({taps(height, h)}) AS ty(oy, y0, y1, v),
           ({taps(width, w)}) AS tx(ox, x0, x1, u), range({channels}) AS ch(c)
    """


_SQL_LIST_PIXELS = f"SELECT vec_id, embedding::DOUBLE[] AS px FROM {SQL_TENSORS}"


@query(f"""
SELECT vec_id, i, CAST(embedding[i - i % 3 + (2 - i % 3) + 1] AS DOUBLE) AS value FROM ({_SQL_PIXELS})
""")
def channel_reorder(spark, sf_dir):
    swapped = T.from_bytes(T.bgr_to_rgb("tensor", SHAPE), SHAPE)
    return exploded(tensors(spark, sf_dir), swapped)


@query(f"""
SELECT vec_id, i, CAST(embedding[i - i % 3 + (2 - i % 3) + 1] AS DOUBLE) AS value FROM ({_SQL_PIXELS})
""")
def channel_reorder_expr(spark, sf_dir):
    return exploded(vectors(spark, sf_dir), T.bgr_to_rgb_expr("pixels"))


@query(f"""
SELECT vec_id, i, round((CAST(x AS DOUBLE) / 255 - {_MEAN}[i % 3 + 1]) / {_STD}[i % 3 + 1], 6) AS value
FROM ({_SQL_PIXELS})
""")
def scale_standardize(spark, sf_dir):
    values = F.col("pixels").cast("array<double>")
    return exploded(vectors(spark, sf_dir), T.standardize_expr(T.scale01_expr(values)), 6)


@query(f"""
SELECT vec_id, i,
       CAST(CAST((CAST(CAST(x / CAST(255 AS FLOAT) AS FLOAT) AS DOUBLE) - {_MEAN}[i % 3 + 1])
                 / {_STD}[i % 3 + 1] AS FLOAT) AS DOUBLE) AS value
FROM ({_SQL_PIXELS})
""")
def scale_standardize_bytes(spark, sf_dir):
    # The float32 form that is stored; both sides round at the same two places.
    done = T.standardize(T.scale01("tensor", SHAPE), SHAPE)
    return exploded(tensors(spark, sf_dir), T.from_bytes(done, SHAPE))


def _resized(spark, sf_dir, h, w):
    resized = T.from_bytes(T.resize("tensor", SHAPE, h, w), (h, w, SHAPE[2]))
    return exploded(tensors(spark, sf_dir), resized, 5).withColumn("side", F.lit(h))


@query(f"""
SELECT vec_id, i, round(CAST(CAST(value AS FLOAT) AS DOUBLE), 5) + 0.0 AS value, 2 AS side
FROM ({sql_resize(_SQL_LIST_PIXELS, 2, 2)})
UNION ALL
SELECT vec_id, i, round(CAST(CAST(value AS FLOAT) AS DOUBLE), 5) + 0.0, 6
FROM ({sql_resize(_SQL_LIST_PIXELS, 6, 6)})
""")
def bilinear_resize(spark, sf_dir):
    return _resized(spark, sf_dir, 2, 2).unionByName(_resized(spark, sf_dir, 6, 6))


@query(f"""
SELECT vec_id, i, round(value, 5) + 0.0 AS value FROM ({sql_resize(_SQL_LIST_PIXELS, 6, 6)})
""")
def bilinear_resize_expr(spark, sf_dir):
    return exploded(vectors(spark, sf_dir), T.resize_expr("pixels", SHAPE, 6, 6), 5)


@query("""
SELECT event_id, CAST(CAST(value AS FLOAT) AS DOUBLE) AS value FROM events
""")
def cast_float32(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    return rows.select("event_id", T.as_float32("value").cast("double").alias("value"))


@query(f"""
SELECT vec_id, i, CAST(x AS DOUBLE) AS value FROM ({_SQL_PIXELS}) WHERE embedding[1] >= 0
""")
def tensor_bytes_roundtrip(spark, sf_dir):
    # Payloads that start with a negative value are cut short and must be dropped.
    cut = F.when(F.get("pixels", F.lit(0)) < 0, F.substring("tensor", 1, 100)).otherwise(F.col("tensor"))
    rows = vectors(spark, sf_dir).withColumn("tensor", T.to_bytes("pixels")).withColumn("tensor", cut)
    whole = filters.drop_bad_payload(rows.select("vec_id", "tensor"), *SHAPE)
    return exploded(whole, T.from_bytes("tensor", SHAPE))


@query("""
SELECT label, CAST(label AS INTEGER) AS label_idx, count(*) AS n,
       CAST(count(*) AS DOUBLE) AS target_sum, CAST(count(*) * 768 AS BIGINT) AS tensor_bytes
FROM embeddings WHERE label < 5 GROUP BY 1
""")
def training_set(spark, sf_dir):
    rows = tables.training_set(tensors(spark, sf_dir), INT_CLASSES)
    path = fresh_path(spark, "training")
    tables.write_training_set(rows, path)
    stored = tables.read_table(spark, path)
    return stored.groupBy("label", "label_idx").agg(
        F.count("*").alias("n"),
        F.sum(F.get("target", F.col("label_idx"))).alias("target_sum"),
        F.sum(F.length("tensor")).alias("tensor_bytes"),
    )


def _sql_uniform(use: str) -> str:
    digest = f"substr(md5('11-0-' || vec_id || '-{use}'), 1, 8)"
    return f"(CAST(('0x' || {digest}) AS BIGINT) / 4294967296.0::DOUBLE)"


@query(f"""
WITH draws AS (
  SELECT vec_id, embedding, {_sql_uniform('flip')} < 0.5 AS flip,
         ({_sql_uniform('brightness')} * 2 - 1) * 0.2::DOUBLE AS shift,
         {_sql_uniform('contrast')} * (1.2::DOUBLE - 0.8::DOUBLE) + 0.8::DOUBLE AS gain
  FROM {SQL_TENSORS}
),
moved AS (
  SELECT vec_id, y, x, c, gain,
         CAST(embedding[(y * 8 + CASE WHEN flip THEN 7 - x ELSE x END) * 3 + c + 1] AS DOUBLE) + shift AS p
  FROM draws, range(8) AS a(y), range(8) AS b(x), range(3) AS d(c)
),
centred AS (SELECT *, avg(p) OVER (PARTITION BY vec_id, c) AS m FROM moved)
SELECT vec_id, CAST((y * 8 + x) * 3 + c AS INTEGER) AS i,
       round(CAST(CAST((p - m) * gain + m AS FLOAT) AS DOUBLE), 5) + 0.0 AS value
FROM centred
""")
def augment(spark, sf_dir):
    changed = augment_tensors(tensors(spark, sf_dir), SHAPE, "vec_id", seed=11)
    return exploded(changed, T.from_bytes("tensor", SHAPE), 5)
