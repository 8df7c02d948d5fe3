"""Queries on layout: limits, caps, chunks, batches, epochs and permutations."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from pixelweave import schemas
from pixelweave.functions import labels as L
from pixelweave.operators import aggregates as A, joins, layout
from pixelweave.operators.numbering import with_place, with_position
from pixelweave.plans.bindings import (
    CLASSES,
    SQL_BATCHES,
    SQL_CHUNKS,
    SQL_GAPPY,
    SQL_KEPT,
    SQL_LIST,
    SQL_SPLIT,
    batches,
    chunks,
    gappy_chunks,
    kept,
    samples,
    split_of,
    table,
)
from pixelweave.plans.registry import query
from pixelweave.sinks import metadata, tables
from pixelweave.sources import chunks as scans, files, samples as sources
from pixelweave.workspace import fresh_path

_SEED = 17
_EPOCHS = 2
_BUFFER = 1000
_RUN_INFO = T.StructType([*schemas.BATCH_INFO.fields, T.StructField("num_classes", T.LongType())])


@query(f"{SQL_KEPT} ORDER BY event_id LIMIT 500")
def limit_after_filter(spark, sf_dir):
    listed = F.col("label").isin(list(CLASSES))
    return layout.filter_limit(samples(spark, sf_dir), listed, 500, "event_id")


@query(f"""
SELECT event_id, event_type AS label FROM (SELECT * FROM events ORDER BY event_id LIMIT 500)
WHERE event_type IN ({SQL_LIST})
""")
def limit_before_filter(spark, sf_dir):
    listed = F.col("label").isin(list(CLASSES))
    return layout.limit_filter(samples(spark, sf_dir), 500, listed, "event_id")


@query("SELECT event_id, event_type AS label FROM events ORDER BY event_id LIMIT 100")
def head_n(spark, sf_dir):
    return layout.head(samples(spark, sf_dir), 100, "event_id")


@query("SELECT event_id, event_type AS label FROM events ORDER BY event_id LIMIT 5000")
def head_n_large(spark, sf_dir):
    return layout.head(samples(spark, sf_dir), 5000, "event_id")


@query(f"""
SELECT event_id, label, split, CAST(pos AS BIGINT) AS pos
FROM (
  SELECT *, row_number() OVER (PARTITION BY split ORDER BY event_id) - 1 AS pos
  FROM (SELECT event_id, label, {SQL_SPLIT} AS split FROM ({SQL_KEPT}))
)
WHERE pos < CASE split WHEN 'train' THEN 640 ELSE 80 END
""")
def per_split_cap(spark, sf_dir):
    rows = kept(spark, sf_dir).withColumn("split", split_of("event_id"))
    caps = {"train": 640, "validation": 80, "test": 80}
    return layout.cap_per_split(rows, caps, "event_id")


@query(f"""
SELECT CAST(chunk_id AS BIGINT) AS chunk_id, min(event_id) AS first_id, max(event_id) AS last_id,
       count(*) AS n, CAST(chunk_id * 50 AS BIGINT) AS start_pos,
       CAST(least(chunk_id * 50 + 50, (SELECT count(*) FROM ({SQL_KEPT}))) AS BIGINT) AS end_pos,
       CAST(((SELECT count(*) FROM ({SQL_KEPT})) + 49) // 50 AS BIGINT) AS chunks
FROM ({SQL_CHUNKS}) GROUP BY chunk_id
""")
def chunk_assign(spark, sf_dir):
    rows = chunks(spark, sf_dir)
    per_chunk = rows.groupBy("chunk_id").agg(
        F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"), F.count("*").alias("n")
    )
    start = F.col("chunk_id") * 50
    return per_chunk.select(
        "*",
        start.alias("start_pos"),
        L.clamp_end(start, 50, A.totals(rows).scalar()).alias("end_pos"),
        A.chunk_count(rows).scalar().alias("chunks"),
    )


@query(f"""
SELECT CAST(chunk_id AS BIGINT) AS chunk_id, count(*) AS n FROM ({SQL_GAPPY})
WHERE chunk_id >= 0 AND chunk_id < 20 GROUP BY 1
""")
def chunk_tolerant_scan(spark, sf_dir):
    found = A.block_size(scans.read_chunks(gappy_chunks(spark, sf_dir), 0, 20))
    return sources.id_range(spark, 0, 20).join(found, "chunk_id")


@query(f"""
WITH ids AS (SELECT DISTINCT chunk_id FROM ({SQL_GAPPY})),
prefix AS (
  SELECT chunk_id
  FROM (SELECT chunk_id, row_number() OVER (ORDER BY chunk_id) - 1 AS expected FROM ids)
  WHERE chunk_id = expected
)
SELECT CAST(chunk_id AS BIGINT) AS chunk_id, count(*) AS n
FROM ({SQL_GAPPY}) JOIN prefix USING (chunk_id) GROUP BY 1
""")
def chunk_prefix_scan(spark, sf_dir):
    return A.block_size(scans.read_chunk_prefix(gappy_chunks(spark, sf_dir)))


@query(f"""
WITH held AS (SELECT *, {SQL_SPLIT} AS split FROM ({SQL_GAPPY})),
gap AS (SELECT min(chunk_id) AS first_gap FROM range(10000000) AS r(chunk_id)
        WHERE chunk_id NOT IN (SELECT chunk_id FROM held WHERE split = 'train')
          AND chunk_id <= (SELECT max(chunk_id) + 1 FROM held))
SELECT 'range' AS scan, CAST(chunk_id AS BIGINT) AS chunk_id, count(*) AS n FROM held
WHERE split = 'train' AND chunk_id >= 3 AND chunk_id < 40 GROUP BY 2
UNION ALL
SELECT 'prefix', CAST(chunk_id AS BIGINT), count(*) FROM held, gap
WHERE split = 'train' AND chunk_id < first_gap GROUP BY 2
""")
def chunk_zone_scan(spark, sf_dir):
    rows = gappy_chunks(spark, sf_dir).withColumn("split", split_of("event_id"))
    path = fresh_path(spark, "chunks")
    tables.write_chunks(rows.repartitionByRange("chunk_id").sortWithinPartitions("chunk_id"), path)
    ranged = A.block_size(scans.read_stored_chunks(spark, path, 3, 40, "train"))
    prefix = A.block_size(scans.read_stored_prefix(spark, path, "train"))
    both = ranged.withColumn("scan", F.lit("range")).unionByName(prefix.withColumn("scan", F.lit("prefix")))
    return both.select("scan", "chunk_id", "n")


@query(f"""
SELECT CAST(batch_id AS BIGINT) AS batch_id, count(*) AS n_loaded,
       count(*) FILTER (label IN ({SQL_LIST})) AS n_kept,
       (SELECT count(DISTINCT batch_id) FROM ({SQL_BATCHES})) AS num_batches
FROM ({SQL_BATCHES}) GROUP BY 1
""")
def batch_pack(spark, sf_dir):
    rows = batches(spark, sf_dir)
    per_batch = A.batch_kept_counts(rows, CLASSES)
    return per_batch.withColumn("num_batches", A.batch_count(rows).scalar())


@query(f"""
SELECT CAST(batch_id AS BIGINT) AS batch_id, label, count(*) AS n
FROM ({SQL_BATCHES}) WHERE batch_id % 3 <> 1 AND label IN ({SQL_LIST}) GROUP BY 1, 2
""")
def batch_read(spark, sf_dir):
    # All batches are written; the read leaves out every third.
    packed = batches(spark, sf_dir)
    path = fresh_path(spark, "batches")
    tables.write_batches(packed, path, CLASSES)
    wanted = [i for i in range(A.batch_count(packed).first()["num_batches"]) if i % 3 != 1]
    stored = scans.read_batches(tables.read_table(spark, path), wanted)
    return stored.groupBy("batch_id", "label").agg(F.count("*").alias("n"))


@query(f"""
SELECT CAST(batch_id AS BIGINT) AS batch_id, count(*) AS n,
       CAST(row_number() OVER (ORDER BY batch_id) - 1 AS BIGINT) AS place
FROM ({SQL_BATCHES}) GROUP BY batch_id
""")
def ordered_batches(spark, sf_dir):
    return with_place(layout.order_batches(A.batch_sizes(batches(spark, sf_dir))))


@query(f"""
SELECT event_id, CAST(chunk_id AS BIGINT) AS chunk_id, CAST(pos AS BIGINT) AS pos,
       CAST(row_number() OVER (ORDER BY chunk_id, pos) - 1 AS BIGINT) AS place
FROM ({SQL_CHUNKS})
""")
def stable_order(spark, sf_dir):
    # Dealt to tasks by a hash first, so that only the sort can bring the rows in order.
    dealt = chunks(spark, sf_dir).select("event_id", "chunk_id", "pos").repartition("event_id")
    return with_place(layout.stable_order(dealt))


@query(f"""
SELECT 10 AS epochs, 32 AS batch_size, 0.001::DOUBLE AS learning_rate, {len(CLASSES)} AS num_classes,
       CAST(count(DISTINCT batch_id) AS INTEGER) AS num_batches, 10 AS chunks_per_batch
FROM ({SQL_BATCHES})
""")
def run_config(spark, sf_dir):
    found = A.batch_count(batches(spark, sf_dir)).first()["num_batches"]
    path = fresh_path(spark, "config")
    metadata.write_meta(metadata.run_config(spark, found, len(CLASSES)), path)
    return files.read_meta(spark, path, schemas.RUN_CONFIG)


_SQL_RANGES = f"""
  SELECT batch_id, n, CAST(sum(n) OVER (ORDER BY batch_id) - n AS BIGINT) AS start,
         CAST(sum(n) OVER (ORDER BY batch_id) AS BIGINT) AS "end"
  FROM (
    SELECT CAST(batch_id AS BIGINT) AS batch_id, count(*) FILTER (label IN ({SQL_LIST})) AS n
    FROM ({SQL_BATCHES}) GROUP BY 1
  )
"""


@query(_SQL_RANGES)
def batch_ranges(spark, sf_dir):
    sizes = A.batch_sizes(batches(spark, sf_dir), CLASSES)
    return layout.batch_ranges(sizes).select("batch_id", "n", "start", "end")


@query(f"""
SELECT batch_id, label, count(*) AS n
FROM (SELECT label, row_number() OVER (ORDER BY event_id) - 1 AS pos FROM ({SQL_KEPT})) AS l
JOIN ({_SQL_RANGES}) AS r ON l.pos >= r.start AND l.pos < r."end"
GROUP BY 1, 2
""")
def batch_range_join(spark, sf_dir):
    ranges = layout.batch_ranges(A.batch_sizes(batches(spark, sf_dir), CLASSES))
    labels = with_position(kept(spark, sf_dir), "event_id").select("pos", "label")
    located = joins.assign_batch_range(labels, ranges)
    return located.groupBy("batch_id", "label").agg(F.count("*").alias("n"))


@query(f"""
SELECT CAST(chunk_id AS BIGINT) AS chunk_id, count(*) AS n_images,
       count(*) FILTER (label <> 'signup') AS n_labels,
       count(*) FILTER (label <> 'signup') AS n_matched
FROM ({SQL_CHUNKS}) GROUP BY 1
""")
def realign_check(spark, sf_dir):
    # The label side lacks one class, so the report has something to find.
    rows = chunks(spark, sf_dir)
    report = joins.realign_report(rows, rows.where(F.col("label") != "signup"))
    counts = ["n_images", "n_labels", "n_matched"]
    return report.select("chunk_id", *[F.col(c).cast("bigint").alias(c) for c in counts])


_SQL_MIXED = f"""
  SELECT CASE WHEN chunk_id % 5 = 1 AND pos % 50 = 7 THEN pos + 1
              WHEN chunk_id % 5 = 1 AND pos % 50 = 8 THEN pos - 1 ELSE pos END AS pos, chunk_id, event_id
  FROM ({SQL_CHUNKS}) WHERE NOT (chunk_id % 5 = 2 AND pos % 50 = 0)
  UNION ALL SELECT pos, chunk_id, event_id FROM ({SQL_CHUNKS}) WHERE chunk_id % 5 = 3 AND pos % 50 = 0
"""


@query(f"""
SELECT CAST(chunk_id AS BIGINT) AS chunk_id, n_images, coalesce(n_labels, 0) AS n_labels,
       coalesce(held = other, false) AS aligned
FROM (SELECT chunk_id, count(*) AS n_images, list((pos, event_id) ORDER BY pos, event_id) AS held
      FROM ({SQL_CHUNKS}) GROUP BY 1)
LEFT JOIN (SELECT chunk_id, count(*) AS n_labels, list((pos, event_id) ORDER BY pos, event_id) AS other
           FROM ({_SQL_MIXED}) GROUP BY 1) USING (chunk_id)
""")
def chunk_alignment(spark, sf_dir):
    # Of every five chunks one has two keys swapped, one lacks a row, and one repeats a row.
    rows = chunks(spark, sf_dir).select("chunk_id", "pos", "event_id")
    place, kind = F.col("pos") % 50, F.col("chunk_id") % 5
    swapped = F.when((kind == 1) & (place == 7), F.col("pos") + 1)
    swapped = swapped.when((kind == 1) & (place == 8), F.col("pos") - 1).otherwise(F.col("pos"))
    other = rows.where(~((kind == 2) & (place == 0))).withColumn("pos", swapped)
    other = other.unionByName(rows.where((kind == 3) & (place == 0)))
    return joins.alignment_report(rows, other, "event_id")


@query(f"""
SELECT event_id, label, CAST(chunk_id AS BIGINT) AS chunk_id, CAST(pos AS BIGINT) AS pos
FROM ({SQL_CHUNKS}) WHERE label <> 'signup'
""")
def realign(spark, sf_dir):
    rows = chunks(spark, sf_dir)
    images = rows.select("chunk_id", "pos", "event_id")
    side = rows.where(F.col("label") != "signup").select("chunk_id", "pos", "label")
    return joins.realign(images, side)


@query(f"""
SELECT 'batches' AS batch_dir, count(*) FILTER (label IN ({SQL_LIST})) AS total_images,
       count(DISTINCT batch_id) AS num_batches,
       count(DISTINCT label) FILTER (label IN ({SQL_LIST})) AS num_classes
FROM ({SQL_BATCHES})
""")
def run_metadata(spark, sf_dir):
    rows = batches(spark, sf_dir)
    path = fresh_path(spark, "batch-info")
    metadata.write_meta(metadata.batch_info(rows, "batches", CLASSES), path)
    return files.read_meta(spark, path, _RUN_INFO)


@query(f"""
SELECT split, count(*) AS n, CAST((count(*) + 31) // 32 AS BIGINT) AS steps
FROM (SELECT {SQL_SPLIT} AS split FROM events) GROUP BY 1
""")
def steps_per_epoch(spark, sf_dir):
    rows = samples(spark, sf_dir).select(split_of("event_id").alias("split"))
    return A.totals(rows, "split").withColumn("steps", A.ceil_div(F.col("n"), 32))


@query("""
SELECT CAST(epoch AS INTEGER) AS epoch, label, count(*) AS n
FROM embeddings, range(3) AS e(epoch) GROUP BY 1, 2
""")
def repeat_epochs(spark, sf_dir):
    rows = layout.repeat_epochs(table(spark, sf_dir, "embeddings").select("label"), 3)
    return rows.groupBy("epoch", "label").agg(F.count("*").alias("n"))


@query(f"""
SELECT vec_id, CAST(epoch AS INTEGER) AS epoch,
       CAST(row_number() OVER (
         PARTITION BY epoch ORDER BY md5('{_SEED}-' || epoch || '-' || vec_id), vec_id) - 1 AS BIGINT) AS pos
FROM embeddings, range({_EPOCHS}) AS e(epoch)
""")
def seeded_shuffle(spark, sf_dir):
    rows = layout.repeat_epochs(table(spark, sf_dir, "embeddings").select("vec_id"), _EPOCHS)
    return layout.shuffle_seeded(rows, _SEED, "vec_id", "epoch")


@query(f"""
SELECT vec_id, label, CAST(pos AS BIGINT) AS pos, CAST(pos // 50 AS BIGINT) AS chunk_id
FROM (
  SELECT vec_id, label,
         row_number() OVER (ORDER BY md5('{_SEED}-0-' || vec_id), vec_id) - 1 AS pos
  FROM embeddings
)
""")
def preshuffle(spark, sf_dir):
    return layout.preshuffle(table(spark, sf_dir, "embeddings").select("vec_id", "label"), _SEED, "vec_id")


@query(f"""
SELECT vec_id, epoch, pos, CAST(row_number() OVER (ORDER BY place + draw % {_BUFFER}, place) - 1 AS BIGINT) AS shuffled
FROM (
  SELECT vec_id, CAST(epoch AS INTEGER) AS epoch, CAST(pos AS BIGINT) AS pos,
         pos + epoch * (SELECT count(*) FROM embeddings) AS place,
         ('0x' || substr(md5('{_SEED}-' || epoch || '-' || vec_id), 1, 12))::BIGINT AS draw
  FROM (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS pos FROM embeddings), range({_EPOCHS}) AS e(epoch)
)
""")
def buffered_shuffle(spark, sf_dir):
    placed = with_position(table(spark, sf_dir, "embeddings").select("vec_id"), "vec_id")
    n = placed.count()
    rows = layout.repeat_epochs(placed, _EPOCHS)
    mixed = layout.shuffle_buffered(rows, _SEED, "vec_id", _BUFFER, n, epoch="epoch", epochs=_EPOCHS)
    return mixed.select("vec_id", "epoch", "pos", "shuffled")


@query("""
SELECT CAST(pos // 32 AS BIGINT) AS step, count(*) AS n, min(vec_id) AS first_id, max(vec_id) AS last_id
FROM (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS pos FROM embeddings) GROUP BY 1
""")
def minibatch(spark, sf_dir):
    rows = with_position(table(spark, sf_dir, "embeddings").select("vec_id"), "vec_id")
    return layout.minibatch(rows).groupBy("step").agg(
        F.count("*").alias("n"), F.min("vec_id").alias("first_id"), F.max("vec_id").alias("last_id")
    )


@query("""
SELECT CAST(pos AS BIGINT) AS pos, l_orderkey, l_linenumber
FROM (
  SELECT l_orderkey, l_linenumber,
         row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
                            l_extendedprice, l_shipdate) - 1 AS pos
  FROM lineitem
)
""")
def dense_positions(spark, sf_dir):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    rows = table(spark, sf_dir, "lineitem").select(*keys)
    return with_position(rows, keys).select("pos", "l_orderkey", "l_linenumber")
