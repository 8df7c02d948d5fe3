"""Queries on labels: scans, normalisation, class filters, encodings and histograms."""

from __future__ import annotations

from pyspark.sql import functions as F

from pixelweave.functions import labels as L
from pixelweave.operators import aggregates as A, filters, joins, layout, sets
from pixelweave.operators.numbering import with_place, with_position
from pixelweave.plans.bindings import (
    CLASSES,
    INT_CLASSES,
    SQL_CLASSES,
    SQL_INDEX,
    SQL_KEPT,
    SQL_LIST,
    SQL_SPLIT,
    kept,
    samples,
    split_of,
    table,
)
from pixelweave.plans.registry import query
from pixelweave.sinks import metadata, tables
from pixelweave.sources import files, samples as sources
from pixelweave.workspace import fresh_path


@query(f"""
WITH classes(class_idx, label) AS (VALUES {SQL_CLASSES}),
counts AS (SELECT lower(trim(event_type)) AS label, count(*) AS n FROM events GROUP BY 1)
SELECT CAST(class_idx AS INTEGER) AS class_idx, label, CAST(coalesce(n, 0) AS BIGINT) AS n
FROM classes LEFT JOIN counts USING (label)
""")
def label_class_histogram(spark, sf_dir):
    rows = samples(spark, sf_dir).select(L.norm_label("label").alias("label"))
    return A.class_histogram(rows, CLASSES, zero_filled=True)


@query(f"""
SELECT event_id, event_type AS label, 'train' AS split
FROM (SELECT event_id, event_type, {SQL_SPLIT} AS split FROM events) WHERE split = 'train'
""")
def sample_scan(spark, sf_dir):
    detection = F.struct(F.col("label").alias("label"))
    annotated = samples(spark, sf_dir).select(
        F.col("event_id").alias("sample_id"),
        split_of("event_id").alias("split"),
        F.format_string("img/%d.jpg", "event_id").alias("filepath"),
        F.struct(F.array(detection).alias("detections")).alias("ground_truth"),
    )
    path = fresh_path(spark, "annotated")
    annotated.write.parquet(path)
    return sources.read_samples(spark, path, "train").select(
        F.col("sample_id").alias("event_id"), L.first_label("ground_truth.detections").alias("label"), "split"
    )


@query(f"""
SELECT event_id, event_type AS label
FROM (SELECT event_id, event_type, {SQL_SPLIT} AS split FROM events) WHERE split = 'train'
ORDER BY event_id LIMIT 300
""")
def first_samples(spark, sf_dir):
    annotated = samples(spark, sf_dir).select(
        F.col("event_id").alias("sample_id"),
        split_of("event_id").alias("split"),
        F.lit("").alias("filepath"),
        F.struct(F.array(F.struct("label")).alias("detections")).alias("ground_truth"),
    )
    path = fresh_path(spark, "annotated")
    annotated.write.parquet(path)
    return sources.read_samples(spark, path, "train", max_samples=300).select(
        F.col("sample_id").alias("event_id"), L.first_label("ground_truth.detections").alias("label")
    )


@query("""
WITH named AS (SELECT page_id, url, regexp_extract(url, '[^/]*$') AS name FROM pages),
listed AS (
  SELECT * FROM named WHERE name LIKE '%.html'
  UNION ALL SELECT * FROM named WHERE name LIKE '%#top'
)
SELECT page_id, url, name, CAST(row_number() OVER (ORDER BY url, page_id) - 1 AS BIGINT) AS pos
FROM listed WHERE starts_with(name, '4')
""")
def path_listing(spark, sf_dir):
    named = table(spark, sf_dir, "pages").select("page_id", "url", L.basename("url").alias("name"))
    listed = sets.union_chunks(
        named.where(F.col("name").endswith(".html")), named.where(F.col("name").endswith("#top"))
    )
    return with_position(filters.name_prefix(listed, "4"), ["url", "page_id"])


# A label file is one text; the broken ones must count as having no labels.
_LABEL_FILES = {
    "object": '{"labels":%s}',
    "list": "%s",
    "blank space": " \n%s\n",
    "trailing text": "%s xx",
    "trailing after object": '{"labels":%s} trailing',
    "other key": '{"other":%s}',
}


@query("""
WITH files(file) AS (VALUES ('object'), ('list'), ('blank space')),
kinds AS (SELECT DISTINCT event_type AS label FROM events)
SELECT file, CAST(row_number() OVER (PARTITION BY file ORDER BY label) - 1 AS BIGINT) AS pos, label
FROM files, kinds
""")
def label_file_scan(spark, sf_dir):
    # One list of the distinct labels, as long as the class list.
    kinds = samples(spark, sf_dir).agg(F.to_json(F.array_sort(F.collect_set("label"))).alias("labels"))
    found = None
    for name, form in _LABEL_FILES.items():
        path = fresh_path(spark, "label-file")
        text = F.format_string(form.replace("%s", "%1$s"), "labels")
        kinds.select(text.alias("value")).coalesce(1).write.text(path)
        rows = files.read_labels(spark, path).select(F.lit(name).alias("file"), "pos", "label")
        found = rows if found is None else found.union(rows)
    return found


@query("""
SELECT doc_id, CAST(quality AS INTEGER) AS mapped FROM labels
""")
def label_map_text(spark, sf_dir):
    rows = table(spark, sf_dir, "labels")
    text = F.to_json(F.create_map(F.lit("quality"), "quality"))
    mapped = F.try_element_at(L.parse_label_map(text), F.lit("quality"))
    return rows.select("doc_id", mapped.alias("mapped"))


@query(f"""
SELECT label, CAST(class_idx AS INTEGER) AS class_idx FROM (VALUES {SQL_CLASSES}) AS c(class_idx, label)
WHERE label IN (SELECT DISTINCT event_type FROM events) OR label = 'cart'
""")
def label_map_file(spark, sf_dir):
    path = fresh_path(spark, "label-map")
    metadata.write_meta(metadata.label_map(spark, CLASSES), path)
    present = samples(spark, sf_dir).select("label").distinct()
    stored = files.read_label_map(spark, path)
    return stored.join(present, "label").union(stored.where("label = 'cart'")).select("label", "class_idx")


@query("""
SELECT CAST(doc_id % 80 AS VARCHAR) AS label, count(*) AS n FROM documents GROUP BY 1
""")
def fallback_labels(spark, sf_dir):
    listing = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("pos"))
    no_labels = table(spark, sf_dir, "labels").where("doc_id < 0")
    empty = no_labels.select(F.col("doc_id").alias("pos"), F.col("quality").cast("string").alias("label"))
    return A.totals(files.with_labels(listing, empty), "label")


@query("""
WITH first_turn AS (SELECT conv_id, arg_min(role, turn) AS role FROM conversations GROUP BY 1)
SELECT doc_id, coalesce(lower(trim(role)), 'unknown') AS label
FROM documents LEFT JOIN first_turn ON doc_id = conv_id
""")
def first_detection_label(spark, sf_dir):
    # Only the first detection matters, so the rest of a group is never gathered.
    first = F.min_by(F.struct(F.col("role").alias("label")), "turn")
    detections = (
        table(spark, sf_dir, "conversations")
        .groupBy(F.col("conv_id").alias("doc_id"))
        .agg(F.array(first).alias("detections"))
    )
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return docs.join(detections, "doc_id", "left").select(
        "doc_id", L.first_label("detections").alias("label")
    )


@query("""
WITH taken AS (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos
  FROM documents
)
SELECT doc_id, CAST(pos AS BIGINT) AS pos, printf('coco_%06d.jpg', pos) AS name,
       'train/images_chunk_' || (pos // 50) AS chunk
FROM taken WHERE doc_id IN (SELECT doc_id FROM labels)
""")
def canonical_name(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    taken = with_position(docs, "doc_id")
    # Names count the rows before the drop, so missing sources leave gaps.
    found = filters.drop_missing_source(taken, table(spark, sf_dir, "labels"), "doc_id")
    return found.select(
        "doc_id",
        "pos",
        L.canonical_name("pos").alias("name"),
        L.chunk_path(F.lit("train"), F.expr("pos div 50")).alias("chunk"),
    )


@query(f"SELECT * FROM ({SQL_KEPT})")
def label_semi_join(spark, sf_dir):
    listed = joins.class_list(spark, CLASSES)
    return joins.semi_join_classes(samples(spark, sf_dir), listed).select("event_id", "label")


@query(f"""
WITH classes(listed_idx, label) AS (VALUES {SQL_CLASSES}),
counts AS (SELECT label, count(*) AS n FROM ({SQL_KEPT}) GROUP BY 1)
SELECT CAST(row_number() OVER (ORDER BY listed_idx) - 1 AS INTEGER) AS class_idx, label, n,
       (SELECT count(DISTINCT label) FROM ({SQL_KEPT})) AS num_classes
FROM classes JOIN counts USING (label)
""")
def present_classes(spark, sf_dir):
    rows = samples(spark, sf_dir)
    distinct = A.num_classes(filters.keep_classes(rows, CLASSES)).scalar()
    return joins.present_classes(rows, CLASSES).withColumn("num_classes", distinct)


@query(f"""
WITH present AS (
  SELECT label, row_number() OVER (ORDER BY {SQL_INDEX}) - 1 AS idx
  FROM (SELECT DISTINCT label FROM ({SQL_KEPT}))
)
SELECT event_id, label, CAST(idx AS INTEGER) AS class_idx FROM ({SQL_KEPT}) JOIN present USING (label)
""")
def label_encode_present(spark, sf_dir):
    return joins.encode_label(kept(spark, sf_dir), CLASSES, mode="present")


_PAGE_NUMBER = r"/([0-9]+)([?#].*)?$"


def _page_numbers(spark, sf_dir):
    number = F.expr(f"try_cast(regexp_extract(url, r'{_PAGE_NUMBER}', 1) AS bigint)")
    return table(spark, sf_dir, "pages").select("page_id", number.alias("number"))


@query(rf"""
SELECT page_id, number
FROM (SELECT page_id, TRY_CAST(regexp_extract(url, '{_PAGE_NUMBER}', 1) AS BIGINT) AS number FROM pages)
WHERE number IS NOT NULL
""")
def drop_invalid(spark, sf_dir):
    return filters.drop_invalid(_page_numbers(spark, sf_dir), "number")


@query(rf"""
SELECT CASE WHEN number IS NULL THEN 'no number' ELSE 'kept' END AS outcome, count(*) AS n
FROM (SELECT TRY_CAST(regexp_extract(url, '{_PAGE_NUMBER}', 1) AS BIGINT) AS number FROM pages)
GROUP BY 1
""")
def reject_report(spark, sf_dir):
    reason = filters.reject_reason(**{"no number": F.col("number").isNotNull()})
    rows = _page_numbers(spark, sf_dir).select(F.coalesce(reason, F.lit("kept")).alias("outcome"))
    return A.totals(rows, "outcome")


@query("""
WITH d AS (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents),
l AS (SELECT doc_id AS labelled_id, quality, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM labels)
SELECT CAST(pos AS BIGINT) AS pos, doc_id, lang, labelled_id, quality FROM d JOIN l USING (pos)
""")
def positional_zip(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    side = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("labelled_id"), "quality")
    return joins.zip_by_position(docs, side, "doc_id", "labelled_id")


@query("""
WITH d AS (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents ORDER BY doc_id LIMIT 60),
l AS (SELECT doc_id AS labelled_id, quality, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM labels
      ORDER BY doc_id LIMIT 50)
SELECT CAST(pos AS BIGINT) AS pos, doc_id, lang, labelled_id, quality FROM d JOIN l USING (pos)
""")
def limited_zip(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    side = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("labelled_id"), "quality")
    return joins.zip_by_position(
        layout.head(docs, 60, "doc_id"), layout.head(side, 50, "labelled_id"), "doc_id", "labelled_id"
    )


@query("""
SELECT page_id, url AS path, CAST(rank() OVER (ORDER BY url) - 1 AS BIGINT) AS place FROM pages
""")
def ordered_paths(spark, sf_dir):
    listed = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("path"))
    placed = with_place(layout.order_by_path(listed))
    # Rows of one path may come in any order, so they share the place of the first.
    first = placed.groupBy("path").agg(F.min("place").alias("place"))
    return placed.drop("place").join(first, "path")


@query(f"""
SELECT 'listed' AS part, count(*) FILTER (event_type IN ({SQL_LIST})) > 0 AS any_rows FROM events
UNION ALL SELECT 'absent', count(*) FILTER (event_type = 'cart') > 0 FROM events
""")
def any_rows(spark, sf_dir):
    rows = samples(spark, sf_dir)
    listed = A.any_rows(filters.keep_classes(rows, CLASSES)).withColumn("part", F.lit("listed"))
    absent = A.any_rows(filters.keep_classes(rows, ["cart"])).withColumn("part", F.lit("absent"))
    return listed.union(absent).select("part", "any_rows")


@query("""
SELECT doc_id, lang, quality, toxic FROM documents JOIN labels USING (doc_id)
""")
def lookup_join(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return joins.lookup_join(docs, table(spark, sf_dir, "labels"), "doc_id")


@query(f"""
SELECT split, label, count(*) AS n, count(*) > 0 AS any_rows
FROM (SELECT event_type AS label, {SQL_SPLIT} AS split FROM events) GROUP BY 1, 2
""")
def split_summary(spark, sf_dir):
    rows = samples(spark, sf_dir).withColumn("split", split_of("event_id"))
    counts = rows.groupBy("split", "label").agg(F.count("*").alias("n"))
    return counts.withColumn("any_rows", F.col("n") > 0)


@query(f"""
SELECT split, count(*) AS n FROM (SELECT {SQL_SPLIT} AS split FROM events) GROUP BY 1
""")
def union_chunks(spark, sf_dir):
    rows = samples(spark, sf_dir)
    parts = {
        name: rows.where(split_of("event_id") == name) for name in ("train", "validation", "test")
    }
    return A.totals(sets.all_splits(**parts), "split")


@query(f"""
SELECT label, n, round(n / sum(n) OVER (), 6) AS share
FROM (SELECT label, count(*) AS n FROM ({SQL_KEPT}) GROUP BY 1)
""")
def class_share(spark, sf_dir):
    shares = A.class_share(kept(spark, sf_dir))
    return shares.withColumn("share", F.round("share", 6))


@query(f"""
SELECT label, n, round(sum(n) OVER () / (count(*) OVER () * n), 6) AS weight
FROM (SELECT label, count(*) AS n FROM ({SQL_KEPT}) GROUP BY 1)
""")
def class_weights(spark, sf_dir):
    weights = A.class_weights(kept(spark, sf_dir))
    return weights.withColumn("weight", F.round("weight", 6))


@query(f"""
SELECT event_id, label, CAST({SQL_INDEX} AS INTEGER) AS class_idx, label AS decoded FROM ({SQL_KEPT})
""")
def label_encode(spark, sf_dir):
    encoded = joins.encode_label(kept(spark, sf_dir), CLASSES)
    return encoded.withColumn("decoded", L.label_of("class_idx", CLASSES))


@query(f"""
SELECT event_type AS label, count(*) AS n FROM events
WHERE event_type NOT IN ({SQL_LIST}) GROUP BY 1
""")
def unknown_labels(spark, sf_dir):
    return joins.unknown_labels(samples(spark, sf_dir), joins.class_list(spark, CLASSES))


@query("""
SELECT vec_id, CAST(class_idx AS INTEGER) AS class_idx, CAST(label = class_idx AS INTEGER) AS v
FROM embeddings, range(5) AS r(class_idx) WHERE label < 5
""")
def one_hot(spark, sf_dir):
    rows = filters.keep_classes(table(spark, sf_dir, "embeddings").select("vec_id", "label"), INT_CLASSES)
    target = L.one_hot("label", len(INT_CLASSES))
    cells = rows.select("vec_id", F.posexplode(target).alias("class_idx", "v"))
    return cells.withColumn("v", F.col("v").cast("int"))


@query(f"""
SELECT printf('coco_%06d.jpg', doc_id) AS name,
       CASE WHEN doc_id % 10 <= 7 THEN 'train' WHEN doc_id % 10 = 8 THEN 'validation' ELSE 'test' END AS split,
       CAST(quality AS VARCHAR) AS label, CAST(strlen(text) AS INTEGER) AS n_bytes
FROM documents JOIN labels USING (doc_id)
""")
def raw_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    sources = docs.join(table(spark, sf_dir, "labels"), "doc_id").select(
        L.canonical_name("doc_id").alias("name"),
        split_of("doc_id").alias("split"),
        F.col("text").cast("binary").alias("content"),
        F.col("quality").cast("string").alias("label"),
    )
    path = fresh_path(spark, "raw")
    tables.write_raw(sources, path)
    stored = tables.read_table(spark, path)
    return stored.select("name", "split", "label", F.length("content").alias("n_bytes"))
