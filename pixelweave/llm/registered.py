"""Registered queries of the language-data operators, with the SQL that checks them.

Each query applies its operator with production parameters to the whole table and derives
the columns it returns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pixelweave.llm import alignment, audit, backoff, extraction, grammar, inner_product, language, mixing, packing, quality, rules, simhash, warc
from pixelweave.llm.text import fold
from pixelweave.workspace import fresh_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 5) == 0
    labels = table(spark, sf_dir, "labels").where(~held_out)
    field = quality.learn(docs, labels)
    found = docs.select(
        "doc_id", held_out.alias("held_out"), quality.scored(field, F.col("text")).alias("score")
    )
    return found.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op2_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write(table(spark, sf_dir, "pages"), fresh_path(spark, "warc"))
    return warc.read(index, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP2_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_id FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM f
"""


def op3_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = backoff.score(table(spark, sf_dir, "documents"))
    return found.withColumn("score", F.round("score", 6))


OP3_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents
), w AS (
  SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d
), p AS (
  SELECT *, lag(w) OVER (PARTITION BY doc_id ORDER BY i) AS v FROM w
), one AS (SELECT w, count(*) AS c FROM w GROUP BY w),
two AS (SELECT v, w, count(*) AS c FROM p WHERE v IS NOT NULL GROUP BY v, w),
own_one AS (SELECT doc_id, w, count(*) AS c FROM w GROUP BY doc_id, w),
own_two AS (SELECT doc_id, v, w, count(*) AS c FROM p WHERE v IS NOT NULL GROUP BY doc_id, v, w),
size AS (SELECT count(*) AS n FROM w),
own_size AS (SELECT doc_id, count(*) AS n FROM w GROUP BY doc_id),
x AS (
  SELECT p.doc_id, p.v, one.c - own_one.c AS c_word, two.c - own_two.c AS c_pair, first.c - own_first.c AS c_first,
    greatest(size.n - own_size.n, 1) AS others
  FROM p CROSS JOIN size JOIN own_size USING (doc_id)
  JOIN one ON one.w = p.w JOIN own_one ON own_one.doc_id = p.doc_id AND own_one.w = p.w
  LEFT JOIN two ON two.v = p.v AND two.w = p.w
  LEFT JOIN own_two ON own_two.doc_id = p.doc_id AND own_two.v = p.v AND own_two.w = p.w
  LEFT JOIN one AS first ON first.w = p.v
  LEFT JOIN own_one AS own_first ON own_first.doc_id = p.doc_id AND own_first.w = p.v
), s AS (
  SELECT doc_id, count(*) AS n_words, avg(CASE
    WHEN v IS NULL THEN ln(greatest(c_word, 0.5::DOUBLE) / others)
    WHEN c_pair > 0 THEN ln(c_pair::DOUBLE / c_first)
    ELSE ln(0.4::DOUBLE * greatest(c_word, 0.5::DOUBLE) / others) END) AS score
  FROM x GROUP BY doc_id
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, round(score, 6) AS score FROM d LEFT JOIN s USING (doc_id)
"""


def tokenizer_path() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf_dir, "documents"), tokenizer_path())
    return packing.pack(cut)[0]


def op5_repair_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return grammar.read(grammar.write(docs, tokenizer_path(), grammar.corpus_folder(docs)))


def op6_norm_sorted_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return inner_product.top_k(vectors, F.col("vec_id") % 50 == 0, k=5, scale=256)


OP6_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q, v c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


# Production parameters of the mix: domains by the number in a source's name, target weights,
# six tenths of the corpus, at most two passes.
DOMAINS = ("web", "books", "code", "news")
TARGETS = mixing.Targets(
    domain={"web": 4, "books": 3, "code": 2, "news": 1},
    lang={"en": 5, "de": 2, "fr": 2, "es": 1},
)


def leaves_of(docs: DataFrame) -> DataFrame:
    """Key, tree levels and word count of documents."""
    number = F.regexp_extract("source", r"(\d{1,9})", 1)
    domain = F.when(
        number != "", F.get(F.array(*map(F.lit, DOMAINS)), number.cast("long").cast("int") % len(DOMAINS))
    ).otherwise("other")
    return docs.select(
        "doc_id",
        F.coalesce(domain, F.lit("other")).alias("domain"),
        "lang",
        "source",
        F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).alias("tokens"),
    )


def op7_mixing_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaves = leaves_of(table(spark, sf_dir, "documents"))
    return mixing.mix(leaves, TARGETS, F.sum("held") * 6 / 10, max_epochs=2, seed=7)


def _case(column: str, weights: dict[str, int]) -> str:
    if not weights:
        return "1"
    whens = " ".join(f"WHEN '{name}' THEN {weight}" for name, weight in weights.items())
    return f"CASE {column} {whens} ELSE 1 END"


def _level_sql(i: int) -> str:
    """Shares of level ``i`` of the tree from those of the level above."""
    name, parents = mixing.LEVELS[i], mixing.LEVELS[:i]
    family = "PARTITION BY " + (", ".join(parents) or "0")
    by_ratio = f"{family} ORDER BY CAST(holds AS DOUBLE) / CAST(weight AS DOUBLE), {name}"
    nodes = ", ".join([*parents, name])
    joined = f"JOIN s{i - 1} USING ({', '.join(parents)})" if parents else "CROSS JOIN root"
    return f"""
n{i} AS (SELECT {nodes}, any_value(w_{name}) AS weight, sum(holds) AS holds FROM weighed GROUP BY {nodes}),
f{i} AS (SELECT {nodes}, weight, holds, least(share, sum(holds) OVER ({family})) AS budget FROM n{i} {joined}),
r{i} AS (SELECT *,
  coalesce(sum(holds) OVER ({by_ratio} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS given,
  sum(weight) OVER ({by_ratio} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS heavy FROM f{i}),
u{i} AS (SELECT *, holds * heavy <= weight * (budget - given) AS is_full FROM r{i}),
o{i} AS (SELECT *,
  budget - coalesce(sum(CASE WHEN is_full THEN holds END) OVER ({family}), 0) AS remains,
  coalesce(sum(CASE WHEN NOT is_full THEN weight END)
    OVER ({family} ORDER BY {name} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS upto,
  sum(CASE WHEN NOT is_full THEN weight END) OVER ({family}) AS total FROM u{i}),
s{i} AS (SELECT {nodes}, CASE WHEN is_full THEN holds
  ELSE remains * upto // total - remains * (upto - weight) // total END AS share FROM o{i}),"""


def _mix_sql(seed: int, max_epochs: int) -> str:
    domains = ", ".join(f"'{d}'" for d in DOMAINS)
    return f"""
WITH named AS (
  SELECT doc_id, regexp_extract(coalesce(source, ''), '(\\d{{1,9}})', 1) AS number,
    coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS tokens FROM documents),
docs AS (
  SELECT doc_id, CASE WHEN number = '' THEN 'other'
    ELSE ([{domains}])[CAST(number AS BIGINT) % {len(DOMAINS)} + 1] END AS domain, lang, source, tokens FROM named),
leaves AS (SELECT domain, lang, source, sum(tokens) AS held FROM docs GROUP BY ALL),
weighed AS (
  SELECT *, held * {max_epochs} AS holds, {_case("domain", TARGETS.domain)} AS w_domain,
    {_case("lang", TARGETS.lang)} AS w_lang, {_case("source", TARGETS.source)} AS w_source
  FROM leaves WHERE held > 0),
root AS (SELECT CAST(floor(sum(held) * 6 / 10) AS HUGEINT) AS share FROM leaves),
{"".join(map(_level_sql, range(3)))}
plan AS (
  SELECT domain, lang, source, share // held AS whole, share - share // held * held AS rest
  FROM s2 JOIN weighed USING (domain, lang, source)),
placed AS (
  SELECT *, md5('{seed}:' || CAST(whole AS VARCHAR) || ':' || CAST(doc_id AS VARCHAR)) AS place
  FROM docs JOIN plan USING (domain, lang, source)),
run AS (
  SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, doc_id, tokens
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - tokens AS start FROM placed)
SELECT doc_id, domain, lang, source, CAST(unnest(range(CAST(whole AS BIGINT))) AS BIGINT) AS epoch,
  CAST(tokens AS BIGINT) AS tokens, CAST(tokens AS BIGINT) AS taken FROM placed
UNION ALL
SELECT doc_id, domain, lang, source, CAST(whole AS BIGINT), CAST(tokens AS BIGINT),
  CAST(least(tokens, rest - start) AS BIGINT) FROM run WHERE start < rest
"""


def op8_language_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = language.learn(docs.where(~held_out))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, budget=4)
    return found.select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(table(spark, sf_dir, "documents"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select(
        "doc_id", *(F.col("f")[c].alias(c) for c in counts), "base_failed", "kept", "quality"
    )


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extracted(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align(table(spark, sf_dir, "documents"), *paths)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP13_SQL = """
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM t),
f AS (
  SELECT doc_id, part, CASE WHEN len(ws) < 200 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 2 ELSE 0 END
    + CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS failed
  FROM w
), l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), sets AS (
  SELECT part, failed, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM f LEFT JOIN l USING (doc_id) GROUP BY part, failed
), x(l, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM x a JOIN x b ON b.l <> a.l JOIN x c ON c.l NOT IN (a.l, b.l) JOIN x d ON d.l NOT IN (a.l, b.l, c.l)
  JOIN x e ON e.l NOT IN (a.l, b.l, c.l, d.l)
), steps AS (
  SELECT filter_order, s.step, bits[s.step] AS own, coalesce(list_sum(bits[1:s.step - 1]), 0) AS before
  FROM orders CROSS JOIN (SELECT unnest(range(1, 6)) AS step) s
), rows AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN failed & CAST(own + before AS INT) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN failed & own > 0 AND failed & CAST(before AS INT) = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN failed & own > 0 AND failed & CAST(before AS INT) > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN failed = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN failed & own > 0 AND failed & CAST(before AS INT) = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN failed & own > 0 AND failed & CAST(before AS INT) = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM sets CROSS JOIN steps GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM rows
"""


QUERIES: dict[str, Query] = {
    "op1_line_field": op1_line_field,
    "op2_warc_dictionary": op2_warc_dictionary,
    "op3_stupid_backoff": op3_stupid_backoff,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_repair_grammar": op5_repair_grammar,
    "op6_norm_sorted_search": op6_norm_sorted_search,
    "op7_mixing_budget": op7_mixing_budget,
    "op8_language_hierarchy": op8_language_hierarchy,
    "op9_simhash_near_duplicates": op9_simhash_near_duplicates,
    "op10_quality_rules": op10_quality_rules,
    "op11_main_text": op11_main_text,
    "op12_token_alignment": op12_token_alignment,
    "op13_filter_audit": op13_filter_audit,
}

ORACLES: dict[str, str] = {
    "op2_warc_dictionary": OP2_SQL,
    "op3_stupid_backoff": OP3_SQL,
    "op6_norm_sorted_search": OP6_SQL,
    "op7_mixing_budget": _mix_sql(seed=7, max_epochs=2),
    "op13_filter_audit": OP13_SQL,
}
