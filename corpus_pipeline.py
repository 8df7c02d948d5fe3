"""A training corpus from raw documents: five stages, each one call of an operator.

A stage takes (spark, docs, sf_dir) and returns what it keeps of ``docs`` with the columns of
``documents``; the last returns the packed pieces. ``run`` writes every stage's rows as
Parquet under the shared folder and reads them back for the next stage; the working tables of
a stage are deleted once its rows are written.

Defined cases: empty tables stay empty; null texts fail the quality rules; rows without a key
cannot be told apart, so the near-duplicate stage keeps them all; rows that repeat a key are
documents of their own there unless their texts are near-duplicates; extra columns, whatever their
names, pass unchanged through all stages but the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pixelweave.llm import language, mixing, packing, rules, simhash
from pixelweave.llm.registered import TARGETS, leaves_of
from pixelweave.workspace import fresh_path, materialize, scope

# Least confidence of the language stage: labelled documents that pass the quality rules and are
# held out from the fit score above it, letter gibberish and foreign texts below (tests compare).
# Share of the tokens and seed of the mixing stage.
LEAST_SURE = 0.2
SHARE, SEED = (8, 10), 7
# Words that the packing stage keeps encoded: workers live through all stages and hold them.
CACHED = 200_000


def _packed(docs: DataFrame, *columns) -> DataFrame:
    """Whole rows as column ``_row`` beside the columns that an operator reads, so that columns
    which an operator adds or replaces never meet the rows' own."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base check and are probably good by the rules' votes."""
    return rules.judge(_packed(docs, "text")).where("kept").select("_row.*")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language, told with confidence ``LEAST_SURE``: without letter
    gibberish, other languages and texts that are as much in one language as in another."""
    found = language.identify(_packed(docs, "text"), language.learn(docs))
    sure = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SURE)
    return found.where(sure).select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near-duplicates one row, with the smallest key and, where rows of the
    group repeat that key, the smallest hash of its text."""
    marked = _packed(docs, "doc_id", "text", F.xxhash64("text").alias("_mark"))
    found = simhash.near_duplicates(marked.select("doc_id", "text", "_mark"), shingle=4, budget=4, carry=("_mark",))
    rows = found.where("doc_id = component_id").groupBy("label", "doc_id", "_mark").agg(F.count("*").alias("n"))
    first = rows.groupBy("label").agg(F.min(F.struct("doc_id", "_mark", "n")).alias("row"))
    kept = materialize(first.select("row.*"), "kept")
    # Only rows that are there more than once have to meet.
    by = ["doc_id", "_mark"]
    once = marked.join(kept.where("n = 1"), by, "left_semi")
    many = marked.join(kept.where("n > 1"), by, "left_semi").dropDuplicates(by)
    return once.unionByName(many).select("_row.*").union(docs.where("doc_id is null"))


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, whole, that the target weights take in one pass."""
    part, of = SHARE
    taken = mixing.mix(leaves_of(docs), TARGETS, F.sum("held") * part / of, max_epochs=1, seed=SEED)
    ids = taken.select(F.col("doc_id").alias("taken_id")).distinct()
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["taken_id"]), "left_semi")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2,048 tokens."""
    cut = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"), cached=CACHED)
    return packing.pack(cut)[0]


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("simhash_near_duplicates", near_duplicates),
    ("mixing_to_targets", mixing_to_targets),
    ("best_fit_packing", best_fit_packing),
]

# Estimation, machines and fingerprints have no SQL; tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        with scope():
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


def queries():
    return {"pipeline": run}


def oracle_sql():
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
