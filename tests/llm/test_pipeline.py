"""Every stage of the pipeline against a brute-force version on small tables."""

import numpy as np
import pytest
from conftest import MEDIUM, SMALL
from test_packing import check_layout
from test_simhash import slow_components, slow_fingerprint

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from pixelweave.llm import language, rules

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
FOREIGN = (
    "litwo ojczyzno moja ty jesteś jak zdrowie ile cię trzeba cenić ten tylko się dowie kto cię stracił ",
    "mieleni minun tekevi aivoni ajattelevi lähteäni laulamahan saa ani sanelemahan sukuvirttä suoltamahan ",
    "мой дядя самых честных правил когда не в шутку занемог он уважать себя заставил и лучше выдумать не мог ",
)


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The rows after each stage."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = [docs]
    for name, stage in pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, found[-1], SMALL).write.parquet(path)
        found.append(spark.read.parquet(path))
    return found


def test_columns(steps):
    assert all(step.columns == steps[0].columns for step in steps[:-1])


def test_quality_stage(steps):
    before, after = ({r["doc_id"]: r["text"] for r in s.collect()} for s in steps[:2])
    described = {i: dict(zip(rules._FEATURES, rules.describe(t))) for i, t in before.items()}
    failed = {i for i, f in described.items() if f["n_words"] < 50 or 100 * f["n_repeat_words"] > 50 * f["n_words"]}
    assert set(after) <= set(before) - failed
    assert len(after) >= 0.7 * (len(before) - len(failed))


def test_language_stage(steps):
    before, after = ({r["doc_id"]: r["text"] for r in s.collect()} for s in steps[1:3])
    model = language.learn(steps[1])
    want = {i for i, t in before.items() if model.predict(t)[0] != "und" and model.predict(t)[1] >= 0.2}
    assert set(after) == want


def test_near_duplicate_stage(steps):
    before = [(r["doc_id"], r["text"]) for r in steps[2].collect()]
    ids = [i for i, _ in before]
    components = slow_components(ids, [slow_fingerprint(t) for _, t in before], 4)
    assert sorted(r["doc_id"] for r in steps[3].collect()) == sorted(set(components))
    assert len(set(components)) < len(ids)


def test_mixing_stage(steps):
    before, after = ({r["doc_id"]: len(r["text"].split()) for r in s.collect()} for s in steps[3:5])
    assert set(after) < set(before)
    budget, largest = 8 * sum(before.values()) // 10, max(before.values())
    leaves = steps[3].select("lang", "source").distinct().count()
    assert budget <= sum(after.values()) <= budget + leaves * largest


def test_packing_stage(steps):
    frame = steps[5].toPandas()
    check_layout(frame, 2048)
    assert set(frame["doc_id"]) == {r["doc_id"] for r in steps[4].collect()}
    for _, rows in frame.sort_values("piece").groupby("doc_id"):
        assert list(rows["start"]) == [0, *np.cumsum(rows["length"])[:-1]]


def test_run(spark, steps):
    got = sorted(tuple(r) for r in pipeline.run(spark, SMALL).select("doc_id", "piece", "length", "ids_crc32").collect())
    assert got == sorted(tuple(r) for r in steps[5].select("doc_id", "piece", "length", "ids_crc32").collect())


@pytest.mark.parametrize("rows", ["none", "odd"])
def test_edges(spark, tmp_path, rows):
    good = [" ".join(f"w{i * j % 89}x{j}" for j in range(1, 20)) + ".\n" for i in range(1, 9)]
    data = [] if rows == "none" else [
        (1, None, None, None, None), (2, "", "en", "src1", 0), (None, "".join(good), "en", None, 5),
        (3, "".join(good), "en", "src1", 9), (3, "".join(good), "en", "src1", 9),
        (4, "".join(good[::-1]), None, "src2", 9), (5, "".join(good) * 400, "en", "src3", 9),
    ]
    docs = spark.createDataFrame([(*r, "x") for r in data], SCHEMA + ", kept string")
    for i, (_, stage) in enumerate(pipeline.STAGES):
        docs = stage(spark, docs, SMALL)
        if i < 4:
            assert docs.columns == [*SCHEMA.replace(",", "").split()[::2], "kept"]
            docs.write.parquet(f"{tmp_path}/{i}")
            docs = spark.read.parquet(f"{tmp_path}/{i}")
    assert docs.count() >= (rows == "odd")


def test_clashing_columns_pass_unchanged(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = ["quality", "kept", "f", "base_failed", "score", "lang_pred", "_mark", "_row", "label", "n", "id", "fp",
             "component_id", "taken_id", "tokens", "a.b"]
    for name in names:
        docs = docs.withColumn(name, F.concat(F.lit(f"{name} of "), F.col("doc_id").cast("string")))
    for _, stage in pipeline.STAGES[:4]:
        docs = stage(spark, docs, SMALL)
    rows = docs.collect()
    assert docs.columns[5:] == names and len(rows) > 20
    assert all(row[name] == f"{name} of {row['doc_id']}" for row in rows for name in names)


def test_language_stage_rejects(spark):
    """Letter gibberish, foreign texts and texts in two languages go; clean held-out texts stay."""
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    clean = [r for r in rules.judge(docs).where("kept").select(*docs.columns).orderBy("doc_id").collect() if r["lang"]]
    fit_on, held = clean[: 3 * len(clean) // 4], clean[3 * len(clean) // 4 :]
    assert len(held) > 150
    rng = np.random.default_rng(5)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    planted = [" ".join("".join(rng.choice(letters, rng.integers(2, 10))) for _ in range(n)) for n in (60, 300, 2000)]
    planted += [text * 4 for text in FOREIGN]
    # As many letters in one language as in another.
    part = {lang: next(r["text"] for r in fit_on if r["lang"] == lang and len(r["text"]) > 900)[:900] for lang in ("de", "en", "fr", "es")}
    planted += [f"{part[a]} {part[b]}" for a, b in (("de", "fr"), ("en", "es"), ("de", "en"))]
    rows = [tuple(r) for r in fit_on]
    rows += [(*r[:2], None, *r[3:]) for r in map(tuple, held)]
    rows += [(-1 - i, text, None, "src1", len(text)) for i, text in enumerate(planted)]
    after = pipeline.language_id(spark, spark.createDataFrame(rows, SCHEMA), MEDIUM)
    ids = {r["doc_id"] for r in after.select("doc_id").collect()}
    assert not ids & {-1 - i for i in range(len(planted))}
    assert len(ids & {r["doc_id"] for r in held}) >= 0.99 * len(held)


def test_language_stage_rejects_with_one_language(spark):
    """Without rivals a text must still be like the language."""
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").where("lang = 'en' and doc_id % 4 < 3")
    kept = rules.judge(docs).where("kept").select(*docs.columns)
    planted = spark.createDataFrame([(-1 - i, t * 4, None, "src1", 9) for i, t in enumerate(FOREIGN)], SCHEMA)
    after = pipeline.language_id(spark, kept.unionByName(planted), MEDIUM)
    ids = {r["doc_id"] for r in after.select("doc_id").collect()}
    assert min(ids) >= 0 and len(ids) >= 0.99 * kept.count()


def test_near_duplicate_stage_repeated_keys(spark):
    """Different texts under one key are decided on each by itself."""
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{j}" for j in rng.integers(0, 5000, 400)) for _ in range(4)]
    a, b, c, d = texts
    rows = [(1, a), (1, b), (2, c), (2, c), (3, c + " more"), (3, d), (4, "x" + a), (None, c)]
    docs = spark.createDataFrame([(i, t, "en", "src1", 9) for i, t in rows], SCHEMA)
    for some in (docs, docs.where("doc_id <> 2 or doc_id is null")):
        got = sorted((r["doc_id"], texts.index(r["text"])) for r in
                     pipeline.near_duplicates(spark, some.where("doc_id is not null"), SMALL).where("text not like '% more'").collect())
        assert got == [(1, 0), (1, 1), *([(2, 2)] if some is docs else []), (3, 3)]
    after = pipeline.near_duplicates(spark, docs, SMALL)
    assert after.columns == docs.columns and after.where("doc_id is null").count() == 1
    assert after.where("doc_id = 3").count() == 1
