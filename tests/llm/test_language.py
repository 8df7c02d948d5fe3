"""Language identification: held-out accuracy, the vote inside a family, edge cases."""

import numpy as np
import pytest
from conftest import MEDIUM
from pyspark.sql import functions as F

from pixelweave.llm import language
from pixelweave.llm.registered import op8_language_hierarchy


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    rows = op8_language_hierarchy(spark, MEDIUM).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 150
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)


def test_held_out_languages_do_not_matter(spark, tmp_path):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").limit(200)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    docs.write.parquet(f"{tmp_path}/a/documents.parquet")
    changed = docs.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    changed.write.parquet(f"{tmp_path}/b/documents.parquet")
    a, b = (sorted(map(tuple, op8_language_hierarchy(spark, f"{tmp_path}/{n}").collect())) for n in "ab")
    assert a == b


def test_families_and_pairs():
    rng = np.random.default_rng(2)
    langs = ["de", "en", "fr", "es", "it", "zz"]
    centre = {lang: rng.random(language.DIMENSIONS) for lang in langs}
    counts = np.stack([centre[lang] + 0.3 * rng.random(language.DIMENSIONS) for lang in langs for _ in range(20)])
    model = language.fit(counts, [lang for lang in langs for _ in range(20)])
    assert model.families == (("de", "en"), ("es", "fr", "it"), ("zz",))
    assert model.pairs == (("de", "en"), ("es", "fr"), ("es", "it"), ("fr", "it"))
    assert model.weights.shape == (3 + 4, language.DIMENSIONS + 1)
    weights = model.weights[:, :-1], model.weights[:, -1]
    for lang, row in zip((lang for lang in langs for _ in range(20)), counts):
        margins = weights[0] @ language._unit(row) + weights[1]
        family = model.families[int(np.argmax(margins[:3]))]
        assert lang in family


def test_separable_svm():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 10)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = np.where(x @ np.arange(10) > 0, 1, -1)
    w = language.fit_svm(x, y)
    assert (np.sign(x @ w[:-1] + w[-1]) == y).mean() > 0.95


@pytest.mark.parametrize("text", [None, "", "  \n", "123 !? 4.5", "​_", "²", "½ ¼", "Ⅷ ①", "〇 ㊀"])
def test_no_letter_is_undetermined(text):
    model = language.fit(np.eye(2, language.DIMENSIONS), ["de", "fr"])
    assert model.predict(text) == ("und", 0.0)


def slow_prediction(model, text):
    """The vote written out plainly: Unicode letters, family, then every pair of its languages."""
    import unicodedata

    if not any(unicodedata.category(c).startswith("L") for c in text or ""):
        return "und"
    data = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in (" " + text.lower() + " ").encode())
    x = np.zeros(language.DIMENSIONS)
    for i in range(len(data) - 1):
        grams = [data[i] << 8 | data[i + 1]]
        if i + 2 < len(data):
            grams.append(1 << 24 | data[i] << 16 | data[i + 1] << 8 | data[i + 2])
        for gram in grams:
            x[(gram * 2654435769 & 0xFFFFFFFF) >> 20] += 1
    x /= np.sqrt(x @ x)
    margins = [float(w[:-1].astype(float) @ x + w[-1]) for w in model.weights]
    family = model.families[int(np.argmax(margins[: len(model.families)]))]
    wins = {lang: 0 for lang in family}
    for (a, b), margin in zip(model.pairs, margins[len(model.families) :]):
        if a in wins:
            wins[a if margin >= 0 else b] += 1
    most = max(wins.values())
    return {lang for lang, n in wins.items() if n == most}


def test_whole_table_against_the_plain_vote(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    model = language.learn(docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2))
    got = language.identify(docs, model).select("text", "lang_pred").collect()
    assert len(got) == docs.count()
    for row in got:
        want = slow_prediction(model, row["text"])
        assert row["lang_pred"] in want if isinstance(want, set) else row["lang_pred"] == want


@pytest.mark.parametrize("langs", [[None] * 4, ["en"] * 4, ["en", "en", "de", None], ["en", "fr", "en", "fr"]])
def test_edges(spark, langs):
    texts = ["the cat", "a dog " * 20_000, "die katze", None]
    rows = [(i if i else None, t, lang, "x", 2) for i, (t, lang) in enumerate(zip(texts, langs))]
    docs = spark.createDataFrame(rows + rows, "doc_id long, text string, lang string, lang_pred string, score int")
    model = language.learn(docs)
    got = language.identify(docs, model).collect()
    assert len(got) == 8 and all(0 <= r["score"] <= 1 for r in got)
    learned = {lang for lang in langs[1:] if lang}
    assert {r["lang_pred"] for r in got} <= learned | {"und"}
    assert language.identify(docs.limit(0), language.learn(docs.limit(0))).collect() == []


def test_scores_can_fall_to_zero():
    """Texts that no machine prefers, or that lie far from the only language, score next to nothing."""
    rng = np.random.default_rng(4)
    centre = {lang: rng.random(language.DIMENSIONS) ** 8 for lang in ("de", "en", "fr")}
    langs = [lang for lang in centre for _ in range(20)]
    counts = np.stack([centre[lang] + 0.05 * rng.random(language.DIMENSIONS) for lang in langs])
    for of in (langs, langs[20:40]):
        own = counts if len(of) > 20 else counts[20:40]
        model = language.fit(own, of)
        assert model.predict("qxz jwv kkq " * 40)[1] < 0.1


def test_sample_is_bounded(spark, monkeypatch):
    """A key of many rows is one document of the sample, and takes one place in it."""
    rows = [(1, f"text {i}", "en" if i % 2 else "de") for i in range(400)] + [(1, "same row", "en")] * 400
    rows += [(i, f"own {i}", "en" if i % 2 else "de") for i in range(2, 42)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7)
    taught = []
    monkeypatch.setattr(language, "fit", lambda counts, langs: taught.append((counts, langs)))
    for most in (300, 300, 8):
        language.learn(docs, per_language=most)
    assert len(taught[0][0]) == len(taught[0][1]) == 41
    assert (taught[0][0] == taught[1][0]).all() and taught[0][1] == taught[1][1]
    assert taught[2][1] == ["de"] * 8 + ["en"] * 8
