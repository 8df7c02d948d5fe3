"""Queries that fit, score and evaluate classifiers on the embeddings."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from pixelweave.functions import labels as L, tensors as T
from pixelweave.learning import minibatch, scoring, training
from pixelweave.operators import aggregates as A, filters
from pixelweave.plans.bindings import CLASSES, INT_CLASSES, SQL_INDEX, SQL_KEPT, kept, table
from pixelweave.plans.registry import query
from pixelweave.workspace import fresh_path

_K = len(INT_CLASSES)

# Class means over all listed rows outside the validation split, and the probabilities
# they give every row.
SQL_SCORES = f"""
  WITH cells AS (
    SELECT vec_id, label, CAST(d AS INTEGER) AS d, CAST(embedding[d + 1] AS DOUBLE) AS x
    FROM embeddings, range(64) AS r(d)
  ),
  means AS (
    SELECT label AS class_idx, d, avg(x) AS m FROM cells
    WHERE label < {_K} AND vec_id % 10 <> 8 GROUP BY 1, 2
  ),
  logits AS (
    SELECT vec_id, cells.label, class_idx, exp(sum(x * m)) AS e
    FROM cells JOIN means USING (d) GROUP BY 1, 2, 3
  )
  SELECT vec_id, label, class_idx, e / sum(e) OVER (PARTITION BY vec_id) AS p FROM logits
"""


def vectors(spark, sf_dir):
    """All 64 values of every embedding."""
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").alias("features"))


def training_rows(spark, sf_dir):
    """Rows outside the validation split."""
    return vectors(spark, sf_dir).where(F.col("vec_id") % 10 != 8)


def mean_model(spark, sf_dir):
    """Mean vector per class, as the weights of a linear model."""
    return scoring.class_means(training_rows(spark, sf_dir), "features", INT_CLASSES)


def probability_rows(scored):
    """One row per row and class, rounded to 4 digits."""
    cells = scored.select("vec_id", F.posexplode("probs").alias("class_idx", "p"))
    return cells.withColumn("p", F.round("p", 4))


@query(f"SELECT vec_id, class_idx, round(p, 4) AS p FROM ({SQL_SCORES})")
def batch_scoring(spark, sf_dir):
    model = mean_model(spark, sf_dir)
    return probability_rows(scoring.score(vectors(spark, sf_dir), model))


@query(f"""
WITH scores AS ({SQL_SCORES}),
per_row AS (
  SELECT vec_id, label, arg_max(class_idx, p) AS predicted,
         max(p) FILTER (class_idx = label) AS p_true
  FROM scores WHERE label < {_K} AND vec_id % 10 = 8 GROUP BY 1, 2
)
SELECT round(avg(-ln(least(greatest(p_true, 1e-7), 1 - 1e-7))), 4) AS loss,
       round(avg(CAST(predicted = label AS DOUBLE)), 4) AS accuracy
FROM per_row
""")
def evaluate(spark, sf_dir):
    held_out = filters.keep_classes(vectors(spark, sf_dir).where(F.col("vec_id") % 10 == 8), INT_CLASSES)
    encoded = held_out.withColumn("label_idx", L.label_index("label", INT_CLASSES))
    result = scoring.evaluate(encoded, mean_model(spark, sf_dir))
    return result.select(F.round("loss", 4).alias("loss"), F.round("accuracy", 4).alias("accuracy"))


def _ready(rows):
    listed = filters.keep_classes(rows, INT_CLASSES)
    indexed = listed.withColumn("label_idx", L.label_index("label", INT_CLASSES).cast("double"))
    return training.with_features(indexed, "features")


@query(f"""
SELECT event_id, label, CAST({SQL_INDEX} AS INTEGER) AS label_idx, label AS decoded FROM ({SQL_KEPT})
""")
def label_indexer(spark, sf_dir):
    """Encoder and decoder stages, saved and loaded as one model."""
    stages = [training.label_encoder(CLASSES), training.label_decoder(CLASSES, output="decoded")]
    path = fresh_path(spark, "model")
    training.save_model(PipelineModel(stages), path)
    coded = training.load_model(path).transform(kept(spark, sf_dir))
    return coded.withColumn("label_idx", F.col("label_idx").cast("int"))


# What SQL can know of a fit: how many rows it scores, its classes, and that four statements
# on it hold.
_SQL_FIT = f"""
SELECT count(*) FILTER (vec_id % 10 = 8) AS n_scored, count(DISTINCT label) FILTER (vec_id % 10 <> 8) AS n_classes,
       true AS sums_to_one, true AS reloaded_same, true AS better_than_first, true AS better_than_guess
FROM embeddings WHERE label < {_K}
"""


def _checked(spark, sf_dir, rows, model, first_loss, last_loss):
    path = fresh_path(spark, "model")
    training.save_model(model, path)
    held_out = _ready(vectors(spark, sf_dir).where(F.col("vec_id") % 10 == 8))
    scored = scoring.score(held_out, model).select("vec_id", "probs")
    again = scoring.score(held_out, training.load_model(path)).select("vec_id", F.col("probs").alias("reloaded"))
    both = scored.join(again, "vec_id")
    total = F.aggregate("probs", F.lit(0.0), lambda s, x: s + x)
    fitted = scoring.evaluate(rows, model).first()
    return both.agg(
        F.count("*").alias("n_scored"),
        F.max(F.size("probs")).cast("bigint").alias("n_classes"),
        F.every(F.abs(total - 1) < 1e-9).alias("sums_to_one"),
        F.every(F.col("probs") == F.col("reloaded")).alias("reloaded_same"),
        F.lit(bool(last_loss < first_loss)).alias("better_than_first"),
        F.lit(bool(fitted["accuracy"] > 1.2 / _K)).alias("better_than_guess"),
    )


def _history(spark, model, rows):
    history = training.training_history(model, rows)
    first = history.where("epoch = 0").first()["loss"]
    return first, A.last_epoch_metric(history, "loss").first()["loss"]


@query(_SQL_FIT)
def fit_classifier(spark, sf_dir):
    """Fit, save, load and score."""
    rows = _ready(training_rows(spark, sf_dir))
    model = training.fit_classifier(rows, epochs=10)
    return _checked(spark, sf_dir, rows, model, *_history(spark, model, rows))


@query(_SQL_FIT)
def fit_perceptron(spark, sf_dir):
    """The same with one hidden layer."""
    rows = _ready(training_rows(spark, sf_dir))
    model = training.fit_classifier(rows, layers=(64, 32, _K), epochs=10, seed=7)
    return _checked(spark, sf_dir, rows, model, *_history(spark, model, rows))


@query(_SQL_FIT)
def fit_weighted(spark, sf_dir):
    """The same with rows weighted so that classes count the same."""
    rows = training.with_class_weights(_ready(training_rows(spark, sf_dir)))
    model = training.fit_classifier(rows, epochs=10, weightCol="weight")
    return _checked(spark, sf_dir, rows, model, *_history(spark, model, rows))


_STEPS = 4
_CANDIDATES = (
    minibatch.Candidate(0.01), minibatch.Candidate(0.001), minibatch.Candidate(0.05, 0.01), minibatch.Candidate(0.02, 1.0)
)


def _sql_history(candidates, epochs: int) -> str:
    """CTEs of a fit with Adam: a table of weights and moments after every step, four steps an
    epoch, and ``history`` as the fit reports it. The intercept is value 64."""
    pick = lambda of: "CASE c " + " ".join(f"WHEN {i} THEN {of(x)}" for i, x in enumerate(candidates)) + " END"
    rate, penalty = pick(lambda x: f"{x.learning_rate!r}::DOUBLE"), pick(lambda x: f"{x.penalty!r}::DOUBLE")

    def answers(name: str, rows: str, weights: str, where: str = "true") -> str:
        return f"""
{name}z AS MATERIALIZED (
  SELECT vec_id, y, c, k, sum(w * x) AS z FROM {rows} JOIN {weights} USING (d) WHERE {where} GROUP BY ALL),
{name} AS MATERIALIZED (
  SELECT *, e / sum(e) OVER (PARTITION BY vec_id, c) AS p,
    row_number() OVER (PARTITION BY vec_id, c ORDER BY z DESC, k) = 1 AS top
  FROM (SELECT *, exp(z - max(z) OVER (PARTITION BY vec_id, c)) AS e FROM {name}z)),"""

    metrics = """SELECT c, {epoch} AS epoch, avg(-ln(least(greatest(p, 1e-7), 1 - 1e-7))) AS loss,
    avg(CASE WHEN top THEN 1.0::DOUBLE ELSE 0 END) AS accuracy FROM ({rows}) WHERE k = y GROUP BY c"""
    text = f"""
WITH base AS (
  SELECT vec_id, label AS y, embedding, vec_id % 10 = 8 AS held,
    row_number() OVER (PARTITION BY vec_id % 10 = 8 ORDER BY vec_id) - 1 AS pos,
    (count(*) OVER (PARTITION BY vec_id % 10 = 8) + {_STEPS - 1}) // {_STEPS} AS size
  FROM embeddings WHERE label < {_K}),
cells AS MATERIALIZED (
  SELECT vec_id, y, held, pos // size AS step, CAST(d AS INTEGER) AS d,
    CASE WHEN d < 64 THEN CAST(embedding[d + 1] AS DOUBLE) ELSE 1 END AS x
  FROM base, range(65) AS r(d)),
learned AS MATERIALIZED (SELECT * FROM cells WHERE NOT held),
checked AS MATERIALIZED (SELECT * FROM cells WHERE held),
w0 AS MATERIALIZED (
  SELECT CAST(c AS INTEGER) AS c, CAST(k AS INTEGER) AS k, CAST(d AS INTEGER) AS d, 0::DOUBLE AS w, 0::DOUBLE AS m, 0::DOUBLE AS v
  FROM range({len(candidates)}) AS a(c), range({_K}) AS b(k), range(65) AS e(d)),"""
    for t in range(epochs * _STEPS):
        text += answers(f"p{t}", "learned", f"w{t}", f"step = {t % _STEPS}") + f"""
g{t} AS (
  SELECT c, k, d, sum((p - CASE WHEN k = y THEN 1 ELSE 0 END) * x) / count(*) AS g
  FROM p{t} JOIN learned USING (vec_id, y) GROUP BY ALL),
w{t + 1} AS MATERIALIZED (
  SELECT c, k, d, w - {rate} * (m / (1 - 0.9::DOUBLE ** {t + 1})) / (sqrt(v / (1 - 0.999::DOUBLE ** {t + 1})) + 1e-7) AS w, m, v
  FROM (
    SELECT c, k, d, w, 0.9::DOUBLE * m + 0.1::DOUBLE * h AS m, 0.999::DOUBLE * v + 0.001::DOUBLE * h * h AS v
    FROM (SELECT *, g + CASE WHEN d < 64 THEN {penalty} * w ELSE 0 END AS h FROM w{t} JOIN g{t} USING (c, k, d)))),"""
    seen, held = [], []
    for epoch in range(1, epochs + 1):
        steps = range((epoch - 1) * _STEPS, epoch * _STEPS)
        seen.append(metrics.format(epoch=epoch, rows=" UNION ALL ".join(f"SELECT * FROM p{t}" for t in steps)))
        text += answers(f"q{epoch}", "checked", f"w{epoch * _STEPS}")
        held.append(metrics.format(epoch=epoch, rows=f"SELECT * FROM q{epoch}"))
    return text + f"""
history AS MATERIALIZED (
  SELECT a.c AS candidate, CAST(a.epoch AS INTEGER) AS epoch, a.loss, a.accuracy, b.loss AS val_loss, b.accuracy AS val_accuracy
  FROM ({" UNION ALL ".join(seen)}) a JOIN ({" UNION ALL ".join(held)}) b USING (c, epoch))"""


def _minibatches(spark, sf_dir, held_out):
    """Rows inside or outside the validation split, in four minibatches."""
    held = F.col("vec_id") % 10 == 8
    listed = filters.keep_classes(vectors(spark, sf_dir).where(held if held_out else ~held), INT_CLASSES)
    rows = listed.select("vec_id", T.to_bytes("features").alias("tensor"), L.label_index("label", INT_CLASSES).alias("label_idx"))
    return minibatch.minibatches(rows, "vec_id", max(1, -(-rows.count() // _STEPS)))


def _searched(spark, sf_dir, **settings):
    learned, held = _minibatches(spark, sf_dir, False), _minibatches(spark, sf_dir, True)
    return minibatch.fit(learned, _K, _CANDIDATES, epochs=2, validation=held, **settings)


_METRICS = ("loss", "accuracy", "val_loss", "val_accuracy")


@query(_sql_history(_CANDIDATES, 2) + f"""
SELECT candidate, epoch, {", ".join(f"round({m}, 4) AS {m}" for m in _METRICS)} FROM history
""")
def epoch_metrics(spark, sf_dir):
    """Loss and accuracy of every candidate after each epoch, of one fit with minibatches."""
    found = minibatch.history(spark, _searched(spark, sf_dir))
    return found.select("candidate", "epoch", *[F.round(m, 4).alias(m) for m in _METRICS])


@query(_sql_history(_CANDIDATES, 2) + f""",
scored AS (
  SELECT *, val_accuracy - 0.4::DOUBLE / (SELECT count(*) FROM base WHERE held) * val_loss / (1 - ln(1e-7)) AS score
  FROM history),
going_on AS (
  SELECT candidate FROM scored WHERE epoch = 1 ORDER BY score DESC, candidate LIMIT {len(_CANDIDATES) - len(_CANDIDATES) // 2}),
run AS (SELECT * FROM scored WHERE epoch = 1 OR candidate IN (SELECT candidate FROM going_on)),
best AS (
  SELECT candidate, max(epoch) AS epochs, arg_max(epoch, score) AS best_epoch, max(score) AS score FROM run GROUP BY 1)
SELECT candidate, epochs, best_epoch, round(score, 4) AS score,
  row_number() OVER (ORDER BY score DESC, candidate) = 1 AS is_best
FROM best
""")
def search_halving(spark, sf_dir):
    """A search that fits all candidates in the same passes and drops the worse half after one epoch."""
    state = _searched(spark, sf_dir, halve_after=(1,))
    run = minibatch.history(spark, state).groupBy("candidate").agg(F.max("epoch").alias("epochs"))
    rows = [(i, int(e), float(s), i == state.winner()) for i, (e, s) in enumerate(zip(state.best_epoch, state.best_score))]
    best = spark.createDataFrame(rows, "candidate int, best_epoch int, score double, is_best boolean")
    return run.join(best, "candidate").withColumn("score", F.round("score", 4))


@query("""
SELECT CAST(3 AS BIGINT) AS n_candidates, true AS best_is_largest, true AS model_is_best
FROM embeddings LIMIT 1
""")
def grid_search(spark, sf_dir):
    """Best regularisation by validation accuracy, and the model that reached it."""
    rows = _ready(training_rows(spark, sf_dir))
    grid = {"regParam": [0.0, 0.01, 0.1], "elasticNetParam": [0.0]}
    found, model = training.grid_search(rows, grid, "vec_id", epochs=5)
    best = A.best_candidate(found, "candidate", "accuracy").first()
    params = found.where(F.col("candidate") == best["candidate"]).first()["params"]
    reg = model.stages[-1].getOrDefault("regParam")
    return found.agg(
        F.count("*").alias("n_candidates"),
        (F.max("accuracy") == best["accuracy"]).alias("best_is_largest"),
        F.lit(f"regParam={reg}" in params).alias("model_is_best"),
    )


@query("""
WITH scores AS (SELECT event_type AS label, round(avg(value), 6) AS score FROM events GROUP BY 1)
SELECT label, score FROM scores ORDER BY score DESC, label LIMIT 1
""")
def best_candidate(spark, sf_dir):
    rows = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("label"))
    return A.best_candidate(rows.agg(F.round(F.avg("value"), 6).alias("score")), "label", "score")


@query("""
WITH history AS (
  SELECT CAST(ts AS DATE) AS epoch, round(avg(value), 6) AS score FROM events GROUP BY 1
)
SELECT arg_max(score, epoch) AS score FROM history
""")
def last_epoch_metric(spark, sf_dir):
    rows = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("epoch"))
    return A.last_epoch_metric(rows.agg(F.round(F.avg("value"), 6).alias("score")), "score")
