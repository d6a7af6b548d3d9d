from __future__ import annotations

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from flowlab.operators import metrics
from flowlab.plans.inputs import scored

# Published confusion cells (tn, fp, fn, tp) of three models and their metrics
# (accuracy, weighted precision, weighted recall, weighted F1).
CELLS = {
    "Model A - Logistic Regression": (23161, 3480, 3106, 127601),
    "Model B - Deep Learning MLP": (24593, 2048, 610, 130097),
    "Model C - Random Forest": (26361, 280, 440, 130267),
}
PUBLISHED = {
    "Model A - Logistic Regression": (0.9581437323639321, 0.9579257738492684, 0.9581437323639321, 0.9580256927216964),
    "Model B - Deep Learning MLP": (0.9831075069273203, 0.983027949004455, 0.9831075069273203, 0.9829194402839867),
    "Model C - Random Forest": (0.9954241553753463, 0.9954386684052742, 0.9954241553753463, 0.9954296039916695),
}


@pytest.fixture(scope="module")
def cells(spark):
    places = [(0.0, 0.0), (0.0, 1.0), (1.0, 0.0), (1.0, 1.0)]
    rows = [(m, a, b, n) for m, counts in CELLS.items() for (a, b), n in zip(places, counts, strict=True)]
    return spark.createDataFrame(rows, "model string, label double, prediction double, count bigint")


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return scored(spark, sf_dir).cache()


def test_published_metrics_follow_from_the_cells(cells):
    for r in metrics.weighted_metrics(cells).collect():
        assert (r["accuracy"], r["precision"], r["recall"], r["f1"]) == pytest.approx(PUBLISHED[r["model"]], rel=1e-14)


def test_published_best_model(cells):
    long = metrics.weighted_metrics(cells).unpivot(["model"], ["accuracy", "f1"], "metric", "value")
    assert metrics.best_model(long).first()["model"] == "Model C - Random Forest"


def test_minority_recall_is_visible(cells):
    recall = {(r["model"], r["class"]): r["recall"] for r in metrics.class_metrics(cells).collect()}
    assert round(recall["Model A - Logistic Regression", 0.0], 4) == 0.8694
    assert round(recall["Model C - Random Forest", 0.0], 4) == 0.9895


def test_dense_cells_fill_absent_ones(spark):
    sparse = spark.createDataFrame([("m", 1.0, 1.0, 5)], "model string, label double, prediction double, count bigint")
    assert tuple(metrics.confusion_dense(sparse).first()) == ("m", 0, 0, 0, 5)


def test_equal_to_mllib(rows):
    one = rows.filter("model = 'Model A - Lift 150'").withColumn("number", F.col("score").cast("double"))
    mine = metrics.metrics_wide(metrics.metrics_long(one, "score")).first()
    for mllib, name in (("accuracy", "accuracy"), ("weightedPrecision", "precision"), ("weightedRecall", "recall"), ("f1", "f1")):
        assert mine[name] == pytest.approx(MulticlassClassificationEvaluator(metricName=mllib).evaluate(one), rel=1e-12)
    exact = BinaryClassificationEvaluator(rawPredictionCol="number", numBins=0)
    assert mine["auc_roc"] == pytest.approx(exact.evaluate(one), rel=1e-12)


def test_binned_area_is_close_to_the_exact_one(rows):
    exact = {r["model"]: r["auc_roc"] for r in metrics.auc_exact(rows, "score").collect()}
    for r in metrics.auc_binned(rows, "score").collect():
        assert r["auc_binned"] == pytest.approx(exact[r["model"]], abs=1e-3)


@pytest.mark.parametrize("partitions", [1, 4, 13])
def test_layout_changes_nothing(rows, partitions):
    moved = rows.repartition(partitions)
    for build in (metrics.confusion, lambda r: metrics.auc_exact(r, "score"), lambda r: metrics.roc_points(r, "score")):
        assert sorted(map(str, build(moved).collect())) == sorted(map(str, build(rows).collect()))


def test_models_together_equal_models_apart(rows):
    together = sorted(metrics.metrics_long(rows, "score").collect())
    names = sorted({r["model"] for r in together})
    apart = [x for m in names for x in metrics.metrics_long(rows.filter(F.col("model") == m), "score").collect()]
    assert sorted(apart) == together


def test_reversed_scores_give_the_complement(rows):
    area = {r[0]: r[1] for r in metrics.auc_exact(rows, "score").collect()}
    for model, other in metrics.auc_exact(rows.withColumn("score", -F.col("score")), "score").collect():
        assert area[model] + other == pytest.approx(1.0, abs=1e-12)


def test_known_area(rows):
    area = {r[0]: r[1] for r in metrics.auc_exact(rows, "score").collect()}
    assert area["Model A - Lift 150"] == 10231477 / 15869952


def test_one_class_has_no_area(spark):
    only = spark.createDataFrame([("m", 1.0, 1.0, 0.3), ("m", 1.0, 0.0, 0.1)], "model string, label double, prediction double, s double")
    assert metrics.auc_exact(only, "s").first()["auc_roc"] is None
    assert {r["fpr"] for r in metrics.roc_points(only, "s").collect()} == {None}


def test_area_of_more_rows_than_a_bigint_holds(spark, monkeypatch):
    """10^10 rows per class: the doubled area is about 10^20."""
    many = 10**10
    steps = spark.createDataFrame([("m", 0.9, many, 0), ("m", 0.5, 0, many)], "model string, score double, p bigint, n bigint")
    monkeypatch.setattr(metrics, "score_counts", lambda *_: steps)
    rows = spark.createDataFrame([("m", 1.0, 0.9)], "model string, label double, s double")
    assert metrics.auc_exact(rows, "s").first()["auc_roc"] == 1.0


def roc_by_brute_force(pairs):
    """Points after every distinct score, without the inner ones that repeat the step before the next."""
    steps = []
    for score in sorted({s for s, _ in pairs}, reverse=True):
        hits = [y for s, y in pairs if s == score]
        steps.append((score, sum(hits), len(hits) - sum(hits)))
    points, tp, fp = [(None, 0, 0)], 0, 0
    for i, (score, p, n) in enumerate(steps):
        tp, fp = tp + p, fp + n
        if i in (0, len(steps) - 1) or steps[i + 1][1:] != (p, n):
            points.append((score, tp, fp))
    return points


@pytest.mark.parametrize("distinct", [3, 40, 100000])
def test_roc_equals_brute_force(spark, distinct):
    pick = random.Random(distinct)
    pairs = [(pick.randrange(distinct) / distinct, int(pick.random() < 0.4)) for _ in range(500)]
    pairs += [(0.999, 1)] * 300  # a hot score
    rows = spark.createDataFrame([("m", float(y), 0.0, s) for s, y in pairs], "model string, label double, prediction double, s double")
    found = [(r["score"], r["tp"], r["fp"]) for r in metrics.roc_points(rows.repartition(7), "s").collect()]
    assert sorted(found, key=str) == sorted(roc_by_brute_force(pairs), key=str)
    kept = metrics.roc_points(rows, "s", drop_collinear=False).count()
    assert kept == len({s for s, _ in pairs}) + 1


def test_odd_scores_are_counted_and_not_ranked(spark):
    data = [("m", float(i % 2), 1.0, s) for i, s in enumerate([0.1, 0.9, None, float("nan"), 0.4, 0.8, float("nan")])]
    rows = spark.createDataFrame(data * 30, "model string, label double, prediction double, score double").repartition(4)
    assert [tuple(r) for r in metrics.score_coverage(rows, "score").collect()] == [("m", 210, 120, 30, 60)]
    assert metrics.auc_exact(rows, "score").first().auc_roc == 1.0
    assert metrics.roc_points(rows, "score").filter("score IS NOT NULL").count() > 0
    found = {r.metric: r.value for r in metrics.metrics_long(rows, "score").collect()}
    assert found["auc_roc"] == 1.0 and found["accuracy"] == pytest.approx(3 / 7)


def test_recall_by_class(spark):
    data = [("m", "a", 1.0, 1.0), ("m", "a", 1.0, 0.0), ("m", "b", 0.0, 0.0), ("m", None, 1.0, 1.0)]
    rows = spark.createDataFrame(data, "model string, label_original string, label double, prediction double")
    found = {r["class"]: (r.rows, r.found, r.recall) for r in metrics.recall_by_class(rows).collect()}
    assert found == {"a": (2, 1, 0.5), "b": (1, 1, 1.0), None: (1, 1, 1.0)}


def test_ties_name_every_best_model(spark):
    long = spark.createDataFrame([("b", "f1", 0.5), ("a", "f1", 0.5), ("c", "f1", 0.1)], "model string, metric string, value double")
    assert metrics.best_model(long).first()["model"] == "a"
    assert {r["model"] for r in metrics.best_per_metric(long).collect()} == {"a", "b"}


def thinned_area(pairs, bins):
    """Area under the curve of (score, label) through one point of each group of neighbouring scores."""
    scores = sorted({s for s, _ in pairs}, reverse=True)
    group = -(-len(scores) // bins)
    points, tp, fp = [(0, 0)], 0, 0
    for place, score in enumerate(scores, 1):
        tp += sum(1 for s, y in pairs if s == score and y == 1.0)
        fp += sum(1 for s, y in pairs if s == score and y == 0.0)
        if place % group == 0 or place == len(scores):
            points.append((fp, tp))
    area = sum((x1 - x0) * (y1 + y0) for (x0, y0), (x1, y1) in zip(points, points[1:], strict=False))
    return area / (2 * tp * fp) if tp and fp else None


@pytest.mark.parametrize("bins", [1, 3, 10, 1000])
def test_thinned_areas_of_all_models(spark, bins):
    data = [(f"m{m}", (i * 37 + m * 11) % (40 + 25 * m), float((i * i + m) % 3 == 0)) for m in range(3) for i in range(150)]
    data += [("one class", i, 1.0) for i in range(9)]
    rows = spark.createDataFrame(data, "model string, score int, label double")
    for r in metrics.auc_binned(rows, "score", bins).collect():
        wanted = thinned_area([(s, y) for m, s, y in data if m == r.model], bins)
        assert r.auc_binned == (wanted if wanted is None else pytest.approx(wanted, abs=1e-12))
