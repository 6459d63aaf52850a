"""Boosting against a plain Python version that looks at every row for every split."""

import random

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from viaduct.forecast import boosting
from viaduct.forecast.boosting import HistogramBoosting, cut_points, soft_threshold

NAMES = ("a", "b", "c", "d")


@pytest.fixture(scope="module")
def table():
    draw = random.Random(4)
    rows = [(draw.randrange(24) * 1.0, round(draw.random(), 2), draw.randrange(3) * 1.0, 7.0) for _ in range(160)]
    return [(*x, 100 + 50.0 * (x[0] >= 12) + 30.0 * (x[2] >= 1) * (x[1] > 0.4) + draw.randrange(3)) for x in rows]


@pytest.fixture(scope="module")
def frame(spark, table):
    rows = spark.createDataFrame(table, [*NAMES, "label"])
    return VectorAssembler(inputCols=list(NAMES), outputCol="features").transform(rows)


def plain(table, trees, depth, step, columns, alpha, l2, seed):
    """Predictions of the training rows; splits are tried at every value, exactly."""
    draw, width = random.Random(seed), len(NAMES)
    base = sum(r[-1] for r in table) / len(table)
    predicted = [base] * len(table)

    def worth(rows, gradient):
        return soft_threshold(sum(gradient[r] for r in rows), alpha) ** 2 / (len(rows) + l2)

    def grow(rows, gradient, features, levels):
        best = None
        for f in features if levels else ():
            for cut in sorted({table[r][f] for r in rows})[:-1]:
                left = [r for r in rows if table[r][f] <= cut]
                right = [r for r in rows if table[r][f] > cut]
                gain = worth(left, gradient) + worth(right, gradient) - worth(rows, gradient)
                if gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                    best = gain, left, right
        if best is None:
            weight = -step * soft_threshold(sum(gradient[r] for r in rows), alpha) / (len(rows) + l2)
            return {r: weight for r in rows}
        return {**grow(best[1], gradient, features, levels - 1), **grow(best[2], gradient, features, levels - 1)}

    for _ in range(trees):
        features = sorted(draw.sample(range(width), max(1, int(columns * width + 1e-9))))
        gradient = [p - row[-1] for p, row in zip(predicted, table)]
        weights = grow(list(range(len(table))), gradient, features, depth)
        predicted = [p + weights[r] for r, p in enumerate(predicted)]
    return predicted


SETTINGS = [dict(trees=10, depth=3, step=0.3, columns=0.5, alpha=10.0, l2=1.0, seed=3),
            dict(trees=9, depth=2, step=0.5, columns=1.0, alpha=0.0, l2=0.0, seed=1)]


@pytest.mark.parametrize("settings", SETTINGS, ids=["l1", "plain"])
@pytest.mark.parametrize("cells", [boosting.CELLS, 0], ids=["cube", "levels"])
def test_predictions_of_the_plain_version(frame, table, settings, cells, monkeypatch):
    monkeypatch.setattr(boosting, "CELLS", cells)
    model = HistogramBoosting(**settings).fit(frame.repartition(3))
    found = sorted((*[r[n] for n in NAMES], r["label"], r["prediction"]) for r in model.transform(frame).collect())
    expected = sorted((*row, p) for row, p in zip(table, plain(table, **settings)))
    assert [f[-1] for f in found] == pytest.approx([e[-1] for e in expected], abs=1e-6)


def test_alpha_left_out_is_alpha_zero_and_alpha_shrinks(frame):
    def spread(**more):
        model = HistogramBoosting(trees=3, depth=2, **more).fit(frame)
        return [r[0] for r in model.transform(frame).orderBy(*NAMES, "label").select("prediction").collect()]
    none, zero, some, much = spread(), spread(alpha=0.0), spread(alpha=200.0), spread(alpha=1e9)
    assert none == zero and max(some) - min(some) < max(none) - min(none) and max(much) == min(much)


def test_fit_does_not_depend_on_partitions(frame):
    forests = {HistogramBoosting(trees=5, depth=3, columns=0.5, seed=8).fit(f).getOrDefault("forest")
               for f in (frame, frame.repartition(5), frame.repartition(2, "label").orderBy(F.desc("a")))}
    assert len(forests) == 1


def test_cuts_are_values_or_quantiles(spark):
    rows = spark.range(10_000).select(F.array((F.col("id") % 3).cast("double"), F.col("id").cast("double"),
                                              F.lit(5.0), F.lit(float("nan"))).alias("x"))
    few, many, one, none = cut_points(rows, 4, bins=16)
    assert few == [0.0, 1.0] and one == [] and none == []
    assert 12 <= len(many) <= 16 and all(abs(cut - 625 * k) < 40 for k, cut in enumerate(many, 1))


def test_kept_and_loaded_in_a_pipeline(frame, tmp_path):
    model = Pipeline(stages=[HistogramBoosting(trees=4, depth=3)]).fit(frame)
    model.write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    assert again.transform(frame).exceptAll(model.transform(frame)).count() == 0


def test_odd_tables(spark, frame):
    with pytest.raises(ValueError, match="no rows"):
        HistogramBoosting().fit(frame.limit(0))
    same = frame.withColumn("label", F.lit(4.0))
    assert {r[0] for r in HistogramBoosting(trees=2).fit(same).transform(same).select("prediction").collect()} == {4.0}


def test_a_nan_goes_where_it_went_when_fitted(spark, frame):
    """Below a leaf above the last level, too."""
    odd = frame.select(F.when(F.col("a") >= 12, float("nan")).otherwise(F.col("a")).alias("a"), "label")
    odd = VectorAssembler(inputCols=["a"], outputCol="features", handleInvalid="keep").transform(odd)
    model = HistogramBoosting(trees=30, depth=4).fit(odd)
    means = {r["high"]: r["p"] for r in model.transform(odd).groupBy(F.isnan("a").alias("high")).agg(F.avg("prediction").alias("p")).collect()}
    expected = {r["high"]: r["y"] for r in odd.groupBy(F.isnan("a").alias("high")).agg(F.avg("label").alias("y")).collect()}
    assert means == pytest.approx(expected, abs=0.5)


def test_predictions_walk_down_in_batches(frame):
    model = HistogramBoosting(trees=2, depth=2).fit(frame)
    plan = model.transform(frame)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "lambda" not in plan
