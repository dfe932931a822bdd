"""EXP-2: rows are preprocessed once, and scores equal those of preprocessing every shuffled row. PP-3: powers from one logarithm."""

import random

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from fareline.operators import models as md
from fareline.operators import prep as pp

NAMES = ["day", "km", "turn", "rush"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data = [(rng.randint(0, 6), rng.expovariate(0.3) ** 2, rng.gauss(0, 3), rng.randint(0, 1)) for _ in range(500)]
    data += data[:40]
    return spark.createDataFrame([(*r, 2.0 + r[0] + 3 * r[1] ** 0.5 + r[2] * r[3] + rng.gauss(0, 1)) for r in data],
                                 "day int, km double, turn double, rush int, fare_amount double").repartition(3).cache()


def test_shuffled_vectors_score_as_shuffled_rows(spark, rows, monkeypatch):
    prep = md.fit_preprocessor(rows, ["day"], ["km", "turn"], ["rush"])
    model = Pipeline(stages=[md.make_regressor("linear")]).fit(prep.transform(rows))
    want = dict.fromkeys(NAMES, 0.0)
    used = prep.feature_order
    rmse = lambda df: model.transform(prep.transform(df)).agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("fare_amount"), F.lit(2.0))))).first()[0]
    base = rows.select("fare_amount", *used)
    for r in range(2):
        s = md.shuffled_columns(base, used, 42 + 10 * r, n_rows=540)
        for c in used:
            want[c] += (rmse(s.select("fare_amount", *[F.col(f"_s_{u}" if u == c else u).alias(u) for u in used])) - rmse(base)) / 2
    seen, transform = [], md.Preprocessor.transform
    monkeypatch.setattr(md.Preprocessor, "transform", lambda self, df, *a, **k: seen.append(1) or transform(self, df, *a, **k))
    got = md.permutation_importance(model, prep, rows, used, repeats=2)
    assert dict(got) == pytest.approx(want, rel=1e-9, abs=1e-12)
    assert len(seen) == 1


def test_likelihoods_from_logarithms(rows):
    grids = {"km": [-2.0, 0.0, 0.3, 2.0, 3.1], "turn": [-1.5, 0.0, 1.0, 2.0, 2.7]}
    logs = rows.withColumns({f"{c}__l": F.log1p(F.abs(c)) for c in grids})
    a, b = rows.selectExpr(*pp._yj_aggs(grids)).first().asDict(), logs.selectExpr(*pp._yj_log_aggs(grids)).first().asDict()
    assert b == pytest.approx(a, rel=1e-9)
