"""Bracketed quantiles equal the built-in percentile."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from senslake.operators import brackets

QS = [0.0, 0.25, 0.5, 0.9, 1.0]
NAMES = [f"p{i}" for i in range(len(QS))]


@pytest.mark.parametrize("accuracy", [50, 10_000])
def test_equals_percentile_in_groups_of_any_size(spark, accuracy):
    rng = np.random.default_rng(3)
    rows = [("hot", float(x)) for x in rng.normal(size=6000).round(3)] + [("ties", float(x)) for x in rng.integers(0, 4, 5000)]
    rows += [("one value", 2.5)] * 3000 + [(None, float(x)) for x in rng.exponential(size=900)] + [("single", 5.0), ("pair", 1.0), ("pair", 2.0), ("hot", None), ("hot", float("nan")), ("none", None)]
    rows += [("ends", float(x)) for x in [float("inf")] * 3 + [-float("inf")] * 3 + list(range(500))]
    df = spark.createDataFrame(rows, "g string, value double").repartition(7)
    got = {r.g: r for r in brackets.exact_quantiles(df, ["g"], "value", QS, NAMES, accuracy=accuracy).collect()}
    clean = df.where("value is not null and not isnan(value)")
    want = clean.groupBy("g").agg(F.count("value").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"), F.percentile("value", F.array(*[F.lit(q) for q in QS])).alias("p")).collect()
    assert set(got) == {w.g for w in want}
    for w in want:
        assert (got[w.g].n, got[w.g]["min"], got[w.g]["max"]) == (w.n, w.lo, w.hi)
        assert [got[w.g][n] for n in NAMES] == pytest.approx(w.p, rel=1e-12, abs=1e-12)


def test_only_values_inside_the_brackets_are_shuffled(spark):
    df = spark.range(200_000).select(F.lit(1).alias("g"), F.pmod(F.xxhash64("id"), F.lit(1 << 40)).cast("double").alias("value"))
    out = brackets.exact_quantiles(df, ["g"], "value", [0.5], ["median"], accuracy=1000)
    assert out.first().median == df.agg(F.percentile("value", 0.5)).first()[0]
    s = df.groupBy("g").agg(F.percentile_approx("value", F.array(F.lit(0.498), F.lit(0.502)), 1000).alias("s")).first().s
    assert df.where(F.col("value").between(*s)).count() < 2500
