from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from curaspan.operators import quantiles as module
from curaspan.operators.profile import describe, describe_continuous
from curaspan.operators.quantiles import quantiles

PROBABILITIES = (0.0, 0.01, 0.25, 0.5, 0.731, 0.99, 1.0)


@pytest.fixture
def few_sorted(monkeypatch):
    """Several rounds also on small tables."""
    monkeypatch.setattr(module, "SORTED_VALUES", 20)


def column(spark, expression, rows=40_000):
    return spark.range(rows).select(F.expr(expression).alias("x"))


@pytest.mark.parametrize(
    "expression",
    [
        "cast(xxhash64(id) as double) / 1e9",  # all different
        "if(id % 3 = 0, 7.5, cast(xxhash64(id) % 1000 as double))",  # one value in a third of the rows
        "cast(id % 2 as double)",
        "cast(5 as double)",
        "exp(cast(id % 700 as double))",  # very uneven
        "if(id % 5 = 0, null, if(id % 7 = 0, double('nan'), -cast(id as double)))",
    ],
)
def test_equal_to_sorting(spark, few_sorted, expression):
    df = column(spark, expression)
    values = df.toPandas()["x"].dropna().to_numpy()
    expected = np.quantile(values, PROBABILITIES)
    assert quantiles(df, "x", PROBABILITIES) == pytest.approx(expected.tolist(), rel=1e-12)


def test_cuts_of_a_bad_sketch_change_nothing(spark, few_sorted, monkeypatch):
    monkeypatch.setattr(module, "MARGIN", 1e-9)
    monkeypatch.setattr(module, "SKETCH_K", 8)
    df = column(spark, "cast(xxhash64(id) as double)", 5_000)
    expected = np.quantile(df.toPandas()["x"].to_numpy(), (0.3, 0.9))
    assert quantiles(df, "x", (0.3, 0.9)) == pytest.approx(expected.tolist(), rel=1e-12)


def test_approximate_form_is_near(spark):
    df = column(spark, "cast(id as double)", 100_000)
    for p, got in zip(PROBABILITIES, quantiles(df, "x", PROBABILITIES, approximate=True)):
        assert abs(got / 100_000 - p) < 0.005


def test_empty_and_wrong_input(spark):
    df = column(spark, "cast(null as double)", 3)
    assert quantiles(df, "x", (0.5,)) == [None] == quantiles(df, "x", (0.5,), approximate=True)
    assert describe_continuous(df.limit(0), "x").first()["count"] == 0
    with pytest.raises(ValueError, match="between 0 and 1"):
        quantiles(df, "x", (1.5,))


def test_same_as_describe(spark, few_sorted):
    df = column(spark, "cast(xxhash64(id) % 5000 as double)", 9_000)
    assert describe_continuous(df, "x").first().asDict() == pytest.approx(describe(df, "x").first().asDict())
