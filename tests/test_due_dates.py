"""Due dates whose parts are worked out once."""

from __future__ import annotations

from conftest import plan_of
from pyspark.sql import functions as F

from curaspan.functions.times import parse_due_date, print_iso


def test_a_date_is_brought_into_shape_once(spark):
    plan = plan_of(spark.range(1).select(parse_due_date(F.col("id").cast("string")).alias("due")))
    # One plain date, and one for texts that may have a clock.
    assert plan.count("(?:st|nd|rd|th)") == 2


def test_with_and_without_a_clock(spark):
    want = {
        "2024-03-05": "2024-03-05T00:00:00+00:00",
        "13/03/2024": "2024-03-13T00:00:00+00:00",
        "5 may 24": "2024-05-05T00:00:00+00:00",
        "April 5th, 2024": "2024-04-05T00:00:00+00:00",
        "April 5th, 2024 3 pm": "2024-04-05T15:00:00+00:00",
        "20240305 07:08:09.5": "2024-03-05T07:08:09.500000+00:00",
        "2024-03-05\n": None,
        "2024-\n03-05": None,
        "no date": None,
        "": None,
        None: None,
    }
    rows = spark.createDataFrame([(text,) for text in want], "text string")
    found = rows.select("text", print_iso(parse_due_date(F.col("text"))).alias("due")).collect()
    assert {r["text"]: r["due"] for r in found} == want
