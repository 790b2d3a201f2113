from __future__ import annotations

import statistics
from datetime import datetime

import pytest

from curaspan.operators import profile
from curaspan.operators.quality import score_quality

ROWS = [
    # record_id, format, file, time, tag, text, types, has_pii, found, replaced
    ("r1", "csv", "2024-01-01", "a::b::c", "x" * 20, ["EMAIL", "SSN"], True, 6, 6),
    ("r2", "csv", "2024-01-01", "a::b::c", "x" * 20, ["EMAIL"], True, 1, 1),
    ("r3", "csv", None, "a::b::c", "", [], False, 0, 0),
    ("r4", "slack", "2024-01-01", "a::b::c", "x" * 20, [], False, 0, 0),
    ("r5", "slack", "2005-01-01", "a::b", "short", [], False, 0, 0),
    ("r6", "slack", "2024-01-01", "a::b::c", "x" * 20, [], False, 0, 0),
    ("r7", "slack", "2024-01-01", "a::b::c", "x" * 20, [], False, 0, 0),
    ("r8", None, "2024-01-01", "a::b::c", "x" * 20, [], False, 0, 0),
]


@pytest.fixture(scope="module")
def table(spark):
    rows = [
        (*r[:2], datetime.fromisoformat(r[2]) if r[2] else None, *r[3:]) for r in ROWS
    ]
    schema = (
        "record_id string, source_format string, timestamp timestamp, source_lineage_tag string, text string, "
        "pii_types_found array<string>, has_pii boolean, pii_count int, anonymization_count int"
    )
    return score_quality(spark.createDataFrame(rows, schema))


@pytest.fixture(scope="module")
def scores(table):
    return [r["quality_score"] for r in table.collect()]


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def test_column_profile(table):
    rows = {r["column"]: r for r in rows_of(profile.column_profile(table))}
    assert set(rows) == set(table.columns)
    assert rows["timestamp"]["null_count"] == 1 and rows["timestamp"]["null_pct"] == 12.5
    assert rows["record_id"]["sample"] == "r1" and rows["pii_count"]["dtype"] == "int"
    assert rows["pii_types_found"]["sample"].startswith("[")


def test_counts_and_rates(table):
    assert rows_of(profile.records_per_format(table)) == [
        {"source_format": "slack", "records": 4},
        {"source_format": "csv", "records": 3},
    ]
    rates = rows_of(profile.pii_rate(table))
    assert [(r["source_format"], r["total"], r["with_pii"]) for r in rates] == [("csv", 3, 2), ("slack", 4, 0)]
    assert rates[0]["pct_with_pii"] == pytest.approx(200 / 3)
    assert rows_of(profile.type_frequency(table)) == [
        {"pii_type": "EMAIL", "records": 2},
        {"pii_type": "SSN", "records": 1},
    ]


def test_histograms(table, scores):
    counts = {r["pii_count"]: r["records"] for r in rows_of(profile.pii_count_histogram(table))}
    assert counts == {0: 6, 1: 1, 2: 0, 3: 0, 4: 0, 5: 0, 6: 1}
    bins = sorted(rows_of(profile.quality_histogram(table)), key=lambda r: r["bin"])
    assert len(bins) == 30 and sum(b["records"] for b in bins) == len(ROWS)
    assert bins[0]["bin_from"] == min(scores) and bins[29]["bin_to"] == pytest.approx(max(scores))
    assert bins[0]["records"] == 1 and bins[29]["records"] == sum(s == max(scores) for s in scores) + 2


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(0.5,), (0.5,)], "quality_score double")
    bins = sorted(rows_of(profile.quality_histogram(df)), key=lambda r: r["bin"])
    assert (bins[0]["bin_from"], sum(b["records"] for b in bins), bins[15]["records"]) == (0.0, 2, 2)


def test_describe(table, scores):
    row = profile.describe(table, "quality_score").first()
    q25, q50, q75 = statistics.quantiles(scores, n=4, method="inclusive")
    want = (8, statistics.mean(scores), statistics.stdev(scores), min(scores), q25, q50, q75, max(scores))
    assert tuple(row) == pytest.approx(want)


def test_above_threshold(table, scores):
    row = profile.above_threshold(table).first()
    assert (row["passed"], row["records"]) == (sum(s >= 0.8 for s in scores), 8)


def test_box_statistics(table):
    boxes = {r["source_format"]: r for r in rows_of(profile.box_statistics(table))}
    slack = boxes["slack"]
    scores = sorted([1.0, 0.35 * 0.5 + 0.2 * 0.5 + 0.15 * 0.5 + 0.3, 1.0, 1.0])
    q25, q50, q75 = statistics.quantiles(scores, n=4, method="inclusive")
    assert (slack["q25"], slack["median"], slack["q75"]) == pytest.approx((q25, q50, q75))
    low = min(s for s in scores if s >= q25 - 1.5 * (q75 - q25))
    assert (slack["whisker_low"], slack["whisker_high"]) == pytest.approx((low, 1.0))
    assert slack["pct_above"] == 75.0 and set(boxes) == {"csv", "slack"}


def test_dimension_means(table):
    means = {r["source_format"]: r for r in rows_of(profile.dimension_means(table))}
    assert means["slack"]["completeness_score"] == 0.875
    assert means["csv"]["pii_removal_confidence_score"] == pytest.approx((0.95 + 0.95 + 1) / 3)


def test_weak_segments(table, spark):
    low = rows_of(profile.low_quality(table))
    assert [r["record_id"] for r in low] == ["r3"] and list(low[0]) == profile.LOW_QUALITY_COLUMNS
    assert [r["record_id"] for r in rows_of(profile.weakest(table))] == ["r3"]
    worst = profile.worst_dimension(table).first()
    # Two dimensions are at zero: the first one counts.
    assert (worst["dimension"], worst["mean"]) == ("completeness_score", 0.0)
    good = table.where("record_id <> 'r3'")
    assert rows_of(profile.low_quality(good)) == []
    assert [r["record_id"] for r in rows_of(profile.weak_segment(good))] == ["r5"]
    assert profile.worst_dimension(good).first()["dimension"] == "completeness_score"


def test_anomalies(table):
    counts = [r[7] for r in ROWS]
    cutoff = statistics.mean(counts) + 2 * statistics.stdev(counts)
    flags = {r["record_id"]: r["is_pii_anomaly"] for r in rows_of(profile.flag_anomalies(table))}
    assert flags == {r[0]: r[7] > cutoff for r in ROWS} and flags["r1"]
    assert rows_of(profile.anomaly_breakdown(table)) == [
        {"source_format": "csv", "anomaly_records": 1, "max_pii_count": 6, "mean_pii_count": 6.0}
    ]
    pairs = rows_of(profile.count_by_score(table))
    assert sum(p["records"] for p in pairs) == 8 and sum(p["is_pii_anomaly"] for p in pairs) == 1


def test_one_record_has_no_anomaly(table):
    flagged = profile.flag_anomalies(table.where("record_id = 'r1'")).first()
    assert flagged["is_pii_anomaly"] is False
