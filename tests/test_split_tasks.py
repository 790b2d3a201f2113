"""Small splits without many tasks, records cut without a shuffle of their text, narrow shuffles."""

from __future__ import annotations

from conftest import plan_of, shuffled_columns
from pyspark.sql import functions as F

from curaspan.plans import views
from curaspan.sources import split_records
from curaspan.sources.split_records import quoted_records


def test_tasks_do_not_grow_with_the_number_of_splits(spark, tmp_path):
    (tmp_path / "a.csv").write_text("record_id,notes\n" + '1,"x\ny"\n' * 3000)
    with views.small_splits(spark, "16b"):
        lines = spark.read.text(str(tmp_path)).select(F.col("_metadata.file_block_start").alias("split"), "value")
        assert lines.select("split").distinct().count() > 1000
        assert lines.rdd.getNumPartitions() <= 2 * views.SPLIT_TASKS * spark.sparkContext.defaultParallelism
        records = quoted_records(spark, str(tmp_path), F.col("_metadata.file_path"))
        counted = {r["value"]: r["n"] for r in records.groupBy("value").agg(F.count("*").alias("n")).collect()}
    assert counted == {"record_id,notes": 1, '1,"x\ny"': 3000}
    assert spark.conf.get("spark.sql.files.maxPartitionNum", None) is None


def test_records_are_cut_where_they_are_read(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text('record_id,notes\n1,"x\ny"\n2,z\n' * 50)
    plans = {}
    kept = split_records.written

    def noted(df, name):
        plans[name] = plan_of(df)
        return kept(df, name)

    monkeypatch.setattr(split_records, "written", noted)
    assert quoted_records(spark, str(tmp_path), F.col("_metadata.file_path")).count() == 150
    assert "Exchange hashpartitioning" not in plans["records-of-splits"]


def test_splits_with_unusual_starts_may_be_too_many_for_a_broadcast(spark, tmp_path, monkeypatch):
    text = "".join(f'{i},"{i}\n,{i}\n"\n' for i in range(200))
    (tmp_path / "a.csv").write_text(text)
    monkeypatch.setattr(split_records, "BROADCAST_SPLITS", 0)
    with views.small_splits(spark, "20b"):
        found = [r["value"] for r in quoted_records(spark, str(tmp_path), F.col("_metadata.file_path")).collect()]
    assert sorted(found) == sorted(f'{i},"{i}\n,{i}\n"' for i in range(200))


def test_tickets_are_built_after_their_shuffle(spark, sf_dir):
    rows = views._as_tickets(views._lines_in_order(spark, sf_dir))
    [moved] = shuffled_columns(rows)
    assert "notes" not in moved and "assignee_email" not in moved
