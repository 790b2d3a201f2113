from __future__ import annotations

import gzip
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, shuffled_columns
from curaspan.plans.catalog import QUERIES
from curaspan.plans.pipeline import curate, ingest_all, run_pipeline
from curaspan.schemas import CURATED_COLUMNS, DETECTION_TYPE
from curaspan.session import build_session, scratch_root
from curaspan.sources.readers import read_curated
from curaspan.sources.writers import RAW_COLUMNS, release_view, write_curated
from curaspan.streaming.curate import start_curation


@pytest.fixture
def sources(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    messages = [
        {"user_id": "U1", "username": "bob", "channel": "c", "timestamp": "2024-01-15T09:00:00Z",
         "text": "Mail alice@example.com or call 415-555-0192"},
        {"user_id": "U2", "username": "eve", "channel": "c", "timestamp": "2024-01-15T09:01:00Z", "text": "héllo there, all"},
    ]
    (raw / "chat.json").write_text(json.dumps(messages))
    (raw / "records.csv").write_text(
        "record_id,assignee_name,due_date,notes\n1,Ann,2024-03-05,SSN 123-45-6789\n1,Dup,,\n,,soon,\n"
    )
    (raw / "comments.txt").write_text("# host 10.0.0.1\n# nothing here at all\n")
    return {
        str(raw / "chat.json"): "slack",
        str(raw / "records.csv"): "csv",
        str(raw / "comments.txt"): "plaintext",
        str(raw / "missing.csv"): "csv",
    }


def config(sources, tmp_path, **extra):
    return {
        "sources": sources,
        "lineage_dir": str(tmp_path / "lineage"),
        "quality_report_path": str(tmp_path / "reports" / "report.json"),
        "parquet_path": str(tmp_path / "out" / "curated.parquet"),
        "rejects_path": str(tmp_path / "out" / "rejects.parquet"),
        **extra,
    }


def test_run(spark, sources, tmp_path):
    summary = run_pipeline(spark, config(sources, tmp_path))
    assert summary["total_records_ingested"] == 6
    assert summary["pii_detected_in"] == 3 and summary["spans_replaced"] == 4
    assert summary["records_passed_quality_threshold"] == 5
    assert len(summary["load_failures"]) == 1 and summary["elapsed_seconds"] > 0

    saved = read_curated(spark, summary["parquet_path"])
    assert saved.columns == CURATED_COLUMNS and len(CURATED_COLUMNS) == 21
    rows = {r["source_format"] + r["text"][:4]: r for r in saved.collect()}
    assert rows["csvAnn "]["anonymized_text"].startswith("Ann SSN [SSN_")
    assert rows["plaintext# ho"]["anonymized_text"] == "# host [REDACTED_IP_ADDRESS]"
    assert rows["csv"]["quality_score"] < 0.5

    log = [json.loads(r["value"]) for r in spark.read.text(summary["lineage_log_path"]).collect()]
    assert len(log) == 3 * 6 + 4 and {e["run_id"] for e in log} == {summary["run_id"]}
    assert {e["record_id"] for e in log} == {r["record_id"] for r in rows.values()}
    stages = {}
    for event in log:
        stages.setdefault(event["record_id"], []).append(event["event"])
    for names in stages.values():
        assert names[:2] == ["ingested", "pii_detected"] and names[-1] == "quality_scored"
    assert any("héllo" in json.dumps(r.asDict(), ensure_ascii=False, default=str) for r in rows.values())

    sidecar = json.loads(spark.read.text(str(tmp_path / "lineage" / "lineage_log_summary.json")).first()["value"])
    assert sidecar["total_events"] == len(log) and sidecar["records_processed"] == 6
    report = json.loads(
        "\n".join(
            r["value"] for r in spark.read.text(str(tmp_path / "reports" / "report.json"), wholetext=True).collect()
        )
    )
    assert report["record_count"] == 6 and report["weights"]["completeness"] == 0.35
    assert report["pct_pii_records_fully_anonymized"] == 100.0


def test_threshold_is_separate_from_the_report(spark, sources, tmp_path):
    summary = run_pipeline(spark, config(sources, tmp_path, quality_threshold=0.99, run_id="run-1"))
    assert summary["run_id"] == "run-1" and summary["records_passed_quality_threshold"] == 2
    text = spark.read.text(str(tmp_path / "reports" / "report.json"), wholetext=True).first()["value"]
    assert json.loads(text)["threshold_used"] == 0.8


def test_nested_columns_as_json(spark, sources, tmp_path):
    summary = run_pipeline(spark, config(sources, tmp_path, nested_as_json=True))
    raw = spark.read.parquet(summary["parquet_path"])
    assert dict(raw.dtypes)["pii_detections"] == "string"
    assert json.loads(raw.where("pii_count = 2").first()["pii_types_found"]) == ["EMAIL", "PHONE_US"]
    back = read_curated(spark, summary["parquet_path"])
    assert back.schema["pii_detections"].dataType.simpleString() == DETECTION_TYPE.simpleString()
    direct = curate(ingest_all(spark, sources).records)
    columns = ["text", "pii_detections", "anonymization_log", "strategies_used"]
    assert sorted(map(str, back.select(columns).collect())) == sorted(map(str, direct.select(columns).collect()))


def test_entity_dictionary(spark, sources, tmp_path):
    names = spark.createDataFrame([("Ann", "PERSON"), ("host", "ORG")], "phrase string, label string")
    summary = run_pipeline(spark, config(sources, tmp_path, entity_dictionary=names))
    saved = read_curated(spark, summary["parquet_path"])
    assert saved.columns == CURATED_COLUMNS
    texts = [r["anonymized_text"] for r in saved.collect()]
    assert "# [REDACTED_ORG] [REDACTED_IP_ADDRESS]" in texts
    assert any(t.startswith("[PERSON_") for t in texts)


def test_nothing_to_load(spark, tmp_path):
    summary = run_pipeline(spark, config({"/nowhere/a.json": "slack"}, tmp_path))
    assert summary["total_records_ingested"] == 0 and summary["records_passed_quality_threshold"] == 0
    assert read_curated(spark, summary["parquet_path"]).columns == CURATED_COLUMNS


def test_release_holds_no_original_values(spark, sources):
    curated = curate(ingest_all(spark, sources).records)
    released = release_view(curated)
    assert not set(RAW_COLUMNS) & set(released.columns)
    dump = " ".join(str(r) for r in released.collect())
    for value in ("alice@example.com", "415-555-0192", "123-45-6789", "10.0.0.1"):
        assert value not in dump


def test_stream(spark, sources, tmp_path):
    batch = ingest_all(spark, sources).records
    landing, out = str(tmp_path / "landing"), str(tmp_path / "streamed")
    batch.write.parquet(landing)
    stream = spark.readStream.schema(batch.schema).parquet(landing)
    for _ in range(2):
        # The second run finds no new files and adds nothing.
        start_curation(stream, out, str(tmp_path / "checkpoint"), drain=True).awaitTermination()
    want = curate(spark.read.parquet(landing))
    assert read_curated(spark, out).columns == CURATED_COLUMNS
    assert sorted(map(str, read_curated(spark, out).collect())) == sorted(map(str, want.collect()))


def test_scratch_follows_the_cluster_setting(spark, monkeypatch):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_curation_of_the_given_tables_shuffles_nothing(spark, sf_dir):
    for name in ("pii_spans", "anonymized_text", "quality_scores"):
        assert "Exchange" not in plan_of(QUERIES[name](spark, sf_dir))


def test_ordered_log_does_not_move_texts(spark, sf_dir):
    moved = shuffled_columns(QUERIES["lineage_events"](spark, sf_dir))
    assert len(moved) == 1
    names = [c.split("#")[0] for c in moved[0].split(", ")]
    assert "record_id" in names and not {"text", "anonymization_log", "anonymized_text"} & set(names)


def test_appended_runs_keep_their_summaries(spark, sources, tmp_path):
    for _ in range(2):
        run_pipeline(spark, config(sources, tmp_path, lineage_mode="append", multiline=False))
    summaries = spark.read.json(str(tmp_path / "lineage" / "lineage_log_summary.json"))
    log = spark.read.json(str(tmp_path / "lineage" / "lineage_log.jsonl"))
    assert summaries.select("run_id").distinct().count() == 2
    assert log.count() == summaries.agg(F.sum("total_events")).first()[0]


def test_metadata_decodes(spark, sources, tmp_path):
    summary = run_pipeline(spark, config(sources, tmp_path))
    saved = read_curated(spark, summary["parquet_path"], decode_metadata=True)
    field = F.try_variant_get("raw_metadata", "$.assignee_name", "string")
    names = {r["name"] for r in saved.select(field.alias("name")).collect()}
    assert names == {None, "Ann", ""}


def test_nothing_is_lost_without_a_word(spark, tmp_path):
    """Rejects, counts and sources that break while they are read are all reported."""
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "cut.json").write_text('[{"text": "a"}, {"text": "b')
    (raw / "long.csv").write_text("record_id,notes\n1,x\n2,y,,extra a@b.co\n1,z\n,q\n")
    with gzip.open(raw / "text.txt.gz", "wb") as file:
        file.write(b"line of text\n" * 100_000)
    whole = (raw / "text.txt.gz").read_bytes()
    (raw / "text.txt.gz").write_bytes(whole[: len(whole) // 2])
    (raw / "bad.csv.gz").write_bytes(b"no gzip at all")
    (raw / "good.txt").write_text("one\ntwo\n")
    kinds = {"cut.json": "slack", "long.csv": "csv", "text.txt.gz": "plaintext", "bad.csv.gz": "csv"}
    sources = {str(raw / name): kind for name, kind in kinds.items()}
    sources[str(raw / "good.txt")] = "plaintext"
    summary = run_pipeline(spark, config(sources, tmp_path))
    assert summary["records_per_format"] == {"csv": 2, "plaintext": 2}
    assert (summary["duplicates_dropped"], summary["ids_repaired"]) == (1, 1)
    assert set(summary["rejected_per_source"].values()) == {1}
    failed = " ".join(summary["load_failures"])
    assert all(name in failed for name in kinds) and "good" not in failed
    rejects = {r["raw"] for r in spark.read.parquet(summary["rejects_path"]).collect()}
    assert any("extra a@b.co" in r for r in rejects) and len(rejects) == 2


def test_overwrite_by_default(spark, tmp_path):
    path = str(tmp_path / "c")
    for n in (5, 3):
        write_curated(spark.range(n).select(F.col("id").cast("string").alias("record_id")), path)
    assert spark.read.parquet(path).count() == 3 and os.path.isdir(path)


def test_session_settings():
    spark = build_session()
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.files.minPartitionNum")


def test_a_cut_file_takes_no_other_with_it(spark, tmp_path):
    folder = tmp_path / "mixed é"
    folder.mkdir()
    for i in range(10):
        body = gzip.compress("".join(f"line {i} {k} {random.random()}\n" for k in range(3000)).encode())
        (folder / f"f [{i}].txt.gz").write_bytes(body[: len(body) // 2] if i in (3, 6) else body)
    out = ingest_all(spark, {str(folder): "plaintext", "/nowhere/x.txt": "plaintext"}, staged=True)
    assert out.records.count() == 8 * 3000
    assert sum("file left out" in f for f in out.failures) == 2 and len(out.failures) == 3
    assert {i for i in range(10) if any(f"%5B{i}%5D" in f or f"[{i}]" in f for f in out.failures)} == {3, 6}
