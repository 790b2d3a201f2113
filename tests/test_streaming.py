"""The streaming query on tables of one file and of a folder of files."""

from __future__ import annotations

from curaspan.plans.catalog import QUERIES

DOCUMENTS = "doc_id long, text string, lang string, source string"


def test_documents_may_be_a_file_or_a_folder(spark, tmp_path):
    rows = [(i, f"mail a{i}@example.com", "en", "web") for i in range(6)]
    folder, single = tmp_path / "folder", tmp_path / "single"
    docs = spark.createDataFrame(rows, DOCUMENTS)
    docs.repartition(3).write.parquet(str(folder / "documents.parquet"))
    docs.coalesce(1).write.parquet(str(tmp_path / "one"))
    single.mkdir()
    next((tmp_path / "one").glob("part-*.parquet")).rename(single / "documents.parquet")
    for sf_dir in (folder, single):
        found = QUERIES["streaming_curation"](spark, str(sf_dir)).collect()
        assert sorted((r["record_id"], r["pii_count"]) for r in found) == [(f"doc-{i}", 1) for i in range(6)]
