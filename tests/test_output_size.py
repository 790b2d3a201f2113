"""The log takes less room than its lines."""

from __future__ import annotations

from curaspan.sources.writers import write_lineage


def test_a_log_is_smaller_than_its_lines(spark, tmp_path):
    lines = [f'{{"event":"ingested","record_id":"r{i}","n":{i}}}' for i in range(2000)]
    path = write_lineage(spark.createDataFrame([(line,) for line in lines], "json string"), str(tmp_path / "log"))
    assert sorted(r["value"] for r in spark.read.text(path).collect()) == sorted(lines)
    size = sum(f.stat().st_size for f in (tmp_path / "log").iterdir())
    assert size < sum(map(len, lines)) / 2
