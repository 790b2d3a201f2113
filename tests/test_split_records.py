"""Records cut out of many small input splits, against parsers that see the whole file."""

from __future__ import annotations

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from curaspan.plans.views import small_splits
from curaspan.sources.readers import read_chat, read_tabular, read_tabular_raw
from curaspan.sources.split_records import array_elements, quoted_records



def path():
    return F.col("_metadata.file_path")

CELLS = ["", "a", "é日本", 'say "x"', "one\ntwo", "\n\n", '"', '""\n"', "x,y", ",\n,", "line " * 30, 'end"']


def made_csv(rng, n, end="\n"):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    rows = [["record_id", "notes", "status"]]
    rows += [[str(i), rng.choice(CELLS), rng.choice(CELLS)] for i in range(n)]
    writer.writerows(rows)
    return out.getvalue(), rows[1:]


@pytest.mark.parametrize("seed,split", [(0, "64b"), (1, "1k")])
def test_csv_equals_the_whole_file_parser(spark, tmp_path, seed, split):
    rng = random.Random(seed)
    want = []
    for k in range(3):
        text, rows = made_csv(rng, 60, "\r\n" if k == 1 else "\n")
        (tmp_path / f"f{k}.csv").write_bytes(text.encode())
        want += [tuple(c for c in row) for row in rows]
    with small_splits(spark, split):
        if split == "64b":
            assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
        raw = read_tabular_raw(spark, str(tmp_path))
        records = quoted_records(spark, str(tmp_path), path())
        assert records.count() == len(want) + 3
    got = sorted(map(tuple, raw.select("record_id", "notes", "status").collect()))
    assert got == sorted(want)


def test_quotes_inside_unquoted_fields_and_unclosed_ones(spark, tmp_path):
    text = 'record_id,notes\n1,5" pipe\n2,a "b" c\n3,"open\n4,x\n\n5,y\n'
    (tmp_path / "a.csv").write_text(text)
    (tmp_path / "b.csv").write_text('record_id,notes\n7,"z"\n')
    for split in ("16b", "1m"):
        with small_splits(spark, split):
            values = [r["value"] for r in quoted_records(spark, str(tmp_path), path()).collect()]
        assert sorted(values) == sorted(
            ["record_id,notes", '1,5" pipe', '2,a "b" c', '3,"open\n4,x\n\n5,y\n'.rstrip("\n"), "record_id,notes", '7,"z"']
        )


def test_positions_keep_the_order_of_the_file(spark, tmp_path):
    rows = "".join(f'{i % 7},"n{i}\nmore"\n' for i in range(300))
    (tmp_path / "a.csv").write_text("record_id,notes\n" + rows)
    with small_splits(spark, "100b"):
        loaded = read_tabular(spark, str(tmp_path))
    assert sorted(r["text"] for r in loaded.records.collect()) == [f"n{i}\nmore" for i in range(7)]
    counted = loaded.counters.first()
    assert (counted["rows_read"], counted["duplicates_dropped"]) == (300, 293)


STRINGS = ["", "a", "}", "{[", "]}", 'q"}', "\\", "\\\\}", "é\n", "[1]", "x" * 70, '"', "},{"]


def made_message(rng):
    message = {"text": rng.choice(STRINGS), "user_id": rng.choice(STRINGS), "timestamp": "2024-01-15T09:00:00Z"}
    if rng.random() < 0.4:
        message["channel"] = rng.choice([None, "c}", {"deep": [{"x": rng.choice(STRINGS)}, []]}])
    return message


@pytest.mark.parametrize("seed,split", [(0, "64b"), (1, "1k")])
def test_arrays_equal_the_whole_file_parser(spark, tmp_path, seed, split):
    rng = random.Random(seed)
    want = []
    for k, indent in enumerate((None, 2, 0, None)):
        messages = [made_message(rng) for _ in range(40)]
        text = json.dumps(messages, indent=indent, ensure_ascii=k == 3)
        (tmp_path / f"f{k}.json").write_text(text + "\n" * (k % 2))
        want += messages
    (tmp_path / "one.json").write_text(json.dumps(made_message(rng), indent=1))
    want.append(json.loads((tmp_path / "one.json").read_text()))
    (tmp_path / "none.json").write_text("[]")
    with small_splits(spark, split):
        elements = array_elements(spark, str(tmp_path), path())
        rows = elements.collect()
        loaded = read_chat(spark, str(tmp_path))
    assert all(r["closed"] for r in rows)
    key = json.dumps
    assert sorted(map(key, (json.loads(r["value"]) for r in rows))) == sorted(map(key, want))
    assert sorted(r["text"] for r in loaded.records.collect()) == sorted(m["text"] for m in want)
    assert loaded.rejects.count() == 0
    assert loaded.records.select("record_id").distinct().count() == len(want)


@pytest.mark.parametrize(
    "text", ['[{"text": "a"}, {"text": 1', '[{"text": "a"}', '[{"text": "a"}, 5]', '[{"text" "a"}]']
)
def test_what_does_not_parse_rejects_its_file_only(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    (tmp_path / "good.json").write_text('[{"text": "fine"}]')
    with small_splits(spark, "8b"):
        loaded = read_chat(spark, str(tmp_path))
    assert [r["text"] for r in loaded.records.collect()] == ["fine"]
    assert [r["source_file"].endswith("bad.json") for r in loaded.rejects.collect()] == [True]
