from __future__ import annotations

import json
import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, shuffled_columns
from curaspan.functions.text import WHITE_SPACE, join_nonempty, stable_id, strip
from curaspan.functions.times import parse_due_date, parse_iso, print_for_tag, print_iso
from curaspan.operators import ingest
from curaspan.plans.pipeline import ingest_all
from curaspan.schemas import TAGGED_SCHEMA, UNIFIED_COLUMNS
from curaspan.sources.readers import read_blocks, read_chat, read_tabular

UUID = re.compile(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}")


def column_of(spark, values, function):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["x"] for r in df.select("i", function(F.col("v")).alias("x")).orderBy("i").collect()]


def test_strip_knows_all_white_space(spark):
    every = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    assert sorted(WHITE_SPACE) == every
    values = [f"{c}a{c}b{c}" for c in every]
    assert column_of(spark, values, strip) == [v.strip() for v in values]


def test_iso_timestamps(spark):
    cases = {
        "2024-01-15T09:00:00Z": datetime(2024, 1, 15, 9),
        "2024-01-15T09:00:00": datetime(2024, 1, 15, 9),
        "2024-01-15 09:00": datetime(2024, 1, 15, 9),
        "2024-01-15": datetime(2024, 1, 15),
        "2024-01-15T09:00:00.123456": datetime(2024, 1, 15, 9, 0, 0, 123456),
        "2024-01-15T09:00:00.5": datetime(2024, 1, 15, 9, 0, 0, 500000),
        # The clock reading stays, the zone is replaced.
        "2024-01-15T09:00:00+05:00": datetime(2024, 1, 15, 9),
        "2024-W03-1": datetime(2024, 1, 15),
        "2024W031T05:06": datetime(2024, 1, 15, 5, 6),
        "2024-W03": datetime(2024, 1, 15),
        "2020-W53-7": datetime(2021, 1, 3),
        "2021-W53-1": None,
        "20240115": datetime(2024, 1, 15),
        "2024-0115": None,
        "2024-02-30T09:00:00": None,
        "15/01/2024": None,
        "bad": None,
        "": None,
        None: None,
    }
    assert column_of(spark, list(cases), parse_iso) == list(cases.values())


def test_due_dates(spark):
    cases = {
        "2024-03-05": datetime(2024, 3, 5),
        "03/05/2024": datetime(2024, 3, 5),
        "3/5/2024": datetime(2024, 3, 5),
        "05-Mar-2024": datetime(2024, 3, 5),
        "05-MAR-2024": datetime(2024, 3, 5),
        "2024/03/05": datetime(2024, 3, 5),
        "March 5, 2024": datetime(2024, 3, 5),
        "March 05, 2024": datetime(2024, 3, 5),
        "May 05, 2024": datetime(2024, 5, 5),
        "Mar 5, 2024": datetime(2024, 3, 5),
        "5 March 2024": datetime(2024, 3, 5),
        # Month first; day first only where that is impossible.
        "13/02/2024": datetime(2024, 2, 13),
        "02/13/2024": datetime(2024, 2, 13),
        "02/30/2024": None,
        "2024-03-05 10:11": datetime(2024, 3, 5, 10, 11),
        "2024-03-05T10:11:12": datetime(2024, 3, 5, 10, 11, 12),
        "2024-03-05 10:11:12.25": datetime(2024, 3, 5, 10, 11, 12, 250000),
        "2024-03-05T10:11:12+05:00": datetime(2024, 3, 5, 10, 11, 12),
        " 2024-03-05 ": datetime(2024, 3, 5),
        "03/05/24": datetime(2024, 3, 5),
        "13/05/24": datetime(2024, 5, 13),
        "03/05/2024 3:30 PM": datetime(2024, 3, 5, 15, 30),
        "12/31/2024 12:00 AM": datetime(2024, 12, 31),
        "March 5 2024": datetime(2024, 3, 5),
        "mar 5 2024": datetime(2024, 3, 5),
        "20240305": datetime(2024, 3, 5),
        "2024.03.05": datetime(2024, 3, 5),
        "Sept 5, 2024": datetime(2024, 9, 5),
        "5-March-2024": datetime(2024, 3, 5),
        "5th March 2024": datetime(2024, 3, 5),
        "5-Mar-24": datetime(2024, 3, 5),
        "12/31/2024 13:00 PM": None,
        "Juno 5, 2024": None,
        "99/99/9999": None,
        "soon": None,
        "": None,
        "  ": None,
        None: None,
    }
    assert column_of(spark, list(cases), parse_due_date) == list(cases.values())


def test_printed_timestamps(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 15, 9),), (datetime(2024, 1, 15, 9, 0, 0, 1500),), (None,)], "t timestamp"
    )
    rows = df.select(print_for_tag(F.col("t")).alias("tag"), print_iso(F.col("t")).alias("iso")).collect()
    assert [r["tag"] for r in rows] == [
        "2024-01-15 09:00:00+00:00", "2024-01-15 09:00:00.001500+00:00", "NaT",
    ]
    assert [r["iso"] for r in rows] == [
        "2024-01-15T09:00:00+00:00", "2024-01-15T09:00:00.001500+00:00", None,
    ]


def test_text_composition(spark):
    df = spark.createDataFrame([("Ann", "note"), ("", "note"), ("Ann", ""), ("", ""), (" ", " x ")], "a string, b string")
    rows = df.select(join_nonempty(F.col("a"), F.col("b")).alias("t")).collect()
    assert [r["t"] for r in rows] == ["Ann note", "note", "Ann", "", "x"]


def test_stable_id(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 1)], "s string, n int")
    ids = [r["i"] for r in df.select(stable_id(F.col("s"), F.col("n")).alias("i")).collect()]
    assert all(UUID.fullmatch(i) for i in ids)
    assert ids[0] == ids[2] != ids[1]


@pytest.fixture
def folder(tmp_path):
    def write(name, content):
        path = tmp_path / name
        path.write_bytes(content.encode())
        return str(path)

    return write


def test_chat(spark, folder):
    path = folder(
        "chat.json",
        json.dumps(
            [
                {"user_id": "U1", "username": "bob", "timestamp": "2024-01-15T09:00:00Z", "channel": "c", "text": "hi"},
                {"user_id": "U2", "timestamp": "bad", "text": None},
                {"channel": None},
            ]
        ),
    )
    loaded = read_chat(spark, path)
    rows = loaded.records.orderBy(F.col("text").desc_nulls_last()).collect()
    assert loaded.records.columns == UNIFIED_COLUMNS
    assert [r["text"] for r in rows] == ["hi", "", None]
    assert [r["timestamp"] for r in rows] == [datetime(2024, 1, 15, 9), None, None]
    assert json.loads(rows[0]["raw_metadata"]) == {"channel": "c", "username": "bob", "user_id": "U1"}
    # A missing field is an empty string, an explicit null stays null.
    assert json.loads(rows[1]["raw_metadata"]) == {"channel": None, "username": "", "user_id": ""}
    assert len({r["record_id"] for r in rows}) == 3
    assert all(r["source_file"] == path and r["source_format"] == "slack" for r in rows)
    assert [r["record_id"] for r in loaded.records.collect()] == [r["record_id"] for r in loaded.records.collect()]


def test_chat_lines(spark, folder):
    path = folder("chat.jsonl", '{"text": "a"}\n{"text": \n{"text": "b", "extra": 1}\n')
    loaded = read_chat(spark, path, multiline=False)
    assert sorted(r["text"] for r in loaded.records.collect()) == ["a", "b"]
    assert loaded.records.count() == 2 and loaded.rejects.count() == 1


def test_broken_chat_file_is_rejected(spark, folder):
    loaded = read_chat(spark, folder("bad.json", '[{"text": "a"}, {"text":'))
    assert loaded.records.count() == 0
    assert loaded.rejects.count() == 1


CSV = (
    "record_id,assignee_name,assignee_email,due_date,notes\n"
    '1,Ann,a@b.co,2024-03-05,"says ""x"",\nsecond line"\n'
    "1,Copy,,,\n"
    ",Zed,,15-Mar-2024,\n"
    ",Zed,,15-Mar-2024,\n"
    " ,Blank,,,n\n"
    "1 ,Padded,,,\n"
    "5,,,soon,\n"
    "6,Short\n"
    "7,Too,many,fields,here,x\n"
)


def test_tabular(spark, folder):
    path = folder("r.csv", CSV)
    loaded = read_tabular(spark, path)
    rows = {r["text"]: r for r in loaded.records.collect()}
    assert loaded.records.count() == 7
    first = rows['Ann says "x",\nsecond line']
    assert first["record_id"] == "1" and first["timestamp"] == datetime(2024, 3, 5)
    meta = json.loads(first["raw_metadata"])
    assert meta == {
        "record_id": "1", "assignee_name": "Ann", "assignee_email": "a@b.co", "due_date": "2024-03-05",
        "notes": 'says "x",\nsecond line',
    }
    # Ids are compared as they are: the padded one is another id.
    assert rows["Padded"]["record_id"] == "1 " and "Copy" not in rows
    # Equal rows without an id are two records.
    assert loaded.records.where("text = 'Zed'").select("record_id").distinct().count() == 2
    repaired = json.loads(rows["Blank n"]["raw_metadata"])
    assert repaired["record_id_was_missing"] is True and repaired["record_id"] == rows["Blank n"]["record_id"]
    assert UUID.fullmatch(repaired["record_id"])
    assert rows[""]["timestamp"] is None
    assert loaded.rejects.first()["raw"].startswith("7,Too")
    counters = loaded.counters.first()
    assert (counters["rows_read"], counters["ids_repaired"], counters["duplicates_dropped"]) == (8, 3, 1)


def test_dedup_is_per_file(spark, folder):
    folder("d1.csv", "record_id,notes\n1,a\n1,b\n")
    path = folder("d2.csv", "record_id,notes\n1,c\n")
    texts = [r["text"] for r in read_tabular(spark, [path, path.replace("d2", "d1")]).records.collect()]
    assert sorted(texts) == ["a", "c"]


def test_dedup_collapses_a_hot_id_before_the_shuffle(spark, folder):
    raw = spark.range(200_000, numPartitions=8).select(
        F.lit("f").alias("source_file"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("record_id"),
        F.lit(0).cast("long").alias(ingest.SPLIT),
        F.col("id").alias(ingest.ROW),
    )
    kept = raw.transform(ingest.keep_first)
    assert plan_of(kept).count("WindowGroupLimit") == 2
    assert kept.where("record_id = 'hot'").select(ingest.ROW).collect() == [(0,)]
    assert kept.count() == 200_000 - 66_667 + 1


def test_keep_first_over_many_splits(spark, folder):
    lines = "".join(f"{i % 500},{i:06d} {'x' * 40}\n" for i in range(20_000))
    path = folder("big.csv", "record_id,notes\n" + lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        loaded = read_tabular(spark, path, multiline=False)
        kept = sorted(int(r["text"][:6]) for r in loaded.records.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert kept == list(range(500))


def model_blocks(content):
    """What a file yields, worked out on the whole text at once."""
    content = content.replace("\r\n", "\n").replace("\r", "\n")
    blocks = [b.strip() for b in re.split("\n\n", content) if b.strip()]
    return blocks if len(blocks) > 1 else [line.strip() for line in content.splitlines() if line.strip()]


@pytest.mark.parametrize(
    "content",
    [
        "one\ntwo\n\nthree\n",
        "one\n\n\n\ntwo\n\n\nthree",
        "\n\none\ntwo\n\n",
        "one\ntwo\nthree",
        "one\r\ntwo\r\n\r\nthree\r\n",
        "one\n \ntwo\n\n  \n\n\tthree\n \nfour\n",
        "a\x0bb\x0cc\x1cd\x85e f\n",
        "a\x0bb\n\nc d\n",
        "  \n\n  \n",
        "single",
        "\n",
        "a\r\rb\rc",
        "a\rb\rc\r",
        "a\r\nb\r\nc",
        "a\r\r\nb\r\n",
    ],
)
def test_blocks(spark, folder, content):
    path = folder("t.txt", content)
    rows = read_blocks(spark, path).records.collect()
    assert sorted(r["text"] for r in rows) == sorted(model_blocks(content))
    assert len({r["record_id"] for r in rows}) == len(rows)
    assert all(r["raw_metadata"] == "{}" and r["timestamp"] is not None for r in rows)


@pytest.mark.parametrize("kinds", ["blocks", "lines", "both", "returns"])
def test_blocks_over_many_splits(spark, folder, kinds):
    rng = random.Random(3)
    pieces = ["word ", "line\n", "\n", "\n\n", "\n\n\n", "é ", "  \n"]
    blocky = "".join(rng.choice(pieces) for _ in range(40_000))
    flat = "\n\n" + "".join(f"line {i}\n" for i in range(20_000)) + "\n \n"
    contents = {
        "blocks": [blocky],
        "lines": [flat],
        "both": [blocky, flat],
        "returns": [blocky.replace("\n", "\r\n")],
    }[kinds]
    paths = [folder(f"{kinds}{i}.txt", content) for i, content in enumerate(contents)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        records = read_blocks(spark, paths).records
        rows = records.select("source_file", "text").collect()
        # Block and line files are cut by the reader, also side by side: no text moves.
        moved = any("value#" in columns for columns in shuffled_columns(records))
        assert moved == (kinds == "returns")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for path, content in zip(paths, contents):
        assert sorted(r["text"] for r in rows if r["source_file"] == path) == sorted(model_blocks(content))


def test_ids_depend_on_the_file_alone(spark, tmp_path):
    """Other files, cores and the packing of small files do not change an id."""
    raw = tmp_path / "raw"
    raw.mkdir()
    chat = [{"user_id": "u", "text": f"m{i % 3}"} for i in range(20)]
    kinds = {
        "k.txt": (read_blocks, "same\n" * 30),
        "k.csv": (read_tabular, "record_id,notes\n" + ",x\n" * 25),
        "k.json": (read_chat, json.dumps(chat)),
    }
    for name, (reader, content) in kinds.items():
        folder = raw / name
        folder.mkdir()
        (folder / f"m-{name}").write_text(content)

        def ids():
            rows = reader(spark, str(folder)).records
            return sorted(r[0] for r in rows.where(F.col("source_file").contains("m-")).select("record_id").collect())

        before = ids()
        assert len(set(before)) == len(before) >= 20
        for i in range(5):
            (folder / f"{i} é {name}").write_text(content)
        assert ids() == before
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
        try:
            assert ids() == before
        finally:
            spark.conf.set("spark.sql.files.minPartitionNum", "4")


def test_every_csv_file_is_read_by_its_own_header(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.csv").write_text("record_id,assignee_name,notes\n1,Ann,n1\n")
    (raw / "b.csv").write_text("notes,record_id,assignee_name\nsecret note,77,Zoe\n")
    (raw / "c.csv").write_text("record_id,assignee_name,notes,extra\n5,Bob,n5,e5\n6,Bea\n")
    (raw / "d.csv").write_text("record_id,assignee_name,notes\n8,Cy,,SURPLUS a@b.co\n9,\"q,\"\"x\"\",\",\n")
    loaded = read_tabular(spark, str(raw))
    rows = {r["record_id"]: r for r in loaded.records.collect()}
    assert {k: r["text"] for k, r in rows.items()} == {
        "1": "Ann n1", "77": "Zoe secret note", "5": "Bob n5", "6": "Bea", "9": 'q,"x",',
    }
    assert json.loads(rows["5"]["raw_metadata"])["extra"] == "e5"
    assert "extra" not in json.loads(rows["1"]["raw_metadata"])
    assert [r["raw"] for r in loaded.rejects.collect()] == ["8,Cy,,SURPLUS a@b.co"]
    (raw / "e.csv").write_text("no_id,notes\n1,x\n")
    again = read_tabular(spark, str(raw))
    assert again.records.count() == 5 and len(again.failures) == 1


def test_unify_and_tag(spark, folder):
    out = ingest_all(
        spark,
        {
            folder("a.json", '[{"text": "a", "timestamp": "2024-01-15T09:00:00Z"}, {"text": "b"}]'): "slack",
            folder("b.csv", "record_id,notes\n1,c\n"): "csv",
            folder("c.txt", "d\n"): "plaintext",
            folder("d.csv", "no_id\n1\n"): "csv",
            "/nowhere/e.json": "slack",
        },
    )
    assert out.records.schema.simpleString() == TAGGED_SCHEMA.simpleString()
    assert len(out.failures) == 2 and "load error" in out.failures[0]
    tags = {r["text"]: r["source_lineage_tag"] for r in out.records.collect()}
    assert tags["a"].startswith("slack::/") and tags["a"].endswith("a.json::2024-01-15 09:00:00+00:00")
    assert tags["b"].endswith("::NaT") and tags["c"].endswith("b.csv::NaT")
    counts = {r["source_format"]: r["records"] for r in ingest.count_by_format(out.records).collect()}
    assert counts == {"slack": 2, "csv": 1, "plaintext": 1}
    broken = [(r["rule"], r["bad_rows"]) for r in out.violations.collect()]
    assert broken == [("timestamp is null", 1)]


def test_no_source_loads(spark):
    out = ingest_all(spark, {"/nowhere/a.csv": "csv"})
    assert out.records.columns == [*UNIFIED_COLUMNS, "source_lineage_tag"]
    assert out.records.count() == 0 and len(out.failures) == 1


def unified(spark, *rows):
    schema = (
        "record_id string, source_format string, source_file string, timestamp timestamp, text string, "
        "raw_metadata string"
    )
    return spark.createDataFrame(list(rows), schema)


def test_validation_rules(spark):
    now = datetime(2024, 1, 1)
    df = unified(
        spark,
        ("", "slack", "a", now, "x", "{}"),
        (None, "slack", "a", None, None, "{}"),
        ("1", "csv", "b", None, "", "{}"),
        ("1", "csv", "b", now, "", "{}"),
        ("1", "csv", "c", now, "", "{}"),
        ("2", "plaintext", "d", now, " \n", "{}"),
        ("3", "plaintext", "d", now, "ok", "{}"),
    )
    found = {(r["source_file"], r["rule"]): r["bad_rows"] for r in ingest.validate(df).collect()}
    assert found == {
        ("a", "record_id is null or empty"): 2,
        ("a", "text is null"): 1,
        ("a", "timestamp is null"): 1,
        ("b", "record_id is duplicated"): 1,
        ("d", "text is blank"): 1,
    }


def test_profile_and_preview(spark):
    now = datetime(2024, 1, 1, 10)
    df = unified(
        spark,
        ("id-000000001", "csv", "b", now, "line\n" + "x" * 80, "{}"),
        ("id-000000002", "csv", "b", None, "", "{}"),
        ("id-000000003", "csv", "b", now, None, "{}"),
    )
    assert ingest.ingest_profile(df).first().asDict() == {
        "source_format": "csv", "records": 3, "null_timestamps": 1, "empty_texts": 2,
    }
    rows = [r.asDict() for r in ingest.preview(df).orderBy("nth").collect()]
    assert rows[0] == {
        "source_format": "csv", "nth": 1, "record_id": "id-00000", "timestamp": "2024-01-01 10:00:00",
        "text": "line " + "x" * 50,
    }
    assert len(rows) == 2 and rows[1]["timestamp"] == "NaT"
    assert "WindowGroupLimit" in plan_of(ingest.preview(df))


def test_texts_of_mixed_files_are_shuffled_once_to_be_counted(spark, tmp_path):
    """Copies are counted, and no second shuffle of the texts serves the count of ids."""
    from conftest import shuffled_columns
    from curaspan.plans.catalog import text_mixed

    texts = [("same text",), ("same text",), ("two\nlines",), (None,), ("",), ("a",)]
    spark.createDataFrame(texts, "text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    names = [("C1", "A"), ("C1", "A"), ("C2", "B")]
    customers = spark.createDataFrame(names, "c_name string, c_mktsegment string")
    customers.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    df = text_mixed(spark, str(tmp_path))
    rows = {r["text"]: (r["source_format"], r["n"], r["ids"]) for r in df.collect()}
    assert len(rows) == df.count() and {r[1:] for r in rows.values()} == {(4, 4), (2, 2), (1, 1)}
    assert rows["same text"][1:] == (4, 4) and rows["C1, A"][1:] == (2, 2) and rows["C2, B"][1:] == (1, 1)
    assert sum("text#" in columns and "record_id#" in columns for columns in shuffled_columns(df)) == 0
