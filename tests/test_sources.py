from __future__ import annotations

import hashlib

import pytest
from conftest import rows
from pyspark.errors import PySparkException

from tallyhouse.sources import csv as source
from tallyhouse.sources import sinks
from tallyhouse.sources.records import file_blocks


def test_discovery_is_recursive_case_insensitive_and_sorted(spark, tmp_path):
    (tmp_path / "extracted_dataset").mkdir()
    for name in ("b.CSV", "a.csv", "extracted_dataset/c.csv", "notes.txt"):
        (tmp_path / name).touch()
    found = source.discover_csv_files(spark, str(tmp_path))
    assert rows(found, "relative_path") == ["a.csv", "b.CSV", "extracted_dataset/c.csv"]
    assert rows(found, "file_name") == ["a.csv", "b.CSV", "c.csv"]


def test_discovery_of_a_missing_folder_raises(spark, tmp_path):
    with pytest.raises(NotADirectoryError):
        source.discover_csv_files(spark, str(tmp_path / "absent")).collect()


def test_part_files_of_a_folder_are_one_table(spark, tmp_path):
    spark.range(100).selectExpr("id", "id * 2 AS twice").repartition(4).write.option("header", True).csv(
        str(tmp_path / "deep" / "numbers.csv")
    )
    paths = source.source_table_paths(spark, str(tmp_path))
    assert list(paths) == ["numbers.csv"]
    assert source.load_csv(spark, paths["numbers.csv"]).count() == 100


def test_part_files_with_other_headers_raise(spark, tmp_path):
    (tmp_path / "a.csv").mkdir()
    (tmp_path / "a.csv" / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "a.csv" / "2.csv").write_text("b,a\n1,2\n")
    with pytest.raises(source.CsvError, match="different headers, a,b and b,a"):
        source.load_csv(spark, str(tmp_path / "a.csv"))


def test_same_file_name_twice_raises(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "a.csv").write_text("id\n1\n")
    (tmp_path / "x" / "a.csv").write_text("id\n2\n")
    with pytest.raises(ValueError, match="exists twice"):
        source.load_source_tables(spark, str(tmp_path))


def test_missing_tokens_quotes_and_lines(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('id,text\n1,NA\n2,"two\nlines, ""quoted"""\n3,  kept  \n4,""\n5\n\n6,n/a \n', encoding="utf-8")
    assert file_blocks(spark, str(path)).spans_lines
    found = {row.id: row.text for row in source.load_csv(spark, str(path)).collect()}
    assert found == {"1": None, "2": 'two\nlines, "quoted"', "3": "  kept  ", "4": None, "5": None, "6": "n/a "}


def test_file_without_open_quotes_is_split_by_lines(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('id,text\n1,"a ""b"" c"\n2,d\n', encoding="utf-8")
    assert not file_blocks(spark, str(path)).spans_lines
    assert rows(source.load_csv(spark, str(path)).orderBy("id"), "text") == ['a "b" c', "d"]


def test_long_records_and_broken_text_are_errors(spark, tmp_path):
    (tmp_path / "long.csv").write_text('a,b\n1,"x, y"\n1,2,3\n')
    long_record = source.load_csv(spark, str(tmp_path / "long.csv"))
    with pytest.raises(PySparkException, match="more than 2 fields"):
        long_record.collect()
    with pytest.raises(PySparkException, match="more than 2 fields"):
        long_record.count()
    (tmp_path / "bytes.csv").write_bytes(b"a,b\n1,\xff\xfe\n")
    with pytest.raises(ValueError, match="UTF-8"):
        source.load_csv(spark, str(tmp_path / "bytes.csv"))
    with pytest.raises(FileNotFoundError):
        source.load_csv(spark, str(tmp_path / "absent.csv"))
    with pytest.raises(ValueError, match="is no .csv file"):
        source.load_csv(spark, str(tmp_path / "a.txt"))


def test_errors_stay_with_their_file(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "good.csv").write_text("order_id,created_at\na,2024-01-01\nb,bad\n")
    (raw / "long.csv").write_text("a\n1,2\n")
    (raw / "empty.csv").write_text("")
    audit, tables, errors = source.audit_csv_directory(spark, str(raw), str(tmp_path / "work"))
    assert list(tables) == ["good.csv"]
    assert set(errors) == {"long.csv", "empty.csv"}
    assert rows(audit.keys, "column_name") == ["order_id"]


def test_csv_round_trip_keeps_every_text(spark, tmp_path):
    texts = ['plain', ' spaces ', 'comma, "quote"', "line\nbreak", "back\\slash", "ünï", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    sinks.write_csv(df, str(tmp_path / "t.csv"))
    back = source.load_csv(spark, str(tmp_path / "t.csv"))
    assert {int(r.id): r.text for r in back.collect()} == dict(enumerate(texts))


def test_digests_equal_sha256_of_the_bytes(spark, tmp_path):
    (tmp_path / "x").mkdir()
    contents = {"x/a.bin": b"abc" * 10_000, "x/b.bin": b"xyz"}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    expected = {hashlib.sha256(content).hexdigest() for content in contents.values()}
    assert set(rows(sinks.file_digests(spark, str(tmp_path / "x")), "sha256")) == expected
    one = sinks.table_digests(spark, {"a": str(tmp_path / "x" / "a.bin"), "all": str(tmp_path / "x")})
    assert {r.table_name: r.files for r in one.collect()}["all"] >= 1


def test_digest_of_a_file_beyond_one_value(spark, tmp_path):
    """A sparse file of more than 2 GB, and one just beyond the values that the JVM digests."""
    size = (2 << 30) + 12_345
    for name, length in (("big.bin", size), ("with space.bin", sinks.VALUE_BYTES + 1), ("small.bin", 10)):
        with open(tmp_path / name, "wb") as file:
            file.truncate(length)
    expected = {}
    for path in tmp_path.iterdir():
        with open(path, "rb") as file:
            expected[path.name] = hashlib.file_digest(file, "sha256").hexdigest()
    found = {row.path.rsplit("/", 1)[-1].replace("%20", " "): row for row in sinks.file_digests(spark, str(tmp_path)).collect()}
    assert {name: row.sha256 for name, row in found.items()} == expected
    assert found["big.bin"].length == size


def test_json_sink(spark, tmp_path):
    sinks.write_json(spark, {"a": 1, "b": ["ü", None]}, str(tmp_path / "m.json"))
    assert sinks.read_json(spark, str(tmp_path / "m.json")) == {"a": 1, "b": ["ü", None]}
