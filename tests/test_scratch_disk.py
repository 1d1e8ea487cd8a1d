"""What runs keep on disk: shuffle files, written views and text sources."""

from __future__ import annotations

import gzip
import os
import time

import pytest
from conftest import rows

from tallyhouse import session
from tallyhouse.operators import quality as Q
from tallyhouse.plans import audit, catalog
from tallyhouse.session import RELEASE, released_shuffles, releasing_shuffles
from tallyhouse.sources.csv import discover_csv_files, load_csv
from tallyhouse.sources.testbed import Testbed

FOLDER = "/root/testdata/sf0.001"


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {name for name in manager.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in name}


def settled(condition):
    """Spark deletes shuffle files in the background."""
    until = time.time() + 20
    while not condition() and time.time() < until:
        time.sleep(0.2)
    return condition()


@pytest.fixture
def scratch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_shared_setting", lambda _: str(tmp_path))
    return tmp_path


def test_a_run_deletes_the_shuffles_of_each_query(spark, tmp_path):
    counts = spark.range(1000).selectExpr("id % 7 AS k")
    before, seen = shuffle_files(spark), []

    @releasing_shuffles
    def run(spark, path):
        counts.groupBy("k").count().write.parquet(path)
        seen.append(settled(lambda: not shuffle_files(spark) - before))
        return counts.groupBy("k").count().orderBy("k").collect()

    setting = spark.conf.get(RELEASE, None)
    assert [r["count"] for r in run(spark, f"{tmp_path}/t")] == [143] * 6 + [142]
    assert seen == [True] and settled(lambda: not shuffle_files(spark) - before)
    assert spark.conf.get(RELEASE, None) == setting


def test_a_frame_run_twice_counts_alike(spark):
    with released_shuffles(spark):
        frame = spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count()
        assert sorted(frame.collect()) == sorted(frame.collect())


def test_part_files_may_be_gzip(spark, tmp_path):
    (tmp_path / "t.csv").mkdir()
    (tmp_path / "t.csv" / "part-0.csv").write_text("a,b\n1,x\n")
    with gzip.open(tmp_path / "t.csv" / "part-1.csv.gz", "wt") as file:
        file.write('a,b\n2,"one,\ntwo ""three"""\n3,\n')
    with gzip.open(tmp_path / "alone.csv.gz", "wt") as file:
        file.write("a\n1\n")
    found = discover_csv_files(spark, str(tmp_path))
    assert sorted(rows(found, "relative_path")) == ["t.csv/part-0.csv", "t.csv/part-1.csv.gz"]
    assert {r.file_name for r in found.collect()} == {"t.csv"}
    read = load_csv(spark, f"{tmp_path}/t.csv")
    assert sorted(map(tuple, read.collect()), key=str) == [("1", "x"), ("2", 'one,\ntwo "three"'), ("3", None)]


def test_sources_are_written_small_and_their_view_goes(spark, scratch):
    tb = Testbed(spark, FOLDER)
    folder = catalog.written_sources(tb)
    assert [p.name.split("-")[0] for p in scratch.iterdir()] == ["sources"]
    parts = [(where, name) for where, _, names in os.walk(folder) for name in names if name.startswith("part-")]
    assert parts and all(name.endswith(".csv.gz") for _, name in parts)
    packed = sum(os.path.getsize(f"{where}/{name}") for where, name in parts)
    plain = sum(len(gzip.open(f"{where}/{name}").read()) for where, name in parts)
    assert packed * 2 < plain
    for table in ("order_payments", "order_reviews"):
        written = load_csv(spark, f"{folder}/archive/{catalog.MARKETPLACE.file_name(table)}")
        assert sorted(map(str, written.collect())) == sorted(map(str, catalog.good_sources(tb)[table].select(*written.columns).collect()))


def test_the_audit_leaves_its_reports_only(spark, scratch):
    found = {r.table_name: r.row_count for r in catalog.CATALOG["snk_02_audit_report_set"](Testbed(spark, FOLDER)).collect()}
    assert set(found) == set(audit.REPORTS) - {"audit_summary"} and found["table_overview"] == 9
    assert [p.name.split("-")[0] for p in scratch.iterdir()] == ["reports"]


def test_parsed_sources_go_before_the_gates_of_cleaned_tables(spark, scratch, monkeypatch):
    kept, facts = [], Q.shared_key_facts

    def watched(tables, *args):
        (landing,) = scratch.glob("landing-*")
        kept.append({p.name for p in landing.iterdir() if not p.name.startswith((".", "_"))})
        return facts(tables, *args)

    monkeypatch.setattr(Q, "shared_key_facts", watched)
    folder, run = catalog.cleaning_run(Testbed(spark, FOLDER))
    assert len(kept) == 2 and len(kept[0]) == 9 and not kept[1]
    assert {r.table_name: r.input_rows for r in run.lineage.collect()}["customers"] == Testbed(spark, FOLDER)["customer"].count()
    assert [entry["source_sha256"] is None for entry in run.manifest["tables"]].count(True) == 1
    assert {p.name.split("-")[0] for p in scratch.iterdir()} == {"run", "median"}
    (version,) = (scratch / os.path.basename(folder) / "processed" / "versions").glob("[!.]*")
    assert all(p.name.endswith(".zstd.parquet") for p in version.rglob("part-*"))
