"""Counts observed while layers are written, and repeated ingest of a growing export."""

import json
import os
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from scanledger.operators import quality
from scanledger.plans import ledger
from scanledger.plans.build import build, ingest, read_layers
from scanledger.schemas import HOST_BATCHES, HOSTS
from scanledger.sources.readers import REJECTED, line_counts, scan_raw_records
from scanledger.sources.writers import observed_write, read_counts
from tests.helpers import plan_of

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def record(n: int, **more) -> str:
    return json.dumps({"ip_str": f"10.0.0.{n}", "port": 443, "org": f"Firm {n} Ltd", "domains": [f"firm{n}.de"],
                       "timestamp": f"2024-01-01T00:00:{n:02d}", **more})


ODD_LINES = [
    '{"ip_str": "10.0.0.1", "port": ', "no json", '"text"', "7", "{}", '{"location": "not a struct"}',
    '{"ip_str": "10.0.0.9", "vulns": 5}', "", "   ", "[1, 2]", '{"ip_str": "10.0.0.8", "domains": "x"}', "null",
]


def counts_of(spark, out, layer=HOSTS, date=None):
    return {r.layer: r.counts for r in read_counts(spark, out, date).collect()}[layer]


@pytest.mark.parametrize("by_line", [False, True])
def test_one_parse_tells_rejected_lines(spark, tmp_path, by_line):
    lines = [record(n) for n in range(20)] + [x for x in ODD_LINES if not x.startswith("[")]
    (tmp_path / "raw.json").write_text("\n".join(lines) + "\n")
    path = str(tmp_path / "raw.json")
    expected = line_counts(spark, path).first()
    raw = scan_raw_records(spark, path, by_line, with_rejected=True)
    assert raw.count() == expected.raw_lines
    # the JSON source refuses to read nothing but the faulty lines
    assert raw.agg(F.count_if(REJECTED), F.count("ip_str")).first()[0] == expected.rejected_lines
    # a wrong value in an object is no rejected line
    assert not raw.filter("ip_str = '10.0.0.8' OR ip_str = '10.0.0.9'").select(F.max(REJECTED)).first()[0]


def test_ingest_counts_what_it_parses(spark, tmp_path):
    lines = [record(n) for n in range(20)] + [x for x in ODD_LINES if not x.startswith("[")]
    (tmp_path / "raw.json").write_text("\n".join(lines) + "\n")
    out = str(tmp_path / "out")
    hosts = ingest(spark, str(tmp_path / "raw.json"), out)
    lost = line_counts(spark, str(tmp_path / "raw.json")).first()
    counts = counts_of(spark, out)
    assert (counts["rows"], counts["rejected"]) == tuple(lost) and hosts.count() == lost.raw_lines
    assert counts["empty"] == hosts.filter("ip_str IS NULL AND org IS NULL").count()
    assert REJECTED not in hosts.columns
    # another date has counts of its own, and a repeated run replaces its own
    for _ in range(2):
        ingest(spark, str(tmp_path / "raw.json"), str(tmp_path / "dated"), "2024-01-31")
    ingest(spark, str(tmp_path / "raw.json"), str(tmp_path / "dated"), "2024-02-29")
    for date in ("2024-01-31", "2024-02-29"):
        assert counts_of(spark, str(tmp_path / "dated"), date=date) == counts
    assert read_counts(spark, str(tmp_path / "dated"), "2024-03-31").count() == 0


def test_counts_of_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "a INT")
    figures = {"rows": F.count(F.lit(1)), "sum": F.sum("a")}
    for rebalance in (False, True):
        assert observed_write(empty, str(tmp_path / "none"), figures, rebalance=rebalance) == {"rows": 0, "sum": 0}


def test_reconcile_reads_no_record_again(spark, tmp_path):
    (tmp_path / "raw.json").write_text("\n".join([record(n) for n in range(40)] + ["broken"]) + "\n")
    out = str(tmp_path / "out")
    build(spark, str(tmp_path / "raw.json"), out)
    (tmp_path / "raw.json").unlink()
    layers = read_layers(spark, out)
    checks = quality.reconcile_observed(read_counts(spark, out), layers.hosts, layers.companies, layers.signals)
    rows = {r.check_name: (r.left_n, r.right_n, r.ok) for r in checks.collect()}
    assert len(rows) == 10 and all(ok for *_, ok in rows.values())
    assert rows["raw_lines_vs_hosts"] == (41, 41, True) and rows["rejected_lines_vs_empty_hosts"] == (1, 1, True)
    assert "ReadSchema: struct<>" in plan_of(checks) and "json" not in plan_of(checks).lower().replace("to_json", "")
    # a file of the hosts table that is lost shows
    part = next((tmp_path / "out" / "silver" / "hosts").glob("*.parquet"))
    part.unlink()
    hosts = spark.read.parquet(f"{out}/{HOSTS}") if list(part.parent.glob("*.parquet")) else layers.hosts.limit(0)
    checks = quality.reconcile_observed(read_counts(spark, out), hosts, layers.companies, layers.signals)
    assert "raw_lines_vs_hosts" in {r.check_name for r in checks.collect() if not r.ok}


RETRIED = """
import os, sys
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from scanledger.sources.writers import observed_write

spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
spark.sparkContext.setLogLevel("OFF")

@F.udf("long")
def once_broken(value):
    context = TaskContext.get()
    if context.attemptNumber() == 0 and context.partitionId() % 2 == 0 and value % 50 == 49:
        raise RuntimeError("lost")
    return value

table = spark.range(0, 1000, 1, 8).select(once_broken("id").alias("a"))
figures = {"rows": F.count(F.lit(1)), "sum": F.sum("a")}
folder = sys.argv[1]
print("plain", observed_write(table, folder + "/plain", figures))
again = table.repartition(4, "a").select(once_broken("a").alias("a"))
print("behind", observed_write(again, folder + "/behind", figures, rebalance=True))
print("rows", spark.read.parquet(folder + "/plain").count(), spark.read.parquet(folder + "/behind").count())
"""


def test_counts_are_right_when_tasks_are_repeated(tmp_path):
    """Tasks of the stage that writes, and of the stages before it, fail once and run again."""
    done = subprocess.run(
        [sys.executable, "-c", RETRIED, str(tmp_path)], cwd=ROOT, capture_output=True, text=True, timeout=300,
        check=False,
    )
    assert done.returncode == 0, done.stderr[-3000:]
    counts = "{'rows': 1000, 'sum': 499500}"
    assert done.stdout.split("\n")[:3] == [f"plain {counts}", f"behind {counts}", "rows 1000 1000"]


# --- ledger ----------------------------------------------------------------------------------


def addresses(spark, out):
    return sorted(r.ip_str for r in ledger.current_hosts(spark, out).select("ip_str").collect())


def deliver(path, *numbers):
    path.write_text("".join(record(n) + "\n" for n in numbers))
    # the time of change has to differ, whatever the file system keeps of it
    stamp = time.time() - 1000 + 10 * sum(numbers)
    os.utime(path, (stamp, stamp))


def test_each_file_is_read_once(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    deliver(raw / "a b%20.json", 1, 2)
    deliver(raw / "b.json", 3)
    path = str(raw)
    assert ledger.ingest_new(spark, path, out) == 1
    assert ledger.ingest_new(spark, path, out) is None
    deliver(raw / "c.json", 4)
    # only the new file may be read
    for name in ("a b%20.json", "b.json"):
        (raw / name).chmod(0o000)
    assert ledger.ingest_new(spark, path, out) == 2
    counts = {r.layer: r.counts["rows"] for r in read_counts(spark, out).collect()}
    assert counts == {f"{HOST_BATCHES}/1": 3, f"{HOST_BATCHES}/2": 1}
    assert addresses(spark, out) == [f"10.0.0.{n}" for n in (1, 2, 3, 4)]


def test_a_changed_file_replaces_its_rows(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    deliver(raw / "a.json", 1, 2)
    deliver(raw / "b.json", 3)
    ledger.ingest_new(spark, str(raw), out)
    deliver(raw / "a.json", 7, 2)
    assert ledger.ingest_new(spark, str(raw), out) == 2
    assert addresses(spark, out) == ["10.0.0.2", "10.0.0.3", "10.0.0.7"]
    # back to an earlier state is a change as well
    deliver(raw / "a.json", 1, 2)
    assert ledger.ingest_new(spark, str(raw), out) == 3
    assert addresses(spark, out) == ["10.0.0.1", "10.0.0.2", "10.0.0.3"]
    assert ledger.ingest_new(spark, str(raw), out) is None
    (raw / "b.json").unlink()
    assert ledger.ingest_new(spark, str(raw), out) is None
    assert ledger.ingest_new(spark, str(raw), out, withdraw_missing=True) == 4
    assert addresses(spark, out) == ["10.0.0.1", "10.0.0.2"]
    deliver(raw / "b.json", 3)
    assert ledger.ingest_new(spark, str(raw), out, withdraw_missing=True) == 5
    assert addresses(spark, out) == ["10.0.0.1", "10.0.0.2", "10.0.0.3"]
    summary = ledger.batch_summary(spark, out).orderBy("batch").collect()
    assert [tuple(r) for r in summary] == [(1, 2, 0, 0, 3), (2, 1, 0, 0, 2), (3, 1, 0, 1, 2), (4, 0, 1, 0, 0), (5, 1, 0, 1, 1)]


def test_a_run_that_fails_before_its_commit_leaves_nothing(spark, tmp_path, monkeypatch):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    deliver(raw / "a.json", 1)
    ledger.ingest_new(spark, str(raw), out)
    deliver(raw / "b.json", 2)

    def lost(*_, **__):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(ledger, "write_parquet_zstd", lost)
        with pytest.raises(OSError, match="lost"):
            ledger.ingest_new(spark, str(raw), out)
    assert addresses(spark, out) == ["10.0.0.1"]
    assert ledger.ingest_new(spark, str(raw), out) == 3
    assert addresses(spark, out) == ["10.0.0.1", "10.0.0.2"]


def test_hosts_are_not_shuffled_to_leave_rows_out(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    deliver(raw / "a.json", 1)
    ledger.ingest_new(spark, str(raw), out)
    deliver(raw / "a.json", 2)
    ledger.ingest_new(spark, str(raw), out)
    plan = plan_of(ledger.current_hosts(spark, out))
    assert "BroadcastHashJoin" in plan and "PartitionFilters: [batch" in plan


def test_scratch_of_one_application_is_cleared(spark, tmp_path):
    from types import SimpleNamespace

    from scanledger.session import clear_scratch, scratch_dir

    assert not clear_scratch(spark)
    # the setting can't be changed in a running session
    shared = SimpleNamespace(conf={"spark.checkpoint.dir": str(tmp_path)}, sparkContext=spark.sparkContext)
    folder = scratch_dir(shared, "tables")
    assert folder.startswith(str(tmp_path)) and folder != scratch_dir(shared, "tables")
    spark.range(3).write.parquet(folder)
    (tmp_path / "other").mkdir()
    assert not clear_scratch(shared, "app-of-another-time")
    assert clear_scratch(shared) and not os.path.exists(folder) and (tmp_path / "other").exists()
    for wrong in ("..", "a/b", "."):
        with pytest.raises(ValueError, match="application"):
            clear_scratch(shared, wrong)
