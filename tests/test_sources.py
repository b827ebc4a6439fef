"""Raw scan, samples, side tables and writers."""

import json

import pytest
import zstandard
from pyspark.sql import functions as F

from scanledger import schemas
from scanledger.functions.common import to_bigint
from scanledger.operators import evaluate, quality
from scanledger.operators.ingest import flatten_hosts
from scanledger.plans import build, reports
from scanledger.sources import readers, writers
from tests.helpers import rows_of

RECORD = {
    "ip_str": "10.0.0.1", "port": 443, "transport": "tcp",
    "timestamp": "2024-01-01T00:00:07.179575", "hostnames": ["www.firm.de"],
    "domains": ["firm.de"],
    "location": {"country_code": "DE", "country_name": "Germany", "city": None,
                 "latitude": 52.5, "longitude": 13},
    "org": "Firm GmbH", "isp": None, "asn": "AS1", "tags": ["c2"],
    "vulns": {"CVE-2025-1": {"cvss": 7.5, "verified": True, "epss": "0.5"}},
    "http": {"status": 200}, "screenshot": {"labels": ["windows"], "text": ""},
    "data": "payload that no one reads", "opts": {"deep": [1, {"x": 2}]},
}


def hosts_of(spark, path):
    return flatten_hosts(readers.scan_raw_records(spark, str(path)))


def write_lines(path, *lines):
    path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")
    return path


def test_flat_record(spark, tmp_path):
    table = hosts_of(spark, write_lines(tmp_path / "a.json", RECORD))
    assert tuple(table.columns) == schemas.HOST_COLUMNS
    row = table.first()
    assert (row.port, row.latitude, row.longitude, row.http_status) == (443, 52.5, 13.0, 200)
    assert row.vulns["CVE-2025-1"].epss == 0.5 and row.vulns["CVE-2025-1"].verified is True
    assert row.screenshot_text is None and row.screenshot_labels == ["windows"]
    assert row.is_c2 is True and row.is_vpn is False
    assert str(row.ts) == "2024-01-01 00:00:07.179575"


def test_a_malformed_cve_entry_does_not_void_the_others(spark, tmp_path):
    vulns = {
        "CVE-1": {"cvss": "7.5", "verified": "false", "summary": "a \"b\""}, "CVE-2": "bad",
        "CVE-3": None, "CVE-4": {"cvss": "high", "epss": 1}, "CVE-5": [1],
    }
    path = write_lines(tmp_path / "a.json", {"vulns": vulns}, {"vulns": []}, {"vulns": None})
    first, second, third = [r.vulns for r in hosts_of(spark, path).collect()]
    assert second is None and third is None
    assert {k: v and (v.cvss, v.verified, v.epss) for k, v in first.items()} == {
        "CVE-1": (7.5, False, None), "CVE-2": (None, None, None), "CVE-3": None,
        "CVE-4": (None, None, 1.0), "CVE-5": (None, None, None),
    }
    assert first["CVE-1"].summary == 'a "b"'


def test_types_of_the_hosts_table(spark, tmp_path):
    types = dict(hosts_of(spark, write_lines(tmp_path / "a.json", RECORD)).dtypes)
    assert types["port"] == types["http_status"] == "bigint"
    assert types["ts"] == "timestamp_ntz" and types["is_c2"] == "boolean"
    assert types["vulns"].startswith("map<string,struct<cvss:double")


def test_values_are_coerced_and_bad_lines_are_kept_as_null(spark, tmp_path):
    path = write_lines(
        tmp_path / "a.json",
        {"ip_str": "a", "port": "443"}, {"ip_str": "b", "port": 80.7},
        {"ip_str": "c", "port": "none"}, {"ip_str": "d", "hostnames": "not a list", "port": 1},
        '{"ip_str": "e", "port": ', "", {"ip_str": "f", "location": "nowhere", "port": 2},
    )
    got = rows_of(hosts_of(spark, path), "ip_str", "port")
    assert got == rows_of(spark.createDataFrame(
        [("a", 443), ("b", 81), ("c", None), ("d", 1), (None, None), ("f", 2)],
        "ip_str STRING, port BIGINT"))
    assert readers.rejected_lines(spark, str(path)).count() == 1


def test_to_bigint_rounds_and_keeps_large_numbers(spark):
    table = spark.createDataFrame([("80.5",), ("81.5",), ("9007199254740993",), ("x",)], "s STRING")
    assert [r[0] for r in table.select(to_bigint(F.col("s"))).collect()] == [
        80, 82, 9007199254740993, None
    ]


def test_compressed_and_huge_records(spark, tmp_path):
    huge = dict(RECORD, data="x" * 26_000_000)
    text = "\n".join(json.dumps(r) for r in (RECORD, huge)).encode()
    (tmp_path / "a.json.zst").write_bytes(zstandard.ZstdCompressor().compress(text))
    assert hosts_of(spark, tmp_path / "a.json.zst").filter(F.col("port") == 443).count() == 2


def test_scan_parses_only_what_is_read(spark, tmp_path):
    from tests.helpers import plan_of

    plan = plan_of(hosts_of(spark, write_lines(tmp_path / "a.json", RECORD)).select("ip_str"))
    assert "ReadSchema: struct<ip_str:string>" in plan


def test_sample(spark, tmp_path):
    path = write_lines(tmp_path / "a.json", *[{"a": n, "b": str(n)} for n in range(30)])
    sample = readers.sample_raw(spark, str(path), str(tmp_path / "out"), lines=20)
    assert rows_of(readers.sample_fields(sample)) == [("a", 20), ("b", 20)]


def test_manifest(spark, tmp_path):
    path = write_lines(tmp_path / "a.json", *[RECORD] * 50)
    row = writers.source_manifest(spark, str(path), average_record_bytes=100).first()
    assert row.size_bytes == path.stat().st_size and row.format == "json_lines"
    assert row.estimated_row_count == path.stat().st_size // 100
    assert writers.exact_row_count(spark, str(path)).first().row_count == 50


def test_contacts_last_record_wins_and_empty_ones_are_skipped(spark, tmp_path):
    def record(key, email):
        return {"company_key": key, "contact": email and {"email": email}, "raw_email_count": 1}

    path = write_lines(
        tmp_path / "c.jsonl", record("a", "1@a"), record("a", "2@a"), record("b", "1@b"),
        record("b", None), {"company_key": "c", "contact": {"email": ""}},
    )
    contacts = readers.scan_contacts(spark, str(path))
    assert rows_of(readers.usable_emails(contacts)) == [("a", "2@a"), ("b", "1@b")]


def test_traces(spark, tmp_path):
    assert readers.scan_traces(spark, str(tmp_path / "absent")).count() == 0
    path = write_lines(tmp_path / "t.jsonl", {"skill": "x", "request": {"a": 1}}, "", {"skill": "y"})
    assert json.loads(readers.scan_traces(spark, str(path), "x").first().request) == {"a": 1}


def test_empty_inline_table_keeps_its_schema(spark):
    table = readers.inline_table(spark, [], schemas.DECISION_RECORD)
    assert table.count() == 0 and "final_label" in table.columns


def test_jsonl_keeps_null_fields(spark, tmp_path):
    table = spark.createDataFrame([(1, None)], "a INT, b STRING")
    writers.write_jsonl(table, str(tmp_path / "o"))
    writers.write_jsonl(table, str(tmp_path / "o"), append=True)
    assert rows_of(spark.read.text(str(tmp_path / "o"))) == [('{"a":1,"b":null}',)] * 2


def test_whole_build_from_raw_lines(spark, tmp_path):
    records = [
        dict(RECORD, ip_str=f"10.0.0.{n}", org=f"Firm {n % 4} GmbH",
             domains=[f"firm{n % 3}.de"] if n % 2 else [],
             timestamp=f"2024-01-01T00:00:{n:02d}", tags=["eol-product"])
        for n in range(40)
    ]
    raw = write_lines(tmp_path / "raw.json", *records)
    layers = build.build(spark, str(raw), str(tmp_path / "out"))
    assert layers.hosts.count() == layers.keyed.count() == 40
    assert layers.companies.count() == layers.signals.count() == layers.accounts.count() == 5
    final = build.adjudicate(layers, str(tmp_path / "out"))
    assert final.count() == 5 and "final_label" in final.columns
    assert spark.read.parquet(str(tmp_path / "out/gold/accounts")).count() == 5
    direct = build.build_from_hosts(
        layers.hosts, str(tmp_path / "direct"), build.BuildRules(join_hosts_to_map=False)
    )
    assert rows_of(direct.accounts) == rows_of(layers.accounts)


def test_dated_snapshots_replace_only_their_partition(spark, tmp_path):
    raw = write_lines(tmp_path / "raw.json", RECORD, RECORD)
    out = str(tmp_path / "out")
    for day in ("2024-01-01", "2024-01-02", "2024-01-02"):
        assert build.ingest(spark, str(raw), out, snapshot_date=day).count() == 2
    stored = spark.read.parquet(f"{out}/silver/hosts")
    assert rows_of(stored.groupBy("snapshot_date").count(), "count") == [(2,), (2,)]


def test_reports_of_one_of_two_dated_exports(spark, tmp_path, capsys):
    from scanledger.__main__ import main

    out, exports = str(tmp_path / "out"), {"2024-01-01": 4, "2024-02-01": 7}
    for day, size in exports.items():
        records = [dict(RECORD, ip_str=f"10.0.0.{n}", domains=[f"{day[5:7]}firm{n}.de"]) for n in range(size)]
        raw = write_lines(tmp_path / f"{day}.json", *records, '{"broken": ')
        main(["build", "--raw", str(raw), "--out", out, "--snapshot-date", day])
        main(["adjudicate", "--out", out, "--snapshot-date", day])
    for day, size in exports.items():
        layers = build.read_layers(spark, out, day)
        raw = readers.line_counts(spark, str(tmp_path / f"{day}.json"))
        found = reports.quality_reports(layers, raw)
        checks = {r.check_name: r for r in found["layer_reconcile"].collect()}
        assert all(r.ok for r in checks.values())
        assert checks["raw_lines_vs_hosts"].left_n == size + 1 == layers.hosts.count()
        assert checks["rejected_lines_vs_empty_hosts"].left_n == 1
        assert found["signal_prevalence"].first().total == size
        assert {r.n for r in found["null_rates"].filter("column_name = 'ip_str'").collect()} == {1}
    capsys.readouterr()
    main(["report", "--out", out, "--raw", str(tmp_path / "2024-02-01.json")])
    assert "false" not in capsys.readouterr().out.split("layer_reconcile")[1]
    main(["accounts", "--out", out])
    latest = capsys.readouterr().out
    assert "02firm" in latest and "01firm" not in latest
    main(["accounts", "--out", out, "--snapshot-date", "2024-01-01"])
    assert "01firm" in capsys.readouterr().out
    with pytest.raises(ValueError, match="dated exports"):
        build.read_layers(spark, out)


def test_a_lost_record_fails_the_reconciliation(spark, tmp_path):
    raw = write_lines(tmp_path / "raw.json", *[dict(RECORD, ip_str=f"10.0.0.{n}") for n in range(6)], "", '[1]')
    layers = build.build(spark, str(raw), str(tmp_path / "out"))
    lines = readers.line_counts(spark, str(raw))

    def checks(**changed):
        given = {**vars(layers), **changed}
        table = quality.layer_reconcile(
            given["hosts"], given["keyed"], given["host_map"], given["companies"], given["signals"],
            given["accounts"], lines,
        )
        return {r.check_name: r.ok for r in table.collect()}

    assert all(checks().values())
    lost = layers.hosts.filter("ip_str <> '10.0.0.3' OR ip_str IS NULL")
    assert checks(hosts=lost)["raw_lines_vs_hosts"] is False


def test_array_lines(spark, tmp_path):
    """An array of records is no record; the JSON source takes it for several."""
    path = write_lines(tmp_path / "a.json", RECORD, json.dumps([RECORD, RECORD, RECORD]), "  ", "{}")
    assert readers.scan_raw_records(spark, str(path)).count() == 5
    records = readers.scan_raw_records(spark, str(path), array_lines_as_null=True)
    assert rows_of(flatten_hosts(records), "port") == rows_of(
        spark.createDataFrame([(443,), (None,), (None,)], "port BIGINT")
    )
    counts = readers.line_counts(spark, str(path)).first()
    assert (counts.raw_lines, counts.rejected_lines) == (3, 1)


def test_ingest_parses_with_a_task_per_split(spark, tmp_path):
    """The number of files is settled behind the parse, by a shuffle of the small result."""
    folder = tmp_path / "raw"
    folder.mkdir()
    for k in range(40):
        write_lines(folder / f"{k}.json", *[dict(RECORD, ip_str=f"10.{k}.0.{n}", data="x" * 5000) for n in range(20)])
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))
    try:
        splits = readers.scan_raw_records(spark, str(folder)).rdd.getNumPartitions()
        hosts = build.ingest(spark, str(folder), str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    assert splits == 40 and hosts.count() == 800
    assert len(list((tmp_path / "out/silver/hosts").glob("part-*"))) == 1


def test_model_decisions_in_a_run(spark, tmp_path):
    """Inputs out, replies and traces in, by company and tier."""
    from scanledger.__main__ import main

    records = [
        dict(RECORD, ip_str=f"10.0.0.{n}", domains=[f"firm{n % 4}.de"], tags=["eol-product"]) for n in range(24)
    ]
    raw, out = write_lines(tmp_path / "raw.json", *records), str(tmp_path / "out")
    main(["build", "--raw", str(raw), "--out", out])
    main(["inputs", "--out", out, "--to", str(tmp_path / "inputs")])
    inputs = [json.loads(r[0]) for r in spark.read.text(str(tmp_path / "inputs")).collect()]
    assert len(inputs) == 4 and json.loads(inputs[0]["account_json"])["company_key"] == inputs[0]["company_key"]
    said = ['{"label": "skip", "rationale": "r", "confidence": "high"}', "no JSON", '```json\n{"label": "contact"}\n```']
    replies = [
        {"company_key": f"firm{n}.de", "resolution_tier": "domain", "reply": text} for n, text in enumerate(said)
    ] + [{"company_key": "firm3.de", "resolution_tier": "org", "reply": said[0]}]
    main(["adjudicate", "--out", out, "--replies", str(write_lines(tmp_path / "replies.json", *replies))])
    table = spark.read.parquet(f"{out}/gold/accounts_adjudicated")
    assert rows_of(table, "company_key", "final_label", "confidence") == rows_of(spark.createDataFrame(
        [("firm0.de", "skip", "high"), ("firm1.de", "escalate", "low"), ("firm2.de", "contact", None),
         ("firm3.de", "review", None)], "a STRING, b STRING, c STRING"))
    traces = [
        {"ts": f"2024-01-0{n}", "skill": "account-scoring", "response": {"label": label},
         "request": {"company_key": "firm3.de", "input": {"resolution_tier": "domain"}}}
        for n, label in ((2, "contact"), (1, "skip"))
    ]
    main(["adjudicate", "--out", out, "--traces", str(write_lines(tmp_path / "traces.json", *traces))])
    spark.catalog.clearCache()
    table = spark.read.parquet(f"{out}/gold/accounts_adjudicated")
    assert rows_of(table.filter("final_label <> band"), "company_key", "final_label") == [("firm3.de", "contact")]


def test_repeated_run_replaces_its_report(spark, tmp_path):
    pairs = spark.createDataFrame(
        [("v1", 1, "skip", "skip", "m", 10, 10), ("v1", 1, "skip", "contact", "m", 10, 10), ("v1", 2, "skip", "skip", "m", 1, 1),
         ("v2", 1, "skip", "skip", "openai/gpt-oss-120b", 600, 75)],
        "prompt_version STRING, run_no BIGINT, predicted STRING, expected STRING, model STRING, input_tokens BIGINT, output_tokens BIGINT")
    path = str(tmp_path / "reports")
    report = evaluate.eval_report(pairs)
    writers.write_eval_report(report, path)
    writers.write_eval_report(report.filter("run_no = 2"), path)
    stored = writers.read_eval_reports(spark, path)
    assert stored.count() == 9
    assert rows_of(stored) == rows_of(report.select(*stored.columns))
    deltas = evaluate.eval_delta(evaluate.run_accuracy(stored))
    assert rows_of(deltas, "run_no", "accuracy_delta") == rows_of(
        spark.createDataFrame([(1, None), (2, 0.5), (1, None)], "a BIGINT, b DOUBLE"))
    assert stored.filter("prompt_version = 'v2'").first().total_cost_usd == 0.0001


def test_command_line(spark, tmp_path, capsys):
    from scanledger.__main__ import main

    raw = write_lines(tmp_path / "raw.json", *[dict(RECORD, ip_str=f"10.0.0.{n}") for n in range(9)])
    out = str(tmp_path / "out")
    main(["build", "--raw", str(raw), "--out", out])
    main(["accounts", "--out", out, "--country", "de"])
    assert "firm.de" in capsys.readouterr().out
    main(["adjudicate", "--out", out, "--sample", "3"])
    main(["account", "--out", out, "--key", "firm.de"])
    main(["report", "--out", out])
    printed = capsys.readouterr().out
    assert "firm.de" in printed and "hosts_vs_keyed" in printed
