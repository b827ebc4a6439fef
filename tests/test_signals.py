"""Signals: NULL rules, duplicate observations and the plan of their join."""

import datetime as dt
import re
from collections import defaultdict

from pyspark.sql import functions as F

from scanledger.config import SignalRules
from scanledger.functions.hosts import cve_features, recent_cve, tag_flags
from scanledger.operators import resolve, signals
from tests.helpers import host, hosts_table, plan_of, rows_of


def layers(spark, rows):
    hosts = signals.with_host_features(hosts_table(spark, rows))
    keyed = resolve.resolve_hosts(hosts)
    return hosts, keyed, resolve.host_company_map(keyed)


def mixed_rows():
    return [
        host(
            n, org=f"Firm {n % 5}", port=[443, 22, 3389, 6379][n % 4],
            ip_str=None if n % 6 == 0 else f"10.0.0.{n}",
            tags=[None, [], ["c2"], ["eol-product", None]][n % 4],
            vulns={"CVE-2025-1": (7.5, n % 2 == 0, 0.1 * (n % 9))} if n % 3 == 0 else None,
            screenshot_text="login" if n == 9 else None,
        )
        for n in range(120)
    ]


def test_cve_features(spark):
    cases = [
        (None, (0, 0, None, None, False)),
        ({}, (0, 0, None, None, False)),
        ({"CVE-2014-0160": (7.5, None, None)}, (1, 0, 7.5, None, False)),
        ({"CVE-2014-0160": (None, True, 0.2), "CVE-2026-1": (9.8, False, 0.1)},
         (2, 1, 9.8, 0.2, True)),
        ({"CVE-2024-9": None}, (1, 0, None, None, False)),
    ]
    for vulns, expected in cases:
        table = hosts_table(spark, [host(vulns=vulns)])
        assert tuple(table.select(*cve_features(F.col("vulns")).values()).first()) == expected


def test_recent_by_pattern_and_by_year(spark):
    ids = ["CVE-2024-1", "CVE-2025-1", "CVE-2029-1", "CVE-2030-1", "CVE-2112-99999", "GHSA-1", "CVE--1"]
    table = spark.createDataFrame([(x,) for x in ids], "id STRING")

    def chosen(**rules):
        return [r[0] for r in table.filter(recent_cve(F.col("id"), SignalRules(**rules))).collect()]

    assert chosen() == ids[1:3]
    assert chosen(recent_cve_year=2025) == ids[1:5]
    assert chosen(recent_cve_year=2030) == ids[3:5]


def test_features_follow_the_given_rules(spark):
    table = hosts_table(spark, [host(port=8443, vulns={"CVE-2019-1": (1.0, None, None)})])
    rules = SignalRules(risky_ports=(8443,), recent_cve_year=2019)
    for featured in (table, signals.with_host_features(table)):
        row = signals.with_host_features(featured, rules).first()
        assert row.is_risky_port is True and row.row_has_recent_cve is True


def test_tag_flags_null_rules(spark):
    table = spark.createDataFrame([(None,), ([],), (["c2", None],), ([None],)], "t ARRAY<STRING>")
    got = [r["is_c2"] for r in table.select(*tag_flags(F.col("t"))).collect()]
    assert got == [None, False, True, False]


def test_all_tags_null_counts_zero(spark):
    hosts, keyed, host_map = layers(spark, [host(n) for n in range(16)])
    row = signals.signals_rollup(hosts, host_map).first()
    assert (row.host_count, row.eol_count, row.c2_count) == (16, 0, 0)
    assert row.has_screenshot_evidence is False and row.screenshot_evidence_text is None


def test_null_ip_joins_and_null_port_or_time_drops(spark):
    rows = [host(1, ip_str=None), host(2, port=None), host(3, ts=None)]
    hosts, _, host_map = layers(spark, rows)
    assert rows_of(signals.signals_rollup(hosts, host_map), "host_count") == [(1,)]


def test_routes_agree_on_unique_keys(spark):
    hosts, keyed, host_map = layers(spark, mixed_rows())
    joined = rows_of(signals.signals_rollup(hosts, host_map))
    assert joined == rows_of(signals.signals_rollup_direct(keyed))
    assert len(joined) == 5


def expected_pairs(rows):
    """The joined rows by brute force: every host row with every map row of its key."""
    figures = defaultdict(lambda: [0, 0])
    for m in rows:
        if m["org"] is None:
            continue
        for h in rows:
            if all(h[k] == m[k] for k in ("ip_str", "port", "ts")):
                entry = figures[m["org"].lower()]
                entry[0] += 1
                entry[1] += "c2" in (h["tags"] or [])
    return {k: tuple(v) for k, v in figures.items()}


def test_duplicate_observations_count_as_pairs(spark):
    """A third of the rows share one key, some of them unresolved or of other companies."""
    same = {"ip_str": None, "ts": dt.datetime(2024, 5, 5)}
    rows = [
        host(n, org=[None, "Firm 0", "Firm 1", "Firm 2"][n % 4], tags=["c2"] if n % 3 else None, **same)
        for n in range(60)
    ] + [host(n, org=f"Firm {n % 5}") for n in range(60, 180)]
    hosts, _, host_map = layers(spark, rows)
    rolled = signals.signals_rollup(hosts, host_map)
    got = {r.company_key: (r.host_count, r.c2_count) for r in rolled.collect()}
    assert got == expected_pairs(rows)


def test_direct_route_plans_no_wide_join(spark):
    _, keyed, _ = layers(spark, mixed_rows())
    joins = [line for line in plan_of(signals.signals_rollup_direct(keyed)).splitlines() if "Join" in line]
    assert len(joins) == 1 and "LeftOuter" in joins[0]


def test_observation_join_is_one_merge_join(spark):
    """Two shuffles by the key for the figures, two for the screenshot texts."""
    hosts, _, host_map = layers(spark, mixed_rows())
    plan = plan_of(signals.signals_rollup(hosts, host_map))
    by_key = re.findall(r"Exchange hashpartitioning\(_no_ip#\d+, _ip#\d+, port#\d+L?, ts#\d+, \d+\)", plan)
    assert "SortMergeJoin [_no_ip" in plan and len(by_key) <= 4
    join = plan_of(signals.host_map_join(hosts, host_map))
    assert "BroadcastExchange" not in join
