"""Differences of layers and exports, denylists, sketches, budget and SQL, beside their queries."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from scanledger.config import CostRules, ResolveRules
from scanledger.functions.resolve import candidate_domain
from scanledger.operators import budget, denylist, differences, sketches
from scanledger.operators.accounts import gold_accounts
from scanledger.operators.enrichment import contacts_from_replies
from scanledger.operators.resolve import companies_rollup, host_company_map, keyed_table
from scanledger.operators.signals import signals_rollup
from scanledger.plans import views
from scanledger.plans.build import Layers
from scanledger.sources.readers import gold_view
from tests.helpers import host, hosts_table, plan_of, rows_of

KEYS = "k STRING, t STRING"


def layers_of(spark, hosts):
    table = hosts_table(spark, hosts)
    keyed = keyed_table(table)
    mapped = host_company_map(keyed)
    companies, signals = companies_rollup(keyed), signals_rollup(keyed, mapped)
    return Layers(table, keyed, mapped, companies, signals, gold_accounts(companies, signals))


def test_keys_missing_on_either_side(spark):
    left = spark.createDataFrame([("a", "x"), ("a", "x"), (None, "x"), (None, None), ("b", None)], KEYS)
    right = spark.createDataFrame([("a", "x"), (None, None), ("c", None), ("c", None)], KEYS)
    found = differences.missing_keys(left, right, ["k", "t"])
    assert rows_of(found) == sorted(
        [(None, "x", "right", 1), ("b", None, "right", 1), ("c", None, "left", 2)], key=repr
    )
    counted = differences.key_differences(left, right, ["k", "t"])
    assert ("a", "x", 2, 1) in rows_of(counted) and (None, None, 1, 1) not in rows_of(counted)
    assert differences.missing_keys(left, left, ["k", "t"]).count() == 0
    assert rows_of(differences.missing_keys(left.limit(0), right.limit(0), ["k", "t"])) == []
    # the rows of a hot key are counted before they are shuffled
    plan = plan_of(differences.missing_keys(left, right, ["k", "t"]))
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_layer_differences_name_null_keys(spark):
    rows = [host(n, org="Firm A Ltd") for n in range(3)]
    rows += [host(7, org="Lost Ltd", port=None), host(8, org="Firm A Ltd", ts=None, ip_str=None)]
    i = layers_of(spark, rows)
    found = differences.layer_differences(i.keyed, i.host_map, i.companies, i.signals, i.accounts)
    time = str(dt.datetime(2024, 1, 1) + dt.timedelta(microseconds=7))
    assert rows_of(found) == sorted(
        [
            ("map to join", f"10.0.0.7|null|{time}", None, "right", 1), ("map to join", "null|443|null", None, "right", 1),
            ("companies to signals", None, "lost ltd|org", "right", 1),
            ("companies to accounts", None, "lost ltd|org", "right", 1),
        ],
        key=repr,
    )


def firm(name, count, **given):
    return [host(100 * len(name) + n, org=name, **given) for n in range(count)]


def test_account_changes(spark):
    cve = {"CVE-2025-1": {"cvss": 9.0, "verified": True, "epss": 0.9}}
    before = firm("Aa Ltd", 3) + firm("Bbb Ltd", 2) + firm("Cccc Ltd", 2) + firm("Ddddd Ltd", 30) + firm("Eeeeee Ltd", 2)
    after = firm("Aa Ltd", 3) + firm("Cccc Ltd", 2, vulns=cve, tags=["c2", "eol-product"])
    after += firm("Ddddd Ltd", 31) + firm("Eeeeee Ltd", 2, isp="Carrier 9") + firm("Fffffff Ltd", 1)
    changes = differences.account_changes(layers_of(spark, before).accounts, layers_of(spark, after).accounts)
    found = {r.company_key: r for r in changes.collect()}
    assert {k: r.change for k, r in found.items()} == {
        "bbb ltd": "gone", "cccc ltd": "band", "ddddd ltd": "company", "eeeeee ltd": "company", "fffffff ltd": "new",
    }
    assert found["bbb ltd"].signals_changed is None and found["bbb ltd"].band_after is None
    assert found["cccc ltd"].signals_changed and found["cccc ltd"].score_after > found["cccc ltd"].score_before
    assert (found["eeeeee ltd"].signals_changed, found["eeeeee ltd"].company_changed) == (False, True)
    summary = {(r.change, r.n) for r in differences.change_summary(changes).collect()}
    assert ("gone", 1) in summary and ("new", 1) in summary


def test_digests_tell_where_nulls_are(spark):
    rows = [(None, "x", ["a", None]), ("x", None, ["a", None]), ("x", None, [None, "a"]), ("x", None, ["a"]),
            ("x", None, None), ("x", "", []), ("x", None, [])]
    table = spark.createDataFrame(rows, "a STRING, b STRING, c ARRAY<STRING>")
    assert table.select(differences.row_digest(("a", "b", "c"))).distinct().count() == len(rows)


def test_changes_shuffle_each_table_once_and_narrow(spark, tmp_path):
    accounts = layers_of(spark, firm("Aa Ltd", 3)).accounts
    accounts.write.parquet(f"{tmp_path}/before")
    accounts.write.parquet(f"{tmp_path}/after")
    both = [spark.read.parquet(f"{tmp_path}/{n}") for n in ("before", "after")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(differences.account_changes(*both))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2 and "why" not in plan


# --- denylists -------------------------------------------------------------------------------

DOMAINS = [
    None, [], ["AmazonAWS.com", "Shop.de."], ["foo.amazonaws.com", "x.firm.de"], ["localhost.", "a.b"], [None, "a.b"],
    ["37.in-addr.arpa"], ["vds."], ["a..b", ".com", "com."], ["amazon.com", "Foo.Bar.AMAZON.com", "z.y.x.w"], ["x"],
    ["google.com.", "sub.google.com."], [None], ["", "q.r"],
]


def test_a_table_denies_what_the_literals_deny(spark):
    rules = ResolveRules()
    rows = [(n, d) for n, d in enumerate(DOMAINS * 3)]
    hosts = spark.createDataFrame(rows, "id INT, domains ARRAY<STRING>")
    listed = spark.createDataFrame([(d,) for d in rules.denied_domains] * 2, "domain STRING")
    chosen = denylist.with_candidate_domain(hosts, listed, suffix=False)
    expected = hosts.withColumn("candidate_domain", candidate_domain(F.col("domains")))
    assert rows_of(chosen, "id", "candidate_domain") == rows_of(expected, "id", "candidate_domain")

    def below(name):
        return any(name == d or name.endswith("." + d) for d in rules.denied_domains)

    def first(domains):
        for d in domains or ():
            if d and not below(d.lower()) and not d.lower().endswith(".arpa") and "." in d[:-1]:
                return d
        return None

    chosen = denylist.with_candidate_domain(hosts, listed)
    assert rows_of(chosen, "id", "candidate_domain") == sorted(((n, first(d)) for n, d in rows), key=repr)


def test_a_million_entries(spark):
    """The list is joined, not written into the plan."""
    listed = spark.range(1_000_000).select(F.concat(F.lit("Tenant"), "id", F.lit(".cloud.example")).alias("domain"))
    rows = [(1, ["tenant77.cloud.example", "b.tenant999999.cloud.example", "own.de"]), (2, ["tenant1000000.cloud.example"]),
            (3, ["tenant5.cloud.example"]), (4, None)]
    hosts = spark.createDataFrame(rows, "id INT, domains ARRAY<STRING>")
    chosen = denylist.with_candidate_domain(hosts, listed)
    assert rows_of(chosen, "id", "candidate_domain") == [
        (1, "own.de"), (2, "tenant1000000.cloud.example"), (3, None), (4, None)
    ]
    plan = plan_of(chosen)
    assert "LeftSemi" in plan and "LeftAnti" in plan and "tenant" not in plan.lower().replace("concat(tenant", "")
    assert "INSET" not in plan and " IN (" not in plan


# --- sketches --------------------------------------------------------------------------------


def test_sketches_of_dates_add_up(spark):
    table = spark.range(200_000).select(
        (F.col("id") % 70_000).alias("a"), F.when(F.col("id") % 3 == 0, F.col("id") % 11).alias("b"),
        F.lit(None).cast("string").alias("c"),
    )
    parts = [table.filter(F.col("a") % 4 <= 2), table.filter(F.col("a") % 4 >= 2)]
    merged = None
    for part in parts:
        own = sketches.distinct_sketches(part, ("a", "b", "c"))
        merged = own if merged is None else merged.unionByName(own)
    found = {r.column_name: r.estimate for r in sketches.distinct_estimates(merged).collect()}
    assert abs(found["a"] - 70_000) <= 3 * sketches.STANDARD_ERROR * 70_000
    assert found["b"] == 11 and found["c"] == 0
    assert sketches.distinct_sketches(table.limit(0), ("a",)).count() == 1


def test_a_union_of_sketches_reads_no_hosts(spark, tmp_path):
    sketches.distinct_sketches(spark.range(100).toDF("a"), ("a",)).write.parquet(str(tmp_path / "s"))
    estimates = sketches.distinct_estimates(spark.read.parquet(str(tmp_path / "s")))
    assert plan_of(estimates).count("FileScan") == 1
    assert rows_of(estimates) == [("a", 100)]


# --- budget ----------------------------------------------------------------------------------


def review_table(spark, count, seed=1):
    rng = random.Random(seed)
    rows = [(f"firm{n:05d}", rng.choice(["org", "domain"]), float(rng.randint(50, 84)), "review" if n % 9 else "skip",
             rng.randint(0, 4000)) for n in range(count)]
    return rows, spark.createDataFrame(
        rows, "company_key STRING, resolution_tier STRING, contact_score DOUBLE, band STRING, millionths INT"
    )


@pytest.mark.parametrize("partitions", [1, 7])
def test_review_stops_at_the_ceiling(spark, partitions):
    rows, accounts = review_table(spark, 3000)
    cost = F.col("millionths") / F.lit(1_000_000)
    picked = budget.review_within_budget(accounts, cost, CostRules(ceiling=2.5), partitions)
    total, expected = 0, []
    for key, tier, score, _, price in sorted((r for r in rows if r[3] == "review"), key=lambda r: (-r[2], r[0], r[1])):
        total += price
        if total <= 2_500_000:
            expected.append((key, tier, score, total))
    found = [(r[0], r[1], r[2], round(float(r[3]) * 1e6)) for r in picked.select("company_key", "resolution_tier", "contact_score", "running_total").collect()]
    assert sorted(found) == sorted(expected)


def test_a_budget_for_all_or_none(spark):
    rows, accounts = review_table(spark, 50)
    assert budget.review_within_budget(accounts, rules=CostRules(ceiling=0.0)).count() == 0
    assert budget.review_within_budget(accounts).count() == sum(r[3] == "review" for r in rows)
    assert budget.review_within_budget(accounts.limit(0)).count() == 0


def test_no_task_sees_all_accounts(spark):
    plan = plan_of(budget.review_within_budget(review_table(spark, 50)[1]))
    assert "SinglePartition" not in plan and "Window" in plan


# --- SQL -------------------------------------------------------------------------------------


@pytest.fixture
def named(spark, tmp_path):
    rows = [host(n, org=f"Firm {n % 40:02d} Ltd", country_code="DE" if n % 2 else "US") for n in range(300)]
    rows += [host(900, org="O'Hara; DROP TABLE gold --")]
    i = layers_of(spark, rows)
    gold_view(i.accounts).write.parquet(str(tmp_path / "gold"))
    gold = spark.read.parquet(str(tmp_path / "gold"))
    views.register_views(Layers(i.hosts, i.keyed, i.host_map, i.companies, i.signals, i.accounts), gold, "t_")
    return gold


def test_values_are_no_sql(spark, named):
    for text in ("O'Hara", "x'; DROP VIEW t_gold; --", "' OR '1'='1", ":label", "{prefix}", ""):
        assert views.find_accounts(spark, label=text, prefix="t_").count() == 0
    found = views.run_sql(
        spark, "SELECT company_key FROM {prefix}gold WHERE company_key = :key", {"key": "o'hara; drop table gold --"}, "t_"
    )
    assert found.count() == 1
    with pytest.raises(ValueError, match="prefix"):
        views.find_accounts(spark, prefix="t_gold; --")


def test_search_by_sql_and_by_columns_agree(spark, named):
    from scanledger.operators.serving import query_accounts

    for given in ({}, {"country": "de"}, {"min_score": 10.0, "limit": 3}, {"label": "skip", "country": "US", "limit": 50}):
        columns = {"band" if k == "label" else k: v for k, v in given.items()}
        found = views.find_accounts(spark, prefix="t_", **given).collect()
        assert found == query_accounts(named, **columns).collect()


def test_the_filter_reaches_the_scan(spark, named):
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    try:
        plan = plan_of(views.find_accounts(spark, label="skip", country="de", prefix="t_"))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(final_label,skip)" in plan and "EqualTo(primary_country_code,DE)" in plan
    assert "TakeOrderedAndProject" in plan


# --- replies ---------------------------------------------------------------------------------


def test_all_replies_of_a_company_count(spark):
    import json

    pages = [
        ("a", 1, {"emails": [{"email": "late@a", "confidence": 90}, {"email": "x@a", "position": "Buyer"}]}),
        ("a", 0, {"emails": [{"email": "early@a", "confidence": 90}]}),
        ("a", 2, {"emails": [{"email": "it@a", "position": "IT Manager", "confidence": 1}]}),
        ("b", 0, {"error": "quota"}), ("b", 1, {"data": {"organization": "B", "emails": [{"value": "1@b"}]}}),
        ("c", 0, {"emails": []}), ("d", 0, {"emails": [{"email": "1@d"}], "data": "wrong"}),
    ]
    rows = [(k, p, json.dumps(r)) for k, p, r in pages] + [("a", 3, "broken {"), ("a", 4, None)]
    replies = spark.createDataFrame(rows, "company_key STRING, page INT, reply STRING")
    found = {r.company_key: r for r in contacts_from_replies(replies).collect()}
    assert {k: (r.contact and r.contact.email, r.raw_email_count, r.organization) for k, r in found.items()} == {
        "a": ("it@a", 4, None), "b": ("1@b", 1, "B"), "c": (None, 0, None), "d": ("1@d", 1, None),
    }
    tied = contacts_from_replies(replies.filter("page < 2")).filter("company_key = 'a'").first()
    assert tied.contact.email == "early@a"
    # without pages the smaller address decides between equals
    unpaged = contacts_from_replies(replies.filter("page < 2").drop("page")).filter("company_key = 'a'").first()
    assert unpaged.contact.email == "early@a" and unpaged.raw_email_count == 3


def test_replies_are_limited_before_they_are_parsed_once(spark, tmp_path):
    rows = [(f"k{n}", f'{{"emails": [{{"email": "{n}@x"}}]}}') for n in range(50)]
    spark.createDataFrame(rows, "company_key STRING, reply STRING").write.parquet(str(tmp_path / "r"))
    replies = spark.read.parquet(str(tmp_path / "r"))
    wanted = spark.createDataFrame([("k3",), ("k7",), ("none",)], "company_key STRING")
    found = contacts_from_replies(replies, wanted)
    assert rows_of(found, "company_key", "contact.email") == [("k3", "3@x"), ("k7", "7@x")]
    plan = plan_of(found)
    assert plan.count("from_json") == 1
    assert plan.index("from_json") < plan.index("LeftSemi")
