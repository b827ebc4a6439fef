"""Resolution rules: the published regression cases and the NULL traps."""

import pytest
from pyspark.sql import functions as F

from scanledger import config
from scanledger.config import ResolveRules
from scanledger.functions import resolve as fn
from scanledger.operators import resolve
from tests.helpers import host, hosts_table, plan_of, rows_of


def keyed(spark, *rows):
    return resolve.resolve_hosts(hosts_table(spark, [host(n, **r) for n, r in enumerate(rows)]))


def tier_and_key(spark, **row):
    return rows_of(keyed(spark, row), "resolution_tier", "company_key")[0]


def test_list_sizes():
    assert len(ResolveRules().denied_domains) == 74
    assert len(config.HYPERSCALER_KEYWORDS) == 37
    assert len(config.GENERIC_ISP_KEYWORDS) == 14
    assert len(config.RISKY_PORTS) == 19


@pytest.mark.parametrize(
    ("row", "expected"),
    [
        ({"org": "ACEVILLE PTE.LTD.", "isp": None}, ("org", "aceville pte.ltd")),
        ({"org": "Meteverse Limited"}, ("org", "meteverse limited")),
        ({"org": "Meteverse Limited."}, ("org", "meteverse limited")),
        ({"org": "NTT America, Inc.", "domains": ["amazon.com"]}, ("org", "ntt america, inc")),
        ({"domains": ["localhost."]}, ("org", "acme ltd")),
        ({"domains": ["37.in-addr.arpa"]}, ("org", "acme ltd")),
        ({"domains": ["vds."]}, ("org", "acme ltd")),
        ({"domains": ["vds.", "Shop.Example-Firm.de."]}, ("domain", "shop.example-firm.de.")),
        ({"domains": ["foo.amazonaws.com"]}, ("domain", "foo.amazonaws.com")),
        ({"domains": [None, "firm.de"]}, ("domain", "firm.de")),
        ({"domains": ["firm.de"], "isp": "Google LLC"}, ("unresolved", None)),
        ({"org": None}, ("unresolved", None)),
        ({"org": None, "domains": ["firm.de"]}, ("domain", "firm.de")),
        ({"org": "Deutsche Telekom AG"}, ("unresolved", None)),
        ({"org": "Deutsche Telekom AG", "domains": ["firm.de"]}, ("domain", "firm.de")),
        ({"isp": "Some Telekom"}, ("org", "acme ltd")),
        ({"org": ""}, ("org", "")),
        ({"org": "."}, ("org", "")),
        ({"org": " Acme Ltd  "}, ("org", "acme ltd")),
        ({"org": "Acme Ltd. , \t"}, ("org", "acme ltd")),
        ({"domains": ["firm.de"], "hostnames": ["77-163-107-27.fixed.kpn.net"]},
         ("org", "acme ltd")),
        ({"domains": ["firm.de"], "hostnames": [None, "a.firm.de"]}, ("org", "acme ltd")),
        ({"domains": ["firm.de"], "hostnames": []}, ("domain", "firm.de")),
    ],
)
def test_tier_and_key(spark, row, expected):
    assert tier_and_key(spark, **row) == expected


@pytest.mark.parametrize(
    ("hostnames", "expected"),
    [
        (None, False), ([], False), ([None], None), (["www.firm.de"], False),
        (["77-163-107-27.fixed.kpn.net"], True), (["ip-192-168-1-1.customer.net"], True),
        (["179.202.41.212.static.wline.lns.sme.cust.swisscom.ch"], True),
        (["a.DHCP.firm.de"], True), (["dhcp.firm.de"], False),
        (["www.firm.de", "77-163-107-27.fixed.kpn.net"], False),
    ],
)
def test_dynamic_ptr(spark, hostnames, expected):
    table = hosts_table(spark, [host(hostnames=hostnames)])
    assert table.select(fn.dynamic_ptr_flag(F.col("hostnames"))).first()[0] is expected


def test_suffix_denylist(spark):
    names = ["amazonaws.com", "foo.AmazonAWS.com", "notamazonaws.com", None]
    table = spark.createDataFrame([(n,) for n in names], "d STRING")
    got = table.select(fn.is_denied_domain(F.col("d")), fn.is_denied_domain(F.col("d"), False))
    assert [tuple(r) for r in got.collect()] == [
        (True, True), (True, False), (False, False), (False, False)
    ]


def test_infra_threshold(spark):
    rows = [{"org": "Big"}] * 500 + [{"org": "Small"}] * 499
    companies = resolve.companies_rollup(keyed(spark, *rows))
    assert rows_of(companies, "company_key", "host_count", "likely_infra_or_proxy") == [
        ("big", 500, True), ("small", 499, False)
    ]


def test_same_name_in_both_tiers_stays_apart(spark):
    table = keyed(spark, {"domains": ["firm.de"]}, {"org": "firm.de"})
    assert rows_of(resolve.companies_rollup(table), "company_key", "resolution_tier") == [
        ("firm.de", "domain"), ("firm.de", "org")
    ]


def test_mode_ties_distincts_and_samples(spark):
    rows = [
        {"country_code": "FR", "asn": None, "isp": None, "hostnames": ["h9"]},
        {"country_code": "DE", "asn": "AS2", "isp": None, "hostnames": ["h1"]},
        {"country_code": "DE", "asn": "AS2", "isp": None, "ip_str": None},
        {"country_code": "FR", "asn": "AS3", "isp": None, "hostnames": ["h1"]},
        {"country_code": None, "asn": "AS3", "isp": None, "hostnames": ["h5"]},
    ]
    row = resolve.companies_rollup(keyed(spark, *rows)).first()
    assert (row.host_count, row.country_count, row.asn_count) == (5, 2, 2)
    assert (row.primary_country_code, row.primary_isp) == ("DE", None)
    assert row.sample_ips == ["10.0.0.0", "10.0.0.1", "10.0.0.3", "10.0.0.4", None]
    assert row.sample_hostnames == ["h1", "h5", "h9", None]


def test_row_order_and_partitions_do_not_matter(spark):
    rows = [
        host(n, org=f"Firm {n % 7}", country_code=["US", "DE", None][n % 3], isp=f"isp {n % 5}")
        for n in range(200)
    ]
    one = resolve.companies_rollup(resolve.resolve_hosts(hosts_table(spark, rows)))
    two = resolve.companies_rollup(
        resolve.resolve_hosts(hosts_table(spark, rows[::-1]).repartition(13))
    )
    assert rows_of(one) == rows_of(two)


def test_sampling_limits_rows_before_the_second_shuffle(spark):
    """Read upwards: distinct values by their own hash, the rank limit, the shuffle by company."""
    plan = plan_of(resolve.sample_values(keyed(spark, {"org": "a"}))).splitlines()[::-1]
    by_value = next(k for k, x in enumerate(plan) if "Exchange hashpartitioning" in x and "value" in x)
    limit = next(k for k, x in enumerate(plan) if "WindowGroupLimit" in x and "Partial" in x)
    by_company = next(
        k for k, x in enumerate(plan) if "Exchange hashpartitioning" in x and "value" not in x
    )
    assert by_value < limit < by_company


def test_roll_up_has_no_per_company_value_list(spark):
    plan = plan_of(resolve.primary_values(keyed(spark, {"org": "a"})))
    assert "ObjectHashAggregate" not in plan and "collect_" not in plan
