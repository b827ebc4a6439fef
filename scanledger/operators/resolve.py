"""Hosts -> company keys, the host/company map and the company roll-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanledger.config import ResolveRules, SignalRules
from scanledger.functions import resolve as fn
from scanledger.functions.common import contains_any
from scanledger.operators.signals import with_host_features
from scanledger.schemas import COMPANY_COLUMNS, COMPANY_KEY, MAP_COLUMNS

RESOLVED_TIERS = ("domain", "org")


def resolve_hosts(hosts: DataFrame, rules: ResolveRules = ResolveRules()) -> DataFrame:
    """Add the resolution flags, the tier and the company key to every host row.

    Narrow: stacked projections, no shuffle. Each stage names what the next
    one uses several times, so it is computed once per row. The keyword and
    pattern flags come before the domain choice, whose array filter is
    interpreted and would take them out of the generated code.
    """
    c = F.col
    flagged = (
        hosts.withColumn("_carrier", fn.carrier_text(c("org"), c("isp")))
        .withColumns(
            {
                "is_dynamic_ptr": fn.dynamic_ptr_flag(c("hostnames")),
                "is_hyperscaler_org": contains_any(c("_carrier"), rules.hyperscaler_keywords),
                "is_generic_isp_org": fn.generic_isp_flag(c("org"), rules),
            }
        )
        .drop("_carrier")
    )
    eligible = flagged.withColumns(
        {
            "candidate_domain": fn.candidate_domain(c("domains"), rules),
            "_by_domain": fn.domain_allowed(c("is_dynamic_ptr"), c("is_hyperscaler_org")),
            "_by_org": fn.org_allowed(
                c("org"), c("is_hyperscaler_org"), c("is_generic_isp_org")
            ),
        }
    )
    tiered = eligible.withColumn(
        "resolution_tier",
        fn.resolution_tier(c("candidate_domain"), c("_by_domain"), c("_by_org")),
    ).drop("_by_domain", "_by_org")
    return tiered.withColumn(
        "company_key", fn.company_key(c("resolution_tier"), c("candidate_domain"), c("org"))
    )


# Host columns that nothing after resolution reads: the CVE map lives on in the
# row figures, the tags in the flags.
_UNUSED_LATER = (
    "transport", "latitude", "longitude", "os", "product", "devicetype", "tags", "cpe23",
    "vulns", "ssl_jarm", "http_status", "http_server", "http_title", "shodan_module",
    "screenshot_labels",
)


def keyed_table(
    hosts: DataFrame,
    rules: ResolveRules = ResolveRules(),
    signal_rules: SignalRules = SignalRules(),
) -> DataFrame:
    """What to store per host for all later layers: key, tier and row figures."""
    return resolve_hosts(with_host_features(hosts, signal_rules), rules).drop(*_UNUSED_LATER)


def filter_resolved(keyed: DataFrame) -> DataFrame:
    return keyed.filter(F.col("resolution_tier").isin(*RESOLVED_TIERS))


def host_company_map(keyed: DataFrame) -> DataFrame:
    return filter_resolved(keyed).select(*MAP_COLUMNS)


def _values(*names: str) -> Column:
    """Long form: one (kind, value) struct per named column."""
    return F.inline(
        F.array(*[F.struct(F.lit(n).alias("kind"), F.col(n).alias("value")) for n in names])
    )


def primary_values(keyed: DataFrame) -> DataFrame:
    """Host count, distinct countries and ASNs, and the most frequent attributes.

    Counts are narrowed in three steps: identical attribute tuples, then one
    row per (company, attribute, value), then one row per company. Every step
    combines on the map side, so a company that holds a third of all hosts is
    spread by its attribute values and reaches the last step as a few partial
    rows; no per-company value map is ever built in memory.
    Ties of the most frequent value go to the smallest one.
    """
    attributes = ["country_code", "country_name", "asn", "org", "isp"]
    tuples = (
        filter_resolved(keyed).groupBy(*COMPANY_KEY, *attributes).agg(F.count("*").alias("n"))
    )
    per_value = (
        tuples.select(*COMPANY_KEY, "n", _values(*attributes))
        .groupBy(*COMPANY_KEY, "kind", "value")
        .agg(F.sum("n").alias("n"))
    )

    def most_frequent(kind: str) -> Column:
        known = (F.col("kind") == kind) & F.col("value").isNotNull()
        return F.min_by(
            F.when(known, F.col("value")),
            F.when(known, F.struct((-F.col("n")).alias("n"), F.col("value"))),
        )

    def distinct(kind: str) -> Column:
        return F.count(F.when(F.col("kind") == kind, F.col("value")))

    return per_value.groupBy(*COMPANY_KEY).agg(
        F.sum(F.when(F.col("kind") == "asn", F.col("n"))).alias("host_count"),
        distinct("country_code").alias("country_count"),
        most_frequent("country_code").alias("primary_country_code"),
        most_frequent("country_name").alias("primary_country_name"),
        distinct("asn").alias("asn_count"),
        most_frequent("org").alias("primary_org"),
        most_frequent("isp").alias("primary_isp"),
    )


def sample_values(keyed: DataFrame, size: int = ResolveRules().sample_size) -> DataFrame:
    """Up to ``size`` distinct addresses and first hostnames per company.

    The smallest values are taken, NULL last. The values are first made
    distinct, which shuffles up to two of them per resolved host, spread by the
    value. The rank filter then runs before the second shuffle too, which so
    carries at most ``size`` values per company, kind and task, and the arrays
    stay bounded.
    """
    distinct_values = (
        filter_resolved(keyed)
        .select(*COMPANY_KEY, "ip_str", F.get("hostnames", F.lit(0)).alias("hostname"))
        .select(*COMPANY_KEY, _values("ip_str", "hostname"))
        .distinct()
    )
    smallest_first = Window.partitionBy(*COMPANY_KEY, "kind").orderBy(
        F.col("value").asc_nulls_last()
    )
    picked = distinct_values.withColumn("rank", F.row_number().over(smallest_first)).filter(
        F.col("rank") <= size
    )

    def listed(kind: str) -> Column:
        ranked = F.collect_list(F.when(F.col("kind") == kind, F.struct("rank", "value")))
        return F.transform(F.sort_array(ranked), lambda r: r["value"])

    return picked.groupBy(*COMPANY_KEY).agg(
        listed("ip_str").alias("sample_ips"), listed("hostname").alias("sample_hostnames")
    )


def infra_flag(host_count: Column, rules: ResolveRules = ResolveRules()) -> Column:
    """No single business holds this many hosts."""
    return host_count >= rules.infra_host_threshold


def companies_rollup(keyed: DataFrame, rules: ResolveRules = ResolveRules()) -> DataFrame:
    """One row per (company_key, resolution_tier)."""
    return (
        primary_values(keyed)
        .join(sample_values(keyed, rules.sample_size), list(COMPANY_KEY))
        .withColumn("likely_infra_or_proxy", infra_flag(F.col("host_count"), rules))
        .select(*COMPANY_COLUMNS)
    )
