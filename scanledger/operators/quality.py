"""Quality reports and reconciliation of the layers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanledger import config
from scanledger.functions.common import percent, round_half_up
from scanledger.schemas import (
    ACCOUNTS, COMPANIES, COMPANY_KEY, HOST_COLUMNS, HOST_MAP, HOSTS, KEYED,
)


def _rates(table: DataFrame, conditions: dict[str, Column], digits: int) -> DataFrame:
    """Rows meeting each condition and their share, all from one scan."""
    counted = table.agg(
        F.count("*").alias("_rows"), *[F.count_if(c).alias(n) for n, c in conditions.items()]
    )
    return counted.unpivot("_rows", list(conditions), "column_name", "n").select(
        "column_name", "n", percent(F.col("n"), F.col("_rows"), digits).alias("pct")
    )


def null_rates(hosts: DataFrame, columns: Sequence[str] = config.NULL_RATE_COLUMNS) -> DataFrame:
    return _rates(hosts, {c: F.col(c).isNull() for c in columns}, 1)


def flag_rates(hosts: DataFrame) -> DataFrame:
    return _rates(hosts, {c: F.col(c) for c in config.TAG_FLAGS}, 2)


def coverage(hosts: DataFrame) -> DataFrame:
    """Rows with a CVE and rows with a domain."""
    return _rates(
        hosts,
        {"has_vulns": F.size("vulns") > 0, "has_domains": F.size("domains") > 0},
        2,
    )


def distinct_counts(
    hosts: DataFrame, columns: Sequence[str] = config.DISTINCT_COLUMNS
) -> DataFrame:
    """Distinct non-NULL values per column.

    Values are made distinct across the cluster in long form; only one row per
    value is left to count.
    """
    values = hosts.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                    for c in columns
                ]
            )
        )
    )
    return values.distinct().groupBy("column_name").agg(F.count("value").alias("n"))


def row_count(table: DataFrame, name: str) -> DataFrame:
    return table.agg(F.lit(name).alias("table_name"), F.count("*").alias("n"))


def resolution_yield(keyed: DataFrame) -> DataFrame:
    """Hosts per tier and their share; three rows reach the total."""
    counts = keyed.groupBy("resolution_tier").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return counts.select("resolution_tier", "n", percent(F.col("n"), total, 1).alias("pct"))


def unresolved_orgs(keyed: DataFrame, limit: int = 15) -> DataFrame:
    return (
        keyed.filter((F.col("resolution_tier") == "unresolved") & F.col("org").isNotNull())
        .groupBy("org", "isp")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), F.asc("org"), F.asc_nulls_last("isp"))
        .limit(limit)
    )


def top_orgs(hosts: DataFrame, limit: int = 5) -> DataFrame:
    return (
        hosts.filter(F.col("org").isNotNull())
        .groupBy("org")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "org")
        .limit(limit)
    )


def top_urgency(signals: DataFrame, limit: int = 10) -> DataFrame:
    return (
        signals.filter(F.col("cve_count") > 0)
        .orderBy(F.desc_nulls_last("max_epss"), *COMPANY_KEY)
        .limit(limit)
        .select(
            *COMPANY_KEY, "cve_count", "max_cvss", "max_epss", "has_recent_cve",
            "eol_count", "self_signed_count", "risky_open_port_count",
        )
    )


def top_cve_companies(signals: DataFrame, limit: int = 3) -> DataFrame:
    return (
        signals.orderBy(F.desc("cve_count"), *COMPANY_KEY)
        .limit(limit)
        .select(*COMPANY_KEY, "cve_count", "max_cvss", "max_epss")
    )


def signal_prevalence(signals: DataFrame) -> DataFrame:
    """Companies that show each kind of signal."""
    kinds = {
        "with_cve": "cve_count",
        "with_eol": "eol_count",
        "with_self_signed": "self_signed_count",
        "with_honeypot": "honeypot_count",
        "with_c2": "c2_count",
        "with_risky_port": "risky_open_port_count",
    }
    return signals.agg(
        *[F.count_if(F.col(c) > 0).alias(name) for name, c in kinds.items()],
        F.count("*").alias("total"),
    )


def band_distribution(accounts: DataFrame) -> DataFrame:
    return accounts.groupBy("band").agg(
        F.count("*").alias("n"),
        round_half_up(F.avg("contact_score"), 1).alias("avg_score"),
    )


def infra_concentration(companies: DataFrame) -> DataFrame:
    """How many companies are flagged as infrastructure, and how many hosts they hold."""
    flagged = F.col("likely_infra_or_proxy")
    held = F.sum(F.when(flagged, F.col("host_count")).otherwise(0))
    return companies.agg(
        F.count_if(flagged).alias("flagged_companies"),
        F.count("*").alias("companies"),
        percent(F.count_if(flagged), F.count("*"), 2).alias("company_pct"),
        held.alias("flagged_hosts"),
        F.sum("host_count").alias("resolved_hosts"),
        percent(held, F.sum("host_count"), 2).alias("host_pct"),
    )


def _sides(companies: DataFrame, signals: DataFrame) -> DataFrame:
    """Companies and signals counted, and the keys that only one of them has."""
    both = companies.select(*COMPANY_KEY, F.lit(1).alias("_c")).join(
        signals.select(*COMPANY_KEY, F.lit(1).alias("_s")), list(COMPANY_KEY), "full"
    )
    return both.agg(
        F.count("_c").alias("companies"),
        F.count("_s").alias("signals"),
        F.count_if(F.col("_c").isNull() | F.col("_s").isNull()).alias("one_sided"),
    )


def _long(one_rows: Sequence[DataFrame]) -> DataFrame:
    long = None
    for one_row in one_rows:
        rows = one_row.unpivot([], one_row.columns, "figure", "n")
        long = rows if long is None else long.unionByName(rows)
    return long


_REJECTED_CHECK = "rejected_lines_vs_empty_hosts"


def _checked(figures: DataFrame, with_raw: bool) -> DataFrame:
    """The checks over ``figure, n`` rows."""
    known = figures.agg(F.map_from_entries(F.collect_list(F.struct("figure", "n"))).alias("n"))
    checks = {
        **({"raw_lines_vs_hosts": ("raw_lines", "hosts")} if with_raw else {}),
        "hosts_vs_keyed": ("hosts", "keyed"),
        "hosts_vs_tiers": ("keyed", "tiers"),
        "resolved_vs_map": ("resolved", "mapped"),
        "resolved_vs_company_hosts": ("resolved", "company_hosts"),
        "companies_vs_signals": ("companies", "signals"),
        "companies_vs_accounts": ("companies", "accounts"),
        "accounts_vs_bands": ("accounts", "banded"),
        "companies_without_counterpart": ("one_sided", None),
        **({_REJECTED_CHECK: ("rejected_lines", "empty_hosts")} if with_raw else {}),
    }
    rows = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.col("n")[left].alias("left_n"),
            (F.col("n")[right] if right else F.lit(0).cast("bigint")).alias("right_n"),
        )
        for name, (left, right) in checks.items()
    ]
    left, right = F.col("left_n"), F.col("right_n")
    ok = F.when(F.col("check_name") == _REJECTED_CHECK, left <= right).otherwise(left == right)
    return known.select(F.inline(F.array(*rows))).withColumn("ok", ok)


#: Where the figures of the checks stand in the observed counts.
_OBSERVED = {
    "raw_lines": (HOSTS, "rows"), "rejected_lines": (HOSTS, "rejected"), "empty_hosts": (HOSTS, "empty"),
    "keyed": (KEYED, "rows"), "tiers": (KEYED, "tiers"), "resolved": (KEYED, "resolved"),
    "mapped": (HOST_MAP, "rows"), "company_hosts": (COMPANIES, "hosts"),
    "accounts": (ACCOUNTS, "rows"), "banded": (ACCOUNTS, "banded"),
}


def reconcile_observed(
    counts: DataFrame, hosts: DataFrame, companies: DataFrame, signals: DataFrame
) -> DataFrame:
    """The checks of :func:`layer_reconcile` from the counts observed while the layers were written.

    ``counts`` has ``layer, counts`` of one build. No layer and no raw record is
    read again for them: the rows of hosts come from the files' footers, to
    be held against those that were written, and the keys of companies and
    signals are compared. Raw lines are the records that the ingest parsed.
    """
    observed = counts.select("layer", F.explode("counts").alias("name", "n"))
    named = F.coalesce(
        *[
            F.when((F.col("layer") == layer) & (F.col("name") == name), F.lit(figure))
            for figure, (layer, name) in _OBSERVED.items()
        ]
    )
    observed = observed.select(named.alias("figure"), "n").filter("figure IS NOT NULL")
    stored = _long([hosts.agg(F.count("*").alias("hosts")), _sides(companies, signals)])
    return _checked(observed.unionByName(stored), True)


def layer_reconcile(
    hosts: DataFrame,
    keyed: DataFrame,
    host_map: DataFrame,
    companies: DataFrame,
    signals: DataFrame,
    accounts: DataFrame,
    raw: DataFrame | None = None,
) -> DataFrame:
    """Row counts that must agree between neighbouring layers, one row per check.

    For layers without observed counts: each is counted once, by a one-row
    aggregate of few columns; companies and signals are also compared key by
    key. ``raw`` has the one row of ``readers.line_counts`` for the export;
    every line that is not blank must be a row of hosts. The rejected ones among
    them are told beside it, with the hosts that hold no value at all; a line
    with an empty object is such a row too, so there may be more of these.
    """
    tier, band = F.col("resolution_tier"), F.col("band")
    empty = F.coalesce(*[F.col(c).cast("string") for c in HOST_COLUMNS if c != "vulns"]).isNull()
    empty_hosts = [F.count_if(empty & F.col("vulns").isNull()).alias("empty_hosts")] if raw is not None else []
    counts = [
        hosts.agg(F.count("*").alias("hosts"), *empty_hosts),
        keyed.agg(
            F.count("*").alias("keyed"),
            F.count_if(tier.isin("domain", "org", "unresolved")).alias("tiers"),
            F.count_if(tier.isin("domain", "org")).alias("resolved"),
        ),
        host_map.agg(F.count("*").alias("mapped")),
        _sides(companies, signals),
        accounts.agg(
            F.count("*").alias("accounts"),
            F.count_if(band.isin("contact", "review", "skip", "exclude")).alias("banded"),
        ),
        companies.agg(F.sum("host_count").alias("company_hosts")),
        *([raw] if raw is not None else []),
    ]
    return _checked(_long(counts), raw is not None)
