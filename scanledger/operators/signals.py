"""Hosts and the host/company map -> security signals per company."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanledger.config import SignalRules
from scanledger.functions.hosts import cve_features, risky_port_flag
from scanledger.schemas import COMPANY_KEY, SIGNAL_COLUMNS

# NULL-safe observation key as plain columns, so that the aggregation and the
# join on it share one partitioning.
_OBSERVATION = ("_no_ip", "_ip", "port", "ts")

# Signal -> host column it counts.
_COUNTED = {
    "cve_count": "row_cve_count",
    "verified_cve_count": "row_verified_cve_count",
    "eol_count": "is_eol_product",
    "self_signed_count": "is_self_signed",
    "honeypot_count": "is_honeypot",
    "c2_count": "is_c2",
    "iot_count": "is_iot",
    "vpn_count": "is_vpn",
    "database_tag_count": "is_database_tag",
    "risky_open_port_count": "is_risky_port",
}
_LARGEST = {
    "max_cvss": "row_max_cvss",
    "max_epss": "row_max_epss",
    "has_recent_cve": "row_has_recent_cve",
}


def with_host_features(hosts: DataFrame, rules: SignalRules = SignalRules()) -> DataFrame:
    """Add the CVE figures and the risky-port flag of each row, by these rules.

    The roll-ups below read these columns; the keyed table has them already.
    """
    return hosts.withColumns(
        {
            **cve_features(F.col("vulns"), rules),
            "is_risky_port": risky_port_flag(F.col("port"), rules.risky_ports),
        }
    )


def _joinable(rows: DataFrame) -> DataFrame:
    """Rows with a port and a time, under the NULL-safe observation key."""
    return rows.filter(F.col("port").isNotNull() & F.col("ts").isNotNull()).withColumns(
        {"_no_ip": F.col("ip_str").isNull(), "_ip": F.coalesce("ip_str", F.lit(""))}
    )


def _total(column: str) -> Column:
    return F.coalesce(F.sum(F.col(column).cast("bigint")), F.lit(0).cast("bigint"))


def _row_figures() -> list[Column]:
    return [
        F.count("*").alias("rows"),
        *[_total(source).alias(name) for name, source in _COUNTED.items()],
        *[F.max(source).alias(name) for name, source in _LARGEST.items()],
    ]


def _company_figures(per_port: DataFrame) -> DataFrame:
    """(company, port) figures -> company figures."""
    return per_port.groupBy(*COMPANY_KEY).agg(
        F.sum("rows").alias("host_count"),
        *[F.sum(name).alias(name) for name in _COUNTED],
        *[F.max(name).alias(name) for name in _LARGEST],
        F.count("port").alias("distinct_port_count"),
    )


def observation_totals(featured: DataFrame) -> DataFrame:
    """One row per observation key with the figures of all its host rows."""
    return _joinable(featured).groupBy(*_OBSERVATION).agg(*_row_figures())


def map_copies(host_map: DataFrame) -> DataFrame:
    """One row per observation key and company, with the number of map rows."""
    return (
        _joinable(host_map)
        .groupBy(*_OBSERVATION, *COMPANY_KEY)
        .agg(F.count("*").alias("copies"))
    )


def host_map_join(featured: DataFrame, host_map: DataFrame) -> DataFrame:
    """Hosts (with their features) joined to the map on (ip NULL-safe, port, ts), in summed form.

    The key is not unique: h host rows and m map rows of one key stand for
    h*m joined rows. Those pairs are never produced. Hosts are summed per key
    and map rows counted per key and company first, so the join has one host
    row per key and each result row carries its weight: ``rows`` pairs and
    sums multiplied by ``copies``.

    Both sides grow with the data and are joined by a sort-merge join on the
    partitioning that the sums leave; the hint rules out a broadcast chosen
    from the size of the well compressed files. A key with very many companies
    has one row for each, and adaptive execution splits such a side.
    """
    copies = map_copies(host_map)
    pairs = copies.join(observation_totals(featured).hint("merge"), list(_OBSERVATION))
    weight = F.col("copies")
    return pairs.select(
        *COMPANY_KEY,
        F.when(~F.col("_no_ip"), F.col("_ip")).alias("ip_str"),
        "port",
        "ts",
        (F.col("rows") * weight).alias("rows"),
        *[(F.col(name) * weight).alias(name) for name in _COUNTED],
        *list(_LARGEST),
    )


def screenshot_evidence(hosts: DataFrame, host_map: DataFrame) -> DataFrame:
    """Largest screenshot text per company.

    Few hosts have one. The filter reaches the scan, and the texts (wide and
    not hash-aggregatable in place) stay out of the main roll-up.
    """
    texts = (
        _joinable(hosts.filter(F.col("screenshot_text").isNotNull()))
        .groupBy(*_OBSERVATION)
        .agg(F.max("screenshot_text").alias("text"))
    )
    return (
        _joinable(host_map)
        .join(texts, list(_OBSERVATION))
        .groupBy(*COMPANY_KEY)
        .agg(F.max("text").alias("screenshot_evidence_text"))
    )


def _with_evidence(figures: DataFrame, evidence: DataFrame) -> DataFrame:
    text = F.col("screenshot_evidence_text")
    return (
        figures.join(evidence, list(COMPANY_KEY), "left")
        .withColumn("has_screenshot_evidence", text.isNotNull())
        .select(*SIGNAL_COLUMNS)
    )


def signals_rollup(featured: DataFrame, host_map: DataFrame) -> DataFrame:
    """Security signals through the hosts/map join (pairs counted, see above)."""
    per_port = (
        host_map_join(featured, host_map)
        .groupBy(*COMPANY_KEY, "port")
        .agg(
            F.sum("rows").alias("rows"),
            *[F.sum(name).alias(name) for name in _COUNTED],
            *[F.max(name).alias(name) for name in _LARGEST],
        )
    )
    return _with_evidence(_company_figures(per_port), screenshot_evidence(featured, host_map))


def signals_rollup_direct(keyed: DataFrame) -> DataFrame:
    """Security signals from the resolved rows themselves, without a join.

    Equal to ``signals_rollup`` when (ip, port, ts) is unique and port and ts
    are never NULL. Duplicates count once per row here.
    """
    rows = keyed.filter(F.col("company_key").isNotNull())
    per_port = rows.groupBy(*COMPANY_KEY, "port").agg(*_row_figures())
    evidence = (
        keyed.filter(F.col("screenshot_text").isNotNull() & F.col("company_key").isNotNull())
        .groupBy(*COMPANY_KEY)
        .agg(F.max("screenshot_text").alias("screenshot_evidence_text"))
    )
    return _with_evidence(_company_figures(per_port), evidence)
