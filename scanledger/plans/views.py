"""The layers as SQL views, and the account search as a query with named parameters.

Values are bound by name and never become SQL text.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from scanledger.plans.build import Layers
from scanledger.sources.readers import gold_view

#: Names of the views, behind a prefix.
VIEWS = ("hosts", "keyed", "host_map", "companies", "signals", "accounts", "gold")

ACCOUNT_SEARCH = """
    SELECT company_key, primary_country_code AS country, contact_score AS score, final_label AS band
    FROM {prefix}gold
    WHERE (:label IS NULL OR final_label = :label)
        AND (:country IS NULL OR primary_country_code = upper(:country))
        AND (:min_score IS NULL OR contact_score >= :min_score)
    ORDER BY contact_score DESC, company_key, resolution_tier
    LIMIT :limit"""

COMPANY_SIGNALS = """
    SELECT a.company_key, a.resolution_tier, a.final_label, s.cve_count, s.max_epss, s.risky_open_port_count
    FROM {prefix}gold a JOIN {prefix}signals s
        ON s.company_key = a.company_key AND s.resolution_tier = a.resolution_tier
    WHERE a.company_key = :company"""


def register_views(layers: Layers, adjudicated: DataFrame | None = None, prefix: str = "") -> None:
    """Name the layers in the session; ``gold`` has the final labels if there are any."""
    gold = gold_view(layers.accounts, adjudicated)
    for name in VIEWS:
        table = gold if name == "gold" else getattr(layers, name)
        table.createOrReplaceTempView(f"{prefix}{name}")


def run_sql(spark: SparkSession, text: str, given: Mapping[str, object] | None = None, prefix: str = "") -> DataFrame:
    """A query over the views; ``:name`` in it stands for a given value."""
    if not prefix.replace("_", "a").isalnum() and prefix:
        raise ValueError("a prefix has letters, digits and underscores only")
    return spark.sql(text.replace("{prefix}", prefix), args=dict(given or {}))


def find_accounts(
    spark: SparkSession,
    label: str | None = None,
    country: str | None = None,
    min_score: float | None = None,
    limit: int = 10,
    prefix: str = "",
) -> DataFrame:
    """Accounts by final label, country and score; what isn't given does not filter."""
    given = {"label": label, "country": country, "min_score": min_score, "limit": limit}
    return run_sql(spark, ACCOUNT_SEARCH, given, prefix)
