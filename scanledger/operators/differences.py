"""What differs between two layers, or between two exports of one layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanledger.schemas import ACCOUNT_FROM_COMPANY, ACCOUNT_FROM_SIGNALS, COMPANY_KEY


def key_differences(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys whose number of rows differs, with ``left_n`` and ``right_n``.

    A key that one side lacks has 0 there. Null parts of a key are equal to each
    other. Both sides are counted in one aggregation, which combines before its
    shuffle; so a key with very many rows is a row per task, where an anti-join
    in each direction would bring all of its rows to one.
    """

    def side(table: DataFrame, name: str) -> DataFrame:
        marks = [F.lit(int(n == name)).cast("bigint").alias(n) for n in ("_left", "_right")]
        return table.select(*keys, *marks)

    both = side(left, "_left").unionAll(side(right, "_right"))
    counted = both.groupBy(*keys).agg(F.sum("_left").alias("left_n"), F.sum("_right").alias("right_n"))
    return counted.filter("left_n <> right_n")


def missing_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that only one side has: ``missing_in`` is left or right, with the other's rows ``n``."""
    found = key_differences(left, right, keys).filter("left_n = 0 OR right_n = 0")
    return found.select(
        *keys,
        F.when(F.col("left_n") == 0, "left").otherwise("right").alias("missing_in"),
        (F.col("left_n") + F.col("right_n")).alias("n"),
    )


def layer_differences(
    keyed: DataFrame, host_map: DataFrame, companies: DataFrame, signals: DataFrame, accounts: DataFrame
) -> DataFrame:
    """The keys that are lost or added between neighbouring layers, in long form.

    ``step`` names the two layers, ``observation`` and ``company`` the key.
    Hosts that are not resolved have no place in the map and aren't told.
    """
    observed = ("ip_str", "port", "ts")
    resolved = keyed.filter(F.col("company_key").isNotNull())
    # a row with a null port or time has no counterpart in the join of hosts and map
    joinable = host_map.filter(F.col("port").isNotNull() & F.col("ts").isNotNull())
    no_company = F.lit(None).cast("string")

    def told(step: str, found: DataFrame, names: Sequence[str]) -> DataFrame:
        parts = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in names]
        text = F.concat_ws("|", *parts)
        observation, company = (text, no_company) if names == observed else (no_company, text)
        return found.select(
            F.lit(step).alias("step"), observation.alias("observation"), company.alias("company"),
            "missing_in", "n",
        )

    steps = (
        ("hosts to map", missing_keys(resolved, host_map, observed), observed),
        ("map to join", missing_keys(host_map, joinable, observed), observed),
        ("companies to signals", missing_keys(companies, signals, COMPANY_KEY), COMPANY_KEY),
        ("companies to accounts", missing_keys(companies, accounts, COMPANY_KEY), COMPANY_KEY),
    )
    long = None
    for step, found, names in steps:
        rows = told(step, found, names)
        long = rows if long is None else long.unionByName(rows)
    return long


# --- two exports -----------------------------------------------------------------------------


def row_digest(columns: Sequence[str]) -> Column:
    """128 bits of the values as text; a hash of the values would pass over nulls, also in arrays."""
    return F.unhex(F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})))


_OWN = tuple(c for c in ACCOUNT_FROM_COMPANY if c not in COMPANY_KEY)


def _narrow(accounts: DataFrame, name: str) -> DataFrame:
    return accounts.select(
        *COMPANY_KEY,
        F.struct(
            "band", "contact_score", row_digest(_OWN).alias("own"), row_digest(ACCOUNT_FROM_SIGNALS).alias("signals")
        ).alias(name),
    )


def account_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """What changed between the accounts of two exports, one row per changed company and tier.

    ``change``: ``new``, ``gone``, ``band`` (it moved to another band), ``score``
    (another score in the same band), ``signals`` or ``company`` (other values
    behind the same score); the first of these that holds. ``signals_changed``
    and ``company_changed`` tell about the values of both sides, null where one
    is missing. Rows travel as key, band, score and digests: each table is
    shuffled once, and narrow.
    """
    both = _narrow(before, "was").join(_narrow(after, "now"), list(COMPANY_KEY), "full")
    was, now = F.col("was"), F.col("now")
    other = {c: ~was[c].eqNullSafe(now[c]) for c in ("band", "contact_score", "own", "signals")}
    change = (
        F.when(was.isNull(), "new").when(now.isNull(), "gone").when(other["band"], "band")
        .when(other["contact_score"], "score").when(other["signals"], "signals").when(other["own"], "company")
    )
    lasting = was.isNotNull() & now.isNotNull()
    return both.withColumn("change", change).filter(F.col("change").isNotNull()).select(
        *COMPANY_KEY, "change",
        was["band"].alias("band_before"), now["band"].alias("band_after"),
        was["contact_score"].alias("score_before"), now["contact_score"].alias("score_after"),
        F.when(lasting, other["signals"]).alias("signals_changed"),
        F.when(lasting, other["own"]).alias("company_changed"),
    )


def change_summary(changes: DataFrame) -> DataFrame:
    """Companies per kind of change and pair of bands."""
    return changes.groupBy("change", "band_before", "band_after").agg(F.count("*").alias("n"))
