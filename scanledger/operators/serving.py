"""Queries of the dashboard and of the account lookup, over the gold table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanledger.functions.common import all_of
from scanledger.sources.readers import usable_emails
from scanledger.schemas import COMPANY_KEY, CONTACT_ENTRY


def _best_first() -> list[Column]:
    return [F.desc("contact_score"), F.asc("company_key"), F.asc("resolution_tier")]


def account_filter(
    label: str | None = None, country: str | None = None, min_score: float | None = None
) -> Column:
    """Conjunction of the given conditions; values are literals, never SQL text."""
    conditions = []
    if label:
        conditions.append(F.col("final_label") == label)
    if country:
        conditions.append(F.col("primary_country_code") == country.upper())
    if min_score is not None:
        conditions.append(F.col("contact_score") >= min_score)
    return all_of(conditions) if conditions else F.lit(True)


def top_accounts(
    accounts: DataFrame, limit: int = 10, band: str | None = "contact"
) -> DataFrame:
    """Best accounts, ties by key; a top-k per task, then one merge."""
    kept = accounts if band is None else accounts.filter(F.col("band") == band)
    return kept.orderBy(*_best_first()).limit(limit)


def query_accounts(
    gold: DataFrame,
    band: str | None = None,
    country: str | None = None,
    min_score: float | None = None,
    limit: int = 10,
) -> DataFrame:
    """Accounts by final label, country and score."""
    return (
        gold.filter(account_filter(band, country, min_score))
        .orderBy(*_best_first())
        .limit(limit)
        .select(
            "company_key",
            F.col("primary_country_code").alias("country"),
            F.col("contact_score").alias("score"),
            F.col("final_label").alias("band"),
        )
    )


def get_account(gold: DataFrame, company_key: str) -> DataFrame:
    """Details of one company; the domain tier goes before the org tier."""
    return (
        gold.filter(F.col("company_key") == company_key)
        .orderBy("resolution_tier")
        .limit(1)
        .select(
            "company_key",
            F.col("primary_country_code").alias("country"),
            F.col("contact_score").alias("score"),
            F.col("final_label").alias("band"),
            "why",
            F.col("rationale").alias("adjudication_rationale"),
        )
    )


def get_contact(
    keys: DataFrame, contacts: DataFrame | None, order_column: str = "record_no"
) -> DataFrame:
    """The whole contact of each key with the outcome of the lookup; the first record counts."""
    if contacts is None:
        return keys.select(
            "company_key",
            F.lit("no enrichment data yet").alias("outcome"),
            F.lit(None).cast(f"STRUCT<{CONTACT_ENTRY}>").alias("contact"),
        )
    # Reduced before the join, so a company with many records arrives as one row.
    first = (
        contacts.groupBy("company_key")
        .agg(F.min_by(F.struct("contact"), order_column)["contact"].alias("contact"))
        .withColumn("_listed", F.lit(True))
    )
    return keys.join(first, "company_key", "left").select(
        "company_key",
        F.when(F.col("_listed").isNull(), "not in the enriched set")
        .when(F.col("contact").isNull(), "no contact found for this company")
        .otherwise("found")
        .alias("outcome"),
        "contact",
    )


def contact_lookup(top: DataFrame, contacts: DataFrame, order_column: str = "record_no") -> DataFrame:
    """Attach the email address to a few accounts; companies without one keep NULL.

    Only the records of these accounts reach the aggregation: ``top`` has as
    many rows as are shown, which bounds the broadcast.
    """
    wanted = F.broadcast(top.select("company_key").distinct())
    emails = usable_emails(contacts.join(wanted, "company_key", "left_semi"), order_column)
    return top.join(emails, "company_key", "left")


def dashboard_top(
    gold: DataFrame, contacts: DataFrame | None = None, limit: int = 20, order_column: str = "record_no"
) -> DataFrame:
    top = top_accounts(gold, limit, band=None).select(
        "company_key",
        "resolution_tier",
        F.col("primary_country_code").alias("country"),
        F.col("contact_score").alias("score"),
        F.col("final_label").alias("band"),
        F.col("fit_score").alias("fit"),
        F.col("urgency_score").alias("urgency"),
    )
    return top if contacts is None else contact_lookup(top, contacts, order_column)


def dashboard_counts(gold: DataFrame, countries: int = 8) -> DataFrame:
    """Counts by label, country and tier, the total and the number of countries.

    One scan and one shuffle of partial counts for all groupings; the country
    ranking runs over the counts.
    """
    label, country, tier = "final_label", "primary_country_code", "resolution_tier"
    grouped = (
        gold.select(label, country, tier)
        .groupingSets([[label], [country], [tier], []], label, country, tier)
        .agg(F.count("*").alias("n"), F.grouping_id().alias("_set"))
    )
    section = (
        F.when(F.col("_set") == 0b011, "bands")
        .when(F.col("_set") == 0b101, "countries")
        .when(F.col("_set") == 0b110, "tiers")
        .otherwise("total")
    )
    counts = grouped.select(
        section.alias("section"), F.coalesce(label, country, tier).alias("label"), "n"
    ).filter((F.col("section") != "countries") | F.col("label").isNotNull())
    by_size = Window.partitionBy("section").orderBy(F.desc("n"), "label")
    listed = (
        counts.withColumn("_rank", F.row_number().over(by_size))
        .filter((F.col("section") != "countries") | (F.col("_rank") <= countries))
        .drop("_rank")
    )
    country_count = counts.agg(
        F.lit("country_count").alias("section"),
        F.lit(None).cast("string").alias("label"),
        F.count_if(F.col("section") == "countries").alias("n"),
    )
    return listed.unionByName(country_count)


def dashboard_stats(
    gold: DataFrame, contacts: DataFrame | None = None, countries: int = 8, limit: int = 20,
    order_column: str = "record_no",
) -> DataFrame:
    """Everything the dashboard shows, as (section, label, value, email)."""
    no_email = F.lit(None).cast("string").alias("email")
    counts = dashboard_counts(gold, countries).select(
        "section", "label", F.col("n").cast("double").alias("value"), no_email
    )
    top = dashboard_top(gold, contacts, limit, order_column).select(
        F.lit("top").alias("section"),
        F.concat_ws("|", *COMPANY_KEY).alias("label"),
        F.col("score").alias("value"),
        no_email if contacts is None else F.col("email"),
    )
    return counts.unionByName(top)


def client_cards(gold: DataFrame, cards: int = 8, limit: int = 20) -> DataFrame:
    """Of the best accounts the contact-ready ones first."""
    return (
        dashboard_top(gold, limit=limit)
        .orderBy(
            F.desc(F.col("band").eqNullSafe("contact")), F.desc("score"), *COMPANY_KEY
        )
        .limit(cards)
    )


def band_share(gold: DataFrame) -> DataFrame:
    """Accounts per label, relative to the largest, with the two headline counts."""
    counts = gold.groupBy("final_label").agg(F.count("*").alias("n"))
    # One row per label reaches this window.
    every_label = Window.partitionBy(F.lit(1))

    def headline(label: str) -> Column:
        return F.coalesce(
            F.sum(F.when(F.col("final_label") == label, F.col("n"))).over(every_label), F.lit(0)
        )

    return counts.select(
        "final_label",
        "n",
        (F.col("n") / F.max("n").over(every_label)).alias("share_of_largest"),
        headline("contact").alias("contact_ready"),
        headline("review").alias("needs_review"),
    )
