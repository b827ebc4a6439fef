"""Contact enrichment around the external address search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanledger.functions.contacts import (
    best_of_reply, contact_rank, parsed_reply, preference, reply_emails, reply_organization,
)
from scanledger.operators.accounts import filter_band
from scanledger.schemas import CONTACT_FIELDS


def enrichment_candidates(
    accounts: DataFrame, limit: int = 25, include_adjudicated: bool = False
) -> DataFrame:
    """Best domain-tier accounts to look up; the search quota sets the limit."""
    if include_adjudicated:
        ready = accounts.filter(
            (F.col("final_label") == "contact") & (F.col("resolution_tier") == "domain")
        )
    else:
        ready = filter_band(accounts, "contact", "domain")
    return (
        ready.orderBy(F.desc("contact_score"), "company_key")
        .limit(limit)
        .select("company_key", "primary_country_code", "contact_score", "why")
    )


def best_contacts(hits: DataFrame, with_smtp_fallback: bool = True) -> DataFrame:
    """Best address and number of addresses per company, from one row per address.

    A running minimum, combined on the map side: no list of the addresses is
    built, whatever their number. ``place`` is the position in the reply. The
    entry is kept whole, with all of CONTACT_FIELDS that ``hits`` has.
    """
    entry = [c for c in CONTACT_FIELDS if c in hits.columns]
    smtp = F.col("smtp_status_percentage") if with_smtp_fallback else None
    rank = contact_rank(F.col("confidence"), smtp)
    return hits.groupBy("company_key").agg(
        F.min_by(
            F.struct(*entry), preference(F.col("position"), rank, F.col("place"))
        ).alias("contact"),
        F.count("*").alias("raw_email_count"),
    )


def contacts_from_replies(replies: DataFrame, candidates: DataFrame | None = None) -> DataFrame:
    """Best address of each company, from ``company_key`` and the JSON texts of its search replies.

    Both forms of reply are read, each text once. All replies of a company
    count: the best address of all of them is chosen, their addresses are
    summed. At equal preference the earlier reply by ``page`` goes first, if
    there is such a column, then the earlier place in a reply, then the smaller
    address. A reply without addresses, an error or a text that is no JSON adds
    nothing; a company that has only such replies has no contact and count 0.

    With ``candidates`` only the replies of these companies are parsed; they
    are as many as are looked up, which bounds the broadcast.
    """
    if candidates is not None:
        wanted = F.broadcast(candidates.select("company_key").distinct())
        replies = replies.join(wanted, "company_key", "left_semi")
    page = F.col("page") if "page" in replies.columns else F.lit(0)
    parsed = replies.select("company_key", page.alias("page"), parsed_reply(F.col("reply")).alias("parsed"))
    found = parsed.select(
        "company_key", "page", reply_organization(F.col("parsed")).alias("organization"),
        reply_emails(F.col("parsed")).alias("emails"),
    ).select(
        "company_key", "page", "organization", best_of_reply(F.col("emails")).alias("best"),
        F.coalesce(F.size("emails"), F.lit(0)).cast("bigint").alias("n"),
    )
    key = F.col("best.key")
    order = F.struct(key["other_title"], key["rank"], F.col("page"), key["place"], F.col("best.entry.email"))
    return found.groupBy("company_key").agg(
        F.min_by("organization", F.when(F.col("organization").isNotNull(), F.col("page"))).alias("organization"),
        F.min_by("best.entry", F.when(F.col("best").isNotNull(), order)).alias("contact"),
        F.sum("n").alias("raw_email_count"),
    )


def contact_report(candidates: DataFrame, contacts: DataFrame) -> DataFrame:
    """One record per looked-up account, also for those without a contact.

    ``contacts`` holds the whole chosen entry and, if the search tells it, the
    organization.
    """
    if "organization" not in contacts.columns:
        contacts = contacts.withColumn("organization", F.lit(None).cast("string"))
    return candidates.join(contacts, "company_key", "left").select(
        "company_key",
        "contact_score",
        F.col("primary_country_code").alias("country"),
        "organization",
        "contact",
        F.coalesce("raw_email_count", F.lit(0)).alias("raw_email_count"),
    )


def contact_yield(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count("contact").alias("contacts_found"), F.count("*").alias("accounts")
    )
