"""Review-band accounts -> decisions -> final labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanledger.config import AdjudicationRules
from scanledger.functions import decisions as fn
from scanledger.operators.accounts import filter_band
from scanledger.schemas import COMPANY_KEY


def adjudication_input(accounts: DataFrame) -> DataFrame:
    """One JSON object per review-band account."""
    return filter_band(accounts, "review").select(
        *COMPANY_KEY, fn.input_json().alias("account_json")
    )


def parse_decisions(replies: DataFrame, reply: str | Column = "reply") -> DataFrame:
    """Add final_label, rationale and confidence read from the reply text.

    Text that is no JSON object, and an object without a label, escalate. An
    explicit null label stays NULL, which leaves the band in force.
    """
    text = F.col(reply) if isinstance(reply, str) else reply
    parsed = replies.withColumn("_text", fn.unfenced(text)).withColumn(
        "_fields", F.when(fn.is_json_object(F.col("_text")), fn.reply_fields(F.col("_text")))
    )
    fields, readable = F.col("_fields"), F.col("_fields").isNotNull()
    labelled = F.coalesce(F.map_contains_key(fields, "label"), F.lit(False))
    return parsed.withColumns(
        {
            "final_label": F.when(labelled, fn.last_field(fields, "label")).otherwise("escalate"),
            "rationale": F.when(readable, fn.last_field(fields, "rationale")).otherwise(
                F.concat(F.lit("unparseable response: "), F.left(F.col("_text"), F.lit(200)))
            ),
            "confidence": F.when(readable, fn.last_field(fields, "confidence")).otherwise("low"),
        }
    ).drop("_text", "_fields")


def decisions_from_replies(replies: DataFrame, order: str | None = None) -> DataFrame:
    """One decision per company and tier from ``company_key, resolution_tier, reply``.

    Of several replies the last by ``order`` counts; without an order, and for
    equal places, the greatest text.
    """
    parsed = parse_decisions(replies).filter(F.col("company_key").isNotNull())
    place = F.struct(*([order] if order else []), "reply")
    fields = F.struct("final_label", "rationale", "confidence")
    last = parsed.groupBy(*COMPANY_KEY).agg(F.max_by(fields, place).alias("decision"))
    return last.select(*COMPANY_KEY, "decision.*")


def decisions_from_traces(traces: DataFrame, skill: str = "account-scoring") -> DataFrame:
    """Decisions of logged calls; request and response are the texts of their JSON."""
    calls = traces.filter(F.col("skill") == skill).select(
        F.get_json_object("request", "$.company_key").alias("company_key"),
        F.get_json_object("request", "$.input.resolution_tier").alias("resolution_tier"),
        F.col("response").alias("reply"),
        "ts",
    )
    return decisions_from_replies(calls, "ts")


def rule_adjudicate(
    review: DataFrame, rules: AdjudicationRules = AdjudicationRules()
) -> DataFrame:
    """Decisions of the written corroboration rule for the given accounts."""
    return review.select(
        *COMPANY_KEY,
        fn.rule_label(rules).alias("final_label"),
        fn.rule_rationale().alias("rationale"),
        F.lit("medium").alias("confidence"),
    )


def decision_overlay(
    accounts: DataFrame, decisions: DataFrame, by_name_only: bool = False
) -> DataFrame:
    """Accounts with final_label: the decision where there is one, else the band.

    The key is the company with its tier. ``by_name_only`` joins on the name
    alone, so a decision also reaches the same name in the other tier.
    """
    key = ["company_key"] if by_name_only else list(COMPANY_KEY)
    decided = decisions.select(
        *key, F.col("final_label").alias("_decision"), "rationale", "confidence"
    )
    joined = accounts.join(decided, key, "left")
    return joined.select(
        *accounts.columns,
        F.coalesce("_decision", "band").alias("final_label"),
        "rationale",
        "confidence",
    )
