"""Companies and signals -> scored accounts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanledger.config import ScoreRules
from scanledger.functions import scores
from scanledger.schemas import ACCOUNT_FROM_COMPANY, ACCOUNT_FROM_SIGNALS, COMPANY_KEY


def company_signal_join(companies: DataFrame, signals: DataFrame) -> DataFrame:
    """One row per company that has both sides; the key is unique on both."""
    return companies.select(*ACCOUNT_FROM_COMPANY).join(
        signals.select(*COMPANY_KEY, *ACCOUNT_FROM_SIGNALS), list(COMPANY_KEY)
    )


def score_accounts(joined: DataFrame, rules: ScoreRules = ScoreRules()) -> DataFrame:
    """Add fit, urgency, contact score, band and reasons; narrow."""
    return (
        joined.withColumns(
            {"fit_score": scores.fit_score(rules), "urgency_score": scores.urgency_score(rules)}
        )
        .withColumn("contact_score", scores.contact_score())
        .withColumns({"band": scores.band(rules), "why": scores.why(rules)})
    )


def gold_accounts(
    companies: DataFrame, signals: DataFrame, rules: ScoreRules = ScoreRules()
) -> DataFrame:
    return score_accounts(company_signal_join(companies, signals), rules)


def filter_band(accounts: DataFrame, band: str, tier: str | None = None) -> DataFrame:
    kept = accounts.filter(F.col("band") == band)
    return kept if tier is None else kept.filter(F.col("resolution_tier") == tier)
