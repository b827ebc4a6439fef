"""Account score columns: fit, urgency, contact score, band and the reasons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scanledger import config
from scanledger.config import ScoreRules
from scanledger.functions.common import fill, round_half_up


def _points(condition: Column, points: float, otherwise: float = 0) -> Column:
    return F.when(condition, F.lit(float(points))).otherwise(F.lit(float(otherwise)))


def fit_score(rules: ScoreRules = ScoreRules()) -> Column:
    """How well the account fits the customer profile (0-100)."""
    capped = F.least(F.col("host_count"), F.lit(rules.size_cap)).cast("double")
    size = F.when(F.col("likely_infra_or_proxy"), F.lit(0.0)).otherwise(
        capped / F.lit(float(rules.size_cap)) * F.lit(float(rules.size_points))
    )
    return (
        _points(F.col("resolution_tier") == "domain", rules.domain_points)
        + size
        + _points(F.col("database_tag_count") > 0, rules.database_points, rules.no_database_points)
        + _points(
            F.col("primary_country_code").isin(*rules.target_countries),
            rules.target_points,
            rules.other_country_points,
        )
    )


def urgency_score(rules: ScoreRules = ScoreRules()) -> Column:
    """How exposed the account is now (0-100)."""
    cap = F.lit(float(rules.epss_points))
    graded = (
        F.least(cap * F.coalesce(F.col("max_epss"), F.lit(0.0)), cap)
        + _points(F.col("has_recent_cve"), rules.recent_points)
        + _points(F.col("verified_cve_count") > 0, rules.verified_points)
        + _points(F.col("eol_count") > 0, rules.eol_points)
        + _points(F.col("self_signed_count") > 0, rules.self_signed_points)
        + _points(F.col("risky_open_port_count") > 0, rules.risky_port_points)
    )
    compromised = (F.col("c2_count") > 0) | F.col("has_screenshot_evidence")
    return F.when(compromised, F.lit(rules.override_urgency)).otherwise(graded)


def contact_score() -> Column:
    return F.round(F.lit(0.5) * F.col("fit_score") + F.lit(0.5) * F.col("urgency_score"))


def band(rules: ScoreRules = ScoreRules()) -> Column:
    score = F.col("contact_score")
    return (
        F.when((F.col("honeypot_count") > 0) | F.col("likely_infra_or_proxy"), "exclude")
        .when(score >= rules.contact_cut, "contact")
        .when(score >= rules.review_cut, "review")
        .otherwise("skip")
    )


def why(rules: ScoreRules = ScoreRules()) -> Column:
    """Ordered reasons; a sentence whose figure is NULL is left out."""

    def counted(column: str, template: str) -> Column:
        return F.when(F.col(column) > 0, fill(template, F.col(column)))

    seen_text = F.left(F.col("screenshot_evidence_text"), F.lit(rules.screenshot_text_chars))
    screenshot = F.concat(
        F.lit(config.WHY_SCREENSHOT),
        F.coalesce(fill(config.WHY_SCREENSHOT_TEXT, seen_text), F.lit("")),
    )
    epss = round_half_up(F.coalesce(F.col("max_epss"), F.lit(0.0)), 2)
    return F.array_compact(
        F.array(
            F.when(F.col("has_screenshot_evidence"), screenshot),
            F.when(
                F.col("cve_count") > 0,
                fill(config.WHY_CVE, F.col("cve_count"), F.col("max_cvss"), epss),
            ),
            counted("verified_cve_count", config.WHY_VERIFIED),
            F.when(F.col("has_recent_cve"), F.lit(config.WHY_RECENT)),
            counted("eol_count", config.WHY_EOL),
            counted("self_signed_count", config.WHY_SELF_SIGNED),
            counted("risky_open_port_count", config.WHY_RISKY_PORT),
            counted("c2_count", config.WHY_C2),
            counted("database_tag_count", config.WHY_DATABASE),
            F.when(F.col("honeypot_count") > 0, F.lit(config.WHY_HONEYPOT)),
            F.when(F.col("likely_infra_or_proxy"), F.lit(config.WHY_INFRA)),
        )
    )
