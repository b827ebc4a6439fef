"""Scores, bands, reasons, decisions and the overlay."""

import pytest

from scanledger.config import AdjudicationRules
from scanledger.operators import accounts, adjudicate
from tests.helpers import plan_of, rows_of

SCHEMA = """
    company_key STRING, resolution_tier STRING, host_count BIGINT, primary_country_code STRING,
    likely_infra_or_proxy BOOLEAN, cve_count BIGINT, verified_cve_count BIGINT, max_cvss DOUBLE,
    max_epss DOUBLE, has_recent_cve BOOLEAN, eol_count BIGINT, self_signed_count BIGINT,
    honeypot_count BIGINT, c2_count BIGINT, risky_open_port_count BIGINT,
    database_tag_count BIGINT, has_screenshot_evidence BOOLEAN, screenshot_evidence_text STRING
"""


def account(**given):
    row = {
        "company_key": "firm", "resolution_tier": "org", "host_count": 1,
        "primary_country_code": None, "likely_infra_or_proxy": False, "cve_count": 0,
        "verified_cve_count": 0, "max_cvss": None, "max_epss": None, "has_recent_cve": False,
        "eol_count": 0, "self_signed_count": 0, "honeypot_count": 0, "c2_count": 0,
        "risky_open_port_count": 0, "database_tag_count": 0, "has_screenshot_evidence": False,
        "screenshot_evidence_text": None,
    }
    row.update(given)
    return row


def scored(spark, *rows):
    return accounts.score_accounts(spark.createDataFrame([account(**r) for r in rows], SCHEMA))


CVE_ONLY = dict(resolution_tier="domain", primary_country_code="GB", cve_count=76, max_cvss=9.8,
                max_epss=0.99957, has_recent_cve=True)
BROAD = dict(primary_country_code="IT", host_count=43, cve_count=435, max_cvss=10.0,
             max_epss=0.99999, has_recent_cve=True, eol_count=1, self_signed_count=5,
             risky_open_port_count=1)
TINY = dict(primary_country_code="IN", host_count=3, self_signed_count=1, risky_open_port_count=1,
            has_screenshot_evidence=True, screenshot_evidence_text="Ce:")


@pytest.mark.parametrize(
    ("row", "fit", "urgency", "contact", "band"),
    [
        (dict(resolution_tier="domain", host_count=20, database_tag_count=1,
              primary_country_code="DE", c2_count=1), 100.0, 100.0, 100.0, "contact"),
        (CVE_ONLY, 66.0, 34.98925, 50.0, "review"),
        (BROAD, 35.0, 79.99975, 57.0, "review"),
        (TINY, 18.0, 100.0, 59.0, "review"),
        (dict(), 16.0, 0.0, 8.0, "skip"),
        (dict(host_count=900, likely_infra_or_proxy=True), 15.0, 0.0, 8.0, "exclude"),
        (dict(honeypot_count=1, c2_count=1), 16.0, 100.0, 58.0, "exclude"),
        (dict(verified_cve_count=1, has_recent_cve=True, max_epss=1.0, eol_count=1,
              self_signed_count=1, risky_open_port_count=1), 16.0, 90.0, 53.0, "review"),
    ],
)
def test_scores(spark, row, fit, urgency, contact, band):
    got = scored(spark, row).first()
    assert got.fit_score == fit and got.urgency_score == pytest.approx(urgency, abs=1e-9)
    assert (got.contact_score, got.band) == (contact, band)


def test_reasons_in_order(spark):
    assert scored(spark, CVE_ONLY).first().why == [
        "76 known CVE(s), max CVSS 9.8, max EPSS 1.0",
        "Includes a 2025+ (recently disclosed) CVE",
    ]
    assert scored(spark, TINY).first().why[0] == (
        'Screenshot evidence of an exposed remote desktop login (OCR text visible on screen: "Ce:")'
    )
    assert len(scored(spark, BROAD).first().why) == 5


def test_reason_with_unknown_figure_is_left_out(spark):
    assert scored(spark, dict(cve_count=3)).first().why == []


def test_long_screenshot_text_is_cut(spark):
    row = dict(has_screenshot_evidence=True, screenshot_evidence_text="#" * 500)
    assert scored(spark, row).first().why[0].count("#") == 120


def test_epss_is_rounded_like_a_binary_double(spark):
    row = dict(cve_count=1, max_cvss=7.5, max_epss=0.285)
    assert scored(spark, row).first().why[0].endswith("max EPSS 0.28")


@pytest.mark.parametrize(
    ("row", "label"),
    [
        (CVE_ONLY, "skip"), (BROAD, "contact"), (TINY, "escalate"),
        (dict(BROAD, company_key="north communications"), "escalate"),
        (dict(CVE_ONLY, host_count=2, eol_count=1), "escalate"),
        (dict(CVE_ONLY, host_count=9, eol_count=1), "contact"),
    ],
)
def test_written_rule(spark, row, label):
    assert adjudicate.rule_adjudicate(scored(spark, row)).first().final_label == label


def test_rule_order_is_a_parameter(spark):
    rules = AdjudicationRules(order=("contact", "escalate", "skip"))
    assert adjudicate.rule_adjudicate(scored(spark, TINY), rules).first().final_label == "contact"


def test_overlay_keeps_the_band_without_a_decision(spark):
    table = scored(
        spark, dict(BROAD, resolution_tier="org"), dict(CVE_ONLY, company_key="firm"),
        dict(company_key="other"),
    )
    decisions = spark.createDataFrame(
        [("firm", "org", "contact", "why", "high"), ("other", "org", None, None, None)],
        "company_key STRING, resolution_tier STRING, final_label STRING, rationale STRING, confidence STRING",
    )
    overlaid = adjudicate.decision_overlay(table, decisions)
    assert rows_of(overlaid, "company_key", "resolution_tier", "final_label") == [
        ("firm", "domain", "review"), ("firm", "org", "contact"), ("other", "org", "skip")
    ]
    by_name = adjudicate.decision_overlay(table, decisions, by_name_only=True)
    assert ("firm", "domain", "contact") in rows_of(
        by_name, "company_key", "resolution_tier", "final_label"
    )


@pytest.mark.parametrize(
    ("reply", "label", "confidence"),
    [
        ('{"label": "skip", "confidence": "high"}', "skip", "high"),
        ('```json\n{"label": "skip"}\n```', "skip", None),
        (' ```\n{"label": "skip"}```  ', "skip", None),
        ('{"label": "skip"} and more', "escalate", "low"),
        ('{"label": "skip"}} and more', "escalate", "low"),
        ('{"label": "skip"}, "x": 1', "escalate", "low"),
        ('{"label": "skip"}], "x": [1', "escalate", "low"),
        ("{'label': 'skip'}", "escalate", "low"),
        ('{"rationale": "none"}', "escalate", None),
        ('{"label": null}', None, None),
        ('{"label": "skip", "label": "contact"}', "contact", None),
        ('["skip"]', "escalate", "low"),
        ('"skip"', "escalate", "low"),
        ("", "escalate", "low"),
        ("no json at all", "escalate", "low"),
    ],
)
def test_parse_decisions(spark, reply, label, confidence):
    row = adjudicate.parse_decisions(spark.createDataFrame([(reply,)], "reply STRING")).first()
    assert (row.final_label, row.confidence) == (label, confidence)


def test_unparseable_reply_is_quoted(spark):
    table = spark.createDataFrame([("  " + "y" * 300,)], "reply STRING")
    row = adjudicate.parse_decisions(table).first()
    assert row.rationale == "unparseable response: " + "y" * 200


def test_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "accounts")
    scored(spark, BROAD, CVE_ONLY).write.parquet(path)
    plan = plan_of(accounts.filter_band(spark.read.parquet(path), "review").select("company_key"))
    assert "EqualTo(band,review)" in plan
    assert "ReadSchema: struct<company_key:string,band:string>" in plan
