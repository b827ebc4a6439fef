"""The layers as DuckDB SQL, written from the published semantics.

This is the independent statement the Spark results are checked against, so
it takes the direct road: it really joins every pair of host and map rows,
ranks every value and sorts every list.
"""

from __future__ import annotations

from scanledger import config
from workload import recipes
from workload.observations import host_sql


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


_DENIED = config.SHARED_INFRA_DOMAINS + config.BRAND_DOMAINS + config.PLACEHOLDER_DOMAINS
_PORTS = ", ".join(str(p) for p in config.RISKY_PORTS)

KEYED = f"""
    SELECT t.*,
        CASE WHEN resolution_tier = 'domain' THEN lower(candidate_domain)
             WHEN resolution_tier = 'org'
             THEN rtrim(lower(trim(org)), concat(' .,', chr(9), chr(10), chr(12), chr(13))) END AS company_key
    FROM (
        SELECT f.*,
            CASE WHEN coalesce(NOT is_dynamic_ptr, false) AND NOT is_hyperscaler_org
                      AND candidate_domain IS NOT NULL THEN 'domain'
                 WHEN is_hyperscaler_org OR is_generic_isp_org OR org IS NULL THEN 'unresolved'
                 ELSE 'org' END AS resolution_tier
        FROM (
            SELECT h.*,
                [d FOR d IN domains
                 IF d IS NOT NULL AND NOT list_contains([{_quoted(_DENIED)}], lower(d))
                    AND NOT ends_with(lower(d), '.arpa')
                    AND strpos(CASE WHEN ends_with(d, '.') THEN left(d, length(d) - 1) ELSE d END, '.') > 0
                ][1] AS candidate_domain,
                CASE WHEN len(hostnames) >= 1 THEN
                    regexp_matches(hostnames[1], '(^(ip-)?[0-9]+(-[0-9]+){{2,}})|(^([0-9]{{1,3}}\\.){{4}})')
                    OR regexp_matches(lower(hostnames[1]), '\\.(static|dynamic|cust|customer|pool|dsl|dial|dhcp)\\.')
                    ELSE false END AS is_dynamic_ptr,
                len([w FOR w IN [{_quoted(config.HYPERSCALER_KEYWORDS)}]
                     IF contains(lower(coalesce(org, '')), w) OR contains(lower(coalesce(isp, '')), w)]) > 0
                    AS is_hyperscaler_org,
                len([w FOR w IN [{_quoted(config.GENERIC_ISP_KEYWORDS)}]
                     IF contains(lower(coalesce(org, '')), w)]) > 0 AS is_generic_isp_org
            FROM hosts h
        ) f
    ) t
"""

HOST_MAP = """
    SELECT ip_str, port, ts, company_key, resolution_tier FROM keyed
    WHERE resolution_tier <> 'unresolved'
"""


def _mode(attribute: str) -> str:
    return f"""
    (SELECT {attribute} FROM keyed v
     WHERE v.company_key = g.company_key AND v.resolution_tier = g.resolution_tier
       AND {attribute} IS NOT NULL
     GROUP BY {attribute} ORDER BY count(*) DESC, {attribute} LIMIT 1)"""


COMPANIES = f"""
    SELECT g.*,
        {_mode("country_code")} AS primary_country_code,
        {_mode("country_name")} AS primary_country_name,
        {_mode("org")} AS primary_org,
        {_mode("isp")} AS primary_isp,
        host_count >= 500 AS likely_infra_or_proxy
    FROM (
        SELECT company_key, resolution_tier, count(*) AS host_count,
            count(DISTINCT country_code) AS country_count, count(DISTINCT asn) AS asn_count,
            list_sort(list(DISTINCT ip_str), 'ASC', 'NULLS LAST')[1:5] AS sample_ips,
            list_sort(list(DISTINCT hostnames[1]), 'ASC', 'NULLS LAST')[1:5] AS sample_hostnames
        FROM keyed WHERE company_key IS NOT NULL
        GROUP BY company_key, resolution_tier
    ) g
"""

_FEATURES = f"""
    SELECT *,
        CAST(coalesce(cardinality(vulns), 0) AS BIGINT) AS row_cve_count,
        CAST(coalesce(len([v FOR v IN map_values(vulns) IF coalesce(v.verified, false)]), 0) AS BIGINT)
            AS row_verified_cve_count,
        list_aggregate([v.cvss FOR v IN map_values(vulns)], 'max') AS row_max_cvss,
        list_aggregate([v.epss FOR v IN map_values(vulns)], 'max') AS row_max_epss,
        coalesce(len([c FOR c IN map_keys(vulns) IF regexp_matches(c, 'CVE-202[5-9]-')]), 0) > 0
            AS row_has_recent_cve,
        port IN ({_PORTS}) AS is_risky_port
    FROM {{rows}}
"""
FEATURES = _FEATURES.replace("{rows}", "hosts")
KEYED_FEATURES = _FEATURES.replace("{rows}", "keyed")

SIGNALS = """
    SELECT m.company_key, m.resolution_tier,
        count(*) AS host_count,
        CAST(sum(row_cve_count) AS BIGINT) AS cve_count,
        CAST(sum(row_verified_cve_count) AS BIGINT) AS verified_cve_count,
        max(row_max_cvss) AS max_cvss,
        max(row_max_epss) AS max_epss,
        bool_or(row_has_recent_cve) AS has_recent_cve,
        count(*) FILTER (is_eol_product) AS eol_count,
        count(*) FILTER (is_self_signed) AS self_signed_count,
        count(*) FILTER (is_honeypot) AS honeypot_count,
        count(*) FILTER (is_c2) AS c2_count,
        count(*) FILTER (is_iot) AS iot_count,
        count(*) FILTER (is_vpn) AS vpn_count,
        count(*) FILTER (is_database_tag) AS database_tag_count,
        count(*) FILTER (is_risky_port) AS risky_open_port_count,
        count(DISTINCT h.port) AS distinct_port_count,
        count(screenshot_text) > 0 AS has_screenshot_evidence,
        max(screenshot_text) AS screenshot_evidence_text
    FROM features h JOIN host_map m
        ON h.ts = m.ts AND h.port = m.port AND h.ip_str IS NOT DISTINCT FROM m.ip_str
    GROUP BY m.company_key, m.resolution_tier
"""

_JOINED = """
    SELECT c.company_key, c.resolution_tier, c.host_count, c.primary_country_code,
        c.primary_country_name, c.asn_count, c.primary_org, c.primary_isp, c.sample_ips,
        c.sample_hostnames, c.likely_infra_or_proxy,
        s.* EXCLUDE (company_key, resolution_tier, host_count, iot_count, vpn_count)
    FROM companies c JOIN signals s USING (company_key, resolution_tier)
"""

_COUNTRIES = _quoted(config.TARGET_COUNTRIES)

SCORED = f"""
    SELECT j.*,
        CAST(if(resolution_tier = 'domain', 40, 0) AS DOUBLE)
        + if(likely_infra_or_proxy, 0e0, CAST(least(host_count, 20) AS DOUBLE) / 20e0 * 20e0)
        + if(database_tag_count > 0, 20, 5)
        + if(coalesce(primary_country_code IN ({_COUNTRIES}), false), 20, 10) AS fit_score,
        if(c2_count > 0 OR has_screenshot_evidence, 100e0,
            least(25e0 * coalesce(max_epss, 0e0), 25e0)
            + if(has_recent_cve, 10, 0) + if(verified_cve_count > 0, 10, 0)
            + if(eol_count > 0, 15, 0) + if(self_signed_count > 0, 10, 0)
            + if(risky_open_port_count > 0, 20, 0)) AS urgency_score
    FROM ({_JOINED}) j
"""


def _said(condition: str, *pieces: str) -> str:
    return f"CASE WHEN {condition} THEN {' || '.join(pieces)} END"


def _sentence(template: str, *figures: str) -> list[str]:
    pieces: list[str] = []
    for text, figure in zip(template.split("{}"), list(figures) + [None]):
        if text:
            pieces.append(_quoted([text]))
        if figure:
            pieces.append(figure)
    return pieces


_SHOT = _sentence(config.WHY_SCREENSHOT_TEXT, "left(screenshot_evidence_text, 120)")
WHY = ",\n            ".join(
    [
        _said("has_screenshot_evidence", *_sentence(config.WHY_SCREENSHOT),
              f"coalesce({' || '.join(_SHOT)}, '')"),
        _said("cve_count > 0", *_sentence(config.WHY_CVE, "cve_count", "max_cvss",
                                          "round(coalesce(max_epss, 0e0), 2)")),
        _said("verified_cve_count > 0", *_sentence(config.WHY_VERIFIED, "verified_cve_count")),
        _said("has_recent_cve", *_sentence(config.WHY_RECENT)),
        _said("eol_count > 0", *_sentence(config.WHY_EOL, "eol_count")),
        _said("self_signed_count > 0", *_sentence(config.WHY_SELF_SIGNED, "self_signed_count")),
        _said("risky_open_port_count > 0",
              *_sentence(config.WHY_RISKY_PORT, "risky_open_port_count")),
        _said("c2_count > 0", *_sentence(config.WHY_C2, "c2_count")),
        _said("database_tag_count > 0", *_sentence(config.WHY_DATABASE, "database_tag_count")),
        _said("honeypot_count > 0", *_sentence(config.WHY_HONEYPOT)),
        _said("likely_infra_or_proxy", *_sentence(config.WHY_INFRA)),
    ]
)

ACCOUNTS = f"""
    SELECT x.*,
        if(honeypot_count > 0 OR likely_infra_or_proxy, 'exclude',
            if(contact_score >= 85, 'contact', if(contact_score >= 50, 'review', 'skip'))) AS band,
        [w FOR w IN [{WHY}] IF w IS NOT NULL] AS why
    FROM (SELECT s.*, round(0.5e0 * fit_score + 0.5e0 * urgency_score) AS contact_score
          FROM scored s) x
"""

_TYPES = """(CAST(cve_count > 0 AS INTEGER) + CAST(eol_count > 0 AS INTEGER)
        + CAST(self_signed_count > 0 AS INTEGER) + CAST(risky_open_port_count > 0 AS INTEGER)
        + CAST(has_screenshot_evidence AS INTEGER))"""

DECISIONS = f"""
    SELECT company_key, resolution_tier,
        CASE WHEN (({_TYPES} >= 2 OR has_screenshot_evidence)
                   AND (fit_score < 25 OR host_count BETWEEN 1 AND 3))
                  OR regexp_matches(lower(company_key), 'communications|telecom')
                  OR lower(company_key) IN ({_quoted(config.CARRIER_NAMES)}) THEN 'escalate'
             WHEN {_TYPES} >= 2 THEN 'contact' ELSE 'skip' END AS decision,
        'Signal types present: ' || coalesce(nullif(concat_ws(', ',
            CASE WHEN cve_count > 0 THEN 'CVE' END,
            CASE WHEN eol_count > 0 THEN 'end-of-life software' END,
            CASE WHEN self_signed_count > 0 THEN 'self-signed certificate' END,
            CASE WHEN risky_open_port_count > 0 THEN 'risky open port' END,
            CASE WHEN has_screenshot_evidence THEN 'screenshot' END), ''), 'none') AS rationale
    FROM accounts WHERE band = 'review'
"""

GOLD = """
    SELECT a.*, coalesce(d.decision, a.band) AS final_label, d.rationale,
        CASE WHEN d.company_key IS NOT NULL THEN 'medium' END AS confidence
    FROM accounts a LEFT JOIN decisions d USING (company_key, resolution_tier)
"""

EMAILS = """
    SELECT company_key, arg_max(email, seq) AS email FROM contact_records
    WHERE has_contact AND email <> '' GROUP BY company_key
"""


def _filled(text: str) -> str:
    for name in recipes.TABLES:
        text = text.replace("{" + name + "}", name)
    return text


# Name -> (definition, names it needs).
LAYERS: dict[str, tuple[str, tuple[str, ...]]] = {
    "hosts": (host_sql(), ()),
    "keyed": (KEYED, ("hosts",)),
    "host_map": (HOST_MAP, ("keyed",)),
    "companies": (COMPANIES, ("keyed",)),
    "features": (FEATURES, ("hosts",)),
    "keyed_features": (KEYED_FEATURES, ("keyed",)),
    "signals": (SIGNALS, ("features", "host_map")),
    "scored": (SCORED, ("companies", "signals")),
    "accounts": (ACCOUNTS, ("scored",)),
    "decisions": (DECISIONS, ("accounts",)),
    "gold": (GOLD, ("accounts", "decisions")),
    "hits": (_filled(recipes.EMAIL_HITS), ()),
    "contact_records": (_filled(recipes.CONTACT_RECORDS), ()),
    "emails": (EMAILS, ("contact_records",)),
    "traces": (_filled(recipes.TRACES), ()),
    "eval_pairs": (_filled(recipes.EVAL_PAIRS), ()),
    "replies": (_filled(recipes.replies("duck")), ()),
}


def over(*needed: str, select: str, changed: dict[str, str] | None = None) -> str:
    """``select`` with the layers it reads as common table expressions.

    ``changed`` gives some host columns other values, for a later export.
    """
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for parent in LAYERS[name][1]:
            visit(parent)
        order.append(name)

    for name in needed:
        visit(name)
    texts = {name: LAYERS[name][0] for name in order}
    if changed:
        values = ", ".join(f"{value} AS {name}" for name, value in changed.items())
        texts["hosts"] = f"SELECT * REPLACE ({values}) FROM ({texts['hosts']})"
    tables = ",\n".join(f"{name} AS (\n{text}\n)" for name, text in texts.items())
    return f"WITH {tables}\n{select}"
