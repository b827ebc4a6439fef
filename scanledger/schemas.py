"""Explicit schemas (DDL) of the raw records and of the side tables.

Raw numeric and boolean leaves are read as text and cast afterwards: a typed
JSON leaf turns a quoted "443" or an 80.7 in an integer field into NULL, while
the analytics need them coerced. The entries of the CVE map are read as JSON
text for the same reason: one malformed entry would void the whole map.
"""

#: Folder of each layer; also its name in the table of observed counts.
HOSTS, KEYED, HOST_MAP = "silver/hosts", "silver/keyed", "silver/host_company_map"
COMPANIES, SIGNALS, ACCOUNTS = "silver/companies", "gold/security_signals", "gold/accounts"
ADJUDICATED = "gold/accounts_adjudicated"
#: Layers of the repeated ingest.
HOST_BATCHES, LEDGER = "silver/host_batches", "silver/ingested_files"

RAW_RECORD = """
    ip_str STRING, port STRING, transport STRING, timestamp STRING,
    hostnames ARRAY<STRING>, domains ARRAY<STRING>,
    location STRUCT<country_code: STRING, country_name: STRING, city: STRING,
                    region_code: STRING, latitude: STRING, longitude: STRING>,
    org STRING, isp STRING, asn STRING, os STRING, product STRING, devicetype STRING,
    tags ARRAY<STRING>, cpe23 ARRAY<STRING>,
    vulns MAP<STRING, STRING>,
    ssl STRUCT<jarm: STRING>,
    http STRUCT<status: STRING, server: STRING, title: STRING, host: STRING>,
    _shodan STRUCT<module: STRING, region: STRING, ptr: STRING>,
    screenshot STRUCT<labels: ARRAY<STRING>, text: STRING>
"""

VULN_ENTRY = """
    cvss STRING, cvss_version STRING, cvss_v2 STRING, summary STRING, verified STRING,
    epss STRING, ranking_epss STRING
"""

HOST_COLUMNS = (
    "ip_str", "port", "transport", "ts", "hostnames", "domains",
    "country_code", "country_name", "city", "latitude", "longitude",
    "org", "isp", "asn", "os", "product", "devicetype", "tags", "cpe23", "vulns",
    "ssl_jarm", "http_status", "http_server", "http_title", "shodan_module",
    "screenshot_labels", "screenshot_text",
    "is_eol_product", "is_self_signed", "is_honeypot", "is_c2", "is_iot", "is_vpn",
    "is_database_tag",
)

COMPANY_KEY = ("company_key", "resolution_tier")

MAP_COLUMNS = ("ip_str", "port", "ts", "company_key", "resolution_tier")

COMPANY_COLUMNS = (
    "company_key", "resolution_tier", "host_count", "country_count",
    "primary_country_code", "primary_country_name", "asn_count", "primary_org",
    "primary_isp", "sample_ips", "sample_hostnames", "likely_infra_or_proxy",
)

SIGNAL_COLUMNS = (
    "company_key", "resolution_tier", "host_count", "cve_count", "verified_cve_count",
    "max_cvss", "max_epss", "has_recent_cve", "eol_count", "self_signed_count",
    "honeypot_count", "c2_count", "iot_count", "vpn_count", "database_tag_count",
    "risky_open_port_count", "distinct_port_count", "has_screenshot_evidence",
    "screenshot_evidence_text",
)

# What an account takes over from each side.
ACCOUNT_FROM_COMPANY = tuple(c for c in COMPANY_COLUMNS if c != "country_count")
ACCOUNT_FROM_SIGNALS = tuple(
    c for c in SIGNAL_COLUMNS
    if c not in COMPANY_KEY + ("host_count", "iot_count", "vpn_count")
)

CONTACT_ENTRY = """type: STRING, status: STRING, email: STRING, position: STRING,
    firstName: STRING, lastName: STRING, companyName: STRING, sourcePage: STRING,
    confidence: DOUBLE, smtp_status_percentage: DOUBLE"""

CONTACT_FIELDS = tuple(f.split(":")[0].strip() for f in CONTACT_ENTRY.split(","))

CONTACT_RECORD = f"""
    company_key STRING, contact_score DOUBLE, country STRING, organization STRING,
    contact STRUCT<{CONTACT_ENTRY}>, raw_email_count BIGINT
"""

LABELED_RECORD = """
    id STRING, company_key STRING, resolution_tier STRING,
    input STRUCT<primary_country_code: STRING, host_count: BIGINT, fit_score: DOUBLE,
                 urgency_score: DOUBLE, contact_score: DOUBLE, cve_count: BIGINT,
                 max_cvss: DOUBLE, max_epss: DOUBLE, eol_count: BIGINT,
                 self_signed_count: BIGINT, risky_open_port_count: BIGINT,
                 c2_count: BIGINT, has_screenshot_evidence: BOOLEAN, why: ARRAY<STRING>>,
    expected_label STRING, rationale STRING
"""

LEDGER_RECORD = (
    "source_file STRING, source_path STRING, size_bytes BIGINT, mtime_ms BIGINT, removed BOOLEAN, "
    "batch BIGINT"
)

REPLY_RECORD = "company_key STRING, resolution_tier STRING, reply STRING"

# request and response differ per skill, so they are kept as JSON text.
TRACE_RECORD = """
    ts STRING, call_id STRING, skill STRING, prompt_version STRING, model STRING,
    input_tokens BIGINT, output_tokens BIGINT, latency_ms DOUBLE, cost_usd DOUBLE,
    request STRING, response STRING, decision STRING
"""

# One row per run and label; the last two are the partition columns.
EVAL_REPORT = """
    label STRING, tp BIGINT, fp BIGINT, fn BIGINT, precision DOUBLE, recall DOUBLE, f1 DOUBLE,
    overall_accuracy DOUBLE, model STRING, n_examples BIGINT, total_cost_usd DOUBLE,
    prompt_version STRING, run_no BIGINT
"""

DECISION_RECORD = (
    "company_key STRING, resolution_tier STRING, final_label STRING, "
    "rationale STRING, confidence STRING"
)
