"""Scan observations derived from the star-schema tables.

The given tables hold no scan data, so every query works on observations that
are computed from all rows of ``events`` (with customer, nation and page
attributes). The same recipe is stated once and rendered for both engines;
only literals of arrays, maps and structs differ. Spark takes the parts of an
address once per page, and deals out the events before the costly row work: a
file of one row group would be one task, and so would every layer behind it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanledger import config
from scanledger.functions.hosts import tag_flags

_TABLES = ("events", "customer", "nation", "pages")

HOST_OF_URL = "regexp_extract(url, '://([^/:]+)', 1)"
SITE_OF_URL = f"regexp_replace({HOST_OF_URL}, '^(www|blog|m)[.]', '')"
NBSP = "\u00a0"

# Scalar columns: the same expression in both dialects.
_SCALARS = {
    "ip_str": """CASE WHEN event_id % 83 = 0 THEN NULL
        ELSE concat('10.', CAST(user_id % 256 AS STRING), '.',
                    CAST(CAST(floor(event_id / 256) AS BIGINT) % 256 AS STRING), '.',
                    CAST(event_id % 256 AS STRING)) END""",
    "port": """CAST(CASE WHEN event_id % 157 = 0 THEN NULL
        WHEN event_id % 12 = 0 THEN 80 WHEN event_id % 12 = 1 THEN 22
        WHEN event_id % 60 = 2 THEN 3389 WHEN event_id % 60 = 3 THEN 6379
        WHEN event_id % 12 = 4 THEN 8443 WHEN event_id % 60 = 5 THEN 5901
        ELSE 443 END AS BIGINT)""",
    "transport": "CASE WHEN event_id % 9 = 0 THEN 'udp' ELSE 'tcp' END",
    "ts": "CASE WHEN event_id % 163 = 0 THEN NULL ELSE ts END",
    "country_code": """CASE WHEN n_nationkey = 0 THEN 'US' WHEN n_nationkey = 1 THEN 'DE'
        WHEN n_nationkey = 2 THEN 'CN' WHEN n_nationkey = 3 THEN NULL
        ELSE concat('N', CAST(n_nationkey AS STRING)) END""",
    "country_name": "n_name",
    "city": "CASE WHEN event_id % 6 = 0 THEN NULL ELSE c_mktsegment END",
    "latitude": "CAST(n_nationkey AS DOUBLE) * 1.5E0",
    "longitude": "CAST(n_regionkey AS DOUBLE) * 2.5E0",
    "org": f"""CASE WHEN copy_no = 3 THEN 'Copy Holdings'
        WHEN event_id % 500 = 0 THEN NULL WHEN event_id % 500 = 1 THEN ''
        WHEN event_id % 500 = 2 THEN '.' WHEN event_id % 500 = 3 THEN 'Acme Ltd. , '
        WHEN event_id % 500 = 4 THEN '{NBSP}Acme Ltd{NBSP}'
        WHEN c_custkey % 10 = 0 THEN 'Google LLC' WHEN c_custkey % 10 = 1 THEN 'Deutsche Telekom AG'
        WHEN c_custkey % 10 = 2 THEN concat(c_mktsegment, ' Communications')
        WHEN event_id % 3 = 0 THEN concat(c_mktsegment, ' ', CAST(c_custkey % 400 AS STRING), ' Ltd.')
        ELSE concat(c_mktsegment, ' ', CAST(c_custkey % 400 AS STRING), ' Ltd') END""",
    "isp": """CASE WHEN event_id % 12 = 5 THEN NULL
        WHEN event_id % 97 = 1 THEN 'Hetzner Online GmbH'
        ELSE concat('Carrier ', CAST(n_regionkey AS STRING)) END""",
    "asn": "CASE WHEN event_id % 71 = 0 THEN NULL ELSE concat('AS', CAST(64512 + c_nationkey AS STRING)) END",
    "os": "CASE WHEN event_id % 20 = 0 THEN 'Linux' END",
    "product": "CASE WHEN event_id % 6 = 1 THEN event_type END",
    "devicetype": "CASE WHEN event_id % 20 = 0 THEN 'router' END",
    "ssl_jarm": "CASE WHEN event_id % 9 = 1 THEN CAST(event_id AS STRING) END",
    "http_status": """CAST(CASE WHEN event_id % 3 = 0 THEN 200 WHEN event_id % 3 = 1 THEN 404
        END AS BIGINT)""",
    "http_server": "CASE WHEN event_id % 3 = 0 THEN event_type END",
    "http_title": "CASE WHEN event_id % 3 = 1 THEN event_type END",
    "shodan_module": "CASE WHEN event_id % 2 = 0 THEN 'https' ELSE 'auto' END",
    "screenshot_text": """CASE WHEN event_type = 'signup' AND event_id % 7 = 0
        THEN concat('Login: user', CAST(user_id AS STRING)) END""",
}

# Nested columns: {name: (Spark, DuckDB)}.
_ARRAY = {"spark": "array({})", "duck": "[{}]"}
_EMPTY = {"spark": "CAST(array() AS ARRAY<STRING>)", "duck": "CAST([] AS VARCHAR[])"}


def _nested(dialect: str) -> dict[str, str]:
    arr, empty = _ARRAY[dialect], _EMPTY[dialect]
    null_text = "CAST(NULL AS STRING)"
    struct, mapping = {
        "spark": (
            "named_struct('cvss', CAST({cvss} AS DOUBLE), 'cvss_version', CAST(3.1 AS DOUBLE), "
            "'cvss_v2', CAST(NULL AS DOUBLE), 'summary', CAST(NULL AS STRING), "
            "'verified', {verified}, 'epss', CAST({epss} AS DOUBLE), "
            "'ranking_epss', CAST(NULL AS DOUBLE))",
            "map({k1}, {v1}, {k2}, {v2})",
        ),
        "duck": (
            "{{'cvss': CAST({cvss} AS DOUBLE), 'verified': {verified}, "
            "'epss': CAST({epss} AS DOUBLE)}}",
            "MAP {{{k1}: {v1}, {k2}: {v2}}}",
        ),
    }[dialect]
    recent = struct.format(
        cvss="least(floor(value) / 10, 10)", verified="event_id % 13 = 0",
        epss="least(value / 200, 1)",
    )
    old = struct.format(cvss="7.5", verified="CAST(NULL AS BOOLEAN)", epss="NULL")
    vulns = mapping.format(
        k1="concat('CVE-20', CAST(18 + event_id % 9 AS STRING), '-1000')", v1=recent,
        k2="'CVE-2014-0160'", v2=old,
    )
    return {
        "hostnames": f"""CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 5 = 1 THEN {empty}
            WHEN event_id % 35 = 2 THEN {arr.format(f"concat('77-163-107-27.fixed.', {HOST_OF_URL})")}
            WHEN event_id % 35 = 3 THEN {arr.format(f"concat('179.202.41.212.', {HOST_OF_URL})")}
            WHEN event_id % 35 = 4 THEN {arr.format(f"concat('a.CUST.', {HOST_OF_URL})")}
            WHEN event_id % 35 = 7 THEN {arr.format(f"{null_text}, {HOST_OF_URL}")}
            ELSE {arr.format(HOST_OF_URL + ", 'alt.example'")} END""",
        "domains": f"""CASE WHEN event_id % 4 = 0 THEN NULL
            WHEN event_id % 4 = 1 THEN {arr.format("'AmazonAWS.com', '37.in-addr.arpa', 'vds.'")}
            WHEN event_id % 12 = 2 THEN {arr.format("'amazon.com', 'foo.amazonaws.com'")}
            WHEN event_id % 44 = 3 THEN {arr.format(f"{null_text}, concat('Shop.', {SITE_OF_URL}, '.')")}
            WHEN event_id % 44 = 6 THEN {empty}
            ELSE {arr.format(f"'localhost.', {SITE_OF_URL}")} END""",
        "tags": f"""CASE event_type WHEN 'view' THEN NULL
            WHEN 'error' THEN CASE WHEN event_id % 4 = 0 THEN {arr.format("'eol-product', 'self-signed'")}
                WHEN event_id % 4 = 1 THEN {arr.format("'eol-product'")} ELSE {empty} END
            WHEN 'purchase' THEN CASE WHEN event_id % 5 = 0 THEN {arr.format("'database'")} ELSE {empty} END
            WHEN 'click' THEN CASE WHEN event_id % 31 = 0 THEN {arr.format("'vpn', " + null_text)}
                ELSE {empty} END
            ELSE CASE WHEN event_id % 97 = 0 THEN {arr.format("'c2'")}
                WHEN event_id % 89 = 0 THEN {arr.format("'honeypot'")}
                ELSE {arr.format("'vpn', 'iot'")} END END""",
        "cpe23": f"CASE WHEN event_id % 6 = 1 THEN {arr.format('event_type')} END",
        "vulns": f"CASE WHEN event_type = 'error' AND value > 20 THEN {vulns} END",
        "screenshot_labels": f"""CASE WHEN event_type = 'signup' AND event_id % 7 = 0
            THEN {arr.format("'windows'")} END""",
    }


def _source_rows(dialect: str) -> str:
    """Events with their attributes; some rows are observed two or three times."""
    count = "CASE WHEN event_id % 211 = 0 THEN 3 WHEN event_id % 223 = 0 THEN 2 ELSE 1 END"
    # neighbouring events stay together, which the tables' compression needs
    block = ", CAST(floor(s.event_id / 1024) AS BIGINT) AS event_block"
    pages, parts, dealt, block = {
        "spark": (
            f"(SELECT page_id, {HOST_OF_URL} AS url_host, {SITE_OF_URL} AS url_site FROM {{pages}})",
            "p.url_host, p.url_site", "/*+ REPARTITION(event_block) */ ", block,
        ),
        "duck": ("{pages}", "p.url", "", ""),
    }[dialect]
    copies = {
        "spark": f"LATERAL VIEW explode(sequence(1, {count})) v AS copy_no",
        "duck": f", unnest(range(1, 1 + {count})) AS v(copy_no)",
    }[dialect]
    return f"""SELECT e.*, c.c_custkey, c.c_mktsegment, c.c_nationkey, n.n_nationkey, n.n_name,
            n.n_regionkey, {parts}, CAST(copy_no AS BIGINT) AS copy_no
        FROM (SELECT {dealt}s.*, s.event_id % (SELECT count(*) FROM {{pages}}) AS page_no{block} FROM {{events}} s) e
        JOIN {{customer}} c ON c.c_custkey = e.user_id
        JOIN {{nation}} n ON n.n_nationkey = c.c_nationkey
        JOIN {pages} p ON p.page_id = e.page_no {copies}"""


def _select(dialect: str) -> str:
    recipe = {**_SCALARS, **_nested(dialect)}
    columns = ",\n        ".join(f"{expr} AS {name}" for name, expr in recipe.items())
    if dialect == "spark":
        columns = columns.replace(SITE_OF_URL, "url_site").replace(HOST_OF_URL, "url_host")
    return f"SELECT event_id, copy_no,\n        {columns}\n    FROM ({_source_rows(dialect)}) q"


def _with_tables(sql: str, tables: dict[str, str]) -> str:
    for name, source in tables.items():
        sql = sql.replace("{" + name + "}", source)
    return sql


def host_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations with the 34 host columns plus (event_id, copy_no)."""
    tables = {name: f"parquet.`{sf_dir}/{name}.parquet`" for name in _TABLES}
    rows = spark.sql(_with_tables(_select("spark"), tables))
    return rows.select("*", *tag_flags(F.col("tags")))


def host_sql() -> str:
    """The same observations as DuckDB SQL over the registered tables."""
    text = _with_tables(_select("duck"), {name: name for name in _TABLES})
    flags = ",\n        ".join(
        f"CASE WHEN tags IS NOT NULL THEN coalesce(list_contains(tags, '{tag}'), false) END AS {flag}"
        for flag, tag in config.TAG_FLAGS.items()
    )
    return f"SELECT b.*,\n        {flags}\n    FROM ({text}) b"
