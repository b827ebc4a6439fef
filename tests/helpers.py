"""Small hand-made tables with the columns the operators read."""

from __future__ import annotations

import datetime as dt

HOST_SCHEMA = """
    ip_str STRING, port BIGINT, ts TIMESTAMP_NTZ, hostnames ARRAY<STRING>, domains ARRAY<STRING>,
    country_code STRING, country_name STRING, org STRING, isp STRING, asn STRING,
    tags ARRAY<STRING>,
    vulns MAP<STRING, STRUCT<cvss: DOUBLE, verified: BOOLEAN, epss: DOUBLE>>,
    screenshot_text STRING
"""


def host(n: int = 0, **given):
    row = {
        "ip_str": f"10.0.{n // 256}.{n % 256}", "port": 443,
        "ts": dt.datetime(2024, 1, 1) + dt.timedelta(microseconds=n),
        "hostnames": None, "domains": None, "country_code": "US", "country_name": "United States",
        "org": "Acme Ltd", "isp": None, "asn": "AS1", "tags": None, "vulns": None,
        "screenshot_text": None,
    }
    row.update(given)
    return row


def hosts_table(spark, rows):
    from pyspark.sql import functions as F

    from scanledger.functions.hosts import tag_flags

    table = spark.createDataFrame(rows, HOST_SCHEMA)
    return table.select("*", *tag_flags(F.col("tags")))


def rows_of(table, *columns):
    chosen = table.select(*columns) if columns else table
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


def plan_of(table) -> str:
    return table._jdf.queryExecution().explainString(
        table.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )
