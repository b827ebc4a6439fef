"""Raw nested records -> flat hosts table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanledger.functions.common import to_bigint
from scanledger.functions.hosts import empty_to_null, parse_ts, tag_flags, vulns_typed


def flatten_hosts(raw: DataFrame, *carried: str) -> DataFrame:
    """One row per observation with the 34 host columns, and columns carried on.

    A projection only: the JSON scan parses just the fields used here, and a
    reader of fewer columns prunes it further.
    """
    c = F.col
    return raw.select(
        c("ip_str"),
        to_bigint(c("port")).alias("port"),
        c("transport"),
        parse_ts(c("timestamp")).alias("ts"),
        c("hostnames"),
        c("domains"),
        c("location.country_code").alias("country_code"),
        c("location.country_name").alias("country_name"),
        c("location.city").alias("city"),
        c("location.latitude").try_cast("double").alias("latitude"),
        c("location.longitude").try_cast("double").alias("longitude"),
        c("org"),
        c("isp"),
        c("asn"),
        c("os"),
        c("product"),
        c("devicetype"),
        c("tags"),
        c("cpe23"),
        vulns_typed(c("vulns")).alias("vulns"),
        c("ssl.jarm").alias("ssl_jarm"),
        to_bigint(c("http.status")).alias("http_status"),
        c("http.server").alias("http_server"),
        c("http.title").alias("http_title"),
        c("_shodan.module").alias("shodan_module"),
        c("screenshot.labels").alias("screenshot_labels"),
        empty_to_null(c("screenshot.text")).alias("screenshot_text"),
        *tag_flags(c("tags")),
        *carried,
    )
