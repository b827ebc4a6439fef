"""Row-level columns of one observation: tag flags, CVE figures, risky port."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from scanledger import config, schemas


def parse_ts(text: Column) -> Column:
    """Zoneless timestamp; an offset in the text is ignored, bad text gives NULL."""
    return text.try_cast("timestamp_ntz")


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def tag_flag(tags: Column, tag: str) -> Column:
    """NULL tags give NULL; a NULL element never hides the answer."""
    return F.when(tags.isNotNull(), F.coalesce(F.array_contains(tags, tag), F.lit(False)))


def tag_flags(tags: Column) -> list[Column]:
    return [tag_flag(tags, tag).alias(name) for name, tag in config.TAG_FLAGS.items()]


def vulns_typed(vulns: Column) -> Column:
    """CVE map with typed entries from a map of JSON texts.

    Values that do not fit become NULL one by one; a NULL entry stays NULL.
    """

    def cast_leaves(entry: Column) -> Column:
        def leaf(name: str, to: str) -> Column:
            return entry[name].try_cast(to).alias(name)

        return F.when(
            entry.isNotNull(),
            F.struct(
                leaf("cvss", "double"),
                leaf("cvss_version", "double"),
                leaf("cvss_v2", "double"),
                entry["summary"].alias("summary"),
                leaf("verified", "boolean"),
                leaf("epss", "double"),
                leaf("ranking_epss", "double"),
            ),
        )

    # Parsed in a pass of its own, so that each entry is read once.
    parsed = F.transform_values(vulns, lambda _, text: F.from_json(text, schemas.VULN_ENTRY))
    return F.transform_values(parsed, lambda _, entry: cast_leaves(entry))


def recent_cve(cve_id: Column, rules: config.SignalRules) -> Column:
    """By the pattern or, if the rules name one, by the year of the id."""
    if rules.recent_cve_year is None:
        return cve_id.rlike(rules.recent_cve_pattern)
    year = F.regexp_extract(cve_id, "CVE-([0-9]+)-", 1).try_cast("int")
    return F.coalesce(year >= rules.recent_cve_year, F.lit(False))


def cve_features(
    vulns: Column, rules: config.SignalRules = config.SignalRules()
) -> dict[str, Column]:
    """CVE figures of one observation, without exploding the map.

    Observations without CVEs (the large majority) skip the map functions.
    """
    some = F.coalesce(F.size(vulns), F.lit(0)) > 0
    values = F.map_values(vulns)
    return {
        "row_cve_count": F.when(some, F.size(vulns)).otherwise(0).cast("bigint"),
        "row_verified_cve_count": F.when(
            some, F.size(F.filter(values, lambda v: v["verified"]))
        ).otherwise(0).cast("bigint"),
        "row_max_cvss": F.when(some, F.array_max(F.transform(values, lambda v: v["cvss"]))),
        "row_max_epss": F.when(some, F.array_max(F.transform(values, lambda v: v["epss"]))),
        "row_has_recent_cve": F.when(
            some, F.exists(F.map_keys(vulns), lambda k: recent_cve(k, rules))
        ).otherwise(False),
    }


def risky_port_flag(port: Column, ports: Iterable[int] = tuple(config.RISKY_PORTS)) -> Column:
    return port.isin(*ports)


def risky_port_label(port: Column) -> Column:
    """Service name of a risky port, NULL for any other port."""
    pairs = [F.lit(x) for port_label in config.RISKY_PORTS.items() for x in port_label]
    return F.try_element_at(F.create_map(*pairs), port.cast("int"))
