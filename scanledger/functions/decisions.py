"""Columns of the adjudication step: reading replies and the written rule."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from scanledger import config
from scanledger.config import AdjudicationRules
from scanledger.functions.common import contains_any

_BLANK = r"[\s\p{Z}\x1c-\x1f\x85]"
_JSON_OPTIONS = {"allowSingleQuotes": "false"}


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"\A{_BLANK}+|{_BLANK}+\z", "")


def unfenced(reply: Column) -> Column:
    """Reply text without surrounding blanks and without a Markdown code fence."""
    text = _strip(reply)
    inner = F.regexp_replace(text, r"\A`+|`+\z", "")
    inner = F.regexp_replace(inner, r"\Ajson", "")
    return F.when(text.startswith("```"), _strip(inner)).otherwise(text)


def is_json_object(text: Column) -> Column:
    """Strict check: exactly one JSON object and nothing else.

    The parser stops at the end of the first value, so the text is also read
    as the only element of a list and as a member followed by a marker; text
    after the object breaks the one or hides the marker of the other.
    """
    as_member = F.from_json(
        F.concat(F.lit('{"v":'), text, F.lit(',"end":1}')),
        "v STRING, end INT, bad STRING",
        {**_JSON_OPTIONS, "columnNameOfCorruptRecord": "bad"},
    )
    as_element = F.from_json(
        F.concat(F.lit('{"v":['), text, F.lit("]}")),
        "v ARRAY<STRING>, bad STRING",
        {**_JSON_OPTIONS, "columnNameOfCorruptRecord": "bad"},
    )
    return F.coalesce(
        text.startswith("{")
        & as_member["bad"].isNull()
        & (as_member["end"] == 1)
        & as_element["bad"].isNull()
        & (F.size(as_element["v"]) == 1),
        F.lit(False),
    )


def reply_fields(text: Column) -> Column:
    """Top-level fields of a JSON object as a map of texts."""
    return F.from_json(text, "MAP<STRING, STRING>", _JSON_OPTIONS)


def last_field(fields: Column, name: str) -> Column:
    """Value of a field; of a repeated field the last one, as usual in JSON."""
    entries = F.filter(F.map_entries(fields), lambda e: e["key"] == name)
    return F.get(entries, F.size(entries) - 1)["value"]


def signal_types() -> dict[str, Column]:
    """Independent kinds of evidence of an account."""
    return {
        "CVE": F.col("cve_count") > 0,
        "end-of-life software": F.col("eol_count") > 0,
        "self-signed certificate": F.col("self_signed_count") > 0,
        "risky open port": F.col("risky_open_port_count") > 0,
        "screenshot": F.col("has_screenshot_evidence"),
    }


def signal_type_count() -> Column:
    return reduce(add, [kind.cast("int") for kind in signal_types().values()])


def signal_type_names() -> Column:
    return F.concat_ws(", ", *[F.when(c, F.lit(n)) for n, c in signal_types().items()])


def carrier_like(rules: AdjudicationRules = AdjudicationRules()) -> Column:
    """The company name reads like a telecom carrier or hosting provider."""
    parts = rules.carrier_keywords
    if rules.known_providers:
        parts += config.GENERIC_ISP_KEYWORDS + config.HYPERSCALER_KEYWORDS
    name = F.lower("company_key")
    return contains_any(name, parts) | name.isin(*rules.carrier_names)


def rule_label(rules: AdjudicationRules = AdjudicationRules()) -> Column:
    """contact, skip or escalate by the written rule, in the configured order."""
    corroborated = signal_type_count() >= rules.corroborating_types
    strong = corroborated | F.col("has_screenshot_evidence")
    unclear = (F.col("fit_score") < rules.low_fit) | F.col("host_count").between(
        1, rules.tiny_hosts
    )
    matches = {
        "escalate": (strong & unclear) | carrier_like(rules),
        "contact": corroborated,
        "skip": ~corroborated,
    }
    chain = F
    for label in rules.order:
        chain = chain.when(matches[label], label)
    return chain.otherwise("skip")


def rule_rationale() -> Column:
    names = signal_type_names()
    return F.concat(
        F.lit("Signal types present: "), F.when(names == "", F.lit("none")).otherwise(names)
    )


def input_json() -> Column:
    """The fields an adjudicator sees as one JSON object, NULLs kept."""
    return F.to_json(F.struct(*config.ADJUDICATION_FIELDS), {"ignoreNullFields": "false"})
