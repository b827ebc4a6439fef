"""Choice of the best contact among found email addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scanledger import config, schemas
from scanledger.functions.common import contains_any


# Search replies: addresses at the top, or below ``data`` with the organisation.
# An entry is kept whole, under the names of schemas.CONTACT_ENTRY.
REPLY = f"""emails ARRAY<STRUCT<{schemas.CONTACT_ENTRY}>>,
    data STRUCT<organization: STRING, emails: ARRAY<STRUCT<value: STRING,
    type: STRING, confidence: DOUBLE, first_name: STRING, last_name: STRING, position: STRING,
    verification: STRUCT<status: STRING>, sources: ARRAY<STRUCT<uri: STRING>>>>>"""


def parsed_reply(reply: Column) -> Column:
    """A reply text, parsed once for both forms."""
    return F.from_json(reply, REPLY)


def reply_emails(parsed: Column) -> Column:
    """Address structs of a parsed reply; NULL for an error or a text that is no JSON."""
    data = parsed["data"]
    nested = F.transform(
        data["emails"],
        lambda e: F.struct(
            e["type"].alias("type"),
            e["verification"]["status"].alias("status"),
            e["value"].alias("email"),
            e["position"].alias("position"),
            e["first_name"].alias("firstName"),
            e["last_name"].alias("lastName"),
            data["organization"].alias("companyName"),
            F.try_element_at(e["sources"], F.lit(1))["uri"].alias("sourcePage"),
            e["confidence"].alias("confidence"),
            F.lit(None).cast("double").alias("smtp_status_percentage"),
        ),
    )
    return F.coalesce(parsed["emails"], nested)


def reply_organization(parsed: Column) -> Column:
    return parsed["data"]["organization"]


def contact_rank(confidence: Column, smtp_status: Column | None = None) -> Column:
    """Confidence, else the SMTP figure, else 0."""
    known = [confidence] if smtp_status is None else [confidence, smtp_status]
    return F.coalesce(*[k.cast("double") for k in known], F.lit(0.0))


def is_security_title(position: Column) -> Column:
    return contains_any(F.coalesce(F.lower(position), F.lit("")), config.SECURITY_TITLE_KEYWORDS)


def preference(position: Column, rank: Column, place: Column) -> Column:
    """Sort key, smallest first: security titles, then high rank, then early place."""
    return F.struct(
        (~is_security_title(position)).alias("other_title"),
        (-rank).alias("rank"),
        place.alias("place"),
    )


def best_of_reply(emails: Column, with_smtp_fallback: bool = True) -> Column:
    """``key, entry`` of the best in an array of address structs; NULL when there is none.

    For one search reply per row (a reply is short): no explode, no shuffle.
    """
    keyed = F.transform(
        emails,
        lambda e, i: F.struct(
            preference(
                e["position"],
                contact_rank(
                    e["confidence"], e["smtp_status_percentage"] if with_smtp_fallback else None
                ),
                i,
            ).alias("key"),
            e.alias("entry"),
        ),
    )
    return F.array_min(keyed)


def pick_best_contact(emails: Column, with_smtp_fallback: bool = True) -> Column:
    """Best entry of an array of address structs; NULL when there is none."""
    return best_of_reply(emails, with_smtp_fallback)["entry"]
