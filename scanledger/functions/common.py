"""Small column helpers shared by the other modules."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(or_, conditions, F.lit(False))


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def contains_any(text: Column, keywords: Iterable[str]) -> Column:
    """True when any keyword is a substring of ``text``.

    A keyword that contains another one can never decide the answer alone, so
    only the shortest ones are tested.
    """
    words = list(keywords)
    needed = [w for w in words if not any(o != w and o in w for o in words)]
    return any_of(text.contains(w) for w in needed)


def to_bigint(text: Column) -> Column:
    """Integer from JSON text; fractions round to the nearest, bad text gives NULL."""
    return F.coalesce(
        text.try_cast("bigint"), F.rint(text.try_cast("double")).try_cast("bigint")
    )


def round_half_up(value: Column, digits: int) -> Column:
    """Round a double as ``round(value * 10^d) / 10^d`` does on binary doubles."""
    scale = F.lit(float(10 ** digits))
    return F.round(value * scale) / scale


def percent(part: Column, whole: Column, digits: int) -> Column:
    return round_half_up(part / F.nullif(whole, F.lit(0)) * F.lit(100.0), digits)


def fill(template: str, *figures: Column) -> Column:
    """Put figures into the {} slots of a sentence; a NULL figure gives NULL."""
    parts = template.split("{}")
    pieces: list[Column] = []
    for text, figure in zip(parts, list(figures) + [None]):
        if text:
            pieces.append(F.lit(text))
        if figure is not None:
            pieces.append(figure.cast("string"))
    return F.concat(*pieces)
