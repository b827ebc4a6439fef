"""Secrets in texts: fixed patterns, and tokens that pass a battery of randomness tests.

Long tokens are put to three tests of "independent and uniform over the
alphabet of the inferred encoding": chi-squared counts, runs above and below
the middle, and the correlation of neighbours. What fails them is ordinary text
and set aside; the rest is reported. How much evidence sets a token aside
follows from all tokens together, by false-discovery control with weights for
their length. Only DataFrame functions are used.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanledger.llm.common import stored

#: The kinds in the order in which equal starts are listed.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = (
    r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_CHARS = 6
# A run that is long enough is found at its first character; the others needn't be tried.
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
TOKEN_CHARS = 20
TOKEN = rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{TOKEN_CHARS},}}+"

#: Marks matches in a text; characters of the text that are equal to it stand as ``OTHER`` meanwhile.
MARK, OTHER = "\x01", "\x02"
#: Sizes are summed in blocks, so that a text of very many matches takes no square time.
BLOCK = 256


@dataclass(frozen=True)
class Encoding:
    """A token is in the first encoding whose symbols it keeps to."""

    name: str
    symbols: str
    pattern: str


_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = (
    Encoding("hex", _DIGITS + _LOWER[:6], "^[0-9a-f]+$"),
    Encoding("HEX", _DIGITS + _UPPER[:6], "^[0-9A-F]+$"),
    Encoding("base32", _DIGITS[2:8] + _UPPER, "^[2-7A-Z]+$"),
    Encoding("base36", _DIGITS + _LOWER, "^[0-9a-z]+$"),
    Encoding("base62", _DIGITS + _UPPER + _LOWER, "^[0-9A-Za-z]+$"),
    Encoding("base64", "+/" + _DIGITS + _UPPER + _LOWER, "^[+/0-9A-Za-z]+$"),
    Encoding("base64url", "-" + _DIGITS + _UPPER + "_" + _LOWER, "^[0-9A-Za-z_-]+$"),
)

#: Of the tokens set aside as ordinary text, at most this share is expected to be random.
FALSE_SHARE = 0.05
#: Weight of a token of n symbols: USUAL / n within these bounds. Short tokens are more often words, and
#: the tests see less in them.
USUAL, LEAST_WEIGHT, MOST_WEIGHT = 32, 0.25, 4.0
#: Weighted p-values are rounded up to steps of a tenth of a power of ten over this, down to 10 ** -MOST_POWER.
STEPS, MOST_POWER = 32, 30


def let(value: Column, work: Callable[[Column], Column]) -> Column:
    """The work on a value that is evaluated once, also inside of other lambdas."""
    return F.get(F.transform(F.array(value), work), 0)


# --- spans -----------------------------------------------------------------------------------


def pieces(text: Column, pattern: str) -> Column:
    """The text cut at its matches; every second piece is one. The text has no ``MARK``."""
    return F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK, -1)


def _sum(sizes: Column) -> Column:
    return F.aggregate(sizes, F.lit(0).cast("long"), lambda total, x: total + x)


def starts(sizes: Column) -> Column:
    """The sum of the sizes before each of them; at least one is given."""

    def from_blocks(own: Column, offsets: Column) -> Column:
        def start(_, k: Column) -> Column:
            block = F.floor(k / BLOCK).cast("int")
            return F.get(offsets, block) + _sum(F.slice(own, block * BLOCK + 1, k % BLOCK))

        return F.transform(own, start)

    def blocks(own: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(own) - 1) / BLOCK).cast("int"))
        totals = F.transform(numbers, lambda b: _sum(F.slice(own, b * BLOCK + 1, BLOCK)))
        return let(
            totals,
            lambda held: let(
                F.transform(held, lambda _, b: _sum(F.slice(held, 1, b))), lambda offsets: from_blocks(own, offsets)
            ),
        )

    return let(sizes, blocks)


_SPANS = "array<struct<start: bigint, end: bigint, found: string>>"


def spans(parts: Column) -> Column:
    """``start, end, found`` of each match, in code points, the end exclusive."""

    def located(held: Column) -> Column:
        sizes = F.transform(held, lambda p: F.length(p).cast("long"))

        def match(own: Column, k: Column) -> Column:
            at, found = F.get(own, 2 * k + 1), F.get(held, 2 * k + 1)
            return F.struct(at.alias("start"), (at + F.length(found)).alias("end"), found.alias("found"))

        numbers = F.sequence(F.lit(0), F.floor(F.size(held) / 2).cast("int") - 1)
        matches = let(starts(sizes), lambda own: F.transform(numbers, lambda k: match(own, k)))
        return F.when(F.size(held) > 1, matches.cast(_SPANS)).otherwise(F.array().cast(_SPANS))

    return let(parts, located)


def _assigned(found: Column) -> Column:
    return F.length(F.regexp_extract(found, ASSIGN, 2)) >= ASSIGN_CHARS


def _blanked(parts: Column) -> Column:
    """The text with its assignments blanked."""

    def blank(part: Column, k: Column) -> Column:
        return F.when((k % 2 == 1) & _assigned(part), F.rpad(F.lit(""), F.length(part), " ")).otherwise(part)

    return let(
        parts,
        lambda held: F.when(F.size(held) == 1, F.get(held, 0)).otherwise(F.array_join(F.transform(held, blank), "")),
    )


# --- tests -----------------------------------------------------------------------------------


def _encoding(token: Column, field: Callable[[Encoding], object]) -> Column:
    chosen = F.when(F.lit(False), F.lit(field(ENCODINGS[0])))
    for encoding in ENCODINGS:
        chosen = chosen.when(token.rlike(encoding.pattern), F.lit(field(encoding)))
    return chosen


def two_sided(z: Column) -> Column:
    """The chance that a standard normal lies as far out, by the usual rational approximation."""
    size = F.least(F.abs(z), F.lit(12.0))
    t = 1 / (1 + 0.2316419 * size)
    # fixed values: coefficients of the approximation
    tail = F.lit(0.0)
    for factor in (1.330274429, -1.821255978, 1.781477937, -0.356563782, 0.319381530):
        tail = (tail + factor) * t
    return F.least(F.lit(1.0), 2 / math.sqrt(2 * math.pi) * F.exp(-size * size / 2) * tail)


def _squares(token: Column, symbols: Column) -> Column:
    """The sum of the squared counts of the symbols."""

    def count(symbol: Column) -> Column:
        times = (F.length(token) - F.length(F.replace(token, symbol, F.lit("")))).cast("double")
        return times * times

    each = F.split(symbols, "")
    return F.aggregate(F.transform(each, count), F.lit(0.0), lambda total, x: total + x)


def chi_squared(token: Column, symbols: Column) -> Column:
    """Uniform counts: Pearson's statistic with its exact variance, as a normal deviate."""
    n, k = F.length(token).cast("double"), F.length(symbols).cast("double")
    free = k - 1
    statistic = k / n * _squares(token, symbols) - n
    ratio = F.greatest(F.lit(0.0), 1 + (statistic - free) / free / F.sqrt((n - 1) / n))
    return (F.pow(ratio, 1 / 3) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))


def runs(token: Column, symbols: Column) -> Column:
    """Changes between the lower and upper half of the alphabet: half of the places."""
    n, half = F.length(token).cast("double"), F.floor(F.length(symbols) / 2).cast("int")
    sides = F.concat(F.repeat(F.lit("l"), half), F.repeat(F.lit("h"), half))
    halves = F.call_function("translate", token, symbols, sides)

    def changes(held: Column) -> Column:
        both = (F.length(held) - F.length(F.replace(held, F.lit(pair), F.lit(""))) for pair in ("lh", "hl"))
        return sum(both) / 2.0

    return (let(halves, changes) - (n - 1) / 2) / F.sqrt((n - 1) / 4)


def serial_correlation(token: Column, symbols: Column) -> Column:
    """Products of neighbours' distances from the middle, in units of their deviation."""
    n, k = F.length(token).cast("int"), F.length(symbols).cast("double")
    places = F.transform(F.split(token, ""), lambda c: F.instr(symbols, c) - 1 - (k - 1) / 2)

    def products(held: Column) -> Column:
        pairs = F.zip_with(F.slice(held, 1, n - 1), F.slice(held, 2, n - 1), lambda a, b: a * b)
        return F.aggregate(pairs, F.lit(0.0), lambda total, x: total + x)

    return let(places, products) / F.sqrt(n - 1) / ((k * k - 1) / 12)


def randomness(token: Column) -> Column:
    """``encoding`` and ``p`` of a token: three times the least p-value of the tests, at most 1.

    Null for what is no candidate: tokens of no encoding, without a digit or a
    letter, or around a base span of another kind.
    """
    symbols = _encoding(token, lambda e: e.symbols)

    def battery(own: Column) -> Column:
        tests = (chi_squared(token, own), runs(token, own), serial_correlation(token, own))
        least = F.least(*(two_sided(z) for z in tests))
        return F.struct(
            _encoding(token, lambda e: e.name).alias("encoding"), F.least(F.lit(1.0), 3 * least).alias("p")
        )

    coded = token.rlike("[0-9]") & token.rlike("[A-Za-z]") & ~token.rlike(f"{HEX}|{ACCESS}")
    return F.when(coded, let(symbols, lambda own: F.when(own.isNotNull(), battery(own))))


# --- false discoveries -----------------------------------------------------------------------


def _weight(n: Column) -> Column:
    return F.greatest(F.lit(LEAST_WEIGHT), F.least(F.lit(MOST_WEIGHT), F.lit(float(USUAL)) / n))


def evidence(p: Column, n: Column) -> Column:
    """Steps of the weighted p-value; it is at most 10 ** (-steps / STEPS)."""
    power = -F.log10(F.greatest(p, F.lit(10.0 ** -(2 * MOST_POWER))) / _weight(n)) * STEPS
    return F.least(F.floor(power), F.lit(STEPS * MOST_POWER)).cast("int")


def set_aside_from(levels: list[tuple[int, int, float]], share: float = FALSE_SHARE) -> int | None:
    """The evidence from which tokens are set aside; None if none are.

    ``levels``: evidence, tokens and sum of their weights. Step-up rule: the
    least evidence at which the tokens expected to reach it by chance are at
    most ``share`` of those that do.
    """
    total = sum(tokens for _, tokens, _ in levels)
    mean = sum(weights for _, _, weights in levels) / total if total else 0.0
    found, reached = None, 0
    for steps, tokens, _ in sorted(levels, reverse=True):
        reached += tokens
        if 10.0 ** (-steps / STEPS) * mean * total <= share * reached:
            found = steps
    return found


# --- documents -------------------------------------------------------------------------------

_CANDIDATES = "array<struct<start: bigint, end: bigint, encoding: string, p: double, evidence: int>>"


def scan(docs: DataFrame) -> DataFrame:
    """One row per row: ``doc_id``, the base spans of each kind, and ``tokens`` with their tests."""
    text = F.translate(F.coalesce("text", F.lit("")), MARK, OTHER)
    cut = docs.select("doc_id", text.alias("body")).select(
        "doc_id", "body", pieces(F.col("body"), ASSIGN).alias("parts")
    )
    base = cut.select(
        "doc_id",
        F.filter(spans(F.col("parts")), lambda s: _assigned(s.found)).alias("assign"),
        spans(pieces(F.col("body"), ACCESS)).alias("access"),
        spans(pieces(F.col("body"), HEX)).alias("hex"),
        spans(pieces(_blanked(F.col("parts")), TOKEN)).alias("tokens"),
    )

    def tested(span: Column) -> Column:
        def kept(own: Column) -> Column:
            n = F.length(span.found)
            return F.struct(
                span.start.alias("start"), span.end.alias("end"), own.encoding.alias("encoding"), own.p.alias("p"),
                evidence(own.p, n).alias("evidence"),
            )

        return let(randomness(span.found), lambda own: F.when(own.isNotNull(), kept(own)))

    places = "array<struct<start: bigint, end: bigint>>"
    bare = (F.transform(k, lambda s: F.struct(s.start, s.end)).cast(places).alias(k) for k in KINDS[:3])
    tokens = F.array_compact(F.transform("tokens", tested)).cast(_CANDIDATES)
    return base.select("doc_id", *bare, tokens.alias("tokens"))


def find_secrets(docs: DataFrame, share: float = FALSE_SHARE) -> DataFrame:
    """``doc_id, assign, access, hex, random``: the spans of each kind in every text.

    Spans are ``start, end`` in code points, the end exclusive, in order. Base
    kinds are leftmost non-overlapping matches: ``assign`` (a name such as
    ``token``, then ``:`` or ``=``, then ``ASSIGN_CHARS`` characters or more),
    ``access`` and ``hex``. ``random`` spans are runs of at least
    ``TOKEN_CHARS`` of ``[A-Za-z0-9+/_-]``, outside assignments, with a letter
    and a digit and no access or hex span inside, in one of ``ENCODINGS``, that
    the tests don't set aside; they also give ``encoding`` and ``p``. Ties can't
    matter: equal tokens get equal verdicts. Null and empty texts have no spans;
    rows that repeat stay; an empty table gives no rows; other columns aren't
    read. Which tokens are set aside depends on all tokens of the table; the
    driver sees counts for at most ``STEPS * MOST_POWER`` levels of evidence.
    """
    scanned = stored(scan(docs), "secrets")
    tokens = scanned.select(F.explode("tokens").alias("t")).select(
        "t.evidence", _weight(F.col("t.end") - F.col("t.start")).alias("weight")
    )
    levels = tokens.groupBy("evidence").agg(F.count("*"), F.sum("weight")).collect()
    least = set_aside_from([tuple(row) for row in levels], share)
    kept = F.lit(least).cast("int")
    random = F.filter("tokens", lambda t: kept.isNull() | (t.evidence < kept))
    return scanned.select("doc_id", *KINDS[:3], random.alias("random"))


def listed(kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` of the spans of some kinds, by start, then kind, joined by commas."""

    def places(rank: int, kind: str) -> Column:
        return F.transform(
            kind, lambda s: F.struct(s.start.alias("start"), F.lit(rank).alias("rank"), s.end.alias("end"))
        )

    every = F.concat(*(places(*numbered) for numbered in enumerate(kinds)))
    names = F.array(*map(F.lit, kinds))
    written = F.transform(
        F.array_sort(every),
        lambda s: F.concat_ws(":", F.get(names, s.rank), s.start.cast("string"), s.end.cast("string")),
    )
    return F.array_join(written, ",")
