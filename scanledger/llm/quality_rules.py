"""Quality verdicts from a learned decision list.

Sequential covering: a rule is a conjunction of thresholds on statistics of a
text. It is grown on part of the labelled documents, one condition at a time by
information gain, pruned on the rest, and kept while it is precise there; the
documents it covers are set aside and the next rule is grown. The list becomes
one Spark conditional expression, whose rules can be read and edited.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanledger.llm.common import UPPER, schema_of, utf8

#: Labelled documents that the list is fitted on: those with the smallest hash of their id.
FIT_ROWS = 20_000
MIN_WORDS = 50
SYMBOLS = b"#*$%&|<>"
WINDOW_WORDS = 3
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATES = (
    "word_length", "symbol_rate", "dup_line_rate", "repeat_rate", "distinct_rate", "upper_rate",
    "digit_rate", "stop_rate", "words_per_line", "longest_word",
)
_STATS = pa.struct([(c, pa.int64()) for c in COUNTS] + [(c, pa.float64()) for c in RATES])
_STATS_SQL = ", ".join([f"{c}: bigint" for c in COUNTS] + [f"{c}: double" for c in RATES])


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    threshold: float

    def column(self, stats: str) -> Column:
        value = F.col(f"{stats}.{self.statistic}")
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def covers(self, table: np.ndarray) -> np.ndarray:
        value = table[:, RATES.index(self.statistic)]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    """All conditions together reject a document."""

    conditions: tuple[Condition, ...]

    def column(self, stats: str) -> Column:
        whole = F.lit(True)
        for condition in self.conditions:
            whole = whole & condition.column(stats)
        return whole

    def covers(self, table: np.ndarray) -> np.ndarray:
        whole = np.ones(len(table), bool)
        for condition in self.conditions:
            whole &= condition.covers(table)
        return whole

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


@dataclass(frozen=True)
class Covering:
    """Limits of the covering; part of the model, not of the data."""

    max_rules: int = 16
    max_conditions: int = 4
    min_precision: float = 0.9
    min_covered: int = 1
    prune_share: int = 3  # every so many documents prune, the others grow


def _without(text: bytes, dropped: bytes) -> int:
    """How many bytes of a text are among some ASCII characters."""
    return len(text) - len(text.translate(None, dropped))


def _repeated_words(words: list[bytes]) -> int:
    """Words in windows that occur twice or more, first ones included."""
    windows = list(zip(*(words[k:] for k in range(WINDOW_WORDS)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    starts = np.fromiter((seen[w] > 1 for w in windows), bool, len(windows))
    covered = np.zeros(len(words), bool)
    for k in range(WINDOW_WORDS):
        covered[k : k + len(starts)] |= starts
    return int(covered.sum())


def text_statistics(text: bytes) -> tuple:
    """Counts and rates of one text; all zero for an empty one."""
    words = text.split()
    if not words:
        return (0, 0, _without(text, SYMBOLS), 0, 0, *[0.0] * len(RATES))
    joined = b"".join(words)
    chars = len(joined) if joined.isascii() else len(joined.decode("utf-8", "surrogatepass"))
    lines = [x for x in text.split(b"\n") if x.strip()]
    symbols, repeated = _without(text, SYMBOLS), _repeated_words(words)
    dup_lines = len(lines) - len(set(lines))
    n = len(words)
    rates = (
        chars / n, symbols / chars, dup_lines / len(lines), repeated / n, len(set(words)) / n,
        _without(joined, UPPER.encode()) / chars, _without(joined, b"0123456789") / chars,
        _without(joined, b".!?") / n, n / len(lines), float(max(map(len, words))),
    )
    return (n, chars, symbols, dup_lines, repeated, *rates)


def _add_statistics(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        found = [text_statistics(utf8(t)) for t in part.column("text").to_pylist()]
        fields = [pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), _STATS, strict=True)]
        if found:
            columns = {name: part.column(name) for name in part.schema.names}
            columns["stats"] = pa.StructArray.from_arrays(fields, fields=list(_STATS))
            yield pa.RecordBatch.from_pydict(columns)


def with_statistics(docs: DataFrame) -> DataFrame:
    """The documents with a struct ``stats``; an earlier column of this name is replaced."""
    docs = docs.drop("stats")
    return docs.mapInArrow(_add_statistics, schema_of(docs, f"stats struct<{_STATS_SQL}>"))


def base_failed() -> Column:
    words = F.col("stats.n_words")
    return (words < MIN_WORDS) | (100 * F.col("stats.n_repeat_words") > 50 * words)


def _gain(table: np.ndarray, bad: np.ndarray) -> tuple[float, Condition | None]:
    """The threshold with the most information gained on what a rule covers so far."""
    total_bad, total = bad.sum(), len(bad)
    best, chosen = 0.0, None
    base = np.log2(total_bad / total)
    for k, name in enumerate(RATES):
        order = np.argsort(table[:, k], kind="stable")
        value, hits = table[order, k], np.cumsum(bad[order])
        cut = np.flatnonzero(value[1:] > value[:-1])
        if not len(cut):
            continue
        below, below_bad = cut + 1, hits[cut]
        for above in (False, True):
            n = total - below if above else below
            p = total_bad - below_bad if above else below_bad
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / n) - base), 0.0)
            at = int(gain.argmax())
            if gain[at] > best + 1e-9:
                middle = float(value[cut[at]] + value[cut[at] + 1]) / 2
                best, chosen = float(gain[at]), Condition(name, above, middle)
    return best, chosen


def _grow(table: np.ndarray, bad: np.ndarray, limits: Covering) -> Rule:
    conditions: list[Condition] = []
    while len(conditions) < limits.max_conditions and bad.any() and not bad.all():
        _, found = _gain(table, bad)
        if found is None:
            break
        conditions.append(found)
        inside = found.covers(table)
        table, bad = table[inside], bad[inside]
    return Rule(tuple(conditions))


def _prune(rule: Rule, table: np.ndarray, bad: np.ndarray) -> tuple[Rule, float, int]:
    """The first conditions of a rule that are worth most on documents it has not seen."""
    best = (Rule(()), -1.0, 0.0, 0)
    for size in range(1, len(rule.conditions) + 1):
        short = Rule(rule.conditions[:size])
        inside = short.covers(table)
        hit, covered = int(bad[inside].sum()), int(inside.sum())
        worth = (2 * hit - covered) / covered if covered else -1.0
        if worth > best[1] + 1e-9:
            best = (short, worth, hit / covered, hit)
    return best[0], best[2], best[3]


def learn_rules(table: np.ndarray, bad: np.ndarray, limits: Covering = Covering()) -> list[Rule]:
    """Ordered rules that reject; none if either class is missing."""
    prunes = np.arange(len(bad)) % limits.prune_share == 0
    rules: list[Rule] = []
    while len(rules) < limits.max_rules and bad[~prunes].any():
        rule = _grow(table[~prunes], bad[~prunes], limits)
        rule, precision, hit = _prune(rule, table[prunes], bad[prunes])
        if not rule.conditions or precision < limits.min_precision or hit < limits.min_covered:
            break
        rules.append(rule)
        left = ~rule.covers(table)
        table, bad, prunes = table[left], bad[left], prunes[left]
    return rules


def fit_rules(
    docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, limits: Covering = Covering()
) -> list[Rule]:
    """Learn the list from ``labels(doc_id, quality)``; only ``rows`` of them are used.

    A document that is labelled more than once counts as bad if one label is 0.
    Documents that fail the base rule teach nothing. The driver gets the
    statistics of at most ``rows`` documents.
    """
    labelled = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    sample = (
        labelled.groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    known = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    known = with_statistics(known).filter(~base_failed())
    known = known.select("doc_id", "quality", *(f"stats.{c}" for c in RATES))
    found = known.orderBy(F.xxhash64("doc_id"), "doc_id", *RATES).limit(rows).toPandas()
    return learn_rules(found[list(RATES)].to_numpy(float), (found["quality"] == 0).to_numpy(bool), limits)


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that rejects, from 1; null for a kept document."""
    found = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules, 1))):
        found = F.when(rule.column("stats"), F.lit(number)).otherwise(found)
    return found


def judge_quality(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The documents with ``stats``, ``base_failed``, ``rule`` and ``kept``.

    Words are ``[^\\x20\\x09-\\x0D]+``; a null text has none. ``base_failed``:
    fewer than 50 words, or more than half of them in repeated windows of three
    words. ``kept`` is false then, or if a learned rule rejects. Earlier columns
    of these names are replaced, others are carried on; repeated rows are judged
    alike and an empty table gives no rows.
    """
    judged = with_statistics(docs.drop("base_failed", "rule", "kept"))
    judged = judged.withColumns({"base_failed": base_failed(), "rule": verdict(rules)})
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
