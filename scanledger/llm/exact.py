"""Exact duplicates, with the heavy hitters split from the ordinary digests.

A hash shuffle sends all copies of a text to one task. A text that fills a
third of the corpus must not go that way, so the frequent digests are found
first (Misra-Gries summaries, one per task, merged by addition), counted
exactly, and joined on the map side. All other digests are shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scanledger.llm.common import stored

#: Counters of a summary. It bounds the broadcast: so many digests of 32 bytes.
SUMMARY_COUNTERS = 1024
_SUMMARY = pa.schema([("digest", pa.binary()), ("seen", pa.int64())])


def text_digests(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the SHA-256 of the whole text as 32 bytes; null is an empty text."""
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return docs.select("doc_id", F.unhex(F.sha2(text, 256)).alias("digest"))


class MisraGries:
    """Frequent items of a stream in a fixed number of counters.

    With k counters, an item seen more than n / (k + 1) times is kept, with a
    count that is too low by n / (k + 1) at most.
    """

    def __init__(self, counters: int):
        self.counters, self.held = counters, Counter()

    def add(self, items: list) -> None:
        self.held.update(items)
        if len(self.held) > self.counters:
            least = sorted(self.held.values(), reverse=True)[self.counters]
            self.held = Counter({k: n - least for k, n in self.held.items() if n > least})


def _summaries(counters: int):
    def summarise(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = MisraGries(counters)
        for part in parts:
            summary.add(part.column("digest").to_pylist())
        if summary.held:
            columns = [list(summary.held), list(summary.held.values())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _SUMMARY, strict=True)],
                schema=_SUMMARY,
            )

    return summarise


def heavy_digests(digests: DataFrame, counters: int = SUMMARY_COUNTERS) -> DataFrame:
    """The frequent digests with their exact group size and largest id, ``counters`` rows at most.

    Complete for digests of more than 2 n / (counters + 1) of n rows; a digest
    that is not found goes the ordinary way, so a miss costs time, not rows.
    """
    found = (
        digests.select("digest")
        .mapInArrow(_summaries(counters), "digest binary, seen long")
        .groupBy("digest")
        .agg(F.sum("seen").alias("seen"))
        .orderBy(F.desc("seen"), "digest")
        .limit(counters)
    )
    suspects = digests.join(F.broadcast(found.select("digest")), "digest", "left_semi")
    counted = suspects.groupBy("digest").agg(
        F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id")
    )
    return counted.filter("group_size > 1")


def exact_groups(docs: DataFrame, counters: int = SUMMARY_COUNTERS) -> DataFrame:
    """One row per document: the row that stays of its group of identical texts.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256``. Texts are equal
    when identical after no change; null counts as empty. The largest doc_id
    stays; null ids rank below all others. Rows that repeat id and text count
    in ``group_size`` and are kept or dropped together. An empty table gives no
    rows. Only ``doc_id`` and ``text`` are read, so other columns can't clash.
    """
    digests = stored(text_digests(docs), "digests")
    heavy = stored(heavy_digests(digests, counters), "heavy")
    split = digests.join(F.broadcast(heavy), "digest", "left")
    group = Window.partitionBy("digest")
    ordinary = (
        split.filter(F.col("group_size").isNull())
        .select("doc_id", "digest")
        .withColumn("group_size", F.count("*").over(group))
        .withColumn("keep_id", F.max("doc_id").over(group))
    )
    both = split.filter(F.col("group_size").isNotNull()).unionByName(ordinary)
    return both.select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
