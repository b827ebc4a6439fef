"""Spelling variants: words one edit apart, found by asymmetric chunks.

Of two words that may be one edit apart, the longer (of equal length, the
smaller) contributes two disjoint chunks: its head and its tail. The other
contributes its positional grams as long as those chunks. One edit touches one
chunk and moves the other by at most one place, so a pair always shares a chunk
within that shift; what shares one is verified.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanledger.llm.common import batches, stored, utf8

#: Letters of a word: A-Z, a-z and U+00C0 to U+00FF.
RUNS = re.compile("[A-Za-zÀ-ÿ]+").findall
MIN_CHARS = 5
MIN_COUNT = 3
#: A form must be this many times as frequent as its variant.
FORM_RATIO = 2
#: One run in so many loses a code point, if damage is asked for.
DAMAGE_EVERY = 97
#: Distinct words that a task counts before it sends them on.
TASK_WORDS = 1 << 18

_COUNTS = pa.schema([("word", pa.string()), ("seen", pa.int64())])


# --- words -----------------------------------------------------------------------------------


def damaged(run: str, prefix: int) -> str:
    """The run without one code point if its checksum says so; ``prefix`` is that of the id."""
    h = zlib.crc32(run.encode(), prefix)
    if h % DAMAGE_EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _count_words(damage: bool, min_chars: int):
    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for part in parts:
            ids, texts = part.column("doc_id").to_pylist(), part.column("text").to_pylist()
            for doc_id, text in zip(ids, texts, strict=True):
                runs = Counter(RUNS(utf8(text).lower().decode("utf-8", "surrogatepass")))
                prefix = zlib.crc32(f"{'null' if doc_id is None else doc_id}:".encode())
                for run, n in runs.items():
                    word = damaged(run, prefix) if damage else run
                    if len(word) >= min_chars:
                        seen[word] += n
                if len(seen) >= TASK_WORDS:
                    yield from batches(seen.items(), _COUNTS)
                    seen = Counter()
        yield from batches(seen.items(), _COUNTS)

    return count


def word_counts(
    docs: DataFrame, damage: bool = False, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT
) -> DataFrame:
    """``word, n``: the words of the texts with at least so many code points and occurrences.

    Words are maximal runs of ``RUNS`` with A-Z lower-cased. With ``damage``, a
    run whose unsigned crc32 h of ``<doc_id>:<run>`` is a multiple of
    ``DAMAGE_EVERY`` loses its code point h % length first. A null text has no
    words; a null id reads ``null``; repeated rows count again.
    """
    counted = docs.select("doc_id", "text").mapInArrow(_count_words(damage, min_chars), "word string, seen long")
    return counted.groupBy("word").agg(F.sum("seen").alias("n")).filter(F.col("n") >= min_count)


# --- pairs -----------------------------------------------------------------------------------


def _head_chars(size: Column) -> Column:
    return F.floor(size / 2).cast("int")


def chunks(words: DataFrame) -> DataFrame:
    """Two disjoint chunks of each word: ``size`` of the word, ``start`` of the chunk, ``gram``."""
    size = F.length("word")
    head = _head_chars(size)
    both = F.array(
        F.struct(F.lit(0).alias("start"), F.substr("word", F.lit(1), head).alias("gram")),
        F.struct(head.alias("start"), F.substr("word", head + 1, size - head).alias("gram")),
    )
    return words.select("word", "n", size.alias("size"), F.explode(both).alias("chunk")).select(
        "word", "n", "size", "chunk.start", "chunk.gram"
    )


def positional_grams(words: DataFrame) -> DataFrame:
    """The positional grams of each word that a chunk of another word can meet.

    ``size`` and ``start`` are those of the chunk: the other word is as long or
    one longer, and a gram lies at the chunk's start (the edit is behind it, or
    replaces) or one before it (a deletion in front of it). All other positions
    are out of reach by one edit.
    """
    own = F.length("word")
    wanted = []
    for longer in (0, 1):
        size = own + longer
        head = _head_chars(size)
        for start, chars in ((F.lit(0), head), (head, size - head)):
            for shift in range(longer + 1):
                place = start - shift
                gram = F.struct(
                    size.alias("size"), start.alias("start"), F.substr("word", place + 1, chars).alias("gram")
                )
                wanted.append(F.when((place >= 0) & (place + chars <= own), gram))
    return words.select("word", "n", F.explode(F.array_compact(F.array(*wanted))).alias("g")).select(
        "word", "n", "g.size", "g.start", "g.gram"
    )


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, a_n, b, b_n``: each pair of distinct words one edit apart, once.

    An edit inserts, deletes or replaces one code point. ``words`` has distinct
    ``word`` of two code points or more, with its ``n``.
    """
    one, two = chunks(words).alias("one"), positional_grams(words).alias("two")
    same = [F.col(f"one.{c}") == F.col(f"two.{c}") for c in ("size", "start", "gram")]
    # of equally long words the smaller one has the chunks
    role = (F.length("two.word") < F.col("one.size")) | (F.col("one.word") < F.col("two.word"))
    head = F.floor(F.col("one.size") / 2).cast("int")
    # a pair whose heads agree has been found by them
    first = (F.col("one.start") == 0) | (
        F.substr("one.word", F.lit(1), head) != F.substr("two.word", F.lit(1), head)
    )
    return (
        one.join(two, same[0] & same[1] & same[2] & role & first)
        .filter(F.levenshtein("one.word", "two.word", 1) == 1)
        .select(
            F.col("one.word").alias("a"), F.col("one.n").alias("a_n"),
            F.col("two.word").alias("b"), F.col("two.n").alias("b_n"),
        )
    )


# --- forms -----------------------------------------------------------------------------------


def last_forms(forms: DataFrame) -> DataFrame:
    """``word, root`` for each row of ``forms(word, form)``: the last of the chain of forms.

    Each round doubles the steps that a word looks ahead. A form is at least
    twice as frequent as its variant, so chains are short and have no circles.
    """
    ahead = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        on = ahead.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = ahead.join(on, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        step = stored(step, "forms")
        if not step.filter("moved").limit(1).count():
            return step.select("word", "root")
        ahead = step.select("word", "root")


def spelling_variants(words: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of distinct words with their counts ``n``.

    Two words are near if one inserted, deleted or replaced code point apart.
    ``form`` is the near word of largest n (ties: the smallest in code-point
    order) if that n is at least ``ratio`` times the word's, else null with
    ``form_n`` null; ``n_near`` counts near words, 0 if none; ``root`` follows
    the forms to the last, the word itself if it has none. No words, no rows.
    """
    words = stored(words.select("word", "n"), "words")
    pairs = stored(near_pairs(words), "near")
    both = pairs.selectExpr("a AS word", "a_n AS own", "b AS near", "b_n AS near_n").unionByName(
        pairs.selectExpr("b AS word", "b_n AS own", "a AS near", "a_n AS near_n")
    )
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct(-F.col("near_n"), "near")).alias("best"), F.first("own").alias("own")
    )
    best = best.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.col1")).alias("near_n"), "own")
    enough = F.col("near_n") >= ratio * F.col("own")
    best = stored(
        best.select(
            "word", "n_near", F.when(enough, F.col("near")).alias("form"), F.when(enough, F.col("near_n")).alias("form_n")
        ),
        "best",
    )
    roots = last_forms(best.filter("form IS NOT NULL"))
    return (
        words.join(best, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n",
        )
    )
