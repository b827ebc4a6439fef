"""Removal of long byte strings that occur more than once in a corpus.

A suffix of every byte would be some ten times the corpus. But every string of
``SPAN`` bytes contains an anchor: the place where the hash of ``GRAM`` bytes is
least (the leftmost, if tied). It depends on the string's bytes alone, so equal
strings have their anchors at the same offset, and suffixes are kept only for
anchors: a sparse suffix array, about one entry in 150 bytes.

An anchor's context is what the strings that it stands for cover. Equal
contexts are combined before the shuffle, and wherever there is more than one,
all of the context is repeated. Different contexts with the same gram are
sorted by what follows the anchor. One scan with a stack turns the lengths of
common prefixes of neighbours into the tree of common-prefix intervals. An
interval of length r holds all occurrences that go on alike for r bytes; those
are split by what precedes them, and a class that agrees in ``SPAN`` - r bytes
on the left is a repeat. Its members reach as far to the left as to where what
precedes them differs (left-extension diversity), so that the repeats found
are maximal, with all their occurrences.

A gram with more than ``CROWD`` rows is not gathered in a task: there equal
contexts are found by an aggregation and strings are compared by their digests,
one row each.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanledger.llm.common import batches, stored, texts_of

SPAN = 400
GRAM = 64
#: Contexts of one gram, of up to 740 bytes each, that one task holds.
CROWD = 1 << 16
#: Bytes of a text that are searched at once; places within them take twenty bits.
_CHUNK = 1 << 19
_PLACE = np.uint64((1 << 20) - 1)
_MIX = 0x9E3779B97F4A7C15
_FINISH = np.uint64(0xD6E8FEB86659FD93)
_BYTES = np.array([(b + 1) * _MIX * _MIX % (1 << 64) for b in range(256)], np.uint64)
_POWERS = {k: np.uint64(pow(_MIX, k, 1 << 64)) for k in (1, 2, 4, 8, 16, 32)}

#: A row is known by its id and 128 bits of its text, so that rows of one id, or of none, are told apart.
_ROW = [("doc_id", pa.int64()), ("check", pa.binary())]
_ROW_SQL = "doc_id long, check binary"
#: What a task has found: contexts with their number (2: two or more, all of them in spans already),
#: or, without a gram, a span from ``first`` to ``last``.
_ANCHORS = pa.schema(
    [
        *_ROW, ("gram", pa.int64()), ("context", pa.int64()), ("n", pa.int32()),
        ("at", pa.int64()), ("first", pa.int64()), ("last", pa.int64()),
    ]
)
_ANCHORS_SQL = f"{_ROW_SQL}, gram long, context long, n int, at long, first long, last long"
_CONTEXTS = pa.schema(
    [
        *_ROW, ("gram", pa.int64()), ("n", pa.int32()), ("at", pa.int64()),
        ("left", pa.binary()), ("right", pa.binary()),
    ]
)
_CONTEXTS_SQL = f"{_ROW_SQL}, gram long, n int, at long, left binary, right binary"
_SPANS = pa.schema([*_ROW, ("start", pa.int64()), ("end", pa.int64())])
_SPANS_SQL = f"{_ROW_SQL}, start long, end long"
_WINDOWS = pa.schema([("digest", pa.binary()), *_ROW, ("n", pa.int32()), ("start", pa.int64())])
_WINDOWS_SQL = f"digest binary, {_ROW_SQL}, n int, start long"
_PACKED = pa.schema([*_ROW, ("packed", pa.binary())])


# --- anchors ---------------------------------------------------------------------------------


def _gram_hashes(text: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each place on, by doubling."""
    hashes = _BYTES[text]
    for half, power in _POWERS.items():
        hashes = hashes[:-half] * power + hashes[half:]
    hashes = hashes * _FINISH
    hashes ^= hashes >> np.uint64(32)
    return hashes * _FINISH


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while 2 * done <= width:
        values, done = np.minimum(values[:-done], values[done:]), 2 * done
    rest = width - done
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def anchors(text: bytes) -> np.ndarray:
    """Rows ``gram, at, first, last``: an anchor's hash and place, and the strings it stands for.

    These are the strings of ``SPAN`` bytes that start from ``first`` to
    ``last``; those of all anchors are all strings of the text, once each.
    """
    whole, found = np.frombuffer(text, np.uint8), []
    for start in range(0, len(whole) - SPAN + 1, _CHUNK):
        hashes = _gram_hashes(whole[start : start + _CHUNK + SPAN - 1])
        placed = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        least = (_sliding_minimum(placed, SPAN - GRAM + 1) & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        last = np.append(first[1:], len(least)) - 1
        at = least[first]
        found.append(np.stack([hashes[at].view(np.int64), start + at, start + first, start + last]))
    return np.concatenate(found, axis=1) if found else np.zeros((4, 0), np.int64)


def _context_hash(text: bytes, at: int, first: int, last: int) -> int:
    value = xxhash.xxh3_64_intdigest(text[first : last + SPAN], at - first)
    return value - (1 << 64) if value >= 1 << 63 else value


def _anchor_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each different context of a batch; spans where it is found again."""

    def rows() -> Iterator[tuple]:
        for part in parts:
            found, texts = [], texts_of(part)
            for doc_id, text in zip(part.column("doc_id").to_pylist(), texts, strict=True):
                listed = anchors(text).tolist()
                contexts = [_context_hash(text, *place) for place in zip(*listed[1:], strict=True)]
                found.append((doc_id, xxhash.xxh3_128_digest(text), listed, contexts))
            seen = Counter(k for _, _, listed, contexts in found for k in zip(listed[0], contexts, strict=True))
            given: set = set()
            for doc_id, check, listed, contexts in found:
                spans = []
                for gram, at, first, last, context in zip(*listed, contexts, strict=True):
                    key = (gram, context)
                    n = min(seen[key], 2)
                    if n > 1:
                        spans.append((first, last + SPAN))
                    if key not in given:
                        yield doc_id, check, gram, context, n, at, first, last
                        if n > 1:
                            given.add(key)
                for start, end in merged_spans(spans):
                    yield doc_id, check, None, None, None, None, start, end

    yield from batches(rows(), _ANCHORS, 16_384)


# --- the interval tree -----------------------------------------------------------------------


def common_prefix(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def prefix_intervals(lengths: list[int]) -> Iterator[tuple[int, int, int]]:
    """``length, first, last`` of all common-prefix intervals, inner ones before outer ones.

    ``lengths[i]`` is the common prefix of the sorted entries i - 1 and i;
    ``lengths[0]`` counts for nothing. Intervals of length 0 aren't given.
    """
    stack = [(0, 0)]
    for i in range(1, len(lengths) + 1):
        length, first = lengths[i] if i < len(lengths) else 0, i - 1
        while stack[-1][0] > length:
            inner, first = stack.pop()
            yield inner, first, i - 1
        if stack[-1][0] < length:
            stack.append((length, first))


def repeat_classes(lefts: list[bytes], rights: list[bytes]) -> Iterator[tuple[int, int, list[int]]]:
    """``before, after, members`` of all maximal repeats through the anchor, of ``SPAN`` bytes or more.

    ``rights`` are sorted, ``lefts`` are reversed, as in :func:`reach`. The
    members of a common-prefix interval are put into the order of what precedes
    them, whose common prefixes make a tree as well: each of its intervals is a
    class that goes on alike to the left for ``before`` bytes and no further
    (left-extension diversity). It is a maximal repeat unless all its members
    lie in one inner interval, where they go on alike for longer.
    """
    n = len(rights)
    lengths = [0, *(common_prefix(rights[k - 1], rights[k]) for k in range(1, n))]
    rank = [0] * n
    for place, k in enumerate(sorted(range(n), key=lefts.__getitem__)):
        rank[k] = place
    inner = list(range(-n, 0))  # the innermost interval of an entry so far; alone at first
    for number, (length, first, last) in enumerate(prefix_intervals(lengths)):
        members = sorted(range(first, last + 1), key=rank.__getitem__)
        shared = [0, *(common_prefix(lefts[a], lefts[b]) for a, b in zip(members, members[1:], strict=False))]
        classes = list(prefix_intervals(shared))
        if not any(a == 0 and b == last - first for _, a, b in classes):
            classes.append((0, 0, last - first))
        for before, a, b in classes:
            own = members[a : b + 1]
            if before + length >= SPAN and len({inner[k] for k in own}) > 1:
                yield before, length, own
        for k in members:
            inner[k] = number


def reach(lefts: list[bytes], rights: list[bytes]) -> list[tuple[int, int] | None]:
    """How far each entry is repeated to the left and right of its anchor.

    ``rights`` are sorted; ``lefts`` are reversed, so that both are read away
    from the anchor. An entry gets None if no string of ``SPAN`` bytes through
    its anchor is shared with another one.
    """
    n = len(rights)
    lengths = [0, *(common_prefix(rights[k - 1], rights[k]) for k in range(1, n))]
    rank = [0] * n
    for place, k in enumerate(sorted(range(n), key=lefts.__getitem__)):
        rank[k] = place
    before, after = [-1] * n, [0] * n
    for length, first, last in prefix_intervals(lengths):
        needed = max(0, SPAN - length)
        members = sorted(range(first, last + 1), key=rank.__getitem__)
        # in the order of what precedes them, an entry shares most with a neighbour
        shared = [-1, *(common_prefix(lefts[a], lefts[b]) for a, b in zip(members, members[1:], strict=False)), -1]
        for k, member in enumerate(members):
            most = max(shared[k], shared[k + 1])
            if most >= needed:
                before[member] = max(before[member], most)
                after[member] = max(after[member], length)
    return [(b, a) if b >= 0 else None for b, a in zip(before, after, strict=True)]


def _rows_of(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for part in parts:
        yield from zip(*(c.to_pylist() for c in part.columns), strict=True)


def _compare_contexts(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts come sorted by gram. Repeated ones become spans; of grams with different contexts
    and a single one among them, one row for each context goes on."""

    def rows() -> Iterator[tuple]:
        for gram, group in groupby(_rows_of(parts), key=lambda r: r[2]):
            alike: dict[int, list[tuple]] = {}
            for row in group:
                alike.setdefault(row[3], []).append(row)
            counts = {context: sum(r[4] for r in held) for context, held in alike.items()}
            for context, held in alike.items():
                if counts[context] > 1:
                    for doc_id, check, _, _, n, _, first, last in held:
                        if n == 1:
                            yield doc_id, check, None, None, None, None, first, last + SPAN
            if len(alike) > 1 and 1 in counts.values():
                for context, held in alike.items():
                    doc_id, check, _, _, _, at, first, last = held[0]
                    yield doc_id, check, gram, context, min(counts[context], 2), at, first, last

    yield from batches(rows(), _ANCHORS, 16_384)


def _scan_groups(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts come sorted by gram and by what follows the anchor."""

    def rows() -> Iterator[tuple]:
        for _, group in groupby(_rows_of(parts), key=lambda r: r[2]):
            ids, checks, _, counts, places, lefts, rights = zip(*group, strict=True)
            for k, found in enumerate(reach(list(lefts), list(rights))):
                if found and counts[k] == 1:
                    yield ids[k], checks[k], places[k] - found[0], places[k] + found[1]

    yield from batches(rows(), _SPANS)


def _window_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for doc_id, check, _, n, at, left, right in _rows_of(parts):
            whole, first = left[::-1] + right, at - len(left)
            for k in range(len(whole) - SPAN + 1):
                yield xxhash.xxh3_128_digest(whole[k : k + SPAN]), doc_id, check, n, first + k

    yield from batches(rows(), _WINDOWS, 16_384)


# --- groups ----------------------------------------------------------------------------------

_PLACES = pa.schema(
    [*_ROW, ("gram", pa.int64()), ("context", pa.int64()), ("at", pa.int64()), ("first", pa.int64()), ("last", pa.int64())]
)
_PLACES_SQL = f"{_ROW_SQL}, gram long, context long, at long, first long, last long"
_CLASSES = pa.schema(
    [("group", pa.binary()), ("length", pa.int64()), ("gram", pa.int64()), ("context", pa.int64()), ("before", pa.int64())]
)
_CLASSES_SQL = "group binary, length long, gram long, context long, before long"
#: A gram with more contexts than this is split by the bytes around it, in steps of so many bytes.
SPLIT_GRAM, SPLIT_STEP = 1 << 12, 21


def _place_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every anchor of every text."""

    def rows() -> Iterator[tuple]:
        for part in parts:
            for doc_id, text in zip(part.column("doc_id").to_pylist(), texts_of(part), strict=True):
                check, found = xxhash.xxh3_128_digest(text), anchors(text).tolist()
                for gram, at, first, last in zip(*found, strict=True):
                    yield doc_id, check, gram, _context_hash(text, at, first, last), at, first, last

    yield from batches(rows(), _PLACES, 16_384)


def _split_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The contexts of frequent grams, once for each choice of bytes that a repeat may cover.

    A repeat that goes on to the right for r bytes, ``low`` <= r < ``low`` +
    ``SPLIT_STEP``, covers the first ``low`` bytes there and ``SPAN`` less the
    next bound on the left: contexts that share it agree in these.
    """

    def rows() -> Iterator[tuple]:
        for doc_id, check, gram, n, at, left, right in _rows_of(parts):
            for low in range(GRAM, SPAN + 1, SPLIT_STEP):
                needed = max(0, SPAN - (low + SPLIT_STEP - 1))
                if len(right) >= low and len(left) >= needed:
                    key = xxhash.xxh3_64_intdigest(left[:needed] + right[:low], low)
                    yield doc_id, check, key - (1 << 63), gram, n, at, left, right

    yield from batches(rows(), _SPLIT)


_SPLIT = pa.schema([*_ROW, ("part", pa.int64()), *list(_CONTEXTS)[2:]])
_SPLIT_SQL = f"{_ROW_SQL}, part long, gram long, n int, at long, left binary, right binary"


def _class_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts come sorted by part and by what follows the anchor."""

    def rows() -> Iterator[tuple]:
        for _, held in groupby(_rows_of(parts), key=lambda r: r[2]):
            _, _, _, grams, counts, _, lefts, rights = map(list, zip(*held, strict=True))
            wholes = [a[::-1] + b for a, b in zip(lefts, rights, strict=True)]
            contexts = [_context_hash(w, len(a), 0, len(w) - SPAN) for a, w in zip(lefts, wholes, strict=True)]
            # equal contexts are one entry; if there is more than one, all of it is a repeat
            classes = [(len(lefts[k]), len(rights[k]), [k]) for k, n in enumerate(counts) if n > 1]
            for before, after, members in (*classes, *repeat_classes(lefts, rights)):
                a = len(lefts[members[0]]) - before
                string = wholes[members[0]][a : a + before + after]
                group = xxhash.xxh3_128_digest(string)
                for k in members:
                    yield group, len(string), grams[k], contexts[k], before

    yield from batches(rows(), _CLASSES, 16_384)


def repeat_groups(docs: DataFrame, split: int = SPLIT_GRAM) -> DataFrame:
    """``group, length, doc_id, check, start``: maximal repeats with all their occurrences.

    A repeat is a string of ``SPAN`` bytes or more that occurs more than once,
    within what the strings around one anchor cover (up to ``2 * SPAN - GRAM``
    bytes; longer passages are several groups that overlap). It is maximal
    there: its occurrences go on differently on either side. ``group`` is 128
    bits of the string, ``check`` those of the row's text. Every anchor's
    context enters the suffix array, equal ones as one entry whose places are
    joined back; together the groups cover what :func:`remove_repeats` removes.
    Null texts are empty; rows that repeat are occurrences each (once, if id and
    text are equal); an empty table has no groups.
    """
    places = stored(docs.select("doc_id", "text").mapInArrow(_place_rows, _PLACES_SQL), "places")
    place = F.min(F.struct("doc_id", "check", "at", "first", "last")).alias("place")
    entries = places.groupBy("gram", "context").agg(F.count("*").alias("n"), place)
    grams = entries.groupBy("gram").agg(F.count("*").alias("contexts"), F.sum("n").alias("all")).filter(F.col("all") > 1)
    entries = entries.join(grams, "gram").select(
        "place.*", "gram", F.least("n", F.lit(2)).cast("int").alias("n"), (F.col("contexts") > split).alias("frequent")
    )
    entries = stored(entries, "entries")
    # a row that is listed more than once would give its contexts more than once
    texts = docs.select("doc_id", "text").distinct()
    plain = _context_bytes(texts, entries.filter("NOT frequent")).withColumn("part", F.col("gram"))
    many = _context_bytes(texts, entries.filter("frequent")).mapInArrow(_split_rows, _SPLIT_SQL)
    parts = plain.select(*many.columns).unionByName(many)
    classes = parts.repartition("part").sortWithinPartitions("part", "right").mapInArrow(_class_rows, _CLASSES_SQL)
    classes = stored(classes.distinct(), "classes")
    return (
        places.join(classes, ["gram", "context"])
        .select("group", "length", "doc_id", "check", (F.col("at") - F.col("before")).alias("start"))
        .distinct()
    )


# --- the corpus ------------------------------------------------------------------------------


def _pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed for a shuffle, with the key that tells rows of one id apart."""
    compress = zstandard.ZstdCompressor(level=1).compress
    for part in parts:
        texts = list(texts_of(part))
        columns = [[xxhash.xxh3_128_digest(t) for t in texts], [compress(t) for t in texts]]
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), *(pa.array(c, f.type) for c, f in zip(columns, list(_PACKED)[1:], strict=True))],
            schema=_PACKED,
        )


def packed_texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text").mapInArrow(_pack, f"{_ROW_SQL}, packed binary")


def _same_row(left: DataFrame, right: DataFrame):
    return left["doc_id"].eqNullSafe(right["of_doc"]) & (left["check"] == right["of_check"])


def _context_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    expand = zstandard.ZstdDecompressor().decompress

    def rows() -> Iterator[tuple]:
        for doc_id, check, packed, wanted in _rows_of(parts):
            text = expand(packed)
            for w in wanted:
                left = text[w["first"] : w["at"]][::-1]
                yield doc_id, check, w["gram"], w["n"], w["at"], left, text[w["at"] : w["last"] + SPAN]

    yield from batches(rows(), _CONTEXTS)


def _context_bytes(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """What precedes (reversed) and follows the anchor of each wanted context."""
    by_row = wanted.groupBy(F.col("doc_id").alias("of_doc"), F.col("check").alias("of_check")).agg(
        F.collect_list(F.struct("gram", "n", "at", "first", "last")).alias("wanted")
    )
    texts = packed_texts(docs)
    joined = texts.join(by_row, _same_row(texts, by_row)).select("doc_id", "check", "packed", "wanted")
    return joined.mapInArrow(_context_rows, _CONTEXTS_SQL)


def _as_spans(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "check", F.col("first").alias("start"), F.col("last").alias("end"))


def _ordinary_spans(docs: DataFrame, contexts: DataFrame) -> DataFrame:
    """Spans of the grams that a task can hold."""
    # a join by name puts its column first; the tasks read columns by place
    by_gram = contexts.select(*_ANCHORS.names).repartition("gram").sortWithinPartitions("gram")
    compared = stored(by_gram.mapInArrow(_compare_contexts, _ANCHORS_SQL), "compared")
    sorted_array = (
        _context_bytes(docs, compared.filter(F.col("gram").isNotNull()))
        .repartition("gram")
        .sortWithinPartitions("gram", "right")
    )
    scanned = sorted_array.mapInArrow(_scan_groups, _SPANS_SQL)
    return _as_spans(compared.filter(F.col("gram").isNull())).unionByName(scanned)


def _crowded_spans(docs: DataFrame, contexts: DataFrame) -> DataFrame:
    """Spans of the other grams, by aggregations that combine before their shuffle."""
    place = [F.first(c).alias(c) for c in ("doc_id", "check", "at", "first", "last")]
    counted = stored(contexts.groupBy("gram", "context").agg(F.sum("n").cast("int").alias("n"), *place), "crowded")
    alike = counted.filter("n > 1").select("gram", "context")
    found = contexts.filter("n = 1").join(alike, ["gram", "context"])
    found = found.withColumn("last", F.col("last") + SPAN)
    windows = stored(_context_bytes(docs, counted).mapInArrow(_window_rows, _WINDOWS_SQL), "windows")
    shared = windows.groupBy("digest").agg(F.count("*").alias("strings")).filter("strings > 1").select("digest")
    strings = windows.filter("n = 1").join(shared, "digest")
    strings = strings.select("doc_id", "check", "start", (F.col("start") + SPAN).alias("end"))
    return _as_spans(found).unionByName(strings)


def repeated_spans(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """``doc_id, check, start, end``: spans that together cover all repeated strings."""
    found = stored(docs.select("doc_id", "text").mapInArrow(_anchor_rows, _ANCHORS_SQL), "anchors")
    contexts = found.filter(F.col("gram").isNotNull())
    crowds = contexts.groupBy("gram").agg(F.count("*").alias("rows")).filter(F.col("rows") > crowd)
    crowds = stored(crowds.select("gram"), "crowds")
    spans = _as_spans(found.filter(F.col("gram").isNull()))
    if crowds.head(1):
        spans = spans.unionByName(_crowded_spans(docs, contexts.join(crowds, "gram", "left_semi")))
        contexts = contexts.join(crowds, "gram", "left_anti")
    return spans.unionByName(_ordinary_spans(docs, contexts))


def merged_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the covered bytes."""
    merged: list[list[int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    return [(a, b) for a, b in merged]


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(e for span in spans for e in span), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


_RESULT_SQL = (
    "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
    "spans array<struct<start: bigint, end: bigint>>, kept binary"
)
_RESULT = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
        ("kept_sha256", pa.string()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary()),
    ]
)


def _cut(with_bytes: bool):
    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress

        def rows() -> Iterator[tuple]:
            for part in parts:
                spans = part.column("spans")
                names = part.column("doc_id").to_pylist()
                for k, packed in enumerate(part.column("packed").to_pylist()):
                    text = expand(packed)
                    runs = merged_spans([(s["start"], s["end"]) for s in spans[k].as_py() or ()])
                    kept = cut_spans(text, runs)
                    listed = [{"start": a, "end": b} for a, b in runs]
                    digest = hashlib.sha256(kept).hexdigest()
                    yield (
                        names[k], len(text), len(text) - len(kept), len(runs), digest, listed,
                        kept if with_bytes else None,
                    )

        yield from batches(rows(), _RESULT, 512)

    return cut


def remove_repeats(docs: DataFrame, crowd: int = CROWD, with_bytes: bool = True) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept`` of every row.

    Texts are UTF-8 bytes, null is empty. Each byte is removed that is covered
    by a string of ``SPAN`` bytes which also starts elsewhere, in this text or
    another row's; overlaps count, strings never cross texts, and all are judged
    on the input. ``spans`` are the maximal removed runs, ``kept`` the bytes
    left (null unless ``with_bytes``; they may cut a character). Rows that
    repeat an id are told apart by their text; wholly equal rows are repeats of
    each other. An empty table gives no rows; other columns aren't read.
    """
    spans = (
        repeated_spans(docs, crowd)
        .groupBy(F.col("doc_id").alias("of_doc"), F.col("check").alias("of_check"))
        .agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    )
    texts = packed_texts(docs)
    joined = texts.join(spans, _same_row(texts, spans), "left").select("doc_id", "packed", "spans")
    return joined.mapInArrow(_cut(with_bytes), _RESULT_SQL)
