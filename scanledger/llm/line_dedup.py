"""Lines that many documents share, found through two Bloom filters.

A first pass sets the bits of every line key in a filter of keys seen once; a
bit that is hit again is also set in a filter of keys seen twice. Filters of
different tasks merge without loss: seen twice is seen twice in either, or once
in both. Only keys whose bits are all set in the second filter can occur in two
documents, so only those are shuffled, counted exactly and given the document
that keeps them. The filters have a fixed size; when a corpus fills them, more
keys are shuffled, but the result stays the same.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanledger.llm.common import ASCII_SPACE, batches, in_slices, schema_of, stored, texts_of, utf8

MIN_CHARS = 20
MIN_DOCS = 3
#: Bits of each filter; the one that is broadcast has an eighth as many bytes.
FILTER_BITS = 1 << 26
#: Filters travel in pieces, so that no task or row holds those of all tasks.
PIECE_BITS = 1 << 20
#: Tasks that build filters, at most: each of them sends its own two.
FILTER_TASKS = 4096
_PIECES = pa.schema([("piece", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])
_KEYS = pa.schema(
    [("digest", pa.binary()), ("line_key", pa.binary()), ("doc_id", pa.int64()), ("row_digest", pa.binary())]
)


def line_key(line: bytes) -> bytes:
    return line.strip(ASCII_SPACE).lower()


def shared_keys(text: bytes) -> set[bytes]:
    """The distinct keys of a text that are long enough to be dropped."""
    keys = {line_key(line) for line in text.split(b"\n")}
    # a key has as many code points as bytes that don't continue a character
    return {k for k in keys if len(k) >= MIN_CHARS and (k.isascii() or len(k.decode()) >= MIN_CHARS)}


def _positions(keys: list[bytes], bits: int) -> np.ndarray:
    """Two positions of each key, in two rows."""
    hashes = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], dtype=np.uint64)
    mask = np.uint64(bits - 1)
    return np.stack([hashes & mask, (hashes >> np.uint64(32)) & mask]).astype(np.int64)


def _are_set(at: np.ndarray, held: np.ndarray) -> np.ndarray:
    return ((held[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)


def _set(at: np.ndarray, held: np.ndarray) -> None:
    """Set the bits at sorted places of a filter that holds eight in a byte."""
    if len(at):
        octets, first = np.unique(at >> 3, return_index=True)
        held[octets] |= np.bitwise_or.reduceat(np.uint8(1) << (at & 7).astype(np.uint8), first)


def _hit(positions: np.ndarray, once: np.ndarray, twice: np.ndarray) -> None:
    """Set the bits of ``once``, and of ``twice`` where they are hit again."""
    distinct, counts = np.unique(positions, return_counts=True)
    _set(distinct[_are_set(distinct, once) | (counts > 1)], twice)
    _set(distinct, once)


def _pack(octets: np.ndarray) -> bytes:
    return zlib.compress(octets.tobytes(), 1)


def _unpack(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), np.uint8)


def _task_filters(bits: int):
    piece = min(bits, PIECE_BITS) // 8

    def build(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for part in in_slices(parts):
            keys = [k for text in part.column("text").to_pylist() for k in shared_keys(utf8(text))]
            if keys:
                first, second = _positions(keys, bits)
                # a key's two positions may be one; it must not count as hit twice
                _hit(np.concatenate([first, second[second != first]]), once, twice)
        rows = (
            (k, _pack(once[k * piece : (k + 1) * piece]), _pack(twice[k * piece : (k + 1) * piece]))
            for k in range(len(once) // piece)
            if once[k * piece : (k + 1) * piece].any()
        )
        yield from batches(rows, _PIECES, 16)

    return build


def _merge_pieces(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces come sorted by number; only the sums of one are held."""

    def merged() -> Iterator[tuple]:
        number, once, twice = None, None, None
        for part in parts:
            for k, a, b in zip(*(c.to_pylist() for c in part.columns), strict=True):
                a, b = _unpack(a), _unpack(b)
                if k != number:
                    if number is not None:
                        yield number, b"", zlib.compress(twice.tobytes(), 1)
                    number, once, twice = k, a, b
                else:
                    twice, once = twice | b | (once & a), once | a
        if number is not None:
            yield number, b"", zlib.compress(twice.tobytes(), 1)

    yield from batches(merged(), _PIECES, 16)


def seen_twice(docs: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """The merged filter of keys seen twice, as packed bytes; ``bits`` / 8 of them."""
    if bits & (bits - 1) or not 8 <= bits <= 1 << 32:
        raise ValueError("the bits of a filter must be a power of two from 8 to 2 ** 32")
    texts = docs.select("text").coalesce(FILTER_TASKS)
    schema = "piece int, once binary, twice binary"
    pieces = texts.mapInArrow(_task_filters(bits), schema)
    merged = (
        pieces.repartition("piece").sortWithinPartitions("piece").mapInArrow(_merge_pieces, schema)
    )
    piece = min(bits, PIECE_BITS) // 8
    whole = np.zeros(max(1, bits // 8), np.uint8)
    for row in merged.filter(F.length("twice") > 0).collect():
        whole[row.piece * piece : (row.piece + 1) * piece] = _unpack(row.twice)
    return whole


def _suspects(twice, bits: int):
    def find(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = twice.value
        for part in in_slices(parts):
            ids, keys = [], []
            texts = part.column("text").to_pylist()
            for doc_id, text in zip(part.column("doc_id").to_pylist(), texts, strict=True):
                own = shared_keys(utf8(text))
                keys += own
                ids += [(doc_id, xxhash.xxh3_128_digest(utf8(text)))] * len(own)
            if not keys:
                continue
            at = _positions(keys, bits)
            hit = _are_set(at, held).all(axis=0)
            found = np.flatnonzero(hit).tolist()
            rows = ((xxhash.xxh3_128_digest(keys[k]), keys[k], *ids[k]) for k in found)
            yield from batches(rows, _KEYS)

    return find


def suspected_keys(docs: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """``digest, line_key, doc_id, row_digest`` of the keys that may be in more than one document."""
    spark: SparkSession = docs.sparkSession
    twice = spark.sparkContext.broadcast(seen_twice(docs, bits))
    return docs.select("doc_id", "text").mapInArrow(
        _suspects(twice, bits), "digest binary, line_key binary, doc_id long, row_digest binary"
    )


def lost_keys(docs: DataFrame, bits: int = FILTER_BITS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc_id, row_digest, lost``: the digests of the keys whose lines each row loses.

    A row is known by its id and 128 bits of its text, so what is gathered is
    bounded by the lines of one text, also where rows have no id or one in common.
    """
    suspects = stored(suspected_keys(docs, bits), "suspects")
    counted = suspects.groupBy("line_key", "digest").agg(
        F.count("*").alias("documents"), F.max("doc_id").alias("keeper")
    )
    repeated = counted.filter(F.col("documents") >= min_docs).select("digest", "keeper")
    losers = suspects.select("digest", "doc_id", "row_digest").join(repeated, "digest")
    losers = losers.filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return losers.groupBy("doc_id", "row_digest").agg(F.collect_set("digest").alias("lost"))


def kept_lines(text: bytes, lost: set[bytes]) -> tuple[bytes, int, int]:
    """What stays of a text, its lines before and the lines dropped."""
    lines = text.split(b"\n")
    if not lost:
        return text, len(lines), 0
    kept = [x for x in lines if xxhash.xxh3_128_digest(line_key(x)) not in lost]
    return b"\n".join(kept), len(lines), len(lines) - len(kept)


def _drop(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in in_slices(parts):
        texts = part.column("text").to_pylist()
        lost = part.column("__lost").to_pylist()
        done = [kept_lines(utf8(t), set(x or ())) for t, x in zip(texts, lost, strict=True)]
        new = [None if t is None else d[0].decode() for t, d in zip(texts, done, strict=True)]
        columns = {name: part.column(name) for name in part.schema.names if name != "__lost"}
        columns["text"] = pa.array(new, pa.string())
        columns["n_lines"] = pa.array([d[1] for d in done], pa.int64())
        columns["n_dropped"] = pa.array([d[2] for d in done], pa.int64())
        yield pa.RecordBatch.from_pydict(columns)


def _with_digest(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        columns = {name: part.column(name) for name in part.schema.names}
        digests = [xxhash.xxh3_128_digest(text) for text in texts_of(part)]
        yield pa.RecordBatch.from_pydict({**columns, "__row": pa.array(digests, pa.binary())})


def drop_repeated_lines(
    docs: DataFrame, bits: int = FILTER_BITS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """The documents without repeated lines, with ``n_lines`` (before) and ``n_dropped``.

    Texts are split at ``\\n``; a null or empty text is one empty line and stays
    as it is. A key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z
    lower-cased. Keys of at least ``MIN_CHARS`` code points in at least
    ``min_docs`` rows lose all their lines except in the largest doc_id that
    holds them; null ids rank lowest, and rows that repeat an id are treated
    alike. Other lines stay, joined by ``\\n``. Other columns are carried on;
    earlier columns named ``n_lines`` or ``n_dropped`` are replaced. An empty
    table gives no rows.
    """
    docs = docs.drop("n_lines", "n_dropped")
    lost = lost_keys(docs, bits, min_docs).select(
        F.col("doc_id").alias("__losing"), F.col("row_digest").alias("__losing_row"), F.col("lost").alias("__lost")
    )
    known = docs.mapInArrow(_with_digest, schema_of(docs, "__row binary"))
    same = F.col("doc_id").eqNullSafe(F.col("__losing")) & (F.col("__row") == F.col("__losing_row"))
    joined = known.join(lost, same, "left").drop("__losing", "__losing_row", "__row")
    return joined.mapInArrow(_drop, schema_of(docs, "n_lines long, n_dropped long"))
