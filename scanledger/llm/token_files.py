"""Token ids of a corpus in files with random access, as directly addressable codes.

An id is cut into chunks of eight bits, lowest first. Level k holds the k-th
chunk of all ids that have one, and a bitmap tells which of them go on at the
next level. A rank directory counts the set bits before every block of 512, so
the place of an id's next chunk is one addition and one count in a block, and
any single id is read without decoding those before it.

The files are Parquet, so that any store that Spark writes to can hold them and
a lost task is written again. A row is a segment of whole documents, in
ascending doc_id order within and across files::

    shard, segment     the file's place in the order, and the row's place in it
    doc_ids            of the segment's documents, null allowed
    doc_starts         first token of each within the segment, and the end
    n_tokens           of the segment
    levels             of each: chunks (bytes), more (bitmap, lowest bit first; empty
                       at the last level), ranks (unsigned 32-bit, little endian)
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scanledger.llm.common import batches
from scanledger.llm.pretokens import WordTable, groups_of, split_words
from scanledger.session import scratch_dir

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
#: Tokens of a segment, after which the next document starts another one.
SEGMENT_TOKENS = 1 << 20
RANK_BITS = 512
#: Words that a worker keeps encoded.
CACHED_WORDS = 1 << 19

_LEVEL = pa.struct([("chunks", pa.binary()), ("more", pa.binary()), ("ranks", pa.binary())])
_SEGMENT = pa.schema(
    [
        ("shard", pa.int32()), ("segment", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
        ("doc_starts", pa.list_(pa.int64())), ("n_tokens", pa.int64()), ("levels", pa.list_(_LEVEL)),
    ]
)
SEGMENT_SQL = (
    "shard int, segment int, doc_ids array<long>, doc_starts array<long>, n_tokens long, "
    "levels array<struct<chunks: binary, more: binary, ranks: binary>>"
)
_READ = pa.schema(
    [
        ("shard", pa.int32()), ("segment", pa.int32()), ("doc_id", pa.int64()),
        ("within", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
    ]
)


# --- the code --------------------------------------------------------------------------------


def encode_levels(ids: np.ndarray) -> list[dict[str, bytes]]:
    """The levels of some ids; at least one."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        chunks, rest = (rest & 0xFF).astype(np.uint8), rest >> 8
        more = rest > 0
        if not more.any():
            return [*levels, {"chunks": chunks.tobytes(), "more": b"", "ranks": b""}]
        before = np.add.accumulate(np.add.reduceat(more, np.arange(0, len(more), RANK_BITS), dtype=np.uint32))
        ranks = np.concatenate([[0], before[:-1]]).astype("<u4")
        bits = np.packbits(more, bitorder="little")
        levels.append({"chunks": chunks.tobytes(), "more": bits.tobytes(), "ranks": ranks.tobytes()})
        rest = rest[more]


def decode_levels(levels: list) -> np.ndarray:
    """All ids of a segment."""
    ids = np.frombuffer(levels[0]["chunks"], np.uint8).astype(np.uint32)
    at = np.arange(len(ids))
    for k, level in enumerate(levels[:-1]):
        more = np.unpackbits(np.frombuffer(level["more"], np.uint8), count=len(at), bitorder="little")
        at = at[more.astype(bool)]
        ids[at] |= np.frombuffer(levels[k + 1]["chunks"], np.uint8).astype(np.uint32) << np.uint32(8 * (k + 1))
    return ids


def token_at(levels: list, place: int) -> int:
    """One id of a segment, from one byte and one rank a level."""
    found = 0
    for k, level in enumerate(levels):
        found |= level["chunks"][place] << (8 * k)
        if not level["more"] or not level["more"][place >> 3] >> (place & 7) & 1:
            return found
        block = place // RANK_BITS
        inside = level["more"][block * RANK_BITS // 8 : (place >> 3) + 1]
        below = int.from_bytes(inside, "little") & ((1 << (place - block * RANK_BITS)) - 1)
        place = int(np.frombuffer(level["ranks"], "<u4", 1, 4 * block)[0]) + below.bit_count()
    raise ValueError("the last level goes on")


# --- words -----------------------------------------------------------------------------------


def byte_characters() -> dict[int, int]:
    """The characters that stand for bytes in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + k for k, b in enumerate(hidden)}


class Words(WordTable):
    """Words encoded by the model of a tokenizer file, which needs no more than the split words.

    With ``added_tokens``, the tokens that the file adds to its model are cut
    out of the texts first and have their own ids, as the library does it.
    """

    def __init__(self, path: str, most: int = CACHED_WORDS, added_tokens: bool = False):
        tokenizer = Tokenizer.from_file(path)
        found = tokenizer.get_added_tokens_decoder() if added_tokens else {}
        if any(t.single_word or t.lstrip or t.rstrip for t in found.values()):
            raise ValueError("added tokens that depend on what is around them can't be cut out")
        self.added = {t.content: k for k, t in found.items()}
        # of those that start at one place, the longest
        longest = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile(f"({'|'.join(map(re.escape, longest))})").split if longest else None
        if tokenizer.normalizer is not None:
            raise ValueError("a vocabulary whose tokenizer changes texts can't be used by words")
        self.tokenize, self.shown = tokenizer.model.tokenize, byte_characters()
        self.space = chr(self.shown[ord(" ")])
        super().__init__(self._encode, most)

    def _encode(self, word: str) -> list[int]:
        if word in self.added:
            return [self.added[word]]
        if word.isascii() and word.isalnum():
            shown = word
        elif word.isascii() and word[1:].isalnum() and word[0] == " ":
            shown = self.space + word[1:]
        else:
            shown = word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.shown)
        return [t.id for t in self.tokenize(shown)]

    def documents(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some texts, one after the other, and how many each has."""
        return self.lookup([self._split(text) for text in texts])

    def _split(self, text: str) -> list[str]:
        pieces = self.cut(text) if self.cut else [text]
        if len(pieces) == 1:
            return split_words(text)
        return [w for piece in pieces for w in ([piece] if piece in self.added else split_words(piece))]


_words: dict[tuple[str, bool], Words] = {}


def worker_words(path: str, added_tokens: bool = False) -> Words:
    """The table of this worker; it outlives the task."""
    if (path, added_tokens) not in _words:
        _words[path, added_tokens] = Words(path, added_tokens=added_tokens)
    return _words[path, added_tokens]


# --- files -----------------------------------------------------------------------------------


def _segments(path: str, added_tokens: bool):
    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, shard = worker_words(path, added_tokens), TaskContext.get().partitionId()

        def encoded() -> Iterator[tuple]:
            for part in parts:
                texts = [t or "" for t in part.column("text").to_pylist()]
                doc_ids, at = part.column("doc_id").to_pylist(), 0
                for group in groups_of(texts):
                    ids, sizes = words.documents(group)
                    yield doc_ids[at : at + len(group)], ids, sizes
                    at += len(group)

        def rows() -> Iterator[tuple]:
            doc_ids, ids, starts, number = [], [], [0], 0
            end = np.array([END_ID], np.uint32)
            for names, group, sizes in encoded():
                edges = np.concatenate([[0], np.cumsum(sizes)])
                for k, name in enumerate(names):
                    doc_ids.append(name)
                    ids += [group[edges[k] : edges[k + 1]], end]
                    starts.append(starts[-1] + int(sizes[k]) + 1)
                    if starts[-1] >= SEGMENT_TOKENS:
                        yield shard, number, doc_ids, starts, starts[-1], encode_levels(np.concatenate(ids))
                        doc_ids, ids, starts, number = [], [], [0], number + 1
            if doc_ids:
                yield shard, number, doc_ids, starts, starts[-1], encode_levels(np.concatenate(ids))

        yield from batches(rows(), _SEGMENT, 1)

    return write


def write_token_files(
    docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, added_tokens: bool = False
) -> None:
    """Encode the whole texts and write the files, in ascending doc_id order.

    Null texts are empty; each document ends with id 0; strings of added tokens
    in a text have those tokens' ids if ``added_tokens``, as with the library's
    ``encode``, and are ordinary text otherwise. Null ids come first; rows that
    repeat an id follow one another by a hash of their text, which also parts
    them among tasks. An empty table gives files without rows.
    """
    path = public_tokenizers.path(vocabulary)
    order = ("doc_id", F.xxhash64("text"))
    ordered = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.mapInArrow(_segments(path, added_tokens), SEGMENT_SQL).write.parquet(folder)


def _documents(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for part in parts:
            for k in range(part.num_rows):
                row = part.slice(k, 1).to_pylist()[0]
                ids, starts = decode_levels(row["levels"]).astype("<u4"), row["doc_starts"]
                for doc_id, first, end in zip(row["doc_ids"], starts, starts[1:], strict=False):
                    digest = zlib.crc32(ids[first:end].tobytes())
                    yield row["shard"], row["segment"], doc_id, first, end - first, digest

    yield from batches(rows(), _READ)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files."""
    files = spark.read.schema(SEGMENT_SQL).parquet(folder)
    sizes = files.select("shard", "segment", "n_tokens")
    shards = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("all"))
    # one row per file: their sums need no split
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("shard_start"))
    inside = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("segment_start", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    starts = starts.join(shards, "shard").select(
        "shard", "segment", (F.col("shard_start") + F.col("segment_start")).alias("before")
    )
    found = files.mapInArrow(
        _documents, "shard int, segment int, doc_id long, within long, n_tokens long, ids_crc32 long"
    )
    return found.join(starts, ["shard", "segment"]).select(
        "doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_files(docs: DataFrame, vocabulary: str = VOCABULARY, added_tokens: bool = False) -> DataFrame:
    """Write the files to a new folder beside the session's tables, and read them back."""
    folder = scratch_dir(docs.sparkSession, "tokens")
    write_token_files(docs, folder, vocabulary, added_tokens)
    return read_token_files(docs.sparkSession, folder)
