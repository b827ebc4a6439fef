"""Byte-level BPE over a corpus in which each distinct word is encoded once.

Texts are cut into pre-tokens ("words") by the vocabulary's pattern; BPE works
inside a word only, so equal words have equal ids wherever they stand.

1. Texts are dealt to blocks by a hash; the table of blocks is shuffled once and
   read twice. The words of a block are its distinct pre-tokens in order, and a
   word's place in that order is the same whenever a block is read.
2. The words of all blocks are exploded with block and place and shuffled by
   the word: each distinct word is encoded in one place.
3. The ids of the distinct words are joined with the table of token bytes,
   which decodes them.
4. Ids are joined back to the blocks, where each text takes them by position.

A word that stands everywhere is one row per block, not one per occurrence.
What a word decodes to travels only if it is not the word itself.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - makes pa.compute known
import tiktoken
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanledger.llm.common import schema_of, texts_of
from scanledger.llm.pretokens import gather, split_words

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Code points of a block, on average. It bounds what a task holds; larger blocks repeat fewer words.
BLOCK_CHARS = 1 << 23
#: Places that a task holds before it sends them on by block.
HELD_PLACES = 1 << 20


# --- vocabulary ------------------------------------------------------------------------------


def read_ranks(vocabulary: str) -> dict[bytes, int]:
    with open(public_tokenizers.path(vocabulary), "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


_encodings: dict[str, tiktoken.Encoding] = {}


def word_ids(vocabulary: str, words: list[str]) -> list[list[int]]:
    """The ids of some words, each by itself and without special tokens."""
    if vocabulary not in _encodings:
        _encodings[vocabulary] = tiktoken.Encoding(
            "ranks", pat_str=r"(?s:.+)", mergeable_ranks=read_ranks(vocabulary), special_tokens={}
        )
    encode = _encodings[vocabulary].encode_ordinary
    return [encode(word) for word in words]


def token_table(spark: SparkSession, vocabulary: str) -> DataFrame:
    """``id, token``; as many rows as the vocabulary has."""
    ids, tokens = zip(*((i, t) for t, i in read_ranks(vocabulary).items()), strict=True)
    schema = pa.schema([("id", pa.int32()), ("token", pa.binary())])
    return spark.createDataFrame(pa.table([pa.array(ids, pa.int32()), pa.array(tokens, pa.binary())], schema))


# --- blocks ----------------------------------------------------------------------------------


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers of four bytes, plane by plane; the upper planes are mostly zeros."""
    return np.ascontiguousarray(numbers.astype("<u4").view("u1").reshape(-1, 4).T).tobytes()


def _from_planes(planes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


def pack_arrays(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers, or of bytes, compressed together."""
    body = [a.tobytes() if a.dtype == np.uint8 else _planes(a) for a in arrays]
    head = np.array([len(b) for b in body], "<u8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(b"".join((head, *body)))


def unpack_arrays(packed: bytes, count: int) -> list[np.ndarray]:
    """``count`` arrays; a last one of bytes is left as it is."""
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), "u1")
    sizes = data[: 8 * count].view("<u8").tolist()
    edges = 8 * count + np.cumsum([0, *sizes])
    return [data[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]


_MIX = 0x9E3779B97F4A7C15


#: Texts, and code points of each, that the dictionary is made of by which texts are compressed.
SAMPLE_TEXTS, SAMPLE_CHARS, DICTIONARY_BYTES = 4_000, 2_000, 1 << 18


def shared_dictionary(docs: DataFrame) -> bytes:
    """What texts often have in common, for their compression; most are too short to show it themselves.

    It is made of the beginnings of some texts, whichever come first: it makes
    rows shorter and changes no result. Too few texts give none.
    """
    rows = docs.select(F.left("text", F.lit(SAMPLE_CHARS))).filter(F.length("text") > 0).limit(SAMPLE_TEXTS).collect()
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [r[0].encode() for r in rows]).as_bytes()
    except zstandard.ZstdError:
        return b""


def _deal(blocks: int, dictionary: bytes):
    def deal(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = zstandard.ZstdCompressionDict(dictionary)
        compress = zstandard.ZstdCompressor(level=6, dict_data=common, write_dict_id=False).compress
        for part in parts:
            texts = list(texts_of(part))
            ids = part.column("doc_id").cast(pa.int64()).fill_null(0).to_pylist()
            # copies of a text are dealt apart by their ids
            dealt = [(xxhash.xxh3_64_intdigest(t) ^ i * _MIX) % blocks for t, i in zip(texts, ids, strict=True)]
            columns = {n: part.column(n) for n in part.schema.names if n != "text"}
            columns["__packed"] = pa.array([compress(t) for t in texts], pa.binary())
            columns["__block"] = pa.array(dealt, pa.int32())
            yield pa.RecordBatch.from_pydict(columns)

    return deal


def text_blocks(docs: DataFrame, chars: int = BLOCK_CHARS, dictionary: bytes = b"") -> DataFrame:
    """The documents with ``__packed`` instead of their text, shuffled by ``__block``.

    The number of blocks follows from the code points of all texts.
    """
    size = docs.agg(F.sum(F.length("text").cast("long")).alias("chars")).first().chars or 0
    schema = schema_of(docs, "__packed binary, __block int", ("text",))
    deal = _deal(max(1, math.ceil(size / chars)), dictionary)
    return docs.mapInArrow(deal, schema).repartition("__block")


def _unpacked(packed: pa.Array | pa.ChunkedArray, dictionary: bytes) -> Iterator[str]:
    expand = zstandard.ZstdDecompressor(zstandard.ZstdCompressionDict(dictionary)).decompress
    for text in packed.to_pylist():
        yield expand(text).decode("utf-8", "surrogatepass")


# --- distinct words --------------------------------------------------------------------------

_WORDS_AT_ONCE = 1 << 16


def _block_words(dictionary: bytes):
    """Rows come sorted by block: the distinct words of each in order."""

    def listed(block: int, seen: set[str]) -> Iterator[pa.RecordBatch]:
        words = sorted(seen)
        for k in range(0, len(words), _WORDS_AT_ONCE):
            some = words[k : k + _WORDS_AT_ONCE]
            places = (block << 32) + np.arange(k, k + len(some), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), pa.array(places)], ["word", "at"])

    def find(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, seen = -1, set()
        for part in parts:
            blocks = part.column("__block").to_numpy()
            edges = np.flatnonzero(np.diff(blocks, prepend=-1)).tolist()
            for first, end in zip(edges, [*edges[1:], len(blocks)], strict=True):
                if blocks[first] != at:
                    yield from listed(at, seen)
                    at, seen = int(blocks[first]), set()
                for text in _unpacked(part.column("__packed").slice(first, end - first), dictionary):
                    seen.update(split_words(text))
        yield from listed(at, seen)

    return find


def word_places(blocks: DataFrame, dictionary: bytes = b"") -> DataFrame:
    """``word, at``: every word of every block, with the block's number in the upper half of ``at`` and
    the word's place in the block in the lower."""
    return blocks.sortWithinPartitions("__block").mapInArrow(_block_words(dictionary), "word string, at long")


def _encode_words(vocabulary: str):
    """Rows come sorted by word: those of one word become one row with its places and ids."""

    def encode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            words = part.column("word").to_pylist()
            if not words:
                continue
            first = [k for k in range(len(words)) if not k or words[k] != words[k - 1]]
            own = [words[k] for k in first]
            row = {
                "word": pa.array(own, pa.string()),
                "places": pa.ListArray.from_arrays(pa.array([*first, len(words)], pa.int32()), part.column("at")),
                "ids": pa.array(word_ids(vocabulary, own), pa.list_(pa.int32())),
            }
            yield pa.RecordBatch.from_pydict(row)

    return encode


def encoded_words(places: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``word, places, ids``: each distinct word once, with the places of the blocks where it stands.

    A word of more places than an Arrow batch holds has several rows.
    """
    return (
        places.repartition("word")
        .sortWithinPartitions("word")
        .mapInArrow(_encode_words(vocabulary), "word string, places array<bigint>, ids array<int>")
    )


def decoded_words(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``word, places, position, id, token``: the ids of the words joined with the token-byte table.

    The table is as large as the vocabulary and is broadcast, so the rows of a
    word stay together; the word and its places are on the first of them.
    """
    each = encoded.select("word", "places", F.posexplode("ids").alias("position", "id"))
    first = F.col("position") == 0
    each = each.select(*(F.when(first, F.col(c)).alias(c) for c in ("word", "places")), "position", "id")
    tokens = F.broadcast(token_table(encoded.sparkSession, vocabulary))
    return each.join(tokens, "id").select("word", "places", "position", "id", "token")


class _Words:
    """Decoded words that a task has read, ready to be sent to their blocks."""

    def __init__(self) -> None:
        self.parts: list[pa.RecordBatch] = []
        self.held = 0

    def add(self, part: pa.RecordBatch) -> None:
        if part.num_rows:
            self.parts.append(part)
            self.held += len(part.column("places").flatten()) + part.num_rows

    def send(self, last: bool) -> Iterator[pa.RecordBatch]:
        """One row per block; a word whose rows may go on in the next batch stays."""
        table = pa.Table.from_batches(self.parts).combine_chunks()
        position = table.column("position").to_numpy()
        first = np.flatnonzero(position == 0)
        end = len(position) if last else int(first[-1])
        rest = table.slice(end)
        self.parts, self.held = rest.to_batches(), rest.num_rows
        if not end:
            return
        table, first = table.slice(0, end), first[first < end]
        counts = np.diff(np.append(first, end))
        if not np.array_equal(position[:end], np.arange(end) - np.repeat(first, counts)):
            raise ValueError("the ids of a word don't stand together")
        ids = table.column("id").to_numpy()
        heads = table.take(pa.array(first)).select(["word", "places"]).combine_chunks()
        letters, sizes = _other_bytes(
            heads.column("word").to_pylist(), table.column("token").to_pylist(), first.tolist()
        )
        lists = heads.column("places").combine_chunks()
        word = np.repeat(np.arange(len(first)), np.array(pa.compute.list_value_length(lists)))
        at = lists.flatten().to_numpy(zero_copy_only=False)
        order = np.argsort(at)
        at, word = at[order], word[order]
        blocks, places = at >> 32, at & 0xFFFFFFFF
        starts = np.cumsum(np.maximum(sizes - 1, 0)) - np.maximum(sizes - 1, 0)
        edges = np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1], [True]]))
        rows = []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            own = word[a:b]
            rows.append(
                pack_arrays(
                    np.diff(places[a:b], prepend=0), counts[own], sizes[own], gather(ids, first[own], counts[own]),
                    gather(letters, starts[own], np.maximum(sizes[own] - 1, 0)),
                )
            )
        columns = [pa.array(blocks[edges[:-1]].astype(np.int32), pa.int32()), pa.array(rows, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["block", "found"])


def _other_bytes(words: list[str], tokens: list[bytes], first: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The decoded bytes of words that don't decode to themselves; for each word 0, or their number and one."""
    sizes, others = np.zeros(len(words), np.int64), []
    for k, (word, a, b) in enumerate(zip(words, first, [*first[1:], len(tokens)], strict=True)):
        decoded = tokens[a] if b == a + 1 else b"".join(tokens[a:b])
        if decoded != word.encode("utf-8", "surrogatepass"):
            sizes[k] = 1 + len(decoded)
            others.append(decoded)
    return np.frombuffer(b"".join(others), np.uint8), sizes


def _send_words(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = _Words()
    for part in parts:
        words.add(part)
        if words.held >= HELD_PLACES:
            yield from words.send(False)
    if words.parts:
        yield from words.send(True)


def block_ids(decoded: DataFrame) -> DataFrame:
    """``block, found``: the ids of a block's words with their places, packed; several rows a block."""
    return decoded.mapInArrow(_send_words, "block int, found binary")


# --- whole texts -----------------------------------------------------------------------------

_encoded_type = pa.struct(
    [("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
)


class _Block:
    """The encoded words of a block by their places."""

    def __init__(self, found: list[bytes], words: list[str]):
        parts = [unpack_arrays(p, 5) for p in found]
        places, counts, sizes, ids = (
            [_from_planes(part[k]).astype(np.int64) for part in parts] for k in range(4)
        )
        places = _joined([np.cumsum(p) for p in places])
        order = np.argsort(places)
        if not np.array_equal(places[order], np.arange(len(words))):
            raise ValueError("the ids of some words are missing")
        counts, sizes, ids = _joined(counts), _joined(sizes), _joined(ids)
        self.counts = counts[order]
        self.starts = np.cumsum(self.counts) - self.counts
        self.ids = gather(ids, (np.cumsum(counts) - counts)[order], self.counts)
        decimal = list(map(str, self.ids.tolist()))
        edges = [*self.starts.tolist(), len(decimal)]
        self.listed = [",".join(decimal[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        self.bytes = [w.encode("utf-8", "surrogatepass") for w in words]
        letters = b"".join(p[4].tobytes() for p in parts)
        lengths = np.maximum(sizes - 1, 0)
        begin, own = (np.cumsum(lengths) - lengths)[order], sizes[order]
        for k in np.flatnonzero(own).tolist():
            self.bytes[k] = letters[begin[k] : begin[k] + own[k] - 1]


def _joined(arrays: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.zeros(0, np.int64)


class _Numbers(dict):
    """Words by the order in which they are met."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def _numbered(texts: Iterator[str]) -> tuple[list[str], list[np.ndarray]]:
    """The distinct words of some texts in order, and the place of each word of each text among them.

    A word is held once, not wherever it stands.
    """
    numbers, met = _Numbers(), []
    for text in texts:
        own = split_words(text)
        met.append(np.fromiter(map(numbers.__getitem__, own), np.int32, len(own)))
    words = sorted(numbers)
    places = np.zeros(len(words), np.int32)
    places[list(map(numbers.__getitem__, words))] = np.arange(len(words))
    return words, [places[m] for m in met]


def _assemble(with_ids: bool, dictionary: bytes):
    def assemble(docs: pa.Table, found: pa.Table) -> pa.Table:
        words, split = _numbered(_unpacked(docs.column("__packed"), dictionary))
        block = _Block(found.column("found").to_pylist(), words)
        rows = []
        for at in split:
            places = at.tolist()
            listed = ",".join(map(block.listed.__getitem__, places))
            decoded = b"".join(map(block.bytes.__getitem__, places))
            ids = gather(block.ids, block.starts[at], block.counts[at]) if with_ids else None
            digests = (hashlib.sha256(x).hexdigest() for x in (listed.encode(), decoded))
            rows.append((int(block.counts[at].sum()), ids, *digests))
        fields = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _encoded_type, strict=True)]
        encoded = pa.StructArray.from_arrays(fields, fields=list(_encoded_type))
        return docs.drop_columns(["__packed", "__block"]).append_column("encoded", encoded)

    return assemble


def encode_and_decode(
    docs: DataFrame, vocabulary: str = VOCABULARY, with_ids: bool = True, block_chars: int = BLOCK_CHARS, apart: bool = False
) -> DataFrame:
    """The documents without ``text``, with a struct ``encoded``.

    It holds ``n_tokens``, ``ids`` (null unless ``with_ids``), ``ids_sha256``
    (of the decimal ids joined by commas) and ``decoded_sha256`` (of the bytes
    decoded from the ids), the digests as lower-case hex. Special tokens in a
    text are ordinary text; null texts are empty and have no ids. Null and
    repeated ids make no difference; rows that repeat stay, an empty table gives
    no rows, and an earlier column ``encoded`` is replaced. ``apart``
    shuffles the encoded words before they are decoded: else a task has a Python
    worker for either step, and Spark keeps both for what is run later.
    """
    docs = docs.drop("encoded")
    dictionary = shared_dictionary(docs)
    blocks = text_blocks(docs, block_chars, dictionary)
    places = word_places(blocks, dictionary)
    encoded = encoded_words(places, vocabulary)
    found = block_ids(decoded_words(encoded.repartition("word") if apart else encoded, vocabulary))
    kind = "struct<n_tokens: bigint, ids: array<int>, ids_sha256: string, decoded_sha256: string>"
    both = blocks.groupBy("__block").cogroup(found.groupBy("block"))
    return both.applyInArrow(_assemble(with_ids, dictionary), schema_of(docs, f"encoded {kind}", ("text",)))
