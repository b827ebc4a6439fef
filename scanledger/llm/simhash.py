"""Near-duplicate documents by SimHash fingerprints and pivot distance tables.

Equal fingerprints are one class, so copies cost nothing further. Two classes
link if their fingerprints differ in ``MAX_BITS`` bits or fewer. The distances
of every fingerprint to fixed reference fingerprints (pivots) are computed
once. By the triangle inequality, the distances of a linked pair to any pivot
differ by ``MAX_BITS`` at most, so a pair is discarded by its largest
difference of coordinates, and only survivors are compared bit by bit.

To make no all-pairs join of it, pairs are looked for only where they can be:
64 bits are cut into five segments, two bits change two of them at most, so
linked fingerprints agree in three whole segments (ten ways to choose). A
block of more than ``BLOCK_PAIRS`` fingerprints emits no pairs: there each
fingerprint goes to itself and its one-bit neighbours, and those that meet
are linked to the least of them. Two fingerprints at distance two or less
always meet so, and none further apart does.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanledger.llm.common import stored, texts_of
from scanledger.llm.components import connected_components

SHINGLE_WORDS = 3
HASH_SEED = 42
MAX_BITS = 2
#: Fingerprints of a block up to which its pairs are compared; beyond it they meet at neighbours.
BLOCK_PAIRS = 64
SEGMENT_BITS = (13, 13, 13, 13, 12)
#: Pivots: the first words of the published SplitMix64 sequence. Seven distances fill one packed table
#: column, a byte each, so that sums of bytes never reach the sign bit.
TABLE_COLUMNS, LANES = 2, 7
_FINGERPRINTS = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])


def fingerprint(text: bytes) -> int:
    """SimHash of the word shingles, A-Z lower-cased; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= SHINGLE_WORDS:
        return xxhash.xxh64_intdigest(b" ".join(words), HASH_SEED)
    shingles = zip(*(words[k:] for k in range(SHINGLE_WORDS)), strict=False)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    hashes = np.array([digest(join(s), HASH_SEED) for s in shingles], dtype=np.uint64)
    return _majority(hashes)


def _majority(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half of the hashes.

    Eight bits that lie a byte apart are counted at once, in the bytes of one
    word; after 255 additions the bytes are spread to wider counters.
    """
    lanes = np.uint64(0x0101010101010101)
    starts = np.arange(0, len(hashes), 255)
    value = 0
    for low in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(low)) & lanes, starts)
        counts = sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
        for byte in np.flatnonzero(2 * counts > len(hashes)).tolist():
            value |= 1 << (8 * byte + low)
    return value


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _fingerprint_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        found = [_signed(fingerprint(text)) for text in texts_of(part)]
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id").cast(pa.int64()), pa.array(found, pa.int64())],
            schema=_FINGERPRINTS,
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the fingerprint as a signed long; null texts have no words."""
    return docs.select("doc_id", "text").mapInArrow(_fingerprint_rows, "doc_id long, fp long")


def pivots(count: int = TABLE_COLUMNS * LANES) -> list[int]:
    """Reference fingerprints: SplitMix64 from seed 0, about half of the bits set."""
    found, state = [], 0
    for _ in range(count):
        state = (state + 0x9E3779B97F4A7C15) % (1 << 64)
        mixed = (state ^ state >> 30) * 0xBF58476D1CE4E5B9 % (1 << 64)
        mixed = (mixed ^ mixed >> 27) * 0x94D049BB133111EB % (1 << 64)
        found.append(mixed ^ mixed >> 31)
    return found


def distance_table(fp: Column) -> list[Column]:
    """Distances to all pivots, packed a byte each into columns ``near0, near1, ...``."""
    packed = []
    for k in range(TABLE_COLUMNS):
        total = F.lit(0).cast("long")
        for lane, pivot in enumerate(pivots()[k * LANES : (k + 1) * LANES]):
            distance = F.bit_count(fp.bitwiseXOR(F.lit(_signed(pivot)).cast("long"))).cast("long")
            total = total.bitwiseOR(F.shiftleft(distance, 8 * lane))
        packed.append(total.alias(f"near{k}"))
    return packed


def _every_lane(value: int) -> int:
    return sum(value << (8 * lane) for lane in range(LANES))


def within_table(left: Column, right: Column) -> Column:
    """No coordinate of two packed tables differs by more than ``MAX_BITS``.

    Each lane holds 128 + left - right, which is 126 to 130 for a pair that may
    link; less 126 it is 0 to 4, and with 3 added it still has no bit above the
    lowest three. A lane below 126 borrows and so shows high bits itself.
    """
    top = F.lit(_every_lane(128)).cast("long")
    lanes = left.bitwiseOR(top) - right - F.lit(_every_lane(128 - MAX_BITS)).cast("long")
    slack = F.lit(_every_lane(7 - 2 * MAX_BITS)).cast("long")
    high = F.lit(_signed(((1 << 64) - 1) ^ _every_lane(7))).cast("long")
    return (lanes.bitwiseAND(high) == 0) & ((lanes + slack).bitwiseAND(high) == 0)


def _segment_masks() -> list[int]:
    masks, low = [], 0
    for bits in SEGMENT_BITS:
        masks.append(((1 << bits) - 1) << low)
        low += bits
    return masks


def block_masks() -> list[int]:
    """The bits that a block has in common, one mask for each choice of three segments."""
    kept = len(SEGMENT_BITS) - MAX_BITS
    return [sum(chosen) for chosen in combinations(_segment_masks(), kept)]


def _blocks(classes: DataFrame) -> DataFrame:
    ways = [
        F.struct(F.lit(k).alias("way"), F.col("fp").bitwiseAND(F.lit(_signed(mask)).cast("long")).alias("bits"))
        for k, mask in enumerate(block_masks())
    ]
    return classes.withColumn("block", F.explode(F.array(*ways))).select(
        "fp", "near0", "near1", "block.way", "block.bits"
    )


def _first_way(differing: Column) -> Column:
    """The first choice of segments in which two fingerprints agree; pairs are kept there only."""
    found = F.lit(None).cast("int")
    for k, mask in reversed(list(enumerate(block_masks()))):
        agree = differing.bitwiseAND(F.lit(_signed(mask)).cast("long")) == 0
        found = F.when(agree, F.lit(k)).otherwise(found)
    return found


def links(classes: DataFrame, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """Edges ``a, b`` between distinct fingerprints that connect all that link.

    ``classes`` has one row per distinct ``fp``. Pairs of small blocks are all
    linked pairs; in larger blocks the edges are linked pairs that reach the
    same fingerprints.
    """
    tabled = classes.select("fp", *distance_table(F.col("fp")))
    blocks = _blocks(tabled)
    sizes = blocks.groupBy("way", "bits").agg(F.count("*").alias("members")).filter("members > 1")
    shared = stored(blocks.join(sizes, ["way", "bits"]), "blocks")

    small = shared.filter(F.col("members") <= block_pairs)
    one, two = small.alias("one"), small.alias("two")
    same = (F.col("one.way") == F.col("two.way")) & (F.col("one.bits") == F.col("two.bits"))
    differing = F.col("one.fp").bitwiseXOR(F.col("two.fp"))
    pairs = (
        one.join(two, same & (F.col("one.fp") < F.col("two.fp")))
        .filter(within_table(F.col("one.near0"), F.col("two.near0")))
        .filter(within_table(F.col("one.near1"), F.col("two.near1")))
        .filter(F.bit_count(differing) <= MAX_BITS)
        .filter(_first_way(differing) == F.col("one.way"))
        .select(F.col("one.fp").alias("a"), F.col("two.fp").alias("b"))
    )

    crowded = shared.filter(F.col("members") > block_pairs).select("fp").distinct()
    flips = [F.lit(0).cast("long"), *(F.lit(_signed(1 << k)).cast("long") for k in range(64))]
    neighbours = crowded.select(
        "fp", F.explode(F.transform(F.array(*flips), lambda f: F.col("fp").bitwiseXOR(f))).alias("met")
    )
    least = neighbours.groupBy("met").agg(F.min("fp").alias("b"), F.count("*").alias("n")).filter("n > 1")
    meetings = neighbours.join(least, "met").filter("fp <> b").select(F.col("fp").alias("a"), "b")
    return pairs.unionByName(meetings)


def near_groups(docs: DataFrame, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text, A-Z lower-cased;
    shingles are three words, repeats included, or all words if there are
    fewer. Null, empty and blank texts have fingerprint zero and link like any
    other. ``component_id`` is the smallest doc_id that is reachable over links,
    the own one included; null ids are passed over unless there is no other.
    Repeated rows stay, an empty table gives no rows, and only ``doc_id`` and
    ``text`` are read.
    """
    found = stored(fingerprints(docs), "fingerprints")
    classes = stored(found.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    roots = connected_components(links(classes, block_pairs))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id")
    # the documents' side may have one fingerprint very often; it is the side that may be split
    return found.join(named, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
