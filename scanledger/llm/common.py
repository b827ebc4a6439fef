"""Helpers that the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanledger.session import scratch_dir

#: White space of the word rule ``[^\x20\x09-\x0D]+``; bytes.split() and strip() use the same.
ASCII_SPACE = b" \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def stored(table: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    This cuts lineage: what reads it again, or loses an executor, starts from
    the files and not from the texts.
    """
    folder = scratch_dir(table.sparkSession, purpose)
    table.write.option("compression", "zstd").parquet(folder)
    return table.sparkSession.read.schema(table.schema).parquet(folder)


def schema_of(docs: DataFrame, more: str, without: tuple[str, ...] = ()) -> T.StructType:
    """The columns of a table, without some, and further ones given as DDL."""
    kept = [T.StructField(f.name, f.dataType) for f in docs.schema if f.name not in without]
    return T.StructType(kept + T.StructType.fromDDL(more).fields)


def set_aside(
    docs: DataFrame, names: tuple[str, ...], work: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Do work that adds columns of these names; the table's own are put back, the added ones go."""
    held = {c: f"__own_{c}" for c in docs.columns if c.lower() in names}
    done = work(docs.withColumnsRenamed(held))
    return done.select(*(F.col(f"`{held.get(c, c)}`").alias(c) for c in docs.columns))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def utf8(text: str | None) -> bytes:
    """Null counts as an empty text."""
    return text.encode("utf-8", "surrogatepass") if text else b""


def texts_of(batch: pa.RecordBatch, column: str = "text") -> Iterator[bytes]:
    """The texts of a batch as UTF-8, without decoding them."""
    for text in batch.column(column).cast(pa.large_binary()):
        yield text.as_py() or b""


def in_slices(parts: Iterable[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Batches in pieces of a few rows, which bound what a task makes of whole texts at once."""
    for part in parts:
        for first in range(0, part.num_rows, rows):
            yield part.slice(first, rows)


def batches(
    rows: Iterable[tuple], schema: pa.Schema, size: int = 4096
) -> Iterator[pa.RecordBatch]:
    """Tuples as record batches of bounded size."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
