"""Repeated ingest of a growing export: each source file is read once.

The ledger is a table of the files that each batch read, known by address, size
and time of change. A run reads what the ledger does not have, writes it as a
partition of its own and then commits the files to the ledger, as the last
step: a run that fails leaves a partition that nothing refers to. A file that
changed is read again and its earlier rows don't count any more; the same holds
for a file that is gone, if asked for. Nothing is rewritten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanledger.operators.ingest import flatten_hosts
from scanledger.plans.build import host_figures
from scanledger.schemas import HOST_BATCHES, HOST_COLUMNS, LEDGER, LEDGER_RECORD
from scanledger.sources.readers import REJECTED, SOURCE_FILE, scan_raw_records
from scanledger.sources.writers import (
    COUNTS, keep_counts, layer_exists, observed_write, write_parquet_zstd,
)

_FILE = (SOURCE_FILE, "source_path", "size_bytes", "mtime_ms")
#: What makes a listed file the same as one that was read.
_SAME = (SOURCE_FILE, "size_bytes", "mtime_ms")


def source_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The files of an export as they are now; contents are not read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.col("path").alias("source_path"),
        F.col("length").alias("size_bytes"),
        F.unix_millis("modificationTime").alias("mtime_ms"),
    )


def read_ledger(spark: SparkSession, out_dir: str) -> DataFrame:
    """Every file of every committed batch; no rows before the first."""
    path = f"{out_dir}/{LEDGER}"
    if not layer_exists(spark, path):
        return spark.createDataFrame([], LEDGER_RECORD)
    return spark.read.schema(LEDGER_RECORD).parquet(path)


def newest_entries(ledger: DataFrame) -> DataFrame:
    """The last entry of each file; ``removed`` if the file was gone then."""
    fields = [c for c in ledger.columns if c != SOURCE_FILE]
    newest = ledger.groupBy(SOURCE_FILE).agg(F.max_by(F.struct(*fields), "batch").alias("entry"))
    return newest.select(SOURCE_FILE, "entry.*")


def pending_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files that are new, or not as they were when they were read."""
    known = newest_entries(ledger).filter(~F.col("removed"))
    return files.join(known.select(*_SAME), list(_SAME), "left_anti").select(*_FILE)


def missing_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files that were read and are not listed any more."""
    known = newest_entries(ledger).filter(~F.col("removed"))
    return known.join(files.select(SOURCE_FILE), SOURCE_FILE, "left_anti").select(*_FILE)


def outdated_entries(ledger: DataFrame) -> DataFrame:
    """``batch, source_file`` of rows that later entries of their file replace or withdraw."""
    newest = newest_entries(ledger).filter(~F.col("removed")).select("batch", SOURCE_FILE)
    read = ledger.filter(~F.col("removed")).select("batch", SOURCE_FILE)
    return read.join(newest, ["batch", SOURCE_FILE], "left_anti")


def _next_batch(spark: SparkSession, out_dir: str, ledger: DataFrame) -> int:
    """A number that neither a committed batch has nor one that failed before its commit."""
    numbers = [ledger.agg(F.max("batch")).first()[0] or 0]
    if layer_exists(spark, f"{out_dir}/{HOST_BATCHES}"):
        written = spark.read.parquet(f"{out_dir}/{HOST_BATCHES}")
        numbers.append(written.agg(F.max("batch")).first()[0] or 0)
    return 1 + max(numbers)


def ingest_new(
    spark: SparkSession,
    raw_path: str | list[str],
    out_dir: str,
    withdraw_missing: bool = False,
    array_lines_as_null: bool = False,
) -> int | None:
    """Read the files that the ledger does not have, as one batch; its number, or None.

    ``withdraw_missing`` takes the listed files as the whole export, so rows
    of files that are gone don't count any more. The driver sees the names of
    the pending files, as it does in any scan of them.
    """
    ledger = read_ledger(spark, out_dir)
    files = source_files(spark, raw_path)
    pending = pending_files(files, ledger).collect()
    gone = missing_files(files, ledger).collect() if withdraw_missing else []
    if not pending and not gone:
        return None
    batch = _next_batch(spark, out_dir, ledger)
    if pending:
        paths = [row.source_path for row in pending]
        raw = scan_raw_records(spark, paths, array_lines_as_null, with_rejected=True, with_file=True)
        hosts = flatten_hosts(raw, SOURCE_FILE, REJECTED).withColumn("batch", F.lit(batch).cast("bigint"))
        counts = observed_write(
            hosts, f"{out_dir}/{HOST_BATCHES}", host_figures(), partition_by="batch", rebalance=True,
            hidden=(REJECTED,),
        )
        keep_counts(spark, out_dir, {f"{HOST_BATCHES}/{batch}": counts})
    entries = [(*row, removed, batch) for rows, removed in ((pending, False), (gone, True)) for row in rows]
    committed = spark.createDataFrame(entries, LEDGER_RECORD)
    write_parquet_zstd(committed.coalesce(1), f"{out_dir}/{LEDGER}", partition_by="batch")
    return batch


def current_hosts(spark: SparkSession, out_dir: str) -> DataFrame:
    """The rows of all files as they were last read.

    Partitions of batches that were never committed aren't read. The rows to
    leave out are named by the few outdated entries, so the hosts aren't
    shuffled unless very many files were replaced.
    """
    ledger = read_ledger(spark, out_dir)
    committed = [row.batch for row in ledger.select("batch").distinct().collect()]
    if not layer_exists(spark, f"{out_dir}/{HOST_BATCHES}"):
        raise ValueError(f"no batch was ingested into {out_dir}")
    rows = spark.read.parquet(f"{out_dir}/{HOST_BATCHES}").filter(F.col("batch").isin(*committed))
    kept = rows.join(outdated_entries(ledger), ["batch", SOURCE_FILE], "left_anti")
    return kept.select(*HOST_COLUMNS)


def batch_summary(spark: SparkSession, out_dir: str) -> DataFrame:
    """Per batch: files read, withdrawn and still valid, and the rows written."""
    ledger = read_ledger(spark, out_dir)
    outdated = outdated_entries(ledger).groupBy("batch").agg(F.count("*").alias("outdated"))
    counts = spark.read.parquet(f"{out_dir}/{COUNTS}").select(
        F.regexp_extract("layer", rf"^{HOST_BATCHES}/(\d+)$", 1).try_cast("bigint").alias("batch"),
        F.col("counts")["rows"].alias("rows"),
    )
    files = ledger.groupBy("batch").agg(
        F.count_if(~F.col("removed")).alias("files"), F.count_if("removed").alias("withdrawn")
    )
    return (
        files.join(outdated, "batch", "left")
        .join(counts, "batch", "left")
        .select(
            "batch", "files", "withdrawn", (F.col("files") - F.coalesce("outdated", F.lit(0))).alias("valid"),
            F.coalesce("rows", F.lit(0)).alias("rows"),
        )
    )
