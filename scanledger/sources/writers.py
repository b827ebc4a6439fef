"""Writers of tables, JSON lines, evaluation reports and the source manifest."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from scanledger import config, schemas


def write_parquet_zstd(
    table: DataFrame,
    path: str,
    partition_by: str | None = None,
    mode: str = "overwrite",
    rebalance: bool = False,
    observation: Observation | None = None,
    figures: Mapping[str, Column] | None = None,
    hidden: tuple[str, ...] = (),
) -> DataFrame:
    """Write a ZSTD Parquet table and return it as read back.

    ``observation`` takes the ``figures`` (aggregates by name) of the rows as
    they are written. They are observed in the stage that writes, behind all
    shuffles: Spark counts each partition of that stage once, however often its
    tasks or the stages before it run. ``hidden`` columns serve the figures
    only and aren't written.

    ``rebalance`` is for a table much smaller than the input it was computed
    from: its rows are shuffled into files of the advisory partition size, so
    that the tasks before may be as many as the input has splits.

    Reading back cuts the lineage: a lost executor costs the running stage,
    not the whole chain. With a partition column only the partitions present
    in ``table`` are replaced.
    """
    rows = table.hint("rebalance") if rebalance else table
    if observation is not None:
        rows = rows.observe(observation, *[figure.alias(name) for name, figure in figures.items()])
    rows = rows.drop(*hidden)
    writer = rows.write.mode(mode).option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return table.sparkSession.read.parquet(path)


def write_jsonl(table: DataFrame, path: str, append: bool = False, **options: str) -> None:
    """One JSON object per line; NULL fields are written, not dropped."""
    mode = "append" if append else "overwrite"
    table.write.mode(mode).options(ignoreNullFields="false", **options).json(path)


SNAPSHOT = "snapshot_date"
#: Folder of the counts that were observed while layers were written.
COUNTS = "layer_counts"


def write_layer(table: DataFrame, path: str, snapshot_date: str | None = None, **options) -> DataFrame:
    """Write a layer, as one partition if it belongs to a dated export; returns that export's rows."""
    if snapshot_date is None:
        return write_parquet_zstd(table, path, **options)
    dated = table.withColumn(SNAPSHOT, F.lit(snapshot_date).cast("date"))
    written = write_parquet_zstd(dated, path, partition_by=SNAPSHOT, **options)
    return one_snapshot(written, snapshot_date)


def one_snapshot(table: DataFrame, snapshot_date: str) -> DataFrame:
    """The rows of one export; the filter on the partition column reads only its files."""
    return table.filter(F.col(SNAPSHOT) == F.lit(snapshot_date).cast("date")).drop(SNAPSHOT)


def latest_snapshot(spark: SparkSession, path: str) -> str | None:
    """The last date of a layer; None if it is not dated. Only partition values are read."""
    table = spark.read.parquet(path)
    if SNAPSHOT not in table.columns:
        return None
    return table.agg(F.max(SNAPSHOT).cast("string")).first()[0]


def read_layer(spark: SparkSession, path: str, snapshot_date: str | None = None) -> DataFrame:
    """A layer as of one export, or the whole of a layer that is not dated."""
    table = spark.read.parquet(path)
    if SNAPSHOT not in table.columns:
        return table
    if snapshot_date is None:
        raise ValueError(f"{path} has dated exports: name one of them")
    return one_snapshot(table, snapshot_date)


def layer_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def observed_write(table: DataFrame, path: str, figures: Mapping[str, Column], **options) -> dict[str, int]:
    """Write a table; returns the figures of the rows as they were written."""
    observation = Observation()
    write_parquet_zstd(table, path, observation=observation, figures=figures, **options)
    return {name: int(n or 0) for name, n in observation.get.items()}


def observed_layer(
    table: DataFrame,
    out_dir: str,
    layer: str,
    figures: Mapping[str, Column],
    snapshot_date: str | None = None,
    held: dict[str, dict[str, int]] | None = None,
    **options,
) -> DataFrame:
    """Write a layer and keep the figures observed meanwhile, one row per layer and date.

    With ``held`` they are put there instead, to be kept with those of other layers.
    """
    observation = Observation()
    written = write_layer(
        table, f"{out_dir}/{layer}", snapshot_date, observation=observation, figures=figures, **options
    )
    counts = {layer: {name: int(n or 0) for name, n in observation.get.items()}}
    if held is None:
        keep_counts(table.sparkSession, out_dir, counts, snapshot_date)
    else:
        held.update(counts)
    return written


def keep_counts(
    spark: SparkSession, out_dir: str, counts: Mapping[str, Mapping[str, int]], snapshot_date: str | None = None
) -> None:
    """Replace the counts of these layers and this date."""
    rows = [(layer, dict(own)) for layer, own in counts.items()]
    kept = spark.createDataFrame(rows, "layer STRING, counts MAP<STRING, BIGINT>")
    kept = kept.withColumn(SNAPSHOT, F.lit(snapshot_date).cast("date"))
    (
        kept.coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(SNAPSHOT, "layer")
        .parquet(f"{out_dir}/{COUNTS}")
    )


def read_counts(spark: SparkSession, out_dir: str, snapshot_date: str | None = None) -> DataFrame:
    """``layer, counts`` of one date, or of a build without a date."""
    schema = f"counts MAP<STRING, BIGINT>, {SNAPSHOT} DATE, layer STRING"
    kept = spark.read.schema(schema).parquet(f"{out_dir}/{COUNTS}")
    return kept.filter(F.col(SNAPSHOT).eqNullSafe(F.lit(snapshot_date).cast("date"))).select("layer", "counts")


def write_eval_report(report: DataFrame, path: str) -> None:
    """Keep a run with the reports; repeating it replaces its own entry only."""
    (
        report.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", "false")
        .partitionBy("prompt_version", "run_no")
        .json(path)
    )


def read_eval_reports(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.EVAL_REPORT).json(path)


def source_manifest(
    spark: SparkSession,
    path: str | list[str],
    average_record_bytes: int = config.AVERAGE_RECORD_BYTES,
) -> DataFrame:
    """Identity of the source files; contents are not read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(
        F.col("path").alias("source_path"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("mtime"),
        F.floor(F.col("length") / F.lit(float(average_record_bytes))).alias("estimated_row_count"),
        F.lit("json_lines").alias("format"),
        F.current_timestamp().alias("recorded_at"),
    )


def manifest_summary(
    manifest: DataFrame, average_record_bytes: int = config.AVERAGE_RECORD_BYTES
) -> DataFrame:
    """The manifest of a whole export that was delivered as several files."""
    size = F.sum("size_bytes")
    return manifest.groupBy("format").agg(
        size.alias("size_bytes"),
        F.floor(size / F.lit(float(average_record_bytes))).alias("estimated_row_count"),
    )


def exact_row_count(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the source, for when the estimate is not good enough."""
    return spark.read.text(path).agg(F.count("*").alias("row_count"))
