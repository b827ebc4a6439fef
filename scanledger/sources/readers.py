"""Readers of raw records and of the side tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanledger import schemas


#: Column of ``scan_raw_records(..., with_rejected=True)``: the line is no JSON object.
REJECTED = "_rejected"
#: Column of ``scan_raw_records(..., with_file=True)``: the file of the record.
SOURCE_FILE = "source_file"
_CORRUPT = "_corrupt_line"


def scan_raw_records(
    spark: SparkSession,
    path: str | list[str],
    array_lines_as_null: bool = False,
    with_rejected: bool = False,
    with_file: bool = False,
) -> DataFrame:
    """Raw scan records, one JSON object per line.

    Only the declared fields are parsed. A malformed line becomes a row of
    NULLs, a wrong value a NULL. Record size is not limited. Compressed files
    (.gz, .zst, ...) are read directly but not split, so deliver many files.

    A line that holds a JSON array of records is no record. The JSON source
    gives a row for each of its elements; with ``array_lines_as_null`` it is a
    malformed line as any other, but reading lines first and parsing them then
    takes about half as long again, so it is not the default. ``line_counts``
    shows if an export needs it.

    ``with_rejected`` adds ``REJECTED`` from the same parse: the parser hands
    over the text of lines in which it found a fault, and only these few are
    looked at again, because a fault may be one wrong value in an object.
    """
    schema = schemas.RAW_RECORD
    if with_rejected:
        schema = f"{schema}, {_CORRUPT} STRING"
    faults = {"columnNameOfCorruptRecord": _CORRUPT} if with_rejected else {}
    file = [F.col("_metadata.file_path").alias(SOURCE_FILE)] if with_file else []
    if array_lines_as_null:
        lines = record_lines(spark, path, *file)
        record = F.from_json("value", schema, faults).alias("record")
        records = lines.select(record, *lines.columns[1:]).select("record.*", *lines.columns[1:])
    else:
        records = spark.read.schema(schema).options(**faults).json(path)
        records = records.select("*", *file) if file else records
    if not with_rejected:
        return records
    rejected = F.when(F.col(_CORRUPT).isNotNull(), _is_rejected(F.col(_CORRUPT))).otherwise(False)
    return records.withColumn(REJECTED, rejected).drop(_CORRUPT)


def record_lines(spark: SparkSession, path: str | list[str], *added: Column) -> DataFrame:
    """The lines of an export that are not blank."""
    line = F.col("value")
    # most lines show by their first character that they aren't blank
    blank = F.left(line, F.lit(1)).isin("", " ", "\t") & (F.trim(line) == "")
    return spark.read.text(path).select("value", *added).filter(~blank)


def rejected_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The raw text of the lines that are no JSON object."""
    return record_lines(spark, path).filter(_is_rejected(F.col("value")))


def _is_rejected(line: Column) -> Column:
    parsed = F.from_json(
        line, "`_` STRING, _rejected STRING", {"columnNameOfCorruptRecord": "_rejected"}
    )
    return parsed["_rejected"].isNotNull()


def line_counts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines that are not blank, and those of them that are no JSON object, in one scan."""
    return record_lines(spark, path).agg(
        F.count("*").alias("raw_lines"), F.count_if(_is_rejected(F.col("value"))).alias("rejected_lines")
    )


def sample_raw(spark: SparkSession, path: str, out_dir: str, lines: int = 5000) -> DataFrame:
    """Copy ``lines`` raw lines, infer their schema and keep a Parquet sample.

    The cap is the purpose: a quick look at an unknown export.
    """
    spark.read.text(path).limit(lines).write.mode("overwrite").text(f"{out_dir}/json")
    inferred = spark.read.json(f"{out_dir}/json")
    inferred.write.mode("overwrite").parquet(f"{out_dir}/parquet")
    return spark.read.parquet(f"{out_dir}/parquet")


def sample_fields(sample: DataFrame) -> DataFrame:
    """Shape of a sample in long form: its fields and the number of rows."""
    names = F.explode(F.array(*[F.lit(n) for n in sorted(sample.columns)]))
    return sample.agg(F.count("*").alias("sampled_rows")).select(
        names.alias("field"), "sampled_rows"
    )


def scan_parquet(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


def scan_contacts(spark: SparkSession, path: str, order_column: str | None = None) -> DataFrame:
    """Contact records with their place in the file order.

    ``order_column`` (BIGINT, in the records) states the order where several
    files were written in parallel; without it the order within the files is
    used: path, then position in the file.
    """
    if order_column:
        return spark.read.schema(f"{schemas.CONTACT_RECORD}, {order_column} BIGINT").json(path)
    table = spark.read.schema(schemas.CONTACT_RECORD).json(path)
    return table.withColumn(
        "record_no",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ),
    )


def usable_emails(contacts: DataFrame, order_column: str = "record_no") -> DataFrame:
    """Company -> email; records without an email are skipped, the last one wins."""
    return (
        contacts.filter(F.col("contact.email") != "")
        .groupBy("company_key")
        .agg(F.max_by("contact.email", order_column).alias("email"))
    )


def scan_labeled_set(spark: SparkSession, path: str) -> DataFrame:
    """Labelled accounts; blank lines are skipped."""
    return spark.read.schema(schemas.LABELED_RECORD).json(path)


def scan_replies(spark: SparkSession, path: str) -> DataFrame:
    """Replies of an adjudicating model, one JSON record with the reply's text per account."""
    return spark.read.schema(schemas.REPLY_RECORD).json(path)


def scan_traces(spark: SparkSession, path: str, skill: str | None = None) -> DataFrame:
    """Call traces; an absent path gives an empty table."""
    try:
        traces = spark.read.schema(schemas.TRACE_RECORD).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        traces = spark.createDataFrame([], schemas.TRACE_RECORD)
    return traces if skill is None else traces.filter(F.col("skill") == skill)


def inline_table(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """A small typed table from literals; empty input keeps the schema."""
    return spark.createDataFrame(rows, schema)


def gold_view(accounts: DataFrame, adjudicated: DataFrame | None = None) -> DataFrame:
    """Adjudicated accounts, or the rule band as label while there are none."""
    if adjudicated is not None:
        return adjudicated
    return accounts.withColumns(
        {
            "final_label": F.col("band"),
            "rationale": F.lit(None).cast("string"),
            "confidence": F.lit(None).cast("string"),
        }
    )
