"""Distinct counts that add up over dates, from mergeable sketches."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanledger import config

#: Two to this many registers; a sketch takes about half as many bytes.
LOG_REGISTERS = 14
#: Relative standard error of the estimate of a union.
STANDARD_ERROR = 1.04 / math.sqrt(1 << LOG_REGISTERS)


def distinct_sketches(
    table: DataFrame, columns: Sequence[str] = config.DISTINCT_COLUMNS, log_registers: int = LOG_REGISTERS
) -> DataFrame:
    """``column_name, sketch``: one sketch per column of its values that are not null.

    Sketches are combined before the shuffle, which carries one per column and
    task. Store them as a layer of the export's date.
    """
    sketches = [F.hll_sketch_agg(F.col(c).cast("string"), log_registers).alias(c) for c in columns]
    one_row = table.agg(*sketches)
    return one_row.unpivot([], list(columns), "column_name", "sketch")


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """``column_name, estimate`` over all given sketches of a column, of one or of many dates."""
    merged = sketches.groupBy("column_name").agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("column_name", F.hll_sketch_estimate("sketch").alias("estimate"))
