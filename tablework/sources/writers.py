"""Writing tables, reports and JSON; every task writes its own part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def two_decimals(column: str) -> Column:
    return F.format_string("%.2f", F.col(column).cast("double"))


def write_csv(df: DataFrame, path: str, fixed_decimals: bool = False, mode: str = "errorifexists") -> None:
    """CSV with a header; with ``fixed_decimals`` every float gets two decimals."""
    if fixed_decimals:
        df = df.withColumns({
            f.name: F.when(F.col(f.name).isNotNull(), two_decimals(f.name))
            for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        })
    df.write.mode(mode).option("header", True).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON record per line, native types."""
    df.write.mode(mode).json(path)


def write_report(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Text lines ``(line_no, line)`` in order, range-partitioned so that parts are in line order."""
    lines.repartitionByRange("line_no").sortWithinPartitions("line_no").select("line").write.mode(mode).text(path)
