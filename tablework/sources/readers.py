"""Reading CSV, JSON, Excel and Parquet tables."""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.functions.semantics import nan_to_null
from tablework.operators.joins import merge
from tablework.operators.order import scratch_path

_FORMATS = {".csv": "csv", ".json": "json", ".parquet": "parquet", ".xlsx": "xlsx"}


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in whatever file system it names."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def _dated(df: DataFrame, date_columns) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string").try_cast("date") for c in date_columns if c in df.columns})


def read_csv(spark: SparkSession, path, schema=None, date_columns=()) -> DataFrame:
    """CSV with a header. With a schema there is no inference pass; listed columns become dates,
    with NULL where the text is no date."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return nan_to_null(_dated(reader.csv(path), date_columns))


def _one_record_per_line(spark: SparkSession, path) -> bool:
    """Whether the first line that is not blank is a whole JSON value."""
    head = spark.read.text(path).filter(F.length(F.trim("value")) > 0).first()
    try:
        json.loads(head["value"] if head else "[]")
    except ValueError:
        return False
    return True


def read_json(spark: SparkSession, path, schema=None, date_columns=(), lines: bool | None = None) -> DataFrame:
    """One record per line (which can be split over tasks), or one array of records per file.

    Without ``lines`` the first line decides: a line that is a whole value, be it a record or an
    array of records, means lines.
    """
    lines = _one_record_per_line(spark, path) if lines is None else lines
    reader = spark.read.option("multiLine", not lines)
    if schema is not None:
        reader = reader.schema(schema)
    return nan_to_null(_dated(reader.json(path), date_columns))


def read_typed(spark: SparkSession, path, schema: str | T.StructType) -> DataFrame:
    """Reload a written CSV with its types given."""
    return read_csv(spark, path, schema)


def read_many(spark: SparkSession, paths, fmt: str = "parquet", schema=None, **options) -> DataFrame:
    """Several files or folders as one table."""
    paths = list(paths)
    if not paths:
        raise ValueError("no paths given")
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(paths)


# Namespaces of the Office Open XML workbook format.
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def _sheet_rows(content: bytes) -> Iterator[list]:
    """Cell texts of the first sheet, row by row; the sheet is parsed as a stream."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names = set(book.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            for item in ElementTree.parse(book.open("xl/sharedStrings.xml")).getroot().iter(f"{_MAIN}si"):
                shared.append("".join(t.text or "" for t in item.iter(f"{_MAIN}t")))
        sheet = ElementTree.parse(book.open("xl/workbook.xml")).getroot().find(f"{_MAIN}sheets/{_MAIN}sheet")
        targets = {
            r.get("Id"): r.get("Target") for r in ElementTree.parse(book.open("xl/_rels/workbook.xml.rels")).getroot()
        }
        target = targets[sheet.get(f"{_REL}id")].lstrip("/")
        with book.open(target if target.startswith("xl/") else f"xl/{target}") as stream:
            for _, row in ElementTree.iterparse(stream):
                if row.tag != f"{_MAIN}row":
                    continue
                cells: list = []
                for cell in row.iter(f"{_MAIN}c"):
                    at = 0
                    for letter in re.match("[A-Z]+", cell.get("r")).group():
                        at = at * 26 + ord(letter) - 64
                    cells.extend([None] * (at - len(cells)))
                    value = cell.find(f"{_MAIN}v")
                    if cell.get("t") == "s":
                        cells[at - 1] = shared[int(value.text)]
                    elif cell.get("t") == "inlineStr":
                        cells[at - 1] = "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
                    elif value is not None:
                        cells[at - 1] = value.text
                yield cells
                row.clear()


def parse_workbooks(files: DataFrame, schema: str | T.StructType, date_columns=()) -> DataFrame:
    """Rows of the first sheet of every workbook in a ``content`` column, columns matched by header.

    Numbers in date columns count days from 1899-12-30; what does not fit its type is NULL.
    """
    types = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = types.fieldNames()
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])

    def parse(batches):
        for pdf in batches:
            for content in pdf["content"]:
                rows = _sheet_rows(bytes(content))
                header = next(rows, [])
                place = [header.index(n) if n in header else None for n in names]
                pending = []
                for cells in rows:
                    pending.append([cells[p] if p is not None and p < len(cells) else None for p in place])
                    if len(pending) == 10_000:
                        yield pd.DataFrame(pending, columns=names, dtype="object")
                        pending = []
                yield pd.DataFrame(pending, columns=names, dtype="object")

    raw = files.select("content").mapInPandas(parse, text)
    out = {}
    for f in types.fields:
        if f.name in date_columns:
            days = F.floor(F.col(f.name).try_cast("double")).try_cast("int")
            serial = F.date_add(F.lit("1899-12-30").cast("date"), days)
            # a bare number would also parse as a year
            out[f.name] = F.when(days.isNull(), F.col(f.name).try_cast("date")).otherwise(serial)
        elif isinstance(f.dataType, T.IntegralType):
            out[f.name] = F.col(f.name).try_cast("double").try_cast(f.dataType)
        else:
            out[f.name] = F.col(f.name).try_cast(f.dataType)
    return raw.withColumns(out)


def read_excel(spark: SparkSession, path, schema: str | T.StructType, date_columns=()) -> DataFrame:
    """First sheet of .xlsx workbooks; files spread over tasks, a sheet is read as a stream."""
    if str(path).lower().endswith(".xls"):
        raise ValueError("the binary .xls format is not supported; save as .xlsx")
    return parse_workbooks(spark.read.format("binaryFile").load(path), schema, date_columns)


def load_table(spark: SparkSession, path: str, schema=None, date_columns=()) -> DataFrame:
    """Read by file extension; a missing file and an unknown extension raise before any job."""
    suffix = "." + path.rstrip("/").rsplit(".", 1)[-1].lower() if "." in path else ""
    if not _exists(spark, path):
        raise FileNotFoundError(path)
    if suffix not in _FORMATS:
        raise ValueError(f"unsupported extension {suffix!r}; use one of {sorted(_FORMATS)}")
    kind = _FORMATS[suffix]
    if kind == "csv":
        return read_csv(spark, path, schema, date_columns)
    if kind == "json":
        return read_json(spark, path, schema, date_columns)
    if kind == "xlsx":
        if schema is None:
            raise ValueError("an .xlsx table needs a schema")
        return read_excel(spark, path, schema, date_columns)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return nan_to_null(reader.parquet(path))


def load_merged(facts: DataFrame, lookup: DataFrame, on) -> DataFrame:
    """Fact rows with their lookup columns; the optimiser broadcasts a lookup of known small size."""
    return merge(facts, lookup, on, "left")


class DatasetCatalog:
    """Named feature tables with their target column and task."""

    def __init__(self):
        self._entries: dict = {}

    def register(self, name: str, build, target: str, task: str) -> None:
        if task not in ("regression", "classification"):
            raise ValueError(f"unknown task {task!r}")
        self._entries[name.lower()] = (build, target, task)

    def _entry(self, name: str):
        key = name.lower() if isinstance(name, str) else name
        if key not in self._entries:
            raise ValueError(f"unknown dataset {name!r}; choose one of {sorted(self._entries)}")
        return self._entries[key]

    def task(self, name: str) -> str:
        return self._entry(name)[2]

    def load_xy(self, name: str) -> tuple[DataFrame, DataFrame]:
        """(features, target) with the target renamed ``target``; both come from one lazy plan."""
        build, target, _ = self._entry(name)
        table = build()
        return table.drop(target), table.select(F.col(target).alias("target"))

    def load(self, name: str) -> DataFrame:
        build, target, _ = self._entry(name)
        return build().withColumnRenamed(target, "target")


def inline_table(spark: SparkSession, data, schema=None) -> DataFrame:
    """Small table from a dict of columns, a list of records, a dict of labelled values or rows."""
    if isinstance(data, dict) and data and all(isinstance(v, (list, tuple)) for v in data.values()):
        if len({len(v) for v in data.values()}) > 1:
            raise ValueError("columns have different lengths")
        return spark.createDataFrame(list(zip(*data.values())), schema or list(data))
    if isinstance(data, dict):
        return spark.createDataFrame(list(data.items()), schema or ["label", "value"])
    if data and isinstance(data[0], dict):
        names = list(dict.fromkeys(k for row in data for k in row))
        return spark.createDataFrame([tuple(row.get(n) for n in names) for row in data], schema or names)
    return spark.createDataFrame(data, schema)


def materialize_once(spark: SparkSession, path: str | None, build) -> DataFrame:
    """Compute and write on first use; read ever after."""
    path = path or scratch_path(spark, "once")
    if not _exists(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
