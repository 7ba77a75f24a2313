"""File sources.

All readers are ``spark.read`` calls with explicit options; prefer passing a
schema (inference costs an extra pass over the input and is unstable).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, header: bool = True,
             infer: bool = False, sep: str = ",", quote: str = '"', escape: str = '"', encoding: str = "UTF-8",
             multiline: bool = False, mode: str = "PERMISSIVE", corrupt_column: str | None = None) -> DataFrame:
    """CSV with header, delimiter, quote and doubled-quote escape (SRC-01,
    SRC-09, SRC-10).  ``corrupt_column`` keeps malformed lines (SRC-07);
    it must be part of ``schema`` as a string field."""
    r = (spark.read.option("header", header).option("sep", sep).option("quote", quote).option("escape", escape)
         .option("encoding", encoding).option("multiLine", multiline).option("mode", mode))
    if corrupt_column:
        r = r.option("columnNameOfCorruptRecord", corrupt_column)
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    return r.csv(path)


def read_csv_lines(spark: SparkSession, path: str | Sequence[str], sep: str = ",") -> DataFrame:
    """Lines of one or several paths split on the delimiter into an array,
    header kept as data (SRC-08)."""
    paths = path if isinstance(path, str) else list(path)
    return spark.read.text(paths).select(F.split("value", sep).alias("fields"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line (SRC-03)."""
    return spark.read.text(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: (path, text) (SRC-04)."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """LibSVM (label, features) (SRC-05)."""
    r = spark.read.format("libsvm")
    if num_features:
        r = r.option("numFeatures", num_features)
    return r.load(path)


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Rows by element name; attributes appear as ``_name`` fields (SRC-11)."""
    r = spark.read.format("xml").option("rowTag", row_tag)
    return (r.schema(schema) if schema is not None else r).load(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
              multiline: bool = False) -> DataFrame:
    """JSON documents -> typed rows (SRC-12)."""
    r = spark.read.option("multiLine", multiline)
    return (r.schema(schema) if schema is not None else r).json(path)


def read_paginated(spark: SparkSession, path: str, items: str = "items", schema=None,
                   keep: Sequence[str] = (), multiline: bool = True) -> DataFrame:
    """Landed offset/limit pages -> one row per item (SRC-13); the pages are
    read in parallel and exploded, no HTTP in the job.  A page is a file, or
    with ``multiline=False`` a line, so that a file holds many and can be
    split.  ``keep`` names fields of the page to carry to its items."""
    pages = read_json(spark, path, schema, multiline=multiline)
    return pages.select(F.input_file_name().alias("page"), *keep, F.posexplode(items).alias("item_pos", "item")).select(
        "page", *keep, "item_pos", "item.*")


def counter(spark: SparkSession, start: int, stop: int, step: int = 1) -> DataFrame:
    """Bounded arithmetic sequence ``start, start+step, ... < stop`` (SRC-15)."""
    return spark.range(start, stop, step).withColumnRenamed("id", "n")


def schema_frame(df: DataFrame) -> DataFrame:
    """The schema as a two-column frame (name, type) (SRC-02)."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "name string, type string")


def preview(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First ``n`` rows in a total order (SRC-02 ``show``)."""
    return df.orderBy(*order).limit(n)
