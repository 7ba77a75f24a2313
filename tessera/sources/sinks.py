"""Sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",", mode: str = "overwrite") -> None:
    """CSV with header and delimiter (SNK-01), quotes doubled inside quoted
    fields as the reader expects; one part file per partition."""
    df.write.mode(mode).option("header", header).option("sep", sep).option("escape", '"').csv(path)


def write_single_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",") -> None:
    """Single-file overwrite (SNK-02).  ``repartition(1)`` funnels the write
    through one task: meant for small, final results only."""
    write_csv(df.repartition(1), path, header, sep, "overwrite")


def _cell(tag: str, value: Column) -> Column:
    text = F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), "\u00a0", "&#160")
    return F.concat(F.lit(f"\n<{tag}>"), text, F.lit(f"</{tag}>"))


def html_fragments(df: DataFrame, columns: Sequence[str], order: Sequence, title: str) -> DataFrame:
    """HTML table report as ordered text fragments (pos, html) (SNK-03):
    pos 0 is the preamble and header row, 1..n the data rows in ``order``,
    n+1 the closing tags.  Header cells are ``th``, data cells ``td``, and a
    non-breaking space becomes ``&#160``.  Concatenating the fragments by
    ``pos`` gives the document; rows are rendered in parallel."""
    from tessera.operators.ordered import global_row_number

    spark = df.sparkSession
    row = F.concat(F.lit("\n<tr>"), *[_cell("td", F.col(c)) for c in columns], F.lit("</tr>"))
    body = global_row_number(df.select(*columns, *[o for o in order if isinstance(o, str) and o not in columns]),
                             order, "pos").select("pos", row.alias("html"))
    header = "".join(f"\n<th>{c}</th>" for c in columns)
    head = (f'\n<html>\n<head>\n<title>{title}</title></head>\n<body>\n<table border="1">\n<tr>{header}</tr>')
    n = body.agg(F.coalesce(F.max("pos"), F.lit(0)).alias("n"))
    tail = n.select((F.col("n") + 1).alias("pos"), F.lit("</table></body></html>").alias("html"))
    return spark.createDataFrame([(0, head)], "pos bigint, html string").unionByName(body).unionByName(tail)


def render(fragments: DataFrame) -> DataFrame:
    """Fragments in order as text lines; write with ``.write.text`` after a
    ``repartition(1)`` only for small reports."""
    return fragments.orderBy("pos").select("html")


def to_xml_text(df: DataFrame, columns: Sequence[str], row_tag: str = "row") -> DataFrame:
    """Each row as XML text (SNK-04)."""
    return df.select(F.to_xml(F.struct(*columns), {"rowTag": row_tag}).alias("xml"))
