"""Source/sink round trips over the driver tables.

Each plan writes a table (or a result Spark derives from one) in a file
format into the cluster's shared checkpoint folder, reads it back with the
library's reader and returns the typed rows, so the oracle is plain SQL on
the original table.  Files go to a fresh sub-folder per call.
"""

from __future__ import annotations

import uuid

from pyspark.ml.linalg import VectorUDT  # noqa: F401  (libsvm vectors)
from pyspark.sql import functions as F

from tessera.functions.numeric import fround
from tessera.operators.ml import as_vector
from tessera.operators import ordered as O
from tessera.operators import policies as P
from tessera.operators import records as REC
from tessera.plans.common import t
from tessera.plans.registry import plan
from tessera.session import checkpoint_dir
from tessera.sources import files as IO
from tessera.sources import sinks as K


def _scratch(spark, what: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/io-{what}-{uuid.uuid4().hex}"


_ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"


@plan("orders_csv_roundtrip", "SRC-01 SNK-01 SRC-09", sql="""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""")
def orders_csv_roundtrip(spark, sf):
    path = _scratch(spark, "csv")
    o = t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                                      "o_orderpriority")
    K.write_csv(o, path, header=True, sep="|")
    return IO.read_csv(spark, path, _ORDERS, header=True, sep="|")


@plan("orders_csv_inferred", "SRC-01", sql="""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders""")
def orders_csv_inferred(spark, sf):
    path = _scratch(spark, "inferred")
    K.write_csv(t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), path, header=True)
    got = IO.read_csv(spark, path, infer=True)  # types come from the data
    return got.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), F.col("o_custkey").cast("bigint").alias("o_custkey"),
                      "o_orderstatus", F.col("o_totalprice").cast("double").alias("o_totalprice"))


@plan("part_csv_quoted", "SRC-09", sql="""
SELECT p_partkey, 'the "' || p_name || '", size ' || p_size::VARCHAR || ',"' AS label FROM part""")
def part_csv_quoted(spark, sf):
    # Labels hold the delimiter, quotes and a quote at the end.
    path = _scratch(spark, "quoted")
    label = F.concat(F.lit('the "'), "p_name", F.lit('", size '), F.col("p_size").cast("string"), F.lit(',"'))
    K.write_csv(t(spark, sf, "part").select("p_partkey", label.alias("label")), path, header=True)
    return IO.read_csv(spark, path, "p_partkey bigint, label string")


@plan("part_movie_records", "SRC-06", sql="""
SELECT p_name || ', part ' || p_partkey::VARCHAR AS title, CASE WHEN p_size % 2 = 0 THEN 'PG' ELSE 'R' END AS code,
       CASE WHEN p_size % 2 = 0 THEN 13 END AS age, p_partkey::INTEGER AS budget, 2::INTEGER AS n_genres, 'Q.' AS middle
FROM part WHERE p_size % 7 <> 0""")
def part_movie_records(spark, sf):
    # Parts in the movie layout, through a CSV file of strings into nested
    # records; rows whose rating cannot be read are dropped.
    path = _scratch(spark, "movies")
    rating = F.when(F.col("p_size") % 7 == 0, "PG-XX").when(F.col("p_size") % 2 == 0, "PG-13").otherwise("R")
    given = {"color": F.lit("Color"), "director_name": F.lit("Jane Q. Director"), "genres": F.lit("Drama|Comedy|"),
             "movie_title": F.concat("p_name", F.lit(", part "), F.col("p_partkey").cast("string")),
             "content_rating": rating, "budget": F.col("p_partkey").cast("string"), "language": F.lit("English")}
    K.write_csv(t(spark, sf, "part").select(*[given.get(c, F.lit(None).cast("string")).alias(c) for c in REC.MOVIE_COLUMNS]), path)
    raw = IO.read_csv(spark, path, ", ".join(f"{c} string" for c in REC.MOVIE_COLUMNS))
    ok, _ = P.forgiving(REC.movie_records(raw))
    return ok.select("title", "reviews.content_rating.code", "reviews.content_rating.age", "production.budget",
                     F.size("genres").alias("n_genres"), F.col("director.name.middle").alias("middle"))


@plan("part_name_line_words", "SRC-03", sql="""
SELECT word, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) GROUP BY word""")
def part_name_line_words(spark, sf):
    path = _scratch(spark, "lines")
    t(spark, sf, "part").select("p_name").write.text(path)
    words = IO.read_lines(spark, path).select(F.explode(F.split("value", " ")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@plan("nation_customer_files", "SRC-04", sql="""
SELECT c_nationkey::BIGINT AS c_nationkey, count(*) AS n_names, sum(length(c_name) + 1)::BIGINT AS n_chars
FROM customer GROUP BY c_nationkey""")
def nation_customer_files(spark, sf):
    # One folder of whole files for each nation, a name a line.
    path = _scratch(spark, "whole")
    t(spark, sf, "customer").select("c_nationkey", "c_name").write.partitionBy("c_nationkey").text(path)
    files = IO.read_documents(spark, path)
    nation = F.regexp_extract("path", r"c_nationkey=(\d+)/", 1).cast("bigint")
    return files.groupBy(nation.alias("c_nationkey")).agg(
        F.sum(F.size(F.split("text", "\n")) - 1).alias("n_names"), F.sum(F.length("text")).cast("bigint").alias("n_chars"))


@plan("supplier_csv_fields", "SRC-08", sql="""
SELECT s_suppkey::VARCHAR AS f0, s_name AS f1, 2::INTEGER AS n_fields FROM supplier UNION ALL SELECT 's_suppkey', 's_name', 2""")
def supplier_csv_fields(spark, sf):
    # The header is a file of its own beside the part files, which every task writes.
    head, body = _scratch(spark, "fields-header"), _scratch(spark, "fields")
    s = t(spark, sf, "supplier").select("s_suppkey", "s_name")
    K.write_csv(s.limit(0), head, header=True)
    K.write_csv(s, body, header=False)
    return IO.read_csv_lines(spark, [head, body]).select(
        F.col("fields")[0].alias("f0"), F.col("fields")[1].alias("f1"), F.size("fields").alias("n_fields"))


@plan("priority_counts_single_file", "SNK-02", sql="""
SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority""")
def priority_counts_single_file(spark, sf):
    # One file is for small final results: here the aggregated report.
    path = _scratch(spark, "single")
    rep = t(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    K.write_single_csv(rep, path)
    return IO.read_csv(spark, path, "o_orderpriority string, n bigint")


@plan("orders_csv_corrupt_rows", "SRC-07 ERR-02", sql="""
SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS price,
       o_orderstatus = 'P' AS corrupt FROM orders""")
def orders_csv_corrupt_rows(spark, sf):
    # Pending orders are written with an unreadable price; the permissive
    # reader keeps them with the raw line in the corrupt-record column.
    path = _scratch(spark, "corrupt")
    o = t(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")).alias("price"))
    K.write_csv(o, path, header=True)
    back = IO.read_csv(spark, path, "k bigint, price double, _corrupt string", corrupt_column="_corrupt")
    return back.select("k", "price", F.col("_corrupt").isNotNull().alias("corrupt"))


@plan("supplier_tsv_utf16", "SRC-10", sql="SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def supplier_tsv_utf16(spark, sf):
    path = _scratch(spark, "tsv16")
    s = t(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    s.write.mode("overwrite").option("header", True).option("sep", "\t").option("encoding", "UTF-16").csv(path)
    return IO.read_csv(spark, path, "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
                       sep="\t", encoding="UTF-16", multiline=True)


@plan("nation_xml_roundtrip", "SRC-11 SNK-04", sql="""
SELECT n_nationkey AS _key, n_name AS name, n_regionkey AS region FROM nation""")
def nation_xml_roundtrip(spark, sf):
    # A leading underscore makes a field an XML attribute: <nation key="..">.
    path = _scratch(spark, "xml")
    n = t(spark, sf, "nation").select(F.col("n_nationkey").alias("_key"), F.col("n_name").alias("name"),
                                      F.col("n_regionkey").alias("region"))
    n.write.mode("overwrite").format("xml").option("rowTag", "nation").option("rootTag", "nations").save(path)
    return IO.read_xml(spark, path, "nation", "_key int, name string, region int")


@plan("orders_json_lines_roundtrip", "SRC-12", sql="""
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders""")
def orders_json_lines_roundtrip(spark, sf):
    path = _scratch(spark, "json")
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    o.write.mode("overwrite").json(path)
    return IO.read_json(spark, path, "o_orderkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string")


@plan("order_item_pages", "SRC-13", sql="""
SELECT l_orderkey AS page, l_partkey AS partkey, l_quantity AS quantity FROM lineitem""")
def order_item_pages(spark, sf):
    # Each order is landed as one page {"page": .., "items": [...]}; the
    # reader explodes the items back to rows in parallel.
    path = _scratch(spark, "pages")
    pages = t(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("page")).agg(
        F.collect_list(F.struct(F.col("l_partkey").alias("partkey"), F.col("l_quantity").alias("quantity"))).alias("items"))
    pages.write.mode("overwrite").json(path)
    back = IO.read_json(spark, path, "page bigint, items array<struct<partkey: bigint, quantity: double>>")
    return back.select("page", F.inline("items"))


@plan("lineitem_offset_pages", "SRC-13", sql="""
SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity) - 1 AS pos, l_orderkey AS orderkey,
       l_partkey AS partkey, l_quantity AS quantity FROM lineitem""")
def lineitem_offset_pages(spark, sf):
    # The whole table is one collection, landed in pages of 100 items {"offset": .., "limit": 100, "items": [..]};
    # a page's offset and the place of an item in it give back the place in the collection.
    path, limit = _scratch(spark, "offset-pages"), 100
    rows = O.global_row_number(t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"),
                               ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"], "pos", start=0)
    item = F.struct("pos", F.col("l_orderkey").alias("orderkey"), F.col("l_partkey").alias("partkey"),
                    F.col("l_quantity").alias("quantity"))
    pages = rows.groupBy((F.col("pos") - F.col("pos") % limit).alias("offset")).agg(F.sort_array(F.collect_list(item)).alias("items"))
    pages.select("offset", F.lit(limit).alias("limit"), F.transform("items", lambda x: x.dropFields("pos")).alias("items")
                 ).write.mode("overwrite").json(path)
    back = IO.read_paginated(spark, path, schema="offset bigint, items array<struct<orderkey: bigint, partkey: bigint, quantity: double>>",
                             keep=["offset"], multiline=False)
    return back.select((F.col("offset") + F.col("item_pos")).alias("pos"), "orderkey", "partkey", "quantity")


@plan("embedding_libsvm_roundtrip", "SRC-05", sql="""
SELECT vec_id, label::DOUBLE AS label, len(list_filter(embedding, lambda x: x <> 0))::BIGINT AS active,
       round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 4) AS total
FROM embeddings""")
def embedding_libsvm_roundtrip(spark, sf):
    # LibSVM rows carry only (label, features): the row id is written as the
    # label, and the true label is joined back after reading.
    path = _scratch(spark, "libsvm")
    e = t(spark, sf, "embeddings").select("vec_id", F.col("label").cast("double").alias("label"),
                                          as_vector("embedding").alias("features"))
    e.select(F.col("vec_id").cast("double").alias("label"), "features").write.mode("overwrite").format("libsvm").save(path)
    back = IO.read_libsvm(spark, path, 64)
    from pyspark.ml.functions import vector_to_array
    arr = vector_to_array("features")
    got = back.select(F.col("label").cast("bigint").alias("vec_id"),
                      F.size(F.filter(arr, lambda x: x != 0)).cast("bigint").alias("active"),
                      fround(F.aggregate(arr, F.lit(0.0), lambda a, x: a + x), 4).alias("total"))
    labels = t(spark, sf, "embeddings").select("vec_id", F.col("label").cast("double").alias("label"))
    return got.join(labels, "vec_id").select("vec_id", "label", "active", "total")
