"""Machine-learning, generator and output plans.

Stand-ins: passenger table -> ``customer JOIN orders`` (label: order status
``F``); spam mails -> ``documents JOIN labels`` (label: toxic); LibSVM
sample -> ``embeddings`` (64 dimensions, 10 classes).
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql.functions import unwrap_udt

from tessera.functions.numeric import fround
from tessera.operators import generate as GN
from tessera.operators import ml as M
from tessera.plans.common import t
from tessera.plans.registry import plan
from tessera.sources import sinks as K
from tessera.sources.files import schema_frame

# Price split points for the bucketiser.
PRICE_SPLITS = [float("-inf"), 50000.0, 100000.0, 200000.0, 300000.0, float("inf")]


@plan("order_price_buckets", "ML-03", sql="""
SELECT o_orderkey, (CASE WHEN o_totalprice < 50000 THEN 0 WHEN o_totalprice < 100000 THEN 1 WHEN o_totalprice < 200000 THEN 2
                         WHEN o_totalprice < 300000 THEN 3 ELSE 4 END)::DOUBLE AS bucket FROM orders""")
def order_price_buckets(spark, sf):
    b = M.bucketizer("o_totalprice", PRICE_SPLITS, "bucket")
    return b.transform(t(spark, sf, "orders").select("o_orderkey", "o_totalprice")).select("o_orderkey", "bucket")


def _split_sql(key: str, percent: int) -> str:
    """SQL for the training side of ``hash_split``."""
    return f"('0x' || substr(md5('1234:' || {key}::VARCHAR), 1, 8))::BIGINT % 100 < {percent}"


def _draw_sql(seed: int, key: str) -> str:
    return f"(('0x' || substr(md5('{seed}:' || {key}::VARCHAR), 1, 13))::BIGINT / 4503599627370496.0)"


@plan("customer_hash_split", "ML-06", sql=f"""
SELECT c_custkey, CASE WHEN {_split_sql('c_custkey', 60)} THEN 'train' ELSE 'test' END AS split FROM customer""")
def customer_hash_split(spark, sf):
    c = t(spark, sf, "customer").select("c_custkey")
    train, test = M.hash_split(c, "c_custkey", 60)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@plan("customer_balance_imputed", "ML-01", sql=f"""
WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 10 <> 3 THEN c_acctbal END AS c_acctbal FROM customer)
SELECT c_custkey, round(coalesce(c_acctbal, (SELECT avg(c_acctbal) FROM c WHERE {_split_sql('c_custkey', 60)})), 6) AS c_acctbal
FROM c WHERE NOT ({_split_sql('c_custkey', 60)})""")
def customer_balance_imputed(spark, sf):
    # A tenth of the balances is taken away, to be filled in again.
    c = t(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 10 != 3, F.col("c_acctbal")).alias("c_acctbal"))
    train, test = M.hash_split(c, "c_custkey", 60)
    model = M.mean_imputer(train, ["c_acctbal"])  # fitted on the training split only
    return model.transform(test).select("c_custkey", fround(F.col("c_acctbal"), 6).alias("c_acctbal"))


def _passengers(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice",
                                      (F.col("o_orderstatus") == "F").cast("double").alias("label"))
    c = t(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return o.join(c, o.o_custkey == c.c_custkey)


def _forest(spark, sf, trees=100, depth=6):
    train, test = M.hash_split(_passengers(spark, sf), "o_orderkey", 80)
    pipe = M.forest_pipeline(["c_mktsegment", "o_orderpriority"], ["o_orderpriority"], ["c_acctbal", "o_totalprice"],
                             "label", trees=trees, depth=depth)
    return pipe.fit(train), test


@plan("order_status_forest", "ML-07 ML-09")
def order_status_forest(spark, sf):
    model, test = _forest(spark, sf)
    return model.transform(test).select("o_orderkey", "prediction")


@plan("order_status_forest_auc", "ML-08")
def order_status_forest_auc(spark, sf):
    model, test = _forest(spark, sf)
    auc = M.area_under_roc(model.transform(test), "label")
    return spark.createDataFrame([(float(auc),)], "auc double")


@plan("toxic_text_predictions", "ML-10 ML-11 SET-01")
def toxic_text_predictions(spark, sf):
    d = t(spark, sf, "documents").select("doc_id", "text")
    lab = t(spark, sf, "labels").select("doc_id", F.col("toxic").cast("double").alias("label"))
    train = d.join(lab, "doc_id").cache()  # fitted with several passes
    model = M.text_classifier("text", "label").fit(train)
    out = model.transform(d).select("doc_id", "prediction")
    return out


@plan("embedding_mlp_precision", "ML-12 ML-13")
def embedding_mlp_precision(spark, sf):
    e = t(spark, sf, "embeddings").select("vec_id", M.as_vector("embedding").alias("features"),
                                          F.col("label").cast("double").alias("label"))
    train, test = M.hash_split(e, "vec_id", 60)
    model = M.mlp([64, 32, 10]).fit(train)
    precision = M.weighted_precision(model.transform(test), "label")
    return spark.createDataFrame([(float(precision),)], "precision double")


def _report(train, test, metric, beats_constant):
    """One row on a fitted model, from its scored splits: their sizes, the test
    rows with a prediction, whether its metric is one, and whether it does
    better on its own training rows than any constant answer."""
    both = train.select(F.lit(True).alias("train"), "prediction").unionByName(
        test.select(F.lit(False).alias("train"), "prediction"))
    return both.agg(
        F.count_if("train").alias("n_train"), F.count_if(~F.col("train")).alias("n_test"),
        F.count_if(~F.col("train") & F.col("prediction").isNotNull()).alias("n_scored")).select(
        "*", F.lit(metric is not None and 0 <= metric <= 1).alias("metric_in_range"),
        F.lit(bool(beats_constant)).alias("beats_constant"))


def _beats_majority(scored, label):
    """More rows right than the largest class has: no constant prediction is."""
    counts = M.confusion(scored, label)
    right = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))
    of = counts.groupBy("label").agg(right.alias("right"), F.sum("n").alias("n"))
    got = of.agg(F.sum("right").alias("right"), F.max("n").alias("largest")).first()
    return (got["right"] or 0) > (got["largest"] or 0)


@plan("order_status_forest_report", "ML-07 ML-09", sql=f"""
WITH p AS (SELECT {_split_sql('o_orderkey', 80)} AS train FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT count(*) FILTER (WHERE train) AS n_train, count(*) FILTER (WHERE NOT train) AS n_test,
       count(*) FILTER (WHERE NOT train) AS n_scored, true AS metric_in_range, true AS beats_constant FROM p""")
def order_status_forest_report(spark, sf):
    # A constant score has an area of exactly one half.
    train, _ = M.hash_split(_passengers(spark, sf), "o_orderkey", 80)
    model, test = _forest(spark, sf, trees=100)
    fitted, scored = model.transform(train), model.transform(test)
    return _report(fitted, scored, M.area_under_roc(scored, "label"), M.area_under_roc(fitted, "label") > 0.5)


@plan("order_feature_vectors", "ML-02 ML-04 ML-05", sql=f"""
WITH p AS (SELECT o_orderkey, c_mktsegment, o_orderpriority, c_acctbal, o_totalprice, {_split_sql('o_orderkey', 80)} AS train
           FROM orders JOIN customer ON o_custkey = c_custkey),
s AS (SELECT c_mktsegment, row_number() OVER (ORDER BY n DESC, c_mktsegment) - 1 AS i
      FROM (SELECT c_mktsegment, count(*) AS n FROM p WHERE train GROUP BY c_mktsegment)),
r AS (SELECT o_orderpriority, row_number() OVER (ORDER BY n DESC, o_orderpriority) - 1 AS i
      FROM (SELECT o_orderpriority, count(*) AS n FROM p WHERE train GROUP BY o_orderpriority)),
v AS (SELECT o_orderkey, list_concat(
          list_transform(range(0, (SELECT count(*) - 1 FROM r)), lambda k: CASE WHEN k = r.i THEN 1.0 ELSE 0.0 END::DOUBLE),
          [s.i::DOUBLE, c_acctbal, o_totalprice]) AS f
      FROM p JOIN s USING (c_mktsegment) JOIN r USING (o_orderpriority) WHERE NOT train)
SELECT o_orderkey, (k - 1)::INTEGER AS place, round(f[k], 4) AS value
FROM (SELECT o_orderkey, f, unnest(range(1, len(f) + 1)) AS k FROM v)""")
def order_feature_vectors(spark, sf):
    # Indexes and one-hot codes are fitted on the training split and applied to the test split.
    train, test = M.hash_split(_passengers(spark, sf), "o_orderkey", 80)
    stages = M.feature_stages(["c_mktsegment", "o_orderpriority"], ["o_orderpriority"], ["c_acctbal", "o_totalprice"])
    made = Pipeline(stages=stages).fit(train).transform(test)
    return made.select("o_orderkey", F.posexplode(vector_to_array("features")).alias("place", "value")).select(
        "o_orderkey", "place", fround(F.col("value"), 4).alias("value"))


@plan("order_price_auc", "ML-08", sql="""
WITH s AS (SELECT (o_orderstatus = 'F')::INT AS y, rank() OVER (ORDER BY o_totalprice)
                  + (count(*) OVER (PARTITION BY o_totalprice) - 1) / 2.0 AS r FROM orders WHERE o_totalprice IS NOT NULL)
SELECT round((sum(r * y) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y))), 9)::DOUBLE AS auc FROM s""")
def order_price_auc(spark, sf):
    # How well the price alone ranks finished orders, by the exact curve.
    o = t(spark, sf, "orders").where("o_totalprice IS NOT NULL").select(
        (F.col("o_orderstatus") == "F").cast("double").alias("label"), F.col("o_totalprice").alias("score"))
    return spark.range(1).select(fround(F.lit(M.area_under_roc(o, "label", "score", bins=0)), 9).alias("auc"))


@plan("embedding_largest_component_precision", "ML-13", sql="""
WITH p AS (SELECT label, list_position(embedding[1:10], list_max(embedding[1:10])) - 1 AS pred FROM embeddings),
c AS (SELECT pred, count(*) FILTER (WHERE pred = label) / count(*)::DOUBLE AS precision FROM p GROUP BY pred),
n AS (SELECT label, count(*) AS n FROM p GROUP BY label)
SELECT round(sum(n * coalesce(precision, 0)) / sum(n), 9) AS precision FROM n LEFT JOIN c ON label = pred""")
def embedding_largest_component_precision(spark, sf):
    # A fixed rule in place of a model: the class is the place of the largest of the first ten components.
    head = F.slice("embedding", 1, 10)
    p = t(spark, sf, "embeddings").select(F.col("label").cast("double").alias("label"),
                                          (F.array_position(head, F.array_max(head)) - 1).cast("double").alias("prediction"))
    return spark.range(1).select(fround(F.lit(M.weighted_precision(p, "label")), 9).alias("precision"))


@plan("document_term_frequencies", "ML-10", sql="""
WITH w AS (SELECT doc_id, string_split(coalesce(text, ''), ' ') AS words FROM documents)
SELECT doc_id, len(words)::DOUBLE AS n_words, true AS buckets_possible FROM w""")
def document_term_frequencies(spark, sf):
    # The hash is Spark's own; what any engine can say is that frequencies sum to the
    # words, and that no more buckets are in use than there are different words.
    d = t(spark, sf, "documents").select("doc_id", "text")
    words, tf = M.term_frequencies("text")
    made = tf.transform(words.transform(d))
    values = F.col("tf.values")
    different = F.size(F.array_distinct("_words"))
    return made.select("doc_id", "_words", unwrap_udt("features").alias("tf")).select(
        "doc_id", F.aggregate(values, F.lit(0.0), lambda a, x: a + x).alias("n_words"),
        F.size(values).between(1, F.least(different, F.lit(M.TF_BUCKETS))).alias("buckets_possible"))


@plan("toxic_text_report", "ML-11", sql="""
SELECT (SELECT count(*) FROM documents JOIN labels USING (doc_id)) AS n_train, (SELECT count(*) FROM documents) AS n_test,
       (SELECT count(*) FROM documents) AS n_scored, true AS metric_in_range, true AS beats_constant""")
def toxic_text_report(spark, sf):
    lab = t(spark, sf, "labels").select("doc_id", F.col("toxic").cast("double").alias("label"))
    scored = toxic_text_predictions(spark, sf)
    labelled = scored.join(lab, "doc_id")
    right = labelled.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    return _report(labelled, scored, right, _beats_majority(labelled, "label"))


@plan("embedding_mlp_report", "ML-12", sql=f"""
SELECT count(*) FILTER (WHERE train) AS n_train, count(*) FILTER (WHERE NOT train) AS n_test,
       count(*) FILTER (WHERE NOT train) AS n_scored, true AS metric_in_range, true AS beats_constant
FROM (SELECT {_split_sql('vec_id', 60)} AS train FROM embeddings)""")
def embedding_mlp_report(spark, sf):
    e = t(spark, sf, "embeddings").select("vec_id", M.as_vector("embedding").alias("features"),
                                          F.col("label").cast("double").alias("label"))
    train, test = M.hash_split(e, "vec_id", 60)
    model = M.mlp([64, 32, 10]).fit(train)
    fitted, scored = model.transform(train), model.transform(test)
    return _report(fitted, scored, M.weighted_precision(scored, "label"), _beats_majority(fitted, "label"))


@plan("order_uniform_draws", "GEN-01", sql=f"SELECT o_orderkey, {_draw_sql(42, 'o_orderkey')} AS u FROM orders")
def order_uniform_draws(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", GN.uniform(42, "o_orderkey").alias("u"))


@plan("order_gaussian_draws", "GEN-02", sql=f"""
SELECT o_orderkey, round(CASE WHEN u <= 0 THEN 0 ELSE sqrt(-2 * ln(u)) * cos(2 * pi() * v) END, 6) AS z
FROM (SELECT o_orderkey, {_draw_sql(42, 'o_orderkey')} AS u, {_draw_sql(43, 'o_orderkey')} AS v FROM orders)""")
def order_gaussian_draws(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", fround(GN.gaussian(42, "o_orderkey"), 6).alias("z"))


@plan("supplier_html_report", "SNK-03", sql="""
SELECT 0::BIGINT AS pos, chr(10) || '<html>' || chr(10) || '<head>' || chr(10) || '<title>Suppliers</title></head>' || chr(10)
       || '<body>' || chr(10) || '<table border="1">' || chr(10) || '<tr>' || chr(10) || '<th>s_suppkey</th>' || chr(10)
       || '<th>s_name</th>' || chr(10) || '<th>s_nationkey</th></tr>' AS html
UNION ALL
SELECT row_number() OVER (ORDER BY s_suppkey), chr(10) || '<tr>' || chr(10) || '<td>' || s_suppkey::VARCHAR || '</td>' || chr(10)
       || '<td>' || replace(s_name, chr(160), '&#160') || '</td>' || chr(10) || '<td>' || s_nationkey::VARCHAR || '</td></tr>'
FROM supplier
UNION ALL SELECT count(*) + 1, '</table></body></html>' FROM supplier""")
def supplier_html_report(spark, sf):
    s = t(spark, sf, "supplier")
    return K.html_fragments(s, ["s_suppkey", "s_name", "s_nationkey"], ["s_suppkey"], "Suppliers")


@plan("orders_schema", "SRC-02")
def orders_schema(spark, sf):
    return schema_frame(t(spark, sf, "orders"))


@plan("order_xml_rows", "SNK-04")
def order_xml_rows(spark, sf):
    return K.to_xml_text(t(spark, sf, "orders"), ["o_orderkey", "o_orderstatus", "o_orderpriority"], "order")
