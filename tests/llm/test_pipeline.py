import inspect

from pyspark.sql import functions as F

import corpus_pipeline as P
from conftest import SF_SMALL
from tessera.llm import mixing, quality_rules, secret_scan, simhash
from tessera.llm.queries import QUERIES, SQL, WEIGHTS


def test_stages_against_plain_versions(spark, tmp):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    read, columns = docs, docs.columns
    seen = {}
    for name, stage in P.STAGES:
        out = stage(spark, read, SF_SMALL)
        out.write.parquet(f"{tmp}/{name}")
        seen[name] = (read, spark.read.parquet(f"{tmp}/{name}"))
        read = seen[name][1]
        if name != P.STAGES[-1][0]:
            assert read.columns == columns
    before, after = seen["quality_rules"]
    kept = {r.doc_id for r in quality_rules.judge(before, quality_rules.fit(docs, labels)).where("kept").collect()}
    assert {r.doc_id for r in after.collect()} == kept
    before, after = seen["simhash_near_dedup"]
    reps = {r.component_id for r in simhash.components(before).collect()}
    assert sorted(r.doc_id for r in after.collect()) == sorted(reps)
    before, after = seen["secret_scans"]
    assert before.count() == after.count()
    assert all(not r.found for r in secret_scan.scan(after).collect())
    clean = {r.doc_id for r in secret_scan.scan(before).collect() if not r.found}
    texts = {r.doc_id: r.text for r in before.collect()}
    assert all(r.text == texts[r.doc_id] for r in after.collect() if r.doc_id in clean)
    before, after = seen["mixing"]
    rates = mixing.repetition_rates(before, WEIGHTS)
    want = mixing.replicate(before, rates).groupBy("doc_id").count().collect()
    assert {tuple(r) for r in want} == {tuple(r) for r in after.groupBy("doc_id").count().collect()}
    before, after = seen["best_fit_packing"]
    assert after.where("piece = 0").count() == before.count()


def test_run_and_registration(spark):
    assert [n for n, _ in P.STAGES] == ["quality_rules", "simhash_near_dedup", "secret_scans", "mixing", "best_fit_packing"]
    assert all(len(inspect.signature(f).parameters) == 3 for _, f in P.STAGES)
    assert P.run(spark, SF_SMALL).count() > 0
    assert {f"op{i}" for i in range(1, 14)} == {n.split("_")[0] for n in QUERIES} and SQL.keys() <= QUERIES.keys()


def test_stages_keep_columns_called_like_their_own(spark):
    names = "__key __spans __changed __q_n_words __Q_words copy shuffle_key SHUFFLE_KEY_ _t fp".split()
    secret = "password = 'abcdefghijkl' "
    words = " ".join(f"word{i}" for i in range(40))
    docs = spark.createDataFrame(
        [(1, words, *range(10)), (2, secret + words[::-1], *range(10, 20)), (3, words, *range(20, 30))],
        "doc_id long, text string, " + ", ".join(f"{n} long" for n in names)).withColumn("source", F.lit("web"))
    want = {r.doc_id: tuple(r)[2:] for r in docs.collect()}

    def own(df, ids):
        assert df.columns[:len(docs.columns)] == docs.columns
        got = df.collect()
        assert {r.doc_id for r in got} == ids and all(tuple(r)[2:len(docs.columns)] == want[r.doc_id] for r in got)
        return got

    own(quality_rules.keep(docs, []), {1, 2, 3})
    own(simhash.deduplicate(docs), {1, 2})
    got = {r.doc_id: r.text for r in own(secret_scan.redact(docs), {1, 2, 3})}
    assert got[1] == words and got[2].startswith("[SECRET]")
    mixed = mixing.replicate(docs, {"web": 50.0})
    assert mixed.columns[len(docs.columns):] == ["copy_", "shuffle_key__"]
    assert all([r["copy_"] for r in rows] == list(range(len(rows))) for rows in (
        sorted((r for r in own(mixed, {1, 2, 3}) if r.doc_id == i), key=lambda r: r["copy_"]) for i in (1, 2, 3)))
    own(mixing.mix(docs, {"web": 1.0}, total=10 ** 6), {1, 2, 3})


def test_rows_that_differ_by_the_place_of_a_null(spark):
    # A hash that passes over nulls gives both rows of an id one value.
    docs = spark.createDataFrame([(1, "a b c d e", None), (1, None, "a b c d e"), (2, None, None)],
                                 "doc_id long, text string, lang string")
    got = simhash.deduplicate(docs).collect()
    assert sorted((r.doc_id, r.text is None) for r in got) == [(1, False), (1, True)]
