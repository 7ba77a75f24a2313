"""End-to-end jobs mirroring the reference's runnable programs.

Each job reads files, composes the library's operators and returns
DataFrames (writing them too when an output path is given).  They are what
a user of the reference runs today, re-expressed as distributed jobs: no
step parses, groups or counts on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import aggregate as A
from tessera.operators import ml as M
from tessera.operators import policies as P
from tessera.operators import records as REC
from tessera.operators import text as X
from tessera.sources import files as IO
from tessera.sources import sinks as K


def rating_report(spark: SparkSession, ratings_csv: str, out_dir: str | None = None,
                  movie: str = "movieId", rating: str = "rating") -> dict[str, DataFrame]:
    """Per-movie mean and sample deviation plus the global pair, from a
    headered ratings CSV; optionally written as CSV (one folder each)."""
    df = IO.read_csv(spark, ratings_csv, f"{movie} int, {rating} double")
    per_movie = A.mean_stddev(df, movie, rating)
    overall = A.mean_stddev(df, None, rating)
    if out_dir:
        K.write_csv(per_movie, f"{out_dir}/per_movie")
        K.write_single_csv(overall, f"{out_dir}/overall")
    return {"per_movie": per_movie, "overall": overall}


def word_count_job(spark: SparkSession, path: str, clean: bool = True, top: int | None = 20) -> DataFrame:
    """Word counts of text files, most frequent first (the top ``top`` when given)."""
    counts = X.word_count(IO.read_lines(spark, path).withColumnRenamed("value", "text"), "text", clean=clean)
    return counts.limit(top) if top else counts


def movie_database(spark: SparkSession, csv_path: str) -> dict[str, DataFrame]:
    """Typed nested movie records from the 28-column movie metadata CSV,
    forgiving: parsed rows and the quarantined ones with their reason."""
    schema = ", ".join(f"{c} string" for c in REC.MOVIE_COLUMNS)
    recs = REC.movie_records(IO.read_csv(spark, csv_path, schema))
    ok, bad = P.forgiving(recs)
    return {"movies": ok, "rejected": bad}


def concordance_job(spark: SparkSession, path: str, mode: str = "strict") -> DataFrame:
    """Positional word index (file, page, line, col, word) of whole text files."""
    docs = IO.read_documents(spark, path).withColumnRenamed("path", "doc")
    return X.concordance(docs, "doc", "text", mode=mode)


def host_word_totals(spark: SparkSession, pages: DataFrame, url: str = "url", text: str = "text") -> DataFrame:
    """Words per server host and the grand total (null host), the two chained
    map-reduce jobs of the reference as one rollup."""
    from tessera.functions.text import url_host

    return X.words_per_group_with_total(pages.select(url_host(url).alias("host"), F.col(text)), "host", text)


def spam_classifier(spark: SparkSession, spam_path: str, normal_path: str, texts: list[str]) -> DataFrame:
    """Hashed term frequencies + logistic regression trained on two text
    files (one mail per line; spam = 1, normal = 0), then predictions for
    ``texts``."""
    spam = IO.read_lines(spark, spam_path).select(F.col("value").alias("text"), F.lit(1.0).alias("label"))
    normal = IO.read_lines(spark, normal_path).select(F.col("value").alias("text"), F.lit(0.0).alias("label"))
    train = spam.unionByName(normal).cache()
    model = M.text_classifier("text", "label").fit(train)
    probe = spark.createDataFrame([(x,) for x in texts], "text string")
    return model.transform(probe).select("text", "prediction")


def perceptron_job(spark: SparkSession, libsvm_path: str, layers: list[int], train_percent: int = 60,
                   seed: int = 1234) -> float:
    """Multilayer perceptron on a LibSVM file with a stable hash split;
    returns the weighted precision on the held-out rows."""
    from pyspark.ml.functions import vector_to_array

    # Split on a hash of the row's content: deterministic however the file
    # is split into tasks, and identical on every re-read.
    df = IO.read_libsvm(spark, libsvm_path, layers[0])
    df = df.withColumn("_id", F.xxhash64("label", vector_to_array("features")))
    train, test = M.hash_split(df, "_id", train_percent, seed)
    model = M.mlp(layers, seed=seed).fit(train)
    return M.weighted_precision(model.transform(test), "label")
