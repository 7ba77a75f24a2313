import os

import pytest

from tessera import jobs as J
from tessera.operators import records as REC


def write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_rating_report(spark, tmp):
    # Literal ratings fixture of the reference's analyzer spec.
    p = write(os.path.join(tmp, "ratings.csv"), "movieId,rating\n1,4.0\n1,3.0\n2,2.0\n2,2.5\n2,3.0\n")
    out = J.rating_report(spark, p, os.path.join(tmp, "out"))
    per = {r.movieId: round(r.mean, 6) for r in out["per_movie"].collect()}
    assert per == {1: 3.5, 2: 2.5}
    assert round(out["overall"].first().mean, 6) == 2.9
    assert os.path.isdir(os.path.join(tmp, "out", "per_movie")) and os.path.isdir(os.path.join(tmp, "out", "overall"))


def test_word_count_job(spark, tmp):
    p = write(os.path.join(tmp, "wc.txt"), "Hello World\nHello World\nHello World\nHi\n")
    assert [(r.word, r["count"]) for r in J.word_count_job(spark, p).collect()] == [("hello", 3), ("world", 3), ("hi", 1)]


def test_movie_database_and_concordance(spark, tmp):
    header = ",".join(REC.MOVIE_COLUMNS)
    row = ["Color", "Ann Director", "1", "90", "1", "1", "B C", "1", "1", "Drama", "D E", "Film", "1", "1", "F G", "0",
           "k", "http://x", "1", "English", "New Zealand", "PG", "1", "2001", "1", "6.5", "1.85", "1"]
    bad = list(row)
    bad[21] = "PG-XX"
    p = write(os.path.join(tmp, "movies.csv"), "\n".join([header, ",".join(row), ",".join(bad)]) + "\n")
    out = J.movie_database(spark, p)
    assert out["movies"].count() == 1 and out["rejected"].count() == 1
    d = os.path.join(tmp, "docs")
    os.makedirs(d)
    write(os.path.join(d, "a.txt"), "Hello World!\nsecond line here")
    conc = J.concordance_job(spark, d).collect()
    assert sorted((r.line, r.col, r.word) for r in conc)[:2] == [(1, 1, "hello"), (1, 7, "world")]


def test_host_totals_and_classifiers(spark, tmp):
    pages = spark.createDataFrame([("http://a.com/x", "one two"), ("http://a.com/y", "three"), ("https://b.org/", "four five six")],
                                  "url string, text string")
    totals = {r.host: r.words for r in J.host_word_totals(spark, pages).collect()}
    assert totals == {"a.com": 3, "b.org": 3, None: 6}
    spam = write(os.path.join(tmp, "spam.txt"), "\n".join(["win cash now", "cheap pills win big", "win a prize now"] * 4))
    normal = write(os.path.join(tmp, "normal.txt"), "\n".join(["see you at lunch", "meeting notes attached", "lunch at noon"] * 4))
    pred = {r.text: r.prediction for r in J.spam_classifier(spark, spam, normal, ["win cash", "lunch notes"]).collect()}
    assert pred == {"win cash": 1.0, "lunch notes": 0.0}
    lines = []
    for i in range(150):
        c = i % 3
        lines.append(f"{c} 1:{c + 0.1 * (i % 5)} 2:{1.0 - c * 0.3} 3:{(i % 7) * 0.01} 4:{c * 2.0}")
    lib = write(os.path.join(tmp, "iris.libsvm"), "\n".join(lines) + "\n")
    assert 0.0 <= J.perceptron_job(spark, lib, [4, 5, 4, 3]) <= 1.0
