import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

LONG = " ".join(f"w{i % 977} x{i * 7919 % 10007}" for i in range(15_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null ids and texts, empty, white, very long and repeated rows, and
    columns whose names the operators might use inside."""
    rows = [(1, "the quick brown fox jumps over the lazy dog"), (2, None), (3, ""), (None, "no id here"), (4, " \n\t "),
            (5, LONG), (6, "The quick  brown\tfox\njumps over the lazy dog"), (6, "The quick  brown\tfox\njumps over the lazy dog"),
            (7, "same id, one text"), (7, "same id, another text"), (None, None), (8, "one"),
            (9, "password = 'abcdefghijkl' <|endoftext|> <|im_end|>")]
    names = "key k t n copy _id _h fp part rules m0 found r score lang source n_chars".split()
    return spark.createDataFrame([(i, t, *([i] * len(names))) for i, t in rows],
                                 "doc_id long, text string, " + ", ".join(f"{n} long" for n in names)
                                 ).withColumn("source", F.lit("src1")).withColumn(
        "lang", F.lit("en"))


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
