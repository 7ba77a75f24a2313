"""Text plans on ``documents``,
``pages`` and ``conversations``, always over whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import text as X
from tessera.plans.common import spread, t
from tessera.plans.registry import plan

_WS = r"[\t\n\x0B\f\r ]"


def _docs(spark, sf):
    # Hash-partitioned by document: only the raw text is shuffled, and what
    # the operators group by document needs no further shuffle.  The number
    # of partitions is given, so that adaptive execution does not merge them
    # by the size of the text, of which each word becomes a record.
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return t(spark, sf, "documents").select("doc_id", "text").repartition(n, "doc_id")


@plan("document_word_count", "AGG-16 AGG-17", headline=True, sql=f"""
SELECT word, count(*) AS count
FROM (SELECT unnest(regexp_split_to_array(text, '{_WS}+')) AS word FROM documents)
WHERE word <> '' GROUP BY word ORDER BY count DESC, word""")
def document_word_count(spark, sf):
    return X.word_count(spread(t(spark, sf, "documents").select("text")), "text")


@plan("document_clean_word_count", "AGG-19 SCL-17", sql=f"""
SELECT word, count(*) AS count FROM (
  SELECT lower(regexp_replace(regexp_replace(tok, '[,.!?:;()%$''-]', '', 'g'), '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')) AS word
  FROM (SELECT unnest(regexp_split_to_array(text, '{_WS}')) AS tok FROM documents))
WHERE word <> '' GROUP BY word""")
def document_clean_word_count(spark, sf):
    return X.word_count(spread(t(spark, sf, "documents").select("text")), "text", clean=True)


@plan("conversation_word_count", "AGG-16", sql=f"""
SELECT word, count(*) AS count
FROM (SELECT unnest(regexp_split_to_array(text, '{_WS}+')) AS word FROM conversations)
WHERE word <> '' GROUP BY word""")
def conversation_word_count(spark, sf):
    return X.word_count(spread(t(spark, sf, "conversations").select("text")), "text")


@plan("word_document_frequency", "AGG-25", sql=f"""
SELECT word, count(DISTINCT doc_id) AS documents FROM (
  SELECT doc_id, lower(regexp_replace(regexp_replace(tok, '[,.!?:;()%$''-]', '', 'g'), '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')) AS word
  FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '{_WS}')) AS tok FROM documents))
WHERE word <> '' GROUP BY word""")
def word_document_frequency(spark, sf):
    return X.word_document_frequency(spread(t(spark, sf, "documents").select("doc_id", "text")), "doc_id", "text")


_HOST_SQL = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:@]*)', 1)"


@plan("page_words_per_host", "AGG-24 SCL-23", sql=f"""
SELECT host, sum(len(regexp_extract_all(regexp_replace(html, '<[^>]*>', ' ', 'g'), '[^\\t\\n\\x0B\\f\\r ]+')))::BIGINT AS words
FROM (SELECT {_HOST_SQL} AS host, html FROM pages) GROUP BY ROLLUP (host)""")
def page_words_per_host(spark, sf):
    p = spread(t(spark, sf, "pages").select("url", "html")).select(T.url_host("url").alias("host"), T.strip_tags("html").alias("body"))
    return X.words_per_group_with_total(p, "host", "body")


def _concordance_sql(word: str, strip: str) -> str:
    w = word.replace("'", "''")
    return f"""
WITH pg AS (SELECT doc_id, unnest(string_split_regex(text, '/p')) AS ptext,
                   unnest(range(1, len(string_split_regex(text, '/p')) + 1)) AS page FROM documents),
ln AS (SELECT doc_id, page, unnest(string_split(ptext, chr(10))) AS line,
              unnest(range(1, len(string_split(ptext, chr(10))) + 1)) AS line_no FROM pg),
ok AS (SELECT * FROM ln WHERE regexp_matches(regexp_replace(line, '{w}', '', 'g'), '^\\s*$')),
m AS (SELECT doc_id, page, line_no, unnest(regexp_extract_all(line, '\\s*{w}')) AS m,
             unnest(range(len(regexp_extract_all(line, '\\s*{w}')))) AS k FROM ok)
SELECT doc_id, page::INTEGER AS page, line_no::INTEGER AS line,
       (coalesce(sum(length(m)) OVER (PARTITION BY doc_id, page, line_no ORDER BY k
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
        + length(m) - length(ltrim(m, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) + 1)::INTEGER AS col,
       lower(regexp_replace(ltrim(m, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{strip}', '', 'g')) AS word
FROM m"""


@plan("document_concordance", "TXT-01 TXT-02", sql=_concordance_sql(X.WORD, X.STRIP_STRICT))
def document_concordance(spark, sf):
    return X.concordance(_docs(spark, sf), "doc_id", "text")


@plan("document_concordance_unicode", "TXT-01 TXT-02", sql=_concordance_sql(X.WORD_UNICODE, X.STRIP_STRICT))
def document_concordance_unicode(spark, sf):
    return X.concordance(_docs(spark, sf), "doc_id", "text", mode="unicode")


@plan("document_concordance_offsets", "TXT-04", sql=_concordance_sql(X.WORD, X.STRIP_RANGE))
def document_concordance_offsets(spark, sf):
    return X.concordance(_docs(spark, sf), "doc_id", "text", strip=X.STRIP_RANGE)


@plan("document_concordance_nested", "TXT-03", sql="""
WITH flat AS (""" + _concordance_sql(X.WORD, X.STRIP_STRICT) + """)
SELECT doc_id, to_json(list({'page': page, 'line': line, 'col': col, 'word': word} ORDER BY page, line, col, word))::VARCHAR
         AS entries
FROM flat GROUP BY doc_id""")
def document_concordance_nested(spark, sf):
    # JSON text of the nested entries keeps the result comparable across engines.
    nested = X.concordance_nested(X.concordance(_docs(spark, sf), "doc_id", "text", per_doc=True))
    return nested.select("doc_id", F.to_json("entries").alias("entries"))


@plan("document_word_value_counts", "AGG-18", sql=f"""
WITH w AS (SELECT doc_id, word, count(*) AS c
           FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '{_WS}+')) AS word FROM documents)
           WHERE word <> '' GROUP BY doc_id, word)
SELECT doc_id, to_json(map_from_entries(list({{'k': word, 'v': c}} ORDER BY word, c)))::VARCHAR AS counts
FROM w GROUP BY doc_id""")
def document_word_value_counts(spark, sf):
    m = X.word_value_counts(_docs(spark, sf), "doc_id", "text")
    return m.select("doc_id", F.to_json("counts").alias("counts"))
