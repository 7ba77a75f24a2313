"""Graph and hierarchy plans: the link graph of ``pages`` and
the ``region -> nation -> customer`` tree."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import graph as G
from tessera.plans.common import t
from tessera.plans.registry import plan

_SCHEME = "regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)"
_AUTH = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)"
_FN = G.FILE_NAME.replace("'", "''")

# Every href in the driver pages is root-relative ("/word"), which resolves
# to scheme://authority/word; the oracle spells out that rule only.
_LINKS_SQL = f"""hr AS (SELECT page_id, url AS src, unnest(regexp_extract_all(html, '<a[^>]+href="([^"]*)"', 1)) AS href,
                   unnest(range(len(regexp_extract_all(html, '<a[^>]+href="([^"]*)"', 1)))) AS pos,
                   {_SCHEME} AS scheme, {_AUTH} AS auth FROM pages),
rs AS (SELECT page_id, src, pos, href, scheme || '://' || auth || href AS dst FROM hr),
pp AS (SELECT *, regexp_extract(dst, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path FROM rs),
links AS (SELECT page_id, src, pos, href, dst FROM pp
          WHERE lower(regexp_extract(dst, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) IN ('http', 'https')
            AND (NOT regexp_matches(path, '{_FN}') OR regexp_extract(path, '{_FN}', 3) = ''
                 OR regexp_extract(path, '{_FN}', 4) IN ('html', 'htm')))"""


def _links(spark, sf):
    return G.extract_links(t(spark, sf, "pages"))


@plan("page_links", "GR-05 JN-12 FIL-09", sql=f"WITH {_LINKS_SQL} SELECT page_id, pos::INTEGER AS pos, href, dst FROM links")
def page_links(spark, sf):
    return _links(spark, sf).select("page_id", "pos", "href", "dst")


@plan("page_link_validity", "FIL-09", sql=f"""
WITH {_LINKS_SQL.split(',links AS')[0].rstrip().rstrip(',')}
SELECT lower(regexp_extract(dst, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) IN ('http', 'https') AS protocol_ok,
       (NOT regexp_matches(path, '{_FN}') OR regexp_extract(path, '{_FN}', 3) = ''
        OR regexp_extract(path, '{_FN}', 4) IN ('html', 'htm')) AS can_parse, count(*) AS n
FROM pp GROUP BY 1, 2""")
def page_link_validity(spark, sf):
    allx = G.extract_links(t(spark, sf, "pages"), valid_only=False)
    return allx.groupBy(G.valid_protocol("dst").alias("protocol_ok"), G.can_parse("dst").alias("can_parse")).agg(
        F.count(F.lit(1)).alias("n"))


@plan("page_dot_links", "JN-12", sql="""
SELECT page_id, '../' || repeat('./../', (page_id % 3)::INTEGER) || 'x/../p' || page_id::VARCHAR || '.html?u=/../v' AS href,
       regexp_extract(url, '^([a-z]+://[^/?#]*)', 1)
         || CASE WHEN page_id % 3 = 0 AND len(dirs) > 1 THEN '/' || array_to_string(dirs[1:len(dirs) - 1], '/') ELSE '' END
         || CASE WHEN page_id % 3 = 1 AND len(dirs) > 2 THEN '/' || array_to_string(dirs[1:len(dirs) - 2], '/') ELSE '' END
         || CASE WHEN page_id % 3 = 2 AND len(dirs) > 3 THEN '/' || array_to_string(dirs[1:len(dirs) - 3], '/') ELSE '' END
         || '/p' || page_id::VARCHAR || '.html?u=/../v' AS dst
FROM (SELECT page_id, url, list_filter(string_split(regexp_replace(
        regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '[^/]*$', ''), '/'), lambda d: d <> '') AS dirs FROM pages)""")
def page_dot_links(spark, sf):
    # Links with dot segments, up to three folders above each page's own.
    p = t(spark, sf, "pages")
    k, name = (F.col("page_id") % 3).cast("int"), F.col("page_id").cast("string")
    href = F.concat(F.lit("../"), F.repeat(F.lit("./../"), k), F.lit("x/../p"), name, F.lit(".html?u=/../v"))
    return p.select("page_id", href.alias("href"), G.resolve_url(F.col("url"), href).alias("dst"))


# Attributes for vertices only known as edge endpoints.
DEFAULT_VERTEX = {"name": "unknown", "role": "missing"}


def _page_graph(spark, sf):
    p = t(spark, sf, "pages")
    vertices = p.select(F.col("url").alias("id"), F.regexp_extract("url", G.AUTHORITY, 1).alias("name"),
                        F.lit("page").alias("role"))
    edges = _links(spark, sf).select("src", "dst").distinct().withColumn("attr", F.lit("links_to"))
    return vertices, edges


@plan("page_graph_vertices", "GR-01", sql=f"""
WITH {_LINKS_SQL},
v AS (SELECT url AS id, {_AUTH} AS name, 'page' AS role FROM pages),
e AS (SELECT src AS id FROM links UNION SELECT dst FROM links)
SELECT id, name, role FROM v
UNION ALL SELECT id, 'unknown', 'missing' FROM e WHERE id NOT IN (SELECT id FROM v)""")
def page_graph_vertices(spark, sf):
    v, e = _page_graph(spark, sf)
    return G.graph_vertices(v, e, DEFAULT_VERTEX)


@plan("page_graph_triplets", "GR-02 JN-04", sql=f"""
WITH {_LINKS_SQL},
v AS (SELECT url AS id, {_AUTH} AS name, 'page' AS role FROM pages),
e AS (SELECT DISTINCT src, dst FROM links)
SELECT e.src, e.dst, 'links_to' AS attr, coalesce(s.name, 'unknown') AS src_name, coalesce(s.role, 'missing') AS src_role,
       coalesce(d.name, 'unknown') AS dst_name, coalesce(d.role, 'missing') AS dst_role
FROM e LEFT JOIN v s ON s.id = e.src LEFT JOIN v d ON d.id = e.dst""")
def page_graph_triplets(spark, sf):
    v, e = _page_graph(spark, sf)
    tr = G.triplets(v, e, ["name", "role"], DEFAULT_VERTEX)
    return tr.select("src", "dst", "attr", "src_name", "src_role", "dst_name", "dst_role")


@plan("region_knowledge_triplets", "GR-03", sql="""
WITH v AS (SELECT 'R' || r_regionkey::VARCHAR AS id, 'concept' AS kind, r_name AS term FROM region
           UNION ALL SELECT 'N' || n_nationkey::VARCHAR, 'entity', n_name FROM nation),
e AS (SELECT 'N' || n_nationkey::VARCHAR AS src, 'R' || n_regionkey::VARCHAR AS dst, 'located_in' AS which, 'present' AS tense
      FROM nation)
SELECT e.src, e.dst, which, tense, coalesce(s.kind, 'unknown') AS src_kind, coalesce(s.term, 'missing') AS src_term,
       coalesce(d.kind, 'unknown') AS dst_kind, coalesce(d.term, 'missing') AS dst_term
FROM e LEFT JOIN v s ON s.id = e.src LEFT JOIN v d ON d.id = e.dst""")
def region_knowledge_triplets(spark, sf):
    # Concepts (regions) and named entities (nations) with one relationship
    # kind; vertex ids are unique by construction (kind prefix + key).
    r, n = t(spark, sf, "region"), t(spark, sf, "nation")
    v = r.select(F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("id"), F.lit("concept").alias("kind"),
                 F.col("r_name").alias("term")).unionByName(
        n.select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("id"), F.lit("entity").alias("kind"),
                 F.col("n_name").alias("term")))
    e = n.select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("src"),
                 F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("dst"),
                 F.lit("located_in").alias("which"), F.lit("present").alias("tense"))
    tr = G.triplets(v, e, ["kind", "term"], {"kind": "unknown", "term": "missing"})
    return tr.select("src", "dst", "which", "tense", "src_kind", "src_term", "dst_kind", "dst_term")


@plan("page_crawl", "GR-04", sql=f"""
WITH RECURSIVE {_LINKS_SQL},
crawl(url, depth) AS (SELECT url, 0 FROM pages
                      UNION SELECT l.dst, c.depth + 1 FROM crawl c JOIN links l ON l.src = c.url WHERE c.depth < 3)
SELECT url, min(depth)::INTEGER AS depth FROM crawl GROUP BY url""")
def page_crawl(spark, sf):
    links = _links(spark, sf).select("src", "dst")
    seeds = t(spark, sf, "pages").select("url")
    return G.crawl(links, seeds, max_depth=3)


@plan("page_crawl_budget", "GR-04", sql="""
WITH RECURSIVE ids AS (SELECT url, page_id, count(*) OVER () AS n FROM pages),
links AS (SELECT a.url AS src, b.url AS dst, k.pos FROM ids a, (SELECT unnest(range(3)) AS pos) k
          JOIN ids b ON b.page_id = (a.page_id * 3 + k.pos) % a.n),
q(r, hs, h, urls) AS (
  SELECT 0, [0::BIGINT], 0::BIGINT, (SELECT list(url ORDER BY page_id) FROM pages WHERE page_id IN (1, 2))
  UNION ALL
  SELECT r + 1, hs || [least(h + 4, len(urls))], least(h + 4, len(urls)), urls || coalesce((
    SELECT list(dst ORDER BY o) FROM (
      SELECT l.dst, min(u.i * 10 + l.pos) AS o
      FROM (SELECT unnest(urls[h + 1:h + 4]) AS url, unnest(range(len(urls[h + 1:h + 4]))) AS i) u
      JOIN links l ON l.src = u.url GROUP BY l.dst) WHERE NOT list_contains(urls, dst)), [])
  FROM q WHERE r < 6 AND len(urls) > h),
last AS (SELECT * FROM q ORDER BY r DESC LIMIT 1)
SELECT url, pos, CASE WHEN pos < h THEN (len(list_filter(hs, lambda x: x <= pos)) - 1)::INTEGER END AS round
FROM (SELECT hs, h, unnest(urls) AS url, unnest(range(len(urls))) AS pos FROM last)""")
def page_crawl_budget(spark, sf):
    # A link graph over the pages with several levels: page i names pages 3i,
    # 3i + 1 and 3i + 2 (modulo their number).  Two seeds, six rounds of four.
    p = t(spark, sf, "pages").select("url", "page_id")
    n = p.agg(F.count(F.lit(1))).scalar()
    out = p.select(F.col("url").alias("src"), F.posexplode(F.array(*[(F.col("page_id") * 3 + k) % n for k in range(3)])))
    links = out.join(p.select(F.col("url").alias("dst"), F.col("page_id").alias("col")), "col").select("src", "dst", "pos")
    seeds = p.where(F.col("page_id").isin(1, 2)).select("url", F.col("page_id").alias("ord"))
    return G.crawl_queue(links, seeds, per_round=4, max_rounds=6)


def _tree_nodes(spark, sf):
    r, n, c = t(spark, sf, "region"), t(spark, sf, "nation"), t(spark, sf, "customer")
    rid = lambda p, k: F.concat(F.lit(p), F.col(k).cast("string"))
    return (r.select(rid("R", "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent"),
                     F.col("r_regionkey").cast("bigint").alias("key"))
            .unionByName(n.select(rid("N", "n_nationkey").alias("id"), rid("R", "n_regionkey").alias("parent"),
                                  F.col("n_nationkey").cast("bigint").alias("key")))
            .unionByName(c.select(rid("C", "c_custkey").alias("id"), rid("N", "c_nationkey").alias("parent"),
                                  F.col("c_custkey").cast("bigint").alias("key"))))


_TREE_SQL = """RECURSIVE nodes AS (
  SELECT 'R' || r_regionkey::VARCHAR AS id, NULL::VARCHAR AS parent, r_regionkey::BIGINT AS key FROM region
  UNION ALL SELECT 'N' || n_nationkey::VARCHAR, 'R' || n_regionkey::VARCHAR, n_nationkey::BIGINT FROM nation
  UNION ALL SELECT 'C' || c_custkey::VARCHAR, 'N' || c_nationkey::VARCHAR, c_custkey::BIGINT FROM customer),
paths(id, depth, path) AS (
  SELECT id, 0, [key] FROM nodes WHERE parent IS NULL
  UNION ALL SELECT n.id, p.depth + 1, list_append(p.path, n.key) FROM paths p JOIN nodes n ON n.parent = p.id),
sized AS (SELECT a.id, a.depth, a.path, count(*) AS size FROM paths a JOIN paths d ON d.path[1:len(a.path)] = a.path
          GROUP BY a.id, a.depth, a.path)"""


@plan("tree_node_stats", "GR-06", sql=f"""
WITH {_TREE_SQL}
SELECT id, depth::INTEGER AS depth, size FROM sized""")
def tree_node_stats(spark, sf):
    s = G.tree_sizes(_tree_nodes(spark, sf))
    return s.select("id", F.col("depth").cast("int"), "size")


@plan("tree_nested_sets", "GR-07", sql=f"""
WITH {_TREE_SQL}
SELECT id, depth::INTEGER AS depth, size, (2 * (row_number() OVER (ORDER BY path) - 1) - depth + 1)::BIGINT AS lft,
       (2 * (row_number() OVER (ORDER BY path) - 1) - depth + 1 + 2 * size - 1)::BIGINT AS rgt
FROM sized""")
def tree_nested_sets(spark, sf):
    return G.nested_sets(G.tree_sizes(_tree_nodes(spark, sf))).select("id", F.col("depth").cast("int"), "size", "lft", "rgt")


@plan("tree_render_fragments", "GR-08", sql=f"""
WITH {_TREE_SQL},
ns AS (SELECT id, size, (2 * (row_number() OVER (ORDER BY path) - 1) - depth + 1)::BIGINT AS lft,
              (2 * (row_number() OVER (ORDER BY path) - 1) - depth + 1 + 2 * size - 1)::BIGINT AS rgt FROM sized)
SELECT lft AS pos, CASE WHEN size > 1 THEN id || '{{' ELSE id END AS text FROM ns
UNION ALL SELECT rgt, '}}' FROM ns WHERE size > 1""")
def tree_render_fragments(spark, sf):
    s = G.nested_sets(G.tree_sizes(_tree_nodes(spark, sf)))
    return G.render_fragments(s, "id")
