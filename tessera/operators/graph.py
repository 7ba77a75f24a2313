"""Property graphs, link extraction, frontier crawl and hierarchies
(SURVEY §2.11, JN-04, JN-12, FIL-09).

GraphX has no Python API, so a graph is two DataFrames: ``vertices(id, ...)``
and ``edges(src, dst, ...)``.  Iterative algorithms (crawl, tree levels)
are driver loops over DataFrame joins whose state is checkpointed to the
cluster's shared checkpoint folder each round, so lineage stays short and a
lost executor only costs the current round.  The driver only ever sees a
boolean "anything new?" per round.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize, written

# URL shapes.  The path test is the reference's file-name
# pattern (note the '/'..'_' character range inside the first class).
SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"
AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"
#: Scheme and authority, path, and what follows.
HEAD = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)([^?#]*)(.*)$"
FILE_NAME = r"^([\/-_\w~]*\/)?([-_\w]*)?(\.(\w*))?$"
#: An anchor's href with its quotes, if it has any; names in either case.
HREF = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def url_scheme(u) -> Column:
    return F.lower(F.regexp_extract(_c(u), SCHEME, 1))


def remove_dot_segments(path) -> Column:
    """The path without its ``.`` and ``..`` segments (RFC 3986, 5.2.4): a fold
    over the segments with those kept so far as a stack."""
    parts = F.split(_c(path), "/")
    kept = F.aggregate(F.slice(parts, F.lit(2), F.size(parts)), F.array().cast("array<string>"), lambda acc, x: (
        F.when(x == ".", acc).when(x == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(x)))))
    last = F.element_at(parts, -1)
    # A path that ends on a dot segment names a folder.
    kept = F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(_c(path).startswith("/"), F.concat(F.lit("/"), F.array_join(kept, "/"))).otherwise(_c(path))


def resolve_url(base, href) -> Column:
    """Absolute URL of ``href`` relative to the page ``base`` (JN-12):
    absolute stays, ``//host`` takes the base scheme, ``/path`` the base
    scheme and authority, ``#frag``/``?query`` attach to the base, anything
    else replaces the last path segment.  Dot segments of the path are
    removed; an empty reference is the base without its fragment."""
    b, h = _c(base), F.trim(_c(href))
    scheme = F.regexp_extract(b, SCHEME, 1)
    auth = F.regexp_extract(b, AUTHORITY, 1)
    path = F.regexp_extract(b, PATH, 1)
    no_frag = F.regexp_replace(b, "#.*$", "")
    no_query = F.regexp_replace(no_frag, r"\?.*$", "")
    dir_ = F.regexp_replace(path, "[^/]*$", "")
    dir_ = F.when(dir_ == "", F.lit("/")).otherwise(dir_)
    joined = (F.when(h.rlike(SCHEME), h)
              .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
              .when(h.startswith("/"), F.concat(scheme, F.lit("://"), auth, h))
              .when(h.startswith("#"), F.concat(no_frag, h))
              .when(h.startswith("?"), F.concat(no_query, h))
              .when(h == "", no_frag)
              .otherwise(F.concat(scheme, F.lit("://"), auth, dir_, h)))
    dots = F.regexp_extract(joined, PATH, 1)
    head, tail = F.regexp_extract(joined, HEAD, 1), F.regexp_extract(joined, HEAD, 3)
    return F.when(dots.rlike(r"/\.\.?(/|$)"), F.concat(head, remove_dot_segments(dots), tail)).otherwise(joined)


def valid_protocol(u) -> Column:
    """http or https only (FIL-09)."""
    return url_scheme(u).isin("http", "https")


def can_parse(u) -> Column:
    """Whether the path looks like an HTML document (FIL-09): no extension,
    ``.html`` or ``.htm``; a path the file-name pattern cannot read is
    accepted, as in the reference."""
    p = F.regexp_extract(_c(u), PATH, 1)
    m = p.rlike(FILE_NAME)
    has_ext = F.regexp_extract(p, FILE_NAME, 3) != ""
    ext = F.regexp_extract(p, FILE_NAME, 4)
    return ~m | ~has_ext | ext.isin("html", "htm")


def extract_links(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
                  valid_only: bool = True) -> DataFrame:
    """(page_id, src, pos, href, dst) for every ``<a href>`` of every page
    (GR-05), however it is quoted and cased, resolved against the page URL; ``valid_only`` keeps http(s)
    links to parseable paths."""
    hrefs = pages.select(page_id, F.col(url).alias("src"),
                         F.posexplode(F.regexp_extract_all(html, F.lit(HREF), 1)).alias("pos", "href"))
    out = hrefs.withColumn("href", F.regexp_replace("href", "^[\"']|[\"']$", "")).withColumn("dst", resolve_url("src", "href"))
    if valid_only:
        out = out.where(valid_protocol("dst") & can_parse("dst"))
    return out


# ------------------------------------------------------------------ graphs --


def graph_vertices(vertices: DataFrame, edges: DataFrame, defaults: dict[str, object],
                   vid: str = "id") -> DataFrame:
    """Given vertices plus every edge endpoint that is not among them, with
    the default attributes (GR-01)."""
    ends = edges.select(F.col("src").alias(vid)).unionByName(edges.select(F.col("dst").alias(vid))).distinct()
    missing = ends.join(vertices.select(vid), vid, "left_anti")
    filled = missing.select(vid, *[F.lit(v).alias(k) for k, v in defaults.items()])
    return vertices.select(vid, *defaults.keys()).unionByName(filled)


def triplets(vertices: DataFrame, edges: DataFrame, attrs: Sequence[str], defaults: dict[str, object],
             vid: str = "id") -> DataFrame:
    """Each edge with its source and destination attributes (GR-02, JN-04);
    endpoints without a vertex get the default attributes."""
    v = vertices.select(vid, *attrs)
    s = v.select(F.col(vid).alias("src"), *[F.col(a).alias(f"src_{a}") for a in attrs])
    d = v.select(F.col(vid).alias("dst"), *[F.col(a).alias(f"dst_{a}") for a in attrs])
    j = edges.join(s, "src", "left").join(d, "dst", "left")
    fill = {f"{p}_{a}": F.coalesce(F.col(f"{p}_{a}"), F.lit(defaults[a])) for p in ("src", "dst") for a in attrs}
    return j.withColumns(fill)


def _cut(df: DataFrame) -> DataFrame:
    """Cut lineage by a reliable checkpoint in the shared checkpoint folder."""
    return materialize(df)


def crawl(links: DataFrame, seeds: DataFrame, max_depth: int) -> DataFrame:
    """Breadth-first frontier crawl (GR-04): (url, depth) for every URL
    reached within ``max_depth`` link hops of a seed, at its first depth.

    Each round joins the frontier to the link table (``src -> dst``),
    removes already-visited URLs with an anti-join and appends the rest.
    Each round's new frontier is checkpointed, so the visited set is a union
    of checkpointed levels.  Unlike the reference, which
    re-queues visited URLs and counts batches of 8, depth here is true BFS
    depth and no URL is expanded twice."""
    # The link table is joined in every round: materialise it once instead
    # of re-extracting links from the pages each time.
    links = _cut(links.select("src", "dst"))
    visited = _cut(seeds.select(F.col("url"), F.lit(0).alias("depth")).distinct())
    frontier = visited
    for depth in range(1, max_depth + 1):
        nxt = (frontier.join(links, frontier.url == links.src).select(F.col("dst").alias("url")).distinct()
               .join(visited.select("url"), "url", "left_anti").withColumn("depth", F.lit(depth)))
        nxt = _cut(nxt)
        if nxt.isEmpty():
            break
        # A union of checkpointed levels already has shallow lineage.
        visited = visited.unionByName(nxt)
        frontier = nxt
    return visited


def crawl_queue(links: DataFrame, seeds: DataFrame, per_round: int, max_rounds: int) -> DataFrame:
    """Crawl within a budget (GR-04): (url, pos, round) of every URL in the
    queue when the crawl ends, in discovery order; ``round`` is when it was
    taken, null if the budget ran out before.

    ``seeds`` (url, ord) begin the queue; each round takes the next
    ``per_round`` URLs and appends what they link to (``links`` src, dst, pos)
    in the order in which it is found, each URL once.  The crawl ends after
    ``max_rounds`` rounds or when the queue is used up.  The queue is a table;
    the driver only counts it."""
    from tessera.operators.ordered import global_row_number

    links = _cut(links.select("src", "dst", F.col("pos").alias("_at")))
    first = seeds.groupBy("url").agg(F.min("ord").alias("_o"))
    queue = _cut(global_row_number(first, ["_o", "url"], "pos", start=0).select("url", "pos"))
    size, heads = queue.count(), [0]  # heads: where each round begins
    while len(heads) <= max_rounds and heads[-1] < size:
        heads.append(min(size, heads[-1] + per_round))
        taken = queue.where((F.col("pos") >= heads[-2]) & (F.col("pos") < heads[-1]))
        seen = taken.join(links, taken["url"] == links["src"]).groupBy(F.col("dst").alias("url")).agg(
            F.min(F.struct("pos", "_at")).alias("_o"))
        new = seen.join(queue.select("url"), "url", "left_anti").withColumn("_p", F.col("_o.pos")).withColumn("_q", F.col("_o._at"))
        found = _cut(global_row_number(new, ["_p", "_q", "url"], "pos", start=size).select("url", "pos"))
        size += found.count()
        queue = queue.unionByName(found)  # checkpointed tables: shallow lineage
    begun = F.size(F.filter(F.array(*map(F.lit, heads)), lambda h: h <= F.col("pos")))
    return queue.withColumn("round", F.when(F.col("pos") < heads[-1], begun - 1))


def tree_paths(nodes: DataFrame) -> DataFrame:
    """Root-to-node paths of a forest given as ``nodes(id, parent, key)``
    (``parent`` null for roots; ``key`` orders siblings).  Returns
    ``(id, depth, path)`` where ``path`` is the array of keys from the root,
    so sorting by ``path`` is a pre-order walk.  One join per level until a
    level is empty; levels are checkpointed.  Nodes that no root reaches (on
    a cycle) have no path."""
    level = _cut(nodes.where(F.col("parent").isNull()).select(
        "id", F.lit(0).alias("depth"), F.array(F.col("key")).alias("path")))
    out = level
    children = _cut(nodes.where(F.col("parent").isNotNull()).select("id", "parent", "key"))  # joined every level
    for d in count(1):
        nxt = level.select(F.col("id").alias("parent"), "path").join(children, "parent").select(
            "id", F.lit(d).alias("depth"), F.concat("path", F.array(F.col("key"))).alias("path"))
        nxt = _cut(nxt)
        if nxt.isEmpty():
            break
        out = out.unionByName(nxt)  # union of checkpointed levels: shallow lineage
        level = nxt
    return out


def tree_sizes(nodes: DataFrame) -> DataFrame:
    """(id, parent, key, depth, size) of each node that a root reaches, ``size``
    counting the node and its descendants (GR-06), in a number of rounds that
    is the logarithm of the depth and without any path.

    Before round k a node knows its ancestor ``2**k`` steps up and the number
    of descendants fewer than ``2**k`` steps down; descendants exactly ``2**k``
    down hand on theirs.  Nodes on a cycle, and nodes below a parent that is
    not there, are reached by no root and have no row."""
    nodes = _cut(nodes.select("id", "parent", "key"))
    known = nodes.select(F.col("id").alias("_up"))
    state = _cut(nodes.select("id", "parent").join(known, F.col("parent") == F.col("_up"), "left").select(
        "id", F.col("_up").alias("up"), F.when(F.col("_up").isNull(), 0).otherwise(1).cast("bigint").alias("depth"),
        (F.col("parent").isNotNull() & F.col("_up").isNull()).alias("lost"), F.lit(1).cast("bigint").alias("size")))
    # What still has an ancestor after log2(nodes) rounds is on a cycle or below one.
    for _ in range(nodes.count().bit_length() + 1):
        if state.where("up is not null").isEmpty():
            break
        below = state.where("up is not null").groupBy(F.col("up").alias("id")).agg(F.sum("size").alias("more"))
        above = state.select(F.col("id").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("depth2"),
                             F.col("lost").alias("lost2"))
        state = _cut(state.join(above, "up", "left").join(below, "id", "left").select(
            "id", F.col("up2").alias("up"), (F.col("depth") + F.coalesce("depth2", F.lit(0))).alias("depth"),
            (F.col("lost") | F.coalesce("lost2", F.lit(False))).alias("lost"),
            (F.col("size") + F.coalesce("more", F.lit(0))).alias("size")))
    return nodes.join(state.where("up is null and not lost").select("id", "depth", "size"), "id")


def nested_sets(sized: DataFrame) -> DataFrame:
    """Nested-set (left, right) numbering (GR-07) of the output of
    :func:`tree_sizes`.  A node comes right after its parent and the subtrees
    of its earlier siblings (by ``key``, then ``id``), so its pre-order place
    ``p`` is a sum over its ancestors: sums over siblings come from the
    segmented scan (a parent may hold most nodes), sums over ancestors from
    doubling.  Then ``left = 2p - depth + 1`` and ``right = left + 2*size - 1``.
    Roots are siblings of each other."""
    from tessera.operators.scan import segmented_scan

    s = segmented_scan(sized, "parent", ["key", "id"], sum_col="size", idx="_i", running="_upto")
    step = F.col("_upto") - F.col("size") + F.when(F.col("parent").isNull(), 0).otherwise(1)
    state = written(s.select("id", "depth", "size", F.col("parent").alias("up"), step.alias("p")))
    deepest = state.agg(F.max("depth")).first()[0] or 0
    for _ in range(int(deepest).bit_length()):
        above = state.select(F.col("id").alias("up"), F.col("up").alias("up2"), F.col("p").alias("p2"))
        state = _cut(state.join(above, "up", "left").select(
            "id", "depth", "size", F.col("up2").alias("up"), (F.col("p") + F.coalesce("p2", F.lit(0))).alias("p")))
    lft = 2 * F.col("p") - F.col("depth") + 1
    return state.select("id", "depth", "size", lft.cast("bigint").alias("lft"),
                        (lft + 2 * F.col("size") - 1).cast("bigint").alias("rgt"))


def render_fragments(nested: DataFrame, label: str) -> DataFrame:
    """Bracketed rendering of a tree, ``A{B C{D}}`` style (GR-08), as ordered
    text fragments ``(pos, text)``: a node with children opens ``label{`` at
    its left number and closes ``}`` at its right number; a leaf is its label.
    Concatenating by ``pos`` gives the whole rendering, which is never built
    in one row (a tree can be arbitrarily large)."""
    opens = nested.select(F.col("lft").alias("pos"),
                          F.when(F.col("size") > 1, F.concat(F.col(label).cast("string"), F.lit("{")))
                          .otherwise(F.col(label).cast("string")).alias("text"))
    closes = nested.where(F.col("size") > 1).select(F.col("rgt").alias("pos"), F.lit("}").alias("text"))
    return opens.unionByName(closes)
