"""Chat formatting (operator 1): reply trees to conversations, with DataFrame
functions only.

A message has an id, the id of the message it answers (null: a root), a role,
a text and a score.  Iterative self-joins double the distance at which each
message knows its ancestor (1, 2, 4, ...), with the sum of scores on the way,
so a path of n messages takes log2(n) rounds.  Leaves climb these tables to
their root, branches of a root are ranked by the mean score of their path, and
the chosen root-to-leaf paths are enumerated by halving the same strides, and
written out as one conversation each.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn.  Inside texts
and roles one backslash is put between ``<`` and ``|`` wherever they stand
together or with only backslashes between, so ``<|`` never occurs there and
taking one backslash out gives the text back.  In roles a backslash is first
doubled and a line feed written as ``\\n``.

Defined cases: null texts and roles are empty, null scores 0; a message whose
parent is not in the table is a root; messages on a reply cycle, and what
hangs on one, have no root and so no path; ties between branches go to the
smaller leaf id; an empty table gives an empty result; other columns are
ignored.  A hot tree is many rows of the joins, never one group; only the
turns of one conversation are brought together, as its text is one value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import materialize
from tessera.operators.ordered import global_row_number

# Fixed values of the template.
START, END = "<|im_start|>", "<|im_end|>"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<$1\\|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\\\|", r"<$1|")


def escape_role(c: Column) -> Column:
    return escape(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(c: Column) -> Column:
    # An even run of backslashes is doubled ones; an odd one ends in \n.
    c = F.regexp_replace(unescape(c), r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return F.replace(c, F.lit("\\\\"), F.lit("\\"))


def reply_paths(messages: DataFrame, top: int | None = 1) -> DataFrame:
    """(root, leaf, score, pos, node): the messages of the ``top`` best
    branches of each tree (None: all), pos counting from the root.

    ``messages`` has the columns node, parent (longs) and score (double)."""
    known = messages.select(F.col("node").alias("_p"))
    m = materialize(
        messages.select("node", "parent", F.coalesce("score", F.lit(0.0)).alias("s"))
        .join(known, F.col("parent") == F.col("_p"), "left")
        .select("node", F.col("_p").alias("parent"), "s"))
    nodes = m.count()
    # strides[k]: node -> the ancestor 2**k above it and the scores passed.
    strides = [m.where("parent is not null").select("node", F.col("parent").alias("up"), "s")]
    while 2 ** len(strides) < max(2, nodes):
        low = strides[-1]
        high = low.select("node", F.col("up").alias("mid"), "s").join(
            low.select(F.col("node").alias("mid"), "up", F.col("s").alias("s2")), "mid")
        high = materialize(high.select("node", "up", (F.col("s") + F.col("s2")).alias("s")))
        if high.isEmpty():
            break
        strides.append(high)
    # Leaves climb by falling strides; each stride taken is one stretch.
    parents = strides[0].select(F.col("up").alias("node")).distinct()
    climb = m.join(parents, "node", "left_anti").select(
        F.col("node").alias("leaf"), F.col("node").alias("at"), F.lit(0).cast("long").alias("depth"),
        F.lit(0.0).alias("score"), F.expr("cast(array() as array<struct<k:int,node:bigint,above:bigint>>)").alias("taken"))
    for k in reversed(range(len(strides))):
        step = strides[k].select(F.col("node").alias("at"), "up", "s")
        go = F.col("up").isNotNull()
        climb = climb.join(step, "at", "left").select(
            "leaf", F.coalesce("up", "at").alias("at"),
            (F.col("depth") + F.when(go, 2 ** k).otherwise(0)).alias("depth"),
            (F.col("score") + F.coalesce("s", F.lit(0.0))).alias("score"),
            F.when(go, F.concat("taken", F.array(F.struct(
                F.lit(k).alias("k"), F.col("at").alias("node"), F.col("depth").alias("above")))))
            .otherwise(F.col("taken")).alias("taken"))
    climb = materialize(climb)
    ends = m.where("parent is null").select(F.col("node").alias("root"), F.col("s").alias("s0"))
    best = climb.join(ends, climb["at"] == ends["root"]).select(
        "root", "leaf", "depth", ((F.col("score") + F.col("s0")) / (F.col("depth") + 1)).alias("score"),
        F.concat("taken", F.array(F.struct(F.lit(0).alias("k"), F.col("root").alias("node"),
                                           F.col("depth").alias("above")))).alias("taken"))
    if top is not None:
        # The rank limit is applied before the exchange too, so a hot tree
        # sends ``top`` rows from each task.
        rank = F.row_number().over(W.partitionBy("root").orderBy(F.desc("score"), "leaf"))
        best = best.withColumn("_r", rank).where(F.col("_r") <= top).drop("_r")
    # Each stretch of 2**k messages is halved until it is one message; the
    # upper half starts at the ancestor 2**(k-1) above.
    part = materialize(best.select("root", "leaf", "score", "depth", F.explode("taken").alias("t")).select(
        "root", "leaf", "score", "depth", "t.k", "t.node", "t.above"))
    for k in reversed(range(1, len(strides))):
        half = strides[k - 1].select(F.col("node").alias("_n"), "up")
        split = (F.col("k") == k) & (F.col("node") == F.col("_n"))
        lower = F.struct(F.least("k", F.lit(k - 1)).alias("k"), F.col("node"), F.col("above"))
        upper = F.struct(F.lit(k - 1).alias("k"), F.col("up").alias("node"), (F.col("above") + 2 ** (k - 1)).alias("above"))
        halves = F.when(F.col("up").isNotNull(), F.array(lower, upper)).otherwise(F.array(lower))
        part = part.join(half, split, "left").select("root", "leaf", "score", "depth", F.explode(halves).alias("t")).select(
            "root", "leaf", "score", "depth", "t.k", "t.node", "t.above")
    return part.select("root", "leaf", "score", (F.col("depth") - F.col("above")).alias("pos"), "node")


def format_paths(paths: DataFrame, messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """(root, leaf, score, n_turns, formatted, turns): one conversation for
    each path.  ``turns`` gives, in code points of ``formatted``, where each
    turn starts and its part under the loss mask [loss_start, loss_end)."""
    role = F.coalesce("role", F.lit(""))
    head = F.concat(F.lit(START), escape_role(role), F.lit("\n"))
    body = escape(F.coalesce("text", F.lit("")))
    pieces = messages.select("node", head.alias("_h"), body.alias("_b"), (role == loss_role).alias("_l"))
    rows = paths.join(pieces, "node").select(
        "root", "leaf", "score", "pos", F.concat("_h", "_b", F.lit(END + "\n")).alias("piece"),
        F.length("_h").cast("long").alias("before"),
        F.when(F.col("_l"), F.length("_b")).otherwise(0).cast("long").alias("under"))
    sofar = W.partitionBy("root", "leaf").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("piece").cast("long")).over(sofar), F.lit(0))
    one = rows.withColumn("start", start).select(
        "root", "leaf", "score", F.struct(
            "pos", "piece", "start", (F.col("start") + F.col("before")).alias("loss_start"),
            (F.col("start") + F.col("before") + F.col("under")).alias("loss_end")).alias("t"))
    return (one.groupBy("root", "leaf").agg(F.max("score").alias("score"), F.sort_array(F.collect_list("t")).alias("t"))
            .select("root", "leaf", "score", F.size("t").cast("long").alias("n_turns"),
                    F.array_join("t.piece", "").alias("formatted"),
                    F.transform("t", lambda t: F.struct(t["start"].alias("start"), t["loss_start"].alias("loss_start"),
                                                        t["loss_end"].alias("loss_end"))).alias("turns")))


def format_trees(messages: DataFrame, top: int | None = 1, loss_role: str = "assistant") -> DataFrame:
    """``format_paths`` over ``reply_paths`` of messages (node, parent, role, text, score)."""
    return format_paths(reply_paths(messages, top), messages, loss_role)


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds ``roles``, ``texts`` and ``loss`` (the text under the loss mask),
    read from ``formatted`` and ``turns`` alone."""
    end = len(END) + 1
    piece = F.split("formatted", r"(?=<\|im_start\|>)", -1)
    df = formatted.withColumn("_p", piece)
    body = F.transform("_p", lambda p: F.substr(p, F.lit(len(START) + 1)))
    df = df.withColumn("_b", body)
    role = F.transform("_b", lambda b: F.substring_index(b, "\n", 1))
    df = df.withColumn("_r", role)
    text = F.zip_with("_b", "_r", lambda b, r: unescape(
        F.substr(b, F.length(r) + 2, F.length(b) - F.length(r) - 1 - end)))
    loss = F.zip_with("_p", "turns", lambda p, t: unescape(F.substr(
        p, (t["loss_start"] - t["start"] + 1).cast("int"), (t["loss_end"] - t["loss_start"]).cast("int"))))
    return (df.withColumn("roles", F.transform("_r", unescape_role)).withColumn("texts", text)
            .withColumn("loss", F.array_join(loss, "")).drop("_p", "_b", "_r"))


def conversation_messages(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as messages of reply trees: each turn
    answers the one before it.  Order: turn (nulls first), role, text."""
    rows = global_row_number(conversations.select("conv_id", "turn", "role", "text"),
                             [F.col("conv_id"), F.col("turn"), F.col("role"), F.col("text")], "node", 0)
    rows = materialize(rows)
    first = rows.groupBy("conv_id").agg(F.min("node").alias("first")).withColumnRenamed("conv_id", "_c")
    return rows.join(first, F.col("conv_id").eqNullSafe(F.col("_c"))).select(
        "conv_id", "node", F.when(F.col("node") > F.col("first"), F.col("node") - 1).alias("parent"),
        "role", "text", F.lit(0.0).alias("score"))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, formatted, turns) for each conversation."""
    messages = conversation_messages(conversations)
    out = format_trees(messages, top=1)
    names = messages.where("parent is null").select(F.col("node").alias("root"), "conv_id")
    return out.join(names, "root").select("conv_id", "n_turns", "formatted", "turns")


def digests(formatted: DataFrame) -> DataFrame:
    """What was read back from the formatted conversations, as digests."""
    rows = read_back(formatted)
    turns = F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit("\n"), t, F.lit("\n"))), "")
    return rows.select(
        "conv_id", F.size("texts").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
