"""Conversation prefix trie by ROLLUP over positional turn ids (operator 12).

A turn's id is 128 bits of the SHA-256 of its role and text.  A conversation
is laid out in blocks of ``WIDTH`` turns, one row each with the turn ids in
columns t1 … tW; a block after the first carries the key of the trie node in
which the block before it ended, so one statement

    GROUP BY k1, k2, block, ROLLUP (t1, …, tW)

aggregates all prefixes of all lengths together, however long conversations
are, and ``grouping_id()`` tells a row's depth.  The smallest conversation of
a node is its owner; owner and depth name the node.

The first ROLLUP finds every node's owner.  A conversation owns its nodes from
some depth f on, down to its end, and shares what lies above with a smaller
one.  With g the code points of its turns above f, subtree sums become sums
over a node's members, which a second ROLLUP takes: the tokens saved below a
node of depth d are ``sum(g) - g(owner) - (members - 1) * (code points above
d)``, and its leaves are the members that own a childless end.

A node's key is the exclusive or of two 64-bit hashes of each full block and
of the begun one with the depth, so keys of long conversations come from
grouped, not sequential, sums.

Hot groups: turns are numbered after a range sort by conversation, turn and
hash, which splits a conversation that holds a third of all rows; running sums
over blocks go through stretches of ``STRETCH`` blocks; joins on a
conversation or a parent node send the keys with over a thousandth of the rows
(fewer than a thousand by count) as a broadcast and shuffle the others.  The
conversations that end at a node are joined into texts of at most
``CHUNK_IDS`` ids by a range sort, and one task hashes these in order.

Defined results: a null role or text is empty; turns of equal number follow
the hash of role and text (null numbers first); a row without conv_id belongs
to no conversation and is left out; repeated rows are turns like others.  An
empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop, materialize

#: Turns of a block, that is positional columns of a ROLLUP.
WIDTH = 8
#: Blocks of a stretch in running sums over a conversation.
STRETCH = 256
#: The first turns come from the first conversation of each family of so many, at most so many of them.
FAMILY = 100
MAX_HEAD = 5
#: Ids joined into one text before the texts of a node are hashed in order.
CHUNK_IDS = 4096

T = [f"t{j}" for j in range(1, WIDTH + 1)]


def head_length(conv: str | Column) -> Column:
    """Turns that a conversation takes from the first of its family."""
    return (F.crc32(F.col(conv).cast("string").cast("binary")) % (MAX_HEAD + 1)).cast("int")


def join_split(left: DataFrame, right: DataFrame, on: list[str], counts: DataFrame, how: str = "left") -> DataFrame:
    """``left`` joined to ``right`` (one row a key), without a hot key in a shuffle.

    ``counts`` has, for each key, its rows ``n`` in ``left``.  Keys with over a
    thousandth of these rows are fewer than a thousand: their rows of ``right``
    are broadcast and what they match is taken out of the shuffle.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0
    heavy = counts.where(F.col("n") > max(total // 1000, 1000)).select(*on)
    few = F.broadcast(right.join(F.broadcast(heavy), on, "left_semi"))
    hot = left.join(F.broadcast(heavy), on, "left_semi").join(few, on, how)
    rest = left.join(F.broadcast(heavy), on, "left_anti").join(right, on, how)
    return hot.unionByName(rest)


# --- numbered turns ---------------------------------------------------------

def numbered(conversations: DataFrame) -> DataFrame:
    """conv, pos (from 1), tid, len of every turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    both = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv"), "turn", F.substring(F.unhex(F.sha2(both, 256)), 1, 16).alias("tid"),
        F.length(text).cast("bigint").alias("len"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("tid"), F.col("row")]
    # equal rows are alike, so the row number only lets the range sort part a crowd of them
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order) \
        .select("conv", "tid", "len").mapInArrow(_run_places, "conv bigint, run bigint, place bigint, tid binary, len bigint")
    placed = materialize(placed, "trie-turns")
    # A conversation lies in consecutive parts; all but the first of its parts begin at an offset.
    runs = placed.groupBy("conv", "run").agg(F.max("place").alias("n"))
    w = Window.partitionBy("conv").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    later = runs.withColumn("before", F.sum("n").over(w)).where("before is not null").select("conv", "run", "before")
    # at most one conversation goes on from an earlier part into each part of the sort: a broadcast of that many rows
    return placed.join(F.broadcast(later), ["conv", "run"], "left").select(
        "conv", (F.col("place") + F.coalesce("before", F.lit(0))).alias("pos"), "tid", "len")


def _run_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the rows of each conversation of this part of the sort."""
    part, last, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        conv = batch.column("conv").to_numpy(zero_copy_only=False)
        if not len(conv):
            continue
        new = np.concatenate([[conv[0] != last], conv[1:] != conv[:-1]])
        at = np.arange(len(conv))
        first = np.maximum.accumulate(np.where(new, at, -1))
        place = np.where(first >= 0, at - first, at + seen) + 1
        last, seen = conv[-1], int(place[-1])
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), pa.array(np.full(len(conv), part, np.int64)), pa.array(place.astype(np.int64)),
             batch.column("tid"), batch.column("len")], ["conv", "run", "place", "tid", "len"])


# --- rebuilt conversations in blocks ----------------------------------------

def rebuilt(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """conv, depth (from 1), tid, len: the head of the family's first conversation, then the own turns after it.

    ``sizes`` has the number ``n`` of own turns of each conv.
    """
    heads = turns.where((F.col("conv") % FAMILY == 0) & (F.col("pos") <= MAX_HEAD)).groupBy(F.col("conv").alias("first")) \
        .agg(F.sort_array(F.collect_list(F.struct("pos", "tid", "len"))).alias("head"))  # at most MAX_HEAD turns
    convs = sizes.select("conv", (F.col("conv") - F.col("conv") % FAMILY).alias("first"), head_length("conv").alias("h"))
    taken = convs.join(heads, "first", "left").select(
        "conv", "h", F.filter(F.coalesce("head", F.array().cast("array<struct<pos:bigint,tid:binary,len:bigint>>")),
                              lambda t: t["pos"] <= F.col("h")).alias("head"))
    front = taken.select("conv", F.explode("head").alias("t")).select("conv", F.col("t.pos").alias("depth"), "t.tid", "t.len")
    missing = taken.select("conv", (F.col("h") - F.size("head")).alias("missing")).where("missing > 0")
    own = join_split(turns.where(F.col("pos") > head_length("conv")), missing, ["conv"], sizes).select(
        "conv", (F.col("pos") - F.coalesce("missing", F.lit(0))).alias("depth"), "tid", "len")
    return front.unionByName(own)


def _node(depth: Column, upto: Column | None = None) -> list[Column]:
    """Two hashes of the depth reached and of the turn ids of its block (those up to a place)."""
    ids = [F.col(t) if upto is None else F.when(upto >= j, F.col(t)) for j, t in enumerate(T, 1)]
    return [F.xxhash64(F.lit(lane), depth.cast("bigint"), *ids) for lane in (1, 2)]


def blocks(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """A row for each block of a rebuilt conversation; one without turns for a conversation that has none.

    conv, block, n (turns in it), k1, k2 (key of the node it goes on from),
    above (code points before it), t1 … tW and the code points q1 … qW up to each.
    """
    rows = rebuilt(turns, sizes)
    slot = ((F.col("depth") - 1) % WIDTH + 1).cast("int")
    cut = rows.groupBy("conv", ((F.col("depth") - 1) / WIDTH).cast("bigint").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct(slot.alias("slot"), "tid", "len"))).alias("b"))  # at most WIDTH turns
    cut = cut.select("conv", "block", F.size("b").alias("n"),
                     *[F.get("b.tid", F.lit(j)).alias(t) for j, t in enumerate(T)],
                     *[F.aggregate(F.slice("b.len", 1, j + 1), F.lit(0).cast("bigint"), lambda a, x: a + x).alias(f"c{j + 1}")
                       for j in range(WIDTH)])
    cut = materialize(cut, "trie-cut")
    # keys and code points before a block: within its stretch, and of the stretches before
    long = cut.where(f"n = {WIDTH}").select(
        "conv", "block", F.col(f"c{WIDTH}").alias("c"),
        *[x.alias(f"x{i}") for i, x in enumerate(_node((F.col("block") + 1) * WIDTH), 1)],
        (F.col("block") / STRETCH).cast("bigint").alias("stretch"))
    sums = [F.bit_xor("x1"), F.bit_xor("x2"), F.sum("c")]
    inner = Window.partitionBy("conv", "stretch").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    outer = Window.partitionBy("conv").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    whole = long.groupBy("conv", "stretch").agg(*[s.alias(c) for s, c in zip(sums, ("x1", "x2", "c"))])
    earlier = whole.select("conv", "stretch", *[s.over(outer).alias(c) for s, c in zip(sums, ("y1", "y2", "y"))])
    ended = long.select("conv", "stretch", "block", *[s.over(inner).alias(c) for s, c in zip(sums, ("x1", "x2", "c"))]) \
        .join(earlier.where("y is not null"), ["conv", "stretch"], "left")
    zero = F.lit(0).cast("bigint")
    ended = ended.select("conv", (F.col("block") + 1).alias("block"),
                         *[F.col(f"x{i}").bitwiseXOR(F.coalesce(f"y{i}", zero)).alias(f"k{i}") for i in (1, 2)],
                         (F.col("c") + F.coalesce("y", zero)).alias("above"))
    full = cut.join(ended, ["conv", "block"], "left")
    bare = sizes.select("conv").join(cut.where("block = 0").select("conv"), "conv", "left_anti").select(
        "conv", zero.alias("block"), F.lit(0).alias("n"), *[F.lit(None).cast("binary").alias(t) for t in T],
        *[F.lit(None).cast("bigint").alias(f"c{j}") for j in range(1, WIDTH + 1)],
        *[F.lit(None).cast("bigint").alias(c) for c in ("k1", "k2", "above")])
    rows = full.unionByName(bare).fillna(0, ["k1", "k2", "above"])
    out = materialize(rows.select("conv", "block", "n", "k1", "k2", "above", *T,
                                  *[(F.col("above") + F.col(f"c{j}")).alias(f"q{j}") for j in range(1, WIDTH + 1)]),
                      "trie-blocks")
    drop(cut)
    return out


# --- the trie ---------------------------------------------------------------

def rollup(rows: DataFrame, aggregates: str) -> DataFrame:
    """All nodes: depth, x1, x2 (the node's key), p1, p2 (its parent's), above (code points before its turn), aggregates."""
    ids = ", ".join(T)
    ups = ", ".join(f"max(q{j}) AS q{j}" for j in range(1, WIDTH + 1))
    found = rows.sparkSession.sql(
        f"SELECT k1, k2, block, {ids}, grouping_id() AS gid, max(above) AS start, {ups}, {aggregates} "
        f"FROM {{rows}} GROUP BY k1, k2, block, ROLLUP ({ids})", rows=rows)
    # the ids below a row's depth are the trailing ones of its grouping id
    level = (F.lit(WIDTH) - F.bit_count("gid")).cast("int")
    found = found.withColumn("level", level)
    here = F.coalesce(*[F.when(F.col("level") == j, F.col(t)) for j, t in enumerate(T, 1)])
    found = found.where((F.col("level") > 0) & here.isNotNull() | (F.col("level") == 0) & (F.col("block") == 0))
    depth = F.col("block") * WIDTH + F.col("level")
    x = _node(depth)
    up = _node(depth - 1, F.col("level") - 1)
    root, first = F.col("level") == 0, F.col("level") == 1
    before = F.when(first, F.col("start")).otherwise(
        F.coalesce(*[F.when(F.col("level") == j, F.col(f"q{j - 1}")) for j in range(2, WIDTH + 1)], F.lit(0)))
    names = [c for c in found.columns if c not in {"k1", "k2", "block", "gid", "level", "start", *T}
             and not (c[0] == "q" and c[1:].isdigit())]
    return found.select(
        depth.alias("depth"),
        *[F.when(root, F.lit(0)).otherwise(F.col(f"k{i}").bitwiseXOR(x[i - 1])).cast("bigint").alias(f"x{i}") for i in (1, 2)],
        *[F.when(first, F.col(f"k{i}")).when(~root, F.col(f"k{i}").bitwiseXOR(up[i - 1])).alias(f"p{i}") for i in (1, 2)],
        before.alias("above"), *names)


def branches(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes with their owners, and for each owner the highest node it owns (f, its parent's key, code points above)."""
    nodes = materialize(rollup(rows, "min(conv) AS conv"), "trie-owners")
    tops = nodes.groupBy("conv").agg(F.min(F.struct("depth", "p1", "p2", "above")).alias("top")) \
        .select("conv", F.col("top.depth").alias("f"), "top.p1", "top.p2", F.col("top.above").alias("g"))
    return nodes, materialize(tops, "trie-tops")


def _digests(ended: DataFrame) -> DataFrame:
    """x1, x2, ends_sha256 over (x1, x2, conv): the decimal ids in ascending order, joined by commas."""
    order = ["x1", "x2", "conv"]
    texts = ended.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _chunk, "x1 bigint, x2 bigint, first bigint, ids string")
    return texts.repartition("x1", "x2").sortWithinPartitions("x1", "x2", "first").mapInArrow(
        _hash, "x1 bigint, x2 bigint, ends_sha256 string")


def _chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of up to CHUNK_IDS ids of a node, in order."""
    def flush(done):
        return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate(
            (pa.int64(), pa.int64(), pa.int64(), pa.string()))], ["x1", "x2", "first", "ids"])

    node, ids, done = None, [], []
    for batch in batches:
        for x1, x2, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if (x1, x2) != node or len(ids) >= CHUNK_IDS:
                if ids:
                    done.append((*node, ids[0], ",".join(map(str, ids))))
                node, ids = (x1, x2), []
            ids.append(conv)
        if len(done) >= CHUNK_IDS:
            yield flush(done)
            done = []
    if ids:
        done.append((*node, ids[0], ",".join(map(str, ids))))
    if done:
        yield flush(done)


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's texts, one after another."""
    def flush(done):
        return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate(
            (pa.int64(), pa.int64(), pa.string()))], ["x1", "x2", "ends_sha256"])

    node, state, done = None, None, []
    for batch in batches:
        for x1, x2, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if (x1, x2) != node:
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = (x1, x2), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        if len(done) >= CHUNK_IDS:
            yield flush(done)
            done = []
    if node is not None:
        done.append((*node, state.hexdigest()))
    if done:
        yield flush(done)


NONE_SHA256 = hashlib.sha256(b"").hexdigest()


def trie(conversations: DataFrame) -> DataFrame:
    """One row for each node; see the module's first lines."""
    turns = numbered(conversations)
    sizes = materialize(turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n")), "trie-sizes")
    rows = blocks(turns, sizes)
    nodes, tops = branches(rows)

    # one row for each conversation: its length and the node it ends at (the key of its last block's last turn)
    depth = F.col("block") * WIDTH + F.col("n")
    x = _node(depth)
    lasts = rows.groupBy("conv").agg(F.max("block").alias("block"))
    lasts = rows.join(lasts, ["conv", "block"], "left_semi").select(
        "conv", depth.alias("l"), F.coalesce(*[F.when(F.col("n") == j, F.col(f"q{j}")) for j in range(1, WIDTH + 1)],
                                             F.lit(0)).alias("total"),
        *[F.when(F.col("n") == 0, F.lit(0)).otherwise(F.col(f"k{i}").bitwiseXOR(x[i - 1])).cast("bigint").alias(f"e{i}")
          for i in (1, 2)])
    lasts = materialize(lasts, "trie-ends")

    # nodes under which other owners begin: their number of such children and their owner
    children = tops.where("p1 is not null").groupBy("p1", "p2").agg(F.count(F.lit(1)).alias("n"))
    parents = children.join(nodes.select(F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("conv").alias("parent")),
                            ["p1", "p2"])
    parents = materialize(parents, "trie-parents")
    begun = join_split(tops, parents.select("p1", "p2", "parent"), ["p1", "p2"], parents.select("p1", "p2", "n"))
    convs = lasts.join(begun.select("conv", "f", "g", "parent"), "conv", "left")
    # a conversation that owns nothing is a prefix of a smaller one: all its turns are shared
    inner = parents.select(F.col("p1").alias("e1"), F.col("p2").alias("e2"), F.lit(True).alias("inner"))
    owners = convs.where("f is not null").join(inner, ["e1", "e2"], "left").select(
        "conv", "l", "f", "g", "parent", F.col("inner").isNull().cast("int").alias("leaf"))
    others = convs.where("f is null").select("conv", "l", "f", F.col("total").alias("g"), "parent", F.lit(0).alias("leaf"))
    per_conv = materialize(owners.unionByName(others), "trie-convs")
    drop(nodes, tops)

    n_blocks = sizes.select("conv", (F.col("n") / WIDTH + 1).cast("bigint").alias("n"))
    valued = join_split(rows, per_conv, ["conv"], n_blocks, "inner")
    found = rollup(valued, "min(struct(conv, l, f, g, parent)) AS o, count(*) AS n_convs, sum(g) AS g, sum(leaf) AS n_leaves")
    ends = lasts.select(F.col("e1").alias("x1"), F.col("e2").alias("x2"), "conv")
    more = parents.select(F.col("p1").alias("x1"), F.col("p2").alias("x2"), F.col("n").alias("more"))
    full = found.join(more, ["x1", "x2"], "left").join(_digests(ends), ["x1", "x2"], "left")
    return full.select(
        F.col("o.conv").alias("conv_id"), "depth",
        F.when(F.col("depth") == F.col("o.f"), F.col("o.parent")).otherwise(F.col("o.conv")).alias("parent_conv_id"),
        "n_convs", ((F.col("o.l") > F.col("depth")).cast("bigint") + F.coalesce("more", F.lit(0))).alias("n_children"),
        F.col("n_leaves").cast("bigint").alias("n_leaves"),
        (F.col("g") - F.col("o.g") - (F.col("n_convs") - 1) * F.col("above")).cast("bigint").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NONE_SHA256)).alias("ends_sha256"))
