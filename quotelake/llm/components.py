"""Distributed union-find, and exact similarity components over candidate buckets.

``connected`` alternates the large-star and small-star steps until the edge
set stops changing; every step is a shuffle of edges, so no component is ever
gathered in one task or on the driver.

``similarity_components`` finds the components of the relation
``100 * |A∩B| >= percent * |A∪B|`` between sets whose bands share a bucket.
No bucket is expanded into all its pairs: members are first linked to centres
of their buckets and verified; sets that provably reach nobody are put aside
(too many of their elements occur in no set that they could still be linked
with); of the others only pairs that share one of their rarest differences from
what is usual in their cluster are compared (``_differences``, ``_prefix_pairs``).
The result is the same as if every candidate pair had been verified.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop, materialize

STAR_ROUNDS = 3
SHARE = 3  # shared elements are counted among one element of so many


def _is_forest(edges: DataFrame) -> bool:
    """Does every a have one b only, and is no a itself a b?"""
    ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")) \
        .unionByName(edges.select(F.col("b").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    return ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into")) \
        .where("out > 1 or (out = 1 and into = 1)").isEmpty()


def connected(edges: DataFrame, made: list | None = None) -> DataFrame:
    """Rows (node, component): component is the smallest node reachable.

    The rows are read from a written table; with ``made`` it is added there, to
    be dropped after its last reader.

    ``edges`` has columns a, b of one orderable type.  Only nodes with an edge
    to another node are returned.  Self loops and repeated edges do no harm.
    """
    cur = materialize(edges.where("a <> b")
                      .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    while not _is_forest(cur):
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b")
        was, cur = cur, materialize(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
        drop(was)
    if made is not None:
        made.append(cur)
    pairs = cur.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return pairs.unionByName(cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def stored(raw: bytes) -> np.ndarray:
    """A set kept as its sorted 64-bit elements."""
    return np.frombuffer(raw, np.uint64)


def overlaps(batches: Iterator[pa.RecordBatch], percent: int,
             decode: Callable[[bytes], np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Keep the pairs (a, b) whose sets sa, sb reach ``percent``."""
    for batch in batches:
        sa, sb = batch.column("sa").to_pylist(), batch.column("sb").to_pylist()
        keep = np.zeros(batch.num_rows, bool)
        raw = y = None
        for i, (x, again) in enumerate(zip(sa, sb)):
            x = decode(x)
            if again != raw:  # the pairs of one centre follow each other
                raw, y = again, decode(again)
            if min(len(x), len(y)) * 100 < percent * max(len(x), len(y)) or not len(x):
                continue
            at = np.searchsorted(y, x)
            at[at == len(y)] = 0
            both = int((y[at] == x).sum())
            keep[i] = 100 * both >= percent * (len(x) + len(y) - both)
        out = batch.select(["a", "b"]).filter(pa.array(keep))
        if out.num_rows:
            yield out


def similarity_components(nodes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int,
                          likely: Callable[[str, str], Column] | None = None,
                          decode: Callable[[bytes], np.ndarray] = stored) -> DataFrame:
    """Rows (node, component) for every node linked to another.

    nodes: node, buckets array<bigint>, and a signature column ``sig`` if
    ``likely`` (a condition on two signature columns) is given.
    sets_of: gets a DataFrame of column node, returns node, set (binary), size
    (number of elements); ``decode`` turns the binary into the sorted elements.
    """
    made: list[DataFrame] = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        made.append(materialize(df, name))
        return made[-1]

    def done(result: DataFrame) -> DataFrame:
        """The result in a table of its own, all others dropped."""
        result = materialize(result, "components")
        drop(*made)
        return result

    node_t = nodes.schema["node"].dataType.simpleString()
    extra = ["size"] + (["sig"] if likely is not None else [])
    member = nodes.select("node", F.explode("buckets").alias("bucket"))
    shared = member.groupBy("bucket").agg(F.min("node").alias("centre"), F.max("node").alias("top")) \
        .where("centre <> top").drop("top")
    in_shared = keep(member.join(shared, "bucket"), "buckets")

    # rows that share a node stand for one set
    sets = keep(sets_of(in_shared.select("node").distinct()).groupBy("node").agg(
        F.min(F.struct("set", "size")).alias("s")).select("node", "s.*"), "sets")
    cand = sets.select("node", "size")
    if likely is not None:
        cand = keep(cand.join(nodes.select("node", "sig"), "node"), "candidates")

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose full sets reach the threshold."""
        full = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a") \
            .join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b")
        return full.select("a", "b", "sa", "sb").mapInArrow(
            lambda it: overlaps(it, percent, decode), f"a {node_t}, b {node_t}")

    def check(pairs: DataFrame) -> DataFrame:
        """Verified links among distinct pairs (a, b)."""
        left = cand.select(F.col("node").alias("a"), *[F.col(c).alias(f"a_{c}") for c in extra])
        right = cand.select(F.col("node").alias("b"), *[F.col(c).alias(f"b_{c}") for c in extra])
        pairs = pairs.join(left, "a").join(right, "b") \
            .where(F.least("a_size", "b_size") * 100 >= F.greatest("a_size", "b_size") * percent)
        if likely is not None:
            pairs = pairs.where(likely("a_sig", "b_sig"))
        return verified(pairs.select("a", "b"))

    def ordered(df: DataFrame, x: str, y: str) -> DataFrame:
        return df.where(F.col(x) != F.col(y)).select(
            F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct()

    comp = None

    def merged(found: DataFrame) -> DataFrame:
        """The components so far joined by new links, which are taken between components."""
        if comp is None:
            return connected(found, made)
        ends = labelled(labelled(found, "a", "la"), "b", "lb")
        joined = connected(ends.select(F.col("la").alias("a"), F.col("lb").alias("b")), made)
        moved = joined.select(F.col("node").alias("_was"), F.col("component").alias("_now"))
        grown = comp.join(moved, F.col("component") == F.col("_was"), "left") \
            .select("node", F.coalesce("_now", "component").alias("component"))
        return keep(grown.unionByName(joined.join(comp.select("node"), "node", "left_anti")), "components")

    def labelled(df: DataFrame, key: str, name: str) -> DataFrame:
        if comp is None:
            return df.withColumn(name, F.col(key))
        return df.join(comp.select(F.col("node").alias(key), F.col("component").alias(f"_{name}")), key, "left") \
            .withColumn(name, F.coalesce(f"_{name}", key)).drop(f"_{name}")

    for turn in range(STAR_ROUNDS):
        if turn == 0:
            star = in_shared.select("node", "centre")
        else:
            # another centre for each bucket, drawn anew in each turn
            centre = open_members.groupBy("bucket").agg(
                F.min_by("node", F.xxhash64("node", "bucket", F.lit(turn))).alias("centre2"))
            star = labelled(open_members.join(centre, "bucket"), "centre2", "c2") \
                .where("label <> c2").select("node", F.col("centre2").alias("centre"))
        found = keep(check(ordered(star, "node", "centre")), "links")
        if turn and found.isEmpty():
            break
        comp = merged(found)
        # buckets whose members still lie in different components (a closed one stays closed)
        lab = keep(labelled(in_shared.select("bucket", "node") if turn == 0 else
                                   open_members.select("bucket", "node"), "node", "label"), "labels")
        open_b = lab.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y"),
                                           F.count(F.lit(1)).alias("n")).where("x <> y and n > 2").select("bucket")
        open_members = keep(lab.join(open_b, "bucket"), "open")
        if turn == 0:  # later turns read the open buckets only
            drop(in_shared)
            made.remove(in_shared)
        if open_members.isEmpty():
            return done(comp)

    # Only sets of open buckets under different labels are still to be compared.
    # A set of size n can lack at most n * (1 - percent) of its elements in its
    # partner, of all of them and so of those in any share of the hash space.
    # Elements of one share, counted where sets of other labels have them too,
    # put aside the sets that can't have a partner.
    # A cluster is what open buckets connect.
    edges = open_members.join(open_members.groupBy("bucket").agg(F.min("node").alias("b")), "bucket")
    cluster = connected(edges.select(F.col("node").alias("a"), "b"), made).withColumnRenamed("component", "cluster")
    todo = keep(open_members.select("node", "label").distinct().join(cluster, "node"), "clusters")
    rows = sets.join(todo, "node").select("cluster", "label", "node", "set").mapInArrow(
        lambda it: _explode(it, decode, percent),
        f"cluster {node_t}, label {node_t}, node {node_t}, need int, element bigint")
    common = rows.where("element is not null").groupBy("cluster", "element") \
        .agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi") \
        .select("cluster", "element", F.lit(1).alias("hit"))
    able = rows.drop("label").join(common, ["cluster", "element"], "left").groupBy("node") \
        .agg(F.count("hit").alias("k"), F.max("need").alias("need")).where("k >= need").select("node")
    able = keep(able.join(todo, "node").join(sets, "node"), "able")
    differ = keep(_differences(able, percent, decode, node_t), "differences")

    # Links that need no comparison: score(a) + score(b) <= 0 (see _differences).
    # The least score of a cluster reaches all sets that any set reaches so.
    def least(df: DataFrame) -> DataFrame:
        return df.groupBy("cluster").agg(F.min(F.struct("score", "node", "label")).alias("best"))

    sure = differ.join(least(differ), "cluster").where("score + best.score <= 0 and label <> best.label") \
        .select(F.col("node").alias("a"), F.col("best.node").alias("b"))
    sure = keep(sure, "links")
    if not sure.isEmpty():
        comp = merged(sure)
        differ = keep(labelled(differ.drop("label"), "node", "label"), "differences")
    pairs = _prefix_pairs(differ, least(differ), percent)
    found = keep(check(pairs), "links")
    return done(comp if found.isEmpty() else merged(found))


def _differences(able: DataFrame, percent: int, decode: Callable[[bytes], np.ndarray], node_t: str) -> DataFrame:
    """cluster, label, node, score, short, diff of each set: how it differs from what is usual in its cluster.

    ``diff`` is the symmetric difference to the elements U that more than half
    of the cluster's sets have (at most twice as many as a set has on average).
    With t = (100 - percent) / (100 + percent), A and B reach the threshold if
    and only if their symmetric difference, which is that of their diffs, has at
    most t * (|A| + |B|) elements.  score = (100 + percent) * (|diff| - t * |A|):
    a pair whose scores add up to 0 or less reaches it whatever it shares, and
    any other has to share (score + score) / (2 * (100 + percent)) elements of
    its diffs, and at least ``short`` = percent of |A|, less those of A in U.
    So near copies that differ at places of their own are never compared.
    """
    elements = able.select("cluster", "set").mapInArrow(
        lambda it: _flat(it, decode), f"cluster {node_t}, element bigint")
    salts = 16
    many = able.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    usual = elements.groupBy("cluster", "element").agg(F.count(F.lit(1)).alias("c")).where("c > 1") \
        .withColumn("salt", F.pmod(F.xxhash64("element"), F.lit(salts)).cast("int")) \
        .join(many, ["cluster", "salt"]).where("2 * c > n") \
        .groupBy("cluster").agg(F.collect_list("element").alias("usual"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.uint64)
        for batch in batches:
            score, short, diff, last, u = [], [], [], None, none
            for raw, again in zip(batch.column("set"), batch.column("usual")):
                if last is None or again != last:  # the sets of a cluster follow each other
                    last = again
                    u = np.sort(again.values.to_numpy(zero_copy_only=False).view(np.uint64)) if again.is_valid else none
                x = decode(raw.as_py())
                d = np.setxor1d(x, u, assume_unique=True)
                score.append(len(d) * (100 + percent) - (100 - percent) * len(x))
                short.append(-(-percent * len(x) // 100) - (len(x) + len(u) - len(d)) // 2)
                diff.append(d.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("cluster", "label", "node")), pa.array(score, pa.int64()),
                 pa.array(short, pa.int64()), pa.array(diff, pa.list_(pa.int64()))],
                names=["cluster", "label", "node", "score", "short", "diff"])

    return able.join(usual, "cluster", "left").select("cluster", "label", "node", "set", "usual").mapInArrow(
        run, f"cluster {node_t}, label {node_t}, node {node_t}, score bigint, short bigint, diff array<bigint>")


def _prefix_pairs(differ: DataFrame, best: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of other labels that may reach the threshold, by their rarest differences.

    Of the elements of a diff that sets of other labels have too, in order of
    their number, a pair that has to share k shares one among all but the last
    k - 1 on either side, and enough are left there on both sides.
    """
    unit = 2 * (100 + percent)
    other = differ.join(best, "cluster").where("label <> best.label").groupBy("cluster").agg(F.min("score").alias("next"))
    need = F.greatest(F.lit(1), F.col("short"), F.ceil(
        (F.col("score") + F.when(F.col("label") == F.col("best.label"), F.col("next")).otherwise(F.col("best.score"))) / unit))
    # one column for cluster and element: the shuffle must deal out a large cluster, and not reuse that of the join
    rows = differ.join(best.join(other, "cluster"), "cluster") \
        .select("cluster", "label", "node", "score", need.alias("need"), F.explode("diff").alias("element")) \
        .select("label", "node", "score", "need", F.struct("cluster", "element").alias("place"))
    common = rows.groupBy("place").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("n")).where("lo <> hi") \
        .select("place", "n")
    prefix = rows.join(common, "place").groupBy("node") \
        .agg(F.first("label").alias("label"), F.first("score").alias("score"),
             F.first("need").alias("need"), F.sort_array(F.collect_list(F.struct("n", "place"))).alias("rare")) \
        .where("size(rare) >= need") \
        .select("node", "label", "score", F.size("rare").alias("len"), F.posexplode(
            F.expr("slice(rare, 1, cast(size(rare) - need + 1 as int))")).alias("at", "e")) \
        .select("e.place", "node", "label", "score", (F.col("len") - F.col("at")).alias("rest"))
    left = prefix.select("place", F.col("node").alias("a"), F.col("label").alias("la"),
                         F.col("score").alias("sa"), F.col("rest").alias("ra"))
    right = prefix.select("place", F.col("node").alias("b"), F.col("label").alias("lb"),
                          F.col("score").alias("sb"), F.col("rest").alias("rb"))
    on = (left["place"] == right["place"]) & (F.col("a") > F.col("b")) \
        & (F.col("la") != F.col("lb")) & (F.col("sa") + F.col("sb") <= unit * F.least("ra", "rb"))
    return left.join(right, on).select("a", "b").distinct()


def _flat(batches: Iterator[pa.RecordBatch], decode: Callable[[bytes], np.ndarray]) -> Iterator[pa.RecordBatch]:
    """One row for each element of each set."""
    for batch in batches:
        raw = batch.column("set").to_pylist()
        for lo in range(0, len(raw), 500):
            arrays = [decode(x) for x in raw[lo:lo + 500]]
            at = np.repeat(np.arange(len(arrays)), [len(x) for x in arrays]) + lo
            yield pa.RecordBatch.from_arrays(
                [batch.column("cluster").take(pa.array(at)), pa.array(np.concatenate(arrays).view(np.int64))],
                names=["cluster", "element"])


def _explode(batches: Iterator[pa.RecordBatch], decode: Callable[[bytes], np.ndarray], percent: int) -> Iterator[pa.RecordBatch]:
    """One row for each element in 1/SHARE of the hash space (a null one if there is none).

    ``need``: how many of them a partner has at least.
    """
    for batch in batches:
        raw = batch.column("set").to_pylist()
        for lo in range(0, len(raw), 500):
            arrays, need = [decode(x) for x in raw[lo:lo + 500]], []
            for i, x in enumerate(arrays):
                arrays[i] = x[x % np.uint64(SHARE) == 0]
                need.append(len(arrays[i]) - len(x) * (100 - percent) // 100)
            n = np.array([max(len(x), 1) for x in arrays])
            at = np.repeat(np.arange(len(arrays)), n)
            none = np.repeat(np.array([not len(x) for x in arrays], bool), n)
            flat = np.concatenate([x if len(x) else np.zeros(1, np.uint64) for x in arrays]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(pa.array(at + lo)) for c in ("cluster", "label", "node")),
                 pa.array(np.array(need, np.int32)[at]), pa.array(flat, mask=none)],
                names=["cluster", "label", "node", "need", "element"])
