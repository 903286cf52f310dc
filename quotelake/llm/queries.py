"""The thin ``opN_<name>`` queries: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import adaptive_scan, bbit_minhash, bpe_fst, chaining, curriculum, filter_audit, fuzzy_lines, line_crf, ppm, prefix_free, prefix_trie, \
    suffix_repetition, token_counts
from .common import documents, remainder

QUERIES = {}
ORACLES = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


ORACLES["op8_curriculum"] = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(CAST(doc_id AS VARCHAR)) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
n AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM s),
w AS (SELECT *, CAST(i % 3 + 1 AS DOUBLE) AS wt, 3 * source_size AS cap,
             CASE i % 3 WHEN 0 THEN 0.5 WHEN 1 THEN 0.0 ELSE -0.5 END::DOUBLE AS slope FROM n),
f AS (SELECT *, row_number() OVER (ORDER BY cap / wt, i) AS rk,
        CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / wt, i
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
        / sum(wt) OVER (ORDER BY cap / wt, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl FROM w),
g AS (SELECT *, min(CASE WHEN NOT (cap < lvl * wt) THEN rk END) OVER () AS first_open FROM f),
o AS (SELECT *, max(CASE WHEN rk = first_open THEN lvl END) OVER () AS open_lvl FROM g),
t AS (SELECT *, CASE WHEN rk < coalesce(first_open, 1000000000) THEN CAST(cap AS DOUBLE)
                     ELSE least(CAST(cap AS DOUBLE), open_lvl * wt) END AS target FROM o),
x AS (SELECT d.*, t.source_size, t.target, t.slope, CAST(round(t.target) AS BIGINT) AS goal,
             CASE WHEN t.source_size > 0 THEN CAST(round(t.target) AS BIGINT) // t.source_size ELSE 0 END AS whole,
             CAST(coalesce(sum(size) OVER (PARTITION BY d.source
               ORDER BY CAST('0x' || substr(h, 1, 8) AS BIGINT) % 4096, h, doc_id, size
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (SELECT *, CAST(whole * size + least(greatest(goal - whole * source_size - before, 0), size) AS BIGINT) AS taken
      FROM x),
u AS (SELECT *, CASE WHEN target > 0 THEN least((before + least(size, taken) / 2) / target, 1.0) ELSE 0.0 END AS u,
             1 - slope AS b FROM k)
SELECT doc_id, source, size, source_size, target, taken,
       CASE WHEN taken > 0 THEN CASE WHEN abs(slope) < 1e-9 THEN u
            ELSE 2 * u / (b + sqrt(b * b + 4 * slope * u)) END END AS first_position
FROM u"""


@register
def op3_bpe_transducer(spark, sf_dir):
    return bpe_fst.digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                           public_tokenizers.PATTERN)


@register
def op5_line_crf(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = line_crf.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return line_crf.scores(docs, model).select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score",
        F.when(F.col("score") >= line_crf.THRESHOLD, 1).otherwise(0).alias("predicted"))


@register
def op8_curriculum(spark, sf_dir):
    p = curriculum.plan(documents(spark, sf_dir).select("doc_id", "text", "source"))
    first = curriculum.position(F.col("_mix_before") + F.least("size", "taken") / 2, F.col("target"), F.col("slope"))
    return p.select("doc_id", "source", "size", "source_size", "target", "taken",
                    F.when(F.col("taken") > 0, first).alias("first_position"))


@register
def op10_bbit_minhash(spark, sf_dir):
    return bbit_minhash.near_duplicates(documents(spark, sf_dir), width=3, percent=85, rows=8)


@register
def op1_suffix_repetition(spark, sf_dir):
    return suffix_repetition.rules(documents(spark, sf_dir))


@register
def op4_fuzzy_lines(spark, sf_dir):
    """doc_id, n_lines, n_dropped, dropped_lines, kept of every row (null id: nothing dropped)."""
    docs = documents(spark, sf_dir)
    got = fuzzy_lines.line_decisions(docs).withColumnRenamed("id", "_id")
    n, cut = F.coalesce("n_lines", F.lit(0)), F.coalesce(F.size("dropped"), F.lit(0))
    cut = F.greatest(cut, F.lit(0))
    return docs.select("doc_id").join(got, F.col("doc_id") == F.col("_id"), "left").select(
        "doc_id", n.cast("bigint").alias("n_lines"), cut.cast("bigint").alias("n_dropped"),
        F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped_lines"),
        ((cut == 0) | (cut < n)).alias("kept"))


@register
def op6_adaptive_scan(spark, sf_dir):
    return adaptive_scan.neighbours(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@register
def op2_ppm(spark, sf_dir):
    return ppm.score(documents(spark, sf_dir))


@register
def op9_prefix_free(spark, sf_dir):
    return prefix_free.dedup(documents(spark, sf_dir)).drop("removed")


@register
def op7_chaining(spark, sf_dir):
    """One row for each fuzzy passage of a document that an earlier document (other_id) holds too."""
    return chaining.passages(documents(spark, sf_dir))


@register
def op11_token_counts(spark, sf_dir):
    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                                     public_tokenizers.PATTERN)


# crc32 bit by bit: the first item is the start, an item of 0 or more a byte, -1 a shift
ORACLES["op12_prefix_trie"] = r"""
WITH t AS (
  SELECT conv_id AS c, len(coalesce(text, '')) AS n,
         sha256(len(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
         turn FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, id) AS pos FROM t),
k AS (SELECT c, c - c % 100 AS base, xor(list_reduce(
        [4294967295::BIGINT] || flatten([[ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]
                                         for x in string_split(c::VARCHAR, '')]),
        lambda a, i: CASE WHEN i >= 0 THEN xor(a, i)
                          ELSE xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END) END),
        4294967295) % 6 AS h FROM (SELECT DISTINCT c FROM o) s),
r AS (SELECT c, n, id, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS d FROM (
        SELECT k.c, o.n, o.id, 0 AS part, o.pos FROM k JOIN o ON o.c = k.base AND o.pos <= k.h
        UNION ALL SELECT k.c, o.n, o.id, 1, o.pos FROM k JOIN o ON o.c = k.c AND o.pos > k.h) b),
p AS (SELECT c, d, n, sha256(string_agg(id, ',') OVER (PARTITION BY c ORDER BY d)) AS node FROM r
      UNION ALL SELECT c, 0, 0, '' FROM k),
l AS (SELECT c, max(d) AS l FROM p GROUP BY c),
m AS (SELECT p.d, p.node, min(p.c) AS c, count(*) AS n_convs, any_value(p.n) AS n,
             string_agg(p.c::VARCHAR, ',' ORDER BY p.c) FILTER (WHERE p.d = l.l) AS ends
      FROM p JOIN l ON p.c = l.c GROUP BY p.d, p.node),
u AS (SELECT m.*, q.node AS up FROM m LEFT JOIN p q ON q.c = m.c AND q.d = m.d - 1),
ch AS (SELECT d - 1 AS d, up AS node, count(*) AS n FROM u WHERE d > 0 GROUP BY ALL),
f AS (SELECT m.*, coalesce(ch.n, 0) AS n_children FROM m LEFT JOIN ch ON ch.d = m.d AND ch.node = m.node),
s AS (SELECT a.d, a.node, count(*) FILTER (WHERE f.n_children = 0) AS n_leaves, sum((f.n_convs - 1) * f.n) AS saved
      FROM f JOIN p a ON a.c = f.c AND a.d <= f.d GROUP BY a.d, a.node)
SELECT f.c AS conv_id, f.d AS depth, pm.c AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(f.ends, '')) AS ends_sha256
FROM f JOIN u ON u.d = f.d AND u.node = f.node JOIN s ON s.d = f.d AND s.node = f.node
LEFT JOIN m pm ON pm.d = f.d - 1 AND pm.node = u.up"""


@register
def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


ORACLES["op13_filter_audit"] = r"""
WITH t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x,
         regexp_extract_all(coalesce(text, ''), '[^ 	-]+') AS w FROM documents),
g AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic
      FROM labels GROUP BY doc_id),
d AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
         + CASE WHEN 100 * (len(x) - len(regexp_replace(x, '[A-Z]', '', 'g'))) > 2 * len(x) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(x, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN t.doc_id > min(t.doc_id) OVER (PARTITION BY x) THEN 16 ELSE 0 END AS mask
  FROM t LEFT JOIN g ON t.doc_id = g.doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM d GROUP BY part, mask),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(letter, bit)),
o AS (SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
      FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
        AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
s AS (SELECT filter_order, step, f.bit,
             (SELECT coalesce(sum(g.bit), 0) FROM f g WHERE strpos(filter_order, g.letter) < step) AS before
      FROM o, (SELECT unnest(range(1, 6)) AS step) k, f WHERE strpos(filter_order, f.letter) = step),
r AS (SELECT c.part, s.filter_order, s.step, s.bit,
        sum(n) FILTER (WHERE mask & before = 0 AND mask & bit = 0) AS kept,
        sum(n) FILTER (WHERE mask & before = 0 AND mask & bit <> 0) AS removed,
        sum(n) FILTER (WHERE mask & before <> 0 AND mask & bit <> 0) AS redundant,
        sum(n) FILTER (WHERE mask = bit) AS unique_fails,
        sum(good) FILTER (WHERE mask & before = 0 AND mask & bit <> 0) AS good_lost,
        sum(toxic) FILTER (WHERE mask & before = 0 AND mask & bit <> 0) AS toxic_lost
      FROM (SELECT part, CAST(mask AS BIGINT) AS mask, n, good, toxic FROM c) c,
           (SELECT filter_order, step, CAST(bit AS BIGINT) AS bit, CAST(before AS BIGINT) AS before FROM s) s
      GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept,
       CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
       CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
       CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, bit), 0) AS BIGINT) AS shapley
FROM r"""


@register
def op13_filter_audit(spark, sf_dir):
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
