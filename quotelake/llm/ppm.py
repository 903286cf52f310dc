"""Language-model scores by prediction by partial matching over bytes.

The model is a byte-context trie of order ``ORDER``, trained on counts of the
training texts (A-Z as a-z, with a boundary symbol before and after each
text).  A symbol's probability follows method C: in the longest context seen,
``count / (total + distinct)``, or the escape ``distinct / (total + distinct)``
to the next shorter context, where the symbols of the longer one are excluded;
last, an equal share among the symbols never seen.  A text's score is the sum
over its bytes and its end; the pretrained counts stay as they are.

How it is spread: documents are dealt to chunks of about ``CHUNK_BYTES``.
Each chunk walks its texts along a trie of its own and reports every distinct
(context, symbol) once, with its training count, so what is shuffled grows
with the corpus and not with its positions.  Keys are dealt by their hash to
``PARTS_PER_CHUNK`` parts for each chunk and packed in arrays; a part sums the
counts of all chunks and stays about as large however big the corpus is.  The
distinct (context, symbol) are then dealt by the two symbols next to the
predicted one, so that each part of the trie holds all its longer contexts
(orders 1 and 0 are a table of at most 257*257 counts), and get their costs.
The costs go back to the chunks that asked, where the same walk adds them up.
Words of the base score take the same way, by 64-bit hashes.  No table of the
whole corpus is sent to the driver or broadcast.

Null texts count as empty; an empty text has only its end.  Repeated rows are
scored and counted each.  Without training rows all symbols are equally
likely.  Extra columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, lower_ascii, materialize, mix64, prefix_hash, remainder, span_hash, utf8_buffer, word_spans

ORDER = 5
CHUNK_BYTES = 8 << 20
PARTS_PER_CHUNK = 4
SUFFIX_PARTS = 128
_B = 256  # the boundary symbol; 9 bits each


def _mask(symbols: int) -> int:
    return (1 << (9 * symbols)) - 1


def walk(raw: np.ndarray, off: np.ndarray, order: int = ORDER):
    """Trie nodes of all predicted symbols of these (lower-cased) texts.

    Returns node (one for each predicted symbol, in order), the code of each
    node ascending, and the offsets of the texts among the predicted symbols.
    """
    n = np.diff(off)
    texts = len(n)
    begin = np.concatenate([[0], np.cumsum(n + order + 1)])
    seq = np.full(begin[-1], _B, np.uint16)
    row = np.repeat(np.arange(texts), n)
    seq[np.arange(len(raw)) + (row + 1) * order + row] = raw
    told = np.ones(len(seq), bool)
    for k in range(order):
        told[begin[:-1] + k] = False
    used = np.flatnonzero(np.bincount(seq, minlength=257))
    a = len(used)
    dense = np.zeros(257, np.int32)
    dense[used] = np.arange(a)
    sym = dense[seq]
    node, code = sym, used.astype(np.int64)
    for level in range(1, order + 1):
        wide = np.int64 if len(code) * a >= 1 << 31 else np.int32
        key = node[:-1].astype(wide) * wide(a) + sym[1:]
        here = key if level < order else key[told[order:]]
        flag = np.zeros(len(code) * a, bool)
        flag[here] = True
        found = np.flatnonzero(flag)
        rank = np.zeros(len(flag), np.int32)
        rank[found] = np.arange(len(found), dtype=np.int32)
        node = rank[here]
        code = (code[found // a] << 9) | used[found % a]
        sym = sym[1:]
    return node, code, begin - np.arange(texts + 1) * order


def costs(gram: np.ndarray, count: np.ndarray, low_key: np.ndarray, low_count: np.ndarray,
          order: int = ORDER) -> np.ndarray:
    """log10 probability of each (context, symbol).

    gram: codes sorted; count: training counts (0: not in the trie).  The
    grams share no two-symbol suffix of the context with grams elsewhere.
    low_key, low_count: the whole table of order 1 (sorted).
    """
    seen = count > 0
    key, cnt = {order: gram[seen]}, {order: count[seen]}
    for j in range(order - 1, 1, -1):
        k, inv = np.unique(key[j + 1] & _mask(j + 1), return_inverse=True)
        key[j], cnt[j] = k, np.bincount(inv, cnt[j + 1], len(k)).astype(np.int64)
    key[1], cnt[1] = low_key, low_count
    k0, inv = np.unique(low_key & _mask(1), return_inverse=True)
    key[0], cnt[0] = k0, np.bincount(inv, low_count, len(k0)).astype(np.int64)

    def find(table: np.ndarray, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(table):
            return np.zeros(len(want), np.int64), np.zeros(len(want), bool)
        at = np.minimum(np.searchsorted(table, want), len(table) - 1)
        return at, table[at] == want

    ctx, total, distinct, shared = {}, {}, {}, {}
    for j in range(order + 1):
        ctx[j], inv = np.unique(key[j] >> 9, return_inverse=True)
        total[j] = np.bincount(inv, cnt[j], len(ctx[j]))
        distinct[j] = np.bincount(inv, minlength=len(ctx[j]))
        if j:
            at, ok = find(key[j - 1], key[j] & _mask(j))
            # what the symbols of this context count for in the next shorter one
            shared[j] = np.bincount(inv, np.where(ok, cnt[j - 1][at] if len(cnt[j - 1]) else 0, 0), len(ctx[j]))
    out = np.zeros(len(gram))
    todo = np.ones(len(gram), bool)
    above, above_at = np.zeros(len(gram), bool), np.zeros(len(gram), np.int64)
    for j in range(order, -1, -1):
        at, exists = find(ctx[j], (gram & _mask(j + 1)) >> 9)
        if not len(ctx[j]):
            continue
        tot, dis = total[j][at].astype(np.float64), distinct[j][at].astype(np.float64)
        if j < order and len(ctx[j + 1]):
            up = np.minimum(above_at, len(ctx[j + 1]) - 1)
            tot = tot - np.where(above, shared[j + 1][up], 0)
            dis = dis - np.where(above, distinct[j + 1][up], 0)
        where, hit = find(key[j], gram & _mask(j + 1))
        hit &= todo & exists
        den = tot + dis
        out[hit] += np.log10(cnt[j][where[hit]] / den[hit])
        esc = todo & exists & ~hit & (dis > 0)
        out[esc] += np.log10(dis[esc] / den[esc])
        todo &= ~hit
        above, above_at = exists, at
    out[todo] -= np.log10(257 - len(key[0]))
    return out


#: The end of a text, as a key among word hashes.
_END = np.uint64(0x5851F42D4C957F2D)


def _words(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the number of words of each text (hashed a piece at a time)."""
    hashes, counts, i = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    while i < len(off) - 1:
        j = max(int(np.searchsorted(off, off[i] + (1 << 20))), i + 1)
        j = min(j, len(off) - 1)
        piece = raw[off[i]: off[j]]
        start, end, n = word_spans(piece, off[i: j + 1] - off[i])
        hashes.append(span_hash(prefix_hash(piece), start, end))
        counts.append(n)
        i = j
    return np.concatenate(hashes), np.concatenate(counts)


def _packed(keys: np.ndarray, parts: int):
    """Order of the keys by part (ascending inside), part numbers, and bounds."""
    part = (mix64(keys.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
    by = np.argsort(part, kind="stable")
    used, first = np.unique(part[by], return_index=True)
    return by, used, np.append(first, len(by))


def _rows(kind: int, parts: int, keys: np.ndarray, values: np.ndarray, extra: dict) -> pa.Table:
    """One row for each part, with its keys and values as bytes."""
    by, used, at = _packed(keys, parts)
    k, v = keys[by], values[by]
    n = len(used)
    return pa.table({"kind": pa.array(np.full(n, kind, np.int32)), "part": pa.array(used, pa.int64()),
                     **{c: pa.array(np.full(n, x, np.int32)) for c, x in extra.items()},
                     "keys": pa.array([k[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary()),
                     "vals": pa.array([v[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary())})


def _join(column, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    k, inv = np.unique(keys, return_inverse=True)
    return k, np.bincount(inv, counts, len(k)).astype(np.int64)


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", mod: int = 10, held: int = 0) -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    spark = docs.sparkSession
    key_t = docs.schema[key].dataType.simpleString()
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    chunks = max(1, -(-total // CHUNK_BYTES))
    dealt = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), (remainder(key, mod) == held).alias("held"),
                        F.pmod(F.xxhash64(key, text), F.lit(chunks)).cast("int").alias("chunk"))

    parts = chunks * PARTS_PER_CHUNK

    def count(table: pa.Table) -> pa.Table:
        raw, off = utf8_buffer(table.column("t"))
        raw = lower_ascii(raw)
        train = ~table.column("held").to_numpy(zero_copy_only=False).astype(bool)
        node, code, at = walk(raw, off)
        grams = np.bincount(node[np.repeat(train, np.diff(at))], minlength=len(code))
        words, n = _words(raw, off)
        known, inv = np.unique(words, return_inverse=True)
        seen = np.bincount(inv[np.repeat(train, n)], minlength=len(known))
        known, seen = np.append(known, _END), np.append(seen, train.sum())
        chunk = {"chunk": table.column("chunk")[0].as_py()}
        return pa.concat_tables([_rows(0, parts, code, grams.astype(np.uint32), chunk),
                                 _rows(1, parts, known.view(np.int64), seen.astype(np.uint32), chunk)])

    asked = materialize(dealt.groupBy("chunk").applyInArrow(
        count, "kind int, part bigint, chunk int, keys binary, vals binary"), "ppm-asked")

    def add(table: pa.Table) -> pa.Table:
        kind, part = table.column("kind")[0].as_py(), table.column("part")[0].as_py()
        k, n = _summed(_join(table.column("keys"), np.int64), _join(table.column("vals"), np.uint32))
        suffix = (mix64(((k >> 9) & _mask(2)).astype(np.uint64)) % np.uint64(SUFFIX_PARTS)).astype(np.int64) \
            if kind == 0 else np.zeros(len(k), np.int64)
        by = np.argsort(suffix, kind="stable")
        used, first = np.unique(suffix[by], return_index=True)
        at = np.append(first, len(by))
        k, n = k[by], n[by]
        spans = list(zip(at, at[1:]))
        return pa.table({"kind": pa.array(np.full(len(used), kind, np.int32)),
                         "part": pa.array(np.full(len(used), part, np.int64)),
                         "suffix": pa.array(used.astype(np.int32)),
                         "keys": pa.array([k[a:b].tobytes() for a, b in spans], pa.binary()),
                         "vals": pa.array([n[a:b].tobytes() for a, b in spans], pa.binary()),
                         "total": pa.array([int(n[a:b].sum()) for a, b in spans], pa.int64()),
                         "seen": pa.array([int((n[a:b] > 0).sum()) for a, b in spans], pa.int64())})

    totals = materialize(asked.groupBy("kind", "part").applyInArrow(
        add, "kind int, part bigint, suffix int, keys binary, vals binary, total bigint, seen bigint"), "ppm-totals")
    n_train, distinct = totals.where("kind = 1").agg(
        F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("seen"), F.lit(0))).first()

    def pairs(batches):
        for batch in batches:
            k, n = _join(batch.column(0), np.int64), _join(batch.column(1), np.int64)
            k, n = _summed(k[n > 0] & _mask(2), n[n > 0])
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(n)], names=["g", "n"])

    # at most 257 * 257 rows, whatever the corpus
    low = totals.where("kind = 0").select("keys", "vals").mapInArrow(pairs, "g bigint, n bigint") \
        .groupBy("g").agg(F.sum("n").alias("n")).orderBy("g").toArrow()
    low_key, low_count = low.column("g").to_numpy(), low.column("n").to_numpy()

    def price(table: pa.Table) -> pa.Table:
        g, n = _join(table.column("keys"), np.int64), _join(table.column("vals"), np.int64)
        by = np.argsort(g)
        g, n = g[by], n[by]
        return _rows(0, parts, g, costs(g, n, low_key, low_count).astype(np.float32), {})

    priced = totals.where("kind = 0").select("suffix", "keys", "vals").groupBy("suffix") \
        .applyInArrow(price, "kind int, part bigint, keys binary, vals binary") \
        .unionByName(totals.where("kind = 1").select("kind", "part", "keys", "vals"))

    def answer(table: pa.Table, known: pa.Table) -> pa.Table:
        kind = (table if table.num_rows else known).column("kind")[0].as_py()
        given = np.float32 if kind == 0 else np.int64
        k, v = _join(known.column("keys"), np.int64), _join(known.column("vals"), given)
        by = np.argsort(k)
        k, v = k[by], v[by]
        out = [v[np.searchsorted(k, np.frombuffer(x, np.int64))].tobytes() for x in table.column("keys").to_pylist()]
        return pa.table({"kind": table.column("kind"), "part": table.column("part"),
                         "chunk": table.column("chunk"), "vals": pa.array(out, pa.binary())})

    back = materialize(
        asked.select("kind", "part", "chunk", "keys").groupBy("kind", "part").cogroup(
            priced.groupBy("kind", "part")).applyInArrow(
            answer, "kind int, part bigint, chunk int, vals binary"), "ppm-costs")
    drop(asked, totals)

    def fetched(known: pa.Table, kind: int, keys: np.ndarray, dtype) -> np.ndarray:
        """The values of these keys, in their order."""
        rows = known.filter(pc.equal(known.column("kind"), kind))
        rows = rows.take(pc.sort_indices(rows.column("part")))
        by, _, _ = _packed(keys, parts)
        out = np.empty(len(keys), dtype)
        out[by] = _join(rows.column("vals"), dtype)
        return out

    low_den = float(n_train + 0.1 * (distinct + 1))

    def add_up(table: pa.Table, known: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({"k": pa.array([], table.schema.field("k").type), "held": pa.array([], pa.bool_()),
                             "n": pa.array([], pa.int64()), "known": pa.array([], pa.int64()),
                             "base": pa.array([], pa.float64()), "score": pa.array([], pa.float64())})
        raw, off = utf8_buffer(table.column("t"))
        raw = lower_ascii(raw)
        node, code, at = walk(raw, off)
        total = np.add.reduceat(fetched(known, 0, code, np.float32).astype(np.float64)[node], at[:-1])
        words, n = _words(raw, off)
        keys, inv = np.unique(words, return_inverse=True)
        c = fetched(known, 1, np.append(keys, _END).view(np.int64), np.int64)
        end, c = int(c[-1]), c[:-1][inv]
        row = np.repeat(np.arange(len(n)), n)
        base = np.bincount(row, np.log10((c + 0.1) / low_den), len(n)) + np.log10((end + 0.1) / low_den)
        known_n = np.bincount(row, c > 0, len(n)).astype(np.int64) + (end > 0)
        return pa.table({"k": table.column("k"), "held": table.column("held"), "n": pa.array(n + 1),
                         "known": pa.array(known_n), "base": pa.array(base), "score": pa.array(total)})

    out = dealt.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(
        add_up, f"k {key_t}, held boolean, n bigint, known bigint, base double, score double")
    return out.select(F.col("k").alias(key), F.col("held").alias("held_out"), F.col("n").alias("n_tokens"),
                      F.col("known").alias("n_known"), F.lit(int(n_train)).cast("bigint").alias("train_tokens"),
                      F.col("base").alias("base_score"), "score")
