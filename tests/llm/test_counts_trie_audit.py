"""Token counts, prefix trie and filter audit against brute force, on small tables with awkward rows."""

import collections
import hashlib
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quotelake.llm import filter_audit, prefix_trie, queries, token_counts

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, part string, mask int, block int, n int"
CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string, conv int, block int, pos int, k1 string"


# ------------------------------------------------------------ token counts --

AWKWARD = [
    None, "", " ", "\n\n  \t", "a", "  lead and trail  ", "<|endoftext|>", "a<|endoftext|>b <|endoftext|>  c", "<|endoftext|",
    "it's they're I'LL 'tis", "x" * 5000, "ab " * 3000, "\x85\x1c   y", "你好，世界 \U0001f600\U0001f600",
    "՘ ࢏֋ a՘b", "٣٤٥ ½ Ⅷ", "é é", "\x00\x01 \x7f", "#$%&*| 12 345", "\U000e0001 \U0010ffff",
]


def doc_rows(texts):
    return [(i, t, "en", [None, "", "a", "b"][i % 4], 3, "x", 9, 8, 7) for i, t in enumerate(texts)]


def test_token_counts_equal_the_library(spark):
    rng = random.Random(3)
    texts = AWKWARD + ["".join(rng.choice(" \n'ab1é你!՘") for _ in range(rng.randint(1, 80))) for _ in range(150)]
    texts += [" ".join(str(k) for k in range(40_000))]
    rows = doc_rows(texts)
    rows += [rows[5], rows[5], (None, "no id", None, None, 1, None, 1, 1, 1)]
    lib = Tokenizer.from_file(PATH)
    want = collections.Counter()
    for i, t, *_ in rows:
        n = len(lib.encode(t or "", add_special_tokens=False).ids)
        want[(i, len((t or "").encode()), n, n > 512)] += 1
    got = token_counts.token_counts(spark.createDataFrame(rows, DOCS).repartition(3), PATH, PATTERN)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert collections.Counter(map(tuple, got.collect())) == want


def test_token_counts_over_many_blocks(spark, monkeypatch):
    """Blocks are cut where they are full; a text never lies in two of them."""
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma", str(rng.randint(0, 400))]) for _ in range(60)) for _ in range(90)]
    run = token_counts._frequencies(PATH, PATTERN)
    monkeypatch.setattr(token_counts, "BLOCK_PIECES", 50)
    monkeypatch.setattr(token_counts, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda s: 2})())}))
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(range(90), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    out = pa.Table.from_batches(run(iter([batch]))).to_pylist()
    blocks = {r["block"]: r["pieces"] for r in out if r["pieces"] is not None}
    assert len(blocks) > 5 and min(blocks) == 2 << 32
    for r in out:
        if r["pieces"] is None:
            at, freq = token_counts.frequency(r["places"], r["often"])
            pieces = [blocks[r["block"]][k] for k in at]
            assert dict(zip(pieces, freq)) == collections.Counter(token_counts.loaded(PATH, PATTERN).split(texts[r["doc_id"]]))


def test_packed_integers():
    v = np.array([0, 1, 127, 128, 16383, 16384, 2 ** 21, 2 ** 28, 2 ** 35 - 1], np.int64)
    assert token_counts.unpack(token_counts.pack(v)).tolist() == v.tolist()
    assert token_counts.unpack(token_counts.pack(v[:0])).tolist() == []


def test_token_counts_of_nothing(spark):
    assert token_counts.token_counts(spark.createDataFrame([], DOCS), PATH, PATTERN).collect() == []


# ------------------------------------------------------------- prefix trie --

def brute_trie(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0), hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16], role, text))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    seqs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = c - int(np.fmod(c, 100))
        seqs[c] = tuple(own.get(first, [])[:h] + turns[h:])
    members = collections.defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    kids = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        cost = (len(m) - 1) * (len(p[-1][1]) if p else 0)
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += cost
    out = set()
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if seqs[c] == p))
        out.add((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


def conversation_rows():
    rng = random.Random(8)
    turn = lambda: rng.choice(["hi", "how are you", "fine é", "", None, "more"])
    rows = []

    def add(c, texts, start=0):
        rows.extend((c, start + k, ["user", "assistant", None][k % 3], t, 1, 2, 3, "k") for k, t in enumerate(texts))

    for c in [*range(0, 40), *range(97, 125), 300, 317, 555, -1, -100, -150, 7001]:
        add(c, [turn() for _ in range(rng.randint(1, 20))])
    same = [f"t{k}" for k in range(30)]
    for c in range(400, 460):          # a crowd of copies, of which some stop early and some go on
        add(c, same[:rng.choice([8, 16, 17, 30])])
    add(461, same + ["one more"])
    rows += [(500, None, "user", "a null turn comes first", 1, 2, 3, "k"), (500, 0, "user", "x", 1, 2, 3, "k"),
             (500, 0, "user", "tie", 1, 2, 3, "k"), (500, 0, "user", "tie", 1, 2, 3, "k"), (None, 0, "user", "nobody's", 1, 2, 3, "k")]
    return rows


def got_trie(spark, rows, parts=4):
    df = prefix_trie.trie(spark.createDataFrame(rows, CONVERSATIONS).repartition(parts))
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert {t for _, t in df.dtypes[:-1]} == {"bigint"}
    found = [tuple(r) for r in df.collect()]
    assert len(found) == len(set(found))
    return set(found)


def test_trie_equals_brute_force(spark):
    rows = conversation_rows()
    assert got_trie(spark, rows) == brute_trie(rows)


def test_trie_of_a_hot_and_long_conversation(spark, monkeypatch):
    """One conversation holds most rows, another shares thousands of turns with it; keys go over stretches of blocks."""
    monkeypatch.setattr(prefix_trie, "STRETCH", 4)
    rows = [(c, k, "user", f"w{k % 7}{'x' * (k % 5)}", 1, 2, 3, "k") for c, n in ((1000, 900), (1001, 700), (1002, 3)) for k in range(n)]
    rows += [(1002, 900 + k, "user", "other", 1, 2, 3, "k") for k in range(5)]
    got, want = got_trie(spark, rows, 9), brute_trie(rows)
    assert got == want


def test_trie_splits_hot_keys(spark, monkeypatch):
    """Rows of frequent keys go by broadcast, the others by shuffle; nothing is lost or doubled."""
    left = spark.createDataFrame([(1, i) for i in range(3000)] + [(k, k) for k in range(2, 60)], "conv long, v long")
    right = spark.createDataFrame([(1, "hot"), (2, "cold")], "conv long, name string")
    counts = left.groupBy("conv").count().withColumnRenamed("count", "n")
    got = prefix_trie.join_split(left, right, ["conv"], counts)
    assert collections.Counter(r["name"] for r in got.collect()) == {"hot": 3000, "cold": 1, None: 57}
    assert prefix_trie.join_split(left, right, ["conv"], counts, "inner").count() == 3001


def test_trie_of_nothing(spark):
    assert got_trie(spark, []) == set()
    assert got_trie(spark, [(None, 1, "a", "b", 1, 2, 3, "k")]) == set()


def test_trie_digest_goes_over_many_texts(spark, monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", 3)
    batch = pa.RecordBatch.from_arrays([pa.array([1] * 10 + [2], pa.int64()), pa.array([1] * 11, pa.int64()), pa.array(range(11), pa.int64())],
                                       ["x1", "x2", "conv"])
    texts = list(prefix_trie._chunk(iter([batch])))
    assert sum(b.num_rows for b in texts) == 5
    got = pa.Table.from_batches(prefix_trie._hash(iter(texts))).to_pylist()
    assert got == [{"x1": 1, "x2": 1, "ends_sha256": hashlib.sha256(b"0,1,2,3,4,5,6,7,8,9").hexdigest()},
                   {"x1": 2, "x2": 1, "ends_sha256": hashlib.sha256(b"10").hexdigest()}]


# ------------------------------------------------------------ filter audit --

def brute_audit(rows, labels):
    good = {i for i, q, t in labels if q == 1 and i is not None}
    toxic = {i for i, q, t in labels if t == 1 and i is not None}
    by_text = collections.defaultdict(list)
    for i, t, *_ in rows:
        if i is not None:
            by_text[t or ""].append(i)
    docs = []
    for i, t, _, source, *_ in rows:
        t = t or ""
        w = t.encode().split()
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= x <= "Z" for x in t) > 2 * len(t),
                 "D": any(x in "#$%&*|" for x in t), "E": i is not None and min(by_text[t]) < i}
        docs.append((source or "", frozenset(f for f in fails if fails[f]), i in good, i in toxic))
    out = set()
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        shapley, lines = collections.Counter(), []
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                cut = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(cut)
                lines.append(("".join(order), step, f, len(left), len(cut), sum(f in d[1] for d in mine) - len(cut),
                              sum(d[1] == {f} for d in mine), sum(d[2] for d in cut), sum(d[3] for d in cut)))
        out |= {(part, o, s, *rest, shapley[f]) for o, s, f, *rest in lines}
    return out


def test_audit_equals_brute_force(spark):
    rng = random.Random(2)
    word = lambda: rng.choice(["ab", "Cd", "é", "x y", "q1", "z#", "lorem", "IPSUM", "你"]) + str(rng.randint(0, 300))
    texts = [" ".join(word() for _ in range(rng.choice([3, 150, 199, 200, 201, 400]))) for _ in range(40)]
    texts += [" ".join(["same"] * 300), "a " * 100 + " ".join(f"w{k}" for k in range(100)), "A" + "b" * 49, "A" + "b" * 48, "", None, "", "\x85 \x1c a"]
    texts += texts[:12] + [texts[0]] * 30
    rows = doc_rows(texts)
    rows += [rows[3], (5, "another text under a repeated id", "en", "b", 1, "p", 1, 1, 1), (None, texts[0], "en", "a", 1, "p", 1, 1, 1),
             (None, None, None, None, None, None, None, None, None)]
    rng.shuffle(rows)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 60, 2)] + [(0, 1, 0), (0, 0, 1), (None, 1, 1), (9999, 1, 1)]
    got = filter_audit.audit(spark.createDataFrame(rows, DOCS).repartition(5),
                             spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    found = [tuple(r) for r in got.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
                                          "good_lost", "toxic_lost", "shapley").collect()]
    assert len(found) == 600 * len({r[0] for r in found})
    assert set(found) == brute_audit(rows, labels)


def test_audit_of_nothing(spark):
    got = filter_audit.audit(spark.createDataFrame([], DOCS), spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))
    assert got.collect() == []


# ------------------------------------------------------------ their queries --

@pytest.mark.parametrize("name", ["op11_token_counts", "op12_prefix_trie", "op13_filter_audit"])
def test_queries_on_the_given_tables(spark, name):
    sf = "/root/testdata/sf0.001"
    got = queries.QUERIES[name](spark, sf)
    if name == "op11_token_counts":
        lib = Tokenizer.from_file(PATH)
        want = {(r["doc_id"], len(lib.encode(r["text"] or "", add_special_tokens=False).ids)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
        assert {(r["doc_id"], r["n_tokens"]) for r in got.collect()} == want
        return
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    res = con.execute(queries.ORACLES[name])
    names = [d[0] for d in res.description]
    assert collections.Counter(map(tuple, got.select(*names).collect())) == collections.Counter(res.fetchall())
