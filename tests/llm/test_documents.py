"""The document operators against brute force, on a small table with awkward rows."""

import collections
import hashlib
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from quotelake.llm import (bbit_minhash, bpe_fst, chaining, curriculum, fuzzy_lines, line_crf, ppm, prefix_free,
                           suffix_repetition)
from quotelake.llm.components import similarity_components

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, bucket int"
RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def make():
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    texts = [text(rng.randint(30, 160)) for _ in range(25)]
    shared = text(70)
    texts += [text(20) + " " + shared + " " + text(15), shared + "\n" + text(40), text(50) + "\n" + shared]
    base = texts[0].split(" ")
    for k in (1, 2, 4, 9):
        w = list(base)
        for i in rng.sample(range(len(w)), k):
            w[i] = rng.choice(vocab)
        texts.append(" ".join(w))
    texts += [texts[3], texts[3], texts[4].upper(), "", None, "one", "two words", " \t\n", "a\x1cb c\x0bd",
              "x" * 900, "ab " * 400, text(30) + "\n" + "\n".join([text(12)] * 6), texts[5] + "\n" + texts[5],
              text(6000), "#$%& <b> | it's 12 don't  你好 \U0001f600\r\n\r\n", "\n\n" + texts[7] + "\n"]
    rows = [(i, t, "en" if i % 3 else None, [None, "a", "B", "c"][i % 4], len(t or ""), 7, 8) for i, t in enumerate(texts)]
    rows += [rows[6], rows[6], (None, texts[8], "en", "a", 3, 7, 8), (None, None, None, None, None, None, None)]
    return rows


ROWS = make()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(t, lower=False):
    w = (t or "").encode()
    return (w.lower() if lower else w).split()


def key(i):
    return -1 if i is None else i


def test_suffix_repetition(docs, empty):
    got = collections.Counter(tuple(r)[:8] for r in suffix_repetition.rules(docs).collect())
    want = collections.Counter()
    for r in ROWS:
        t, w = r[1] or "", words(r[1])
        lines = [x for x in t.split("\n") if x.strip(" \t\n\v\f\r")]

        def covered(k):
            c = collections.Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
            return {j for i in range(len(w) - k + 1) if c[tuple(w[i:i + k])] > 1 for j in range(i, i + k)}
        rep, cov, longest = len(covered(5)), len(covered(suffix_repetition.MIN_WORDS)), 0
        while cov and covered(max(longest, 9) + 1):
            longest = max(longest, 9) + 1
            if longest > suffix_repetition.MAX_LONGEST:
                break
        failed = len(w) < 10 or 100 * rep > 20 * len(w)
        kept = not failed and cov <= suffix_repetition.MAX_COVERED * len(w) and longest <= suffix_repetition.MAX_LONGEST
        want[(r[0], len(w), len(t) - sum(map(t.count, " \t\n\v\f\r")), sum(map(t.count, "#*$%&|<>")),
              len(lines) - len(set(lines)), rep, failed, kept)] += 1
    assert got == want
    assert suffix_repetition.rules(empty).count() == 0


def test_ppm(docs, empty):
    train = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 10 != 0 for r in ROWS]
    order = ppm.ORDER
    seqs = [[256] * order + list((r[1] or "").encode().lower()) + [256] for r in ROWS]
    count = [collections.defaultdict(collections.Counter) for _ in range(order + 1)]
    tokens = collections.Counter()
    for s, r, t in zip(seqs, ROWS, train):
        if t:
            tokens.update(words(r[1], True) + [b""])
            for i in range(order, len(s)):
                for j in range(order + 1):
                    count[j][tuple(s[i - j:i])][s[i]] += 1

    def cost(s, i):
        out, gone = 0.0, set()
        for j in range(order, -1, -1):
            seen = count[j].get(tuple(s[i - j:i]))
            if seen is None:
                continue
            rest = {a: b for a, b in seen.items() if a not in gone}
            total = sum(rest.values()) + len(rest)
            if s[i] in rest:
                return out + np.log10(rest[s[i]] / total)
            if rest:
                out += np.log10(len(rest) / total)
            gone |= set(seen)
        return out - np.log10(257 - len(gone))
    n, v = sum(tokens.values()), len(tokens)
    want = []
    for s, r, t in zip(seqs, ROWS, train):
        w = words(r[1], True) + [b""]
        want.append((key(r[0]), not t, len(w), sum(tokens[x] > 0 for x in w), n,
                     round(sum(np.log10((tokens[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), 4),
                     round(sum(cost(s, i) for i in range(order, len(s))), 2)))
    got = [(key(r[0]), *r[1:5], round(r[5], 4), round(r[6], 2)) for r in ppm.score(docs).collect()]
    assert sorted(x[:5] for x in got) == sorted(x[:5] for x in want)
    for a, b in zip(sorted(got), sorted(want)):
        assert a[5:] == pytest.approx(b[5:], abs=0.02)
    assert ppm.score(empty).count() == 0


def test_bpe_round_trip(docs, empty):
    ranks = bpe_fst.load_ranks(RANKS)
    enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for r in ROWS:
        ids = enc.encode_ordinary(r[1] or "")
        want.append((key(r[0]), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((r[1] or "").encode()).hexdigest()))
    got = [(key(r[0]), *r[1:]) for r in bpe_fst.digests(docs, RANKS, PATTERN).collect()]
    assert sorted(got) == sorted(want)
    out = bpe_fst.encode(docs, RANKS, PATTERN)
    assert out.columns == docs.columns + ["token_ids"]
    assert sorted((key(r["doc_id"]), r["token_ids"]) for r in out.collect()) == \
        sorted((key(r[0]), enc.encode_ordinary(r[1] or "")) for r in ROWS)
    assert bpe_fst.digests(empty, RANKS, PATTERN).count() == 0


def test_bpe_pieces_and_streaming():
    ranks = bpe_fst.load_ranks(RANKS)
    small = {t: r for t, r in ranks.items() if r < 3000}
    rng = random.Random(2)
    for vocabulary, states in ((ranks, 50), (small, 10_000)):
        fst = bpe_fst.Transducer(vocabulary, max_states=states)
        for _ in range(1500):
            piece = bytes(rng.choice(b"abest n\xc3\xa9\xe2\x820") for _ in range(rng.randint(1, 24)))
            assert fst.encode(piece) == ([vocabulary[piece]] if piece in vocabulary else bpe_fst.merge(piece, vocabulary))
    bytes_of = {r: t for t, r in ranks.items()}
    text = "café 你好 \U0001f600 end"
    ids = [ranks[bytes([b])] for b in text.encode()]
    for step in (1, 2, 3, 5):
        dec = bpe_fst.StreamDecoder(bytes_of)
        assert "".join(dec.feed(ids[i:i + step]) for i in range(0, len(ids), step)) + dec.finish() == text
    dec = bpe_fst.StreamDecoder(bytes_of)
    assert dec.feed(ids[:4]) == "caf" and dec.feed([ranks[b"A"]]) == "�A"


def components(links, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_near_duplicates(docs, empty):
    sets = {}
    for r in ROWS:
        w = words(r[1], True)
        sets[r[0]] = {tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} if w else set()
    ids = [i for i in sets if i is not None and sets[i]]
    links = [(a, b) for a in ids for b in ids if a < b
             and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    comp = components(links, [i for i in sets if i is not None])
    got = {(r[0], r[2], r[3]) for r in bbit_minhash.near_duplicates(docs, 3, 85, 8).collect()}
    assert got == {(i, comp.get(i), i is None or comp[i] == i) for i in sets}
    assert bbit_minhash.near_duplicates(empty).count() == 0


def test_large_group_of_near_copies(spark):
    """Many chains of small edits: nothing is lost though no bucket is paired out."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for j in rng.sample(range(120), rng.randint(0, 6)):
            w[j] = f"x{rng.randint(0, 999)}"
        rows.append((i, " ".join(w)))
    sets = {i: {tuple(t.split()[k:k + 3]) for k in range(118)} for i, t in rows}
    comp = components([(a, b) for a in sets for b in sets if a < b
                       and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])], list(sets))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r[0]: r[2] for r in bbit_minhash.near_duplicates(df, 3, 85, 8).collect()}
    assert got == comp


@pytest.mark.parametrize("percent, families", [(85, 1), (80, 3), (60, 2)])
def test_components_of_one_bucket_against_all_pairs(spark, percent, families):
    """Sets of one bucket, near and below the threshold, with and without what they come from."""
    rng = random.Random(percent)
    sets = {}
    for f in range(families):
        base = [rng.getrandbits(63) for _ in range(60 + 20 * f)]
        spare = [rng.getrandbits(63) for _ in range(25)]
        for _ in range(70):
            lost = rng.randint(0, max(len(base) * (100 - percent) // 120, 2))
            x = set(rng.sample(base, len(base) - lost))
            x |= set(rng.sample(spare, rng.randint(0, 8))) if rng.random() < 0.5 else {rng.getrandbits(63) for _ in range(lost)}
            sets[len(sets)] = x
    for _ in range(20):
        sets[len(sets)] = {rng.getrandbits(63) for _ in range(rng.randint(1, 40))}
    links = [(a, b) for a in sets for b in sets if a < b
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    comp = components(links, list(sets))
    stored = spark.createDataFrame(
        [(i, bytearray(np.array(sorted(x), np.uint64).tobytes()), len(x)) for i, x in sets.items()],
        "node bigint, set binary, size bigint")
    nodes = spark.createDataFrame([(i, [7]) for i in sets], "node bigint, buckets array<bigint>")
    got = similarity_components(nodes, lambda ids: stored.join(ids, "node", "left_semi"), percent)
    linked = {i for pair in links for i in pair}
    assert {r["node"]: r["component"] for r in got.collect()} == {i: comp[i] for i in linked}


def test_fuzzy_lines(docs, empty):
    lines = {}
    for r in ROWS:
        if r[0] is not None:
            for n, x in enumerate((r[1] or "").encode().lower().split(b"\n")):
                if x.split():
                    lines[r[0], n] = frozenset(fuzzy_lines.shingles(x).tolist())
    at = sorted(lines)
    comp = components([(a, b) for a in at for b in at if a < b
                       and 100 * len(lines[a] & lines[b]) >= 80 * len(lines[a] | lines[b])], at)
    want = collections.defaultdict(list)
    for a in at:
        want[a[0]] += [a[1]] if comp[a] != a else []
    got = {r["id"]: r["dropped"] for r in fuzzy_lines.line_decisions(docs).collect()}
    assert got == dict(want)
    left = fuzzy_lines.dedup(docs)
    assert left.columns == docs.columns
    by_id = {r["doc_id"]: r for r in left.collect() if r["doc_id"] is not None}
    for i, gone in want.items():
        text = next(r[1] for r in ROWS if r[0] == i)
        keep = [x for n, x in enumerate(text.split("\n")) if n not in gone]
        if len([a for a in at if a[0] == i]) == len(gone):
            assert i not in by_id
        elif gone:
            assert by_id[i]["text"] == "\n".join(keep) and by_id[i]["n_chars"] == len("\n".join(keep))
    assert fuzzy_lines.dedup(empty).count() == 0


def test_chaining_finds_shared_passages(docs, empty):
    got = chaining.passages(docs).collect()
    pairs = {(r["doc_id"], r["other_id"]) for r in got}
    assert {(26, 25), (27, 25), (32, 3), (33, 3)} <= pairs
    clean = set(range(9, 24))
    assert not clean & {r["doc_id"] for r in got}
    r = next(r for r in got if r["doc_id"] == 26 and r["other_id"] == 25)
    assert (r["start_word"], r["end_word"], r["other_start"], r["other_end"]) == (0, 70, 20, 90)
    assert chaining.passages(empty).count() == 0


def test_chain_is_the_best_chain():
    rng = random.Random(4)
    for _ in range(40):
        n = rng.randint(1, 25)
        pts = list({(rng.randint(0, 30), rng.randint(0, 30)) for _ in range(n)})
        x, y = np.array([p[0] for p in pts]), np.array([p[1] for p in pts])
        best = {}
        for p in sorted(pts):
            best[p] = chaining.K + max([0.0] + [best[q] - chaining.GAP * (p[0] - q[0] + p[1] - q[1])
                                                for q in best if q[0] < p[0] and q[1] < p[1]])
        path = chaining.chain(x, y)[0]
        score = len(path) * chaining.K - chaining.GAP * (x[path[-1]] - x[path[0]] + y[path[-1]] - y[path[0]])
        assert score == pytest.approx(max(best.values()))


def test_chain_is_the_best_chain_within_the_gap():
    rng = random.Random(9)
    for _ in range(60):
        pts = list({(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(rng.randint(1, 120))})
        pts += [(at + k, at + k) for at in (400, 500) for k in range(20)]
        x, y = np.array([p[0] for p in pts]), np.array([p[1] for p in pts])
        best = {}
        for p in sorted(pts):
            best[p] = chaining.K + max([0.0] + [best[q] - chaining.GAP * (p[0] - q[0] + p[1] - q[1]) for q in best
                                                if 0 < p[0] - q[0] <= chaining.MAX_GAP and 0 < p[1] - q[1] <= chaining.MAX_GAP])
        paths = chaining.chain(x, y)
        score = [len(p) * chaining.K - chaining.GAP * (x[p[-1]] - x[p[0]] + y[p[-1]] - y[p[0]]) for p in paths]
        assert score[0] == pytest.approx(max(best.values()))
        assert sum(len(p) == 20 and x[p[0]] in (400, 500) for p in paths) == 2
        assert sorted(i for p in paths for i in p) == list(range(len(pts)))


@pytest.mark.parametrize("apart", [30, 38, 50, 100])
def test_chaining_finds_both_of_two_passages(spark, apart):
    rng = random.Random(apart)
    text = lambda n: [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]
    one, two = text(60), text(60)
    rows = [(i, " ".join(text(45) + one + text(apart) + two + text(45))) for i in (1, 2)]
    got = chaining.passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    found = {w for r in got if (r["doc_id"], r["other_id"]) == (2, 1) for w in range(r["start_word"], r["end_word"])}
    assert set(range(45, 105)) <= found and set(range(105 + apart, 165 + apart)) <= found


def test_chaining_passages_hidden_by_first_places(spark):
    """Pairs whose seeds all stand in earlier documents that share no passage with them, against brute force."""
    rng = random.Random(1)
    text = lambda n: [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]
    halves, bits, often = text(70), text(60), text(60)
    rows = [(1, text(50) + halves[:35] + text(50)), (2, text(50) + halves[35:] + text(50)),
            (3, text(30) + halves + text(30)), (4, text(60) + halves + text(10))]
    rows += [(10 + i, text(30) + bits[5 * i:5 * i + 9] + text(30)) for i in range(10)]
    rows += [(30, text(30) + bits + text(5)), (31, text(7) + bits + text(20))]
    rows += [(100 + i, text(30) + often[3 * (i % 18):3 * (i % 18) + 9] + text(30)) for i in range(200)]  # over FEW places
    rows += [(400, text(30) + often + text(5)), (401, text(7) + often + text(20))]
    # a random corpus of pieces of a few base passages
    base = [text(90) for _ in range(4)]
    for i in range(60):
        parts = []
        for _ in range(3):
            of, at, n = rng.choice(base), rng.randrange(60), rng.choice((9, 20, 30, 55))
            parts += text(12) + of[at:at + n]
        rows.append((1000 + i, parts + text(12)))
    # brute force: by document, the words of exact runs of 40 words and more that an earlier document has
    want, runs = collections.defaultdict(set), {}
    for i, words in rows:
        own = {tuple(words[p:p + 40]): p for p in range(len(words) - 39)}
        for run, p in own.items():
            if run in runs:
                want[i] |= set(range(p, p + 40))
        runs.update(dict.fromkeys(own, i))
    assert {4, 31, 401} <= set(want) and len(want) > 20
    got = chaining.passages(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id bigint, text string")).collect()
    found = collections.defaultdict(set)
    for r in got:
        assert r["other_id"] < r["doc_id"] and r["identity"] >= 0.8
        found[r["doc_id"]] |= set(range(r["start_word"], r["end_word"]))
    assert {(4, 3), (31, 30), (401, 400)} <= {(r["doc_id"], r["other_id"]) for r in got}
    assert not {i for i in found if 10 <= i < 31 or 100 <= i < 400}
    for i, words in want.items():  # what is left are ends of passages, of fewer than MIN_CHAIN words each
        left = sorted(words - found[i])
        for _, run in itertools.groupby(enumerate(left), lambda at: at[1] - at[0]):
            assert len(list(run)) < chaining.MIN_CHAIN, i


def test_chaining_equal_passage_of_frequent_runs(spark):
    """Two documents share 40 words; every run of 4 to 32 of them stands in over FEW earlier documents, shorter in all."""
    rng = random.Random(3)
    text = lambda n: [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]
    whole, n = text(chaining.MIN_WORDS), chaining.FEW + 4
    rows = [(i, text(30) + whole[:36] + text(30)) for i in range(n)]
    rows += [(100 + i, text(30) + whole[4:] + text(30)) for i in range(n)]
    rows += [(200, text(20) + whole + text(40)), (201, text(35) + whole + text(10))]
    got = chaining.passages(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id bigint, text string")).collect()
    assert [(r["doc_id"], r["other_id"], r["start_word"], r["end_word"], r["other_start"]) for r in got] == [(201, 200, 35, 75, 20)]


def test_chaining_passage_with_edits_of_frequent_runs(spark):
    """Two documents share 48 words but for three; every run of 4 and 8 of them stands in over FEW earlier documents."""
    rng = random.Random(3)
    text = lambda n: [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]
    whole, n = text(48), chaining.FEW + 4
    other = [f"x{i}" if i in (12, 25, 38) else w for i, w in enumerate(whole)]
    rows = [(100 * i + at, text(30) + whole[at:at + 12] + text(30)) for i in range(n) for at in range(0, 40, 4)]
    rows += [(9000, text(20) + whole + text(40)), (9001, text(35) + other + text(10))]
    got = chaining.passages(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id bigint, text string")).collect()
    assert [(r["doc_id"], r["other_id"], r["start_word"], r["end_word"], r["matched_words"]) for r in got] == [(9001, 9000, 35, 83, 45)]


def test_window_grams_of_every_passage_are_shared():
    """A copy with at most a fifth of its words edited shares enough of the grams, whatever the counts say."""
    rng = random.Random(8)
    for trial in range(300):
        words = [rng.randrange(10 ** 9 if trial % 3 else 12) for _ in range(rng.randint(40, 79))]
        copy = list(words)
        for at in sorted(rng.sample(range(len(words)), len(words) // 5), reverse=True):
            copy[at:at + (trial % 2)] = [rng.randrange(10 ** 9) + 10 ** 9] * (1 if trial % 2 else rng.choice((1, 1, 0)))
        a, b = (np.array([rng.randrange(10 ** 9) + 2 * 10 ** 9 for _ in range(30)] + x, np.uint64) for x in (words, copy))
        count = np.array([rng.randint(1, 50) for _ in range(512)] * (chaining.SKETCH // 512))
        grams, times = chaining._window_grams(a, np.arange(30, 30 + len(words) - 3), count, 40, 0.8)
        has = np.concatenate([chaining._grams(b, g) for g in (1, 2)])
        assert len(np.unique(grams)) == len(grams) and times[np.isin(grams, has)].sum() >= chaining.ALIKE


def test_chaining_stretches_of_one_word(spark):
    """Repeated words meet along few diagonals, not place by place, and every word of them is covered."""
    rows = [(0, "a " * 200), (1, "a " * 200), (2, "a " * 500), (3, "a " * 60 + "b c d e f " * 60)]
    got = chaining.passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(got) <= 12 and {r["other_id"] for r in got} == {0}
    for i, n in ((1, 200), (2, 500), (3, 60)):
        at = sorted((r["start_word"], r["end_word"]) for r in got if r["doc_id"] == i)
        assert at[0][0] == 0 and max(e for _, e in at) >= n
        assert all(s <= max(e for _, e in at[:k + 1]) for k, (s, _) in enumerate(at[1:]))


def test_matches_in_line_chain_as_by_the_tree():
    rng = random.Random(6)
    for _ in range(200):
        n = rng.randint(1, 60)
        x = np.cumsum([rng.choice((1, 1, 1, 5, 30, 45)) for _ in range(n)])
        y = np.cumsum([rng.choice((1, 1, 1, 5, 30, 45)) for _ in range(n)])
        order = list(range(n))
        line, tree = chaining._in_line(order, np.diff(x), np.diff(y)), chaining._best_before(order, x, y)
        assert line[0] == pytest.approx(tree[0]) and line[1] == tree[1]


@pytest.mark.parametrize("kind", ["replace", "insert"])
@pytest.mark.parametrize("n", [45, 50, 60])
def test_chaining_recall_at_low_identity(n, kind):
    """Copies with a share of words replaced or inserted, inside unrelated words."""
    found = total = 0
    for trial in range(90):
        rng = random.Random(trial)
        text = lambda k: [rng.randrange(10 ** 9) for _ in range(k)]
        one = text(n)
        two, edits = list(one), int((0.1, 0.15, 0.18)[trial % 3] * n)
        for at in sorted(rng.sample(range(n), edits), reverse=True):
            two[at:at + (kind == "replace")] = text(1)
        a, b = np.array(text(60) + two + text(60), np.uint64), np.array(text(80) + one + text(50), np.uint64)
        row, at, seed = chaining.seeds(np.concatenate([a, b]), np.array([len(a), len(b)]))
        there = {s: p for r, p, s in zip(row, at, seed) if r == 1}
        m = np.array([(p, there[s]) for r, p, s in zip(row, at, seed) if r == 0 and s in there]).reshape(-1, 2)
        hits = [s for path in chaining.chain(m[:, 0], m[:, 1]) if len(path) > 1
                for s in chaining.stretches(a, b, m[path, 0], m[path, 1], 40, 0.8)]
        total += 1
        found += any(x0 < 60 + n // 2 < x1 for x0, x1, _, _, _ in hits)
    assert found >= 0.95 * total


def test_curriculum(docs, empty):
    rows = curriculum.plan(docs).select("doc_id", "source", "size", "bucket", "source_size", "target", "taken").collect()
    assert len(rows) == len(ROWS) and {r["bucket"] for r in rows} == {8, None}
    total, taken, target = collections.Counter(), collections.Counter(), {}
    for r in rows:
        total[r["source"]] += r["size"] if False else 0
    sizes = collections.Counter()
    for r in ROWS:
        sizes[r[3]] += len(words(r[1]))
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: [1, 2, 3][i % 3] for i, s in enumerate(order)}
    left, open_, goal = sum(sizes.values()), set(order), {}
    while True:
        level = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if level[s] > 3 * sizes[s]]
        if not over:
            goal.update(level)
            break
        for s in over:
            goal[s] = 3 * sizes[s]
            left -= goal[s]
            open_.discard(s)
    for r in rows:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["source_size"] == sizes[r["source"]]
    for s in order:
        assert target[s] == pytest.approx(goal[s]) and abs(taken[s] - goal[s]) <= 1
    out = curriculum.curriculum(docs.drop("size", "bucket"))
    assert sum(r["copy_words"] for r in out.collect()) == sum(taken.values())
    assert all(0 <= r["position"] <= 1 for r in out.select("position").collect())
    assert curriculum.curriculum(empty).count() == 0


def test_prefix_free(docs, empty, monkeypatch):
    raw = [(r[1] or "").encode() for r in ROWS]
    n = prefix_free.LENGTH
    seen = collections.Counter(b[i:i + n] for b in raw for i in range(len(b) - n + 1))
    want = []
    for r, b in zip(ROWS, raw):
        cov = np.zeros(len(b), bool)
        for i in range(len(b) - n + 1):
            if seen[b[i:i + n]] > 1:
                cov[i:i + n] = True
        spans = int((np.diff(np.concatenate([[0], cov.astype(int)])) == 1).sum())
        kept = bytes(x for x, c in zip(b, cov) if not c)
        want.append((key(r[0]), len(b), int(cov.sum()), spans, hashlib.sha256(kept).hexdigest()))
    for hot in (prefix_free.HOT, 1):  # the second counts every shared core by hashes
        monkeypatch.setattr(prefix_free, "HOT", hot)
        got = [(key(r[0]), *r[1:5]) for r in prefix_free.dedup(docs).collect()]
        assert sorted(got) == sorted(want)
    assert prefix_free.dedup(empty).count() == 0


def test_line_crf_counts_a_line_of_several_megabytes():
    part = b"Some plain words, 12 of them."
    shares = []
    for times in (1000, 160_000):
        raw = np.frombuffer(b"ab\n" + part * times + b"\ncd", np.uint8)
        x, _, _ = line_crf.line_features(raw, np.array([0, len(raw)]))
        shares.append(x[:, :len(line_crf._CLASSES)])
    assert len(raw) > 4_000_000 and np.allclose(*shares)
    assert shares[1][1, 1] == pytest.approx(sum(97 <= c <= 122 for c in part) / len(part))


def test_line_crf(spark, docs, empty):
    sf = "/root/testdata/sf0.01"
    real, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = line_crf.train(real, labels)
    got = {r["doc_id"]: r["score"] for r in line_crf.scores(real, model).collect()}
    held = [(r["quality"], got[r["doc_id"]]) for r in labels.collect()
            if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert sum((s >= 0.7) == (q == 1) for q, s in held) >= 0.97 * len(held)
    odd = line_crf.scores(docs, model).collect()
    assert len(odd) == len(ROWS) and all(0 <= r["score"] <= 1 for r in odd)
    assert line_crf.keep_good(docs, model).columns == docs.columns
    none = line_crf.train(empty, labels.limit(0))
    assert {r["score"] for r in line_crf.scores(docs, none).collect()} == {1.0}
    assert line_crf.scores(empty, model).count() == 0


def test_line_crf_fit_holds_one_copy_of_the_sample():
    """The driver's share of the memory: the sample's features and little beside them."""
    import tracemalloc
    rng = np.random.default_rng(0)
    x, row = rng.normal(size=(20_000, 107)), np.repeat(np.arange(2000), 10)
    mean, std, size = x.mean(0), x.std(0), x.nbytes
    tracemalloc.start()
    model = line_crf.fit(x, row, np.ones(len(row)), (np.arange(2000) % 2).astype(float), steps=2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < size / 2
    assert np.allclose(model.mean, mean) and np.allclose(model.scale, std + 1e-3)


def test_line_crf_train_takes_documents_in_hash_order(spark, monkeypatch):
    """Up to the bound of lines, each with its features, label and weight; a long document is passed over."""
    got = []
    monkeypatch.setattr(line_crf, "fit", lambda *a: got.append(a))
    texts = {i: "\n".join(f"Line {k} of {i}." for k in range(1 + i % 3)) for i in range(200)}
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()] + [(200, "x\n" * 50)], "doc_id bigint, text string")
    labels = docs.selectExpr("doc_id", "int(doc_id % 2) as quality")
    line_crf.train(docs, labels, max_lines=60)
    order, lines = [], 0
    for i in sorted((i for i in texts if zlib.crc32(str(i).encode()) % 4 != 2), key=lambda i: (zlib.crc32(str(i).encode()), i)):
        if lines + 1 + i % 3 <= 60:
            order.append(i)
            lines += 1 + i % 3
    raw = [texts[i].encode() for i in order]
    x, row, weight = line_crf.line_features(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw]))
    assert np.array_equal(got[0][0], x) and np.array_equal(got[0][1], row)
    assert np.array_equal(got[0][2], weight) and got[0][3].tolist() == [i % 2 for i in order]


def test_forward_backward_against_enumeration():
    import itertools
    rng = np.random.default_rng(0)
    unary, move = rng.normal(size=9), rng.normal(size=(2, 2))
    first, length = np.array([0, 4, 5]), np.array([4, 1, 4])
    good, pairs, _ = line_crf.forward_backward(unary, move, first, length)
    for a, k in zip(first, length):
        p = np.zeros(k)
        z = 0.0
        for y in itertools.product((0, 1), repeat=int(k)):
            w = np.exp(sum(unary[a + i] for i in range(k) if y[i]) + sum(move[y[i], y[i + 1]] for i in range(k - 1)))
            z += w
            p += w * np.array(y)
        assert good[a:a + k] == pytest.approx(p / z)
    assert pairs.sum() == pytest.approx(6)


@pytest.mark.parametrize("module, make", [
    (fuzzy_lines, lambda docs: fuzzy_lines.occurrences(docs, "doc_id", "text", True)),
    (bbit_minhash, lambda docs: bbit_minhash.features(docs, 5, 6, "doc_id", "text")),
    (line_crf, lambda docs: line_crf.scores(docs, line_crf.Model(0.0, 1.0, np.ones(1), 0.0, np.zeros((2, 2)), 1.0, 0.0)))])
def test_working_memory_of_a_large_batch(spark, monkeypatch, module, make):
    """A task's arrays stay far below the share of one of an executor's workers, whatever Arrow hands it."""
    import tracemalloc

    import pyarrow as pa
    tasks = []
    docs = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda df, task, schema: tasks.append(task) or df)
    make(docs)
    if module is line_crf:
        monkeypatch.setattr(line_crf.Model, "quality", lambda model, x, row, weight, n: np.zeros(n))
    rng = random.Random(2)
    words = [f"word{k}" for k in range(5000)]
    texts = ["\n".join(" ".join(rng.choices(words, k=10)) for _ in range(30)) for _ in range(1500)]  # about 4 MB
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    list(tasks[0](iter([batch.slice(0, 300)])))  # tables of powers
    tracemalloc.start()
    rows = sum(b.num_rows for b in tasks[0](iter([batch])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows >= len(texts) and most < 80 << 20
