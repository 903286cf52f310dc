"""Quality rule on repetition inside a text, by suffix arrays over its words.

The suffixes of every text of a slice are sorted together by prefix doubling
(ranks of 1, 2, 4, ... words; only groups that still tie are sorted again; a
text's end sorts before every word, and words of different texts never tie).
Longest common prefixes of neighbours come from the ranks kept of each round.
A suffix's longest repeat is the larger of its two neighbour prefixes; maximal
runs of neighbours that share ``min_words`` words are the prefix intervals.
The spans of repeats of at least ``min_words`` words are united; a text is
rejected if they cover more than ``max_covered`` of its words or if one repeat
is longer than ``max_longest`` words.

Texts are taken whole, in slices of about ``SLICE_BYTES`` (one text at least).
Null and empty texts have no words and fail the base rule.  Repeated rows get
equal verdicts; extra columns are ignored by ``rules``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import prefix_hash, slices, span_hash, text_array, utf8_buffer, word_spans

MIN_WORDS = 10
MAX_COVERED = 0.2
MAX_LONGEST = 100
SLICE_BYTES = 2 << 20
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"


def suffix_array(word: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes in order, and the ranks after 1, 2, 4, ... words.

    word: a code for each word, different between texts; room: words from each
    position to the end of its text, itself included.
    """
    n = len(word)
    order = np.argsort(word, kind="stable")
    new = np.append(True, word[order][1:] != word[order][:-1]) if n else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = start
    ranks, sa, k = [rank.astype(np.int32)], order.copy(), 1
    tied = np.bincount(start, minlength=n)
    active = np.flatnonzero(tied[rank] > 1)
    while len(active):
        nxt = np.minimum(active + k, n - 1)
        second = np.where(room[active] > k, rank[nxt] + 1, 0)
        code = rank[active] * np.int64(n + 2) + second
        by = np.argsort(code, kind="stable")
        pos, code = active[by], code[by]
        old = rank[pos]
        idx = np.arange(len(pos))
        group = np.maximum.accumulate(np.where(np.append(True, old[1:] != old[:-1]), idx, 0))
        run = np.maximum.accumulate(np.where(np.append(True, code[1:] != code[:-1]), idx, 0))
        sa[old + (idx - group)] = pos
        fresh = old + (run - group)
        rank = rank.copy()
        rank[pos] = fresh
        ranks.append(rank.astype(np.int32))
        size = np.bincount(run, minlength=len(pos))
        active = np.sort(pos[size[run] > 1])
        k *= 2
    return sa, ranks


def neighbour_prefixes(sa: np.ndarray, ranks: list[np.ndarray], room: np.ndarray, word: np.ndarray) -> np.ndarray:
    """lcp[r]: words shared by the suffixes at r-1 and r of the order."""
    n = len(sa)
    lcp = np.zeros(n, np.int64)
    at = np.flatnonzero(word[sa[1:]] == word[sa[:-1]]) + 1 if n else np.zeros(0, np.int64)
    p, q = sa[at - 1].copy(), sa[at].copy()
    got = np.zeros(len(at), np.int64)
    left = np.minimum(room[p], room[q])
    for k in range(len(ranks) - 1, -1, -1):
        can = left >= (1 << k)
        same = np.zeros(len(at), bool)
        same[can] = ranks[k][p[can]] == ranks[k][q[can]]
        step = np.where(same, 1 << k, 0)
        p, q, got, left = p + step, q + step, got + step, left - step
        if n:
            np.minimum(p, n - 1, out=p)
            np.minimum(q, n - 1, out=q)
    lcp[at] = got
    return lcp


def united(start: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """Which of n positions the spans cover."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + length, -1)
    return np.cumsum(edge[:-1]) > 0


def repeats(raw: np.ndarray, off: np.ndarray, min_words: int) -> dict[str, np.ndarray]:
    """For each text: n_words, n_repeat_words (5-word windows), covered, longest, n_intervals."""
    start, end, count = word_spans(raw, off)
    n, texts = len(start), len(count)
    row = np.repeat(np.arange(texts), count)
    word = span_hash(prefix_hash(raw), start, end) + row.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)
    room = np.cumsum(count)[row] - np.arange(n)
    sa, ranks = suffix_array(word, room)
    lcp = neighbour_prefixes(sa, ranks, room, word)
    longest = np.zeros(n, np.int64)
    if n:
        longest[sa] = np.maximum(lcp, np.append(lcp[1:], 0))
    five = np.flatnonzero(longest >= 5)
    rep = np.flatnonzero(longest >= min_words)
    opens = (lcp >= min_words) & ~np.append(False, lcp[:-1] >= min_words) if n else np.zeros(0, bool)
    best = np.zeros(texts, np.int64)
    np.maximum.at(best, row[rep], longest[rep])
    return {"n_words": count,
            "n_repeat_words": np.bincount(row[united(five, np.full(len(five), 5), n)], minlength=texts),
            "covered": np.bincount(row[united(rep, longest[rep], n)], minlength=texts),
            "longest": best, "n_intervals": np.bincount(row[sa[opens]], minlength=texts)}


def rules(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
          max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """Counts and verdicts of every row."""
    key_t = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text, SLICE_BYTES):
            got = repeats(*utf8_buffer(part.column(1)), min_words)
            chars, symbols, dup = [], [], []
            for t in text_array(part.column(1)).to_pylist():
                chars.append(len(t) - sum(map(t.count, BLANKS)))
                symbols.append(sum(map(t.count, SYMBOLS)))
                lines = [x for x in t.split("\n") if x.strip(BLANKS)]
                dup.append(len(lines) - len(set(lines)))
            n, rep = got["n_words"], got["n_repeat_words"]
            failed = (n < 10) | (100 * rep > 20 * n)
            share = got["covered"] / np.maximum(n, 1)
            kept = ~failed & (share <= max_covered) & (got["longest"] <= max_longest)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n, pa.int64()), pa.array(chars, pa.int64()), pa.array(symbols, pa.int64()),
                 pa.array(dup, pa.int64()), pa.array(rep, pa.int64()), pa.array(failed), pa.array(kept),
                 pa.array(share), pa.array(got["longest"], pa.int64()), pa.array(got["n_intervals"], pa.int64())],
                names=[key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                       "kept", "covered_share", "longest_repeat", "n_intervals"])

    return docs.select(key, text).mapInArrow(
        run, f"`{key}` {key_t}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
             "n_repeat_words bigint, base_failed boolean, kept boolean, covered_share double, "
             "longest_repeat bigint, n_intervals bigint")
