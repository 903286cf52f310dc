"""Byte-level BPE by a lazily determinised finite-state transducer.

Encoding.  A sequence of tokens is the BPE encoding of its bytes exactly when
each token encodes to itself and each neighbouring pair encodes to that pair.
The nondeterministic transducer therefore reads bytes along the trie of tokens
and may end a token where the pair with the token before is allowed.  Its
determinisation is built while it is used: a state is the set of open
hypotheses ``(trie node, token before, tokens not yet written)``; a step moves
all of them by one byte, closes the one allowed token that ends there, and
writes the tokens on which all hypotheses agree.  A hypothesis lives for at
most the longest token, so the lookahead is bounded by it.  Transitions are
memoised; the tables are dropped when ``max_states`` is reached and grow anew,
so memory is bounded whatever the text.

Decoding.  ``StreamDecoder`` takes ids in pieces of any size and returns text
as soon as characters are complete, by an incremental UTF-8 state machine
that is run over whole tokens (each token's effect on each state is memoised).

Nulls are encoded as the empty text.  Texts of any length are read in pieces
of ``PIECES`` matches.  Repeated rows are encoded each on their own; columns
beside the text are carried along untouched by ``encode``.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from array import array
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import slices, text_array

PIECES = 200_000
#: States of a worker's transducer (some 300 MB at most, kept for its next tasks), and matches
#: memoised (as much again, forgotten when a task ends).
MAX_STATES = 400_000
MAX_CACHE = 600_000
#: Bytes of text taken together.
SLICE_BYTES = 1 << 20


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Reference merging: the lowest-ranked neighbouring pair first, leftmost of equals."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, i = min((ranks.get(parts[j] + parts[j + 1], 1 << 60), j) for j in range(len(parts) - 1))
        if rank == 1 << 60:
            break
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


class Transducer:
    """The determinised transducer of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks, self.max_states = ranks, max_states
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.trie: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        for tok, rank in ranks.items():
            node = 0
            for b in tok:
                nxt = self.trie[node].get(b)
                if nxt is None:
                    nxt = self.trie[node][b] = len(self.trie)
                    self.trie.append({})
                    self.token.append(-1)
                node = nxt
            self.token[node] = rank
        self._pair: dict[tuple[int, int], bool] = {}
        self._own: dict[int, tuple | None] = {}
        self.reset()

    def reset(self) -> None:
        self.items = [((0, -1, ()),)]
        self.number = {self.items[0]: 0}
        self.next: list[dict[int, tuple[int, tuple[int, ...]]]] = [{}]
        self.final: list[tuple[int, ...]] = [()]

    def _ends(self, tok: int) -> tuple | None:
        """How a token's first and last part grow while its bytes are merged.

        Two lists of (part, rank of the merge that takes it in), the last with
        no such merge; None if the bytes don't merge to the token.
        """
        if tok not in self._own:
            raw = self.bytes_of[tok]
            parts = [raw[i:i + 1] for i in range(len(raw))]
            first, last = [], []
            get, never = self.ranks.get, 1 << 60
            while len(parts) > 1:
                found = [get(parts[j] + parts[j + 1], never) for j in range(len(parts) - 1)]
                rank = min(found)
                if rank == never:
                    break
                i = found.index(rank)
                if i == 0:
                    first.append((parts[0], rank))
                if i == len(parts) - 2:
                    last.append((parts[-1], rank))
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            self._own[tok] = None if len(parts) > 1 else ([*first, (raw, never)], [*last, (raw, never)])
        return self._own[tok]

    def allowed(self, before: int, tok: int) -> bool:
        """Do these two tokens stay as they are when their bytes are encoded?

        Follows both parts beside the border through time (merges go by rank,
        leftmost first): a merge over the border that comes first forbids it.
        """
        ok = self._pair.get((before, tok))
        if ok is None:
            if len(self._pair) > 1_000_000:
                self._pair.clear()
            right = self._ends(tok)
            if before < 0 or right is None:
                self._pair[before, tok] = right is not None
                return right is not None
            left, right = self._own[before][1], right[0]
            get, never, i, j = self.ranks.get, 1 << 60, 0, 0
            while True:
                (a, a_rank), (b, b_rank) = left[i], right[j]
                rank = get(a + b, never)
                if rank < a_rank and rank <= b_rank and rank != never:
                    ok = False
                    break
                if a_rank == b_rank == never:
                    ok = True
                    break
                if a_rank <= b_rank:
                    i += 1
                else:
                    j += 1
            self._pair[before, tok] = ok
        return ok

    def step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The memoised move of a state by a byte: the next state and the tokens written."""
        moved, trie, token, known = [], self.trie, self.token, self._pair.get
        done = None
        for item in self.items[state]:
            node, before, held = item
            child = trie[node].get(byte)
            if child is None:
                continue
            if done is None:
                tok = token[child]
                if tok >= 0:
                    ok = known((before, tok))
                    if ok or (ok is None and self.allowed(before, tok)):
                        done = (0, tok, held + (tok,))
            if trie[child]:
                moved.append((child, before, held))
        moved.append(done)
        same = 0
        if moved[0][2]:  # tokens on which all hypotheses agree are written
            first = done[2]
            same = min([len(h) for _, _, h in moved])
            while same and any([h[:same] != first[:same] for _, _, h in moved]):
                same -= 1
        written = done[2][:same]
        key = tuple([(n, b, h[same:]) for n, b, h in moved]) if same else tuple(moved)
        number = self.number.get(key)
        if number is None:
            number = self.number[key] = len(self.items)
            self.items.append(key)
            self.next.append({})
            self.final.append(key[-1][2])
        out = self.next[state][byte] = (number, written)
        return out

    def encode(self, piece: bytes) -> list[int]:
        """The ids of one match of the splitting pattern."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.items) > self.max_states:
            self.reset()
        out: list[int] = []
        state, table = 0, self.next
        for b in piece:
            hit = table[state].get(b)
            state, written = hit if hit is not None else self.step(state, b)
            if written:
                out += written
            if len(self.items) > self.max_states + 200_000:  # one huge piece: keep its last state only
                keep, final = self.items[state], self.final[state]
                self.reset()
                table = self.next
                state = self.number.setdefault(keep, len(self.items))
                if state == len(self.items):
                    self.items.append(keep)
                    self.next.append({})
                    self.final.append(final)
        out += self.final[state]
        return out


class Encoder:
    """Splits text by a pattern and encodes every match by the transducer."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.fst = Transducer(ranks)
        self.pattern = regex.compile(pattern)
        self.cache: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def _miss(self, piece: str) -> tuple[int, ...]:
        ids = self.older.get(piece) or tuple(self.fst.encode(piece.encode("utf-8")))
        if len(piece) <= 64:
            if len(self.cache) >= MAX_CACHE:  # two generations: what was used lately stays
                self.older, self.cache = self.cache, {}
            self.cache[piece] = ids
        return ids

    def clear(self) -> None:
        """Forget the matches and pairs memoised, so that stages that reuse this worker start without them.

        The states stay: they cost most to build, and there are ``MAX_STATES`` at most.
        """
        self.cache, self.older = {}, {}
        self.fst._pair.clear()

    def ids(self, text: str) -> Iterator[array]:
        """Arrays of unsigned 32-bit ids, one for each ``PIECES`` matches."""
        if len(text) <= 4 * PIECES:
            found = iter([self.pattern.findall(text)])
        else:
            it = (m.group() for m in self.pattern.finditer(text))
            found = iter(lambda: list(islice(it, PIECES)), [])
        for pieces in found:
            get, miss = self.cache.get, self._miss
            yield array("I", chain.from_iterable([get(p) or miss(p) for p in pieces]))


# --- decoding -------------------------------------------------------------

#: States of the UTF-8 machine: what may follow.  0 is between characters.
_START, _C1, _C2, _C3, _E0, _ED, _F0, _F4 = range(8)


def utf8_step(state: int, b: int) -> int:
    """The next state, or -1 where byte ``b`` can't follow."""
    if state == _START:
        if b < 0x80:
            return _START
        if 0xC2 <= b <= 0xDF:
            return _C1
        if 0xE0 <= b <= 0xEF:
            return _E0 if b == 0xE0 else _ED if b == 0xED else _C2
        if 0xF0 <= b <= 0xF4:
            return _F0 if b == 0xF0 else _F4 if b == 0xF4 else _C3
        return -1
    low, high, to = {_C1: (0x80, 0xBF, _START), _C2: (0x80, 0xBF, _C1), _C3: (0x80, 0xBF, _C2),
                     _E0: (0xA0, 0xBF, _C1), _ED: (0x80, 0x9F, _C1),
                     _F0: (0x90, 0xBF, _C2), _F4: (0x80, 0x8F, _C2)}[state]
    return to if low <= b <= high else -1


class StreamDecoder:
    """Ids to text, piece by piece.  Bytes that can't be UTF-8 become U+FFFD.

    ``feed`` returns the complete characters so far; ``finish`` what is left.
    Unknown ids raise KeyError.
    """

    def __init__(self, bytes_of: dict[int, bytes], clean: np.ndarray | None = None):
        self.bytes_of, self.state, self.left = bytes_of, _START, b""
        self.clean = clean if clean is not None else clean_tokens(bytes_of)
        self._over: dict[tuple[int, int], int] = {}

    def over(self, state: int, tok: int) -> int:
        """The state after a whole token; -1 if some byte of it can't follow."""
        to = self._over.get((state, tok))
        if to is None:
            to = state
            for b in self.bytes_of[tok]:
                to = utf8_step(to, b)
                if to < 0:
                    break
            self._over[state, tok] = to
        return to

    def feed_bytes(self, ids: array) -> bytes:
        """The bytes of the ids, moving the machine over them."""
        arr = np.frombuffer(ids, np.uint32) if len(ids) else np.zeros(0, np.uint32)
        odd = np.flatnonzero(~self.clean[np.minimum(arr, len(self.clean) - 1)])
        if self.state != _START or len(odd):
            last = -1
            for k in ([0] if self.state != _START and len(arr) else []) + odd.tolist():
                if k <= last:
                    continue
                last = k
                while last < len(arr):  # until a character is complete again
                    self.state = max(self.over(self.state, int(arr[last])), 0)
                    if self.state == _START:
                        break
                    last += 1
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def feed(self, ids) -> str:
        raw = self.left + self.feed_bytes(array("I", ids))
        keep, state = len(raw), _START
        for back in range(1, min(4, len(raw) + 1)):  # an unfinished character is at most three bytes
            lead = raw[-back]
            if lead >= 0xC0:
                state = _START
                for b in raw[-back:]:
                    state = utf8_step(state, b)
                    if state < 0:
                        break
                if state > _START:
                    keep = len(raw) - back
                break
            if lead < 0x80:
                break
        self.left = raw[keep:]
        return raw[:keep].decode("utf-8", "replace")

    def finish(self) -> str:
        out, self.left, self.state = self.left.decode("utf-8", "replace"), b"", _START
        return out


def clean_tokens(bytes_of: dict[int, bytes]) -> np.ndarray:
    """By id: does the token hold whole characters only?"""
    out = np.zeros(max(bytes_of) + 2, bool)
    for tok, raw in bytes_of.items():
        try:
            raw.decode("utf-8")
            out[tok] = True
        except UnicodeDecodeError:
            pass
    return out


# --- on DataFrames --------------------------------------------------------

@contextmanager
def no_collection():
    """Python's cycle collector off: it walks the (acyclic) tables again and again."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


_ENCODERS: dict[tuple[str, str], tuple[Encoder, np.ndarray]] = {}


def _encoder(rank_file: str, pattern: str) -> tuple[Encoder, np.ndarray]:
    """One encoder for each Python worker, reused by its tasks."""
    key = (rank_file, pattern)
    if key not in _ENCODERS:
        enc = Encoder(load_ranks(rank_file), pattern)
        _ENCODERS[key] = enc, clean_tokens(enc.fst.bytes_of)
    return _ENCODERS[key]


def encode(docs: DataFrame, rank_file: str, pattern: str, text: str = "text", out: str = "token_ids") -> DataFrame:
    """Every column of ``docs`` and ``out`` array<int>: the ids of its text (null: none).

    A column already named ``out`` is replaced.
    """
    docs = docs.drop(out)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, _ = _encoder(rank_file, pattern)
        try:
            for batch in slices(batches, text, SLICE_BYTES):
                at = batch.schema.get_field_index(text)
                texts = text_array(batch.column(at)).to_pylist()
                with no_collection():
                    ids = [array("I", chain.from_iterable(enc.ids(t))) for t in texts]
                off = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(x) for x in ids], out=off[1:])
                flat = np.frombuffer(b"".join(x.tobytes() for x in ids), np.int32)
                col = pa.ListArray.from_arrays(pa.array(off), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*batch.columns, col], names=[*batch.schema.names, out])
        finally:
            enc.clear()

    return docs.mapInArrow(run, f"{schema}, `{out}` array<int>")


def digests(docs: DataFrame, rank_file: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256 of every row, encoded and decoded in a stream."""
    key_t = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, clean = _encoder(rank_file, pattern)
        try:
            for batch in slices(batches, text, SLICE_BYTES):
                counts, of_ids, of_text = [], [], []
                with no_collection():
                    for t in text_array(batch.column(1)).to_pylist():
                        n, ids_sum, text_sum = 0, hashlib.sha256(), hashlib.sha256()
                        dec = StreamDecoder(enc.fst.bytes_of, clean)
                        for ids in enc.ids(t):
                            n += len(ids)
                            ids_sum.update(ids.tobytes())  # little-endian on the supported machines
                            text_sum.update(dec.feed_bytes(ids))
                        counts.append(n)
                        of_ids.append(ids_sum.hexdigest())
                        of_text.append(text_sum.hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()),
                     pa.array(of_text, pa.string())], names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])
        finally:
            enc.clear()

    return docs.select(key, text).mapInArrow(
        run, f"`{key}` {key_t}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
