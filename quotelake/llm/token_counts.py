"""Token counts without ids (operator 11).

A byte-level BPE never merges across pre-tokens, so a text's token count is
the sum of its pre-tokens' counts.

1. Tasks part their texts into pre-tokens and keep, for each block of texts,
   the block's distinct pre-tokens and every document's frequencies of them
   (packed variable-length integers).  A block ends at ``BLOCK_PIECES``
   distinct pre-tokens or ``BLOCK_ENTRIES`` frequencies, so memory is bounded
   and a pre-token leaves a block once however often it stands there.
2. Equal pre-tokens of all blocks meet in one sorted run, and the library
   counts the tokens of each distinct pre-token of the corpus once.
3. The counts join the documents' frequencies by block, where frequency times
   count is summed for every document.

Neither ids nor texts are shuffled.  Added tokens of the file (such as
``<|endoftext|>``) found inside a text count as one token, as the library
does by default.  The ``regex`` module splits texts whose characters it is
known to class as the library does (each character is tried once in every
worker); the library's own pre-tokenizer splits all others.

A null text is empty and has no tokens.  Rows that repeat a doc_id, or have
none, are counted each.  An empty table gives no rows.  Other columns are
ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import materialize, release, text_array

LIMIT = 512
#: A block of texts ends at so many distinct pre-tokens or frequencies.
BLOCK_PIECES = 1_000_000
BLOCK_ENTRIES = 8_000_000

FREQUENCIES = "block bigint, doc_id bigint, n_bytes bigint, n_added bigint, places binary, often binary, pieces array<string>"


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers below 2**35 as seven bits a byte, lowest first, the high bit on all but the last."""
    v = values.astype(np.uint64)
    parts = np.stack([(v >> np.uint64(7 * k)) & np.uint64(127) for k in range(5)], axis=1)
    size = 1 + sum((v >= np.uint64(1 << (7 * k))).astype(np.int64) for k in range(1, 5))
    at = np.arange(5)
    parts |= np.where(at < (size - 1)[:, None], np.uint64(128), np.uint64(0))
    return parts[at < size[:, None]].astype(np.uint8).tobytes()


def unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    last = np.flatnonzero(raw < 128)
    if not len(last):
        return np.zeros(0, np.int64)
    start = np.concatenate([[0], last[:-1] + 1])
    shift = 7 * (np.arange(len(raw)) - np.repeat(start, last - start + 1))
    return np.add.reduceat((raw & 127).astype(np.int64) << shift, start)


def frequency(places: bytes, often: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The places of a document's pre-tokens in its block, and how often each stands in the document.

    ``places`` holds the steps from place to place, ``often`` the steps to
    those found more than once, then their numbers.
    """
    at = np.cumsum(unpack(places))
    more, count = unpack(often).reshape(2, -1)
    freq = np.ones(len(at), np.int64)
    freq[np.cumsum(more)] = count
    return at, freq


class Pieces:
    """Pre-tokens of texts as the library parts them."""

    def __init__(self, path: str, pattern: str):
        self.tok = Tokenizer.from_file(path)
        self.pattern = regex.compile(pattern)
        self.alike: set[str] = set()
        self.other: set[str] = set()
        added = self.tok.get_added_tokens_decoder().values()
        if any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added):
            raise ValueError("added tokens that take blanks or whole words are not supported")
        names = sorted((t.content for t in added), key=len, reverse=True)  # the longest first, as the library does
        self.added = re.compile("|".join(map(re.escape, names))) if names else None

    def _classed_alike(self, char: str) -> bool:
        """Whether both split the character alike among letters, digits, signs and blanks."""
        probe = f"a{char}a 1{char}1 !{char}! {char}  {char}"
        return [m.span() for m in self.pattern.finditer(probe)] == [s for _, s in self.tok.pre_tokenizer.pre_tokenize_str(probe)]

    def split(self, text: str) -> list[str]:
        """The pre-tokens of a text without added tokens, as plain text."""
        chars = set(text)
        if not chars <= self.alike:
            for c in chars - self.alike - self.other:
                (self.alike if self._classed_alike(c) else self.other).add(c)
        if chars <= self.alike:
            return self.pattern.findall(text)
        return [text[a:b] for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(text)]

    def texts(self, text: str) -> tuple[list[str], int]:
        """The stretches between added tokens, and the number of these."""
        if self.added is None or not self.added.search(text):
            return [text], 0
        parts = self.added.split(text)
        return parts, len(parts) - 1

    def count(self, piece: str) -> int:
        """Tokens of one pre-token."""
        return sum(len(self.tok.model.tokenize(mapped)) for mapped, _ in self.tok.pre_tokenizer.pre_tokenize_str(piece))


_LOADED: dict[tuple[str, str], Pieces] = {}


def loaded(path: str, pattern: str) -> Pieces:
    """The tokenizer of this worker; it keeps the vocabulary and the characters it has tried."""
    key = path, pattern
    if key not in _LOADED:
        _LOADED[key] = Pieces(path, pattern)
    return _LOADED[key]


def _frequencies(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = loaded(path, pattern)
        base, blocks = TaskContext.get().partitionId() << 32, 0
        place: dict[str, int] = {}
        ids, sizes, added, places, often, held = [], [], [], [], [], 0

        def block():
            n = len(ids)
            cols = [[base + blocks] * (n + 1), ids + [None], sizes + [None], added + [None], places + [None],
                    often + [None], [None] * n + [list(place)]]
            schema = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()),
                                ("n_added", pa.int64()), ("places", pa.binary()), ("often", pa.binary()),
                                ("pieces", pa.list_(pa.string()))])
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)

        for batch in batches:
            for doc_id, value in zip(batch.column("doc_id").to_pylist(), text_array(batch.column("text"))):
                stretches, n_added = tok.texts(value.as_py())
                freq = Counter()
                for s in stretches:
                    freq.update(tok.split(s))
                at = np.fromiter((place.setdefault(p, len(place)) for p in freq), np.int64, len(freq))
                order = np.argsort(at)
                count = np.fromiter(freq.values(), np.int64, len(freq))[order]
                more = np.flatnonzero(count > 1)
                ids.append(doc_id)
                sizes.append(value.as_buffer().size if value.as_buffer() is not None else 0)
                added.append(n_added)
                places.append(pack(np.diff(at[order], prepend=0)))
                often.append(pack(np.concatenate([np.diff(more, prepend=0), count[more]])))
                held += len(at)
                if len(place) >= BLOCK_PIECES or held >= BLOCK_ENTRIES:
                    yield block()
                    place, ids, sizes, added, places, often, held, blocks = {}, [], [], [], [], [], 0, blocks + 1
        if ids:
            yield block()

    return run


def frequencies(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """A row for each document (block, doc_id, n_bytes, n_added, places, often) and one for each block (block, pieces)."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_frequencies(path, pattern), FREQUENCIES)


def _count(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, last = loaded(path, pattern), (None, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            coded = batch.column("piece").dictionary_encode()
            words = coded.dictionary.to_pylist()  # in order of place: the first may go on from the batch before
            sizes = [last[1] if p == last[0] else tok.count(p) for p in words]
            last = words[-1], sizes[-1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("place"), pa.array(sizes, pa.int32()).take(coded.indices)],
                ["block", "place", "n"])

    return run


def piece_counts(pieces: DataFrame, path: str, pattern: str) -> DataFrame:
    """block, place, n for every place of a piece; equal pieces meet in one sorted run, which is counted once."""
    return pieces.repartition("piece").sortWithinPartitions("piece").mapInArrow(
        _count(path, pattern), "block bigint, place int, n int")


def _sum(key, docs: pa.Table, counts: pa.Table) -> pa.Table:
    n = np.zeros(counts.num_rows, np.int64)
    n[counts.column("place").to_numpy()] = counts.column("n").to_numpy()
    total = []
    for places, often in zip(docs.column("places").to_pylist(), docs.column("often").to_pylist()):
        at, freq = frequency(places, often)
        total.append(int(n[at] @ freq))
    tokens = pa.array(total, pa.int64())
    return pa.table({"doc_id": docs.column("doc_id"), "n_bytes": docs.column("n_bytes"),
                     "n_tokens": pc.add(tokens, docs.column("n_added").combine_chunks())})


def token_counts(docs: DataFrame, path: str, pattern: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document."""
    table = materialize(frequencies(docs, path, pattern), "token-frequencies")
    pieces = table.where("pieces is not null").select("block", F.posexplode("pieces").alias("place", "piece"))
    counts = materialize(piece_counts(pieces, path, pattern), "token-pieces")
    release(docs.sparkSession)
    rows = table.where("pieces is null").select("block", "doc_id", "n_bytes", "n_added", "places", "often")
    out = rows.groupBy("block").cogroup(counts.groupBy("block")) \
        .applyInArrow(_sum, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
