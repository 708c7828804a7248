"""Encoding of whole texts by a byte-level BPE vocabulary.

Texts are cut at spaces that begin a pre-token (no pre-token spans such a place), so that each distinct piece is
pre-tokenized once per worker and batch of texts. All pre-tokens that are new go through one rank queue together:
a bucket per merge rank holds the positions (in linked lists of symbols) where that merge applies, a hierarchical bitmap
over the ranks gives the next one by find-first-set, and entries whose symbols have changed are skipped as stale. A
pre-token of any length costs a bounded amount of work per merge, also one of a million characters.

Defined cases
* A null text and an empty text both have the ids [] (no token).
* Strings of special tokens in a text are ordinary text. Lone surrogates can't occur in Spark strings.
* Texts are encoded whole, whatever their length; ids are those of the vocabulary file, in order.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.session import ship

# Fixed value: the pattern of the vocabulary's pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Fixed value: the characters that \s means there (Unicode White_Space).
WHITE = "\t-\r \x85\xa0  -     　"

# Texts are taken together up to so many bytes; a worker's tables are begun anew beyond so many pieces or characters
# (scripts without spaces make whole paragraphs pieces), so that their size is bounded by these and by one group.
GROUP_CHARS = 4_000_000
MOST_PIECES, MOST_CHARS = 400_000, 16_000_000
LONG_PIECE = 256


def default_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the public vocabulary files are: TALLYFRAME_TOKENIZERS, or the installed package."""
    if folder := os.environ.get("TALLYFRAME_TOKENIZERS"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in vocabulary files: printable ones for themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class RankQueue:
    """Positions by rank; `first` gives the least rank that has any. Three levels of 64 bits: up to 262,144 ranks."""

    def __init__(self) -> None:
        self.low = [0] * 4096
        self.mid = [0] * 64
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [position]
            self.mark(rank)
        else:
            bucket.append(position)

    def mark(self, rank: int) -> None:
        self.low[rank >> 6] |= 1 << (rank & 63)
        self.mid[rank >> 12] |= 1 << (rank >> 6 & 63)
        self.top |= 1 << (rank >> 12)

    def first(self) -> int:
        """The least rank, which leaves the queue with its bucket still to be taken; -1 if there is none."""
        if not self.top:
            return -1
        a = (self.top & -self.top).bit_length() - 1
        b = a << 6 | ((self.mid[a] & -self.mid[a]).bit_length() - 1)
        w = self.low[b]
        rank = b << 6 | ((w & -w).bit_length() - 1)
        self.low[b] = w & (w - 1)
        if not self.low[b]:
            self.mid[a] &= ~(1 << (b & 63))
            if not self.mid[a]:
                self.top &= ~(1 << a)
        return rank


def _with_room(table: np.ndarray, size: int) -> np.ndarray:
    """The table, or a copy of twice its length or more, that holds at least `size` entries."""
    if size <= len(table):
        return table
    more = np.zeros(max(size, 2 * len(table)), table.dtype)
    more[: len(table)] = table
    return more


class BytePairs:
    """A byte-level BPE vocabulary with its merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, letters = model["vocab"], _byte_letters()
        self.byte_id = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.byte_id[byte] = vocab[letter]
        self.left, self.right, self.merged, self.rank = [], [], [], {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            x, y = vocab[a], vocab[b]
            self.left.append(x)
            self.right.append(y)
            self.merged.append(vocab[a + b])
            self.rank.setdefault(x << 32 | y, rank)
        keys = np.fromiter(self.rank, np.int64, len(self.rank))
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], np.fromiter(self.rank.values(), np.int64, len(keys))[order]
        self.pre = regex.compile(PATTERN)
        self.cut = re.compile(f" (?=[^{WHITE}])")
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, list[int]] = {}  # ids of pre-tokens
        self.pieces: dict[str, int] = {}  # place in the tables below of a piece that follows a space
        self.openings: dict[str, int] = {}  # the same of a text's first piece, which no space precedes
        self.n_pieces = self.n_chars = self.n_ids = 0
        # With room to grow: doubled when full, so that learning costs no more than what is learned.
        self.ids = np.zeros(1 << 16, np.int32)
        self.starts = np.zeros(1 << 14, np.int64)

    def merge(self, pre_tokens: list[bytes]) -> list[list[int]]:
        """The ids of each pre-token, all of them through one rank queue."""
        sizes = np.fromiter(map(len, pre_tokens), np.int64, len(pre_tokens))
        flat = self.byte_id[np.frombuffer(b"".join(pre_tokens), np.uint8)]
        ends = np.cumsum(sizes)
        n = len(flat)
        inner = np.ones(n, bool)
        inner[ends[sizes > 0] - 1] = False
        at = np.flatnonzero(inner)
        pairs = flat[at] << 32 | flat[at + 1] if len(at) else np.zeros(0, np.int64)
        slot = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
        hit = self.keys[slot] == pairs
        at, ranks = at[hit], self.ranks[slot[hit]]
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]

        queue = RankQueue()
        bounds = np.flatnonzero(np.diff(ranks, prepend=-1, append=-1)) if len(ranks) else np.zeros(0, np.int64)
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            rank = int(ranks[lo])
            queue.buckets[rank] = at[lo:hi].tolist()
            queue.mark(rank)

        symbol = flat.tolist()
        after = np.where(inner, np.arange(1, n + 1), -1).tolist()
        before = np.arange(-1, n - 1)
        before[np.concatenate([[0], ends[:-1]])[sizes > 0]] = -1
        before = before.tolist()
        rank_of, push, left, right, merged = self.rank.get, queue.push, self.left, self.right, self.merged
        while (r := queue.first()) >= 0:
            a, b, m = left[r], right[r], merged[r]
            bucket = queue.buckets.pop(r)
            if a == b:
                bucket.sort()  # of overlapping pairs the first is merged
            for i in bucket:
                if symbol[i] != a or (j := after[i]) < 0 or symbol[j] != b:
                    continue  # stale
                symbol[i], symbol[j] = m, -1
                k = after[i] = after[j]
                if k >= 0:
                    before[k] = i
                    if (s := rank_of(m << 32 | symbol[k])) is not None:
                        push(s, i)
                h = before[i]
                if h >= 0 and (s := rank_of(symbol[h] << 32 | m)) is not None:
                    push(s, h)

        left_over = np.array(symbol, np.int64)
        kept = np.concatenate([[0], np.cumsum(left_over >= 0)])
        out = left_over[left_over >= 0].tolist()
        at = kept[ends].tolist()
        return [out[x:y] for x, y in zip([0, *at[:-1]], at)]

    def _learn(self, new: list[str]) -> None:
        """Fills the tables for pieces that weren't seen before."""
        split = [self.pre.findall(p) for p in new]
        todo = list(dict.fromkeys(t for ts in split for t in ts if t not in self.known))
        fresh = dict(zip(todo, self.merge([t.encode("utf-8") for t in todo]))) if todo else {}
        self.known.update((t, ids) for t, ids in fresh.items() if len(t) <= LONG_PIECE)
        flat, ends, total = [], [], self.n_ids
        for ts in split:
            for t in ts:
                ids = fresh.get(t)
                flat.extend(ids if ids is not None else self.known[t])
            ends.append(total + len(flat))
        self.ids = _with_room(self.ids, total + len(flat))
        self.ids[total : total + len(flat)] = flat
        self.starts = _with_room(self.starts, self.n_pieces + len(ends) + 1)
        self.starts[self.n_pieces + 1 : self.n_pieces + len(ends) + 1] = ends
        self.n_ids = total + len(flat)
        self.n_chars += sum(map(len, new))

    def _places(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(place of each piece of all texts, number of pieces up to each text's end)."""
        if self.n_pieces > MOST_PIECES or self.n_chars > MOST_CHARS:
            self.clear()
        counts, order, new = [0], [], []
        get = self.pieces.get
        for text in texts:
            if text:
                first, *rest = self.cut.split(text)
                if first:
                    if (place := self.openings.get(first)) is None:
                        place = self.openings[first] = self.n_pieces + len(new)
                        new.append(first)
                    order.append(place)
                for p in rest:
                    if (place := get(p)) is None:
                        place = self.pieces[p] = self.n_pieces + len(new)
                        new.append(" " + p)
                    order.append(place)
            counts.append(len(order))
        if new:
            self._learn(new)
            self.n_pieces += len(new)
        return np.array(order, np.int64), np.array(counts, np.int64)

    def counts(self, texts: list[str | None]) -> np.ndarray:
        """The number of tokens of each text."""
        places, ends = self._places(texts)
        sizes = np.concatenate([[0], np.cumsum(self.starts[places + 1] - self.starts[places])])
        return np.diff(sizes[ends])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, end of each text's ids, from 0)."""
        places, ends = self._places(texts)
        begin = self.starts[places]
        size = self.starts[places + 1] - begin
        upto = np.concatenate([[0], np.cumsum(size)])
        source = np.repeat(begin - upto[:-1], size) + np.arange(upto[-1])
        return self.ids[source], upto[ends]


_LOADED: dict[str, BytePairs] = {}


def vocabulary(path: str) -> BytePairs:
    """The vocabulary of this worker, read once."""
    if path not in _LOADED:
        _LOADED[path] = BytePairs(path)
    return _LOADED[path]


def groups(column: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) of consecutive rows that together have about GROUP_CHARS characters."""
    lengths = pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    start = 0
    while start < len(column):
        upto = np.searchsorted(np.cumsum(lengths[start:]), GROUP_CHARS) + 1
        stop = min(len(column), start + int(upto))
        yield start, column[start:stop].to_pylist()
        start = stop


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(key, ids): the token ids of each text. One pass without a shuffle."""
    ship(docs.sparkSession)
    path = path or default_path()
    key_type = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = vocabulary(path)
        for batch in batches:
            for start, texts in groups(batch.column(1)):
                ids, ends = pairs.encode(texts)
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(texts)), lists], names=[key, "ids"])

    return docs.select(F.col(key), F.col(text).cast("string")).mapInArrow(run, f"`{key}` {key_type}, ids array<int>")


def token_counts(docs: DataFrame, keep: list[str], text: str = "text", path: str | None = None) -> DataFrame:
    """The columns to keep and n_tokens of each text."""
    ship(docs.sparkSession)
    path = path or default_path()
    kept = docs.select(*keep)
    schema = kept.schema.add("n_tokens", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = vocabulary(path)
        for batch in batches:
            sizes = [pairs.counts(texts) for _, texts in groups(batch.column(batch.num_columns - 1))]
            n = pa.array(np.concatenate(sizes) if sizes else np.zeros(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], n], names=[*keep, "n_tokens"])

    return docs.select(*keep, F.col(text).cast("string").alias("__text")).mapInArrow(run, schema)
