"""Filling containers of fixed capacity with texts, measured in tokens.

Conflict-constrained best fit in decreasing order: open bins are kept by residual capacity under a hierarchical bitmap.
For an item the successor search starts at the residual that just holds it and goes on to larger ones until a residual
has a bin that is compatible: a bin holds no two texts of one duplicate cluster, nor sources that were declared to
conflict. Bins carry this as bitmaps, kept the other way round (the bins of each cluster, source and residual), so that
all bins of a residual are tested at once. Among equally tight bins one without the item's source is taken.

Texts are spread over independent shares of about BIN_TEXTS texts each by a hash of their id and their place in the
input, so that copies of one text, also those under one id or none, are spread as well. A share leaves a few partly
filled bins.

Defined cases
* A text that is longer than a container fills containers of its own; its last piece is an item like any other.
* Null and empty texts have no tokens and get no container (container and offset are null, n_tokens 0).
* Repeated ids are texts of their own (piece numbers start at 0 for each).
* A cluster that is larger than the number of bins opens new bins for the rest; nothing is dropped.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.text import strip_unicode
from tallyframe.llm.tokens import token_counts
from tallyframe.session import ship

BIN_TEXTS = 50_000


class Bins:
    """Open bins of one share, by residual."""

    def __init__(self, capacity: int, conflicts: Mapping[str, frozenset[str]] = {}):
        self.capacity, self.conflicts = capacity, conflicts
        self.at = [0] * (capacity + 1)  # bins of each residual, as a bitmap
        self.words = [0] * (capacity // 64 + 1)  # residuals that have a bin
        self.top = 0  # words that aren't zero
        self.residual: list[int] = []
        self.of_cluster: dict = defaultdict(int)
        self.of_source: dict = defaultdict(int)

    def _put(self, bin_no: int, residual: int) -> None:
        self.residual[bin_no] = residual
        self.at[residual] |= 1 << bin_no
        self.words[residual >> 6] |= 1 << (residual & 63)
        self.top |= 1 << (residual >> 6)

    def _take(self, bin_no: int) -> int:
        r = self.residual[bin_no]
        self.at[r] ^= 1 << bin_no
        if not self.at[r]:
            self.words[r >> 6] ^= 1 << (r & 63)
            if not self.words[r >> 6]:
                self.top ^= 1 << (r >> 6)
        return r

    def _successor(self, residual: int) -> int:
        """The least residual from this one on that has a bin, or -1."""
        if residual > self.capacity:
            return -1
        w = residual >> 6
        word = self.words[w] >> (residual & 63)
        if word:
            return residual + (word & -word).bit_length() - 1
        above = self.top >> (w + 1)
        if not above:
            return -1
        w += (above & -above).bit_length()
        return w << 6 | ((self.words[w] & -self.words[w]).bit_length() - 1)

    def add(self, size: int, source, cluster) -> tuple[int, int]:
        """(bin, offset in it) of an item that fits into a bin."""
        barred = self.of_cluster[cluster] if cluster is not None else 0
        for other in self.conflicts.get(source, ()):
            barred |= self.of_source[other]
        r = self._successor(size)
        while r >= 0:
            if free := self.at[r] & ~barred:
                if apart := free & ~self.of_source[source]:
                    free = apart
                bin_no = (free & -free).bit_length() - 1
                offset = self.capacity - self._take(bin_no)
                break
            r = self._successor(r + 1)
        else:
            bin_no, offset = len(self.residual), 0
            self.residual.append(self.capacity)
        self._put(bin_no, self.capacity - offset - size)
        self.of_source[source] |= 1 << bin_no
        if cluster is not None:
            self.of_cluster[cluster] |= 1 << bin_no
        return bin_no, offset


def pack(sizes: list[int], sources: list, clusters: list, ids: list, capacity: int, conflicts: Mapping[str, frozenset[str]] = {}) -> list[tuple[int, int, int, int, int]]:
    """(item, piece, bin, offset, tokens) for each piece of each item with tokens."""
    bins, out, pieces = Bins(capacity, conflicts), [], []
    shared = defaultdict(int)
    for i, (size, cluster) in enumerate(zip(sizes, clusters)):
        if size > 0:
            shared[cluster] += 1
            whole, rest = divmod(size, capacity)
            pieces += [(capacity, i, k) for k in range(whole)]
            if rest:
                pieces.append((rest, i, whole))
    pieces.sort(key=lambda p: (-p[0], ids[p[1]], p[1], p[2]))
    for size, i, k in pieces:
        # Pieces of one text may share a bin; clusters of one text need no bitmap.
        cluster = clusters[i] if clusters[i] is not None and shared[clusters[i]] > 1 else None
        bin_no, offset = bins.add(size, sources[i], cluster)
        out.append((i, k, bin_no, offset, size))
    return out


def duplicate_cluster(text: Column) -> Column:
    """Copies of one text, regardless of case and of white space of any kind around it."""
    return F.xxhash64(F.lower(strip_unicode(text)))


def fill(docs: DataFrame, capacity: int = 2048, conflicts: Mapping[str, frozenset[str]] = {}, key: str = "doc_id", path: str | None = None, share: int = BIN_TEXTS) -> DataFrame:
    """(key, piece, container, offset, n_tokens): where each text, or each piece of one too long, goes.

    Sizes come from `token_counts`. One shuffle of ids and sizes; the texts themselves stay where they are read."""
    ship(docs.sparkSession)
    sized = token_counts(docs.select(F.col(key).alias("id"), "source", duplicate_cluster(F.col("text")).alias("cluster"), F.monotonically_increasing_id().alias("place"), "text"), ["id", "source", "cluster", "place"], path=path)
    shares = max(1, -(-docs.count() // share))  # of Parquet only the footers are read for this

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share_rows = list(batches)  # a bounded number of texts
        table = pa.Table.from_batches(share_rows) if share_rows else None
        if table is None or not table.num_rows:
            return
        ids, sources, clusters, sizes = (c.to_pylist() for c in table.columns)
        order = [-(2**63) if i is None else i for i in ids]
        rows = pack(sizes, sources, clusters, order, capacity, conflicts)
        base = TaskContext.get().partitionId() << 32
        item, piece, bin_no, offset, size = zip(*rows) if rows else ((),) * 5
        empty = [i for i, n in enumerate(sizes) if not n]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([ids[i] for i in (*item, *empty)], pa.int64()),
                pa.array([*piece, *(0 for _ in empty)], pa.int32()),
                pa.array([*(base + b for b in bin_no), *(None for _ in empty)], pa.int64()),
                pa.array([*offset, *(None for _ in empty)], pa.int32()),
                pa.array([*size, *(0 for _ in empty)], pa.int32()),
            ],
            names=[key, "piece", "container", "offset", "n_tokens"],
        )

    # The place is the same whenever a partition is computed again.
    spread = sized.repartition(shares, F.xxhash64("id", "cluster", "place")).drop("place")
    return spread.mapInArrow(run, f"`{key}` bigint, piece int, container bigint, offset int, n_tokens int")


def fill_report(filled: DataFrame, capacity: int = 2048) -> DataFrame:
    """(containers, tokens, unused_share)."""
    used = filled.where("container IS NOT NULL").groupBy("container").agg(F.sum("n_tokens").alias("used"))
    return used.agg(F.count("*").alias("containers"), F.sum("used").alias("tokens"), (1 - F.sum("used") / (F.count("*") * capacity)).alias("unused_share"))
