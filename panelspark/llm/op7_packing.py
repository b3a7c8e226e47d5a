"""Best-fit packing under conflicts.

Documents are packed into bins of a fixed number of words. No bin holds two
documents of one source or of one duplicate cluster: each bin carries a bitmap
of the sources and one of the clusters in it. Bins are kept ordered by
residual capacity; the search starts at the smallest residual that fits and
walks to its successors until the tightest bin without conflict is found. A
document longer than a bin is split without loss; its full pieces fill bins of
their own.

Documents are dealt to shards by a hash, as many as keep a shard near
`shard_rows` rows, and each shard is packed by one task: a hot source or
cluster is spread over all shards, and the work grows with the rows.

Defined cases: null or empty text has size 0 and is placed like any other; a
null source or cluster conflicts with nothing; ties of size go by doc_id;
repeated rows are placed each; an empty table gives none. Only the named
columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm import op2_near_duplicates
from panelspark.llm.common import materialise, split_words

CAPACITY = 2048
SHARD_ROWS = 4000
SCHEMA = "doc_id bigint, piece int, start bigint, size int, shard int, bin int, at int"


class Bins:
    """Bins ordered by (residual, number), each with its two bitmaps."""

    def __init__(self, capacity: int):
        self.capacity, self.order, self.residual, self.sources, self.clusters = capacity, [], [], [], []

    def open(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        number = len(self.residual)
        self.residual.append(self.capacity - size)
        self.sources.append(source)
        self.clusters.append(cluster)
        insort(self.order, (self.capacity - size, number))
        return number, 0

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """Bin and offset of an item; source and cluster are its bits (0: none)."""
        order, sources, clusters = self.order, self.sources, self.clusters
        for k in range(bisect_left(order, (size, -1)), len(order)):
            residual, number = order[k]
            if not (sources[number] & source or clusters[number] & cluster):
                del order[k]
                sources[number] |= source
                clusters[number] |= cluster
                self.residual[number] = residual - size
                insort(order, (residual - size, number))
                return number, self.capacity - residual
        return self.open(size, source, cluster)


def _bits(keys: list) -> list[int]:
    """A bit for each key that occurs twice or more, 0 for the others and for null: they can't conflict."""
    count: dict = {}
    for k in keys:
        count[k] = count.get(k, 0) + 1
    bit = {k: 1 << i for i, k in enumerate(k for k, n in count.items() if n > 1 and k is not None)}
    return [bit.get(k, 0) for k in keys]


def pack_shard(rows: list[tuple], capacity: int) -> list[tuple]:
    """rows: (doc_id, size, source, cluster). Returns (doc_id, piece, start, size, bin, at)."""
    sources, clusters = _bits([r[2] for r in rows]), _bits([r[3] for r in rows])
    items = []
    for (doc, size, _, _), s, c in zip(rows, sources, clusters):
        full = max(0, (size - 1) // capacity)
        items += [(capacity, doc, k, s, c) for k in range(full)] + [(size - full * capacity, doc, full, s, c)]
    items.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0, x[2]))
    bins, out = Bins(capacity), []
    for size, doc, piece, s, c in items:
        number, at = bins.open(size, s, c) if size == capacity else bins.place(size, s, c)
        out.append((doc, piece, piece * capacity, size, number, at))
    return out


def pack(df: DataFrame, size: Column, cluster: Column, doc_id: str = "doc_id", source: str = "source",
         capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """A row for each piece of each document: where it starts in the document, its shard, bin and offset."""
    rows = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(size, F.lit(0)).cast("bigint").alias("size"),
                     F.col(source).cast("string").alias("source"), cluster.cast("string").alias("cluster"))
    n_shards = max(1, -(-df.count() // shard_rows))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "size"), F.lit(n_shards)).cast("int"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        null = lambda v: None if pd.isna(v) else v
        got = pack_shard([(None if pd.isna(d) else int(d), int(n), null(s), null(c)) for d, n, s, c in
                          zip(pdf.doc_id, pdf["size"], pdf.source, pdf.cluster)], capacity)
        out = pd.DataFrame(got, columns=["doc_id", "piece", "start", "size", "bin", "at"])
        out["doc_id"] = out["doc_id"].astype("Int64")
        out.insert(4, "shard", int(pdf.shard.iloc[0]))
        return out

    return rows.groupBy("shard").applyInPandas(run, SCHEMA)


def with_clusters(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, words, cluster) of every row, written once: the number of words and the class of near-duplicates,
    null without words. Texts are read and their words counted as they are signed; classes are named by a digest of id and
    text, so null and repeated ids keep their own."""
    keyed = df.select(F.xxhash64(doc_id, text).alias("key"), F.col(doc_id).alias("own_id"), F.col(source).alias("source"), F.col(text).alias("text"))
    rows = op2_near_duplicates.classes(keyed, "key", also=("own_id", "source"), measures={"words": count_words})
    return materialise(rows.select(F.col("own_id").alias("doc_id"), "source", F.coalesce("words", F.lit(0)).alias("words"),
                                   F.when(F.col("words") > 0, F.col("class_id")).alias("cluster")))


def count_words(texts: list[str]) -> np.ndarray:
    """The number of words of each text, as `words_in` counts them."""
    raw = [t.encode() + b" " for t in texts]
    b = np.frombuffer(b" " + b"".join(raw), np.uint8)
    gap = (b == 32) | (b - np.uint8(9) < 5)
    begins, ends = np.flatnonzero(gap[:-1] & ~gap[1:]), np.cumsum([len(t) for t in raw])
    return np.diff(np.searchsorted(begins, ends), prepend=0)


def words_in(text: str) -> Column:
    return F.size(split_words(F.col(text)))


def same_words(text: str) -> Column:
    """A cluster key: equal for texts that differ in case or white space only; null without words."""
    w = split_words(F.lower(F.col(text)))
    return F.when(F.size(w) > 0, F.md5(F.array_join(w, " ")))
