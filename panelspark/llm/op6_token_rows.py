"""Token-id output: documents packed into fixed-width rows of ids.

Ids (with an end mark after each document) are cut into pieces of at most one
row: every full row stands alone, the rest is packed best-fit-decreasing. A
segment tree over capacities 0..width knows which remaining capacities occur
and finds the smallest that fits in log(width) steps. Nothing is dropped: the
pieces of a document carry its id and piece number.

Packing works on blocks of about `block_tokens` tokens within a task, so
memory is bounded and no token is shuffled.

Defined cases: null text counts as empty; an empty text gives one piece, its
end mark; texts of any length are split; equal lengths pack in the order of
doc_id, then input; repeated rows are packed each; an empty table gives none.
Only the id and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ENCODERS: dict[tuple[str, str], object] = {}


def encoder(rank_file: str, pattern: str):
    """The library's encoder over a rank file; one a worker process."""
    import tiktoken

    if (rank_file, pattern) not in _ENCODERS:
        with open(rank_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        _ENCODERS[rank_file, pattern] = tiktoken.Encoding("rows", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[rank_file, pattern]


WIDTH = 2048
BLOCK_TOKENS = 4_000_000
SCHEMA = ("block string, row int, n_tokens int, ids binary, cu_seqlens array<int>, position_ids binary, "
          "doc_ids array<bigint>, pieces array<int>")


class CapacityTree:
    """Which remaining capacities have an open row: counts at the leaves, sums above."""

    def __init__(self, width: int):
        self.leaves = 1 << width.bit_length()
        self.sums = [0] * (2 * self.leaves)

    def add(self, capacity: int, n: int) -> None:
        at = self.leaves + capacity
        while at:
            self.sums[at] += n
            at >>= 1

    def smallest_from(self, size: int) -> int | None:
        """The smallest capacity >= size that occurs."""
        at, sums = self.leaves + size, self.sums
        if sums[at]:
            return size
        while at > 1:
            if not at & 1 and sums[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if sums[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return None


def best_fit_decreasing(sizes: list[int], width: int) -> list[list[int]]:
    """Rows as lists of item numbers; each size is 1..width."""
    tree, open_rows, rows = CapacityTree(width), [[] for _ in range(width + 1)], []
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[item]
        capacity = tree.smallest_from(size)
        if capacity is None:
            row, capacity = len(rows), width
            rows.append([])
        else:
            row = open_rows[capacity].pop()
            tree.add(capacity, -1)
        rows[row].append(item)
        open_rows[capacity - size].append(row)
        tree.add(capacity - size, 1)
    return rows


def pack_block(docs: list[tuple[int | None, np.ndarray]], width: int, dtype: str):
    """Rows of a block: (n_tokens, ids, cumulative segment lengths, positions, doc ids, piece numbers)."""
    pieces = [(doc, k, ids[at:at + width]) for doc, ids in docs for k, at in enumerate(range(0, len(ids), width))]
    for items in best_fit_decreasing([len(p[2]) for p in pieces], width):
        parts = [pieces[i] for i in items]
        ends = np.cumsum([0] + [len(p[2]) for p in parts])
        row = np.zeros(width, dtype)
        row[:ends[-1]] = np.concatenate([p[2] for p in parts])
        position = np.zeros(width, "<i4")
        position[:ends[-1]] = np.arange(ends[-1]) - np.repeat(ends[:-1], np.diff(ends))
        yield int(ends[-1]), row.tobytes(), ends.tolist(), position.tobytes(), [p[0] for p in parts], [p[1] for p in parts]


def pack_rows(df: DataFrame, rank_file: str, pattern: str, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH,
              block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One output row a packed row: its ids (little-endian uint16 if the ids fit, else uint32, padded with 0 up to
    `width`), cumulative segment lengths, positions that restart with each segment (int32), and whose pieces they are.
    A block is named by the digest of its documents, so the name does not depend on when or where it ran."""
    docs = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))

    def run(batches):
        enc = encoder(rank_file, pattern)
        end, dtype = enc.max_token_value + 1, "<u2" if enc.max_token_value + 1 < 1 << 16 else "<u4"
        block, held, name = [], 0, hashlib.sha256()

        def flush():
            block.sort(key=lambda d: (d[0] is None, d[0] or 0))
            rows = list(pack_block(block, width, dtype))
            cols = list(zip(*rows)) if rows else [[]] * 6
            label = name.hexdigest()[:24]
            return pa.RecordBatch.from_arrays([
                pa.array([label] * len(rows), pa.string()), pa.array(range(len(rows)), pa.int32()), pa.array(cols[0], pa.int32()),
                pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.list_(pa.int32())), pa.array(cols[3], pa.binary()),
                pa.array(cols[4], pa.list_(pa.int64())), pa.array(cols[5], pa.list_(pa.int32()))],
                names=["block", "row", "n_tokens", "ids", "cu_seqlens", "position_ids", "doc_ids", "pieces"])

        for batch in batches:
            for doc, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.array([*enc.encode_ordinary(t or ""), end], "<i4")
                block.append((doc, ids))
                name.update(b"%s:%d:" % (str(doc).encode(), len(ids)) + ids.tobytes())
                held += len(ids)
                if held >= block_tokens:
                    yield flush()
                    block, held, name = [], 0, hashlib.sha256()
        if block:
            yield flush()

    return docs.mapInArrow(run, SCHEMA)


def unpack_rows(packed: DataFrame, vocabulary_size: int) -> DataFrame:
    """(doc_id, ids without end mark) of every document, from its pieces in order."""
    item = "H" if vocabulary_size < 1 << 16 else "I"

    def run(batches):
        for batch in batches:
            out = [[], [], []]
            for ids, ends, docs, pieces in zip(*(batch.column(c).to_pylist() for c in ("ids", "cu_seqlens", "doc_ids", "pieces"))):
                row = np.frombuffer(ids, "<u2" if item == "H" else "<u4")
                for a, b, d, k in zip(ends, ends[1:], docs, pieces):
                    for col, v in zip(out, (d, k, row[a:b].tolist())):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()),
                                              pa.array(out[2], pa.list_(pa.int32()))], names=["doc_id", "piece", "ids"])

    parts = packed.mapInArrow(run, "doc_id bigint, piece int, ids array<int>")
    whole = parts.groupBy("doc_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("piece", "ids"))), lambda p: p["ids"])).alias("ids"))
    return whole.select("doc_id", F.slice("ids", 1, F.size("ids") - 1).alias("ids"))


def write_matrices(packed: DataFrame, path: str) -> None:
    """Rows as Parquet: the binary column `ids`, taken row after row, is the id matrix of a block."""
    packed.write.mode("errorifexists").parquet(path)
