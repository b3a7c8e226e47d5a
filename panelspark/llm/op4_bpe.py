"""Byte-level BPE encoding and decoding.

A pre-token is a linked list of byte pieces. All neighbouring pairs that the
vocabulary can merge wait in buckets, one a merge rank, that hold list
positions. Which buckets are filled is kept in a bitmap of two levels, so two
find-first-set steps give the lowest rank, whatever the length; entries whose
pair has changed meanwhile are stale and skipped. The cost is linear in the
length but for the order within a bucket. Merged pre-tokens are remembered in
a table of bounded size, as words recur.

Defined cases: null text encodes as empty text, to no ids; texts and
pre-tokens of any length are encoded whole; rows are independent, so repeated
rows and ties need nothing; input columns stay and the new column is renamed
if its name is taken; an empty table gives an empty one.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.llm.common import free_name

CACHE_ENTRIES = 1_000_000


class Vocabulary:
    """Merge ranks of a rank file (base64 bytes, blank, rank on each line)."""

    def __init__(self, rank_file: str, pattern: str):
        import regex

        with open(rank_file, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        self.pieces = {b: a for a, b in self.ranks.items()}
        self.size = max(self.ranks.values()) + 1
        self.of_byte = [self.ranks[bytes([i])] for i in range(256)]
        # The id of two neighbours' joined bytes, which is also the rank of their merge.
        self.joined = {self.ranks[t[:i]] * self.size + self.ranks[t[i:]]: r for t, r in self.ranks.items()
                       for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks}
        self.find = regex.compile(pattern).findall
        self.after_blank: dict[str, bytes] = {}  # pre-tokens that begin with a blank, without it -> ids as int32 bytes
        self.plain: dict[str, bytes] = {}  # other pre-tokens

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token of any length."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        joined, size = self.joined.get, self.size
        ids = [self.of_byte[c] for c in piece]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # The queue: `top` has a bit for each word of 64 ranks, `words` a bit for each rank, and `buckets` its
        # positions: one number, or a heap of several.
        top, words, buckets = 0, {}, {}
        due = [(r, i) for i, r in enumerate([joined(x * size + y) for x, y in zip(ids, ids[1:])]) if r is not None]
        while True:
            for rank, i in due:
                if rank in buckets:
                    bucket = buckets[rank]
                    if type(bucket) is int:
                        buckets[rank] = [bucket, i] if bucket < i else [i, bucket]
                    else:
                        heapq.heappush(bucket, i)
                else:
                    buckets[rank] = i
                    w = rank >> 6
                    words[w] = words.get(w, 0) | 1 << (rank & 63)
                    top |= 1 << w
            if not top:
                break
            w = (top & -top).bit_length() - 1  # find first set
            bits = words[w]
            rank = w << 6 | (bits & -bits).bit_length() - 1
            i = buckets[rank]
            if type(i) is not int:
                bucket, i = i, heapq.heappop(i)
            if type(buckets[rank]) is int or not bucket:
                del buckets[rank]
                words[w] = bits = bits & (bits - 1)
                if not bits:
                    top &= top - 1
            due = []
            x, j = ids[i], after[i]
            if x < 0 or j == n or joined(x * size + ids[j]) != rank:
                continue  # stale: one of the two has been merged since
            ids[i], ids[j] = rank, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                r = joined(rank * size + ids[k])
                if r is not None:
                    due.append((r, i))
            h = before[i]
            if h >= 0:
                r = joined(ids[h] * size + rank)
                if r is not None:
                    due.append((r, h))
        return [x for x in ids if x >= 0]

    def ids_of(self, piece: str) -> bytes:
        """Ids of one pre-token as int32 bytes, remembered."""
        known, key = (self.after_blank, piece[1:]) if piece[0] == " " else (self.plain, piece)
        ids = known.get(key)
        if ids is None:
            ids = pack("<%di" % len(found := self.merge(piece.encode())), *found)
            if len(piece) <= 64:
                if len(known) >= CACHE_ENTRIES:
                    known.clear()
                known[key] = ids
        return ids

    def chunk(self, chunk: str) -> bytes:
        """Ids of a chunk of text that begins and ends at pre-token boundaries."""
        word = chunk.rstrip(MARKS)
        if word[1:].isalpha() and word[0] == " ":  # a word, then a run of marks or nothing: one match each
            return self.ids_of(word) + (self.ids_of(chunk[len(word):]) if len(word) < len(chunk) else b"")
        return b"".join(map(self.ids_of, self.find(chunk)))

    def encode(self, text: str) -> bytes:
        """Every blank that a non-blank follows begins a pre-token, so the text is cut there; a chunk that is one
        pre-token is looked up, others are split by the pattern. Each match of the pattern is merged separately."""
        first, *rest = CUT.split(text)
        get, chunk = self.after_blank.get, self.chunk
        return chunk(first) + b"".join([get(c) or chunk(" " + c) for c in rest])


#: Neither white space nor letters, digits or apostrophes: at the end of a chunk a run of them is one match.
MARKS = ".,;:!?*$%&#|"
CUT = re.compile(r" (?=\S)")
_VOCABULARIES: dict[tuple[str, str], Vocabulary] = {}


def vocabulary(rank_file: str, pattern: str) -> Vocabulary:
    """One a worker process."""
    if (rank_file, pattern) not in _VOCABULARIES:
        _VOCABULARIES[rank_file, pattern] = Vocabulary(rank_file, pattern)
    return _VOCABULARIES[rank_file, pattern]


def _lists(parts: list[bytes]) -> pa.Array:
    ends = np.cumsum([0] + [len(p) // 4 for p in parts], dtype=np.int64)
    return pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(np.frombuffer(b"".join(parts), dtype="<i4"), pa.int32()))


def _slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Small slices keep what a task holds near the size of its longest texts."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def encode(df: DataFrame, rank_file: str, pattern: str, text: str = "text", out: str = "ids", keep_text: bool = True) -> DataFrame:
    """Adds the token ids of every text as array<int>."""
    out = free_name(df, out)
    kept = [f for f in df.schema.fields if keep_text or f.name != text]
    schema = T.StructType([*kept, T.StructField(out, T.ArrayType(T.IntegerType(), False))])

    def run(batches):
        voc = vocabulary(rank_file, pattern)
        for whole in batches:
            for batch in _slices(whole):
                ids = _lists([voc.encode(t) if t else b"" for t in batch.column(text).to_pylist()])
                columns = [batch.column(f.name) for f in kept] + [ids.cast(pa.list_(pa.field("element", pa.int32(), nullable=False)))]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, rank_file: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the bytes that the ids stand for (null ids: no bytes)."""
    out = free_name(df, out)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.BinaryType())])

    def run(batches):
        voc = vocabulary(rank_file, pattern)
        pieces = [voc.pieces.get(i, b"") for i in range(voc.size)]
        for whole in batches:
            for batch in _slices(whole):
                col = batch.column(ids)
                flat = col.values.to_numpy(zero_copy_only=False)
                ends = col.offsets.to_numpy(zero_copy_only=False)
                get = pieces.__getitem__
                parts = [b"".join(map(get, flat[a:b].tolist())) for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(parts, pa.binary())], names=schema.fieldNames())

    return df.mapInArrow(run, schema)


def round_trip(df: DataFrame, rank_file: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes and decodes every text: per document the number of ids, a digest of the ids and one of the decoded bytes."""
    docs = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    both = decode(encode(docs, rank_file, pattern, keep_text=False), rank_file, pattern)
    return both.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
