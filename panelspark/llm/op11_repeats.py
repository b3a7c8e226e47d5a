"""Removal of repeated passages by prefix-partitioned suffix trees.

A window is WINDOW consecutive words of one document. Words of a window that
occurs in a document with a smaller id, too, are removed; runs of such windows
are the maximal repeats. Windows meet in a sparse suffix tree: each window has
an anchor, the least-hashed run of ANCHOR words within it, and is spelled from
its anchor on (the words from the anchor to its end, then those before the
anchor, then how many those are). Equal windows have equal anchors, so a node
at full depth is a window, and one with leaves in two documents is a repeat.

1. Documents are dealt to *parts* of a few MB by a hash, once; every later step
   reads that one shuffle.
2. Pruning, exact: an anchor that occurs in one document only begins no repeat.
   Each part names each of its anchors once, with the least and largest id.
3. Prefixes: words that start more than `group` suffixes are too large a group;
   they are extended word by word, up to the anchor's length, until a prefix has
   few enough. The table of extended prefixes is bounded: a level has at most
   2 (number of words) / `group` of them, and `group` is at least the number of
   words over MAX_GROUPS.
4. The windows that are left travel once for each anchor, as the passage that
   they cover, to the task of their prefix. It spells and sorts them and walks
   its subtrees depth first, holding only the path from the root. Leaves of a
   node come by id, so the first one names the smallest document and the others
   stream past it.
5. Each part learns which of its windows are repeats and removes the words.

A passage that a third of all documents share reaches steps 2 and 4 at most
once a part, so no key is hot.

Defined cases: null text has no words; a text under WINDOW words loses none;
texts of any length are searched whole; a null doc_id counts as larger than
every other; documents with equal ids take nothing from one another (so
repeated rows all keep their words unless a smaller id has them); an empty
table gives none. Only the id and text columns are read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


WINDOW = 13
ANCHOR = 5
PART_BYTES = 8 << 20
GROUP = 8_000_000  # places; fewer than one in five begins a passage
MAX_GROUPS = 65_536
CHUNK = 1 << 19
HELD = 1_000_000  # prefixes that a task counts before it hands them on
LAST = np.iinfo(np.int64).max  # stands for a null doc_id
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))  # fixed values of splitmix64
INVERSE = np.uint64(pow(int(MIX[1]), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function (splitmix64)."""
    x = x + MIX[0]
    x = (x ^ (x >> np.uint64(30))) * MIX[1]
    x = (x ^ (x >> np.uint64(27))) * MIX[2]
    return x ^ (x >> np.uint64(31))


def run_hash(values: np.ndarray, length: int) -> np.ndarray:
    """A number for each run of `length` consecutive values."""
    out = np.zeros(max(0, len(values) - length + 1), np.uint64)
    for j in range(length):
        out *= MIX[1]
        out += values[j:j + len(out)]
    return mix(out)


class Powers:
    """Powers of an odd number and of its inverse modulo 2^64."""

    def __init__(self):
        self.up = self.down = np.ones(0, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, CHUNK)
            self.up, self.down = (np.multiply.accumulate(np.r_[np.uint64(1), np.full(size, c, np.uint64)]) for c in (MIX[1], INVERSE))
        return self.up[:n], self.down[:n]


POWERS = Powers()


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each word of `data` begins and ends, and its 64-bit hash: the bytes as digits of a number modulo 2^64, cut
    out of the running sum of the whole. Each word is followed by one blank or newline."""
    b = np.frombuffer(data, np.uint8)
    up, down = POWERS(len(b) + 1)
    sums = np.r_[np.uint64(0), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:-1])]
    end = np.flatnonzero((b == 32) | (b == 10))
    begin = np.r_[0, end[:-1] + 1] if len(end) else end
    return begin, end, mix((sums[end] - sums[begin]) * down[begin])


class Part:
    """The documents of a part, by id and in an order that depends on them alone, as one line of words."""

    def __init__(self, table: pa.Table, window: int):
        given = table.column("doc_id").to_pylist()
        ids = [LAST if i is None else i for i in given]
        texts = [b"" if t is None else t for t in table.column("text").cast(pa.binary()).to_pylist()]
        order = sorted(range(len(ids)), key=lambda k: (ids[k], texts[k]))
        self.ids, self.given = np.array([ids[k] for k in order], np.int64), [given[k] for k in order]
        n_words, held, size, base, found, data = [], [], 0, 0, [], []
        for k in order:
            words = texts[k].split()  # bytes split at ASCII white space
            texts[k] = b""
            n_words.append(len(words))
            if words:
                held.append(b" ".join(words))
                size += len(held[-1]) + 1
            if size >= CHUNK or k == order[-1] and held:
                data.append(b"\n".join(held) + b"\n")
                begin, end, h = word_hashes(data[-1])
                found.append((begin + base, end + base, h))
                base, held, size = base + len(data[-1]), [], 0
        self.data, self.n_words = b"".join(data), np.array(n_words, np.int64)
        self.begin, self.end, self.hashes = (np.concatenate(x) for x in zip(*found)) if found else (
            np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
        self.first = np.cumsum(self.n_words) - self.n_words
        # The starts of all windows, and the document of each.
        per = np.maximum(0, self.n_words - window + 1)
        self.doc = np.repeat(np.arange(len(per)), per)
        self.starts = np.arange(len(self.doc)) - np.repeat(np.cumsum(per) - per, per) + self.first[self.doc]

    def anchors(self, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
        """The anchor of each window: the least hash of its runs of `anchor` words, and the place of the first such run."""
        if not len(self.starts):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        runs = run_hash(self.hashes, anchor)
        n = len(self.hashes) - window + 1
        least, offset = runs[:n].copy(), np.zeros(n, np.int64)
        for j in range(1, window - anchor + 1):
            less = runs[j:j + n] < least
            np.minimum(least, runs[j:j + n], out=least)
            offset[less] = j
        return least[self.starts], self.starts + offset[self.starts]

    def passages(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last of each run of neighbouring windows with one anchor, as numbers into `starts`."""
        if not len(places):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        cut = np.flatnonzero((np.diff(places) != 0) | (np.diff(self.doc) != 0)) + 1
        return np.r_[0, cut], np.r_[cut, len(places)] - 1

    def texts(self, first: np.ndarray, last: np.ndarray) -> list[bytes]:
        """The words from each of `first` to that of `last`, joined by one space."""
        data = self.data
        return [data[a:b] for a, b in zip(self.begin[first].tolist(), self.end[last].tolist())]


def anchors_of(window: int, anchor: int):
    """Each anchor of a part with the least and largest id of its documents."""
    def run(key, table):
        part = Part(table, window)
        hashes, places = part.anchors(window, anchor)
        first, _ = part.passages(places)
        a, ids = hashes[first], part.ids[part.doc[first]]
        order = np.argsort(a, kind="stable")  # ids rise with the place, so they rise within an anchor
        a, ids = a[order], ids[order]
        begin = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.zeros(0, np.int64)
        end = np.r_[begin[1:], len(a)].astype(np.int64) - 1 if len(a) else begin
        return pa.table({"part": pa.array(np.full(len(begin), key[0].as_py()), pa.int32()), "anchor": pa.array(a[begin].view(np.int64)),
                         "low": pa.array(ids[begin], pa.int64()), "high": pa.array(ids[end], pa.int64())})

    return run


def prefix_of(words: list[bytes], heavy: frozenset) -> bytes:
    """The shortest prefix that is not among the heavy ones."""
    for n in range(1, len(words)):
        p = b" ".join(words[:n])
        if p not in heavy:
            return p
    return b" ".join(words)


PASSAGES = "part int, at bigint, passage binary, offset int, tree bigint, low bigint, high bigint"


def passages_of(window: int, anchor: int, heavy):
    """Each different passage of a part whose windows may be repeats: its place, text, where its anchor begins (in words),
    the hash of its prefix, least and largest id."""
    def run(key, table, marks):
        known, part = heavy.value, Part(table, window)
        wanted = marks.column("anchor").to_numpy().view(np.uint64) if marks.num_rows else np.zeros(0, np.uint64)
        hashes, places = part.anchors(window, anchor)
        first, last = part.passages(places)
        keep = np.isin(hashes[first], wanted)
        first, last = first[keep], last[keep]
        starts, found = part.starts[first], {}
        for at, text, offset, i in zip(starts.tolist(), part.texts(starts, part.starts[last] + window - 1), (places[first] - starts).tolist(),
                                       part.ids[part.doc[first]].tolist()):
            row = found.get((text, offset))
            if row is None:
                found[text, offset] = [at, i, i]
            else:
                row[2] = i
        rows, number = [], key[0].as_py()
        for (text, offset), (at, low, high) in found.items():
            words = text.split(b" ", offset + anchor)
            prefix = words[offset] if words[offset] not in known else prefix_of(words[offset:offset + anchor], known)
            rows.append((number, at, text, offset, xxhash.xxh3_64_intdigest(prefix) - (1 << 63), low, high))
        types = (pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 7, types)], names=[x.split()[0] for x in PASSAGES.split(", ")])

    return run


SUFFIXES = "suffix binary, part int, at bigint, low bigint, high bigint"


def spelled(window: int):
    """The windows of each passage, spelled from their anchor on."""
    def run(batches):
        for whole in batches:
            for k in range(0, whole.num_rows, 2000):
                batch = whole.slice(k, 2000)
                out, times, ats = [], [], []
                for at, text, offset in zip(*(batch.column(c).to_pylist() for c in ("at", "passage", "offset"))):
                    begins = [0]
                    for w in text.split(b" "):
                        begins.append(begins[-1] + len(w) + 1)
                    n, anchor = len(begins) - window, begins[offset]
                    times.append(n)
                    for i in range(n):
                        out.append(b"%b %b%d" % (text[anchor:begins[i + window] - 1], text[begins[i]:anchor], offset - i))
                    ats += range(at, at + n)
                again = [np.repeat(batch.column(c).to_numpy(), times) for c in ("part", "low", "high")]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(again[0]), pa.array(ats, pa.int64()), pa.array(again[1]), pa.array(again[2])],
                                                 names=[x.split()[0] for x in SUFFIXES.split(", ")])

    return run


def deep_nodes():
    """Walks the subtrees of a task from leaf to leaf. Leaves come in order, so a node at full depth is a run of leaves
    that agree in every word, and its first leaf has the least id; shallower nodes are passed without being built. Of
    each deep node: its leaves whose largest id exceeds the least."""
    def run(batches):
        before, least = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            suffix, low = batch.column("suffix"), batch.column("low").to_numpy()
            opens = np.r_[suffix[0].as_py() != before, pc.not_equal(suffix[1:], suffix[:-1]).to_numpy(zero_copy_only=False)]
            node = np.cumsum(opens)  # 0: the node that was open
            of = np.r_[LAST if least is None else least, low[opens]][node]
            hit = batch.column("high").to_numpy() > of
            before, least = suffix[-1].as_py(), int(of[-1])
            yield pa.RecordBatch.from_arrays([batch.column("part").filter(pa.array(hit)), batch.column("at").filter(pa.array(hit)), pa.array(of[hit])],
                                             names=["part", "at", "low"])

    return run


def removal(window: int):
    """Removes words of the repeats: (doc_id, n_words, kept text, spans of removed words)."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(key, table, repeats):
        part = Part(table, window)
        gone = np.zeros(len(part.hashes) + 1, np.int64)
        if repeats.num_rows:
            places, least = repeats.column("at").to_numpy(), repeats.column("low").to_numpy()
            h = run_hash(part.hashes, window)
            # Hashes only choose what to compare. `known` has the words of each repeat with its least id.
            known = dict(zip(part.texts(places, places + window - 1), least.tolist()))
            low_bits = np.zeros(1 << 22, bool)
            low_bits[h[places] & np.uint64(len(low_bits) - 1)] = True
            maybe = np.flatnonzero(low_bits[h[part.starts] & np.uint64(len(low_bits) - 1)])
            starts = part.starts[maybe]
            of = np.fromiter((known.get(t, LAST) for t in part.texts(starts, starts + window - 1)), np.int64, len(starts))
            hit = starts[of < part.ids[part.doc[maybe]]]
            gone[hit] += 1  # starts are distinct
            gone[hit + window] -= 1
        covered = np.cumsum(gone[:-1]) > 0
        some = np.r_[0, np.cumsum(covered)]
        texts, spans, begin, end = [], [], part.begin, part.end
        for first, n in zip(part.first.tolist(), part.n_words.tolist()):
            if some[first + n] == some[first]:
                texts.append(part.data[begin[first]:end[first + n - 1]] if n else b"")
                spans.append([])
                continue
            edge = [first, *(np.flatnonzero(np.diff(np.r_[False, covered[first:first + n], False].astype(np.int8))) + first).tolist(), first + n]
            spans.append([{"start": a - first, "end": b - first} for a, b in zip(edge[1:-1:2], edge[2:-1:2])])
            texts.append(b" ".join([part.data[begin[a]:end[b - 1]] for a, b in zip(edge[::2], edge[1::2]) if a < b]))
        return pa.table({"doc_id": pa.array(part.given, pa.int64()), "n_words": pa.array(part.n_words, pa.int64()),
                         "kept": pa.array(texts, pa.binary()).cast(pa.string()), "removed": pa.array(spans, span)})

    return run


def heavy_prefixes(docs: DataFrame, group: int, longest: int, n_words: int) -> frozenset:
    """The prefixes (words joined by a space) of fewer than `longest` words that start more than `group` runs of that
    length, level by level over whole texts of at most `n_words` words in all.

    A task hands on what makes up at least half the share group / n_words of the words that it has counted. A count is
    short by at most group / 2 then, so prefixes that come to over group / 2 are taken: all those over `group`, none
    under half of it, 2 n_words / group a level at most."""
    heavy: set[bytes] = set()
    for depth in range(1, longest):
        above = docs.sparkSession.sparkContext.broadcast(frozenset(p for p in heavy if p.count(b" ") == depth - 2))
        if depth > 1 and not above.value:
            break

        def run(batches, depth=depth, above=above):
            known, count, seen = above.value, Counter(), 0

            def flush():
                kept = {p: k for p, k in count.items() if 2 * n_words * k >= seen * group}
                return pa.RecordBatch.from_arrays([pa.array(kept.keys(), pa.binary()), pa.array(kept.values(), pa.int64())], names=["prefix", "n"])

            for batch in batches:
                for text in batch.column("text").cast(pa.binary()):
                    words = text.as_py().split()
                    starts = max(0, len(words) - longest + 1)
                    seen += starts
                    if depth == 1:
                        count.update(words[:starts])
                    else:
                        count.update(b" ".join(words[i:i + depth]) for i in range(starts) if b" ".join(words[i:i + depth - 1]) in known)
                    if len(count) > HELD:
                        yield flush()
                        count, seen = Counter(), 0
            yield flush()

        found = docs.filter(F.col("text").isNotNull()).select("text").mapInArrow(run, "prefix binary, n bigint") \
            .groupBy("prefix").agg(F.sum("n").alias("n")).filter(F.col("n") > group // 2)
        heavy |= {bytes(r.prefix) for r in found.select("prefix").toLocalIterator()}
    return frozenset(heavy)


def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int = ANCHOR,
                   part_bytes: int = PART_BYTES, group: int = GROUP) -> DataFrame:
    """(doc_id, n_words, kept, removed) of every row: the words left, joined by one space, and the spans of word numbers
    that went."""
    spark = df.sparkSession
    docs = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(2 * n, -(-size // part_bytes))
    heavy = spark.sparkContext.broadcast(heavy_prefixes(docs, max(group, size // 2 // MAX_GROUPS), anchor, size // 2 + 1))
    dealt = docs.withColumn("part", F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).cast("int"))

    seen = dealt.groupBy("part").applyInArrow(anchors_of(window, anchor), "part int, anchor bigint, low bigint, high bigint")
    same = W.partitionBy("anchor")
    marks = seen.withColumn("least", F.min("low").over(same)).withColumn("most", F.max("high").over(same)) \
        .filter(F.col("least") < F.col("most")).select("part", "anchor")
    passages = dealt.groupBy("part").cogroup(marks.groupBy("part")).applyInArrow(passages_of(window, anchor, heavy), PASSAGES)
    walked = passages.repartition(n, "tree").mapInArrow(spelled(window), SUFFIXES).sortWithinPartitions("suffix", "low") \
        .mapInArrow(deep_nodes(), "part int, at bigint, low bigint")
    return dealt.groupBy("part").cogroup(walked.groupBy("part")).applyInArrow(
        removal(window), "doc_id bigint, n_words bigint, kept string, removed array<struct<start:bigint,end:bigint>>")
