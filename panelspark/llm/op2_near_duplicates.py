"""Near-duplicate classes by DartMinHash.

Every word shingle owns a strip of the plane, as wide as its weight; hashed
darts fall on the plane, the same for every text, and a dart counts for a text
if it falls within the strip's width. Of the darts of each coordinate the
earliest is kept: the share of equal coordinates estimates weighted Jaccard
similarity, at a cost of about k log k darts a text whatever its length.

1. Texts with equal words are one node (a digest), with its signature.
2. Signatures are cut into bands. Nodes that share a band meet in blocks of
   bounded size within a task, which compares signatures and emits a spanning
   forest of the pairs whose estimate is above a floor that lies several
   standard deviations below the wanted similarity. Components of those
   forests are groups; no pair of a wanted similarity crosses two groups.
3. Within a group, blocks compare shingles exactly and emit a spanning forest
   of the true links. Components of these are the classes.

A large bucket or group is dealt to all pairs of its blocks, so none is capped
and none is gathered in one task; a task emits fewer links than it has nodes.
What stays quadratic is the comparison of *different* texts that really are
alike, spread over the block pairs.

Similarity is the Jaccard similarity of the multisets of shingles (weight:
number of occurrences), or with `weighted=False` of the sets (each weight 1).

Defined cases: a null text has no likeness and is a class of its own id; texts
without words are equal to each other; a text under five words is one shingle;
texts of any length are compared whole; a class is named by its smallest
doc_id; repeated rows fall into one class; an empty table gives none. Only the
id and text columns, and those named in `also`, are read by the operator.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.llm.common import free_name, materialise

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 5
K = BANDS * ROWS
FLOOR = 0.62  # over five standard deviations of the estimate below THRESHOLD
BLOCK = 512
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
POISSON = np.cumsum([np.exp(-1.0) / f for f in (1, 1, 2, 6, 24, 120, 720, 5040, 40320, 362880, 3628800)])


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function (splitmix64)."""
    x = x + MIX[0]
    x ^= x >> np.uint64(30)
    x *= MIX[1]
    x ^= x >> np.uint64(27)
    x *= MIX[2]
    x ^= x >> np.uint64(31)
    return x


def unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)) * 2.0 ** -53


#: A number x is at least LEAST[j] if unit(x) is at least POISSON[j]: then its cell holds more than j darts.
LEAST = np.array([int(np.ceil(p * 2.0 ** 53)) << 11 for p in POISSON if p < 1], np.uint64)
#: Signatures and the exact comparison number words apart, so that words which one of them takes for equal the other tells apart.
WORDS, EXACT = 1, 2
LONG = 64
FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # the first n of eight bytes
PLACE = mix(np.arange(SHINGLE, dtype=np.uint64)) | np.uint64(1)  # an odd factor for each place in a shingle


def normal(text: str) -> bytes:
    """Lower-case words, parted by single blanks."""
    return " ".join(text.lower().split()).encode()


def word_numbers(words: bytes, seed: int) -> np.ndarray:
    """A number for each word of a normal text that has some: its length and its bytes are mixed, eight at a time."""
    ends = np.append(np.flatnonzero(np.frombuffer(words, np.uint8) == 32), len(words))
    at = np.concatenate([[0], ends[:-1] + 1])
    left = ends - at
    out = mix(left.astype(np.uint64) + np.uint64(seed << 32))
    eight = np.ndarray(len(words) + 1, "<u8", words + bytes(8), strides=(1,))  # those from each byte on
    for i in np.flatnonzero(left > LONG).tolist():
        out[i] = xxhash.xxh3_64_intdigest(words[at[i]:ends[i]], seed)
    more = np.flatnonzero(left <= LONG)
    while len(more):
        out[more] = mix(out[more] ^ (eight[at[more]] & FIRST[np.minimum(left[more], 8)]))
        more = more[left[more] > 8]
        at[more] += 8
        left[more] -= 8
    return out


def shingles(texts: list[bytes], seed: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """A number for each run of five words of each normal text, in order, one for a shorter text; and how many each has."""
    n = np.array([t.count(b" ") + 1 if t else 0 for t in texts], np.int64)
    h = word_numbers(b" ".join([t for t in texts if t]), seed) if n.any() else np.zeros(0, np.uint64)
    h = np.concatenate([h, np.zeros(SHINGLE, np.uint64)])
    runs = sum(h[j:len(h) - SHINGLE + 1 + j] * PLACE[j] for j in range(SHINGLE))
    sizes, first = np.maximum(1, n - SHINGLE + 1), np.cumsum(n) - n
    begin = np.cumsum(sizes) - sizes
    out = runs[np.arange(sizes.sum()) + np.repeat(first - begin, sizes)]
    short = np.flatnonzero(n < SHINGLE)
    out[begin[short]] = sum(np.where(j < n[short], h[first[short] + j], np.uint64(0)) * PLACE[j] for j in range(SHINGLE))
    return mix(out), sizes


def weighted_sets(texts: list[bytes], weighted: bool, seed: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The shingles of each normal text once, in order, their weights, and how many each text has."""
    items, sizes = shingles(texts, seed)
    ends = np.cumsum(sizes)
    for a, b in zip((ends - sizes).tolist(), ends.tolist()):
        items[a:b].sort()
    new = np.ones(len(items), bool)
    new[1:] = items[1:] != items[:-1]
    new[ends[:-1]] = True
    at = np.flatnonzero(new)
    counts = np.diff(at, append=len(items)) if weighted else np.ones(len(at))
    return items[at], counts.astype(float), np.add.reduceat(new, ends - sizes, dtype=np.int64)


def darts(items: np.ndarray, weights: np.ndarray, limit: np.ndarray):
    """Darts on the strips of the items with time below each item's limit: (item number, time, dart hash).

    Weights are cut into regions [0,1), [1,2), [2,4) ...; a region of width v is cut in time into cells of length 1/v,
    so every cell has area 1 and Poisson(1) darts, whose number and places are hashes of item, region and cell."""
    found = []
    low, width = 0.0, 1.0
    while True:
        has = np.flatnonzero(weights > low)
        if not len(has):
            break
        ends = limit[has] * width
        cells = np.maximum(1, np.ceil(ends)).astype(np.int64)
        cell = np.arange(cells.sum(), dtype=np.int32) - np.repeat((np.cumsum(cells) - cells).astype(np.int32), cells)
        number = mix(np.arange(cells.max(), dtype=np.uint64) * np.uint64(64) + np.uint64(int(width).bit_length()))
        seed = mix(np.repeat(items[has], cells) ^ number[cell])
        more, at = np.flatnonzero(seed >= LEAST[0]), []
        while len(more):
            at.append(more)
            more = more[seed[more] >= LEAST[len(at)]] if len(at) < len(LEAST) else more[:0]
        nth = np.repeat(np.arange(1, len(at) + 1, dtype=np.uint64), [len(x) for x in at])
        at = np.concatenate(at) if at else more
        item, h = np.repeat(has, cells)[at], mix(seed[at] + nth)
        time = (cell[at] + unit(mix(h))) / width
        ok = None
        if (ends < cells).any():
            ok = time < limit[item]
        if (weights[has] < low + width).any():  # elsewhere the strips cover the region
            inside = low + width * unit(mix(h ^ MIX[1])) < weights[item]
            ok = inside if ok is None else ok & inside
        found.append((item, time, h) if ok is None else (item[ok], time[ok], h[ok]))
        low, width = (1.0, 1.0) if low == 0 else (low * 2, width * 2)
    return found[0] if len(found) == 1 else [np.concatenate(x) for x in zip(*found)]


def signed(items: np.ndarray, weights: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A row for each set, given one after another: for each coordinate 16 bits of the earliest dart. Times run until
    every coordinate is hit. Which dart is the earliest does not depend on the limit: but for very long texts it is
    rounded up to whole cells, all of whose darts count."""
    n = len(sizes)
    best = np.full((n, K), np.iinfo(np.uint64).max, np.uint64)
    limit = K * (np.log(K) + 3) / np.add.reduceat(weights, np.cumsum(sizes) - sizes)
    limit = np.where(limit > 0.1, np.ceil(limit), limit)
    owner = np.repeat(np.arange(n), sizes)
    while len(items):
        item, time, h = darts(items, weights, limit[owner])
        # 47 bits of the time as a share of the limit would depend on the limit; a float's own bits do not.
        key = (time.view(np.uint64) & ~np.uint64(0xFFFF)) | (h >> np.uint64(48))
        low = h.astype(np.uint32)
        np.minimum.at(best.reshape(-1), owner[item] * K + (low - low // np.uint32(K) * np.uint32(K)), key)
        missed = (best == np.iinfo(np.uint64).max).any(1)
        again = missed[owner]
        items, weights, owner = items[again], weights[again], owner[again]
        limit *= 2
    return (best & np.uint64(0xFFFF)).astype(np.uint16)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The rows of sets given as items and weights."""
    return signed(np.concatenate([i for i, _ in sets]), np.concatenate([w for _, w in sets]), np.array([len(i) for i, _ in sets]))


def band(signature: Column, number: Column) -> Column:
    """A number for a band of a signature; equal bands in equal places get equal numbers."""
    return F.xxhash64(number, F.substring(signature, number * (2 * ROWS) + 1, F.lit(2 * ROWS)))


def node_key(text: str) -> bytes:
    return hashlib.md5(normal(text)).digest()


SLICE_CELLS = 40_000


def sign(docs: DataFrame, weighted: bool, also: tuple, measures: dict) -> DataFrame:
    """(doc_id, row_key, node, signature, also..., measures...) of every row with a text."""
    carried = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in docs.select(*also).schema)
    schema = "doc_id bigint, row_key bigint, node binary, signature binary" + carried \
        + "".join(f", `{m}` bigint" for m in measures)
    names = ["doc_id", "row_key", "node", "signature", *also, *measures]

    def run(batches):
        for batch in batches:
            column, at = batch.column("text"), 0
            while at < batch.num_rows:  # slices by length bound what the darts hold, and keep it near the processor
                texts, words, first, n = [], [], at, 0
                while at < batch.num_rows and n < SLICE_CELLS:
                    texts.append(column[at].as_py())
                    words.append(normal(texts[-1]))
                    n += max(8 * K, len(words[-1]) // 6)
                    at += 1
                s = signed(*weighted_sets(words, weighted))
                part = batch.slice(first, at - first)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("row_key"), pa.array([hashlib.md5(w).digest() for w in words], pa.binary()),
                    pa.array([r.tobytes() for r in s], pa.binary()), *(part.column(c) for c in also),
                    *(pa.array(f(texts), pa.int64()) for f in measures.values())], names=names)

    return docs.mapInArrow(run, schema)


class Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def forest(likeness: np.ndarray, floor: float) -> list[tuple[int, int]]:
    """A spanning forest of the pairs i < j with likeness of at least `floor`."""
    i, j = np.nonzero(np.triu(likeness >= floor, 1))
    trees = Forest(len(likeness))
    return [(a, b) for a, b in zip(i.tolist(), j.tolist()) if trees.join(a, b)]


def alike_signatures(values: list[bytes]) -> np.ndarray:
    s = np.frombuffer(b"".join(values), np.uint16).reshape(len(values), -1)
    if len(s) < 32:
        return (s[:, None] == s).mean(2)
    return np.stack([(s == row).mean(1) for row in s])


def alike_texts(texts: list[str], weighted: bool) -> np.ndarray:
    """Exact (weighted) Jaccard similarity of all pairs, by products over bounded groups of shingle columns. The
    multiset case numbers the occurrences of a shingle, so that it is a set case, too."""
    items, weights, sizes = weighted_sets([normal(t) for t in texts], weighted, EXACT)
    n = weights.astype(np.int64)
    if weighted:
        items = mix(np.repeat(items, n) ^ (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)).astype(np.uint64))
    size = np.add.reduceat(weights, np.cumsum(sizes) - sizes)
    owner = np.repeat(np.arange(len(size)), size.astype(int))
    columns, place = np.unique(items, return_inverse=True)
    shared = np.bincount(place, minlength=len(columns)) > 1
    number = np.cumsum(shared) - 1
    owner, place = owner[shared[place]], number[place[shared[place]]]
    by = np.argsort(place, kind="stable")
    owner, place = owner[by], place[by]
    both, wide = np.zeros((len(size), len(size))), 4096
    for a in range(0, int(shared.sum()), wide):
        x, y = np.searchsorted(place, (a, a + wide))
        m = np.zeros((len(size), wide), np.float32)
        m[owner[x:y], place[x:y] - a] = 1
        both += m @ m.T
    return both / (size[:, None] + size[None, :] - both)


def compare_blocks(rows: DataFrame, group: str, value: str, links) -> DataFrame:
    """rows: (group, n, node, value), n being the nodes of the group. Deals each group to the pairs of its blocks of BLOCK
    nodes and runs `links(values) -> [(i, j)]` on each pair of blocks; returns the links (a, b) between nodes."""
    rows = rows.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")) \
        .withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = rows.select(group, "node", value, "blocks", "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")) \
        .withColumn("unit", F.xxhash64(group, F.least("mine", "other"), F.greatest("mine", "other"))) \
        .select("unit", "node", value)
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(n, "unit").sortWithinPartitions("unit", "node")

    def run(batches):
        unit_now, nodes, values = None, [], []

        def flush():
            if len(nodes) < 2:
                return None
            found = links(values)
            return pa.RecordBatch.from_arrays([pa.array([nodes[i] for i, _ in found], pa.binary()),
                                               pa.array([nodes[j] for _, j in found], pa.binary())], names=["a", "b"]) if found else None

        for batch in batches:
            for u, node, v in zip(batch.column("unit").to_pylist(), batch.column("node").to_pylist(), batch.column(value).to_pylist()):
                if u != unit_now:
                    if (out := flush()) is not None:
                        yield out
                    unit_now, nodes, values = u, [], []
                if not nodes or nodes[-1] != node:
                    nodes.append(node)
                    values.append(v)
        if (out := flush()) is not None:
            yield out

    return dealt.mapInArrow(run, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of the links, root being the smallest of its component. Alternates large-star and
    small-star steps, in which links move to the smallest neighbour; each round is written to the checkpoint folder."""
    edges = materialise(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct())
    state = None
    while True:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(low.select("u", F.col("m").alias("v")))
        edges = materialise(small.filter("u != v").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def row_key(doc_id: Column, text: Column) -> Column:
    """Names a row by its id and text: also null and repeated ids name the right text. Equal rows share a key."""
    return F.xxhash64(doc_id, text)


def classified(df: DataFrame, doc_id: str, text: str, threshold: float, weighted: bool, also: tuple = (), measures: dict | None = None) -> DataFrame:
    """(doc_id, row_key, node, root, also..., measures...) of every row with a text; rows of one class have one root."""
    more = [*also, *(measures or {})]
    docs = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), *also)
    with_text = docs.filter(F.col("text").isNotNull()).withColumn("row_key", row_key(F.col("doc_id"), F.col("text")))
    rows = materialise(sign(with_text, weighted, also, measures or {}))
    nodes = rows.groupBy("node").agg(F.min("row_key").alias("row_key"), F.first("signature").alias("signature"))
    banded = nodes.select("node", "signature", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("number")) \
        .select("node", band(F.col("signature"), F.col("number")).alias("band"))
    met = banded.join(banded.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1"), "band")
    met = met.join(nodes.select("node", "signature"), "node")
    floor = FLOOR * threshold / THRESHOLD
    near = compare_blocks(met, "band", "signature", lambda v: forest(alike_signatures(v), floor))
    groups = materialise(components(near).withColumnRenamed("root", "grp"))
    # Only grouped texts travel: the key of one row of each node names a text of it.
    wanted = groups.join(groups.groupBy("grp").agg(F.count("*").alias("n")), "grp").join(nodes.select("node", "row_key"), "node")
    texts = with_text.select("row_key", "text").join(wanted, "row_key")
    texts = texts.groupBy("grp", "n", "node").agg(F.min(F.when(node_of(F.col("text")) == F.col("node"), F.col("text"))).alias("text"))
    links = compare_blocks(texts.filter(F.col("text").isNotNull()), "grp", "text", lambda v: forest(alike_texts(v, weighted), threshold))
    return rows.select("doc_id", "row_key", "node", *more).join(components(links), "node", "left") \
        .select("doc_id", "row_key", "node", F.coalesce("root", "node").alias("root"), *more)


def classes(df: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, weighted: bool = True,
            also: tuple = (), measures: dict | None = None) -> DataFrame:
    """(doc_id, node, class_id, also..., measures...) of every row. `also` names further columns of the row; `measures`
    names functions from a list of texts to a whole number for each, which are called as the texts are signed (null for
    a null text). Their names must differ from those above, `row_key` and `root`."""
    rows = classified(df, doc_id, text, threshold, weighted, also, measures)
    more = [*also, *(measures or {})]
    names = rows.groupBy("node", "root").agg(F.min("doc_id").alias("first"))
    names = names.join(names.groupBy("root").agg(F.min("first").alias("class_id")), "root").select("node", "class_id")
    out = rows.select("doc_id", "node", *more).join(names, "node").select("doc_id", "node", "class_id", *more)
    own = F.col(doc_id).cast("bigint")
    alone = df.filter(F.col(text).isNull()).select(own.alias("doc_id"), F.lit(None).cast("binary").alias("node"), own.alias("class_id"), *also,
                                                   *(F.lit(None).cast("bigint").alias(m) for m in measures or {}))
    return out.unionAll(alone)


@F.pandas_udf(T.BinaryType())
def node_of(texts):
    return texts.map(node_key, na_action="ignore")


def keep_one(df: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, weighted: bool = True) -> DataFrame:
    """The rows with one row of each class left, that with the smallest doc_id (null last); same columns. Of several
    such rows with different texts that with the smallest key stays, of equal rows one. Rows with null text stay."""
    key, number = free_name(df, "near_key"), free_name(df, "near_times")
    rows = classified(df, doc_id, text, threshold, weighted)
    times = rows.groupBy("root", "doc_id", "row_key").agg(F.count("*").alias("n"))
    best = times.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "row_key", "n")).alias("best"))
    best = best.select(F.col("best.row_key").alias(key), F.col("best.n").alias(number))
    keyed = df.filter(F.col(text).isNotNull()).withColumn(key, row_key(F.col(doc_id).cast("bigint"), F.col(text)))
    kept = keyed.join(best, key)
    once = kept.filter(F.col(number) == 1).select(*df.columns)
    more = kept.filter(F.col(number) > 1).dropDuplicates([key]).select(*df.columns)
    return once.unionByName(more).unionByName(df.filter(F.col(text).isNull()))
