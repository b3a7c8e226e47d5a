"""Prefix trie of conversations by fixed-length block hashing.

A conversation is a sequence of turns; each distinct sequence of first turns
is a node. Conversations are cut into blocks of BLOCK turns. A block's digest
goes on from that of the block before it, so equal digests mean equal turns
from the first one on.

1. Each conversation streams once past a running digest and yields a row a
   block: digests before, after each turn and at the end, and turn sizes.
2. Blocks are grouped by (digest before, digest at the end): equal blocks
   become one edge of the trie, combined map-side. This is where a group of
   copies, or a first block that a third of all conversations share, melts to
   a row.
3. Where a digest is followed by one edge only, nobody diverges inside that
   block and its turns are nodes as they are. Only where siblings diverge are
   edges opened turn by turn and grouped by the digest after each turn.
4. Sums over subtrees need no walk. A node is owned by its smallest member, and
   what a member owns is the end of its path; so the nodes below a node are
   what its members own, but for the owner's turns up to it. Leaves and sizes
   become sums over the rows of step 1, combined map-side by edge.
5. Ids of conversations that end in a node are joined in order by range
   partitions, in pieces, and the pieces stream through one hash.

Work is in proportion to the turns, whatever the depth. One conversation's
turns stream through one task (its digest is a chain), in constant memory.

Defined cases: turns are ordered by `turn`, null first, equal ones by the digest
of role and text; null role or text is empty; a null conv_id names no
conversation and its rows are left out; a conversation without turns after
rebuilding is a member of the root; repeated rows are turns of their own; an
empty table has no node. Only the four named columns are read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from panelspark.llm.common import materialise

BLOCK = 4
FAMILY, SHARED = 100, 6  # conversations of a family share up to SHARED - 1 first turns
PIECE_IDS = 4096
ROOT = b"\0" * 16
TURNS = "conv_id bigint, pos bigint, digest binary, chars bigint"
BLOCKS = "conv_id bigint, block bigint, before binary, digests array<binary>, sizes array<bigint>, above bigint, last boolean"


def turn_digest(role: Column, text: Column) -> Column:
    """128 bits of a turn; the role's length parts it from the text."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))


def ordered_turns(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, pos from 1, digest, chars) of every turn: texts stay behind."""
    rows = df.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("bigint").alias("conv_id"), F.col(turn).alias("turn"), turn_digest(F.col(role), F.col(text)).alias("digest"),
        F.length(F.coalesce(F.col(text), F.lit(""))).cast("bigint").alias("chars"))
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return rows.select("conv_id", F.row_number().over(order).cast("bigint").alias("pos"), "digest", "chars")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of the family's first conversation: (their turns, their ids).

    h = unsigned crc32 of the decimal id modulo SHARED: the first h turns of conversation c - c % FAMILY (all if fewer,
    none if absent), then c's own after its first h."""
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    convs = convs.select("conv_id", base.alias("base"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED).alias("h"))
    heads = turns.filter((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < SHARED)).select(
        F.col("conv_id").alias("base"), "pos", "digest", "chars")
    heads = heads.groupBy("base").agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "chars"))).alias("head"))  # fewer than SHARED
    convs = convs.join(heads, "base", "left").select("conv_id", "h", F.slice(
        F.coalesce("head", F.array().cast("array<struct<pos:bigint,digest:binary,chars:bigint>>")), 1, F.col("h").cast("int")).alias("head"))
    convs = convs.withColumn("taken", F.size("head").cast("bigint"))
    first = convs.select("conv_id", F.inline("head"))
    own = turns.join(convs.select("conv_id", "h", "taken"), "conv_id").filter(F.col("pos") > F.col("h")).select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "digest", "chars")
    return first.select("conv_id", "pos", "digest", "chars").unionAll(own), convs.select("conv_id")


def blocks_of(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row a block of each conversation; `above` is the number of code points before it."""
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = turns.repartition(n, "conv_id").sortWithinPartitions("conv_id", "pos")
    names = [x.split()[0] for x in BLOCKS.split(", ")]
    types = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.int64(), pa.bool_())

    def run(batches):
        conv = before = now = None
        number, above, digests, sizes, out = 0, 0, [], [], []
        for batch in batches:
            for c, digest, chars in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "digest", "chars"))):
                if c != conv or len(digests) == block:
                    if conv is not None:
                        out.append((conv, number, before, digests, sizes, above, c != conv))
                    number, above = (0, 0) if c != conv else (number + 1, above + sum(sizes))
                    conv, before, digests, sizes = c, ROOT if c != conv else now, [], []
                    now = before
                now = hashlib.md5(now + digest).digest()
                digests.append(now)
                sizes.append(chars)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], names=names)
                out = []
        if conv is not None:
            out.append((conv, number, before, digests, sizes, above, True))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], names=names)

    return rows.mapInArrow(run, BLOCKS)


def opened(edges: DataFrame, *more: str) -> DataFrame:
    """A row a turn of each edge: node, the one above it, depth, its size and the code points above it."""
    turns = edges.withColumn("from", F.concat(F.array("before"), F.slice("digests", 1, F.size("digests") - 1))) \
        .withColumn("upto", F.transform("sizes", lambda _, i: F.aggregate(F.slice("sizes", 1, i), F.col("above"), lambda a, x: a + x)))
    return turns.select(*more, F.posexplode(F.arrays_zip("digests", "from", "sizes", "upto")).alias("i", "t"), "first_depth").select(
        *more, F.col("t.digests").alias("node"), F.col("t.from").alias("parent"), (F.col("first_depth") + F.col("i")).alias("depth"),
        F.col("t.sizes").alias("size"), F.col("t.upto").alias("above"))


def id_pieces_hash(ends: DataFrame) -> DataFrame:
    """ends: (node, conv_id). SHA-256 of the ascending decimal ids, joined by commas, of each node."""
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = ends.repartitionByRange(n, "node", "conv_id").sortWithinPartitions("node", "conv_id")

    def join(batches):
        node, ids, out = None, [], []
        for batch in batches:
            for key, conv in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
                if key != node or len(ids) == PIECE_IDS:
                    if ids:
                        out.append((node, ids[0], ",".join(map(str, ids))))
                    node, ids = key, []
                ids.append(conv)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=["node", "first", "ids"])
                out = []
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip((node, ids[0], ",".join(map(str, ids))))], names=["node", "first", "ids"])

    def digest(batches):
        node, h, out = None, None, []
        for batch in batches:
            for key, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
                if key != node:
                    if h:
                        out.append((node, h.hexdigest()))
                    node, h = key, hashlib.sha256()
                else:
                    h.update(b",")
                h.update(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=["node", "ends_sha256"])
                out = []
        if h:
            yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([h.hexdigest()])], names=["node", "ends_sha256"])

    pieces = rows.mapInArrow(join, "node binary, first bigint, ids string")
    return pieces.repartition(n, "node").sortWithinPartitions("node", "first").mapInArrow(digest, "node binary, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The nodes of conversations given as (conv_id, pos, digest, chars) and all their ids."""
    blocks = materialise(blocks_of(turns, block))
    end = F.element_at("digests", -1)
    keys = ["before", "end"]
    same = [F.first(c).alias(c) for c in ("block", "digests", "sizes", "above")]  # equal in all rows of an edge

    edges = blocks.withColumn("end", end).groupBy(*keys).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"), *same)
    edges = edges.withColumn("first_depth", F.col("block") * block + 1)
    siblings = edges.groupBy("before").agg(F.count("*").alias("n_edges")).filter(F.col("n_edges") > 1).select("before", F.lit(True).alias("diverge"))
    edges = materialise(edges.join(siblings, "before", "left"))
    alone = opened(edges.filter(F.col("diverge").isNull()), "conv_id", "n")
    split = opened(edges.filter(F.col("diverge")), "conv_id", "n").groupBy("node", "parent", "depth", "size", "above").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n").alias("n"))
    nodes = materialise(alone.unionByName(split))

    kids = nodes.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = materialise(nodes.join(kids, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    owned = nodes.groupBy("conv_id").agg(F.sum("size").alias("owned"), F.sum((F.col("n_children") == 0).cast("bigint")).alias("leaves"))
    total = blocks.filter("last").select("conv_id", (F.col("above") + F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("total"))
    stats = materialise(total.join(owned, "conv_id", "left").select(
        "conv_id", "total", F.coalesce("owned", F.lit(0)).alias("owned"), F.coalesce("leaves", F.lit(0)).alias("leaves")))

    sums = [F.sum(c).alias(c) for c in ("total", "owned", "leaves")]
    by_edge = blocks.withColumn("end", end).join(stats, "conv_id").groupBy(*keys).agg(*sums, *same)
    by_edge = by_edge.withColumn("first_depth", F.col("block") * block + 1)
    below = opened(by_edge, "total", "owned", "leaves").groupBy("node").agg(*sums)

    owner = stats.select("conv_id", F.col("total").alias("own_total"), F.col("owned").alias("own_owned"))
    full = nodes.join(below, "node").join(owner, "conv_id")
    # Members' code points from this node on, less those of the distinct nodes among them.
    saved = F.col("total") - F.col("n") * F.col("above") - (F.col("owned") - F.col("own_owned") + F.col("own_total") - F.col("above"))
    full = full.select("node", "parent", "conv_id", "depth", "n", "n_children", F.col("leaves").alias("n_leaves"), saved.alias("saved_tokens"))
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n")).filter("n > 0")
    whole = stats.agg(F.sum("total").alias("t"), F.sum("owned").alias("o"), F.sum("leaves").alias("l"))
    first = nodes.filter("depth = 1").agg(F.count("*").alias("kids"))
    root = root.select(F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"), "conv_id", F.lit(0).cast("bigint").alias("depth"), "n",
                       first.scalar().alias("n_children"), F.greatest(F.lit(1), F.coalesce(whole.select("l").scalar(), F.lit(0))).alias("n_leaves"),
                       F.coalesce(whole.select(F.col("t") - F.col("o")).scalar(), F.lit(0)).alias("saved_tokens"))
    full = full.unionByName(root)

    ends = blocks.filter("last").select("conv_id", end.alias("node"))
    ends = ends.unionByName(convs.join(ends, "conv_id", "left_anti").select("conv_id", F.lit(ROOT).alias("node")))
    above = full.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    empty = hashlib.sha256(b"").hexdigest()
    return full.join(above, "parent", "left").join(id_pieces_hash(ends), "node", "left").select(
        "conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"))


def family_trie(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block: int = BLOCK) -> DataFrame:
    """The trie of the rebuilt conversations of a table of turns."""
    turns, convs = rebuilt(materialise(ordered_turns(df, conv_id, turn, role, text)))
    return trie(turns, materialise(convs), block)
