"""Order MinHash fingerprints of documents (DataFrame functions only).

Every run of five words is a k-mer (a shorter text is one k-mer). A character of
a script written without blanks is a word of its own, in every text alike. The
j-th occurrence of a k-mer counts as an element of its own, so repeats matter.
A hash deals the elements into 64 slots; each slot selects its two minimal
elements, keeps them in text order and hashes that tuple. Moving or changing
passages changes the tuples, so the share of equal slots follows edit distance,
not just overlap.

Defined cases: null text is empty; an empty text has no tuple and the empty
fingerprint, and is wholly like another empty text and wholly unlike any other;
texts of any length are hashed whole; equal texts have equal fingerprints.
Documents that share a doc_id each keep a row; as somebody's *next* document
the one with the smaller text hash stands for them. An empty table gives none.
Only the id and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from panelspark.llm.common import materialise, split_words

K = 5
# The scripts that write no blanks between words.
BLANKLESS = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}"
UNIT = rf"[{BLANKLESS}]|[^{BLANKLESS}\x20\x09-\x0D]+"
SLOT_BITS = 6
PER_SLOT = 2


def _slot(v: Column) -> Column:
    return F.shiftrightunsigned(v, 64 - SLOT_BITS)


def units(text: Column) -> Column:
    """Words in order, characters of blankless scripts one by one; null text has none."""
    whole = F.coalesce(text, F.lit(""))
    return F.when(whole.rlike(f"[{BLANKLESS}]"), F.regexp_extract_all(whole, F.lit(UNIT), F.lit(0))).otherwise(split_words(whole))


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds `out`: one long a filled slot (slot number, tuple hash), by slot. Row-wise, no shuffle."""
    a, b, c, d, e, f = (f"{out}_{x}" for x in "abcdef")
    col = F.col
    df = df.withColumn(a, F.transform(units(col(text)), lambda p: F.xxhash64(p)))
    n = F.size(a) - (K - 1)
    kmers = F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1),
                        lambda i: F.xxhash64(*(F.get(col(a), i + j) for j in range(K))))
    df = df.withColumn(b, F.when(n > 0, kmers).when(F.size(a) > 0, F.array(F.xxhash64(F.array_join(col(a).cast("array<string>"), " "))))
                       .otherwise(F.array().cast("array<bigint>")))
    # Texts that repeat a k-mer: (k-mer, position) in order, then the number of each within its run.
    df = df.withColumn(c, F.when(F.size(F.array_distinct(b)) < F.size(b), F.sort_array(
        F.transform(col(b), lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    df = df.withColumn(d, F.filter(F.sequence(F.lit(0), F.size(c) - 1),
                                   lambda i: (i == 0) | (F.get(col(c), i)["x"] != F.get(col(c), i - 1)["x"])))
    numbers = F.flatten(F.transform(col(d), lambda s, j: F.sequence(
        F.lit(0), F.coalesce(F.get(col(d), j + 1), F.size(c)) - s - 1)))
    several = F.zip_with(c, numbers, lambda p, j: F.when(j == 0, p["x"]).otherwise(F.xxhash64(p["x"], j)))
    df = df.withColumn(b, F.coalesce(several, col(b)))
    df = df.withColumn(e, F.sort_array(b))
    df = df.withColumn(e, F.filter(col(e), lambda v, i: (i < PER_SLOT) | (_slot(v) != _slot(F.get(col(e), i - PER_SLOT)))))
    # Only the selected elements, at most PER_SLOT a slot, are looked up in the text.
    at = F.transform(col(e), lambda v: (F.array_position(col(b), v) - 1).cast("int"))
    df = df.withColumn(f, at).withColumn(f, F.when(col(c).isNull(), col(f)).otherwise(F.transform(col(f), lambda i: F.get(col(c), i)["i"])))

    def tuple_hash(v, i):
        before = F.get(col(e), i - 1)
        pair = F.coalesce(_slot(before) == _slot(v), F.lit(False))
        ordered = F.when(F.get(col(f), i - 1) < F.get(col(f), i), F.xxhash64(before, v)).otherwise(F.xxhash64(v, before))
        h = F.when(pair, ordered).otherwise(F.xxhash64(v))
        last = F.coalesce(_slot(F.get(col(e), i + 1)) != _slot(v), F.lit(True))
        return F.when(last, F.shiftleft(_slot(v), 32).bitwiseOR(F.shiftrightunsigned(h, 32)))

    df = df.withColumn(out, F.filter(F.transform(col(e), tuple_hash), lambda x: x.isNotNull()))
    return df.drop(a, b, c, d, e, f)


def as_text(fingerprint: Column) -> Column:
    """Ten hexadecimal digits a filled slot: two for the slot, eight for its tuple."""
    return F.array_join(F.transform(fingerprint, lambda x: F.lower(F.lpad(F.hex(x), 10, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal tuples among the slots that either fingerprint fills; 1 for two empty ones."""
    slots = lambda f: F.transform(f, lambda x: F.shiftrightunsigned(x, 32))
    either = F.size(F.array_union(slots(a), slots(b)))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either)


def successors(df: DataFrame, doc_id: str, n_chars: Column) -> DataFrame:
    """(doc_id, next_id, longest): the next larger doc_id (after the largest: the smallest) and the largest n_chars
    of the rows with this doc_id. Ids are dealt into ranges; only the first id of each range crosses between them."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = df.filter(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("doc_id")).agg(F.max(n_chars).alias("longest"))
    ids = materialise(ids.repartitionByRange(n, "doc_id").withColumn("part", F.spark_partition_id()))
    firsts = ids.groupBy("part").agg(F.min("doc_id").alias("first"))  # a row a range
    order = W.orderBy("part")
    firsts = firsts.select("part", F.coalesce(F.lead("first").over(order), F.min("first").over(
        order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))).alias("later"))
    inside = F.lead("doc_id").over(W.partitionBy("part").orderBy("doc_id"))
    return ids.withColumn("inside", inside).join(firsts, "part").select(
        "doc_id", F.coalesce("inside", "later").alias("next_id"), "longest")


def fingerprint_edits(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every document and of its edited text (its last quarter replaced by as many first characters
    of the next document), and their likeness to each other and to the next document's fingerprint."""
    docs = df.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    links = successors(docs, "doc_id", F.floor(F.length("text") / 4))
    # Both uses of `own` are dealt by the same key, so they read one shuffle. A null id has no next document.
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    own = with_fingerprint(docs, "text", "fp").withColumn("key", key).repartition("key")
    links = links.select(F.col("doc_id").alias("to"), F.col("next_id").cast("string").alias("key"), "longest")
    sent = own.join(links, "key").select(F.col("to").cast("string").alias("key"), F.struct(
        F.xxhash64("text").alias("order"), F.expr("substring(text, 1, cast(longest as int))").alias("head"), F.col("fp"), F.col("doc_id")).alias("next"))
    sent = sent.groupBy("key").agg(F.min("next").alias("next"))
    both = own.join(sent, "key", "left").withColumn("n", F.length("text")).withColumn("cut", F.floor(F.col("n") / 4).cast("int"))
    both = both.select("doc_id", "n", "fp", F.col("next.fp").alias("next_fp"), F.concat(
        F.expr("substring(text, 1, n - cut)"), F.expr("substring(coalesce(next.head, ''), 1, cut)")).alias("edited"))
    both = with_fingerprint(both, "edited", "edited_fp")
    return both.select("doc_id", F.col("n").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                       as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("edited_fp")).alias("edited_fingerprint"),
                       likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
                       likeness(F.col("fp"), F.coalesce("next_fp", F.array().cast("array<bigint>"))).alias("near_next"))
