"""Personal data: patterns for known kinds, and contextual extraction bootstrapped from their matches.

Known kinds (email, ip, card, phone) are found by fixed patterns. The method
then looks for identifiers that no pattern describes. Every token with a digit
(or '@') that lies outside the found spans is a candidate instance; its lexical
patterns are the words before, the word after, and both sides, each with its
shape. Seed entities are the matches of the known kinds, the candidates whose
value looks drawn at random (`random_looking`; no name beside it is consulted)
and those of a given table of known values (`seeds`). Evidence starts there
alone: Spark scores each pattern by the share of its distinct instances that
are seeds or already found (damped by the number of instances, so rare patterns
earn nothing) and each instance by its patterns on the two sides, in rounds
until no instance is added. Instances whose score passes the threshold are
found and become spans of kind `context`, so a seed needs a pattern that other
instances support, too; base spans always stay. A pattern that no seed reaches
scores 0, so a corpus without seeds has no such span.

The graph holds one row per distinct (pattern, instance), aggregated map-side
before any shuffle; a pattern or instance may be hot, since both sides of a
round are aggregates joined by key.

Defined cases: null text is empty and has no span; texts of any length are
searched whole; equal starts order by kind; repeated rows each get their spans;
an empty table gives none; only the id and text columns are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import free_name, materialise

# The kinds and their patterns.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits either begins a match or none of its digits does, so only its first digit is tried.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CONTEXT = "context"

TOKEN = re.compile(r"[^\s]*[0-9@][^\s]*")
EDGE = "\"'()[]{}<>,;:!?*$%&#|."
WORD = re.compile(r"[^\W\d_]+|=")

# What a value drawn at random is made of.
CODED = re.compile(r"[A-Za-z0-9+/_-]{20,}")

MIN_INSTANCES = 5
THRESHOLD = 0.5


def emails(text: str) -> list[tuple[int, int]]:
    """Works from each '@', so the cost is linear: the longest run of local characters before it, not reaching into
    the last match, then a domain after it."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), ascending. Leftmost non-overlapping matches of each kind; failing ones drop out."""
    found = []
    if "@" in text:
        found += [(a, 0, b) for a, b in emails(text)]
    if ANY_DIGIT.search(text):
        found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        for m in PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


ANY_DIGIT = re.compile(r"[0-9]")


def shape(token: str) -> str:
    """What an unseen identifier looks like: hexadecimal or not, and its length class. Instances of one shape share
    evidence, and a pattern is a context together with a shape."""
    kind = "hex" if re.fullmatch(r"[0-9a-f]+", token) else "digits" if token.isdigit() else "mixed"
    return f"{kind}{min(len(token), 64) // 4}"


def random_looking(token: str) -> bool:
    """At least 20 coded characters with a letter and a digit, and a Shannon entropy of 3 bits a character (hexadecimal)
    or 4 (others)."""
    if not CODED.fullmatch(token) or token.isdigit() or not ANY_DIGIT.search(token):
        return False
    n, hexadecimal = len(token), not set(token) - set("0123456789abcdef")
    return sum(k / n * math.log2(n / k) for k in Counter(token).values()) >= (3 if hexadecimal else 4)


def contexts(text: str, spans: list[tuple[int, int]]) -> list[tuple[str, str]]:
    """(the last two words before, the first word after) of each span: whole words, whatever lies between, in lower
    case. One pass over the words; only what the spans need is kept."""
    starts, ends = sorted({a for a, _ in spans}), sorted({b for _, b in spans})
    before, after, last, i, j = {}, {}, (), 0, 0
    for m in WORD.finditer(text):
        while i < len(starts) and starts[i] < m.end():
            before[starts[i]] = last
            i += 1
        while j < len(ends) and ends[j] <= m.start():
            after[ends[j]] = m[0].lower()
            j += 1
        if i == len(starts) and j == len(ends):
            break
        last = (*last[-1:], m[0].lower())
    return [(" ".join(before.get(a, last)), after.get(b, "")) for a, b in spans]


def candidates(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, str, str, str, bool, bool]]:
    """(start, end, instance, words before, word after, base, seed): tokens with a digit or '@', and the base matches."""
    out, k = [(start, end, True, True) for start, _, end in spans], 0
    for m in TOKEN.finditer(text):
        token = m[0]
        a = m.start() + len(token) - len(token.lstrip(EDGE))
        b = m.start() + len(token.rstrip(EDGE))
        while k < len(spans) and spans[k][2] <= a:
            k += 1
        if b <= a or any(s < b and a < e for s, _, e in spans[max(0, k - 3):k + 4]):
            continue
        out.append((a, b, False, random_looking(text[a:b])))
    around = contexts(text, [(a, b) for a, b, _, _ in out])
    return [(a, b, text[a:b], before, after, base, seed) for (a, b, base, seed), (before, after) in zip(out, around)]


def spans_of(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, base, cands) of every row: base spans, and candidates with their pattern."""
    schema = (f"doc_id {dict(df.dtypes)[doc_id]}, base array<struct<start:int,kind:int,end:int>>, "
              "cands array<struct<start:int,end:int,instance:string,shape:string,before:string,after:string,base:boolean,seed:boolean>>")
    base_type = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    cand_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("instance", pa.string()), ("shape", pa.string()),
                                    ("before", pa.string()), ("after", pa.string()), ("base", pa.bool_()), ("seed", pa.bool_())]))

    def run(batches):
        for batch in batches:
            base, cands = [], []
            for t in batch.column("text").to_pylist():
                found = base_spans(t) if t else []
                base.append([dict(start=a, kind=k, end=b) for a, k, b in found])
                # Only texts with a digit or '@' hold candidates.
                cands.append([dict(start=a, end=b, instance=x, shape=shape(x), before=w, after=v, base=f, seed=s)
                              for a, b, x, w, v, f, s in (candidates(t, found) if t and ("@" in t or ANY_DIGIT.search(t)) else [])])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(base, base_type), pa.array(cands, cand_type)],
                                             names=["doc_id", "base", "cands"])

    return df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def patterns_of(c: Column) -> Column:
    """Lexical patterns (side, pattern) of a candidate, each with its shape: the last word before it, the last two, the
    word after it, and both sides. Sides are 0 (before), 1 (after) and 2 (both)."""
    last, after = F.element_at(F.split(c["before"], " "), -1), c["after"]
    made = lambda side, a, b: F.struct(F.lit(side).alias("side"), F.concat(a, F.lit(" _"), c["shape"], F.lit("_ "), b).alias("pattern"))
    none, two = F.lit(""), c["before"].contains(" ")
    return F.array_compact(F.array(F.when(last != "", made(0, last, none)), F.when(two, made(0, c["before"], none)),
                                   F.when(after != "", made(1, none, after)), F.when((last != "") & (after != ""), made(2, last, after))))


def score_graph(found: DataFrame, seeds: DataFrame | None = None, random_seeds: bool = True, min_instances: int = MIN_INSTANCES, threshold: float = THRESHOLD) -> DataFrame:
    """(instance, score) of the candidates that are no base matches and that evidence reaches. `seeds` has a column
    `instance` of values known beforehand; without `random_seeds` no other candidate is a seed.

    In turns, pattern = its instances that are seeds or have passed the threshold / (n + min_instances), n being the
    number of its distinct instances; instance = 1 - (1 - before) * (1 - after), or the both-side pattern if that is
    larger, by the best pattern of each side. Below the threshold nothing is passed on, so weak evidence does not
    grow from round to round. What is found only grows, so the rounds end when one adds nothing."""
    rows = found.select(F.explode("cands").alias("c")).select("c.instance", "c.base", "c.seed", F.explode(patterns_of(F.col("c"))).alias("p"))
    edges = rows.groupBy("p.side", "p.pattern", "instance").agg(F.max("base").alias("base"), F.max("seed" if random_seeds else "base").alias("seed"))
    if seeds is not None:
        known = seeds.select("instance").distinct().withColumn("known", F.lit(True))
        edges = edges.join(known, "instance", "left").withColumn("seed", F.col("seed") | F.coalesce("known", F.lit(False))).drop("known")
    edges = materialise(edges)
    sure, n_sure = edges.filter("seed").select("instance").distinct(), -1
    while True:
        pattern = edges.join(sure.withColumn("sure", F.lit(1)), "instance", "left").groupBy("side", "pattern").agg(
            (F.count("sure") / (F.count("*") + min_instances)).alias("score")).filter("score > 0")
        side = lambda k: F.coalesce(F.max(F.when(F.col("side") == k, F.col("score"))), F.lit(0.0))
        scores = materialise(edges.join(pattern, ["side", "pattern"]).groupBy("instance").agg(
            F.max("base").alias("base"), F.max("seed").alias("seed"),
            F.greatest(1 - (1 - side(0)) * (1 - side(1)), side(2)).alias("score")))
        sure = scores.filter(F.col("seed") | (F.col("score") >= threshold)).select("instance")
        n_before, n_sure = n_sure, sure.count()
        if n_sure == n_before:
            return scores.filter(~F.col("base")).select("instance", "score")


def find(df: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, seeds: DataFrame | None = None,
         random_seeds: bool = True) -> DataFrame:
    """(doc_id, base, spans) of every row: base spans, and all spans, as arrays of (start, kind, end) by start, kind."""
    found = materialise(spans_of(df, doc_id, text).withColumn("row", F.monotonically_increasing_id()))
    sure = score_graph(found, seeds, random_seeds, threshold=threshold).filter(F.col("score") >= threshold).select("instance")
    new = found.select("row", F.explode("cands").alias("c")).filter(~F.col("c.base")).select("row", "c.start", "c.end", "c.instance") \
        .join(sure, "instance").groupBy("row").agg(F.collect_list(F.struct("start", F.lit(len(KINDS)).alias("kind"), "end")).alias("added"))
    return found.join(new, "row", "left").select("doc_id", "base", F.array_sort(F.concat("base", F.coalesce(
        "added", F.expr("cast(array() as array<struct<start:int,kind:int,end:int>>)")))).alias("spans"))


def as_text(spans: Column) -> Column:
    names = F.array(*map(F.lit, (*KINDS, CONTEXT)))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(df: DataFrame, doc_id: str = "doc_id", text: str = "text", seeds: DataFrame | None = None, random_seeds: bool = True) -> DataFrame:
    n = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{KINDS[k]}")
    return find(df, doc_id, text, seeds=seeds, random_seeds=random_seeds).select(F.col("doc_id").cast("bigint").alias("doc_id"), *(n(k) for k in range(len(KINDS))), F.sha2(as_text(F.col("base")), 256).alias("base_sha256"),
                                         as_text(F.col("spans")).alias("spans"))


def redact(df: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str | None = None) -> DataFrame:
    """The rows with every span of their text replaced by its kind in brackets, overlapping spans by the first one;
    same columns. Spans are joined by the SHA-256 of id and text: rows that share it are equal in both."""
    names = (*KINDS, CONTEXT)
    spans_col, key = free_name(df, "pii_spans"), free_name(df, "pii_key")
    keyed = df.withColumn(key, F.sha2(F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))), 256))
    spans = find(keyed, key, text).groupBy(F.col("doc_id").alias(key)).agg(F.first("spans").alias(spans_col)).filter(F.size(spans_col) > 0)
    both = keyed.join(spans, key, "left")
    schema = df.schema

    def run(batches):
        for batch in batches:
            texts = []
            for t, found in zip(batch.column(text).to_pylist(), batch.column(spans_col).to_pylist()):
                if t and found:
                    out, at = [], 0
                    for s in found:
                        if s["start"] >= at:
                            out += [t[at:s["start"]], f"[{names[s['kind']]}]"]
                            at = s["end"]
                        else:
                            at = max(at, s["end"])
                    t = "".join(out) + t[at:]
                texts.append(t)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if f.name == text else batch.column(f.name) for f in schema.fields],
                                             names=schema.fieldNames())

    out = both.select(*df.columns, spans_col).mapInArrow(run, schema)
    return out if n_chars is None else out.withColumn(n_chars, F.length(text).cast(schema[n_chars].dataType))
