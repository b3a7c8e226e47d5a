"""Text operators against brute force, library results and the defined edge cases."""

import base64
import hashlib
import itertools
import os
import random
import re
import struct
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from panelspark.llm import (op1_licenses, op2_near_duplicates, op3_warc, op4_bpe, op5_fingerprint, op6_token_rows, op7_packing,  # noqa: E402
                            op8_quality, op9_pii, op10_language, queries)

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "lorem ipsum dolor sit amet " * 4000
EDGES = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "  \n\t ", "en", "s", 5), (4, "one two", "en", "s", 7), (5, "one two", "en", "s", 7),
         (5, "one two", "en", "s", 7), (6, LONG, "xx", "s", len(LONG)), (None, "no id here at all, none", "en", None, 22), (8, "😀 Straße ½ 12", "de", "t", 13)]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, SCHEMA)


@pytest.fixture(scope="module")
def clashing(edges):
    """Extra columns named as the operators' own."""
    for c in ("ledger", "licences", "ids", "decoded", "lang_pred", "score", "node", "class_id", "q_words", "fp", "spans", "base"):
        edges = edges.withColumn(c, F.lit(1))
    return edges


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    import oracle_check
    df = queries.QUERIES[name](spark, SF)
    cur = oracle_check.duck(SF).execute(queries.ORACLE[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert oracle_check.digest(df.columns, [tuple(r) for r in df.collect()])[0] == oracle_check.digest(cols, cur.fetchall())[0]


def test_licence_units_bounds_and_anchors(spark, clashing):
    whole = op1_licenses.TEMPLATES["ISC"]
    rows = [(1, "some other line of text\nReleased under the MIT License.\nand one more line"), (2, whole), (3, "Licensed under the Apache License, Version 2.0."), (4, "plain text"), (5, None)]
    got = {r.doc_id: r.licences for r in op1_licenses.scan(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert [(h.unit, h.licence, h.score) for h in got[1]] == [(1, "MIT-line", 1.0)]
    assert (got[2][0].unit, got[2][0].licence) == (-1, "ISC") and got[4] == [] and got[5] == []
    assert {h.licence for h in got[3]} == {"Apache-2.0-line"}
    for text in op1_licenses.TEMPLATES.values():  # a match can't do without the anchors
        grams = [g.split() for g in op1_licenses.template_bigrams(text)]
        left = [g for g in grams if not set(g) & op1_licenses.anchors(text, 0.8)]
        assert len(left) < len(grams) * 0.8 / 1.2
    out = op1_licenses.scan(clashing)
    assert out.count() == len(EDGES) and "licences_1" in out.columns


def test_licence_windows_within_longer_text(spark):
    rng = random.Random(11)
    prose = lambda n: " ".join(rng.choice("lorem ipsum dolor of the software and to sit under amet".split()) for _ in range(n))
    wrap = lambda name, n: "\n".join(" * " + " ".join(w) for w in itertools.batched(op1_licenses.TEMPLATES[name].split(), n))
    short = op1_licenses.TEMPLATES["MIT-line"]
    rows = [(1, f"title\n{wrap('MIT', 9)}\n{prose(900)}"), (2, f"{wrap('Apache-2.0-notice', 7)}\n{prose(400)}\n{prose(400)}"),
            (3, f"{prose(40)}\n{prose(30)} {short} {prose(30)}\n{short}"), (4, prose(900)),
            (5, f"{wrap('MIT', 8)}\n{prose(100)}\n{wrap('BSD-2-Clause', 8)}"), (6, f"x\n{wrap('MIT', 8).replace('publish,', 'print and publish and')}\n{prose(300)}")]
    got = {r.doc_id: [(h.unit, h.licence, h.score) for h in r.licences] for r in op1_licenses.scan(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert got[1] == [(1, "MIT", 1.0)] and (0, "Apache-2.0-notice", 1.0) in got[2] and got[4] == []
    assert got[3] == [(1, "MIT-line", 1.0), (2, "MIT-line", 1.0)]
    assert [(u, name) for u, name, s in got[5] if s == 1.0] == [(0, "MIT"), (len(wrap("MIT", 8).split("\n")) + 1, "BSD-2-Clause")]
    # The best of all windows: an edited notice against brute force.
    words, grams = op1_licenses.template_words(rows[5][1])[:320], set(op1_licenses.template_bigrams(op1_licenses.TEMPLATES["MIT"]))
    pairs = list(zip(words, words[1:]))
    best = max(2 * len({" ".join(g) for g in pairs[i:j]} & grams) / (len(set(pairs[i:j])) + len(grams)) for i in range(40) for j in range(i + 90, i + 240))
    assert [(u, name) for u, name, _ in got[6]] == [(1, "MIT")] and got[6][0][2] == pytest.approx(best) and best < 1


def word_runs(text):
    """Multiset of runs of five words, as strings; a shorter text is one run."""
    w = text.lower().split()
    return Counter(" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def test_near_duplicate_classes_equal_brute_force(docs, texts):
    sets = {i: word_runs(t) for i, t in texts.items()}
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        if (sets[a] & sets[b]).total() >= 0.8 * (sets[a] | sets[b]).total():
            x, y = sorted((root(a), root(b)))
            up[y] = x
    got = {r.doc_id: r.class_id for r in op2_near_duplicates.classes(docs).collect()}
    assert got == {i: root(i) for i in sets}


def test_near_duplicate_weights_words_and_ids(spark):
    """Repeats count; words whose CRC-32 is equal are told apart; null and repeated ids keep their own texts."""
    line = "these are the five words and some more of one line "
    other = "quite another closing sentence stands here for once "
    word = ["one", "two", "three", "four", "five", "six", "seven"]
    long = [f"w{i}" for i in range(120)]
    rows = [(1, line * 10 + other), (2, line + other), (3, line * 10 + other),
            (4, " ".join([*word, "plumless"])), (5, " ".join([*word, "buckeroo"])),
            (None, " ".join(long)), (None, " ".join([*long, "end"])),
            (7, "first text under seven"), (7, "first text under seven"), (7, "second text under seven"), (None, None), (None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    group = {}
    for r in op2_near_duplicates.classified(df, "doc_id", "text", 0.8, True).collect():
        group.setdefault(bytes(r.root), []).append(r.doc_id)
    assert sorted(sorted(g, key=str) for g in group.values() if None not in g) == [[1, 3], [2], [4], [5], [7], [7, 7]]
    assert [g for g in group.values() if None in g] == [[None, None]]
    kept = Counter(tuple(r) for r in op2_near_duplicates.keep_one(df).collect())
    assert kept[None, None] == 2 and kept[7, "first text under seven"] == kept[7, "second text under seven"] == 1
    assert kept.total() == 9 and sum(n for (i, t), n in kept.items() if t and t.startswith("w0")) == 1
    sets = {r.doc_id: r.class_id for r in op2_near_duplicates.classes(df.limit(3), weighted=False).collect()}
    assert sets[1] == sets[3] == 1


def test_darts_estimate_weighted_similarity():
    rng = np.random.default_rng(5)
    items = rng.integers(0, 2 ** 63, 800).astype(np.uint64)
    a, b = rng.integers(1, 7, 800).astype(float), rng.integers(1, 7, 800).astype(float)
    s = op2_near_duplicates.signatures([(items, a), (items, b), (items[::-1], a[::-1])])
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((s[0] == s[1]).mean() - true) < 0.16 and (s[0] == s[2]).all()


def test_shingles_of_a_slice_equal_those_of_each_text():
    """Words are told apart by length and every byte; a slice gives each text the shingles it has alone."""
    rng = random.Random(8)
    long = ["y" * n for n in (7, 8, 9, 16, 17, 63, 64, 65, 200)]
    words = ["a", "a\x00", "é", "日本語" * 9, *long, *(w[:-1] + "z" for w in long), *("z" + w[1:] for w in long)]
    texts = ["", " \n", "One", *(" ".join(rng.choices(words, k=rng.randint(1, 40))) for _ in range(200))]
    lists = [t.lower().split() for t in texts]
    for seed in (op2_near_duplicates.WORDS, op2_near_duplicates.EXACT):
        numbers, sizes = op2_near_duplicates.shingles([op2_near_duplicates.normal(t) for t in texts], seed)
        alone = [op2_near_duplicates.shingles([op2_near_duplicates.normal(t)], seed)[0].tolist() for t in texts]
        assert numbers.tolist() == sum(alone, []) and sizes.tolist() == [max(1, len(w) - 4) for w in lists]
        runs = [tuple(w[i:i + 5]) for w in lists for i in range(max(1, len(w) - 4))]
        assert len(set(zip(runs, numbers.tolist()))) == len(set(runs)) == len(set(numbers.tolist()))
    items, weights, sizes = op2_near_duplicates.weighted_sets([op2_near_duplicates.normal(t) for t in texts], True)
    s, ends = op2_near_duplicates.signed(items, weights, sizes), np.cumsum(sizes)
    for i in range(len(texts)):  # whatever else is in the slice
        a, b = ends[i] - sizes[i], ends[i]
        assert (s[i] == op2_near_duplicates.signatures([(items[a:b], weights[a:b])])[0]).all()


def test_near_duplicate_blocks_lose_no_link(spark, monkeypatch):
    rng = random.Random(2)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(120):  # more than one block of one group
        w = list(base)
        w[rng.randrange(150)] = f"x{i}"
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(op2_near_duplicates, "BLOCK", 16)
    got = op2_near_duplicates.classes(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {r.class_id for r in got.collect()} == {0}


def test_near_duplicate_edges(clashing, edges):
    got = op2_near_duplicates.classes(clashing).collect()
    assert Counter((r.doc_id, r.class_id) for r in got) == Counter([(1, 1), (2, 2), (3, 2), (4, 4), (5, 4), (5, 4), (6, 6), (None, None), (8, 8)])
    kept = op2_near_duplicates.keep_one(edges)
    assert kept.columns == edges.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 4, 6, 8]
    assert op2_near_duplicates.classes(edges.limit(0)).count() == 0


def test_warc_round_trip(spark):
    rows = [(1, "http://www.a.org/x?q=1", "same"), (2, "https://b.org", "same"), (3, None, None), (4, "http://a.org:80/", ""), (5, "http://a.org/é\n", "é" * 70000),
            (6, "http://www.a.org/x?q=1", "other")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("key", F.lit(1))
    got = {r.page_id: r for r in op3_warc.archive_round_trip(pages).collect()}
    assert len(got) == 6
    for page, _, html in rows:
        b = (html or "").encode()
        assert got[page].payload_bytes == len(b) and got[page].payload_digest == base64.b32encode(hashlib.sha1(b).digest()).decode()
    assert [(got[p].record_type, got[p].refers_to) for p in (1, 2, 3, 4)] == [("revisit", 2), ("response", None), ("revisit", 4), ("response", None)]
    assert {r.refers_to for r in op3_warc.archive_round_trip(pages, least_bytes=5).collect()} == {None}
    assert op3_warc.archive_round_trip(pages.limit(0)).count() == 0
    keys = [r[0] for r in pages.orderBy("page_id").select(op3_warc.url_key(F.col("url"))).collect()]
    assert keys[:4] == ["org,a,www)/x?q=1", "org,b)", "", "org,a:80)/"]


def test_warc_finds_keys_with_tabs_and_newlines(spark, tmp_path):
    urls = ["http://a/x\ty", "http://a/x!z", "http://a/x\ny", "http://a/x y", "http://a/x%09y", "http://a/x", "http://a/x\t", "http://a/x%", "http://a/x\x0by", None]
    rows = [(p, u, f"{p} {u}") for u in urls for p in (-5, -1, None, 0, 7)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = op3_warc.archive_round_trip(pages).collect()
    digest = lambda h: base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
    assert Counter((r.page_id, r.payload_digest) for r in got) == Counter((p, digest(h)) for p, _, h in rows)
    captures = op3_warc.write_archives(pages, f"{tmp_path}/archives")
    op3_warc.write_directory(op3_warc.write_index(captures, f"{tmp_path}/index"), f"{tmp_path}/directory")
    with pytest.raises(Exception, match="no capture of page 99"):
        op3_warc.look_up(spark.createDataFrame([("a)/x", 99, "00")], "key string, page_id bigint, digest string"), *(f"{tmp_path}/{x}" for x in ("directory", "index", "archives"))).collect()


def test_bpe_equals_library():
    import tiktoken
    file, pattern = queries.rank_file()
    voc = op4_bpe.vocabulary(file, pattern)
    lib = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=voc.ranks, special_tokens={})
    rng = random.Random(3)
    parts = list("aaabbee  \n\t'sre1²½é漢字́ \x1c\x85\xa0　🙂#*|,.") + ["  ", " the", "'ll", "ththth", "anhe"]
    for _ in range(1500):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(1, 40)))
        assert np.frombuffer(voc.encode(t), "<i4").tolist() == lib.encode_ordinary(t), t
    assert voc.merge(b"ab" * 3000) == lib.encode_ordinary("ab" * 3000)


def test_bpe_edges(clashing, edges):
    file, pattern = queries.rank_file()
    got = op4_bpe.decode(op4_bpe.encode(clashing, file, pattern), file, pattern, ids="ids_1").collect()
    assert sorted(bytes(r.decoded_1) for r in got) == sorted((r[1] or "").encode() for r in EDGES)
    assert op4_bpe.round_trip(edges.limit(0), file, pattern).count() == 0


def test_fingerprints(docs, texts, clashing):
    got = {r.doc_id: r for r in op5_fingerprint.fingerprint_edits(docs).collect()}
    ids = sorted(texts)
    for i, doc in enumerate(ids):
        t, later = texts[doc], texts[ids[(i + 1) % len(ids)]]
        cut = len(t) // 4
        assert got[doc].edited_sha256 == hashlib.sha256((t[:len(t) - cut] + later[:cut]).encode()).hexdigest() and got[doc].n_chars == len(t)
    by_text = defaultdict(set)
    for doc, t in texts.items():
        by_text[t].add(got[doc].fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    assert np.mean([r.near_edited for r in got.values()]) > 0.25 > 0.1 > np.mean([r.near_next for r in got.values()])
    rows = op5_fingerprint.fingerprint_edits(clashing).collect()
    assert len(rows) == len(EDGES) and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)


def xx(*values: bytes) -> int:
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(v, h)
    return h


def long(v: int) -> bytes:
    return struct.pack("<Q", v & (1 << 64) - 1)


def brute_fingerprint(text: str) -> list[int]:
    """One slot after the other, over all elements: the two smallest, in text order."""
    blankless = f"[{regex_scripts}]"
    words = [xx(w.encode()) for w in regex.findall(rf"{blankless}|(?:(?!{blankless})[^ \t-\r])+", text)]
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    if len(words) >= 5:
        kmers = [xx(*map(long, words[i:i + 5])) for i in range(len(words) - 4)]
    else:
        kmers = [xx(" ".join(str(signed(w)) for w in words).encode())] if words else []
    seen, elements = Counter(), []
    for at, k in enumerate(kmers):
        elements.append((k if not seen[k] else xx(long(k), struct.pack("<I", seen[k])), at))
        seen[k] += 1
    out = {}
    for slot in range(64):
        least = sorted((signed(v), at, v) for v, at in elements if v >> 58 == slot)[:2]
        if least:
            out[slot] = slot << 32 | xx(*(long(v) for _, at, v in sorted(least, key=lambda x: x[1]))) >> 32
    return sorted(out.values())


# The scripts that write no blanks between words.
regex_scripts = "".join(rf"\p{{Script={s}}}" for s in ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar", "Tibetan"))


def test_fingerprint_equals_brute_force(spark, docs, texts):
    """Order and occurrences count: the reordered text has the same k-mers in another order."""
    halves = ["a b c d e f g h i j", "k l m n o p q r s t"]
    rows = [(1, " ".join(halves * 40)), (2, " ".join(halves[::-1] * 40)), (3, " ".join(halves * 20)), (4, " ".join(halves * 40)),
            (5, "日本語のテキストは空白なしで書かれています。mixed with blanks"), (6, ""), (7, "one two"), (8, LONG)]
    df = op5_fingerprint.with_fingerprint(spark.createDataFrame(rows, "i int, text string"), "text", "fp")
    fp = {r.i: r.fp for r in df.collect()}
    assert fp[1] == fp[4] and fp[1] != fp[2] and fp[1] != fp[3]
    assert {i: sorted(f) for i, f in fp.items()} == {i: brute_fingerprint(t) for i, t in rows}
    got = op5_fingerprint.with_fingerprint(docs.select("doc_id", "text"), "text", "fp").collect()
    assert all(sorted(r.fp) == brute_fingerprint(texts[r.doc_id]) for r in got)


@pytest.mark.parametrize("width", [3, 15, 16, 17, 40])
def test_one_changed_word_keeps_the_fingerprint_alike(spark, width):
    """400 words of any length, one of them longer by four characters; and 400 characters without blanks."""
    rng = random.Random(width)
    words = ["".join(rng.choices("abcdefghijklmnop", k=width)) for _ in range(400)]
    signs = [chr(rng.randrange(0x4E00, 0x9000)) for _ in range(400)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:200], words[200] + "wxyz", *words[201:]])),
            (3, "".join(signs)), (4, "".join([*signs[:200], "語", *signs[200:]]))]
    df = op5_fingerprint.with_fingerprint(spark.createDataFrame(rows, "i int, text string"), "text", "fp")
    one = df.filter("i % 2 = 1").select((F.col("i") + 1).alias("i"), F.col("fp").alias("other"))
    got = df.join(one, "i").select(op5_fingerprint.likeness(F.col("fp"), F.col("other"))).collect()
    assert len(got) == 2 and all(r[0] > 0.8 for r in got)


def test_blocks_that_differ_late_have_names_of_their_own(spark):
    file, pattern = queries.rank_file()
    same = "one two three four five six seven eight nine ten "
    names = {r.block for t in ("eleven", "twelve") for r in op6_token_rows.pack_rows(
        spark.createDataFrame([(1, same + t)], "doc_id bigint, text string"), file, pattern).collect()}
    assert len(names) == 2


def test_token_rows_round_trip(spark, docs, clashing):
    file, pattern = queries.rank_file()
    for df in (docs, clashing.filter("doc_id is not null").dropDuplicates(["doc_id"])):
        packed = op6_token_rows.pack_rows(df, file, pattern, width=64, block_tokens=20000)
        rows = packed.collect()
        for r in rows:
            ends = r.cu_seqlens
            assert ends[0] == 0 and ends[-1] == r.n_tokens <= 64 and len(r.ids) == 128
            position = np.frombuffer(r.position_ids, "<i4")
            assert all(position[a:b].tolist() == list(range(b - a)) for a, b in zip(ends, ends[1:]))
        want = {r.doc_id: r.ids for r in op4_bpe.encode(df.select("doc_id", "text"), file, pattern).collect()}
        assert {r.doc_id: r.ids for r in op6_token_rows.unpack_rows(packed, 50257).collect()} == want
    assert op6_token_rows.pack_rows(docs.limit(0), file, pattern).count() == 0


def test_best_fit_decreasing_takes_the_tightest_row():
    rng = random.Random(1)
    sizes = [rng.randint(1, 50) for _ in range(300)]
    rows, left, order = [], [], sorted(range(300), key=lambda i: -sizes[i])
    for i in order:
        fits = [(c, k) for k, c in enumerate(left) if c >= sizes[i]]
        k = min(fits)[1] if fits else len(rows)
        if not fits:
            rows.append([])
            left.append(50)
        rows[k].append(i)
        left[k] -= sizes[i]
    got = op6_token_rows.best_fit_decreasing(sizes, 50)
    assert sorted(sum(sizes[i] for i in r) for r in got) == sorted(sum(sizes[i] for i in r) for r in rows)


def test_packing_conflicts_and_tightest_bin(docs, clashing):
    got = op7_packing.pack(docs, op7_packing.words_in("text"), op7_packing.same_words("text"), capacity=300, shard_rows=50).collect()
    size = {r.doc_id: len((r.text or "").split()) for r in docs.collect()}
    source = {r.doc_id: r.source for r in docs.collect()}
    bins, pieces = defaultdict(list), defaultdict(int)
    for r in got:
        bins[r.shard, r.bin].append(r)
        pieces[r.doc_id] += r["size"]
    assert pieces == size
    for rows in bins.values():
        assert sum(r["size"] for r in rows) <= 300 and len({source[r.doc_id] for r in rows}) == len(rows)
        spans = sorted((r["at"], r["at"] + r["size"]) for r in rows)
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    rng, bins = random.Random(4), op7_packing.Bins(100)
    for _ in range(400):  # against a search of all bins
        n, s, c = rng.randint(1, 60), 1 << rng.randrange(5), 1 << rng.randrange(9)
        fit = [(r, k) for k, r in enumerate(bins.residual) if r >= n and not bins.sources[k] & s and not bins.clusters[k] & c]
        want = min(fit)[1] if fit else len(bins.residual)
        assert bins.place(n, s, c)[0] == want
    assert op7_packing.pack(clashing, op7_packing.words_in("text"), op7_packing.same_words("text")).filter("piece = 0").count() == len(EDGES)


def test_packing_parts_near_copies_of_different_sources(spark, tmp_path):
    rng = random.Random(13)
    rows = []
    for g in range(12):
        words = [f"g{g}w{i}" for i in range(150)]
        for k in range(4):  # each with a word of its own
            w = list(words)
            w[rng.randrange(150)] = f"own{g}x{k}"
            rows.append((g * 4 + k, " ".join(w), "en", f"s{g * 4 + k}", 0))
    rows += [(100, None, "en", "a", 0), (101, " ", "en", "b", 0), (None, "no id", "en", "c", 0)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op7_best_fit_packing(spark, str(tmp_path)).collect()
    groups = [(r.bin, r.doc_id // 4) for r in got if r.doc_id is not None and r.doc_id < 100]
    assert len(got) == len(rows) and len(set(groups)) == len(groups) and len({b for b, _ in groups}) < len(groups)


def test_packing_reads_texts_once_for_words_and_classes(spark, monkeypatch):
    """Words are counted as the texts are signed, just as `words_in` does; rows keep their own class and count."""
    rng = random.Random(9)
    odd = ["".join(rng.choices(" \t\n\x0b\x0c\r\x1c\x85\xa0\u3000ab\x00é", k=rng.randint(0, 30))) for _ in range(300)]
    rows = [(None, "no id", "a"), (None, "nor this", "b"), (7, "one two", "c"), (7, "ONE  two", "d"), (7, "three", "e"), (7, "three", "e"),
            (8, None, "f"), (9, " ", "g"), (10, "", None), *((100 + i, t, f"s{i}") for i, t in enumerate(odd))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    want = Counter((r.doc_id, r.source, r.words) for r in df.select("doc_id", "source", op7_packing.words_in("text").alias("words")).collect())
    monkeypatch.setattr(op7_packing, "words_in", None)
    got = op7_packing.with_clusters(df).collect()
    assert Counter((r.doc_id, r.source, r.words) for r in got) == want
    assert all((r.cluster is None) == (r.words == 0) for r in got)
    of = {r.source: r.cluster for r in got}
    assert of["c"] == of["d"] and len({of[x] for x in "abce"}) == 4


def test_quality_edges_policies_and_ablation(clashing, edges, docs):
    got = op8_quality.ledger(clashing, out="ledger")
    assert got.count() == len(EDGES) and "ledger_1" in got.columns
    rows = {r.doc_id: r.ledger for r in op8_quality.ledger(edges).collect()}
    assert rows[1].n_words == 0 and rows[3].n_words == 0 and rows[6].n_words == 20000 and rows[6].n_repeat_words == 20000
    assert op8_quality.keep_good(edges).columns == edges.columns and op8_quality.keep_good(edges.limit(0)).count() == 0
    ledger = op8_quality.ledger(docs).select("doc_id", "ledger.failure_bits")
    bits = [r.failure_bits for r in ledger.collect()]
    for r in op8_quality.ablation(ledger, F.col("failure_bits")).collect():
        b = op8_quality.BIT[r.rule]
        assert (r.n_failed, r.n_only_this_rule) == (sum(x & b != 0 for x in bits), sum(x == b for x in bits))


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def test_base_spans_equal_plain_patterns():
    rng = random.Random(6)
    for _ in range(6000):
        t = "".join(rng.choice(["a", "1", "25", ".", "@", "-", " ", "+", "_", "é", "(", "4111 1111 1111 1111"]) for _ in range(rng.randint(0, 25)))
        found = op9_pii.base_spans(t)
        assert [(a, b) for a, k, b in found if k == 0] == [m.span() for m in EMAIL.finditer(t)], t
        assert [(a, b) for a, k, b in found if k == 1] == [m.span() for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))], t


def test_contextual_extraction_and_redaction(spark, clashing, edges):
    rng = random.Random(8)
    key = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    rows = [(i, f"some words token = \"{key()}\" and more {rng.randint(10**9, 10**10)}x of it", "en", "s", 1) for i in range(60)] + [(99, "a@b.org is mail", "en", "s", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r.spans for r in op9_pii.report(df).collect()}
    assert sum("context" in s for s in got.values()) >= 55 and got[99] == "email:0:7"
    text = {r.doc_id: r.text for r in op9_pii.redact(df, n_chars="n_chars").collect()}
    assert text[99] == "[email] is mail" and "[context]" in text[3]
    assert op9_pii.report(clashing).count() == len(EDGES) == op9_pii.redact(edges).count()
    assert op9_pii.report(edges.limit(0)).count() == 0


def test_context_evidence_starts_from_seeds(spark):
    rng = random.Random(9)
    mixed = lambda n: "".join(rng.choice("ghkmnpqr") + str(rng.randrange(10)) for _ in range(n // 2))
    plain = [(i, f"see version 1.20.{i}-beta of {2000 + i}-05-17 for order {10**8 + 7919 * i} at price {i}99.95eur now") for i in range(80)]
    got = op9_pii.report(spark.createDataFrame(plain, "doc_id int, text string")).collect()
    assert {r.spans for r in got} == {""}
    # Emails seed a context; identifiers of their shape are found in it, and through them a context without any seed.
    codes = [mixed(16) for _ in range(30)]
    rows = [(i, f"please contact {mixed(10)}@b.org about this") for i in range(40)] + [(100 + i, f"please contact {c} about this") for i, c in enumerate(codes)]
    rows += [(200 + i, f"a locker {c} stands there") for i, c in enumerate([*codes, "k1m2n3p4q5r6g7h8"])] + [(300 + i, t) for i, t in plain]
    got = {r.doc_id: r.spans for r in op9_pii.report(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert all("context:15:31" in got[100 + i] for i in range(30)) and all(got[200 + i] == "context:9:25" for i in range(31))
    assert {got[300 + i] for i, _ in plain} == {""}


def test_context_finds_short_identifiers(spark):
    """A third of the values is given; the others are found by the patterns these induce."""
    rows = [(i, f"set token = \"AB{12345 + i}\" here") for i in range(30)] + [(100 + i, f"pwd = x{i} and {i} apples") for i in range(30)]
    known = spark.createDataFrame([(f"AB{12345 + i}",) for i in range(20)] + [(f"x{i}",) for i in range(20)], "instance string")
    df = spark.createDataFrame(rows, "doc_id int, text string")
    got = {r.doc_id: r.spans for r in op9_pii.report(df, seeds=known).collect()}
    assert all(got[i] == "context:13:20" and got[100 + i] == f"context:6:{7 + len(str(i))}" for i in range(30))
    assert {r.spans for r in op9_pii.report(df).collect()} == {""}


def test_held_out_secrets_are_found_by_induced_patterns(spark):
    """Of the table's secrets, three quarters are given and no other is a seed: the pattern is trusted, since over half of its
    instances and five more are known. The rest is found, and nothing else."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    planted = {m[1] for t in text.values() for m in re.finditer(r'token = "([0-9a-f]{40})"', t)}
    given = sorted(planted)[:len(planted) * 3 // 4]
    seeds = spark.createDataFrame([(x,) for x in given], "instance string")
    got = set()
    for r in op9_pii.report(docs, seeds=seeds, random_seeds=False).collect():
        got |= {text[r.doc_id][int(a):int(b)] for k, a, b in (x.split(":") for x in r.spans.split(",") if x) if k == "context"}
    assert len(planted) > len(given) and got == planted


def test_context_spreads_to_a_fixed_point(spark):
    """A chain of six contexts, each reached through the one before."""
    rng = random.Random(10)
    codes = [[f"{rng.choice('ghkm')}{rng.randrange(10**6, 10**7)}q" for _ in range(12)] for _ in range(6)]
    rows = [f"start {c} end" for c in codes[0]]
    for k in range(5):
        rows += [f"link{'abcdef'[k]} {c} tail{'abcdef'[k]}" for c in [*codes[k], *codes[k + 1]]]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id int, text string")
    seeds = spark.createDataFrame([(c,) for c in codes[0]], "instance string")
    assert all("context" in r.spans for r in op9_pii.report(df, seeds=seeds).collect())


def test_contexts_are_whole_words():
    rng = random.Random(11)
    for _ in range(200):
        text = "".join(rng.choice(["a", "Bé", " ", "=", "9", "-", "w" * 60, ". "]) for _ in range(40))
        spans = [tuple(sorted(rng.sample(range(len(text)), 2))) for _ in range(4)]
        words = [m for m in re.finditer(r"[^\W\d_]+|=", text)]
        want = [(" ".join([m[0].lower() for m in words if m.end() <= a][-2:]), next((m[0].lower() for m in words if m.start() >= b), "")) for a, b in spans]
        assert op9_pii.contexts(text, spans) == want


def test_cards_and_phones_equal_brute_force():
    rng = random.Random(13)
    for _ in range(400):
        t = "".join(rng.choice(["4", "1", "0", "79927398713", " ", "-", "+", "(", ")", ".", "x", "4111 1111 1111 1111", "+49 30 1234567"]) for _ in range(rng.randint(1, 25)))
        found = op9_pii.base_spans(t)
        good = lambda d: 12 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(d[::-1])) % 10 == 0
        assert [(a, b) for a, k, b in found if k == 2] == [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if good(re.sub(r"[^0-9]", "", m[0]))], t
        assert [(a, b) for a, k, b in found if k == 3] == [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15], t


def test_language_held_out_accuracy_and_edges(docs, clashing, edges, spark):
    model = op10_language.fit(docs)
    got = op10_language.predict(docs, model).filter(~op10_language.may_learn(F.col("doc_id"))).collect()
    assert np.mean([r.lang == r.lang_pred for r in got if len(r.text or "") > 40]) >= 0.95
    out = op10_language.predict(clashing, model)
    assert out.count() == len(EDGES) and "lang_pred_1" in out.columns
    pred = {r.doc_id: (r.lang_pred, r.score) for r in op10_language.predict(edges, model).collect()}
    assert pred[1] == pred[2] == pred[3] == ("und", 0.0)
    assert op10_language.fit(edges.limit(0)) is None
    assert {r.lang_pred for r in op10_language.predict(edges, None).collect()} == {"und"}


def test_language_stage_rejects_unlearned_languages(docs):
    rng = random.Random(12)
    other = ["".join(rng.choice("bdgkmnzvlraiouy") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    rows = [(10**6 + i, " ".join(rng.choice(other) for _ in range(rng.choice((60, 300)))), None, "s", 0) for i in range(20)]
    rows += [(2 * 10**6, "kvôli tomu však nebolo možné prísť skôr než večer a preto sme čakali doma až do rána " * 4, None, "s", 0)]
    kept = {r.doc_id for r in op10_language.keep_known(docs.unionByName(docs.sparkSession.createDataFrame(rows, SCHEMA))).collect()}
    clean = {r.doc_id for r in op8_quality.keep_good(docs).collect()}
    assert clean <= kept and not kept & {r[0] for r in rows}


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    e, moves, lengths = rng.normal(size=(7, 3)), rng.normal(size=(3, 3)), np.array([3, 4])
    got = op10_language.forward_backward(e, lengths, moves)
    at = 0
    for n in lengths:
        want = np.zeros((n, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            p = np.exp(sum(e[at + t, y] for t, y in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:])))
            for t, y in enumerate(path):
                want[t, y] += p
        assert np.allclose(got[at:at + n], want / want.sum(1, keepdims=True))
        at += n


def test_pipeline_keeps_columns_and_drops_rejects(spark, docs):
    import corpus_pipeline
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "quality", "near_duplicates", "personal_data", "packing"]
    out = corpus_pipeline.run(spark, SF)
    packed = {r.doc_id for r in out.collect()}
    good = {r.doc_id for r in op8_quality.keep_good(docs).collect()}
    classes = {r.doc_id: r.class_id for r in op2_near_duplicates.classes(docs.filter(F.col("doc_id").isin(list(good)))).collect()}
    assert packed <= good and packed == {i for i, c in classes.items() if i == c}


def test_warc_repeated_and_null_page_ids(spark):
    """Each row comes back with its own payload, whatever its id."""
    rows = [(5, "http://a.org/", "AAAA"), (5, "http://a.org/", "BBBBBBBB"), (5, "http://b.org/", "CC"), (4, "http://c.org/", "AAAA"),
            (None, "http://a.org/", "x"), (None, "http://a.org/", "yy"), (None, None, "AAAA"), (None, "http://a.org/", "x")]
    got = op3_warc.archive_round_trip(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    digest = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    first = {"AAAA": 5}
    want = Counter((i, len(t), digest(t), "response" if first.get(t) in (None, i) else "revisit", None if first.get(t) in (None, i) else first[t])
                   for i, _, t in rows)
    assert Counter(map(tuple, got.collect())) == want
