"""Repeated passages, fill-in-the-middle and the conversation trie: brute force, exact round trips, defined cases."""

import hashlib
import random
import zlib

import pyarrow as pa
import pytest
from panelspark.llm import op11_repeats, op12_infill, op13_prefix_trie, queries

SF = "/root/testdata/sf0.001"
LONG = "lorem ipsum dolor sit amet consectetur\n" * 12000
EDGES = [(1, None), (2, ""), (3, "  \n\t "), (4, "one two"), (5, "one two"), (5, "one two"), (6, LONG), (7, LONG), (None, LONG + "end"),
         (8, "😀 Straße ½ 12 x\x85y\n\nz"), (9, "has <S> within"), (10, "a\x01b a\x01b " * 20), (11, "a\x01b a\x01b " * 20 + "more")]
MORE = [f"1 AS {c}" for c in ("part", "anchor", "low", "suffix", "kept", "n", "form", "output", "restored", "node", "pos", "digest", "block", "before")]


def repeats_by_hand(rows, window):
    """First document of each window, then each word's fate."""
    last = float("inf")
    texts = [(last if i is None else i, i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for key, _, w in texts:
        for k in range(len(w) - window + 1):
            g = tuple(w[k:k + window])
            first[g] = min(key, first.get(g, key))
    out = []
    for key, i, w in texts:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < key:
                gone[k:k + window] = [True] * window
        out.append((i, len(w), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out, key=repr)


def test_repeats_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    want = repeats_by_hand([tuple(r) for r in docs.collect()], 13)
    got = [tuple(r)[:3] for r in op11_repeats.remove_repeats(docs).collect()]
    assert sorted(got, key=repr) == want and any(n > len(t.split()) for _, n, t in want)
    # Small parts and groups of one suffix: prefixes are extended to full length; nothing changes.
    split = op11_repeats.remove_repeats(docs, part_bytes=4096, group=1)
    assert sorted((tuple(r)[:3] for r in split.collect()), key=repr) == want


@pytest.mark.parametrize("seed", range(2))
def test_repeats_of_random_texts(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([None, *range(12)]), " ".join(rng.choice("ab") for _ in range(rng.randrange(40)))) for _ in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = op11_repeats.remove_repeats(df, window=6, anchor=3, part_bytes=100, group=3)
    assert sorted((tuple(r)[:3] for r in got.collect()), key=repr) == repeats_by_hand(rows, 6)


def test_repeats_defined_cases(spark):
    df = spark.createDataFrame(EDGES, "doc_id bigint, text string").selectExpr("*", *MORE)
    got = op11_repeats.remove_repeats(df)
    assert sorted((tuple(r)[:3] for r in got.collect()), key=repr) == repeats_by_hand(EDGES, 13)
    spans = {r.doc_id: [tuple(s) for s in r.removed] for r in got.collect()}
    assert spans[6] == [] and spans[7] == [(0, 72000)] and spans[None] == [(0, 72000)] and spans[11] == [(0, 40)]
    assert op11_repeats.remove_repeats(df.limit(0)).count() == 0


def test_deep_nodes_go_on_over_batches():
    """The least id of a node is that of its first leaf, also where the node goes on in later batches."""
    leaves = [(b"a", 0, 1, 5, 5), (b"a", 1, 2, 7, 9), (b"a", 1, 3, 8, 8), (b"b", 0, 4, 3, 3), (b"c", 0, 5, 4, 6), (b"c", 2, 6, 4, 4)]
    want = [(1, 2, 5), (1, 3, 5), (0, 5, 4)]
    names = ["suffix", "part", "at", "low", "high"]
    for size in (1, 2, 4, 6):
        parts = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*leaves[k:k + size])], names=names) for k in range(0, 6, size)]
        got = [tuple(r.values()) for b in op11_repeats.deep_nodes()(iter(parts)) for r in b.to_pylist()]
        assert got == want


def test_heavy_prefixes_are_all_above_the_bound(spark):
    df = spark.createDataFrame([(1, "x y z " * 30), (2, "x q " * 30)], "doc_id bigint, text string")
    heavy = op11_repeats.heavy_prefixes(df, 25, 5, 150)
    count = {}
    for words in (("x y z " * 30).split(), ("x q " * 30).split()):
        for k in range(len(words) - 4):
            for n in range(1, 5):
                p = " ".join(words[k:k + n]).encode()
                count[p] = count.get(p, 0) + 1
    assert {p for p, n in count.items() if n > 25} <= heavy <= {p for p, n in count.items() if n > 12} and b"x y z" in heavy


def test_infill_round_trip_and_draws(spark):
    df = spark.createDataFrame(EDGES, "doc_id bigint, text string").selectExpr("*", *MORE)
    rows = op12_infill.restore(op12_infill.transform(df)).collect()
    texts = {(i, t or "") for i, t in EDGES}
    assert len(rows) == len(EDGES) and {(r.doc_id, r.restored) for r in rows} == texts
    for r in rows:
        h = hashlib.sha256(f"7:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
        lines = [x for x in r.restored.replace("\n", "\n\0").split("\0") if x]
        assert r.n == len(lines)
        a, b = sorted((h1 % (r.n + 1), h2 % (r.n + 1)))
        p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
        if r.restored == "" or "<S>" in r.restored:
            want = ("plain", None, None, r.restored)
        elif h4 % 100 < 50:
            want = ("spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
        else:
            want = ("psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")
        assert (r.form, r.prefix_chars, r.middle_chars, r.output) == want
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    assert op12_infill.transform(df.limit(0)).count() == 0
    assert {r.form for r in op12_infill.transform(df, rate=0).collect()} == {"plain"}


@pytest.mark.parametrize("size", [0, 1, 5, 1000, 3 * op12_infill.STEP + 7])
def test_rotation_in_place(size):
    rng = random.Random(size)
    data = bytes(rng.randrange(256) for _ in range(size))
    for cut in {0, size // 3, size}:
        a = bytearray(data)
        op12_infill.rotate(a, 0, cut, size)
        assert a == data[cut:] + data[:cut]
        op12_infill.rotate(a, 0, size - cut, size)
        assert a == data


def trie_by_hand(rows):
    conv = {}
    for c, t, r, x in rows:
        if c is not None:
            digest = hashlib.md5(f"{len(r or '')}:{r or ''}{x or ''}".encode()).digest()
            conv.setdefault(c, []).append((t is not None, t or 0, digest, r or "", x or ""))
    conv = {c: [v[3:] for v in sorted(turns)] for c, turns in conv.items()}
    built = {}
    for c, own in conv.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = conv.get(c - c % 100, [])[:h] + own[h:]
    members, kids = {}, {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    for k in members:
        if k:
            kids[k[:-1]] = kids.get(k[:-1], 0) + 1
    below = {k: [0, 0] for k in members}
    for k, m in members.items():
        for d in range(len(k) + 1):
            below[k[:d]][0] += k not in kids
            below[k[:d]][1] += (len(m) - 1) * len(k[-1][1]) if k else 0
    return sorted(((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids.get(k, 0), *below[k], hashlib.sha256(
        ",".join(str(c) for c in sorted(m) if len(built[c]) == len(k)).encode()).hexdigest()) for k, m in members.items()), key=repr)


CONV = "conv_id bigint, turn bigint, role string, text string"


def test_trie_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op13_conversation_trie(spark, SF)
    assert sorted(map(tuple, got.collect()), key=repr) == trie_by_hand(rows)


@pytest.mark.parametrize("block", [1, 3, 4])
def test_trie_of_random_conversations(spark, block):
    """Several families, shared beginnings, copies, short and long ones, absent first conversations, nulls and ties."""
    rng = random.Random(block)
    rows = []
    for c in [*range(0, 330, 3), 705, 799]:
        for t in range(rng.choice([1, 2, 3, 5, 9, 14])):
            rows.append((c, rng.choice([t, t, None, 3]), rng.choice(["u", "a", None]), rng.choice(["x", "yy", None, "é😀"])))
    rows += [(None, 1, "u", "lost"), (5, 1, "u", "same"), (5, 1, "u", "same")]
    df = spark.createDataFrame(rows, CONV).selectExpr("*", *MORE)
    got = op13_prefix_trie.family_trie(df, block=block)
    assert sorted(map(tuple, got.collect()), key=repr) == trie_by_hand(rows)


def test_trie_turnless_and_empty(spark):
    # 7 takes no turn of the absent conversation 0 and drops its own first ones.
    c = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 0)
    rows = [(c, 0, "u", "gone")]
    got = op13_prefix_trie.family_trie(spark.createDataFrame(rows, CONV))
    assert list(map(tuple, got.collect())) == trie_by_hand(rows) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
    assert op13_prefix_trie.family_trie(spark.createDataFrame([], CONV)).count() == 0


def test_many_ids_of_a_node_stream_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(op13_prefix_trie, "PIECE_IDS", 7)
    rows = [(c, 0, "u", "same") for c in range(0, 40000, 100)]
    got = op13_prefix_trie.family_trie(spark.createDataFrame(rows, CONV))
    assert sorted(map(tuple, got.collect()), key=repr) == trie_by_hand(rows)
