r"""Fill-in-the-middle by block rotation in place.

A text is cut into lines; two cuts make prefix, middle and suffix. Its bytes go
into one bytearray: the line ends are scanned, sentinels are inserted at the
cuts, and blocks change places by rotation, each rotation three reversals
within the array. Restoring finds the sentinels, inverts the rotation and
deletes them, which gives the exact text again.

    psm   <P>prefix<S>suffix<M>middle
    spm   <S>suffix<P>prefix<M>middle
    plain the text as it is

Which texts are transformed, the cuts and the form are drawn from a hash of a
seed and the id alone, so a rerun or another partitioning draws the same.

Defined cases: null text is empty; an empty text and a text that has one of
the sentinels stay plain; a null doc_id draws as the empty string; cuts may
coincide, then parts are empty; texts of any length are transformed whole (a
task holds one text, its array and a reversal buffer of fixed size); repeated
rows give equal rows; an empty table gives none. Only the id and text columns
are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The sentinels.
P, S, M = b"<P>", b"<S>", b"<M>"
SEED, RATE, SPM = 7, 100, 50
STEP = 1 << 16
SLICE_BYTES = 4 << 20
OUTPUT = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def reverse(a: bytearray, i: int, j: int) -> None:
    """Reverses a[i:j] in place; what is held besides is two pieces of STEP bytes."""
    while j - i > 2 * STEP:
        left = a[i:i + STEP]
        a[i:i + STEP] = a[j - STEP:j][::-1]
        a[j - STEP:j] = left[::-1]
        i, j = i + STEP, j - STEP
    a[i:j] = a[i:j][::-1]


def rotate(a: bytearray, i: int, k: int, j: int) -> None:
    """Exchanges the neighbouring blocks a[i:k] and a[k:j]: each is reversed, then both together."""
    reverse(a, i, k)
    reverse(a, k, j)
    reverse(a, i, j)


def line_ends(a: bytearray, wanted: tuple[int, ...]) -> tuple[int, list[int]]:
    """Number of lines, and for each wanted number of lines where that many end."""
    n = a.count(b"\n") + (len(a) > 0 and a[-1:] != b"\n")
    ends, at, line = {0: 0, n: len(a)}, 0, 0
    for k in sorted(set(wanted)):
        while k not in ends:
            at = a.index(b"\n", at) + 1
            line += 1
            ends[line] = at
    return n, [ends[k] for k in wanted]


def draw(seed: int, doc_id) -> tuple[int, int, int, int]:
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(h[8 * i:8 * i + 8], 16) for i in range(4))


def to_infill(a: bytearray, cut: int, end: int, form: str) -> None:
    """Cuts the text in `a` at bytes `cut` and `end` and puts its parts into the order of `form`."""
    a[end:end] = S
    a[cut:cut] = M
    a[0:0] = P
    middle, suffix = cut + len(P), end + len(P) + len(M)  # <P>prefix | <M>middle | <S>suffix
    rotate(a, middle if form == "psm" else 0, suffix, len(a))


def from_infill(a: bytearray, form: str) -> None:
    """The inverse of to_infill: each rotation is undone, then the sentinels go."""
    if form == "plain":
        return
    if form == "psm":  # <P>prefix | <S>suffix | <M>middle
        first, second = a.index(S), a.index(M)
        rotate(a, first, second, len(a))
    else:  # <S>suffix | <P>prefix<M>middle
        rotate(a, 0, a.index(P), len(a))
    for mark in (S, M, P):
        at = a.index(mark)
        del a[at:at + len(mark)]


def chars(a: bytearray, i: int, j: int) -> int:
    """Code points of UTF-8 in a[i:j], counted in pieces: all bytes but the continuation bytes."""
    return sum(len(a[k:min(k + STEP, j)].translate(None, CONTINUATION)) for k in range(i, j, STEP))


CONTINUATION = bytes(range(0x80, 0xC0))


def transform_text(text: bytes, doc_id, seed: int = SEED, rate: int = RATE, spm: int = SPM) -> tuple[int, str, int | None, int | None, bytes]:
    """(lines, form, code points of prefix and middle, output) of one text."""
    a = bytearray(text)
    h1, h2, h3, h4 = draw(seed, doc_id)
    n, _ = line_ends(a, ())
    if not a or P in a or S in a or M in a or h3 % 100 >= rate:
        return n, "plain", None, None, text
    _, (cut, end) = line_ends(a, tuple(sorted((h1 % (n + 1), h2 % (n + 1)))))
    form = "spm" if h4 % 100 < spm else "psm"
    sizes = chars(a, 0, cut), chars(a, cut, end)
    to_infill(a, cut, end, form)
    return n, form, *sizes, bytes(a)


def slices(batch: pa.RecordBatch, text: str):
    """Row ranges of a batch whose texts together are near SLICE_BYTES (one text at least), as lists of the columns."""
    first, size = 0, 0
    column = batch.column(text).cast(pa.binary())
    for i in range(batch.num_rows):
        size += len(column[i].as_buffer() or b"") if column[i].is_valid else 0
        if size >= SLICE_BYTES or i == batch.num_rows - 1:
            part = batch.slice(first, i + 1 - first)
            yield part, [x or b"" for x in column.slice(first, i + 1 - first).to_pylist()]
            first, size = i + 1, 0


def transform(df: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """The transformed text of every row with its form and the sizes of its parts."""
    rows = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))

    def run(batches):
        for batch in batches:
            for part, texts in slices(batch, "text"):
                ids = part.column("doc_id").to_pylist()
                n, form, prefix, middle, output = zip(*(transform_text(t, i, seed, rate, spm) for i, t in zip(ids, texts)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()),
                     pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())], names=[x.split()[0] for x in OUTPUT.split(", ")])

    return rows.mapInArrow(run, OUTPUT)


def restore(transformed: DataFrame) -> DataFrame:
    """Adds `restored`, rebuilt from `output` and `form` alone, to rows of transform()."""
    def run(batches):
        for batch in batches:
            for part, outputs in slices(batch, "output"):
                texts = []
                for a, form in zip(map(bytearray, outputs), part.column("form").to_pylist()):
                    from_infill(a, form)
                    texts.append(bytes(a))
                yield part.append_column("restored", pa.array(texts, pa.binary()).cast(pa.string()))

    return transformed.mapInArrow(run, f"{OUTPUT}, restored string")
