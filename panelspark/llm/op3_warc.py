"""WARC archives with a two-level capture index.

Pages are written as gzip members, a record each, into archive files; equal
payloads are stored once and revisited. The index has a line a capture, keyed
by the reversed-host URL, sorted and cut into gzip blocks; a sparse directory
holds the first key and place of each block. A look-up searches the directory,
then the block, then reads just the record's range of the archive.

All files are written by tasks into the shared folder under names of their
own attempt and listed in the rows that the task returns; a retried task
writes new files, and files that no returned row names don't count. Files are
reached through pyarrow's file systems, so the folder may be any store that
they know by URI.

Defined cases: a null page has an empty payload; a null URL has the empty key;
captures of one URL are told apart by page_id and payload; payloads of any length
are one record; equal page rows give equal records; a null page_id revisits a
payload that a page with an id has, and is never the one revisited by it; an empty table gives an empty
archive. Only the three named columns are read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import materialise, shared_folder

DATE = "1970-01-01T00:00:00Z"  # the table has no capture time
BLOCK_LINES = 3000
CAPTURES = "key string, page_id bigint, digest string, file string, at bigint, length bigint, record_type string, refers_to bigint"
RECORDS = "page_id bigint, payload binary, payload_digest string, record_type string, refers_to bigint"


def url_key(url: Column) -> Column:
    """Reversed-host key: http://www.a.org:80/p?q -> org,a,www:80)/p?q ; null -> ''. Percent, tab and newline, which
    part the fields and lines of the index, are escaped here, so that sorting, directory and look-up use one key."""
    u = F.lower(F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://", ""))
    for c in "%\t\n":
        u = F.replace(u, F.lit(c), F.lit(f"%{ord(c):02X}"))
    host = F.regexp_extract(u, r"^([^/?#]*)", 1)
    name, port = F.regexp_extract(host, r"^([^:]*)", 1), F.regexp_extract(host, r"(:.*)$", 1)
    rest = F.substring(u, F.length(host) + 1, F.length(u))
    return F.when(u == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(name, r"\.")), ","), port, F.lit(")"), rest))


def place(uri: str) -> tuple[fs.FileSystem, str]:
    system, path = fs.FileSystem.from_uri(uri if ":" in uri.split("/")[0] else f"file://{uri}")
    return system, path


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str, payload: bytes, refers_to) -> bytes:
    """One WARC/1.1 record. A revisit names the record it refers to and carries no payload."""
    name = lambda p: f"<urn:page:{p}>"
    body = b"" if refers_to is not None else payload
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", name(page_id)), ("WARC-Date", DATE),
            ("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha1:{_digest(payload)}"), ("Content-Type", "text/html; charset=utf-8")]
    if refers_to is not None:
        head += [("WARC-Refers-To", name(refers_to)),
                 ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    head.append(("Content-Length", str(len(body))))
    clean = lambda v: str(v).replace("\r", "%0D").replace("\n", "%0A")
    return b"WARC/1.1\r\n" + "".join(f"{k}: {clean(v)}\r\n" for k, v in head).encode() + b"\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    return fields, rest[:int(fields["Content-Length"])]


def _page(name: str) -> int | None:
    text = name.removeprefix("<urn:page:").removesuffix(">")
    return None if text == "None" else int(text)


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", payload: str = "html",
                   least_bytes: int = 0) -> DataFrame:
    """Writes the archives below `folder`; returns the captures (one a page). Of records with equal payloads of at
    least `least_bytes` bytes, that with the largest page_id is the response and the others revisit it."""
    html = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("url"),
                        html.alias("html"), url_key(F.col(url)).alias("key"), F.sha1(html.cast("binary")).alias("sha1"))
    same = pages.select(F.sha1(html.cast("binary")).alias("sha1"), F.col(page_id).cast("bigint").alias("page_id"),
                        F.octet_length(html).alias("n")).groupBy("sha1", "n").agg(F.max("page_id").alias("first"), F.count("*").alias("times"))
    same = same.filter((F.col("times") > 1) & (F.col("n") >= least_bytes)).select("sha1", "first")
    rows = rows.join(same, "sha1", "left").select("key", "page_id", F.col("sha1").alias("digest"), "url", "html", F.when(
        ~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("refers_to"))

    def run(batches):
        system, base = place(folder)
        system.create_dir(base, recursive=True)
        name, at, stream = f"pages-{uuid.uuid4().hex}.warc.gz", 0, None
        for batch in batches:
            out = []
            for key, page, digest, u, text, ref in zip(*(batch.column(c).to_pylist() for c in ("key", "page_id", "digest", "url", "html", "refers_to"))):
                stream = stream or system.open_output_stream(f"{base}/{name}", compression=None)
                member = gzip.compress(record(page, u, text.encode(), ref), 6, mtime=0)
                stream.write(member)
                out.append((key, page, digest, name, at, len(member), "response" if ref is None else "revisit", ref))
                at += len(member)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 8, CAPTURE_TYPES)],
                                             names=[x.split()[0] for x in CAPTURES.split(", ")])
        if stream:
            stream.close()

    return materialise(rows.mapInArrow(run, CAPTURES))


CAPTURE_TYPES = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64())


def _line(key, page, digest, file, at, length) -> str:
    return "\t".join((key, "%d" % page if page is not None else "-", digest, file, str(at), str(length)))


def _sort_key(key: str, page, digest: str) -> tuple[bytes, bool, int, str]:
    """Order of Spark's sort: null before every number."""
    return key.encode(), page is not None, page or 0, digest


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Level one: sorted gzip blocks of capture lines, below `folder`. Returns level two, the directory: first and
    last key and place of each block."""
    n = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The key as UTF-8 bytes, then page_id and digest: many captures of one URL are spread over ranges, too.
    by = ("key", "page_id", "digest")
    rows = captures.select(*by, "file", "at", "length").repartitionByRange(n, *by).sortWithinPartitions(*by)

    def run(batches):
        system, base = place(folder)
        system.create_dir(base, recursive=True)
        name, at, stream, held = f"index-{uuid.uuid4().hex}.gz", 0, None, []

        def block():
            nonlocal at, stream
            stream = stream or system.open_output_stream(f"{base}/{name}", compression=None)
            data = gzip.compress("\n".join(_line(*r) for r in held).encode(), 6, mtime=0)
            stream.write(data)
            found = (*held[0][:3], name, at, len(data), len(held))
            at += len(data)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(found, (
                pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()))], names=[*by, "file", "at", "length", "n"])

        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in (*by, "file", "at", "length"))):
                held.append(r)
                if len(held) >= block_lines:
                    yield block()
                    held = []
        if held:
            yield block()
        if stream:
            stream.close()

    return materialise(rows.mapInArrow(run, "key string, page_id bigint, digest string, file string, at bigint, length bigint, n bigint"))


def write_directory(blocks: DataFrame, path: str) -> None:
    """The sparse directory as one small sorted table (a row a block), read by every task that looks up."""
    blocks.orderBy("key", "page_id", "digest").write.parquet(path)


def _read_range(system, path: str, at: int, length: int) -> bytes:
    with system.open_input_file(path) as f:
        return f.read_at(length, at)


class Index:
    """Look-ups: binary search in the directory, one range read of a block, binary search in the block."""

    def __init__(self, directory: str, folder: str):
        import pyarrow.dataset as ds

        system, path = place(directory)
        rows = ds.dataset(path, filesystem=system, format="parquet").to_table().to_pylist()
        self.blocks = sorted((_sort_key(r["key"], r["page_id"], r["digest"]), r["file"], r["at"], r["length"]) for r in rows)
        self.firsts = [b[0] for b in self.blocks]
        self.system, self.folder = place(folder)
        self.held: tuple[int, list, list] = (-1, [], [])

    def block(self, k: int) -> tuple[list, list]:
        if self.held[0] != k:
            _, file, at, length = self.blocks[k]
            lines = [x.split("\t") for x in gzip.decompress(_read_range(self.system, f"{self.folder}/{file}", at, length)).decode().split("\n")]
            keys = [_sort_key(x[0], None if x[1] == "-" else int(x[1]), x[2]) for x in lines]
            self.held = k, keys, lines
        return self.held[1:]

    def find(self, key: str, page, digest: str) -> tuple[str, int, int] | None:
        """(file, offset, length) of the record of this capture, or of one equal to it."""
        want = _sort_key(key, page, digest)
        k = bisect_right(self.firsts, want) - 1
        if k < 0:
            return None
        keys, lines = self.block(k)
        i = bisect_left(keys, want)
        return (lines[i][3], int(lines[i][4]), int(lines[i][5])) if i < len(keys) and keys[i] == want else None


def look_up(wanted: DataFrame, directory: str, index: str, archives: str) -> DataFrame:
    """wanted: (key, page_id, digest). Returns their records: header fields and the payload that the record carries. A
    capture that the index does not have is an error. Keys are sorted first, so that a task reads each block once."""
    n = int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = ("key", "page_id", "digest")
    rows = wanted.select(*by).repartitionByRange(n, *by).sortWithinPartitions(*by)

    def run(batches):
        found = None
        system, base = place(archives)
        for batch in batches:
            if batch.num_rows and found is None:
                found = Index(directory, index)
            for at in range(0, batch.num_rows, 256):
                part, out = batch.slice(at, 256), []
                for key, page, digest in zip(*(part.column(c).to_pylist() for c in by)):
                    if (where := found.find(key, page, digest)) is None:
                        raise LookupError(f"no capture of page {page} under the key {key!r}")
                    head, body = parse(gzip.decompress(_read_range(system, f"{base}/{where[0]}", where[1], where[2])))
                    ref = head.get("WARC-Refers-To")
                    out.append((_page(head["WARC-Record-ID"]), body, head["WARC-Payload-Digest"].removeprefix("sha1:"),
                                head["WARC-Type"], None if ref is None else _page(ref)))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, (
                    pa.int64(), pa.binary(), pa.string(), pa.string(), pa.int64()))], names=[x.split()[0] for x in RECORDS.split(", ")])

    return rows.mapInArrow(run, RECORDS)


def archive_round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes archives, index and directory, then reads every capture back through the index."""
    spark = pages.sparkSession
    base = shared_folder(spark, "warc")
    captures = write_archives(pages, f"{base}/archives", least_bytes=least_bytes)
    write_directory(write_index(captures, f"{base}/index"), f"{base}/directory")
    got = look_up(captures, f"{base}/directory", f"{base}/index", f"{base}/archives").select(
        "page_id", F.octet_length("payload").cast("bigint").alias("own_bytes"), "payload_digest", "record_type", "refers_to")
    got = materialise(got)
    # A revisit's payload is the one it refers to; only narrow rows meet here.
    named = got.filter("record_type = 'response'").groupBy(F.col("payload_digest").alias("to")).agg(F.max("own_bytes").alias("bytes"))
    return got.join(named, F.col("refers_to").isNotNull() & (F.col("payload_digest") == F.col("to")), "left").select(
        "page_id", F.coalesce("bytes", "own_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
