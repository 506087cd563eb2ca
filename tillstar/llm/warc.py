"""WARC archives with a two-level capture index.

Archives: every record is a gzip member of its own, so a record can be read
by its byte range.  Of payloads that occur more than once (at least
``REVISIT_BYTES`` long), the record with the largest page id holds the
payload; the others are revisit records that refer to it.

Index: a capture line has the URL as a sort key (host labels reversed, scheme,
``www.`` and default port dropped), the record id and the record's file, offset
and length.  Lines are range-sorted over the cluster and written in blocks of
``BLOCK_LINES`` lines, each compressed by itself; the sparse directory keeps
the first key of each block with its place.  A lookup finds the blocks of
each key by binary search in the directory, which goes to the tasks in key
ranges of bounded size: a key meets the entries of its own range only.  The
blocks found are dealt to tasks, so the blocks of a hot key spread, read once
each and searched again for their lines; the captures are dealt by file and
offset, about ``READ_BYTES`` of archive to a task, and their records range-read.

Tasks write under names of their own, and only files named by committed rows
belong to an archive, so a lost executor or a second attempt leaves nothing
that a reader would see.  Files go to the folder given (the shared one), opened
through Arrow's file systems, local or remote.

Edge cases: null html is an empty payload; a null URL has the empty key and no
target URI; records with a null page id are written and read, but never chosen
as the response of a group that has an id; repeated rows of a response are
responses each; an empty table gives an empty archive; other columns are
ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import os
import re
import uuid
from bisect import bisect_left, bisect_right
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm.common import Shared, shared_table

REVISIT_BYTES = 1000
BLOCK_LINES = 512
FILE_BYTES = 64 << 20
# Bytes of archive, and of compressed index blocks, that a task reads; lines
# that it gives at once; directory entries that go to a task at once.
READ_BYTES, INDEX_BYTES, BATCH_LINES = 8 << 20, 4 << 20, 10_000
ENTRIES, BOUNDS = 500_000, 10_000
DATE = "2026-01-01T00:00:00Z"
PORTS = {"http": 80, "https": 443}


def open_store(path: str):
    """File system and plain path of a URI or local path."""
    from pyarrow import fs
    path = re.sub(r"^file:/(?!/)", "file:///", path)
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def url_key(url: str | None) -> str:
    """Sort key of a URL: reversed host, then path and query, lower-cased host."""
    if not url:
        return ""
    try:
        parts = urlsplit(url if "//" in url else "//" + url)
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:
        return url
    at = ",".join(reversed(host.split(".")))
    if port and port != PORTS.get(parts.scheme):
        at += f":{port}"
    return f"{at}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def record(page_id, url, digest: str, payload: bytes, refers_to, refers_url) -> bytes:
    """One WARC record; a revisit has no payload of its own."""
    revisit = refers_to is not None
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}:{digest}:{url}')}>",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}"]
    if url:
        head.append("WARC-Target-URI: " + re.sub(r"[\r\n]", " ", url))
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"X-Refers-To-Page-Id: {refers_to}"]
        if refers_url:
            head.append("WARC-Refers-To-Target-URI: " + re.sub(r"[\r\n]", " ", refers_url))
    body = b"" if revisit else b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict, bytes]:
    """Headers and payload of an unpacked record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[:int(fields["Content-Length"])]
    return fields, body.partition(b"\r\n\r\n")[2]


def plan_records(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, html, digest, refers_to, refers_url: what to write.  Rows
    of a group of equal payloads, but for one of its response's, refer to it."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", html.alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    bytes_ = F.octet_length("html")
    groups = rows.filter(bytes_ >= least).groupBy("digest").agg(
        F.count(F.lit(1)).alias("copies"), F.max(F.struct("page_id", "url")).alias("best"))
    groups = shared_table(groups.filter("copies > 1").select(
        "digest", F.col("best.page_id").alias("best_id"), F.col("best.url").alias("best_url")), "warc-groups")
    rows = rows.join(groups, "digest", "left")
    own = F.col("best_id").isNull() | F.col("page_id").eqNullSafe(F.col("best_id"))
    return rows.select("page_id", "url", "html", "digest", F.when(~own, F.col("best_id")).alias("refers_to"),
                       F.when(~own, F.col("best_url")).alias("refers_url"))


def write_archives(planned: DataFrame, folder: str) -> DataFrame:
    """Writes the records, a file or more per task, and returns their capture
    lines (key, page_id, file, offset, length)."""
    def write(batches):
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        out, name, at = None, "", 0
        for b in batches:
            lines = []
            for row in b.to_pylist():
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"part-{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                data = gzip.compress(record(row["page_id"], row["url"], row["digest"], row["html"].encode(),
                                            row["refers_to"], row["refers_url"]), 6, mtime=0)
                out.write(data)
                lines.append((url_key(row["url"]), row["page_id"], name, at, len(data)))
                at += len(data)
            cols = list(zip(*lines)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                ["key", "page_id", "file", "offset", "length"])
        if out is not None:
            out.close()

    return shared_table(planned.mapInArrow(write, "key string, page_id bigint, file string, offset bigint, length bigint"),
                        "warc-lines")


def _line(key, page_id, file, offset, length) -> str:
    key = key.replace("\\", "\\\\").replace("\t", "\\t").replace("\n", "\\n").replace("\r", "\\r")
    return "\t".join([key, "" if page_id is None else str(page_id), file, str(offset), str(length)])


def _fields(line: str) -> tuple:
    key, page_id, file, offset, length = line.split("\t")
    key = re.sub(r"\\(.)", lambda m: {"t": "\t", "n": "\n", "r": "\r"}.get(m[1], m[1]), key)
    return key, int(page_id) if page_id else None, file, int(offset), int(length)


def write_index(lines: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Sorts the capture lines by key, writes them in compressed blocks and
    returns the sparse directory (first, last, file, offset, length)."""
    def write(batches):
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        name, out, at, block = f"captures-{uuid.uuid4().hex}.gz", None, 0, []

        def flush():
            nonlocal out, at
            if out is None:
                out = store.open_output_stream(f"{root}/{name}", compression=None)
            data = gzip.compress("\n".join(_line(*x) for x in block).encode(), 6, mtime=0)
            out.write(data)
            entry = (block[0][0], block[-1][0], name, at, len(data))
            at += len(data)
            block.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip(entry, (pa.string(),) * 3 + (pa.int64(),) * 2)],
                ["first", "last", "file", "offset", "length"])

        for b in batches:
            for x in zip(*(b.column(c).to_pylist() for c in ("key", "page_id", "file", "offset", "length"))):
                block.append(x)
                if len(block) == block_lines:
                    yield flush()
        if block:
            yield flush()
        if out is not None:
            out.close()

    # file and offset make the order unique, so equal keys spread over ranges
    order = ["key", "file", "offset"]
    ranged = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    return shared_table(ranged.mapInArrow(write, "first string, last string, file string, offset bigint, length bigint"),
                        "warc-directory")


def directory_parts(directory: DataFrame, entries: int = ENTRIES):
    """(least key, key beyond or None, entries) of the directory, sorted, at
    most about ``entries`` at a time.  The ranges are cut at quantiles of a
    bounded sample of first keys; a range in which one key has more blocks
    comes in several parts."""
    n = directory.count()
    bounds = [""]
    if n > entries:
        share = max(1, n // BOUNDS)
        firsts = sorted(r["first"] for r in directory.filter(
            F.pmod(F.xxhash64("file", "offset"), F.lit(share)) == 0).select("first").collect())
        parts = -(-n // entries)
        bounds = sorted({"", *(firsts[len(firsts) * k // parts] for k in range(1, parts) if firsts)})
    for lo, hi in zip(bounds, [*bounds[1:], None]):
        part = directory.filter(F.col("last") >= lo)
        part = part if hi is None else part.filter(F.col("first") < hi)
        slices = 1 if n <= entries else max(1, -(-part.count() // entries))
        for k in range(slices):
            piece = part if slices == 1 else part.filter(F.pmod(F.xxhash64("offset", "file"), F.lit(slices)) == k)
            yield lo, hi, sorted(tuple(r) for r in piece.select("first", "last", "file", "offset", "length").collect())


def find_blocks(keys: DataFrame, directory: DataFrame) -> DataFrame:
    """key, file, offset, length: the index blocks that may hold each key."""
    spark = keys.sparkSession
    names = ["key", "file", "offset", "length"]

    def finder(shared):
        def find(batches):
            entries = shared.value
            firsts = [e[0] for e in entries]
            # blocks of one key may overlap; the running maximum of the last
            # keys is sorted and so can be searched
            lasts, top = [], ""
            for e in entries:
                top = max(top, e[1])
                lasts.append(top)

            def rows(out):
                cols = list(zip(*out)) or [()] * 4
                types = (pa.string(), pa.string(), pa.int64(), pa.int64())
                return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

            for b in batches:
                out = []
                for key in b.column("key").to_pylist():
                    for k in range(bisect_left(lasts, key), bisect_right(firsts, key)):
                        if entries[k][1] >= key:
                            out.append((key, *entries[k][2:]))
                        if len(out) == BATCH_LINES:
                            yield rows(out)
                            out = []
                yield rows(out)
        return find

    asked = shared_table(keys.select("key").distinct().repartitionByRange("key").sortWithinPartitions("key"), "warc-keys")
    found = None
    for lo, hi, entries in directory_parts(directory):
        own = asked.filter(F.col("key") >= lo)
        own = own if hi is None else own.filter(F.col("key") < hi)
        part = own.mapInArrow(finder(Shared(spark, entries)), "key string, file string, offset bigint, length bigint")
        found = part if found is None else found.unionByName(part)
    return found


def lookup(keys: DataFrame, directory: DataFrame, folder: str) -> DataFrame:
    """Capture lines of the rows (key): blocks by binary search in the sparse
    directory, then lines by binary search in the block.  A key is asked once."""
    names = ["key", "page_id", "file", "offset", "length"]
    types = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())

    def read(batches):
        store, root = open_store(folder)
        files, at, lines, known = {}, None, [], []
        for b in batches:
            out = []
            for key, *place in zip(*(b.column(c).to_pylist() for c in ("key", "file", "offset", "length"))):
                if at != place:
                    file, offset, length = place
                    if file not in files:
                        if len(files) >= 64:
                            files.popitem()[1].close()
                        files[file] = store.open_input_file(f"{root}/{file}")
                    data = gzip.decompress(files[file].read_at(length, offset)).decode()
                    at, lines = place, [_fields(x) for x in data.split("\n")]
                    known = [x[0] for x in lines]
                out += lines[bisect_left(known, key):bisect_right(known, key)]
                if len(out) >= BATCH_LINES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                    out = []
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)
        for f in files.values():
            f.close()

    blocks = shared_table(find_blocks(keys, directory), "warc-blocks")
    tasks = max(1, -(-(directory.agg(F.sum("length")).first()[0] or 0) // INDEX_BYTES))
    dealt = blocks.repartition(tasks, "file", "offset").sortWithinPartitions("file", "offset", "key")
    return dealt.mapInArrow(read, "key string, page_id bigint, file string, offset bigint, length bigint")


def read_records(captures: DataFrame, folder: str) -> DataFrame:
    """page_id, url, record_type, refers_to, payload (null for revisits),
    payload_digest as stored: range reads of the captures' records."""
    def read(batches):
        store, root = open_store(folder)
        files = {}
        for b in batches:
            out = []
            for file, offset, length in zip(*(b.column(c).to_pylist() for c in ("file", "offset", "length"))):
                if file not in files:
                    if len(files) >= 64:
                        files.popitem()[1].close()
                    files[file] = store.open_input_file(f"{root}/{file}")
                head, payload = parse_record(gzip.decompress(files[file].read_at(length, offset)))
                page, refers = head.get("X-Page-Id"), head.get("X-Refers-To-Page-Id")
                revisit = head["WARC-Type"] == "revisit"
                out.append((int(page) if page else None, head.get("WARC-Target-URI"), head["WARC-Type"],
                            int(refers) if refers else None, None if revisit else payload,
                            head["WARC-Payload-Digest"].removeprefix("sha1:")))
            cols = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string()))],
                ["page_id", "url", "record_type", "refers_to", "payload", "payload_digest"])
        for f in files.values():
            f.close()

    places = shared_table(captures.select("file", "offset", "length"), "warc-captures")
    tasks = max(1, -(-(places.agg(F.sum("length")).first()[0] or 0) // READ_BYTES))
    dealt = places.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(
        read, "page_id bigint, url string, record_type string, refers_to bigint, payload binary, payload_digest string")


def archive(pages: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Writes archives and index below ``folder``: (capture lines, directory)."""
    lines = write_archives(plan_records(pages), f"{folder}/archive")
    return lines, write_index(lines, f"{folder}/index")


def read_back(keys: DataFrame, directory: DataFrame, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of the
    captures of the keys.  Lengths and digests are computed from the payloads
    read; a revisit takes them from the record that it refers to."""
    records = read_records(lookup(keys, directory, f"{folder}/index"), f"{folder}/archive")
    records = shared_table(records.select(
        "page_id", "record_type", "refers_to", F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"), F.col("payload_digest").alias("stored")), "warc-records")
    whole = records.filter("record_type = 'response'").groupBy(
        F.col("page_id").alias("w_id"), F.col("payload_digest").alias("w_digest")).agg(
        F.first("payload_bytes").alias("w_bytes"))
    back = records.join(whole, (F.col("refers_to") == F.col("w_id")) & (F.col("stored") == F.col("w_digest")), "left")
    return back.select("page_id", F.coalesce("payload_bytes", "w_bytes").alias("payload_bytes"),
                       F.coalesce("payload_digest", "w_digest").alias("payload_digest"), "record_type", "refers_to")
