"""WARC archives with a two-level capture index.

Writing: each task writes its rows as one archive of gzip members, a response with the payload
or, for a payload that an earlier page has, a revisit that names that page.  Index lines
(reversed-host URL key, page, archive, offset, length) are sorted over all archives and written
as compressed blocks; beside each index file lies its sparse directory with the first key of
every block.  What the driver keeps is one row per index file.

Reading: keys are sorted and each is found by binary search over the index files, over the
directory of one of them and in one block; the records are then read by ranges, neighbours in
one request.  Archives and index are reached through the file system their URI names.

Files get fresh names in every attempt and count only when their task's rows arrive, so lost
or repeated tasks leave unused files but no wrong ones.

Defined results: a null html is an empty payload; a null or odd url is kept, percent-encoded,
under the key of what it has; rows with one page_id and one payload are all responses if that
id is the smallest (repeated rows are records of their own); a null page_id counts as greater
than any and stays null; an empty table gives an empty result; other columns do not enter.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tweetlake.llm.common import cut, ship
from tweetlake.session import scratch_path

BLOCK_LINES, GAP, MOST = 256, 1 << 16, 1 << 22
_NO_ID = (1 << 63) - 1


def url_key(url: Column) -> Column:
    """The host's labels from the last to the first, then what follows the host."""
    u = F.coalesce(url, F.lit(""))
    host = F.lower(F.regexp_extract(u, r"(?s)^.*?://([^/?#]*)", 1))
    rest = F.regexp_replace(u, r"(?s)^.*?://[^/?#]*", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def _files(uri: str):
    from pyarrow import fs
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


def record(page_id: int, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One gzip member: a response, or a revisit of another page's payload."""
    head = [f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}", f"WARC-Record-ID: <urn:page:{page_id}>",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}"]
    body = b""
    if refers_to is None:
        body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
        head = ["WARC/1.1", "WARC-Type: response", *head, "Content-Type: application/http;msgtype=response"]
    else:
        head = ["WARC/1.1", "WARC-Type: revisit", *head, f"WARC-Refers-To: <urn:page:{refers_to}>",
                "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    raw = "\r\n".join([*head, f"Content-Length: {len(body)}"]).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    return gzip.compress(raw, compresslevel=4, mtime=0)


def parse(member: bytes) -> dict:
    """The headers of a record and, of a response, its payload."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[:int(fields["Content-Length"])]
    return fields | {"payload": body.partition(b"\r\n\r\n")[2]}


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0) -> DataFrame:
    """Write the archives; returns the index lines (key, page_id, file, offset, length)."""
    ship(pages.sparkSession)
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.coalesce("page_id", F.lit(_NO_ID)).alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
                        payload.alias("payload"), F.unhex(F.sha1(payload)).alias("digest"))
    # Only digests and ids are compared; a payload moves once.
    seen = rows.select("page_id", "digest", F.length("payload").alias("n")).where(f"n >= {int(least_bytes)}")
    first = seen.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = (seen.select("page_id", "digest").join(first.select("digest", "refers_to"), "digest")
             .where("page_id > refers_to").distinct())
    rows = rows.join(again, ["page_id", "digest"], "left").withColumn("key", url_key(F.col("url")))

    def written(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, at, name = None, 0, f"{path}/archives/{uuid.uuid4().hex}.warc.gz"
        try:
            for part in parts:
                lines = []
                for r in part.itertuples(index=False):
                    if out is None:
                        files, local = _files(name)
                        files.create_dir(local.rpartition("/")[0], recursive=True)
                        out = files.open_output_stream(local, compression=None)
                    refers = None if pd.isna(r.refers_to) else int(r.refers_to)
                    raw = record(r.page_id, r.url, r.payload, base64.b32encode(r.digest).decode(), refers)
                    out.write(raw)
                    lines.append((r.key, r.page_id, name, at, len(raw)))
                    at += len(raw)
                yield pd.DataFrame(lines, columns=["key", "page_id", "file", "offset", "length"])
        finally:
            if out is not None:
                out.close()

    rows = rows.select("key", "page_id", "url", "payload", "digest", F.col("refers_to").cast("string").alias("refers_to"))
    return cut(rows.mapInPandas(written, "key string, page_id long, file string, offset long, length long"))


def write_index(lines: DataFrame, path: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write sorted blocks and directories; returns one row per index file with its first key."""
    def written(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, at, out, held, directory = f"{path}/index/{uuid.uuid4().hex}.cdx.gz", 0, None, [], []

        def flush():
            nonlocal at
            raw = gzip.compress("\n".join(json.dumps(x) for x in held).encode(), mtime=0)
            out.write(raw)
            directory.append((held[0][0], held[0][1], at, len(raw)))
            at += len(raw)
            held.clear()

        for part in parts:
            for r in part.itertuples(index=False):
                if out is None:
                    files, local = _files(name)
                    files.create_dir(local.rpartition("/")[0], recursive=True)
                    out = files.open_output_stream(local, compression=None)
                held.append((r.key, r.page_id, r.file, r.offset, r.length))
                if len(held) == block_lines:
                    flush()
        if out is None:
            return
        if held:
            flush()
        out.close()
        with files.open_output_stream(f"{local}.dir", compression=None) as d:
            d.write(gzip.compress(json.dumps(directory).encode(), mtime=0))
        yield pd.DataFrame([(directory[0][0], directory[0][1], name)], columns=["key", "page_id", "name"])

    n = max(1, int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = lines.repartitionByRange(n, "key", "page_id").sortWithinPartitions("key", "page_id", "file", "offset")
    return cut(ordered.mapInPandas(written, "key string, page_id long, name string"))


def find(keys: DataFrame, top: DataFrame) -> DataFrame:
    """The index lines of distinct (key, page_id): binary searches, sorted keys, one block at a time."""
    # One row per index file, whatever the number of pages in them.
    files = sorted((r["key"], r["page_id"], r["name"]) for r in top.collect())
    shared = keys.sparkSession.sparkContext.broadcast(files)

    def found(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tops = [(k, p) for k, p, _ in shared.value]
        blocks: dict[tuple[int, int], list] = {}
        directories: dict[int, tuple] = {}

        def block(i: int, j: int) -> list:
            if (i, j) not in blocks:
                while len(blocks) > 3:
                    blocks.pop(next(iter(blocks)))
                files_, local, d, _ = directory(i)
                with files_.open_input_file(local) as f:
                    raw = f.read_at(d[j][3], d[j][2])
                blocks[i, j] = [json.loads(x) for x in gzip.decompress(raw).decode().split("\n")]
            return blocks[i, j]

        def directory(i: int) -> tuple:
            if i not in directories:
                while len(directories) > 3:
                    directories.pop(next(iter(directories)))
                files_, local = _files(shared.value[i][2])
                with files_.open_input_stream(f"{local}.dir", compression=None) as f:
                    d = json.loads(gzip.decompress(f.read()))
                directories[i] = files_, local, d, [(x[0], x[1]) for x in d]
            return directories[i]

        for part in parts:
            out = []
            for want in zip(part["key"], part["page_id"].astype(int), strict=True):
                # Equal keys may begin in the block before the first that starts with them.
                i = max(0, bisect.bisect_left(tops, want) - 1)
                j = max(0, bisect.bisect_left(directory(i)[3], want) - 1) if tops else 0
                while i < len(tops) and tops[i] <= want or i == 0 and tops:
                    if j >= len(directory(i)[2]):
                        i, j = i + 1, 0
                        if i >= len(tops):
                            break
                        continue
                    lines = block(i, j)
                    if (lines[0][0], lines[0][1]) > want:
                        break
                    k = bisect.bisect_left(lines, want, key=lambda x: (x[0], x[1]))
                    while k < len(lines) and (lines[k][0], lines[k][1]) == want:
                        out.append(tuple(lines[k]))
                        k += 1
                    if k < len(lines):
                        break
                    j += 1
            yield pd.DataFrame(out, columns=["key", "page_id", "file", "offset", "length"])

    n = max(1, int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = keys.select("key", "page_id").distinct().repartitionByRange(n, "key", "page_id").sortWithinPartitions("key", "page_id")
    return ordered.mapInPandas(found, "key string, page_id long, file string, offset long, length long")


def read_records(lines: DataFrame) -> DataFrame:
    """page_id, record_type, payload_bytes, payload_digest (by the payload read), refers_to."""
    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, source = None, None
        for part in parts:
            rows = list(zip(part["file"], part["offset"], part["length"], strict=True))
            out, i = [], 0
            while i < len(rows):
                file, start, size = rows[i]
                j, end = i + 1, start + size
                while j < len(rows) and rows[j][0] == file and 0 <= rows[j][1] - end <= GAP and rows[j][1] + rows[j][2] - start <= MOST:
                    end = rows[j][1] + rows[j][2]
                    j += 1
                if file != name:
                    if source is not None:
                        source.close()
                    files, local = _files(file)
                    name, source = file, files.open_input_file(local)
                raw = source.read_at(int(end - start), int(start))
                for _, at, n in rows[i:j]:
                    r = parse(raw[at - start:at - start + n])
                    page = int(r["WARC-Record-ID"][10:-1])
                    if r["WARC-Type"] == "response":
                        out.append((page, "response", len(r["payload"]), base32_sha1(r["payload"]), None))
                    else:
                        out.append((page, "revisit", None, r["WARC-Payload-Digest"][5:], int(r["WARC-Refers-To"][10:-1])))
                i = j
            yield pd.DataFrame({"page_id": [x[0] for x in out], "record_type": [x[1] for x in out],
                                "payload_bytes": pd.array([x[2] for x in out], dtype="Int64"),
                                "payload_digest": [x[3] for x in out],
                                "refers_to": pd.array([x[4] for x in out], dtype="Int64")})
        if source is not None:
            source.close()

    n = max(1, int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = (lines.select("file", "offset", "length").repartitionByRange(n, "file", "offset")
               .sortWithinPartitions("file", "offset"))
    return ordered.mapInPandas(read, "page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long")


def round_trip(spark: SparkSession, pages: DataFrame, path: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Write all pages, find each through the index, read it and resolve the revisits."""
    path = path or scratch_path(spark, "warc")
    top = write_index(write_archives(pages, path, least_bytes), path)
    keys = pages.select(url_key(F.col("url")).alias("key"), F.coalesce("page_id", F.lit(_NO_ID)).alias("page_id"))
    records = cut(read_records(find(keys, top)))
    # A revisit's size is that of the response that it names.
    payloads = (records.where("record_type = 'response'")
                .groupBy(F.col("page_id").alias("_id"), F.col("payload_digest").alias("_digest"))
                .agg(F.first("payload_bytes").alias("_bytes")))
    revisits = records.where("record_type = 'revisit'").join(
        payloads, (F.col("refers_to") == F.col("_id")) & (F.col("payload_digest") == F.col("_digest"))
    ).select("page_id", F.col("_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
    out = records.where("record_type = 'response'").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return out.union(revisits).withColumn("page_id", F.when(F.col("page_id") != _NO_ID, F.col("page_id")))
