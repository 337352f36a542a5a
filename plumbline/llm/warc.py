"""WARC archives: a writer that dedups payloads into revisit records, and a splittable reader.

Each record is a gzip member of its own. The reader deals byte ranges of the archives to tasks: a task looks for gzip
magic in its range, takes a candidate for a member if it decodes to a WARC header, and owns the records that start in
the range, reading on past its end for the last one. So one archive of any size is read by many tasks.

Archives live in the shared folder and are opened through ``pyarrow.fs`` by URI, as tasks on other machines need it.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.common import arrow_map, importable, scratch, stored

_MAGIC = b"\x1f\x8b\x08"
_END = b"\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORDS = "file string, offset bigint, record_type string, uri string, payload_digest string, payload_bytes bigint, refers_to string, headers map<string,string>, payload binary"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def open_folder(uri: str):
    """(file system, path) of a folder URI or local path."""
    from pyarrow import fs

    if "://" in uri or uri.startswith("file:"):
        # Spark also writes file:/path with one slash
        return fs.FileSystem.from_uri("file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri)
    return fs.LocalFileSystem(), uri


def choose(pages: DataFrame, key: str, min_revisit_bytes: int = 0) -> DataFrame:
    """``pages`` (with a binary column ``payload``) and two columns: ``revisit`` and ``original``, the ``key`` of the
    response record that a revisit points to.

    Of rows with equal payloads of at least ``min_revisit_bytes`` the one with the smallest key is the response; rows
    that repeat that key, too, revisit it. A null key counts as larger than any other."""
    sha = F.sha2("payload", 256)
    if min_revisit_bytes:
        sha = F.when(F.octet_length("payload") >= min_revisit_bytes, sha)
    marked = pages.withColumn("_sha", sha)
    # Only digests and keys are shuffled, a row for each repeated payload is kept, and partial aggregates come first: a
    # page with very many copies is no bottleneck. The result is stored, so that its size is known before the join.
    keyed = marked.where("_sha is not null").groupBy("_sha", F.col(key).alias("_key")).agg(F.count("*").alias("_n"))
    first = F.min(F.struct(F.col("_key").isNull().alias("no"), F.col("_key").alias("key"), F.col("_n").alias("rows")))
    repeated = keyed.groupBy(F.col("_sha").alias("_same")).agg(F.sum("_n").alias("_all"), first.alias("_first")).where("_all > 1")
    repeated = stored(repeated.select("_same", "_first"))
    joined = marked.join(repeated, F.col("_sha") == F.col("_same"), "left")
    smallest = F.col(f"`{key}`").eqNullSafe(F.col("_first.key"))
    own = [F.col(f"`{c}`") for c in pages.columns]

    def out(rows: DataFrame, revisit) -> DataFrame:
        return rows.select(*own, revisit.alias("revisit"), F.when(revisit, F.col("_first.key")).alias("original"))

    chosen = out(joined, F.col("_same").isNotNull() & ~smallest)
    if repeated.where("_first.rows > 1").isEmpty():
        return chosen
    # Rows that repeat the smallest key of their payload: one of them is the response.
    tied = F.coalesce(smallest & (F.col("_first.rows") > 1), F.lit(False))
    place = F.row_number().over(Window.partitionBy("_sha").orderBy(*[F.col(f"`{c}`") for c in pages.columns if c != "payload"]))
    rest = joined.where(~tied)
    return out(rest, F.col("_same").isNotNull() & ~smallest).unionByName(out(joined.where(tied).withColumn("_place", place), F.col("_place") > 1))


def record(kind: str, name: str, uri: str, payload: bytes, refers_to: str | None, extra: dict[str, str]) -> bytes:
    """One gzip member with a response, or with a revisit that holds the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    fields = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<{name}>",
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Target-URI": uri,
        "WARC-Payload-Digest": f"sha1:{base32_sha1(payload)}",
        "WARC-Block-Digest": f"sha1:{base32_sha1(block)}",
        "Content-Type": "application/http; msgtype=response",
        **extra,
    }
    if kind == "revisit":
        fields |= {"WARC-Profile": _PROFILE} | ({"WARC-Refers-To": f"<{refers_to}>"} if refers_to else {})
    fields["Content-Length"] = str(len(block))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode()) + packer.compress(block) + packer.compress(_END) + packer.flush()


def write(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit_bytes: int = 0) -> DataFrame:
    """Writes one record per row to archives in ``folder`` (a new one by default) and returns (path, bytes, records).

    The payload is the html in UTF-8 (null: empty). A null url becomes ``about:blank``; control characters in a url are
    escaped. The id is kept in ``X-Page-Id`` (missing if null). A task writes its archive under a name of its own and
    reports it only when it is complete, so archives of tasks that were lost or run twice are never read. An empty
    table gives no archive."""
    spark = pages.sparkSession
    folder = folder or scratch(spark)
    payload = F.coalesce(F.encode(F.col(html_col), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(folder)
        files.create_dir(root, recursive=True)
        name, stream, size, count = f"{uuid.uuid4().hex}.warc.gz", None, 0, 0
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                for row in batch.slice(start, 256).to_pylist():
                    if stream is None:
                        stream = files.open_output_stream(f"{root}/{name}", compression=None)
                    extra = {} if row["id"] is None else {"X-Page-Id": str(row["id"])}
                    target = None if row["original"] is None else f"urn:page:{row['original']}"
                    own = f"urn:page:{row['id']}" if not row["revisit"] and row["id"] is not None else f"urn:uuid:{uuid.uuid4()}"
                    uri = quote(row["url"] or "about:blank", safe="%/:=&?~#+!$,;'@()*[]")
                    member = record("revisit" if row["revisit"] else "response", own, uri, row["payload"], target, extra)
                    stream.write(member)
                    size += len(member)
                    count += 1
        if stream is not None:
            stream.close()
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([size], pa.int64()), pa.array([count], pa.int64())], names=["path", "bytes", "records"])

    written = importable(choose(rows, "id", min_revisit_bytes)).mapInArrow(run, "path string, bytes bigint, records bigint")
    listing = scratch(spark)
    written.write.parquet(listing)  # the only run of the writer; what reads the listing never writes again
    return spark.read.schema(written.schema).parquet(listing)


def members(data: bytes, own: int, size_left: bool) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of the WARC members that start in the first ``own`` bytes of ``data``.

    A candidate counts if it decodes to a WARC header and to a whole member, and if the data ends or another candidate
    begins behind it. Inside a member nothing else can start, so the search goes on behind it. Raises EOFError if a
    member goes on past ``data`` while ``size_left`` says that there is more to read."""
    at = data.find(_MAGIC, 0, own + 2)
    while 0 <= at < own:
        unpacker = zlib.decompressobj(31)
        content, good = b"", False
        try:
            content = unpacker.decompress(data[at : at + 1024], 16)
            if content[:5] == b"WARC/"[: len(content)]:
                unpacker = zlib.decompressobj(31)
                content = unpacker.decompress(memoryview(data)[at:])
                if not unpacker.eof and size_left:
                    raise EOFError
                good = unpacker.eof and content.startswith(b"WARC/") and unpacker.unused_data[:2] in (b"", _MAGIC[:1], _MAGIC[:2])
        except zlib.error:
            good = False
        if good:
            yield at, content
            at = data.find(_MAGIC, len(data) - len(unpacker.unused_data), own + 2)
        else:
            at = data.find(_MAGIC, at + 1, own + 2)


def parse(content: bytes) -> tuple[dict[str, str], bytes]:
    """WARC header fields (names in lower case) and the block."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        k, _, v = line.partition(":")
        fields[k.strip().lower()] = v.strip()
    length = int(fields.get("content-length") or 0)
    return fields, rest[:length]


def read(spark: SparkSession, archives: DataFrame, split_bytes: int = 4 << 20, read_ahead: int = 1 << 20, tasks: int | None = None) -> DataFrame:
    """Records of the listed archives (path, bytes): file, offset, record_type, uri, payload_digest (bare base32 SHA-1),
    payload_bytes, refers_to, headers and payload. Other members and damaged ones are passed over.

    A revisit has no payload; its digest and length are those of the payload it stands for."""
    ranges = archives.select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))).alias("start"))

    def make():
        def work(batch):
            for row in batch.to_pylist():
                files, path = open_folder(row["path"])
                with files.open_input_file(path) as f:
                    yield from owned(f, row)

        def owned(f, row):
            start, own = row["start"], min(split_bytes, row["bytes"] - row["start"])
            f.seek(start)
            data = f.read(own + max(read_ahead, 64))
            base = 0
            while own > 0:
                more, done = start + base + len(data) < row["bytes"], 0
                try:
                    for at, content in members(data, own, more):
                        yield entry(row["path"], start + base + at, content)
                        done = at + 1
                    return
                except EOFError:
                    # The last member goes on: keep what follows the members already taken and read further.
                    base, own = base + done, own - done
                    f.seek(start + base)
                    data = f.read(2 * max(len(data), read_ahead))

        def entry(path, offset, content):
            fields, block = parse(content)
            http, _, payload = block.partition(b"\r\n\r\n")
            kind = fields.get("warc-type", "")
            length, digest = len(payload), fields.get("warc-payload-digest", "").removeprefix("sha1:")
            if kind == "revisit":
                lengths = [x.partition(b":")[2] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
                length, payload = int(lengths[0]) if lengths else None, None
            elif kind == "response":
                digest = base32_sha1(payload)
            refers = fields.get("warc-refers-to", "").strip("<>") or None
            return path, offset, kind, fields.get("warc-target-uri"), digest, length, refers, list(fields.items()), payload

        return work

    # Rows of ranges are few bytes, so adaptive execution would read them all in one task; a number of partitions of
    # about one range each, dealt by hash, spreads even one large archive over the cluster.
    if tasks is None:
        tasks = int(archives.agg(F.sum(F.ceil(F.col("bytes") / split_bytes)).alias("n")).head()["n"] or 1)
    return arrow_map(ranges.repartition(tasks, "path", "start"), make, RECORDS)


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` to archives and reads them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    records = read(pages.sparkSession, write(pages))
    page = F.col("headers")["x-page-id"].cast("long")
    refers = F.regexp_extract("refers_to", "^urn:page:(-?[0-9]+)$", 1)
    return records.select(
        page.alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.when(refers != "", refers.cast("long")).alias("refers_to")
    )
