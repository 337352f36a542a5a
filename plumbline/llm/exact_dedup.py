"""Exact duplicates by an extendible-hash index on shared files.

Every text gives one fixed-width entry: its row, a 64-bit key (XXH64) and its SHA-256. Entries of one key collapse to one
index key, inside each task first, so a group of copies of any size is one row. The directory maps the leading bits of a
key to a bucket: it starts near the depth that the number of keys asks for, and while a bucket holds more keys than its
capacity the directory doubles and the overfull buckets alone are split by their next bit. Buckets are ranges of keys;
the index is dealt by these ranges, so that each owner task writes whole buckets, sorted by key, as Parquet files in the
shared folder. A bucket that no further bit can split chains what it holds.

Keys only say where to look. The texts under every key with more than one entry are read again and compared byte by
byte: the bytes are a grouping key, so copies collapse inside each task before anything is sent. A key under which
different texts stand has a chain, one link a text, and its rows are told apart by their bytes.

All of it is DataFrame functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import fresh, stored

# Keys of repeated texts up to this many (8 bytes each) are broadcast to the scan that compares bytes; where there are
# more, the scan groups all texts instead.
_BROADCAST_KEYS = 1_000_000
# Cells of the directory are this many bits finer than buckets are expected to be.
_FINER = 6


def normal(text: Column) -> Column:
    """Each run of space and the ASCII controls 9-13 as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _key(text: Column, bits: int) -> Column:
    key = F.xxhash64(text)
    return key if bits == 64 else key.bitwiseAND(F.lit(-1 << (64 - bits)))


def entries(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 64) -> DataFrame:
    """doc_id, row (a number of its own), key and SHA-256 of every row."""
    text = normal(F.col(f"`{text_col}`"))
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), _key(text, bits).alias("key"), F.unhex(F.sha2(text, 256)).alias("sha")
    )


def _first(id_and_row: tuple[str, str] = ("doc_id", "row")) -> Column:
    """The entry that stays: smallest doc_id, a null one last; of repeated rows the first."""
    doc, row = id_and_row
    return F.min(F.struct(F.col(doc).isNull().alias("none"), F.col(doc).alias("doc_id"), F.col(row).alias("row")))


def directory(keys: DataFrame, capacity: int) -> tuple[DataFrame, int]:
    """((cell, bucket), bits of a cell) for a frame with one row per ``key``.

    A cell is a range of keys with the same leading bits. A bucket is named by these bits behind a leading one, so the
    name holds its local depth. Every bucket has at most ``capacity`` keys, or cannot be split within a cell's bits."""
    n = keys.count()
    wanted = math.log2(max(1.0, n / capacity))
    bits = min(48, math.ceil(wanted) + _FINER)
    depth = max(0, math.floor(wanted) - 1)
    cell = F.shiftrightunsigned("key", 64 - bits)
    sizes = keys.groupBy(cell.alias("cell")).agg(F.count("*").alias("n"))
    at = stored(sizes.select("cell", "n", (F.shiftright("cell", bits - depth) + F.lit(1 << depth)).alias("bucket")))
    while depth < bits:
        overfull = stored(at.groupBy("bucket").agg(F.sum("n").alias("n")).where(F.col("n") > capacity).select(F.col("bucket").alias("split")))
        if overfull.isEmpty():
            break
        depth += 1
        bit = F.shiftright("cell", bits - depth).bitwiseAND(F.lit(1))
        deeper = F.when(F.col("split").isNotNull(), F.col("bucket") * 2 + bit).otherwise(F.col("bucket"))
        at = stored(at.join(overfull, F.col("bucket") == F.col("split"), "left").select("cell", "n", deeper.alias("bucket")))
    return at.select("cell", "bucket"), bits


def index(found: DataFrame, capacity: int = 1024) -> DataFrame:
    """bucket, key, n (entries) and first (the entry that stays), one row per key of ``entries``; stored in the shared
    folder, where a file holds the whole buckets of one range of keys, sorted."""
    keys = stored(found.groupBy("key").agg(F.count("*").alias("n"), _first().alias("first")))
    cells, bits = directory(keys, capacity)
    placed = keys.join(cells, F.shiftrightunsigned("key", 64 - bits) == F.col("cell")).drop("cell")
    local = F.length(F.bin("bucket")) - 1
    low = F.expr(f"shiftleft(bucket - shiftleft(1L, depth), {bits} - depth)")
    owned = placed.withColumn("depth", local).withColumn("low", low)
    return stored(owned.repartitionByRange("low").sortWithinPartitions("low", "key").select("bucket", "key", "n", "first"))


def chained(docs: DataFrame, repeated: DataFrame, text_col: str = "text", bits: int = 64, most: int = _BROADCAST_KEYS) -> DataFrame:
    """The keys of ``repeated`` under which different texts stand, found by comparing the bytes of all of them."""
    text = normal(F.col(f"`{text_col}`"))
    texts = docs.select(text.alias("bytes")).withColumn("key", _key(F.col("bytes"), bits))
    if repeated.count() <= most:
        texts = texts.join(F.broadcast(repeated.select("key")), "key", "left_semi")
    links = texts.groupBy("key", "bytes").agg(F.count("*").alias("n"))
    return stored(links.groupBy("key").agg(F.count("*").alias("links")).where("links > 1").select("key"))


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, bits: int = 64, most: int = _BROADCAST_KEYS) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 (of the text with each run of white space as one space, in
    UTF-8) for every row.

    Texts are equal if they are identical after that; a null text is empty. Of equal texts the row with the smallest
    doc_id stays, one of them if rows repeat. A null doc_id comes after all others, so keep_id is null only where no
    row of the group has one. An empty table gives no rows; other columns are left out. ``bits`` is the width of the keys:
    a narrow one makes long chains, not other results."""
    found = stored(entries(docs, id_col, text_col, bits))
    repeated = index(found, capacity).where("n > 1").select(F.col("key"), "n", "first")
    chains = chained(docs, repeated, text_col, bits, most)
    rows, named = found, repeated
    parts = []
    if not chains.isEmpty():
        rows, named = found.join(chains, "key", "left_anti"), repeated.join(chains, "key", "left_anti")
        parts = [_links(docs, chains, id_col, text_col, bits)]
    parts.insert(0, rows.join(named, "key", "left").select("doc_id", "row", "sha", "n", "first"))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    alone = F.col("n").isNull()
    return out.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("row") == F.col("first.row"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def _links(docs: DataFrame, chains: DataFrame, id_col: str, text_col: str, bits: int) -> DataFrame:
    """The rows under chained keys, each with its own link of the chain."""
    text = normal(F.col(f"`{text_col}`"))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("bytes")).withColumn("key", _key(F.col("bytes"), bits)).join(chains, "key", "left_semi")
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()).withColumn("sha", F.unhex(F.sha2("bytes", 256))))
    links = stored(rows.groupBy("key", "bytes").agg(F.count("*").alias("n"), _first().alias("first")))
    return rows.join(links, ["key", "bytes"]).select("doc_id", "row", "sha", "n", "first")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the rows that stay, all columns kept. Of repeated rows one stays, and of a group without any doc_id."""
    doc, sha, kept_doc, kept_sha = (fresh(docs, c) for c in ("doc", "sha", "kept_doc", "kept_sha"))
    stays = duplicates(docs, id_col, text_col).where("kept").select(F.col("doc_id").alias(kept_doc), F.col("text_sha256").alias(kept_sha))
    rows = docs.withColumns({doc: F.col(f"`{id_col}`").cast("long"), sha: F.sha2(normal(F.col(f"`{text_col}`")), 256)})
    found = rows.join(stays, F.col(doc).eqNullSafe(F.col(kept_doc)) & (F.col(sha) == F.col(kept_sha)), "left_semi")
    return found.dropDuplicates([doc, sha]).select(*[F.col(f"`{c}`") for c in docs.columns])


def oracle(table: str = "documents") -> str:
    """SQL with the rows of ``duplicates``."""
    return f"""
        WITH texts AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS body FROM {table})
        SELECT doc_id,
               min(doc_id) OVER (PARTITION BY body) AS keep_id,
               count(*) OVER (PARTITION BY body) AS group_size,
               row_number() OVER (PARTITION BY body ORDER BY doc_id NULLS LAST) = 1 AS kept,
               sha256(body) AS text_sha256
        FROM texts"""
