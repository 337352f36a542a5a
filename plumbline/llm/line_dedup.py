"""Removal of repeated passages by content-defined chunks of lines.

A rolling hash over the hashes of the last lines says where a chunk ends, so a passage is cut alike wherever it stands,
whatever lines were put before it. Chunks of several lines whose hash occurs more than once are fetched and compared
byte by byte; of equal ones the first stays (smallest doc_id, then position) and the others are taken out.

Chunks miss passages whose edges are cut together with foreign lines. So every run of whole lines of over 50 words that
also stands in an earlier document is found as well, exactly: each line starts a shortest run of over 50 words and ends
one, and these depend on nothing outside of them. A repeated run is the union of the shortest runs inside it, so they
alone are compared, by their hashes first and then byte by byte. One long line is a run. Inside one document only chunks are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import arrow_map, fresh, importable, rows_in, stored

_PRIME = 0x9E3779B185EBCA87
_WORD = (1 << 64) - 1
_FIELD = (1 << 127) - 1


def chunks(text: str, window: int, divisor: int, least: int) -> Iterator[tuple[list[str], int]]:
    """(lines, hash) of every chunk of ``text``, in order; the chunks together are the text.

    A chunk ends behind a line where the rolling hash of the last ``window`` lines is divisible by ``divisor``, but not
    before it has ``least`` lines."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    out = pow(_PRIME, window, 1 << 64)
    lines = text.split("\n")
    rolling, past, start = 0, [], 0
    for i, line in enumerate(lines):
        h = digest(line.encode())
        past.append(h)
        rolling = rolling * _PRIME + h
        if i >= window:
            rolling -= past[i - window] * out
        rolling &= _WORD
        if i + 1 - start >= least and (rolling >> 17) % divisor == 0:
            yield lines[start : i + 1], digest("\n".join(lines[start : i + 1]).encode())
            start = i + 1
    if start < len(lines):
        yield lines[start:], digest("\n".join(lines[start:]).encode())


def passages(lines: list[str], over: int) -> Iterator[tuple[int, int, int, int]]:
    """(code, first line, last line, 127-bit hash) of the shortest runs of more than ``over`` words: that from each line
    on (code -1 - 2 * line) and that up to each line (-2 - 2 * line; left out where it is one of the others)."""
    import xxhash

    digest = xxhash.xxh3_128_intdigest
    total, hashes, powers = [0], [0], [1]
    for line in lines:
        total.append(total[-1] + len(line.split()))
        hashes.append((hashes[-1] * _PRIME + digest(line.encode())) % _FIELD)
        powers.append(powers[-1] * _PRIME % _FIELD)
    n = len(lines)
    if total[n] <= over:
        return
    last = [n] * n
    stop = 0
    for i in range(n):
        while stop <= n and total[stop] - total[i] <= over:
            stop += 1
        if stop > n:
            break
        last[i] = stop - 1
        yield -1 - 2 * i, i, stop - 1, (hashes[stop] - hashes[i] * powers[stop - i]) % _FIELD
    start = 0
    for j in range(n):
        if total[j + 1] <= over:
            continue
        while total[j + 1] - total[start + 1] > over:
            start += 1
        if last[start] != j:
            yield -2 - 2 * j, start, j, (hashes[j + 1] - hashes[start] * powers[j + 1 - start]) % _FIELD


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 2, divisor: int = 2, least: int = 2, over: int = 50) -> DataFrame:
    """(doc_id, chunk, hash) of the chunks to be taken out, and of the shortest runs of over ``over`` words that stand in
    an earlier document; for these ``chunk`` is the code of ``passages``. Chunks with fewer than ``least`` lines stay."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null and text is not null")
    shape = (window, divisor, least)

    def hashes():
        def work(batch):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for k, (lines, h) in enumerate(chunks(text, *shape)):
                    if len(lines) >= least:
                        yield doc, k, _signed(h)
                for code, _, _, h in passages(text.split("\n"), over):
                    yield doc, code, _signed(h & _WORD)

        return work

    def contents():
        def work(batch):
            for doc, text, wanted in zip(*(batch.column(i).to_pylist() for i in range(3))):
                wanted = set(wanted)
                for k, (lines, h) in enumerate(chunks(text, *shape)):
                    if k in wanted:
                        yield doc, k, _signed(h), "\n".join(lines)
                if min(wanted) < 0:
                    every = text.split("\n")
                    for code, a, b, h in passages(every, over):
                        if code in wanted:
                            yield doc, code, _signed(h & _WORD), "\n".join(every[a : b + 1])

        return work

    places = stored(arrow_map(texts, hashes, "doc_id bigint, chunk int, hash bigint"))
    # One row for each repeated hash from partial aggregates, so the many copies of a chunk never meet in one task. It is
    # stored, so that its size is known and, where the join is by shuffle, a hot hash can be split.
    repeated = stored(places.groupBy("hash").agg(F.count("*").alias("_n")).where("_n > 1").select("hash"))
    suspects = places.join(repeated, "hash", "left_semi")
    wanted = suspects.groupBy("doc_id").agg(F.collect_set("chunk").alias("wanted"))
    found = stored(arrow_map(texts.join(wanted, "doc_id").select("doc_id", "text", "wanted"), contents, "doc_id bigint, chunk int, hash bigint, content string"))
    # Grouping by the content compares bytes; equal hashes of different contents fall apart here.
    found = found.withColumn("run", F.col("chunk") < 0)
    first = stored(found.groupBy("hash", "content", "run").agg(F.count("*").alias("_n"), F.min(F.struct("doc_id", "chunk")).alias("first")).where("_n > 1"))
    compared = found.join(first.select(F.col("hash").alias("_hash"), F.col("content").alias("_content"), F.col("run").alias("_run"), "first"), (F.col("hash") == F.col("_hash")) & (F.col("content") == F.col("_content")) & (F.col("run") == F.col("_run")))
    elsewhere = F.col("doc_id") != F.col("first.doc_id")
    return compared.where(elsewhere | (~F.col("run") & (F.col("chunk") != F.col("first.chunk")))).select("doc_id", "chunk", "hash").distinct()


def rewritten(docs: DataFrame, taken: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 2, divisor: int = 2, least: int = 2, over: int = 50) -> DataFrame:
    """``docs`` without the chunks in ``taken``: all its rows and columns, then ``n_lines`` and ``removed_lines`` (with
    leading underscores where ``docs`` has columns of these names)."""
    doc, gone = fresh(docs, "doc"), fresh(docs, "drop")
    drop = taken.groupBy("doc_id").agg(F.collect_set(F.struct("chunk", "hash")).alias(gone)).withColumnRenamed("doc_id", doc)
    own = [F.col(f"`{c}`") for c in docs.columns]
    joined = docs.join(drop, F.col(f"`{id_col}`").cast("long") == F.col(doc), "left").select(*own, gone)
    shape, at = (window, divisor, least), docs.columns.index(text_col)
    taken_names = {c.lower() for c in docs.columns}
    counts_of = [fresh(docs, c) if c in taken_names else c for c in ("n_lines", "removed_lines")]
    schema = T.StructType([*docs.schema.fields, *(T.StructField(c, T.LongType()) for c in counts_of)])

    def run(batches):
        for batch in rows_in(batches):
            texts, counts, removed = [], [], []
            for text, drop in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                counts.append(0 if text is None else text.count("\n") + 1)
                text, n = _without(text, drop, shape, over) if text is not None and drop else (text, 0)
                texts.append(text)
                removed.append(n)
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns[at] = pa.array(texts, type=columns[at].type)
            columns += [pa.array(counts, pa.int64()), pa.array(removed, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return importable(joined).mapInArrow(run, schema)


def _without(text: str, drop: list[dict], shape: tuple[int, int, int], over: int) -> tuple[str, int]:
    gone = {(d["chunk"], d["hash"]) for d in drop}
    lines = text.split("\n")
    keep = [True] * len(lines)
    start = 0
    for k, (part, h) in enumerate(chunks(text, *shape)):
        if (k, _signed(h)) in gone:
            keep[start : start + len(part)] = [False] * len(part)
        start += len(part)
    if any(k < 0 for k, _ in gone):
        for code, a, b, h in passages(lines, over):
            if (code, _signed(h & _WORD)) in gone:
                keep[a : b + 1] = [False] * (b + 1 - a)
    kept = [x for x, k in zip(lines, keep) if k]
    return "\n".join(kept), len(lines) - len(kept)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 2, divisor: int = 2, least: int = 2, over: int = 50) -> DataFrame:
    """doc_id, text without repeated chunks and runs, n_lines and removed_lines (of the whole text) for every row.

    A text whose every chunk is taken out becomes empty. Null texts stay null with 0 lines; an empty text has one line.
    Rows with a null doc_id take no part and stay as they are; rows that share a doc_id count as one document. An empty
    table gives no rows; other columns are left out."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rewritten(texts, removals(texts, "doc_id", "text", window, divisor, least, over), "doc_id", "text", window, divisor, least, over)


def cleaned(docs: DataFrame) -> DataFrame:
    """``docs`` with the texts of ``deduplicated``; ``n_chars``, if there, follows. All rows and columns are kept."""
    out = rewritten(docs, removals(docs)).select(*[F.col(f"`{c}`") for c in docs.columns])
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
