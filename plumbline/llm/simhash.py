"""SimHash near-duplicates by vantage-point trees.

Fingerprints within ``radius`` bits agree to ``radius // 2`` bits on one half of their bits. So each half gets a tree of
its own. A level of a tree has a vantage point on a few bits of that half and one branch for each distance from it;
levels use different bits, so the differences of the distances along a path add up to a lower bound of the distance of
two fingerprints (the triangle inequality on every level). A branch is pruned as soon as that sum exceeds what the half
may differ. A leaf is a shard; a fingerprint is a member of one shard of each tree and also visits the shards across a
boundary that the bound leaves open. Within a shard all visiting pairs are compared exactly.

Trees are as deep as the number of different fingerprints asks for. A shard that is still large (many different texts
with almost equal fingerprints) is dealt into tiles; each tile compares two bounded sets. A tile returns only the edges
that join its components, never all of its pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import arrow_map, fresh, importable, rows_in, stored
from plumbline.llm.components import components

_SEED = 42
_HALF = 32


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and 64-bit SimHash (as bigint) of every whole text.

    A-Z is lower-cased; words are runs of anything but space and the ASCII controls 9-13; shingles of ``words`` words,
    repeats included, are joined by one space and hashed by XXH64 with seed 42. A text with fewer words is one shingle;
    one without words (null, empty, blank) has fingerprint 0. A bit is set if it is set in over half of the hashes."""

    def make():
        import xxhash

        digest = xxhash.xxh64_intdigest
        lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

        def work(batch):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield doc, _fingerprint((text or "").encode().translate(lower).split(), words, digest)

        return work

    return arrow_map(docs.select(F.col(id_col).cast("long"), F.col(text_col)), make, "doc_id bigint, fp bigint")


def _fingerprint(parts: list[bytes], words: int, digest, block: int = 1 << 16) -> int:
    """``bytes.split`` splits at space and 9-13, as asked."""
    if not parts:
        return 0
    line = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(parts) > words:
        starts, ends = starts[: len(parts) - words + 1], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    ones = np.zeros(64, np.int64)
    for i in range(0, len(starts), block):
        pairs = zip(starts[i : i + block].tolist(), ends[i : i + block].tolist())
        hashes = np.array([digest(line[a:b], _SEED) for a, b in pairs], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(starts))
    return int(bits.view(">i8")[0])


def hex_of(fp):
    """16 lower-case hex digits of a bigint column."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _shape(count: int, leaf: int) -> tuple[int, int]:
    """(bits of a level, levels of a tree). A level on four bits tells about two bits apart; where four-bit levels
    would leave shards far above ``leaf``, levels look at two bits each."""
    wanted = math.ceil(math.log2(max(2, count / leaf)) / 2)
    return (4, max(1, wanted)) if wanted <= _HALF // 4 else (2, _HALF // 2)


def _vantage(half: int, level: int, width: int) -> int:
    """Vantage point of a level: any fixed bits will do, these are cut from the golden ratio."""
    return (0x9E3779B97F4A7C15 >> (_HALF * half + width * level)) & ((1 << width) - 1)


def visits(fps: DataFrame, width: int, levels: int, allowed: int) -> DataFrame:
    """(half, shard, fp, own) for a column ``fp``: the shard it is a member of, and those across one boundary on the upper
    side (from the lower side the partner visits). ``allowed`` is 0 or 1 bits that a half may differ."""
    if allowed not in (0, 1):
        raise ValueError("a half may differ by 0 or 1 bits here")

    def visit(half, shard, own):
        return F.struct(F.lit(half).alias("half"), shard.alias("shard"), F.lit(own).alias("own"))

    rows = []
    for half in (0, 1):
        distances = []
        for level in range(levels):
            bits = F.shiftrightunsigned("fp", _HALF * half + width * level).bitwiseAND(F.lit((1 << width) - 1))
            distances.append(F.bit_count(bits.bitwiseXOR(F.lit(_vantage(half, level, width)))).cast("long"))
        step = [F.lit((width + 1) ** level) for level in range(levels)]
        shard = sum((d * s for d, s in zip(distances, step)), F.lit(0).cast("long"))
        rows.append(visit(half, shard, True))
        if allowed:
            rows += [F.when(d < width, visit(half, shard + s, False)) for d, s in zip(distances, step)]
    seen = F.filter(F.array(*rows), lambda v: v.isNotNull())
    return fps.select("fp", F.explode(seen).alias("v")).select("v.half", "v.shard", "fp", "v.own")


def links(fps: DataFrame, radius: int = 3, leaf: int = 64, tile: int = 4096) -> DataFrame:
    """Edges (a, b) between different fingerprints within ``radius`` bits, enough to join exactly those that chains of
    such pairs join. ``fps`` has one column ``fp`` without repeats and is read several times: pass a stored frame."""
    if not 0 <= radius <= 3:
        raise ValueError("the radius is from 0 to 3 bits")
    at = visits(fps, *_shape(fps.count(), leaf), radius // 2)
    sizes = at.groupBy("half", "shard").agg(F.count("*").alias("n"))
    big = sizes.where(F.col("n") > tile).select("half", "shard", F.ceil(F.col("n") / (tile // 2)).cast("long").alias("parts"))
    tiled = at.join(big, ["half", "shard"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    part = F.pmod(F.xxhash64("fp"), F.col("parts"))
    others = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda o: F.struct(F.least(part, o).alias("i"), F.greatest(part, o).alias("j")))
    dealt = tiled.select("half", "shard", "fp", "own", part.alias("part"), F.explode(others).alias("t"))
    shuffled = dealt.select("half", "shard", "t.i", "t.j", "part", "fp", "own").repartition("half", "shard", "i", "j").sortWithinPartitions("half", "shard", "i", "j")

    def make():
        rest: list[np.ndarray] = []

        def run(batches):
            for batch in batches:
                key = np.stack([batch.column(k).to_numpy() for k in range(4)])
                rest_rows = (key, *(batch.column(k).to_numpy(zero_copy_only=False) for k in (4, 5, 6)))
                yield from split(rest_rows)
            if rest:
                yield from tile_edges(*_joined(rest))
                rest.clear()

        def split(rows):
            key = rows[0]
            n = key.shape[1]
            if not n:
                return
            cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            bounds = [0, *cuts.tolist(), n]
            for a, b in zip(bounds, bounds[1:]):
                group = tuple(r[..., a:b] for r in rows)
                if rest and (rest[-1][0][:, 0] != group[0][:, 0]).any():
                    yield from tile_edges(*_joined(rest))
                    rest.clear()
                rest.append(group)

        def tile_edges(key, part, fp, own):
            if len(fp) < 2:
                return ()
            return _forest(fp.astype(np.int64).view(np.uint64), own.astype(bool), part if key[2, 0] != key[3, 0] else None, radius)

        return run

    def run(batches):
        out: list[tuple[int, int]] = []
        for pair in make()(batches):
            out.append(pair)
            if len(out) >= 100_000:
                yield _edges(out)
                out = []
        if out:
            yield _edges(out)

    return importable(shuffled).mapInArrow(run, "a bigint, b bigint")


def _joined(parts):
    return tuple(np.concatenate([p[k] for p in parts], axis=-1) for k in range(4))


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _forest(fp: np.ndarray, own: np.ndarray, part: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Edges that join the components of one tile. Pairs of two visitors are left to the shard that one of them owns;
    ``part`` is given if only pairs of different parts belong to the tile."""
    label = np.arange(len(fp))
    signed = fp.view(np.int64)
    edges = []
    members = np.flatnonzero(own)
    block = max(1, (1 << 20) // len(fp))
    for start in range(0, len(members), block):
        rows = members[start : start + block]
        close = np.bitwise_count(fp[rows, None] ^ fp[None, :]) <= radius
        if part is not None:
            close &= part[rows, None] != part[None, :]
        close[np.arange(len(rows)), rows] = False
        for k in np.flatnonzero(close.any(axis=1)).tolist():
            i = int(rows[k])
            near = np.flatnonzero(close[k])
            found, first = np.unique(label[near], return_index=True)
            for old, j in zip(found.tolist(), near[first].tolist()):
                if old != label[i]:
                    label[label == old] = label[i]
                    edges.append((int(signed[i]), int(signed[j])))
    return edges


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (hex) and component_id, the smallest doc_id reachable through links of at most ``radius``
    differing bits, for every row.

    Texts without words have fingerprint 0 and link like any other. Rows with a null doc_id are kept; they belong to a
    component but never name it unless it has no other row (component_id is then null). Repeated rows are all
    returned. An empty table gives no rows; other columns are left out."""
    rows = stored(fingerprints(docs, words, id_col, text_col))
    classes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    joined = components(links(classes.select("fp"), radius))
    named = classes.join(joined, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_fp = named.select("fp", "component").join(least, "component").select("fp", "component_id")
    return rows.join(by_fp, "fp").select("doc_id", hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, words: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that with the component's smallest doc_id. All columns are kept.

    Rows that share a doc_id are told apart by their own text: each stays or goes with its own component, and of those that
    name the same component one stays. Rows with a null doc_id take no part and are kept. An empty table gives no rows."""
    known = docs.where(F.col(f"`{id_col}`").isNotNull())
    marked = stored(near_duplicates(known, words, radius, id_col, text_col))
    own, kept, shared, fp = (fresh(docs, c) for c in ("own", "kept", "shared", "fp"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    several = stored(marked.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias(shared)))
    first = marked.where("doc_id = component_id")
    rows = known.withColumn(own, F.col(f"`{id_col}`").cast("long"))
    alone = rows.join(first.select(F.col("doc_id").alias(kept)), F.col(own) == F.col(kept), "left_semi")
    if several.isEmpty():
        return alone.select(*columns).unionByName(docs.where(F.col(f"`{id_col}`").isNull()))
    alone = alone.join(several, F.col(own) == F.col(shared), "left_anti")
    among = _with_fingerprint(rows.join(several, F.col(own) == F.col(shared), "left_semi"), fp, words, text_col)
    naming = first.select(F.col("doc_id").alias(kept), F.col("fingerprint").alias(shared)).distinct()
    told = among.join(naming, (F.col(own) == F.col(kept)) & (hex_of(F.col(fp)) == F.col(shared)), "left_semi").dropDuplicates([own])
    return alone.select(*columns).unionByName(told.select(*columns)).unionByName(docs.where(F.col(f"`{id_col}`").isNull()))


def _with_fingerprint(docs: DataFrame, name: str, words: int, text_col: str) -> DataFrame:
    """``docs`` with the fingerprint of the text as a last column ``name``."""
    at, schema = docs.columns.index(text_col), T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])

    def run(batches):
        import xxhash

        lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
        for batch in rows_in(batches):
            found = [_fingerprint((t or "").encode().translate(lower).split(), words, xxhash.xxh64_intdigest) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], names=schema.names)

    return importable(docs).mapInArrow(run, schema)
