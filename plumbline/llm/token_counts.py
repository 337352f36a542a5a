"""Token counts by a map-side lookup in two tiers.

A compact table of the frequent pre-tokens and their numbers of tokens is broadcast; pre-tokens that are not in it are
encoded once and kept in a bounded cache of the worker. No pre-token is ever shuffled, and the counts do not depend on
what the table or the cache holds.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import arrow_map, importable, rows_in
from plumbline.llm.tokens import PATTERN, encoder, runs_of_space

COUNTS = "doc_id bigint, n_bytes bigint, n_tokens bigint"
_SINGLE_SPACES = r"'(?:[stmd]|re|ve|ll)| ?(?:\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+)|\s"


def splitters():
    """Pre-tokens of a text by the full pattern, and by the shorter one for texts without runs of white space."""
    import regex

    return regex.compile(PATTERN).findall, regex.compile(_SINGLE_SPACES).findall


def frequent_table(docs: DataFrame, path: str, text_col: str = "text", sample_tasks: int = 8, sample_chars: int = 2_000_000, entries: int = 50_000) -> dict[str, int]:
    """Pre-tokens that occur more than once in some splits, at most ``entries``, with their numbers of tokens. A cache:
    which splits are read changes the speed, never a count.

    The first splits that hold rows are read, ``sample_tasks`` of them; each task counts about ``sample_chars`` characters
    (beyond that it stops reading) and hands its ``entries`` commonest pre-tokens to the driver. Nothing is shuffled."""

    def run(batches):
        import pyarrow as pa

        full, fast = splitters()
        seen: Counter[str] = Counter()
        chars = 0
        for part in rows_in(batches, 16):
            for text in part.column(0).to_pylist():
                for start in range(0, min(len(text), sample_chars - chars), 100_000):
                    piece = text[start : start + 100_000]
                    seen.update((full if runs_of_space(piece) else fast)(piece))
                chars += len(text)
                if chars >= sample_chars:
                    break
            if chars >= sample_chars:
                break
        if seen:
            top = seen.most_common(entries)
            yield pa.RecordBatch.from_arrays([pa.array([[w for w, _ in top]]), pa.array([[n for _, n in top]])], names=["words", "counts"])

    texts = importable(docs).select(F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    total: Counter[str] = Counter()
    for row in texts.mapInArrow(run, "words array<string>, counts array<bigint>").take(sample_tasks):
        total.update(dict(zip(row["words"], row["counts"])))
    bpe = encoder(path)
    return {w: len(bpe.ids(w)) for w, n in total.most_common(entries) if n > 1}


def token_counts(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", cache_entries: int = 300_000, sample_tasks: int = 8, entries: int = 50_000
) -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of every whole text, without added tokens; special strings inside a text are
    handled as the library does by default.

    A null text counts as empty (0 bytes, 0 tokens); null doc_ids and repeated rows are kept; an empty table gives no
    rows; other columns are left out."""
    table = docs.sparkSession.sparkContext.broadcast(frequent_table(docs, path, text_col, sample_tasks, entries=entries))

    def make():
        bpe = encoder(path)
        full, fast = splitters()
        frequent = table.value

        class Lengths(dict):
            """Word to number of tokens: the table first, then what this worker has encoded."""

            def __missing__(self, word):
                n = frequent.get(word)
                if n is None:
                    n = len(bpe.ids(word))
                if len(self) >= cache_entries:
                    self.clear()
                self[word] = n
                return n

        lengths = Lengths()

        def work(batch):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = text or ""
                if bpe.full is None or any(s in text for s in bpe.special):
                    n = len(bpe.ids(text))
                else:
                    n = sum(map(lengths.__getitem__, (full if runs_of_space(text) else fast)(text)))
                yield doc, len(text.encode()), n

        return work

    return arrow_map(docs.select(F.col(id_col).cast("long"), F.col(text_col)), make, COUNTS)


def counted(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """``token_counts`` with ``over_limit``: more than ``limit`` tokens."""
    return token_counts(docs, path).withColumn("over_limit", F.col("n_tokens") > limit)
