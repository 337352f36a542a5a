"""Document quality by a linear-chain conditional random field over lines.

Every line is labelled good or bad from features of its own and of its neighbours; the chain lets labels persist.
Forward-backward gives each line its probability of being good, the average weighted by line length is the good share of
the document, and a logistic curve turns that share into the probability of quality label 1.

Labels are given for documents, not for lines. Training starts from lines that carry their document's label; lines of bad
documents that the first model finds good are then relabelled (each bad document keeps its worst line) and the model is
trained again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import arrow_map, importable

_SYMBOL, _SPACE, _BREAK, _LOWER, _UPPER, _DIGIT, _MARK, _SHOUT, _BAR = range(9)
_WIDTH = 11
_BLOCK = 1 << 20


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of each code point of the basic plane; what lies beyond counts as a symbol."""
    table = np.zeros(1 << 16, np.int64)
    for i in range(1 << 16):
        c = chr(i)
        if c == "\n":
            table[i] = _BREAK
        elif c.isspace():
            table[i] = _SPACE
        elif c.isalpha():
            table[i] = _UPPER if c.isupper() else _LOWER
        elif c.isdigit():
            table[i] = _DIGIT
        elif c in ".,;:'\"-()?":
            table[i] = _MARK
        elif c == "!":
            table[i] = _SHOUT
        elif c == "|":
            table[i] = _BAR
    return table


_STEPS = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(1, 257)], np.uint64)


def line_features(lines: list[str]) -> np.ndarray:
    """One row of ``_WIDTH`` features for each line."""
    out, start = [], 0
    while start < len(lines):
        end, size = start, 0
        while end < len(lines) and (end == start or size + len(lines[end]) < _BLOCK):
            size += len(lines[end])
            end += 1
        out.append(_block_features(lines[start:end]))
        start = end
    return np.concatenate(out) if out else np.zeros((0, _WIDTH))


def _block_features(lines: list[str]) -> np.ndarray:
    n = len(lines)
    codes = np.frombuffer(("\n".join(lines) + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
    kinds = np.where(codes < 1 << 16, _classes()[codes & 0xFFFF], _SYMBOL)
    breaks = kinds == _BREAK
    at = np.cumsum(breaks) - breaks
    count = np.bincount(at * 9 + kinds, minlength=n * 9).reshape(n, 9)[:n].astype(float)
    solid = ~(breaks | (kinds == _SPACE))
    first = np.flatnonzero(solid & ~np.concatenate(([False], solid[:-1])))
    words = repeats = np.zeros(n)
    if len(first):
        # A word's signature; equal neighbours in a line are repeats.
        word_of = np.cumsum(np.isin(np.arange(len(codes)), first, assume_unique=True))[solid] - 1
        place = np.flatnonzero(solid) - first[word_of]
        mixed = codes[solid].astype(np.uint64) * _STEPS[place & 255]
        marks = np.add.reduceat(mixed, np.searchsorted(word_of, np.arange(len(first))))
        line = at[first]
        words = np.bincount(line, minlength=n).astype(float)
        same = (marks[1:] == marks[:-1]) & (line[1:] == line[:-1])
        repeats = np.bincount(line[1:][same], minlength=n).astype(float)
    chars = count.sum(axis=1) - 1
    full = np.maximum(1, chars - count[:, _SPACE])
    letters = count[:, _LOWER] + count[:, _UPPER]
    each = np.maximum(1, words)
    return np.stack(
        [
            count[:, _SYMBOL] / full,
            count[:, _SHOUT] / full,
            count[:, _BAR] / full,
            count[:, _DIGIT] / full,
            count[:, _MARK] / full,
            count[:, _UPPER] / np.maximum(1, letters),
            repeats / each,
            np.log1p(chars) / 5,
            np.log1p(words) / 5,
            np.minimum(3, full / each / 10),
            chars == 0,
        ],
        axis=1,
    )


def with_neighbours(own: np.ndarray, lengths: list[int]) -> np.ndarray:
    """Constant, own features, those of the line before and behind (zero at the ends of a document)."""
    before, behind = np.zeros_like(own), np.zeros_like(own)
    before[1:], behind[:-1] = own[:-1], own[1:]
    ends = np.cumsum(lengths)
    before[ends - np.asarray(lengths)] = 0
    behind[ends - 1] = 0
    return np.concatenate([np.ones((len(own), 1)), own, before, behind], axis=1)


class Chains:
    """Sequences of lines ordered by position, so that one step of the chain is one slice."""

    def __init__(self, lengths: list[int]):
        lengths = np.asarray(lengths)
        starts = np.cumsum(lengths) - lengths
        ranked = np.argsort(-lengths, kind="stable")
        self.alive = [len(lengths) - int(n) for n in np.searchsorted(np.sort(lengths), np.arange(lengths.max(initial=0)), side="right")]
        self.order = np.concatenate([starts[ranked[:n]] + t for t, n in enumerate(self.alive)]) if self.alive else np.zeros(0, int)
        self.first = np.concatenate(([0], np.cumsum(self.alive)))

    def marginals(self, score: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of good for each line, and the expected number of moves between labels (bad 0, good 1)."""
        s = np.clip(score[self.order], -30, 30)
        emit = np.stack([1 / (1 + np.exp(s)), 1 / (1 + np.exp(-s))], axis=1)
        step = np.exp(move)
        forward, scale, back = np.empty_like(emit), np.empty(len(s)), np.ones_like(emit)
        for t, n in enumerate(self.alive):
            a = self.first[t]
            here = emit[a : a + n] if t == 0 else emit[a : a + n] * (forward[self.first[t - 1] : self.first[t - 1] + n] @ step)
            scale[a : a + n] = here.sum(axis=1)
            forward[a : a + n] = here / scale[a : a + n, None]
        moves = np.zeros((2, 2))
        for t in range(len(self.alive) - 1, 0, -1):
            a, b, n = self.first[t - 1], self.first[t], self.alive[t]
            ahead = emit[b : b + n] * back[b : b + n] / scale[b : b + n, None]
            back[a : a + n] = ahead @ step.T
            moves += step * (forward[a : a + n].T @ ahead)
        good = np.empty(len(s))
        good[self.order] = (forward * back)[:, 1]
        return good, moves


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    move: np.ndarray
    curve: tuple[float, float]

    def shares(self, texts: list[str]) -> np.ndarray:
        """Good share of each text, by length of its lines."""
        lines = [t.split("\n") for t in texts]
        lengths = [len(x) for x in lines]
        flat = [x for doc in lines for x in doc]
        good, _ = Chains(lengths).marginals(with_neighbours(line_features(flat), lengths) @ self.weights, self.move)
        return _shares(good, [len(x) for x in flat], lengths)

    def scores(self, texts: list[str]) -> np.ndarray:
        a, b = self.curve
        return 1 / (1 + np.exp(-np.clip(a * self.shares(texts) + b, -30, 30)))


def _shares(good: np.ndarray, chars: list[int], lengths: list[int]) -> np.ndarray:
    weight = np.maximum(1, np.asarray(chars, float))
    starts = np.cumsum(lengths) - np.asarray(lengths)
    return np.add.reduceat(good * weight, starts) / np.add.reduceat(weight, starts)


def _fit_chain(x: np.ndarray, lengths: list[int], label: np.ndarray, steps: int, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights and moves of greatest likelihood, by gradient steps with running moments."""
    chains = Chains(lengths)
    inside = np.ones(len(label) - 1, bool)
    inside[np.cumsum(lengths)[:-1] - 1] = False
    seen = np.zeros((2, 2))
    np.add.at(seen, (label[:-1][inside].astype(int), label[1:][inside].astype(int)), 1)
    theta = np.zeros(x.shape[1] + 4)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, steps + 1):
        weights, move = theta[:-4], theta[-4:].reshape(2, 2)
        good, moves = chains.marginals(x @ weights, move)
        slope = np.concatenate([x.T @ (label - good), (seen - moves).ravel()]) / len(label) - penalty * theta
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        theta = theta + 0.1 * (mean / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-8)
    return theta[:-4], theta[-4:].reshape(2, 2)


def _fit_curve(share: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Logistic curve of the good share; both classes weigh the same, a small penalty keeps it finite."""
    weight = np.where(label == 1, 0.5 / max(1, (label == 1).sum()), 0.5 / max(1, (label == 0).sum()))
    x = np.stack([share, np.ones_like(share)], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (label - p)) - 1e-4 * w
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
        w = w + np.linalg.solve(bend, slope)
    return float(w[0]), float(w[1])


def held_out(id_column, folds: int = 5):
    """True for the rows that labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(True))


def line_runs(n: int, most: int, run: int = 32) -> list[tuple[int, int]]:
    """(first, end) of the lines that a document of ``n`` lines gives to the fit: all, or if there are more than ``most``
    (one at least) runs of ``run`` lines, spread evenly from its first to its last line."""
    if n <= most:
        return [(0, n)]
    run = min(run, most)
    k = most // run
    return [(a, a + run) for a in ([i * (n - run) // (k - 1) for i in range(k)] if k > 1 else [(n - run) // 2])]


def train(docs: DataFrame, labels: DataFrame, per_class: int = 1500, max_lines: int = 40_000, steps: int = 100, penalty: float = 1e-4, doc_lines: int = 512) -> Model:
    """Model fitted on at most ``per_class`` labelled documents of either quality, those with the smallest hash of their
    doc_id outside the held-out fold. A document of over ``doc_lines`` lines gives evenly spread runs of lines, each a
    sequence of its own. The qualities take turns, and a document that would pass ``max_lines`` lines in all is left out
    and the next ones are tried, so what the driver holds (features of lines, no texts) is bounded.

    Null labels, ids and texts and held-out rows are left out; a document with several labels counts once for each. With
    no labelled documents every text scores one half."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_quality")).where("_id is not null and _quality in (0, 1)")
    chosen = None
    for quality in (0, 1):
        some = known.where((F.col("_quality") == quality) & ~held_out(F.col("_id"))).orderBy(F.xxhash64("_id"), "_id").limit(per_class)
        some = some.withColumn("_turn", F.row_number().over(Window.partitionBy("_quality").orderBy(F.xxhash64("_id"), "_id")))
        chosen = some if chosen is None else chosen.unionByName(some)
    # `chosen` has at most twice `per_class` rows of three numbers.
    texts = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))

    most = min(doc_lines, max_lines)

    def make():
        def work(batch):
            for doc, text, quality, turn in zip(*(batch.column(i).to_pylist() for i in range(4))):
                lines = text.split("\n")
                runs = line_runs(len(lines), most)
                given = [x for a, b in runs for x in lines[a:b]]
                yield doc, quality, turn, len(lines), [b - a for a, b in runs], [len(x) for x in given], line_features(given).astype("<f4").tobytes()

        return work

    rows = arrow_map(texts.select("doc_id", "text", "_quality", "_turn"), make, "doc_id bigint, quality int, turn int, n int, runs array<int>, chars array<int>, features binary")
    kept: list = []
    total = 0
    for r in rows.orderBy("turn", "quality", "doc_id", "n").limit(2 * per_class).toLocalIterator():
        if total + len(r["chars"]) > max_lines:
            continue
        total += len(r["chars"])
        kept.append(r)
    if not kept:
        return Model(np.zeros(1 + 3 * _WIDTH), np.zeros((2, 2)), (0.0, 0.0))
    sizes, lengths = [len(r["chars"]) for r in kept], [n for r in kept for n in r["runs"]]
    own = np.concatenate([np.frombuffer(r["features"], "<f4").reshape(-1, _WIDTH) for r in kept]).astype(float)
    chars = [c for r in kept for c in r["chars"]]
    quality = np.array([r["quality"] for r in kept], float)
    x, label = with_neighbours(own, lengths), np.repeat(quality, sizes)
    weights, move = _fit_chain(x, lengths, label, steps, penalty)
    good, _ = Chains(lengths).marginals(x @ weights, move)
    starts = np.cumsum(sizes) - np.asarray(sizes)
    worst = np.minimum.reduceat(good, starts)
    label = np.where((label == 0) & (good > 0.5) & (good > np.repeat(worst, sizes)), 1.0, label)
    weights, move = _fit_chain(x, lengths, label, steps, penalty)
    good, _ = Chains(lengths).marginals(x @ weights, move)
    return Model(weights, move, _fit_curve(_shares(good, chars, sizes), quality))


def _groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Slices of about a million characters, one text at least."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > _BLOCK:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def scored(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a column ``name``: the probability of quality label 1, from the whole text alone.

    Null and empty texts are one empty line and get the score of that. All rows and columns are kept; an empty table
    stays empty."""
    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                texts = [t or "" for t in part.column(at).to_pylist()]
                scores = np.concatenate([model.scores(texts[a:b]) for a, b in _groups(texts)])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores)], names=schema.names)

    return importable(docs).mapInArrow(run, schema)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted (1 if the score reaches ``threshold``) of every document."""
    model = train(docs, labels)
    rows = scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``docs`` without the rows that the classifier rejects, all columns kept."""
    rows = scored(docs, train(docs, labels), name="_plumbline_score")
    return rows.where(F.col("_plumbline_score") >= threshold).drop("_plumbline_score")
