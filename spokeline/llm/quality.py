"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features describe its bytes and words, and those of the lines before
and after it; a weight for each pair of neighbouring labels carries context along the document. The
forward-backward algorithm gives each line's probability of being good, and a document's quality is
their mean weighted by line length, calibrated by a logistic curve. A labelled document stands for a
label on each of its lines in training.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from spokeline.llm.words import SPACE, slices, words

#: Labelled documents that the model is fitted on, and lines of each that it sees, in runs of SEGMENT
#: lines spread evenly over the document. Scoring has no such bound.
FIT_DOCUMENTS = 2000
FIT_LINES = 256
SEGMENT = 32
STEPS = 150
THRESHOLD = 0.7

_LETTER, _UPPER, _DIGIT, _BLANK, _MARK, _STRONG = range(6)
_CLASSES = np.zeros((6, 256), dtype=np.uint8)
_CLASSES[_LETTER, [*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_CLASSES[_UPPER, 65:91] = 1
_CLASSES[_DIGIT, 48:58] = 1
_CLASSES[_BLANK] = SPACE
_CLASSES[_STRONG, list(b"|#$%&*!~^<>=@{}[]\\/_+")] = 1
_CLASSES[_MARK, [i for i in range(33, 127) if not chr(i).isalnum()]] = 1
_ENDS = np.zeros(256, dtype=bool)
_ENDS[list(b".!?:;\"')")] = True
FEATURES = 14


@dataclass
class Lines:
    """Lines of n texts: text t has lines first[t]:first[t + 1]."""

    features: np.ndarray
    length: np.ndarray
    first: np.ndarray


def _sums(flags: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return (total[end] - total[start]).astype(np.float64)


def lines(column: pa.Array) -> Lines:
    """Features of every line; an empty text has one empty line."""
    found = words(column)
    data = found.data
    offsets = np.concatenate([[0], np.cumsum(_byte_lengths(column))])
    breaks = np.flatnonzero(data == 10)
    first = np.searchsorted(breaks, offsets) + np.arange(len(offsets))
    start = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    end = np.sort(np.concatenate([breaks, offsets[1:]]), kind="stable")
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    length = (end - start).astype(np.float64)
    count = np.maximum(length, 1)
    share = [_sums(row[data], start, end) for row in _CLASSES]
    word_first = np.searchsorted(found.start, start)
    word_last = np.searchsorted(found.start, end)
    n_words = np.maximum(word_last - word_first, 1).astype(np.float64)
    hashes = found.hashes()
    line_of = np.repeat(np.arange(len(start)), word_last - word_first)
    again = np.zeros(len(hashes), dtype=bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (line_of[1:] == line_of[:-1])
    order = np.lexsort((hashes, line_of))
    distinct = np.ones(len(hashes), dtype=bool)
    distinct[1:] = (hashes[order][1:] != hashes[order][:-1]) | (line_of[order][1:] != line_of[order][:-1])
    marked = _CLASSES[_MARK][data[found.end - 1]] if len(hashes) else np.zeros(0)
    noisy = _CLASSES[_STRONG][data[found.end - 1]] if len(hashes) else np.zeros(0)
    last = np.zeros(len(start))
    some = length > 0
    last[some] = _ENDS[data[end[some] - 1]]
    features = np.stack(
        [
            np.log1p(length),
            share[_LETTER] / count,
            share[_UPPER] / np.maximum(share[_LETTER], 1),
            share[_DIGIT] / count,
            share[_BLANK] / count,
            share[_MARK] / count,
            share[_STRONG] / count,
            np.log1p(share[_LETTER] / n_words),
            _sums(again, word_first, word_last) / n_words,
            _sums(distinct, word_first, word_last) / n_words,
            _sums(marked, word_first, word_last) / n_words,
            _sums(noisy, word_first, word_last) / n_words,
            last,
            _repeated(hashes, word_first, word_last, text),
        ],
        axis=1,
    )
    return Lines(features, length, first)


def _byte_lengths(column: pa.Array) -> np.ndarray:
    return np.array(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)


def _repeated(hashes: np.ndarray, start: np.ndarray, end: np.ndarray, text: np.ndarray) -> np.ndarray:
    """1 for lines whose words an earlier line of the text has too."""
    total = np.concatenate([[0], np.cumsum(hashes * np.uint64(0x9E3779B97F4A7C15) ^ (hashes >> np.uint64(7)))])
    content = (total[end] - total[start]) + text.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
    order = np.argsort(content, kind="stable")
    out = np.zeros(len(start))
    same = (content[order][1:] == content[order][:-1]) & (text[order][1:] == text[order][:-1])
    out[order[1:][same]] = 1
    return np.where(end > start, out, 0)


def with_neighbours(found: Lines) -> np.ndarray:
    """Each line's features, those of the lines before and after it in its text, and a constant."""
    own = found.features
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    first, last = found.first[:-1], found.first[1:] - 1
    before[first], after[last] = own[first], own[last]
    return np.concatenate([own, before, after, np.ones((len(own), 1))], axis=1)


def marginals(unary: np.ndarray, pair: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per line the probabilities of bad and good, and the expected counts of label pairs.

    All sequences advance together, the longest first, so each step is one array operation."""
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    begin, size = first[:-1][order], size[order]
    longest = int(size[0]) if len(size) else 0
    forward, backward = np.zeros_like(unary), np.zeros_like(unary)
    active = np.searchsorted(-size, -np.arange(1, longest + 1), side="right")  # sequences with a line t
    turns = np.exp(pair - pair.max())
    node = np.exp(unary - unary.max(axis=1, keepdims=True))
    for t in range(longest):
        at = begin[: active[t]] + t
        value = node[at] if t == 0 else (forward[at - 1] @ turns) * node[at]
        forward[at] = value / value.sum(axis=1, keepdims=True)
    for t in range(longest - 1, -1, -1):
        at = begin[: active[t]] + t
        inner = active[t + 1] if t + 1 < longest else 0
        backward[at[inner:]] = 1.0
        if inner:
            value = (backward[at[:inner] + 1] * node[at[:inner] + 1]) @ turns.T
            backward[at[:inner]] = value / value.sum(axis=1, keepdims=True)
    probability = forward * backward
    probability /= probability.sum(axis=1, keepdims=True)
    linked = np.ones(len(unary), dtype=bool)
    linked[first[:-1][np.diff(first) > 0]] = False
    at = np.flatnonzero(linked)
    joint = forward[at - 1][:, :, None] * turns[None] * (backward[at] * node[at])[:, None, :]
    return probability, (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    pair: np.ndarray
    slope: float
    offset: float

    def good(self, found: Lines) -> np.ndarray:
        """The probability of each line of being good."""
        score = ((with_neighbours(found) - self.mean) / self.scale) @ self.weights
        unary = np.stack([np.zeros(len(score)), score], axis=1)
        return marginals(unary, self.pair, found.first)[0][:, 1]

    def quality(self, found: Lines) -> np.ndarray:
        """The length-weighted mean of each text's lines, as log odds."""
        weight = found.length + 1
        starts = found.first[:-1]
        mean = np.add.reduceat(self.good(found) * weight, starts) / np.add.reduceat(weight, starts)
        mean = np.clip(mean, 1e-6, 1 - 1e-6)
        return np.log(mean / (1 - mean))

    def score(self, found: Lines) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.quality(found) + self.offset)))


def _ascend(gradient: Callable, start: np.ndarray, rate: float, steps: int) -> np.ndarray:
    """Adam."""
    x, m, v = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for step in range(1, steps + 1):
        g = gradient(x)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        x += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return x


def fit(texts: list[Lines], labels: np.ndarray) -> Model:
    """A model from labelled texts; without any, one that gives every text 0.5."""
    size = 3 * FEATURES + 1
    if not texts:
        return Model(np.zeros(size), np.ones(size), np.zeros(size), np.zeros((2, 2)), 1.0, 0.0)
    bounds = np.concatenate([[0], np.cumsum([len(x.length) for x in texts])])
    whole = Lines(np.concatenate([x.features for x in texts]), np.concatenate([x.length for x in texts]), bounds)
    inputs = with_neighbours(whole)
    mean, scale = inputs.mean(axis=0), inputs.std(axis=0)
    mean[-1], scale[scale < 1e-6] = 0, 1
    inputs = (inputs - mean) / scale
    truth = np.repeat(labels, np.diff(bounds))
    cuts = [np.arange(a, b, SEGMENT) for a, b in zip(bounds, bounds[1:], strict=False)]
    segments = np.append(np.concatenate(cuts), bounds[-1])
    inner = np.ones(len(truth), dtype=bool)
    inner[segments[:-1]] = False
    seen = np.zeros((2, 2))
    np.add.at(seen, (truth[np.flatnonzero(inner) - 1], truth[inner]), 1)
    n = len(truth)

    def gradient(x: np.ndarray) -> np.ndarray:
        unary = np.stack([np.zeros(n), inputs @ x[:size]], axis=1)
        probability, pairs = marginals(unary, x[size:].reshape(2, 2), segments)
        return np.concatenate([inputs.T @ (truth - probability[:, 1]), (seen - pairs).ravel()]) / n - 1e-3 * x

    x = _ascend(gradient, np.zeros(size + 4), 0.1, STEPS)
    model = Model(mean, scale, x[:size], x[size:].reshape(2, 2), 1.0, 0.0)
    odds = model.quality(whole)

    def calibration(y: np.ndarray) -> np.ndarray:
        miss = labels - 1 / (1 + np.exp(-(y[0] * odds + y[1])))
        return np.array([(miss * odds).mean(), miss.mean()]) - 1e-3 * y

    model.slope, model.offset = (float(v) for v in _ascend(calibration, np.array([1.0, 0.0]), 0.05, 400))
    return model


def _spread_lines(n: int) -> np.ndarray:
    """The lines of a text of n lines that the model is fitted on."""
    if n <= FIT_LINES:
        return np.arange(n)
    runs = FIT_LINES // SEGMENT
    starts = np.arange(runs) * (n - SEGMENT) // (runs - 1)
    return (starts[:, None] + np.arange(SEGMENT)).ravel()


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        found = lines(batch.column("text"))
        rows = []
        for a, b in zip(found.first, found.first[1:], strict=False):
            part = a + _spread_lines(b - a)
            rows.append(np.concatenate([found.features[part], found.length[part, None]], axis=1).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), pa.array(rows, pa.binary())], ["doc_id", "label", "lines"]
        )


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on FIT_DOCUMENTS of the labelled documents, chosen by a hash of doc_id.

    labels: doc_id, label 0 or 1 (the smallest of a document's counts; null ones don't). Of rows that
    share a doc_id one counts, so however often an id repeats the fit stays bounded."""
    known = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.min("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_DOCUMENTS)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")
    rows = rows.mapInArrow(_features, "doc_id long, label int, lines binary")
    found = rows.groupBy("doc_id", "label").agg(F.min("lines").alias("lines")).collect()
    found.sort(key=lambda row: (row.label, bytes(row.lines)))
    texts = []
    for row in found:
        table = np.frombuffer(row.lines).reshape(-1, FEATURES + 1)
        texts.append(Lines(table[:, :-1], table[:, -1], np.array([0, len(table)])))
    return fit(texts, np.array([row.label for row in found]))


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """docs with score double (0 to 1, higher is better); other columns stay.

    docs: text string; a null text is scored as an empty one, which is a single empty line. A column
    called score is replaced."""
    held = docs.drop("score").withColumn("text", F.col("text").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = model.score(lines(batch.column("text")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*batch.schema.names, "score"])

    return held.mapInArrow(run, StructType([*held.schema.fields, StructField("score", DoubleType())]))


def held_out(doc_id: str = "doc_id") -> Column:
    """The documents whose labels are never learnt from; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Model:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    return train(docs, labels.select("doc_id", F.col("quality").cast("int").alias("label")))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = score_quality(docs, quality_model(spark, docs, sf_dir))
    predicted = F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted.alias("predicted"))
