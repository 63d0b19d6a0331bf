"""Removal of repeated word windows, found by recompression.

A text is a sequence of words. A round replaces runs of one symbol by one name and then pairs of
a left and a right symbol (a coin of the name says which) by another name. Names are hashes of
what they stand for, so all tasks agree on them without a shared dictionary, and equal substrings
get the same names in their interior. Spark then groups names over all documents:

1. Each document gives its high-level phrases (several top symbols, at least a window long) and
   first-round symbols: of each window the one with the smallest name, taken together with the
   words after it, so that nothing outside the window counts. An aggregate finds each name's smallest and largest document.
2. A phrase that a smaller document has too repeats as a whole. Of windows outside such phrases,
   those whose first-round symbol is shared are candidates, and an aggregate of their 128-bit
   contents finds which a smaller document has. All others need no comparison.
3. Words covered by a repeated phrase or window go.

Step 2 is exact: equal windows choose the same first-round symbol, and a window left out in one
document because a phrase covers it is given by the smaller document that has the phrase.
"""

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spokeline.llm.words import Words, mix, prefix_sums, segment_hash, slices, words

WINDOW = 50
ROUNDS = 12
PHRASE = 3
#: Words that name the symbol chosen for a window: enough to tell repeats from common expressions.
CONTEXT = 12

_PAIR = np.uint64(0x9E3779B97F4A7C15)
_RUN = np.uint64(0xD1B54A32D192ED03)
_KEYS = "h1 long, h2 long, doc_id long"


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * _PAIR + right)


def window_symbols(names: np.ndarray) -> np.ndarray:
    """The word whose first-round symbol stands for the window from each word.

    It has the smallest name of the symbols that begin inside the window with CONTEXT words to go;
    of equal names the first. It depends on the window's words only."""
    n = len(names)
    left = (names >> np.uint64(63)).astype(bool)
    pair = np.zeros(n, dtype=bool)
    pair[:-1] = left[:-1] & ~left[1:]
    symbol = names.copy()
    at = np.flatnonzero(pair)
    symbol[at] = _pair(names[at], names[at + 1])
    order = mix(symbol)
    order[1:][pair[:-1]] = np.uint64(2**64 - 1)  # the second word of a pair begins no symbol
    best = np.arange(n, dtype=np.int64)
    size, span = 1, WINDOW - CONTEXT
    while size < span:
        step = min(size, span - size)
        other = best[step:]
        own = best[: len(other)]
        best = np.where(order[other] < order[own], other, own)
        size += step
    return best[1:]


def phrases(found: Words, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word and end of PHRASE neighbouring symbols of the last round (or a whole text)."""
    text, first = found.text_of(), np.arange(len(names), dtype=np.int64)
    for turn in range(ROUNDS):
        if len(names) < 2:
            break
        starts = np.ones(len(names), dtype=bool)
        starts[1:] = (names[1:] != names[:-1]) | (text[1:] != text[:-1])
        at = np.flatnonzero(starts)
        long = np.diff(np.append(at, len(names)))
        names, text, first = names[at], text[at], first[at]
        run = long > 1
        names[run] = mix(names[run] * _RUN + long[run].astype(np.uint64))
        coin = (mix(names + np.uint64(turn)) >> np.uint64(63)).astype(bool)
        pair = np.zeros(len(names), dtype=bool)
        pair[:-1] = coin[:-1] & ~coin[1:] & (text[:-1] == text[1:])
        at = np.flatnonzero(pair)
        names = names.copy()
        names[at] = _pair(names[at], names[at + 1])
        keep = np.ones(len(names), dtype=bool)
        keep[at + 1] = False
        names, text, first = names[keep], text[keep], first[keep]
    n = len(names)
    if not n:
        return text, first, first
    begins = np.searchsorted(text, np.arange(len(found.first)))  # first symbol of each text
    rank = np.arange(n) - begins[text]
    to = np.minimum(np.arange(n) + PHRASE, begins[text + 1])
    whole = (rank == 0) | (to - np.arange(n) == PHRASE)
    end = np.where(to == begins[text + 1], found.first[text + 1], np.append(first, 0)[to])
    keep = whole & (end - first >= WINDOW)
    return text[keep], first[keep], end[keep]


class _Slice:
    """What the steps need of a run of documents, each part computed when it is first used."""

    def __init__(self, column: pa.Array):
        self.words = words(column)

    @cached_property
    def h1(self) -> np.ndarray:
        return self.words.hashes(0)

    @cached_property
    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        return prefix_sums(self.h1, 0), prefix_sums(self.words.hashes(1), 1)

    @cached_property
    def chosen(self) -> np.ndarray:
        return window_symbols(self.h1)

    @cached_property
    def phrases(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return phrases(self.words, self.h1)

    def keys(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        length = (end - start).astype(np.uint64)
        first = segment_hash(self.sums[0], start, end, 0) + length
        return mix(first).view(np.int64), segment_hash(self.sums[1], start, end, 1).view(np.int64)

    def symbols(self, at: np.ndarray) -> np.ndarray:
        """Names of the symbols that begin at the words, with the words after them."""
        return mix(segment_hash(self.sums[0], at, at + CONTEXT, 0)).view(np.int64)

    def windows(self, t: int) -> np.ndarray:
        """First words of the windows of text t."""
        return np.arange(self.words.first[t], max(self.words.first[t], self.words.first[t + 1] - WINDOW + 1))


def _unique(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((h2, h1))
    h1, h2 = h1[order], h2[order]
    new = np.ones(len(h1), dtype=bool)
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    return h1[new], h2[new]


def _rows(h1: list, h2: list, doc_id: list) -> pa.RecordBatch:
    parts = [np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (h1, h2, doc_id)]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in parts], ["h1", "h2", "doc_id"])


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's distinct window symbols (h2 is 0) and phrases."""
    for batch in slices(batches):
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
        s = _Slice(batch.column("text"))
        text = s.words.text_of()
        n = np.maximum(s.words.count - WINDOW + 1, 0)
        start = np.repeat(s.words.first[:-1], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        chosen = np.unique(s.chosen[start])
        name, of = _unique(s.symbols(chosen), text[chosen].astype(np.int64))
        of_phrase, start, end = s.phrases
        h1, h2 = s.keys(start, end)
        yield _rows([name, h1], [np.zeros_like(name), h2], [ids[of], ids[of_phrase]])


def _inside(s: _Slice, t: int, pairs: list) -> list[tuple[int, int]]:
    """Phrases of text t among the pairs of hashes."""
    wanted = {(x["h1"], x["h2"]) for x in pairs or ()}
    if not wanted:
        return []
    text, start, end = s.phrases
    lo, hi = np.searchsorted(text, [t, t + 1])
    start, end = start[lo:hi], end[lo:hi]
    h1, h2 = s.keys(start, end)
    found = [x in wanted for x in zip(h1.tolist(), h2.tolist(), strict=True)]
    return [(int(a), int(b)) for a, b, hit in zip(start, end, found, strict=True) if hit]


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contents of the windows whose symbol is shared and that no repeated phrase covers."""
    for batch in slices(batches):
        batch = batch.filter(pc.fill_null(pc.greater(pc.list_value_length(batch.column("symbols")), 0), False))
        if not batch.num_rows:
            continue
        s = _Slice(batch.column("text"))
        out: tuple[list, list, list] = ([], [], [])
        ids, symbols, repeated = (batch.column(c).to_pylist() for c in ("doc_id", "symbols", "phrases"))
        for t, doc_id in enumerate(ids):
            start = s.windows(t)
            shared = np.isin(s.symbols(s.chosen[start]), np.array(symbols[t], dtype=np.int64))
            for a, b in _inside(s, t, repeated[t]):
                shared[a - s.words.first[t] : b - WINDOW + 1 - s.words.first[t]] = False
            start = start[shared]
            h1, h2 = _unique(*s.keys(start, start + WINDOW))
            for part, x in zip(out, (h1, h2, np.full(len(h1), doc_id)), strict=True):
                part.append(x)
        yield _rows(*out)


def _covered(s: _Slice, t: int, repeated: list, windows: list) -> np.ndarray:
    """Which words of text t the repeated phrases and windows cover."""
    lo, hi = int(s.words.first[t]), int(s.words.first[t + 1])
    change = np.zeros(hi - lo + 1, dtype=np.int64)
    for a, b in _inside(s, t, repeated):
        change[a - lo] += 1
        change[b - lo] -= 1
    if windows:
        wanted = {(x["h1"], x["h2"]) for x in windows}
        start = s.windows(t)
        pairs = zip(*(x.tolist() for x in s.keys(start, start + WINDOW)), strict=True)
        hit = start[[x in wanted for x in pairs]] - lo
        np.add.at(change, hit, 1)
        np.add.at(change, hit + WINDOW, -1)
    return np.cumsum(change)[:-1] > 0


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        all_words = words(batch.column("text"))
        gone = np.zeros(len(all_words.start), dtype=bool)
        listed = np.flatnonzero(
            pc.fill_null(pc.list_value_length(batch.column("phrases")), 0).to_numpy(zero_copy_only=False)
            + pc.fill_null(pc.list_value_length(batch.column("windows")), 0).to_numpy(zero_copy_only=False)
        )
        if len(listed):
            part = batch.take(pa.array(listed))
            s = _Slice(part.column("text"))
            lists = zip(listed, part.column("phrases").to_pylist(), part.column("windows").to_pylist(), strict=True)
            for i, (t, repeated, windows) in enumerate(lists):
                gone[all_words.first[t] : all_words.first[t + 1]] = _covered(s, i, repeated, windows)
        before = np.concatenate([[0], np.cumsum(gone)])[all_words.first]
        text = _joined(all_words, np.flatnonzero(~gone), all_words.first - before)
        counts = pa.array(all_words.count), pa.array(np.diff(before))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), text, *counts], ["doc_id", "text", "n_words", "n_removed"])


def _joined(found: Words, kept: np.ndarray, first: np.ndarray) -> pa.Array:
    """The kept words of each text with a blank between; text t has kept[first[t]:first[t + 1]]."""
    start = found.start[kept]
    size = found.end[kept] - start + 1  # a word and the byte after it, which becomes the blank
    ends = np.cumsum(size)
    place = np.repeat(start - (ends - size), size)
    place += np.arange(len(place))
    data = np.append(found.data, np.uint8(32))[place]
    data[ends - 1] = 32
    # No blank after a text's last word.
    some = np.flatnonzero(np.diff(first))
    keep = np.ones(len(data), dtype=bool)
    keep[ends[first[some + 1] - 1] - 1] = False
    at = np.concatenate([[0], ends])[first] - np.concatenate([[0], np.cumsum(np.diff(first) > 0)])
    offsets = pa.py_buffer(at.astype(np.int32).tobytes())
    return pa.StringArray.from_buffers(len(first) - 1, offsets, pa.py_buffer(data[keep].tobytes()))


def _shared(keys: DataFrame) -> DataFrame:
    """The keys with the smallest and largest document of each, where these differ.

    The aggregate combines within tasks, and the join can be split at a frequent key."""
    spread = keys.groupBy("h1", "h2").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    return keys.join(spread.where("low < high"), ["h1", "h2"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Texts without the words that repeat from documents with a smaller doc_id.

    docs: doc_id long, text string; other columns are ignored. A word goes if a run of WINDOW words
    that covers it also starts in a document with a smaller doc_id; runs are those of the input.
    Returns doc_id, text (the kept words with one blank between), n_words and n_removed, one row per
    input row. Null, empty and short texts lose nothing; a row with a null doc_id neither loses
    words nor takes any from others. Rows that share a doc_id lose no words to each other.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    known = docs.where("doc_id IS NOT NULL")
    pair = F.struct("h1", "h2")
    shared = _shared(known.mapInArrow(_names, _KEYS))
    lists = shared.groupBy("doc_id").agg(
        F.collect_list(F.when(F.col("h2") == 0, F.col("h1"))).alias("symbols"),
        F.collect_list(F.when((F.col("h2") != 0) & (F.col("low") < F.col("doc_id")), pair)).alias("phrases"),
    )
    listed = docs.join(lists, "doc_id", "left")
    windows = (
        _shared(listed.mapInArrow(_candidates, _KEYS))
        .where("low < doc_id")
        .groupBy("doc_id")
        .agg(F.collect_list(pair).alias("windows"))
    )
    return listed.join(windows, "doc_id", "left").mapInArrow(
        _remove, "doc_id long, text string, n_words long, n_removed long"
    )


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
