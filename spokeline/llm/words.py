"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column.

A word is a longest run of bytes other than blank, tab, line feed, vertical tab, form feed and
carriage return, which is the pattern [^\\x20\\x09-\\x0D]+. A null text has no words.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

SLICE_BYTES = 1 << 21
#: A batch that goes to a Python worker ends with the row that takes it beyond this size.
BATCH_BYTES = 1 << 23

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_random = np.random.Generator(np.random.PCG64(20240131))
# Two hash functions, each with a value per byte and an odd base.
_VALUES = _random.integers(1, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = [int(b) * 2 + 1 for b in _random.integers(2**40, 2**62, 2)]
_INVERSES = [pow(b, -1, 2**64) for b in _BASES]
_powers: dict[tuple[int, bool], np.ndarray] = {}


def powers(which: int, n: int, inverse: bool = False) -> np.ndarray:
    """base**0 ... base**(n - 1) modulo 2**64, or those of the base's inverse."""
    known = _powers.get((which, inverse))
    if known is None or len(known) < n:
        base = (_INVERSES if inverse else _BASES)[which]
        kept = n <= 2 * SLICE_BYTES  # tables for a giant text aren't
        # As long as asked for, rounded up, since every Python worker keeps up to four of these tables.
        row = np.full(max(1 << (n - 1).bit_length(), 1 << 12) if kept else n, base, dtype=np.uint64)
        row[0] = 1
        known = np.multiply.accumulate(row)
        if kept:
            _powers[which, inverse] = known
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose every output bit depends on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def segment_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
    """Hashes of [start, end) from prefix sums of value[i] * base**i (one longer than the values).

    Equal contents have equal hashes wherever they lie."""
    back = powers(which, len(prefix), inverse=True)
    return (prefix[end] - prefix[start]) * back[start]


def prefix_sums(values: np.ndarray, which: int) -> np.ndarray:
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(which, len(values)), out=sums[1:])
    return sums


def bound_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Bound the batches of later Python steps by bytes too, as 10,000 rows of long texts are large."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with about size bytes of text; one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = utf8(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins and the last ends; null: empty."""
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    width = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=width)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    if data is None or offsets[0] == offsets[-1]:
        return np.zeros(0, dtype=np.uint8), offsets - offsets[0]
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


@dataclass
class Words:
    """All words of n texts: word i is data[start[i]:end[i]]; text t has words first[t]:first[t+1]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1, dtype=np.int32), self.count)

    def hashes(self, which: int = 0, data: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash of each word (of data's bytes in place of the texts' own)."""
        data = self.data if data is None else data
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        sums = prefix_sums(_VALUES[which][data], which)
        return mix(segment_hash(sums, self.start, self.end, which))


def words(column: pa.Array) -> Words:
    data, offsets = utf8(column)
    inside = ~SPACE[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    # Adjacent texts don't share a word.
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    begins[cuts] = inside[cuts]
    ends[cuts - 1] = inside[cuts - 1]
    start = np.flatnonzero(begins)
    return Words(data, start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets))


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The columns without text, and size: the number of words."""
    for batch in slices(batches):
        rest = [i for i, name in enumerate(batch.schema.names) if name != "text"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in rest), pa.array(words(batch.column("text")).count)],
            [*(batch.schema.names[i] for i in rest), "size"],
        )


def shingle_hashes(first: np.ndarray, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of k words of each text, and the first of each text.

    Text t has the word hashes first[t]:first[t + 1]; one of 1 to k - 1 words has one shingle."""
    count = np.diff(first)
    shingles = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    begin = np.concatenate([[0], np.cumsum(shingles)])
    text = np.repeat(np.arange(len(count)), shingles)
    start = first[text] + np.arange(begin[-1]) - begin[text]
    end = np.minimum(start + k, first[text + 1])
    return mix(segment_hash(prefix_sums(hashes, 1), start, end, 1) + (end - start).astype(np.uint64)), begin
