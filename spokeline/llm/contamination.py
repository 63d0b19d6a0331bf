"""Benchmark items inside documents: size-partitioned MinHash containment, verified exactly.

Containment of a short item in a long document is a tiny Jaccard similarity, which MinHash can't
see. So items are partitioned by size, class c holding those of up to 2**c shingles, and for each
class a document is covered by windows of 2 * 2**c shingles that start every 2**c: an item's passage
lies in one of them, and its similarity to that window is at least about a fifth however long the
document is. A window and an item that agree in one of BANDS minima of their class are a candidate
pair, and the exact share of the item's shingles that the whole document holds decides.
"""

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spokeline.llm.components import stored
from spokeline.llm.words import Words, mix, shingle_hashes, slices, words

SHINGLE = 5
CONTAINMENT = 0.8
BANDS = 64
#: Bytes of items that are sent to every task; an item counts with its text and ROW_BYTES.
BLOCK_BYTES = 4 << 20
ROW_BYTES = 16
#: The filter of more items than that takes 2**FILTER_BITS bits (32 MiB) at most.
FILTER_BITS = 28

_salts = np.random.Generator(np.random.PCG64(11)).integers(1, 2**63, BANDS, dtype=np.uint64) | np.uint64(1)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

FOUND = "doc_id long, item_id long, n_shared long, n_shingles long"


def _shingles(column: pa.Array) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words, and shingles with A to Z lower-cased."""
    found = words(column)
    return found, *shingle_hashes(found.first, found.hashes(0, _LOWER[found.data]), SHINGLE)


class Items:
    """A block of items: their shingles, and the items of each minimum by class and band."""

    def __init__(self, ids: list[int], texts: list[str]):
        _, hashes, first = _shingles(pa.array(texts, pa.string()))
        self.ids, self.shingles, self.classes = [], [], defaultdict(list)
        for item, a, b in zip(ids, first, first[1:], strict=False):
            if b > a:
                own = np.unique(hashes[a:b])
                self.classes[_class(own)].append(len(self.ids))
                self.ids.append(item)
                self.shingles.append(own)
        self.minima = {}
        for size, members in self.classes.items():
            bands = []
            for salt in _salts:
                least = np.array([_order(self.shingles[m], salt).min() for m in members])
                order = np.argsort(least)
                bands.append((least[order], np.array(members)[order]))
            self.minima[size] = bands


def _class(own: np.ndarray) -> int:
    return max(2, int(len(own) - 1).bit_length())


def _order(hashes: np.ndarray, salt: np.uint64) -> np.ndarray:
    out = hashes * salt
    return out ^ (out >> np.uint64(31))


def window_minima(hashes: np.ndarray, first: np.ndarray, sizes: list[int]) -> Iterator[tuple]:
    """(size, band, text, minimum) for the windows of each class and band, as arrays over the windows.

    A block of a class is made of whole blocks of the class below, so minima are taken from those."""
    count, begin, step, below = np.diff(first), first, 1, []
    for size in sizes:
        ratio, step = (1 << size) // step, 1 << size
        blocks = -(-count // ratio)
        text = np.repeat(np.arange(len(count)), blocks)
        after = np.concatenate([[0], np.cumsum(blocks)])
        starts = begin[text] + (np.arange(len(text)) - after[text]) * ratio
        below.append((size, text, starts, text[1:] == text[:-1]))
        count, begin = blocks, after
    for band, salt in enumerate(_salts):
        low = _order(hashes, salt)
        for size, text, starts, same in below:
            low = np.minimum.reduceat(low, starts)
            joint = low.copy()  # of a block and the next of the same text
            joint[:-1] = np.where(same, np.minimum(low[:-1], low[1:]), low[:-1])
            yield size, band, text, joint


def candidates(items: Items, hashes: np.ndarray, first: np.ndarray) -> set[tuple[int, int]]:
    """Pairs (text, item) of which a window and the item agree in a band."""
    pairs: set[tuple[int, int]] = set()
    if not len(hashes):
        return pairs
    for size, band, text, joint in window_minima(hashes, first, sorted(items.minima)):
        least, members = items.minima[size][band]
        at = np.minimum(np.searchsorted(least, joint), len(least) - 1)
        hit = np.flatnonzero(least[at] == joint)
        for t, value in zip(text[hit].tolist(), joint[hit], strict=True):
            lo, hi = np.searchsorted(least, value), np.searchsorted(least, value, side="right")
            pairs.update((t, int(m)) for m in members[lo:hi])
    return pairs


def _search(ids: list[int], texts: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(ids, texts)
        for batch in slices(batches):
            _, hashes, first = _shingles(batch.column("text"))
            docs = batch.column("doc_id").to_pylist()
            own: dict[int, np.ndarray] = {}
            out = []
            for t, m in sorted(candidates(items, hashes, first)):
                if t not in own:
                    own[t] = np.unique(hashes[first[t] : first[t + 1]])
                wanted = items.shingles[m]
                at = np.minimum(np.searchsorted(own[t], wanted), len(own[t]) - 1)
                shared = int((own[t][at] == wanted).sum())
                if shared >= CONTAINMENT * len(wanted) - 1e-9:
                    out.append((docs[t], items.ids[m], shared, len(wanted)))
            if out:
                frame = pd.DataFrame(out, columns=["doc_id", "item_id", "n_shared", "n_shingles"], dtype="object")
                yield pa.RecordBatch.from_arrays([pa.array(frame[c], pa.int64()) for c in frame], list(frame))

    return run


def _code(minima: np.ndarray, size: int, band: int) -> np.ndarray:
    """One number for a minimum, its class and its band."""
    return mix(minima ^ mix(np.uint64([size * BANDS + band + 1]))[0])


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each item that has shingles: its class, its shingles and the codes of its minima."""
    for batch in slices(batches):
        _, hashes, first = _shingles(batch.column("text"))
        rows = []
        for row, item, a, b in zip(*(batch.column(c).to_pylist() for c in ("item_row", "item_id")), first, first[1:], strict=False):
            if b > a:
                own = np.unique(hashes[a:b])
                size = _class(own)
                codes = np.concatenate([_code(_order(own, salt).min(keepdims=True), size, n) for n, salt in enumerate(_salts)])
                rows.append((row, item, size, own.view(np.int64), codes.view(np.int64)))
        if rows:
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["item_row", "item_id", "size", "shingles", "codes"])


def _hits(sizes: list[int], known: Broadcast, bits: int) -> Callable:
    """Of each document the minima that the filter knows and, if there are any, such shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = known.value

        def passes(codes: np.ndarray) -> np.ndarray:
            at = codes >> np.uint64(64 - bits)
            return (words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1

        for batch in slices(batches):
            _, hashes, first = _shingles(batch.column("text"))
            if not len(hashes):
                continue
            found = []
            for size, band, text, joint in window_minima(hashes, first, sizes):
                codes = _code(joint, size, band)
                hit = np.flatnonzero(passes(codes))
                found.append((text[hit], codes[hit]))
            text, code = (np.concatenate(x) for x in zip(*found, strict=True))
            held = np.zeros(batch.num_rows, dtype=bool)
            held[text] = True
            owner = np.repeat(np.arange(batch.num_rows), np.diff(first))
            shared = np.flatnonzero(held[owner] & passes(hashes))
            for minimum, text, code in ((True, text, code), (False, owner[shared], hashes[shared])):
                order = np.lexsort((code, text))
                text, code = text[order], code[order]
                new = np.ones(len(text), dtype=bool)
                new[1:] = (text[1:] != text[:-1]) | (code[1:] != code[:-1])
                at = pa.array(text[new])
                columns = [batch.column("doc_row").take(at), batch.column("doc_id").take(at)]
                columns += [pa.array(np.full(len(at), minimum)), pa.array(code[new].view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_row", "doc_id", "minimum", "code"])

    return run


def _by_joins(docs: DataFrame, items: DataFrame) -> DataFrame:
    """contained_items for items of any size: what they have is a table by code, and one pass over the
    documents writes the codes that a filter of all items' codes lets through. The filter has FILTER_BITS
    at most; a fuller one lets more through, and the joins are exact in any case."""
    spark = docs.sparkSession
    items = items.withColumn("item_row", F.monotonically_increasing_id()).select("item_row", "item_id", "text")
    items = stored(items.mapInArrow(_described, "item_row long, item_id long, size int, shingles array<long>, codes array<long>"), "items")
    # One row per class, of which there are as many as a text's length has bits.
    sizes = items.groupBy("size").agg(F.sum(F.size("shingles") + BANDS).alias("n")).collect()
    if not sizes:
        return spark.createDataFrame([], FOUND)
    bits = min(max(16, (16 * sum(r.n for r in sizes)).bit_length()), FILTER_BITS)
    every = items.select(F.explode(F.concat("codes", "shingles")).alias("code"))
    places = every.select(F.shiftrightunsigned("code", 64 - bits).alias("at")).select(F.shiftright("at", 6).alias("word"), F.expr("1L << int(at & 63)").alias("bit"))
    filled = places.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    words = np.zeros(1 << (bits - 6), dtype=np.uint64)
    words[filled["word"].to_numpy()] = filled["bits"].to_numpy().view(np.uint64)
    known = spark.sparkContext.broadcast(words)
    rows = docs.withColumn("doc_row", F.monotonically_increasing_id()).select("doc_row", "doc_id", "text")
    search = _hits(sorted(r.size for r in sizes), known, bits)
    hits = stored(rows.mapInArrow(search, "doc_row long, doc_id long, minimum boolean, code long"), "hits")
    codes = items.select("item_row", F.explode("codes").alias("code"))
    pairs = hits.where("minimum").join(codes, "code").select("doc_row", "doc_id", "item_row").distinct()
    wanted = items.select("item_row", "item_id", F.size("shingles").cast("long").alias("n_shingles"), F.explode("shingles").alias("code"))
    held = hits.where("NOT minimum").select("doc_row", "code")
    shared = pairs.join(wanted, "item_row").join(held, ["doc_row", "code"])
    found = shared.groupBy("doc_row", "doc_id", "item_row", "item_id", "n_shingles").agg(F.count("*").alias("n_shared"))
    found = found.where(F.col("n_shared") >= CONTAINMENT * F.col("n_shingles") - 1e-9)
    return found.select("doc_id", "item_id", "n_shared", "n_shingles").distinct()


def contained_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Items whose shingles a document holds: doc_id, item_id, n_shared, n_shingles.

    docs: doc_id, text; items: item_id, text; other columns are ignored. A row for each pair of
    which the document holds at least CONTAINMENT of the item's distinct 5-word shingles (all words
    of a shorter item are one shingle, found only in a document that is just as short or, as for any
    shingle, holds it whole); A to Z are compared without case. Null and empty texts hold nothing and
    are in nothing. Repeated rows of one id and text give one row; a null id is an id of its own; an
    empty table on either side gives no rows. A text is searched whole by one task, however long.

    Items of BLOCK_BYTES at most, by a count over the table, are sent to every task; more are not
    gathered anywhere but joined. Both ways read the documents once and give the same rows.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    items = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text <> ''").distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + ROW_BYTES), F.lit(0))).first()[0]
    if size > BLOCK_BYTES:
        return _by_joins(docs, items)
    block = items.orderBy("item_id", "text").collect()
    return docs.mapInArrow(_search([r.item_id for r in block], [r.text for r in block]), FOUND).distinct()


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "benchmark"))
    found = contained_items(docs, items)
    return found.withColumn("containment", F.col("n_shared") / F.col("n_shingles"))


ORACLE_SQL = r"""
WITH words AS (
  SELECT kind, id, list_filter(string_split_regex(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
      lambda w: w <> '') AS w
  FROM (SELECT 'doc' AS kind, doc_id AS id, text FROM documents
        UNION ALL SELECT 'item', item_id, text FROM benchmark)
), shingles AS (
  SELECT DISTINCT kind, id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[]
      WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words
), sizes AS (
  SELECT id, count(*) AS n_shingles FROM shingles WHERE kind = 'item' GROUP BY id
)
SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared, n_shingles,
       count(*) / n_shingles AS containment
FROM shingles d JOIN shingles i ON d.kind = 'doc' AND i.kind = 'item' AND d.s = i.s
JOIN sizes z ON z.id = i.id
GROUP BY d.id, i.id, n_shingles HAVING count(*) >= 0.8 * n_shingles - 1e-9
"""
