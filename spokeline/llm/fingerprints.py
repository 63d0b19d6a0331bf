"""Document fingerprints by locally consistent parsing.

A text is a sequence of bytes. A level collapses runs of a symbol and labels each symbol by
deterministic coin tossing: the lowest bit in which it differs from its left neighbour, and that
bit. Two more tosses leave labels below six, of which no two neighbours agree, so their local
maxima cut the sequence into short phrases by what lies around the cut alone. A phrase's name is a
hash of its symbols' names, and the names are the next level's symbols. Equal substrings thus give
the same names in their interior at every level, wherever they lie.

The fingerprint is the hash of the whole text and the KEPT smallest names from level 2 up (about a
dozen bytes a phrase); likeness is the Jaccard similarity of the name sets that these samples show.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spokeline.llm.words import mix, prefix_sums, segment_hash, slices, utf8

LEVELS = 4
KEPT = 64
#: Texts with fewer names from level 2 up use those of level 1 too.
FEW = 8
PIECE_BYTES = 1 << 19

_symbols = np.random.Generator(np.random.PCG64(5)).integers(1, 2**63, 256, dtype=np.uint64)


def _toss(bits: int) -> np.ndarray:
    """The label of a symbol below 2**bits after its left neighbour, at [left << bits | symbol]."""
    left, right = np.divmod(np.arange(1 << (2 * bits), dtype=np.int64), 1 << bits)
    differ = left ^ right
    lowest = np.bitwise_count((differ & -differ) - 1).astype(np.int64)
    label = 2 * lowest + ((right >> np.minimum(lowest, 62)) & 1)
    return np.where(differ == 0, 0, label).astype(np.uint8)


_TOSS = {bits: _toss(bits) for bits in (8, 7, 4, 3)}


def _again(labels: np.ndarray, begins: np.ndarray, bits: int) -> np.ndarray:
    """Labels from labels; a text's first symbol keeps its lowest bit."""
    key = np.empty(len(labels), dtype=np.uint16)
    key[0] = 0
    key[1:] = (labels[:-1].astype(np.uint16) << bits) | labels[1:]
    out = _TOSS[bits][key]
    out[begins] = labels[begins] & 1
    return out


def _phrases(labels: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where phrases begin: at text starts and at local maxima that aren't a text's last symbol."""
    starts = np.zeros(len(labels), dtype=bool)
    starts[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
    starts[begins] = True
    last = begins[1:] - 1
    starts[last[last > begins[:-1]]] = False
    return np.flatnonzero(starts)


def _level(names: np.ndarray, text: np.ndarray, labels: np.ndarray, begins: np.ndarray, level: int):
    start = _phrases(labels, begins)
    end = np.append(start[1:], len(names))
    sums = prefix_sums(names, 0)
    return mix(segment_hash(sums, start, end, 0) + (end - start).astype(np.uint64) * np.uint64(2 * level + 1)), text[start]


def parse(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each level from 1: names and the text that each belongs to."""
    data, offsets = utf8(column)
    if not len(data):
        return []
    size = np.diff(offsets)
    new = np.ones(len(data), dtype=bool)
    new[1:] = data[1:] != data[:-1]
    new[offsets[:-1][size > 0]] = True
    at = np.flatnonzero(new)
    run = np.diff(np.append(at, len(data)))
    text = np.searchsorted(offsets, at[np.searchsorted(at, offsets[:-1][size > 0])], side="right") - 1
    begins = np.searchsorted(at, offsets[:-1][size > 0])
    text = np.repeat(text.astype(np.int32), np.diff(np.append(begins, len(at))))
    symbol = data[at]
    labels = _again(symbol, begins, 8)
    names = _symbols[symbol] * run.astype(np.uint64)
    out = []
    for level in range(1, LEVELS + 1):
        for bits in (4, 3):
            labels = _again(labels, begins, bits)
        names, text = _level(names, text, labels, begins, level)
        out.append((names, text))
        new = np.ones(len(names), dtype=bool)
        new[1:] = (names[1:] != names[:-1]) | (text[1:] != text[:-1])
        at = np.flatnonzero(new)
        run = np.diff(np.append(at, len(names)))
        names, text = names[at] + (run - 1).astype(np.uint64), text[at]
        begins = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
        differ = names.copy()
        differ[1:] ^= names[:-1]
        lowest = np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1))
        labels = (2 * lowest + ((names >> np.minimum(lowest, 63)) & np.uint64(1))).astype(np.uint8)
        labels[begins] = (names[begins] & np.uint64(1)).astype(np.uint8)
        labels = _again(labels, begins, 7)
    return out


def samples(column: pa.Array) -> list[np.ndarray]:
    """The KEPT smallest names of each text, as ascending 32-bit numbers."""
    n = len(column)
    found = parse(column)
    if not found:
        return [np.zeros(0, dtype=np.uint32)] * n
    names, text = (np.concatenate(x) for x in zip(*found[1:], strict=True))
    few = np.bincount(text, minlength=n) < FEW
    keep = few[found[0][1]]
    names, text = np.concatenate([names, found[0][0][keep]]), np.concatenate([text, found[0][1][keep]])
    short = (names >> np.uint64(32)).astype(np.uint64) | (text.astype(np.uint64) << np.uint64(32))
    short = np.unique(short)
    bounds = np.searchsorted(short, np.arange(n + 1, dtype=np.uint64) << np.uint64(32))
    return [short[a : min(b, a + KEPT)].astype(np.uint32) for a, b in zip(bounds, bounds[1:], strict=False)]


def fingerprints(texts: list[str]) -> list[str]:
    """The whole text's hash, a colon, and the kept names: all hexadecimal."""
    out: list[str] = []
    column = pa.array(texts, pa.large_string())
    _, offsets = utf8(column)
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(offsets, offsets[at] + PIECE_BYTES, side="right")) - 1
        to = min(max(to, at + 1), len(texts))
        for text, names in zip(texts[at:to], samples(column.slice(at, to - at)), strict=True):
            whole = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()
            out.append(f"{whole}:{names.astype('>u4').tobytes().hex()}")
        at = to
    return out


def likeness(a: str, b: str) -> float:
    """Of two fingerprints: 1 for equal texts, else the share of common names among the KEPT
    smallest of both, which estimates the Jaccard similarity (and is it for short texts)."""
    if a == b:
        return 1.0
    one, other = ({x[i : i + 8] for i in range(0, len(x), 8)} for x in (a.split(":")[1], b.split(":")[1]))
    union = sorted(one | other)[:KEPT]
    return sum(x in one and x in other for x in union) / len(union) if union else 0.0


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id, text and fingerprint of every row; null texts count as empty; other columns are dropped.

    Equal texts have equal fingerprints; an empty text has no names. A text is parsed whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = pa.array(fingerprints(batch.column("text").to_pylist()), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "fingerprint"])

    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return docs.mapInArrow(run, "doc_id long, text string, fingerprint string")


def name_sets(docs: DataFrame) -> DataFrame:
    """doc_id, level (from 1) and name: every phrase name of every text once, the whole of what a
    fingerprint samples.

    docs: doc_id, text; other columns are ignored. Rows of one id are one set, null ids one of their
    own. Null and empty texts have no names, and a text that stays one phrase one a level. About a
    name for three bytes of text at level 1, a third of those before at each further level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column("doc_id")
            for level, (names, text) in enumerate(parse(batch.column("text")), 1):
                order = np.lexsort((names, text))
                names, text = names[order], text[order]
                new = np.ones(len(names), dtype=bool)
                new[1:] = (names[1:] != names[:-1]) | (text[1:] != text[:-1])
                columns = [ids.take(pa.array(text[new])), pa.array(np.full(new.sum(), level, dtype=np.int32))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(names[new].view(np.int64))], ["doc_id", "level", "name"])

    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return docs.mapInArrow(run, "doc_id long, level int, name long").distinct()


def exact_likeness(pairs: DataFrame, names: DataFrame, level: int = 2) -> DataFrame:
    """a, b, n_a, n_b, n_common of each pair of ids (a, b), over the name sets from that level up, and
    jaccard and contained: the share of common names among all names and among the smaller set's.

    Exact where the KEPT names of fingerprints estimate: a passage that two long texts have in common
    shows however small a part of them it is. Ids without names have counts and shares of 0; repeated
    pairs count once. Only the names of documents in pairs are joined; texts don't move."""
    pairs = pairs.select(F.col("a").cast("long"), F.col("b").cast("long")).distinct()
    names = names.where(F.col("level") >= level).select(F.col("doc_id").alias("id"), "level", "name")
    sizes = names.groupBy("id").agg(F.count("*").alias("n"))
    for end in ("a", "b"):
        size = sizes.select(F.col("id").alias("of"), F.col("n").alias(f"n_{end}"))
        pairs = pairs.join(size, F.col(end).eqNullSafe(F.col("of")), "left").drop("of")
    first = pairs.select("a", "b").join(names, F.col("a").eqNullSafe(F.col("id"))).drop("id")
    other = names.select("id", F.col("level").alias("l"), F.col("name").alias("m"))
    both = first.join(other, F.col("b").eqNullSafe(F.col("id")) & (F.col("level") == F.col("l")) & (F.col("name") == F.col("m")))
    common = both.groupBy(F.col("a").alias("x"), F.col("b").alias("y")).agg(F.count("*").alias("n_common"))
    found = pairs.join(common, F.col("a").eqNullSafe(F.col("x")) & F.col("b").eqNullSafe(F.col("y")), "left").drop("x", "y")
    found = found.na.fill(0, ["n_a", "n_b", "n_common"])
    union = F.col("n_a") + F.col("n_b") - F.col("n_common")
    share = lambda whole: F.coalesce(F.try_divide(F.col("n_common"), whole), F.lit(0.0))
    return found.select("*", share(union).alias("jaccard"), share(F.least("n_a", "n_b")).alias("contained"))


_ORDER = "coalesce(doc_id, -9223372036854775808)"


def in_descending_runs(docs: DataFrame) -> DataFrame:
    """(run, edge, doc_id, text) such that each run, sorted by edge and then doc_id downwards, is a
    stretch of all documents in descending order, with the first document of the next stretch as its
    edge; the run of the last documents has the very first as edge.

    The stretches are cut at quantiles of doc_id, one per shuffle partition, so no task holds more
    than its share and each text is moved once."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.select(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], 10000)).first()[0] or []
    cuts = sorted(set(cuts))
    above = F.lit(0) if not cuts else F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut > F.expr(_ORDER)))
    rows = docs.withColumn("run", above)
    firsts = {r.run: r.first for r in rows.groupBy("run").agg(F.max(F.expr(_ORDER)).alias("first")).collect()}
    runs = sorted(firsts)
    before = {firsts[run]: runs[i - 1] for i, run in enumerate(runs)}
    rows = rows.withColumn("edge", F.lit(False))
    if not before:
        return rows
    table = F.create_map(*(F.lit(x) for pair in before.items() for x in pair))
    edges = docs.where(F.expr(_ORDER).isin(list(before))).select(
        "doc_id", "text", table[F.expr(_ORDER)].alias("run"), F.lit(True).alias("edge")
    )
    return rows.unionByName(edges)


def _with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of in_descending_runs in order, to the query's columns."""
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    held: list[tuple] = []
    for batch in slices(batches):
        ids, edges, texts = (batch.column(c).to_pylist() for c in ("doc_id", "edge", "text"))
        rows = held + list(zip(ids, edges, texts, fingerprints(texts), strict=True))
        held = rows[-1:]
        pairs = [(x, y) for x, y in zip(rows, rows[1:], strict=False) if not x[1]]
        edited = []
        for (_, _, text, _), (_, _, following, _) in pairs:
            half = len(text) // 2
            edited.append(text[: len(text) - half] + following[:half])
        out = []
        for (x, y), text, own in zip(pairs, edited, fingerprints(edited), strict=True):
            digest = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
            out.append((x[0], len(x[2]), digest, x[3], own, likeness(x[3], own), likeness(x[3], y[3])))
        if out:
            parts = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(parts, columns)


def edited_neighbours(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint against that of its edited text and of the next document.

    docs: doc_id, text; other columns are ignored. Documents go by descending doc_id, equal ids by
    text, null ids last, and the first follows the last. Null texts are empty; an empty text's
    edited text is empty. One row per input row; an empty table gives no rows."""
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = in_descending_runs(docs).repartition("run").sortWithinPartitions("run", "edge", F.desc("doc_id"), "text")
    return rows.select("doc_id", "edge", "text").mapInArrow(
        _with_next,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_neighbours(spark.read.parquet(f"{sf_dir}/documents.parquet"))
