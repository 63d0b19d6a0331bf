"""Alignment of two tokenizers' tokens, and how often ids are linked corpus-wide.

Both tokenizers spell out the same bytes, so their tokens are cut into groups wherever a token of each
ends at the same byte. Per text two dictionaries lead from the cumulative ends to the tokens' numbers;
the keys in both, sorted, slice the two id lists, and a slice links each of its A tokens with each of its
B tokens.

Counting the documents that link a pair of ids, and handing the counts back to the documents, moves
links only in packed form: tasks write the distinct links of a slice of documents as arrays, in PARTS
parts by the pair. Counts are added up per pair; then each part of the pairs meets the slices' arrays of
the same part, dealt out by slices too, and what comes back is a sum per document.
"""

import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spokeline.llm.components import stored
from spokeline.llm.tokenizer import PATTERN
from spokeline.llm.words import bound_batches, slices

BYTES_A = "/opt/tokenizers/byte_bpe_50k.json"
PIECES_B = "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of a text whose ends are in the dictionaries at once.
WINDOW = 1 << 18
#: Bytes of the documents whose tokens are held at once.
SLICE = 1 << 20
#: Links that are expanded at once.
LINKS = 1 << 21
#: Parts of the pairs; a prime, so that they are even whatever the sizes of the vocabularies.
PARTS = 31
#: Slices of documents that one task looks up in a part of the pairs.
SLICES = 256
#: Pairs that a task collects before it adds them up.
COUNTED = 1 << 22

_built: dict[int, "Tokenizers"] = {}


class Tokenizers:
    """Both tokenizers, of each id its bytes and their number, and what separated ids are written as."""

    def __init__(self, bytes_a: bytes, pieces_b: bytes):
        known = json.loads(bytes_a)
        special = {token["content"] for token in known["added_tokens"]}
        letters = _byte_letters()
        ranks = {
            bytes(letters[c] for c in token): i for token, i in known["model"]["vocab"].items() if token not in special
        }
        self.encoding_a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes_a[i] = token
        self.pieces_b = sentencepiece.SentencePieceProcessor(model_proto=pieces_b)
        ids = range(self.pieces_b.vocab_size())
        names = [self.pieces_b.id_to_piece(i) for i in ids]
        self.bytes_b = [
            bytes([int(name[3:5], 16)]) if self.pieces_b.is_byte(i) else name.replace("▁", " ").encode()
            for i, name in zip(ids, names, strict=True)
        ]
        self.length_a, self.length_b = (np.array([len(x) for x in t]) for t in (self.bytes_a, self.bytes_b))
        largest = max(len(self.bytes_a), len(self.bytes_b))
        self.names = [f"{i}{mark}" for mark in ",|;" for i in range(largest)]

    def encode(self, texts: list[str | None]) -> Iterator[tuple[list[int], list[int]]]:
        """The ids of space + text by A and of text, to which it adds the space, by B; none if these
        don't spell the same bytes, and of null and empty texts."""
        by_b = self.pieces_b.encode([text or "" for text in texts], num_threads=1)
        for text, b in zip(texts, by_b, strict=True):
            if text:
                spaced = " " + text
                a, own = self.encoding_a.encode_ordinary(spaced), spaced.encode()
                if b"".join([self.bytes_a[i] for i in a]) == own == b"".join([self.bytes_b[i] for i in b]):
                    yield a, b
                    continue
            yield [], []


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it is visible in
    Latin-1, and the others from U+0100 on in their order."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + n): b for n, b in enumerate(others)}


def tokenizers(spark: SparkSession, path_a: str = BYTES_A, path_b: str = PIECES_B) -> Callable[[], Tokenizers]:
    """A function for tasks that gives the tokenizers; each Python worker builds them once.

    The files are read here and broadcast (two megabytes, as vocabularies are fixed)."""
    data = []
    for path in (path_a, path_b):
        with open(path, "rb") as file:
            data.append(file.read())
    held = spark.sparkContext.broadcast(tuple(data))

    def build() -> Tokenizers:
        key = hash(held.value)
        if key not in _built:
            _built[key] = Tokenizers(*held.value)
        return _built[key]

    return build


def group_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[list[int], list[int]]:
    """How many A tokens, and how many B tokens, have ended where each group ends.

    The ends are cumulative numbers of bytes; dictionaries hold those of a WINDOW of the text."""
    cuts_a: list[int] = []
    cuts_b: list[int] = []
    last = int(ends_a[-1]) if len(ends_a) else 0
    for low in range(0, last, WINDOW):
        ia, ja = np.searchsorted(ends_a, [low, low + WINDOW], side="right").tolist()
        ib, jb = np.searchsorted(ends_b, [low, low + WINDOW], side="right").tolist()
        at_a = dict(zip(ends_a[ia:ja].tolist(), range(ia + 1, ja + 1), strict=True))
        at_b = dict(zip(ends_b[ib:jb].tolist(), range(ib + 1, jb + 1), strict=True))
        # The ends went in upwards, so the common keys come out sorted.
        cuts_a += [i for end, i in at_a.items() if end in at_b]
        cuts_b += [i for end, i in at_b.items() if end in at_a]
    return cuts_a, cuts_b


@dataclass
class Aligned:
    """The tokens of a slice of texts in a row, and for each group where its tokens begin and how many
    they are. Text t has groups first[t]:first[t + 1]; tokens has its ids and how many of each have ended
    at the end of each group."""

    a: np.ndarray
    b: np.ndarray
    start_a: np.ndarray
    start_b: np.ndarray
    size_a: np.ndarray
    size_b: np.ndarray
    first: np.ndarray
    tokens: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    @property
    def links(self) -> np.ndarray:
        """Of each text."""
        total = np.concatenate([[0], np.cumsum(self.size_a * self.size_b)])
        return total[self.first[1:]] - total[self.first[:-1]]


def align(models: Tokenizers, texts: list[str | None]) -> Aligned:
    # Arrays only, as the garbage collector would go through lists of numbers again and again.
    tokens = []
    for ids in models.encode(texts):
        a, b = (np.array(x, dtype=np.int64) for x in ids)
        cuts = group_ends(np.cumsum(models.length_a[a]), np.cumsum(models.length_b[b]))
        tokens.append((a, b, *(np.array(x, dtype=np.int64) for x in cuts)))
    a, b, ends_a, ends_b = (np.concatenate([x[k] for x in tokens] or [[]]).astype(np.int64) for k in range(4))
    before_a, before_b, first = (np.concatenate([[0], np.cumsum([len(x[k]) for x in tokens])]).astype(np.int64) for k in range(3))
    text = np.repeat(np.arange(len(tokens)), np.diff(first))
    ends_a, ends_b = ends_a + before_a[text], ends_b + before_b[text]
    start_a, start_b = (np.concatenate([[0], x[:-1]])[: len(x)] for x in (ends_a, ends_b))
    return Aligned(a, b, start_a, start_b, ends_a - start_a, ends_b - start_b, first, tokens)


def written_groups(names: list[str], found: Aligned) -> list[str]:
    """a1,a2|b1;a3|b2,b3 for the groups of each text; names: Tokenizers.names."""
    kinds = len(names) // 3
    both, at = found.size_a + found.size_b, 0
    ends = np.cumsum(both)
    marked = np.empty(len(found.a) + len(found.b), dtype=np.int64)
    marked[_ragged(ends - both, found.size_a)] = found.a
    marked[_ragged(ends - found.size_b, found.size_b)] = found.b
    marked[ends - found.size_b - 1] += kinds
    marked[ends - 1] += 2 * kinds
    out = []
    for to in np.concatenate([[0], ends])[found.first[1:]].tolist():
        out.append("".join(map(names.__getitem__, marked[at:to].tolist()))[:-1])
        at = to
    return out


def _ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] of them), start[1], ..."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, in order, with the sum of its n."""
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    lead = np.flatnonzero(np.diff(key, prepend=-1))
    return key[lead], np.add.reduceat(n, lead) if len(lead) else n


def distinct_links(found: Aligned, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """text, pair (a * width + b) and how often, for the distinct links of each text.

    The slices are expanded LINKS links at a time; a wider one a row of A tokens at a time."""
    text = found.text
    spread = np.int64(len(found.first))  # more than the largest text's number
    held: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = 0
    for group, row, rows in _portions(found.size_a, found.size_b):
        size = found.size_b[group] * rows
        ends = np.cumsum(size)
        off = np.arange(ends[-1]) - np.repeat(ends - size, size)
        group, row = np.repeat(group, size), np.repeat(row, size)
        a = found.a[found.start_a[group] + row + off // found.size_b[group]]
        b = found.b[found.start_b[group] + off % found.size_b[group]]
        key = np.sort((a * width + b) * spread + text[group])
        lead = np.flatnonzero(np.diff(key, prepend=-1))
        held.append((key[lead], np.diff(lead, append=len(key))))
        waiting += len(held[-1][0])
        if waiting > 4 * LINKS:
            held = [_summed(*map(np.concatenate, zip(*held, strict=True)))]
            waiting = 0
    if not held:
        return (np.zeros(0, dtype=np.int64),) * 3
    key, n = _summed(*map(np.concatenate, zip(*held, strict=True))) if len(held) > 1 else held[0]
    return key % spread, key // spread, n


def _portions(size_a: np.ndarray, size_b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """All groups in runs of about LINKS links: group, its first A token and how many A tokens."""
    total = np.cumsum(size_a * size_b)
    at = 0
    while at < len(total):
        done = int(total[at - 1]) if at else 0
        to = int(np.searchsorted(total, done + LINKS, side="right"))
        if to > at:
            group = np.arange(at, to)
            yield group, np.zeros(to - at, dtype=np.int64), size_a[at:to]
            at = to
            continue
        step = max(int(LINKS // size_b[at]), 1)
        for row in range(0, int(size_a[at]), step):
            yield np.array([at]), np.array([row]), np.array([min(step, int(size_a[at]) - row)])
        at += 1


_PACKED = (
    "slice long, part int, keys binary, counts binary, texts binary, times binary, "
    "number int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
)


def _narrow(values: np.ndarray) -> bytes:
    """Little-endian integers of the least width; what reads them knows how many they are."""
    return values.astype(f"<u{min(w for w in (1, 2, 4, 8) if not len(values) or int(values.max()) < 1 << 8 * w)}").tobytes()


def _wide(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, dtype=f"<u{len(data) // max(n, 1) or 1}").astype(np.int64)


def _pack(build: Callable, schema: pa.Schema) -> Callable:
    """One row per document with its digest, and one per slice and part with its distinct links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = build()
        width = len(models.bytes_b)
        number = TaskContext.get().partitionId() << 32
        for batch in slices(batches, size=SLICE):
            found = align(models, batch.column("text").to_pylist())
            written = written_groups(models.names, found)
            digests = [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in written]
            own = {
                "slice": [number] * batch.num_rows,
                "number": range(batch.num_rows),
                "doc_id": batch.column("doc_id"),
                "n_a": [len(x[0]) for x in found.tokens],
                "n_b": [len(x[1]) for x in found.tokens],
                "n_groups": np.diff(found.first),
                "n_links": found.links,
                "groups_sha256": digests,
            }
            yield _filled(own, batch.num_rows, schema)
            text, pair, times = distinct_links(found, width)
            part = (pair % PARTS).astype(np.uint8)
            order = np.argsort(part, kind="stable")  # in a part by pair and text, as before
            cuts = np.concatenate([[0], np.cumsum(np.bincount(part, minlength=PARTS))]).tolist()
            rows: dict[str, list] = {x: [] for x in ("slice", "part", "keys", "counts", "texts", "times")}
            for k in range(PARTS):
                mine = order[cuts[k] : cuts[k + 1]]
                if len(mine):
                    lead = np.flatnonzero(np.diff(pair[mine], prepend=-1))
                    packed = (pair[mine][lead], np.diff(lead, append=len(mine)), text[mine], times[mine])
                    values = (number, k, packed[0].astype("<i8").tobytes(), *map(_narrow, packed[1:]))
                    for column, value in zip(rows.values(), values, strict=True):
                        column.append(value)
            yield _filled(rows, len(rows["part"]), schema)
            number += 1

    return run


def _filled(columns: dict, n: int, schema: pa.Schema) -> pa.RecordBatch:
    """columns as schema has them, with nulls for those that are missing."""
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema
    )


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """pair and n, the documents that link it, of packed rows; added up COUNTED pairs at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = 0

    def flush() -> pa.RecordBatch:
        pair, n = _summed(*map(np.concatenate, zip(*held, strict=True)))
        return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], ["pair", "n"])

    for batch in batches:
        for keys, counts in zip(batch.column("keys"), batch.column("counts"), strict=True):
            pair = np.frombuffer(keys.as_py(), dtype="<i8")
            held.append((pair, _wide(counts.as_py(), len(pair))))
            waiting += len(pair)
            if waiting >= COUNTED:
                yield flush()
                held, waiting = [], 0
    if held:
        yield flush()


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per packed row the sums of its links for each text; the rows of a group begin with its pairs."""
    group, known, missing = None, [], True
    pairs = counts = best = np.zeros(0, dtype=np.int64)
    for batch in batches:
        at = 0
        parts, salts, kinds = (batch.column(c).to_numpy() for c in ("part", "salt", "kind"))
        cuts = np.flatnonzero(np.diff(parts) | np.diff(salts) | np.diff(kinds)) + 1
        out: list[list] = [[], [], [], []]
        for to in [*cuts.tolist(), batch.num_rows]:
            if to == at:
                continue
            run, at = batch.slice(at, to - at), to
            here = (run.column("part")[0].as_py(), run.column("salt")[0].as_py())
            if here != group:
                group, known, missing = here, [], True
            if run.column("kind")[0].as_py() == 0:
                known.append([run.column(c).to_numpy(zero_copy_only=False) for c in ("pair", "n", "best")])
                continue
            if missing:
                pairs, counts, best = map(np.concatenate, zip(*known, strict=True))
                known, missing = [], False
            for row in run.select(["slice", "keys", "counts", "texts", "times"]).to_pylist():
                keys = np.frombuffer(row["keys"], dtype="<i8")
                place = np.searchsorted(pairs, keys)
                each = _wide(row["counts"], len(keys))
                texts, times = (_wide(row[c], int(each.sum())) for c in ("texts", "times"))
                place = np.repeat(place, each)
                members, slot = np.unique(texts, return_inverse=True)
                sums = np.zeros((2, len(members)), dtype=np.int64)
                np.add.at(sums[0], slot, np.where(best[place], times, 0))
                np.add.at(sums[1], slot, times * counts[place])
                for column, value in zip(out, (row["slice"], members, sums[0], sums[1]), strict=True):
                    column.append(value)
        if out[0]:
            lists = [pa.array(x, pa.list_(pa.int64())) for x in out[1:]]
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), *lists], ["slice", "members", "n_best", "count_sum"])


def _merge(table: pa.Table) -> pa.Table:
    """The sums of a slice's texts over all parts."""
    members, n_best, count_sum = (table[c].combine_chunks().flatten().to_numpy() for c in ("members", "n_best", "count_sum"))
    number, best = _summed(members, n_best)
    _, counts = _summed(members, count_sum)
    names = ["slice", "number", "n_best", "count_sum"]
    return pa.table([pa.array(np.full(len(number), table["slice"][0].as_py())), pa.array(number, pa.int32()), best, counts], names)


def packed_links(docs: DataFrame, models: Callable[[], Tokenizers]) -> DataFrame:
    """The stored digests and distinct links of all documents; see _pack."""
    bound_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return stored(docs.mapInArrow(_pack(models, _arrow_schema()), _PACKED), "links")


def _arrow_schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in _PACKED.split(", "))])


def pair_counts(packed: DataFrame) -> DataFrame:
    """pair (a * the size of B's vocabulary + b) and n, the documents that hold it linked."""
    links = packed.where("part is not null").select("keys", "counts")
    return links.mapInArrow(_add_up, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def aligned_tokens(docs: DataFrame, path_a: str = BYTES_A, path_b: str = PIECES_B) -> DataFrame:
    """doc_id, the ids of both tokenizers, and how many of each have ended at the end of each group.

    Null and empty texts, and those that the two spell differently, have empty arrays."""
    models = tokenizers(docs.sparkSession, path_a, path_b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=SLICE):
            found = align(models(), batch.column("text").to_pylist()).tokens
            lists = [pa.array([x[k].tolist() for x in found], pa.list_(pa.int32())) for k in range(4)]
            names = ["doc_id", "a_ids", "b_ids", "a_ends", "b_ends"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *lists], names)

    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    lists = ", ".join(f"{c} array<int>" for c in ("a_ids", "b_ids", "a_ends", "b_ends"))
    return docs.mapInArrow(run, f"doc_id long, {lists}")


def link_statistics(docs: DataFrame, path_a: str = BYTES_A, path_b: str = PIECES_B) -> DataFrame:
    """Per row of docs the sizes and digest of its alignment and the corpus-wide weight of its links.

    docs: doc_id, text; other columns are ignored. n_a, n_b, n_groups, n_links; groups_sha256, the
    digest of the groups as written_groups() has them ('' without tokens); n_best: links whose pair is
    in as many documents as any pair of its A id; count_sum: the sum of those numbers over the links.
    Texts that are null, empty or spelled differently by the two have no tokens. Rows that share an id,
    or have none, are documents of their own; long texts are aligned whole; an empty table gives an
    empty one."""
    models = tokenizers(docs.sparkSession, path_a, path_b)
    packed = packed_links(docs, models)
    width = len(models().bytes_b)
    counted = pair_counts(packed).withColumn("a", F.floor(F.col("pair") / width))
    # An A id has at most as many pairs as B's vocabulary is large.
    best = F.max("n").over(Window.partitionBy("a")) == F.col("n")
    pairs = stored(counted.select("pair", "n", best.alias("best")), "pairs")
    heads = packed.where("number is not null")
    salts = max(heads.select("slice").distinct().count() // SLICES, 1)
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    table = pairs.select(F.pmod("pair", F.lit(PARTS)).cast("int").alias("part"), every, F.lit(0).alias("kind"), "pair", "n", "best")
    links = packed.where("part is not null").select(
        "part",
        F.pmod(F.xxhash64("slice"), F.lit(salts)).cast("int").alias("salt"),
        F.lit(1).alias("kind"),
        *("slice", "keys", "counts", "texts", "times"),
    )
    both = table.unionByName(links, allowMissingColumns=True).repartition("part", "salt")
    sums = both.sortWithinPartitions("part", "salt", "kind", "pair").mapInArrow(
        _look_up, "slice long, members array<long>, n_best array<long>, count_sum array<long>"
    )
    each = sums.groupBy("slice").applyInArrow(_merge, "slice long, number int, n_best long, count_sum long")
    zero: Callable[[str], Column] = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return heads.join(each, ["slice", "number"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256"
    )


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_statistics(spark.read.parquet(f"{sf_dir}/documents.parquet"))
