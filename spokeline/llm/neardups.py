"""Near-duplicate documents by Order MinHash, verified by banded alignment.

A sketch is the ORDERED smallest of a text's 2-word shingles under one hash function, each labelled
with its occurrence number and all kept in text order, so it agrees more often the fewer edits
turn one text into the other. Documents that share one of SKETCHES sketches are candidates. Two
texts are linked if the edit distance of their whole word sequences is at most (1 - SIMILARITY) of
the longer one; classes are the connected components of the links.

An edit changes two shingles of either text at most, so long linked texts have a Jaccard similarity J of
0.43 or more and share none of the sketches with a probability of about (1 - J**ORDERED)**SKETCHES, 0.006 or
less. Texts of a few words have too few shingles for that. Those of fewer than FEW words also have
SKETCHES sketches of one shingle less. Where one edit is all that SIMILARITY allows, the text and
what is left of it without one word are keys too, which finds all links.

Equal texts are one class from the start and only the smallest doc_id of each goes on. In a bucket
every document is first aligned with the smallest one. Where that leaves more than one class in a
bucket, the documents outside the largest are aligned with another one of it, and then all documents
of classes that still differ are compared. A passage that many texts contain makes
crowded buckets of unlike documents; these are dealt out in pairs of blocks, and a task compares and
aligns the documents of two blocks, so that only links come out of it. A signature of a text's words
gives a lower bound of the edit distance, so only pairs that may be linked are aligned.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spokeline.llm.components import components, looked_up, stored
from spokeline.llm.words import bound_batches, mix, shingle_hashes, slices, utf8, words

SHINGLE = 2
SIMILARITY = 0.8
ORDERED = 3
SKETCHES = 64
#: Texts of fewer words may differ by one edit at most.
SHORT = 10
FEW = 64
#: Documents outside a bucket's largest class beyond which the bucket is compared in pairs of blocks
#: of about so many rows and words; all pairs are compared either way.
CROWD = 32
BLOCK_ROWS = 512
BLOCK_WORDS = 1 << 20
#: Bits of a text's signature.
SIGNATURE = 2048
#: Shingles that are sketched at once, and bytes of text that a Python worker gets and takes apart at once: the
#: arrays for a byte of text take some forty times its size, in every worker of an executor.
BLOCK = 1 << 13
BATCH = 1 << 21
SLICE = 1 << 19

_salts = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, SKETCHES, dtype=np.uint64) | np.uint64(1)


def _occurrences(values: np.ndarray) -> np.ndarray:
    """How many equal values stand before each."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    at = np.flatnonzero(new)
    rank = np.empty(len(values), dtype=np.uint64)
    rank[order] = np.arange(len(values)) - np.repeat(at, np.diff(np.append(at, len(values))))
    return rank


def sketches(shingles: np.ndarray, ordered: int = ORDERED) -> np.ndarray:
    """SKETCHES hashes, each of the so many smallest labelled shingles in text order."""
    labelled = mix(shingles + _occurrences(shingles) * np.uint64(0x9E3779B97F4A7C15))
    best, place = np.zeros((0, SKETCHES), np.uint64), np.zeros((0, SKETCHES), np.int64)
    for at in range(0, len(labelled), BLOCK):  # in blocks, so that a long text needs no large matrix
        part = labelled[at : at + BLOCK, None] * _salts[None, :]
        part ^= part >> np.uint64(29)
        where = np.broadcast_to(np.arange(at, at + len(part))[:, None], part.shape)
        if len(part) > ordered:
            least = np.argpartition(part, ordered - 1, axis=0)[:ordered]
            part, where = np.take_along_axis(part, least, 0), np.take_along_axis(where, least, 0)
        best, place = np.concatenate([best, part]), np.concatenate([place, where])
        if len(best) > ordered:
            least = np.argpartition(best, ordered - 1, axis=0)[:ordered]
            best, place = np.take_along_axis(best, least, 0), np.take_along_axis(place, least, 0)
    place = np.sort(place, axis=0)
    key = np.arange(SKETCHES, dtype=np.uint64) + np.uint64(SKETCHES * ordered)
    for row in place:
        key = mix(key * np.uint64(0xD1B54A32D192ED03) + labelled[row])
    return key


def signatures(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A row of SIGNATURE bits a text: whether the number of its labelled words with that hash is odd.

    Words are labelled with their occurrence number, so one that is frequent in one text only counts as
    often as it is there. An inserted or deleted word changes one bit, a replaced one at most two."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    apart = hashes + text.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)
    labelled = mix(hashes + _occurrences(apart) * np.uint64(0x9E3779B97F4A7C15))
    cells, n = np.unique(text * SIGNATURE + (labelled % np.uint64(SIGNATURE)).astype(np.int64), return_counts=True)
    cells = cells[n % 2 == 1]
    out = np.zeros((len(first) - 1, SIGNATURE // 8), dtype=np.uint8)
    np.bitwise_or.at(out, (cells // SIGNATURE, cells % SIGNATURE // 8), (1 << (cells % 8)).astype(np.uint8))
    return out


def _bits(column: pa.Array) -> np.ndarray:
    """Signatures as rows of 64-bit integers."""
    return utf8(column)[0].view(np.uint64).reshape(-1, SIGNATURE // 64)


def _near(n: np.ndarray, m: np.ndarray, bits: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether texts of n and m words with these signatures may be linked."""
    most = (np.maximum(n, m) * (1 - SIMILARITY) + 1e-9).astype(np.int64)
    # Of the words that only one side has, an edit settles at most one of each side.
    only = np.bitwise_count(bits ^ other).sum(axis=1, dtype=np.int64)
    return (abs(n - m) <= most) & (only + abs(n - m) <= 2 * most)


def shorter(hashes: np.ndarray) -> np.ndarray:
    """Hashes of a text of fewer than SHORT words and of all that deleting one word makes of it."""
    n = len(hashes)
    rows = np.array([np.delete(hashes, i) for i in range(n)], dtype=np.uint64).reshape(n, n - 1)
    out = []
    for part in (hashes[None, :], rows):
        key = np.full(len(part), part.shape[1], dtype=np.uint64)
        for column in part.T:
            key = mix(key * np.uint64(0xD1B54A32D192ED03) + column)
        out.append(key)
    return np.concatenate(out)


def _keys(hashes: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    """What a text is found by."""
    if not len(hashes):
        return np.zeros(0, dtype=np.int64)
    found = [sketches(shingles)]
    if len(hashes) < FEW:
        found.append(sketches(shingles, ORDERED - 1))
    if len(hashes) < SHORT:
        found.append(shorter(hashes))
    return np.concatenate(found).view(np.int64)


def _sketch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, size=SLICE):
        found = words(batch.column("text"))
        hashes = found.hashes()
        shingles, first = shingle_hashes(found.first, hashes, SHINGLE)
        keys = [
            _keys(hashes[a:b], shingles[x:y])
            for a, b, x, y in zip(found.first, found.first[1:], first, first[1:], strict=False)
        ]
        signature = [row.tobytes() for row in signatures(hashes, found.first)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(found.count), pa.array(keys, pa.list_(pa.int64())), pa.array(signature, pa.binary())],
            ["doc_id", "n_words", "keys", "signature"],
        )


def distances(pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Edit distance of each pair of sequences, or -1 beyond (1 - SIMILARITY) of the longer."""
    out = np.full(len(pairs), -1)
    for i, (a, b) in enumerate(pairs):
        most = int(max(len(a), len(b)) * (1 - SIMILARITY) + 1e-9)
        if abs(len(a) - len(b)) > most:
            continue
        n = min(len(a), len(b))
        differ = np.flatnonzero(a[:n] != b[:n])
        head = int(differ[0]) if len(differ) else n
        a, b, n = a[head:], b[head:], n - head
        differ = np.flatnonzero(a[len(a) - n :][::-1] != b[len(b) - n :][::-1])
        tail = int(differ[0]) if len(differ) else n
        a, b = a[: len(a) - tail].tolist(), b[: len(b) - tail].tolist()
        distance = _banded(a, b, most) if len(a) <= len(b) else _banded(b, a, most)
        out[i] = distance if distance <= most else -1
    return out


def _banded(a: list[int], b: list[int], band: int) -> int:
    """Edit distance of a and b (not shorter) if it is at most band, which their lengths differ by at most;
    else some larger number. Only cells within band diagonals of the main one are computed.

    Column by column of b; bit t of the numbers stands for row column - band + t of a. plus and minus
    are the rows whose cell is one more, or one less, than the cell above; diagonal those whose cell
    equals the one before on its diagonal; right and left those that are one more or less than the cell
    in the column before.
    """
    places: dict[int, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    mask = (1 << 2 * band + 1) - 1
    plus, minus = mask >> band << band, 0
    distance, longer = 0, len(b) - len(a)
    for column, x in enumerate(b, 1):
        shift = column - band - 1
        match = places.get(x, 0)
        match = (match >> shift if shift >= 0 else match << -shift) & mask | minus
        diagonal = ((((match & plus) + plus) ^ plus) | match) & mask
        right = minus | mask ^ (diagonal | plus)
        left = diagonal & plus
        if column <= len(a):
            distance += 1 - (diagonal >> band & 1)
            if distance > band + longer:
                return distance
        else:
            row = len(a) - column + band
            distance += (right >> row & 1) - (left >> row & 1)
        plus = left | mask ^ (diagonal >> 1 | right)
        minus = diagonal >> 1 & right
    return distance


def _word_hashes(texts: pa.Array) -> list[np.ndarray]:
    """The hashes of each text's words; only SLICE bytes of text (one text at least) are taken apart at once."""
    out = []
    for part in slices(iter([pa.RecordBatch.from_arrays([texts], ["text"])]), size=SLICE):
        found = words(part.column("text"))
        hashes = found.hashes()
        out += [hashes[x:y] for x, y in zip(found.first, found.first[1:], strict=False)]
    return out


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of rows (a, b, text_a, text_b) that are linked."""
    for batch in slices(batches, "text_a", SLICE):
        sides = [_word_hashes(batch.column(name)) for name in ("text_a", "text_b")]
        found = distances(list(zip(*sides, strict=True)))
        yield batch.select(["a", "b"]).filter(pa.array(found >= 0))


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of rows (a, b, n_a, n_b, signature_a, signature_b) that may be linked."""
    for batch in batches:
        if batch.num_rows:
            n, m = (batch.column(name).to_numpy() for name in ("n_a", "n_b"))
            near = _near(n, m, _bits(batch.column("signature_a")), _bits(batch.column("signature_b")))
            yield batch.select(["a", "b"]).filter(pa.array(near))


def possible(sketched: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose lengths and signatures don't rule a link out."""
    for x in ("a", "b"):
        side = sketched.select(
            F.col("doc_id").alias(x), F.col("n_words").alias(f"n_{x}"), F.col("signature").alias(f"signature_{x}")
        )
        pairs = pairs.join(side, x)
    return pairs.mapInArrow(_possible, "a long, b long")


def linked(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough."""
    text = F.col("text")
    left = docs.select(F.col("doc_id").alias("a"), text.alias("text_a"))
    right = docs.select(F.col("doc_id").alias("b"), text.alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_align, "a long, b long")


def _fits(x: str, y: str) -> Column:
    """The shorter text has at least SIMILARITY of the longer one's words."""
    return F.least(x, y) >= F.ceil(F.greatest(x, y) * SIMILARITY - 1e-9)


def _mixed(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows (key, doc_id, n_words) of buckets with more than one class, with class_id, the bucket's
    rows n, its largest class main and the rows of the others, rest."""
    known = classes.select(F.col("id").alias("doc_id"), "class_id")
    rows = rows.join(known, "doc_id", "left").withColumn("class_id", F.coalesce("class_id", "doc_id"))
    rows = stored(rows, "labelled")
    sizes = rows.groupBy("key", "class_id").agg(F.count("*").alias("n"))
    largest = F.max(F.struct("n", "class_id"))
    sizes = sizes.groupBy("key").agg(
        F.sum("n").alias("n"), (F.sum("n") - largest["n"]).alias("rest"), largest["class_id"].alias("main")
    )
    return stored(rows.join(sizes.where("rest > 0"), "key"), "mixed")

def _strays(held: DataFrame) -> DataFrame:
    """Pairs (a, b) of the documents outside a bucket's largest class, each with one of that class, which is
    another one in most buckets."""
    by = F.struct(F.xxhash64("key", "doc_id").alias("order"), "doc_id", "n_words")
    centre = held.where("class_id = main").groupBy("key").agg(F.min(by).alias("centre"))
    strays = held.where("class_id <> main").select("key", "doc_id", "n_words").join(centre, "key")
    strays = strays.where(_fits("n_words", "centre.n_words"))
    return strays.select(
        F.least("doc_id", "centre.doc_id").alias("a"), F.greatest("doc_id", "centre.doc_id").alias("b")
    ).distinct()


def _across(held: DataFrame, sketched: DataFrame) -> DataFrame:
    """Pairs (a, b) of different classes in the _mixed() buckets with at most CROWD documents outside
    the largest class that may be linked.

    Each of these documents is compared with all others of other classes, so a bucket gives at most
    CROWD pairs for each of its rows, each pair in the first of these buckets that it shares.
    """
    ready = held.where(F.col("rest") <= CROWD).select("key", "doc_id", "n_words", "class_id", "main")
    keys = ready.groupBy("doc_id").agg(F.sort_array(F.collect_set("key")).alias("keys"))
    ready = stored(ready.join(keys, "doc_id"), "ready")
    one, other = ready.where("class_id <> main").alias("x"), ready.alias("y")
    once = "(y.class_id = y.main OR x.doc_id < y.doc_id) AND array_intersect(x.keys, y.keys)[0] = x.key"
    first = F.expr(f"x.key = y.key AND x.class_id <> y.class_id AND {once}")
    pairs = one.join(other, first & _fits("x.n_words", "y.n_words"))
    pairs = pairs.select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b"))
    return possible(sketched, pairs.distinct()).distinct()


def _crowded_links(held: DataFrame, sketched: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) between different classes in the other _mixed() buckets.

    A bucket's rows are dealt into blocks of about BLOCK_ROWS rows and BLOCK_WORDS words, and a task
    compares and aligns all rows of a pair of blocks, so unlike documents with a passage in common never
    make rows of their own. A pair that shares several of these buckets is compared in the first."""
    crowded = held.where(F.col("rest") > CROWD).select("key", "doc_id", "n_words", "class_id")
    size = crowded.groupBy("key").agg(F.count("*").alias("n"), F.sum("n_words").alias("words"))
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK_ROWS, F.col("words") / BLOCK_WORDS, F.lit(1.0)))
    rows = crowded.join(size.select("key", blocks.alias("blocks")), "key")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id"), "blocks"))
    keys = crowded.groupBy("doc_id").agg(F.sort_array(F.collect_set("key")).alias("keys"))
    # Written, their ids have a size that is known before a join with them is planned; where it is small
    # enough to broadcast, no other text is shuffled.
    ids = stored(crowded.select("doc_id").distinct(), "crowded")
    text = docs.join(ids, "doc_id", "left_semi").join(keys, "doc_id")
    text = text.join(sketched.select("doc_id", "signature").join(ids, "doc_id", "left_semi"), "doc_id")
    rows = rows.join(text, "doc_id")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    rows = rows.select("key", "low", "high", "block", "doc_id", "n_words", "class_id", "signature", "keys", "text")
    return rows.groupBy("key", "low", "high").applyInArrow(_blocks, "a long, b long")


def _earlier_keys(keys: pa.Array, key: int) -> np.ndarray:
    """Bits of the keys below key that each row has, as rows of 64-bit integers."""
    row = np.repeat(np.arange(len(keys)), np.diff(keys.offsets.to_numpy()))
    value = keys.flatten().to_numpy()
    row, value = row[value < key], value[value < key]
    known, number = np.unique(value, return_inverse=True)
    out = np.zeros((len(keys), -(-len(known) // 64) or 1), dtype=np.uint64)
    np.bitwise_or.at(out, (row, number // 64), np.uint64(1) << (number % 64).astype(np.uint64))
    return out


def _blocks(table: pa.Table) -> pa.Table:
    """Links between the rows of two blocks, or within one, that are of different classes; rows that
    these links join already are not compared again."""
    hashes = [x for texts in table["text"].chunks for x in _word_hashes(texts)]
    order = pc.sort_indices(table["n_words"])
    hashes = [hashes[i] for i in order.to_pylist()]
    table = table.drop_columns(["text"]).take(order).combine_chunks()
    column = lambda name: table[name].chunk(0)
    block, doc, n, of = (column(name).to_numpy() for name in ("block", "doc_id", "n_words", "class_id"))
    bits, earlier = _bits(column("signature")), _earlier_keys(column("keys"), table["key"][0].as_py())
    known, of = np.unique(of, return_inverse=True)
    top = list(range(len(known)))

    def class_of(x: int) -> int:
        while top[x] != x:
            top[x] = x = top[top[x]]
        return x

    one, other = np.flatnonzero(block == table["low"][0].as_py()), np.flatnonzero(block == table["high"][0].as_py())
    links: list[tuple[int, int]] = []
    within = len(one) == len(table)
    for i in one.tolist():
        least = int(np.searchsorted(n[other], n[i] * SIMILARITY - 1))
        to = int(np.searchsorted(n[other], (n[i] + 1) / SIMILARITY + 1, side="right"))
        at = other[max(least, i + 1 if within else 0) : to]
        at = at[(of[at] != of[i]) & ~(earlier[at] & earlier[i]).any(axis=1)]
        at = at[_near(n[i], n[at], bits[i], bits[at])]
        for j in at.tolist():
            x, y = class_of(int(of[i])), class_of(int(of[j]))
            if x != y and distances([(hashes[i], hashes[j])])[0] >= 0:
                top[max(x, y)] = min(x, y)
                links.append((min(doc[i], doc[j]), max(doc[i], doc[j])))
    a, b = zip(*links, strict=True) if links else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _one_text_each(docs: DataFrame) -> DataFrame:
    """docs with the smallest text (by its bytes) of each doc_id; only texts of repeated ids are moved."""
    repeated = stored(docs.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    if repeated.isEmpty():
        return docs
    chosen = docs.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    return docs.join(repeated, "doc_id", "left_anti").select("doc_id", "text").unionByName(chosen)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Classes of near-duplicate texts.

    docs: doc_id long, text string; other columns are ignored. Returns one row per distinct non-null
    doc_id: doc_id, class_id (the smallest doc_id of its class), n_words and class_size. A null text
    counts as empty; empty texts equal each other and nothing else. A text of one word
    has one shingle, that word. Of rows that share a doc_id the one with the smallest text counts,
    whatever their order; rows with a null doc_id are left out. Long texts are sketched and aligned
    whole. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    bound_batches(spark, BATCH)
    docs = (
        docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        .where("doc_id IS NOT NULL")
    )
    docs = _one_text_each(docs)
    content = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    same = stored(docs.select("doc_id", content.alias("content")), "contents")
    least = same.groupBy("content").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).where("n > 1")
    member = looked_up(same, least.drop("n"), "content", "doc_id")
    member = stored(member.select("doc_id", F.coalesce("rep", "doc_id").alias("rep")), "members")
    sketched = docs.mapInArrow(_sketch_rows, "doc_id long, n_words long, keys array<long>, signature binary")
    sketched = stored(sketched, "sketches")
    reps = member.where("doc_id = rep").select("doc_id")
    rows = (
        sketched.join(reps, "doc_id", "left_semi")
        .select("doc_id", "n_words", F.explode(F.array_distinct("keys")).alias("key"))
    )
    first = F.min(F.struct("doc_id", "n_words")).alias("first")
    leader = rows.groupBy("key").agg(first, F.count("*").alias("n")).where("n > 1")
    buckets = stored(rows.join(leader.select("key", "first"), "key"), "buckets")
    stars = buckets.where((F.col("first.doc_id") < F.col("doc_id")) & _fits("first.n_words", "n_words"))
    stars = possible(sketched, stars.select(F.col("first.doc_id").alias("a"), F.col("doc_id").alias("b")).distinct())
    stars = stored(stars, "stars")
    links = stored(linked(docs, stars), "links")
    # Documents that one of a large class is like need not be aligned with all of it.
    held = _mixed(buckets.select("key", "doc_id", "n_words"), components(links))
    strays = stored(possible(sketched, _strays(held).join(stars, ["a", "b"], "left_anti")), "strays")
    links = links.unionByName(stored(linked(docs, strays), "links"))
    held = _mixed(held.select("key", "doc_id", "n_words"), components(links))
    pairs = _across(held, sketched).join(stars, ["a", "b"], "left_anti").join(strays, ["a", "b"], "left_anti")
    pairs = stored(pairs, "across")
    links = links.unionByName(stored(linked(docs, pairs), "links"))
    links = links.unionByName(stored(_crowded_links(held, sketched, docs), "links"))
    bound_batches(spark)  # all Python steps above have run
    classes = components(links)
    found = looked_up(member, classes.select(F.col("id").alias("rep"), "class_id"), "rep", "doc_id")
    found = found.select("doc_id", F.coalesce("class_id", "rep").alias("class_id"))
    size = found.groupBy("class_id").agg(F.count("*").alias("class_size")).where("class_size > 1")
    found = looked_up(found, size, "class_id", "doc_id").withColumn("class_size", F.coalesce("class_size", F.lit(1)))
    lengths = sketched.select("doc_id", "n_words")
    return found.join(lengths, "doc_id").select("doc_id", "class_id", "n_words", "class_size")


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
