"""Spelling variants: words one edit apart, found by search schemes over FM-indexes.

Two words are near if one inserted, deleted or replaced code point makes them equal. Of a word cut in
halves the edit lies in one, so the other half is in the near word unchanged, at the same end. Two
searches follow: match the first half exactly and extend to the right over the second with one edit, and
match the second half exactly and extend to the left over the first. The index is bidirectional: both
the words and the reversed words, each word between delimiters, are indexed, so that extending to the
right is extending to the left in the other; an interval of suffix ranks stands for all words that
begin, or end, with what has been matched so far.

A search starts with an end of the word unchanged, so words are dealt into blocks by their first (last)
code points, and a word is searched only in the block that its own first (last) code points name. Crowded
blocks are split, and their queries search every part.
"""

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spokeline.llm.components import looked_up, stored
from spokeline.llm.words import bound_batches, slices

LEAST_LENGTH, LEAST_COUNT, MODULUS = 5, 3, 97
#: Words that an index, and queries that one task puts to it, hold on average at most.
BLOCK_WORDS = 50_000
#: Queries searched at once.
CHUNK = 4096
#: Distinct words that a task counts before it hands them on.
COUNTED = 400_000
#: Words from this length on are dealt by four code points at an end, shorter ones by two; half a word
#: has at least as many.
LONG = 8

# Over Latin-1: one byte a code point, and any other character is a question mark.
_RUN = re.compile(rb"[a-z\xc0-\xff]+")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
        counts.clear()
        return out

    for batch in slices(batches):
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
        for doc_id, text in zip(ids, texts, strict=True):
            if not text:
                continue
            seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            for run, n in Counter(_RUN.findall(text.encode("latin-1", "replace").lower())).items():
                word = run.decode("latin-1")
                h = zlib.crc32(run if run.isascii() else word.encode(), seed)
                if h % MODULUS == 0:
                    at = h % len(run)
                    word = word[:at] + word[at + 1 :]
                if len(word) >= LEAST_LENGTH:
                    counts[word] += n
            if len(counts) >= COUNTED:
                yield flush()
    yield flush()


def vocabulary_of(docs: DataFrame) -> DataFrame:
    """word and n, the occurrences of words of LEAST_LENGTH code points that occur LEAST_COUNT times.

    Words are runs of A to Z, a to z and U+00C0 to U+00FF, with only A to Z lower-cased; one in
    MODULUS runs, by the checksum of doc_id and run, lacks a code point. Tasks add up their words
    before the shuffle, so a frequent word is at most a few rows a task."""
    bound_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    counts = docs.mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= LEAST_COUNT)


def _symbols(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all words in a row, and where each begins and the last ends."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    text = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return text, np.concatenate([[0], np.cumsum(lengths)])


def _ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] of them), start[1], ..."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Where the suffixes of text begin, in their order; by doubling the prefix that is compared."""
    n, bits = len(text), int(text.max()).bit_length() + 1
    step = max(62 // bits, 1)
    padded = np.concatenate([text.astype(np.int64) + 1, np.zeros(step, dtype=np.int64)])
    key = np.zeros(n, dtype=np.int64)
    for i in range(step):
        key = (key << (bits if i else 0)) | padded[i : n + i]
    while True:
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        if new[-1] == n - 1:
            return order
        rank = np.empty(n, dtype=np.int64)
        rank[order] = new + 1
        after = np.zeros(n, dtype=np.int64)
        after[: max(n - step, 0)] = rank[step:]
        key, step = rank * (n + 1) + after, 2 * step


class Index:
    """An FM-index of words with a delimiter (symbol 0) before, between and after them.

    Row j of the sorted suffixes has bwt[j] before it; in step[j] it is the rank of the suffix that
    begins with that symbol. An interval [low, high) of ranks holds all suffixes with a common start."""

    def __init__(self, symbols: np.ndarray, first: np.ndarray):
        sizes = np.diff(first) + 1
        self.starts = np.concatenate([[0], np.cumsum(sizes)])  # of the delimiters
        text = np.zeros(self.starts[-1] + 1, dtype=np.int64)
        text[_ragged(self.starts[:-1] + 1, np.diff(first))] = symbols
        self.n = len(text)
        self.order = suffix_order(text)
        self.bwt = text[self.order - 1]
        by_symbol = np.argsort(self.bwt, kind="stable")
        self.step = np.empty(self.n, dtype=np.int64)
        self.step[by_symbol] = np.arange(self.n)
        self.keys = self.bwt[by_symbol] * self.n + by_symbol

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the suffixes with the symbols put before them; symbol -1 is in no text."""
        return np.searchsorted(self.keys, symbol * self.n + low), np.searchsorted(self.keys, symbol * self.n + high)

    def before(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
        """All symbols but the delimiter that stand before the suffixes of each interval: symbol and
        new interval, in the order of the intervals, and how many each has."""
        size = high - low
        rows = _ragged(low, size)
        width = int(self.bwt.max()) + 1
        key = np.repeat(np.arange(len(low)), size) * width + self.bwt[rows]
        key, at, count = np.unique(key, return_index=True, return_counts=True)
        symbol = key % width
        kept = symbol > 0
        new = self.step[rows[at]]
        return symbol[kept], new[kept], (new + count)[kept], np.bincount(key[kept] // width, minlength=len(low))

    def one_edit(self, symbols: np.ndarray, first: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, word) such that the word ends with the query's last exact symbols and is one
        edit away in what stands before them. Queries: symbols[first[q] : first[q + 1]]."""
        n = len(first) - 1
        query = np.arange(n)
        left = np.diff(first)  # symbols still to be matched
        low, high = np.zeros(n, dtype=np.int64), np.full(n, len(self.starts))
        goal = left - exact
        while True:  # the unchanged half
            go = np.flatnonzero(left > goal)
            if not len(go):
                break
            left[go] -= 1
            low[go], high[go] = self.extend(symbols[first[query[go]] + left[go]], low[go], high[go])
            found = high > low
            query, left, low, high, goal = (x[found] for x in (query, left, low, high, goal))
        edited = [np.zeros(0, dtype=np.int64)] * 4
        pairs = []
        while len(query) or len(edited[0]):
            query, left, low, high, new = self._edits(symbols, first, query, left, low, high)
            edited = [np.concatenate(x) for x in zip(edited, *new, strict=True)]
            edited, ended = self._exactly(symbols, first, *edited)
            pairs.append(ended)
        if not pairs:
            return query, query
        pair = np.unique(np.concatenate([q * len(self.starts) + w for q, w in pairs]))
        return pair // len(self.starts), pair % len(self.starts)

    def _edits(self, symbols, first, query, left, low, high) -> tuple:
        """Unedited states one symbol further, and the states that an edit here leads to."""
        none = np.zeros(0, dtype=np.int64)
        if not len(query):
            return query, left, low, high, [[none] * 4]
        spans, span = np.unique(low * (self.n + 1) + high, return_inverse=True)
        symbol, new_low, new_high, count = self.before(spans // (self.n + 1), spans % (self.n + 1))
        begin = np.cumsum(count) - count
        child = _ragged(begin[span], count[span])
        state = np.repeat(np.arange(len(query)), count[span])
        wanted = np.where(left > 0, symbols[first[query] + np.maximum(left, 1) - 1], -1)
        q, l, lo, hi = query[state], left[state], new_low[child], new_high[child]
        same = symbol[child] == wanted[state]
        other = ~same & (l > 0)
        more = left > 0
        new = [
            [q, l, lo, hi],  # the word has one symbol more
            [q[other], l[other] - 1, lo[other], hi[other]],  # another one
            [query[more], left[more] - 1, low[more], high[more]],  # one less
        ]
        return q[same], l[same] - 1, lo[same], hi[same], new

    def _exactly(self, symbols, first, query, left, low, high) -> tuple[list[np.ndarray], tuple]:
        """Edited states one symbol further; of those that reach the delimiter the pairs."""
        symbol = np.where(left > 0, symbols[np.minimum(first[query] + np.maximum(left, 1) - 1, len(symbols) - 1)], 0)
        low, high = self.extend(symbol, low, high)
        found = high > low
        done = found & (left == 0)
        word = np.searchsorted(self.starts, self.order[low[done]])
        go = found & (left > 0)
        return [query[go], left[go] - 1, low[go], high[go]], (query[done], word)


def near_pairs(index: list[str], queries: list[str], backwards: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers (query, word) of near pairs, each once, in chunks of queries.

    Forwards: those that share the query's second half, but not its first; backwards (both sides are
    reversed to extend to the right): those that share the first half."""
    if not index or not queries:
        return
    turned = [w[::-1] for w in index] if backwards else index
    text, first = _symbols(turned)
    known, symbols = np.unique(text, return_inverse=True)
    fm = Index(symbols + 1, first)
    for at in range(0, len(queries), CHUNK):
        chunk = queries[at : at + CHUNK]
        own, begin = _symbols([w[::-1] for w in chunk] if backwards else chunk)
        place = np.minimum(np.searchsorted(known, own), len(known) - 1)
        own = np.where(known[place] == own, place + 1, -1)
        half = np.diff(begin) // 2
        query, word = fm.one_edit(own, begin, half if backwards else np.diff(begin) - half)
        if not backwards:
            apart = np.zeros(len(query), dtype=bool)
            left = np.flatnonzero(half[query] > 0)
            i = 0
            while len(left):  # compare the first halves symbol by symbol
                q, w = query[left], word[left]
                inside = first[w] + i < first[w + 1]
                theirs = np.where(inside, symbols[np.minimum(first[w] + i, len(symbols) - 1)] + 1, -2)
                differ = theirs != own[begin[q] + i]
                apart[left[differ]] = True
                i += 1
                left = left[~differ & (half[q] > i)]
            query, word = query[apart], word[apart]
        yield query + at, word


def _search(key: tuple, table: pa.Table) -> pa.Table:
    """Of a part of a block, per query with near words: how many, and the most frequent of them."""
    rows = table.select(["word", "n", "is_query"])
    queries = rows.filter(rows["is_query"])
    index = rows.filter(pc.invert(rows["is_query"])).group_by("word").aggregate([("n", "max")]).sort_by("word")
    words, counts = index["word"].to_pylist(), index["n_max"].to_numpy()
    asked = queries["word"].to_pylist()
    found: list[list] = [[], [], [], []]
    for query, word in near_pairs(words, asked, key[0].as_py()):
        # The words are in code-point order, so of equally frequent ones the smallest number wins.
        order = np.lexsort((word, -counts[word], query))
        query, word = query[order], word[order]
        lead = np.flatnonzero(np.diff(query, prepend=-1))
        found[0] += [asked[q] for q in query[lead].tolist()]
        found[1] += np.diff(lead, append=len(query)).tolist()
        found[2] += counts[word[lead]].tolist()
        found[3] += [words[w] for w in word[lead].tolist()]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    return pa.table([pa.array(x, k) for x, k in zip(found, kinds, strict=True)], names=["word", "n_near", "top_n", "top"])


def near_words(vocabulary: DataFrame) -> DataFrame:
    """Per word and part of the index with near words: n_near, and top and top_n, the most frequent.

    vocabulary: word (distinct, not null, two code points at least) and n. Every word is a query
    against all words; a pair is counted once for each of its two words."""
    words = vocabulary.select("word", "n")
    turned = words.select("word", "n", F.explode(F.array(F.lit(False), F.lit(True))).alias("backwards"))
    turned = turned.withColumn("x", F.when(F.col("backwards"), F.reverse("word")).otherwise(F.col("word")))
    size = F.length("word")
    key = lambda n: F.substr("x", F.greatest(F.length("x") - (n - 1), F.lit(1)), F.lit(n))
    asked = F.array(F.when(size >= LONG, key(4)).otherwise(key(2)))
    # A word is searched for by words of its own length, one less and one more.
    held = F.filter(
        F.array(F.when(size - 1 < LONG, key(2)), F.when(size + 1 >= LONG, key(4))), lambda k: k.isNotNull()
    )
    rows = [
        turned.select("word", "n", "backwards", F.lit(query).alias("is_query"), F.explode(keys).alias("key"))
        for query, keys in ((False, held), (True, asked))
    ]
    total = vocabulary.count()
    blocks = max(4 * total // BLOCK_WORDS, 1)
    dealt = rows[0].unionByName(rows[1]).withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)))
    # How many parts the words and the queries of a block make: a few numbers for BLOCK_WORDS words.
    sizes = dealt.groupBy("backwards", "block").agg(
        *(F.ceil(F.count_if(F.col("is_query") == q) / BLOCK_WORDS).cast("int").alias(f"{name}_parts")
          for name, q in (("word", False), ("query", True)))
    )
    dealt = dealt.join(sizes, ["backwards", "block"])
    every = lambda n: F.sequence(F.lit(0), F.greatest(F.col(n), F.lit(1)) - 1)
    own = lambda n: F.pmod(F.xxhash64("word"), F.greatest(F.col(n), F.lit(1))).cast("int")
    placed = dealt.withColumn("i", F.when(F.col("is_query"), every("word_parts")).otherwise(F.array(own("word_parts"))))
    placed = placed.withColumn("j", F.when(F.col("is_query"), F.array(own("query_parts"))).otherwise(every("query_parts")))
    placed = placed.withColumn("i", F.explode("i")).withColumn("j", F.explode("j"))
    parts = placed.select("backwards", "block", "i", "j", "word", "n", "is_query")
    return parts.groupBy("backwards", "block", "i", "j").applyInArrow(
        _search, "word string, n_near long, top_n long, top string"
    )


def roots(forms: DataFrame) -> DataFrame:
    """word and root, the end of its chain, of every word with a form (word, form).

    Each round every word takes over what its own target points at, so chains halve. A form is at
    least twice as frequent as its word, so there are no cycles and few rounds."""
    reached = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        targets = reached.select(F.col("root").alias("word")).distinct()
        onward = reached.join(targets, "word", "left_semi").select(F.col("word").alias("root"), F.col("root").alias("next"))
        if onward.isEmpty():
            return reached
        found = looked_up(reached, onward, "root", "word")
        reached = stored(found.select("word", F.coalesce("next", "root").alias("root")), "roots")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """The vocabulary of docs with each word's form and root.

    docs: doc_id, text; other columns are ignored. word and n as in vocabulary_of(); n_near: how many
    words are one edit away; form: the most frequent of them (ties: the smallest in code-point order)
    if it is at least twice as frequent as the word, with its n in form_n; root: the end of the chain
    of forms, the word itself if it has none. A null text has no words; a null doc_id counts as an
    empty text before the colon of the checksum; repeated rows all count; long texts and words are
    whole; an empty table gives an empty one."""
    words = stored(vocabulary_of(docs), "vocabulary")
    found = near_words(words).select("word", F.lit(None).cast("long").alias("n"), "n_near", "top_n", "top")
    blank = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), _null("long", "top_n"), _null("string", "top"))
    best = F.min(F.when(F.col("top").isNotNull(), F.struct((-F.col("top_n")).alias("order"), "top")))
    near = found.unionByName(blank).groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best")
    )
    better = -F.col("best.order") >= 2 * F.col("n")
    near = near.select(
        "word",
        "n",
        "n_near",
        F.when(better, F.col("best.top")).alias("form"),
        F.when(better, -F.col("best.order")).alias("form_n"),
    )
    near = stored(near, "near")
    ends = roots(near.where(F.col("form").isNotNull()))
    return near.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def _null(kind: str, name: str) -> Column:
    return F.lit(None).cast(kind).alias(name)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    variants = spelling_variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return variants.select("word", "form", "root", "n", "n_near", "form_n")
