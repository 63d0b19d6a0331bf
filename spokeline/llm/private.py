"""Personal data in texts: fixed formats, and further spans that boosted trees accept.

All of it is SQL expressions. The formats of base spans (email, ip, card, phone) are matched and
validated. Generators with high recall propose spans that may overlap: runs of digits and their
separators ("number"), and long words that mix letters and digits ("secret"). Trees fitted on all
candidates, counted by the cells of a fixed grid of their features, and on fixed examples score format
and context. Where a validated format or a telling context decides a candidate, that is its label; the
smallest score that keeps PRECISION on the half of the candidates the trees haven't seen is the
threshold. Candidates beyond it, and all that a telling context decides, are added where no base span
touches them.
"""

import random
import string
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spokeline.functions.coerce import once
from spokeline.llm.boosting import Trees, fit

PRECISION = 0.95
#: The share of label 1 among candidates that the precision is computed for.
PRIOR = 0.2
#: Elements of an array that are handled at a time, code points of a piece of text and before a span.
CHUNK = 256
BLOCK = 512
CONTEXT = 16

# The given patterns. Possessive repeats and starts that can't lie inside a run keep long texts
# linear; the matches are the same.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "number": r"(?<![0-9])[0-9][\x20().0-9-]{5,}[0-9]",
    "secret": r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*+[0-9])[A-Za-z0-9_+/-]{12,}+",
}
BASE = ("email", "ip", "card", "phone")
ADDED = ("number", "secret")
_RANK = {kind: i for i, kind in enumerate(PATTERNS)}
# What a text must hold for a pattern to be worth trying.
_HINT = {
    "email": r"@",
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9][\x20-]?[0-9]",
    "phone": r"\+[0-9]",
    "number": r"[0-9]",
    "secret": r"[0-9]",
}
_CUE = r"(?i)(?:token|password|passwd|pwd|secret|key|auth)['\"\x20:=]{1,5}$"
_KEY = r"^(?:AKIA|ASIA|ghp_|xox[bp]-|sk_live_)"
_NUMBER_CUE = r"(?i)(?:phone|mobile|tel|fax|ssn|passport|account|iban)['\"\x20.:=#]{1,5}$"
FEATURES = 15
#: Where each of the features may be cut; those that follow are 0 or 1.
_CUTS = [
    [4],
    [8, 10, 12, 14, 16, 18, 20, 24, 32, 40, 64],
    [1, 2, 4, 6, 8, 9, 10, 12, 14, 15, 16, 19, 24, 32],
    [0, 2, 4, 6, 8, 12, 16, 24, 32],
    [0, 1, 2, 4, 8, 16],
    [0, 1, 2, 3, 4, 6, 8],
    [2, 4, 6, 8, 10, 12, 14, 16, 20, 24],
]
CUTS = [np.array(c, dtype=np.float64) for c in (*_CUTS, *[[0]] * (FEATURES - len(_CUTS)))]


def _hold(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _chunks(items: Column) -> Column:
    """The numbers of the chunks of an array that isn't empty."""
    return F.sequence(F.lit(0), F.floor((F.size(items) - 1) / CHUNK).cast("int"))


def _chunk(items: Column, number: Column) -> Column:
    return F.slice(items, number * CHUNK + 1, F.lit(CHUNK))


def _running(items: Column, both: Callable[[Column, Column], Column]) -> Column:
    """Running results of both over longs that aren't negative. items has to be a plain column.

    Chunks are appended whole, as an array grows by copying: the time stays close to linear."""
    start = F.struct(F.lit(0).cast("long").alias("last"), F.array().cast("array<array<bigint>>").alias("done"))

    def step(state: Column, number: Column) -> Column:
        within = F.aggregate(
            _chunk(items, number),
            F.array(state["last"]),
            lambda out, x: F.concat(out, F.array(both(F.element_at(out, -1), x))),
        )
        grown = lambda out: F.struct(
            F.element_at(out, -1).alias("last"),
            F.concat(state["done"], F.array(F.slice(out, F.lit(2), F.lit(CHUNK)))).alias("done"),
        )
        return _hold(within, grown)

    out = F.aggregate(_chunks(items), start, step, lambda state: F.flatten(state["done"]))
    return F.when(F.size(items) > 0, out).otherwise(F.array().cast("array<bigint>"))


def _below(starts: Column, bound: Column) -> Column:
    """How many of the ascending starts, a plain column, are below bound: a binary search."""
    halvings = F.sequence(F.lit(0), F.ceil(F.log2(F.size(starts) + 1.0)).cast("int"))

    def halve(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        right = F.get(starts, middle) < bound
        low = F.when(right, middle + 1).otherwise(state["low"])
        high = F.when(right, state["high"]).otherwise(middle)
        moved = F.struct(low.alias("low"), high.alias("high"))
        return F.when(state["low"] < state["high"], moved).otherwise(state)

    whole = F.struct(F.lit(0).alias("low"), F.size(starts).alias("high"))
    return F.aggregate(halvings, whole, halve, lambda state: state["low"])


def _blocks(text: Column) -> Column:
    """The text in pieces of BLOCK code points, from which parts are cut without counting from its start."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def _cut(blocks: Column, start: Column, end: Column) -> Column:
    """The code points from start up to end of the text in blocks, a plain column."""
    first, last = F.floor(start / BLOCK).cast("int"), F.floor(end / BLOCK).cast("int")
    piece = lambda number: F.coalesce(F.get(blocks, number), F.lit(""))
    at, rest = (start % BLOCK).cast("int") + 1, (end % BLOCK).cast("int")
    inside = F.substr(piece(first), at, (end - start).cast("int"))
    between = F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
    across = F.concat(F.substr(piece(first), at), between, F.substr(piece(last), F.lit(1), rest))
    return F.when(first == last, inside).otherwise(across)


def _found(text: Column, kind: str) -> Column:
    found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    return F.when(F.rlike(text, F.lit(_HINT[kind])), found).otherwise(F.array().cast("array<string>"))


def _steps(text: Column, kind: str) -> Column:
    """How far each match ends behind the one before. Reads the column of the matches."""
    found = F.col(f"found_{kind}")
    gaps = F.slice(F.split(text, PATTERNS[kind], -1), F.lit(1), F.size(found))
    steps = F.zip_with(gaps, found, lambda gap, match: (F.length(gap) + F.length(match)).cast("long"))
    return F.when(F.size(found) > 0, steps).otherwise(F.array().cast("array<bigint>"))


def _matches(kind: str) -> Column:
    """All matches of a kind: rank, kind, start and end in code points, found."""
    return F.zip_with(
        F.col(f"ends_{kind}"),
        F.col(f"found_{kind}"),
        lambda end, match: F.struct(
            F.lit(_RANK[kind]).alias("rank"),
            F.lit(kind).alias("kind"),
            (end - F.length(match)).alias("start"),
            end.alias("end"),
            match.alias("found"),
        ),
    )


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit is right; only for a bounded number of digits."""
    values = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((2 * c.cast("int")) % 10 + F.floor(2 * c.cast("int") / 10)),
    )
    return F.aggregate(values, F.lit(0).cast("long"), lambda total, v: total + v) % 10 == 0


def _valid(kind: str) -> Callable[[Column], Column]:
    """What a base match of a kind must fulfil besides its pattern."""

    def small(part: Column) -> Column:
        # Leading zeros don't count, and three digits are always a number.
        bare = F.regexp_replace(part, "^0+(?=[0-9])", "")
        return F.when(F.length(bare) <= 3, bare.cast("int") <= 255).otherwise(False)

    def test(span: Column) -> Column:
        digits = _digits(span["found"])
        if kind == "ip":
            return F.forall(F.split(span["found"], "\\."), small)
        if kind == "card":
            return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
        if kind == "phone":
            return F.length(digits).between(10, 15)
        return F.lit(True)

    return test


def with_candidates(docs: DataFrame) -> DataFrame:
    """row, a struct of the columns of docs, text (not null) of these, base, the validated spans in order,
    and loose, the proposed ones with the text around them and how they lie to base spans.

    Each select computes columns that the next one reads at least twice, so Spark doesn't merge them and
    compute a column again for every span; once() keeps filters above."""
    text = F.col("text")
    rows = docs.select(F.struct("*").alias("row"), "text", *(_found(text, k).alias(f"found_{k}") for k in PATTERNS))
    rows = rows.withColumns({f"steps_{k}": _steps(text, k) for k in PATTERNS})
    add = lambda a, b: a + b
    rows = rows.withColumns({f"ends_{k}": _running(F.col(f"steps_{k}"), add) for k in PATTERNS})
    base = F.concat(*(F.filter(_matches(kind), _valid(kind)) for kind in BASE))
    base = F.array_sort(F.transform(base, lambda s: F.struct(s["start"], s["rank"], s["kind"], s["end"])))
    rows = rows.select("row", "text", base.alias("base"), F.concat(*(_matches(k) for k in ADDED)).alias("loose"))
    rows = rows.select(
        "*",
        F.when(F.size("loose") > 0, _blocks(text)).alias("blocks"),
        F.transform("base", lambda s: s["start"]).alias("starts"),
        F.transform("base", lambda s: s["end"]).alias("ends"),
    )
    rows = rows.withColumn("tops", _running(F.col("ends"), F.greatest))
    starts, blocks = F.col("starts"), F.col("blocks")

    def placed(s: Column) -> Column:
        behind, start = _below(starts, s["end"]), s["start"]
        same = F.exists(
            F.slice("base", _below(starts, start) + 1, F.lit(len(BASE))),
            lambda b: (b["start"] == start) & (b["end"] == s["end"]),
        )
        some = F.size("tops") > 0
        touches = F.coalesce(F.get("tops", behind - 1) > start, F.lit(False))
        return F.struct(
            *(s[x].alias(x) for x in ("rank", "kind", "start", "end", "found")),
            _cut(blocks, F.greatest(start - CONTEXT, F.lit(0)), start).alias("before"),
            _cut(blocks, s["end"], s["end"] + 1).alias("after"),
            F.when(some, touches).otherwise(False).alias("touches"),
            F.when(some, same).otherwise(False).alias("same"),
        )

    return once(rows.select("row", "text", "base", F.transform("loose", placed).alias("loose")))


def _features(span: Column) -> list[Column]:
    """Of format: length, digits, letters and so on; of context: what stands before and after."""
    found, before, after = span["found"], span["before"], span["after"]
    count = lambda keep: F.length(F.regexp_replace(found, keep, ""))
    flag = lambda x: x.cast("int")
    digits = _digits(found)
    values = [
        span["rank"],
        F.length(found),
        count("[^0-9]"),
        count("[^A-Za-z]"),
        count("[^A-Z]"),
        count("[0-9A-Za-z]"),
        F.size(F.array_distinct(F.split(found, ""))),
        flag(F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False)),
        flag(F.rlike(found, F.lit("^[0-9a-f]+$"))),
        flag(F.rlike(found, F.lit("^[A-Z]{4}"))),
        flag(F.rlike(before, F.lit(_CUE))),
        flag(F.rlike(before, F.lit(_NUMBER_CUE))),
        flag(F.rlike(before, F.lit("[A-Za-z0-9+.@]$"))),
        flag(F.rlike(before, F.lit("['\"=:]$"))),
        flag(F.rlike(after, F.lit("^[A-Za-z0-9@]"))),
    ]
    return [x.cast("double") for x in values]


def _told(span: Column) -> Column:
    """Whether a telling context, or a key's prefix, gives a span away."""
    secret = F.rlike(span["before"], F.lit(_CUE)) | F.rlike(span["found"], F.lit(_KEY))
    return F.when(span["kind"] == "secret", secret).otherwise(F.rlike(span["before"], F.lit(_NUMBER_CUE)))


def _examples() -> list[str]:
    """Fixed texts with candidates of both labels, so that trees can be fitted on any table."""
    rnd = random.Random(8)
    some = lambda of, n: "".join(rnd.choice(of) for _ in range(n))
    mixed, digits = string.ascii_letters + string.digits, string.digits
    out = []
    for i in range(60):
        key, cue = f"{some(mixed, 15 + i % 20)}7", rnd.choice(["password=", "token: ", "secret = ", "auth "])
        out.append(cue + key)
        out.append(f"see {rnd.choice(['AKIA', 'ASIA', 'ghp_'])}{some(mixed, 16)}4 there")
        out.append(f"{rnd.choice(['phone ', 'tel. ', 'mobile: '])}{some(digits, 3)}-{some(digits, 3)}-{some(digits, 4)}")
        out.append(f"chapter section-{some(digits, 2)}-introduction of rev{some(digits, 2)}/overview/pages")
        out.append(f"from {1900 + i}-{1910 + i} to {some(digits, 3)} {some(digits, 3)} {some(digits, 3)} pieces")
        out.append(f"on {2000 + i % 25}-0{1 + i % 9}-1{i % 10} the {some('1234', 2)}.{some(digits, 3)}.{some(digits, 3)} cases")
    return out


def cells(marked: DataFrame) -> DataFrame:
    """(label, half, cell, n): how many loose spans of with_candidates() rows are in each cell of the grid.

    Equal spans count every time, all those in equal surroundings in the same half, which is drawn by a
    hash. A span that equals a base span, or that a telling context gives away, has label 1."""
    rows = marked.select(F.explode("loose").alias("span"))
    span = F.col("span")
    rows = rows.select(
        (span["same"] | _told(span)).cast("int").alias("label"),
        F.pmod(F.xxhash64(span["found"], span["before"], span["after"]), F.lit(2)).cast("int").alias("half"),
        F.array(*_features(span)).alias("features"),
    )
    cell = F.lit(0).cast("long")
    for i, cuts in enumerate(CUTS):
        value = F.col("features")[i]
        cell = cell * (len(cuts) + 1) + sum((value > float(c)).cast("int") for c in cuts)
    return rows.select("label", "half", cell.alias("cell")).groupBy("label", "half", "cell").agg(F.count("*").alias("n"))


def _inputs(cell: np.ndarray) -> np.ndarray:
    """For each cell, values of the features that lie in it."""
    out = []
    for cuts in reversed(CUTS):
        cell, place = np.divmod(cell, len(cuts) + 1)
        out.append(np.append(cuts, cuts[-1] + 1)[place])
    return np.stack(out[::-1], axis=1)


def train(marked: DataFrame) -> tuple[Trees, float]:
    """Trees for loose spans, and the least log odds that selects one.

    marked: with_candidates() rows. All their candidates count, and the examples do. One aggregate counts
    them, so what is handled here are cells of the grid, however many candidates they hold. Half of the
    candidates fit the trees; the precision is that on the others, where a label's candidates count for
    its share in PRIOR."""
    spark = marked.sparkSession
    examples = with_candidates(spark.createDataFrame([(x,) for x in _examples()], "text string"))
    counted = cells(marked).unionByName(cells(examples))
    table = np.array(sorted(tuple(row) for row in counted.collect()), dtype=np.int64)
    labels, inputs, counts = table[:, 0], _inputs(table[:, 2]), table[:, 3].astype(np.float64)
    half = table[:, 1] == 0
    trees = fit(inputs[half], labels[half], counts[half], CUTS)
    odds, truth, counts = trees.odds(inputs[~half]), labels[~half], counts[~half]
    shares = np.where(truth == 1, PRIOR, 1 - PRIOR)
    weights = shares * counts / np.where(truth == 1, max(counts[truth == 1].sum(), 1), max(counts[truth == 0].sum(), 1))
    order = np.argsort(-odds, kind="stable")
    right = np.cumsum((truth * weights)[order]) / np.cumsum(weights[order])
    last = np.append(odds[order][1:] != odds[order][:-1], True)  # a threshold can't part equal scores
    good = np.flatnonzero((right >= PRECISION) & last)
    return trees, float(odds[order][good[-1]]) if len(good) else float("inf")


def _apart(spans: Column) -> Column:
    """Of spans by start, a plain column, those that begin where the one kept before has ended, or later."""
    none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    rank = lambda s: F.when(s["kind"] == ADDED[0], _RANK[ADDED[0]]).otherwise(_RANK[ADDED[1]])
    bare = lambda s: F.struct(s["start"], rank(s).alias("rank"), s["kind"], s["end"])
    start = F.lit(0).cast("long").alias("last")

    def keep(state: Column, s: Column) -> Column:
        more = F.struct(s["end"].alias("last"), F.concat(state["kept"], F.array(bare(s))).alias("kept"))
        return F.when(s["start"] >= state["last"], more).otherwise(state)

    def step(state: Column, number: Column) -> Column:
        within = F.aggregate(_chunk(spans, number), F.struct(state["last"].alias("last"), none.alias("kept")), keep)
        grown = lambda x: F.struct(
            x["last"].alias("last"), F.concat(state["done"], F.array(x["kept"])).alias("done")
        )
        return _hold(within, grown)

    lists = F.array().cast("array<array<struct<start:bigint,rank:int,kind:string,end:bigint>>>").alias("done")
    out = F.aggregate(_chunks(spans), F.struct(start, lists), step, lambda state: F.flatten(state["done"]))
    return F.when(F.size(spans) > 0, out).otherwise(none)


def find_private(docs: DataFrame) -> DataFrame:
    """docs with spans, an array of (start, rank, kind, end) by start and kind, and base, those of
    the fixed formats; start and end count code points, end exclusive.

    docs: text string; other columns stay, but for spans and base, which are replaced. A null
    text becomes empty. Every base span stays; added ones neither touch a base span nor each other
    (the leftmost, of these the longest, stays). Long texts are searched whole, in time close to linear;
    repeated rows alike; an empty table gives an empty one."""
    docs = docs.drop("spans", "base")
    docs = docs.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    trees, least = train(with_candidates(docs.select("text")))

    def judged(s: Column) -> Column:
        told = _told(s)
        # The features of a span that its context tells aren't needed.
        features = F.when(~told, F.array(*_features(s)))
        return F.struct(s["start"], s["kind"], s["end"], told.alias("told"), features.alias("features"))

    def selected(s: Column) -> Column:
        return s["told"] | (trees.column([s["features"][i] for i in range(FEATURES)]) >= least)

    apart = F.transform(F.filter("loose", lambda s: ~s["touches"]), judged)
    added = F.transform(
        F.filter(apart, selected), lambda s: F.struct(s["start"], (-s["end"]).alias("back"), s["kind"], s["end"])
    )
    marked = with_candidates(docs).select("row", "base", F.array_sort(added).alias("added"))
    spans = F.when(F.size("added") > 0, F.array_sort(F.concat("base", _apart(F.col("added"))))).otherwise(F.col("base"))
    return marked.select("row.*", "base", spans.alias("spans"))


def redact(found: DataFrame) -> DataFrame:
    """find_private() rows with each stretch of spans in text replaced by the first one's kind."""
    rows = found.select(
        F.struct("*").alias("row"),
        "spans",
        F.when(F.size("spans") > 0, _blocks(F.col("text"))).alias("blocks"),
        F.transform("spans", lambda s: s["end"]).alias("ends"),
    )
    rows = rows.withColumn("tops", _running(F.col("ends"), F.greatest))
    blocks, tops = F.col("blocks"), F.col("tops")

    def piece(s: Column, i: Column) -> Column:
        before = F.coalesce(F.get(tops, i - 1), F.lit(0))
        shown = F.concat(_cut(blocks, before, s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.when(s["start"] >= before, shown).otherwise("")

    text = F.col("row.text")
    rest = _cut(blocks, F.element_at(tops, -1), F.length(text).cast("long"))
    cleared = F.concat(F.array_join(F.transform("spans", piece), ""), rest)
    cleared = F.when(F.size("spans") > 0, cleared).otherwise(text)
    return rows.select(*((cleared if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in found.columns))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op8_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_private(docs)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in BASE),
        F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )
