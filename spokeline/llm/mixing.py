"""A mix of sources to target weights, by a low-discrepancy schedule of equal blocks.

Each source's documents are shuffled and cut into blocks of equally many words. Slot t of the
schedule goes to the source whose share of [0, 1) holds frac(t * golden ratio): every stretch of the
schedule is as close to the targets as a sequence can be. The slots of a source are ranked, and slot
number r takes the source's block r, from the start again after the last one.
"""


from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spokeline.llm.components import stored
from spokeline.llm.words import count_words

WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
#: The schedule has about this many slots for each 100 % of all words, whatever their number.
BLOCKS = 1 << 17
#: Parts of a source or of the schedule that are summed on their own.
PARTS = 1024

GOLDEN = 0.6180339887498949


def running_sum(df: DataFrame, by: list[str], part: str, order: list, value: str, name: str) -> DataFrame:
    """df with the sum of value over the rows of by that stand before (part, then order).

    Sums run inside each part and over the parts' totals, so the rows of one key are not one task's."""
    totals = df.groupBy(*by, part).agg(F.sum(value).alias("_total"))
    earlier = Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_before", F.coalesce(F.sum("_total").over(earlier), F.lit(0))).drop("_total")
    inside = Window.partitionBy(*by, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = df.join(totals, [*by, part])
    return joined.withColumn(name, F.col("_before") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop("_before")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source_key, source_size) with position, weight and target of each source.

    Sources by code point, null last, weigh WEIGHTS in turn and share SHARE of all words. A target
    stops at REPEATS times its source's size; what is over goes to the others by weight until none
    is above. That is a common level per weight: sources fill up in the order of their room per
    weight, and the level is the first at which the rest can take their shares. The table has one
    row per source, and its windows read it in one task."""
    ordered = Window.orderBy(F.col("source_key").isNull(), "source_key")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.row_number().over(ordered) - 1) % len(WEIGHTS) + 1)
    rows = sizes.withColumn("weight", weight).withColumn("room", F.col("source_size") * REPEATS)
    filling = Window.orderBy(F.col("room") / F.col("weight"), F.col("source_key").isNull(), "source_key")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    left = F.sum("source_size").over(whole) * SHARE - F.coalesce(F.sum("room").over(before), F.lit(0))
    weights = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    rows = rows.withColumn("level", left / weights).withColumn("full", F.col("room") <= F.col("level") * F.col("weight"))
    level = F.max(F.when(~F.col("full"), F.col("level"))).over(whole)  # of the first that is not full
    target = F.when(F.col("full"), F.col("room")).otherwise(level * F.col("weight")).cast("double")
    return rows.withColumn("target", target).drop("room", "level", "full")


def golden_points(t: Column) -> Column:
    """frac(t * golden ratio) in two parts, so that large t keep their fraction."""
    high, low = F.floor(t / (1 << 20)), t % (1 << 20)
    point = high * ((GOLDEN * (1 << 20)) % 1.0) + low * GOLDEN
    return point - F.floor(point)


def schedule(targets: DataFrame) -> DataFrame:
    """(source, rank) with slot: the place in the mix of each block that a source gives.

    targets: source, need (blocks it gives). Slots that a source doesn't need
    are dropped; blocks that the golden points leave out follow at the end."""
    spark = targets.sparkSession
    whole = Window.partitionBy()
    upto = Window.orderBy("source").rowsBetween(Window.unboundedPreceding, -1)
    share = F.col("need") / F.sum("need").over(whole)
    low = F.coalesce(F.sum("need").over(upto), F.lit(0)) / F.sum("need").over(whole)
    ranges = targets.where("need > 0").select("source", "need", low.alias("low"), (low + share).alias("high"))
    # A point's cell meets only the sources that reach into the cell.
    cell = F.explode(F.sequence(F.floor(F.col("low") * PARTS), F.least(F.floor(F.col("high") * PARTS), F.lit(PARTS))))
    ranges = ranges.withColumn("cell", cell)
    n = targets.agg(F.sum("need")).first()[0] or 0
    slots = spark.range(n).withColumnRenamed("id", "slot").withColumn("point", golden_points(F.col("slot")))
    slots = slots.withColumn("cell", F.floor(F.col("point") * PARTS))
    slots = slots.join(ranges, "cell").where("point >= low AND point < high").select("source", "slot", "need")
    slots = slots.withColumn("part", F.floor(F.col("slot") * PARTS / max(n, 1))).withColumn("one", F.lit(1))
    ranked = running_sum(slots, ["source"], "part", ["slot"], "one", "rank").where("rank < need")
    ranked = stored(ranked.select("source", "rank", "slot"), "schedule")
    given = ranked.groupBy("source").agg(F.count("*").alias("given"))
    late = targets.join(given, "source", "left").withColumn("given", F.coalesce("given", F.lit(0)))
    late = late.where("given < need").select("source", F.explode(F.sequence("given", F.col("need") - 1)).alias("rank"))
    return ranked.unionByName(late.withColumn("slot", F.lit(n)))


def _sized(docs: DataFrame) -> DataFrame:
    texts = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string"))
    return texts.mapInArrow(count_words, "doc_id long, source string, size long")


def mix(docs: DataFrame) -> DataFrame:
    """What the mix takes: doc_id, source, size, source_size, target, taken, first_slot.

    docs: doc_id long, source string, text string; other columns are ignored. size is the number of
    words (null text: 0). A null source is a source of its own. taken counts the document's words in
    the mix with repeats, at most REPEATS times its size; a source's sum is its target rounded down.
    first_slot is the first place in the schedule at which the document appears, null if it doesn't.
    The shuffle is by a hash of doc_id, so the same input always gives the same mix; rows that share
    a doc_id (or have none) are told apart by size only and are taken alike, each as its own row.
    """
    sized = stored(_sized(docs), "sizes")
    order = F.xxhash64(F.lit("mix"), "doc_id", "size")
    sized = sized.withColumn("order", order).withColumn("part", F.shiftrightunsigned("order", 54))
    found = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumnRenamed("source", "source_key")
    total = found.agg(F.sum("source_size")).first()[0] or 0
    block = max(1, total // BLOCKS)
    targets = source_targets(found)
    # A number stands for the source from here on, so that the null source joins like any other.
    number = F.row_number().over(Window.orderBy(F.col("source_key").isNull(), "source_key"))
    targets = targets.withColumn("source", number)
    wanted, size = F.floor("target"), F.col("source_size")
    per_round = F.ceil(size / block)
    rounds = F.when(size > 0, F.floor(wanted / size)).otherwise(0)
    rest = wanted - rounds * size
    targets = stored(
        targets.withColumn("blocks", per_round)
        .withColumn("wanted", wanted)
        .withColumn("need", (rounds * per_round + F.ceil(rest / block)).cast("long")),
        "targets",
    )
    keys = targets.select("source_key", "source", "source_size", "target")
    docs_of = sized.join(keys, F.col("source_key").eqNullSafe(sized["source"])).select(
        "doc_id", sized["source"].alias("source_name"), "size", "order", "part", keys["source"], "source_size", "target"
    )
    placed = running_sum(docs_of, ["source"], "part", ["order", "doc_id", "size"], "size", "start")
    placed = stored(placed, "placed")
    last = F.floor((F.col("start") + F.col("size") - 1) / block)
    pieces = placed.where("size > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block), last)))
    slots = schedule(targets.select("source", "need"))
    slots = slots.join(targets.select("source", "blocks", "wanted", "source_size"), "source")
    turn = F.floor(F.col("rank") / F.col("blocks"))
    slots = slots.withColumn("block", F.col("rank") % F.col("blocks"))
    # The words [from, to) of the source that a slot takes; the last one may take less than a block.
    begin = F.col("block") * block
    left = F.col("wanted") - turn * F.col("source_size")
    slots = slots.select("source", "block", "slot", F.least(begin + block, left).alias("to"))
    taken = pieces.join(slots, ["source", "block"])
    overlap = F.least(F.col("start") + F.col("size"), F.col("to")) - F.greatest("start", F.col("block") * block)
    taken = taken.withColumn("words", F.greatest(overlap, F.lit(0))).where("words > 0")
    # No two documents with words start at the same place of a source.
    place = ["source", "start", "size"]
    taken = taken.groupBy(*place).agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"))
    return placed.join(taken, place, "left").select(
        "doc_id",
        F.col("source_name").alias("source"),
        "size",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0)).alias("taken"),
        "first_slot",
    )


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
