"""The corpus pipeline: five stages from raw documents to a training mix.

Each stage is a function (spark, docs, sf_dir) -> DataFrame; all but the last return the columns of
documents, and further columns of docs are dropped. run() applies them in order, each on the written
result of the one before. A stage never loses or doubles rows by their doc_id: null and repeated ids
are as each docstring says. Texts are used whole, a null text counts as empty, and an empty table
gives an empty one.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spokeline.llm.components import stored
from spokeline.llm.contamination import contained_items
from spokeline.llm.mixing import mix
from spokeline.llm.neardups import near_duplicates
from spokeline.llm.private import find_private, redact
from spokeline.llm.quality import THRESHOLD, quality_model, score_quality

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model scores as good stay; every row is judged by its own text."""
    scored = score_quality(docs.select(COLUMNS), quality_model(spark, docs, sf_dir))
    return scored.where(F.col("score") >= THRESHOLD).select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the smallest doc_id stays; a document
    without a doc_id is in no class and stays. Rows that share a doc_id are one document, for which the
    smallest of their texts counts, and stay or go together."""
    copies = near_duplicates(docs).where("doc_id <> class_id").select("doc_id")
    return docs.select(COLUMNS).join(copies, "doc_id", "left_anti").select(COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go. Every row is judged by its own text, also those
    without a doc_id or with the same one: a 64-bit hash of doc_id and text stands for the row."""
    rows = docs.select(COLUMNS).withColumn("row", F.xxhash64("doc_id", "text"))
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    held = contained_items(rows.select(F.col("row").alias("doc_id"), "text"), items)
    held = held.select(F.col("doc_id").alias("row")).distinct()
    return rows.join(held, "row", "left_anti").select(COLUMNS)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row stays, with the personal data of its text replaced by the kind; n_chars is the new
    length."""
    cleared = redact(find_private(docs.select(COLUMNS)))
    return cleared.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with the words taken and the first place in the schedule.

    Rows are matched with the mix's by doc_id, source and size, all of which may be null or repeat, and
    by their number among the rows that have these in common: each row is in the result at most once."""
    alike = ["doc_id", "source", "size"]
    size = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    rows = docs.select(COLUMNS).withColumn("size", size)
    rows = rows.withColumn("n", F.row_number().over(Window.partitionBy(*alike).orderBy(F.xxhash64("text"))))
    order = Window.partitionBy(*alike).orderBy(F.desc("taken"), "first_slot")
    taken = mix(docs).withColumn("n", F.row_number().over(order)).where("taken > 0")
    key = [*alike, "n"]
    taken = taken.select(*(F.col(c).alias(f"_{c}") for c in key), "target", "taken", "first_slot")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key]
    both = rows.join(taken, same)
    return both.select(*COLUMNS, "size", "target", "taken", "first_slot")


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("private_data", private_data),
    ("mixing", mixing),
]

#: No SQL expresses the classifier, the sketches or the boosted trees.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
