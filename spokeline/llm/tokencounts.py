"""Exact histogram of encoded document lengths, and what suffix sums over it answer."""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spokeline.llm.tokenizer import VOCABULARY, vocabulary
from spokeline.llm.words import slices

#: Lengths that one group of the suffix sums holds.
GROUP = 1024


def _lengths(build: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = build()
        for batch in slices(batches):
            counts = [len(encoding.encode_ordinary(text)) if text else 0 for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(counts, pa.int64())], ["n_tokens"])

    return run


def length_histogram(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """n_tokens and n_docs: how many texts have each encoded length; null and empty texts have 0.

    docs: text string; other columns are ignored and repeated rows all count. An empty table has an
    empty histogram. Texts are encoded whole, and tasks add up equal lengths before the shuffle."""
    texts = docs.select(F.col("text").cast("string"))
    lengths = texts.mapInArrow(_lengths(vocabulary(docs.sparkSession, path)), "n_tokens long")
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def with_suffix_sums(histogram: DataFrame) -> DataFrame:
    """The histogram with what holds for a context limit of n_tokens.

    docs_from and tokens_from: documents of at least this length, and their tokens;
    total_truncated: tokens if every document is cut to this length; total_fitting: tokens of the
    documents that fit; docs_fitting_share: share of documents that fit, whose smallest length at or
    above q is the q-quantile. Sums run inside groups of GROUP lengths and over the groups' totals,
    of which there are as many as the longest document has thousands of tokens.
    """
    grouped = histogram.withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    grouped = grouped.withColumn("part", F.floor(F.col("n_tokens") / GROUP))
    totals = grouped.groupBy("part").agg(F.sum("n_docs").alias("part_docs"), F.sum("tokens").alias("part_tokens"))
    after = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    totals = totals.select(
        "part",
        *(F.coalesce(F.sum(f"part_{c}").over(after), F.lit(0)).alias(f"{c}_after") for c in ("docs", "tokens")),
        *(F.sum(f"part_{c}").over(whole).alias(f"all_{c}") for c in ("docs", "tokens")),
    )
    inside = Window.partitionBy("part").orderBy(F.desc("n_tokens"))
    found = grouped.join(totals, "part")
    docs_from = F.sum("n_docs").over(inside) + F.col("docs_after")
    tokens_from = F.sum("tokens").over(inside) + F.col("tokens_after")
    found = found.withColumn("docs_from", docs_from).withColumn("tokens_from", tokens_from)
    longer_docs = F.col("docs_from") - F.col("n_docs")
    longer_tokens = F.col("tokens_from") - F.col("tokens")
    return found.select(
        "n_tokens",
        "n_docs",
        "docs_from",
        "tokens_from",
        (F.col("all_tokens") - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from")).alias("total_truncated"),
        (F.col("all_tokens") - longer_tokens).alias("total_fitting"),
        ((F.col("all_docs") - longer_docs) / F.col("all_docs")).alias("docs_fitting_share"),
    )


def truncated_totals(sums: DataFrame, limits: list[int]) -> DataFrame:
    """limit and total: the tokens left if every document is cut to any of these limits (0 or more).

    Read off the rows of with_suffix_sums: no length lies between a limit and the smallest one at or
    above it, so what that row's documents are cut to is all that differs. A limit beyond the longest
    document leaves all tokens; an empty table has none."""
    above = [F.when(F.col("n_tokens") >= limit, F.col("n_tokens")) for limit in limits]
    cut = [F.col("total_truncated") - (F.col("n_tokens") - limit) * F.col("docs_from") for limit in limits]
    every = F.max("total_fitting")
    totals = [F.coalesce(F.min_by(c, a), every, F.lit(0)) for c, a in zip(cut, above, strict=True)]
    return _listed(sums, limits, totals, "limit", "total")


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """share and n_tokens: the smallest length that this share of the documents does not exceed.

    Read off the rows of with_suffix_sums; null for an empty table."""
    found = [F.min(F.when(F.col("docs_fitting_share") >= share, F.col("n_tokens"))) for share in shares]
    return _listed(sums, shares, found, "share", "n_tokens")


def _listed(sums: DataFrame, given: list, found: list[Column], name: str, value: str) -> DataFrame:
    pairs = F.array(*(F.struct(F.lit(g).alias(name), f.cast("long").alias(value)) for g, f in zip(given, found, strict=True)))
    return sums.agg(pairs.alias("pairs")).select(F.inline("pairs"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_suffix_sums(length_histogram(spark.read.parquet(f"{sf_dir}/documents.parquet")))
