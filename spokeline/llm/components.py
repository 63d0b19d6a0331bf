"""Connected components, and tables written between steps."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spokeline.session import work_folder

#: Parts that the rows of a key are spread over in a join.
SALTS = 16


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared work folder and read again: later steps don't repeat the work."""
    spark = df.sparkSession
    folder = work_folder(spark, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def looked_up(rows: DataFrame, table: DataFrame, key: str, spread: str) -> DataFrame:
    """rows with the columns of table, which has at most one row per key: a left join.

    The rows of a key are dealt into SALTS parts by a hash of the column spread, so a task never has
    to take all rows of a hot key. table is repeated SALTS times and should hold only keys worth it."""
    parts = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    return rows.join(parts, [key, "salt"], "left").drop("salt")


def components(links: DataFrame) -> DataFrame:
    """id and class_id (the smallest id it is connected with) of all ends of the links (a, b).

    Large-star and small-star steps in turn: each links the neighbours of an id to the smallest of
    them. The longest path halves about every round; no step gathers the neighbours of an id, and
    those of the centre of a large star are spread over tasks.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    edges = stored(edges, "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Only ids with a larger neighbour, such as a star's centre, hand their smallest on.
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("top")).where("top > u")
        least = least.select("u", F.least("m", "u").alias("m"))
        large = looked_up(both.where("v > u"), least, "u", "v").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u > v").distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        after = stored(small.where("u > v").distinct(), "small")
        same = after.count() == edges.count() and after.join(edges, ["u", "v"], "left_anti").isEmpty()
        edges = after
        if same:
            break
    stars = edges.select(F.col("u").alias("id"), F.col("v").alias("class_id"))
    return stars.unionByName(stars.select(F.col("class_id").alias("id"), "class_id").distinct())
