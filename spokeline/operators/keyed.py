"""Latest rows per key, and keyed upserts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spokeline.session import estimated_size


def latest_one(
    df: DataFrame, keys: list[str], time: str, tie_break: list[str],
    known: DataFrame | None = None,
) -> DataFrame:
    """One row per key: the newest, a null time counting as newest, ties by tie_break.

    An aggregate, so every task hands on at most one row per key, however hot the key is. It sorts
    the rows it gets, so a hash aggregate finds the newest times first, and only rows that may have
    one get there: df is read twice. known has all keys that are wanted, one row each; when it is
    small enough to broadcast, so are the newest times, and else a Bloom filter of them.
    """
    if known is not None and fits_broadcast(known):
        df = _newest_rows(df, keys, time, known.select(*keys))
    else:
        if known is not None:
            df = df.join(known, keys, "left_semi")
        df = _perhaps_newest_rows(df, keys, time)
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(F.col(time).isNull().alias("unknown"), time, *tie_break)
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("row"))
    return newest.select(*keys, "row.*").select(*df.columns)


def _newest_rows(df: DataFrame, keys: list[str], time: str, known: DataFrame) -> DataFrame:
    """The rows of each known key that have its newest time; df is not shuffled."""
    maxima = df.groupBy(*keys).agg(
        F.max(F.col(time).isNull()).alias("_unknown"), F.max(time).alias("_newest")
    )
    wanted = F.broadcast(known.join(maxima, keys))
    is_newest = F.when(F.col("_unknown"), F.col(time).isNull()).otherwise(
        F.col(time) == F.col("_newest")
    )
    return df.join(wanted, keys).where(is_newest).select(*df.columns)


#: Bits of the filter, in words of 64: at most FILTER_BITS / 64 rows of two numbers are broadcast. With
#: k keys about k / FILTER_BITS of the other rows pass it too.
FILTER_BITS = 1 << 25


def _perhaps_newest_rows(df: DataFrame, keys: list[str], time: str) -> DataFrame:
    """The rows of each key that have its newest time, an unknown time being the newest, and a few more.

    The newest times set bits of a Bloom filter, whose words are the rows of a small table; a row
    passes if its own bit is set. df is not shuffled but for one time per key and task."""
    maxima = df.groupBy(*keys).agg(
        F.max(F.col(time).isNull()).alias("_unknown"), F.max(time).alias("_newest")
    )
    newest = F.when(~F.col("_unknown"), F.col("_newest"))
    words = maxima.select(_bit(keys, newest).alias("_bit")).groupBy(
        F.shiftright("_bit", 6).alias("_word")
    ).agg(F.bit_or(_mask()).alias("_set"))
    marked = df.withColumn("_bit", _bit(keys, F.col(time))).withColumn("_word", F.shiftright("_bit", 6))
    passed = marked.join(F.broadcast(words), "_word")
    return passed.where(F.col("_set").bitwiseAND(_mask()) != 0).select(*df.columns)


def _bit(keys: list[str], time: Column) -> Column:
    return F.pmod(F.xxhash64(*keys, time), F.lit(FILTER_BITS))


def _mask() -> Column:
    return F.expr("shiftleft(1L, CAST(_bit & 63 AS INT))")


def latest_with_ties(
    df: DataFrame, keys: list[str], time: str, dimension: DataFrame | None = None
) -> DataFrame:
    """All rows whose time is the maximum of their key; rows without a time never match.

    The maxima come from a hash aggregate and are joined back, so the rows of a hot key stay
    spread over their tasks. dimension has one row per key; its columns are joined on, and a
    dimension small enough to broadcast bounds the maxima too: then df is never shuffled.
    """
    newest = df.groupBy(*keys).agg(F.max(time).alias(time))
    if dimension is None:
        return df.join(newest, [*keys, time]).select(*df.columns)
    extra = [c for c in dimension.columns if c not in keys]
    newest = dimension.join(newest, keys)
    if fits_broadcast(dimension):
        newest = F.broadcast(newest)
    return df.join(newest, [*keys, time]).select(*df.columns, *extra)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Catalyst expects df to be below the broadcast threshold of the session."""
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    return estimated_size(df) <= conf.autoBroadcastJoinThreshold()


def fold(
    changes: DataFrame, keys: list[str], order: list[str], keep_first: list[str] = ()
) -> DataFrame:
    """The table a log of upserts amounts to: per key the newest value of every column.

    Columns in keep_first are set by the first change of a key and never updated.
    """
    return _fold(changes, changes.columns, keys, F.struct(*order), keep_first)


def upsert(
    base: DataFrame,
    changes: DataFrame,
    keys: list[str],
    order: list[str],
    keep_first: list[str] = (),
) -> DataFrame:
    """base with the changes applied: insert new keys, update the others.

    order is the order of the changes among themselves; all of them come after base, which has
    at most one row per key.
    """
    before_all = [F.lit(None).cast(changes.schema[c].dataType).alias(c) for c in order]
    after = [F.col(c) for c in order]
    both = base.withColumn("_order", F.struct(F.lit(0), *before_all)).unionByName(
        changes.select(*base.columns, F.struct(F.lit(1), *after).alias("_order"))
    )
    return _fold(both, base.columns, keys, F.col("_order"), keep_first)


def without_keys(rows: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose keys (never null) changes does not have. rows in buckets of a key stay where they
    are: only the keys of changes are broadcast or shuffled, and nothing is aggregated."""
    return rows.join(changes.select(*keys), keys, "left_anti").select(*rows.columns)


def newest_changes(
    base: DataFrame, newest: DataFrame, keys: list[str], keep_first: list[str]
) -> DataFrame:
    """The newest changes, one row per key, with the columns in keep_first as base has them, if it does."""
    kept = base.select(*keys, F.struct(*keep_first).alias("_kept"))
    both = newest.join(kept.join(newest.select(*keys), keys, "left_semi"), keys, "left")
    stored = F.col("_kept").isNotNull()
    return both.select(
        *[F.when(stored, F.col(f"_kept.{c}")).otherwise(F.col(c)).alias(c) if c in keep_first else c
          for c in newest.columns]
    )


def _fold(
    changes: DataFrame, columns: list[str], keys: list[str], sequence: Column,
    keep_first: list[str],
) -> DataFrame:
    updated = [c for c in columns if c not in (*keys, *keep_first)]
    values = [F.max_by(F.struct(*updated), sequence).alias("updated")]
    if keep_first:
        values.append(F.min_by(F.struct(*keep_first), sequence).alias("kept"))
    folded = changes.groupBy(*keys).agg(*values)
    return folded.select(*keys, *[f"{v}.*" for v in ("updated", "kept")[: len(values)]]).select(
        *columns
    )
