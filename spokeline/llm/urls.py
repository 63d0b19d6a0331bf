"""URL filter: host and path rules, and boosted trees on lexical features where no rule fits."""

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spokeline.llm.boosting import Trees, fit
from spokeline.llm.components import stored

#: Labelled URLs that the trees are fitted on.
FIT_ROWS = 20000
THRESHOLD = 0.5
#: Labelled URLs' worth of the average that a suffix's own share is mixed with.
SMOOTHING = 10.0
#: Parts of the labelled URLs; a URL that trees are fitted on has the suffix statistics of the other parts.
FOLDS = 5

RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)

FEATURES = (
    "f_length f_host_length f_path_length f_depth f_labels f_longest_label f_digit_ratio f_hyphens f_entropy "
    "f_parameters f_query_length f_fragment f_escapes f_secure f_suffix_share f_suffix_count f_domain_share f_domain_count"
).split()


def with_parts(urls: DataFrame) -> DataFrame:
    """urls with host and path. Host: after the first :// up to /, ?, # or the end, A to Z in lower
    case; path: then up to ?, # or the end. Both are empty for null and without ://."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.substr("url", at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return urls.withColumn("host", F.coalesce(lower, F.lit(""))).withColumn("path", F.coalesce(path, F.lit("")))


def _fits(rule: str) -> Column:
    cut = rule.index("/")
    name, path = rule[:cut], rule[cut:]
    inside = (F.col("host") == name) | F.col("host").endswith(f".{name}")
    return inside & F.col("path").startswith(path)


def rule_of(rules: tuple) -> tuple[Column, Column]:
    """The longest fitting rule and what it says; null if none fits. Rules are a fixed list."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):
        rule = F.when(_fits(text), text).otherwise(rule)
        verdict = F.when(_fits(text), says).otherwise(verdict)
    return rule, verdict


def _count(text: Column, piece: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(piece), F.lit("")))


def _entropy(text: Column) -> Column:
    """Bits per character of the text's own character frequencies."""
    n = F.length(text)
    bits = F.transform(
        F.array_distinct(F.split(text, "")),
        lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n,
    )
    total = F.aggregate(bits, F.lit(0.0), lambda total, p: total - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    return F.when(n > 0, total).otherwise(0.0)


def _suffixes() -> list[Column]:
    """The last label of host, and the last two, with a dot before the only one."""
    return [F.substring_index("host", ".", -1), F.substring_index(F.concat(F.lit("."), F.col("host")), ".", -2)]


def _fold() -> Column:
    return F.pmod(F.xxhash64("url"), F.lit(FOLDS)).cast("int")


def with_features(parts: DataFrame, suffixes: DataFrame, average: float, without: Column) -> DataFrame:
    """parts (url, host, path) with the trees' features. suffixes and average: suffix_statistics(); of these,
    the rows that leave out the part without (-1: none)."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    labels = F.split(host, "\\.")
    query = F.regexp_extract(url, "\\?([^#]*)", 1)
    digits = F.length(F.regexp_replace(url, "[^0-9]", ""))
    values = {
        "f_length": F.length(url),
        "f_host_length": F.length(host),
        "f_path_length": F.length(path),
        "f_depth": _count(path, "/"),
        "f_labels": F.size(labels),
        "f_longest_label": F.array_max(F.transform(labels, F.length)),
        "f_digit_ratio": digits / F.greatest(F.length(url), F.lit(1)),
        "f_hyphens": _count(host, "-"),
        "f_entropy": _entropy(url),
        "f_parameters": F.when(F.length(query) > 0, _count(query, "&") + 1).otherwise(0),
        "f_query_length": F.length(query),
        "f_fragment": F.contains(url, F.lit("#")).cast("int"),
        "f_escapes": _count(url, "%"),
        "f_secure": F.startswith(url, F.lit("https:")).cast("int"),
    }
    rows = parts.withColumns(values).withColumn("without", without)
    share = F.lit(average)
    # The table grows with the labelled hosts, so Spark chooses the join by its size.
    for name, suffix in zip(("suffix", "domain"), _suffixes(), strict=True):
        known = suffixes.select("suffix", "without", F.col("n_bad").alias("known_bad"), F.col("n").alias("known_n"))
        rows = rows.withColumn("suffix", suffix).join(known, ["suffix", "without"], "left").drop("suffix")
        bad, n = F.coalesce("known_bad", F.lit(0)), F.coalesce("known_n", F.lit(0))
        rows = rows.withColumns({f"f_{name}_share": (bad + share * SMOOTHING) / (n + SMOOTHING), f"f_{name}_count": n})
        rows = rows.drop("known_bad", "known_n")
        share = F.col(f"f_{name}_share")
    return rows.drop("without")


def suffix_statistics(labelled: DataFrame) -> tuple[DataFrame, float]:
    """Of all labelled URLs: n_bad and n by suffix (last host label, or last two) and the part of the URLs left out
    (without; -1: none), and the average of bad. Counts are summed before a suffix meets its others."""
    rows = with_parts(labelled).select(F.explode(F.array(*_suffixes())).alias("suffix"), _fold().alias("fold"), "bad")
    counts = rows.groupBy("suffix", "fold").agg(F.sum("bad").alias("n_bad"), F.count("*").alias("n"))
    kept = counts.withColumn("without", F.explode(F.sequence(F.lit(-1), F.lit(FOLDS - 1)))).where("without <> fold")
    kept = kept.groupBy("suffix", "without").agg(F.sum("n_bad").alias("n_bad"), F.sum("n").alias("n"))
    kept = stored(kept, "suffixes")
    average = kept.where("without = -1").agg(F.sum("n_bad") / F.sum("n")).first()[0]
    return kept, 0.5 if average is None else float(average)


def train(labelled: DataFrame) -> tuple[Trees, DataFrame, float]:
    """Trees and suffix statistics from labelled URLs (url, bad: 1 is to be blocked). The statistics count all of
    them; the trees are fitted on the FIT_ROWS first by a hash of the URL, each with statistics of
    the parts it isn't in, so that its own label isn't among its features. Null labels don't count;
    without rows all is 0.5."""
    labelled = labelled.where("bad IS NOT NULL").select("url", F.col("bad").cast("int").alias("bad"))
    suffixes, average = suffix_statistics(labelled)
    chosen = with_parts(labelled.orderBy(F.xxhash64("url"), "url", "bad").limit(FIT_ROWS))
    rows = with_features(chosen, suffixes, average, _fold())
    rows = rows.select("bad", *(F.col(f).cast("double") for f in FEATURES)).collect()
    rows.sort()
    table = np.array([tuple(row) for row in rows], dtype=np.float64).reshape(-1, 1 + len(FEATURES))
    return fit(table[:, 1:], table[:, 0]), suffixes, average


def judge(urls: DataFrame, rules: tuple, model: tuple[Trees, DataFrame, float]) -> DataFrame:
    """urls (page_id, url; other columns are ignored) with host, path, rule, bad_share and verdict.

    verdict is the longest fitting rule's, else block where the trees' probability of a bad URL,
    bad_share, reaches THRESHOLD. A null url has an empty host and path, fits no rule and is judged
    by the features of an empty text. Every row of any length is judged, repeated rows alike; an empty table
    gives an empty one."""
    trees, suffixes, average = model
    rows = with_features(with_parts(urls.select("page_id", "url")), suffixes, average, F.lit(-1))
    rule, says = rule_of(rules)
    odds = trees.column([F.col(f).cast("double") for f in FEATURES])
    rows = rows.withColumn("bad_share", 1 / (1 + F.exp(-odds)))
    own = F.when(F.col("bad_share") >= THRESHOLD, "block").otherwise("allow")
    return rows.select("page_id", "url", "host", "path", rule.alias("rule"), "bad_share", F.coalesce(says, own).alias("verdict"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    # A page has the label of the document of its number: low quality is bad.
    labelled = pages.join(labels, pages["page_id"] == labels["doc_id"]).select(
        "url", (1 - F.col("quality")).alias("bad")
    )
    return judge(pages, RULES, train(labelled)).drop("url")
