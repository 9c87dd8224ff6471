"""URL verdicts: fixed rules first, then boosted trees on lexical features.

Everything on the rows is a column expression. Corpus statistics of host endings are one
aggregation over all rows; the trees are fitted on a bounded sample and scored as CASE expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlog.llm import trees
from voltlog.llm.common import ascii_lower, bounded_sample, others, stored

# Words that mark a host as unwanted when they are one of its parts.
LISTED_WORDS = (
    "ads", "adult", "bets", "bingo", "casino", "cheap", "dating", "farm", "gambling", "lottery",
    "malware", "phishing", "pills", "poker", "porn", "sex", "slots", "spam", "torrent", "track",
    "viagra", "warez", "win", "xxx",
)

FEATURES = (
    "url_length", "host_length", "path_depth", "digit_ratio", "entropy", "parameters",
    "host_parts", "host_hyphens", "longest_part", "query_length", "ending_rows", "ending_share",
    "domain_rows", "domain_share",
)
#: A table of host endings up to this many rows (each below 300 bytes) is broadcast.
MOST_BROADCAST_ENDINGS = 100_000


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_verdict(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, both null if none fits."""
    rule = verdict = None
    for kind, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        domain, _, start = text.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(f"/{start}")
        rule = F.when(fits, F.lit(text)) if rule is None else rule.when(fits, F.lit(text))
        verdict = F.when(fits, F.lit(kind)) if verdict is None else verdict.when(fits, F.lit(kind))
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def listed(host: Column) -> Column:
    """Label 1 if a part of the host, between dots and hyphens, is a listed word."""
    words = F.array(*[F.lit(w) for w in LISTED_WORDS])
    return F.arrays_overlap(F.split(host, "[.-]"), words).cast("int")


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    size = F.length(text)

    def part(c: Column) -> Column:
        share = (size - F.length(F.replace(text, c))) / size
        return -share * F.log2(share)

    letters = F.filter(F.array_distinct(F.split(text, "")), lambda c: c != "")
    return F.when(size > 0, F.aggregate(letters, F.lit(0.0), lambda a, c: a + part(c))).otherwise(0.0)


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char)))


def lexical(rows: DataFrame) -> DataFrame:
    """Adds the features that need no other row; expects ``_url``, ``_host`` and ``_path``."""
    url, host = F.col("_url"), F.col("_host")
    parts = F.split(host, r"\.")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    length = F.length(url)
    return rows.select(
        "*",
        length.alias("url_length"),
        F.length(host).alias("host_length"),
        _count(F.col("_path"), "/").alias("path_depth"),
        (F.length(F.regexp_replace(url, "[^0-9]+", "")) / F.greatest(length, F.lit(1))).alias("digit_ratio"),
        F.round(_entropy(url), 6).alias("entropy"),
        F.when(query == "", 0).otherwise(_count(query, "&") + 1).alias("parameters"),
        F.size(parts).alias("host_parts"),
        _count(host, "-").alias("host_hyphens"),
        F.coalesce(F.array_max(F.transform(parts, F.length)), F.lit(0)).alias("longest_part"),
        F.length(query).alias("query_length"),
        F.substring_index(host, ".", -1).alias("_ending"),
        F.substring_index(host, ".", -2).alias("_domain"),
    )


def _ending_statistics(rows: DataFrame, column: str, prefix: str) -> DataFrame:
    """Rows and smoothed share of label 1 of every host ending, over all rows."""
    stats = rows.groupBy(column).agg(
        F.count(F.lit(1)).alias("_rows"), F.count("label").alias("_known"), F.sum("label").alias("_ones")
    )
    return stats.select(
        column,
        F.log2(F.col("_rows") + 1).alias(f"{prefix}_rows"),
        ((F.coalesce("_ones", F.lit(0)) + 1) / (F.col("_known") + 20)).alias(f"{prefix}_share"),
    )


def with_features(rows: DataFrame) -> DataFrame:
    """Adds all of ``FEATURES``; expects also a column ``label`` (0, 1 or null)."""
    out = lexical(rows)
    for column, prefix in (("_ending", "ending"), ("_domain", "domain")):
        stats = stored(_ending_statistics(out, column, prefix))
        if stats.count() <= MOST_BROADCAST_ENDINGS:
            stats = F.broadcast(stats)
        out = out.join(stats, column, "left")
    return out


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]],
    label: str | None = None,
    url: str = "url",
    sample_rows: int = 20_000,
    limit: float = 0.5,
) -> DataFrame:
    """``pages`` with host, path, rule, score and verdict (``allow`` or ``block``).

    A row gets the verdict of the longest rule that fits; without one, ``block`` if the trees
    give at least ``limit``. The column ``label`` says which urls are known as unwanted (1) or not
    (0, null: unknown); by default a listed word in the host. At most ``sample_rows`` rows of each label
    train the trees; the statistics of host endings cover all rows.

    A url that is null, empty or has no ``://`` has an empty host and path and gets the verdict
    of the trees on those. Repeated rows are judged alike; no rows give no rows. Existing columns
    with the names of the new ones are replaced.
    """
    kept = others(pages, ("host", "path", "rule", "score", "verdict"))
    source = pages.select(
        F.struct(*kept).alias("_row"),
        F.coalesce(F.col(url), F.lit("")).alias("_url"),
        host_of(F.col(url)).alias("_host"),
        path_of(F.col(url)).alias("_path"),
    )
    source = source.select(
        "_row", "_url", "_host", "_path",
        (listed(F.col("_host")) if label is None else F.col(f"_row.{label}").cast("int")).alias("label"),
    )
    known = source.drop("_row")
    featured = with_features(known)
    each = [
        bounded_sample(featured.where(F.col("label") == k), F.col("_url"), sample_rows).select(*FEATURES, "label")
        for k in (0, 1)
    ]
    score = trees.fit(stored(each[0].unionByName(each[1])), FEATURES, "label")
    rows = with_features(source)
    rows = rows.withColumn("score", score([F.col(f) for f in FEATURES]))
    rule, verdict = rule_verdict(F.col("_host"), F.col("_path"), rules)
    by_score = F.when(F.col("score") >= limit, F.lit("block")).otherwise(F.lit("allow"))
    return rows.select(
        "_row.*",
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        rule.alias("rule"),
        "score",
        F.coalesce(verdict, by_score).alias("verdict"),
    )
