"""URL rules by a sort-merge range join.

A rule (host, path) fits its host and all subdomains where the path starts with the rule's.  Its
canonical key is the host's labels reversed, a separator, and the path: everything it fits under
that very host is the interval of keys that start with it.  A URL gives one key for each of its
host's suffixes, so prefixes are all that is left to match.  Keys of rules and URLs are dealt to
ranges, each rule to every range its interval meets, and one sorted sweep of each range keeps a
stack of the rules that are open: as intervals of prefixes are nested or apart, its top is the
longest rule at each key.  The longest rule over a URL's keys decides (host and path together;
then the longer host; then block before allow).

Distinct (host, path) pairs are matched, so a page address that a third of the rows share is one
row of the sweep.  Bounds between ranges come from a sample of keys and change cost only; equal
keys are told apart by a hash, so a very common key is spread over several ranges.  At most as
many rules as a key has characters are open at a bound, which bounds their copies.

Defined results: a null address or one without ``://`` has an empty host and path, which no rule
fits; without a fitting rule the verdict is the default and the rule null.  Null hosts of rules
are ignored, null paths are empty.  Repeated rows stay repeated.  Other columns are ignored.
"""

from __future__ import annotations

import string
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwatch.sources.staging import stage

SEPARATOR = "\x01"  # sorts before any character of a host
LAST = "\U0010ffff"


def lowered(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty if there is none."""
    return lowered(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    found = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(found, F.lit(""))


def _reversed(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def _suffix_keys(host: Column, path: Column) -> Column:
    """A key for each suffix of the host."""
    labels = F.reverse(F.split(host, r"\."))
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit(SEPARATOR), path),
    )


def _sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Longest open rule at each key; rows come by range, key, and rules before addresses."""
    open_rules: list[tuple] = []
    at_range = None
    for batch in batches:
        found = []
        for row in batch.itertuples(index=False):
            if row.range != at_range:
                open_rules, at_range = [], row.range
            while open_rules and not row.key.startswith(open_rules[-1].key):
                open_rules.pop()
            if row.is_rule:
                open_rules.append(row)
            elif open_rules:
                rule = open_rules[-1]
                found.append((row.host, row.path, rule.host, rule.path, rule.verdict))
        yield pd.DataFrame(found, columns=["host", "path", "rule_host", "rule_path", "verdict"])


def judge(
    pages: DataFrame,
    rules: DataFrame,
    *,
    key: str = "page_id",
    url: str = "url",
    default: str = "allow",
    ranges: int | None = None,
) -> DataFrame:
    """(``key``, host, path, rule, verdict) for every row; ``rules`` has host, path, verdict."""
    spark = pages.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    address = pages.select(
        F.col(key).alias("page"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")
    )
    points = address.select("host", "path").distinct()
    points = points.withColumn("key", F.explode(_suffix_keys(F.col("host"), F.col("path"))))
    points = stage(points.withColumn("salt", F.xxhash64("host", "path")), "keys")
    total = points.count()
    share = min(1.0, 30 * ranges / max(total, 1))
    sample = sorted(
        (r["key"], r["salt"]) for r in points.sample(share, seed=7).select("key", "salt").collect()
    )
    step = max(1, len(sample) // ranges)
    bounds = sorted(set(sample[step::step]))

    def of_keys(keys: pd.Series, salts: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(bounds, pair) for pair in zip(keys, salts)], dtype="int64")

    of_keys.__annotations__ = {"keys": pd.Series, "salts": pd.Series, "return": pd.Series}

    def of_rules(keys: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "first": [bisect_left(bounds, (k, -(2**63))) for k in keys],
                "last": [bisect_right(bounds, (k + LAST, 2**63)) for k in keys],
            }
        )

    of_rules.__annotations__ = {"keys": pd.Series, "return": pd.DataFrame}
    dealt = points.select(
        F.pandas_udf(of_keys, "long")("key", "salt").alias("range"),
        "key", F.lit(False).alias("is_rule"), "host", "path", F.lit("").alias("verdict"),
    )
    tidy = rules.where(F.col("host").isNotNull()).select(
        lowered(F.col("host")).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
        F.col("verdict").alias("verdict"),
    )
    tidy = tidy.distinct().withColumn(
        "key", F.concat(_reversed(F.col("host")), F.lit(SEPARATOR), F.col("path"))
    )
    spans = tidy.withColumn("span", F.pandas_udf(of_rules, "first long, last long")("key"))
    copied = spans.select(
        F.explode(F.sequence(F.col("span.first"), F.col("span.last"))).alias("range"),
        "key", F.lit(True).alias("is_rule"), "host", "path", "verdict",
    )
    swept = (
        copied.union(dealt)
        .repartition(ranges, "range")
        .sortWithinPartitions("range", "key", F.desc("is_rule"), "verdict")
        .mapInPandas(
            _sweep, "host string, path string, rule_host string, rule_path string, verdict string"
        )
    )
    rank = F.struct(
        (F.char_length("rule_host") + F.char_length("rule_path")).alias("length"),
        F.char_length("rule_host").alias("host_length"),
        F.col("verdict").alias("verdict"),  # block sorts after allow
        F.concat("rule_host", "rule_path").alias("rule"),
    )
    best = swept.groupBy("host", "path").agg(F.max(rank).alias("best"))
    return address.join(best, ["host", "path"], "left").select(
        F.col("page").alias(key),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
