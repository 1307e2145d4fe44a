"""Spelling variants: words one edit apart, found by walking a distributed trie.

Words that differ by one inserted, deleted or replaced character are *near*.  The words, read
forwards and backwards, are cut into an edge table (reading, node, char): a node is the prefix it
stands for, and an edge knows which lengths lie beyond it and which characters come next.  A state
is (word, position, node, edits).  The frontier advances level by level: states at a node are
joined with its edges; one without edits may take another character than the word's own (a
replacement) or one besides it (an insertion), one with an edit must follow its word.  A state
that has used up its word at the end of a word is a neighbour.

Edits are made in the second half of a reading only.  The other half of all pairs is met by the
reading from the other end, so no state ever fans out at the crowded nodes near the root.  A
deletion is the other side of an insertion and a replacement is found from the lesser word.  A
node has at most as many edges as the alphabet has characters, so a join makes no pairs of states.

Levels are joins, so they are kept to ``DEPTH``; of words longer than that, which no walk of joins
would end on, pairs are found by an equal result of deleting one character, and are then verified.
At most alphabet x length words share such a result.

Defined results: null texts have no words; a null key counts as an empty one; repeated rows count
again; no words give no rows; ties between forms go to the lesser word in code-point order.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwatch.sources.staging import stage

LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DEPTH = 32  # levels of the trie
_PRIME, _BASE = (1 << 61) - 1, 1_000_003


def word_counts(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", least_chars: int = 6,
    least_count: int = 5, damage: int | None = None,
) -> DataFrame:
    """(word, n): runs of letters, A-Z lowered, that are long and frequent enough.

    With ``damage`` a character is deleted from each run of which ``<key>:<run>`` has a CRC-32
    divisible by it: the one at CRC-32 modulo length.
    """
    owner = F.coalesce(F.col(key).cast("string"), F.lit(""))
    runs = F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(LETTERS), F.lit(0))
    rows = docs.select(owner.alias("owner"), F.explode(runs).alias("run"))
    if damage is None:
        rows = rows.select(F.col("run").alias("word"))
    else:
        rows = rows.withColumn("h", F.crc32(F.concat_ws(":", "owner", "run").cast("binary")))
        at = (F.col("h") % F.char_length("run")).cast("int")
        cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
        rows = rows.select(F.when(F.col("h") % damage == 0, cut).otherwise(F.col("run")).alias("word"))
    counted = rows.where(F.char_length("word") >= least_chars).groupBy("word")
    return counted.agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _bit(number: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), number.cast("int"))


def _has(mask: str, number: Column) -> Column:
    return F.col(mask).bitwiseAND(_bit(number)) != 0


def _char(word: str, at: Column) -> Column:
    """The character at a position (from 0), empty beyond the end."""
    return F.substring(word, at + 1, F.lit(1))


def _edges(read: DataFrame) -> DataFrame:
    """(reading, node, char, depth, lengths, nexts) of ``read`` (reading, word, size).

    ``lengths`` has a bit for each number of characters that can follow the edge to the end of a
    word, ``nexts`` one for the character (modulo 64) that can come next.  A word adds edges from the
    middle of a word one shorter on; no state asks for earlier ones.
    """
    depth = F.explode(F.sequence(F.expr("(size - 1) div 2").cast("int"), F.col("size") - 1)).alias("depth")
    steps = read.select("reading", "word", "size", depth)
    following = F.ascii(_char("word", F.col("depth") + 1)) % 64
    return steps.groupBy(
        "reading",
        F.substring("word", F.lit(1), F.col("depth")).alias("node"),
        _char("word", F.col("depth")).alias("char"),
        "depth",
    ).agg(
        F.bit_or(_bit(F.col("size") - F.col("depth") - 1)).alias("lengths"),
        F.bit_or(
            F.when(F.col("depth") + 1 < F.col("size"), _bit(following)).otherwise(F.lit(0).cast("long"))
        ).alias("nexts"),
    )


def _moved(steps: DataFrame, depth: int) -> DataFrame:
    """States after a step, without those that can reach no end; done where the word is used up."""
    left = F.col("size") - F.col("position")
    node = F.concat("node", "char")
    live = steps.where(_has("lengths", left)).where(
        (left == 0) | _has("nexts", F.ascii(_char("word", F.col("position"))) % 64)
    )
    return live.select(
        "reading", "word", "size", "position", node.alias("node"), (left == 0).alias("done")
    ).withColumn("depth", F.lit(depth + 1))


def _walked(words: DataFrame, depth: int) -> DataFrame:
    """(a, b) of near words of at most ``depth`` characters; some pairs are met twice."""
    one = words.select("word", F.char_length("word").alias("size")).where(F.col("size") <= depth)
    read = one.select(F.lit(0).alias("reading"), "word", "size").union(
        one.select(F.lit(1), F.reverse("word"), "size")
    )
    read = stage(read, "read")
    sizes = read.agg(F.min("size").alias("low"), F.max("size").alias("high")).first()
    if sizes["high"] is None:
        return words.select(F.col("word").alias("a"), F.col("word").alias("b")).limit(0)
    edges = stage(_edges(read).repartition("reading", "node").sortWithinPartitions("depth"), "edges")
    found, current = [], None
    for level in range(sizes["low"] // 2, sizes["high"] + 1):
        here = edges.where(F.col("depth") == level).drop("depth")
        fresh = read.where((F.expr("size div 2") <= level) & (F.col("size") >= level))
        fresh = fresh.withColumn("node", F.substring("word", F.lit(1), F.lit(level)))
        own = _char("word", F.lit(level))
        tried = (
            fresh.join(here, ["reading", "node"])
            .where(F.col("char") != own)
            .withColumn("step", F.explode(F.array(F.lit(0), F.lit(1))))
            .where((F.col("step") == 0) | ((own != "") & (F.col("char") > own)))
            .withColumn("position", F.col("step") + level)
        )
        columns = ["reading", "word", "size", "position", "node", "char", "lengths", "nexts"]
        steps = tried.select(*columns)
        if current is not None:
            waiting = current.where(~F.col("done")).withColumn("char", _char("word", F.col("position")))
            followed = waiting.drop("depth").join(here, ["reading", "node", "char"])
            steps = steps.union(
                followed.withColumn("position", F.col("position") + 1).select(*columns)
            )
        current = stage(_moved(steps, level), f"level{level}")
        found.append(current.where("done"))
    ends = reduce(DataFrame.union, found)
    forwards = F.col("reading") == 0
    return ends.select(
        F.when(forwards, F.col("word")).otherwise(F.reverse("word")).alias("a"),
        F.when(forwards, F.col("node")).otherwise(F.reverse("node")).alias("b"),
    )


def deletions(word: str) -> list[int]:
    """Hashes of a word and of each result of deleting one of its characters."""
    ends = [0]
    for c in reversed(word):  # ends[k]: of the last k characters
        ends.append((ord(c) * pow(_BASE, len(ends) - 1, _PRIME) + ends[-1]) % _PRIME)
    power, powers = 1, [1]
    for _ in word:
        power = power * _BASE % _PRIME
        powers.append(power)
    start, out = 0, [ends[-1]]
    for i, c in enumerate(word):
        rest = len(word) - i - 1
        out.append((start * powers[rest] + ends[rest]) % _PRIME)
        start = (start * _BASE + ord(c)) % _PRIME
    return sorted(set(out))


def _through_deletions(words: DataFrame) -> DataFrame:
    """(a, b) of near words among ``words``, by what deleting one character leaves."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for word in batch["word"].tolist():
                yield pd.DataFrame({"key": deletions(word)}).assign(word=word)[["word", "key"]]

    keys = words.select("word").mapInPandas(run, "word string, key long")
    pairs = keys.select("key", F.col("word").alias("a")).join(
        keys.select("key", F.col("word").alias("b")), "key"
    )
    return pairs.where("a < b").select("a", "b").distinct().where(F.levenshtein("a", "b", 1) == 1)


def near_pairs(words: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(a, b), both ways and once each, for near words of ``words`` (distinct words)."""
    long_ = words.where(F.char_length("word") >= depth)
    met = _walked(words, depth).union(_through_deletions(long_))
    return met.select("a", "b").union(met.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


def forms(words: DataFrame, *, times: int = 5, depth: int = DEPTH) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of ``words`` (word, n).

    A word's form is its near word of largest n if that is at least ``times`` its own n; the root
    is where following forms ends (each is ``times`` as frequent as the one before, so they end).
    """
    words = stage(words.select("word", "n"), "words")
    pairs = near_pairs(words, depth)
    other = words.select(F.col("word").alias("b"), F.col("n").alias("m"))
    best = pairs.join(other, "b").groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "b")).alias("best")
    )
    joined = words.join(best, "word", "left")
    enough = -F.col("best.m") >= times * F.col("n")
    formed = stage(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(enough, F.col("best.b")).alias("form"), F.when(enough, -F.col("best.m")).alias("form_n"),
        ),
        "formed",
    )
    # each round doubles the number of forms followed
    current = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        onward = current.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        current = current.join(onward, "root", "left").select(
            "word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved")
        )
        current = stage(current, "roots")
        if current.where("moved").isEmpty():
            break
        current = current.drop("moved")
    return formed.join(current.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
