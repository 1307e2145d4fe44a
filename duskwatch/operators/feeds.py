"""Filters whose values come as a table: ranges and patterns by the thousand.

The filters of ``operators.filters`` turn every value into a literal of the plan, which is right
for a handful.  Here the values stay rows, and rows of the log meet them by joins on keys that
both sides can compute; what meets is then checked exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from duskwatch.functions.literals import column_type, quoted

COARSE = 256  # stretches in which overlapping ranges are united
GRAM = 3
SIZES = (GRAM, 4, 5, 6, 8, 12, 16)  # of the pieces under which patterns are filed
CROWD = 16  # patterns of a piece that are sent to its values, or more for long values
PARTS = 16  # into which the values of a larger crowd are dealt
STRETCH = 256  # characters of a value that are cut at a time
WORDS = 1 << 18  # of 64 marks each, that tell which pieces can be filed
BINARY = "UTF8_BINARY"
_BREAK = "\x01"


# --- ranges --------------------------------------------------------------------------------

def _position(column: Column, kind: T.DataType) -> Column:
    """A double that never falls where the value rises."""
    if isinstance(kind, T.TimestampNTZType):
        clock = F.hour(column) * 3600 + F.minute(column) * 60 + F.second(column)
        return (F.datediff(column, F.lit("1970-01-01").cast("date")) * F.lit(86400.0) + clock).cast("double")
    if isinstance(kind, T.DateType):
        return F.datediff(column, F.lit("1970-01-01").cast("date")).cast("double")
    if isinstance(kind, (T.TimestampType, T.NumericType)):
        return column.cast("double")
    raise ValueError(f"ranges of {kind.simpleString()} have no positions")


def united_ranges(ranges: DataFrame, low: str = "low", high: str = "high") -> DataFrame:
    """(low, high, low_at, high_at, start, width): ranges without overlap that cover the same.

    The span of all ranges is cut into ``COARSE`` stretches; within each, ranges that overlap are
    joined to one (a running maximum of the ends so far tells where a gap is).  A range that
    reaches over several stretches has a piece in each.  ``start`` and ``width`` describe bins
    of which the pieces fill about two each, ``*_at`` are positions of the ends.  Ranges with
    a null end or with ``high`` under ``low`` hold nothing.
    """
    kind = column_type(ranges, low)
    given = ranges.select(
        F.col(low).alias("low"), F.col(high).cast(kind).alias("high"),
        _position(F.col(low), kind).alias("low_at"), _position(F.col(high).cast(kind), kind).alias("high_at"),
    ).where("low <= high")
    span = given.agg(
        F.struct(F.min("low_at").alias("low"), F.max("high_at").alias("high"), F.count("*").alias("n"))
    ).scalar()
    start, long_ = span.getField("low"), span.getField("high") - span.getField("low")
    wide = F.greatest(long_ / COARSE, F.lit(1e-9))

    def stretch(at: str) -> Column:
        return F.floor((F.col(at) - start) / wide)

    pieces = given.withColumn("stretch", F.explode(F.sequence(stretch("low_at"), stretch("high_at"))))
    earlier = Window.partitionBy("stretch").orderBy("low", F.desc("high"))
    reached = F.max("high").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    opened = F.when(reached.isNull() | (F.col("low") > reached), 1).otherwise(0)
    marked = pieces.withColumn("opened", opened)
    islands = marked.withColumn("island", F.sum("opened").over(earlier.rowsBetween(Window.unboundedPreceding, 0)))
    joined = islands.groupBy("stretch", "island").agg(
        F.min("low").alias("low"), F.max("high").alias("high"),
        F.min("low_at").alias("low_at"), F.max("high_at").alias("high_at"),
    )
    # bins of a stretch are only filled from that stretch, so clip what reaches over it
    first, last = start + F.col("stretch") * wide, start + (F.col("stretch") + 1) * wide
    return joined.select(
        "low", "high", F.greatest("low_at", first).alias("low_at"), F.least("high_at", last).alias("high_at"),
        start.alias("start"), F.greatest(long_ / F.greatest(span.getField("n"), F.lit(1)), F.lit(1e-9)).alias("width"),
    )


def filter_column_by_range_table(
    df: DataFrame, column: str, ranges: DataFrame, low: str = "low", high: str = "high"
) -> DataFrame:
    """Rows whose value lies in some range of a table, ends included, each row once.

    An interval semi-join: ranges are united, cut into bins and met on the bin; the value itself
    is then compared with the ends.  Repeated, nested and touching ranges change nothing; null
    values are in no range.
    """
    kind = column_type(df, column)
    typed = ranges.select(F.col(low).cast(kind).alias("low"), F.col(high).cast(kind).alias("high"))
    united = united_ranges(typed)
    settings = united.agg(F.struct(F.first("start").alias("start"), F.first("width").alias("width"))).scalar()

    def bin_of(at: Column, start: Column, width: Column) -> Column:
        return F.floor((at - start) / width)

    bins = F.sequence(
        bin_of(F.col("low_at"), F.col("start"), F.col("width")) - 1,
        bin_of(F.col("high_at"), F.col("start"), F.col("width")) + 1,  # rounding at a bin's edge
    )
    kept = united.select(F.col("low").alias("__low"), F.col("high").alias("__high"), F.explode(bins).alias("__bin"))
    value = F.col(quoted(column))
    placed = df.withColumn(
        "__bin", bin_of(_position(value, kind), settings.getField("start"), settings.getField("width"))
    )
    inside = (placed["__bin"] == kept["__bin"]) & value.between(F.col("__low"), F.col("__high"))
    return placed.join(kept, inside, "left_semi").drop("__bin")


# --- patterns ------------------------------------------------------------------------------

def required_texts(pattern: Column) -> Column:
    """Texts of at least ``GRAM`` characters that every match of a regular expression contains.

    Conservative: escapes, classes, groups, wildcards and what is repeated or optional end a
    piece; alternatives outside groups, inline flags, quoting and what cannot be read give none.
    """
    unsafe = pattern.rlike(r"\\[QEcxuNkpP0-9]|\(\?[a-zA-Z-]|\(\?#|[\x01\r\n]")
    text = F.regexp_replace(pattern, r"(?s)\\.", _BREAK)
    for _ in range(2):
        text = F.regexp_replace(text, r"\[\^?\]?[^\[\]]*\]", _BREAK)
    for _ in range(8):
        text = F.regexp_replace(text, r"\([^()]*\)", _BREAK)
    unread = text.rlike(r"[\[\]()|\\]")
    text = F.regexp_replace(text, r"(?s).(?:[?*]|\{[^}]*\})", _BREAK)
    text = F.regexp_replace(text, r"[?*+.^${}]", _BREAK)
    pieces = F.filter(F.split(text, _BREAK), lambda p: F.char_length(p) >= GRAM)
    return F.when(~unsafe & ~unread, pieces).otherwise(F.array().cast("array<string>"))


def _windows(text: Column, sizes: Column) -> Column:
    """The substrings of a text that have one of the sizes, some of them repeated."""

    def of(part: Column, size: Column) -> Column:
        places = F.sequence(F.lit(1), F.char_length(part) - size + 1)
        return F.transform(places, lambda i: F.substring(part, i, size))

    def cut(part: Column) -> Column:
        fitting = F.filter(sizes, lambda size: size <= F.char_length(part))
        return F.flatten(F.transform(fitting, lambda size: of(part, size)))

    # the place of a character is found by counting from the start, so long texts go by stretches
    starts = F.sequence(F.lit(1), F.greatest(F.char_length(text), F.lit(1)), F.lit(STRETCH))
    parts = F.transform(starts, lambda i: F.substring(text, i, F.lit(STRETCH + max(SIZES) - 1)))
    return F.flatten(F.transform(parts, cut))


def _word(gram: Column) -> Column:
    return F.pmod(F.shiftright(F.xxhash64(gram), 6), F.lit(WORDS)).cast("int")


def _bit(gram: Column) -> Column:
    return F.xxhash64(gram).bitwiseAND(F.lit(63)).cast("int")


def _marks(grams: DataFrame) -> Column:
    """An array of ``WORDS`` longs in which the bit of each gram is set."""
    one = F.call_function("shiftleft", F.lit(1).cast("long"), _bit(F.col("gram")))
    none = grams.sparkSession.range(WORDS).select(F.col("id").cast("int"), F.lit(0).cast("long"))
    words = grams.select(_word(F.col("gram")).alias("word"), one.alias("bits")).union(none)
    words = words.groupBy("word").agg(F.bit_or("bits").alias("bits"))
    ordered = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return words.agg(ordered.alias("words")).select(F.col("words.bits")).scalar()


def filed_patterns(feed: DataFrame) -> DataFrame:
    """(pattern, gram): each pattern that has ``needed`` texts under one piece of them.

    Of each text only the longest pieces that ``SIZES`` allow are tried, since a value has far
    fewer patterns by chance under a long piece than under a short one.  Pieces that up to ``CROWD``
    patterns share count as equally rare, and the longest of them is taken; a pattern all of whose
    pieces are commoner is filed under the one that fewest share.
    """
    sizes = F.array(*(F.lit(n) for n in SIZES))
    pieces = feed.select("pattern", F.explode("needed").alias("piece"))
    longest = F.slice(F.filter(sizes, lambda n: n <= F.char_length("piece")), -1, 1)
    spread = pieces.select("pattern", F.explode(F.array_distinct(_windows(F.col("piece"), longest))).alias("gram"))
    shares = spread.groupBy("gram").agg(F.count("*").alias("n"))
    rank = F.struct(
        F.when(F.col("n") > CROWD, F.col("n")).otherwise(0).alias("crowd"),
        (-F.char_length("gram")).alias("size"), "n", "gram",
    )
    return spread.join(shares, "gram").groupBy("pattern").agg(F.min(rank)["gram"].alias("gram"))


def matched_values(values: DataFrame, column: str, patterns: DataFrame, pattern: str = "pattern") -> DataFrame:
    """Distinct values of ``column`` that some regular expression of a table is found in.

    Each pattern is filed under one piece of a text that its matches must contain.  Values are cut
    into pieces of the sizes that occur and meet the patterns filed there; only what meets
    is searched.  Where a piece has up to ``CROWD`` patterns they are sent to the values; the
    values are sent to larger crowds and searched while they are joined, so that no list
    of values times patterns is ever written.  Patterns without such a text are tried on every value.
    """
    name = quoted(column)
    texts = values.select(F.col(name).alias("value")).where("value IS NOT NULL").distinct()
    hashed = texts.withColumn("h", F.xxhash64("value"))
    feed = patterns.select(F.col(pattern).alias("pattern")).where("pattern IS NOT NULL")
    # searched once, so that a malformed pattern fails whatever it meets
    feed = feed.where(F.regexp_instr(F.lit(""), F.col("pattern")) >= 0)
    # an aggregate, below which no filter moves: all uses share one reading of the patterns
    feed = feed.groupBy("pattern").agg(F.first(required_texts(F.col("pattern"))).alias("needed"))
    index = filed_patterns(feed)
    crowds = index.groupBy("gram").agg(F.count("*").alias("held"))
    # values travel where they take less room than their patterns
    limit = F.greatest(F.lit(CROWD), texts.agg(F.avg(F.char_length("value")) / CROWD).scalar())
    few = F.when(F.col("held") <= limit, F.col("pattern"))
    filed = index.join(crowds, "gram").select("gram", few.alias("pattern")).distinct()
    sizes = index.agg(F.collect_set(F.char_length("gram"))).scalar()
    pieces = F.array_distinct(_windows(F.col("value"), F.col("sizes")))
    cut = hashed.withColumn("sizes", sizes).select("h", F.explode(pieces).alias("gram"))
    # under other collations equal texts can differ in their hash, so all of them go on
    if getattr(texts.schema["value"].dataType, "collation", BINARY) == BINARY:
        cut = cut.where(F.getbit(F.get(_marks(crowds), _word(F.col("gram"))), _bit(F.col("gram"))) == 1)
    met = hashed.join(cut.join(filed, "gram"), "h")
    search = F.expr("value RLIKE pattern")
    found = met.where(search).select("value")
    shared = index.join(crowds.where(F.col("held") > limit), "gram").select("gram", "pattern")
    shared = shared.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    part = F.col("h").bitwiseAND(F.lit(PARTS - 1)).cast("int").alias("part")
    sent = met.where("pattern IS NULL").select("value", "gram", part)
    # numbered, so that few bytes are not united to one task: here the search is what takes time
    sent = sent.repartition(int(values.sparkSession.conf.get("spark.sql.shuffle.partitions")), "gram", "part")
    crowded = sent.join(shared, ["gram", "part"]).where(search).select("value")
    loose = feed.where(F.size("needed") == 0)
    # one row however many patterns; empty (not null) if all have a text of their own
    always = loose.agg(F.collect_list("pattern").alias("patterns")).scalar()
    searched = F.exists("always", lambda p: F.call_function("rlike", F.col("value"), p))
    tried = texts.withColumn("always", always).where(searched).select("value")
    return found.union(crowded).union(tried).distinct().toDF(column)


def filter_column_by_pattern_table(
    df: DataFrame, column: str, patterns: DataFrame, pattern: str = "pattern"
) -> DataFrame:
    """Rows in whose ``column`` some regular expression of a table is found, each row once.

    As ``filter_column_by_string_pattern`` for each of the patterns and OR between, but the
    patterns are rows and not parts of the plan.  A malformed pattern fails when the plan runs.
    """
    return df.join(matched_values(df, column, patterns, pattern), column, "left_semi")
