"""SpotSigs fingerprints: chains of content words that follow common words.

A signature is a common word (anchor) with the next two content words, whatever anchors lie
between; a text's fingerprint is the multiset of its signatures, written as its size and a hash.
A text without any signature has its word pairs instead, or its only word.  Likeness is the
Jaccard similarity of two multisets, pruned: with a floor, sets whose sizes alone rule it out
are not compared, and a comparison ends once the floor is out of reach.

``similar_pairs`` finds all pairs of different fingerprints with at least some likeness.  Sets
are partitioned by size so that only equal or neighbouring partitions can hold a pair; in them a
pair must share one of the rarest signatures of both (a prefix as long as the floor demands),
which is the join.

``edited_neighbours`` compares each text with an edited version of itself, which ends in the
beginning of the next document by descending key, and with that document.  Texts are dealt to
sorted ranges once; where one range ends and the next begins the two rows are written to a small
table and finished from there.

Defined results: a null text is empty; an empty text has an empty fingerprint; two empty ones
are alike (1), an empty and another are not (0).  Documents of equal key follow each other by a
hash of their texts, null keys come last; a single document is its own next.  Repeated rows are
documents of their own.  Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b, sha256

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwatch.sources.staging import stage

# Common words of English, French, German and Spanish
ANCHORS = frozenset(
    """
    the of and a to in is that it was for on are as with be by at this from or an
    le la les de des du et un une en est que qui dans pour pas sur avec il au
    der die das und ist von zu den mit sich im für auf ein eine nicht dem es
    el los las y del una por con para se no lo su al como más
    """.split()
)
CHAIN = 2
_WORD = re.compile(r"\w+")


def signatures(text: str | None) -> Counter:
    """Multiset of a text's signatures."""
    words = _WORD.findall((text or "").lower())
    content = [w for w in words if w not in ANCHORS]
    chains = list(zip(*(content[i:] for i in range(CHAIN))))
    found, at = [], 0
    for word in words:
        if word not in ANCHORS:
            at += 1
        elif at < len(chains):
            found.append((word, chains[at]))
        else:
            break
    if not found:
        found = [("", pair) for pair in zip(words, words[1:])] or [("", (w,)) for w in words]
    return Counter(found)


def fingerprint(found: Counter) -> str:
    """Size of a multiset and a hash of its signatures with their numbers."""
    lines = sorted(f"{a} {' '.join(c)} {n}" for (a, c), n in found.items())
    return f"{sum(found.values())}:{sha256(chr(10).join(lines).encode()).hexdigest()}"


def likeness(a: Counter, b: Counter, floor: float = 0.0) -> float:
    """Jaccard similarity of multisets, or 0 where it is below ``floor``."""
    size_a, size_b = sum(a.values()), sum(b.values())
    if not size_a and not size_b:
        return 1.0
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if min(size_a, size_b) < floor * max(size_a, size_b):
        return 0.0
    # shared / (size_a + size_b - shared) >= floor needs so many shared signatures
    needed = floor * (size_a + size_b) / (1 + floor)
    shared, left = 0, sum(small.values())
    for signature, count in small.items():
        shared += min(count, large.get(signature, 0))
        left -= count
        if shared + left < needed - 1e-9:
            return 0.0
    value = shared / (size_a + size_b - shared)
    return value if value >= floor else 0.0


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as much of ``following``, or all of it."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


_FIELDS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, " \
    "edited_fingerprint string, near_edited double, near_next double"
_NAMES = [f.split()[0] for f in _FIELDS.split(",")]


def _compared(key, text: str, own: Counter, following: str, its: Counter) -> tuple:
    changed = edited(text, following)
    other = signatures(changed)
    return (
        key, len(text), sha256(changed.encode()).hexdigest(), fingerprint(own), fingerprint(other),
        likeness(own, other), likeness(own, its),
    )


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of one range in order: all but the last are finished, the ends are passed on."""
    part, before = TaskContext.get().partitionId(), None
    columns = [*_NAMES, "range", "place", "text"]
    for batch in batches:
        rows = []
        for key, text in zip(batch["doc_id"].tolist(), batch["text"].tolist()):
            key, text = None if pd.isna(key) else int(key), text or ""
            own = signatures(text)
            if before is None:
                rows.append((key, *[None] * 6, part, "first", text))
            else:
                rows.append((*_compared(*before, text, own), part, "done", None))
            before = (key, text, own)
        yield _frame(rows, columns)
    if before is not None:
        yield _frame([(before[0], *[None] * 6, part, "last", before[1])], columns)


def _frame(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=columns)
    return out.astype({"doc_id": "Int64", "n_chars": "Int64"})


def edited_neighbours(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie")]
    walked = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(
        _walk, f"{_FIELDS}, range int, place string, text string"
    )
    walked = stage(walked, "walked")
    ends = walked.where("place != 'done'").select("range", "place", "doc_id", "text")
    # at most one number for each range
    numbers = sorted(r["range"] for r in ends.where("place = 'last'").select("range").collect())
    following = dict(zip(numbers, numbers[1:] + numbers[:1]))
    if not numbers:
        return walked.select(*_NAMES)
    after = F.create_map(*[F.lit(v) for pair in following.items() for v in pair])
    last = ends.where("place = 'last'").withColumn("next", after[F.col("range")])
    first = ends.where("place = 'first'").select(
        F.col("range").alias("next"), F.col("text").alias("following")
    )

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                row_key = None if pd.isna(row.doc_id) else int(row.doc_id)
                text, other = row.text or "", row.following or ""
                out.append(_compared(row_key, text, signatures(text), other, signatures(other)))
            yield _frame(out, _NAMES)

    closed = last.join(first, "next").select("doc_id", "text", "following")
    return walked.where("place = 'done'").select(*_NAMES).union(closed.mapInPandas(finish, _FIELDS))


def similar_pairs(
    docs: DataFrame, floor: float = 0.44, *, key: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b, likeness) of different fingerprints, and membership (``key``, fingerprint)."""

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row_key, value in zip(batch["key"].tolist(), batch["text"].tolist()):
                found = signatures(value)
                hashed = sorted(
                    int.from_bytes(blake2b(repr((s, i)).encode(), digest_size=8).digest(), "big", signed=True)
                    for s, n in found.items()
                    for i in range(n)  # the i-th repeat counts as a signature of its own
                )
                out.append((row_key, fingerprint(found), hashed))
            yield pd.DataFrame(out, columns=["key", "fingerprint", "items"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["key"]
    described = stage(
        rows.mapInPandas(describe, f"key {kind}, fingerprint string, items array<long>"), "described"
    )
    sets = stage(described.groupBy("fingerprint").agg(F.first("items").alias("items")), "sets")
    items = sets.select("fingerprint", F.size("items").alias("n"), F.explode("items").alias("item"))
    often = items.groupBy("item").agg(F.count("*").alias("often"))
    ranked = items.join(often, "item").groupBy("fingerprint", "n").agg(
        F.array_sort(F.collect_list(F.struct("often", "item"))).alias("items")
    )
    # sizes s and t can be alike only if s >= floor * t: neighbouring powers of 1 / floor
    ratio = math.log(1 / floor)
    prefixes = ranked.select(
        "fingerprint",
        "n",
        F.floor(F.log(F.col("n")) / ratio).alias("band"),
        F.explode(F.slice("items", 1, (F.col("n") - F.ceil(F.col("n") * floor) + 1).cast("int"))).alias("e"),
    ).select("fingerprint", "n", "band", F.col("e.item").alias("item"))
    one = prefixes.select(F.col("fingerprint").alias("a"), "band", "item")
    two = prefixes.select(
        F.col("fingerprint").alias("b"), F.explode(F.array(F.col("band"), F.col("band") - 1)).alias("band"), "item"
    )
    met = one.join(two, ["band", "item"]).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    met = met.where("a < b").distinct()
    x = sets.select(F.col("fingerprint").alias("a"), F.col("items").alias("x"))
    y = sets.select(F.col("fingerprint").alias("b"), F.col("items").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    value = shared / (F.size("x") + F.size("y") - shared)
    # sizes rule out most pairs before sets are compared
    possible = F.least(F.size("x"), F.size("y")) >= floor * F.greatest(F.size("x"), F.size("y"))
    pairs = met.join(x, "a").join(y, "b").where(possible).withColumn("likeness", value)
    pairs = pairs.where(F.col("likeness") >= floor).select("a", "b", "likeness")
    return pairs, described.select(F.col("key").alias(key), "fingerprint")
