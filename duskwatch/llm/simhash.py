"""SimHash near-duplicate groups by pigeonhole blocks.

A text's fingerprint has a bit set where over half of its shingles' hashes have it.  The bits
are cut into blocks; texts that share enough of them meet in a join on those blocks, and the
Hamming distance of each pair that meets is verified.  Linked texts form components.

* ``EXACT`` (64 bits, distance 2): of four 16-bit blocks two bits can touch only two, so close
  pairs agree on some two blocks: six keys of 32 bits.  No link is lost.
* ``SIMILAR`` (2048 bits, five-word shingles, Jaccard 0.8): the bits are cut into 85 blocks of
  24 bits twice, in two orders; a pair at similarity 0.8 shares a block with probability 0.96,
  at 0.85 with 0.998.  A distance tells a similarity only within an error, so pairs within three
  standard deviations of the distance expected at 0.8 have their shingles compared, exactly;
  closer pairs are linked and farther ones are not.

Sets of few shingles do not follow the angle law (ties of few hashes are frequent), so below
``FEW`` shingles ``SIMILAR`` asks the shingles alone: texts meet that share one of the rarest
shingles of both (a prefix as long as the similarity demands), and no distance is asked.

Equal fingerprints are one node, so copies cost one row before anything is joined.  Buckets of
at most ``bucket`` nodes are paired within by a join.  Larger ones are not paired as rows.  For
``EXACT`` their nodes are linked through *centres*: two fingerprints differ in at most two bits
just when some fingerprint is within one bit of both, so each sends itself to its 65 centres and
is linked to the least node there - 65 rows a node, whatever the bucket's size, and nothing
missed.  For ``SIMILAR`` their nodes are first compared with the bucket's least node; then nodes
of small buckets are compared while they are joined, but for those in one component, and only
close pairs leave the join: texts half alike share many buckets, and as rows their pairs would be
most of the work.  A large bucket that all these links leave in several components is dealt to
blocks, and every block is compared with every block, shingles included, again but for pairs that
are in one component already.
What leaves a comparison is a forest, so a crowd, alike or not, makes few rows; only components
are asked for, so nothing is missed here either.

Defined results: a text that is null or has no word has an all-zero fingerprint, linked like
any other; with fewer words than a shingle has, the whole sequence is the shingle.  Rows with a
null key are fingerprinted and linked too but never name a component (null if there is no
other key).  Repeated rows give repeated rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duskwatch.llm.components import components
from duskwatch.sources.staging import stage

SEED = 42
FEW = 20  # shingles from which distances tell similarities
SIDE = 256  # nodes of a block
RUN = 512  # fingerprints cut into blocks at once


@dataclass(frozen=True)
class Scheme:
    words: int  # in a shingle
    bits: int  # of a fingerprint, a multiple of 64
    block_bits: int
    together: int  # blocks that make a key
    distance: int  # at most so many bits differ
    repeats: bool  # whether a repeated shingle counts again
    bucket: int  # nodes of which all pairs are joined as rows
    orders: int = 1  # of the bits, each cut into blocks of its own
    similarity: float | None = None  # decided exactly between the two distances
    sure: int = -1  # at most so many differing bits need no such decision


def _distance_at(similarity: float, bits: int) -> int:
    """Bits expected to differ at a Jaccard similarity of sets of equal size."""
    cosine = 2 * similarity / (1 + similarity)
    return round(bits * np.arccos(cosine) / np.pi)


def _error_at(similarity: float, bits: int) -> int:
    """Three standard deviations of that number."""
    share = _distance_at(similarity, bits) / bits
    return round(3 * np.sqrt(bits * share * (1 - share)))


EXACT = Scheme(
    words=3, bits=64, block_bits=16, together=2, distance=2, repeats=True, bucket=64
)
SIMILAR = Scheme(
    words=5, bits=2048, block_bits=24, together=1, repeats=False, bucket=8, orders=2, similarity=0.8,
    distance=_distance_at(0.8, 2048) + _error_at(0.8, 2048),
    sure=_distance_at(0.8, 2048) - _error_at(0.8, 2048),
)
STEP = 1009  # odd, so that steps of it visit all bits once; the next order of the bits


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of each shingle of ``words`` words, in order, repeats included."""
    found = (text or "").encode().lower().split()  # of bytes: A-Z and ASCII blanks only
    if not found:
        return np.empty(0, dtype=np.uint64)
    joined, ends = b" ".join(found), np.cumsum([len(w) + 1 for w in found])
    starts = (ends - np.array([len(w) + 1 for w in found])).tolist()
    stops = (ends[min(words, len(found)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array(
        [digest(joined[a:b], SEED) for a, b in zip(starts, stops)], dtype=np.uint64
    )


def fingerprint(hashes: np.ndarray, bits: int) -> np.ndarray:
    """``bits`` / 64 words; beyond 64 bits each hash is mixed once for every word."""
    n, width = len(hashes), bits // 64
    if not n:
        return np.zeros(width, dtype=np.uint64)
    odd = (np.arange(width, dtype=np.uint64) * np.uint64(2) + np.uint64(1)) * np.uint64(
        0x9E3779B97F4A7C15
    )
    sums = np.zeros(bits, dtype=np.int64)
    for start in range(0, n, 255):  # so that a byte can hold the sum
        part = hashes[start : start + 255, None]
        if width > 1:
            part = part * (odd | np.uint64(1))
            part ^= part >> np.uint64(32)
            part *= np.uint64(0xD6E8FEB86659FD93)
            part ^= part >> np.uint64(29)
        bytes_ = np.ascontiguousarray(part).view(np.uint8)
        sums += np.unpackbits(bytes_, axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * sums > n, bitorder="little").view(np.uint64)


def described(text: Column, scheme: Scheme) -> Column:
    """Fingerprint of a text column, an array of longs, and its shingles where they are few.

    Few are as many as a set of fewer than ``FEW`` can be similar to.
    """
    most = 0 if scheme.similarity is None else FEW / scheme.similarity

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            prints, items = [], []
            for value in texts.tolist():
                hashes = shingle_hashes(value, scheme.words)
                hashes = hashes if scheme.repeats else np.unique(hashes)
                prints.append(fingerprint(hashes, scheme.bits).view(np.int64))
                items.append(hashes.view(np.int64) if len(hashes) < most else None)
            yield pd.DataFrame(
                {"print": pd.Series(prints, dtype=object), "items": pd.Series(items, dtype=object)}
            )

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, "print array<long>, items array<long>").asNondeterministic()(text)


def _keys(prints: Column, scheme: Scheme) -> Column:
    """Block keys of a fingerprint: number of the combination, then its bits."""
    blocks, per = scheme.bits // scheme.block_bits, scheme.block_bits
    chosen = list(combinations(range(blocks), scheme.together))

    def keys_of(words: np.ndarray) -> np.ndarray:
        bits = np.unpackbits(words.view(np.uint8), axis=1, bitorder="little")
        keys = np.empty((len(words), scheme.orders * len(chosen)), dtype=np.int64)
        for order in range(scheme.orders):
            at = np.arange(blocks * per) * pow(STEP, order) % scheme.bits
            parts = bits[:, at].reshape(len(words), blocks, per)
            packed = np.packbits(parts, axis=2, bitorder="little").astype(np.int64)
            values = sum(packed[:, :, i] << (8 * i) for i in range(packed.shape[2]))
            for i, combination in enumerate(chosen, order * len(chosen)):
                keys[:, i] = i
                for block in combination:
                    keys[:, i] = (keys[:, i] << per) | values[:, block]
        return keys

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in batches:
            if not len(column):
                yield pd.Series([], dtype=object)
                continue
            prints_, out = column.tolist(), []
            for begin in range(0, len(prints_), RUN):
                out += list(keys_of(np.array(prints_[begin : begin + RUN], dtype=np.int64)))
            yield pd.Series(out, dtype=object)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "array<long>")(prints)


def _shared(rows: DataFrame) -> DataFrame:
    """From (key, node) the rows of keys that several nodes have, with n and the least of them.

    Rows are made and shuffled once; a window over the sorted bucket gives its size and least
    node, so that keys that are nearly all different never fill a hash table.
    """
    bucket = Window.partitionBy("key")
    sized = rows.select(
        "key", "node", F.count("*").over(bucket).alias("n"), F.min("node").over(bucket).alias("least")
    )
    return stage(sized.where("n > 1"), "shared")


def _met(rows: DataFrame, largest: int) -> tuple[DataFrame, DataFrame]:
    """From (key, node): pairs a < b within small buckets, and the rows of large ones."""
    shared = _shared(rows)
    small = shared.where(F.col("n") <= largest)
    left = small.select("key", F.col("node").alias("a"))
    right = small.select("key", F.col("node").alias("b"))
    pairs = left.join(right, "key").where("a < b").select("a", "b")
    return pairs, shared.where(F.col("n") > largest)


def _apart(small: DataFrame, nodes: DataFrame, roots: DataFrame, scheme: Scheme) -> DataFrame:
    """Close pairs (a, b, differing), a < b, of small buckets that ``roots`` (node, root) leaves apart.

    Fingerprints go with the rows of buckets in several components, so that the join on the bucket
    decides: a pair that is not close, or is in one component, is never a row.
    """
    known = small.select("key", "node").join(roots, "node", "left")
    known = known.withColumn("root", F.coalesce("root", "node"))
    bucket = Window.partitionBy("key")  # of at most ``largest`` rows
    split = known.withColumns({"low": F.min("root").over(bucket), "high": F.max("root").over(bucket)})
    split = stage(split.where("low < high").select("key", "node", "root"), "split")
    held = split.join(nodes.select("node", "print", "items"), "node")
    left = held.select("key", F.col("root").alias("root_a"), *_side("a", "x"))
    right = held.select("key", F.col("root").alias("root_b"), *_side("b", "y"))
    differing = _differing(scheme)
    close = left.join(right, "key").where(
        F.expr("a < b AND root_a != root_b") & (differing <= scheme.distance)
    )
    return close.select("a", "b", differing.alias("differing")).distinct()


def _through_centres(nodes: DataFrame, large: DataFrame) -> DataFrame:
    """Links at two bits or fewer among the nodes of large buckets."""
    crowd = nodes.join(large.select("node").distinct(), "node", "left_semi")
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)) for i in range(64)])
    near = crowd.select(
        "node",
        F.explode(
            F.transform(flips, lambda flip: F.col("print")[0].bitwiseXOR(flip.cast("long")))
        ).alias("centre"),
    )
    least = near.groupBy("centre").agg(F.min("node").alias("least"), F.count("*").alias("n"))
    return (
        near.join(least.where("n > 1"), "centre")
        .where("node > least")
        .select(F.col("least").alias("a"), F.col("node").alias("b"))
    )


def _alike(x: str, y: str) -> Column:
    shared = F.size(F.array_intersect(x, y))
    return shared / (F.size(x) + F.size(y) - shared)


def _side(node: str, items: str) -> list[Column]:
    """Columns of a node as ``_differing`` wants them on one side of a pair."""
    return [F.col("node").alias(node), F.col("print").alias(f"print_{node}"), F.col("items").alias(items)]


def _differing(scheme: Scheme) -> Column:
    """Bits in which the fingerprints of a pair differ.

    Two sets of few shingles are decided by these: no differing bits if they are alike, else null.
    """
    differing = F.aggregate(
        F.zip_with("print_a", "print_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))),
        F.lit(0),
        lambda total, x: total + x,
    )
    if scheme.similarity is not None:
        few = F.col("x").isNotNull() & F.col("y").isNotNull()
        alike = F.when(_alike("x", "y") >= scheme.similarity, F.lit(0))
        differing = F.when(few, alike).otherwise(differing)
    return differing


def _verified(pairs: DataFrame, nodes: DataFrame, scheme: Scheme) -> DataFrame:
    """Those distinct pairs whose fingerprints differ in at most ``distance`` bits, and how many."""
    one, two = nodes.select(*_side("a", "x")), nodes.select(*_side("b", "y"))
    met = pairs.distinct().join(one, "a").join(two, "b")
    return met.select("a", "b", _differing(scheme).alias("differing")).where(
        F.col("differing") <= scheme.distance
    )


def _shingle_sets(text: Column, words: int) -> Column:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            sets = [np.unique(shingle_hashes(t, words)).view(np.int64) for t in texts.tolist()]
            yield pd.Series(sets, dtype=object)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "array<long>").asNondeterministic()(text)


def _sets(asked: DataFrame, nodes: DataFrame, texts: DataFrame, scheme: Scheme) -> DataFrame:
    """(node, items): the sorted shingles of each node of ``asked``."""
    tags = nodes.join(asked, "node", "left_semi").select("node", "tag")
    found = texts.join(tags, "tag").dropDuplicates(["node"])
    return stage(
        found.select("node", _shingle_sets(F.col("text"), scheme.words).alias("items")), "sets"
    )


def _decided(close: DataFrame, nodes: DataFrame, texts: DataFrame, scheme: Scheme) -> DataFrame:
    """Links (a, b) of ``close``: the sure ones, and others if their shingles are alike enough.

    ``texts`` (tag, text) has a text of every node; only those of undecided pairs are compared.
    """
    close = stage(close, "close")
    open_ = close.where(F.col("differing") > scheme.sure).select("a", "b")
    sets = _sets(open_.select(F.explode(F.array("a", "b")).alias("node")).distinct(), nodes, texts, scheme)
    x = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    alike = open_.join(x, "a").join(y, "b").where(_alike("x", "y") >= scheme.similarity)
    alike = alike.select("a", "b")
    return close.where(F.col("differing") <= scheme.sure).select("a", "b").union(alike)


def _rarest(nodes: DataFrame, similarity: float) -> DataFrame:
    """(key, node): of each set of few shingles the rarest, one of which similar sets share."""
    items = nodes.select("node", F.size("items").alias("n"), F.explode("items").alias("item"))
    often = items.groupBy("item").agg(F.count("*").alias("often"))
    ranked = items.join(often, "item").groupBy("node", "n").agg(
        F.array_sort(F.collect_list(F.struct("often", "item"))).alias("items")
    )
    prefix = (F.col("n") - F.ceil(F.col("n") * similarity - 1e-9) + 1).cast("int")
    rarest = ranked.select("node", F.explode(F.slice("items", 1, prefix)).alias("e"))
    return rarest.select(F.col("e.item").alias("key"), "node")


def _cell_links(cell: pd.DataFrame, scheme: Scheme) -> pd.DataFrame:
    """Links (a, b) between two blocks (or within one) that join components: a forest of them.

    Pairs within a sure distance link; the others, nearest first, have their shingles compared
    unless what was linked before has joined them already.
    """
    one = cell[cell["part"] == cell["i"]].reset_index(drop=True)
    two = cell[cell["part"] == cell["j"]].reset_index(drop=True)
    names, group = np.unique(np.concatenate((one["root"], two["root"])), return_inverse=True)
    left, right = group[: len(one)], group[len(one) :]
    apart = left[:, None] != right
    if cell["i"].iat[0] == cell["j"].iat[0]:
        apart &= np.tri(len(one), k=-1, dtype=bool)
    a, b = [], []
    if apart.any():

        def signs(rows: pd.DataFrame) -> np.ndarray:
            words = np.array(rows["print"].tolist(), dtype=np.int64)
            bits = np.unpackbits(words.view(np.uint8), axis=1)
            return bits.astype(np.float32) * 2 - 1

        distance = ((scheme.bits - signs(one) @ signs(two).T) / 2).astype(np.int32)
        sets = one["items"].tolist(), two["items"].tolist()  # sorted, without repeats
        few = [np.array([len(v) < FEW / scheme.similarity for v in side], dtype=bool) for side in sets]
        open_ = (few[0][:, None] & few[1]) | (distance > scheme.sure)
        asked = apart & ((distance <= scheme.distance) | (few[0][:, None] & few[1]))
        parent = list(range(len(names)))

        def find(at: int) -> int:
            while parent[at] != at:
                parent[at] = at = parent[parent[at]]
            return at

        nodes = one["node"].to_numpy(), two["node"].to_numpy()
        x, y = np.nonzero(asked)
        order = np.lexsort((distance[x, y], open_[x, y]))
        for x, y, undecided in zip(x[order], y[order], open_[x, y][order]):
            p, q = find(left[x]), find(right[y])
            if p == q:
                continue
            if undecided:
                shared = len(np.intersect1d(sets[0][x], sets[1][y], assume_unique=True))
                union = len(sets[0][x]) + len(sets[1][y]) - shared
                if not union or shared / union < scheme.similarity:
                    continue
            parent[p] = q
            a.append(min(nodes[0][x], nodes[1][y]))
            b.append(max(nodes[0][x], nodes[1][y]))
    return pd.DataFrame({"a": a, "b": b}).astype("int64")


def _crowded(
    large: DataFrame, nodes: DataFrame, texts: DataFrame, roots: DataFrame, scheme: Scheme
) -> DataFrame:
    """Links (a, b) among large buckets' nodes that ``roots`` (node, root) leaves apart."""
    known = large.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    known = stage(known.select("key", "node", "n", "root"), "crowds")
    hashed = F.xxhash64("node")
    open_ = known.groupBy("key", "n").agg(
        F.min("root").alias("low"),
        F.max("root").alias("high"),
        F.bit_xor(hashed).alias("mixed"),
        F.sum(hashed.cast("decimal(20,0)")).alias("total"),
    )
    # buckets of the same nodes are one
    once = open_.where("low < high").groupBy("n", "mixed", "total").agg(F.min("key").alias("key"))
    parts = F.ceil(F.col("n") / SIDE).cast("int")
    held = stage(known.join(once.select("key"), "key", "left_semi"), "apart")
    dealt = held.select(
        "key",
        "node",
        "root",
        F.pmod(hashed, parts).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"),
    )
    cells = dealt.withColumns({"i": F.least("part", "other"), "j": F.greatest("part", "other")})
    sets = _sets(held.select("node").distinct(), nodes, texts, scheme)
    members = nodes.select("node", "print").join(sets, "node")

    def solve(cell: pd.DataFrame) -> pd.DataFrame:
        return _cell_links(cell, scheme)

    return (
        cells.drop("other")
        .join(members, "node")
        .groupBy("key", "i", "j")
        .applyInPandas(solve, "a long, b long")
        .distinct()
    )


def _exact_links(nodes: DataFrame, scheme: Scheme, largest: int) -> DataFrame:
    """Links (a, b) of ``nodes`` (node, print, items) that connect all within the distance."""
    keys = nodes.select("node", _keys(F.col("print"), scheme).alias("keys"))
    pairs, large = _met(keys.select(F.explode("keys").alias("key"), "node"), largest)
    large = stage(large.select("node").distinct(), "crowd")
    near = _verified(pairs, nodes, scheme).select("a", "b")
    return near.union(_through_centres(nodes, large))


def _similar_links(nodes: DataFrame, texts: DataFrame, scheme: Scheme, largest: int) -> DataFrame:
    """Links (a, b) that connect all ``nodes`` that meet and are alike."""
    enough = nodes.where(F.col("items").isNull() | (F.size("items") >= FEW))
    keys = enough.select("node", _keys(F.col("print"), scheme).alias("keys"))
    keys = keys.select(F.explode("keys").alias("key"), "node")
    shared = _shared(keys.union(_rarest(nodes, scheme.similarity)))
    large, small = shared.where(F.col("n") > largest), shared.where(F.col("n") <= largest)
    stars = large.where("node > least").select(F.col("least").alias("a"), F.col("node").alias("b"))
    roots = components(_decided(_verified(stars, nodes, scheme), nodes, texts, scheme))
    forest = roots.select(F.col("root").alias("a"), F.col("node").alias("b"))
    near = _decided(_apart(small, nodes, roots, scheme), nodes, texts, scheme)
    roots = components(forest.union(near))
    links = roots.select(F.col("root").alias("a"), F.col("node").alias("b"))
    return links.union(_crowded(large, nodes, texts, roots, scheme))


def near_duplicates(
    docs: DataFrame,
    scheme: Scheme = EXACT,
    *,
    key: str = "doc_id",
    text: str = "text",
    largest: int | None = None,
) -> DataFrame:
    """(``key``, print, component_id) for every row of ``docs``.

    print is the fingerprint as an array of longs, component_id the least key reachable.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows = rows.withColumn("tag", F.xxhash64("key", "text"))
    prints = rows.select("key", "tag", described(F.col("text"), scheme).alias("found"))
    prints = stage(prints.select("key", "tag", "found.*"), "prints")
    nodes = prints.groupBy("print").agg(
        F.min("key").alias("first"), F.min("tag").alias("tag"), F.min("items").alias("items")
    )
    nodes = stage(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    largest = largest or scheme.bucket
    if scheme.similarity is None:
        links = _exact_links(nodes, scheme, largest)
    else:
        links = _similar_links(nodes, rows.select("tag", "text"), scheme, largest)
    roots = components(links)
    named = nodes.join(roots, "node", "left").select(
        "print", "first", F.coalesce("root", "node").alias("root")
    )
    named = stage(named, "named")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = named.join(least, "root").select("print", "component_id")
    return prints.join(classes, "print").select(F.col("key").alias(key), "print", "component_id")


def hexadecimal(word: Column) -> Column:
    """16 lower-case digits of a 64-bit word."""
    return F.lower(F.lpad(F.hex(word), 16, "0"))
