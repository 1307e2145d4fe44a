"""Hard negatives: rows of another label that score just below an anchor's positives.

Rows are dealt to cells around pivots and cells to blocks of at most about ``BLOCK`` rows; a cover
tree is built for each block once and written.  Anchors visit every block for their positives.
Each (anchor, positive) then is a window of scores, from ``low`` to ``high`` times the positive's,
which visits only cells whose covering radius can reach it, and in a tree only nodes that can.
What blocks return is merged by rank.  Leaves are verified with exact integer products, so bounds
(widened by rounding error) decide cost alone.  The number of visits grows with anchors x blocks:
on vectors that bounds cannot tell apart this is a comparison of the anchors with all rows.

Defined results: rows with a null id, null label, null vector or a null or non-finite component
take no part; rows equal in id, label and vector are one; rows of equal id are never each other's
positive or negative.  A vector shorter than others is as if it ended in zeros.  Ties go to the
smaller id.  Products that do not fit 64 bits, or components beyond 2^53, raise ``ValueError``.
Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duskwatch.llm.cover_tree import EXACT, CoverTree
from duskwatch.sources.staging import stage

BLOCK = 4096  # rows of a tree
ASKED = 1024  # anchors, or windows, that visit a tree at once
PIVOTS = 32  # cells at most; bounds cost only
TOGETHER = 1024  # windows of a search


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), dtype=np.int64)
    for i, raw in enumerate(column.tolist()):
        values = np.frombuffer(raw, dtype=np.int64)
        out[i, : len(values)] = values
    return out


def quantised(vectors: DataFrame, key: str, label: Column, vector: str, scale: float) -> DataFrame:
    """(id, label, vec) of usable rows, vec being the floored components as bytes."""
    x = F.col(vector)
    usable = x.isNotNull() & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    )

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in batches:
            out = []
            for value in column.tolist():
                whole = np.floor(scale * np.asarray(value, dtype=np.float64))
                if (np.abs(whole) >= EXACT).any():
                    raise ValueError("a component is beyond 2^53 after scaling")
                out.append(np.trim_zeros(whole.astype(np.int64), "b").tobytes())
            yield pd.Series(out, dtype=object)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    floored = F.pandas_udf(run, "binary").asNondeterministic()(x)
    rows = vectors.select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"), vector)
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable)
    return rows.select("id", "label", floored.alias("vec"))


def _planted(rows: DataFrame, width: int, block: int) -> tuple[DataFrame, np.ndarray, np.ndarray, list]:
    """Trees (block, tree), and for each cell its centre, radius and (first, number of) blocks."""
    drawn = rows.select("vec").distinct().orderBy(F.xxhash64("vec"), "vec")
    total = rows.count()
    pivots = _matrix(drawn.limit(max(1, min(PIVOTS, total // block))).toPandas()["vec"], width).astype(float)
    half = (pivots**2).sum(1) / 2

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = _matrix(batch["vec"], width).astype(float)
            cell = (x @ pivots.T - half).argmax(1)
            away = np.sqrt(((x - pivots[cell]) ** 2).sum(1))
            yield batch.assign(cell=cell.astype(np.int32), away=away)

    placed = stage(rows.mapInPandas(place, "id long, label long, vec binary, cell int, away double"), "placed")
    radius, parts = np.zeros(len(pivots)), np.zeros(len(pivots), dtype=np.int64)
    for r in placed.groupBy("cell").agg(F.max("away").alias("r"), F.count("*").alias("n")).collect():
        radius[r["cell"]], parts[r["cell"]] = r["r"], -(-r["n"] // block)
    first = np.concatenate(([0], np.cumsum(parts)))
    per_cell = lambda values: F.array(*[F.lit(int(v)) for v in values])[F.col("cell")]
    turn = F.pmod(F.xxhash64("id", "label", "vec"), per_cell(np.maximum(1, parts))).cast("int")

    def plant(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id")
        tree = CoverTree.build(
            group["id"].to_numpy(), group["label"].to_numpy(), _matrix(group["vec"], width)
        )
        return pd.DataFrame({"block": group["block"].iloc[:1], "tree": [tree.packed()]})

    dealt = placed.withColumn("block", (per_cell(first[:-1]) + turn).cast("int"))
    trees = dealt.select("block", "id", "label", "vec").groupBy("block").applyInPandas(
        plant, "block int, tree binary"
    )
    spans = [(int(a), int(n)) for a, n in zip(first, parts)]
    return stage(trees, "trees"), pivots, radius, spans


def _visited(
    asks: DataFrame, trees: DataFrame, blocks: Column, number: int, width: int, k: int, same: bool
) -> DataFrame:
    """(ask, id, score, place): the ``k`` best of each row of ``asks`` (ask, own, label, vec, low, high).

    ``blocks`` is an array column of the blocks that a row visits.
    """
    turns = -(-number // ASKED)
    turn = F.pmod(F.xxhash64("vec"), F.lit(turns)).cast("int")  # windows of one vector stay together
    right = asks.withColumn("turn", turn).withColumn("block", F.explode(blocks))
    left = trees.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))

    def solve(held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = [], [], []
        if len(held) and len(asked):
            tree = CoverTree.unpacked(held["tree"].iat[0])
            asked = asked.sort_values(["vec", "ask"])
            for at in range(0, len(asked), TOGETHER):
                some = asked.iloc[at : at + TOGETHER]
                once = some["vec"].drop_duplicates()
                of = (some["vec"] != some["vec"].shift()).cumsum().to_numpy() - 1
                row, id_, score = tree.search(
                    _matrix(once, width), of, some["own"].to_numpy(), some["label"].to_numpy(),
                    some["low"].to_numpy(), some["high"].to_numpy(), k, same,
                )
                for out, part in zip(found, (some["ask"].to_numpy()[row], id_, score)):
                    out.append(part)
        names = ("ask", "id", "score")
        return pd.DataFrame(
            {c: np.concatenate(f) if f else np.empty(0, dtype=np.int64) for c, f in zip(names, found)}
        )

    keys = ["block", "turn"]
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(solve, "ask long, id long, score long")
    ranked = Window.partitionBy("ask").orderBy(F.desc("score"), "id")
    return met.withColumn("place", F.row_number().over(ranked)).where(F.col("place") <= k)


def mine(
    vectors: DataFrame, is_anchor: Column, *, label: Column | str = "label", key: str = "vec_id",
    vector: str = "embedding", scale: float = 256.0, positives: int = 5, negatives: int = 3,
    low: Fraction = Fraction(1, 2), high: Fraction = Fraction(19, 20), block: int = BLOCK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on the column ``id``; ``low`` and ``high`` are shares of the
    positive's score within which, both included, a negative's score must lie.
    """
    label = F.col(label) if isinstance(label, str) else label
    spark = vectors.sparkSession
    rows = stage(quantised(vectors, key, label, vector, scale).distinct(), "vectors")
    shape = rows.agg(F.max(F.length("vec")).alias("bytes")).first()
    empty = spark.createDataFrame(
        [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    )
    if shape["bytes"] is None:
        return empty
    width = max(1, shape["bytes"] // 8)
    anchors = rows.where(is_anchor).select(
        F.monotonically_increasing_id().alias("ask"), F.col("id").alias("own"), "label", "vec"
    )
    anchors = stage(anchors, "anchors")
    number = anchors.count()
    if not number:
        return empty
    trees, pivots, radius, spans = _planted(rows, width, block)
    every = F.sequence(F.lit(0), F.lit(sum(n for _, n in spans) - 1))
    wide = anchors.withColumn("low", F.lit(-(2**63) + 1)).withColumn("high", F.lit(2**63 - 1))
    best = stage(_visited(wide, trees, every, number, width, positives, True), "positives")

    # windows: positives of equal score share one; those of negative score can have none
    down, up = Fraction(low), Fraction(high)
    window = best.select("ask", F.col("score").alias("level")).distinct().where("level >= 0")
    least = F.expr(f"(level * {down.numerator}L + {down.denominator - 1}L) div {down.denominator}L")
    most = F.expr(f"(level * {up.numerator}L) div {up.denominator}L")
    window = window.withColumns({"low": least, "high": most}).where("low <= high")
    window = window.withColumn("number", F.monotonically_increasing_id())
    asks = stage(window.join(anchors, "ask"), "windows")

    def reachable(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for vec, lows, highs in batches:
            q = _matrix(vec, width).astype(float)
            middle, spread = q @ pivots.T, np.sqrt((q**2).sum(1))[:, None] * radius
            slack = 1 + 1e-9 * (np.abs(middle) + spread)
            meets = (middle + spread + slack >= lows.to_numpy()[:, None]) & (
                middle - spread - slack <= highs.to_numpy()[:, None]
            )
            yield pd.Series(
                [[b for cell in np.flatnonzero(m) for b in range(spans[cell][0], sum(spans[cell]))] for m in meets],
                dtype=object,
            )

    reachable.__annotations__ = {
        "batches": Iterator[tuple[pd.Series, pd.Series, pd.Series]], "return": Iterator[pd.Series]
    }
    blocks = F.pandas_udf(reachable, "array<int>").asNondeterministic()("vec", "low", "high")
    visits = asks.select(F.col("number").alias("ask"), "own", "label", "vec", "low", "high")
    hard = _visited(visits, trees, blocks, max(1, asks.count()), width, negatives, False)
    levels = asks.select("number", F.col("ask").alias("anchor"), "own", "level")
    named = hard.join(levels, hard["ask"] == levels["number"]).select(
        "anchor", "own", "level", F.col("place").alias("rank"), F.col("id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    positive = best.select(F.col("ask").alias("anchor"), F.col("id").alias("positive_id"), F.col("score").alias("level"))
    return named.join(positive, ["anchor", "level"]).select(
        F.col("own").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"),
        "negative_id", F.col("level").alias("positive_score"), "negative_score",
    )
