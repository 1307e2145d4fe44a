"""Exact top-k by inner product: a Voronoi join.

Equal vectors are one candidate (only its ``k`` + 1 least ids can ever be among a query's best).
Distinct vectors and queries are both grouped by their nearest pivot.  A query group is known by
its pivot p, its radius R (largest distance of a member) and, from summaries of the data, a score
that its members are sure to reach: every query q of the group has q.x >= p.x - R|x| for each
data vector x, so the (k + 1)-th largest of these bounds over all data is a floor for the
(k + 1)-th best score.  A data cell is known by its pivot c, its radius r, its largest norm m and
its size: no member can exceed p.c + |p|r + Rm in a group.  Cells that reach no group's floor are
not read again; of the others a vector is wanted by a group only if p.x + R|x| reaches its floor.
Neighbouring groups are packed into teams of at most ``block`` queries, and a vector goes once to
each team that has a group wanting it, so that where bounds prune nothing it is copied once for
each block of queries, not for each group.  Teams are solved locally in blocks of bounded size;
partial results of a query are merged by rank.  Nothing depends on the pivots but cost.

Components are floored to ``floor(scale * x)`` and scores are 64-bit integers; bounds are
widened by rounding error, so that ties at the floor survive.  A floored component of 2^53 or more,
or a score that might not fit in 64 bits, is an error.

Defined results: vectors that are null or hold a null or non-finite component take no part;
vectors of different length are compared as if the shorter one ended in zeros; ties go to the
smaller id; a query's own row (equal id) is never its answer; with fewer candidates than ``k``
all are given.  Repeated ids count as one row if their vectors are equal and as several
candidates otherwise.  Null ids take no part.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwatch.sources.staging import stage

BLOCK = 4096  # vectors, and queries, solved at once
PIVOTS = 64


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    """Rows of equal width from binary vectors of 64-bit integers."""
    out = np.zeros((len(column), width), dtype=np.int64)
    for i, raw in enumerate(column.tolist()):
        values = np.frombuffer(raw, dtype=np.int64)
        out[i, : len(values)] = values
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products; in floating point where that is exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if most >= 2**63:
        raise OverflowError("inner products do not fit in 64 bits; use a smaller scale")
    return a @ b.T


def _quantised(vectors: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """(id, vec): the floored vector as bytes, without what cannot take part."""
    x = F.col(vector)
    usable = x.isNotNull() & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    )

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in batches:
            out = []
            for value in column.tolist():
                whole = np.floor(scale * np.asarray(value, dtype=np.float64))
                if np.abs(whole).max(initial=0) >= 2**53:
                    raise OverflowError("a component is too large to be exact; use a smaller scale")
                out.append(np.trim_zeros(whole.astype(np.int64), "b").tobytes())
            yield pd.Series(out, dtype=object)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    floored = F.pandas_udf(run, "binary").asNondeterministic()(x)
    rows = vectors.where(F.col(key).isNotNull() & usable)
    return rows.select(F.col(key).cast("long").alias("id"), floored.alias("vec"))


def _distinct(rows: DataFrame, most: int) -> DataFrame:
    """(vec, ids): the ``most`` least ids of each distinct vector.

    Each batch first keeps what it can contribute, so a vector that a third of all rows share
    is a few ids for each batch before anything is shuffled.
    """

    def least(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.drop_duplicates().sort_values("id")
            yield batch.groupby("vec").head(most)

    return (
        rows.mapInPandas(least, "id long, vec binary")
        .groupBy("vec")
        .agg(F.slice(F.array_sort(F.collect_set("id")), 1, most).alias("ids"))
    )


class _Pivots:
    """Bounded set of vectors that groups and cells are formed around."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.p = vectors.astype(np.float64)
        self.half = (self.p**2).sum(1) / 2
        self.norm = np.sqrt(2 * self.half)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest pivot of each row and the distance to it."""
        x = x.astype(np.float64)
        group = (x @ self.p.T - self.half).argmax(1)
        return group, np.sqrt(((x - self.p[group]) ** 2).sum(1))

    def bounds(self, x: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product of each row with any query of each group."""
        x = x.astype(np.float64)
        centre, spread = x @ self.p.T, np.sqrt((x**2).sum(1))[:, None] * radius
        slack = 1 + 1e-9 * (np.abs(centre) + spread)
        return centre - spread - slack, centre + spread + slack

    def reach(self, cell_radius: np.ndarray, cell_norm: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Greatest inner product of any member of each cell (rows) with any query of each group."""
        centre = self.p @ self.p.T
        spread = cell_radius[:, None] * self.norm + cell_norm[:, None] * radius
        return centre + spread + 1 + 1e-9 * (np.abs(centre) + spread)

    def chain(self) -> list[int]:
        """All pivots, each followed by the nearest that has not been listed."""
        apart = self.half[:, None] + self.half - self.p @ self.p.T
        order, rest = [0], set(range(1, len(self.p)))
        while rest:
            order.append(min(rest, key=lambda i: (apart[order[-1], i], i)))
            rest.remove(order[-1])
        return order


def _teams(order: list[int], waiting: np.ndarray, block: int) -> np.ndarray:
    """Team of each group: neighbours in ``order`` together, up to ``block`` queries."""
    team, number, load = np.zeros(len(order), dtype=np.int64), 0, 0
    for group in order:
        if load and load + waiting[group] > block:
            number, load = number + 1, 0
        team[group], load = number, load + waiting[group]
    return team


def _spread(batch: pd.DataFrame, group: np.ndarray, columns: list[str]) -> pd.DataFrame:
    out = batch[columns].copy()
    out["group"] = group
    return out


def top_k(
    vectors: DataFrame,
    is_query: Column,
    *,
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: float = 1024.0,
    pivots: int = PIVOTS,
    block: int = BLOCK,
) -> DataFrame:
    """(query_id, rank, ``key``, score): the ``k`` best rows for each row where ``is_query``."""
    rows = stage(
        _quantised(vectors, key, vector, scale), "vectors"
    )
    asked = vectors.where(is_query).select(F.col(key).cast("long").alias("id")).distinct()
    queries = stage(rows.join(asked, "id", "left_semi"), "queries")
    data = stage(_distinct(rows, k + 1), "data")
    shapes = data.agg(F.max(F.length("vec")).alias("bytes"), F.count("*").alias("n")).first()
    empty = rows.sparkSession.createDataFrame([], f"query_id long, rank int, {key} long, score long")
    if not shapes["n"]:
        return empty
    width = max(1, shapes["bytes"] // 8)
    asks = stage(queries.select("vec").distinct(), "asks")
    drawn = asks.orderBy(F.xxhash64("vec"), "vec").limit(pivots).toPandas()
    if not len(drawn):
        return empty
    centre = _Pivots(_matrix(drawn["vec"], width))
    groups = len(drawn)

    # queries by group, with the radius of each group
    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            group, distance = centre.nearest(_matrix(batch["vec"], width))
            yield _spread(batch, group, ["vec"]).assign(distance=distance)

    placed = stage(asks.mapInPandas(place, "vec binary, group int, distance double"), "placed")
    sizes = placed.groupBy("group").agg(F.max("distance").alias("r"), F.count("*").alias("n"))
    radius, waiting = np.zeros(groups), np.zeros(groups, dtype=np.int64)
    for r in sizes.collect():  # one row for each pivot
        radius[r["group"]], waiting[r["group"]] = r["r"], r["n"]

    # data by cell, with radius, largest norm and size of each cell
    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = _matrix(batch["vec"], width)
            cell, distance = centre.nearest(x)
            norm = np.sqrt((x.astype(np.float64) ** 2).sum(1))
            yield batch.assign(cell=cell, distance=distance, norm=norm)

    data = data.mapInPandas(settle, "vec binary, ids array<long>, cell int, distance double, norm double")
    data = stage(data, "cells")
    cell_radius, cell_norm = np.zeros(groups), np.zeros(groups)
    cell_size = np.zeros(groups, dtype=np.int64)
    summary = data.groupBy("cell").agg(F.max("distance"), F.max("norm"), F.count("*"))
    for cell, far, long, n in summary.collect():  # one row for each pivot
        cell_radius[cell], cell_norm[cell], cell_size[cell] = far, long, n

    # floors: the (k + 1)-th largest lower bound of each group over all data
    def best_bounds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = np.empty((0, groups))
        for batch in batches:
            lower, _ = centre.bounds(_matrix(batch["vec"], width), radius)
            repeats = np.minimum(batch["ids"].map(len).to_numpy(), k + 1)
            lower = np.repeat(lower, repeats, axis=0)
            kept = -np.sort(-np.concatenate((kept, lower)), axis=0)[: k + 1]
        if len(kept):
            names = np.repeat(np.arange(groups), len(kept))
            yield pd.DataFrame({"group": names, "bound": kept.T.ravel()})

    bounds = data.mapInPandas(best_bounds, "group int, bound double").groupBy("group")
    floors = np.full(groups, -np.inf)
    for r in bounds.agg(
        F.slice(F.sort_array(F.collect_list("bound"), asc=False), k + 1, 1).alias("at")
    ).collect():
        floors[r["group"]] = r["at"][0] if r["at"] else -np.inf

    # each vector to the teams with a group it can matter to: cells first, then row by row
    possible = (centre.reach(cell_radius, cell_norm, radius) >= floors) & (waiting > 0)
    team = _teams(centre.chain(), waiting, block)
    teams = int(team.max()) + 1
    member = np.zeros((groups, teams))
    member[np.arange(groups), team] = 1
    live = [int(c) for c in np.flatnonzero(possible.any(1))]

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            _, upper = centre.bounds(_matrix(batch["vec"], width), radius)
            wanted = (upper >= floors) & possible[batch["cell"].to_numpy()]
            at, to = np.nonzero(wanted @ member)
            yield _spread(batch.iloc[at], to, ["vec", "ids"])

    near = data.where(F.col("cell").isin(live)).select("vec", "ids", "cell")
    sent = near.mapInPandas(send, "vec binary, ids array<long>, group int")
    placed = placed.withColumn("group", F.array(*[F.lit(int(t)) for t in team])[F.col("group")])
    # sizes of the cells a team may need bound what it gets
    coming = ((possible @ member) > 0).T @ cell_size
    parts = np.maximum(1, -(-coming // block)).tolist()
    turns = np.maximum(1, -(-(waiting @ member).astype(np.int64) // block)).tolist()
    per_team = lambda values: F.array(*[F.lit(int(v)) for v in values])[F.col("group")]
    hashed = F.xxhash64("vec")
    left = sent.withColumn("part", F.pmod(hashed, per_team(parts)).cast("int")).withColumn(
        "turn", F.explode(F.sequence(F.lit(0), per_team(turns) - 1))
    )
    right = placed.withColumn("turn", F.pmod(hashed, per_team(turns)).cast("int")).withColumn(
        "part", F.explode(F.sequence(F.lit(0), per_team(parts) - 1))
    )

    def solve(data_part: pd.DataFrame, query_part: pd.DataFrame) -> pd.DataFrame:
        columns = {"vec": [], "best": [], "ids": []}
        if len(data_part) and len(query_part):
            ids = np.concatenate(data_part["ids"].to_list())
            owner = np.repeat(np.arange(len(data_part)), data_part["ids"].map(len))
            order = np.argsort(ids, kind="stable")
            ids, owner = ids[order], owner[order]
            x = _matrix(data_part["vec"], width)
            for at in range(0, len(query_part), 256):
                chunk = query_part["vec"].iloc[at : at + 256]
                scores = _products(_matrix(chunk, width), x)[:, owner]
                for raw, row in zip(chunk.tolist(), scores):
                    if len(row) > k + 1:
                        least = np.partition(row, len(row) - k - 1)[len(row) - k - 1]
                        near = np.flatnonzero(row >= least)
                    else:
                        near = np.arange(len(row))
                    top = near[np.argsort(-row[near], kind="stable")[: k + 1]]
                    columns["vec"].append(raw)
                    columns["best"].append(row[top])
                    columns["ids"].append(ids[top])
        return pd.DataFrame({k: pd.Series(v, dtype=object) for k, v in columns.items()})

    keys = ["group", "turn", "part"]
    solved = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        solve, "vec binary, best array<long>, ids array<long>"
    )
    pairs = F.arrays_zip(F.transform("best", lambda s: -s).alias("s"), F.col("ids").alias("i"))
    merged = solved.groupBy("vec").agg(
        F.slice(F.array_sort(F.flatten(F.collect_list(pairs))), 1, k + 1).alias("found")
    )
    answers = queries.distinct().join(merged, "vec").select(
        F.col("id").alias("query_id"),
        F.slice(F.filter("found", lambda f: f["i"] != F.col("id")), 1, k).alias("found"),
    )
    return answers.select("query_id", F.posexplode("found").alias("at", "one")).select(
        "query_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("one.i").alias(key),
        (-F.col("one.s")).alias("score"),
    )
