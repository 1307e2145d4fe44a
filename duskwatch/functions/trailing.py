"""Sums over a trailing time range, in linear time and without one-task-per-key windows.

``sum(v) over (partition by key order by t range between R preceding and current row)`` has
two costs at scale: a window partition holds a key's whole history in one task, and the
sliding frame is summed afresh for every row.  Cutting time into chunks of length R removes
both.  A frame ``[t - R, t]`` then covers the beginning of t's own chunk and the end of the
chunk before.  So every point is emitted twice, once at its own time and once R later (its
*echo*, which always lands in the following chunk), and per (key, chunk)

* an ascending running sum over points gives the part since the chunk began,
* a descending running sum over echoes gives the part of the previous chunk still in reach.

Both only ever add, so there is no cancellation error, and no window partition is larger
than two chunks of one key: at most 2 * R rows, since points are unique per second (with several
ranges, one chunk more for each).

Several ranges, each a multiple of the next, share one emission and one shuffle: chunks of the
shorter range lie within those of the longer, so rows brought together by the longer chunk are
together for all.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame

from duskwatch.functions.literals import quoted


def nested(reaches: Sequence[int]) -> bool:
    """Whether one emission can serve these ranges: none is zero, each divides the next longer."""
    ordered = sorted(reaches, reverse=True)
    return ordered[-1] > 0 and all(a % b == 0 for a, b in zip(ordered, ordered[1:]))


def with_trailing_sums(
    points: DataFrame, keys: Sequence[str], second: str, reaches: Mapping[int, Mapping[str, str]]
) -> DataFrame:
    """Add, for each reach and each ``new: column`` under it, the column's sum over ``[t-reach, t]``.

    ``points`` holds one row per (keys, second); ``second`` is a whole number of seconds.  The
    summed columns must not be null.  A point without a time sees only itself.
    """
    if not nested(list(reaches)):
        if len(reaches) > 1:
            for reach, sums in reaches.items():
                points = with_trailing_sums(points, keys, second, {reach: sums})
            return points
        (sums,) = reaches.values()
        return points.selectExpr(
            "*", *[f"{quoted(old)} AS {quoted(new)}" for new, old in sums.items()]
        )

    ordered = sorted(reaches, reverse=True)
    t, key_list = quoted(second), ", ".join(quoted(k) for k in keys)
    # __reach is null for the point itself, else the reach that its echo serves
    here = f"named_struct('__reach', CAST(null AS BIGINT), '__at', {t})"
    later = [f"named_struct('__reach', {reach}L, '__at', {t} + {reach})" for reach in ordered]
    emitted = f"inline(if({t} IS NULL, array({here}), array({', '.join([here, *later])})))"
    up = [f"__chunk_{reach}" for reach in ordered]
    down = [up[0], *[f"{c}_down" for c in up[1:]]]
    carried_by_echo = {*keys, *(old for sums in reaches.values() for old in sums.values())}
    spread = points.selectExpr("*", emitted).selectExpr(
        "__reach",
        "__at",
        *[f"__at - pmod(__at, {reach}) AS {c}" for reach, c in zip(ordered, up)],
        *[f"pmod(__at, {reach}) - __at AS {c}" for reach, c in zip(ordered[1:], down[1:])],
        *[
            quoted(c)
            if c in carried_by_echo
            else f"if(__reach IS NOT NULL, null, {quoted(c)}) AS {quoted(c)}"
            for c in points.columns
        ],
    )

    # Longest first: its windows ask for the distribution that those of the others can use.  Each
    # orders by the shorter chunks before the time, which is the same order, so that one sort
    # serves all ascending windows and one all descending ones.
    def sums(chunks: list[str], last: str, name: str, value: Callable[[int, str], str]) -> None:
        nonlocal spread
        for depth, reach in enumerate(ordered, 1):
            over = (
                f"PARTITION BY {key_list}, {', '.join(chunks[:depth])}"
                f" ORDER BY {', '.join([*chunks[depth:], last])} ROWS UNBOUNDED PRECEDING"
            )
            spread = spread.selectExpr(
                "*",
                *[
                    f"sum({value(reach, quoted(old))}) OVER ({over}) AS {quoted(name + new)}"
                    for new, old in reaches[reach].items()
                ],
            )

    sums(up, "__at", "__since_", lambda reach, old: f"if(__reach IS NULL, {old}, null)")
    # True of every row; a test of a sum keeps the optimizer from mixing the two orders.
    added = [new for reach in ordered for new in reaches[reach]]
    spread = spread.where(f"__reach IS NOT NULL OR {quoted('__since_' + added[-1])} IS NOT NULL")
    # Points are unique per second; an echo of the same second is still in reach, so it goes first.
    sums(
        down, "__at DESC, __reach DESC NULLS LAST", "__before_",
        lambda reach, old: f"if(__reach = {reach}, {old}, null)",
    )
    parts = [(quoted(f"__since_{new}"), quoted(f"__before_{new}"), quoted(new)) for new in added]
    return spread.where("__reach IS NULL").selectExpr(
        *[quoted(c) for c in points.columns],
        *[f"{since} + coalesce({before}, 0) AS {new}" for since, before, new in parts],
    )
