"""Secrets: exact patterns, and windows of high entropy that they miss.

Candidates are runs of at least ``WINDOW`` characters of the alphabet in which keys are written.
A window slides over each; the number of times every character is in it is kept up to date, and
with it the Shannon entropy, one addition and one removal a step.  The limit depends on the
characters the window holds (digits and one case of a-f; letters of one case and digits; both
cases).  Windows above it join into spans.  What base spans cover and what the allow-list knows is
cut out of a run first, and windows slide over each piece that is left: a key beside a listed word
or a base span is found, the word itself is not.

Defined results: a null text is empty, an empty text has no spans; rows are independent of each
other and other columns are ignored.  A base span is never changed or dropped, and a span of
kind ``entropy`` never overlaps one.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate
from math import log2

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")
SPANS = "array<struct<kind:string,start:int,end:int,exact:boolean>>"
WINDOW = 20

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ASSIGN_CUES = ("passw", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}+")
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+")

# Bits of entropy that a window of each class must reach
LIMITS = {"hex": 3.0, "one case": 3.7, "both cases": 3.8}
# What looks random and is no secret (identifiers, digests of public files), and words
# that mark the part between two separators in which they stand
ALLOWED = (
    r"(?<![0-9a-fA-F])[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}(?![0-9a-fA-F])",
    r"(?i:sha(1|256|384|512)-[a-z0-9+/=]+)",
)
MARKERS = r"(?i:example|sample|placeholder|changeme|your[_-]?key|xxxx|0123456789|abcdefgh)"
_ALLOWED = re.compile("|".join(f"(?:{a})" for a in ALLOWED))
_MARKERS = re.compile(MARKERS)
_SEPARATOR = re.compile("[/=]")
# n log2 n, by which the entropy of counts is kept up to date
_LOGS = [0.0] + [n * log2(n) for n in range(1, WINDOW + 1)]


def _class_of(lower: int, upper: int, digits: int, beyond_hex: int) -> str | None:
    """Class of a window from how many characters of each sort it holds; None: no secret's."""
    if not digits or not lower + upper:
        return None
    if not beyond_hex:
        return "hex" if not (lower and upper) else "both cases"
    return "both cases" if lower and upper else "one case"


def entropy_spans(run: str, limits: dict[str, float] | None = None) -> list[tuple[int, int]]:
    """Stretches of ``run`` covered by windows whose entropy reaches their class's limit."""
    limits = LIMITS if limits is None else limits
    counts: dict[str, int] = {}
    sums, sorts = 0.0, [0, 0, 0, 0]  # lower, upper, digits, beyond hexadecimal
    spans: list[list[int]] = []

    def count(character: str, by: int) -> None:
        nonlocal sums
        before = counts.get(character, 0)
        counts[character] = before + by
        sums += _LOGS[before + by] - _LOGS[before]
        sorts[0 if character.islower() else 1 if character.isupper() else 2] += (
            by if character.isalnum() else 0
        )
        sorts[3] += by if character not in "0123456789abcdefABCDEF" else 0

    for at, character in enumerate(run):
        if at >= WINDOW:
            count(run[at - WINDOW], -1)
        count(character, 1)
        if at < WINDOW - 1:
            continue
        sort = _class_of(*sorts)
        if sort is None or log2(WINDOW) - sums / WINDOW < limits[sort] - 1e-9:
            continue
        start = at - WINDOW + 1
        if spans and start <= spans[-1][1]:
            spans[-1][1] = at + 1
        else:
            spans.append([start, at + 1])
    return [(s, e) for s, e in spans]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """What the patterns find, by start and then kind."""
    found = []
    lowered = text.lower()
    if any(cue in lowered for cue in _ASSIGN_CUES):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def allowed_spans(run: str) -> list[tuple[int, int]]:
    """What the allow-list knows of a run: its matches, and the parts that hold a marker."""
    found, done = [m.span() for m in _ALLOWED.finditer(run)], 0
    for marker in _MARKERS.finditer(run):
        if marker.end() <= done:
            continue
        start = max(done, run.rfind("/", done, marker.start()) + 1, run.rfind("=", done, marker.start()) + 1)
        after = _SEPARATOR.search(run, marker.end())
        done = after.start() if after else len(run)
        found.append((start, done))
    return found


def _left_over(length: int, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The stretches of 0 to ``length`` outside all of ``taken``."""
    out, at = [], 0
    for start, end in sorted(taken):
        if start > at:
            out.append((at, start))
        at = max(at, end)
    return out + [(at, length)] if at < length else out


def find(text: str | None) -> list[tuple[str, int, int, bool]]:
    """All spans of a text, by start and then kind; the last field marks base spans."""
    text = text or ""
    base = base_spans(text)
    every = [(*s, True) for s in base]
    nearest = 0  # base spans before it end before the current run
    reach = list(accumulate((e for _, _, e in base), max))
    for run in _CANDIDATE.finditer(text):
        if run[0].isalpha() or not any(c.isdigit() for c in run[0]):
            continue
        nearest = bisect_right(reach, run.start(), nearest)
        taken, at = allowed_spans(run[0]), nearest
        while at < len(base) and base[at][1] < run.end():
            taken.append((base[at][1] - run.start(), base[at][2] - run.start()))
            at += 1
        for start, end in _left_over(len(run[0]), taken):
            for s, e in entropy_spans(run[0][start:end]):
                every.append(("entropy", run.start() + start + s, run.start() + start + e, False))
    return sorted(every, key=lambda s: (s[1], KINDS.index(s[0])))


def detected(text: Column) -> Column:
    """Array of spans (kind, start, end, exact) of a text column."""
    names = ("kind", "start", "end", "exact")

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(
                [[dict(zip(names, s)) for s in find(t)] for t in texts.tolist()], dtype=object
            )

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, SPANS).asNondeterministic()(text)
