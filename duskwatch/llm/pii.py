"""Personal data: exact patterns, and a character LSTM-CRF that adds what they miss.

The patterns give the *base* spans.  The tagger learns from spans that they label in windows of
about ``sample_documents`` documents (drawn by hash); a third of the phone numbers lose their country
code in training, so that it learns the form and not the plus sign.  Every kind of personal data
here holds a digit or an @; the tagger decodes overlapping windows over each stretch of text
around such characters and no others.  Its spans are reconciled over the whole text - parts of
one kind that overlap are joined, of different kinds the one with most context on both sides
stays - and then checked exactly (digits, check sum, nothing alphanumeric at either end).  A
base span is never changed or dropped.

Defined results: a null text is empty, and an empty text has no spans.  Rows are independent,
so repeated rows and equal keys give equal results.  Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwatch.llm.tagger import WINDOW, CharacterTagger

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind:string,start:int,end:int,exact:boolean>>"
SAMPLE_DOCUMENTS = 20_000
MARGIN = 20  # characters of context around a digit or @
STRIDE = WINDOW // 2

Span = tuple[str, int, int]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_CUE = re.compile(r"[0-9@]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number is right."""
    total = 0
    for i, digit in enumerate(map(int, reversed(digits))):
        doubled = digit * 2 if i % 2 else digit
        total += doubled - 9 if doubled > 9 else doubled
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[Span]:
    """Around each @, so that a long run of letters is not tried from every start."""
    after = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            after = domain.end()
            yield "email", start, after
        at = text.find("@", max(at + 1, after))


def is_ip(text: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part[-3:]) <= 255 for part in text.split("."))


def is_card(text: str) -> bool:
    digits = _digits(text)
    return 12 <= len(digits) <= 19 and luhn(digits)


def is_phone(text: str) -> bool:
    return 9 <= len(_digits(text)) <= 15


def base_spans(text: str) -> list[Span]:
    """What the patterns find, by start and then kind."""
    found = list(_emails(text))
    for kind, pattern, right in (("ip", _IP, is_ip), ("card", _CARD, is_card), ("phone", _PHONE, is_phone)):
        found += [(kind, *m.span()) for m in pattern.finditer(text) if right(m[0])]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def windows(text: str) -> list[int]:
    """Starts of the windows to decode: overlapping by half over each stretch around cues."""
    starts: list[int] = []
    stretch_start, stretch_end = 0, None  # no stretch yet

    def close() -> None:
        if stretch_end is not None:
            last = max(stretch_start, stretch_end - WINDOW)
            starts.extend(range(stretch_start, last, STRIDE))
            starts.append(last)

    for cue in _CUE.finditer(text):
        at = cue.start()
        if stretch_end is None or at - MARGIN > stretch_end:
            close()
            stretch_start = max(0, at - MARGIN)
        stretch_end = min(len(text), at + 1 + MARGIN)
    close()
    return starts


def reconcile(found: list[tuple[Span, int]]) -> list[Span]:
    """One set of spans that do not overlap, from spans with the context they were seen in."""
    joined: list[list] = []
    for (kind, start, end), context in sorted(found, key=lambda f: (f[0][0], f[0][1], f[0][2])):
        if joined and joined[-1][0] == kind and start < joined[-1][2]:
            joined[-1][2] = max(joined[-1][2], end)
            joined[-1][3] = max(joined[-1][3], context)
        else:
            joined.append([kind, start, end, context])
    kept: list[Span] = []
    for kind, start, end, _ in sorted(joined, key=lambda j: (-j[3], j[1], j[2], j[0])):
        if all(end <= s or start >= e for _, s, e in kept):
            kept.append((kind, start, end))
    return kept


def plausible(text: str, span: Span) -> bool:
    """Exact check of a span that the tagger added."""
    kind, start, end = span
    inner = text[start:end]
    if any(c.isalnum() or c in "@_" for c in (text[start - 1 : start] + text[end : end + 1])):
        return False
    if kind == "email":
        return inner.count("@") == 1 and len(inner.split()) == 1 and inner[0] != "@" != inner[-1]
    if kind == "ip":
        return bool(re.fullmatch(r"[0-9]{1,3}(?:[.\x20,-][0-9]{1,3}){3}", inner)) and all(
            int(part) <= 255 for part in re.split(r"[^0-9]", inner)
        )
    if kind == "card":
        return bool(re.fullmatch(r"[0-9][0-9\x20.-]+[0-9]", inner)) and is_card(inner)
    return bool(re.fullmatch(r"[(+]?[0-9][\x20().0-9-]*[\x20().-][\x20().0-9-]*[0-9]", inner)) and is_phone(inner)


def _training_windows(
    texts: list[str | None], turn_at: int = 0
) -> tuple[list[str], list[list[Span]]]:
    """Windows of texts with the base spans inside; windows that cut a span are left out."""
    shown, labels = [], []
    for number, text in enumerate((t or "" for t in texts), turn_at):
        base = base_spans(text)
        for turn, start in enumerate(windows(text)):
            piece = text[start : start + WINDOW]
            inside = [(k, s - start, e - start) for k, s, e in base if s >= start and e <= start + len(piece)]
            cut = any(s < start + len(piece) and e > start for _, s, e in base) and not inside
            apart = all(a[2] <= b[1] for a, b in zip(inside, inside[1:]))
            if cut or not apart:
                continue
            if (number + turn) % 3 == 0 and len(inside) == 1 and inside[0][0] == "phone":
                _, s, e = inside[0]
                code = re.match(r"\+[0-9]+[\x20-]?", piece[s:e])
                piece = piece[:s] + piece[s + len(code[0]) :]
                inside = [("phone", s, e - len(code[0]))]
            shown.append(piece)
            labels.append(inside)
    return shown, labels


def fit(
    docs: DataFrame,
    *,
    text: str = "text",
    key: str = "doc_id",
    sample_documents: int = SAMPLE_DOCUMENTS,
    most_windows: int = 3000,
) -> CharacterTagger:
    """Train on at most ``most_windows`` windows of about ``sample_documents`` documents.

    The documents are those whose hash lies under the share that gives this number; tasks cut
    them into labelled windows, which alone go to the driver.
    """
    share = min(1.0, sample_documents / max(docs.count(), 1))
    draw = F.xxhash64(F.col(key).cast("string"), F.col(text))
    rows = docs.select(draw.alias("draw"), F.col(text).alias("text")).where(
        (F.abs(F.col("draw") / F.lit(2.0**63)) <= share) & F.col("text").rlike("[0-9@]")
    )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                for i, (piece, spans) in enumerate(zip(*_training_windows([row.text], row.draw % 3))):
                    out.append((row.draw, i, piece, ",".join(f"{k}:{s}:{e}" for k, s, e in spans)))
            yield pd.DataFrame(out, columns=["draw", "number", "piece", "spans"])

    parts = rows.mapInPandas(cut, "draw long, number long, piece string, spans string")
    parts = parts.orderBy(F.xxhash64("draw", "number"), "draw", "number", "piece").limit(most_windows)
    tagger, shown, labels = CharacterTagger(KINDS), [], []
    for r in parts.collect():
        shown.append(r["piece"])
        found = [s.split(":") for s in r["spans"].split(",") if s]
        labels.append([(k, int(s), int(e)) for k, s, e in found])
    if shown:
        tagger.train(shown, labels)
    return tagger


def find(texts: list[str | None], tagger: CharacterTagger | None) -> list[list[tuple[str, int, int, bool]]]:
    """All spans of each text, by start and then kind; the last field marks base spans."""
    plain = [t or "" for t in texts]
    base = [base_spans(t) for t in plain]
    added: list[list[tuple[Span, int]]] = [[] for _ in plain]
    if tagger is not None and tagger.trained:
        places = [(i, start) for i, t in enumerate(plain) for start in windows(t)]
        pieces = [plain[i][start : start + WINDOW] for i, start in places]
        for (i, at), piece, spans in zip(places, pieces, tagger.decode(pieces)):
            for kind, s, e in spans:
                added[i].append(((kind, at + s, at + e), min(s, len(piece) - e)))
    out = []
    for text, known, seen in zip(plain, base, added):
        more = [
            span
            for span in (reconcile(seen) if seen else [])
            if all(span[2] <= s or span[1] >= e for _, s, e in known) and plausible(text, span)
        ]
        every = [(*s, True) for s in known] + [(*s, False) for s in more]
        out.append(sorted(every, key=lambda s: (s[1], KINDS.index(s[0]), s[2])))
    return out


def detected(text: Column, tagger: CharacterTagger | None) -> Column:
    """Array of spans (kind, start, end, exact) of a text column."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = find(texts.tolist(), tagger)
            names = ("kind", "start", "end", "exact")
            yield pd.Series([[dict(zip(names, s)) for s in spans] for spans in found], dtype=object)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, SPANS).asNondeterministic()(text)


def redacted(text: Column, tagger: CharacterTagger | None) -> Column:
    """The text with every span replaced by its kind in brackets; null stays null."""

    def mask(value: str | None, spans) -> str | None:
        if not spans:
            return value
        parts, at = [], 0
        for kind, start, end, _ in spans:
            if start >= at:
                parts += [value[at:start], f"[{kind.upper()}]"]
            at = max(at, end)
        return "".join([*parts, value[at:]])

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values = texts.tolist()
            masked = [mask(v, s) for v, s in zip(values, find(values, tagger))]
            yield pd.Series(masked, dtype=object)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "string").asNondeterministic()(text)


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")
