"""Main text of web pages: boosted trees over block features and a consistent tree labelling.

Each node of a page's block tree is *in* (all its text is main text), *out* (none is) or *mixed*.
Gradient-boosted trees give the log-probability of each; decoding picks the labelling of greatest
sum in which everything below an *in* node is in, everything below an *out* node is out, and a
leaf is not mixed, so an ancestor and a descendant never contradict each other.  The text of the
in leaves, in page order, is the result.

The trees are trained here, on pages put together by ``training_pages``: text pieces of a bounded
sample of real pages (``SAMPLE`` pages, drawn by hash) are set into layouts whose parts are known
to be main text or not.  Every part gets pieces of every length, so the layout teaches, not the
words.  Decisions are made for every page from the whole of it.

Defined results: null, empty or tag-less html gives what text there is outside tags (a page that
is nothing but text is its own main text); references are decoded; white space (any that Unicode
knows, after decoding) becomes one space, blocks are joined by one space, nothing else is cut.
Unclosed or misnested tags never fail.  Repeated rows give repeated rows; other columns, of any
name, are ignored.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwatch.llm import boosting, dom

IN, OUT, MIXED = 0, 1, 2
SAMPLE = 300  # pages whose text pieces training layouts are filled with
LAYOUTS = 700  # training pages
PIECES = 40  # of one sampled page at most; bounds the training text, not what is extracted
LONGEST = 2000  # characters of a training piece


class _Layout:
    """One training page; ``data-t`` marks what is main text."""

    def __init__(self, pieces: list[str], draw: random.Random) -> None:
        self.pieces, self.draw = pieces, draw

    def chance(self, p: float) -> bool:
        return self.draw.random() < p

    def text(self, longest: int = LONGEST) -> str:
        piece = self.draw.choice(self.pieces)
        if len(piece) > longest:
            words = piece.split(" ")
            piece = " ".join(words[: self.draw.randint(1, max(1, longest // 6))])
        return piece.replace("&", "&amp;").replace("<", "&lt;")

    def named(self, tags: str, names: str, plain: float = 0.2) -> tuple[str, str]:
        """Open and close tag; a div needs a name to be told, others may go without."""
        tag = self.draw.choice(tags.split())
        words = names.split()
        label = self.draw.choice(words)
        if self.chance(0.3):
            label += self.draw.choice("- _".split(" ")) + self.draw.choice(["box", "area", "1", "list", *words])
        kind = self.draw.choice(("class", "id", "class"))
        bare = tag not in ("div", "ul", "section", "p") and self.chance(0.6)
        return (f"<{tag}>" if bare else f'<{tag} {kind}="{label}">'), f"</{tag}>"

    def paragraphs(self, least: int, most: int, longest: int = LONGEST) -> str:
        out = []
        for _ in range(self.draw.randint(least, most)):
            text = self.text(longest)
            if self.chance(0.15):
                words = text.split(" ")
                at = self.draw.randrange(len(words))
                words[at] = self.draw.choice(('<a href="/x">%s</a>', "<b>%s</b>", "<em>%s</em>")) % words[at]
                text = " ".join(words)
            start = "<p><b>" if self.chance(0.15) else "<p>"
            out.append(start + text + ("<br>" if self.chance(0.15) else "</p>"))
        return "".join(out)

    def links(self) -> str:
        n = self.draw.randint(2, 9)
        items = "".join(f'<li><a href="/{i}">{self.text(40)}</a></li>' for i in range(n))
        return f"<ul>{items}</ul>" if self.chance(0.8) else items.replace("li>", "span>")

    def menu(self) -> str:
        a, b = self.named("nav nav div ul", "nav menu navbar breadcrumbs main-nav")
        return a + self.links() + b

    def header(self) -> str:
        a, b = self.named("header div", "header masthead site-header top-bar branding")
        title = f"<h1>{self.text(60)}</h1>" if self.chance(0.5) else f"<a href='/'>{self.text(40)}</a>"
        return a + title + (self.paragraphs(0, 1, 150)) + (self.menu() if self.chance(0.4) else "") + b

    def advert(self) -> str:
        a, b = self.named("div div div aside section", "ad ads advert sponsored promo banner ad-slot", 0)
        return a + (self.text(300) if self.chance(0.6) else self.paragraphs(1, 2, 300)) + b

    def notice(self) -> str:
        a, b = self.named("div section aside", "cookie-notice notice alert consent newsletter popup subscribe", 0)
        field = "<button>OK</button>" if self.chance(0.5) else ""
        return a + (self.paragraphs(1, 2, 400) if self.chance(0.7) else self.text(200)) + field + b

    def sidebar(self) -> str:
        a, b = self.named("aside aside div section", "sidebar related widget rail recommended more")
        head = f"<h3>{self.text(40)}</h3>" if self.chance(0.6) else ""
        return a + head + (self.links() if self.chance(0.6) else self.paragraphs(1, 3, 500)) + b

    def form(self) -> str:
        a, b = self.named("form", "search-form login contact subscribe")
        asked = f"<label>{self.text(40)}</label><input name='q'>"
        return a + asked + (self.paragraphs(0, 1, 120)) + f"<button>{self.text(20)}</button>" + b

    def comments(self) -> str:
        a, b = self.named("section div div ol", "comments comment-list discussion replies responses", 0)
        head = f"<h3>{self.text(30)}</h3>" if self.chance(0.5) else ""
        each = self.draw.choice(("div", "li", "article"))
        said = "".join(
            f'<{each} class="{self.draw.choice(("comment", "reply", "comment-body"))}">'
            + (f"<b>{self.text(20)}</b>" if self.chance(0.5) else "")
            + self.paragraphs(1, 2, 900) + f"</{each}>"
            for _ in range(self.draw.randint(1, 5))
        )
        return a + head + (said if self.chance(0.8) else self.paragraphs(1, 4)) + b

    def footer(self) -> str:
        a, b = self.named("footer footer div", "footer site-footer copyright imprint")
        said = self.text(200) if self.chance(0.6) else self.paragraphs(1, 2, 300)
        return a + "&copy; " + said + (self.links() if self.chance(0.3) else "") + b

    def share(self) -> str:
        a, b = self.named("div ul", "share social tags byline", 0)
        return a + self.links() + b

    def out(self, part: str) -> str:
        return part.replace(">", ' data-t="0">', 1)

    def body(self) -> str:
        """Main text, sometimes with other parts inside."""
        parts = [f"<h1>{self.text(120)}</h1>"] if self.chance(0.8) else []
        parts.append(self.paragraphs(0 if parts else 1, 14))
        for _ in range(self.draw.choice((0, 0, 0, 1, 2))):
            items = "".join(f"<li>{self.text(300)}</li>" for _ in range(self.draw.randint(2, 5)))
            rows = "".join(f"<tr><td>{self.text(30)}</td><td>{self.text(60)}</td></tr>" for _ in range(3))
            parts.append(
                self.draw.choice((
                    f"<h2>{self.text(80)}</h2>", f"<ul>{items}</ul>", f"<ol>{items}</ol>",
                    f"<blockquote>{self.text(600)}</blockquote>", f"<pre>{self.text(300)}</pre>",
                    f"<table>{rows}</table>", f"<h3>{self.text(60)}</h3>",
                    f"<figure><img src='x'><figcaption>{self.text(100)}</figcaption></figure>",
                    f"<section><h2>{self.text(60)}</h2>{self.paragraphs(1, 3)}</section>",
                    f"<div>{self.paragraphs(1, 3)}</div>",
                ))
            )
            parts.append(self.paragraphs(0, 5))
        other = (self.advert, self.share, self.sidebar, self.notice, self.form, self.comments)
        if self.chance(0.3):
            at = self.draw.randint(1, len(parts))
            parts.insert(at, self.out(self.draw.choice(other)()))
        return "".join(parts)

    def page(self) -> str:
        d = self.draw
        tag = d.choice(("article", "article", "article", "main", "div", "section", "main article", "div div"))
        names = "content post entry article-body story main-text post-content main"
        opened, closed = "", ""
        for i, t in enumerate(tag.split()):
            need = t in ("div", "section")
            label = f' {d.choice(("class", "id"))}="{d.choice(names.split())}"' if need or self.chance(0.3) else ""
            opened += f'<{t}{label} data-t="1">' if i == len(tag.split()) - 1 else f"<{t}{label}>"
            closed = f"</{t}>" + closed
        before = [self.out(part()) for part in (self.header, self.menu, self.notice, self.advert, self.sidebar, self.form)
                  if self.chance(0.35)]
        after = [self.out(part()) for part in (self.comments, self.sidebar, self.advert, self.share, self.footer, self.notice)
                 if self.chance(0.35)]
        if self.chance(0.4):  # the plainest layout of all
            before = [self.out(self.menu()), self.out(self.advert())]
            after = [self.out(self.footer())]
        elif self.chance(0.3):
            d.shuffle(before)
            d.shuffle(after)
        inner = "".join(before) + opened + self.body() + closed + "".join(after)
        if self.chance(0.25):
            inner = f'<div {d.choice(("id", "class"))}="{d.choice(("page", "wrapper", "container"))}">{inner}</div>'
        return f"<!DOCTYPE html><html><head><title>x</title></head><body>{inner}</body></html>"


def training_pages(pieces: list[str], number: int = LAYOUTS, seed: int = 7) -> list[str]:
    """Pages whose parts are marked by ``data-t`` (1 for main text)."""
    draw = random.Random(seed)
    return [_Layout(pieces or ["text"], draw).page() for _ in range(number)]


def labelled(page: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and label of each node with text of a marked page."""
    nodes = dom.parse(page)
    x, texts = dom.features(nodes)
    index = {id(v): i for i, v in enumerate(nodes)}
    main, other = [0] * len(nodes), [0] * len(nodes)
    for i in range(len(nodes) - 1, -1, -1):
        if texts[i]:
            main[i] += nodes[i].mark == "1"
            other[i] += nodes[i].mark != "1"
        if nodes[i].parent is not None:
            up = index[id(nodes[i].parent)]
            main[up] += main[i]
            other[up] += other[i]
    label = [IN if not o else OUT if not m else MIXED for m, o in zip(main, other)]
    held = [i for i in range(len(nodes)) if main[i] or other[i]]
    return x[held], np.array(label, dtype=np.int64)[held]


def decode(nodes: list[dom.Node], scores: np.ndarray) -> list[bool]:
    """Whether each node is in, by the best labelling without contradictions."""
    index = {id(v): i for i, v in enumerate(nodes)}
    best = scores.copy()  # of the subtree, by the label of its top
    for i in range(len(nodes) - 1, -1, -1):
        if not nodes[i].kids:
            best[i, MIXED] = -np.inf
        if nodes[i].parent is not None:
            best[index[id(nodes[i].parent)]] += (best[i, IN], best[i, OUT], best[i].max())
    inside, label = [False] * len(nodes), [MIXED] * len(nodes)
    for i, node in enumerate(nodes):
        up = MIXED if node.parent is None else label[index[id(node.parent)]]
        label[i] = int(best[i].argmax()) if up == MIXED else up
        inside[i] = label[i] == IN
    return inside


def extract(html: str | None, forest: boosting.Forest) -> str:
    return _extracted([html], forest)[0]


def _extracted(pages: list[str | None], forest: boosting.Forest) -> list[str]:
    """Main text of each page; the trees are asked once for all nodes that hold text."""
    read = []
    for html in pages:
        nodes = dom.parse(html)
        x, texts = dom.features(nodes)
        held = np.flatnonzero(x[:, _CHARS] > 0)
        read.append((nodes, texts, x[held], held))
    rows = np.concatenate([r[2] for r in read]) if read else np.empty((0, len(dom.FEATURES)))
    told, at, out = forest.log_probabilities(rows), 0, []
    for nodes, texts, x, held in read:
        if not any(t for n, t in zip(nodes, texts) if n.tag != "#text") and sum(map(bool, texts)) == 1:
            out.append("".join(texts))  # nothing but text
        else:
            scores = np.zeros((len(nodes), 3))
            scores[held] = told[at : at + len(x)]
            inside = decode(nodes, scores)
            out.append(" ".join(t for t, keep in zip(texts, inside) if keep and t))
        at += len(x)
    return out


_CHARS = dom.FEATURES.index("chars")


def fit(pages: DataFrame, *, html: str = "html", sample: int = SAMPLE, layouts: int = LAYOUTS) -> boosting.Forest:
    """Trees trained on layouts that are filled with text pieces of ``sample`` pages."""

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for page in batch["html"].tolist():
                texts = [dom.block_text(v) for v in dom.parse(page) if not v.kids]
                found += [t[:LONGEST] for t in texts if t][:PIECES]
            yield pd.DataFrame({"piece": found})

    rows = pages.select(F.col(html).alias("html")).where("html is not null")
    share = min(1.0, 4 * sample / max(1, rows.count()))  # few reach the sort; equal pages are one
    draw = F.xxhash64("html", F.lit(1))
    few = rows.withColumn("draw", draw).where(F.pmod("draw", F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    drawn = few.groupBy("draw").agg(F.min("html").alias("html")).orderBy("draw").limit(sample)
    texts = drawn.select("html").mapInPandas(pieces, "piece string").distinct()
    held = sorted(r["piece"] for r in texts.collect())  # at most sample x PIECES pieces
    parts = [labelled(page) for page in training_pages(held, layouts)]
    x, y = (np.concatenate(side) for side in zip(*parts))
    return boosting.fit(x, y, 3)


def main_text(html: Column, forest: boosting.Forest) -> Column:
    """Main text of an html column; never null."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            values = batch.tolist()
            yield pd.Series(
                [t for at in range(0, len(values), 64) for t in _extracted(values[at : at + 64], forest)],
                dtype=object,
            )

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "string").asNondeterministic()(html)
