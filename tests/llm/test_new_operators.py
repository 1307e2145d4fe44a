"""Spelling variants, hard negatives and main text: brute force, known layouts, awkward rows."""

import random
import re
import zlib
from collections import Counter, defaultdict
from html import unescape

import numpy as np
import pytest
from pyspark.sql import functions as F

from duskwatch.llm import boosting, dom, extraction, hard_negatives, variants
from duskwatch.llm.cover_tree import CoverTree

SMALL = "/root/testdata/sf0.001"


# -- spelling variants
def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_forms(counts, times=5):
    near = {a: [b for b in counts if one_edit(a, b)] for a in counts}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        if best is not None and counts[best] >= times * counts[word]:
            form[word] = best

    def root(word):
        while word in form:
            word = form[word]
        return word

    return {(w, form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items()}


def plain_counts(rows, damage=199):
    out = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def result(df):
    return {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()}


def test_variants_are_those_of_all_pairs(spark, awkward, nothing):
    draw = random.Random(3)
    base = ["bananas", "anananas", "oranges", "grapefruit", "électrique", "aaaaaaa", "z" * 31, "q" * 40]
    words = set(base)
    for _ in range(260):
        w = draw.choice(sorted(words))
        at = draw.randrange(len(w) + 1)
        kind = draw.randrange(3)
        letter = draw.choice("abnzéÿ")
        words.add(w[:at] + letter + w[at:] if kind == 0 else w[:at] + w[at + 1 :] if kind == 1 else w[:at] + letter + w[at + 1 :])
    counts = {w: draw.choice((5, 6, 25, 26, 125, 700, 5000)) for w in words if len(w) >= 6}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long").withColumn("form", F.lit("x"))
    expected = plain_forms(counts)
    assert result(variants.forms(frame)) == expected
    assert result(variants.forms(frame, depth=8)) == expected  # most words through deletions
    chain = spark.createDataFrame([("cat" * 4 + c, 5 ** (i + 1)) for i, c in enumerate(["", "a", "ab", "abc", "abcd", "abcde"])], "word string, n long")
    assert {r["root"] for r in variants.forms(chain).collect()} == {"cat" * 4 + "abcde"}
    assert variants.forms(variants.word_counts(nothing)).count() == 0
    found = variants.word_counts(awkward, least_chars=5, least_count=3)
    assert {(r["word"], r["n"]) for r in found.collect()} == {("quick", 4000), ("brown", 4000), ("jumps", 4000)}
    assert variants.forms(frame.limit(1)).count() == 1


def test_word_counts_follow_the_rule(spark, awkward):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    docs = docs.union(awkward.select("doc_id", "text"))
    got = {r["word"]: r["n"] for r in variants.word_counts(docs, damage=199).collect()}
    assert got == plain_counts([(r[0], r[1]) for r in docs.collect()])


@pytest.mark.parametrize("word", ["", "a", "aa", "abc", "banana"])
def test_deletion_hashes_meet_where_words_are_near(word):
    left = {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}
    assert set(variants.deletions(word)) == {plain_hash(w) for w in left}


def plain_hash(word):
    out = 0
    for c in word:
        out = (out * variants._BASE + ord(c)) % variants._PRIME
    return out


# -- hard negatives
def plain_negatives(rows):
    usable = []
    for id_, label, vec in rows:
        if id_ is None or label is None or vec is None or any(v is None or not np.isfinite(v) for v in vec):
            continue
        usable.append((id_, (label + 1) % 10 if id_ % 7 == 0 else label, tuple(int(np.floor(256 * v)) for v in vec)))
    usable = sorted(set(usable))
    out = set()
    for a, la, va in usable:
        if a % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v)), b, lb) for b, lb, v in usable if b != a)
        for ps, p, _ in [s for s in scored if s[2] == la][:5]:
            fits = [(s, n) for s, n, lb in scored if lb != la and -50 * ps <= -100 * s <= -95 * ps][:3]
            out |= {(a, p, rank, n, -ps, -s) for rank, (s, n) in enumerate(fits, 1)}
    return out


def mined(spark, rows, **options):
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumn("id", F.lit("x"))
    wrong = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return {tuple(r) for r in hard_negatives.mine(frame, F.col("id") % 50 == 0, label=wrong, **options).collect()}


def test_negatives_are_those_of_all_pairs(spark):
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(6, 8))
    rows = []
    for i in range(900):
        x = centres[i % 6] + 0.4 * draw.normal(size=8)
        rows.append((i, int(draw.integers(0, 4)), [float(v) for v in x]))
    same = [0.5] * 8
    rows += [(1000 + i, i % 3, same) for i in range(200)]  # one vector many times: ties
    rows += [rows[3], rows[50], rows[50], (2000, None, same), (2050, 1, None), (2100, 1, [float("nan")] * 8)]
    rows += [(2150, 1, [None] * 8), (2200, 1, [float("inf")] * 8), (None, 1, same), (2250, 1, []), (2300, 2, [0.5, 0.5])]
    want = plain_negatives(rows)
    assert mined(spark, rows) == want and len(want) > 100
    assert mined(spark, rows, block=60) == want  # many blocks
    assert mined(spark, []) == set() and mined(spark, [(1, 1, same)]) == set()
    with pytest.raises(Exception, match="beyond 2\\^53"):
        mined(spark, [(50, 1, [1e300]), (51, 1, [1.0])])


@pytest.mark.parametrize("kind", ["plain", "clusters", "copies", "lengths", "huge"])
def test_cover_tree_search_is_exact(kind):
    draw = np.random.default_rng(1)
    n, d = 700, 12
    x = draw.normal(size=(n, d))
    if kind == "clusters":
        x = draw.normal(size=(9, d))[draw.integers(0, 9, n)] * 3 + 0.05 * x
    if kind == "copies":
        x[: n // 2] = x[0]
    if kind == "lengths":
        x = x * draw.lognormal(size=(n, 1))
    v = np.floor((2.0**27 if kind == "huge" else 256) * x).astype(np.int64)
    ids, label = draw.permutation(n), draw.integers(0, 5, n)
    tree = CoverTree.unpacked(CoverTree.build(ids, label, v).packed())
    for i, c in enumerate(tree.centre):  # covering radii hold for all descendants
        waiting, below = [i], []
        while waiting:
            at = waiting.pop()
            below += range(*tree.points[at])
            waiting += range(*tree.kids[at])
        away = np.sqrt(((tree.vectors[below] - c) ** 2).sum(1))
        assert (away <= tree.radius[i] * (1 + 1e-9) + 1e-6).all()
    assert sorted(tree.ids) == list(range(n))
    at, of = draw.integers(0, n, 12), np.repeat(np.arange(12), 3)
    scores = v[at] @ v.T
    low = np.sort(scores, axis=1)[of, draw.integers(0, n - 100, 36)]
    high = low + np.abs(low) // 2
    low[::7], high[::5] = -(2**62), 2**62
    for same in (True, False):
        row, id_, score = tree.search(v[at], of, ids[at][of], label[at][of], low, high, 4, same)
        for w in range(len(of)):
            g = scores[of[w]]
            fits = ((label == label[at[of[w]]]) == same) & (ids != ids[at[of[w]]]) & (g >= low[w]) & (g <= high[w])
            want = sorted((-s, i) for s, i in zip(g[fits].tolist(), ids[fits].tolist()))[:4]
            assert [(-s, i) for s, i in zip(score[row == w].tolist(), id_[row == w].tolist())] == want


# -- main text
@pytest.fixture(scope="module")
def forest(spark):
    return extraction.fit(spark.read.parquet(f"{SMALL}/pages.parquet"))


def article(html):
    inner = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    return " ".join(unescape(re.sub(r"<[^>]+>", " ", inner)).split())


def test_pages_give_their_articles(spark, forest):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = pages.select("html", extraction.main_text(F.col("html"), forest).alias("text")).collect()
    assert len(got) == pages.count() and all(r["text"] == article(r["html"]) for r in got)


def test_other_layouts_are_told(forest):
    words = "the quick brown fox jumps over a lazy dog and runs away from it".split()
    draw = random.Random(8)
    pieces = [" ".join(draw.choices(words, k=draw.choice((1, 2, 5, 12, 40, 90)))).capitalize() + "." for _ in range(300)]
    right = total = 0
    for page in extraction.training_pages(pieces, 200, seed=123):
        nodes = dom.parse(page)
        texts = [dom.block_text(n) if not n.kids else "" for n in nodes]
        want = " ".join(t for n, t in zip(nodes, texts) if t and n.mark == "1")
        right += extraction.extract(re.sub(r' data-t="[01]"', "", page), forest) == want
        total += 1
    assert right / total > 0.85
    body = "<p>One two three, four five six seven. Eight nine ten.</p>" * 6
    page = (
        '<body><header class="site-header"><h1>Site</h1></header><div class="cookie-notice"><p>We use cookies.</p></div>'
        f'<main><h1>Title</h1>{body}</main><aside><h3>More</h3><ul><li><a href="/">x</a></li></ul></aside>'
        '<form><label>Mail</label><button>Send</button></form>'
        '<section class="comments"><div class="comment"><p>Nice read, thank you very much for it.</p></div></section>'
        "<footer>&copy; 2024</footer></body>"
    )
    text = extraction.extract(page, forest)
    assert text == " ".join(["Title", *["One two three, four five six seven. Eight nine ten."] * 6])


@pytest.mark.parametrize(
    "html, texts",
    [
        (None, []),
        ("", []),
        ("plain &amp; simple", ["plain & simple"]),
        ("<p>a<p>b</p>c", ["a", "b", "c"]),
        ("<p><b>a<br><p>b &lt;i&gt;", ["a", "b <i>"]),
        ("<p>foo<b>bar</b>  baz\n qux</p>", ["foobar baz qux"]),
        ("<script>var t='</p>';</script><p>x</p><style>p{}", ["x"]),
        ("<!-- <p>no</p> --><p>yes</p><!-- open <p>no", ["yes"]),
        ("a < b and <3 <p>c", ["a < b and <3", "c"]),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
        ("<div>own<p>inner</p>rest</div>", ["own", "inner", "rest"]),
        ('<p title="a > b">x</p>', ["x"]),
        ("<head><title>t</title><p>x", ["x"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
        ("&nbsp;x&nbsp;&eacute;&#233;&#x1F600;", ["x éé\U0001f600"]),
    ],
)
def test_reader_forgives(html, texts):
    nodes = dom.parse(html)
    x, found = dom.features(nodes)
    assert [t for t in found if t] == texts
    assert x.shape == (len(nodes), len(dom.FEATURES)) and np.isfinite(x).all()


def test_decoding_never_contradicts_itself():
    draw = np.random.default_rng(5)
    page = extraction.training_pages(["a b c", "d"], 1, seed=3)[0]
    nodes = dom.parse(page)
    index = {id(v): i for i, v in enumerate(nodes)}
    for _ in range(50):
        scores = np.log(draw.dirichlet((1, 1, 1), len(nodes)))
        inside = extraction.decode(nodes, scores)
        for i, v in enumerate(nodes):
            if v.parent is not None and inside[index[id(v.parent)]]:
                assert inside[i]
    small = dom.parse("<div><p>a</p><p>b</p></div>")  # against all labellings of two leaves
    for _ in range(50):
        scores = np.log(draw.dirichlet((1, 1, 1), len(small)))
        best = max(
            ((top, mid, a, b) for top in range(3) for mid in range(3) for a in range(2) for b in range(2)
             if (top == 2 or (mid, a, b) == (top,) * 3) and (mid == 2 or (a, b) == (mid, mid))),
            key=lambda labels: sum(scores[i, label] for i, label in enumerate(labels)),
        )
        assert extraction.decode(small, scores) == [label == extraction.IN for label in best]


def test_boosted_trees_learn_an_exclusive_or():
    draw = np.random.default_rng(2)
    x = draw.random((1500, 4))
    y = (x[:, 0] > 0.5).astype(int) ^ (x[:, 1] > 0.3).astype(int)
    y[x[:, 2] > 0.8] = 2
    forest = boosting.fit(x[:1000], y[:1000], 3, rounds=20)
    told = forest.log_probabilities(x[1000:])
    assert (told.argmax(1) == y[1000:]).mean() > 0.95
    assert np.allclose(np.exp(told).sum(1), 1)


def test_awkward_pages(spark, forest):
    rows = [(1, None), (1, ""), (2, "<p>" * 3000 + "deep"), (3, "<div>" * 3000 + "deep"), (None, "word " * 200000), (4, "<"), (5, "<p")]
    rows.append((6, "<article>" + "<p>some words stand here, and some more.</p>" * 5000 + "</article><footer>f</footer>"))
    pages = spark.createDataFrame(rows, "page_id long, html string").withColumns({"text": F.lit("x"), "draw": F.lit(0)})
    got = pages.select("page_id", extraction.main_text(F.col("html"), forest).alias("text")).collect()
    by = defaultdict(list)
    for r in got:
        by[r["page_id"]].append(r["text"])
    assert by[1] == ["", ""] and by[None] == [" ".join(["word"] * 200000)] and by[4] == ["<"]
    assert by[6] == [" ".join(["some words stand here, and some more."] * 5000)]
    assert len(got) == len(rows)
    assert extraction.fit(pages.limit(0)).classes == 3
    again = extraction.fit(spark.read.parquet(f"{SMALL}/pages.parquet"))
    assert (again.leaf == forest.leaf).all()  # training repeats
