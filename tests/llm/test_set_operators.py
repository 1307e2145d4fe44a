"""SimHash, components, top-k, URL rules, SpotSigs, chat and the pipeline."""

import hashlib
import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from duskwatch.llm import chat, knn, queries, simhash, spotsigs, url_rules
from duskwatch.llm.components import components

SMALL = "/root/testdata/sf0.001"


def roots(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def test_components_match_union_find(spark):
    draw = random.Random(2)
    pairs = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    linked = [(a, b) for a, b in pairs if a != b]
    assert got == roots({n for p in linked for n in p}, linked)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("largest", [None, 1])
def test_simhash_groups_match_all_pairs(spark, awkward, largest):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    base = "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15 w16 w17 w18 w19 w20 " * 9
    near = spark.createDataFrame([(1000 + i, base + f" tail{i}") for i in range(90)], "doc_id long, text string")
    docs = docs.union(near).union(awkward.select("doc_id", "text").where("doc_id is not null"))
    got = simhash.near_duplicates(docs, simhash.EXACT, largest=largest)
    got = got.select("doc_id", simhash.hexadecimal(F.col("print")[0]).alias("f"), "component_id").collect()
    texts = [(r["doc_id"], plain_fingerprint(r["text"])) for r in docs.collect()]
    assert sorted((r["doc_id"], int(r["f"], 16)) for r in got) == sorted(texts)
    prints = {f for _, f in texts}
    root = roots(prints, [(a, b) for a, b in combinations(prints, 2) if (a ^ b).bit_count() <= 2])
    least = {}
    for d, f in texts:
        least[root[f]] = min(d, least.get(root[f], d))
    assert all(r["component_id"] == least[root[int(r["f"], 16)]] for r in got)


def test_similar_scheme_finds_pairs_of_similarity_080(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: set(simhash.shingle_hashes(r["text"], 5).tolist()) for r in docs.collect()}
    group = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs, simhash.SIMILAR).collect()}
    close = found = wrong = 0
    for a, b in combinations(texts, 2):
        shared = len(texts[a] & texts[b])
        alike = shared / max(1, len(texts[a] | texts[b]))
        close += alike >= 0.8
        found += alike >= 0.8 and group[a] == group[b]
        wrong += alike < 0.7 and group[a] == group[b] and shared == 0
    assert close > 50 and found >= 0.95 * close and wrong == 0


def test_similar_scheme_links_a_crowd_to_its_original(spark):
    draw = random.Random(5)
    base = [f"word{i}" for i in range(204)]
    rows = [(draw.randrange(10**9), " ".join(base))]
    for n in range(600):  # four words changed: 180 of 220 shingles are shared, 0.82
        words = list(base)
        for at in draw.sample(range(5, 199, 10), 4):
            words[at] = f"new{n}x{at}"
        rows.append((draw.randrange(10**9), " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    group = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs, simhash.SIMILAR).collect()}
    original = group[rows[0][0]]
    assert sum(g == original for g in group.values()) >= 0.95 * len(rows)


def test_similar_scheme_makes_no_rows_of_pairs_half_alike(spark, monkeypatch):
    asked, verified = [], simhash._verified

    def counted(pairs, *rest):
        asked.append(pairs.distinct().count())
        return verified(pairs, *rest)

    monkeypatch.setattr(simhash, "_verified", counted)
    draw = random.Random(7)
    rows = []
    for n in range(150):  # four words changed: two of them are alike by 0.67, or 0.78 at most
        words = [f"word{i}" for i in range(204)]
        for at in draw.sample(range(5, 199, 5), 4):
            words[at] = f"new{n}x{at}"
        rows.append((2 * n, " ".join(words)))
        if n % 3 == 0:
            rows.append((2 * n + 1, " ".join(words + ["end"])))  # 0.995
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    group = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs, simhash.SIMILAR).collect()}
    assert group == {n: n - n % 2 for n, _ in rows}
    assert sum(asked) < 10 * len(rows)  # 7,371 pairs share a small bucket


def test_similar_scheme_decides_few_shingles_by_themselves(spark):
    rows = []
    for n in range(300):
        words = [f"w{n}x{i}" for i in range(11)]
        for i, ends in enumerate((8, 9, 11)):  # 4, 5 and 7 shingles: 0.8, then 0.71
            rows.append((10 * n + i, " ".join(words[:ends])))
    rows += [(10_000 + i, "the same words start every one of these " + f"end{i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    group = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs, simhash.SIMILAR).collect()}
    assert all(group[10 * n + 1] == 10 * n and group[10 * n + 2] == 10 * n + 2 for n in range(300))
    assert all(group[10_000 + i] == 10_000 + i for i in range(40))  # 3 of 5 shingles


def test_simhash_on_awkward_rows(awkward, nothing):
    got = simhash.near_duplicates(awkward, simhash.EXACT)
    assert got.count() == awkward.count()
    empty = [r["component_id"] for r in got.collect() if r["doc_id"] in (3, 4)]
    assert empty == [3, 3]
    assert simhash.near_duplicates(nothing, simhash.SIMILAR).count() == 0


@pytest.mark.parametrize("pivots,block", [(4, 16), (64, 4096)])
def test_top_k_matches_brute_force(spark, pivots, block):
    draw = np.random.default_rng(4)
    x = np.round(draw.normal(size=(300, 5)), 2)
    x[50:150] = x[50]  # a third of all rows share one vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(900, None), (901, [1.0, None]), (902, [float("nan"), 1.0]), (903, [float("inf")]), (904, [0.5]), (None, [1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    got = knn.top_k(frame, F.col("vec_id") % 7 == 0, k=10, pivots=pivots, block=block)
    whole = {i: np.floor(1024 * np.array(v)).astype(int) for i, v in rows[:300]} | {904: np.array([512, 0, 0, 0, 0])}
    expected = set()
    for q in (i for i in whole if i % 7 == 0):
        best = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:10]
        expected |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    assert {tuple(r) for r in got.collect()} == expected
    assert knn.top_k(frame.limit(0), F.lit(True)).count() == 0


@pytest.mark.parametrize("clustered", [True, False])
def test_top_k_sends_few_copies(spark, monkeypatch, clustered):
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(8, 24)) * (6 if clustered else 0)
    rows = [(i, (centres[i % 8] + draw.normal(size=24) * (0.05 if clustered else 1)).tolist()) for i in range(4000)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    sent, spread = spark.sparkContext.accumulator(0), knn._spread

    def counted(batch, group, columns):
        if "ids" in columns:
            sent.add(len(batch))
        return spread(batch, group, columns)

    monkeypatch.setattr(knn, "_spread", counted)
    got = knn.top_k(frame, F.col("vec_id") % 20 == 0, k=5, pivots=16, block=50 if clustered else 4096).collect()
    v = np.floor(1024 * np.array([r[1] for r in rows])).astype(int)
    expected = {}
    for q in range(0, 4000, 20):
        score = v @ v[q]
        expected[q] = sorted((-int(s), i) for i, s in enumerate(score) if i != q)[:5]
    assert {(r[0], r[1], r[2], r[3]) for r in got} == {(q, n + 1, i, -s) for q, best in expected.items() for n, (s, i) in enumerate(best)}
    # 200 queries are four teams of 50 or more, or one of 4,096
    assert sent.value <= 4000 * 4 * (0.5 if clustered else 0.25)


def test_top_k_refuses_what_does_not_fit(spark):
    huge = spark.createDataFrame([(0, [1e300, 1.0]), (1, [1.0, 2.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large to be exact"):
        knn.top_k(huge, F.lit(True)).collect()


def test_url_rules_match_a_loop(spark):
    draw = random.Random(8)
    hosts = ["org", "example.org", "a.example.org", "xexample.org", "com", "EXAMPLE.com", "b.a.example.org", ""]
    paths = ["", "/", "/es/", "/es/x", "/en/1", "/en/12", "/en/12/deep", "/fr/?q=://x", "/e#f"]
    pages = [(i, f"http://{draw.choice(hosts)}{draw.choice(paths)}") for i in range(400)]
    pages += [(400, None), (401, ""), (402, "no scheme.org/"), (403, "x://://y"), (404, "http://org/")] * 2
    rules = [(h, p, draw.choice(["allow", "block"])) for h in hosts[:6] for p in ("/", "/e", "/es/", "/en/1", "/en/12")]
    rules += [("org", "/", "block"), (None, "/", "block"), ("example.org", None, "allow")]
    frame = spark.createDataFrame(pages, "page_id long, url string").withColumn("rule", F.lit("x"))
    got = url_rules.judge(frame, spark.createDataFrame(rules, "host string, path string, verdict string"), ranges=5)

    def judged(url):
        if url is None or "://" not in url:
            return "", "", None, "allow"
        rest = url.split("://", 1)[1].split("#")[0].split("?")[0]
        host, slash, path = rest.partition("/")
        host, path = host.lower(), slash + path
        fits = [
            (len(h) + len(p or ""), len(h), v, h.lower() + (p or ""))
            for h, p, v in rules
            if h is not None and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p or "")
        ]
        best = max(fits, default=None)
        return host, path, best and best[3], best[2] if best else "allow"

    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(repr((i, *judged(u))) for i, u in pages)
    assert url_rules.judge(frame.limit(0), spark.createDataFrame(rules, "host string, path string, verdict string")).count() == 0


def test_edited_neighbours_match_a_loop(spark, awkward, nothing):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(5001, None), (5002, ""), (-1, "x")], "doc_id long, text string"))
    order = sorted(docs.collect(), key=lambda r: -r["doc_id"])
    got = {r["doc_id"]: r for r in spotsigs.edited_neighbours(docs.repartition(7)).collect()}
    for i, row in enumerate(order):
        text, after = row["text"] or "", order[(i + 1) % len(order)]["text"] or ""
        changed = text[: len(text) - len(text) // 3] + after[: len(text) // 3]
        r = got[row["doc_id"]]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        a, b = spotsigs.signatures(text), spotsigs.signatures(changed)
        assert r["fingerprint"] == spotsigs.fingerprint(a)
        assert r["near_edited"] == spotsigs.likeness(a, b)
        assert r["near_next"] == spotsigs.likeness(a, spotsigs.signatures(after))
    assert spotsigs.edited_neighbours(awkward).count() == awkward.count()
    assert spotsigs.edited_neighbours(nothing).count() == 0
    alone = spotsigs.edited_neighbours(docs.where("doc_id = -1")).first()
    assert alone["near_next"] == alone["near_edited"] == 1


def test_similar_pairs_match_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").where("doc_id < 400")
    pairs, members = spotsigs.similar_pairs(docs, 0.5)
    own = {r["doc_id"]: spotsigs.signatures(r["text"]) for r in docs.collect()}
    sets = {spotsigs.fingerprint(s): s for s in own.values()}
    expected = {
        tuple(sorted((a, b))) for (a, x), (b, y) in combinations(sets.items(), 2) if x and y and spotsigs.likeness(x, y, 0.5)
    }
    assert expected and {(r["a"], r["b"]) for r in pairs.collect()} == expected
    assert members.count() == docs.count()


def test_pruned_likeness_is_the_plain_one():
    draw = random.Random(1)
    for _ in range(300):
        a, b = (spotsigs.Counter(draw.choices("abcdefg", k=draw.randrange(12))) for _ in "ab")
        union, shared = sum((a | b).values()), sum((a & b).values())
        value = shared / union if union else 1.0
        assert spotsigs.likeness(a, b) == value
        assert spotsigs.likeness(a, b, 0.5) == (value if value >= 0.5 else 0)


def test_chat_reads_back_exactly(spark):
    draw = random.Random(6)
    controls = [*chat.INSTRUCTIONS.controls, chat.INSTRUCTIONS.escape, "A", "B", "\n", "x", "", "é🙂", "<", "["]
    rows = [(1, t, r, "ok") for t, r in enumerate(["system", "user", "assistant", "user", "assistant"])]
    rows += [(2, t, r, "ok") for t, r in enumerate(["user", "user"])] + [(3, 0, "tool[SAYS]", None), (None, None, None, None)]
    rows += [(4 + i // 6, i % 6, draw.choice(["user", "assistant", "other", "<s>"]), "".join(draw.choices(controls, k=6))) for i in range(240)]
    rows += [rows[0], (90, 0, "user", "long [INST] " * 20000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1))
    chats = chat.format_chats(frame)
    got = {r["conv_id"]: r for r in chats.withColumn("turns", chat.read_back(F.col("formatted"))).collect()}
    expected = {}
    for c, t, r, x in sorted(rows, key=lambda r: (-1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        expected.setdefault(c, []).append((r or "", x or ""))
    assert {c: [tuple(t) for t in r["turns"]] for c, r in got.items()} == expected
    assert got[1]["valid"] is False  # its first turn is repeated
    assert got[2]["valid"] is False and got[3]["valid"] is False
    assert chat.format_chats(frame.where("conv_id = 1").distinct()).first()["valid"] is True
    for c, r in got.items():
        loss = "".join(s["text"] for s in r["segments"] if s["loss"])
        assert loss.count("</s>") == 0
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
    assert chat.format_chats(frame.limit(0)).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    extra = docs.limit(3).union(spark.createDataFrame([(9999, "123 !!", None, "s", 6), (9998, None, None, "s", 0)], docs.schema))
    current = docs.union(extra)
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_duplicates", "personal_data", "mixing", "encoding"]
    for name, step in corpus_pipeline.STAGES:
        before = current
        current = corpus_pipeline.stage(step(spark, current, SMALL), name)
        if name != "encoding":
            assert set(current.columns) == set(docs.columns)
        ids = {r["doc_id"] for r in current.select("doc_id").collect()}
        if name == "language":
            assert not ids & {9998, 9999} and current.count() >= docs.count()
        if name == "near_duplicates":
            assert current.count() == len(ids)
        if name == "personal_data":
            assert current.count() == before.count()
            assert current.where(F.col("text").rlike(r"\S@\S+\.\S")).count() == 0
    assert current.count() > 0 and set(queries.QUERIES) == {
        "op1_simhash", "op2_language", "op3_top_k", "op4_secrets", "op5_bpe",
        "op6_mixing", "op7_urls", "op8_pii", "op9_spotsigs", "op10_chat",
        "op11_variants", "op12_hard_negatives", "op13_main_text",
    }
