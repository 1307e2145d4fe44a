"""Secrets, PII, BPE, language, mixing: brute force, round trips and awkward rows."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from duskwatch.llm import bpe, language_id, mixing, pii, secrets
from duskwatch.llm.tagger import CharacterTagger

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain(pattern, text, flags=0):
    return [m for m in re.finditer(pattern, text, flags)]


# -- secrets


def plain_secrets(text):
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [("assign", *m.span()) for m in plain(assign, text, re.I | re.A) if len(m[2]) >= 12]
    found += [("access", *m.span()) for m in plain(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [("hex", *m.span()) for m in plain(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


PARTS = ["token", "API_KEY", " = ", ":", '"', "AKIA", "ABCDEFGHIJKLMN0123", "deadbeef01", "é", " ", "zzz",
         "x9Kd02LmQp77TrVwXy31", "passwd", "ſecret", "f" * 20]


@given(st.lists(st.sampled_from(PARTS), max_size=12).map("".join))
@settings(max_examples=300, deadline=None)
def test_base_secrets_are_those_of_the_patterns(text):
    assert secrets.base_spans(text) == plain_secrets(text)
    every = secrets.find(text)
    assert [s[:3] for s in every if s[3]] == plain_secrets(text)


def test_entropy_counts_match_entropy_from_scratch():
    draw = random.Random(3)
    run = "".join(draw.choice("abcXYZ0189") for _ in range(60))
    size, covered = secrets.WINDOW, set()
    for at in range(len(run) - size + 1):
        window = run[at : at + size]
        p = np.array([window.count(c) / size for c in set(window)])
        sort = secrets._class_of(
            sum(c.islower() for c in window), sum(c.isupper() for c in window),
            sum(c.isdigit() for c in window), sum(c not in "0123456789abcdefABCDEF" for c in window),
        )
        if sort and -(p * np.log2(p)).sum() >= 3.0 - 1e-9:
            covered.update(range(at, at + size))
    found = secrets.entropy_spans(run, dict.fromkeys(secrets.LIMITS, 3.0))
    assert {i for s, e in found for i in range(s, e)} == covered


def test_entropy_adds_keys_and_leaves_words_and_allowed_strings():
    assert [s[0] for s in secrets.find("use x9Kd02LmQp77TrVwXy31bZ now")] == ["entropy"]
    assert secrets.find("thonshedionentionerthandoneringesofthe") == []
    assert secrets.find("id 123e4567-e89b-12d3-a456-426614174000 x") == []


KEY = "Zk39dLmQp77TrVwXy31bZq8"


@pytest.mark.parametrize(
    "text",
    [
        f"sample_key={KEY}", f"docs/sample/{KEY}", f"{KEY}/xxxx", f"a {KEY}=example=x", f"/0123456789/{KEY}/abcdefgh",
        f"123e4567-e89b-12d3-a456-426614174000/{KEY}", f"token=abcdefghijkl0123/+x {KEY}", f"{'0a1b2c3d' * 2}/{KEY}",
    ],
)
def test_keys_beside_listed_words_and_base_spans_are_found(text):
    found = [text[s:e] for kind, s, e, _ in secrets.find(text) if kind == "entropy"]
    assert len(found) == 1 and KEY in found[0] and len(found[0]) <= len(KEY) + 2


def test_listed_words_are_left_alone():
    for text in (f"example{KEY}", f"x/{KEY}xxxx/y", "sha384-oqVuAfXRKap7fdgcCY5uykM6+R9GqQ8K/uxy9rx7HNQlGYl1kPzQho1wx4JwY8wC",
                 "id=123e4567-e89b-12d3-a456-426614174000", "=" * 30000, "xxxx/" * 5000 + "1"):
        assert secrets.find(text) == []


@given(st.lists(st.sampled_from(PARTS + [KEY, "/", "=", "sample", "example/"]), max_size=14).map("".join))
@settings(max_examples=300, deadline=None)
def test_entropy_spans_overlap_nothing_known(text):
    base, rest = plain_secrets(text), [s for s in secrets.find(text) if not s[3]]
    assert all(e <= b or s >= c for _, s, e, _ in rest for _, b, c in base)
    assert all(e - s >= secrets.WINDOW and not secrets.allowed_spans(text[s:e]) for _, s, e, _ in rest)


def test_recall_and_false_alarms_of_planted_keys():
    draw = random.Random(11)
    words = [" ".join("".join(draw.choice("etaoinshrdlu") for _ in range(draw.randrange(2, 14))) for _ in range(60)) for _ in range(400)]
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(draw.choices(letters, k=draw.randrange(24, 48))) for _ in words]
    hit = sum(any(s[0] == "entropy" for s in secrets.find(f"{w} {k} {w}")) for w, k in zip(words, keys))
    assert hit >= 0.97 * len(keys)
    assert not any(secrets.find(w) for w in words)


# -- personal data


def plain_pii(text):
    found = [("email", *m.span()) for m in plain(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", *m.span()) for m in plain(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(p) <= 255 for p in m[0].split("."))]
    digits = lambda m: re.sub(r"\D", "", m[0])
    found += [("card", *m.span()) for m in plain(r"[0-9]([\x20-]?[0-9])+", text)
              if 12 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    found += [("phone", *m.span()) for m in plain(r"\+[0-9][\x20().0-9-]+[0-9]", text)
              if 9 <= len(digits(m)) <= 15]
    return sorted(found, key=lambda s: (s[1], pii.KINDS.index(s[0])))


PIECES = ["a.b", "@", "x-1.", "com", ".", "1", "255", "256", "4111 1111 1111 1111", "+1 (499) 555-6503", "+",
          " ", "-", "é", "007", "(", "12.34.56.78"]


@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
@settings(max_examples=500, deadline=None)
def test_base_pii_is_that_of_the_patterns(text):
    assert pii.base_spans(text) == plain_pii(text)


@given(st.lists(st.sampled_from(PIECES + ["word " * 30]), max_size=14).map("".join))
@settings(max_examples=100, deadline=None)
def test_windows_cover_every_cue(text):
    starts = pii.windows(text)
    assert all(s >= 0 for s in starts)
    for cue in re.finditer("[0-9@]", text):
        assert any(s <= cue.start() < s + pii.WINDOW for s in starts)


@pytest.mark.parametrize("at", [0, 1, 7, 19, 20, 25, 63, 64, 100])
def test_windows_read_stretches_from_their_start(at):
    text = ("1 word " * 40)[:at] + "(499) 555-6503 today please"
    starts = pii.windows(text)
    first = next(i for i, c in enumerate(text) if c.isdigit())
    assert min(starts) == max(0, first - pii.MARGIN)
    covered = {i for s in starts for i in range(s, s + pii.WINDOW)}
    assert set(range(first, len(text))) <= covered | set(range(len(text) - 6, len(text)))


def test_tagger_learns_spans_and_gradients_are_right():
    draw = random.Random(1)
    texts, spans = [], []
    for _ in range(200):
        head = "".join(draw.choice("abc de") for _ in range(draw.randint(0, 20)))
        number = "".join(draw.choice("0123456789") for _ in range(6))
        texts.append(f"{head} {number} xyz")
        spans.append([("phone", len(head) + 1, len(head) + 7)])
    tagger = CharacterTagger(("phone",))
    ids, gold = np.array([[3, 1], [3, 2], [1, 3]]), np.array([[1, 0], [2, 0], [0, 1]])
    tagger.p = {k: v.astype(np.float64) for k, v in tagger.p.items()}
    _, grads = tagger._gradients(ids, gold)
    for name in ("xf", "hb", "out", "step"):
        at = (1, 2)
        tagger.p[name][at] += 1e-3
        up, _ = tagger._gradients(ids, gold)
        tagger.p[name][at] -= 2e-3
        down, _ = tagger._gradients(ids, gold)
        tagger.p[name][at] += 1e-3
        assert abs((up - down) / 2e-3 - grads[name][at]) < 2e-3
    tagger = CharacterTagger(("phone",))
    tagger.train(texts[:150], spans[:150], steps=80)
    assert sum(a == b for a, b in zip(tagger.decode(texts[150:]), spans[150:])) >= 45


def test_reconcile_joins_one_kind_and_keeps_the_best_of_several():
    seen = [(("phone", 5, 10), 3), (("phone", 8, 14), 1), (("card", 9, 20), 2), (("ip", 30, 33), 0)]
    assert sorted(pii.reconcile(seen)) == [("ip", 30, 33), ("phone", 5, 14)]


def test_pii_on_awkward_rows(spark, awkward, nothing):
    tagger = pii.fit(awkward)
    rows = awkward.select("doc_id", pii.detected(F.col("text"), tagger).alias("s")).collect()
    assert len(rows) == awkward.count() and all(r["s"] is not None for r in rows)
    assert pii.fit(nothing).trained is False
    text = spark.createDataFrame([("mail a.b@c.org or 10.0.0.1",), (None,)], "text string")
    got = text.select(pii.redacted(F.col("text"), None).alias("t")).collect()
    assert [r["t"] for r in got] == ["mail [EMAIL] or [IP]", None]


# -- byte-pair encoding


@pytest.fixture(scope="module")
def codec():
    return bpe.load(PATH), Tokenizer.from_file(PATH)


# characters newer than the library's Unicode tables are left out
KNOWN = st.characters(exclude_categories=("Cs", "Cn"))


@given(st.text(KNOWN, max_size=40) | st.lists(
    st.sampled_from(["<|startoftext|>", "<|endoftext|>", "it's", "aaaa", "ünïcode", "Σσς", " ", "\x1c", "½", "𝟘"]),
    max_size=8).map("".join))
@settings(max_examples=400, deadline=None)
def test_encoding_is_the_librarys(codec, text):
    ours, library = codec
    ids = library.encode(text, add_special_tokens=False).ids
    assert ours.encode(text) == ids
    assert ours.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_long_words_and_awkward_rows(codec, awkward):
    ours, library = codec
    word = "".join(random.Random(5).choice("aeinrst") for _ in range(3000))
    assert ours.encode(word) == library.encode(word, add_special_tokens=False).ids
    rows = awkward.select("text", bpe.tokens(F.col("text"), PATH).alias("t")).collect()
    for r in rows:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["t"]["ids"] == " ".join(map(str, ids)) and r["t"]["n_tokens"] == len(ids)
    digest = awkward.where("doc_id = 1").select(bpe.token_digests(F.col("text"), PATH).alias("d")).first()["d"]
    ids = library.encode("the cat sat on the mat and the dog ran", add_special_tokens=False).ids
    assert digest["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


# -- languages and mixing


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = language_id.fit(docs.where(~held))
    got = language_id.identify(docs.where(held), model, keep=["lang"]).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.97 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)
    assert (model.weights == 0).mean() > 0.2  # the penalty leaves weights at zero


def test_samples_hold_for_hot_rows_and_many_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    plain = language_id.learning_rows(docs, "text", "lang", "doc_id", 600, 200)
    often = language_id.learning_rows(docs.union(docs).union(docs), "text", "lang", "doc_id", 600, 200)
    flat = lambda rows: [(name, at.tolist(), n.tolist()) for name, at, n in rows]
    assert flat(plain) == flat(often) and len(plain) > 100
    dirty = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en").otherwise(F.col("doc_id").cast("string")))
    assert len(language_id.fit(dirty, most_languages=3).languages) == 3
    domains = labels.select("doc_id", F.when(F.col("toxic") == 1, "toxic").otherwise("good").alias("domain"))
    once = mixing.fit(docs, domains, ("good", "toxic"))
    thrice = mixing.fit(docs.union(docs), domains.union(domains).union(domains), ("good", "toxic"))
    assert once.vocabulary == thrice.vocabulary and np.array_equal(once.weights, thrice.weights)
    assert np.array_equal(once.shift, thrice.shift)


def test_language_on_awkward_rows(awkward, nothing):
    model = language_id.fit(awkward)
    got = language_id.identify(awkward, model, keep=["doc_id", "text", "score"])
    assert got.columns == ["doc_id", "text", "score", "lang_pred", "score"]
    found = {(r[0], r[1]): r[3] for r in got.collect()}
    assert found[3, None] == found[4, ""] == found[6, "12 34 !!"] == "und"
    assert got.count() == awkward.count()
    assert language_id.identify(awkward, language_id.fit(nothing)).where("lang_pred != 'und'").count() == 0


def test_temperature_softens_overconfident_logits():
    logits, labels = np.array([[8.0, 0.0]] * 10), np.array([0] * 7 + [1] * 3)
    assert language_id.fit_temperature(logits, labels) > 3


def test_rates_are_those_of_least_squares(spark):
    draw = np.random.default_rng(0)
    p = np.round(draw.dirichlet((0.3, 0.3, 0.3), 60), 3)
    tokens = draw.integers(5, 200, 60)
    rows = spark.createDataFrame([(*map(float, x), int(t)) for x, t in zip(p, tokens)], "p0 double, p1 double, p2 double, n_words long")
    names, weights = ["p0", "p1", "p2"], np.array([0.5, 0.3, 0.2])
    for wanted in (weights, np.array([0.7, 0.3, 0.0])):
        rates = mixing.fit_rates(rows, names, list(wanted), hold=1e-8)
        rate = np.array([r[0] for r in rows.select(rates.column(names)).collect()])
        gap = (rate * tokens) @ p / tokens.sum() - wanted
        assert np.allclose(np.abs(gap), rates.errors, atol=1e-9) and np.allclose(wanted, rates.targets)
        # the conditions that only an optimum of the nonnegative least squares meets
        slope = p @ gap
        assert (rate >= 0).all() and (slope >= -1e-4).all() and np.abs(slope[rate > 0]).max() <= 1e-4


def test_more_hold_moves_rates_less(spark):
    rows = spark.createDataFrame([(0.9, 0.1, 50), (0.2, 0.8, 50), (0.5, 0.5, 0)], "p0 double, p1 double, n_words long")
    moved = [
        max(abs(r[0] - 1) for r in rows.select(mixing.fit_rates(rows, ["p0", "p1"], [0.3, 0.7], hold=h).column(["p0", "p1"])).collect())
        for h in (1e-6, 0.1, 10)
    ]
    assert moved[0] > moved[1] > moved[2] > 0
    none = mixing.fit_rates(rows.limit(0), ["p0", "p1"], [0.3, 0.7])
    assert none.pulls == (0.0, 0.0) and none.targets == (0.3, 0.7)


@pytest.mark.parametrize("keep_all", [False, True])
@pytest.mark.parametrize("toxic", [3, 10])
def test_rare_domain_meets_its_target_by_default(spark, toxic, keep_all):
    kinds = [(0.98, 0.02, 0.0)] * 850 + [(0.03, 0.96, 0.01)] * (150 - toxic) + [(0.02, 0.03, 0.95)] * toxic
    rows = spark.createDataFrame([(*k, 100) for k in kinds], "p0 double, p1 double, p2 double, n_words long")
    rates = mixing.fit_rates(rows, ["p0", "p1", "p2"], [0.88, 0.12, 0.0], keep_all=keep_all)
    rate = np.array([r[0] for r in rows.select(rates.column(["p0", "p1", "p2"])).collect()])
    assert (rate[-toxic:] < 0.5).all() and (rate[:-toxic] >= 0.5).all()
    assert len(rates.errors) == 3 and max(rates.errors[:2]) <= 0.05


def test_mixing_drops_toxic_and_keeps_the_rest(spark, awkward, nothing):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").otherwise("poor")
    given_ = labels.select("doc_id", domain.alias("domain"))
    model = mixing.fit(docs, given_, ("good", "poor", "toxic"))
    weights = {"good": 0.88, "poor": 0.12, "toxic": 0.0}
    mixed = mixing.mix(docs, model, weights, keep=["doc_id"], keep_all=True).join(given_, "doc_id").toPandas()
    toxic = mixed["domain"] == "toxic"
    assert (mixed.rate[toxic] < 0.5).mean() > 0.9 and (mixed.rate[~toxic] >= 0.5).mean() > 0.99
    assert mixing.mix(awkward, model, weights, keep=["doc_id", "rate"]).count() == awkward.count()
    assert mixing.mix(nothing, model, weights, keep=["doc_id"]).count() == 0
    untaught = mixing.fit(awkward, given_.limit(0), ("good", "poor"))
    assert mixing.mix(awkward, untaught, {"good": 1, "poor": 1}).count() == awkward.count()
