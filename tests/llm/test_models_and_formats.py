"""Tokens, chat, pages, classifier, language model and the pipeline."""

from __future__ import annotations

import base64
import gc
import math
import random
import re
import subprocess
import sys
import tracemalloc
import zlib
from collections import Counter
from html import unescape
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewright.llm import bpe, chat, html, lm, quality_classifier
from tidewright.llm import common as c
from tidewright.llm.queries import tokenizer

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def coders():
    path, pattern = tokenizer()
    with open(path, "rb") as f:
        data = f.read()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
    return bpe.Bpe(data, pattern, cached=500), tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=80) | st.text("ab \n'sthe\t\x1c  é中9", max_size=60))
def test_tokens_are_those_of_the_library(coders, text):
    own, library = coders
    ids = own.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
    assert own.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 4001, "aaab" * 999, "=" * 4097, "é" * 2001, " " * 3000 + "x" + "\n" * 500, "the" * 900])
def test_long_words(coders, text):
    own, library = coders
    assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_join_of_any_two_halves(coders):
    own, _ = coders
    rng = random.Random(2)
    for _ in range(500):
        data = "".join(rng.choice("abcdeth nig") for _ in range(rng.randrange(2, 40))).encode()
        cut = rng.randrange(1, len(data))
        assert own.joined(own.merged(data[:cut]), own.merged(data[cut:])) == own.merged(data)


def test_frames_of_tokens(docs, no_docs, odd_texts, coders):
    path, pattern = tokenizer()
    both = bpe.decode(bpe.encode(docs, path, pattern), path, pattern)
    assert both.columns == [*docs.columns, "n_tokens", "token_ids", "decoded"]
    for r, (i, t) in zip(both.collect(), odd_texts, strict=True):
        assert (r.doc_id, r.n_tokens) == (i, len(coders[1].encode_ordinary(t or ""))) and bytes(r.decoded) == (t or "").encode()
    assert bpe.encode(no_docs, path, pattern).count() == 0


TALK = [
    (1, 1, None, "user", "hi <|im_end|> <\\|x <|", 0.0),
    (1, 2, 1, "assistant", "a", 1.0),
    (1, 3, 1, "assistant", "b", 2.0),
    (1, 4, 2, "user", "c", 5.0),
    (1, 5, 4, "assistant", None, 0.0),
    (1, 6, 99, "user", "lost", 0.5),
    (2, 1, None, None, "x\ny", None),
    (3, 1, 2, "user", "circle", 1.0),
    (3, 2, 1, "user", "circle", 1.0),
    (3, 3, 2, "user", "into the circle", 1.0),
    (None, 1, None, "we\\ird\nrole<|", "z", 0.0),
    (None, 1, None, "we\\ird\nrole<|", "z", 0.0),
    (4, None, None, "user", "no id", 0.0),
]


def test_paths_are_ranked_and_read_back(spark):
    talk = spark.createDataFrame(TALK, "conv long, id long, parent long, role string, text string, score double")
    made = chat.format_trees(talk, best=2)
    back = made.select("conv", "rank", chat.read_turns(made.text).alias("t"), chat.read_loss(made.text, made.loss_spans).alias("loss"), "text", "leaf")
    got = {(r.conv, r["rank"]): ([(x.role, x.text) for x in r.t], r.loss) for r in back.collect()}
    hi = ("user", "hi <|im_end|> <\\|x <|")
    assert got == {
        (1, 1): ([hi, ("assistant", "a"), ("user", "c"), ("assistant", "")], "a"),
        (1, 2): ([hi, ("assistant", "b")], "b"),
        (2, 1): ([("", "x\ny")], ""),
        (4, 1): ([("user", "no id")], ""),
        (None, 1): ([("we\\ird\nrole<|", "z")], ""),
    }
    text = made.where("conv = 1 and rank = 1").first().text
    assert text.count(chat.OPEN) == 4 == text.count(chat.CLOSE)
    assert chat.format_trees(talk.where("false")).count() == 0


def test_deep_threads(spark):
    turns = [(7, i, "assistant" if i % 2 else "user", f"t{i} <|") for i in range(300)] + [(8, 0, "user", "x"), (8, 0, "user", "x")]
    made = chat.format_trees(chat.thread(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")))
    got = {r.conv: (r.n_turns, [x.text for x in r.t]) for r in made.select("conv", "n_turns", chat.read_turns(made.text).alias("t")).collect()}
    assert got == {7: (300, [t for *_, t in turns[:300]]), 8: (2, ["x", "x"])}


@settings(max_examples=100, deadline=None)
@given(st.text("<|\\im_start>end ab\n", max_size=30))
def test_escape_is_reversible(text):
    import re

    escaped = re.sub(r"<(\\*)\|", r"<\\\1|", text)
    assert "<|" not in escaped and re.sub(r"<\\(\\*)\|", r"<\1|", escaped) == text


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x="<p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a><li><a href=/b>About</a></ul></nav><div class="cookie-notice"><p>We use cookies
and a long explanation of why they are so useful to all of us.</p></div>%s<div id="comments"><p>A reader says a lot of things here.</p></div>
<aside>More to read, and more, and more.</aside><form><p>Sign up for our letter</p><input><button>Go</button></form><footer>&copy; 2020 <p>All rights</p></footer>"""


def test_main_text():
    article = "<h1>Title &amp; more</h1><p>First  <b>bold</b>\n text, long enough to be one.<br>Second line<p>Short.<p>Caf&eacute; &lt;tag&gt;<script>1</script></p>"
    want = "Title & more\nFirst bold text, long enough to be one. Second line\nShort.\nCafé <tag>"
    assert html.main_text(PAGE % f"<article>{article}</article>") == want
    assert html.main_text(PAGE % f"<div class=post>{article}</div>") == want
    assert html.main_text(PAGE % f"<main><div class='ad'>Buy now</div>{article}</main>") == want
    assert html.main_text(PAGE % f"<article class='has-sidebar'>{article}<article class='comment'><p>A reader adds this.</p></article></article>") == want
    assert html.main_text(PAGE % "") == "" == html.main_text("") == html.main_text("<p>  <br>")
    assert html.main_text("plain words") == "plain words"
    assert html.main_text("<article><p>cut off in the <a href='") == "cut off in the"


def plain_article(page):
    """The one article of a page by patterns alone; enough for the plain markup of the given pages."""
    inner = re.search("(?s)<article>(.*?)</article>", page or "")
    if not inner:
        return ""
    text = re.sub(r'(?s)<!--.*?-->|<(script|style|aside|form|nav)\b.*?</\1>|<div class="ad">.*?</div>', "", inner[1])
    blocks = re.split(r"</?(?:p|h\d|ul|ol|li|div|table|thead|tbody|tr|td|th|blockquote|pre|section)\b[^>]*>", re.sub("<br[^>]*>", " ", text))
    blocks = [" ".join(unescape(re.sub("<[^>]+>", "", b)).split()) for b in blocks]
    return "\n".join(b for b in blocks if b)


def test_all_given_pages(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    got = {r.page_id: r.text for r in html.extract(pages).collect()}
    assert got == {r.page_id: plain_article(r.html) for r in pages.collect()} and any(got.values())


LONG = " ".join(f"word{i}" for i in range(60))


@pytest.mark.parametrize(
    ("around", "want"),
    [
        ("<div class='content has-sidebar'><article><p>{0}</p></article></div>", 1),
        ("<div class='no-sidebar comments-open'><main><p>{0}</p></main></div>", 1),
        ("<form id=aspnet><article><p>{0}</p></article><input name=q></form>", 1),
        ("<div id=sidebar-layout><article><p>{0}</p></article></div>", 1),
        ("<article><p>{0}</p></article><article class=comment><p>{0} no</p></article>", 1),
        ("<article><p>{0}</p></article><section class=user-feedback><article><p>no {0}</p></article></section>", 1),
        ("<article><p>{0}</p><section id=related-work><p>{0}</p></section><div class=social-sciences><p>{0}</p></div></article>", 3),
        ("<article><p>{0}</p><div class=related-posts><p>no</p></div><div class='widget social'><p>no</p></div></article>", 1),
        ("<section><p>short one</p></section><section><p>{0} {0} {0}</p></section><section><p>short two</p></section>", 3),
        ("<div class=advert><p>{0} no</p></div><div class=post><p>{0}</p><p>{0}</p></div>", 2),
        ("<form><div class=post><p>{0}</p><p>{0}</p></div></form><div class=ad>no</div>", 2),
        ("<article><p>{0}</p></article><form class=search><p>no {0} {0} {0}</p></form>", 1),
        ("<div class='main-content nav-open'><div><p>{0}</p></div></div>", 1),
        ("<article class='post sidebar-right'><p>{0}</p></article><div class=sidebar-left><p>no</p></div>", 1),
    ],
)
def test_names_only_add_to_what_tags_say(around, want):
    got = html.main_text(PAGE % around.format(LONG))
    assert "no" not in got.split() and len(got.split("\n")) == want


def test_pages(spark):
    pages = spark.createDataFrame([(1, "u", "<p>x y", "old"), (1, "u", "<p>x y", "old"), (2, None, None, "old"), (None, "v", "", None)], "page_id long, url string, html string, TEXT string")
    assert rows(html.extract(pages).select("page_id", "url", "text")) == [(None, "v", ""), (1, "u", "x y"), (1, "u", "x y"), (2, None, "")]
    assert html.extract(pages.where("false")).count() == 0
    long = "".join(f"<p>{'word ' * 50}{i}</p>" for i in range(3000))
    assert html.main_text(f"<article>{long}</article>").count("\n") == 2999


def test_smoothing():
    flat = html.smoothed(np.ones(5))
    assert np.allclose(flat, 1)
    spike = html.smoothed(np.array([0, 0, 0, 1.0, 0, 0, 0]))
    assert spike.argmax() == 3 and np.allclose(spike, spike[::-1])


def labelled_corpus(rng, n):
    docs, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.25
        w = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(30, 200))]
        if bad:
            for _ in range(max(3, len(w) // 20)):
                w[rng.randrange(len(w))] = rng.choice(["vileword", "nastiness", "vilest"])
        docs.append((i, " ".join(w)))
        if i % 2:
            labels.append((i, int(not bad or rng.random() < 0.5), int(bad)))
    labels = [(i, q, x) for i, q, x in labels]
    return docs, labels


def test_classifier_on_held_out_documents(spark):
    docs, labels = labelled_corpus(random.Random(4), 4000)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    marked = spark.createDataFrame([*labels, (None, 1, 0), (1, None, 0), labels[0]], "doc_id long, quality int, toxic int")
    kept = {r.doc_id: r.kept for r in quality_classifier.resample(frame, marked).collect()}
    assert {r.doc_id: r.kept for r in quality_classifier.judge(frame, marked).collect()} == kept
    bad = {i: "vil" in t or "nast" in t for i, t in docs}
    held = [i for i, _ in docs if i % 2 == 0]
    assert sum(kept[i] != bad[i] for i in held) >= 0.98 * len(held)
    stay = quality_classifier.keep_good(frame, marked)
    assert stay.columns == frame.columns and {r.doc_id for r in stay.collect()} == {i for i, k in kept.items() if k}


def test_toxic_documents_of_a_small_table_go(spark, folder):
    small = Path(folder).parent / "sf0.01"
    if not small.is_dir():
        pytest.skip(f"no tables at {small}")
    docs, labels = (spark.read.parquet(f"{small}/{n}.parquet") for n in ("documents", "labels"))
    kept = {r.doc_id for r in quality_classifier.judge(docs.select("doc_id", "text"), labels).where("kept").collect()}
    toxic = {r.doc_id for r in labels.where("quality = 1 and toxic = 1").collect()}
    assert len(toxic) > 20 and len(toxic & kept) < len(toxic) / 2


def test_gate_follows_the_labels():
    good = np.array([True] * 6 + [False] * 2)
    weights = np.tile(np.where(good, 0.0, 1.0)[:, None], len(quality_classifier.GATES))
    assert quality_classifier.GATES[quality_classifier.best_gate(weights, good)[0]] == quality_classifier.SIGNIFICANT
    weights[:, 2] = np.where(good, 0.0, -3.0)
    gate, cut = quality_classifier.best_gate(weights, good)
    assert gate == 2 and -3 < cut < 0
    none = quality_classifier.best_gate(np.zeros((0, len(quality_classifier.GATES))), np.zeros(0, bool))
    assert quality_classifier.GATES[none[0]] == quality_classifier.SIGNIFICANT and none[1] == float("-inf")


def test_classifier_on_odd_rows(spark, docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    judged = quality_classifier.resample(docs, none)
    assert quality_classifier.judge(docs, none).columns == [*[x for x in docs.columns if x != "text"], "log_weight", "kept"]
    assert judged.columns == [*docs.columns, "log_weight", "kept"] and {r.kept for r in judged.collect()} == {True}
    some = spark.createDataFrame([(0, 1, 0), (1, 0, 1), (2, 1, None), (3, 1, 1), (5, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality_classifier.resample(docs, some).count() == docs.count()
    assert quality_classifier.resample(no_docs, some).count() == 0


def test_counting_grams_takes_little_memory():
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(60_000)}" for _ in range(400)) for _ in range(1500)]
    batch = pa.RecordBatch.from_pydict({"text": texts, "target": [i % 3 == 0 for i in range(len(texts))]})
    tracemalloc.start()
    counted = list(quality_classifier._count([batch]))[0]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 75e6
    for name, chosen in (("raw", texts), ("target", texts[::3])):
        times = [np.frombuffer(x, np.int32).sum() for x in counted.column(name).to_pylist()]
        ngrams = [n for t in chosen for w in t.split() for n in [2 + sum(len(w) > x for x in quality_classifier.BEGINNINGS)]]
        assert sum(times) == sum(ngrams) + 399 * len(chosen)


def test_kth_largest(spark):
    rng = random.Random(1)
    values = [rng.gauss(0, 3) for _ in range(3000)] + [1.25] * 500
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 2, 1500, 3499, 3500):
        assert quality_classifier.kth_largest(frame, "v", k) == sorted(values, reverse=True)[k - 1]


def test_cut_between_labels():
    w, good = np.array([-5.0, -4, -3, 0, 0, 1]), np.array([False, False, True, True, True, True])
    assert -4 < quality_classifier.best_cut(w, good) < -3
    assert quality_classifier.best_cut(w, np.ones(6, bool)) == float("-inf")


def test_scores(spark, docs, no_docs, odd_texts):
    marked = docs.withColumn("trained", docs.doc_id % 10 != 0)
    got = lm.score(marked, "trained")
    assert got.columns == [*[x for x in docs.columns if x != "text"], "trained", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    words = lambda t: [*(t or "").encode().lower().split(), None]
    count = Counter(w for i, t in odd_texts if i is not None and i % 10 for w in words(t))
    n, v = sum(count.values()), len(count)
    want = sorted(
        (str(i), len(words(t)), sum(count[w] > 0 for w in words(t)), n, round(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words(t)), 4)) for i, t in odd_texts
    )
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got.collect()) == want
    assert all(r.score < 0 for r in got.collect())
    assert lm.score(no_docs.withColumn("trained", no_docs.doc_id > 0), "trained").count() == 0
    unseen = lm.score(docs.limit(3).withColumn("trained", docs.doc_id < 0), "trained").collect()
    assert {r.n_known for r in unseen} == {0} and {r.train_tokens for r in unseen} == {0}


def test_training_takes_every_triple():
    k = lm.CLASSES
    triple = np.array([(a * k + b) * k + c for a, b, c in ((3, 3, 3), (3, 3, 4), (3, 4, 3), (4, 3, 4), (9, 9, 10))])
    table = 10.0 ** lm.train(triple, np.array([10**9, 10**9, 10**9, 10**9, 20]))
    assert table[9, 9, 10] > 0.1  # one in 200 million
    assert abs(table[3, 3, 3] - 0.5) < 0.1 and table[3, 4, 3] > 0.9 and table[4, 3, 4] > 0.9
    again = lm.train(np.repeat(triple, 2), np.repeat(np.array([10**9, 10**9, 10**9, 10**9, 20]) // 2, 2))
    assert np.allclose(10.0**again, table, atol=1e-3)


def test_scores_follow_from_the_model(spark):
    texts = ["a b a c", "A b b", "d a b", "", None]
    docs = spark.createDataFrame([(i, t, i != 2) for i, t in enumerate(texts)], "doc_id long, text string, trained boolean")
    model = lm.fit(docs, "trained")
    words = [(t or "").lower().split() for t in texts]
    count = Counter(w for i, t in enumerate(words) if i != 2 for w in t)
    assert {r.n for r in model.counts.collect()} == set(count.values()) and model.tokens == sum(count.values()) + 4
    flat = [w.encode() for w in sorted(count)]
    kind = dict(zip(sorted(count), model.words.classes(flat, c.word_hashes(flat))[0].tolist(), strict=True))
    kind["d"] = lm.CLASSES - lm.FORMS + lm.form(b"d")
    for r in lm.score(docs, "trained").collect():
        want, two, one = 0.0, lm.BEGIN, lm.BEGIN
        for w in [*words[r.doc_id], None]:
            of = lm.END if w is None else kind[w]
            want += model.table[two, one, of] + (math.log10(count[w] + 0.1) - model.words.log_mass[of] if w and of >= lm.CLASSES - lm.FORMS else 0)
            two, one = one, of
        assert abs(r.score - want) < 1e-4


def test_model_is_normalised_and_beats_the_base(spark, folder):
    rng = np.random.default_rng(0)
    triple, count = np.unique(rng.integers(0, 40, 5000) * lm.CLASSES**2 + 3 * lm.CLASSES + rng.integers(2, 9, 5000), return_counts=True)
    table = lm.train(triple, count, steps=50)
    assert np.allclose((10.0**table).sum(axis=2), 1, atol=1e-4) and (10.0 ** table[:, :, lm.BEGIN] == 0).all()
    from tidewright.llm.queries import QUERIES

    held = [r for r in QUERIES["op7_lm_scoring"](spark, folder).collect() if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all((zlib.crc32(str(r.doc_id).encode()) % 10 == 0) for r in held)


def test_encoder_leaves_no_caches_behind(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "some words, some more")], "doc_id long, text string")
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["some words, some more"]})
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: run)
    run = bpe.encode(docs, *tokenizer())
    gc.collect()
    gc.disable()
    try:
        assert list(run([batch]))[0].column("n_tokens").to_pylist()[0] > 0
        left = [x for x in gc.get_objects() if isinstance(x, bpe.Bounded) and len(x)]
    finally:
        gc.enable()
    assert not left


def test_encoder_gives_memory_back_and_gets_small_batches(spark):
    script = """
import random, re, sys
import pyarrow as pa
from tidewright.llm import bpe, common
from tidewright.llm.queries import tokenizer

path, pattern = tokenizer()
with open(path, "rb") as f:
    data = f.read()
draw = random.Random(0).choices

def held():  # MB
    with open("/proc/self/smaps_rollup") as f:
        return int(re.search(r"Anonymous:\\s+(\\d+)", f.read())[1]) / 1024

def task(texts):
    coder = bpe.Bpe(data, pattern)
    for _ in range(texts):
        coder.encode("".join("".join(draw("abcdefghij", k=8 + i % 30)) + draw([" ", "  ", "\\n\\n"], [8, 1, 1])[0] for i in range(300)))
    full = held()
    coder.forget()
    return full

task(3)
common.release()
before = held()
full = task(700)
print(before, full, held())
"""
    root = Path(__file__).parents[2]
    said = subprocess.run([sys.executable, "-c", script], cwd=root, capture_output=True, text=True, timeout=120, check=True).stdout
    before, full, after = map(float, said.split())
    assert full > before + 40 and after < before + 8, said

    try:
        spark.conf.unset(c.BATCH_LIMIT)
        docs = spark.range(0, 4000, 1, 1).select(F.col("id").alias("doc_id"), F.expr("repeat('x', 6000)").alias("text"))
        bpe.encode(docs, *tokenizer())

        def sizes(batches):
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"mb": [batch.nbytes >> 20]})

        assert max(r.mb for r in docs.mapInArrow(sizes, "mb long").collect()) <= c.BATCH_BYTES >> 20
        spark.conf.set(c.BATCH_LIMIT, "1m")
        bpe.decode(bpe.encode(docs, *tokenizer()), *tokenizer())
        assert spark.conf.get(c.BATCH_LIMIT) == "1m"
    finally:
        spark.conf.unset(c.BATCH_LIMIT)
