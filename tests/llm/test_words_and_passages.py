"""Substring dedup, decontamination, line dedup, quality rules and the Jaccard join against brute force."""

from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewright.llm import common as c
from tidewright.llm import bpe, decontaminate, html, jaccard, line_dedup, quality_classifier, quality_rules, substring
from tidewright.llm.queries import tokenizer

LAST = 2**63


def plain(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def later_words(data, k):
    """Per row: words, and those left after removing windows that a smaller id has."""
    first = {}
    for i, t in data:
        w = plain(t)
        for at in range(len(w) - k + 1):
            key = tuple(w[at : at + k])
            first[key] = min(first.get(key, LAST), LAST - 1 if i is None else i)
    out = []
    for i, t in data:
        w = plain(t)
        gone = set()
        for at in range(len(w) - k + 1):
            if first[tuple(w[at : at + k])] < (LAST - 1 if i is None else i):
                gone |= set(range(at, at + k))
        out.append((i, len(w), len(gone), None if t is None else " ".join(x for n, x in enumerate(w) if n not in gone)))
    return out


@pytest.mark.parametrize("k", [3, 8, 50])
def test_repeats_are_those_of_brute_force(docs, odd_texts, k):
    cut = substring.remove_repeats(docs, k=k)
    assert cut.columns == [*docs.columns, "n_words", "n_removed"]
    got = sorted((tuple(r) for r in cut.select("doc_id", "n_words", "n_removed", "text").collect()), key=str)
    assert got == sorted(later_words(odd_texts, k), key=str)


def test_keys_that_many_windows_share_are_split(spark, monkeypatch):
    passage = [f"p{i}" for i in range(12)]
    data = [(i, " ".join([*(f"a{i}x{j}" for j in range(9)), *passage, *(f"b{i // 2}x{j}" for j in range(9))])) for i in range(300)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(8)
    keyed = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("fp"), "text")

    def largest(hot):
        bits = spark.sparkContext.broadcast(substring._split_bits(keyed, 20, hot))
        runs = keyed.mapInArrow(substring._window_runs(20, bits), substring._RUN).where("n > 0")
        return runs.groupBy("key").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0]

    whole = largest(1 << 20)
    assert whole > 500 and largest(40) < whole / 4
    monkeypatch.setattr(substring, "HOT", 40)  # read in the driver
    cut = substring.remove_repeats(docs, k=20).select("doc_id", "n_words", "n_removed", "text")
    assert sorted(map(tuple, cut.collect())) == sorted(later_words(data, 20))


def test_rolling_hashes_and_least_values():
    h = np.random.default_rng(1).integers(0, 2**63, 200).astype(np.uint64)
    for k in (1, 2, 7, 50, 200):
        values = c.rolling(h, k)
        assert len(values) == 200 - k + 1
        assert values[0] == c.rolling(h[:k], k)[0] and values[-1] == c.rolling(h[-k:], k)[0]
        assert (c.sliding_min(h, k) == [h[i : i + k].min() for i in range(201 - k)]).all()
    assert not len(c.rolling(h[:3], 4))


def test_small_batches_give_the_same(spark, docs, monkeypatch):
    whole = rows(substring.remove_repeats(docs, k=8).select("doc_id", "n_removed", "text"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert rows(substring.remove_repeats(docs.repartition(5), k=8).select("doc_id", "n_removed", "text")) == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def letters(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def contaminated(data, items, n):
    grams = {}
    for item, text in items:
        w = letters(text)
        size = min(n, len(w))
        for at in range(len(w) - size + 1 if w else 0):
            grams.setdefault(tuple(w[at : at + size]), set()).add(item)
    out = []
    for i, t in data:
        w = letters(t)
        hit, found = set(), set()
        for size in {len(g) for g in grams}:
            for at in range(len(w) - size + 1):
                if of := grams.get(tuple(w[at : at + size])):
                    hit |= set(range(at, at + size))
                    found |= of
        out.append((i, len(w), len(hit), sorted(x for x in found if x is not None)))
    return out


ITEMS = [(1, "w1 w2"), (2, "one"), (3, None), (4, ""), (5, "?!"), (None, "two words")]


@pytest.mark.parametrize("block", [1 << 20, 64])
def test_passages_are_those_of_brute_force(spark, docs, odd_texts, block):
    items = [*ITEMS, (7, odd_texts[0][1][50:300]), (8, odd_texts[2][1].upper().replace(" ", "--")), (8, "TWO, words")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_passages(docs, benchmark, n=10, block_bytes=block)
    got = sorted((tuple(r) for r in found.select("doc_id", "n_words", "n_hit", "hit_items").collect()), key=str)
    assert got == sorted(contaminated(odd_texts, items, 10), key=str)
    hit = {i for i, _, n, _ in contaminated(odd_texts, items, 10) if n}
    clean = decontaminate.remove_contaminated(docs, benchmark)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id is None or r.doc_id not in hit for r in clean.collect()) == [True] * clean.count()


def test_passages_are_cut_out_of_the_text(spark):
    docs = spark.createDataFrame([(1, "Keep this. A b, C d! Keep that."), (2, "x"), (3, None)], "doc_id int, text string")
    benchmark = spark.createDataFrame([(1, "a b c d")], "item_id int, text string")
    assert rows(decontaminate.remove_passages(docs, benchmark, n=4)) == [(1, "Keep this. ! Keep that."), (2, "x"), (3, None)]


def test_no_documents_and_no_benchmark(docs, no_docs):
    none = docs.selectExpr("doc_id item_id", "text").where("false")
    assert decontaminate.find_passages(no_docs, none).count() == 0
    assert {r.n_hit for r in decontaminate.find_passages(docs, none).collect()} == {0}
    assert substring.remove_repeats(no_docs).count() == 0
    assert line_dedup.remove_repeated_lines(no_docs).count() == 0
    assert jaccard.link_documents(no_docs).count() == 0
    assert jaccard.keep_one(no_docs).count() == 0
    assert quality_rules.judge(no_docs).count() == 0


def later_lines(data, m, keep_blank=False):
    places = {}
    key = lambda i, t: (LAST if i is None else i, hash(t))
    for i, t in data:
        lines = [] if t is None else t.split("\n")
        for at in range(len(lines) - m + 1):
            places.setdefault(tuple(lines[at : at + m]), []).append((*key(i, t), at))
    out = []
    for i, t in data:
        lines = [] if t is None else t.split("\n")
        gone = set()
        for at in range(len(lines) - m + 1):
            here = (*key(i, t), at)
            if any(p[0] < here[0] or p[:2] == here[:2] and p < here for p in places[tuple(lines[at : at + m])]):
                gone |= set(range(at, at + m))
        gone = {n for n in gone if plain(lines[n])} if keep_blank else gone
        out.append((i, len(lines), len(gone), None if t is None else "\n".join(x for n, x in enumerate(lines) if n not in gone)))
    return out


@pytest.mark.parametrize("m", [1, 2, 3, 4])
def test_repeated_lines_are_those_of_brute_force(docs, odd_texts, m):
    cut = line_dedup.remove_repeated_lines(docs, min_lines=m)
    assert cut.columns == [*docs.columns, "n_lines", "n_removed"]
    got = sorted((tuple(r) for r in cut.select("doc_id", "n_lines", "n_removed", "text").collect()), key=str)
    assert got == sorted(later_lines(odd_texts, m), key=str)


@pytest.mark.parametrize("m", [1, 2])
def test_blank_lines_may_stay(spark, docs, odd_texts, m):
    cut = line_dedup.remove_repeated_lines(docs, min_lines=m, keep_blank=True).select("doc_id", "n_lines", "n_removed", "text")
    assert sorted(map(tuple, cut.collect()), key=str) == sorted(later_lines(odd_texts, m, keep_blank=True), key=str)
    data = [(1, "a b\n\nc\n \t\nd"), (2, "c\n\nx\n\na b"), (3, "\n\n"), (4, "d")]
    cut = line_dedup.remove_repeated_lines(spark.createDataFrame(data, "doc_id long, text string"), m, keep_blank=True)
    assert sorted(map(tuple, cut.select("doc_id", "n_lines", "n_removed", "text").collect())) == later_lines(data, m, keep_blank=True)


def test_repeated_rows_do_not_multiply_places(spark):
    text = "\n".join(f"line {i}" for i in range(64))
    data = [(1, text), (1, text), *[(None, "x\ny\n" + text)] * 20, (2, "y\nline 0\nz")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    places = line_dedup._lines(docs, "doc_id", "text").groupBy("id", "fp", "pos").count()
    assert places.where("count > 1").count() == 0
    cut = line_dedup.remove_repeated_lines(docs).select("doc_id", "n_lines", "n_removed", "text")
    assert sorted(map(tuple, cut.collect()), key=str) == sorted(later_lines(data, 2), key=str)


def test_runs_are_maximal(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc\nd\ne\nf"), (2, "x\nb\nc\nd\ne\ny"), (3, "c\nd\nz\nb\nc")], "doc_id int, text string")
    runs = line_dedup.repeated_runs(docs, 2)
    assert rows(runs.select("id", "start", "stop")) == [(2, 1, 5), (3, 0, 2), (3, 3, 5)]


def repeat_words(words, k=8):
    places = {}
    for at in range(len(words) - k + 1):
        places.setdefault(tuple(words[at : at + k]), []).append(at)
    return len({i for at in places.values() if len(at) > 1 for a in at for i in range(a, a + k)})


def test_measures_are_those_of_brute_force(docs, odd_texts):
    got = sorted((tuple(r) for r in quality_rules.judge(docs).select("doc_id", *quality_rules.MEASURES, "base_failed").collect()), key=str)
    want = []
    for i, t in odd_texts:
        w, lines = plain(t), [x for x in (t or "").split("\n") if plain(x)]
        n = repeat_words(w)
        want.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), n, len(w) < 20 or 100 * n > 30 * len(w)))
    assert got == sorted(want, key=str)


def test_order_of_rules_does_not_change_the_verdict(docs):
    measured = quality_rules.measures(docs)
    rules = quality_rules.text_rules()
    verdicts = [rows(measured.select("doc_id", quality_rules.first_rejection(order).isNull().alias("kept"))) for order in (rules, rules[::-1])]
    assert verdicts[0] == verdicts[1]
    found = quality_rules.estimate(docs, rules)
    assert {e.rule.name for e in found} == {r.name for r in rules}
    gains = [e.rejected / e.seconds for e in found]
    assert gains == sorted(gains, reverse=True)


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def groups(data, k, percent):
    sets = [shingles(t, k) for _, t in data]
    parent = list(range(len(data)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(data)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[top(a)] = top(b)
    least = {}
    for n, (i, _) in enumerate(data):
        least[top(n)] = min(least.get(top(n), LAST), LAST if i is None else i)
    return [(i, len(sets[n]), None if least[top(n)] == LAST else least[top(n)]) for n, (i, _) in enumerate(data)]


def near_copies(rng, n):
    data, texts = [], []
    for i in range(n):
        if texts and rng.random() < 0.6:
            w = rng.choice(texts).split()
            for _ in range(rng.randrange(6)):
                w[rng.randrange(len(w))] = f"v{rng.randrange(1000)}"
            t = " ".join(w)
        else:
            t = " ".join(f"w{rng.randrange(60)}" for _ in range(rng.choice([2, 8, 11, 60, 200])))
        texts.append(t)
        data.append((i, t))
    return data


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80), (1, 50)])
def test_groups_are_those_of_brute_force(spark, docs, odd_texts, k, percent):
    import random

    got = sorted((tuple(r) for r in jaccard.link_documents(docs, k, percent).select("id", "n_shingles", "component_id").collect()), key=str)
    assert got == sorted(groups(odd_texts, k, percent), key=str)
    data = near_copies(random.Random(k), 250)
    linked = jaccard.link_documents(spark.createDataFrame(data, "doc_id long, text string"), k, percent)
    assert sorted(tuple(r) for r in linked.select("id", "n_shingles", "component_id").collect()) == sorted(groups(data, k, percent))


def test_long_lists_are_split_without_loss(spark, monkeypatch):
    import random

    monkeypatch.setattr(jaccard, "LONG", 3)  # read when the tasks' function is made, in the driver
    data = near_copies(random.Random(9), 120)
    linked = jaccard.link_documents(spark.createDataFrame(data, "doc_id long, text string"), 3, 90)
    assert sorted(tuple(r) for r in linked.select("id", "n_shingles", "component_id").collect()) == sorted(groups(data, 3, 90))


def test_one_document_of_each_group_stays(docs, odd_texts):
    kept = jaccard.keep_one(docs, 3, 90)
    assert kept.columns == docs.columns
    want = {g if g is not None else None for i, n, g in groups(odd_texts, 3, 90) if n}
    some = [r for r in kept.collect() if (r.text or "").split()]
    assert sorted(map(str, (r.doc_id for r in some))) == sorted(map(str, want))
    assert {r.doc_id for r in kept.collect()} >= {20, 21, 22}


def close_copies(rng, groups_, size, words=60, swaps=6):
    """Groups of texts around the threshold: some pairs link, others just fail to."""
    data = []
    for g in range(groups_):
        base = [f"g{g}w{i}" for i in range(words)]
        for _ in range(size):
            text = list(base)
            for at in rng.choice(words, rng.integers(0, swaps), replace=False):
                text[at] = f"x{rng.integers(10**9)}"
            data.append((len(data), " ".join(text)))
    return data


@pytest.mark.parametrize("list_block, set_block", [(4_000, 8 << 20), (5, 3000)])
def test_large_groups_of_near_copies(spark, monkeypatch, list_block, set_block):
    """Small blocks deal one list, and one cluster, to many tasks; no link is lost between them."""
    monkeypatch.setattr(jaccard, "LIST_BLOCK", list_block)
    monkeypatch.setattr(jaccard, "SET_BLOCK", set_block)
    data = close_copies(np.random.default_rng(6), 3, 40)
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    linked = jaccard.link_documents(df, k=3, percent=80)
    assert sorted(tuple(r) for r in linked.select("id", "n_shingles", "component_id").collect()) == sorted(groups(data, 3, 80))


def test_forests_span_what_all_pairs_span():
    rng = np.random.default_rng(7)
    sets = []
    for _ in range(4):
        base = rng.integers(0, 2**63, 200).astype(np.uint64)
        for _ in range(12):
            new = rng.integers(0, 30)
            sets.append(np.unique(np.concatenate([rng.permutation(base)[new:], rng.integers(0, 2**63, new).astype(np.uint64)])))
    n, label = np.array([len(x) for x in sets]), np.arange(len(sets)) // 3  # some components are known
    sketches = [jaccard.sketch(x, 90) for x in sets]

    def parts(edges):
        root = list(range(len(sets)))
        for a, b in edges:
            a, b = ([r for r in [root[x]]][0] for x in (a, b))
            root = [b if x == a else x for x in root]
        return [root.index(x) for x in root]

    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if label[i] != label[j]]
    possible = [(i, j) for i, j in pairs if jaccard.parts_apart(sketches[i], sketches[j]) <= jaccard.most_apart(n[i] + n[j], 90)
                and min(n[i], n[j]) * 100 >= max(n[i], n[j]) * 90]
    one = np.zeros(len(sets), np.int64)
    found = jaccard.open_forest(n, label, one, sketches, 90)
    assert parts(found) == parts(possible) and len(found) < len(sets)
    same = lambda i, j: len(np.intersect1d(sets[i], sets[j]))
    links = [(i, j) for i, j in pairs if 100 * same(i, j) >= 90 * (n[i] + n[j] - same(i, j))]
    known = [(i, i - 1) for i in range(1, len(sets)) if label[i] == label[i - 1]]
    joined = jaccard.link_forest(label, one, sets, 90)
    assert set(joined) <= {(j, i) for i, j in links} and parts(joined + known) == parts(links + known)
    two = np.arange(len(sets)) % 2
    across = jaccard.link_forest(np.arange(len(sets)), two, sets, 90)
    assert all(two[i] != two[j] for i, j in across) and across


def test_divide_skip_counts():
    rng = np.random.default_rng(3)
    for least in (1, 2, 5, 9):
        lists = [sorted(set(rng.integers(0, 40, rng.integers(0, 30)).tolist())) for _ in range(12)]
        count = {x: sum(x in one for one in lists) for x in range(40)}
        assert jaccard.divide_skip(lists, least) == {x: n for x, n in count.items() if n >= least}


def test_sketches_never_rule_out_a_link():
    rng = np.random.default_rng(4)
    for _ in range(300):
        n = int(rng.integers(9, 900))
        percent = int(rng.choice([50, 80, 90]))
        one = np.unique(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
        gone = rng.integers(0, len(one) // 5 + 1)
        other = np.unique(np.concatenate([one[gone:], rng.integers(0, 2**63, rng.integers(0, n // 5 + 1)).astype(np.uint64)]))
        same = len(np.intersect1d(one, other))
        apart = jaccard.parts_apart(jaccard.sketch(one, percent), jaccard.sketch(other, percent))
        assert apart <= len(one) + len(other) - 2 * same
        if 100 * same >= percent * (len(one) + len(other) - same):
            assert apart <= jaccard.most_apart(len(one) + len(other), percent)


def test_columns_are_found_in_any_case(spark, docs):
    """Workers look columns up by their exact names, which the operators therefore resolve."""
    renamed = docs.withColumnRenamed("text", "Text")
    items = spark.createDataFrame([(1, "w1 w2")], "item_id long, text string")
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 1)], "doc_id long, quality int, toxic int")
    path, pattern = tokenizer()
    made = [
        substring.remove_repeats(renamed, k=8),
        decontaminate.find_passages(renamed, items),
        decontaminate.remove_passages(renamed, items),
        line_dedup.remove_repeated_lines(renamed),
        bpe.encode(renamed, path, pattern),
        quality_classifier.judge(renamed, labels),
        html.extract(renamed.withColumnRenamed("Text", "Html")),
    ]
    assert [df.count() for df in made] == [docs.count()] * len(made)
    assert all("Text" in df.columns for df in made[:4])
    with pytest.raises(ValueError):
        bpe.encode(docs.drop("text"), path, pattern)
