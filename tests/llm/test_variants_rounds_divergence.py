"""Spelling variants, merge rounds and the divergence audit against brute force and the tokenizers library."""

from __future__ import annotations

import json
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.conftest import rows
from tidewright.llm import divergence, merge_rounds, spelling

PATH = public_tokenizers.path("byte_bpe_50k.json")


def edits(word, alphabet):
    """All words one edit away."""
    cut = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    made = {a + b[1:] for a, b in cut if b} | {a + x + b for a, b in cut for x in alphabet}
    return (made | {a + x + b[1:] for a, b in cut if b for x in alphabet}) - {word}


def variants(counts, ratio):
    alphabet, out = set("".join(counts)), {}
    for word, n in counts.items():
        near = [x for x in edits(word, alphabet) if x in counts]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        out[word] = (n, len(near), best if best and counts[best] >= ratio * n else None)
    found = []
    for word, (n, near, form) in out.items():
        root = word
        while out[root][2] is not None:
            root = out[root][2]
        found.append((word, form, root, n, near, counts[form] if form is not None else None))
    return sorted(found)


def some_words(seed, n, letters, most):
    rng = random.Random(seed)
    return {"".join(rng.choice(letters) for _ in range(rng.randint(1, most))): rng.choice([1, 2, 9, 50, 300]) for _ in range(n)}


@pytest.mark.parametrize("part", [10_000, 3])
@pytest.mark.parametrize("letters", ["ab", "abcdeé"])
def test_variants_are_those_of_brute_force(spark, monkeypatch, letters, part):
    monkeypatch.setattr(spelling, "PART", part)  # small parts are halved down to single places
    counts = some_words(1, 400, letters, 7) | {"x" * 900: 7, "x" * 901: 40, "y" + "x" * 900: 3, "zzz": 1}
    words = spark.createDataFrame([*counts.items(), (None, 5)], "word string, n long")
    got = spelling.group_variants(words, ratio=5)
    assert sorted(map(tuple, got.select("word", "form", "root", "n", "n_near", "form_n").collect())) == variants(counts, 5)


def test_small_batches_of_parts_give_the_same(spark, monkeypatch):
    counts = some_words(2, 500, "abc", 6)
    words = spark.createDataFrame(list(counts.items()), "word string, n long").coalesce(1)
    found = spelling.near_words(words)
    whole = rows(found)
    for name, value in (("WORDS", 20), ("BLOCK", 8)):
        monkeypatch.setattr(spelling, name, value)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert rows(spelling.near_words(words)) == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_acceptor_is_minimal_and_numbers_its_words():
    words = sorted({w + end for w in ("walk", "talk", "ask") for end in ("", "ed", "s", "ing")})
    made = spelling.Acceptor(np.ones(len(words), np.int64), words)
    # After any stem the same endings follow; the states are those of the smallest acceptor.
    right = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for w in words for p in (w[:i] for i in range(len(w) + 1))}
    assert len(made.accepts) == len(right)
    for node, (first, depth) in enumerate(zip(made.first, made.depth, strict=True)):
        language = [w[depth:] for w in words if w.startswith(words[first][:depth])]
        assert made.words_from[made.state[node]] == len(language)


def test_words_are_counted_with_planted_errors(docs, odd_texts):
    want = Counter()
    for i, text in odd_texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(x.lower() if x.isascii() else x for x in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 3 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            want[run] += 1
    got = spelling.count_words(docs, min_length=1, min_count=2, drop_one_in=3, text_col="TEXT")
    assert dict(map(tuple, got.collect())) == {w: n for w, n in want.items() if w and n >= 2}


def test_no_words(spark, no_docs, docs):
    assert spelling.spelling_variants(no_docs).isEmpty()
    assert spelling.spelling_variants(docs.withColumn("text", F.lit(None).cast("string"))).isEmpty()
    with pytest.raises(ValueError):
        spelling.group_variants(spark.createDataFrame([], "word string, n long"), ratio=1)


def library():
    return Tokenizer.from_file(PATH)


def odd_strings():
    rng = random.Random(3)
    bits = [*"abcde  \n\n\t.,'’s12éñ中文　\x1c\x85\xa0 <|>", "\U000323b5", "՘", "\U00010940", "<|endoftext|>", "'ll", " 've", "the "]
    made = ["".join(rng.choice(bits) for _ in range(rng.randrange(50))) for _ in range(3000)]
    return [*made, "", " ", "   ", "a" * 3000, "ab" * 999, "".join(rng.choice("abcdefgh") for _ in range(9000)), "<|endoftext|>" * 3]


def test_rounds_give_what_the_library_gives(spark):
    texts = odd_strings()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    both = merge_rounds.decode(merge_rounds.encode(docs, PATH), PATH).orderBy("doc_id").collect()
    known = library()
    want = known.encode_batch(texts, add_special_tokens=False)
    assert [r.token_ids for r in both] == [e.ids for e in want]
    assert [r.n_tokens for r in both] == [len(e.ids) for e in want]
    assert [r.decoded for r in both] == [known.decode(e.ids, skip_special_tokens=False) for e in want]


def test_any_ids_decode_as_in_the_library(spark):
    rng = random.Random(4)
    ids = [[rng.randrange(50_300) for _ in range(rng.randrange(20))] for _ in range(500)]
    df = spark.createDataFrame([(x, "a") for x in ids] + [(None, "b")], "token_ids array<int>, DECODED string")
    got = merge_rounds.decode(df, PATH)
    assert got.columns == ["token_ids", "decoded"]
    known = library()
    assert [r.decoded for r in got.collect()] == [known.decode(x, skip_special_tokens=False) for x in ids] + [""]


def test_merges_out_of_order_go_one_by_one():
    made = json.load(open(PATH))
    vocab = made["model"]["vocab"]
    made["model"]["merges"] = [["ab", "c"], ["b", "c"], ["a", "b"]]
    made["model"]["vocab"] = {k: v for k, v in vocab.items() if len(k) == 1} | {"ab": 300, "bc": 301, "abc": 302}
    coder = merge_rounds.Coder(json.dumps(made).encode())
    assert not coder.ordered
    known = Tokenizer.from_str(json.dumps(made))
    for text in ("abc", "abab", "ababc", "cabcbabc", "bcabbc"):
        assert np.frombuffer(coder.encode([text])[0], "<u4").tolist() == known.encode(text, add_special_tokens=False).ids


def test_rounds_on_odd_rows(spark, docs, no_docs, odd_texts, monkeypatch):
    monkeypatch.setattr(merge_rounds, "CACHE_BYTES", 1000)
    made = merge_rounds.encode(docs.withColumn("N_Tokens", F.lit(1)), PATH, text_col="TEXT")
    assert made.columns == [*docs.columns, "n_tokens", "token_ids"]
    want = library().encode_batch([t or "" for _, t in odd_texts], add_special_tokens=False)
    assert sorted(r.token_ids for r in made.collect()) == sorted(e.ids for e in want)
    assert merge_rounds.decode(merge_rounds.encode(no_docs, PATH), PATH).isEmpty()


def audit_by_hand(data, min_docs, top):
    """The audit in plain Python integers."""
    terms = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")) for lang, source, text in data]
    terms = [(a, b, ["".join(x.lower() if x.isascii() else x for x in t) for t in words]) for a, b, words in terms]
    groups = sorted({(a, b) for a, b, _ in terms})
    out = []
    for lang in {a for a, _ in groups}:
        in_docs, total, by = Counter(), Counter(), defaultdict(Counter)
        for a, b, words in terms:
            if a == lang:
                in_docs.update(set(words))
                total.update(words)
                by[b].update(words)
        kept = [t for t in in_docs if in_docs[t] >= min_docs]
        n = {b: sum(by[b][t] for t in kept) for a, b in groups if a == lang}
        p = {b: {t: 1 + 10**9 * (by[b][t] + 1) // (n[b] + len(kept)) for t in kept} for b in n}
        whole = sum(total[t] for t in kept) + len(kept)
        q = {t: 1 + 10**9 * (total[t] + 1) // whole for t in kept}
        for b in n:
            pairs = [(sum((p[b][t] - p[x][t]) ** 2 // p[x][t] for t in kept), x) for x in n if x != b]
            own = [((p[b][t] - q[t]) ** 2 // q[t], t) for t in kept if by[b][t] and p[b][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", own, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, b, part, item, value, i + 1) for i, (value, item) in enumerate(found[:most])]
    return sorted(out)


@pytest.mark.parametrize("min_docs, top", [(1, 3), (3, 200)])
def test_audit_is_that_of_brute_force(spark, monkeypatch, min_docs, top):
    rng = random.Random(6)
    words = ["The", "the", "cat", "dog", "éa", "Éa", "中", "sun", "moon", "a1b", "x"] + [f"w{chr(97 + i)}" for i in range(20)]
    data = [
        (rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "s3", "é", None]), " ".join(rng.choices(words, k=rng.randrange(30))))
        for _ in range(120)
    ]
    data += [("fr", "s1", None), ("fr", "s2", ""), ("it", "s1", "solo"), ("it", "s1", "solo"), ("en", "s9", "123 456"), ("en", "s1", "moon " * 5000)]
    docs = spark.createDataFrame([(*d, 1) for d in data], "lang string, source string, text string, ITEM int").repartition(4)
    monkeypatch.setattr(divergence, "BLOCK", 5)
    monkeypatch.setattr(divergence, "HELD", 10)
    got = divergence.audit(docs, min_docs, top)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == audit_by_hand(data, min_docs, top)
    assert divergence.audit(docs.where("false")).isEmpty()


def test_tree_meets_every_pair_once():
    rng = random.Random(8)
    made = Counter(tuple((s, rng.randint(1, 2)) for s in sorted(rng.sample(range(6), rng.randint(1, 6)))) for _ in range(300))
    paths = sorted(made)
    flat = [x for row in paths for x in row]
    tree = divergence.Tree(
        np.array([s for s, _ in flat]), np.array([n for _, n in flat]), np.array([len(r) for r in paths]), np.array([made[r] for r in paths])
    )
    want = Counter()
    for row, times in made.items():
        for j, b in enumerate(row):
            for a in row[:j]:
                want[a, b] += times
    got, met = Counter(), 0
    for node, up, times in tree.pairs():
        met += len(node)
        for i, j, n in zip(node.tolist(), up.tolist(), times.tolist(), strict=True):
            got[flat[j], flat[i]] += n
    assert got == want
    prefixes = {row[: i + 1] for row in paths for i in range(len(row))}
    assert met == sum(len(p) - 1 for p in prefixes)  # once per node and ancestor


def test_shares_stay_exact_for_large_counts(spark):
    total = 9 * 10**15
    counts = [0, 1, 10**9, 10**13 + 7, total - 1]
    df = spark.createDataFrame([(n, total) for n in counts], "n long, total long")
    got = [r[0] for r in df.select(divergence.share(F.col("n"), F.col("total"))).collect()]
    assert got == [1 + 10**9 * (n + 1) // total for n in counts]
