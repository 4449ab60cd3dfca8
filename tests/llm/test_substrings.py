"""Substring dedup and its FM-index against plain counts, with hot passages, periodic and odd texts."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tiffin.llm import substrings as S
from tiffin.llm.fmindex import FMIndex, suffix_array

SCHEMA = "doc_id long, text string, row long, spans string, key int"


def plain(texts, window):
    split = [[w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w] for t in texts]
    count = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = {p for i in range(len(w) - window + 1) if count[tuple(w[i : i + window])] > 1 for p in range(i, i + window)}
        out.append((len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return out


def removed(spark, texts, window, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    docs = spark.createDataFrame([(i, t, 7, "x", 1) for i, t in zip(ids, texts)], SCHEMA).repartition(5)
    return S.remove_repeats(docs, window, ("n_words", "n_removed", "text", "kept_sha256")).collect()


def corpus(seed, n, passage):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + rng.choice(["", "x", "é", "Y"])
    shared = [[word() for _ in range(passage)] for _ in range(4)]
    texts = []
    for _ in range(n):
        w = [word() for _ in range(rng.choice([0, 3, 20, 90]))]
        for _ in range(rng.choice([0, 1, 1, 2])):
            p = list(rng.choice(shared))
            if rng.random() < 0.5:
                p[rng.randrange(len(p))] = word()
            at = rng.randrange(len(w) + 1)
            w[at:at] = p[rng.randrange(10) :]
        texts.append(rng.choice([" ", "\n", "\t \r"]).join(w))
    return texts


@pytest.mark.parametrize(("window", "limit", "shard"), [(12, 4096, 1 << 19), (12, 3, 200), (35, 4096, 900), (5, 1, 64)])
def test_removal_is_brute_force(spark, monkeypatch, window, limit, shard):
    monkeypatch.setattr(S, "LIMIT", limit)
    monkeypatch.setattr(S, "SHARD", shard)
    texts = [*corpus(window, 60, 45), "", None, " \n ", "A b", "a " * 60, "a " * 36, "one two three " * 30, "a b " * 700, "Same words " * 3, "same words " * 3]
    texts += [texts[1]] * 5
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["text"]) for r in removed(spark, texts, window)}
    assert got == dict(enumerate(plain(texts, window)))


def test_digest_and_repeated_rows(spark):
    once = " ".join(f"w{i}" for i in range(50))
    got = removed(spark, [once, once, "x " + once[:-2] + "z", None, None], 35, [4, 4, None, 5, 5])
    assert sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in got) == [(0, 51, 49), (4, 50, 50), (4, 50, 50), (5, 0, 0), (5, 0, 0)]
    assert all(r["kept_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest() for r in got)
    alone = removed(spark, [once], 35)
    assert [(r["n_removed"], r["text"]) for r in alone] == [(0, once)]


def test_no_documents(spark):
    assert removed(spark, [], 35) == []


def test_very_long_text(spark):
    rng = random.Random(2)
    w = [rng.choice("abcdefgh") * rng.randint(1, 6) for _ in range(60_000)]
    w[50_000:50_100] = w[100:200]
    got = removed(spark, [" ".join(w), "short text"], 35)
    assert {r["doc_id"]: r["n_removed"] for r in got} == {0: plain([" ".join(w)], 35)[0][1], 1: 0}


def sequences(rng, most):
    made = [[rng.randint(1, most) for _ in range(rng.randint(1, 14))] for _ in range(rng.randint(1, 8))]
    flat = np.unique(np.concatenate(made), return_inverse=True)[1] + 1
    ends = np.cumsum([len(s) for s in made])
    return flat, ends, [flat[e - len(s) : e].tolist() for s, e in zip(made, ends)]


@pytest.mark.parametrize("most", [1, 2, 3, 40])
def test_index_counts_and_matching_statistics(most):
    rng = random.Random(most)
    for _ in range(60):
        flat, ends, made = sequences(rng, most)
        weights = np.array([rng.choice([1, 1, 3]) for _ in made])
        count = Counter()
        for s, n in zip(made, weights):
            for i in range(len(s)):
                for j in range(i + 1, len(s) + 1):
                    count[tuple(s[i:j])] += int(n)
        index = FMIndex(flat, ends, weights)
        for p in rng.sample(list(count), min(15, len(count))):
            assert index.occurrences(list(p)) == count[p]
        twice = tuple(made[0] + made[0])
        assert index.occurrences(list(twice)) == count[twice]
        for window in (1, 2, 4, 9):
            want = np.zeros(len(index.text), bool)
            for s, a in zip(made, index.start):
                for i in range(len(s) - window + 1):
                    if count[tuple(s[i : i + window])] > 1:
                        want[a + i : a + i + window] = True
            assert np.array_equal(index.repeated(window), want)


def test_suffixes_are_in_order():
    flat, ends, _ = sequences(random.Random(9), 3)
    text = np.insert(flat, ends, 0)
    mark = [(0, i) if c == 0 else (1, c) for i, c in enumerate(text)]
    order = suffix_array(text)
    assert sorted(order) == list(range(len(text)))
    tail = [mark[i : i + 20] for i in order]
    assert tail == sorted(tail)


def test_bits_take_about_the_entropy():
    rng = np.random.default_rng(1)
    tokens = np.minimum(rng.zipf(1.5, 60_000), 5000)
    tokens = np.unique(tokens, return_inverse=True)[1] + 1
    index = FMIndex(tokens, np.arange(50, 60_001, 50), np.ones(1200, np.int64))
    share = np.bincount(index.text) / len(index.text)
    entropy = -sum(p * np.log2(p) for p in share if p) * len(index.text)
    assert sum(64 * len(bits.words) for bits, *_ in index.tree.levels) < entropy + 1.1 * len(index.text)


def test_stretches_of_words_are_exact():
    words = pa.array([b"a b c d e", b"x b c d y", "é b c".encode()], pa.binary())
    owner, a, z = S.repeated_stretches(words, np.ones(3, np.int64), 3)
    assert list(zip(owner, a, z)) == [(0, 1, 4), (1, 1, 4)]
