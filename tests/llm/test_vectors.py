"""Vector codes and hard negatives against plain loops, with nulls, ties, repeated rows and empty tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tiffin.llm import hardneg as H
from tiffin.llm import veccode as V

SCHEMA = "vec_id long, embedding array<double>, label int, code string, row long"


def rows_of(seed, n, dim, spread=1.0, step=None):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, spread, (n, dim))
    x = np.round(x / step) * step if step else x
    return [(int(i), [float(v) for v in x[i]], int(rng.integers(0, 4)) if i % 9 else None, "c", 1) for i in range(n)]


ODD = [(901, None, 1, "c", 1), (902, [1.0, None] * 4, 1, "c", 1), (903, [math.nan] + [0.0] * 7, 1, "c", 1), (904, [math.inf] + [0.0] * 7, 1, "c", 1), (905, [1.0] * 3, 1, "c", 1)]


def good(rows, dim):
    return [r for r in rows if r[1] is not None and len(r[1]) == dim and all(x is not None and math.isfinite(x) for x in r[1])]


def plain_codes(rows, parts, entries, rounds, scale):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(rows[0][1]) // parts
    x = [[[math.floor(scale * v) for v in r[1][p * width : (p + 1) * width]] for p in range(parts)] for r in rows]
    books = [[x[i][p] for i in range(min(entries, len(x)))] for p in range(parts)]

    def near(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(book))

    for k in range(rounds + 1):
        found = [[near(v[p], books[p]) for p in range(parts)] for v in x]
        if k == rounds:
            break
        for p in range(parts):
            for e in range(len(books[p])):
                if mine := [v[p] for v, f in zip(x, found) if f[p][1] == e]:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    return [(r[0], r[2], "".join(f"{f[1]:02x}" for f in fs), sum(f[0] for f in fs)) for r, fs in zip(rows, found)], books


@pytest.mark.parametrize(("step", "entries", "rounds"), [(None, 16, 2), (0.5, 16, 3), (1.0, 64, 4)])
def test_vector_codes_are_brute_force(spark, step, entries, rounds):
    # Coarse steps make ties and equal entries; repeated ids and rows, and a null id, are among them.
    rows = rows_of(3, 150, 8, step=step)
    rows += [rows[5], rows[5], (7, [0.0] * 8, 2, "c", 1), (None, [0.5] * 8, None, "c", 1), *ODD]
    got, books = V.vector_codes(spark.createDataFrame(rows, SCHEMA).repartition(4), parts=4, entries=entries, rounds=rounds, scale=16.0)
    want, plain = plain_codes(good(rows, 8), 4, entries, rounds, 16.0)
    assert books.tolist() == plain
    key = lambda r: str(tuple(r))
    assert sorted(got.collect(), key=key) == sorted(want, key=key)


def test_active_entries_alone_give_the_codes_of_a_full_scan():
    rng = np.random.default_rng(5)
    x = rng.integers(-4, 4, (400, 3, 2))
    books = rng.integers(-4, 4, (3, 12, 2))
    at, dist = V.assign(x, books, None, None, None)
    for _ in range(5):
        new = books.copy()
        for p in range(3):
            new[p, rng.integers(0, 12, 4)] = rng.integers(-4, 4, (4, 2))
        moved = (new != books).any(2)
        at, dist = V.assign(x, new, moved, at, dist)
        full = V.assign(x, new, None, None, None)
        assert np.array_equal(at, full[0]) and np.array_equal(dist, full[1])
        books = new


def test_distances_stay_exact_beyond_doubles():
    x, c = np.array([[4_000_000, -4_000_000] * 8], np.int64), np.array([[-4_000_000, 3_999_999] * 8], np.int64)
    assert V._distances(x, c)[0, 0] == sum((int(a) - int(b)) ** 2 for a, b in zip(x[0], c[0]))


def test_label_errors_and_digest(spark):
    rows = rows_of(4, 60, 8)
    out = V.coded_vectors(spark.createDataFrame(rows, SCHEMA), parts=4, entries=8).collect()
    want, books = plain_codes(rows, 4, 8, 2, 256.0)
    by = {}
    for _, label, _, error in want:
        by[label] = by.get(label, 0) + error
    label = {r[0]: r[2] for r in rows}
    assert {r["vec_id"]: r["label_error"] for r in out} == {i: by[label[i]] for i in label}
    assert len({r["codebooks_sha256"] for r in out}) == 1 == len({V.codebook_digest(np.array(books))} | {out[0]["codebooks_sha256"]})


def test_no_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert V.coded_vectors(empty).count() == 0 and V.coded_vectors(spark.createDataFrame(ODD[:4], SCHEMA)).count() == 0
    assert H.hard_negatives(empty, F.col("vec_id") % 2 == 0).count() == 0
    with pytest.raises(ValueError, match="do not divide"):
        V.vector_codes(spark.createDataFrame(rows_of(1, 3, 6), SCHEMA), parts=4)


@pytest.mark.parametrize(("dim", "size"), [(1, 10), (8, 300), (64, 600), (64, 1 << 22), (700, 1 << 22), (5000, 1000)])
def test_residue_scores_are_exact(dim, size):
    rng = np.random.default_rng(dim)
    a, b = rng.integers(-size, size + 1, (7, dim)), rng.integers(-size, size + 1, (9, dim))
    a[0], b[0], b[1] = size, size, -size
    want = [[sum(int(x) * int(y) for x, y in zip(u, v)) for v in b] for u in a]
    assert H.scores(a, b).tolist() == want


def test_primes_leave_float32_exact():
    for dim in (1, 8, 64, 768, 4096):
        primes = H.primes_for(dim)
        assert len(primes) == len(set(primes)) and all(dim * (p // 2) ** 2 <= 1 << 24 for p in primes)
        assert math.prod(primes) > 1 << 60


def plain_negatives(rows, anchors, positives, negatives, scale):
    x = [([math.floor(scale * v) for v in r[1]], r[2], r[0]) for r in rows if r[2] is not None]
    dot = lambda a, b: sum(p * q for p, q in zip(a, b))
    last = lambda i: (i is None, i or 0)
    out = []
    for n, (q, label, vid) in enumerate(x):
        if not anchors(vid):
            continue
        near = [(-dot(q, y), last(i), i) for m, (y, k, i) in enumerate(x) if m != n and k == label]
        far = [(-dot(q, y), last(i), i) for y, k, i in x if k != label]
        for p, _, pid in sorted(near)[:positives]:
            fit = [(s, i) for s, _, i in sorted(far) if 50 * -p <= 100 * -s <= 95 * -p][:negatives]
            out += [(vid, pid, k + 1, i, -p, -s) for k, (s, i) in enumerate(fit)]
    return out


@pytest.mark.parametrize(("step", "tile"), [(None, 1024), (0.5, 16)])
def test_hard_negatives_are_brute_force(spark, monkeypatch, step, tile):
    monkeypatch.setattr(H, "ROWS", tile)
    monkeypatch.setattr(H, "ANCHORS", tile)
    monkeypatch.setattr(H, "GROUP", 13)
    rows = rows_of(8, 240, 8, step=step)
    # Repeated anchors, an anchor alone with its label, a null id, and zero vectors whose window is the score 0.
    rows += [rows[10], rows[10], (1000, rows[20][1], 77, "c", 1), (None, rows[30][1], 1, "c", 1), (1005, [0.0] * 8, 2, "c", 1), *ODD]
    got = H.hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(5), F.col("vec_id") % 5 == 0, scale=16.0).collect()
    want = plain_negatives(good(rows, 8), lambda i: i is not None and i % 5 == 0, 5, 3, 16.0)
    key = lambda r: str(tuple(r))
    assert len(want) > 100
    assert sorted(got, key=key) == sorted(want, key=key)
