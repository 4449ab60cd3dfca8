"""Set join, exact and line dedup against brute force, with nulls, empty and long texts, ties and clashing names."""

import hashlib
import random
import re

import numpy as np
import pytest

from tiffin.llm import exactdedup as E
from tiffin.llm import linededup as L
from tiffin.llm import setjoin as S
from tiffin.llm._spark import components, repeated_keys

SCHEMA = "doc_id long, text string, n long, component string, key int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if w]


def sets(text, width):
    w = words(text)
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def union_find(n, links):
    up = list(range(n))

    def top(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for a, b in links:
        up[top(a)] = top(b)
    return [top(i) for i in range(n)]


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 6))) for _ in range(300)]
    base = [" ".join(rng.choices(vocabulary, k=rng.choice([3, 8, 20, 60, 200]))) for _ in range(n // 6)]
    out = []
    for _ in range(n):
        w = rng.choice(base).split(" ")
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        out.append(" ".join(w))
    return out


def frame(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, 7, "x", 1) for i, t in zip(ids, texts)], SCHEMA)


@pytest.mark.parametrize(("width", "threshold"), [(3, 0.9), (5, 0.8)])
def test_set_join_is_brute_force(spark, width, threshold):
    texts = [*corpus(1), "", None, "one", "ONE", "one two", "a b c d", "A  B\tc\nd", " \t ", *["hot group of equal texts"] * 30]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in S.similar_components(frame(spark, texts), width, threshold).collect()}
    s = [sets(t, width) for t in texts]
    links = [(i, j) for i in range(len(s)) for j in range(i) if s[i] and s[j] and 1000 * len(s[i] & s[j]) >= round(threshold * 1000) * len(s[i] | s[j])]
    root = union_find(len(s), links)
    assert got == {i: (len(s[i]), min(j for j in range(len(s)) if root[j] == root[i])) for i in range(len(s))}


@pytest.mark.parametrize("threshold", [0.7, 0.8, 0.9])
def test_linked_sets_share_the_keys_they_need(threshold):
    rng = np.random.default_rng(round(threshold * 100))
    per_mille, tight = round(threshold * 1000), 0
    for _ in range(600):
        n = int(rng.choice([5, 12, 40, 41, 90, 300]))
        a = np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64))
        keep = a[rng.permutation(len(a))[: len(a) - int(rng.integers(0, max(1, round(len(a) * (1 - threshold))) + 1))]]
        b = np.unique(np.concatenate([keep, rng.integers(0, 1 << 62, int(rng.integers(0, 1 + len(a) // 6)), dtype=np.uint64)]))
        common = len(np.intersect1d(a, b))
        if 1000 * common < per_mille * (len(a) + len(b) - common) or common == len(a) == len(b):
            continue
        shared = len(np.intersect1d(S.part_keys(a, threshold), S.part_keys(b, threshold)))
        for x in (a, b):
            need = S.shared_keys_needed(x, threshold)
            assert 1 <= need <= shared
            tight += need > 1
    assert tight > 100


def test_set_join_hot_near_copies(spark):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for k in range(200):
        w = list(base)
        for _ in range(k % 6):
            w[rng.randrange(150)] = f"v{rng.random()}"
        texts.append(" ".join(w))
    got = {r["doc_id"]: r["component_id"] for r in S.similar_components(frame(spark, texts), 3, 0.9).collect()}
    s = [sets(t, 3) for t in texts]
    root = union_find(200, [(i, j) for i in range(200) for j in range(i) if 10 * len(s[i] & s[j]) >= 9 * len(s[i] | s[j])])
    assert got == {i: min(j for j in range(200) if root[j] == root[i]) for i in range(200)}


def test_set_join_odd_rows(spark):
    assert S.similar_components(frame(spark, []), 3, 0.9).collect() == []
    rows = S.similar_components(frame(spark, ["a b c d", "a b c d", "a b c d"], [None, 5, 5]), 3, 0.9).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in rows) == [(0, 5), (5, 5), (5, 5)]


def test_repeated_keys_and_components(spark):
    rng = np.random.default_rng(3)
    rows = [(int(k), int(v)) for k, v in zip(rng.integers(0, 60, 400), rng.integers(0, 40, 400))] + [(1000, 1)] * 5
    df = spark.createDataFrame(rows, "key long, node long").repartition(7)
    want = {(k, v) for k, v in rows if len({b for a, b in rows if a == k}) > 1}
    got = repeated_keys(df, "key", "node").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    edges = [(i, i + 1) for i in range(50)] + [(100, 90), (90, 95), (200, 200)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, 90: 90, 95: 90, 100: 90}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fingerprints_compose():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 300_000, dtype=np.uint8)
    whole = E.fingerprint(data)
    for cut in (0, 1, 65_536, 123_457, 300_000):
        assert E.combine(E.fingerprint(data[:cut]), E.fingerprint(data[cut:])) == whole
    assert E.fingerprint(np.zeros(3, np.uint8)) != E.fingerprint(np.zeros(4, np.uint8))


def exact_want(texts, ids):
    low = [(t or "").translate(LOWER) for t in texts]
    out = []
    for i, t in zip(ids, low):
        same = [j for j, u in zip(ids, low) if u == t]
        keep = max((j for j in same if j is not None), default=None)
        out.append((i, keep, len(same), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("collide", [False, True])
def test_exact_dedup(spark, monkeypatch, collide):
    texts = ["A b", "a B", None, "", "É", "é", "x" * 200_000, "X" * 200_000, "x" * 199_999 + "y", *["hot"] * 40, "null id", "Null ID"]
    ids = [*range(len(texts) - 2), None, None]
    df = frame(spark, texts, ids)
    if collide:  # fingerprints that hardly tell texts apart: the comparison must
        real = E._fingerprints
        monkeypatch.setattr(E, "_fingerprints", lambda *a: real(*a).selectExpr("doc_id", "0L as f1", "0L as f2", "size", "x"))
    got = sorted((tuple(r) for r in E.exact_duplicates(df).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)
    assert got == exact_want(texts, ids)
    assert E.exact_duplicates(df.limit(0)).collect() == []


def line_want(rows):
    """Kept line numbers of each document, by exact comparison of all pairs of lines."""
    places = []
    for i, t in rows:
        for n, line in enumerate(L.split_lines(t)):
            if len(line) >= L.MIN_CHARS:
                places.append(((i, n), line))
    grams = [{x[k : k + L.WIDTH] for k in range(len(x) - L.WIDTH + 1)} for _, x in places]
    links = [(a, b) for a in range(len(places)) for b in range(a) if 10 * len(grams[a] & grams[b]) >= 8 * len(grams[a] | grams[b])]
    root = union_find(len(places), links)
    first = {}
    for k, (place, _) in enumerate(places):
        first[root[k]] = min(first.get(root[k], place), place)
    return {place for k, (place, _) in enumerate(places) if first[root[k]] != place}


def test_line_dedup(spark):
    rng = random.Random(9)
    lines = ["".join(rng.choices("abcdefghij klmn", k=rng.choice([30, 60, 200, 400]))).strip() for _ in range(25)]
    near = lambda x: x[: len(x) // 2] + rng.choice("xyz") + x[len(x) // 2 + 1 :]
    rows = []
    for i in range(60):
        own = "".join(rng.choices("opqrstuvw ", k=120)).strip()
        rows.append((i, "\n".join([rng.choice(lines), own, near(rng.choice(lines)), "short", rng.choice(lines).upper()])))
    rows += [(60, None), (61, ""), (62, "\n\n"), (63, lines[0] + "\n" + lines[0])]
    df = frame(spark, [t for _, t in rows], [i for i, _ in rows])
    gone = line_want(rows)
    want = {i: None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone) for i, t in rows}
    out = L.dedup_lines(df.withColumnRenamed("n", "n_lines"))
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got == want
    assert set(out.columns) == {"doc_id", "text", "component", "key", "n_lines", "n_dropped"}
    assert {r["doc_id"]: r["n_dropped"] for r in out.collect()} == {i: sum(1 for a, _ in gone if a == i) for i, _ in rows}


def test_line_dedup_odd_rows(spark):
    assert L.dedup_lines(frame(spark, [])).collect() == []
    line = "this very line is repeated in several documents"
    rows = L.dedup_lines(frame(spark, [line, line, line], [None, 2, 2])).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in rows) == [(0, ""), (2, line), (2, line)]


def test_line_dedup_short_lines(spark):
    short = ["x", "sevench", "eightchr", "share this article now!"]
    assert [len(x) for x in short] == [1, 7, 8, 23]
    near = "share this article now!!"  # 16 of 17 shingles in common
    rows = [(1, "\n".join([*short, "", "only here"])), (2, "\n".join(["", *(x.upper() for x in short), "", "sevenc", "sevencj"])), (3, f" x \n{near}\nx\neightchs"), (4, "aaaaaaaa\naaaaaaaaa")]
    out = L.dedup_lines(frame(spark, [t for _, t in rows], [i for i, _ in rows])).collect()
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in out}
    assert got == {1: (rows[0][1], 6, 0), 2: ("\n\nsevenc\nsevencj", 8, 4), 3: ("eightchs", 4, 3), 4: ("aaaaaaaa", 2, 1)}


def test_band_keys_of_short_lines():
    """Pairs of four and five shingles, of similarity 0.8, meet; such that share one shingle of 16 hardly do."""
    rng = random.Random(12)
    draw = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    base = [draw(11) for _ in range(1000)]
    a, b = L.band_keys(base), L.band_keys([x + draw(1) for x in base])
    assert (a == b).any(axis=1).mean() > 0.985
    base = [draw(8) for _ in range(1000)]
    a, b = L.band_keys([x + draw(15) for x in base]), L.band_keys([x + draw(15) for x in base])
    assert (a == b).any(axis=1).mean() < 0.02


def test_line_dedup_broadcast_is_bounded_by_numbers(spark, monkeypatch):
    seen = {}
    real = L.sized

    def sized(df, rows=None):
        if df.columns == ["doc_key", "drop"]:
            seen["rows"] = rows
        return real(df, rows)

    monkeypatch.setattr(L, "sized", sized)
    out = L.dedup_lines(frame(spark, ["\n".join(["a line that is repeated"] * 9)] * 2)).collect()
    assert sorted(r["n_dropped"] for r in out) == [8, 9] and seen == {"rows": 17}


def test_components_of_a_long_chain_take_few_rounds(spark, monkeypatch):
    from tiffin.llm import _spark

    real, calls = _spark.checkpoint, []
    monkeypatch.setattr(_spark, "checkpoint", lambda df: calls.append(1) or real(df))
    n = 3000
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)], "a long, b long")
    got = components(edges).collect()
    assert len(got) == n + 1 and {r["component"] for r in got} == {0}
    assert len(calls) <= 3 * 14  # at most three tables a round


def similar_pair(rng, n, share):
    """Two lines of n characters with a similarity of about `share`: the second begins with other characters."""
    draw = lambda k: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=k))
    a = draw(n).replace("  ", " a")
    m = n - L.WIDTH + 1
    other = round(m * (1 - share) / (1 + share))
    return a, draw(other) + a[other:]


@pytest.mark.parametrize("n", [30, 60, 120, 300, 1000])
def test_band_recall(n):
    rng = random.Random(n)
    pairs = [similar_pair(rng, n, rng.uniform(0.8, 0.86)) for _ in range(1500)]
    grams = [[{x[k : k + L.WIDTH] for k in range(len(x) - L.WIDTH + 1)} for x in p] for p in pairs]
    good = [len(a & b) >= 0.8 * len(a | b) for a, b in grams]
    met = (L.band_keys([a for a, _ in pairs]) == L.band_keys([b for _, b in pairs])).any(axis=1)
    assert sum(good) > 500 and np.mean(met[good]) >= 0.99


def test_line_dedup_of_a_crowded_band(spark, monkeypatch):
    """Blocks of a few lines each: every two of them meet."""
    monkeypatch.setattr(L, "BLOCK_LINES", 3)
    rng = random.Random(21)
    base = "".join(rng.choices("abcdefghij klmn", k=150)).strip()
    rows = []
    for i in range(40):
        x = base
        for _ in range(i % 4):
            k = rng.randrange(10, 140)
            x = x[:k] + rng.choice("xyz") + x[k + 1 :]
        rows.append((i, x))
    gone = line_want(rows)
    got = {r["doc_id"]: r["text"] for r in L.dedup_lines(frame(spark, [t for _, t in rows], [i for i, _ in rows])).collect()}
    assert got == {i: "" if (i, 0) in gone else t for i, t in rows}


def test_common_shingles_in_runs(monkeypatch):
    """Counts do not depend on how shingles are dealt into runs and columns."""
    rng = random.Random(5)
    lines = ["".join(rng.choices("abc", k=rng.randint(8, 90))) for _ in range(20)]
    want = [[len({x[i : i + 8] for i in range(len(x) - 7)} & {y[i : i + 8] for i in range(len(y) - 7)}) for y in lines] for x in lines]
    for cells, chars in ((1 << 20, 1 << 20), (60, 1 << 20), (60, 20)):
        monkeypatch.setattr(L, "CELLS", cells)
        monkeypatch.setattr(L, "BLOCK_CHARS", chars)
        sizes, common = L._common(lines)
        for i in range(20):
            assert sizes[i] == want[i][i]
            assert [int(c) for j, c in enumerate(common[i]) if j != i] == [c for j, c in enumerate(want[i]) if j != i]


def test_line_dedup_clashing_names(spark):
    line = "this very line is repeated in several documents"
    df = spark.createDataFrame([(1, line, "a", "b", 3), (2, line, "c", "d", 4)], "doc_id long, text string, doc_key string, drop string, n_dropped int")
    out = L.dedup_lines(df)
    assert out.columns == ["doc_id", "text", "doc_key", "drop", "n_lines", "n_dropped"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, line, "a", "b", 1, 0), (2, "", "c", "d", 1, 1)]


def test_set_join_of_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 2)
    monkeypatch.setattr(S, "BLOCK_TOKENS", 50)
    texts = corpus(8, 80)
    got = {r["doc_id"]: r["component_id"] for r in S.similar_components(frame(spark, texts), 3, 0.7).collect()}
    s = [sets(t, 3) for t in texts]
    root = union_find(len(s), [(i, j) for i in range(len(s)) for j in range(i) if 10 * len(s[i] & s[j]) >= 7 * len(s[i] | s[j])])
    assert got == {i: min(j for j in range(len(s)) if root[j] == root[i]) for i in range(len(s))}
