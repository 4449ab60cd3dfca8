"""Decontamination, sharding, tokenising, extraction and classifiers against brute force or the tokenizers library."""

import hashlib
import random
import re
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tiffin.llm import bpe, decontaminate, htmlextract, quality, sharding, tokencount, toxicity
from tiffin.llm._learn import held_out
from tiffin.llm.queries import END_OF_DOCUMENT, word_vocabulary

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contaminated_want(text, items, width=13):
    w, hit, found = WORD.findall((text or "").translate(LOWER)), set(), set()
    for item, t in items:
        b = WORD.findall((t or "").translate(LOWER))
        k = min(width, len(b))
        grams = {tuple(b[i : i + k]) for i in range(len(b) - k + 1)} if k else set()
        for i in range(len(w) - k + 1):
            if tuple(w[i : i + k]) in grams:
                hit |= set(range(i, i + k))
                found.add(str(item))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


@pytest.mark.parametrize("block", [10, 4_000_000])
def test_decontamination(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    rng = random.Random(2)
    v = [f"w{i}" for i in range(30)] + ["été", "naïve"]
    items = [(i, " ".join(rng.choices(v, k=n))) for i, n in enumerate([20, 15, 13, 5, 1, 30])] + [(6, None), (7, ""), (8, "..."), (2, "same id other text " * 5)]
    texts = [" ".join(rng.choices(v, k=60)) for _ in range(20)]
    texts += [t + " " + items[k % 6][1].upper() + " " + t for k, t in enumerate(texts)] + [None, "", "?!", items[3][1]] + [items[0][1]] * 3
    docs = spark.createDataFrame([(i, t, 1, "c") for i, t in enumerate(texts)], "doc_id long, text string, n_words int, item string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in decontaminate.contamination(docs, bench).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()}
    assert got == {i: contaminated_want(t, items) for i, t in enumerate(texts)}
    kept = {r[0] for r in decontaminate.decontaminate(docs, bench).select("doc_id").collect()}
    assert kept == {i for i, t in enumerate(texts) if not contaminated_want(t, items)[4]}
    cut = decontaminate.decontaminate(docs, bench, mode="spans")
    assert cut.columns == docs.columns
    assert all(contaminated_want(r["text"], [x for x in items if len(WORD.findall(x[1] or "")) > 13])[1] == 0 or r["text"] for r in cut.collect())
    assert decontaminate.contamination(docs.limit(0), bench.limit(0)).collect() == []


def test_hilbert_curve_is_continuous():
    side = np.arange(8)
    x, y, z = (a.ravel() for a in np.meshgrid(side, side, side, indexing="ij"))
    index = sharding.hilbert_index([x, y, z], 3)
    assert sorted(index) == list(range(512))
    at = np.argsort(index)
    step = abs(np.diff(x[at])) + abs(np.diff(y[at])) + abs(np.diff(z[at]))
    assert (step == 1).all()


def test_shards(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 7)
    rng = random.Random(3)
    rows = [(i, rng.choice(["", "aé" * rng.randint(1, 900), None]), rng.choice(["a", "b", None]), rng.choice(["hot", "hot", "s1", None]), 5) for i in range(313)] + [(None, "x", "a", "hot", 5)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, shard int")
    got = sharding.hilbert_shards(docs).collect()
    assert len(got) == 316 and {r["doc_id"] for r in got} == {r[0] for r in rows}
    text = {r[0]: (r[1] or "").encode() for r in rows}
    assert all(r["size"] == len(text[r["doc_id"]]) + 16 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]]) for r in got)
    slots = {k: sorted(r["slot"] for r in got if r["shard"] == k) for k in range(40)}
    assert all(s == list(range(len(s))) for s in slots.values()) and {len(s) for s in slots.values()} == {7, 8}
    ordered = [r["hilbert"] for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))]
    assert ordered == sorted(ordered)
    assert sharding.hilbert_shards(docs.limit(0)).collect() == []


ODD = ["", None, "<|endoftext|> Hello'S we'll <|startoftext|>x", "ΑΣ ΑΣΑ İ ½ ² ª x²y \x1c a\x1fb   é ﬁ ǅ ß ẞ 漢字 ١٢ ①", "a" * 3000, "!" * 777, "don't 's 123 1.5 ___ ​ ﻿", "🎉👩‍👩‍👧 ok", "été"]


def test_bpe_is_the_library(spark):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(word_vocabulary())
    rng = random.Random(6)
    texts = ODD + ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz    '.-éüñ0123456789ABC\n", k=rng.randint(1, 400))) for _ in range(300)] + ["same"] * 3
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, ids int").repartition(3)
    got = {r["doc_id"]: r for r in bpe.bpe_encode(docs, word_vocabulary(), ("n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256"), keep=("doc_id",)).collect()}
    for i, t in enumerate(texts):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        text = lib.decode(ids, skip_special_tokens=False)
        r = got[i]
        assert r["ids"] == ids and r["n_tokens"] == len(ids) and r["decoded"] == text, t
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest() and r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.bpe_encode(docs.limit(0), word_vocabulary()).collect() == []


@pytest.mark.parametrize("block", [1, 3, 50, 100_000])
def test_token_counts(spark, block):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(word_vocabulary())
    texts = ["", None, "one", "two words", *ODD, "<|endoftext|><|endoftext|> a <|endoftext|>", "long " * 400, "", "end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    blocks = tokencount.stored(tokencount.token_files(docs, word_vocabulary(), END_OF_DOCUMENT, block))
    got = {r["doc_id"]: r["n_tokens"] for r in tokencount.count_tokens(blocks, END_OF_DOCUMENT).collect()}
    assert got == {i: len(lib.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_token_counts_of_raw_files(spark):
    rng = np.random.default_rng(8)
    stream = np.where(rng.random(1000) < 0.03, 9, rng.integers(10, 99, 1000)).astype("<u2")
    cut = np.sort(rng.choice(1000, 20, replace=False))
    rows = [("f", k, p.tobytes()) for k, p in enumerate(np.split(stream, cut))] + [("g", 0, b""), ("h", 0, None), ("i", 0, np.array([9, 9, 5], "<u2").tobytes())]
    out = tokencount.count_tokens(spark.createDataFrame(rows, "file string, block long, tokens binary"), 9, tails=True).collect()
    ends = np.flatnonzero(stream == 9)
    f = [r["n_tokens"] for r in sorted((r for r in out if r["file"] == "f" and r["nth"] is not None), key=lambda r: (r["block"], r["nth"]))]
    assert f == (np.diff(ends, prepend=-1) - 1).tolist()
    assert [r["n_tokens"] for r in out if r["file"] == "f" and r["nth"] is None] == [999 - ends[-1]]
    assert sorted((r["nth"] is None, r["n_tokens"]) for r in out if r["file"] == "i") == [(False, 0), (False, 0), (True, 1)]
    assert not [r for r in out if r["file"] in "gh"]


def test_minimum_cut_is_brute_force():
    rng = random.Random(5)
    for _ in range(150):
        n = rng.randint(1, 8)
        score = [rng.choice([-2, -0.7, -0.2, 0.1, 0.6, 1.5]) + rng.random() / 100 for _ in range(n)]
        ties = [(i, i + 1, 0.4 + rng.random()) for i in range(n - 1)] + [(rng.randrange(n), rng.randrange(n), 0.5) for _ in range(3)]
        ties = [t for t in ties if t[0] != t[1]]

        def cost(side):
            return sum(max(s, 0) for s, x in zip(score, side) if not x) + sum(max(-s, 0) for s, x in zip(score, side) if x) + sum(c for a, b, c in ties if side[a] != side[b])

        best = min(cost([m >> i & 1 for i in range(n)]) for m in range(1 << n))
        assert cost(htmlextract.minimum_cut(score, ties)) == pytest.approx(best)


PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style></head><body><header>Site</header><nav><ul><li><a href=/>Home</a></li></ul></nav>
<div id="cookie-notice">We use cookies</div><main><h1>T &amp; U</h1><p>Real <b>text</b>&nbsp;one is
 here and long enough to be kept.<br>More<p>Second<script>x("</p>")</script> part &lt;3<form><label>Mail</label></form><div class="ad-slot">Buy</div>
<section class="comments"><p>First! I like this article a lot and write a long comment here, so it is long.</p></section></main><footer>f</footer>"""


def test_html(spark):
    rows = [(1, "u", PAGE, "t"), (2, None, None, None), (3, "u", "", "t"), (4, "u", "plain words only, without any markup at all, but a lot of them to read on and on", "t"), (5, "u", "<p>unclosed <b>bold text that goes on for quite a while so that it counts as content", "t"), (6, "u", "<", "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r["page_id"]: r for r in htmlextract.extract_text(df, ("page_id", "url")).collect()}
    assert got[1]["text"] == "T & U\n\nReal text one is here and long enough to be kept. More\n\nSecond part <3"
    assert got[2]["text"] == got[3]["text"] == "" and got[4]["text"].startswith("plain words") and "bold text" in got[5]["text"]
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert htmlextract.extract_text(df.limit(0)).collect() == []


def labelled(spark, n=600):
    rng = random.Random(11)
    v = ["".join(rng.choices("aeioulnrst", k=rng.randint(2, 8))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        w = rng.choices(v, k=rng.randint(20, 200))
        toxic, bad = i % 7 == 0, i % 5 == 0
        for _ in range(2 + len(w) // 20 if toxic else 0):
            w[rng.randrange(len(w))] = rng.choice(["zblorg", "kwixmu"])
        if bad:
            w = [x + "!!" for x in w] if i % 2 else [x for x in w for _ in range(4)]
        docs.append((i, " ".join(w), 1.5, "x"))
        labels.append((i, int(not bad), int(toxic)))
    docs += [(n, None, 1.5, "x"), (n + 1, "", 1.5, "x"), (None, "no id", 1.5, "x"), (0, "again the id 0", 1.5, "x")]
    labels += [(None, 1, 1), (n, None, None), (0, 0, 1)]
    return spark.createDataFrame(docs, "doc_id long, text string, score double, y string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels


def test_held_out_never_trains(spark):
    got = {r[0]: r[1] for r in spark.range(100).select("id", held_out("id")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(100)}


@pytest.mark.parametrize(("module", "label", "apply"), [(toxicity, "toxic", toxicity.toxicity), (quality, "quality", quality.score_quality)])
def test_classifiers(spark, module, label, apply):
    docs, labels, rows = labelled(spark)
    model = module.train(docs, labels)
    out = apply(docs, model).select("doc_id", "score", "predicted", held_out().alias("held_out")).collect()
    assert len(out) == 604 and all(0 <= r["score"] <= 1 for r in out)
    cut = 0.3 if label == "toxic" else 0.7
    assert all(r["predicted"] == int(r["score"] >= cut) for r in out)
    truth = {i: (q if label == "quality" else t) for i, q, t in rows[:600]}
    held = [r for r in out if r["held_out"] and r["doc_id"] in truth and r["doc_id"]]
    assert len(held) > 100 and np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95
    # Flipped labels of held-out rows change nothing.
    flipped = labels.withColumn(label, F.when(held_out(), 1 - F.col(label)).otherwise(F.col(label)))
    again = apply(docs, module.train(docs, flipped)).select("doc_id", "score").collect()
    assert sorted((r["doc_id"] or -1, round(r["score"], 9)) for r in again) == sorted((r["doc_id"] or -1, round(r["score"], 9)) for r in out)
    none = apply(docs, module.train(docs, labels.limit(0))).select("score").distinct().collect()
    assert len(none) == 1 and 0 <= none[0][0] <= 1
    assert apply(docs.limit(0), model).collect() == []


@pytest.mark.parametrize("block", [3, 100_000])
def test_token_counts_of_texts_with_special_tokens(spark, block):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(word_vocabulary())
    texts = ["one", ODD[2], "<|endoftext|>", "two words", None, "the end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    blocks = tokencount.token_files(docs, word_vocabulary(), END_OF_DOCUMENT, block)
    got = sorted(tuple(r) for r in tokencount.count_tokens(blocks, END_OF_DOCUMENT).select("doc_id", "n_tokens").collect())
    assert got == [(i, len(lib.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(texts)]


LONG = "This is real text of an article that goes on for long enough to be content, and for a few words more."


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f"<main><p>{LONG}<svg class='i'/></p><p>{LONG}</p><svg><title>t</title><text>drawn</text></svg><p>{LONG}</p></main>", [LONG] * 3),
        (f"<main><div><video src=a></div><p>{LONG}</p><object><p>{LONG}</p></main>", [LONG] * 2),
        (f"<main><p>{LONG} <video><p>no <b>player</video> {LONG}</p></main>", [f"{LONG} {LONG}"]),
        (f"<iframe src='x'/><main><p>{LONG}</p></main><iframe>rest {LONG}", [LONG]),
        (f"<html class='no-cookie'><body class='has-sidebar'><div><p>{LONG}</p></div></body></html>", [LONG]),
        (f"<body><main class='search'><p>{LONG}</p></main><div class='post share'><p>{LONG}</p></div><div class='share'><p>{LONG}</p></div></body>", [LONG] * 2),
    ],
)
def test_html_drops_nothing_else(page, want):
    assert htmlextract.main_text(page) == "\n\n".join(want)


def test_decontamination_leaves_columns(spark):
    item = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(1, f"clean text {item[:9]}", 999, "s", 7), (2, f"x {item} y", 998, "t", 8)], "doc_id long, text string, n_words int, hit_spans string, n_hit int")
    bench = spark.createDataFrame([(1, item)] * 50 + [(None, item), (2, None)], "item_id long, text string")
    assert [tuple(r) for r in decontaminate.decontaminate(docs, bench).collect()] == [(1, f"clean text {item[:9]}", 999, "s", 7)]
    cut = sorted(tuple(r) for r in decontaminate.decontaminate(docs, bench, mode="spans").collect())
    assert cut == [(1, f"clean text {item[:9]}", 999, "s", 7), (2, "x  y", 998, "t", 8)]
    out = decontaminate.contamination(docs, bench).where("doc_id = 2").first()
    assert (out["n_words"], out["n_hit"], out["n_items"], out["items_sha256"], out["hit_spans"]) == (22, 20, 2, decontaminate.digest(["", 1]), "t")


def test_decontamination_of_long_items(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE_BYTES", 200)
    rng = random.Random(4)
    v = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(v, k=n))) for i, n in enumerate([300, 27, 500, 3])]
    words = items[0][1].split()
    texts = [" ".join(rng.choices(v, k=80) + words[i : i + 14]) for i in range(0, 280, 7)] + [items[2][1], items[3][1]]
    docs, bench = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in decontaminate.contamination(docs, bench).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()}
    assert got == {i: contaminated_want(t, items) for i, t in enumerate(texts)}


def test_bpe_clashing_names_and_large_vocabularies(spark, tmp_path):
    import json

    docs = spark.createDataFrame([(1, "two words", 5, "x")], "doc_id long, text string, ids int, text_to_encode string")
    out = bpe.bpe_encode(docs, word_vocabulary())
    assert sorted(out.columns) == ["decoded", "doc_id", "ids", "n_tokens", "text", "text_to_encode"] and len(out.first()["ids"]) == 2
    with open(word_vocabulary()) as f:
        spec = json.load(f)
    word = next(t for t, i in spec["model"]["vocab"].items() if t == "words</w>")
    spec["model"]["vocab"][word] = 70_000
    large = tmp_path / "large.json"
    large.write_text(json.dumps(spec))
    assert 70_000 in bpe.bpe_encode(docs, str(large)).first()["ids"]
    with pytest.raises(Exception, match="16 bits"):
        tokencount.token_files(docs, str(large), END_OF_DOCUMENT).collect()


def test_equal_texts_follow_each_other(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 20)
    rows = [(i, f"copy {i % 3}" if i % 2 else f"own {i:05d}", "a", "s") for i in range(600)] + [(7, "the same row", "a", "s")] * 200
    got = sharding.hilbert_shards(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), 8).collect()
    ordered = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    runs = [x for i, x in enumerate(ordered) if i == 0 or x["text_crc32"] != ordered[i - 1]["text_crc32"]]
    assert len(ordered) == 800 and len(runs) == len({r["text_crc32"] for r in got})


def page_of(rng):
    """A page with known main text."""
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9)))
    sentence = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    title, paragraphs = sentence(5), [sentence(rng.choice([3, 12, 40, 90])) for _ in range(rng.randint(2, 7))]
    paragraphs[0] = sentence(60)
    links = "".join(f"<li><a href='/{word()}'>{word()}</a></li>" for _ in range(6))
    wrap = rng.choice([("<article>", "</article>"), ("<main>", "</main>"), ("<div class='post-body'>", "</div>")])
    ad = f"<div class='{rng.choice(['ad', 'ad-slot', 'sponsored'])}'>{sentence(8)}</div>"
    body = "".join(f"<p>{p}</p>" + (ad if rng.random() < 0.2 else "") for p in paragraphs)
    notes = f"<div class='comment-list'><p>{sentence(30)}</p></div><aside><p>{sentence(20)}</p></aside>"
    page = f"<html><head><title>{word()}</title></head><body><nav><ul>{links}</ul></nav>{ad}{wrap[0]}<h1>{title}</h1>{body}{wrap[1]}{notes}<footer>{sentence(9)}</footer></body></html>"
    return page, "\n\n".join([title, *paragraphs])


def test_extraction_of_known_pages(spark):
    rng = random.Random(17)
    known = [page_of(rng) for _ in range(150)]
    pages = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(known)] + [(-1, None), (-2, "")], "page_id long, html string")
    weights = htmlextract.fit(pages)
    got = {r["page_id"]: r["text"] for r in htmlextract.extract_text(pages, ("page_id",), weights=weights).collect()}
    assert got[-1] == got[-2] == "" and np.mean([got[i] == t for i, (_, t) in enumerate(known)]) >= 0.98
    assert htmlextract.fit(pages.limit(0)) == htmlextract.PRIOR


def test_the_cut_decides_blocks_of_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    counts = htmlextract.decided_by_cut(pages, htmlextract.fit(pages)).first()
    assert counts["blocks"] > 40_000 and counts["turned"] > 100


def test_the_cut_decides_short_paragraphs():
    page = f"<div id=x><p>{LONG}</p><p>Yes</p><p>{LONG}</p></div><div id=y><p>Yes</p></div>"
    blocks = htmlextract.read_blocks(page)
    scores, sides = htmlextract.label(blocks)
    assert scores[1] < 0 and sides == [True, True, True, False]


def test_scores_are_brute_force(spark):
    docs, labels, _ = labelled(spark)
    model = toxicity.train(docs, labels)
    for text in ["", "ab", "Zblorg is a word", "kwixmu " * 50, "été" * 20]:
        low, total, count = text.lower(), 0.0, 0
        for size in toxicity.SIZES:
            for i in range(len(low) - size + 1):
                h = 0
                for k, c in enumerate(low[i : i + size]):
                    h = (h + ord(c) * int(toxicity._A[k])) % (1 << 64)
                total += float(model.weights[(h ^ h >> 29) * int(toxicity._B) % (1 << 64) >> 64 - toxicity.BITS])
                count += 1
        assert toxicity.weigh([text], model.weights)[0] == pytest.approx(total / max(count, 1) ** 0.5, abs=1e-6)
    texts = ["", "Abc 12, x!\nx x", "same same same Ü", " a  b "]
    import pyarrow as pa

    from tiffin.llm._arrow import text_bytes

    got = quality.statistics(*text_bytes(pa.array(texts)))
    for x, t in zip(got, texts):
        raw, words = t.encode(), t.lower().split()
        share = [sum(quality._CLASS[b] == k for b in raw) / max(len(raw), 1) for k in range(10)]
        same = [sum(a == b for a, b in zip(words, words[k:])) / max(len(words), 1) for k in (1, 2, 3)]
        size = [len(w.encode()) for w in words]
        want = [*share, *np.sqrt(share), *same, same[0] ** 0.5, sum(size) / max(len(words), 1) / 10, sum(n == 1 for n in size) / max(len(words), 1)]
        assert x == pytest.approx(want)


def test_quality_learns_from_every_labelled_document(spark):
    """More bad documents than a sample would hold: the threshold leaves as many documents below as there are bad ones."""
    ids = [i for i in range(8000) if zlib.crc32(str(i).encode()) % 4 != 2]
    bad = lambda i: i % 10 != 0
    docs = spark.createDataFrame([(i, ("go! " if bad(i) else "some plain words here ") * 3 + str(i)) for i in ids], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(not bad(i))) for i in ids], "doc_id long, quality int")
    seen, fit = [], quality._fit

    def kept(rows, *args):
        seen.append(rows.groupBy("y").count().collect())
        return fit(rows, *args)

    quality._fit = kept
    try:
        model = quality.train(docs, labels)
    finally:
        quality._fit = fit
    assert {r["y"]: r["count"] for r in seen[0]} == {0: sum(map(bad, ids)), 1: sum(not bad(i) for i in ids)}
    out = quality.score_quality(docs, model).select("doc_id", "predicted").collect()
    assert all(r["predicted"] == int(not bad(r["doc_id"])) for r in out)


def test_quality_threshold_is_the_share_of_all_labels(spark):
    docs, labels, rows = labelled(spark)
    whole = quality.train(docs, labels)
    few = quality.train(docs, labels, per_class=40)
    out = quality.score_quality(docs.where("doc_id > 0"), few).select("predicted").collect()
    bad = np.mean([q == 0 for _, q, _ in rows])
    assert abs(np.mean([r[0] == 0 for r in out]) - bad) < 0.06 and whole.slope != 0


def test_one_text_of_an_id_trains(spark):
    docs = spark.createDataFrame([(1, "a")] * 500 + [(1, "b"), (6, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (6, 0)], "doc_id long, quality int")
    from tiffin.llm._learn import training_sample

    assert sorted((r["text"], r["y"]) for r in training_sample(docs, labels, "quality", 10).collect()) == [("a", 1), ("c", 0)]


def test_bpe_knows_every_code_point_as_the_library_does():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(word_vocabulary())
    own = bpe.WordBpe(Path(word_vocabulary()).read_bytes())
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"ab{chr(c)}cd " for c in points[i : i + 256]) for i in range(0, len(points), 256)]
    wrong = []
    for k in range(0, len(texts), 64):
        some = texts[k : k + 64]
        made = [np.frombuffer(x, np.uint16).tolist() for x in own.encode_batch(some)]
        wrong += [t for t, ids, e in zip(some, made, library.encode_batch(some, add_special_tokens=False)) if ids != e.ids]
    assert not wrong, [hex(ord(w[2])) for t in wrong for w in t.split(" ") if len(w) == 5][:20]


_SENTENCE = "The committee met on Tuesday to hear the plans for the coming year, and several members who had come a long way spoke. "


def _page(inner, before=""):
    return f"<html><body><nav><a href=x>Home</a> <a href=y>News</a></nav>{before}{inner}<footer>Imprint</footer></body></html>"


@pytest.mark.parametrize("name", ["share-price", "related-work", "widget-doc", "privacy", "sidebar-history", "promo-code", "adverts-of-1920", "noticeBoard"])
def test_a_class_word_does_not_lose_an_article(name):
    paragraphs = [_SENTENCE * 2 + f"Part {i}." for i in range(3)]
    got = htmlextract.main_text(_page(f"<div class='{name}'>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</div>"))
    assert got == "\n\n".join(paragraphs)
    # Beside an article of its own the same element is what its word says, however long it is.
    if name in ("privacy", "sidebar-history", "promo-code", "noticeBoard"):
        article = f"<article><h1>Title</h1><p>{_SENTENCE * 3}</p></article>"
        both = htmlextract.main_text(_page(f"<div class='{name}'><p>{_SENTENCE * 2}</p></div>", article))
        assert both == f"Title\n\n{(_SENTENCE * 3).strip()}"


@pytest.mark.parametrize("name", ["comments", "comment-list", "cookie-consent", "gdpr"])
def test_comments_and_consent_are_never_the_article(name):
    long = "".join(f"<p>{_SENTENCE * 2}</p>" for _ in range(4))
    got = htmlextract.main_text(_page(f"<div class='{name}'>{long}</div>", f"<main><p>{_SENTENCE}</p></main>"))
    assert got == _SENTENCE.strip()


def test_a_short_article_is_not_lost_to_a_long_notice():
    notice = f"<div class='notice'><p>{_SENTENCE * 3}</p></div>"
    assert htmlextract.main_text(_page(notice, f"<p>{_SENTENCE}</p>")) == _SENTENCE.strip()


def test_extraction_of_repeated_rows_and_very_long_pages(spark):
    page = _page("<article>" + "".join(f"<p>{_SENTENCE}{i}.</p>" for i in range(3000)) + "</article>")
    pages = spark.createDataFrame([(1, "u", page), (1, "u", page), (2, "v", "<p>"), (3, "w", None)], "page_id long, url string, html string")
    got = sorted((r["page_id"], r["n_chars"], len(r["text"])) for r in htmlextract.extract_text(pages, ("page_id", "url")).collect())
    size = len("\n\n".join(f"{_SENTENCE}{i}." for i in range(3000)))
    assert got == [(1, size, size), (1, size, size), (2, 0, 0), (3, 0, 0)]
