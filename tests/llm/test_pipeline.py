"""The pipeline: every stage judged on its own input."""

from pyspark.sql import functions as F

import corpus_pipeline as P
from tests.llm.test_dedup import sets, union_find
from tests.llm.test_text import contaminated_want

DATA = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    seen = {}
    for name, stage in P.STAGES:
        stage(spark, docs, DATA).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        seen[name] = docs
        if name != P.STAGES[-1][0]:
            assert docs.columns == columns and docs.where(F.length("text") != F.col("n_chars")).count() == 0
        if name == "ngram_jaccard_join":
            rows = before.select("doc_id", "text").orderBy("doc_id").collect()
            s = [sets(t, 5) for _, t in rows]
            root = union_find(len(s), [(i, j) for i in range(len(s)) for j in range(i) if s[i] and s[j] and 10 * len(s[i] & s[j]) >= 8 * len(s[i] | s[j])])
            first = {}
            for k, (i, _) in enumerate(rows):
                first.setdefault(root[k], i)
            assert {r[0] for r in docs.select("doc_id").collect()} == set(first.values())
        if name == "benchmark_decontamination":
            want = {i for i, t in before.select("doc_id", "text").collect() if not contaminated_want(t, items)[4]}
            assert {r[0] for r in docs.select("doc_id").collect()} == want
    counts = [seen[n].count() for n, _ in P.STAGES]
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0
    assert set(seen["bpe_encoding"].columns) == {"doc_id", "source", "n_tokens", "ids", "ids_sha256", "decoded_sha256"}


def test_copies_within_an_id(spark):
    same, other = "a b c d e f g h", "other words that stand alone here today"
    rows = [(None, same, 1), (5, same, 2), (5, same, 2), (5, other, 3), (None, "only null ids have this text now", 4), (None, "only null ids have this text now", 4), (3, "A B C D E F G H", 5), (7, "", 6), (7, "", 6), (None, None, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    got = sorted((tuple(r) for r in P.ngram_jaccard_join(spark, docs, DATA).collect()), key=repr)
    assert got == sorted([rows[3], rows[4], *rows[6:]], key=repr)


def test_stages_with_odd_rows(spark):
    """Nulls in any column, empty and long texts, repeated rows and ids, clashing names, and empty tables."""
    long = " ".join(f"word{i % 700}" for i in range(20_000))
    rows = [(None, "no id here but some text", None, None, None, 5, "k"), (1, None, "en", "s", 1, 6, "k"), (1, None, "en", "s", 1, 6, "k"), (2, "", "en", None, 0, 7, None), (3, long, "de", "s", len(long), 8, "k"), (3, long, "de", "s", len(long), 8, "k"), (4, "x\n\nx\nshort", None, "s", 11, 9, "k")]
    rows += [(i, f"document {i} has a text of its own with the numbers {i * 7} and {i * 11} in it", "en", "s", 70, i, "k") for i in range(10, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_words int, drop string")
    for name, stage in P.STAGES:
        out = stage(spark, docs, DATA)
        got = out.collect()
        if name != P.STAGES[-1][0]:
            assert out.columns == docs.columns
            assert {r["n_words"] for r in got} <= {r[5] for r in rows}
        none = stage(spark, docs.limit(0), DATA)
        assert none.collect() == [] and none.columns == out.columns
        if name == "line_dedup":
            assert {r["text"] for r in got if r["doc_id"] == 4} == {"x\n\nshort"} and sum(r["doc_id"] == 3 for r in got) == 2
        if name == "ngram_jaccard_join":
            assert sum(r["doc_id"] == 3 for r in got) == 1 and sum(r["text"] is None for r in got) == 2
        if name == "benchmark_decontamination":
            assert len(got) == len(rows)
        if name == "bpe_encoding":
            assert len(got) == len(rows) and {r["n_tokens"] for r in got if r["doc_id"] in (1, 2)} == {0}


def test_line_stage_is_brute_force(spark):
    from tests.llm.test_dedup import line_want

    docs = spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").limit(60)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    gone = line_want_short(rows, line_want)
    want = {i: "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone) for i, t in rows}
    got = {r["doc_id"]: r["text"] for r in P.line_dedup(spark, docs, DATA).collect()}
    assert got == {i: t for i, t in want.items() if t or not rows[[r[0] for r in rows].index(i)][1]}


def line_want_short(rows, line_want):
    """line_want compares shingle sets only; lines too short for one are equal or not."""
    from tiffin.llm import linededup as L

    short, gone = {}, set()
    for i, t in rows:
        for n, line in enumerate(L.split_lines(t)):
            if 0 < len(line) < L.WIDTH:
                if line in short:
                    gone.add((i, n))
                short.setdefault(line, (i, n))
    kept = [(i, "\n".join(x if len(x.strip()) >= L.WIDTH else "" for x in t.split("\n"))) for i, t in rows]
    return gone | line_want(kept)
