"""A corpus pipeline of five stages: quality, line dedup, near-duplicate join, decontamination, tokenising.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each as Parquet into the shared folder
and gives the next stage what it reads back. All stages but the last return the columns of `documents`, and any others that
`docs` has, whatever their names.

Defined cases: an empty table gives an empty table. A null text counts as an empty one: it gets the quality score of
one, loses no line, is similar to nothing, is clean, and has no tokens; it stays null until the last stage. Null ids,
sources and languages are values like others; a null id comes last where the smallest stays. Rows that repeat wholly
are judged alike; the join keeps one of them if they have words, and all if they have none. Texts of any length are
taken whole.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.llm import quality as _quality
from tiffin.llm._spark import checkpoint, scratch_folder, sized
from tiffin.llm.bpe import bpe_encode
from tiffin.llm.decontaminate import decontaminate
from tiffin.llm.linededup import dedup_lines
from tiffin.llm.queries import word_vocabulary
from tiffin.llm.setjoin import similar_components


def _packed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, row): the columns other than the text go in one, so that no name of theirs clashes."""
    return docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("row"))


def _unpacked(packed: DataFrame, columns: list[str]) -> DataFrame:
    return packed.select(*(F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in columns))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model, trained on the labelled rows of the stage's input, does not reject."""
    model = _quality.train(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _unpacked(_quality.score_quality(_packed(docs), model).where("predicted = 1"), docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; n_chars follows the new text. A document that lost all its lines goes."""
    out = dedup_lines(_packed(docs)).where("n_dropped = 0 or length(text) > 0")
    return _unpacked(out, docs.columns).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of similar ones: the one with the smallest id, null ids last. Texts without words stay.

    Rows are named by a hash of id and text; of rows with the same name, the smallest stays.
    """
    keyed = _packed(docs).withColumn("_key", F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.lit("|"), "text"))
    groups = checkpoint(similar_components(keyed, width=5, threshold=0.8, id_col="_key").withColumnRenamed("doc_id", "_key"))
    named = groups.where("n_shingles > 0").groupBy("_key").agg(F.min("component_id").alias("component"), F.count("*").alias("_rows"))
    place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "_key", "_rows")
    first = keyed.select("_key", "doc_id").join(sized(checkpoint(named)), "_key").groupBy("component").agg(F.min(place).alias("first"))
    wordless = groups.where("n_shingles = 0").select("_key", F.lit(1).cast("long").alias("_rows")).distinct()
    kept = keyed.join(sized(checkpoint(first.select("first._key", "first._rows").union(wordless))), "_key")
    repeated = kept.where("_rows > 1").groupBy("_key").agg(F.min(F.struct("text", "row")).alias("one")).select("one.*")
    return _unpacked(kept.where("_rows = 1").select("text", "row").union(repeated), docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lies in benchmark windows."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's id, source and token ids, their number, and the checksums of ids and decoded text."""
    return bpe_encode(docs, word_vocabulary(), ("n_tokens", "ids", "ids_sha256", "decoded_sha256"), keep=("doc_id", "source"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_encoding", bpe_encoding),
]

#: Trained models, fuzzy lines and BPE are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), f"{scratch_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
