"""The corpus pipeline: documents to packed training sequences, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roompulse.llm import chosen_path, decontaminate, language_id, packing, suffix_dedup
from roompulse.llm.encoding import tokenizer_path
from roompulse.llm.storage import dropped, importable, named, saved, table
from roompulse.workspace import new_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _carried(docs: DataFrame) -> tuple[str, ...]:
    return tuple(c for c in docs.columns if c not in ("doc_id", "text"))


def _restored(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of documents, in their order, from those that an operator carried along."""
    return rows.select(*(named(c) if c in ("doc_id", "text") else named(f"own_{c}").alias(c) for c in docs.columns))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language identification: documents without a language (no text, no letter) go, ``lang`` becomes the prediction."""
    importable(spark)
    languages, weights = language_id.fit(docs)
    if not languages:
        return docs.where(F.col("text").rlike("\\p{L}"))
    carry = ("text", *_carried(docs))
    found = language_id.predicted(docs, languages, weights, carry=carry).where(F.col("lang_pred") != language_id.UNKNOWN)
    return found.select(*(
        F.col("doc_id") if c == "doc_id" else F.col("lang_pred").alias(c) if c == "lang" else named(f"own_{c}").alias(c)
        for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup on five-word shingles: of each group the row with the smallest id stays (NULL ids last)."""
    importable(spark)
    rows = chosen_path.near_duplicates(docs)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "text_key"))
    kept = rows.where("label is not null").groupBy("label").agg(first.alias("first")).select(
        "first.doc_id", "first.text_key", F.lit(False).alias("apart"))
    # Rows without words can be linked with nothing and stay.
    apart = rows.where("label is null").select("doc_id", "text_key").distinct().withColumn("apart", F.lit(True))
    chosen = kept.unionByName(apart).select(F.col("doc_id").alias("kept_id"), F.col("text_key").alias("kept_key"), "apart")
    # Documents go as one struct, so that their columns can have any name.
    keyed = docs.select(F.struct(*map(named, docs.columns)).alias("document"),
                        F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("key"))
    out = keyed.join(chosen, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("key") == F.col("kept_key")))
    # Rows with one id and text are one document, of which the first by its other columns stays; without words and id they may
    # be different ones.
    rank = F.row_number().over(Window.partitionBy("id", "key").orderBy(F.xxhash64(F.col("document").cast("string"))))
    return out.withColumn("rank", rank).where("rank = 1 or (apart and id is null)").select("document.*")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix-array dedup: repeated 100-byte strings are cut out; documents that nothing is left of go."""
    importable(spark)
    rows = suffix_dedup.repeats_removed(docs, carry=_carried(docs), as_text=True).where("n_bytes = 0 or kept != ''")
    rows = rows.withColumn("text", F.when(F.col("n_bytes") > 0, F.col("kept")).otherwise(F.lit("")))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("own_n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return _restored(rows, docs)


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with a window of a benchmark item go."""
    importable(spark)
    rows = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), carry=_carried(docs))
    return _restored(rows.where(F.size("items") == 0), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Harmonic packing of all that is left, into sequences of 2048 tokens."""
    importable(spark)
    return packing.packed(docs, tokenizer_path("word_bpe_49k.json"), end_id=1, with_ids=False).select(*packing.DIGEST)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", identify_language),
    ("MinHash near-dedup", drop_near_duplicates),
    ("suffix-array dedup", cut_repeats),
    ("benchmark decontamination", decontaminate_documents),
    ("packing", pack),
]
# Training, suffix sorting and tokenizing are beyond SQL; tests hold every stage, and run() as a whole, against a
# brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each one's table is committed before the next one reads it."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        folder = new_folder(spark, f"pipeline-{name.replace(' ', '-')}")
        docs = saved(stage(spark, docs, sf_dir), name, folder)
        if before is not None:
            dropped(spark, before)
        before = folder
    return STAGES[-1][1](spark, docs, sf_dir)
