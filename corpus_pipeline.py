"""The corpus pipeline: five stages over `documents`, each on all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next one's
docs. All but the last return the columns of documents. Texts decide, not ids: decisions are joined back by the text's
SHA-256 where an operator returns no rows of documents, so null and repeated ids are safe. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessaline.llm import decontam, mixing, simhash, suffix, toxicity
from tessaline.llm.common import cut, drop_cut, table


#: Words of the shortest passage that the stage `repeats` cuts out.
PASSAGE_WORDS = 50


def _text_key() -> Column:
    return F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"), 256)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the labels outside the held-out fold."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class stays: that with the smallest id (of rows that repeat it, one)."""
    return simhash.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of PASSAGE_WORDS words or more that occur twice or more go, all of them. Emptied documents stay.

    The length is in words, whose number of bytes differs by language: a passage of fifty words has some 125 to 550 bytes.
    """
    columns = docs.columns
    # The operator adds columns of its own, which must not take the place of columns of that name: docs' have other names meanwhile.
    held = {c: c if c == "text" else f"__tsl_own_{k}" for k, c in enumerate(columns)}
    cut = suffix.remove_repeats(docs.toDF(*held.values()), threshold=PASSAGE_WORDS, words=True)
    text = F.when(F.col("n_removed") == 0, F.col("kept_bytes").cast("string")).otherwise(suffix.decoded(F.col("kept_bytes")))
    out = cut.withColumn("text", text)
    if "n_chars" in columns:
        out = out.withColumn(held["n_chars"], F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(held[c]).alias(c) for c in columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which windows of benchmark items make up a twentieth of the words or more go."""
    found = decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    bad = found.filter("contaminated").select(F.col("text_key").alias("__tsl_bad")).distinct()
    return docs.withColumn("__tsl_key", _text_key()).join(bad, F.col("__tsl_key") == F.col("__tsl_bad"), "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often the mix takes each document, and so how many words; a row for each, also where it takes none."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: SimHash components and the classifier have no SQL form; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stage's result written to the shared folder and read again; files go when the next are there."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        done = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
        drop_cut(docs)
        docs = done
    return docs
