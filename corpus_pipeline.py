"""A training corpus from raw documents: each stage applies one operator to all that its
predecessor kept, and is written as Parquet and read again before the next.

Every stage but the last returns the columns of ``documents``:

1. ``toxicity`` drops documents scored 0.3 or more;
2. ``language_id`` drops documents in no language (no letters, or nothing learned);
3. ``simhash_dedup`` keeps, of each group of near copies (fingerprints within 2 bits, or
   five-word shingles at least 0.8 alike), the document with the smallest id;
4. ``decontamination`` drops documents with benchmark passages (one word in twenty);
5. ``packing`` turns the rest into sequences of power-of-two length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import decontaminate, langid, packing, simhash, toxicity
from ledgerloom.llm.shared import cut


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.3 by a model of the labels that are not held out.

    Null and empty texts have no toxic word, so they stay; repeated rows all stay or all
    go; without labels nothing goes."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~toxicity.held_out())
    scored = toxicity.score(docs, toxicity.train(docs, labels), carry=True)
    return scored.where(F.col("score") < toxicity.THRESHOLD).select("whole.*")


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the documents themselves are labelled with.

    Null texts and texts without letters go; if no document has a language, all go."""
    prototypes = langid.train(docs.where(~langid.held_out()))
    found = langid.predict(docs, prototypes, carry=True)
    return found.where(F.col("lang_pred") != langid.UNKNOWN).select("whole.*")


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id: see
    ``simhash.one_of_each``, which also says what becomes of nulls and repeated rows."""
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages, or with less than one word in twenty in them.

    Null and empty texts stay; an empty benchmark drops nothing; repeated rows all stay or
    all go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.scan(docs, benchmark, carry=True).where(~decontaminate.contaminated()).select("whole.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of power-of-two length of every document, with a checksum of their ids.

    A null or empty text is its end token alone; repeated rows are packed each; other
    columns are left behind; an empty table gives no piece."""
    packed = packing.pack_documents(docs)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", keep_known_languages),
    ("simhash_dedup", keep_one_of_each_group),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Models, XXH64 fingerprints and token ids have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, from ``documents``; each one's rows are written and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
