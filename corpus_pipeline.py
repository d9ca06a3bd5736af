"""Clean a corpus in five stages: language, exact copies, near copies, mixture, pieces.

Each stage takes all documents its predecessor kept, as read back from Parquet,
and returns the columns of ``documents`` (the last one its result). Null texts
have no language and go in the first stage; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinomill.llm import exact_dedup, langid, mixing, near_copies, pieces
from kinomill.session import apply_conf, scratch_path

def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without letters go, and nothing else, whatever the number of languages.

    A missing ``lang`` is filled in. If no document states a language, none is told and all documents with letters stay.
    """
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    names = ("__lang_pred", "__score")
    told = langid.predict(docs, model, docs.columns, names)
    kept = told.where(F.col(names[0]) != langid.UNKNOWN)
    return kept.withColumn("lang", F.coalesce("lang", names[0])).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each text, by a new digest index."""
    index = exact_dedup.DigestIndex.open(spark, scratch_path(spark, "digests"))
    return exact_dedup.keep_first(docs, index)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near copies.

    Documents with SimHash fingerprints at most 4 bits apart are candidates, by pigeonhole keys; MinHash buckets add those
    further apart. All count only if their five-word shingles have a similarity of 0.8 or more.
    """
    return near_copies.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of sources takes them."""
    return mixing.repeat(docs, mixing.mix(docs))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document of the mixture in pieces."""
    return pieces.encode(docs, ["doc_id", "lang", "source"], n=3)


STAGES = [
    ("language ID", keep_language),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("SentencePiece", encode_pieces),
]

# Learned predictions and the piece lattice are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again as the next one's input."""
    apply_conf(spark)
    folder = scratch_path(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
