"""From raw documents to encoded training text, in five stages.

Each stage is a function (spark, docs, sf_dir) of the documents its
predecessor kept; its result is written as Parquet and read again.  The
classifiers of the first two stages learn from the input's own tables
(``documents`` with their languages, ``labels``), like their queries.
"""


import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pumpline.llm import bpe, langid, mixing, quality, simhash
from pumpline.llm.common import free_name, is_fold, read_table, stored
from pumpline.llm.registry import ENCODING_VOCABULARY

ORACLE_SQL = None  # the classifiers and fingerprints have no SQL form


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters or without a clearly best language."""
    learn = read_table(spark, sf_dir, "documents").where(~is_fold(F.col("doc_id"), 4, 2))
    model = langid.fit_language_model(learn)
    out = free_name(docs, "_language")
    return langid.predict_language(docs, model, out=out).where(langid.accepted(out)).select(*docs.columns)


def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score under the keeping score."""
    labels = read_table(spark, sf_dir, "labels").where(~is_fold(F.col("doc_id"), 4, 2))
    model = quality.fit_quality(read_table(spark, sf_dir, "documents"), labels)
    out = free_name(docs, "_quality")
    return quality.score_quality(docs, model, out=out).where(F.col(out) >= quality.KEEP_SCORE).select(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates."""
    return simhash.first_of_each_group(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: documents as often as they are taken."""
    return mixing.mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids with the digests of ids and decoded text."""
    out = free_name(docs, "_bpe")
    done = bpe.encode_documents(docs, public_tokenizers.path(ENCODING_VOCABULARY), out=out)
    return done.select("doc_id", "source", *[f"{out}.{c}" for c in ("n_tokens", "ids", "ids_sha256", "decoded_sha256")])


STAGES = [
    ("language", by_language),
    ("quality", by_quality),
    ("near_duplicates", without_near_duplicates),
    ("mixing", mixed),
    ("encoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
