"""The corpus pipeline: language ID, exact dedup, near-dedup, mixing, piece encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``, whatever these are. run() writes each
stage's result as Parquet to the shared folder and reads it again as the next
one's docs; a stage's folder goes once the next one is written, and the last is
the result. An empty table passes through as one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm.exact_dedup import exact_dedup
from waybill.llm.lang_id import fit, identify_languages, keep_identified
from waybill.llm.mixing import mixed_documents
from waybill.llm.near_dedup import near_dedup
from waybill.llm.piece_codec import encode_pieces


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the corpus's languages; those without a language go.

    ``lang`` is the label that the text model is fitted on, so it isn't evidence
    too: text and the source's prior decide. Null, empty and very short texts go;
    repeated rows are decided alike.
    """
    return keep_identified(docs, identify_languages(docs, fit(docs), declared_col=None))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with the same text, the one with the largest id; a null text counts as empty."""
    return exact_dedup(docs).filter("kept").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one with the smallest id; texts without words stay."""
    return near_dedup(docs).filter("kept").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; those without words are never taken."""
    return mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document of the mix, each copy with a segmentation of its own; a null text has none."""
    return encode_pieces(docs, vary_copies=True)


STAGES = [
    ("language ID", identify),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources", mix),
    ("SentencePiece encoding", encode),
]

#: Signatures, a fitted model and merge-dropout aren't SQL; tests/llm compares the pipeline with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, lossless of every document of the mix."""
    from waybill.llm._common import remove, shared_folder

    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            remove(spark, f"{folder}/{k - 1}")
    return docs.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "lossless")
