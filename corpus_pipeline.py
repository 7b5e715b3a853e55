"""From raw documents to token ids: five stages, each one a whole pass over what the last one kept.

The last stage returns counts and digests of the ids; ``pieces.encode_documents`` returns the ids
themselves. Any stage takes nulls in any column, empty and very long texts, ties, repeated rows and empty
tables, and passes columns it does not know on as they are, but for the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm import decontaminate, langid, line_dedup, pieces, simhash
from tillwise.llm.common import held_out, land, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter (null and empty texts too) or without a clear language go; repeated rows go
    or stay together. No labelled documents: all go, as nothing was learned."""
    return langid.keep_identified(docs, langid.fit(docs.where(~held_out(4, 2))))


def deduplicate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten or more documents share go; every row stays, if only with an empty text. Null texts become
    empty. Repeated rows count as one document, rows without an id count for none."""
    return line_dedup.deduplicate_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component stays, the one with the smallest doc_id; null ids come last, ties go to
    the smaller hash of the row. Of all texts without words one stays, and of fully repeated rows one."""
    return simhash.drop_near_duplicates(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item within its edit budget go. Null and empty texts contain none and
    stay; repeated rows go or stay together; items under 12 characters count as whole texts only; an empty
    benchmark drops nothing."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Count and digest of the token ids of every row that is left, and the digest of what they decode to. Null
    and empty texts are the two end ids and decode to an empty text."""
    done = pieces.encode_documents(docs)
    return done.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language", identify_language),
    ("lines", deduplicate_lines),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", decontaminate_benchmark),
    ("pieces", encode_pieces),
]

#: SQL has no SimHash components, n-gram classifier or piece segmentation; tests compare with
#: brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = land(docs)
    return docs
