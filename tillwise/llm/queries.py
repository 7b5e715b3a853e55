"""The operators as queries over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm import (
    centroids,
    chat,
    decontaminate,
    langid,
    licenses,
    line_dedup,
    packing,
    personal,
    pieces,
    resample,
    simhash,
    spotsigs,
    toxicity,
)
from tillwise.llm.common import held_out, table


def op1_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text, and their likenesses."""
    pairs = spotsigs.edited_pairs(table(spark, sf_dir, "documents"))
    return pairs.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        spotsigs.fingerprint(F.col("signatures")).alias("fingerprint"),
        spotsigs.fingerprint(F.col("edited_signatures")).alias("edited_fingerprint"),
        spotsigs.likeness(F.col("signatures"), F.col("edited_signatures")).alias("near_edited"),
        spotsigs.likeness(F.col("signatures"), F.col("next_signatures")).alias("near_next"),
        spotsigs.length_partition(F.col("signatures")).alias("length_partition"),
        "next_doc_id",
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", held_out(5, 0))
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit(docs.where(~F.col("held_out")), labels)
    scored = toxicity.score_documents(docs, model, keep=["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op3_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: base counts, and all spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = personal.find_personal_data(docs, personal.fit(docs))
    counts = [f"n_{kind}" for kind in personal.KINDS]
    return found.select("doc_id", *counts, F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans", "n_added")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    done = simhash.near_duplicate_components(table(spark, sf_dir, "documents"))
    return done.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", held_out(4, 2))
    model = langid.fit(docs.where(~F.col("held_out")))
    return langid.identify(docs, model, keep=["doc_id", "held_out"])


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of every conversation, repaired and rendered."""
    return chat.repair(table(spark, sf_dir, "conversations"))


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of every document."""
    done = pieces.encode_documents(table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every license notice found in every document."""
    return licenses.scan_documents(table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in every document, with the distance and place of the match."""
    return decontaminate.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line counts and the digest of what line deduplication keeps of every document."""
    done = line_dedup.drop_shared_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance weight, score and place in the draw towards the benchmark's texts of every document."""
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every embedding, with the totals and the digest of its centroid."""
    assigned, found = centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))
    return centroids.with_totals(assigned, found)


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every token piece of every document in sequences of 1024 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_spotsigs": op1_spotsigs,
    "op2_toxicity": op2_toxicity,
    "op3_personal": op3_personal,
    "op4_simhash": op4_simhash,
    "op5_language": op5_language,
    "op6_chat": op6_chat,
    "op7_pieces": op7_pieces,
    "op8_licenses": op8_licenses,
    "op9_decontaminate": op9_decontaminate,
    "op10_lines": op10_lines,
    "op11_resample": op11_resample,
    "op12_centroids": op12_centroids,
    "op13_packing": op13_packing,
    "pipeline": corpus_pipeline.run,
}

_LINES = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), shared AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE shared.key IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE shared.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN shared ON keyed.key = shared.key
GROUP BY doc_id
"""

#: CRC-32 by its table of 256 steps, over the distinct words only.
_RESAMPLE = r"""
WITH crc_table AS (
  SELECT list(list_reduce(list_prepend(i, range(8)),
                          lambda c, step: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)
              ORDER BY i) AS steps
  FROM range(256) AS t(i)
), doc_words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM documents
), target_words AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM benchmark
), words AS (
  SELECT word, hex(encode(word)) AS bytes
  FROM (SELECT word FROM doc_words UNION SELECT word FROM target_words)
), bucketed AS (
  SELECT word, xor(list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(range(0, length(bytes) // 2),
             lambda pos: ('0x' || substr(bytes, 2 * pos + 1, 2))::BIGINT)),
           lambda c, byte: xor(c // 256, steps[xor(c % 256, byte) + 1])), 4294967295) % 10000 AS bucket
  FROM words, crc_table
), source AS (
  SELECT bucket, count(*) AS n FROM doc_words JOIN bucketed USING (word) GROUP BY bucket
), target AS (
  SELECT bucket, count(*) AS n FROM target_words JOIN bucketed USING (word) GROUP BY bucket
), sizes AS (
  SELECT (SELECT count(*) FROM doc_words) AS s, (SELECT count(*) FROM target_words) AS t
), gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(target.n, 0) + 1)::DOUBLE * (sizes.s + 10000)
                                 / ((source.n + 1)::DOUBLE * (sizes.t + 10000))))::BIGINT AS gain
  FROM source LEFT JOIN target USING (bucket), sizes
), weights AS (
  SELECT doc_id, count(*) AS n_features, sum(gain)::BIGINT AS weight
  FROM doc_words JOIN bucketed USING (word) JOIN gains USING (bucket)
  GROUP BY doc_id
), scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln(
           (('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
  FROM documents LEFT JOIN weights USING (doc_id)
), drawn AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank,
         count(*) OVER () * 10 // 100 AS size
  FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= size THEN rank END AS rank
FROM scored LEFT JOIN drawn USING (doc_id)
"""


def _centroids_sql(clusters: int, rounds: int, dimensions: int, scale: int, seed: str) -> str:
    """All vectors against all centroids in every round."""
    steps = [
        f"""
whole AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda c: floor({scale} * c::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE len(embedding) = {dimensions}
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
)""",
        f"""
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY digest) - 1 AS cluster, x
  FROM (SELECT x, sha256('{seed}:' || vec_id) AS digest FROM whole ORDER BY digest LIMIT {clusters})
)""",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""
a{i} AS MATERIALIZED (
  SELECT vec_id, whole.x, min(struct_pack(distance := list_sum(list_transform(list_zip(whole.x, c{i}.x),
           lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, cluster := cluster)) AS nearest
  FROM whole, c{i} GROUP BY vec_id, whole.x
)"""
        )
        if i < rounds:
            steps.append(
                f"""
m{i} AS MATERIALIZED (
  SELECT cluster, list((total - ((total % n) + n) % n) // n ORDER BY dimension)::BIGINT[] AS x
  FROM (SELECT nearest.cluster AS cluster, dimension, sum(x[dimension]) AS total, count(*) AS n
        FROM a{i}, range(1, {dimensions + 1}) AS t(dimension) GROUP BY 1, 2)
  GROUP BY cluster
), c{i + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(m{i}.x, c{i}.x) AS x FROM c{i} LEFT JOIN m{i} USING (cluster)
)"""
            )
    return (
        "WITH "
        + ",".join(steps)
        + f"""
SELECT vec_id, nearest.cluster::INTEGER AS cluster, nearest.distance AS distance,
       sum(nearest.distance) OVER (PARTITION BY nearest.cluster)::BIGINT AS cluster_inertia,
       sum(nearest.distance) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(c{rounds}.x, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON nearest.cluster = c{rounds}.cluster
"""
    )


ORACLE: dict[str, str] = {
    "op10_lines": _LINES,
    "op11_resample": _RESAMPLE,
    "op12_centroids": _centroids_sql(
        centroids.CLUSTERS, centroids.ROUNDS, centroids.DIMENSIONS, centroids.SCALE, centroids.SEED
    ),
}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
