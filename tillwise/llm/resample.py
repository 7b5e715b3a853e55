"""Importance resampling towards a target corpus: hashed n-grams, bucket gains, a weighted draw.

Separators collapse to single blanks, and an overlapped scan with boundary lookarounds gives the
span of every n-gram. A span's CRC is its bucket. Two corpora's bucket counts give each bucket a
gain; a document's weight is the sum of the gains of its n-grams. Adding Gumbel noise to weights
and taking the highest is a draw without replacement in proportion to exp(weight / 1000).
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.common import append_by_text, land

BUCKETS = 10_000
GRAMS = (1, 1)
MIN_WORDS = 20
PERCENT = 10
SEED = "2024"
#: Place of the number within a partition in Spark's monotonically increasing ids.
PLACE_BITS = 33

_SEPARATORS = bytes(c for c in range(128) if not chr(c).isalnum())
_CLEAN = bytes.maketrans(
    _SEPARATORS + bytes(range(ord("A"), ord("Z") + 1)),
    b" " * len(_SEPARATORS) + bytes(range(ord("a"), ord("z") + 1)),
)
_RUNS = regex.compile(rb" {2,}")


def gram_pattern(n: int) -> regex.Pattern:
    """Spans of ``n`` words between single blanks, in UTF-8 bytes; to be scanned overlapped."""
    return regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (n - 1))


def gram_counter(grams: tuple[int, int] = GRAMS, buckets: int = BUCKETS) -> Callable:
    """Per-task factory of the function from a text to (n_words, n_features, buckets, counts)."""

    def make():
        patterns = [gram_pattern(n) for n in range(grams[0], grams[1] + 1)]

        def count(text: str | None) -> tuple[int, int, list[int], list[int]]:
            line = _RUNS.sub(b" ", (text or "").encode().translate(_CLEAN)).strip(b" ")
            found = Counter()
            for pattern in patterns:
                found.update([crc32(m.group()) % buckets for m in pattern.finditer(line, overlapped=True)])
            n_words = line.count(b" ") + 1 if line else 0
            return n_words, found.total(), list(found), list(found.values())

        return count

    return make


def count_grams(docs: DataFrame, grams: tuple[int, int] = GRAMS, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, n_features bigint, buckets, counts array<int>) for every row of ``docs``.

    A null text has no words. ``buckets`` holds each bucket met once, ``counts`` how often; both are
    no longer than the text or the number of buckets.
    """
    fields = [("n_words", "bigint"), ("n_features", "bigint"), ("buckets", "array<int>"), ("counts", "array<int>")]
    return append_by_text(docs.select("doc_id", "text"), gram_counter(grams, buckets), fields, keep=["doc_id"])


def bucket_totals(counted: DataFrame) -> DataFrame:
    """(bucket, n): what all rows hold; summed in each task before the shuffle."""
    entries = counted.select(F.explode(F.arrays_zip("buckets", "counts")).alias("entry"))
    return entries.groupBy(F.col("entry.buckets").alias("bucket")).agg(F.sum("entry.counts").alias("n"))


def bucket_gains(source: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln of the ratio of the smoothed shares of target and source), one per bucket."""
    n_source, n_target = sum(source.values()), sum(target.values())
    return np.array(
        [
            math.floor(
                1000
                * math.log(
                    (target.get(b, 0) + 1.0) * (n_source + buckets) / ((source.get(b, 0) + 1.0) * (n_target + buckets))
                )
            )
            for b in range(buckets)
        ],
        np.int64,
    )


def noise(doc_id: int | None, seed: str = SEED) -> int:
    """Gumbel noise of an id in thousandths, from the first 32 bits of a digest; a null id is ''."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    share = (int.from_bytes(digest[:4], "big") + 0.5) / 4294967296
    return math.floor(-1000 * math.log(-math.log(share)))


def weigh(counted: DataFrame, gains: np.ndarray, seed: str = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score), all bigint but the id, one row for each row of ``counted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, counts = batch.column("buckets"), batch.column("counts")
            gained = gains[spans.flatten().to_numpy()] * counts.flatten().to_numpy()
            summed = np.concatenate([[0], np.cumsum(gained, dtype=np.int64)])
            ends = np.cumsum(spans.value_lengths().to_numpy(zero_copy_only=False))
            weight = summed[ends] - summed[np.concatenate([[0], ends[:-1]])] if len(ends) else ends
            score = weight + np.array([noise(i, seed) for i in batch.column("doc_id").to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "n_words", "n_features")] + [pa.array(weight), pa.array(score)],
                names=["doc_id", "n_words", "n_features", "weight", "score"],
            )

    doc_id = counted.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_id}, n_words bigint, n_features bigint, weight bigint, score bigint"
    return counted.mapInArrow(run, schema)


def resample(
    docs: DataFrame,
    target: DataFrame,
    grams: tuple[int, int] = GRAMS,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    seed: str = SEED,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank), all bigint but the id, for every row of ``docs`` (doc_id, text).

    Of the N rows with at least ``min_words`` words the floor(percent * N / 100) with the highest
    scores are drawn; ``rank`` numbers them from 1, ties to the smaller id (a null id before all
    others, rows alike in both in any order), and is null for all other rows. Features are runs of
    ``grams[0]`` to ``grams[1]`` words. Null and empty texts have no features and weight 0. Repeated
    rows count and are drawn on their own; other columns are ignored; an empty table gives no rows
    and an empty ``target`` (text) counts 0 in every bucket.

    Texts are scanned once; their bucket counts, a few bytes for each distinct bucket of a text, are
    landed and read by both the totals and the weights. Only the totals, one number for each bucket, reach
    the driver. Ranks come from rows dealt by range of the score and numbered within their range, so
    no task sees more than a range, however many rows share a score.
    """
    counted = land(count_grams(docs, grams, buckets))
    aimed = count_grams(target.select(F.lit(0).cast("bigint").alias("doc_id"), "text"), grams, buckets)
    source, wanted = ({r["bucket"]: r["n"] for r in bucket_totals(x).collect()} for x in (counted, aimed))
    scored = weigh(counted, bucket_gains(source, wanted, buckets), seed)
    return ranked(scored, F.col("n_words") >= min_words, percent).select(
        "doc_id", "n_features", "weight", "score", "rank"
    )


def ranked(scored: DataFrame, eligible: Column, percent: int) -> DataFrame:
    """``scored`` with the ``rank`` of the rows drawn: the best ``percent`` of the ``eligible`` ones."""
    rows = scored.withColumn("_out", ~eligible).withColumn("_any", F.rand(7))
    order = [F.col("_out"), F.col("score").desc(), F.col("doc_id"), F.col("_any")]
    dealt = land(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    )
    part = F.shiftrightunsigned("_id", PLACE_BITS)
    # one row a range
    ranges = dealt.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"), F.count_if(~F.col("_out")).alias("_in"))
    before = ranges.select(
        "_part",
        (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"),
        F.expr(f"sum(_in) OVER () * {int(percent)} div 100").alias("_drawn"),
    )
    place = F.col("_before") + F.col("_id").bitwiseAND((1 << PLACE_BITS) - 1) + 1
    return (
        dealt.withColumn("_part", part)
        .join(F.broadcast(before), "_part")
        .withColumn("rank", F.when(~F.col("_out") & (place <= F.col("_drawn")), place))
        .drop("_part", "_before", "_drawn", "_id", "_out", "_any")
    )
