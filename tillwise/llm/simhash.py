"""SimHash fingerprints and near-duplicate components by covering locality-sensitive hashing.

Covering masks: give each of the 64 bits a nonzero 4-bit vector. For every nonzero 4-bit vector v,
table v keeps the bits whose vectors are odd against v. Three differing bits span at most three
dimensions, so some v is even against all of them: in table v the pair agrees on every kept bit.
With radius 3 the 15 tables therefore miss no pair (no false negatives, whatever the data).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import append_by_text, columns, fresh, land, row_key
from tillwise.llm.components import components

BITS = 64
RADIUS = 3
SHINGLE_WORDS = 3
SEED = 42
#: Members of a bucket compared at once; larger buckets are cut into blocks, and each pair of
#: blocks becomes a task group of its own, so no group outgrows a task.
BLOCK = 2048


def covering_masks(radius: int = RADIUS) -> list[int]:
    """Bit masks of the 2^(radius+1)-1 tables, as signed 64-bit integers."""
    vectors = 2 ** (radius + 1) - 1
    owner = [1 + bit % vectors for bit in range(BITS)]
    masks = []
    for v in range(1, vectors + 1):
        mask = sum(1 << bit for bit in range(BITS) if (owner[bit] & v).bit_count() % 2)
        masks.append(mask - (1 << BITS) if mask >> (BITS - 1) else mask)
    return masks


def simhash_maker(shingle_words: int = SHINGLE_WORDS):
    """Per task: the function from a text to its fingerprint as a signed 64-bit integer."""

    def fingerprint(text: str | None) -> tuple[int]:
        # bytes.lower and bytes.split touch exactly A-Z and [\x20\x09-\x0D]
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return (0,)
        joined = b" ".join(words)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        span = min(shingle_words, len(words)) - 1
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter(
            (
                digest(joined[s:e], SEED)
                for s, e in zip(starts[: len(words) - span].tolist(), ends[span:].tolist(), strict=True)
            ),
            dtype="<u8",
            count=len(words) - span,
        )
        counts = np.zeros(BITS, dtype=np.int64)
        for at in range(0, len(hashes), 65536):
            block = np.ascontiguousarray(hashes[at : at + 65536]).view(np.uint8).reshape(-1, 8)
            counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
        return (int(bits.view("<i8")[0]),)

    return fingerprint


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` and ``fp`` (bigint), one row per row of ``docs``.

    A fingerprint bit is set if it is set in over half of the hashes of the 3-word shingles
    (repeats count). Fewer words than a shingle: the whole sequence is one; null, empty or blank
    texts: 0.
    """
    return append_by_text(docs, simhash_maker, [("fp", "bigint")], keep=keep)


def near_links(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between the distinct values ``fp`` of ``prints`` (one row per value).

    The links span exactly the components of "differs in at most ``radius`` bits": a bucket yields
    a spanning forest of its verified links, not all pairs. Equal texts were merged before, and
    every bucket is cut into blocks by its counted size (one block for nearly all), so a bucket
    with a third of all rows is spread over many groups of at most two blocks.
    """
    masked = [
        F.struct(F.lit(t).cast("tinyint").alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
        for t, m in enumerate(covering_masks(radius))
    ]
    rows = prints.select("fp", F.explode(F.array(*masked)).alias("b")).select("fp", "b.t", "b.key")
    sizes = rows.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    cut = F.ceil(F.col("n") / block)
    members = (
        rows.join(sizes, ["t", "key"])
        .withColumn("own", F.pmod(F.xxhash64("fp"), cut))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), cut - 1)))
        .select(
            F.xxhash64("t", "key", F.least("own", "other"), F.greatest("own", "other")).alias("g"),
            "t",
            "key",
            "fp",
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for values in _groups(batches):
            found = _forest(values, radius)
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, type=pa.int64()) for x in zip(*found, strict=True)], names=["a", "b"]
                )

    return members.repartition("g").sortWithinPartitions("g", "t", "key").mapInArrow(run, "a bigint, b bigint")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The values of each run of equal (g, t, key), also across batches."""
    last, parts = None, []
    for batch in batches:
        g, t, key, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        if not len(g):
            continue
        edges = np.flatnonzero((g[1:] != g[:-1]) | (t[1:] != t[:-1]) | (key[1:] != key[:-1])) + 1
        bounds = [0, *edges.tolist(), len(g)]
        for s, e in zip(bounds, bounds[1:], strict=False):
            here = (g[s], t[s], key[s])
            if here != last:
                if parts:
                    yield np.concatenate(parts)
                last, parts = here, []
            parts.append(fp[s:e])
    if parts:
        yield np.concatenate(parts)


def _forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs within ``radius`` bits, by breadth-first search."""
    left = np.unique(values)
    if len(left) == 2:
        a, b = left.tolist()
        return [(a, b)] if ((a ^ b) & (2**64 - 1)).bit_count() <= radius else []
    found = []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count((left ^ at).view(np.uint64)) <= radius
            if near.any():
                hits = left[near]
                found += [(int(at), int(x)) for x in hits]
                queue.extend(hits)
                left = left[~near]
    return found


def near_duplicate_components(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs`` (doc_id, text).

    Rows link when their fingerprints differ in at most 3 bits; component_id is the smallest doc_id
    reachable (null only if no row reached has an id). Repeated rows are repeated in the result;
    documents without words have fingerprint 0 and link like any other; an empty table gives no
    rows; other columns are ignored.
    """
    prints = land(fingerprints(docs))
    return prints.join(_labels(prints), "fp").select("doc_id", "fp", "component_id")


def _labels(prints: DataFrame) -> DataFrame:
    """(fp, root, component_id) for every distinct fingerprint."""
    heads = land(prints.groupBy("fp").agg(F.min("doc_id").alias("head")))
    roots = components(near_links(heads)).select(F.col("node").alias("fp"), "root")
    rooted = land(heads.join(roots, "fp", "left").select("fp", "head", F.coalesce("root", "fp").alias("root")))
    lowest = rooted.groupBy("root").agg(F.min("head").alias("component_id"))
    return rooted.join(lowest, "root").select("fp", "root", "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each component of ``docs``, with all its columns.

    The row with the smallest doc_id stays; among rows sharing that id the smallest hash of its
    text decides, and of fully repeated rows one stays. Null ids come last.
    """
    row = fresh(docs, "_row")
    keyed = docs.withColumn(row, row_key(docs))
    prints = land(fingerprints(keyed, keep=("doc_id", row)))
    labels = _labels(prints.select("doc_id", "fp"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", row))
    winners = (
        prints.join(labels.select("fp", "root"), "fp").groupBy("root").agg(first.alias("w")).select(f"w.{row}")
    )
    return keyed.join(winners, row).dropDuplicates([row]).select(*columns(docs))
