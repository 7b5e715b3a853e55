"""Line deduplication: lines that many documents share lose all their copies."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import columns, fresh, let, row_key

#: A key found in at least this many documents is dropped everywhere.
MIN_DOCUMENTS = 10
MIN_KEY_LENGTH = 1
#: Parts that the lines of one digest are dealt over when they meet the shared digests.
SALTS = 32
BLANKS = " \t\n\x0b\f\r"


def line_digest(line: Column) -> Column:
    """128-bit digest of a line's key (blanks stripped, A-Z lower-cased), null for short keys."""
    key = F.translate(F.btrim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase)
    return let(key, lambda k: F.when(F.length(k) >= MIN_KEY_LENGTH, F.unhex(F.md5(k))))


def drop_shared_lines(
    docs: DataFrame,
    min_documents: int = MIN_DOCUMENTS,
    names: tuple[str, str, str] = ("n_lines", "n_dropped", "kept"),
) -> DataFrame:
    """``docs`` with three more columns: n_lines, n_dropped (bigint) and kept (string).

    Lines are split at newline; null and empty texts are one empty line, which has no key and
    stays. A document is a doc_id: rows that share one count once, rows without one do not count,
    though their shared lines go too. The new columns replace columns of the same ``names``.
    Rows, repeated ones too, come back one for one; an empty table gives none.

    Each row contributes a digest once, ids are counted once per digest, and both are reduced per
    task before their shuffle. The
    dropped positions of a row come from a join of its line digests with the shared ones, salted so
    that a digest carried by a third of all lines is dealt over many tasks, and rows are put
    together by position. Texts are shuffled once.
    """
    row, at = fresh(docs, "_row"), fresh(docs, "_at")
    keyed = docs.withColumn(row, row_key(docs))
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n")
    digests = keyed.select(row, "doc_id", F.transform(lines, line_digest).alias("digests"))
    shared = (
        digests.where("doc_id is not null")
        .select("doc_id", F.explode(F.array_distinct("digests")).alias("digest"))
        .where("digest is not null")
        .distinct()
        .groupBy("digest")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_documents)
        .select("digest", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    dropped = (
        digests.select(row, F.posexplode("digests").alias(at, "digest"))
        .where("digest is not null")
        .withColumn("salt", F.pmod(F.xxhash64(row), F.lit(SALTS)).cast("int"))
        .join(shared, ["digest", "salt"], "left_semi")
        .groupBy(row)
        .agg(F.collect_set(at).alias(at))
    )
    size = F.size(lines)
    gone = F.coalesce(F.col(at), F.array().cast("array<int>"))
    # array_except is a hash set, so this stays linear in the lines of a text
    kept = let(
        lines,
        lambda x: F.array_join(
            F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), gone), lambda i: F.get(x, i)), "\n"
        ),
    )
    return (
        keyed.join(dropped, row, "left")
        .withColumns(
            {
                names[0]: size.cast("bigint"),
                names[1]: F.size(gone).cast("bigint"),
                names[2]: F.when(F.size(gone) == 0, F.coalesce("text", F.lit(""))).otherwise(kept),
            }
        )
        .drop(row, at)
    )


def deduplicate_lines(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``docs`` with ``text`` (and n_chars, if there) rewritten to the lines that stay."""
    names = tuple(fresh(docs, c) for c in ("_lines", "_dropped", "_kept"))
    done = drop_shared_lines(docs, min_documents, names)
    out = {"text": F.col(names[2])}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.length(names[2]).cast("bigint")
    return done.withColumns(out).select(*columns(docs))
