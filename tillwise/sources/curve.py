"""Clustering by several columns at once: a curve through their quantile ranks.

A plain sort narrows the value ranges of its first column only. Here each column is cut into equally
deep slices, and the bits of the slice numbers are interleaved into one key. Files and row groups that
are contiguous along that key are narrow in every column, so a filter on any one of them skips most.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Bits of a slice number: 64 slices of each column.
SLICE_BITS = 6
#: Rows that the cuts are estimated from. They steer where rows are stored, never what is read.
SAMPLE_ROWS = 20_000

Cuts = Mapping[str, Sequence[Any]]


def quantile_cuts(
    df: DataFrame, columns: Sequence[str], bits: int = SLICE_BITS, sample_rows: int = SAMPLE_ROWS
) -> dict[str, list]:
    """Values that cut each column into up to 2 ** ``bits`` equally deep slices; nulls do not count.

    A value so frequent that it fills several slices is one cut only. The driver receives the cuts,
    at most 2 ** ``bits`` - 1 per column.
    """
    rows = df.select(*columns)
    n = rows.count()
    if n > sample_rows:
        rows = rows.filter(F.rand(7) < sample_rows / n)
    slices = 1 << bits

    def cuts(column: str) -> Column:
        depth = F.sort_array(F.collect_list(column))
        places = F.sequence(F.lit(1), F.lit(slices - 1))
        picked = F.transform(places, lambda i: F.get(depth, F.floor(i * F.size(depth) / slices).cast("int")))
        return F.array_distinct(F.array_compact(picked)).alias(column)

    return {column: list(values) for column, values in rows.agg(*map(cuts, columns)).first().asDict().items()}


def _spread(number: int, place: int, columns: int, bits: int) -> int:
    """The bits of ``number``, each at this column's place in its group of ``columns`` bits."""
    return sum((number >> bit & 1) << (bit * columns + columns - 1 - place) for bit in range(bits))


def curve_key(cuts: Cuts, bits: int = SLICE_BITS) -> Column:
    """Place of a row on the curve, as bigint; nulls are in the first slice.

    A column's slice is found by a balanced tree of comparisons whose leaves hold the interleaved bits,
    so a row costs ``bits`` comparisons per column, in generated code.
    """
    if len(cuts) * bits > 62:
        raise ValueError("too many columns or bits for one key")
    key = F.lit(0).cast("bigint")
    for place, (column, values) in enumerate(cuts.items()):
        value = F.col(column)

        def tree(low: int, high: int) -> Column:
            if low == high:
                # few distinct values are spread over all slices, so that they count in the high bits
                number = (low << bits) // (len(values) + 1)
                return F.lit(_spread(number, place, len(cuts), bits)).cast("bigint")
            middle = (low + high) // 2
            return F.when(value < F.lit(values[middle]), tree(low, middle)).otherwise(tree(middle + 1, high))

        key = key.bitwiseOR(F.when(value.isNull(), F.lit(0).cast("bigint")).otherwise(tree(0, len(values))))
    return key


def write_clustered(
    df: DataFrame,
    path: str,
    cluster_by: Sequence[str],
    partition_by: str | None = None,
    bits: int = SLICE_BITS,
    row_group_bytes: int | None = None,
) -> DataFrame:
    """Overwrite ``path`` with Parquet laid out along the curve of ``cluster_by``; read it back.

    Rows are dealt by range of (partition date, curve key, digest of the row), so a file holds one
    stretch of the curve, a heavy date is many files, and a key that many rows share is split too.
    ``row_group_bytes`` sets the size of row groups, the unit that readers skip.
    """
    cuts = quantile_cuts(df, cluster_by, bits)
    hashable = [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    keyed = df.withColumns({"_curve": curve_key(cuts, bits), "_digest": F.xxhash64(*[F.col(f"`{c}`") for c in hashable])})
    dates = [partition_by] if partition_by else []
    laid_out = keyed.repartitionByRange(*dates, "_curve", "_digest").sortWithinPartitions(*dates, "_curve", *cluster_by)
    writer = laid_out.drop("_curve", "_digest").write.mode("overwrite")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "static").partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
