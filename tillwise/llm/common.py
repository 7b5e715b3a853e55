"""Shared helpers: reading tables, landing intermediates, and per-text work in Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.sources.tables import scratch_root

#: Rows handed to Python code at a time within an Arrow batch; bounds what a task holds.
SLICE_ROWS = 128

ARROW = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<int>": pa.list_(pa.int32()),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The application's folder for intermediates, which driver and executors share."""
    return f"{scratch_root(spark)}/text"


def land(df: DataFrame) -> DataFrame:
    """``df`` as written to the shared folder: cuts lineage and survives lost executors.

    ``sources.tables.drop_intermediates`` deletes all that an application has landed.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def columns(df: DataFrame) -> list[Column]:
    """The columns of ``df``, whatever characters their names have."""
    return [F.col("`{}`".format(c.replace("`", "``"))) for c in df.columns]


def row_key(df: DataFrame) -> Column:
    """A key of (doc_id, text) without nulls: 128 bits as text.

    Equal rows share it, which every use allows for; that different rows do is out of the question
    at any number of documents.
    """
    first, second = _row_hashes(df["doc_id"], df["text"])
    return F.concat(F.hex(first), F.lit("-"), F.hex(second))


def _row_hashes(doc_id: Column, text: Column) -> tuple[Column, Column]:
    return F.xxhash64(doc_id, text), F.xxhash64(F.lit(1), text, doc_id.isNull(), doc_id)


def append_by_text(
    df: DataFrame,
    make: Callable[[], Callable[[str | None], tuple]],
    fields: Sequence[tuple[str, str]],
    text: str = "text",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Columns ``keep`` (default all) of ``df`` and new ``fields`` computed from each whole text.

    ``make`` runs once per task and returns the function from a text (or None) to a tuple of the
    new values. A field is (name, Spark type); a field named like a kept column replaces it.
    """
    names = [name for name, _ in fields]
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    schema = T.StructType([df.schema[c] for c in kept])
    for name, kind in fields:
        schema = schema.add(name, T.DataType.fromDDL(kind))
    inputs = list(dict.fromkeys([*kept, text]))
    simple = [ARROW.get(kind) for _, kind in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                rows = [function(x) for x in part.column(text).to_pylist()]
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept]
                    + [pa.array(list(c), type=t) for c, t in zip(columns, simple, strict=True)],
                    names=[*kept, *names],
                )

    return df.select(*[F.col(f"`{c}`") for c in inputs]).mapInArrow(run, schema)


def hashed_sample(rows: DataFrame, label: str, size: int) -> DataFrame:
    """(doc_id, ``label``) of the ``size`` rows of each label whose ids have the smallest hashes.

    A label's count gives a hash under which about twice that many of its rows lie; only those are
    ranked, so the task that ranks a label reads rows in proportion to ``size``, not to the table.
    """
    ids = rows.select("doc_id", label).distinct()
    counts = ids.groupBy(label).agg(F.count("*").alias("n"))  # one row per label
    place = F.xxhash64("doc_id") / F.lit(2.0**64) + F.lit(0.5)
    rank = F.row_number().over(Window.partitionBy(label).orderBy(F.xxhash64("doc_id"), "doc_id"))
    near = ids.join(F.broadcast(counts), label).where(place * F.col("n") < 2.0 * size + 100)
    return near.withColumn("n", rank).where(F.col("n") <= size).select("doc_id", label)


def held_out(modulus: int, remainder: int) -> Column:
    """Whether crc32 of the doc_id as text leaves ``remainder``; a null id is treated as ''."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus == remainder
