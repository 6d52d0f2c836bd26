"""Helpers that the corpus operators share: words, let-bindings, staged tables, Arrow batches, ranks."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tickframe.session import checkpoint_dir

#: The white space that separates words: U+0020 and U+0009 to U+000D.
WHITE_SPACE = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Runs of ``[^\\x20\\x09-\\x0D]`` of a text, in order; NULL text gives an empty array."""
    spaced = F.translate(F.coalesce(text, F.lit("")), WHITE_SPACE[1:], " " * (len(WHITE_SPACE) - 1))
    return F.array_remove(F.split(spaced, " "), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also where ``body`` uses it inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fold_of(doc_id: Column, folds: int) -> Column:
    """CRC-32 of the id as decimal text, modulo ``folds``; a NULL id is in fold 0."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % folds, F.lit(0)).cast("int")


def stage_table(df: DataFrame, label: str, partition_by: str | None = None, compression: str | None = None) -> DataFrame:
    """Writes ``df`` below the shared checkpoint folder and reads it back: lineage is cut, and lost executors
    cost nothing that was finished."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tickframe-llm/{label}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    if compression:
        writer = writer.option("compression", compression)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


def by_bytes(batches: Iterable[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.Table]:
    """Regroups record batches into tables of about ``limit`` bytes of ``column`` (one row may be larger)."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        start = 0
        while start < batch.num_rows:
            rest = batch.slice(start)
            take = rows_within(rest.column(rest.schema.get_field_index(column)), limit - size)
            if take == 0 and not held:
                take = 1
            if take:
                part = rest.slice(0, take)
                held.append(part)
                size += payload(part.column(part.schema.get_field_index(column)))
                start += take
            if start < batch.num_rows or size >= limit:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def releasing(function: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """An Arrow function that gives its freed memory back at the end of a task; its worker lives on, idle."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim:
                trim(0)
    return run


def payload(column: pa.Array) -> int:
    """Bytes of the values of a string or binary array."""
    if not len(column):
        return 0
    import pyarrow.compute as pc
    return pc.sum(pc.binary_length(column)).as_py() or 0


def rows_within(column: pa.Array, limit: int) -> int:
    """Number of leading rows whose values fit into ``limit`` bytes together."""
    import pyarrow.compute as pc
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    return int(np.searchsorted(np.cumsum(sizes), limit, side="right"))


def deal(df: DataFrame, keys: list[str], order: list[str], rows_per_task: int) -> DataFrame:
    """``df`` with the columns ``_bucket``, ``_class`` and ``_part``, which split each key into groups of about ``rows_per_task``.

    Rows go to buckets by the hash of ``order``.  Rows that are equal in it stay together, so where a bucket is more than
    twice as large as it should be, its large classes of equal rows (``_class``) are dealt into parts by row numbers
    that are written down once.  Rows of a class are interchangeable, so ranks do not depend on these numbers."""
    buckets = max(1, -(-df.count() // rows_per_task))
    h = F.xxhash64(*order)
    plain = df.withColumn("_bucket", F.pmod(h, F.lit(buckets)).cast("int"))
    large = plain.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n")).filter(F.col("_n") > 2 * rows_per_task)
    large = stage_table(_renamed(large.select(*keys, "_bucket"), [*keys, "_bucket"]), "rank-large")
    if large.isEmpty():
        return plain.withColumns({"_class": F.lit(0).cast("long"), "_part": F.lit(0)})
    rows = stage_table(plain.withColumns({"_hash": h, "_row": F.monotonically_increasing_id()}), "rank-rows")
    classes = (rows.join(large, _same(rows, [*keys, "_bucket"]), "left_semi").groupBy(*keys, "_hash").agg(F.count("*").alias("_n"))
               .filter(F.col("_n") > rows_per_task).withColumn("_parts", F.ceil(F.col("_n") / rows_per_task).cast("int")))
    classes = stage_table(_renamed(classes.drop("_n"), [*keys, "_hash"]), "rank-classes")
    return (rows.join(classes, _same(rows, [*keys, "_hash"]), "left")
            .withColumns({"_class": F.when(F.col("_parts").isNotNull(), F.col("_hash")).otherwise(F.lit(0).cast("long")),
                          "_part": F.coalesce(F.pmod(F.xxhash64("_row"), F.col("_parts")), F.lit(0)).cast("int")})
            .drop("_hash", "_row", "_parts", *[f"_k_{k}" for k in [*keys, "_hash"]]))


def rank_within(df: DataFrame, keys: list[str], order: list[str], rows_per_task: int, name: str = "rank") -> DataFrame:
    """``df`` with the gapless rank (from 0) of each row within its ``keys``; ties in any order.

    A hot key is dealt into groups (``deal``): rows are numbered inside a group, and the groups' counts, one row each,
    give the offsets.  No task holds the rows of a whole key, however many rows are equal.
    """
    group = ["_bucket", "_class", "_part"]
    dealt = deal(df, keys, order, rows_per_task)
    inside = Window.partitionBy(*keys, *group)
    ranked = dealt.withColumn("_place", F.row_number().over(inside.orderBy(*order)) - 1)
    counts = dealt.groupBy(*keys, *group).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy(*group).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return (ranked.join(_renamed(offsets, [*keys, *group]), _same(ranked, [*keys, *group]), "left")
            .withColumn(name, (F.col("_place") + F.col("_before")).cast("long"))
            .drop(*group, "_place", "_before", *[f"_k_{k}" for k in [*keys, *group]]))


def _renamed(df: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` with the prefix ``_k_``, to be joined by ``_same``."""
    return df.withColumnsRenamed({c: f"_k_{c}" for c in columns})


def _same(df: DataFrame, columns: list[str]) -> Column:
    return _all([df[c].eqNullSafe(F.col(f"_k_{c}")) for c in columns])


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out
