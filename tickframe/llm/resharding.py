"""Resharding by minimum-cost flow: from old shard sizes and new capacities, the transfers that move the
fewest bytes.

The flow runs on one node per old and new shard.  Its edges are byte ranges: the documents of an old shard
have a fixed order, and every document goes where the range holding its middle byte goes.  Positions come from
running sums inside small (shard, bucket) cells and from the cells' totals, so no task holds a shard.
Equal texts are neighbours in that order and stay together, except at a cut.

The transfers are carried out: rows of affected shards, those that give or receive, travel with all their columns
to the files of their new shard, and the digests of ``reshard`` are taken from what these files hold.  Shards that
keep just what they had are left alone.

Defined cases: NULL text has no bytes and the CRC-32 of nothing, 0; a NULL id is an id like any other; repeated
rows are placed one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe.llm.common import stage_table
from tickframe.session import checkpoint_dir

OVERHEAD = 8
CELL_ROWS = 2000
CELL = ["old_shard", "_range", "_group", "_part"]
FILE_BYTES = 32 << 20  # text bytes that a task writes, to the files of a shard or two
OLD_SHARDS = 16
NEW_SHARDS = 24


def min_cost_transfers(supply: dict[int, int], capacity: dict[int, int],
                       cost: Callable[[int, int], int] = lambda i, j: int(i != j)) -> dict[tuple[int, int], int]:
    """{(old, new): bytes} of least total ``cost`` a byte, by successive shortest augmenting paths.

    The capacities must hold the supply.  The graph has one node per shard, however large the data are."""
    if sum(capacity.values()) < sum(supply.values()):
        raise ValueError("the new shards cannot hold the old ones")
    flow: dict[tuple[int, int], int] = {}
    left, room = dict(supply), dict(capacity)
    while any(left.values()):
        # Bellman-Ford from all old shards with bytes left, over residual edges
        far: dict[tuple[str, int], float] = {("o", i): 0 for i, b in left.items() if b}
        came: dict[tuple[str, int], tuple[str, int]] = {}
        changed = True
        while changed:
            changed = False
            for i in supply:
                for j in capacity:
                    o, n, c = ("o", i), ("n", j), cost(i, j)
                    if o in far and far[o] + c < far.get(n, float("inf")):
                        far[n], came[n], changed = far[o] + c, o, True
                    if flow.get((i, j)) and n in far and far[n] - c < far.get(o, float("inf")):
                        far[o], came[o], changed = far[n] - c, n, True
        end = min((n for n in far if n[0] == "n" and room[n[1]]), key=lambda n: (far[n], n[1]))
        path = [end]
        while path[-1] in came:
            path.append(came[path[-1]])
        path.reverse()
        push = min(left[path[0][1]], room[end[1]], *[flow[(b[1], a[1])] for a, b in zip(path, path[1:]) if a[0] == "n"])
        for a, b in zip(path, path[1:]):
            if a[0] == "o":
                flow[(a[1], b[1])] = flow.get((a[1], b[1]), 0) + push
            else:
                flow[(b[1], a[1])] -= push
        left[path[0][1]] -= push
        room[end[1]] -= push
    return {e: b for e, b in flow.items() if b}


def even_capacities(total: int, shards: int) -> dict[int, int]:
    return {j: total // shards + (j < total % shards) for j in range(shards)}


def digests(docs: DataFrame, old_shard: Callable[[Column], Column], id_col: str, text_col: str, *more: str | Column) -> DataFrame:
    """(doc_id, size, text_crc32, old_shard) of every row, and ``more`` of its columns."""
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    crc = F.crc32(text)
    return docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
                       crc.alias("text_crc32"), old_shard(crc).cast("int").alias("old_shard"), *more)


def in_cells(base: DataFrame, hot: DataFrame, ranges: int) -> DataFrame:
    """``base`` with the columns of ``CELL``; a row's cell follows from its text and id alone."""
    return (base.join(hot, F.col("text_crc32") == F.col("_hot"), "left").withColumn("_range", F.floor(F.pmod(F.hash("text_crc32").cast("long"), F.lit(1 << 31)) * ranges / (1 << 31)).cast("int"))
            .withColumn("_group", F.coalesce("_hot", F.lit(-1).cast("long")))
            .withColumn("_part", F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("_parts")), F.lit(0)).cast("int"))
            .drop("_hot", "_parts"))


def destined(cells: DataFrame, span: DataFrame) -> DataFrame:
    """``cells``, joined with what lies before them, with each row's number in its old shard (``_row``) and the new
    shard that holds its middle byte."""
    inside = Window.partitionBy(*CELL).orderBy("text_crc32", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    return (cells.withColumn("_b", F.coalesce(F.sum("size").over(inside), F.lit(0))).withColumn("_r", F.count("*").over(inside))
            .withColumn("_middle", F.col("_b") + F.col("_b0") + F.expr("size div 2")).withColumn("_row", F.col("_r") + F.col("_r0"))
            .join(F.broadcast(span), "old_shard").filter("_middle >= _lo and _middle < _hi")
            .drop("_b", "_r", "_b0", "_r0", "_middle", "_lo", "_hi"))


def reshard(docs: DataFrame, old_shard: Callable[[Column], Column], capacities: Callable[[int], dict[int, int]],
            id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, old_shard, shard, slot) of every document, as its shard's files hold it.

    ``old_shard`` maps the CRC-32 column to today's shard number; ``capacities`` maps the total bytes to the
    bytes of each new shard.  Affected shards are written below ``path`` (a new folder; by default one below the
    checkpoint folder), one folder ``shard=N`` each, with the columns of ``docs`` and the slot; columns named shard
    and slot are replaced.  Only the shard sizes (a row per shard) reach the driver."""
    spark = docs.sparkSession
    base = stage_table(digests(docs, old_shard, id_col, text_col), "reshard-base")
    total = base.count()
    ranges = max(1, -(-total // (OLD_SHARDS * CELL_ROWS)))
    # only a text with more copies than a cell's rows is dealt over parts, behind the others of its range
    hot = stage_table(base.groupBy("text_crc32").agg(F.count("*").alias("_copies")).filter(F.col("_copies") > CELL_ROWS)
                      .select(F.col("text_crc32").alias("_hot"), F.ceil(F.col("_copies") / CELL_ROWS).alias("_parts")), "reshard-hot")
    cells = stage_table(in_cells(base, hot, ranges), "reshard-rows")
    before = Window.partitionBy("old_shard").orderBy("_range", "_group", "_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = stage_table(cells.groupBy(*CELL).agg(F.sum("size").alias("b"), F.count("*").alias("r"))
                         .select(*CELL, F.coalesce(F.sum("b").over(before), F.lit(0)).alias("_b0"), F.coalesce(F.sum("r").over(before), F.lit(0)).alias("_r0")), "reshard-cells")
    supply = {r[0]: r[1] for r in cells.groupBy("old_shard").agg(F.sum("size")).collect()}
    moves = min_cost_transfers(supply, capacities(sum(supply.values())))
    spans, at = [], {}
    for i, j in sorted(moves, key=lambda e: (e[0], e[0] != e[1], e[1])):  # what stays comes first
        lo = at.get(i, 0)
        spans.append((i, lo, lo + moves[(i, j)], j))
        at[i] = lo + moves[(i, j)]
    span = spark.createDataFrame(spans, "old_shard int, _lo long, _hi long, shard int")
    moved = stage_table(destined(cells.join(totals, CELL), span).select("doc_id", "size", "text_crc32", "old_shard", "shard", "_row"), "reshard-moved")
    first = stage_table(moved.groupBy("shard", "old_shard").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
                        .withColumn("_base", F.coalesce(F.sum("_n").over(Window.partitionBy("shard").orderBy("old_shard").rowsBetween(
                            Window.unboundedPreceding, -1)), F.lit(0))).drop("_n"), "reshard-first")
    slot = (F.col("_row") - F.col("_first") + F.col("_base")).cast("long").alias("slot")
    changed = [r[0] for r in affected_shards(moved).collect()]

    # the same numbering over the rows with all their columns: equal rows may change places, their places stay
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/tickframe-llm/reshard-shards-{uuid.uuid4().hex}"
    own = docs.drop("shard", "slot")
    whole = digests(own, old_shard, id_col, text_col, F.struct(*[own[c] for c in own.columns]).alias("_doc"))
    tasks = max(1, -(-sum(supply.values()) // FILE_BYTES))
    near = in_cells(whole.filter(F.col("old_shard").isin(changed)), hot, ranges).join(totals, CELL).repartitionByRange(tasks, *CELL)
    rows = (destined(near, span).join(F.broadcast(first), ["shard", "old_shard"]).select("_doc.*", "shard", slot))
    rows.sortWithinPartitions("shard", "slot").write.partitionBy("shard").option("compression", "zstd").parquet(path)
    schema = T.StructType([*own.schema.fields, T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType())])
    columns = ["doc_id", "size", "text_crc32", "old_shard", "shard", "slot"]
    written = digests(spark.read.schema(schema).parquet(path), old_shard, id_col, text_col, "shard", "slot").select(columns)
    stayed = moved.filter(~F.col("old_shard").isin(changed)).join(F.broadcast(first), ["shard", "old_shard"])
    return written.unionByName(stayed.withColumn("slot", slot).select(columns))


def affected_shards(placed: DataFrame) -> DataFrame:
    """New shards whose files change: those that receive from, or give to, another shard (a row per shard)."""
    crossing = placed.filter("shard <> old_shard")
    return crossing.select("shard").union(crossing.select(F.col("old_shard").alias("shard"))).distinct()


def rewrite(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Writes the affected shards of ``path`` (one folder ``shard=N`` each) anew and leaves the others alone.

    The ids must be unique, as they tie a document to its place; columns named shard and slot are replaced."""
    changed = [r[0] for r in affected_shards(placed).collect()]
    place = placed.filter(F.col("shard").isin(changed)).select(F.col("doc_id").alias("_id"), "shard", "slot")
    own = docs.drop("shard", "slot")
    rows = own.join(place, own[id_col].eqNullSafe(place["_id"])).select(*[own[c] for c in own.columns], place["shard"], place["slot"])
    (rows.repartition("shard", F.floor(F.col("slot") / 100_000)).sortWithinPartitions("shard", "slot")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(path))
