"""What the order of filters changes: every order's counts per step, from one mask per document.

1. A map over blocks of documents finds a block's distinct texts, judges them by the content filters and keeps
   their least ids.  Rows carry the number of their group (block, text); the text is staged once a group.
2. Texts are range-partitioned by adaptive prefixes: a range that weighs more than ``RANGE`` is split behind the
   prefix that all its texts share, two bytes further, until every range is light or holds one text only.
3. A task inserts the full texts of its ranges into a radix trie; terminals hold the least id.  The trie is
   traversed for (group, least id), which comes back to the rows by group: a row whose id is larger is a duplicate.
4. Rows are reduced to counts per (part, mask, labels), at most 32 masks times 4 labels a part; the orders and
   steps are read off these counts.

Only prefixes reach the driver and all tasks: one for ``RANGE`` bytes of text, as long as its texts must be told apart.

Defined cases: a NULL text counts as empty, and empty texts are equal to each other; a NULL id is neither smaller
nor larger than any, so its row is no duplicate and makes none, and it has no labels; rows that repeat an id are
no duplicates of each other; a document is good (toxic) if any label row of its id says so; a NULL part column
counts as the empty string; an empty table gives no rows.  Texts are compared whole, whatever their length.
Columns besides the id, the text and the part are not read.
"""

from __future__ import annotations

import bisect
import json
from collections.abc import Iterable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.llm.common import by_bytes, releasing, stage_table
from tickframe.llm.radix_trie import Trie, shared

BLOCK = 4 << 20
RANGE = 32 << 20    # weight of a range: what one trie takes
HEAD = 64           # bytes of a text that are staged in a column of their own, for the first rounds of the ranges
ROW_WEIGHT = 400    # bytes that a text costs in a trie beside its own
STEP = 2            # bytes that a round looks behind a shared prefix
MAX_ROUNDS = 10_000

#: The filters in natural order; all but the last judge a text by itself.
LETTERS = "ABCDE"
FEW_WORDS = 100
SYMBOLS = b"#$%&*|"
CAPITALS = bytes(range(65, 91))

GROUPED = "group_id long, doc_id long, part string, mask int, text binary, head binary, weight long, least long"


def content_mask(text: bytes) -> int:
    """Bits 0 to 3: fails A (few words), B (repeated words), C (capitals), D (symbols)."""
    words = text.split()  # ASCII white space: the space and U+0009 to U+000D
    n = len(words)
    chars = len(text.decode("utf-8", "surrogatepass"))
    capitals = len(text) - len(text.translate(None, CAPITALS))
    return ((n < FEW_WORDS) | (100 * len(set(words)) < 80 * n) << 1 | (100 * capitals > 10 * chars) << 2
            | (len(text.translate(None, SYMBOLS)) < len(text)) << 3)


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """A row per document with its group (equal texts of one block); a group's first row has text and least id."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(text_col, F.lit("")).alias("text"))
    return rows.mapInArrow(releasing(_group), GROUPED)


def _group(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 36
    for block in by_bytes(batches, "text", BLOCK):
        coded = block.column("text").combine_chunks().cast(pa.binary()).dictionary_encode()
        texts, codes = coded.dictionary, coded.indices
        ids = block.column("doc_id").combine_chunks()
        least = pa.table({"code": codes, "id": ids}).group_by("code", use_threads=False).aggregate(
            [("id", "min")]).sort_by("code").column("id_min").combine_chunks()
        masks = pa.array([content_mask(t.as_buffer().to_pybytes()) for t in texts], pa.int32())
        heads = pc.binary_slice(texts, 0, HEAD)
        weights = pc.add(pc.binary_length(texts).cast(pa.int64()), ROW_WEIGHT)
        first = _first_rows(codes)
        none = pa.scalar(None, pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pc.add(codes.cast(pa.int64()), number), ids, block.column("part").combine_chunks(), masks.take(codes),
             pc.if_else(first, texts.take(codes), none), pc.if_else(first, heads.take(codes), none), weights.take(codes),
             pc.if_else(first, least.take(codes), pa.scalar(None, pa.int64()))],
            ["group_id", "doc_id", "part", "mask", "text", "head", "weight", "least"])
        number += len(texts)


def _first_rows(codes: pa.Array) -> pa.Array:
    """Codes of a dictionary are given in order of appearance: a row is its code's first where the maximum grows."""
    code = codes.to_numpy(zero_copy_only=False)
    top = np.maximum.accumulate(code)
    return pa.array(np.concatenate([[True], top[1:] > top[:-1]]) if len(code) else np.zeros(0, bool))


# ---- ranges of texts ----------------------------------------------------------

def splits(groups: DataFrame, target: int = RANGE) -> list[bytes]:
    """Ascending byte strings at which the ranges of the groups' texts begin, the first one empty.

    A round weighs the open ranges and finds the prefix that all texts of one share, that of its least and its
    greatest text as far as ``depth`` bytes; a range whose texts agree so far is looked at deeper, until they end.
    Then it weighs the prefixes ``STEP`` bytes longer and cuts where their running sum passes the target; prefixes
    that are too heavy alone stay open.  A range is below twice the target or holds one text, and at most
    256 ** STEP + 1 prefixes belong to a range, so no task and no window grows with the data.  The driver gets
    two prefixes of each heavy range and one of each range (one for ``target`` bytes of text)."""
    starts, depths = [b""], {b"": HEAD}
    for _ in range(MAX_ROUNDS):
        deepest = max(depths.values())
        texts = groups.select(F.col("head" if deepest <= HEAD else "text").alias("text"), "weight")
        spans = (texts.mapInArrow(_extents(starts, depths), "range_id int, low binary, high binary, weight long")
                 .groupBy("range_id").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("weight").alias("weight"))
                 .filter(F.col("weight") > target).collect())
        heavy, deeper = {}, {}
        for r in spans:
            start, low, high = starts[r["range_id"]], bytes(r["low"]), bytes(r["high"])
            if low != high:
                heavy[r["range_id"]] = low[:shared(low, high, 0)]
            elif len(low) == depths[start]:
                deeper[start] = 4 * depths[start]
        depths = deeper
        if heavy:
            cuts = _cuts(texts, starts, heavy, target)
            depths |= {bytes(r["prefix"]) if r["cut"] else starts[r["range_id"]]: max(HEAD, 2 * len(r["prefix"]))
                       for r in cuts if r["alone"]}
            starts = sorted(set(starts) | {bytes(r["prefix"]) for r in cuts if r["cut"]})
        if not depths:
            return starts
    raise RuntimeError("the ranges did not settle")


def _cuts(texts: DataFrame, starts: list[bytes], heavy: dict[int, bytes], target: int) -> list:
    """The prefixes at which a heavy range is cut, and those that outweigh the target alone."""
    by_prefix = Window.partitionBy("range_id").orderBy("prefix")
    bin_of = F.floor(F.col("before") / F.lit(target))
    return (texts.mapInArrow(_prefixes(starts, heavy), "range_id int, prefix binary, weight long")
            .groupBy("range_id", "prefix").agg(F.sum("weight").alias("weight"))
            .withColumn("before", F.sum("weight").over(by_prefix.rowsBetween(Window.unboundedPreceding, -1)))
            .withColumns({"bin": F.coalesce(bin_of, F.lit(0)), "alone": F.col("weight") > target})
            .withColumn("cut", F.col("before").isNotNull() & (
                F.col("alone") | F.lag("alone").over(by_prefix) | (F.col("bin") != F.lag("bin").over(by_prefix))))
            .filter(F.col("cut") | F.col("alone")).select("range_id", "prefix", "cut", "alone").collect())


def _extents(starts: list[bytes], depths: dict[bytes, int]):
    """Per task and open range: least and greatest text, as far as the range's depth, and the weight."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for text, weight in zip(batch.column(0), batch.column(1).to_pylist()):
                t = text.as_buffer().to_pybytes()
                k = bisect.bisect_right(starts, t) - 1
                depth = depths.get(starts[k])
                if depth is None:
                    continue
                t, h = t[:depth], held.get(k)
                if h is None:
                    held[k] = [t, t, weight]
                    continue
                if t < h[0]:
                    h[0] = t
                elif t > h[1]:
                    h[1] = t
                h[2] += weight
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(held, pa.int32()), *(pa.array([h[i] for h in held.values()], t)
                                               for i, t in enumerate((pa.binary(), pa.binary(), pa.int64())))],
                ["range_id", "low", "high", "weight"])
    return run


def _prefixes(starts: list[bytes], heavy: dict[int, bytes]):
    """Per task: weight of each prefix ``STEP`` bytes longer than its heavy range's shared one."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, bytes], int] = {}
        for batch in batches:
            for text, weight in zip(batch.column(0), batch.column(1).to_pylist()):
                t = text.as_buffer().to_pybytes()
                k = bisect.bisect_right(starts, t) - 1
                if k in heavy:
                    key = (k, t[:len(heavy[k]) + STEP])
                    held[key] = held.get(key, 0) + weight
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in held], pa.int32()), pa.array([p for _, p in held], pa.binary()),
                 pa.array(held.values(), pa.int64())], ["range_id", "prefix", "weight"])
    return run


# ---- tries ----------------------------------------------------------------------

def first_ids(groups: DataFrame, target: int = RANGE) -> DataFrame:
    """(group_id, first): the least id of all rows whose text equals the group's, over the whole table."""
    texts = groups.filter(F.col("text").isNotNull())
    starts = splits(texts, target)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranges = [bisect.bisect_right(starts, t.as_buffer().to_pybytes()) - 1 for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([pa.array(ranges, pa.int32()), *batch.columns],
                                             ["range_id", "group_id", "text", "least"])

    placed = texts.select("group_id", "text", "least").mapInArrow(place, "range_id int, group_id long, text binary, least long")
    return (placed.repartitionById(len(starts), F.col("range_id"))
            .mapInArrow(releasing(_insert), "group_id long, first long"))


def _insert(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trie = Trie()
    for batch in batches:
        for group, text, least in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist()):
            trie.insert(text.as_buffer().to_pybytes(), group, least)
    ids, firsts = [], []
    for members, least in trie.terminals():
        for start in range(0, len(members), 1 << 16):
            part = members[start:start + (1 << 16)]
            ids.extend(part)
            firsts.extend([least] * len(part))
            if len(ids) >= 1 << 16:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(firsts, pa.int64())], ["group_id", "first"])
                ids, firsts = [], []
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(firsts, pa.int64())], ["group_id", "first"])


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
           target: int = RANGE) -> DataFrame:
    """(doc_id, part, mask) of every row: bit k is set where the document fails filter ``LETTERS[k]``."""
    groups = stage_table(grouped(docs, id_col, text_col, part_col), "audit-groups", compression="zstd")
    rows = groups.select("group_id", "doc_id", "part", "mask")
    late = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).cast("int")
    return (rows.join(first_ids(groups, target), "group_id", "left")
            .select("doc_id", "part", F.col("mask").bitwiseOR(late * 16).alias("mask")))


# ---- audit -----------------------------------------------------------------------

def mask_counts(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n) of ``judged`` rows; ids that repeat are counted before the labels join."""
    known = (labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("labelled"))
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    counted = rows.groupBy("doc_id", "part", "mask").agg(F.count("*").alias("n"))
    return (counted.join(known, F.col("doc_id") == F.col("labelled"), "left")
            .groupBy("part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
            .agg(F.sum("n").alias("n")))


def audit(counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, order of the filters and step, zeros included, from ``mask_counts``."""
    steps = [{"filter_order": "".join(order), "step": k + 1, "letter": letter, "bit": 1 << letters.index(letter),
              "prior": sum(1 << letters.index(x) for x in order[:k])}
             for order in permutations(letters) for k, letter in enumerate(order)]
    plan = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order string, step int, letter string, bit int, prior int>>")
    mask, n = F.col("mask"), F.col("n")
    fails, gone = mask.bitwiseAND(F.col("bit")) != 0, mask.bitwiseAND(F.col("prior")) != 0
    total = lambda where: F.coalesce(F.sum(F.when(where, n)), F.lit(0)).cast("long")
    return (counts.select("*", F.explode(plan).alias("s")).select("part", "mask", "good", "toxic", "n", "s.*")
            .groupBy("part", "filter_order", "step", "letter").agg(
                total(~fails & ~gone).alias("kept"), total(fails & ~gone).alias("removed"), total(fails & gone).alias("redundant"),
                total(mask == F.col("bit")).alias("unique_fails"), total(fails & ~gone & (F.col("good") == 1)).alias("good_lost"),
                total(fails & ~gone & (F.col("toxic") == 1)).alias("toxic_lost"))
            .withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "letter")))
            .drop("letter"))


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 part_col: str = "lang") -> DataFrame:
    """The audit of ``docs``: (part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)."""
    return audit(mask_counts(judged(docs, id_col, text_col, part_col), labels))
