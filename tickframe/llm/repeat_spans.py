"""Removes every byte that lies in a 400-byte string occurring elsewhere too: buckets refined at later offsets.

Two equal strings of ``SPAN`` bytes hold the same least q-gram (``GRAM`` bytes, by hash, the leftmost of equals),
their anchor, at the same place.  So strings are told apart inside the bucket of their anchor's q-gram only:

1. ``blocks``: a map over blocks of texts.  Identifiers of 8 bytes are refined to identifiers of ``GRAM`` bytes by
   joining those of a place and of a later one, all places at once.  Each anchor stands for the run of strings
   that it is the least q-gram of; ``whole`` identifies the bytes of the run.  Equal runs in a block are settled
   at once (copies, periodic texts) and go on as one.
2. Runs are counted by (gram, whole): a run found twice is settled.  A bucket with a single run holds no repeat.
   The others go on: each run that is alone of its kind, and one of each settled kind as its possible partner.
3. Their bytes come to the task of their bucket, where strings are refined by sorting on the bucket pointers of
   later offsets: 128 bytes to 256, and these, reused, to 400.  Strings left together are repeats.  A bucket with
   more than ``HOT`` runs is dealt by whole strings instead: each string's identifier is counted with
   partial sums, so no task holds such a bucket.
4. The repeats' spans come back to their block by its number; covered bytes go.

Blocks are staged bucketed by their number, so their text is written once and never shuffled.

Buckets are named by 64 bits of hash, runs by 128 bits together, strings by ranks inside a bucket's task (hot ones
by 128 bits); equal names are taken for equal bytes.

Defined cases: a NULL text counts as empty; texts below ``SPAN`` bytes keep all; each row that repeats a text has the
result of that text, and its bytes are repeats (from ``SPAN`` bytes on); NULL and repeated ids keep their rows; an
empty table gives an empty table.  Texts of any length are one document; a block holds one text at least.
Columns besides the id and the text are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import by_bytes, mix, releasing, stage_table
from tickframe.session import checkpoint_dir

SPAN = 400
GRAM = 128
BLOCK = 4 << 20
PIECE = 1 << 22       # places whose least q-grams are searched at once
HOT = 20_000          # runs that a bucket's task takes
TASK_RUNS = 40_000    # runs a refining task takes on average
PLACE_BITS = 24       # low bits of a key: the place in its piece
MAX_BUCKETS = 100_000  # fixed value: the most that Spark allows a table
STEP_MIX = np.uint64(0xD6E8FEB86659FD93)

BLOCKS = ("block long, ids array<array<long>>, sizes array<long>, text binary, settled array<array<long>>, "
          "run array<struct<gram: long, whole: long, many: boolean, first: int, last: int>>")
RUNS = "gram long, whole long, shared boolean, hot boolean, block long, run int, first int, anchor int, bytes binary"
SPANS = "block long, start long, stop long"
FOUND = "doc_id long, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary"


# ---- identifiers --------------------------------------------------------------

def identifiers(data: np.ndarray, depth: int) -> np.ndarray:
    """For each place a hash of the ``depth`` bytes from it on (a power of two, 8 at least); the last places are void."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    held = mix(np.lib.stride_tricks.sliding_window_view(padded, 8)[:n].copy().view("<u8").ravel())
    known = 8
    while known < depth and n > known:
        held[:n - known] = mix(held[:n - known] * STEP_MIX + held[known:])
        known *= 2
    return held


def least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring keys: prefix minima of one stretch, suffix minima of the one before."""
    n = len(keys)
    stretches = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    stretches[:n] = keys
    stretches = stretches.reshape(-1, width)
    before = np.minimum.accumulate(stretches, axis=1).ravel()
    after = np.minimum.accumulate(stretches[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n - width + 1], before[width - 1:n])


def anchors(grams: np.ndarray) -> np.ndarray:
    """For each place that starts a string of ``SPAN`` bytes, the place of its anchor."""
    width = SPAN - GRAM + 1
    total = len(grams) - SPAN + 1
    out = np.empty(max(total, 0), np.int64)
    low = np.uint64((1 << PLACE_BITS) - 1)
    for start in range(0, total, PIECE):
        part = grams[start:min(start + PIECE, total) + width - 1]
        keys = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        found = least(keys, width)
        out[start:start + len(found)] = (found & low).astype(np.int64) + start
    return out


def runs(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gram, anchor, first, last) of the runs of strings with one anchor, inside texts that stop at ``ends``."""
    if len(data) < SPAN:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    grams = identifiers(data, GRAM)
    at = anchors(grams)
    place = np.arange(len(at))
    inside = np.repeat(ends, np.diff(np.concatenate([[0], ends])))[:len(at)] >= place + SPAN
    place, at = place[inside], at[inside]
    new = np.ones(len(place), bool)
    new[1:] = (at[1:] != at[:-1]) | (place[1:] != place[:-1] + 1)
    starts = np.flatnonzero(new)
    stops = np.concatenate([starts[1:], [len(place)]]) - 1 if len(starts) else starts
    return grams[at[starts]], at[starts], place[starts], place[stops]


# ---- blocks ---------------------------------------------------------------------

def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    for table in by_bytes(batches, "text", BLOCK):
        members: dict[bytes, list] = {}
        for doc_id, text in zip(table.column("doc_id").to_pylist(), table.column("text").combine_chunks().cast(pa.binary())):
            members.setdefault(text.as_buffer().to_pybytes(), []).append(doc_id)
        yield _block(number, members)
        number += 1


def _block(number: int, members: dict[bytes, list]) -> pa.RecordBatch:
    text = b"".join(members)
    sizes = np.array([len(t) for t in members], np.int64)
    ends = np.cumsum(sizes)
    gram, _, first, last = runs(np.frombuffer(text, np.uint8), ends)
    copies = np.array([len(ids) for ids in members.values()], np.int64)
    weight = copies[np.searchsorted(ends, first, side="right")]
    view = memoryview(text)
    whole = np.array([xxhash.xxh3_64_intdigest(view[a:b + SPAN]) for a, b in zip(first.tolist(), last.tolist())], np.uint64)
    kinds, kind = np.unique(np.stack([gram, whole], axis=1), axis=0, return_inverse=True) if len(gram) else (gram, first)
    kind = np.ravel(kind)
    many = np.bincount(kind, weights=weight, minlength=len(kinds)) > 1 if len(gram) else np.zeros(0, bool)
    settled = np.flatnonzero(many[kind]) if len(gram) else first
    _, once = np.unique(kind, return_index=True)
    once = np.sort(once)
    run = pa.StructArray.from_arrays(
        [pa.array(gram[once].view(np.int64)), pa.array(whole[once].view(np.int64)), pa.array(many[kind[once]] if len(gram) else many),
         pa.array(first[once].astype(np.int32)), pa.array(last[once].astype(np.int32))], ["gram", "whole", "many", "first", "last"])
    spans = [[a, b + SPAN] for a, b in _joined(first[settled], last[settled] + 1)]
    one = lambda values, kind_: pa.array([values], kind_)
    return pa.RecordBatch.from_arrays(
        [one(number, pa.int64()), one(list(members.values()), pa.list_(pa.list_(pa.int64()))), one(sizes.tolist(), pa.list_(pa.int64())),
         one(text, pa.binary()), one([[a, b - 1] for a, b in spans], pa.list_(pa.list_(pa.int64()))),
         pa.ListArray.from_arrays(pa.array([0, len(run)], pa.int32()), run)],
        ["block", "ids", "sizes", "text", "settled", "run"])


def _joined(start: np.ndarray, stop: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching [start, stop), in order."""
    if not len(start):
        return []
    order = np.argsort(start, kind="stable")
    start, stop = start[order], np.maximum.accumulate(stop[order])
    new = np.concatenate([[True], start[1:] > stop[:-1]])
    heads = np.flatnonzero(new)
    return list(zip(start[heads].tolist(), stop[np.concatenate([heads[1:], [len(start)]]) - 1].tolist()))


def stage_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The blocks as a table bucketed by their number, in the shared checkpoint folder."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    name = f"repeat_blocks_{uuid.uuid4().hex}"
    buckets = min(max(1, rows.rdd.getNumPartitions()), MAX_BUCKETS)
    (rows.mapInArrow(releasing(_blocks), BLOCKS).write.bucketBy(buckets, "block").option("compression", "zstd")
     .option("path", f"{checkpoint_dir(spark).rstrip('/')}/tickframe-llm/{name}").saveAsTable(name))
    return spark.table(name)


# ---- buckets --------------------------------------------------------------------

def judged_runs(blocks: DataFrame, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """(settled runs: block, run) and (open runs: block, run, gram, whole, shared, hot).

    Open runs share their bucket with another kind; ``shared`` ones stand for a settled kind."""
    found = blocks.select("block", F.posexplode("run").alias("run", "r")).select("block", "run", "r.gram", "r.whole", "r.many")
    kinds = found.groupBy("gram", "whole").agg(F.sum(F.when(F.col("many"), 2).otherwise(1)).alias("n"),
                                               F.min(F.struct("block", "run")).alias("one"))
    buckets = (kinds.groupBy("gram").agg(F.count("*").alias("kinds"), F.sum((F.col("n") == 1).cast("long")).alias("alone"))
               .filter("kinds > 1 AND alone > 0"))
    open_runs = (kinds.join(buckets, "gram")
                 .select("one.block", "one.run", "gram", "whole", (F.col("n") > 1).alias("shared"), (F.col("kinds") > hot).alias("hot")))
    twice = kinds.filter("n > 1").select(F.col("gram").alias("g"), F.col("whole").alias("w"))
    settled = found.filter(~F.col("many")).join(twice, (F.col("gram") == F.col("g")) & (F.col("whole") == F.col("w")), "left_semi")
    return settled.select("block", "run"), open_runs


def _bytes_of_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the asked runs of a block."""
    for batch in batches:
        for row in batch.to_pylist():
            text, held, asked = row["text"], row["run"], row["asked"]
            for start in range(0, len(asked), 4096):
                part = asked[start:start + 4096]
                first = [held[a["run"]]["first"] for a in part]
                last = [held[a["run"]]["last"] for a in part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a[c] for a in part], t) for c, t in (("gram", pa.int64()), ("whole", pa.int64()),
                                                                    ("shared", pa.bool_()), ("hot", pa.bool_()))]
                    + [pa.array([row["block"]] * len(part), pa.int64()), pa.array([a["run"] for a in part], pa.int32()),
                       pa.array(first, pa.int32()), pa.array([0] * len(part), pa.int32()),
                       pa.array([text[a:b + SPAN] for a, b in zip(first, last)], pa.binary())],
                    ["gram", "whole", "shared", "hot", "block", "run", "first", "anchor", "bytes"])


def refine(runs_of_bytes: list[bytes], gram: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(run, offset) of the strings of unshared runs that occur again among all ``runs_of_bytes``.

    Bucket pointers of 128 bytes at each place are refined, by sorting on the pointers of a place and of the one 128
    further, to 256 bytes; these again on those 144 further to 400.  Strings alone in their bucket leave."""
    sizes = np.array([len(b) for b in runs_of_bytes], np.int64)
    base = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    data = np.frombuffer(b"".join(runs_of_bytes), np.uint8)
    pointer = identifiers(data, GRAM)
    owner = np.repeat(np.arange(len(sizes)), sizes - SPAN + 1)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(sizes - SPAN + 1) - (sizes - SPAN + 1), sizes - SPAN + 1)
    place = base[owner] + offset
    tail = SPAN - 2 * GRAM
    kept = np.ones(len(place), bool)
    for shift in (0, tail):  # buckets of the first and of the last 256 bytes; strings alone in one are no repeats
        kept = _together(pointer, place + shift, kept)
    owner, offset, place = owner[kept], offset[kept], place[kept]
    double = np.empty(len(pointer), np.int64)
    both = np.unique(np.concatenate([place, place + tail]))
    double[both] = _ranks(pointer[both], pointer[both + GRAM])
    rank = _ranks(double[place], double[place + tail])
    rank = _ranks(rank, gram[owner])
    size = int(rank.max()) + 1 if len(rank) else 0
    repeated = (np.bincount(rank, minlength=size) > 1)[rank] & ~shared[owner]
    return owner[repeated], offset[repeated]


def _ranks(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Bucket numbers: equal where both identifiers are equal, in the order of a sort on them."""
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    new = np.ones(len(order), np.int64)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


def _together(pointer: np.ndarray, place: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """Of the ``kept`` strings those whose pointers at ``place`` and ``GRAM`` further occur more than once."""
    left = np.flatnonzero(kept)
    if not len(left):
        return kept
    rank = _ranks(pointer[place[left]], pointer[place[left] + GRAM])
    out = kept.copy()
    out[left] = (np.bincount(rank) > 1)[rank]
    return out


def _refine_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from releasing(_refine)(batches)


def _refine(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of a group of whole buckets."""
    table = pa.Table.from_batches(list(batches))
    gram = table.column("gram").to_numpy()
    order = np.argsort(gram, kind="stable")
    for part in _whole_buckets(gram[order]):
        rows = table.take(pa.array(order[part]))
        data = [b.as_buffer().to_pybytes() for b in rows.column("bytes").combine_chunks()]
        shared = rows.column("shared").to_numpy()
        owner, offset = refine(data, rows.column("gram").to_numpy(), shared)
        if len(owner):
            start = rows.column("first").to_numpy().astype(np.int64)[owner] + offset
            block = rows.column("block").to_numpy()[owner]
            yield _spans(block, start)


PART_RUNS = 8_000


def _whole_buckets(gram: np.ndarray) -> Iterator[slice]:
    """Slices of sorted buckets of about ``PART_RUNS`` runs each, no bucket cut."""
    if not len(gram):
        return
    edges = np.concatenate([np.flatnonzero(np.diff(gram)) + 1, [len(gram)]])
    start = 0
    while start < len(gram):
        stop = int(edges[min(np.searchsorted(edges, start + PART_RUNS), len(edges) - 1)])
        yield slice(start, stop)
        start = stop


def _spans(block: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    """Neighbouring starts of a block become one span."""
    order = np.lexsort((start, block))
    block, start = block[order], start[order]
    new = np.ones(len(block), bool)
    new[1:] = (block[1:] != block[:-1]) | (start[1:] > start[:-1] + 1)
    heads = np.flatnonzero(new)
    stops = start[np.concatenate([heads[1:], [len(start)]]) - 1] + SPAN
    return pa.RecordBatch.from_arrays([pa.array(block[heads]), pa.array(start[heads]), pa.array(stops)], ["block", "start", "stop"])


HOT_STRINGS = "gram long, name long, shared boolean, block long, start long"


def _hot_strings(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per string of a hot bucket's runs, named by a hash of its bytes."""
    for batch in batches:
        for row in batch.to_pylist():
            view = memoryview(row["bytes"])
            names = [xxhash.xxh3_64_intdigest(view[k:k + SPAN]) for k in range(len(view) - SPAN + 1)]
            n = len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["gram"]] * n, pa.int64()), pa.array(np.array(names, np.uint64).view(np.int64)),
                 pa.array([row["shared"]] * n, pa.bool_()), pa.array([row["block"]] * n, pa.int64()),
                 pa.array(np.arange(n) + row["first"], pa.int64())], ["gram", "name", "shared", "block", "start"])


def hot_spans(open_bytes: DataFrame) -> DataFrame:
    """(block, start, stop) of the repeats of hot buckets, by counting the names of their strings."""
    strings = stage_table(open_bytes.filter("hot").mapInArrow(_hot_strings, HOT_STRINGS), "repeat-hot", compression="zstd")
    twice = (strings.groupBy("gram", "name").agg(F.count("*").alias("n")).filter("n > 1")
             .select(F.col("gram").alias("g"), F.col("name").alias("m")))
    return (strings.filter("NOT shared").join(twice, (F.col("gram") == F.col("g")) & (F.col("name") == F.col("m")), "left_semi")
            .select("block", "start", (F.col("start") + SPAN).alias("stop")))


# ---- result -------------------------------------------------------------------

def _documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            view = memoryview(row["text"])
            start = [s for s, _ in row["settled"]] + [row["run"][k]["first"] for k in row["runs"] or []]
            stop = [s for _, s in row["settled"]] + [row["run"][k]["last"] + SPAN for k in row["runs"] or []]
            start += [s["start"] for s in row["found"] or []]
            stop += [s["stop"] for s in row["found"] or []]
            yield _cut(row, view, np.array(start, np.int64), np.array(stop, np.int64))


def _cut(row: dict, view: memoryview, start: np.ndarray, stop: np.ndarray) -> pa.RecordBatch:
    ends = np.cumsum(np.array(row["sizes"], np.int64))
    home = np.searchsorted(ends, start, side="right")
    order = np.argsort(home, kind="stable")
    start, stop, home = start[order], stop[order], home[order]
    edges = np.searchsorted(home, np.arange(len(ends) + 1))
    ids, sizes, spans, kept = [], [], [], []
    for k, (members, size, end) in enumerate(zip(row["ids"], row["sizes"], ends.tolist())):
        base = end - size
        cut = [(a - base, b - base) for a, b in _joined(start[edges[k]:edges[k + 1]], stop[edges[k]:edges[k + 1]])]
        rest, at = [], 0
        for a, b in cut:
            rest.append(view[base + at:base + a])
            at = b
        rest.append(view[base + at:end])
        left = b"".join(rest)
        for doc_id in members:
            ids.append(doc_id)
            sizes.append(size)
            spans.append([{"start": a, "stop": b} for a, b in cut])
            kept.append(left)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
         pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), pa.array(kept, pa.binary())],
        ["doc_id", "n_bytes", "spans", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row: the removed spans, and the bytes that are left."""
    blocks = stage_blocks(docs, id_col, text_col)
    settled, open_runs = judged_runs(blocks, hot)
    known = stage_table(settled.select("block", "run", F.lit(None).cast("long").alias("gram"), F.lit(None).cast("long").alias("whole"),
                                       F.lit(False).alias("shared"), F.lit(False).alias("hot"))
                        .unionByName(open_runs.select("block", "run", "gram", "whole", "shared", "hot")), "repeat-runs")
    asked = (known.filter("gram IS NOT NULL").groupBy("block")
             .agg(F.collect_list(F.struct("run", "gram", "whole", "shared", "hot")).alias("asked")))
    open_bytes = (blocks.select("block", "text", "run").join(asked.hint("shuffle_hash"), "block")
                  .mapInArrow(releasing(_bytes_of_runs), RUNS))
    counts = known.filter("gram IS NOT NULL").agg(F.count("*"), F.count(F.when(F.col("hot"), 1))).first()
    parts = max(1, -(-counts[0] // TASK_RUNS))
    spans = (open_bytes.filter("NOT hot").withColumn("part", F.pmod(F.xxhash64("gram"), F.lit(parts)))
             .groupBy("part").applyInArrow(_refine_part, SPANS))
    if counts[1]:
        spans = spans.unionByName(hot_spans(open_bytes))
    spans = stage_table(spans, "repeat-spans")
    found = spans.groupBy("block").agg(F.collect_list(F.struct("start", "stop")).alias("found"))
    done = known.filter("gram IS NULL").groupBy("block").agg(F.collect_list("run").alias("runs"))
    by_block = found.join(done, "block", "full_outer")
    return (blocks.join(by_block.hint("shuffle_hash"), "block", "left").select("ids", "sizes", "text", "settled", "run", "runs", "found")
            .mapInArrow(releasing(_documents), FOUND))
