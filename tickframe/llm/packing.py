"""Best-fit packing planned on a length histogram.

Documents become token ids and are cut into pieces of at most ``capacity`` tokens.  Best-fit decreasing then
runs over (length, count) pairs instead of pieces: bins that look alike are kept as one run of bins, so the
plan depends on the number of lengths and not on the number of documents.  It yields, for every length, spans
of ranks and the sequences and offsets they fill.  Pieces take those slots by their rank within their length,
which is computed in hash buckets, so a length that most pieces share is no hot spot.

Defined cases: NULL and empty text is the end token alone; repeated rows and rows with equal ids are packed one
by one; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import by_bytes, rank_within, releasing, stage_table
from tickframe.llm.token_counts import BLOCK_BYTES, PieceMemory, gather

CAPACITY = 4096
END_ID = 1
ROWS_PER_TASK = 200_000


def _lower(words: pa.Array) -> pa.Array:
    """The tokenizer lower-cases what is not a special token, so words without ``<`` can be before it."""
    return pc.if_else(pc.match_substring(words, "<"), words, pc.ascii_lower(words))


class WordIds:
    """Token ids of texts whose tokenizer drops white space.

    Its patterns never match across a space or line feed, so the words between them are encoded once each; Arrow
    splits the texts and numbers their distinct words, and the ids are gathered by those numbers."""

    def __init__(self, path: str):
        self.memory = PieceMemory(path, " \x01 ", _lower)

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each followed by ``end_id``; number of ids of each)."""
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        numbered = split.flatten().dictionary_encode()
        source, start, size = self.memory(numbered.dictionary)
        word = numbered.indices.to_numpy()
        upto = np.r_[0, np.cumsum(size[word])]
        own = np.diff(upto[np.r_[0, np.cumsum(split.value_lengths().to_numpy())]])
        out = np.full(upto[-1] + len(own), end_id, "<u4")
        out[np.arange(upto[-1]) + np.repeat(np.arange(len(own)), own)] = gather(source, start[word], size[word])
        return out, own + 1


def to_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(tokenizer_path)
        for block in by_bytes(batches, "text", BLOCK_BYTES):
            ids, count = words.encode(block.column("text").combine_chunks().fill_null(""), end_id)
            pieces = -(-count // capacity)
            row = np.repeat(np.arange(len(count)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(count[row] - start, capacity)
            at = 4 * ((np.cumsum(count) - count)[row] + start)
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[lo:hi]) for lo, hi in zip(at.tolist(), (at + 4 * length).tolist())]
            yield pa.RecordBatch.from_arrays([block.column("doc_id").combine_chunks().take(pa.array(row)), pa.array(piece.astype(np.int32)),
                                              pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                                             ["doc_id", "piece", "start", "length", "ids_crc32"])

    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(releasing(cut), f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long"))


def best_fit(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Spans (length, first rank, first sequence, pieces a sequence, offset) that place every counted piece.

    A span gives ranks ``first rank + k`` the sequence ``first sequence + k // pieces`` and the offset
    ``offset + k % pieces * length``; it ends where the next span of its length begins."""
    runs: dict[int, list[tuple[int, int]]] = {}  # room left: runs of sequences (first, number)
    rooms: list[int] = []
    spans, opened = [], 0

    def put(room: int, run: tuple[int, int]) -> None:
        if run[1] and room:
            if room not in runs:
                runs[room] = []
                insort(rooms, room)
            runs[room].append(run)

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, number = runs[room].pop()
                if not runs[room]:
                    del runs[room]
                    rooms.pop(at)
            else:
                room = capacity
                number = -(-left // (capacity // length))
                first, opened = opened, opened + number
            per = room // length
            full = min(number, left // per)
            spans.append((length, rank, first, per, capacity - room))
            put(room - per * length, (first, full))
            rank, left = rank + full * per, left - full * per
            if full < number:
                if left:  # the last, partly filled sequence of this span
                    put(room - left * length, (first + full, 1))
                    rank, full, left = rank + left, full + 1, 0
                put(room, (first + full, number - full))
    return np.array(sorted(spans), np.int64).reshape(-1, 5)


def place(ranked: DataFrame, spans: np.ndarray) -> DataFrame:
    """Adds (sequence_id, offset) to rows with (length, rank).

    ``spans`` is a bounded table: a few rows per length and run of alike sequences, whatever the data."""
    schema = ranked.schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name != "rank")

    def look_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = np.array([(s[0], s[1]) for s in spans.tolist()], dtype=[("length", "<i8"), ("rank", "<i8")])
        base = {v: i for i, v in reversed(list(enumerate(keys["length"].tolist())))}
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            row = np.empty(len(length), np.int64)
            for v in np.unique(length):
                lo = base[int(v)]
                hi = np.searchsorted(keys["length"], v, side="right")
                own = length == v
                row[own] = lo + np.searchsorted(keys["rank"][lo:hi], rank[own], side="right") - 1
            s = spans[row]
            k = rank - s[:, 1]
            yield pa.RecordBatch.from_arrays(
                [c for c, n in zip(batch.columns, batch.schema.names) if n != "rank"]
                + [pa.array(s[:, 2] + k // s[:, 3]), pa.array(s[:, 4] + k % s[:, 3] * length)],
                [n for n in batch.schema.names if n != "rank"] + ["sequence_id", "offset"])

    return ranked.mapInArrow(releasing(look_up), f"{fields}, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece."""
    rows = stage_table(to_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col), "pack-pieces")
    histogram = {r[0]: r[1] for r in rows.groupBy("length").count().collect()}  # at most ``capacity`` rows
    ranked = rank_within(rows, ["length"], ["doc_id", "piece", "ids_crc32"], ROWS_PER_TASK)
    return place(ranked, best_fit(histogram, capacity))
