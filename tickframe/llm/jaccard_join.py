"""Exact Jaccard join of documents' word n-gram sets, with skipping by set relations.

A document's set holds its distinct shingles of ``width`` words (fewer words: the whole sequence).  Two
documents link when the Jaccard similarity of their sets reaches a threshold; the result gives the connected
component of every document.  The steps:

1. One pass over the texts emits, per set, a signature and the postings of its prefix: the rarest shingles, of
   which two linked sets must share one.  Any global order is exact; frequent shingles, known from a sample,
   come last, so common passages stay out of the prefixes.  Postings travel as packed arrays per shard, and
   equal sets have equal postings, which collapse.
2. Each shard keeps the index lists of two or more sets.  Entries carry their position, and a pair is a
   candidate only if the shingles after both positions and the sizes allow the threshold.
3. First answers: every list gives a number of pairs linear in its length: each entry with the list's first one,
   then neighbours in two random orders that are not yet of one class.  These are verified and joined to classes.
4. The other answers are derived: a set of a class shares the class's answers, so pairs within a class are
   skipped.  Lists are cut into blocks by class and position; a pair of blocks is skipped when it has one class
   only or when no position and size in it can reach the threshold.  What is left is verified and joined.

Verification first bounds the overlap by parity bitmaps (the symmetric difference is at least the number of
differing parity bits) and then intersects the sets, which are computed anew for the few documents concerned.
Lists of a very frequent shingle are dealt as pairs of chunks, so no task holds such a list whole.

Defined cases: NULL, empty and white-space texts have an empty set, link with nothing and are their own
component; repeated rows are one class; a NULL id counts as no id when a component takes its smallest id;
an empty table gives an empty result; extra columns are ignored.  Sets and shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import by_bytes, mix, releasing, stage_table
from tickframe.llm.components import components

WIDTH = 5
THRESHOLD = (75, 100)
BLOCK_BYTES = 4 << 20
KEPT_WORDS = 250_000
ORDER_SAMPLE_DOCS = 20_000
ORDER_LIST = 1 << 18
POSTINGS_PER_TASK = 2_000_000
CHUNK = 4096
BLOCK = 64
BITS = 1024
BLOOM_BITS = 1 << 23
PAIRS_AT_ONCE = 1 << 20
BITS_AT_ONCE = 1 << 16
#: Added to the side of entries of lists longer than BLOCK.
LONG = 4


class Shingler:
    """Sorted distinct 64-bit shingle hashes of texts; A-Z is lower-cased, words split at ASCII white space."""

    def __init__(self, width: int = WIDTH):
        self.width = width
        self.known: dict[bytes, int] = {}

    def word_hashes(self, text: str) -> np.ndarray:
        from xxhash import xxh3_64_intdigest
        words = text.encode().lower().split()  # bytes: lower() and split() know ASCII only
        known = self.known
        if len(known) > KEPT_WORDS:
            known.clear()
        try:
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            known.update([(w, xxh3_64_intdigest(w)) for w in words if w not in known])
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.uint64)
        w = self.word_hashes(text)
        if not len(w):
            return w
        width = min(self.width, len(w))
        h = np.full(len(w) - width + 1, width, np.uint64)
        for k in range(width):
            h = mix(h + w[k:len(w) - width + 1 + k])
        return np.unique(h)


def signature(s: np.ndarray) -> int:
    from xxhash import xxh3_64_intdigest
    return int(np.uint64(xxh3_64_intdigest(s.tobytes())).view(np.int64))


def parity(s: np.ndarray) -> bytes:
    """Whether the number of elements in each of at least ``len(s)`` hash classes is odd, a bit a class."""
    size = max(BITS, 1 << (len(s) - 1).bit_length())
    counts = np.bincount((s & np.uint64(size - 1)).astype(np.int64), minlength=size)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def folded(bits: bytes, size: int) -> np.ndarray:
    """A parity bitmap as words, with pairs of classes joined until it has ``size`` bits."""
    words = np.frombuffer(bits, np.uint64)
    while len(words) * 64 > size:
        words = words[:len(words) // 2] ^ words[len(words) // 2:]
    return words


def prefix_length(n, threshold=THRESHOLD):
    """Shingles of a set of size n >= 1 of which a linked set of any size has at least one."""
    return n - -(-threshold[0] * n // threshold[1]) + 1


def needed(total, threshold=THRESHOLD):
    """Least overlap of two linked sets with ``total`` elements counted in both."""
    return -(-threshold[0] * total // (threshold[0] + threshold[1]))


def may_link(n1, rest1, n2, rest2, threshold=THRESHOLD):
    """Whether sizes, and the elements from the shared one to each end, allow a link."""
    sizes = threshold[0] * np.maximum(n1, n2) <= threshold[1] * np.minimum(n1, n2)
    return sizes & (np.minimum(rest1, rest2) >= needed(n1 + n2, threshold))


class Order:
    """The global order: frequent shingles of the sample last, by frequency; the rest by hash."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, scale: float, chunk: int):
        by = np.argsort(keys)
        self.keys, self.counts = keys[by], counts[by]
        self.chunks = np.maximum(1, np.ceil(self.counts * scale / chunk)).astype(np.int64)

    def prefix(self, s: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        """The first ``count`` shingles in the order, and the chunks their lists are dealt in."""
        if not len(self.keys):
            return s[:count], np.ones(count, np.int64)
        at = np.minimum(np.searchsorted(self.keys, s), len(self.keys) - 1)
        hot = self.keys[at] == s
        cold = s[~hot][:count]
        if len(cold) == count:
            return cold, np.ones(count, np.int64)
        at = at[hot]
        at = at[np.lexsort((self.keys[at], self.counts[at]))][:count - len(cold)]
        return np.concatenate([cold, self.keys[at]]), np.concatenate([np.ones(len(cold), np.int64), self.chunks[at]])


def pack_postings(keys, sigs, sizes, pos, side, shard) -> Iterator[tuple[int, bytes]]:
    """(shard, packed postings); within a shard, postings stay grouped by set."""
    by = np.argsort(shard, kind="stable")
    keys, sigs, sizes, pos, side, shard = (x[by] for x in (keys, sigs, sizes, pos, side, shard))
    cuts = np.flatnonzero(np.diff(shard)) + 1
    for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(keys)]):
        runs = np.r_[lo, lo + 1 + np.flatnonzero(np.diff(sigs[lo:hi])), hi]
        head = np.array([hi - lo, len(runs) - 1], np.int64)
        yield int(shard[lo]), b"".join([
            head.tobytes(), sigs[runs[:-1]].tobytes(), sizes[runs[:-1]].astype(np.uint32).tobytes(),
            np.diff(runs).astype(np.uint32).tobytes(), keys[lo:hi].tobytes(), pos[lo:hi].astype(np.uint32).tobytes(),
            side[lo:hi].astype(np.uint8).tobytes()])


def unpack_postings(blob: bytes) -> tuple[np.ndarray, ...]:
    m, r = np.frombuffer(blob, np.int64, 2).tolist()
    at = 16

    def take(kind, count):
        nonlocal at
        out = np.frombuffer(blob, kind, count, at)
        at += out.nbytes
        return out

    sig, size, run = take(np.int64, r), take(np.uint32, r), take(np.uint32, r)
    key, pos, side = take(np.uint64, m), take(np.uint32, m), take(np.uint8, m)
    return key, np.repeat(sig, run), np.repeat(size, run).astype(np.int64), pos.astype(np.int64), side


def spread_lists(keys: np.ndarray, chunks: np.ndarray, rows: np.ndarray, sig: np.ndarray):
    """Lists of several chunks: an entry of chunk a goes to the lists of all pairs (a, b).

    Returns (list key, row, side); entries of one side only pair with those of the other, side 2 with all."""
    one = chunks == 1
    key, row, side = [keys[one]], [rows[one]], [np.full(one.sum(), 2, np.uint8)]
    for k in np.flatnonzero(~one):
        c = int(chunks[k])
        a = int(mix(np.uint64(sig[k]) + keys[k:k + 1])[0] % np.uint64(c))
        b = np.arange(c, dtype=np.uint64)
        lo, hi = np.minimum(b, np.uint64(a)), np.maximum(b, np.uint64(a))
        key.append(mix(mix(keys[k] + lo) + hi))
        row.append(np.full(c, rows[k]))
        side.append(np.where(b == a, 2, np.where(b > a, 0, 1)).astype(np.uint8))
    return np.concatenate(key), np.concatenate(row), np.concatenate(side)


def star_pairs(key, sig, n, pos, side, threshold) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of each list's entries with its first one, by signature (so the lists of a group agree on it)."""
    by = np.lexsort((sig, key))
    k = key[by]
    first = np.maximum.accumulate(np.where(np.r_[True, k[1:] != k[:-1]], np.arange(len(k)), 0))
    here = np.flatnonzero(first != np.arange(len(k)))
    return _unique_pairs(*_filtered(by[first[here]], by[here], sig, n, pos, side, threshold))


def neighbour_pairs(key, sig, n, pos, side, label, threshold) -> tuple[np.ndarray, np.ndarray]:
    """Of each list, the neighbours in two random orders that are of different classes."""
    found = []
    for salt in (1, 2):
        by = np.lexsort((mix(sig.view(np.uint64) + np.uint64(salt)), key))
        here = np.flatnonzero(key[by][1:] == key[by][:-1]) + 1
        found.append(_filtered(by[here - 1], by[here], sig, n, pos, side, threshold, label))
    return _unique_pairs(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))


def _filtered(i, j, sig, n, pos, side, threshold, label=None, bits=None):
    """(smaller signature, larger) of the pairs of entries i, j that may link and are of different classes."""
    ok = may_link(n[i], n[i] - pos[i], n[j], n[j] - pos[j], threshold) & ((side[i] != side[j]) | (side[i] == 2))
    ok &= sig[i] != sig[j]
    if label is not None:
        ok &= label[i] != label[j]
    i, j = i[ok], j[ok]
    if bits is not None:
        close = np.ones(len(i), bool)
        for lo in range(0, len(i), BITS_AT_ONCE):
            x, y = i[lo:lo + BITS_AT_ONCE], j[lo:lo + BITS_AT_ONCE]
            close[lo:lo + BITS_AT_ONCE] = within_bits(n[x], bits[x], n[y], bits[y], threshold)
        i, j = i[close], j[close]
    return np.minimum(sig[i], sig[j]), np.maximum(sig[i], sig[j])


def within_bits(n1, bits1, n2, bits2, threshold):
    """Whether parity bitmaps allow a link: every differing bit is an element of one set only."""
    return enough(n1, n2, np.bitwise_count(bits1 ^ bits2).sum(axis=1, dtype=np.int64), threshold)


def enough(n1, n2, apart, threshold):
    """Whether sets with at least ``apart`` elements in one of them only may link."""
    return (n1 + n2 - apart) // 2 >= needed(n1 + n2, threshold)


def _unique_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    by = np.lexsort((b, a))
    a, b = a[by], b[by]
    keep = np.ones(len(a), bool)
    keep[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[keep], b[keep]


def cross_pairs(key, sig, n, pos, side, label, bits, threshold) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All candidate pairs of each list whose entries differ in ``label``, in bounded portions.

    Short lists are paired in full, long ones block by block and with a look at the parity bitmaps ``bits``
    (a row per entry; only those of long lists are filled)."""
    by = np.lexsort((pos, label, key))
    key, sig, n, pos, side, label = (x[by] for x in (key, sig, n, pos, side, label))
    bits = bits[by]
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
    length = np.diff(np.r_[start, len(key)])
    for size in np.unique(length[(length > 1) & (length <= BLOCK)]):
        i, j = np.triu_indices(size, 1)
        lists = start[length == size]
        step = max(1, PAIRS_AT_ONCE // len(i))
        for k in range(0, len(lists), step):
            at = lists[k:k + step, None]
            yield _unique_pairs(*_filtered((at + i).ravel(), (at + j).ravel(), sig, n, pos, side, threshold, label))
    for lo, size in zip(start[length > BLOCK], length[length > BLOCK]):
        edge = np.arange(lo, lo + size, BLOCK)
        end = np.r_[edge[1:], lo + size]
        one = label[edge] == label[end - 1]  # sorted by label: a block of one class
        small, large = np.minimum.reduceat(n[lo:lo + size], edge - lo), np.maximum.reduceat(n[lo:lo + size], edge - lo)
        rest = np.maximum.reduceat((n - pos)[lo:lo + size], edge - lo)
        for a in range(len(edge)):
            b = np.arange(a, len(edge))
            skip = one[a] & one[b] & (label[edge[a]] == label[edge[b]])
            sizes = (threshold[0] * small[a] <= threshold[1] * large[b]) & (threshold[0] * small[b] <= threshold[1] * large[a])
            reach = np.minimum(rest[a], rest[b]) >= needed(small[a] + small[b], threshold)
            live = b[~skip & sizes & reach]
            step = max(1, PAIRS_AT_ONCE // BLOCK ** 2)
            for k in range(0, len(live), step):
                j = np.concatenate([np.arange(edge[x], end[x]) for x in live[k:k + step]])
                i = np.arange(edge[a], end[a])
                ii, jj = np.repeat(i, len(j)), np.tile(j, len(i))
                keep = ii < jj
                yield _unique_pairs(*_filtered(ii[keep], jj[keep], sig, n, pos, side, threshold, label, bits))


def _sample_order(texts: DataFrame, total: int, width: int, threshold, chunk: int, sample_docs: int) -> tuple[Order, float]:
    """The order and the mean prefix length, from about ``sample_docs`` documents.

    They steer the cost alone: every order gives the same links."""
    share = min(1.0, sample_docs / max(total, 1))
    sample = texts.select("text").sample(share, 11) if share < 1 else texts.select("text")

    def tally(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for block in by_bytes(batches, "text", BLOCK_BYTES):
            sets = [shingler(t) for t in block.column("text").to_pylist()]
            k, c = np.unique(np.concatenate(sets), return_counts=True)
            again = c > 1  # a shingle of one document of a block still counts through its hash class below
            prefix = sum(int(prefix_length(len(s), threshold)) for s in sets if len(s))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.r_[k[again].view(np.int64), k[~again].view(np.int64), 0]), pa.array(np.r_[c[again], c[~again], 0]),
                pa.array(np.r_[np.zeros(len(k), np.int64), prefix]), pa.array(np.r_[np.zeros(len(k), np.int64), len(sets)])],
                ["key", "n", "prefix", "docs"])

    counted = stage_table(sample.mapInArrow(releasing(tally), "key long, n long, prefix long, docs long")
                          .groupBy("key").agg(F.sum("n").alias("n"), F.sum("prefix").alias("prefix"), F.sum("docs").alias("docs"))
                          .filter("n >= 3 or docs > 0"), "jaccard-order")
    prefix, docs = counted.agg(F.sum("prefix"), F.sum("docs")).first()
    top = counted.filter("n >= 3").orderBy(F.desc("n"), "key").limit(ORDER_LIST).select("key", "n").toPandas()
    order = Order(top["key"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64), 1 / share, chunk)
    return order, (prefix or 0) / max(docs or 0, 1)


def _index(docs: DataFrame, order: Order, shards: int, width: int, threshold) -> DataFrame:
    """Rows of three kinds: 0 documents (doc_id, n, sig, bits), 1 live postings (key, sig, n, pos, side) and
    2 first candidate pairs (key, sig)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    arrow_id = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[id_type]

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for block in by_bytes(batches, "text", BLOCK_BYTES):
            sets = [shingler(t) for t in block.column("text").to_pylist()]
            sigs = [signature(s) if len(s) else None for s in sets]
            sizes = np.array([len(s) for s in sets], np.int64)
            seen: dict[int, int] = {}
            own = [k for k, s in enumerate(sigs) if s is not None and seen.setdefault(s, k) == k]
            packed: list[tuple[int, bytes]] = []
            if own:
                parts = [order.prefix(sets[k], int(prefix_length(len(sets[k]), threshold))) for k in own]
                count = [len(p[0]) for p in parts]
                keys = np.concatenate([p[0] for p in parts])
                chunks = np.concatenate([p[1] for p in parts])
                sig = np.repeat(np.array([sigs[k] for k in own], np.int64), count)
                size = np.repeat(sizes[own], count)
                pos = np.concatenate([np.arange(c) for c in count])
                key, row, side = spread_lists(keys, chunks, np.arange(len(keys)), sig)
                back = np.argsort(row, kind="stable")  # by set again
                key, row, side = key[back], row[back], side[back]
                packed = list(pack_postings(key, sig[row], size[row], pos[row], side, (mix(key) % np.uint64(shards)).astype(np.int64)))
            d, p = len(sets), len(packed)
            home = [(s or 0) % shards for s in sigs]
            yield pa.RecordBatch.from_arrays([
                pa.array([*home, *(x[0] for x in packed)], pa.int32()),
                pa.concat_arrays([block.column("doc_id").combine_chunks().cast(arrow_id), pa.nulls(p, arrow_id)]),
                pa.concat_arrays([pa.array(sizes), pa.nulls(p, pa.int64())]),
                pa.array([*sigs, *[None] * p], pa.int64()),
                pa.array([*(parity(s) if len(s) else None for s in sets), *[None] * p], pa.binary()),
                pa.array([*[None] * d, *(x[1] for x in packed)], pa.binary())], ["shard", "doc_id", "n", "sig", "bits", "blob"])

    def rows(kind, doc_id=None, n=None, sig=None, bits=None, key=None, pos=None, side=None) -> pa.RecordBatch:
        size = len(sig)
        fill = lambda x, t: pa.nulls(size, t) if x is None else x if isinstance(x, pa.Array) else pa.array(x, t)
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(size, kind, np.int32)), fill(doc_id, arrow_id), fill(n, pa.int64()), fill(sig, pa.int64()), fill(bits, pa.binary()),
            fill(key, pa.int64()), fill(pos, pa.int64()), fill(side, pa.int32())], ["kind", "doc_id", "n", "sig", "bits", "key", "pos", "side"])

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            blobs = batch.column(5)
            held += [unpack_postings(x) for x in blobs.drop_null().to_pylist()]
            own = batch.filter(blobs.is_null())
            if own.num_rows:
                yield rows(0, own.column(1), own.column(2), own.column(3), own.column(4))
        if not held:
            return
        key, sig, n, pos, side = (np.concatenate(x) for x in zip(*held))
        held.clear()
        keys, count = np.unique(key, return_counts=True)
        keys = keys[count > 1]
        if not len(keys):
            return
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        live = keys[at] == key
        key, sig, n, pos, side = (x[live] for x in (key, sig, n, pos, side))
        by = np.lexsort((side, sig, key))
        key, sig, n, pos, side = (x[by] for x in (key, sig, n, pos, side))
        same = np.r_[False, (key[1:] == key[:-1]) & (sig[1:] == sig[:-1])]  # copies of one set
        key, sig, n, pos, side = (x[~same] for x in (key, sig, n, pos, side))
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        length = np.repeat(np.diff(np.r_[start, len(key)]), np.diff(np.r_[start, len(key)]))
        key, sig, n, pos, side, length = (x[length > 1] for x in (key, sig, n, pos, side, length))
        if not len(key):
            return
        a, b = star_pairs(key, sig, n, pos, side, threshold)
        for k in range(0, len(key), 500_000):
            s = slice(k, k + 500_000)
            yield rows(1, None, n[s], sig[s], None, key[s].view(np.int64), pos[s], (side[s] + LONG * (length[s] > BLOCK)).astype(np.int32))
        for k in range(0, len(a), 500_000):
            yield rows(2, sig=b[k:k + 500_000], key=a[k:k + 500_000])

    sent = docs.select("doc_id", "text").mapInArrow(releasing(emit), f"shard int, doc_id {id_type}, n long, sig long, bits binary, blob binary")
    return stage_table(sent.repartitionById(shards, F.col("shard")).mapInArrow(
        releasing(gather), f"kind int, doc_id {id_type}, n long, sig long, bits binary, key long, pos long, side int"), "jaccard-index", "kind")


def _bloom(hashes: DataFrame) -> np.ndarray:
    """A bit set of fixed size over the column ``h``, built by Spark; at most BLOOM_BITS / 64 rows come back."""
    places = hashes.select(F.explode(F.array(F.pmod("h", F.lit(BLOOM_BITS)), F.pmod(F.shiftright("h", 24), F.lit(BLOOM_BITS)))).alias("p"))
    words = places.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("b")).toPandas()
    bits = np.zeros(BLOOM_BITS // 64, np.int64)
    bits[words["w"].to_numpy(np.int64)] = words["b"].to_numpy(np.int64)
    return bits


def _sets_of(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(sig, set) of the sets ``wanted`` (sig, h: hash of the id of one document that has it) and a few more.

    A Bloom filter picks the documents, so only their sets are built and moved."""
    bits = _bloom(wanted.select("h"))

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            h = batch.column("h").to_numpy()
            ok = np.ones(len(h), bool)
            for p in (h % BLOOM_BITS, (h >> 24) % BLOOM_BITS):
                ok &= ((bits[p >> 6] >> (p & 63)) & 1).astype(bool)
            texts = batch.column("text").filter(pa.array(ok))
            for block in by_bytes([pa.RecordBatch.from_arrays([texts], ["text"])], "text", BLOCK_BYTES):
                sets = [s for s in map(shingler, block.column("text").to_pylist()) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([signature(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["sig", "set"])

    return stage_table(docs.select(F.xxhash64("doc_id").alias("h"), "text").mapInArrow(releasing(build), "sig long, set binary"), "jaccard-sets")


def _verify(docs: DataFrame, pairs: DataFrame, known: DataFrame, fetched: DataFrame | None, width: int, threshold) -> tuple[DataFrame, DataFrame]:
    """The linked ones of ``pairs`` (u, v), and ``fetched`` (sig, set) with the sets this took.

    ``known``: (sig, n, bits, h) of all distinct sets."""
    def bounded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nu, nv = b.column("nu").to_numpy(), b.column("nv").to_numpy()
            apart = np.empty(len(nu), np.int64)
            for k, (x, y) in enumerate(zip(b.column("bu").to_pylist(), b.column("bv").to_pylist())):
                size = 8 * min(len(x), len(y))
                apart[k] = np.bitwise_count(folded(x, size) ^ folded(y, size)).sum(dtype=np.int64)
            yield b.filter(pa.array(enough(nu, nv, apart, threshold))).select(["u", "v", "hu", "hv"])

    def exact(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for s, t in zip(b.column("su"), b.column("sv")):
                x, y = np.frombuffer(s.as_buffer(), np.uint64), np.frombuffer(t.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                ok.append(threshold[1] * both >= threshold[0] * (len(x) + len(y) - both))
            yield b.filter(pa.array(ok, pa.bool_())).select(["u", "v"])

    side = lambda s: known.select(F.col("sig").alias(s), F.col("n").alias(f"n{s}"), F.col("bits").alias(f"b{s}"), F.col("h").alias(f"h{s}"))
    close = stage_table(pairs.join(side("u"), "u").join(side("v"), "v").select("u", "v", "nu", "nv", "bu", "bv", "hu", "hv")
                        .mapInArrow(releasing(bounded), "u long, v long, hu long, hv long"), "jaccard-close")
    wanted = stage_table(close.select(F.col("u").alias("sig"), F.col("hu").alias("h")).union(close.select("v", "hv")).distinct(), "jaccard-wanted")
    if fetched is None:
        full = own = _sets_of(docs, wanted, width)
    else:
        full = fetched.union(_sets_of(docs, wanted.join(fetched.select("sig"), "sig", "left_anti"), width))
        own = full.join(wanted.select("sig"), "sig", "left_semi")
    both = (close.select("u", "v").join(own.select(F.col("sig").alias("u"), F.col("set").alias("su")), "u")
            .join(own.select(F.col("sig").alias("v"), F.col("set").alias("sv")), "v"))
    return stage_table(both.select("u", "v", "su", "sv").mapInArrow(releasing(exact), "u long, v long"), "jaccard-links"), full


def _cross(live: DataFrame, classes: DataFrame, known: DataFrame, shards: int, threshold, every: bool) -> DataFrame:
    """Distinct candidate pairs (u, v) of different classes: all of them, or the neighbours in each list."""
    def pair(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        t = pa.Table.from_batches(held)
        key, sig, n, pos, side, label = (t.column(c).to_numpy() for c in ("key", "sig", "n", "pos", "side", "label"))
        if every:
            bits = np.zeros((len(key), BITS // 64), np.uint64)
            filled = t.column("bits").is_valid().to_numpy()
            bits[filled] = np.array([folded(x, BITS) for x in t.column("bits").drop_null().to_pylist()], np.uint64).reshape(-1, BITS // 64)
            found = cross_pairs(key, sig, n, pos, side % LONG, label, bits, threshold)
        else:
            found = [neighbour_pairs(key, sig, n, pos, side % LONG, label, threshold)]
        for a, b in found:
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["u", "v"])

    labelled = (live.join(classes.select(F.col("node").alias("sig"), "component"), "sig", "left")
                .select("key", "sig", "n", "pos", "side", F.coalesce("component", "sig").alias("label")))
    none = F.lit(None).cast("binary").alias("bits")
    if every:
        labelled = labelled.filter(F.col("side") < LONG).select("*", none).union(
            labelled.filter(F.col("side") >= LONG).join(known.select("sig", "bits"), "sig").select("key", "sig", "n", "pos", "side", "label", "bits"))
    return labelled.repartition(shards, "key").mapInArrow(releasing(pair), "u long, v long").distinct()


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                       threshold: tuple[int, int] = THRESHOLD, chunk: int = CHUNK, sample_docs: int = ORDER_SAMPLE_DOCS) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``docs``."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    total = docs.count()
    order, mean_prefix = _sample_order(docs, total, width, threshold, chunk, sample_docs)
    shards = int(min(20_000, max(12, -(-total * mean_prefix // POSTINGS_PER_TASK))))
    index = _index(docs, order, shards, width, threshold)
    rows = index.filter("kind = 0").select("doc_id", "n", "sig", "bits")
    sets = stage_table(rows.filter("n > 0").groupBy("sig").agg(
        F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("bits").alias("bits"), F.count("*").alias("copies"))
        .withColumn("h", F.xxhash64("id")), "jaccard-distinct")
    live = index.filter("kind = 1").select("key", "sig", "n", "pos", "side")
    first = index.filter("kind = 2").select(F.col("key").alias("u"), F.col("sig").alias("v")).distinct()
    links, fetched = _verify(docs, first, sets, None, width, threshold)
    classes = components(links)
    for every in (False, True):
        rest = _cross(live, classes, sets, shards, threshold, every)
        links, fetched = _verify(docs, rest, sets, fetched, width, threshold)
        classes = components(classes.select(F.col("node").alias("u"), F.col("component").alias("v")).union(links))
    named = classes.join(sets.select(F.col("sig").alias("node"), "id"), "node")
    least = named.groupBy("component").agg(F.min("id").alias("least"))
    own = named.join(least, "component").select(F.col("node").alias("sig"), "least")
    shared = (sets.join(own, "sig", "left").filter("copies > 1 or least is not null")
              .select(F.col("sig").alias("_sig"), F.coalesce("least", "id").alias("least")))
    return rows.join(shared, F.col("sig") == F.col("_sig"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id (NULL last), then the smallest hash
    of its columns.  Rows are told apart by id and hash, so rows of one id with different texts are judged one by
    one; rows without a word are no copies and stay."""
    names = ("copy", "id", "hash", "lost", "component")
    copy, row_id, row_hash, lost, component = (f"{c}_{uuid.uuid4().hex}" for c in names)  # no columns of the documents have these names
    own = F.xxhash64(*[docs[c] for c in docs.columns])
    found = (jaccard_components(docs.select(own.alias("doc_id"), docs[text_col].alias("text")), **kw).filter("n_shingles > 0")
             .groupBy("doc_id").agg(F.max("component_id").alias(component), (F.count("*") > 1).alias(copy)))
    ids = docs.select(docs[id_col].alias(row_id), own.alias(row_hash)).distinct()
    rows = stage_table(ids.join(found, ids[row_hash] == found["doc_id"]).select(row_id, row_hash, component, copy), "jaccard-rows")
    best = rows.groupBy(component).agg(F.min(F.struct(F.col(row_id).isNull().alias("none"), F.col(row_id).alias("id"), F.col(row_hash).alias("hash"))).alias("best"))
    first = F.col(row_id).eqNullSafe(F.col("best.id")) & (F.col(row_hash) == F.col("best.hash"))
    marks = rows.join(best, component).select(row_id, row_hash, (~first).alias(lost), copy).filter(F.col(lost) | F.col(copy))
    kept = (docs.join(marks, (own == marks[row_hash]) & docs[id_col].eqNullSafe(marks[row_id]), "left")
            .filter(~F.coalesce(marks[lost], F.lit(False))))
    once = kept.filter(F.col(copy).isNull()).select(*[docs[c] for c in docs.columns])
    return once.unionByName(kept.filter(F.col(copy)).dropDuplicates([row_id, row_hash]).select(*[F.col(c) for c in docs.columns]))
