"""Scoring texts with a smoothed bigram model in sharded Elias-Fano tries.

Model: p(w | v) = (c(v w) + PRIOR * p1(w)) / (c(v) + PRIOR) with p1(w) = (c(w) + 1) / (N + V + 1), counts over
all training documents; the first token follows a begin mark, every text ends in an end token.  log10 p is a
numerator, known where w's counts are, minus a denominator, known where v's are; so one shuffle by word serves
both, whatever the order of magnitude of the vocabulary.

1. Word counts of the training documents are summed by shard: N, V, and the counts of the few words that make up
   more than 1 / HOT_PART of the tokens (fewer than HOT_PART, a proven bound; they are sent to all tasks).
2. Every occurrence (w, v, document) goes to w's shard as packed arrays; occurrences of a hot word are dealt by
   (w, v) over all shards, so no word is a hot spot.
3. A shard counts its training pairs, packs them with their quantised numerators into a trie, looks all its
   occurrences up (words, then neighbours relative to the word) and returns sums per document.
4. The sums of a document meet by block and give one row per document.

Defined cases: NULL and empty text is the end token alone; a word never met in training has c = 0; without
training documents all counts are 0; repeated rows are scored one by one; an empty table gives an empty result;
extra columns are ignored; a NULL id is in fold 0.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import by_bytes, fold_of, mix, releasing, stage_table
from tickframe.llm.elias_fano import Trie
from tickframe.llm.jaccard_join import Shingler

FOLDS, HELD_OUT = 7, 2
PRIOR = 1000.0
HOT_PART = 4096
BLOCK_BYTES = 6 << 20
BLOCK_DOCS = 1 << 15
TOKENS_PER_TASK = 2_500_000
NEIGHBOUR_BITS = 40
BEGIN = np.uint64(0x1D8AF066BE64A7C5)
END = np.uint64(0xA3EC647659359ACD)


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    for block in by_bytes(batches, "text", BLOCK_BYTES):
        for at in range(0, block.num_rows, BLOCK_DOCS):
            yield block.slice(at, BLOCK_DOCS)


def _tokens(reader: Shingler, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, each ended by END, and the number of tokens of each."""
    parts, end = [], np.array([END])
    for t in texts:
        parts += [reader.word_hashes(t), end] if t else [end]
    tokens = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    lengths = np.diff(np.r_[-1, np.flatnonzero(tokens == END)]) if len(tokens) else np.empty(0, np.int64)
    return tokens, lengths


def _split(shard: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """(shard, its rows of each column); rows keep their order."""
    by = np.argsort(shard.astype(np.uint16) if len(shard) and shard.max() < 1 << 16 else shard, kind="stable")
    shard, columns = shard[by], [c[by] for c in columns]
    cuts = np.flatnonzero(np.diff(shard)) + 1
    for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(shard)]):
        if hi > lo:
            yield (int(shard[lo]), *[c[lo:hi] for c in columns])


def corpus_counts(docs: DataFrame, shards: int) -> tuple[int, int, int, np.ndarray, np.ndarray]:
    """(N, V, number of training documents, hot words sorted, their counts) of (text, train)."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Shingler()
        for block in _blocks(batches):
            texts = block.column("text").to_pylist()
            words, n = np.unique(_tokens(reader, texts)[0], return_counts=True)
            packed = list(_split((mix(words) % np.uint64(shards)).astype(np.int64), words, n))
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in packed], pa.int32()), pa.array([p[1].tobytes() for p in packed], pa.binary()),
                                              pa.array([p[2].astype(np.uint32).tobytes() for p in packed], pa.binary())], ["shard", "words", "n"])

    def total(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, n = [], []
        for b in batches:
            words += [np.frombuffer(x, np.uint64) for x in b.column("words").to_pylist()]
            n += [np.frombuffer(x, np.uint32) for x in b.column("n").to_pylist()]
        if not words:
            return
        distinct, back = np.unique(np.concatenate(words), return_inverse=True)
        counts = np.bincount(back, np.concatenate(n)).astype(np.int64)
        # a word that is hot in the corpus is so in its shard too: at most HOT_PART candidates a shard, whatever their number
        hot = (counts * HOT_PART >= counts.sum()) | (distinct == END)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[0, distinct[hot].view(np.int64)]), pa.array(np.r_[counts.sum(), counts[hot]]),
                                          pa.array(np.r_[len(distinct), np.zeros(hot.sum(), np.int64)])], ["word", "n", "distinct"])

    rows = stage_table(docs.filter("train").select("text").mapInArrow(releasing(count), "shard int, words binary, n binary")
                       .repartitionById(shards, F.col("shard")).mapInArrow(releasing(total), "word long, n long, distinct long"), "lm-counts")
    n, v = rows.filter("distinct > 0").agg(F.sum("n"), F.sum("distinct")).first()
    n, v = n or 0, v or 0
    end = int(END.view(np.int64))
    hot = rows.filter((F.col("distinct") == 0) & ((F.col("n") * HOT_PART >= n) | (F.col("word") == end))).select("word", "n").toPandas()
    words, counts = hot["word"].to_numpy(np.int64).view(np.uint64), hot["n"].to_numpy(np.int64)
    by = np.argsort(words)
    words, counts = words[by], counts[by]
    ends = int(counts[words == END].sum())
    return n, v, ends, words, counts


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS, held_out: int = HELD_OUT, prior: float = PRIOR,
          tokens_per_task: int = TOKENS_PER_TASK, tries: bool = False) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document; with ``tries``
    the model itself instead: (shard, trie), one packed trie per shard."""
    fold = fold_of(F.col(id_col), folds)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), (fold != held_out).alias("train"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = int(min(60_000, max(12, -(-(size / 6) // tokens_per_task))))
    n_all, n_distinct, n_ends, hot, hot_counts = corpus_counts(docs, shards)
    whole = n_all + n_distinct + 1

    def hot_index(words: np.ndarray) -> np.ndarray:
        if not len(hot):
            return np.full(len(words), -1, np.int64)
        at = np.minimum(np.searchsorted(hot, words), len(hot) - 1)
        return np.where(hot[at] == words, at, -1)

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Shingler()
        part = TaskContext.get().partitionId()
        for number, block in enumerate(_blocks(batches)):
            train = np.array(block.column("train").to_pylist(), bool)
            tokens, lengths = _tokens(reader, block.column("text").to_pylist())
            doc = np.repeat(np.arange(len(lengths)), lengths)
            before = np.r_[BEGIN, tokens[:-1]]
            before[before == END] = BEGIN
            words, local = np.unique(tokens, return_inverse=True)
            heat = hot_index(words)
            known = np.where(heat >= 0, hot_counts[heat] if len(hot) else 0, 0)
            # what hot words contribute without a shard: base score, known tokens, denominators
            own_base = np.where(heat >= 0, np.log10(known + 1.0), 0.0)
            own_down = np.where((heat >= 0) & (words != END), -np.log10(known + prior), 0.0)
            per_doc = lambda x: np.bincount(doc, x[local], len(lengths))
            base = per_doc(own_base)
            value = per_doc(own_down) - np.log10(n_ends + prior)
            n_known = per_doc((known > 0).astype(np.float64)).astype(np.int64)
            code = (doc | (train[doc].astype(np.int64) << 15)).astype(np.uint16)
            near = mix(before) >> np.uint64(64 - NEIGHBOUR_BITS)
            near_low, near_high = near.astype(np.uint32), (near >> np.uint64(32)).astype(np.uint8)
            home = (mix(words) % np.uint64(shards)).astype(np.int64)
            token_heat = heat[local]
            is_hot = token_heat >= 0
            rows: dict[int, list[bytes]] = {}
            # rare words: the shard's distinct words once, then per occurrence neighbour and document
            rank = np.empty(len(words), np.int64)
            by_home = np.lexsort((words, home))
            rank[by_home] = np.arange(len(words))
            cold = np.flatnonzero(~is_hot)
            cold = cold[np.argsort(rank[local[cold]].astype(np.int32), kind="stable")]
            for s, w, lo, hi, c in _split(home[local[cold]], local[cold], near_low[cold], near_high[cold], code[cold]):
                run = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
                rows[s] = [words[w[run]].tobytes(), np.diff(np.r_[run, len(w)]).astype(np.uint32).tobytes(), lo.tobytes(), hi.tobytes(), c.tobytes(), b"", b"", b"", b""]
            warm = np.flatnonzero(is_hot)
            to = (mix(near[warm] + hot[token_heat[warm]]) % np.uint64(shards)).astype(np.int64) if len(warm) else warm
            for s, w, lo, hi, c in _split(to, token_heat[warm].astype(np.uint16), near_low[warm], near_high[warm], code[warm]):
                rows.setdefault(s, [b""] * 9)[5:] = [w.tobytes(), lo.tobytes(), hi.tobytes(), c.tobytes()]
            block_id = (part << 24) | number
            packed = sorted(rows.items())
            k = len(packed)
            nul = lambda m, t: pa.nulls(m, t)
            d = len(lengths)
            head = [pa.concat_arrays([pa.array([s for s, _ in packed], pa.int32()), pa.array(np.arange(d) % shards, pa.int32())]),
                    pa.array(np.full(k + d, block_id))]
            blobs = [pa.concat_arrays([pa.array([r[i] for _, r in packed], pa.binary()), nul(d, pa.binary())]) for i in range(9)]
            tail = [pa.concat_arrays([nul(k, pa.int32()), pa.array(np.arange(d), pa.int32())]),
                    pa.concat_arrays([nul(k, block.column("doc_id").type), block.column("doc_id").combine_chunks()]),
                    pa.concat_arrays([nul(k, pa.bool_()), pa.array(~train)]),
                    *[pa.concat_arrays([nul(k, t), pa.array(x, t)]) for x, t in ((lengths, pa.int64()), (n_known, pa.int64()), (base, pa.float64()), (value, pa.float64()))]]
            yield pa.RecordBatch.from_arrays(head + blobs + tail, emitted)

    emitted = ["shard", "block", *[f"b{i}" for i in range(9)], "doc", "doc_id", "held_out", "n_tokens", "n_known", "base", "value"]

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, near, codes, blocks = [], [], [], []
        back = [emitted.index(c) for c in ("block", "doc", "doc_id", "held_out", "n_tokens", "n_known", "base", "value")]
        shard = -1
        for batch in batches:
            is_doc = batch.column("doc").is_valid()
            own = batch.filter(is_doc)
            if own.num_rows and not tries:
                yield pa.RecordBatch.from_arrays([*[own.column(i) for i in back], pa.nulls(own.num_rows, pa.binary())], scored)
            rest = batch.filter(pa.array(~is_doc.to_numpy(zero_copy_only=False)))
            for r in rest.select(["shard", "block", *[f"b{i}" for i in range(9)]]).to_pylist():
                shard = r["shard"]
                run = np.frombuffer(r["b1"], np.uint32)
                w = [np.repeat(np.frombuffer(r["b0"], np.uint64), run), hot[np.frombuffer(r["b5"], np.uint16)] if r["b5"] else np.empty(0, np.uint64)]
                words += w
                for lo, hi in (("b2", "b3"), ("b6", "b7")):
                    near.append(np.frombuffer(r[lo], np.uint32).astype(np.uint64) | (np.frombuffer(r[hi], np.uint8).astype(np.uint64) << np.uint64(32)))
                codes += [np.frombuffer(r["b4"], np.uint16), np.frombuffer(r["b8"], np.uint16)]
                blocks.append(np.full(len(w[0]) + len(w[1]), r["block"], np.int64))
        if not words:
            return
        word, near, code, block = (np.concatenate(x) for x in (words, near, codes, blocks))
        words.clear(), codes.clear(), blocks.clear()
        distinct, index = np.unique(word, return_inverse=True)
        index = index.astype(np.int32)
        del word
        train = code >> 15 == 1
        heat = hot_index(distinct)
        counts = np.where(heat >= 0, hot_counts[heat] if len(hot) else 0, np.bincount(index[train], minlength=len(distinct)))
        p1 = (counts + 1.0) / whole
        learned = np.flatnonzero(counts)
        place = np.full(len(distinct), -1, np.int64)
        place[learned] = np.arange(len(learned))
        pair, n = np.unique((place[index[train]].astype(np.uint64) << np.uint64(NEIGHBOUR_BITS)) | near[train], return_counts=True)
        of = (pair >> np.uint64(NEIGHBOUR_BITS)).astype(np.int64)
        packed = Trie.pack(distinct[learned], of, pair & np.uint64((1 << NEIGHBOUR_BITS) - 1), np.log10(prior * p1[learned]),
                           np.log10(n + prior * p1[learned][of]), NEIGHBOUR_BITS)
        if tries:
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([packed], pa.binary())], ["shard", "trie"])
            return
        trie = Trie(packed)
        at = trie.word(distinct)
        alone = np.full(len(distinct), np.log10(prior / whole))
        alone[at >= 0] = trie.word_value(at[at >= 0])
        rare = heat < 0
        down = np.where(rare & (distinct != END), -np.log10(counts + prior), 0.0)
        base = np.where(rare, np.log10(counts + 1.0), 0.0)
        step = 1 << 20
        value = np.empty(len(index))
        for lo in range(0, len(index), step):
            i = index[lo:lo + step]
            found = trie.pair(at[i], near[lo:lo + step])
            hit = found >= 0
            up = alone[i]
            up[hit] = trie.pair_value(found[hit])
            value[lo:lo + step] = up + down[i]
        document, back_to = np.unique((block << 15) | (code & 0x7FFF).astype(np.int64), return_inverse=True)
        sums = [np.bincount(back_to, x) for x in ((rare & (counts > 0))[index].astype(np.float64), base[index], value)]
        edge = np.flatnonzero(np.r_[True, np.diff(document >> 15) != 0, True])
        blobs = [b"".join([np.int64(hi - lo).tobytes(), (document[lo:hi] & 0x7FFF).astype(np.uint16).tobytes(), sums[0][lo:hi].astype(np.uint32).tobytes(),
                           sums[1][lo:hi].tobytes(), sums[2][lo:hi].astype(np.float32).tobytes()]) for lo, hi in zip(edge[:-1], edge[1:])]
        k = len(blobs)
        yield pa.RecordBatch.from_arrays([pa.array(document[edge[:-1]] >> 15), *[pa.nulls(k, t) for t in (
            pa.int32(), arrow_id, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())], pa.array(blobs, pa.binary())], scored)

    def total(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, blobs = [], []
        for b in batches:
            is_doc = b.column("doc").is_valid()
            rows.append(b.filter(is_doc))
            rest = b.filter(pc.invert(is_doc))
            blobs += zip(rest.column("block").to_pylist(), rest.column("sums").to_pylist())
        if not rows:
            return
        docs = pa.Table.from_batches(rows)
        code = (docs.column("block").to_numpy() << 15) | docs.column("doc").to_numpy().astype(np.int64)
        by = np.argsort(code)
        add = np.zeros((3, len(code)))
        for block, blob in sorted(blobs):
            m = int(np.frombuffer(blob, np.int64, 1)[0])
            doc, known = np.frombuffer(blob, np.uint16, m, 8), np.frombuffer(blob[8 + 2 * m:8 + 6 * m], np.uint32)
            at = by[np.searchsorted(code, (block << 15) | doc.astype(np.int64), sorter=by)]
            add[0, at] += known
            add[1, at] += np.frombuffer(blob[8 + 6 * m:8 + 14 * m], np.float64)
            add[2, at] += np.frombuffer(blob[8 + 14 * m:], np.float32)
        n = docs.column("n_tokens").to_numpy()
        yield pa.RecordBatch.from_arrays([
            docs.column("doc_id").combine_chunks(), docs.column("held_out").combine_chunks(), pa.array(n), pa.array(docs.column("n_known").to_numpy() + add[0].astype(np.int64)),
            pa.array(np.full(len(n), n_all)), pa.array(docs.column("base").to_numpy() + add[1] - n * float(np.log10(whole))), pa.array(docs.column("value").to_numpy() + add[2])], result)

    scored = ["block", "doc", "doc_id", "held_out", "n_tokens", "n_known", "base", "value", "sums"]
    result = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    arrow_id = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[id_type]
    sent = docs.mapInArrow(releasing(emit), ", ".join(["shard int, block long", *[f"b{i} binary" for i in range(9)], "doc int", f"doc_id {id_type}",
                                           "held_out boolean, n_tokens long, n_known long, base double, value double"])).repartitionById(shards, F.col("shard"))
    if tries:
        return sent.mapInArrow(releasing(gather), "shard int, trie binary")
    sums = sent.mapInArrow(releasing(gather), f"block long, doc int, doc_id {id_type}, held_out boolean, n_tokens long, n_known long, base double, value double, sums binary")
    return sums.repartition(shards, "block").mapInArrow(
        releasing(total), f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
