"""Language identification with one bit-sliced Bloom filter over character trigrams.

Training counts trigrams per language over all training rows.  A language keeps a trigram that is frequent
enough in it and not much rarer than in the language that uses it most.  All languages share one Bloom filter
whose every position holds a bit mask of languages: AND-ing the masks at a trigram's positions returns all
languages that have it.  A text's hits per language (popcounts over its trigrams) are corrected for the
filter's false positives, which follow from the share of set bits, and the language with most hits wins.

Trigrams are taken over lower-cased letters; all else counts as one space.  Frequent enough means ``MIN_COUNT``
times (or as often as the language's most frequent one, if that is less) and a share of at least ``MIN_SHARE``
of a language's trigrams, so a language keeps at most ``1 / MIN_SHARE`` of them and the
filter has a proven bound.

Defined cases: NULL text, or one without a letter, gives ``und`` and score 0; a text none of whose trigrams is
known gives the language most common in training and score 0; ties go to the first language by code point;
without training rows every text is ``und``; rows with NULL lang are not trained on; repeated rows and extra
columns need no care.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import by_bytes, mix, releasing, stage_table

MIN_SHARE = 1e-5
MIN_COUNT = 3
#: A language has a trigram if its share there is at least this part of the largest share in any language.
MIN_PART = 0.2
HASHES = 3
ROOM = 12
BLOCK_BYTES = 1 << 20
FLUSH = 1_000_000
#: Standard deviations of the false-positive hits that a known language must exceed.
NOISE = 4
UNKNOWN = "und"
_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, text index) of every trigram, and the number of letters of every text."""
    padded = [f" {t.lower()} " if t else "  " for t in texts]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    text = np.repeat(np.arange(len(texts)), [len(t) for t in padded])
    is_letter = letters()[codes]
    count = np.bincount(text[is_letter], minlength=len(texts))
    codes = np.where(is_letter, codes, 32).astype(np.int64)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32) | (text[1:] != text[:-1])
    codes, text = codes[keep], text[keep]
    same = text[2:] == text[:-2]
    return ((codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:])[same], text[2:][same], count


@dataclass(frozen=True)
class Model:
    langs: list[str]
    masks: np.ndarray  # position -> bit mask of languages, 64 languages a column
    common: int

    def positions(self, keys: np.ndarray) -> Iterator[np.ndarray]:
        yield from positions(keys, len(self.masks))

    def false_positive(self) -> np.ndarray:
        fill = np.array([((self.masks[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean() for k in range(len(self.langs))])
        return fill ** HASHES

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        return self.judge(texts)[:2]

    def judge(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and whether some language has more hits than its false positives explain."""
        known = np.zeros(len(texts), bool)
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), known
        keys, text, n_letters = trigrams(texts)
        found = None
        for p in self.positions(keys):
            found = self.masks[p] if found is None else found & self.masks[p]
        total = np.maximum(np.bincount(text, minlength=len(texts)), 1)
        rates = np.empty((len(texts), len(self.langs)))
        for k, wrong in enumerate(self.false_positive()):
            hit = (found[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)
            hits = np.bincount(text, hit, len(texts))
            known |= hits > total * wrong + NOISE * np.sqrt(total * wrong * (1 - wrong))
            rates[:, k] = np.maximum(hits / total - wrong, 0) / max(1 - wrong, 1e-9)
        best = rates.argmax(axis=1)
        top, every = rates.max(axis=1), rates.sum(axis=1)
        best[every == 0] = self.common
        score = np.where(n_letters > 0, top / np.maximum(every, 1e-300), 0.0)
        return [self.langs[b] if n else UNKNOWN for b, n in zip(best, n_letters)], score, known


def positions(keys: np.ndarray, size: int) -> Iterator[np.ndarray]:
    h = mix(keys.view(np.uint64))
    step = mix(h) | np.uint64(1)
    for k in range(HASHES):
        yield ((h + np.uint64(k) * step) % np.uint64(size)).astype(np.int64)


def _counts(rows: DataFrame) -> DataFrame:
    """(lang, key, n) over the rows (text, lang), summed in each task before the shuffle."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                keys, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
                n = np.bincount(back, np.concatenate([c for _, c in parts])).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(n)], ["lang", "key", "n"])
            held.clear()

        for block in by_bytes(batches, "text", BLOCK_BYTES):
            texts, langs = block.column("text").to_pylist(), block.column("lang").to_pylist()
            for lang in set(langs):
                keys, n = np.unique(trigrams([t for t, x in zip(texts, langs) if x == lang])[0], return_counts=True)
                held.setdefault(lang, []).append((keys, n))
                size += len(keys)
            if size > FLUSH:
                yield from flush()
                size = 0
        yield from flush()

    return rows.mapInArrow(releasing(count), "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, learn_from: Column, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fits the filter on all rows where ``learn_from`` holds and text and language are known."""
    rows = docs.filter(learn_from).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("text is not null and lang is not null")
    counts = stage_table(_counts(rows), "language-counts")
    totals = {r[0]: r[1] for r in counts.groupBy("lang").agg(F.sum("n")).collect()}  # a row per language
    langs = sorted(totals)
    if not langs:
        return Model([], np.zeros((1, 1), np.uint64), 0)
    spark = docs.sparkSession
    known = spark.createDataFrame([(x, k, float(totals[x])) for k, x in enumerate(langs)], "lang string, bit int, total double")
    shares = counts.join(F.broadcast(known), "lang").withColumn("share", F.col("n") / F.col("total"))
    most = shares.groupBy("key").agg(F.max("share").alias("most"))
    often = counts.groupBy("lang").agg(F.least(F.max("n"), F.lit(MIN_COUNT)).alias("often"))  # a row per language
    own = shares.join(F.broadcast(often), "lang").filter((F.col("n") >= F.col("often")) & (F.col("share") >= MIN_SHARE)).join(most, "key").filter(F.col("share") >= MIN_PART * F.col("most"))
    kept = own.select("key", "bit").toPandas()  # at most 1 / MIN_SHARE rows per language
    keys, bits = kept["key"].to_numpy(np.int64), kept["bit"].to_numpy(np.int64)
    size = 1 << max(10, int(ROOM * max(len(np.unique(keys)), 1) - 1).bit_length())
    masks = np.zeros((size, -(-len(langs) // 64)), np.uint64)
    for p in positions(keys, size):
        np.bitwise_or.at(masks, (p, bits // 64), np.uint64(1) << (bits % 64).astype(np.uint64))
    return Model(langs, masks, max(range(len(langs)), key=lambda k: (totals[langs[k]], -k)))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score), one row per row of ``docs``."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in by_bytes(batches, "text", BLOCK_BYTES):
            lang, score = model.predict(block.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([block.column("doc_id").combine_chunks(), pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(releasing(predict), f"doc_id {id_type}, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without those of undetermined language: no letter, or no language's trigrams beyond false positives.

    Each language is judged by itself, so more languages do not make a document less certain."""
    def select(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in by_bytes(batches, text_col, BLOCK_BYTES):
            lang, _, known = model.judge(block.column(text_col).to_pylist())
            yield from block.filter(pa.array((np.array(lang) != UNKNOWN) & known)).to_batches()

    return docs.mapInArrow(releasing(select), docs.schema)
