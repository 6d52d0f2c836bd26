"""Token counts by batch encoding in Arrow functions that return lengths only.

Texts are handled in blocks of about equal bytes.  Each text is split at safe boundaries, places where a
byte-level BPE with the usual word pattern always starts a new token: before a single space between two
non-space characters, and around a single line feed between two.  A long text thus becomes many short pieces,
and the block's distinct pieces are encoded in batches.  Lengths of pieces seen before are kept in a bounded
memory per worker.  Added special tokens hold no white space, so they never lie across a boundary.

Defined cases: NULL and empty text have 0 bytes and 0 tokens; a text without a safe boundary is encoded as it
is, however long; repeated rows are counted one by one; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import by_bytes, releasing

BLOCK_BYTES = 6 << 20
BATCH_CHARS = 256 << 10
BATCH_PIECES = 2048
KEPT_PIECES = 300_000
#: Marks that may end a piece.
MARKS = ".,;:!?"
_SPACES = r" \n\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: RE2: two spaces in a row, white space at either end or other than space and line feed.
_ODD_SPACE = rf"[ \n][ \n]|^[ \n]|[ \n]$|[{_SPACES[3:]}]"
#: Letters whose normal form ends in a letter: the mark behind them is a token of its own.  Others (U+0130 in lower
#: case, letters that are decomposed) may end in a combining mark, which joins the mark behind it.
_LETTER = r"[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{24f}]"
_MARKED = rf"{_LETTER}[{MARKS}]$"
_SAFE = re.compile(r"(?<=\S)(?= \S)")


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def pieces(text: str) -> list[str]:
    """Parts of a text, cut before single spaces, whose token counts add up to that of the text."""
    return _SAFE.split(text) if text else []


def gather(source: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``source[start:start + size]`` of every row, one after the other."""
    upto = np.cumsum(size)
    return source[np.repeat(start - (upto - size), size) + np.arange(upto[-1] if len(upto) else 0)]


class PieceMemory:
    """Token ids of pieces of text; each distinct piece of a block is encoded once.

    Pieces without inner white space are encoded many at a time, joined by ``separator``, whose one token ends
    what belongs to a piece; all others alone.  A final mark after a Latin letter is a token of its own, so a marked
    piece is put together from its stem and the mark.  At most about ``KEPT_PIECES`` pieces, or those of one
    block, are remembered."""

    def __init__(self, path: str, separator: str, same: Callable[[pa.Array], pa.Array] = lambda words: words):
        self.tokenizer = load_tokenizer(path)
        self.separator, self.same = separator, same
        self.divider, = self._alone(separator.strip(" "))
        self.joinable = rf"^ ?[^{_SPACES}<{separator.strip(' ')}]+$"
        self.words = pa.array(list(MARKS), pa.string())
        self.size = np.ones(len(MARKS), np.int64)
        self.start = np.arange(len(MARKS))
        self.ids = np.array([self._alone(m)[0] for m in MARKS], np.uint32)

    def _alone(self, piece: str) -> list[int]:
        return self.tokenizer.encode(piece, add_special_tokens=False).ids

    def __call__(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start, size): the ids of word k are ``ids[start[k]:start[k] + size[k]]``.  Words are distinct."""
        if len(self.words) + len(words) > 2 * KEPT_PIECES:
            self._forget(words)
        at = pc.index_in(words, value_set=self.words)
        new = words.filter(at.is_null())
        at = at.fill_null(-1).to_numpy().astype(np.int64)
        marked = pc.match_substring_regex(new, _MARKED)
        cut = pc.utf8_slice_codeunits(new, 0, -1)
        stems = self.same(pc.if_else(marked, cut, new))
        numbered = stems.dictionary_encode()
        first = self._add(numbered.dictionary)
        own = first[numbered.indices.to_numpy()]
        mark = pc.index_in(pc.utf8_slice_codeunits(new, -1), value_set=self.words.slice(0, len(MARKS))).fill_null(0).to_numpy()
        more = marked.to_numpy(zero_copy_only=False).astype(np.int64)
        there = own.copy()  # a piece that is its own stem has its place already
        put = np.flatnonzero(pc.not_equal(new, stems).to_numpy(zero_copy_only=False))
        # a marked piece: the ids of its stem, then that of the mark
        size = self.size[own[put]]
        ids = np.empty(int(size.sum() + more[put].sum()), np.uint32)
        start = np.cumsum(size + more[put]) - (size + more[put])
        ids[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())] = gather(self.ids, self.start[own[put]], size)
        with_mark = more[put] == 1
        ids[(start + size)[with_mark]] = self.ids[mark[put][with_mark]]
        there[put] = self._append(new.take(pa.array(put)), size + more[put], ids)
        at[at < 0] = there
        return self.ids, self.start[at], self.size[at]

    def _append(self, words: pa.Array, size: np.ndarray, ids: np.ndarray) -> np.ndarray:
        begin = len(self.words)
        self.words = pa.concat_arrays([self.words, words])
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.ids = np.concatenate([self.ids, ids])
        return np.arange(begin, len(self.words))

    def _add(self, words: pa.Array) -> np.ndarray:
        """Places of distinct words, encoding those not known."""
        at = pc.index_in(words, value_set=self.words)
        at = at.fill_null(-1).to_numpy().astype(np.int64)
        missing = np.flatnonzero(at < 0)
        new = words.take(pa.array(missing))
        by_length = pc.sort_indices(pc.utf8_length(new)).to_numpy()
        together = pc.match_substring_regex(new, self.joinable).to_numpy(zero_copy_only=False)[by_length]
        joined, alone = by_length[together], by_length[~together]
        parts = [self._joined(new.take(pa.array(joined)).to_pylist())]
        for ids in map(self._alone, new.take(pa.array(alone)).to_pylist()):
            parts.append((np.array([len(ids)]), np.array(ids, np.uint32)))
        order = np.concatenate([joined, alone]).astype(np.int64)
        at[missing[order]] = self._append(new.take(pa.array(order)), np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
        return at

    def _joined(self, items: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(sizes, ids) of items sorted by length, in batches of about equal size."""
        sizes, ids, at = [np.empty(0, np.int64)], [np.empty(0, np.uint32)], 0
        while at < len(items):
            longest = len(items[min(at + BATCH_PIECES, len(items)) - 1])
            batch = items[at:at + max(1, min(BATCH_PIECES, BATCH_CHARS // longest))]
            at += len(batch)
            found = np.array(self.tokenizer.encode_batch_fast([self.separator.join(batch)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(found == self.divider)
            if len(ends) != len(batch) - 1:  # the separator became part of a token
                alone = [self._alone(piece) for piece in batch]
                sizes.append(np.array([len(a) for a in alone], np.int64))
                ids.append(np.array([i for a in alone for i in a], np.uint32))
                continue
            sizes.append(np.diff(np.r_[-1, ends, len(found)]) - 1)
            ids.append(found[found != self.divider])
        return np.concatenate(sizes), np.concatenate(ids)

    def _forget(self, words: pa.Array) -> None:
        """Keeps the marks and the pieces met in ``words``."""
        used = np.zeros(len(self.words), bool)
        used[:len(MARKS)] = True
        used[pc.index_in(words, value_set=self.words).drop_null().to_numpy()] = True
        self.ids = gather(self.ids, self.start[used], self.size[used])
        self.size = self.size[used]
        self.start = np.cumsum(self.size) - self.size
        self.words = self.words.filter(pa.array(used))


class LengthCounter:
    """Token counts of texts.

    Arrow splits texts without odd white space at their spaces; a piece is a word with the space or line feed
    before it (a line feed set before the whole text counts one token).  Other texts go through ``pieces``."""

    def __init__(self, path: str):
        self.memory = PieceMemory(path, "\n")

    def _sums(self, lists: pa.Array, before: Callable[[pa.Array], pa.Array] = lambda words: words) -> np.ndarray:
        numbered = lists.flatten().dictionary_encode()
        size = self.memory(before(numbered.dictionary))[2]
        upto = np.r_[0, np.cumsum(size[numbered.indices.to_numpy()])]
        return np.diff(upto[np.r_[0, np.cumsum(lists.value_lengths().to_numpy())]])

    def counts(self, texts: pa.Array) -> np.ndarray:
        odd = pc.match_substring_regex(texts, _ODD_SPACE)
        is_odd = odd.to_numpy(zero_copy_only=False)
        out = np.empty(len(texts), np.int64)
        plain = pc.binary_join_element_wise("\n", texts.filter(pc.invert(odd)), "")
        split = pc.split_pattern(pc.replace_substring(plain, "\n", " \n"), " ")
        out[~is_odd] = self._sums(split, lambda w: pc.if_else(pc.or_(pc.equal(w, ""), pc.starts_with(w, "\n")), w, pc.binary_join_element_wise(" ", w, ""))) - 1
        out[is_odd] = self._sums(pa.array([pieces(t) for t in texts.filter(odd).to_pylist()], pa.list_(pa.string())))
        return out


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per row of ``docs``."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = LengthCounter(tokenizer_path)
        for block in by_bytes(batches, "text", BLOCK_BYTES):
            text = block.column("text").combine_chunks().fill_null("")
            n = counter.counts(text)
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id").combine_chunks(), pc.binary_length(text).cast(pa.int64()), pa.array(n), pa.array(n > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(releasing(count), f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean"))
