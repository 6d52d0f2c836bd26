"""Quality rules as a short-circuit cascade: cheap, selective rules run first, later rules see only the rest.

Every rule is a condition over measures that is true for a document to reject.  Their cost (seconds a row: the slope
between two sizes of a warmed-up job, so that the cost of a job itself drops out) and selectivity (share rejected) are
estimated on a sample; ``order_rules`` sorts them by rejections per second.  ``cascade`` turns the ordered list into
one CASE expression inside a lambda, whose branches, their measures included, Spark evaluates only as far as needed.
The order changes the cost of a run and never its verdicts.  Only DataFrame functions are used.

``judge`` reports the base measures of every document; the measures of the rules beyond the base (letters, bullets,
ellipses) are taken only of documents that pass the base and every rule before them.

Defined cases: NULL or empty text has no words, all measures are 0 and the document fails; rules that
divide by a count use at least 1; repeated rows are judged one by one; an empty table gives an
empty result; extra columns are kept by ``keep_good`` and ignored by ``judge``.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import let, stage_table, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5
SAMPLE_ROWS = 1000
#: The sample is read this often in the small and in the large timing of a rule.
REPEATS = (1, 4)


@dataclass(frozen=True)
class Rule:
    """``reject`` takes the measures by name and returns a condition; it reads only those it needs."""

    name: str
    reject: Callable[[Mapping[str, Column]], Column]


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _n_dup_lines(text: Column, w: Column) -> Column:
    return let(_word_lines(text), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def _n_repeat_words(text: Column, w: Column) -> Column:
    """Words that lie in a window of five words found at least twice.

    Windows are compared by a 64-bit hash of their words.  Only a text that has a repeated window pays for
    sorting its windows; the covered words are then counted from the sorted start positions.
    """
    windows = F.when(F.size(w) < WINDOW, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)),
                    lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(WINDOW)])))

    def covered(h: Column) -> Column:
        ranked = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(ranked, lambda s: let(F.sort_array(F.transform(F.filter(s, lambda x, i: (
            (i > 0) & (x["h"] == F.get(s, i - 1)["h"])) | (
            (i < F.size(s) - 1) & (x["h"] == F.get(s, i + 1)["h"]))), lambda x: x["i"])),
            lambda p: F.aggregate(F.transform(p, lambda x, i: F.least(
                F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))),
                F.lit(0).cast("long"), lambda a, x: a + x)))

    return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h)))


def _word_lines(text: Column, pattern: str = r"[^\x20\x09-\x0D]") -> Column:
    """Lines that match, by default those with a word."""
    return F.filter(_lines(text), lambda x: x.rlike(pattern))


#: Measures of a text and its words.
MEASURES: dict[str, Callable[[Column, Column], Column]] = {
    "n_words": lambda t, w: F.size(w).cast("long"),
    "word_chars": lambda t, w: F.length(F.array_join(w, "")).cast("long"),
    "n_symbols": lambda t, w: F.length(F.regexp_replace(F.coalesce(t, F.lit("")), f"[^{SYMBOLS}]+", "")).cast("long"),
    "n_dup_lines": _n_dup_lines,
    "n_repeat_words": _n_repeat_words,
    "n_lines": lambda t, w: F.size(_lines(t)).cast("long"),
    "n_word_lines": lambda t, w: F.size(_word_lines(t)).cast("long"),
    "n_letter_words": lambda t, w: F.size(F.filter(w, lambda x: x.rlike(r"\p{L}"))).cast("long"),
    "n_bullet_lines": lambda t, w: F.size(_word_lines(t, r"^[\x20\x09-\x0D]*[•‣▪●○◦*-]")).cast("long"),
    "n_ellipsis_lines": lambda t, w: F.size(_word_lines(t, r"(\.\.\.|…)[\x20\x09-\x0D]*$")).cast("long"),
}
#: Measures that ``judge`` reports of every document; the others are taken where a rule asks for them.
REPORTED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

BASE = [
    Rule("too_few_words", lambda m: m["n_words"] < 10),
    Rule("repeated_windows", lambda m: 100 * m["n_repeat_words"] > 20 * m["n_words"]),
]
RULES = [
    *BASE,
    Rule("symbols", lambda m: 10 * m["n_symbols"] > 3 * F.greatest(m["n_words"], F.lit(1))),
    Rule("word_length", lambda m: (m["word_chars"] < 2 * F.greatest(m["n_words"], F.lit(1))) | (m["word_chars"] > 14 * F.greatest(m["n_words"], F.lit(1)))),
    Rule("repeated_lines", lambda m: (m["n_dup_lines"] >= 3) & (10 * m["n_dup_lines"] > 3 * m["n_lines"])),
    Rule("letters", lambda m: 2 * m["n_letter_words"] < m["n_words"]),
    Rule("bullets", lambda m: (m["n_bullet_lines"] >= 5) & (10 * m["n_bullet_lines"] > 9 * m["n_word_lines"])),
    Rule("ellipses", lambda m: (m["n_ellipsis_lines"] >= 3) & (10 * m["n_ellipsis_lines"] > 3 * m["n_word_lines"])),
]


def _over(text: Column, body: Callable[[dict[str, Column]], Column]) -> Column:
    """``body`` of the measures of a text, whose words are split once."""
    return let(words(text), lambda w: body({k: f(text, w) for k, f in MEASURES.items()}))


def estimate(docs: DataFrame, text_col: str, candidates: list[Rule], sample_rows: int = SAMPLE_ROWS, seed: int = 17,
             after: list[Rule] = ()) -> dict[str, tuple[float, float]]:
    """(seconds a row, share rejected) of each rule on about ``sample_rows`` random rows that pass the rules ``after``.

    The sample only decides the order of the rules; every document is judged by every rule it reaches."""
    total = docs.count()
    share = min(1.0, sample_rows / total) if total else 1.0
    slim = docs.select(F.col(text_col).alias("text"))
    slim = slim.sample(share, seed) if share < 1 else slim
    if after:
        slim = slim.filter(_over(F.col("text"), lambda m: cascade(list(after), m)))
    sample = stage_table(slim, "quality-sample").coalesce(1)  # one task: its time is the rules' time

    def timed(rule: Rule, repeats: int) -> tuple[float, int, int]:
        read = sample.withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
        hit = F.coalesce(_over(F.col("text"), rule.reject), F.lit(False)).cast("int")
        began = time.perf_counter()
        n, hits = read.agg(F.count("*"), F.sum(hit)).first()
        return time.perf_counter() - began, n, hits or 0

    out = {}
    for rule in candidates:
        timed(rule, REPEATS[0])  # compiles the job
        (quick, n, hits), (slow, _, _) = (timed(rule, r) for r in REPEATS)
        out[rule.name] = (max(slow - quick, 0.0) / max(n * (REPEATS[1] - REPEATS[0]), 1), hits / max(n, 1))
    return out


def order_rules(candidates: list[Rule], figures: dict[str, tuple[float, float]]) -> list[Rule]:
    """By rejections per second, highest first; equal ones by cost, then as given."""
    def key(rule: Rule) -> tuple[float, float]:
        cost, rejected = figures[rule.name]
        return -rejected / max(cost, 1e-9), cost
    return sorted(candidates, key=key)


def cascade(ordered: list[Rule], measures: Mapping[str, Column]) -> Column:
    """True if no rule rejects.  CASE stops at the first rule that does; a NULL verdict does not reject."""
    if not ordered:
        return F.lit(True)
    out = F.when(ordered[0].reject(measures), F.lit(False))
    for rule in ordered[1:]:
        out = out.when(rule.reject(measures), F.lit(False))
    return out.otherwise(F.lit(True))


def keep_good(docs: DataFrame, text_col: str = "text", candidates: list[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Documents that pass every rule, with all their columns; measures are computed only as far as needed."""
    ordered = order_rules(candidates, estimate(docs, text_col, candidates, sample_rows))
    return docs.filter(_over(docs[text_col], lambda m: cascade(ordered, m)))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", candidates: list[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The reported measures, ``base_failed`` and the cascade's verdict ``kept`` of every document.

    The base comes first, since its measures are reported anyway; the rules beyond it are ordered by a sample of
    documents that pass it and run in that order, each only where all before it pass."""
    beyond = [r for r in candidates if r not in BASE]
    ordered = order_rules(beyond, estimate(docs, text_col, beyond, sample_rows, after=BASE))
    text = F.col(text_col)

    def verdict(w: Column, reported: Column) -> Column:
        measures = {k: reported[k] if k in REPORTED else f(text, w) for k, f in MEASURES.items()}
        passed = cascade(BASE, measures)
        return F.struct(*[measures[k].alias(k) for k in REPORTED], (~passed).alias("base_failed"),
                        F.when(passed, cascade(ordered, measures)).otherwise(F.lit(False)).alias("kept"))

    judged = let(words(text), lambda w: let(F.struct(*[MEASURES[k](text, w).alias(k) for k in REPORTED]), lambda m: verdict(w, m)))
    return docs.select(F.col(id_col).alias("doc_id"), judged.alias("m")).select("doc_id", "m.*")
