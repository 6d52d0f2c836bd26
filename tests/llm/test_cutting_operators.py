"""Fill-in-the-middle, filter audit and repeated spans against brute force, on the smallest tables and awkward rows."""
import hashlib
import re
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tickframe.llm import fill_middle, filter_audit, repeat_spans
from tickframe.llm.frame_store import Packer, Reader, cut_points, seek, unit_starts
from tickframe.llm.queries import ORACLES, QUERIES
from tickframe.llm.radix_trie import Trie, shared

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 977} x{i}," for i in range(20_000))
PASSAGE = " ".join(f"passage{i}" for i in range(70))
AWKWARD = [
    (1, None, None), (2, "", "en"), (3, " \t\n\x0b ", "en"), (4, "one two three", ""), (5, "One TWO three\n\nfour é ퟿ 😀 five", "fr"),
    (6, LONG, "en"), (6, LONG, "en"), (None, LONG + "!", "en"), (None, "null id", "de"), (None, "null id", "de"), (7, "null id", "de"),
    (8, "has <P> inside", "en"), (9, "a" * 5000, "de"), (10, "<S" * 40, "en"), (11, PASSAGE + " tail one", "en"),
    (12, "head two " + PASSAGE, "en"), (13, "ab" * 700, "fr"), (14, PASSAGE[:399], "fr"), (15, "x" + PASSAGE[:399], "fr"),
    (16, "é" * 450 + "b", None), (17, "c" + "é" * 300, None), (4, "one two three", ""),
]
SCHEMA = "doc_id long, text string, lang string"


@pytest.fixture(scope="module")
def rows():
    return duckdb.sql(f"SELECT doc_id, text, lang FROM read_parquet('{SF}/documents.parquet') ORDER BY doc_id").fetchall()


@pytest.fixture(scope="module")
def odd(spark):
    """Awkward rows with extra columns whose names the operators use themselves."""
    names = ("frames", "units", "form", "output", "block", "run", "spans", "part", "mask", "least", "group_id", "n", "gram", "weight", "range_id")
    return spark.createDataFrame(AWKWARD, SCHEMA).withColumns({c: F.lit(7) for c in names})


# ---- op11 ---------------------------------------------------------------------

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.DOTALL)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def fim_by_hand(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n, digest = len(units), sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(digest[8 * k:8 * k + 8], 16) for k in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return str(doc_id), n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h4 % 100 < 20 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return str(doc_id), n, form, len(p), len(m), sha(out), sha(text)


@pytest.mark.parametrize("frame_bytes", [1 << 16, 257, 3])
def test_fill_in_middle(spark, rows, odd, frame_bytes):
    docs = odd if frame_bytes > 3 else odd.filter(F.length("text") < 2000)
    if frame_bytes > 300:
        docs = docs.select("doc_id", "text", "lang").union(spark.createDataFrame(rows, SCHEMA))
    given = docs.select("doc_id", "text").collect()
    found = fill_middle.fill_in_middle(docs, frame_bytes=frame_bytes).collect()
    got = [(str(r.doc_id), r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) for r in found]
    assert Counter(got) == Counter(fim_by_hand(*r) for r in given)
    reader = Reader()
    for r in found:  # the frames are the output whose digest was streamed
        assert hashlib.sha256(b"".join(map(reader.frame, map(bytes, r.output)))).hexdigest() == r.output_sha256


def test_fill_in_middle_empty_table_and_rates(spark, odd):
    assert fill_middle.fill_in_middle(odd.limit(0)).count() == 0
    stored = fill_middle.store(odd)
    assert {r.form for r in fill_middle.transform(stored, fill_middle.Rates(fim=0)).collect()} == {"plain"}
    forms = Counter(r.form for r in fill_middle.transform(stored, fill_middle.Rates(fim=100, spm=100)).collect())
    assert forms == {"plain": 3, "spm": len(AWKWARD) - 3}


def test_frames_are_cut_between_characters_and_found_by_unit():
    text = ("abc é😀" * 30 + "z" * 40 + "9 ").encode()
    units = UNIT.findall(text.decode())
    for size in (1, 2, 5, 16, 1000):
        ends = cut_points(text, size)
        parts = [text[a:b] for a, b in zip([0, *ends], ends)]
        assert b"".join(parts) == text and all(p.decode() for p in parts)
        frames = [Packer()(p) for p in parts]
        starts = np.concatenate([[0], np.cumsum(unit_starts(np.frombuffer(text, np.uint8), np.zeros(1, np.int64)))])
        counts = starts[ends].tolist()
        chars = [len(text[:e].decode()) for e in ends]
        for unit in range(len(units) + 1):
            k, at, before = seek(Reader(), frames, counts, chars, ends, unit)
            place = (ends[k - 1] if k else 0) + at
            assert text[:place].decode() == "".join(units[:unit]) and before == len("".join(units[:unit]))
        assert b"".join(Reader().stream(frames, 7, 33)) == text[7:33]


# ---- op12 ---------------------------------------------------------------------

WORD = re.compile("[^\x20\x09-\x0D]+")


def masks_by_hand(docs):
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    out = []
    for i, t, part in docs:
        t = t or ""
        w = WORD.findall(t)
        mask = ((len(w) < 100) + 2 * (100 * len(set(w)) < 80 * len(w)) + 4 * (100 * len(re.findall("[A-Z]", t)) > 10 * len(t))
                + 8 * bool(re.search(r"[#$%&*|]", t)) + 16 * (i is not None and i > least[t]))
        out.append((str(i), part or "", mask))
    return out


def audit_by_hand(masks, labels):
    """Applies the filters one after the other to the rows themselves."""
    good = {str(i) for i, q, _ in labels if q == 1 and i is not None}
    toxic = {str(i) for i, _, t in labels if t == 1 and i is not None}
    out, removed_by = {}, Counter()
    for part in {p for _, p, _ in masks}:
        members = [(i, m) for i, p, m in masks if p == part]
        for order in permutations("ABCDE"):
            left = members
            for step, letter in enumerate(order, 1):
                bit = 1 << "ABCDE".index(letter)
                gone = [x for x in left if x[1] & bit]
                redundant = sum(bool(m & bit) for _, m in members) - len(gone)
                left = [x for x in left if not x[1] & bit]
                removed_by[part, letter] += len(gone)
                out[part, "".join(order), step] = (
                    letter, len(left), len(gone), redundant, sum(m == bit for _, m in members),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone))
    return {k: (*v[1:], removed_by[k[0], v[0]]) for k, v in out.items()}


@pytest.mark.parametrize("target", [32 << 20, 4000])
def test_filter_audit(spark, rows, odd, target):
    docs = odd.select("doc_id", "text", "lang").union(spark.createDataFrame(rows, SCHEMA))
    given = [tuple(r) for r in docs.collect()]
    judged = filter_audit.judged(docs, target=target)
    want = masks_by_hand(given)
    assert Counter((str(r.doc_id), r.part, r["mask"]) for r in judged.collect()) == Counter(want)
    labels = [(1, 1, 1), (1, 0, 0), (6, 1, 0), (6, 0, 1), (7, 1, 1), (None, 1, 1), (12, None, 1), (999_999, 1, 1)]
    labels += [(i, i % 2, int(i % 5 == 0)) for i in range(20, 120)]
    counts = filter_audit.mask_counts(judged, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit(1)))
    found = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
             for r in filter_audit.audit(counts).collect()}
    assert found == audit_by_hand(want, labels)


def test_filter_audit_of_no_rows(spark, odd):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.filter_audit(odd.limit(0), labels).count() == 0
    assert filter_audit.filter_audit(odd, labels).filter("good_lost + toxic_lost > 0").count() == 0


def test_ranges_split_at_shared_prefixes(spark):
    """Many copies, a long shared head and texts that are prefixes of others: ranges stay light or hold one text."""
    head = "the same long head " * 40
    texts = ["copy " * 30] * 400 + [head + str(i) for i in range(300)] + [f"{i:03d}" * 9 for i in range(200)] + [head, head[:500], ""]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], SCHEMA).repartition(7)
    groups = filter_audit.grouped(df).filter("text IS NOT NULL").cache()
    target = 6000
    starts = filter_audit.splits(groups, target)
    assert starts == sorted(set(starts)) and starts[0] == b""
    held = [(bytes(r.text), r.weight) for r in groups.collect()]
    for a, b in zip(starts, [*starts[1:], None]):
        inside = [(t, w) for t, w in held if t >= a and (b is None or t < b)]
        assert sum(w for _, w in inside) <= 2 * target or len({t for t, _ in inside}) == 1
    first = {r.group_id: r["first"] for r in filter_audit.first_ids(groups, target).collect()}
    least = {}
    for i, t in enumerate(texts):
        least.setdefault(t.encode(), i)
    assert first == {r.group_id: least[bytes(r.text)] for r in groups.collect()}
    groups.unpersist()


def test_trie_holds_least_ids():
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 99, rng.integers(0, 9)).astype(np.uint8)) for _ in range(600)]
    trie, least = Trie(), {}
    for g, t in enumerate(texts):
        i = None if g % 7 == 0 else int(rng.integers(0, 1000))
        trie.insert(t, g, i)
        least.setdefault(t, []).append((g, i))
    found = [(sorted(groups), low) for groups, low in trie.terminals()]
    want = [(sorted(g for g, _ in least[t]), min((i for _, i in least[t] if i is not None), default=None)) for t in sorted(least)]
    assert found == want and trie.nodes < 2 * len(least) + 1
    assert [shared(b"abcd", b"xxabce", 2), shared(b"ab", b"ab", 0), shared(b"", b"q", 0)] == [3, 2, 0]


# ---- op13 ---------------------------------------------------------------------

def spans_by_hand(texts, span=400):
    """(n_bytes, spans, kept) of each text, from a count of all strings of ``span`` bytes."""
    texts = [(t or "").encode() for t in texts]
    seen = Counter(t[k:k + span] for t in texts for k in range(len(t) - span + 1))
    out = []
    for t in texts:
        spans = []
        for k in range(len(t) - span + 1):
            if seen[t[k:k + span]] > 1:
                if spans and k <= spans[-1][1]:
                    spans[-1][1] = k + span
                else:
                    spans.append([k, k + span])
        kept, at = [], 0
        for a, b in spans:
            kept.append(t[at:a])
            at = b
        out.append((len(t), tuple(map(tuple, spans)), b"".join([*kept, t[at:]])))
    return out


def as_found(df):
    return Counter((str(r.doc_id), r.n_bytes, tuple((s.start, s.stop) for s in r.spans), bytes(r.kept)) for r in df.collect())


@pytest.mark.parametrize("hot", [repeat_spans.HOT, 1])
def test_repeated_spans(spark, rows, odd, hot):
    docs = odd.select("doc_id", "text", "lang").union(spark.createDataFrame(rows[:120], SCHEMA)).repartition(5)
    given = [tuple(r) for r in docs.collect()]
    found = repeat_spans.remove_repeats(docs.withColumn("bytes", F.lit(1)), hot=hot)
    assert as_found(found) == Counter((str(i), *r) for (i, _, _), r in zip(given, spans_by_hand([t for _, t, _ in given])))
    assert repeat_spans.remove_repeats(odd.limit(0)).count() == 0


def test_repeated_spans_of_small_blocks_and_pieces(spark, monkeypatch):
    """Edits, periods and matches of just 399, 400 and 401 bytes, over many blocks; anchors searched in small pieces."""
    monkeypatch.setattr(repeat_spans, "BLOCK", 3000)
    monkeypatch.setattr(repeat_spans, "PART_RUNS", 5)
    rng = np.random.default_rng(11)
    word = lambda n: "".join(map(chr, rng.integers(97, 101, n)))
    base = word(2500)
    texts = [base, base[:1200] + "#" + base[1201:], word(30) + base[300:699] + word(40), word(50) + base[800:1200] + word(9),
             word(5) + base[1500:1901], base[2100:], "abcabd" * 300, "xx" + "abcabd" * 90, word(700) * 3, "q" * 1000, "q" * 399, "q" * 400]
    texts += ["".join(base[k:k + 450] + word(60) for k in rng.integers(0, 2000, 4)) for _ in range(12)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], SCHEMA).repartition(4)
    given = [tuple(r) for r in docs.collect()]
    want = Counter((str(i), *r) for (i, _, _), r in zip(given, spans_by_hand([t for _, t, _ in given])))
    assert as_found(repeat_spans.remove_repeats(docs)) == want


@pytest.mark.parametrize("piece", [1, 7, 300, 1 << 22])
def test_anchors_depend_on_the_string_alone(monkeypatch, piece):
    monkeypatch.setattr(repeat_spans, "PIECE", piece)
    rng = np.random.default_rng(2)
    data = rng.integers(97, 100, 1500).astype(np.uint8)
    data[500:900] = 97
    grams = repeat_spans.identifiers(data, repeat_spans.GRAM)
    at = repeat_spans.anchors(grams)
    cut = np.uint64(repeat_spans.PLACE_BITS)
    for s in range(0, len(data) - 399, 13):
        window = grams[s:s + 400 - repeat_spans.GRAM + 1] >> cut
        assert at[s] == s + int(np.argmin(window))


def test_registered_sql_of_cutting_operators(spark):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name in ("op11_fill_middle", "op12_filter_audit"):
        df = QUERIES[name](spark, SF)
        want = con.sql(f"SELECT {', '.join(df.columns)} FROM ({ORACLES[name]})").fetchall()
        assert Counter(tuple(r) for r in df.collect()) == Counter(want)


def test_suffix_dedup_query(spark, rows):
    want = Counter((i, n, sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest())
                   for (i, _, _), (n, spans, kept) in zip(rows, spans_by_hand([t for _, t, _ in rows])))
    assert Counter(tuple(r) for r in QUERIES["op13_suffix_dedup"](spark, SF).collect()) == want
