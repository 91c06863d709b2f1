"""Resampling, line dedup and periodic runs against plain versions of the same rules."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from kerbflow.llm import queries
from kerbflow.llm import resampling as rs
from kerbflow.llm.line_dedup import apply_bitmaps, dedup_lines, keep_bitmaps
from kerbflow.llm.periodic_runs import WaveletTree, find_runs, periodic_runs
from kerbflow.llm.resampling import Features, Frequent, Head, Joiner, resample

DOCS = "doc_id bigint, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- resampling ---------------------------------------------------------------------------------------


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_features(text):
    w = plain_words(text)
    return [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def plain_buckets(text):
    return Counter(zlib.crc32(f.encode()) % 10_000 for f in plain_features(text))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab Zé中9-\n", max_size=40), max_size=6), st.integers(0, 4), st.integers(0, 6), st.sampled_from([6, 1 << 19]))
def test_buckets_of_any_head_and_piece(texts, n_words, n_pairs, piece):
    counts = Counter(w.encode() for t in texts for w in plain_words(t))
    words = [w for w, _ in counts.most_common(n_words) if len(w) <= rs.LONGEST]
    pairs = [(a, b) for a in words for b in words][:n_pairs]
    before, rs.PIECE = rs.PIECE, piece
    try:
        got = [Counter() for _ in texts]
        for found, owner, _ in Features(Head(words, pairs), 10_000).of_texts(texts):
            for b, o in zip(found.tolist(), owner.tolist()):
                got[o][b] += 1
    finally:
        rs.PIECE = before
    assert got == [plain_buckets(t) for t in texts]


def test_joined_crc():
    join, a = Joiner(20), b"some words"
    for b in (b"", b"x", b"abcdefghij", "日本".encode()):
        got = join(np.array([zlib.crc32(a)], np.uint32), np.array([zlib.crc32(b)], np.uint32), np.array([len(b)]))
        assert got[0] == zlib.crc32(a + b)


def test_frequent_values_are_kept_and_never_overcounted():
    frequent, rows = Frequent(4), ["a"] * 300 + [str(i) for i in range(700)]
    random.Random(1).shuffle(rows)
    for at in range(0, 1000, 10):
        frequent.add(rows[at : at + 10])
    frequent.cut()
    assert 300 - 1000 / 4 <= frequent.counts["a"] <= 300 and len(frequent.counts) <= 4


def plain_resample(docs, target, percent=5, least=20):
    source, aim = Counter(), Counter()
    for total, texts in ((source, [d[1] for d in docs]), (aim, target)):
        for text in texts:
            total.update(plain_buckets(text))
    S, T, out = sum(source.values()), sum(aim.values()), []
    gain = lambda b: math.floor(1000 * math.log((aim[b] + 1) * (S + 10_000) / ((source[b] + 1) * (T + 10_000))))
    for doc_id, text in docs:
        found = plain_buckets(text)
        weight = sum(gain(b) * n for b, n in found.items())
        h = int(sha(f"42:{'' if doc_id is None else doc_id}")[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, sum(found.values()), weight, weight + noise, None, len(plain_words(text)) >= least])
    able = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for place, row in enumerate(able[: len(able) * percent // 100], 1):
        row[4] = place
    return sorted((tuple(r[:5]) for r in out), key=repr)


def test_resampling_equals_plain(spark):
    draw = random.Random(3)
    text = lambda n: " ".join(draw.choice(["the", "a", "Cat", "naïve", "x9", "zebra!", "日本"]) for _ in range(n))
    docs = [(i, text(draw.choice([0, 5, 19, 20, 60]))) for i in range(120)]
    docs += [(500, None), (501, ""), (502, "-- !"), (None, text(30)), (7, docs[7][1]), (8, text(40)), (503, "w" * 3000 + " " + text(25))]
    target = [text(50), None, ""]
    source = spark.createDataFrame([(*d, 1, "x") for d in docs], DOCS + ", rank int, weight string").repartition(5)
    got = resample(source, spark.createDataFrame([(t,) for t in target], "text string"), percent=30)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_resample(docs, target, 30)


def test_resampling_of_empty_tables(spark):
    none, one = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a b c")], DOCS)
    assert resample(none, one).count() == 0
    assert [tuple(r) for r in resample(one, none).collect()] == plain_resample([(1, "a b c")], [])


# --- lines ----------------------------------------------------------------------------------------------


def plain_lines(docs, least=10):
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\f\r"))
    last = lambda i: math.inf if i is None else i
    first = {}
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            first[key(line)] = min(first.get(key(line), math.inf), last(doc_id))
    out = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least or last(doc_id) <= first[key(x)]]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


LINES = ["This line is shared", " this LINE is shared\t", "ÉCOLE normale", "école normale", "ninechars", "tencharsxx", "", "own", "日本語日本語日本語日"]


def test_lines_equal_plain(spark):
    draw = random.Random(5)
    docs = [(i * 3, "\n".join(draw.choices(LINES, k=draw.choice([1, 2, 5, 40])))) for i in range(60)]
    docs += [(i, f"header of all pages\nown line number {i}\n") for i in range(1000, 1300)]
    docs += [(2, None), (4, ""), (None, "header of all pages\nThis line is shared"), (None, "nobody else has this"), (6, "\n\n\n")]
    docs += [docs[5], docs[5], (docs[7][0], "header of all pages\r\nanother text of the same id"), (9999, "header of all pages")]
    source = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], DOCS + ", Keep string, n_lines int").repartition(6)
    got = dedup_lines(source)
    assert got.columns == ["doc_id", "text", "Keep", "n_lines", "n_dropped"]
    rows = [(r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in got.collect()]
    assert sorted(rows, key=repr) == plain_lines(docs)
    assert {r.Keep for r in got.collect()} == {"x"}


def test_bitmaps_are_runs(spark):
    shared = "a line that is shared"
    docs = spark.createDataFrame([(1, shared), (2, f"x\ny\n{shared}\n{shared}\nz\n{shared}"), (3, shared), (4, "alone")], DOCS)
    bitmaps = keep_bitmaps(docs)
    assert {(r.id, r.n_lines, tuple(map(tuple, r.keep))) for r in bitmaps.collect()} == {(2, 6, ((0, 2), (4, 1))), (3, 1, ())}
    assert {(r.doc_id, r.text) for r in apply_bitmaps(docs, bitmaps).collect()} == {(1, shared), (2, "x\ny\nz"), (3, ""), (4, "alone")}


def test_lines_of_an_empty_table(spark):
    assert dedup_lines(spark.createDataFrame([], DOCS)).count() == 0


# --- runs -----------------------------------------------------------------------------------------------


def plain_runs(words, least=24):
    found = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 3 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


@st.composite
def repetitive(draw):
    out = []
    for _ in range(draw(st.integers(0, 4))):
        inner = draw(st.lists(st.integers(0, 2), min_size=1, max_size=4))
        unit = inner * draw(st.integers(1, 8)) + draw(st.lists(st.integers(0, 3), max_size=5))
        out += (unit * draw(st.integers(1, 9)))[: draw(st.integers(1, 200))]
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(repetitive(), min_size=1, max_size=5), st.sampled_from([12, 24, 40]))
def test_runs_equal_plain(documents, least):
    assert find_runs([np.array(d, np.int64) for d in documents], least) == [plain_runs(d, least) for d in documents]


def test_runs_of_long_texts():
    draw = random.Random(2)
    unit = [draw.randrange(9) for _ in range(20_000)]
    assert find_runs([np.array(unit * 3 + unit[:5])]) == [[(0, 60_005, 20_000)]]
    assert find_runs([np.zeros(100_000, np.int64)]) == [[(0, 100_000, 1)]]
    assert find_runs([np.array(unit * 3)[:-1]])[0] == []


@settings(max_examples=50, deadline=None)
@given(st.permutations(range(13)), st.integers(0, 12), st.integers(0, 13), st.integers(0, 20))
def test_wavelet_tree(values, lo, hi, limit):
    hi = max(lo + 1, hi)
    tree, part = WaveletTree(np.array(values)), sorted(values[lo:hi])
    slices = np.array([lo]), np.array([hi])
    assert tree.below(*slices, np.array([limit]))[0] == sum(v < limit for v in part)
    assert [tree.nth(*slices, np.array([i]))[0] for i in range(len(part))] == part


def plain_op13(docs):
    out = []
    for doc_id, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(w)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(w)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else (None, None, None)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        out.append(
            (doc_id, len(runs), *best, best[1] * 1000 // best[2] if runs else None,
             sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
        )
    return sorted(out, key=repr)


def test_op13_equals_plain(spark, tmp_path):
    draw = random.Random(4)
    docs = [(i, " ".join(draw.choice(["a", "b", "c\td", "é", "\n"]) * draw.choice([1, 1, 3]) for _ in range(draw.choice([3, 40, 150])))) for i in range(150)]
    docs += [(300, None), (301, ""), (302, " \n"), (303, "x " * 5000), (304, "  \x1c y " * 30), (305, "one two\nthree " * 8)]
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 and bool(t) for i, t in docs) > 5
    spark.createDataFrame([(d, t, "x") for d, t in docs], DOCS + ", found string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op13_periodic_runs"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_op13(docs)


def test_runs_pass_columns_through(spark):
    docs = spark.createDataFrame([(1, "a b " * 20, "y"), (1, "a b " * 20, "y"), (None, None, None)], DOCS + ", Periodic string")
    found = periodic_runs(docs)
    assert found.columns == ["doc_id", "text", "periodic"]
    rows = {(r.doc_id, tuple(map(tuple, r.periodic.runs)), r.periodic.collapsed) for r in found.collect()}
    assert rows == {(1, ((0, 40, 2),), "a b"), (None, (), "")} and found.count() == 3
    assert periodic_runs(docs.limit(0)).count() == 0
