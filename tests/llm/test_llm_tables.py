"""WARC, vectors, near duplicates, chat and the pipeline against SQL or brute force."""

from __future__ import annotations

import gzip
import random
import re
import string
from itertools import combinations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from compare import duck_rows, spark_rows
from kerbflow.llm import minhash
from kerbflow.llm.chat import digest_conversations, format_conversations, plan_windows, read_turns
from kerbflow.llm.common import connected_classes
from kerbflow.llm.embeddings import link_vectors
from kerbflow.llm.minhash import keep_first, near_duplicates
from kerbflow.llm.queries import QUERIES, SQL
from kerbflow.llm.shingles import Darts, jaccard, parities, shingles
from kerbflow.llm.warc import base32_sha1, plan_revisits, read_warc, write_warc

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert spark_rows(QUERIES[name](spark, SF)) == duck_rows(SQL[name], SF)


def classes_of(ids, linked):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def test_connected_classes(spark):
    random.seed(4)
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(random.randint(200, 400), random.randint(200, 400)) for _ in range(120)]
    found = connected_classes(spark.createDataFrame(links, "a bigint, b bigint"), "test").collect()
    wanted = classes_of({x for a, b in links if a != b for x in (a, b)}, [x for x in links if x[0] != x[1]])
    same = lambda m: {frozenset(k for k in m if m[k] == v) for v in m.values()}
    assert same({r.id: r.root for r in found}) == same(wanted)


# --- WARC -----------------------------------------------------------------------------------------


def pages(spark):
    rows = [(1, "u1", "same"), (2, None, "same"), (3, "u\r\n3", "same"), (4, "u4", None), (5, "u5", ""), (6, "u6", "é😀\r\n\r\n x" * 30000)]
    rows += [(None, "u7", "same"), (None, "u8", "alone"), (3, "u3", "same"), (None, "u9", "twin"), (None, "u9", "twin")]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("sha", F.lit("clash"))


def test_warc_round_trip(spark, tmp_path):
    rows = read_warc(write_warc(plan_revisits(pages(spark)), str(tmp_path / "w"))).collect()
    assert len(rows) == 11
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in rows)
    assert kinds.count((3, "response", None)) == 2 and (1, "revisit", 3) in kinds and (0, "revisit", 3) in kinds
    assert (4, "revisit", 5) in kinds and kinds.count((0, "response", None)) == 3
    long = next(r for r in rows if r.page_id == 6)
    assert long.payload == "é😀\r\n\r\n x" * 30000 and long.payload_bytes == len(long.payload.encode())
    assert long.payload_digest == base32_sha1(long.payload.encode())
    assert next(r for r in rows if r.page_id == 1).payload_digest == base32_sha1(b"same")
    large = plan_revisits(pages(spark), least_bytes=5)
    assert large.where("refers_to is not null").count() == 0
    assert read_warc(write_warc(plan_revisits(pages(spark).limit(0)), str(tmp_path / "none"))).count() == 0


def test_record_ids_tell_records_apart(spark, tmp_path):
    """Only rows equal in id, url and payload share one; a revisit names the one record that it refers to."""
    planned = plan_revisits(pages(spark).withColumn("refers_url", F.lit("clash")))
    path = write_warc(planned.coalesce(1), str(tmp_path / "w")).first().path
    with gzip.open(path) as file:
        text = file.read().decode()
    ids = re.findall(r"WARC-Record-ID: (\S+)", text)
    assert len(ids) == 11 and len(set(ids)) == 10
    records = {r.record_id: r for r in read_warc(spark.createDataFrame([(path,)], "path string")).collect()}
    meant = re.findall(r"WARC-Refers-To: (\S+)", text)
    assert sorted((records[i].page_id, records[i].url) for i in meant) == [(3, "u3")] * 3 + [(5, "u5")]


def test_warc_members_and_damage(spark, tmp_path):
    manifest = write_warc(plan_revisits(pages(spark)).coalesce(1), str(tmp_path / "w"))
    path = manifest.first().path
    with gzip.open(path) as file:
        assert file.read().count(b"WARC/1.1\r\n") == 11
    data = open(path, "rb").read()
    assert data.count(b"\x1f\x8b\x08") >= 11
    for name, bad in (("cut", data[:-9]), ("other", gzip.compress(gzip.decompress(data).replace(b"alone", b"alonE")))):
        (tmp_path / name).write_bytes(bad)
        with pytest.raises(Exception, match="record|digest|states"):
            read_warc(spark.createDataFrame([(str(tmp_path / name),)], "path string")).collect()


# --- vectors --------------------------------------------------------------------------------------


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 16))
    rows = [base[i % 40] + rng.normal(size=16) * (0.02 + 0.05 * (i % 3)) for i in range(700)] + [base[0] * 3] * 5
    vectors = [(i, v.tolist()) for i, v in enumerate(rows)]
    odd = [(1000, None), (1001, []), (1002, [0.0] * 16), (1003, [float("nan")] + [1.0] * 15), (1004, [None] + [1.0] * 15)]
    odd += [(1005, [float("inf")] + [1.0] * 15), (1006, [1e-300] * 16), (1007, [1e300] * 16), (None, [1.0] * 16)]
    df = spark.createDataFrame(vectors + odd, "vec_id bigint, embedding array<double>").withColumn("cell", F.lit("clash"))
    found = {r.vec_id: r for r in link_vectors(df).collect()}
    unit = np.array(rows) / np.linalg.norm(rows, axis=1)[:, None]
    hits = unit @ unit.T >= 0.95
    np.fill_diagonal(hits, False)
    wanted = classes_of(range(len(rows)), [(int(a), int(b)) for a, b in zip(*np.nonzero(hits), strict=True)])
    counted = sum(found[i].n_links for i in range(len(rows)))
    assert 0.98 * hits.sum() <= counted <= hits.sum()
    assert all(found[i].component_id == wanted[i] and found[i].kept == (wanted[i] == i) for i in wanted)
    for i in (1000, 1001, 1002, 1003, 1004, 1005):
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (0, i, True)
    assert (found[1006].n_links, found[1007].component_id, found[None].component_id) == (2, 1006, 1006)
    assert link_vectors(df.limit(0)).count() == 0
    assert link_vectors(df.where("vec_id = 1000")).first().kept


def test_links_beyond_the_sample_are_found(spark):
    """A hot cluster and twins near the threshold, hardly any pair of which falls into the sample."""
    made = np.random.default_rng(5)
    unit = lambda v: v / np.sqrt((v**2).sum(axis=1, keepdims=True))
    base = unit(made.standard_normal((6000, 64)))
    aside = made.standard_normal(base.shape)
    aside = unit(aside - (aside * base).sum(axis=1, keepdims=True) * base)
    hot = unit(base[:1] + 0.001 * made.standard_normal((400, 64)))
    rows = np.concatenate([base, 0.955 * base + np.sqrt(1 - 0.955**2) * aside, hot])
    links = (rows @ rows.T >= 0.95).sum(axis=1) - 1
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id bigint, embedding array<double>")
    found = {r.vec_id: r.n_links for r in link_vectors(df, sample=600).collect()}
    assert all(found[i] <= n for i, n in enumerate(links))
    twins = [i for i in range(12000) if i % 6000]
    assert sum(found[i] for i in twins) >= 0.99 * sum(int(links[i]) for i in twins)
    assert sum(found.values()) >= 0.99 * links.sum()


# --- near duplicates ------------------------------------------------------------------------------


def edited(words, edits, rng):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(9)
    texts = []
    for group in range(6):
        words = [f"w{rng.randrange(400)}" for _ in range(120)]
        texts += [edited(words, rng.randrange(0, 8), rng) for _ in range(30 if group else 150)]
    chain = [f"c{i}" for i in range(200)]
    texts += [" ".join(chain[i * 3 : i * 3 + 60]) for i in range(12)]
    texts += ["few words", "Few, words!", "x", "", None, "...", "few words"]
    rows = list(enumerate(texts)) + [(None, texts[0]), (3, texts[3])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("print", F.lit("clash")).withColumn("bands", F.lit(1))
    found = near_duplicates(df).collect()
    sets = [shingles(t)[0] for t in texts]
    links = [(a, b) for a, b in combinations(range(len(texts)), 2) if jaccard(sets[a], sets[b]) >= 0.8]
    wanted = classes_of(range(len(texts)), links)
    assert len(found) == len(rows)
    for row in found:
        assert row.class_id == (wanted[row.doc_id] if row.doc_id is not None else 0)
    kept = keep_first(df, near_duplicates(df))
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(wanted.values()))
    assert near_duplicates(df.limit(0)).count() == 0


def test_links_that_no_centre_shows_are_kept(spark):
    """Texts on one common passage share buckets; only neighbours in a group are near duplicates, few of them centres."""
    rng = random.Random(11)
    common = [f"p{i}" for i in range(90)]
    texts = []
    for group in range(60):
        own = [f"g{group}x{i}" for i in range(30)]
        texts += [" ".join(common + own), " ".join(common + own[:22] + [f"e{group}y{i}" for i in range(8)])]
    rng.shuffle(texts)
    sets = [shingles(t)[0] for t in texts]
    links = [(a, b) for a, b in combinations(range(len(texts)), 2) if jaccard(sets[a], sets[b]) >= 0.8]
    wanted = classes_of(range(len(texts)), links)
    assert 50 < len(set(wanted.values())) < len(texts)
    found = near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.class_id for r in found} == wanted


def test_rounds_that_add_few_links_end(spark, monkeypatch):
    """Copies are linked at once; a chain, of which a round finds some links, is left to the comparison after the rounds."""
    texts = [" ".join([*(f"w{i}" for i in range(40)), f"copy{n}"]) for n in range(500)]
    chain = [f"c{i}" for i in range(800)]
    texts += [" ".join([*(f"p{i}" for i in range(60)), *chain[i * 6 : i * 6 + 44]]) for i in range(120)]
    random.Random(12).shuffle(texts)
    sets = [shingles(t)[0] for t in texts]
    links = [(a, b) for a, b in combinations(range(len(texts)), 2) if texts[a][0] == texts[b][0] and jaccard(sets[a], sets[b]) >= 0.8]
    wanted = classes_of(range(len(texts)), links)
    assert len(set(wanted.values())) == 2
    written, labels = minhash.written, []
    monkeypatch.setattr(minhash, "written", lambda df, label: labels.append(label) or written(df, label))
    monkeypatch.setattr(minhash, "FEW", 10, raising=False)
    found = near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), bands=8, rows=1).collect()
    assert {r.doc_id: r.class_id for r in found} == wanted
    assert labels.count("minhash-pairs") <= 3


def test_parities_never_exceed_the_symmetric_difference():
    rng = np.random.default_rng(3)
    for size, changed in ((1, 1), (40, 5), (300, 60), (5000, 900), (20000, 20000)):
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        b = np.unique(np.concatenate([a[changed:], rng.integers(0, 2**63, changed).astype(np.uint64)]))
        differ = sum(int(x).bit_count() for x in (parities(a) ^ parities(b)).view(np.uint64))
        true = len(np.setxor1d(a, b))
        assert differ <= true and (true > 200 or differ >= 0.8 * true)
    assert not parities(a[:0]).any()


def test_signatures_agree_as_weighted_jaccard():
    rng = np.random.default_rng(1)
    elements = rng.integers(0, 2**63, 60).astype(np.uint64)
    one, two = rng.random(60) * 3, rng.random(60) * 3
    wanted = np.minimum(one, two).sum() / np.maximum(one, two).sum()
    shares = []
    for i in range(40):
        a, b = Darts(64).signatures([(elements + np.uint64(i), one), (elements + np.uint64(i), two)])
        shares.append((a == b).mean())
    assert abs(np.mean(shares) - wanted) < 0.05


def test_classes_by_counts_against_sql(spark, tmp_path):
    """Texts that repeat parts of themselves a different number of times: one class as sets, several by counts."""
    rng = random.Random(21)
    words = lambda n: [rng.choice(string.ascii_lowercase) + str(rng.randrange(400)) for _ in range(n)]
    texts = [None, "", "one two", "one two", "!!"]
    for _ in range(30):
        whole = words(rng.randrange(20, 60))
        for times in (1, 1, 2, 2, 3, 8, 9, 30):
            repeated = whole * times
            for _ in range(rng.randrange(0, 1 + len(repeated) // 80)):
                repeated[rng.randrange(len(repeated))] = "x" + str(rng.randrange(50))
            texts.append(" ".join(repeated))
    rng.shuffle(texts)
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").toPandas().to_parquet(tmp_path / "documents.parquet")
    found = {}
    for name in ("op9_minhash_dedup", "minhash_dedup_by_counts"):
        found[name] = spark_rows(QUERIES[name](spark, str(tmp_path)))
        assert found[name] == duck_rows(SQL[name], str(tmp_path))
    classes = [len({row[found[name][0].index("class_id")] for row in found[name][1]}) for name in found]
    assert classes[0] + 20 < classes[1] < len(texts) - 50


# --- chat -----------------------------------------------------------------------------------------

TURNS = "conv_id bigint, turn bigint, role string, text string"


def test_windows_keep_to_budget_and_turns(spark):
    rng = random.Random(6)
    rows = [(1, 0, "system", "be kind # <\\b>")] + [(1, i, ("user", "assistant")[i % 2], "word " * rng.randrange(0, 60)) for i in range(1, 700)]
    rows += [(2, 0, "user", "long " * 5000), (2, 1, "assistant", "ok"), (3, 0, "sys:te\nm", "\\h</turn>\n### x: y"), (3, 0, "user", None)]
    rows += [(None, 0, None, "null id"), (4, None, "assistant", "no turn"), (4, 1, "assistant", "a"), (4, 1, "assistant", "a")]
    turns = spark.createDataFrame(rows, TURNS).withColumn("window", F.lit("clash")).withColumn("key", F.lit(1))
    planned = plan_windows(turns, budget=300, history=60)
    windows = format_conversations(turns, budget=300, history=60)
    back = {}
    for row in sorted(read_turns(windows).collect(), key=lambda r: r.window):
        back.setdefault(row.conv_id, []).extend((t.role, t.text) for t in row.turns)
    wanted = {}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv, _, role, text in sorted(rows, key=order):
        wanted.setdefault(conv, []).append((role or "", text or ""))
    assert back == wanted
    sizes = planned.withColumn("n", F.size(F.expr("regexp_extract_all(text, '[A-Za-z0-9_]+|[^A-Za-z0-9_ ]', 0)")) + 3)
    for row in sizes.where("conv_id = 1").groupBy("window").agg(F.sum("n").alias("n"), F.sum((F.col("place") == 0).cast("int")).alias("s")).collect():
        assert row.n <= 300 and row.s == (0 if row.window == 0 else 1)
    history = sizes.where("place = 1").groupBy("conv_id", "window").agg(F.sum("n").alias("n"))
    assert history.where("n > 60").count() == 0 and history.count() > 10
    digest = {r.conv_id: r for r in digest_conversations(windows).collect()}
    assert digest[1].loss_chars == sum(len(t) for _, _, r, t in rows[:700] if r == "assistant")
    assert digest[4].n_turns == 3 and digest[4].loss_chars == len("no turn") + 2
    assert digest_conversations(format_conversations(turns.limit(0))).count() == 0


def greedy_windows(sizes, system, budget, history):
    """(window, place, nth) of one conversation, turn after turn."""
    at = [sum(sizes[:i]) for i in range(len(sizes))]
    room = max(1, budget - history - (sizes[0] if system else 0))
    starts, full = [], None
    for i, size in enumerate(sizes):
        border = i and at[i] // (32 * room) != at[i - 1] // (32 * room)
        if full is None or border or at[i] + size > full:
            starts.append(i)
            full = at[i] + (room if i else budget)
    rows = set()
    for k, s in enumerate(starts):
        end = starts[k + 1] if k + 1 < len(starts) else len(sizes)
        rows |= {(s, 2, i + 1) for i in range(s, end)}
        rows |= {(s, 1, i + 1) for i in range(bool(system), s) if at[s] - at[i] <= history}
        rows |= {(s, 0, 1)} if system and s else set()
    return rows


@pytest.mark.parametrize(("budget", "history"), [(300, 60), (100, 20), (40, 39)])
def test_windows_fill_their_budget_by_given_counts(spark, budget, history):
    """Token counts of a column, among them null, none and some above the budget, against a walk turn by turn."""
    rng = random.Random(budget)
    counts = {c: [rng.choice([None, 0, 1, 5, 30, rng.randrange(1, 80), rng.choice([9, 900])]) for _ in range(n)] for c, n in enumerate((1, 2, 700, 1500))}
    rows = [(c, i, "system" if i == 0 and c % 2 else "user", f"t{i}", n) for c, sizes in counts.items() for i, n in enumerate(sizes)]
    turns = spark.createDataFrame(rows, TURNS + ", n int").repartition(5)
    found = {}
    for r in plan_windows(turns, budget, history, tokens="n").collect():
        assert r.text == f"t{r.nth - 1}"
        assert (r.window, r.place, r.nth) not in found.setdefault(r.conv_id, set())
        found[r.conv_id].add((r.window, r.place, r.nth))
    for c, sizes in counts.items():
        assert found[c] == greedy_windows([max(1, n or 0) for n in sizes], bool(c % 2), budget, history)


def test_long_conversations_against_sql(spark, tmp_path):
    rng = random.Random(3)
    rows = [
        (c, i, "system" if i == 0 and c % 2 else ("user", "assistant")[i % 2], "word, # <b\\\\ " * rng.randrange(0, 40) + rng.choice(["", "x " * 600 * (c % 3)]))
        for c, n in ((1, 900), (2, 300), (5, 40), (6, 1))
        for i in range(n)
    ]
    spark.createDataFrame(rows, TURNS).repartition(3).write.parquet(str(tmp_path / "turns"))
    duckdb.execute(f"COPY (SELECT * FROM read_parquet('{tmp_path}/turns/*.parquet')) TO '{tmp_path}/conversations.parquet'")
    found = spark_rows(QUERIES["op10_chat_format"](spark, str(tmp_path)))
    assert len(found[1]) == 5 and found == duck_rows(SQL["op10_chat_format"], str(tmp_path))


# --- pipeline -------------------------------------------------------------------------------------


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(12)
    lang = {"en": "the and of to in that is was for with".split(), "de": "der die und das nicht ist ein zu mit von".split()}
    text = lambda k, n=60: " ".join(rng.choice(lang[k]) + rng.choice(["", "", "er", "ing"]) for _ in range(n))
    rows = [(i, text("en" if i % 2 else "de"), "en" if i % 2 else "de", "s", 1) for i in range(40)]
    item = "what is the capital city of the old northern kingdom by the sea"
    rows += [(100, rows[0][1], "de", "s", 1), (101, rows[1][1] + " end", "en", "s", 1), (1, rows[1][1], "en", "s", 1)]
    rows += [(102, f"{text('en')} {item.upper()}! {text('en')}", "en", "s", 1), (103, text("en") + " token=abcdefgh12", "en", "s", 1)]
    rows += [(104, None, "en", "s", 1), (105, "12 34 !!", "en", "s", 1), (106, "жзик " * 30, None, None, None), (None, text("de"), "de", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(found) == {*range(40), 103, None}
    assert all(r.round_trip for r in found.values())
    step = corpus_pipeline.secrets_stage(spark, docs, str(tmp_path)).where("doc_id = 103").first()
    assert "[SECRET]" in step.text and "abcdefgh12" not in step.text and step.n_chars == len(step.text)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), str(tmp_path)).columns == docs.columns
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_clean_documents_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert corpus_pipeline.language_stage(spark, docs, SF).count() == docs.count()
    assert corpus_pipeline.secrets_stage(spark, docs, SF).count() == docs.count()


def test_languages_that_were_not_learned_go(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    finnish = "Pohjoisen talvi oli tullut aikaisin, ja järven jäällä kulki yksinäinen mies, joka etsi kadonnutta koiraansa. "
    finnish += "Metsän reunassa paloi pieni valo, mutta kukaan ei vastannut hänen huutoonsa, vaikka yö oli aivan hiljainen."
    polish = "Wczesnym rankiem chłopiec wyszedł z domu, żeby zobaczyć, czy rzeka już zamarzła. Na moście spotkał starego "
    polish += "rybaka, który opowiedział mu o dawnych czasach, kiedy w tej okolicy mieszkało jeszcze dużo więcej ludzi."
    rng = random.Random(9)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    strange = [finnish, polish, " ".join(letters(rng.randint(3, 9)) for _ in range(60)), letters(300)]
    assert docs.where("lang in ('fi', 'pl')").count() == 0
    rows = docs.union(spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(strange)], "doc_id bigint, text string, lang string"))
    kept = corpus_pipeline.language_stage(spark, rows, SF)
    assert kept.where("doc_id < 0").count() == 0
    assert kept.count() >= 0.995 * docs.count()


def test_which_of_rows_with_one_id_and_text_stays(spark):
    rows = [(1, "one two three four five six", "a", n) for n in (5, 3, 9)] + [(2, "", "b", 1), (2, "", "c", 1)]
    kept = []
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id bigint, text string, source string, n int").repartition(3)
        kept.append(sorted(keep_first(docs, near_duplicates(docs)).collect()))
    assert kept[0] == kept[1] and [r.doc_id for r in kept[0]] == [1, 2]


def test_sketches_of_a_table_in_one_file_are_dealt_over_tasks(spark, tmp_path, monkeypatch):
    from kerbflow.llm import minhash, queries

    texts = [(n, " ".join(f"w{n // 2}x{k}" for k in range(30))) for n in range(60)]
    spark.createDataFrame(texts, "doc_id bigint, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    files, written = {}, minhash.written

    def watched(df, label):
        done = written(df, label)
        files.setdefault(label, len(done.inputFiles()))
        return done

    monkeypatch.setattr(minhash, "written", watched)
    rows = queries.minhash_dedup_by_counts(spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.class_id) for r in rows} == {(n, n - n % 2) for n in range(60)}
    assert files["minhash-sketch"] > 1
