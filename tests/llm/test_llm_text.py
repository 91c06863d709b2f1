"""Token counts, SentencePiece, token files, language, decontamination and secrets against brute force."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2
from tokenizers import Tokenizer

from kerbflow.llm import langid
from kerbflow.llm.decontaminate import Matcher, find_leaks, item_blocks, plain
from kerbflow.llm.langid import LanguageModel, fold, identify_language, sample_texts, train
from kerbflow.llm.pieces import Pieces
from kerbflow.llm.queries import QUERIES
from kerbflow.llm.secrets import ASSIGN, entropy_units, redact_secrets, scan_secrets, spans_text
from kerbflow.llm.sentencepiece_stream import decode_pieces, encode_checked, encode_pieces
from kerbflow.llm.token_blocks import pack_block, read_token_files, unpack_block, write_token_files
from kerbflow.llm.token_counts import count_tokens

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string"
ODD = [None, "", " ", "a", "  two  spaces\n\tand\r\nlines ", "日本語 x😀y é́ ﬁ", "\x00\x01", "word " * 3000, "z" * 5000]


@pytest.fixture(scope="module")
def texts(spark):
    return [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]


def unigram_model(folder, score):
    """The public pieces as a unigram model of other scores."""
    model = sentencepiece_model_pb2.ModelProto()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1
    for piece in model.pieces:
        piece.score = score(piece.score)
    path = folder / "unigram.model"
    path.write_bytes(model.SerializeToString())
    return str(path)


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    """Scores that single precision can add up exactly over some hundred pieces, for the library to follow."""
    return unigram_model(tmp_path_factory.mktemp("model"), lambda score: max(score, -40000.0))


def odd_docs(spark):
    rows = [(i, t, "en") for i, t in enumerate(ODD)] + [(None, "no id", None), (3, "a", "en"), (3, "a", "en")]
    return spark.createDataFrame(rows, DOCS)


# --- pieces ---------------------------------------------------------------------------------------


def test_pieces_follow_the_library(unigram, texts):
    pieces, library = Pieces(unigram), sentencepiece.SentencePieceProcessor(model_file=unigram)
    for text in [*(t[:900] for t in texts), *(t[:900] for t in ODD if t)]:
        ids = library.encode(text)
        assert pieces.encode(text).tolist() == ids
        assert pieces.count(text) == len(ids)


def test_whole_texts_follow_the_library(tmp_path, texts):
    """Scores in steps of 1/64 down to -16, whose sums are exact over whole texts and often tie."""
    model = unigram_model(tmp_path, lambda score: max(-16.0, round(score / 40) / 64))
    pieces, library = Pieces(model), sentencepiece.SentencePieceProcessor(model_file=model)
    rng = random.Random(8)
    dense = ["".join(rng.choice("aeinsthlor") for _ in range(8000)), "ab" * 4000, "\U0001f600x" * 900]
    whole = [t for t in [*texts, *(t for t in ODD if t), *dense] if len(t) < 15000]
    assert sum(len(t) > 2000 for t in whole) > 10
    for text in whole:
        ids = library.encode(text)
        assert pieces.encode(text).tolist() == ids
        assert list(pieces.stream(pieces.normalise(text))) == ids
        assert pieces.count(text) == len(ids)


def test_stream_holds_a_bounded_window(texts):
    pieces = Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(9)
    for letters in ("aeinsthlor", "aeinst\U0001f600\n"):
        runs = list(pieces.commits("".join(rng.choice(letters) for _ in range(50_000))))
        assert len(runs) > 400 and max(map(len, runs)) < 8 * pieces.longest


def best_score(pieces, text):
    best = [0.0] + [float("-inf")] * len(text)
    scores = {text[e - n + 1 : e + 1]: s for e, (n, _, s) in pieces.automaton.iter(text)}
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - pieces.longest), end):
            if text[start:end] in scores:
                best[end] = max(best[end], best[start] + scores[text[start:end]])
        best[end] = max(best[end], best[end - 1] + pieces.unknown_score)
    return best[-1]


def test_stream_commits_the_best_path(texts):
    pieces = Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    for text in [*texts[:20], "ab" * 300, "\n" * 200]:
        normal = pieces.normalise(text)
        ids = list(pieces.stream(normal))
        assert ids == pieces.encode(text).tolist()
        assert len(ids) == pieces.count_span(normal)
        if "\n" not in text:
            scores = {i: s for _, (_, i, s) in pieces.automaton.iter(normal)}
            assert sum(scores[i] for i in ids if i in scores) == best_score(pieces, normal)


def test_round_trip_and_odd_rows(spark, texts):
    docs = odd_docs(spark).withColumn("ids", F.lit("clash")).withColumn("N_TOKENS", F.lit("clash"))
    rows = decode_pieces(encode_pieces(count_tokens(docs))).collect()
    assert len(rows) == len(ODD) + 3
    for row in rows:
        assert row.decoded == (row.text or "")
        assert row.n_tokens == len(row.ids)
    checked = encode_checked(docs.withColumn("round_trip", F.lit(1)))
    assert checked.where("round_trip").count() == len(rows) and [r.ids for r in checked.collect()] == [r.ids for r in rows]
    empty = docs.limit(0)
    assert decode_pieces(encode_pieces(count_tokens(empty))).count() == 0


# --- token files ----------------------------------------------------------------------------------


def test_blocks_round_trip():
    random.seed(3)
    for n in (1, 2, 129, 4096):
        for top in (0, 1, 300, 2**32 - 1):
            ids = np.array([random.randint(0, top) for _ in range(n)], dtype=np.uint32)
            ids[random.randrange(n)] = 2**32 - 1
            assert (unpack_block(pack_block(ids)) == ids).all()


def test_token_files_against_the_tokenizer(spark, tmp_path, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tricky = ["it's WE'LL <|endoftext|> a<|endoftext|>b", "ΑΣ Σ", "a\u00a0b\x1cc", "é́É ÿŸ ß", "12ab34 -- a.b,c"]
    rows = [(1000 - i, t) for i, t in enumerate([*texts, *ODD, *tricky])] + [(None, "no id"), (5, "same"), (5, "same")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("start", F.lit("clash"))
    manifest = write_token_files(docs, str(tmp_path / "tokens"), block=64)
    found = sorted(read_token_files(manifest, ids=True).collect(), key=lambda r: r.place)
    assert len(found) == len(rows)
    start, keys = 0, [(r.doc_id is not None, r.doc_id) for r in found]
    assert keys == sorted(keys)
    known = {}
    for key, text in rows:
        known.setdefault(key, []).append([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1])
    for n, row in enumerate(found):
        assert row.place == n and row.start == start and row.n_tokens == len(row.ids)
        assert row.ids_crc32 == zlib.crc32(np.array(row.ids, dtype="<u4").tobytes())
        known[row.doc_id].remove(row.ids)
        start += row.n_tokens
    assert not any(known.values())
    assert read_token_files(write_token_files(docs.limit(0), str(tmp_path / "none"))).count() == 0


# --- language -------------------------------------------------------------------------------------


def phrases(text, corpus):
    number = at = 0
    while at < len(text):
        end = at
        while end < len(text) and any(text[at : end + 1] in c for c in corpus):
            end += 1
        number, at = number + 1, max(end, at + 1)
    return number


def test_phrases_against_substring_search(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    samples = {k: v[:4] for k, v in sample_texts(docs).items()}
    model = LanguageModel.fit(samples)
    for row in docs.limit(25).collect():
        text = row.text[:400]
        found = model.predict([text])[0]
        counts = [phrases(fold(text), [fold(t) for t in samples[lang]]) for lang in model.languages]
        assert found["lang"] == model.languages[int(np.argmin(counts))]
        assert found["phrases"] == min(counts) / len(fold(text))


@pytest.mark.parametrize("block", [1, 7, 100, 2048])
def test_whole_texts_are_parsed_whatever_the_block(spark, monkeypatch, block):
    """Borders of blocks change nothing: texts of several blocks against a parse letter by letter."""
    monkeypatch.setattr(langid, "BLOCK", block)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = LanguageModel.fit({k: v[:4] for k, v in sample_texts(docs).items()})
    texts = [r.text for r in docs.where("length(text) > 2048").orderBy(F.length("text")).limit(3 if block == 1 else 12).collect()]
    texts += ["", None, "ab" * 3000, texts[0][:2048], texts[0][:2049]]
    assert max(len(fold(t)) for t in texts if t) > 2 * 2048

    def plainly(text, root):
        state, number = root, 0
        for c in fold(text):
            code = int(model.letters[ord(c)])
            to = int(model.table[state * model.width + code])
            if to < 0:
                number += state != root
                to = int(model.table[root * model.width + code])
                if to < 0:
                    number, to = number + 1, root
            state = to
        return number + (state != root)

    for text, found in zip(texts, model.predict(texts)):
        if text:
            counts = [plainly(text, int(root)) for root in model.roots]
            assert found["phrases"] == min(counts) / len(fold(text)) and found["lang"] == model.languages[int(np.argmin(counts))]


def test_ranking_in_parts_chooses_the_smallest_hashes(spark):
    docs = spark.range(3000).select(F.concat(F.lit("text "), F.col("id")).alias("text"), F.lit("xx").alias("lang"))
    got = {r.text for r in langid.chosen_texts(docs, 40, 4000).collect()}
    assert got == {r.text for r in docs.orderBy(F.xxhash64("text")).limit(40).collect()}


def test_held_out_accuracy(spark):
    rows = QUERIES["op5_language_id"](spark, "/root/testdata/sf0.01").where("held_out")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    hits = rows.join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert hits > 0.97
    assert rows.where("score < 0 or score > 1").count() == 0


def test_language_of_odd_rows(spark):
    model = train(spark.createDataFrame([(i, "the cat and the hat", "en") for i in range(9)], DOCS))
    found = {r.doc_id: r.language for r in identify_language(odd_docs(spark).withColumn("language", F.lit(1)), model).collect()}
    assert [found[i].lang for i in (0, 1, 2, 6)] == ["und"] * 4
    assert found[3].lang == "en" and found[3].score == 1.0
    nothing = train(odd_docs(spark).limit(0))
    assert {r.language.lang for r in identify_language(odd_docs(spark), nothing).collect()} == {"und"}
    assert identify_language(odd_docs(spark).limit(0), model).count() == 0


def test_copies_count_once_in_the_sample(spark):
    texts = [f"text number {i} of the sample" for i in range(400)]
    smallest = spark.createDataFrame([(t,) for t in texts], "text string").orderBy(F.xxhash64("text")).first().text
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts + [smallest] * 500)], DOCS)
    assert len(set(sample_texts(docs)["en"])) == 200


def test_languages_of_long_texts_are_learned(spark):
    long = {i: f"{i} viele lange seiten " * 400 for i in range(5)}
    docs = spark.createDataFrame([(i, t, "de") for i, t in long.items()] + [(9, "a short text", "en"), (10, "b " * 9000, "en")], DOCS)
    found = sample_texts(docs)
    assert set(found) == {"de", "en"}
    assert len(found["de"]) == 5 and all(len(t) == 4000 and any(t in whole for whole in long.values()) for t in found["de"])
    assert found["en"][0] == "a short text" and len(found["en"]) == 2


def test_every_labelled_text_is_learned_from(spark):
    rows = [(i, f"common word{'abcdefghij'[i % 10]} {'xyz'[i % 3] * 3} 12", "en") for i in range(900)] + [(900, "langeswort " * 9000, "de")]
    docs = spark.createDataFrame([*rows, (901, None, "en"), (902, "lost", None), (903, "字" * 70, "zh")], DOCS)
    counts = {(r.lang, r.word): r.n for r in langid.word_counts(docs.repartition(7)).collect()}
    assert counts["en", "common"] == 900 and counts["en", "worda"] == 90 and counts["en", "zzz"] == 300
    assert counts["de", "langeswort"] == 9000 and counts["zh", "字" * 32] == 2 and counts["zh", "字" * 6] == 1 and len(counts) == 17
    words = langid.frequent_words(langid.word_counts(docs), 21)
    assert words == {"de": ["langeswort"], "en": ["common", "xxx", "yyy", "zzz"]}


def test_bounds_are_measured_on_every_held_out_text(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"the cat and the hat {i} " * (400 if i % 2 else 40), "en") for i in range(3000)], DOCS)
    model, asked = train(docs), []
    plain = langid.identify_language
    monkeypatch.setattr(langid, "identify_language", lambda parts, *a: asked.append(parts.where("place = 0").agg(F.count("*"), F.max(F.length("part"))).first()) or plain(parts, *a))
    bounds = langid.phrase_bounds(docs, model, 0.7)
    held = docs.where(langid.held_out())
    assert [tuple(a) for a in asked] == [(held.count(), held.agg(F.max(F.length("text"))).first()[0])]
    assert set(bounds) == {("en", n) for n in langid.LENGTHS} and all(0 < b < 0.7 for b in bounds.values())


# --- decontamination ------------------------------------------------------------------------------


def distances(text, item):
    """Least edit distance of the item to a part of the text."""
    before = list(range(len(item) + 1))
    least = before[-1]
    for letter in text:
        now = [0]
        for j, other in enumerate(item, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (letter != other)))
        before, least = now, min(least, now[-1])
    return least


def test_matcher_against_full_edit_distance():
    random.seed(11)
    items = [(i, " ".join("".join(random.choices("abcd", k=random.randint(1, 6))) for _ in range(12))) for i in range(6)]
    matcher = Matcher(items, 0.1)
    for _ in range(150):
        number, text = random.choice(items)
        letters = list(text)
        for _ in range(random.randint(0, len(text) // 7)):
            at = random.randrange(len(letters))
            letters[at : at + 1] = random.choice([[], ["a"], [letters[at], "b"]])
        body = plain("some words " + "".join(letters) + " and more")
        wanted = {i: distances(body, t) for i, t in items}
        wanted = {i: d for i, d in wanted.items() if d <= int(0.1 * len(dict(items)[i]))}
        assert {i: d for i, _, _, d in matcher.find(body)} == wanted


def test_leaks_of_odd_rows_and_blocks(spark):
    items = spark.createDataFrame(
        [(1, "Alpha beta gamma delta epsilon."), (2, None), (3, ""), (None, "one two three four five six"), (4, "zeta eta theta iota")],
        "item_id bigint, text string",
    )
    docs = odd_docs(spark).union(
        spark.createDataFrame([(50, "X ALPHA!! beta GAMMA delta, epsilon", "en"), (51, "one two three four five six", "en")], DOCS)
    )
    docs = docs.withColumn("leaks", F.lit("clash"))
    for block_chars in (10, 10**6):
        found = {r.doc_id: [leak.item_id for leak in r.leaks] for r in find_leaks(docs, items, block_chars=block_chars).collect()}
        assert {k: v for k, v in found.items() if v} == {50: [1], 51: [None]}
    both = docs.select(F.lit("One two three four five six; alpha beta gamma delta epsilon").alias("text")).limit(1)
    twice = items.union(items)  # repeated items count once, null ids come first
    for block_chars in (10, 10**6):
        assert [leak.item_id for leak in find_leaks(both, twice, block_chars=block_chars).first().leaks] == [None, 1]
    assert find_leaks(docs, items.limit(0)).where(F.size("leaks") > 0).count() == 0
    assert find_leaks(docs.limit(0), items).count() == 0


def test_leaks_by_many_blocks_equal_one_block(spark):
    """All columns and rows, repeated ones too, whatever the number of blocks; blocks keep to their bound."""
    rng = random.Random(4)
    words = lambda n: " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(n))
    texts = [words(rng.randint(6, 14)) for _ in range(120)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string").repartition(4)
    rows = [(i % 70, " ".join([words(8), *rng.sample(texts, i % 4), words(5)]).replace("a", "a" if i % 3 else "A"), i) for i in range(90)]
    rows += [(None, None, 1), (3, "", 2), (3, "", 2), (5, texts[0] + " " + texts[0], 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, `row` int").withColumn("Leaks", F.lit(0)).withColumn("doc", F.lit("x"))
    stored, names = item_blocks(items, 400)
    assert stored.count() == 120 and len(names) > 10
    assert all(r.n <= 400 + 14 * 8 for r in stored.groupBy("block").agg(F.sum(F.length("body")).alias("n")).collect())
    one, many = find_leaks(docs, items), find_leaks(docs, items, block_chars=400)
    assert one.columns == many.columns == ["doc_id", "text", "row", "doc", "leaks"]
    assert sorted(map(repr, one.collect())) == sorted(map(repr, many.collect()))
    assert one.where(F.size("leaks") > 1).count() > 30 and one.count() == len(rows)


# --- secrets --------------------------------------------------------------------------------------


def base_spans(text):
    found = []
    for rank, (kind, pattern, keep) in enumerate(
        (
            ("assign", ASSIGN, lambda m: len(m.group(2)) >= 8),
            ("access", r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 16),
            ("hex", r"[0-9a-f]+", lambda m: len(m.group()) >= 32),
        )
    ):
        found += [(m.start(), m.end(), rank, kind) for m in re.finditer(pattern, text) if keep(m)]
    return sorted(found)


def test_secrets_against_python(spark):
    random.seed(7)
    bits = ["password", "Secret : ", "token=", "api_key", "'", '"', ":", "AKIA", "ABCDEFGH1234", "é😀", " ", "deadbeef" * 4, "abc12345", "\n"]
    texts = ["".join(random.choices(bits, k=random.randint(0, 12))) for _ in range(300)]
    texts += ["token=abcdefgh1 " * 700, "x" * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").withColumn("secrets", F.lit(0))
    for row in scan_secrets(docs).collect():
        assert [tuple(s) for s in row.secrets if s.rank < 3] == base_spans(texts[row.doc_id])


def test_entropy_spans_and_allow_list(spark):
    random.seed(2)
    token = "".join(random.sample("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", 40))
    texts = [f"see {token} here", "see 123e4567-e89b-12d3-a456-426614174000 here", "x1" * 30, "plainwordsplainwordsplainwords", token[:20], None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {r.doc_id: [(s.start, s.end, s.kind) for s in r.secrets] for r in scan_secrets(docs).collect()}
    assert found == {0: [(4, 44, "entropy_base64")], 1: [], 2: [], 3: [], 4: [], 5: []}


def test_spans_are_ordered_by_start_and_then_kind(spark):
    docs = spark.createDataFrame([(1, "token=aB3dE5fG7hJ9kL1mN3pQ5rS7.tail1234")], "doc_id int, text string")
    assert scan_secrets(docs).select(spans_text(F.col("secrets"))).first()[0] == "assign:0:39,entropy_base64:0:30"


def test_the_allow_list_has_no_length(spark):
    part, key = "some-Word12/usr2/local_Bin", "aB3dE5fG7hJ9kL1mN3pQ5rS7tU9v"
    texts = ["/".join([part] * n) for n in (1, 4, 30, 3000)] + ["/".join([part, key, part]), "example-" * 500 + "xxxx0000", "example-" * 9 + key]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {r.doc_id: len(r.secrets) for r in scan_secrets(docs).collect()}
    assert found == {0: 0, 1: 0, 2: 0, 3: 0, 4: 1, 5: 0, 6: 1}


@pytest.mark.parametrize("window", [4, 24, 63])
def test_entropy_of_windows(spark, window):
    draw = random.Random(window)
    runs = ["".join(draw.choices("aA0+/_=-zZ9!~"[: draw.randint(1, 13)], k=draw.randint(window, 4 * window))) for _ in range(60)]
    weight = lambda part: sum(round(c * math.log2(c) * 1_000_000) for c in Counter(part).values())
    rows = spark.createDataFrame([(r,) for r in runs], "run string").select("run", entropy_units(F.col("run"), window).alias("units"))
    for row in rows.collect():
        assert row.units == min(weight(row.run[i : i + window]) for i in range(len(row.run) - window + 1))


def test_names_are_compared_as_spark_does(spark):
    docs = spark.createDataFrame([(1, "token=abcdefgh1", 5)], "doc_id int, Text string, __pieces int")
    assert redact_secrets(scan_secrets(docs)).first().Text == "[SECRET]"
    assert encode_checked(docs).columns == ["doc_id", "Text", "__pieces", "ids", "round_trip"]
    assert encode_checked(docs).first().round_trip


def test_allow_list_hides_no_secret(spark):
    keys = ["aX3kP9/mQ7zLw2Rt5Vb8Nc/1Yd6Fg4Hj0Ks9TuEo", "q7Zm0000Xk2Rt5Vb8NcY1d6Fg4HjKs9TuEoW3pLa", "sampleQ7zLw2Rt5Vb8NcY1d6Fg4HjKs9TuEo"]
    fine = ["/usr/local/lib/python3/site-packages/kerb_flow/Word", "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"]
    fine += ["your-example-api-key-0000-here-xxxx", "123e4567-e89b-12d3-a456-426614174000"]
    docs = spark.createDataFrame([(i, f"aws_key = {k} .") for i, k in enumerate(keys + fine)], "doc_id int, text string")
    found = {r.doc_id: [(s.start, s.end) for s in r.secrets] for r in scan_secrets(docs).collect()}
    assert found == {i: [(10, 10 + len(k))] if k in keys else [] for i, k in enumerate(keys + fine)}


def test_redaction(spark):
    texts = ["token=abcdefgh1", "a token=abcdefgh1 b AKIA" + "A1" * 10, "é😀 secret: 'deadbeefdeadbeefdeadbeefdeadbeef'!", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {r.doc_id: r.text for r in redact_secrets(scan_secrets(docs)).collect()}
    assert found == {0: "[SECRET]", 1: "a [SECRET] b [SECRET]", 2: "é😀 [SECRET]'!", 3: "", 4: None}
    assert scan_secrets(docs.limit(0)).count() == 0
