"""Language identification by cross-parsing against suffix automata (operator 5)."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbflow.llm.common import SLICE, put, ready

SAMPLE_ROWS, SAMPLE_CHARS, ROW_CHARS = 200, 60_000, 4_000
#: What a model holds of a language: characters of its most frequent words, and letters of a word that are counted as one.
MODEL_CHARS, WORD_CHARS = 60_000, 32
#: Characters that are read side by side; no part of any result.
BLOCK = 2048
#: Parts of a language that are ranked by themselves.
PARTS = 64
#: For the bounds on phrases: least number of texts, quantile, margin, beginnings and length classes.
LEAST, FAR, MARGIN = 20, 0.98, 1.75
BEGINNINGS, LENGTHS = [24 << n for n in range(8)], range(5, 13)
LETTERS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
RESULT = "struct<lang: string, score: double, phrases: double>"
#: Code points with an entry; a letter beyond them matches nothing.
CODES = 0x30000


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that reads exactly the substrings of ``codes`` from state 0."""
    after: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for code in codes:
        state = len(after)
        after.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and code not in after[at]:
            after[at][code] = state
            at = link[at]
        if at >= 0:
            target = after[at][code]
            if length[target] == length[at] + 1:
                link[state] = target
            else:
                copy = len(after)
                after.append(dict(after[target]))
                link.append(link[target])
                length.append(length[at] + 1)
                while at >= 0 and after[at].get(code) == target:
                    after[at][code] = copy
                    at = link[at]
                link[target] = link[state] = copy
        last = state
    return after


@dataclass
class LanguageModel:
    """One automaton per language, as a table of the next state by state and letter; -1: no such substring."""

    languages: list[str]
    letters: np.ndarray
    width: int
    table: np.ndarray
    roots: np.ndarray

    @classmethod
    def fit(cls, samples: dict[str, list[str]]) -> LanguageModel:
        """From some texts per language. Texts are set one after another with a mark between them that no text holds."""
        languages = sorted(samples)
        alphabet = sorted({c for texts in samples.values() for t in texts for c in fold(t)} | {" "})
        letters = np.zeros(CODES, dtype=np.int32)
        number = {c: i + 1 for i, c in enumerate(alphabet)}
        for c, i in number.items():
            if ord(c) < CODES:
                letters[ord(c)] = i
        width = len(alphabet) + 1
        tables, roots, states = [], [], 0
        for lang in languages:
            codes = [code for t in sorted(samples[lang]) for code in (*(number[c] for c in fold(t)), 0)]
            after = suffix_automaton(codes)
            table = np.full((len(after), width), -1, dtype=np.int32)
            for state, moves in enumerate(after):
                for code, to in moves.items():
                    if code:
                        table[state, code] = to + states
            tables.append(table)
            roots.append(states)
            states += len(after)
        table = np.concatenate(tables) if tables else np.full((1, width), -1, dtype=np.int32)
        return cls(languages, letters, width, table.ravel(), np.array(roots, dtype=np.int64))

    def predict(self, texts: list[str | None]) -> list[dict]:
        """For each text the language with the fewest phrases, a score from 0 to 1, and phrases per character.

        A text is read from left to right; a phrase goes on while the language's automaton can follow, and a letter on
        which it fails begins the next one. The number of phrases, divided by the length, estimates the cross
        entropy. The score is one less the ratio of the fewest phrases to the second fewest (1 if only one language was
        learned). How a text is cut into blocks for reading (see ``_parse``) has no part in the result.
        """
        folded = [fold(t) if t else "" for t in texts]
        owner, blocks = [], []
        for i, t in enumerate(folded):
            codes = np.frombuffer(t.encode("utf-32-le"), dtype=np.uint32)
            codes = np.where(codes < CODES, self.letters[np.minimum(codes, CODES - 1)], 0)
            for at in range(0, len(codes), BLOCK):
                blocks.append(codes[at : at + BLOCK])
                owner.append(i)
        phrases = np.zeros((len(texts), max(1, len(self.languages))), dtype=np.int64)
        if blocks and self.languages:
            np.add.at(phrases, np.array(owner), self._parse(blocks, np.array(owner)))
        return [self._decide(text, line, number) for text, line, number in zip(texts, folded, phrases, strict=True)]

    def _step(self, here: np.ndarray, codes: np.ndarray, roots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after one more letter each, and the phrases that ended."""
        to = self.table[here * self.width + codes]
        broken = to < 0
        if not broken.any():
            return to, broken.astype(np.int64)
        # A letter that the language never shows is a phrase by itself; the next one starts at the root.
        again = self.table[roots * self.width + codes]
        lone = broken & (again < 0)
        ended = (broken & (here != roots)).astype(np.int64) + lone
        return np.where(broken, np.where(again < 0, roots, again), to), ended

    def _parse(self, blocks: list[np.ndarray], owner: np.ndarray) -> np.ndarray:
        """Phrases by block and language, a text's blocks standing in order; all blocks and languages are read side by side.

        Every block is first read as if a phrase began with it. Where a text goes on from the block before, its
        beginning is read once more from the state that the text is really in, until both readings are in the same state,
        mostly after some words; the difference in phrases up to there is added. Where they still differ at the end of a block, the
        next one is read again from the state found.
        """
        order = np.argsort([-len(b) for b in blocks], kind="stable")
        sizes = np.array([len(blocks[i]) for i in order])
        grid = np.zeros((sizes[0], len(blocks)), dtype=np.int64)
        for column, i in enumerate(order):
            grid[: len(blocks[i]), column] = blocks[i]
        roots = self.roots[:, None]
        state = np.repeat(roots, len(blocks), axis=1)
        ended = np.zeros(state.shape, dtype=np.int64)
        live = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right")
        for at in range(sizes[0]):
            n = live[at]
            state[:, :n], now = self._step(state[:, :n], grid[at, :n], roots)
            ended[:, :n] += now

        column = np.empty(len(blocks), dtype=np.int64)
        column[order] = np.arange(len(blocks))
        later = np.flatnonzero(np.concatenate(([False], owner[1:] == owner[:-1])))
        after = np.full(len(blocks), -1)  # the column of the block that follows
        after[column[later - 1]] = column[later]
        added = np.zeros(state.shape, dtype=np.int64)
        lang, at_column = (x.ravel() for x in np.meshgrid(np.arange(len(self.roots)), column[later], indexing="ij"))
        entry, end = state[lang, np.tile(column[later - 1], len(self.roots))], state.copy()
        while len(lang):
            lang, at_column, entry = self._mend(grid, sizes, state, end, added, lang, at_column, entry, after)
        # A phrase that has not ended with the text is one more.
        out = np.empty((len(blocks), len(self.languages)), dtype=np.int64)
        out[order] = (ended + added + ((end != roots) & (after < 0))).T
        return out

    def _mend(self, grid, sizes, plain_end, end, added, lang, column, entry, after) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Reads blocks from the states they are entered in; returns the blocks behind those whose last state is another now."""
        root = self.roots[lang]
        true, plain, found = entry.copy(), root.copy(), plain_end[lang, column]
        added[lang, column] = 0
        differ, at = np.flatnonzero(true != plain), 0
        while len(differ):
            over = sizes[column[differ]] <= at
            found[differ[over]] = true[differ[over]]
            differ = differ[~over]
            if not len(differ):
                break
            codes, own = grid[at, column[differ]], root[differ]
            here, more = self._step(true[differ], codes, own)
            there, less = self._step(plain[differ], codes, own)
            added[lang[differ], column[differ]] += more - less
            true[differ], plain[differ] = here, there
            differ = differ[here != there]
            at += 1
        other = (found != end[lang, column]) & (after[column] >= 0)
        end[lang, column] = found
        return lang[other], after[column[other]], found[other]

    def _decide(self, text: str | None, folded: str, phrases: np.ndarray) -> dict:
        if not self.languages or not text or not any(map(str.isalpha, text)):
            return {"lang": UNKNOWN, "score": 0.0, "phrases": None}
        ranked = np.argsort(phrases, kind="stable")
        best = int(phrases[ranked[0]])
        score = 1.0 - best / int(phrases[ranked[1]]) if len(ranked) > 1 else 1.0
        return {"lang": self.languages[ranked[0]], "score": score, "phrases": best / len(folded)}


def fold(text: str) -> str:
    """Lower case; all that is no letter becomes a space, and a run of spaces one space."""
    return " ".join(LETTERS.findall(text.lower()))


def sample_texts(docs: DataFrame, rows: int = SAMPLE_ROWS, row_chars: int = ROW_CHARS, chars: int = SAMPLE_CHARS) -> dict:
    """At most ``rows`` texts and ``chars`` characters per language, for the fit alone.

    ``docs`` has columns ``text`` and ``lang``; rows without either are left out. Each text counts once in a language,
    however many copies it has. Texts of at most ``row_chars`` characters come first, whole, those with the smallest hash; what
    they leave is filled from the longer ones, of each a window of ``row_chars`` characters whose start its hash
    chooses. So each language with a label is learned.
    """
    found: dict[str, list[str]] = {}
    held: dict[str, int] = {}
    for row in chosen_texts(docs, rows, row_chars).orderBy("lang", "place", "text").toLocalIterator():
        if held.get(row.lang, 0) + len(row.text) <= chars:
            found.setdefault(row.lang, []).append(row.text)
            held[row.lang] = held.get(row.lang, 0) + len(row.text)
    return found


def chosen_texts(docs: DataFrame, rows: int, row_chars: int) -> DataFrame:
    """The texts of ``rows`` hashes per language, with their ``place``: whole ones first, then windows of longer ones.

    Only hashes are shuffled, copies of a text combined before, and each task keeps its own smallest per language; the texts
    are read for the chosen hashes alone.
    """
    fit = docs.where("lang is not null and text is not null")
    hashed = fit.select("lang", "text", (F.length("text") > row_chars).alias("long"), F.xxhash64("text").alias("h"))
    keys = hashed.select("lang", "long", "h").distinct().withColumn("part", F.pmod("h", F.lit(PARTS)))
    # One language may hold most rows: parts of it are ranked first, and what they leave is below PARTS * rows.
    for by in (["lang", "part"], ["lang"]):
        order = Window.partitionBy(*by).orderBy("long", "h")
        keys = keys.withColumn("place", F.row_number().over(order)).where(F.col("place") <= rows)
    keys = keys.drop("part")
    start = F.pmod(F.col("h"), F.length("text") - row_chars + 1).cast("int") + 1
    window = F.when(F.col("long"), F.substring(F.col("text"), start, F.lit(row_chars))).otherwise(F.col("text"))
    return hashed.join(F.broadcast(keys), ["lang", "long", "h"]).select("lang", "place", window.alias("text")).distinct()


def identify_language(
    docs: DataFrame, model: LanguageModel, text: str = "text", to: str = "language", sent: Broadcast | None = None
) -> DataFrame:
    """``docs`` with a struct of ``lang``, ``score`` and ``phrases`` (per character) from the whole text alone.

    A text that is null or has no letter is ``und`` with score 0, and so is every text if nothing was learned. On a tie
    the language that sorts first wins, with score 0. A column named ``to`` is replaced; other columns and repeated rows stay.
    The model is bounded by the sample it was fitted on, so it may be broadcast; ``sent`` is a broadcast of it that is there already.
    """
    spark = ready(docs.sparkSession)
    sent = sent or spark.sparkContext.broadcast(model)
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("phrases", pa.float64())])

    def run(texts: pa.Array) -> pa.Array:
        out: list[dict] = []
        for at in range(0, len(texts), 2 * SLICE):
            out.extend(sent.value.predict(texts.slice(at, 2 * SLICE).to_pylist()))
        return pa.array(out, type=kind)

    return put(docs, to, F.arrow_udf(run, RESULT).asNondeterministic()(F.col(f"`{text}`")))


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from the fit: its fold, by CRC-32 of the id as text, is 0 of 5. False for a null id."""
    return F.coalesce(fold_of(doc_id) == 0, F.lit(False))


def fold_of(doc_id: str = "doc_id"):
    return F.crc32(F.col(f"`{doc_id}`").cast("string")) % 5


def word_counts(docs: DataFrame) -> DataFrame:
    """How often each language uses each ``word``: ``n`` over every word of every whole text with a label.

    A text without spaces is counted in pieces of ``WORD_CHARS`` letters.
    """
    ready(docs.sparkSession)
    kind = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: defaultdict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = LETTERS.findall(text.lower())
                if any(len(w) > WORD_CHARS for w in words):
                    words = [w[at : at + WORD_CHARS] for w in words for at in range(0, len(w), WORD_CHARS)]
                found[lang].update(words)
            rows = [(lang, word, n) for lang, counts in found.items() for word, n in counts.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), kind)] if rows else [[], [], []], schema=kind)

    fit = docs.where("lang is not null and text is not null").select("lang", "text")
    return fit.mapInArrow(count, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, chars: int = MODEL_CHARS) -> dict[str, list[str]]:
    """The most frequent words of each language, most frequent first, that ``chars`` characters hold with the spaces between them."""
    held = counts.withColumn("part", F.pmod(F.xxhash64("word"), F.lit(PARTS)))
    # One language may hold most words. What comes after a part of it is full cannot be among the first of all parts.
    for by, full in ((["lang", "part"], F.col("filled") - F.length("word") > chars), (["lang"], F.col("filled") > chars)):
        order = Window.partitionBy(*by).orderBy(F.desc("n"), "word").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        held = held.withColumn("filled", F.sum(F.length("word") + 1).over(order)).where(~full)
    found: dict[str, list[str]] = {}
    for row in sorted(held.select("lang", "filled", "word").toLocalIterator()):
        found.setdefault(row.lang, []).append(row.word)
    return found


def train(docs: DataFrame) -> LanguageModel:
    """A model from all documents that are not held out; a document without an id is not learned from either.

    Every word of their whole texts is counted, and the most frequent ones of each language, in that order, are what its
    automaton reads: the model is bounded, what it is learned from is not.
    """
    words = frequent_words(word_counts(docs.where(fold_of() != 0)))
    return LanguageModel.fit({lang: [" ".join(found)] for lang, found in words.items()})


def letters_in(text: str):
    return F.length(F.regexp_replace(text, r"[^\p{L}]", ""))


def length_class(letters):
    """Texts of 32 to 63 letters are class 5, of 64 to 127 class 6, and so on; all from 4,096 on are class 12."""
    return F.least(F.floor(F.log2(letters)), F.lit(LENGTHS[-1])).cast("int")


def phrase_bounds(
    docs: DataFrame, model: LanguageModel, most: float, sent: Broadcast | None = None
) -> dict[tuple[str, int], float]:
    """The most phrases per character that texts of a language and length class should need, at most ``most``.

    Measured on all held-out documents with a label, whole, each distinct text once, and on their beginnings, since a short
    text needs more phrases a character: ``FAR`` quantile times ``MARGIN``. A longer text is never allowed more than a shorter one. A class with fewer than ``LEAST`` texts takes the bound of
    the next shorter one, and ``most`` if there is none. Texts under 32 letters have no class: too short to judge. A language without any takes the largest of the others.
    """
    held = docs.where(held_out()).where("lang is not null and text is not null").select("text", F.xxhash64("text").alias("h"))
    parts = F.array(F.col("text"), *[F.when(F.length("text") > n, F.substring("text", 1, n)) for n in BEGINNINGS])
    parts = held.select("h", F.posexplode(parts).alias("place", "part")).where("part is not null")
    found = identify_language(parts, model, "part", "found", sent).withColumn("class", length_class(letters_in("part")))
    # Copies count once; they are told apart by what was found, so that no text is dealt out.
    found = found.select("h", "place", "class", "found.lang", "found.phrases").where(F.col("class") >= LENGTHS[0])
    far = found.dropDuplicates(["h", "place"]).groupBy("lang", "class").agg(F.percentile_approx("phrases", FAR, 10_000).alias("far"), F.count("*").alias("n")).where(F.col("n") >= LEAST)
    measured = {(r.lang, r["class"]): r.far * MARGIN for r in far.collect()}
    bounds: dict[tuple[str, int], float] = {}
    for lang in model.languages:
        last = most
        for n in LENGTHS:
            if (lang, n) in measured:
                last = min(most, max(measured[k] for k in measured if k[0] == lang and k[1] >= n))
            bounds[lang, n] = last
    some = {lang for lang, _ in measured}
    for lang in model.languages:
        if some and lang not in some:
            bounds |= {(lang, n): max(bounds[k, n] for k in some if k in model.languages) for n in LENGTHS}
    return bounds
