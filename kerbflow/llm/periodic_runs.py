"""Stretches of words that repeat with a period: internal pattern matching on dyadic blocks.

Notation: a run ``[s, e)`` with smallest period q is at least ``m`` words and 3q long. Let b be a power of two.

*Blocks.* For q >= ``base`` (the largest power of two up to m / 3) take b with b <= q < 2b; for smaller q take b = base. Then
``[s, e - q)`` has 2b words or more, so it contains a block of b words whose place is a multiple of b, and the block occurs again q
words later, inside the run. So it is enough to ask, for all blocks of each length, where they occur next: q is a distance in [b, 2b),
or in [1, b) for b = base.

*Occurrences.* Names of all stretches of 1, 2, 4, ... words by doubling put the places in suffix order, in which the
places of one block are neighbours. A wavelet tree over that order answers which of them is the next one at or after a place (range
successor), how many lie in a window, and which is the last of them.

*Candidates.* Distances below b: the first occurrence is the only candidate (two periods of one block have their
divisor as a period). Distances in [b, 2b): up to two occurrences are candidates as they are. Three or more form a progression
with a step p <= b / 2, and then block and occurrences lie in stretches of period p; as q is no multiple of p, one end of both
stretches is inside the run, and q is the distance of their left ends or of their right ends.

Each candidate is extended both ways, once for each stretch. A stretch found with several periods has the smallest of them.

Only words that a document repeats get names beyond one word, so ordinary prose costs little more than its pairs.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbflow.llm.common import put, ready, text_column

LEAST_WORDS = 24
TURNS = 3
#: Words of short texts that are searched together.
CHUNK = 1 << 16

Run = tuple[int, int, int]  # first word, number of words, period


class WaveletTree:
    """Numbers 0 to len - 1 in some order; counts and selects in slices of it, for many slices at once."""

    def __init__(self, values: np.ndarray):
        self.levels: list[tuple[int, np.ndarray, int]] = []
        for bit in reversed(range(max(1, int(len(values) - 1).bit_length()))):
            ones = (values >> bit) & 1
            zeros_before = np.concatenate(([0], np.cumsum(1 - ones)))
            zeros = int(zeros_before[-1])
            self.levels.append((bit, zeros_before, zeros))
            values = np.concatenate((values[ones == 0], values[ones == 1]))

    def below(self, lo: np.ndarray, hi: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many numbers of each slice ``[lo, hi)`` are below its limit."""
        total = np.zeros(len(lo), np.int64)
        over = limit >= 1 << len(self.levels)
        total[over] = (hi - lo)[over]
        for bit, before, zeros in self.levels:
            a, b = before[lo], before[hi]
            one = ((limit >> bit) & 1 == 1) & ~over
            total += np.where(one, b - a, 0)
            lo, hi = np.where(one, zeros + lo - a, a), np.where(one, zeros + hi - b, b)
        return total

    def nth(self, lo: np.ndarray, hi: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The number of each slice that has ``n`` smaller ones in it."""
        value = np.zeros(len(lo), np.int64)
        for bit, before, zeros in self.levels:
            a, b = before[lo], before[hi]
            one = n >= b - a
            value |= one.astype(np.int64) << bit
            n = np.where(one, n - (b - a), n)
            lo, hi = np.where(one, zeros + lo - a, a), np.where(one, zeros + hi - b, b)
        return value


def _ranked(keys: np.ndarray) -> np.ndarray:
    """Names in the order of the keys, -1 for a key that occurs once."""
    _, names, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return np.where(counts[names] > 1, names, -1)


def block_names(words: np.ndarray, owner: np.ndarray, base: int, longest: int) -> dict[int, np.ndarray]:
    """For b = base, 2 base, ... up to ``longest``: the name of the b words from each place, -1 where its document has them once.

    ``words`` are numbers from 0, ``owner`` the document of each word, from 0 and ascending.
    """
    n, kinds = len(words), int(words.max()) + 1
    names = owner.astype(np.int64) * kinds + words
    places, size, out = np.arange(n), 1, {}
    while size < longest:
        second = places + size
        places, second = places[second < n], second[second < n]
        same = (owner[places] == owner[second]) & (names[second] >= 0)
        places, second = places[same], second[same]
        if not len(places):
            break
        right = words[second] if size == 1 else names[second]
        found = _ranked(names[places] * (int(right.max()) + 1) + right)
        places, size = places[found >= 0], size * 2
        if not len(places):
            break
        names = np.full(n, -1, np.int64)
        names[places] = found[found >= 0]
        if size >= base:
            out[size] = names
    return out


class Stretches:
    """Maximal stretches with a given period in one document, each measured once."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.last: dict[int, tuple[int, int]] = {}

    def _equal(self, i: int, j: int, step: int, room: int) -> int:
        """How far the words from ``i`` and ``j`` on agree, forwards or backwards, ``room`` words at the most."""
        done, size, words = 0, 32, self.words
        while done < room:
            size = min(size * 2, room - done)
            if step > 0:
                differ = words[i + done : i + done + size] != words[j + done : j + done + size]
            else:
                differ = (words[i - done - size + 1 : i - done + 1] != words[j - done - size + 1 : j - done + 1])[::-1]
            at = int(differ.argmax())
            if differ[at]:
                return done + at
            done += size
        return done

    def around(self, x: int, period: int, equal: int) -> tuple[int, int]:
        """The stretch of that period that holds ``[x, x + period + equal)``, whose first ``equal`` words are known to repeat."""
        known = self.last.get(period)
        if known and known[0] <= x and x + period + equal <= known[1]:
            return known
        left = self._equal(x - 1, x + period - 1, -1, x)
        i = x + equal
        right = self._equal(i, i + period, 1, len(self.words) - i - period)
        self.last[period] = found = (x - left, i + period + right)
        return found


def find_runs(documents: list[np.ndarray], least: int = LEAST_WORDS) -> list[list[Run]]:
    """The runs of each document, given as numbers of its words, by start and then period."""
    base = 1 << ((least // TURNS).bit_length() - 1)
    out: list[list[Run]] = [[] for _ in documents]
    sizes = np.array([len(d) for d in documents], np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    if not len(documents) or sizes.max() < least:
        return out
    words = np.concatenate(documents)
    owner = np.repeat(np.arange(len(documents)), sizes)
    names = block_names(words, owner, base, int(sizes.max()) // TURNS)
    if not names:
        return out
    places = np.flatnonzero(names[base] >= 0)
    order = np.lexsort([names[size][places] for size in sorted(names, reverse=True)])
    tree = WaveletTree(order)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    candidates: list[tuple[int, int, int, int]] = []  # document, distance, place, size of the block
    progressions: list[tuple[int, int, int, int, int, int]] = []
    for size, name in sorted(names.items()):
        sorted_names = name[places[order]]
        edges = np.flatnonzero(np.concatenate(([True], sorted_names[1:] != sorted_names[:-1], [True])))
        local = places - starts[owner[places]]
        blocks = np.flatnonzero((name[places] >= 0) & (local % size == 0))
        if not len(blocks):
            continue
        at = places[blocks]
        group = np.searchsorted(edges, rank[blocks], "right") - 1
        lo, hi = edges[group], edges[group + 1]
        middle, end = np.searchsorted(places, at + size), np.searchsorted(places, at + 2 * size)
        before, until = tree.below(lo, hi, middle), tree.below(lo, hi, end)
        if size == base:
            passed = tree.below(lo, hi, blocks + 1)
            near = passed < before
            first = places[tree.nth(lo[near], hi[near], passed[near])]
            candidates += zip(owner[at[near]].tolist(), (first - at[near]).tolist(), at[near].tolist(), [size] * len(first))
        some = until > before
        at, lo, hi, before, until = (v[some] for v in (at, lo, hi, before, until))
        if not len(at):
            continue
        several, many = until - before > 1, until - before > 2
        first, last = places[tree.nth(lo, hi, before)], places[tree.nth(lo, hi, until - 1)]
        for x, found in ((at[~many], first[~many]), (at[several & ~many], last[several & ~many])):
            candidates += zip(owner[x].tolist(), (found - x).tolist(), x.tolist(), [size] * len(x))
        second = places[tree.nth(lo[many], hi[many], before[many] + 1)]
        x, first, last = at[many], first[many], last[many]
        progressions += zip(owner[x].tolist(), (second - first).tolist(), x.tolist(), [size] * len(x), first.tolist(), last.tolist())

    stretches: dict[tuple[int, bool], Stretches] = {}

    def of(document: int, later: bool = False) -> Stretches:
        if (document, later) not in stretches:
            stretches[document, later] = Stretches(documents[document])
        return stretches[document, later]

    for document, step, x, size, first, last in sorted(progressions):
        begin = int(starts[document])
        own = of(document).around(x - begin, step, size - step)
        same = own[1] >= last - begin + size
        other = own if same else of(document, True).around(first - begin, step, last - first + size - step)
        for distance in {other[0] - own[0], other[1] - own[1]}:
            if first - x <= distance <= last - x and (distance - (first - x)) % step == 0:
                candidates.append((document, distance, x, size))
    periods: dict[tuple[int, int, int], int] = {}
    for document, distance, x, size in sorted(candidates):
        s, e = of(document).around(x - int(starts[document]), distance, size)
        if e - s >= max(least, TURNS * distance):
            key = (document, s, e)
            periods[key] = min(periods.get(key, distance), distance)
    for (document, s, e), q in periods.items():
        out[document].append((s, e - s, q))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def split_words(text: str | None) -> list[bytes]:
    """Words between blanks, tabs and line ends (the ASCII ones alone)."""
    return (text or "").encode().split()


def _numbered(words: list[bytes]) -> np.ndarray:
    ids: defaultdict = defaultdict(count().__next__)
    return np.fromiter(map(ids.__getitem__, words), np.int64, len(words))


def _collapsed(words: list[bytes], runs: list[Run]) -> str:
    if not runs:
        return b" ".join(words).decode()
    stays = np.ones(len(words), bool)
    for start, length, period in runs:
        stays[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(stays).tolist()]).decode()


FOUND = "struct<runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>"
RUN_TYPE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND_TYPE = pa.struct([("runs", pa.list_(RUN_TYPE)), ("collapsed", pa.string())])


def search_texts(texts: list, least: int = LEAST_WORDS) -> Iterator[dict]:
    """Runs of each text and the text without its repetitions; short texts are searched together."""
    at = 0
    while at < len(texts):
        chunk, held = [], 0
        while at < len(texts) and (not chunk or held + len(texts[at] or "") // 4 < CHUNK):
            chunk.append(split_words(texts[at]))
            held += len(chunk[-1])
            at += 1
        for words, runs in zip(chunk, find_runs([_numbered(words) for words in chunk], least)):
            found = [{"start": s, "length": n, "period": q} for s, n, q in runs]
            yield {"runs": found, "collapsed": _collapsed(words, runs)}


def periodic_runs(docs: DataFrame, text: str = "text", to: str = "periodic", least: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with ``to``: a struct of ``runs`` and ``collapsed``.

    A run is a stretch of words (split at ASCII white space) with smallest period q, at least ``least`` words and 3q long, that no
    neighbouring word extends. ``runs`` has start, length and period of each, by start and then period; ``collapsed`` is the text's
    words joined by single blanks, without what lies behind the first period of a run.

    Every run of a whole text is found, whatever its length. A null or empty text has no runs and an empty ``collapsed``. Rows do not
    affect each other, so repeated rows get the same result. All columns pass through; one named ``to`` is replaced. No rows give no rows.
    """
    ready(docs.sparkSession)
    search = text_column(lambda texts: search_texts(texts, least), FOUND, FOUND_TYPE)
    return put(docs, to, search(F.col(f"`{text}`")))
