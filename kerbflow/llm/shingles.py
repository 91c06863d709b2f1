"""Word shingles as 64-bit numbers, and the DartMinHash of a weighted set of them."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import xxhash

from kerbflow.llm.common import Memo, resident

WORD = re.compile(r"\w+")
NONE = np.zeros(0, dtype=np.uint64)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)

#: Odd multipliers for the places of a word in its shingle, up to 64 words.
FACTORS = np.array([pow(int(GOLDEN), k + 1, 1 << 64) for k in range(64)], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], words: int = 5) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its distinct runs of ``words`` lower-case words, sorted, and how often each occurs.

    A text of fewer words is one shingle of all its words; a text without a word has none.
    """
    known = resident("word hashes", lambda: Memo(lambda word: xxhash.xxh64_intdigest(word.encode()), limit=150_000))
    get = known.__getitem__
    parts = [np.fromiter(map(get, WORD.findall(t.lower())), dtype=np.uint64) if t else NONE for t in texts]
    hashes = np.concatenate([*parts, np.zeros(words, dtype=np.uint64)])
    long = hashes[: len(hashes) - words + 1] * FACTORS[0]
    for k in range(1, words):
        long = long + hashes[k : len(hashes) - words + 1 + k] * FACTORS[k]
    long = mix(long)
    out, at = [], 0
    for part in parts:
        n = len(part)
        if n >= words:
            rolled = long[at : at + n - words + 1]
        elif n:
            rolled = mix((part * FACTORS[:n]).sum(keepdims=True) + np.uint64(n))
        else:
            rolled = NONE
        out.append(np.unique(rolled, return_counts=True) if n else (NONE, NONE))
        at += n
    return out


def shingles(text: str | None, words: int = 5) -> tuple[np.ndarray, np.ndarray]:
    return shingle_sets([text], words)[0]


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted sets; 0 if either is empty."""
    if not len(a) or not len(b):
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


@dataclass(frozen=True)
class Darts:
    """Signatures whose coordinates agree with the weighted Jaccard similarity as their probability.

    Darts are thrown at every element over weight x rank with one dart per unit of area, by hashes of the element,
    so all sets see the same darts. A set of total weight W keeps the darts that lie below its weights and whose rank is at
    most T / W, about T = k ln k + 2k of them whatever its size; each dart belongs to one of k coordinates, which keeps the
    one of least rank. A set that leaves a coordinate empty is thrown again up to twice the rank.
    """

    k: int

    @property
    def thrown(self) -> float:
        return self.k * math.log(self.k) + 2 * self.k

    def signatures(self, sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """One row of ``k`` dart numbers per set of (elements, weights); no set may be empty."""
        out = np.zeros((len(sets), self.k), dtype=np.uint64)
        todo, reach = list(range(len(sets))), self.thrown
        while todo:
            found, full = self._throw([sets[i] for i in todo], reach)
            out[np.array(todo)[full]] = found[full]
            todo, reach = [i for i, ok in zip(todo, full, strict=True) if not ok], 2 * reach
        return out

    def _throw(self, sets: list, reach: float) -> tuple[np.ndarray, np.ndarray]:
        elements = np.concatenate([e for e, _ in sets])
        weights = np.concatenate([np.asarray(w, dtype=np.float64) for _, w in sets])
        owner = np.repeat(np.arange(len(sets)), [len(e) for e, _ in sets])
        far = reach / np.array([float(np.sum(w)) for _, w in sets])
        # One strip of weight 1 (or what is left of it) after the other.
        strips = np.ceil(weights).astype(np.int64)
        strip = np.arange(strips.sum()) - np.repeat(np.cumsum(strips) - strips, strips)
        left = np.repeat(weights, strips) - strip
        owner = np.repeat(owner, strips)
        key = mix(np.repeat(elements, strips) + strip.astype(np.uint64) * GOLDEN)
        rank, limit = np.zeros(len(key)), far[owner]
        best = np.full(len(sets) * self.k, np.inf)
        slots, ranks, numbers = [], [], []
        turn = 0
        while len(key):
            turn += 1
            drawn = mix(key + np.uint64((2 * turn * int(GOLDEN)) & 0xFFFFFFFFFFFFFFFF))
            rank = rank - np.log(((drawn >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53)
            near = rank <= limit
            key, rank, limit, owner, left = key[near], rank[near], limit[near], owner[near], left[near]
            dart = mix(drawn[near] ^ np.uint64(0xD6E8FEB86659FD93))
            hit = slice(None)
            if (left < 1).any():
                hit = (mix(dart) >> np.uint64(11)).astype(np.float64) * 2.0**-53 < left
            slot = owner[hit] * self.k + (dart[hit] % np.uint64(self.k)).astype(np.int64)
            np.minimum.at(best, slot, rank[hit])
            slots.append(slot)
            ranks.append(rank[hit])
            numbers.append(dart[hit])
        slot, rank, dart = np.concatenate(slots), np.concatenate(ranks), np.concatenate(numbers)
        first = rank == best[slot]
        found = np.zeros(len(best), dtype=np.uint64)
        found[slot[first]] = dart[first]
        return found.reshape(len(sets), self.k), np.isfinite(best).reshape(len(sets), self.k).all(axis=1)


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """One key per band of ``rows`` neighbouring coordinates; the number of the band is part of its key."""
    bands = signatures.shape[1] // rows
    key = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(signatures), 1))
    for k in range(rows):
        key = mix(key * GOLDEN + signatures[:, k : bands * rows : rows])
    return key.view(np.int64)


def parities(elements: np.ndarray, bits: int = 1024) -> np.ndarray:
    """Whether an odd number of the elements falls on each of ``bits`` places, as 64-bit numbers.

    Where two such sketches differ there is an element that only one of the sets has, so their distance is never above
    the size of the symmetric difference, and close to it while that is well below ``bits``.
    """
    places = np.bincount((elements & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((places & 1).astype(np.uint8)).view(np.int64)


def nibbles(signatures: np.ndarray) -> np.ndarray:
    """Four bits of each coordinate, sixteen coordinates to a 64-bit number."""
    small = np.zeros((len(signatures), -(-signatures.shape[1] // 16) * 16), dtype=np.uint64)
    small[:, : signatures.shape[1]] = signatures & np.uint64(15)
    shifts = np.arange(0, 64, 4, dtype=np.uint64)
    return np.bitwise_or.reduce(small.reshape(len(small), small.shape[1] // 16, 16) << shifts, axis=2).view(np.int64)
