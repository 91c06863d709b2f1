"""Documents drawn by how much their hashed word runs look like a target's: importance weights and Gumbel noise.

A feature is a run of one to three consecutive words, joined by single spaces, and its bucket the CRC-32 of its UTF-8 bytes
modulo ``BUCKETS``. Runs of frequent words are never spelled out: the CRC of a joined text follows from the CRCs of its parts
(a CRC is linear, so appending n bytes is a fixed table for each n). A head vocabulary, which is counted over all
documents, holds the CRC states of frequent words and the buckets of frequent pairs; a feature with any other word takes the CRC of its
bytes. Both ways give the same number, so the vocabulary decides on the time alone.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbflow.llm.common import ready, resident, text_column, written
from kerbflow.operators.numbering import dense_numbers

BUCKETS = 10_000
#: Bounds of the broadcast: 32,768 words of at most 48 bytes and 65,536 pairs of them, below 4 MB in all.
HEAD_WORDS, HEAD_PAIRS, LONGEST = 1 << 15, 1 << 16, 48
PAIR_SLOTS = 1 << 19
#: Steps of a doubling of the count, by which the head is cut off.
LEVELS = 8
#: Bytes of text that are taken apart at a time.
PIECE = 1 << 19
LEAST_WORDS = 20
PERCENT = 5
SEED = 42

# --- words ------------------------------------------------------------------------------------------

#: 0-9, a-z and all bytes from 0x80 stay, A-Z become a-z, the rest is a space.
FOLD = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))


def word_pieces(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text, a piece of about ``PIECE`` bytes at a time."""
    folded = (text or "").encode().translate(FOLD)
    at = 0
    while at < len(folded):
        end = folded.find(b" ", at + PIECE)
        end = len(folded) if end < 0 else end
        words = folded[at:end].split()
        if words:
            yield words
        at = end


# --- CRC of joined texts ----------------------------------------------------------------------------


def _byte_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1).astype(np.uint32)
    return c


def shift_tables(longest: int) -> np.ndarray:
    """``[n, k, b]``: what byte ``k`` with value ``b`` of a CRC becomes when ``n`` bytes follow, for ``n`` up to ``longest``."""
    table = _byte_table()
    now = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
    out = [now]
    for _ in range(longest):
        now = table[now & 255] ^ (now >> np.uint32(8))
        out.append(now)
    return np.stack(out)


class Joiner:
    """CRC of ``a + b`` from the CRC of ``a``, the CRC of ``b`` and the length of ``b``."""

    def __init__(self, longest: int):
        self.flat = shift_tables(longest).ravel()

    def __call__(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        at = length.astype(np.int64) << 10
        out = self.flat.take(at + (a & 255))
        for k in (1, 2, 3):
            out ^= self.flat.take(at + (k << 8) + ((a >> np.uint32(8 * k)) & 255))
        return out ^ b


# --- head vocabulary ----------------------------------------------------------------------------------


class Frequent:
    """Counts of the frequent values of a stream in bounded memory (Misra and Gries).

    Whatever makes up more than one in ``limit`` of the stream is in it, and no count is too high.
    """

    def __init__(self, limit: int):
        self.limit, self.counts = limit, Counter()

    def add(self, values: Iterable) -> None:
        self.counts.update(values)
        if len(self.counts) > 4 * self.limit:
            self.cut()

    def cut(self) -> None:
        if len(self.counts) > self.limit:
            sizes = np.fromiter(self.counts.values(), np.int64, len(self.counts))
            least = int(np.partition(sizes, -self.limit - 1)[-self.limit - 1])
            self.counts = Counter({value: n - least for value, n in self.counts.items() if n > least})


HEAD = "pair boolean, feature binary, n bigint"


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words, pairs = Frequent(HEAD_WORDS), Frequent(HEAD_PAIRS)
    for batch in batches:
        for text in batch.column(0):
            for piece in word_pieces(text.as_py()):
                words.add(piece)
                pairs.add(zip(piece, piece[1:]))
    for found, pair in ((words, False), (pairs, True)):
        found.cut()
        kept = {f: n for f, n in found.counts.items() if (max(map(len, f)) if pair else len(f)) <= LONGEST}
        features = [b" ".join(f) if pair else f for f in kept]
        yield pa.record_batch(
            [pa.array([pair] * len(kept), pa.bool_()), pa.array(features, pa.binary()), pa.array(list(kept.values()), pa.int64())],
            names=["pair", "feature", "n"],
        )


@dataclass
class Head:
    """What every executor holds: frequent words in order of frequency, and frequent pairs of them."""

    words: list[bytes]
    pairs: list[tuple[bytes, bytes]]
    name: str = field(default_factory=lambda: uuid.uuid4().hex)


def count_head(texts: DataFrame, text: str = "text") -> Head:
    """The frequent words and pairs of all texts.

    Each task sends its most frequent ones, at most ``HEAD_WORDS`` and ``HEAD_PAIRS``; they are added up and at most as many stay.
    """
    ready(texts.sparkSession)
    local = texts.select(F.col(f"`{text}`").alias("text")).mapInArrow(_frequent, HEAD)
    counts = written(local.groupBy("pair", "feature").agg(F.sum("n").alias("n")), "resample-head")
    counts = counts.withColumn("level", F.floor(F.log2("n") * LEVELS))
    sizes = sorted(map(tuple, counts.groupBy("pair", "level").agg(F.count(F.lit(1))).collect()), reverse=True)

    def most(pair: bool, limit: int) -> list[bytes]:
        """As many of the highest levels as hold ``limit`` features together, so no task has to sort what all others send."""
        levels = [(level, size) for kind, level, size in sizes if kind == pair]
        sums = accumulate(size for _, size in levels)
        whole = [level for (level, _), total in zip(levels, sums) if total <= limit]
        found = counts.where((F.col("pair") == pair) & (F.col("level") >= (whole[-1] if whole else math.inf))).toArrow()
        ordered = sorted(zip(found["n"].to_pylist(), found["feature"].to_pylist()), key=lambda f: (-f[0], f[1]))
        return [feature for _, feature in ordered]

    words = most(False, HEAD_WORDS)
    known = set(words)
    pairs = (tuple(p.split(b" ")) for p in most(True, HEAD_PAIRS))
    return Head(words, [p for p in pairs if known.issuperset(p)])


class Features:
    """Buckets of the features of word lists."""

    def __init__(self, head: Head, buckets: int):
        self.ids = {word: i for i, word in enumerate(head.words)}
        self.buckets = np.uint32(buckets)
        self.join = Joiner(LONGEST + 1)
        # One place more, for words that are not in the head.
        self.crc = np.array([*map(zlib.crc32, head.words), 0], np.uint32)
        self.spaced = np.array([*(zlib.crc32(b" " + w) for w in head.words), 0], np.uint32)
        self.length = np.array([*(len(w) + 1 for w in head.words), 0], np.int64)
        self.pair_key = np.full(PAIR_SLOTS, -1, np.int64)
        self.pair_crc = np.zeros(PAIR_SLOTS, np.uint32)
        for a, b in reversed(head.pairs):  # of two pairs in one slot the more frequent stays
            i, j = self.ids[a], self.ids[b]
            slot = self._slot(i, j)
            self.pair_key[slot], self.pair_crc[slot] = (i << 32) | j, zlib.crc32(a + b" " + b)
        self.pair_bucket = self.pair_crc % self.buckets

    @staticmethod
    def _slot(i, j):
        return (i * 40_503 + j * 2_971) & (PAIR_SLOTS - 1)

    def __call__(self, words: list[bytes], owner: np.ndarray, fresh: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the features that end at word ``fresh`` or later, and the owner of each; none spans two owners."""
        n = len(words)
        ids = np.fromiter(map(self.ids.get, words, repeat(-1)), np.int64, n)
        head = ids >= 0
        crc = self.crc[ids]
        tail = np.flatnonzero(~head)
        crc[tail] = [zlib.crc32(words[i]) for i in tail.tolist()]
        found, owners = [crc[fresh:] % self.buckets], [owner[fresh:]]
        pair_crc = np.zeros(n, np.uint32)  # of the pair that ends at a word
        for size in (2, 3):
            end = np.arange(max(fresh, size - 1), n)
            end = end[owner[end] == owner[end - size + 1]]
            known = head[end] & head[end - 1] & head[end - size + 1]
            bucket = np.empty(len(end), np.uint32)
            at = end[known]
            if size == 2:
                i, j = ids[at - 1], ids[at]
                slot = self._slot(i, j)
                hit = self.pair_key[slot] == (i << 32) | j
                value, b = np.empty(len(at), np.uint32), np.empty(len(at), np.uint32)
                value[hit], b[hit] = self.pair_crc[slot[hit]], self.pair_bucket[slot[hit]]
                rest = at[~hit]
                value[~hit] = joined = self.join(crc[rest - 1], self.spaced[ids[rest]], self.length[ids[rest]])
                b[~hit] = joined % self.buckets
                pair_crc[at], bucket[known] = value, b
            else:
                before = pair_crc[at - 1]
                if fresh == 2 and len(at) and at[0] == 2:  # the pair of the two words carried over
                    before[0] = zlib.crc32(words[0] + b" " + words[1])
                bucket[known] = self.join(before, self.spaced[ids[at]], self.length[ids[at]]) % self.buckets
            direct = end[~known].tolist()
            bucket[~known] = np.array([zlib.crc32(b" ".join(words[i - size + 1 : i + 1])) for i in direct], np.uint32) % self.buckets
            found.append(bucket)
            owners.append(owner[end])
        return np.concatenate(found), np.concatenate(owners)

    def of_texts(self, texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """Buckets, the text each belongs to (by place), and words, for small texts together and long ones piece by piece."""
        words: list[bytes] = []
        owner: list[np.ndarray] = []
        for place, text in enumerate(texts):
            before: list[bytes] = []
            for piece in word_pieces(text):
                if before or len(piece) > PIECE // 8:
                    both = before + piece
                    yield *self(both, np.full(len(both), place), len(before)), len(piece)
                elif piece:
                    words += piece
                    owner.append(np.full(len(piece), place))
                before = (before + piece)[-2:]
            if len(words) > PIECE // 8:
                yield *self(words, np.concatenate(owner)), len(words)
                words, owner = [], []
        if words:
            yield *self(words, np.concatenate(owner)), len(words)


def _features(shared: Broadcast, buckets: int) -> Features:
    return resident(("resample", shared.value.name, buckets), lambda: Features(shared.value, buckets))


# --- bucket totals, gains, weights -----------------------------------------------------------------------


def bucket_totals(texts: DataFrame, head: Broadcast, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """Features of all texts in each bucket that has any: ``bucket``, ``n``. A task sends one row a bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        features = _features(head, buckets)
        for batch in batches:
            for found, _, _ in features.of_texts(t.as_py() for t in batch.column(0)):
                total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], names=["bucket", "n"])

    local = texts.select(F.col(f"`{text}`").alias("text")).mapInArrow(count, "bucket int, n bigint")
    return local.groupBy("bucket").agg(F.sum("n").alias("n"))


def _dense(totals: DataFrame, buckets: int) -> np.ndarray:
    """At most one row a bucket."""
    rows, out = totals.toArrow(), np.zeros(buckets, np.int64)
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's share in the target to that in the source, each count plus one, rounded down."""
    buckets, s, t = len(source), int(source.sum()), int(target.sum())
    pairs = zip(source.tolist(), target.tolist())
    ratios = (float(b + 1) * float(s + buckets) / (float(a + 1) * float(t + buckets)) for a, b in pairs)
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


WEIGHED = "struct<n_words:bigint,n_features:bigint,weight:bigint>"
WEIGHED_TYPE = pa.struct([("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])


def weighed(text: Column, gains: Broadcast, head: Broadcast, buckets: int = BUCKETS) -> Column:
    """Words, features and weight (the sum of the features' gains) of a text; zeros for a null one."""

    def weigh(texts: list) -> list[dict]:
        features = _features(head, buckets)
        n_features, weight, n_words = (np.zeros(len(texts), np.int64) for _ in range(3))
        for found, owner, _ in features.of_texts(texts):
            n_features += np.bincount(owner, minlength=len(texts))
            weight += np.rint(np.bincount(owner, gains.value[found], len(texts))).astype(np.int64)
        # n words have n + (n - 1) + (n - 2) features, one word has one.
        n_words[:] = np.where(n_features > 1, (n_features + 3) // 3, n_features)
        return [{"n_words": a, "n_features": b, "weight": c} for a, b, c in zip(n_words.tolist(), n_features.tolist(), weight.tolist())]

    return text_column(weigh, WEIGHED, WEIGHED_TYPE)(text)


def gumbel_score(weight: Column, id: Column, seed: int) -> Column:
    """``weight`` plus thousandths of Gumbel noise, which hangs on the seed and the id alone. No id reads as an empty one."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit(""))), 256), 1, 8)
    share = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return weight + F.floor(F.lit(-1000.0) * F.log(-F.log(share)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """Every row of ``docs`` (``id``, ``n_features``, ``weight``, ``score``) and the ``rank`` of those drawn.

    Of the documents with at least ``least_words`` words, ``percent`` in a hundred (rounded down) with the highest scores are drawn.
    Equal scores go to the smaller id, then to fewer features; a null id comes last. A null or empty text has no features and weight 0.
    Rows with the same id are scored each by its text. An empty target leaves weights that favour rare buckets; no documents give no
    rows. Other columns are not read. Whole texts are read, long ones piece by piece.
    """
    spark = ready(docs.sparkSession).sparkContext
    shared = spark.broadcast(count_head(docs, text))
    totals = [_dense(bucket_totals(t, shared, c, buckets), buckets) for t, c in ((docs, text), (target, target_text))]
    gains = spark.broadcast(bucket_gains(*totals))
    rows = docs.select(F.col(f"`{id}`").alias("id"), weighed(F.col(f"`{text}`"), gains, shared, buckets).alias("w"))
    scored = rows.select("id", "w.*", gumbel_score(F.col("w.weight"), F.col("id"), seed).alias("score"))
    scored = written(scored, "resample-scores")
    able = F.col("n_words") >= least_words
    drawn = scored.where(able).count() * percent // 100
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("n_features")]
    ranked = dense_numbers(scored.where(able), order, "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    others = scored.where(~able).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(others).select(F.col("id").alias(id), "n_features", "weight", "score", "rank")
