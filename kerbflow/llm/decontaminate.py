"""Benchmark decontamination by pigeonhole edit matching (operator 8)."""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbflow.llm.common import put, ready, resident, text_column, written
from kerbflow.session import scratch_dir

ERROR_RATE = 0.1
BLOCK_CHARS = 4_000_000
#: Blocks that a task cuts, on average.
GROUP_BLOCKS = 8
WORD = re.compile(r"\w+")
LEAKS = "array<struct<item_id bigint, start int, end int, distance int>>"
LEAK_KIND = pa.list_(
    pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("distance", pa.int32())])
)


def plain(text: str | None) -> str:
    """Lower-case words with one space between them: case, signs and white space do not hide a passage."""
    return " ".join(WORD.findall(text.lower())) if text else ""


def within_one(piece: str, text: str) -> bool:
    """Whether some beginning of ``text`` is at most one edit away from ``piece``."""
    if text.startswith(piece):
        return True
    at, end = 0, min(len(piece), len(text))
    while at < end and piece[at] == text[at]:
        at += 1
    rest = piece[at + 1 :]
    return text.startswith(rest, at + 1) or text.startswith(rest, at) or text.startswith(piece[at:], at + 1)


class Matcher:
    """Finds items in texts within an edit distance of ``floor(error_rate * length)``.

    An item with a budget of k edits is cut into k + 1 pieces. Whatever the k edits do, one piece is left whole, so
    every match holds a piece exactly, at a known offset but for k places. All pieces of all items go into one
    automaton. The same argument holds for pairs of neighbours: one pair has at most one edit, so a hit counts only if
    its partner follows within one edit (a piece without a partner is as long as a pair). Around the hits that are left the
    text is searched for the item with Myers' bit-parallel edit distance; windows of one item that overlap are searched as one.
    """

    def __init__(self, items: list[tuple[int, str]], error_rate: float):
        self.items, places = [], defaultdict(list)
        for item_id, text in items:
            if not text:
                continue
            budget = int(error_rate * len(text))
            number = len(self.items)
            masks: dict[str, int] = {}
            for at, letter in enumerate(text):
                masks[letter] = masks.get(letter, 0) | 1 << at
            self.items.append((item_id, len(text), budget, masks))
            pieces = budget + 1
            shares = pieces + pieces % 2
            cuts = [len(text) * k // shares for k in range(pieces)] + [len(text)]
            for k in range(pieces):
                piece, partner, side = text[cuts[k] : cuts[k + 1]], "", 0
                if k % 2:
                    partner, side = text[cuts[k - 1] : cuts[k]][::-1], -1
                elif k + 1 < pieces:
                    partner, side = text[cuts[k + 1] : cuts[k + 2]], 1
                places[piece].append((number, cuts[k], cuts[k + 1], partner, side))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, where)
        if places:
            self.automaton.make_automaton()
        self.empty = not places

    def find(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item, start of the match at the earliest, end, distance) of the best match of every item, in the plain text.

        Of equally good matches the one that ends first counts.
        """
        body = plain(text)
        if not body or self.empty:
            return []
        windows: dict[int, list[tuple[int, int]]] = {}
        for last, where in self.automaton.iter(body):
            for number, begins, ends, partner, side in where:
                if side > 0:
                    if not within_one(partner, body[last + 1 : last + 2 + len(partner)]):
                        continue
                elif side < 0:
                    first = last + 1 - (ends - begins)
                    if not within_one(partner, body[max(0, first - 1 - len(partner)) : first][::-1]):
                        continue
                _, length, budget, _ = self.items[number]
                start = last + 1 - ends
                low, high = max(0, start - budget), min(len(body), start + length + budget)
                spans = windows.setdefault(number, [])
                if spans and spans[-1][0] <= low <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], max(high, spans[-1][1]))
                else:
                    spans.append((low, high))
        found = []
        for number, spans in windows.items():
            item_id, length, budget, masks = self.items[number]
            best = None
            for low, high in sorted(spans):
                for end, distance in self._distances(body, low, high, length, masks):
                    if distance <= budget and (best is None or distance < best[1]):
                        best = (end, distance)
                if best and best[1] == 0:
                    break
            if best:
                end, distance = best
                found.append((item_id, max(0, end - length - distance), end, distance))
        return sorted(found, key=lambda f: (f[0] is not None, f[0] or 0, *f[1:]))

    @staticmethod
    def _distances(text: str, low: int, high: int, length: int, masks: dict[str, int]) -> Iterator[tuple[int, int]]:
        """For each end in the window, the smallest edit distance of the item to a piece of text that ends there."""
        full, top = (1 << length) - 1, 1 << (length - 1)
        plus, minus, distance = full, 0, length
        get = masks.get
        for at in range(low, high):
            same = get(text[at], 0)
            either = same | minus
            across = (((same & plus) + plus) ^ plus) | same
            rises = minus | (full & ~(across | plus))
            falls = plus & across
            if rises & top:
                distance += 1
            elif falls & top:
                distance -= 1
            rises <<= 1
            plus = full & ((falls << 1) | ~(either | rises))
            minus = rises & either & full
            yield at + 1, distance


def item_blocks(items: DataFrame, block_chars: int = BLOCK_CHARS) -> tuple[DataFrame, list[str]]:
    """Items (``item_id``, ``text``) as a written table ``item_id, body, block``, and the names of its blocks.

    ``body`` is the plain form; items without a word are left out, and rows equal in id and body count once. A block has at most
    ``block_chars`` characters before its last item. Items are dealt out by a hash into groups of some blocks each, and a
    group is cut by its running sum of characters, so neither the driver nor one task goes through them all.
    """
    spark = ready(items.sparkSession)
    bodies = text_column(lambda texts: [plain(t) for t in texts], "string", pa.string())(F.col("text"))
    cleaned = written(items.select(F.col("item_id").cast("long").alias("item_id"), bodies.alias("body")), "leak-items")
    once = cleaned.where("body <> ''").distinct().withColumn("chars", F.length("body").cast("long"))
    total = once.agg(F.coalesce(F.sum("chars"), F.lit(0)).alias("chars")).first().chars
    groups = total // (GROUP_BLOCKS * block_chars) + 1
    mixed = F.xxhash64("item_id", "body")
    dealt = once.withColumn("group", F.pmod(mixed, F.lit(groups))).withColumn("mixed", mixed)
    before = Window.partitionBy("group").orderBy("mixed", "item_id", "body").rowsBetween(Window.unboundedPreceding, -1)
    part = F.floor(F.coalesce(F.sum("chars").over(before), F.lit(0)) / block_chars)
    named = dealt.select("item_id", "body", F.concat_ws("-", F.lit("block"), "group", part).alias("block"))
    path = scratch_dir(spark, "leak-blocks")
    named.write.partitionBy("block").parquet(path)
    stored = spark.read.schema(named.schema).parquet(path)
    return stored, sorted(r.block for r in stored.select("block").distinct().collect())


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    error_rate: float = ERROR_RATE,
    text: str = "text",
    to: str = "leaks",
    item_id: str = "item_id",
    item_text: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``docs`` with ``leaks``: the items that each whole text holds within the error budget, by item_id.

    Both sides are compared as lower-case words with single spaces. Places are code points of that form; ``start`` is a lower
    bound of where the match begins. Of equally good matches of an item the one that ends first is given. Null and empty texts
    hold nothing, items without a word match nothing, items with a null id are given with it, before all others; items
    equal in id and words count once, items of one id and other words by themselves. No items, or no documents, is no leak. A
    column named ``to`` is replaced, others stay.

    Items travel to the tasks in blocks of at most ``block_chars`` characters and one item. One block is
    a column of the result. More are matched one after another: each pass reads the texts, writes what it
    found and gives its block back before the next, so an executor holds one block at any time; what the
    passes found is put together by document at the end.
    """
    spark = ready(docs.sparkSession)
    stored, names = item_blocks(items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{item_text}`").alias("text")), block_chars)

    def sent(name: str):
        return spark.sparkContext.broadcast([tuple(r) for r in stored.where(F.col("block") == name).select("item_id", "body").collect()])

    if not names:
        return put(docs, to, F.expr(f"cast(array() as {LEAKS})"))
    if len(names) == 1:
        return put(docs, to, _column(sent(names[0]), error_rate)(F.col(f"`{text}`")))
    # Numbers are fixed by being written; other columns are kept aside, whatever their names.
    numbered = written(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "leak-docs")
    path = scratch_dir(spark, "leaks")
    for name in names:
        block = sent(name)
        found = numbered.select("row", _column(block, error_rate)(F.col(f"doc.`{text}`")).alias("leaks"))
        found.where(F.size("leaks") > 0).write.parquet(f"{path}/{name}")
        block.destroy()
    found = spark.read.schema(found.schema).parquet(*[f"{path}/{name}" for name in names])
    leaks = found.groupBy("row").agg(F.sort_array(F.flatten(F.collect_list("leaks"))).alias("leaks"))
    joined = numbered.join(leaks, "row", "left")
    value = F.coalesce("leaks", F.expr(f"cast(array() as {LEAKS})")).alias(to)
    return joined.select(*[F.col(f"doc.`{c}`") for c in docs.columns if c.lower() != to.lower()], value)


def _column(block, error_rate: float):
    """A column of leaks from one broadcast block. A worker keeps the matcher of the block it saw last."""
    token = ("matcher", uuid.uuid4().hex)

    def find(texts: list) -> list:
        matcher = resident(token, lambda: Matcher(block.value, error_rate))
        return [[dict(zip(("item_id", "start", "end", "distance"), f, strict=True)) for f in matcher.find(t)] for t in texts]

    return text_column(find, LEAKS, LEAK_KIND)
