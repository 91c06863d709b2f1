"""Lines that several documents share, kept in the first of them only; expressions of Spark alone.

A line's key is the line without white space at both ends, with A-Z in lower case. Keys of at least ``LEAST`` code points
lose their lines in all documents but the one with the smallest id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbflow.llm.common import written

LEAST = 10
SPACE = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A key with more than one in so many of all lines is resolved by itself; there are fewer such keys than this.
HEAVY = 1000
PREFIX_BITS = 14
LAST = 2**63 - 1

KEEP = "array<struct<start:int,length:int>>"


def lines_of(text: str) -> Column:
    return F.split(F.coalesce(F.col(f"`{text}`"), F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(SPACE))
    # ``lower`` is much the faster, and does the same where there is nothing but ASCII.
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, UPPER.lower()))


def _identity(id: str, text: str) -> list[Column]:
    """A document: its id, null after all others, and a hash of its text, in case an id comes with two texts."""
    return [F.coalesce(F.col(f"`{id}`").cast("long"), F.lit(LAST)).alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("row")]


def _hashes(docs: DataFrame, id: str, text: str, least: int) -> DataFrame:
    """One row per line whose key is long enough: 128 bits of the key, the document and the place in it."""
    lines = docs.select(*_identity(id, text), lines_of(text).alias("lines"))
    lines = lines.select("id", "row", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line"))
    keyed = lines.where(F.octet_length("line") >= least).select("id", "row", "n_lines", "pos", line_key(F.col("line")).alias("key"))
    long = keyed.where(F.length("key") >= least)
    return long.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"), "id", "row", "pos", "n_lines")


def _heavy(hashes: DataFrame) -> DataFrame:
    """The keys that more than one in ``HEAVY`` lines has, with the first document of each.

    Lines are counted by a prefix of the hash first: a heavy key lies in a heavy prefix, and there are fewer than
    ``HEAVY`` of either. Both counts combine on the map side.
    """
    prefix = F.shiftright("h1", 64 - PREFIX_BITS).alias("prefix")
    counts = written(hashes.groupBy(prefix).agg(F.count(F.lit(1)).alias("n")), "line-prefixes")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    many = F.col("n") * HEAVY > total
    near = hashes.withColumn("prefix", prefix).join(F.broadcast(counts.where(many).select("prefix")), "prefix")
    keys = near.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    return written(keys.where(many).select("h1", "h2", "first"), "line-heavy")


def _later_lines(hashes: DataFrame) -> DataFrame:
    """Lines whose key a smaller document holds.

    Hashes are dealt out by ranges and sorted by document and position inside one, so the first document of a key passes
    before its other lines. What is left after the heavy keys is below one line in ``HEAVY`` for each key.
    """
    heavy = F.broadcast(_heavy(hashes))
    frequent = hashes.join(heavy, ["h1", "h2"]).where("id > first")
    ranged = hashes.join(heavy, ["h1", "h2"], "left_anti").repartitionByRange("h1", "h2")
    passed = Window.partitionBy("h1", "h2").orderBy("id", "pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    others = ranged.withColumn("first", F.first("id").over(passed)).where("id > first")
    columns = ["id", "row", "pos", "n_lines"]
    return frequent.select(*columns).union(others.select(*columns))


def keep_bitmaps(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """For each document that loses a line: ``id``, ``row`` (a hash of its text), ``n_lines`` and ``keep``.

    ``keep`` is a bitmap of the lines in runs: first line (from 0) and number of lines of each stretch that stays, none if
    all go. A document that loses nothing has no row.

    A null text is one empty line, as is an empty one; empty lines are shorter than any key. Rows with the same id are one document, so a line
    is never dropped for another row of its own id, and rows equal in id and text share one bitmap. Rows without an id are one document that
    comes last. Equal lines inside one document all stay or all go. Other columns are not read. No rows give no rows.
    """
    hashes = written(_hashes(docs, id, text, least), "line-hashes")
    lost = _later_lines(hashes).groupBy("id", "row").agg(F.max("n_lines").alias("n_lines"), F.sort_array(F.collect_set("pos")).alias("pos"))
    before = lambda i: F.get("pos", i - 1)
    after = lambda i: F.get("pos", i + 1)
    first = F.filter("pos", lambda p, i: (i == 0) | (before(i) != p - 1))
    last = F.filter("pos", lambda p, i: (i == F.size("pos") - 1) | (after(i) != p + 1))
    edges = lost.select("id", "row", "n_lines", first.alias("first"), last.alias("last"))
    starts = F.concat(F.array(F.lit(0)), F.transform("last", lambda p: p + 1))
    ends = F.concat(F.col("first"), F.array(F.col("n_lines")))
    runs = F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("start"), (e - s).alias("length")))
    return edges.select("id", "row", "n_lines", F.filter(runs, lambda r: r["length"] > 0).cast(KEEP).alias("keep"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the lines that ``bitmaps`` keeps in ``text``, and ``n_lines`` and ``n_dropped`` behind its columns.

    A text that loses nothing stays as it is (a null one null). Columns ``n_lines`` and ``n_dropped`` of the input are
    replaced; all others pass through, whatever their names.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), *_identity(id, text))
    joined = rows.join(bitmaps.select("id", "row", "keep"), ["id", "row"], "left")
    lines = lines_of("text_")
    cut = joined.withColumn("text_", F.col(f"doc.`{text}`"))
    stays = F.flatten(F.transform("keep", lambda r: F.slice(lines, r["start"] + 1, r["length"])))
    kept_lines = F.aggregate("keep", F.lit(0), lambda n, r: n + r["length"])
    n_lines = F.size(lines)
    cut = cut.select(
        "doc",
        n_lines.cast("long").alias("n_lines"),
        F.coalesce(n_lines - kept_lines, F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("keep").isNull(), F.col("text_")).otherwise(F.array_join(stays, "\n")).alias("kept"),
    )
    names = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    own = lambda c: F.col("kept").alias(c) if c.lower() == text.lower() else F.col(f"doc.`{c}`").alias(c)
    return cut.select(*[own(c) for c in names], "n_lines", "n_dropped")


def dedup_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """``docs`` without the lines that a document of smaller id holds, see ``keep_bitmaps`` and ``apply_bitmaps``."""
    return apply_bitmaps(docs, keep_bitmaps(docs, id, text, least), id, text)
