"""Near-duplicate documents by DartMinHash, banded joins and exact verification (operator 9)."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbflow.llm.common import connected_classes, ready, written
from kerbflow.llm.shingles import Darts, band_keys, jaccard, nibbles, parities, shingle_sets, shingles

WORDS, THRESHOLD = 5, 0.8
SLICE = 256
BANDS, ROWS = 25, 5

#: Members of a bucket that one block holds, in the comparison of what the rounds left.
BLOCK = 2000
#: A round that adds no more than this part of all links is the last one.
FEW = 100


def _sketch(words: int, bands: int, rows: int, weighted: bool):
    """Fingerprint of the set of shingles and the key of each band; null where the text has no word."""

    def run(texts: pa.Array) -> pa.Array:
        darts = Darts(bands * rows)
        prints, keys, sketches = [], [], []
        for at in range(0, len(texts), SLICE):
            sets = shingle_sets(texts.slice(at, SLICE).to_pylist(), words)
            if not weighted:
                sets = [(e, np.ones(len(e))) for e, _ in sets]
            some = [s for s in sets if len(s[0])]
            signed = darts.signatures(some) if some else np.zeros((0, bands * rows), dtype=np.uint64)
            found = iter(zip(band_keys(signed, rows), nibbles(signed), strict=True))
            for e, w in sets:
                content = e.tobytes() + (w.tobytes() if weighted else b"")
                prints.append(xxhash.xxh3_128_digest(content) if len(e) else None)
                key, sketch = next(found) if len(e) else (None, None)
                keys.append(key)
                sketches.append(sketch)
        numbers = pa.list_(pa.int64())
        arrays = [pa.array(prints, type=pa.binary()), pa.array(keys, type=numbers), pa.array(sketches, type=numbers)]
        return pa.StructArray.from_arrays(arrays, names=["print", "bands", "sketch"])

    return F.arrow_udf(run, "print binary, bands array<bigint>, sketch array<bigint>").asNondeterministic()


def _agree(left: Column, right: Column, numbers: int) -> Column:
    """Coordinates of two sketches whose four bits agree, with those that fill up the last number."""
    total = F.lit(16 * numbers)
    for i in range(numbers):
        differ = F.get(left, F.lit(i)).bitwiseXOR(F.get(right, F.lit(i)))
        for shift in (1, 2):
            differ = differ.bitwiseOR(F.shiftrightunsigned(differ, shift))
        total = total - F.bit_count(differ.bitwiseAND(F.lit(0x1111111111111111)))
    return total


def _least_agreement(threshold: float, k: int, numbers: int) -> int:
    """Four standard deviations below what is expected at the threshold, where four bits also agree by chance."""
    expected = threshold + (1 - threshold) / 16
    return math.floor(k * expected - 4 * math.sqrt(k * expected * (1 - expected))) + 16 * numbers - k


def _marks(words: int, weighted: bool):
    """Parities of the set of shingles, and its size (its weight, with ``weighted``)."""

    def run(texts: pa.Array) -> pa.Array:
        odd, mass = [], []
        for at in range(0, len(texts), SLICE):
            for e, w in shingle_sets(texts.slice(at, SLICE).to_pylist(), words):
                odd.append(parities(e))
                mass.append(int(w.sum()) if weighted else len(e))
        arrays = [pa.array(odd, type=pa.list_(pa.int64())), pa.array(mass, type=pa.int64())]
        return pa.StructArray.from_arrays(arrays, names=["odd", "mass"])

    return F.arrow_udf(run, "odd array<bigint>, mass bigint").asNondeterministic()


def _may_link(threshold: float) -> Column:
    """False only where the parities alone show that a pair is below the threshold.

    Sets (or counts) of sizes m and n are at t or above if their symmetric difference is at most (m + n)(1 - t) / (1 + t).
    """
    differ = F.zip_with("a_odd", "b_odd", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    most = (F.col("a_mass") + F.col("b_mass")) * ((1 - threshold) / (1 + threshold)) + 1e-6
    return F.aggregate(differ, F.lit(0), lambda total, n: total + n) <= most


def _similarity(words: int, weighted: bool):
    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        out, last, ready_set = [], None, None
        for at in range(0, len(left), SLICE):
            for a, b in zip(left.slice(at, SLICE).to_pylist(), right.slice(at, SLICE).to_pylist(), strict=True):
                if b != last:
                    last, ready_set = b, shingles(b, words)
                out.append(_weighted(shingles(a, words), ready_set) if weighted else jaccard(shingles(a, words)[0], ready_set[0]))
        return pa.array(out, type=pa.float64())

    return F.arrow_udf(run, "double").asNondeterministic()


def _weighted(a: tuple, b: tuple) -> float:
    if not len(a[0]) or not len(b[0]):
        return 0.0
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = int(np.minimum(a[1][i], b[1][j]).sum())
    return low / (int(a[1].sum()) + int(b[1].sum()) - low)


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    threshold: float = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
    weighted: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """Classes of documents whose sets of word shingles are linked by a similarity of ``threshold`` or more.

    Returns one row per input row: ``doc_id``, ``row_key`` (of id and text), ``class_id`` (smallest doc_id of the class),
    ``class_key`` (key of the row that stays), ``class_rows``. Similarity is Jaccard over distinct shingles, or with
    ``weighted`` over their counts. Every link is verified on whole texts. A document without a word (null, empty, signs
    only) is a class of its own row. Null ids are allowed; a class without any id has a null class_id. Repeated rows share a
    class. Other columns are not read, so they may have any name. ``tasks`` deals the texts to so many tasks for their sketches,
    for a table in few files or row groups, at the cost of one more shuffle of them.

    Texts with the same set of shingles are one vertex, so groups of exact copies cost one row each beyond the first
    aggregate. Vertices meet in buckets of equal band keys; with the defaults two texts at 0.8 share one with
    probability 1 - 5e-5. Pairs whose sketches of four bits a coordinate agree less than chance allows at the threshold (four
    standard deviations below) are not read. In a bucket every member is compared with one centre, never with all others: first with the
    member that shares most buckets (the original of a group of edited copies), then, in rounds, with members of the smallest
    class, for the buckets that still hold several classes. Rounds end when one adds at most one link in ``FEW``, a share, so that
    their number, and with it what the driver plans, does not follow the size of the table. What is left then are
    members of different classes in one bucket that no centre connected: each member outside its bucket's largest class
    is held against the other classes of that bucket, in blocks and by sketch alone: the four bits, then parities of the
    sets, which rule out a pair only where it is certainly below the threshold. What passes is stored and read. So no link between two texts that share a bucket is lost.
    """
    spark = ready(docs.sparkSession)
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    source = source.withColumn("row_key", _row_key())
    sketch = _sketch(words, bands, rows, weighted)(F.col("text"))
    dealt = source if tasks is None else source.repartition(tasks, "row_key")
    rows_of = dealt.select("doc_id", "row_key", sketch.alias("s"))
    rows_of = written(rows_of.select("doc_id", "row_key", "s.print", "s.bands", "s.sketch"), "minhash-sketch")
    # A null id sorts last, so that a class with any id is named by one.
    first = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_key")
    texts = rows_of.where("print is not null").groupBy("print")
    same = [F.first("bands").alias("bands"), F.first("sketch").alias("sketch")]
    texts = written(texts.agg(F.min(first).alias("first"), *same, F.count("*").alias("n")), "minhash-texts")

    buckets = _members(texts)
    bodies = written(_bodies(buckets, texts, source), "minhash-bodies")
    numbers = -(-bands * rows // 16)
    least = _least_agreement(threshold, bands * rows, numbers)
    compared: DataFrame | None = None
    links: DataFrame | None = None
    roots: DataFrame | None = None
    turn = known = 0
    sketches = bodies.select("print", "sketch")
    agree = _agree(F.col("a_sketch"), F.col("b_sketch"), numbers) >= least
    few = False
    while not few:
        pairs = _star_pairs(buckets, roots, turn)
        if compared is not None:
            pairs = pairs.join(compared, ["a", "b"], "left_anti")
        pairs = written(pairs, "minhash-pairs")
        compared = pairs if compared is None else compared.union(pairs)
        left, right = sketches.toDF("a", "a_sketch"), sketches.toDF("b", "b_sketch")
        likely = pairs.join(left, "a").join(right, "b").where(agree).select("a", "b")
        found = _linked(likely, bodies, words, threshold, weighted)
        new = found.count()
        if new:
            links = found if links is None else links.union(found)
            roots = connected_classes(links, "minhash")
        known += new
        few = new * FEW <= known
        turn += 1
    likely = _rest_pairs(buckets, roots, bodies, _marks(words, weighted), agree & _may_link(threshold)).join(compared, ["a", "b"], "left_anti")
    found = _linked(likely, bodies, words, threshold, weighted)
    if not found.isEmpty():
        links = found if links is None else links.union(found)
        roots = connected_classes(links, "minhash")

    classes = texts.select("print", "first", "n")
    if roots is None:
        classes = classes.withColumn("root", F.col("print"))
    else:
        classes = classes.join(roots, classes["print"] == roots["id"], "left")
        classes = classes.select("print", "first", "n", F.coalesce("root", "print").alias("root"))
    heads = classes.groupBy("root").agg(F.min("first").alias("head"), F.sum("n").alias("class_rows"))
    named = classes.join(heads, "root").select("print", "head", "class_rows")
    out = rows_of.select("doc_id", "row_key", "print").join(named, "print", "left")
    return out.select(
        "doc_id",
        "row_key",
        F.when(F.col("head").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("class_id"),
        F.coalesce("head.row_key", "row_key").alias("class_key"),
        F.coalesce("class_rows", F.lit(1)).cast("long").alias("class_rows"),
    )


def keep_first(docs: DataFrame, classes: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class, with all columns of ``docs``. Of repeated rows one stays, of those without a word as well.

    Rows equal in id and text that differ in other columns are repeated rows; the one whose other columns have the smallest
    hash (of their JSON) stays, whatever the order of the rows.
    """
    key, row = "__row_key", "__row"
    kept = classes.where("row_key = class_key").select(F.col("row_key").alias(key)).distinct()
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in (doc_id.lower(), text.lower())]
    order = F.xxhash64(F.to_json(F.struct(*rest))) if rest else F.lit(0)
    ids = docs.select(_row_key(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).alias(key), whole.alias(row), order.alias("__order"))
    return ids.join(kept, key, "left_semi").groupBy(key).agg(F.min_by(row, "__order").alias(row)).select(f"{row}.*")


def _row_key(doc_id: Column | None = None, text: Column | None = None) -> Column:
    """Never null, and the same for a repeated row only."""
    doc_id = F.col("doc_id") if doc_id is None else doc_id
    text = F.col("text") if text is None else text
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("-")), F.md5(F.coalesce(text, F.lit("\0"))))


def _members(texts: DataFrame) -> DataFrame:
    """Members of the buckets with two members or more, each with the number of partners it meets in all its buckets."""
    each = texts.select("print", F.explode("bands").alias("bucket"))
    sizes = each.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = written(each.join(sizes, "bucket"), "minhash-buckets")
    met = members.groupBy("print").agg(F.sum("size").alias("met"))
    return written(members.select("bucket", "print").join(met, "print"), "minhash-members")


def _star_pairs(buckets: DataFrame, roots: DataFrame | None, turn: int) -> DataFrame:
    """Pairs (member, centre) of every bucket that still holds several classes, each pair once."""
    noise = F.xxhash64("print", F.lit(turn))
    if roots is None:
        members = buckets.withColumn("root", F.col("print"))
        order = F.struct(-F.col("met"), noise, "print", "root")
    else:
        sizes = roots.groupBy("root").agg(F.count("*").alias("class_size"))
        known = roots.join(sizes, "root")
        members = buckets.join(known, buckets["print"] == known["id"], "left")
        members = members.select("bucket", "print", F.coalesce("root", "print").alias("root"), F.coalesce("class_size", F.lit(1)).alias("class_size"))
        order = F.struct("class_size", noise, "print", "root")
    stars = members.groupBy("bucket").agg(
        F.min(order).alias("centre"), F.min("root").alias("low"), F.max("root").alias("high")
    )
    stars = stars.where("low <> high").select("bucket", F.col("centre.print").alias("c"), F.col("centre.root").alias("c_root"))
    pairs = members.join(stars, "bucket").where("print <> c and root <> c_root")
    return pairs.select(F.least("print", "c").alias("a"), F.greatest("print", "c").alias("b")).distinct()


def _rest_pairs(buckets: DataFrame, roots: DataFrame | None, bodies: DataFrame, marks, possible: Column) -> DataFrame:
    """Pairs of different classes in one bucket for which ``possible`` holds, from all members of all buckets.

    Of any such pair one member is outside the largest class of the bucket, so only those are copied to the blocks of
    their bucket. A class of near copies, however large, is not paired with itself.
    """
    if roots is None:
        members = buckets.select("bucket", "print", F.col("print").alias("root"))
    else:
        members = buckets.join(roots, buckets["print"] == roots["id"], "left")
        members = members.select("bucket", "print", F.coalesce("root", "print").alias("root"))
    sizes = members.groupBy("bucket", "root").agg(F.count("*").alias("n")).groupBy("bucket")
    mixed = sizes.agg(
        F.max(F.struct("n", "root"))["root"].alias("largest"),
        F.count("*").alias("classes"),
        F.ceil(F.sum("n") / BLOCK).cast("int").alias("blocks"),
    )
    mixed = mixed.where("classes > 1").drop("classes")
    members = written(members.join(mixed, "bucket"), "minhash-mixed")
    marked = bodies.join(members.select("print").distinct(), "print", "left_semi")
    marked = marked.select("print", "sketch", marks(F.col("text")).alias("m")).select("print", "sketch", "m.odd", "m.mass")
    members = written(members.join(marked, "print"), "minhash-rest")
    names = ("print", "root", "sketch", "odd", "mass")
    asked = members.where("root <> largest").select(
        "bucket",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        *[F.col(c).alias(f"a_{c}") for c in names],
    )
    others = members.select(
        "bucket",
        F.pmod(F.hash("print"), "blocks").alias("block"),
        *[F.col(c).alias(f"b_{c}") for c in names],
        "largest",
    )
    # Two members outside the largest class would meet twice.
    pairs = asked.join(others, ["bucket", "block"]).where("a_root <> b_root and (b_root = largest or a_print < b_print)")
    pairs = pairs.where(possible)
    return pairs.select(F.least("a_print", "b_print").alias("a"), F.greatest("a_print", "b_print").alias("b")).distinct()


def _bodies(buckets: DataFrame, texts: DataFrame, source: DataFrame) -> DataFrame:
    """Text and sketch of every vertex that shares a bucket; the one time that texts are dealt out by key."""
    rows = buckets.select("print").distinct().join(texts.select("print", "sketch", F.col("first.row_key").alias("row_key")), "print")
    return source.select("row_key", "text").join(rows, "row_key").dropDuplicates(["row_key"]).select("print", "sketch", "text")


def _linked(likely: DataFrame, bodies: DataFrame, words: int, threshold: float, weighted: bool) -> DataFrame:
    return written(_verified(written(likely, "minhash-likely"), bodies, words, threshold, weighted), "minhash-links")


def _verified(pairs: DataFrame, bodies: DataFrame, words: int, threshold: float, weighted: bool) -> DataFrame:
    """Pairs whose similarity, from whole texts, is ``threshold`` or more."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("print")).distinct()
    needed = bodies.select("print", "text").join(ends, "print", "left_semi")
    both = pairs.join(needed.toDF("a", "a_text"), "a").join(needed.toDF("b", "b_text"), "b")
    similar = _similarity(words, weighted)(F.col("a_text"), F.col("b_text"))
    return both.select("a", "b", similar.alias("similarity")).where(F.col("similarity") >= threshold)
