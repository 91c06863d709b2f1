"""Near-duplicate vectors by an inverted multi-index (operator 4)."""

from __future__ import annotations

import heapq
import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbflow.llm.common import connected_classes, ready, written

THRESHOLD, RECALL = 0.95, 0.99
CODEWORDS, SAMPLE, QUERIES, BLOCK = 32, 16_384, 512, 512
#: Stored points, and about as many asking ones, that a task compares.
STORED = 4096
LEAST_CELLS, BANDS, TWINS = 4, 5, 4

logger = logging.getLogger(__name__)


@dataclass
class MultiIndex:
    """Two codebooks, one for each half of a vector; a cell is a pair of their entries."""

    first: np.ndarray
    second: np.ndarray
    visits: int

    @property
    def half(self) -> int:
        return self.first.shape[1]

    def distances(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _squared(vectors[:, : self.half], self.first), _squared(vectors[:, self.half :], self.second)

    def traverse(self, vectors: np.ndarray, cells: int) -> np.ndarray:
        """For each vector its ``cells`` nearest cells in order, by multi-sequence traversal.

        Both halves' entries are sorted by distance; starting from the nearest pair, the pair of least total distance is taken
        from a heap and its two successors are put in.
        """
        one, two = self.distances(vectors)
        by_one, by_two = np.argsort(one, axis=1, kind="stable"), np.argsort(two, axis=1, kind="stable")
        width = self.second.shape[0]
        out = np.empty((len(vectors), min(cells, self.first.shape[0] * width)), dtype=np.int32)
        for row in range(len(vectors)):
            a, b = one[row, by_one[row]].tolist(), two[row, by_two[row]].tolist()
            heap, seen = [(a[0] + b[0], 0, 0)], {(0, 0)}
            for n in range(out.shape[1]):
                _, i, j = heapq.heappop(heap)
                out[row, n] = by_one[row, i] * width + by_two[row, j]
                for x, y in ((i + 1, j), (i, j + 1)):
                    if x < len(a) and y < len(b) and (x, y) not in seen:
                        seen.add((x, y))
                        heapq.heappush(heap, (a[x] + b[y], x, y))
        return out

    @classmethod
    def fit(cls, sample: np.ndarray, codewords: int = CODEWORDS) -> MultiIndex:
        """Codebooks of a bounded sample of unit vectors; the number of cells to visit is raised later."""
        half = sample.shape[1] // 2
        return cls(_codebook(sample[:, :half], codewords), _codebook(sample[:, half:], codewords), LEAST_CELLS)

    @property
    def reaches(self) -> np.ndarray:
        """The numbers of cells that may be visited: doubled from ``LEAST_CELLS`` up to all cells."""
        cells = self.first.shape[0] * self.second.shape[0]
        out = [min(LEAST_CELLS, cells)]
        while out[-1] < cells:
            out.append(min(2 * out[-1], cells))
        return np.array(out)

    def homes(self, vectors: np.ndarray) -> np.ndarray:
        one, two = self.distances(vectors)
        return one.argmin(axis=1) * self.second.shape[0] + two.argmin(axis=1)

    def places(self, vectors: np.ndarray) -> np.ndarray:
        """For each vector and each cell, how many cells are as near or nearer: visiting as many reaches the cell."""
        one, two = self.distances(vectors)
        far = (one[:, :, None] + two[:, None, :]).reshape(len(vectors), -1)
        order = np.sort(far, axis=1)
        return np.array([np.searchsorted(o, f, side="right") for o, f in zip(order, far, strict=True)]).reshape(far.shape)


@dataclass
class Probe:
    """Queries whose links against all points say how many cells must be visited.

    They are drawn from all points by a hash of their own, as points that the codebooks were fitted on lie nearer to them
    than others. One half are the first of the draw, the other the first of each cell in turn, so that small clusters
    are asked about beside a hot one. A link belongs to one of ``BANDS`` equal bands of cosine, from the threshold to one.
    """

    index: MultiIndex
    threshold: float
    names: list[str]
    vectors: np.ndarray
    homes: np.ndarray
    places: np.ndarray

    @classmethod
    def choose(cls, index: MultiIndex, names: list[str], drawn: np.ndarray, threshold: float, queries: int = QUERIES) -> Probe:
        homes = index.homes(drawn)
        turn: dict[int, int] = {}
        turns = []
        for home in homes.tolist():
            turns.append(turn.get(home, 0))
            turn[home] = turns[-1] + 1
        by_cell = np.argsort(turns, kind="stable")[:queries]
        at = np.union1d(np.arange(min(queries, len(drawn))), by_cell)
        return cls(index, threshold, [names[i] for i in at], drawn[at], homes[at], index.places(drawn[at]))

    def count(self, names: list[str], unit: np.ndarray, seen: np.ndarray) -> None:
        """Adds the links of the queries with some points to ``seen``, by query, band and the least reach that finds them."""
        near = self.vectors @ unit.T
        own = {name: i for i, name in enumerate(self.names)}
        for column, name in enumerate(names):
            if name in own:
                near[own[name], column] = -2.0
        query, point = np.nonzero(near >= self.threshold)
        if not len(query):
            return
        linked, back = np.unique(point, return_inverse=True)
        homes, places = self.index.homes(unit[linked]), self.index.places(unit[linked])
        self._add(query, homes[back], places[back, self.homes[query]], near[query, point], seen)

    def _add(self, query: np.ndarray, home: np.ndarray, from_point: np.ndarray, cosine: np.ndarray, seen: np.ndarray) -> None:
        """A link is found if either point visits the other's home."""
        place = np.minimum(self.places[query, home], from_point)
        step = np.searchsorted(self.index.reaches, place)
        band = ((cosine - self.threshold) / max(1 - self.threshold, 1e-9) * BANDS).astype(int).clip(0, BANDS - 1)
        np.add.at(seen, (query, band, step), 1)

    def blank(self) -> np.ndarray:
        return np.zeros((len(self.names), BANDS, len(self.index.reaches)), dtype=np.int64)

    def planted(self, seed: int = 4) -> np.ndarray:
        """Twins of the queries, ``TWINS`` each, at the threshold in random directions."""
        twins = np.repeat(self.vectors, TWINS, axis=0)
        aside = np.random.default_rng(seed).standard_normal(twins.shape)
        aside -= (aside * twins).sum(axis=1, keepdims=True) * twins
        length = np.sqrt((aside**2).sum(axis=1, keepdims=True))
        aside = np.where(length > 1e-9, aside / np.maximum(length, 1e-9), 0)
        twins = self.threshold * twins + np.sqrt(max(0.0, 1 - self.threshold**2)) * aside
        query, seen = np.repeat(np.arange(len(self.names)), TWINS), self.blank()
        for at in range(0, len(twins), 1024):
            part, asked = twins[at : at + 1024], query[at : at + 1024]
            back = self.index.places(part)[np.arange(len(part)), self.homes[asked]]
            self._add(asked, self.index.homes(part), back, np.full(len(part), self.threshold), seen)
        return seen

    def recalls(self, seen: np.ndarray) -> dict[str, np.ndarray]:
        """Recall by reach: of planted twins, of all links alike, and of each band that has links.

        In a band each query counts with the share of its links found, over the number of its links in all bands and
        one, so a cluster counts about once, however many of its points were asked. Planted twins likewise.
        """
        found = np.cumsum(seen, axis=2)
        total, weight = found[:, :, -1], 1.0 / (1 + found[:, :, -1].sum(axis=1))
        out = {"planted": weight @ (np.cumsum(self.planted(), axis=2).sum(axis=1) / TWINS) / weight.sum()}
        if total.any():
            out["links"] = found.sum(axis=(0, 1)) / total.sum()
        for band in range(BANDS):
            some = total[:, band] > 0
            if some.any():
                share = found[some, band] / total[some, band, None]
                out[f"band {band + 1}"] = weight[some] @ share / weight[some].sum()
        return out


def measure(points: DataFrame, probe: Probe, size: int) -> dict[str, np.ndarray]:
    """Recalls of the probe's queries, whose links are sought among all ``points`` (columns p and v) by brute force."""
    sent = points.sparkSession.sparkContext.broadcast(probe)

    def seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = sent.value.blank()
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                sent.value.count(part.column(0).to_pylist(), _unit(_padded(part.column(1).to_pylist(), size)), seen)
        at = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(x, type=pa.int64()) for x in (*at, seen[at])], names=["q", "band", "step", "n"])

    rows = points.select("p", "v").mapInArrow(seek, "q bigint, band bigint, step bigint, n bigint")
    seen = probe.blank()
    # At most queries * bands * reaches rows.
    for row in rows.groupBy("q", "band", "step").agg(F.sum("n").alias("n")).collect():
        seen[row.q, row.band, row.step] = row.n
    return probe.recalls(seen)


def fit_index(points: DataFrame, size: int, threshold: float, recall: float, codewords: int, sample: int) -> MultiIndex:
    """The index of a bounded sample, with as many cells to visit as ``recall`` takes over links with all points."""
    rows = points.orderBy(F.xxhash64("p"), "p").limit(sample).select("v").toArrow()
    index = MultiIndex.fit(_unit(_padded(rows["v"].to_pylist(), size)), codewords)
    drawn = points.orderBy(F.xxhash64(F.lit("query"), "p"), "p").limit(8 * QUERIES).select("p", "v").toArrow()
    unit = _unit(_padded(drawn["v"].to_pylist(), size))
    recalls = measure(points, Probe.choose(index, drawn["p"].to_pylist(), unit, threshold), size)
    enough = np.all([r >= recall for r in recalls.values()], axis=0)
    step = int(np.argmax(enough)) if enough.any() else len(enough) - 1
    index.visits = int(index.reaches[step])
    said = ", ".join(f"{name} {r[step]:.4f}" for name, r in recalls.items())
    logger.info("%d cells of %d are visited; recall: %s", index.visits, index.reaches[-1], said)
    return index


def _squared(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    cross = vectors @ centres.T
    return (vectors**2).sum(axis=1)[:, None] - 2 * cross + (centres**2).sum(axis=1)[None, :]


def _codebook(vectors: np.ndarray, size: int, rounds: int = 8) -> np.ndarray:
    """k-means from evenly spaced rows of the sample, which is in hash order."""
    size = max(1, min(size, len(vectors)))
    centres = vectors[np.linspace(0, len(vectors) - 1, size).astype(int)].copy()
    for _ in range(rounds):
        near = _squared(vectors, centres).argmin(axis=1)
        counts = np.bincount(near, minlength=size)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, vectors)
        some = counts > 0
        centres[some] = sums[some] / counts[some, None]
    return centres


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one. Each is scaled by its largest component first, so that no square overflows or vanishes."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def link_vectors(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    codewords: int = CODEWORDS,
    sample: int = SAMPLE,
) -> DataFrame:
    """Rows ``vec_id, n_links, component_id, kept`` for every input row: how many other rows it is linked to by a cosine of
    ``threshold`` or more, in double precision, and the smallest vec_id of its class.

    A vector that is null, empty, zero or not finite in some component links with nothing. Vectors of different lengths are
    compared as if the shorter one went on with zeros. Repeated rows (and equal vectors) are linked rows. A null vec_id is allowed;
    it names no class unless the class has no other id. Other columns are not read.

    Equal vectors are one point with a count, so they never meet in pairs. Codebooks are fitted on the ``sample``
    points of smallest hash. The links of some of them with all points are found by brute force, and the number of cells
    to visit is raised until ``recall`` of these links is reached, in all and by band of cosine, and of planted twins at the
    threshold. Every point is stored once, in its nearest cell, and asks in each cell that it visits, so it is copied 1 + visits
    times. A pair that both ends would find counts once, as stored points carry the cells they visit. A cell of more than
    ``STORED`` points is cut into blocks, and those that ask there into slices. A comparison gives back counts
    and a spanning forest of its links, never all pairs.
    """
    spark = ready(vectors.sparkSession)
    rows = vectors.select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("v")
    )
    rows = rows.withColumn("ok", usable(F.col("v")))
    points = rows.where("ok").groupBy("v").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
    # A point's number stems from the whole vector, so it is the same in every attempt.
    points = written(points.select(F.sha2(F.to_json(F.struct("v")), 256).alias("p"), "v", "least", "n"), "vector-points")
    size = points.agg(F.max(F.size("v"))).first()[0] or 0
    own = F.col("n") - 1
    if not size:
        singles = rows.select("vec_id")
        return _named(singles.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    index = fit_index(points, size, threshold, recall, codewords, sample)
    sent = spark.sparkContext.broadcast(index)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                unit = _unit(_padded(part.column(1).to_pylist(), size))
                near = sent.value.traverse(unit, sent.value.visits)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(list(unit), type=pa.list_(pa.float64())), part.column(2), pa.array(near[:, 0]),
                     pa.array(list(near), type=pa.list_(pa.int32()))], names=["p", "u", "n", "cell", "near"]
                )

    shape = "p string, u array<double>, n bigint, cell int, near array<int>"
    placed = written(points.select("p", "v", "n").mapInArrow(cells, shape), "vector-cells")
    asked = placed.select(F.explode("near").alias("cell"))
    # At most codewords ** 2 rows, whatever the number of points.
    per_cell = lambda df, n: df.groupBy("cell").agg(F.ceil(F.count("*") / STORED).cast("int").alias(n))
    cuts = F.broadcast(written(per_cell(placed, "blocks").join(per_cell(asked, "slices"), "cell"), "vector-cuts"))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    part_of = lambda n: F.pmod(F.xxhash64("p"), n).cast("int")
    none = F.lit(None).cast("array<int>").alias("near")
    stored = placed.join(cuts, "cell").withColumn("home", F.col("cell"))
    stored = stored.select("cell", part_of("blocks").alias("block"), each("slices").alias("slice"), "home", "p", "u", "n", "near")
    asking = placed.select(F.explode("near").alias("cell"), F.col("cell").alias("home"), "p", "u", "n").join(cuts, "cell")
    asking = asking.select("cell", each("blocks").alias("block"), part_of("slices").alias("slice"), "home", "p", "u", "n", none)
    met = stored.union(asking)
    cells_in_all = int(index.reaches[-1])

    def compare(group: pa.Table) -> pa.Table:
        kept = group.column("near").is_valid().to_numpy()
        unit = group.column("u").combine_chunks().flatten().to_numpy().reshape(len(kept), -1)
        names, counts, homes = (group.column(c).to_pylist() for c in ("p", "n", "home"))
        counts, homes = np.array(counts, dtype=np.float64), np.array(homes)
        _, rank = np.unique(names, return_inverse=True)
        right, left = np.flatnonzero(kept), np.flatnonzero(~kept)
        visits = np.zeros((len(right), cells_in_all), dtype=bool)
        near = np.array([v for v in group.column("near").to_pylist() if v is not None]).reshape(len(right), -1)
        visits[np.arange(len(right))[:, None], near] = True
        total, forest, edges = np.zeros(len(names)), Forest(rank), []
        for at in range(0, len(left), BLOCK):
            some = left[at : at + BLOCK]
            row, column = np.nonzero(unit[some] @ unit[right].T >= threshold)
            a, b = some[row], right[column]
            # A pair may meet in the home of either: it counts where the smaller one asks, or where the other does not ask back.
            once = (rank[a] < rank[b]) | ~visits[column, homes[a]]
            a, b = a[once], b[once]
            total += np.bincount(a, counts[b], len(names)) + np.bincount(b, counts[a], len(names))
            edges += forest.join(a, b)
        some = np.flatnonzero(total).tolist()
        out = {
            "a": [names[i] for i in some] + [names[i] for i, _ in edges],
            "b": [None] * len(some) + [names[j] for _, j in edges],
            "n": [int(total[i]) for i in some] + [0] * len(edges),
        }
        return pa.table(out, schema=pa.schema([("a", pa.string()), ("b", pa.string()), ("n", pa.int64())]))

    found = written(met.groupBy("cell", "block", "slice").applyInArrow(compare, "a string, b string, n bigint"), "vector-links")
    counts = found.where("b is null").groupBy("a").agg(F.sum("n").alias("links"))
    edges = found.where("b is not null").select("a", "b")
    roots = connected_classes(edges, "vectors")
    known = points.join(counts, points["p"] == counts["a"], "left").drop("a").join(roots, F.col("p") == roots["id"], "left")
    known = known.select("v", "least", (own + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "p").alias("root"))
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(least, "root").select("v", "n_links", "component_id")
    linked = rows.join(known, "v", "left")
    return _named(
        linked.select(
            "vec_id",
            F.when(F.col("ok"), F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
            F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"),
        )
    )


def _named(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _padded(vectors: list[list[float]], size: int) -> np.ndarray:
    out = np.zeros((len(vectors), max(size, 2)))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


class Forest:
    """Keeps of the links that it is given those that join what was not joined; ``points`` has equal numbers for equal points."""

    def __init__(self, points: np.ndarray):
        self.points, self.label = points, np.arange(len(points))

    def join(self, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        """``a`` ascending."""
        out = []
        starts = np.flatnonzero(np.diff(a, prepend=-1))
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(a)]):
            i, others = int(a[start]), b[start:end]
            own = self.label[self.points[i]]
            labels, at = np.unique(self.label[self.points[others]], return_index=True)
            new = labels != own
            if new.any():
                out += [(i, j) for j in others[at[new]].tolist()]
                self.label[np.isin(self.label, labels)] = own
        return out
