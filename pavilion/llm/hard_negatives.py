"""Hard negatives from a multiway hyperplane tree whose split points know their siblings' distances.

Vectors are lifted by one coordinate so that all have the same length. A score (an
inner product) with an anchor then says exactly how far a vector is from it, and a
window of scores is an annulus around the anchor.

The tree has two levels. Split points come from a bounded sample, picked far from each
other; every vector goes to its nearest one at either level. For each subtree, each
of its siblings' split points has the smallest and largest distance to the subtree's
vectors. An anchor's annulus, seen from a split point, is again an interval of
distances: a subtree whose interval does not meet it holds no vector of the window and
is not searched. Leaves are searched exactly, in blocks of bounded size.

Three searches lead to the result: an anchor's own leaf tells how good its positives
are at least, the tree gives the positives, and their scores give the windows of the
negatives.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pavilion.llm import workers
from pavilion.llm.storage import stored
from pavilion.llm.vectors import matrix, scaled, usable

SCALE, POSITIVES, NEGATIVES = 256, 5, 10
# Share of a positive's score, in hundredths, that a negative must have at least and at most.
WINDOW = (30, 90)
# Rows that the tree is fitted on, at most; rows that a leaf should hold; widest split.
SAMPLE, LEAF_ROWS, WIDEST = 8192, 512, 32
# Rows in a block of a leaf, rows of a leaf that are dealt together, anchors in a block.
BLOCK_ROWS, PART_ROWS, ANCHORS = 1024, 8192, 128
# Anchors of a task whose best rows are kept in memory before they are handed on.
_KEPT = 4096
# Scores are sums of exact products in double precision up to here.
_EXACT = 1 << 53
_SLACK = 1e-6

_FOUND = "row long, aim int, score long, other long, other_id long"


# ---- the tree ---------------------------------------------------------------


@dataclass
class Tree:
    """Split points (whole-number vectors) of the root and of each of its subtrees.

    ``level`` is the squared length that all vectors are lifted to. ``ranges[node]`` has,
    by subtree and sibling, the smallest and the largest distance between the sibling's
    split point and the subtree's vectors; node -1 is the root.
    """

    level: float
    points: dict[int, np.ndarray]
    ranges: dict[int, tuple[np.ndarray, np.ndarray]]

    def lifts(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.level - np.einsum("ij,ij->i", x, x), 0))

    def distances(self, node: int, x: np.ndarray) -> np.ndarray:
        """From lifted vectors ``x`` to the split points of ``node``."""
        points = self.points[node]
        across = 2 * self.level - 2 * (x @ points.T) - 2 * np.outer(self.lifts(x), self.lifts(points))
        return np.sqrt(np.maximum(across, 0))

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Subtree and leaf of each vector."""
        branch = self.distances(-1, x).argmin(axis=1)
        leaf = np.zeros(len(x), dtype=np.int64)
        for node in np.unique(branch).tolist():
            here = branch == node
            leaf[here] = self.distances(node, x[here]).argmin(axis=1)
        return branch, leaf

    @property
    def widest(self) -> int:
        """Leaves of the subtree that has most."""
        return max(len(p) for node, p in self.points.items() if node >= 0)

    def open_leaves(self, x: np.ndarray, least: np.ndarray, most: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """Leaves that may hold a score between ``least`` and ``most`` for vectors ``x``, and for which of them."""
        near, far = self.annuli(x, least, most)
        for branch, asked in self._open(-1, x, near, far):
            for leaf, inside in self._open(branch, x[asked], near[asked], far[asked]):
                yield branch, leaf, asked[inside]

    def annuli(self, x: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances from anchors ``x`` (which are not lifted) at which scores lie in the windows."""
        squares = np.einsum("ij,ij->i", x, x) + self.level
        slack = _SLACK * (squares + 1)
        near = np.sqrt(np.maximum(squares - 2 * most - slack, 0))
        far = squares - 2 * least + slack
        return near, np.where(far < 0, -1.0, np.sqrt(np.maximum(far, 0)))

    def _open(self, node: int, x: np.ndarray, near: np.ndarray, far: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        low, high = self.ranges[node]
        points = self.points[node]
        squares = np.einsum("ij,ij->i", x, x) + self.level
        away = np.sqrt(np.maximum(squares[:, None] - 2 * (x @ points.T), 0))
        slack = _SLACK * (1 + np.sqrt(self.level))
        # What a split point can see of the annulus.
        inner = np.maximum(away - far[:, None], near[:, None] - away) - slack
        outer = away + far[:, None] + slack
        for child in range(len(points)):
            meets = (inner <= high[child]) & (outer >= low[child]) & (far >= 0)[:, None]
            asked = np.flatnonzero(meets.all(axis=1))
            if len(asked):
                yield child, asked


def _spread_points(x: np.ndarray, wanted: int) -> np.ndarray:
    """Distinct rows of ``x`` far from each other: the farthest candidate from those picked, again and again."""
    x = np.unique(x, axis=0)
    candidates = x[:: max(1, len(x) // (3 * wanted))].astype(np.float64)
    picked = [0]
    nearest = ((candidates - candidates[0]) ** 2).sum(axis=1)
    while len(picked) < min(wanted, len(candidates)):
        nxt = int(nearest.argmax())
        if nearest[nxt] == 0:
            break
        picked.append(nxt)
        nearest = np.minimum(nearest, ((candidates - candidates[nxt]) ** 2).sum(axis=1))
    return candidates[picked]


def _fitted(sample: np.ndarray, rows: int, level: float) -> Tree:
    """Split points for ``rows`` vectors, from some of them."""
    width = min(WIDEST, max(2, math.ceil(math.sqrt(rows / LEAF_ROWS))))
    tree = Tree(level, {-1: _spread_points(sample, width)}, {})
    branch = tree.distances(-1, sample.astype(np.float64)).argmin(axis=1)
    for node in range(len(tree.points[-1])):
        here = sample[branch == node]
        tree.points[node] = _spread_points(here, width) if len(here) else tree.points[-1][node : node + 1]
    return tree


def _measured(tree: Tree, told: list) -> None:
    """Set the ranges from rows of branch, leaf and distances."""
    top = len(tree.points[-1])
    low, high = np.full((top, top), np.inf), np.full((top, top), -np.inf)
    for node in range(top):
        k = len(tree.points[node])
        tree.ranges[node] = np.full((k, k), np.inf), np.full((k, k), -np.inf)
    for r in told:
        least, most = np.array(r.least), np.array(r.most)
        low[r.branch], high[r.branch] = np.minimum(low[r.branch], least[:top]), np.maximum(high[r.branch], most[:top])
        k = len(tree.points[r.branch])
        tree.ranges[r.branch][0][r.leaf] = least[top : top + k]
        tree.ranges[r.branch][1][r.leaf] = most[top : top + k]
    tree.ranges[-1] = low, high


# ---- vectors in their leaves ------------------------------------------------


def _placed(tree: Tree, dimensions: int) -> Callable:
    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            branch, leaf = tree.leaves(matrix(batch["x"], dimensions, np.float64))
            others = {n: batch[n] for n in batch.schema.names}
            yield workers.batch(**others, branch=branch.astype(np.int32), leaf=leaf.astype(np.int32))

    return placed


def _leaf_ranges(tree: Tree, dimensions: int) -> Callable:
    """Per task and leaf: rows, and the least and largest distance to the split points of both levels.

    Goes by the leaf that a row was given, so that rounding cannot put it elsewhere.
    """
    top = len(tree.points[-1])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], list] = {}
        for batch in batches:
            x = matrix(batch["x"], dimensions, np.float64)
            both = batch["branch"].to_numpy().astype(np.int64) * WIDEST + batch["leaf"].to_numpy()
            for number in np.unique(both).tolist():
                here, key = x[both == number], divmod(number, WIDEST)
                away = np.zeros((len(here), top + tree.widest))
                away[:, :top] = tree.distances(-1, here)
                away[:, top : top + len(tree.points[key[0]])] = tree.distances(key[0], here)
                told = found.setdefault(key, [0, away[0], away[0]])
                told[0] += len(here)
                told[1], told[2] = np.minimum(told[1], away.min(axis=0)), np.maximum(told[2], away.max(axis=0))
        keys = list(found)
        yield workers.batch(
            branch=pa.array([k[0] for k in keys], pa.int32()),
            leaf=pa.array([k[1] for k in keys], pa.int32()),
            rows=pa.array([found[k][0] for k in keys], pa.int64()),
            least=pa.array([found[k][1].tolist() for k in keys], pa.list_(pa.float64())),
            most=pa.array([found[k][2].tolist() for k in keys], pa.list_(pa.float64())),
        )

    return measure


def _blocks(dimensions: int, size: int) -> Callable:
    """Rows that come sorted by leaf and part as blocks of at most ``size`` rows of one of them."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []

        def block(rows: pa.Table) -> pa.RecordBatch:
            rows = rows.combine_chunks()
            first = lambda n: pa.array([rows[n][0].as_py()], pa.int32())
            flat = lambda n, kind: pa.array([rows[n].to_numpy().astype(kind).tobytes()], pa.binary())
            x = np.concatenate([matrix(c, dimensions, np.float64) for c in rows["x"].chunks])
            return workers.batch(
                branch=first("branch"), leaf=first("leaf"), part=first("part"),
                rows=flat("row", "<i8"), ids=flat("vec_id", "<i8"), labels=flat("label", "<i8"),
                x=pa.array([x.astype("<f8").tobytes()], pa.binary()),
                aims=pa.array([b"".join(a for c in rows["aims"].chunks for a in c.to_pylist())], pa.binary()),
            )

        def flushed() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(kept)
            kept.clear()
            for at in range(0, table.num_rows, size):
                yield block(table.slice(at, size))

        last = None
        for batch in batches:
            keys = np.column_stack([batch[n].to_numpy() for n in ("branch", "leaf", "part")])
            cuts = (np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist()
            for start, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if start == end:
                    continue
                key = tuple(keys[start].tolist())
                if kept and (key != last or sum(b.num_rows for b in kept) >= size):
                    yield from flushed()
                last = key
                kept.append(batch.slice(start, end - start))
        if kept:
            yield from flushed()

    return blocks


_BLOCK = "branch int, leaf int, part int, rows binary, ids binary, labels binary, x binary, aims binary"


def _in_blocks(df: DataFrame, dimensions: int, size: int) -> DataFrame:
    order = df.repartition("branch", "leaf", "part").sortWithinPartitions("branch", "leaf", "part", "vec_id", "row")
    return workers.mapped(order, _blocks(dimensions, size), _BLOCK)


# ---- searches ---------------------------------------------------------------


@dataclass(frozen=True)
class Aim:
    """What an anchor looks for: the first ``k`` rows with its label, or with another one."""

    same_label: bool
    k: int


def _windows(aims: bytes, n: int) -> np.ndarray:
    """Windows of ``n`` anchors, as least and most by anchor and aim; without any, all scores."""
    if not aims:
        return np.broadcast_to(np.array([-math.inf, math.inf]), (n, 1, 2))
    return np.frombuffer(aims, "<f8").reshape(n, -1, 2)


def _routed(tree: Tree, dimensions: int, own: bool) -> Callable:
    """Anchor blocks with the leaves that may hold a row of one of their windows, or only with ``own`` leaf."""

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                if own:
                    leaves = {(one["branch"][0].as_py(), one["leaf"][0].as_py())}
                else:
                    x = np.frombuffer(one["x"][0].as_py(), "<f8").reshape(-1, dimensions)
                    windows, leaves = _windows(one["aims"][0].as_py(), len(x)), set()
                    for aim in range(windows.shape[1]):
                        asked = np.flatnonzero(windows[:, aim, 0] <= windows[:, aim, 1])
                        found = tree.open_leaves(x[asked], windows[asked, aim, 0], windows[asked, aim, 1])
                        leaves.update((branch, leaf) for branch, leaf, _ in found)
                if leaves:
                    told = pa.array([[{"branch": b, "leaf": n} for b, n in sorted(leaves)]], _LEAVES)
                    kept = {f"a_{n}": one[n] for n in ("rows", "labels", "x", "aims")}
                    yield workers.batch(**kept, leaves=told)

    return routed


_LEAVES = pa.list_(pa.struct([("branch", pa.int32()), ("leaf", pa.int32())]))
_ROUTED = "a_rows binary, a_labels binary, a_x binary, a_aims binary, leaves array<struct<branch:int,leaf:int>>"


def _best(scores: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k``: higher scores, then smaller ids, then earlier rows."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
        return some[np.lexsort((rows[some], ids[some], -scores[some]))[:k]]
    return np.lexsort((rows, ids, -scores))[:k]


def _scored(dimensions: int, aim: Aim) -> Callable:
    """The first rows of every anchor and window among the leaf blocks of a task."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

        def handed_on() -> pa.RecordBatch:
            keys = list(found)
            counts = [len(found[k][0]) for k in keys]
            join = lambda i: np.concatenate([found[k][i] for k in keys])
            out = workers.batch(
                row=np.repeat(np.array([k[0] for k in keys], np.int64), counts),
                aim=np.repeat(np.array([k[1] for k in keys], np.int32), counts),
                score=join(0), other=join(1), other_id=join(2),
            )
            found.clear()
            return out

        for batch in batches:
            for i in range(batch.num_rows):
                read = lambda n, kind, i=i, batch=batch: np.frombuffer(batch[n][i].as_py(), kind)
                anchors, asked = read("a_x", "<f8").reshape(-1, dimensions), read("a_rows", "<i8")
                windows = _windows(batch["a_aims"][i].as_py(), len(asked))
                ids, rows, labels = read("ids", "<i8"), read("rows", "<i8"), read("labels", "<i8")
                scores = (anchors @ read("x", "<f8").reshape(-1, dimensions).T).astype(np.int64)
                same = read("a_labels", "<i8")[:, None] == labels[None, :]
                right = (same & (asked[:, None] != rows[None, :])) if aim.same_label else ~same
                for a in range(len(asked)):
                    here = np.flatnonzero(right[a])
                    own = scores[a, here]
                    for w in range(windows.shape[1]):
                        least, most = windows[a, w]
                        inside = here[(own >= least) & (own <= most)]
                        if not len(inside):
                            continue
                        key, new = (int(asked[a]), w), (scores[a, inside], rows[inside], ids[inside])
                        if key in found:
                            new = tuple(map(np.concatenate, zip(found[key], new, strict=True)))
                        first = _best(*new, aim.k)
                        found[key] = tuple(v[first] for v in new)
                if len(found) > _KEPT * windows.shape[1]:
                    yield handed_on()
        if found:
            yield handed_on()

    return scored


def _search(tree: Tree, dimensions: int, anchors: DataFrame, leaves: DataFrame, parts: Column, aim: Aim, own: bool = False) -> DataFrame:
    """Rows ``aim`` asks for, for every anchor and window, best first by ``rank``."""
    routed = workers.mapped(anchors, _routed(tree, dimensions, own), _ROUTED)
    routed = routed.select("a_rows", "a_labels", "a_x", "a_aims", F.inline("leaves"))
    # Own leaves are looked into for a first bound only: one part of a hot leaf will do.
    last = F.lit(0) if own else F.coalesce(F.get(parts, F.col("branch") * WIDEST + F.col("leaf")), F.lit(1)) - 1
    routed = routed.withColumn("part", F.explode(F.sequence(F.lit(0), last.cast("int"))))
    meet = leaves.select("branch", "leaf", "part", "rows", "ids", "labels", "x").join(
        routed.hint("merge"), ["branch", "leaf", "part"]
    )
    meet = meet.select("a_rows", "a_labels", "a_x", "a_aims", "rows", "ids", "labels", "x")
    found = workers.mapped(meet, _scored(dimensions, aim), _FOUND)
    best = Window.partitionBy("row", "aim").orderBy(F.desc("score"), "other_id", "other")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= aim.k)


def _with_windows(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """Anchor rows with packed ``aims`` of ``windows`` (row, place, least, most), none for those without."""
    return rows.drop("aims").join(windows, "row")


def _packed(count: int) -> Callable:
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for windows in batch["windows"].to_pylist():
                told = np.full((count, 2), [math.inf, -math.inf])
                for w in windows:
                    told[w["place"]] = w["least"], w["most"]
                out.append(told.astype("<f8").tobytes())
            yield workers.batch(row=batch["row"], aims=pa.array(out, pa.binary()))

    return packed


def _aims(windows: DataFrame, count: int) -> DataFrame:
    """Packed windows of each anchor, from rows of ``row``, ``place``, ``least`` and ``most``."""
    each = windows.groupBy("row").agg(F.collect_list(F.struct("place", "least", "most")).alias("windows"))
    return workers.mapped(each, _packed(count), "row long, aims binary")


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW,
    scale: int = SCALE,
    sample: int = SAMPLE,
) -> DataFrame:
    """The hardest negatives inside a window below each positive of each anchor.

    Entries become ``floor(scale * c)``; a score is the inner product with the anchor.
    An anchor's positives are the ``positives`` other rows of its label with the highest
    scores; for each, the ``negatives`` rows of other labels with the highest scores
    ``s`` such that ``window[0] * p <= 100 * s <= window[1] * p``, ``p`` being the
    positive's score. Ties go to the smaller id. Returns ``anchor_id``, ``positive_id``,
    ``rank`` from 1, ``negative_id``, ``positive_score`` and ``negative_score``; a
    positive without negatives has no row. Results are exact, whatever the tree.

    ``label`` defaults to the column of that name and must be whole numbers. Rows with
    a null id, label or vector, or a null, infinite or other non-number entry, take no
    part; nor do, of vectors of several lengths, all but those of the most frequent one
    (of equals, the longest). Repeated rows are rows of their own: a copy of an anchor
    is its first positive. Without usable rows the result is empty. Other columns play
    no part, whatever their names. Entries so large that scores would not be exact in
    double precision are refused. ``sample`` bounds the rows the tree is fitted on.
    """
    label = F.col("label") if label is None else label
    plain = rows.where(usable(F.col(vector_column)) & (F.size(vector_column) > 0)).select(
        F.col(id_column).cast("long").alias("vec_id"), label.cast("long").alias("label"),
        scaled(F.col(vector_column), scale).alias("x"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    )
    plain = plain.where("vec_id IS NOT NULL AND label IS NOT NULL").withColumn("row", F.monotonically_increasing_id())
    plain = stored(plain, "vectors")
    spark = rows.sparkSession
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    common = plain.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if common is None:
        return spark.createDataFrame([], result)
    d = common.d
    plain = plain.where(F.size("x") == d)
    square = F.aggregate("x", F.lit(0.0), lambda t, v: t + v.cast("double") * v.cast("double"))
    level = plain.agg(F.max(square)).first()[0]
    if level >= _EXACT:
        raise ValueError("entries are too large for exact scores")
    # About ``sample`` rows, at most twice as many.
    some = F.pmod(F.xxhash64("row"), F.lit(common.n)) < sample
    picked = plain.where(some).select("x").limit(2 * sample).collect() or plain.select("x").limit(1).collect()
    tree = _fitted(np.array([r.x for r in picked], dtype=np.int64).reshape(-1, d), common.n, float(level))
    with_leaf = "row long, vec_id long, label long, x array<long>, anchor boolean, branch int, leaf int"
    placed = stored(workers.mapped(plain.select("row", "vec_id", "label", "x", "anchor"), _placed(tree, d), with_leaf), "placed")
    ranges = workers.mapped(
        placed.select("x", "branch", "leaf"), _leaf_ranges(tree, d),
        "branch int, leaf int, rows long, least array<double>, most array<double>",
    )
    edges = len(tree.points[-1]) + tree.widest
    each = [f(F.col(c)[i]).alias(f"{c}{i}") for c, f in (("least", F.min), ("most", F.max)) for i in range(edges)]
    told = ranges.groupBy("branch", "leaf").agg(F.sum("rows").alias("rows"), *each)
    # A row per leaf, of which there are at most the square of the widest split.
    told = told.select("branch", "leaf", "rows", *[F.array(*[f"{c}{i}" for i in range(edges)]).alias(c) for c in ("least", "most")]).collect()
    _measured(tree, told)
    counts = [1] * (WIDEST * WIDEST)
    for r in told:
        counts[r.branch * WIDEST + r.leaf] = math.ceil(r.rows / PART_ROWS)
    parts = F.array(*[F.lit(c) for c in counts])
    part = F.pmod(F.xxhash64("row"), F.get(parts, F.col("branch") * WIDEST + F.col("leaf")).cast("long")).cast("int")
    placed = placed.withColumn("part", part).withColumn("aims", F.lit(b""))
    leaves = stored(_in_blocks(placed.drop("anchor"), d, BLOCK_ROWS).drop("aims"), "leaves")
    anchors = placed.where("anchor").drop("anchor")

    search = lambda df, aim, own=False: _search(tree, d, _in_blocks(df, d, ANCHORS), leaves, parts, aim, own)
    # The last positive found in the anchor's own leaf bounds the scores from below.
    first = search(anchors, Aim(True, positives), own=True)
    bounds = first.where(F.col("rank") == positives).select("row", F.lit(0).alias("place"), F.col("score").cast("double").alias("least"))
    everything = anchors.select("row", F.lit(0).alias("place")).join(bounds, ["row", "place"], "left")
    bounds = everything.select("row", "place", F.coalesce("least", F.lit(-math.inf)).alias("least"), F.lit(math.inf).alias("most"))
    found = search(_with_windows(anchors, _aims(bounds, 1)), Aim(True, positives))
    found = stored(found.select("row", (F.col("rank") - 1).cast("int").alias("place"), "score", F.col("other_id").alias("positive_id")), "positives")

    # Whole numbers s with low * p <= 100 * s <= high * p.
    hundredth = lambda c: ((c - F.pmod(c, F.lit(100))) / 100).cast("double")  # noqa: E731  rounded down
    least, most = -hundredth(-F.col("score") * window[0]), hundredth(F.col("score") * window[1])
    windows = found.select("row", "place", least.alias("least"), most.alias("most")).where("least <= most")
    hard = search(_with_windows(anchors, _aims(windows, positives)), Aim(False, negatives))
    hard = hard.select("row", F.col("aim").alias("place"), "rank", F.col("other_id").alias("negative_id"), F.col("score").alias("negative_score"))
    told = found.withColumnRenamed("score", "positive_score").join(hard, ["row", "place"])
    told = told.join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
    return told.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
