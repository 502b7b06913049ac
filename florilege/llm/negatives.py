"""Hard negatives of anchors among all vectors, by branch and bound in ball trees.

Vectors are dealt into blocks of about ``BLOCK_ROWS`` rows and anchors into
blocks of about ``ANCHOR_ROWS``; a task gets one block of either, builds the
vectors' ball tree and walks it for all its anchors at once.  A node's centre
and radius bound the inner product of its vectors with an anchor above and
below: a node is left out where all its scores lie outside an anchor's score
windows, or strictly beneath the k-th best found so far.  What the blocks found
is merged by ranks; no block sees all vectors and nothing is broadcast.

First pass: each anchor's best rows of its own label.  Second pass: for each of
those positives the best rows of other labels whose score lies in its window.

Defined results: rows with a null label or vector, or with a null or non-finite
component, take no part; a null id is never an anchor and comes behind all ids.
A shorter vector counts as filled up with zeros.  Rows that repeat, id and all,
are rows of their own: a repeated anchor gives its result for each, with its
copies among its positives.  Ties go to the smaller id.  Scores are exact while
they lie within 64 bits.  An empty table, or one without anchors, gives an
empty result.  Other columns don't matter, whatever they are called.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from florilege.llm.shared import materialize_table, release

#: Vectors and anchors to a task; rows of a leaf; anchors that walk a tree together.
BLOCK_ROWS, ANCHOR_ROWS, LEAF, TOGETHER = 8192, 4096, 96, 64
#: Every how manieth id is an anchor; how many positives, and negatives of each; least part of a positive's score, in hundredths.
EVERY, POSITIVES, NEGATIVES, LEAST = 100, 5, 5, 80
#: Below this, sums of products are exact in doubles.
EXACT = 2.0**53
NO_ID = np.iinfo(np.int64).max
BEYOND = np.iinfo(np.int64).min

FOUND = "anchor long, slot int, score long, vec_id long, mark long"
FOUND_ARROW = pa.schema([("anchor", pa.int64()), ("slot", pa.int32()), ("score", pa.int64()), ("vec_id", pa.int64()), ("mark", pa.int64())])


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """mark, vec_id, label, v (whole numbers) of the rows that take part; labels of every seventh id are turned on by one."""
    v = F.col("embedding")
    sound = F.col("label").isNotNull() & v.isNotNull() & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    label = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * 256).cast("long"))
    return embeddings.filter(sound).select(F.monotonically_increasing_id().alias("mark"), "vec_id", label.cast("long").alias("label"), whole.alias("v"))


@dataclass
class Block:
    """Rows of a task as arrays."""

    mark: np.ndarray
    vec_id: np.ndarray
    label: np.ndarray
    v: np.ndarray

    @classmethod
    def of(cls, table: pa.Table) -> Block:
        n = table.num_rows
        column = table.column("v").combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        ends = column.offsets.to_numpy()
        flat, width = column.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]], np.diff(ends)
        v = np.zeros((n, int(width.max(initial=0))), np.int64)
        v[np.arange(v.shape[1]) < width[:, None]] = flat
        ids = table.column("vec_id").fill_null(NO_ID).to_numpy()
        return cls(table.column("mark").to_numpy(), ids, table.column("label").to_numpy(), v)

    def wide(self, width: int) -> np.ndarray:
        return np.pad(self.v, ((0, 0), (0, width - self.v.shape[1])))


class BallTree:
    """Nodes over ranges of ``order``; a node splits at the middle of the line between two far points."""

    def __init__(self, points: np.ndarray, label: np.ndarray, vec_id: np.ndarray, leaf: int = LEAF) -> None:
        self.order = np.arange(len(points))
        self.nodes: list[tuple[int, int, int, int]] = []  # from, to, left, right (-1: leaf)
        centres, radii, labels, ids = [], [], [], []
        todo = [(0, len(points), -1, 0)]
        while todo:
            lo, hi, parent, side = todo.pop()
            me, at = len(self.nodes), self.order[lo:hi]
            own = points[at]
            centre = own.mean(axis=0)
            away = np.sqrt(((own - centre) ** 2).sum(axis=1))
            self.nodes.append((lo, hi, -1, -1))
            centres.append(centre)
            radii.append(away.max())
            labels.append(label[at[0]] if (label[at] == label[at[0]]).all() else BEYOND)
            ids.append(vec_id[at].min())
            if parent >= 0:
                a, b, left, right = self.nodes[parent]
                self.nodes[parent] = (a, b, me, right) if side == 0 else (a, b, left, me)
            if hi - lo > leaf:
                first = own[away.argmax()]
                second = own[((own - first) ** 2).sum(axis=1).argmax()]
                split = np.argpartition(own @ (second - first), (hi - lo) // 2)
                self.order[lo:hi] = at[split]
                middle = lo + (hi - lo) // 2
                todo += [(middle, hi, me, 1), (lo, middle, me, 0)]
        self.centre, self.radius, self.label, self.least_id = np.array(centres), np.array(radii), np.array(labels), np.array(ids)


class Best:
    """The best ``k`` so far for each anchor and window: by score, then smaller id, then mark."""

    def __init__(self, anchors: int, windows: int, k: int) -> None:
        shape = (anchors, windows, k)
        self.score, self.vec_id, self.mark = np.full(shape, BEYOND), np.full(shape, NO_ID), np.full(shape, NO_ID)

    def add(self, who: np.ndarray, score: np.ndarray, fits: np.ndarray, vec_id: np.ndarray, mark: np.ndarray) -> None:
        """``score``: anchors x rows; ``fits``: anchors x windows x rows."""
        k = self.score.shape[2]
        for w in range(self.score.shape[1]):
            better = fits[:, w] & (score >= self.score[who, w, -1][:, None])
            some = np.flatnonzero(better.any(axis=1))
            if not len(some):
                continue
            at, ok = who[some], better[some]
            s = np.concatenate([self.score[at, w], np.where(ok, score[some], BEYOND)], axis=1)
            i = np.concatenate([self.vec_id[at, w], np.where(ok, vec_id, NO_ID)], axis=1)
            m = np.concatenate([self.mark[at, w], np.where(ok, mark, NO_ID)], axis=1)
            order = np.lexsort((m, i, np.where(s == BEYOND, NO_ID, -s)), axis=1)[:, :k]
            for own, new in ((self.score, s), (self.vec_id, i), (self.mark, m)):
                own[at, w] = np.take_along_axis(new, order, axis=1)


def search(anchors: Block, rows: Block, low: np.ndarray, high: np.ndarray, same: bool, k: int) -> Best:
    """Of ``rows`` with the anchor's own label (or another) the best k in each score window, both ends included.

    ``low`` and ``high``: anchors x windows; an empty window has its low end above its high end.
    """
    width = max(anchors.v.shape[1], rows.v.shape[1])
    q, p = anchors.wide(width), rows.wide(width)
    top = float(np.abs(q.astype(float)).max(initial=0)) * float(np.abs(p.astype(float)).max(initial=0)) * max(width, 1)
    real_q, real_p = q.astype(float), p.astype(float)
    exact = (lambda a, b: (real_q[a] @ real_p[b].T).astype(np.int64)) if top < EXACT else (lambda a, b: q[a] @ p[b].T)
    slack = 1 + top * 1e-12
    best = Best(len(q), low.shape[1], k)
    if not len(q) or not len(p):
        return best
    tree = BallTree(real_p, rows.label, rows.vec_id)
    norm = np.sqrt((real_q**2).sum(axis=1))
    for begin in range(0, len(q), TOGETHER):
        todo = [(0, np.arange(begin, min(begin + TOGETHER, len(q))))]
        while todo:
            node, who = todo.pop()
            lo, hi, left, right = tree.nodes[node]
            if tree.label[node] != BEYOND:
                who = who[(anchors.label[who] == tree.label[node]) == same]
            middle, reach = real_q[who] @ tree.centre[node], norm[who] * tree.radius[node] + slack
            over, under, kth = (middle + reach)[:, None], (middle - reach)[:, None], best.score[who, :, -1]
            needed = (over >= low[who]) & (under <= high[who]) & (low[who] <= high[who])
            needed &= (kth == BEYOND) | (over >= kth)
            who = who[needed.any(axis=1)]
            if not len(who):
                continue
            if left >= 0:
                # the child that promises more comes first
                near = (real_q[who] @ (tree.centre[left] - tree.centre[right])).sum() >= 0
                todo += [(right, who), (left, who)] if near else [(left, who), (right, who)]
                continue
            at = tree.order[lo:hi]
            score = exact(who, at)
            fits = ((anchors.label[who][:, None] == rows.label[at]) == same) & (anchors.mark[who][:, None] != rows.mark[at])
            fits = fits[:, None, :] & (score[:, None, :] >= low[who][:, :, None]) & (score[:, None, :] <= high[who][:, :, None])
            best.add(who, score, fits, rows.vec_id[at], rows.mark[at])
    return best


def _found(anchors: Block, best: Best) -> pa.Table:
    a, w, k = np.nonzero(best.mark != NO_ID)
    ids = best.vec_id[a, w, k]
    return pa.table(
        {
            "anchor": anchors.mark[a], "slot": w.astype(np.int32), "score": best.score[a, w, k],
            "vec_id": pa.array(ids, mask=ids == NO_ID), "mark": best.mark[a, w, k],
        }
    )


def _cells(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, find) -> DataFrame:
    """Each block of rows with each block of anchors: the stated queries against all rows, in blocks."""
    blocks, parts = max(1, -(-n_rows // BLOCK_ROWS)), max(1, -(-n_anchors // ANCHOR_ROWS))
    own, other = F.pmod(F.xxhash64("mark"), F.lit(blocks)), F.pmod(F.xxhash64("mark"), F.lit(parts))
    cell = lambda row, part: (row * parts + part).cast("long").alias("cell")
    left = rows.select("*", own.alias("b"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("x")).withColumn("cell", cell(F.col("b"), F.col("x"))).drop("b", "x")
    right = anchors.select("*", other.alias("b"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("x")).withColumn("cell", cell(F.col("x"), F.col("b")))

    # both sides come of one table: columns of one origin would be taken for the same
    right = right.select("cell", *(F.col(c).alias(f"anchor_{c}") for c in anchors.columns))

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        b = b.rename_columns([c.removeprefix("anchor_") for c in b.column_names])
        try:
            return find(Block.of(a), b) if a.num_rows and b.num_rows else pa.table({"anchor": [], "slot": [], "score": [], "vec_id": [], "mark": []}, schema=FOUND_ARROW)
        finally:
            release()

    return left.groupBy("cell").cogroup(right.groupBy("cell")).applyInArrow(run, FOUND)


def _first(found: DataFrame, k: int, *by: str) -> DataFrame:
    """The best k of each group with their rank; ranks are cut before the shuffle too."""
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "mark")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _find_positives(rows: Block, table: pa.Table) -> pa.Table:
    anchors = Block.of(table)
    ends = np.full((len(anchors.mark), 1), float("inf"))
    return _found(anchors, search(anchors, rows, -ends, ends, True, POSITIVES))


def _find_negatives(rows: Block, table: pa.Table) -> pa.Table:
    anchors = Block.of(table)
    scores = Block.of(table.select(["mark", "vec_id", "label", "scores"]).rename_columns(["mark", "vec_id", "label", "v"])).v
    width = np.diff(table.column("scores").combine_chunks().offsets.to_numpy()) if table.num_rows else np.zeros(0, int)
    # 80 * positive <= 100 * negative <= 100 * positive, in whole numbers; slots without a positive have an empty window
    low, high = -((-LEAST * scores) // 100), scores.copy()
    none = np.arange(scores.shape[1]) >= width[:, None]
    low[none], high[none] = 1, 0
    return _found(anchors, search(anchors, rows, low, high, False, NEGATIVES))


def anchors_of(rows: DataFrame, is_anchor: Column | None = None) -> DataFrame:
    return rows.filter(F.col("vec_id") % EVERY == 0 if is_anchor is None else is_anchor)


def hard_negatives(embeddings: DataFrame, is_anchor: Column | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for each anchor and positive."""
    rows = materialize_table(whole_vectors(embeddings))
    anchors = anchors_of(rows, is_anchor)
    n_rows, n_anchors = rows.count(), anchors.count()
    positives = _first(_cells(rows, anchors, n_rows, n_anchors, _find_positives), POSITIVES, "anchor")
    positives = materialize_table(positives.select("anchor", (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    scores = positives.groupBy("anchor").agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", "positive_score"))), lambda x: x["positive_score"]).alias("scores"))
    asking = anchors.join(scores, anchors.mark == scores.anchor).drop("anchor")
    negatives = _first(_cells(rows, asking, n_rows, n_anchors, _find_negatives), NEGATIVES, "anchor", "slot")
    negatives = negatives.select("anchor", "slot", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    ids = anchors.select(F.col("mark").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return positives.join(negatives, ["anchor", "slot"]).join(ids, "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
