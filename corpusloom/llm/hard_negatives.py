"""Hard-negative mining by Fagin's threshold algorithm.

Rows are dealt into blocks by a hash of their id. A block keeps one list of its rows per dimension,
sorted by that component. For an anchor the lists are read from the end that raises its score (the
sign of the anchor's component says which), all to the same depth, deeper in each round; every row that
shows up is scored in whole by random access. The components last read give a threshold that no unseen
row can pass; reading stops once it falls strictly below the k-th score of every window asked for, or
below the window. Anchors meet the blocks in chunks, so a task holds one block and one chunk; the best
rows of the blocks are then ranked per anchor.

A first search finds the positives, whose scores set the windows; a second one finds the negatives.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import materialise

#: Rows of a block and anchors of a chunk: what one task holds.
BLOCK_ROWS, CHUNK_ANCHORS = 16_384, 512
#: Depth of the first round of sorted access; each round doubles it.
FIRST_DEPTH = 16
_LONG = np.iinfo(np.int64)


def integer_rows(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, v): every component floored after scaling, one row per vec_id.

    Rows with a null id or label, a null vector, or a null or non-finite component take no part. Of rows
    with the same id the one with the smallest label, then vector, stays. Components saturate at the
    limits of a long.
    """
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    whole = F.transform(x, lambda c: F.floor(c * scale).cast("long"))
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.when(finite, whole).alias("v"),
    ).filter("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("row"))
    return one.select("vec_id", "row.label", "row.v")


class Block:
    """Rows of one block with a sorted list per dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.x = ids[by_id], labels[by_id], vectors[by_id]
        self.lists = np.argsort(self.x, axis=0, kind="stable").astype(np.int32)
        self._most = max((abs(int(v)) for v in (self.x.min(initial=0), self.x.max(initial=0))), default=0)
        self._doubles = self.x.astype(np.float64)

    def scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Exact integer inner products, saturated at the limits of a long."""
        return self._products(rows, anchor, lambda table: table[rows])

    def _products(self, rows, anchor, of):
        bound = self._most * max((abs(int(a)) for a in anchor), default=0) * max(len(anchor), 1)
        if bound < 1 << 53:
            return (of(self._doubles) @ anchor.astype(np.float64)).astype(np.int64)
        if bound < 1 << 63:
            return of(self.x) @ anchor
        exact = of(self.x).astype(object) @ anchor.astype(object)
        return np.array([min(max(v, _LONG.min), _LONG.max) for v in exact], np.int64)

    def search(self, anchor: np.ndarray, settled) -> tuple[np.ndarray, np.ndarray, int]:
        """Rows seen by sorted access, their scores, and the depth read.

        settled(rows, scores, threshold) tells whether rows unseen, which score `threshold` at most, can
        still matter.
        """
        n = len(self.ids)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        if not len(up) and not len(down):
            every = np.arange(n)
            return every, np.zeros(n, np.int64), n
        seen, rows, scores = np.zeros(n, bool), [], []
        depth = 0
        while depth < n:
            to = min(n, max(2 * depth, FIRST_DEPTH))
            shown = np.concatenate([self.lists[n - to : n - depth, up].ravel(), self.lists[depth:to, down].ravel()])
            seen_now = np.zeros(n, bool)
            seen_now[shown] = True
            fresh = np.flatnonzero(seen_now & ~seen)
            seen |= seen_now
            rows.append(fresh)
            scores.append(self.scores(fresh, anchor))
            edge = np.zeros((1, len(anchor)), np.int64)
            edge[0, up] = self.x[self.lists[n - to, up], up]
            edge[0, down] = self.x[self.lists[to - 1, down], down]
            threshold = int(self._products(None, anchor, lambda table: edge.astype(table.dtype))[0])
            depth = to
            if depth < n and settled(rows, scores, threshold):
                break
        return np.concatenate(rows), np.concatenate(scores), depth

    def best(self, rows: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        """Places of the first k by falling score, then rising id."""
        return np.lexsort((self.ids[rows], -scores.astype(object) if len(scores) and scores.min() == _LONG.min else -scores))[:k]

    def positives(self, anchor_id: int, label: int, anchor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the first k other rows of the anchor's label."""
        fit = (self.labels == label) & (self.ids != anchor_id)
        need = min(k, int(fit.sum()))
        if not need:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)

        def settled(rows, scores, threshold):
            return sum(int((fit[r] & (s > threshold)).sum()) for r, s in zip(rows, scores, strict=True)) >= need

        rows, scores, _ = self.search(anchor, settled)
        rows, scores = rows[fit[rows]], scores[fit[rows]]
        first = self.best(rows, scores, k)
        return self.ids[rows[first]], scores[first]

    def negatives(self, label: int, anchor: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[tuple]:
        """Per window (lowest, highest score): ids and scores of its first k rows of other labels."""
        fit = self.labels != label

        def settled(rows, scores, threshold):
            held = np.concatenate([s[fit[r]] for r, s in zip(rows, scores, strict=True)])
            return all(
                threshold < low or low > high or ((held > threshold) & (held >= low) & (held <= high)).sum() >= k
                for low, high in windows
            )

        rows, scores, _ = self.search(anchor, settled)
        rows, scores = rows[fit[rows]], scores[fit[rows]]
        out = []
        for low, high in windows:
            inside = np.flatnonzero((scores >= low) & (scores <= high))
            first = inside[self.best(rows[inside], scores[inside], k)]
            out.append((self.ids[rows[first]], scores[first]))
        return out


def window_of(positive_score: int, low: int, high: int) -> tuple[int, int]:
    """Least and greatest integer score n with low * p <= 100 * n <= high * p."""
    return -(-low * positive_score // 100), high * positive_score // 100


def _vectors(column: pa.ChunkedArray, size: int) -> np.ndarray:
    column = column.combine_chunks()
    return np.asarray(column.flatten(), np.int64).reshape(len(column), -1 if size and len(column) else 0)


def _block(table: pa.Table) -> Block:
    return Block(
        np.asarray(table["vec_id"], np.int64), np.asarray(table["label"], np.int64), _vectors(table["v"], table["dim"][0].as_py())
    )


def _met(rows: DataFrame, anchors: DataFrame, n_blocks: int, n_chunks: int):
    """Blocks and chunks of anchors of the same number of dimensions, each pair a group of bounded size."""
    dim = F.size("v").alias("dim")
    chunks = F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))).alias("chunk")
    blocks = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block")
    dealt = F.xxhash64("vec_id")
    left = rows.select("*", dim, F.pmod(dealt, F.lit(n_blocks)).cast("int").alias("block"), chunks)
    right = anchors.select("*", dim, blocks, F.pmod(F.xxhash64(dealt), F.lit(n_chunks)).cast("int").alias("chunk"))
    by = ["dim", "block", "chunk"]
    return left.groupBy(*by).cogroup(right.groupBy(*by))


def _table(rows: list[tuple], names: list[str]) -> pa.Table:
    table = np.array(rows, np.int64).reshape(-1, len(names))
    return pa.table({name: table[:, i] for i, name in enumerate(names)})


def mine(
    rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    block_rows: int = BLOCK_ROWS, chunk_anchors: int = CHUNK_ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from `integer_rows`.

    Anchors are the rows whose id is divisible by `every`; all rows are searched. An anchor's positives
    are its first `positives` other rows of its label; per anchor and positive the first `negatives` rows
    of other labels with low * positive_score <= 100 * negative_score <= high * positive_score are
    ranked. Higher scores come first, ties by smaller id. Fewer rows than asked for give fewer results; an
    anchor without a positive, or a window without a row, gives none, as a window of a negative positive
    score does. Only vectors of equal length are compared; empty vectors score 0. Scores saturate at the
    limits of a long. An empty table gives an empty result.
    """
    rows = materialise(rows, "vectors")
    n = rows.count()
    anchors = materialise(rows.filter(F.pmod("vec_id", F.lit(every)) == 0), "anchors")
    n_blocks, n_chunks = max(1, -(-n // block_rows)), max(1, -(-anchors.count() // chunk_anchors))

    def near(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            block = _block(left)
            vectors = _vectors(right["v"], right["dim"][0].as_py())
            for a, label, v in zip(right["vec_id"].to_pylist(), right["label"].to_pylist(), vectors, strict=True):
                found += [(a, i, s) for i, s in zip(*block.positives(a, label, v, positives), strict=True)]
        return _table(found, ["anchor_id", "positive_id", "positive_score"])

    first = _met(rows, anchors, n_blocks, n_chunks).applyInArrow(
        near, "anchor_id long, positive_id long, positive_score long"
    )
    by_score = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    first = first.withColumn("place", F.row_number().over(by_score)).filter(F.col("place") <= positives)
    windows = first.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("found")  # at most `positives`
    )
    asked = materialise(anchors.join(windows, "vec_id"), "windows")

    def far(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            block = _block(left)
            vectors = _vectors(right["v"], right["dim"][0].as_py())
            for a, label, wanted, v in zip(
                right["vec_id"].to_pylist(), right["label"].to_pylist(), right["found"].to_pylist(), vectors, strict=True
            ):
                bounds = [window_of(w["positive_score"], low, high) for w in wanted]
                for w, (ids, scores) in zip(wanted, block.negatives(label, v, bounds, negatives), strict=True):
                    found += [(a, w["positive_id"], i, w["positive_score"], s) for i, s in zip(ids, scores, strict=True)]
        return _table(found, ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"])

    best = _met(rows, asked, n_blocks, n_chunks).applyInArrow(
        far, "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"
    )
    by_score = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = best.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
