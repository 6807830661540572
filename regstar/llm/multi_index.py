"""Hard negatives by an inverted multi-index.

Vectors are scored by integer inner product. Two codebooks, one for each half
of the components, are fitted by k-means on a bounded sample; a pair of codes
is a cell. Rows are dealt into blocks by the hash of their ids, and each block
sorts its rows by cell and keeps, for each code, the largest distance of its
rows' half from the centroid. For a query q a half's score is then at most
q . centroid + |q| * radius, and a cell's at most the sum of its two halves'.

A multi-sequence heap visits the cells of a block by that sum: the codes of
either half are sorted by their bounds, and a popped cell (i, j) opens (i, j + 1)
and, for j = 0, (i + 1, 0). The rows of visited cells are scored exactly. What is
not visited scores at most the bound on top of the heap, so a search ends as
soon as that certifies its result: for the positives, when it is below the last
of them; for the windows of negatives, when each one is full above it or begins
above it. Results are therefore exact; the index only saves work.

The anchors are a stated set of queries, sent to every block; a task has one
block and at most ``anchors_per_task`` of them. Each returns a few rows for
each anchor and block, merged by anchor.

Defined cases: rows with a null id, label or vector, or a null or non-finite
component, take no part; of rows with one id the smallest (label, vector) does;
missing components of shorter vectors are 0; ties are broken by the smaller id;
anchors without positives, and windows without rows, give no rows; an empty
table gives none; other columns are ignored. Inner products must fit 64 bits.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regstar.llm.shared import SharedTables, columns, for_workers

FOUND = "anchor long, other long, score long, wanted long"
SLACK = 1e-6  # relative rounding error of a bound, generously


def integer_vectors(rows: DataFrame, scale: int) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part: floor(scale * x)."""
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    kept = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & usable)
    one = F.min(F.struct("label", "vector")).alias("row")
    return kept.select("vec_id", F.col("label").cast("long").alias("label"), whole.alias("vector")).groupBy("vec_id").agg(one).select(
        "vec_id", "row.label", "row.vector"
    )


# ---------------------------------------------------------------- codebooks


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (((centroids**2).sum(1)) - 2 * (x @ centroids.T)).argmin(1)


def codebook(x: np.ndarray, codes: int, rounds: int = 8) -> np.ndarray:
    """Centroids of ``x`` by k-means from evenly spread rows."""
    centroids = x[np.unique(np.linspace(0, len(x) - 1, codes).astype(int))].astype(np.float64)
    for _ in range(rounds):
        code = _nearest(x, centroids)
        for c in range(len(centroids)):
            if (code == c).any():
                centroids[c] = x[code == c].mean(0)
    return centroids


def _matrix(column, dim: int) -> np.ndarray:
    """Rows of a list column as int64, padded with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy().astype(np.int64)
    if len(lengths) and (lengths == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(lengths), dim), np.int64)
    out[np.arange(dim) < lengths[:, None]] = flat
    return out


# -------------------------------------------------------------------- block


class MultiIndex:
    """The rows of one block, by cell."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, books: list[np.ndarray], most: int):
        half = books[0].shape[1]
        halves = (vectors[:, :half], vectors[:, half:])
        codes = [_nearest(h, book) for h, book in zip(halves, books)]
        self.books, self.half = books, half
        self.radii = []
        for h, code, book in zip(halves, codes, books):
            far = np.zeros(len(book))
            np.maximum.at(far, code, np.sqrt(((h - book[code]) ** 2).sum(1)))
            self.radii.append(far)
        self.second = len(books[1])
        cell = codes[0] * self.second + codes[1]
        order = np.lexsort((ids, cell))
        self.ids, self.labels = ids[order], labels[order]
        self.first = np.searchsorted(cell[order], np.arange(len(books[0]) * self.second + 1)).tolist()
        # The narrowest numbers that hold every inner product with a component up to `most`.
        largest = float(np.abs(vectors).max(initial=0)) * most * vectors.shape[1]
        self.kind = np.float32 if largest < 1 << 24 else np.float64 if largest < 1 << 53 else np.int64
        self.vectors = vectors[order].astype(self.kind)

    def visits(self, q: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """(rows, scores, bound): the next cells' rows, and what bounds the score
        of every row not given yet; more rows with every step."""
        x, exact = q.astype(np.float64), q.astype(self.kind)
        bounds, order = [], []
        for part, book, far in zip((x[: self.half], x[self.half :]), self.books, self.radii):
            bound = book @ part + np.sqrt(part @ part) * far
            by = np.argsort(-bound)
            order.append(by.tolist())
            bounds.append((bound[by] + SLACK * (1 + np.abs(bound[by]))).tolist())
        (u, v), (a, b), first = bounds, order, self.first
        heap, parts, size, enough = [(-u[0] - v[0], 0, 0)], [], 0, 512
        while heap:
            _, i, j = heap[0]
            cell = a[i] * self.second + b[j]
            begin, end = first[cell], first[cell + 1]
            if begin < end:
                parts.append(np.arange(begin, end))
                size += end - begin
            if j + 1 < len(v):
                heapq.heapreplace(heap, (-u[i] - v[j + 1], i, j + 1))
            else:
                heapq.heappop(heap)
            if j == 0 and i + 1 < len(u):
                heapq.heappush(heap, (-u[i + 1] - v[0], i + 1, 0))
            if size >= enough or (parts and not heap):
                rows = np.concatenate(parts)
                parts, size, enough = [], 0, 2 * enough
                yield rows, (self.vectors[rows] @ exact).astype(np.int64), -heap[0][0] if heap else -np.inf

    def positives(self, anchor: int, label: int, q: np.ndarray, n: int) -> list[tuple[int, int]]:
        """The first ``n`` other rows of the label as (score, id)."""
        best = np.zeros((2, 0), np.int64)
        for rows, scores, bound in self.visits(q):
            mine = (self.labels[rows] == label) & (self.ids[rows] != anchor)
            best = _first(np.hstack((best, np.stack((scores[mine], self.ids[rows[mine]])))), n)
            if best.shape[1] == n and best[0, -1] > bound:
                break
        return list(zip(*best.tolist()))

    def negatives(self, label: int, q: np.ndarray, windows: list[tuple[int, int]], n: int) -> list[list[tuple[int, int]]]:
        """For each window (low, high) of scores the first ``n`` rows of other
        labels in it."""
        best = [np.zeros((2, 0), np.int64) for _ in windows]
        lowest, highest = min(w[0] for w in windows), max(w[1] for w in windows)
        for rows, scores, bound in self.visits(q):
            other = (scores >= lowest) & (scores <= highest)
            other[other] = self.labels[rows[other]] != label
            s, ids = scores[other], self.ids[rows[other]]
            ended = True
            for k, (low, high) in enumerate(windows):
                inside = (s >= low) & (s <= high)
                if inside.any():
                    best[k] = _first(np.hstack((best[k], np.stack((s[inside], ids[inside])))), n)
                ended &= bound < low or (best[k].shape[1] == n and bound < best[k][0, -1])
            if ended:
                break
        return [list(zip(*b.tolist())) for b in best]


def _first(found: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` columns (score, id) by descending score, then id."""
    if found.shape[1] > 4 * n:  # all that ties with the n-th, at least
        least = -np.partition(-found[0], n - 1)[n - 1]
        found = found[:, found[0] >= least]
    return found[:, np.lexsort((found[1], -found[0]))[:n]]


def score_window(positive: int, low_percent: int, high_percent: int) -> tuple[int, int]:
    """(low, high): whole scores s with low_percent * p <= 100 * s <= high_percent * p."""
    return -(-low_percent * positive // 100), high_percent * positive // 100


# ------------------------------------------------------------------ operator


class Search:
    """Searches of anchors in the blocks of ``rows`` (vec_id, label, vector)."""

    def __init__(self, rows: DataFrame, anchors: DataFrame, books: list[np.ndarray], dim: int, block_rows: int, anchors_per_task: int):
        self.rows, self.anchors, self.books, self.dim = rows, anchors, books, dim
        self.blocks = max(8, -(-rows.count() // block_rows))
        self.groups = max(1, -(-anchors.count() // anchors_per_task))

    def run(self, asked: DataFrame, answer) -> DataFrame:
        """``FOUND`` rows; ``asked`` has (vec_id, label, vector, scores) for each
        anchor, and ``answer(index, id, label, vector, scores)`` gives (other,
        score, wanted)."""
        block = F.pmod(F.xxhash64("vec_id"), F.lit(self.blocks))
        group = F.pmod(F.xxhash64("vec_id", F.lit("group")), F.lit(self.groups))
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        none = F.array().cast("array<bigint>").alias("scores")
        index = self.rows.select("vec_id", "label", "vector", none, block.alias("block"), every(self.groups).alias("group"))
        asked = asked.select("vec_id", "label", "vector", "scores", group.alias("group"), every(self.blocks).alias("block"))
        both = index.withColumn("asks", F.lit(False)).unionByName(asked.withColumn("asks", F.lit(True)))
        task = F.col("block") * self.groups + F.col("group")
        dealt = both.withColumn("task", task).repartition("task").sortWithinPartitions("task", "asks")
        books, dim = self.books, self.dim

        def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            task, parts, index, out = None, [], None, []
            for batch in batches:
                ids, labels, tasks = (batch.column(i).to_numpy() for i in (0, 1, 4))
                asks = batch.column(5).to_numpy(zero_copy_only=False)
                vectors, scores = _matrix(batch.column(2), dim), batch.column(3)
                cuts = np.flatnonzero((np.diff(tasks) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
                for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ids)]):
                    if a == b:
                        continue
                    if tasks[a] != task:
                        task, parts, index = tasks[a], [], None
                    if not asks[a]:
                        parts.append((ids[a:b], labels[a:b], vectors[a:b]))
                        continue
                    if not parts:
                        continue  # a block without rows
                    most = int(np.abs(vectors[a:b]).max(initial=1))
                    if index is None or most > index.most:
                        index = MultiIndex(*(np.concatenate(x) for x in zip(*parts)), books, most)
                        index.most = most
                    for i in range(a, b):
                        found = answer(index, int(ids[i]), int(labels[i]), vectors[i], scores[i].as_py())
                        out += [(int(ids[i]), *f) for f in found]
                        if len(out) >= 8192:
                            yield _batch(out)
                            out = []
            yield _batch(out)

        return dealt.select("vec_id", "label", "vector", "scores", "task", "asks").mapInArrow(walk, FOUND)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in FOUND.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], names=names)


def hard_negatives(
    embeddings: DataFrame,
    is_anchor: Column,
    *,
    label: Column | None = None,
    scale: int = 256,
    positives: int = 5,
    negatives: int = 3,
    low_percent: int = 50,
    high_percent: int = 95,
    codes: int = 16,
    sample: int = 10_000,
    block_rows: int = 200_000,
    anchors_per_task: int = 100_000,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)
    over ``embeddings`` (vec_id, embedding, label). ``is_anchor`` and ``label``
    (in place of the column) are conditions on vec_id and label. The codebooks
    are fitted on at most ``sample`` rows, those with the smallest hashes of
    their ids; all rows are indexed."""
    spark = for_workers(embeddings.sparkSession)
    shared = SharedTables(spark, "multi_index")
    rows = columns(embeddings, "vec_id", "embedding", "label")
    if label is not None:
        rows = rows.withColumn("label", label)
    rows = shared.put(integer_vectors(rows, scale), "rows")
    dim = max(rows.agg(F.max(F.size("vector"))).first()[0] or 0, 2)
    some = rows.select("vector", F.xxhash64("vec_id").alias("h")).orderBy("h").limit(sample).select("vector").toArrow()
    picked = np.concatenate([_matrix(c, dim) for c in some.column(0).chunks]) if some.num_rows else np.zeros((1, dim))
    half = dim // 2
    books = [codebook(picked[:, :half], codes), codebook(picked[:, half:], codes)]
    anchors = rows.where(is_anchor)
    search = Search(rows, anchors, books, dim, block_rows, anchors_per_task)

    def near(index, anchor, own, q, _):
        return [(other, score, 0) for score, other in index.positives(anchor, own, q, positives)]

    found = search.run(anchors.withColumn("scores", F.array().cast("array<bigint>")), near)
    by_anchor = Window.partitionBy("anchor").orderBy(F.desc("score"), "other")
    first = found.withColumn("nth", F.row_number().over(by_anchor)).where(F.col("nth") <= positives)
    first = shared.put(first.select(F.col("anchor").alias("vec_id"), F.col("other").alias("positive_id"), "score"), "positives")

    def below(index, anchor, own, q, wanted):
        windows = {p: score_window(p, low_percent, high_percent) for p in wanted}
        windows = {p: w for p, w in windows.items() if w[0] <= w[1]}
        if not windows:
            return []
        best = index.negatives(own, q, list(windows.values()), negatives)
        return [(other, score, p) for p, few in zip(windows, best) for score, other in few]

    asked = anchors.join(first.groupBy("vec_id").agg(F.collect_set("score").alias("scores")), "vec_id")
    found = search.run(asked, below)
    by_window = Window.partitionBy("anchor", "wanted").orderBy(F.desc("score"), "other")
    last = found.withColumn("rank", F.row_number().over(by_window)).where(F.col("rank") <= negatives)
    last = last.select(
        F.col("anchor").alias("vec_id"), F.col("wanted").alias("score"), "rank", F.col("other").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    return first.join(last, ["vec_id", "score"]).select(
        F.col("vec_id").alias("anchor_id"), "positive_id", "rank", "negative_id",
        F.col("score").alias("positive_score"), "negative_score",
    )
