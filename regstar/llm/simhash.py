"""SimHash near-duplicates: a self-join of the fingerprints' binary trie.

A fingerprint has 64 bits, one for each bit position that more than half of
the text's shingle hashes set. Two texts are linked if their fingerprints
differ in at most ``max_bits`` bits; a component is what links reach.

The distinct fingerprints form a binary trie. Its upper part is walked as
tables: a pair of nodes at one depth is replaced by the pairs of their
children, the differing bits of the two paths are added up, and a pair above
``max_bits`` is pruned. A node with at most ``cell`` fingerprints is not
opened further, so a crowded region (many near copies) is split deeper than
the rest and no task gets an unbounded group. For each pair of such cells that
is left, a worker goes on down the two subtrees in the same way on sorted
arrays, and compares the last few fingerprints bit by bit. It returns a
spanning forest of the links it found, not all pairs: connectivity is whole,
and a cell pair gives at most as many rows as it has fingerprints.

Equal texts meet before the trie (one node for each distinct fingerprint).

Defined cases: a null text is an empty text; no words gives fingerprint zero,
linked like any other; fewer words than a shingle make one shingle; a null
doc_id has its fingerprint's component, and a component of null ids alone is
null; repeated rows give repeated result rows; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regstar.llm.components import connected_components
from regstar.llm.shared import SharedTables, columns, for_workers

BITS = 64
SEED = 42
STEP = 2  # bits by which a table of trie nodes is deeper than the one before


# ---------------------------------------------------------------- fingerprint


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash over XXH64 of the text's word shingles (repeats count)."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    size = min(shingle, len(words))
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    begins = (ends - lengths)[: len(words) - size + 1].tolist()
    ends = ends[size - 1 :].tolist()
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(begins), 1 << 16):
        part = slice(i, i + (1 << 16))
        hashes = np.array([digest(joined[b:e], SEED) for b, e in zip(begins[part], ends[part])], np.uint64)
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(begins)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, key, fp): fp is the fingerprint as a signed long; ``key`` is that
    of ``docs``, null where it has none."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fps.view(np.int64))], names=["doc_id", "key", "fp"]
            )

    return docs.select("doc_id", "key", "text").mapInArrow(of, "doc_id long, key string, fp long")


# ------------------------------------------------------------- upper trie


def _prefix(depth: int):
    return F.shiftrightunsigned("fp", BITS - depth)


def _cells(distinct: DataFrame, shared: SharedTables, cell: int) -> tuple[DataFrame, list[DataFrame]]:
    """The trie's cells as (depth, prefix), and its nodes by level as
    (parent, node, leaf). Each fingerprint is in one cell."""
    n = distinct.count()
    depth = STEP * max(1, int(np.log2(max(n // cell, 1))) // STEP)
    found = shared.put(
        distinct.groupBy(_prefix(depth).alias("node")).agg(F.count("*").alias("n")), f"nodes{depth}"
    )
    by_level = {}
    top = found
    for d in range(depth - STEP, 0, -STEP):  # levels above the first table are all opened
        top = top.select(F.expr(f"shiftrightunsigned(node, {STEP})").alias("node")).distinct()
        by_level[d] = top.select("node", F.lit(False).alias("leaf"))
    leaves = []
    while True:
        flagged = found.select("node", (F.col("n") <= cell).alias("leaf"))
        by_level[depth] = flagged
        leaves.append(found.where(F.col("n") <= cell).select(F.lit(depth).alias("depth"), F.col("node").alias("prefix")))
        crowded = found.where(F.col("n") > cell).select(F.col("node").alias("up"))
        if crowded.isEmpty():
            break
        depth += STEP
        below = distinct.withColumn("up", _prefix(depth - STEP)).join(crowded, "up")
        found = shared.put(below.groupBy(_prefix(depth).alias("node")).agg(F.count("*").alias("n")), f"nodes{depth}")
    levels = [
        by_level[d].select(F.expr(f"shiftrightunsigned(node, {STEP})").alias("parent"), "node", "leaf")
        for d in sorted(by_level)
    ]
    cells = leaves[0]
    for more in leaves[1:]:
        cells = cells.unionByName(more)
    return cells, levels


def _cell_pairs(spark, levels: list[DataFrame], shared: SharedTables, max_bits: int) -> DataFrame:
    """Pairs of cells (p at depth dp, q at depth dq) whose common bits differ
    in ``diff`` <= max_bits places. Walks the levels from the root; a cell
    stays as it is while the other side is opened."""
    pairs = spark.createDataFrame(
        [(0, 0, False, 0, 0, False, 0)], "p long, dp int, p_leaf boolean, q long, dq int, q_leaf boolean, diff int"
    )
    for i, level in enumerate(levels):
        depth = STEP * (i + 1)

        def children(side: str):
            # A cell opens to itself; its level is above, so it has no children here.
            return level.select(
                F.col("parent").alias(f"{side}_up"), F.col("node").alias(f"{side}_node"), F.col("leaf").alias(f"{side}_new")
            )

        opened = pairs
        for side in "pq":
            done = opened.where(f"{side}_leaf").withColumns(
                {f"{side}_node": F.col(side), f"{side}_new": F.lit(True), f"{side}_depth": F.col(f"d{side}")}
            )
            more = (
                opened.where(f"NOT {side}_leaf")
                .join(children(side), F.col(side) == F.col(f"{side}_up"))
                .drop(f"{side}_up")
                .withColumn(f"{side}_depth", F.lit(depth))
            )
            opened = done.unionByName(more)
        step_bits = F.when(
            F.col("p_leaf") | F.col("q_leaf"), F.lit(0)
        ).otherwise(F.bit_count(F.col("p_node").bitwiseXOR(F.col("q_node")).bitwiseAND(F.lit((1 << STEP) - 1))))
        one_order = (F.col("p") != F.col("q")) | (F.col("dp") != F.col("dq")) | (F.col("p_node") <= F.col("q_node"))
        new = opened.where(one_order).select(
            F.col("p_node").alias("p"), F.col("p_depth").alias("dp"), F.col("p_new").alias("p_leaf"),
            F.col("q_node").alias("q"), F.col("q_depth").alias("dq"), F.col("q_new").alias("q_leaf"),
            (F.col("diff") + step_bits).cast("int").alias("diff"),
        ).where(F.col("diff") <= max_bits)
        pairs = shared.put(new, f"pairs{depth}")
    return pairs.select("p", "dp", "q", "dq", "diff")


# ------------------------------------------------------------- lower trie


def join_cells(a: np.ndarray, b: np.ndarray | None, depth: int, diff: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between sorted arrays of fingerprints ``a`` and ``b`` (within
    ``a`` if ``b`` is None) that share a path of ``depth`` bits with ``diff``
    differing ones, as a spanning forest (positions in a, then b)."""
    alone = b is None
    b = a if alone else b
    label = np.arange(len(a) + (0 if alone else len(b)))
    shift = 0 if alone else len(a)
    nodes = np.array([[0, len(a), 0, len(b), diff]], np.int64)
    small = 64
    while len(nodes):
        a0, a1, b0, b1, d = nodes.T
        few = (a1 - a0) * (b1 - b0) <= small if depth < BITS else np.ones(len(nodes), bool)
        for x, y in _compare(a, b, nodes[few], alone, max_bits):
            _unite(label, x, y + shift)
        a0, a1, b0, b1, d = nodes[~few].T
        if not len(a0):
            break
        ones_a, ones_b = _ones(a, depth), _ones(b, depth)
        am, bm = a1 - (ones_a[a1] - ones_a[a0]), b1 - (ones_b[b1] - ones_b[b0])
        same = (a0 == b0) & (a1 == b1) & alone
        parts = [(a0, am, b0, bm, d), (am, a1, bm, b1, d), (a0, am, bm, b1, d + 1)]
        nodes = np.concatenate(
            [np.stack(x, 1) for x in parts] + [np.stack((am, a1, b0, bm, d + 1), 1)[~same]]
        )
        nodes = nodes[(nodes[:, 0] < nodes[:, 1]) & (nodes[:, 2] < nodes[:, 3]) & (nodes[:, 4] <= max_bits)]
        depth += 1
    child = np.flatnonzero(label != np.arange(len(label)))
    return child, label[child]


def _ones(x: np.ndarray, depth: int) -> np.ndarray:
    """Number of fingerprints before each position whose bit ``depth`` is set."""
    bits = (x >> np.uint64(BITS - 1 - depth)) & np.uint64(1)
    return np.concatenate(([0], np.cumsum(bits, dtype=np.int64)))


def _compare(a, b, nodes, alone: bool, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked positions under node pairs that are compared fingerprint by
    fingerprint, some million at a time."""
    sizes = (nodes[:, 1] - nodes[:, 0]) * (nodes[:, 3] - nodes[:, 2])
    ends = np.cumsum(sizes)
    first = 0
    while first < len(nodes):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + (1 << 21), "right")))
        part, size = nodes[first:last], sizes[first:last]
        k = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        wide = np.repeat(part[:, 3] - part[:, 2], size)
        x, y = np.repeat(part[:, 0], size) + k // wide, np.repeat(part[:, 2], size) + k % wide
        near = np.bitwise_count(a[x] ^ b[y]) <= max_bits
        if alone:
            near &= x < y
        yield x[near], y[near]
        first = last


def _unite(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Give linked positions one label, the smallest position of their part."""
    while True:
        lx, ly = label[x], label[y]
        apart = lx != ly
        if not apart.any():
            return
        x, y, lx, ly = x[apart], y[apart], lx[apart], ly[apart]
        np.minimum.at(label, np.maximum(lx, ly), np.minimum(lx, ly))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


# ------------------------------------------------------------------ operator


def near_duplicates(docs: DataFrame, *, shingle: int = 3, max_bits: int = 3, cell: int = 8192) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of ``docs``."""
    rows = columns(docs, "doc_id", "text").withColumn("key", F.lit(None).cast("string"))
    prints, named = _components(rows, shingle, max_bits, cell)
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _components(docs: DataFrame, shingle: int, max_bits: int, cell: int) -> tuple[DataFrame, DataFrame]:
    """(prints, named): the fingerprints of ``docs`` (doc_id, key, text), and
    (fp, root, component_id): the smallest fingerprint and doc_id of each one's component."""
    spark = for_workers(docs.sparkSession)
    shared = SharedTables(spark, "simhash")
    prints = shared.put(fingerprints(docs, shingle), "fingerprints")
    distinct = shared.put(prints.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "distinct")
    cells, levels = _cells(distinct, shared, cell)
    pairs = _cell_pairs(spark, levels, shared, max_bits)

    depths = [r[0] for r in cells.select("depth").distinct().collect()]  # at most 32
    in_cells = None
    for d in depths:
        part = distinct.select("fp", F.lit(d).alias("depth"), _prefix(d).alias("prefix"))
        in_cells = part if in_cells is None else in_cells.unionByName(part)
    edges = None
    if in_cells is not None:
        arrays = shared.put(
            in_cells.join(cells, ["depth", "prefix"]).groupBy("depth", "prefix").agg(F.collect_list("fp").alias("fps")),
            "cells",
        )
        left = arrays.select(F.col("depth").alias("dp"), F.col("prefix").alias("p"), F.col("fps").alias("p_fps"))
        right = arrays.select(F.col("depth").alias("dq"), F.col("prefix").alias("q"), F.col("fps").alias("q_fps"))
        rows = pairs.join(left, ["dp", "p"]).join(right, ["dq", "q"]).select("p", "dp", "q", "dq", "diff", "p_fps", "q_fps")

        def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for p, dp, q, dq, diff, fa, fb in zip(*(batch.column(i) for i in range(7))):
                    alone = (p.as_py(), dp.as_py()) == (q.as_py(), dq.as_py())
                    a = np.sort(fa.values.to_numpy().view(np.uint64))
                    b = None if alone else np.sort(fb.values.to_numpy().view(np.uint64))
                    child, root = join_cells(a, b, min(dp.as_py(), dq.as_py()), diff.as_py(), max_bits)
                    both = (a if alone else np.concatenate((a, b))).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(both[child]), pa.array(both[root])], names=["a", "b"])

        edges = rows.mapInArrow(walk, "a long, b long")
    if edges is None:
        edges = spark.createDataFrame([], "a long, b long")
    reached = connected_components(edges, shared)
    labelled = shared.put(
        distinct.join(reached.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", "first_doc", F.coalesce("component", "fp").alias("root")
        ),
        "labelled",
    )
    roots = shared.put(labelled.groupBy("root").agg(F.min("first_doc").alias("component_id")), "roots")
    named = shared.put(labelled.join(roots, "root").select("fp", "root", "component_id"), "named")
    return prints, named


def one_of_each(docs: DataFrame, *, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` without near-duplicates: of each component one row stays, that of
    the smallest doc_id (rows without one come last; of rows with one doc_id, that
    of the smallest digest). Rows are told apart by the digest of all their
    columns, so rows of one doc_id and different texts, and rows without a
    doc_id, are judged each for itself."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    have = {c.lower(): c for c in docs.columns}
    keyed = docs.select(
        row.alias("row"), F.sha2(F.to_json(row), 256).alias("key"),
        F.col(f"`{have['doc_id']}`").alias("doc_id"), F.col(f"`{have['text']}`").alias("text"),
    )
    prints, named = _components(keyed, shingle, max_bits, 8192)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")
    kept = prints.join(named, "fp").groupBy("root").agg(F.min(order).alias("first")).select("first.key")
    once = keyed.select("key", "row").join(kept, "key", "left_semi").groupBy("key").agg(F.first("row").alias("row"))
    return once.select("row.*")
