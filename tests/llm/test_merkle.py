"""Merkle manifest against plain Python."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from regstar.llm import merkle
from regstar.llm.merkle import LEAF_COLUMNS, manifest, path_digest
from tests.llm.conftest import pairs


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest(*last[i : i + 3]) for i in range(0, len(last), 3)])
    return levels


def walk(levels, i):
    for level in levels[:-1]:
        first = i // 3 * 3
        yield level[first:i], level[i + 1 : first + 3]
        i //= 3


def tampers(row):
    return row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0


def plain(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)."""
    by_source = defaultdict(list)
    for r in rows:
        by_source[r[1]].append((r[0] is not None, r[0] or 0, leaf(r), r))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for s in sources:
        by_source[s].sort(key=lambda x: x[:3])
    trees = {s: tree([x[2] for x in by_source[s]]) for s in sources}
    top = tree([trees[s][-1][0] for s in sources])
    out = []
    for nth, s in enumerate(sources):
        for i, (_, _, own, r) in enumerate(by_source[s]):
            path = [*walk(trees[s], i), *walk(top, nth)]
            folded = leaf((*r[:4], r[4].replace("\n", ""))) if tampers(r) else own
            for before, after in path:
                folded = digest(*before, folded, *after)
            root = top[-1][0]
            proof = digest(*(h for before, after in path for h in before + after))
            out.append((r[0], own, trees[s][-1][0], root, proof, folded, folded == root))
    return sorted(out, key=repr)


def got(docs):
    changed = F.when(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.translate("text", "\n", "")
    )
    proven = manifest(docs, tampered=changed)
    cols = ("doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified")
    return sorted(pairs(proven.withColumn("proof", path_digest(F.col("path"))), *cols), key=repr)


def test_given_documents(small_docs):
    want = plain(pairs(small_docs, *LEAF_COLUMNS))
    assert 0 < sum(r[6] for r in want) < len(want)
    assert got(small_docs) == want


def test_odd_documents(odd_docs):
    """Null ids, sources and texts, repeated rows, columns with clashing names."""
    assert got(odd_docs) == plain(pairs(odd_docs, *LEAF_COLUMNS))


def test_no_documents(no_docs):
    assert got(no_docs) == []


@pytest.mark.parametrize("sizes", [[1], [3], [4], [82], [1, 1, 1, 1], [9, 10, 27, 28], [1] * 12 + [250, 7]])
def test_trees_of_any_size(spark, sizes, monkeypatch):
    monkeypatch.setattr(merkle, "STRIDE", 2)  # families of nine: several of them at small sizes
    rows = [
        (i * 1000 + j, f"s{i}" if i else None, "en", j, f"line\n{j}" if j % 5 else None)
        for i, n in enumerate(sizes)
        for j in range(n)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert got(docs.repartition(4)) == plain(rows)


def test_large_source_over_many_parts_and_ties(spark):
    rows = [(i // 3, "hot" if i % 9 else f"é{i}", None, 1, f"{i % 2}\n") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert got(docs.repartition(16)) == plain(rows)
