import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from regstar.llm import simhash as S
from tests.llm import brute
from tests.llm.conftest import pairs


@pytest.mark.parametrize("which", ["odd_docs", "small_docs"])
def test_against_all_pairs(request, which):
    docs = request.getfixturevalue(which)
    got = sorted(pairs(S.near_duplicates(docs), "doc_id", "fingerprint", "component_id"), key=repr)
    assert got == sorted(brute.simhash_rows(pairs(docs, "doc_id", "text")), key=repr)


def test_crowded_trie_is_split_and_loses_no_link(spark):
    """Fingerprints around a few centres, cells of 16: the walk goes deep."""
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 2**63, 3, dtype=np.uint64)
    fps = {int(c) for c in centres}
    for _ in range(900):
        x = int(centres[rng.integers(3)])
        for b in rng.integers(0, 64, rng.integers(0, 7)):
            x ^= 1 << int(b)
        fps.add(x)
    fps = np.array(sorted(fps), np.uint64)
    frame = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    shared = S.SharedTables(spark, "test")
    cells, levels = S._cells(frame, shared, 16)
    found = S._cell_pairs(spark, levels, shared, 3).collect()
    members = {}
    for d, p in pairs(cells, "depth", "prefix"):
        members[p, d] = fps[(fps >> np.uint64(64 - d)).astype(np.int64) == p]
    assert sum(map(len, members.values())) == len(fps) and max(map(len, members.values())) <= 16
    links = []
    for r in found:
        a, b = members[r.p, r.dp], members[r.q, r.dq]
        same = (r.p, r.dp) == (r.q, r.dq)
        i, j = S.join_cells(a, None if same else b, min(r.dp, r.dq), r["diff"], 3)
        both = a if same else np.concatenate((a, b))
        links += list(zip(both[i].tolist(), both[j].tolist()))
    every = [(int(x), int(y)) for i, x in enumerate(fps) for y in fps[i + 1 :][np.bitwise_count(fps[i + 1 :] ^ x) <= 3]]
    assert all(bin(a ^ b).count("1") for a, b in links)
    assert brute.components(links, fps.tolist()) == brute.components(every, fps.tolist())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=40), st.lists(st.integers(0, 63), max_size=40), st.integers(0, 5))
def test_join_of_two_subtrees(values, flips, bits):
    a = np.unique(np.array(values, np.uint64))
    b = np.setdiff1d(np.unique(np.array([v ^ (1 << f) ^ (1 << (f // 2)) for v, f in zip(values * 2, flips)] or [0], np.uint64)), a)
    i, j = S.join_cells(a, b, 0, 0, bits)
    both = np.concatenate((a, b)).tolist()
    got = brute.components([(both[x], both[y]) for x, y in zip(i, j)], both)
    every = [(int(x), int(y)) for x in a for y in b if bin(int(x) ^ int(y)).count("1") <= bits]
    assert got == brute.components(every, both)


def test_one_of_each_keeps_whole_rows(odd_docs, no_docs):
    kept = S.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    want = {d for d, _, c in brute.simhash_rows(pairs(odd_docs, "doc_id", "text")) if d == c and d is not None}
    ids = [r[0] for r in pairs(kept, "doc_id")]
    assert sorted(i for i in ids if i is not None) == sorted(want) and ids.count(None) == 1  # the row of nulls is one of the empty texts
    assert S.one_of_each(no_docs).count() == 0 and S.near_duplicates(no_docs).count() == 0


def test_one_of_each_tells_rows_apart_by_all_columns(spark):
    """Several texts under one id, and copies without an id."""
    text = lambda i: " ".join(f"w{(i * 7919 + k * 104729) % 1000}" for k in range(60))
    rows = [(1, text(1)), (1, text(2)), (1, text(2)), (2, text(1)), (None, text(1)), (None, text(3)), (None, text(3)), (5, text(2))]
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = S.one_of_each(docs)
    assert sorted(pairs(kept, "doc_id", "text"), key=repr) == sorted([(1, text(1)), (1, text(2)), (None, text(3))], key=repr)
    assert kept.columns == docs.columns
