"""Substring dedup against plain Python."""

import hashlib

import numpy as np
import pytest

from regstar.llm import super_kmers
from regstar.llm.super_kmers import dedup_substrings
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.conftest import pairs

SMALL = dict(chunk=3000, bucket=500, crowded=400)  # many chunks and buckets, and crowded ones


def plain(docs, k=13):
    first = {}
    for d, t in docs:
        words = brute.WORD.findall(t or "")
        for i in range(len(words) - k + 1):
            if d is not None:
                x = tuple(words[i : i + k])
                first[x] = min(first.get(x, d), d)
    out = []
    for d, t in docs:
        words, gone = brute.WORD.findall(t or ""), set()
        for i in range(len(words) - k + 1):
            if d is not None and first[tuple(words[i : i + k])] < d:
                gone.update(range(i, i + k))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((d, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(docs, **sizes):
    return sorted(pairs(dedup_substrings(docs, **sizes), "doc_id", "n_words", "n_removed", "kept_sha256"), key=repr)


@pytest.mark.parametrize("sizes", [{}, SMALL])
def test_given_documents(small_docs, sizes):
    want = plain(pairs(small_docs, "doc_id", "text"))
    assert sum(r[2] for r in want) > 1000
    assert got(small_docs, **sizes) == want


@pytest.mark.parametrize("sizes", [{}, SMALL])
def test_odd_documents(odd_docs, sizes):
    assert got(odd_docs, **sizes) == plain(pairs(odd_docs, "doc_id", "text"))


def test_no_documents(no_docs):
    assert got(no_docs) == []


def test_long_texts_shared_passages_and_one_id_with_several_texts(spark):
    rng = np.random.default_rng(5)
    words = np.array([f"w{i}" for i in range(40)])

    def text(n):
        return " ".join(rng.choice(words, n))

    passage, line = text(30), text(6)  # the line is in windows with other words around it
    rows = [(i, f"{text(9)} {line} {text(9)} {passage if i % 3 == 0 else ''}\n{text(5)}") for i in range(120)]
    rows += [(7, text(40)), (7, passage), (8, passage + " tail"), (8, passage + " tail"), (None, passage), (500, "same " * 30_000)]
    rows += [(400, "same " * 20), (501, text(60_000)), (502, rows[-1][1]), (-3, "\x1f".join(["unit"] * 40)), (-2, passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = plain(rows)
    assert got(docs) == want
    assert got(docs, chunk=50_000, bucket=200, crowded=300) == want


def test_windows_with_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(super_kmers, "_mix", lambda x: x % np.uint64(3))
    chunk = super_kmers.Chunk(3, 2)
    rng = np.random.default_rng(1)
    rows = [(d, [b"%d" % x for x in rng.integers(0, 14, 60)]) for d in range(9)]
    for d, words in rows:
        chunk.add(d, 0, words)
    chunk.sort()
    first = {}
    for d, words in rows:
        for i in range(58):
            first.setdefault(tuple(words[i : i + 3]), d)
    want = [first[tuple(words[i : i + 3])] < d for d, words in rows for i in range(58)]
    inside = chunk.row[: len(chunk.settled)] == chunk.row[2:]
    assert chunk.settled[inside].tolist() == want and any(want)


def test_word_hashes_see_every_byte():
    words = [b"a", b"aa", b"x" * 70, b"x" * 64 + b"y" + b"x" * 5, b"y" + b"x" * 69, b"\xc3\xa9", b"\x00a", b"a\x00", b"\x1f"]
    begins, ends, hashes = super_kmers._words(b" ".join(words))
    assert [(b" ".join(words))[a:b] for a, b in zip(begins, ends)] == words
    assert len(set(hashes.tolist())) == len(words)


def test_query_registered(spark):
    from regstar.llm.queries import QUERIES

    assert QUERIES["op11_substring_dedup"](spark, SF_SMALL).count() == 200
