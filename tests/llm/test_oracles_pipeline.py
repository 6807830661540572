import numpy as np
import pytest

import corpus_pipeline as P
from regstar.llm import pfair
from regstar.llm.packing import pack_in_order
from regstar.llm.queries import ORACLE_SQL, SOURCE_SHARES, tokenizer_path
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.conftest import pairs
from tests.oracle_compare import compare


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    report = compare(spark, SF_SMALL, [name])[name]
    assert report["columns_match"] and report["values_match"], report


def test_pipeline_against_python(spark, small_docs):
    from tokenizers import Tokenizer

    rows = pairs(small_docs, "doc_id", "text")
    kept = [(d, t) for d, t in rows if brute.quality_row(d, t)[7]]
    first = {d for d, _, c in brute.simhash_rows(kept) if d == c}
    docs, ids = small_docs, None
    for name, stage in P.STAGES[:3]:
        docs = P.SharedTables(spark, "test").put(stage(spark, docs, SF_SMALL), name)
        assert docs.columns == small_docs.columns
        ids = {r[0] for r in pairs(docs, "doc_id")}
        assert ids == ({d for d, _ in kept} if name == "quality_rules" else first)
    clean, before = dict(pairs(docs, "doc_id", "text")), dict(rows)
    assert all((clean[d] == before[d]) == (not brute.base_spans(before[d])) for d in ids)
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = {d: tokenizer.encode(t, add_special_tokens=False).ids + [2] for d, t in clean.items()}
    got: dict[int, list] = {}
    for r in P.run(spark, SF_SMALL).collect():
        tokens, at = np.frombuffer(r.ids, "<u4"), 0
        assert len(tokens) == r.n_tokens <= 4096
        for d, start, n in zip(r.doc_ids, r.starts, r.lengths):
            got.setdefault(d, []).append((start, tokens[at : at + n].tolist()))
            at += n
    assert {d: [x for _, part in sorted(parts) for x in part] for d, parts in got.items()} == want


def unequal_files(spark, df, tmp_path, cuts):
    """``df`` written in its order as files that end at ``cuts``, and reread."""
    rows = df.collect()
    parts = [[tuple(r) for r in rows[a:b]] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
    dealt = spark.sparkContext.parallelize(parts, len(parts)).flatMap(list)
    spark.createDataFrame(dealt, df.schema).write.parquet(str(tmp_path / "mixed"))
    return spark.read.parquet(str(tmp_path / "mixed"))


def test_sequences_follow_the_mix_over_many_files(spark, small_docs, tmp_path):
    place = pairs(pfair.mix(small_docs, SOURCE_SHARES, other_weight=1, block=16), "slot", "position", "doc_id", "class")
    docs = unequal_files(spark, P.source_mix(spark, small_docs, SF_SMALL), tmp_path, [3, 40, 45, 120, 125])
    assert len({r[0] for r in docs.select("_metadata.file_path").collect()}) == 6
    packed = sorted(P.packed(spark, docs, SF_SMALL).collect(), key=lambda r: r.sequence_id)
    assert [r.sequence_id for r in packed] == list(range(len(packed)))
    assert all(r.n_tokens == 4096 for r in packed[:-1])
    got = list(dict.fromkeys(d for r in packed for d in r.doc_ids))
    assert got == [d for _, _, d, _ in sorted(place)]


def test_long_documents_and_odd_texts_in_order(spark, odd_docs, tmp_path):
    from tokenizers import Tokenizer

    docs = unequal_files(spark, odd_docs, tmp_path, [1, 2, 9, 30])
    tokenizer = Tokenizer.from_file(tokenizer_path())
    written = docs.orderBy("_metadata.file_path", "_metadata.row_index")
    rows = [i for t in pairs(written, "text") for i in tokenizer.encode(t[0] or "", add_special_tokens=False).ids + [2]]
    got = sorted(pack_in_order(docs, tokenizer_path(), window=7).collect(), key=lambda r: (r.sequence_id, r.offset))
    assert np.frombuffer(b"".join(r.ids for r in got), "<u4").tolist() == rows
    assert all(len(r.ids) == 4 * r.length and r.start + r.length <= r.doc_tokens for r in got)
    assert pack_in_order(docs.limit(0), tokenizer_path()).count() == 0


def best_fit(sizes, window, most):
    """Windows of (document, start, length), by trying every open window:
    heads go to the current one, rests where they fill best."""
    done, opened, current = [], [], None

    def left(pieces):
        return window - sum(n for _, _, n in pieces)

    def place(pieces, d, at, end):
        n = min(end - at, left(pieces))
        pieces.append((d, at, n))
        if not left(pieces):
            done.append(pieces)
            return at + n, None
        return at + n, pieces

    def choose(n):
        fits = [p for p in opened if left(p) >= n]
        if not fits and len(opened) < most:
            return []
        best = min(fits or opened, key=left)
        opened.remove(best)
        return best

    for d, size in enumerate(sizes):
        at, current = place(choose(size) if current is None else current, d, 0, size)
        while size - at >= window:
            done.append([(d, at, window)])
            at += window
        while at < size:
            at, pieces = place(choose(size - at), d, at, size)
            if pieces:
                opened.append(pieces)
    last = []
    for d, at, n in [p for pieces in [current or [], *sorted(opened, key=left)] for p in pieces]:
        end = at + n
        while at < end:
            at, pieces = place(last, d, at, end)
            last = pieces or []
    return done + ([last] if last else [])


@pytest.mark.parametrize("most", [1, 2, 5])
def test_rests_of_documents_go_where_they_fit_best(spark, tmp_path, most):
    texts = ["a " * (n * 7 % 23) + "b" for n in range(40)] + ["c " * 75, "d", "e " * 8, "f"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs = unequal_files(spark, docs, tmp_path, [3, 4, 30])
    got = pack_in_order(docs, tokenizer_path(), window=10, open_windows=most, stretch=1000).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        found.setdefault(r.sequence_id, []).append((r.doc_id, r.start, r.length))
    want = best_fit([len(t.split()) + 1 for t in texts], 10, most)
    assert sorted(found) == list(range(len(want)))
    # A tie between windows may go either way; how full they are does not depend on it.
    assert [sum(n for _, _, n in found[k]) for k in sorted(found)] == [sum(n for _, _, n in w) for w in want]
    assert len(got) == sum(map(len, want))
    assert list(dict.fromkeys(d for k in sorted(found) for d, _, _ in found[k])) == list(range(len(texts)))


def test_pipeline_packs_rests_into_open_windows(spark, small_docs, tmp_path):
    docs = unequal_files(spark, P.source_mix(spark, small_docs, SF_SMALL), tmp_path, [3, 40])
    packed = sorted(P.packed(spark, docs, SF_SMALL).collect(), key=lambda r: r.sequence_id)
    assert all(r.n_tokens == 4096 for r in packed[:-1])
    # Cut in a row, each document goes on in the next sequence.
    on = [(a.doc_ids[-1], b.doc_ids[0]) for a, b in zip(packed, packed[1:]) if a.starts[-1] + a.lengths[-1] > 0 and b.starts[0] > 0]
    assert any(a != b for a, b in on)


def test_stretches_are_packed_one_by_one(spark, small_docs, tmp_path):
    docs = unequal_files(spark, small_docs.limit(60), tmp_path, [7, 31])
    order = [r[0] for r in docs.orderBy("_metadata.file_path", "_metadata.row_index").select("doc_id").collect()]
    got = pack_in_order(docs, tokenizer_path(), window=64, open_windows=4, stretch=3).collect()
    rows = sorted(got, key=lambda r: (r.sequence_id, r.offset))
    fill = np.bincount([r.sequence_id for r in rows], [r.length for r in rows])
    assert (fill[:-1] == 64).all() and 0 < fill[-1] <= 64
    assert list(dict.fromkeys(r.doc_id for r in rows)) == order
    for d in order:
        parts = sorted((r.start, r.length, r.doc_tokens) for r in rows if r.doc_id == d)
        assert [p[0] for p in parts] == np.cumsum([0, *(p[1] for p in parts)])[:-1].tolist()
        assert sum(p[1] for p in parts) == parts[0][2]
