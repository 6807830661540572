import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from regstar.llm import minimax_shards as M
from regstar.llm import packing, pfair
from regstar.llm.queries import QUERIES, SOURCE_SHARES, tokenizer_path
from tests.conftest import SF_SMALL
from tests.llm.conftest import pairs

# ------------------------------------------------------------------- mixing

SHARES = st.dictionaries(st.sampled_from("abcdefgh"), st.integers(1, 9), min_size=1)


@given(SHARES)
def test_period_is_less_than_one_block_off(shares):
    slots, q = pfair.period(shares), sum(shares.values())
    seen = Counter()
    for t, name in enumerate(slots, 1):
        seen[name] += 1
        assert all(abs(seen[k] - t * w / q) < 1 for k, w in shares.items())
    assert seen == shares


@given(st.dictionaries(st.sampled_from("abcdefgh"), st.integers(0, 60), min_size=1), SHARES)
def test_phases_place_every_block_once(blocks, shares):
    runs = pfair.phases(blocks, shares)
    at, placed = 0, defaultdict(list)
    for run in runs:
        assert run["first_slot"] == at
        n, seen = sum(b - a for a, b in run["classes"].values()), Counter()
        for t in range(n):
            name = run["slots"][t % len(run["slots"])]
            placed[name].append(run["classes"][name][0] + seen[name])
            seen[name] += 1
        assert seen == {k: b - a for k, (a, b) in run["classes"].items() if b > a}
        at += n
    assert {k: v for k, v in placed.items()} == {k: list(range(n)) for k, n in blocks.items() if n}


@pytest.mark.parametrize("which", ["odd_docs", "small_docs", "no_docs"])
def test_mix_places_every_row(request, which):
    docs = request.getfixturevalue(which)
    shares = {"src1": 3, "src2": 2, "src0": 0}
    got = pairs(pfair.mix(docs, shares, other_weight=1, block=4, rows_per_bucket=3), "doc_id", "class", "block", "slot", "position")
    cls = lambda s: s if s in shares else "other"
    assert Counter((g[0], g[1]) for g in got) == Counter((d, cls(s)) for d, s in pairs(docs, "doc_id", "source"))
    counts = Counter(g[1] for g in got)
    for name, n in counts.items():
        mine = sorted((g[2], g[4]) for g in got if g[1] == name)
        assert mine == [(i // 4, i % 4) for i in range(n)]
    # Slots follow the schedule; no two blocks share one.
    by_slot = {g[3]: (g[1], g[2]) for g in got}
    assert sorted(by_slot) == list(range(len(by_slot))) and len(set(by_slot.values())) == len(by_slot)
    want, at = {}, 0
    for run in pfair.phases({k: -(-n // 4) for k, n in counts.items()}, shares | {"other": 1}):
        seen = Counter()
        for t in range(sum(b - a for a, b in run["classes"].values())):
            name = run["slots"][t % len(run["slots"])]
            want[at] = (name, run["classes"][name][0] + seen[name])
            seen[name] += 1
            at += 1
    assert by_slot == want


def test_mixed_reads_in_order(odd_docs):
    got = pfair.mixed(odd_docs, {"src1": 3}, block=2)
    assert got.columns == odd_docs.columns
    place = {r[0]: (r[1], r[2]) for r in pairs(pfair.mix(odd_docs, {"src1": 3}, block=2), "doc_id", "slot", "position")}
    order = [place[r[0]] for r in pairs(got, "doc_id") if r[0] is not None and r[0] != 20]
    assert order == sorted(order) and got.count() == odd_docs.count()


def test_mixing_query(spark, small_docs):
    got = QUERIES["op7_mixing"](spark, SF_SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in pairs(small_docs, "doc_id"))
    blocks = sorted({(r.slot, r["class"]) for r in got})
    first_out = min(max(s for s, c in blocks if c == k) for k in {c for _, c in blocks})
    seen, shares = Counter(), SOURCE_SHARES | {"other": 1}
    live = {k: w for k, w in shares.items() if k in {c for _, c in blocks}}
    for s, c in blocks[: first_out + 1]:
        seen[c] += 1
        assert all(abs(seen[k] - (s + 1) * w / sum(live.values())) < 1 for k, w in live.items())


# ----------------------------------------------------------------- sharding


def smallest(sizes: list[int], shards: int) -> int:
    """Smallest largest sum of ``shards`` contiguous parts, by trying."""
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle, parts, held = (low + high) // 2, 1, 0
        for x in sizes:
            if held + x > middle:
                parts, held = parts + 1, 0
            held += x
        low, high = (low, middle) if parts <= shards else (middle + 1, high)
    return low


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2**63 - 1), st.integers(1, 1000)), min_size=1, max_size=300), st.integers(1, 16), st.booleans())
def test_smallest_capacity_is_found_from_sums_of_ranges(groups, shards, close):
    table = {(k >> 45 if close else k): b for k, b in groups}
    keys = sorted(table)

    def sums(_, widths):
        found = {}
        for width, inside in widths.items():
            new = M.KEY_BITS - M.FIRST_BITS if width == M.KEY_BITS else max(0, width - M.MORE_BITS)
            for k in keys:
                if width == M.KEY_BITS or k >> width in inside:
                    b, n = found.get((k >> new, new), (0, 0))
                    found[k >> new, new] = (b + table[k], n + 1)
        return [(k << w, w, b, n) for (k, w), (b, n) in found.items()]

    real, M._sums = M._sums, sums
    try:
        cuts, capacity = M.cut_keys(None, shards)
    finally:
        M._sums = real
    assert capacity == smallest([table[k] for k in keys], shards)
    load = Counter()
    for k in keys:
        load[sum(k >= c for c in cuts)] += table[k]
    assert max(load.values()) == capacity or max(load.values()) <= capacity
    assert len(cuts) < shards or shards == 1


@pytest.mark.parametrize("which", ["odd_docs", "small_docs", "no_docs"])
def test_shards_against_python(request, which):
    docs = request.getfixturevalue(which)
    got = pairs(M.shard_documents(docs, shards=8, rows_per_bucket=5), "doc_id", "size", "text_crc32", "shard", "slot")
    rows = pairs(docs, "doc_id", "text")
    body = lambda t: (t or "").encode()
    assert sorted((g[:3] for g in got), key=repr) == sorted(((d, len(body(t)) + 1, zlib.crc32(body(t))) for d, t in rows), key=repr)
    slots = defaultdict(list)
    for g in got:
        slots[g[3]].append(g[4])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    shard_of = {}
    for g in got:
        assert shard_of.setdefault(g[2], g[3]) == g[3]
    if rows:
        keyed = docs.select(F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit(""))), 1).alias("k"), F.coalesce("text", F.lit("")).alias("t"))
        sizes = Counter()
        for k, t in pairs(keyed, "k", "t"):
            sizes[k] += len(t.encode()) + 1
        load = Counter()
        for g in got:
            load[g[3]] += g[1]
        assert max(load.values()) <= smallest([sizes[k] for k in sorted(sizes)], 8)


def test_sharding_query(spark, small_docs):
    rows = QUERIES["op9_sharding"](spark, SF_SMALL).collect()
    assert len(rows) == small_docs.count() and {r.shard for r in rows} == set(range(16))
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}


# ------------------------------------------------------------------ packing


def ids_of(texts: list) -> list[list[int]]:
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    return [e.ids + [2] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@pytest.mark.parametrize(("window", "open_windows", "fan_in"), [(4096, 16, 16), (64, 2, 2), (1, 1, 2)])
def test_every_id_is_packed_once(odd_docs, window, open_windows, fan_in):
    docs = odd_docs.where("doc_id IS NULL OR doc_id NOT IN (20, 28) AND doc_id < 60").repartition(5)
    if window == 1:
        docs = docs.where("doc_id > 10 AND doc_id < 25")
    got = packing.pack_documents(
        docs, tokenizer_path(), window=window, open_windows=open_windows, fan_in=fan_in, keep_ids=True
    ).collect()
    rows = pairs(docs, "doc_id", "text")
    want = Counter((d, tuple(ids)) for (d, _), ids in zip(rows, ids_of([t for _, t in rows])))
    pieces, inside = defaultdict(list), defaultdict(list)
    for r in got:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length > 0
        pieces[r.doc_id].append(r)
        inside[r.sequence_id].append(r)
    for d, parts in pieces.items():
        if d is not None:
            parts.sort(key=lambda r: r.start)
            ids = np.frombuffer(b"".join(r.ids for r in parts), "<u4").tolist()
            assert [r.start for r in parts] == np.cumsum([0, *(r.length for r in parts)])[:-1].tolist()
            assert want.pop((d, tuple(ids))) == 1 and {r.doc_tokens for r in parts} == {len(ids)}
    assert {k[0] for k in want} <= {None}
    sizes = []
    for parts in inside.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == np.cumsum([0, *(r.length for r in parts)])[:-1].tolist()
        sizes.append(sum(r.length for r in parts))
    assert max(sizes) <= window and sum(s < window for s in sizes) <= 1


def test_packing_query_and_sequences(spark, small_docs, no_docs):
    rows = QUERIES["op10_packing"](spark, SF_SMALL).collect()
    texts = dict(pairs(small_docs, "doc_id", "text"))
    ids = dict(zip(texts, ids_of(list(texts.values()))))
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    for r in rows:
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()
        assert zlib.crc32(part) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
    whole = packing.sequences(packing.pack_documents(small_docs, tokenizer_path(), keep_ids=True)).collect()
    assert sum(r.n_tokens for r in whole) == sum(r.length for r in rows)
    for r in whole:
        assert len(r.ids) == 4 * r.n_tokens
        parts = [np.array(ids[d][s : s + n], "<u4").tobytes() for d, s, n in zip(r.doc_ids, r.starts, r.lengths)]
        assert b"".join(parts) == r.ids
    assert packing.pack_documents(no_docs, tokenizer_path()).count() == 0


def test_words_are_tokenized_as_whole_texts():
    words = packing.WordIds(tokenizer_path())
    texts = ["It's 3.5 o'clock, don't—ÉTÉ x　y \x1cz", "<|endoftext|> <|x|>a", "é ́ ﬁ Ⅷ İ ς Σ", "a\x85b c", "日本語 text"]
    for text, ids in zip(texts, ids_of(texts)):
        assert np.frombuffer(words.text(text), "<u4").tolist() == ids[:-1]
    words.KEEP = 2
    assert np.frombuffer(words.text("a b c d a b"), "<u4").tolist() == ids_of(["a b c d a b"])[0][:-1]
