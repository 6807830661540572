"""Language-model scoring: interpolated modified Kneser-Ney, of any order.

Counting. Workers hash the words of training texts and count the pairs
(history, word) of some million tokens at a time; the counts go to shards by
the hash of the history's last word, as compact sorted arrays, so a shard has
all grams of every level that end in such a word and another one, and derives
the lower levels by itself. Last words that are frequent in a bounded sample
are far ones: their grams go by the whole history's hash (and those of frequent
histories by the pair's), and the level below is counted after another shuffle.
This balances the work and changes no count. Each shard merges its counts,
then writes its part of the model. The shards are built in ``PARTS`` rounds,
each reading the texts again and counting its own shards only, and a round's
shuffle files go when it ends: the disk holds the model and a part of the counts.

Model. Sorted arrays in raw files under the shared folder, for each shard and
level, near and far words apart: the sorted hashes of histories, and for each
its followers as sorted places in the file's list of words, with their counts.
Histories with one follower seen once are kept apart without numbers; others
have totals and numbers of followers seen once and twice. A file for each word
shard has sorted word hashes with token counts and numbers of different
histories. Workers map the files into memory and look up by binary search, a
sorted batch at a time, so only the pages that are needed are read
and no worker holds the model. The shared folder must therefore be mounted on
the workers (``file:`` or a plain path).

Probability. p(w|v) = max(c(vw) - D(c(vw)), 0) / c(v.) + g(v) p(w), with
p(w) = max(k(w) - D'(k(w)), 0) / K + g' / (V + 1); k(w) is the number of
different histories of w, K their sum, V the number of distinct training
tokens. At an order above 2, v is the history of
order - 1 tokens, its p(w) is that of the history without its first token, and
counts below the highest order are numbers of different longer histories; files
and blobs are kept by level. The discounts D(1), D(2), D(3 and more) come from the numbers of pairs
seen once to four times (modified Kneser-Ney); D' likewise from the k(w). An
unseen history backs off to p(w), an unseen word gets the last term.

Tokens: words between ASCII white space, A-Z lower-cased, and one end token
for each text; the first token's history is a begin mark.

Defined cases: a null text is an empty text (one token, its end); a null
doc_id is in the training part; repeated rows are counted and scored each; no
training text leaves every token unseen with probability 1; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regstar.llm.minhash import WordHashes, _mix
from regstar.llm.shared import SharedTables, columns, for_workers

BEGIN, END = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)  # fixed marks
CHUNK = 2_000_000  # tokens counted at a time
PARTS = 3  # rounds in which the shards are built, one after the other
U64 = np.dtype("<u8")
U32 = np.dtype("<u4")


# ------------------------------------------------------------------ tokens


class Tokens:
    """Word hashes of texts; words are looked up by their bytes."""

    def __init__(self):
        self.hashes = WordHashes()

    def of(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()
        out = np.empty(len(words) + 1, np.uint64)
        out[:-1] = list(map(self.hashes.__getitem__, words))
        out[-1] = END
        return out


def histories(tokens: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The token before each, or the begin mark at the start of a text;
    ``ends`` holds the texts' ends (exclusive)."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[0] = BEGIN
    before[ends[:-1]] = BEGIN
    return before


def preceding(tokens: np.ndarray, ends: np.ndarray, order: int) -> list[np.ndarray]:
    """The order - 1 tokens before each, the nearest first. Texts start with
    begin marks."""
    out = [histories(tokens, ends)]
    for _ in range(order - 2):
        out.append(histories(out[-1], ends))
    return out


def history_hash(before: list[np.ndarray]) -> np.ndarray:
    """The hash of a history, given its tokens, the nearest first."""
    h = before[0]
    for older in before[1:]:
        h = pair_hash(older, h)
    return h


def contexts(tokens: np.ndarray, ends: np.ndarray, order: int) -> list[np.ndarray]:
    """Each token's history at levels 2 to ``order``: the token before it, then
    a hash of the two, three, ... before it."""
    nearest, *older = preceding(tokens, ends, order)
    out = [nearest]
    for token in older:
        out.append(pair_hash(token, out[-1]))
    return out


def begin_contexts(order: int) -> list[np.uint64]:
    out = contexts(np.array([END]), np.array([1]), order)
    return [c[0] for c in out]


def pair_hash(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return _mix(v * np.uint64(0x9E3779B97F4A7C15) + w)


def _counted(key: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, starts, sums): a sorting order of ``key``, where its distinct
    values start in it, and their summed weights (or numbers)."""
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    starts = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1]))) if len(key) else np.zeros(0, np.int64)
    if weight is None:
        sums = np.diff(np.append(starts, len(key)))
    else:
        sums = np.add.reduceat(weight[order], starts) if len(key) else np.zeros(0, np.int64)
    return order, starts, sums


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays in a row, each with its length, compressed."""
    import zstandard

    raw = b"".join(np.int64(len(a)).tobytes() + np.ascontiguousarray(a).tobytes() for a in arrays)
    return zstandard.compress(raw, 1)


def _unpack(blob: bytes, *kinds: np.dtype) -> list[np.ndarray]:
    import zstandard

    raw, at, out = zstandard.decompress(blob), 0, []
    for kind in kinds:
        n = int(np.frombuffer(raw, np.int64, 1, at)[0])
        out.append(np.frombuffer(raw, kind, n, at + 8))
        at += 8 + n * kind.itemsize
    return out


def _coded(*columns: np.ndarray) -> list[np.ndarray]:
    """[distinct values, then each column as places in them]: words recur, so
    two bytes mostly do for eight."""
    known, which = np.unique(np.concatenate(columns), return_inverse=True)
    which = which.astype(np.uint16 if len(known) <= 1 << 16 else U32)
    return [known, *np.split(which, np.cumsum([len(c) for c in columns])[:-1])]


def _pack_grams(before: list[np.ndarray], followers: np.ndarray, w: np.ndarray, counts: np.ndarray) -> bytes:
    """Grams of one shard: of each history its tokens and number of followers;
    of each gram its last word and count."""
    known, *columns = _coded(*before, w)
    few = counts.max() < 256 and followers.max() < 256
    small = np.uint8 if few else U32
    sizes = bytes([columns[0].itemsize, np.dtype(small).itemsize])
    return sizes + _pack(known, *columns, followers.astype(small), counts.astype(small))


def _unpack_grams(blob: bytes, level: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(tokens before, nearest first; last words; counts), a row for each gram."""
    kinds = {1: np.dtype(np.uint8), 2: np.dtype(np.uint16), 4: U32}
    word, small = kinds[blob[0]], kinds[blob[1]]
    known, *columns, followers, counts = _unpack(blob[2:], U64, *[word] * level, small, small)
    *before, w = (known[c] for c in columns)
    return [np.repeat(x, followers) for x in before], w, counts.astype(np.int64)


# ------------------------------------------------------------------- files


def local_path(folder: str) -> str:
    """The mounted path of a shared folder."""
    url = urlparse(folder)
    if url.scheme not in ("", "file"):
        raise ValueError(f"{folder} is not mounted: the model's files are mapped into memory by the workers")
    return url.path


def _narrow(a: np.ndarray) -> np.ndarray:
    """In the smallest unsigned type that holds all its values."""
    most = int(a.max()) if len(a) else 0
    return np.ascontiguousarray(a, next(k for k in (np.uint8, np.uint16, U32, U64) if most <= np.iinfo(k).max))


def write_arrays(path: str, *arrays: np.ndarray) -> None:
    """A model file: the number of arrays, their lengths and the sizes of their
    items, then the arrays (of unsigned numbers), each from a multiple of 8 bytes on.
    It appears whole or not at all, also when a task is run twice."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    part = f"{path}.{uuid.uuid4().hex}"
    arrays = [_narrow(a) for a in arrays]
    with open(part, "wb") as f:
        np.array([len(arrays), *(len(a) for a in arrays), *(a.itemsize for a in arrays)], np.int64).tofile(f)
        for a in arrays:
            a.tofile(f)
            f.write(bytes(-a.nbytes % 8))
    os.replace(part, path)


def map_arrays(path: str) -> list[np.ndarray] | None:
    """The arrays of a model file, mapped into memory; None without a file."""
    if not os.path.exists(path):
        return None
    whole = np.memmap(path, np.uint8, "r")
    n = int(whole[:8].view(np.int64)[0])
    head = whole[8 : 8 + 16 * n].view(np.int64)
    at, out = 8 + 16 * n, []
    for length, size in zip(head[:n].tolist(), head[n:].tolist()):
        out.append(whole[at : at + length * size].view(f"<u{size}"))
        at += length * size + -length * size % 8
    return out


class Maps:
    """The model files opened last."""

    def __init__(self, folder: str, most: int = 128):
        self.folder, self.most, self.open = folder, most, OrderedDict()

    def get(self, name: str) -> list[np.ndarray] | None:
        if name not in self.open:
            if len(self.open) >= self.most:
                self.open.popitem(last=False)
            self.open[name] = map_arrays(f"{self.folder}/{name}")
        self.open.move_to_end(name)
        return self.open[name]


LARGE = 255  # stands for a number that is in a list of its own


class Numbers:
    """Small numbers in a byte each, the large ones in a list."""

    def __init__(self, small: np.ndarray, places: np.ndarray, large: np.ndarray):
        self.small, self.places, self.large = small, places, large

    @staticmethod
    def arrays(numbers: np.ndarray) -> list[np.ndarray]:
        places = np.flatnonzero(numbers >= LARGE)
        return [np.minimum(numbers, LARGE), places, numbers[places]]

    def at(self, i: np.ndarray) -> np.ndarray:
        out = self.small[i].astype(np.int64)
        large = np.flatnonzero(out == LARGE)
        out[large] = self.large[np.searchsorted(self.places, i[large])]
        return out


class Level:
    """The grams of one level in one shard, from the arrays of their file."""

    def __init__(self, known, lone, lone_low, lone_high, many, starts, low, high, *numbers):
        self.known, self.lone, self.many, self.starts = known, lone, many, starts
        self.lone_place, self.place = (lone_low, lone_high), (low, high)
        self.counts, *self.sums = [Numbers(*numbers[i : i + 3]) for i in range(0, len(numbers), 3)]

    @staticmethod
    def write(path: str, h: np.ndarray, w: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
        """Write distinct grams (history hash, last word, count); returns the
        histories (sorted), their totals and numbers of followers seen once, twice and more."""
        known, place = np.unique(w, return_inverse=True)
        order = np.lexsort((place, h))
        h, place, counts = h[order], place[order], counts[order]
        edges = _runs(h)
        starts, followers = edges[:-1], np.diff(edges)
        totals = np.add.reduceat(counts, starts)
        once, twice = (np.add.reduceat((counts == k).astype(np.int64), starts) for k in (1, 2))
        lone, h = (followers == 1) & (totals == 1), h[starts]
        kept = np.repeat(~lone, followers)
        split = lambda x: (x & 0xFFFF, x >> 16)
        numbers = [counts[kept], *(x[~lone] for x in (totals, once, twice))]
        write_arrays(
            path, known, h[lone], *split(place[starts[lone]]), h[~lone], np.append(0, np.cumsum(followers[~lone])),
            *split(place[kept]), *(a for x in numbers for a in Numbers.arrays(x)),
        )
        return h, totals, once, twice, followers - once - twice

    @staticmethod
    def _places(parts: tuple[np.ndarray, np.ndarray], i: np.ndarray) -> np.ndarray:
        low, high = parts
        return low[i].astype(np.int64) + (high[i].astype(np.int64) << 16)

    def find(self, h: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(count, total, numbers of followers seen once, twice and more) of each
        gram; zeros where the gram or its history is not here."""
        count, total, followers = np.zeros(len(h), np.int64), np.zeros(len(h), np.int64), np.zeros((3, len(h)), np.int64)
        place, known = _find(self.known, w)
        place = np.where(known, place, -1)
        i, found = _find(self.lone, h)
        at, i = np.flatnonzero(found), i[found]
        total[at] = followers[0, at] = 1
        count[at] = self._places(self.lone_place, i) == place[at]
        i, found = _find(self.many, h)
        at, i = np.flatnonzero(found), i[found]
        first, end = self.starts[i].astype(np.int64), self.starts[i + 1].astype(np.int64)
        total[at], followers[0, at], followers[1, at] = (x.at(i) for x in self.sums)
        followers[2, at] = end - first - followers[0, at] - followers[1, at]
        at, first, end = (x[place[at] >= 0] for x in (at, first, end))
        while len(at):  # a binary search in each history's followers
            middle = (first + end) // 2
            here, wanted = self._places(self.place, middle), place[at]
            equal = here == wanted
            count[at[equal]] = self.counts.at(middle[equal])
            first, end = np.where(here < wanted, middle + 1, first), np.where(here < wanted, end, middle)
            going = ~equal & (first < end)
            at, first, end = at[going], first[going], end[going]
        return count, total, followers


# ---------------------------------------------------------------- training


def _frequent(docs: DataFrame, sample_docs: int, share: float, order: int) -> dict[int, np.ndarray]:
    """By level, sorted hashes of the histories of at least ``share`` of the
    tokens of a bounded sample (at most 1 / share), and of the begin."""
    n = docs.count()
    some = docs.sample(min(1.0, 1.2 * sample_docs / n), seed=3).limit(sample_docs) if n > sample_docs else docs

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        for batch in batches:
            texts = [tokens.of(t.as_py()) for t in batch.column(0)]
            if not texts:
                continue
            every = contexts(np.concatenate(texts), np.cumsum([len(t) for t in texts]), order)
            for level, h in enumerate(every, 2):
                known, times = np.unique(h, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(known), level, np.int32)), pa.array(known.view(np.int64)), pa.array(times.astype(np.int64))],
                    names=["level", "h", "n"],
                )

    counts = some.mapInArrow(count, "level int, h long, n long").groupBy("level", "h").agg(F.sum("n").alias("n"))
    total = counts.where("level = 2").agg(F.sum("n").alias("total"))
    found = {k: {int(h)} for k, h in enumerate(begin_contexts(order), 2)}
    for r in counts.join(total, F.col("n") >= share * F.col("total")).collect():
        found[r["level"]].add(r["h"] % 2**64)
    return {k: np.sort(np.array(list(h), np.uint64)) for k, h in found.items()}


def _runs(ranked: np.ndarray) -> np.ndarray:
    """Where the values of a sorted array (or rows of sorted columns) begin, and its end."""
    columns = ranked if isinstance(ranked, list) else [ranked]
    n = len(columns[0])
    new = np.ones(n, bool)
    if n:
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.append(np.flatnonzero(new), n)


def _shards_of(before: list[np.ndarray], w: np.ndarray, shards: int, frequent: dict[int, np.ndarray]) -> np.ndarray:
    """The shard of each gram: by its nearest word before, or by its whole
    history where that word is far (frequent), or by all of it where the history
    is frequent too."""
    h = history_hash(before)
    far = _find(frequent[2], before[0])[1]
    key = np.where(far, _mix(h), _mix(before[0]))
    spread = np.flatnonzero(far)
    spread = spread[_find(frequent[len(before) + 1], h[spread])[1]]
    key[spread] = pair_hash(w[spread], h[spread])
    return (key % np.uint64(shards)).astype(np.int64)


def _blobs(before: list[np.ndarray], w: np.ndarray, counts: np.ndarray, shards: int, frequent: dict[int, np.ndarray]):
    """(shard, blob) of distinct grams: the tokens of their histories, the
    nearest first, their last words and counts. Only shards that occur."""
    shard = _shards_of(before, w, shards, frequent)
    order = np.lexsort((w, *before[::-1], shard))
    w, counts, shard, before = w[order], counts[order], shard[order], [x[order] for x in before]
    edges = _runs(shard)
    for a, b in zip(edges[:-1], edges[1:]):
        of = [x[a:b] for x in before]
        starts = _runs(of)
        yield int(shard[a]), _pack_grams([x[starts[:-1]] for x in of], np.diff(starts), w[a:b], counts[a:b])


def _count_grams(shards: int, frequent: dict[int, np.ndarray], order: int, part: int):
    """Worker function: texts to (shard, blob of counts of the longest grams),
    for the shards of one part."""

    def blobs(tokens: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, bytes]]:
        before = preceding(tokens, ends, order)
        own = _shards_of(before, tokens, shards, frequent) % PARTS == part
        tokens, before = tokens[own], [x[own] for x in before]
        by, starts, counts = _counted(pair_hash(history_hash(before), tokens))
        first = by[starts]
        yield from _blobs([x[first] for x in before], tokens[first], counts, shards, frequent)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, held, size = Tokens(), [], 0

        def out() -> pa.RecordBatch:
            ends = np.cumsum([len(t) for t in held])
            rows = list(blobs(np.concatenate(held), ends))
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
                names=["shard", "blob"],
            )

        for batch in batches:
            for text in batch.column(0):
                held.append(tokens.of(text.as_py()))
                size += len(held[-1])
                if size >= CHUNK:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    return count


def _shorter(before: list[np.ndarray], w: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Grams without their oldest token, distinct; counted are the longer ones."""
    before = before[:-1]
    by, starts, kinds = _counted(pair_hash(history_hash(before), w))
    first = by[starts]
    return [x[first] for x in before], w[first], kinds


def _merge_grams(folder: str, shards: int, frequent: dict[int, np.ndarray], level: int, order: int):
    """Worker function: the blobs of a shard of one level to its model files
    (of near words: those of all levels); returns blobs of word counts by word
    shard, blobs of the level below (a gram's count there is its number of longer
    histories), histories that are spread over shards, and for each level the
    numbers of grams counted 1, 2, 3, 4 times."""

    def merge(key, table: pa.Table) -> pa.Table:
        shard, rows = key[0].as_py(), []
        parts = [_unpack_grams(blob, level) for blob in table.column("blob").to_pylist()]
        before = [np.concatenate([p[0][i] for p in parts]) for i in range(level - 1)]
        w, c = np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
        del parts
        by, starts, counts = _counted(pair_hash(history_hash(before), w), c)
        first = by[starts]
        w, before = w[first], [x[first] for x in before]
        by, starts, tokens = _counted(w, counts)
        words, kinds = w[by][starts], np.zeros(len(starts), np.int64)
        tokens = tokens * (level == order)
        is_far = _find(frequent[2], before[0])[1]
        for side, own in (("near", ~is_far), ("far", is_far)):
            grams = [x[own] for x in before], w[own], counts[own]
            for k in range(level, 1, -1):
                of, last, n = grams
                if not len(last):
                    break
                known, totals, once, twice, more = Level.write(f"{folder}/{side}-{k}-{shard}", history_hash(of), last, n)
                rows.append(("seen", k, None, *(int((n == x).sum()) for x in (1, 2, 3, 4))))
                if k == 2:
                    kinds += np.bincount(np.searchsorted(words, last), minlength=len(words))
                if side == "far":
                    for i in np.flatnonzero(_find(frequent[k], known)[1]):
                        rows.append(("history", int(known[i].view(np.int64)), None, *(int(x[i]) for x in (totals, once, twice, more))))
                if k > 2:
                    grams = _shorter(of, last)
                    if side == "far":  # other shards have longer histories of the same grams
                        rows.extend(("grams", s, blob, 0, 0, 0, 0) for s, blob in _blobs(*grams, shards, frequent))
                        break
        if level in (2, order):
            to = _mix(words) % np.uint64(shards)
            by = np.argsort(to, kind="stable")
            edges = _runs(to[by])
            for start, end in zip(edges[:-1], edges[1:]):
                part = by[start:end]
                blob = _pack(words[part], tokens[part].astype(U64), kinds[part].astype(U32))
                rows.append(("words", int(to[part[0]]), blob, 0, 0, 0, 0))
        return _rows(rows)

    return merge


def _merge_words(folder: str):
    """Worker function: the blobs of a word shard to its model file; returns
    its numbers of words, tokens, pairs, and words with 1, 2, 3, 4 or more
    different histories."""

    def merge(key, table: pa.Table) -> pa.Table:
        parts = [_unpack(b, U64, U64, U32) for b in table.column("blob").to_pylist()]
        words, tokens, kinds = (np.concatenate([p[i] for p in parts]) for i in range(3))
        order, starts, tokens = _counted(words, tokens.astype(np.int64))
        kinds = np.add.reduceat(kinds[order].astype(np.int64), starts)
        words = words[order][starts]
        write_arrays(f"{folder}/words-{key[0].as_py()}", words, tokens, kinds)
        seen = [int((kinds == k).sum()) for k in (1, 2, 3, 4)]
        return _rows([("totals", len(words), None, int(tokens.sum()), int(kinds.sum()), 0, 0), ("kinds", 0, None, *seen)])

    return merge


ROWS = "what string, id long, blob binary, a long, b long, c long, d long"


def _rows(rows: list[tuple]) -> pa.Table:
    kinds = [pa.string(), pa.int64(), pa.binary(), *[pa.int64()] * 4]
    names = [c.split()[0] for c in ROWS.split(", ")]
    return pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """Discounts for counts 0, 1, 2, and 3 or more, from the numbers of
    items counted 1 to 4 times. Where a number is zero, a half for each."""
    if not (n1 and n2 and n3 and n4):
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    raw = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([min(max(d, 0.0), float(k)) for k, d in enumerate(raw)])


class Model:
    """What every worker knows of a trained model beside its files: numbers
    of fixed size, and the histories that are spread over the shards. By level:
    ``frequent``, ``seen``, and ``spread`` (history hashes, sorted; totals, once,
    twice, more)."""

    def __init__(self, folder, shards, order, frequent, seen, kinds, words, tokens, pairs, spread):
        self.folder, self.shards, self.order = folder, shards, order
        self.frequent, self.spread = frequent, spread
        self.pair_discounts = {k: discounts(*n) for k, n in seen.items()}
        self.word_discounts = discounts(*kinds)
        self.words, self.tokens, self.pairs = words, tokens, pairs
        many = max(0, words - kinds[0] - kinds[1])
        left = self.word_discounts[1] * kinds[0] + self.word_discounts[2] * kinds[1] + self.word_discounts[3] * many
        self.unseen = (left / pairs if pairs else 1.0) / (words + 1)


def train(docs: DataFrame, shared: SharedTables, *, order: int = 2, shard_bytes: int = 24 << 20) -> Model:
    """A model of all texts of ``docs`` (a column ``text``), with grams of up
    to ``order`` words (2 or more)."""
    for_workers(docs.sparkSession)
    folder = local_path(f"{shared.root}/model")
    texts = docs.select("text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(32, size // shard_bytes)
    frequent = _frequent(texts, 2000, 0.002, order)
    sums = [F.sum(c).alias(c) for c in "abcd"]

    def in_parts(name: str, of_part, merge) -> DataFrame:
        """Merge the blobs of a part of the shards at a time, by kind of row."""
        for part in range(PARTS):
            with shuffle_files_removed(docs.sparkSession):
                merged = of_part(part).groupBy("shard").applyInArrow(_plain(merge), ROWS)
                merged.write.partitionBy("what").mode("append").parquet(f"{shared.root}/{name}")
        return docs.sparkSession.read.schema(ROWS).parquet(f"{shared.root}/{name}")

    def counted(part: int) -> DataFrame:
        return texts.mapInArrow(_count_grams(shards, frequent, order, part), "shard int, blob binary")

    def written(rows: DataFrame, what: str):
        of = rows.where(F.col("what") == what).select(F.col("id").alias("shard"), "blob")
        return lambda part: of.where(F.col("shard") % PARTS == part)

    seen, spread, words = {k: [0, 0, 0, 0] for k in range(2, order + 1)}, {}, None
    blobs = counted
    for level in range(order, 1, -1):
        merged = in_parts(f"pairs{level}", blobs, _merge_grams(folder, shards, frequent, level, order))
        if level < order:
            shared.drop(f"pairs{level + 1}/what=grams")  # the level below has them: most of the bytes
        blobs = written(merged, "grams")
        words = merged if words is None else words.unionByName(merged)
        # A few sums, and at most 501 frequent histories.
        facts, rows = merged.where("what IN ('seen', 'history')").groupBy("what", "id").agg(*sums).collect(), []
        for r in facts:
            if r["what"] == "seen":
                seen[r["id"]] = [n + r[c] for n, c in zip(seen[r["id"]], "abcd")]
            else:
                rows.append((r["id"], *(r[c] for c in "abcd")))
        table = np.array(rows, np.int64).reshape(-1, 5)
        table = table[np.argsort(table[:, 0].view(np.uint64))]
        spread[level] = (table[:, 0].view(np.uint64), *table[:, 1:].T)
    word_rows = in_parts("words", written(words, "words"), _merge_words(folder))
    for level in range(order, 1, -1):
        shared.drop(f"pairs{level}")
    totals = {r["what"]: r for r in word_rows.groupBy("what").agg(F.sum("id").alias("id"), *sums).collect()}
    t, k = totals.get("totals"), totals.get("kinds")
    return Model(
        folder, shards, order, frequent, seen, [k[c] for c in "abcd"] if k else [0, 0, 0, 0],
        t["id"] if t else 0, t["a"] if t else 0, t["b"] if t else 0, spread,
    )


@contextmanager
def shuffle_files_removed(spark: SparkSession):
    """Shuffle files of the queries run inside go when their query ends, not
    when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _plain(function):
    """Without the annotations that Spark would read as another kind."""
    return lambda key, table: function(key, table)


# ----------------------------------------------------------------- scoring


def _find(sorted_keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, found) of each of ``wanted``."""
    at = np.searchsorted(sorted_keys, wanted)
    at[at == len(sorted_keys)] = 0
    return at, (sorted_keys[at] == wanted) if len(sorted_keys) else np.zeros(len(wanted), bool)


class Scorer:
    """Log-probabilities of tokens, looked up in the model's mapped files."""

    def __init__(self, model: Model):
        self.model, self.maps = model, Maps(model.folder)

    def _by_shard(self, shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """The shards that occur, each with its places."""
        order = np.argsort(shard, kind="stable")
        edges = _runs(shard[order])
        for a, b in zip(edges[:-1], edges[1:]):
            yield int(shard[order[a]]), order[a:b]

    def words(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(token count, continuation probability) of sorted word hashes."""
        m = self.model
        count, kinds = np.zeros(len(w), np.int64), np.zeros(len(w), np.int64)
        for s, at in self._by_shard(_mix(w) % np.uint64(m.shards)):
            if (arrays := self.maps.get(f"words-{s}")) is None:
                continue
            known, tokens, histories_ = arrays
            i, found = _find(known, w[at])
            count[at[found]], kinds[at[found]] = tokens[i[found]], histories_[i[found]]
        lower = np.maximum(kinds - m.word_discounts[np.minimum(kinds, 3)], 0)
        return count, lower / max(m.pairs, 1) + m.unseen

    def pairs(self, v: np.ndarray, w: np.ndarray, lower: np.ndarray, before: list[np.ndarray] | None = None) -> np.ndarray:
        """p(w|v) of distinct pairs of history and word, given the words'
        probabilities at the level below; ``before`` has the histories' tokens,
        the nearest first (left out: v is that token)."""
        m = self.model
        before = before or [v]
        level = len(before) + 1
        count, total = np.zeros(len(v), np.int64), np.zeros(len(v), np.int64)
        followers = np.zeros((3, len(v)), np.int64)
        far = _find(m.frequent[2], before[0])[1]
        for s, at in self._by_shard(2 * _shards_of(before, w, m.shards, m.frequent) + far):
            if (arrays := self.maps.get(f"{'far' if s % 2 else 'near'}-{level}-{s // 2}")) is not None:
                at = at[np.argsort(v[at])]
                count[at], total[at], followers[:, at] = Level(*arrays).find(v[at], w[at])
        often, totals, once, twice, more = m.spread[level]
        if len(often):
            at = np.flatnonzero(far)
            i, found = _find(often, v[at])
            at, i = at[found], i[found]
            total[at] = totals[i]
            followers[0, at], followers[1, at], followers[2, at] = once[i], twice[i], more[i]
        d = m.pair_discounts[level]
        seen = np.maximum(count - d[np.minimum(count, 3)], 0)
        left = d[1] * followers[0] + d[2] * followers[1] + d[3] * followers[2]
        safe = np.maximum(total, 1)
        return np.where(total > 0, seen / safe + left / safe * lower, lower)

    def texts(self, tokens: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(n_known, base_score, score) of texts that end at ``ends``."""
        m = self.model
        words, which = np.unique(tokens, return_inverse=True)
        count, lower = self.words(words)
        base = np.log10((count + 1) / (m.tokens + m.words + 1))
        p = lower[which]
        before = preceding(tokens, ends, m.order)
        for level, v in enumerate(contexts(tokens, ends, m.order), 2):
            order, starts, _ = _counted(pair_hash(v, tokens))
            first = order[starts]
            of_gram = self.pairs(v[first], tokens[first], p[first], [x[first] for x in before[: level - 1]])
            p = np.empty(len(tokens))
            p[order] = np.repeat(of_gram, np.diff(np.append(starts, len(order))))
        logs = np.log10(p)
        begins = np.concatenate(([0], ends[:-1]))
        return (
            np.add.reduceat((count > 0)[which].astype(np.int64), begins),
            np.add.reduceat(base[which], begins),
            np.add.reduceat(logs, begins),
        )


def score_documents(docs: DataFrame, held_out, *, order: int = 2, shard_bytes: int = 24 << 20) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    perplexity) for each row of ``docs`` (doc_id, text), by a model of the
    rows for whose doc_id ``held_out`` does not hold."""
    spark = for_workers(docs.sparkSession)
    shared = SharedTables(spark, "kneser_ney")
    rows = columns(docs, "doc_id", "text").withColumn("held_out", F.coalesce(held_out(F.col("doc_id")), F.lit(False)))
    trained = train(rows.where("NOT held_out").select(F.coalesce("text", F.lit("")).alias("text")), shared, order=order, shard_bytes=shard_bytes)
    model = spark.sparkContext.broadcast(trained)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, scorer, held, size = Tokens(), Scorer(model.value), [], 0

        def out() -> pa.RecordBatch:
            ends = np.cumsum([len(h[2]) for h in held])
            known, base, logs = scorer.texts(np.concatenate([h[2] for h in held]), ends)
            n = np.array([len(h[2]) for h in held])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([h[0] for h in held], pa.int64()), pa.array([h[1] for h in held], pa.bool_()),
                    pa.array(n, pa.int64()), pa.array(known, pa.int64()),
                    pa.array(np.full(len(held), model.value.tokens), pa.int64()),
                    pa.array(base, pa.float64()), pa.array(logs, pa.float64()), pa.array(10 ** (-logs / n), pa.float64()),
                ],
                names=[c.split()[0] for c in SCORED.split(", ")],
            )

        for batch in batches:
            for doc_id, text, out_of in zip(batch.column(0), batch.column(1), batch.column(2)):
                held.append((doc_id.as_py(), out_of.as_py(), tokens.of(text.as_py())))
                size += len(held[-1][2])
                if size >= CHUNK // 2:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    return rows.mapInArrow(score, SCORED)


SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double, perplexity double"
)
