"""Substring dedup: words covered by a passage of an earlier document go.

A window is ``k`` consecutive words of one document. Of every window the
smallest hash of its ``m``-word runs is the minimiser; consecutive windows with
one minimiser form a super-k-mer, whose words travel as one packed string (so a
window costs about 3 words, not ``k``) to the bucket of the minimiser. Equal
windows have equal minimisers, so they meet in one bucket. There the windows
are sorted (by hash; neighbours with one hash are compared word by word) and
each distinct window gets its smallest doc_id. Windows that also start in a
document with a smaller doc_id are sent back as runs of window starts, and
their words are removed from the texts.

Hot groups: a map task sorts the windows of ``CHUNK`` words at a time in the
same way first. A window that a smaller doc_id of the chunk holds is settled
there and does not travel, so a group of copies, or a passage that a third of
all documents share, sends one row for each chunk, not for each document. Then
the windows that would travel are counted by bucket, over all documents; in a
bucket with over ``CROWDED`` of them each window travels alone, to the bucket
of its own hash, where equal windows are read as a sorted stream. So no task
holds more than a bounded number of windows. The list of crowded buckets, which
every task gets, has at most one number for each ``CROWDED`` windows.

Defined cases: a null text has no words; a text of fewer than ``k`` words has no
window; a row without a doc_id neither loses words nor makes others lose any;
rows with one doc_id are not earlier than each other, whatever their texts;
repeated rows give repeated result rows; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regstar.llm.shared import SharedTables, columns, for_workers

CHUNK = 2_000_000  # words that a map task sorts at once
BUCKET = 40_000  # windows of a bucket, on average
CROWDED = 1_000_000  # windows of a bucket that are sorted in memory, at most
GROUP = 300_000  # windows that a reduce task sorts at once, of whole buckets
LONGEST = 4096  # windows of a super-k-mer

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # masks of the lowest n bytes

#: What travels: ``key`` is null in a packed super-k-mer blob of ``bucket``, and
#: the window's hash where it travels alone; blobs of settled runs have bucket -1 - n.
TRAVEL = "bucket long, key long, first_doc long, body binary"
RUNS = "doc_id long, salt long, start long, n long, words_hash long"
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixer (xor-shift, multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _rolled(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``size`` neighbours from each position on (cut at the end)."""
    out = np.zeros(max(len(h) - size + 1, 0), np.uint64)
    for j in range(size):
        out = out * _PRIME + h[j : j + len(out)]
    return _mix(out)


def _sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    width = 1
    while 2 * width <= size:
        x = np.minimum(x[: len(x) - width], x[width:])
        width *= 2
    rest = size - width
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def _words(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begins, ends, hashes) of the words of ``raw``, which are divided by one
    blank or line end each."""
    text = np.frombuffer(raw, np.uint8)
    ends = np.append(np.flatnonzero((text == 32) | (text == 10)), len(text))
    begins = np.append(0, ends[:-1] + 1)
    # The eight bytes from any position on, as one number.
    eight = np.ndarray(len(raw) + 1, "<u8", raw + bytes(8), strides=(1,))
    left = ends - begins
    h = _mix((eight[begins] & _LOW[np.minimum(left, 8)]) + left.astype(np.uint64) * _PRIME)
    longer, at = np.flatnonzero(left > 8), 8
    while len(longer):
        part = eight[begins[longer] + at] & _LOW[np.minimum(left[longer] - at, 8)]
        h[longer] = _mix(h[longer] * _PRIME + part)
        at += 8
        longer = longer[left[longer] > at]
    return begins, ends, h


def _differ(text: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> bool:
    """Whether any two passages of one size, from ``a`` and ``b`` on, differ."""
    ends = np.cumsum(size)
    first = 0
    while first < len(size):  # some million bytes at a time
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + (1 << 21), "right")))
        n = size[first:last]
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        if (text[np.repeat(a[first:last], n) + nth] != text[np.repeat(b[first:last], n) + nth]).any():
            return True
        first = last
    return False


def _groups(hashes: np.ndarray, text: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, firsts): the windows sorted so that equal ones are neighbours,
    and where each group of equal ones begins. Sorted by hash; neighbours with
    one hash are compared byte by byte, and if two of them differ, all windows
    are sorted by their bytes instead."""
    order = np.argsort(hashes)
    h = hashes[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    same = np.flatnonzero(~new)
    one, two = order[same - 1], order[same]
    size = ends[one] - begins[one]
    if (size != ends[two] - begins[two]).any() or _differ(text, begins[one], begins[two], size):
        seen: dict[bytes, int] = {}
        raw = text.tobytes()
        label = np.array([seen.setdefault(raw[a:b], len(seen)) for a, b in zip(begins.tolist(), ends.tolist())])
        order = np.argsort(label)
        new[1:] = np.diff(label[order]) != 0
    return order, np.flatnonzero(new)


def _later(hashes, text, begins, ends, docs) -> np.ndarray:
    """Whether each window also starts in one with a smaller number in ``docs``."""
    if not len(hashes):
        return np.zeros(0, bool)
    order, first = _groups(hashes, text, begins, ends)
    sizes = np.diff(np.append(first, len(order)))
    least = np.repeat(np.minimum.reduceat(docs[order], first), sizes)
    out = np.empty(len(order), bool)
    out[order] = docs[order] > least
    return out


def _runs(chosen: np.ndarray, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begins, ends) of runs of neighbouring chosen positions that agree in ``same``."""
    at = np.flatnonzero(chosen)
    if not len(at):
        return at, at
    cut = np.diff(at) != 1
    for x in same:
        cut |= x[at[1:]] != x[at[:-1]]
    first = np.append(0, np.flatnonzero(cut) + 1)
    return at[first], at[np.append(first[1:] - 1, len(at) - 1)] + 1


class Chunk:
    """Documents whose windows a map task sorts at once."""

    def __init__(self, k: int, m: int):
        self.k, self.m = k, m
        self.docs: list[tuple[int, int]] = []  # (doc_id, salt)
        self.texts: list[bytes] = []  # words joined by one space
        self.sizes: list[int] = []
        self.size = 0

    def add(self, doc_id: int, salt: int, words: list[bytes]) -> None:
        self.docs.append((doc_id, salt))
        self.texts.append(b" ".join(words))
        self.sizes.append(len(words))
        self.size += len(words)

    def sort(self) -> None:
        """Settle the chunk's own repeats; ``travels`` marks the other windows."""
        k = self.k
        sizes = np.array(self.sizes)
        self.row = np.repeat(np.arange(len(sizes)), sizes)
        self.first_word = np.cumsum(sizes) - sizes
        self.ids, self.salts = np.array(self.docs, np.int64).T
        self.text = b"\n".join(self.texts)
        self.texts = []
        text = np.frombuffer(self.text, np.uint8)
        self.begins, self.ends, h = _words(self.text)
        n = len(h) - k + 1
        inside = self.row[:n] == self.row[k - 1 :]
        self.hashes = _rolled(h, k)
        self.minimiser = _mix(_sliding_min(_rolled(h, self.m), k - self.m + 1))
        at = np.flatnonzero(inside)
        later = _later(self.hashes[at], text, self.begins[at], self.ends[at + k - 1], self.ids[self.row[at]])
        self.settled = np.zeros(n, bool)
        self.settled[at[later]] = True
        self.travels = inside & ~self.settled

    def passage(self, first: int, windows: int) -> bytes:
        """The words under ``windows`` windows from ``first`` on."""
        return self.text[self.begins[first] : self.ends[first + windows + self.k - 2]]

    def place(self, first: int) -> tuple[int, int, int]:
        """(doc_id, salt, word number in the document) of a window."""
        row = self.row[first]
        return (*self.docs[row], int(first - self.first_word[row]))

    def bucket_counts(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(self.minimiser[self.travels] % np.uint64(buckets), return_counts=True)

    def blobs(self, buckets: int, crowded: np.ndarray) -> Iterator[tuple]:
        """``TRAVEL`` rows: super-k-mers by bucket, then windows of crowded buckets."""
        bucket = (self.minimiser % np.uint64(buckets)).astype(np.int64)
        alone = np.isin(bucket, crowded) if len(crowded) else np.zeros(len(bucket), bool)
        begins, ends = _runs(self.travels & ~alone, self.minimiser, self.row[: len(bucket)])
        if (ends - begins > LONGEST).any():
            begins, ends = _cut(begins, ends, LONGEST)
        order = np.argsort(bucket[begins], kind="stable")
        begins, ends = begins[order], ends[order]
        of = bucket[begins]
        first = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else np.zeros(0, np.int64)
        rows = self.row[begins]
        head = np.stack((self.ids[rows], self.salts[rows], begins - self.first_word[rows], ends - begins))
        cuts = list(zip(self.begins[begins].tolist(), self.ends[ends + self.k - 2].tolist()))
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(of)]):
            yield int(of[a]), None, None, _pack(head[:, a:b], [self.text[x:y] for x, y in cuts[a:b]])
        for w in np.flatnonzero(self.travels & alone).tolist():
            body = _pack(np.array([[*self.place(w), 1]], np.int64).T, [self.passage(w, 1)])
            own = int(self.hashes[w : w + 1].view(np.int64)[0])
            yield buckets + own % buckets, own, self.docs[self.row[w]][0], body

    def settled_runs(self) -> list[tuple]:
        begins, ends = _runs(self.settled, self.row[: len(self.settled)])
        return [
            (*self.place(a), b - a, _hash(self.passage(a, b - a))) for a, b in zip(begins.tolist(), ends.tolist())
        ]


def _cut(begins: np.ndarray, ends: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    parts = -(-(ends - begins) // most)
    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    new = np.repeat(begins, parts) + nth * most
    return new, np.minimum(new + most, np.repeat(ends, parts))


def _hash(passage: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(passage) - (1 << 63)


def _pack(head: np.ndarray, passages: list[bytes]) -> bytes:
    """One compressed blob: doc_ids (as differences), salts, starts, numbers of
    windows, and the passages, one on a line."""
    import zstandard

    head = head.astype("<i8")
    head[0, 1:] -= head[0, :-1].copy()
    # Bytes of one significance lie together, so high zero bytes cost nothing.
    planes = head.view(np.uint8).reshape(4, -1, 8).transpose(0, 2, 1).tobytes()
    return zstandard.compress(head.shape[1].to_bytes(4, "little") + planes + b"\n".join(passages), 3)


def _unpack(body: bytes) -> tuple[np.ndarray, np.ndarray, bytes]:
    import zstandard

    raw = zstandard.decompress(body)
    n = int.from_bytes(raw[:4], "little")
    planes = np.frombuffer(raw, np.uint8, 32 * n, 4).reshape(4, 8, n)
    head = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<i8").reshape(4, n).astype(np.int64)
    head[0] = np.cumsum(head[0])
    return head[:3], head[3], raw[4 + 32 * n :]


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kinds[kind]) for i, (_, kind) in enumerate(fields)], names=[f[0] for f in fields]
    )


def _chunks(batches: Iterator[pa.RecordBatch], k: int, m: int, chunk: int) -> Iterator[Chunk]:
    """Sorted chunks of (doc_id, salt, text) rows that have a window."""
    part = Chunk(k, m)
    for batch in batches:
        for doc_id, salt, text in zip(*(batch.column(i) for i in range(3))):
            words = (text.as_py() or "").encode().split()  # bytes: ASCII white space only
            doc_id = doc_id.as_py()
            if doc_id is None or len(words) < k:
                continue
            part.add(doc_id, salt.as_py(), words)
            if part.size >= chunk:
                part.sort()
                yield part
                part = Chunk(k, m)
    if part.size:
        part.sort()
        yield part


class Buckets:
    """Sorts the windows of whole buckets; gives ``RUNS`` rows."""

    def __init__(self, k: int):
        self.k = k
        self.clear()

    def clear(self) -> None:
        self.places, self.windows, self.texts, self.size = [], [], [], 0

    def add(self, body: bytes) -> None:
        places, windows, text = _unpack(body)
        self.places.append(places)
        self.windows.append(windows)
        self.texts.append(text)
        self.size += int(windows.sum())

    def settle(self) -> Iterator[tuple]:
        if not self.places:
            return
        k = self.k
        doc, salt, start = np.concatenate(self.places, axis=1)
        windows = np.concatenate(self.windows)
        raw = b"\n".join(self.texts)
        text = np.frombuffer(raw, np.uint8)
        begins, ends, h = _words(raw)
        sizes = windows + k - 1  # words of each super-k-mer
        first = np.cumsum(sizes) - sizes
        of = np.repeat(np.arange(len(windows)), windows)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
        at = first[of] + nth
        later = _later(_rolled(h, k)[at], text, begins[at], ends[at + k - 1], doc[of])
        for a, b in zip(*(x.tolist() for x in _runs(later, of))):
            i = of[a]
            passage = raw[begins[at[a]] : ends[at[b - 1] + k - 1]]
            yield int(doc[i]), int(salt[i]), int(start[i] + nth[a]), b - a, _hash(passage)


def removed_runs(rows: DataFrame, shared: SharedTables, k: int, m: int, chunk: int, bucket: int, crowded: int) -> DataFrame:
    """``RUNS``: starts of windows that a smaller doc_id also has, as runs."""
    text_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(64, text_bytes // 6 // bucket)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _chunks(batches, k, m, chunk):
            of, n = part.bucket_counts(buckets)
            yield pa.RecordBatch.from_arrays([pa.array(of.astype(np.int64)), pa.array(n)], names=["bucket", "n"])

    counted = rows.mapInArrow(counts, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    # At most one number for each `crowded` windows.
    hot = np.array([r[0] for r in counted.where(F.col("n") > crowded).collect()], np.int64)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nth, part in enumerate(_chunks(batches, k, m, chunk)):
            out, size = [], 0
            runs = part.settled_runs()
            for i in range(0, len(runs), 4096):
                head = np.array(runs[i : i + 4096], np.int64)
                out.append((-1 - (part.docs[0][0] + i + nth) % buckets, None, None, head.astype("<i8").tobytes()))
            for row in part.blobs(buckets, hot):
                out.append(row)
                size += len(row[3])
                if size >= 4 << 20:
                    yield _batch(out, TRAVEL)
                    out, size = [], 0
            yield _batch(out, TRAVEL)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, last, out = Buckets(k), None, []
        key, earliest = None, {}  # words of the windows that travel alone, with their smallest doc_id
        for batch in batches:
            for of, own, first_doc, body in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if of < 0:
                    out += map(tuple, np.frombuffer(body, "<i8").reshape(-1, 5).tolist())
                elif own is None:
                    if of != last and group.size >= GROUP:
                        out += group.settle()
                        group.clear()
                    group.add(body)
                    last = of
                else:
                    if own != key:
                        key, earliest = own, {}
                    places, _, passage = _unpack(body)
                    # Sorted by doc_id: the first row of a window has its smallest one.
                    if first_doc > earliest.setdefault(passage, first_doc):
                        out.append((*places[:, 0].tolist(), 1, _hash(passage)))
                if len(out) >= 8192:
                    yield _batch(out, RUNS)
                    out = []
        out += group.settle()
        yield _batch(out, RUNS)

    travelling = rows.mapInArrow(pack, TRAVEL)
    placed = travelling.repartition("bucket").sortWithinPartitions("bucket", "key", "first_doc")
    return shared.put(placed.mapInArrow(settle, RUNS).distinct(), "runs")


def _kept(text: str | None, runs: list, k: int) -> tuple[int, int, str]:
    """(n_words, n_removed, kept_sha256) of a text."""
    words = (text or "").encode().split()
    gone = np.zeros(len(words) + 1, np.int64)
    for r in runs or ():
        a, b = r["start"], r["start"] + r["n"] + k - 1
        # A row whose salt is another text's by chance has other words there.
        if b <= len(words) and _hash(b" ".join(words[a:b])) == r["words_hash"]:
            gone[a] += 1
            gone[b] -= 1
    stays = np.cumsum(gone[:-1]) == 0
    kept = b" ".join([w for w, s in zip(words, stays.tolist()) if s]) if runs else b" ".join(words)
    return len(words), int(len(words) - stays.sum()), hashlib.sha256(kept).hexdigest()


def dedup_substrings(
    docs: DataFrame, *, k: int = 13, m: int = 3, chunk: int = CHUNK, bucket: int = BUCKET, crowded: int = CROWDED
) -> DataFrame:
    """``RESULT`` for each row of ``docs`` (doc_id, text)."""
    spark = for_workers(docs.sparkSession)
    shared = SharedTables(spark, "super_kmers")
    # The salt tells rows with one doc_id and different texts apart.
    salt = F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).alias("salt")
    rows = columns(docs, "doc_id", "text").select("doc_id", salt, "text")
    runs = removed_runs(rows, shared, k, m, chunk, bucket, crowded)
    of_row = runs.groupBy("doc_id", "salt").agg(F.collect_list(F.struct("start", "n", "words_hash")).alias("runs"))
    joined = rows.join(of_row, ["doc_id", "salt"], "left").select("doc_id", "text", "runs")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                (d.as_py(), *_kept(t.as_py(), r.as_py(), k))
                for d, t, r in zip(batch.column(0), batch.column(1), batch.column(2))
            ]
            yield _batch(out, RESULT)

    return joined.mapInArrow(finish, RESULT)
