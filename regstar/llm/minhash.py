"""Document fingerprints: one-permutation MinHash in b bits.

Every word shingle is hashed once; the hash's high bits name one of ``BINS``
bins, and each bin keeps its smallest hash. An empty bin takes the value of
another one by optimal densification: its own fixed sequence of bins is tried
until one is not empty. Of each bin the lowest ``B`` bits are stored, packed
two to a byte. Two fingerprints agree by chance in a share 2**-B of the bins,
so the likeness is (share of equal bins - 2**-B) / (1 - 2**-B), from 0 to 1.

A document's successor in descending doc_id is found without gathering
documents in one task: rows are dealt into ranges of doc_id (bounds from
quantiles), sorted there and read as a stream; the first row of each range is
also dealt to the range before it, as the successor of its last row. One
shuffle moves each text once.

Defined cases: a null text is an empty text; no words gives the empty
fingerprint, with likeness 1 to itself and 0 to any other; fewer words than a
shingle make one shingle; rows with one doc_id follow each other by text, and
rows without a doc_id come last; a table of one row is its own successor; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regstar.llm.shared import columns, for_workers

BINS, BIN_BITS, B = 256, 8, 4
FIRST = -(2**63)  # stands for a missing doc_id
RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixer (xor-shift, multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash by word, for as many words as a worker may hold."""

    KEEP = 400_000

    def __init__(self):
        import xxhash

        self.digest = xxhash.xxh64_intdigest

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.KEEP:
            self.clear()
        h = self[word] = self.digest(word)
        return h


class MinHasher:
    """Fingerprints of texts; ``bits`` gives the low bits of each bin, or None
    for a text without words."""

    def __init__(self, shingle: int = 5):
        self.shingle, self.hashes = shingle, WordHashes()
        self.starts = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - BIN_BITS)
        self.bins = np.arange(BINS, dtype=np.uint64)

    def bits(self, text: str) -> np.ndarray | None:
        words = text.encode().lower().split()
        if not words:
            return None
        w = np.array(list(map(self.hashes.__getitem__, words)), np.uint64)
        size = min(self.shingle, len(w))
        h = np.zeros(len(w) - size + 1, np.uint64)
        for k in range(size):  # order of the words counts
            h = h * np.uint64(0x9E3779B97F4A7C15) + w[k : k + len(h)]
        h = np.sort(_mix(h))
        at = np.searchsorted(h, self.starts)
        low = h[np.minimum(at, len(h) - 1)]
        full = (at < len(h)) & (low >> np.uint64(64 - BIN_BITS) == self.bins)
        return (self._densified(low, full) & np.uint64((1 << B) - 1)).astype(np.uint8)

    def _densified(self, low: np.ndarray, full: np.ndarray) -> np.ndarray:
        if full.all():
            return low
        if full.sum() == 1:
            return np.full(BINS, low[full][0])
        low, empty, attempt = low.copy(), np.flatnonzero(~full), 0
        while len(empty):
            attempt += 1
            tried = (_mix(self.bins[empty] + np.uint64(attempt * BINS)) & np.uint64(BINS - 1)).astype(np.int64)
            good = full[tried]
            low[empty[good]] = low[tried[good]]
            empty = empty[~good]
        return low

    @staticmethod
    def packed(bits: np.ndarray | None) -> str:
        return "" if bits is None else (bits[0::2] << B | bits[1::2]).astype(np.uint8).tobytes().hex()

    @staticmethod
    def likeness(a: np.ndarray | None, b: np.ndarray | None) -> float:
        if a is None or b is None:
            return float(a is b)
        by_chance = 2.0**-B
        return max(0.0, (float((a == b).mean()) - by_chance) / (1 - by_chance))


def unpacked(fingerprint: str) -> np.ndarray | None:
    """The bins' bits of a stored fingerprint."""
    if not fingerprint:
        return None
    raw = np.frombuffer(bytes.fromhex(fingerprint), np.uint8)
    return np.stack((raw >> B, raw & ((1 << B) - 1)), 1).ravel()


def edited(text: str, after: str) -> str:
    """``text`` with its second half replaced by as much of ``after``."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def fingerprint_documents(docs: DataFrame, *, shingle: int = 5, rows_per_range: int = 50_000) -> DataFrame:
    """``RESULT`` for each row of ``docs`` (doc_id, text)."""
    for_workers(docs.sparkSession)
    rows = columns(docs, "doc_id", "text").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("doc_id", F.lit(FIRST)).alias("key")
    )
    n = rows.count()
    ranges = max(64, n // rows_per_range)
    cuts = rows.agg(F.percentile_approx("key", [i / ranges for i in range(1, ranges)], 100 * ranges)).first()[0]
    bounds = np.unique(np.array(cuts or [], np.int64))

    def range_of(key: pd.Series) -> np.ndarray:
        return len(bounds) - np.searchsorted(bounds, key.to_numpy(), "left")  # 0 has the largest ids

    @F.pandas_udf("int")
    def in_range(key: pd.Series) -> pd.Series:
        return pd.Series(range_of(key).astype(np.int32))

    # One number for each range: its largest id, and the range before it.
    heads = rows.groupBy(in_range("key").alias("r")).agg(F.max("key").alias("head")).orderBy("r").collect()
    before = {r["head"]: heads[i - 1]["r"] for i, r in enumerate(heads)}

    @F.pandas_udf("int")
    def successor_of(key: pd.Series) -> pd.Series:
        """The range whose last row this row follows, or -1."""
        return key.map(before).fillna(-1).astype(np.int32)

    dealt = rows.withColumns({"r": in_range("key"), "of": successor_of("key")})
    place = F.struct(F.col("r").alias("r"), F.lit(False).alias("look"))
    ahead = F.struct(F.col("of").alias("r"), F.lit(True).alias("look"))
    dealt = dealt.select(
        "doc_id", "text", "key", F.explode(F.when(F.col("of") >= 0, F.array(place, ahead)).otherwise(F.array(place))).alias("p")
    ).select("doc_id", "text", "key", "p.r", "p.look")
    ordered = dealt.repartition("r").sortWithinPartitions("r", "look", F.desc("key"), "text")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, last, out = MinHasher(shingle), None, []
        for batch in batches:
            for doc_id, text, r, look in zip(batch.column(0), batch.column(1), batch.column(2), batch.column(3)):
                r, look = r.as_py(), look.as_py()
                if look and (last is None or last[0] != r):
                    continue  # a further row of the successor's doc_id
                text = text.as_py()
                row = (r, doc_id.as_py(), text, hasher.bits(text))
                if last is not None and last[0] == r:
                    out.append(_told(hasher, last, row))
                last = None if look else row
                if len(out) >= 2000:
                    yield _batch(out)
                    out = []
        yield _batch(out)

    return ordered.select("doc_id", "text", "r", "look").mapInArrow(stream, RESULT)


def _told(hasher: MinHasher, row: tuple, after: tuple) -> tuple:
    _, doc_id, text, bits = row
    new = edited(text, after[2])
    new_bits = hasher.bits(new)
    return (
        doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), hasher.packed(bits), hasher.packed(new_bits),
        hasher.likeness(bits, new_bits), hasher.likeness(bits, after[3]),
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    fields = [c.split() for c in RESULT.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kinds[kind]) for i, (_, kind) in enumerate(fields)], names=[f[0] for f in fields]
    )
