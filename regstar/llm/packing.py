"""Packing: bounded-space online packing of token sequences.

Each input partition keeps at most ``open_windows`` open windows. A piece of a
document goes whole into the open window that it fills best; if it fits in
none while all are open, the fullest one is filled up with the head of the
piece (documents may be cut) and emitted. Windows still open at the end of a
partition are leftovers: their pieces, with their ids, are merged in rounds
(``fan_in`` partitions at a time, again in bounded space) until one group is
left, whose rest is cut into full windows and one partial window.

Only this last window is padded, so padding is below one window in all.
Nothing is shuffled but leftovers: at most ``open_windows`` windows for each
partition, whatever the size of the input.

Defined cases: a null text is an empty text, and every document ends with
``end_id``, so an empty one has one token; a document longer than the window
gives full windows and a remainder; equal rows are packed once each; a null
doc_id stays null; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regstar.llm.shared import SharedTables, columns, for_workers

ID_BYTES = 4

#: ``ids``: little-endian unsigned 32-bit ids of the piece (null unless kept).
#: ``bin``: the group whose leftover this is; null once its window is emitted.
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, ids binary, bin long"
)


class TwoGenerations(dict):
    """A bounded cache: when full, it becomes the old generation, whose entries
    come back as they are asked for; what is not asked for again is dropped."""

    def __init__(self, keep: int):
        self.keep, self.old = keep, {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.made(key)
        if len(self) >= self.keep:
            self.old = dict(self)
            self.clear()
        self[key] = found
        return found


class PieceIds(TwoGenerations):
    """Token ids (little-endian bytes) of the pieces into which the tokenizer
    splits a lower-case word."""

    def __init__(self, tokenizer, keep: int):
        super().__init__(keep)
        from tokenizers.pre_tokenizers import ByteLevel

        self.model = tokenizer.model
        as_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        accented = [chr(c) for c in range(0xC0, 0x100)]
        self.spelled = {ord(c): as_bytes.pre_tokenize_str(c)[0][0] for c in accented}

    def made(self, piece: str) -> bytes:
        spelled = piece if piece.isascii() else piece.translate(self.spelled)
        return b"".join([t.id.to_bytes(ID_BYTES, "little") for t in self.model.tokenize(spelled)])


class WordIds(TwoGenerations):
    """Token ids (little-endian bytes) by white-space separated word. The
    tokenizer never joins text across ASCII white space, so a text's ids are
    its words' ids in a row; most words of a partition are seen before."""

    KEEP = 300_000  # words and pieces of one generation: bounds the memory of a worker
    LONGEST = 64  # bytes of a word that is kept

    # Words of these characters are split as the tokenizer does it: runs of
    # letters, single digits, other runs. (Without "<", which begins the
    # strings of special tokens.)
    PLAIN = re.compile("[!-;=-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch
    LETTER = "a-z\u00df-\u00f6\u00f8-\u00ff"
    PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[0-9]|[^{LETTER}0-9]+").findall

    def __init__(self, path: str, keep: int | None = None):
        super().__init__(keep or self.KEEP)
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.pieces = PieceIds(self.tokenizer, self.keep)
        # That the given tokenizer splits so is seen on a word with every character.
        signs = "".join(chr(c) for c in range(33, 256) if self.PLAIN(chr(c)))
        probes = [signs, "It's ÉTÉ's we'LL 12ab34,56--c", *(f"a{c}b{c}{c}1" for c in signs), *(f"{c}Été" for c in signs)]
        self.plain = all(self._by_pieces(w) == self._whole(w) for probe in probes for w in probe.split())

    def _by_pieces(self, word: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.PIECES(word.lower())))

    def _whole(self, word: str) -> bytes:
        ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def made(self, key: bytes) -> bytes:
        word = key.decode()
        return self._by_pieces(word) if self.plain and self.PLAIN(word) else self._whole(word)

    def __missing__(self, key: bytes) -> bytes:
        return super().__missing__(key) if len(key) <= self.LONGEST else self.made(key)

    def text(self, text: str) -> bytes:
        # bytes.split: the ASCII white space \x09-\x0d and \x20.
        return b"".join(map(self.__getitem__, text.encode().split()))


_WORDS: dict[tuple, WordIds] = {}


def words_of(path: str, keep: int | None = None) -> WordIds:
    """The worker's own ``WordIds``, kept from one task to the next."""
    if (path, keep) not in _WORDS:
        _WORDS.clear()
        _WORDS[path, keep] = WordIds(path, keep)
    return _WORDS[path, keep]


class Packer:
    """Open windows of one partition; emitted pieces collect in ``out``."""

    def __init__(self, window: int, open_windows: int, first_sequence: int, keep_ids: bool):
        self.window, self.most, self.keep = window, open_windows, keep_ids
        self.sequence = first_sequence
        self.open: list[tuple[int, int, list]] = []  # (free, number, pieces) by free space
        self.number = 0
        self.out: list[tuple] = []

    def add(self, doc_id, start: int, tokens: int, ids: bytes) -> None:
        n, w = len(ids) // ID_BYTES, self.window
        at = 0
        while n - at >= w:
            self._emit([(doc_id, start + at, tokens, ids[at * ID_BYTES : (at + w) * ID_BYTES])])
            at += w
        while at < n:
            rest = n - at
            fit = bisect.bisect_left(self.open, (rest,))
            if fit < len(self.open):
                free, number, pieces = self.open.pop(fit)
            elif len(self.open) < self.most:
                self.number += 1
                free, number, pieces = w, self.number, []
            else:
                free, number, pieces = self.open.pop(0)  # the fullest: filled and emitted
            take = min(rest, free)
            pieces.append((doc_id, start + at, tokens, ids[at * ID_BYTES : (at + take) * ID_BYTES]))
            at += take
            if take == free:
                self._emit(pieces)
            else:
                bisect.insort(self.open, (free - take, number, pieces), key=lambda x: x[:2])

    def _emit(self, pieces: list, bin_: int | None = None) -> None:
        offset = 0
        for doc_id, start, tokens, ids in pieces:
            n = len(ids) // ID_BYTES
            kept = ids if self.keep or bin_ is not None else None
            self.out.append((doc_id, start, n, zlib.crc32(ids), tokens, self.sequence, offset, kept, bin_))
            offset += n
        self.sequence += 1

    def leave(self, bin_: int) -> None:
        """Write open windows as leftovers of ``bin_``."""
        for _, _, pieces in self.open:
            self._emit(pieces, bin_)
        self.open = []

    def finish(self) -> None:
        """Cut the rest into full windows and one partial one."""
        rest = [p for _, _, pieces in sorted(self.open, key=lambda x: x[:2]) for p in pieces]
        self.open, self.most = [], 1
        for doc_id, start, tokens, ids in rest:
            self.add(doc_id, start, tokens, ids)
        for _, _, pieces in self.open:
            self._emit(pieces)
        self.open = []

    def batch(self) -> pa.RecordBatch:
        rows, self.out = self.out, []
        kinds = [pa.int64()] * 7 + [pa.binary(), pa.int64()]
        names = [c.split()[0] for c in PIECES.split(", ")]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=names
        )


class OrderedPacker(Packer):
    """A packer whose documents begin in the order in which they come: a head
    goes into the current window, the only one that takes heads, until that is
    full; the next head then goes into the open window that it fills best, which
    becomes the current one. The rest of a document whose head filled a window
    is packed like any piece. A window that holds the head of a document is so
    emitted before all that hold its rest."""

    def __init__(self, window: int, open_windows: int, first_sequence: int, keep_ids: bool):
        super().__init__(window, open_windows, first_sequence, keep_ids)
        self.current: tuple[int, list] | None = None  # (free, pieces)

    def add(self, doc_id, start: int, tokens: int, ids: bytes) -> None:
        n, take = len(ids) // ID_BYTES, 0
        if not start:
            free, pieces = self.current or self._next(n)
            take = min(n, free)
            pieces.append((doc_id, start, tokens, ids[: take * ID_BYTES]))
            self.current = (free - take, pieces) if take < free else None
            if not self.current:
                self._emit(pieces)
        if take < n:
            super().add(doc_id, start + take, tokens, ids[take * ID_BYTES :])

    def _next(self, n: int) -> tuple[int, list]:
        fit = bisect.bisect_left(self.open, (n,))
        if fit == len(self.open):
            if len(self.open) < self.most:
                return self.window, []
            fit = 0  # the fullest: filled up with the head of this one
        free, _, pieces = self.open.pop(fit)
        return free, pieces

    def finish(self) -> None:
        """Cut the rest into full windows and one partial one, the current
        window's documents first."""
        heads = [] if not self.current else self.current[1]
        tails = [p for _, _, pieces in sorted(self.open, key=lambda x: x[:2]) for p in pieces]
        self.open, self.current, self.most = [], None, 1
        for doc_id, start, tokens, ids in heads + tails:
            super().add(doc_id, start, tokens, ids)
        for _, _, pieces in self.open:
            self._emit(pieces)
        self.open = []


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    window: int = 4096,
    open_windows: int = 16,
    fan_in: int = 16,
    end_id: int = 2,
    keep_ids: bool = False,
) -> DataFrame:
    """Pieces of packed sequences over ``docs`` (doc_id, text); columns as in
    ``PIECES`` without ``bin``. ``sequence_id`` is unique, not gapless."""
    spark = for_workers(docs.sparkSession)
    shared = SharedTables(spark, "packing")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        packer = Packer(window, open_windows, part << 30, keep_ids)
        words, end = words_of(tokenizer_path), end_id.to_bytes(ID_BYTES, "little")
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids = words.text(text.as_py() or "") + end
                packer.add(doc_id.as_py(), 0, len(ids) // ID_BYTES, ids)
                if len(packer.out) >= 4096:
                    yield packer.batch()
        packer.leave(part)
        yield packer.batch()

    done = shared.put(columns(docs, "doc_id", "text").mapInArrow(first, PIECES), "wave0")
    emitted, wave = [done.where("bin IS NULL")], 0
    left = done.where("bin IS NOT NULL")
    while (most := left.agg(F.max("bin")).first()[0]) is not None:
        wave += 1
        last = most < fan_in
        def merge(key, table, last, number):
            packer = Packer(window, open_windows, number + (key[0].as_py() << 30), keep_ids)
            # open_windows * fan_in windows at most
            rows = sorted(table.to_pylist(), key=lambda r: (r["sequence_id"], r["offset"]))
            for r in rows:
                packer.add(r["doc_id"], r["start"], r["doc_tokens"], r["ids"])
            if last:
                packer.finish()
            else:
                packer.leave(key[0].as_py())
            return pa.Table.from_batches([packer.batch()])

        merged = left.withColumn("into", F.expr(f"bin div {fan_in}")).drop("bin").groupBy("into")
        done = shared.put(merged.applyInArrow(_with(merge, last, wave << 54), PIECES), f"wave{wave}")
        emitted.append(done.where("bin IS NULL"))
        left = done.where("bin IS NOT NULL")
        if last:
            break
    out = emitted[0]
    for more in emitted[1:]:
        out = out.unionByName(more)
    return out.drop("bin")


def _with(merge, last: bool, number: int):
    """``merge`` as a function of (key, table) alone."""
    return lambda key, table: merge(key, table, last, number)


#: Token ids of a written table: ``run`` is the row where a run of rows that one
#: task read in a row begins, ``at`` the place of ``ids`` among the run's tokens.
TOKENS = "file string, run long, at long, doc_id long, start long, n long, doc_tokens long, ids binary"


def pack_in_order(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    window: int = 4096,
    open_windows: int = 1,
    stretch: int = 32,
    end_id: int = 2,
    keep_words: int = 100_000,
) -> DataFrame:
    """Pieces (with ids) of sequences 0, 1, ... over ``docs``, a table as read
    from its files; documents begin in the order in which its rows were
    written, and only the last sequence is shorter than ``window``. Spark
    reads the files in any order and in splits; the written order is that of
    the files' numbers and of the rows in each.

    The tokens in a row are dealt into stretches of ``stretch`` full windows, and
    each is packed by an ``OrderedPacker`` with ``open_windows`` (with one, that
    cuts the tokens in a row). A stretch fills its windows, so it leaves nothing
    over, its sequences have their numbers at once, and no task holds more than
    a stretch. ``keep_words`` bounds the words that a worker remembers."""
    spark = for_workers(docs.sparkSession)
    shared = SharedTables(spark, "packing_in_order")
    most = 16 * window  # tokens of a row: long documents take several

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = words_of(tokenizer_path, keep_words), end_id.to_bytes(ID_BYTES, "little")
        file, run, row, at, out, size = None, 0, 0, 0, [], 0
        kinds = [pa.string(), *[pa.int64()] * 6, pa.binary()]
        names = [c.split()[0] for c in TOKENS.split(", ")]

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)

        for batch in batches:
            # Row by row: the texts of a whole batch are not held twice.
            for doc_id, text, path, index in zip(*((x.as_py() for x in batch.column(i)) for i in range(4))):
                if path != file or index != row + 1:
                    file, run, at = path, index, 0
                row = index
                ids = words.text(text or "") + end
                n = len(ids) // ID_BYTES
                for start in range(0, n, most):
                    part = ids[start * ID_BYTES : (start + most) * ID_BYTES]
                    out.append((file, run, at, doc_id, start, len(part) // ID_BYTES, n, part))
                    at += len(part) // ID_BYTES
                    size += len(part)
                    if len(out) >= 4096 or size >= 4 << 20:
                        yield rows()
                        out, size = [], 0
        yield rows()

    have = {c.lower(): c for c in docs.columns}
    read = docs.select(
        *(F.col(f"`{have[c]}`").alias(c) for c in ("doc_id", "text")),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"),
    )
    done = shared.put(read.mapInArrow(tokens, TOKENS), "tokens")
    # A row for each split that a task read; their numbers are summed in one task.
    runs = shared.put(done.groupBy("file", "run").agg(F.sum("n").alias("run_tokens")), "runs")
    number = [F.regexp_extract("file", p, 1).try_cast("long") for p in (r"part-(\d+)[^/]*$", r"-c(\d+)[^/]*$")]
    before = Window.orderBy(*number, "file", "run").rowsBetween(Window.unboundedPreceding, -1)
    bases = shared.put(
        runs.select("file", "run", F.coalesce(F.sum("run_tokens").over(before), F.lit(0)).alias("base")), "bases"
    )
    placed = done.join(bases, ["file", "run"]).withColumn("begin", F.col("base") + F.col("at"))
    size = stretch * window
    cut = placed.select("*", F.explode(F.expr(f"sequence(begin div {size}, (begin + n - 1) div {size})")).alias("stretch"))
    low = F.greatest("begin", F.col("stretch") * size)
    high = F.least(F.col("begin") + F.col("n"), (F.col("stretch") + 1) * size)
    first = (F.col("low") - F.col("begin")).cast("int")
    part = F.substring("ids", first * ID_BYTES + 1, (F.col("high") - F.col("low")).cast("int") * ID_BYTES)
    cut = cut.withColumns({"low": low, "high": high}).select(
        "stretch", "low", "doc_id", (F.col("start") + first).alias("start"), "doc_tokens", part.alias("ids")
    )

    def pack(key, table: pa.Table) -> pa.Table:
        packer = OrderedPacker(window, open_windows, key[0].as_py() * stretch, True)
        rows = table.sort_by("low").select(["doc_id", "start", "doc_tokens", "ids"])
        held = None  # a document, of which the next rows may hold more
        for doc_id, start, tokens, ids in zip(*(c.to_pylist() for c in rows.columns)):
            if held and start:  # rows in a row: it goes on
                held[3].append(ids)
                continue
            if held:
                packer.add(*held[:3], b"".join(held[3]))
            held = (doc_id, start, tokens, [ids])
        packer.add(*held[:3], b"".join(held[3]))
        packer.finish()
        return pa.Table.from_batches([packer.batch()])

    return cut.groupBy("stretch").applyInArrow(_plain(pack), PIECES).drop("bin")


def _plain(function):
    """Without the annotations that Spark would read as another kind."""
    return lambda key, table: function(key, table)


def sequences(pieces: DataFrame, *, window: int = 4096) -> DataFrame:
    """One row for each packed sequence of ``pack_documents(keep_ids=True)`` or
    ``pack_in_order``: its token ids and, in the same order, the pieces they come from. A
    sequence holds at most ``window`` pieces, so its group is bounded."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids")))
    grouped = pieces.groupBy("sequence_id").agg(parts.alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda out, p: F.concat(out, p["ids"]))
    return grouped.select(
        "sequence_id",
        F.transform("parts", lambda p: p["doc_id"]).alias("doc_ids"),
        F.transform("parts", lambda p: p["start"]).alias("starts"),
        F.transform("parts", lambda p: p["length"]).alias("lengths"),
        F.expr("aggregate(parts, 0L, (n, p) -> n + p.length)").alias("n_tokens"),
        joined.alias("ids"),
    )
