"""Repeated windows of texts by two passes of winnowed anchors and full windows.

Windows of ``DEPTH`` bytes that stand in several documents are found by digits that
are hashes, dealt out to ``groups`` parts: no suffix is ordered by its leading bytes
(the README says why no radix sort was built).

1. Digit: a hash of ``GRAM`` bytes. Of the suffixes a window holds, the first with
   the least digit owns it (winnowing: equal windows have equal owners, and about
   one suffix in sixteen moves). Digits in one place only are done. Suffixes with
   one digit are told apart by the next: all bytes of the windows they own. Where
   these are equal too, every window is, and all but the first document's are
   found repeated.
2. What is left has equal digits in differing surroundings. The windows it owns are
   dealt out by two hashes of the full depth; equal groups are repeated windows.

Texts do not move. They are written once in the pieces Spark reads them in, each
row with a number, and passes send only digits, 12 bytes each in the first and 10
in the second, with the numbers and ids of their rows. Answers come back in one table a pass, parted by piece, and a task reads those of its own.

Within a task only the first document of equal suffixes asks; the others are
settled by it. A common digit in differing surroundings still sends one row per
occurrence to one part of the first pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicksieve.llm.id_store import filesystem
from clicksieve.session import scratch_path

DEPTH = 50
GRAM = 20
SIDE = DEPTH - GRAM  # bytes a window may have on either side of a digit
PAD = SIDE + 10  # zeros between texts in a buffer
SLICE = 1 << 16  # bytes or places hashed at a time
FLUSH = 1 << 24  # bytes of text whose suffixes are settled together
PART_BYTES = 1 << 25  # bytes of text per part of a pass
LEAST_PARTS = 64
WIDTHS = 4, 2  # bytes of the coarse digit sent in each pass, beside 8 of the fine one and the part
PIECE = 33  # bits of a row's number below the number of its piece

_C = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]
_TOP = np.iinfo(np.uint64).max
_AROUND = range(-SIDE, GRAM + SIDE, 8)  # places of the words around a digit
# of each such word, the bytes among the first before a digit and among the first behind it
_LEFT = {k: np.array([int(_TOP) << 8 * min(max(-n - k, 0), 8) & int(_TOP) for n in range(SIDE + 1)], np.uint64) for k in _AROUND}
_RIGHT = {k: np.array([int(_TOP) >> 8 * min(max(k + 8 - GRAM - n, 0), 8) for n in range(SIDE + 1)], np.uint64) for k in _AROUND}


def _round(t: np.ndarray, x: np.ndarray) -> np.ndarray:
    t = (t + x) * _C[0]
    t ^= t >> np.uint64(32)
    t *= _C[1]
    return t ^ (t >> np.uint64(29))


@dataclass
class Anchors:
    """Places of digits, their hashes, the first and last start of the windows they own, and rows."""

    places: np.ndarray
    digits: np.ndarray
    first: np.ndarray
    last: np.ndarray
    rows: np.ndarray

    def windows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and rows of the windows that the chosen ones own; no window has two owners."""
        first, n = self.first[which], (self.last - self.first)[which] + 1
        ends = np.cumsum(n)
        return np.arange(n.sum()) + np.repeat(first - ends + n, n), np.repeat(self.rows[which], n)


class Texts:
    """The texts of some rows in one buffer, with zeros around each."""

    def __init__(self, column: pa.Array):
        offsets = np.frombuffer(column.buffers()[1], np.int32 if pa.types.is_string(column.type) else np.int64)[
            column.offset:column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
        valid = column.is_valid().to_numpy(zero_copy_only=False)
        self.sizes = np.where(valid, np.diff(offsets), 0).astype(np.int64)
        self.starts = PAD + np.concatenate([[0], np.cumsum(self.sizes + PAD)[:-1]]).astype(np.int64)
        self.buffer = np.zeros(int(self.sizes.sum()) + PAD * (len(column) + 2) + 8, np.uint8)
        self.whole = np.zeros(len(self.buffer), bool)  # a digit that starts here lies inside a text long enough
        for k, (a, n) in enumerate(zip(self.starts, self.sizes)):
            self.buffer[a:a + n] = data[offsets[k]:offsets[k] + n]
            if n >= DEPTH:
                self.whole[a:a + n - GRAM + 1] = True
        self.words = np.ndarray((len(self.buffer) - 7,), "<u8", self.buffer.data, strides=(1,))

    def text(self, k: int) -> np.ndarray:
        return self.buffer[self.starts[k]:self.starts[k] + self.sizes[k]]

    def hashes(self, at: np.ndarray, length: int, seed: int) -> np.ndarray:
        """Hash of the ``length`` bytes from each place."""
        out = np.full(len(at), seed, np.uint64)
        for a in range(0, len(at), SLICE):
            own, t = at[a:a + SLICE], out[a:a + SLICE]
            for k in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
                t = _round(t, self.words[own + k])
            out[a:a + SLICE] = t
        return out

    def anchors(self) -> Anchors:
        """Places that own windows, with the hashes of their digits and the windows they own."""
        found = []
        span = SIDE + 1  # digits in a window
        n = len(self.words) - GRAM
        for core in range(0, max(n, 0), SLICE):
            a, b = max(core - DEPTH, 0), min(core + SLICE + DEPTH, n)
            h = np.zeros(b - a, np.uint64)
            for k in (0, 8, GRAM - 8):
                h = _round(h, self.words[a + k:b + k])
            h[~self.whole[a:b]] = _TOP
            low = _sliding(h, span, np.minimum)
            # the greatest of the minima of all windows that hold a digit; equal to its hash if one picks it
            high = _sliding(np.concatenate([np.zeros(span - 1, np.uint64), low, np.zeros(span - 1, np.uint64)]), span, np.maximum)
            at = np.flatnonzero((high[:len(h)] == h) & self.whole[a:b])
            if not len(at):
                continue
            # runs of windows with one least digit, in the order of the places that pick it
            cuts = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1], [True]]))
            held = low[cuts[:-1]] != _TOP
            begin, end = cuts[:-1][held], cuts[1:][held] - 1
            digit = h[at]
            tied = np.concatenate([[False], (digit[1:] == digit[:-1]) & (np.diff(at) <= span)])
            run = np.cumsum(~tied) - 1
            first, last = begin[run], np.minimum(end[run], at)
            t = np.flatnonzero(tied)  # the first of equal digits owns a window
            first[t] = np.maximum(first[t], at[t - 1] + 1)
            own = (at + a >= core) & (at + a < core + SLICE)
            found.append((at[own] + a, digit[own], first[own] + a, last[own] + a))
        if not found:
            return Anchors(*[np.empty(0, t) for t in (np.int64, np.uint64, np.int64, np.int64, np.int64)])
        places, digits, first, last = (np.concatenate(x) for x in zip(*found))
        rows = self.of(places)
        first = np.maximum(first, self.starts[rows])
        last = np.minimum(last, self.starts[rows] + self.sizes[rows] - DEPTH)
        own = first <= last
        return Anchors(places[own], digits[own], first[own], last[own], rows[own])

    def of(self, places: np.ndarray) -> np.ndarray:
        """Row of each place."""
        return np.searchsorted(self.starts, places, "right") - 1

    def surroundings(self, anchors: Anchors) -> np.ndarray:
        """Hash of all bytes of the windows an anchor owns, and of its place among them."""
        left = anchors.places - anchors.first
        right = anchors.last + SIDE - anchors.places
        t = np.full(len(left), 11, np.uint64)
        for k in _AROUND:
            word = self.words[anchors.places + k]
            if k < 0:
                word &= _LEFT[k][left]
            if k + 8 > GRAM:
                word &= _RIGHT[k][right]
            t = _round(t, word)
        return _round(t, (left * 256 + right).astype(np.uint64))


def _sliding(x: np.ndarray, span: int, take: np.ufunc) -> np.ndarray:
    """take over each ``span`` neighbours, by doubling; one value per full window."""
    have = 1
    while 2 * have <= span:
        x = take(x[:-have], x[have:])
        have *= 2
    return take(x[:len(x) - (span - have)], x[span - have:]) if span > have else x


class Asking:
    """Collects (coarse digit, fine digit) of rows and packs them by part.

    Of a coarse digit the upper ``width`` bytes are sent, and none where the task
    itself has settled the suffix. A bit tells where the next row's digits begin.
    """

    def __init__(self, groups: int, salt: int, width: int):
        self.groups, self.salt, self.width = groups, salt, width
        self.held: list[tuple[np.ndarray, ...]] = []
        self.bytes = 0

    def add(self, coarse: np.ndarray, fine: np.ndarray, ids: np.ndarray, rows: np.ndarray, size: int) -> None:
        self.held.append((coarse, fine, ids, rows))
        self.bytes += size

    def flush(self) -> pa.RecordBatch | None:
        if not self.held:
            return None
        coarse, fine, ids, rows = (np.concatenate(x) for x in zip(*self.held))
        self.held, self.bytes = [], 0
        order = np.lexsort((rows, ids, fine, coarse))
        coarse, fine, ids, rows = coarse[order], fine[order], ids[order], rows[order]
        new = np.ones(len(order), bool)
        new[1:] = (coarse[1:] != coarse[:-1]) | (fine[1:] != fine[:-1])
        again = ~new
        again[1:] &= rows[1:] == rows[:-1]
        first = ids[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))] if len(order) else ids
        settled = ids > first  # a smaller id of this task has the same suffix
        keep = ~again
        coarse, fine, ids, rows, settled = (x[keep] for x in (coarse, fine, ids, rows, settled))
        part = (coarse % np.uint64(self.groups)).astype(np.int64)
        part[settled] = self.groups + (rows[settled] + self.salt) % self.groups
        order = np.lexsort((rows, part))
        coarse, fine, ids, rows, part = (x[order] for x in (coarse, fine, ids, rows, part))
        cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-1)) if len(part) else np.empty(0, np.int64)
        out = {"part": [], "owners": [], "which": [], "coarse": [], "fine": []}
        for a, b in zip(cuts[:-1], cuts[1:]):
            next_row = np.diff(rows[a:b], prepend=-1) != 0
            out["part"].append(int(part[a]))
            out["owners"].append(np.stack([rows[a:b][next_row], ids[a:b][next_row]]).astype("<i8").tobytes())
            out["which"].append(np.packbits(next_row).tobytes())
            out["coarse"].append(b"" if part[a] >= self.groups else
                                 (coarse[a:b] >> np.uint64(64 - 8 * self.width)).astype(f"<u{self.width}").tobytes())
            out["fine"].append(fine[a:b].astype("<u8").tobytes())
        return pa.RecordBatch.from_pydict(out, pa.schema(
            [("part", pa.int32())] + [(c, pa.binary()) for c in ("owners", "which", "coarse", "fine")]))


ASKED = "part int, owners binary, which binary, coarse binary, fine binary"
ANSWERS = "piece int, row long, repeated binary, open binary"


def _answer(groups: int, width: int, last: bool):
    """Settles one part: which of its suffixes are repeated, and which stay open (none in the last pass)."""

    def run(table: pa.Table) -> pa.Table:
        rows, ids, coarse, fine = [], [], [], []
        for r in table.to_pylist():
            f = np.frombuffer(r["fine"], "<u8")
            own = np.frombuffer(r["owners"], "<i8").reshape(2, -1)
            which = np.cumsum(np.unpackbits(np.frombuffer(r["which"], np.uint8), count=len(f)), dtype=np.int64) - 1
            rows.append(own[0][which])
            ids.append(own[1][which])
            coarse.append(np.frombuffer(r["coarse"], f"<u{width}"))
            fine.append(f)
        rows, ids, coarse, fine = (np.concatenate(x) for x in (rows, ids, coarse, fine))
        if table.column("part")[0].as_py() >= groups:
            repeated, is_open = np.ones(len(rows), bool), np.zeros(len(rows), bool)
        else:
            order = np.lexsort((ids, fine, coarse))
            rows, ids, coarse, fine = rows[order], ids[order], coarse[order], fine[order]
            start = np.diff(coarse.astype(np.int64), prepend=-1) != 0
            new = start.copy()
            new[1:] |= fine[1:] != fine[:-1]
            first = ids[np.maximum.accumulate(np.where(new, np.arange(len(ids)), 0))]
            repeated = ids > first
            group = np.cumsum(start) - 1
            kinds = np.bincount(group, weights=new)
            is_open = ~repeated & (kinds[group] > 1) & (not last)
        told = repeated | is_open
        rows, fine, repeated = rows[told], fine[told], repeated[told]
        order = np.lexsort((fine, ~repeated, rows))
        rows, fine, repeated = rows[order], fine[order], repeated[order]
        cuts = np.flatnonzero(np.diff(rows, prepend=-1, append=-1)) if len(rows) else np.empty(0, np.int64)
        out = {"piece": [], "row": [], "repeated": [], "open": []}
        for a, b in zip(cuts[:-1], cuts[1:]):
            m = a + int(repeated[a:b].sum())
            out["piece"].append(int(rows[a]) >> PIECE)
            out["row"].append(int(rows[a]))
            out["repeated"].append(fine[a:m].tobytes())
            out["open"].append(fine[m:b].tobytes())
        return pa.table(out, pa.schema([("piece", pa.int32()), ("row", pa.int64()), ("repeated", pa.binary()), ("open", pa.binary())]))

    return run


class Answers:
    """Answers for the rows of one piece at a time."""

    def __init__(self, path: str | None):
        self.path, self.piece, self.of = path, None, {}

    def get(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        """Fine digits of a row that are repeated, and those that are open."""
        none = np.empty(0, np.uint64)
        if self.path is None:
            return none, none
        if row >> PIECE != self.piece:
            self.piece, self.of = row >> PIECE, {}
            store, folder = filesystem(self.path)
            at = f"{folder}/piece={self.piece}"
            for f in store.get_file_info(fs.FileSelector(at, allow_not_found=True)):
                if f.base_name.endswith(".parquet"):
                    with store.open_input_file(f.path) as data:
                        for r in pq.ParquetFile(data).read(["row", "repeated", "open"]).to_pylist():
                            own = self.of.setdefault(r["row"], ([], []))
                            own[0].append(r["repeated"])
                            own[1].append(r["open"])
        found = self.of.get(row)
        return tuple(np.frombuffer(b"".join(x), "<u8") for x in found) if found else (none, none)


def _member(values: np.ndarray, rows: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """Whether each value is in its row's set; ``rows`` ascend."""
    out = np.zeros(len(values), bool)
    cuts = np.searchsorted(rows, np.arange(len(sets) + 1))
    for k, s in enumerate(sets):
        if len(s):
            out[cuts[k]:cuts[k + 1]] = np.isin(values[cuts[k]:cuts[k + 1]], s)
    return out


def _ask(asked: DataFrame, groups: int, width: int, last: bool) -> str:
    """Deals out what a pass asks and writes the answers, parted by piece."""
    answers = asked.groupBy("part").applyInArrow(_answer(groups, width, last), ANSWERS)
    path = scratch_path(asked.sparkSession, "answers")
    answers.repartition("piece").write.partitionBy("piece").parquet(path)
    return path


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept) of each row; ``kept`` is a binary column.

    Texts count as UTF-8 bytes, null as empty. A byte is removed when a window of
    ``DEPTH`` bytes that covers it also starts in a document with a smaller id;
    windows lie inside one text and are judged on the input. Spans are maximal
    removed runs. Texts shorter than a window, and rows with a null id, neither
    lose bytes nor cause losses; rows that share an id do not affect each other.
    An empty table gives an empty table.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "pieces")
    docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
                F.col(text_col).alias("text")).write.option("compression", "zstd").parquet(path)
    pieces = spark.read.schema("row long, id long, text string").parquet(path)
    size = pieces.select(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(LEAST_PARTS, size // PART_BYTES)
    long = pieces.filter(F.col("id").isNotNull() & (F.octet_length("text") >= DEPTH))

    def anchors_of(batch: pa.RecordBatch):
        texts = Texts(batch.column(2))
        anchors = texts.anchors()
        return texts, anchors, texts.surroundings(anchors)

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asking = None
        for batch in batches:
            for part in _by_size(batch):
                texts, anchors, around = anchors_of(part)
                asking = asking or Asking(groups, int(part.column(0)[0].as_py()) >> PIECE, WIDTHS[0])
                number, ids = part.column(0).to_numpy(), part.column(1).to_numpy()
                asking.add(anchors.digits, around, ids[anchors.rows], number[anchors.rows], len(texts.buffer))
                if asking.bytes >= FLUSH:
                    yield asking.flush()
        if asking and asking.held:
            yield asking.flush()

    first = _ask(long.mapInArrow(first_pass, ASKED), groups, WIDTHS[0], last=False)

    def open_windows(texts: Texts, number: np.ndarray, anchors: Anchors, around: np.ndarray, answers: Answers):
        """Anchors settled as repeated, and starts, rows and hashes of the windows still open."""
        told = [answers.get(int(n)) for n in number]
        repeated = _member(around, anchors.rows, [t[0] for t in told])
        starts, own = anchors.windows(_member(around, anchors.rows, [t[1] for t in told]))
        return repeated, starts, own, texts.hashes(starts, DEPTH, 23)

    def second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asking, answers = None, Answers(first)
        for batch in batches:
            for part in _by_size(batch):
                texts, anchors, around = anchors_of(part)
                asking = asking or Asking(groups, int(part.column(0)[0].as_py()) >> PIECE, WIDTHS[1])
                number, ids = part.column(0).to_numpy(), part.column(1).to_numpy()
                _, starts, own, fine = open_windows(texts, number, anchors, around, answers)
                asking.add(texts.hashes(starts, DEPTH, 37), fine, ids[own], number[own], len(starts) * DEPTH)
                if asking.bytes >= FLUSH:
                    yield asking.flush()
        if asking and asking.held:
            yield asking.flush()

    second = _ask(long.mapInArrow(second_pass, ASKED), groups, WIDTHS[1], last=True)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, after = Answers(first), Answers(second)
        for batch in batches:
            for part in _by_size(batch):
                texts, anchors, around = anchors_of(part)
                number = part.column(0).to_numpy()
                repeated, starts, own, fine = open_windows(texts, number, anchors, around, before)
                again = _member(fine, own, [after.get(int(n))[0] for n in number])
                mark = np.zeros(len(texts.buffer) + 1, np.int32)
                np.add.at(mark, anchors.first[repeated], 1)
                np.add.at(mark, anchors.last[repeated] + DEPTH, -1)
                np.add.at(mark, starts[again], 1)
                np.add.at(mark, starts[again] + DEPTH, -1)
                gone = np.cumsum(mark)[:-1] > 0
                removed, spans, kept = [], [], []
                for k in range(len(part)):
                    a, b = texts.starts[k], texts.starts[k] + texts.sizes[k]
                    g = gone[a:b]
                    removed.append(int(g.sum()))
                    spans.append(int(np.count_nonzero(np.diff(g.astype(np.int8), prepend=0) == 1)))
                    kept.append(texts.text(k)[~g].tobytes())
                yield pa.RecordBatch.from_arrays([
                    part.column(1), pa.array(texts.sizes, pa.int64()), pa.array(removed, pa.int64()),
                    pa.array(spans, pa.int64()), pa.array(kept, pa.binary())], ["id", "n_bytes", "n_removed", "n_spans", "kept"])

    return pieces.mapInArrow(cut, "id long, n_bytes long, n_removed long, n_spans long, kept binary")


def _by_size(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in runs of about 4 MB of text."""
    sizes = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = np.unique(np.concatenate([[0], np.searchsorted(sizes, np.arange(1, sizes[-1] // (1 << 22) + 1) << 22, "left") + 1, [len(batch)]])) \
        if len(batch) else [0]
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield batch.slice(a, b - a)
