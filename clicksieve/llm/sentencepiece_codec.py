"""SentencePiece encoding and decoding by streaming Viterbi.

The model file is a list of merges: the adjacent pair whose piece scores best is
merged first, the leftmost of equals. Of a beginning of a text that way knows one
last piece. It is the longest one that ends there and that its neighbour allows:
the two stay apart when their joined characters are merged on their own. So every
position gets one backpointer, to the start of the last piece before it, from the
positions that a piece reaches back to, and the ids are those of the library.

The text is read once. Only positions that a piece may still start from are open,
the longest piece being the window. As soon as the backpointer paths of all open
positions meet at one boundary, the pieces before it are final: their ids are
committed and their positions forgotten, so memory follows the window and not the
text.

No piece leads from a letter over a blank, nor over a line end, when the model's
pieces say so; such places are boundaries on every path. What lies between two of
them is encoded for itself, and a worker remembers what it gave for short ones.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicksieve.llm.common import replace_columns

BLANK = "▁"  # fixed value: stands for a blank in pieces
UNCOVERED = -1  # in place of an id: a character without a piece, or no piece at all
PAIRS = 1_000_000  # neighbours a worker remembers
REMEMBERED = 250_000  # segments in a generation of what a worker remembers
SHORT = 48  # characters of a segment worth remembering


class Codec:
    """Pieces, scores and bytes of a model file."""

    def __init__(self, model: str):
        import sentencepiece

        vocab = sentencepiece.SentencePieceProcessor(model_file=model)
        self.scores: dict[str, tuple[float, int]] = {}
        self.byte_ids: dict[int, int] = {}
        self.bytes_of: list[bytes] = []
        for i in range(vocab.get_piece_size()):
            piece = vocab.id_to_piece(i)
            if vocab.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif vocab.is_control(i) or vocab.is_unknown(i) or vocab.is_unused(i):
                self.bytes_of.append(b"")
            else:
                self.scores[piece] = (vocab.get_score(i), i)
                self.bytes_of.append(piece.replace(BLANK, " ").encode())
        self.unknown = vocab.unk_id()
        self.pieces = {i: p for p, (_, i) in self.scores.items()}
        self.matcher = ahocorasick.Automaton()  # the pieces that end at each position, longest first
        for piece, (_, i) in self.scores.items():
            self.matcher.add_word(piece, (len(piece), i))
        self.matcher.make_automaton()
        self.longest = max(map(len, self.scores), default=1)
        self.pairs: dict[tuple[int, int], bool] = {}
        long = [p for p in self.scores if len(p) > 1]
        over_blank = any(re.search(f"[^{BLANK}]{BLANK}", p) for p in long)
        over_line = any("\n" in p for p in long)
        parts = {(False, False): f"{BLANK}+[^{BLANK}\n]*|[^{BLANK}\n]+|\n", (True, False): "[^\n]+|\n",
                 (False, True): f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+"}.get((over_blank, over_line), r"(?s:.+)")
        self.parts = re.compile(parts)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _fallback(self, char: str) -> list[int]:
        ids = [self.byte_ids.get(b, self.unknown) for b in char.encode("utf-8", "surrogatepass")]
        return ids if self.unknown not in ids else [self.unknown]

    def merged(self, text: str) -> list[str]:
        """Pieces of a few characters by merging them, best score first, leftmost of equals."""
        parts, scores = list(text), self.scores
        while True:
            pairs = [(-scores[p][0], k) for k in range(len(parts) - 1) if (p := parts[k] + parts[k + 1]) in scores]
            if not pairs:
                return parts
            k = min(pairs)[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]

    def stay_apart(self, left: int, right: int) -> bool:
        """True when two pieces side by side come out of the merges as they are."""
        known = self.pairs.get((left, right))
        if known is None:
            pair = [self.pieces[i] for i in (left, right) if i != UNCOVERED]
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = self.merged("".join(pair)) == pair
        return known

    def stream(self, text: str) -> Iterator[int]:
        """Ids of one segment, each committed as soon as no later character can change it."""
        n, longest, pairs, stay_apart = len(text), self.longest, self.pairs, self.stay_apart
        done = 0  # boundary up to which ids are committed; the lists begin with it
        start, last = [0], [UNCOVERED]  # by open position: where its last piece starts, and its id
        filled, full = 0, 4 * longest
        for end, (size, piece) in chain(self.matcher.iter(text) if self.scores else (), [(n, (0, UNCOVERED))]):
            if end < filled:
                continue  # the position at ``end`` + 1 has its last piece
            while filled < end:  # no piece fits
                start.append(filled)
                last.append(UNCOVERED)
                filled += 1
            before = last[end + 1 - size - done] if size else UNCOVERED
            fits = pairs.get((before, piece))
            if size and (fits or fits is None and stay_apart(before, piece)):
                start.append(end + 1 - size)
                last.append(piece)
                filled += 1
            if filled - done < full:
                continue  # the paths are compared when so many positions are open
            heads = set(range(filled - longest + 1, filled + 1))
            while len(heads) > 1:
                latest = max(heads)
                heads.discard(latest)
                heads.add(start[latest - done])
            meet = heads.pop()
            yield from self._commit(text, start, last, done, meet)
            start, last, done = start[meet - done:], last[meet - done:], meet
            full = filled - done + longest
        yield from self._commit(text, start, last, done, n)

    def _commit(self, text: str, start: list[int], last: list[int], done: int, end: int) -> list[int]:
        """Ids of the path from the last committed boundary to another one."""
        ids: list[int] = []
        while end > done:
            begin, piece = start[end - done], last[end - done]
            if piece == UNCOVERED:
                ids += self._fallback(text[begin:end])[::-1]
            else:
                ids.append(piece)
            end = begin
        return ids[::-1]

    def segment(self, part: str) -> bytes:
        """Packed ids of a segment, remembered when it is short."""
        if len(part) > SHORT:
            return np.fromiter(self.stream(part), np.int32).tobytes()
        ids = self.older.get(part)
        if ids is None:
            ids = array("i", self.stream(part)).tobytes()
        if len(self.known) >= REMEMBERED:  # keep the last two generations
            self.older = dict(self.known)
            self.known.clear()
        self.known[part] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text; a blank is put before it, an empty text has none."""
        if not text:
            return np.empty(0, np.int32)
        known, segment = self.known, self.segment
        parts = self.parts.findall(BLANK + text.replace(" ", BLANK))
        return np.frombuffer(b"".join([known.get(p) or segment(p) for p in parts]), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids, without the blank put before it."""
        whole = b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        return whole.decode("utf-8", "replace").removeprefix(" ")


@lru_cache(maxsize=2)
def codec(model: str) -> Codec:
    """The codec of a model file; each worker builds it once."""
    return Codec(model)


def _ids_array(ids: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0] + [len(x) for x in ids], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else [], pa.int32()))


def encode_column(text: Column, model: str) -> Column:
    """Array of ids; an empty array for a null or empty text."""

    @F.arrow_udf("array<int>")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(model)
        for batch in texts:
            yield _ids_array([own.encode(t.as_py() or "") for t in batch])

    return run(text)


def decode_column(ids: Column, model: str) -> Column:
    """Text of an array of ids; null for null."""

    @F.arrow_udf("string")
    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(model)
        for batch in arrays:
            flat, ends = batch.values.to_numpy(zero_copy_only=False), batch.offsets.to_numpy()
            yield pa.array([own.decode(flat[ends[i]:ends[i + 1]]) if batch[i].is_valid else None
                            for i in range(len(batch))], pa.string())

    return run(ids)


def round_trip_column(text: Column, model: str) -> Column:
    """Struct (ids, decoded): a text encoded, and its ids decoded again, by one worker."""

    @F.arrow_udf("struct<ids: array<int>, decoded: string>")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(model)
        for batch in texts:
            ids = [own.encode(t.as_py() or "") for t in batch]
            yield pa.StructArray.from_arrays(
                [_ids_array(ids), pa.array((own.decode(x) for x in ids), pa.string())], ["ids", "decoded"])

    return run(text)


def encode_documents(docs: DataFrame, model: str, text_col: str = "text") -> DataFrame:
    """Documents with ids, n_tokens and decoded added.

    ``model`` is the path of a SentencePiece model file on the workers. Null and
    empty texts have no ids and decode to an empty text. A text comes back as it
    was, but for U+2581, which decodes to a blank, and code units outside UTF-8.
    Characters that no piece covers become byte pieces where the model has them,
    else its unknown id. Input columns named as the results are replaced. An
    empty table gives an empty table.
    """
    both = docs.withColumn("__coded", round_trip_column(F.col(text_col), model))
    ids = F.col("__coded.ids")
    return replace_columns(both, {
        "ids": ids, "n_tokens": F.size(ids).cast("long"), "decoded": F.col("__coded.decoded")}).drop("__coded")
