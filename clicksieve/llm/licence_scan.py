"""Licence phrases and texts in documents, by matching statistics of one suffix automaton.

All licence texts and phrases, as words, form one generalised suffix automaton. A
text streams through it in blocks; after each word the automaton's state and length
are the longest run of words up to there that stands in some licence text. Where a
run can't be extended it is a match; a match's places in a licence text follow from
its state. A match of ``MIN_MATCH`` words or more joins the open chain of a licence
text if it stands behind the chain in both texts and at most ``MAX_GAP`` words after
it; otherwise the chain ends and the match begins the next one. The words of a chain,
over the licence text's, are its share; chains of ``MIN_SHARE`` or more are spans.
A phrase, or a whole licence text, ends where its state is a suffix of the current
one, and is a span of share 1 (short licence texts have no other).

Words are runs of characters other than ASCII ones outside a-z and 0-9, of the text
with A-Z in lower case. Results for awkward input: a null, empty or wordless text has
no words, no labels and score 0; a text of any length streams in blocks; repeated
rows have equal results; an empty table has no rows; no other column is read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from clicksieve.llm.licence_texts import PHRASES, TEMPLATES

MIN_MATCH = 6  # words of a match that counts
MAX_GAP = 20  # words of the document between two matches of a chain
MIN_SHARE = 0.5  # of a licence text that a chain must cover
BLOCK_BYTES = 1 << 20

# A-Z go to lower case first; what is left of ASCII outside a-z and 0-9 becomes a blank.
_WORDS = bytes(c if c > 0x7F or chr(c).isdigit() or 0x61 <= c <= 0x7A else 0x20 for c in range(256))

SCAN = ("struct<n_words: bigint, n_base: bigint, first_word: bigint, last_word: bigint, base_labels: array<string>, "
        "labels: array<string>, score: double, spans: array<struct<label: string, first: bigint, last: bigint, share: double>>>")


def word_blocks(data: bytes, size: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    """Words of a UTF-8 text, in blocks of about ``size`` bytes."""
    clean = data.lower().translate(_WORDS)
    start = 0
    while start < len(clean):
        end = clean.find(b" ", start + size)
        end = len(clean) if end < 0 else end
        yield clean[start:end].split()
        start = end


def _words(text: str) -> list[bytes]:
    return [w for block in word_blocks(text.encode()) for w in block]


class LicenceAutomaton:
    """Suffix automaton of several sequences of words.

    ``after`` are the transitions, ``link`` and ``size`` the suffix links and longest
    lengths; ``places`` lists (text, end) of a state's runs; ``whole`` the texts that
    are suffixes of a state, as (words, text).
    """

    def __init__(self, texts: Sequence[Sequence[bytes]]):
        self.ids: dict[bytes, int] = {}
        self.after, self.link, self.size = [{}], [-1], [0]
        ends: list[list[tuple[int, int]]] = []
        finals = []
        for k, words in enumerate(texts):
            state = 0
            for end, word in enumerate(words):
                state = self._extend(state, self.ids.setdefault(word, len(self.ids)))
                ends.extend([] for _ in range(len(self.size) - len(ends)))
                ends[state].append((k, end))
            finals.append((state, len(words), k))
        ends.extend([] for _ in range(len(self.size) - len(ends)))
        order = sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True)
        for v in order:
            if self.link[v] > 0:
                ends[self.link[v]] += ends[v]
        self.places = [sorted(set(e)) for e in ends]
        own: dict[int, list[tuple[int, int]]] = {}
        for state, n, k in finals:
            own.setdefault(state, []).append((n, k))
        self.whole: dict[int, list[tuple[int, int]]] = {}
        for v in reversed(order):
            found = [*own.get(v, []), *self.whole.get(self.link[v], [])]
            if found:
                self.whole[v] = found

    def _state(self, size: int, link: int, after: dict[int, int]) -> int:
        self.size.append(size)
        self.link.append(link)
        self.after.append(after)
        return len(self.size) - 1

    def _split(self, p: int, q: int, word: int) -> int:
        """The state of p's longest run plus ``word``, split off from q if q has longer runs."""
        if self.size[q] == self.size[p] + 1:
            return q
        clone = self._state(self.size[p] + 1, self.link[q], dict(self.after[q]))
        self.link[q] = clone
        while p >= 0 and self.after[p].get(word) == q:
            self.after[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: int) -> int:
        if word in self.after[last]:
            return self._split(last, self.after[last][word], word)
        new = self._state(self.size[last] + 1, 0, {})
        p = last
        while p >= 0 and word not in self.after[p]:
            self.after[p][word] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, self.after[p][word], word)
        return new


@dataclass
class _Chain:
    first: int = 0  # first and last word in the document
    last: int = -1
    end: int = -1  # last word in the licence text
    words: int = 0


class LicenceScanner:
    """Scans texts for phrases (their labels are the base ones) and licence texts."""

    def __init__(self, phrases: Sequence[tuple[str, str]] = PHRASES, templates: Sequence[tuple[str, str]] = TEMPLATES):
        texts = [*phrases, *templates]
        words = [_words(t) for t, _ in phrases] + [_words(t) for _, t in templates]
        self.labels = [name for _, name in phrases] + [name for name, _ in templates]
        self.sizes = [len(w) for w in words]
        self.n_base = len(phrases)
        if not all(self.sizes):
            raise ValueError(f"a licence text without words: {texts[self.sizes.index(0)]}")
        self.automaton = LicenceAutomaton(words)

    def scan(self, blocks: Iterator[list[bytes]]) -> dict:
        auto = self.automaton
        after, link, size, whole, ids = auto.after, auto.link, auto.size, auto.whole, auto.ids
        at, state, length = 0, 0, 0
        n_base, first, last, base, spans = 0, None, None, set(), []
        chains: dict[int, _Chain] = {}
        best = 0.0
        for words in blocks:
            for at, word in enumerate(map(ids.get, words), at):
                if word is None:
                    if length >= MIN_MATCH:
                        best = max(best, self._chain(chains, spans, state, length, at - 1))
                    state = length = 0
                    continue
                to = after[state].get(word)
                if to is None:
                    if length >= MIN_MATCH:
                        best = max(best, self._chain(chains, spans, state, length, at - 1))
                    while to is None and state > 0:
                        state = link[state]
                        to = after[state].get(word)
                    length = size[state]
                    if to is None:
                        continue
                state, length = to, length + 1
                if state in whole:
                    for n, k in whole[state]:
                        if n > length:
                            continue
                        best = 1.0
                        if k < self.n_base:
                            n_base, last = n_base + 1, max(last or 0, at - n + 1)
                            first = last if first is None else min(first, at - n + 1)
                            base.add(self.labels[k])
                        else:
                            spans.append((self.labels[k], at - n + 1, at, 1.0))
            at += bool(words)
        if length >= MIN_MATCH:
            best = max(best, self._chain(chains, spans, state, length, at - 1))
        for k, chain in chains.items():
            best = max(best, self._close(k, chain, spans))
        spans = sorted(set(spans), key=lambda s: (s[1], s[2], s[0], s[3]))
        return {
            "n_words": at, "n_base": n_base, "first_word": first, "last_word": last, "base_labels": sorted(base),
            "labels": sorted(base | {s[0] for s in spans}), "score": best,
            "spans": [dict(zip(("label", "first", "last", "share"), s)) for s in spans]}

    def _close(self, k: int, chain: _Chain, spans: list) -> float:
        """The share of a chain that ends, which is a span if it is large enough."""
        share = chain.words / self.sizes[k]
        if MIN_SHARE <= share < 1.0:
            spans.append((self.labels[k], chain.first, chain.last, share))
        return share

    def _chain(self, chains: dict[int, _Chain], spans: list, state: int, length: int, last: int) -> float:
        """Add a match to the chains of the licence texts it stands in; the largest share that ended."""
        ended, first = 0.0, last - length + 1
        places: dict[int, list[int]] = {}
        for k, end in self.automaton.places[state]:
            if k >= self.n_base:
                places.setdefault(k, []).append(end)
        for k, ends in places.items():
            chain = chains.get(k)
            if chain is not None and first - chain.last - 1 <= MAX_GAP:
                skip = max(0, chain.last + 1 - first)  # words that the chain has already
                fit = next((e for e in ends if e - length + 1 + skip > chain.end), None)
                if fit is not None and skip < length:
                    chain.last, chain.end, chain.words = last, fit, chain.words + length - skip
                    continue
            if chain is not None:
                ended = max(ended, self._close(k, chain, spans))
            chains[k] = _Chain(first, last, ends[0], length)
        return ended


def scan_licences(text: Column, scanner: LicenceScanner | None = None) -> Column:
    """Struct ``SCAN`` of a text: words, places of phrases, labels, score and covered spans.

    ``score`` is the largest share of a licence text that a chain covers, 1 where a
    phrase or a whole licence text stands.
    """
    scanner = scanner or LicenceScanner()
    fields = pa.struct([
        *[(c, pa.int64()) for c in ("n_words", "n_base", "first_word", "last_word")],
        ("base_labels", pa.list_(pa.string())), ("labels", pa.list_(pa.string())), ("score", pa.float64()),
        ("spans", pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("share", pa.float64())])))])

    @F.arrow_udf(SCAN)
    def scan(texts: pa.Array) -> pa.Array:
        raw = texts.cast(pa.large_binary())
        return pa.array([scanner.scan(word_blocks(t.as_py() or b"")) for t in raw], fields)

    return scan(text)
