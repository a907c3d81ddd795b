"""Language identification by cross-parsing entropy.

For each language a suffix automaton holds all substrings of its labelled words.
A text is parsed against it: from each position the longest substring that the
automaton knows is one phrase (or a single character it does not know), and the
next phrase starts behind it. Texts in the automaton's language need few, long
phrases. The count per character, divided by what labelled texts of the language
itself need, is the language's normalised number of phrases; the least one wins.

Phrases stay inside a word and the blanks around it, so a word always costs the
same and a worker remembers its counts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import zip_longest

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicksieve.llm.common import held_out

SAMPLE_DOCS = 240  # labelled documents per language a fit may read, by least hash of their id
SAMPLE_CHARS = 100_000  # distinct words per language are learned up to so many characters
REMEMBERED = 300_000  # words a worker remembers
UNKNOWN = "und"  # fixed value

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters, in lower case, with a blank on either side."""
    return [f" {w} " for w in _WORD.findall((text or "").lower()) if any(map(str.isalpha, w))]


class SuffixAutomaton:
    """Smallest automaton of all substrings of a text."""

    def __init__(self, text: str):
        self.next: list[dict[str, int]] = [{}]
        link, length, last = [-1], [0], 0
        for char in text:
            new = len(length)
            self.next.append({})
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p >= 0 and char not in self.next[p]:
                self.next[p][char] = new
                p = link[p]
            if p >= 0:
                q = self.next[p][char]
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    split = len(length)
                    self.next.append(dict(self.next[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and self.next[p].get(char) == q:
                        self.next[p][char] = split
                        p = link[p]
                    link[q] = link[new] = split
            last = new

    def phrases(self, text: str) -> int:
        """Number of longest matches, one after the other, that cover a text."""
        step, state, count = self.next, 0, 0
        for char in text:
            to = step[state].get(char)
            if to is None:
                count += state != 0
                to = step[0].get(char)
                if to is None:
                    count += 1
                    to = 0
            state = to
        return count + (state != 0)


@dataclass(frozen=True)
class LanguageModel:
    """Labelled words per language, and the phrases per character its own texts need."""

    languages: tuple[str, ...]
    words: tuple[str, ...]
    own_rate: tuple[float, ...]


@dataclass
class Identifier:
    """Automata of a model and the counts of the words met so far."""

    model: LanguageModel
    known: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.automata = [SuffixAutomaton(w) for w in self.model.words]
        self.counts = np.zeros((1024, len(self.automata)), np.int32)
        self.rates = np.array(self.model.own_rate)

    def identify(self, text: str | None) -> tuple[str, float]:
        words = words_of(text)
        if not words or not self.automata:
            return UNKNOWN, 0.0
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for w in set(words).difference(known):
            at = len(known)
            if at == len(self.counts):
                self.counts = np.vstack([self.counts, np.zeros_like(self.counts)])
            self.counts[at] = [a.phrases(w) for a in self.automata]
            known[w] = at
        total = self.counts[np.fromiter(map(known.__getitem__, words), np.int64, len(words))].sum(0, dtype=np.int64)
        need = total / self.rates
        best = int(np.argmin(need))
        if len(need) == 1:
            return self.model.languages[0], 1.0
        second = np.partition(need, 1)[1]
        return self.model.languages[best], float(1.0 - need[best] / second)


def leading_words(text: str | None, chars: int) -> list[tuple[str, int]]:
    """Distinct words of a text with their counts, first ones first, up to so many characters."""
    out = []
    for word, n in Counter(words_of(text)).items():
        if chars <= 0:
            break
        out.append((word[:chars], n))
        chars -= len(word)
    return out


def learn_language(docs: list[list[tuple[str, int]]], chars: int) -> tuple[str, float]:
    """Words to learn and the own rate, of documents as words with counts.

    The documents that are learned from take turns with their words, so that
    no long one fills the budget alone.
    """
    learn: set[str] = set()
    turns = zip_longest(*[d for k, d in enumerate(docs) if k % 3 or len(docs) < 3])
    for word, _ in (entry for turn in turns for entry in turn if entry):
        if chars > 0 and word not in learn:
            learn.add(word[:chars])
            chars -= len(word)
    text = "".join(sorted(learn))
    automaton = SuffixAutomaton(text)
    check = [entry for k, d in enumerate(docs) if not k % 3 or len(docs) < 3 for entry in d]
    return text, sum(n * automaton.phrases(w) for w, n in check) / sum(n * len(w) for w, n in check)


def fit_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> LanguageModel:
    """Model of the labelled, not held-out documents.

    Reads at most ``sample_docs`` documents with letters of a language, of any
    length, those with the least hashes of their ids. Two thirds of them go into
    the automaton, as distinct words of ``sample_chars`` characters together; the
    others measure the language's own rate, each by its first distinct words up
    to as many characters. Every label with letters is learned. A language is
    fitted in one task; the driver holds the words to learn.
    """
    letters = F.col(text_col).rlike(r"[\p{L}\p{Cn}]")  # Cn: letters that Java does not know yet
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)) & letters)
    counts = rows.groupBy(F.col(lang_col).alias("lang")).agg(F.count("*").alias("n"))
    unit = F.pmod(F.xxhash64(F.col(id_col), F.lit(9)), F.lit(1 << 30)) / F.lit(float(1 << 30))

    @F.arrow_udf("array<struct<word: string, n: bigint>>")
    def counted(texts: pa.Array) -> pa.Array:
        return pa.array([[{"word": w, "n": n} for w, n in leading_words(t.as_py(), sample_chars)] for t in texts],
                        pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())])))

    once = counted.asNondeterministic()  # else the filter on words moves below the join, to all documents

    def fit(group: pa.Table) -> pa.Table:
        own = sorted(group.select(["rank", "words"]).to_pylist(), key=lambda r: r["rank"])
        text, rate = learn_language([[(e["word"], e["n"]) for e in r["words"]] for r in own], sample_chars)
        return pa.table({"lang": group["lang"][:1], "text": pa.array([text]), "rate": pa.array([rate])})

    # about twice the documents wanted pass by their hash, then the least are taken
    picked = rows.select(F.col(lang_col).alias("lang"), unit.alias("at"), F.col(id_col).alias("id"), F.col(text_col).alias("text")) \
        .join(F.broadcast(counts), "lang").filter(F.col("at") * F.col("n") < 2 * sample_docs + 20) \
        .select("lang", "at", "id", once("text").alias("words")).filter(F.size("words") > 0)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("at", "id"))
    fitted = picked.withColumn("rank", rank).filter(F.col("rank") <= sample_docs).select("lang", "rank", "words") \
        .groupBy("lang").applyInArrow(fit, "lang string, text string, rate double").collect()
    fitted.sort(key=lambda r: r.lang)
    return LanguageModel(tuple(r.lang for r in fitted), tuple(r.text for r in fitted), tuple(r.rate for r in fitted))


_READY: dict[LanguageModel, Identifier] = {}


def identify_language(text: Column, model: LanguageModel) -> Column:
    """Struct (lang, score) of each text.

    ``und`` with score 0 for a null text and one without a letter, or when no
    language was learned. The score is the margin: 1 less the ratio of the least
    to the second least normalised number of phrases.
    """
    sent = model

    @F.arrow_udf("struct<lang: string, score: double>")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if sent not in _READY:
            _READY.clear()
            _READY[sent] = Identifier(sent)
        own = _READY[sent]
        for batch in texts:
            found = [own.identify(t.as_py()) for t in batch]
            yield pa.StructArray.from_arrays([
                pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], ["lang", "score"])

    return run(text)
