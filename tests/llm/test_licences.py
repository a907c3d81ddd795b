"""The licence scan against searches without an automaton."""

import random
import re

from pyspark.sql import functions as F

from clicksieve.llm import licence_scan as scan
from clicksieve.llm import queries  # noqa: F401  registers the queries
from clicksieve.llm.licence_texts import PHRASES, TEMPLATES
from clicksieve.queries.base import QUERIES

from .conftest import FOLDER

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def starts(part, whole):
    return [i for i in range(len(whole) - len(part) + 1) if whole[i:i + len(part)] == part]


def slow_scan(text, phrases, templates):
    """The contract and the chains, each place searched in every licence text."""
    w = words(text)
    texts = [words(t) for t, _ in phrases] + [words(t) for _, t in templates]
    labels, n_base = [n for _, n in phrases] + [n for n, _ in templates], len(phrases)
    hits = [(i, k) for k in range(n_base) for i in starts(texts[k], w)]
    spans = {(labels[k], i, i + len(texts[k]) - 1, 1.0) for k in range(n_base, len(texts)) for i in starts(texts[k], w)}
    best = 1.0 if hits or spans else 0.0
    longest = []
    for end in range(len(w)):
        n = longest[-1] + 1 if longest else 1
        while n and not any(starts(w[end - n + 1:end + 1], t) for t in texts):
            n -= 1
        longest.append(n)
    matches = [(e, n) for e, n in enumerate(longest) if n >= scan.MIN_MATCH and (e + 1 == len(w) or longest[e + 1] != n + 1)]
    for k in range(n_base, len(texts)):
        closed, chain = [], None
        for e, n in matches:
            first = e - n + 1
            at = starts(w[first:e + 1], texts[k])
            if not at:
                continue
            if chain:
                skip = max(0, chain[1] + 1 - first)
                fit = [a for a in at if a + skip > chain[2]]
                if first - chain[1] - 1 <= scan.MAX_GAP and fit and skip < n:
                    chain = [chain[0], e, fit[0] + n - 1, chain[3] + n - skip]
                    continue
                closed.append(chain)
            chain = [first, e, at[0] + n - 1, n]
        for c in [*closed, *([chain] if chain else [])]:
            share = c[3] / len(texts[k])
            best = max(best, share)
            if scan.MIN_SHARE <= share < 1:
                spans.add((labels[k], c[0], c[1], share))
    base = {labels[k] for _, k in hits}
    return {"n_words": len(w), "n_base": len(hits), "first_word": min((i for i, _ in hits), default=None),
            "last_word": max((i for i, _ in hits), default=None), "base_labels": sorted(base),
            "labels": sorted(base | {s[0] for s in spans}), "score": best,
            "spans": sorted(spans, key=lambda s: (s[1], s[2], s[0], s[3]))}


def check(scanner, text, phrases, templates, size=1 << 20):
    got = scanner.scan(scan.word_blocks((text or "").encode(), size))
    got["spans"] = [tuple(s.values()) for s in got["spans"]]
    assert got == slow_scan(text, phrases, templates)
    return got


def test_few_words_in_many_orders(monkeypatch):
    """Small vocabularies make matches that overlap, repeat and stand in several texts."""
    monkeypatch.setattr(scan, "MIN_MATCH", 3)
    monkeypatch.setattr(scan, "MAX_GAP", 4)
    rng = random.Random(3)
    for _ in range(150):
        line = lambda n: " ".join(rng.choice("abcd") for _ in range(n))
        phrases = [(line(rng.randint(1, 4)), f"p{i}") for i in range(2)]
        templates = [(f"t{i}", line(rng.randint(1, 14))) for i in range(3)]
        scanner = scan.LicenceScanner(phrases, templates)
        for _ in range(6):
            text = " ".join(rng.choice("abcdx") if rng.random() < 0.5 else rng.choice(templates)[1] for _ in range(12))
            check(scanner, text, phrases, templates, size=rng.choice([1, 7, 1 << 20]))


def test_pieces_of_licences():
    """Licence texts with words cut out, changed and put between."""
    rng = random.Random(5)
    scanner = scan.LicenceScanner()
    for name, text in TEMPLATES:
        w = text.split()
        for cut in (0, 0.02, 0.1):
            bent = " ".join(rng.choice(["", f"{x} ZZ", "ZZ"]) if rng.random() < cut else x for x in w)
            got = check(scanner, f"Own text, {bent} And more own text.", PHRASES, TEMPLATES)
            assert cut or (name in got["labels"] and got["score"] == 1.0)
            assert cut != 0.02 or len(w) < 20 or name in got["labels"]


def test_base_columns_of_whole_tables(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op12_licence_scan"](spark, FOLDER).collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        w = words(text)
        hits = sorted((k, n) for p, n in PHRASES for k in starts(p.split(), w))
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (
            len(w), len(hits), hits[0][0] if hits else None, hits[-1][0] if hits else None)
        assert r.base_labels == ",".join(sorted({n for _, n in hits})) and 0 <= r.score <= 1
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}


def test_licences_awkward(spark, awkward, nothing):
    rows = awkward.select("doc_id", "text", scan.scan_licences(F.col("text")).alias("f")).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        assert r.f.n_words == len(words(r.text)) and r.f.labels == [] and r.f.score == 0 and r.f.first_word is None
    assert nothing.select(scan.scan_licences(F.col("text")).alias("f")).collect() == []


def test_words_next_to_other_signs(spark):
    text = "CC-BY! cc by ccby GNU\nGeneral\tPUBLIC\x00License, 3cc by; MIT.LICENSE é mitİ license"
    got = check(scan.LicenceScanner(), text, PHRASES, TEMPLATES)
    assert got["n_base"] == 3 and got["base_labels"] == ["cc-by", "gpl", "mit"]
