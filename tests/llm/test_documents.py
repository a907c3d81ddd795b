"""Operators on documents against brute force."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from clicksieve.llm import components, near_dedup
from clicksieve.llm import queries  # noqa: F401  registers the queries
from clicksieve.llm.common import keep_table
from clicksieve.llm.components import connected_components, merge_components
from clicksieve.llm.id_store import PerfectHash, Shard, fingerprints, lookup, scan_store, write_store
from clicksieve.llm.language_id import SuffixAutomaton, fit_languages, identify_language
from clicksieve.llm.line_crf import WIDTH, LineField, fit_blocks, fit_on_labels, good_lines, quality_score
from clicksieve.llm.line_dedup import drop_recurring_lines
from clicksieve.llm.mixing import mix_sources, repeat_copies
from clicksieve.llm.near_dedup import drop_near_duplicates, near_duplicates
from clicksieve.llm.quality_rules import BUCKETS, fit_ratio, judge, trusted_ids
from clicksieve.llm.repeated_windows import remove_repeated
from clicksieve.llm.sentencepiece_codec import Codec, encode_documents
from clicksieve.queries.base import QUERIES
from clicksieve.session import scratch_path

from .conftest import AWKWARD, FOLDER

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def crc_held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


# line dedup -------------------------------------------------------------------

def test_lines_with_a_varying_field_are_one_template(spark):
    base = "visit our shop number {} in the old town and ask for the new card today please"
    rows = [(i, f"own text of document {i * 37} {'abc' * (i + 1)} here\n" + base.format(("seven", "blue", "x9", "12", "green", "last")[i]))
            for i in range(6)]
    out = {r.doc_id: r for r in drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string"), min_docs=5).collect()}
    assert out[0].n_dropped == 0 and all(out[i].n_dropped == 1 for i in range(1, 6))
    assert all(out[i].text == rows[i][1].split("\n")[0] for i in range(1, 6))


def test_lines_below_the_count_and_short_lines_stay(spark):
    rows = [(i, "yes it is\n" + ("this line is in four documents only and stays there" if i < 4 else f"line {i}")) for i in range(9)]
    out = drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string"), min_docs=5)
    assert {r.doc_id: r.text for r in out.collect()} == dict(rows)


def test_rows_of_numbers_recur_by_their_text_only(spark):
    rows = [(i, "\n".join([f"201{i} 1{i}.5 13.{i} 9.2", " ".join(f"{i}{k}.5" for k in range(14)), "2019 12.5 13.1 9.2",
                           f"sum of the year {i}"])) for i in range(7)]
    out = {r.doc_id: r for r in drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string"), min_docs=5).collect()}
    assert out[0].text == rows[0][1]
    assert all(out[i].text.split("\n") == rows[i][1].split("\n")[:2] for i in range(1, 7))


def test_short_lines_recur_in_many_documents(spark):
    """Short templates need 4 times the documents, and 1% of them."""
    names = ("ann", "bob", "cyd", "dee", "eve")
    rows = [(i, "\n".join(["All rights reserved.", "Yes." if i < 19 else f"word{chr(97 + i % 26)}{chr(97 + i // 26)} x",
                           f"Posted here by {names[i % 5]}{chr(97 + i // 5)}", "", f"own {'z' * (i + 1)}"])) for i in range(50)]
    out = {r.doc_id: r for r in drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[0].text == rows[0][1]
    for i in range(1, 50):
        lines = rows[i][1].split("\n")
        assert out[i].text.split("\n") == [lines[1], "", lines[4]] and out[i].n_dropped == 2


def test_lines_equal_the_sql(spark, tmp_path):
    """Rows of numbers, short lines and open parts: the operator and its SQL on the same table."""
    duckdb = pytest.importorskip("duckdb")
    rng = np.random.default_rng(8)
    vocab = ["a", "b", "7", "x9", "the", "end"]
    rows = [(i, "\n".join(" ".join(rng.choice(vocab, rng.integers(0, 14) if rng.random() < .3 else rng.integers(0, 5)))
                          for _ in range(rng.integers(1, 9)))) for i in range(400)]
    rows += [(500 + i, "\n".join([f"201{i} 1{i}.5 13.{i} 9.2", "2019 12.5 13.1 9.2", "12 13"])) for i in range(30)]
    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    got = {(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in QUERIES["op1_line_dedup"](spark, folder).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    want = con.execute(f"SELECT doc_id, n_lines, n_dropped, text FROM ({queries.OP1_SQL})").fetchall()
    assert got == set(want) and sum(r[2] for r in want) > 300


def test_lines_awkward(spark, awkward, nothing):
    out = drop_recurring_lines(awkward, min_docs=2)
    assert out.count() == len(AWKWARD)
    rows = {(r.doc_id, r.n_dropped) for r in out.collect()}
    assert (1, 0) in rows and (7, 2) in rows and (None, 0) in rows and (2, 0) in rows
    assert drop_recurring_lines(nothing).count() == 0


# near duplicates ----------------------------------------------------------------

def brute_components(rows, width, percent=80):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(spark, texts, width):
    rng = np.random.default_rng(3)
    rows = list(texts[:80])
    for k in range(60):  # chains: each a changed copy of one before
        words = rows[-1 - int(rng.integers(0, 30))][1].split()
        for at in rng.integers(0, len(words), max(1, len(words) // 30)):
            words[at] = f"w{rng.integers(0, 9)}"
        rows.append((1000 + k, " ".join(words)))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=width).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows, width)
    assert all(r.kept == (r.id == r.component_id) for r in got)


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_in_one_large_group(spark, monkeypatch, seed):
    """Changed copies of one text, many of them just below the similarity, with every mixed bucket searched as a large one."""
    monkeypatch.setattr(near_dedup, "SMALL", 1)
    rng = np.random.default_rng(seed)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for k in range(160):
        words = list(base)
        for at in rng.integers(0, len(words), int(rng.integers(0, 16))):
            words[at] = f"x{rng.integers(0, 40)}"
        if k % 9 == 0:
            words = words[:int(rng.integers(110, 150))]
        rows.append((k, " ".join(words)))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=2).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows, 2)


def test_near_duplicates_awkward(spark, awkward, nothing):
    got = near_duplicates(awkward, width=2).collect()
    assert len(got) == len(AWKWARD)
    by_id = defaultdict(list)
    for r in got:
        by_id[r.id].append(r)
    assert [r.component_id for r in by_id[7]] == [1] and not by_id[7][0].kept and by_id[6][0].component_id == 5
    assert [r.n_shingles for r in by_id[2] + by_id[3] + by_id[4]] == [0, 0, 0] and by_id[None][0].kept
    assert near_duplicates(nothing).count() == 0
    kept = drop_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    left = Counter((r.doc_id, r.text) for r in kept.select("doc_id", "text").collect())
    assert left[(9, "x")] == left[(9, "y")] == 1 and left[AWKWARD[0][:2]] == 2 and (7, AWKWARD[0][1]) not in left
    again = spark.createDataFrame([(1, "a b"), (9, "a b"), (9, "c d")], "doc_id long, text string")
    assert sorted(drop_near_duplicates(again, width=2).collect()) == [(1, "a b"), (9, "c d")]


def test_components_of_a_long_chain(spark):
    n = 300
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001), (5, 5)], "a long, b long")
    groups = defaultdict(set)
    for r in connected_components(links).collect():
        groups[r.label].add(r.node)
    assert sorted(map(len, groups.values())) == [2, n + 1]


def test_links_are_gone_through_once(spark, monkeypatch):
    """Links of a large group are one row each, and later ones do not take the first through the rounds again."""
    rows = Counter()

    def counted(df, name):
        out = keep_table(df, name)
        rows[name] += out.count()
        return out

    monkeypatch.setattr(components, "keep_table", counted)
    monkeypatch.setattr(near_dedup, "keep_table", counted)
    monkeypatch.setattr(near_dedup, "SMALL", 1)
    rng = np.random.default_rng(5)
    texts = []
    for k in range(200):
        words = [f"w{i}" for i in range(120)]
        for at in rng.integers(0, 120, int(rng.integers(1, 9))):
            words[at] = f"x{rng.integers(0, 10 ** 6)}"
        texts.append((k, " ".join(words)))
    got = near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), width=2).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == brute_components(texts, 2)
    assert 1000 < rows["links"] < 1.1 * rows["confirmed"]


def changed_copies(n, seed=7):
    """Copies of one text with up to 12 of 120 words changed, some changes in many copies."""
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        words = [f"w{i}" for i in range(120)]
        for at in rng.integers(0, 120, int(rng.integers(0, 13))):
            words[at] = f"x{rng.integers(0, 10 if rng.random() < .2 else 10 ** 6)}"
        rows.append((k, " ".join(words)))
    return rows


def test_search_across_components_lists_few_pairs(spark, monkeypatch):
    """Far copies are not set against all near ones: pairs grow with the nodes, not with their square."""
    listed, far = [], near_dedup._far_pairs

    def counted(*args):
        out = far(*args)
        listed.append(out.distinct().count())
        return out

    monkeypatch.setattr(near_dedup, "_far_pairs", counted)
    monkeypatch.setattr(near_dedup, "SMALL", 1)
    for n in (100, 300):
        rows = changed_copies(n)
        got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=2).collect()
        assert {r.id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows, 2)
    print("pairs", listed)
    assert listed[1] <= 300 and listed[0] <= 100


def test_merged_components(spark):
    """Further links: within a component, between two, to new nodes, between new nodes, of a node with itself."""
    first = [(1, 2), (2, 3), (3, 1), (10, 11), (20, 21), (30, 31)]
    more = [(1, 3), (11, 2), (2, 11), (21, 40), (50, 51), (51, 52), (60, 60)]
    frame = lambda rows: spark.createDataFrame(rows, "a long, b long")
    for start in (first, []):
        groups = defaultdict(set)
        for r in merge_components(connected_components(frame(start)), frame(more)).collect():
            assert r.node not in groups[r.label]
            groups[r.label].add(r.node)
        want = [{1, 2, 3, 10, 11}, {20, 21, 40}, {30, 31}, {50, 51, 52}] if start else [{1, 3}, {2, 11}, {21, 40}, {50, 51, 52}]
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want))


# repeated windows -----------------------------------------------------------------

def brute_windows(rows, depth=50):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - depth + 1):
            w = b[k:k + depth]
            if w not in first or i < first[w]:
                first[w] = i
    out = {}
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, int)
        for k in range(len(b) - depth + 1):
            if first[b[k:k + depth]] < i:
                gone[k] += 1
                gone[k + depth if k + depth <= len(b) else len(b)] -= 1
        g = np.cumsum(gone)[:-1] > 0
        kept = bytes(np.frombuffer(b, np.uint8)[~g])
        out[i] = (len(b), int(g.sum()), int((np.diff(g.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def test_repeated_windows(spark, texts):
    rng = np.random.default_rng(5)
    rows = list(texts)
    pool = "".join(t for _, t in texts[:40])
    for k in range(80):  # passages from everywhere, cut at any byte, with edits
        parts = []
        for _ in range(int(rng.integers(1, 6))):
            a = int(rng.integers(0, len(pool) - 400))
            parts.append(pool[a:a + int(rng.integers(30, 400))])
            parts.append("".join(chr(int(c)) for c in rng.integers(97, 123, int(rng.integers(0, 4)))))
        rows.append((2000 + k, "".join(parts)))
    rows += [(3000, "a" * 400), (3001, "ab" * 300), (3002, "a" * 49), (3003, "a" * 50), (3004, "b" + "a" * 50 + "c"), (3005, None)]
    got = remove_repeated(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    assert {r.id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got} == brute_windows(rows)


def test_repeated_windows_awkward(spark, awkward, nothing):
    got = remove_repeated(awkward).collect()
    assert len(got) == len(AWKWARD)
    removed = Counter((r.id, r.n_removed) for r in got)
    assert removed[(1, 0)] == 2 and removed[(None, 0)] == 1
    assert next(r for r in got if r.id == 7).n_removed == len(AWKWARD[0][1])
    six = next(r for r in got if r.id == 6)
    assert (six.n_removed, bytes(six.kept)) == (len(AWKWARD[5][1]), b"end")
    assert remove_repeated(nothing).count() == 0


# languages -----------------------------------------------------------------------

def test_automaton_counts_longest_matches():
    text = " ein haus ein hausboot "
    automaton = SuffixAutomaton(text)
    for word in (" haus ", " hausboot ", " boothaus ", " xyz ", " ein "):
        count, at = 0, 0
        while at < len(word):
            n = max([k for k in range(1, len(word) - at + 1) if word[at:at + k] in text], default=1)
            at += n
            count += 1
        assert automaton.phrases(word) == count, word




def test_language_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = QUERIES["op4_language_id"](spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert all(r.held_out == crc_held(r.doc_id) for r in got)
    judged = [r for r in got if r.held_out and r.lang]
    assert sum(r.lang_pred == r.lang for r in judged) / len(judged) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_awkward(spark, awkward, nothing):
    model = fit_languages(awkward)
    got = {(r.doc_id, r.text): r.found.lang for r in awkward.select("doc_id", "text", identify_language(F.col("text"), model).alias("found")).collect()}
    assert got[(2, None)] == got[(3, "")] == got[(10, "1234 5678")] == "und"
    none = fit_languages(nothing)
    assert awkward.select(identify_language(F.col("text"), none)["lang"].alias("l")).distinct().collect()[0].l == "und"


def test_language_of_long_documents_only(spark):
    """Long texts and such behind many empty ones are learned from like others."""
    words = {"aa": ["kolo", "moko", "loko", "komo"], "bb": ["sitz", "titz", "zist", "tisz"], "cc": ["brar", "arbr", "rabr", "barb"]}
    rows = [(i, " ".join(words["aa"][(i + k) % 4] for k in range(30)), "aa") for i in range(60)]
    rows += [(100 + i, " ".join(words["bb"][(i * k) % 4] for k in range(6000)), "bb") for i in range(6)]
    rows += [(200 + i, None if i % 2 else "12 34", "cc") for i in range(1500)]
    rows += [(2000 + i, " ".join(words["cc"][(i + k) % 4] for k in range(30)), "cc") for i in range(4)]
    rows += [(3000 + i, "x" * 150_000, "dd") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit_languages(docs)
    assert model.languages == ("aa", "bb", "cc", "dd")
    assert all(0 < len(w) <= 100_000 for w in model.words) and all(0 < r <= 1 for r in model.own_rate)
    found = docs.select("lang", "text", identify_language(F.col("text"), model)["lang"].alias("got")).collect()
    assert all(r.got == r.lang for r in found if re.search("[a-z]", r.text or ""))


# mixing ---------------------------------------------------------------------------

def test_mixing(spark, texts):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = QUERIES["op5_mixing"](spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "source", "text"), "doc_id").collect()
    words = defaultdict(int)
    for r in got:
        assert r.size == len(WORD.findall(r.text or ""))
        words[r.source] += r.size
    order = sorted(words, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, free, left = {}, set(order), 1.5 * sum(words.values())
    while True:  # reshare what is above
        level = left / sum(weight[s] for s in free)
        above = {s for s in free if level * weight[s] > 2 * words[s]}
        if not above:
            break
        target.update({s: 2.0 * words[s] for s in above})
        left -= sum(2 * words[s] for s in above)
        free -= above
    target.update({s: level * weight[s] for s in free})
    taken, most = defaultdict(int), defaultdict(int)
    for r in got:
        assert math.isclose(r.target, target[r.source], rel_tol=1e-9) and r.source_size == words[r.source]
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
        most[r.source] = max(most[r.source], r.size)
    assert all(abs(taken[s] - target[s]) <= most[s] + 1 for s in order)
    again = QUERIES["op5_mixing"](spark, "/root/testdata/sf0.01").select("doc_id", "taken").collect()
    assert {r.doc_id: r.taken for r in again} == {r.doc_id: r.taken for r in got}


def dense_tilt(sizes, target, ceiling=2.0):
    """Rates of one source by bisection on the tilt, all documents in one array."""
    z = sizes / sizes[sizes > 0].mean()
    low, high = -1e4, 1e4
    with np.errstate(over="ignore"):
        rates = lambda tilt: np.where(sizes > 0, ceiling / (1 + np.exp(-tilt * z)), 0.0)
        for _ in range(200):
            middle = (low + high) / 2
            low, high = (middle, high) if (rates(middle) * sizes).sum() < target else (low, middle)
        return rates(low)


def test_mixing_rates_equal_a_dense_solver(spark):
    rng = np.random.default_rng(5)
    rows = [(k, " ".join(["w"] * int(n)), "abc"[k % 3]) for k, n in enumerate(rng.lognormal(3, 1.2, 900))]
    rows += [(1000, "w " * 60_000, "a"), (1001, "", "a"), (1002, None, "b"), (1003, "w " * 20_000, "c")]
    got = mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights=(1, 5, 3), share=1.2).collect()
    for source in "abc":
        own = sorted((r for r in got if r.source == source), key=lambda r: r.doc_id)
        sizes = np.array([float(r.size) for r in own])
        want = dense_tilt(sizes, own[0].target)
        assert np.allclose([r.rate for r in own], want, atol=1e-6)
        if own[0].target < 1.99 * sizes.sum():
            assert len({round(r.rate, 4) for r in own if r.size}) > 10
        assert abs(sum(r.taken for r in own) - own[0].target) <= sizes.max() + 1
        assert all(r.copies <= 2 for r in own)


def test_mixing_awkward(spark, awkward, nothing):
    got = mix_sources(awkward)
    assert got.count() == len(AWKWARD) and got.filter("taken > 2 * size").count() == 0
    assert repeat_copies(got).count() == got.agg(F.sum("copies")).first()[0]
    assert mix_sources(nothing).count() == 0


# quality rules -----------------------------------------------------------------------

def brute_rules(text):
    text = text or ""
    w = WORD.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    often = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(5)}
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


def test_quality_rules(spark, awkward):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    good = {r.doc_id for r in labels.filter("quality = 1").collect()}
    rows = docs.collect()
    grams = {}
    for r in rows:
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in WORD.findall(r.text)]
        pair = [xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42)) for a, b in zip(h, h[1:])]
        grams[r.doc_id] = [x % BUCKETS for x in h + pair]
    raw = np.bincount(sum(grams.values(), []), minlength=BUCKETS) + 1.0
    mine = np.bincount(sum((g for i, g in grams.items() if i in good), []), minlength=BUCKETS) + 1.0
    ratio = np.log(mine / mine.sum()) - np.log(raw / raw.sum())
    assert np.allclose(fit_ratio(docs, trusted_ids(labels)), ratio)
    got = judge(docs.unionByName(awkward.select(docs.columns)), ratio)
    for r in got.collect():
        want = brute_rules(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, r.doc_id
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.kept and r.base_failed)
    scores = {r.doc_id: r.ratio_score for r in judge(docs, ratio).collect()}
    for i, g in grams.items():
        assert math.isclose(scores[i], ratio[g].mean() if g else 0.0, abs_tol=1e-4)


def test_quality_rules_empty(spark, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert judge(nothing, fit_ratio(nothing, trusted_ids(labels))).count() == 0


# SentencePiece -----------------------------------------------------------------------

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_ids_equal_the_library(texts):
    """Whole texts, blanks in rows, line ends and characters without a piece."""
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    own = Codec(MODEL)
    odd = ["", " ", "  a  b ", "\n\n x\n", "\U0001f600\x00\u200b", "日本語" * 40, "\u0301e\u0301", "a" * 500, "ab" * 300 + "\U0001f600", "== ==="]
    for t in [t for _, t in texts] + odd:
        ids = own.encode(t)
        assert ids.tolist() == library.encode(t), t[:60]
        assert own.decode(ids) == t


def test_long_segment_streams():
    """Ids of one long segment are committed on the way, and equal the library's."""
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    own = Codec(MODEL)
    rng = np.random.default_rng(4)
    letters = "".join(rng.choice(list("etaoinshrdlu日本\U0001f600"), 20_000))
    for text in ("thequickbrownfox" * 3000 + "日本語" * 500, letters):
        committed = []
        commit = own._commit
        own._commit = lambda text, start, last, done, end: committed.append(end - done) or commit(text, start, last, done, end)
        ids = list(own.stream("▁" + text))
        own._commit = commit
        assert ids == library.encode(text)
        assert len(committed) > 100 and max(committed) < 50 * own.longest


def test_encode_awkward(spark, awkward, nothing):
    got = encode_documents(awkward, MODEL).collect()
    for r in got:
        assert r.decoded == (r.text or "").replace("▁", " ") and r.n_tokens == len(r.ids)
    assert encode_documents(nothing, MODEL).count() == 0


# id store ----------------------------------------------------------------------------

def test_perfect_hash():
    for n in (0, 1, 2, 3, 100, 5000):
        keys = np.random.default_rng(n).choice(1 << 62, n, replace=False).astype(np.uint64)
        mph = PerfectHash.build(keys)
        if n:
            assert sorted(mph.slots(keys)) == list(range(n)) and len(set(fingerprints(keys))) > n * 0.99


def test_store(spark, texts, awkward):
    from tokenizers import Tokenizer

    model = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(model)
    odd = [(900, "don't. can't, it's! ab-. 'tis, 12.5% a1. É, naïve; <|endoftext|>. A<|startoftext|> K. \x1c. <| a. a|> a世. ²."),
           (901, "<|ENDOFTEXT|> <|endoftext|>THE <|Endoftext|>"), (902, "The the THE. thE, tHE!")]
    docs = spark.createDataFrame([*texts, *odd], "doc_id long, text string").repartition(5).union(awkward.select("doc_id", "text"))
    path = scratch_path(spark, "store-test")
    write_store(docs, path, model)
    rows = docs.collect()
    ids = {(r.doc_id, r.text): plain.encode(r.text or "", add_special_tokens=False).ids + [2] for r in rows}
    got = scan_store(spark, path).collect()
    assert len(got) == len(rows)
    want = Counter((r.doc_id, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for r in rows for x in [ids[(r.doc_id, r.text)]])
    assert Counter((r.id, r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    keys = [r.id for r in sorted(got, key=lambda r: r.start)]
    assert keys == sorted(keys, key=lambda k: (k is not None, k))
    asked = spark.createDataFrame([(3,), (17,), (9,), (123456789,), (None,)], "doc_id long")
    found = Counter((r.id, tuple(r.ids)) for r in lookup(asked, path).collect())
    assert found == Counter((i, tuple(x)) for r in rows for i, x in [(r.doc_id, ids[(r.doc_id, r.text)])] if i in (3, 17, 9))


def test_empty_store(spark, nothing):
    path = scratch_path(spark, "store-test")
    write_store(nothing, path, public_tokenizers.path("word_bpe_49k.json"))
    assert scan_store(spark, path).count() == 0


# quality classifier --------------------------------------------------------------------

def test_classifier_on_held_out_documents(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = QUERIES["op10_quality_classifier"](spark, "/root/testdata/sf0.1").join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == crc_held(r.doc_id) and r.predicted == int(r.score >= 0.3) for r in got)
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.95


def test_marginals_equal_all_labelings():
    """Forward-backward of short chains against the sum over every labeling."""
    rng = np.random.default_rng(6)
    for n in range(1, 7):
        field = LineField(np.zeros(WIDTH), np.ones(WIDTH), rng.normal(0, .6, 3 * WIDTH + 1), rng.normal(0, 1, (2, 2)))
        x = rng.normal(0, 1, (n, WIDTH))
        padded = np.vstack([np.zeros(WIDTH), x, np.zeros(WIDTH)])
        evidence = [np.concatenate([padded[k + 1], padded[k], padded[k + 2], [1.0]]) @ field.weights for k in range(n)]
        good, total = np.zeros(n), 0.0
        for labels in itertools.product((0, 1), repeat=n):
            mass = math.exp(sum(e for e, y in zip(evidence, labels) if y)
                            + sum(field.trans[a, b] for a, b in zip(labels, labels[1:])))
            good += mass * np.array(labels)
            total += mass
        assert np.allclose(1 / (1 + np.exp(-field.line_odds(x))), good / total)


def test_fit_learns_from_long_documents(spark):
    """Labelled documents of thousands of lines, spam only at their ends: no document is left out, and no prefix taken."""
    fine = "the quiet river runs below the old mill and the fields"
    rows = [(i, "\n".join([fine] * 6000 if i % 2 else [fine] * 3000 + ["$$$ buy buy buy ### |||"] * 3000)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    field = fit_on_labels(docs, labels)
    assert field.score("$$$ buy buy buy ### |||\n" * 3) < 0.3 < field.score(fine)
    blocks = fit_blocks(np.arange(6000.0).reshape(-1, 1))
    assert sum(map(len, blocks)) == 128 and blocks[0][0] == 0 and blocks[-1][-1] == 5999
    assert len(fit_blocks(np.zeros((128, 1)))) == 1


def test_classifier_awkward(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 1), (5, 0), (7, None), (None, 1), (6, 0), (6, 1)], "doc_id long, quality int")
    field = fit_on_labels(awkward, labels)
    scored = awkward.select(quality_score(F.col("text"), field).alias("s"), good_lines(F.col("text"), field).alias("g"))
    assert all(0 <= r.s <= 1 and len(r.g) >= 1 for r in scored.collect())
    blank = fit_on_labels(nothing, labels)
    assert {r.s for r in awkward.select(quality_score(F.col("text"), blank).alias("s")).collect()} == {0.5}
