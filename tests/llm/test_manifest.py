"""The Merkle manifest against a recursive version."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from clicksieve.llm.merkle_manifest import audit, build_manifest, fold, leaf_digest, siblings_digest

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string, digest string, tree string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def tree(leaves):
    """(root, [segments of each leaf, from the bottom up])"""
    paths, spots, nodes = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(nodes) > 1:
        for i, at in enumerate(spots):
            run = nodes[at // 16 * 16: at // 16 * 16 + 16]
            paths[i].append(("".join(run[:at % 16]), "".join(run[at % 16 + 1:])))
        nodes = [H(*nodes[k:k + 16]) for k in range(0, len(nodes), 16)]
        spots = [at // 16 for at in spots]
    return nodes[0], paths


def expected(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        group = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees.append((group, *tree([leaf(*r) for r in group])))
    root, tops = tree([t[1] for t in trees])
    for (group, subroot, paths), top in zip(trees, tops):
        for r, path in zip(group, paths):
            segments = [*path, *top]
            bent = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and bent is not None:
                bent = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in bent)
            acc = leaf(*r[:4], bent)
            for left, right in segments:
                acc = H(left, acc, right)
            proof = H(*[x for s in segments for x in s])
            yield r[0], leaf(*r), subroot, root, proof, acc, acc == root


def result(df):
    cols = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in df.select(cols).collect()), key=repr)


@pytest.mark.parametrize("sizes", [[1], [16], [17, 1, 257], [2] * 18, [300, 33, 16, 15, 1]])
def test_trees_of_all_shapes(spark, sizes):
    rng = random.Random(7)
    rows = [(i * 10 + k, f"s{i}" if i else None, rng.choice(["en", None, "é"]), rng.choice([None, k]), rng.choice([None, "", "Ünï TEXT", f"Text {k}"]))
            for i, n in enumerate(sizes) for k in rng.sample(range(n), n)]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    assert result(audit(docs)) == sorted(expected(rows), key=repr)


def test_manifest_awkward(spark, awkward, nothing):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in awkward.collect()]
    assert result(audit(awkward)) == sorted(expected(rows), key=repr)
    assert audit(nothing).collect() == []


def test_proofs_of_some_leaves(spark):
    """Requests for a few leaves descend alone, and a changed leaf does not lead to the root."""
    rows = [(k, f"s{k % 3}", "en", 1, f"t{k}") for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string")
    made = build_manifest(docs.select(F.col("source").alias("group"), F.col("doc_id").alias("key"), leaf_digest(
        [F.col(c) for c in docs.columns]).alias("leaf")))
    root = made.root()
    got = made.proofs(made.leaves.filter(F.col("key") % 97 == 0)).select(
        "key", "leaf", "found", fold(F.col("leaf"), F.col("path")).alias("own"), fold(F.lit("0" * 64), F.col("path")).alias("other"),
        siblings_digest(F.col("path")).alias("proof")).collect()
    want = {w[0]: w for w in expected(rows)}
    assert sorted(r.key for r in got) == [0, 97, 194, 291, 388]
    assert all(r.found == r.leaf and r.own == root != r.other and r.proof == want[r.key][4] for r in got)
    repeated = made.groups.records(1).groupBy("digest").count().filter("count > 1")
    assert repeated.count() == 0
