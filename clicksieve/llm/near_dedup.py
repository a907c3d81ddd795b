"""Near-duplicate documents by b-bit MinHash.

A document is the set of its distinct word shingles, hashed to 64 bits. Minima
under ``BANDS * ROWS`` hash functions give its sketch: each band of ``ROWS`` full
minima hashes to a bucket key, and the low ``BITS`` bits of every minimum are
packed into bit planes. Documents that share a bucket are candidates; comparing
bit planes by bit counts gives their similarity once the chance agreement of
2^-BITS is taken off, and pairs well below the threshold go. All others are
confirmed on their full sets, so a link is exact.

No bucket is expanded into all its pairs. Documents of one set are one node. In
each bucket every node is first compared with one node picked at random, which
makes a star; the links found are contracted to components. Then only buckets
that still hold nodes of several components are searched again, for pairs across
components, since pairs within one can add nothing to the result. In a bucket of
more than ``SMALL`` nodes these are not listed either: see ``_far_pairs``.

At similarity 0.8, a pair shares no bucket with probability (1 - 0.8^6)^48, below
1e-6; the margin of the estimate is six standard deviations.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicksieve.llm.common import keep_table, replace_columns
from clicksieve.llm.components import connected_components, merge_components

BANDS, ROWS, BITS = 48, 6, 2
SMALL = 8  # nodes of a bucket whose pairs are listed, 28 at most
CENTRES = 6  # nodes of a component, and of its buckets, in a reference
CHUNK = 1 << 16  # shingles hashed together
WORD_CACHE = 200_000  # word hashes a worker remembers


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit (multiply and shift rounds)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Distinct shingle hashes of texts; ``width`` words make a shingle."""

    def __init__(self, width: int):
        self.width = width
        self.known: dict[bytes, int] = {}

    def words(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII blanks only
        known = self.known
        if len(known) > WORD_CACHE:
            known.clear()
        for w in set(words).difference(known):
            known[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes; fewer words than a shingle needs are one together."""
        w = self.words(text or "")
        if not len(w):
            return w
        span = min(self.width, len(w))
        h = np.full(len(w) - span + 1, span, np.uint64)
        for i in range(span):
            h = _mix(h + w[i:len(w) - span + 1 + i])
        return np.unique(h)


def _name(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _sketch(sets: list[np.ndarray], bands: int, rows: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket keys (documents x bands) and bit planes (documents x bits * words) of non-empty sets."""
    perms = bands * rows
    rng = np.random.default_rng(7)
    odd = rng.integers(0, 1 << 63, perms, np.uint64) * np.uint64(2) + np.uint64(1)
    turn = rng.integers(0, 1 << 63, perms, np.uint64)
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    minima = np.empty((len(sets), perms), np.uint64)
    for k in range(perms):
        minima[:, k] = np.minimum.reduceat((flat ^ turn[k]) * odd[k], starts)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sets), bands)).copy()
    for r in range(rows):
        keys = _mix(keys + minima[:, r::rows])
    planes = []
    for bit in range(bits):
        low = np.zeros((len(sets), -(-perms // 64) * 64), np.uint8)
        low[:, :perms] = (minima >> np.uint64(bit)).astype(np.uint8) & 1
        planes.append(np.packbits(low, axis=1, bitorder="little").view(np.int64))
    return keys.view(np.int64), np.concatenate(planes, axis=1)


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int,
             bands: int = BANDS, rows: int = ROWS, bits: int = BITS) -> DataFrame:
    """(id, text_hash, n, node, keys, planes) per document; node is a digest of the set, null when it is empty."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)

        def emit(ids, hashes, sets):
            full = [i for i, s in enumerate(sets) if len(s)]
            keys, planes = _sketch([sets[i] for i in full], bands, rows, bits) if full else ((), ())
            at = {i: k for k, i in enumerate(full)}
            of = lambda values: pa.array([values[at[i]] if i in at else None for i in range(len(sets))], pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([
                ids, hashes, pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_name(s) if len(s) else None for s in sets], pa.binary()), of(keys), of(planes),
            ], ["id", "text_hash", "n", "node", "keys", "planes"])

        for batch in batches:
            ids, hashes, texts = batch.columns
            start, sets, held = 0, [], 0
            for i, text in enumerate(texts):
                sets.append(shingler.shingles(text.as_py()))
                held += len(sets[-1])
                if held >= CHUNK:
                    yield emit(ids.slice(start, len(sets)), hashes.slice(start, len(sets)), sets)
                    start, sets, held = i + 1, [], 0
            if sets:
                yield emit(ids.slice(start, len(sets)), hashes.slice(start, len(sets)), sets)

    return docs.select(F.col(id_col).alias("id"), text_hash(text_col), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {id_type}, text_hash long, n long, node binary, keys array<long>, planes array<long>")


def text_hash(text_col: str) -> Column:
    """Tells rows apart that share an id; null and empty texts differ."""
    return F.xxhash64(F.col(text_col)).alias("text_hash")


def estimate(a: Column, b: Column, perms: int, bits: int) -> Column:
    """Similarity from two stacks of bit planes, chance agreement taken off."""
    words = -(-perms // 64)
    differ = []
    for w in range(words):
        bit = F.lit(0).cast("long")
        for plane in range(bits):
            bit = bit.bitwiseOR(a[plane * words + w].bitwiseXOR(b[plane * words + w]))
        differ.append(F.bit_count(bit))
    agree = 1 - sum(differ[1:], differ[0]) / F.lit(float(perms))
    return (agree - 2.0 ** -bits) / (1 - 2.0 ** -bits)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                a, b = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], ["a", "b"])

    left = sets.select(F.col("node").alias("a"), F.col("set").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("set").alias("sb"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "sa", "sb") \
        .mapInArrow(run, "a binary, b binary")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    percent: int = 80) -> DataFrame:
    """(id, text_hash, n_shingles, component_id, kept) per row of ``docs``.

    Documents are linked when ``100 * intersection >= percent * union`` of their
    shingle sets; a component is what links reach, named by its smallest id, and
    that document is kept. Words are lower-cased in A-Z and end at ASCII blanks; a
    text with fewer words than ``width`` is one shingle. Null, empty and blank
    texts have an empty set and are linked with nothing. Rows with a null id are
    kept, with a null component. Rows that share an id are kept or dropped each by
    its own text. An empty table gives an empty table.
    """
    perms = BANDS * ROWS
    slack = 6 * math.sqrt(0.25 / perms) / (1 - 2.0 ** -BITS)
    sketch = keep_table(sketches(docs, id_col, text_col, width), "sketches")
    nodes = sketch.filter(F.col("node").isNotNull() & F.col("id").isNotNull())
    single = nodes.groupBy("node").agg(F.first("keys").alias("keys"), F.first("planes").alias("planes"))
    single = keep_table(single, "nodes")
    planes = single.select("node", "planes")

    member = single.select("node", F.explode("keys").alias("key"))
    pick = F.struct(F.xxhash64("key", "node").alias("h"), F.col("node").alias("pivot"))
    pivots = member.groupBy("key").agg(F.min(pick)["pivot"].alias("pivot"), F.count("*").alias("size")) \
        .filter("size > 1").select("key", "pivot")
    member = keep_table(member.join(pivots, "key"), "buckets")

    def plausible(pairs: DataFrame) -> DataFrame:
        a = planes.select(F.col("node").alias("a"), F.col("planes").alias("pa"))
        b = planes.select(F.col("node").alias("b"), F.col("planes").alias("pb"))
        near = estimate(F.col("pa"), F.col("pb"), perms, BITS) >= percent / 100 - slack
        return pairs.join(a, "a").join(b, "b").filter(near).select("a", "b")

    star = member.filter("node <> pivot").select(
        F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    star = keep_table(plausible(star), "candidates")
    involved = member.select("node").distinct()
    sets = keep_table(_full_sets(docs, sketch, involved, id_col, text_col, width), "sets")
    links = keep_table(_confirmed(star, sets, percent), "confirmed")
    labels = connected_components(links)

    # what a star may have missed: pairs of different components that share a bucket
    named = member.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    mixed = named.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("size")) \
        .filter("lo <> hi").select("key", "size")
    open_ = keep_table(named.join(mixed, "key"), "open")
    few = open_.filter(F.col("size") <= SMALL)
    x = few.select("key", F.col("node").alias("a"), F.col("label").alias("la"))
    y = few.select("key", F.col("node").alias("b"), F.col("label").alias("lb"))
    near = x.join(y, "key").filter("a < b and la <> lb").select("a", "b")
    far = _far_pairs(open_.filter(F.col("size") > SMALL), links, labels, sets, percent)
    across = near.union(far).distinct().join(star, ["a", "b"], "left_anti")
    more = keep_table(_confirmed(plausible(across), sets, percent), "confirmed")
    if not more.isEmpty():
        labels = merge_components(labels, more)

    named = nodes.select("id", "node").join(labels, "node", "left").select(
        "id", "node", F.coalesce("label", "node").alias("label"))
    first = named.groupBy("label").agg(F.min("id").alias("component_id"))
    of_node = named.select("node", "label").distinct().join(first, "label").select("node", "component_id")
    out = sketch.join(of_node, "node", "left")
    component = F.coalesce("component_id", "id")
    return out.select("id", "text_hash", F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), component).alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def _far_pairs(rows: DataFrame, links: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) across components that may be linked, from large buckets (key, node, label).

    A bucket's nodes are set against a reference: the shingles of most of the most
    linked nodes of its largest component and of a few nodes by hash. Any reference
    gives all pairs; a good one few others. A node of n shingles differs from it in
    d, held or missing; two nodes that share c of these differ in d + d' - 2c, so
    they are linked when ``score + score' <= 2 * (100 + percent) * c`` with
    ``score = (100 + percent) * d - (100 - percent) * n``.

    With c = 0 that is a sum alone: who is linked so with any node is so with the
    node of the least score, and is set against that one only (the core). All other
    pairs share a difference. A node's differences are ordered, those of few nodes
    first; the first one shared has all others after it in both, so c is at most
    what remains from there, and the join on a difference keeps only pairs that can
    still be linked. No pair that components need is left out.
    """
    main = rows.groupBy("key", "label").agg(F.count("*").alias("c")).groupBy("key").agg(
        F.max(F.struct("c", "label"))["label"].alias("main"))
    group = keep_table(rows.join(main, "key").select("main", "node", "label").distinct(), "group")
    ends = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node")))
    degree = ends.groupBy("node").agg(F.count("*").alias("degree")).join(labels, "node")
    rank = F.row_number().over(Window.partitionBy("label").orderBy(F.desc("degree"), "node"))
    central = degree.withColumn("rank", rank).filter(F.col("rank") <= CENTRES).select(F.col("label").alias("main"), "node")
    # what one node has lost of a common text, others still hold: some nodes of the bucket itself join in
    turn = F.row_number().over(Window.partitionBy("main").orderBy(F.xxhash64("node"), "node"))
    some = group.select("main", "node").withColumn("turn", turn).filter(F.col("turn") <= CENTRES).select("main", "node")
    centres = central.join(group.select("main").distinct(), "main", "left_semi").union(some).distinct()
    gathered = centres.join(sets, "node").groupBy("main").agg(F.collect_list("set").alias("parts"))

    def usual(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for parts in batch.column(1):
                held = [np.frombuffer(x, np.int64) for x in parts.as_py()]
                values, counts = np.unique(np.concatenate(held), return_counts=True)
                out.append(values[2 * counts > len(held)].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["main", "reference"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, differ = [], []
            for mine, common in zip(batch.column(3), batch.column(4)):
                own = np.frombuffer(mine.as_py(), np.int64)
                n.append(len(own))
                differ.append(np.setxor1d(own, np.frombuffer(common.as_py(), np.int64), assume_unique=True))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(n, pa.int64()), pa.array(differ, pa.list_(pa.int64()))],
                                             ["main", "node", "label", "n", "differ"])

    reference = gathered.select("main", "parts").mapInArrow(usual, "main binary, reference binary")
    placed = group.join(sets, "node").join(reference, "main").select("main", "node", "label", "set", "reference") \
        .mapInArrow(run, "main binary, node binary, label binary, n long, differ array<long>")
    score = (100 + percent) * F.size("differ").cast("long") - (100 - percent) * F.col("n")
    placed = keep_table(placed.withColumn("score", score), "placed")
    least = placed.groupBy("main").agg(F.min(F.struct("score", "node", "label")).alias("z")).select(
        "main", F.col("z.score").alias("least"), F.col("z.node").alias("centre"), F.col("z.label").alias("label_c"))
    scored = placed.join(least, "main").withColumn("core", F.col("score") + F.col("least") <= 0)
    inside = scored.filter("core and label <> label_c").select(
        F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b"))

    held = scored.select("main", "node", "label", "score", "least", "core", F.explode("differ").alias("s"))
    often = held.groupBy("main", "s").agg(F.count("*").alias("of")).filter(F.col("of") > 1)
    ordered = held.join(often, ["main", "s"]).groupBy("main", "node", "label", "score", "least", "core").agg(
        F.sort_array(F.collect_list(F.struct("of", "s"))).alias("differ"))
    step = 2 * (100 + percent)
    shared = keep_table(ordered.select("main", "node", "label", "score", "least", "core", F.size("differ").alias("all"),
                                       F.posexplode("differ").alias("at", "e")).select(
        "main", "node", "label", "score", "least", "core", F.col("e.s").alias("s"), (F.col("all") - F.col("at")).alias("left")), "shared")
    # the other node's score is the least at best, and above minus the least where this one is in the core
    outer = shared.filter(~F.col("core") & (F.col("score") + F.col("least") <= step * F.col("left")))
    any_ = shared.filter(F.col("score") - F.col("least") < step * F.col("left"))
    side = lambda df, mark: df.select("main", "s", *[F.col(c).alias(f"{c}_{mark}") for c in ("node", "label", "score", "core", "left")])
    outside = side(outer, "x").join(side(any_, "y"), ["main", "s"]).filter(
        (F.col("label_x") != F.col("label_y")) & (F.col("core_y") | (F.col("node_x") < F.col("node_y")))
        & (F.col("score_x") + F.col("score_y") <= step * F.least("left_x", "left_y"))) \
        .select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b"))
    return outside.union(inside)


def _full_sets(docs: DataFrame, sketch: DataFrame, involved: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(node, set) of the nodes that have a candidate; one document stands for its node."""
    chosen = sketch.join(involved, "node").groupBy("node").agg(F.min("id").alias("id")).select(F.col("id").alias("__of")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            sets = [shingler.shingles(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([
                pa.array([_name(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary()),
            ], ["node", "set"])

    texts = docs.select(F.col(id_col).alias("__of"), F.col(text_col).alias("text")).join(chosen, "__of", "left_semi")
    sets = texts.select("text").mapInArrow(run, "node binary, set binary")
    return sets.groupBy("node").agg(F.first("set").alias("set"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                         percent: int = 80) -> DataFrame:
    """The documents that ``near_duplicates`` keeps, with their own columns.

    Rows of one id and one text are one document: they stay or go together.
    """
    gone = near_duplicates(docs, id_col, text_col, width, percent).filter(~F.col("kept")).select(
        F.col("id").alias("__gone"), F.col("text_hash").alias("__text")).distinct()
    same = (docs[id_col] == gone["__gone"]) & (F.xxhash64(docs[text_col]) == gone["__text"])
    return docs.join(gone, same, "left_anti")
