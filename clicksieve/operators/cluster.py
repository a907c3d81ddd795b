"""Clustering of groups by their histograms.

Histograms stay in long form (group, key, n) or as sparse profiles, one row per
group with its own keys. Smoothing adds the same small count to every key, so a
share is a background value of the group plus a correction on the group's own
keys; sums over all keys follow from both, and the number of keys has no limit.

Divergences of listed pairs come from joins on keys. Average linkage lists no pairs:
groups are numbered and cut into blocks, two blocks meet in one task, and the task
hands on only the nearest cluster of each cluster.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicksieve.operators.aggregate import same_keys
from clicksieve.operators.ranks import number_rows, running
from clicksieve.session import keep_table

SMOOTH = 0.0001  # fixed value
# Blocks per side of the join that lists all pairs.
PAIR_BLOCKS = 16
# Groups in a block; two blocks and the matrix between them are held by a task.
BLOCK = 1024


# long and sparse histograms --------------------------------------------------------

def key_places(hist: DataFrame, key: str = "k") -> DataFrame:
    """(key, place) of all keys in order, from 0; whole-number keys order as numbers."""
    keys = keep_table(hist.select(F.col(key).alias("k")).distinct(), "keys")
    texts = F.col("k").cast("string")
    numbers = keys.agg(F.coalesce(F.bool_and(texts.rlike("^-*[0-9]+$")), F.lit(False))).first()[0]
    return number_rows(keys, [], [texts.cast("bigint"), F.col("k")] if numbers else ["k"])


def histogram_places(hist: DataFrame, group: str, key: str = "k", n: str = "n") -> DataFrame:
    """Long vectors (group, k, place, n): the entries that are not zero, with the place of their key."""
    places = key_places(hist, key)
    rows = hist.select(group, F.col(key).alias("k"), F.col(n).alias("n")).filter(F.col("n") != 0)
    return same_keys(rows, places, ["k"], "inner").select(group, "k", "place", "n")


def histogram_vectors(hist: DataFrame, group: str, key: str = "k", n: str = "n") -> DataFrame:
    """Dense vector per group over all keys in order, for exports; whole-number keys order as numbers."""
    places = keep_table(key_places(hist, key), "places")
    size = places.count()
    rows = same_keys(hist.select(group, F.col(key).alias("k"), F.col(n).cast("double").alias("n")), places, ["k"], "inner")
    cells = F.map_from_entries(F.collect_list(F.struct("place", "n")))
    steps = F.sequence(F.lit(0), F.lit(size - 1)).cast("array<bigint>")
    vec = F.transform(steps, lambda i: F.coalesce(F.try_element_at("_c", i), F.lit(0.0)))
    summed = rows.groupBy(group, "place").agg(F.sum("n").alias("n"))
    return summed.groupBy(group).agg(cells.alias("_c")).select(group, vec.alias("vec"))


def profiles(hist: DataFrame, group: str, key: str = "k", n: str = "n", smooth: float = SMOOTH) -> DataFrame:
    """One row per group: its share of every key as a background and corrections.

    A key's share is ``base``, plus ``c`` where the group has the key; its logarithm
    is ``log_base``, plus ``e`` there. ``keys`` are places, ``c_sum`` and ``e_sum`` sums,
    ``entropy`` the sum of p ln p over all keys, ``n_keys`` their number.
    """
    places = keep_table(key_places(hist, key), "places")
    rows = same_keys(hist.select(group, F.col(key).alias("k"), F.col(n).cast("double").alias("n")), places, ["k"], "inner")
    return _profiles(rows.select(F.col(group).alias("g"), "place", "n"), places.count(), smooth)


def _profiles(rows: DataFrame, n_keys: int, smooth: float) -> DataFrame:
    """Profiles of (g, place, n)."""
    size = F.lit(float(n_keys))
    lists = rows.groupBy("g", "place").agg(F.sum("n").alias("n")).groupBy("g").agg(
        F.sort_array(F.collect_list(F.when(F.col("n") != 0, F.struct("place", "n")))).alias("cells"),
        (F.sum("n") + smooth * size).alias("total"))
    lists = lists.withColumns({"base": F.lit(smooth) / F.col("total"), "keys": F.col("cells.place")})
    share = F.transform("cells.n", lambda x: x / F.col("total"))
    raised = F.transform("cells.n", lambda x: F.ln((x + smooth) / smooth))
    add = lambda values: F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
    lists = lists.withColumns({"c": share, "e": raised, "log_base": F.ln("base")})
    own = F.zip_with("c", "e", lambda c, e: (c + F.col("base")) * (e + F.col("log_base")))
    return lists.select(
        "g", "keys", "c", "e", "base", "log_base", add(F.col("c")).alias("c_sum"), add(F.col("e")).alias("e_sum"),
        (add(own) + (size - F.size("keys")) * F.col("base") * F.col("log_base")).alias("entropy"), size.alias("n_keys"))


# cells of two blocks -----------------------------------------------------------------

class Block:
    """Profiles of a block as arrays."""

    def __init__(self, table: pa.Table):
        self.table = table
        self.size = table.num_rows
        for name in ("base", "log_base", "c_sum", "e_sum", "entropy", "n_keys"):
            setattr(self, name, table.column(name).to_numpy())
        self.keys, self.c, self.e = (self._flat(n) for n in ("keys", "c", "e"))
        lengths = table.column("keys").combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
        self.rows = np.repeat(np.arange(self.size), lengths)

    def _flat(self, name: str) -> np.ndarray:
        return self.table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)

    def matrix(self, values: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Rows by the given sorted keys."""
        at = np.searchsorted(keys, self.keys)
        here = (at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == self.keys)
        out = np.zeros((self.size, len(keys)))
        out[self.rows[here], at[here]] = values[here]
        return out


def divergence(a: Block, b: Block, chunk: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """KL(a || b) and KL(b || a) of every row of a with every row of b, both indexed [a, b]."""
    common = np.intersect1d(a.keys, b.keys)
    ab, ba = np.zeros((a.size, b.size)), np.zeros((a.size, b.size))
    for k in range(0, len(common), chunk):
        keys = common[k:k + chunk]
        ab += a.matrix(a.c, keys) @ b.matrix(b.e, keys).T
        ba += a.matrix(a.e, keys) @ b.matrix(b.c, keys).T

    def rest(p: Block, q: Block) -> np.ndarray:
        return (p.base[:, None] * q.e_sum + p.c_sum[:, None] * q.log_base + (p.n_keys * p.base)[:, None] * q.log_base)

    ab += rest(a, b)
    ba += rest(b, a).T
    return a.entropy[:, None] - ab, b.entropy[None, :] - ba


def in_cells(
    rows: DataFrame, links: DataFrame, what: Callable[[pa.Table, pa.Table | None], Iterator[pa.Table]], schema: str,
) -> DataFrame:
    """``what(rows of block i, rows of block j)`` for each link (i, j), i <= j; the second is None where i = j.

    ``rows`` have a column ``block``. A row goes to as many tasks as its block has links.
    """
    left = rows.join(links, rows["block"] == links["i"]).withColumn("side", F.lit(0))
    right = rows.join(links.filter("i < j"), rows["block"] == F.col("j")).withColumn("side", F.lit(1))

    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        second = table.filter(pa.array(side == 1))
        return pa.concat_tables(what(table.filter(pa.array(side == 0)), second if second.num_rows else None))

    return left.unionByName(right).groupBy("i", "j").applyInArrow(run, schema)


def _near_links(spans: DataFrame, width: float) -> DataFrame:
    """Links (i, j) of blocks whose intervals (block, lo, hi) are at most ``width`` apart."""
    cell = lambda c: F.floor(F.col(c) / width).cast("bigint")
    a = spans.select(F.col("block").alias("i"), F.col("lo").alias("a_lo"), F.col("hi").alias("a_hi"),
                     F.explode(F.sequence(cell("lo") - 1, cell("hi") + 1)).alias("cell"))
    b = spans.select(F.col("block").alias("j"), F.col("lo").alias("b_lo"), F.col("hi").alias("b_hi"),
                     F.explode(F.sequence(cell("lo"), cell("hi"))).alias("cell"))
    met = a.join(b, "cell").filter((F.col("i") <= F.col("j")) & (F.col("b_lo") - F.col("a_hi") <= width) & (
        F.col("a_lo") - F.col("b_hi") <= width))
    return met.select("i", "j").distinct()


# pairs of groups ---------------------------------------------------------------------

_SCALARS = ["base", "log_base", "c_sum", "e_sum", "entropy"]


def _entries(rows: DataFrame) -> DataFrame:
    """Corrections of profiles in long form: (g, at, c, e)."""
    cells = rows.select("g", F.explode(F.arrays_zip("keys", "c", "e")).alias("x"))
    return cells.select("g", F.col("x.keys").alias("at"), F.col("x.c").alias("c"), F.col("x.e").alias("e"))


def _sided(rows: DataFrame, side: str, columns: Sequence[str]) -> DataFrame:
    return rows.select(F.col("g").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in columns])


def _with_kl(pairs: DataFrame, common: DataFrame) -> DataFrame:
    """(a, b, kl) of pairs with both profiles' scalars, and what common keys add (a, b, dot)."""
    background = F.col("a_base") * (F.col("a_n_keys") * F.col("b_log_base") + F.col("b_e_sum")) + F.col("a_c_sum") * F.col("b_log_base")
    joined = same_keys(pairs, common, ["a", "b"])
    return joined.select("a", "b", (F.col("a_entropy") - background - F.coalesce("dot", F.lit(0.0))).alias("kl"))


def pairwise_kl(hist: DataFrame, group: str, key: str = "k", n: str = "n", smooth: float = SMOOTH) -> DataFrame:
    """KL divergence in nats between every two groups, as (a, b, kl): all pairs are the result asked for.

    The background of a pair follows from sums of both groups, what common keys add
    from a join on the key. Groups fall into hash blocks, and each pair of blocks is
    one key of the join that lists the pairs, so these spread over many tasks.
    """
    rows = keep_table(profiles(hist, group, key, n, smooth), "profiles")
    own = F.pmod(F.xxhash64("g"), F.lit(PAIR_BLOCKS)).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.lit(PAIR_BLOCKS - 1)))
    a = _sided(rows, "a", [*_SCALARS, "n_keys"]).join(rows.select(F.col("g").alias("a"), own.alias("_i"), others.alias("_j")), "a")
    b = _sided(rows, "b", _SCALARS).join(rows.select(F.col("g").alias("b"), others.alias("_i"), own.alias("_j")), "b")
    pairs = a.join(b, ["_i", "_j"]).filter(F.col("a") != F.col("b")).drop("_i", "_j")
    cells = _entries(rows)
    common = _sided(cells, "a", ["at", "c"]).join(_sided(cells, "b", ["at", "e"]), F.col("a_at") == F.col("b_at")).filter(
        F.col("a") != F.col("b")).groupBy("a", "b").agg(F.sum(F.col("a_c") * F.col("b_e")).alias("dot"))
    return _with_kl(pairs, common)


def _widest(rows: DataFrame, count: int) -> list[int]:
    """Places of the keys whose shares vary most over the profiles."""
    every = rows.agg(F.count(F.lit(1)), F.sum("base"), F.sum(F.col("base") * F.col("base"))).first()
    cells = rows.select("base", F.explode(F.arrays_zip("keys", "c")).alias("x")).select(
        F.col("x.keys").alias("place"), F.col("x.c").alias("c"), "base")
    # on its own keys a share differs from the background by c, its square by c * (c + 2 base)
    mean = (F.lit(every[1]) + F.sum("c")) / every[0]
    square = (F.lit(every[2]) + F.sum(F.col("c") * (F.col("c") + 2 * F.col("base")))) / every[0]
    widest = cells.groupBy("place").agg((square - mean * mean).alias("d")).orderBy(F.desc("d"), "place").limit(count)
    return [r.place for r in widest.collect()]


def _share(place: int | Sequence[int]) -> Column:
    """A profile's share of one key; the background without one."""
    if not isinstance(place, int):
        return _share(place[0]) if place else F.col("base")
    at = F.array_position("keys", F.lit(place).cast("bigint")).cast("int")
    return F.col("base") + F.when(at > 0, F.get("c", at - 1)).otherwise(F.lit(0.0))


def _width(below: float) -> float:
    """Groups, or the means of clusters, under this divergence differ by no more in any share (Pinsker)."""
    return float(np.sqrt(max(below, 1e-12) / 2)) * (1 + 1e-9)


def near_pairs(
    hist: DataFrame, group: str, below: float, key: str = "k", n: str = "n", smooth: float = SMOOTH
) -> DataFrame:
    """The ordered pairs of groups whose KL divergence is under ``below`` nats, as (a, b, kl).

    A divergence under t moves no share by more than sqrt(t / 2) (Pinsker), so
    both groups lie in the same or neighbouring cells of that width, for every key.
    Cells of the two keys whose shares vary most are the join keys; distant groups
    never meet and no pair below the threshold is missed. What common keys add is
    summed over the entries of the pairs that met.
    """
    rows = keep_table(profiles(hist, group, key, n, smooth), "profiles")
    width = _width(below)
    names = [f"_c{i}" for i in range(2)]
    cells = [F.floor(_share(p) / width) for p in _widest(rows, 2)]
    cells += [F.lit(0).cast("bigint")] * (2 - len(cells))
    placed = rows.withColumns(dict(zip(names, cells)))
    a = _sided(placed, "a", [*_SCALARS, "n_keys", *names]).withColumnsRenamed({f"a_{n}": n for n in names})
    b = _sided(placed, "b", [*_SCALARS, *names]).withColumnsRenamed({f"b_{n}": n for n in names})
    for n in names:
        b = b.withColumn(n, F.explode(F.array(F.col(n) - 1, F.col(n), F.col(n) + 1)))
    pairs = keep_table(a.join(b, names).filter(F.col("a") != F.col("b")).drop(*names), "near-pairs")
    entries = _entries(rows)
    left, right = _sided(entries, "a", ["at", "c"]), _sided(entries, "b", ["at", "e"]).withColumnRenamed("b", "_b")
    met = pairs.select("a", "b").join(left, "a")
    common = met.join(right, (met["b"] == right["_b"]) & (met["a_at"] == right["b_at"])).groupBy("a", "b").agg(
        F.sum(F.col("a_c") * F.col("b_e")).alias("dot"))
    return _with_kl(pairs, common).filter(F.col("kl") < below)


# average linkage ------------------------------------------------------------------------

def _nearest(first: pa.Table, second: pa.Table | None) -> Iterator[pa.Table]:
    """What a cell knows of the distances between clusters.

    Sums of pairs for clusters that other cells hold parts of (``own`` is null),
    and for every other cluster the nearest one that is whole in this cell.
    """
    a = Block(first)
    b = a if second is None else Block(second)
    one, two = divergence(a, b)
    before = a.table.column("rank").to_numpy()[:, None] < b.table.column("rank").to_numpy()[None, :]
    pairs = np.where(before, one, two)
    (tags_a, at_a, n_a, whole_a), (tags_b, at_b, n_b, whole_b) = map(_clusters, (a.table, b.table))
    sums = np.zeros((len(tags_a), b.size))
    np.add.at(sums, at_a, pairs)
    sums = np.add.reduceat(sums[:, np.argsort(at_b, kind="stable")], np.searchsorted(np.sort(at_b), np.arange(len(tags_b))), axis=1)
    same = tags_a[:, None] == tags_b[None, :]
    x, y = np.nonzero(~same & ~(whole_a[:, None] & whole_b[None, :]))
    if second is None:  # each pair once
        x, y = x[x < y], y[x < y]
    parts = [(None, tags_a[i], tags_b[j], sums[i, j]) for i, j in zip(x, y)]
    means = sums / (n_a[:, None] * n_b[None, :])
    means[same | ~(whole_a[:, None] & whole_b[None, :])] = np.inf
    found = []
    for d, own, other in [(means, tags_a, tags_b)] if second is None else [(means, tags_a, tags_b), (means.T, tags_b, tags_a)]:
        if not d.size:
            continue
        low = d.min(axis=1)
        for i in np.nonzero(np.isfinite(low))[0]:
            pair = min((min(own[i], other[j]), max(own[i], other[j])) for j in np.nonzero(d[i] == low[i])[0])
            found.append((own[i], *pair, low[i]))
    names = ("own", "a", "b", "v")
    cols = list(zip(*parts)) if parts else [[], [], [], []]
    yield pa.table({n: pa.array(list(c), t) for n, c, t in zip(names, cols, (pa.string(),) * 3 + (pa.float64(),))})
    cols = list(zip(*found)) if found else [[], [], [], []]
    yield pa.table({n: pa.array(list(c), t) for n, c, t in zip(names, cols, (pa.string(),) * 3 + (pa.float64(),))})


def _clusters(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tags of a block, the tag of each row, and of each tag its size and whether the block holds all of it."""
    tags, first, at = np.unique(np.array(table.column("tag").to_pylist(), dtype=object), return_index=True, return_inverse=True)
    column = lambda name: table.column(name).to_numpy(zero_copy_only=False)[first]
    return tags, at, column("members"), column("whole")


def link_clusters(rows: DataFrame, threshold: float) -> DataFrame:
    """Clusters (g, tag) of written profiles with their ``volume``, see ``average_link_clusters``."""
    # a divergence goes from the larger group to the smaller one
    ranked = keep_table(number_rows(rows, [], [F.desc("volume"), "g"], "rank"), "ranked")
    ranked = keep_table(ranked.withColumn("share", _share(_widest(ranked, 1))), "ranked-shares")
    tags = ranked.select("g", F.col("g").alias("tag"))
    while True:
        sizes = same_keys(ranked.select("g", "share"), tags, ["g"], "inner").groupBy("tag").agg(
            F.count(F.lit(1)).alias("members"), F.avg("share").alias("centre"))
        placed = keep_table(same_keys(tags, sizes, ["tag"], "inner"), "sized")
        placed = number_rows(placed, [], ["centre", "tag", "g"])
        starts = placed.groupBy("tag").agg(F.min("place").alias("start"))
        # a cluster of up to half a block stays in one block, a larger one is cut by place
        whole = F.col("members") <= BLOCK // 2
        block = F.floor(F.when(whole, F.col("start")).otherwise(F.col("place")) / BLOCK)
        blocks = same_keys(placed, starts, ["tag"], "inner").select(
            "g", "tag", "members", "centre", whole.alias("whole"), block.alias("block"))
        blocked = keep_table(same_keys(ranked, blocks, ["g"], "inner"), "blocked")
        spans = blocked.groupBy("block").agg(F.min("centre").alias("lo"), F.max("centre").alias("hi"))
        cells = in_cells(blocked, _near_links(spans, _width(threshold)), _nearest, "own string, a string, b string, v double")
        cells = keep_table(cells, "nearest")
        n = sizes.select("tag", "members")
        low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
        sums = cells.filter(F.col("own").isNull()).groupBy(low, high).agg(F.sum("v").alias("v"))
        for side in "ab":
            sums = sums.join(n.withColumnsRenamed({"tag": side, "members": f"n_{side}"}), side)
        split = sums.withColumn("v", F.col("v") / F.col("n_a") / F.col("n_b")).select(
            F.explode(F.array("a", "b")).alias("own"), "a", "b", "v")
        near = cells.filter(F.col("own").isNotNull()).unionByName(split).groupBy("own").agg(F.min(F.struct("v", "a", "b")).alias("k"))
        merges = keep_table(
            near.filter(F.col("k.v") < threshold).groupBy(F.col("k.a").alias("new"), F.col("k.b").alias("old"))
            .agg(F.count(F.lit(1)).alias("both")).filter(F.col("both") == 2).select("old", "new"), "merges")
        if merges.isEmpty():
            return tags
        tags = keep_table(tags.join(merges, tags["tag"] == merges["old"], "left").select(
            "g", F.coalesce("new", "tag").alias("tag")), "tags")


def average_link_clusters(
    vectors: DataFrame, group: str, volume: str, threshold: float, vec: str = "vec", smooth: float = SMOOTH
) -> DataFrame:
    """Agglomerative clusters by average linkage below a distance threshold, as (group, tag).

    The distance of two groups is the divergence from the one with the larger
    volume (equal volumes: the smaller name) to the other. That direction belongs
    to the pair, so sums per cluster do not give a cluster's distances; each round
    computes the divergences again, in cells of two blocks, and a cell adds them up
    by cluster: only the nearest cluster of each one leaves it, and for clusters of
    more than half a block their part of the sums. Blocks of clusters whose mean
    shares are too far apart for the threshold do not meet. Each round merges all
    clusters that are nearest to each other, which gives the same tree as merging
    one pair at a time; equal distances go by the names. The tag is the smallest
    group of the cluster. Names of groups are texts.
    """
    rows = vectors.select(F.col(group).alias("g"), F.posexplode_outer(vec).alias("place", "n"))
    size = vectors.agg(F.coalesce(F.max(F.size(vec)), F.lit(0))).first()[0]
    entries = rows.select("g", F.col("place").cast("bigint").alias("place"), F.col("n").cast("double").alias("n"))
    return _linked(_profiles(entries, size, smooth), vectors, group, volume, threshold)


def average_link_histograms(
    hist: DataFrame, sizes: DataFrame, group: str, volume: str, threshold: float, key: str = "k", n: str = "n",
    smooth: float = SMOOTH,
) -> DataFrame:
    """``average_link_clusters`` of histograms in long form, with ``sizes`` (group, volume)."""
    return _linked(profiles(hist, group, key, n, smooth), sizes, group, volume, threshold)


def _linked(rows: DataFrame, sizes: DataFrame, group: str, volume: str, threshold: float) -> DataFrame:
    volumes = sizes.select(F.col(group).alias("g"), F.col(volume).alias("volume"))
    tags = link_clusters(keep_table(same_keys(rows, volumes, ["g"], "inner"), "profiles"), threshold)
    return tags.withColumnRenamed("g", group)


def cluster_stats(
    members: DataFrame, hist: DataFrame, group: str, tag: str, volume: str,
    keys: Sequence[str] = (), key: str = "k", n: str = "n", smooth: float = SMOOTH,
) -> DataFrame:
    """Per cluster and key of ``hist`` the mean and deviation, with size, volume and density.

    ``members`` has (group, tag, volume). A group without a key counts 0 there, which
    the sums over the groups that have it already tell. The density is the mean KL
    divergence of the pairs of a cluster, the later group first. It needs no pairs:
    group i adds its sum of p ln p for each of the groups before it, less its shares
    times the running sums of their ln q, which are a background sum of the cluster
    and corrections by key. Running sums go over blocks of groups, so neither a
    cluster nor a key is held by one task. A key that no group of a cluster has
    gets a row of zeros if it is one of ``keys``, else none.
    """
    rows = profiles(hist, group, key, n, smooth)
    named = members.select(F.col(group).alias("g"), F.col(tag).alias("tag"), F.col(volume).alias("volume"))
    placed = number_rows(keep_table(same_keys(rows, named, ["g"], "inner"), "members"), ["tag"], ["g"])
    placed = keep_table(placed, "placed-members")
    sizes = placed.groupBy("tag").agg(F.count(F.lit(1)).alias("nodes"), F.sum("volume").alias("volume"))
    scalars = running(placed.drop("keys", "c", "e"), ["tag"], "place", {
        "logs": (F.sum, F.col("log_base")), "raised": (F.sum, F.col("e_sum"))})
    own = F.col("entropy") * F.col("place") - F.col("logs") * (F.col("n_keys") * F.col("base") + F.col("c_sum")) \
        - F.col("base") * F.col("raised")
    back = scalars.groupBy("tag").agg(F.sum(F.coalesce(own, F.lit(0.0))).alias("_sum"))
    cells = placed.select("tag", "place", F.explode(F.arrays_zip("keys", "c", "e")).alias("x")).select(
        "tag", "place", F.col("x.keys").alias("at"), F.col("x.c").alias("c"), F.col("x.e").alias("e"))
    crossed = running(cells, ["tag", "at"], "place", {"before": (F.sum, F.col("e"))})
    common = crossed.groupBy("tag").agg(F.sum(F.coalesce(F.col("c") * F.col("before"), F.lit(0.0))).alias("_common"))
    counted = same_keys(hist.select(F.col(group).alias("g"), F.col(key).alias("k"), F.col(n).cast("double").alias("v")),
                        named.select("g", "tag"), ["g"], "inner").filter(F.col("v") != 0)
    per_key = counted.groupBy("tag", "k").agg(
        F.count(F.lit(1)).alias("_m"), F.avg("v").alias("_mean"), F.var_pop("v").alias("_var"))
    if keys:
        every = sizes.select("tag", F.explode(F.array(*[F.lit(k) for k in keys])).alias("k"))
        per_key = same_keys(every, per_key, ["tag", "k"]).fillna(0, ["_m", "_mean", "_var"]).unionByName(
            same_keys(per_key, every, ["tag", "k"], "left_anti"))
    joined = same_keys(same_keys(same_keys(per_key, sizes, ["tag"]), back, ["tag"]), common, ["tag"])
    part = F.col("_m") / F.col("nodes")  # of the groups that have the key; the others are zeros
    deviation = F.sqrt(part * F.col("_var") + part * (1 - part) * F.col("_mean") * F.col("_mean"))
    pairs = F.col("nodes") * (F.col("nodes") - 1) / 2
    density = F.coalesce(F.try_divide(F.col("_sum") - F.coalesce("_common", F.lit(0.0)), pairs), F.lit(0.0))
    return joined.select(
        F.col("tag").alias(tag), F.col("k").alias(key), (part * F.col("_mean")).alias("mean"), deviation.alias("std"),
        "nodes", "volume", density.alias("density"))


def sort_by_volume(df: DataFrame, volume: str, limit: int, tie: Sequence[str] = ()) -> DataFrame:
    """Groups with at least ``limit`` volume, largest first."""
    return df.filter(F.col(volume) >= limit).orderBy(F.desc(volume), *tie)


_MEASURES = {"ls": "channels", "pv": "volume", "avg": "average"}


def _sizes(volume: str) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("channels"), F.sum(volume).alias("volume"), F.avg(volume).alias("average")]


def rank_clusters(df: DataFrame, tag: str, volume: str, measure: str) -> DataFrame:
    """Clusters with their sizes, best measure first."""
    return df.groupBy(tag).agg(*_sizes(volume)).orderBy(F.desc(_MEASURES[measure]), tag)


def best_tag_path(
    df: DataFrame, tags: Sequence[str], site: str, volume: str, measure: str, count: int = 10
) -> DataFrame:
    """Best tag combinations with their largest sites, one row per path and site rank.

    Both the paths and the sites shown per path are reports of ``count`` rows.
    """
    paths = df.groupBy(*tags).agg(*_sizes(volume)).orderBy(F.desc(_MEASURES[measure]), *tags).limit(count)
    sites = df.groupBy(*tags, site).agg(F.sum(volume).alias("site_volume"))
    joined = same_keys(sites, paths, tags, "inner")
    order = Window.partitionBy(*tags).orderBy(F.desc("site_volume"), site)
    return joined.withColumn("site_rank", F.row_number().over(order)).filter(F.col("site_rank") <= count)


def keep_one_per_page(
    df: DataFrame, site: str, channel: str, volume: str, *, near: float = 0.01, unknown: str = "unk"
) -> DataFrame:
    """One channel per run of channels with almost equal volume on a site.

    Channels go by falling volume; a run lasts while the volume differs by
    less than ``near`` from the run's first, relative to their sum. The last
    channel of a run stays, and every channel of the unknown site.

    Channels with the same volume are always in one run, so distinct volumes are
    numbered by site. Where a run that starts at a volume would end is the same
    for every volume, an as-of search by running minima; the starts that the
    walk from the largest volume meets are found by doubling the jumps. No task
    holds a site.
    """
    known = df.filter(F.col(site) != unknown)
    steps = known.groupBy(F.col(site).alias("s"), F.col(volume).cast("double").alias("v")).agg(F.max(channel).alias("last"))
    volumes = keep_table(number_rows(keep_table(steps, "volumes"), ["s"], [F.desc("v")]), "numbered-volumes")
    jumps = keep_table(_run_ends(volumes, near), "jumps")
    met = starts = jumps.filter(F.col("place") == 0).select("s", "place")
    leaps = jumps.select("s", "place", "next")
    while True:  # starts within 1, 2, 4, ... runs of the first
        ahead = keep_table(_at(met, leaps).filter(F.col("next").isNotNull()).select("s", F.col("next").alias("place")), "met")
        if ahead.isEmpty():
            break
        met = keep_table(met.unionByName(ahead).distinct(), "starts")
        further = leaps.select(F.col("s").alias("_s"), F.col("place").alias("_p"), F.col("next").alias("_n"))
        leaps = keep_table(leaps.join(further, (leaps["s"] == further["_s"]) & (leaps["next"] == further["_p"])).select(
            "s", "place", F.col("_n").alias("next")).filter(F.col("next").isNotNull()), "leaps")
    counts = volumes.groupBy("s").agg(F.max("place").alias("end"))
    ends = same_keys(_at(met, jumps), counts, ["s"], "inner").select(
        "s", F.coalesce(F.col("next") - 1, F.col("end")).alias("place"))
    kept = _at(ends, volumes).select(F.col("s").alias(site), F.col("last").alias(channel))
    return same_keys(known, kept, [site, channel], "left_semi").unionByName(df.filter(F.col(site) == unknown))


def _at(places: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows (s, place, ...) at the given places."""
    return same_keys(places, rows, ["s", "place"], "inner")


def _run_ends(volumes: DataFrame, near: float) -> DataFrame:
    """(s, place, next): the place where the next run starts, if one starts at ``place``; null if none does.

    The largest volume up to v (1 - near) / (1 + near) starts it. The bound is taken a
    trifle wider, and the volume found then tested as it stands: the next one starts
    the run if it is still near.
    """
    bound = F.col("v") * ((1 - near) / (1 + near) * (1 + 1e-9))
    asked = volumes.select("s", bound.alias("x"), F.lit(1).alias("asks"), "place", "v")
    given = volumes.select("s", F.col("v").alias("x"), F.lit(0).alias("asks"), "place", "v")
    line = number_rows(keep_table(asked.unionByName(given), "line"), ["s"], ["x", "asks", "place"], "at")
    # going up, the latest volume passed is the one with the smallest place
    passed = running(line, ["s"], "at", {
        "found": (F.min, F.when(F.col("asks") == 0, F.struct(F.col("place").alias("p"), F.col("v").alias("u"))))})
    u = F.col("found.u")
    still = F.abs((u - F.col("v")) / (u + F.col("v"))) < near
    step = F.col("found.p") + F.when(still, 1).otherwise(0)
    tops = volumes.groupBy("s").agg(F.max("place").alias("end"))
    found = passed.filter(F.col("asks") == 1).select("s", "place", step.alias("step"))
    return same_keys(found, tops, ["s"], "inner").select("s", "place", F.when(F.col("step") <= F.col("end"), F.col("step")).alias("next"))
