"""Isolation forest: hash-drawn samples, trees trained in tasks, scored in batches.

All draws are digests of the tree number and the row id, so a re-run gives the
same forest. Sizes are fixed by the parameters: a tree sees ``max_samples`` rows and
has at most 2^(max_depth+1) nodes. The forest itself stays in files: scoring tasks
read it from the shared folder, the driver never holds it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicksieve.operators.ranks import number_rows
from clicksieve.session import cut_lineage, scratch_path

EULER = 0.5772156649  # fixed value
# Nodes that a scoring worker keeps; a larger forest is read file by file for each batch of rows.
KEPT_NODES = 2_000_000
NODE_SCHEMA = (
    "tree int, node int, feature int, split double, left int, right int, size int, depth int"
)


@dataclass(frozen=True)
class ForestParams:
    trees: int = 100
    max_samples: float = 256.0  # at most 1 means a fraction of the rows
    max_features: float = 1.0   # likewise
    max_depth: int = 10
    bootstrap: bool = False
    shuffle_columns: bool = True
    clamp: float | None = 4.0
    seed: int = 7


def _digest(*parts: Column | str | int) -> Column:
    """MD5 of the parts as text."""
    texts = [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws(":", *texts).cast("binary"))


def _unit(*parts: Column | str | int) -> Column:
    """A number in [0, 1) from the first 52 bits of the digest."""
    return F.conv(F.substring(_digest(*parts), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def unit(*parts: str | int) -> float:
    """``_unit`` of plain values."""
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:13], 16) / (1 << 52)


def tree_rows(rows: int, params: ForestParams) -> int:
    n = int(params.max_samples if params.max_samples > 1 else params.max_samples * rows)
    if n > rows:
        raise ValueError("a tree cannot sample more rows than there are")
    return n


def iforest_sample(df: DataFrame, id_col: str, cols: Sequence[str], params: ForestParams) -> DataFrame:
    """Training rows (tree, pos, features) of every tree.

    A pool of trees x max_samples rows with the smallest digests is a uniform
    sample of the table; each tree draws its rows from the pool by digests of
    its own. Only the pool, whose size the parameters set, meets the trees; it
    is numbered by ranges and offsets. The pool is taken out of the rows below a
    bound that should leave twice as many; should it leave too few, all rows are
    numbered. A tree is trained in one task, so ``max_samples`` bounds its memory.
    """
    rows = df.count()
    n = tree_rows(rows, params)
    seed = params.seed
    size = min(rows, n * params.trees)
    hashed = df.select(F.col(id_col).alias("_id"), *[F.col(c).cast("double").alias(c) for c in cols]).withColumn(
        "_h", _digest(seed, F.col("_id")))
    bound = (2 * size + 100) / rows
    if bound < 1:
        near = cut_lineage(hashed.filter(F.col("_h") < f"{int(bound * 16 ** 13):013x}"))
        hashed = near if near.count() >= size else hashed
    return _draw(hashed, cols, params, n, size)


def _draw(hashed: DataFrame, cols: Sequence[str], params: ForestParams, n: int, size: int) -> DataFrame:
    seed = params.seed
    pool = number_rows(hashed, [], ["_h", "_id"], "_i").filter(F.col("_i") < size)
    trees = F.explode(F.sequence(F.lit(0), F.lit(params.trees - 1))).alias("tree")
    if params.bootstrap:
        draws = hashed.sparkSession.range(params.trees * n).select(
            F.floor(F.col("id") / n).cast("int").alias("tree"),
            F.floor(_unit(seed, F.col("id"), "draw") * size).cast("bigint").alias("_i"),
            (F.col("id") % n).cast("int").alias("pos"))
        sample = draws.join(pool, "_i").select("tree", "pos", "_id", *cols)
    else:
        order = Window.partitionBy("tree").orderBy(_digest(seed, F.col("tree"), F.col("_id")), "_id")
        sample = (
            pool.select(trees, "_id", *cols)
            .withColumn("pos", F.row_number().over(order) - 1).filter(F.col("pos") < n)
            .select("tree", "pos", "_id", *cols)
        )
    if params.shuffle_columns:
        long = sample.select("tree", "pos", F.inline(F.array(*[
            F.struct(F.lit(c).alias("_f"), F.col(c).alias("_v")) for c in cols])))
        mixed = Window.partitionBy("tree", "_f").orderBy(_digest(seed, F.col("tree"), F.col("_f"), F.col("pos")), "pos")
        sample = (
            long.withColumn("pos", F.row_number().over(mixed) - 1)
            .groupBy("tree", "pos").pivot("_f", list(cols)).agg(F.first("_v"))
        )
    out = []
    for c in cols:
        v = F.col(c)
        if params.clamp is not None:
            jitter = _unit(seed, F.col("tree"), F.col("pos"), c) - 0.5
            v = F.when(v > params.clamp, F.lit(params.clamp) + jitter).otherwise(v)
        out.append(v.alias(c))
    return sample.select("tree", "pos", *out)


def _grow(data: np.ndarray, tree: int, params: ForestParams) -> list[tuple]:
    """Nodes of a tree, numbered by place: those below node i are 2i + 1 and 2i + 2.

    Feature and split of a node are drawn by digests of seed, tree and node.
    """
    width = data.shape[1]
    take = int(params.max_features * width if params.max_features <= 1 else min(params.max_features, width))
    order = sorted(range(width), key=lambda f: unit(params.seed, tree, "column", f))
    features = np.sort(order[:take])
    deepest = min(params.max_depth, int(np.ceil(np.log2(max(2, len(data))))))
    nodes: list[tuple] = []
    todo = [(0, np.arange(len(data)), 0)]
    while todo:
        node, rows, depth = todo.pop()
        usable = features[:0]
        if depth < deepest and len(rows) > 1:
            part = data[rows]
            usable = features[part[:, features].min(axis=0) < part[:, features].max(axis=0)]
        if not len(usable):
            nodes.append((tree, node, -1, None, -1, -1, len(rows), depth))
            continue
        f = int(usable[int(unit(params.seed, tree, node, "feature") * len(usable))])
        values = part[:, f]
        low, high = values.min(), values.max()
        split = float(low + unit(params.seed, tree, node, "split") * (high - low))
        left, right = 2 * node + 1, 2 * node + 2
        nodes.append((tree, node, f, split, left, right, len(rows), depth))
        todo += [(right, rows[values >= split], depth + 1), (left, rows[values < split], depth + 1)]
    return nodes


def iforest_fit(sample: DataFrame, cols: Sequence[str], params: ForestParams) -> DataFrame:
    """Node table of the forest; node 0 of each tree is its root, feature -1 a leaf."""
    names = list(cols)

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        ordered = pdf.sort_values("pos")
        nodes = _grow(ordered[names].to_numpy(float), int(ordered["tree"].iloc[0]), params)
        return pd.DataFrame(
            nodes, columns=["tree", "node", "feature", "split", "left", "right", "size", "depth"])

    return sample.groupBy("tree").applyInPandas(train, NODE_SCHEMA)


def average_path(size: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``size`` rows."""
    n = np.asarray(size, dtype=float)
    big = np.maximum(n, 3.0)
    long = 2.0 * (np.log(big - 1.0) + EULER) - 2.0 * (big - 1.0) / big
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


def write_forest(nodes: DataFrame) -> str:
    """Nodes as files below the shared folder, whole trees in a file; the folder's path."""
    path = scratch_path(nodes.sparkSession, "forest")
    nodes.repartitionByRange("tree").sortWithinPartitions("tree", "node").write.parquet(path)
    return path


def _tree_arrays(table: pd.DataFrame, adjust: bool) -> list[tuple]:
    """Per tree the arrays feature, split, left, right, path length and the root's place."""
    trees = []
    for _, t in table.groupby("tree"):
        place = {int(v): i for i, v in enumerate(t["node"].to_numpy())}
        at = lambda c: np.array([place.get(int(v), -1) for v in t[c]])
        path = t["depth"].to_numpy(float) + average_path(t["size"].to_numpy())
        if adjust:
            path = np.where(path <= 2, 0.0, np.where(path <= 5, path - 1.0, path))
        trees.append((
            t["feature"].to_numpy(int), t["split"].to_numpy(float), at("left"), at("right"), path, place[0]))
    return trees


class ForestFiles:
    """The trees of a folder, read in the scoring task with Arrow's own file systems."""

    def __init__(self, path: str, adjust: bool, kept: int):
        self.path, self.adjust, self.kept = path, adjust, kept
        self.held: dict[str, list[tuple]] = {}
        self.nodes = 0

    def blocks(self) -> Iterator[list[tuple]]:
        """Trees of one file after another; as many as fit stay in memory."""
        # a plain or file: path is one that all executors mount
        local = self.path.startswith(("/", "file:"))
        fs, root = (pa.fs.LocalFileSystem(), "/" + self.path.removeprefix("file:").lstrip("/")) if local \
            else pa.fs.FileSystem.from_uri(self.path)
        files = sorted(f.path for f in fs.get_file_info(pa.fs.FileSelector(root)) if f.path.endswith(".parquet"))
        for file in files:
            trees = self.held.get(file)
            if trees is None:
                table = pq.read_table(file, filesystem=fs).to_pandas()
                trees = _tree_arrays(table, self.adjust)
                if self.nodes + len(table) <= self.kept:
                    self.held[file] = trees
                    self.nodes += len(table)
            yield trees


def iforest_score(
    df: DataFrame, nodes: DataFrame, cols: Sequence[str], samples: int, *, adjust: bool = True,
    kept_nodes: int = KEPT_NODES,
) -> DataFrame:
    """Rows with ``score`` = 2^(-mean path / c(samples)).

    ``adjust`` shortens the paths of a tree: at most 2 counts as 0, at most 5
    as one less. The forest is written once below the shared folder; each worker
    reads it there and keeps up to ``kept_nodes`` nodes. A larger forest is read
    again, file by file, for each Arrow batch. The shared folder must be one that
    Arrow reads (a mounted path, or a store it knows).
    """
    path = write_forest(nodes)
    norm = float(average_path(samples))

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        forest = ForestFiles(path, adjust, kept_nodes)
        for batch in batches:
            x = np.column_stack([s.to_numpy(float) for s in batch])
            total, count = np.zeros(len(x)), 0
            rows = np.arange(len(x))
            for trees in forest.blocks():
                count += len(trees)
                for feature, split, left, right, lengths, root in trees:
                    here = np.full(len(x), root)
                    inner = feature[here] >= 0
                    while inner.any():
                        f = np.maximum(feature[here], 0)
                        down = np.where(x[rows, f] < split[here], left[here], right[here])
                        here = np.where(inner, down, here)
                        inner = feature[here] >= 0
                    total += lengths[here]
            yield pd.Series(np.power(2.0, -(total / count) / norm))

    return df.select("*", score(*[F.col(c).cast("double") for c in cols]).alias("score"))
