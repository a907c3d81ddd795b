"""A Merkle manifest of a dataset: digests, membership proofs and their check.

Rows are leaves, the leaves of a group make a tree of runs of 16, the roots of the
groups make one more tree. Inner nodes are kept as records digest -> children; a
proof descends from the root by the base-16 digits of the leaf's place, fetches
the record of each digest on the way, collects the children that it does not
choose, and turns the collected segments round at the end. Requests with a common
prefix descend as one row, so a proof's upper part is fetched once for all leaves
below it; texts are read once and never shuffled.

Results for awkward input: a null field is ``-``; an empty text is ``0:``; a null
group is a group of its own and goes first; rows of one key (a null key goes
first) stand in the order of their leaves, and equal rows are equal leaves at
neighbouring places; an empty table has no root and no rows; other columns do not
matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicksieve.llm.common import keep_table
from clicksieve.operators.ranks import number_rows

# Fixed value: nodes in a run, a power of two.
RUN = 16
_BITS = RUN.bit_length() - 1
# Runs of 16 over 2^60 leaves; a place is a long.
_MAX_HEIGHT = 15


def field_text(value: Column) -> Column:
    """What a field adds to a leaf: ``-`` if null, else its UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field_text(f) for f in fields]).cast("binary"), 256)


def _join_digests(children: Column) -> Column:
    return F.sha2(F.array_join(children, "").cast("binary"), 256)


def _above(place: Column, levels: int) -> Column:
    return F.shiftright(place, _BITS * levels)


@dataclass(frozen=True)
class Forest:
    """Trees of runs: nodes by level (tree, place, digest, children, height); level 0 is the leaves."""

    levels: list[DataFrame]

    def roots(self) -> DataFrame:
        """(tree, digest, height) of each tree; a lone leaf is its own root."""
        tops = [n.filter(F.col("height") == k).select("tree", "digest", "height") for k, n in enumerate(self.levels)]
        return reduce(DataFrame.unionByName, tops)

    def records(self, level: int) -> DataFrame:
        """Content-addressed records of a level: one (digest, children) for each digest."""
        return self.levels[level].groupBy("digest").agg(F.first("children").alias("children"))


def height_of(leaves: Column) -> Column:
    """Levels of runs over so many leaves."""
    return sum(((leaves > RUN ** k).cast("int") for k in range(_MAX_HEIGHT)), F.lit(0))


def grow(leaves: DataFrame) -> Forest:
    """Trees over written leaves (tree, place, digest, height), places from 0 without gaps."""
    levels = [leaves]
    for level in range(1, (leaves.agg(F.max("height")).first()[0] or 0) + 1):
        runs = levels[-1].filter(F.col("height") >= level).groupBy("tree", "height", _above(F.col("place"), 1).alias("up")).agg(
            F.array_sort(F.collect_list(F.struct("place", "digest"))).alias("run"))
        nodes = runs.select("tree", F.col("up").alias("place"), "height", F.col("run.digest").alias("children"))
        levels.append(keep_table(nodes.withColumn("digest", _join_digests(F.col("children"))), f"merkle-{level}"))
    return Forest(levels)


def descend(forest: Forest, starts: DataFrame, requests: DataFrame) -> DataFrame:
    """The requests with the digest found at their place and the segments on the way to it.

    ``starts`` has (tree, digest, height, path), the roots to start from with the
    segments above them; ``requests`` has (tree, place) and what else is to come
    along. A segment holds the digests left and right of the chosen child; ``path``
    lists them from the top down.
    """
    carried = [c for c in requests.columns if c not in ("tree", "place")]
    front, found = None, []
    for level in range(len(forest.levels) - 1, -1, -1):
        begun = starts.filter(F.col("height") == level).select("tree", F.lit(0).cast("bigint").alias("at"), "digest", "path")
        front = begun if front is None else front.unionByName(begun)
        if level == 0:
            break
        asked = requests if level == 1 else requests.select("tree", _above(F.col("place"), level - 1).alias("place")).distinct()
        asked = asked.withColumnRenamed("tree", "_tree").withColumn("_up", _above(F.col("place"), 1))
        here = front.join(forest.records(level), "digest")
        digit = F.col("place").bitwiseAND(F.lit(RUN - 1)).cast("int")
        left, right = F.slice("children", 1, digit), F.slice("children", digit + 2, RUN)
        segment = F.struct(F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right"))
        chosen = here.join(asked, (here["tree"] == asked["_tree"]) & (here["at"] == asked["_up"])).select(
            "tree", F.col("place").alias("at"), F.get("children", digit).alias("digest"),
            F.concat("path", F.array(segment)).alias("path"), *(carried if level == 1 else []))
        if level == 1:
            found.append(chosen.select("tree", F.col("at").alias("place"), "digest", "path", *carried))
            front = None
        else:  # written, so that a proof's plan is as short as one level
            front = keep_table(chosen, f"front-{level}")
    lone = begun.drop("at").withColumnRenamed("tree", "_tree")
    found.append(requests.join(lone, requests["tree"] == lone["_tree"]).select("tree", "place", "digest", "path", *carried))
    return reduce(DataFrame.unionByName, found)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the segments of its path, from the bottom up, lead to."""
    return F.aggregate(path, leaf, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]).cast("binary"), 256))


def siblings_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)


def _one_tree(column: str) -> Column:
    """0 for the tree of the groups, made from data so that joins on it stay joins on a key."""
    return (F.col(column) * 0).alias("tree")


@dataclass(frozen=True)
class Manifest:
    """``leaves`` (tree, place, group, key, leaf and what came along), trees of groups and the tree of their roots."""

    leaves: DataFrame
    groups: Forest
    top: Forest

    def root(self) -> str | None:
        row = self.top.roots().select("digest").first()
        return row.digest if row else None

    def proofs(self, wanted: DataFrame | None = None) -> DataFrame:
        """Rows of ``leaves`` (or of a part of them) with ``found``, ``subroot`` and ``path``, from the bottom up."""
        requests = self.leaves if wanted is None else wanted
        none = F.array().cast("array<struct<left:string,right:string>>")
        trees = requests.select("tree").distinct().select(_one_tree("tree"), F.col("tree").alias("place"))
        groups = descend(self.top, self.top.roots().withColumn("path", none), trees).select(
            F.col("place").alias("_t"), F.col("digest").alias("subroot"), "path")
        heights = self.groups.roots().select("tree", "height")
        starts = heights.join(groups, heights["tree"] == groups["_t"]).select(
            "tree", "height", F.col("subroot").alias("digest"), "path")
        below = descend(self.groups, starts, requests)
        return below.select(
            *[c for c in below.columns if c not in ("digest", "path")], F.col("digest").alias("found"),
            F.reverse("path").alias("path"))


def build_manifest(rows: DataFrame) -> Manifest:
    """The manifest of rows (group, key, leaf), ordered by key inside a group, and by group.

    Further columns come along as they are. The rows are written once; places come
    from ranges and running sums, so no task holds a group.
    """
    leaves = keep_table(rows, "leaves")
    sizes = keep_table(leaves.groupBy("group").agg(F.count(F.lit(1)).alias("n")), "groups")
    groups = number_rows(sizes, [], ["group"], "tree")
    names = groups.select(F.col("group").alias("_g"), "tree", height_of(F.col("n")).alias("height"))
    placed = number_rows(leaves, ["group"], ["key", "leaf"], "place")
    # what is known of a group meets its leaves once; hot groups are split by AQE at the join
    placed = keep_table(placed.join(names, placed["group"].eqNullSafe(names["_g"])).drop("_g"), "placed")
    trees = grow(placed.select("tree", "place", F.col("leaf").alias("digest"), "height"))
    height = height_of(F.lit(sizes.count())).alias("height")
    roots = trees.roots().select(_one_tree("tree"), F.col("tree").alias("place"), "digest", height)
    return Manifest(placed.drop("height"), trees, grow(keep_table(roots, "subroots")))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, nothing else changed."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def audit(docs: DataFrame) -> DataFrame:
    """Every document with its proof, and the check of a copy in which some texts were changed.

    Documents whose unsigned crc32 of the decimal id is divisible by 5 are tampered
    with: A-Z of the text in lower case (a null id or text is left as it is). The
    root folded from the tampered leaf and the original siblings equals ``root``
    only if the leaf did not change. Columns: doc_id, leaf, subroot, root,
    proof_sha256, folded_root, verified, then ``tampered``.
    """
    text = F.col("text")
    struck = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    fields = lambda t: [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), t]
    rows = docs.select(
        F.col("source").alias("group"), F.col("doc_id").alias("key"), leaf_digest(fields(text)).alias("leaf"),
        F.when(struck, leaf_digest(fields(lower_ascii(text)))).alias("other"), struck.alias("tampered"))
    manifest = build_manifest(rows)
    root = F.lit(manifest.root()).cast("string")
    roots = manifest.groups.roots().select(F.col("tree").alias("_t"), F.col("digest").alias("subroot"))
    proofs = manifest.proofs()
    out = proofs.select(
        "tree", F.col("key").alias("doc_id"), F.col("found").alias("leaf"), siblings_digest(F.col("path")).alias("proof_sha256"),
        fold(F.coalesce("other", "found"), F.col("path")).alias("folded_root"), "tampered")
    return out.join(roots, out["tree"] == roots["_t"]).select(
        "doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == root).alias("verified"), "tampered")
