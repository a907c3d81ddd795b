"""The prefix trie of conversations, with totals of every subtree.

Turns become two 64-bit hashes at the scan; texts never move. A prefix is the xor
of its turns' hashes, each taken with its place, so it is a running value that
merges: prefixes come from running xors over blocks of places, and no task holds a
conversation. Nodes are prefixes counted with partial sums.

Totals are passed up by time-forward processing. A node's weight is the number of
(member, place) pairs below it; nodes fall into bands of weight, and a shard is what
hangs below the topmost ancestor in the band. A task reads its shards in reverse
level order from Spark's external sort; a node takes what its children sent from a
priority queue that spills sorted runs, and sends its own totals to its parent. What
leaves a shard is summed by parent and starts the next band, until the root. A node
with one member needs no message: its subtree is a chain that saves nothing.

Results for awkward input: rows without conversation id are left out; a null role
or text is empty; turns go by number, null first, and equal numbers by the hashes of
role and text, so equal rows may repeat; an empty table has no nodes; other columns
do not matter. Prefixes are told apart by 128 bits.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicksieve.llm.common import keep_table
from clicksieve.operators.ranks import number_rows

# Places in a block of a conversation.
BLOCK = 1024
# Weight of the shards of the first band, and how much heavier each next band is.
SHARD_WEIGHT = 4096
BAND_FACTOR = 256
# Messages that a queue holds before it spills, and characters of ids in one piece.
QUEUE_ROWS = 200_000
PIECE_CHARS = 65_536
ID = ["depth", "a", "b"]
PARENT = ["up", "pa", "pb"]


# prefixes ---------------------------------------------------------------------

def conversation_turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, place, t1, t2, chars) of every turn, places from 0."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    turns = rows.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("conv"), F.col(turn).alias("turn"), F.xxhash64(*said).alias("t1"),
        F.xxhash64(F.lit("second"), *reversed(said)).alias("t2"), F.length(said[1]).cast("bigint").alias("chars"))
    placed = number_rows(keep_table(turns, "turns"), ["conv"], ["turn", "t1", "t2"], "place")
    return keep_table(placed.drop("turn"), "placed-turns")


def share_heads(turns: DataFrame, span: int = 100, heads: int = 6) -> DataFrame:
    """Turns (conv, depth, t1, t2, chars, length) of conversations that start with another's first turns.

    Conversation c takes the first h turns of c - c % span, h = crc32(c) % heads, then
    its own turns after its first h. The remainder has the sign of c, as in SQL. Each
    conversation adds a row of depth 0.
    """
    convs = turns.groupBy("conv").agg((F.max("place") + 1).alias("n")).withColumns({
        "base": F.col("conv") - F.col("conv") % span,
        "h": F.crc32(F.col("conv").cast("string").cast("binary")) % heads})
    bases = convs.select(F.col("conv").alias("_c"), F.col("n").alias("_n"))
    taken = F.least("h", F.coalesce("_n", F.lit(0)))
    convs = keep_table(convs.join(bases, convs["base"] == bases["_c"], "left").select(
        "conv", "base", "h", taken.alias("m"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "conversations")
    said = ["t1", "t2", "chars"]
    own = turns.join(convs, "conv").filter(F.col("place") >= F.col("h")).select(
        "conv", (F.col("place") - F.col("h") + F.col("m") + 1).alias("depth"), *said, "length")
    first = turns.filter(F.col("place") < heads).withColumnRenamed("conv", "_c")
    head = convs.join(first, convs["base"] == first["_c"]).filter(F.col("place") < F.col("m")).select(
        "conv", (F.col("place") + 1).alias("depth"), *said, "length")
    zero = F.lit(0).cast("bigint")
    start = convs.select("conv", zero.alias("depth"), *[zero.alias(c) for c in said], "length")
    return own.unionByName(head).unionByName(start)


def prefixes(turns: DataFrame) -> DataFrame:
    """Every prefix of every conversation: (conv, depth, a, b, up, pa, pb, chars, length)."""
    at = lambda *c: F.when(F.col("depth") > 0, F.xxhash64("depth", *c)).otherwise(F.lit(0).cast("bigint"))
    rows = turns.withColumns({
        "x": at(F.col("t1"), F.col("t2")), "y": at(F.lit("second"), F.col("t2"), F.col("t1")),
        "block": F.floor(F.col("depth") / BLOCK)})
    inside = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("conv", "block").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    shifts = blocks.select(
        F.col("conv").alias("_c"), F.col("block").alias("_b"), F.bit_xor("x").over(before).alias("_x"),
        F.bit_xor("y").over(before).alias("_y")).filter(F.col("_b") > 0)
    rows = rows.withColumns({"p": F.bit_xor("x").over(inside), "q": F.bit_xor("y").over(inside)})
    rows = rows.join(shifts, (rows["conv"] == shifts["_c"]) & (rows["block"] == shifts["_b"]), "left")
    none = F.lit(0).cast("bigint")
    a, b = F.col("p").bitwiseXOR(F.coalesce("_x", none)), F.col("q").bitwiseXOR(F.coalesce("_y", none))
    return rows.select(
        "conv", "depth", a.alias("a"), b.alias("b"), (F.col("depth") - 1).alias("up"), a.bitwiseXOR(F.col("x")).alias("pa"),
        b.bitwiseXOR(F.col("y")).alias("pb"), "chars", "length")


# time-forward processing ------------------------------------------------------

class SpillingQueue:
    """Messages (depth, a, b) -> (leaves, saved) in the order of a reverse level walk.

    The deepest key comes first. Beyond ``limit`` messages the queue sums those of one
    key and writes them, sorted, to an unnamed file of the task, which is read back
    in blocks; a task that dies leaves nothing behind and starts anew.
    """

    _record = struct.Struct("<5q")

    def __init__(self, limit: int = QUEUE_ROWS):
        self.limit, self.heap, self.runs, self.heads = limit, [], [], []

    def push(self, depth: int, a: int, b: int, leaves: int, saved: int) -> None:
        heapq.heappush(self.heap, (-depth, a, b, leaves, saved))
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        file = tempfile.TemporaryFile()
        key, leaves, saved = None, 0, 0
        for *k, n, s in [*sorted(self.heap), (None, None, None, 0, 0)]:
            if k != key:
                if key is not None:
                    file.write(self._record.pack(*key, leaves, saved))
                key, leaves, saved = k, 0, 0
            leaves, saved = leaves + n, saved + s
        file.seek(0)
        self.heap = []
        self.runs.append(self._read(file))
        self._advance(len(self.runs) - 1)

    def _read(self, file) -> Iterator[tuple]:
        with file:
            while block := file.read(self._record.size * 4096):
                yield from self._record.iter_unpack(block)

    def _advance(self, run: int) -> None:
        head = next(self.runs[run], None)
        if head is not None:
            heapq.heappush(self.heads, (head, run))

    def take(self, depth: int, a: int, b: int) -> tuple[int, int]:
        """Sums of the messages to a node; those to earlier nodes must be taken before."""
        key, leaves, saved = (-depth, a, b), 0, 0
        while self.heap and self.heap[0][:3] == key:
            *_, n, s = heapq.heappop(self.heap)
            leaves, saved = leaves + n, saved + s
        while self.heads and self.heads[0][0][:3] == key:
            head, run = heapq.heappop(self.heads)
            leaves, saved = leaves + head[3], saved + head[4]
            self._advance(run)
        return leaves, saved


_TOTALS = pa.schema([(c, pa.int64()) for c in (*ID, *PARENT, "leaves", "saved")] + [("out", pa.bool_())])


def forward_totals(limit: int = QUEUE_ROWS) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Totals of the nodes of a task's shards, which come in reverse level order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(limit)
        for batch in batches:
            cols = {c: batch.column(c).to_pylist() for c in (*ID, *PARENT, "leaves", "saved", "out")}
            leaves, saved = [], []
            for d, a, b, up, p, q, n, s, out in zip(*cols.values()):
                more, extra = queue.take(d, a, b)
                n, s = n + more, s + extra
                if not out:
                    queue.push(up, p, q, n, s)
                leaves.append(n)
                saved.append(s)
            cols["leaves"], cols["saved"] = leaves, saved
            yield pa.RecordBatch.from_pydict(cols, schema=_TOTALS)

    return run


def _key_join(left: DataFrame, right: DataFrame, names: list[str], how: str) -> DataFrame:
    """Join ``names`` of the left with ID of the right; the left names stay."""
    other = right.withColumnsRenamed({c: f"_{c}" for c in ID})
    return left.join(other, [left[n] == other[f"_{c}"] for n, c in zip(names, ID)], how).drop(*[f"_{c}" for c in ID])


def subtree_totals(shared: DataFrame, paths: DataFrame, queue_rows: int = QUEUE_ROWS) -> DataFrame:
    """(depth, a, b, n_leaves, saved_tokens) of nodes with several members.

    ``shared`` has ID, PARENT, conv_id, weight, and the node's own ``leaves`` and
    ``saved``; ``paths`` has (conv, ID) of the conversations that name the nodes.
    """
    top = shared.agg(F.max("weight")).first()[0]
    if top is None:
        return shared.select(*ID, F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    limits = [SHARD_WEIGHT]
    while limits[-1] < top:
        limits.append(limits[-1] * BAND_FACTOR)
    named = shared.select(F.col("conv_id").alias("_rep")).distinct()
    met = _key_join(paths.join(named, paths["conv"] == named["_rep"], "left_semi"), shared.select(*ID, "weight"), ID, "inner")
    cuts = met.groupBy(F.col("conv").alias("_conv")).agg(*[
        F.min(F.when(F.col("weight") <= w, F.struct(*ID))).alias(f"cut{k}") for k, w in enumerate(limits)])
    band = reduce(lambda acc, w: acc + (F.col("weight") > w).cast("int"), limits, F.lit(0))
    nodes = keep_table(shared.withColumn("band", band).join(cuts, F.col("conv_id") == F.col("_conv")).withColumn(
        "shard", F.array(*[F.col(f"cut{k}") for k in range(len(limits))])[F.col("band")]).select(
        *ID, *PARENT, "leaves", "saved", "band", "shard"), "trie-shared")
    done, sent = [], None
    for k in range(len(limits)):
        here = nodes.filter(F.col("band") == k)
        if sent is not None:
            got = _key_join(here, sent, ID, "left")
            here = got.withColumns({c: F.col(c) + F.coalesce(f"got_{c}", F.lit(0)) for c in ("leaves", "saved")})
        here = here.withColumn("out", (F.col("shard.depth") == F.col("depth")) & (F.col("shard.a") == F.col("a")) & (
            F.col("shard.b") == F.col("b")))
        ordered = here.repartition("shard").select(*ID, *PARENT, "leaves", "saved", "out").sortWithinPartitions(
            F.desc("depth"), "a", "b")
        schema = ", ".join(f"{c} long" for c in (*ID, *PARENT, "leaves", "saved")) + ", out boolean"
        done.append(keep_table(ordered.mapInArrow(forward_totals(queue_rows), schema), f"trie-band-{k}"))
        sent = reduce(DataFrame.unionByName, done).filter("out").groupBy(
            F.col("up").alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(
            F.sum("leaves").alias("got_leaves"), F.sum("saved").alias("got_saved"))
    return reduce(DataFrame.unionByName, done).select(
        *ID, F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))


# digests of members -----------------------------------------------------------

def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (ID, conv) as texts of ids: (ID, first id, text)."""
    key, ids, size, rows = None, [], 0, []
    schema = pa.schema([*[(c, pa.int64()) for c in (*ID, "first")], ("ids", pa.string())])

    def close():
        if ids:
            rows.append((*key, ids[0], ",".join(map(str, ids))))

    for batch in batches:
        for d, a, b, conv in zip(*(batch.column(c).to_pylist() for c in (*ID, "conv"))):
            if key != (d, a, b) or size > PIECE_CHARS:
                close()
                key, ids, size = (d, a, b), [], 0
            ids.append(conv)
            size += 20
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
            rows = []
    close()
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces as one digest per node; only the state of one digest is held."""
    key, state = None, None
    schema = pa.schema([*[(c, pa.int64()) for c in ID], ("digest", pa.string())])
    for batch in batches:
        rows = []
        for d, a, b, ids in zip(*(batch.column(c).to_pylist() for c in (*ID, "ids"))):
            if key == (d, a, b):
                state.update(b"," + ids.encode())
                continue
            if key is not None:
                rows.append((*key, state.hexdigest()))
            key, state = (d, a, b), hashlib.sha256(ids.encode())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*key, state.hexdigest()), schema.types)], schema=schema)


def ends_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ids (ID, conv) of each node, ascending and joined by commas.

    Ranges of (node, id) become pieces of text in parallel. A digest is sequential,
    so the pieces of a node, thousands of ids each, pass through one task in order.
    """
    ids = ", ".join(f"{c} long" for c in ID)
    pieces = keep_table(ends, "ends").repartitionByRange(*ID, "conv").sortWithinPartitions(*ID, "conv").mapInArrow(
        _pieces, f"{ids}, first long, ids string")
    return pieces.repartition(*ID).sortWithinPartitions(*ID, "first").mapInArrow(_digests, f"{ids}, digest string")


# the trie ---------------------------------------------------------------------

def prefix_trie(turns: DataFrame, queue_rows: int = QUEUE_ROWS) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv, depth, t1, t2, chars, length).

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.
    """
    paths = keep_table(prefixes(turns), "prefixes")
    here = F.col("depth") == F.col("length")
    nodes = keep_table(paths.groupBy(*ID, *PARENT).agg(
        F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"), F.count(F.when(here, 1)).alias("n_ends"),
        F.min(F.when(here, F.col("conv"))).alias("end"), F.max("length").alias("length")), "nodes")
    single = F.col("n_convs") == 1
    below = nodes.filter(F.col("depth") > 0).groupBy(
        F.col("up").alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(
        F.count(F.lit(1)).alias("n_children"), F.count(F.when(single, 1)).alias("n_single"))
    none = F.lit(0).cast("bigint")
    many = _key_join(nodes.filter(~single), below, ID, "left").withColumns({
        "n_children": F.coalesce("n_children", none), "saved": (F.col("n_convs") - 1) * F.col("chars"),
        "leaves": F.when(F.coalesce("n_children", none) == 0, F.lit(1).cast("bigint")).otherwise(F.coalesce("n_single", none))})
    shared = keep_table(many, "shared")
    totals = subtree_totals(shared, paths.select("conv", *ID), queue_rows)
    several = shared.filter(F.col("n_ends") > 1).select(*ID)
    digests = ends_digests(_key_join(paths.filter(here).select("conv", *ID), several, ID, "left_semi"))
    shared = _key_join(_key_join(shared, totals, ID, "left"), digests, ID, "left")
    chains = nodes.filter(single).withColumns({
        "n_children": (F.col("depth") < F.col("length")).cast("bigint"), "n_leaves": F.lit(1).cast("bigint"),
        "saved_tokens": none, "digest": F.lit(None).cast("string")})
    names = [*ID, *PARENT, "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "n_ends", "end", "digest"]
    rows = shared.select(names).unionByName(chains.select(names))
    parents = nodes.filter(~single).select(*ID, F.col("conv_id").alias("_above"))
    rows = _key_join(rows, parents, PARENT, "left")
    listed = F.when(F.col("n_ends") == 0, F.sha2(F.lit("").cast("binary"), 256)).when(
        F.col("n_ends") == 1, F.sha2(F.col("end").cast("string").cast("binary"), 256)).otherwise(F.col("digest"))
    return rows.select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("_above", "conv_id")).alias("parent_conv_id"), "n_convs",
        "n_children", "n_leaves", "saved_tokens", listed.alias("ends_sha256"))
