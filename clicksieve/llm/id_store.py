"""Token ids on disk, reached by document key in constant time.

A store is a folder of shards and a table of them. A shard holds the documents of
one range of keys, in key order, as two files:

``*.ids``  the ids of all its documents, one after the other, as little-endian
           unsigned integers of 2 or 4 bytes; nothing else.
``*.mph``  numpy archive: keys and offsets in document order, and a minimal
           perfect hash of the distinct keys. ``shift`` holds one number per
           bucket of keys; with it a key leads to its own slot among exactly as
           many slots as keys. A slot stores a fingerprint of its key, by which
           an absent key is told, and the place of the key's first document.

Each task writes under a name of its own and only names that a task returned get
into the table of shards, so a task that runs twice leaves no trace.
"""

from __future__ import annotations

import io
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

END_ID = 2
REMEMBERED = 700_000  # encoded words in a generation of what a worker remembers
ENDS = b".,!?;:*#$%&"  # no apostrophe: with letters behind it, it is a piece of its own
SHORT = 48  # bytes of a word worth remembering
PER_BUCKET = 2  # keys per bucket of the hash, on average
SHARDS = "id int, name string, first long, last long, docs long, tokens long, width int"


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    x = (x + np.uint64(seed & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys, by hashing and shifting buckets.

    Buckets take their slots from the largest to the smallest: each tries shifts
    until all its keys fall on free slots. Buckets of one key come last and name
    their slot outright, as a negative shift.
    """

    def __init__(self, shift: np.ndarray, size: int):
        self.shift, self.size = shift, size

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        n = len(keys)
        buckets = max(1, n // PER_BUCKET)
        shift = np.zeros(buckets, np.int64)
        if n:
            bucket = (_mix(keys, 1) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            sizes = np.bincount(bucket, minlength=buckets)
            ends = np.cumsum(sizes)
            free = np.ones(n, bool)
            base = _mix(keys, 2)
            for b in np.argsort(-sizes, kind="stable"):
                if sizes[b] < 2:
                    break
                own = base[order[ends[b] - sizes[b]:ends[b]]]
                tried = 0
                while True:
                    tries = np.arange(tried, tried + 64, dtype=np.uint64)
                    at = (_mix(own[None, :] ^ _mix(tries, 3)[:, None], 4) % np.uint64(n)).astype(np.int64)
                    ok = free[at].all(1)
                    for t in np.flatnonzero(ok):
                        if len(np.unique(at[t])) == sizes[b]:
                            shift[b] = tried + t
                            free[at[t]] = False
                            break
                    else:
                        tried += 64
                        continue
                    break
            alone = np.flatnonzero(sizes == 1)
            shift[alone] = -1 - np.flatnonzero(free)[:len(alone)]
        return cls(shift, n)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; an absent key gets some slot. There must be a key at all."""
        s = self.shift[(_mix(keys, 1) % np.uint64(len(self.shift))).astype(np.int64)]
        at = _mix(_mix(keys, 2) ^ _mix(s.astype(np.uint64), 3), 4) % np.uint64(self.size)
        return np.where(s < 0, -1 - s, at.astype(np.int64))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, 5) >> np.uint64(32)).astype(np.uint32)


class Words(dict):
    """Packed ids of words; a word asked for the first time is encoded.

    A tokenizer that ends a run of letters at punctuation gives a word and such an
    end the ids they have apart, so both may be known already.
    """

    def __init__(self, tokenizer, dtype: np.dtype):
        super().__init__()
        self.tokenizer, self.dtype = tokenizer, dtype
        self.older: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            start = word.rstrip(ENDS)
            if start and len(start) < len(word) and start[-1:].isalnum() and b"<|" not in word:
                ids = self[start] + self[word[len(start):]]
            else:
                ids = np.array(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids, self.dtype).tobytes()
        if len(word) <= SHORT:
            self[word] = ids
        return ids

    def age(self) -> None:
        """Forget what the last two generations did not meet."""
        if len(self) > REMEMBERED:
            self.older = dict(self)
            self.clear()


class WordEncoder:
    """Ids of whole texts with a tokenizer that never looks across blanks.

    Pieces between ASCII blanks are encoded once and remembered, in lower case as
    the tokenizer takes them. Its pattern drops white space and matches none, so
    joined pieces give the ids of the whole text.
    """

    def __init__(self, tokenizer: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        own = Tokenizer.from_file(tokenizer)
        self.dtype = np.dtype("<u2") if own.get_vocab_size(with_added_tokens=True) <= 1 << 16 else np.dtype("<u4")
        self.words = Words(own, self.dtype)

    def encode(self, text: str | None) -> bytes:
        raw = (text or "").encode("utf-8", "replace")
        # special tokens are found before lower case, so what may hold one stays as it is
        words = raw.lower().split() if b"<|" not in raw else [w if b"<|" in w else w.lower() for w in raw.split()]
        ids = b"".join(map(self.words.__getitem__, words))
        self.words.age()
        return ids


@lru_cache(maxsize=2)
def encoder(tokenizer: str) -> WordEncoder:
    return WordEncoder(tokenizer)


def write_store(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                end_id: int = END_ID) -> None:
    """Encode all texts and write them in ascending order of their integer ids.

    Null and empty texts have the end id alone. Rows with a null id come first and
    can be scanned but not looked up. Rows that share an id follow each other in
    the order of their texts' hashes and are looked up together. An empty table
    gives a store without shards. Only the shuffle by ranges moves texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own = encoder(tokenizer)
        store, folder = filesystem(path)
        name = uuid.uuid4().hex
        end = np.array([end_id], own.dtype).tobytes()
        keys, sizes = [], []
        out = None
        for batch in batches:
            if out is None:
                store.create_dir(folder, recursive=True)
                out = store.open_output_stream(f"{folder}/{name}.ids")
            for text in batch.column(1):
                ids = own.encode(text.as_py()) + end
                out.write(ids)
                sizes.append(len(ids) // own.dtype.itemsize)
            keys.append(batch.column(0))
        if out is None:
            return
        out.close()
        column = pa.chunked_array(keys).combine_chunks()
        has_key = column.is_valid().to_numpy(zero_copy_only=False)
        key = column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        places = np.flatnonzero(has_key)
        distinct, first, runs = np.unique(key[places], return_index=True, return_counts=True)
        mph = PerfectHash.build(distinct.astype(np.uint64))
        mark, place, run = (np.zeros(len(distinct), t) for t in (np.uint32, np.int64, np.int64))
        if len(distinct):
            slot = mph.slots(distinct.astype(np.uint64))
            mark[slot], place[slot], run[slot] = fingerprints(distinct.astype(np.uint64)), places[first], runs
        held = io.BytesIO()
        np.savez(held, keys=key, has_key=has_key, offsets=np.cumsum([0] + sizes), shift=mph.shift,
                 mark=mark, place=place, run=run)
        with store.open_output_stream(f"{folder}/{name}.mph") as f:
            f.write(held.getvalue())
        yield pa.RecordBatch.from_pylist([{
            "id": TaskContext.get().partitionId(), "name": name, "docs": len(key), "tokens": sum(sizes),
            "first": int(distinct[0]) if len(distinct) else None, "last": int(distinct[-1]) if len(distinct) else None,
            "width": own.dtype.itemsize}], pa.schema([
                ("id", pa.int32()), ("name", pa.string()), ("first", pa.int64()), ("last", pa.int64()),
                ("docs", pa.int64()), ("tokens", pa.int64()), ("width", pa.int32())]))

    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, SHARDS) \
        .write.parquet(f"{path}/shards")


class Shard:
    """An open shard: its ids and the perfect hash that leads into them."""

    def __init__(self, path: str, name: str, width: int):
        store, folder = filesystem(path)
        with store.open_input_file(f"{folder}/{name}.mph") as f:
            index = np.load(io.BytesIO(f.read()))
            self.keys, self.has_key, self.offsets = index["keys"], index["has_key"], index["offsets"]
            self.mph = PerfectHash(index["shift"], len(index["mark"]))
            self.mark, self.place, self.run = index["mark"], index["place"], index["run"]
        self.dtype = np.dtype(f"<u{width}")
        self.file = store.open_input_file(f"{folder}/{name}.ids")

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first document of each key, -1 for absent ones, and how many it has."""
        if not self.mph.size:
            return np.full(len(keys), -1), np.zeros(len(keys), np.int64)
        k = keys.astype(np.uint64)
        slot = self.mph.slots(k)
        place = self.place[slot]
        found = (self.mark[slot] == fingerprints(k)) & (self.keys[place] == keys)
        return np.where(found, place, -1), np.where(found, self.run[slot], 0)

    def ids(self, place: int) -> np.ndarray:
        start, end = (int(self.offsets[place + i]) * self.dtype.itemsize for i in (0, 1))
        return np.frombuffer(self.file.read_at(end - start, start), self.dtype)


def _digest(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def scan_store(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, each found through the index.

    ``start`` counts the ids of all documents before it in the store.
    """
    shards = spark.read.schema(SHARDS).parquet(f"{path}/shards")
    before = Window.partitionBy(F.lit(0)).orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    based = shards.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    based = based.repartition(max(1, shards.count()), "id").select("name", "width", "base")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(path, row["name"], row["width"])
                place, _ = shard.find(shard.keys)
                twin = np.arange(len(place)) - place
                # a key's documents follow its first one; those without a key are scanned
                place = np.where(shard.has_key, place + twin, np.arange(len(place)))
                for k in range(0, len(place), 5000):
                    some = place[k:k + 5000]
                    ids = [shard.ids(int(p)) for p in some]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(shard.keys[some], pa.int64(), mask=~shard.has_key[some]),
                        pa.array(row["base"] + shard.offsets[some], pa.int64()),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([_digest(x) for x in ids], pa.int64())], ["id", "start", "n_tokens", "ids_crc32"])

    return based.mapInArrow(run, "id long, start long, n_tokens long, ids_crc32 long")


def lookup(keys: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, ids) of the stored documents with the given keys; absent keys give no row.

    The ranges of the shards, 24 bytes and a name for each, go to every task; they
    tell a key its shard. Keys then meet at their shards, each is found there in
    constant time, and only its own ids are read.
    """
    rows = sorted(keys.sparkSession.read.schema(SHARDS).parquet(f"{path}/shards").filter("first is not null")
                  .select("id", "first", "last", "name", "width").collect())
    first, last = (np.array([r[c] for r in rows], np.int64) for c in ("first", "last"))
    names, widths = [r.name for r in rows], [r.width for r in rows]
    wanted = keys.select(F.col(id_col).cast("long").alias("id")).filter("id is not null").distinct()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            lo, hi = np.searchsorted(last, ids, "left"), np.searchsorted(first, ids, "right")
            some = np.repeat(np.arange(len(ids)), np.maximum(hi - lo, 0))
            shard = np.concatenate([np.arange(a, b) for a, b in zip(lo, hi)] or [[]]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(ids[some], pa.int64()), pa.array(shard, pa.int32())], ["id", "shard"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, shard = None, None
        for batch in batches:
            out_ids, out = [], []
            for key, number in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if number != at:
                    at, shard = number, Shard(path, names[number], widths[number])
                place, count = shard.find(np.array([key]))
                for i in range(int(count[0])):
                    out_ids.append(key)
                    out.append(shard.ids(int(place[0]) + i).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(out_ids, pa.int64()), pa.array(out, pa.list_(pa.int64()))], ["id", "ids"])

    return wanted.mapInArrow(assign, "id long, shard int").repartition("shard").sortWithinPartitions("shard", "id") \
        .mapInArrow(read, "id long, ids array<long>")
