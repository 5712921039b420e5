"""Token ids in binary shards with a minimal perfect hash from document key to place.

A shard is a payload of raw ids (unsigned, little-endian, 16 bits where the vocabulary allows, else
32), in ascending key order, and an index beside it. The index's hash is built in levels: a key
that falls alone on a bit of its level's bit field takes that bit, the others go on to the next
level; a bit's rank over all levels is the key's slot, so n keys use slots 0 to n - 1. A slot holds
a 32-bit fingerprint of its key and the number of its record, so a foreign key is refused.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import files
from .common import new_path, partitions, slices, small_batches, written
from .tokens import encoder, with_end


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes of 64-bit keys (the finaliser of SplitMix64 over key and seed)."""
    x = keys.astype(np.int64).view(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Slots 0 to n - 1 for n different keys."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.field = np.unpackbits(bits)[: int(self.starts[-1])] if len(sizes) else np.zeros(0, np.uint8)
        self.ranks = np.cumsum(self.field, dtype=np.int64) - self.field

    @staticmethod
    def build(keys: np.ndarray, gamma: float = 2.0) -> PerfectHash:
        left, sizes, fields = keys, [], []
        while len(left):
            size = max(64, int(gamma * len(left)))
            at = (mix(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            fields.append(alone)
            left = left[~alone[at]]
        return PerfectHash(np.array(sizes, np.int64), np.packbits(np.concatenate(fields)) if fields else np.zeros(0, np.uint8))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 where no level has it (a foreign key may also get a slot)."""
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            at = (mix(keys[todo], level) % np.uint64(size)).astype(np.int64) + self.starts[level]
            hit = self.field[at] == 1
            out[todo[hit]] = self.ranks[at[hit]]
            todo = todo[~hit]
        return out


class Shard:
    """One shard opened for keyed access."""

    def __init__(self, path: str):
        with np.load(io.BytesIO(files.get(path + ".index"))) as z:
            self.keys, self.named, self.starts, self.width = z["keys"], z["named"], z["starts"], int(z["width"])
            self.hash = PerfectHash(z["sizes"], z["bits"])
            self.prints, self.records = z["prints"], z["records"]
        self.path = path

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The record number of each key (of repeated keys the first record), -1 for keys that are not here."""
        slot = self.hash.slots(keys)
        ok = slot >= 0
        ok[ok] = self.prints[slot[ok]] == (mix(keys[ok], 97) >> np.uint64(32)).astype(np.uint32)
        return np.where(ok, self.records[np.where(ok, slot, 0)] if len(self.records) else -1, -1)

    def payload(self) -> np.ndarray:
        return np.frombuffer(files.get(self.path + ".ids"), "<u2" if self.width == 2 else "<u4")

    def ids(self, key: int) -> np.ndarray | None:
        """One document's ids, read from its place alone."""
        n = int(self.find(np.array([key], np.int64))[0])
        if n < 0:
            return None
        system, path = files.place(self.path + ".ids")
        with system.open_input_file(path) as f:
            f.seek(int(self.starts[n]) * self.width)
            return np.frombuffer(f.read(int(self.starts[n + 1] - self.starts[n]) * self.width), "<u2" if self.width == 2 else "<u4")


def write(docs: DataFrame, folder: str, vocabulary: str, end_id: int = 2, roll_mb: int = 64, remembered: int = 500_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes whole texts and writes the shards; returns the manifest, a table in the shared folder.

    Rows are range partitioned and sorted by key (then by the text's hash, for repeated keys), so shards follow one
    another in ascending key order; a task rolls to the next shard after ``roll_mb`` of payload.
    A null text is empty and still gets the end id. Rows with a null key stand first and are in no
    index. Rows of one key may stand in several shards. Texts of any length go whole into one shard. Extra columns aren't read, and an
    empty table gives an empty manifest. The manifest row (part, seq, path, first, n, tokens) is what a reader trusts.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text"))
    # The sampling pass sends keys and hashes, no text, to the driver; rows of one key, or of none, are dealt to many tasks.
    rows = rows.withColumn("h", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(partitions(spark), "key", "h", "row").sortWithinPartitions("key", "h", "row").select("key", "text", F.spark_partition_id().alias("part"))

    def save(path: str, keys: list, ends: list, data: list, width: int) -> None:
        named = np.array([k is not None for k in keys])
        ids = np.array([k if k is not None else 0 for k in keys], np.int64)
        distinct, first = np.unique(ids[named], return_index=True)
        first = np.flatnonzero(named)[first]
        perfect = PerfectHash.build(distinct)
        slot = perfect.slots(distinct)
        prints, records = np.zeros(len(distinct), np.uint32), np.zeros(len(distinct), np.int64)
        prints[slot], records[slot] = (mix(distinct, 97) >> np.uint64(32)).astype(np.uint32), first
        files.put(path + ".ids", data)
        out = io.BytesIO()
        np.savez(out, keys=ids, named=named, starts=np.concatenate([[0], np.cumsum(ends)]).astype(np.int64), width=width, sizes=perfect.sizes, bits=perfect.bits, prints=prints, records=records)
        files.put(path + ".index", [out.getvalue()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(vocabulary, remembered)
        kind = "<u2" if max(e.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
        keys, ends, data, size, seq, part, made = [], [], [], 0, 0, 0, []

        def roll() -> None:
            nonlocal keys, ends, data, size, seq
            path = f"{folder}/shard-{part:06d}-{seq:05d}"
            save(path, keys, ends, data, int(kind[2]))
            made.append({"part": part, "seq": seq, "path": path, "first": next((k for k in keys if k is not None), None), "n": len(keys), "tokens": sum(ends)})
            keys, ends, data, size, seq = [], [], [], 0, seq + 1

        for batch in batches:
            for lo, hi in slices(batch.column("text"), 1 << 20):
                cutting = batch.slice(lo, hi - lo)
                ids, n = with_end(*e.encode(cutting.column("text")), end_id)
                part = cutting.column("part")[0].as_py()
                keys += cutting.column("key").to_pylist()
                ends += n.tolist()
                data.append(ids.astype(kind).tobytes())
                size += len(data[-1])
                if size >= roll_mb << 20:
                    roll()
        if keys:
            roll()
        if made:
            yield pa.RecordBatch.from_pylist(made, pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), ("first", pa.int64()), ("n", pa.int64()), ("tokens", pa.int64())]))

    with small_batches(spark):
        return written(rows.mapInArrow(run, "part int, seq int, path string, first long, n long, tokens long"), "manifest")


def read(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every stored document, from the files.

    Each key goes through the hash index to its record; repeated keys and null keys, which the
    index can't tell apart, are taken at their own places. start counts the ids of all documents
    before; the sums before each shard are taken over the manifest, a row for each file. An empty manifest gives an empty result.
    """
    spark = manifest.sparkSession
    order = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.withColumn("before", F.coalesce(F.sum("tokens").over(order), F.lit(0))).repartition(max(partitions(spark), min(manifest.count(), 20_000)), "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["path"])
                ids = shard.payload()
                at = np.arange(len(shard.keys))
                found = shard.find(shard.keys[shard.named])
                same = shard.keys[found] == shard.keys[shard.named] if len(found) else found
                if len(found) and ((found < 0).any() or not same.all()):
                    raise ValueError(f"the index of {row['path']} misses a key")
                single = np.bincount(found, minlength=len(at)) if len(found) else np.zeros(len(at), np.int64)
                at[shard.named] = np.where(single[found] == 1, found, at[shard.named]) if len(found) else at[shard.named]
                lo, hi = shard.starts[at], shard.starts[at + 1]
                wide = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(wide[a:b]) for a, b in zip((4 * lo).tolist(), (4 * hi).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(shard.keys, mask=~shard.named), pa.array(row["before"] + lo), pa.array(hi - lo), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.select("path", "before").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def new_folder(docs: DataFrame) -> str:
    return new_path(docs.sparkSession, "tokens")
