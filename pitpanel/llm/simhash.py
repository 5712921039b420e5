"""SimHash near-duplicates through tables of distances to many reference fingerprints.

A fingerprint's row in the pivot table holds its Hamming distances to reference fingerprints. Two
fingerprints that differ in at most ``bits`` bits differ by at most ``bits`` in every coordinate,
so a pair is discarded by its largest coordinate difference, from coordinates kept beside the
fingerprint (packed in one number), and only what is left is verified by the fingerprints.

The references are a base code and the base with its first 2, 4, ... 64 bits turned over. The
difference of two neighbouring coordinates depends on two bits only, so the 32 differences
fall into bands that depend on bits of their own, and of m bands at least m - bits agree. Pairs
meet by the coordinates of every choice of m - bits bands; m grows with the number of different
fingerprints, so that cells stay small. Random reference codes alone could not deal pairs out:
a 64-bit code's distances to them all lie near 32, and every coordinate keeps a third of all pairs.

A cell with more than ``cell`` fingerprints is not paired. Its fingerprints take an exact path that
makes no pairs: each is listed under itself and its one-bit neighbours, and two that differ in
at most two bits share an entry, of at most 65 owners each.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_text, written
from .graph import connected_components

WORD = re.compile(r"[^\x20\x09-\x0d]+")
LOWER = {i: i + 32 for i in range(65, 91)}
BASE = 0x9E3779B97F4A7C15
ONE_BIT = [1 << k if k < 63 else -(1 << 63) for k in range(64)]
REFERENCES = np.array([BASE ^ ((1 << 2 * k) - 1) for k in range(33)], np.uint64)


def words(text: str | None) -> list[str]:
    return WORD.findall(text.translate(LOWER)) if text else []


def shingles(found: list[str], size: int) -> list[str]:
    """All runs of ``size`` words, repeats included; of fewer words the whole sequence, of none nothing."""
    if len(found) <= size:
        return [" ".join(found)] if found else []
    return list(map(" ".join, zip(*(found[i:] for i in range(size)), strict=False)))


def fingerprint(grams: list[str]) -> int:
    """64 bits, each set if it is set in over half of the grams' XXH64 (seed 42); 0 for no gram."""
    if not grams:
        return 0
    total = np.zeros(64, np.int64)
    for k in range(0, len(grams), 65536):
        h = np.array([xxhash.xxh64_intdigest(g, 42) for g in grams[k : k + 65536]], "<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > len(grams), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp long) for each row; a null, empty or blank text has fingerprint 0."""

    def each(texts: list) -> dict:
        fps = np.array([fingerprint(shingles(words(t), shingle)) for t in texts], np.uint64)
        return {"fp": pa.array(fps.view(np.int64))}

    return map_text(docs, text_col, [id_col], "fp long", each)


def bands_for(n: int, bits: int) -> int:
    """Bands so that a cell of n random fingerprints holds about one; a band's two-bit coordinates carry 1.5 bits each."""
    for m in (*range(bits + 2, 9), 16):
        if m > bits and n < 2 ** (48 * (m - bits) // m):
            return m
    return 16


def coordinates(table: np.ndarray) -> np.ndarray:
    """Every fourth distance of the pivot table's rows, 7 bits each, in one number."""
    kept = table[:, 4::4]
    return (kept << (7 * np.arange(kept.shape[1]))).sum(1)


def largest_difference(x: Column, y: Column) -> Column:
    """The largest coordinate difference of two packed rows of the pivot table."""
    return F.greatest(*(F.abs(F.shiftright(x, 7 * k).bitwiseAND(F.lit(127)) - F.shiftright(y, 7 * k).bitwiseAND(F.lit(127))) for k in range(len(REFERENCES[4::4]))))


def cells(fps: DataFrame, bands: int, bits: int) -> DataFrame:
    """A row (cell, fp, rep, coordinates) for each choice of bands - bits bands of the pivot table's differences."""
    edges = [round(32 * k / bands) for k in range(bands + 1)]
    choices = list(combinations(range(bands), bands - bits))

    def run(batches):
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            table = np.bitwise_count(fp[:, None] ^ REFERENCES[None, :]).astype(np.int64)
            digit = (np.diff(table, axis=1) + 2) // 2
            out = []
            for k, choice in enumerate(choices):
                cell = np.full(len(fp), k, np.int64)
                for b in choice:
                    for j in range(edges[b], edges[b + 1]):
                        cell = cell * 3 + digit[:, j]
                out.append(cell)
            n = len(choices)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(out)), pa.array(np.tile(fp.view(np.int64), n)), pa.array(np.tile(batch.column("rep").to_numpy(zero_copy_only=False), n)), pa.array(np.tile(coordinates(table), n))], names=["cell", "fp", "rep", "coordinates"]
            )

    return fps.select("fp", "rep").mapInArrow(run, "cell long, fp long, rep long, coordinates long")


def links(fps: DataFrame, bits: int = 2, cell: int = 64, folder: str | None = None) -> DataFrame:
    """Edges (a, b) between representatives, whose components are those of all links of at most ``bits`` bits; ``folder`` takes the cells."""
    if bits not in (1, 2):
        raise ValueError("bits must be 1 or 2: the path for full cells covers two bits")
    dealt = written(cells(fps, bands_for(fps.count(), bits), bits), "cells", folder)
    full = dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    small = dealt.join(full.where(F.col("n") <= cell), "cell").select("cell", "fp", "rep", "coordinates")
    x, y = small.alias("x"), small.alias("y")
    close = largest_difference(F.col("x.coordinates"), F.col("y.coordinates")) <= bits
    pairs = x.join(y, (F.col("x.cell") == F.col("y.cell")) & (F.col("x.fp") < F.col("y.fp")) & close & (F.bit_count(F.expr("x.fp ^ y.fp")) <= bits)).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))

    crowded = dealt.join(full.where(F.col("n") > cell), "cell").select("fp", "rep").distinct()
    near = crowded.select("fp", "rep", F.explode(F.array(F.col("fp"), *(F.col("fp").bitwiseXOR(F.lit(bit)) for bit in ONE_BIT))).alias("spot"))
    if bits == 1:  # an entry that two one-bit neighbours share would be two bits apart: only its owner counts
        owner = crowded.select(F.col("fp").alias("spot"), F.col("rep").alias("b"))
    else:
        owner = near.groupBy("spot").agg(F.min("rep").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1").select("spot", "b")
    return pairs.unionByName(near.join(owner, "spot").select(F.col("rep").alias("a"), "b").where("a <> b"))


def near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 2, cell: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id) for each row of ``docs``.

    fingerprint is 16 lower-case hex digits; component_id the smallest id reachable by links.
    Texts without words have fingerprint zero and link like any other; equal fingerprints are one
    class from the start and are never paired. Repeated rows come back as often as they came in.
    A null id is carried through, with a component only if another row of its class has an id. Texts of any
    length are taken whole. Only the two columns named are read, so others can't clash. An empty table gives an empty result.
    """
    fps = written(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    classes = written(fps.groupBy("fp").agg(F.min(id_col).alias("rep")), "classes")
    found = connected_components(links(classes.where("rep is not null"), bits, cell))
    named = classes.join(found, classes.rep == found.node, "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return fps.join(named, "fp").select(id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
