"""Vector best-fit packing of documents into token sequences.

A piece asks for tokens, one document and length squared of attention. All three follow from its
length, so pieces of one length are interchangeable: the plan is made over the histogram of
lengths (at most ``capacity`` rows, whatever the corpus), and places whole runs of equal bins at
once. Longest first, a piece goes to the open bin that is best by ``score`` among those with room
in every dimension:

* ``norm``: the smallest weighted norm of what is left after the piece is in,
* ``dot``: the largest weighted dot-product of demand and residual.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, numbered, slices, small_batches, written
from .tokens import encoder, forget, with_end


def pieces(docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 2, remembered: int = 500_000, keep: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids with ``end_id`` behind, cut if longer than ``capacity``.

    Only the first piece of a cut document may be shorter than the capacity. A null text is empty, a text of any length is encoded
    whole, repeated rows and ids have pieces of their own. Extra columns aren't read; an empty table gives an empty result.
    ``keep`` leaves what the encoder remembers to the worker's next task.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column("text"), 1 << 20):
                part = batch.slice(lo, hi - lo)
                ids, n = with_end(*encoder(vocabulary, remembered).encode(part.column("text")), end_id)
                number = -(-n // capacity)
                of = np.repeat(np.arange(len(n)), number)
                piece = np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number)
                head = n - (number - 1) * capacity  # the length of a document's first piece
                length = np.where(piece == 0, head[of], capacity)
                start = np.where(piece == 0, 0, head[of] + (piece - 1) * capacity)
                data, at = memoryview(ids.tobytes()), 4 * ((np.cumsum(n) - n)[of] + start)
                crc = [zlib.crc32(data[a:b]) for a, b in zip(at.tolist(), (at + 4 * length).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("key").take(pa.array(of)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())], names=names)
        if not keep:
            forget()
        give_back()

    rows = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def plan(counts: dict[int, int], capacity: tuple[int, int, int], weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3), score: str = "norm") -> np.ndarray:
    """Runs (length, rank, n, bin, offset): the pieces rank to rank + n - 1 of a length go to bins bin, bin + 1, ... at offset.

    ``capacity``: most tokens, documents and attention (sum of squared lengths) of a bin. Bins of
    equal load form a class, kept as ranges of bin numbers; a piece fills its best bin as long
    as it fits, so a step fills many bins of one class alike.
    """
    cap, w = np.array(capacity, float), np.array(weights, float)
    loads: dict[tuple[int, int, int], list[list[int]]] = {}
    runs, bins = [], 0

    def fit(load: tuple[int, int, int], need: tuple[int, int, int]) -> int:
        return min((c - u) // d for c, u, d in zip(capacity, load, need, strict=True))

    def fill(load, start: int, n: int, layers: int, length: int, rank: int, need) -> int:
        for k in range(layers):
            runs.append((length, rank, n, start, load[0] + k * length))
            rank += n
        now = tuple(u + layers * d for u, d in zip(load, need, strict=True))
        loads.setdefault(now, []).append([start, n])
        return rank

    for length in sorted(counts, reverse=True):
        need, left, rank = (length, 1, length * length), counts[length], 0
        if fit((0, 0, 0), need) < 1:
            raise ValueError(f"a piece of {length} ids fits no empty bin")
        while left:
            room = [(u, f) for u in loads if (f := fit(u, need)) > 0]
            if not room:
                n = -(-left // fit((0, 0, 0), need))
                loads[(0, 0, 0)] = [[bins, n]]
                bins += n
                continue
            u = np.array([x for x, _ in room], float)
            rest = (cap - u - np.array(need)) / cap
            best = np.argmin((w * rest**2).sum(1)) if score == "norm" else np.argmax((w * (np.array(need) / cap) * ((cap - u) / cap)).sum(1))
            load, most = room[int(best)]
            start, n = loads[load][-1]
            # With norm the bin just filled stays the best one for the next piece; with dot an emptier one of its class is,
            # but for new bins, which are opened one by one when nothing else fits.
            layers = min(most, left) if score == "norm" or load == (0, 0, 0) else 1
            take = min(n, left // layers)
            rank = fill(load, start, take, layers, length, rank, need)
            left -= take * layers
            if take < n:
                loads[load][-1] = [start + take, n - take]
            else:
                loads[load].pop()
                if not loads[load]:
                    del loads[load]
    return np.array(runs, np.int64).reshape(-1, 5)


#: Scorings that ``pack`` tries.
SCORINGS = (("norm", (1.0, 1e-3, 1e-3)), ("dot", (1.0, 1e-3, 1e-3)), ("norm", (1.0, 1.0, 1.0)))


def fewest(counts: dict[int, int], capacity: tuple[int, int, int], scorings: tuple = SCORINGS) -> np.ndarray:
    """The plan with the fewest bins over the scorings (kind, weights), of equal ones the first; none after one that fills all bins but the last."""
    best, used, least = None, 0, -(-sum(k * n for k, n in counts.items()) // capacity[0])
    for kind, weights in scorings:
        runs = plan(counts, capacity, weights, kind)
        n = int((runs[:, 2] + runs[:, 3]).max(initial=0))
        if best is None or n < used:
            best, used = runs, n
        if used <= least:
            break
    return best


def pack(made: DataFrame, capacity: int = 1024, documents: int | None = None, attention: int | None = None, scorings: tuple = SCORINGS) -> DataFrame:
    """``made`` (from ``pieces``) with sequence_id and offset, by the scoring that takes the fewest sequences.

    ``documents`` and ``attention`` (sum of squared lengths) bound what else a sequence may hold; None leaves them to the
    tokens. A full piece alone takes capacity squared of attention, so that bound can't be lower where pieces are full.
    The order of equal lengths is doc_id, piece, start: repeated rows keep places of their own. An empty table gives an empty result.
    """
    with small_batches(made.sparkSession):
        made = written(made, "pieces")
    counts = {r.length: r.n for r in made.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = fewest(counts, (capacity, documents or capacity, attention or capacity**2), scorings)
    lengths = sorted(counts)
    base = dict(zip(lengths, np.concatenate([[0], np.cumsum([counts[x] for x in lengths])[:-1]]).tolist() if lengths else [], strict=False))
    first = np.array([base[x] for x in runs[:, 0]], np.int64) + runs[:, 1] if len(runs) else np.zeros(0, np.int64)
    order = np.argsort(first)
    first, bin_at, offset = first[order], runs[order, 3], runs[order, 4]

    columns = list(made.columns)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("_at").to_numpy(zero_copy_only=False)
            k = np.searchsorted(first, at, side="right") - 1
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(bin_at[k] + at - first[k]), pa.array(offset[k])], names=[*columns, "sequence_id", "offset"])

    placed = numbered(made, ["length", "doc_id", "piece", "start", "ids_crc32"], "_at")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in made.schema.fields)
    return placed.mapInArrow(place, f"{fields}, sequence_id long, offset long")
