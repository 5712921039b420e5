"""Quality scores by histogram gradient-boosted trees over document statistics.

The trees are fitted in numpy on a bounded sample of labelled rows (``max_train``), on statistics
binned by quantiles. The fitted forest is three arrays (feature, threshold, value) of complete
trees, which a task walks for all rows of a batch at once.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_text, written

COUNTED = "!|?.,:;#*&%$@/\\<>{}[]()=_\"'-\n\t"
WORD = re.compile(r"\S+")
BASIC = ("log_chars", "log_words", "word_length", "longest_word", "upper", "digit", "alpha", "space", "not_ascii", "distinct", "top_word", "repeat", "pairs", "lines", "line_distinct", "line_words", "short", "common", "packed", "capital", "sentence")
NAMES = BASIC + tuple(f"char_{ord(c)}" for c in COUNTED)


def statistics(text: str | None, common: frozenset[str] = frozenset()) -> np.ndarray:
    """The statistics of one whole text, in the order of NAMES; an empty or null text has zeros."""
    out = np.zeros(len(NAMES), np.float32)
    if not text or not text.strip():
        return out
    n, found = len(text), text.split()
    w = len(found)
    lower = text.lower().split()
    counts = Counter(lower)
    data = text.encode("utf-8", "replace")
    raw = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    lines = [x for x in text.split("\n") if x.strip()]
    upper, digit, letters = int(raw[65:91].sum()), int(raw[48:58].sum()), int(raw[65:91].sum() + raw[97:123].sum() + raw[192:].sum())
    out[: len(BASIC)] = (
        math.log1p(n), math.log1p(w), n / w, max(map(len, found)), upper / max(1, letters), digit / n, letters / n, int(raw[32] + raw[9] + raw[10] + raw[13]) / n, int(raw[128:].sum()) / len(data), len(counts) / w,
        counts.most_common(1)[0][1] / w, sum(map(str.__eq__, lower, lower[1:])) / w, len(set(zip(lower, lower[1:], strict=False))) / max(1, w - 1), math.log1p(len(lines)), len(set(lines)) / max(1, len(lines)), w / max(1, len(lines)),
        sum(len(x) <= 3 for x in found) / w, sum(c for x, c in counts.items() if x in common) / w, len(zlib.compress(data, 1)) / len(data), sum(map(str.isupper, found)) / w, w / (1 + int(raw[46] + raw[33] + raw[63])),
    )
    out[len(BASIC) :] = [raw[ord(c)] / n for c in COUNTED]
    return out


@dataclass
class Forest:
    """Complete trees of one depth: node i's children are 2i + 1 and 2i + 2; a row goes right if its value exceeds the threshold."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float
    common: frozenset[str]

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        depth = int(math.log2(self.value.shape[1] if len(self.value) else 1))
        for f, t, v in zip(self.feature, self.threshold, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            total += v[at - (len(v) - 1)]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 120, depth: int = 4, rate: float = 0.1, bins: int = 64, l2: float = 1.0, least: float = 2.0, common: frozenset[str] = frozenset()) -> Forest:
    """Logistic boosting; each level takes for every node the best cut of its gradient histograms."""
    if not len(y):
        return Forest(np.zeros((0, 0), int), np.zeros((0, 0)), np.zeros((0, 1)), 0.0, common)
    rate_1 = float(np.clip(y.mean(), 0.5 / len(y), 1 - 0.5 / len(y)))
    base = math.log(rate_1 / (1 - rate_1))
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) for k in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(cuts)], 1)
    margin, rows, width = np.full(len(y), base), np.arange(len(y)), x.shape[1]
    features, thresholds, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        f, t, b = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf), np.full(2**depth - 1, bins)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, n = 2**level - 1, 2**level
            flat = ((node - first)[:, None] * width + np.arange(width)) * bins + binned
            hist_g = np.bincount(flat.ravel(), np.repeat(g, width), n * width * bins).reshape(n, width, bins)
            hist_h = np.bincount(flat.ravel(), np.repeat(h, width), n * width * bins).reshape(n, width, bins)
            gl, hl = hist_g.cumsum(2)[:, :, :-1], hist_h.cumsum(2)[:, :, :-1]
            gt, ht = hist_g.sum(2, keepdims=True), hist_h.sum(2, keepdims=True)
            gain = gl**2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt**2 / (ht + l2)
            gain[(hl < least) | (ht - hl < least)] = 0
            for k, best in enumerate(gain.reshape(n, -1).argmax(1)):
                column, cut = divmod(int(best), bins - 1)
                if gain[k, column, cut] > 1e-6 and cut < len(cuts[column]):
                    f[first + k], t[first + k], b[first + k] = column, cuts[column][cut], cut
            node = 2 * node + 1 + (binned[rows, f[node]] > b[node])
        leaf = node - (2**depth - 1)
        value = -rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + l2)
        margin += value[leaf]
        features.append(f)
        thresholds.append(t)
        values.append(value)
    return Forest(np.array(features), np.array(thresholds), np.array(values), base, common)


def held_out(id_col: str = "doc_id", fold: int = 5, rest: int = 0):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % fold == rest, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_train: int = 12_000, common_words: int = 200, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Forest:
    """Fits on at most ``max_train`` labelled documents outside the held-out fold, those with the smallest hashes of id and text.

    Labels of repeated ids are averaged, null labels and null ids left out. Equal rows count once, and texts that share an id are
    documents of their own, so no id brings more rows than others and the driver never gets more than ``max_train`` rows of
    statistics. Null, empty and blank texts have statistics of zero; texts of any length are taken whole. Columns beside those
    named aren't read. The most frequent words of a tenth of the sample serve as one statistic. Without labels, or
    with empty tables, every score is 0.5.
    """
    own = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col)).groupBy(id_col).agg(F.avg(label_col).alias("_y"))
    texts = docs.select(id_col, text_col, F.pmod(F.xxhash64(id_col, text_col), F.lit(1 << 62)).alias("_h"))
    known = texts.join(own, id_col)
    # Which hashes belong to the sample is found without the texts; the share taken first leaves about a fifth more than is wanted.
    keys = texts.select(id_col, "_h").join(own.select(id_col), id_col, "left_semi").select("_h").distinct()
    n = keys.count()
    share = min(1 << 62, int(2**62 * (1.2 * max_train + 100) / max(1, n)))
    last = keys.where(F.col("_h") < share).orderBy("_h").limit(max_train).agg(F.max("_h")).first()[0]
    rows = written(known.where(F.col("_h") <= (-1 if last is None else last)).dropDuplicates([id_col, "_h"]), "sample")
    words = F.array_distinct(F.split(F.lower(F.coalesce(text_col, F.lit(""))), r"\s+"))
    frequent = rows.where(F.pmod(F.xxhash64(id_col), F.lit(10)) == 3).select(F.explode(words).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).where("w <> ''").orderBy(F.desc("n"), "w").limit(common_words).collect()
    common = frozenset(r.w for r in frequent)
    found = map_text(rows, text_col, [id_col, "_y"], "x binary", lambda texts: {"x": pa.array([statistics(t, common).tobytes() for t in texts], pa.binary())}).collect()
    found.sort(key=lambda r: (r[0], r.x))  # the order rows arrive in must not matter
    if not found:
        return fit(np.zeros((0, len(NAMES))), np.zeros(0), common=common)
    x = np.frombuffer(b"".join(r.x for r in found), np.float32).reshape(len(found), -1)
    return fit(x, np.array([r._y for r in found]), common=common)


def score(docs: DataFrame, forest: Forest, threshold: float = 0.3, keep: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) and the columns in ``keep`` for each row.

    A null text scores as an empty one, texts of any length are taken whole, and equal texts get equal scores. Repeated rows come back
    as often; a null id is never held out. Extra columns aren't read, those in ``keep`` must not be named like one that
    is added. An empty table gives an empty result.
    """

    def each(texts: list) -> dict:
        x = np.stack([statistics(t, forest.common) for t in texts])
        return {"score": forest.score(x)}

    kept = list(dict.fromkeys([id_col, *(keep or [])]))
    scored = map_text(docs, text_col, kept, "score double", each)
    return scored.select(*kept, held_out(id_col).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
