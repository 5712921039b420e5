"""Language identification by error-correcting output codes over hashed letter n-grams.

Every language gets a codeword; for every bit a linear classifier tells from a text's n-grams whether
the bit is set. Decoding adds up each language's weighted logistic losses over the bits and takes the
smallest; a text whose two best languages are close is flagged as ambiguous.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_text, written

DIM = 2048


def has_letter(text: str | None) -> bool:
    """Whether a character of a letter category (L*) is there; numerals such as ½ or ⅷ are none."""
    return bool(text) and any(map(str.isalpha, text))


def features(text: str, dim: int = DIM) -> np.ndarray:
    """Square roots of the shares of hashed byte 1-, 2- and 3-grams of the lower-cased whole text, at unit length."""
    data = np.frombuffer(b" " + text.lower().encode("utf-8", "replace") + b" ", np.uint8).astype(np.uint32)
    letter = (data > 96) & (data < 123) | (data > 127)
    data = np.where(letter, data, np.uint32(32))
    pair = data[:-1] * np.uint32(257) + data[1:]
    triple = pair[:-1] * np.uint32(257) + data[2:]
    spread = lambda g, seed: ((g * np.uint32(2654435761) + np.uint32(seed)) >> np.uint32(7)) % np.uint32(dim)
    counts = np.bincount(spread(data, 1), minlength=dim) + np.bincount(spread(pair, 2), minlength=dim) + np.bincount(spread(triple, 3), minlength=dim)
    root = np.sqrt(counts.astype(np.float32))
    return root / max(1e-9, float(np.linalg.norm(root)))


def codewords(n: int, bits: int) -> np.ndarray:
    """n rows of ``bits`` signs, every bit set for some languages and not for others, far apart: the best of many draws."""
    draw, best, far = np.random.default_rng(7), None, -1
    for _ in range(200):
        code = draw.choice([-1.0, 1.0], (n, bits))
        same = np.abs(code.sum(0)) == n
        code[0, same] *= -1
        apart = ((bits - code @ code.T) / 2 + np.eye(n) * bits).min() if n > 1 else bits
        if apart > far:
            best, far = code, apart
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each row the language's number, its score, and the gap to the second."""
        margin = x @ self.weights + self.bias
        loss = np.stack([(self.trust * np.logaddexp(0, -margin * c)).sum(1) for c in self.code], 1)
        share = np.exp(loss.min(1, keepdims=True) - loss)
        share /= share.sum(1, keepdims=True)
        best = share.argmax(1)
        ordered = np.sort(share, 1)
        gap = ordered[:, -1] - (ordered[:, -2] if share.shape[1] > 1 else 0)
        return best, share[np.arange(len(x)), best], gap


def fit(x: np.ndarray, y: np.ndarray, languages: list[str], bits: int = 15, rounds: int = 120, l2: float = 1e-4) -> Model:
    """All bits' logistic classifiers at once, by Adam over the whole sample; trust is a bit's mean likelihood there."""
    code = codewords(len(languages), bits)
    target = code[y]
    w, b = np.zeros((x.shape[1], bits), np.float32), np.zeros(bits, np.float32)
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)
    size = np.bincount(y, minlength=len(languages))
    weight = (1.0 / np.maximum(1, size))[y].astype(np.float32)
    weight /= weight.sum()
    for k in range(1, rounds + 1):
        z = np.clip(target * (x @ w + b), -30, 30)
        d = (-target / (1 + np.exp(z)) * weight[:, None]).astype(np.float32)
        g, gb = x.T @ d + l2 * w, d.sum(0)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        w -= 0.3 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
        b -= 0.3 * (mb / (1 - 0.9**k)) / (np.sqrt(vb / (1 - 0.99**k)) + 1e-8)
    likely = 1 / (1 + np.exp(-np.clip(target * (x @ w + b), -30, 30)))
    return Model(languages, code, w, b, (likely * weight[:, None]).sum(0))


def held_out(id_col: str = "doc_id", fold: int = 3, rest: int = 1):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % fold == rest, F.lit(False))


def train(docs: DataFrame, per_language: int = 1000, max_rows: int = 40_000, least: int = 8, max_languages: int = 4096, bits: int = 15, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Fits on about ``per_language`` rows of each language outside the held-out fold, chosen by a hash of id and text.

    Up to ``max_languages`` languages are learned, where there are more those with the most rows. Where there are more than
    ``max_rows`` / ``per_language`` of them each gets its part of about ``max_rows`` rows, but ``least`` in any case; a row takes 8 KB on
    the driver. Of equal rows one counts. Rows with a null id, text or language, and texts without letters teach nothing;
    texts of any length are taken whole. None without any row.
    """
    known = docs.where(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}") & ~held_out(id_col))
    known = known.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(id_col, text_col).alias("h"))
    counts = written(known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages), "languages")
    many = counts.count()
    if not many:
        return None
    want = max(least, min(per_language, max_rows // many))
    point = F.shiftrightunsigned("h", 11).cast("double") / F.lit(float(1 << 53))
    sample = known.join(F.broadcast(counts), "lang").where(point * F.col("n") < want).dropDuplicates(["lang", "h"])  # at most max_languages rows
    found = map_text(sample, "text", ["id", "lang"], "x binary", lambda texts: {"x": pa.array([features(t).tobytes() for t in texts], pa.binary())}).collect()
    found.sort(key=lambda r: (r[0], r[1], r.x))
    if not found:
        return None
    languages = sorted({r[1] for r in found})
    number = {k: i for i, k in enumerate(languages)}
    x = np.frombuffer(b"".join(r.x for r in found), np.float32).reshape(len(found), -1)
    return fit(x, np.array([number[r[1]] for r in found]), languages, max(bits, 3 * int(np.ceil(np.log2(len(languages) + 1)))))


def predict(docs: DataFrame, model: Model | None, gap: float = 0.1, keep: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous) and the columns in ``keep`` for each row.

    ``und`` with score 0 for null texts and those without a letter, and for all without a model;
    ambiguous where the best two scores differ by less than ``gap``; of equal scores the first language in alphabetical order wins. Repeated rows come back as often; a null id is never
    held out; columns of any name may be kept, but clash with those added. An empty table gives an empty result.
    """

    def each(texts: list) -> dict:
        lang, score, unsure = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        some = [i for i, t in enumerate(texts) if has_letter(t)] if model else []
        for k in range(0, len(some), 512):
            part = some[k : k + 512]
            best, share, apart = model.decode(np.stack([features(texts[i]) for i in part]))
            for i, b in zip(part, best, strict=True):
                lang[i] = model.languages[b]
            score[part], unsure[part] = share, apart < gap
        return {"lang_pred": pa.array(lang, pa.string()), "score": score, "ambiguous": unsure}

    kept = list(dict.fromkeys([id_col, *(keep or [])]))
    made = map_text(docs, text_col, kept, "lang_pred string, score double, ambiguous boolean", each)
    return made.select(*kept, held_out(id_col).alias("held_out"), "lang_pred", "score", "ambiguous")
