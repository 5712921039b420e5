"""Token ids of whole texts by the tokenizers library.

Byte-level BPE never merges across the pieces of its pattern, so each different piece needs the
library only once in a worker; what it answers is remembered up to a bound. numpy parts all texts
of a slice at once by the kinds of their characters, Arrow makes the pieces distinct, and only the
distinct ones are looked up. Texts that spell a special token or hold a character whose kind Unicode
settled late, and all texts of a vocabulary file with other parting rules, go to the library whole.
"""

from __future__ import annotations

import gc
import json
import os
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import bytes_of

#: Kinds of characters in the ByteLevel rule of the tokenizers library; UNSURE ones are left to it.
OTHER, LETTER, DIGIT, SPACE, BLANK, UNSURE = range(6)
#: What the rule parts from a word after an apostrophe.
SUFFIXES = ("s", "t", "re", "ve", "m", "ll", "d")
#: How the vocabulary writes the byte of a space (the byte's number moved past 256).
SPACE_BYTE = chr(256 + 32)


@cache
def kinds() -> np.ndarray:
    """Each character's kind; UNSURE where Unicode 3.2 did not know it or saw it otherwise than today."""
    old = unicodedata.ucd_3_2_0.category

    def kind(c: str, category: str) -> int:
        return LETTER if category[0] == "L" else DIGIT if category[0] == "N" else BLANK if category[0] == "Z" else OTHER

    table = np.full(0x110000, UNSURE, np.uint8)
    for n in range(0x110000):
        c = chr(n)
        then = old(c)
        if then not in ("Cn", "Co", "Cs") and kind(c, then) == kind(c, unicodedata.category(c)):
            table[n] = kind(c, then)
    table[9:14], table[32] = BLANK, SPACE
    table[[0x1C, 0x1D, 0x1E, 0x1F, 0x85]] = UNSURE  # white space to some, not to others
    return table


def byte_kinds(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The kind, by a table of all characters, of the character that each byte of valid UTF-8 belongs to."""
    out = np.append(table[:128], np.zeros(128, np.uint8))[data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        first = data[lead].astype(np.int64)
        width = 2 + (first >= 0xE0) + (first >= 0xF0)
        code = first & np.array([0, 0, 0x1F, 0x0F, 0x07])[width]
        for k in (1, 2, 3):
            own = width > k
            code[own] = code[own] << 6 | (data[lead[own] + k] & 0x3F)
        kind = table[code]
        for k in (0, 1, 2, 3):
            own = width > k
            out[lead[own] + k] = kind[own]
    return out


def piece_starts(data: np.ndarray, kind: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where pieces begin, in order; ``starts`` are the first bytes of texts that are not empty.

    A run of letters, digits or other characters is a piece, with one space before it if there is one.
    White space that is followed by something else leaves its last character to stand alone or
    with what follows. An apostrophe alone takes one of SUFFIXES from the letters behind it.
    """
    blank = kind >= SPACE
    run = np.where(blank, np.uint8(BLANK), kind)
    begins = np.append(True, run[1:] != run[:-1])
    begins[starts] = True
    opens = np.zeros(len(data), bool)
    opens[starts] = True
    at = np.flatnonzero(begins & ~blank)
    inside = at[~opens[at]]  # runs that follow something in their text
    inside = inside[blank[inside - 1]]
    last = inside - 1
    for _ in range(3):
        last = np.where(data[last] & 0xC0 == 0x80, last - 1, last)
    marks = begins
    marks[last] = True
    marks[inside[kind[last] == SPACE]] = False

    quote = np.flatnonzero(data[:-1] == 39)
    if len(quote):
        quote = quote[marks[quote] & (kind[quote + 1] == LETTER) & ~opens[quote + 1]]
        for suffix in SUFFIXES:
            n = len(suffix)
            own = quote[quote + n < len(data)]
            hit = np.ones(len(own), bool)
            for k, c in enumerate(suffix.encode(), 1):
                hit &= (data[own + k] == c) & ~opens[own + k]
            own = own[hit]
            marks[own + 1] = False
            after = own + 1 + n
            marks[after[after < len(data)]] = True
            quote = np.setdiff1d(quote, own, assume_unique=True)
    return np.flatnonzero(marks)


class Encoder:
    """``encode(texts)``: the ids of all texts one behind the other, and each text's number of them.

    Remembers between ``remembered`` and twice as many pieces: when the newer half is full it becomes
    the older one, from which only what is asked for again moves on.
    """

    def __init__(self, path: str, remembered: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.remembered, self.known, self.older = remembered, {}, {}
        rules = json.loads(self.tokenizer.to_str())
        self.special = tuple(t["content"] for t in rules["added_tokens"])
        parting = rules["pre_tokenizer"] or {}
        own = parting.get("type") == "ByteLevel" and parting.get("use_regex") and not parting.get("add_prefix_space")
        self.parts = bool(own and not rules["normalizer"] and rules["model"]["type"] == "BPE" and not rules["model"]["dropout"])
        vocabulary = rules["model"]["vocab"] if self.parts else {}
        self.begins = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.begins[[n for t, n in vocabulary.items() if t[:1] == SPACE_BYTE]] = True
        if self.parts and hasattr(self.tokenizer.model, "_resize_cache"):
            self.tokenizer.model._resize_cache(0)  # what is asked for is new each time

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, unseen: list[str]) -> None:
        """Encodes unseen pieces: words behind a space many in one string, where only a word's first id begins with the space."""
        words, others = [], []
        for p in unseen:
            if p[:1] == " " and p[1:].isalpha():
                words.append(p)
            else:
                others.append(p)
        for k in range(0, len(words), 20_000):
            part = words[k : k + 20_000]
            ids = np.array(self.tokenizer.encode_batch_fast(["".join(part)], add_special_tokens=False)[0].ids, "<u4")
            starts = np.flatnonzero(self.begins[ids])
            if len(starts) != len(part) or starts[0] != 0:
                others += part
                continue
            data, at = ids.tobytes(), 0
            for p, end in zip(part, (4 * np.append(starts[1:], len(ids))).tolist(), strict=True):
                self.known[p] = data[at:end]
                at = end
        self.known.update(zip(others, self.whole(others), strict=True))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """A null text is empty. The collector pauses meanwhile: the many short-lived lists here hold no cycles."""
        paused = gc.isenabled()
        gc.disable()
        try:
            return self._encode(pc.fill_null(texts.cast(pa.large_string()), ""))
        finally:
            if paused:
                gc.enable()

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            each = self.whole(texts.to_pylist())
            return np.frombuffer(b"".join(each), "<u4"), np.array([len(b) // 4 for b in each], np.int64)
        strange = np.zeros(len(texts), bool)
        for s in self.special:
            strange |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        data, ends = bytes_of(texts)
        kind = byte_kinds(data, kinds())
        strange[np.searchsorted(ends, np.flatnonzero(kind == UNSURE), side="right")] = True
        if strange.any():
            data, ends = bytes_of(pc.if_else(pa.array(strange), "", texts))
            kind = byte_kinds(data, kinds())
        first = np.append(0, ends[:-1])[: len(ends)]
        if len(data):
            marks = piece_starts(data, kind, first[first < ends])
            bounds = pa.py_buffer(np.append(marks, len(data)).astype(np.int64))
            coded = pa.LargeStringArray.from_buffers(len(marks), bounds, pa.py_buffer(data)).dictionary_encode()
            of, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
            table = self.looked_up(names)
            before = np.searchsorted(marks, ends)
        else:
            of, table, before = np.zeros(0, np.int64), [], np.zeros(len(texts), np.int64)
        if strange.any():
            # A text that was encoded whole stands as one piece of its own.
            at = np.flatnonzero(strange)
            of = np.insert(of, before[at], np.arange(len(table), len(table) + len(at)))
            before = before + np.cumsum(strange)
            table = table + self.whole([texts[int(i)].as_py() for i in at])
        size = np.fromiter(map(len, table), np.int64, len(table)) // 4
        lengths = size[of]
        behind = np.cumsum(lengths)
        shift = (np.cumsum(size) - size)[of] - (behind - lengths)
        out = np.frombuffer(b"".join(table), "<u4")[np.repeat(shift, lengths) + np.arange(int(behind[-1]) if len(of) else 0)]
        upto = np.append(0, behind)[before]
        return out, np.diff(upto, prepend=0)

    def looked_up(self, names: list[str]) -> list[bytes]:
        """The ids of different pieces."""
        if len(self.known) > self.remembered:
            self.known, self.older = {}, self.known
        ids = list(map(self.known.get, names))
        unseen = [k for k, v in enumerate(ids) if v is None]
        rest = []
        for k in unseen:
            v = self.older.get(names[k])
            if v is None:
                rest.append(names[k])
            else:
                self.known[names[k]] = v
        self.learn(rest)
        for k in unseen:
            ids[k] = self.known[names[k]]
        return ids


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` behind each text."""
    out = np.empty(len(ids) + len(counts), "<u4")
    own = np.ones(len(out), bool)
    own[np.cumsum(counts + 1) - 1] = False
    out[own], out[~own] = ids, end_id
    return out, counts + 1


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, remembered: int = 500_000) -> Encoder:
    """The worker's encoder for this vocabulary file; about 100 MB at most for 500,000 remembered."""
    if (path, remembered) not in _encoders:
        _encoders[path, remembered] = Encoder(path, remembered)
    return _encoders[path, remembered]


def forget() -> None:
    """Drops the worker's encoders and all that they remember."""
    _encoders.clear()


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
