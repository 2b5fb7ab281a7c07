"""Token counts by finite-state machines compiled from a tokenizer file.

Two deterministic transducers, one after the other:

* the splitter reads classes of characters and marks where pieces begin. A chunk of a text whose entry state isn't known
  gets its state map, one exit state for each entry state; the maps compose, so a parallel prefix scan over the chunks
  gives every chunk its entry state;
* the counter reads a piece's bytes, and its transitions carry the number of tokens that they add (see bpe.py).

Nulls count as empty texts, with no token. Strings of special tokens inside a text count as one token each, as the tokenizer's
library has it by default.
"""
from __future__ import annotations

import json
import re
import sys
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import CountTransducer, Merges
from .common import as_texts, bounded_batches, fresh, record_batches
from .words import _BASE, mix

LIMIT = 2048
CHUNK = 64

# Classes of characters.
BLANK, E, L, R, V, STMD, LETTER, NUMBER, APOSTROPHE, OTHER = range(10)
# States: nothing open, in letters, in other signs, after an apostrophe that begins a piece, and after that and r, v, l.
FREE, WORD, SIGNS, QUOTE, QR, QV, QL = range(7)
HERE, BEFORE = 1, 2  # a piece begins at this character, or began at the one before

# The white space of Unicode.
WHITE = [*range(9, 14), 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of each code point."""
    out = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for i in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(i))[0]
        if kind == "L":
            out[i] = LETTER
        elif kind == "N":
            out[i] = NUMBER
    out[WHITE] = BLANK
    for c, k in (("e", E), ("l", L), ("r", R), ("v", V), ("s", STMD), ("t", STMD), ("m", STMD), ("d", STMD), ("'", APOSTROPHE)):
        out[ord(c)] = k
    return out


@lru_cache(1)
def splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next states and marks by state and class, flat: state * 10 + class."""
    to, mark = np.zeros((7, 10), np.uint8), np.zeros((7, 10), np.uint8)
    letters = (E, L, R, V, STMD, LETTER)

    def begin(c: int) -> tuple[int, int]:
        if c in letters:
            return WORD, HERE
        return {BLANK: (FREE, 0), NUMBER: (FREE, HERE), APOSTROPHE: (QUOTE, HERE), OTHER: (SIGNS, HERE)}[c]

    for c in range(10):
        sign, letter = c in (APOSTROPHE, OTHER), c in letters
        rows = {FREE: begin(c), WORD: (WORD, 0) if letter else begin(c), SIGNS: (SIGNS, 0) if sign else begin(c)}
        if c == STMD:
            rows[QUOTE] = (FREE, 0)
        elif c in (R, V, L):
            rows[QUOTE] = ({R: QR, V: QV, L: QL}[c], 0)
        else:
            rows[QUOTE] = rows[SIGNS]
        for state, end in ((QR, E), (QV, E), (QL, L)):
            s, m = rows[WORD]
            rows[state] = (FREE, 0) if c == end else (s, m | BEFORE)
        for s, (a, b) in rows.items():
            to[s, c], mark[s, c] = a, b
    return to.ravel(), mark.ravel()


def compose_scan(maps: np.ndarray) -> np.ndarray:
    """maps[i, s]: the state after chunk i from entry state s. Returns the maps of chunks 0..i, by doubling steps."""
    out, step = maps.copy(), 1
    while step < len(out):
        out[step:] = np.take_along_axis(out[step:], out[:-step].astype(np.intp), 1)
        step *= 2
    return out


def piece_starts(points: np.ndarray) -> np.ndarray:
    """True where a piece begins. points: code points, ending with a blank."""
    to, mark = splitter()
    n = len(points)
    chunks = -(-n // CHUNK)
    c = np.zeros(chunks * CHUNK, np.uint8)
    c[:n] = classes()[points]
    c = np.ascontiguousarray(c.reshape(chunks, CHUNK).T)
    maps = np.repeat(np.arange(7, dtype=np.uint8)[None], chunks, 0)
    for i in range(CHUNK):
        maps = to[maps * 10 + c[i][:, None]]
    entry = np.zeros(chunks, np.uint8)
    entry[1:] = compose_scan(maps)[:-1, FREE]
    marks, state = np.empty((CHUNK, chunks), np.uint8), entry
    for i in range(CHUNK):
        k = state * 10 + c[i]
        marks[i], state = mark[k], to[k]
    flat = marks.T.ravel()[:n]
    starts = (flat & HERE).astype(bool)
    starts[:-1] |= (flat[1:] & BEFORE).astype(bool)
    return starts


def _unicode_bytes() -> dict[str, int]:
    """The characters that stand for bytes in such files: printable ones for themselves, the rest from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Counter:
    """Counts tokens as the library does with the tokenizer file at path."""

    #: Pieces whose counts are kept in memory, twice: those met lately, and those met before these.
    KEEP = 300_000
    #: Bytes of texts that are counted at once.
    SLICE = 256 << 10

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        model, end = spec["model"], spec["model"]["end_of_word_suffix"]
        table = _unicode_bytes()

        def symbols(x: str) -> str:
            body = x.removesuffix(end)
            s = [table[c] for c in body]
            if body != x:
                s[-1] += 256
            return "".join(map(chr, s))

        special = [t["content"] for t in spec["added_tokens"]]
        ranks = {}
        for i, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            ranks[symbols(a), symbols(b)] = i
        tokens = {symbols(x) for x in model["vocab"] if x not in special}
        self.machine = CountTransducer(Merges(tokens, lambda a, b: ranks.get((a, b))))
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.known: dict[int, int] = {}
        self.older: dict[int, int] = {}

    def piece(self, text: str) -> int:
        b = text.encode()
        return self.machine.count(b[:-1].decode("latin-1") + chr(256 + b[-1]))

    @staticmethod
    def normal(text: str) -> str:
        if text.isascii():
            return text.lower()
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def count(self, texts: list[str]) -> np.ndarray:
        """The number of tokens of each text."""
        out = np.zeros(len(texts), np.int64)
        parts, owner = [], []
        for i, t in enumerate(texts):
            if self.special and "<|" in t:
                pieces = self.special.split(t)
                out[i] += len(pieces) - 1
            else:
                pieces = [t]
            parts += [self.normal(x) for x in pieces]
            owner += [i] * len(pieces)
        text = " ".join(parts) + " "
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = piece_starts(points)
        blank = classes()[points] == BLANK
        begins = np.flatnonzero(starts)
        if not len(begins):
            return out
        edge = starts | blank
        marks = np.flatnonzero(edge)
        ends = marks[np.searchsorted(marks, begins, "right")]  # the next beginning or blank
        with np.errstate(over="ignore"):
            power = np.full(int((ends - begins).max()) + 1, _BASE, np.uint64)
            power[0] = 1
            power = np.multiply.accumulate(power)
            place = np.arange(len(points)) - np.maximum.accumulate(np.where(starts, np.arange(len(points)), 0))
            place = np.where(blank, 0, np.minimum(place, len(power) - 1))
            terms = np.where(blank, np.uint64(0), mix(points.astype(np.uint64) + np.uint64(1)) * power[place])
            run = np.r_[np.uint64(0), np.cumsum(terms, dtype=np.uint64)]
            keys = mix(run[ends] - run[begins])
        distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        known, older, counts = self.known, self.older, np.empty(len(distinct), np.int64)
        for j, (k, i) in enumerate(zip(distinct.tolist(), first.tolist(), strict=True)):
            n = known.get(k)
            if n is None:
                if len(known) >= self.KEEP:
                    known, older = self.known, self.older = {}, known
                n = older.get(k)
                known[k] = n = self.piece(text[begins[i] : ends[i]]) if n is None else n
            counts[j] = n
        edges = np.cumsum([0, *(len(p) + 1 for p in parts)])
        which = np.asarray(owner)[np.searchsorted(edges, begins, "right") - 1]
        return out + np.bincount(which, counts[inverse], len(texts)).astype(np.int64)


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of each row."""
    bounded_batches(docs.sparkSession)
    i, t = fresh(docs.select(id_col), "_tokens_id", "_tokens_text")

    def run(it):
        c = counter(path)
        for b in record_batches(it, c.SLICE):
            texts = as_texts(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x.encode()) for x in texts], pa.int64()), pa.array(c.count(texts), pa.int64())], [id_col, "n_bytes", "n_tokens"])

    source = docs.select(F.col(id_col).alias(i), F.col(text_col).alias(t))
    kind = dict(docs.dtypes)[id_col]
    return source.mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
