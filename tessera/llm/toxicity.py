"""Toxicity by a weighted lexicon.

A text is folded (width and compatibility forms, lookalike letters of other scripts, digit substitutions inside words,
invisible characters) and scanned once by an Aho-Corasick automaton that holds the lexicon's word beginnings and
whole words together with exception phrases. A match inside an exception phrase doesn't count. The matches' weights are
summed and normalised by the text's length; a logistic curve over both gives the score.

Entries, weights, exceptions and the curve are learnt from labelled rows that aren't held out. Nulls count as empty
texts, which have no match. Near copies of one label count as one text in all that is learnt. With no toxic or no clean row the lexicon is empty and every score is the share of toxic rows.
"""
from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bagminhash import BANDS, ROWS, SIMILARITY, bag, signatures
from .common import as_bytes, as_texts, bounded_batches, held_out, materialise, record_batches
from .words import word_hashes

#: The most labelled rows that are learnt from: the rows with the smallest hash of their id.
SAMPLE_ROWS = 20000
THRESHOLD = 0.5
SHORTEST, LONGEST = 4, 12
#: An entry's texts are toxic this many times as often as clean.
RARER = 3

# Lookalikes of Latin letters in other scripts, and signs that stand for letters inside words.
LOOKALIKES = str.maketrans("аеорсухіјѕһԁԛԝɡαορνιτκυε", "aeopcyxijshdqwgaopvitkue")
SUBSTITUTES = str.maketrans("013457@", "oieasta")

_INVISIBLE = re.compile("[­​-‏⁠﻿]")
_MIXED = re.compile(r"(?=[^\W\d_]*[\d@])[\w@]*[^\W\d_][\w@]*")
_GAP = re.compile(r"[\W_]+")


def _letters(m: re.Match) -> str:
    x = m[0]
    return x.translate(SUBSTITUTES) if sum(c.isalpha() for c in x) * 3 >= len(x) else x


def fold(text: str) -> str:
    """Lower-case words, one blank before and after each."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", _INVISIBLE.sub("", text)).lower().translate(LOOKALIKES)
    else:
        text = text.lower()
    text = _MIXED.sub(_letters, text)
    return f" {_GAP.sub(' ', text)} "


class Lexicon:
    """entries: pattern to weight. A pattern begins with a blank; one that ends with a blank is a whole word, another the
    beginning of a longer word."""

    def __init__(self, entries: dict[str, float], exceptions: tuple[str, ...] = (), curve: tuple[float, ...] = (-4.0, 1.0, 1.0)):
        self.entries, self.exceptions, self.curve = entries, tuple(fold(x) for x in exceptions), curve
        self._automaton = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_automaton": None}

    @property
    def automaton(self) -> ahocorasick.Automaton:
        if self._automaton is None:
            a = ahocorasick.Automaton()
            for x, w in self.entries.items():
                a.add_word(x, (len(x), w, False))
            for x in self.exceptions:
                a.add_word(x, (len(x), 0.0, True))
            if len(a):
                a.make_automaton()
            self._automaton = a
        return self._automaton

    def matches(self, folded: str) -> list[tuple[int, int, float]]:
        """(begin, end, weight) of each match that no exception phrase covers; of matches with one beginning the heaviest."""
        if not len(self.automaton):
            return []
        best: dict[int, tuple[int, float]] = {}
        free: list[tuple[int, int]] = []
        for end, (n, w, exception) in self.automaton.iter(folded):
            begin = end - n + 1
            if exception:
                free.append((begin, end))
            elif (folded[end] == " " or folded[end + 1] != " ") and (begin not in best or w > best[begin][1]):
                best[begin] = (end, w)
        out, k = [], 0
        free.sort()
        reach = -1
        for begin, (end, w) in sorted(best.items()):
            while k < len(free) and free[k][0] <= begin:
                reach = max(reach, free[k][1])
                k += 1
            if end > reach:
                out.append((begin, end, w))
        return out

    def measure(self, text: str) -> tuple[float, float]:
        """Log of the summed weights, and of the weights in a thousand words."""
        folded = fold(text)
        total = sum(m[2] for m in self.matches(folded))
        return math.log1p(total), math.log1p(1000 * total / (folded.count(" ") + 20))

    def score(self, texts: list[str]) -> np.ndarray:
        x = np.array([self.measure(t) for t in texts], float).reshape(-1, 2)
        z = self.curve[0] + x @ np.array(self.curve[1:])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, ...]:
    """Logistic regression by Newton steps; slopes below 0 are not taken."""
    a, b = np.c_[np.ones(len(x)), x], np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(3)
        b = b + np.clip(np.linalg.solve(h, a.T @ (y - p) - ridge * b), -2, 2)
        b[1:] = np.maximum(b[1:], 0)
    return tuple(map(float, b))


def sample(docs: DataFrame, labels: DataFrame, rows: int, id_col: str, text_col: str) -> DataFrame:
    """(id, text, toxic) of at most rows labelled rows that aren't held out."""
    known = labels.where(F.col(id_col).isNotNull() & F.col("toxic").isNotNull() & ~held_out(id_col)).groupBy(F.col(id_col).alias("_id")).agg(F.max("toxic").alias("_toxic"))
    picked = F.broadcast(known.orderBy(F.xxhash64("_id"), "_id").limit(rows))  # at most rows ids
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(picked, "_id")


def _signatures(it):
    """The signature of each text, 32 bits of each register."""
    for b in it:
        for part in record_batches([b], 1 << 20):
            h, offsets = word_hashes(as_bytes(part.column("_text")))
            reg = signatures([bag(h[i:j])[:2] for i, j in zip(offsets[:-1], offsets[1:], strict=True)], BANDS * ROWS)
            reg = (reg.view(np.uint64) >> np.uint64(20)).astype(np.uint32)
            yield pa.RecordBatch.from_arrays([part.column("_key"), part.column("_toxic"), pa.array([r.tobytes() for r in reg], pa.binary())], ["key", "toxic", "sign"])


def groups(reg: np.ndarray, least: float = SIMILARITY) -> np.ndarray:
    """The first row of each row's group of near copies: rows that agree with the first of a band's bucket in this share of
    all registers are linked."""
    parent = np.arange(len(reg))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    bands = np.ascontiguousarray(reg).view(f"V{4 * ROWS}")
    for j in range(bands.shape[1]):
        _, first, inverse = np.unique(bands[:, j], return_index=True, return_inverse=True)
        row = np.flatnonzero(first[inverse] != np.arange(len(reg)))
        row = row[parent[row] != parent[first[inverse[row]]]]
        for i in row[(reg[row] == reg[first[inverse[row]]]).mean(1) >= least] if len(row) else ():
            x, y = find(i), find(first[inverse[i]])
            parent[max(x, y)] = min(x, y)
    return np.array([find(i) for i in range(len(reg))], np.int64)


def merged(some: DataFrame) -> DataFrame:
    """(_text, _toxic) of the sample with near copies of one label merged. Only signatures (720 bytes a text) reach the driver."""
    toxic = F.coalesce((F.col("_toxic") == 1).cast("int"), F.lit(0)).alias("_toxic")
    text = F.coalesce("_text", F.lit(""))
    distinct = materialise(some.groupBy(F.sha2(text, 256).alias("_key"), toxic).agg(F.first(text).alias("_text")), "toxicity-distinct")
    signs = distinct.mapInArrow(_signatures, "key string, toxic int, sign binary").toPandas().sort_values(["toxic", "key"])
    kept = []
    for label, part in signs.groupby("toxic"):
        reg = np.frombuffer(b"".join(part.sign), np.uint32).reshape(len(part), -1)
        kept += [(part.key.iloc[i], int(label)) for i in np.unique(groups(reg))]
    if not kept:
        return distinct
    one = some.sparkSession.createDataFrame(kept, "_key string, _toxic int")
    return materialise(distinct.join(F.broadcast(one), ["_key", "_toxic"], "left_semi").select("_text", "_toxic"), "toxicity-merged")


def _patterns(it):
    """Of each slice of a batch: how many texts of either label have this word, or a longer word with this beginning."""
    for b in record_batches(it, 1 << 19):
        count: tuple[Counter, Counter] = (Counter(), Counter())
        for text, toxic in zip(as_texts(b.column("_text")), b.column("_toxic").to_pylist(), strict=True):
            found = set()
            for w in set(fold(text).split()):
                if len(w) <= LONGEST:
                    found.add(f" {w} ")
                found.update(f" {w[:n]}" for n in range(SHORTEST, min(len(w) - 1, LONGEST) + 1))
            count[int(toxic == 1)].update(found)
        keys = list(count[0].keys() | count[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([count[1][k] for k in keys], pa.int64()), pa.array([count[0][k] for k in keys], pa.int64())], ["pattern", "toxic", "clean"])


def choose(found: list[tuple[str, int, int]], n_toxic: int, n_clean: int, at_least: int) -> dict[str, float]:
    """Entries from (pattern, toxic texts, clean texts): shortest first, each with its log odds; what a chosen shorter
    entry explains as well isn't taken again."""
    def odds(t: int, c: int) -> float:
        return math.log((t + 0.5) / (n_toxic + 1)) - math.log((c + 0.5) / (n_clean + 1))

    out: dict[str, float] = {}
    for x, t, c in sorted(found, key=lambda r: (len(r[0].rstrip()), r[0])):
        w = odds(t, c)
        stem = x.rstrip()
        if t < at_least or w < 3.0 or c * RARER > t:
            continue
        if any(stem[:n] in out and out[stem[:n]] >= w - 1.5 for n in range(2, len(stem) + 1)):
            continue
        out[x] = w
    return out


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Lexicon:
    """Learn entries, exceptions and the curve from a bounded sample."""
    spark = docs.sparkSession
    bounded_batches(spark)
    some = materialise(sample(docs, labels, rows, id_col, text_col), "toxicity-sample")
    once = merged(some)
    sizes = {r["_toxic"]: r["n"] for r in once.groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        share = n_toxic / max(n_toxic + n_clean, 1)
        return Lexicon({}, (), (math.log((share + 1e-6) / (1 - share + 1e-6)), 0.0, 0.0))
    at_least = max(3, n_toxic // 200)
    counts = once.select("_text", "_toxic").mapInArrow(_patterns, "pattern string, toxic long, clean long").groupBy("pattern").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    found = [tuple(r) for r in counts.where((F.col("toxic") >= at_least) & (F.col("clean") * RARER <= F.col("toxic"))).collect()]
    first = Lexicon(choose(found, n_toxic, n_clean, at_least))

    def contexts(it):  # matches with the word before and after, of either label
        for b in it:
            rows_ = []
            for text, toxic in zip(as_texts(b.column("_text")), b.column("_toxic").to_pylist(), strict=True):
                folded, seen = fold(text), set()
                for begin, end, _ in first.matches(folded):
                    stop = folded.find(" ", end if folded[end] != " " else end - 1)
                    before, after = folded.rfind(" ", 0, begin), folded.find(" ", stop + 1)
                    word = folded[begin : stop + 1]
                    if word not in first.entries:  # a whole word can't be the exception to itself
                        seen.add(word.strip())
                    seen.add(folded[max(before, 0) : stop + 1].strip())
                    if after > 0:
                        seen.add(folded[begin : after + 1].strip())
                rows_ += [(x, int(toxic == 1)) for x in seen if x]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows_], pa.string()), pa.array([r[1] for r in rows_], pa.int32())], ["phrase", "toxic"])

    phrases = once.mapInArrow(contexts, "phrase string, toxic int").groupBy("phrase").agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n"))
    exceptions = tuple(sorted(r["phrase"] for r in phrases.where((F.col("n") - F.col("t") >= 3) & (F.col("t") * 10 <= F.col("n"))).collect()))
    lexicon = Lexicon(first.entries, exceptions)

    def measures(it):
        for b in it:
            x = [lexicon.measure(t) for t in as_texts(b.column("_text"))]
            yield pa.RecordBatch.from_arrays([pa.array([v[0] for v in x], pa.float64()), pa.array([v[1] for v in x], pa.float64()), b.column("_toxic").cast(pa.float64())], ["a", "b", "y"])

    m = once.mapInArrow(measures, "a double, b double, y double").toPandas().sort_values(["a", "b", "y"]).to_numpy()
    lexicon.curve = _curve(m[:, :2], (m[:, 2] == 1).astype(float))
    return lexicon


def score_column(lexicon: Lexicon, text_col: Column | str) -> Column:
    """The score of each text, 0 to 1."""

    @F.arrow_udf("double")
    def toxicity_score(t: pa.Array) -> pa.Array:
        return pa.array(lexicon.score(as_texts(t)), pa.float64())

    return toxicity_score(F.col(text_col) if isinstance(text_col, str) else text_col)
