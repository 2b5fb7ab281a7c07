"""SentencePiece encoding and decoding by weighted finite-state transducers.

The model is compiled into machines. The normaliser rewrites blanks to U+2581 and puts one before a text. The lexicon reads
pieces; a character that is no piece is read as itself and written as its byte pieces. The neighbour machine gives a weight of 0
to pieces that the model's merges would leave beside each other, and an infinite one to others (bpe.Lattice). Composed with a text they are a lattice
whose shortest path in the tropical semiring, the only one of finite weight, is the encoding.

Pieces never have a blank sign after another character, so the lattice is cut at blanks, and before marks that no piece has
after a letter or digit; the shortest path of the parts is that of the whole. The distinct parts that a worker meets are searched together, in arrays, and kept
up to KEEP of them; parts of more than LONG characters are searched one by one and not kept.
Nulls count as empty texts, which have no piece. Decoding gives the text back; only U+2581 itself comes back as a blank. Repeated rows are encoded
alike, and an empty table gives an empty one.
"""
from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import Lattice, Merges
from .common import as_texts, bounded_batches

BLANK = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


def _fields(data: bytes) -> Iterable[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    i = 0

    def number() -> int:
        nonlocal i
        shift = value = 0
        while True:
            b = data[i]
            i += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while i < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = number() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, data[i : i + size]
        i += size


class Slots(dict[str, int]):
    """The places of parts. A part that is met first gets the next place; one of more than `most` characters gets a place below 0 and isn't kept."""

    def __init__(self, most: int):
        self.most = most
        self.new: list[str] = []
        self.longs: list[str] = []

    def __missing__(self, part: str) -> int:
        if len(part) > self.most:
            self.longs.append(part)
            return -len(self.longs)
        self[part] = at = len(self)
        self.new.append(part)
        return at


class Pieces:
    """The compiled model at path. Parts have plain blanks, so that most take one byte a character; searches have BLANK."""

    KEEP, LONG, BLOCK = 400_000, 64, 1 << 19

    def __init__(self, path: str):
        import struct

        ids, scores, kinds, normal = {}, {}, [], {}
        for field, value in _fields(open(path, "rb").read()):
            if field == 1:
                p = dict(_fields(value))  # type: ignore[arg-type]
                kinds.append((p[1].decode(), p.get(3, NORMAL)))  # type: ignore[union-attr]
                if p.get(3, NORMAL) == NORMAL:
                    ids[kinds[-1][0]] = len(kinds) - 1
                    scores[kinds[-1][0]] = struct.unpack("<f", p.get(2, b"\0\0\0\0"))[0]
            elif field == 3:
                normal = dict(_fields(value))  # type: ignore[arg-type]
        if normal.get(2) or normal.get(4, 1) or not normal.get(5, 1):
            raise ValueError("only the identity normaliser that keeps blanks is supported")
        if any(BLANK in p.lstrip(BLANK) for p in ids):
            raise ValueError("pieces that go across blanks aren't supported")
        self.prefix = bool(normal.get(3, 1))
        self.ids, self.kinds = ids, kinds
        self.bytes = {int(p[1:-1], 16): i for i, (p, k) in enumerate(kinds) if k == BYTE}
        order = {p: r for r, p in enumerate(sorted(scores, key=lambda p: -scores[p]))}
        self.lattice = Lattice(Merges(set(ids), lambda a, b: order.get(a + b)))
        self.cut = re.compile(self.parts(), re.DOTALL)
        self.ids_of = np.array([ids.get(t, -1) if t is not None else -1 for t in self.lattice.names], np.int32)
        self.byte_ids = np.array([self.bytes.get(b, -1) for b in range(256)], np.int32)
        self.written = np.empty(len(kinds), object)
        self.written[:] = [bytes([int(p[1:-1], 16)]) if k == BYTE else p.replace(BLANK, " ").encode() if k == NORMAL else b"" for p, k in kinds]
        self._forget()

    def _forget(self) -> None:
        self.known = Slots(self.LONG)  # parts met so far, and where their ids are
        self.begins, self.sizes, self.store, self.used = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(4096, np.int32), 0
        self.met = np.zeros(1024, bool)  # whether a part has come again after the block that it was met in

    def _forget_rare(self) -> None:
        """Only parts that have come again stay, if these are at most half of KEEP."""
        again = np.flatnonzero(self.met[: len(self.known)])
        words = [w for w, m in zip(self.known, self.met.tolist(), strict=False) if m]
        begins, n, store = self.begins[again], self.sizes[again], self.store
        self._forget()
        if 0 < len(again) <= self.KEEP // 2:
            ends = np.cumsum(n)
            self.known.update(zip(words, range(len(words)), strict=True))
            self._room(len(again), int(ends[-1]))
            self.begins[: len(again)], self.sizes[: len(again)], self.used = ends - n, n, int(ends[-1])
            self.store[: self.used] = store[np.arange(self.used) - np.repeat(ends - n - begins, n)]

    def _room(self, parts: int, ids: int) -> None:
        while parts > len(self.begins):
            self.begins, self.sizes, self.met = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begins, self.sizes, self.met))
        while ids > len(self.store):
            self.store = np.concatenate([self.store, np.zeros_like(self.store)])

    def parts(self) -> str:
        """A pattern of the parts that no piece goes across: words, and within them letters or digits before a mark."""
        line = "" if any("\n" in p for p in self.ids) else "\n"
        before: dict[str, set[str]] = {c: set() for c in map(chr, range(33, 127)) if not c.isalnum()}  # what a mark follows in a piece
        for p in self.ids:
            for a, b in zip(p, p[1:], strict=False):
                if a.isalnum() and b in before:
                    before[b].add(a)
        marks = ["[" + re.escape("".join(c for c, s in before.items() if not s)) + "]"]
        marks += [f"(?<![{re.escape(''.join(sorted(s)))}])" + re.escape(c) for c, s in before.items() if s]
        return rf" *+[^\W_]++(?={'|'.join(marks)})| +[^ {line}]*|[^ {line}]+" + (f"|{line}" if line else "")

    def search(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all parts, and how many each has."""
        token, point, n = self.lattice.shortest_of([x.replace(" ", BLANK) for x in parts])
        ids = self.ids_of[token]
        other = ids < 0
        if not other.any():
            return ids, n
        p = point[other]  # such a token is one character
        size = np.ones(len(ids), np.int64)
        size[other] = 1 + (p >= 0x80) + (p >= 0x800) + (p >= 0x10000)
        out = np.repeat(ids, size)
        out[np.repeat(other, size)] = self.byte_ids[np.frombuffer("".join(map(chr, p)).encode(), np.uint8)]
        return out, np.add.reduceat(size, np.cumsum(n) - n)

    def _long(self, part: str) -> np.ndarray:
        ids: list[int] = []
        for t in self.lattice.shortest(part.replace(" ", BLANK)):
            i = self.ids.get(t)
            ids.extend([i] if i is not None else [self.bytes[b] for b in t.encode()])
        return np.array(ids, np.int32)

    def _learn(self, new: list[str], at: int) -> None:
        """Put the ids of parts that aren't known yet into the store, those of the first at place `at`."""
        first = 0
        while first < len(new):
            some, size = [], 0
            while first < len(new) and size < self.BLOCK // 2:
                some.append(new[first])
                size += len(new[first])
                first += 1
            ids, n = self.search(some)
            k = len(some)
            self._room(at + k, self.used + len(ids))
            self.store[self.used : self.used + len(ids)] = ids
            self.begins[at : at + k], self.sizes[at : at + k] = self.used + np.cumsum(n) - n, n
            self.used += len(ids)
            at += k

    def _blocks(self, texts: list[str]) -> Iterable[tuple[list[int], list[int], list[str]]]:
        """Texts' numbers, how many parts each has, and all parts, some BLOCK characters at a time; long texts go in pieces."""
        owners, counts, parts, size = [], [], [], 0
        for k, text in enumerate(texts):
            normal = (" " if self.prefix else "") + text.replace(BLANK, " ") if text else ""
            at = 0
            while at < len(normal):
                end = at + self.BLOCK
                if end < len(normal):  # where a blank follows something else a part begins
                    while 0 < (end := normal.find(" ", end)) and normal[end - 1] == " ":
                        end += 1
                    end = len(normal) if end < 0 else end
                piece = normal if at == 0 and end >= len(normal) else normal[at:end]
                found = self.cut.findall(piece)
                owners.append(k)
                counts.append(len(found))
                parts += found
                size += len(piece)
                at = end
                if size >= self.BLOCK:
                    yield owners, counts, parts
                    owners, counts, parts, size = [], [], [], 0
        if parts:
            yield owners, counts, parts

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and how many each has."""
        out, totals = [], np.zeros(len(texts), np.int64)
        for owners, counts, parts in self._blocks(texts):
            if len(self.known) >= self.KEEP:
                self._forget_rare()
            known, at = self.known, len(self.known)
            slot = np.fromiter(map(known.__getitem__, parts), np.int64, len(parts))
            try:
                longs = {w: self._long(w) for w in set(known.longs)}
                self._learn(known.new, at)
            except BaseException:  # places without ids must not stay
                self._forget()
                raise
            known.new, known.longs = [], []
            self.met[slot[(slot >= 0) & (slot < at)]] = True
            kept = np.maximum(slot, 0)
            begin, n = self.begins[kept], self.sizes[kept]
            if longs:
                where = np.flatnonzero(slot < 0)
                n[where] = [len(longs[parts[i]]) for i in where]
                begin[where] = 0
            ends = np.cumsum(n)
            place = np.arange(ends[-1]) - np.repeat(ends - n - begin, n)
            if longs:  # their places point beyond what is kept
                inside = np.repeat(slot >= 0, n)
                ids = np.empty(len(place), np.int32)
                ids[inside] = self.store[place[inside]]
                ids[~inside] = np.concatenate([longs[parts[i]] for i in where])
            else:
                ids = self.store[place]
            out.append(ids)
            first = np.cumsum(counts) - counts
            full = np.flatnonzero(counts)
            np.add.at(totals, np.array(owners)[full], np.add.reduceat(n, first[full]))
        return np.concatenate(out) if out else np.empty(0, np.int32), totals

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def decode_all(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts whose ids are between the offsets."""
        out = []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            text = b"".join(self.written[ids[a:b]].tolist()).decode("utf-8", "replace")
            if BLANK in text:  # of byte pieces
                text = text.replace(BLANK, " ")
            out.append(text[1:] if self.prefix and text.startswith(" ") else text)
        return out

    def decode(self, ids: Iterable[int]) -> str:
        a = np.fromiter(ids, np.int64)
        return self.decode_all(a, np.array([0, len(a)]))[0]


_loaded: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def encode_column(path: str, text_col: Column | str) -> Column:
    """The ids of each text."""

    @F.arrow_udf("array<int>")
    def encode(t: pa.Array) -> pa.Array:
        ids, n = pieces(path).encode_all(as_texts(t))
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(ids))

    return encode(F.col(text_col) if isinstance(text_col, str) else text_col)


def decode_column(path: str, ids_col: Column | str) -> Column:
    """The text of each array of ids; null gives an empty text."""

    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        flat = ids.fill_null([]) if ids.null_count else ids
        offsets = flat.offsets.to_numpy()
        return pa.array(pieces(path).decode_all(flat.values.to_numpy(zero_copy_only=False), offsets), pa.string())

    return decode(F.col(ids_col) if isinstance(ids_col, str) else ids_col)


def encode_documents(docs: DataFrame, path: str, text_col: str = "text", into: str = "piece_ids") -> DataFrame:
    """docs with the ids of each text in the column into, which must be new."""
    if into.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"there is a column {into} already")
    bounded_batches(docs.sparkSession)
    return docs.withColumn(into, encode_column(path, text_col))
