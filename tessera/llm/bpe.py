"""Byte-pair encoding as a left-to-right machine.

A sequence of tokens is the encoding of its text exactly if every token encodes to itself and every two neighbours do so
together. Hence each prefix of a text has one last token, and the machine can go from left to right: at each symbol it takes
the only token that ends here and fits the last token of the text before it. What it needs of the past is bounded by
the longest beginning of a token that the text ends with, so its states are finite; they are made when first met.
"""
from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np


class Merges:
    """rank(a, b): the order in which the neighbours a and b merge, or None. Tokens and symbols are strings."""

    KEEP = 50_000  # neighbours whose answer is remembered, twice: those asked lately, and those before these

    def __init__(self, tokens: set[str], rank: Callable[[str, str], int | None]):
        self.rank = rank
        self.known: dict[tuple[str, str], bool] = {}
        self.older: dict[tuple[str, str], bool] = {}
        self.edges: tuple[dict[str, list[tuple[int, str]]], ...] = ({}, {})  # [0] and [-1]
        self.same: dict = {}  # equal entries of edges are one object
        self.tokens = {t for t in tokens if len(t) == 1 or self.whole(t)}
        self.beginnings = {t[:n] for t in self.tokens for n in range(1, len(t))}
        self.longest = max(map(len, self.tokens), default=1)
        self.same.clear()

    def steps(self, text: str) -> Iterator[tuple[int, int, list[str]]]:
        """The definition: merge the neighbours of least rank, leftmost first, until none merge. Rank, place, parts then."""
        parts = list(text)
        ranks = [self.rank(a, b) for a, b in zip(parts, parts[1:], strict=False)]
        while True:
            best, at = None, -1
            for i, r in enumerate(ranks):
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                return
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = self.rank(parts[at - 1], parts[at])
            if at < len(ranks):
                ranks[at] = self.rank(parts[at], parts[at + 1])
            yield best, at, parts

    def encode(self, text: str) -> list[str]:
        parts = list(text)
        for _, _, parts in self.steps(text):  # noqa: B007
            pass
        return parts

    def whole(self, token: str) -> bool:
        """Whether a token encodes to itself. Its edges are kept."""
        sides: tuple[list[tuple[int, str]], ...] = ([], [])
        parts = [""] * 2
        for r, _, parts in self.steps(token):
            for end in (0, -1):
                sides[end].append(self.same.setdefault(x := (r, parts[end]), x))
        if len(parts) == 1:
            self.edges[0][token], self.edges[-1][token] = sides
        return len(parts) == 1

    def edge(self, token: str, end: int) -> list[tuple[int, str]]:
        """Ranks of the merges that make a token, in their order, and the part at its beginning (0) or end (-1) after each."""
        found = self.edges[end].get(token)
        if found is None:
            found = self.edges[end][token] = [(r, parts[end]) for r, _, parts in self.steps(token)]
        return found

    def fits(self, a: str, b: str) -> bool:
        """Whether a and b, tokens that encode to themselves, do so together.

        Merges within a and within b go on in their own order, the lesser rank first and a's first if ranks are equal, unless the
        parts that meet at the border merge before.
        """
        key = (a, b)
        found = self.known.get(key)
        if found is not None:
            return found
        if len(self.known) >= self.KEEP:
            self.known, self.older = {}, self.known
        found = self.older.get(key)
        if found is not None:
            self.known[key] = found
            return found
        ends, begins, i, j = self.edge(a, -1), self.edge(b, 0), 0, 0
        x, y = a[-1], b[0]
        across = self.rank(x, y)
        while True:
            p = ends[i][0] if i < len(ends) else None
            q = begins[j][0] if j < len(begins) else None
            if across is not None and (p is None or across < p) and (q is None or across <= q):
                found = False
                break
            if p is None and q is None:
                found = True
                break
            if q is None or p is not None and p <= q:
                new, i = (ends[i][1], y), i + 1
            else:
                new, j = (x, begins[j][1]), j + 1
            if new != (x, y):
                x, y = new
                across = self.rank(x, y)
        self.known[key] = found
        return found


class CountTransducer:
    """States and transitions that say by how much the number of tokens changes. State 0 is the beginning of a piece.

    A state holds the longest text end that begins a token and, for each place in it, the last token and the number of
    tokens less than now. Memory is bounded: past MOST states the machine starts anew (results are the same).
    """

    MOST = 250_000

    def __init__(self, merges: Merges):
        self.m = merges
        self._reset()

    def _reset(self) -> None:
        start = ("", ((None, 0),))
        self.ids, self.states, self.next = {start: 0}, [start], [{}]
        self.same: dict = {}  # equal places are one object

    def step(self, state: int, symbol: str) -> tuple[int, int]:
        """The next state and the number of tokens that the symbol adds (below 0 where tokens merge)."""
        found = self.next[state].get(symbol)
        if found is not None:
            return found
        tail, past = self.states[state]
        grown, m = tail + symbol, self.m
        token, less = symbol, past[-1][1] - 1  # an unknown symbol is a token of its own
        for n in range(len(grown), 0, -1):  # past[-n] is the place before the last n symbols
            t = grown[-n:]
            if t in m.tokens and n <= len(past):
                before, k = past[-n]
                if before is None or m.fits(before, t):
                    token, less = t, k - 1
                    break
        # counts are held as (now - then): a place with k tokens less than now
        change = -less  # tokens now minus tokens before this symbol
        keep = len(grown)
        while keep and grown[-keep:] not in m.beginnings:
            keep -= 1
        same = self.same.setdefault
        places = [same(x := (p, k + change), x) for p, k in past[len(past) - keep :]] + [same(x := (token, 0), x)]
        key = (grown[len(grown) - keep :], tuple(places))
        at = self.ids.get(key)
        if at is None:
            at = self.ids[key] = len(self.states)
            self.states.append(key)
            self.next.append({})
        self.next[state][symbol] = (at, change)
        return at, change

    def count(self, symbols: str) -> int:
        """Tokens of one piece."""
        if len(self.states) > self.MOST:
            self._reset()
        state, n, nexts = 0, 0, self.next
        for c in symbols:
            found = nexts[state].get(c) or self.step(state, c)
            state = found[0]
            n += found[1]
        return n


class Lattice:
    """The encoding as a shortest path in the tropical semiring.

    Two machines are compiled. The lexicon maps symbols to tokens: a trie whose ends give the token read, and a symbol that no token
    begins with gives itself. The neighbour machine's state is the last token; its arcs weigh nothing if a token fits the one before
    and infinitely much otherwise. Their composition with a text is a lattice of (place, last token). Every beginning of a
    text has one path of finite weight, so a place needs one entry, and one pass over the places in order relaxes every arc once.

    shortest() does so for one text, shortest_of() for many at once, place by place, in arrays.
    """

    NONE, OTHER = 0, 1  # before a text; a symbol that is in no token
    SLOTS = 22  # bits: neighbours whose weight is remembered

    def __init__(self, merges: Merges):
        self.m = merges
        self.kinds = {t: (t in merges.beginnings) + 2 * (t in merges.tokens) for t in merges.beginnings | merges.tokens}
        singles = {c for t in merges.tokens for c in t}
        self.names = [None, None, *sorted(merges.tokens | singles)]
        self.number = {t: i for i, t in enumerate(self.names) if t is not None}
        self.symbols = np.array(sorted(map(ord, singles)), np.uint32)
        self._lexicon()
        self._neighbours()

    def _lexicon(self) -> None:
        nodes = {"": 0}
        for t in sorted(self.m.tokens):
            for n in range(1, len(t) + 1):
                nodes.setdefault(t[:n], len(nodes))
        width = len(self.symbols) + 1
        sign = {int(c): i + 1 for i, c in enumerate(self.symbols)}
        arcs = sorted((nodes[p[:-1]] * width + sign[ord(p[-1])], i) for p, i in nodes.items() if p)
        self.arc, self.child = np.array([a for a, _ in arcs], np.int64), np.array([i for _, i in arcs], np.int32)
        self.token = np.full(len(nodes), -1, np.int32)
        for t in self.m.tokens:
            self.token[nodes[t]] = self.number[t]
        self.signs = np.zeros(sys.maxunicode + 1, np.int32)  # by code point
        self.signs[self.symbols] = np.arange(1, width)
        self.root = np.zeros(width, np.int32)  # the nodes after a first sign, 0 if there is none
        for a, i in arcs:
            if a < width:
                self.root[a] = i
        self.single = np.array([self.OTHER, *(self.number[chr(c)] for c in self.symbols)], np.int32)

    def _neighbours(self) -> None:
        self.never = np.int64(1 << 40)
        ranks, parts, begins = ([], []), ([], []), ([], [])
        for t in self.names:
            for end in (0, -1):
                begins[end].append(len(ranks[end]))
                for r, p in self.m.edge(t, end) if t is not None else ():
                    ranks[end].append(r)
                    parts[end].append(self.number.get(p, self.OTHER))
                ranks[end].append(int(self.never))
                parts[end].append(self.OTHER)
        self.ranks, self.parts, self.begins = ([np.array(x[e], np.int64) for e in (0, -1)] for x in (ranks, parts, begins))
        self.ends = [np.array([self.OTHER if t is None else self.number[t[e]] for t in self.names], np.int64) for e in (0, -1)]
        made = {}
        for t in self.names[2:]:
            for n in range(1, len(t)):
                a, b = self.number.get(t[:n]), self.number.get(t[n:])
                r = self.m.rank(t[:n], t[n:]) if a is not None and b is not None else None
                if r is not None:
                    made[a * len(self.names) + b] = r
        self.pair = np.array(sorted(made), np.int64)
        self.pair_rank = np.array([made[k] for k in sorted(made)], np.int64)
        self.seen, self.weight = np.full(1 << self.SLOTS, -1, np.int64), np.zeros(1 << self.SLOTS, bool)

    def _across(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        if not len(self.pair):
            return np.full(len(x), self.never)
        key = x * len(self.names) + y
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.pair_rank[at], self.never)

    def _fit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merges.fits of many pairs: the merges at both sides of the border, in their order."""
        out = np.zeros(len(a), bool)
        at = np.arange(len(a))
        i, j, x, y = self.begins[1][a], self.begins[0][b], self.ends[1][a], self.ends[0][b]
        while len(at):
            across, p, q = self._across(x, y), self.ranks[1][i], self.ranks[0][j]
            joined = (across < p) & (across <= q)
            done = ~joined & (p == self.never) & (q == self.never)
            out[at[done]] = True
            left = p <= q
            x, y = np.where(left, self.parts[1][i], x), np.where(left, y, self.parts[0][j])
            i, j = i + left, j + ~left
            on = ~(joined | done)
            at, i, j, x, y = at[on], i[on], j[on], x[on], y[on]
        return out

    def fits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the weight of b after a is finite; what was asked lately is remembered in a table of bounded size."""
        key = a * np.int64(len(self.names)) + b
        slot = (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.SLOTS)).astype(np.int64)
        out = self.weight[slot]
        new = np.flatnonzero(self.seen[slot] != key)
        if len(new):
            fresh, inverse = np.unique(key[new], return_inverse=True)
            found = self._fit(fresh // len(self.names), fresh % len(self.names))
            out[new] = found[inverse]
            self.seen[slot[new]] = key[new]
            self.weight[slot[new]] = out[new]  # of equal slots the last wins in both
        return out

    def shortest(self, text: str) -> list[str]:
        """The tokens of one text."""
        kinds, fits, n = self.kinds, self.m.fits, len(text)
        last: list[str | None] = [None] * (n + 1)
        for i in range(n):
            before, t = last[i], ""
            for j in range(i, min(n, i + self.m.longest)):
                t += text[j]
                kind = kinds.get(t, 0)
                if (kind & 2 or j == i) and last[j + 1] is None:
                    if before is None or fits(before, t):
                        last[j + 1] = t
                if not kind & 1:
                    break
        out, i = [], n
        while i:
            t = last[i]
            assert t is not None
            out.append(t)
            i -= len(t)
        return out[::-1]

    def shortest_of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of the tokens of all texts, none of which is empty, the code point that each ends with, and how many each text has."""
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        lengths = np.array([len(t) for t in texts])
        begin = np.cumsum(lengths) - lengths
        sign = self.signs[points].astype(np.int64)
        owner = np.repeat(np.arange(len(texts)), lengths)
        stop = (begin + lengths)[owner]
        # arcs of the lattice: all places step through the lexicon at once
        width = len(self.symbols) + 1
        at, node, n = np.arange(len(points)), np.zeros(len(points), np.int64), 0
        arcs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(at):
            if n == 0:
                node = self.root[sign].astype(np.int64)
                hit = node > 0
            else:
                key = node * width + sign[at + n]
                edge = np.minimum(np.searchsorted(self.arc, key), len(self.arc) - 1)
                hit = self.arc[edge] == key
                node = np.where(hit, self.child[edge], 0).astype(np.int64)
            token = np.where(hit, self.token[node], -1)
            if n == 0:  # a symbol that isn't a token is read as itself
                token = np.where(token < 0, self.single[sign[at]], token)
            took = token >= 0
            n += 1
            arcs.append((at[took], at[took] + n, token[took]))
            on = hit & (at + n < stop[at])
            at, node = at[on], node[on]
        source, target, token = (np.concatenate(x) for x in zip(*arcs, strict=True))
        step = target - begin[owner[source]]
        order = np.argsort(step.astype(np.int32), kind="stable")
        source, target, token, step = source[order], target[order], token[order].astype(np.int64), step[order]
        # a text's places: one more than its symbols, counted from begin + its number
        source, target = source + owner[source], target + owner[target - 1]
        last, back = np.zeros(len(points) + len(texts), np.int64), np.zeros(len(points) + len(texts), np.int64)
        limits = np.searchsorted(step, np.arange(1, lengths.max() + 2))
        for a, b in zip(limits[:-1], limits[1:], strict=True):
            s, d, t = source[a:b], target[a:b], token[a:b]
            before = last[s]
            finite = before == self.NONE
            rest = np.flatnonzero(~finite)
            finite[rest] = self.fits(before[rest], t[rest])
            last[d[finite]], back[d[finite]] = t[finite], s[finite]
        first = begin + np.arange(len(texts))
        on = np.zeros(len(last), bool)
        at = first + lengths
        while len(at):
            on[at] = True
            at = back[at]
            at = at[last[at] != self.NONE]
        ends = np.flatnonzero(on)
        text = np.searchsorted(first, ends, "right") - 1
        return last[ends], points[ends - text - 1], np.bincount(text, minlength=len(texts))
