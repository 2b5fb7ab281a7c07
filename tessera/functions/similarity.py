"""How alike two texts are, from 0 to 100. Vectorised functions over Arrow batches; null counts as empty.

ratio is 200 * LCS / (len a + len b), LCS being the longest common subsequence; two empty texts are alike (100).
"""
from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def places_of(a: str) -> dict[str, int]:
    """One bit for each place of each sign."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    return places


def common(a: str, b: str, places: dict[str, int] | None = None) -> int:
    """Length of the longest common subsequence, one bit per sign of a."""
    places = places_of(a) if places is None else places
    full = (1 << len(a)) - 1
    free = full
    for c in b:
        at = places.get(c)
        if at:
            hit = free & at
            free = ((free + hit) | (free - hit)) & full
    return len(a) - free.bit_count()


def ratio(a: str, b: str) -> float:
    n = len(a) + len(b)
    return 100.0 if a == b else 200.0 * common(a, b) / n


def _windows(a: str, b: str) -> float:
    """The best ratio of a with a window of b as long as a, or less at either end. A window whose newest sign at its end, or at the text's end
    whose first sign, isn't in a is no better than one that is tried as well; neither is one that can't reach the best so far."""
    n, places, best = len(a), places_of(a), 0.0
    for i in range(1 - n, len(b)):
        w = b[max(0, i) : i + n]
        if (w[-1] if i + n <= len(b) else w[0]) not in places or 200.0 * min(len(w), n) / (n + len(w)) <= best:
            continue
        best = max(best, 200.0 * common(a, w, places) / (n + len(w)))
    return best


def partial_ratio(a: str, b: str) -> float:
    """The best ratio of the shorter text with a window of the longer one: as long as the shorter, or less at either end.

    Texts of one length are both tried as the longer one.
    """
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 0.0 if b else 100.0
    if a in b:
        return 100.0
    found = _windows(a, b)
    return max(found, _windows(b, a)) if len(b) == len(a) else found


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    """The best ratio among the common words, and these with either text's other words. A text without words gives 0."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, only_x, only_y = sorted(x & y), sorted(x - y), sorted(y - x)
    if both and not (only_x and only_y):
        return 100.0
    s, sx, sy = " ".join(both), " ".join(both + only_x), " ".join(both + only_y)
    return max(ratio(sx, sy), ratio(s, sx) if s else 0.0, ratio(s, sy) if s else 0.0)


def jaro_winkler(a: str, b: str) -> float:
    """Jaro's similarity, raised by a tenth of the rest for each of the first four signs in common where it is above 0.7."""
    if not a or not b:
        return 0.0 if a or b else 100.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used, first = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                first.append(c)
                break
    m = len(first)
    if not m:
        return 0.0
    second = [c for c, u in zip(b, used, strict=True) if u]
    swapped = sum(x != y for x, y in zip(first, second, strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swapped) / m) / 3
    if jaro > 0.7:
        same = 0
        while same < min(4, len(a), len(b)) and a[same] == b[same]:
            same += 1
        jaro += 0.1 * same * (1 - jaro)
    return 100.0 * jaro


SCORERS: dict[str, Callable[[str, str], float]] = {f.__name__: f for f in (ratio, partial_ratio, token_sort_ratio, token_set_ratio, jaro_winkler)}


def score_udf(name: str):
    """The scorer as a function of two text columns."""
    score = SCORERS[name]

    def apply(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([score(x or "", y or "") for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.float64())

    apply.__annotations__ = {"a": pa.Array, "b": pa.Array, "return": pa.Array}
    return F.arrow_udf(apply, "double")


def score(name: str, a: Column | str, b: Column | str) -> Column:
    return score_udf(name)(a, b)


def scores(wanted: Sequence[tuple[str, str, str]], columns: Sequence[str]) -> Column:
    """One struct with a score for each (name, scorer, column of both records, the sides being a_* and b_*), from one crossing into Python; equal
    pairs of texts in a batch are scored once."""
    place = {c: i for i, c in enumerate(columns)}
    kind = ", ".join(f"{n} double" for n, _, _ in wanted)

    def apply(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for arrays in batches:
            texts = [[x or "" for x in a.to_pylist()] for a in arrays]
            known: dict[tuple[str, str, str], float] = {}
            out = []
            for _, scorer, c in wanted:
                f, found = SCORERS[scorer], []
                for x, y in zip(texts[place[f"a_{c}"]], texts[place[f"b_{c}"]], strict=True):
                    key = (scorer, x, y)
                    v = known.get(key)
                    if v is None:
                        v = known[key] = round(f(x, y), 6)
                    found.append(v)
                out.append(pa.array(found, pa.float64()))
            yield pa.StructArray.from_arrays(out, names=[n for n, _, _ in wanted])

    apply.__annotations__ = {"batches": Iterator[tuple[pa.Array, ...]], "return": Iterator[pa.Array]}
    return F.arrow_udf(apply, kind)(*columns)
