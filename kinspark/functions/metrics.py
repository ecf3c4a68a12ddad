"""String likeness measures. Levenshtein distance and soundex are Spark's own; the others are Arrow-batched functions of two
columns. NULL on either side gives NULL; two empty strings are alike (100, or 1 for Jaro-Winkler), one empty string is not."""

from __future__ import annotations

import itertools
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import functions as F


def _places(a: str) -> dict[str, int]:
    """Where each character stands, a bit for each place."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    return places


def _common(places: dict[str, int], n: int, b: str) -> int:
    """Longest common subsequence with the n characters of places; the column of matches is one integer."""
    every = (1 << n) - 1
    free = every
    for c in b:
        hit = free & places.get(c, 0)
        free = ((free + hit) | (free - hit)) & every
    return n - free.bit_count()


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence."""
    return _common(_places(a), len(a), b)


def indel_ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 200.0 * lcs_length(a, b) / total if total else 100.0


def partial_ratio(a: str, b: str) -> float:
    """Best indel ratio of the shorter string and a window of its length, cut off at the edges, in the longer one. Windows are
    tried by how many of their characters the shorter one has at all, which bounds their ratio."""
    short, long = sorted((a, b), key=len)
    if not short:
        return 100.0 if not long else 0.0
    n, places = len(short), _places(short)
    known = [0, *itertools.accumulate(c in places for c in long)]
    windows = [(lo, min(len(long), i + n)) for i in range(1 - n, len(long)) for lo in (max(0, i),)]
    bounds = sorted(((200.0 * (known[hi] - known[lo]) / (n + hi - lo), lo, hi) for lo, hi in windows), reverse=True)
    best = 0.0
    for bound, lo, hi in bounds:
        if bound <= best:
            break
        best = max(best, 200.0 * _common(places, n, long[lo:hi]) / (n + hi - lo))
    return best


def token_sort_ratio(a: str, b: str) -> float:
    return indel_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    both, left, right = (sorted(s) for s in (x & y, x - y, y - x))
    if both and not (left and right):
        return 100.0
    shared, one, two = " ".join(both), " ".join(both + left), " ".join(both + right)
    best = indel_ratio(one, two)
    return max(best, indel_ratio(shared, one), indel_ratio(shared, two)) if both else best


def jaro_winkler(a: str, b: str) -> float:
    """Jaro likeness, raised by a tenth of the rest for each common leading character up to four where it is over 0.7."""
    if not a or not b:
        return float(a == b)
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    taken, left = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                left.append(c)
                break
    m = len(left)
    if not m:
        return 0.0
    moved = sum(x != y for x, y in zip(left, (c for c, t in zip(b, taken) if t))) / 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    lead = next((k for k, (x, y) in enumerate(zip(a[:4], b[:4])) if x != y), min(4, len(a), len(b)))
    return jaro + 0.1 * lead * (1 - jaro) if jaro > 0.7 else jaro


def osa_distance(a: str, b: str) -> int:
    """Edit distance in which two adjacent characters may be swapped, no part being edited twice."""
    older, old = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(old[j] + 1, row[j - 1] + 1, old[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and y == a[i - 2]:
                d = min(d, older[j - 2] + 1)
            row.append(d)
        older, old = old, row
    return old[-1]


#: Pairs worked on at a time; strings of a pair, the shorter and the longer, up to which that is by arrays; windows between two
#: that are always tried.
PAIRS, SHORT, LONG, STRIDE = 1024, 64, 256, 4


def _codes(*sides: list[str]) -> tuple[int, list[tuple[np.ndarray, np.ndarray]]]:
    """How many characters there are; of each side, its characters by number, a row for each text and 0 behind its end, and lengths."""
    points = [np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32) for texts in sides]
    number = np.zeros(0x110000, np.int64)
    for p in points:
        number[p] = 1
    there = np.flatnonzero(number)
    number[there] = np.arange(1, len(there) + 1)
    out = []
    for p, texts in zip(points, sides):
        n = np.array([len(t) for t in texts], np.int64)
        rows = np.zeros((len(texts), max(1, int(n.max(initial=0)))), np.int64)
        rows[np.arange(rows.shape[1]) < n[:, None]] = number[p]
        out.append((rows, n))
    return len(there), out


def _masks(short: np.ndarray, characters: int) -> np.ndarray:
    """Where each character stands in each row, a bit for each place; none for what is no character."""
    masks, rows = np.zeros((len(short), characters + 1), np.uint64), np.arange(len(short))
    for i in range(short.shape[1]):
        masks[rows, short[:, i]] |= np.uint64(1 << i)
    masks[:, 0] = 0
    return masks


def _window_lcs(masks: np.ndarray, long: np.ndarray, row: np.ndarray, lo: np.ndarray, size: np.ndarray) -> np.ndarray:
    """_common of each row's masks with the window of size characters from lo on, many at a time."""
    order = np.argsort(-size, kind="stable")
    row, lo, falling = row[order], lo[order], -size[order]
    free = np.full(len(row), ~np.uint64(0))
    for t in range(int(-falling[0]) if len(row) else 0):
        k = int(np.searchsorted(falling, -t))  # windows longer than t
        hit = free[:k] & masks[row[:k], long[row[:k], lo[:k] + t]]
        free[:k] = (free[:k] + hit) | (free[:k] - hit)
    out = np.empty(len(row), np.int64)
    out[order] = np.bitwise_count(~free)
    return out


def _in_parts(one: Callable[[str, str], float], many: Callable[[list[str], list[str]], np.ndarray]):
    """many for parts of the pairs, shorter strings first, and one for pairs of long ones; neither string is empty for many."""

    def of(a: list[str], b: list[str]) -> list:
        out: list = [None] * len(a)
        fit = []
        for i, (x, y) in enumerate(zip(a, b)):
            if x and y and min(len(x), len(y)) <= SHORT and max(len(x), len(y)) <= LONG:
                fit.append(i)
            else:
                out[i] = one(x, y)
        for k in range(0, len(fit), PAIRS):
            part = fit[k : k + PAIRS]
            short, long = zip(*(sorted((a[i], b[i]), key=len) for i in part))
            for i, value in zip(part, many(short, long).tolist()):
                out[i] = value
        return out

    return of


def _many_lcs(short: list[str], long: list[str]) -> np.ndarray:
    characters, ((x, _), (y, m)) = _codes(short, long)
    return _window_lcs(_masks(x, characters), y, np.arange(len(x)), np.zeros(len(x), np.int64), m)


def _many_partial(short: list[str], long: list[str]) -> np.ndarray:
    """As partial_ratio. Every STRIDE-th whole window is tried; a step along the longer string changes the subsequence by one at
    most, and a window cut off at an edge has none longer than the whole one there, which bounds the others."""
    characters, ((x, n), (y, m)) = _codes(short, long)
    masks = _masks(x, characters)
    rows = np.arange(len(x))
    known = np.zeros((len(x), y.shape[1] + 1), np.int64)
    np.cumsum(masks[rows[:, None], y] != 0, axis=1, out=known[:, 1:])
    last = m - n
    whole = np.zeros((len(x), int(last.max()) + 1), np.int64)
    starts = np.arange(whole.shape[1])
    row, lo = np.nonzero((starts <= last[:, None]) & ((starts % STRIDE == 0) | (starts == last[:, None])))
    whole[row, lo] = _window_lcs(masks, y, row, lo, n[row])
    best = np.zeros(len(x))
    np.maximum.at(best, row, 200.0 * whole[row, lo] / (n + n)[row])
    rest, at = np.nonzero((starts < last[:, None]) & (starts % STRIDE != 0))
    before, after = at - at % STRIDE, np.minimum(at - at % STRIDE + STRIDE, last[rest])
    most = np.minimum(whole[rest, before] + at - before, whole[rest, after] + after - at)
    cut, size = np.nonzero(np.arange(int(n.max())) < n[:, None])
    cut, size = cut[size > 0], size[size > 0]
    row = np.concatenate([rest, cut, cut])
    lo = np.concatenate([at, np.zeros_like(size), m[cut] - size])
    most = np.concatenate([most, whole[cut, 0], whole[cut, last[cut]]])
    size = np.concatenate([n[rest], size, size])
    most = np.minimum(most, known[row, lo + size] - known[row, lo])
    open_ = 200.0 * most / (n[row] + size) > best[row]
    row, lo, size = row[open_], lo[open_], size[open_]
    np.maximum.at(best, row, 200.0 * _window_lcs(masks, y, row, lo, size) / (n[row] + size))
    return best


lcs_lengths = _in_parts(lcs_length, _many_lcs)
partial_ratios = _in_parts(partial_ratio, _many_partial)


def indel_ratios(a: list[str], b: list[str]) -> list[float]:
    return [200.0 * c / (len(x) + len(y)) if x or y else 100.0 for c, x, y in zip(lcs_lengths(a, b), a, b)]


def token_sort_ratios(a: list[str], b: list[str]) -> list[float]:
    tidy = {t: " ".join(sorted(t.split())) for t in {*a, *b}}
    return indel_ratios([tidy[t] for t in a], [tidy[t] for t in b])


def token_set_ratios(a: list[str], b: list[str]) -> list[float]:
    """As token_set_ratio; the words in common begin both sides, so they are their own longest subsequence with each."""
    words = {t: set(t.split()) for t in {*a, *b}}
    ones, twos, shared, every = [], [], [], []
    for s, t in zip(a, b):
        x, y = words[s], words[t]
        both, left, right = sorted(x & y), sorted(x - y), sorted(y - x)
        every.append(bool(both) and not (left and right))
        shared.append(len(" ".join(both)))
        ones.append("" if every[-1] else " ".join(both + left))
        twos.append("" if every[-1] else " ".join(both + right))
    out = []
    for best, one, two, k, done in zip(indel_ratios(ones, twos), ones, twos, shared, every):
        out.append(100.0 if done else max(best, 200.0 * k / (k + len(one)), 200.0 * k / (k + len(two))) if k else best)
    return out


def _many_jaro_winkler(a: list[str], b: list[str]) -> np.ndarray:
    """As jaro_winkler, of strings of SHORT - 1 characters at most: of each character of a in turn, the first free equal one of b
    within reach, by the lowest bit."""
    characters, ((x, n), (y, m)) = _codes(a, b)
    masks, one = _masks(y, characters), np.uint64(1)
    rows, reach = np.arange(len(x)), np.maximum(0, np.maximum(n, m) // 2 - 1)
    free, taken = np.full(len(x), ~np.uint64(0)), np.zeros(x.shape, bool)
    for i in range(x.shape[1]):
        hi, lo = np.clip(i + reach + 1, 0, m).astype(np.uint64), np.minimum(np.maximum(0, i - reach), SHORT - 1).astype(np.uint64)
        hit = free & masks[rows, x[:, i]] & ((one << hi) - one) & ~((one << lo) - one)
        bit = hit & (~hit + one)
        taken[:, i] = bit != 0
        free &= ~bit
    other = (free[:, None] >> np.arange(y.shape[1], dtype=np.uint64)) & one == 0
    equal = taken.sum(axis=1)
    moved = np.bincount(np.nonzero(taken)[0], x[taken] != y[other], len(x)) / 2
    some = np.maximum(equal, 1)
    jaro = (equal / n + equal / m + (equal - moved) / some) / 3
    width = min(4, x.shape[1], y.shape[1])
    lead = np.cumprod((x[:, :width] == y[:, :width]) & (x[:, :width] > 0), axis=1).sum(axis=1)
    return np.where(equal == 0, 0.0, np.where(jaro > 0.7, jaro + 0.1 * lead * (1 - jaro), jaro))


def jaro_winklers(a: list[str], b: list[str]) -> list[float]:
    out: list = [None] * len(a)
    fit = []
    for i, (x, y) in enumerate(zip(a, b)):
        if x and y and len(x) < SHORT and len(y) < SHORT:
            fit.append(i)
        else:
            out[i] = jaro_winkler(x, y)
    for k in range(0, len(fit), PAIRS):
        part = fit[k : k + PAIRS]
        for i, value in zip(part, _many_jaro_winkler([a[i] for i in part], [b[i] for i in part]).tolist()):
            out[i] = value
    return out


def levenshteins(a: list[str], b: list[str]) -> list[int]:
    """Edit distances, a row of the table for all pairs of a part at a time."""
    out: list[int] = []
    for k in range(0, len(a), PAIRS):
        _, ((x, n), (y, m)) = _codes(a[k : k + PAIRS], b[k : k + PAIRS])
        found, step = m.copy(), np.arange(y.shape[1] + 1)
        row = np.broadcast_to(step, (len(x), len(step))).copy()
        for i in range(x.shape[1]):
            new = np.empty_like(row)
            new[:, 0] = i + 1
            new[:, 1:] = np.minimum(row[:, 1:] + 1, row[:, :-1] + (x[:, i : i + 1] != y))
            row = np.minimum.accumulate(new - step, axis=1) + step  # insertions
            found = np.where(n == i + 1, row[np.arange(len(x)), m], found)
        out += found.tolist()
    return out


#: Measures of many pairs at a time, the same values as one by one.
MANY = {"jaro_winkler": jaro_winklers, "ratio": indel_ratios, "partial_ratio": partial_ratios, "token_sort_ratio": token_sort_ratios, "token_set_ratio": token_set_ratios, "lcs": lcs_lengths}


def _arrow_function(f, kind: str):
    def of(a: pd.Series, b: pd.Series) -> pd.Series:
        pairs = [None if x is None or y is None else (x, y) for x, y in zip(a, b)]
        known = dict.fromkeys(p for p in pairs if p is not None)  # of this batch
        if known:
            known = dict(zip(known, f(*map(list, zip(*known)))))
        return pd.Series([None if p is None else known[p] for p in pairs], dtype=object)

    return F.pandas_udf(of, kind)


MEASURES = {"ratio": (indel_ratio, "double"), "partial_ratio": (partial_ratio, "double"), "token_sort_ratio": (token_sort_ratio, "double"), "token_set_ratio": (token_set_ratio, "double"), "jaro_winkler": (jaro_winkler, "double"), "lcs": (lcs_length, "long"), "osa": (osa_distance, "long")}


def measure(name: str, a, b):
    """Column of a measure of two string columns."""
    f, kind = MEASURES[name]
    return _arrow_function(MANY.get(name, lambda x, y: list(map(f, x, y))), kind)(a, b)
