"""Periodic runs of words: difference-cover LCE queries on a harmonic grid.

Words become numbers, and many texts one array with a number of its own between
any two.  For every period q the places on a grid that a run of that period
cannot miss are compared with the places q further on, a few words each, which leaves next
to nothing where nothing repeats.  How far the equality reaches from a place
that is left, in both directions, is the longest common extension of two
suffixes: only the suffixes at the residues of a difference cover are sorted
(prefix doubling), two suffixes are compared word by word up to the first
place where both are in the sample, and a sparse table over the sample's
neighbours answers the rest with a range minimum.  All of it works on whole
arrays at a time; texts are independent, so tasks share nothing.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

#: A run's shortest length, and how many times its period it has at least.
LEAST, TIMES = 24, 3
#: Differences modulo PERIOD all occur between two residues of COVER.
PERIOD, COVER = 13, (0, 1, 3, 9)
#: Words compared at a place of the grid.
FEW = 8
#: Words of texts that are worked on together, and pairs of places at a time.
TOGETHER, PAIRS = 1 << 20, 1 << 20

_SAMPLED = np.zeros(PERIOD, bool)
_SAMPLED[list(COVER)] = True
#: Steps from residues (i, j) until both places are in the sample.
_STEPS = np.array([[next(d for d in range(PERIOD) if _SAMPLED[(i + d) % PERIOD] and _SAMPLED[(j + d) % PERIOD])
                    for j in range(PERIOD)] for i in range(PERIOD)], np.int64)


class Extensions:
    """Longest common extensions of the suffixes of ``codes`` (no number of which is from -2 * PERIOD to -1)."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        n = len(codes)
        self.padded = np.concatenate([codes, np.arange(-1, -1 - 2 * PERIOD, -1, dtype=codes.dtype)])
        places = np.flatnonzero(_SAMPLED[np.arange(n) % PERIOD])
        number = np.full(n + PERIOD, -1, np.int64)  # of a sampled place among them
        number[places] = np.arange(len(places))
        order, levels = self._sorted(places, number, n)
        self.number, self.rank = number, np.empty(len(places), np.int64)
        self.rank[order] = np.arange(len(places))
        self.table = self._minima(self._neighbours(places, order, levels, number, n))

    def _sorted(self, places: np.ndarray, number: np.ndarray, n: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """The sampled suffixes in order, and their ranks by the first PERIOD * 2 ** k words for each k."""
        keys = [self.padded[places + d] for d in range(PERIOD)]
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(places), bool)
        for key in keys:
            new[1:] |= key[order][1:] != key[order][:-1]
        rank = np.empty(len(places), np.int64)
        rank[order] = np.cumsum(new)
        levels, reach = [rank], PERIOD
        while len(places) and rank[order[-1]] < len(places) - 1:
            after = places + reach
            inside = after < n
            beyond = np.zeros(len(places), np.int64)
            beyond[inside] = rank[number[after[inside]]] + 1
            key = rank * (len(places) + 1) + beyond
            order = np.argsort(key, kind="stable")
            rank = np.empty(len(places), np.int64)
            rank[order] = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
            levels.append(rank)
            reach *= 2
        return order, levels

    def _neighbours(self, places: np.ndarray, order: np.ndarray, levels: list[np.ndarray], number: np.ndarray, n: int) -> np.ndarray:
        """The common extension of each sampled suffix and the one before it in order."""
        a, b = places[order[:-1]].copy(), places[order[1:]].copy()
        length = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            inside = (a < n) & (b < n)
            same = np.zeros(len(a), bool)
            same[inside] = levels[k][number[a[inside]]] == levels[k][number[b[inside]]]
            step = same * (PERIOD << k)
            length, a, b = length + step, a + step, b + step
        return length + self._few(a, b, np.full(len(a), PERIOD, np.int64))

    def _few(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from places a and b on, ``most`` at most."""
        found = np.zeros(len(a), np.int64)
        going = np.flatnonzero(most > 0)
        end = len(self.padded) - 1
        while len(going):
            at = found[going]
            same = self.padded[np.minimum(a[going] + at, end)] == self.padded[np.minimum(b[going] + at, end)]
            going = going[same]
            found[going] += 1
            going = going[found[going] < most[going]]
        return found

    @staticmethod
    def _minima(values: np.ndarray) -> list[np.ndarray]:
        table, width = [values], 1
        while 2 * width <= len(values):
            table.append(np.minimum(table[-1][:-width], table[-1][width:]))
            width *= 2
        return table

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that are equal from i and from j on (i != j; places inside the array)."""
        steps = _STEPS[i % PERIOD, j % PERIOD]
        found = self._few(i, j, steps)
        rest = np.flatnonzero(found == steps)
        a, b = i[rest] + steps[rest], j[rest] + steps[rest]
        inside = np.maximum(a, b) < len(self.codes)
        rest, a, b = rest[inside], a[inside], b[inside]
        ra, rb = self.rank[self.number[a]], self.rank[self.number[b]]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        level = np.frexp((high - low).astype(float))[1] - 1  # floor of the binary logarithm
        least = np.empty(len(rest), np.int64)
        for k in np.unique(level):
            at = level == k
            row = self.table[k]
            least[at] = np.minimum(row[low[at]], row[high[at] - (1 << int(k))])
        found[rest] += least
        return found


def _grid(n: int, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, periods) that runs of an array of n words cannot miss, by periods up to ``longest``, PAIRS at a time or so.

    A run of period q has ``max(LEAST, TIMES * q) - q`` places or more where the word
    q further on is equal; a step that is FEW - 1 shorter finds a place
    with FEW of them ahead.
    """
    periods = np.arange(1, longest + 1, dtype=np.int64)
    steps = np.maximum(LEAST, TIMES * periods) - periods - FEW + 1
    counts = np.maximum(0, (n - periods - FEW) // steps + 1)
    at = 0
    while at < len(periods):
        stop = max(at + 1, int(np.searchsorted(np.cumsum(counts[at:]), PAIRS, "right")) + at)
        own = counts[at:stop]
        total = int(own.sum())
        if total:
            place = (np.arange(total) - np.repeat(np.cumsum(own) - own, own)) * np.repeat(steps[at:stop], own)
            yield place, np.repeat(periods[at:stop], own)
        at = stop


def _equal(codes: np.ndarray, place: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places with FEW words equal to those a period further on."""
    for d in range(FEW):
        same = np.flatnonzero(codes[place + d] == codes[place + d + period])
        place, period = place[same], period[same]
    return place, period


def _joined(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The texts in one array with numbers of their own between, and where each begins."""
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    codes = np.empty(starts[-1], np.int64)
    for k, (t, at) in enumerate(zip(texts, starts)):
        codes[at:at + len(t)] = t
        codes[at + len(t)] = -1 - 2 * PERIOD - 1 - k  # ends of texts; smaller than any padding
    return codes, starts[:-1]


def _stretches(codes: np.ndarray, longest: int) -> Iterator[tuple[int, int, int]]:
    """(start, stop, smallest period) of the runs in an array of joined texts."""
    n = len(codes)
    ahead, behind = Extensions(codes), Extensions(codes[::-1].copy())
    held, until = np.ones(n, np.int64), np.zeros(n, np.int64)  # period and end of the last run found that holds a place
    seen: dict[tuple[int, int], int] = {}
    for place, period in _grid(n, longest):
        place, period = _equal(codes, place, period)
        # a run of a period that divides this one and holds both places is the same stretch
        new = np.flatnonzero((period % held[place] != 0) | (place + period >= until[place]))
        place, period = place[new], period[new]
        if not len(place):
            continue
        right = place + period + ahead.of(place, place + period)
        left, later = place.copy(), np.flatnonzero(place)
        left[later] -= behind.of(n - place[later], n - place[later] - period[later])
        long = right - left >= np.maximum(LEAST, TIMES * period)
        for a, b, q in np.unique(np.stack([left[long], right[long], period[long]], 1), axis=0).tolist():
            if (a, b) not in seen:  # periods come in rising order
                seen[a, b] = q
                held[a:b], until[a:b] = q, b
    return iter([(a, b, q) for (a, b), q in seen.items()])


def runs_of(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of each text (arrays of word numbers from 0), by start, then period.

    A run has at least max(LEAST, TIMES * period) words, its period is its
    smallest, and it cannot be extended.
    """
    result: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    classes = defaultdict(list)  # of about equal length, as the longest decides how far periods go
    for i, t in enumerate(texts):
        if len(t) >= LEAST:
            classes[len(t).bit_length()].append(i)
    for members in classes.values():
        codes, starts = _joined([texts[i] for i in members])
        longest = max(len(texts[i]) for i in members) // TIMES
        marked = np.zeros(len(members), bool)
        for place, period in _grid(len(codes), longest):
            marked[np.searchsorted(starts, _equal(codes, place, period)[0], "right") - 1] = True
        # suffixes are sorted only of the texts that have such a place
        own = [members[k] for k in np.flatnonzero(marked)]
        if not own:
            continue
        codes, starts = _joined([texts[i] for i in own])
        for a, b, q in _stretches(codes, max(len(texts[i]) for i in own) // TIMES):
            k = int(np.searchsorted(starts, a, "right")) - 1
            result[own[k]].append((a - int(starts[k]), b - a, q))
    for own in result:
        own.sort(key=lambda r: (r[0], r[2]))
    return result


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """True for each of n words that no run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest length / period, compared exactly, then the smallest start, then period."""
    best = None
    for run in runs:  # by start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def repeated_tail(words: np.ndarray, doc_id: int) -> np.ndarray:
    """The words of a document that the periodic test rule makes repeat (a tenth of them), else as they are."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([words[:a], words[a + np.arange(n - a) % p]])


def _digests(ids: list[int | None], texts: list[bytes | None], planted: bool) -> Iterator[tuple]:
    """A result row for each text, TOGETHER words or so at a time."""
    at = 0
    while at < len(ids):
        numbers: dict[bytes, int] = defaultdict()
        numbers.default_factory = numbers.__len__
        words, size, start = [], 0, at
        while at < len(ids) and (at == start or size < TOGETHER):
            split = (texts[at] or b"").split()
            codes = np.fromiter(map(numbers.__getitem__, split), np.int64, len(split))
            words.append(repeated_tail(codes, ids[at]) if planted and ids[at] is not None else codes)
            size += len(split)
            at += 1
        spelled = list(numbers)
        for i, own, runs in zip(ids[start:at], words, runs_of(words)):
            left = own[kept_words(len(own), runs)] if runs else own
            collapsed = hashlib.sha256(b" ".join(map(spelled.__getitem__, left.tolist()))).hexdigest()
            listed = hashlib.sha256("".join(f"{a},{b},{q}\n" for a, b, q in runs).encode()).hexdigest()
            best = strongest(runs)
            yield (i, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], listed, collapsed)


_RESULT = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_runs", "start", "length", "period", "exponent_milli")),
                     ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])


def periodic_runs(docs: DataFrame, text: str = "text", planted: bool = False) -> DataFrame:
    """doc_id, n_runs, the strongest run and digests of all runs and of the collapsed text, for every row.

    Words are runs of anything but ASCII white space.  A null or blank text has
    no run, nulls for the strongest, and digests of nothing.  ``planted`` first
    makes the tail of a tenth of the documents repeat, as the registered query asks; rows
    with a null doc_id stay as they are.  Repeated ids are rows of their own,
    other columns are ignored, and an empty table gives an empty result.
    """
    ship(docs.sparkSession)
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_digests(batch.column(0).to_pylist(), batch.column(1).to_pylist(), planted))
            columns = zip(*found) if found else [()] * len(_RESULT)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _RESULT)], schema=_RESULT)

    return kept.mapInArrow(run, "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, "
                                "exponent_milli bigint, runs_sha256 string, collapsed_sha256 string")


def collapse_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents, columns as they were, with each run cut down to its first period.

    Texts without a run, null texts included, are unchanged; in the others the
    words that stay are joined by single spaces.
    """
    ship(docs.sparkSession)
    at, names = docs.columns.index(text), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for t in batch.column(at):
                whole = t.as_py()
                split = (whole or "").encode("utf-8", "replace").split()
                numbers: dict[bytes, int] = {}
                codes = np.array([numbers.setdefault(w, len(numbers)) for w in split], np.int64)
                (runs,) = runs_of([codes])
                if runs:
                    whole = b" ".join(split[i] for i in np.flatnonzero(kept_words(len(split), runs)).tolist()).decode()
                texts.append(whole)
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, docs.schema)
