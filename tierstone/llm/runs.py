"""Periodic runs of words, found online by catchers over completed power-of-two blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from tierstone.llm.common import extended, free_name, slices, texts
from tierstone.llm.rolling import BASES, mixed, powers

MIN_LENGTH, MIN_EXPONENT = 24, 3
#: Words are appended in stretches of this many; the result does not depend on it.
STRETCH = 1 << 16
RUN_TYPE = ArrayType(StructType([StructField(name, LongType()) for name in ("start", "length", "period")]))


class RunCatcher:
    """Squares, merged into runs, of a word sequence that grows at its end.

    A square of period q holds, in its first half, a whole block of B = 2^k words at a
    multiple of B, where 2B - 1 <= q <= 4B - 2. Each completed block opens a catcher, which
    waits for the block's words to return at such a distance. At every place exactly two
    catchers of a level are open, so an appended word costs two suffix comparisons a level,
    by hash. A return is extended word by word to the maximal stretch of equal
    words q apart; squares of one period that overlap are one stretch. Stretches that reach
    the end stay open, and appended words extend them.

    With an exponent of 3 or more every run holds two adjacent blocks that return at the same
    distance, so catchers compare twice the block's width.
    """

    def __init__(self, exponent: int = MIN_EXPONENT):
        self.exponent = exponent
        self.codes = np.zeros(0, np.int64)
        self.sums = np.zeros(1, np.uint64)
        self.catchers: list[list[np.ndarray]] = []
        self.equal: dict[int, list[list[int]]] = {}  # period -> stretches [s, e) of words equal to those a period before
        self.cover: tuple[np.ndarray, ...] | None = None

    def append(self, codes: np.ndarray) -> None:
        """Append words, given by number."""
        old, n = len(self.codes), len(self.codes) + len(codes)
        values = mixed(codes.astype(np.uint64) + np.uint64(1)) * powers(BASES[0], n)[old:]
        self.codes = np.concatenate((self.codes, codes)) if old else codes
        self.sums = np.concatenate((self.sums, self.sums[-1] + np.cumsum(values, dtype=np.uint64)))
        for period, stretches in self.equal.items():
            if stretches[-1][1] == old:
                stretches[-1][1] = self._equal_up_to(period, old)
        self.cover = None
        back = powers(pow(BASES[0], -1, 1 << 64), n + 1)
        level, block = 0, 1
        while True:
            width = 2 * block if self.exponent >= 3 else block
            if 2 * block - 1 + width > n:
                break
            first = max(old - width + 1, 0)
            hashes = (self.sums[first + width :] - self.sums[first : n + 1 - width]) * back[first : n + 1 - width]
            if level == len(self.catchers):
                # blocks that were complete before this level was looked at for the first time
                done = np.arange(0, first, block)
                self.catchers.append([(self.sums[done + width] - self.sums[done]) * back[done]])
            self.catchers[level].append(hashes[-first % block :: block])
            self._catch(level, block, width, first, hashes)
            level, block = level + 1, 2 * block

    def _catch(self, level: int, block: int, width: int, first: int, hashes: np.ndarray) -> None:
        waiting = np.concatenate(self.catchers[level])
        self.catchers[level] = [waiting]
        skip = max(2 * block - 1 - first, 0)
        places = np.arange(first + skip, first + len(hashes))
        nearer = (places - (2 * block - 1)) // block
        seen = hashes[skip:]
        hit = waiting[nearer] == seen
        again = (waiting[nearer - 1] == seen) & (nearer > 0)
        if not (hit.any() or again.any()):
            return
        found = np.concatenate((places[hit], places[again]))
        period = found - np.concatenate((nearer[hit], nearer[again] - 1)) * block
        order = np.lexsort((found, period))
        found, period = found[order], period[order]
        edges = np.flatnonzero(np.concatenate(([True], period[1:] != period[:-1], [True])))
        if len(edges) > 2:
            open_ = ~self._covered(found, period, width)
            found, period = found[open_], period[open_]
            edges = np.flatnonzero(np.concatenate(([True], period[1:] != period[:-1], [True]))) if len(found) else edges[:1]
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            self._merge(int(period[a]), found[a:b], width)

    def _merge(self, period: int, places: np.ndarray, width: int) -> None:
        """Extend returns at one distance, from left to right; those inside a known stretch are skipped."""
        places = places[~self._covered(places, np.full(len(places), period), width)]
        known = self.equal.get(period)
        at = int(np.searchsorted(places, known[-1][1])) if known else 0
        while at < len(places):
            place = int(places[at])
            start, end = self._equal_down_to(period, place), self._equal_up_to(period, place)
            if end - start >= (self.exponent - 1) * period or end == len(self.codes) and end > start:
                self.equal.setdefault(period, []).append([start, end])
                self.cover = None
            at = max(int(np.searchsorted(places, end)), at + 1)

    def _covered(self, places: np.ndarray, period: np.ndarray, width: int) -> np.ndarray:
        """Whether a return lies inside a known run whose period divides its distance: nothing new then."""
        if self.cover is None:
            known = sorted((s - q, e, q) for q, stretches in self.equal.items() for s, e in stretches if e - s >= q)
            if known:
                starts, ends, periods = (np.array(x, np.int64) for x in zip(*known))
                reach = np.maximum.accumulate(ends)
                widest = np.maximum.accumulate(np.where(ends == reach, np.arange(len(ends)), 0))
                self.cover = starts, reach, periods[widest]
            else:
                self.cover = ()
        if not self.cover:
            return np.zeros(len(places), bool)
        starts, reach, periods = self.cover
        at = np.searchsorted(starts, places - period, "right") - 1
        inside = (at >= 0) & (reach[at] >= places + width)
        return inside & (periods[at] < period) & (period % periods[at] == 0)

    def _equal_up_to(self, period: int, place: int) -> int:
        n, step = len(self.codes), 32
        while place < n:
            m = min(step, n - place)
            differs = self.codes[place : place + m] != self.codes[place - period : place - period + m]
            k = int(differs.argmax())
            if differs[k]:
                return place + k
            place, step = place + m, 4 * step
        return n

    def _equal_down_to(self, period: int, place: int) -> int:
        step = 32
        while place > period:
            m = min(step, place - period)
            differs = (self.codes[place - m : place] != self.codes[place - m - period : place - period])[::-1]
            k = int(differs.argmax())
            if differs[k]:
                return place - k
            place, step = place - m, 4 * step
        return period

    def runs(self, min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
        """(start, length, smallest period) of every run long enough, by start and period."""
        smallest: dict[tuple[int, int], int] = {}
        for period, stretches in self.equal.items():
            for s, e in stretches:
                length = e - s + period
                if length >= max(min_length, self.exponent * period):
                    key = (s - period, length)
                    smallest[key] = min(period, smallest.get(key, period))
        return sorted((start, length, period) for (start, length), period in smallest.items())


def runs_of(words: list[bytes], min_length: int = MIN_LENGTH, exponent: int = MIN_EXPONENT, stretch: int = STRETCH) -> list[tuple[int, int, int]]:
    number = dict(zip(dict.fromkeys(words), range(len(words))))
    codes = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    catcher = RunCatcher(exponent)
    for at in range(0, len(codes), stretch):
        catcher.append(codes[at : at + stretch])
    return catcher.runs(min_length)


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Words without those that some run holds after its first period."""
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()] if runs else words


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH, exponent: int = MIN_EXPONENT, names: tuple[str, str] = ("runs", "collapsed")) -> DataFrame:
    """`docs` with its runs and its text without the repetitions, words joined by one space.

    A run is a stretch of words with smallest period q, words q apart being identical, of
    at least max(min_length, exponent * q) words, that neither neighbouring word extends. Words are
    `[^\\x20\\x09-\\x0D]+`, compared byte by byte, numbered from 0. Each row is judged by itself: no
    shuffle; repeated rows, ties and null ids stay as they are. A null or blank text has no words,
    no runs and an empty collapsed text. Texts of any length are read whole: memory is some 50 bytes
    a word of the longest text. An empty table gives no rows. All columns of `docs` stay;
    the new ones get underscores before their names where those are taken.
    """
    added = [free_name(docs, name) for name in names]
    schema = extended(docs.schema, **{added[0]: RUN_TYPE, added[1]: "string"})
    run_type = pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")]))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            runs, kept = [], []
            for text in texts(batch):
                words = (text or "").encode().split()
                found = runs_of(words, min_length, exponent)
                runs.append([dict(zip(("start", "length", "period"), r)) for r in found])
                kept.append(b" ".join(collapsed(words, found)).decode())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(runs, run_type), pa.array(kept, pa.string())], schema.names)

    return docs.mapInArrow(look, schema)
