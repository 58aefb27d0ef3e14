"""Periodic runs of words, caught online: each completed power-of-two block watches for its own return.

A run is a stretch of words in which words ``p`` apart are identical, longer than a given multiple of ``p``. The part of
it that matches the words ``p`` further on always holds a whole aligned block of 2**k words, so the catcher of that
block sees it return at distance ``p``. Every distance belongs to one level k: blocks of level k watch a band of
distances not longer than a few blocks, so a word is compared once or twice per level, whatever the text holds.

Documents are independent rows: no shuffle, and a lost task is run again on its split.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_chunks, with_unique_names

# Runs that count: at least so many words, and so many times their period.
MIN_LENGTH = 24
MIN_EXPONENT = 3
# Words that are appended at once; bounds the arrays of one step for texts of any length.
SLAB = 1 << 16
WORD = r"[^\x20\x09-\x0D]+"
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


@lru_cache(maxsize=64)
def bands(most: int, min_length: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """(level, lowest period, highest period) for all periods up to ``most``, in order of the periods.

    A run of period p matches its own continuation over at least ``w = max(length, exponent * p) - p`` words, and any
    2**(k+1) - 1 words hold an aligned block of 2**k.
    """
    p = np.arange(1, most + 1)
    level = np.log2(np.maximum(min_length, min_exponent * p) - p + 1).astype(np.int64) - 1
    edges = [0, *(np.flatnonzero(np.diff(level)) + 1).tolist(), most]
    return [(int(level[a]), a + 1, b) for a, b in zip(edges, edges[1:]) if a < b]


class RunCatcher:
    """Takes the words of one text in order, as integers, and knows all runs of what has come so far.

    ``append`` advances every open comparison (a stretch whose words still equal those one period before), then lets
    the blocks of each level compare themselves with the windows that the new words have completed. A block that
    returns opens a stretch: it is extended to both sides word by word, and further returns inside it merge into it.
    """

    def __init__(self, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> None:
        if min_length < 2 or min_exponent < 2:
            raise ValueError("a run has two words and two periods at least")
        self.min_length, self.min_exponent = min_length, min_exponent
        self.n = 0
        self.words = np.zeros(0, np.int64)
        self.prints: list[np.ndarray] = []  # per level the hash of the 2**k words from each place on
        self.filled: list[int] = []  # per level how many of them there are
        self.checked: dict[int, int] = {}  # per band (by its lowest period) how many windows its blocks have seen
        self.open: list[tuple[int, int]] = []  # (start, period) of stretches that reach the last word
        self.found: dict[tuple[int, int], int] = {}  # (start, end) of a run -> its smallest period

    def append(self, words: np.ndarray) -> None:
        for at in range(0, len(words), SLAB):
            self._append(words[at:at + SLAB])

    def finish(self) -> list[tuple[int, int, int]]:
        """All runs as (start, length, period), by start, then period."""
        for start, period in self.open:
            self._close(start, self.n, period)
        return sorted((s, e - s, p) for (s, e), p in self.found.items())

    def _append(self, words: np.ndarray) -> None:
        old, self.n = self.n, self.n + len(words)
        self.words = _room(self.words, self.n)
        self.words[old:self.n] = words
        self._advance(old)
        # Stretches that may hold the windows just completed: those still open and those that ended in the new words.
        around = [(s, self.n, p) for s, p in self.open] + [w for w in self.ended if w[1] > old]
        # Bands are asked for by powers of two, so that texts of many lengths share them.
        for level, low, high in bands(1 << self.n.bit_length(), self.min_length, self.min_exponent):
            if low + (1 << level) > self.n:
                break
            self._fill(level)
            begin, seen = self._returns(level, low, high)
            while len(begin):
                s, p = int(begin[0]), int(seen[0] - begin[0])
                covered = next((w for w in around if p % w[2] == 0 and w[0] <= s and s + p + (1 << level) <= w[1]), None)
                if covered is None:
                    covered = self._stretch(s, p, level)
                    around.append(covered) if covered else None
                if covered is None:  # two hashes that agree by chance
                    begin, seen = begin[1:], seen[1:]
                    continue
                a, e, q = covered
                period = seen - begin
                merged = (period % q == 0) & (begin >= a) & (seen + (1 << level) <= e)
                begin, seen = begin[~merged], seen[~merged]

    def _advance(self, old: int) -> None:
        """Compare the new words with those one period before, for every open stretch."""
        still, self.ended = [], []
        for start, period in self.open:
            end = self._forward(old, period)
            if end == self.n:
                still.append((start, period))
            else:
                self._close(start, end, period)
                self.ended.append((start, end, period))
        self.open = still

    def _fill(self, level: int) -> None:
        """Hashes of windows of 2**level words, each from two of half the size."""
        for k in range(level + 1):
            if k == len(self.prints):
                self.prints.append(np.zeros(0, np.uint64))
                self.filled.append(0)
            a, b = self.filled[k], self.n - (1 << k) + 1
            if b <= a:
                continue
            out = self.prints[k] = _room(self.prints[k], b)
            if k == 0:
                out[a:b] = self.words[a:b]
            else:
                half, low = 1 << (k - 1), self.prints[k - 1]
                left = low[a:b]
                out[a:b] = (left ^ (left >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + low[a + half:b + half]
            self.filled[k] = b

    def _returns(self, level: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """(block, window) pairs where a block's hash returns within its band, by period, then place."""
        prints, size = self.prints[level], 1 << level
        first = max(self.checked.get(low, 0), low)
        last = self.filled[level]
        self.checked[low] = last
        if first >= last:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        window = np.arange(first, last)
        nearest = (window - low) >> level << level
        hits = []
        for back in range(0, high - low + size, size):
            block = nearest - back
            inside = (block >= 0) & (window - block <= high)
            at = np.flatnonzero(inside & (prints[first:last] == prints[np.maximum(block, 0)]))
            if len(at):
                hits.append((block[at], window[at]))
        if not hits:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        block, window = (np.concatenate(x) for x in zip(*hits))
        order = np.lexsort((block, window - block))
        return block[order], window[order]

    def _stretch(self, block: int, period: int, level: int) -> tuple[int, int, int] | None:
        """The whole stretch around a returned block; None if the words differ after all."""
        end = self._forward(block + period, period)
        if end < block + period + (1 << level):
            return None
        start = self._backward(block, period)
        if end == self.n:
            self.open.append((start, period))
        else:
            self._close(start, end, period)
        return start, end, period

    def _forward(self, at: int, period: int) -> int:
        """First place from ``at`` on whose word differs from the one a period before."""
        step = 64
        while at < self.n:
            to = min(at + step, self.n)
            differ = self.words[at:to] != self.words[at - period:to - period]
            i = int(differ.argmax())
            if differ[i]:
                return at + i
            at, step = to, step * 2
        return self.n

    def _backward(self, at: int, period: int) -> int:
        """First place of the stretch that holds ``at``."""
        step = 64
        while at > 0:
            to = max(at - step, 0)
            differ = (self.words[to:at] != self.words[to + period:at + period])[::-1]
            i = int(differ.argmax())
            if differ[i]:
                return at - i
            at, step = to, step * 2
        return 0

    def _close(self, start: int, end: int, period: int) -> None:
        if end - start >= max(self.min_length, self.min_exponent * period):
            known = self.found.get((start, end), period)
            self.found[start, end] = min(known, period)


def _room(held: np.ndarray, n: int) -> np.ndarray:
    """The array with room for ``n`` entries; doubled when it grows."""
    if len(held) >= n:
        return held
    out = np.zeros(max(n, 2 * len(held)), held.dtype)
    out[:len(held)] = held
    return out


def runs_of(words: list, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """All runs of a list of words."""
    if len(words) < min_length:
        return []
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    catcher = RunCatcher(min_length, min_exponent)
    catcher.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
    return catcher.finish()


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words outside of all repeats; of each run its first period stays, unless another run repeats it."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def word_runs(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text",
              min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """Runs of words and the text without their repeats, one row per input row.

    Returns ``doc_id``, ``n_words``, ``runs`` (start, length and smallest period in words, by start, then period) and
    ``collapsed`` (the kept words joined by one blank). Words are ``[^\\x20\\x09-\\x0D]+``, compared as they are. A null
    or empty text has no words, no runs and an empty ``collapsed``; ids may be null or repeat, each row is answered;
    other columns are ignored, whatever their names. A text of any length is read whole: memory grows with its words
    (about 8 bytes a word and level of the longest period), time with words times the logarithm of their number.
    """
    docs = with_unique_names(documents, doc_id=id_column, text=text_column)
    kind = dict(docs.dtypes)["doc_id"]
    layout = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, max_bytes=2 << 20):
            counts, found, kept = [], [], []
            for text in chunk.column("text").to_pylist():
                words = text.encode("utf-8", "surrogatepass").split() if text else []
                runs = runs_of(words, min_length, min_exponent)
                counts.append(len(words))
                found.append([{"start": s, "length": n, "period": p} for s, n, p in runs])
                kept.append(b" ".join(collapsed(words, runs)))
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), pa.array(counts, pa.int64()), pa.array(found, layout),
                 pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.mapInArrow(find, f"doc_id {kind}, n_words long, runs {RUNS}, collapsed string")


def with_planted_repeat(text: Column, doc_id: Column) -> Column:
    """The contract's text: about every tenth document repeats some of its words from a place on, by its id's checksum.

    Other documents keep their text, as do those with a null id. Changed texts have one blank between words.
    """
    check = F.crc32(doc_id.cast("string").cast("binary"))
    seed = F.floor(check / 10)

    def changed(words: Column) -> Column:
        n = F.size(words)
        first = (seed % n).cast("int")
        period = F.lit(1) + F.floor((n - first) / (3 + seed % 8)).cast("int")
        times = F.ceil((n - first) / period).cast("int")
        repeat = F.flatten(F.array_repeat(F.slice(words, first + 1, period), times))
        return F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), first), repeat), F.lit(1), n), " ")

    # Bound as a variable, the words are cut once and not once per use.
    bound = F.transform(F.array(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), changed)[0]
    return F.when((check % 10 == 0) & text.rlike(WORD), bound).otherwise(text)


def run_digests(found: DataFrame) -> DataFrame:
    """Counts, the run of the greatest exponent, and digests of all runs and of the collapsed text."""
    best = F.aggregate(
        "runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"),
        lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"), "n_words")
