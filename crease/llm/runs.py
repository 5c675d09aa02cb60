"""Periodic runs of words by internal pattern matching.

A run is a maximal stretch of words of smallest period q that holds REPEATS periods or more.
The words of a piece of texts are one array, with a word of its own after each text. Prefix
doubling sorts the suffixes and keeps the rank of every stretch of 2^k words, so equal
stretches, common extensions both ways and the suffix array interval of a stretch are array
reads. A run of period q between m = 2^k and 2m holds a block of m words that starts at a
multiple of m, and a copy of it q words on. So each block asks for its occurrences among the
next starts i+m .. i+2m-1: range successors of the wavelet matrix over the suffix array give
the first two and their number. Occurrences that near each other form a progression:

* one or two: their distances are candidate periods;
* three or more: the difference p is the block's own period; if block and copy lie in
  different stretches of period p, the run's period is the distance of their starts or of
  their ends (a run that holds neither end would have period p itself).

The smallest blocks also ask for the starts i+1 .. i+m-1, for periods below m. A candidate is
extended to both sides; of the candidates with one extent, the least is its smallest period.

Defined results: a null text, or one without words, has no runs and an empty collapsed text;
rows are independent, so repeated rows get equal results; a null id stays null; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease.llm.chunks import map_chunks
from crease.llm.common import words
from crease.llm.wavelet import WaveletMatrix

MIN_WORDS = 24
REPEATS = 3


class Suffixes:
    """Suffix array of ``x`` and the ranks of its stretches of 2^k items.

    Rank: how many suffixes are less by their first 2^k items. ``x`` must end with an item
    found nowhere else, and so must each of its texts; that stops every comparison."""

    def __init__(self, x: np.ndarray):
        n = len(x)
        self.order = np.argsort(x, kind="stable").astype(np.int32)
        key = x[self.order]
        head = np.ones(n, bool)
        head[1:] = key[1:] != key[:-1]
        slot = np.flatnonzero(head)
        rank = np.empty(n, np.int32)
        rank[self.order] = np.repeat(slot, np.diff(slot, append=n))
        self.levels = [rank.copy()]
        # only suffixes that share their rank with others are sorted on
        tied = np.flatnonzero(~(head & np.append(head[1:], True)))
        step = 1
        while len(tied):
            at = self.order[tied]
            key = rank[at].astype(np.int64) * n + rank[at + step]
            by = np.argsort(key, kind="stable")
            key, at = key[by], at[by]
            self.order[tied] = at
            head = np.ones(len(key), bool)
            head[1:] = key[1:] != key[:-1]
            start = np.flatnonzero(head)
            rank[at] = np.repeat(tied[start], np.diff(start, append=len(key)))
            self.levels.append(rank.copy())
            tied = tied[~(head & np.append(head[1:], True))]
            step *= 2

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Items that the suffixes at ``i`` and ``j`` (i < j) have in common."""
        i, j, first = i.copy(), j.copy(), i
        for k in range(len(self.levels) - 1, -1, -1):
            step = np.where(self.levels[k][i] == self.levels[k][j], 1 << k, 0)
            i += step
            j += step
        return i - first

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Items that the prefixes before ``i`` and ``j`` (i < j) have in common at their end."""
        i, j, first = i.copy(), j.copy(), i
        for k in range(len(self.levels) - 1, -1, -1):
            back_i, back_j = np.maximum(i - (1 << k), 0), np.maximum(j - (1 << k), 0)
            step = np.where((i >= 1 << k) & (self.levels[k][back_i] == self.levels[k][back_j]), 1 << k, 0)
            i -= step
            j -= step
        return first - i


def candidates(s: Suffixes, base: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period): for each run, one of them is a place in it and its smallest period."""
    n = len(s.order)
    tree = WaveletMatrix(s.order, max(1, int(n - 1).bit_length()))
    places, periods = [], []

    def add(i, q):
        ok = (q > 0) & (i + q < n)
        places.append(i[ok])
        periods.append(q[ok])

    for k in range(base.bit_length() - 1, len(s.levels)):
        m = 1 << k
        i = np.arange(0, n - m, m, dtype=np.int64)
        lo = s.levels[k][i].astype(np.int64)
        hi = lo + np.bincount(s.levels[k], minlength=n)[lo]
        i, lo, hi = (a[hi - lo > 1] for a in (i, lo, hi))
        for begin, end in ([(1, m)] if m == base else []) + [(m, 2 * m)]:
            before = tree.count_less(lo, hi, i + begin)
            found = tree.count_less(lo, hi, i + end) - before
            some = found > 0
            j, first = i[some], tree.quantile(lo[some], hi[some], before[some])
            add(j, first - j)
            two = found > 1
            j, first = i[two], first[found[some] > 1]
            second, number = tree.quantile(lo[two], hi[two], before[two] + 1), found[two]
            few = number == 2
            add(j[few], (second - j)[few])
            j, first, p = j[~few], first[~few], (second - first)[~few]
            if begin > 1 and len(j):
                add(j, first - s.backward(first, first + p) - (j - s.backward(j, j + p)))
                add(j, first + s.forward(first, first + p) - (j + s.forward(j, j + p)))
    return np.concatenate([*places, np.zeros(0, np.int64)]), np.concatenate([*periods, np.zeros(0, np.int64)])


def find_runs(x: np.ndarray, min_words: int = MIN_WORDS,
              repeats: int = REPEATS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of ``x``, by start, then end. ``x``: see ``Suffixes``."""
    if repeats < 3 or min_words < 3:
        raise ValueError("a run is found from three periods and three words on")
    s = Suffixes(x)
    base = 1 << ((min_words + 2) // 3).bit_length() - 1  # 3 * base - 2 words are enough to find it
    i, q = candidates(s, base)
    start, end = i - s.backward(i, i + q), i + q + s.forward(i, i + q)
    ok = end - start >= np.maximum(min_words, repeats * q)
    start, end, q = start[ok], end[ok], q[ok]
    by = np.lexsort((q, end, start))
    start, end, q = start[by], end[by], q[by]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return start[new], end[new], q[new]


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  min_words: int = MIN_WORDS, repeats: int = REPEATS) -> DataFrame:
    """Rows doc_id, n_words, runs (array of start, length, period, by start, then period) and
    collapsed: the words that no run holds after its first period, joined by a space."""

    def work(piece: pa.RecordBatch) -> dict:
        bodies = [(t or "").encode("utf-8", "surrogatepass").split() for t in piece["text"].to_pylist()]
        sizes = np.array([len(b) for b in bodies], np.int64)
        number: dict[bytes, int] = {}
        x = np.empty(int(sizes.sum()) + len(bodies), np.int64)
        at = 0
        for d, body in enumerate(bodies):
            x[at:at + len(body)] = [number.setdefault(w, len(number)) for w in body]
            at += len(body)
            x[at] = -1 - d  # ends the text, found nowhere else
            at += 1
        first = np.concatenate([[0], np.cumsum(sizes + 1)])
        start, end, q = find_runs(x, min_words, repeats)
        gone = np.zeros(len(x) + 1, np.int32)
        np.add.at(gone, start + q, 1)
        np.add.at(gone, end, -1)
        kept = (np.cumsum(gone) == 0)[:-1]
        doc = np.searchsorted(first, start, side="right") - 1
        own = np.searchsorted(doc, np.arange(len(bodies) + 1))
        collapsed = [b" ".join([w for w, k in zip(body, kept[at:at + len(body)]) if k] if own[d] < own[d + 1]
                               else body) for d, (body, at) in enumerate(zip(bodies, first.tolist()))]
        rows = pa.StructArray.from_arrays(
            [pa.array(a, pa.int64()) for a in (start - first[doc], end - start, q)],
            ["start", "length", "period"])
        return {"n_words": pa.array(sizes, pa.int64()),
                "runs": pa.ListArray.from_arrays(pa.array(own, pa.int32()), rows),
                "collapsed": pa.array([c.decode("utf-8", "surrogatepass") for c in collapsed], pa.string())}

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = map_chunks(rows, work, ["doc_id"], "n_words long, runs array<struct<start:long,"
                       "length:long,period:long>>, collapsed string")
    return found.withColumn("runs", F.array_sort("runs", lambda a, b: _order(
        a["start"] - b["start"], a["period"] - b["period"])))


def _order(*differences: Column) -> Column:
    """Comparator for ``array_sort``: the sign of the first difference that is not zero."""
    out = F.lit(0)
    for d in reversed(differences):
        out = F.when(d < 0, -1).when(d > 0, 1).otherwise(out)
    return out


def strongest(runs: Column) -> Column:
    """The run of the greatest length / period; of equal ones the first, then the least period."""
    return F.get(F.array_sort(runs, lambda a, b: _order(
        b["length"] * a["period"] - a["length"] * b["period"], a["start"] - b["start"],
        a["period"] - b["period"])), F.lit(0))


def with_planted_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs``, in which a tenth of the texts, by a hash of the id, turns periodic at some word.

    h = crc32(id); texts with h % 10 = 0: every word from a = g % n on repeats the p words from
    a on, where g = h div 10, n the number of words and p = 1 + (n - a) div (3 + g % 8)."""
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    w, g = F.col("__w"), F.floor(h / 10)
    size = F.size(w)
    n = F.greatest(size, F.lit(1))
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    period = F.slice(w, a + 1, p)
    laps = F.ceil((n - a) / p).cast("int")
    planted = F.concat(F.slice(w, 1, a), F.slice(F.flatten(F.array_repeat(period, laps)), F.lit(1), n - a))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    # only the chosen texts are split; the words of the others are not looked at here
    split = docs.withColumn("__w", F.when(chosen, words(F.col(text))).otherwise(F.array().cast("array<string>")))
    return split.withColumn(text, F.when(size > 0, F.array_join(planted, " ")).otherwise(F.col(text))).drop("__w")
