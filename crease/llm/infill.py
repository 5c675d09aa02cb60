"""Fill-in-the-middle transformation: documents cut at unit boundaries and reordered.

The code points of a piece of texts are one array of character classes (separator, line
feed, word character; each with a bit that tells whether the run ends there) in a wavelet
matrix. Rank queries of the classes that end a unit add up to the number of boundaries
before a place, and bisection on these ranks finds the place of a boundary, for both cuts
of all texts at once. Units:

* ``words``: a word with the separators before it; separators that end the text are one more;
* ``lines``: a line with its line feed; what follows the last one is one more;
* ``chars``: single code points.

A document is transformed with a chance of ``rate`` percent, by a hash of the seed and the
id, then written suffix first (spm) or prefix first (psm).

Defined results: a null or empty text is plain with 0 units; a text that holds a marker is
plain; a null id hashes as the empty string; rows with equal id and text get equal results;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease.llm.chunks import map_chunks
from crease.llm.wavelet import WaveletMatrix

MARKERS = ("<P>", "<S>", "<M>")  # before prefix, suffix and middle
RATE, SPM_SHARE, SEED = 50, 80, 42
#: Class of a code point: 2 * kind + (1 if the next one is of another kind or text).
SEPARATOR, LINE_FEED, WORD = 0, 1, 2
#: Classes whose places end a unit.
ENDS = {"words": (2 * WORD + 1,), "lines": (2 * LINE_FEED, 2 * LINE_FEED + 1)}


def flat(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts, where each text starts, and the end)."""
    parts = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4") for t in texts]
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=at[1:])
    return np.concatenate([*parts, np.zeros(0, "<u4")]), at


class Boundaries:
    """Unit boundaries of texts laid end to end."""

    def __init__(self, texts: list[str], unit: str = "words"):
        self.unit = unit
        code, self.at = flat(texts)
        kind = np.where(code == 10, LINE_FEED, np.where((code == 32) | (code - 9 < 5), SEPARATOR, WORD))
        last = np.ones(len(code), bool)
        if len(code):
            inner = (kind[1:] == WORD) == (kind[:-1] == WORD)
            last[:-1] = ~inner
            ends = self.at[1:]
            last[ends[ends > self.at[:-1]] - 1] = True  # runs end with their text
        self.classes = WaveletMatrix((2 * kind + last).astype(np.uint8), 3)

    def count(self, place: np.ndarray) -> np.ndarray:
        """Units that end before ``place``, an index into the laid-out code points, all texts."""
        if self.unit == "chars":
            return place
        return sum(self.classes.rank(c, place) for c in ENDS[self.unit])

    def units(self) -> np.ndarray:
        """Units of each text; what follows its last boundary is one more."""
        whole = self.count(self.at)
        rest = self.at[1:] > np.maximum(self._find(whole[1:], self.at[:-1], self.at[1:]), self.at[:-1])
        rest &= self.at[1:] > self.at[:-1]
        return whole[1:] - whole[:-1] + rest

    def _find(self, want: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Least place of lo..hi before which ``want`` boundaries lie, or hi: bisection on ranks."""
        lo, hi = lo.copy(), hi.copy()
        while (lo < hi).any():
            mid = (lo + hi) >> 1
            enough = self.count(mid) >= want
            hi = np.where(enough & (lo < hi), mid, hi)
            lo = np.where(~enough & (lo < hi), mid + 1, lo)
        return lo

    def place(self, k: np.ndarray) -> np.ndarray:
        """Code points of each text in its first ``k`` units."""
        start, end = self.at[:-1], self.at[1:]
        return self._find(self.count(start) + k, start, end) - start


def chance(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit hashes of the seed and an id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", unit: str = "words",
                   rate: int = RATE, spm_share: int = SPM_SHARE, seed: int = SEED,
                   markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """Rows doc_id, n (units), form (plain, psm, spm), prefix_chars, middle_chars, output."""
    if unit not in (*ENDS, "chars"):
        raise ValueError(f"unit must be words, lines or chars, not {unit!r}")
    body = F.coalesce(F.col(text), F.lit(""))
    h1, h2, h3, h4 = chance(F.col(doc_id), seed)
    plain = (body == "") | (h3 % 100 >= rate)
    for m in markers:
        plain = plain | F.contains(body, F.lit(m))
    rows = docs.select(F.col(doc_id).alias("doc_id"), body.alias("text"), h1.alias("h1"), h2.alias("h2"),
                       F.when(plain, "plain").when(h4 % 100 < spm_share, "spm").otherwise("psm").alias("form"))
    before_p, before_s, before_m = markers

    def work(piece: pa.RecordBatch) -> dict:
        texts, form = piece["text"].to_pylist(), piece["form"].to_pylist()
        found = Boundaries(texts, unit)
        n = found.units()
        cuts = np.sort([piece[h].to_numpy() % (n + 1) for h in ("h1", "h2")], axis=0)
        first, second = found.place(cuts[0]).tolist(), found.place(cuts[1]).tolist()
        out = []
        for t, f, a, b in zip(texts, form, first, second):
            if f == "psm":
                t = f"{before_p}{t[:a]}{before_s}{t[b:]}{before_m}{t[a:b]}"
            elif f == "spm":
                t = f"{before_s}{t[b:]}{before_p}{t[:a]}{before_m}{t[a:b]}"
            out.append(t)
        shown = [f != "plain" for f in form]
        return {"n": pa.array(n, pa.int64()),
                "prefix_chars": pa.array([a if s else None for a, s in zip(first, shown)], pa.int64()),
                "middle_chars": pa.array([b - a if s else None for a, b, s in zip(first, second, shown)],
                                         pa.int64()),
                "output": pa.array(out, pa.string())}

    return map_chunks(rows, work, ["doc_id", "form"],
                      "n long, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that ``output`` was made of: no part of it holds a marker."""
    parts = F.split(output, "|".join(rf"\Q{m}\E" for m in markers))
    order = {"psm": (1, 3, 2), "spm": (2, 3, 1)}  # places of prefix, middle, suffix
    out = output
    for name, places in order.items():
        out = F.when(form == name, F.concat(*[F.get(parts, F.lit(i)) for i in places])).otherwise(out)
    return out
