"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text becomes words: stretches of U+2581 (a blank) with what follows, since no vocabulary
piece goes on behind its leading blanks. The words of a piece of texts that were not met
before are laid out as one flat array of symbols, one per code point, and cut again where no
vocabulary piece holds the two code points side by side. In each round every word takes
the least rank of its neighbouring pairs (a segmented minimum), merges the pairs of that rank
from the left, apart, all words at once, and the arrays are compacted; words without a pair
are finished. The encoder of the library merges one pair at a time, the best first, from the
left. So a word ends its round early after a merge whose new neighbour pair is as good as the
round's: that pair comes before the occurrences further right. Rounds and single merges
thus give the same pieces (tests compare them with the library's).

Symbols that are no vocabulary piece become the pieces of their UTF-8 bytes. Decoding lays out
the bytes of all pieces at once.

Defined results: a null text is empty; an empty text has the begin and end ids alone and
decodes to the empty text; rows are independent, so repeated rows get equal results; a null id
stays null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.llm.chunks import map_chunks

MODEL = "piece_bpe_32k.model"
BLANK = "▁"
#: Rank of a pair that no piece joins.
NEVER = np.int32(2**31 - 1)
#: Words up to so many code points are remembered by a task, up to so many words.
REMEMBER_CHARS, REMEMBER_WORDS = 64, 1 << 18
#: Words that are not finished after so many rounds (long runs of blanks, whose pieces all have
#: one rank, so that a round is one merge) go on by single merges from a heap.
ROUNDS = 128
WORDS = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")


def model_path(name: str = MODEL) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Vocabulary:
    """Pieces, pair ranks and byte pieces of a BPE model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        probe = " a  ﬁ \t"
        if model.normalize(probe) != BLANK + probe.replace(" ", BLANK):
            raise ValueError("the model normalises texts; only the identity with a leading blank is supported")
        size = model.get_piece_size()
        self.begin, self.end = model.bos_id(), model.eos_id()
        text = [model.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.id_of = {text[i]: i for i in plain}
        self.byte_piece = np.zeros(256, np.int32)
        self.is_byte = np.zeros(size, bool)
        shown = [text[i].replace(BLANK, " ").encode() for i in range(size)]
        for i in range(size):
            if model.is_byte(i):
                value = int(text[i][3:-1], 16)
                self.byte_piece[value], self.is_byte[i], shown[i] = i, True, bytes([value])
            elif model.is_control(i):
                shown[i] = b""
            elif model.is_unknown(i):
                shown[i] = model.decode([i]).encode()
        if not self.is_byte.any():
            raise ValueError("the model has no byte pieces")
        self.silent = np.array([model.is_control(i) for i in range(size)])
        self.blank_first = np.zeros(size, bool)
        self.blank_first[plain] = [text[i].startswith(BLANK) for i in plain]
        self.length = np.array([len(s) for s in shown], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)])
        self.bytes = np.frombuffer(b"".join(shown), np.uint8)
        if any(BLANK in t.lstrip(BLANK) for t in self.id_of):
            raise ValueError("a piece goes on behind a blank")

        # symbols: ids of pieces; from ``size`` on, code points that only occur inside of pieces
        symbol = dict(self.id_of)
        for t in self.id_of:
            for c in t:
                symbol.setdefault(c, len(symbol) + size)
        self.size = size
        self.symbol_of = np.full(0x110000, -1, np.int32)
        for t, s in symbol.items():
            if len(t) == 1:
                self.symbol_of[ord(t)] = s
        best = np.unique([-model.get_score(i) for i in plain])
        rank = {i: int(np.searchsorted(best, -model.get_score(i))) for i in plain}
        keys, made, inner = [], [], set()
        for t, i in self.id_of.items():
            inner.update(zip(t, t[1:]))
            for k in range(1, len(t)):
                if t[:k] in symbol and t[k:] in symbol:
                    keys.append(symbol[t[:k]] << 32 | symbol[t[k:]])
                    made.append(i)
        by = np.argsort(keys)
        self.keys = np.append(np.array(keys, np.int64)[by], np.iinfo(np.int64).max)
        self.made = np.append(np.array(made, np.int32)[by], -1)
        self.rank = np.append(np.array([rank[i] for i in made], np.int32)[by], NEVER)
        self.table = dict(zip(self.keys.tolist(), zip(self.rank.tolist(), self.made.tolist())))
        self.inner = np.sort([ord(a) << 32 | ord(b) for a, b in inner])

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, piece) of the symbol pairs; NEVER where no piece joins them."""
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, key)
        hit = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.rank[at], NEVER), self.made[at]

    def merged(self, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(token ids, number of ids of each word) of words laid end to end as code points."""
        n = len(codes)
        # a word is cut where no piece holds the two code points side by side
        cut = np.zeros(n, bool)
        cut[starts] = True
        if n > 1:
            beside = codes[:-1].astype(np.int64) << 32 | codes[1:]
            at = np.minimum(np.searchsorted(self.inner, beside), len(self.inner) - 1)
            cut[1:] |= self.inner[at] != beside
        place = np.arange(n)  # of a symbol's first code point
        sym = self.symbol_of[codes]
        out = sym.copy()
        alive = np.ones(n, bool)  # code points that begin a symbol
        head = cut
        rank, made = self._beside(sym, head)
        rounds = 0
        while len(sym):
            rounds += 1
            if rounds > ROUNDS:
                self._one_by_one(place, sym, head, out, alive)
                break
            word = np.cumsum(head) - 1
            first = np.flatnonzero(head)
            least = np.minimum.reduceat(rank, first)[word]
            live = least < NEVER
            if not live.all():  # finished words leave
                out[place[~live]] = sym[~live]
                place, sym, head, rank, made, word, least = (
                    a[live] for a in (place, sym, head, rank, made, word, least))
                if not len(sym):
                    break
            take = rank == least
            # of touching pairs every other one, from the left
            idx = np.arange(len(sym))
            begin = take.copy()
            begin[1:] &= ~take[:-1]
            take &= (idx - np.maximum.accumulate(np.where(begin, idx, 0))) % 2 == 0
            # a word stops behind the first merge that brings up a pair as good as this round's
            i = np.flatnonzero(take)
            new = made[i]
            before = np.maximum(i - 1, 0)
            left = np.where((i >= 2) & take[i - 2], made[i - 2], sym[before])
            behind = np.minimum(i + 2, len(sym) - 1)
            good = np.minimum(
                np.where(head[i], NEVER, self.pairs(left, new)[0]),
                np.where((i + 2 >= len(sym)) | head[behind], NEVER, self.pairs(new, sym[behind])[0]))
            stop = (good <= least[i]).astype(np.int64)
            earlier = np.cumsum(stop) - stop
            own = word[i]
            opens = np.ones(len(i), bool)
            opens[1:] = own[1:] != own[:-1]
            i = i[earlier == earlier[np.maximum.accumulate(np.where(opens, np.arange(len(i)), 0))]]

            sym[i] = made[i]
            gone = np.zeros(len(sym), bool)
            gone[i + 1] = True
            alive[place[i + 1]] = False
            changed = np.zeros(len(sym), bool)
            changed[i] = True
            keep = ~gone
            place, sym, head, rank, made, changed = (
                a[keep] for a in (place, sym, head, rank, made, changed))
            again = changed.copy()
            again[:-1] |= changed[1:]
            again = np.flatnonzero(again)
            rank[again], made[again] = self._beside(sym, head, again)
        return self._ids(codes, out, alive, starts)

    def _beside(self, sym: np.ndarray, head: np.ndarray, at: np.ndarray | None = None):
        """(rank, piece) of the pairs of each symbol, or those at ``at``, and its right neighbour."""
        at = np.arange(len(sym)) if at is None else at
        right = np.minimum(at + 1, len(sym) - 1)
        rank, made = self.pairs(sym[at], sym[right])
        return np.where((at + 1 < len(sym)) & ~head[right], rank, NEVER), made

    def _one_by_one(self, place, sym, head, out, alive) -> None:
        """Finish words by single merges from a heap, the best and leftmost first."""
        sym, place = sym.tolist(), place.tolist()
        n = len(sym)
        after = np.append(np.where(head[1:], n, np.arange(1, n)), n).tolist()
        before = np.where(head, -1, np.arange(-1, n - 1)).tolist()
        table = self.table

        def pair(i: int):
            j = after[i]
            joined = table.get(sym[i] << 32 | sym[j]) if j < n and sym[i] >= 0 and sym[j] >= 0 else None
            if joined is not None:
                heapq.heappush(heap, (joined[0], i, sym[i], sym[j], joined[1]))

        heap: list[tuple] = []
        for i in range(n):
            pair(i)
        while heap:
            _, i, left, right, piece = heapq.heappop(heap)
            j = after[i]
            if sym[i] != left or j >= n or sym[j] != right:
                continue  # one of the two has been merged since
            sym[i], sym[j] = piece, None
            alive[place[j]] = False
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            pair(i)
            if before[i] >= 0:
                pair(before[i])
        for at, s in zip(place, sym):
            if s is not None:
                out[at] = s

    def _ids(self, codes, out, alive, starts):
        """Finished symbols as ids: code points that are no piece become their bytes."""
        at = np.flatnonzero(alive)
        sym = out[at]
        lone = (sym < 0) | (sym >= self.size)
        width = np.ones(len(sym), np.int64)
        code = codes[at].astype(np.int64)
        width[lone] = 1 + (code[lone] > 0x7F) + (code[lone] > 0x7FF) + (code[lone] > 0xFFFF)
        ends = np.cumsum(width)
        ids = np.repeat(sym, width)
        raw = np.frombuffer(code[lone].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
                            .encode("utf-8", "surrogatepass"), np.uint8)
        ids[np.repeat(lone, width)] = self.byte_piece[raw]
        bound = np.searchsorted(at, np.append(starts, len(codes)))
        total = np.concatenate([[0], ends])
        return ids.astype(np.int32), np.diff(total[bound])

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """Texts of the id lists ids[bounds[d]:bounds[d + 1]]."""
        length = self.length[ids].copy()
        start = self.start[ids]
        # the blank that encoding put before the text goes: of the first piece that shows
        shown = np.flatnonzero(~self.silent[ids])
        d = np.searchsorted(bounds, shown, side="right") - 1
        opens = np.ones(len(shown), bool)
        opens[1:] = d[1:] != d[:-1]
        firsts = shown[opens]
        blank = firsts[self.blank_first[ids[firsts]]]
        length[blank] -= 1
        start = start.copy()
        start[blank] += 1
        ends = np.concatenate([[0], np.cumsum(length)])
        body = self.bytes[np.repeat(start - ends[:-1], length) + np.arange(ends[-1])].tobytes()
        at = ends[bounds].tolist()
        texts = []
        for lo, hi, a, b in zip(at, at[1:], bounds.tolist(), bounds.tolist()[1:]):
            try:
                texts.append(body[lo:hi].decode())
            except UnicodeDecodeError:  # loose byte pieces: each byte that is no UTF-8 shows as U+FFFD
                texts.append(self._loose(ids[a:b], body[lo:hi], length[a:b]))
        return texts

    def _loose(self, ids: np.ndarray, body: bytes, length: np.ndarray) -> str:
        out, at, i = [], 0, 0
        while i < len(ids):
            j = i
            while j < len(ids) and self.is_byte[ids[j]] == self.is_byte[ids[i]]:
                j += 1
            size = int(length[i:j].sum())
            part = body[at:at + size]
            if self.is_byte[ids[i]]:
                part = part.decode("utf-8", "surrogateescape")
                out.append(re.sub("[\udc80-\udcff]", "�", part))
            else:
                out.append(part.decode())
            at, i = at + size, j
        return "".join(out)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Encoder:
    """Texts to ids; words met before are looked up."""

    def __init__(self, model: Vocabulary):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.ends = np.zeros(1, np.int64)  # of the ids of each word, after a zero

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts with begin and end ids, bounds of each text's ids)."""
        if len(self.number) > REMEMBER_WORDS:
            self.clear()
        number, known = self.number, len(self.number)
        flat, per_text = [], []
        for t in texts:
            found = WORDS.findall(BLANK + t.replace(" ", BLANK)) if t else []
            flat += [number.setdefault(w, len(number)) for w in found]
            per_text.append(len(found))
        flat, per_text = np.array(flat, np.int64), np.array(per_text, np.int64)
        fresh = list(islice(number, known, None))
        if fresh:
            body = "".join(fresh)
            codes = np.frombuffer(body.encode("utf-32-le", "surrogatepass"), "<u4")
            sizes = np.array([len(w) for w in fresh], np.int64)
            ids, counts = self.model.merged(codes, np.concatenate([[0], np.cumsum(sizes)[:-1]]))
            self.ids = np.concatenate([self.ids, ids])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts)])
        size = self.ends[flat + 1] - self.ends[flat]
        last = np.cumsum(size)
        body = self.ids[np.repeat(self.ends[flat] - (last - size), size) + np.arange(last[-1] if len(last) else 0)]
        total = np.concatenate([[0], last])[np.concatenate([[0], np.cumsum(per_text)])]
        bounds = total + 2 * np.arange(len(texts) + 1)
        ids = np.empty(int(bounds[-1]), np.int32)
        inside = np.ones(len(ids), bool)
        inside[bounds[:-1]], inside[bounds[1:] - 1] = False, False
        ids[inside] = body
        ids[bounds[:-1]], ids[bounds[1:] - 1] = self.model.begin, self.model.end
        if any(len(w) > REMEMBER_CHARS for w in fresh):
            self._forget_long()
        return ids, bounds

    def _forget_long(self) -> None:
        sizes = np.diff(self.ends)
        keep = np.array([len(w) <= REMEMBER_CHARS for w in self.number], bool)
        self.ids = self.ids[np.repeat(keep, sizes)]
        self.ends = np.concatenate([[0], np.cumsum(sizes[keep])])
        self.number = {w: i for i, w in enumerate(w for w in self.number if len(w) <= REMEMBER_CHARS)}


def encode(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None,
           decoded: bool = False) -> DataFrame:
    """Rows doc_id and ids: token ids with begin and end, as little-endian 32-bit integers; and
    with ``decoded`` the text they decode to."""
    path = path or model_path()
    state: dict[str, Encoder] = {}  # one per task

    def work(piece: pa.RecordBatch) -> dict:
        if "encoder" not in state:
            state["encoder"] = Encoder(vocabulary(path))
        encoder = state["encoder"]
        ids, bounds = encoder.encode([t or "" for t in piece["text"].to_pylist()])
        body = pa.py_buffer(ids.astype("<u4").tobytes())
        offsets = pa.py_buffer((4 * bounds).astype(np.int32).tobytes())
        found = {"ids": pa.Array.from_buffers(pa.binary(), piece.num_rows, [None, offsets, body])}
        if decoded:
            found["decoded"] = pa.array(encoder.model.decode(ids, bounds), pa.string())
        return found

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return map_chunks(rows, work, ["doc_id"], "ids binary" + (", decoded string" if decoded else ""))


def decode(rows: DataFrame, ids: str = "ids", key: str = "doc_id", path: str | None = None) -> DataFrame:
    """Rows doc_id and decoded, from lists of ids as ``encode`` gives them (null: empty)."""
    path = path or model_path()

    def work(piece: pa.RecordBatch) -> dict:
        lists = [np.frombuffer(b or b"", "<u4").astype(np.int32) for b in piece["ids"].to_pylist()]
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
        ids = np.concatenate([*lists, np.zeros(0, np.int32)])
        return {"decoded": pa.array(vocabulary(path).decode(ids, bounds), pa.string())}

    frame = rows.select(F.col(key).alias("doc_id"), F.col(ids).alias("ids"))
    return map_chunks(frame, work, ["doc_id"], "decoded string", text="ids")
