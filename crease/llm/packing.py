"""Best-fit-decreasing packing of tokenised documents into sequences of fixed length.

Texts become token ids and an end id in Arrow batches; a document that is longer than a
sequence is cut into whole sequences, its first piece taking the remainder. Pieces are
dealt by a hash into groups of bounded tokens and bounded rows; inside a group each piece,
longest first, goes into the open bin it fills most tightly, found in a segment tree over
remaining capacities in time logarithmic in the sequence length. Sequences that end up
loosely filled are taken apart and packed once more together, over all groups.

Defined results: a null text is empty and has the end id alone; repeated rows are packed
each; ties are broken by a hash of the id, so reruns on the same rows agree up to
numbering; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.llm.common import materialise

SEQUENCE = 2048
END_ID = 0
#: A group holds about so many tokens and pieces.
GROUP_TOKENS = 1 << 24
GROUP_PIECES = 1 << 17
#: Sequences filled below this share are packed again.
LOOSE = 0.98
TOKENIZER = "byte_bpe_50k"
PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long")


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Path of the vocabulary without its ending (.json, and .tiktoken for the ranks)."""
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def _encoder(path: str):
    """Text -> ids of the JSON file. The rank file holds its vocabulary but not its added
    tokens, and gives the same ids at four times the speed: a text that holds the literal of
    an added token goes to the JSON tokenizer, and so does one its pattern engine refuses."""
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer
    with open(path + ".tiktoken", "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("corpus", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=ranks, special_tokens={})

    slow = Tokenizer.from_file(path + ".json")
    added = [token.content for token in slow.get_added_tokens_decoder().values()]

    def encode(text: str) -> list[int]:
        if not any(literal in text for literal in added):
            try:
                return fast.encode_ordinary(text)
            except Exception:  # backtracking limit on very long runs of one class
                pass
        return slow.encode(text, add_special_tokens=False).ids
    return encode


def token_ids(text: str | None, path: str) -> np.ndarray:
    return np.array([*_encoder(path)(text or ""), END_ID], dtype="<u4")


def cuts(n: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids; only the first is shorter."""
    first = n if n <= limit else n % limit or limit
    return [(0, first), *((at, limit) for at in range(first, n, limit))]


def tokenised_pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                     limit: int = SEQUENCE, path: str | None = None,
                     with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids if asked for)."""
    path = path or tokenizer_path()

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, body in zip(batch["doc_id"], batch["text"]):
                ids = token_ids(body, path)
                for k, (at, n) in enumerate(cuts(len(ids), limit)):
                    part = ids[at:at + n]
                    rows.append((doc, k, at, n, zlib.crc32(part.tobytes()),
                                 *([part.astype(np.int32)] if with_ids else [])))
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:5 + with_ids]
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(task, PIECES + (", ids array<int>" if with_ids else ""))


class Capacities:
    """Segment tree over remaining capacities 0..limit, with a stack of bins at each leaf."""

    def __init__(self, limit: int):
        self.leaves = 1 << limit.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(limit + 1)]

    def add(self, capacity: int, bin_id: int) -> None:
        self.bins[capacity].append(bin_id)
        node = capacity + self.leaves
        while node:
            self.count[node] += 1
            node >>= 1

    def take_tightest(self, need: int) -> tuple[int, int] | None:
        """Remove and return (capacity, bin) with the least capacity of ``need`` or more."""
        node = need + self.leaves
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                if not self.count[node]:
                    node += 1
        capacity = node - self.leaves
        while node:
            self.count[node] -= 1
            node >>= 1
        return capacity, self.bins[capacity].pop()


def best_fit_decreasing(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset in it) of each length; ``lengths`` must not increase."""
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree, opened = Capacities(limit), 0
    for i, n in enumerate(lengths.tolist()):
        found = tree.take_tightest(n)
        if found is None:
            found, opened = (limit, opened), opened + 1
        capacity, where[i] = found
        offset[i] = limit - capacity
        if capacity > n:
            tree.add(capacity - n, int(where[i]))
    return where, offset


def _pack_groups(pieces: DataFrame, limit: int, first_id: int) -> DataFrame:
    size = pieces.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("t"),
                      F.count(F.lit(1)).alias("n")).first()
    groups = max(1, -(-size["t"] // GROUP_TOKENS), -(-size["n"] // GROUP_PIECES))
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("_tie", "piece", "_row"), F.lit(groups)))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "_tie", "piece", "_row"], ascending=[False, True, True, True])
        where, offset = best_fit_decreasing(rows["length"].to_numpy(), limit)
        base = first_id + (int(rows["_group"].iloc[0]) << 32)
        return rows.drop(columns="_group").assign(sequence_id=base + where, offset=offset)

    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")
    return dealt.groupBy("_group").applyInPandas(pack, schema)


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", limit: int = SEQUENCE,
         path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = tokenised_pieces(docs, doc_id, text, limit, path)
    pieces = materialise(pieces.withColumn("_tie", F.xxhash64("doc_id", "ids_crc32"))
                         .withColumn("_row", F.monotonically_increasing_id()), "pieces")
    packed = materialise(_pack_groups(pieces, limit, 0), "packed")
    fill = packed.groupBy("sequence_id").agg(F.sum("length").alias("_fill"))
    loose = fill.filter(F.col("_fill") < LOOSE * limit).select("sequence_id")
    again = materialise(packed.join(loose, "sequence_id", "left_semi")
                        .drop("sequence_id", "offset"), "loose")
    repacked = _pack_groups(again, limit, 1 << 31)
    tight = packed.join(loose, "sequence_id", "left_anti")
    return tight.unionByName(repacked).drop("_tie", "_row")


def sequences(docs: DataFrame, packed: DataFrame, doc_id: str = "doc_id", text: str = "text",
              limit: int = SEQUENCE, path: str | None = None) -> DataFrame:
    """The sequences themselves: sequence_id and ids, from the texts and their packing.

    Rows with equal id and equal text are interchangeable; each place is filled once."""
    pieces = tokenised_pieces(docs, doc_id, text, limit, path, with_ids=True)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    ids = pieces.groupBy(*key).agg(F.any_value("ids").alias("ids"))
    cond = [packed[c].eqNullSafe(ids[c]) for c in key]
    placed = packed.join(ids, cond).select("sequence_id", "offset", "ids")
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("_parts")).select(
        "sequence_id", F.flatten(F.transform("_parts", lambda p: p["ids"])).alias("ids"))
