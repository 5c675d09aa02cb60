"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of hashed n-grams are gathered per language over all training rows (each task keeps
one vector per language), summed, smoothed and turned into log-probabilities. The matrix
(languages x BUCKETS doubles: 256 KB per language) is broadcast; a batch of texts is scored
as sparse rows, by gathering matrix rows and summing them per text. Texts are worked
through in pieces of bounded length, whole, however long they are.

Defined results: a null text, or one without a letter, is ``und`` with score 0, as is any
text when nothing could be learned; rows without text or label teach nothing; ties go to
the label first in code-point order; repeated rows get a result each; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDERS = (2, 3)
BUCKETS = 1 << 15
SMOOTHING = 0.5
#: Characters worked on at once; a longer text is cut, with the overlap n-grams need.
PIECE = 1 << 19
UNKNOWN = "und"


def _pieces(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket of each n-gram, index of its text), PIECE characters at a time."""
    lap = max(ORDERS) - 1
    codes, owners, held = [], [], 0
    for i, text in enumerate(texts):
        text = f" {text.lower()} "
        for at in range(0, max(len(text) - lap, 1), PIECE):
            cut = np.frombuffer(text[at:at + PIECE + lap].encode("utf-32-le", "replace"), np.uint32)
            codes.append(cut)
            owners.append(i)
            held += len(cut)
            if held >= PIECE:
                yield from _buckets(codes, owners)
                codes, owners, held = [], [], 0
    if codes:
        yield from _buckets(codes, owners)


def _buckets(codes: list[np.ndarray], owners: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A run of ``codes`` that goes on in the next piece repeats its last characters there;
    the shorter orders are counted up to the same place, so each n-gram counts once."""
    flat = np.concatenate(codes).astype(np.uint64)
    lengths = np.array([len(c) for c in codes])
    owner = np.repeat(np.array(owners), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(flat))
    longest = max(ORDERS)
    for n in ORDERS:
        mixed = flat[: len(flat) - n + 1].copy() if len(flat) >= n else flat[:0]
        for k in range(1, n):
            mixed *= np.uint64(0x9E3779B97F4A7C15)
            mixed ^= flat[k: len(flat) - n + 1 + k]
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        mixed += np.uint64(n)
        bucket = (mixed >> np.uint64(49)).astype(np.int64)
        whole = left[: len(bucket)] >= longest
        yield bucket[whole], owner[: len(bucket)][whole]


def count_ngrams(train: DataFrame, text: str, label: str) -> DataFrame:
    """Rows (label, bucket, n): occurrences of each hashed n-gram in texts of the label;
    bucket -1 holds the number of texts."""
    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, texts in batch.groupby("label", sort=False)["text"]:
                counts = sums.setdefault(name, np.zeros(BUCKETS + 1, np.int64))
                for bucket, _ in _pieces(list(texts)):
                    counts[:BUCKETS] += np.bincount(bucket, minlength=BUCKETS)
                counts[BUCKETS] += len(texts)
        for name, counts in sums.items():
            at = np.flatnonzero(counts)
            yield pd.DataFrame({"label": name, "bucket": np.where(at == BUCKETS, -1, at),
                                "n": counts[at]})

    rows = (train.select(F.col(label).alias("label"), F.col(text).alias("text"))
            .filter("label IS NOT NULL AND text IS NOT NULL"))
    return (rows.mapInPandas(task, "label string, bucket long, n long")
            .groupBy("label", "bucket").agg(F.sum("n").alias("n")))


def fit(train: DataFrame, text: str, label: str) -> tuple[list[str], np.ndarray]:
    """(labels, matrix): row b of the matrix holds log P(bucket b | label) for each label,
    the last row the log priors. At most labels x (BUCKETS + 1) counts reach the driver."""
    counts = count_ngrams(train, text, label).toPandas()
    labels = sorted(counts["label"].unique())
    sums = np.zeros((BUCKETS + 1, len(labels)))
    column = counts["label"].map({s: i for i, s in enumerate(labels)}).to_numpy(dtype=int)
    row = np.where(counts["bucket"] < 0, BUCKETS, counts["bucket"]).astype(int)
    sums[row, column] = counts["n"]
    grams = sums[:BUCKETS] + SMOOTHING
    logs = np.vstack([np.log(grams / grams.sum(axis=0)),
                      np.log(sums[BUCKETS:] / max(sums[BUCKETS].sum(), 1))])
    return labels, logs


def score(texts: list[str], logs: np.ndarray) -> np.ndarray:
    """Posterior probabilities, one row per text, one column per label."""
    total = np.tile(logs[-1], (len(texts), 1))
    width = max(1, (1 << 21) // max(1, logs.shape[1]))
    for bucket, owner in _pieces(texts):
        for at in range(0, len(bucket), width):
            part, whose = logs[bucket[at:at + width]], owner[at:at + width]
            if len(whose):
                first = np.flatnonzero(np.diff(whose, prepend=-1))
                np.add.at(total, whose[first], np.add.reduceat(part, first, axis=0))
    total -= total.max(axis=1, keepdims=True)
    odds = np.exp(total)
    return odds / odds.sum(axis=1, keepdims=True)


def identify(docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text",
             label: str = "lang", carry: dict[str, Column] | None = None) -> DataFrame:
    """Learn from the rows where ``train`` holds and return doc_id, ``carry``, lang_pred and
    score for every row of ``docs``."""
    labels, logs = fit(docs.filter(train), text, label)
    model = docs.sparkSession.sparkContext.broadcast((labels, logs))
    extra = carry or {}
    rows = docs.select(F.col(doc_id).alias("doc_id"), *[c.alias(k) for k, c in extra.items()],
                       F.when(F.col(text).rlike(r"\p{L}"), F.col(text)).alias("_text"))

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        labels, logs = model.value
        for batch in batches:
            out = batch.drop(columns="_text").assign(lang_pred=UNKNOWN, score=0.0)
            known = np.flatnonzero(batch["_text"].notna())
            if len(known) and labels:
                odds = score(list(batch["_text"].iloc[known]), logs)
                best = odds.argmax(axis=1)
                out.iloc[known, out.columns.get_loc("lang_pred")] = np.array(labels, object)[best]
                out.iloc[known, out.columns.get_loc("score")] = odds[np.arange(len(best)), best]
            yield out

    schema = rows.drop("_text").schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInPandas(task, schema)
