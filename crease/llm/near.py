"""Near-duplicate components by a MinHash LSH forest.

A text's set is its distinct shingles of five words. Texts with equal sets are one node.
Each node gets PERMUTATIONS minimum hashes, dealt to TREES trees of DEPTH hashes. A tree is
a sorted order: all nodes are range-sorted by (tree, hashes), so that the longer the common
prefix of two nodes, the closer they stand. A node's candidates in a tree are the nearest
nodes before it whose common prefix has at least MIN_DEPTH hashes: where the order is
sparse these are all nodes that share MIN_DEPTH hashes, in a dense region only those that
share many, so depth follows the region. Candidates are confirmed on full shingle sets.

Dense regions (thousands of near copies) are thinned first: the first pass tests only direct
neighbours and joins them into components. The following passes run over the nodes that had
a neighbour at all, sorted by DEEP hashes. A node looks back to the LOOK nearest nodes and
tests those of other components that are likeliest by the share of equal hashes: a few in
the second pass; where there were more, more in the next. These
passes only join what is easily found. The last one leaves no candidate out: of all nodes that
share MIN_DEPTH hashes in a tree and are still of different components, however many stand
there, every two meet in a pair of blocks, and those likely enough are compared by full sets.

Defined results: a null text, an empty one and one without words have the empty set and
are linked with nothing; fewer than five words are one shingle; rows with a null id take
part, and a component without any id has a null one; repeated rows share a result each; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.llm.common import key_filter, materialise, may_contain, salted_join
from crease.llm.components import star_edges

SHINGLE = 5
THRESHOLD = 85
TREES = 16
DEPTH = 8
PERMUTATIONS = TREES * DEPTH
MIN_DEPTH = 4
PROBE_BYTES = 32
#: Later passes: nodes looked back to per node and tree; hashes sorted by; candidates of a
#: node and tree tested in each pass. What they leave out is left to the last pass.
LOOK = 512
DEEP = 16
CHOICES = (3, 15)
#: Nodes of a block in the last pass; any two blocks that share MIN_DEPTH hashes meet.
BLOCK_NODES = 1024
#: A candidate is left out if its share of equal hashes is so many percent below the
#: threshold (about six standard errors of 32 hashes, four and a half of 128).
SLACK = {PROBE_BYTES: 36, PERMUTATIONS: 14}
#: Rows on each side of a seam between two partitions that are brought together; who has a
#: neighbour is told across all seams, and the last pass does not depend on them.
SEAM = 16
FILTER_BITS = 1 << 22
#: Nodes of rows without id are numbered from here.
NO_ID = 1 << 62
#: Shingles hashed at once when minima are taken.
BLOCK = 1 << 16

_rng = np.random.default_rng(20240501)
_FACTORS = (_rng.integers(0, 1 << 31, PERMUTATIONS, np.uint32) << 1) | 1
_SHIFTS = _rng.integers(0, 1 << 32, PERMUTATIONS, np.uint32)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Word (bytes) -> 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 18:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def _finish(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None, cache: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; A-Z are lower-cased first.

    bytes.lower and bytes.split know exactly A-Z and space, U+0009..U+000D."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    n = len(h) - SHINGLE + 1
    mixed = h[:n].copy()
    for k in range(1, SHINGLE):
        mixed *= _MIX
        mixed += h[k:n + k]
    return np.unique(_finish(mixed))


def _minima(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, PERMUTATIONS) minimum hashes of non-empty sets."""
    out = np.empty((len(sets), PERMUTATIONS), np.uint32)
    at = 0
    while at < len(sets):
        end, held = at, 0
        while end < len(sets) and (held == 0 or held + len(sets[end]) <= BLOCK):
            held += len(sets[end])
            end += 1
        x = (np.concatenate(sets[at:end]) >> np.uint64(32)).astype(np.uint32)
        first = np.cumsum([0, *(len(s) for s in sets[at:end - 1])])
        y = np.empty_like(x)
        for p in range(PERMUTATIONS):
            np.multiply(x, _FACTORS[p], out=y)
            np.add(y, _SHIFTS[p], out=y)
            out[at:end, p] = np.minimum.reduceat(y, first)
        at = end
    return out


def signatures(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Per row: doc_id, n_shingles, s1, s2 (digest of the set), paths (TREES x DEPTH hashes of
    16 bits, high byte first) and probe (PROBE_BYTES hashes of 8 bits); for an empty set the
    last four are null."""
    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = WordHashes()
        for batch in batches:
            sets = [shingle_set(t, cache) for t in batch["_t"]]
            some = [i for i, s in enumerate(sets) if len(s)]
            out = batch.drop(columns="_t").assign(n_shingles=[len(s) for s in sets],
                                                  s1=None, s2=None, paths=None, probe=None)
            if some:
                minima = _minima([sets[i] for i in some])
                paths = minima.astype(">u2")
                probes = (minima ^ (minima >> np.uint32(8)) ^ (minima >> np.uint32(16))).astype(np.uint8)
                digests = [xxhash.xxh3_128_intdigest(sets[i].tobytes()) for i in some]
                low = np.array([d & ((1 << 64) - 1) for d in digests], np.uint64).view(np.int64)
                high = np.array([d >> 64 for d in digests], np.uint64).view(np.int64)
                for name, values in (
                        ("s1", low), ("s2", high), ("paths", [r.tobytes() for r in paths]),
                        ("probe", [r[:PROBE_BYTES].tobytes() for r in probes[:, ::PERMUTATIONS // PROBE_BYTES]])):
                    column = np.full(len(batch), None, object)
                    column[some] = list(values)
                    out[name] = column
            yield out

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.xxhash64(F.col(text)).alias("_hash"), F.col(text).alias("_t"))
    return rows.mapInPandas(task, "doc_id long, _hash long, n_shingles long, s1 long, s2 long, "
                                  "paths binary, probe binary")


class Region:
    """The last ``look`` nodes of a sorted run with a common prefix of MIN_DEPTH hashes."""

    def __init__(self, look: int, hashes: int, threshold: int, choice: int):
        self.look, self.threshold, self.choice = look, threshold, choice
        self.kind = np.uint8 if hashes == PROBE_BYTES else np.uint16
        self.need = (threshold - SLACK[hashes]) * hashes / 100
        self.probes = np.zeros((look, hashes), self.kind)
        self.nodes, self.comps, self.sizes = (np.zeros(look, np.int64) for _ in range(3))
        self.asks = np.zeros(look, bool)
        self.key, self.count = None, 0

    def partners(self, tree: int, path: bytes, node: int, comp: int, n: int, probe: bytes,
                 asks: bool) -> tuple[list[int], list[int]]:
        """(candidates of this row, nodes about which there is more to find)."""
        key = (tree, path[:2 * MIN_DEPTH])
        if key != self.key:
            self.key, self.count = key, 0
        mine = np.frombuffer(probe, self.kind)
        found: list[int] = []
        more: list[int] = []
        if self.count:
            k = min(self.count, self.look)
            if not self.choice:
                more = [node] if self.count > 1 else [node, int(self.nodes[0])]
            sizes = self.sizes[:k]
            at = np.flatnonzero((self.comps[:k] != comp) & (self.asks[:k] | asks)
                                & (100 * np.minimum(n, sizes) >= self.threshold * np.maximum(n, sizes)))
            same = self.probes[at] == mine
            equal = same.sum(axis=1)
            likely = np.flatnonzero(equal >= self.need)
            if self.choice:
                likely = likely[np.lexsort((self.nodes[at[likely]], -equal[likely]))]
                more = [node] if len(likely) > self.choice else []
                likely = likely[:self.choice]
            found = [int(self.nodes[at[i]]) for i in likely]
        i = self.count % self.look
        self.probes[i], self.nodes[i], self.comps[i], self.sizes[i] = mine, node, comp, n
        self.asks[i] = asks
        self.count += 1
        return found, more


ROW = ["t", "path", "node", "comp", "n", "probe", "asks"]


def forest_pairs(nodes: DataFrame, threshold: int, choice: int = 0) -> DataFrame:
    """Candidate pairs (a, b) of different components; a row with b null says that there is
    more to find about a.

    ``nodes``: node, comp, n, paths, probe (the hashes to compare) and asks (whether to look
    for its candidates). ``choice`` 0: direct neighbours, and what has one; else so many of
    the likeliest."""
    spark = nodes.sparkSession
    look, hashes, depth = ((LOOK, PERMUTATIONS, DEEP) if choice else (1, PROBE_BYTES, DEPTH))
    rows = nodes.select("node", "comp", "n", "probe", "paths", "asks",
                        F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("t"))
    # the hashes of a tree, then those of the next ones
    order = f"substring(concat(paths, paths), t * {2 * DEPTH} + 1, {2 * depth})"
    rows = rows.select("t", F.expr(order).alias("path"),
                       "node", "comp", "n", "probe", "asks")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(parts, nodes.count() * TREES // (128 * SEAM)))
    names = ["a", "b", "seam", "place", *ROW]
    whole = {c: "Int64" for c in ("a", "b", "seam", "place", "t", "node", "comp", "n")}
    whole["asks"] = "boolean"

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        region = Region(look, hashes, threshold, choice)
        head, tail = [], deque(maxlen=SEAM)
        for batch in batches:
            pairs = []
            for row in zip(*(batch[c] for c in ROW)):
                found, more = region.partners(*row)
                pairs += [(row[2], q) for q in found]
                pairs += [(q, None) for q in more]
                if len(head) < SEAM:
                    head.append(row)
                tail.append(row)
            yield pd.DataFrame(pairs, columns=["a", "b"]).reindex(columns=names).astype(whole)
        edge = [(part - 1, i, *r) for i, r in enumerate(head) if part]
        edge += [(part, i - len(tail), *r) for i, r in enumerate(tail)]
        yield pd.DataFrame(edge, columns=names[2:]).reindex(columns=names).astype(whole)

    found = materialise(
        rows.repartitionByRange(parts, "t", "path", "node").sortWithinPartitions("t", "path", "node")
        .mapInPandas(scan, "a long, b long, seam int, place int, t int, path binary, node long, "
                           "comp long, n long, probe binary, asks boolean"), "forest")

    def across(rows: pd.DataFrame) -> pd.DataFrame:
        """Pairs over the seam between two partitions: at most twice SEAM rows."""
        region, pairs = Region(look, hashes, threshold, choice), []
        before = set()
        for place, *row in rows.sort_values("place")[["place", *ROW]].itertuples(index=False):
            got, more = region.partners(*row)
            if place < 0:
                before.add(row[2])
            else:
                pairs += [(row[2], q) for q in got if q in before]
                pairs += [(q, None) for q in more]
        return pd.DataFrame(pairs, columns=["a", "b"]).astype("Int64")

    seams = found.filter("seam IS NOT NULL").groupBy("seam").applyInPandas(across, "a long, b long")
    # nodes with a neighbour beyond a seam, over however many partitions
    ends = found.filter("seam IS NOT NULL").groupBy(
        "t", F.substring("path", 1, 2 * MIN_DEPTH).alias("key")).agg(F.collect_set("node").alias("nodes"))
    alike = ends.filter(F.size("nodes") > 1).select(F.explode("nodes").alias("a"),
                                                    F.lit(None).cast("long").alias("b"))
    found = found.filter("seam IS NULL").select("a", "b").unionByName(seams)
    return found if choice else found.unionByName(alike)


def node_texts(nodes: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(node, _t) for ``nodes`` (node, doc_id, _hash): one scan; only rows that pass a filter
    of fixed size are shuffled. Rows equal in id and text are one node."""
    needed = nodes.select("node", F.col("doc_id").alias("_nid"), "_hash")
    rows = docs.select(F.col(doc_id).cast("long").alias("_did"), F.col(text).alias("_t"),
                       F.xxhash64(F.col(text)).alias("_dhash"))
    wanted = key_filter(needed.withColumnRenamed("_hash", "_dhash"), ["_dhash"], FILTER_BITS)
    rows = may_contain(rows, wanted, ["_dhash"], FILTER_BITS, "_in").filter("_in")
    match = (rows["_dhash"] == needed["_hash"]) & rows["_did"].eqNullSafe(needed["_nid"])
    return materialise(rows.join(needed, match).select("node", "_t").dropDuplicates(["node", "_t"]),
                       "near-texts")


def confirmed(pairs: DataFrame, texts: DataFrame, threshold: int) -> DataFrame:
    """The pairs (u, v) of nodes whose full sets reach ``threshold`` percent."""
    both = (pairs.join(texts.select(F.col("node").alias("u"), F.col("_t").alias("_tu")), "u")
            .join(texts.select(F.col("node").alias("v"), F.col("_t").alias("_tv")), "v"))

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache, last = WordHashes(), (None, None)
        for batch in batches:
            keep = []
            for v, tu, tv in zip(batch["v"], batch["_tu"], batch["_tv"]):
                if last[0] != v or last[1] is not tv:
                    last, set_v = (v, tv), shingle_set(tv, cache)
                set_u = shingle_set(tu, cache)
                common = len(np.intersect1d(set_u, set_v, assume_unique=True))
                keep.append(100 * common >= threshold * (len(set_u) + len(set_v) - common))
            yield batch.loc[keep, ["u", "v"]]

    return both.mapInPandas(task, "u long, v long")


def _candidates(tree: int, nodes: np.ndarray, comps: np.ndarray, sizes: np.ndarray, sigs: np.ndarray,
                left: np.ndarray, right: np.ndarray, threshold: int) -> np.ndarray:
    """Which nodes have a candidate between ``left`` and ``right``: of another component, likely
    enough, and with ``tree`` as the first in which the two share MIN_DEPTH hashes."""
    need = (threshold - SLACK[PERMUTATIONS]) * PERMUTATIONS / 100
    marked = np.zeros(len(nodes), bool)
    for i in left:
        at = right[(comps[right] != comps[i]) & (nodes[right] != nodes[i])
                   & (100 * np.minimum(sizes[i], sizes[right]) >= threshold * np.maximum(sizes[i], sizes[right]))]
        same = sigs[at] == sigs[i]
        likely = np.flatnonzero(np.count_nonzero(same, axis=1) >= need)
        if len(likely):
            shared = same[likely].reshape(-1, TREES, DEPTH)[:, :, :MIN_DEPTH].all(axis=2)
            likely = likely[shared.argmax(axis=1) == tree]
            marked[at[likely]] = True
            marked[i] |= len(likely) > 0
    return marked


def _spanning_links(nodes: np.ndarray, comps: np.ndarray, sets: list[np.ndarray], left: np.ndarray,
                    right: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Links between ``left`` and ``right``, by full sets, that join different components: as
    many as are needed to join all that are linked."""
    root = {c: c for c in comps.tolist()}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    sizes = np.array([len(s) for s in sets])
    values = np.concatenate([sets[j] for j in right])
    order = np.argsort(values, kind="stable")
    values, holder = values[order], np.repeat(np.arange(len(right)), sizes[right])[order]
    links = []
    for i in left:
        first, last = (np.searchsorted(values, sets[i], side) for side in ("left", "right"))
        count = last - first
        where = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
        common = np.bincount(holder[where], minlength=len(right))
        for j in right[100 * common >= threshold * (sizes[i] + sizes[right] - common)]:
            a, b = find(int(comps[i])), find(int(comps[j]))
            if a != b:
                root[a] = b
                links.append((int(nodes[i]), int(nodes[j])))
    return links


def _sides(blocks: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    return np.flatnonzero(blocks == low), np.flatnonzero(blocks == high)


def remaining_links(comps: DataFrame, texts: DataFrame, threshold: int) -> DataFrame:
    """Links (u, v) that join all components which any link of two nodes sharing MIN_DEPTH hashes
    in a tree joins. ``comps``: node, comp, n, paths; ``texts``: node, _t.

    The nodes that share a tree's hashes are dealt into blocks, and any two blocks meet, so that
    a group holds twice BLOCK_NODES rows, however many share the hashes. Of a group come the
    nodes that have a candidate, and then, by their sets, fewer links than nodes."""
    rows = comps.select("node", "comp", "n", "paths",
                        F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("t"))
    rows = rows.withColumn("key", F.expr(f"substring(paths, t * {2 * DEPTH} + 1, {2 * MIN_DEPTH})"))
    crowds = rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("m"), F.min("comp").alias("c"),
                                          F.max("comp").alias("d")).filter("c < d")
    crowds = crowds.select("t", "key", F.expr(f"CAST(ceil(m / {BLOCK_NODES}) AS int)").alias("blocks"))
    rows = salted_join(rows, crowds, ["t", "key"], F.col("node"), how="inner")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    group = ["t", "key", "low", "high"]
    rows = rows.select("t", "key", F.least("block", "other").alias("low"),
                       F.greatest("block", "other").alias("high"), "block", "node", "comp", "n", "paths")

    def groups(batches: Iterator[pd.DataFrame], columns: list[str]) -> Iterator[tuple[tuple, list]]:
        """(group, its columns) of rows that are sorted by group."""
        names = [*group, *columns]
        stream = (row for batch in batches for row in zip(*(batch[c] for c in names)))
        for key, members in groupby(stream, key=lambda row: row[:len(group)]):
            yield key, list(zip(*(row[len(group):] for row in members)))

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for key, (block, node, comp, n, paths) in groups(batches, ["block", "node", "comp", "n", "paths"]):
            if len(set(comp)) == 1:
                continue
            block, node, comp, n = map(np.array, (block, node, comp, n))
            sigs = np.frombuffer(b"".join(paths), np.uint16).reshape(-1, PERMUTATIONS)
            marked = _candidates(key[0], node, comp, n, sigs, *_sides(block, *key[2:]), threshold)
            if marked.any():
                yield pd.DataFrame({**dict(zip(group, key)), "block": block[marked], "node": node[marked],
                                    "comp": comp[marked]})

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = WordHashes()
        for key, (block, node, comp, text) in groups(batches, ["block", "node", "comp", "_t"]):
            block, node, comp = map(np.array, (block, node, comp))
            sets = [shingle_set(t, cache) for t in text]
            links = _spanning_links(node, comp, sets, *_sides(block, *key[2:]), threshold)
            if links:
                yield pd.DataFrame(links, columns=["u", "v"])

    def together(df: DataFrame) -> DataFrame:
        return df.repartition(*group).sortWithinPartitions(*group)

    marked = materialise(together(rows).mapInPandas(
        mark, "t int, key binary, low int, high int, block int, node long, comp long"), "near-rest")
    return together(marked.join(texts, "node")).mapInPandas(link, "u long, v long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    threshold: int = THRESHOLD) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (least id reachable), kept (the row's own id
    is that one), and _hash (of the text). Links need ``threshold`` percent of the union."""
    rows = materialise(signatures(docs, doc_id, text).withColumn("_id", F.coalesce(
        F.col("doc_id"), F.lit(NO_ID) + F.pmod(F.col("s1"), F.lit(1 << 61)))), "signatures")
    sets = rows.filter("n_shingles > 0").groupBy("s1", "s2", "n_shingles", "paths", "probe").agg(
        F.min(F.struct("_id", "doc_id", "_hash")).alias("_least"), F.count(F.lit(1)).alias("_rows"))
    nodes = materialise(sets.select(
        F.col("_least._id").alias("node"), "_least.doc_id", "_least._hash", "s1", "s2",
        F.col("n_shingles").alias("n"), "paths", "probe", "_rows"), "near-nodes")
    comps = nodes.select("node", "n", "paths", "probe", F.col("node").alias("comp"),
                         F.lit(True).alias("asks"))
    stars = tested = active = None
    for choice in (0, *CHOICES):
        found = materialise(forest_pairs(comps, threshold, choice).select(
            F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"),
            F.col("b").isNull().alias("more")).distinct(), "near-pairs")
        more = found.filter("more").select(F.col("u").alias("node"))
        pairs = found.filter("NOT more").select("u", "v")
        if active is None:
            active = materialise(nodes.join(more, "node", "left_semi"), "near-active")
            texts = node_texts(active, docs, doc_id, text)
        else:
            pairs = materialise(pairs.join(tested, ["u", "v"], "left_anti"), "near-new")
        links = materialise(confirmed(pairs, texts, threshold), "near-links")
        if stars is None:
            stars = star_edges(links)
        elif not links.isEmpty():
            stars = star_edges(links.unionByName(stars.select(F.col("node").alias("u"),
                                                              F.col("root").alias("v"))))
        if more.isEmpty():
            break
        tested = pairs if tested is None else tested.unionByName(pairs)
        comps = active.select("node", "n", "paths", F.col("paths").alias("probe")).join(
            stars, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root")
        if choice:
            comps = comps.join(more.withColumn("asks", F.lit(True)), "node", "left").withColumn(
                "asks", F.coalesce("asks", F.lit(False)))
        else:
            comps = comps.withColumn("asks", F.lit(True))
    comps = active.select("node", "n", "paths").join(stars, "node", "left").withColumn(
        "comp", F.coalesce("root", "node"))
    rest = materialise(remaining_links(comps, texts, threshold), "near-rest-links")
    if not rest.isEmpty():
        stars = star_edges(rest.unionByName(stars.select(F.col("node").alias("u"), F.col("root").alias("v"))))
    # sets that several rows share or that are linked: everything else stands alone
    placed = nodes.join(stars, "node", "left").filter("_rows > 1 OR root IS NOT NULL").select(
        "s1", "s2", F.coalesce("root", "node").alias("_root"))
    joined = salted_join(rows.select("doc_id", "_hash", "_id", "n_shingles", "s1", "s2"), placed,
                         ["s1", "s2"], F.col("_id"), salts=32)
    root = F.when(F.col("n_shingles") > 0, F.coalesce("_root", "_id"))
    component = F.when(root.isNull(), F.col("doc_id")).when(root < NO_ID, root)
    return joined.select("doc_id", "n_shingles", component.alias("component_id"),
                         component.eqNullSafe(F.col("doc_id")).alias("kept"), "_hash")


def keep_representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                         threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each group: the one with the least id (of rows equal in id and
    text, one)."""
    verdicts = near_duplicates(docs, doc_id, text, threshold)
    # two hashes, so that the join and the removal of repeated rows share one exchange
    gone = materialise(verdicts.filter("NOT kept").select(
        "_hash", F.xxhash64("doc_id").alias("_key")).distinct(), "near-gone")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
                       F.xxhash64(F.col(text)).alias("_hash"),
                       F.xxhash64(F.col(doc_id).cast("long")).alias("_key"))
    left = rows.join(gone, ["_hash", "_key"], "left_anti").dropDuplicates(["_hash", "_key"])
    return left.select(*[F.col(f"_doc.`{c}`").alias(c) for c in docs.columns])
