"""Corpus operators: SQL oracles, brute force on the small tables, and odd rows."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from crease.llm import (exact, language, lines, mixing, near, oracle, packing, passages, preferences,
                        quality, queries, sharding)
from crease.llm.common import documents
from tools.compare import digest

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, _row long, _hash string, "
          "size long, n_lines long, n_removed long, kept string, node long, _t string, piece string")
PROSE = " ".join(f"word{i}" for i in range(120))
ROWS = [
    (1, PROSE, "en", "a"), (1, PROSE, "en", "a"), (2, PROSE, None, "b"), (3, PROSE + " end", "en", None),
    (None, PROSE, "fr", "a"), (None, None, None, None), (4, None, "en", "a"), (5, "", "en", "b"),
    (6, " \n\t ", "en", "b"), (7, "one two", "en", "b"), (8, "one two", "en", "b"),
    (9, "na " * 3000, "en", "c"), (10, "x" * 200_000, "en", "c"), (11, "ä" * 9 + "\n#$%\n#$%", "de", "c"),
    (12, " ".join(f"other{i % 40}" for i in range(5000)), "en", "c"),
]


@pytest.fixture(scope="module")
def messy(spark):
    pad = (0, 0, "h", 1, 2, 3, "k", 4, "t", "p")
    return spark.createDataFrame([(*r, *pad) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, SF).toPandas()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text):
    w = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())


@pytest.mark.parametrize("key", sorted(oracle.ORACLE))
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[key](spark, SF)
    cur = con.execute(oracle.ORACLE[key])
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(
        [d[0] for d in cur.description], cur.fetchall())[0]


def test_quality_counts_and_hosts(messy, none):
    rows = {r["doc_id"]: r for r in quality.quality_rules(messy).collect()}
    assert (rows[1]["n_words"], rows[1]["n_repeat_words"], rows[1]["kept"]) == (120, 0, True)
    assert (rows[9]["n_words"], rows[9]["n_repeat_words"], rows[9]["kept"]) == (3000, 3000, False)
    assert (rows[11]["n_symbols"], rows[11]["n_dup_lines"], rows[11]["word_chars"]) == (6, 1, 15)
    assert rows[4]["n_words"] == rows[5]["n_words"] == rows[6]["n_words"] == 0
    assert rows[3]["kept"]  # no host: judged alone
    assert quality.quality_rules(none).count() == quality.keep_good(none).count() == 0
    assert quality.keep_good(messy).columns == messy.columns


def test_bad_host_takes_its_documents_along(spark):
    rows = [(i, "bad", "bad") for i in range(50)] + [(50, PROSE, "bad")]
    rows += [(100 + i, PROSE + f" {i}", "good") for i in range(50)] + [(150, "short", "good")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r["doc_id"] for r in quality.keep_good(df).collect()}
    assert kept == {100 + i for i in range(50)}


def test_exact_dedup_odd_rows(messy, none):
    rows = exact.exact_dedup(messy, digest_all=True).collect()
    assert len(rows) == len(ROWS)
    groups = defaultdict(list)
    for r in rows:
        groups[bytes(r["text_sha256"])].append(r)
    for g in groups.values():
        assert sum(r["kept"] for r in g) == 1 and {r["group_size"] for r in g} == {len(g)}
        ids = [r["doc_id"] for r in g if r["doc_id"] is not None]
        assert {r["keep_id"] for r in g} == {max(ids, default=None)}
    assert exact.exact_dedup(none).count() == 0


def test_lines(spark, messy, none):
    assert lines.remove_boilerplate(messy).count() == len(ROWS)
    assert lines.keep_unboiled(messy).columns == messy.columns
    assert lines.keep_unboiled(none).count() == 0
    rows = [(i, f"own {i}\n  shared line \n\nlast {i}", f"s{i % 12}") for i in range(40)]
    rows += [(90, "few", "s1"), (91, "few", "s2"), (92, " shared line", "s3"), (93, None, "s1")]
    out = {r["doc_id"]: r for r in lines.remove_boilerplate(
        spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert out[0]["text"] == rows[0][1] and out[1]["text"] == "own 1\n\nlast 1"
    assert out[90]["n_removed"] == 0 and out[92]["text"] == "" and out[93]["text"] is None


def components(frame, threshold=85):
    sets = [(i, shingles(t)) for i, t in frame]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for (i, (_, a)), (j, (_, b)) in itertools.combinations(enumerate(sets), 2):
        if a and b and 100 * len(a & b) >= threshold * len(a | b):
            root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: (len(s), least[find(i)] if s else d) for i, (d, s) in enumerate(sets)}


def test_near_duplicates_against_all_pairs(spark, docs):
    rng, rows = random.Random(3), []
    for base in range(12):  # dense regions: copies of a base, not all like one another
        body = [f"w{base}_{rng.randrange(300)}" for _ in range(160)]
        for k in range(25):
            copy = list(body)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = f"new{rng.randrange(10**6)}"
            rows.append((10_000 + 100 * base + k, " ".join(copy).upper() if k % 2 else " ".join(copy)))
    rows += list(zip(docs["doc_id"].tolist(), docs["text"].tolist()))
    got = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == components(rows)


def crowd(pairs):
    """Copies of a text with a word or two changed: 67 to 81 percent alike, but for ``pairs`` of 85 or more."""
    rng = random.Random(8)
    body, rows = [f"t{i}" for i in range(100)], []
    for k in range(pairs):
        at = rng.randrange(4, 94)
        other = (at + rng.randrange(10, 80)) % 94
        for shift in (0, 2):
            copy = list(body)
            copy[at + shift] = f"n{rng.randrange(10**9)}"
            if k % 2:
                copy[other] = f"same{k}"
            rows.append((len(rows) * 7919 % 10_007, " ".join(copy)))
    return rows


def test_near_duplicates_beyond_the_window(spark, monkeypatch):
    """More nodes with a common prefix than a pass looks back to."""
    monkeypatch.setattr(near, "LOOK", 2)
    rows = crowd(60)
    got = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == components(rows)


def test_near_duplicates_after_passes_without_links(spark, monkeypatch):
    """The passes test one candidate of a node and tree; what is left is linked all the same."""
    monkeypatch.setattr(near, "CHOICES", (1,))
    rows = crowd(60)
    got = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == components(rows)


def test_near_duplicates_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(near, "SEAM", 1)  # as many partitions as the rows allow
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    rows = crowd(120)
    try:
        got = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == components(rows)


def test_near_duplicates_odd_rows(messy, none):
    rows = near.near_duplicates(messy).collect()
    assert len(rows) == len(ROWS)
    by = defaultdict(set)
    for r in rows:
        by[r["doc_id"]].add((r["n_shingles"] > 0, r["component_id"]))
    assert by[1] == by[2] == by[3] == {(True, 1)} and (True, 1) in by[None]
    assert by[4] == {(False, 4)} and by[8] == {(True, 7)}
    kept = near.keep_representatives(messy)
    assert kept.columns == messy.columns
    assert Counter(r["doc_id"] for r in kept.collect())[1] == 1
    assert near.near_duplicates(none).count() == near.keep_representatives(none).count() == 0


def test_preferences_odd_rows(spark):
    def turns(conv, *texts):
        return [(conv, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)]
    rows = turns(1, "q", "short") + turns(2, "q", "a longer answer", None, "more") + turns(3, "q", "short")
    rows += turns(4, None, "x") + [(None, 0, "user", "q"), (5, None, None, None), (5, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    convs = preferences.stored_conversations(df)
    got = {(r["chosen_id"], r["rejected_id"]): r for r in preferences.format_pairs(
        preferences.pairs_by_first_turn(convs).unionByName(preferences.pairs_by_stale_reply(convs))).collect()}
    assert set(got) == {(2, 1), (2, 3), (2, 2)}
    assert got[2, 1]["prompt"] == "<|user|>\nq<|end|>\n" and got[2, 2]["n_prompt_turns"] == 3
    assert got[2, 1]["rejected_mask"] == "0:14,1:13"
    assert len(got[2, 1]["rejected_text"]) == 27
    assert preferences.conversations(df.limit(0)).count() == 0


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_shards(spark, docs, messy, none, shards):
    rows = sharding.shard_by_bytes(documents(spark, SF), shards).toPandas()
    size = {d: len(t.encode()) + 16 for d, t in zip(docs["doc_id"], docs["text"])}
    assert dict(zip(rows["doc_id"], rows["size"])) == size
    crc = {d: zlib.crc32(t.encode()) for d, t in zip(docs["doc_id"], docs["text"])}
    assert dict(zip(rows["doc_id"], rows["text_crc32"])) == crc
    loads = rows.groupby("shard")["size"].sum().reindex(range(shards), fill_value=0)
    assert (abs(loads - sum(size.values()) / shards) <= max(size.values())).all()
    for _, slots in rows.groupby("shard")["slot"]:
        assert sorted(slots) == list(range(len(slots)))
    odd = sharding.shard_by_bytes(messy, shards).toPandas()
    assert len(odd) == len(ROWS) and not odd.duplicated(["shard", "slot"]).any()
    assert sharding.shard_by_bytes(none, shards).count() == 0


def test_packing_round_trip(spark, docs, messy, none):
    from tokenizers import Tokenizer
    slow = Tokenizer.from_file(packing.tokenizer_path() + ".json")
    slow.encode_special_tokens = True
    ids = {d: [*slow.encode(t, add_special_tokens=False).ids, 0] for d, t in zip(docs["doc_id"], docs["text"])}
    frame = documents(spark, SF)
    packed = packing.pack(frame)
    rows = packed.toPandas()
    for r in rows.itertuples():
        part = np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4")
        assert len(part) == r.length <= 2048 and zlib.crc32(part.tobytes()) == r.ids_crc32
    assert rows["length"].sum() == sum(map(len, ids.values()))
    ordered = rows.sort_values(["sequence_id", "offset"])
    ends = (ordered["offset"] + ordered["length"]).groupby(ordered["sequence_id"])
    assert (ends.shift(fill_value=0) == ordered["offset"]).all() and ends.max().max() <= 2048
    assert rows["sequence_id"].nunique() <= -(-rows["length"].sum() // 2048) + 1
    made = {r["sequence_id"]: r["ids"] for r in packing.sequences(frame, packed).collect()}
    first = ordered.iloc[0]
    assert made[first["sequence_id"]][:first["length"]] == ids[first["doc_id"]][first["start"]:][:first["length"]]
    assert packing.pack(messy).select("doc_id").count() >= len(ROWS) and packing.pack(none).count() == 0


def test_packing_ids_of_added_tokens(spark):
    from tokenizers import Tokenizer
    slow = Tokenizer.from_file(packing.tokenizer_path() + ".json")
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n" * 900, "a <|endoftext| > b"]
    want = [[*slow.encode(t, add_special_tokens=False).ids, 0] for t in texts]
    assert want[0] == [64, 220, 50256, 275, 0]
    rows = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in rows:
        part = np.array(want[r["doc_id"]][r["start"]:r["start"] + r["length"]], "<u4")
        assert len(part) == r["length"] and zlib.crc32(part.tobytes()) == r["ids_crc32"]
    assert sum(r["length"] for r in rows) == sum(map(len, want))


def test_best_fit_matches_a_linear_search():
    rng = random.Random(5)
    lengths = sorted((rng.randrange(1, 65) for _ in range(400)), reverse=True)
    where, _ = packing.best_fit_decreasing(np.array(lengths), 64)
    room = []
    for n in lengths:
        fits = [c for c in room if c >= n]
        if fits:
            room.remove(min(fits))
            room.append(min(fits) - n)
        else:
            room.append(64 - n)
    loads = Counter()
    for b, n in zip(where.tolist(), lengths):
        loads[b] += n
    assert sorted(64 - x for x in loads.values()) == sorted(room)


def test_mix(spark, docs, messy, none):
    rows = queries.op8_flow_mixing(spark, SF).toPandas().merge(docs[["doc_id", "source"]], on="doc_id")
    assert (rows["taken"] <= 3 * rows["size"]).all()
    for _, g in rows.groupby("source"):
        assert abs(g["taken"].sum() - g["target"].iloc[0]) <= g["size"].max()
        assert (g["source_size"] == g["size"].sum()).all()
    assert mixing.mix_sizes(messy).count() == len(ROWS) and mixing.mix_sizes(none).count() == 0
    assert mixing.mixed_documents(messy).columns == messy.columns


def test_mixed_documents_take_what_mix_says(spark, messy):
    whole = documents(spark, SF)
    both = F.when(F.col("doc_id") % 4 == 0, F.array("source", F.lit("zz"))).otherwise(F.array("source"))
    for df, options in ((whole, {}), (whole, {"sources": both}), (messy, {})):
        rows, stored = mixing.mix(df, **options)
        want = (stored.join(rows, "_row").filter("copies > 0")
                .select("_doc.doc_id", F.expr("explode(sequence(1, copies))")).groupBy("doc_id").count())
        got = mixing.mixed_documents(df, **options).groupBy("doc_id").count()
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_targets_and_flow():
    goal = mixing.targets({"a": 10, "b": 1000, None: 90})
    assert goal["a"] == 30 and sum(goal.values()) == 1100 and goal[None] == 270
    flow = mixing.route([(10, ["a"]), (10, ["a", "b"]), (10, ["b"])], {"a": 25, "b": 5})
    assert sum(f.get("a", 0) for f in flow) == 25 and sum(f.get("b", 0) for f in flow) == 5
    assert max(sum(f.values()) for f in flow) <= 20  # a third lap costs more than a second


def test_passages(spark, none, messy):
    rng = random.Random(1)

    def text(n):
        return [f"v{rng.randrange(10**6)}" for _ in range(n)]
    shared, fuzzy = text(60), text(120)
    edited = [w if i % 12 else "edit" for i, w in enumerate(fuzzy)]
    rows = [(1, text(80) + shared + text(30)), (2, text(10) + shared + text(90)), (3, text(300)),
            (4, text(40) + fuzzy), (5, edited + text(70)), (6, text(30) + shared[:40] + text(30))]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    got = {(r["doc_id"], r["source_id"]): r for r in passages.repeated_passages(df).collect()}
    assert set(got) == {(2, 1), (5, 4)}
    assert (got[2, 1]["start"], got[2, 1]["finish"], got[2, 1]["source_start"]) == (10, 70, 80)
    length = got[5, 4]["finish"] - got[5, 4]["start"]
    assert length >= 50 and 100 * got[5, 4]["n_equal"] >= 80 * length
    assert passages.repeated_passages(none).count() == 0
    odd = {(r["doc_id"], r["source_id"]) for r in passages.repeated_passages(messy).collect()}
    assert {(2, 1), (3, 1)} <= odd  # copies are linked to the smallest id


@pytest.mark.parametrize("change", ["every sixth", 0.1, 0.15])
def test_passages_recall_of_fuzzy_copies(spark, change):
    """Brute force: the planted stretches are 83 to 90 percent equal, word by word."""
    rng, rows, planted = random.Random(11), [], set()

    def text(n):
        return [f"v{rng.randrange(10**9)}" for _ in range(n)]
    for k in range(0, 200, 2):
        body = text(61)
        at = range(0, 61, 6) if change == "every sixth" else rng.sample(range(61), round(61 * change))
        edited = list(body)
        for i in at:
            edited[i] = text(1)[0]
        # the best stretch, by every start and end; of equal ones the shortest
        same = np.cumsum([0, *(20 if a == b else -80 for a, b in zip(body, edited))])
        best = max((same[e] - same[s], s - e) for s in range(61) for e in range(s + 1, 62))
        if best[1] <= -50:
            planted.add((k + 1, k))
        rows += [(k, " ".join(text(40) + body + text(40))), (k + 1, " ".join(text(50) + edited + text(30)))]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {(r["doc_id"], r["source_id"]) for r in got}
    assert len(planted) > 10 and found <= {(k + 1, k) for k in range(0, 200, 2)}
    assert len(found & planted) >= 0.97 * len(planted)


def test_passages_of_common_fragments(spark):
    """Every seed that 50 and 51 share stands in a lower and a higher document as well."""
    rng = random.Random(4)

    def text(n):
        return [f"v{rng.randrange(10**9)}" for _ in range(n)]
    shared = text(80)
    rows = [(50, text(20) + shared + text(30)), (51, text(40) + shared + text(10))]
    for k, at in enumerate(range(0, 80, 10)):
        rows += [(i + k, text(60) + shared[at:at + 34] + text(60)) for i in (1, 90)]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    got = {(r["doc_id"], r["source_id"]): r for r in passages.repeated_passages(df).collect()}
    assert set(got) == {(51, 50)}
    assert got[51, 50]["start"] == 40 and got[51, 50]["finish"] == 120 and got[51, 50]["source_start"] == 20


def test_passages_of_families(spark):
    """Brute force over families of variants of one passage, the outermost ids changed most."""
    rng, rows, bodies = random.Random(7), [], {}

    def text(n):
        return [f"v{rng.randrange(10**9)}" for _ in range(n)]
    for family in range(8):
        body, ids = text(100), rng.sample(range(family, 8000, 8), 24)
        for rank, i in enumerate(sorted(ids)):
            change = 30 if rank in (0, 1, 22, 23) else 11
            edited = list(body)
            for at in rng.sample(range(100), change):
                edited[at] = text(1)[0]
            bodies[i] = edited
            rows.append((i, " ".join(text(40) + edited + text(40))))

    def alike(u, v):
        gain = np.cumsum([0, *(20 if p == q else -80 for p, q in zip(u, v))])
        return any((gain[s + 50:] >= gain[s]).any() for s in range(51))
    true = {(i, j) for i in bodies for j in bodies if j < i and i % 8 == j % 8 and alike(bodies[i], bodies[j])}
    got = {(r["doc_id"], r["source_id"]) for r in passages.repeated_passages(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got <= true
    parent = {i: i for i in bodies}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, j in got:
        parent[root(i)] = root(j)
    assert len(true) > 500 and sum(root(i) == root(j) for i, j in true) >= 0.97 * len(true)


def test_passages_among_decoys(spark):
    """Texts with a seed of the pair and the words after it stand between the two in any order by words."""
    rng = random.Random(5)

    def text(n):
        return [f"v{rng.randrange(10**9)}" for _ in range(n)]
    one = text(60)
    other = [w if i % 7 else "edit" for i, w in enumerate(one)]
    rows = [(1, text(20) + one + text(30)), (2, text(40) + other + text(10))]
    for at in range(0, 60, 4):
        for body in (one, other):
            rows += [(len(rows) + k, text(60) + body[at:at + 24] + text(60)) for k in range(1, 13)]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    got = {(r["doc_id"], r["source_id"]) for r in passages.repeated_passages(df).collect()}
    assert got == {(2, 1)}


@pytest.mark.parametrize("block", [None, 40])
def test_places_of_a_crowded_seed(spark, monkeypatch, block):
    """A seed in every text: of all pairs, those alike around it end in one component, in blocks too."""
    if block:
        monkeypatch.setattr(passages, "BLOCK", block)
    rng = random.Random(6)

    def text(n):
        return [f"v{rng.randrange(10**9)}" for _ in range(n)]
    seed, rows, bodies = text(7), [], {}
    for family in range(6):
        left, right = text(30), text(30)
        for k in range(12):
            body = left + seed + right
            for i in rng.sample([*range(30), *range(37, 67)], 9):
                body[i] = text(1)[0]
            bodies[12 * family + k] = body
    rows = [(i, text(30) + body + text(30)) for i, body in bodies.items()]
    rows += [(100 + i, text(40) + seed + text(40)) for i in range(60)]
    got = {(r["doc_id"], r["source_id"]) for r in passages.repeated_passages(spark.createDataFrame(
        [(i, " ".join(w)) for i, w in rows], "doc_id long, text string")).collect()}

    def alike(u, v):
        gain = np.cumsum([0, *(20 if p == q else -80 for p, q in zip(u, v))])
        return any((gain[s + 50:] >= gain[s]).any() for s in range(len(u) - 49))
    true = {(i, j) for i in bodies for j in bodies if j < i and i // 12 == j // 12 and alike(bodies[i], bodies[j])}
    assert len(true) > 100 and got <= true
    parent = {i: i for i in bodies}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, j in got:
        parent[root(i)] = root(j)
    assert all(root(i) == root(j) for i, j in true)


def test_rows_beside_their_texts(spark):
    """A text of many chains does not hold their pieces in one row: each comes as its own after it."""
    texts = spark.createDataFrame([(n, 10 * n, f"Text {n} É") for n in range(20)], "node long, doc long, _t string")
    rows = spark.createDataFrame([(3, i, b"v" * 1000) for i in range(400)] + [(7, 0, None), (99, 1, b"")],
                                 "b long, a long, v binary")
    both = passages._beside(rows, "b", texts)
    assert max(len(r["v"] or b"") + len(r["_t"] or "") for r in both.collect()) == 1000 and both.count() == 422

    def task(batches):
        found = [(node, doc, b" ".join(body), *row) for node, doc, body, row in passages._each(batches)]
        yield pa.RecordBatch.from_pylist([dict(zip(("node", "doc", "body", "a", "v"), r)) for r in found], schema=out)
    out = pa.schema([("node", pa.int64()), ("doc", pa.int64()), ("body", pa.binary()), ("a", pa.int64()), ("v", pa.binary())])
    got = both.mapInArrow(task, "node long, doc long, body binary, a long, v binary").collect()
    assert {(r["node"], r["doc"], bytes(r["body"]), r["a"]) for r in got} == {
        *((3, 30, "text 3 É".encode(), i) for i in range(400)), (7, 70, "text 7 É".encode(), 0)}


def test_crowded_places_come_in_parts(monkeypatch):
    """Of 60 texts with one line in common, those whose words go on alike, also after a gap, are given;
    many pairs leave in parts, and parts change nothing."""
    rng = random.Random(8)
    reach, n = passages.MIN_WORDS, 60
    w = np.array([[rng.randrange(1, 1 << 16) for _ in range(2 * reach + passages.K)] for _ in range(n)], np.uint16)
    w[:, :8] = w[0, :8]
    w[:, reach:reach + 8] = w[0, reach:reach + 8]
    w[:, 2 * reach:] = w[0, 2 * reach:]
    w[21, :2 * reach] = np.where(np.arange(2 * reach) % 9 == 8, w[21, :2 * reach], w[20, :2 * reach])
    w[41, :reach] = w[40, :reach]  # 3 words more after 20 equal ones
    w[41, reach:reach + 20], w[41, reach + 23:2 * reach] = w[40, reach:reach + 20], w[40, reach + 20:2 * reach - 3]
    w[31, reach:reach + 20], w[31, reach + 23:2 * reach] = w[30, reach:reach + 20], w[30, reach + 20:2 * reach - 3]
    group, node = np.ones(n, np.int64), np.arange(n)

    def pairs():
        return {(int(a), int(b)) for i, j, _ in passages.linked_places(group, node, w, reach, passages.SIMILARITY)
                for a, b in zip(i, j)}
    assert pairs() == {(20, 21), (30, 31), (40, 41)}
    monkeypatch.setattr(passages, "LISTED", 16)
    monkeypatch.setattr(passages, "MANY", 0)
    monkeypatch.setattr(passages, "ROWS", 8)
    assert pairs() == {(20, 21), (30, 31), (40, 41)}


def test_passages_longer_than_their_chains(spark):
    """A passage of which two documents share few neighbouring places is followed to its ends."""
    rng = random.Random(3)

    def text(n):
        return [f"v{rng.randrange(10**9)}" for _ in range(n)]
    shared = text(1500)
    rows = [(k, " ".join(text(20 + k) + shared + text(30))) for k in range(6)]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {i for r in got for i in (r["doc_id"], r["source_id"])} == set(range(6))
    for r in got:
        assert (r["start"], r["finish"]) == (20 + r["doc_id"], 1520 + r["doc_id"]) and r["n_equal"] == 1500
        assert (r["source_start"], r["source_finish"]) == (20 + r["source_id"], 1520 + r["source_id"])


def test_passage_gaps():
    """A gap too large for the edit distance is one insertion at its best place."""
    u = np.arange(600)
    v = np.concatenate([u[:250], np.arange(1000, 1040), u[250:]])
    of_u, of_v, equal = passages._gap(u, v)
    assert len(u) * len(v) > passages.CELLS and equal.sum() == 600 and of_u.sum() == 600 and of_v.sum() == 640
    for a, b in ((u, v), (v, u)):
        assert passages.align(a, b, [0], [0], 50, 80) == [(0, 250, 0, 250, 250)]


def test_language(spark, messy, none):
    rows = queries.op10_language_id(spark, SF).toPandas().merge(
        documents(spark, SF).select("doc_id", "lang").toPandas(), on="doc_id")
    held = rows[rows["held_out"]]
    assert (held["lang_pred"] == held["lang"]).mean() > 0.95 and rows["score"].between(0, 1).all()
    odd = language.identify(messy, F.lit(True)).collect()
    assert len(odd) == len(ROWS)
    assert {r["lang_pred"] for r in odd if r["doc_id"] in (4, 5, 6)} == {"und"}
    assert language.identify(none, F.lit(True)).count() == 0
    assert {r["lang_pred"] for r in language.identify(messy, F.lit(False)).collect()} == {"und"}
    whole = "abc déf " * 300_000
    a, b = (Counter(np.concatenate([x for x, _ in language._pieces([whole])]).tolist()), Counter())
    for n in language.ORDERS:  # pieces count each n-gram once
        b[n] = len(whole) + 2 - max(language.ORDERS) + 1
    assert sum(a.values()) == sum(b.values())


def test_near_stage_finds_copies_of_80_percent(spark):
    rng, rows = random.Random(12), []
    for k in range(0, 200, 2):
        body = [f"b{rng.randrange(10**9)}" for _ in range(154)]
        copy = list(body)
        for i in range(10, 150, 50):  # each changed word changes five shingles: 150 - 15 of 150 + 15
            copy[i] = f"c{rng.randrange(10**9)}"
        copy[30 + k % 40:30 + k % 40] = ["x"] if k % 4 else []
        rows += [(k, " ".join(body)), (k + 1, " ".join(copy))]
    groups = components(rows, 80)
    assert sum(c != d for d, (n, c) in groups.items()) > sum(c != d for d, (n, c) in components(rows).items()) + 20
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.near_stage(spark, frame, SF).select("doc_id").collect()
    assert {r["doc_id"] for r in kept} == {d for d, (n, c) in groups.items() if c == d}


def test_pipeline_stages(spark, docs):
    frame, seen = documents(spark, SF), {}
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, SF)
        seen[name] = frame.toPandas()
        if name != "packing":
            assert frame.columns == list(docs.columns)
    good = seen["quality rules"]
    for t in good["text"]:
        assert len(words(t)) >= 10
    after = seen["near dedup"]
    groups = components(list(zip(seen["line dedup"]["doc_id"], seen["line dedup"]["text"])),
                        corpus_pipeline.NEAR_PERCENT)
    assert set(after["doc_id"]) == {d for d, (n, c) in groups.items() if c == d}
    mixed = Counter(seen["mixing"]["doc_id"])
    assert set(mixed) <= set(after["doc_id"]) and max(mixed.values()) <= 3
    firsts = seen["packing"].query("piece == 0")["doc_id"]
    assert Counter(firsts) == mixed


def test_pipeline_stages_on_odd_rows(spark, messy, none):
    """Nulls, empty and very long texts, repeats, clashing columns and an empty table go through
    all five stages."""
    for frame in (messy, none):
        columns, seen = frame.columns, {}
        for name, stage in corpus_pipeline.STAGES:
            frame = corpus_pipeline.materialise(stage(spark, frame, SF), "odd")
            seen[name] = frame
            if name != "packing":
                assert frame.columns == columns
        if columns and seen["quality rules"].isEmpty():
            assert all(f.isEmpty() for f in seen.values())
            continue
        good = [r["text"] for r in seen["quality rules"].select("text").collect()]
        assert good and all(len(words(t)) >= 10 for t in good)
        left = [(r["doc_id"], r["text"]) for r in seen["near dedup"].select("doc_id", "text").collect()]
        assert len(left) == len(set(left))
        groups = components([(i, t) for i, t in enumerate(t for _, t in left)], corpus_pipeline.NEAR_PERCENT)
        assert all(c == i for i, (n, c) in groups.items())  # no two near copies are left
        mixed = Counter(r["doc_id"] for r in seen["mixing"].select("doc_id").collect())
        firsts = Counter(r["doc_id"] for r in seen["packing"].filter("piece = 0").select("doc_id").collect())
        assert firsts == mixed and set(mixed) <= {d for d, _ in left}
    assert none.isEmpty()
