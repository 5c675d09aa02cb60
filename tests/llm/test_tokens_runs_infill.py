"""Piece tokens against the sentencepiece library, periodic runs against all periods by brute
force, fill-in-the-middle against regular expressions; odd rows for each."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from crease.llm import infill, pieces, queries, runs
from crease.llm.common import documents
from crease.llm.wavelet import WaveletMatrix

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, ids string, runs string, "
          "form string, output string, n long, decoded string, h1 string, start string, __w string")
TEXTS = [None, "", " ", " \n\t ", "one two", "one two", "na " * 3000, "x" * 100_000, "ä日本 𝄞\x00▁▁ <s> <0x41>\n",
         " ".join(f"w{i % 40}" for i in range(5000)), " lead and  trail \x0b", "has <S> inside", "\x08a\x0eb\x1f c",
         "\n\nline\n\n", "aab" * 400, " " * 3000]
UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def messy(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(0, "other text of id 0"), (4, "one two"), (None, "no id here"),
                                                    (None, None), (2**60 + 1, "far id")]
    rows += [(100 + k, " ".join(f"v{(i * i) % 23}" for i in range(k))) for k in range(60)]
    pad = ("en", "s", 1, "i", "r", "f", "o", 2, "d", "h", "s", "w")
    return spark.createDataFrame([(*r, *pad) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def run_on(monkeypatch, query, frame):
    monkeypatch.setattr(queries, "documents", lambda spark, sf_dir: frame)
    return [tuple(r) for r in query(frame.sparkSession, SF).collect()]


def same_rows(got, want):
    key = lambda r: tuple("" if v is None else str(v) for v in r)
    assert sorted(got, key=key) == sorted(want, key=key)


# --- tokens ------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())


def expected_tokens(library, rows):
    out = []
    for d, t in rows:
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        out.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha(library.decode(ids))))
    return out


def pairs_of(frame):
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]


def test_tokens_are_the_librarys(spark, library):
    docs = documents(spark, SF)
    got = [tuple(r) for r in queries.op11_piece_tokens(spark, SF).collect()]
    same_rows(got, expected_tokens(library, pairs_of(docs)))


def test_tokens_of_odd_rows(monkeypatch, library, messy, none):
    got = run_on(monkeypatch, queries.op11_piece_tokens, messy)
    same_rows(got, expected_tokens(library, pairs_of(messy)))
    assert run_on(monkeypatch, queries.op11_piece_tokens, none) == []


@pytest.mark.parametrize("rounds", [pieces.ROUNDS, 1])
def test_merge_rounds_equal_single_merges(monkeypatch, library, rounds):
    monkeypatch.setattr(pieces, "ROUNDS", rounds)
    encoder, rng = pieces.Encoder(pieces.vocabulary(pieces.model_path())), random.Random(3)
    parts = ["the", "in", "he", "er", "a", "aa", " ", "   ", "\n", "▁", "<s>", "<0x41>", "é", "日本", "𝄞", "tion", "1"]
    for _ in range(60):
        unit = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 4)))
        texts = [unit * rng.randrange(1, 50)] + ["".join(rng.choice(parts) for _ in range(rng.randrange(60)))
                                                 for _ in range(20)]
        ids, bounds = encoder.encode(texts)
        want = library.encode(texts, add_bos=True, add_eos=True)
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == want
        assert encoder.model.decode(ids, bounds) == [library.decode(w) for w in want]


def test_forgotten_words_are_encoded_again(monkeypatch, library):
    monkeypatch.setattr(pieces, "REMEMBER_WORDS", 3)
    monkeypatch.setattr(pieces, "REMEMBER_CHARS", 4)
    encoder = pieces.Encoder(pieces.vocabulary(pieces.model_path()))
    for texts in (["a longer word here"], ["a word"], ["here a longer word", ""], ["one more, and longer"]):
        ids, bounds = encoder.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == library.encode(texts, add_bos=True, add_eos=True)


def test_decode_of_any_ids(spark, library):
    rng = random.Random(5)
    lists = [[rng.choice([rng.randrange(32000), rng.randrange(0, 262)]) for _ in range(rng.randrange(15))]
             for _ in range(400)]
    frame = spark.createDataFrame([(i, bytearray(np.array(x, "<u4").tobytes())) for i, x in enumerate(lists)] + [(-1, None)],
                                  "doc_id long, ids binary")
    got = {r["doc_id"]: r["decoded"] for r in pieces.decode(frame).collect()}
    assert got == {i: library.decode(x) for i, x in enumerate(lists)} | {-1: ""}


# --- runs --------------------------------------------------------------------------------------

def all_runs(x, min_words=24, repeats=3):
    """Every run by trying every period."""
    found = {}
    for q in range(1, len(x) // repeats + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_words, repeats * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, q, e - s) for (s, e), q in found.items())


def expected_runs(doc, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if doc is not None and n:
        h = zlib.crc32(str(doc).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = all_runs(w)
    gone = set()
    for s, q, m in found:
        gone.update(range(s + q, s + m))
    best = min(((-Fraction(m, q), s, q, m) for s, q, m in found), default=None)
    return (doc, len(found), *((best[1], best[3], best[2], 1000 * best[3] // best[2]) if best else [None] * 4),
            sha("".join(f"{s},{m},{q}\n" for s, q, m in found)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_runs_equal_brute_force_on_the_table(spark):
    docs = documents(spark, SF).filter("n_chars < 12000 OR n_chars IS NULL")
    few = dict(pairs_of(docs))
    got = [tuple(r) for r in queries.op12_periodic_runs(spark, SF).collect() if r["doc_id"] in few]
    want = [expected_runs(d, t) for d, t in few.items()]
    same_rows(got, want)
    assert sum(r[1] > 0 for r in want) > 10


def test_runs_of_odd_rows(monkeypatch, messy, none):
    near = messy.filter("doc_id IS NULL OR doc_id < 1000").withColumn("text", F.substring("text", 1, 4000))
    got = run_on(monkeypatch, queries.op12_periodic_runs, near)
    same_rows(got, [expected_runs(d, t) for d, t in pairs_of(near)])
    whole = run_on(monkeypatch, queries.op12_periodic_runs, messy)
    key = lambda d: (d is None, d)
    assert sorted((r[0] for r in whole), key=key) == sorted((d for d, _ in pairs_of(messy)), key=key)
    assert run_on(monkeypatch, queries.op12_periodic_runs, none) == []


def test_find_runs_equals_brute_force():
    rng = random.Random(8)

    def text():
        n, k = rng.randrange(0, 200), rng.choice([1, 2, 2, 3, 5, 50])
        kind = rng.randrange(5)
        if kind == 0:
            return [rng.randrange(k) for _ in range(n)]
        if kind == 1:
            a, b = [0], [0, 1]
            while len(b) < n:
                a, b = b, b + a
            return b[:n]
        unit = [0] * rng.randrange(1, 20) + [1] * rng.randrange(3) + [0] * rng.randrange(9) + [2] * rng.randrange(2)
        if kind == 2:
            unit = [0, 1] * rng.randrange(1, 12) + [2] * rng.randrange(3)
        body = (unit * 200)[rng.randrange(5):][:n]
        for _ in range(rng.randrange(3) if n else 0):
            body[rng.randrange(n)] = 7
        return body + body[::-1] if kind == 4 else body

    seen = 0
    for _ in range(150):
        texts = [text() for _ in range(rng.randrange(1, 8))]
        x, first = [], []
        for d, t in enumerate(texts):
            first.append(len(x))
            x += t + [-1 - d]
        for min_words, repeats in ((24, 3), (rng.randrange(3, 40), rng.choice([3, 4, 5]))):
            got = list(zip(*(a.tolist() for a in runs.find_runs(np.array(x), min_words, repeats))))
            want = sorted((f + s, f + s + m, q) for f, t in zip(first, texts) for s, q, m in all_runs(t, min_words, repeats))
            assert got == want
            seen += len(want)
    assert seen > 500
    with pytest.raises(ValueError):
        runs.find_runs(np.array([0, -1]), 24, 2)


def test_wavelet_matrix():
    rng = np.random.default_rng(4)
    values = rng.integers(0, 1000, 3000)
    tree = WaveletMatrix(values, 10)
    for _ in range(100):
        lo, hi = sorted(rng.integers(0, 3001, 2))
        bound = int(rng.integers(0, 1100))
        assert tree.count_less([lo], [hi], [bound])[0] == (values[lo:hi] < bound).sum()
        assert tree.rank(int(values[7]), np.array([hi]))[0] == (values[:hi] == values[7]).sum()
        if lo < hi:
            k = int(rng.integers(0, hi - lo))
            assert tree.quantile([lo], [hi], [k])[0] == np.sort(values[lo:hi])[k]


# --- fill in the middle ------------------------------------------------------------------------

def expected_infill(doc, text):
    t = text or ""
    digest = hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    u = UNITS.findall(t)
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    x, y, z = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return (doc, len(u), "plain", None, None, sha(t), sha(t))
    if h[3] % 100 < 80:
        return (doc, len(u), "spm", len(x), len(y), sha(f"<S>{z}<P>{x}<M>{y}"), sha(t))
    return (doc, len(u), "psm", len(x), len(y), sha(f"<P>{x}<S>{z}<M>{y}"), sha(t))


def test_infill_of_table_and_odd_rows(monkeypatch, spark, messy, none):
    for frame in (documents(spark, SF), messy):
        got = run_on(monkeypatch, queries.op13_fill_in_middle, frame)
        want = [expected_infill(d, t) for d, t in pairs_of(frame)]
        same_rows(got, want)
        assert {r[2] for r in want} == {"plain", "psm", "spm"}
    assert run_on(monkeypatch, queries.op13_fill_in_middle, none) == []


@pytest.mark.parametrize("unit", ["lines", "chars"])
def test_other_units_restore(messy, unit):
    rows = infill.fill_in_middle(messy, unit=unit, rate=100, spm_share=50)
    back = rows.select("doc_id", "n", "form", infill.restored(F.col("output"), F.col("form")).alias("text")).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in back) == sorted((str(d), t or "") for d, t in pairs_of(messy))
    for r in back:
        n = len(r["text"]) if unit == "chars" else len([x for x in re.split(r"(?<=\n)", r["text"]) if x])
        assert r["n"] == n
    with pytest.raises(ValueError):
        infill.fill_in_middle(messy, unit="pages")
