"""Language identification, hard negatives and the filter audit against brute force and on edge cases."""

import math
import random
import sys
import unicodedata
import zlib
from itertools import permutations
from pathlib import Path

import numpy as np
import pyarrow.dataset as ds
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from test_operators import EDGE, SCHEMA, query  # noqa: E402

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------------------- language identification

def brute_vector(text, dim):
    from staffrank.llm.language_id import letter_vectors

    code = [0] + [ord(c) if unicodedata.category(c)[0] in "LM" else 0 for c in text.lower()] + [0]
    total = np.zeros(dim)
    if any(unicodedata.category(c)[0] == "L" for c in text):
        for a, b, c in zip(code, code[1:], code[2:], strict=False):
            if b:
                v = letter_vectors(np.array([a, b, c]), dim)
                total += np.roll(v[0], 2) * np.roll(v[1], 1) * v[2]
    return total


@pytest.mark.parametrize("texts", [
    ["Der Hund bellt.", "", "the cat", "12 34 !", "́́", "été", "日本語の文章 と English", "ÀÉÎ ß"],
    ["x"], [""], [], ["a b c " * 40, "ab" * 300],
])
def test_text_vectors_equal_sums_of_bound_letters(texts, monkeypatch):
    from staffrank.llm import language_id as L

    want = [brute_vector(t, 128) for t in texts]
    assert np.array_equal(L.text_vectors(texts, 128), np.array(want).reshape(len(texts), 128))
    # the same in small windows, slices of trigrams and blocks of texts
    for name, value in (("WINDOW", 7), ("GRAMS", 3), ("TEXTS", 2), ("HELD", 5)):
        monkeypatch.setattr(L, name, value)
    assert np.array_equal(L.text_vectors(texts, 128), np.array(want).reshape(len(texts), 128))


def test_trigrams_of_many_letters_are_sorted_the_same():
    from staffrank.llm.language_id import _distinct

    rng = np.random.default_rng(1)
    for letters in (20, 5000):
        code = rng.choice(rng.integers(1, 0x10FFFF, letters), 400)
        at = np.arange(1, len(code) - 1)
        gram, which = _distinct(code, at)
        want, inverse = np.unique(code[at - 1] << 42 | code[at] << 21 | code[at + 1], return_inverse=True)
        assert np.array_equal(gram, want) and np.array_equal(which, inverse)


def test_language_query_learns_from_the_other_folds_only(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = query(spark, "op11_language_id").collect()
    assert len(found) == len(docs)
    right = n = 0
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
        if r.held_out and len(docs[r.doc_id].text) >= 100:
            n, right = n + 1, right + (r.lang_pred == docs[r.doc_id].lang)
    assert n >= 20 and right >= 0.97 * n


def test_language_by_cosine_of_prototypes(spark):
    from staffrank.llm.language_id import identify

    docs = ds.dataset(f"{SF}/documents.parquet").to_table().to_pandas()[["doc_id", "text", "lang"]].head(60)
    docs.text = docs.text.str[:200]
    got = {r.doc_id: r for r in identify(spark.createDataFrame(docs).repartition(5)).collect()}
    vector = {i: brute_vector(t, 1024) for i, t in zip(docs.doc_id, docs.text, strict=True)}
    proto = {}
    for i, lang in zip(docs.doc_id, docs.lang, strict=True):
        if zlib.crc32(str(i).encode()) % 5:
            proto[lang] = proto.get(lang, 0) + vector[i]
    for i, v in vector.items():
        cos = {k: v @ p / (np.linalg.norm(v) * np.linalg.norm(p)) for k, p in proto.items()}
        best = max(sorted(cos), key=cos.get)
        assert got[i].language.lang == best and got[i].language.score == pytest.approx(max(cos[best], 0), abs=1e-9)


def test_language_edge_cases(spark):
    from staffrank.llm.language_id import identify, train, with_language

    docs = spark.createDataFrame(EDGE, SCHEMA).repartition(3).withColumn("held_out", F.lit("own")).withColumn("v", F.lit(1))
    found = identify(docs).collect()
    assert len(found) == len(EDGE) and all(r.held_out == "own" for r in found)
    for r in found:
        if not r.text or not any(unicodedata.category(c)[0] == "L" for c in r.text):
            assert (r.language.lang, r.language.score) == ("und", 0.0)
        else:
            assert r.language.lang in ("en", "fr", "de", "xx")
    none = docs.limit(0)
    assert identify(none).count() == 0
    assert train(none) == {}
    assert {r.l.lang for r in with_language(docs, {}, "l").collect()} == {"und"}


# ------------------------------------------------------------------------------- hard negatives

def brute_negatives(rows, every=100, k=5):
    """rows (id, label, vector) -> sorted hard negatives; labels as they are."""
    one = {}
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            z = tuple(math.floor(256 * x) for x in v)
            one[i] = min(one.get(i, (label, z)), (label, z))
    out = []
    for a, (label, z) in one.items():
        if a % every:
            continue
        score = {i: sum(x * y for x, y in zip(z, w, strict=True)) for i, (_, w) in one.items() if len(w) == len(z)}
        near = sorted((-score[i], i) for i in score if one[i][0] == label and i != a)[:k]
        for s, p in near:
            fits = sorted((-score[i], i) for i in score if one[i][0] != label and -80 * s <= 100 * score[i] <= -100 * s)[:k]
            out += [(a, p, n + 1, i, -s, -t) for n, (t, i) in enumerate(fits)]
    return sorted(out)


def mined(spark, rows, **more):
    from staffrank.llm.hard_negatives import mine

    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").repartition(3)
    return sorted(map(tuple, mine(df.withColumn("z", F.lit("x")).withColumn("rank", F.lit(0)), **more).collect()))


def test_hard_negatives_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    v = rng.standard_normal((300, 24)).astype(np.float32)
    v[50:120] = v[7]  # a large group of copies
    v[130:160] = -v[3]
    v[200:205] = 0
    rows = [(i, int(rng.integers(4)), v[i].tolist()) for i in range(300)]
    want = brute_negatives(rows, every=20)
    assert len(want) > 100
    assert mined(spark, rows, every=20) == want
    assert mined(spark, rows, every=20, block=24 * 4) == want  # several blocks of anchors


def test_intervals_hold_every_score():
    import pandas as pd

    from staffrank.llm import hard_negatives as H

    rng = np.random.default_rng(2)
    for dim in (1, 5, 64, 130):
        z = rng.integers(-300, 300, (60, dim))
        z[:5] = z[5] * 3
        z[6] = 0
        code, aligned, length = H.encode(z)
        frame = pd.DataFrame({"vec_id": range(60), "label": 0, "z": [x.tobytes() for x in z], "length": length,
                              "codes": [x.tobytes() for x in code], "aligned": [x.tobytes() for x in aligned]})
        seen = []

        def all_of(low, high, col, seen=seen):
            seen.append((low.ravel(), high.ravel()))
            return np.ones(low.shape, bool)

        row, col, score = H.Anchors(np.arange(60), np.zeros(60), z).scored(H.Rows(frame, dim), np.ones((60, 60), bool), all_of)
        assert np.array_equal(score, (z @ z.T)[row, col])
        widths = [float((high - low).mean()) for low, high in seen]
        assert all((low <= score).all() and (score <= high).all() for low, high in seen)
        assert len(seen) == H.LEVELS and (dim < 64 or widths == sorted(widths, reverse=True))


def test_hard_negatives_edge_cases(spark):
    a, nan, inf = [1.0, 0.5], float("nan"), float("inf")
    rows = [(0, 1, a), (1, 1, [0.9, 0.4]), (2, 2, [0.8, 0.4]), (2, 2, [0.8, 0.4]), (3, 2, [0.85, 0.4]), (4, None, a), (None, 2, a),
            (5, 2, None), (6, 2, [1.0, None]), (7, 2, [nan, 1.0]), (8, 2, [inf, 0.0]), (9, 2, []), (10, 2, [1.0]), (11, 1, [-1.0, -1.0]),
            (100, 3, []), (101, 3, []), (102, 4, []), (200, 9, a)]
    want = brute_negatives(rows)
    assert mined(spark, rows) == want and any(r[0] == 100 for r in want) and any(r[0] == 0 for r in want)
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, a)]) == []


def test_hard_negative_query_on_the_given_table(spark):
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding)
            for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted(map(tuple, query(spark, "op12_hard_negatives").collect())) == brute_negatives(rows)


# ------------------------------------------------------------------------------- filter audit

def brute_audit(docs, labels):
    """docs (doc_id, text, source), labels (doc_id, quality, toxic) -> report rows."""
    import re

    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    parts = {}
    for i, text, source in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {c for c, f in zip("ABCDE", (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            re.search(r"[#$%&*|]", t), i is not None and i > least[t]), strict=True) if f}
        parts.setdefault(source or "", []).append((fails, i in good, i in toxic))
    out = []
    for part, rows in parts.items():
        share = {c: sum(120 // len(f) for f, _, _ in rows if c in f) for c in "ABCDE"}
        for order in permutations("ABCDE"):
            for step, c in enumerate(order):
                before = set(order[:step])
                here = [r for r in rows if c in r[0] and not r[0] & before]
                out.append(("".join(order), part, step + 1, sum(not r[0] & (before | {c}) for r in rows), len(here),
                            sum(c in r[0] and bool(r[0] & before) for r in rows), sum(r[0] == {c} for r in rows),
                            sum(r[1] for r in here), sum(r[2] for r in here), share[c]))
    return sorted(out)


def audited(spark, docs, labels, folder, files, rounds=3):
    """The report of documents written as one file for each list of rows, oldest first."""
    from staffrank.llm.filter_audit import audit

    path = f"{folder}/documents.parquet"
    for n, rows in enumerate(files(docs)):
        part = spark.createDataFrame(rows, "doc_id long, text string, source string, part string, n int").coalesce(1)
        part.write.mode("append").parquet(path)
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return sorted(map(tuple, audit(spark, path, told, rounds).select(
        "filter_order", "part", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley").collect()))


def test_filter_audit_takes_masks_back(spark, tmp_path):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choices(words[: rng.choice([30, 400])], k=rng.choice([5, 150, 250]))) + rng.choice(["", "#", " ABCDEFGHIJKLMNOP" * 9])
             for _ in range(12)]
    docs = [(i, rng.choice([*texts, texts[0], texts[0]]), rng.choice(["a", "b", "", None]), "x", 1) for i in range(120)]
    docs += [(3, texts[0], "b", "x", 1), (3, texts[0], "b", "x", 1), (None, texts[0], "a", "x", 1), (None, None, None, "x", 1),
             (121, None, "a", "x", 1), (122, "", "a", "x", 1)]
    rng.shuffle(docs)
    docs.sort(key=lambda r: -(r[0] or 0) // 20)  # smaller ids arrive later: earlier masks must be taken back
    labels = [(i, rng.randint(0, 1), rng.randint(0, 1)) for i in range(0, 130, 2)] + [(2, 1, 1), (2, 0, None), (None, 1, 1)]
    want = brute_audit([r[:3] for r in docs], labels)
    cut = lambda d: [d[i: i + 25] for i in range(0, len(d), 25)]
    assert audited(spark, docs, labels, tmp_path / "many", cut, rounds=6) == want
    assert audited(spark, docs, labels, tmp_path / "one", lambda d: [d], rounds=1) == want


def test_filter_audit_goes_on_with_new_files(spark, tmp_path):
    from staffrank.llm.filter_audit import count_masks, read_documents

    path, root = f"{tmp_path}/documents.parquet", f"file://{tmp_path}/state"
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    for rows in ([(7, "t", "s")], [(5, "t", "s"), (9, "t", "r")], [(1, "t", "q")]):
        spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1).write.mode("append").parquet(path)
        counts = {(r.part, r["mask"], r.good): r.n for r in count_masks(read_documents(spark, path), labels, root, 4).collect()}
    assert counts == {("s", 17, False): 2, ("r", 17, False): 1, ("q", 1, True): 1}


def test_filter_audit_of_an_empty_table(spark, tmp_path):
    assert audited(spark, [], [], tmp_path, lambda d: [d]) == []


def test_filter_masks_of_texts():
    from staffrank.llm.filter_audit import failed_by_text

    assert failed_by_text(b"") == 1
    assert failed_by_text(" ".join(f"w{i}" for i in range(200)).encode()) == 0
    assert failed_by_text(" ".join(f"w{i}" for i in range(199)).encode()) == 1
    assert failed_by_text(("x " * 200).encode()) == 2
    assert failed_by_text(" ".join(["a"] * 101 + [f"w{i}" for i in range(99)]).encode()) == 0  # 100 distinct of 200
    assert failed_by_text(("é" * 98 + "AB").encode()) == 1 and failed_by_text(("é" * 97 + "ABC").encode()) == 5
    assert failed_by_text("a b c|".encode()) == 9
