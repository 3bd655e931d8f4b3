"""Operators 11 to 13 against plain versions, held-out labels and odd input."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from terraproof.llm import classifier, spelling, whitening
from terraproof.llm.q11_classifier import op11_classifier
from terraproof.llm.q12_whitening import op12_whitening
from terraproof.llm.q13_spelling import op13_spelling

# --- 13: spelling variants


def plain_words(docs: list[tuple]) -> Counter:
    found = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            found[w] += 1
    return Counter({w: n for w, n in found.items() if len(w) >= 7 and n >= 2})


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_groups(words: Counter) -> set[tuple]:
    near = {w: [] for w in words}
    by_less: dict[str, set[str]] = {}
    for w in words:
        for k in range(len(w)):
            by_less.setdefault(w[:k] + w[k + 1 :], set()).add(w)
        by_less.setdefault(w, set()).add(w)
    for mine in by_less.values():
        for a in mine:
            near[a] += [b for b in mine if b != a and b not in near[a] and one_edit(a, b)]
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, n, len(near[w]), form[w], words.get(form[w]), root))
    return out


def spelled() -> list[tuple]:
    rng = random.Random(3)
    texts: list[tuple] = [(0, None), (1, ""), (2, "Ünïcödé ünïcödé STRASSE-strasse 12 ÿÿÿÿÿÿÿ ÿÿÿÿÿÿÿ ÿÿÿÿÿÿÿÿ ÿÿÿÿÿÿÿÿ"), (None, "nameless nameless namelesS")]
    base = ["".join(rng.choices("ab", k=rng.randrange(7, 11))) for _ in range(250)] + ["".join(rng.choices("xyzé", k=rng.randrange(7, 25))) for _ in range(60)]
    for w in base[::3]:  # variants of all kinds
        k = rng.randrange(len(w))
        base += [w[:k] + w[k + 1 :], w[:k] + rng.choice("abcz") + w[k:], w[:k] + rng.choice("abcz") + w[k + 1 :]]
    base += ["a" * 300 + "b" * 300, "a" * 299 + "b" * 300, "a" * 300 + "c" + "b" * 299]
    for i in range(10, 150):
        texts.append((i, " ".join(rng.choices(base, k=60))))
    # a chain of forms, each ten times as often as the one before
    texts += [(1000, "chainab " * 3), (1001, "chainabc " * 60), (1002, "chainabcd " * 700), (1003, "Chainabcde " * 8000), (1002, "chainabcd " * 20)]
    return texts


@pytest.mark.parametrize(("most_rows", "most_broadcast"), [(2, 100_000), (2, 0), (64, 100_000)])
def test_spelling_against_brute_force(spark, monkeypatch, most_rows, most_broadcast):
    monkeypatch.setattr(spelling, "MOST_BROADCAST", most_broadcast)
    docs = spelled()
    df = spark.createDataFrame([(t, i, "clash", 1) for i, t in docs], "text string, doc_id long, word string, n int")
    out = spelling.group_variants(df, "doc_id", "text", most_rows)
    got = out.collect()
    assert [f"{x.name} {x.dataType.simpleString()}" for x in out.schema] == ["word string", "n bigint", "n_near bigint", "form string", "form_n bigint", "root string"]
    assert len(got) == len(set(got)) and set(map(tuple, got)) == plain_groups(plain_words(docs))
    roots = {r["word"]: r["root"] for r in got}
    assert roots["chainab"] == roots["chainabc"] == "chainabcde"


def test_spelling_of_all_documents(spark, small):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert set(map(tuple, op13_spelling(spark, small).collect())) == plain_groups(plain_words(docs))


def test_each_pair_is_found_in_one_block(spark, tmp_path):
    """Blocks of one word's rows, down to windows of one character."""
    rng = random.Random(8)
    words = sorted({"".join(rng.choices("ab", k=rng.randrange(7, 10))) for _ in range(200)})
    df = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    rows = spelling.subdivided(df, 1, str(tmp_path)).collect()
    assert all(r["b"] - r["a"] >= 1 for r in rows) and min(r["b"] - r["a"] for r in rows) == 1
    near = spelling.near_words(df, 1, str(tmp_path / "again")).collect()
    want = {w: sum(one_edit(w, x) for x in words) for w in words}
    assert {r["word"]: r["n_near"] for r in near} == {w: n for w, n in want.items() if n}


def test_spelling_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.group_variants(empty, "doc_id", "text").count() == 0
    once = spark.createDataFrame([(1, "onlyonce"), (2, None)], "doc_id long, text string")
    assert spelling.group_variants(once, "doc_id", "text").count() == 0


# --- 12: whitening


def plain_whitening(rows: list[tuple]) -> tuple[dict, list, list]:
    xs = {}
    for i, v in rows:
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            xs.setdefault(i, []).append(tuple(math.floor(64 * c) + 1_000_000 for c in v))
    fit = sorted({x for many in xs.values() for x in many})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[float(Decimal(n * c - s) / n) for c, s in zip(x, sums, strict=True)] for x in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    deviation = {x: sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True)) for x in fit}
    return {i: [(x, deviation[x], np.array([float(Decimal(n * c - s) / n) for c, s in zip(x, sums, strict=True)])) for x in many] for i, many in xs.items()}, values[::-1], vectors[:, ::-1].T


@pytest.mark.parametrize("scale", [1.0, 3e4])
def test_whitening_against_plain(spark, scale):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((300, 20)) @ rng.standard_normal((20, 20)) * scale
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    rows += [(i + 1000, rows[i % 3][1]) for i in range(60)]  # copies, which count once
    rows += [(2000, None), (2001, [None, *rows[0][1][1:]]), (2002, [math.nan, *rows[0][1][1:]]), (2003, [math.inf, *rows[0][1][1:]]), (2004, [1.0] * 3), (2005, []), (None, rows[7][1])]
    df = spark.createDataFrame([(v, i, 0.5) for i, v in rows], "embedding array<double>, vec_id long, whitened double")
    got = whitening.whiten(df, "vec_id", "embedding").collect()
    rows = [r for r in rows if r[0] not in (2004, 2005)]
    plain, values, vectors = plain_whitening(rows)
    assert len(got) == 16 * sum(map(len, plain.values())) and {r["vec_id"] for r in got} == set(plain)
    signs = {}
    for r in got:
        (_, deviation, centred), k = plain[r["vec_id"]][0], r["component"] - 1
        assert r["n"] == 300 and int(r["deviation"]) == deviation
        assert abs(r["explained"] / (values[k] / values.sum()) - 1) < 1e-9 and r["identity_error"] < 1e-9
        want = centred @ vectors[k] / math.sqrt(values[k])
        assert abs(abs(r["whitened"]) - abs(want)) < 1e-6
        if abs(want) > 1e-3:
            assert signs.setdefault(k, np.sign(want * r["whitened"])) == np.sign(want * r["whitened"])


def test_whitening_query(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding").collect()]
    plain, values, vectors = plain_whitening(rows)
    got = op12_whitening(spark, small).collect()
    assert len(got) == 16 * sum(map(len, plain.values()))
    for r in got[::7]:
        (_, deviation, centred), k = plain[r["vec_id"]][0], r["component"] - 1
        assert r["deviation"] == deviation and abs(abs(r["whitened"]) - abs(centred @ vectors[k]) / math.sqrt(values[k])) < 1e-6


def test_whitening_of_little(spark):
    schema = "vec_id string, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema), "vec_id", "embedding").count() == 0
    assert whitening.whiten(spark.createDataFrame([("a", None), ("b", [])], schema), "vec_id", "embedding").count() == 0
    assert whitening.whiten(spark.createDataFrame([("a", [1.0, 2.0]), ("b", [1.0, 2.0])], schema), "vec_id", "embedding").count() == 0
    # two different vectors span one direction
    got = whitening.whiten(spark.createDataFrame([("a", [1.0, 2.0]), ("b", [3.0, 2.0]), ("b", [3.0, 2.0])], schema), "vec_id", "embedding").collect()
    assert [(r["component"], r["n"], abs(round(r["whitened"], 9)), round(r["explained"], 9)) for r in got] == [(1, 2, 1.0, 1.0)] * 3
    wide = spark.createDataFrame([("a", [0.0] * 9)], schema)
    with pytest.raises(Exception, match="the bound is 8"):
        whitening.whiten(wide, "vec_id", "embedding", most_dims=8)


def test_packing_is_lossless_and_canonical():
    rng = np.random.default_rng(2)
    for most in (100, 30_000, 2**30, 2**60):
        xs = rng.integers(-most, most, (50, 7))
        rows = whitening.packed(xs)
        assert rows == whitening.packed(xs[::-1])[::-1] and len(set(map(len, rows))) == 1
        assert np.array_equal(np.concatenate(list(whitening.unpacked(rows))), xs)
        assert whitening.whole_sums(xs) == [sum(map(int, c)) for c in xs.T]
    edge = np.array([[127, -128], [128, 0], [-129, 0], [32767, -32768], [2**31 - 1, -(2**31)], [2**31, 0]])
    assert [r[0] for r in whitening.packed(edge)] == [0, 1, 1, 1, 2, 3]
    assert np.array_equal(next(whitening.unpacked(whitening.packed(edge[:1]))), edge[:1])
    with pytest.raises(OverflowError):
        whitening.rounded(np.array([[1e30]]))
    assert whitening.usable(pa.array([[1.0, None], None, []])) [0][1].shape == (0, 2)


# --- 11: quality classifier


def test_chunks_cover_whole_texts():
    texts = [None, "", "a", "é" * 700, "x" * classifier.CHUNK, "y" * (classifier.CHUNK + 1), "z" * 50_000]
    chunks, sizes, owners = classifier.chunked(texts)
    for k, text in enumerate(texts):
        mine = [bytes(c[:n]) for c, n, o in zip(chunks, sizes, owners, strict=True) if o == k]
        joined = mine[0] + b"".join(m[classifier.OVERLAP :] for m in mine[1:]) if mine else b""
        assert joined == (text or "").encode()
    shares = classifier.weights_of(sizes, owners, len(texts))
    assert np.allclose(np.bincount(owners, shares, len(texts)), [0, 0, 1, 1, 1, 1, 1])


def test_gradients_against_differences():
    rng = np.random.default_rng(1)
    texts = ["".join(chr(int(c)) for c in rng.integers(32, 250, n)) for n in (5, 40, 700, 1500)]
    net = classifier.Network(0.5, {k: v.astype(np.float64) for k, v in classifier.Network.random(3).items()})
    chunks, sizes, owners = classifier.chunked(texts)
    labels, weights = np.array([0, 1, 1, 0]), np.array([1.0, 3.0, 1.0, 2.0])

    def loss() -> float:
        p = net.scores(texts)
        return float(-(weights * np.where(labels == 1, np.log(p), np.log(1 - p))).sum() / weights.sum())

    grads = classifier.gradients(net, chunks, sizes, owners, labels, weights)
    assert set(grads) == set(net.p)
    for name, value in net.p.items():
        at = np.unravel_index(int(np.abs(grads[name]).argmax()), value.shape)
        before = value[at]
        value[at] = before + 1e-5
        up = loss()
        value[at] = before - 1e-5
        down = loss()
        value[at] = before
        assert abs((up - down) / 2e-5 - grads[name][at]) < 1e-4 * max(1e-2, abs(grads[name][at])), name


def test_every_part_of_a_text_counts():
    net = classifier.train(["good words here. " * 30, "### $$$ %%% " * 40] * 8, np.array([1, 0] * 8), (1.0, 1.0), rounds=30, batch=4)
    clean = "good words here. " * 3000
    dirty = clean[:40_000] + "### $$$ %%% " * 400 + clean[40_000:]
    a, b, c, d = net.scores([clean, dirty, clean[:20], "### $$$"])
    assert a > 0.9 > 0.5 > d and c > 0.5 and b < a
    assert np.allclose(net.scores([clean, dirty]), net.scores([dirty, clean])[::-1], atol=1e-5)


def test_classifier_on_held_out_labels(spark):
    out = op11_classifier(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.join(labels, "doc_id").filter("held_out").collect()
    good, bad = ([r["score"] for r in rows if r["quality"] == y] for y in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.93
    assert np.mean([g >= 0.5 for g in good]) > 0.9
    everything = out.collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in everything)


def test_classifier_of_little(spark):
    docs = spark.createDataFrame([(1, "ein text", "x"), (2, None, "y"), (None, "", "z"), (1, "ein text", "x")], "doc_id long, text string, label string")
    schema = "doc_id long, quality int"
    always = F.lit(True)
    none = classifier.fit(docs, spark.createDataFrame([], schema), "doc_id", "text", "quality", always)
    one = classifier.fit(docs, spark.createDataFrame([(1, 1), (2, 1), (3, None), (4, 7)], schema), "doc_id", "text", "quality", always)
    missing = classifier.fit(docs, spark.createDataFrame([(1, 1), (9, 0)], schema), "doc_id", "text", "quality", always)
    assert (none.share, one.share, missing.share) == (0.5, 0.75, 0.5)
    both = classifier.fit(docs, spark.createDataFrame([(1, 1), (1, 0), (None, 1)], schema), "doc_id", "text", "quality", always, rounds=1)
    out = classifier.score(docs, "text", both)
    scores = {r["label"]: r["score"] for r in out.collect()}
    assert out.columns == ["doc_id", "label", "score"] and out.count() == 4 and scores["y"] == scores["z"] and all(0 <= x <= 1 for x in scores.values())
    assert classifier.score(docs.limit(0), "text", both).count() == 0
