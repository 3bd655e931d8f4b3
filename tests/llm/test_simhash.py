from __future__ import annotations

import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from terraproof.llm import simhash
from terraproof.llm.components import connected_components

WORDS = "der die und in den von zu das mit sich auf ist im dem nicht ein eine als auch es".split()


def brute_print(text: str | None) -> int:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall("[^\x20\x09-\x0d]+", lowered)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 3 else [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints: dict, threshold: int = 2) -> dict:
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= threshold:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def corpus() -> dict[int, str | None]:
    rng = random.Random(4)
    docs: dict[int, str | None] = {i: " ".join(rng.choices(WORDS, k=rng.randrange(1, 60))) for i in range(60)}
    for i in range(60, 120):  # copies with one word more, less or other
        w = (docs[i - 60] or "x").split()
        w[rng.randrange(len(w))] = rng.choice(WORDS)
        docs[i] = " ".join(w)
    return docs | {200: None, 201: "", 202: " \n\x0b ", 203: "Ä ß", 204: docs[0].upper(), 205: docs[0], 206: "wort " * 30_000, 207: "a\u00a0b c"}


def test_against_brute_force(spark):
    docs = corpus()
    df = spark.createDataFrame([(t, i, "clash") for i, t in docs.items()], "text string, doc_id long, fp string")
    got = {r["doc_id"]: r for r in simhash.label_near_duplicates(df, "doc_id", "text").collect()}
    prints = {i: brute_print(t) for i, t in docs.items()}
    assert {i: int(r["fingerprint"], 16) for i, r in got.items()} == prints
    assert {i: r["component_id"] for i, r in got.items()} == brute_components(prints)


def test_links_are_complete_for_every_code(spark):
    rng = np.random.default_rng(1)
    points = {0, -1, (1 << 63) - 1, -(1 << 63)}
    for base in rng.integers(-(2**63), 2**63 - 1, 25):
        for _ in range(16):
            x = int(base)
            for k in rng.choice(64, rng.integers(0, 6), replace=False):
                x ^= (1 << int(k)) if k < 63 else -(1 << 63)
            points.add(x)
    points = sorted(points)
    df = spark.createDataFrame([(x, x) for x in points], "fp long, component long")
    apart = {(a, b): ((a ^ b) & (2**64 - 1)).bit_count() for i, a in enumerate(points) for b in points[i + 1 :]}
    for blocks, threshold in ((2, 0), (2, 1), (2, 2), (4, 2), (2, 4)):
        got = {tuple(r) for r in simhash.near_links(df, threshold, blocks).collect()}
        assert got == {p for p, d in apart.items() if d <= threshold}, (blocks, threshold)


def test_two_rounds_reach_the_threshold(spark):
    """The second round links what the first left apart, and nothing within a component."""
    rng = random.Random(9)
    docs = {i: " ".join(rng.choices(WORDS, k=40)) for i in range(40)}
    docs |= {100 + i: " ".join([*docs[i % 40].split()[:-1], rng.choice(WORDS)]) for i in range(160)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in simhash.label_near_duplicates(df, "doc_id", "text", threshold=4).collect()}
    assert got == brute_components({i: brute_print(t) for i, t in docs.items()}, 4)
    prints = spark.createDataFrame([(x, 7) for x in range(64)], "fp long, component long")
    assert simhash.near_links(prints, 2).count() == 0


def test_codes_are_perfect():
    for _, code in simhash.blocks_of(4):
        assert (code.counts[0] == 1).all()


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 400, 2)] + [(i, i + 1) for i in range(1, 200, 2)] + [(1000, 1001), (1001, 1000), (7, 7)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(200)) and got[1001] == 1000 and got[399] == 398
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_one(spark):
    docs = corpus()
    rows = [(i, t, "x") for i, t in docs.items()] + [(0, docs[0], "x"), (None, "ganz allein hier", "x"), (None, "ganz allein hier", "y"), (None, docs[5], "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _n string")
    kept = simhash.keep_one(df, "doc_id", "text")
    ids = [r["doc_id"] for r in kept.collect()]
    named = [i for i in ids if i is not None]
    assert kept.columns == df.columns and sorted(named) == sorted(set(brute_components({i: brute_print(t) for i, t in docs.items()}).values()))
    assert ids.count(None) == 1
    assert simhash.keep_one(df.limit(0), "doc_id", "text").count() == 0 and simhash.label_near_duplicates(df.limit(0), "doc_id", "text").count() == 0


def test_keep_one_where_ids_repeat(spark):
    """A row that shares its id with another, but no text, is no copy; a copy does not stay for its id."""
    a, b = "ein langer text von vielen worten ganz ohne sinn", "etwas anderes steht hier und noch viel mehr davon"
    schema = "doc_id long, text string"
    kept = lambda rows: sorted(map(tuple, simhash.keep_one(spark.createDataFrame(rows, schema), "doc_id", "text").collect()), key=repr)
    assert kept([(3, a), (5, a), (5, b)]) == [(3, a), (5, b)]
    assert kept([(5, a), (5, b), (5, b), (5, a)]) == [(5, b), (5, a)] or kept([(5, a), (5, b), (5, b), (5, a)]) == [(5, a), (5, b)]
    assert kept([(5, None), (4, ""), (4, b), (None, b), (None, a)]) == sorted([(4, ""), (4, b), (None, a)], key=repr)
    # a component of null ids only, of two fingerprints
    w = [f"wort{k}" for k in range(400)]
    near = " ".join(w), " ".join([*w[:-1], "anders"])
    prints = simhash.fingerprints(list(near))
    assert prints[0] != prints[1] and int(prints[0] ^ prints[1]).bit_count() <= 2
    assert len(kept([(None, near[0]), (None, near[1]), (None, a)])) == 2


def test_hex(spark):
    got = spark.createDataFrame([(-1,), (0,), (255,)], "v long").select(simhash.fingerprint_hex(F.col("v"))).collect()
    assert [r[0] for r in got] == ["f" * 16, "0" * 16, "0" * 14 + "ff"]
