"""Quality rules, tokenizers, packing, media, chat: against plain versions on small tables."""

from __future__ import annotations

import hashlib
import io
import random
import re
import struct
import wave
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from terraproof.llm import bpe, chat, html, media, packing, quality
from terraproof.llm.q04_bpe import tokenizer_file
from terraproof.llm.q07_media import UNIT

TEXTS = [None, "", " \n\t", "a b c a b c", "a b c a b", "a a a", "a a a a", "Über #1 | x\nder Text\nder Text\n \n", "wort " * 3000, "x" * 20_000, "don't  stop\n\nnow é中\u00a0!", "<|endoftext|> a", "and the of " * 30]


def docs(spark, texts=TEXTS):
    return spark.createDataFrame([(t, "clash", i, 1) for i, t in enumerate(texts)], "text string, kept string, doc_id long, n_words int")


def test_quality_figures(spark):
    got = {r["doc_id"]: r for r in quality.score_quality(docs(spark), "doc_id", "text").collect()}
    for i, t in enumerate(TEXTS):
        w = [x for x in __import__("re").split("[\x20\x09-\x0d]+", t or "") if x]
        tri = Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {p + k for p, x in enumerate(zip(w, w[1:], w[2:], strict=False)) if tri[x] > 1 for k in range(3)}
        lines = [x for x in (t or "").split("\n") if x.strip(" \t\x0b\x0c\r")]
        want = (len(w), sum(map(len, w)), sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want, t
        assert r["base_failed"] == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and not (r["kept"] and r["base_failed"])
    assert quality.score_quality(docs(spark).limit(0), "doc_id", "text").count() == 0


@pytest.mark.parametrize(
    ("inside", "want"),
    [
        ('<h2 id="search">Search</h2>', "Search"),
        ('<h2 id="notice">Notice of change</h2>', "Notice of change"),
        ('<section id="disclaimer"><p>What we do not promise is written here.</p></section>', "What we do not promise is written here."),
        ("<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> hold.</p>", "Let x=1 hold."),
        ("<figure><svg><title>icon</title><desc>a chart</desc><text>Sales by year</text></svg></figure>", "Sales by year"),
        ("<fieldset><legend>Note</legend>A box with text of the article in it.</fieldset>", "Note\nA box with text of the article in it."),
    ],
)
def test_html_keeps_text_of_the_article(inside, want):
    """Ids, formulas, drawings and boxes within an article are part of it; a sidebar named by its id is not."""
    before, after = "Some words of an article that goes on for a while, as articles do.", "And here it ends, after some more words that say nothing much."
    page = f'<html><body><div id="sidebar"><p>Links and other things here</p></div><article><p>{before}</p>{inside}<p>{after}</p></article><div id="footer">Imprint and so on</div></body></html>'
    assert html.main_text(page) == f"{before}\n{want}\n{after}"


def test_quality_filter_keeps_columns(spark):
    good = " ".join(f"the word{i} of thing{i}" for i in range(40))
    df = docs(spark, [good, good, None, "#### " * 80])
    kept = quality.keep_good(df, "text")
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [0, 1]


def test_bpe_matches_the_library(spark):
    path = tokenizer_file("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    for spread in (4_000_000, 1000):  # the second deals long texts out by leaves
        got = bpe.encode_texts(docs(spark), "doc_id", "text", path, leaf=64, margin=4, spread=spread, texts=True).collect()
        assert len(got) == len(TEXTS)
        for r in got:
            e = tok.encode(TEXTS[r["doc_id"]] or "", add_special_tokens=False)
            assert r["n_tokens"] == len(e.ids) and r["ids"] == " ".join(map(str, e.ids)) and r["decoded"] == tok.decode(e.ids, skip_special_tokens=False)
            assert r["ids_sha256"] == hashlib.sha256(r["ids"].encode()).hexdigest()
    assert bpe.encode_texts(docs(spark).limit(0), "doc_id", "text", path).count() == 0


def test_bpe_parts_of_a_text_are_encoded_apart(spark):
    """The parts are encoded before the shuffle that brings them together by text; copies share their parts."""
    path = tokenizer_file("word_bpe_49k.json")
    tok, rng = Tokenizer.from_file(path), random.Random(5)
    long = ["".join(rng.choice("etaoin srhlÜé'.\n") for _ in range(n)) for n in (999, 1000, 1001, 2500, 7001)] + ["x" * 5000, " " * 3000]
    df = docs(spark, [*long, long[4], long[4], None]).repartition(3)
    out = bpe.encode_texts(df, "doc_id", "text", path, leaf=64, margin=4, spread=1000)
    for r in out.collect():
        text = [*long, long[4], long[4], ""][r["doc_id"]]
        ids = tok.encode(text, add_special_tokens=False).ids
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest() and r["n_tokens"] == len(ids)
        assert r["decoded_sha256"] == hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    plan = out._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
    assert re.search(r"FlatMapGroupsInPandas.*?hashpartitioning\(_key#\d+, \d+\).*?MapInArrow encoded.*?hashpartitioning\(_key#\d+, _at#\d+, \d+\)", plan, re.S)


def test_bpe_joins_at_any_place():
    path = tokenizer_file("word_bpe_49k.json")
    tok, rng = Tokenizer.from_file(path), random.Random(1)
    tree = bpe.TreeEncoder(path, leaf=8, margin=2)
    letters = ["abcdeehstTÉéßñİ'  1.!\n\x1c \u0301\u00a0", "etaoinsrh", "abc's'tİé.,'"]
    for k in range(1500):
        s = "".join(rng.choice(letters[k % 3]) for _ in range(rng.randrange(0, 250)))
        e, p = tok.encode(s, add_special_tokens=False), tree.encode(s)
        assert bpe.ids_text(p) == " ".join(map(str, e.ids)), s
        assert bpe.decoded_text(p) == tok.decode(e.ids, skip_special_tokens=False), s


@pytest.mark.parametrize("letters", ["etaoinsrhldcu", "etaoinsrh0123456789", "étaoñ's.,中"])
def test_bpe_joins_take_the_tokens_of_both_sides_over(letters):
    """Long unsplit text: what is read again in the joins is a small part of it, and the ids are the library's."""
    path = tokenizer_file("word_bpe_49k.json")
    tok, rng, tree = Tokenizer.from_file(path), random.Random(2), bpe.TreeEncoder(path)
    text = "".join(rng.choices(letters, k=131_072))
    pieces = [tree.encode(text[at : at + 16_384]) for at in range(0, len(text), 16_384)]
    tree.read = 0
    piece = tree.join_all(pieces)
    assert 0 < tree.read < 0.05 * len(text)
    assert bpe.ids_text(piece) == " ".join(map(str, tok.encode(text, add_special_tokens=False).ids))


def test_packing(spark):
    path = tokenizer_file("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    got = packing.pack_documents(docs(spark), "doc_id", "text", path, capacity=256, group_size=5).toPandas()
    for i, g in got.groupby("doc_id"):
        ids = np.array([*tok.encode(TEXTS[i] or "", add_special_tokens=False).ids, 0], "<u4")
        g, at = g.sort_values("start"), 0
        for r in g.itertuples():
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    assert got["doc_id"].nunique() == len(TEXTS)
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert list(g["offset"]) == [0, *g["length"].cumsum()[:-1]] and g["length"].sum() <= 256
    same = packing.pack_documents(docs(spark, ["a b c"] * 50), "doc_id", "text", path).toPandas()
    assert len(same) == 50 and same["sequence_id"].nunique() == 1
    # equal rows without an id part into groups
    equal = spark.createDataFrame([(None, "", "clash")] * 3000, "doc_id long, text string, sequence_id string")
    groups = packing.pack_documents(equal, "doc_id", "text", path, group_size=300).selectExpr("shiftright(sequence_id, 32) AS g").groupBy("g").count().toPandas()
    assert groups["count"].sum() == 3000 and len(groups) == 10 and groups["count"].max() < 600
    assert packing.pack_documents(docs(spark).limit(0), "doc_id", "text", path).count() == 0


def test_packing_fill(spark, small):
    path = tokenizer_file("byte_bpe_50k.json")
    got = packing.pack_documents(spark.read.parquet(f"{small}/documents.parquet"), "doc_id", "text", path).toPandas()
    full = got[got["length"] == 1024]
    assert len(full) and full["sequence_id"].is_unique and (full["offset"] == 0).all() and (full["sequence_id"] >= packing.FULL).all()
    assert got["length"].sum() / (1024 * got["sequence_id"].nunique()) > 0.98


def test_first_fit_decreasing():
    rng = random.Random(2)
    lengths = sorted((rng.randrange(1, 101) for _ in range(500)), reverse=True)
    free, want = [], []
    for n in lengths:
        k = next((i for i, f in enumerate(free) if f >= n), len(free))
        free += [100] * (k == len(free))
        want.append((k, 100 - free[k]))
        free[k] -= n
    assert packing.pack(lengths, 100) == want


def png(w=2, h=2):
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"\0\0\0" * h)) + chunk(b"IEND", b"")


SAMPLES = {
    "image/png": png(), "audio/wav": media.to_wav(b"ab" * 50), "application/gzip": __import__("gzip").compress(b"x" * 99),
    "image/gif": b"GIF89a\x01\0\x01\0\x80\0\0\0\0\0\xff\xff\xff,\0\0\0\0\x01\0\x01\0\0\x02\x02D\x01\0;",
    "image/bmp": struct.pack("<2sIIIIiiHHIIiiII", b"BM", 58, 0, 54, 40, 1, 1, 1, 24, 0, 4, 0, 0, 0, 0) + b"\1\2\3\0",
    "application/pdf": b"%PDF-1.4\n1 0 obj\nstartxref\n9\n%%EOF", "image/jpeg": b"\xff\xd8\xff\xe0\0\4ab\xff\xda\0\2xy\xff\0z\xff\xd9",
}


def test_sniffing(spark):
    import zipfile

    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("a.txt", "hello")
    samples = SAMPLES | {"application/zip": z.getvalue()}
    rows = [(i, bytearray(b), "image/png", "clash") for i, b in enumerate(samples.values())]
    rows += [(100, bytearray(b"BM is no bitmap, GIF89a neither" + samples["image/png"] + b"tail" + samples["audio/wav"]), None, ""), (101, None, None, ""), (102, bytearray(b""), "text/plain", ""), (103, bytearray(samples["image/png"][:-3]), "image/png", "")]
    got = {r["id"]: r for r in media.sniff_media(spark.createDataFrame(rows, "id long, content binary, declared string, type string"), "id", "content", "declared", carve=True).collect()}
    for i, (kind, b) in enumerate(samples.items()):
        assert (got[i]["type"], got[i]["length"], got[i]["declared_ok"]) == (kind, len(b), kind == "image/png"), kind
    assert [(e["type"], e["length"]) for e in got[100]["embedded"]] == [("image/png", len(samples["image/png"])), ("audio/wav", len(samples["audio/wav"]))]
    assert [bytes(b) for b in got[100]["carved"]] == [samples["image/png"], samples["audio/wav"]] and got[100]["declared_ok"] is None
    assert all((got[i]["type"], got[i]["length"]) == (media.UNKNOWN, 0) for i in (101, 102)) and got[103]["type"] == media.UNKNOWN


def test_media_round_trip(spark, tmp_path):
    from terraproof.llm.q07_media import op7_media

    texts = [None, "", "a" * 576, "b" * 577, "é" * 400, "BM GIF89a %PDF-1"]
    texts += [texts[2], "é中" * 40_000]
    rows = spark.createDataFrame([(t, i, "clash") for i, t in enumerate(texts)] + [(texts[3], 3, "again")], "text string, doc_id long, feature string")
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    rows.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    got = op7_media(spark, str(tmp_path)).collect()
    assert len(got) == len(texts) + 1 and op7_media(spark, str(tmp_path / "none")).count() == 0
    for r in got:
        b = (texts[r["doc_id"]] or "").encode()
        p = b + b"\xff" * (max(UNIT, -(-len(b) // UNIT) * UNIT) - len(b))
        with io.BytesIO() as stored:
            with wave.open(stored, "wb") as w:  # the standard library's writer and reader
                w.setnchannels(1)
                w.setsampwidth(1)
                w.setframerate(8000)
                w.writeframes(p)
            form = stored.getvalue()
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]))
        assert (r["media_bytes"], r["media_sha256"]) == (len(form), hashlib.sha256(form).hexdigest())
        assert r["feature"] == f"audio/wav;declared_ok=false;length={len(form)};channels=1;rate=8000;bits=8;frames={len(p)};embedded="


def test_sniffing_takes_linear_time():
    import time

    automaton = media.build_automaton()
    for magic in (b"%PDF-1", b"PK\x03\x04", b"%PDF-1 %%EOF "):
        began = time.perf_counter()
        assert media.sniff(magic * 200_000, automaton)[0] == media.UNKNOWN
        assert time.perf_counter() - began < 5


def rotate(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, block string")
    return chat.rotate_dialogues(df, **kw)


def test_chat(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 3, "ann", "ünd"), (2, 0, "system", "alone"), (None, None, None, "lost"), (1, 3, "ann", "ünd")]
    got = {(r["conv_id"], r["perspective"]): r for r in rotate(spark, rows, block_turns=64).collect()}
    assert set(got) == {(1, "ann"), (1, "bob"), (None, "unknown")}
    r = got[1, "ann"]
    assert r["text"].startswith("<|start|>system<|message|>be kind<|end|>\n<|start|>assistant<|message|>hi<|end|>\n<|start|>user name=bob<|message|><|end|>\n") and r["n_turns"] == 5
    spans = [tuple(map(int, s.split("+"))) for s in r["mask"].split(",")]
    assert [r["text"][a : a + n] for a, n in spans] == ["hi", "ünd", "ünd"] and r["n_masked"] == 8
    assert got[None, "unknown"]["mask"] == "29+4"
    assert rotate(spark, []).count() == 0


@pytest.mark.parametrize("copies", [63, 64, 65, 300])
def test_chat_has_one_form_at_every_size(spark, copies):
    """A turn number of so many rows, equal and different ones, before and behind other turns."""
    rng = random.Random(copies)
    rows = [(1, t, rng.choice("abc"), f"t{t}") for t in range(70)] + [(1, 9, "a", f"x{i % 3}" if i % 2 else f"y{i}") for i in range(copies)]
    rows += [(2, None, "b", "same")] * copies + [(2, 1, "c", "end")]
    turns = {c: sorted((-1 if t is None else t, who, said) for conv, t, who, said in rows if conv == c) for c in (1, 2)}
    got = {(r["conv_id"], r["perspective"], r["block"]): r for r in rotate(spark, rows, block_turns=64).collect()}
    want = {(c, p, b) for c, ts in turns.items() for p in {w for _, w, _ in ts} for b in range(-(-len(ts) // 64))}
    assert set(got) == want
    for (c, p, b), r in got.items():
        part = turns[c][64 * b : 64 * (b + 1)]
        assert r["n_turns"] == len(part)
        assert r["text"] == "".join(f"<|start|>{'assistant' if w == p else 'user name=' + w}<|message|>{said}<|end|>\n" for _, w, said in part)
        spans = [tuple(map(int, s.split("+"))) for s in r["mask"].split(",") if s]
        assert [r["text"][a : a + n] for a, n in spans] == [said for _, w, said in part if w == p]


@pytest.mark.parametrize("name", ["op2_quality", "op8_chat"])
def test_sql(spark, small, name):
    import duckdb

    from terraproof.llm.queries import ORACLES, QUERIES

    c = duckdb.connect()
    for t in ("documents", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small}/{t}.parquet')")
    got, want = QUERIES[name](spark, small).toPandas(), c.sql(ORACLES[name]).df()
    key = lambda d: sorted(map(repr, d[sorted(d.columns)].itertuples(index=False, name=None)))
    assert sorted(got.columns) == sorted(want.columns) and key(got) == key(want)
