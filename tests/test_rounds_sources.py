"""Discovery, download and cached JSON in rounds, with local openers and pages."""

from __future__ import annotations

import hashlib
import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from terraproof.operators import attachments, discovery, hydrate
from terraproof.operators.hydrate import Response, Unreachable
from terraproof.sources import catalog
from terraproof.sources.http_json import Request, Rules, acquire_json, cache_table

HOST = "https://portal.example"


def link(path: str, text: str = "View documents") -> str:
    return f'<a href="{path}">{text}</a>'


def image(n: int, title: str = "Proposed site plan") -> str:
    return f'<table><tr><td><a href="/x/AttachmentShowServlet?ImageName={n}">{title}</a></td></tr></table>'


# --- discovery


def discover(spark, pages: dict, apps: list, rounds: int = 1):
    visited, found = discovery.discover(spark.createDataFrame(apps, "application string, url string"), spark.createDataFrame(list(pages.items()), "url string, html string"), rounds)
    return {(r["application"], r["url"].removeprefix(HOST)): (r["round"], r["via"], r["fetched"]) for r in visited.collect()}, sorted((r["application"], r["image"], r["page"].removeprefix(HOST)) for r in found.collect())


def test_a_page_with_attachments_is_not_followed(spark):
    pages = {HOST + "/a": image(1) + link("/b"), HOST + "/b": image(2), HOST + "/c": link("/b") + link("http://portal.example/b") + link("/missing") + link("https://elsewhere.example/documents") + link("/news", "News")}
    visited, found = discover(spark, pages, [("A", HOST + "/a"), ("C", "http://portal.example/c"), ("N", None), (None, HOST + "/a"), ("X", HOST + "/nowhere")])
    assert visited == {("A", "/a"): (0, 0, True), ("C", "/c"): (0, 0, True), ("C", "/b"): (1, 1, True), ("C", "/missing"): (1, 2, False), ("X", "/nowhere"): (0, 0, False)}
    assert found == [("A", "1", "/a"), ("C", "2", "/b")]


def test_four_of_eight_links_are_followed_and_cycles_end(spark):
    pages = {HOST + "/a": "".join(link(f"/p{k}") for k in range(10)), **{HOST + f"/p{k}": link("/a") + link(f"/p{(k + 1) % 10}") + (image(9) if k == 5 else "") for k in range(10)}}
    visited, found = discover(spark, pages, [("A", HOST + "/a")], rounds=1)
    assert sorted(p for _, p in visited) == ["/a", "/p0", "/p1", "/p2", "/p3"] and found == []
    visited, found = discover(spark, pages, [("A", HOST + "/a")], rounds=12)
    assert visited["A", "/p5"] == (3, 2, True) and ("A", "/p6") not in visited and found == [("A", "9", "/p5")]


def test_a_page_that_all_applications_lead_to(spark):
    pages = {HOST + "/hub": image(7), **{f"{HOST}/app{k}": link("/hub") for k in range(200)}}
    visited, found = discover(spark, pages, [(f"A{k}", f"{HOST}/app{k}") for k in range(200)])
    assert len(visited) == 400 and len(found) == 200 and {p for *_, p in found} == {"/hub"}


def test_the_best_rank_of_an_image_wins_and_ties_are_settled(spark):
    pages = {HOST + "/a": link("/p") + link("/q"), HOST + "/p": image(1, "Decision notice") + image(2), HOST + "/q": image(1) + image(2)}
    _, found = discover(spark, pages, [("A", HOST + "/a")])
    assert found == [("A", "1", "/q"), ("A", "2", "/p")]
    nothing = discover(spark, {HOST + "/a": None}, [("A", HOST + "/a")])
    assert nothing == ({("A", "/a"): (0, 0, True)}, [])


def test_union_of_attachments_does_not_depend_on_the_order_of_rows(spark):
    rows = [("A", "1", 5, "t2"), ("A", "1", 5, "t1"), ("A", "2", 1, "x")]
    for given in (rows, rows[::-1]):
        first = spark.createDataFrame(given, "application string, image string, priority int, title string")
        later = spark.createDataFrame([("A", "1", 5, "t0"), ("A", "2", 3, "y")], first.schema)
        got = attachments.in_order(attachments.union_attachments(first, later), "application").collect()
        assert [(r["image"], r["title"]) for r in got] == [("1", "t1"), ("2", "y")]


# --- download


BODY = b"%PDF-1.7 a drawing"
SHA = hashlib.sha256(BODY).hexdigest()
ENTRY = "file string, url string, transport_url string, tls_verification string, bytes long, sha256 string"


def entry(name: str, transport: str | None = None, legacy: bool = False, n: int = len(BODY), sha: str = SHA, url: str | None = "") -> tuple:
    return (name, f"{HOST}/{name}" if url == "" else url, transport, hydrate.LEGACY if legacy else None, n, sha)


def run(spark, tmp_path, rows: list, answers: dict, **options):
    """Answers by address: a list of what its attempts get, the last one again and again. Attempts are files in a folder."""
    log = str(tmp_path)

    def opener(address: str) -> Response:
        said = answers.get(address, [404])
        name = hashlib.sha256(address.encode()).hexdigest()[:16]
        seen = len([x for x in os.listdir(log) if x.startswith(name)])
        Path(log, f"{name}-{seen}").write_text(address)
        now = said[min(seen, len(said) - 1)]
        if isinstance(now, str):
            raise Unreachable(now)
        if isinstance(now, int):
            return Response(now, {}, None, address)
        return now

    results, contents = hydrate.hydrate(spark.createDataFrame(rows, ENTRY), hydrate.over(opener), **options)
    return {r["file"]: (r["status"], r["attempts"], r["retries_used"], r["code"]) for r in results.collect()}, {r["file"]: bytes(r["content"]) for r in contents.collect()}, len(os.listdir(log))


def ok(address: str, body: bytes = BODY, **headers: str) -> Response:
    return Response(200, {k.replace("_", "-"): v for k, v in headers.items()}, [body[:5], body[5:]], address)


def test_addresses_rotate_until_one_answers(spark, tmp_path):
    a, mirror = f"{HOST}/f", "https://mirror.example/f"
    got, contents, tries = run(spark, tmp_path, [entry("f", mirror)], {a: [503, "ETIMEDOUT", ok(a)], mirror: [429, 500]})
    # round 0: own, mirror; round 1: mirror, own; round 2: own
    assert got == {"f": ("downloaded", 5, 2, None)} and contents == {"f": BODY} and tries == 5


def test_what_is_broken_is_never_tried_again(spark, tmp_path):
    rows = [entry(x) for x in ("short", "long", "other", "declared", "gone", "moved", "unknown")]
    answers = {
        f"{HOST}/short": [ok("", b"x")], f"{HOST}/long": [ok("", BODY + b"!")], f"{HOST}/other": [ok("", BODY[::-1])], f"{HOST}/declared": [ok("", content_length="999")], f"{HOST}/gone": [404],
        f"{HOST}/moved": [Response(200, {}, [BODY], "http://portal.example/moved")], f"{HOST}/unknown": ["ENOTFOUND"],
    }
    for x in ("short", "long", "other", "declared"):
        answers[f"{HOST}/{x}"][0].url = f"{HOST}/{x}"
    got, contents, tries = run(spark, tmp_path, rows, answers, retries=4)
    assert {k: v[3] for k, v in got.items()} == {"short": "DOWNLOAD_BYTES_MISMATCH", "long": "DOWNLOAD_EXCEEDS_MANIFEST", "other": "DOWNLOAD_SHA256_MISMATCH", "declared": "CONTENT_LENGTH_EXCEEDS_MANIFEST", "gone": "HTTP_404", "moved": "UNSAFE_REDIRECT", "unknown": "ENOTFOUND"}
    assert {v[:3] for v in got.values()} == {("failed", 1, 0)} and tries == 7 and contents == {}


def test_a_body_that_breaks_off_and_retries_that_run_out(spark, tmp_path):
    def body():
        yield BODY[:4]
        raise ConnectionResetError("broke off")

    class Broken:
        def __iter__(self):
            return body()

    a = f"{HOST}/f"
    got, contents, tries = run(spark, tmp_path, [entry("f"), entry("g")], {a: [Response(200, {}, Broken(), a), ok(a)], f"{HOST}/g": [500]}, retries=2)
    assert got == {"f": ("downloaded", 2, 1, None), "g": ("failed", 3, 2, "HTTP_500")} and contents == {"f": BODY}


def test_legacy_transport_only_where_it_is_declared_and_allowed(spark, tmp_path):
    http, mine = "http://portal.example/f", f"{HOST}/f"
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    answers = {http: [ok(http)], mine: [404]}
    assert run(spark, tmp_path / "a", [entry("f", http, legacy=True)], answers, allow_legacy=True)[0] == {"f": ("downloaded", 1, 0, None)}
    assert run(spark, tmp_path / "b", [entry("f", http, legacy=True)], answers)[0] == {"f": ("failed", 1, 0, "HTTP_404")}


def test_reused_files_and_wrong_entries(spark, tmp_path):
    rows = [entry("have"), entry("stale"), entry("plain", url="http://portal.example/x"), entry("none", url=None), entry("empty", n=0), entry("hash", sha="zz")]
    files = spark.createDataFrame([("have", BODY), ("stale", b"old")], "file string, content binary")
    got, _, tries = run(spark, tmp_path, rows, {f"{HOST}/stale": [ok(f"{HOST}/stale")]}, files=files)
    assert got == {"have": ("reused", 0, 0, None), "stale": ("downloaded", 1, 0, None), "plain": ("failed", 0, 0, "URL_NOT_HTTPS"), "none": ("failed", 0, 0, "URL_NOT_HTTPS"), "empty": ("failed", 0, 0, "INVALID_BYTES"), "hash": ("failed", 0, 0, "INVALID_SHA256")}
    assert tries == 1 and hydrate.hydrate(spark.createDataFrame([], ENTRY), hydrate.over(lambda a: None))[0].count() == 0


# --- JSON sources


def asked(spark, tmp_path, requests, answers: dict, now: int, **rules):
    """(rows by source, the calls made) of one acquisition over the cache in ``tmp_path``."""
    log = tmp_path / f"log-{now}"
    log.mkdir()
    where = str(log)

    def opener(url, method, headers, body, timeout):
        Path(where, f"{len(os.listdir(where)):03d}-{os.getpid()}").write_text(json.dumps([url, method, headers, body]))
        said = answers[url]
        if isinstance(said, Exception):
            raise said
        return said

    rows = acquire_json(spark, requests, str(tmp_path / "cache"), Rules(now, **rules), opener).collect()
    return {r["source"]: r for r in rows}, [json.loads(p.read_text()) for p in sorted(log.iterdir())]


def test_the_modes_of_the_cache(spark, tmp_path):
    url, ask = f"{HOST}/data", Request("osm", (f"{HOST}/data",), headers=(("Accept", "application/json"),))
    fine = Response(200, {"etag": "e1", "last-modified": "yesterday"}, [b'{"x":', b" 1}"], url)
    got, calls = asked(spark, tmp_path, [ask], {url: fine}, 1000, fresh_ms=100)
    first = got["osm"]
    assert (first["status"], first["mode"], first["payload"], first["bytes"], first["attempt"]) == ("usable", "miss", '{"x": 1}', 8, 1) and len(calls) == 1
    got, calls = asked(spark, tmp_path, [ask], {}, 1100, fresh_ms=100)
    assert (got["osm"]["mode"], got["osm"]["payload"], got["osm"]["fetched_at"]) == ("fresh", '{"x": 1}', 1000) and calls == []
    got, calls = asked(spark, tmp_path, [ask], {url: Response(304)}, 1200, fresh_ms=100)
    assert (got["osm"]["mode"], got["osm"]["payload"], got["osm"]["fetched_at"]) == ("revalidated", '{"x": 1}', 1200)
    assert calls[0][2] == {"accept": "application/json", "if-none-match": "e1", "if-modified-since": "yesterday"}
    assert asked(spark, tmp_path, [ask], {}, 1300, fresh_ms=100)[0]["osm"]["mode"] == "fresh"
    got, _ = asked(spark, tmp_path, [ask], {url: Response(200, {}, [b"[2]"], url)}, 1400, fresh_ms=100)
    assert (got["osm"]["mode"], got["osm"]["payload"], got["osm"]["etag"]) == ("refreshed", "[2]", None)
    got, _ = asked(spark, tmp_path, [ask], {url: Response(500)}, 1600, fresh_ms=100, stale_ms=500)
    assert (got["osm"]["mode"], got["osm"]["payload"]) == ("stale-if-error", "[2]") and "HTTP 500" in got["osm"]["error"]
    got, _ = asked(spark, tmp_path, [ask], {url: Response(500)}, 2600, fresh_ms=100, stale_ms=500)
    assert (got["osm"]["status"], got["osm"]["payload"]) == ("unavailable", None)
    assert cache_table(spark, str(tmp_path / "cache")).count() == 3


def test_a_source_that_fails_in_mid_read_is_an_unavailable_row(spark, tmp_path):
    def breaks():
        yield b'{"half":'
        raise ConnectionResetError("gone")

    class Broken:
        def __iter__(self):
            return breaks()

    a, b, c = f"{HOST}/a", f"{HOST}/b", f"{HOST}/c"
    requests = [Request("broken", (a,)), Request("large", (b,)), Request("over", (a, c)), Request("text", (c + "/t",))]
    answers = {a: Response(200, {}, Broken(), a), b: Response(200, {}, [b"1" * 2000], b), c: Response(200, {}, [b"3"], c), c + "/t": Response(200, {}, [b"<html>"], c)}
    got, _ = asked(spark, tmp_path, requests, answers, 5, max_bytes=1024)
    assert {k: r["status"] for k, r in got.items()} == {"broken": "unavailable", "large": "unavailable", "over": "usable", "text": "unavailable"}
    assert "gone" in got["broken"]["error"] and "ceiling" in got["large"]["error"] and got["over"]["payload"] == "3"
    assert (got["over"]["attempt"], got["over"]["attempted"], got["over"]["endpoint"]) == (2, [a, c], c)
    with pytest.raises(Exception, match="failed across 1 addresses"):
        asked(spark, tmp_path, requests[:1], answers, 6, fail_open=False)


def test_requests_have_canonical_keys():
    base = Request("osm", (HOST,), "post", (("B", "2"), ("a", "1")), "x")
    assert base.key(HOST) == Request("osm", (HOST,), "POST", (("A", "1"), ("b", "2")), "x").key(HOST)
    assert base.key(HOST) != base.key(HOST + "/") and base.key(HOST).startswith("http-json-osm-")
    with pytest.raises(ValueError, match="HTTPS"):
        Request("osm", ("http://portal.example",))


def test_a_reader_that_fails_while_it_runs(spark):
    good = lambda: spark.createDataFrame([(1,), (2,)], "x int")
    bad = lambda: spark.range(100).select(F.when(F.col("id") > 50, F.raise_error(F.lit("in the middle"))).otherwise(F.col("id")).cast("int").alias("x"))
    got = catalog.acquire(spark, {"good": good, "bad": bad}).collect()
    assert sorted((r["source"], r["status"]) for r in got) == [("bad", "unavailable"), ("good", "ready"), ("good", "ready")]
    assert "in the middle" in next(r["error"] for r in got if r["source"] == "bad")
    with pytest.raises(Exception, match="in the middle"):
        catalog.acquire(spark, {"good": good, "bad": bad}, fail_open=["good"])
    with pytest.raises(ValueError, match="named by"):
        catalog.acquire(spark, {"../x": good})
