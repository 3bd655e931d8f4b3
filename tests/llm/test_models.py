"""Language identification, suffix tree, url templates, page text and the pipeline."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from terraproof.llm import html, language, quality, suffix_tree, urls
from terraproof.llm.common import id_crc32
from terraproof.llm.q06_urls import RULES


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(0)
    k, lengths = 3, np.array([4, 1, 3])
    emit, trans, first = rng.random((8, k)) + 0.1, rng.random((k, k)) + 0.1, rng.random(k) + 0.1
    marginal, pairs, heads, log_z = language.Lattice(lengths).run(emit, trans, first, True)
    at, total, want_pairs = 0, 0.0, np.zeros((k, k))
    for n in lengths:
        weights = {}
        for path in np.ndindex(*(k,) * n):
            w = first[path[0]] * np.prod([emit[at + i, y] for i, y in enumerate(path)]) * np.prod([trans[a, b] for a, b in zip(path, path[1:], strict=False)])
            weights[path] = w
        z = sum(weights.values())
        total += math.log(z)
        for path, w in weights.items():
            for a, b in zip(path, path[1:], strict=False):
                want_pairs[a, b] += w / z
        for i in range(n):
            for y in range(k):
                assert abs(marginal[at + i, y] - sum(w for p, w in weights.items() if p[i] == y) / z) < 1e-9
        at += n
    assert abs(total - log_z) < 1e-9 and np.allclose(pairs, want_pairs) and abs(heads.sum() - 3) < 1e-9


def test_language_held_out(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    held = id_crc32("doc_id") % 3 == 1
    crf = language.fit(docs, "doc_id", "text", "lang", ~held)
    rows = docs.filter(held).select("text", "lang").collect()
    found = language.Tagger(crf).predict([r["text"] for r in rows])
    assert np.mean([p == r["lang"] for (p, _), r in zip(found, rows, strict=True)]) > 0.95
    odd = spark.createDataFrame([(0, None, "x"), (1, "", "x"), (2, "12 ... 34", "x"), (3, "the of and with that\npour dans une", "x"), (4, "the " * 50_000, "x"), (3, "the", "x")], "doc_id long, text string, lang string")
    got = {r["doc_id"]: (r["lang"], r["score"]) for r in language.identify(odd.drop("lang"), "text", crf).collect()}
    assert all(got[i] == ("und", 0.0) for i in (0, 1, 2)) and got[4][0] == "en" and all(0 <= s <= 1 for _, s in got.values())
    assert language.keep_identified(odd, "text", crf).columns == odd.columns
    assert language.identify(odd.drop("lang").limit(0), "text", crf).count() == 0
    assert language.fit(odd.limit(0), "doc_id", "text", "lang", F.lit(True)) is None
    assert [r["lang"] for r in language.identify(odd.drop("lang"), "text", None).collect()] == ["und"] * 6


def test_code_switching_is_seen_word_by_word(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    crf = language.fit(docs, "doc_id", "text", "lang", F.lit(True))
    words = ["the", "of", "and", "with", "pour", "dans", "une", "est"]
    tagger = language.Tagger(crf)
    emit = tagger.table[tagger._ids(words)].astype(float)  # noqa: SLF001
    marginal = language.Lattice(np.array([len(words)])).run(emit, crf.trans, crf.first, False)[0]
    best = [crf.labels[i] for i in marginal.argmax(1)]
    assert best[:3] == ["en"] * 3 and best[-3:] == ["fr"] * 3


def test_switches_are_learned():
    """Words of both languages go with their neighbours; to change costs less than with transitions of constant chains."""
    rng = np.random.default_rng(2)
    vocabulary = {"x": ["aba", "abo", "abu"], "y": ["kik", "kok", "kuk"]}
    texts, langs = zip(*((" ".join(rng.choice(vocabulary[x], 30)), x) for x in "xy" * 20), strict=True)
    crf = language.train(list(texts), list(langs))
    assert crf.trans[0, 1] > 0 and crf.trans[0, 0] > crf.trans[0, 1]
    tagger = language.Tagger(crf)
    words = ["aba", "abo", "zzz", "kik", "kok", "aba"]
    marginal = language.Lattice(np.array([len(words)])).run(tagger.table[tagger._ids(words)].astype(float), crf.trans, crf.first, False)[0]  # noqa: SLF001
    best = [crf.labels[i] for i in marginal.argmax(1)]
    assert best[:2] == ["x"] * 2 and best[3:] == ["y", "y", "x"]


def test_long_runs_are_read_whole(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    crf = language.fit(docs, "doc_id", "text", "lang", F.lit(True))
    en, fr = ("".join(w for r in docs.filter(F.col("lang") == lang).orderBy("doc_id").limit(20).collect() for w in r["text"].split() if w.isalpha()) for lang in ("en", "fr"))
    assert [p for p, _ in language.Tagger(crf).predict([en[:31] + fr + en[-31:], fr[:31] + en + fr[-31:]])] == ["fr", "en"]
    for n in (63, 64, 65, 78, 79, 80, 81, 500):
        word = "".join(chr(0x4E00 + i) for i in range(n))
        parts = language.units(["a", word])
        assert parts[0] == "a" and [x[i : i + 3] for x in parts[1:] for i in range(len(x) - 2)] == [word[i : i + 3] for i in range(n - 2)]


def corpus(spark):
    base = "the cat sat on the mat and the dog sat on the rug"
    texts = [base + f" w{i}" for i in range(40)] + [None, "", " ", "THE cat unseen"] + ["x y " * 3000]
    return texts, spark.createDataFrame([(t, i, 1.0) for i, t in enumerate(texts)], "text string, doc_id long, score double")


def words_of(text):
    return [w.decode() for w in (text or "").encode().lower().split()] + [""]


class PlainTree:
    """The suffix tree with dicts: ("^", ...) are contexts from the start of a text."""

    def __init__(self, texts, depth=3, gain=0.02, discount=0.5, least=2):
        self.n, self.discount, self.least = Counter(), discount, least
        for ws in texts:
            ws = ["^", *ws]
            self.n.update(tuple(ws[i : i + k]) for k in range(1, depth + 2) for i in range(len(ws) - k + 1))
        self.total = sum(n for c, n in self.n.items() if len(c) == 1 and c != ("^",))
        self.base = self.total + sum(len(c) == 1 and c != ("^",) for c in self.n) + 1
        follows = {}
        for g, n in self.n.items():
            if len(g) > 1 and n >= least and self.n[g[:-1]] >= least:
                follows.setdefault(g[:-1], []).append(g[-1])
        self.depth, self.rest = depth, {}
        for c in sorted(follows, key=len):
            share = {x: (self.n[*c, x] - discount) / self.n[c] for x in follows[c]}
            above = {x: self.chance(c[1:], x) for x in share}
            left, left_above = 1 - sum(share.values()), 1 - sum(above.values())
            if left > 0 and left_above > 0:
                gained = sum(p * math.log(p / above[x]) for x, p in share.items()) + left * math.log(left / left_above)
                if gained >= gain and gained * self.n[c] >= math.log(max(1, self.total)):
                    self.rest[c] = left / left_above

    def chance(self, context, word):
        if not context:
            return (self.n[word,] + 1) / self.base
        if context not in self.rest:
            return self.chance(context[1:], word)
        n = self.n[*context, word]
        return (n - self.discount) / self.n[context] if n >= self.least else self.rest[context] * self.chance(context[1:], word)

    def score(self, words):
        ws = ["^", *words]
        return sum(math.log10(self.chance(tuple(ws[max(0, i - self.depth) : i]), ws[i])) for i in range(1, len(ws)))


def test_suffix_tree_against_a_plain_one(spark, monkeypatch):
    """Small blocks and ranges: several of each in one partition."""
    monkeypatch.setattr(suffix_tree, "RANGE_BYTES", 4000)
    monkeypatch.setattr(suffix_tree, "BUCKET_BYTES", 10_000)
    rng = np.random.default_rng(3)
    texts, _ = corpus(spark)
    texts += [" ".join(f"w{k}" for k in rng.zipf(1.4, 60) if k < 300) for _ in range(150)] + [texts[0]] * 3
    rows = [*enumerate(texts), (None, texts[1]), (5, texts[5])]  # a null id and a repeated row
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, train string").repartition(3)
    train = F.coalesce(F.col("doc_id"), F.lit(2)) % 7 != 2
    tree = PlainTree([words_of(t) for i, t in rows if (2 if i is None else i) % 7 != 2])
    assert max(map(len, tree.rest)) == 3 and any("^" in c for c in tree.rest)
    want = Counter((i, len(words_of(t)), sum(tree.n[w,] > 0 for w in words_of(t)), tree.total) for i, t in rows)
    for size in (1_000_000, 500):
        monkeypatch.setattr(suffix_tree, "BLOCK_TOKENS", size)
        got = suffix_tree.score_texts(df, "doc_id", "text", train).collect()
        assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got) == want
        by_id = {i: t for i, t in rows}
        for r in got:
            ws = words_of(by_id[r["doc_id"]])
            assert math.isclose(r["base_score"], sum(math.log10((tree.n[w,] + 1) / tree.base) for w in ws), rel_tol=1e-9)
            assert math.isclose(r["score"], tree.score(ws), rel_tol=1e-5), r


def test_suffix_tree_without_rows(spark):
    texts, df = corpus(spark)
    assert suffix_tree.score_texts(df.limit(0), "doc_id", "text", F.lit(True)).count() == 0
    for nothing in (F.lit(False), F.lit(None).cast("boolean")):
        rows = suffix_tree.score_texts(df, "doc_id", "text", nothing).collect()
        assert len(rows) == len(texts) and all(r["score"] == r["base_score"] == 0 and not r["train"] for r in rows)


def test_suffix_tree_states_are_distributions():
    tree = PlainTree([words_of(f"the cat sat on the mat and the dog sat on w{i % 9}") for i in range(40)])
    every = {c[0] for c in tree.n if len(c) == 1} - {"^"}
    assert tree.rest
    for c in tree.rest:
        assert math.isclose(sum(tree.chance(c, w) for w in every) + tree.chance(c, "never seen"), 1, rel_tol=1e-9)


def test_suffix_tree_keeps_rare_contexts(spark):
    """A pair of words seen four times in 50,000 tokens, less than a ten-thousandth."""
    rng = np.random.default_rng(0)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 2000, 500)) + (" zig zag" if i < 4 else "") for i in range(100)] + ["zig zag"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    last = {r["doc_id"]: r for r in suffix_tree.score_texts(df, "doc_id", "text", F.col("doc_id") < 100).collect()}[100]
    assert last["score"] - last["base_score"] > 3


def test_pack_round_trip():
    x = np.array([0, 1, 255, 256, 2**31 - 1, 2**62, 7])
    for part in (x, x[:1], x[:0], x[4:]):
        assert (suffix_tree.unpack(suffix_tree.pack(part)) == part).all() and len(suffix_tree.unpack(suffix_tree.pack(part))) == len(part)
        assert (suffix_tree.unpack_bytes(suffix_tree.pack_bytes(part / 3), np.float64) == part / 3).all()


def test_url_rules(spark):
    rows = [None, "", "no scheme", "HTTP://A.Example.COM/en/712?q#f", "http://example.com", "http://notexample.com/en/7", "http://x.example.com/en/7", "http://b.example.net/de/81", "http://example.net/de/9", "http://s.org/es/x", "http://s.org/es", "a://b://c/d"]
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(rows)] * 2, "page_id long, url string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge(df, "page_id", "url", RULES).collect()}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow") and got[3] == ("a.example.com", "/en/712", "example.com/en/7", "allow")
    assert got[4][:3] == ("example.com", "", None) and got[5][2:] == ("com/en/", "block") and got[6][2:] == ("example.com/en/7", "allow") and got[7][2:] == ("example.net/de/8", "block")
    assert got[8][2:] == ("net/de/", "allow") and got[9][2:] == ("org/es/", "block") and got[10][2] is None and got[11][:2] == ("b:", "//c/d")
    assert urls.judge(df.limit(0), "page_id", "url", RULES).count() == 0


def test_url_templates_carry_labels_over(spark):
    rules = (urls.UrlRule("block", "s.net", "/spam/a"), urls.UrlRule("allow", "s.net", "/blog/a"))
    rows = [f"http://s.net/{kind}/{'a' if i % 2 else 'b'}{'xyz'[i % 3]}{chr(97 + i % 26)}/{i}" for kind in ("spam", "blog") for i in range(120)]
    df = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    got = [(r["path"], r["rule"], r["verdict"]) for r in urls.judge(df, "page_id", "url", rules).collect()]
    free = [(p, v) for p, rule, v in got if rule is None]
    assert len(free) == 120 and all(v == ("block" if p.startswith("/spam") else "allow") for p, v in free)


def test_url_templates_reach_the_last_segment(spark):
    kinds = ("/shop/en/c/spam", "/shop/en/c/blog")
    rules = (urls.UrlRule("block", "s.net", kinds[0] + "/a"), urls.UrlRule("allow", "s.net", kinds[1] + "/a"))
    rows = [f"http://s.net{kind}/{'a' if i % 2 else 'b'}{'xyz'[i % 3]}{chr(97 + i % 26)}/{i}" for kind in kinds for i in range(120)]
    deep = "http://s.net/" + "/".join("deep" for _ in range(400))  # one long tail takes no round for each segment
    df = spark.createDataFrame(list(enumerate([*rows, deep, deep])), "page_id long, url string")
    got = [(r["path"], r["rule"], r["verdict"], r["template"]) for r in urls.judge(df, "page_id", "url", rules).collect()]
    free = [(p, v) for p, rule, v, _ in got if rule is None and p.startswith("/shop")]
    assert len(free) == 120 and all(v == ("block" if p.startswith(kinds[0]) else "allow") for p, v in free)
    assert sum((t or "").endswith("/deep" * 390) for _, _, _, t in got) == 2


def test_main_text(spark):
    page = """<html><head><title>t</title></head><body><header><h1>Site</h1></header><nav><ul><li><a href=/a>Menu</a></li></ul></nav>
    <div class="cookie-notice">We use cookies on this site, a lot of them, really.</div><div class="ad">Buy now &amp; save</div>
    <main><article><h1>Head &eacute;</h1><p>First  para\n of <b>text</b> &lt;here&gt;.<p>Short.<script>var x = "<p>no</p>";</script><p>Another paragraph with enough words in it to count.</article>
    <aside>Related links and more words</aside><form><label>Name</label><input></form><section id="comments"><p>First! A reader wrote this long comment here.</p></section></main><footer>&copy; x</footer></body></html>"""
    want = "Head é\nFirst para of text <here>.\nShort.\nAnother paragraph with enough words in it to count."
    odd = [page, None, "", "plain only", "<nav>menu</nav>", "<p>" * 3000 + "deep", "<article>" + "<p>word &amp; word</p>" * 2000 + "</article>", "<p>open <b>bold", page]
    df = spark.createDataFrame([(i, "u", h, "clash") for i, h in enumerate(odd)], "page_id long, url string, html string, text string")
    got = {r["page_id"]: r for r in html.extract_main_text(df, "page_id", "url", "html").collect()}
    assert got[0]["text"] == got[8]["text"] == want and all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert [got[i]["text"] for i in (1, 2, 3, 4, 5, 7)] == ["", "", "plain only", "", "deep", "open bold"] and got[6]["text"].count("\n") == 1999
    assert html.extract_main_text(df.limit(0), "page_id", "url", "html").count() == 0


def test_main_text_without_article():
    long = "A sentence with more than enough words to be the longest one of the page by far. " * 8
    nav = "<nav><a href=/a>Menu</a></nav><div class=footer>Imprint</div><div><a href=/b>More</a> <a href=/c>Links</a></div>"
    pages = {
        f"<body>{nav}<div><p>First words.</p><blockquote><p>{long}</p></blockquote><p>Last words.</p></div></body>": ["First words.", long.strip(), "Last words."],
        f"<body>{nav}<div><div><p>{long}</p></div><div><p>Short.</p></div></div></body>": [long.strip(), "Short."],
        f"<body><table><tr><td>{long}</td><td>Cell.</td></tr></table></body>": [long.strip(), "Cell."],
    }
    for page, want in pages.items():
        assert html.main_text(page).split("\n") == want
    page = f"<body><h1>Head</h1><p>Before.</p><section><p>{long}</p></section><p>After.</p></body>"
    assert html.main_text(page).split("\n") == ["Head", "Before.", long.strip(), "After."]


VARIABLE = re.compile(r"^(\d+|[0-9a-fA-F]{8,}|\d{4}-\d{2}(-\d{2})?|[0-9a-fA-F]{8}-[0-9a-fA-F-]{27}|(?=[^.]*\d)[\w-]{6,})(\.[A-Za-z]{2,5})?$", re.A)


def plain_url_verdicts(urls_seen, rules, z=2.5, weight=4.0):
    """(host, path, rule, verdict, template, purity) of each url, by recursion over each host's paths."""
    rows, by_host = [], {}
    for url in urls_seen:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].translate({c: c + 32 for c in range(65, 91)}), m[2]) if m else ("", "")
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        rule = max(fits, key=lambda r: len(r.name), default=None)
        s = tuple("*" + (g[3] or "") if (g := VARIABLE.match(x)) else x for x in path.split("/") if x)
        rows.append((host, path, rule, s))
        n, b = by_host.setdefault(host, {}).get(s, (0, 0))
        by_host[host][s] = (n + (rule is not None), b + (rule is not None and rule.verdict == "block"))
    found, pools = {}, {}

    def grow(host, leaves, level, m, above):
        tn, tb = (sum(x[i] for x in leaves.values()) for i in (0, 1))
        p = (tb + weight * above) / (tn + weight)
        children = {}
        for s, x in leaves.items():
            children.setdefault(s[level] if len(s) > level else "", {})[s] = x
        below = {}
        for here, held in children.items():
            n, b = (sum(x[i] for x in held.values()) for i in (0, 1))
            rest_n, rest_b = tn - n, tb - b
            alike = True
            if n and rest_n:
                noise = math.sqrt(tb / tn * (1 - tb / tn) * (1 / n + 1 / rest_n))
                alike = abs(b / n - rest_b / rest_n) <= z * noise
            if here == "" or len(leaves) == 1:
                for s in held:
                    found[host, s] = m if here == "" else m + s[level:]
                    pool = pools.setdefault((host, found[host, s]), [0, 0, p])
                    pool[0], pool[1] = pool[0] + held[s][0], pool[1] + held[s][1]
            else:
                below.setdefault("*" if alike else here, {}).update(held)
        for name, held in below.items():
            grow(host, held, level + 1, (*m, name), p)

    for host, leaves in by_host.items():
        grow(host, leaves, 0, (), 0.5)
    out = []
    for host, path, rule, s in rows:
        m = found[host, s]
        n, b, above = pools[host, m]
        purity = (b + weight * above) / (n + weight)
        out.append((host, path, rule.name, rule.verdict, None, None) if rule else (host, path, None, "block" if purity > 0.5 else "allow", "/" + "/".join(m), round(purity, 6)))
    return out


def test_url_templates_against_a_plain_tree(spark):
    pages = [r["url"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("url").collect()]
    rng = np.random.default_rng(8)
    made = [f"http://h{rng.integers(3)}.net/{'ab'[rng.integers(2)]}/{'cdef'[rng.integers(4)]}/" + "/".join("gh"[rng.integers(2)] for _ in range(rng.integers(4))) for _ in range(300)]
    more = (urls.UrlRule("block", "h0.net", "/a/c"), urls.UrlRule("allow", "h0.net", "/b/d/g"), urls.UrlRule("allow", "h1.net", "/a"), urls.UrlRule("block", "h1.net", "/b/e"))
    rows = [*pages, *made, None, "x", "http://" + "a" * 3000 + ".net/" + "b/" * 50 + "c" * 5000, *made[:20]]
    df = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    got = {r["page_id"]: r for r in urls.judge(df, "page_id", "url", RULES + more).collect()}
    for i, (*same, purity) in enumerate(plain_url_verdicts(rows, RULES + more)):
        r = got[i]
        assert (r["host"], r["path"], r["rule"], r["verdict"], r["template"]) == tuple(same) and (r["purity"] is None) == (purity is None)
        assert purity is None or abs(r["purity"] - purity) < 2e-6
    free = {r["purity"] for i, r in got.items() if i < len(pages) and r["rule"] is None}
    assert len(free) > 3 and {r["verdict"] for i, r in got.items() if i < len(pages) and r["rule"] is None} == {"allow", "block"}


LONG = "A sentence with more than enough words in it to stand for the text of the page. " * 4


def test_main_text_weighs_names_by_content():
    article = f"<div><h2>Head</h2><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div>"
    want = ["Head", LONG.strip(), "Short.", LONG.strip()]
    menu = "<ul><li><a href=/a>Home page</a></li><li><a href=/b>About the firm</a></li><li><a href=/c>Shop</a></li><li><a href=/d>Contact</a></li></ul>"
    for page in (
        f"<body><form action=/x>{article}</form></body>",
        f"<body><form><label>Mail</label><input></form>{article}</body>",
        f"<body><nav>{menu}{article}</body>",
        f"<body><div class='header-main wrapper'>{article}</div></body>",
        f"<body><div>{menu}</div>{article}<div>{menu}</div></body>",
    ):
        assert html.main_text(page).split("\n") == want, page
    inside = f"<article><p>{LONG}</p><div class='legal-analysis'><p>The law says so.</p></div><div class='cookie-notice'>We use cookies.</div><div class='ad slot-3'>Buy!</div></article>"
    assert html.main_text(inside).split("\n") == [LONG.strip(), "The law says so."]
    comments = "".join(f"<p>Reader {i}: {LONG}</p>" for i in range(2))
    assert html.main_text(f"<body><div><p>{LONG}</p><p>{LONG}</p></div><div id=comments>{comments}</div></body>").split("\n") == [LONG.strip()] * 2


def test_main_text_depends_on_smoothing_and_threshold():
    links = "<div><a href=/a>Home</a></div><div><a href=/b>Shop</a></div><div><a href=/c>About</a></div>"
    promo = "<div>Save on all we sell</div>"
    page = f"<body>{links}{promo}{links}<div><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div>{links}{promo}{links}</body>"
    want = [LONG.strip(), "Short.", LONG.strip()]
    assert html.main_text(page).split("\n") == want
    assert html.main_text(page, level=0.0).split("\n") != want  # without the threshold the promotions are seeds
    short = f"<body><div><p>{LONG}</p></div><div><p>Short.</p></div><div><p>{LONG}</p></div>{links}<div>Imprint</div></body>"
    assert html.main_text(short).split("\n")[:3] == want
    edge = f"<body><div><div><p>{LONG}</p></div><div><p>So.</p></div></div>{links}{promo}{links}</body>"
    assert html.main_text(edge).split("\n") == [LONG.strip(), "So."]
    assert html.main_text(edge, sigma=0.01).split("\n") == [LONG.strip()]  # without smoothing a short line has no support


def test_main_text_takes_linear_time():
    import time

    for page in ("<b>" * 8000 + "<p>deep" * 8000, "<div class=ad><section>" * 4000 + "x", "<i>" * 8000 + "</u>" * 8000 + "end", "<section><p>text</p>" * 8000):
        began = time.perf_counter()
        html.main_text(page)
        assert time.perf_counter() - began < 1


def test_page_text_of_all_pages(spark, small):
    from html import unescape

    for r in spark.read.parquet(f"{small}/pages.parquet").collect():
        body = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = re.split(r"</?(?:p|h1|br|div)\b[^>]*>", body)
        want = "\n".join(x for x in (" ".join(unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in parts) if x)
        assert html.main_text(r["html"]) == want


def plain_quality(text):
    """The verdict of the quality rules, word by word."""
    t = text or ""
    words = [x for x in re.split("[\x20\x09-\x0d]+", t) if x]
    lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    three = Counter(zip(words, words[1:], words[2:], strict=False))
    repeated = {p + k for p, x in enumerate(zip(words, words[1:], words[2:], strict=False)) if three[x] > 1 for k in range(3)}
    stops = set(quality.STOP_WORDS.split())
    figures = {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(map(t.count, "#*$%&|<>")), "n_shouts": sum(map(t.count, "!?")), "n_upper": sum(unicodedata.category(c) == "Lu" for c in t),
        "n_stop_words": sum(w.lower() in stops for w in words), "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)),
    }
    if len(words) < 50 or 100 * len(repeated) > 50 * len(words):
        return False
    return all(r.least <= (figures[r.numerator] / figures[r.denominator] if figures[r.denominator] else 0.0) <= r.most for r in quality.RULES)


def test_pipeline_against_plain_stages(spark, small, tmp_path):
    import corpus_pipeline as cp
    from test_simhash import brute_components, brute_print
    from tokenizers import Tokenizer

    from terraproof.llm.q04_bpe import tokenizer_file

    docs = spark.read.parquet(f"{small}/documents.parquet").withColumn("__lang_found", F.lit("clash")).withColumn("_n", F.lit("clash"))
    good = docs.filter("lang = 'en'").orderBy(F.desc("n_chars")).first()
    odd = [(90001, None, None, None, None), (90002, "", "en", "s", 0), (90003, "12 34", None, "s", 5), (90004, good["text"], "en", "s", 9), (good["doc_id"], good["text"], "en", "s", 9), (None, good["text"][:-30], "en", None, 1)]
    docs = docs.unionByName(spark.createDataFrame([(*r, "clash", "clash") for r in odd], docs.schema))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    crf = language.fit(docs, "doc_id", "text", "lang", F.coalesce(id_crc32("doc_id") % 3 != 1, F.lit(True)))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = language.Tagger(crf).predict([t for _, t in rows])
    want = [[r for r, (lang, score) in zip(rows, found, strict=True) if lang != "und" and score >= 0.4]]
    want.append([(i, t) for i, t in want[0] if plain_quality(t)])
    named = {i: t for i, t in want[1] if i is not None}
    heads = set(brute_components({i: brute_print(t) for i, t in named.items()}, 4).values())
    want.append([(i, t) for i, t in named.items() if i in heads])
    at = docs
    for (name, stage), expected in zip(cp.STAGES, want, strict=False):
        out = stage(spark, at, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        at = spark.read.parquet(str(tmp_path / name))
        assert Counter((r["doc_id"], r["text"]) for r in at.collect()) == Counter(expected), name
    assert len(want[0]) < len(rows) and len(want[1]) < len(want[0]) and len(want[2]) < len(want[1])
    packed = cp.run(spark, str(tmp_path)).toPandas()
    tok = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    pieces = {i: g.sort_values("start") for i, g in packed.groupby("doc_id")}
    assert set(pieces) == {i for i, _ in want[2]}
    for i, t in want[2]:
        n = len(tok.encode(t, add_special_tokens=False).ids) + 1
        assert (pieces[i]["doc_tokens"] == n).all() and pieces[i]["length"].sum() == n and (pieces[i]["start"] == pieces[i]["length"].cumsum() - pieces[i]["length"]).all()
    for _, g in packed.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert (g["offset"] == g["length"].cumsum() - g["length"]).all() and g["length"].sum() <= 1024
    docs.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert cp.run(spark, str(tmp_path / "none")).count() == 0
