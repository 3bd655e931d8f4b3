"""Text rules as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from terraproof.functions import rules as R

#: A word boundary between ASCII word characters, as the rules mean it; Java's own looks at all letters.
ASCII_EDGE = r"(?:(?<=[A-Za-z0-9_])(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])(?=[A-Za-z0-9_]))"


def has(text: Column, pattern: str) -> Column:
    """Whether the pattern occurs, without regard to ASCII case."""
    return F.coalesce(text, F.lit("")).rlike("(?is)" + pattern.replace(r"\b", ASCII_EDGE))


def first_case(cases: list[tuple[Column, Column]], otherwise: Column) -> Column:
    """The value of the first condition that holds."""
    return reduce(lambda acc, x: F.when(x[0], x[1]).otherwise(acc), reversed(cases), otherwise)


def squeeze(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))


def non_empty(*parts: Column) -> Column:
    """The parts that are neither null nor empty, joined by blanks."""
    return F.concat_ws(" ", *(F.when(p != "", p) for p in parts))


def classify_document(text: Column, role: Column) -> Column:
    """Struct (classification, priority, narrative): explicit role, else narrative words, else geometry words."""
    make = lambda c, p, n: F.struct(F.lit(c).alias("classification"), F.lit(p).alias("priority"), F.lit(n).alias("narrative"))
    said = F.lower(F.trim(F.coalesce(role, F.lit(""))))
    cases = [(said.contains(token), make(c, p, False)) for token, c, p in R.ROLE_CLASSES]
    cases.append((has(text, R.NARRATIVE), make("narrative", -100, True)))
    cases += [(has(text, pattern), make(c, p, False)) for c, p, pattern in R.TEXT_CLASSES]
    return first_case(cases, make("unknown", 0, False))


def label_role(text: Column) -> Column:
    """Semantic role of a label, or null."""
    flat = squeeze(text)
    return first_case([(has(flat, p), F.lit(role)) for role, p in R.LABEL_ROLES], F.lit(None).cast("string"))


def role_feature_class(role: Column) -> Column:
    key = F.lower(F.trim(role))
    return first_case([(key == r, F.lit(c)) for r, c in R.ROLE_FEATURE_CLASS.items()], F.lit(None).cast("string"))


def normal_status(status: Column) -> Column:
    flat = F.lower(squeeze(status))
    return F.when(flat == "", "unknown").otherwise(flat)


def status_eligible(status: Column) -> Column:
    flat = normal_status(status)
    return ~flat.rlike("|".join(R.NEGATIVE_STATUS)) & has(flat, r"\b(?:" + "|".join(R.POSITIVE_STATUS) + r")\b")


def status_reason(status: Column) -> Column:
    return F.when(status_eligible(status), "positive-final-planning-status").otherwise(F.concat(F.lit("non-authoritative-application-status:"), normal_status(status)))


def rank_attachment(title: Column, row_text: Column, document_type: Column) -> Column:
    """Struct (classification, priority, narrative, proposed, existing, ride_layout, drawing)."""
    text = F.trim(non_empty(title, row_text, document_type))
    base = classify_document(text, F.lit(None).cast("string"))
    narrative = has(text, R.ATTACHMENT_NARRATIVE) | base["narrative"]
    existing = has(text, R.EXISTING)
    proposed = has(text, R.PROPOSED) & ~existing
    ride = has(text, R.ATTACHMENT_RIDE) & ~narrative
    drawing = has(text, R.ATTACHMENT_DRAWING) & ~narrative
    score = F.when(ride, F.greatest(base["priority"], F.lit(220))).when(proposed & drawing, base["priority"] + 45).when(drawing, base["priority"] + 15).otherwise(base["priority"])
    score = score - F.when(existing, 55).otherwise(0)
    score = F.when(narrative, F.least(score, F.lit(-150))).otherwise(score)
    return F.struct(
        F.when(ride, "ride-layout").otherwise(base["classification"]).alias("classification"), score.alias("priority"), narrative.alias("narrative"),
        proposed.alias("proposed"), existing.alias("existing"), ride.alias("ride_layout"), drawing.alias("drawing"),
    )


def count_words(text: Column) -> Column:
    flat = squeeze(text)
    return F.when(flat == "", 0).otherwise(F.size(F.split(flat, " ")))


def ride_page(role: Column, text: Column, has_anchor: Column) -> Column:
    """Struct (eligible, score, words, dense, reasons) of a page that may be a ride drawing."""
    prior = F.lower(F.coalesce(role, F.lit(""))).rlike(R.PAGE_ROLE_PRIOR)
    ride, context, drawing, proposed, narrative = (has(text, p) for p in (R.PAGE_RIDE_DRAWING, R.PAGE_RIDE_CONTEXT, R.PAGE_DRAWING, R.PROPOSED, R.PAGE_NARRATIVE))
    words = count_words(text)
    dense = (words >= R.DENSE_PROSE_WORDS) & ~drawing
    points = lambda c, n: F.when(c, n).otherwise(0)
    score = points(prior, 2) + F.when(ride, 5).when(context, 1).otherwise(0) + points(drawing, 3) + points(proposed, 1) + points(has_anchor, 1) - points(narrative, 4) - points(dense, 4)
    named = [(prior, "ride-document-prior"), (ride, "ride-drawing-text"), (drawing, "drawing-cues"), (proposed, "proposed-cue"), (narrative, "narrative-cue"), (dense, "dense-prose")]
    reasons = F.array_compact(F.array(*(F.when(c, n) for c, n in named)))
    return F.struct((ride & drawing & (score >= R.RIDE_PAGE_SCORE) & ~dense).alias("eligible"), score.alias("score"), words.alias("words"), dense.alias("dense"), reasons.alias("reasons"))


def useful_text(text: Column) -> Column:
    """At least five words and 32 characters."""
    return (count_words(text) >= 5) & (F.length(squeeze(text)) >= 32)


def embedded_or(embedded: Column, words: Column, fallback: Column, least: int = 24) -> Column:
    """A page's embedded text where it has a word and ``least`` characters that are no white space, else the fallback."""
    solid = F.length(F.regexp_replace(F.coalesce(embedded, F.lit("")), r"[\s\p{Z}\x0B\uFEFF]+", ""))
    return F.when((solid >= least) & (F.coalesce(words, F.lit(0)) > 0), embedded).otherwise(fallback)


def pixel_threshold(base: Column, dpi: Column, requested: Column, least: float = 1.0) -> Column:
    """A threshold in pixels, made smaller where a page was drawn at less than the requested resolution."""
    given = lambda c: F.nullif(c.cast("double"), F.lit(0.0))
    asked = F.greatest(F.lit(1.0), F.coalesce(given(requested), given(dpi), F.lit(240.0)))
    real = F.greatest(F.lit(1.0), F.coalesce(given(dpi), asked))
    return F.greatest(F.lit(max(0.0, least)), F.greatest(F.lit(0.0), F.coalesce(base.cast("double"), F.lit(0.0))) * F.least(F.lit(1.0), real / asked))


def scale_denominators(text: Column, least: int = 25, most: int = 10000) -> Column:
    """Distinct denominators of scales like 1:500, ascending."""
    found = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?i)(?:scale\s*)?1\s*[:/]\s*([0-9]{2,5})" + ASCII_EDGE), F.lit(1)), lambda x: x.cast("int"))
    return F.array_sort(F.array_distinct(F.filter(found, lambda n: (n >= least) & (n <= most))))


def raster_dpi(requested: Column, width_points: Column, height_points: Column, long_edge_px: int = 5200, least: int = 120, fallback: int = 180) -> Column:
    """Resolution that keeps a page's longer edge within a number of pixels."""
    want = F.least(F.lit(600.0), F.greatest(F.lit(72.0), F.coalesce(F.nullif(requested.cast("double"), F.lit(0.0)), F.lit(240.0))))
    low = F.greatest(F.lit(72.0), F.least(want, F.lit(float(least))))
    longest = F.greatest(F.coalesce(width_points, F.lit(0.0)), F.coalesce(height_points, F.lit(0.0)))
    bound = F.floor(F.lit(long_edge_px * 72.0) / F.nullif(longest, F.lit(0.0)))
    chosen = F.when(longest > 0, F.greatest(low, F.least(want, bound))).otherwise(F.greatest(low, F.least(want, F.lit(float(fallback)))))
    return F.floor(chosen + 0.5).cast("int")


def coordinate_pair(text: Column) -> Column:
    """Struct (kind, first, second) of the first coordinates in a text, else null: labelled grid, grid, lon/lat, lat/lon."""
    flat = F.regexp_replace(F.coalesce(text, F.lit("")), ",", " ")
    label = r"(?i)(?:e(?:asting)?\s*[:=]?\s*)(\d{5,6}(?:\.\d+)?)\D{0,20}(?:n(?:orthing)?\s*[:=]?\s*)(\d{5,7}(?:\.\d+)?)"
    east, north = (F.try_to_number(F.nullif(F.regexp_extract(flat, label, k), F.lit("")), F.lit("9999999.9999999999")).cast("double") for k in (1, 2))
    # transform over a one-element array binds a value to a name, so that it is computed once
    bound = lambda value, f: F.get(F.transform(F.array(value), f), F.lit(0))
    pair = lambda texts, i: F.struct(F.get(texts, i).cast("double").alias("a"), F.get(texts, i + 1).cast("double").alias("b"))
    pairs = bound(F.regexp_extract_all(flat, F.lit(r"[-+]?\d+(?:\.\d+)?"), F.lit(0)), lambda texts: F.when(F.size(texts) > 1, F.transform(F.sequence(F.lit(0), F.size(texts) - 2), lambda i: pair(texts, i))))
    make = lambda kind, a, b: F.struct(F.lit(kind).alias("kind"), a.alias("first"), b.alias("second"))
    # a number counts as fractional if its value is, as "1.0" and "1" are one number
    fractional = lambda p: (p["a"] != F.floor(p["a"])) | (p["b"] != F.floor(p["b"]))
    grid = lambda p: p["a"].between(10000, 700000) & p["b"].between(10000, 1300000)
    lon_lat = lambda p: (F.abs(p["a"]) <= 180) & (F.abs(p["b"]) <= 90) & fractional(p)
    lat_lon = lambda p: (F.abs(p["a"]) <= 90) & (F.abs(p["b"]) <= 180) & fractional(p)
    first = F.get(F.filter(pairs, lambda p: grid(p) | lon_lat(p) | lat_lon(p)), F.lit(0))
    free = bound(first, lambda p: F.when(p.isNotNull(), F.when(grid(p), make("osgb", p["a"], p["b"])).when(lon_lat(p), make("wgs84", p["a"], p["b"])).otherwise(make("wgs84", p["b"], p["a"]))))
    return F.when(east.isNotNull() & north.isNotNull(), make("osgb", east, north)).otherwise(free)


def decode_html(text: Column) -> Column:
    """Text of a piece of markup: breaks and tags become blanks, then references are decoded in a fixed order."""
    out = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?i)<br\s*/?\s*>", " ")
    out = F.regexp_replace(out, r"<[^>]+>", " ")
    for pattern, value in (("&amp;", "&"), ("&quot;", '"'), ("&#39;|&apos;", "'"), ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">")):
        out = F.regexp_replace(out, "(?i)" + pattern, value)
    codes = F.array_distinct(F.regexp_extract_all(out, F.lit(r"&#(\d{1,6});"), F.lit(1)))
    char = lambda c: F.decode(F.unhex(F.lpad(F.hex(c.cast("int")), 8, "0")), "UTF-32")
    out = F.aggregate(codes, out, lambda acc, c: F.replace(acc, F.concat(F.lit("&#"), c, F.lit(";")), char(c)))
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def href(tag: Column) -> Column:
    """Target in an anchor's start tag, in double, single or no quotes; empty if there is none."""
    pattern = r"""(?i)\bhref\s*=\s*(?:"([^"]+)"|'([^']+)'|([^\s>"']+))"""
    target = F.concat(*(F.regexp_extract(tag, pattern, k) for k in (1, 2, 3)))
    return F.regexp_replace(target, r"(?i)&amp;|&#38;|\\u0026|\\x26", "&")


def without_dots(url: Column) -> Column:
    """An absolute address whose path has no ``.`` and ``..`` segments; one that leaves the root stays at the root."""
    parts = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)(/[^?#]*)?(.*)$"
    head, path, tail = (F.regexp_extract(url, "(?s)" + parts, k) for k in (1, 2, 3))
    steps = F.split(path, "/")
    up = lambda done: F.when(F.size(done) > 1, F.slice(done, F.lit(1), F.size(done) - 1)).otherwise(done)
    kept = F.aggregate(steps, F.array().cast("array<string>"), lambda done, s: F.when(s == ".", done).when(s == "..", up(done)).otherwise(F.concat(done, F.array(s))))
    ends = F.when(F.element_at(steps, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when((head != "") & path.rlike(r"/\.{1,2}(/|$)"), F.concat(head, F.array_join(ends, "/"), tail)).otherwise(url)


def resolve_url(base: Column, target: Column) -> Column:
    """Absolute form of ``target`` as seen from ``base``: absolute, without scheme, from the root, query, fragment, relative."""
    scheme, origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1), F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    page, folder = F.regexp_extract(base, r"^([^?#]*)", 1), F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    return without_dots(
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), target).when(target.startswith("//"), F.concat(scheme, target)).when(target.startswith("/"), F.concat(origin, target))
        .when(target.startswith("?"), F.concat(page, target)).when(target.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), target))
        .otherwise(F.concat(folder, F.when(folder == origin, "/").otherwise(""), target))
    )


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def normal_name(name: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), "[^a-z0-9]+", " "))


def content_key(namespace: str, *parts: Column) -> Column:
    """Address of a result: namespace and digest of the namespace and the parts' JSON, fields in order of name."""
    body = F.to_json(F.struct(*parts))
    return F.concat(F.lit(namespace + "-"), F.sha2(F.concat(F.lit(namespace), F.lit("\u0000"), body), 256))


def payload_hash(provided: Column, payload: Column) -> Column:
    """Digest of a source's payload: the one it brings, if that is one, else that of the payload's text."""
    return F.when(provided.rlike("^[a-fA-F0-9]{64}$"), F.lower(provided)).otherwise(F.sha2(F.coalesce(payload, F.lit("{}")), 256))


def page_size(info: Column, page: int | None = None) -> Column:
    """Struct (width, height) in points from a page-information text: the named page's line, else the common one, else the first."""
    line = lambda p: rf"(?im)^Page\s+{p}size:\s*([0-9.]+)\s+x\s+([0-9.]+)\s+pts"
    found = [F.struct(*(F.regexp_extract(F.coalesce(info, F.lit("")), line(p), k).try_cast("double").alias(n) for k, n in ((1, "width"), (2, "height")))) for p in ([rf"{int(page)}\s+"] if page is not None else []) + ["", r"\d+\s+"]]
    return F.coalesce(*(F.when((s["width"] > 0) & (s["height"] > 0), s) for s in found))


def is_pdf(mime: Column, path: Column) -> Column:
    """A document is a PDF by its media type or by its name."""
    return (F.lower(F.coalesce(mime, F.lit(""))) == "application/pdf") | F.lower(F.coalesce(path, F.lit(""))).endswith(".pdf")


def safe_token(value: Column) -> Column:
    """A text as part of a file name: other characters become single hyphens, none at the ends, 96 characters at most."""
    made = F.substring(F.regexp_replace(F.regexp_replace(F.coalesce(value, F.lit("")), "[^A-Za-z0-9._-]+", "-"), "^-+|-+$", ""), 1, 96)
    return F.coalesce(F.nullif(made, F.lit("")), F.lit("unknown"))


def png_size(content: Column) -> Column:
    """Struct (width, height) of a PNG file's bytes; null for other bytes."""
    digits = F.hex(F.substring(content, 1, 24))
    number = lambda at: F.conv(F.substring(digits, at, 8), 16, 10).cast("long")
    return F.when((F.length(content) >= 24) & digits.startswith("89504E470D0A1A0A"), F.struct(number(33).alias("width"), number(41).alias("height")))
