"""Attachments of application pages: image links in anchors and scripts, ranked, each once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraproof.functions.text import decode_html, href, rank_attachment, resolve_url

RAW_URL = r"""(?i)(?:https?://[^"'<>\s)]+?)?(?:/[^"'<>\s)]*?)?AttachmentShowServlet\?[^"'<>\s)]*ImageName(?:=|%3D)\d+[^"'<>\s)]*"""
#: Fixed value: characters that count as around a link outside table rows.
AROUND = 500
IMAGE = r"(?i)[?&]ImageName(?:=|%3D)(\d+)"


def with_offsets(text: Column, pattern: str) -> Column:
    """Matches of a pattern as structs (at, found): ``at`` counts the characters before, by sums over what lies between matches."""
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.transform(F.split(text, pattern, -1), F.length)
    before = lambda acc, k: F.coalesce(F.get(acc, F.size(acc) - 1)["end"], F.lit(0)) + F.get(between, k)
    step = lambda acc, x: F.concat(acc, F.array(F.struct(before(acc, x["k"]).alias("at"), (before(acc, x["k"]) + F.length(x["m"])).alias("end"), x["m"].alias("found"))))
    made = F.aggregate(F.transform(found, lambda m, k: F.struct(m.alias("m"), k.alias("k"))), F.array().cast("array<struct<at:int,end:int,found:string>>"), step)
    return F.transform(made, lambda x: F.struct(x["at"].alias("at"), x["found"].alias("found")))


def row_text(body: Column, at: Column) -> Column:
    """Text around a place: from the last ``<tr`` before it to the next ``</tr>``, else AROUND characters either side."""
    head = F.substring(body, F.lit(1), at + 3)
    back = F.instr(F.reverse(head), "rt<")
    begin = F.when(back > 0, F.length(head) - back - 2)
    after = F.instr(F.substring(body, at + 1, F.length(body)), "</tr>")
    in_row = F.substring(body, begin + 1, at + after + 4 - begin)
    first = F.greatest(F.lit(0), at - AROUND)
    return decode_html(F.when((back > 0) & (after > 0), in_row).otherwise(F.substring(body, first + 1, at + AROUND - first)))


def parse_attachments(pages: DataFrame, base: str = "url", markup: str = "html") -> DataFrame:
    """Ranked attachments of each page (page_id, url, html), best rank of each image.

    Links are anchors and addresses anywhere in the markup. The text of a link's table row counts for the rank; outside rows
    that of the characters around it does.
    """
    body = F.coalesce(F.col(markup), F.lit(""))
    mine = pages.filter(body.rlike("(?i)AttachmentShowServlet")).select("page_id", F.col(base).alias("base"), body.alias("body"))
    anchors = F.transform(with_offsets(F.col("body"), r"(?is)<a\b[^>]*>.*?</a>"), lambda x: F.struct(x["at"].alias("at"), F.regexp_extract(x["found"], r"(?is)^(<a\b[^>]*>)", 1).alias("tag"), decode_html(x["found"]).alias("title")))
    raw = F.transform(with_offsets(F.col("body"), RAW_URL), lambda x: F.struct(x["at"].alias("at"), F.concat(F.lit('<a href="'), x["found"], F.lit('">')).alias("tag"), F.lit("").alias("title")))
    found = mine.select("page_id", "base", "body", F.posexplode(F.concat(anchors, raw)).alias("k", "x"))
    found = found.withColumn("target", href(F.col("x.tag"))).filter(F.col("target").rlike("(?i)AttachmentShowServlet"))
    found = found.withColumns({"image": F.regexp_extract("target", IMAGE, 1), "resolved": resolve_url(F.col("base"), F.col("target")), "title": F.nullif(F.col("x.title"), F.lit("")), "row_text": row_text(F.col("body"), F.col("x.at"))}).drop("body").filter("image <> ''")
    ranked = found.withColumn("r", rank_attachment(F.col("title"), F.col("row_text"), F.lit(None).cast("string")))
    order = F.struct((-F.col("r.priority")).alias("p"), F.col("title").isNull().alias("untitled"), "k")
    best = ranked.groupBy("page_id", "image").agg(F.min_by(F.struct("title", "row_text", "resolved", "r"), order).alias("b"))
    url = F.regexp_replace("b.resolved", "(?i)^http:", "https:")
    return best.select("page_id", "image", "b.title", "b.row_text", url.alias("url"), F.regexp_replace(url, "(?i)^https:", "http:").alias("transport_url"), "b.r.*")


def best_attachments(found: DataFrame, order: tuple[str, ...] = ()) -> DataFrame:
    """Of each (application, image) the row of the best rank; ties go to the first by the columns of ``order``, then to a
    title, then to the least row, so that the result does not depend on the order of rows."""
    rest = [c for c in found.columns if c not in ("application", "image")]
    plain = [c for c in rest if c not in order and c != "priority"]
    key = F.struct((-F.col("priority")).alias("_p"), *order, F.to_json(F.struct(*plain)).alias("_row"))
    return found.groupBy("application", "image").agg(F.min_by(F.struct(*rest), key).alias("b")).select("application", "image", "b.*")


def union_attachments(*found: DataFrame) -> DataFrame:
    """Attachments of several pages of one application (application, image, priority, ...), the best rank of each image;
    of equal ranks the one of the earlier argument."""
    out = None
    for k, more in enumerate(found):
        more = more.withColumn("_page", F.lit(k))
        out = more if out is None else out.unionByName(more)
    return best_attachments(out, ("_page",)).drop("_page")


def in_order(attachments: DataFrame, *first: str) -> DataFrame:
    """Attachments as they are listed: best rank, narrative last where that is a column, name of the image."""
    narrative = [F.coalesce("narrative", F.lit(False))] if "narrative" in attachments.columns else []
    return attachments.orderBy(*first, F.desc("priority"), *narrative, "image")
