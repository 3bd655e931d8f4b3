"""Words to lines, lines to roles, roles to the nearest candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terraproof.functions.rules import ANCHOR_DISTANCE_PX
from terraproof.functions.text import label_role, squeeze


def group_words(words: DataFrame, keys: list[str]) -> DataFrame:
    """Lines of words (keys, pos, text, left, top, width, height, confidence): text, mean confidence, joint bounds, role."""
    lines = words.groupBy(*keys).agg(
        F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda w: w["text"])).alias("text"),
        F.avg("confidence").alias("confidence"), F.min("left").alias("left"), F.min("top").alias("top"),
        F.max(F.col("left") + F.col("width")).alias("right"), F.max(F.col("top") + F.col("height")).alias("bottom"),
    )
    return _with_role(lines)


def _with_role(lines: DataFrame) -> DataFrame:
    lines = lines.withColumn("text", squeeze(F.col("text"))).filter("text <> ''")
    return lines.withColumns({"center_x": (F.col("left") + F.col("right")) / 2, "center_y": (F.col("top") + F.col("bottom")) / 2, "role": label_role(F.col("text"))})


def lines_of_words(lines: DataFrame, keys: list[str], column: str = "words") -> DataFrame:
    """As ``group_words`` has it, of lines whose words (pos, text, left, top, width, height, confidence) come as one list:
    nothing is shuffled. A line is one row."""
    w = F.col(column)
    each = lambda f: F.transform(w, f)
    sure = F.filter(each(lambda x: x["confidence"]), lambda c: c.isNotNull())
    return _with_role(lines.filter(F.size(w) > 0).select(
        *keys, F.concat_ws(" ", F.transform(F.array_sort(each(lambda x: F.struct(x["pos"].alias("pos"), x["text"].alias("text")))), lambda x: x["text"])).alias("text"),
        F.when(F.size(sure) > 0, F.aggregate(sure, F.lit(0.0), lambda s, c: s + c) / F.size(sure)).alias("confidence"),
        F.array_min(each(lambda x: x["left"])).alias("left"), F.array_min(each(lambda x: x["top"])).alias("top"),
        F.array_max(each(lambda x: x["left"] + x["width"])).alias("right"), F.array_max(each(lambda x: x["top"] + x["height"])).alias("bottom"),
    ))


#: Columns of an OCR table.
TSV_COLUMNS = ("page_num", "block_num", "par_num", "line_num", "left", "top", "width", "height", "conf", "text")


def tsv_words(tsv: DataFrame, column: str = "tsv", min_confidence: float = 35.0, scale_x: float = 1.0, scale_y: float = 1.0) -> DataFrame:
    """Words of OCR tables with a header line; columns are found by their names.

    A table that lacks a column fails the job; one of fewer than two lines has no words. An empty number is 0, a confidence
    that is missing or no number is -1.
    """
    lines = F.filter(F.split(F.coalesce(F.col(column), F.lit("")), r"\r?\n"), lambda x: x != "")
    rows = tsv.withColumn("_h", F.split(F.get(lines, F.lit(0)), "\t")).select("*", F.posexplode(F.slice(lines, F.lit(2), F.greatest(F.lit(0), F.size(lines) - 1))).alias("_n", "_l"))
    cells = rows.withColumn("_c", F.split("_l", "\t"))
    cell = lambda name: F.get("_c", F.array_position("_h", name).cast("int") - 1)
    number = lambda name, other=0.0: F.when(F.trim(cell(name)) == "", F.lit(0.0)).otherwise(F.coalesce(cell(name).try_cast("double"), F.lit(other)))
    lacks = F.filter(F.array(*map(F.lit, TSV_COLUMNS)), lambda c: ~F.array_contains("_h", c))
    cells = cells.withColumn("_c", F.when(F.size(lacks) > 0, F.raise_error(F.concat(F.lit("table lacks "), F.array_join(lacks, ", "))).cast("array<string>")).otherwise(F.col("_c")))
    found = cells.select(
        *tsv.columns, F.concat_ws(":", *(cell(c) for c in ("page_num", "block_num", "par_num", "line_num"))).alias("line_id"), F.col("_n").alias("pos"), F.trim(cell("text")).alias("text"),
        (number("left") * scale_x).alias("left"), (number("top") * scale_y).alias("top"), (number("width") * scale_x).alias("width"), (number("height") * scale_y).alias("height"), number("conf", -1.0).alias("conf"),
    ).drop(column)
    return found.filter((F.col("conf") >= min_confidence) & (F.coalesce("text", F.lit("")) != "")).withColumn("confidence", F.col("conf") / 100).drop("conf")


def bbox_words(pages: DataFrame, column: str = "xhtml", lines_only: bool = True) -> DataFrame:
    """Words of embedded text (XHTML with <line> and <word xMin yMin xMax yMax>), scaled to a raster of width and height.

    Without ``lines_only`` a page that has no <line> counts as one line.
    """
    page = F.regexp_extract(column, r'(?is)<page\s[^>]*?width="([0-9.]+)"', 1), F.regexp_extract(column, r'(?is)<page\s[^>]*?height="([0-9.]+)"', 1)
    found = F.regexp_extract_all(F.col(column), F.lit(r"(?is)<line\b[^>]*>.*?</line>"), F.lit(0))
    lines = found if lines_only else F.when(F.size(found) > 0, found).otherwise(F.array(F.col(column)))
    rows = pages.withColumns({"_w": page[0].try_cast("double"), "_h": page[1].try_cast("double")}).select("*", F.posexplode(lines).alias("line_id", "_line"))
    rows = rows.select("*", F.posexplode(F.regexp_extract_all("_line", F.lit(r"(?is)<word\b[^>]*>.*?</word>"), F.lit(0))).alias("pos", "_word"))
    at = {k: F.regexp_extract("_word", rf'(?i)\b{k}="([-0-9.]+)"', 1).try_cast("double") for k in ("xMin", "yMin", "xMax", "yMax")}
    sx, sy = F.col("width") / F.col("_w"), F.col("height") / F.col("_h")
    from terraproof.functions.text import decode_html

    keep = (at["xMax"] >= at["xMin"]) & (at["yMax"] >= at["yMin"]) if lines_only else (at["xMax"] > at["xMin"]) & (at["yMax"] > at["yMin"])
    kept = [c for c in pages.columns if c not in (column, "width", "height")]
    return rows.filter(keep).select(
        *kept, "line_id", "pos", decode_html(F.col("_word")).alias("text"), (at["xMin"] * sx).alias("left"), (at["yMin"] * sy).alias("top"),
        ((at["xMax"] - at["xMin"]) * sx).alias("width"), ((at["yMax"] - at["yMin"]) * sy).alias("height"), F.lit(1.0).alias("confidence"),
    )


def nearest_anchor(candidates: DataFrame, anchors: DataFrame, within: float = ANCHOR_DISTANCE_PX) -> DataFrame:
    """Candidates (page, id, x, y, confidence) with role, label and distance of the nearest anchor on their page.

    Both sides are dealt to square cells as wide as the reach, so that a page with very many of both is many small
    joins. Distance decides, then the anchor's confidence, then its id.
    """
    cell = lambda v: F.floor(v / within)
    steps = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
    near = anchors.filter("role IS NOT NULL").select(
        F.col("page").alias("ap"), F.col("id").alias("aid"), F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("confidence").alias("ac"), "role", "label", cell(F.col("x")).alias("ci"), cell(F.col("y")).alias("cj")
    )
    wide = candidates.select("*", F.explode(steps).alias("s")).withColumns({"ki": cell(F.col("x")) + F.col("s.i"), "kj": cell(F.col("y")) + F.col("s.j")}).drop("s")
    distance = F.sqrt((F.col("x") - F.col("ax")) * (F.col("x") - F.col("ax")) + (F.col("y") - F.col("ay")) * (F.col("y") - F.col("ay")))
    pairs = wide.join(near, (F.col("page") == F.col("ap")) & (F.col("ki") == F.col("ci")) & (F.col("kj") == F.col("cj")) & (distance <= within)).withColumn("distance", distance)
    best = pairs.groupBy("page", "id").agg(F.min(F.struct("distance", (-F.col("ac")).alias("c"), "aid", "role", "label")).alias("b"))
    found = candidates.join(best, ["page", "id"], "left")
    return found.select("page", "id", F.col("b.role").alias("role"), F.col("b.label").alias("label"), F.round("b.distance", 1).alias("distance"), F.greatest("confidence", -F.col("b.c")).alias("confidence"))


def best_ride_anchor(lines: DataFrame, keys: list[str]) -> DataFrame:
    """The line that names a ride drawing: most confident, then shortest, then first in order of text."""
    from terraproof.functions.rules import PAGE_RIDE_DRAWING
    from terraproof.functions.text import has

    w = Window.partitionBy(*keys).orderBy(F.desc("confidence"), F.length("text"), "text")
    return lines.filter(has(F.col("text"), PAGE_RIDE_DRAWING)).withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def diagnostics(pages: DataFrame) -> DataFrame:
    """Counters over pages (failed, adaptive, engine)."""
    done = ~F.coalesce("failed", F.lit(False))
    engine = F.coalesce("engine", F.lit("unknown"))
    return pages.agg(
        F.count(F.lit(1)).alias("pages"), F.count_if(done).alias("completed"), F.count_if(~done).alias("failed"), F.count_if(done & F.coalesce("adaptive", F.lit(False))).alias("adaptive_raster"),
        F.count_if(done & engine.startswith("pdftotext-")).alias("embedded_text"), F.count_if(done & engine.startswith("tesseract")).alias("ocr"),
    )


def histograms(pages: DataFrame) -> DataFrame:
    """Counts by engine, renderer and dpi of completed pages and by stage of failed ones, in one pass."""
    done = ~F.coalesce("failed", F.lit(False))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("unknown"))
    pair = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))
    named = F.when(done, F.filter(F.array(pair("engine", text("engine")), pair("renderer", text("renderer")), pair("dpi", F.col("dpi").cast("string"))), lambda p: p["value"].isNotNull())).otherwise(F.array(pair("failure", text("stage"))))
    return pages.select(F.explode(named).alias("p")).groupBy("p.kind", "p.value").agg(F.count(F.lit(1)).alias("n"))


def stage_timings(calls: DataFrame) -> DataFrame:
    """Calls, failures and milliseconds by stage."""
    return calls.groupBy("stage").agg(F.count(F.lit(1)).alias("calls"), F.count_if("failed").alias("failures"), F.round(F.sum("millis"), 3).alias("total_ms"), F.round(F.max("millis"), 3).alias("max_ms"), F.round(F.avg("millis"), 3).alias("avg_ms"))
