"""Reference rasters: polylines to pixels, pixels to bit-packed tiles, tiles to PNG files.

A segment's pixels are stepped along its longer axis in whole numbers; a pixel of a thick line is a square. A tile's bits are
64 to a word; words of the lines that meet in a tile are merged by a bitwise or, partly before the shuffle, so that a crowded
tile is at most its own words. Only the encoding of a tile, of a bounded size, runs in Python.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TILE, WORD = 256, 64


def segments(lines: DataFrame, *keys: str) -> DataFrame:
    """(keys, thickness, x0, y0, x1, y1) of polylines (keys, pixels, closed, thickness); a line of one point is a segment of no length."""
    n = F.size("pixels")
    closed = F.coalesce("closed", F.lit(False)) & (n > 2)
    points = F.when(closed | (n == 1), F.concat("pixels", F.slice("pixels", 1, 1))).otherwise(F.col("pixels"))
    rows = lines.filter(n > 0).select(*keys, F.coalesce("thickness", F.lit(1)).alias("thickness"), points.alias("p"))
    rows = rows.select(*keys, "thickness", F.explode(F.zip_with(F.slice("p", F.lit(1), F.size("p") - 1), F.slice("p", F.lit(2), F.size("p") - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))).alias("s"))
    return rows.select(*keys, "thickness", *(F.col(f"s.{e}.{c}").cast("long").alias(f"{c}{k}") for k, e in enumerate("ab") for c in "xy"))


def stepped(parts: DataFrame, size: int, *keys: str) -> DataFrame:
    """(keys, x, y) of the pixels of segments on a square raster; a pixel that several segments cover comes several times.

    Steps outside the raster are left out before they are made: only the range of steps whose longer axis is on it is.
    """
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    n = F.greatest(F.abs(dx), F.abs(dy))
    flat = F.abs(dx) >= F.abs(dy)
    at, way = F.when(flat, F.col("x0")).otherwise(F.col("y0")), F.signum(F.when(flat, dx).otherwise(dy)).cast("long")
    low, high = F.when(way >= 0, -at - 8).otherwise(at - size), F.when(way >= 0, F.lit(size) - at).otherwise(at + 8)
    first, last = F.greatest(F.lit(0).cast("long"), low), F.least(n, high)
    steps = parts.withColumns({"_n": n, "_dx": dx, "_dy": dy}).withColumn("_k", F.explode(F.when(first <= last, F.sequence(first, last))))
    half = lambda d: F.expr(f"CASE WHEN _n = 0 THEN 0L ELSE (2 * {d} * _k + _n - pmod(2 * {d} * _k + _n, 2 * _n)) div (2 * _n) END")
    brush = F.explode(F.flatten(F.transform(F.sequence(F.lit(0), F.col("thickness") - 1), lambda i: F.transform(F.sequence(F.lit(0), F.col("thickness") - 1), lambda j: F.struct(i.alias("i"), j.alias("j"))))))
    made = steps.withColumns({"_x": F.col("x0") + half("_dx"), "_y": F.col("y0") + half("_dy")}).withColumn("_b", brush)
    out = made.select(*keys, (F.col("_x") + F.col("_b.i")).alias("x"), (F.col("_y") + F.col("_b.j")).alias("y"))
    return out.filter((F.col("x") >= 0) & (F.col("y") >= 0) & (F.col("x") < size) & (F.col("y") < size))


def words(pixels: DataFrame, *keys: str) -> DataFrame:
    """(keys, y, word, bits): 64 pixels of a row in a number, the leftmost its lowest bit."""
    bit = F.expr("shiftleft(1L, CAST(x % 64 AS INT))")
    return pixels.groupBy(*keys, "y", F.floor(F.col("x") / WORD).alias("word")).agg(F.bit_or(bit).alias("bits"))


def draw(lines: DataFrame, size: int, *keys: str) -> DataFrame:
    """The words of the polylines of each raster; ``keys`` name the raster. A segment that is drawn again is stepped once."""
    return words(stepped(segments(lines, *keys).distinct(), size, *keys), *keys)


def png(rows: dict[int, dict[int, int]], width: int, height: int) -> bytes:
    """A two-coloured PNG, white where no bit is set, of rows of words."""
    blank, reverse = (1 << width) - 1, {}
    for b in range(256):
        reverse[b] = int(f"{b:08b}"[::-1], 2)
    raw = bytearray()
    n = -(-width // 8)
    for y in range(height):
        bits = blank
        for w, held in rows.get(y, {}).items():
            bits &= ~((held & (1 << WORD) - 1) << w * WORD)
        raw += b"\0" + bytes(reverse[b] for b in (bits & blank).to_bytes(n, "little"))
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 1, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(bytes(raw), 9)) + chunk(b"IEND", b"")


def tiles(drawn: DataFrame, size: int, *keys: str, tile: int = TILE) -> DataFrame:
    """(keys, i, j, width, height, png) of the tiles that words touch; ``tile`` is a multiple of 64."""
    if tile % WORD:
        raise ValueError("a tile is a multiple of 64 pixels wide")
    at = drawn.withColumns({"i": F.floor(F.col("word") * WORD / tile), "j": F.floor(F.col("y") / tile)})
    held = F.struct((F.col("y") - F.col("j") * tile).cast("int").alias("y"), (F.col("word") - F.col("i") * (tile // WORD)).cast("int").alias("w"), "bits")
    each = at.groupBy(*keys, "i", "j").agg(F.collect_list(held).alias("words"))
    schema = StructType([*(each.schema[k] for k in (*keys, "i", "j")), *StructType.fromDDL("width int, height int, png binary")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for i, j, held in zip(*(batch.column(c).to_pylist() for c in ("i", "j", "words")), strict=True):
                rows: dict[int, dict[int, int]] = {}
                for x in held:
                    rows.setdefault(x["y"], {})[x["w"]] = x["bits"]
                width, height = min(tile, size - i * tile), min(tile, size - j * tile)
                made.append((width, height, png(rows, width, height)))
            columns = [pa.array([m[k] for m in made], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in (*keys, "i", "j")), *columns], names=schema.names)

    return each.mapInArrow(run, schema)


def pixel_rows(drawn: DataFrame, *keys: str) -> DataFrame:
    """(keys, x, y) of the bits of words."""
    set_bits = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda b: F.getbit(F.col("bits"), b) == 1)
    return drawn.select(*keys, "word", "y", F.explode(set_bits).alias("_b")).select(*keys, (F.col("word") * WORD + F.col("_b")).alias("x"), "y")
