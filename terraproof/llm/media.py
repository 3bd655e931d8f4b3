"""Media columns by signature sniffing.

An Aho-Corasick automaton finds the magic bytes of every known format in one pass over a binary value.
Each hit is then confirmed by a validator of that format, which walks the structure and returns the exact
length, so that a stray ``BM`` in prose is no bitmap. The hit at offset 0 corrects the declared type; the
confirmed hits behind it are the embedded media, outermost first.

Defined results: a null or empty value has type ``application/octet-stream``, length 0 and no embedded media.
Types are MIME names. ``declared_ok`` is null where no type was declared. Repeated rows give repeated results. An
empty table gives an empty result. A FLAC stream does not tell its length and reaches to the end of the value.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraproof.llm.common import release_memory, slices

UNKNOWN = "application/octet-stream"
#: Each format's magic bytes, and how far behind the format's first byte they stand.
SIGNATURES = [
    ("image/png", b"\x89PNG\r\n\x1a\n", 0),
    ("image/gif", b"GIF87a", 0),
    ("image/gif", b"GIF89a", 0),
    ("image/jpeg", b"\xff\xd8\xff", 0),
    ("image/bmp", b"BM", 0),
    ("audio/wav", b"WAVEfmt ", 8),
    ("image/webp", b"WEBPVP8", 8),
    ("audio/flac", b"fLaC\x00", 0),
    ("application/ogg", b"OggS\x00", 0),
    ("application/pdf", b"%PDF-", 0),
    ("application/zip", b"PK\x03\x04", 0),
    ("application/gzip", b"\x1f\x8b\x08", 0),
]
#: Marks that the ends of documents and archives are found by.
EOF, XREF, PDF, ZIP_END = CLOSING = (b"%%EOF", b"startxref", b"%PDF-", b"PK\x05\x06")


def _png(b: bytes, at: int) -> int:
    pos = at + 8
    while pos + 12 <= len(b):
        n = int.from_bytes(b[pos : pos + 4], "big")
        end = pos + 12 + n
        if end > len(b) or zlib.crc32(b[pos + 4 : end - 4]) != int.from_bytes(b[end - 4 : end], "big"):
            return 0
        if pos == at + 8 and b[pos + 4 : pos + 8] != b"IHDR":
            return 0
        if b[pos + 4 : pos + 8] == b"IEND":
            return end - at
        pos = end
    return 0


def _gif(b: bytes, at: int) -> int:
    def blocks(pos: int) -> int:
        while pos < len(b) and b[pos]:
            pos += 1 + b[pos]
        return pos + 1

    if at + 13 > len(b):
        return 0
    pos = at + 13 + (3 * 2 ** ((b[at + 10] & 7) + 1) if b[at + 10] & 128 else 0)
    while pos < len(b):
        if b[pos] == 0x3B:
            return pos + 1 - at
        if b[pos] == 0x21 and pos + 2 <= len(b):
            pos = blocks(pos + 2)
        elif b[pos] == 0x2C and pos + 10 <= len(b):
            pos = blocks(pos + 11 + (3 * 2 ** ((b[pos + 9] & 7) + 1) if b[pos + 9] & 128 else 0))
        else:
            return 0
    return 0


def _jpeg(b: bytes, at: int) -> int:
    pos = at + 2
    while pos + 4 <= len(b) and b[pos] == 0xFF and b[pos + 1] not in (0x00, 0xFF, 0xD8, 0xD9):
        n = int.from_bytes(b[pos + 2 : pos + 4], "big")
        if n < 2:
            return 0
        scan, pos = b[pos + 1] == 0xDA, pos + 2 + n
        while scan:
            pos = b.find(b"\xff", pos)
            if pos < 0 or pos + 2 > len(b):
                return 0
            if b[pos + 1] == 0xD9:
                return pos + 2 - at
            if b[pos + 1] and not 0xD0 <= b[pos + 1] <= 0xD7:
                break
            pos += 2
    return 0


def _bmp(b: bytes, at: int) -> int:
    if at + 30 > len(b):
        return 0
    n, reserved, start, head = struct.unpack_from("<IIII", b, at + 2)
    planes, depth = struct.unpack_from("<HH", b, at + 26)
    fits = not reserved and head in (40, 108, 124) and planes == 1 and depth in (1, 4, 8, 16, 24, 32)
    return n if fits and 14 + head <= start <= n <= len(b) - at else 0


def _riff(b: bytes, at: int) -> int:
    if at < 0 or b[at : at + 4] != b"RIFF":
        return 0
    n = 8 + int.from_bytes(b[at + 4 : at + 8], "little")
    if n < 12 or at + n > len(b):
        return 0
    pos = at + 12
    while pos + 8 <= at + n:
        size = int.from_bytes(b[pos + 4 : pos + 8], "little")
        pos += 8 + size + size % 2
    return n if pos in (at + n, at + n + 1) else 0


def _flac(b: bytes, at: int) -> int:
    pos = at + 4
    while pos + 4 <= len(b):
        last, kind, n = b[pos] & 128, b[pos] & 127, int.from_bytes(b[pos + 1 : pos + 4], "big")
        if kind > 6 or pos == at + 4 and (kind or n != 34) or pos + 4 + n > len(b):
            return 0
        pos += 4 + n
        if last:
            return len(b) - at if b[pos : pos + 1] == b"\xff" else 0
    return 0


def _ogg(b: bytes, at: int) -> int:
    pos = at
    while b[pos : pos + 5] == b"OggS\x00" and pos + 27 <= len(b):
        lacing = b[pos + 27 : pos + 27 + b[pos + 26]]
        end = pos + 27 + len(lacing) + sum(lacing)
        if len(lacing) < b[pos + 26] or end > len(b):
            break
        last, pos = b[pos + 5] & 4, end
        if last:
            break
    return pos - at


class Marks:
    """Where a value's closing marks stand, found in the pass that finds the magic bytes."""

    def __init__(self) -> None:
        self.at: dict[bytes, list[int]] = {x: [] for x in CLOSING}
        self.archives: dict[int, int] | None = None

    def next(self, mark: bytes, start: int) -> int:
        """The first place of the mark from ``start`` on, or -1."""
        held = self.at[mark]
        k = bisect_left(held, start)
        return held[k] if k < len(held) else -1


def _pdf(b: bytes, at: int, marks: Marks) -> int:
    if not b[at + 5 : at + 6].isdigit():
        return 0
    end = marks.next(EOF, at)
    if end < 0 or not 0 <= marks.next(XREF, at) < end:
        return 0
    while (more := marks.next(EOF, end + 5)) >= 0 and not 0 <= marks.next(PDF, end) < more:
        end = more
    return end + 5 - at


def _zip(b: bytes, at: int, marks: Marks) -> int:
    if marks.archives is None:  # each closing record says where its archive begins
        marks.archives = {}
        for end in marks.at[ZIP_END]:
            if end <= len(b) - 22:
                size, start, note = struct.unpack_from("<IIH", b, end + 12)
                if end + 22 + note <= len(b):
                    marks.archives.setdefault(end - size - start, end + 22 + note)
    return max(0, marks.archives.get(at, at) - at)


def _gzip(b: bytes, at: int) -> int:
    if at + 18 > len(b) or b[at + 3] & 0xE0:
        return 0
    unpack = zlib.decompressobj(31)
    try:
        pos = at
        while pos < len(b) and not unpack.eof:
            unpack.decompress(b[pos : pos + 65536])
            pos += 65536
    except zlib.error:
        return 0
    return min(pos, len(b)) - at - len(unpack.unused_data) if unpack.eof else 0


VALIDATORS: dict[str, Callable[..., int]] = {
    "image/png": _png, "image/gif": _gif, "image/jpeg": _jpeg, "image/bmp": _bmp, "audio/wav": _riff, "image/webp": _riff,
    "audio/flac": _flac, "application/ogg": _ogg, "application/pdf": _pdf, "application/zip": _zip, "application/gzip": _gzip,
}
MARKED = {"application/pdf", "application/zip"}


def build_automaton() -> ahocorasick.Automaton:
    """The automaton over all magic bytes and closing marks; bytes stand as Latin-1 characters."""
    found, named = ahocorasick.Automaton(), dict.fromkeys([m for _, m, _ in SIGNATURES] + list(CLOSING))
    for magic in named:
        kinds = [(kind, back) for kind, m, back in SIGNATURES if m == magic]
        found.add_word(magic.decode("latin-1"), (magic, kinds[0] if kinds else None))
    found.make_automaton()
    return found


def sniff(b: bytes | None, automaton: ahocorasick.Automaton) -> tuple[str, int, list[tuple[str, int, int]]]:
    """Type and length of the value itself, then (type, offset, length) of what is embedded, in order of offset.

    A hit inside an embedded medium belongs to that medium and is not reported again.
    """
    if not b:
        return UNKNOWN, 0, []
    kind, length, inside, past = UNKNOWN, len(b), [], 0
    hits, marks = [], Marks()
    for last, (magic, opens) in automaton.iter(b.decode("latin-1")):
        at = last - len(magic) + 1
        if magic in marks.at:
            marks.at[magic].append(at)
        if opens:
            hits.append((at - opens[1], opens[0]))
    for at, name in sorted(hits):
        if at < 0 or at and at < past or not (n := VALIDATORS[name](b, at, marks) if name in MARKED else VALIDATORS[name](b, at)):
            continue
        if at == 0:
            if kind == UNKNOWN:
                kind, length = name, n
        else:
            inside.append((name, at, n))
            past = at + n
    return kind, length, inside


SPAN = pa.struct([("type", pa.string()), ("start", pa.int64()), ("length", pa.int64())])
SNIFFED = {"type": pa.string(), "declared_ok": pa.bool_(), "length": pa.int64(), "embedded": pa.list_(SPAN)}


def sniff_batches(batches: Iterator[pa.RecordBatch], content: str, declared: str | None, carve: bool = False) -> Iterator[pa.RecordBatch]:
    """Each batch with the columns of SNIFFED behind its own and, with ``carve``, the embedded bytes."""
    automaton = build_automaton()
    for part in slices(batches, content):
        found, values = [], part.column(content).to_pylist()
        for b, said in zip(values, part.column(declared).to_pylist() if declared else [None] * len(part), strict=True):
            kind, n, inside = sniff(b, automaton)
            found.append((kind, None if said is None else said == kind, n, [dict(zip(("type", "start", "length"), x, strict=True)) for x in inside]))
        for (name, to), x in zip(SNIFFED.items(), zip(*found, strict=True), strict=True):
            part = part.append_column(name, pa.array(x, to))
        if carve:
            cuts = [[b[s["start"] : s["start"] + s["length"]] for s in inside] for b, (*_, inside) in zip(values, found, strict=True)]
            part = part.append_column("carved", pa.array(cuts, pa.list_(pa.binary())))
        yield part
    release_memory()


def sniff_media(df: DataFrame, id_col: str, content_col: str, declared_col: str | None = None, carve: bool = False) -> DataFrame:
    """One row per input row: id, type, declared_ok, length, embedded and, with ``carve``, the embedded bytes.

    Other input columns are not looked at, so their names cannot clash.
    """
    rows = df.select(F.col(id_col).alias("_id"), F.col(content_col).alias("_content"), (F.col(declared_col) if declared_col else F.lit(None)).cast("string").alias("_declared"))
    kept = ["_id", *SNIFFED, *["carved"] * carve]
    schema = f"_id {rows.schema['_id'].dataType.simpleString()}, type string, declared_ok boolean, length long, embedded array<struct<type:string,start:long,length:long>>" + ", carved array<binary>" * carve

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sniff_batches(batches, "_content", "_declared", carve):
            yield part.select(kept)

    return rows.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def to_wav(payload: bytes, rate: int = 8000) -> bytes:
    """One channel of unsigned 8-bit samples; the payload's length is even, so no pad byte is needed."""
    return b"RIFF" + struct.pack("<I", 36 + len(payload)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, rate, 1, 8) + b"data" + struct.pack("<I", len(payload)) + payload


def wav_chunks(b: bytes) -> dict[bytes, tuple[int, int]]:
    """Start and length of each chunk's body."""
    found, pos = {}, 12
    while pos + 8 <= len(b):
        n = int.from_bytes(b[pos + 4 : pos + 8], "little")
        found.setdefault(b[pos : pos + 4], (pos + 8, n))
        pos += 8 + n + n % 2
    return found
