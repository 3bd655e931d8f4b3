"""Query of operator 7: texts stored as samples, found again by their signature."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraproof.llm.common import slices, table
from terraproof.llm.media import sniff_batches, to_wav, wav_chunks

UNIT = 576
RESULT = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """UTF-8 bytes, filled up with 255 to a positive multiple of UNIT, as the samples of a WAV file.

    The stored form is declared as ``image/png`` on purpose: the operator has to correct it.
    """
    for part in slices(batches, "text", 1 << 20):
        held = [x.encode("utf-8", "surrogatepass") for x in part.column("text").to_pylist()]
        media = [to_wav(b.ljust(max(1, -(-len(b) // UNIT)) * UNIT, b"\xff")) for b in held]
        columns = [part.column("doc_id"), pa.array(list(map(len, held))), pa.array(media, pa.binary()), pa.array(["image/png"] * len(part))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "media", "declared"])


def read_back(b: bytes) -> tuple:
    """What the stored bytes themselves say: the samples come out of the data chunk."""
    chunks = wav_chunks(b)
    (fmt, _), (start, n) = chunks[b"fmt "], chunks[b"data"]
    samples = memoryview(b)[start : start + n]
    channels, rate, bits = (int.from_bytes(b[fmt + i : fmt + i + k], "little") for i, k in ((2, 2), (4, 4), (14, 2)))
    return n, hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-32:]), len(b), hashlib.sha256(b).hexdigest(), f"channels={channels};rate={rate};bits={bits};frames={n}"


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The contract's columns; ``feature`` is what sniffing says of the stored form."""
    names = [x.split()[0] for x in RESULT.split(", ")]
    for part in batches:
        rows = []
        for x in part.select(["media", "type", "declared_ok", "length", "embedded"]).to_pylist():
            *found, form = read_back(x["media"])
            spans = ",".join(f"{s['type']}@{s['start']}+{s['length']}" for s in x["embedded"])
            rows.append((*found, f"{x['type']};declared_ok={str(x['declared_ok']).lower()};length={x['length']};{form};embedded={spans}"))
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("n_bytes"), *map(pa.array, zip(*rows, strict=True))], names=names)


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored, sniffed and read back in one pass, few texts at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return digests(sniff_batches(store(batches), "media", "declared"))

    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return docs.mapInArrow(run, RESULT)
