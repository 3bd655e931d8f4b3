"""SimHash near-duplicates by anchor-point covering.

A fingerprint's bits are cut into blocks, each with a perfect code: two Golay codes of 23 bits (covering radius 3),
one Hamming code of 15 bits and one of 3 bits (radius 1). The anchors are the codewords of their direct sum. Every
fingerprint has exactly one home anchor within the covering radius of each block; it is replicated to every anchor
within covering radius plus threshold, where the steps beyond the radius, summed over the blocks, are at most the
threshold. If two fingerprints differ in no more bits than that, the home anchor of the one is among the anchors of
the other, so comparing home rows with replicas, anchor by anchor, finds every link, and finds it once per
direction. Equal fingerprints are merged first; links are then joined into components.

Two blocks give 2**24 anchors and about 60 replicas, all four 2**36 and about 170. The number of distinct
fingerprints decides which are used (``blocks``); both are exact, so the choice only moves work.

Defined results: a null text is the empty text and has fingerprint zero. Equal texts and repeated rows share a
component. A component is named by the smallest id in it; null ids are passed over, and a component of null ids
only is named null. An empty table gives an empty result. Input columns other than the named ones are not looked at,
whatever their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from terraproof.llm.common import cut, release_memory, slices
from terraproof.llm.components import connected_components

SEED = 42
#: Fixed value: generator polynomial of the binary Golay code of length 23.
GOLAY = 0b110001110101
MAX_STEPS = 2
ROWS_AT_ONCE = 1 << 17


def fingerprints(texts: list[str | None], width: int = 3) -> np.ndarray:
    """Fingerprints as signed 64-bit numbers: a bit is set if it is set in over half of the shingles' hashes."""
    ones, totals = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    held: list[bytes] = []
    owners: list[int] = []
    sizes: list[int] = []

    def flush() -> None:
        if held:
            bits = np.unpackbits(np.frombuffer(b"".join(held), np.uint8).reshape(-1, 8), axis=1)
            starts = np.cumsum([0, *sizes[:-1]])
            np.add.at(ones, owners, np.add.reduceat(bits, starts, axis=0, dtype=np.int64))
            np.add.at(totals, owners, sizes)
            for x in (held, owners, sizes):
                x.clear()

    digest, blank = xxhash.xxh64_digest, b" ".join
    waiting = 0
    for k, text in enumerate(texts):
        words = text.encode().lower().split() if text else []
        if not words:
            continue
        for at in range(0, max(1, len(words) - width + 1), ROWS_AT_ONCE):
            part = words[at : at + ROWS_AT_ONCE + width - 1]
            if len(part) <= width:
                found = [digest(blank(part), SEED)]
            else:
                found = [digest(blank(x), SEED) for x in zip(*(part[i:] for i in range(width)), strict=False)]
            held.append(b"".join(found))
            owners.append(k)
            sizes.append(len(found))
            waiting += len(found)
            if waiting >= ROWS_AT_ONCE:
                flush()
                waiting = 0
    flush()
    return np.packbits(2 * ones > totals[:, None], axis=1).view(">i8").ravel().astype(np.int64)


def with_fingerprint(df: DataFrame, text_col: str, name: str, width: int = 3, keep_text: bool = True) -> DataFrame:
    """``df`` and the fingerprint of each text as a long; without ``keep_text`` the text stays behind."""
    kept = [x for x in df.schema if keep_text or x.name != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            found = pa.array(fingerprints(part.column(text_col).to_pylist(), width))
            yield pa.RecordBatch.from_arrays([*(part.column(x.name) for x in kept), found], names=[*(x.name for x in kept), name])
        release_memory()

    return df.mapInArrow(run, StructType([*kept, StructField(name, LongType())]))


def fingerprint_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


class PerfectCode:
    """For each syndrome the error patterns of weight radius + e, for e up to MAX_STEPS.

    e = 0 holds the patterns up to the radius; there is exactly one for each syndrome.
    """

    def __init__(self, columns: list[int], radius: int):
        self.length = len(columns)
        self.table = np.zeros(1 << self.length if self.length <= 12 else 1 << 12, np.int64)
        self.columns = columns
        found: list[dict[int, list[int]]] = [{} for _ in range(MAX_STEPS + 1)]
        for weight in range(min(self.length, radius + MAX_STEPS) + 1):
            for places in combinations(range(self.length), weight):
                syndrome, pattern = 0, 0
                for p in places:
                    syndrome ^= columns[p]
                    pattern |= 1 << p
                found[max(0, weight - radius)].setdefault(syndrome, []).append(pattern)
        count = max(found[0]) + 1
        self.starts, self.counts, self.patterns = [], [], []
        for by in found:
            counts = np.array([len(by.get(s, ())) for s in range(count)], np.int64)
            self.counts.append(counts)
            self.starts.append(np.cumsum(counts) - counts)
            self.patterns.append(np.array([p for s in range(count) for p in by.get(s, ())], np.int64))

    def syndromes(self, words: np.ndarray) -> np.ndarray:
        out = np.zeros(len(words), np.int64)
        for i, c in enumerate(self.columns):
            out ^= ((words >> i) & 1) * c
        return out


def _golay_columns() -> list[int]:
    out, x = [], 1
    for _ in range(23):
        out.append(x)
        x <<= 1
        if x >> 11:
            x ^= GOLAY
    return out


@lru_cache(maxsize=2)
def blocks_of(count: int) -> list[tuple[int, PerfectCode]]:
    """(first bit, code) of the first 2 or of all 4 blocks."""
    golay = PerfectCode(_golay_columns(), 3)
    out = [(0, golay), (23, golay)]
    if count == 4:
        out += [(46, PerfectCode(list(range(1, 16)), 1)), (61, PerfectCode([1, 2, 3], 1))]
    return out


def anchors(prints: np.ndarray, steps: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the fingerprint, anchor) of every anchor within the covering radius plus ``steps``."""
    plan = blocks_of(blocks)
    used = np.int64(-1) if blocks == 4 else np.int64((1 << 46) - 1)
    syndromes = [code.syndromes((prints >> at) & ((1 << code.length) - 1)) for at, code in plan]
    owners, found = [], []
    for excess in product(range(steps + 1), repeat=len(plan)):
        if sum(excess) > steps:
            continue
        owner, error = np.arange(len(prints)), np.zeros(len(prints), np.int64)
        for (at, code), syndrome, e in zip(plan, syndromes, excess, strict=True):
            s = syndrome[owner]
            n = code.counts[e][s]
            again = np.repeat(np.arange(len(owner)), n)
            nth = np.arange(len(again)) - np.repeat(np.cumsum(n) - n, n)
            pattern = code.patterns[e][code.starts[e][s[again]] + nth] if len(again) else np.zeros(0, np.int64)
            owner, error = owner[again], error[again] ^ (pattern << at)
        owners.append(owner)
        found.append((prints[owner] ^ error) & used)
    return np.concatenate(owners), np.concatenate(found)


def _anchored(df: DataFrame, steps: int, blocks: int, names: tuple[str, str, str]) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            prints, components = pdf["fp"].to_numpy(), pdf["component"].to_numpy()
            for at in range(0, len(prints), 4096):
                owner, anchor = anchors(prints[at : at + 4096], steps, blocks)
                yield pd.DataFrame({names[0]: anchor, names[1]: prints[at + owner], names[2]: components[at + owner]})

    return df.select("fp", "component").mapInPandas(run, ", ".join(f"{x} long" for x in names))


def near_links(prints: DataFrame, threshold: int = 2, blocks: int = 2) -> DataFrame:
    """Links (a, b), a < b, of the components of distinct fingerprints ``fp`` that differ in at most ``threshold`` bits.

    Fingerprints of one ``component`` are not linked again. Beyond MAX_STEPS both sides go some steps past the radius,
    which together make the threshold: some word lies that near to both, and its home anchor is an anchor of both. Such
    a link may be found more than once.
    """
    if not 0 <= threshold <= 2 * MAX_STEPS:
        raise ValueError(f"threshold is between 0 and {2 * MAX_STEPS}")
    steps = min(threshold, MAX_STEPS)
    home = _anchored(prints, threshold - steps, blocks, ("anchor", "a", "of_a"))
    copies = _anchored(prints, steps, blocks, ("anchor_b", "b", "of_b"))
    apart = (F.col("a") < F.col("b")) & (F.col("of_a") != F.col("of_b"))
    near = (F.col("anchor") == F.col("anchor_b")) & apart & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= threshold)
    return home.hint("merge").join(copies, near).select(F.least("of_a", "of_b").alias("a"), F.greatest("of_a", "of_b").alias("b"))


def near_duplicates(df: DataFrame, id_col: str, text_col: str, threshold: int = 2, width: int = 3) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, classes, heads): rows has id and ``fp`` of each input row; classes has for each ``fp`` its component_id,
    the fingerprints (``n_prints``) and rows (``n_rows``) of the component; heads has for each component its
    component_id and a ``fp`` that a row of that id has. Two components may bear the same id, where rows repeat it.

    A threshold beyond MAX_STEPS is reached in two rounds: the second links what the first left apart, so that a dense
    cluster of fingerprints, one component after the first round, does not give all of its pairs.
    """
    rows = cut(with_fingerprint(df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), "_text", "fp", width, keep_text=False))
    # dealt out evenly, as each print becomes many rows
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    prints = rows.groupBy("fp").agg(F.min("_id").alias("least"), F.count(F.lit(1)).alias("n"), F.first("fp").alias("component"))
    prints = cut(prints.repartition(parts, "fp"))
    blocks = 2 if prints.count() <= 1 << 24 else 4
    for reach in sorted({min(threshold, MAX_STEPS), threshold}):
        linked = connected_components(near_links(prints, reach, blocks)).withColumnRenamed("component", "_to")
        joined = prints.join(linked, prints["component"] == linked["node"], "left").select("fp", "least", "n", F.coalesce("_to", "component").alias("component"))
        prints = cut(joined.repartition(parts, "fp"))
    # partial sums first: a component of very many fingerprints is no single group of rows in one task
    first = F.min(F.struct(F.col("least").isNull().alias("nameless"), "least", "fp")).alias("_first")
    heads = cut(prints.groupBy("component").agg(first, F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n_prints"), F.sum("n").alias("n_rows")))
    classes = cut(prints.select("fp", "component").join(heads, "component").select("fp", "component_id", "n_prints", "n_rows"))
    return rows, classes, heads.select("component_id", F.col("_first.fp").alias("fp"))


def label_near_duplicates(df: DataFrame, id_col: str, text_col: str, threshold: int = 2, width: int = 3) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id, n_prints, n_rows."""
    rows, classes, _ = near_duplicates(df, id_col, text_col, threshold, width)
    out = rows.join(classes, "fp").select(F.col("_id").alias(id_col), fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id", "n_prints", "n_rows")
    return out


def keep_one(df: DataFrame, id_col: str, text_col: str, threshold: int = 2, width: int = 3) -> DataFrame:
    """The rows of ``df`` without near duplicates: of each component one row with its smallest id stays.

    Where several rows of a component carry that id, one of those with its head's fingerprint stays; where all ids of a
    component are null, one of its rows. Rows that share an id but not a component are apart, and all stay.
    """
    rows, _, heads = near_duplicates(df, id_col, text_col, threshold, width)
    counts = rows.filter("_id IS NOT NULL").groupBy("_id").agg(F.count(F.lit(1)).alias("_n"))
    named = cut(heads.filter("component_id IS NOT NULL").join(counts, F.col("component_id") == F.col("_id")).select("_id", "fp", "_n"))
    first = df.join(named.filter("_n = 1").select(F.col("_id").alias(id_col)), id_col, "left_semi")
    # ids that occur again, and rows without one, are told apart by their fingerprints
    mark = f"fp_{uuid.uuid4().hex}"  # clashes with no input column
    often = named.filter("_n > 1").select(F.col("_id").alias(id_col), F.col("fp").alias(mark))
    again = with_fingerprint(df.join(often.select(id_col).distinct(), id_col, "left_semi").select(*df.columns), text_col, mark, width)
    again = again.join(often, [id_col, mark], "left_semi").dropDuplicates([id_col, mark])
    nameless = with_fingerprint(df.filter(F.col(id_col).isNull()), text_col, mark, width)
    rest = nameless.join(heads.filter("component_id IS NULL").select(F.col("fp").alias(mark)), mark, "left_semi").dropDuplicates([mark])
    return first.select(*df.columns).unionByName(again.select(*df.columns)).unionByName(rest.select(*df.columns))
