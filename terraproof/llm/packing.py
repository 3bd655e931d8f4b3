"""Sequence packing: first-fit decreasing with a tournament tree, in randomised groups of documents.

Documents become token ids plus one closing id. A document longer than a sequence is cut at multiples of the
capacity: its full pieces fill sequences of their own, and only the rests, one for each document at most, have to be
packed. The rests are dealt by a random number into groups of about ``group_size``; within a group, first-fit
decreasing asks a tournament tree over the bins' free space for the leftmost bin that still fits, in logarithmic
time. Groups are independent and their number follows the number of rests, so one group is one bounded task however
many equal rows there are, and only numbers travel: the ids themselves never leave the task that makes them.

Defined results: a null text is the empty text and becomes the closing id alone. Null ids are kept. Repeated rows are
packed as often as they occur. Ties in length are broken by id, start and digest. An empty table gives an empty
result. Input columns other than the named ones are not looked at. Sequence ids are unique: of a group the group's
number times 2**32 plus the bin's, of a full piece 2**62 plus the task's number times 2**32 plus the piece's.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from terraproof.llm.cache import Recent, byte_letters
from terraproof.llm.common import cut, release_memory, slices

#: Fixed value: how this vocabulary's files split text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: At most one blank and letters, then signs that make one pre-token.
PLAIN = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
#: Sequences of full pieces are numbered from here.
FULL = 1 << 62
PIECES = "start long, length long, ids_crc32 long, doc_tokens long"


class ByteBpe:
    """Ids of a text by a byte-level vocabulary, through a bounded cache of its parts.

    A new part made of at most one blank, Western European letters and a tail of ASCII signs without apostrophe is
    two pre-tokens at most and goes to the library's merge model directly; others go through its whole chain.

    A blank or line feed between two visible characters always begins a new pre-token, so that a text without
    adjacent white space is cut there. Other texts are cut by the pattern itself. Texts that hold a special
    token go to the library whole.
    """

    def __init__(self, path: str, cache: int = 400_000):
        self.tokenizer, self.letters = Tokenizer.from_file(path), byte_letters()
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.pattern, self.adjacent = regex.compile(PATTERN), re.compile(r"\s\s|\x00|[\x1c-\x1f\x85]")
        self.known, self.cores = Recent(cache), Recent(cache)
        self.known.put("", b"")

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _core(self, text: str) -> bytes:
        """One pre-token."""
        found = self.cores.young.get(text) or self.cores.old_or_none(text)
        if found is None:
            letters = text.replace(" ", self.letters[32]) if text.isascii() else text.encode().decode("latin-1").translate(self.letters)
            found = array("I", [x.id for x in self.tokenizer.model.tokenize(letters)]).tobytes()
            self.cores.put(text, found)
        return found

    def _new(self, part: str) -> bytes:
        if plain := PLAIN.fullmatch(part):
            return self._core(plain[1]) + self._core(plain[2]) if plain[2] else self._core(plain[1])
        return self._whole(part) if part else b""

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if any(x in text for x in self.special):
            return self._whole(text)
        if self.adjacent.search(text):
            parts = self.pattern.findall(text)
        else:
            parts = text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00").split("\x00")
        found = list(map(self.known.young.get, parts))
        if None in found:
            young = self.known.young
            for k, b in enumerate(found):
                if b is None:
                    part = parts[k]
                    b = young.get(part)
                    if b is None:
                        b = self.known.old_or_none(part)
                    found[k] = b = self._new(part) if b is None else b
                    if len(part) <= 64:
                        young[part] = b
            self.known.turn()
            self.cores.turn()
        return b"".join(found)


@lru_cache(maxsize=1)
def encoder(path: str, cache: int) -> ByteBpe:
    return ByteBpe(path, cache)


class Bins:
    """Free space of the opened bins in a tournament tree: each node holds the larger of its children."""

    def __init__(self, most: int, capacity: int):
        self.size = 1 << max(1, most - 1).bit_length()
        self.tree, self.capacity, self.opened = [0] * (2 * self.size), capacity, 0

    def _put(self, node: int, free: int) -> None:
        tree = self.tree
        tree[node] = free
        while node > 1:
            node >>= 1
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) in the leftmost opened bin that fits, else in a new one."""
        tree = self.tree
        if tree[1] < length:
            node = self.size + self.opened
            self.opened += 1
            self._put(node, self.capacity - length)
            return node - self.size, 0
        node = 1
        while node < self.size:
            node *= 2
            if tree[node] < length:
                node += 1
        free = tree[node]
        self._put(node, free - length)
        return node - self.size, self.capacity - free


def pack(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each piece, given in order of falling length."""
    bins = Bins(len(lengths), capacity)
    return [bins.place(n) for n in lengths]


def tokenize(df: DataFrame, id_col: str, text_col: str, path: str, capacity: int, closing: int, cache: int, seed: int) -> DataFrame:
    """One row per piece: id, start, length, digest of its ids, tokens of its document, and its ``_slot``.

    The slot of a full piece numbers the full pieces of the task; that of a rest is a random number, made of the piece,
    the task and how many like it came before, so that equal rows part and a task that is run again gives the same.
    """
    rows = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    end = np.array([closing], "<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, task, full, seen = encoder(path, cache), TaskContext.get().partitionId(), 0, Counter()
        for part in slices(batches, "_text"):
            ids, out = part.column("_id"), []
            for k, (doc, text) in enumerate(zip(ids.to_pylist(), part.column("_text").to_pylist(), strict=True)):
                b = e.encode(text) + end
                n = len(b) // 4
                for start in range(0, n, capacity):
                    piece = b[4 * start : 4 * (start + capacity)]
                    digest = zlib.crc32(piece)
                    if len(piece) == 4 * capacity:
                        slot, full = (task << 32) + full, full + 1
                    else:
                        like = f"{doc} {start} {digest} {n}"
                        slot = xxhash.xxh64_intdigest(f"{task} {seen[like]} {like}", seed) >> 2
                        seen[like] += 1
                    out.append((k, start, len(piece) // 4, digest, n, slot))
            at, *rest = map(pa.array, zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([ids.take(at), *rest], names=["_id", "start", "length", "ids_crc32", "doc_tokens", "_slot"])
        release_memory()

    return rows.mapInArrow(pieces, f"_id {rows.schema['_id'].dataType.simpleString()}, {PIECES}, _slot long")


def pack_documents(df: DataFrame, id_col: str, text_col: str, path: str, capacity: int = 1024, closing: int = 0, group_size: int = 4096, seed: int = 17, cache: int = 400_000) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    The pieces, numbers only, are written to the checkpoint folder, so that texts are read once and the rests can be
    counted. ``cache`` bounds the known parts of texts that a worker keeps, about 100 MB at the default; fewer cost time.
    """
    found = cut(tokenize(df, id_col, text_col, path, capacity, closing, cache, seed))
    rests = found.filter(F.col("length") < capacity)
    groups = max(1, -(-rests.count() // group_size))
    id_type = found.schema["_id"].dataType.simpleString()

    def one_group(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        placed = pack(pdf["length"].tolist(), capacity)
        base = int(key[0]) << 32
        return pdf.drop(columns=["_group", "_slot"]).assign(sequence_id=[base + b for b, _ in placed], offset=[o for _, o in placed])

    dealt = rests.withColumn("_group", F.col("_slot") % groups)
    packed = dealt.groupBy("_group").applyInPandas(one_group, f"_id {id_type}, {PIECES}, sequence_id long, offset long")
    alone = (F.col("_slot") + F.lit(FULL)).alias("sequence_id")
    full = found.filter(F.col("length") == capacity).select("_id", "start", "length", "ids_crc32", "doc_tokens", alone, F.lit(0).cast("long").alias("offset"))
    return full.unionByName(packed).withColumnRenamed("_id", id_col)
