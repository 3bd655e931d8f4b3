"""Spelling variants: words one edit apart, found in a forward and a reversed sorted dictionary.

Let l be the length of the shorter of two near words (l = both lengths for a replaced character). One edit leaves the
first or the last half of l characters intact, so near words share a prefix block of the forward dictionary or a suffix
block of the reversed one. A block is written as a window [a, b) of l: its words agree in the first a and the last l - b
characters and the edit lies between. Words of length l and l + 1 meet in a block of l. Blocks of more than ``most_rows``
words are subdivided: their window is halved, and each word goes into both halves, until blocks are small or the window
is one character wide, where the alphabet bounds the block. Blocks are then scanned range by range, each short word
against those behind it, and every candidate is verified.

Each pair is found in one block only: it goes to the right half of a split if its common prefix reaches the split, else to
the left half; so in a block with b < l a pair counts if its common prefix ends before b. A word's rows carry the counts of
whole blocks, never pairs. Sizes of blocks are counted with partial counts. The list of large blocks is broadcast if it is
counted to have at most MOST_BROADCAST rows, some MB; a longer one is joined with the words by block and salt, so that one
block with a third of all words is no hot partition.

Defined results: a null text has no words; a null id is written as the empty text. Repeated rows count as occurrences. Ties
of the largest n go to the smallest word in code-point order. Without words the result is empty. Input columns other than
the named ones are not looked at.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraproof.llm.common import ensure_checkpoint_dir, forget_files, release_memory

#: Fixed value: the letters of a run, after A-Z are lower-cased.
RUN = r"[a-zÀ-ÿ]"
MIN_LENGTH, MIN_COUNT, DROP_ONE_IN, FORM_RATIO = 7, 2, 31, 10
SALTS = 16
MOST_BROADCAST = 100_000
PAIR_BYTES = 8 << 20
FOUND = "word string, near long, best_n long, best string"


def occurrences(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(word) of each run that is long enough, one character fewer where the hash of id and run says so."""
    text = F.translate(F.col(text_col).cast("string"), ascii_uppercase, ascii_lowercase)
    runs = df.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"), F.explode(F.regexp_extract_all(text, F.lit(RUN + "{%d,}" % MIN_LENGTH), F.lit(0))).alias("run"))
    hashed = F.crc32(F.concat("_id", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return runs.withColumn("h", hashed).select(F.when(F.col("h") % DROP_ONE_IN == 0, less).otherwise(F.col("run")).alias("word")).filter(F.length("word") >= MIN_LENGTH)


def _block(word: Column, length: Column, a: Column, b: Column) -> Column:
    """Number of the block. Two blocks of one number are told apart when candidates are verified."""
    tail = length - b
    return F.xxhash64(length, a, b, F.substring(word, F.lit(1), a), F.when(tail > 0, F.substring(word, F.length(word) - tail + 1, tail)).otherwise(""))


def _with_windows(df: DataFrame, windows: Column) -> DataFrame:
    """A row for each (length, a, b) of ``windows``, with its block."""
    rows = df.select("word", "n", F.explode(windows).alias("_w")).select("word", "n", "_w.length", "_w.a", "_w.b")
    return rows.withColumn("block", _block(F.col("word"), F.col("length"), F.col("a"), F.col("b")))


def _window(length: Column, a: Column, b: Column) -> Column:
    return F.struct(length.cast("int").alias("length"), a.cast("int").alias("a"), b.cast("int").alias("b"))


def dictionaries(words: DataFrame) -> DataFrame:
    """The words' rows in prefix blocks of the forward and suffix blocks of the reversed dictionary."""
    n, zero = F.length("word"), F.lit(0)
    half = lambda x: F.floor(x / 2)
    of = lambda x: F.array(_window(x, half(x), x), _window(x, zero, half(x)))
    return _with_windows(words, F.when(n > MIN_LENGTH, F.concat(of(n), of(n - 1))).otherwise(of(n)))


def halved(rows: DataFrame) -> DataFrame:
    length, a, b = F.col("length"), F.col("a"), F.col("b")
    middle = F.floor((a + b) / 2)
    return _with_windows(rows, F.array(_window(length, middle, b), _window(length, a, middle)))


def subdivided(words: DataFrame, most_rows: int, home: str) -> DataFrame:
    """Rows of ``words`` in blocks of at most ``most_rows`` words, or whose window is one character wide."""
    spark = words.sparkSession
    salt = F.pmod(F.xxhash64("word"), F.lit(SALTS)).cast("int")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    rows, done, level = dictionaries(words), [], 0
    while True:
        large = f"{home}/large-{level}"
        rows.filter(F.col("b") - F.col("a") > 1).groupBy("block").count().filter(F.col("count") > most_rows).select("block").write.parquet(large)
        blocks = spark.read.schema("block long").parquet(large)
        n_large = blocks.count()
        if not n_large:
            done.append(rows)
            break
        split = F.lit(True).alias("split")
        if n_large <= MOST_BROADCAST:
            marked = rows.join(F.broadcast(blocks.select("block", split)), "block", "left")
        else:
            marked = rows.withColumn("salt", salt).join(blocks.select("block", salts.alias("salt"), split).hint("merge"), ["block", "salt"], "left")
        marked = marked.withColumn("split", F.coalesce("split", F.lit(False)) & (F.col("b") - F.col("a") > 1))
        done.append(marked.filter(~F.col("split")).select(*rows.columns))
        at = f"{home}/rows-{level}"
        halved(marked.filter("split")).write.parquet(at)
        rows, level = spark.read.parquet(at), level + 1
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def _common(x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Length of the common beginning of rows i and j of a matrix of characters."""
    apart = x[i] != x[j]
    return np.where(apart.any(1), apart.argmax(1), x.shape[1])


def near_pairs(words: list[bytes], length: int, a: np.ndarray, b: np.ndarray, block: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions of near words in whole blocks of one length, sorted by block, the shorter words first."""
    sizes = np.array(list(map(len, words)))
    forward = np.array(words, f"S{length + 1}").view(np.uint8).reshape(len(words), length + 1)
    backward = np.array([w[::-1] for w in words], f"S{length + 1}").view(np.uint8).reshape(len(words), length + 1)
    edges = np.flatnonzero(np.diff(block)) + 1
    ends = np.repeat(np.append(edges, len(words)), np.diff(np.concatenate(([0], edges, [len(words)]))))
    counts = np.where(sizes == length, ends - np.arange(len(words)) - 1, 0)
    done = np.cumsum(counts)
    at_once, low = max(1, PAIR_BYTES // (length + 1)), 0
    while low < len(words):
        before = done[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(done, before + at_once, side="right")))
        mine = counts[low:high]
        i = np.repeat(np.arange(low, high), mine)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(mine) - mine, mine)
        head, tail = _common(forward, i, j), _common(backward, i, j)
        near = head + tail >= np.maximum(sizes[i], sizes[j]) - 1
        here = (head >= a[i]) & (tail >= length - b[i]) & ((b[i] == length) | (head < b[i])) & (a[i] == a[j]) & (b[i] == b[j])
        found = near & here
        yield i[found], j[found]
        low = high


def _scan(rows: list[tuple]) -> pa.RecordBatch | None:
    """What the blocks of ``rows`` (word, n, length, a, b, block) tell each word; the blocks are whole and of one length."""
    words = [r[0].encode("latin-1") for r in rows]
    n, a, b, block = (np.array([r[k] for r in rows], np.int64) for k in (1, 3, 4, 5))
    pairs = list(near_pairs(words, rows[0][2], a, b, block))
    left, right = np.concatenate([i for i, _ in pairs]), np.concatenate([j for _, j in pairs])
    if not len(left):
        return None
    of, other = np.concatenate([left, right]), np.concatenate([right, left])
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[other], -n[other], of))
    of, other = of[order], other[order]
    first = np.flatnonzero(np.append(True, np.diff(of) > 0))
    near = np.diff(np.append(first, len(of)))
    columns = [[rows[i][0] for i in of[first]], near, n[other[first]], [rows[i][0] for i in other[first]]]
    return pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["word", "near", "best_n", "best"])


def scan_blocks(batches: Iterator[pa.RecordBatch], at_once: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Rows sorted by length and block; as many whole blocks at once as have some ``at_once`` rows."""
    held: list[tuple] = []

    def scanned(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        low = 0
        while low < len(rows):  # by length, as the matrices are as wide as their words
            high = next((k for k in range(low, len(rows)) if rows[k][2] != rows[low][2]), len(rows))
            found = _scan(rows[low:high])
            if found is not None:
                yield found
            low = high

    for batch in batches:
        for row in zip(*(batch.column(x).to_pylist() for x in ("word", "n", "length", "a", "b", "block")), strict=True):
            if held and row[5] != held[-1][5] and (len(held) >= at_once or len(held) * held[-1][2] >= PAIR_BYTES):
                yield from scanned(held)
                held = []
            held.append(row)
    if held:
        yield from scanned(held)
    release_memory()


def near_words(words: DataFrame, most_rows: int, home: str) -> DataFrame:
    """(word, n_near, best_n, best) of each of ``words`` (word, n) that has a near word; best is the one of largest n."""
    rows = subdivided(words, most_rows, home)
    dealt = rows.repartition("block").sortWithinPartitions("length", "block", F.length("word"), F.when(F.col("a") == 0, F.reverse("word")).otherwise(F.col("word")))
    found = dealt.mapInArrow(scan_blocks, FOUND)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("_best")).select("word", "n_near", (-F.col("_best.less")).alias("best_n"), F.col("_best.word").alias("best"))


def group_variants(df: DataFrame, id_col: str, text_col: str, most_rows: int = 64) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root, as a table in the checkpoint folder.

    ``root`` is where the forms lead. n grows at least tenfold with each step, so the longest chain follows from the
    largest n, and pointers double their reach in each of a few joins. A form has at most some thousand near words,
    whatever the corpus, so no key of those joins is hot.
    """
    spark = df.sparkSession
    home = f"{ensure_checkpoint_dir(spark)}/spelling-{uuid.uuid4().hex}"
    result = f"{home}-result"
    try:
        occurrences(df, id_col, text_col).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_COUNT).write.parquet(f"{home}/words")
        words = spark.read.schema("word string, n long").parquet(f"{home}/words")
        near_words(words, most_rows, home).write.parquet(f"{home}/near")
        near = spark.read.schema("word string, n_near long, best_n long, best string").parquet(f"{home}/near")
        leads_on = F.coalesce(F.col("best_n") >= FORM_RATIO * F.col("n"), F.lit(False))
        formed = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(leads_on, F.col("best")).alias("form"), F.when(leads_on, F.col("best_n")).alias("form_n"))
        steps = math.log10(max(1.0, (formed.agg(F.max("form_n")).first()[0] or 0) / MIN_COUNT))
        leads = formed.filter(F.col("form").isNotNull()).select(F.col("word").alias("_from"), F.col("form").alias("root"))
        for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
            farther = leads.select(F.col("_from").alias("_next"), F.col("root").alias("_root"))
            leads = leads.join(farther, F.col("root") == F.col("_next"), "left").select("_from", F.coalesce("_root", "root").alias("root"))
        rooted = formed.join(leads, F.col("word") == F.col("_from"), "left")
        rooted.select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")).write.parquet(result)
    finally:
        forget_files(spark, home)
    return spark.read.schema("word string, n long, n_near long, form string, form_n long, root string").parquet(result)
