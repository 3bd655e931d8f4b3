"""Language-model scoring by a probabilistic suffix tree over words.

Texts become tokens: words with A-Z lower-cased, then one end. The root of the tree is the add-one unigram over all
training tokens. Deeper states are contexts of up to ``depth`` tokens; a context is kept where the distribution of
its next tokens diverges from that of its longest kept suffix by at least ``gain`` nats a token, and by at least the
logarithm of the training tokens over all its occurrences. A kept state lists its next tokens with discounted shares;
what is left goes to the other tokens in proportion to the state above. A text is scored token by token in the longest
kept state. A context needs ``least`` training occurrences, so does what follows it, whatever the corpus: the model
grows with the corpus, and nothing of it is collected or broadcast.

How the work is dealt: texts are packed into blocks of bounded size, written once to the shared checkpoint folder,
bucketed by block. Level by level every block sends the n-grams that it holds, each once, to the key ranges of the
n-grams' hashed keys: sorted, as differences, one row for each block and range. A range adds up what all blocks sent
and answers each of them in the order that it asked. Keys are spread evenly by their hash and a block sends a key
once, so that no n-gram, however frequent, makes a hot range; the number of ranges follows the tokens, and there are
never more rows than n-grams. The sums of a context's divergence go the same way: each of its followers is weighed by
one of the blocks that hold it. Blocks stay where they are: the answers are dealt to their buckets.

Defined results: a null text is the empty text, which is one end. Repeated rows are scored and counted as often as
they occur. A null condition is no training row; null ids are kept. Without training rows every probability is one, so
both scores are 0. An empty table gives an empty result. Input columns other than the named ones are not looked at.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, replace
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraproof.llm.common import ensure_checkpoint_dir, forget_shuffles, release_memory, slices

BLOCK_TOKENS, BLOCK_WORDS = 500_000, 150_000
#: Bytes of text for which there is one bucket of blocks, and one range of keys.
BUCKET_BYTES, RANGE_BYTES, MOST_BUCKETS = 16 << 20, 12 << 20, 100_000
BLOCK = "block long, n_tokens long, ids array<{0}>, train binary, sizes binary, tokens binary, words binary"
SENT = "kind int, range long, block long, keys binary, n binary, counts binary, followers binary, chances binary, divergence binary"
ANSWERS = "block long, kind int, range long, answer binary, total long, distinct long, texts long"
GRAMS, CONTEXTS = 0, 1
#: Bits of a word's key, and of an n-gram's beyond those that number the text's bytes: one in 2**18 has another's key.
WORD_BITS, MORE_BITS = 60, 18
END = b""


def pack(numbers: np.ndarray) -> bytes:
    """Whole numbers, byte by byte of equal weight without the bytes that all lack, compressed."""
    planes = np.ascontiguousarray(numbers.astype("<i8").view(np.uint8).reshape(-1, 8).T)
    used = max((i + 1 for i in range(8) if planes[i].any()), default=0)
    return bytes([used]) + len(numbers).to_bytes(4, "little") + zstandard.ZstdCompressor(level=1).compress(planes[:used].tobytes())


def unpack(packed: bytes) -> np.ndarray:
    out = np.zeros((int.from_bytes(packed[1:5], "little"), 8), np.uint8)
    if packed[0]:
        out[:, : packed[0]] = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed[5:]), np.uint8).reshape(packed[0], -1).T
    return out.view("<i8").ravel()


def pack_bytes(numbers: np.ndarray) -> bytes:
    """Numbers of any kind as they are, byte by byte of equal weight, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, numbers.itemsize).T).tobytes())


def unpack_bytes(packed: bytes, kind: type) -> np.ndarray:
    held = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return np.ascontiguousarray(held.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def pack_sparse(numbers: np.ndarray) -> bytes:
    """Numbers of single precision, of which many are 0."""
    there = numbers != 0
    held = pack_bytes(numbers[there].astype(np.float32))
    return len(numbers).to_bytes(4, "little") + len(held).to_bytes(4, "little") + held + pack_bytes(np.packbits(there))


def unpack_sparse(packed: bytes) -> np.ndarray:
    n, size = (int.from_bytes(packed[at : at + 4], "little") for at in (0, 4))
    out = np.zeros(n)
    out[np.unpackbits(unpack_bytes(packed[8 + size :], np.uint8))[:n].astype(bool)] = unpack_bytes(packed[8 : 8 + size], np.float32)
    return out


def ordered(keys: np.ndarray, bits: int) -> np.ndarray:
    """Places of the keys in rising order; sorting them with their places below is faster than sorting places."""
    size = len(keys).bit_length()
    if bits + size > 63:
        return np.argsort(keys)
    return np.sort((keys << size) | np.arange(len(keys))) & ((1 << size) - 1)


def distinct(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The different keys in rising order, and the number of each key among them."""
    size = len(keys).bit_length()
    spare = max(0, bits + size - 63)  # low bits of the keys that leave room for the places
    order = np.sort((keys >> spare << size) | np.arange(len(keys))) & ((1 << size) - 1)
    held = keys[order]
    if (held[1:] < held[:-1]).any():
        order = np.argsort(keys)
        held = keys[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = held[1:] != held[:-1]
    which = np.empty(len(keys), np.int64)
    which[order] = np.cumsum(fresh) - 1
    return held[fresh], which


def word_keys(words: list[bytes]) -> np.ndarray:
    return (pd.util.hash_array(np.array([*words, b"x"], object)[:-1], categorize=False) >> np.uint64(64 - WORD_BITS)).astype(np.int64)


#: The start of a text stands in a block's vocabulary like a word; words hold no blank, so none is equal to it.
START = b" "


def joined(contexts: np.ndarray, tokens: np.ndarray, bits: int) -> np.ndarray:
    """Keys of the contexts with one more token."""
    x = contexts.view(np.uint64)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + tokens.view(np.uint64)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(64 - bits)).view(np.int64)


class Numbers(dict):
    """Numbers of words, in the order in which they are asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _blocks(df: DataFrame, id_col: str, text_col: str, is_train: Column) -> DataFrame:
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(is_train, F.lit(False)).alias("train"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        ids, train, sizes, tokens, words, waiting = [], [], [], [], Numbers(), 0

        def block() -> pa.RecordBatch:
            keys, number = np.unique(word_keys(list(words)), return_inverse=True)  # words in order of their keys
            row = [(part << 31) + made, waiting, pa.concat_arrays(ids), pack_bytes(np.packbits(np.array(train, bool))), pack(np.array(sizes)), pack(number[np.concatenate(tokens)]), pack(np.diff(keys, prepend=0))]
            return pa.RecordBatch.from_arrays([pa.array([x]) if k != 2 else pa.ListArray.from_arrays([0, len(x)], x) for k, x in enumerate(row)], names=["block", "n_tokens", "ids", "train", "sizes", "tokens", "words"])

        for batch in slices(batches, "text"):
            for k, (text, learn) in enumerate(zip(batch.column("text").to_pylist(), batch.column("train").to_pylist(), strict=True)):
                found = text.encode().lower().split()
                found.append(END)
                ids.append(batch.column("id").slice(k, 1))
                train.append(learn)
                sizes.append(len(found) + 1)
                tokens.append(np.fromiter(map(words.__getitem__, (START, *found)), np.int32, len(found) + 1))
                waiting += len(found)
                if len(words) >= BLOCK_WORDS or waiting >= BLOCK_TOKENS:
                    yield block()
                    made += 1
                    ids, train, sizes, tokens, words, waiting = [], [], [], [], Numbers(), 0
        if ids:
            yield block()
        release_memory()

    return rows.mapInArrow(run, BLOCK.format(rows.schema["id"].dataType.simpleString()))


@dataclass(frozen=True)
class Rules:
    ranges: int
    depth: int
    least: int
    gain: float
    discount: float
    bits: int
    total: int = 0
    base: float = 1.0

    def key_bits(self, kind: int, level: int) -> int:
        """Of what goes to the ranges at a level: words, and contexts of one word, have longer keys."""
        return WORD_BITS if (kind, level) in ((GRAMS, 0), (CONTEXTS, 2)) else self.bits

    def low(self, r: int, kind: int, level: int) -> int:
        """Where a range begins."""
        return (r << self.key_bits(kind, level)) // self.ranges


class Walk:
    """A block's tokens with a start before each text, and what the ranges answered, level by level.

    A level's n-grams are contexts of so many tokens and one more; ``n`` has the training count of the n-gram that
    ends at each place, 0 where it is below the least one, ``best`` the token's probability in the longest kept state.
    """

    def __init__(self, b, rules: Rules):  # noqa: ANN001
        self.b, self.rules, self.level = b, rules, 0
        self.words = np.cumsum(unpack(b.words))
        self.tokens = unpack(b.tokens).astype(np.int32)
        self.sizes = unpack(b.sizes)
        train = np.unpackbits(unpack_bytes(b.train, np.uint8))[: len(self.sizes)].astype(bool)
        self.train = np.repeat(train, self.sizes)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.real = np.ones(len(self.tokens), bool)
        self.real[self.starts] = False
        self.key = self.words[self.tokens]

    def first(self) -> tuple:
        """The words and how often each stands in training texts."""
        return GRAMS, self.words, np.bincount(self.tokens[self.train], minlength=len(self.words)), None, None

    def known(self) -> None:
        """Takes the words' counts."""
        counts = unpack(self.b.grams0) >> 1
        self.n = counts[self.tokens]
        self.root = self.best = np.log10((counts + 1) / self.rules.base)[self.tokens]

    def deeper(self) -> None:
        """Goes to the n-grams with one token more: places whose context is frequent, and those that can be so too."""
        self.level += 1
        self.at = np.flatnonzero(self.real[1:] & (self.n[:-1] >= self.rules.least)) + 1
        self.context, self.of = self.key[self.at - 1], self.n[self.at - 1]
        self.maybe = np.flatnonzero(self.n[self.at] >= self.rules.least)
        if self.level == 1:  # contexts are words, whose numbers are in the order of their keys
            number = self.tokens[self.at - 1]
            there = np.bincount(number, minlength=len(self.words)) > 0
            self.contexts, self.which = self.words[there], (np.cumsum(there) - 1)[number]
        else:
            self.contexts, self.which = distinct(self.context, self.rules.bits)
        place = self.at[self.maybe]
        grams = joined(self.context[self.maybe], self.words[self.tokens[place]], self.rules.bits)
        self.grams, self.gram = distinct(grams, self.rules.bits)
        self.key = np.zeros(len(self.tokens), np.int64)
        self.key[place] = grams

    def count(self) -> tuple:
        n = np.bincount(self.gram[self.train[self.at[self.maybe]]], minlength=len(self.grams))
        return GRAMS, self.grams, n, None, None

    def counted(self) -> None:
        """Takes the n-grams' counts; of each n-gram one place stands for it where this block speaks for it."""
        told = unpack(getattr(self.b, f"grams{self.level}")) if len(self.grams) else np.zeros(0, np.int64)
        n = (told >> 1)[self.gram]
        self.n = np.zeros(len(self.tokens), np.int64)
        self.n[self.at[self.maybe]] = n
        one = np.zeros(len(self.grams), np.int64)
        one[self.gram] = self.maybe
        self.own = one[(told & 1) == 1]

    def weigh(self) -> tuple:
        """Each context's sums over the followers that this block speaks for: counts, followers, chances above, divergence."""
        place = self.at[self.own]
        n, above = self.n[place], 10 ** self.best[place]
        share = (n - self.rules.discount) / self.of[self.own]
        add = lambda x: np.bincount(self.which[self.own], x, len(self.contexts))
        counts, followers = np.stack([add(n), add(np.ones(len(n)))]).astype(np.int64)
        of = np.zeros(len(self.contexts), np.int64)
        of[self.which[self.own]] = self.of[self.own]
        return CONTEXTS, self.contexts, of, (counts, followers), (add(above), add(share * np.log(share / above)))

    def score(self) -> None:
        """Takes the kept contexts' shares into the probabilities."""
        rest = unpack_sparse(getattr(self.b, f"contexts{self.level}")) if len(self.at) else np.zeros(0)
        logs = np.log10(np.where(rest > 0, rest, 1.0))
        kept = np.flatnonzero((rest > 0)[self.which])
        place = self.at[kept]
        best = self.best.copy()
        best[place] += logs[self.which[kept]]
        kept = kept[self.n[place] > 0]
        place = self.at[kept]
        best[place] = np.log10((self.n[place] - self.rules.discount) / self.of[kept])
        self.best = best


def _walks(batches: Iterator[pa.RecordBatch], rules: Rules) -> Iterator[tuple[Walk, pa.RecordBatch]]:
    """One block after another, so that a worker holds the arrays of one."""
    for batch in batches:
        for k in range(len(batch)):
            row = batch.slice(k, 1)
            held = {name: row.column(name)[0].as_py() for name in row.schema.names if name != "ids"}
            yield Walk(SimpleNamespace(**held), rules), row
    release_memory()


def _sent(known: DataFrame, rules: Rules, level: int) -> DataFrame:
    """What each block asks and tells the ranges: n-grams of this level, and contexts of the one above."""
    bounds = [np.array([rules.low(r, kind, level) for r in range(rules.ranges + 1)], np.int64) for kind in (GRAMS, CONTEXTS)]
    names = [c.split()[0] for c in SENT.split(", ")]
    kinds = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 6]

    def told(walk: Walk) -> Iterator[tuple]:
        if not level:
            yield walk.first()
            return
        walk.known()
        for k in range(1, min(level, rules.depth) + 1):
            walk.deeper()
            if k == level:
                yield walk.count()
                return
            walk.counted()
            if k < level - 1:
                walk.score()
            else:
                yield walk.weigh()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for walk, _ in _walks(batches, rules):
            for kind, keys, n, more, sums in told(walk):
                ends, rows = np.searchsorted(keys, bounds[kind]), []
                for r in np.flatnonzero(np.diff(ends)):
                    x = slice(ends[r], ends[r + 1])
                    rows.append((kind, r, walk.b.block, pack(np.diff(keys[x], prepend=bounds[kind][r])), pack(n[x]), *(None if y is None else put(y[x]) for ys, put in ((more or (None, None), pack), (sums or (None, None), pack_sparse)) for y in ys)))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return known.drop("ids").mapInArrow(run, SENT)


def _answers(sent: DataFrame, rules: Rules, level: int) -> DataFrame:
    """Every range adds up what the blocks sent and answers each in its order.

    N-grams: twice the count, and one more for the block that speaks for it; 0 where it is too rare. Contexts: what a
    kept one leaves to the state above, else 0. For words, a row without a block has the range's totals.
    """
    start, end = word_keys([START, END])
    least = rules.least if level else 1

    def grams(n: np.ndarray, order: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sums = np.add.reduceat(n[order], np.flatnonzero(fresh))
        enough = sums >= least
        answer = np.empty(len(n), np.int64)
        answer[order] = np.where(enough, 2 * sums, 0)[group := np.cumsum(fresh) - 1] + (fresh & enough[group])
        return answer, sums

    def contexts(pdf: pd.DataFrame, n: np.ndarray, order: np.ndarray, fresh: np.ndarray) -> np.ndarray:
        one = np.flatnonzero(fresh)
        counts, followers, chances, divergence = (np.add.reduceat(np.concatenate(list(map(take, pdf[name])))[order], one) for name, take in (("counts", unpack), ("followers", unpack), ("chances", unpack_sparse), ("divergence", unpack_sparse)))
        n = np.maximum(1, np.maximum.reduceat(n[order], one))  # blocks that weigh no follower do not tell it
        left, above = 1 - (counts - rules.discount * followers) / n, 1 - chances
        sound = (followers > 0) & (left > 0) & (above > 0)
        rest = np.where(sound, left, 1.0) / np.where(sound, above, 1.0)
        gained = divergence + np.where(sound, left, 0.0) * np.log(rest)
        kept = sound & (gained >= rules.gain) & (gained * n >= math.log(max(1, rules.total)))
        answer = np.empty(len(order))
        answer[order] = np.where(kept, rest, 0.0)[np.cumsum(fresh) - 1]
        return answer

    def add_up(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        kind, at = map(int, key)
        keys = [np.cumsum(unpack(x)) + rules.low(at, kind, level) for x in pdf["keys"]]
        ends = np.cumsum(list(map(len, keys)))[:-1]
        keys, n = np.concatenate(keys), np.concatenate(list(map(unpack, pdf["n"])))
        order = ordered(keys - rules.low(at, kind, level), rules.key_bits(kind, level) - rules.ranges.bit_length() + 2)
        keys = keys[order]
        fresh = np.ones(len(keys), bool)
        fresh[1:] = keys[1:] != keys[:-1]
        blocks, totals = pdf["block"].tolist(), (None, None, None)
        if kind == CONTEXTS:
            parts = [pack_sparse(x) for x in np.split(contexts(pdf, n, order, fresh), ends)]
        else:
            answer, sums = grams(n, order, fresh)
            parts = [pack(x) for x in np.split(answer, ends)]
            if not level:
                sums, keys = sums[keys[fresh] != start], keys[fresh][keys[fresh] != start]
                blocks, parts, totals = [*blocks, None], [*parts, None], (int(sums.sum()), int((sums > 0).sum()), int(sums[keys == end].sum()))
        out = pd.DataFrame({"block": pd.array(blocks, "Int64"), "kind": kind, "range": at, "answer": parts})
        return out.assign(**{name: pd.array([None] * (len(out) - 1) + [x], "Int64") for name, x in zip(("total", "distinct", "texts"), totals, strict=True)})

    return sent.groupBy("kind", "range").applyInPandas(add_up, ANSWERS)


def _by_block(answers: DataFrame, buckets: int) -> DataFrame:
    """One row for each block: its answers, in the order that it asked."""

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("range")
        counts, rests = ([x for x, k in zip(pdf["answer"], pdf["kind"], strict=True) if k == kind] for kind in (GRAMS, CONTEXTS))
        row = [pdf["block"].iloc[0], pack(np.concatenate([np.zeros(0, np.int64), *map(unpack, counts)])), pack_sparse(np.concatenate([np.zeros(0), *map(unpack_sparse, rests)]))]
        return pd.DataFrame([row], columns=["block", "grams", "contexts"])

    found = answers.select("block", "kind", "range", "answer").filter("block IS NOT NULL").repartition(buckets, "block")
    return found.groupBy("block").applyInPandas(gather, "block long, grams binary, contexts binary")


def _stored(df: DataFrame, home: str, name: str, buckets: int, tables: list[str]) -> DataFrame:
    """``df`` as a table bucketed by block in the shared folder, so that joins by block move neither side."""
    table = f"suffix_tree_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, "block").option("path", f"{home}/{name}").saveAsTable(table)
    tables.append(table)
    return df.sparkSession.table(table)


def score_texts(df: DataFrame, id_col: str, text_col: str, is_train: Column, depth: int = 3, gain: float = 0.02, discount: float = 0.5, least: int = 2) -> DataFrame:
    """One row per input row: id, train, n_tokens, n_known, train_tokens, base_score, score.

    ``least`` is the smallest training count of a context and of what follows it.
    """
    spark = df.sparkSession
    home, tables = f"{ensure_checkpoint_dir(spark)}/suffix-tree-{uuid.uuid4().hex}", []
    size = df.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
    buckets = min(MOST_BUCKETS, 1 + size // BUCKET_BYTES)
    known = _stored(_blocks(df, id_col, text_col, is_train).repartition(buckets, "block"), home, "blocks", buckets, tables)
    rules = Rules(1 + size // RANGE_BYTES, depth, max(1, least), gain, discount, min(62, MORE_BITS + size.bit_length()))
    _answers(_sent(known, rules, 0), rules, 0).write.parquet(f"{home}/words")
    words = spark.read.parquet(f"{home}/words")
    totals = words.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "distinct"))).first()
    rules = replace(rules, total=totals["total"], base=float(totals["total"] + totals["distinct"] + 1))
    answers = words
    for level in range(depth + 2):
        if level:
            answers = _answers(_sent(known, rules, level), rules, level)
        told = _stored(_by_block(answers, buckets), home, f"told{level}", buckets, tables)
        held = [F.col("grams").alias(f"grams{level}")] * (level <= depth) + [F.col("contexts").alias(f"contexts{level - 1}")] * (level > 1)
        known = known.join(told.select("block", *held), "block", "left")
        forget_shuffles(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for walk, row in _walks(batches, rules):
            walk.known()
            for _ in range(rules.depth):
                walk.deeper()
                walk.counted()
                walk.score()
            add = lambda x: np.add.reduceat(np.where(walk.real, x, 0), walk.starts)  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([row.column("ids").flatten(), *map(pa.array, (walk.train[walk.starts], walk.sizes - 1, add((unpack(walk.b.grams0) > 1)[walk.tokens].astype(np.int64)), add(walk.root), add(walk.best)))], names=["id", "train", "n_tokens", "n_known", "base_score", "score"])

    id_type = known.schema["ids"].dataType.elementType.simpleString()
    scored = known.mapInArrow(run, f"id {id_type}, train boolean, n_tokens long, n_known long, base_score double, score double")
    scored = scored.select(F.col("id").alias(id_col), "train", "n_tokens", "n_known", F.lit(rules.total).cast("long").alias("train_tokens"), "base_score", "score")
    for table in tables:  # the files stay for the result to read
        spark.sql(f"DROP TABLE {table}")
    return scored
