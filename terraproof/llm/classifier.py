"""Quality classifier: a convolutional network over bytes, in numpy.

A text's UTF-8 bytes are cut into chunks of CHUNK bytes that overlap by OVERLAP, over its whole length. Bytes become
learned vectors; FILTERS learned filters slide over windows of WIDTH bytes; the largest answer of each filter in a chunk
goes through a small dense layer; the mean over a text's chunks, weighted by the bytes that each adds, gives one
probability. Windows overlap within a chunk and chunks overlap by more than a window, so no sequence of bytes is missed.

The network is fitted on the driver, on a bounded sample of labelled rows: about ``per_class`` documents of each label,
those with the smallest hashes of their ids, none longer than ``most_chars``; with these bounds the sample has at most
some 60 MB and a step works on chunks of a few MB. Each class weighs as it does among all labelled rows. The model has
some 3,000 numbers, whatever the corpus, and is broadcast.

Defined results: a null or empty text is scored by the network's answer to no chunks. Labels other than 0 and 1 and null
labels are passed over; contradicting labels of one id both count. Where one label only is known, each score is that
label's share, smoothed by one row of each; without labels 0.5. Repeated texts have equal scores, to some six digits.
Input columns of any name go through, but names of the output must not be among them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from terraproof.llm.common import release_memory, slices

CHUNK, OVERLAP, STRIDE = 512, 64, 2
WIDTH, DEPTH, FILTERS, HIDDEN = 8, 6, 24, 16
CHUNKS_AT_ONCE = 64
WINDOWS = (CHUNK - WIDTH) // STRIDE + 1


def chunked(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of each chunk, filled up with zeros; bytes in it; its text)."""
    rows, sizes, owners = [], [], []
    for k, text in enumerate(texts):
        raw = text.encode("utf-8", "replace") if text else b""
        for at in range(0, max(1, len(raw) - OVERLAP), CHUNK - OVERLAP) if raw else ():
            part = raw[at : at + CHUNK]
            rows.append(part.ljust(CHUNK, b"\0"))
            sizes.append(len(part))
            owners.append(k)
    return np.frombuffer(b"".join(rows), np.uint8).reshape(-1, CHUNK), np.array(sizes, np.int64), np.array(owners, np.int64)


@dataclass
class Network:
    """Parameters by name; ``share`` stands in for a network that could not be fitted."""

    share: float
    p: dict[str, np.ndarray] | None = None

    @staticmethod
    def random(seed: int = 11) -> dict[str, np.ndarray]:
        rng = np.random.default_rng(seed)
        normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        return {
            "bytes": normal(256, DEPTH, scale=0.5), "filters": normal(WIDTH * DEPTH, FILTERS, scale=(WIDTH * DEPTH) ** -0.5), "bias": np.zeros(FILTERS, np.float32),
            "dense": normal(FILTERS, HIDDEN, scale=FILTERS**-0.5), "dense_bias": np.zeros(HIDDEN, np.float32), "out": normal(HIDDEN, scale=HIDDEN**-0.5), "out_bias": np.zeros(1, np.float32),
        }

    def windows(self, chunks: np.ndarray) -> np.ndarray:
        """Vectors of the bytes of each window: chunk, window, WIDTH * DEPTH."""
        v = np.ascontiguousarray(self.p["bytes"][chunks].reshape(len(chunks), CHUNK * DEPTH))
        a, b = v.strides
        return np.ascontiguousarray(np.lib.stride_tricks.as_strided(v, (len(chunks), WINDOWS, WIDTH * DEPTH), (a, STRIDE * DEPTH * b, b), writeable=False))

    def pooled(self, chunks: np.ndarray, sizes: np.ndarray, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """The largest answer of each filter in each chunk, and the window that gave it."""
        found, places = [], []
        for at in range(0, len(chunks), CHUNKS_AT_ONCE):
            part = self.windows(chunks[at : at + CHUNKS_AT_ONCE])
            answers = (part.reshape(-1, WIDTH * DEPTH) @ self.p["filters"]).reshape(len(part), WINDOWS, FILTERS)
            short = sizes[at : at + CHUNKS_AT_ONCE]
            for k in np.flatnonzero(short < CHUNK):  # windows that begin behind the text
                answers[k, max(1, -(-int(short[k]) // STRIDE)) :] = -np.inf
            if where:
                place = answers.argmax(1)
                places.append(place)
                found.append(np.take_along_axis(answers, place[:, None, :], 1)[:, 0])
            else:
                found.append(answers.max(1))
        if not found:
            return np.zeros((0, FILTERS), np.float32), np.zeros((0, FILTERS), np.int64)
        return np.concatenate(found) + self.p["bias"], np.concatenate(places) if where else None

    def combined(self, pooled: np.ndarray, shares: np.ndarray, owners: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(log odds of each text, hidden answers of each chunk, their mean in each text)."""
        hidden = np.maximum(np.maximum(pooled, 0) @ self.p["dense"] + self.p["dense_bias"], 0)
        mean = np.zeros((texts, HIDDEN))
        np.add.at(mean, owners, hidden * shares[:, None])
        return mean @ self.p["out"].astype(float) + float(self.p["out_bias"][0]), hidden, mean

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.p is None:
            return np.full(len(texts), self.share)
        chunks, sizes, owners = chunked(texts)
        odds, _, _ = self.combined(self.pooled(chunks, sizes)[0], weights_of(sizes, owners, len(texts)), owners, len(texts))
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def weights_of(sizes: np.ndarray, owners: np.ndarray, texts: int) -> np.ndarray:
    """Share of each chunk in its text: of a chunk behind another, the bytes that it adds."""
    added = sizes - np.where(np.diff(owners, prepend=-1) == 0, OVERLAP, 0)
    total = np.bincount(owners, added, texts)
    return added / np.maximum(total[owners], 1) if len(owners) else np.zeros(0)


def train(texts: list[str], labels: np.ndarray, class_weights: tuple[float, float], rounds: int = 14, batch: int = 32, rate: float = 4e-3, ridge: float = 1e-4) -> Network:
    """Adam on the weighted log loss; the gradient of a largest answer goes to its window alone."""
    net = Network(0.5, Network.random())
    rng = np.random.default_rng(12)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step, steps = 0, rounds * -(-len(texts) // batch)
    for _ in range(rounds):
        order = rng.permutation(len(texts))
        for at in range(0, len(texts), batch):
            rows = order[at : at + batch]
            chunks, sizes, owners = chunked([texts[i] for i in rows])
            grads = gradients(net, chunks, sizes, owners, labels[rows], np.where(labels[rows] == 1, class_weights[1], class_weights[0]))
            step += 1
            pace = rate * (1 - (step - 1) / steps)
            for k, g in grads.items():
                first, second = moments[k]
                g = g + ridge * net.p[k]
                first += 0.1 * (g - first)
                second += 0.001 * (g * g - second)
                net.p[k] -= (pace * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def gradients(net: Network, chunks: np.ndarray, sizes: np.ndarray, owners: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the weighted mean log loss of some texts."""
    p, texts = net.p, len(labels)
    pooled, place = net.pooled(chunks, sizes, where=True)
    shares = weights_of(sizes, owners, texts)
    odds, hidden, mean = net.combined(pooled, shares, owners, texts)
    miss = weights * (1 / (1 + np.exp(-np.clip(odds, -500, 500))) - labels) / weights.sum()
    grads = {"out": mean.T @ miss, "out_bias": np.array([miss.sum()])}
    at_hidden = (miss[owners] * shares)[:, None] * p["out"] * (hidden > 0)
    grads["dense"], grads["dense_bias"] = np.maximum(pooled, 0).T @ at_hidden, at_hidden.sum(0)
    at_pooled = (at_hidden @ p["dense"].T) * (pooled > 0)
    grads["bias"] = at_pooled.sum(0)
    raw = chunks[np.arange(len(chunks))[:, None, None], (place * STRIDE)[:, :, None] + np.arange(WIDTH)]  # chunk, filter, byte of the window
    seen = p["bytes"][raw].reshape(len(chunks), FILTERS, WIDTH * DEPTH)
    grads["filters"] = np.einsum("cf,cfk->kf", at_pooled, seen)
    at_bytes = at_pooled[:, :, None] * p["filters"].T[None]
    flat = raw.ravel()
    spread = at_bytes.reshape(-1, DEPTH)
    grads["bytes"] = np.stack([np.bincount(flat, spread[:, d], 256) for d in range(DEPTH)], 1)
    return grads


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, is_train: Column, per_class: int = 600, most_chars: int = 20_000, rounds: int = 14) -> Network:
    """A network from the rows of ``labels`` (id, label) for which ``is_train``, a condition on the id, holds."""
    known = labels.filter(is_train & F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
    counts = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        return Network((counts.get(1, 0) + 1) / (total + 2))
    chance = F.pmod(F.xxhash64(F.col("_id").cast("string")), F.lit(1 << 30))
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text")).filter(F.length("_text") <= most_chars)
    picked: list[tuple[str, int]] = []
    for label in (0, 1):
        # twice as many ids as needed, for those without a text that is short enough
        first = known.filter(F.col("_label") == label).select("_id", chance.alias("_chance")).orderBy("_chance", "_id").limit(2 * per_class)
        rows = texts.join(F.broadcast(first), F.col("_doc") == F.col("_id")).select("_text", "_chance").orderBy("_chance", "_text").limit(per_class).collect()
        picked += [(r["_text"], label) for r in rows]
    got = [sum(y == label for _, y in picked) for label in (0, 1)]
    if not all(got):
        return Network((counts[1] + 1) / (total + 2))
    return train([x for x, _ in picked], np.array([y for _, y in picked]), (counts[0] / got[0], counts[1] / got[1]), rounds)


def score(df: DataFrame, text_col: str, network: Network, name: str = "score") -> DataFrame:
    """The columns of ``df`` but the text, then the probability of label 1."""
    kept = [x for x in df.schema if x.name != text_col]
    model = df.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            found = model.value.scores(part.column(text_col).to_pylist())
            yield pa.RecordBatch.from_arrays([*(part.column(x.name) for x in kept), pa.array(found)], names=[*(x.name for x in kept), name])
        release_memory()

    return df.mapInArrow(run, StructType([*kept, StructField(name, DoubleType())]))
