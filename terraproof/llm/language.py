"""Language identification by a linear-chain conditional random field over words.

A word's features are its affixes, its character n-grams and what a lexicon learned from the sample says of it;
the transitions between the languages of neighbouring words are learned as well, from the sample's documents and from
lines spliced of two of them. Forward-backward gives each
word's language probabilities in code-switched text; a line break ends a chain. A run of more than 62 characters
without a blank counts as several words, so that text in scripts without blanks is read whole. A document's language is the one
with the largest sum over its words, its score that sum per word.

The field is fitted on the driver on a bounded sample: at most ``2 * per_language`` documents for each of the
``most_languages`` most frequent languages, none longer than ``most_chars``. Everything else covers all rows.

Defined results: a text that is null or holds no letter is ``und`` with score 0; so is every text where there is
nothing to learn from. Words without a letter have no say. Ties go to the first language in alphabetical order. Null
ids are read like others; repeated rows give repeated results. An empty table gives an empty result. Other input
columns go through untouched, whatever their names.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from terraproof.llm.common import release_memory, slices

UNKNOWN = "und"
#: Longer runs without a blank are cut into units of so many trigrams, each a position of the chain.
LONGEST, UNIT = 62, 16
#: Words that a document gives to a line of two languages.
SPLICE = 20
EDGES = ".,;:!?\"'()[]{}|*#$%&<>-_=+/\\"


def features(word: str) -> list[str]:
    """The word, its affixes and its trigrams, edges included."""
    w = f"^{word}$"
    out = [w[i : i + 3] for i in range(len(w) - 2)]
    out += ("w" + word, "p" + word[:1], "p" + word[:2], "q" + word[:4], "s" + word[-1:], "s" + word[-2:], "z" + word[-4:])
    return out


def normal(word: str) -> str:
    """The form that features are taken from; empty if there is no letter."""
    form = word.strip(EDGES).lower()
    if form == word:
        form = word  # one string for both
    return form if any(map(str.isalpha, form)) else ""


class Lattice:
    """Chains of differing length, longest first, so that step t touches the first ``active[t]`` of them."""

    def __init__(self, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        starts = np.cumsum(lengths) - lengths
        self.starts, self.lengths = starts[self.order], lengths[self.order]
        longest = int(lengths.max()) if len(lengths) else 0
        self.active = len(lengths) - np.searchsorted(self.lengths[::-1], np.arange(longest), side="right")

    def run(self, emit: np.ndarray, trans: np.ndarray, first: np.ndarray, pairs: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Marginals of each position, expected transitions and first labels, and the log partition function."""
        k = emit.shape[1]
        alpha, scale = np.empty_like(emit), 0.0
        at = self.starts
        now = None
        for t, n in enumerate(self.active):
            now = emit[at[:n] + t] * (first if now is None else now[:n] @ trans)
            total = now.sum(1, keepdims=True)
            now /= total
            scale += float(np.log(total).sum())
            alpha[at[:n] + t] = now
        marginal, expected = np.empty_like(emit), np.zeros((k, k))
        later = np.ones((len(at), k))
        for t in range(len(self.active) - 1, -1, -1):
            n = self.active[t]
            here = at[:n] + t
            if t + 1 < len(self.active):
                m = self.active[t + 1]
                seen = emit[at[:m] + t + 1] * later[:m]
                if pairs:
                    a = alpha[here[:m]]
                    joint = a[:, :, None] * trans[None] * seen[:, None, :]
                    expected += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
                back = seen @ trans.T
                later[:m] = back / back.sum(1, keepdims=True)
            both = alpha[here] * later[:n]
            marginal[here] = both / both.sum(1, keepdims=True)
        heads = marginal[at].sum(0) if len(self.active) else np.zeros(k)
        return marginal, expected, heads, scale


@dataclass
class Crf:
    labels: list[str]
    index: dict[str, int]
    weights: np.ndarray
    trans: np.ndarray
    first: np.ndarray
    lexicon: dict[str, int]

    def scores(self, words: list[str]) -> np.ndarray:
        """Potentials of each word's labels, the largest of a word being 1."""
        index, lexicon, nothing = self.index, self.lexicon, len(self.weights)
        flat, sizes = [], []
        for w in words:
            ids = [index[f] for f in features(w) if f in index] if w else []
            ids.append(lexicon.get(w, nothing))
            flat += ids
            sizes.append(len(ids))
        starts = np.cumsum(sizes) - sizes
        weights = np.vstack([self.weights, np.zeros((1, len(self.labels)), np.float32)])
        out = np.add.reduceat(weights[flat], starts) if words else np.zeros((0, len(self.labels)), np.float32)
        return np.exp(out - out.max(1, keepdims=True))


def _chains(texts: list[str]) -> list[list[list[str]]]:
    return [[units(words) for line in text.split("\n") if (words := line.split())] for text in texts]


def units(words: list[str]) -> list[str]:
    """Words, the long ones in pieces that overlap by two characters, so that each of their trigrams is in one piece."""
    if max(map(len, words)) <= LONGEST:
        return words
    pieces = lambda w: [w[i : i + UNIT + 2] for i in range(0, len(w) - 2, UNIT)] if len(w) > LONGEST else [w]
    return [x for w in words for x in pieces(w)]


def train(texts: list[str], langs: list[str], rounds: int = 20, rate: float = 0.3, ridge: float = 2.0, rare: int = 3) -> Crf | None:
    """Fit by Adam on the penalised log likelihood of the sample's word labels."""
    labels = sorted(set(langs))
    if not labels:
        return None
    k = len(labels)
    code = {x: i for i, x in enumerate(labels)}
    types: dict[str, int] = {}
    ids, gold, lengths = [], [], []
    by_word: dict[str, Counter] = defaultdict(Counter)

    def learn(forms: list[str], langs: list[int]) -> None:
        ids.extend(types.setdefault(w, len(types)) for w in forms)
        gold.extend(langs)
        lengths.append(len(forms))

    heads = []
    for chains, lang in zip(_chains(texts), langs, strict=True):
        heads.append(([], code[lang]))
        for words in chains:
            forms = list(map(normal, words))
            learn(forms, [code[lang]] * len(forms))
            heads[-1][0].extend(forms[: SPLICE - len(heads[-1][0])])
            for w in forms:
                by_word[w][code[lang]] += 1
    # a document has one language, so switches are learned from the heads of two documents in one line
    for (a, x), (b, y) in zip(heads, heads[1:] + heads[:1], strict=True):
        if x != y and a and b:
            learn(a + b, [x] * len(a) + [y] * len(b))
    if not ids:
        return None
    seen = Counter(f for w in types if w for f in features(w))
    index = {f: i for i, f in enumerate(x for x, n in seen.items() if n >= rare or x[0] == "w" and sum(by_word[x[1:]].values()) >= rare)}
    lexicon = {w: len(index) + c.most_common(1)[0][0] for w, c in by_word.items() if w and sum(c.values()) >= rare and c.most_common(1)[0][1] > 0.8 * sum(c.values())}
    flat, owner = [], []
    for w, i in types.items():
        mine = [index[f] for f in features(w) if f in index] if w else []
        if w in lexicon:
            mine.append(lexicon[w])
        flat += mine
        owner += [i] * len(mine)
    flat, owner, ids, gold = np.array(flat, np.int64), np.array(owner, np.int64), np.array(ids), np.array(gold)
    n_features = len(index) + k
    weights, trans, first = np.zeros((n_features, k)), np.eye(k) * 2.0, np.zeros(k)
    lattice = Lattice(np.array(lengths))
    gold_by_type = np.stack([np.bincount(ids[gold == j], minlength=len(types)) for j in range(k)], 1).astype(float)
    ends = np.cumsum(lengths)
    inner = np.ones(len(ids), bool)
    inner[ends[:-1]] = False
    inner[0] = False
    at = np.flatnonzero(inner)
    gold_pairs = np.zeros((k, k))
    np.add.at(gold_pairs, (gold[at - 1], gold[at]), 1)
    gold_first = np.bincount(gold[ends - np.array(lengths)], minlength=k).astype(float)
    total = lambda values: np.stack([np.bincount(owner, values[flat, j], len(types)) for j in range(k)], 1)
    params, moments = [weights, trans, first], [[0.0, 0.0] for _ in range(3)]
    scale = 1.0 / len(ids)
    for step in range(1, rounds + 1):
        logits = total(weights)
        emit = np.exp(logits - logits.max(1, keepdims=True))
        marginal, pairs, heads, _ = lattice.run(emit[ids], np.exp(trans), np.exp(first), True)
        miss = gold_by_type - np.stack([np.bincount(ids, marginal[:, j], len(types)) for j in range(k)], 1)
        grads = [np.stack([np.bincount(flat, miss[owner, j], n_features) for j in range(k)], 1), gold_pairs - pairs, gold_first - heads]
        for p, g, m in zip(params, grads, moments, strict=True):
            g = (g - ridge * p) * scale
            m[0] = 0.9 * m[0] + 0.1 * g
            m[1] = 0.99 * m[1] + 0.01 * g * g
            p += rate * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-8)
    return Crf(labels, index, weights.astype(np.float32), np.exp(trans), np.exp(first), lexicon)


class Tagger:
    """Applies a field to batches of texts; the potentials of words are kept in a bounded cache."""

    def __init__(self, crf: Crf | None, cache: int = 120_000, at_once: int = 150_000):
        self.crf, self.limit, self.at_once = crf, cache, at_once
        self._reset()

    def _reset(self) -> None:
        self.known: dict[str, int] = {}
        self.forms: dict[str, int] = {}
        self.table = np.ones((1024, len(self.crf.labels) if self.crf else 1), np.float32)
        self.voice = np.zeros(1024, bool)

    def _ids(self, words: list[str]) -> np.ndarray:
        found = list(map(self.known.get, words))
        if None in found:
            new = list(dict.fromkeys(w for w, i in zip(words, found, strict=True) if i is None))
            if len(self.known) + len(new) > self.limit and self.known:
                self._reset()
                return self._ids(words)
            forms = list(map(normal, new))
            fresh = list(dict.fromkeys(w for w in forms if w not in self.forms))
            start, end = len(self.forms), len(self.forms) + len(fresh)
            if end > len(self.table):
                grown = max(end, 2 * len(self.table))
                self.table = np.concatenate([self.table, np.ones((grown - len(self.table), self.table.shape[1]), np.float32)])
                self.voice = np.concatenate([self.voice, np.zeros(grown - len(self.voice), bool)])
            self.table[start:end] = self.crf.scores(fresh)
            self.voice[start:end] = [bool(w) for w in fresh]
            self.forms.update(zip(fresh, range(start, end), strict=True))
            self.known.update(zip(new, map(self.forms.__getitem__, forms), strict=True))
            found = list(map(self.known.get, words))
        return np.array(found, np.int64)

    def _part(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sum of the words' marginals, and number of words with a letter, of each text."""
        words, lengths, owners = [], [], []
        for d, chains in enumerate(_chains(texts)):
            for line in chains:
                words += line
                lengths.append(len(line))
                owners.append(d)
        k = len(self.crf.labels)
        sums, voices = np.zeros((len(texts), k)), np.zeros(len(texts))
        if words:
            ids, lengths = self._ids(words), np.array(lengths)
            emit, voice = self.table[ids].astype(float), self.voice[ids]
            marginal = Lattice(lengths).run(emit, self.crf.trans, self.crf.first, False)[0]
            doc = np.repeat(np.array(owners), lengths)
            for j in range(k):
                sums[:, j] = np.bincount(doc, marginal[:, j] * voice, len(texts))
            voices = np.bincount(doc, voice, len(texts))
        return sums, voices

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
        if self.crf is None:
            return out
        rows, size = [], 0
        todo = sorted((i for i, x in enumerate(texts) if x), key=lambda i: len(texts[i]))
        for n, i in enumerate(todo):
            rows.append(i)
            size += len(texts[i]) // 6 + 1
            if size >= self.at_once or n + 1 == len(todo):
                sums, voices = self._part([texts[r] for r in rows])
                best = sums.argmax(1)
                for r, s, v, b in zip(rows, sums, voices, best, strict=True):
                    if v:
                        out[r] = (self.crf.labels[b], float(min(1.0, s[b] / v)))
                    elif any(map(str.isalpha, texts[r])):  # letters only inside odd signs
                        out[r] = (self.crf.labels[0], 1.0 / len(self.crf.labels))
                rows, size = [], 0
        return out


def sample(df: DataFrame, id_col: str, text_col: str, lang_col: str, is_train: Column, per_language: int, most_languages: int, most_chars: int) -> tuple[list[str], list[str]]:
    """Training texts and their languages: documents with the smallest hashes of their ids, about as many of each language."""
    slim = df.filter(is_train & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = slim.groupBy(F.col(lang_col).alias("lang")).count().orderBy(F.desc("count"), "lang").limit(most_languages).collect()
    if not counts:
        return [], []
    chance = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 30)) / float(1 << 30)
    shares = F.create_map(*(x for r in counts for x in (F.lit(r["lang"]), F.lit(min(1.0, 1.3 * per_language / r["count"])))))
    rows = (
        slim.filter((F.length(text_col) <= most_chars) & (chance < F.try_element_at(shares, F.col(lang_col))))
        .select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), chance.alias("chance"))
        .orderBy("chance", "text").limit(2 * per_language * len(counts)).collect()
    )
    return [r["text"] for r in rows], [r["lang"] for r in rows]


def fit(df: DataFrame, id_col: str, text_col: str, lang_col: str, is_train: Column, per_language: int = 80, most_languages: int = 64, most_chars: int = 20_000) -> Crf | None:
    return train(*sample(df, id_col, text_col, lang_col, is_train, per_language, most_languages, most_chars))


def _read(df: DataFrame, text_col: str, crf: Crf | None, schema: StructType, row: Callable[[pa.RecordBatch, list[tuple[str, float]]], pa.RecordBatch]) -> DataFrame:
    """``row`` of each run of rows and its texts' languages. The model's size is bounded by its sample, so it is broadcast."""
    model = df.sparkSession.sparkContext.broadcast(crf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model.value)
        for part in slices(batches, text_col):
            yield row(part, tagger.predict(part.column(text_col).to_pylist()))
        del tagger
        release_memory()

    return df.mapInArrow(run, schema)


def identify(df: DataFrame, text_col: str, crf: Crf | None, names: tuple[str, str] = ("lang", "score")) -> DataFrame:
    """The columns of ``df`` but the text, then language and score; ``names`` must not be names of ``df``."""
    kept = [x for x in df.schema if x.name != text_col]

    def row(part: pa.RecordBatch, found: list[tuple[str, float]]) -> pa.RecordBatch:
        langs, scores = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays([*(part.column(x.name) for x in kept), pa.array(langs), pa.array(scores)], names=[*(x.name for x in kept), *names])

    return _read(df, text_col, crf, StructType([*kept, StructField(names[0], StringType()), StructField(names[1], DoubleType())]), row)


def keep_identified(df: DataFrame, text_col: str, crf: Crf | None, least: float = 0.4) -> DataFrame:
    """The rows of ``df`` whose language is known with at least that score."""
    return _read(df, text_col, crf, df.schema, lambda part, found: part.filter(pa.array([lang != UNKNOWN and score >= least for lang, score in found])))
