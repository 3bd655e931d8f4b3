"""BPE encoding and decoding by tree concatenation.

A text longer than ``leaf`` is halved until every piece fits; the halves are encoded on their own and joined
bottom-up. Around each join a window is encoded anew and grown until both sides agree exactly:

* White space ends every pre-token of the vocabularies in question, so a join beside white space agrees at once.
* A join inside a blank-free run re-encodes that run, if it has no more than ``leaf`` characters.
* In a longer blank-free run the tokens of both sides are kept with their places. The window starts at ``margin`` characters
  on either side and doubles until, on each side of the join, it shares a token (same id, same span, clean edges) with the
  encoding of that side; the tokens of the sides beyond are taken over as they are. Every
  adjacent pair of tokens then stands next to each other in some correct encoding, which is what makes the
  joined sequence the correct one. A window that reaches the end of a side needs no agreement there.

Encodings of short blank-free runs are kept in a bounded cache, as natural text repeats them. A new run made of
Western European letters and a tail of ASCII signs without apostrophe is two pre-tokens at most and goes to the
library's merge model directly; every other run goes through the library's whole chain.
Texts longer than ``spread`` are cut into parts that a shuffle deals to different tasks, which encode them in parallel;
only their ids, tokens and edge runs then come together by text to be joined. All others are halved and joined in the
task that reads them. Both ways run the same joins and give the same ids.

Defined results: a null text is the empty text; it has 0 tokens, and both its texts are empty. Repeated rows
give repeated results. Input columns other than the id and the text are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from terraproof.llm.cache import Recent, byte_letters
from terraproof.llm.common import cut, release_memory, slices

#: Letters without any normal form but their own, then signs that make one pre-token.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
BLANKS = " \t\n\x0b\x0c\r"
RESULT = "n_tokens long, ids_sha256 string, decoded_sha256 string"


class Encoded:
    """Ids of one blank-free run as text, its tokens as text, and how many there are."""

    __slots__ = ("ids", "tokens", "n")

    def __init__(self, ids: list[int], tokens: list[str]):
        self.ids, self.tokens, self.n = " ".join(map(str, ids)), " ".join(tokens), len(ids)


class Spanned:
    """A long run: its tokens as rows of id, start, end, so that a join can take them over."""

    __slots__ = ("spans", "token")

    def __init__(self, spans: np.ndarray, token: Callable[[int], str]):
        self.spans, self.token = spans, token

    @property
    def n(self) -> int:
        return len(self.spans)

    @property
    def ids(self) -> str:
        return " ".join(map(str, self.spans[:, 0].tolist()))

    @property
    def tokens(self) -> str:
        return " ".join(map(self.token, self.spans[:, 0].tolist()))


class Piece:
    """An encoded piece of a text: its runs, and whether it begins or ends with white space."""

    __slots__ = ("first", "last", "runs", "opens", "closes")

    def __init__(self, first: str, last: str, runs: list[Encoded], opens: bool, closes: bool):
        self.first, self.last, self.runs, self.opens, self.closes = first, last, runs, opens, closes


class TreeEncoder:
    def __init__(self, path: str, leaf: int = 4096, margin: int = 64, cache: int = 250_000):
        if leaf < 1 or margin < 1:
            raise ValueError("leaf and margin are at least 1")
        self.tokenizer, self.leaf, self.margin = Tokenizer.from_file(path), leaf, margin
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.token = {i: x for x, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}.__getitem__
        self.known, self.parts, self.letters = Recent(cache), Recent(cache), byte_letters()
        self.read = 0  # characters that runs with places were read from
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]

    # runs -----------------------------------------------------------------

    def _tokens(self, text: str) -> np.ndarray:
        """Id, start, end of each token of a blank-free text."""
        e = self.tokenizer.encode(text, add_special_tokens=False)
        self.read += len(text)
        out = np.empty((len(e.ids), 3), np.int64)
        out[:, 0], out[:, 1:] = e.ids, np.array(e.offsets, np.int64).reshape(-1, 2)
        return out

    def _long_run(self, text: str) -> np.ndarray:
        """Tokens of a long blank-free run, from its halves."""
        if len(text) <= self.leaf:
            return self._tokens(text)
        cut = len(text) // 2
        return self._spliced(text, self._long_run(text[:cut]), self._long_run(text[cut:]), cut)

    def _spliced(self, text: str, left: np.ndarray, right: np.ndarray, cut: int) -> np.ndarray:
        """Tokens of a text from those of its two sides, read anew only in a window around the join."""
        width = self.margin
        while True:
            start, end = max(0, cut - width), min(len(text), cut + width)
            window = self._tokens(text[start:end]) + (0, start, start)
            # of the sides only what reaches into the window is looked at
            low, high = int(np.searchsorted(left[:, 2], start)), int(np.searchsorted(right[:, 1], end - cut, side="right"))
            here, ahead, behind = window.tolist(), left[low:].tolist(), (right[:high] + (0, cut, cut)).tolist()
            head = _agreed(ahead, here, range(len(here) - 1), cut, before=True) if start else (-low, 0)
            tail = _agreed(behind, here, range(len(here) - 1, 0, -1), cut, before=False) if end < len(text) else (len(right), len(here))
            if head and tail and head[1] <= tail[1]:
                return np.concatenate([left[: low + head[0]], window[head[1] : tail[1]], right[tail[0] :] + (0, cut, cut)])
            width *= 2

    def _part(self, text: str) -> Encoded:
        """One pre-token of plain letters or signs."""
        found = self.parts.young.get(text) or self.parts.old_or_none(text)
        if found is None:
            tokens = self.tokenizer.model.tokenize(text if text.isascii() else text.encode().decode("latin-1").translate(self.letters))
            found = Encoded([x.id for x in tokens], [x.value for x in tokens])
            self.parts.put(text, found)
        return found

    def _new(self, run: str) -> Encoded:
        if len(run) > self.leaf:
            return Spanned(self._long_run(run), self.token)
        plain = PLAIN.fullmatch(run)
        if plain and not any(x in run for x in self.special):
            word = self._part(plain[1].lower())
            if not plain[2]:
                return word
            tail, both = self._part(plain[2]), Encoded((), ())
            both.ids, both.tokens, both.n = f"{word.ids} {tail.ids}", f"{word.tokens} {tail.tokens}", word.n + tail.n
            return both
        ids = self.tokenizer.encode(run, add_special_tokens=False).ids
        return Encoded(ids, list(map(self.token, ids)))

    def _runs(self, runs: list[str]) -> list[Encoded]:
        out = list(map(self.known.young.get, runs))
        if None in out:
            young = self.known.young
            for k, e in enumerate(out):
                if e is None:
                    run = runs[k]
                    out[k] = e = young.get(run) or self.known.old_or_none(run) or self._new(run)
                    if len(run) <= 64:
                        young[run] = e
            self.known.turn()
            self.parts.turn()
        return out

    # pieces ---------------------------------------------------------------

    def encode_leaf(self, text: str) -> Piece:
        runs = [x.decode("utf-8", "surrogatepass") for x in text.encode("utf-8", "surrogatepass").split()]
        return Piece(runs[0] if runs else "", runs[-1] if runs else "", self._runs(runs), text[:1] in BLANKS, text[-1:] in BLANKS)

    def join(self, a: Piece, b: Piece) -> Piece:
        """The piece of the joined text."""
        if not a.runs or not b.runs:
            kept = a if a.runs else b
            blank = not a.runs and (a.opens or b.opens) if kept is b else a.opens
            return Piece(kept.first, kept.last, kept.runs, blank, b.closes if kept is b else a.closes or b.closes)
        if a.closes or b.opens:
            return Piece(a.first, b.last, a.runs + b.runs, a.opens, b.closes)
        both = a.last + b.first
        if len(both) > self.leaf:
            run = Spanned(self._spliced(both, self._spans(a.last, a.runs[-1]), self._spans(b.first, b.runs[0]), len(a.last)), self.token)
        else:
            (run,) = self._runs([both])
        first = both if len(a.runs) == 1 else a.first
        return Piece(first, both if len(b.runs) == 1 else b.last, [*a.runs[:-1], run, *b.runs[1:]], a.opens, b.closes)

    def _spans(self, text: str, run: Encoded | Spanned) -> np.ndarray:
        return run.spans if isinstance(run, Spanned) else self._tokens(text)

    def join_all(self, pieces: list[Piece]) -> Piece:
        """Neighbours are joined level by level."""
        while len(pieces) > 1:
            pieces = [self.join(*pieces[i : i + 2]) if i + 1 < len(pieces) else pieces[i] for i in range(0, len(pieces), 2)]
        return pieces[0]

    def encode(self, text: str) -> Piece:
        if len(text) <= self.leaf:
            return self.encode_leaf(text)
        cut = len(text) // 2
        return self.join(self.encode(text[:cut]), self.encode(text[cut:]))


def _agreed(side: list, window: list, order: range, cut: int, before: bool) -> tuple[int, int] | None:
    """Where to leave one sequence for the other: (index in side, index in window) behind or before a shared token.

    The shared token nearest to the window's edge is not taken but the one after it, as the first may be a
    fragment that only looks alike.
    """
    at = {(x[1], x[2]): k for k, x in enumerate(side)}
    seen = 0
    for k in order:
        i, a, b = window[k]
        if (b >= cut) if before else (a <= cut):
            return None
        near = window[k + 1] if before else window[k - 1]
        clean = near[1] == b if before else near[2] == a
        if clean and b > a and (j := at.get((a, b))) is not None and side[j][0] == i:
            seen += 1
            if seen == 2:
                return (j + 1, k + 1) if before else (j, k)
        else:
            seen = 0
    return None


@lru_cache(maxsize=4)
def encoder(path: str, leaf: int, margin: int) -> TreeEncoder:
    """One encoder for each worker process."""
    return TreeEncoder(path, leaf, margin)


def ids_text(piece: Piece) -> str:
    return " ".join([x.ids for x in piece.runs if x.n])


def decoded_text(piece: Piece) -> str:
    """As ``decode(ids, skip_special_tokens=False)`` of a tokenizer without a decoder: tokens joined by blanks."""
    return " ".join([x.tokens for x in piece.runs if x.n])


def _row(piece: Piece, texts: bool) -> tuple:
    ids, decoded = ids_text(piece), decoded_text(piece)
    n = sum([x.n for x in piece.runs])
    return (n, *(hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in (ids, decoded)), *((ids, decoded) if texts else ()))


#: ``head`` and ``tail``: starts, then ends, of the tokens of a long run that begins or ends a part.
PART = "_key string, _at int, first string, last string, opens boolean, closes boolean, ids array<string>, tokens array<string>, n array<long>, head array<int>, tail array<int>"


def ends_apart(piece: Piece) -> list[Encoded]:
    """A piece's runs, all between the first and the last as one: joins only touch those two."""
    if len(piece.runs) < 4:
        return piece.runs
    inner, middle = Encoded((), ()), [x for x in piece.runs[1:-1] if x.n]
    inner.ids, inner.tokens, inner.n = " ".join([x.ids for x in middle]), " ".join([x.tokens for x in middle]), sum([x.n for x in middle])
    return [piece.runs[0], inner, piece.runs[-1]]


def _places(run: Encoded | Spanned) -> list[int] | None:
    return run.spans[:, 1:].T.ravel().tolist() if isinstance(run, Spanned) else None


def _again(e: TreeEncoder, row: tuple) -> Piece:
    """A piece as it came through the shuffle."""
    runs: list[Encoded | Spanned] = []
    for k, (ids, tokens, n) in enumerate(zip(row.ids, row.tokens, row.n, strict=True)):
        places = row.head if k == 0 and row.head is not None else row.tail if k == len(row.ids) - 1 else None
        if places is not None:
            at = np.asarray(places, np.int64)
            runs.append(Spanned(np.column_stack([np.array(ids.split(" ") if n else [], np.int64), at[: int(n)], at[int(n) :]]), e.token))
        else:
            run = Encoded((), ())
            run.ids, run.tokens, run.n = ids, tokens, int(n)
            runs.append(run)
    return Piece(row.first, row.last, runs, row.opens, row.closes)


def encode_texts(df: DataFrame, id_col: str, text_col: str, path: str, leaf: int = 4096, margin: int = 64, spread: int = 65_536, texts: bool = False) -> DataFrame:
    """Per row: id, n_tokens, digests of ids and decoded text and, with ``texts``, both as text.

    ``path`` is a tokenizers file without a decoder whose pre-tokens never span ASCII white space. ``spread``
    counts characters.
    """
    names = [x.split()[0] for x in RESULT.split(", ")] + ["ids", "decoded"] * texts
    result = RESULT + (", ids string, decoded string" if texts else "")
    rows = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    id_type = rows.schema["_id"].dataType.simpleString()
    kinds = [pa.int64(), *[pa.string()] * (len(names) - 1), pa.string(), pa.int32(), pa.string()]

    def here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, apart, seen = encoder(path, leaf, margin), (None,) * len(names), set()
        for batch in slices(batches, "_text"):
            out = []
            for k, text in enumerate(batch.column("_text").to_pylist()):
                if len(text) <= spread:
                    out.append((k, *_row(e.encode(text), texts), None, None, None))
                    continue
                key = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
                out.append((k, *apart, key, None, None))
                if key not in seen:  # copies in one task are cut once
                    seen.add(key)
                    out += [(None, *apart, key, at, text[at * spread : (at + 1) * spread]) for at in range(-(-len(text) // spread))]
            owner, *rest = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([batch.column("_id").take(pa.array(owner, pa.int64())), *map(pa.array, rest, kinds)], names=["_id", *names, "_key", "_at", "_part"])
        release_memory()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, named = encoder(path, leaf, margin), [x.split()[0] for x in PART.split(", ")]
        for batch in slices(batches, "_part"):
            out = []
            for key, at, text in zip(*(batch.column(x).to_pylist() for x in ("_key", "_at", "_part")), strict=True):
                piece = e.encode(text)
                runs = ends_apart(piece)
                out.append((key, at, piece.first, piece.last, piece.opens, piece.closes, *([getattr(x, held) for x in runs] for held in ("ids", "tokens", "n")), *((_places(x) for x in (runs[0], runs[-1])) if runs else (None, None))))
            to = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.bool_(), pa.bool_(), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*out, strict=True), to)), names=named)
        release_memory()

    def joined(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        e, pdf = encoder(path, leaf, margin), pdf.sort_values("_at")
        piece = e.join_all([_again(e, x) for x in pdf.itertuples()])
        return pd.DataFrame([(key[0], *_row(piece, texts))], columns=["_key", *names])

    # one pass over the table: results of all texts but the long ones, which come along in parts
    first = cut(rows.mapInArrow(here, f"_id {id_type}, {result}, _key string, _at int, _part string"))
    short = first.filter("_key IS NULL").select("_id", *names)
    # the shuffle that drops copies deals the parts of a text to different tasks; their ids then meet by text
    parts = first.filter("_at IS NOT NULL").select("_key", "_at", "_part").dropDuplicates(["_key", "_at"])
    whole = parts.mapInArrow(encoded, PART).groupBy("_key").applyInPandas(joined, f"_key string, {result}")
    far = first.filter("_key IS NOT NULL AND _at IS NULL").select("_id", "_key").join(whole, "_key").select("_id", *names)
    return short.unionByName(far).withColumnRenamed("_id", id_col)
