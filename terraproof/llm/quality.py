"""Quality rules: a table of thresholds compiled into one Spark projection.

Every figure is a column expression over the whole text; no user function runs. ``RULES`` names a ratio and the
bounds it must keep; a row passes where all ratios do. Rules are data: pass another table to change the verdict.

Defined results: a null text has no words. With no words every ratio is 0. ``base_failed`` rows are never kept.
Repeated rows give repeated results. Working columns carry a reserved prefix and are dropped again, so that
input columns of any name go through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraproof.llm.common import WORD_BREAK

#: Frequent short words of the languages to keep.
STOP_WORDS = (
    "the of and to in is it for on was be with that are as by this have from or an a at not which "
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an "
    "de la le les et en des un du une que est pour qui dans par sur au pas plus "
    "el los las y por con para una del se su al lo como"
)
P = "__quality_"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


@dataclass(frozen=True)
class Rule:
    """``numerator / denominator`` has to lie within the bounds; both name figures of ``FIGURES``."""

    name: str
    numerator: str
    denominator: str
    least: float = 0.0
    most: float = float("inf")


RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 3.0, 12.0),
    Rule("symbol_ratio", "n_symbols", "n_words", most=0.1),
    Rule("shout_ratio", "n_shouts", "n_words", most=0.3),
    Rule("upper_ratio", "n_upper", "word_chars", most=0.3),
    Rule("stop_word_ratio", "n_stop_words", "n_words", least=0.05),
    Rule("dup_line_ratio", "n_dup_lines", "n_lines", most=0.5),
)
FIGURES = ("n_words", "word_chars", "n_symbols", "n_shouts", "n_upper", "n_stop_words", "n_lines", "n_dup_lines", "n_repeat_words")


def _repeat_words(words: Column, keys: Column, n: Column) -> Column:
    """Words inside three-word windows that occur twice or more.

    ``keys`` packs 32 bits of each window's hash above its position. Sorting puts equal hashes side by side;
    only windows whose hash has an equal neighbour are then compared word by word, so that the count is exact.
    """
    top = lambda a, k: F.shiftright(F.get(a, k), 32)
    order = F.sort_array(keys)
    m = n - 2
    near = lambda a, k: ((k > 0) & (top(a, k) == top(a, k - 1))) | ((k < m - 1) & (top(a, k) == top(a, k + 1)))
    with_order = lambda a: F.filter(F.sequence(F.lit(0), m - 1), lambda k: near(a, k))
    # transform over a one-element array binds the sorted array to a name, so that it is sorted once
    suspects = F.flatten(F.transform(F.array(order), lambda a: F.transform(with_order(a), lambda k: F.get(a, k).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"))))
    windows = F.sort_array(F.transform(suspects, lambda p: F.struct(F.get(words, p).alias("a"), F.get(words, p + 1).alias("b"), F.get(words, p + 2).alias("c"), p.alias("p"))))
    same = lambda e, k, j: (F.get(e, k)["a"] == F.get(e, j)["a"]) & (F.get(e, k)["b"] == F.get(e, j)["b"]) & (F.get(e, k)["c"] == F.get(e, j)["c"])

    def covered(e: Column) -> Column:
        size = F.size(e)
        twice = F.filter(F.sequence(F.lit(0), size - 1), lambda k: ((k > 0) & same(e, k, k - 1)) | ((k < size - 1) & same(e, k, k + 1)))
        at = F.transform(twice, lambda k: F.get(e, k)["p"])
        return F.when(size > 0, F.size(F.array_distinct(F.flatten(F.transform(at, lambda p: F.array(p, p + 1, p + 2)))))).otherwise(0)

    return F.get(F.transform(F.array(windows), covered), 0)


def with_figures(df: DataFrame, text_col: str) -> DataFrame:
    """``df`` with one column for each of FIGURES, under the reserved prefix."""
    c = lambda name: F.col(P + name)
    stops = sorted(set(STOP_WORDS.split()))
    has_word = r"[^\x20\x09-\x0D]"
    df = df.withColumn(P + "text", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    df = df.withColumns({
        P + "words": F.array_remove(F.split(c("text"), WORD_BREAK), ""),
        P + "lines": F.filter(F.split(c("text"), "\n"), lambda x: x.rlike(has_word)),
        P + "word_chars": (F.length(c("text")) - F.regexp_count(c("text"), F.lit(r"[\x20\x09-\x0D]"))).cast("long"),
        P + "n_symbols": F.regexp_count(c("text"), F.lit(r"[#*$%&|<>]")).cast("long"),
        P + "n_shouts": F.regexp_count(c("text"), F.lit(r"[!?]")).cast("long"),
        P + "n_upper": F.regexp_count(c("text"), F.lit(r"\p{Lu}")).cast("long"),
    })
    df = df.withColumn(P + "n", F.size(c("words")))
    hashed = F.transform(F.sequence(F.lit(0), c("n") - 3), lambda i: F.shiftleft(F.xxhash64(F.get(c("words"), i), F.get(c("words"), i + 1), F.get(c("words"), i + 2)), 32).bitwiseOR(i.cast("long")))
    df = df.withColumn(P + "keys", F.when(c("n") >= 4, hashed).otherwise(F.array().cast("array<bigint>")))
    distinct = F.size(F.array_distinct(F.transform(c("keys"), lambda k: F.shiftright(k, 32))))
    df = df.withColumns({
        P + "n_words": c("n").cast("long"),
        P + "n_stop_words": F.size(F.filter(c("words"), lambda w: F.lower(w).isin(stops))).cast("long"),
        P + "n_lines": F.size(c("lines")).cast("long"),
        P + "n_dup_lines": (F.size(c("lines")) - F.size(F.array_distinct(c("lines")))).cast("long"),
        P + "n_repeat_words": F.when(distinct == F.size(c("keys")), 0).otherwise(_repeat_words(c("words"), c("keys"), c("n"))).cast("long"),
        P + "task": F.spark_partition_id(),
    })
    return df.drop(*(P + x for x in ("text", "words", "lines", "n", "keys")))


def base_failed() -> Column:
    n, r = F.col(P + "n_words"), F.col(P + "n_repeat_words")
    return (n < MIN_WORDS) | (100 * r > MAX_REPEAT_PERCENT * n)


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """True where the base rules and every rule of the table hold."""
    kept = ~base_failed()
    for r in rules:
        a, b = F.col(P + r.numerator).cast("double"), F.col(P + r.denominator).cast("double")
        ratio = F.when(b > 0, a / b).otherwise(F.lit(0.0))
        if r.least > 0:
            kept = kept & (ratio >= r.least)
        if r.most < float("inf"):
            kept = kept & (ratio <= r.most)
    return kept


def score_quality(df: DataFrame, id_col: str, text_col: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per input row: id, the figures, ``base_failed`` and ``kept``."""
    slim = df.select(F.col(id_col), F.col(text_col).alias(P + "source"))
    return with_figures(slim, P + "source").select(F.col(id_col), *(F.col(P + x).alias(x) for x in FIGURES), base_failed().alias("base_failed"), verdict(rules).alias("kept"))


def keep_good(df: DataFrame, text_col: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``df`` that pass, with the columns of ``df``.

    The task number keeps the optimizer from moving the filter below the projection, which would write the
    figures' expressions out again for every use.
    """
    return with_figures(df, text_col).filter(verdict(rules) & (F.col(P + "task") >= 0)).select(*df.columns)
