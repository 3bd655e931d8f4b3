"""URL filters by a path-template tree with labelled purity.

Rules label some urls; the tree carries their labels over to urls that no rule fits. A url is the list of its host
and path segments. Per host:

1. Variable segments (numbers, hex strings, dates, identifiers with digits; file endings are kept) become wildcards.
2. Each node of the tree, a prefix of such segments, counts the labelled urls below it and how many are blocked.
3. Level by level, the segments whose block rate does not differ from that of their siblings (two-proportion z test)
   are merged into one wildcard. Where a segment or all of its siblings have no label, nothing tells them apart.
4. A node's purity is the share of blocked urls among the labelled ones below it, smoothed by ``weight`` urls with the
   purity of the node above; the host's is smoothed by urls of which half are blocked. A url takes the purity of its
   template, a leaf of the tree, and is blocked if that exceeds ``limit``. So a template without labels is judged by
   the next node above that has some, and on a host without any it is not rejected.

Everything is grouped by (host, template prefix) with partial sums before the shuffle, so that a host with a third
of all urls is many small groups. All segments count.

Defined results: a null url, or one without ``://``, has an empty host and an empty path, no rule and the verdict of
that empty template. Of rules of equal length the one first in alphabetical order is named. Repeated rows count as
often as they occur. An empty table gives an empty result. Input columns other than the named ones are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraproof.llm.common import cut


@dataclass(frozen=True)
class UrlRule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, with A-Z lower-cased."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[UrlRule, ...]) -> Column:
    """The longest rule that fits, as a struct (rule, verdict); null if none does."""
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.name))
    fits = lambda r: ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
    return F.coalesce(*(F.when(fits(r), F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))) for r in ordered))


def segments(path: Column) -> Column:
    """Path segments with variable ones generalised to ``*``, keeping a file ending."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    variable = r"^(\d+|[0-9a-fA-F]{8,}|\d{4}-\d{2}(-\d{2})?|[0-9a-fA-F]{8}-[0-9a-fA-F-]{27}|(?=[^.]*\d)[\w-]{6,})(\.[A-Za-z]{2,5})?$"
    return F.transform(parts, lambda s: F.when(s.rlike(variable), F.concat(F.lit("*"), F.regexp_extract(s, r"(\.[A-Za-z]{2,5})?$", 1))).otherwise(s))


def _tree(leaves: DataFrame, z: float, weight: float) -> DataFrame:
    """Leaves (host, s, n, blocked) with their merged segments m beside the literal ones s, and the purity above them.

    Level by level: the counts of the nodes (host, merged prefix, literal segment) are compared with those of their
    parent; like ones share a wildcard from there on. A leaf is done where its path ends or no other leaf shares its
    prefix, so there are as many rounds as two different paths have merged segments in common, and one more.
    """
    going, done, level = cut(leaves.withColumns({"m": F.array().cast("array<string>"), "above": F.lit(0.5)})), None, 0
    while not going.isEmpty():
        node = ["host", "m"]
        found = going.withColumn("here", F.coalesce(F.get("s", F.lit(level)), F.lit("")))
        parts = found.groupBy(*node, "here").agg(F.sum("n").alias("n_here"), F.sum("blocked").alias("b_here"), F.count(F.lit(1)).alias("leaves"), F.max("above").alias("above"))
        totals = parts.groupBy(*node).agg(F.sum("n_here").alias("tn"), F.sum("b_here").alias("tb"), F.sum("leaves").alias("all"), F.max("above").alias("prior"))
        both = parts.join(totals, node)
        n, b, rest_n, rest_b = F.col("n_here"), F.col("b_here"), F.col("tn") - F.col("n_here"), F.col("tb") - F.col("b_here")
        some = lambda x: F.greatest(x, F.lit(1))
        pooled = F.col("tb") / some(F.col("tn"))
        gap = F.abs(b / some(n) - rest_b / some(rest_n))
        noise = F.sqrt(pooled * (1 - pooled) * (1 / some(n) + 1 / some(rest_n)))
        alike = (n == 0) | (rest_n == 0) | (gap <= z * noise)
        purity = (F.col("tb") + weight * F.col("prior")) / (F.col("tn") + weight)
        told = both.select(*node, "here", F.when(alike, "*").otherwise(F.col("here")).alias("name"), (F.col("all") == 1).alias("alone"), purity.alias("purity"))
        step = found.join(told, [*node, "here"])
        ends = F.col("here") == ""
        merged = F.when(ends, F.col("m")).when(F.col("alone"), F.concat("m", F.slice("s", F.lit(level + 1), F.size("s")))).otherwise(F.concat("m", F.array("name")))
        step = cut(step.select("host", "s", "n", "blocked", merged.alias("m"), F.col("purity").alias("above"), (ends | F.col("alone")).alias("over")))
        over = step.filter("over").drop("over")
        done = over if done is None else done.unionByName(over)
        going, level = step.filter("NOT over").drop("over"), level + 1
    return going if done is None else done


def judge(df: DataFrame, id_col: str, url_col: str, rules: tuple[UrlRule, ...], z: float = 2.5, weight: float = 4.0, limit: float = 0.5) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict, template, purity (null where a rule decides)."""
    url = F.col(url_col)
    urls = df.select(F.col(id_col).alias("_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    # a rule is all the tree learns from; where a url's label is known its template decides nothing
    keyed = urls.select("*", rule_of(F.col("host"), F.col("path"), rules).alias("_rule"), segments(F.col("path")).alias("s"))
    label = F.when(F.col("_rule").isNotNull(), 1).otherwise(0)
    block = F.when(F.col("_rule.verdict") == "block", 1).otherwise(0)
    tree = cut(_tree(keyed.groupBy("host", "s").agg(F.sum(label).alias("n"), F.sum(block).alias("blocked")), z, weight))
    scored = tree.groupBy("host", "m").agg(F.sum("n").alias("tn"), F.sum("blocked").alias("tb"), F.max("above").alias("above"))
    purity = (F.col("tb") + weight * F.col("above")) / (F.col("tn") + weight)
    template = F.concat(F.lit("/"), F.array_join("m", "/"))
    verdicts = cut(tree.select("host", "m", "s").join(scored.select("host", "m", purity.alias("purity")), ["host", "m"]).select("host", "s", template.alias("template"), "purity"))
    # The side of the templates is unique by key; a frequent template is the sort-merge join's skew, which it splits.
    out = keyed.join(verdicts, ["host", "s"], "left")
    by_tree = F.when(F.col("purity") > limit, "block").otherwise("allow")
    return out.select(
        F.col("_id").alias(id_col), "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce(F.col("_rule.verdict"), by_tree).alias("verdict"),
        F.when(F.col("_rule").isNull(), F.col("template")).alias("template"), F.when(F.col("_rule").isNull(), F.round("purity", 6)).alias("purity"),
    )
