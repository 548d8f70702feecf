"""URL filters: explicit rules first, then per-host trees of path templates judged by labelled purity.

A rule is a host and a path (``com/fr/``); it fits its host and all subdomains when the path starts with the rule's
path, and the longest rule that fits decides. Other urls are judged by their template:

1. The first ``DEPTH`` segments of a path are the levels of its host's tree; deeper ones become ``**``. Segments with a
   digit are variable at once: ``17.html`` is ``*.html``.
2. Level by level, at each node that has several children: those with labels whose share of bad ones does not differ from that of the
   whole node by ``z`` standard errors merge into the wildcard ``*`` (branches that are statistically similar); one that does
   differ stays a branch of its own, however rare; those without any label merge into a wildcard ``?`` of their own, so no label
   of a sibling speaks for them. An only child keeps its name.
3. A template is rejected when its smoothed share of bad labels, (bad + a p) / (labelled + a), reaches ``reject``; without
   labels it has the prior p.

Urls are first counted per host and masked path, so the tree works on counts; only joins by key and sums by key are
used, and a hot host is combined before it is shuffled.

Defined results: a null url or one without ``://`` has an empty host and path and is judged by the template of that
host; of two equally long rules that fit the first in the list decides; equal rows get equal rows; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from dayloom.session import stored

DEPTH = 3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]


class Settings(NamedTuple):
    """What decides about wildcards, merging and rejection."""

    z: float = 3.0
    prior: float = 0.1
    strength: float = 4.0
    reject: float = 0.5


def host_of(url: Column) -> Column:
    rest = _after_scheme(url)
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    rest = _after_scheme(url)
    return F.regexp_extract(F.regexp_replace(rest, "^[^/?#]*", ""), "^[^?#]*", 0)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """(name, verdict) of the longest rule that fits, the first of equally long ones, else null."""
    found = F.lit(None).cast("struct<name:string,verdict:string>")
    for rule in sorted(reversed(rules), key=lambda r: len(r.name)):  # the last that fits stays
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def masked_segments(path: Column) -> Column:
    """The levels of a path, variable segments masked."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    first = F.transform(
        F.slice(parts, 1, DEPTH),
        lambda s: F.when(s.rlike("[0-9]"), F.concat(F.lit("*"), F.regexp_extract(s, r"(\.[A-Za-z]+)$", 1))).otherwise(s),
    )
    return F.when(F.size(parts) > DEPTH, F.concat(first, F.array(F.lit("**")))).otherwise(first)


def path_templates(counted: DataFrame, settings: Settings) -> DataFrame:
    """``counted(host, segments, n, good, bad)`` with ``template``."""
    tree = stored(counted.withColumn("template", F.lit("")))
    sums = [F.sum(c).alias(c) for c in ("n", "good", "bad")]
    node = ["host", "template"]
    for level in range(DEPTH + 1):
        tree = tree.withColumn("child", F.get("segments", F.lit(level)))
        children = tree.where("child IS NOT NULL").groupBy(*node, "child").agg(*sums)
        whole = children.groupBy(*node).agg(
            F.count("*").alias("n_children"), *[F.sum(c).alias(f"all_{c}") for c in ("good", "bad")]
        )
        labelled, all_labelled = F.col("good") + F.col("bad"), F.col("all_good") + F.col("all_bad")
        rate = (F.col("all_bad") + settings.prior) / (all_labelled + 1)
        apart = F.abs(F.col("bad") - labelled * rate) > settings.z * F.sqrt(labelled * rate * (1 - rate))
        several = F.col("n_children") > 1
        wildcard = F.when(several & (labelled == 0), "?").when(several & ~apart, "*")
        # a suffix such as .html is no variable part
        general = F.concat(wildcard, F.regexp_extract("child", r"^\*(\.[A-Za-z]+)$", 1))
        named = children.join(whole, node).select(*node, "child", F.coalesce(general, "child").alias("step"))
        # stored: each level reads the tree twice, and a plan of all levels would double with each
        tree = stored(tree.join(named, [*node, "child"], "left").withColumn(
            "template", F.when(F.col("step").isNull(), F.col("template")).otherwise(F.concat_ws("/", "template", "step"))
        ).drop("child", "step"))
    return tree


def judge(pages: DataFrame, rules: list[Rule], label: str | None = None, settings: Settings = Settings()) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) of every row of ``pages(page_id, url)``.

    ``label`` names a boolean column, true for bad; without it the urls that a rule decides are the labelled ones.
    """
    given = F.col(label) if label else F.lit(None).cast("boolean")
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), given.alias("given"))
    urls = urls.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    bad = F.col("given") if label else F.col("rule.verdict") == "block"
    urls = urls.withColumn("bad", bad).withColumn("segments", masked_segments(F.col("path")))
    counted = urls.groupBy("host", "segments").agg(
        F.count("*").alias("n"), F.count_if(~F.col("bad")).alias("good"), F.count_if("bad").alias("bad")
    )
    tree = path_templates(counted, settings)
    totals = tree.groupBy("host", "template").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    purity = (F.col("bad") + settings.strength * settings.prior) / (F.col("good") + F.col("bad") + settings.strength)
    judged = tree.select("host", "segments", "template").join(
        totals.select("host", "template", purity.alias("purity")), ["host", "template"]
    )
    own = F.when(F.col("purity") >= settings.reject, "block").otherwise("allow")
    return urls.join(judged, ["host", "segments"]).select(
        "page_id", "host", "path", F.col("rule.name").alias("rule"), F.coalesce("rule.verdict", own).alias("verdict"),
        "template", "purity",
    )
