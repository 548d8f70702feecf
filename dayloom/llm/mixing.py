"""Mixing sources to target weights, by budgets handed down a tree of domain, language and source.

*Budgets.* The total goes to the domains, a domain's share to its languages, a language's to its sources. At each node
the children get shares in proportion to their weights, but none more than all leaves below it can give (their tokens
times ``max_epochs``); what one child cannot take goes to its siblings by the same proportion. So a shortage reaches an
ancestor's other children only when the whole subtree is used up. Among siblings sorted by capacity per weight those
that fill up come first, which makes each level one window sum over the children of a node.

*Selection.* A leaf's budget is so many whole epochs and a rest. In epoch e documents come in the order of
md5(seed, e, doc_id, md5 of the text); the rest is a prefix of the next epoch's tokens, whose last document is cut after
as many words as are left. To find the cut, tokens are summed by leaf and the first ``BUCKET_DIGITS`` digits of the key,
the sums are added up, and only the bucket that holds the cut is looked into. Neither a leaf nor a node is ever gathered.

Tokens are words: runs of characters other than space and ``\\t \\n \\v \\f \\r``.

Defined results: a null domain, language or source is a branch of its own; a null or empty text has no tokens and comes
along where its key lies before the cut; rows equal in doc_id and text share a key and, at the cut, share the rest; an
empty table gives no rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from dayloom.session import stored

BUCKET_DIGITS = 3  # of the key, that tell rows of a bucket apart; a bucket with more than MOST_ROWS is opened by as many more
MOST_ROWS = 10_000
LEVELS = ["domain", "lang", "source"]
_KEY_DIGITS = 32
_BLANKS = r"[\x20\x09-\x0D]+"


class Plan(NamedTuple):
    """Weights by value of each level, and the size of the mixture."""

    domains: dict[str, float]
    languages: dict[str, float]
    sources: dict[str, float]
    other: float = 1.0  # weight of values that are not named
    share: float = 0.5  # tokens of the mixture, as a share of all
    max_epochs: int = 2
    seed: int = 7


def words_in(text: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), _BLANKS), lambda w: w != "")).cast("bigint")


def _key(seed: int, epoch: Column) -> Column:
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), name, "text_md5"))


def _weight(level: str, values: dict[str, float], other: float) -> Column:
    weight = F.lit(float(other))
    for value, w in values.items():
        weight = F.when(F.col(level) == value, F.lit(float(w))).otherwise(weight)
    return weight


def _share_out(children: DataFrame, parent: list[str]) -> DataFrame:
    """``children(weight, capacity, total)`` with ``budget``: shares of the parent's total within the capacities."""
    siblings = Window.partitionBy(*parent)
    by_level = [F.col(c).asc_nulls_first() for c in LEVELS if c in children.columns]
    in_order = siblings.orderBy(F.col("per_weight").asc_nulls_last(), *by_level)
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    summed = children.withColumn("per_weight", F.col("capacity") / F.nullif(F.col("weight"), F.lit(0.0))).select(
        "*",
        F.row_number().over(in_order).alias("place"),
        (F.col("total") - F.coalesce(F.sum("capacity").over(before), F.lit(0))).alias("left"),
        (F.sum("weight").over(siblings) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("weight_left"),
    )
    # each takes all it has as long as the rate of those after it would give it more
    rated = summed.withColumn("rate", F.greatest("left", F.lit(0.0)) / F.nullif(F.col("weight_left"), F.lit(0.0)))
    filled = rated.withColumn("filled", F.coalesce(F.col("rate") * F.col("weight") >= F.col("capacity"), F.lit(False)))
    first = F.min(F.when(~F.col("filled"), F.struct("place", "rate"))).over(siblings)
    part = F.least(F.col("capacity").cast("double"), F.coalesce(first["rate"] * F.col("weight"), F.lit(0.0)))
    budget = F.when(F.col("filled"), F.col("capacity").cast("double")).otherwise(part)
    return filled.withColumn("budget", budget).drop("per_weight", "place", "left", "weight_left", "rate", "filled", "total")


def budgets(supply: DataFrame, plan: Plan) -> DataFrame:
    """``supply(domain, lang, source, tokens)``, one row per leaf, with its whole ``budget``."""
    weights = {"domain": plan.domains, "lang": plan.languages, "source": plan.sources}
    leaves = supply.withColumn("capacity", F.col("tokens") * plan.max_epochs)
    total = (leaves.agg(F.sum("tokens")).first()[0] or 0) * plan.share
    above = None
    for depth, level in enumerate(LEVELS):
        keys = LEVELS[: depth + 1]
        nodes = leaves.groupBy(*keys).agg(F.sum("capacity").alias("capacity"))
        nodes = nodes.withColumn("weight", _weight(level, weights[level], plan.other))
        if above is None:
            nodes = nodes.withColumn("total", F.lit(float(total)))
        else:
            parent = above.select(*[F.col(k).alias(f"_{k}") for k in keys[:-1]], F.col("budget").alias("total"))
            same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys[:-1]]
            nodes = nodes.join(parent, same).drop(*[f"_{k}" for k in keys[:-1]])
        above = _share_out(nodes, keys[:-1])
    return above.withColumn("budget", F.floor(F.col("budget") + 1e-6).cast("bigint")).drop("weight", "capacity")


def _with_plan(rows: DataFrame, leaves: DataFrame) -> DataFrame:
    """``rows`` with the columns of their leaf's plan."""
    renamed = leaves.select(*[F.col(k).alias(f"_{k}") for k in LEVELS], *[c for c in leaves.columns if c not in LEVELS])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in LEVELS]
    return rows.join(renamed, same).drop(*[f"_{k}" for k in LEVELS])


def _cut_buckets(keyed: DataFrame, cut_in: DataFrame, digits: int) -> DataFrame:
    """Of each leaf's bucket in ``cut_in`` the one of ``digits`` digits within it where the tokens taken reach ``rest``."""
    rows = _with_plan(keyed, cut_in.select(*LEVELS, "rest", "before", "cut_bucket"))
    rows = rows.where(F.col("key").startswith(F.col("cut_bucket"))).withColumn("bucket", F.substring("key", 1, digits))
    buckets = rows.groupBy(*LEVELS, "rest", "before", "bucket").agg(
        F.sum("n_tokens").alias("n"), F.approx_count_distinct("key").alias("rows")
    )
    so_far = Window.partitionBy(*LEVELS).orderBy("bucket")
    buckets = buckets.withColumn("upto", F.col("before") + F.sum("n").over(so_far))
    cut = buckets.where("upto >= rest AND upto - n < rest")
    return cut.select(*LEVELS, "rest", (F.col("upto") - F.col("n")).alias("before"), F.col("bucket").alias("cut_bucket"), "rows")


def leaf_plans(sizes: DataFrame, plan: Plan) -> DataFrame:
    """Per leaf: ``epochs`` taken whole, and key and tokens of the document at which the next one is cut.

    ``sizes(doc_id, text_md5, domain, lang, source, n_tokens)`` is read three times: pass a stored frame.
    """
    supply = sizes.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    leaves = _with_plan(supply, budgets(supply, plan))
    leaves = leaves.withColumn("epochs", F.coalesce(F.expr("budget div nullif(tokens, 0)"), F.lit(0)))
    leaves = stored(leaves.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens")))
    open_ = leaves.where("rest > 0").select(*LEVELS, "epochs", "rest")
    keyed = _with_plan(sizes, open_).withColumn("key", _key(plan.seed, F.col("epochs") + 1))
    # the bucket in which each leaf is cut, by the first digits of the key: 4,096 sums per leaf and round
    cut_in = open_.select(*LEVELS, "rest", F.lit(0).cast("bigint").alias("before"), F.lit("").alias("cut_bucket"))
    digits, most = 0, MOST_ROWS + 1
    while most > MOST_ROWS and digits < _KEY_DIGITS:
        digits += BUCKET_DIGITS
        cut_in = stored(_cut_buckets(keyed.drop("rest"), cut_in, digits).select(*LEVELS, "rest", "before", "cut_bucket", "rows"))
        most = cut_in.agg(F.max("rows")).first()[0] or 0
    inside = _with_plan(keyed.drop("rest"), cut_in.drop("rows")).where(F.substring("key", 1, digits) == F.col("cut_bucket"))
    same_key = inside.groupBy(*LEVELS, "rest", "before", "key").agg(
        F.sum("n_tokens").alias("n"), F.count("*").alias("copies")
    )
    same_key = same_key.withColumn("upto", F.col("before") + F.sum("n").over(Window.partitionBy(*LEVELS).orderBy("key")))
    cut = same_key.where("upto >= rest AND upto - n < rest").select(
        *LEVELS, F.col("key").alias("cut_key"), F.expr("(rest - upto + n) div copies").alias("cut_tokens")
    )
    renamed = cut.select(*[F.col(k).alias(f"_{k}") for k in LEVELS], "cut_key", "cut_tokens")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in LEVELS]
    return leaves.join(renamed, same, "left").select(*LEVELS, "budget", "epochs", "cut_key", "cut_tokens")


def mixture(docs: DataFrame, domain: Column, plan: Plan, carry: list[str]) -> DataFrame:
    """(doc_id, domain, lang, source, n_tokens, epoch, taken, <carry>): a row per document and epoch it is taken in.

    ``carry`` names columns of ``docs`` that come along, in a struct ``row``.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.lit(None).cast("string")
    named = docs.select(
        "doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"), domain.alias("domain"), "lang", "source",
        words_in(F.col("text")).alias("n_tokens"), row.alias("row"),
    )
    sizes = stored(named.drop("row"))
    planned = _with_plan(named, stored(leaf_plans(sizes, plan)))  # a row per leaf
    key = _key(plan.seed, F.col("epochs") + 1)
    last = F.when(key < F.col("cut_key"), F.col("n_tokens")).when(key == F.col("cut_key"), F.col("cut_tokens"))
    taken = F.concat(F.array_repeat("n_tokens", F.col("epochs").cast("int")), F.array_compact(F.array(last)))
    kept = ["doc_id", *LEVELS, "n_tokens", *(["row"] if carry else [])]
    return planned.select(*kept, F.posexplode(taken).alias("epoch", "taken")).withColumn("epoch", F.col("epoch") + 1)


def mixed_documents(docs: DataFrame, domain: Column, plan: Plan) -> DataFrame:
    """The mixture as rows of ``docs``; the text of a document that is cut ends with the last word taken, else as it was."""
    chosen = mixture(docs, domain, plan, docs.columns)
    cut = F.col("taken") < F.col("n_tokens")
    whole, taken = F.col("row.text"), F.col("taken").cast("int")
    # a blank at the begin counts as a part of its own
    parts = taken + 1 + F.when(whole.rlike("^" + _BLANKS), 1).otherwise(0)
    behind = F.get(F.split(whole, _BLANKS, parts), parts - 1)
    kept = F.regexp_replace(F.left(whole, F.length(whole) - F.length(behind)), _BLANKS + "$", "")
    text = F.when(cut & (F.col("taken") > 0), kept).when(cut, "").otherwise(whole)
    new = {"text": text}
    if "n_chars" in docs.columns:
        n_chars = F.when(cut, F.length(text)).otherwise(F.col("row.n_chars"))
        new["n_chars"] = n_chars.cast(docs.schema["n_chars"].dataType)
    return chosen.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
