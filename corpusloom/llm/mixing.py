"""Mixing sources to target weights by hierarchical budgeting.

A token budget flows down a tree of domain, language and source. At each node it is shared among the children by
weight; a child gets no more than its capacity (its tokens times the epochs allowed), and what it can't take goes to
its siblings, so that only what a whole subtree can't take reaches the parent's siblings. Sharing is water-filling in
closed form, a window over one node's children, in whole numbers; at most a token a child is lost to rounding.

Each leaf then repeats whole epochs and takes a prefix of one more, in the order of a hash seeded by epoch. The prefix
is found without sorting a leaf: tokens are summed by hash bucket, the bucket in which the budget runs out is the only
one looked into, and the cut is a hash value. Documents are then kept by a comparison, so texts are never shuffled and
a source with most of the rows costs no more than others.

Defined cases: null domains, languages and sources are the child ``(none)``; a null text has no tokens; rows that
repeat an id lie at one point of the order and are taken or left together; a leaf without tokens, or under a weight of
zero, is left out, and its tokens are no capacity of its ancestors; where all weights are zero nothing is taken; an
empty table gives an empty result. Columns of the input keep their values, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import boxed, saved, small, whole, words_of

NONE = "(none)"


@dataclass(frozen=True)
class Mix:
    """Weights by level (others count one), the budget as a share of all tokens, epochs at most, and the seed."""

    domains: dict[str, int] = field(default_factory=lambda: {"core": 3, "tail": 2})
    langs: dict[str, int] = field(default_factory=lambda: {"en": 4, "fr": 2, "de": 2, "es": 2})
    sources: dict[str, int] = field(default_factory=dict)
    percent: int = 80
    epochs: int = 2
    seed: int = 17


def domain_of(source: Column) -> Column:
    """The domain of a source: names that end in a single digit are the core, others the tail."""
    return F.when(source.rlike("^[^0-9]*[0-9]$"), "core").otherwise("tail")


def _weight(name: Column, weights: dict[str, int]) -> Column:
    out = F.lit(1)
    for k, w in weights.items():
        out = F.when(name == k, w).otherwise(out)
    return out.cast("decimal(10,0)")


def _share(children: DataFrame, parent: list[str], name: str, weight: Column) -> DataFrame:
    """Children (parent.., name, cap, budget of the parent) with their own budget."""
    c = children.withColumn("w", weight).withColumn("c", F.when(F.col("w") > 0, F.col("cap")).otherwise(0).cast("decimal(20,0)"))
    fill = F.when(F.col("w") > 0, F.col("c").cast("double") / F.col("w").cast("double")).otherwise(0.0)
    order = Window.partitionBy(*parent).orderBy(fill, name)
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    c = c.withColumn("c_before", F.coalesce(F.sum("c").over(before), F.lit(0)).cast("decimal(24,0)")).withColumn("w_from", F.sum("w").over(after).cast("decimal(12,0)"))
    c = c.withColumn("full", (F.col("c") == 0) | (F.col("c") * F.col("w_from") <= (F.col("budget") - F.col("c_before")) * F.col("w")))
    all_ = Window.partitionBy(*parent)
    c = c.withColumn("c_full", F.sum(F.when(F.col("full"), F.col("c")).otherwise(0)).over(all_).cast("decimal(24,0)")).withColumn("w_open", F.sum(F.when(~F.col("full"), F.col("w")).otherwise(0)).over(all_).cast("decimal(12,0)"))
    own = F.when(F.col("full"), F.col("c").cast("long")).otherwise(F.expr("((budget - c_full) * w) div w_open"))
    return c.withColumn("own", own.cast("long")).drop("w", "c", "c_before", "w_from", "full", "c_full", "w_open")


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """Leaves (domain, lang, source, tokens) with ``own``, the tokens that each is to give."""
    taken = (_weight(F.col("lang"), mix.langs) > 0) & (_weight(F.col("source"), mix.sources) > 0)  # else no ancestor may count on it
    leaves = leaves.withColumn("cap", F.when(taken, F.col("tokens") * mix.epochs).otherwise(0))
    total = leaves.agg(F.expr(f"cast(coalesce(sum(tokens), 0) as decimal(20,0)) * {mix.percent} div 100").cast("decimal(20,0)").alias("budget"))
    top = leaves.groupBy("domain").agg(F.sum("cap").alias("cap")).crossJoin(F.broadcast(total))  # one row of one number
    top = _share(top.withColumn("all", F.lit(1)), ["all"], "domain", _weight(F.col("domain"), mix.domains))
    mid = leaves.groupBy("domain", "lang").agg(F.sum("cap").alias("cap")).join(top.select("domain", F.col("own").cast("decimal(20,0)").alias("budget")), "domain")
    mid = _share(mid, ["domain"], "lang", _weight(F.col("lang"), mix.langs))
    low = leaves.join(mid.select("domain", "lang", F.col("own").cast("decimal(20,0)").alias("budget")), ["domain", "lang"])
    return _share(low, ["domain", "lang"], "source", _weight(F.col("source"), mix.sources)).drop("budget", "cap")


def order_of(epoch: Column, key: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(key.cast("string"), F.lit(""))))


def plan(docs: DataFrame, mix: Mix, text: str, key: str) -> tuple[DataFrame, int]:
    """For each leaf: whole epochs, the bucket and hash at which one more is cut; and the digits of a bucket."""
    leaf = ["domain", "lang", "source"]
    slim = saved(_leafed(docs, text).select(*[f"__leaf.{c}" for c in leaf], docs[key].alias("__id"), F.col("__tokens").alias("tokens")))
    leaves = saved(slim.groupBy(*leaf).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n")))
    most = leaves.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()
    digits = 1
    while 256**digits < most[1]:  # about as many buckets as documents in one
        digits += 1
    cut = saved(budgets(leaves, mix).filter("tokens > 0").select(*leaf, F.expr("own div tokens").alias("whole"), F.expr("own % tokens").alias("rest")))
    hashed = slim.join(small(cut.filter("rest > 0"), most[0], 200), leaf).withColumn("h", order_of(F.col("whole"), F.col("__id"), mix.seed)).withColumn("bucket", F.substring("h", 1, digits))
    sums = hashed.groupBy(*leaf, "bucket", "rest").agg(F.sum("tokens").alias("t")).withColumn("upto", F.sum("t").over(Window.partitionBy(*leaf).orderBy("bucket")))
    edge = sums.filter("upto > rest").groupBy(*leaf).agg(F.min(F.struct("bucket", (F.col("upto") - F.col("t")).alias("before"))).alias("e")).select(*leaf, F.col("e.bucket").alias("edge"), F.col("e.before").alias("before"))
    edge = saved(edge)
    inside = hashed.join(small(edge, most[0], 200), leaf).filter("bucket = edge").withColumn("upto", F.col("before") + F.sum("tokens").over(Window.partitionBy(*leaf).orderBy("h")))
    last = inside.filter("upto <= rest").groupBy(*leaf).agg(F.max("h").alias("last"))
    return saved(cut.join(edge.drop("before"), leaf, "left").join(last, leaf, "left").drop("rest")), digits


def _leafed(docs: DataFrame, text: str) -> DataFrame:
    source = F.coalesce(docs["source"].cast("string"), F.lit(NONE))
    leaf = F.struct(F.when(docs["source"].isNull(), NONE).otherwise(domain_of(source)).alias("domain"), F.coalesce(docs["lang"].cast("string"), F.lit(NONE)).alias("lang"), source.alias("source"))
    return docs.withColumns({"__leaf": leaf, "__tokens": F.size(words_of(whole(docs[text]))).cast("long")})


def select(docs: DataFrame, mix: Mix | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs``, each row as often as the mix takes it, with ``__leaf``, ``__tokens`` and ``__epoch``."""
    mix = mix or Mix()
    cut, digits = plan(docs, mix, text, key)
    side = small(cut.select(F.struct("domain", "lang", "source").alias("__l"), "whole", "edge", "last"), cut.count(), 300)
    rows = _leafed(docs, text)
    rows = rows.select(boxed(docs).alias("__doc"), docs[key].alias("__id"), "__leaf", "__tokens").join(side, F.col("__leaf") == F.col("__l"))
    h = order_of(F.col("whole"), F.col("__id"), mix.seed)
    bucket = F.substring(h, 1, digits)
    more = F.coalesce((bucket < F.col("edge")) | ((bucket == F.col("edge")) & (h <= F.col("last"))), F.lit(False))
    times = (F.col("whole") + more.cast("int")).cast("int")
    rows = rows.withColumn("__times", times).filter("__times > 0")
    return rows.withColumn("__epoch", F.explode(F.sequence(F.lit(0), F.col("__times") - 1))).select("__doc.*", "__leaf", "__tokens", "__epoch")
