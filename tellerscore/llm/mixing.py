"""Mixing sources to target weights by hierarchical budgets.

A tree of domains, languages and sources carries whole-number weights. A token budget flows down: the
children of a node share it by weight, none gets more than its documents give in ``max_epochs`` passes,
and what one cannot use goes to its siblings in proportion. A node counts as full only when all below it
is, so a shortage reaches the siblings of an ancestor last. Each leaf then takes whole passes and a
prefix, by tokens, of one more pass in an order that depends on the seed and the pass.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tellerscore.llm.common import SPACE_CLASS, carried, fresh_names
from tellerscore.session import materialize

LEVELS = ("domain", "lang", "source")
#: Documents of a leaf that are put in order together.
ORDERED_ROWS = 1000
_OUT = ["epoch", "n_tokens"]


def word_count(text: Column) -> Column:
    words = SPACE_CLASS.replace("[", "[^") + "+"
    return F.coalesce(F.regexp_count(text, F.lit(words)), F.lit(0)).cast("long")


def _weight(level: str, weights: Mapping[str, int]) -> Column:
    """The weight of a node's name, 1 where none is given."""
    column = F.lit(1)
    for name, weight in weights.items():
        column = F.when(F.col(level) == name, F.lit(int(weight))).otherwise(column)
    return column.cast("long")


def _share(nodes: DataFrame, parent: list[str], level: str) -> DataFrame:
    """Give each node its part of ``budget``, its parent's: by ``weight``, up to ``capacity``.

    Children are looked at in the order of capacity per weight. Those that the remaining budget fills, at
    the remaining weights, get their capacity; the others share what is left. Whole numbers throughout.
    """
    within = Window.partitionBy(*(parent or [F.lit(0)])).orderBy(F.col("capacity") / F.col("weight"), level)
    earlier = within.rowsBetween(Window.unboundedPreceding, -1)
    later = within.rowsBetween(0, Window.unboundedFollowing)
    filled_before = F.coalesce(F.sum("capacity").over(earlier), F.lit(0))
    fits = F.col("capacity") * F.sum("weight").over(later) <= F.col("weight") * (F.col("budget") - filled_before)
    nodes = nodes.withColumn("_fits", F.when(fits, 1).otherwise(0))
    nodes = nodes.withColumn("_full", F.min("_fits").over(within.rowsBetween(Window.unboundedPreceding, 0)) == 1)
    siblings = Window.partitionBy(*(parent or [F.lit(0)]))
    left = F.col("budget") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("capacity"))).over(siblings), F.lit(0))
    open_weight = F.sum(F.when(~F.col("_full"), F.col("weight"))).over(siblings)
    part = F.when(F.col("_full"), F.col("capacity")).otherwise(
        F.call_function("div", left * F.col("weight"), open_weight)
    )
    return nodes.withColumn("budget", part).drop("_fits", "_full")


def budgets(leaves: DataFrame, budget: int, weights: Mapping[str, Mapping[str, int]], max_epochs: int) -> DataFrame:
    """The budget of each leaf; ``leaves`` has the three level columns and ``tokens``."""
    nodes = leaves.withColumn("capacity", F.col("tokens") * max_epochs)
    above: DataFrame | None = None
    for depth, level in enumerate(LEVELS):
        keys, parent = list(LEVELS[: depth + 1]), list(LEVELS[:depth])
        own = nodes.groupBy(*keys).agg(F.sum("capacity").alias("capacity"))
        own = own.withColumn("weight", _weight(level, weights.get(level, {})))
        own = own.withColumn("budget", F.lit(int(budget)).cast("long")) if above is None else own.join(above, parent)
        above = _share(own, parent, level).select(*keys, "budget")
    return leaves.join(above, list(LEVELS))


def _order(seed: int, epoch: Column, ident: Column) -> Column:
    return F.md5(
        F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(ident.cast("string"), F.lit(""))).cast("binary")
    )


def mix(
    docs: DataFrame,
    domain: Column,
    weights: Mapping[str, Mapping[str, int]],
    share: tuple[int, int] = (1, 2),
    max_epochs: int = 2,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Draw documents until the tree's budgets are used.

    ``domain`` names a document's domain; ``weights`` maps a level (domain, lang, source) to names and
    positive whole numbers, and a name without one weighs 1. The budget is ``share`` (a fraction of whole
    numbers) of all tokens, here words between the six white-space characters.

    Returns one row for each time a document is drawn: all input columns, ``domain``, ``n_tokens`` and
    ``epoch`` (from 0). Within a pass, rows of one id are drawn together; a pass ends before the first id
    that does not fit, so leaves fall short of their budget by less than one id's tokens. A null language,
    source or domain counts as the empty name; the columns themselves stay as they are. A null id counts
    as empty text in the order. Null text has no tokens; leaves without tokens give nothing. No rows give
    no rows. Input columns named like an output are replaced.

    A leaf may hold any share of the rows: its order is cut into ranges of a hash, of which each is sorted
    by itself, and only the last key drawn comes back to the documents, whose texts are not shuffled as
    long as the list of leaves is small enough to be sent to them.
    """
    wanted = fresh_names(docs, [*_OUT, "domain"])
    level = {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}
    tagged = docs.withColumn("domain", F.coalesce(domain.cast("string"), F.lit(""))).select(
        F.col(id_col).alias("id"),
        "domain",
        *[F.coalesce(level[name].cast("string"), F.lit("")).alias(name) for name in LEVELS[1:]],
        word_count(F.col(text_col)).alias("tokens"),
    )
    rows = materialize(tagged, "mix-rows")
    leaves = materialize(rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n")), "leaves")
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    budget = total * share[0] // share[1]
    plan = materialize(
        budgets(leaves, budget, weights, max_epochs)
        .where("tokens > 0")
        .select(
            *LEVELS,
            "n",
            F.expr("budget div tokens").alias("passes"),
            F.expr("budget % tokens").alias("rest"),
        ),
        "leaf-plan",
    )
    key = _order(seed, F.col("passes"), F.col("id"))
    dealt = (
        rows.join(plan.where("rest > 0"), list(LEVELS))
        .withColumn("key", key)
        .withColumn(
            "range",
            F.shiftright(
                F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * F.ceil(F.col("n") / ORDERED_ROWS), 32
            ),
        )
        .select(*LEVELS, "range", "rest", "key", "tokens")
    )
    sizes = dealt.groupBy(*LEVELS, "range").agg(F.sum("tokens").alias("in_range"))
    ahead = Window.partitionBy(*LEVELS).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("ahead", F.coalesce(F.sum("in_range").over(ahead), F.lit(0))).drop("in_range")
    in_order = Window.partitionBy(*LEVELS, "range").orderBy("key")  # rows of one key count together
    cuts = (
        dealt.join(starts, [*LEVELS, "range"])
        .withColumn("drawn", F.col("ahead") + F.sum("tokens").over(in_order))
        .where("drawn <= rest")
        .groupBy(*LEVELS)
        .agg(F.max("key").alias("cut"))
    )
    plan = materialize(
        plan.join(cuts, list(LEVELS), "left").select(
            *[F.col(name).alias(f"_{name}") for name in LEVELS], "passes", "cut"
        ),
        "leaf-cuts",
    )
    names = {name: F.coalesce(level[name].cast("string"), F.lit("")).alias(f"_{name}_") for name in LEVELS}
    out = docs.select(
        carried(docs, *[c for c in docs.columns if c not in wanted.columns]),
        F.col(id_col).alias("_id"),
        word_count(F.col(text_col)).alias("n_tokens"),
        *names.values(),
    )
    joined = out.join(plan, [F.col(f"_{name}_") == F.col(f"_{name}") for name in LEVELS])
    whole = F.when(F.col("passes") > 0, F.sequence(F.lit(0).cast("long"), F.col("passes") - 1)).otherwise(
        F.array().cast("array<bigint>")
    )
    part = F.when(
        _order(seed, F.col("passes"), F.col("_id")) <= F.col("cut"), F.array(F.col("passes"))
    ).otherwise(F.array().cast("array<bigint>"))
    return joined.select(
        "_in.*",
        F.col("_domain_").alias("domain"),
        "n_tokens",
        F.explode(F.concat(whole, part)).alias("epoch"),
    )
