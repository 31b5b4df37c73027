"""Mixing sources to target weights: budgets down a tree, then a prefix of seeded epochs per leaf."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardlens.llm.line_rules import word_list
from hazardlens.llm.staging import staged

NONE = "(none)"
EPOCHS = 3
BUCKETS = 4096
_BIG = "decimal(38,0)"


def order_number(seed: int, epoch: Column, id: Column) -> Column:
    """A number below 2^60 from seed, epoch and id: the place of a document in that epoch's order."""
    key = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(id.cast("string"), F.lit("null")))
    return F.conv(F.substr(F.md5(key), F.lit(1), F.lit(15)), 16, 10).cast("bigint")


def share_out(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """``nodes`` (``parent`` columns, ``name``, ``capacity``, ``weight``, ``given``) with ``budget``.

    Each group of siblings shares its parent's ``given`` in proportion to the weights;
    who has less ``capacity`` than its share keeps what it has, and the rest goes to its
    siblings in the same way. Sorted by capacity per weight, a sibling is full exactly
    if its capacity is at most its share of what those before it leave over. Shares are
    rounded down to whole tokens.
    """
    ratio = F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight")).otherwise(0.0)
    group = Window.partitionBy(*parent)
    before = group.orderBy(ratio, name).rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("given") - F.coalesce(F.sum("capacity").over(before), F.lit(0))
    weight = F.sum("weight").over(group) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    step = nodes.withColumns({"_left": left.cast(_BIG), "_weight": weight.cast(_BIG)})
    full = F.col("capacity") * F.col("_weight") <= F.col("weight") * F.col("_left")
    step = step.withColumn("_full", F.coalesce(full, F.lit(False)))
    # what is left only shrinks, so the largest value is that of the first sibling that is not full
    rest = F.max(F.when(~F.col("_full"), F.col("_left"))).over(group)
    weights = F.max(F.when(~F.col("_full"), F.col("_weight"))).over(group)
    step = step.withColumns({"_rest": rest, "_weights": weights})
    budget = F.when(F.col("_full"), F.col("capacity")).otherwise(F.expr("cast(weight as decimal(18,0)) * _rest div _weights"))
    return step.withColumn("budget", budget).drop("_left", "_weight", "_full", "_rest", "_weights")


def leaf_budgets(leaves: DataFrame, levels: list[str], weights: Mapping[str, str], percent: int, epochs: int) -> DataFrame:
    """``levels``, ``tokens`` and ``budget`` of every leaf.

    The whole budget is ``percent`` of all tokens, or what ``epochs`` passes over all
    can give if that is less. It is shared out level by level; a subtree's capacity is
    that of its leaves, so a leaf's shortage goes to its siblings first, and only what a
    whole subtree cannot take goes to the siblings of its ancestor.
    """
    used = F.lit(True)
    for level in levels:
        used = used & (F.expr(weights.get(level, "1")) > 0)
    tree = leaves.withColumn("capacity", F.when(used, F.col("tokens") * epochs).otherwise(0))
    sums = tree.agg(F.sum("tokens").alias("tokens"), F.sum("capacity").alias("capacity")).first()
    whole = min((sums["tokens"] or 0) * percent // 100, sums["capacity"] or 0)
    tree = tree.withColumn("given", F.lit(whole).cast("bigint"))
    for depth, level in enumerate(levels):
        path, parent = levels[: depth + 1], levels[:depth]
        nodes = tree.groupBy(*path).agg(F.sum("capacity").cast("bigint").alias("capacity"), F.max("given").alias("given"))
        nodes = nodes.withColumn("weight", F.expr(weights.get(level, "1")).cast("bigint"))
        shared = share_out(nodes, parent, level).select(*path, F.col("budget").alias("given"))
        tree = tree.drop("given").join(shared, path)
    return tree.select(*levels, "tokens", F.col("given").alias("budget"))


def mix(
    df: DataFrame,
    levels: Mapping[str, str],
    weights: Mapping[str, str],
    percent: int,
    epochs: int = EPOCHS,
    seed: int = 1,
    id: str = "doc_id",
    text: str = "text",
    buckets: int = BUCKETS,
    key: str | None = None,
) -> DataFrame:
    """``doc_id``, the ``levels``, ``n_tokens`` and ``copies`` of every document that is taken.

    ``levels`` names the tree from the root down with a SQL expression for each, ``weights``
    has SQL for the whole numbers of a level, from its own and higher level names (1 where it has
    none; 0 leaves out). Tokens are words. A leaf whose budget is ``k`` times its tokens
    and some takes all its documents ``k`` times, and from the next epoch the longest
    prefix that fits into the rest. Every epoch has an order of its own, from ``seed``.

    The prefix is found without sorting a leaf in one place: tokens are added up per
    leaf and slice of the order, running totals over the slices say which are in, and
    only inside a slice documents are sorted.

    A null level value is a leaf of its own, ``(none)``. Texts without words are never
    taken. Repeated rows count as documents of their own and stand side by side in the
    order; null ids share one place. With ``key``, a string column that tells rows apart, the
    result has that column too, and rows without an id have their place by it. Extra columns
    are not read. An empty table gives an empty result.
    """
    names, keys = list(levels), [key] if key else []
    columns = [F.coalesce(F.expr(e).cast("string"), F.lit(NONE)).alias(n) for n, e in levels.items()]
    tokens = F.size(word_list(F.col(text))).cast("bigint")
    rows = staged(df.select(F.col(id).alias("doc_id"), *keys, *columns, tokens.alias("n_tokens")).where("n_tokens > 0"))
    leaves = staged(rows.groupBy(*names).agg(F.sum("n_tokens").alias("tokens")))
    plan = leaf_budgets(leaves, names, weights, percent, epochs)
    plan = plan.select(
        *names,
        F.expr("cast(budget div tokens as int)").alias("full"),
        F.expr("budget % tokens").alias("rest"),
    )
    epoch = F.explode(F.sequence(F.lit(0), F.lit(epochs)))
    name = F.coalesce(F.col("doc_id").cast("string"), *keys)
    placed = rows.withColumn("full", epoch).withColumn("place", order_number(seed, F.col("full"), name))
    placed = placed.withColumn("slice", F.floor(F.col("place") / F.lit((1 << 60) // buckets)).cast("int"))
    sums = placed.groupBy(*names, "full", "slice").agg(F.sum("n_tokens").alias("sum")).join(plan, [*names, "full"])
    before = Window.partitionBy(*names).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("sum").over(before), F.lit(0)))
    # of each document's places only that in its leaf's unfinished epoch finds a partner
    inside = Window.partitionBy(*names, "full", "slice").orderBy("place", "doc_id", "n_tokens", *keys).rowsBetween(Window.unboundedPreceding, 0)
    cut = placed.join(sums.select(*names, "full", "slice", "rest", "before"), [*names, "full", "slice"])
    taken = (F.col("before") + F.sum("n_tokens").over(inside) <= F.col("rest")).cast("int")
    return cut.withColumn("copies", F.col("full") + taken).where("copies > 0").select("doc_id", *keys, *names, "n_tokens", "copies")


def row_key(df: DataFrame) -> Column:
    """A digest of the whole row, null ids and nulls included; only rows equal in all columns share it."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in df.columns])), 256)


def select_documents(df: DataFrame, taken: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``df`` that ``mix`` took, each as often as it has copies.

    Rows of one ``key`` must be equal (``row_key`` is such a key); the copies of all of
    them are added up. Rows whose key is null are not selected.
    """
    copies = taken.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.sum("copies").cast("int").alias("_copies"))
    named = df.dropDuplicates([key])
    repeated = named.join(copies, F.col(key) == F.col("_key")).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return repeated.select(*df.columns)
