"""Mixing sources to target weights (DataFrame functions only).

Documents hang in a tree, for example domain, language, source. Each node's
token budget is divided among its children by weight. A child gets no more
than its leaves can give in ``max_epochs``; what it cannot use goes to its
siblings, and to the siblings of an ancestor only where all of them are full.
A leaf spends its budget on whole epochs and then on a prefix of one more
epoch, in an order seeded by leaf epoch and document.

Sizes travel as sums: the prefix of a leaf is found from token sums per slice
of the order, and only the one slice in which the budget ends is sorted. The
tables per leaf are broadcast while their counted rows are few.

Defined results: a null text has no tokens; null levels form the level ''; rows
with one id share their place in the order and are taken together; an empty
table gives an empty result; other columns of the input pass through
``mixed_rows``. Rounding down loses at most one token per child of a node.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from neardup.llm.common import SPACE_CLASS, fresh_name, text_or_empty
from neardup.session import broadcast_if_small, materialize

#: Hexadecimal digits of the order that name a slice of a leaf.
SLICE_DIGITS = 3


@dataclass(frozen=True)
class Mix:
    """What to mix: ``levels`` from the root to the leaves as columns or SQL.

    ``weights`` has a whole number for a path such as ``("web", "en")``, which
    counts among its siblings; others weigh ``default_weight``. The budget is
    ``budget_percent`` of all tokens. ``floor_epochs`` whole epochs of every
    leaf are set apart first, so that only the rest of the budget is mixed; with
    ``floor_counts`` they are the least that a leaf gets of the whole budget, so
    that a leaf beyond its target gets no more and the others come nearer to theirs.
    """

    levels: tuple[str, ...]
    weights: Mapping[tuple[str, ...], int] = field(default_factory=dict)
    default_weight: int = 1
    budget_percent: int = 100
    max_epochs: int = 1
    floor_epochs: int = 0
    seed: int = 0
    floor_counts: bool = False

    def __post_init__(self):
        if not self.levels or not 0 <= self.floor_epochs <= self.max_epochs:
            raise ValueError("levels must be given and floor_epochs be within max_epochs")
        if self.budget_percent < 0 or self.default_weight < 0 or min(self.weights.values(), default=0) < 0:
            raise ValueError("budget and weights must not be negative")


def count_tokens(text: str | Column) -> Column:
    """Words of a text, as the measure of its length."""
    return F.regexp_count(text_or_empty(text), F.lit(f"[^{SPACE_CLASS}]+")).cast("long")


def _level_columns(mix: Mix) -> list[Column]:
    return [F.coalesce(F.expr(x).cast("string"), F.lit("")) for x in mix.levels]


def _weight(mix: Mix, names: list[str]) -> Column:
    given = {k: w for k, w in mix.weights.items() if len(k) == len(names)}
    if not given:
        return F.lit(mix.default_weight).cast("decimal(38,0)")
    path = F.array(*[F.col(n) for n in names])
    found = [
        F.when(path == F.array(*[F.lit(p) for p in k]), F.lit(w)) for k, w in sorted(given.items())
    ]
    return F.coalesce(*found, F.lit(mix.default_weight)).cast("decimal(38,0)")


def _divide(nodes: DataFrame, parents: list[str], own: str) -> DataFrame:
    """``budget`` of each node from its parent's ``_b``, capacity ``_c`` and weight ``_w``.

    The budget rises like water over capacities: sorted by the level at which
    they are full, the nodes up to some level are full and the others share
    the rest by weight.
    """
    siblings = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    fill = F.when(F.col("_w") > 0, F.col("_c").cast("double") / F.col("_w").cast("double"))
    order = siblings.orderBy(fill.asc_nulls_last(), own)
    before = F.coalesce(
        F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    rest = F.sum("_w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    full = (F.col("_w") > 0) & (
        F.col("_c") * rest + F.col("_w") * before <= F.col("_b") * F.col("_w")
    )
    marked = nodes.withColumn("_full", full)
    spent = F.coalesce(F.sum(F.when(F.col("_full"), F.col("_c"))).over(siblings), F.lit(0))
    open_w = F.sum(F.when(~F.col("_full"), F.col("_w"))).over(siblings)
    marked = marked.withColumn("_spent", spent).withColumn("_open", open_w)
    share = F.expr("case when _w > 0 then ((_b - _spent) * _w) div _open else 0 end")
    return marked.withColumn(
        "_b", F.when(F.col("_full"), F.col("_c")).otherwise(share).cast("decimal(38,0)")
    ).drop("_full", "_spent", "_open")


def _divide_between(nodes: DataFrame, parents: list[str], own: str) -> DataFrame:
    """As ``_divide``, but each node gets ``_l`` at least and ``_c`` at most.

    The water rises to one level among siblings: a node is full or still at its
    least where all siblings together, at the level of that bound, need no more
    or no less than the budget.
    """
    siblings = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    wide = "decimal(38,0)"
    nodes = nodes.withColumn("_all", F.sum("_l").over(siblings))
    bound = F.explode(
        F.array(
            F.struct(F.lit(0).alias("top"), F.col("_l").alias("at")),
            F.struct(F.lit(1).alias("top"), F.col("_c").alias("at")),
        )
    )
    bounds = nodes.where("_w > 0").select("*", bound.alias("_e"))
    level = F.col("_e.at").cast("double") / F.col("_w").cast("double")
    # Up to a level, with the bounds of equal level: what is fixed and what rises by weight.
    below = siblings.orderBy(level).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    top = F.col("_e.top") == 1
    fixed = F.sum(F.when(top, F.col("_e.at")).otherwise(-F.col("_e.at"))).over(below)
    rising = F.sum(F.when(top, -F.col("_w")).otherwise(F.col("_w"))).over(below)
    needs = (F.col("_all") + fixed) * F.col("_w") + F.col("_e.at") * rising
    found = (
        bounds.withColumn("_needs", needs.cast(wide))
        .groupBy(*parents, own)
        .agg(
            F.max(top & (F.col("_needs") <= F.col("_b") * F.col("_w"))).alias("_full"),
            F.max(~top & (F.col("_needs") >= F.col("_b") * F.col("_w"))).alias("_least"),
        )
    )
    marked = nodes.join(found, [*parents, own], "left")
    full = F.coalesce("_full", F.lit(False))
    least = ~full & F.coalesce("_least", F.lit(True))  # no weight: the least
    marked = marked.withColumn(
        "_kept", F.when(full, F.col("_c")).when(least, F.col("_l")).cast(wide)
    )
    marked = marked.withColumn("_spent", F.coalesce(F.sum("_kept").over(siblings), F.lit(0)))
    marked = marked.withColumn(
        "_open", F.sum(F.when(F.col("_kept").isNull(), F.col("_w"))).over(siblings)
    )
    share = F.expr("case when _kept is null then ((_b - _spent) * _w) div _open end")
    # Bounds that tie but for rounding of a level may be missed by a token.
    share = F.greatest("_l", F.least("_c", share.cast(wide)))
    return marked.withColumn("_b", F.coalesce("_kept", share).cast(wide)).drop(
        "_all", "_full", "_least", "_kept", "_spent", "_open"
    )


def leaf_budgets(leaves: DataFrame, names: list[str], mix: Mix) -> DataFrame:
    """Adds ``_budget`` to the leaves, whose ``_tokens`` are known. One row per leaf."""
    apart = 0 if mix.floor_counts else mix.floor_epochs
    spare = mix.max_epochs - apart
    total = F.sum("_tokens").cast("decimal(38,0)")
    # One row: all tokens. The budget of the root follows from it.
    tokens = int(leaves.agg(F.coalesce(total, F.lit(0))).first()[0])
    budget = max(0, tokens * mix.budget_percent // 100 - tokens * apart)
    nodes = None
    for depth in range(1, len(names) + 1):
        bounds = [(total * spare).cast("decimal(38,0)").alias("_c")]
        if mix.floor_counts:
            bounds.append((total * mix.floor_epochs).cast("decimal(38,0)").alias("_l"))
        here = leaves.groupBy(*names[:depth]).agg(*bounds)
        here = here.withColumn("_w", _weight(mix, names[:depth]))
        if nodes is None:
            here = here.withColumn("_b", F.lit(budget).cast("decimal(38,0)"))
        else:
            here = here.join(nodes.select(*names[: depth - 1], "_b"), names[: depth - 1])
        divide = _divide_between if mix.floor_counts else _divide
        nodes = divide(here, names[: depth - 1], names[depth - 1])
    out = leaves.join(nodes.select(*names, "_b"), names)
    kept = F.col("_b").cast("long") + F.col("_tokens") * apart
    return out.withColumn("_budget", kept).drop("_b")


def _place(mix: Mix, id_col: str, epoch: str) -> Column:
    """Place of a document in the order of an epoch."""
    return F.md5(
        F.concat_ws(
            ":", F.lit(str(mix.seed)), F.col(epoch).cast("string"),
            F.coalesce(F.col(id_col).cast("string"), F.lit("")),
        )
    )


def leaf_cuts(docs: DataFrame, names: list[str], mix: Mix) -> DataFrame:
    """Per leaf ``_budget``, whole epochs ``_epochs`` and the last place ``_cut`` of the prefix.

    ``docs`` has the levels, ``_id`` and ``_n`` tokens; it is read three times.
    """
    leaves = materialize(
        docs.groupBy(*names).agg(F.sum("_n").alias("_tokens")), "mix-leaves"
    )
    budgets = leaf_budgets(leaves, names, mix).withColumn(
        "_epochs", F.expr("case when _tokens > 0 then _budget div _tokens else 0 end")
    )
    budgets = materialize(
        budgets.withColumn("_rest", F.col("_budget") - F.col("_epochs") * F.col("_tokens")),
        "mix-budgets",
    )
    small = budgets.select(*names, "_epochs", "_rest").where(F.col("_epochs") < mix.max_epochs)
    placed = (
        docs.join(broadcast_if_small(small, 256), names)
        .withColumn("_h", _place(mix, "_id", "_epochs"))
        .withColumn("_slice", F.substring("_h", 1, SLICE_DIGITS))
    )
    by_leaf = Window.partitionBy(*names).orderBy("_slice")
    sums = placed.groupBy(*names, "_slice").agg(
        F.sum("_n").alias("_s"), F.first("_rest").alias("_rest"), F.max("_h").alias("_h")
    )
    sums = materialize(
        sums.withColumn("_before", F.sum("_s").over(by_leaf) - F.col("_s")), "mix-slices"
    )
    fits = F.col("_before") + F.col("_s") <= F.col("_rest")
    whole = sums.where(fits).select(*names, "_h")
    # The slice in which the budget ends is the first that does not fit.
    ends = sums.where(~fits).groupBy(*names).agg(F.min(F.struct("_slice", "_before")).alias("_e"))
    ends = materialize(
        ends.select(*names, F.col("_e._slice").alias("_slice"), F.col("_e._before").alias("_before")),
        "mix-ends",
    )
    inside = placed.join(broadcast_if_small(ends, 256), [*names, "_slice"])
    in_order = Window.partitionBy(*names).orderBy("_h")
    part = (
        inside.withColumn("_sum", F.col("_before") + F.sum("_n").over(in_order))
        .where(F.col("_sum") <= F.col("_rest"))
        .select(*names, "_h")
    )
    cut = whole.unionByName(part).groupBy(*names).agg(F.max("_h").alias("_cut"))
    return materialize(
        budgets.select(*names, "_budget", "_epochs").join(cut, names, "left"), "mix-cuts"
    )


def with_copies(
    docs: DataFrame,
    mix: Mix,
    id_col: str = "doc_id",
    text_col: str = "text",
    copies_col: str = "copies",
    tokens_col: str | None = None,
) -> DataFrame:
    """Adds how often each row is taken (0: not at all); no row moves for it."""
    names = []
    for i in range(len(mix.levels)):
        names.append(fresh_name(docs, f"_level{i}"))
    levels = [c.alias(n) for c, n in zip(_level_columns(mix), names)]
    narrow = materialize(
        docs.select(
            *levels, F.col(id_col).alias("_id"), count_tokens(text_col).alias("_n")
        ),
        "mix-rows",
    )
    cuts = leaf_cuts(narrow, names, mix)
    own = {c: fresh_name(docs, c) for c in ("_budget", "_epochs", "_cut")}
    side = broadcast_if_small(cuts.withColumnsRenamed(own), 256)
    joined = docs.select("*", *levels).join(side, names)
    epochs = F.col(own["_epochs"])
    in_prefix = (epochs < mix.max_epochs) & (
        _place(mix, id_col, own["_epochs"]) <= F.col(own["_cut"])
    )
    copies = epochs + F.when(F.coalesce(in_prefix, F.lit(False)), 1).otherwise(0)
    joined = joined.withColumn(copies_col, copies.cast("long"))
    if tokens_col is not None:
        joined = joined.withColumn(tokens_col, count_tokens(text_col))
    return joined.drop(*names, *own.values())


def shares(
    docs: DataFrame, mix: Mix, depth: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per node of ``depth`` levels its tokens and its shares by weight, of the input and reached.

    Columns: ``path``, ``tokens``, ``taken`` tokens, ``target`` (by the weights of the
    nodes with documents), ``given`` (of the input) and ``reached`` (of what is taken).
    """
    depth = len(mix.levels) if depth is None else depth
    taken = with_copies(docs, mix, id_col, text_col, "_copies", "_n")
    names = [f"_level{i}" for i in range(depth)]
    levels = [c.alias(n) for c, n in zip(_level_columns(mix), names)]
    nodes = taken.select(*levels, "_n", "_copies").groupBy(*names)
    nodes = nodes.agg(
        F.sum("_n").alias("tokens"), F.sum(F.col("_n") * F.col("_copies")).alias("taken")
    )
    nodes = materialize(nodes, "mix-shares")
    target, parts = F.lit(1.0), nodes
    for d in range(1, depth + 1):
        here = nodes.select(*names[:d]).distinct().withColumn("_w", _weight(mix, names[:d]).cast("double"))
        among = Window.partitionBy(*names[: d - 1]) if d > 1 else Window.partitionBy(F.lit(0))
        here = here.withColumn(f"_t{d}", F.col("_w") / F.nullif(F.sum("_w").over(among), F.lit(0.0)))
        parts = parts.join(here.drop("_w"), names[:d])
        target = target * F.coalesce(F.col(f"_t{d}"), F.lit(0.0))
    every = Window.partitionBy(F.lit(0))
    of_all = lambda c: F.coalesce(
        F.col(c) / F.nullif(F.sum(c).over(every), F.lit(0).cast("long")), F.lit(0.0)
    )
    return parts.select(
        F.array(*names).alias("path"), "tokens", "taken", target.alias("target"),
        of_all("tokens").alias("given"), of_all("taken").alias("reached"),
    )


def mixed_rows(docs: DataFrame, mix: Mix, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows as often as they are taken, with the columns of the input."""
    copies = fresh_name(docs, "_copies")
    taken = with_copies(docs, mix, id_col, text_col, copies).where(F.col(copies) > 0)
    again = fresh_name(taken, "_again")
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))
    return taken.withColumn(again, each).drop(copies, again)
