"""Mixing sources to target weights: hierarchical budgeting over a domain - language - source tree.

A token budget enters at the root and is split among the children of each node by weight. No child
gets more than its subtree can deliver (its tokens times the epochs allowed); what a child cannot
take goes to its siblings by weight, and only what a whole subtree cannot take goes to the
siblings of its root, because a subtree's capacity is known before the split above it is made. Each
leaf then takes its budget as whole epochs plus a prefix of one more: documents in the order of a
seeded hash, up to the one that reaches the budget.

The tree is a table of one row per leaf. Documents are never sorted as a whole: a leaf's hash order is
cut into slices of about `ROWS_PER_SLICE` documents, sums per slice find the slice in which the
budget is reached, and only that slice is sorted. A leaf may hold any share of all rows. All of it is DataFrame code.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window, functions as F

from tarnlake.llm.common import WORD, staged

LEVELS = ("domain", "lang", "source")
ROWS_PER_SLICE = 1 << 12
HASH_BITS = 60
_WIDE = "decimal(38,0)"


def n_tokens(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def position(seed: int, epoch: Column, doc_id: Column) -> Column:
    """Place of a document in a seeded epoch: a 60-bit number."""
    key = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def _leaves(entries: DataFrame, weights: Mapping[tuple, int], max_epochs: int) -> DataFrame:
    """One row per leaf: tokens, documents, weights along the path and the capacity."""
    leaves = entries.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    if any(w < 0 for w in weights.values()):
        raise ValueError("weights must not be negative")
    spark = entries.sparkSession
    for depth, level in enumerate(LEVELS, 1):
        rows = [(*path, int(w)) for path, w in weights.items() if len(path) == depth]
        schema = ", ".join(f"{name} string" for name in LEVELS[:depth]) + f", w_{level} long"
        given = spark.createDataFrame(rows, schema)
        leaves = leaves.join(given, list(LEVELS[:depth]), "left").fillna(1, [f"w_{level}"])
    usable = F.least(*(F.col(f"w_{level}") for level in LEVELS)) > 0
    return leaves.withColumn("capacity", F.when(usable, F.col("tokens") * max_epochs).otherwise(0).cast(_WIDE))


def allocate(leaves: DataFrame, budget: Column) -> DataFrame:
    """Add `budget` (tokens) to each leaf. `budget` is an expression over `tokens`, the sum of all tokens."""
    whole = leaves.agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens")).select(
        F.least("capacity", budget.cast(_WIDE)).alias("budget"))
    path, alloc = ["root"], None
    leaves = leaves.withColumn("root", F.lit(1))
    for level in LEVELS:
        nodes = leaves.groupBy(*path, level).agg(
            F.sum("capacity").cast(_WIDE).alias("capacity"),
            F.max(F.when(F.col("capacity") > 0, F.col(f"w_{level}")).otherwise(0)).cast(_WIDE).alias("weight"))
        funded = nodes.withColumn("budget", whole.scalar()) if alloc is None else nodes.join(alloc, path)
        alloc = _split(funded, path, level)
        path.append(level)
    return leaves.join(alloc, [*LEVELS]).drop("root")


def _split(nodes: DataFrame, parent: Sequence[str], level: str) -> DataFrame:
    """Split each parent's budget among its children by weight, each child up to its capacity.

    Children are taken in the order of capacity per weight. A child is full when the level that fills it
    does not exceed the budget; the others share what the full ones leave.
    """
    order = Window.partitionBy(*parent).orderBy(F.col("capacity").cast("double") / F.col("weight").cast("double"), level)
    up_to = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    family = Window.partitionBy(*parent)
    left = F.col("budget") - F.sum("capacity").over(up_to)
    later = F.sum("weight").over(family) - F.sum("weight").over(up_to)
    live = nodes.filter("weight > 0").withColumn(
        "full", F.col("weight") * left.cast("decimal(19,0)") >= F.col("capacity").cast("decimal(19,0)") * later.cast("decimal(19,0)"))
    taken = F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(family), F.lit(0))
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(family)
    shares = live.withColumn("rest", (F.col("budget") - taken).cast("decimal(19,0)")).withColumn("open", open_weight)
    share = F.expr("CASE WHEN full THEN capacity ELSE (rest * cast(weight AS decimal(18,0))) div cast(open AS decimal(38,0)) END")
    return shares.select(*parent, level, share.cast(_WIDE).alias("budget"))


def plan(entries: DataFrame, weights: Mapping[tuple, int], budget: Column, seed: int, max_epochs: int,
         rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """One row per leaf that gives documents: `full` epochs, and the place `cut` where the prefix of the next one ends.

    `entries` is a table of (levels, doc_id, text_key, n_tokens). The cut is (hash, doc_id, text_key) of the
    first document left out.
    """
    leaves = staged(allocate(_leaves(entries, weights, max_epochs), budget), "mixing-leaves")
    leaves = leaves.filter("budget > 0 AND tokens > 0").select(
        *LEVELS, F.expr("cast(budget div tokens AS long)").alias("full"),
        F.expr("cast(budget % tokens AS long)").alias("rest"),
        F.expr(f"{1 << HASH_BITS}L div greatest(1L, cast(ceil(docs / {rows_per_slice}) AS long)) + 1").alias("width"))
    placed = entries.join(leaves.filter("rest > 0"), list(LEVELS)).withColumn(
        "hash", position(seed, F.col("full") + 1, F.col("doc_id"))).withColumn("slice", F.expr("hash div width"))
    sums = placed.groupBy(*LEVELS, "slice").agg(F.sum("n_tokens").alias("sum"), F.first("rest").alias("rest"))
    so_far = Window.partitionBy(*LEVELS).orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = sums.withColumn("end", F.sum("sum").over(so_far)).filter("end >= rest AND end - sum < rest").select(
        *LEVELS, "slice", (F.col("end") - F.col("sum")).alias("before"))
    inside = placed.join(reached, [*LEVELS, "slice"])
    earlier = Window.partitionBy(*LEVELS, "slice").orderBy("hash", "doc_id", "text_key", "n_tokens").rowsBetween(
        Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0))
    cuts = inside.withColumn("start", start).groupBy(*LEVELS).agg(
        F.min(F.when(F.col("start") >= F.col("rest"), F.struct("hash", "doc_id", "text_key"))).alias("at"),
        F.max((F.col("slice") + 1) * F.col("width")).alias("bound"))
    return leaves.join(cuts, list(LEVELS), "left").select(*LEVELS, "full", "rest", "at", "bound")


def mix(docs: DataFrame, domain: Column, weights: Mapping[tuple, int], budget_tokens: int | None = None,
        budget_share: str | float | None = None, seed: int = 0, max_epochs: int = 1,
        rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Documents chosen for the mix: all columns of `docs` plus `domain`, `n_tokens` and `copies` (epochs a document is in).

    `weights` maps paths (domain,), (domain, lang), (domain, lang, source) to whole numbers; a path not
    given weighs 1, weight 0 shuts a subtree out. The budget is a number of tokens or a share of all tokens; where
    all capacity is less, everything is taken. A leaf's last document may exceed its budget; whole documents are
    never cut. Null levels count as the empty name. Null and empty texts have no tokens: they come with whole
    epochs, or with a prefix that goes on behind them. Repeated rows take their tokens each, and are all in or all out where
    the cut falls on them. Columns of the input named like an added one are replaced. An empty table gives no rows.
    """
    if (budget_tokens is None) == (budget_share is None):
        raise ValueError("give the budget as tokens or as a share")
    levels = [domain.alias("domain"), *(F.col(c).cast("string").alias(c) for c in LEVELS[1:])]
    named = docs.select(
        *(F.coalesce(level, F.lit("")).alias(name) for level, name in zip(levels, LEVELS)), "doc_id",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), n_tokens(F.col("text")).alias("n_tokens"))
    entries = staged(named, "mixing-entries")
    if budget_share is None:
        budget = F.lit(budget_tokens)
    else:
        share = Fraction(str(budget_share))
        budget = F.expr(f"cast(tokens AS decimal(28,0)) * {share.numerator}L div {share.denominator}L")
    leaf = staged(plan(entries, weights, budget, seed, max_epochs, rows_per_slice), "mixing-plan").select(
        *(F.col(c).alias(f"__{c}") for c in (*LEVELS, "full", "rest", "at", "bound")))
    own = [c for c in docs.columns if c not in ("domain", "n_tokens", "copies")]
    keyed = docs.select(
        *(F.col(f"`{c}`") for c in own), domain.alias("domain"),
        F.coalesce(domain, F.lit("")).alias("__domain"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("__lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("__source"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("__text_key"))
    joined = keyed.join(leaf, [f"__{c}" for c in LEVELS])
    place = F.struct(position(seed, F.col("__full") + 1, F.col("doc_id")).alias("hash"), F.col("doc_id"), F.col("__text_key").alias("text_key"))
    chosen = (F.col("__rest") > 0) & F.when(F.col("__at").isNull(), place["hash"] < F.col("__bound")).otherwise(place < F.col("__at"))
    copies = F.col("__full") + F.when(chosen, 1).otherwise(0)
    return joined.withColumn("__copies", copies).filter("__copies > 0").select(
        *(F.col(f"`{c}`") for c in own), "domain", n_tokens(F.col("text")).alias("n_tokens"),
        F.col("__copies").cast("long").alias("copies"))
