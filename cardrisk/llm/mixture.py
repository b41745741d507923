"""Mixing sources to target weights over a domain-language-source tree.

Budgets. The token budget flows down the tree: at each node it is split among
the children by their weights; a child cannot take more than its subtree holds
(tokens times ``max_epochs``), and what it leaves is shared by its siblings by
weight. Subtree capacities are known at every level, so a shortage is made up
by siblings first and reaches the ancestors' siblings only when a whole subtree
is short. With children ordered by capacity per weight, those filled to
capacity come first, so each level is one running sum over a node's children.

Selection. A leaf whose budget is k times its tokens plus a rest gives k full
epochs and a prefix of the next: documents in the order of a seeded digest of
epoch and id, whole, as long as their running token count stays within the
rest. The running count is taken over digest-prefix buckets first (256 sums
per leaf, then 256 more inside the bucket where the prefix ends) and row by row
only in that one bucket of 65,536, so a source with a third of all rows is
spread over many tasks.

Defined results: a null path label is a label of its own, the empty string; a
null or empty text has no tokens; rows with the same id share one place in an
epoch and are taken together (null ids too); ties go by id; repeated rows are
counted and selected as rows of their own; labels
without a given weight have weight 1 times nothing else (equal shares); an
empty table, or a budget of zero, selects only documents without tokens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.storage import materialize

DIGITS, LEVELS = 2, 2   # 256 buckets by two hexadecimal digits, and 256 again inside the one that matters
WORDS = r"[^\x20\x09-\x0D]+"

PATH = ("__domain", "__language", "__source")


def weight_of(level: int, weights: dict[tuple, float]) -> Column:
    """Weight of a node at ``level`` (0 domain, 1 language, 2 source): the entry of
    its whole path, else of its own label as ``(label,)`` at that level, else 1."""
    w = F.lit(1.0)
    for path, value in sorted(weights.items(), key=lambda x: (len(x[0]), x[0])):
        if len(path) == level + 1 and path[0] != "*":
            hit = F.lit(True)
            for name, label in zip(PATH, path):
                hit = hit & (F.col(name) == label)
            w = F.when(hit, F.lit(float(value))).otherwise(w)
        elif path[0] == "*" and len(path) == level + 1:
            w = F.when(F.col(PATH[level]) == path[-1], F.lit(float(value))).otherwise(w)
    return w


def split_level(nodes: DataFrame, parent_keys: list[str], order_keys: list[str]) -> DataFrame:
    """Add ``share`` to nodes with ``budget`` (the parent's), ``cap`` and ``w``."""
    ratio = Window.partitionBy(*parent_keys).orderBy(F.col("cap") / F.col("w"), *order_keys)
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*parent_keys)
    n = (nodes.withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
              .withColumn("w_before", F.coalesce(F.sum("w").over(before), F.lit(0.0)))
              .withColumn("w_all", F.sum("w").over(whole)))
    left = F.greatest(F.col("budget") - F.col("cap_before"), F.lit(0.0))
    w_left = F.col("w_all") - F.col("w_before")
    n = n.withColumn("full", F.col("cap") * w_left <= F.col("w") * left)
    # the first child that is not full fixes the rate of all that follow it
    n = n.withColumn("rate", F.min(F.when(~F.col("full"), F.struct(
        F.col("cap") / F.col("w"), *order_keys, (left / w_left).alias("r")))).over(whole)["r"])
    share = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("w") * F.col("rate"))
    return n.withColumn("share", share).drop("cap_before", "w_before", "w_all", "full", "rate")


def leaf_budgets(rows: DataFrame, budget: Column, weights: dict[tuple, float], max_epochs: int) -> DataFrame:
    """Per leaf: tokens, full epochs and the token count of the partial epoch.

    ``rows`` has the path labels and ``__tokens``; ``budget`` is a column over
    the total (``all_tokens``), such as ``F.lit(10**9)`` or a share of it.
    """
    leaves = rows.groupBy(*PATH).agg(F.sum("__tokens").alias("tokens"))
    for level in range(3):      # weight 0 takes a node out with all below it: it has no capacity
        leaves = leaves.filter(weight_of(level, weights) > 0)
    total = rows.agg(F.coalesce(F.sum("__tokens"), F.lit(0)).alias("all_tokens")).select(
        F.floor(budget).cast("double").alias("budget"))
    shares = total
    for level in range(3):
        keys = list(PATH[:level + 1])
        nodes = leaves.groupBy(*keys).agg((F.sum("tokens") * max_epochs).alias("cap")).withColumn("w", weight_of(level, weights))
        if level == 0:
            nodes = nodes.crossJoin(F.broadcast(shares))      # one row: the whole budget
        else:
            nodes = nodes.join(shares, keys[:-1])
        shares = split_level(nodes, keys[:-1], keys[-1:]).select(*keys, F.col("share").alias("budget"))
    whole = F.floor(F.col("budget") + 1e-6).cast("long")
    return leaves.join(shares, list(PATH)).select(
        *PATH, "tokens", F.when(F.col("tokens") > 0, F.floor(whole / F.col("tokens"))).otherwise(0).cast("long").alias("epochs"),
        F.when(F.col("tokens") > 0, F.pmod(whole, F.col("tokens"))).otherwise(0).cast("long").alias("rest"))


def epoch_key(seed: str, epoch: Column, doc_id: Column) -> Column:
    """Place of a document in an epoch: the digest of seed, epoch and id (a null id counts as empty)."""
    return F.md5(F.concat(F.lit(seed + ":"), epoch.cast("string"), F.lit(":"),
                          F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def prefix_ends(narrow: DataFrame, budgets: DataFrame, seed: str) -> DataFrame:
    """Per leaf the key prefix in which the prefix of its partial epoch ends (no
    row: nowhere, all is taken) and the last key taken there (null: none)."""
    keyed = narrow.join(budgets, list(PATH)).withColumn("key", epoch_key(seed, F.col("epochs"), F.col("doc_id")))
    scope = keyed.withColumn("before", F.lit(0).cast("long"))
    for level in range(1, LEVELS + 1):
        bucket = F.substring("key", 1, DIGITS * level)
        run = Window.partitionBy(*PATH).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        last = (scope.groupBy(*PATH, bucket.alias("bucket"), "rest", "before").agg(F.sum("__tokens").alias("n"))
                     .withColumn("upto", F.col("before") + F.sum("n").over(run)).filter(F.col("upto") > F.col("rest"))
                     .groupBy(*PATH).agg(F.min(F.struct("bucket", (F.col("upto") - F.col("n")).alias("before"))).alias("b"))
                     .select(*PATH, F.col("b.bucket").alias("bucket"), F.col("b.before").alias("before")))
        last = materialize(narrow.sparkSession, last, "mix-buckets")
        scope = keyed.withColumn("bucket", bucket).join(last, [*PATH, "bucket"])
    order = Window.partitionBy(*PATH).orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    cut = (scope.groupBy(*PATH, "key", "doc_id", "before", "rest").agg(F.sum("__tokens").alias("n"))
                .withColumn("upto", F.col("before") + F.sum("n").over(order)).filter(F.col("upto") <= F.col("rest"))
                .groupBy(*PATH).agg(F.max("key").alias("last_key")))
    return last.select(*PATH, F.col("bucket").alias("last_bucket")).join(cut, list(PATH), "left")


def mix(spark: SparkSession, docs: DataFrame, domain: Column, budget: Column, weights: dict[tuple, float] | None = None,
        max_epochs: int = 4, seed: str = "mix") -> DataFrame:
    """Selected rows with all their columns, and ``__domain``, ``__language``,
    ``__source``, ``__tokens`` and ``__epoch`` (one output row per epoch taken)."""
    label = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    rows = (docs.withColumn(PATH[0], label(domain)).withColumn(PATH[1], label(F.col("lang")))
                .withColumn(PATH[2], label(F.col("source")))
                .withColumn("__tokens", F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long")))
    narrow = materialize(spark, rows.select("doc_id", *PATH, "__tokens"), "mix-rows")
    budgets = materialize(spark, leaf_budgets(narrow, budget, weights or {}, max_epochs), "mix-budgets")
    ends = materialize(spark, prefix_ends(narrow, budgets.drop("tokens"), seed), "mix-ends")
    leaves = budgets.join(ends, list(PATH), "left").select(
        *PATH, *(F.col(c).alias(f"__{c}") for c in ("epochs", "last_bucket", "last_key")))
    # written, so that its size is known: a tree of ordinary size is then broadcast and no text is shuffled
    leaves = materialize(spark, leaves, "mix-leaves")
    key = epoch_key(seed, F.col("__epochs"), F.col("doc_id"))
    in_prefix = F.col("__last_bucket").isNull() | (F.substring(key, 1, DIGITS * LEVELS) < F.col("__last_bucket")) | (
        F.coalesce(key <= F.col("__last_key"), F.lit(False)))
    none = F.array().cast("array<long>")
    epochs = F.concat(F.when(F.col("__epochs") > 0, F.sequence(F.lit(0).cast("long"), F.col("__epochs") - 1)).otherwise(none),
                      F.when(in_prefix, F.array("__epochs")).otherwise(none))
    return (rows.join(leaves, list(PATH)).withColumn("__epoch", F.explode(epochs))
                .select(*docs.columns, *PATH, "__tokens", "__epoch"))
