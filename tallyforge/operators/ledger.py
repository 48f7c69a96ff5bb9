"""Ledger of closed periods: a hash tree over what each organisation owes, proofs, and credit notes (H5, H6).

The tree is a trie over the hash of the organisation's id, sixteen children a node, so a row's place hangs on nothing but
its organisation: building it takes one grouping per level, each over a sixteenth of the rows before, and no row has to be
ranked.  Our assumption is its form; the documents ask for a proof hash per reconciled invoice.
"""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.billing import MONEY

KEYS = ["period_start", "organization_id"]


def _hash_of(children: Column) -> Column:
    """The hash of a node from its (name, hash) children in order."""
    return F.sha2(F.array_join(F.transform(children, lambda c: F.concat(c["name"], F.lit(":"), c["hash"])), ","), 256)


def leaves(snapshot: DataFrame, invoices: DataFrame | None = None) -> DataFrame:
    """(period_start, organization_id, key, leaf_hash): one leaf per organisation and period.

    It covers the hashes of the organisation's rows in the closed ``snapshot``, which are bounded by the catalog, and
    number and total of its ``invoices`` if given.
    """
    owed = snapshot.groupBy(*KEYS).agg(F.array_join(F.sort_array(F.collect_list("row_hash")), "|").alias("_rows"))
    if invoices is not None:
        line = F.concat_ws("=", "invoice_number", F.col("total").cast("string"))
        billed = invoices.groupBy(*KEYS).agg(F.array_join(F.sort_array(F.collect_list(line)), "|").alias("_billed"))
        owed = owed.join(billed, KEYS, "full")
    parts = ["organization_id", *[c for c in owed.columns if c.startswith("_")]]
    return owed.select(
        *KEYS,
        F.sha2("organization_id", 256).alias("key"),
        F.sha2(F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in parts]), 256).alias("leaf_hash"),
    )


def depth_for(count: int, bucket: int = 8) -> int:
    """Levels below the root for so many leaves a period, with about ``bucket`` of them in a lowest node."""
    return max(1, ceil(log(max(1, count) / bucket, 16))) if count > bucket else 1


def hash_tree(found: DataFrame, depth: int) -> DataFrame:
    """(period_start, level, prefix, hash, children) of all nodes; the root has level 0 and an empty prefix."""
    children = found.select("period_start", F.col("key").alias("name"), F.col("leaf_hash").alias("hash"))
    levels = []
    for level in range(depth, -1, -1):
        node = children.groupBy("period_start", F.substring("name", 1, level).alias("prefix")).agg(
            F.sort_array(F.collect_list(F.struct("name", "hash"))).alias("children")
        )
        node = node.select("period_start", F.lit(level).alias("level"), "prefix", _hash_of(F.col("children")).alias("hash"), "children")
        levels.append(node)
        children = node.select("period_start", F.col("prefix").alias("name"), "hash")
    result = levels[0]
    for node in levels[1:]:
        result = result.unionByName(node)
    return result


def proofs(found: DataFrame, nodes: DataFrame, depth: int) -> DataFrame:
    """Per leaf ``root`` and ``path``: the children of the nodes above it, from the lowest to the root.

    Whoever has a leaf's row and its path can work out the root again, without any other organisation's rows.
    """
    result = found
    for level in range(depth, -1, -1):
        node = nodes.where(F.col("level") == level).select(
            F.col("period_start"), F.col("prefix").alias("_prefix"), F.col("children").alias(f"_{level}"), F.col("hash").alias("root")
        )
        result = result.drop("root").withColumn("_prefix", F.substring("key", 1, level)).join(node, ["period_start", "_prefix"])
    path = F.array(*[f"_{level}" for level in range(depth, -1, -1)])
    return result.select(*KEYS, "key", "leaf_hash", "root", path.alias("path"))


def proof_holds(depth: int) -> Column:
    """Whether a row of ``proofs`` leads from its leaf to its root."""

    def there(children: Column, name: Column, value: Column) -> Column:
        return F.exists(children, lambda c: (c["name"] == name) & (c["hash"] == value))

    holds, below, name = F.lit(True), F.col("leaf_hash"), F.col("key")
    for step in range(depth + 1):
        children = F.col("path")[step]
        holds &= there(children, name, below)
        below, name = _hash_of(children), F.substring("key", 1, depth - step)
    return F.coalesce(holds & (below == F.col("root")), F.lit(False))


def changed_leaves(before: DataFrame, after: DataFrame, depth: int) -> DataFrame:
    """(period_start, key, change) of the leaves that two trees disagree about: changed, added or removed.

    From the roots down, only nodes whose hashes differ are compared further, so equal periods end at their roots.
    """

    def children(nodes: DataFrame, level: int, suspects: DataFrame | None) -> DataFrame:
        rows = nodes.where(F.col("level") == level)
        rows = rows if suspects is None else rows.join(suspects, ["period_start", "prefix"], "left_semi")
        return rows.select("period_start", F.explode("children").alias("c")).select("period_start", "c.name", "c.hash")

    suspects = None
    for level in range(depth + 1):
        old = children(before, level, suspects).withColumnRenamed("hash", "_old")
        new = children(after, level, suspects).withColumnRenamed("hash", "_new")
        differing = old.join(new, ["period_start", "name"], "full").where(~F.col("_old").eqNullSafe(F.col("_new")))
        suspects = differing.select("period_start", F.col("name").alias("prefix"))
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").otherwise("changed")
    return differing.select("period_start", F.col("name").alias("key"), change.alias("change"))


def credit_notes(reconciled: DataFrame) -> DataFrame:
    """A note for each difference that ``billing.reconcile`` found: closed periods are never rewritten.

    Billed too much is credited, too little is debited; ``amount`` has the sign of the difference, so notes and closing
    agree: invoices less notes are what the snapshots owe.
    """
    number = F.concat_ws("-", F.lit("CN"), F.date_format("period_start", "yyyy-MM-dd"), "organization_id")
    return reconciled.where(F.col("difference") != 0).select(
        number.alias("note_number"),
        *KEYS,
        F.when(F.col("difference") > 0, "credit").otherwise("debit").alias("kind"),
        F.col("difference").cast(MONEY).alias("amount"),
        F.col("outcome").alias("reason"),
    )
