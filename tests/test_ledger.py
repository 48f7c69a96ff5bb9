"""The hash tree of closed periods, its proofs, and credit notes."""

from __future__ import annotations

import hashlib
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyforge.operators import billing, ledger

MONTHS = [date(2024, 1, 1), date(2024, 2, 1)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def closed(spark):
    rows = [(m, f"org{o}", plan, chain, 10 * o + i) for m in MONTHS for o in range(60) for i, (plan, chain) in enumerate([("pro", "eth"), ("pro", "arb")])]
    metered = spark.createDataFrame(rows, "period_start date, organization_id string, plan_slug string, chain_slug string, units bigint")
    return billing.close_period(metered).cache()


def slow_root(leaves, depth):
    """The trie of one period, node by node."""

    def node(prefix):
        inside = sorted((k, h) for k, h in leaves.items() if k.startswith(prefix))
        if len(prefix) < depth:
            inside = [(p, node(p)) for p in sorted({k[: len(prefix) + 1] for k, _ in inside})]
        return sha(",".join(f"{n}:{h}" for n, h in inside))

    return node("")


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_proofs_lead_to_the_root(spark, closed, depth):
    found = ledger.leaves(closed).cache()
    nodes = ledger.hash_tree(found, depth).cache()
    proved = ledger.proofs(found, nodes, depth).cache()
    rows = proved.withColumn("holds", ledger.proof_holds(depth)).collect()
    assert len(rows) == 120 and all(r.holds for r in rows)
    for month in MONTHS:
        hashes = {r.organization_id: r.leaf_hash for r in rows if r.period_start == month}
        for org in ("org0", "org59"):
            own = sorted(r.row_hash for r in closed.where((F.col("organization_id") == org) & (F.col("period_start") == F.lit(month))).collect())
            assert hashes[org] == sha("|".join([org, *own]))
        assert {r.root for r in rows if r.period_start == month} == {slow_root({sha(o): h for o, h in hashes.items()}, depth)}
    # A leaf, a sibling or a root that is not the one the tree was built from.
    other = proved.withColumn("leaf_hash", F.when(F.col("organization_id") == "org7", F.lit(sha("x"))).otherwise(F.col("leaf_hash")))
    assert {r.organization_id for r in other.where(~ledger.proof_holds(depth)).collect()} == {"org7"}
    bent = F.transform("path", lambda level: F.transform(level, lambda c: F.struct(c["name"], F.reverse(c["hash"]).alias("hash"))))
    assert proved.withColumn("path", bent).where(ledger.proof_holds(depth)).isEmpty()
    assert proved.withColumn("root", F.lit(sha("y"))).where(ledger.proof_holds(depth)).isEmpty()


def test_changed_rows_are_found_from_the_roots_down(spark, closed):
    changed = closed.where("NOT (organization_id = 'org9' AND period_start = DATE '2024-02-01')")
    spoiled = F.when((F.col("organization_id") == "org3") & (F.col("chain_slug") == "arb") & (F.col("period_start") == F.lit(MONTHS[0])), "0")
    changed = changed.withColumn("row_hash", F.coalesce(spoiled, F.col("row_hash")))
    new = changed.where("organization_id = 'org1' AND period_start = DATE '2024-01-01'").withColumn("organization_id", F.lit("late"))
    trees = [ledger.hash_tree(ledger.leaves(s), 2).cache() for s in (closed, changed.unionByName(new))]
    got = {(r.period_start, r.key, r.change) for r in ledger.changed_leaves(*trees, 2).collect()}
    assert got == {(MONTHS[0], sha("org3"), "changed"), (MONTHS[1], sha("org9"), "removed"), (MONTHS[0], sha("late"), "added")}
    assert ledger.changed_leaves(trees[0], trees[0], 2).isEmpty()


def test_leaves_cover_invoices(spark, closed):
    invoices = spark.createDataFrame(
        [(MONTHS[0], "org1", "INV-1", Decimal("5.00")), (MONTHS[0], "fixed", "INV-2", Decimal("7.00"))],
        "period_start date, organization_id string, invoice_number string, total decimal(18,2)",
    )
    with_them = {r.organization_id: r.leaf_hash for r in ledger.leaves(closed, invoices).where("period_start = DATE '2024-01-01'").collect()}
    assert len(with_them) == 61 and with_them["fixed"] == sha("fixed||INV-2=7.00")
    dearer = invoices.withColumn("total", F.col("total") + 1)
    other = {r.organization_id: r.leaf_hash for r in ledger.leaves(closed, dearer).where("period_start = DATE '2024-01-01'").collect()}
    assert {o for o in other if other[o] != with_them[o]} == {"org1", "fixed"}
    assert ledger.hash_tree(ledger.leaves(closed.limit(0)), 1).isEmpty()
    assert [ledger.depth_for(n) for n in (0, 8, 9, 128, 129, 10_000)] == [1, 1, 1, 1, 2, 3]


def test_differences_sum_to_the_credit_notes(spark):
    rows = [(MONTHS[0], f"o{i}", d, "match" if not d else "mismatch") for i, d in enumerate([Decimal("1.50"), Decimal("0.00"), Decimal("-2.25"), None])]
    reconciled = spark.createDataFrame(rows, "period_start date, organization_id string, difference decimal(18,2), outcome string")
    notes = {r.organization_id: (r.kind, r.amount, r.note_number) for r in ledger.credit_notes(reconciled).collect()}
    assert notes == {"o0": ("credit", Decimal("1.50"), "CN-2024-01-01-o0"), "o2": ("debit", Decimal("-2.25"), "CN-2024-01-01-o2")}
    assert sum(n[1] for n in notes.values()) == Decimal("-0.75")
