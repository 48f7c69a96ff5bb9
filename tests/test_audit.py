"""Every rule of the catalog against a planted fault, over all fourteen tables."""

from __future__ import annotations

from collections import Counter

import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from tallyforge.operators import catalog as views
from tallyforge.schemas import CATALOG_DDL


@pytest.fixture(scope="module")
def sound(spark):
    """Five rows of each table that break no rule, and one of nulls."""
    allowed = {(t, c): values for t, c, values in views.ALLOWED_VALUES}
    parents = {(t, c): parent for t, c, parent in views.REFERENCES}
    tables = {}
    for table, ddl in CATALOG_DDL.items():
        rows = spark.range(6)
        columns = []
        for field in spark.createDataFrame([], ddl).schema:
            key = (table, field.name)
            if key in allowed:
                value = F.element_at(F.lit(allowed[key]), (F.col("n") % len(allowed[key]) + 1).cast("int"))
            elif key in parents:
                value = F.format_string("%d", F.col("n"))
            elif field.dataType.typeName() == "string":
                value = F.format_string("%d", F.col("n")) if field.name == "id" else F.format_string(f"{field.name}-%d", F.col("n"))
            else:
                value = F.lit(None) if field.dataType.typeName() != "integer" else F.col("n")
            columns.append(F.when(F.col("n") < 5, value).cast(field.dataType).alias(field.name))
        tables[table] = rows.withColumnRenamed("id", "n").select(*columns)
    return tables


def planted():
    for table, column, _ in views.ALLOWED_VALUES:
        yield table, [column], "allowed_values", "odd"
    for table, column, _, high in views.RANGES:
        yield table, [column], "range", str(high + 1)
    for table, columns in views.UNIQUE:
        yield table, columns, "unique", None
    for table, column, _ in views.REFERENCES:
        yield table, [column], "foreign_key", "gone"


def test_a_sound_catalog_breaks_no_rule(sound):
    assert len(sound) == 14 and views.audit_catalog(sound).isEmpty()


def test_one_fault_of_each_rule(spark, sound):
    """One row of each table for each of its rules, all in one audit; hot faults count their rows."""
    faulty, want = dict(sound), Counter()
    for number, (table, columns, rule, value) in enumerate(planted()):
        row = sound[table].where(F.col(columns[0]).isNotNull()).limit(1)
        # Everything else is null in the planted row, which breaks nothing.
        keep = {c: (F.col(c) if value is None else F.lit(value).cast(sound[table].schema[c].dataType)) for c in columns}
        row = row.select(*[keep.get(c, F.lit(None).cast(sound[table].schema[c].dataType)).alias(c) for c in sound[table].columns])
        copies = 1 if rule == "unique" else 1 + number % 3
        faulty[table] = faulty[table].unionByName(row.withColumn("_c", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("_c"))
        want[table, ",".join(columns), rule] = 2 if rule == "unique" else copies
    got = {(r.table_name, r.column_name, r.rule): r.violations for r in views.audit_catalog(faulty).collect()}
    assert got == dict(want) and len(want) == sum(map(len, (views.ALLOWED_VALUES, views.RANGES, views.UNIQUE, views.REFERENCES)))


def test_each_table_is_read_once(spark, sound, tmp_path):
    read = {}
    for table, df in sound.items():
        df.write.parquet(str(tmp_path / table))
        read[table] = spark.read.parquet(str(tmp_path / table))
    text = plan_text(views.audit_catalog(read)).split("== Initial Plan ==")[-1]
    assert text.count("FileScan parquet") == len({r[0] for r in views._rules(read)} | {r[3] for r in views._rules(read)} - {None})
