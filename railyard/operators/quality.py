"""Declared constraints as a data-quality job over whole tables.

``violations`` gives one row per broken rule and row or key: (TableName, Rule, KeyValue,
Detail). ``summary`` counts them per rule, with the rules that hold at 0.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.checkpoints import cut
from ..plans.tables import Tables
from ..schemas import TABLES, Table

FAMILIES = ("keys", "composite", "foreign", "domains", "rows", "required")
ROW_FAMILIES = ("domains", "rows", "required")
ROWS_OF_A_TASK = 1_000_000


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _text(*columns: str):
    return F.concat_ws("|", *[F.col(c).cast("string") for c in columns])


def _shape(df: DataFrame, table: str, rule: str, key, detail) -> DataFrame:
    return df.select(
        F.lit(table).alias("TableName"),
        F.lit(rule).alias("Rule"),
        key.alias("KeyValue"),
        detail.cast("string").alias("Detail"),
    )


def _rows_rules(spec: Table) -> list[tuple[str, str, object, str]]:
    """(family, rule, broken condition, column to show) for checks of a single row."""
    rules = []
    for c in spec.cols:
        column = F.col(c.name)
        if c.domain:
            rules.append(("domains", f"domain {c.name}", ~column.isin(*c.domain), c.name))
        if c.required:
            rules.append(("required", f"required {c.name}", column.isNull(), c.name))
        if c.max_len:
            too_long = F.length(column) > c.max_len
            rules.append(("required", f"length {c.name}", too_long, c.name))
    if spec.name == "Users":
        none = F.col("Email").isNull() & F.col("PhoneNumber").isNull()
        rules.append(("rows", "contact present", none, "Email"))
    if spec.name == "Routes":
        same = F.col("DepartureStationID") == F.col("ArrivalStationID")
        rules.append(("rows", "different stations", same, "ArrivalStationID"))
    if spec.name == "Schedules":
        late = F.col("ArrivalTime") <= F.col("DepartureTime")
        rules.append(("rows", "arrival after departure", late, "ArrivalTime"))
    return rules


def _row_checks(t: Tables, spec: Table, families) -> DataFrame | None:
    """All single-row rules of a table in one scan; a NULL condition passes."""
    rules = [r for r in _rows_rules(spec) if r[0] in families]
    if not rules:
        return None
    broken = F.array(
        *[
            F.when(
                F.coalesce(cond, F.lit(False)),
                F.struct(F.lit(rule).alias("Rule"), F.col(c).cast("string").alias("Detail")),
            )
            for _, rule, cond, c in rules
        ]
    )
    return (
        t[spec.name]
        .select(_text(spec.key).alias("KeyValue"), F.explode(F.array_compact(broken)).alias("b"))
        .select(F.lit(spec.name).alias("TableName"), "b.Rule", "KeyValue", "b.Detail")
    )


def _dealt(t: Tables, df: DataFrame, columns: tuple[str, ...], *tables: str) -> DataFrame:
    """Rows dealt by key to as many tasks as the rows of these tables need, so that what a task
    holds does not grow with them. Their keys are narrow, which sizes in bytes do not tell."""
    rows = sum(t.once(f"rows of {name}", lambda t, name=name: t[name].count()) for name in tables)
    return df.repartition(max(1, ceil(rows / ROWS_OF_A_TASK)), *columns)


def _duplicates(t: Tables, spec: Table, columns: tuple[str, ...]) -> DataFrame:
    given = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    keys = _dealt(t, t[spec.name].filter(given).select(*columns), columns, spec.name)
    counted = keys.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return _shape(counted, spec.name, f"unique {', '.join(columns)}", _text(*columns), F.col("n"))


def _references(specs: list[Table]) -> list[tuple[Table, str, str, str]]:
    return [(spec, column, *ref) for spec in specs for column, ref in spec.foreign.items()]


def _bounded(t: Tables, parent: str) -> bool:
    return t.bounds.get(parent, t.broadcast_rows + 1) <= t.broadcast_rows


def _missing(t: Tables, references) -> DataFrame:
    """(place, value) of the distinct unknown references to parents that are not known to be
    small. Values, all that there should be none of, are written as text in one job."""

    def one(place: int, spec: Table, column: str, parent: str, key: str) -> DataFrame:
        given = t[spec.name].filter(F.col(column).isNotNull()).select(column)
        asked = _dealt(t, given, (column,), spec.name, parent).distinct()
        known = _dealt(t, t[parent].select(F.col(key).alias(column)), (column,), spec.name, parent)
        unknown = asked.join(known.hint("merge"), column, "left_anti")
        return unknown.select(F.lit(place).alias("place"), F.col(column).cast("string").alias("value"))

    return cut(_union([one(i, *r) for i, r in enumerate(references) if not _bounded(t, r[2])]))


def _orphans(t: Tables, specs: list[Table]) -> list[DataFrame]:
    """Rows whose reference is unknown. Against a parent that is known to be small this is
    one scan. Else only the distinct references are looked up; the rows themselves are joined
    back to the missing ones, of which there should be none."""
    references = _references(specs)
    missing = None
    parts = []
    for i, (spec, column, parent, key) in enumerate(references):
        child = t[spec.name].filter(F.col(column).isNotNull()).select(_text(spec.key).alias("k"), column)
        if _bounded(t, parent):
            parents = t[parent].select(F.col(key).alias(column))
            rows = child.join(F.broadcast(parents), column, "left_anti")
        else:
            missing = _missing(t, references) if missing is None else missing
            value = missing.filter(F.col("place") == i).select("value")
            rows = child.join(value, F.col(column).cast("string") == F.col("value"), "left_semi")
        parts.append(_shape(rows, spec.name, f"foreign {column}", F.col("k"), F.col(column)))
    return parts


def violations(t: Tables, families=FAMILIES, tables=None) -> DataFrame:
    specs = [TABLES[n] for n in (tables or TABLES)]
    parts: list[DataFrame] = []
    for spec in specs:
        if "keys" in families:
            singles = [(spec.key,)] + [u for u in spec.unique if len(u) == 1]
            parts += [_duplicates(t, spec, u) for u in singles]
        if "composite" in families:
            parts += [_duplicates(t, spec, u) for u in spec.unique if len(u) > 1]
        checks = _row_checks(t, spec, set(families) & set(ROW_FAMILIES))
        if checks is not None:
            parts.append(checks)
    if "foreign" in families:
        parts += _orphans(t, specs)
    return _union(parts)


def rule_names(families=FAMILIES, tables=None) -> list[tuple[str, str]]:
    out = []
    for spec in [TABLES[n] for n in (tables or TABLES)]:
        if "keys" in families:
            singles = [(spec.key,)] + [u for u in spec.unique if len(u) == 1]
            out += [(spec.name, f"unique {', '.join(u)}") for u in singles]
        if "composite" in families:
            out += [(spec.name, f"unique {', '.join(u)}") for u in spec.unique if len(u) > 1]
        if "foreign" in families:
            out += [(spec.name, f"foreign {c}") for c in spec.foreign]
        out += [(spec.name, rule) for family, rule, *_ in _rows_rules(spec) if family in families]
    return out


def summary(t: Tables, families=FAMILIES, tables=None) -> DataFrame:
    """Violations per table and rule; every declared rule is listed."""
    spark = next(iter(t.values())).sparkSession
    names = rule_names(families, tables)
    rules = spark.createDataFrame(names, "TableName string, Rule string")
    found = violations(t, families, tables).groupBy("TableName", "Rule").agg(
        F.count(F.lit(1)).alias("n")
    )
    # both sides have at most one row per declared rule
    return rules.join(F.broadcast(found), ["TableName", "Rule"], "left").select(
        "TableName", "Rule", F.coalesce("n", F.lit(0).cast("bigint")).alias("Violations")
    )
