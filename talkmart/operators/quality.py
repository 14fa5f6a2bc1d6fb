"""Reports on schemas, JSON shape, keys, references and declared constraints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkmart.functions.once import computed_once
from talkmart.schemas import RAW, Table


def schema_differences(found: T.StructType, expected: T.StructType) -> list[tuple[str, str | None, str | None]]:
    """``(column, expected, found)`` for every column that is missing, extra or of another type."""
    have = {f.name: f.dataType.simpleString() for f in found.fields}
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    names = list(want) + [n for n in have if n not in want]
    return [(n, want.get(n), have.get(n)) for n in names if want.get(n) != have.get(n)]


def schema_report(spark: SparkSession, tables: Mapping[str, DataFrame], expected: Mapping[str, T.StructType]) -> DataFrame:
    """Schema differences of several tables; reads no rows."""
    rows = [
        (name, *difference)
        for name, schema in expected.items()
        for difference in schema_differences(tables[name].schema, schema)
    ]
    return spark.createDataFrame(rows, "table_name string, column string, expected string, found string")


# JSON kinds each expected type accepts. True and false count as whole numbers,
# because the check this follows takes them for such.
_ACCEPTED = {"str": ("STRING",), "int": ("BIGINT", "BOOLEAN"), "dict": ("OBJECT",), "list": ("ARRAY",)}


def _expected_kinds(struct: T.StructType) -> list[tuple[str, str]]:
    kinds = {T.StringType: "str", T.IntegerType: "int", T.LongType: "int", T.ArrayType: "list", T.StructType: "dict"}
    return [(f.name, kinds[type(f.dataType)]) for f in struct.fields]


def _kind(value: Column) -> Column:
    """BIGINT, STRING, OBJECT, …; a key that is not there gives NULL, a JSON null VOID."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def _check(value: Column, path: Column, expected: str) -> Column:
    """A ``(path, expected, found)`` violation, or NULL when the value fits."""
    kind = _kind(value)
    found = F.when(value.isNull(), "missing").when(~kind.isin(*_ACCEPTED[expected]), F.lower(kind))
    return F.when(
        found.isNotNull(), F.struct(path.alias("path"), F.lit(expected).alias("expected"), found.alias("found"))
    )


def _field(value: Column, name: str) -> Column:
    return F.try_variant_get(value, f"$.{name}", "variant")


def json_violations(
    docs: DataFrame, column: str = "json", schema: T.StructType = RAW, key: Sequence[str] = ()
) -> DataFrame:
    """Checks every JSON text or variant against a record schema, nested arrays of structs included.

    One row per violation: the key columns, the path, and what was expected and
    found. Keys beyond the schema are allowed. All rows are checked, not a sample.
    """
    root = F.col("_v")
    is_text = isinstance(docs.schema[column].dataType, T.StringType)
    value = F.try_parse_json(column) if is_text else F.col(column)
    parsed = computed_once(docs, key, {"_v": value})
    checks = [F.array(_check(root, F.lit("root"), "dict"))]
    is_object = _kind(root) == "OBJECT"
    for field, (name, expected) in zip(schema.fields, _expected_kinds(schema), strict=True):
        value = _field(root, name)
        path = F.lit(f"root.{name}")
        checks.append(F.when(is_object, F.array(_check(value, path, expected))))
        if isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.StructType):
            checks.append(F.when(is_object, _element_checks(value, f"root.{name}", field.dataType.elementType)))
    empty = F.array().cast("array<struct<path: string, expected: string, found: string>>")
    all_checks = F.concat(*(F.coalesce(c, empty) for c in checks))
    violations = F.array_compact(all_checks)
    return parsed.select(*key, F.explode(violations).alias("x")).select(*key, "x.path", "x.expected", "x.found")


def _element_checks(array: Column, path: str, element: T.StructType) -> Column:
    items = F.when(_kind(array) == "ARRAY", F.try_variant_get(array, "$", "array<variant>"))
    kinds = _expected_kinds(element)

    def per_item(item: Column, i: Column) -> Column:
        at = F.concat(F.lit(path + "["), i.cast("string"), F.lit("]"))
        own = F.array(_check(item, at, "dict"))
        fields = F.array(*(_check(_field(item, n), F.concat(at, F.lit("." + n)), e) for n, e in kinds))
        return F.when(_kind(item) == "OBJECT", fields).otherwise(own)

    return F.flatten(F.transform(items, per_item))


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def fk_orphans(facts: DataFrame, dim: DataFrame, columns: Sequence[str], dim_columns: Sequence[str] | None = None) -> DataFrame:
    """Values of a reference that the dimension lacks, with their number of fact rows.

    Facts are counted per value first, so a hot value is one row at the join. A
    reference with a NULL part is not checked, as in SQL.
    """
    names = list(dim_columns or columns)
    used = facts.dropna(subset=list(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))
    known = dim.select(*(F.col(d).alias(c) for c, d in zip(columns, names, strict=True)))
    return used.join(known, list(columns), "left_anti")


def constraint_report(df: DataFrame, table: Table, dims: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """``(table_name, rule, violations)`` for NOT NULL, length, primary key and references.

    NOT NULL and length share one pass over the table; the key and each
    reference take one aggregation.
    """
    row_rules = [(f"not null: {c}", F.col(c).isNull()) for c in table.not_null]
    row_rules += [(f"length <= {n}: {c}", F.length(c) > n) for c, n in table.max_length.items()]
    counts = df.agg(*(F.count_if(broken).alias(f"r{i}") for i, (_, broken) in enumerate(row_rules)))
    pairs = F.array(
        *(F.struct(F.lit(rule).alias("rule"), F.col(f"r{i}").alias("violations")) for i, (rule, _) in enumerate(row_rules))
    )
    reports = [counts.select(F.explode(pairs).alias("p")).select("p.rule", "p.violations")]
    if table.primary_key:
        surplus = duplicate_keys(df, table.primary_key).agg(
            F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("violations")
        )
        reports.append(surplus.select(F.lit(f"unique: {', '.join(table.primary_key)}").alias("rule"), "violations"))
    for fk in table.foreign_keys:
        if dims and fk.table in dims:
            orphans = fk_orphans(df, dims[fk.table], fk.columns)
            total = orphans.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("violations"))
            reports.append(total.select(F.lit(f"{', '.join(fk.columns)} in {fk.table}").alias("rule"), "violations"))
    report = reduce(DataFrame.unionByName, reports)
    return report.select(F.lit(table.name).alias("table_name"), "rule", F.col("violations").cast("bigint").alias("violations"))


def score_violations(scored: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Scores outside 0..1 or categories outside the list."""
    bad_score = ~F.col("sentiment_score").between(0, 1) | F.col("sentiment_score").isNull()
    return scored.filter(bad_score | ~F.col("category").isin(*categories) | F.col("category").isNull())
