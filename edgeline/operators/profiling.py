"""What the source tables hold: column profiles, key columns, foreign keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeline.runtime import materialize

ID_LIKE = "(?i)(id|key)$"


def _short(column: Column, data_type: T.DataType | None = None) -> Column:
    """A value as text, long and nested ones by their 128-bit digest."""
    if _nested(data_type):
        return F.when(column.isNotNull(), F.md5(F.to_json(F.struct(column.alias("value")))))
    text = column.cast("string")
    return F.when(F.octet_length(text) > 32, F.md5(text)).otherwise(text)


def _nested(data_type: T.DataType | None) -> bool:
    return isinstance(data_type, (T.ArrayType, T.MapType, T.StructType))


def _profile_table(name: str, df: DataFrame, exact: bool, ends: bool) -> DataFrame:
    columns = [F.col(f"`{field.name}`") for field in df.schema]
    measures = []
    kinds = [field.dataType for field in df.schema]
    for i, (column, kind) in enumerate(zip(columns, kinds)):
        # A smallest array says nothing.
        low, high = (F.lit(None), F.lit(None)) if _nested(kind) or not ends else (F.min(column), F.max(column))
        measures += [
            F.count(column).alias(f"filled{i}"),
            low.cast("string").alias(f"min{i}"),
            high.cast("string").alias(f"max{i}"),
        ]
        if not exact:
            # Plain values are hashed as they are, without being made text.
            plain = isinstance(kind, (T.NumericType, T.StringType, T.DatetimeType))
            counted = column if plain else _short(column, kind)
            measures.append(F.approx_count_distinct(counted).alias(f"distinct{i}"))
    measured = df.agg(F.count(F.lit(1)).alias("n_rows"), *measures)
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
            (F.col("n_rows") - F.col(f"filled{i}")).alias("n_nulls"),
            F.col(f"min{i}").alias("min_value"),
            F.col(f"max{i}").alias("max_value"),
            *([] if exact else [F.col(f"distinct{i}").alias("n_distinct")]),
        )
        for i, field in enumerate(df.schema)
    ]
    profiled = measured.select(F.lit(name).alias("table_name"), "n_rows", F.inline(F.array(*rows)))
    if exact:
        # Narrow (column, value) rows, reduced before and after the shuffle.
        values = df.select(
            F.inline(
                F.array(
                    *[
                        F.struct(F.lit(i).alias("position"), _short(c, kind).alias("value"))
                        for i, (c, kind) in enumerate(zip(columns, kinds))
                    ]
                )
            )
        ).distinct()
        counted = values.groupBy("position").agg(F.count("value").alias("n_distinct"))
        # One row per column of the table.
        profiled = profiled.join(F.broadcast(counted), "position", "left").withColumn(
            "n_distinct", F.coalesce("n_distinct", F.lit(0))
        )
    return profiled.select(
        "table_name", "n_rows", "column_name", "data_type", "n_nulls", "n_distinct", "min_value", "max_value"
    )


def profile(tables: dict[str, DataFrame], exact: bool = True, ends: bool = True) -> DataFrame:
    """One row per column of every table, each table aggregated in one job.

    Arrays and other nested columns have no smallest and largest value, and are counted by
    digest. `exact=False` estimates the distinct counts, `ends=False` leaves out smallest and largest values.
    """
    parts = [_profile_table(name, df, exact, ends) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def entity_keys(profiled: DataFrame) -> DataFrame:
    """Columns that identify their rows: no NULL, no repeat. `id_like` says the name agrees."""
    return profiled.filter(
        (F.col("n_rows") > 0) & (F.col("n_nulls") == 0) & (F.col("n_distinct") == F.col("n_rows"))
    ).select("table_name", "column_name", F.col("column_name").rlike(ID_LIKE).alias("id_like"))


# An estimated distinct count this far under the number of rows rules a key out.
FAR_FROM_UNIQUE = 0.8


def key_columns(tables: dict[str, DataFrame]) -> DataFrame:
    """The result of `entity_keys`, with values shuffled only for columns that an estimate leaves possible."""
    rough = profile(tables, exact=False, ends=False)
    possible = rough.filter(
        (F.col("n_rows") > 0) & (F.col("n_nulls") == 0) & (F.col("n_distinct") >= FAR_FROM_UNIQUE * F.col("n_rows"))
    )
    wanted: dict[str, list[str]] = {}
    # One row per column of the schema.
    for r in possible.select("table_name", "column_name").collect():
        wanted.setdefault(r["table_name"], []).append(r["column_name"])
    if not wanted:
        return entity_keys(rough.limit(0))
    return entity_keys(profile({name: tables[name].select(*[f"`{c}`" for c in own]) for name, own in wanted.items()}, ends=False))


def _kind(data_type: T.DataType) -> str | None:
    if isinstance(data_type, T.IntegralType):
        return "integer"
    return "string" if isinstance(data_type, T.StringType) else None


# A sketch holds the values whose hash falls into one of this many parts.
SKETCH_PARTS = 16
# A pair goes on unless its sketch lies this many standard deviations under the wanted containment.
DOUBT = 6.0


def _typed_value(column: Column, kind: str, part: bool) -> Column:
    """A value as text, or NULL where a sketch leaves it out. Integers of any width are hashed as long ones."""
    if not part:
        return _short(column)
    hashed = F.xxhash64(column.cast("long") if kind == "integer" else column)
    return F.when(F.pmod(hashed, F.lit(SKETCH_PARTS)) == 0, _short(column))


def _typed_values(tables: dict[str, DataFrame], columns: dict[str, list[tuple[str, str]]], part: bool) -> DataFrame:
    """Distinct (table_name, column_name, kind, value) of the given columns, or only the part of a sketch."""
    frames = []
    for name, own in columns.items():
        rows = tables[name].select(
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(name).alias("table_name"),
                            F.lit(column).alias("column_name"),
                            F.lit(kind).alias("kind"),
                            _typed_value(F.col(f"`{column}`"), kind, part).alias("value"),
                        )
                        for column, kind in own
                    ]
                )
            )
        ).filter(F.col("value").isNotNull())
        frames.append(rows.distinct())
    return reduce(DataFrame.unionByName, frames)


def _matches(values: DataFrame, keys: DataFrame) -> DataFrame:
    """(child_table, child_column, parent_table, parent_column, n_matched, n_values) of columns that share values."""
    # One row per key column of the schema.
    key_values = values.join(F.broadcast(keys.select("table_name", "column_name")), ["table_name", "column_name"])
    parent = key_values.select(
        F.col("table_name").alias("parent_table"), F.col("column_name").alias("parent_column"), "kind", "value"
    )
    child = values.withColumnsRenamed({"table_name": "child_table", "column_name": "child_column"})
    totals = child.groupBy("child_table", "child_column").agg(F.count(F.lit(1)).alias("n_values"))
    matched = (
        child.join(parent, ["kind", "value"])
        .filter(F.col("child_table") != F.col("parent_table"))
        .groupBy("child_table", "child_column", "parent_table", "parent_column")
        .agg(F.count(F.lit(1)).alias("n_matched"))
    )
    return matched.join(F.broadcast(totals), ["child_table", "child_column"], "right")


def possible_pairs(
    tables: dict[str, DataFrame], keys: DataFrame, columns: dict[str, list[tuple[str, str]]], min_containment: float
) -> set[tuple[str, str, str, str]]:
    """Column pairs that sketches do not rule out; both sides' sketches hold the same part of all values.

    The values of a sketch are a random part of the column's, so what of them the key's sketch has estimates the
    containment. A pair is ruled out only far below the wanted one; a column without
    values in its sketch is never.
    """
    rows = _matches(materialize(_typed_values(tables, columns, part=True))[0], keys).collect()
    kinds = {(t, c): kind for t, own in columns.items() for c, kind in own}
    key_list = [(r["table_name"], r["column_name"]) for r in keys.select("table_name", "column_name").collect()]
    seen = {(r["child_table"], r["child_column"]): r["n_values"] for r in rows}
    share = {(r["child_table"], r["child_column"], r["parent_table"], r["parent_column"]): r["n_matched"] for r in rows}
    out = set()
    for child, kind in kinds.items():
        for parent in key_list:
            if child[0] == parent[0] or kinds.get(parent) != kind:
                continue
            n = seen.get(child, 0)
            doubt = DOUBT * ((min_containment * (1 - min_containment) + 0.01) * n) ** 0.5
            if share.get((*child, *parent), 0) >= min_containment * n - doubt:
                out.add((*child, *parent))
    return out


def foreign_keys(
    tables: dict[str, DataFrame], keys: DataFrame, min_containment: float = 0.95
) -> DataFrame:
    """Column pairs where the child's values (nearly) all occur in a key column of another table.

    All integer and text columns take part, whatever their names. Sketches of a sixteenth of
    the distinct values rule most pairs out; only the columns of the others are reduced to
    distinct (column, value) rows, which meet on the value in one shuffle, a value at most
    once per column, and give the exact containment.
    """
    columns = {name: [(f.name, _kind(f.dataType)) for f in df.schema if _kind(f.dataType)] for name, df in tables.items()}
    columns = {name: own for name, own in columns.items() if own}
    pairs = possible_pairs(tables, keys, columns, min_containment)
    # Pairs of columns of the schema.
    listed = keys.sparkSession.createDataFrame(
        sorted(pairs), "child_table string, child_column string, parent_table string, parent_column string"
    )
    used = {p[:2] for p in pairs} | {p[2:] for p in pairs}
    left = {name: [x for x in own if (name, x[0]) in used] for name, own in columns.items()}
    left = {name: own for name, own in left.items() if own}
    if not left:
        return listed.select("*", *(F.lit(0).cast("long").alias(c) for c in ("n_matched", "n_values")), F.lit(0.0).alias("containment")).limit(0)
    values, _ = materialize(_typed_values(tables, left, part=False))
    return (
        _matches(values, keys)
        .filter("parent_table IS NOT NULL")
        .join(F.broadcast(listed), ["child_table", "child_column", "parent_table", "parent_column"], "left_semi")
        .withColumn("containment", F.col("n_matched") / F.col("n_values"))
        .filter(F.col("containment") >= min_containment)
    )
