"""Target profile: column types of the output, coercion to them, and quarantine of bad rows."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelyard.functions.coerce import FROM_TEXT, to_text

# Target type of each source type, the text limit, and the Spark type a target is stored as.
TARGET_OF = {
    T.ShortType: "SHORT",
    T.IntegerType: "LONG",
    T.LongType: "LONG",
    T.FloatType: "DOUBLE",
    T.DoubleType: "DOUBLE",
    T.DecimalType: "DOUBLE",
    T.DateType: "DATETIME",
    T.TimestampType: "DATETIME",
    T.TimestampNTZType: "DATETIME",
    T.BooleanType: "YESNO",
    T.BinaryType: "LONGBINARY",
}
TEXT_LIMIT = 255
STORED_AS = {
    "SHORT": "smallint",
    "LONG": "int",
    "DOUBLE": "double",
    "DATETIME": "timestamp_ntz",
    "YESNO": "boolean",
    "LONGBINARY": "binary",
    "TEXT(255)": "string",
    "MEMO": "string",
}
_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


def _name(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def declared_length(field: T.StructField) -> int | None:
    """Size of a char/varchar column or of one tagged with ``max_len``; None when not declared."""
    if "max_len" in field.metadata:
        return int(field.metadata["max_len"])
    if isinstance(field.dataType, (T.CharType, T.VarcharType)):
        return field.dataType.length
    declared = re.search(r"\((\d+)\)", field.metadata.get("__CHAR_VARCHAR_TYPE_STRING", ""))
    return int(declared[1]) if declared else None


def escape_identifier(name: str) -> str:
    return "[" + name.replace("]", "]]") + "]"


def profile_map(df: DataFrame) -> DataFrame:
    """One row per column: position, name, source_type, max_len, target_type, stored_as.

    Text without a declared size is measured; one aggregate pass reads all such columns and no
    others. Nested columns become JSON text of unlimited size.
    """
    measured = [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and declared_length(f) is None
    ]
    if measured:
        sizes = df.agg(F.struct(*[F.max(F.length(_name(c))).alias(f"_{i}") for i, c in enumerate(measured)]).alias("_m"))
    else:
        sizes = df.sparkSession.range(1).select(F.lit(None).alias("_m"))
    entries = []
    for position, field in enumerate(df.schema.fields, 1):
        target = TARGET_OF.get(type(field.dataType))
        if field.name in measured:
            length = F.coalesce(F.col("_m")[f"_{measured.index(field.name)}"], F.lit(0))
        elif target is None:
            limit = -1 if isinstance(field.dataType, _NESTED) else declared_length(field) or TEXT_LIMIT
            length = F.lit(limit)
        else:
            length = F.lit(None)
        text_type = F.when((length <= 0) | (length > TEXT_LIMIT), "MEMO").otherwise("TEXT(255)")
        entries.append(F.struct(
            F.lit(position).alias("position"),
            F.lit(field.name).alias("name"),
            F.lit(field.dataType.simpleString()).alias("source_type"),
            length.cast("int").alias("max_len"),
            (F.lit(target) if target else text_type).alias("target_type"),
        ))
    rows = sizes.select(F.inline(F.array(*entries)))
    stored = F.create_map(*[F.lit(x) for pair in STORED_AS.items() for x in pair])
    return rows.withColumn("stored_as", stored[F.col("target_type")])


def target_ddl(df: DataFrame, table: str) -> DataFrame:
    """Column list of the target table as rows, identifiers escaped, in source order."""
    quoted = F.concat(F.lit("["), F.replace(F.col("name"), F.lit("]"), F.lit("]]")), F.lit("]"))
    return profile_map(df).select(
        F.lit(escape_identifier(table)).alias("table_name"),
        "position",
        F.concat_ws(" ", quoted, "target_type").alias("column_ddl"),
    )


def apply_profile(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every column in its target type; what does not fit becomes NULL. ``keep`` passes unchanged.

    Run ``quarantine`` first when rows that do not fit are to be set aside instead.
    """
    columns = []
    for field in df.schema.fields:
        target = TARGET_OF.get(type(field.dataType))
        if field.name in keep:
            value = _name(field.name)
        elif target is None:
            value = to_text(_name(field.name), field.dataType)
        else:
            value = _name(field.name).try_cast(STORED_AS[target])
        columns.append(value.alias(field.name))
    return df.select(*columns)


def coerce_text(df: DataFrame, targets: dict[str, str]) -> DataFrame:
    """Read text columns as the target types given for them."""
    return df.withColumns({
        name: FROM_TEXT[target](_name(name)).cast(STORED_AS[target]) for name, target in targets.items()
    })


def profile_rules(df: DataFrame, limits: dict[str, str] | None = None) -> dict[str, Column]:
    """Reject rules that follow from the target types, by reject code ``rule:column``.

    64-bit integers must fit the 32-bit target. ``limits`` gives text columns a target
    (``SHORT``, ``LONG`` or ``TEXT(255)``) whose range their values must fit.
    """
    rules = {}
    for field in df.schema.fields:
        col = _name(field.name)
        target = (limits or {}).get(field.name)
        if isinstance(field.dataType, T.LongType):
            rules[f"int32_overflow:{field.name}"] = ~col.between(-(2**31), 2**31 - 1)
        elif target in ("SHORT", "LONG"):
            bits = 15 if target == "SHORT" else 31
            number = FROM_TEXT[target](col)
            rules[f"int{bits + 1}_overflow:{field.name}"] = ~number.between(-(2**bits), 2**bits - 1)
        elif target == "TEXT(255)":
            rules[f"text_overflow:{field.name}"] = F.length(col) > TEXT_LIMIT
    return rules


def quarantine(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with ``reject_reasons``, the codes of the rules they break.

    Rules look at raw values, before any narrowing cast; an unknown (NULL) verdict breaks nothing.
    The two are disjoint and together hold every row. Range rules reach the scan as filters, so
    looking for bad rows skips the row groups that can hold none.
    """
    broken = reduce(or_, rules.values(), F.lit(False))
    reasons = F.array_compact(F.array(*[F.when(rule, F.lit(code)) for code, rule in rules.items()]))
    good = df.filter(~F.coalesce(broken, F.lit(False)))
    bad = df.filter(broken).withColumn("reject_reasons", reasons.cast("array<string>"))
    return good, bad


def pad_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types; those the rows lack are NULL."""
    have = set(df.columns)
    return df.select(*[
        (_name(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])
