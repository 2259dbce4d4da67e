"""File sources: key lists and tables whose files differ in age."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from zoneferry.functions.columns import name

# Text that stands for a missing key, so that an empty key stays apart from it.
NULL_KEY = "\\N"

# Shared by the reader and the writer of key files, so that quotes, commas and
# blanks inside a key come back as they were.
KEY_CSV = {
    "header": True,
    "sep": ",",
    "escape": '"',
    "nullValue": NULL_KEY,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}

# A key is one line, so that files can be split; what would break a line, or be
# taken for such a mark, is written with a backslash.
MARKS = {"\\": "\\\\", "\n": "\\n", "\r": "\\r"}


def key_text(key: Column) -> Column:
    """A key as it is written to a CSV list."""
    text = key.cast("string")
    for plain, marked in MARKS.items():
        text = F.replace(text, F.lit(plain), F.lit(marked))
    return text


def key_value(text: Column) -> Column:
    """The key that ``key_text`` wrote. Other backslashes stand for themselves."""

    def breaks(part: Column) -> Column:
        for plain in "\n\r":
            part = F.replace(part, F.lit(MARKS[plain]), F.lit(plain))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\"), breaks), "\\")


def read_keys(
    spark: SparkSession, path: str, columns: Sequence[str], fmt: str = "parquet"
) -> DataFrame:
    """A list of changed keys, one row each.

    Parquet keys keep type and text exactly. CSV keys are text: the header line
    is skipped, blanks around a key are trimmed and marked line breaks undone.
    """
    if fmt == "parquet":
        return spark.read.parquet(path).select(*[name(c) for c in columns])
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = spark.read.schema(schema).options(**KEY_CSV).csv(path)
    return raw.select(*[key_value(F.trim(name(c))).alias(c) for c in columns])


def relax(schema: T.StructType) -> T.StructType:
    """The same schema with every primitive field nullable.

    Goes into nested records and into arrays of records; the record and array
    fields themselves keep their nullability.
    """
    return T.StructType([_relax_field(f) for f in schema.fields])


def _relax_field(field: T.StructField) -> T.StructField:
    kind = field.dataType
    if isinstance(kind, T.StructType):
        return T.StructField(field.name, relax(kind), field.nullable, field.metadata)
    if isinstance(kind, T.ArrayType):
        element = kind.elementType
        if isinstance(element, T.StructType):
            element = relax(element)
        array = T.ArrayType(element, kind.containsNull)
        return T.StructField(field.name, array, field.nullable, field.metadata)
    if isinstance(kind, T.MapType):
        return field
    return T.StructField(field.name, kind, True, field.metadata)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bring ``df`` to ``schema`` by column name; absent nullable fields are null.

    Plain values are cast, text to numbers included; in ANSI mode, the default,
    a value that does not fit is an error.
    """
    kinds = {f.name.lower(): f.dataType for f in schema.fields}
    casts = {}
    for have in df.schema.fields:
        want = kinds.get(have.name.lower(), have.dataType)
        if have.dataType != want and _plain(have.dataType) and _plain(want):
            casts[have.name] = name(have.name).cast(want)
    return df.withColumns(casts).to(schema) if casts else df.to(schema)


def _plain(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.StructType, T.ArrayType, T.MapType))


def read_conformed(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """Read files of different ages as one table of the relaxed schema."""
    return spark.read.schema(relax(schema)).format(fmt).load(list(paths))
