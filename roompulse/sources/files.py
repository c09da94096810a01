"""File inputs: CSV, text lines and JSON lines, batch and streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, header: bool = True
) -> DataFrame:
    """CSV with a header row. Without a schema the types are inferred, at the price of one more scan.

    With a schema, columns are found by their header names, in whatever order the file has them; other
    columns are left out, and a missing one fails. A file whose header differs from the first one's fails too.
    """
    reader = spark.read.option("header", header).option("escape", '"')
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    if not header:
        return reader.schema(schema).csv(path)
    names = reader.csv(path).columns
    missing = [name for name in schema.fieldNames() if name not in names]
    if missing:
        raise ValueError(f"{path} has no columns {missing}")
    types = {field.name: field for field in schema}
    in_file = T.StructType([types.get(name, T.StructField(name, T.StringType(), True)) for name in names])
    rows = reader.option("enforceSchema", False).schema(in_file).csv(path)
    return rows.select(*schema.fieldNames())


# A writer's folders per batch are no columns of the rows.
_APPENDED = {"header": "false", "escape": '"', "recursiveFileLookup": "true"}


def read_appended_csv(
    spark: SparkSession, path: str, schema: T.StructType, text: str | None = None
) -> DataFrame:
    """CSV that writers appended to, so header rows may stand anywhere in a file.

    The first line's names give the order of the columns; without names there it is the schema's. Rows are
    read as text, the header rows are filtered out, and each column is cast with ``try_cast``: a bad value
    nulls its own column and never drops a row. Whole numbers may be written as decimals. A later header
    row with another order fails. ``text`` names a column for the fields as they were read; a line with more or fewer
    fields than columns is there as it came, whole.
    """
    names = _first_names(spark, path, schema)
    whole = [] if text is None else ["_whole_line"]
    text_schema = T.StructType([T.StructField(name, T.StringType(), True) for name in [*names, *whole]])
    rows = spark.read.schema(text_schema).options(**_APPENDED, columnNameOfCorruptRecord="_whole_line").csv(path)
    is_header = F.lit(True)
    for name in names:
        is_header = is_header & F.col(name).eqNullSafe(name)
    permuted = F.array_sort(F.array(*names)) == F.array(*[F.lit(name) for name in sorted(names)])
    checked = F.when(permuted, F.raise_error(F.lit(f"a header row of {path} has another order of columns")).cast("boolean"))
    rows = rows.filter(~is_header).filter(F.coalesce(checked, F.lit(True)))
    typed = [_typed(field).alias(field.name) for field in schema]
    if text is not None:
        joined = F.concat_ws(",", *[F.coalesce(name, F.lit("")) for name in names])
        typed.append(F.coalesce("_whole_line", joined).alias(text))
    return rows.select(*typed)


def _first_names(spark: SparkSession, path: str, schema: T.StructType) -> list[str]:
    """The columns in the order of the file's first line, if that is a header row."""
    first = spark.read.options(**_APPENDED).csv(path).first()
    found = [str(name).strip() for name in first] if first is not None else []
    names = schema.fieldNames()
    return found if set(names) <= set(found) and len(set(found)) == len(found) else names


def _typed(field: T.StructField) -> Column:
    value = F.trim(F.col(field.name))
    if not isinstance(field.dataType, T.IntegralType):
        return value.try_cast(field.dataType)
    number = value.try_cast("double")
    return F.coalesce(value.try_cast(field.dataType), F.when(number == F.floor(number), number).try_cast(field.dataType))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines as the column ``value``."""
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """New text files below ``path`` as a stream of lines in the column ``value``."""
    return spark.readStream.options(**options).text(path)


def stream_table(
    spark: SparkSession, root: str, name: str, schema: T.StructType, **options: str
) -> DataFrame:
    """Stream the parquet table ``root/name.parquet``, be it one file or a folder of part files.

    The file source only takes a folder or a glob, so the name is written as a glob.
    """
    glob = f"{root}/[{name[0]}]{name[1:]}.parquet"
    return spark.readStream.schema(schema).options(**options).parquet(glob)


def two_field_rows(lines: DataFrame, first: str, second: str, value: str = "value") -> DataFrame:
    """Headerless comma-separated lines; only lines with exactly two fields are kept.

    The CSV parser reports a line with any other number of fields (quoted commas do not count) in
    its corrupt-record column.
    """
    fields = F.from_csv(
        F.col(value),
        "a string, b string, bad string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad", "escape": '"'},
    )
    return (
        lines.filter(F.col(value) != "")
        .select(fields.alias("f"))
        .filter(F.col("f.bad").isNull())
        .select(
            F.coalesce("f.a", F.lit("")).alias(first), F.coalesce("f.b", F.lit("")).alias(second)
        )
    )
