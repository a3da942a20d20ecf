"""Column and table profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lakemart.functions import literal, parsed_number
from lakemart.session import work_path

INTEGER_TEXT = r"^\s*[+-]?\d+\s*$"
# The words a type-inferring CSV reader takes for booleans.
TRUE_WORDS = ("True", "TRUE", "true")
FALSE_WORDS = ("False", "FALSE", "false")
SAMPLES = 3


def infer_types(df: DataFrame) -> DataFrame:
    """Text columns cast to integer, double or boolean where every value allows it.

    One pass over the text decides all columns; the answer is one row.
    """
    words = ", ".join(map(literal, (*TRUE_WORDS, *FALSE_WORDS)))
    tests: list[str] = []
    for i, c in enumerate(df.columns):
        number = f"if(`{c}` is null, null, {parsed_number.sql(f'`{c}`')} is not null)"
        tests += [
            f"coalesce(bool_and(`{c}` rlike r'{INTEGER_TEXT}'), false) as w{i}",
            f"coalesce(bool_and(if(`{c}` is null, null, try_cast(trim(`{c}`) as bigint) is not null)), false) as i{i}",
            f"coalesce(bool_and({number}), true) as d{i}",
            f"coalesce(bool_and(`{c}` in ({words})), false) as b{i}",
        ]
    facts = df.selectExpr(*tests).first()
    typed = []
    for i, c in enumerate(df.columns):
        kind = "string"
        if facts[f"w{i}"]:
            # Whole numbers that 64 bits do not hold stay text: doubles would make some equal.
            kind = "bigint" if facts[f"i{i}"] else "string"
        elif facts[f"d{i}"]:
            kind = "double"
        elif facts[f"b{i}"]:
            kind = "boolean"
        typed.append(f"cast(trim(`{c}`) as {kind}) as `{c}`" if kind != "string" else f"`{c}`")
    return df.selectExpr(*typed)


def _type_name(data_type: T.DataType) -> str:
    """``int64``, ``float64``, ``bool`` or ``object``, as a data-frame profiler names them."""
    if isinstance(data_type, T.IntegralType):
        return "int64"
    if isinstance(data_type, T.FractionalType):
        return "float64"
    return "bool" if isinstance(data_type, T.BooleanType) else "object"


def _canonical(f: T.StructField) -> str:
    """Text of a value under which equal values are equal (-0.0 is 0.0)."""
    zero = " + 0.0d" if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else ""
    return f"cast(`{f.name}`{zero} as string)"


def column_values(df: DataFrame) -> DataFrame:
    """(column position, value text, n): one scan and one exchange for all columns.

    Values are counted per task first, so a value that fills a third of a column, or a column
    of few values, travels as a handful of rows.
    """
    fields = df.schema.fields
    cells = [f"struct({i} as position, {_canonical(f)} as value)" for i, f in enumerate(fields)]
    return (
        df.selectExpr(f"inline(array({', '.join(cells)}))")
        .groupBy("position", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def profile_columns(df: DataFrame) -> DataFrame:
    """Per column: inferred type, null count and percent, exact number of distinct values."""
    names = F.array(*[F.lit(c) for c in df.columns])
    nulls = F.sum(F.when(F.col("value").isNull(), F.col("n")))
    per_column = column_values(df).groupBy("position").agg(
        F.sum("n").alias("rows"),
        F.coalesce(nulls, F.lit(0)).alias("null_count"),
        F.count("value").alias("distinct_count"),
    )
    plain = F.array(*[F.lit(_type_name(f.dataType)) for f in df.schema.fields])
    kind = plain[F.col("position")]
    # A column of integers or booleans with gaps is a float or an object column.
    with_gaps = F.when(kind == "int64", F.lit("float64")).when(kind == "bool", F.lit("object"))
    return per_column.select(
        names[F.col("position")].alias("column_name"),
        F.when(F.col("null_count") > 0, F.coalesce(with_gaps, kind))
        .otherwise(kind)
        .alias("inferred_type"),
        "null_count",
        F.round(F.col("null_count") * F.lit(100.0) / F.col("rows"), 4).alias("null_percent"),
        "distinct_count",
    )


def profile_table(df: DataFrame) -> DataFrame:
    """One row: row count, column count and later copies of equal rows.

    Rows are first grouped by a digest of 128 bits, so that 16 bytes of each travel; digests that
    occur twice are stored. Only rows with such a digest, if any, are then read again and compared
    in full, which keeps the count exact.
    """
    spark = df.sparkSession
    digest = {"_h1": F.xxhash64(*df.columns), "_h2": F.xxhash64(F.lit(1), *df.columns)}
    groups = df.select(*[value.alias(name) for name, value in digest.items()]).groupBy(*digest).agg(F.count(F.lit(1)).alias("n"))
    seen, path = Observation("rows"), work_path(spark, "shared-digests")
    groups.observe(seen, F.coalesce(F.sum("n"), F.lit(0)).alias("row_count")).filter("n > 1").select(*digest).write.parquet(path)
    shared = spark.read.schema("_h1 bigint, _h2 bigint").parquet(path)
    counted = [F.lit(seen.get["row_count"]).cast("bigint").alias("row_count"), F.lit(len(df.columns)).cast("bigint").alias("column_count")]
    if shared.isEmpty():
        return spark.range(1).select(*counted, F.lit(0).cast("bigint").alias("duplicate_rows"))
    suspects = df.withColumns(digest).join(shared, list(digest), "left_semi")
    copies = suspects.groupBy(*digest, *df.columns).agg(F.count(F.lit(1)).alias("n"))
    return copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows")).select(*counted, "duplicate_rows")


def first_values(df: DataFrame, columns: Sequence[str], n: int = SAMPLES) -> dict[str, list]:
    """First ``n`` non-null values per column in file order, for the report.

    ``take`` reads partitions from the front and stops at ``n`` values; callers leave out
    columns known to hold only nulls, which would be read to the end.
    """
    return {
        c: [row[0] for row in df.select(c).filter(F.col(c).isNotNull()).take(n)] for c in columns
    }


def sample_values(df: DataFrame, order: Sequence[str], n: int = SAMPLES) -> DataFrame:
    """Per column its ``n`` non-null values with the lowest ``order``, as rows, from one scan.

    Cells become rows of (column, order, value), ranked per column. The ranking's limit is applied
    in every task first, so that each task sends at most ``n`` rows for a column.
    """
    key = ", ".join(f"`{c}`" for c in order)
    cells = ", ".join(
        f"if(`{c}` is null, null, struct({i} as position, struct({key}) as k, cast(`{c}` as string) as v))" for i, c in enumerate(df.columns)
    )
    names = F.array(*[F.lit(c) for c in df.columns])
    ranked = df.selectExpr(f"inline(filter(array({cells}), x -> x is not null))").withColumn(
        "place", F.row_number().over(Window.partitionBy("position").orderBy("k", "v"))
    )
    return ranked.filter(F.col("place") <= n).select(names[F.col("position")].alias("column_name"), F.col("v").alias("sample_value"))
