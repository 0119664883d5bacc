"""CSV in and out as spreadsheets and mail tools expect it.

Written: '\\n' line ends, quotes only where needed and doubled inside, null as empty, blanks kept, and no cell that a
spreadsheet would run as a formula. Read: quotes, doubled quotes, line breaks in cells, a byte-order mark; every column
is text, missing cells are '', rows of one cell only are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pagelode.functions.text import as_col


SHORT = "__short_row"


def guarded(c: Column | str) -> Column:
    """A cell that begins with = + @ tab or return gets an apostrophe before it; a minus does not."""
    t = F.coalesce(as_col(c).cast("string"), F.lit(""))
    return F.when(t.rlike("^[=+@\\t\\r]"), F.concat(F.lit("'"), t)).otherwise(t)


def joined(c: Column | str, by: str) -> Column:
    """An array as one cell."""
    return F.array_join(F.coalesce(as_col(c), F.array().cast("array<string>")), by)


def to_csv_lines(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """line: each row as the writer writes it; columns of keep go along as they are."""
    cell = lambda c: F.when(guarded(c).rlike("[\",\\n\\r]"), F.concat(F.lit('"'), F.replace(guarded(c), F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(guarded(c))
    return df.select(*keep, F.concat_ws(",", *[cell(c) for c in columns]).alias("line"))


def header_line(columns: Sequence[str]) -> str:
    quote = lambda s: '"' + s.replace('"', '""') + '"' if any(x in s for x in '",\n\r') else s
    return ",".join(quote("'" + c if c[:1] in "=+@\t\r" and c else c) for c in columns)


def write_csv(df: DataFrame, path: str, columns: Sequence[str], titles: Sequence[str] | None = None) -> None:
    """Part files under path, each with the header; the executors write them side by side."""
    named = df.select(*[guarded(c).alias(t) for c, t in zip(columns, titles or columns, strict=True)])
    named.write.mode("overwrite").options(
        header=True, escape='"', emptyValue="", nullValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, lineSep="\n"
    ).csv(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    options = {"header": True, "multiLine": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "enforceSchema": True}
    names = spark.read.options(**options).csv(path).columns
    schema = StructType([StructField(c, StringType()) for c in [*names, SHORT]])
    df = spark.read.options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord=SHORT).schema(schema).csv(path)
    if len(names) > 1:
        # a short row keeps its text aside; with nothing but a first cell it is no row
        empty = reduce(lambda x, y: x & y, [F.col(f"`{c}`").isNull() for c in names[1:]])
        df = df.filter(~(empty & F.col(SHORT).isNotNull()))
    return df.drop(SHORT).na.fill("")
