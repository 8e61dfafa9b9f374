"""Edge tables from separated text files.

``read_tsv`` is the main batch source: declared schema, no header, quoting
off so titles are literal (a leading ``"`` would otherwise swallow the rest
of its line). Permissive: a bad count is null, a short row gets trailing
nulls, an extra field is ignored, a blank line is skipped.
``read_text_edges`` is the strict positional reading: a short row or a bad
number fails the job, whatever the session's ANSI mode and whichever columns
are read.

With ``escaped``, fields are written and read by ``escape_field``, so null,
empty text, blanks at the ends, quotes, backslashes, tabs and line ends come
back as they were. Without it the files are those of the original.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navedge import schema as S
from navedge.functions.parse import _STRICT_COUNT, NULL_MARK, _sep_regex, escape_field, unescape_field


# Quoted CSV that keeps null apart from empty text, and blanks at the ends. Same options to write and to read.
CSV_OPTIONS = {"header": "true", "nullValue": NULL_MARK, "emptyValue": "", "escape": '"',
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).options(**{**CSV_OPTIONS, "emptyValue": '""', "quoteAll": "false"}).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema=S.EDGE_SCHEMA) -> DataFrame:
    """What ``write_csv`` wrote. Line ends inside a field need ``multiLine``, set here; a file is then one task."""
    return spark.read.schema(schema).options(**CSV_OPTIONS).option("multiLine", "true").csv(path)


def write_csv_lines(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """CSV in which every row is one line: fields are written by ``escape_field``, so a file can be read in splits."""
    rows = df.select(*[escape_field(f.name).alias(f.name) if isinstance(f.dataType, T.StringType)
                       else F.coalesce(F.col(f.name).cast("string"), F.lit(NULL_MARK)).alias(f.name) for f in df.schema.fields])
    rows.write.mode(mode).options(header="true", escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path)
    return path


def read_csv_lines(spark: SparkSession, path: str | list[str], schema=S.EDGE_SCHEMA) -> DataFrame:
    """What ``write_csv_lines`` wrote."""
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    rows = spark.read.schema(texts).options(header="true", escape='"', nullValue="", ignoreLeadingWhiteSpace="false",
                                            ignoreTrailingWhiteSpace="false").csv(path)
    return rows.select(*[unescape_field(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_tsv(spark: SparkSession, path: str, sep: str = "\t", schema=S.EDGE_SCHEMA,
             corrupt_column: str | None = None, escaped: bool = False) -> DataFrame:
    reader = (spark.read.schema(schema)
              .option("sep", sep).option("header", "false")
              .option("quote", "").option("mode", "PERMISSIVE"))
    if corrupt_column:
        # a new schema: ``StructType.add`` would modify the shared one in place
        with_corrupt = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
        reader = reader.schema(with_corrupt).option("columnNameOfCorruptRecord", corrupt_column)
    if not escaped:
        return reader.csv(path)
    rows = reader.option("nullValue", "").option("ignoreLeadingWhiteSpace", "false").option(
        "ignoreTrailingWhiteSpace", "false").csv(path)
    texts = {f.name for f in schema.fields if isinstance(f.dataType, T.StringType)}
    return rows.select(*[unescape_field(c).alias(c) if c in texts else F.col(c) for c in rows.columns])


def read_tsv_inferred(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """Separated scan with an inferred schema (one extra pass over the input), quoting off; whole numbers are long."""
    rows = (spark.read.option("sep", sep).option("inferSchema", "true").option("header", "false")
            .option("quote", "").csv(path))
    return rows.select(*[F.col(f.name).cast("bigint") if isinstance(f.dataType, T.IntegerType) else F.col(f.name)
                         for f in rows.schema.fields])


HEADER = tuple(S.EDGE_COLUMNS)


def drop_header(df: DataFrame, header: tuple[str, ...] = HEADER) -> DataFrame:
    """Drop every row that is the header line read as data.

    Row order is not defined across partitions (and every part file may carry
    a header), so the header is matched by value, not taken as the first row.
    A typed scan reads the header's count column as null.
    """
    cond = None
    for name, text in zip(df.columns, header):
        field = df.schema[name].dataType.simpleString()
        c = F.col(name).isNull() if field != "string" else F.col(name).eqNullSafe(F.lit(text))
        cond = c if cond is None else (cond & c)
    return df.where(~cond)


def read_text_edges(spark: SparkSession, path: str, sep: str = "\t", escaped: bool = False) -> DataFrame:
    """Text lines split on ``sep``; positional typed record; bad rows fail."""
    arr = F.split(F.col("value"), _sep_regex(sep), -1)
    count = F.get(arr, 3)
    # A cast trims blanks; a strict count is digits alone.
    good = (F.size(arr) >= 4) & count.rlike(_STRICT_COUNT) & count.try_cast("bigint").isNotNull()
    if escaped:
        good = good | ((F.size(arr) >= 4) & (count == NULL_MARK))
    # A filter: unlike a column it is never pruned away.
    bad = F.raise_error(F.concat(F.lit("not an edge: "), F.col("value"))).cast("boolean")
    lines = spark.read.text(path).where(F.when(good, True).otherwise(bad))
    key = unescape_field if escaped else (lambda c: c)
    return lines.select(*[key(F.get(arr, i)).alias(c) for i, c in enumerate(S.KEY_COLUMNS)],
                        count.try_cast("bigint").alias(S.N))


def write_tsv(df: DataFrame, path: str, sep: str = "\t", header: bool = False,
              mode: str = "overwrite", escaped: bool = False) -> str:
    if escaped:
        df = df.select(*[escape_field(f.name).alias(f.name) if isinstance(f.dataType, T.StringType)
                         else F.coalesce(F.col(f.name).cast("string"), F.lit(NULL_MARK)).alias(f.name) for f in df.schema.fields])
    (df.write.mode(mode).option("sep", sep).option("header", str(header).lower()).option("quote", "")
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .option("emptyValue", "").csv(path))
    return path


def write_text(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.select("value").write.mode(mode).text(path)
    return path
