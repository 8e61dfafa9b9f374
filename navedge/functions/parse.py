"""Message parsing and encoding as column expressions (no Python per row).

Three readings of a message ``value`` (bytes or text):

* permissive: split on the separator, take four positional fields (missing
  ones are null), strip ``[word]:`` markup, count via ``try_cast`` (bad text
  gives null, not an error);
* strict: keep a message only if it has exactly four fields once trailing
  separators are dropped and the count is a plain signed integer that fits a
  long; otherwise drop it;
* JSON: ``from_json`` with the declared schema, struct expanded.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navedge import schema as S


def _sep_regex(sep: str) -> str:
    return re.escape(sep)


def as_text(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("string")


def strip_markup(col: Column | str, pattern: str = S.MARKUP_PATTERN) -> Column:
    """Remove every ``[word]:`` marker, wherever it occurs in the field."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, pattern, "")


# Escaped wire form: separated text that keeps null, empty text, and any separator or line end in a field.
# The marks of null and of empty text, and the escapes.
NULL_MARK, EMPTY_MARK = "\\N", "\\E"
ESCAPES = (("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"))


def escape_field(col: Column | str) -> Column:
    """A field for separated text: ``\\N`` for null, ``\\E`` for empty text, backslash escapes inside."""
    c = as_text(col)
    out = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for char, escape in ESCAPES:
        out = F.replace(out, F.lit(char), F.lit(escape))
    return F.when(c.isNull(), NULL_MARK).when(c == "", EMPTY_MARK).otherwise(out)


def unescape_field(col: Column | str) -> Column:
    """The field that ``escape_field`` wrote."""
    c = as_text(col)

    def plain(part):
        for char, escape in ESCAPES:
            part = F.replace(part, F.lit(escape), F.lit(char))
        return part

    # Cut at escaped backslashes first, so that what follows one is not read as an escape.
    out = F.array_join(F.transform(F.split(c, r"\\\\", -1), plain), "\\")
    return F.when(c == NULL_MARK, F.lit(None).cast("string")).when(c == EMPTY_MARK, "").otherwise(out)


def split_fields(col: Column | str, sep: str = "\t") -> Column:
    return F.split(as_text(col), _sep_regex(sep), -1)


def fields_to_edge(arr: Column, strip: bool = True, escaped: bool = False) -> list[Column]:
    """Four positional fields of an array as ``prev, curr, type, n``."""
    out = []
    for i, name in enumerate(S.EDGE_COLUMNS):
        f = F.get(arr, i)  # null past the end, where ``arr[i]`` fails under ANSI
        if strip:
            f = strip_markup(f)
        if escaped:
            f = unescape_field(f)
        if name == S.N:
            f = f.try_cast("bigint")
        out.append(f.alias(name))
    return out


def parse_permissive(df: DataFrame, column: str = "value", sep: str = "\t",
                     strip: bool = True, escaped: bool = False) -> DataFrame:
    """``escaped``: the fields were written by ``escape_field``."""
    arr = split_fields(column, sep)
    return df.select(*fields_to_edge(arr, strip, escaped))


_STRICT_COUNT = r"\A[+-]?[0-9]+\z"  # ``$`` would let a line feed pass


def parse_strict(df: DataFrame, column: str = "value", sep: str = "\t", escaped: bool = False) -> DataFrame:
    """``escaped``: the fields were written by ``escape_field``; a null count is then a value, not bad text."""
    text = F.regexp_replace(as_text(column), f"(?:{_sep_regex(sep)})+$", "")
    parts = df.select(F.split(text, _sep_regex(sep), -1).alias("_f"))
    n_text = F.get(F.col("_f"), 3)
    n = n_text.try_cast("bigint")
    good = n_text.rlike(_STRICT_COUNT) & n.isNotNull()
    if escaped:
        good = good | (n_text == NULL_MARK)
    key = unescape_field if escaped else (lambda c: c)
    return (parts
            .where((F.size("_f") == 4) & good)
            .select(*[key(F.get(F.col("_f"), i)).alias(c) for i, c in enumerate(S.KEY_COLUMNS)],
                    n.alias(S.N)))


def parse_json(df: DataFrame, column: str = "value", strict: bool = False) -> DataFrame:
    data = F.from_json(as_text(column), S.JSON_MESSAGE_SCHEMA).alias("data")
    flat = df.select(data).select("data.*").withColumnRenamed("link", S.TYPE)
    if strict:
        all_null = F.col(S.PREV).isNull()
        for c in S.EDGE_COLUMNS[1:]:
            all_null = all_null & F.col(c).isNull()
        flat = flat.where(~all_null)
    return flat


def canonical_edges(df: DataFrame) -> DataFrame:
    """Accept ``link`` as the name of the third column."""
    if S.TYPE not in df.columns and "link" in df.columns:
        df = df.withColumnRenamed("link", S.TYPE)
    return df.select(*S.EDGE_COLUMNS)


def encode_message(df: DataFrame, sep: str = ":") -> DataFrame:
    """One ``prev:curr:type:n`` text per row; a null field prints as ``null``."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in S.EDGE_COLUMNS]
    return df.select(F.concat_ws(sep, *parts).alias("value"))


def tab_message(df: DataFrame, sep: str = "\t", escaped: bool = False) -> DataFrame:
    """Edge rows as separated text. Plain: null fields become empty, as the original's producers write
    them. ``escaped``: every value comes back as it was."""
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    parts = [escape_field(c) if escaped else plain(c) for c in S.EDGE_COLUMNS]
    return df.select(F.concat_ws(sep, *parts).alias("value"))


def json_message(df: DataFrame) -> DataFrame:
    """Edge rows as JSON text with the link kind under ``link``."""
    s = F.struct(F.col(S.PREV), F.col(S.CURR), F.col(S.TYPE).alias("link"), F.col(S.N))
    return df.select(F.to_json(s, {"ignoreNullFields": "false"}).alias("value"))


def parse_avro(df: DataFrame, reader_schema_json: str, column: str = "value") -> DataFrame:
    """Avro-encoded messages to edge rows, with the reader schema given as JSON.

    Needs the spark-avro package on the classpath (``--packages
    org.apache.spark:spark-avro_2.13:<version>``); a schema-registry client is
    not part of this library, so the caller fetches the schema.
    """
    try:
        from pyspark.sql.avro.functions import from_avro
        data = from_avro(F.col(column), reader_schema_json).alias("data")
        flat = df.select(data).select("data.*")
    except Exception as e:  # the JVM side is missing
        raise RuntimeError("Avro parsing needs the spark-avro package on the classpath") from e
    return canonical_edges(flat)
