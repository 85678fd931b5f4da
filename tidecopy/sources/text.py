"""Tab-separated files in the bulk-load layout (S13): fields split by TAB,
rows by newline, ``\\N`` for NULL, and backslash escapes for TAB, newline,
carriage return, NUL and backslash inside a field. Read with ``read.text`` and
``split`` so an empty field stays an empty string."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The escape pairs of the bulk-load text layout.
ESCAPES = (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"), ("\x00", "\\0"))
NULL_TOKEN = "\\N"


def _escape(c: Column) -> Column:
    for raw, esc in ESCAPES:
        c = F.replace(c, F.lit(raw), F.lit(esc))
    return c


def _unescape(c: Column) -> Column:
    """Exact decoding: escape pairs are read left to right, so the text is
    split at every escaped backslash, the other escapes are decoded inside
    each piece, and the pieces are joined with a plain backslash."""
    def decode(piece: Column) -> Column:
        for raw, esc in ESCAPES[1:]:
            piece = F.replace(piece, F.lit(esc), F.lit(raw))
        return piece

    pieces = F.split(c, r"\\\\", -1)
    return F.array_join(F.transform(pieces, decode), "\\")


def _as_text(f: T.StructField) -> Column:
    c = F.col(f"`{f.name}`")
    if isinstance(f.dataType, T.TimestampNTZType) or isinstance(f.dataType, T.TimestampType):
        c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.when(c.isNull(), F.lit(NULL_TOKEN)).otherwise(_escape(c.cast("string")))


def write_tsv(df: DataFrame, path: str) -> None:
    """Write ``df`` as bulk-load text (one file per partition, no header)."""
    line = F.concat_ws("\t", *[_as_text(f) for f in df.schema.fields])
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def load_tsv(spark: SparkSession, path: str, schema: T.StructType | str, target: str | None = None) -> DataFrame:
    """Read bulk-load text into typed columns and, with ``target``, append them to
    that table (created if missing; the result is then the table). Every line is
    a row, an empty one the empty text of a one-column table; a line with the
    wrong number of fields fails the job rather than loading shifted values."""
    if isinstance(schema, str):
        schema = T.DataType.fromDDL(schema)
    n = len(schema.fields)
    parts = F.split(F.col("value"), "\t", -1)
    lines = spark.read.text(path)
    fields = []
    for i, f in enumerate(schema.fields):
        raw = F.element_at(parts, i + 1)
        val = F.when(raw == NULL_TOKEN, F.lit(None)).otherwise(_unescape(raw))
        fields.append(val.cast(f.dataType).alias(f.name))
    ok = F.when(F.size(parts) == n, F.lit(True)).otherwise(F.raise_error(F.concat(
        F.lit("bulk-load line with wrong field count: "), F.size(parts).cast("string"))))
    rows = lines.where(ok).select(*fields)
    if target is None:
        return rows
    from tidecopy.sources.target import append_target, ensure_table, quoted

    ensure_table(spark, target, schema)
    append_target(rows, target)
    return spark.table(quoted(target))
