"""JSON sources."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_json_lines(spark: SparkSession, path: str, schema: StructType | str | None = None,
                    on_error: str | None = None) -> DataFrame:
    """S3: JSON lines; the schema is inferred with a scan unless given.  ``on_error`` (D2) is 'fail', 'drop' or
    'null' for lines that are no object of the schema; without it Spark's own reader decides.  Blank lines
    are no records.  ``rejected_json_lines`` gives what was dropped."""
    if on_error is None:
        reader = spark.read
        if schema is not None:
            reader = reader.schema(schema)
        return reader.json(path)
    return parse_json_strings(_json_lines(spark, path), "value", schema, on_error=on_error)


def rejected_json_lines(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """``(value)``: the lines that ``read_json_lines(..., on_error='drop')`` leaves out."""
    return rejected_json(_json_lines(spark, path), "value", schema)


def _json_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where(F.trim("value") != "")


def _variant_schema_to_ddl(text: str) -> str:
    """The variant schema as Spark's JSON reader names it: objects are structs, numbers with decimals doubles,
    longer whole numbers than 64 bits hold doubles too, and what is only ever null a string."""
    text = re.sub(r"\bOBJECT<", "STRUCT<", text)
    text = re.sub(r"\bDECIMAL\((\d+),\s*(\d+)\)", lambda m: "BIGINT" if m[2] == "0" and int(m[1]) <= 18 else "DOUBLE", text)
    return re.sub(r"\bVOID\b", "STRING", text)


def _is_object(line: Column) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_parse_json(line)).startswith("OBJECT"), F.lit(False))


def infer_json_schema(df: DataFrame, col: str) -> str:
    """Merged schema of all JSON objects in ``col``, computed as a distributed aggregate
    (one small row reaches the driver)."""
    row = df.where(_is_object(F.col(col))).select(F.schema_of_variant_agg(F.try_parse_json(F.col(col))).alias("s")).first()
    return _variant_schema_to_ddl(row.s) if row and row.s and row.s != "VOID" else "STRUCT<>"


def _parsed(df: DataFrame, col: str, schema: StructType | str | None) -> tuple[Column, Column, list[str]]:
    """The struct of a JSON string, whether the string is no object of the schema, and the struct's fields."""
    if schema is None:
        schema = infer_json_schema(df, col)
    if isinstance(schema, str):
        ddl = schema.strip()
        inner = ddl[ddl.index("<") + 1:-1] if ddl.upper().startswith("STRUCT<") else ddl
        schema = StructType.fromDDL(inner) if inner.strip() else StructType()
    corrupt = "_corrupt_record"
    while corrupt in schema.names:
        corrupt = "_" + corrupt
    whole = StructType([*schema.fields, StructField(corrupt, StringType())])
    parsed = F.from_json(F.col(col), whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    bad = ~_is_object(F.col(col)) | parsed.isNull() | parsed[corrupt].isNotNull()
    return parsed, bad, schema.names


def parse_json_strings(df: DataFrame, col: str, schema: StructType | str | None = None,
                       keep: list[str] | None = None, on_error: str = "null") -> DataFrame:
    """A DataFrame from a column of JSON strings, nested objects become structs.

    A record is bad when the string is null or no JSON object, or when a value does not fit the schema; a
    missing field is null.  ``on_error`` (D2): 'fail' fails the job on the first bad record, 'drop' keeps only
    good ones, 'null' keeps every record, bad ones with null in all fields."""
    if on_error not in ("fail", "drop", "null"):
        raise ValueError("on_error must be 'fail', 'drop' or 'null'")
    parsed, bad, names = _parsed(df, col, schema)
    df = df.select(*[F.col(c) for c in keep or []], F.col(col).alias("_line"), F.when(~bad, parsed).alias("_j"))
    good = F.col("_j").isNotNull()
    if on_error == "drop":
        df = df.where(good)
    elif on_error == "fail":
        # A filter is kept whatever columns are read later.
        wrong = F.raise_error(F.concat(F.lit("bad JSON record: "), F.coalesce("_line", F.lit("NULL")))).cast("boolean")
        df = df.where(F.when(good, F.lit(True)).otherwise(wrong))
    return df.select(*[F.col(c) for c in keep or []], *[F.col("_j").getField(n).alias(n) for n in names])


def rejected_json(df: DataFrame, col: str, schema: StructType | str | None = None, keep: list[str] | None = None) -> DataFrame:
    """The bad records of ``parse_json_strings``: ``keep`` and the string as it is."""
    _, bad, _ = _parsed(df, col, schema)
    return df.where(bad).select(*(keep or []), col)


def extract_fields(df: DataFrame, col: str, keys: list[str], on_error: str = "fail",
                   keep: list[str] | None = None) -> DataFrame:
    """P1 with the D2-D4 policy: the text of each named field of a JSON-object line.

    A record is bad when the line is not a JSON object or a field is missing (or JSON null).
    ``on_error='fail'`` (the reference's behaviour) fails the job on the first bad record,
    ``'drop'`` keeps only good records, ``'null'`` keeps every record with NULL fields.
    """
    if on_error not in ("fail", "drop", "null"):
        raise ValueError("on_error must be 'fail', 'drop' or 'null'")
    line = F.col(col)
    is_object = _is_object(line)
    values = {k: F.when(is_object, F.get_json_object(line, f"$.{k}")) for k in keys}
    ok = is_object
    for v in values.values():
        ok = ok & v.isNotNull()
    kept = [F.col(c) for c in (keep or [])]
    if on_error == "drop":
        return df.where(ok).select(*kept, *[v.alias(k) for k, v in values.items()])
    if on_error == "null":
        return df.select(*kept, *[v.alias(k) for k, v in values.items()])
    # A filter is kept whatever columns are read later.
    bad = F.raise_error(F.concat(F.lit("bad JSON record: "), F.coalesce(line, F.lit("NULL")))).cast("boolean")
    return (df.where(F.when(ok, F.lit(True)).otherwise(bad))
            .select(*kept, *[v.alias(k) for k, v in values.items()]))
