"""Strict decoding of a JSON array: one faulty element rejects the whole list.

``from_json`` on its own is lenient (it nulls a field of the wrong type,
accepts trailing text, turns a lone object into a one-element array and fills
missing fields with null). The span is wrapped as ``{"v": <span>}`` and parsed
with a corrupt-record column, which flags wrong types, truncation, trailing
text and lone objects; required fields and allowed values are then checked with
``forall``. JSON types are checked too (a number where text is required is a
fault, as in a typed decoder): the span is also parsed as a VARIANT and the
type of every field of every element is matched against ``types``. Faults
become a reason string; the job never fails (no FAILFAST).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType


# JSON type patterns (full match against ``schema_of_variant`` output; a
# missing field reads as MISSING, a JSON null as VOID).
STR = "STRING"
OPT_STR = "STRING|VOID|MISSING"
STR_LIST = "ARRAY<(STRING|VOID)>"
OPT_STR_LIST = "ARRAY<(STRING|VOID)>|MISSING"
OPT_UINT = "BIGINT|VOID|MISSING"


def _types_ok(span: Column, types: dict[str, str]) -> Column:
    arr = F.try_variant_get(F.try_parse_json(span), "$", "array<variant>")

    def elem(x: Column) -> Column:
        ok = F.lit(True)
        for name, pattern in types.items():
            t = F.coalesce(F.schema_of_variant(F.try_variant_get(x, f"$.{name}", "variant")), F.lit("MISSING"))
            ok = ok & t.rlike(f"^(?:{pattern})$")
        return ok
    return F.coalesce(F.forall(arr, elem), F.lit(False))


def strict_decode(df: DataFrame, span: str, element: StructType, required: Sequence[str],
                  check: Callable[[Column], Column] | None = None,
                  items: str = "items", reason: str = "reason",
                  types: dict[str, str] | None = None) -> DataFrame:
    """Add ``items`` (the decoded array) and ``reason`` (why it was rejected);
    ``items`` is null whenever ``reason`` is not. The span and the parsed value
    are separate columns, so each is computed once per row."""
    schema = StructType([StructField("v", ArrayType(element)), StructField("_c", StringType())])
    wrapped = F.concat(F.lit('{"v":'), F.col(span), F.lit("}"))
    d = df.withColumn("_parsed", F.from_json(wrapped, schema,
                                             {"columnNameOfCorruptRecord": "_c", "mode": "PERMISSIVE"}))

    def element_ok(x: Column) -> Column:
        ok = x.isNotNull()
        for name in required:
            ok = ok & x[name].isNotNull()
        if check is not None:
            ok = ok & F.coalesce(check(x), F.lit(False))
        return ok

    p = F.col("_parsed")
    why = (F.when(F.col(span).isNull(), F.lit("no json array"))
           .when(p["_c"].isNotNull(), F.lit("malformed json"))
           .when(p["v"].isNull(), F.lit("not an array"))
           .when(~F.forall(p["v"], element_ok), F.lit("missing or invalid field")))
    if types:
        why = why.when(~_types_ok(F.col(span), types), F.lit("wrong json type"))
    d = d.withColumn(reason, why)
    return d.withColumn(items, F.when(F.col(reason).isNull(), p["v"])).drop("_parsed")
