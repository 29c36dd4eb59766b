"""Landings whose records differ in their fields (S2, S3, U2): read without a schema, merged by the data.

Every record is read as a VARIANT, so no field is lost before anyone has looked. The distinct shapes of
the records, counted by one aggregation, give a report of all fields and a merged type for each. With
it the records become bars with a column for each further field; what does not fit its column is kept
as text in ``rescued``. Merging copies moves the records as they are.

Field names are matched without regard to case, as Spark's columns are. Numbers of several kinds
merge to ``double``; other mixtures are conflicts and merge to ``string`` (numbers and booleans as
their JSON text). Objects and arrays become their JSON text.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barframe.functions.expressions import ticker_from_path, to_bar_date
from barframe.schema import VALUE_COLUMNS
from barframe.sources.readers import copy_from_path

#: A landing with more different field names has data in its names; the merged schema would not be a table.
MAX_FIELDS = 10_000
_KINDS = {"BIGINT": "bigint", "DOUBLE": "double", "FLOAT": "double", "STRING": "string", "BOOLEAN": "boolean", "VOID": "null"}


def variant_records(spark: SparkSession, path: str | list[str], *, multiline: bool = False) -> DataFrame:
    """``source, record``: every landed record as a VARIANT object.

    ``multiline=True`` reads files that hold a JSON array of records (a whole file per task). Text
    that is no JSON, and records that are no objects, are left out: ``file_report`` counts them.
    """
    raw = spark.read.option("singleVariantColumn", "record").option("multiLine", multiline).option("recursiveFileLookup", True).json(path)
    raw = raw.select(F.col("_metadata.file_path").alias("source"), "record").where(F.col("record").isNotNull())
    if multiline:
        array = F.schema_of_variant("record").startswith("ARRAY")
        elements = raw.where(array).lateralJoin(spark.tvf.variant_explode(F.col("record").outer()))
        raw = raw.where(~array).unionByName(elements.select("source", F.col("value").alias("record")))
    return raw.where(F.schema_of_variant("record").startswith("OBJECT"))


def _fields(record: str = "record") -> Column:
    return F.variant_get(F.col(record), "$", "map<string,variant>")


def _kind(value: Column) -> Column:
    shape = F.schema_of_variant(value)
    out = F.when(shape.startswith("DECIMAL"), "double").when(shape.startswith("OBJECT"), "object").when(shape.startswith("ARRAY"), "array")
    for name, kind in _KINDS.items():
        out = out.when(shape == name, kind)
    return out.otherwise("string")


def field_report(records: DataFrame) -> DataFrame:
    """A row for each field of the records (``record`` VARIANT), however few have it.

    ``field`` (lower case), ``names`` (its spellings), ``n_records`` with the field, ``n_null`` of them with
    a JSON null, ``kinds`` (``array, bigint, boolean, double, object, string``), ``merged`` (its type in
    the merged table) and ``conflict`` (whether kinds other than numbers are mixed). The records are
    counted by shape (their fields and kinds) first, so only the different shapes are taken apart.
    """
    shape = F.to_json(F.transform_values(_fields(), lambda _name, value: _kind(value)))
    shapes = records.groupBy(shape.alias("shape")).agg(F.count(F.lit(1)).alias("n"))
    parts = shapes.select("n", F.explode(F.from_json("shape", "map<string,string>")).alias("name", "kind"))
    by_kind = parts.groupBy(F.lower("name").alias("field"), "kind").agg(
        F.sum("n").alias("n"), F.collect_set("name").alias("names")
    )
    report = by_kind.groupBy("field").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("names")))).alias("names"), F.sum("n").alias("n_records"),
        F.sum(F.when(F.col("kind") == "null", F.col("n")).otherwise(0)).alias("n_null"),
        F.array_sort(F.collect_set(F.when(F.col("kind") != "null", F.col("kind")))).alias("kinds"),
    )
    numbers = F.array_except("kinds", F.array(F.lit("bigint"), F.lit("double")))
    conflict = (F.size("kinds") > 1) & (F.size(numbers) > 0)
    merged = (
        F.when(F.size("kinds") == 0, "string").when(conflict, "string").when(F.size("kinds") > 1, "double")
        .when(F.get("kinds", F.lit(0)).isin("object", "array"), "string").otherwise(F.get("kinds", F.lit(0)))
    )
    return report.select("field", "names", "n_records", "n_null", "kinds", merged.alias("merged"), conflict.alias("conflict"))


@dataclass(frozen=True)
class Field:
    """A column of the merged table: its name in lower case, its type, and its spellings in the records."""

    name: str
    type: str
    names: tuple[str, ...]


def merged_fields(records: DataFrame) -> list[Field]:
    """The merged schema: all fields of the records, in the order of their names."""
    rows = field_report(records).select("field", "merged", "names").limit(MAX_FIELDS + 1).collect()
    if len(rows) > MAX_FIELDS:
        raise ValueError(f"more than {MAX_FIELDS} different fields")
    return sorted((Field(r["field"], r["merged"], tuple(r["names"])) for r in rows), key=lambda f: f.name)


def merged_bars(records: DataFrame, fields: Sequence[Field] | None = None) -> DataFrame:
    """Records as bars: ``ticker, copy_id, date, open, high, low, close, volume, source``, a column for
    each further field, and ``rescued``.

    ``fields`` is a merged schema (default: that of these records; a job over several landings can
    keep an earlier one). ``rescued`` is JSON of the fields without a column and of the values that do
    not fit theirs, NULL if there are none. Of two spellings in one record the first in code-point
    order has the column. Ticker and copy come from the record, else from the path; the copy else is 0.
    """
    own = {"date": "string", **{c: "double" for c in VALUE_COLUMNS}, "ticker": "string", "copy_id": "int"}
    fields = merged_fields(records) if fields is None else list(fields)
    if clashing := [f.name for f in fields if f.name in ("source", "rescued")]:
        raise ValueError(f"fields named like result columns: {clashing}")
    spelled = {f.name: f.names for f in fields}
    types = {f.name: f.type for f in fields} | {c: t for c, t in own.items() if c in spelled}
    read: dict[str, Column] = {}
    misfits = []
    for name, kind in types.items():
        held = [F.element_at("_all", F.lit(n)) for n in spelled[name]]
        value = F.coalesce(*held)
        read[name] = F.try_variant_get(value, "$", kind)
        if name == "date":
            read[name] = to_bar_date(read[name])
        for i, (n, v) in enumerate(zip(spelled[name], held)):
            later = F.lit(False)
            for earlier in held[:i]:
                later = later | earlier.isNotNull()
            lost = v.isNotNull() & ~F.coalesce(F.is_variant_null(v), F.lit(False)) & (read[name].isNull() | later)
            misfits.append(F.when(lost, F.lit(n)))
    known = F.array(*[F.lit(n) for f in fields for n in f.names]) if fields else F.array().cast("array<string>")
    misfit = F.array_compact(F.array(*misfits)) if misfits else F.array().cast("array<string>")
    rows = records.withColumn("_all", _fields()).withColumn("_misfit", misfit)
    rest = F.map_filter("_all", lambda k, v: ~F.array_contains(known, k) | F.array_contains(F.col("_misfit"), k))
    source = F.col("source")
    first = lambda c, *others: F.coalesce(*([read[c]] if c in read else []), *others)
    empty = lambda c: F.lit(None).cast("date" if c == "date" else "double")
    extras = [read[f.name].alias(f.name) for f in fields if f.name not in own]
    return rows.select(
        first("ticker", ticker_from_path(source)).alias("ticker"), first("copy_id", copy_from_path(source), F.lit(0)).alias("copy_id"),
        *[first(c, empty(c)).alias(c) for c in ("date", *VALUE_COLUMNS)], source, *extras,
        F.when(F.size(rest) > 0, F.to_json(rest)).alias("rescued"),
    )


def merge_landings(spark: SparkSession, path: str | list[str], out: str, *, multiline: bool = False, mode: str = "errorifexists") -> None:
    """All copies below ``path`` as one line-JSON landing in a folder for each ticker, with every field of every record.

    The records are written as they are; one that does not carry its copy number gets it from its path.
    """
    records = variant_records(spark, path, multiline=multiline)
    all_fields = _fields()
    has = lambda c: F.exists(F.map_keys(all_fields), lambda k: F.lower(k) == c)
    named = lambda c, kind: F.try_variant_get(F.element_at(all_fields, F.filter(F.map_keys(all_fields), lambda k: F.lower(k) == c)[0]), "$", kind)
    text = F.to_json("record")
    copy = F.coalesce(copy_from_path(F.col("source")), F.lit(0)).cast("string")
    with_copy = F.concat(F.lit('{"copy_id":'), copy, F.when(text == "{}", F.lit("")).otherwise(F.lit(",")), F.substring(text, 2, 2**31 - 1))
    lines = records.select(
        F.coalesce(F.when(has("ticker"), named("ticker", "string")), ticker_from_path(F.col("source"))).alias("ticker"),
        F.when(has("copy_id"), text).otherwise(with_copy).alias("value"),
    )
    lines.hint("rebalance", "ticker").write.mode(mode).partitionBy("ticker").text(out)
