"""Data-quality operators: schema check, range report, quarantine and
duplicate counts. Each range check is one pass over the data, however
many rules there are."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.functions.rules import any_violation, rule_predicates, violated_rules

log = logging.getLogger(__name__)

SCHEMA_CHECK = StructType([StructField("field", StringType(), False), StructField("status", StringType(), False)])


def schema_diff(columns: Iterable[str], expected: Iterable[str]) -> tuple[list[str], list[str]]:
    """(missing, extra) field names, each sorted. Names only, no types."""
    actual, want = set(columns), set(expected)
    return sorted(want - actual), sorted(actual - want)


def validate_schema(df: DataFrame, expected: Iterable[str]) -> bool:
    """True when every expected field is present; extra fields only warn."""
    missing, extra = schema_diff(df.columns, expected)
    if missing:
        log.error("schema check failed: missing fields %s", missing)
    if extra:
        log.warning("schema check: unexpected fields %s", extra)
    return not missing


def schema_check(spark: SparkSession, df: DataFrame, expected: Iterable[str]) -> DataFrame:
    """``(field, status)`` rows ordered by field, status one of ``ok``,
    ``missing`` or ``extra``. Reads the schema only, never the data."""
    expected = list(expected)
    missing, extra = schema_diff(df.columns, expected)
    present = sorted(set(expected) & set(df.columns))
    rows = [(f, "ok") for f in present] + [(f, "missing") for f in missing] + [(f, "extra") for f in extra]
    return spark.createDataFrame(sorted(rows), SCHEMA_CHECK)


def quality_counts(df: DataFrame, rules: Mapping | None) -> list[Column]:
    """``count_if`` aggregate per applicable rule, named after the field;
    usable in ``agg`` or in ``observe`` on a stream."""
    return [F.count_if(F.coalesce(p, F.lit(False))).alias(name) for name, p in rule_predicates(rules, df.columns).items()]


def quality_report(df: DataFrame, rules: Mapping | None) -> DataFrame:
    """``(field, min, max, out_of_range)`` per applicable rule, from one
    aggregation pass (rules on absent fields are skipped)."""
    ranges = (rules or {}).get("numeric_ranges", {}) or {}
    present = [f for f in ranges if f in df.columns]
    schema = "field string, min double, max double, out_of_range long"
    if not present:
        return df.sparkSession.createDataFrame([], schema)
    counts = df.agg(*quality_counts(df, rules))

    def bound(field, side):
        value = (ranges[field] or {}).get(side)
        return F.lit(None).cast("double") if value is None else F.lit(float(value))

    entries = F.array(
        *[
            F.struct(
                F.lit(f).alias("field"),
                bound(f, "min").alias("min"),
                bound(f, "max").alias("max"),
                F.col(f).cast("long").alias("out_of_range"),
            )
            for f in present
        ]
    )
    return counts.select(F.inline(entries))


def quarantine_rows(df: DataFrame, rules: Mapping | None, rule_col: str = "rule") -> DataFrame:
    """Rows that break at least one rule, one output row per broken rule with
    the rule's field name in ``rule_col`` (a row breaking k rules appears k
    times). The any-rule filter is pushed to the scan; no shuffle."""
    preds = rule_predicates(rules, df.columns)
    if not preds:
        return df.filter(F.lit(False)).withColumn(rule_col, F.lit(None).cast("string"))
    return df.filter(any_violation(preds)).withColumn(rule_col, F.explode(violated_rules(preds)))


def drop_bad_rows(df: DataFrame, rules: Mapping | None) -> DataFrame:
    """The rows that break no rule."""
    return df.filter(~F.coalesce(any_violation(rule_predicates(rules, df.columns)), F.lit(False)))


def _leaves(schema: StructType, above: str = "") -> list[str]:
    """Dotted paths of all fields, structs before their fields."""
    out = []
    for f in schema.fields:
        out.append(above + f.name)
        if isinstance(f.dataType, StructType):
            out += _leaves(f.dataType, f"{above}{f.name}.")
    return out


def kind_error_counts(text: Column, data: Column, schema: StructType) -> list[Column]:
    """``count_if`` aggregate per field of a parsed record, named after its
    path: how often the field is present in the text, and not null there, but
    of a kind that the schema does not take, so that the parse gave NULL. The
    text is read a second time as a Variant, which keeps every kind; text that
    is no JSON counts nowhere. Usable in ``agg`` or in ``observe`` on a stream."""
    v = F.try_parse_json(text)
    counts = []
    for path in _leaves(schema):
        there = F.try_variant_get(v, f"$.{path}", "variant")
        parsed = data
        for name in path.split("."):
            parsed = parsed.getField(name)
        wrong = there.isNotNull() & ~F.is_variant_null(there) & parsed.isNull()
        counts.append(F.count_if(F.coalesce(wrong, F.lit(False))).alias(path))
    return counts


def kind_errors(raw: DataFrame, schema: StructType, value_col: str = "value") -> DataFrame:
    """``(field, wrong_kind)`` per field of ``schema`` over JSON records, from
    one pass: values that a permissive parse turns into NULL unseen. A field
    inside a struct that is itself of a wrong kind counts with the struct."""
    text = F.col(value_col).cast("string")
    paths = _leaves(schema)
    rows = raw.select(text.alias("t"), F.from_json(text, schema).alias("d"))
    counts = rows.agg(*[c.alias(f"_{i}") for i, c in enumerate(kind_error_counts(F.col("t"), F.col("d"), schema))])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(p).alias("field"), F.col(f"_{i}").alias("wrong_kind")) for i, p in enumerate(paths)])))


def duplicate_count(df: DataFrame, id_field: str = "event_id", lg_k: int | None = None) -> DataFrame:
    """One row ``(total, distinct_ids, duplicates)``: rows minus distinct
    non-NULL ids, so NULL ids count as duplicates. Spark de-duplicates ids
    on each map task before the shuffle, so a hot id stays cheap.

    With ``lg_k`` (4 to 21) ids are counted by a HyperLogLog sketch of 2**lg_k
    registers: one sketch a task crosses the network instead of its ids, and the
    count has a relative standard error of :func:`sketch_error`."""
    distinct = F.count_distinct(id_field) if lg_k is None else F.hll_sketch_estimate(F.hll_sketch_agg(id_field, F.lit(lg_k)))
    return df.agg(F.count(F.lit(1)).alias("total"), distinct.alias("distinct_ids")).withColumn("duplicates", F.col("total") - F.col("distinct_ids"))


#: Registers (as a power of two) of the sketches kept with batches and dates.
LG_K = 12


def sketch_error(lg_k: int = LG_K) -> float:
    """Relative standard error of a count by a HyperLogLog sketch."""
    return 1.04 / 2 ** (lg_k / 2)


def distinct_sketches(df: DataFrame, *by: str, id_field: str = "event_id", lg_k: int = LG_K) -> DataFrame:
    """One mergeable sketch of the ids for each value of ``by`` (say a date):
    ``(*by, rows, ids)``. Kept beside the data, it answers how many distinct ids
    any union of these groups holds without reading the data again."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg(id_field, F.lit(lg_k)).alias("ids"))


def distinct_over(sketches: DataFrame, *by: str) -> DataFrame:
    """``(*by, rows, distinct_ids)`` over the union of sketches in each group."""
    merged = F.hll_sketch_estimate(F.hll_union_agg("ids"))
    return sketches.groupBy(*by).agg(F.sum("rows").alias("rows"), F.coalesce(merged, F.lit(0)).alias("distinct_ids"))


def id_sketch(id_field: str = "event_id", lg_k: int = LG_K) -> Column:
    """The sketch of a batch's ids as text, for ``observe`` and a metric line
    (:func:`strata.operators.health.distinct_by_layer` merges them)."""
    return F.base64(F.hll_sketch_agg(id_field, F.lit(lg_k)))


# Scalar forms of the checks, for callers that want Python values.


def validate_ranges(df: DataFrame, rules: Mapping | None) -> DataFrame:
    """Log the out-of-range count per rule (one job for all rules); return
    ``df`` unchanged."""
    aggs = quality_counts(df, rules)
    if aggs:
        row = df.agg(*aggs).first()
        for name, n in row.asDict().items():
            if n:
                log.warning("%s rows out of range for %s", n, name)
    return df


def detect_duplicates(df: DataFrame, id_field: str = "event_id") -> int:
    """Number of duplicate rows on ``id_field`` (see :func:`duplicate_count`)."""
    return int(duplicate_count(df, id_field).first()["duplicates"])


def quarantine_bad_records(df: DataFrame, rules: Mapping | None, path: str) -> DataFrame:
    """Append the rows that break rules (with their ``rule``) to ``path`` as
    Parquet and return them."""
    bad = quarantine_rows(df, rules)
    bad.write.mode("append").parquet(path)
    return bad
