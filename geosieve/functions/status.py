"""Values with a status, so that nothing there, no answer and not assessable are never confused with zero.

A value record has value, status, source, vintage, method and note. Only ok
carries a value, and even ok may carry null where the source publishes none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OK, ABSENT, FAILED, MANUAL, NOT_ASSESSABLE = "ok", "absent", "failed", "manual", "not_assessable"
STATUSES = (OK, ABSENT, FAILED, MANUAL, NOT_ASSESSABLE)
RECORD = ("value", "status", "source", "vintage", "method", "note")


def record(value: Column, status: Column | str, **about: Column | str | None) -> Column:
    """A value record; the value is dropped unless the status lets it stand."""
    status = F.lit(status) if isinstance(status, str) else status
    kept = F.when(status.isin(OK, MANUAL), value.cast("string"))
    rest = {k: about.get(k) for k in RECORD[2:]}
    column = lambda x: x.cast("string") if isinstance(x, Column) else F.lit(x).cast("string")
    return F.struct(kept.alias("value"), status.alias("status"), *[column(v).alias(k) for k, v in rest.items()])


def found(value: Column, present: Column, failed: Column | bool = False) -> Column:
    """The status of a measure: failed before absent before ok."""
    failed = failed if isinstance(failed, Column) else F.lit(failed)
    return F.when(failed, FAILED).when(~present, ABSENT).otherwise(OK)


def to_long(wide: DataFrame, key: str, records: dict[str, Column]) -> DataFrame:
    """One row a key and field, in the order of the fields."""
    rows = F.array(*[F.struct(F.lit(i).alias("ordinal"), F.lit(f).alias("field"), r.alias("r")) for i, (f, r) in enumerate(records.items())])
    out = wide.select(key, F.explode(rows).alias("x"))
    return out.select(key, "x.ordinal", "x.field", *[F.col(f"x.r.{c}").alias(c) for c in RECORD])


def to_wide(long: DataFrame, key: str, fields: list[str], value: str = "value") -> DataFrame:
    """One row a key and one column a field, in the given order; fields are named, so no extra job finds them."""
    return long.groupBy(key).pivot("field", fields).agg(F.first(value, ignorenulls=True))


def tally(long: DataFrame, *by: str) -> DataFrame:
    """Rows by status, and by other columns before it."""
    return long.groupBy(*by, "status").agg(F.count("*").alias("n"))


def gaps(long: DataFrame, *order: str) -> DataFrame:
    """Absent and failed records, failed first; not assessable ones are no gaps."""
    kept = long.where(F.col("status").isin(ABSENT, FAILED))
    return kept.orderBy(F.col("status") != FAILED, *order)


def contract(long: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Keys whose fields aren't exactly these in this order, and records that break the null rule."""
    order = F.array_sort(F.collect_list(F.struct("ordinal", "field")))["field"]
    bad = F.count_if(F.col("status").isin(ABSENT, FAILED, NOT_ASSESSABLE) & F.col("value").isNotNull())
    seen = long.groupBy(key).agg(order.alias("fields"), bad.alias("valued"), F.count_if(~F.col("status").isin(*STATUSES)).alias("unknown"))
    wrong = F.col("fields") != F.array(*map(F.lit, fields))
    return seen.where(wrong | (F.col("valued") > 0) | (F.col("unknown") > 0))
