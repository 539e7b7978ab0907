"""Row changes without in-place mutation: conditional update, key-set deletion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.tables import Tables

LOAN_KEYS = ["office_id", "center_id", "member_id", "product_id", "loan_term", "loan_summary_id"]
ACCOUNT_KEYS = ["office_id", "center_id", "member_id", "product_id", "no_of_account"]
MEMBER_KEYS = ["office_id", "center_id", "member_id"]


def set_where(df: DataFrame, condition: Column, **values: Column | int) -> DataFrame:
    """Conditional update; every right-hand side sees the row as it was before."""
    kinds = dict(df.dtypes)
    changed = {}
    for name, value in values.items():
        value = value if isinstance(value, Column) else F.lit(value)
        changed[name] = F.when(condition, value.cast(kinds[name])).otherwise(F.col(name))
    return df.withColumns(changed)


def one_per_key(delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of a delta or lookup; the job fails where two of them have one key.

    Rows meet by their key, as they do for the join that follows, so the check adds no exchange to that.
    """
    rest = [c for c in delta.columns if c not in keys]
    grouped = delta.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *[F.any_value(c).alias(c) for c in rest])
    shown = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
    repeated = F.raise_error(F.concat(F.lit(f"several changes for one key ({', '.join(keys)}): "), shown))
    return grouped.filter(F.when(F.col("_rows") == 1, True).otherwise(repeated.cast("boolean"))).drop("_rows")


def merge(target: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target's rows with their change from a delta, NULL where it has none; see :func:`one_per_key`."""
    return target.join(one_per_key(delta, keys), list(keys), "left")


def meet(
    rows: DataFrame, facts: DataFrame, key: str, also: Sequence[str] = (), how: str = "left", nulls: bool = False
) -> DataFrame:
    """Rows with the facts of their key and of the columns in ``also``.

    The rows are dealt by the one key; the other columns are compared once rows have met, by an order test, which Spark
    does not take for a further key. So several facts of one key meet wide rows that move once. ``nulls``: NULL keys are
    equal.
    """
    own = {c: f"_of_{c}" for c in (key, *also)}
    facts = facts.select(*[F.col(c).alias(own.get(c, c)) for c in facts.columns])
    test = F.col(key).eqNullSafe(F.col(own[key])) if nulls else F.col(key) == F.col(own[key])
    for c in also:
        test = test & (F.col(c) <= F.col(own[c])) & (F.col(c) >= F.col(own[c]))
    return rows.join(facts, test, how).drop(*own.values())


def drop_where(df: DataFrame, condition: Column) -> DataFrame:
    """Delete rows that satisfy the condition; rows where it is NULL stay."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def drop_keys(df: DataFrame, key_set: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete rows whose key is in a derived key set."""
    return df.join(key_set.select(*keys).distinct(), list(keys), "left_anti")


def with_run(df: DataFrame, t: Tables, how: str = "inner") -> DataFrame:
    """Attach the run's dates per office (and organization, where the table carries one).

    ``how="left"`` keeps rows of offices outside the run with NULL dates, for snapshot updates.
    """
    keys = [k for k in ("office_id", "organization_id") if k in df.columns]
    run = t.run_control.select(
        *keys, F.col("business_date").alias("run_date"), F.col("month_end_date").alias("run_month_end")
    )
    return df.join(run, keys, how)


def without_run(df: DataFrame) -> DataFrame:
    return df.drop("run_date", "run_month_end")


def by_shuffle(df: DataFrame) -> DataFrame:
    """A lookup of no bounded size, joined by a shuffle.

    Spark broadcasts by the bytes of the files, and the repeated values of a chart or an interface take up far less
    there than their rows in memory of the driver.
    """
    return df.hint("merge")


#: A lookup of more rows is joined by a shuffle, however small its files are.
BROADCAST_ROWS = 200_000


def lookup(table: DataFrame) -> DataFrame:
    """A written table to look rows up in; whether it may be broadcast is decided by its rows."""
    return by_shuffle(table) if table.count() > BROADCAST_ROWS else table


def products_of(t: Tables, *columns: str) -> DataFrame:
    """Product attributes for a lookup join on ``product_id``."""
    return t.products.select("product_id", *columns)


def loan_products(t: Tables, rows: DataFrame, *columns: str | Column) -> DataFrame:
    """Product attributes by loan and product, for :func:`meet`: only these pairs are dealt by product, not the rows."""
    pairs = rows.select("loan_summary_id", "product_id").distinct()
    return pairs.join(products_of(t, *columns), "product_id")


def within_run(df: DataFrame, t: Tables, column: str, earliest: Column, latest: Column) -> DataFrame:
    """Narrow a history table to the dates the run can need, before any join.

    The bounds are aggregates of the run control, passed as scalar subqueries: Spark evaluates them first and pushes
    the resulting range into the scan, where partitions and row groups outside it are skipped.
    """
    bounds = t.run_control
    low, high = bounds.agg(earliest).scalar(), bounds.agg(latest).scalar()
    return df.filter((F.col(column) >= low) & (F.col(column) <= high))


def split_by_run_date(df: DataFrame, t: Tables, column: str) -> tuple[DataFrame, DataFrame]:
    """The rows in the range of the run's business dates, and all others."""
    low, high = (t.run_control.agg(bound("business_date")).scalar() for bound in (F.min, F.max))
    inside = (F.col(column) >= low) & (F.col(column) <= high)
    return df.filter(inside), df.filter(~F.coalesce(inside, F.lit(False)))


def on_run_date(df: DataFrame, t: Tables, column: str) -> DataFrame:
    """Narrow a history table to the range of the run's business dates."""
    return within_run(df, t, column, F.min("business_date"), F.max("business_date"))
