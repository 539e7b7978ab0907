"""Checks that decide whether an office may run a process: one report row per office and rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import day_diff, month_diff, same_month
from ledgerloom.functions.money import nz
from ledgerloom.functions.text import starts_with
from ledgerloom.operators.changes import on_run_date
from ledgerloom.operators.vouchers import day_initial_offices, movement_offices, voucher_numbers
from ledgerloom.sources.tables import Tables

# fixed values: code of offices exempt from the date-gap rule, holiday and voucher kinds
EXEMPT_OFFICE_CODE = "999"
CLOSED_HOLIDAYS = ("Weekly", "Govt")
BALANCED_VOUCHERS = ("Jr", "Ba", "Bc")


def _run(t: Tables) -> DataFrame:
    return t.run_control.select(
        "office_id",
        F.col("organization_id").alias("run_org"),
        F.col("business_date").alias("run_date"),
        F.col("month_end_date").alias("run_month_end"),
    )


def _report(df: DataFrame, failures: dict[str, Column], details: dict[str, Column] | None = None) -> DataFrame:
    """One row per rule; a NULL test does not fail."""
    details = details or {}
    rows = [
        F.struct(
            F.lit(rule).alias("rule"),
            F.when(F.coalesce(failed, F.lit(False)), 0).otherwise(1).alias("ok"),
            details.get(rule, F.lit(None).cast("string")).alias("detail"),
        )
        for rule, failed in failures.items()
    ]
    return df.select("office_id", F.inline(F.array(*rows)))


def _collect_per_office(run: DataFrame, *frames: DataFrame) -> DataFrame:
    return reduce(lambda left, right: left.join(right, "office_id", "left"), frames, run)


def _count_if(test: Column) -> Column:
    return F.count(F.when(test, F.lit(1)))


def start_of_day_report(t: Tables) -> DataFrame:
    """Rules W1 to W8."""
    run = _run(t)
    org = F.col("organization_id") == F.col("run_org")
    history = t.process_info.join(run, "office_id")
    before = org & (F.col("initial_date") < F.col("run_date"))
    process = history.groupBy("office_id").agg(
        F.max(
            F.when(
                (F.col("closing_status") == 1) & (F.col("business_date") < F.col("run_date")), F.col("business_date")
            )
        ).alias("last_end"),
        _count_if((F.col("business_date") == F.col("run_date")) & (F.col("closing_status") == 1)).alias("done_today"),
        _count_if(F.col("closing_date").isNull()).alias("unclosed"),
        F.max(F.when((F.col("closing_status") == 1) & org, F.col("closing_date"))).alias("last_close"),
        F.max(F.when(before, F.struct("business_date", "closing_status"))).alias("previous"),
        F.max(F.when(F.col("month_closing_status") == 1, F.col("month_closing_date"))).alias("month_closed"),
    )
    days = t.holidays.join(_collect_per_office(run, process.select("office_id", "last_end")), "office_id")
    own_day = org & (F.col("business_date") <= F.col("run_date"))
    holidays = days.groupBy("office_id").agg(
        F.count_distinct(
            F.when(F.col("business_date").between(F.col("last_end"), F.col("run_date")), F.col("business_date"))
        ).alias("days_off"),
        _count_if(
            org & (F.col("business_date") == F.col("run_date")) & F.col("holiday_type").isin(*CLOSED_HOLIDAYS)
        ).alias("closed_today"),
        F.max(F.when(own_day & (F.col("is_active") == 1), F.col("business_date"))).alias("last_holiday"),
    )
    df = _collect_per_office(run, process, holidays, t.offices.select("office_id", "office_code"))
    last_day = F.col("previous.business_date")
    last_day = F.when(F.col("last_holiday") > last_day, F.col("last_holiday")).otherwise(last_day)
    failures = {
        "W01": day_diff(F.col("run_date"), F.col("last_end")) - nz("days_off") > 1,
        "W02": F.col("done_today") > 0,
        "W03": F.col("unclosed") > 0,
        "W04": F.col("run_date") <= F.col("last_close"),
        "W05": (F.col("previous.business_date") != F.col("run_date")) & (F.col("previous.closing_status") == 0),
        "W06": F.col("closed_today") > 0,
        "W07": ~starts_with("office_code", EXEMPT_OFFICE_CODE) & (day_diff(F.col("run_date"), last_day) > 1),
        "W08": month_diff(F.col("month_closed"), F.col("run_date")) != 1,
    }
    return _report(df, failures, {"W05": F.when(F.col("previous").isNull(), "first day")})


def day_end_report(t: Tables) -> DataFrame:
    """Rules W9 to W14."""
    run = _run(t)
    dropped = t.members.filter("member_status = 2").select("member_id")
    movement = (
        F.sum("saving_installment") + F.sum("withdrawal") + F.sum("penalty") + F.sum("monthly_interest")
    ).alias("movement")
    collected = (
        t.daily_saving_trx.join(dropped, "member_id", "left_semi")
        .groupBy("office_id", "saving_summary_id")
        .agg(movement)
        .filter("movement <> 0")
        .groupBy("office_id")
        .agg(F.count(F.lit(1)).alias("dropped_accounts"))
    )
    moved = movement_offices(t).withColumn("moved", F.lit(1))
    flags = t.auto_voucher_check.groupBy("office_id").agg(
        _count_if(F.col("check_auto_voucher") == 1).alias("vouchers_run")
    )
    masters = (
        on_run_date(t.acc_trx_master.filter("is_active = 1"), t, "trx_date")
        .join(run, "office_id")
        .filter(F.col("trx_date") == F.col("run_date"))
        .select("trx_master_id", "trx_date", "office_id", "voucher_type")
    )
    balanced = F.col("voucher_type").isin(*BALANCED_VOUCHERS)
    lines = (
        on_run_date(t.acc_trx_detail.filter("is_active = 1"), t, "trx_date")
        .join(masters, ["trx_master_id", "trx_date"])
        .join(t.acc_chart.select("acc_id"), "acc_id")
        .groupBy("office_id")
        .agg(
            F.sum(F.when(balanced, nz("debit"))).cast("decimal(28,0)").alias("debits"),
            F.sum(F.when(balanced, nz("credit"))).cast("decimal(28,0)").alias("credits"),
            F.count(F.lit(1)).alias("lines"),
        )
    )
    own = t.process_info.join(run, "office_id").filter(F.col("organization_id") == F.col("run_org"))
    status = F.coalesce("closing_status", F.lit(0))
    process = own.groupBy("office_id").agg(
        F.max(F.when(F.col("initial_date") == F.col("run_date"), status)).alias("status_today"),
        F.max(F.when(F.col("initial_date") < F.col("run_date"), F.struct("initial_date", status.alias("status")))).alias(
            "previous"
        ),
    )
    df = _collect_per_office(run, collected, moved, flags, lines, process)
    failures = {
        "W09": F.col("dropped_accounts") > 0,
        "W10": (F.col("moved") == 1) & (nz("vouchers_run") == 0),
        "W11": nz("debits") != nz("credits"),
        "W12": nz("lines") == 0,
        "W13": F.col("status_today").isNull() | (F.col("status_today") != 0),
        "W14": F.col("previous").isNull() | (F.col("previous.status") == 0),
    }
    return _report(
        df,
        failures,
        {
            "W13": F.when(F.col("status_today").isNull(), "no history"),
            "W14": F.when(F.col("previous").isNull(), "no history"),
        },
    )


def month_end_report(t: Tables) -> DataFrame:
    """Rules W15 to W17."""
    run = _run(t)
    closed = (F.col("closing_status") == 1) & (F.col("organization_id") == F.col("run_org"))
    month_closed = same_month(F.col("month_closing_date"), F.col("run_month_end")) & (
        F.col("month_closing_status") == 1
    )
    process = (
        t.process_info.join(run, "office_id")
        .groupBy("office_id")
        .agg(
            _count_if((F.col("business_date") <= F.col("run_month_end")) & (F.col("closing_status") == 0)).alias("open_days"),
            F.max(F.when(closed, F.col("closing_date"))).alias("last_close"),
            _count_if(month_closed).alias("closings"),
        )
    )
    holidays = (
        t.holidays.join(run, "office_id")
        .filter(same_month(F.col("business_date"), F.col("run_month_end")))
        .groupBy("office_id")
        .agg(F.max("business_date").alias("last_holiday"))
    )
    df = _collect_per_office(run, process, holidays)
    failures = {
        "W15": F.col("open_days") > 0,
        "W16": F.col("last_holiday") != F.col("last_close"),
        "W17": F.col("closings") > 0,
    }
    return _report(df, failures)


def auto_voucher_report(t: Tables) -> DataFrame:
    """Rule W18: the day is opened, and with movement an unposted voucher number exists."""
    opened = day_initial_offices(t).withColumn("opened", F.lit(1))
    moved = movement_offices(t).withColumn("moved", F.lit(1))
    df = _collect_per_office(_run(t), opened, moved, voucher_numbers(t))
    failed = F.col("opened").isNull() | ((F.col("moved") == 1) & F.col("voucher_no").isNull())
    detail = F.when(F.col("opened").isNull(), "no day initial").when(
        (F.col("moved") == 1) & F.col("voucher_no").isNull(), "no voucher number"
    )
    return _report(df, {"W18": failed}, {"W18": detail})


def passing_offices(t: Tables, report: DataFrame) -> Tables:
    """The table set with failing offices taken out of the run."""
    failing = report.filter("ok = 0").select("office_id").distinct()
    return t.replace(run_control=t.run_control.join(failing, "office_id", "left_anti"))
