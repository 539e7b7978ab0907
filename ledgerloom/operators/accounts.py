"""Cash-book close of the day and closing of emptied savings accounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.money import money, nz
from ledgerloom.functions.text import starts_with, voucher_for_year
from ledgerloom.operators.changes import (
    ACCOUNT_KEYS,
    LOAN_KEYS,
    MEMBER_KEYS,
    on_run_date,
    products_of,
    set_where,
    with_run,
)
from ledgerloom.operators.voucher_control import with_vouchers
from ledgerloom.sources.tables import Tables


def day_ledger(t: Tables) -> DataFrame:
    """Active voucher lines of the run date."""
    run = t.run_control.select("office_id", F.col("business_date").alias("run_date"))
    masters = (
        on_run_date(t.acc_trx_master.filter("is_active = 1"), t, "trx_date")
        .join(run, "office_id")
        .filter(F.col("trx_date") == F.col("run_date"))
        .select("trx_master_id", "office_id", "trx_date", "voucher_no", "voucher_type")
    )
    lines = on_run_date(t.acc_trx_detail.filter("is_active = 1").drop("is_active"), t, "trx_date")
    return lines.join(masters, ["trx_master_id", "trx_date"]).join(t.acc_chart.select("acc_id"), "acc_id")


def _cash_account(t: Tables) -> DataFrame:
    chart = t.acc_chart.filter("is_active = 1").select(
        F.col("acc_code").alias("cash_book"), "organization_id", F.col("acc_id").alias("cash_id")
    )
    settings = t.application_settings.select("office_id", "organization_id", "cash_book")
    return settings.join(chart, ["cash_book", "organization_id"]).select("office_id", "cash_id")


def cash_close(t: Tables) -> DataFrame:
    """Balancing cash vouchers: a debit line for the day's credits and a credit line for its debits.

    One voucher per side and office; its key is office, date and side.
    """
    run = t.run_control.select("office_id", "organization_id", F.col("business_date").alias("run_date"))
    totals = (
        day_ledger(t)
        .filter("voucher_type = 'CA'")
        .join(_cash_account(t), "office_id")
        .filter(F.col("acc_id") != F.col("cash_id"))
        .groupBy("office_id", "cash_id")
        .agg(F.sum("debit").cast("decimal(28,0)").alias("debits"), F.sum("credit").cast("decimal(28,0)").alias("credits"))
    )
    sides = F.array(
        F.struct(F.lit("Dr").alias("side"), F.col("credits").alias("amount")),
        F.struct(F.lit("Cr").alias("side"), F.col("debits").alias("amount")),
    )
    lines = totals.select("office_id", "cash_id", F.inline(sides)).filter("amount > 0")
    numbered = lines.join(run, "office_id").join(t.acc_last_voucher, "office_id", "left")
    return numbered.select(
        F.concat_ws("-", "office_id", F.date_format("run_date", "yyyyMMdd"), F.lit("cash"), "side").alias("voucher_key"),
        "office_id",
        "organization_id",
        F.col("run_date").alias("trx_date"),
        "voucher_no",
        F.col("side").alias("voucher_type"),
        F.col("cash_id").alias("acc_id"),
        money(F.when(F.col("side") == "Dr", F.col("amount")).otherwise(0)).alias("debit"),
        money(F.when(F.col("side") == "Cr", F.col("amount")).otherwise(0)).alias("credit"),
    )


def flush_cash(t: Tables, cash: DataFrame) -> Tables:
    """The cash vouchers of :func:`cash_close` and their lines in the ledger, with hashes of their keys as numbers.

    Those of an earlier close of the same day are replaced."""
    keyed = (
        cash.withColumn("trx_master_id", F.xxhash64("voucher_key"))
        .withColumn("trx_details_id", F.xxhash64("voucher_key", "acc_id"))
        .withColumn("narration", F.lit("N/A"))
        .withColumn("is_posted", F.lit(0))
        .withColumn("is_auto_voucher", F.lit(0))
        .withColumn("is_active", F.lit(1))
    )
    # a repeated close replaces its vouchers; keys are sought among the run dates' rows only
    made = keyed.select("trx_master_id", "trx_date").distinct()
    masters, details = (
        df.join(made, ["trx_master_id", "trx_date"], "left_anti") for df in (t.acc_trx_master, t.acc_trx_detail)
    )
    return t.replace(
        acc_trx_master=masters.unionByName(keyed.select(*t.acc_trx_master.columns)),
        acc_trx_detail=details.unionByName(keyed.select(*t.acc_trx_detail.columns)),
        voucher_control=with_vouchers(t, keyed),
    )


def post_masters(t: Tables) -> DataFrame:
    """Vouchers of the run date become posted."""
    run = t.run_control.select("office_id", F.col("business_date").alias("run_date"))
    df = t.acc_trx_master.join(run, "office_id", "left")
    return set_where(df, F.col("trx_date") == F.col("run_date"), is_posted=1).drop("run_date")


def roll_last_voucher(t: Tables) -> DataFrame:
    """The last voucher number takes the run year as suffix."""
    run = t.run_control.select("office_id", F.year("business_date").alias("run_year"))
    df = t.acc_last_voucher.join(run, "office_id", "left")
    number = voucher_for_year(F.col("voucher_no"), F.col("run_year"))
    return set_where(df, F.col("run_year").isNotNull(), voucher_no=number).drop("run_year")


# ---------------------------------------------------------------- account closing


def _bare_balance() -> Column:
    return F.col("deposit") + F.col("cum_interest") - F.col("withdrawal")


def close_candidates(t: Tables) -> DataFrame:
    """Open accounts with a withdrawal today and nothing left, penalty included."""
    withdrawn = (
        with_run(t.daily_saving_trx, t)
        .groupBy("saving_summary_id", "transaction_date")
        .agg(F.sum("withdrawal").alias("withdrawn"))
        .filter("withdrawn > 0")
        .select("saving_summary_id")
    )
    return (
        with_run(t.saving_summary, t)
        .filter((F.col("saving_status") == 1) & (_bare_balance() + F.col("penalty") == 0))
        .join(withdrawn, "saving_summary_id", "left_semi")
        .select("organization_id", *ACCOUNT_KEYS)
        .distinct()
    )


def _members_with_loan(t: Tables, members: DataFrame) -> DataFrame:
    """Members among ``members`` with a loan of at least 0.5 left after today's rows."""
    paid = (
        t.daily_loan_trx.join(members.select(*MEMBER_KEYS), MEMBER_KEYS, "left_semi")
        .groupBy(*LOAN_KEYS)
        .agg(F.sum("loan_paid").alias("d_loan_paid"), F.sum("int_paid").alias("d_int_paid"))
    )
    left = (
        nz("principal_loan")
        + nz("int_charge")
        - nz("loan_repaid")
        - nz("int_paid")
        - nz("d_loan_paid")
        - nz("d_int_paid")
    )
    keys = ["organization_id", *MEMBER_KEYS]
    return (
        t.loan_summary.filter("is_active = 1")
        .join(members.select(*keys), keys, "left_semi")
        .join(paid, LOAN_KEYS, "left")
        .filter(left >= 0.5)
        .select(*keys)
        .distinct()
    )


def closable_accounts(t: Tables, candidates: DataFrame) -> DataFrame:
    """Those of :func:`close_candidates` whose net balance after today's rows is not positive.

    ``compulsory`` marks products whose main code starts with 21; ``summed_ok`` is the net test over all rows that
    share the account keys. ``owing`` marks accounts of members with an open loan: of these only compulsory ones with
    a negative net are closable.
    """
    keys = ["organization_id", *ACCOUNT_KEYS]
    day = (
        t.daily_saving_trx.join(candidates, keys, "left_semi")
        .groupBy(*keys)
        .agg(F.sum("saving_installment").alias("d_installment"), F.sum("withdrawal").alias("d_withdrawal"))
    )
    net = nz("deposit") + nz("d_installment") + nz("cum_interest") - nz("withdrawal") - nz("d_withdrawal")
    tested = (
        t.saving_summary.filter("is_active = 1")
        .join(candidates, keys, "left_semi")
        .join(day, keys, "left")
        .groupBy(*keys)
        .agg(F.min(net).alias("least"), F.sum(net).alias("total"))
        .filter("least <= 0")
    )
    keys_of_member = ["organization_id", *MEMBER_KEYS]
    owing = _members_with_loan(t, candidates.select(*keys_of_member).distinct()).withColumn("owing", F.lit(True))
    main_code = products_of(t, "main_product_code")
    compulsory = F.coalesce(starts_with("main_product_code", "21"), F.lit(False))
    return (
        tested.join(owing, keys_of_member, "left")
        .join(main_code, "product_id", "left")
        .select(
            *keys,
            compulsory.alias("compulsory"),
            (F.col("total") <= 0).alias("summed_ok"),
            F.coalesce("owing", F.lit(False)).alias("owing"),
            "least",
        )
        .filter("NOT owing OR (compulsory AND least < 0)")
        .drop("least")
    )


def _open_voluntary(t: Tables, accounts: DataFrame) -> DataFrame:
    """Open active accounts outside the compulsory main products."""
    others = products_of(t, "main_product_code").filter(~starts_with("main_product_code", "21"))
    return accounts.filter("saving_status = 1 AND is_active = 1").join(others, "product_id", "left_semi")


def close_accounts(t: Tables, closable: DataFrame) -> DataFrame:
    """Savings accounts after closing: others first, then compulsory ones no other account holds open.

    Compulsory accounts of owing members close whatever else is open.

    ``closable`` is the result of :func:`closable_accounts`; the accounts closed carry the office's latest business
    date.
    """
    keys = ["organization_id", *ACCOUNT_KEYS]
    others = closable.filter("NOT compulsory").select(*keys)
    compulsory = closable.filter("compulsory AND NOT owing").select(*keys)
    owing = closable.filter("owing").select(*keys)
    held_open = (
        _open_voluntary(t, t.saving_summary)
        .join(compulsory.select(*MEMBER_KEYS).distinct(), MEMBER_KEYS, "left_semi")
        .join(others, keys, "left_anti")
        .select(*MEMBER_KEYS)
        .distinct()
    )
    closing = others.unionByName(compulsory.join(held_open, MEMBER_KEYS, "left_anti")).unionByName(owing)
    latest = t.process_info.groupBy("office_id").agg(F.max("business_date").alias("closed_on"))
    marks = closing.join(latest, "office_id", "left").withColumn("closing", F.lit(1))
    df = set_where(
        t.saving_summary.join(marks, keys, "left"),
        F.col("closing") == 1,
        saving_status=0,
        closing_date=F.col("closed_on"),
        transaction_date=F.col("closed_on"),
    )
    return df.select(*t.saving_summary.columns)


def release_members(t: Tables, closable: DataFrame, closed: DataFrame) -> DataFrame:
    """Members whose compulsory account was closable and who keep no open or positive account are released.

    ``closed`` is the result of :func:`close_accounts`.
    """
    keys = ["organization_id", *MEMBER_KEYS]
    reached = closable.filter("compulsory AND summed_ok AND NOT owing").select(*keys).distinct()
    own = closed.join(reached.select(*MEMBER_KEYS).distinct(), MEMBER_KEYS, "left_semi")
    positive = own.filter((F.col("is_active") == 1) & (_bare_balance() > 0))
    positive = positive.join(t.products.select("product_id"), "product_id", "left_semi").select(*MEMBER_KEYS)
    holding = _open_voluntary(t, own).select(*MEMBER_KEYS).unionByName(positive).distinct()
    latest = t.process_info.groupBy("office_id").agg(F.max("business_date").alias("released_on"))
    released = reached.join(holding, MEMBER_KEYS, "left_anti").join(latest, "office_id", "left")
    df = t.members.join(released.withColumn("released", F.lit(1)), keys, "left")
    df = set_where(df, F.col("released") == 1, member_status=2, release_date=F.col("released_on"))
    return df.select(*t.members.columns)
