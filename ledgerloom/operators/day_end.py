"""Day end: transactions go to history, balances roll, finished accounts and members close.

Operators on history tables return the rows of the run date only; the caller replaces that slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import first_date, last_date, same_month
from ledgerloom.functions.money import nz, zero
from ledgerloom.functions.text import starts_with
from ledgerloom.operators import totals
from ledgerloom.operators.changes import (
    LOAN_KEYS,
    loan_products,
    meet,
    merge,
    on_run_date,
    one_per_key,
    products_of,
    set_where,
    with_run,
    within_run,
    without_run,
)
from ledgerloom.sources.tables import Tables


def _filled(df: DataFrame, template: DataFrame, **columns: Column) -> DataFrame:
    """Rows in the template's layout: given columns, then same-named ones, NULL elsewhere."""
    chosen = []
    for name, kind in template.dtypes:
        if name in columns:
            value = columns[name]
        elif name in df.columns:
            value = F.col(name)
        else:
            value = F.lit(None)
        chosen.append(value.cast(kind).alias(name))
    return df.select(*chosen)


# ---------------------------------------------------------------- loans


def _method() -> Column:
    return F.col("interest_calculation_method").alias("p_method")


def post_loan_trx(t: Tables) -> DataFrame:
    """The day's loan rows as history rows; flat loans carry no charge."""
    run = t.run_control.select("office_id", F.col("business_date").alias("run_date"))
    rows = t.daily_loan_trx.join(run, "office_id")
    rows = meet(rows, loan_products(t, rows, _method()), "loan_summary_id", ["product_id"], "inner", nulls=True)
    charge = F.when(F.col("p_method") == "F", zero()).otherwise(F.col("int_charge"))
    return _filled(
        rows,
        t.loan_trx,
        installment_date=F.col("run_date"),
        int_charge=charge,
        principal_loan=F.lit(None),
        loan_trx_id=F.lit(None),
    )


def roll_loan_summary(t: Tables) -> DataFrame:
    """Twelve loan balances rolled by the day's sums per loan, corrections (type 41) excluded.

    Sums and products meet the loans by the loan alone, as corrections do, so loans move once for all of them.
    """
    day = (
        with_run(t.daily_loan_trx, t)
        .filter((F.col("trx_type") != 41) & (F.col("installment_date") == F.col("run_date")))
        .groupBy(*LOAN_KEYS)
        .agg(
            F.max("installment_no").alias("d_no"),
            F.max("run_date").alias("d_date"),
            *[F.sum(c).alias(f"d_{c}") for c in ("loan_paid", "int_paid", "int_charge", "loan_due", "int_due")],
        )
    )
    loans = with_run(t.loan_summary, t, "left")
    day = one_per_key(day, LOAN_KEYS)
    df = meet(loans, day, "loan_summary_id", [c for c in LOAN_KEYS if c != "loan_summary_id"])
    df = meet(df, loan_products(t, t.loan_summary, _method()), "loan_summary_id", ["product_id"])
    hit = F.col("d_date").isNotNull() & F.col("run_date").isNotNull() & F.col("p_method").isNotNull()

    def grown(column: str, by: str) -> Column:
        return F.col(column) + nz(by)

    def grown_nz(column: str, by: str) -> Column:
        return nz(column) + nz(by)

    charge = F.when(F.col("p_method") == "F", F.col("int_charge")).otherwise(
        F.col("int_charge") + F.col("d_int_charge")
    )
    df = set_where(
        df,
        hit,
        loan_repaid=F.col("loan_repaid") + F.col("d_loan_paid"),
        int_paid=F.col("int_paid") + F.col("d_int_paid"),
        int_charge=charge,
        installment_no=F.col("d_no"),
        installment_date=F.col("d_date"),
        cum_loan_due=grown_nz("cum_loan_due", "d_loan_due"),
        cum_int_due=grown_nz("cum_int_due", "d_int_due"),
        cur_loan=grown("cur_loan", "d_loan_paid"),
        cur_int_paid=grown("cur_int_paid", "d_int_paid"),
        cur_int_charge=grown("cur_int_charge", "d_int_charge"),
        cur_loan_due=grown("cur_loan_due", "d_loan_due"),
        cur_int_due=grown("cur_int_due", "d_int_due"),
    )
    return df.select(*t.loan_summary.columns)


def apply_corrections(t: Tables) -> DataFrame:
    """Corrections (type 41) of the run date added to the loan's repaid, interest paid and charge."""
    day = (
        with_run(t.daily_loan_trx, t)
        .filter((F.col("trx_type") == 41) & (F.col("trx_date") == F.col("run_date")))
        .groupBy("loan_summary_id")
        .agg(*[F.sum(c).alias(f"d_{c}") for c in ("loan_paid", "int_paid", "int_charge")], F.lit(1).alias("hit"))
    )
    day = one_per_key(day, ["loan_summary_id"])
    df = meet(with_run(t.loan_summary, t, "left"), day, "loan_summary_id")
    # the loans as they are stored: keys and products don't change in a roll
    df = meet(df, loan_products(t, t.loan_summary, _method()), "loan_summary_id", ["product_id"])
    hit = (F.col("hit") == 1) & F.col("run_date").isNotNull() & F.col("p_method").isNotNull()
    charge = F.when(F.col("p_method") == "F", F.col("int_charge")).otherwise(nz("int_charge") + nz("d_int_charge"))
    df = set_where(
        df,
        hit,
        loan_repaid=nz("loan_repaid") + nz("d_loan_paid"),
        int_paid=nz("int_paid") + nz("d_int_paid"),
        int_charge=charge,
    )
    return df.select(*t.loan_summary.columns)


def _partial(partial: str, full: Column) -> Column:
    return F.when(F.col("disbursement_type") == 2, nz(partial)).otherwise(full)


def disbursement_trx(t: Tables) -> DataFrame:
    """The day's disbursements as history rows, partial or full."""
    rows = with_run(t.loan_summary, t).filter(F.col("disburse_date") == F.col("run_date"))
    return _filled(
        rows,
        t.loan_trx,
        loan_trx_id=F.lit(None),
        trx_date=F.col("run_date"),
        installment_date=F.col("run_date"),
        principal_loan=_partial("partial_amount", F.col("principal_loan")),
        int_charge=_partial("partial_int_charge", F.col("int_charge")),
        int_paid=_partial("partial_int_paid", zero()),
        trx_type=F.col("trans_type").cast("int"),
        installment_no=F.lit(0),
        loan_paid=F.lit(None),
        loan_due=F.lit(None),
        int_due=F.lit(None),
    )


def roll_disbursement(t: Tables) -> DataFrame:
    """Disbursed loans become posted; partial amounts are added and the final date kept or cleared.

    All right-hand sides see the old row, so the date depends on the previous final-disbursement flag.
    """
    today = (
        (F.col("disburse_date") == F.col("run_date"))
        & (F.col("installment_date") == F.col("run_date"))
        & (F.col("is_active") == 1)
    )
    partial = F.col("disbursement_type") == 2

    def added(column: str, by: str) -> Column:
        return F.when(partial, F.col(column) + nz(by)).otherwise(F.col(column))

    complete = F.col("principal_loan") + nz("partial_amount") == nz("approved_amount")
    kept = F.when(partial, F.when(F.col("final_disbursement") == 1, F.col("run_date"))).otherwise(
        F.col("disburse_date")
    )
    df = set_where(
        with_run(t.loan_summary, t, "left"),
        today,
        posted=1,
        principal_loan=added("principal_loan", "partial_amount"),
        int_charge=added("int_charge", "partial_int_charge"),
        int_paid=added("int_paid", "partial_int_paid"),
        final_disbursement=F.when(complete, 1).otherwise(0),
        disburse_date=kept,
    )
    return without_run(df).select(*t.loan_summary.columns)


def close_loans(t: Tables) -> DataFrame:
    """Open loans with nothing left (net of write-offs) and the principal fully repaid are closed."""
    settled = F.col("loan_repaid") + F.col("int_paid") + nz("write_off_loan") + nz("write_off_interest")
    left = F.col("principal_loan") + F.col("int_charge") - settled
    done = (
        F.col("run_date").isNotNull()
        & (F.col("loan_status") == 1)
        & (left < 0.5)
        & (F.col("principal_loan") == F.col("loan_repaid"))
    )
    df = set_where(
        with_run(t.loan_summary, t, "left"), done, loan_status=0, loan_close_date=F.col("run_date")
    )
    return df.select(*t.loan_summary.columns)


def collected_this_month(t: Tables) -> DataFrame:
    """Loans with history rows of monthly products on other days of the run date's month."""
    keys = ["office_id", "center_id", "member_id", "loan_term", "loan_summary_id"]
    monthly = products_of(t, "payment_frequency").filter("payment_frequency = 'M'")
    month = within_run(
        t.loan_trx, t, "installment_date", first_date(F.min("business_date")), last_date(F.max("business_date"))
    )
    return (
        with_run(month, t)
        .filter(
            same_month(F.col("installment_date"), F.col("run_date"))
            & (F.col("installment_date") != F.col("run_date"))
            & F.col("loan_summary_id").isNotNull()
        )
        .join(monthly, "product_id", "left_semi")
        .select(*keys)
        .distinct()
        .withColumn("collected", F.lit(1))
    )


def zero_repeat_due(t: Tables, today: DataFrame | None = None, collected: DataFrame | None = None) -> DataFrame:
    """History rows of the run date; dues are zero for monthly loans already collected this month.

    ``today``: rows that are to be history of the run date, in place of those that are; they count as collected no more
    than those do. ``collected``: the result of :func:`collected_this_month`, where it is at hand.
    """
    if today is None:
        run = t.run_control.select("office_id", F.col("business_date").alias("run_date"))
        today = on_run_date(t.loan_trx, t, "installment_date").join(run, "office_id")
        today = today.filter(F.col("installment_date") == F.col("run_date"))
    if collected is None:
        collected = collected_this_month(t)
    df = meet(today, collected, "loan_summary_id", ["office_id", "center_id", "member_id", "loan_term"], nulls=True)
    return set_where(df, F.col("collected") == 1, loan_due=0, int_due=0).select(*t.loan_trx.columns)


def final_due(t: Tables) -> DataFrame:
    """A type-52 row per loan at its final instalment today, with all principal and interest not yet due.

    What history sums to comes from the running totals and the days since.
    """
    final = (
        with_run(t.loan_summary, t)
        .filter(
            (F.col("installment_date") == F.col("run_date")) & (F.col("installment_no") == F.col("duration"))
        )
        .select(*LOAN_KEYS, "member_category_id", "employee_id", "investor_id", "organization_id", "run_date")
    )
    history = totals.history_sums(t, final).select(
        *LOAN_KEYS,
        (F.col("principal_loan") - F.col("loan_due")).alias("h_loan_due"),
        (F.col("int_charge") - F.col("int_due")).alias("h_int_due"),
        F.col("installment_no").alias("h_no"),
    )
    return _filled(
        final.join(history, LOAN_KEYS),
        t.loan_trx,
        trx_date=F.col("run_date"),
        installment_date=F.col("run_date"),
        loan_due=F.col("h_loan_due"),
        int_due=F.col("h_int_due"),
        **{c: zero() for c in ("loan_paid", "int_charge", "int_paid")},
        trx_type=F.lit(52),
        installment_no=F.col("h_no"),
    )


def purge_zero_due(rows: DataFrame, t: Tables) -> DataFrame:
    """Type 52/53 rows of the run date without any amount are removed; a NULL amount keeps the row."""
    run = t.run_control.select("office_id", F.col("business_date").alias("run_date"))
    total = F.col("loan_paid") + F.col("loan_due") + F.col("int_due") + F.col("int_charge") + F.col("int_paid")
    empty = (total == 0) & F.col("trx_type").isin(52, 53) & (F.col("trx_date") == F.col("run_date"))
    kept = rows.join(run, "office_id", "left").filter(~F.coalesce(empty, F.lit(False)))
    return kept.select(*rows.columns)


def resync_month_to_date(t: Tables) -> DataFrame:
    """Five month-to-date amounts re-read from history where any differs; NULLs do not count as different."""
    amounts = {
        "cur_loan": "loan_paid",
        "cur_int_paid": "int_paid",
        "cur_int_charge": "int_charge",
        "cur_loan_due": "loan_due",
        "cur_int_due": "int_due",
    }
    run = t.run_control.select("office_id", F.col("business_date").alias("run_date"))
    month = (
        within_run(
            t.loan_trx, t, "installment_date", first_date(F.min("business_date")), F.max("business_date")
        )
        .join(run, "office_id")
        .filter(F.col("installment_date").between(first_date(F.col("run_date")), F.col("run_date")))
        .groupBy("office_id", "loan_summary_id")
        .agg(*[F.sum(source).alias(f"m_{name}") for name, source in amounts.items()])
    )
    df = merge(t.loan_summary, month, ["office_id", "loan_summary_id"])
    differs = F.lit(False)
    for name in amounts:
        differs = differs | (F.col(name) != F.col(f"m_{name}"))
    return set_where(df, differs, **{name: F.col(f"m_{name}") for name in amounts}).select(*t.loan_summary.columns)


# ---------------------------------------------------------------- savings


def post_saving_trx(t: Tables) -> DataFrame:
    """The day's savings rows as history rows with the running balance."""
    rows = with_run(t.daily_saving_trx, t)
    return _filled(
        rows,
        t.saving_trx,
        saving_trx_id=F.lit(None),
        deposit=F.col("saving_installment"),
        balance=F.col("balance") + F.col("saving_installment") - F.col("withdrawal"),
    )


def roll_saving_summary(t: Tables) -> DataFrame:
    """Eight savings balances rolled by the day's sums per account."""
    day = (
        with_run(t.daily_saving_trx, t)
        .groupBy("saving_summary_id")
        .agg(
            *[
                F.sum(c).alias(f"d_{c}")
                for c in ("saving_installment", "withdrawal", "penalty", "monthly_interest")
            ],
            F.lit(1).alias("hit"),
        )
    )
    added = {
        "deposit": "saving_installment",
        "withdrawal": "withdrawal",
        "penalty": "penalty",
        "cum_interest": "monthly_interest",
        "cur_deposit": "saving_installment",
        "cur_withdrawal": "withdrawal",
        "cur_interest": "monthly_interest",
        "cur_penalty": "penalty",
    }
    df = merge(t.saving_summary, day, ["saving_summary_id"])
    rolled = {name: F.col(name) + F.col(f"d_{source}") for name, source in added.items()}
    return set_where(df, F.col("hit") == 1, **rolled).select(*t.saving_summary.columns)


def stamp_saving_date(t: Tables) -> DataFrame:
    """Active accounts with an instalment today carry the run date as transaction date."""
    paid = (
        with_run(t.daily_saving_trx, t)
        .groupBy("saving_summary_id")
        .agg(F.sum("saving_installment").alias("paid"))
        .filter("paid > 0")
    )
    df = merge(with_run(t.saving_summary, t, "left"), paid, ["saving_summary_id"])
    hit = F.col("paid").isNotNull() & (F.col("is_active") == 1) & F.col("run_date").isNotNull()
    return set_where(df, hit, transaction_date=F.col("run_date")).select(*t.saving_summary.columns)


def _balance() -> Column:
    return F.col("deposit") + F.col("cum_interest") - F.col("withdrawal")


def _close_accounts(df: DataFrame, condition: Column, columns: list[str]) -> DataFrame:
    return set_where(df, condition, saving_status=0, closing_date=F.col("run_date")).select(*columns)


def _emptied() -> Column:
    return (
        F.col("run_date").isNotNull()
        & (F.col("is_active") == 1)
        & (F.col("saving_status") == 1)
        & (_balance() == 0)
    )


def close_dropped_member_savings(t: Tables) -> DataFrame:
    """Zero-balance savings of dropped members are closed."""
    dropped = t.members.filter("member_status = 2").select("member_id", F.lit(1).alias("dropped"))
    df = with_run(t.saving_summary, t, "left").join(dropped, "member_id", "left")
    return _close_accounts(df, _emptied() & (F.col("dropped") == 1), t.saving_summary.columns)


def close_empty_savings(t: Tables) -> DataFrame:
    """Emptied savings outside the compulsory products are closed."""
    compulsory = products_of(t, "product_code").filter(starts_with("product_code", "21"))
    compulsory = compulsory.select("product_id", F.lit(1).alias("compulsory"))
    df = with_run(t.saving_summary, t, "left").join(compulsory, "product_id", "left")
    closing = _emptied() & (F.col("withdrawal") > 0) & F.col("compulsory").isNull()
    return _close_accounts(df, closing, t.saving_summary.columns)


def close_no_loan_savings(t: Tables) -> DataFrame:
    """Emptied savings of members without an unsettled loan (code not starting with 7) are closed."""
    excluded = products_of(t, "product_code").filter(starts_with("product_code", "7"))
    owing = F.col("principal_loan") + F.col("int_charge") - F.col("loan_repaid") - F.col("int_paid")
    members = (
        t.loan_summary.filter((F.col("is_active") == 1) & (owing >= 0.5))
        .join(excluded, "product_id", "left_anti")
        .select("office_id", "member_id")
        .distinct()
        .withColumn("owing", F.lit(1))
    )
    df = with_run(t.saving_summary, t, "left").join(members, ["office_id", "member_id"], "left")
    closing = _emptied() & (F.col("withdrawal") > 0) & F.col("owing").isNull()
    return _close_accounts(df, closing, t.saving_summary.columns)


# ---------------------------------------------------------------- members, centers, process


def drop_members(t: Tables) -> DataFrame:
    """Active members without any live loan or savings account are dropped."""
    owing = F.col("principal_loan") + F.col("int_charge") - F.col("loan_repaid") - F.col("int_paid")
    loans = t.loan_summary.filter(
        (F.col("is_active") == 1) & (F.col("posted") == 1) & ((F.col("loan_status") == 1) | (owing >= 0.5))
    ).select("office_id", "member_id")
    ignored = products_of(t, "product_code").filter(starts_with("product_code", "20"))
    savings = (
        t.saving_summary.filter((F.col("is_active") == 1) & ((F.col("saving_status") == 1) | (_balance() > 0)))
        .join(ignored, "product_id", "left_anti")
        .select("office_id", "member_id")
    )
    alive = loans.unionByName(savings).distinct().withColumn("alive", F.lit(1))
    df = with_run(t.members, t, "left").join(alive, ["office_id", "member_id"], "left")
    leaving = (
        F.col("run_date").isNotNull()
        & (F.col("is_active") == 1)
        & (F.col("member_status") == 1)
        & F.col("alive").isNull()
    )
    return set_where(df, leaving, member_status=2, release_date=F.col("run_date")).select(*t.members.columns)


def next_collection_date(t: Tables) -> DataFrame:
    """Centers with fortnightly loans today move 14 days on, or 28 where that day is a holiday."""
    run = t.run_control.select("office_id", F.col("business_date").alias("run_date"))
    next_holiday = (
        t.holidays.join(run, "office_id")
        .filter(F.col("business_date") == F.date_add("run_date", 14))
        .select("office_id", F.lit(1).alias("holiday"))
        .distinct()
    )
    fortnightly = products_of(t, "payment_frequency").filter("payment_frequency = 'F'")
    sheet = (
        t.daily_loan_trx.join(run, "office_id", "left_semi")
        .join(fortnightly, "product_id", "left_semi")
        .groupBy("office_id", "center_id")
        .agg(F.max("installment_date").alias("sheet_date"))
    )
    step = F.when(F.col("holiday") == 1, 28).otherwise(14)
    df = (
        t.centers.join(run, "office_id", "left")
        .join(next_holiday, "office_id", "left")
        .join(sheet, ["office_id", "center_id"], "left")
    )
    moved = F.col("sheet_date").isNotNull() & (F.col("collection_date") == F.col("run_date"))
    return set_where(df, moved, collection_date=F.date_add(F.col("sheet_date"), step)).select(*t.centers.columns)


def close_process(t: Tables) -> DataFrame:
    """The run date's process row is marked closed."""
    today = (F.col("business_date") == F.col("run_date")) & (F.col("initial_date") == F.col("run_date"))
    df = set_where(
        with_run(t.process_info, t, "left"),
        today,
        closing_status=1,
        initial_status=1,
        closing_date=F.col("run_date"),
    )
    return df.select(*t.process_info.columns)


def archive_collections(t: Tables) -> DataFrame:
    """Uploaded collections of the run's offices, for the history table."""
    return t.collection_loan_savings.join(t.run_control.select("office_id"), "office_id", "left_semi")


def remaining_collections(t: Tables) -> DataFrame:
    """Collections left after the archive."""
    return t.collection_loan_savings.join(t.run_control.select("office_id"), "office_id", "left_anti")


def raise_voucher_flag(t: Tables) -> DataFrame:
    """The voucher flag of the run's offices is 1."""
    run = t.run_control.select("office_id", F.lit(1).alias("in_run"))
    df = t.auto_voucher_check.join(run, "office_id", "left")
    return set_where(df, F.col("in_run") == 1, check_auto_voucher=1).drop("in_run")


def clear_day(t: Tables) -> Tables:
    """Both day tables without the run's offices."""
    run = t.run_control.select("office_id", "organization_id")
    keys = ["office_id", "organization_id"]
    return t.replace(
        daily_loan_trx=t.daily_loan_trx.join(run, keys, "left_anti"),
        daily_saving_trx=t.daily_saving_trx.join(run, keys, "left_anti"),
    )
