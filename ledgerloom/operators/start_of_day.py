"""Start of day: the expected collection sheet of every office, and the corrections applied to it.

The sheet of savings (two parts) and of loans (two parts) is built in one pass each; the five loan corrections share
one join of the sheet to its loans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import formulas
from ledgerloom.functions.dates import first_date, last_date, week_day
from ledgerloom.functions.money import money, zero
from ledgerloom.functions.text import member_name, starts_with
from ledgerloom.operators.changes import (
    LOAN_KEYS,
    MEMBER_KEYS,
    drop_keys,
    drop_where,
    lookup,
    products_of,
    set_where,
    with_run,
    without_run,
)
from ledgerloom.sources.tables import Tables

# fixed values: organization whose past-duration loans stop accruing on the sheet
STOP_CHARGE_ORGANIZATION = 5

#: Copies of a sheet row that one task makes at a time.
COPIES = 1000


def _outside_month(day: Column, of: Column) -> Column:
    return (day < first_date(of)) | (day > last_date(of))


# ---------------------------------------------------------------- savings sheet


def _monthly_loans_per_member(t: Tables) -> DataFrame:
    """Per member: number of running monthly loans whose last instalment lies outside the run month.

    The sheet joins this to savings rows that already passed the center and member lookups on the same keys, so those
    lookups are not repeated here. Counting instead of listing keeps a member with very many loans to one row.
    """
    monthly = lookup(products_of(t, "payment_frequency")).filter("payment_frequency = 'M'")
    return (
        with_run(t.loan_summary, t)
        .filter(
            (F.col("loan_status") == 1)
            & (F.col("is_active") == 1)
            & (F.col("installment_no") < F.col("duration"))
            & (F.col("installment_start_date") <= F.col("run_date"))
            & F.col("disburse_date").isNotNull()
            & _outside_month(F.col("installment_date"), F.col("run_date"))
        )
        .join(monthly, "product_id", "left_semi")
        .groupBy(*MEMBER_KEYS)
        .agg(F.count(F.lit(1)).alias("monthly_loans"))
    )


def _collected_savings(t: Tables) -> DataFrame:
    """Active savings whose center collects on the run's week day, with product and member attributes."""
    members = lookup(t.members).select(
        *MEMBER_KEYS,
        "member_code",
        member_name().alias("member_name"),
        F.col("member_category_id").alias("m_category"),
    )
    return (
        with_run(t.saving_summary, t)
        .filter("saving_status = 1 AND is_active = 1")
        .join(t.centers.select("center_id", "office_id", "collection_day"), ["center_id", "office_id"])
        .filter(F.col("collection_day") == week_day(F.col("run_date")))
        .join(
            lookup(
                products_of(
                    t, "product_code", "product_name", "payment_frequency", "main_product_code", "sub_main_category"
                )
            ),
            "product_id",
        )
        .join(members, MEMBER_KEYS)
    )


def _savings_rows(df: DataFrame, transaction_date: Column, with_cur_interest: bool = True) -> DataFrame:
    """Savings sheet layout; the accumulated interest is not carried for long-term savings."""
    cur_interest = F.col("monthly_interest") if with_cur_interest else F.lit(None).cast("decimal(18,2)")
    return df.select(
        F.lit(None).cast("bigint").alias("daily_saving_trx_id"),
        "saving_summary_id",
        "organization_id",
        "office_id",
        "member_id",
        "product_id",
        "center_id",
        "no_of_account",
        transaction_date.alias("transaction_date"),
        F.col("saving_installment").alias("due_saving_installment"),
        "saving_installment",
        "deposit",
        zero().alias("withdrawal"),
        (F.col("deposit") + F.col("cum_interest") - F.col("withdrawal")).cast("decimal(20,2)").alias("balance"),
        zero().alias("penalty"),
        F.lit(10).alias("trans_type"),
        zero().alias("monthly_interest"),
        F.lit(1).alias("presence_ind"),
        F.col("cum_interest").alias("transfer_deposit"),
        F.col("withdrawal").alias("transfer_withdrawal"),
        "member_code",
        "member_name",
        "employee_id",
        F.col("m_category").alias("member_category_id"),
        "product_code",
        "product_name",
        F.lit(None).cast("string").alias("bank_name"),
        cur_interest.alias("cur_interest"),
    )


def weekly_savings(t: Tables) -> DataFrame:
    """Weekly savings of members without a monthly loan to be collected outside the month (part 1)."""
    rows = _collected_savings(t).filter("payment_frequency = 'W'")
    return _savings_rows(
        rows.join(_monthly_loans_per_member(t), MEMBER_KEYS, "left_anti"), F.col("transaction_date")
    )


def repeated(rows: DataFrame, times: str) -> DataFrame:
    """Every row as often as its column ``times`` says.

    Rows with many copies are first cut into blocks of ``COPIES`` and the blocks dealt over tasks, so that the copies
    of one row never come from one task. Only those few rows are exchanged.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    few, many = rows.filter(F.col(times).between(1, COPIES)), rows.filter(F.col(times) > COPIES)

    def numbers(count: Column) -> Column:
        return F.explode(F.sequence(F.lit(1).cast("bigint"), count.cast("bigint")))

    blocks = many.withColumn("block", numbers(F.ceil(F.col(times) / COPIES)))
    dealt = blocks.repartition(tasks, F.xxhash64(*rows.columns), "block")
    size = F.least(F.lit(COPIES), F.col(times) - (F.col("block") - 1) * COPIES)
    return few.withColumn("copy", numbers(F.col(times))).drop("copy").unionByName(
        dealt.withColumn("copy", numbers(size)).drop("block", "copy")
    )


def compulsory_savings(t: Tables) -> DataFrame:
    """Compulsory savings of the members part 1 leaves out, once per such loan (part 2)."""
    rows = (
        _collected_savings(t)
        .filter((F.col("payment_frequency") == "W") & starts_with("main_product_code", "21"))
        .join(_monthly_loans_per_member(t), MEMBER_KEYS)
    )
    return _savings_rows(repeated(rows, "monthly_loans"), F.col("run_date"))


def savings_sheet(t: Tables) -> DataFrame:
    """Parts 1 and 2 in one pass over the savings accounts."""
    rows = (
        _collected_savings(t)
        .filter("payment_frequency = 'W'")
        .join(_monthly_loans_per_member(t), MEMBER_KEYS, "left")
        .filter(F.col("monthly_loans").isNull() | starts_with("main_product_code", "21"))
        .withColumn("copies", F.coalesce("monthly_loans", F.lit(1).cast("bigint")))
    )
    rows = repeated(rows, "copies")
    part = F.when(F.col("monthly_loans").isNull(), F.col("transaction_date")).otherwise(F.col("run_date"))
    return _savings_rows(rows, part)


def lts_savings(t: Tables) -> DataFrame:
    """Long-term (DPS) savings of members who have a loan row due on the run date."""
    due = with_run(t.daily_loan_trx, t).filter(F.col("installment_date") == F.col("run_date"))
    due = due.join(lookup(products_of(t)), "product_id", "left_semi")
    rows = (
        _collected_savings(t)
        .filter("payment_frequency = 'M' AND sub_main_category = 'DPS'")
        .join(due.select(*MEMBER_KEYS).distinct(), MEMBER_KEYS, "left_semi")
    )
    return _savings_rows(rows, F.col("run_date"), with_cur_interest=False)


# ---------------------------------------------------------------- loan sheet


def _collectable_loans(t: Tables) -> DataFrame:
    """Active disbursed loans whose center collects on the run's week day."""
    return (
        with_run(t.loan_summary, t)
        .filter("is_active = 1 AND loan_status = 1 AND disburse_date IS NOT NULL")
        .join(t.centers.select("center_id", "office_id", "collection_day"), ["center_id", "office_id"])
        .filter(F.col("collection_day") == week_day(F.col("run_date")))
        .join(
            lookup(
                products_of(t, "product_code", "product_name", "interest_calculation_method", "payment_frequency")
            ),
            "product_id",
        )
    )


def _is_weekly_row() -> Column:
    """Weekly or monthly loans, except those that have not started.

    The exclusion is a key set taken from the same table by its own key, so it is a test on the row itself.
    """
    not_started = (F.col("installment_no") == 0) & (F.col("installment_start_date") > F.col("run_date"))
    return F.col("payment_frequency").isin("W", "M") & ~F.coalesce(not_started, F.lit(False))


def _is_monthly_row() -> Column:
    return (
        _outside_month(F.col("installment_date"), F.col("run_date"))
        & (F.col("installment_no") < F.col("duration"))
        & (F.col("installment_start_date") < F.col("run_date"))
    )


def _loan_rows(t: Tables, loans: DataFrame) -> DataFrame:
    """Loan sheet layout for rows labelled by ``part`` (0 weekly, 1 monthly)."""
    members = lookup(t.members).select(*MEMBER_KEYS, "member_code", member_name().alias("member_name"))
    terms = formulas.LoanTerms()

    def amount(name: str) -> Column:
        return F.coalesce(formulas.FORMULAS[name](terms), zero()).alias(name)

    def weekly_amount(name: str) -> Column:
        return F.when(F.col("part") == 0, F.coalesce(formulas.FORMULAS[name](terms), zero())).alias(name)

    before_start = F.col("run_date") < F.col("installment_start_date")
    rows = formulas.with_terms(loans.join(members, MEMBER_KEYS), F.col("run_date"))
    return rows.select(
        (F.col("loan_summary_id") * 2 + F.col("part")).alias("daily_loan_trx_id"),
        F.col("run_date").alias("trx_date"),
        "loan_summary_id",
        "organization_id",
        "office_id",
        "member_id",
        "product_id",
        "center_id",
        "member_category_id",
        "loan_term",
        "purpose_id",
        F.col("run_date").alias("installment_date"),
        "principal_loan",
        "loan_repaid",
        amount("loan_due"),
        amount("loan_paid"),
        amount("cum_int_charge"),
        amount("int_charge"),
        amount("int_due"),
        amount("int_paid"),
        "advance",
        F.col("int_paid").alias("due_recovery"),
        F.lit(10).alias("trx_type"),
        F.when(before_start, F.col("installment_no")).otherwise(F.col("installment_no") + 1).alias("installment_no"),
        "employee_id",
        "member_code",
        "member_name",
        "product_code",
        "product_name",
        "interest_calculation_method",
        "investor_id",
        "loan_no",
        "duration",
        weekly_amount("duration_over_loan_due"),
        weekly_amount("duration_over_int_due"),
    )


def weekly_loans(t: Tables) -> DataFrame:
    return _loan_rows(t, _collectable_loans(t).filter(_is_weekly_row()).withColumn("part", F.lit(0)))


def monthly_loans(t: Tables) -> DataFrame:
    return _loan_rows(t, _collectable_loans(t).filter(_is_monthly_row()).withColumn("part", F.lit(1)))


def loan_sheet(t: Tables) -> DataFrame:
    """Both parts in one pass; a loan that qualifies for both yields two rows, as a later step expects."""
    parts = F.array(F.when(_is_weekly_row(), F.lit(0)), F.when(_is_monthly_row(), F.lit(1)))
    rows = _collectable_loans(t).withColumn("part", F.explode(F.array_compact(parts)))
    return _loan_rows(t, rows)


# ---------------------------------------------------------------- corrections of the loan sheet


def _with_loan(t: Tables) -> DataFrame:
    """Sheet rows of the run with their loan's attributes as ``l_`` columns and the product's codes."""
    loans = t.loan_summary.select(
        "loan_summary_id",
        *[F.col(c).alias(f"l_{c}") for c in LOAN_KEYS if c != "loan_summary_id"],
        *[
            F.col(c).alias(f"l_{c}")
            for c in (
                "organization_id",
                "installment_no",
                "duration",
                "loan_status",
                "principal_loan",
                "loan_repaid",
                "int_charge",
                "cum_loan_due",
                "cum_int_due",
            )
        ],
    )
    products = products_of(
        t, F.col("payment_frequency").alias("p_frequency"), F.col("main_product_code").alias("p_main_code")
    )
    run = t.run_control.select(
        "office_id", F.col("organization_id").alias("run_org"), F.col("business_date").alias("run_date")
    )
    return (
        t.daily_loan_trx.join(run, "office_id", "left")
        .join(lookup(loans), "loan_summary_id", "left")
        .join(lookup(products), "product_id", "left")
    )


def _same_loan() -> Column:
    matches = [F.col(c) == F.col(f"l_{c}") for c in LOAN_KEYS if c != "loan_summary_id"]
    condition = F.col("run_date").isNotNull()
    for match in matches:
        condition = condition & match
    return condition


def _set_final_paid(df: DataFrame) -> DataFrame:
    final = _same_loan() & (F.col("l_installment_no") + 1 == F.col("l_duration"))
    return set_where(df, final, loan_paid=F.col("l_principal_loan") - F.col("l_loan_repaid"))


def _zero_overdue(df: DataFrame) -> DataFrame:
    overdue = (
        _same_loan()
        & (F.col("organization_id") == F.col("run_org"))
        & (F.col("l_installment_no") >= F.col("l_duration"))
        & (F.col("l_loan_status") == 1)
        & (F.col("p_frequency") == "W")
    )
    return set_where(df, overdue, loan_due=0, int_due=0, loan_paid=0, int_paid=0)


def _zero_lift_loans(df: DataFrame) -> DataFrame:
    first_half = (F.col("l_installment_no") + 1) * 2 <= F.col("l_duration")
    # the code's tail from its second character on, not a prefix
    lift = F.expr("substring(p_main_code, 2)") == "11"
    lifted = _same_loan() & (F.col("installment_date") == F.col("run_date")) & lift & first_half
    return set_where(df, lifted, loan_due=0, int_due=0, loan_paid=0, int_paid=0)


def _stop_charge(df: DataFrame) -> DataFrame:
    over = (
        _same_loan()
        & (F.col("run_org") == STOP_CHARGE_ORGANIZATION)
        & (F.col("installment_date") == F.col("run_date"))
        & (F.col("l_installment_no") >= F.col("l_duration"))
        & (F.col("l_organization_id") == F.col("run_org"))
        & F.col("p_frequency").isNotNull()
    )
    return set_where(df, over, int_charge=0, cum_int_charge=F.col("l_int_charge"))


def _set_last_installment(df: DataFrame) -> DataFrame:
    last = (
        (F.col("installment_date") == F.col("run_date"))
        & (F.col("installment_no") == F.col("l_duration"))
        & (F.col("l_office_id") == F.col("office_id"))
        & (F.col("l_organization_id") == F.col("run_org"))
    )
    principal = F.col("l_principal_loan") - F.col("l_cum_loan_due")
    interest = F.col("cum_int_charge") - F.col("l_cum_int_due")
    return set_where(df, last, loan_paid=principal, loan_due=principal, int_paid=interest, int_due=interest)


def _corrected(t: Tables, *steps) -> DataFrame:
    df = _with_loan(t)
    for step in steps:
        df = step(df)
    return df.select(*t.daily_loan_trx.columns)


def final_installment_paid(t: Tables) -> DataFrame:
    """On the last instalment the expected principal is the whole balance."""
    return _corrected(t, _set_final_paid)


def reset_overdue(t: Tables) -> DataFrame:
    """Weekly loans past their duration are not expected to pay."""
    return _corrected(t, _zero_overdue)


def lift_loan_zero(t: Tables) -> DataFrame:
    """Lift loans pay nothing in the first half of their duration."""
    return _corrected(t, _zero_lift_loans)


def stop_charge(t: Tables) -> DataFrame:
    """For one organization, loans past their duration carry no new charge."""
    return _corrected(t, _stop_charge)


def last_installment(t: Tables) -> DataFrame:
    """On the numbered last instalment everything not yet due falls due."""
    return _corrected(t, _set_last_installment)


def corrections_before_exclusions(t: Tables) -> DataFrame:
    return _corrected(t, _set_final_paid, _zero_overdue)


def corrections_after_exclusions(t: Tables) -> DataFrame:
    return _corrected(t, _zero_lift_loans, _stop_charge, _set_last_installment)


# ---------------------------------------------------------------- exclusions


def drop_holiday_rows(t: Tables) -> Tables:
    """Both sheets without the centers that are on an office holiday and have a loan row."""
    holidays = (
        t.holidays.filter("holiday_type = 'Office'")
        .join(t.run_control.select("office_id", F.col("business_date").alias("run_date")), "office_id")
        .filter(F.col("business_date") == F.col("run_date"))
        .select("office_id", "center_id")
        .distinct()
    )
    keys = ["office_id", "center_id"]
    listed = with_run(t.daily_loan_trx, t).join(holidays, keys, "left_semi")
    closed = listed.select(*keys, "organization_id").distinct()
    keys = [*keys, "organization_id"]
    return t.replace(
        daily_loan_trx=drop_keys(t.daily_loan_trx, closed, keys),
        daily_saving_trx=drop_keys(t.daily_saving_trx, closed, keys),
    )


def drop_expired_loans(t: Tables) -> DataFrame:
    """Loan rows without members who died after a disbursement."""
    expired = t.expire_infos.join(t.run_control.select("office_id"), "office_id", "left_semi")
    expired = t.loan_summary.select(*MEMBER_KEYS, "disburse_date").join(expired, MEMBER_KEYS)
    expired = expired.filter(F.col("expire_date") > F.col("disburse_date"))
    return drop_keys(t.daily_loan_trx, expired, MEMBER_KEYS)


def drop_family_grace(t: Tables) -> Tables:
    """Both sheets without married members inside a family grace period who have a loan row."""
    grace = (
        with_run(t.family_grace, t)
        .filter(F.col("run_date").between(F.col("grace_start_date"), F.col("grace_end_date")))
        .join(lookup(t.members).filter("marital_status = 1"), MEMBER_KEYS, "left_semi")
        .select(*MEMBER_KEYS)
    )
    listed = t.daily_loan_trx.join(grace, MEMBER_KEYS, "left_semi")
    return t.replace(
        daily_loan_trx=drop_keys(t.daily_loan_trx, grace, MEMBER_KEYS),
        daily_saving_trx=drop_keys(t.daily_saving_trx, listed, MEMBER_KEYS),
    )


# ---------------------------------------------------------------- state tables


def pending_disbursement(t: Tables) -> DataFrame:
    """Loans to be disbursed on the run date become pending."""
    due = F.col("disburse_date") == F.col("run_date")
    nothing = F.lit(None)
    df = set_where(
        with_run(t.loan_summary, t, "left"),
        due,
        disburse_date=nothing,
        installment_start_date=nothing,
        int_charge=0,
        is_approved=0,
    )
    return df.select(*t.loan_summary.columns)


def reset_partial(t: Tables) -> DataFrame:
    """Partial disbursement amounts of active type-2 loans start the day at zero."""
    partial = F.col("run_date").isNotNull() & (F.col("is_active") == 1) & (F.col("disbursement_type") == 2)
    df = with_run(t.loan_summary, t, "left")
    df = set_where(df, partial, partial_amount=0, partial_int_charge=0, partial_int_paid=0)
    return df.select(*t.loan_summary.columns)


def clear_collections(t: Tables) -> DataFrame:
    """Collections of the run date are removed before the day starts."""
    df = with_run(t.collection_loan_savings, t, "left")
    return without_run(drop_where(df, F.col("collection_date") == F.col("run_date")))


def new_process(t: Tables) -> DataFrame:
    """A process row for each office without one for the run date; the process run deals the keys."""
    nothing = F.lit(None).cast("date")
    missing = t.run_control.join(
        t.process_info.select("office_id", "business_date"), ["office_id", "business_date"], "left_anti"
    )
    return missing.select(
        F.lit(None).cast("bigint").alias("process_info_id"),
        "office_id",
        "organization_id",
        "business_date",
        F.col("business_date").alias("initial_date"),
        nothing.alias("closing_date"),
        F.lit(0).alias("closing_status"),
        F.lit(0).alias("initial_status"),
        F.lit(0).alias("month_closing_status"),
        nothing.alias("month_closing_date"),
    )


def open_process(t: Tables) -> DataFrame:
    """A process row per office for the run date, added where none exists."""
    return t.process_info.unionByName(new_process(t))


def voucher_flag_reset(t: Tables) -> DataFrame:
    """The voucher flag of each office goes to 0; an office with no raised flag gets a new 0 row."""
    raised = t.auto_voucher_check.filter("check_auto_voucher = 1").select("office_id").distinct()
    raised = raised.join(t.run_control.select("office_id"), "office_id", "left_semi")
    lowered = t.auto_voucher_check.join(raised.withColumn("raised", F.lit(1)), "office_id", "left")
    lowered = set_where(lowered, F.col("raised") == 1, check_auto_voucher=0).drop("raised")
    added = t.run_control.join(raised, "office_id", "left_anti").select(
        "office_id", F.lit(0).alias("check_auto_voucher")
    )
    return lowered.unionByName(added)
