"""Adjustment of the day's loan transactions, run before vouchers and before day end.

The day's rows are summed once per loan (partial sums are combined before any shuffle); the sums are dealt once by loan
and the four shifts follow each other as columns, so the raw rows are read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.money import money, nz, zero
from ledgerloom.functions.text import joined_name, starts_with
from ledgerloom.operators.changes import products_of, set_where
from ledgerloom.sources.tables import Tables

# fixed values: transaction types and organizations named by the rules
ADJUSTMENT = 50
EXCESS_TO_SAVINGS = 32
NO_EXCESS_RULE_ORGANIZATION = 12
EXCESS_TO_SAVINGS_ORGANIZATION = 4

SUM_KEYS = [
    "office_id",
    "member_id",
    "loan_summary_id",
    "trx_date",
    "installment_date",
    "product_id",
    "product_code",
    "member_code",
    "organization_id",
]
SUMMED = ["loan_paid", "int_paid", "int_charge", "int_due"]
LATEST = ["installment_no", "member_name"]

#: Loans that one task settles. It sorts their rows for every grain, more of them than the bytes of a shuffle tell, so
#: the number of tasks follows the loans once that is above the session's number of shuffle partitions.
LOANS_A_TASK = 30_000


def _in_run(df: DataFrame, t: Tables) -> DataFrame:
    return df.join(t.run_control.select("office_id"), "office_id", "left_semi")


def dedupe_charges(t: Tables, rows: DataFrame | None = None) -> DataFrame:
    """Where a loan has several rows of one date with a due or charge, the row with the largest id loses it.

    ``rows``: those of the day's rows to return, all if not given.

    The ids are found by one aggregation that combines rows before they move, and the rows meet them by loan and date in
    the exchange of that aggregation, so no group of rows is sorted in one task for the rule. The result lies by loan:
    what is summed by loan later is combined to little more than a row a loan before it moves.
    """
    due = {
        "loan_due": F.col("loan_due") > 0,
        "int_due": F.col("int_due") > 0,
        "int_charge": (F.col("int_charge") > 0) & (F.col("trx_type") != 41),
    }
    # as a struct, NULLs of which are equal
    group = F.struct("loan_summary_id", "trx_date", "office_id").alias("_group")
    day = _in_run(t.daily_loan_trx, t).select("*", group)
    found = day.groupBy("_group").agg(
        *[F.max(F.when(test, F.col("daily_loan_trx_id"))).alias(f"last_{c}") for c, test in due.items()],
        *[F.count(F.when(test, F.lit(1))).alias(f"rows_{c}") for c, test in due.items()],
    )
    hits = found.select("_group", *[F.when(F.col(f"rows_{c}") > 1, F.col(f"last_{c}")).alias(f"zero_{c}") for c in due])
    hits = hits.filter(F.coalesce(*[F.col(f"zero_{c}") for c in due]).isNotNull())
    df = (t.daily_loan_trx if rows is None else rows).select("*", group).join(hits, "_group", "left")
    for c in due:
        df = set_where(df, F.col("daily_loan_trx_id") == F.col(f"zero_{c}"), **{c: 0})
    return df.select(*t.daily_loan_trx.columns)


def without_adjustments(t: Tables) -> Tables:
    """Both day tables without rows an earlier adjustment run may have added."""
    run = F.col("in_run") == 1
    offices = t.run_control.select("office_id", F.lit(1).alias("in_run"))

    def keep(df: DataFrame, kinds: Column) -> DataFrame:
        joined = df.join(offices, "office_id", "left")
        return joined.filter(~F.coalesce(run & kinds, F.lit(False))).drop("in_run")

    return t.replace(
        daily_loan_trx=keep(t.daily_loan_trx, F.col("trx_type").isin(ADJUSTMENT, 0)),
        daily_saving_trx=keep(t.daily_saving_trx, F.col("trans_type") == 0),
    )


def day_sums(t: Tables) -> DataFrame:
    """The day's loan rows, summed at the finest grain any rule groups by."""
    return (
        _in_run(t.daily_loan_trx, t)
        .groupBy(*SUM_KEYS)
        .agg(*[F.sum(c).alias(c) for c in SUMMED], *[F.max(c).alias(c) for c in LATEST])
    )


def _loans(t: Tables) -> DataFrame:
    return t.loan_summary.select(
        "loan_summary_id",
        "office_id",
        "center_id",
        "product_id",
        "member_id",
        "loan_term",
        "member_category_id",
        "purpose_id",
        "employee_id",
        "investor_id",
        "organization_id",
        "principal_loan",
        F.col("loan_repaid").alias("l_repaid"),
        F.col("int_charge").alias("l_charge"),
        F.col("int_paid").alias("l_paid"),
        F.col("installment_no").alias("l_installment_no"),
        "cum_int_due",
        "loan_status",
        "is_active",
    )


# A loan's rows meet once, dealt by office and loan; each grain below refines that, so its window needs no exchange.
_LOAN = ["office_id", "loan_summary_id"]
_MEMBER = [*_LOAN, "s_member_id"]
_DAY = [*_MEMBER, "s_trx_date", "s_installment_date", "s_product_code", "s_member_code"]
_DATE = [*_LOAN, "s_installment_date", "s_product_code", "s_member_code"]
_BALANCE = [*_DATE, "s_product_id", "s_organization_id"]
_ROW = [f"s_{c}" for c in SUM_KEYS if c not in _LOAN]


def _over(grain: list[str], **totals: Column) -> dict[str, Column]:
    return {name: total.over(Window.partitionBy(*grain)) for name, total in totals.items()}


def _first(grain: list[str]) -> Column:
    """Whether a row is the one that stands for its group."""
    rest = [c for c in _ROW if c not in grain]
    return F.row_number().over(Window.partitionBy(*grain).orderBy(*rest)) == 1


def _sum_of(*amounts: Column) -> Column:
    """Sum of two amounts that passes over NULL as an aggregate does."""
    first, second = amounts
    return F.coalesce(first + second, first, second)


def _loan_days(t: Tables, sums: DataFrame) -> DataFrame:
    """The day's sums (``s_``) beside their loan, and loans without any that are paid over their principal."""
    sheet_date = _in_run(t.daily_loan_trx, t).groupBy("office_id").agg(F.max("installment_date").alias("sheet_date"))
    offices = t.run_control.groupBy("office_id").agg(
        F.max(F.col("organization_id") != NO_EXCESS_RULE_ORGANIZATION).alias("has_excess_rule")
    )
    # a row per office of the run, so that loans need not be dealt by office to meet them
    offices = offices.join(sheet_date, "office_id", "left")
    offices = t.run_control.sparkSession.createDataFrame(offices.toArrow())
    product = products_of(t, F.col("product_code").alias("l_product_code"))
    method = t.products.select(
        F.col("product_id").alias("s_product_id"), F.col("interest_calculation_method").alias("s_method")
    )
    loans = _loans(t).join(offices, "office_id").join(product, "product_id", "left")
    day = sums.select(*[F.col(c) if c in _LOAN else F.col(c).alias(f"s_{c}") for c in sums.columns])
    day = day.join(method, "s_product_id", "left").withColumn("s_present", F.lit(True))
    tasks = t.loan_summary.count() // LOANS_A_TASK + 1
    if tasks > int(t.run_control.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        loans, day = loans.repartition(tasks, *_LOAN), day.repartition(tasks, *_LOAN)
    return loans.join(day, _LOAN, "left").filter(
        F.col("s_present") | (F.col("principal_loan") - F.col("l_repaid") < 0)
    )


def _settle_days(rows: DataFrame) -> DataFrame:
    """Rules 1 and 2, on a loan's sums of one day: ``moved_1`` and ``moved_2``, and ``moved_once`` on one row a group.

    A settled loan with overpaid principal moves the excess to interest; one with principal short and interest over
    moves interest to principal. The second is selected by the interest gap, but its amount is the principal gap.
    """
    rows = rows.withColumns(
        _over(
            _DAY,
            d_loan_paid=F.sum("s_loan_paid"),
            d_int_paid=F.sum("s_int_paid"),
            d_int_charge=F.sum("s_int_charge"),
            d_installment_no=F.max("s_installment_no"),
            d_member_name=F.max("s_member_name"),
        )
        | {"first_of_day": _first(_DAY)}
    )
    rows = rows.withColumns(
        {
            "principal_gap": F.col("principal_loan") - F.col("l_repaid") - F.col("d_loan_paid"),
            "interest_gap": F.col("l_charge") + F.col("d_int_charge") - F.col("l_paid") - F.col("d_int_paid"),
        }
    )
    own = F.col("s_member_id") == F.col("member_id")
    principal, interest = F.col("principal_gap"), F.col("interest_gap")
    over = own & (principal + interest < 0.5) & (principal < 0)
    rows = rows.withColumn("moved_1", F.when(over, money(principal)))
    principal, interest = principal - nz("moved_1"), interest + nz("moved_1")
    short = own & (principal + interest < 0.5) & (interest < 0.5) & (principal > 0) & (interest != 0)
    rows = rows.withColumn("moved_2", F.when(short, money(principal)))
    return rows.withColumn("moved_once", F.when(F.col("first_of_day"), _sum_of(F.col("moved_1"), F.col("moved_2"))))


def _settle_loans(rows: DataFrame) -> DataFrame:
    """Rule 3: an active loan (code not starting with 7) paid over its principal, with or without rows today.

    ``moved_3`` is the amount for a member's rows of the loan, ``loan_moved_3`` their sum over the loan.
    """
    rows = rows.withColumns(
        _over(_MEMBER, m_loan_paid=F.sum("s_loan_paid"), m_moved=F.sum("moved_once"))
        | {"first_of_member": _first(_MEMBER)}
    )
    gap = F.col("principal_loan") - (F.col("l_repaid") + nz("m_loan_paid") + nz("m_moved"))
    active = (F.col("is_active") == 1) & (F.col("loan_status") == 1) & ~starts_with("l_product_code", "7")
    rows = rows.withColumn("moved_3", F.when(active & (gap < 0), money(gap)))
    once = F.when(F.col("first_of_member"), F.col("moved_3"))
    return rows.withColumns(_over(_LOAN, loan_moved_3=F.sum(once)))


def _settle_excess(rows: DataFrame) -> DataFrame:
    """Rule 4: an unsettled loan with interest overpaid by at least 1 moves the rounded excess to principal.

    The sums count the rows added before. A row of rule 3 needs the loan's member and carries the member's code, which
    is looked up last, for added rows only. So there are two amounts: ``moved_4`` without that row and, where the
    rest of its key meets this group (``meets_3``), ``moved_4_after_3`` with it.
    """
    shifted = F.col("moved_once").isNotNull()
    rows = rows.withColumns(
        _over(
            _BALANCE,
            b_loan_paid=F.sum("s_loan_paid"),
            b_int_paid=F.sum("s_int_paid"),
            b_int_charge=F.sum("s_int_charge"),
            b_int_due=F.sum("s_int_due"),
            b_installment_no=F.max("s_installment_no"),
            b_member_name=F.max("s_member_name"),
        )
        | _over(
            _DATE,
            a_moved=F.sum("moved_once"),
            a_installment_no=F.max(F.when(shifted, F.col("d_installment_no"))),
            a_member_name=F.max(F.when(shifted, F.col("d_member_name"))),
        )
        | {"first_of_balance": _first(_BALANCE)}
    )
    belongs = F.col("s_product_id").eqNullSafe(F.col("product_id")) & F.col("s_organization_id").eqNullSafe(
        F.col("organization_id")
    )
    meets = (
        belongs
        & F.col("loan_moved_3").isNotNull()
        & F.col("s_installment_date").eqNullSafe(F.col("sheet_date"))
        & F.col("s_product_code").eqNullSafe(F.col("l_product_code"))
    )
    moved = F.when(belongs, F.col("a_moved"))
    rows = rows.withColumns(
        {
            "meets_3": meets,
            "b_loan_paid": _sum_of(F.col("b_loan_paid"), moved),
            "b_int_paid": _sum_of(F.col("b_int_paid"), -moved),
            "b_installment_no": F.greatest("b_installment_no", F.when(belongs, F.col("a_installment_no"))),
            "b_member_name": F.greatest("b_member_name", F.when(belongs, F.col("a_member_name"))),
        }
    )

    def excess_moved(loan_paid: Column, int_paid: Column) -> Column:
        principal = F.col("principal_loan") - F.col("l_repaid") - loan_paid
        excess = F.col("l_paid") + int_paid - F.col("l_charge") - F.col("b_int_charge")
        over_due = F.col("l_paid") + int_paid - (nz("cum_int_due") + F.col("b_int_due"))
        hit = (
            F.col("s_present")
            & F.col("has_excess_rule")
            & (principal - excess >= 0.5)
            & (excess >= 1)
            & (over_due >= 1)
            & (F.col("s_method") != "D")
        )
        amount = F.when(principal >= excess, excess).otherwise(excess - principal)
        return F.when(hit, money(F.round(amount, 0)))

    added = F.col("loan_moved_3")
    after = excess_moved(_sum_of(F.col("b_loan_paid"), added), _sum_of(F.col("b_int_paid"), -added))
    return rows.withColumns(
        {
            "moved_4": excess_moved(F.col("b_loan_paid"), F.col("b_int_paid")),
            "moved_4_after_3": F.when(meets, after),
        }
    )


def _shift(rule: int, moved: str, first: str, after_3: Column | None = None, **values: Column) -> Column:
    """One added row as a struct, NULL where the rule does not fire or another row stands for the group."""
    columns = {
        "rule": F.lit(rule),
        "moved": F.col(moved),
        "after_3": F.lit(None).cast("boolean") if after_3 is None else after_3,
        "product_id": F.col("product_id"),
        "organization_id": F.col("organization_id"),
        "trx_date": F.col("s_trx_date"),
        "installment_date": F.col("s_installment_date"),
        "product_code": F.col("s_product_code"),
        "member_code": F.col("s_member_code"),
    } | values
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return F.when(F.col(first) & F.col(moved).isNotNull(), row)


def shift_rows(t: Tables, sums: DataFrame, upto: int = 4) -> DataFrame:
    """The rows that the first ``upto`` of the four shifts add (type 50), with ``rule`` 1 to 4.

    Every rule sees the rows added before it. The sums meet their loans in one exchange; the rules follow as columns of
    that partitioning, a group's amount standing on one of its rows. Dues and charges of added rows stay NULL.
    """
    rows = _settle_days(_loan_days(t, sums))
    day = {"installment_no": F.col("d_installment_no"), "member_name": F.col("d_member_name")}
    found = [_shift(1, "moved_1", "first_of_day", **day), _shift(2, "moved_2", "first_of_day", **day)]
    if upto >= 3:
        rows = _settle_loans(rows)
        sheet = {
            "trx_date": F.col("sheet_date"),
            "installment_date": F.col("sheet_date"),
            "product_code": F.col("l_product_code"),
            "member_code": F.lit(None).cast("string"),
            "installment_no": F.col("l_installment_no"),
            "member_name": F.lit(None).cast("string"),
        }
        found.append(_shift(3, "moved_3", "first_of_member", **sheet))
    if upto >= 4:
        rows = _settle_excess(rows)
        balance = {
            "product_id": F.col("s_product_id"),
            "organization_id": F.col("s_organization_id"),
            "trx_date": F.col("s_installment_date"),
            "installment_no": F.col("b_installment_no"),
            "member_name": F.col("b_member_name"),
        }
        latest = balance | {"installment_no": F.greatest("b_installment_no", "l_installment_no")}
        apart = F.when(F.col("meets_3"), F.lit(False))
        found.append(_shift(4, "moved_4", "first_of_balance", apart, **balance))
        found.append(_shift(4, "moved_4_after_3", "first_of_balance", F.lit(True), **latest))
    kept = ["center_id", "member_id", "loan_term", "member_category_id", "purpose_id", "employee_id", "investor_id"]
    added = rows.select(*_LOAN, *kept, F.explode(F.array_compact(F.array(*found[: upto if upto < 4 else 5]))).alias("row"))
    members = t.members.select(
        "member_id", F.col("member_code").alias("m_code"), joined_name(" ").alias("full_name"), F.lit(True).alias("found")
    )
    added = added.select(*_LOAN, *kept, "row.*").join(members, "member_id", "left")
    is_3, known = F.col("rule") == 3, F.coalesce(F.col("found"), F.lit(False))
    with_3 = known & F.col("member_code").eqNullSafe(F.col("m_code"))
    added = added.filter(F.when(is_3, known).otherwise(F.col("after_3").isNull() | (F.col("after_3") == with_3)))
    name = F.when(F.col("after_3"), F.greatest("member_name", "full_name")).otherwise(F.col("member_name"))
    return added.select(
        "rule",
        *_LOAN,
        "center_id",
        "product_id",
        "member_id",
        "loan_term",
        money(F.col("moved")).alias("loan_paid"),
        money(-F.col("moved")).alias("int_paid"),
        "trx_date",
        "installment_date",
        "installment_no",
        F.when(is_3, F.col("full_name")).otherwise(name).alias("member_name"),
        "member_category_id",
        "purpose_id",
        "employee_id",
        "investor_id",
        F.lit(ADJUSTMENT).alias("trx_type"),
        "product_code",
        F.when(is_3, F.col("m_code")).otherwise(F.col("member_code")).alias("member_code"),
        "organization_id",
    )


def shifts(t: Tables, sums: DataFrame, upto: int = 4) -> list[DataFrame]:
    """The rows of :func:`shift_rows`, one frame a rule."""
    rows = shift_rows(t, sums, upto)
    return [rows.filter(F.col("rule") == rule).drop("rule") for rule in range(1, upto + 1)]


# ---------------------------------------------------------------- overpayment to savings


def overpaid_loans(t: Tables) -> DataFrame:
    """Loans overpaid by at least 1.00, with the (negative) amount outstanding."""
    organization = t.run_control.filter(F.col("organization_id") == EXCESS_TO_SAVINGS_ORGANIZATION)
    run = organization.select("office_id", F.col("business_date").alias("run_date"))
    day = (
        t.daily_loan_trx.filter(F.col("trx_type") != EXCESS_TO_SAVINGS)
        .join(run.select("office_id"), "office_id", "left_semi")
        .groupBy("loan_summary_id")
        .agg(*[F.sum(c).alias(f"d_{c}") for c in ("loan_paid", "int_paid", "int_charge")])
    )
    amount = (
        F.col("principal_loan")
        + F.round(F.col("int_charge") + F.col("d_int_charge"), 0)
        - F.col("loan_repaid")
        - F.col("int_paid")
        - F.col("d_loan_paid")
        - F.col("d_int_paid")
    )
    loans = t.loan_summary.join(run, "office_id").select(
        "loan_summary_id",
        "organization_id",
        "office_id",
        "center_id",
        "member_id",
        "product_id",
        "loan_term",
        "member_category_id",
        "purpose_id",
        "employee_id",
        "investor_id",
        "loan_no",
        "duration",
        "installment_no",
        "principal_loan",
        "loan_repaid",
        "int_charge",
        "int_paid",
        "run_date",
    )
    return loans.join(day, "loan_summary_id").withColumn("amount", money(amount)).filter(F.col("amount") <= -1)


def _compulsory_accounts(t: Tables, saving_summary: DataFrame) -> DataFrame:
    compulsory = products_of(t, "product_code", "product_name").filter(starts_with("product_code", "21"))
    return saving_summary.filter("is_active = 1 AND saving_status = 1").join(compulsory, "product_id")


#: Room for days since 1970 in the key of an account opened on overpayment.
DAYS_IN_KEY = 100_000


def open_savings_for_overpaid(t: Tables, overpaid: DataFrame) -> DataFrame:
    """A savings account (number 2) per overpaid loan whose member has no active compulsory savings.

    The new account's key is made of the loan's key and the run date, negated: apart from existing keys, and from the
    account that an earlier overpayment of the same loan opened.
    """
    members = t.members.select(
        "office_id", "member_id", F.col("center_id").alias("m_center"), "member_category_id",
        F.col("organization_id").alias("m_organization"),
    )
    categories = t.member_categories.select(
        "member_category_id", F.col("category_short_name_bng").alias("product_code")
    )
    held = _compulsory_accounts(t, t.saving_summary).select("office_id", "member_id").distinct()
    loans = overpaid.select("loan_summary_id", "office_id", "member_id", "employee_id", "run_date")
    rows = (
        loans.join(held, ["office_id", "member_id"], "left_anti")
        .join(members, ["office_id", "member_id"])
        .join(categories, "member_category_id")
        .join(t.products.select("product_code", "product_id", "interest_rate"), "product_code")
    )
    set_columns = {
        "saving_summary_id": -(F.col("loan_summary_id") * DAYS_IN_KEY + F.unix_date("run_date")),
        "organization_id": F.col("m_organization"),
        "center_id": F.col("m_center"),
        "no_of_account": F.lit(2),
        "transaction_date": F.col("run_date"),
        "opening_date": F.col("run_date"),
        "closing_date": F.lit(None),
        "trans_type": F.lit(0),
        "saving_status": F.lit(1),
        "is_active": F.lit(1),
    }
    carried = {"office_id", "member_id", "product_id", "interest_rate", "employee_id", "member_category_id"}
    columns = []
    for name, kind in t.saving_summary.dtypes:
        value = set_columns.get(name, F.col(name) if name in carried else F.lit(0))
        columns.append(value.cast(kind).alias(name))
    return rows.select(*columns)


def deposit_overpaid(t: Tables, overpaid: DataFrame, saving_summary: DataFrame) -> DataFrame:
    """A deposit of the overpaid amount into every active compulsory account of the member.

    ``saving_summary`` already holds the accounts opened for overpaid loans.
    """
    members = t.members.select("office_id", "member_id", "member_code", joined_name("").alias("full_name"))
    accounts = _compulsory_accounts(t, saving_summary)
    loans = overpaid.select("office_id", "member_id", "amount", "run_date", "loan_summary_id")
    rows = loans.join(members, ["office_id", "member_id"]).join(accounts, ["office_id", "member_id"])
    return rows.select(
        "saving_summary_id",
        "organization_id",
        "office_id",
        "member_id",
        "product_id",
        "center_id",
        "no_of_account",
        F.col("run_date").alias("transaction_date"),
        zero().alias("due_saving_installment"),
        money(F.abs("amount")).alias("saving_installment"),
        *[zero().alias(c) for c in ("deposit", "withdrawal")],
        F.lit(0).cast("decimal(20,2)").alias("balance"),
        zero().alias("penalty"),
        F.lit(EXCESS_TO_SAVINGS).alias("trans_type"),
        zero().alias("monthly_interest"),
        F.lit(0).alias("presence_ind"),
        *[zero().alias(c) for c in ("transfer_deposit", "transfer_withdrawal")],
        "member_code",
        F.col("full_name").alias("member_name"),
        "employee_id",
        "member_category_id",
        "product_code",
        "product_name",
    )


def contra_overpaid(t: Tables, overpaid: DataFrame) -> DataFrame:
    """The loan-side contra row: the negative amount as interest paid."""
    members = t.members.select("office_id", "member_id", "member_code", joined_name("").alias("full_name"))
    products = products_of(t, "product_code", "product_name", "interest_calculation_method")
    zeros = ("principal_loan", "loan_repaid", "loan_due", "loan_paid", "cum_int_charge", "int_charge", "int_due")
    rows = overpaid.join(members, ["office_id", "member_id"]).join(products, "product_id")
    return rows.select(
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
        *[zero().alias(c) for c in zeros],
        F.col("amount").alias("int_paid"),
        zero().alias("advance"),
        zero().alias("due_recovery"),
        F.lit(EXCESS_TO_SAVINGS).alias("trx_type"),
        "installment_no",
        "employee_id",
        "member_code",
        F.col("full_name").alias("member_name"),
        "product_code",
        "product_name",
        "interest_calculation_method",
        "investor_id",
        "loan_no",
        "duration",
    )


def deactivate_details(t: Tables) -> DataFrame:
    """Voucher lines of inactive vouchers become inactive."""
    inactive = _in_run(t.acc_trx_master, t).filter("is_active = 0")
    inactive = inactive.select("trx_master_id", F.lit(1).alias("void")).distinct()
    df = t.acc_trx_detail.join(inactive, "trx_master_id", "left")
    return set_where(df, F.col("void") == 1, is_active=0).select(*t.acc_trx_detail.columns)
