"""Automatic vouchers: the day's transactions as double-entry lines.

Each source table is summed once to (office, product, type[, bank]) - a size set by the chart of products, not by the
number of transactions - and all 32 rules and 28 gates work on those sums, most of
them through one join with the rule table.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.functions.money import MONEY, RATE, WHOLE, nz
from ledgerloom.functions.text import starts_with, voucher_with_last_year
from ledgerloom.operators import voucher_rules as R
from ledgerloom.operators.changes import by_shuffle, on_run_date, products_of, set_where, split_by_run_date, with_run
from ledgerloom.operators.voucher_control import offices_with_vouchers, with_vouchers
from ledgerloom.sources.tables import Tables

ALL_RULES = frozenset(R.GATE_OF_RULE)
Wanted = frozenset[str]

LINE_COLUMNS = ["office_id", "rule", "batch", "gate", "voucher_category", "acc_id", "amount", "side", "narration"]


def _run(t: Tables) -> DataFrame:
    return t.run_control.select(
        "office_id", F.col("organization_id").alias("run_org"), F.col("business_date").alias("run_date")
    )


def _gates_of(only: Wanted) -> set[str]:
    return {R.GATE_OF_RULE[rule] for rule in only}


def _sources_of(only: Wanted) -> set[str]:
    """Amount sources the wanted rules and their gates read."""
    gates = _gates_of(only)
    named = {rule: {source} for rule, source, _ in R.NAMED_AMOUNTS}
    named |= {rule: sources for rule, sources in R.OTHER_SOURCES.items()}
    return (
        {r.source for r in R.RULES if r.rule in only}
        | {g.source for g in R.GATES if g.gate in gates}
        | {source for source, gate in R.ROW_GATES if gate in gates}
        | {source for rule in only for source in named.get(rule, set())}
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# ---------------------------------------------------------------- sums per source


def _amounts(df: DataFrame, source: Column, names: list[str]) -> DataFrame:
    """One row per named amount: (source, office, product, type, bank, amount_name, amount)."""
    cells = [F.struct(F.lit(n).alias("amount_name"), F.col(n).cast("decimal(38,2)").alias("amount")) for n in names]
    return df.select(
        source.alias("source"), "office_id", "product_id", "type", "bank_name", F.inline(F.array(*cells))
    )


def _loan_amounts(t: Tables) -> DataFrame:
    sums = (
        with_run(t.daily_loan_trx, t)
        .groupBy("office_id", "product_id", F.col("trx_type").cast("string").alias("type"))
        .agg(F.sum(nz("loan_paid")).alias("loan_paid"), F.sum(nz("int_paid")).alias("int_paid"))
        .withColumn("bank_name", F.lit(None).cast("string"))
    )
    return _amounts(sums, F.lit("dlt"), ["loan_paid", "int_paid"])


def _saving_amounts(t: Tables) -> DataFrame:
    sums = (
        with_run(t.daily_saving_trx, t)
        .groupBy("office_id", "product_id", F.col("trans_type").cast("string").alias("type"), "bank_name")
        .agg(
            F.sum(nz("saving_installment")).alias("installment"),
            F.sum(nz("penalty")).alias("penalty"),
            F.sum(nz("monthly_interest")).alias("interest"),
            F.sum(nz("withdrawal")).alias("withdrawal"),
        )
    )
    with_penalty = F.col("installment") + F.col("penalty")
    sums = sums.withColumns(
        {"installment_penalty": with_penalty, "installment_penalty_interest": with_penalty + F.col("interest")}
    )
    names = ["installment", "withdrawal", "interest", "installment_penalty", "installment_penalty_interest"]
    return _amounts(sums, F.lit("dst"), names)


def _disbursement_amounts(t: Tables) -> DataFrame:
    """Loans disbursed on the run date; one sum can serve several rule sources, depending on the loans' state."""
    loans = t.loan_summary.join(_run(t), "office_id").filter(F.col("disburse_date") == F.col("run_date"))
    active = (F.col("is_active") == 1) & (F.col("loan_status") == 1)
    live = (
        active
        & (F.col("installment_date") == F.col("run_date"))
        & (F.col("organization_id") == F.col("run_org"))
    )
    kind = F.col("disbursement_type")
    unposted = F.col("posted") == 0
    tests = {
        "full": live & unposted & (kind != 2),
        "partial": live & (kind == 2),
        "type_one": live & unposted & (kind == 1),
        "adjusted": live & unposted,
        "fund": active & unposted,
        "any_partial": kind == 2,
    }
    sources = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests.items()]))
    sums = loans.groupBy(
        "office_id", "product_id", F.col("trans_type").alias("type"), "bank_name", sources.alias("sources")
    ).agg(
        F.sum("principal_loan").alias("principal"),
        F.sum("partial_amount").alias("partial"),
        F.sum("int_installment").alias("int_installment"),
        F.sum("partial_int_paid").alias("partial_interest"),
        F.count(F.lit(1)).alias("loans"),
    )
    sums = sums.withColumn("source", F.explode("sources"))
    names = ["principal", "partial", "int_installment", "partial_interest", "loans"]
    return _amounts(sums, F.col("source"), names)


def _misc_amounts(t: Tables) -> DataFrame:
    """Active miscellaneous receipts of the run date per product."""
    rows = on_run_date(t.miscellaneous.filter("is_active = 1"), t, "trx_date").join(_run(t), "office_id")
    rows = rows.filter(F.col("trx_date") == F.col("run_date"))
    sums = rows.groupBy("office_id", "product_id").agg(F.sum("amount").alias("receipts"))
    return _amounts(_without_type(sums), F.lit("misc"), ["receipts"])


def _member_amounts(t: Tables) -> DataFrame:
    """Fees of members who joined on the run date without a transfer.

    The rules look for a transfer in every office (source ``joined``), their gate only in the member's own office
    (source ``joined_here``).
    """
    members = (
        t.members.filter("is_active = 1 AND member_status = 1")
        .join(_run(t), "office_id")
        .filter(F.col("join_date") == F.col("run_date"))
    )
    transfers = t.transfer_history.select(F.col("tr_member_id").alias("member_id"), "office_id").distinct()
    anywhere = transfers.select("member_id").distinct().withColumn("moved", F.lit(1))
    here = transfers.withColumn("moved_here", F.lit(1))
    sources = F.array_compact(
        F.array(F.when(F.col("moved").isNull(), F.lit("joined")), F.when(F.col("moved_here").isNull(), F.lit("joined_here")))
    )
    fees = {
        "admission_fee": F.col("admission_fee"),
        "pass_book_fee": F.col("pass_book_fee"),
        "loan_form_fee": F.col("loan_form_fee").cast(WHOLE),
    }
    sums = (
        members.join(by_shuffle(anywhere), "member_id", "left")
        .join(by_shuffle(here), ["member_id", "office_id"], "left")
        .groupBy("office_id", "member_category_id", sources.alias("sources"))
        .agg(F.count(F.lit(1)).alias("members"))
        .join(t.member_categories, "member_category_id")
        .withColumn("source", F.explode("sources"))
        .groupBy("office_id", "source")
        .agg(*[F.sum(F.col("members") * fee).alias(name) for name, fee in fees.items()])
        .withColumn("product_id", F.lit(None).cast("bigint"))
    )
    return _amounts(_without_type(sums), F.col("source"), list(fees))


def _deceased_amounts(t: Tables) -> DataFrame:
    """Transfers (type 21) paid on loans of deceased members."""
    deceased = t.expire_infos.groupBy("office_id", "member_id").agg(F.count(F.lit(1)).alias("entries"))
    sums = (
        t.daily_loan_trx.filter("loan_paid > 0 AND trx_type = 21")
        .join(_run(t).select("office_id"), "office_id", "left_semi")
        .groupBy("office_id", "member_id")
        .agg(F.sum("loan_paid").alias("loan_paid"))
        .join(by_shuffle(deceased), ["office_id", "member_id"])
        .groupBy("office_id")
        .agg(F.sum(F.col("loan_paid") * F.col("entries")).alias("transfers"))
        .withColumn("product_id", F.lit(None).cast("bigint"))
    )
    return _amounts(_without_type(sums), F.lit("deceased"), ["transfers"])


def _without_type(df: DataFrame) -> DataFrame:
    nothing = F.lit(None).cast("string")
    return df.withColumns({"type": nothing, "bank_name": nothing})


_READERS = {
    "daily_loan_trx": (_loan_amounts, {"dlt"}),
    "daily_saving_trx": (_saving_amounts, {"dst"}),
    "loan_summary": (_disbursement_amounts, {"full", "partial", "type_one", "adjusted", "fund", "any_partial"}),
    "miscellaneous": (_misc_amounts, {"misc"}),
    "members": (_member_amounts, {"joined", "joined_here"}),
    "expire_infos": (_deceased_amounts, {"deceased"}),
}


def day_amounts(t: Tables, only: Wanted = ALL_RULES) -> DataFrame:
    """Everything the wanted rules and their gates sum, from one pass over each source table.

    Its size is set by offices, products and transaction types, so a caller writes it once and evaluates every rule
    and gate on the written copy.
    """
    sources = _sources_of(only)
    return _union([read(t) for read, provided in _READERS.values() if provided & sources])


# ---------------------------------------------------------------- rule and gate evaluation


def _entries(t: Tables, indicators: set[str]) -> DataFrame:
    """Interface entries of the given indicators, with the voucher type in one spelling."""
    return t.accounting_interface.filter(F.col("trx_ind").isin(*sorted(indicators))).select(
        "product_id",
        F.col("trx_ind").alias("indicator"),
        F.initcap("voucher_type").alias("voucher_type"),
        F.initcap("trx_type").alias("entry_type"),
        "voucher_category",
        "acc_code",
    )


def _table(t: Tables, rows: list[tuple], layout: str) -> DataFrame:
    """A constant table; made from Arrow so that the plan knows its size."""
    schema = StructType.fromDDL(layout)
    columns = {name: list(values) for name, values in zip(schema.names, zip(*rows))}
    return t.run_control.sparkSession.createDataFrame(pa.table(columns), schema)


def _matched(t: Tables, amounts: DataFrame, table: DataFrame, indicators: set[str]) -> DataFrame:
    """Amounts joined to rule or gate rows and to the interface entries these name."""
    named = ["source", "type", "amount_name"]
    return (
        amounts.join(table.select(*named), named, "left_semi")
        .join(by_shuffle(products_of(t, "product_type")), "product_id")
        .join(table, ["source", "type", "product_type", "amount_name"])
        .join(by_shuffle(_entries(t, indicators)), ["product_id", "indicator", "voucher_type"])
    )


def _table_rule_lines(t: Tables, amounts: DataFrame, rules: list[R.Rule]) -> DataFrame:
    layout = (
        "rule string, batch int, source string, type string, product_type int, indicator string, "
        "voucher_type string, amount_name string, side string, gate string, narration string, by_bank boolean, "
        "active_account boolean"
    )
    rows = [
        (r.rule, r.batch, r.source, str(kind), product, r.indicator, r.voucher_type, r.amount, r.side, r.gate,
         r.narration, r.by_bank, r.active_account)
        for r in rules
        for kind in r.types
        for product in r.product_types
    ]
    chart = t.acc_chart.select("acc_code", "acc_id", F.col("is_active").alias("account_active"))
    no_rebates = t.run_control.filter(F.col("organization_id").isin(*R.NO_REBATE_ORGANIZATIONS))
    no_rebates = no_rebates.select("office_id", F.lit(R.REBATE_BATCH).alias("batch"))
    keys = ["office_id", "rule", "batch", "gate", "voucher_category", "acc_id", "side", "narration"]
    # many products post to one account, so they are summed by its code before they meet the chart
    per_code = (
        _matched(t, amounts, _table(t, rows, layout), {r.indicator for r in rules})
        .withColumn("acc_code", F.when(F.col("by_bank"), F.col("bank_name")).otherwise(F.col("acc_code")))
        .groupBy(*[k for k in keys if k != "acc_id"], "source", "acc_code", "active_account")
        .agg(F.sum(nz("amount")).alias("amount"))
    )
    per_category = (
        per_code.join(by_shuffle(chart), "acc_code")
        .filter(~F.col("active_account") | (F.col("account_active") == 1))
        .groupBy(*keys, "source")
        .agg(F.sum("amount").alias("amount"))
        .filter("amount <> 0")
    )
    # full and partial disbursements of one account are one line, whatever their category
    disbursed = F.col("rule").isin(*R.DISBURSEMENT_RULES)
    return (
        per_category.withColumn("voucher_category", F.when(~disbursed, F.col("voucher_category")))
        .groupBy(*keys)
        .agg(F.sum("amount").cast("decimal(38,2)").alias("amount"))
        .join(no_rebates, ["office_id", "batch"], "left_anti")
        .select(*LINE_COLUMNS)
    )


def _table_gate_hits(t: Tables, amounts: DataFrame, gates: list[R.Gate]) -> DataFrame:
    layout = (
        "gate string, source string, type string, product_type int, indicator string, voucher_type string, "
        "amount_name string, by_bank boolean"
    )
    rows = [
        (g.gate, g.source, str(kind), product, g.indicator, g.voucher_type, g.amount, g.by_bank)
        for g in gates
        for kind in g.types
        for product in g.product_types
    ]
    banks = t.acc_chart.select(F.col("acc_code").alias("bank_name"), F.lit(1).alias("has_bank"))
    return (
        _matched(t, amounts, _table(t, rows, layout), {g.indicator for g in gates})
        .groupBy("office_id", "gate", "voucher_category", "acc_code", "source", "by_bank", "bank_name")
        .agg(F.sum(nz("amount")).alias("amount"))
        .join(by_shuffle(banks), "bank_name", "left")
        .filter(~F.col("by_bank") | (F.col("has_bank") == 1))
        .groupBy("office_id", "gate", "voucher_category", "acc_code", "source")
        .agg(F.sum("amount").alias("amount"))
        .filter("amount <> 0")
        .select("office_id", "gate")
        .distinct()
    )


# ---------------------------------------------------------------- rules outside the table


def _written_off(t: Tables, amounts: DataFrame) -> DataFrame:
    main_loans = products_of(t, "product_type").filter("product_type = 1")
    return (
        amounts.filter("source = 'dlt' AND type = '71' AND amount_name = 'loan_paid'")
        .join(by_shuffle(main_loans), "product_id", "left_semi")
        .groupBy("office_id", "type")
        .agg(F.sum("amount").alias("amount"))
        .filter("amount <> 0")
    )


def _partial_interest(t: Tables, amounts: DataFrame, keys: list[str]) -> DataFrame:
    entries = _entries(t, {"SR"}).filter("voucher_type = 'Cr'").select("product_id", "acc_code")
    return (
        amounts.filter("source = 'any_partial' AND amount_name = 'partial_interest'")
        .join(by_shuffle(t.products.select("product_id")), "product_id", "left_semi")
        .join(by_shuffle(entries), "product_id")
        .groupBy("office_id", "acc_code")
        .agg(F.sum(nz("amount")).alias("amount"))
        .join(by_shuffle(t.acc_chart.select("acc_code", "acc_id")), "acc_code")
        .groupBy(*keys)
        .agg(F.sum("amount").alias("amount"))
        .filter("amount <> 0")
    )


def _misc_rows(t: Tables, amounts: DataFrame) -> DataFrame:
    accounts = t.acc_chart.select(F.col("acc_code").alias("product_code"), "acc_id")
    return (
        amounts.filter("source = 'misc'")
        .join(by_shuffle(products_of(t, "product_code")), "product_id")
        .join(by_shuffle(accounts), "product_code")
        .groupBy("office_id", "acc_id")
        .agg(F.sum("amount").alias("amount"))
    )


def _risk_funds(t: Tables, amounts: DataFrame) -> DataFrame:
    """The insured share of today's unposted disbursements per office, split 70 to 30 with the first part whole."""
    insured = F.col("amount").cast("decimal(24,2)") * F.col("insurance_item_rate").cast(RATE)
    share = F.round(F.col("fund") * F.lit(Decimal("0.7")), 0)
    parts = F.array(
        F.struct(F.lit("P05").alias("rule"), share.cast("decimal(38,2)").alias("amount")),
        F.struct(F.lit("P06").alias("rule"), (F.col("fund") - share).cast("decimal(38,2)").alias("amount")),
    )
    return (
        amounts.filter("source = 'fund' AND amount_name = 'principal'")
        .join(by_shuffle(products_of(t, "product_code", "insurance_item_rate")), "product_id")
        .filter(~starts_with("product_code", "7"))
        .groupBy("office_id")
        .agg(F.sum(insured * F.lit(Decimal("0.01"))).cast("decimal(30,6)").alias("fund"))
        .select("office_id", F.inline(parts))
    )


def _named_lines(t: Tables, amounts: DataFrame, only: Wanted) -> DataFrame:
    """Lines on the accounts of indicators that belong to no product."""
    layout = (
        "rule string, batch int, gate string, indicator string, entry_type string, must_be_active boolean, "
        "side string, narration string"
    )
    totals = []
    direct = [row for row in R.NAMED_AMOUNTS if row[0] in only]
    if direct:
        table = _table(t, direct, "rule string, source string, amount_name string")
        totals.append(amounts.join(table, ["source", "amount_name"]).select("office_id", "rule", "amount"))
    if only & {"P05", "P06"}:
        totals.append(_risk_funds(t, amounts).select("office_id", "rule", "amount"))
    if "P23" in only:
        table = _table(t, [R.NAMED_TYPE], "rule string, type string")
        totals.append(_written_off(t, amounts).join(table, "type").select("office_id", "rule", "amount"))
    rules = [row for row in R.NAMED_RULES if row[0] in only]
    chart = t.acc_chart.select("acc_code", "acc_id", F.col("is_active").alias("account_active"))
    return (
        _union(totals)
        .join(_table(t, rules, layout), "rule")
        .join(_entries(t, {row[3] for row in rules}).select("indicator", "entry_type", "acc_code"), ["indicator", "entry_type"])
        .join(by_shuffle(chart), "acc_code")
        .filter(~F.col("must_be_active") | (F.col("account_active") == 1))
        .withColumn("voucher_category", F.lit(None).cast("string"))
        .select(*LINE_COLUMNS)
    )


def _fixed_lines(df: DataFrame, rule: str, batch: int, gate: str, narration: str) -> DataFrame:
    return df.select(
        "office_id",
        F.lit(rule).alias("rule"),
        F.lit(batch).alias("batch"),
        F.lit(gate).alias("gate"),
        F.lit(None).cast("string").alias("voucher_category"),
        "acc_id",
        "amount",
        F.lit("Cr").alias("side"),
        F.lit(narration).alias("narration"),
    )


def _lines(t: Tables, amounts: DataFrame, only: Wanted) -> DataFrame:
    """Lines of the wanted rules, before their gates."""
    frames = []
    in_table = [r for r in R.RULES if r.rule in only]
    if in_table:
        frames.append(_table_rule_lines(t, amounts, in_table))
    if "P01" in only:
        frames.append(_fixed_lines(_misc_rows(t, amounts), *R.MISC))
    if "P09" in only:
        partial = _partial_interest(t, amounts, ["office_id", "acc_id"])
        frames.append(_fixed_lines(partial, *R.PARTIAL_INTEREST))
    if only & {row[0] for row in R.NAMED_RULES}:
        frames.append(_named_lines(t, amounts, only))
    return _union(frames)


# ---------------------------------------------------------------- gates


def movement_offices(t: Tables) -> DataFrame:
    """Offices with any loan, savings or disbursement movement of a member on the run date."""
    keys = ["office_id", "member_id", "center_id"]
    run = _run(t).select("office_id", "run_date")

    def today(df: DataFrame, day: str, **sums: str) -> DataFrame:
        rows = df.join(run, "office_id").filter(F.col(day) == F.col("run_date"))
        summed = rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums.values()])
        moved = reduce(Column.__or__, [F.col(c) != 0 for c in sums.values()])
        return summed.filter(moved).select("office_id")

    return _union(
        [
            today(t.daily_loan_trx, "trx_date", a="loan_paid", b="int_paid"),
            today(t.daily_saving_trx, "transaction_date", a="saving_installment", b="withdrawal"),
            today(t.loan_summary.filter("is_active = 1"), "disburse_date", a="principal_loan"),
        ]
    ).distinct()


def _opened(df: DataFrame, gate: str) -> DataFrame:
    return df.select("office_id", F.lit(gate).alias("gate")).distinct()


def rule_gate_hits(t: Tables, amounts: DataFrame, gates: set[str]) -> DataFrame:
    """(office, gate) for each of the given gates that is open."""
    frames = []
    in_table = [g for g in R.GATES if g.gate in gates]
    if in_table:
        frames.append(_table_gate_hits(t, amounts, in_table))
    by_row = [row for row in R.ROW_GATES if row[1] in gates]
    if by_row:
        table = _table(t, by_row, "source string, gate string")
        frames.append(amounts.join(table, "source").select("office_id", "gate").distinct())
    if "H04" in gates:
        frames.append(_opened(_misc_rows(t, amounts), "H04"))
    if "H08" in gates:
        frames.append(_opened(_partial_interest(t, amounts, ["office_id"]), "H08"))
    if "H19" in gates:
        frames.append(_opened(_written_off(t, amounts), "H19"))
    return _union(frames)


def day_initial_offices(t: Tables) -> DataFrame:
    """Offices whose run date is opened and not closed."""
    rows = t.process_info.filter("closing_status = 0").join(_run(t), "office_id")
    return rows.filter(F.col("initial_date") == F.col("run_date")).select("office_id").distinct()


def voucher_gates(t: Tables, amounts: DataFrame) -> DataFrame:
    """All gates as 0/1 columns, one row per office of the run."""
    hits = _union(
        [
            rule_gate_hits(t, amounts, set(R.GATE_NAMES)),
            _opened(day_initial_offices(t), "H01"),
            _opened(offices_with_vouchers(t), "H02"),
            _opened(movement_offices(t), "H03"),
        ]
    )
    flags = hits.groupBy("office_id").agg(
        *[F.max(F.when(F.col("gate") == g, 1).otherwise(0)).alias(g.lower()) for g in R.GATE_NAMES]
    )
    return t.run_control.select("office_id").join(flags, "office_id", "left").na.fill(0)


# ---------------------------------------------------------------- postings and vouchers


def voucher_postings(t: Tables, amounts: DataFrame, only: Wanted = ALL_RULES) -> DataFrame:
    """The day's voucher lines: office, rule, batch, account, credit, debit, narration.

    ``amounts`` is the result of :func:`day_amounts` for the same rules.
    """
    gates = rule_gate_hits(t, amounts, _gates_of(only))
    open_lines = _lines(t, amounts, only).join(gates, ["office_id", "gate"], "left_semi")
    amount, side = F.col("amount"), F.col("side")
    credit = (
        F.when(side == "Cr", amount)
        .when((side == "sign") & (amount > 0), amount)
        .when((side == "anti") & (amount <= 0), -amount)
        .otherwise(0)
    )
    debit = (
        F.when(side == "Dr", amount)
        .when(side == "neg", -amount)
        .when((side == "sign") & (amount <= 0), -amount)
        .when((side == "anti") & (amount > 0), amount)
        .otherwise(0)
    )
    return open_lines.select(
        "office_id",
        "rule",
        "batch",
        "voucher_category",
        "acc_id",
        credit.cast(MONEY).alias("credit"),
        debit.cast(MONEY).alias("debit"),
        "narration",
    )


def void_previous(t: Tables) -> Tables:
    """Today's earlier unposted automatic vouchers and their lines become inactive; other dates are only passed on."""
    run = _run(t).select("office_id", "run_date")
    masters, older_masters = split_by_run_date(t.acc_trx_master, t, "trx_date")
    lines, older_lines = split_by_run_date(t.acc_trx_detail, t, "trx_date")
    masters = masters.join(run, "office_id", "left")
    earlier = (
        (F.col("trx_date") == F.col("run_date"))
        & (F.col("is_posted") == 0)
        & (F.col("is_active") == 1)
        & (F.col("is_auto_voucher") == 1)
    )
    keys = masters.filter(earlier).select("trx_master_id", F.lit(1).alias("void"))
    details = set_where(lines.join(by_shuffle(keys), "trx_master_id", "left"), F.col("void") == 1, is_active=0)
    return t.replace(
        acc_trx_master=set_where(masters, earlier, is_active=0).select(*older_masters.columns).union(older_masters),
        acc_trx_detail=details.select(*older_lines.columns).union(older_lines),
    )


def voucher_numbers(t: Tables) -> DataFrame:
    """The base voucher number per office.

    With movement: the smallest unposted number of the run date (NULL rejects the office). Otherwise the last number,
    seeded with ``01-<year>`` for an office without any voucher.
    """
    run = _run(t)
    owned = offices_with_vouchers(t).withColumn("has_master", F.lit(1))
    unposted = (
        on_run_date(t.acc_trx_master.filter("is_posted = 0"), t, "trx_date")
        .join(run, "office_id")
        .filter(F.col("trx_date") == F.col("run_date"))
        .groupBy("office_id")
        .agg(F.min("voucher_no").alias("unposted_no"))
    )
    moved = movement_offices(t).withColumn("moved", F.lit(1))
    last = t.acc_last_voucher.select("office_id", F.col("voucher_no").alias("last_no"))
    df = run
    for frame in (owned, unposted, moved, last):
        df = df.join(frame, "office_id", "left")
    seed = F.concat(F.lit("01-"), F.year("run_date").cast("string"))
    kept = F.when(F.col("has_master").isNull(), F.coalesce("last_no", seed)).otherwise(F.col("last_no"))
    return df.select(
        "office_id", F.when(F.col("moved") == 1, F.col("unposted_no")).otherwise(kept).alias("voucher_no")
    )


def _keyed_lines(t: Tables, postings: DataFrame) -> DataFrame:
    """Postings with their voucher key: office, date and batch."""
    key = F.concat_ws("-", "office_id", F.date_format("run_date", "yyyyMMdd"), "batch")
    return postings.join(_run(t), "office_id").withColumn("voucher_key", key)


def voucher_masters(t: Tables, postings: DataFrame) -> DataFrame:
    """One cash voucher per office and batch with lines; later batches number with the run year and their batch."""
    heads = _keyed_lines(t, postings).select("voucher_key", "office_id", "run_org", "run_date", "batch").distinct()
    first_batch = F.min("batch").over(Window.partitionBy("office_id"))
    numbered = heads.join(voucher_numbers(t), "office_id", "left").withColumn("first_batch", first_batch)
    base = F.when(F.col("batch") == F.col("first_batch"), F.col("voucher_no")).otherwise(
        voucher_with_last_year(F.col("voucher_no"), F.year("run_date"))
    )
    return numbered.select(
        "voucher_key",
        F.col("run_org").alias("organization_id"),
        "office_id",
        F.col("run_date").alias("trx_date"),
        F.concat_ws("/", base, F.col("batch").cast("string")).alias("voucher_no"),
        F.lit("CA").alias("voucher_type"),
        F.lit(0).alias("is_posted"),
        F.lit(1).alias("is_auto_voucher"),
    )


def voucher_details(t: Tables, postings: DataFrame) -> DataFrame:
    """Voucher lines with the key of their voucher."""
    return _keyed_lines(t, postings).select("voucher_key", "rule", "acc_id", "credit", "debit", "narration")


def flush_to_ledger(t: Tables, masters: DataFrame, details: DataFrame) -> Tables:
    """New vouchers and their lines in the ledger, and the last voucher number rolled to the run year.

    Keys are hashes of the voucher's key (office, date, batch) and of how many vouchers of the run date the office had
    before, so a second run of the day, whose first vouchers are void by then, gets keys of its own.
    """
    run = _run(t).select("office_id", "run_date")
    before = (
        on_run_date(t.acc_trx_master, t, "trx_date")
        .join(run, "office_id")
        .filter(F.col("trx_date") == F.col("run_date"))
        .groupBy("office_id")
        .agg(F.count(F.lit(1)).alias("vouchers_before"))
    )
    heads = masters.join(before, "office_id", "left").fillna(0, "vouchers_before")
    heads = heads.withColumn("trx_master_id", F.xxhash64("voucher_key", "vouchers_before")).withColumn("is_active", F.lit(1))
    line_key = F.xxhash64("trx_master_id", "rule", "acc_id", "credit", "debit", "narration")
    lines = (
        details.join(heads.select("voucher_key", "trx_master_id", "trx_date"), "voucher_key")
        .withColumn("trx_details_id", line_key)
        .withColumn("is_active", F.lit(1))
    )
    picked = masters.select("office_id", "trx_date").distinct().join(voucher_numbers(t), "office_id")
    rolled = picked.select("office_id", voucher_with_last_year(F.col("voucher_no"), F.year("trx_date")).alias("rolled"))
    last = t.acc_last_voucher.join(rolled, "office_id", "full")
    return t.replace(
        acc_trx_master=t.acc_trx_master.unionByName(heads.select(*t.acc_trx_master.columns)),
        acc_trx_detail=t.acc_trx_detail.unionByName(lines.select(*t.acc_trx_detail.columns)),
        acc_last_voucher=last.select("office_id", F.coalesce("rolled", "voucher_no").alias("voucher_no")),
        voucher_control=with_vouchers(t, heads),
    )
