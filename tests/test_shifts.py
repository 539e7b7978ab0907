"""The four shifts of principal and interest against a plain sequential version, and their plan."""

import random
import re
from collections import defaultdict
from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import adjustments
from ledgerloom.schemas import SCHEMAS
from ledgerloom.sources.tables import Tables

TODAY = date(2001, 7, 16)
NAMES = ("run_control", "daily_loan_trx", "loan_summary", "products", "members")


def _made(spark, name, rows):
    schema = SCHEMAS[name]
    names = [item.split()[0] for item in re.sub(r"\([^)]*\)", "", schema).split(",")]
    return spark.createDataFrame([tuple(row.get(c) for c in names) for row in rows], schema)


def _case(seed):
    """Loans with rows of several days, members and products, many of them settled or overpaid by little."""
    r = random.Random(seed)
    money = lambda low, high: Decimal(r.randint(low, high))
    run = [{"office_id": o, "organization_id": 12 if o == 3 else 4, "business_date": TODAY} for o in (1, 2, 3)]
    products = [
        {"product_id": p, "product_code": code, "interest_calculation_method": method}
        for p, code, method in ((1, "31", "F"), (2, "32", "D"), (3, "71", "F"))
    ]
    members = [
        {"member_id": m, "office_id": 1, "member_code": f"M{m % 3}", "first_name": f"n{m}", "last_name": "x"}
        for m in range(5)
    ]
    loans, day = [], []
    for n in range(400):
        principal, charge = money(10, 14), money(0, 4)
        loan = {
            "loan_summary_id": n, "office_id": r.choice([1, 1, 2, 3, 9]), "member_id": r.randint(0, 5),
            "product_id": r.randint(1, 3), "organization_id": 4, "loan_term": 1, "center_id": 1,
            "principal_loan": r.choice([principal, principal, None]) if n % 17 == 0 else principal,
            "loan_repaid": principal + money(-4, 3), "int_charge": charge, "int_paid": charge + money(-4, 3),
            "installment_no": r.randint(1, 9), "cum_int_due": r.choice([None, money(0, 2)]),
            "loan_status": r.choice([1, 1, 1, 0]), "is_active": r.choice([1, 1, 1, 0]),
        }
        loans.append(loan)
        for _ in range(r.randint(0, 4)):
            when = TODAY - timedelta(days=r.randint(0, 1))
            day.append({
                "daily_loan_trx_id": len(day), "office_id": loan["office_id"], "loan_summary_id": n,
                "member_id": r.choice([loan["member_id"]] * 4 + [1, None]),
                "trx_date": when, "installment_date": r.choice([when, TODAY, None]) if r.random() < 0.2 else when,
                "product_id": r.choice([loan["product_id"]] * 3 + [1]),
                "product_code": r.choice(["31", "32"]) if r.random() < 0.3 else {1: "31", 2: "32", 3: "71"}[loan["product_id"]],
                "member_code": r.choice([f"M{loan['member_id'] % 3}"] * 3 + [None]),
                "organization_id": r.choice([4, 4, 4, 12]), "trx_type": 1,
                "loan_paid": r.choice([None, money(0, 3), money(0, 3)]), "int_paid": r.choice([None, money(0, 4), money(0, 4)]),
                "int_charge": r.choice([None, money(0, 1), money(0, 1)]), "int_due": money(0, 1),
                "installment_no": r.randint(1, 9), "member_name": r.choice([None, "a", "b"]),
            })
    return {"run_control": run, "daily_loan_trx": day, "loan_summary": loans, "products": products, "members": members}


def _total(rows, column):
    values = [x[column] for x in rows if x.get(column) is not None]
    return sum(values) if values else None


def _latest(rows, column):
    return max((x[column] for x in rows if x.get(column) is not None), default=None)


def _groups(rows, keys):
    groups = defaultdict(list)
    for row in rows:
        groups[tuple(row[k] for k in keys)].append(row)
    return groups.values()


def _gaps(loan, rows):
    """Principal and interest still owed after the rows, None where an amount is unknown."""
    parts = {c: _total(rows, c) for c in ("loan_paid", "int_paid", "int_charge")}
    known = [loan["principal_loan"], loan["int_charge"], *parts.values()]
    if any(v is None for v in known):
        return None, None
    principal = loan["principal_loan"] - loan["loan_repaid"] - parts["loan_paid"]
    return principal, loan["int_charge"] + parts["int_charge"] - loan["int_paid"] - parts["int_paid"]


def _plain(case):
    """Rules one after another over lists of rows; every rule groups the day's rows and all rows added so far."""
    offices = {x["office_id"]: x["organization_id"] for x in case["run_control"]}
    day = [x for x in case["daily_loan_trx"] if x["office_id"] in offices]
    loans = [x for x in case["loan_summary"] if x["office_id"] in offices]
    product = {x["product_id"]: x for x in case["products"]}
    member = {x["member_id"]: x for x in case["members"]}
    rows_of = defaultdict(list)
    for x in day:
        rows_of[x["office_id"], x["loan_summary_id"]].append(x)
    sheet = {o: max((x["installment_date"] for x in day if x["office_id"] == o and x["installment_date"]), default=None) for o in offices}
    added = {rule: [] for rule in (1, 2, 3, 4)}
    for loan in loans:
        office = loan["office_id"]
        rows = list(rows_of[office, loan["loan_summary_id"]])

        def add(rule, amount, **values):
            new = {k: loan[k] for k in ("loan_summary_id", "office_id", "product_id", "member_id", "organization_id")}
            new |= {"loan_paid": amount, "int_paid": -amount} | values
            added[rule].append(new)
            return new

        by_day = ("member_id", "trx_date", "installment_date", "product_code", "member_code")
        for rule in (1, 2):
            found = []
            for group in _groups(rows, by_day):
                principal, interest = _gaps(loan, group)
                if group[0]["member_id"] != loan["member_id"] or principal is None or principal + interest >= Decimal("0.5"):
                    continue
                if principal < 0 if rule == 1 else interest < Decimal("0.5") and principal > 0 and interest != 0:
                    keys = {k: group[0][k] for k in by_day[1:]}
                    latest = {c: _latest(group, c) for c in ("installment_no", "member_name")}
                    found.append(add(rule, principal, **keys, **latest))
            rows += found
        known, found = member.get(loan["member_id"]), []
        code = product[loan["product_id"]]["product_code"]
        if loan["is_active"] == loan["loan_status"] == 1 and not code.startswith("7") and known and loan["principal_loan"] is not None:
            for group in list(_groups(rows, ("member_id",))) or [[]]:
                gap = loan["principal_loan"] - loan["loan_repaid"] - (_total(group, "loan_paid") or 0)
                if gap < 0:
                    found.append(add(
                        3, gap, trx_date=sheet[office], installment_date=sheet[office], product_code=code,
                        installment_no=loan["installment_no"], member_code=known["member_code"],
                        member_name=f"{known['first_name']}  {known['last_name']}",
                    ))
        rows += found
        if offices[office] == 12:
            continue
        balance = ("installment_date", "product_id", "product_code", "member_code", "organization_id")
        for group in _groups(rows, balance):
            principal, interest = _gaps(loan, group)
            if principal is None or product[group[0]["product_id"]]["interest_calculation_method"] == "D":
                continue
            due = (loan["cum_int_due"] or 0) + _total(group, "int_due")
            over_due = loan["int_paid"] + _total(group, "int_paid") - due
            if principal + interest < Decimal("0.5") or -interest < 1 or over_due < 1:
                continue
            amount = -interest if principal >= -interest else -interest - principal
            amount = amount.quantize(Decimal(1), ROUND_HALF_UP)
            latest = {c: _latest(group, c) for c in ("installment_no", "member_name")}
            add(4, amount, **{k: group[0][k] for k in balance}, trx_date=group[0]["installment_date"], **latest)
    return added


COLUMNS = [
    "loan_summary_id", "office_id", "product_id", "member_id", "organization_id", "loan_paid", "int_paid", "trx_date",
    "installment_date", "installment_no", "product_code", "member_code", "member_name",
]


def _comparable(rows):
    return sorted(([str(row[c]) if not isinstance(row[c], Decimal) else f"{row[c]:.2f}" for c in COLUMNS] for row in rows))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_chained_rules_equal_rules_in_turn(spark, seed):
    case = _case(seed)
    t = Tables.of(**{name: _made(spark, name, case[name]) for name in NAMES})
    expected = _plain(case)
    rows = adjustments.shift_rows(t, adjustments.day_sums(t)).collect()
    for rule in (1, 2, 3, 4):
        assert expected[rule], f"the case meets no rule {rule}"
        assert _comparable(x for x in rows if x.rule == rule) == _comparable(expected[rule]), rule


def test_sums_meet_their_loans_once(spark, tables):
    """One exchange by loan on each side of the only join of loans; every window after it needs none."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = adjustments.without_adjustments(tables)
        plan = adjustments.shift_rows(t, adjustments.day_sums(t))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(office_id" in line and "loan_summary_id" in line]
    by_loan = [line for line in dealt if line.count("#") >= 2 and "trx_date" not in line]
    assert plan.count("Window ") >= 4
    assert len(by_loan) == 2


def test_hot_loan_is_summed_before_it_is_dealt(spark, tables):
    """A third of the day's rows on one loan give one sum a date and task, not one row each."""
    t = adjustments.without_adjustments(tables)
    one = t.daily_loan_trx.orderBy("daily_loan_trx_id").limit(1)
    copies = one.crossJoin(spark.range(5_000)).withColumn("daily_loan_trx_id", F.col("id") + 10_000_000).drop("id")
    hot = t.replace(daily_loan_trx=t.daily_loan_trx.unionByName(copies))
    assert adjustments.day_sums(hot).count() == adjustments.day_sums(t).count()


def test_tasks_follow_the_number_of_loans(tables, monkeypatch):
    sums = adjustments.day_sums(tables)
    expected = sorted(map(str, adjustments.shift_rows(tables, sums).collect()))
    monkeypatch.setattr(adjustments, "LOANS_A_TASK", 40)
    rows = adjustments.shift_rows(tables, sums)
    tasks = tables.loan_summary.count() // 40 + 1
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(rf"hashpartitioning\(office_id#\d+L?, loan_summary_id#\d+L?, {tasks}\)", plan)) >= 2
    assert sorted(map(str, rows.collect())) == expected
