"""Month close."""

_KEYS = "saving_summary_id, office_id, center_id, member_id, product_id, no_of_account"
_ON6 = " AND ".join(f"{{0}}.{k}={{1}}.{k}" for k in _KEYS.split(", "))
_ON5 = " AND ".join(f"{{0}}.{k}={{1}}.{k}" for k in _KEYS.split(", ")[1:])
_LOAN6 = " AND ".join(
    f"{{0}}.{k}={{1}}.{k}" for k in ("office_id", "center_id", "member_id", "product_id", "loan_term", "loan_summary_id")
)
_IN_MONTH = "month({0})=month(r.month_end_date) AND year({0})=year(r.month_end_date)"


def _keys(alias: str) -> str:
    return ", ".join(f"{alias}.{k}" for k in _KEYS.split(", "))


def _charge(before: str, no: str) -> str:
    return f"""CASE WHEN meth='F' THEN {before} WHEN meth IN ('A','E','R') THEN
        CASE WHEN {no}>=duration THEN round((CAST({before} AS DOUBLE)*36500+vol*n_days)*100/36500)/100
        ELSE round((CAST({before} AS DOUBLE)*100*duration+vol)*100/(100*duration))/100 END
        WHEN meth='D' THEN round((CAST({before} AS DOUBLE)*36500+vol*n_days)*100/36500)/100 END"""


PARTS = {
    "month_trx": f"""SELECT {_keys('t')}, t.balance, t.transaction_date FROM saving_trx t JOIN saving_summary s ON {_ON6.format('t','s')}
        JOIN run_control r ON r.office_id=t.office_id AND r.organization_id=t.organization_id
        WHERE {_IN_MONTH.format('t.transaction_date')} AND s.saving_status=1""",
    "register": f"""SELECT {_keys('t')}, t.transaction_date, sum(t.deposit)+sum(t.monthly_interest) personal_savings, sum(t.withdrawal) withdrawal, sum(t.balance) balance
        FROM saving_trx t JOIN saving_summary s ON {_ON5.format('t','s')} JOIN run_control r ON r.office_id=t.office_id AND r.organization_id=t.organization_id
        WHERE {_IN_MONTH.format('t.transaction_date')} AND s.saving_status=1 GROUP BY {_keys('t')}, t.transaction_date""",
    "grown": f"""SELECT {_KEYS}, transaction_date, balance, balance-personal_savings+withdrawal previous_balance FROM register
        WHERE balance>balance-personal_savings+withdrawal AND day(transaction_date)>7""",
    "first_grown": f"SELECT {_KEYS}, min(transaction_date) min_installment_date FROM grown GROUP BY {_KEYS}",
    "openings": f"""SELECT {_keys('f')}, min(g.previous_balance) balance, date_trunc('month',r.month_end_date) transaction_date FROM first_grown f
        JOIN grown g ON {_ON6.format('f','g')} AND g.transaction_date=f.min_installment_date JOIN run_control r ON r.office_id=f.office_id
        GROUP BY {_keys('f')}, r.month_end_date""",
    "minimums": f"""SELECT {_keys('c')}, c.transaction_date, min(c.balance) balance FROM
        (SELECT {_KEYS}, balance, CAST(transaction_date AS DATE) transaction_date FROM month_trx UNION ALL
         SELECT {_KEYS}, balance, CAST(transaction_date AS DATE) FROM openings) c
        JOIN saving_summary s ON s.saving_summary_id=c.saving_summary_id AND s.office_id=c.office_id AND s.center_id=c.center_id AND s.member_id=c.member_id
          AND s.product_id=c.product_id AND s.transaction_date=c.transaction_date
        WHERE s.saving_status=1 GROUP BY {_keys('c')}, c.transaction_date""",
    "statics": f"""SELECT DISTINCT {_keys('s')}, CAST(date_trunc('month',r.month_end_date) AS DATE) transaction_date, s.deposit-s.withdrawal balance FROM saving_summary s
        JOIN run_control r ON r.office_id=s.office_id AND r.organization_id=s.organization_id LEFT JOIN minimums m ON {_ON6.format('s','m')}
        WHERE s.saving_status=1 AND m.office_id IS NULL""",
    "balances0": f"SELECT {_KEYS}, transaction_date, balance FROM minimums UNION ALL SELECT {_KEYS}, transaction_date, balance FROM statics",
    "balances1": f"""SELECT {_keys('b')}, b.transaction_date, CASE WHEN s.saving_summary_id IS NOT NULL AND NOT (r.month_end_date-s.opening_date>=
          CASE month(r.month_end_date) WHEN 2 THEN CASE WHEN year(r.month_end_date)%4=0 THEN 22 ELSE 21 END WHEN 4 THEN 23 WHEN 6 THEN 23 WHEN 9 THEN 23 WHEN 11 THEN 23
          ELSE 24 END) THEN 0 ELSE b.balance END balance
        FROM balances0 b JOIN run_control r ON r.office_id=b.office_id LEFT JOIN saving_summary s ON {_ON6.format('b','s')} AND s.saving_status=1""",
    "early": f"""SELECT {_keys('t')}, t.balance, t.transaction_date FROM saving_trx t JOIN saving_summary s ON {_ON6.format('t','s')}
        JOIN run_control r ON r.office_id=t.office_id AND r.organization_id=t.organization_id
        WHERE t.transaction_date=s.opening_date AND s.withdrawal=0 AND day(s.opening_date) BETWEEN 1 AND 7 AND {_IN_MONTH.format('s.opening_date')} AND s.saving_status=1""",
    "balances2": f"""SELECT {_keys('b')}, coalesce(e.d, b.transaction_date) transaction_date, CASE WHEN e.d IS NULL THEN b.balance ELSE e.bal END balance FROM balances1 b
        LEFT JOIN (SELECT n.office_id,n.center_id,n.member_id,n.product_id,n.no_of_account,max(n.balance) bal,max(n.transaction_date) d FROM early n
          JOIN balances1 x ON {_ON6.format('n','x')} GROUP BY n.office_id,n.center_id,n.member_id,n.product_id,n.no_of_account) e ON {_ON5.format('b','e')}""",
    "interests": f"""SELECT {_keys('b')}, b.balance, r.month_end_date transaction_date,
          round(CAST(b.balance*CAST(s.interest_rate AS DECIMAL(9,2)) AS DOUBLE)*(r.month_end_date-CAST(date_trunc('month',r.month_end_date) AS DATE)+1)*100
            /(CASE WHEN year(r.month_end_date)%4=0 OR year(r.month_end_date)%100=0 THEN 36600 ELSE 36500 END))/100 interest
        FROM saving_summary s JOIN balances2 b ON {_ON6.format('s','b')} JOIN run_control r ON r.office_id=b.office_id WHERE s.saving_status=1""",
    "accruing": """SELECT l.*, p.interest_calculation_method meth, r.month_end_date me, r.month_end_date-l.installment_date n_days,
          CAST((l.principal_loan-l.loan_repaid)*CAST(l.interest_rate AS DECIMAL(9,2)) AS DOUBLE) vol,
          coalesce(l.loan_status=1 AND l.disburse_date<date_trunc('month',r.month_end_date) AND p.payment_frequency='M' AND l.installment_start_date<=r.month_end_date
            AND l.loan_summary_id NOT IN (SELECT t.loan_summary_id FROM loan_trx t JOIN run_control q ON q.office_id=t.office_id
              WHERE t.installment_date BETWEEN date_trunc('month',q.month_end_date) AND q.month_end_date), false) hit
        FROM loan_summary l JOIN products p ON p.product_id=l.product_id JOIN run_control r ON r.office_id=l.office_id""",
}


def _month_end_dues(condition: str) -> str:
    return f"""SELECT loan_trx_id, CASE WHEN hit THEN 0 ELSE loan_due END loan_due, CASE WHEN hit THEN 0 ELSE int_due END int_due FROM (
        SELECT t.*, EXISTS (SELECT 1 FROM loan_summary u JOIN products p ON p.product_id=u.product_id WHERE {_LOAN6.format('u','t')}
          AND p.payment_frequency='M' AND {condition}) hit
        FROM loan_trx t JOIN run_control r ON r.office_id=t.office_id WHERE t.installment_date=r.month_end_date) q"""


TEXTS = {
    "mon_saving_transactions": "SELECT * FROM month_trx",
    "mon_savings_register": "SELECT * FROM register",
    "mon_increases": "SELECT * FROM grown",
    "mon_first_increase": "SELECT * FROM first_grown",
    "mon_opening_rows": "SELECT * FROM openings",
    "mon_min_balance": "SELECT * FROM minimums",
    "mon_static_balance": "SELECT * FROM statics",
    "mon_new_after_7": f"""SELECT {_keys('s')}, s.opening_date FROM saving_summary s JOIN run_control r ON r.office_id=s.office_id AND r.organization_id=s.organization_id
        WHERE day(s.opening_date)>7 AND {_IN_MONTH.format('s.opening_date')} AND s.saving_status=1""",
    "mon_min_age_balance": "SELECT * FROM balances1",
    "mon_new_in_7": "SELECT * FROM early",
    "mon_apply_new_in_7": "SELECT * FROM balances2",
    "mon_savings_interest": "SELECT * FROM interests",
    "mon_interest_final": f"""SELECT i.* REPLACE (CASE WHEN EXISTS (SELECT 1 FROM saving_summary s JOIN run_control r ON r.office_id=s.office_id
          WHERE {_ON6.format('s','i')} AND day(s.opening_date)>7 AND {_IN_MONTH.format('s.opening_date')} AND s.saving_status=1) THEN 0 ELSE i.interest END AS interest)
        FROM interests i""",
    "run_month_close": f"""SELECT i.* REPLACE (CASE WHEN EXISTS (SELECT 1 FROM saving_summary s JOIN run_control r ON r.office_id=s.office_id
          WHERE {_ON6.format('s','i')} AND day(s.opening_date)>7 AND {_IN_MONTH.format('s.opening_date')} AND s.saving_status=1) THEN 0 ELSE i.interest END AS interest)
        FROM interests i""",
    "mon_close_process": """SELECT process_info_id, CASE WHEN p.business_date=r.month_end_date THEN 1 ELSE month_closing_status END month_closing_status,
          CASE WHEN p.business_date=r.month_end_date THEN r.month_end_date ELSE month_closing_date END month_closing_date
        FROM process_info p JOIN run_control r ON r.office_id=p.office_id""",
    "mon_loan_accrual": f"""SELECT loan_summary_id, CASE WHEN hit THEN installment_no+1 ELSE installment_no END installment_no,
          CASE WHEN hit THEN {_charge('int_charge','installment_no')} ELSE int_charge END int_charge FROM accruing""",
    "mon_accrual_trx": f"""SELECT loan_summary_id, office_id, member_id, product_id, me trx_date, me installment_date, NULL principal_loan, 0 loan_paid,
          loan_installment loan_due, int_installment int_due, {_charge('0','(installment_no+1)')} int_charge, 0 int_paid, 10 trx_type,
          installment_no+1 installment_no FROM accruing WHERE hit""",
    "mon_zero_past_duration": _month_end_dues("u.installment_no>u.duration"),
    "mon_advance_date": """SELECT l.loan_summary_id, CASE WHEN p.payment_frequency='M' AND l.loan_status=1 AND l.installment_start_date<=r.month_end_date
          AND EXISTS (SELECT 1 FROM loan_trx t WHERE t.installment_date=r.month_end_date AND t.office_id=l.office_id AND t.center_id=l.center_id
            AND t.member_id=l.member_id AND t.product_id=l.product_id AND t.loan_term=l.loan_term) THEN r.month_end_date ELSE l.installment_date END installment_date
        FROM loan_summary l JOIN products p ON p.product_id=l.product_id JOIN run_control r ON r.office_id=l.office_id""",
    "mon_zero_expired": _month_end_dues(
        """u.loan_status=1 AND u.is_active=1 AND EXISTS (SELECT 1 FROM expire_infos e WHERE e.office_id=u.office_id
            AND e.center_id=u.center_id AND e.member_id=u.member_id AND e.expire_date>u.disburse_date)"""
    ),
}

TEXTS["mon_store_interest"] = f"""SELECT * FROM ({TEXTS["mon_interest_final"]}) a UNION ALL
        SELECT b.* REPLACE (0 AS interest, CAST(transaction_date - INTERVAL 1 MONTH AS DATE) AS transaction_date)
        FROM ({TEXTS["mon_interest_final"]}) b"""

# the totals of a loan are the sums of its rows up to the month's end
TEXTS["mon_carry_totals"] = """SELECT loan_summary_id, office_id, sum(principal_loan) principal_loan, sum(loan_due) loan_due,
          sum(int_charge) int_charge, sum(int_due) int_due, max(installment_no) installment_no
        FROM loan_trx JOIN run_control USING (office_id) WHERE installment_date<=month_end_date
        GROUP BY office_id, center_id, member_id, product_id, loan_term, loan_summary_id"""
