"""Automatic vouchers: one statement per rule and per gate."""

_DLT = "daily_loan_trx d"
_DST = "daily_saving_trx d"
_LS = "loan_summary d"
_DAY = "JOIN run_control r ON r.office_id=d.office_id AND r.organization_id=d.organization_id"
_TODAY = "AND d.disburse_date=r.business_date"
_LIVE = f"{_TODAY} AND d.installment_date=r.business_date AND d.is_active=1 AND d.loan_status=1"


def _type(source: str) -> str:
    return "d.trx_type" if source == _DLT else "d.trans_type"


def _joined(source, types, products, ind, vt, extra="", bank=False, chart="AND ac.is_active=1") -> str:
    """FROM and WHERE of a rule body."""
    code = "d.bank_name" if bank else "ai.acc_code"
    return f"""FROM {source} {_DAY} JOIN accounting_interface ai ON ai.product_id=d.product_id JOIN products p ON p.product_id=d.product_id
        JOIN acc_chart ac ON ac.acc_code={code} WHERE p.product_type IN {products} AND ai.trx_ind='{ind}' AND ai.voucher_type='{vt}'
        AND {_type(source)} IN ({types}) {chart} {extra}"""


_GROUP = "GROUP BY d.office_id, ai.voucher_category, ac.acc_id"


def _line(rule, batch, gate, source, types, products, ind, vt, measure, credit, debit, narration, **how) -> str:
    total = f"({measure})"
    return f"""SELECT d.office_id, '{rule}' rule, {batch} batch, '{gate}' gate, ai.voucher_category, ac.acc_id, {credit.replace('@', total)} credit,
        {debit.replace('@', total)} debit, '{narration}' narration {_joined(source, types, products, ind, vt, **how)} {_GROUP} HAVING {total}<>0"""


def _sum(*columns: str) -> str:
    return "+".join(f"sum(coalesce(d.{c},0))" for c in columns)


def _two_kinds(rule, batch, gate, channel, credit, debit, bank=False) -> str:
    """Full and partial disbursements of a channel as one line per account."""
    full = f"""SELECT d.office_id, ac.acc_id, sum(coalesce(d.principal_loan,0)) amt {_joined(_LS, channel, '(1)', 'LD', 'Dr',
        f'{_LIVE} AND d.posted=0 AND d.disbursement_type<>2', bank)} {_GROUP} HAVING sum(coalesce(d.principal_loan,0))<>0"""
    part = f"""SELECT d.office_id, ac.acc_id, sum(coalesce(d.partial_amount,0)) amt {_joined(_LS, channel, '(1)', 'LD', 'Dr',
        f'{_LIVE} AND d.disbursement_type=2', bank)} {_GROUP} HAVING sum(coalesce(d.partial_amount,0))<>0"""
    return f"""SELECT office_id, '{rule}' rule, {batch} batch, '{gate}' gate, NULL voucher_category, acc_id, {credit} credit, {debit} debit, NULL narration
        FROM ({full} UNION ALL {part}) q GROUP BY office_id, acc_id"""


def _fee(rule, ind, fee, narration) -> str:
    return f"""SELECT m.office_id, '{rule}' rule, 1 batch, 'H05' gate, NULL voucher_category, a.acc_id, sum({fee}) credit, 0 debit, '{narration}' narration
        FROM members m JOIN member_categories mc ON mc.member_category_id=m.member_category_id JOIN run_control r ON r.office_id=m.office_id
        CROSS JOIN (SELECT ac.acc_id FROM accounting_interface ai JOIN acc_chart ac ON ac.acc_code=ai.acc_code
          WHERE trx_ind='{ind}' AND trx_type='Cr' AND ac.is_active=1) a
        LEFT JOIN transfer_history t ON t.tr_member_id=m.member_id
        WHERE m.join_date=r.business_date AND m.is_active=1 AND m.member_status=1 AND t.transfer_history_id IS NULL GROUP BY m.office_id, a.acc_id"""


_FUND = """SELECT l.office_id, sum(l.principal_loan*p.insurance_item_rate*0.01) fund FROM loan_summary l JOIN products p ON p.product_id=l.product_id
    JOIN run_control r ON r.office_id=l.office_id WHERE l.disburse_date=r.business_date AND l.is_active=1 AND l.loan_status=1 AND l.posted=0
    AND substr(p.product_code,1,1)<>'7' GROUP BY l.office_id"""


def _account(ind: str, column: str, kind: str) -> str:
    return f"(SELECT ac.acc_id FROM accounting_interface ai JOIN acc_chart ac ON ac.acc_code=ai.acc_code WHERE ai.trx_ind='{ind}' AND ai.{column}='{kind}')"


_CASH = "10,20,50,41"
_SIGN = ("CASE WHEN @<=0 THEN 0 ELSE @ END", "CASE WHEN @<=0 THEN -@ ELSE 0 END")
_SD = ("saving_installment", "penalty")
_SDI = ("saving_installment", "penalty", "monthly_interest")
_ORG = "AND r.organization_id NOT IN (5,54)"

_RULES = {
    "P01": """SELECT d.office_id, 'P01' rule, 1 batch, 'H04' gate, NULL voucher_category, a.acc_id, sum(d.amount) credit, 0 debit,
        'By receiving Miscellaneous Entry as per list' narration FROM miscellaneous d JOIN products p ON p.product_id=d.product_id
        JOIN acc_chart a ON a.acc_code=p.product_code JOIN run_control r ON r.office_id=d.office_id
        WHERE d.trx_date=r.business_date AND d.is_active=1 GROUP BY d.office_id, a.acc_id""",
    "P02": _fee("P02", "MA", "mc.admission_fee", "By Members Admission Fee as per list"),
    "P03": _fee("P03", "PB", "mc.pass_book_fee", "By Members PassBook Fee as per list"),
    "P04": _fee("P04", "LF", "round(mc.loan_form_fee,0)", "By Sale of Loan Form as per list"),
    "P05": f"""SELECT office_id, 'P05' rule, 1 batch, 'H06' gate, NULL voucher_category, {_account('RM', 'trx_type', 'Cr')} acc_id,
        round(fund*70/100,0) credit, 0 debit, 'RiskFund as per List' narration FROM ({_FUND}) f""",
    "P06": f"""SELECT office_id, 'P06' rule, 1 batch, 'H06' gate, NULL voucher_category, {_account('RH', 'trx_type', 'Cr')} acc_id,
        fund-round(fund*70/100,0) credit, 0 debit, 'RiskFund as per List' narration FROM ({_FUND}) f""",
    "P07": _line("P07", 1, "H07L", _DLT, _CASH, "(1,2,3)", "LR", "Cr", _sum("loan_paid"), "@", "0", "By receiving LoanInstallment as per list"),
    "P08": _line("P08", 1, "H07S", _DLT, _CASH, "(1,2,3)", "SR", "Cr", _sum("int_paid"), "@", "0", "By receiving LoanInstallment as per list"),
    "P09": f"""SELECT d.office_id, 'P09' rule, 1 batch, 'H08' gate, NULL voucher_category, ac.acc_id, sum(coalesce(d.partial_int_paid,0)) credit, 0 debit,
        'By receiving LoanInstallment as per list' narration FROM loan_summary d JOIN accounting_interface ai ON ai.product_id=d.product_id
        JOIN products p ON p.product_id=d.product_id JOIN acc_chart ac ON ac.acc_code=ai.acc_code JOIN run_control r ON r.office_id=d.office_id
        WHERE d.disbursement_type=2 {_TODAY} AND ai.trx_ind='SR' AND ai.voucher_type='Cr' GROUP BY d.office_id, ac.acc_id
        HAVING sum(coalesce(d.partial_int_paid,0))<>0""",
    "P10": _line("P10", 1, "H09", _DST, "10,20,41", "(0)", "SD", "Cr", _sum(*_SD), "@", "0", "By Deposit SavingInstallment as per list"),
    "P11": _line("P11", 2, "H10", _DST, "10,20,41", "(0)", "SW", "Dr", _sum("withdrawal"), "0", "@", "To Withdrawal As per list"),
    "P12": _two_kinds("P12", 2, "H11C", "'101'", "0", "sum(amt)"),
    "P13": _line("P13", 3, "H12", _DST, "22", "(0)", "SD", "Cr", _sum("saving_installment"), "@", "0", "By Deposit SavingInstallment as per list To Bank"),
    "P14": _line("P14", 3, "H13", _DST, "22", "(0)", "SD", "Cr", _sum("saving_installment"), "0", "@", "To Bank Deposit from SavingInstallment as per list", bank=True),
    "P15": _line("P15", 4, "H14", _DST, "22", "(0)", "SW", "Dr", _sum("withdrawal"), "0", "@", "To Withdrawal As per list from Bank"),
    "P16": _line("P16", 4, "H14", _DST, "22", "(0)", "SW", "Dr", _sum("withdrawal"), "@", "0", "Savings Withdrawal from Bank", bank=True),
    "P17": _two_kinds("P17", 4, "H11B", "'102'", "0", "sum(amt)"),
    "P18": _two_kinds("P18", 4, "H15", "'102'", "sum(amt)", "0", bank=True),
    "P19": _line("P19", 5, "H16", _LS, "'103'", "(1)", "LD", "Dr", _sum("principal_loan"), "0", "@", "To Adjust Previous Loan", extra=f"{_LIVE} AND d.posted=0"),
    "P20": _line("P20", 5, "H16", _LS, "'103'", "(1)", "LD", "Dr", _sum("int_installment"), "0", "@", "To Adjust Previous ServiceCharge", extra=f"{_LIVE} AND d.posted=0"),
    "P21": _line("P21", 5, "H17", _DLT, "11,21,31", "(1,2,3)", "LR", "Cr", _sum("loan_paid"), *_SIGN, "Adjust Loan Installment as per List"),
    "P22": _line("P22", 5, "H17", _DLT, "71", "(1,2,3)", "LR", "Cr", _sum("loan_paid"), *_SIGN, "Adjust Loan Installment from LLP as per List"),
    "P23": f"""SELECT d.office_id, 'P23' rule, 5 batch, 'H19' gate, NULL voucher_category, {_account('LL', 'voucher_type', 'Cr')} acc_id,
        CASE WHEN sum(coalesce(loan_paid,0))<=0 THEN -sum(coalesce(loan_paid,0)) ELSE 0 END credit,
        CASE WHEN sum(coalesce(loan_paid,0))<=0 THEN 0 ELSE sum(coalesce(loan_paid,0)) END debit, 'LLP Adjust to WriteOff Declaration as per List' narration
        FROM {_DLT} {_DAY} JOIN products p ON p.product_id=d.product_id WHERE p.product_type=1 AND d.trx_type=71 GROUP BY d.office_id
        HAVING sum(coalesce(loan_paid,0))<>0""",
    "P24": _line("P24", 5, "H20", _DLT, "11,21", "(1,2,3)", "SR", "Cr", _sum("int_paid"), *_SIGN, "Adjust SC Installment as per List"),
    "P25": _line("P25", 5, "H21", _DST, "11,21,71,23", "(0)", "SD", "Cr", _sum(*_SDI), "@", "0", "Adjust Saving Installment as Per List"),
    "P26": _line("P26", 5, "H22", _DST, "32", "(0)", "SD", "Cr", _sum(*_SDI), "@", "0", "Excess SC Transfer to Savings as Per List"),
    "P27": _line("P27", 5, "H22", _DLT, "32", "(1,2,3)", "SR", "Cr", _sum("int_paid"), "0", "-@", "Excess SC Transfer to Savings as Per List"),
    "P28": _line("P28", 5, "H23", _DST, "11,21,71", "(0)", "SW", "Dr", _sum("withdrawal"), "0", "@", "Adjust Saving Withdrawal as Per List", chart=""),
    "P29": _line("P29", 5, "H24", _DST, "21,23", "(0)", "GS", "Cr", _sum("monthly_interest"), "0", "@", "Savings Interest distribution as Per List"),
    "P30": _line("P30", 6, "H25", _DLT, "31,71", "(1,2,3)", "SR", "Cr", _sum("int_paid"), "@", "0", "Rebate SC as per List", extra=_ORG),
    "P31": _line("P31", 6, "H25", _DLT, "31,71", "(1,2,3)", "RB", "Dr", _sum("int_paid"), "0", "@", "Rebate SC as per List", extra=_ORG),
    "P32": f"""SELECT d.office_id, 'P32' rule, 7 batch, 'H26' gate, NULL voucher_category, {_account('RM', 'trx_type', 'Dr')} acc_id, 0 credit,
        sum(d.loan_paid) debit, 'RiskFund Adjustment as per list' narration FROM daily_loan_trx d
        JOIN expire_infos e ON e.office_id=d.office_id AND e.member_id=d.member_id JOIN run_control r ON r.office_id=d.office_id
        WHERE d.loan_paid>0 AND d.trx_type=21 GROUP BY d.office_id""",
}


def _gate(source, types, products, ind, vt, measure=None, extra="", bank="") -> str:
    having = f"GROUP BY d.office_id, ai.voucher_category, ai.acc_code HAVING {measure}<>0" if measure else ""
    return f"""SELECT d.office_id FROM {source} {_DAY} JOIN accounting_interface ai ON ai.product_id=d.product_id JOIN products p ON p.product_id=d.product_id {bank}
        WHERE p.product_type IN {products} AND ai.trx_ind='{ind}' AND ai.voucher_type='{vt}' AND {_type(source)} IN ({types}) {extra} {having}"""


def _either(channel: str, first: str) -> str:
    return (
        _gate(_LS, channel, "(1)", "LD", "Dr", extra=f"{_LIVE} AND d.posted=0 AND {first}")
        + " UNION ALL "
        + _gate(_LS, channel, "(1)", "LD", "Dr", extra=f"{_LIVE} AND d.disbursement_type=2")
    )


_GATES = {
    "h01": "SELECT d.office_id FROM process_info d JOIN run_control r ON r.office_id=d.office_id AND d.initial_date=r.business_date WHERE d.closing_status=0",
    "h02": f"SELECT d.office_id FROM acc_trx_master d {_DAY}",
    "h03": "SELECT office_id FROM movement",
    "h04": "SELECT d.office_id FROM miscellaneous d JOIN products p ON p.product_id=d.product_id JOIN acc_chart a ON a.acc_code=p.product_code JOIN run_control r ON r.office_id=d.office_id WHERE d.trx_date=r.business_date AND d.is_active=1",
    "h05": """SELECT m.office_id FROM members m JOIN member_categories mc ON mc.member_category_id=m.member_category_id JOIN run_control r ON r.office_id=m.office_id
        WHERE m.join_date=r.business_date AND m.is_active=1 AND m.member_status=1 AND m.member_id NOT IN (SELECT tr_member_id FROM transfer_history t WHERE t.office_id=m.office_id)""",
    "h06": f"SELECT d.office_id FROM {_LS} JOIN run_control r ON r.office_id=d.office_id WHERE d.is_active=1 AND d.loan_status=1 AND d.posted=0 {_TODAY}",
    "h07l": _gate(_DLT, _CASH, "(1,2,3)", "LR", "Cr", _sum("loan_paid")),
    "h07s": _gate(_DLT, _CASH, "(1,2,3)", "SR", "Cr", _sum("loan_paid")),
    "h08": f"""SELECT d.office_id FROM loan_summary d JOIN accounting_interface ai ON ai.product_id=d.product_id JOIN products p ON p.product_id=d.product_id
        JOIN acc_chart ac ON ac.acc_code=ai.acc_code JOIN run_control r ON r.office_id=d.office_id WHERE d.disbursement_type=2 {_TODAY} AND ai.trx_ind='SR'
        AND ai.voucher_type='Cr' GROUP BY d.office_id HAVING sum(coalesce(d.partial_int_paid,0))<>0""",
    "h09": _gate(_DST, "10,20,41", "(0)", "SD", "Cr", _sum(*_SD)),
    "h10": _gate(_DST, "10,20,41", "(0)", "SW", "Dr", _sum("withdrawal")),
    "h11c": _either("'101'", "d.disbursement_type<>2"),
    "h11b": _either("'102'", "d.disbursement_type<>2"),
    "h12": _gate(_DST, "22", "(0)", "SD", "Cr", _sum("saving_installment")),
    "h13": _gate(_DST, "22", "(0)", "SD", "Cr", _sum("saving_installment"), bank="JOIN acc_chart ac ON ac.acc_code=d.bank_name"),
    "h14": _gate(_DST, "22", "(0)", "SW", "Dr", _sum("withdrawal")),
    "h15": _either("'102'", "d.disbursement_type=1"),
    "h16": _gate(_LS, "'103'", "(1)", "LD", "Dr", extra=f"{_LIVE} AND d.posted=0"),
    "h17": _gate(_DLT, "11,21,31", "(1,2,3)", "LR", "Cr", _sum("loan_paid")),
    "h18": _gate(_DLT, "71", "(1,2,3)", "LR", "Cr", _sum("loan_paid")),
    "h19": f"SELECT d.office_id FROM {_DLT} {_DAY} JOIN products p ON p.product_id=d.product_id WHERE p.product_type=1 AND d.trx_type=71 GROUP BY d.office_id HAVING sum(coalesce(loan_paid,0))<>0",
    "h20": _gate(_DLT, "11,21", "(1,2,3)", "SR", "Cr", _sum("int_paid")),
    "h21": _gate(_DST, "11,21,71,23", "(0)", "SD", "Cr", _sum(*_SDI)),
    "h22": _gate(_DST, "32", "(0)", "SD", "Cr", _sum(*_SDI)),
    "h23": _gate(_DST, "11,21,71", "(0)", "SW", "Dr", _sum("withdrawal")),
    "h24": _gate(_DST, "21,23", "(0)", "GS", "Cr", _sum("monthly_interest")),
    "h25": _gate(_DLT, "31,71", "(1,2,3)", "SR", "Cr", _sum("int_paid")),
    "h26": "SELECT d.office_id FROM daily_loan_trx d JOIN expire_infos e ON e.office_id=d.office_id AND e.member_id=d.member_id JOIN run_control r ON r.office_id=d.office_id WHERE d.loan_paid>0 AND d.trx_type=21",
}

PARTS = {
    "all_lines": " UNION ALL ".join(f"SELECT * FROM ({sql}) {name.lower()}" for name, sql in _RULES.items()),
    "open_gates": " UNION ALL ".join(f"SELECT DISTINCT '{name.upper()}' gate, office_id FROM ({sql}) g" for name, sql in _GATES.items()),
    "postings": "SELECT l.* FROM all_lines l JOIN open_gates g ON g.gate=l.gate AND g.office_id=l.office_id",
    "heads": "SELECT DISTINCT p.office_id, p.batch FROM postings p",
}

_MASTERS = """SELECT h.office_id||'-'||strftime(r.business_date,'%Y%m%d')||'-'||h.batch voucher_key, r.organization_id, h.office_id, r.business_date trx_date,
          concat_ws('/', CASE WHEN h.batch=(SELECT min(batch) FROM heads x WHERE x.office_id=h.office_id) THEN n.voucher_no
            ELSE substr(n.voucher_no,1,length(n.voucher_no)-4)||year(r.business_date) END, h.batch) voucher_no, 'CA' voucher_type, 0 is_posted, 1 is_auto_voucher
        FROM heads h JOIN run_control r ON r.office_id=h.office_id LEFT JOIN picked_numbers n ON n.office_id=h.office_id"""
_DETAILS = "SELECT l.office_id||'-'||strftime(r.business_date,'%Y%m%d')||'-'||batch voucher_key, rule, acc_id, credit, debit, narration FROM postings l JOIN run_control r ON r.office_id=l.office_id"

TEXTS = {
    "voucher_postings": "SELECT * FROM postings",
    **{
        f"vp_{rule[1:]}": f"""SELECT l.* FROM ({sql}) l WHERE l.office_id IN (SELECT office_id FROM ({_GATES[sql.split("' gate")[0].rsplit("'", 1)[1].lower()]}) g)"""
        for rule, sql in _RULES.items()
    },
    "voucher_gates": "SELECT r.office_id, "
    + ", ".join(f"CASE WHEN r.office_id IN ({sql}) THEN 1 ELSE 0 END {name}" for name, sql in _GATES.items())
    + " FROM run_control r",
    "voucher_control": """SELECT office_id, organization_id, min(first_date) first_date FROM (
          SELECT office_id, organization_id, trx_date first_date FROM acc_trx_master WHERE office_id%3<>0
          UNION ALL SELECT office_id, organization_id, business_date FROM run_control SEMI JOIN heads USING (office_id)) GROUP BY ALL""",
    "voucher_numbers": "SELECT office_id, voucher_no FROM picked_numbers",
    "voucher_masters": _MASTERS,
    "voucher_details": _DETAILS,
    "voucher_ledger": f"""SELECT v.office_id, v.trx_date, v.voucher_no, v.voucher_type, v.is_posted, v.is_auto_voucher, l.acc_id, l.debit, l.credit, l.narration
        FROM ({_MASTERS}) v JOIN ({_DETAILS}) l USING (voucher_key)
        UNION ALL SELECT k.office_id, k.trx_date, k.voucher_no, k.voucher_type, k.is_posted, k.is_auto_voucher, l.acc_id, l.debit, l.credit, l.narration
        FROM acc_trx_detail l JOIN acc_trx_master k USING (trx_master_id)
        WHERE k.is_active*l.is_active=1 AND (k.office_id, k.trx_date) IN (SELECT (office_id, business_date) FROM run_control) AND (k.is_posted=1 OR k.is_auto_voucher=0)""",
    "voucher_last_number": """SELECT a.office_id, coalesce(CASE WHEN a.office_id IN (SELECT office_id FROM heads)
          THEN (SELECT left(n.voucher_no, -4)||'2001' FROM picked_numbers n WHERE n.office_id=a.office_id) END, a.voucher_no) voucher_no FROM acc_last_voucher a""",
    "voucher_flag_done": "SELECT a.office_id, CASE WHEN a.office_id IN (SELECT office_id FROM run_control) THEN 1 ELSE check_auto_voucher END check_auto_voucher FROM auto_voucher_check a",
    "voucher_void_previous": """SELECT 'master' kind, trx_master_id row_id, CASE WHEN hit THEN 0 ELSE is_active END is_active FROM (SELECT m.*, m.trx_date=r.business_date
          AND m.is_posted=0 AND m.is_active=1 AND m.is_auto_voucher=1 hit FROM acc_trx_master m JOIN run_control r ON r.office_id=m.office_id) q
        UNION ALL SELECT 'detail', d.trx_details_id, CASE WHEN d.trx_master_id IN (SELECT m.trx_master_id FROM acc_trx_master m JOIN run_control r ON r.office_id=m.office_id
          WHERE m.trx_date=r.business_date AND m.is_posted=0 AND m.is_active=1 AND m.is_auto_voucher=1) THEN 0 ELSE d.is_active END FROM acc_trx_detail d""",
}
