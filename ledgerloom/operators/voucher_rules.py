"""The posting rules and their gates as data.

A rule names a source, the transaction types it takes, the interface entry that gives its account, the amount it sums
and the side it posts to. A gate is a per-office yes/no test with the same vocabulary; a rule posts only in offices
whose gate is open.
"""

from __future__ import annotations

from dataclasses import dataclass

LOANS = (1, 2, 3)
MAIN_LOANS = (1,)
SAVINGS = (0,)


@dataclass(frozen=True)
class Rule:
    rule: str
    batch: int
    source: str  # dlt: day's loans, dst: day's savings, full / partial: today's disbursements
    types: tuple  # transaction types, or the disbursal channel
    product_types: tuple
    indicator: str
    voucher_type: str
    amount: str
    side: str  # Cr, Dr, sign (positive credits), anti (positive debits), neg (negated, debit)
    gate: str
    narration: str | None
    by_bank: bool = False  # the account comes from the bank's code instead of the interface entry
    active_account: bool = True


# fixed values: rule numbers, codes and narrations
RULES = (
    Rule("P07", 1, "dlt", (10, 20, 50, 41), LOANS, "LR", "Cr", "loan_paid", "Cr", "H07L", "By receiving LoanInstallment as per list"),
    Rule("P08", 1, "dlt", (10, 20, 50, 41), LOANS, "SR", "Cr", "int_paid", "Cr", "H07S", "By receiving LoanInstallment as per list"),
    Rule("P10", 1, "dst", (10, 20, 41), SAVINGS, "SD", "Cr", "installment_penalty", "Cr", "H09", "By Deposit SavingInstallment as per list"),
    Rule("P11", 2, "dst", (10, 20, 41), SAVINGS, "SW", "Dr", "withdrawal", "Dr", "H10", "To Withdrawal As per list"),
    Rule("P12", 2, "full", ("101",), MAIN_LOANS, "LD", "Dr", "principal", "Dr", "H11C", None),
    Rule("P12", 2, "partial", ("101",), MAIN_LOANS, "LD", "Dr", "partial", "Dr", "H11C", None),
    Rule("P13", 3, "dst", (22,), SAVINGS, "SD", "Cr", "installment", "Cr", "H12", "By Deposit SavingInstallment as per list To Bank"),
    Rule("P14", 3, "dst", (22,), SAVINGS, "SD", "Cr", "installment", "Dr", "H13", "To Bank Deposit from SavingInstallment as per list", by_bank=True),
    Rule("P15", 4, "dst", (22,), SAVINGS, "SW", "Dr", "withdrawal", "Dr", "H14", "To Withdrawal As per list from Bank"),
    Rule("P16", 4, "dst", (22,), SAVINGS, "SW", "Dr", "withdrawal", "Cr", "H14", "Savings Withdrawal from Bank", by_bank=True),
    Rule("P17", 4, "full", ("102",), MAIN_LOANS, "LD", "Dr", "principal", "Dr", "H11B", None),
    Rule("P17", 4, "partial", ("102",), MAIN_LOANS, "LD", "Dr", "partial", "Dr", "H11B", None),
    Rule("P18", 4, "full", ("102",), MAIN_LOANS, "LD", "Dr", "principal", "Cr", "H15", None, by_bank=True),
    Rule("P18", 4, "partial", ("102",), MAIN_LOANS, "LD", "Dr", "partial", "Cr", "H15", None, by_bank=True),
    Rule("P19", 5, "adjusted", ("103",), MAIN_LOANS, "LD", "Dr", "principal", "Dr", "H16", "To Adjust Previous Loan"),
    Rule("P20", 5, "adjusted", ("103",), MAIN_LOANS, "LD", "Dr", "int_installment", "Dr", "H16", "To Adjust Previous ServiceCharge"),
    Rule("P21", 5, "dlt", (11, 21, 31), LOANS, "LR", "Cr", "loan_paid", "sign", "H17", "Adjust Loan Installment as per List"),
    Rule("P22", 5, "dlt", (71,), LOANS, "LR", "Cr", "loan_paid", "sign", "H17", "Adjust Loan Installment from LLP as per List"),
    Rule("P24", 5, "dlt", (11, 21), LOANS, "SR", "Cr", "int_paid", "sign", "H20", "Adjust SC Installment as per List"),
    Rule("P25", 5, "dst", (11, 21, 71, 23), SAVINGS, "SD", "Cr", "installment_penalty_interest", "Cr", "H21", "Adjust Saving Installment as Per List"),
    Rule("P26", 5, "dst", (32,), SAVINGS, "SD", "Cr", "installment_penalty_interest", "Cr", "H22", "Excess SC Transfer to Savings as Per List"),
    Rule("P27", 5, "dlt", (32,), LOANS, "SR", "Cr", "int_paid", "neg", "H22", "Excess SC Transfer to Savings as Per List"),
    Rule("P28", 5, "dst", (11, 21, 71), SAVINGS, "SW", "Dr", "withdrawal", "Dr", "H23", "Adjust Saving Withdrawal as Per List", active_account=False),
    Rule("P29", 5, "dst", (21, 23), SAVINGS, "GS", "Cr", "interest", "Dr", "H24", "Savings Interest distribution as Per List"),
    Rule("P30", 6, "dlt", (31, 71), LOANS, "SR", "Cr", "int_paid", "Cr", "H25", "Rebate SC as per List"),
    Rule("P31", 6, "dlt", (31, 71), LOANS, "RB", "Dr", "int_paid", "Dr", "H25", "Rebate SC as per List"),
)

# fixed values: rules not driven by the table above, as rule, batch, gate, narration
MISC = ("P01", 1, "H04", "By receiving Miscellaneous Entry as per list")
PARTIAL_INTEREST = ("P09", 1, "H08", "By receiving LoanInstallment as per list")

# fixed values: rules on the account of an indicator, as rule, batch, gate, indicator, entry type, whether the account
# must be active, side, narration
NAMED_RULES = (
    ("P02", 1, "H05", "MA", "Cr", True, "Cr", "By Members Admission Fee as per list"),
    ("P03", 1, "H05", "PB", "Cr", True, "Cr", "By Members PassBook Fee as per list"),
    ("P04", 1, "H05", "LF", "Cr", True, "Cr", "By Sale of Loan Form as per list"),
    ("P05", 1, "H06", "RM", "Cr", False, "Cr", "RiskFund as per List"),
    ("P06", 1, "H06", "RH", "Cr", False, "Cr", "RiskFund as per List"),
    ("P23", 5, "H19", "LL", "Cr", False, "anti", "LLP Adjust to WriteOff Declaration as per List"),
    ("P32", 7, "H26", "RM", "Dr", False, "Dr", "RiskFund Adjustment as per list"),
)
# amounts such a rule takes as they are, as rule, source, amount
NAMED_AMOUNTS = (
    ("P02", "joined", "admission_fee"),
    ("P03", "joined", "pass_book_fee"),
    ("P04", "joined", "loan_form_fee"),
    ("P32", "deceased", "transfers"),
)

# the rule on loan transactions of one type, as rule, type
NAMED_TYPE = ("P23", "71")

# fixed values: rules whose two disbursement kinds form one line, organizations without rebate vouchers
DISBURSEMENT_RULES = ("P12", "P17", "P18")
NO_REBATE_ORGANIZATIONS = (5, 54)
REBATE_BATCH = 6


@dataclass(frozen=True)
class Gate:
    gate: str
    source: str
    types: tuple
    product_types: tuple
    indicator: str
    voucher_type: str
    amount: str
    by_bank: bool = False  # only rows whose bank is an account


GATES = (
    Gate("H07L", "dlt", (10, 20, 50, 41), LOANS, "LR", "Cr", "loan_paid"),
    Gate("H07S", "dlt", (10, 20, 50, 41), LOANS, "SR", "Cr", "loan_paid"),
    Gate("H09", "dst", (10, 20, 41), SAVINGS, "SD", "Cr", "installment_penalty"),
    Gate("H10", "dst", (10, 20, 41), SAVINGS, "SW", "Dr", "withdrawal"),
    Gate("H11C", "full", ("101",), MAIN_LOANS, "LD", "Dr", "loans"),
    Gate("H11C", "partial", ("101",), MAIN_LOANS, "LD", "Dr", "loans"),
    Gate("H11B", "full", ("102",), MAIN_LOANS, "LD", "Dr", "loans"),
    Gate("H11B", "partial", ("102",), MAIN_LOANS, "LD", "Dr", "loans"),
    Gate("H12", "dst", (22,), SAVINGS, "SD", "Cr", "installment"),
    Gate("H13", "dst", (22,), SAVINGS, "SD", "Cr", "installment", by_bank=True),
    Gate("H14", "dst", (22,), SAVINGS, "SW", "Dr", "withdrawal"),
    Gate("H15", "type_one", ("102",), MAIN_LOANS, "LD", "Dr", "loans"),
    Gate("H15", "partial", ("102",), MAIN_LOANS, "LD", "Dr", "loans"),
    Gate("H16", "adjusted", ("103",), MAIN_LOANS, "LD", "Dr", "loans"),
    Gate("H17", "dlt", (11, 21, 31), LOANS, "LR", "Cr", "loan_paid"),
    Gate("H18", "dlt", (71,), LOANS, "LR", "Cr", "loan_paid"),
    Gate("H20", "dlt", (11, 21), LOANS, "SR", "Cr", "int_paid"),
    Gate("H21", "dst", (11, 21, 71, 23), SAVINGS, "SD", "Cr", "installment_penalty_interest"),
    Gate("H22", "dst", (32,), SAVINGS, "SD", "Cr", "installment_penalty_interest"),
    Gate("H23", "dst", (11, 21, 71), SAVINGS, "SW", "Dr", "withdrawal"),
    Gate("H24", "dst", (21, 23), SAVINGS, "GS", "Cr", "interest"),
    Gate("H25", "dlt", (31, 71), LOANS, "SR", "Cr", "int_paid"),
)

# gates any row of a source opens, as source, gate
ROW_GATES = (("joined_here", "H05"), ("fund", "H06"), ("deceased", "H26"))

GATE_NAMES = (
    "H01", "H02", "H03", "H04", "H05", "H06", "H07L", "H07S", "H08", "H09", "H10", "H11C", "H11B", "H12", "H13",
    "H14", "H15", "H16", "H17", "H18", "H19", "H20", "H21", "H22", "H23", "H24", "H25", "H26",
)

# sources of the rules that are not a plain table entry
OTHER_SOURCES = {
    "P01": {"misc"},
    "P05": {"fund"},
    "P06": {"fund"},
    "P09": {"any_partial"},
    "P23": {"dlt"},
}

GATE_OF_RULE = {
    **{r.rule: r.gate for r in RULES},
    **{row[0]: row[2] for row in (MISC, PARTIAL_INTEREST, *NAMED_RULES)},
}
