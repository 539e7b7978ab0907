"""Column layout of every persistent table, as DDL text.

Money is ``decimal(18,2)``, flags are ``int`` 0/1, identifiers ``bigint``, business dates ``date``. Readers pass
these layouts to ``spark.read.schema`` so nothing is ever inferred from the data.
"""

from __future__ import annotations

# fixed values: table and column names
SCHEMAS: dict[str, str] = {
    "offices": """
    office_id bigint, organization_id bigint, office_code string
    """,
    "run_control": """
    office_id bigint, organization_id bigint, business_date date, month_end_date date
    """,
    "centers": """
    center_id bigint, office_id bigint, collection_day string, collection_date date
    """,
    "member_categories": """
    member_category_id bigint, admission_fee decimal(18,2), pass_book_fee decimal(18,2),
    loan_form_fee decimal(18,2), category_short_name_bng string
    """,
    "products": """
    product_id bigint, product_code string, product_name string, main_product_code string,
    sub_main_category string, product_type int, interest_calculation_method string,
    payment_frequency string, interest_rate decimal(18,2), insurance_item_rate decimal(18,2),
    is_active int
    """,
    "product_counts": """
    sets bigint
    """,
    "product_mappings": """
    office_id bigint, product_id bigint
    """,
    "members": """
    member_id bigint, organization_id bigint, office_id bigint, center_id bigint,
    member_category_id bigint, member_code string, first_name string, middle_name string,
    last_name string, marital_status int, member_status int, join_date date, release_date date,
    is_active int
    """,
    "loan_summary": """
    loan_summary_id bigint, organization_id bigint, office_id bigint, center_id bigint,
    member_id bigint, product_id bigint, loan_term int, member_category_id bigint, purpose_id bigint,
    employee_id bigint, investor_id bigint, loan_no string, duration int, installment_no int,
    principal_loan decimal(18,2), loan_repaid decimal(18,2), loan_installment decimal(18,2),
    int_installment decimal(18,2), interest_rate decimal(18,2), int_charge decimal(18,2),
    int_paid decimal(18,2), cum_loan_due decimal(18,2), cum_int_due decimal(18,2),
    cur_loan decimal(18,2), cur_int_paid decimal(18,2), cur_int_charge decimal(18,2),
    cur_loan_due decimal(18,2), cur_int_due decimal(18,2), advance decimal(18,2),
    write_off_loan decimal(18,2), write_off_interest decimal(18,2), installment_date date,
    installment_start_date date, disburse_date date, loan_close_date date, trans_type string,
    bank_name string, disbursement_type int, partial_amount decimal(18,2),
    partial_int_charge decimal(18,2), partial_int_paid decimal(18,2), approved_amount decimal(18,2),
    final_disbursement int, posted int, loan_status int, is_active int, is_approved int
    """,
    "daily_loan_trx": """
    daily_loan_trx_id bigint, trx_date date, loan_summary_id bigint, organization_id bigint,
    office_id bigint, member_id bigint, product_id bigint, center_id bigint, member_category_id bigint,
    loan_term int, purpose_id bigint, installment_date date, principal_loan decimal(18,2),
    loan_repaid decimal(18,2), loan_due decimal(18,2), loan_paid decimal(18,2),
    cum_int_charge decimal(18,2), int_charge decimal(18,2), int_due decimal(18,2),
    int_paid decimal(18,2), advance decimal(18,2), due_recovery decimal(18,2), trx_type int,
    installment_no int, employee_id bigint, member_code string, member_name string,
    product_code string, product_name string, interest_calculation_method string, investor_id bigint,
    loan_no string, duration int
    """,
    "loan_trx": """
    loan_trx_id bigint, trx_date date, installment_date date, loan_summary_id bigint,
    organization_id bigint, office_id bigint, center_id bigint, member_id bigint, product_id bigint,
    loan_term int, principal_loan decimal(18,2), loan_paid decimal(18,2), loan_due decimal(18,2),
    int_due decimal(18,2), int_charge decimal(18,2), int_paid decimal(18,2), trx_type int,
    installment_no int, member_category_id bigint, employee_id bigint, investor_id bigint
    """,
    "saving_summary": """
    saving_summary_id bigint, organization_id bigint, office_id bigint, member_id bigint,
    product_id bigint, center_id bigint, no_of_account int, transaction_date date,
    deposit decimal(18,2), withdrawal decimal(18,2), balance decimal(18,2),
    interest_rate decimal(18,2), saving_installment decimal(18,2), cum_interest decimal(18,2),
    monthly_interest decimal(18,2), penalty decimal(18,2), opening_date date, closing_date date,
    trans_type int, saving_status int, employee_id bigint, member_category_id bigint, is_active int,
    cur_deposit decimal(18,2), cur_withdrawal decimal(18,2), cur_interest decimal(18,2),
    cur_penalty decimal(18,2)
    """,
    "daily_saving_trx": """
    daily_saving_trx_id bigint, saving_summary_id bigint, organization_id bigint, office_id bigint,
    member_id bigint, product_id bigint, center_id bigint, no_of_account int, transaction_date date,
    due_saving_installment decimal(18,2), saving_installment decimal(18,2), deposit decimal(18,2),
    withdrawal decimal(18,2), balance decimal(20,2), penalty decimal(18,2), trans_type int,
    monthly_interest decimal(18,2), presence_ind int, transfer_deposit decimal(18,2),
    transfer_withdrawal decimal(18,2), member_code string, member_name string, employee_id bigint,
    member_category_id bigint, product_code string, product_name string, bank_name string
    """,
    "saving_trx": """
    saving_trx_id bigint, saving_summary_id bigint, organization_id bigint, office_id bigint,
    center_id bigint, member_id bigint, product_id bigint, no_of_account int, deposit decimal(18,2),
    withdrawal decimal(18,2), balance decimal(18,2), transaction_date date, trans_type int,
    monthly_interest decimal(18,2), penalty decimal(18,2)
    """,
    "acc_chart": """
    acc_id int, acc_code string, organization_id bigint, is_active int
    """,
    "accounting_interface": """
    product_id bigint, trx_ind string, voucher_type string, trx_type string, voucher_category string,
    acc_code string
    """,
    "acc_trx_master": """
    trx_master_id bigint, organization_id bigint, office_id bigint, trx_date date, voucher_no string,
    voucher_type string, is_posted int, is_auto_voucher int, is_active int
    """,
    "acc_trx_detail": """
    trx_details_id bigint, trx_master_id bigint, trx_date date, acc_id bigint, debit decimal(18,2),
    credit decimal(18,2), narration string, is_active int
    """,
    "holidays": """
    office_id bigint, organization_id bigint, center_id bigint, business_date date,
    holiday_type string, is_active int
    """,
    "process_info": """
    process_info_id bigint, office_id bigint, organization_id bigint, business_date date,
    initial_date date, closing_date date, closing_status int, initial_status int,
    month_closing_status int, month_closing_date date
    """,
    "expire_infos": """
    office_id bigint, center_id bigint, member_id bigint, expire_date date
    """,
    "family_grace": """
    office_id bigint, center_id bigint, member_id bigint, grace_start_date date, grace_end_date date
    """,
    "transfer_history": """
    transfer_history_id bigint, tr_member_id bigint, office_id bigint
    """,
    "miscellaneous": """
    miscellaneous_id bigint, office_id bigint, product_id bigint, trx_date date, amount decimal(18,2),
    is_active int
    """,
    "application_settings": """
    office_id bigint, organization_id bigint, year_closing_date date, cash_book string
    """,
    "auto_voucher_check": """
    office_id bigint, check_auto_voucher int
    """,
    "acc_last_voucher": """
    office_id bigint, voucher_no string
    """,
    "collection_loan_savings": """
    summary_id bigint, office_id bigint, center_id bigint, member_id bigint, product_id bigint,
    loan_paid decimal(18,2), deposit decimal(18,2), withdrawal decimal(18,2), collection_date date,
    is_uploaded int
    """,
    "collection_loan_savings_history": """
    summary_id bigint, office_id bigint, center_id bigint, member_id bigint, product_id bigint,
    loan_paid decimal(18,2), deposit decimal(18,2), withdrawal decimal(18,2), collection_date date,
    is_uploaded int
    """,
    "month_wise_saving_interest": """
    organization_id bigint, office_id bigint, center_id bigint, member_id bigint, product_id bigint,
    balance decimal(18,2), interest decimal(18,2), transaction_date date, no_of_account int,
    saving_summary_id bigint
    """,
    "voucher_control": """
    office_id bigint, organization_id bigint, first_date date
    """,
    "key_control": """
    table_name string, last_key bigint
    """,
    "totals_until": """
    office_id bigint, until date
    """,
    "loan_totals": """
    office_id bigint, center_id bigint, member_id bigint, product_id bigint, loan_term int,
    loan_summary_id bigint, principal_loan decimal(28,2), loan_due decimal(28,2),
    int_charge decimal(28,2), int_due decimal(28,2), installment_no int
    """,
}
