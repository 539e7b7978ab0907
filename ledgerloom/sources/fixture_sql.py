"""How each domain table is derived from the supplied parquet tables.

Every text is plain SQL that Spark and DuckDB both read and evaluate to the same rows, so the engine and its
SQL check start from identical inputs. Later entries read earlier ones.

The texts are written for one day and one organization. ``_for_each_office`` then gives each office its own: a table
``x`` with an office is read from ``base_x``, with its dates moved by the office's days and the office's organization.
"""

from __future__ import annotations

import re

from ledgerloom.schemas import SCHEMAS

SUPPLIED = ("nation", "customer", "part", "orders", "lineitem", "events")

FIXTURE_SQL: dict[str, str] = {
    "offices": """
        SELECT CAST(n_nationkey+1 AS BIGINT) office_id, CAST(4 AS BIGINT) organization_id, CASE WHEN n_nationkey%9=0
        THEN '99901' ELSE concat('1', lpad(concat('',n_nationkey),4,'0')) END office_code FROM nation
    """,
    "run_control": """
        SELECT office_id, organization_id, DATE '2001-07-16' business_date, DATE '2001-07-31' month_end_date FROM
        offices
    """,
    "centers": """
        SELECT DISTINCT CAST((c_nationkey+1)*100+c_custkey%5 AS BIGINT) center_id, CAST(c_nationkey+1 AS BIGINT)
        office_id, CASE WHEN c_custkey%5<3 THEN 'Monday' WHEN c_custkey%5=3 THEN 'Tuesday' ELSE 'Wednesday' END
        collection_day, CASE WHEN c_custkey%5<2 THEN DATE '2001-07-16' ELSE DATE '2001-07-16'+1 END collection_date
        FROM customer
    """,
    "member_categories": """
        SELECT * FROM (VALUES (CAST(1 AS BIGINT),CAST(10.00 AS DECIMAL(18,2)),CAST(5.00 AS DECIMAL(18,2)),CAST(7.50
        AS DECIMAL(18,2)),'2100'),(2,15.00,5.00,8.25,'2101'),(3,20.00,6.00,9.00,'2102'))
        t(member_category_id,admission_fee,pass_book_fee,loan_form_fee,category_short_name_bng)
    """,
    "product_counts": """
        SELECT CAST(floor(count(*)/24) AS BIGINT) sets FROM part
    """,
    "products": """
        SELECT CAST(p_partkey+1 AS BIGINT) product_id, concat(CASE WHEN k<4 THEN '21' WHEN k<6 THEN '20' WHEN k<8
        THEN '22' WHEN k>=22 THEN '71' ELSE '11' END, lpad(concat('',k),2,'0'), CASE WHEN p_partkey<24 THEN ''
        ELSE lpad(concat('',p_partkey),9,'0') END) product_code, p_name product_name, CASE WHEN k<4 THEN '2101'
        WHEN k<8 THEN '2201' WHEN k IN (8,9,14) THEN '111' ELSE '1201' END main_product_code, CASE WHEN k IN (3,7)
        THEN 'DPS' ELSE 'GS' END sub_main_category, CASE WHEN k<8 THEN 0 WHEN k%7=0 THEN 2 WHEN k%11=0 THEN 3
        ELSE 1 END product_type, substr('FADERH',CAST(k%6+1 AS INT),1) interest_calculation_method, CASE WHEN
        k IN (3,7) THEN 'M' WHEN k IN (20,21) THEN 'F' WHEN k BETWEEN 12 AND 17 THEN 'M' ELSE 'W' END payment_frequency,
        CAST(8+k%9 AS DECIMAL(18,2)) interest_rate, CAST(1+k%2 AS DECIMAL(18,2)) insurance_item_rate, 1 is_active
        FROM (SELECT p_partkey, p_name, p_partkey%24 k FROM part) line
    """,
    "product_mappings": """
        SELECT o.office_id, p.product_id FROM offices o CROSS JOIN products p WHERE (o.office_id+p.product_id)%3<>0
    """,
    "members": """
        SELECT c_custkey+1 member_id, CAST(4 AS BIGINT) organization_id, CAST(c_nationkey+1 AS BIGINT) office_id,
        CAST((c_nationkey+1)*100+c_custkey%5 AS BIGINT) center_id, 1+c_custkey%3 member_category_id, concat('M',c_custkey)
        member_code, c_name first_name, CASE WHEN c_custkey%4=0 THEN NULL ELSE 'X' END middle_name, c_mktsegment
        last_name, CAST(c_custkey%2 AS INT) marital_status, CASE WHEN c_custkey%23=0 THEN 2 ELSE 1 END member_status,
        CASE WHEN c_custkey%19=0 THEN DATE '2001-07-16' ELSE DATE '1999-01-01'+CAST(c_custkey%300 AS INT) END
        join_date, CAST(NULL AS DATE) release_date, CASE WHEN c_custkey%31=0 THEN 0 ELSE 1 END is_active FROM
        customer
    """,
    "loan_summary": """
        SELECT x+1 loan_summary_id, CAST(4 AS BIGINT) organization_id, office_id, center_id, member_id, CAST(24*(x%sets)+9+x%16
        AS BIGINT) product_id, CAST(1+x%3 AS INT) loan_term, member_category_id, x%9 purpose_id, x%40 employee_id,
        x%4 investor_id, concat('L',x) loan_no, dur duration, no installment_no, CAST(prin AS DECIMAL(18,2)) principal_loan,
        CAST(CASE WHEN cx%97 IN (5,7) THEN prin WHEN x%41=0 THEN prin+5 WHEN x%17=0 OR li*no>prin THEN prin ELSE
        li*no END AS DECIMAL(18,2)) loan_repaid, CAST(li AS DECIMAL(18,2)) loan_installment, CAST(ii AS DECIMAL(18,2))
        int_installment, CAST(8+x%9 AS DECIMAL(18,2)) interest_rate, CAST(chg AS DECIMAL(18,2)) int_charge, CAST(CASE
        WHEN cx%97 IN (5,7) THEN chg ELSE (CASE WHEN x%17=0 OR ii*no>chg THEN chg ELSE ii*no END)+(CASE WHEN x%29=0
        THEN 12 ELSE 0 END) END AS DECIMAL(18,2)) int_paid, CAST(li*(CASE WHEN no>dur THEN dur ELSE no END) AS
        DECIMAL(18,2)) cum_loan_due, CAST(ii*(CASE WHEN no>dur THEN dur ELSE no END) AS DECIMAL(18,2)) cum_int_due,
        CAST(x%7*10 AS DECIMAL(18,2)) cur_loan, CAST(x%5*10 AS DECIMAL(18,2)) cur_int_paid, CAST(x%3*10 AS DECIMAL(18,2))
        cur_int_charge, CAST(x%7*10 AS DECIMAL(18,2)) cur_loan_due, CAST(x%5*10 AS DECIMAL(18,2)) cur_int_due,
        CAST(0 AS DECIMAL(18,2)) advance, CAST(NULL AS DECIMAL(18,2)) write_off_loan, CAST(NULL AS DECIMAL(18,2))
        write_off_interest, CASE WHEN x%13=0 THEN DATE '2001-07-16' ELSE DATE '2001-07-16'-CAST(x%45 AS INT) END
        installment_date, DATE '2001-07-16'-300+CAST(x%320 AS INT) installment_start_date, CASE WHEN x%37=0 THEN
        CAST(NULL AS DATE) WHEN x%13=0 THEN DATE '2001-07-16' ELSE DATE '2001-07-16'-400+CAST(x%300 AS INT) END
        disburse_date, CAST(NULL AS DATE) loan_close_date, CASE WHEN x%4=1 THEN '102' WHEN x%4=2 THEN '103' ELSE
        '101' END trans_type, concat('BK',x%2) bank_name, CASE WHEN x%5=0 THEN 2 ELSE 1 END disbursement_type,
        CAST(500 AS DECIMAL(18,2)) partial_amount, CAST(60 AS DECIMAL(18,2)) partial_int_charge, CAST(x%3*10 AS
        DECIMAL(18,2)) partial_int_paid, CAST(prin+500*(x%2) AS DECIMAL(18,2)) approved_amount, CAST(x%2 AS INT)
        final_disbursement, CASE WHEN x%13=0 THEN 0 ELSE 1 END posted, CASE WHEN x%11=0 OR cx%97 IN (5,7) THEN
        0 ELSE 1 END loan_status, CASE WHEN x%53=0 THEN 0 ELSE 1 END is_active, 1 is_approved FROM (SELECT a.*,
        CAST(floor(prin/dur) AS BIGINT) li, CAST(floor(chg/dur) AS BIGINT) ii FROM (SELECT sets, o_orderkey x, o_custkey
        cx, m.office_id, m.center_id, m.member_id, m.member_category_id, 1000*(1+o_orderkey%50) prin, 120*(1+o_orderkey%50)
        chg, CASE WHEN o_orderkey%3=0 THEN 46 WHEN o_orderkey%3=1 THEN 12 ELSE 24 END dur, CAST(o_orderkey%50
        AS INT) no FROM orders JOIN members m ON m.member_id=o_custkey+1 CROSS JOIN product_counts) a) b
    """,
    "daily_loan_trx": """
        SELECT ok*10+ln daily_loan_trx_id, DATE '2001-07-16' trx_date, l.loan_summary_id, l.organization_id, l.office_id,
        l.member_id, l.product_id, l.center_id, l.member_category_id, l.loan_term, l.purpose_id, DATE '2001-07-16'
        installment_date, l.principal_loan, l.loan_repaid, CAST(CASE WHEN ln<=3 THEN q*5 ELSE 0 END AS DECIMAL(18,2))
        loan_due, CAST(CASE WHEN (ok+ln)%23=0 THEN -q ELSE q*7 END AS DECIMAL(18,2)) loan_paid, l.int_charge cum_int_charge,
        CAST(CASE WHEN ln%2=1 THEN q ELSE 0 END AS DECIMAL(18,2)) int_charge, CAST(CASE WHEN ln<=2 THEN q*2 ELSE
        0 END AS DECIMAL(18,2)) int_due, CAST(CASE WHEN (ok+ln)%19=0 THEN -q ELSE q*2 END AS DECIMAL(18,2)) int_paid,
        l.advance, l.int_paid due_recovery, CASE CAST((ok+ln)%11 AS INT) WHEN 0 THEN 10 WHEN 1 THEN 20 WHEN 2
        THEN 41 WHEN 3 THEN 11 WHEN 4 THEN 21 WHEN 5 THEN 31 WHEN 6 THEN 71 WHEN 7 THEN 32 WHEN 8 THEN 50 ELSE
        10 END trx_type, l.installment_no+1 installment_no, l.employee_id, m.member_code, m.first_name member_name,
        p.product_code, p.product_name, p.interest_calculation_method, l.investor_id, l.loan_no, l.duration FROM
        (SELECT l_orderkey ok, l_linenumber ln, CAST(sum(l_quantity) AS BIGINT) q FROM lineitem GROUP BY l_orderkey,
        l_linenumber) k JOIN loan_summary l ON l.loan_summary_id=ok+1 JOIN members m ON m.member_id=l.member_id
        JOIN products p ON p.product_id=l.product_id
    """,
    "loan_trx": """
        SELECT ok*10+ln loan_trx_id, DATE '2001-06-15'+CAST((ok*7+ln*5)%47 AS INT) trx_date, DATE '2001-06-15'+CAST((ok*7+ln*5)%47
        AS INT) installment_date, l.loan_summary_id, l.organization_id, l.office_id, l.center_id, l.member_id,
        l.product_id, l.loan_term, CAST(CASE WHEN ln=1 THEN 1000 ELSE 0 END AS DECIMAL(18,2)) principal_loan,
        CAST(q*7 AS DECIMAL(18,2)) loan_paid, CAST(q*5 AS DECIMAL(18,2)) loan_due, CAST(q AS DECIMAL(18,2)) int_due,
        CAST(q AS DECIMAL(18,2)) int_charge, CAST(q*2 AS DECIMAL(18,2)) int_paid, CASE WHEN ln=6 THEN 52 ELSE
        10 END trx_type, l.installment_no, l.member_category_id, l.employee_id, l.investor_id FROM (SELECT l_orderkey
        ok, l_linenumber ln, CAST(sum(l_quantity) AS BIGINT) q FROM lineitem GROUP BY l_orderkey, l_linenumber)
        k JOIN loan_summary l ON l.loan_summary_id=ok+1
    """,
    "saving_summary": """
        SELECT (m.member_id-1)*2+a.a+1 saving_summary_id, m.organization_id, m.office_id, m.member_id, CAST(24*(m.member_id%sets)+1+(m.member_id+a.a*3)%8
        AS BIGINT) product_id, m.center_id, a.a+1 no_of_account, DATE '2001-07-16'-CAST((m.member_id+a.a*7)%60
        AS INT) transaction_date, CAST(100*(m.member_id%30) AS DECIMAL(18,2)) deposit, CAST(CASE WHEN m.member_id%97
        IN (6,8) THEN 100*(m.member_id%30)+m.member_id%9 WHEN m.member_id%6=0 THEN 100*(m.member_id%30)+m.member_id%9
        ELSE 20*(m.member_id%3) END AS DECIMAL(18,2)) withdrawal, CAST(0 AS DECIMAL(18,2)) balance, CAST(6 AS
        DECIMAL(18,2)) interest_rate, CAST(20+10*a.a AS DECIMAL(18,2)) saving_installment, CAST(m.member_id%9
        AS DECIMAL(18,2)) cum_interest, CAST(m.member_id%4 AS DECIMAL(18,2)) monthly_interest, CAST(CASE WHEN
        m.member_id%10=9 THEN 3 ELSE 0 END AS DECIMAL(18,2)) penalty, CASE WHEN m.member_id%4=0 THEN DATE '2001-07-01'+CAST((m.member_id*3+a.a)%20
        AS INT) ELSE DATE '2000-01-01'+CAST(m.member_id%400 AS INT) END opening_date, CAST(NULL AS DATE) closing_date,
        10 trans_type, CASE WHEN (m.member_id+a.a)%14=0 OR m.member_id%97=6 THEN 0 ELSE 1 END saving_status, m.member_id%40
        employee_id, m.member_category_id, CASE WHEN m.member_id%59=0 THEN 0 ELSE 1 END is_active, CAST(0 AS DECIMAL(18,2))
        cur_deposit, CAST(0 AS DECIMAL(18,2)) cur_withdrawal, CAST(0 AS DECIMAL(18,2)) cur_interest, CAST(0 AS
        DECIMAL(18,2)) cur_penalty FROM members m CROSS JOIN (SELECT 0 a UNION ALL SELECT 1 a) a CROSS JOIN
        product_counts
    """,
    "daily_saving_trx": """
        SELECT o.o_orderkey+1 daily_saving_trx_id, s.saving_summary_id, s.organization_id, s.office_id, s.member_id,
        s.product_id, s.center_id, s.no_of_account, DATE '2001-07-16' transaction_date, s.saving_installment due_saving_installment,
        CAST(CASE WHEN o.o_orderkey%5=0 THEN 0 ELSE 10*(o.o_orderkey%12) END AS DECIMAL(18,2)) saving_installment,
        s.deposit, CAST(CASE WHEN o.o_orderkey%4=0 THEN 5*(o.o_orderkey%9) ELSE 0 END AS DECIMAL(18,2)) withdrawal,
        s.deposit+s.cum_interest-s.withdrawal balance, CAST(CASE WHEN o.o_orderkey%20=0 THEN 2 ELSE 0 END AS DECIMAL(18,2))
        penalty, CASE CAST(o.o_orderkey%9 AS INT) WHEN 0 THEN 10 WHEN 1 THEN 20 WHEN 2 THEN 41 WHEN 3 THEN 22
        WHEN 4 THEN 11 WHEN 5 THEN 21 WHEN 6 THEN 71 WHEN 7 THEN 23 ELSE 32 END trans_type, CAST(o.o_orderkey%5
        AS DECIMAL(18,2)) monthly_interest, 1 presence_ind, s.cum_interest transfer_deposit, s.withdrawal transfer_withdrawal,
        m.member_code, m.first_name member_name, s.employee_id, s.member_category_id, p.product_code, p.product_name,
        concat('BK',o.o_orderkey%2) bank_name FROM orders o JOIN saving_summary s ON s.saving_summary_id=o.o_custkey*2+o.o_orderkey%2+1
        JOIN members m ON m.member_id=s.member_id JOIN products p ON p.product_id=s.product_id
    """,
    "saving_trx": """
        SELECT o.o_orderkey+1 saving_trx_id, s.saving_summary_id, s.organization_id, s.office_id, s.center_id,
        s.member_id, s.product_id, s.no_of_account, CAST(10*(o.o_orderkey%12) AS DECIMAL(18,2)) deposit, CAST(CASE
        WHEN o.o_orderkey%4=0 THEN 5*(o.o_orderkey%9) ELSE 0 END AS DECIMAL(18,2)) withdrawal, CAST(500+10*(o.o_orderkey%40)
        AS DECIMAL(18,2)) balance, CASE WHEN o.o_orderkey%6=0 THEN s.transaction_date WHEN o.o_orderkey%6=1 THEN
        s.opening_date ELSE DATE '2001-06-20'+CAST(o.o_orderkey%42 AS INT) END transaction_date, 10 trans_type,
        CAST(o.o_orderkey%5 AS DECIMAL(18,2)) monthly_interest, CAST(0 AS DECIMAL(18,2)) penalty FROM orders o
        JOIN saving_summary s ON s.saving_summary_id=o.o_custkey*2+o.o_orderkey%2+1 JOIN members m ON m.member_id=s.member_id
        JOIN products p ON p.product_id=s.product_id
    """,
    "acc_chart": """
        SELECT CAST(u.id AS BIGINT) acc_id, u.acc_code, CAST(4 AS BIGINT) organization_id, CASE WHEN u.acc_code='SW3'
        THEN 0 ELSE 1 END is_active FROM (SELECT 38+product_id id, product_code acc_code FROM products UNION ALL
        SELECT i.n*4+k.k+1, concat(i.c, k.k) FROM (VALUES (0,'LR'),(1,'SR'),(2,'SD'),(3,'SW'),(4,'LD'),(5,'GS'),(6,'RB'))
        i(n,c) CROSS JOIN (VALUES (0),(1),(2),(3)) k(k) UNION ALL SELECT v.n, v.c FROM (VALUES (29,'MA'),(30,'PB'),(31,'LF'),(32,'RMC'),(33,'RMD'),(34,'RH'),(35,'LL'),(36,'BK0'),(37,'BK1'),(38,'CASH'))
        v(n,c)) u
        UNION ALL SELECT 1000000000+o.n, 'CASH', CAST(o.n AS BIGINT), 1 FROM (VALUES (5),(7),(12),(54)) o(n)
    """,
    "accounting_interface": """
        SELECT p.product_id, i.ind trx_ind, i.vt voucher_type, i.vt trx_type, 'CA' voucher_category, concat(i.ind,
        p.product_id%4) acc_code FROM products p CROSS JOIN (VALUES ('LR','Cr'),('SR','Cr'),('SD','Cr'),('SW','Dr'),('LD','Dr'),('GS','Cr'),('RB','Dr'))
        i(ind,vt) UNION ALL SELECT CAST(NULL AS BIGINT), v.ind, v.vt, v.vt, 'CA', v.code FROM (VALUES ('MA','Cr','MA'),('PB','Cr','PB'),('LF','Cr','LF'),('RM','Cr','RMC'),('RM','Dr','RMD'),('RH','Cr','RH'),('LL','Cr','LL'))
        v(ind,vt,code)
    """,
    "acc_trx_master": """
        SELECT o_orderkey+1 trx_master_id, m.organization_id, m.office_id, CASE WHEN o_orderkey%3=0 THEN DATE
        '2001-07-16' ELSE DATE '2001-07-16'-CAST(o_orderkey%30 AS INT) END trx_date, concat(lpad(concat('',o_orderkey%90+1),2,'0'),'-2001')
        voucher_no, CASE CAST(o_orderkey%4 AS INT) WHEN 0 THEN 'CA' WHEN 1 THEN 'Jr' WHEN 2 THEN 'Ba' ELSE 'Bc'
        END voucher_type, CASE WHEN o_orderkey%3=0 THEN 0 ELSE 1 END is_posted, CAST(o_orderkey%2 AS INT) is_auto_voucher,
        CASE WHEN o_orderkey%21=0 THEN 0 ELSE 1 END is_active FROM orders JOIN members m ON m.member_id=o_custkey+1
    """,
    "acc_trx_detail": """
        SELECT ok*10+ln trx_details_id, ok+1 trx_master_id, m.trx_date, 1+(ok+ln)%40 acc_id, CAST(CASE WHEN ln%2=1 THEN q*10
        ELSE 0 END AS DECIMAL(18,2)) debit, CAST(CASE WHEN ln%2=0 THEN q*10 ELSE 0 END AS DECIMAL(18,2)) credit,
        concat('n',ln) narration, CASE WHEN ok%27=0 THEN 0 ELSE 1 END is_active FROM acc_trx_master m JOIN (SELECT l_orderkey ok, l_linenumber
        ln, CAST(sum(l_quantity) AS BIGINT) q FROM lineitem GROUP BY l_orderkey, l_linenumber) k ON m.trx_master_id=ok+1
    """,
    "holidays": """
        SELECT office_id, organization_id, CAST(NULL AS BIGINT) center_id, DATE '2001-07-16'-1 business_date,
        'Weekly' holiday_type, 1 is_active FROM offices UNION ALL SELECT office_id, organization_id, CAST(NULL
        AS BIGINT), DATE '2001-07-16'+14, 'Govt', 1 FROM offices WHERE office_id%2=0 UNION ALL SELECT office_id,
        organization_id, CAST(NULL AS BIGINT), DATE '2001-07-16', 'Govt', 1 FROM offices WHERE office_id%10=0
        UNION ALL SELECT office_id, CAST(4 AS BIGINT), center_id, DATE '2001-07-16', 'Office', 1 FROM centers
        WHERE center_id%7=0 UNION ALL SELECT office_id, organization_id, CAST(NULL AS BIGINT), DATE '2001-07-31',
        'Weekly', 1 FROM offices
    """,
    "process_info": """
        SELECT office_id*1000+g.g process_info_id, office_id, organization_id, DATE '2001-07-16'-2-g.g business_date,
        DATE '2001-07-16'-2-g.g initial_date, CASE WHEN office_id%8=0 AND g.g=0 THEN CAST(NULL AS DATE) ELSE DATE
        '2001-07-16'-2-g.g END closing_date, CASE WHEN office_id%8=0 AND g.g=0 THEN 0 ELSE 1 END closing_status,
        1 initial_status, CASE WHEN g.g=15 THEN 1 ELSE 0 END month_closing_status, CASE WHEN g.g=15 THEN DATE
        '2001-06-30' ELSE CAST(NULL AS DATE) END month_closing_date FROM offices CROSS JOIN (VALUES (0),(1),(2),(14),(15))
        g(g) WHERE NOT (office_id%9=0 AND g.g<2) UNION ALL SELECT office_id*1000+999, office_id, organization_id,
        DATE '2001-07-16', DATE '2001-07-16', CAST(NULL AS DATE), 0, 0, 0, CAST(NULL AS DATE) FROM offices WHERE
        office_id%5=0
    """,
    "expire_infos": """
        SELECT office_id, center_id, member_id, DATE '2001-07-16'-CAST(member_id%500 AS INT) expire_date FROM
        members WHERE member_id%25=0
    """,
    "family_grace": """
        SELECT office_id, center_id, member_id, DATE '2001-07-16'-CAST(member_id%20 AS INT) grace_start_date,
        DATE '2001-07-16'-5+CAST(member_id%20 AS INT) grace_end_date FROM members WHERE member_id%15=0
    """,
    "transfer_history": """
        SELECT member_id transfer_history_id, member_id tr_member_id, office_id FROM members WHERE member_id%38=1
    """,
    "miscellaneous": """
        SELECT o_orderkey+1 miscellaneous_id, m.office_id, CAST(1+24*(o_orderkey%sets)+o_orderkey%24 AS BIGINT) product_id, CASE WHEN
        o_orderkey%2=0 THEN DATE '2001-07-16' ELSE DATE '2001-07-16'-1 END trx_date, CAST(10+o_orderkey%90 AS
        DECIMAL(18,2)) amount, CASE WHEN o_orderkey%7=0 THEN 0 ELSE 1 END is_active FROM orders JOIN members m
        ON m.member_id=o_custkey+1 CROSS JOIN product_counts
    """,
    "application_settings": """
        SELECT office_id, organization_id, DATE '2000-12-31' year_closing_date, 'CASH' cash_book FROM offices
    """,
    "auto_voucher_check": """
        SELECT office_id, CASE WHEN office_id%3=0 THEN 0 ELSE 1 END check_auto_voucher FROM offices WHERE office_id%4<>0
    """,
    "acc_last_voucher": """
        SELECT office_id, concat(lpad(concat('',office_id),2,'0'),'-2000') voucher_no FROM offices
    """,
    "collection_loan_savings": """
        SELECT event_id summary_id, m.office_id, m.center_id, m.member_id, CAST(1+24*(event_id%sets)+event_id%24 AS BIGINT) product_id,
        CAST(event_id%300 AS DECIMAL(18,2)) loan_paid, CAST(event_id%70 AS DECIMAL(18,2)) deposit, CAST(event_id%11
        AS DECIMAL(18,2)) withdrawal, CASE WHEN event_id%2=0 THEN DATE '2001-07-16' ELSE DATE '2001-07-16'-1 END
        collection_date, CAST(event_id%2 AS INT) is_uploaded FROM events JOIN members m ON m.member_id=user_id+1 CROSS JOIN
        product_counts
    """,
}

_SOURCE = re.compile(r"\b(FROM|JOIN)\s+([a-z_]+)\b")

#: Days by which an office's dates lie later; ends of months stay ends of months.
SHIFT = "(CASE CAST(office_id%3 AS INT) WHEN 0 THEN 28 WHEN 1 THEN 0 ELSE 1 END)"
ORGANIZATION = "CAST(CASE CAST(office_id%8 AS INT) WHEN 3 THEN 7 WHEN 5 THEN 5 WHEN 6 THEN 12 WHEN 7 THEN 54 ELSE 4 END AS BIGINT)"
_UNMOVED = ("year_closing_date",)


def _column_of_office(name: str, kind: str) -> str:
    if name == "organization_id":
        return f"{ORGANIZATION} organization_id"
    if kind == "date" and name not in _UNMOVED:
        end = f"{name}=last_day({name})"
        return f"CASE WHEN {end} AND {SHIFT}=1 THEN {name} WHEN {end} THEN last_day({name}+{SHIFT}) ELSE {name}+{SHIFT} END {name}"
    return name


def _for_each_office(texts: dict[str, str]) -> dict[str, str]:
    moved = {}
    for name in texts:
        columns = [item.split() for item in re.sub(r"\s+", " ", SCHEMAS[name]).strip().split(", ")]
        named = {column for column, _ in columns}
        if "office_id" in named and ("organization_id" in named or any(kind == "date" for _, kind in columns)):
            moved[name] = ", ".join(_column_of_office(*column) for column in columns)

    def of_base(found: re.Match) -> str:
        return f"{found[1]} base_{found[2]}" if found[2] in moved else found[0]

    out = {}
    for name, text in texts.items():
        text = _SOURCE.sub(of_base, text)
        if name in moved:
            out[f"base_{name}"] = text
            text = f"SELECT {moved[name]} FROM base_{name}"
        out[name] = text
    return out


FIXTURE_SQL = _for_each_office(FIXTURE_SQL)
# lines carry the date of their voucher as its office has it
FIXTURE_SQL["acc_trx_detail"] = FIXTURE_SQL["acc_trx_detail"].replace("base_acc_trx_master", "acc_trx_master")
# every office with a voucher
FIXTURE_SQL["voucher_control"] = """
        SELECT office_id, organization_id, min(trx_date) first_date FROM acc_trx_master GROUP BY office_id, organization_id
    """
# the last surrogate key of each table whose new rows get one
FIXTURE_SQL["key_control"] = """
        SELECT 'loan_trx' table_name, max(loan_trx_id) last_key FROM loan_trx
        UNION ALL SELECT 'saving_trx', max(saving_trx_id) FROM saving_trx
        UNION ALL SELECT 'process_info', max(process_info_id) FROM process_info
    """
# totals reach the first of the run's month; an office in five has none yet
FIXTURE_SQL["totals_until"] = """
        SELECT office_id, CAST(date_trunc('month', business_date) AS DATE) until FROM run_control WHERE office_id%5<>4
    """
FIXTURE_SQL["loan_totals"] = """
        SELECT h.office_id, h.center_id, h.member_id, h.product_id, h.loan_term, h.loan_summary_id, sum(h.principal_loan) principal_loan,
        sum(h.loan_due) loan_due, sum(h.int_charge) int_charge, sum(h.int_due) int_due, max(h.installment_no) installment_no
        FROM loan_trx h JOIN totals_until u ON u.office_id=h.office_id WHERE h.installment_date<u.until
        GROUP BY h.office_id, h.center_id, h.member_id, h.product_id, h.loan_term, h.loan_summary_id
    """


def sources_of(sql: str) -> list[str]:
    """Names of the fixture and supplied tables a text reads, in order of first use."""
    known = set(FIXTURE_SQL) | set(SUPPLIED)
    return list(dict.fromkeys(name for _, name in _SOURCE.findall(sql) if name in known))


def with_placeholders(sql: str) -> str:
    """The text with each source table written as a ``{name}`` placeholder."""
    names = set(sources_of(sql))
    return _SOURCE.sub(lambda m: f"{m[1]} {{{m[2]}}}" if m[2] in names else m[0], sql)
