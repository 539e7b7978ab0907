"""Derived tables: declared layout, unique keys, equal rows in both engines."""

import pytest
from conftest import SF_DIR

from ledgerloom.operators import changes
from ledgerloom.schemas import SCHEMAS
from ledgerloom.sources.fixture_sql import FIXTURE_SQL
from ledgerloom.sources.fixtures import derived_tables
from oracle import _needed

KEYS = {
    "offices": ["office_id"],
    "run_control": ["office_id"],
    "centers": ["center_id"],
    "products": ["product_id"],
    "product_mappings": ["office_id", "product_id"],
    "members": ["member_id"],
    "loan_summary": ["loan_summary_id"],
    "daily_loan_trx": ["daily_loan_trx_id"],
    "loan_trx": ["loan_trx_id"],
    "saving_summary": ["saving_summary_id"],
    "daily_saving_trx": ["daily_saving_trx_id"],
    "saving_trx": ["saving_trx_id"],
    "voucher_control": ["office_id", "organization_id"],
    "key_control": ["table_name"],
    "totals_until": ["office_id"],
    "loan_totals": ["loan_summary_id"],
    "acc_chart": ["organization_id", "acc_code"],
    "accounting_interface": ["product_id", "trx_ind", "voucher_type"],
    "acc_trx_master": ["trx_master_id"],
    "acc_trx_detail": ["trx_details_id"],
    "process_info": ["process_info_id"],
    "expire_infos": ["office_id", "center_id", "member_id"],
    "collection_loan_savings": ["summary_id"],
}


@pytest.mark.parametrize("name", sorted(FIXTURE_SQL))
def test_layout_and_count(name, tables, duck):
    df = getattr(tables, name)
    layout = ["".join(item.split(" ", 1)[1]) for item in SCHEMAS[name.removeprefix("base_")].strip().replace("\n    ", " ").split(", ")]
    assert [kind for _, kind in df.dtypes] == layout
    parts: dict[str, str] = {}
    _needed(f"SELECT * FROM {name}", parts)
    ctes = ", ".join(f"{part} AS ({sql})" for part, sql in parts.items())
    assert df.count() == duck.execute(f"WITH {ctes} SELECT count(*) FROM {name}").fetchone()[0]


@pytest.mark.parametrize("name", sorted(KEYS))
def test_unique_key(name, tables):
    df = getattr(tables, name)
    assert df.select(*KEYS[name]).distinct().count() == df.count()


def test_large_tables_are_derived_without_broadcast(spark, tables, monkeypatch):
    monkeypatch.setattr(changes, "BROADCAST_ROWS", 1)
    large = derived_tables(spark, f"{SF_DIR}/.")
    for name in ("loan_summary", "daily_loan_trx", "loan_trx", "daily_saving_trx", "saving_trx", "acc_trx_master"):
        base = getattr(large, f"base_{name}")
        assert "BroadcastHashJoin" not in base._jdf.queryExecution().executedPlan().toString(), name
        small = getattr(tables, f"base_{name}")
        assert base.exceptAll(small).isEmpty() and small.exceptAll(base).isEmpty(), name
    details, small = large.acc_trx_detail, tables.acc_trx_detail
    assert details.exceptAll(small).isEmpty() and small.exceptAll(details).isEmpty()
