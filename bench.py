"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS choose data and cores; BENCH_KEYS=all times every query,
or names some of them separated by commas. Each query is fully consumed by a no-op sink: one warm-up, then the median
of BENCH_RUNS (3) runs; whole processes run once. Deriving the domain tables from the supplied ones is reported apart.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from ledgerloom.catalog import QUERIES
from ledgerloom.session import build_session
from ledgerloom.sources.fixture_sql import FIXTURE_SQL
from ledgerloom.sources.fixtures import derived_tables

HEADLINE = (
    "mfi_loan_due",
    "mfi_int_due",
    "sod_weekly_savings",
    "sod_compulsory_savings",
    "sod_weekly_loans",
    "sod_monthly_loans",
    "sod_last_installment",
    "sod_drop_holiday_rows",
    "eod_dedupe_charges",
    "eod_adj_excess_interest",
    "eod_excess_deposit",
    "eod_roll_loan_summary",
    "eod_roll_saving_summary",
    "eod_zero_repeat_due",
    "eod_final_due",
    "eod_drop_members",
    "eod_resync_mtd",
    "acc_day_ledger",
    "acc_close_accounts",
    "val_start_of_day",
    "val_day_end",
    "voucher_postings",
    "voucher_gates",
    "mon_min_balance",
    "mon_interest_final",
    "mon_loan_accrual",
    "mon_accrual_trx",
    "dstr_report",
    "run_start_of_day",
    "run_day_end",
    "run_month_close",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_KEYS", "")
    keys = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else list(HEADLINE)
    partitions = int(cpus) if cpus.isdigit() else 8
    spark = build_session(
        f"local[{cpus}]",
        shuffle_partitions=partitions,
        **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    started = time.perf_counter()
    tables = derived_tables(spark, sf_dir)
    for name in FIXTURE_SQL:
        getattr(tables, name)
    derived = time.perf_counter() - started

    seconds = {}
    for key in keys:
        # whole processes run once: they follow the other queries, so the session is warm
        whole = key.startswith("run_")
        timings = []
        for attempt in range(1 if whole else runs + 1):
            begun = time.perf_counter()
            QUERIES[key].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if attempt or whole:
                timings.append(time.perf_counter() - begun)
        seconds[key] = round(statistics.median(timings), 3)
        print(f"{key} {seconds[key]}", file=sys.stderr, flush=True)
    result = {
        "metric": "sum of median query seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "derive_tables_sec": round(derived, 3),
        "sf": sf_dir.rsplit("sf", 1)[-1],
    }
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
