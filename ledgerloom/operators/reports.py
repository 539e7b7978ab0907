"""Daily savings transaction report per product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.money import whole
from ledgerloom.sources.tables import Tables


def savings_report(t: Tables) -> DataFrame:
    """Thirteen measures per product, whole numbers.

    Members are counted by reducing to (product, member) first: two aggregations with map-side combine instead of
    three distinct counts that would copy every row.
    """
    summed = {
        "monthly_interest": "monthly_interest",
        "penalty": "penalty",
        "saving_deposit": "deposit",
        "saving_installment": "saving_installment",
        "saving_withdrawal": "withdrawal",
        "transfer_deposit": "transfer_deposit",
        "transfer_withdrawal": "transfer_withdrawal",
    }
    tests = {
        "depositor": F.col("saving_installment") != 0,
        "non_depositor": F.col("saving_installment") == 0,
        "withdrawer": F.col("withdrawal") != 0,
    }
    per_member = t.daily_saving_trx.groupBy("product_id", "member_id").agg(
        *[F.sum(c).alias(name) for name, c in summed.items()],
        *[F.max(F.when(test, 1).otherwise(0)).alias(name) for name, test in tests.items()],
    )
    counted = F.col("member_id").isNotNull()
    day = per_member.groupBy("product_id").agg(
        *[whole(F.sum(name)).alias(name) for name in summed],
        *[F.sum(F.when(counted, F.col(name)).otherwise(0)).alias(name) for name in tests],
    )
    balance = F.col("deposit") + F.col("cum_interest") + F.col("penalty") - F.col("withdrawal")
    opening = t.saving_summary.groupBy("product_id").agg(whole(F.sum(balance)).alias("opening_balance"))
    report = opening.join(day, "product_id", "full").na.fill(0, list(tests))
    closing = (
        F.col("opening_balance")
        + F.col("saving_deposit")
        + F.col("transfer_deposit")
        + F.col("monthly_interest")
        + F.col("penalty")
        - F.col("saving_withdrawal")
        - F.col("transfer_withdrawal")
    )
    return report.withColumn("closing_balance", whole(closing))


def savings_products(t: Tables) -> DataFrame:
    """Active savings products per office, as code and name."""
    products = t.products.filter("product_type = 0 AND is_active = 1").select(
        "product_id", F.concat_ws(" ", "product_code", "product_name").alias("product")
    )
    return t.product_mappings.join(products, "product_id").select("office_id", "product_id", "product")
