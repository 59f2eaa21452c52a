"""Financial ratios of a cost report, from one column for each metric.

A ratio is null where an input is missing or a denominator is 0; nothing is filled in.
Sums are exact decimals, quotients are doubles: a decimal quotient would be cut to a few
places.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

HOURS_PER_FTE_YEAR = 2080
ACCUMULATED = ("land_improvements", "buildings", "leasehold", "fixed_equipment", "autos_trucks", "major_movable", "minor_movable")

#: name -> (numerator, denominator or None, factor), in SQL over metric columns; every
#: operand of a division is a double.
FORMULAS: dict[str, tuple[str, str | None, int]] = {
    "operating_margin_pct": ("netpatrev - opexp", "netpatrev", 100),
    "excess_margin_pct": ("netpatrev - opexp + othinc", "netpatrev + othinc", 100),
    "return_on_equity_pct": ("net_income", "total_assets - total_liabilities", 100),
    "return_on_assets_pct": ("net_income", "total_assets", 100),
    "current_ratio": ("total_current_assets", "total_current_liabilities", 1),
    "quick_ratio": ("total_current_assets - inventory", "total_current_liabilities", 1),
    "days_in_net_patient_ar": ("accounts_receivable - allow_uncollectible", "cast(netpatrev as double) / 365", 1),
    "days_in_net_total_receivable": ("accounts_receivable + notes_receivable + other_receivables - allow_uncollectible", "cast(netpatrev as double) / 365", 1),
    "inventory_turnover": ("netpatrev + othinc", "inventory", 1),
    "total_asset_turnover": ("netpatrev + othinc", "total_assets", 1),
    "lt_debt_to_net_assets": ("total_long_term_liabilities", "total_assets - total_liabilities", 1),
    "total_debt_to_net_assets": ("total_liabilities", "total_assets - total_liabilities", 1),
    "ebitdar": ("net_income + interest_expense + depreciation_expense + lease_cost", None, 1),
    "days_cash_on_hand": ("cash_on_hand + market_securities", "cast(opexp - depreciation_expense as double) / 365", 1),
    "days_cash_on_hand_all_sources": ("cash_on_hand + market_securities + investments", "cast(opexp - depreciation_expense as double) / 365", 1),
    "average_payment_period_days": ("total_current_liabilities", "cast(opexp + othexp - depreciation_expense as double) / 365", 1),
    "personnel_expense_pct": ("salary_expense + contract_labor_addon + contract_labor_main + fringe_benefits", "netpatrev", 100),
    "occupancy_pct": ("ipbeddays_adultped", "availbeddays_adultped", 100),
    "average_length_of_stay": ("ipbeddays_adultped", "ipdischarges_adultped", 1),
    "ebitda_margin_pct": ("net_income_from_patients + interest_expense + depreciation_expense", "netpatrev", 100),
    "cash_to_debt_pct": ("cash_on_hand + market_securities + investments", "total_long_term_liabilities", 100),
    "total_ftes": (f"cast(total_paid_hours as double) / {HOURS_PER_FTE_YEAR}", None, 1),
    "net_patient_revenue_per_fte": ("netpatrev", f"cast(total_paid_hours as double) / {HOURS_PER_FTE_YEAR}", 1),
    "ftes_per_staffed_bed": (f"cast(total_paid_hours as double) / {HOURS_PER_FTE_YEAR}", "beds_total", 1),
}
PLANT_AGE = "average_age_of_plant"
NAMES = (*FORMULAS, PLANT_AGE)
INPUTS = tuple(sorted({w for n, d, _ in FORMULAS.values() for w in re.findall(r"[a-z]\w*", f"{n} {d or ''}") if w not in ("cast", "as", "double")} | {f"accum_depr_{x}" for x in ACCUMULATED}))


def ratio_columns() -> list[Column]:
    """All ratios as doubles, over columns named like the metrics."""
    out = []
    for name, (top, bottom, factor) in FORMULAS.items():
        x = F.expr(top).cast("double")
        out.append((x if bottom is None else F.try_divide(x, F.expr(bottom).cast("double")) * factor).alias(name))
    parts = [F.col(f"accum_depr_{x}") for x in ACCUMULATED]
    present = F.coalesce(*parts).isNotNull()  # the one ratio that tolerates missing parts
    total = sum((F.coalesce(p, F.lit(0)) for p in parts), F.lit(0)).cast("double")
    out.append(F.when(present, F.try_divide(total, F.col("depreciation_expense").cast("double"))).alias(PLANT_AGE))
    return out
