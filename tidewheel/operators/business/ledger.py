"""Account classification from the segments of an account number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewheel.operators.reshape import classified

# Account types by the hundred of the first segment, revenue accounts, cost categories by the last
# digit of the third segment, and markets by digits, for the two kinds of source.
ACCOUNT_TYPES = {500: "OPERATIONS EXPENSE", 600: "SALES EXPENSE", 700: "G&A EXPENSE", 800: "OTHER INCOME & EXPENSE"}
SALES_RANGE, REVENUE_ACCOUNTS = 300, ("330", "331", "332")
COST_CATEGORIES = {"2": "EQUIPMENT & MATERIAL", "3": "LABOR", "9": "BURDEN", "7": "SUBCONTRACT", "0": "DISCOUNTS", "6": "VEHICLE EXPENSE", "8": "TAX EXPENSE"}
SERVICE_MARKETS = {"4": "CERTIFIED", "7": "INSPECTION", "8": "PROJECT REPAIR"}
PROJECT_MARKETS = {"0": "CONTROLS", "1": "DESIGN BUILD", "2": "INDUSTRIAL", "3": "PERFORMANCE CONTRACT", "4": "PLAN SPEC", "5": "SPECIAL PROJECT"}
UNKNOWN, NO_DIVISION = "BROKEN", "Missing Division"


def _mapped(c: Column, table: dict, default: Column | None = None) -> Column:
    found = classified(c, [(c == k, v) for k, v in table.items()])
    return found if default is None else F.coalesce(found, default)


def hundred(first: Column) -> Column:
    """The first segment rounded down to a hundred; null if it is no number."""
    return (F.floor(first.try_cast("double") / 100) * 100).cast("int")


def account_type(first: Column) -> Column:
    h = hundred(first)
    sales = F.when(F.trim(first).isin(*REVENUE_ACCOUNTS), "REVENUE").otherwise("COST OF SALES")
    return F.when(h == SALES_RANGE, sales).otherwise(_mapped(h, ACCOUNT_TYPES, F.lit(UNKNOWN)))


def cost_category(kind: Column, third: Column) -> Column:
    """Of cost-of-sales accounts, by the third segment's last digit; null for others."""
    return F.when(kind == "COST OF SALES", _mapped(F.right(F.trim(third), F.lit(1)), COST_CATEGORIES))


def region(source: Column, second: Column, divisions: dict[str, dict[str, list[str]]]) -> Column:
    """The region of a division code; divisions: source -> region -> codes."""
    code = F.trim(second)
    bands = []
    for s, regions in divisions.items():
        named = classified(code, [(code.isin(*codes), r) for r, codes in regions.items()], NO_DIVISION)
        bands.append((source == s, named))
    out = None
    for condition, value in bands:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return F.lit(UNKNOWN) if out is None else out.otherwise(UNKNOWN)


def market(source: Column, first: Column, second: Column, third: Column, service: str = "SERV_GP", projects: str = "MECH_GP") -> Column:
    """The market of an account: sales accounts (first digit 3) in full, others for service contracts and projects."""
    a, b, c = F.trim(first), F.trim(second), F.trim(third)
    sold, lead = F.left(a, F.lit(1)) == "3", F.left(c, F.lit(1))
    last_a, last_b = F.right(a, F.lit(1)), F.right(b, F.lit(1))
    upkeep = last_b == "7"
    spot = F.when((last_a == "5") | (last_b == "5"), "INTERCOMPANY SPOT").when(upkeep, "O&M SPOT").otherwise("SPOT")
    shared = F.when(lead == "3", F.when(upkeep, "O&M").when(sold, "ASSURED").otherwise("A")).when(lead == "5", F.when(upkeep, "O&M PROJECTS").otherwise("PROJECTS"))
    of_service = F.when(sold & (lead == "6"), spot).otherwise(F.coalesce(F.when(sold, _mapped(lead, SERVICE_MARKETS)), shared))
    kind = F.trim(source)
    return F.when(kind == service, of_service).when((kind == projects) & sold, _mapped(last_b, PROJECT_MARKETS))
