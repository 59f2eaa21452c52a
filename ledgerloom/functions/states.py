"""States: postal, SSA (prefix of a CCN) and FIPS codes, and names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values: (name, postal code, SSA code, FIPS code) of the states and DC.
STATES = (
    ("Alabama", "AL", "01", "01"), ("Alaska", "AK", "02", "02"), ("Arizona", "AZ", "03", "04"),
    ("Arkansas", "AR", "04", "05"), ("California", "CA", "05", "06"), ("Colorado", "CO", "06", "08"),
    ("Connecticut", "CT", "07", "09"), ("Delaware", "DE", "08", "10"), ("District of Columbia", "DC", "09", "11"),
    ("Florida", "FL", "10", "12"), ("Georgia", "GA", "11", "13"), ("Hawaii", "HI", "12", "15"),
    ("Idaho", "ID", "13", "16"), ("Illinois", "IL", "14", "17"), ("Indiana", "IN", "15", "18"),
    ("Iowa", "IA", "16", "19"), ("Kansas", "KS", "17", "20"), ("Kentucky", "KY", "18", "21"),
    ("Louisiana", "LA", "19", "22"), ("Maine", "ME", "20", "23"), ("Maryland", "MD", "21", "24"),
    ("Massachusetts", "MA", "22", "25"), ("Michigan", "MI", "23", "26"), ("Minnesota", "MN", "24", "27"),
    ("Mississippi", "MS", "25", "28"), ("Missouri", "MO", "26", "29"), ("Montana", "MT", "27", "30"),
    ("Nebraska", "NE", "28", "31"), ("Nevada", "NV", "29", "32"), ("New Hampshire", "NH", "30", "33"),
    ("New Jersey", "NJ", "31", "34"), ("New Mexico", "NM", "32", "35"), ("New York", "NY", "33", "36"),
    ("North Carolina", "NC", "34", "37"), ("North Dakota", "ND", "35", "38"), ("Ohio", "OH", "36", "39"),
    ("Oklahoma", "OK", "37", "40"), ("Oregon", "OR", "38", "41"), ("Pennsylvania", "PA", "39", "42"),
    ("Rhode Island", "RI", "41", "44"), ("South Carolina", "SC", "42", "45"), ("South Dakota", "SD", "43", "46"),
    ("Tennessee", "TN", "44", "47"), ("Texas", "TX", "45", "48"), ("Utah", "UT", "46", "49"),
    ("Vermont", "VT", "47", "50"), ("Virginia", "VA", "49", "51"), ("Washington", "WA", "50", "53"),
    ("West Virginia", "WV", "51", "54"), ("Wisconsin", "WI", "52", "55"), ("Wyoming", "WY", "53", "56"),
)
EVERYWHERE = ("ALL", "US", "USA", "NATIONAL")


def state_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(STATES), "state_name string, usps string, ssa_code string, fips_code string")


def resolve_state(value: str) -> str:
    """Postal code of a postal code or a full name; an unknown state is an error."""
    key = (value or "").strip().upper()
    for name, usps, _, _ in STATES:
        if key in (usps, name.upper()):
            return usps
    raise KeyError(f"unknown state: {value!r}")


def ccn_state(ccn: Column) -> Column:
    """State of a CCN's first two characters."""
    by_prefix = F.create_map(*[F.lit(x) for _, usps, ssa, _ in STATES for x in (ssa, usps)])
    return F.try_element_at(by_prefix, F.substring(ccn, 1, 2))
