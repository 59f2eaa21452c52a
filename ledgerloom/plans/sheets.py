"""Queries of the gap report's sheets in their orders, rows that are ready to be fetched,
amounts, and trial reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import discovery, gaps
from ..sources import charges
from . import catalog, contract, derived
from .catalog import _read, query

#: Hospitals left that make a brand a system.
LEAST = 20
_GAPS = f"""g as (select ccn, name, upper(state) as state, {catalog._BRAND} as system from v_parts where cast(ccn as int) % 3 <> 0), k as (select {catalog._BRAND} as system, min(concat('s', ccn)) as known_source from v_parts where cast(ccn as int) % 3 = 0 group by 1),
s as (select system, count(*) as remaining from g where system is not null group by 1 having count(*) >= {LEAST})"""


def _report(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    parts = contract.view(spark, sf_dir, "v_parts").withColumns({"is_active": F.lit(True), "city": F.lit(None).cast("string")})
    none = F.lit(None).cast("string")
    sources = parts.where("cast(ccn as int) % 3 = 0").select(F.concat(F.lit("s"), "ccn").alias("source_file"), "ccn", F.col("name").alias("hospital_name"), none.alias("license_state"), none.alias("hospital_address"), F.lit(5).cast("long").alias("charge_count"))
    return gaps.gap_report(parts, sources, LEAST)


@query(f"""with {_GAPS} select s.system, s.remaining, k.known_source is not null as already_publishing, k.known_source from s left join k on s.system = k.system order by 3 desc, 2 desc, 1 limit 25""")
def gap_systems_sheet(spark, sf_dir):
    """Brands with most hospitals left, those that publish elsewhere first."""
    return _report(spark, sf_dir)["systems"].select("system", "remaining", "already_publishing", "known_source").limit(25)


@query(f"""with {_GAPS} select g.ccn, g.name, g.state from g left join s on g.system = s.system where s.system is null order by g.state, g.name, g.ccn limit 25""")
def gap_independents_sheet(spark, sf_dir):
    """Hospitals of no such brand, by state and name."""
    return _report(spark, sf_dir)["independents"].select("ccn", "name", "state").limit(25)


@query("""select state, total, covered, remaining, pct from (select upper(state) as state, count(*) as total, count(*) filter (cast(ccn as int) % 3 = 0) as covered, count(*) filter (cast(ccn as int) % 3 <> 0) as remaining, round(100.0 * count(*) filter (cast(ccn as int) % 3 = 0) / count(*), 1) as pct from v_parts group by 1) order by pct, state limit 10""")
def gap_states_sheet(spark, sf_dir):
    """States with the smallest share of hospitals first."""
    return _report(spark, sf_dir)["coverage"].select("state", "total", "covered", "remaining", "pct").limit(10)


@query("""select lpad(cast(s_suppkey as varchar), 6, '0') as ccn, concat('ccn-', lpad(cast(s_suppkey as varchar), 6, '0'), '_', trim(regexp_replace(lower(s_name), '[^a-z0-9]+', '-', 'g'), '-'), '_standardcharges.csv') as file_name from supplier where s_suppkey % 5 <> 0 and s_suppkey % 4 < 2""")
def ready_files(spark, sf_dir):
    """Rows of the manifest to fetch, with the name of each file."""
    s = _read(spark, sf_dir, "supplier")
    wanted = s.select(F.lpad(F.col("s_suppkey").cast("string"), 6, "0").alias("ccn"), F.col("s_name").alias("name"), F.lit(None).cast("string").alias("city"), F.col("s_nationkey").cast("string").alias("state"), F.when(F.col("s_suppkey") % 5 != 0, F.concat(F.lit("http://www.h"), "s_suppkey", F.lit(".org/about"))).alias("website"))
    return discovery.ready(discovery.match_pages(wanted, derived._index_pages(spark, sf_dir))).select("ccn", "file_name")


@query("""select o_orderkey, case when o_orderkey % 5 > 1 then round(o_totalprice, 2) end as amount from orders""")
def parsed_amounts(spark, sf_dir):
    """Amounts with signs, thousands and markers for cells that are withheld."""
    k, price = F.col("o_orderkey"), F.format_number(F.round("o_totalprice", 2), 2)
    raw = F.when(k % 5 == 0, F.element_at(F.array(*map(F.lit, ("*", "N/A", "suppressed", " . "))), (k % 4 + 1).cast("int"))).when(k % 5 == 1, "1 or 2").when(k % 5 == 2, F.concat(F.lit(" $"), price)).otherwise(price)
    return _read(spark, sf_dir, "orders").select("o_orderkey", T.parse_amount(raw).cast("double").alias("amount"))


@query("""select source_file, code, gross_charge from (select concat('ccn-', lpad(cast(l_suppkey as varchar), 6, '0'), '_x.csv') as source_file, p_brand as code, round(l_extendedprice, 2) as gross_charge, row_number() over (partition by l_suppkey order by l_orderkey, l_linenumber) as k from lineitem join part on l_partkey = p_partkey) where k <= 5""")
def trial_rows(spark, sf_dir):
    """A3: the first five items of every file, as a trial reads them."""
    lines = derived._tall_lines(spark, sf_dir)
    return charges.charges(lines, charges.headers(lines), limit=5).select("source_file", "code", F.col("gross_charge").cast("double").alias("gross_charge"))
