"""Views that bind the shared tables to the stored tables' shapes.

Each view exists twice: as a DataFrame and as SQL, from the same definition, so queries
and their SQL counterparts start from the same rows."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: Views in an order in which each uses only tables and earlier views.  The SQL runs
#: unchanged in Spark and in DuckDB.
VIEWS: dict[str, str] = {
    "v_hospitals": """select lpad(cast(s_suppkey as string), 6, '0') as ccn, s_name as name, cast(s_nationkey as string) as state,
        s_acctbal as value from supplier""",
    "v_sources": """select concat('file-', lpad(cast(l_suppkey as string), 6, '0'), '.csv') as source_file, lpad(cast(l_suppkey as string), 6, '0') as ccn,
        count(*) as charge_count from lineitem group by l_suppkey""",
    "v_charges": """select concat('file-', lpad(cast(l_suppkey as string), 6, '0'), '.csv') as source_file, lpad(cast(l_suppkey as string), 6, '0') as ccn,
        cast(s_nationkey as string) as state, p_brand as code, p_name as description, l_extendedprice as gross_charge,
        floor(l_extendedprice * (1 - l_discount) * 100 + 0.5) / 100 as discounted_cash, case when l_returnflag <> 'R' then floor(l_extendedprice * (1 - l_discount) * (1 + l_tax) * 100 + 0.5) / 100 end as negotiated_dollar,
        c_mktsegment as payer_name from lineitem join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join supplier on l_suppkey = s_suppkey""",
    "v_area": """select lpad(cast(l_suppkey as string), 6, '0') as ccn, lpad(cast(c_nationkey as string), 5, '0') as zip5,
        cast(case when count(*) >= 20 then count(*) end as int) as cases, count(*) < 20 as suppressed
        from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey group by l_suppkey, c_nationkey""",
    "v_parts": """select lpad(cast(p_partkey as string), 6, '0') as ccn, p_name as name, p_brand as state, p_size as certified_bed_count, p_type as provider_subtype from part""",
}


BASE = ("customer", "supplier", "part", "orders", "lineitem", "nation")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame, over the tables below ``sf_dir``."""
    used = [t for t in BASE if re.search(rf"\b(from|join) {t}\b", VIEWS[name])]
    sql = re.sub(rf"\b(from|join) ({'|'.join(BASE)})\b", r"\1 {\2}", VIEWS[name])
    return spark.sql(sql, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used})


def with_views(sql: str) -> str:
    """A query over views as one statement for DuckDB."""
    used = [n for n in VIEWS if n in sql]
    if not used:
        return sql
    views = "with " + ",\n".join(f"{n} as ({VIEWS[n]})" for n in used)
    return f"{views},\n{sql[5:]}" if sql.startswith("with ") else f"{views}\n{sql}"
