"""The queries over the shared tables, each with its SQL for DuckDB where SQL has one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names, ratios
from ..functions import text as T
from ..operators import benchmarking, community, cost_reports, coverage, duplicates, gaps, linkage, prices, readiness, service_area, store
from ..session import written
from . import contract
from .contract import with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with SQL over tables and views."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = with_views(sql.strip())
        return f

    return add


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_MEASURES = (("gross", "gross_charge"), ("cash", "discounted_cash"), ("negotiated", "negotiated_dollar"))
_SPREAD = ", ".join(
    f"count({c}) filter ({c} > 0) as {n}_count, "
    + ", ".join(f"round(quantile_cont({c}, {p}) filter ({c} > 0), 4) as {n}_{label}" for label, p in (("p25", 0.25), ("median", 0.5), ("p75", 0.75)))
    + f", min({c}) filter ({c} > 0) as {n}_min, max({c}) filter ({c} > 0) as {n}_max"
    for n, c in _MEASURES
)


def _charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.view(spark, sf_dir, "v_charges")


# --- prices -----------------------------------------------------------------------------


@query(f"select code, count(*) as charge_rows, count(distinct ccn) as hospitals, {_SPREAD} from v_charges group by code")
def price_spread(spark, sf_dir):
    """The spread of every code."""
    return prices.spread(_charges(spark, sf_dir), "code")


@query("""select code, coalesce(nullif(trim(payer_name), ''), '(unnamed)') as payer, count(*) as prices, round(quantile_cont(negotiated_dollar, 0.5), 4) as median
from v_charges where negotiated_dollar > 0 group by 1, 2""")
def price_by_payer(spark, sf_dir):
    """Negotiated prices of every code and payer."""
    return prices.by_payer(_charges(spark, sf_dir), "code")


@query("""select code, description, n as rows_with_it from (select code, description, count(*) as n, row_number() over (partition by code order by count(*) desc, description) as k
from v_charges group by 1, 2) where k = 1""")
def price_modal_description(spark, sf_dir):
    """The usual description of every code."""
    return prices.usual_description(_charges(spark, sf_dir), "code")


@query("""select payer, prices, median from (select payer_name as payer, count(*) as prices, round(quantile_cont(negotiated_dollar, 0.5), 4) as median
from v_charges where negotiated_dollar > 0 and code = 'Brand#3' and state = '7' group by 1) order by prices desc, payer limit 3""")
def price_top_payers(spark, sf_dir):
    """The three payers with most prices of one code in one state."""
    rows = _charges(spark, sf_dir).drop("ccn", "state")
    matched = prices.matching(rows, contract.view(spark, sf_dir, "v_sources"), contract.view(spark, sf_dir, "v_hospitals"), "Brand#3", state="7")
    return prices.top_payers(matched, 3)


@query(f"select count(*) as charge_rows, count(distinct ccn) as hospitals, {_SPREAD} from v_charges where code = 'Brand#5' and payer_name ilike '%auto%'")
def price_one_payer(spark, sf_dir):
    """The price question for one code and a payer's name part, in any case."""
    rows = _charges(spark, sf_dir).drop("ccn", "state")
    return prices.price(rows, contract.view(spark, sf_dir, "v_sources"), contract.view(spark, sf_dir, "v_hospitals"), "Brand#5", payer="auto")["spread"]


# --- service area -----------------------------------------------------------------------

_PUBLISHED = "select * from v_area where not suppressed and cases is not null"


@query(f"""select ccn, zip5, cast(cases as bigint) as cases, cast(sum(cases) over (partition by zip5) as bigint) as zip_total, round(cases / sum(cases) over (partition by zip5), 4) as share from ({_PUBLISHED})""")
def service_draw(spark, sf_dir):
    """Each hospital's share of every ZIP."""
    return service_area.draw(contract.view(spark, sf_dir, "v_area"))


@query(f"""select zip5, cast(cases as bigint) as cases, zip_total, share from (select ccn, zip5, cases, cast(sum(cases) over (partition by zip5) as bigint) as zip_total, round(cases / sum(cases) over (partition by zip5), 4) as share from ({_PUBLISHED}))
where ccn = '000003' order by cases desc, zip5 limit 10""")
def service_draw_of_one(spark, sf_dir):
    """The ten largest ZIPs of one hospital."""
    return service_area.draw_of(contract.view(spark, sf_dir, "v_area"), "000003", 10).drop("ccn")


@query(f"""with r as (select a.ccn, b.ccn as rival, cast(sum(b.cases) as bigint) as overlap_cases, count(*) as shared_zips
from (select distinct ccn, zip5 from v_area where not suppressed and cast(ccn as int) % 100 = 0) a join ({_PUBLISHED}) b on a.zip5 = b.zip5 and a.ccn <> b.ccn group by 1, 2)
select * from (select *, cast(row_number() over (partition by ccn order by overlap_cases desc, rival) as int) as place from r) where place <= 15""")
def service_competitors(spark, sf_dir):
    """The largest rivals in shared ZIPs, asked for every hospital whose number is
    divisible by 100 and counted over all cells."""
    cells = written(contract.view(spark, sf_dir, "v_area"), "area")
    return service_area.competitors(cells, cells.select("ccn").where("cast(ccn as int) % 100 = 0"))


@query(f"""select b.ccn, cast(sum(b.cases) as bigint) as overlap_cases, count(*) as shared_zips, any_value(h.name) as name, any_value(h.state) as state from ({_PUBLISHED}) b left join v_hospitals h on b.ccn = h.ccn
where b.ccn <> '000005' and b.zip5 in (select zip5 from v_area where ccn = '000005' and not suppressed) group by 1 order by 2 desc, 1 limit 15""")
def service_competitors_of_one(spark, sf_dir):
    """The rivals of one hospital with their names."""
    return service_area.competitors_of(contract.view(spark, sf_dir, "v_area"), contract.view(spark, sf_dir, "v_hospitals"), "000005")


# --- cost reports -----------------------------------------------------------------------

#: Metrics over the events' keys: single lines, ranges of lines, and one that is disabled.
METRIC_LINES = [(m, w, s, e, on) for m, w, s, e, on in (
    *[(name, ("view", "click", "purchase", "signup", "error")[k % 5], 3 * k, 3 * k + 2 if k % 4 else None, True) for k, name in enumerate(ratios.INPUTS)],
    ("not_counted", "click", 0, 99, False),
)]
_LINES_SQL = "(values " + ", ".join(f"('{m}', '{w}', {s}, {s if e is None else e}, {str(on).lower()})" for m, w, s, e, on in METRIC_LINES) + ") x(metric, wksht_cd, line_start, line_end, enabled)"
_CELLS_SQL = """(select user_id, event_type as wksht_cd, cast(json_extract_string(props, '$.k') as int) as line, arg_max(value, event_id) as value from events group by 1, 2, 3)"""
_METRICS_SQL = f"""(select c.user_id, x.metric, sum(cast(c.value as decimal(20, 4))) as v from {_CELLS_SQL} c join {_LINES_SQL} on c.wksht_cd = x.wksht_cd and c.line between x.line_start and x.line_end where x.enabled group by 1, 2)"""


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    return _read(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("row_seq"), F.col("event_type").alias("wksht_cd"), F.lit("00100").alias("clmn_num"), F.lpad(k, 5, "0").alias("line_num"), F.col("value").cast("decimal(20,4)").alias("value"))


def _crosswalk(spark: SparkSession) -> DataFrame:
    rows = [(m, m, "flow", w, "00100", f"{s:05d}", None if e is None else f"{e:05d}", on) for m, w, s, e, on in METRIC_LINES]
    from ..schemas import METRIC_CROSSWALK

    return spark.createDataFrame(rows, METRIC_CROSSWALK)


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cost_reports.numeric_metrics(_cells(spark, sf_dir), _crosswalk(spark), by=("user_id",))


@query(f"select user_id, metric, round(cast(v as double), 4) as total from {_METRICS_SQL}")
def hcris_metrics(spark, sf_dir):
    """Sums over ranges of lines, the last value of each cell counting."""
    return _metrics(spark, sf_dir).select("user_id", "metric", F.round(F.col("value_numeric").cast("double"), 4).alias("total"))


def _ratio_sql() -> str:
    wide = ", ".join(f"max(v) filter (metric = '{m}') as {m}" for m in ratios.INPUTS)
    each = [f"select user_id, '{n}' as ratio, " + (f"cast({top} as double)" if not low else f"cast({top} as double) / nullif(cast({low} as double), 0) * {f}") + " as x from w" for n, (top, low, f) in ratios.FORMULAS.items()]
    parts = [f"accum_depr_{a}" for a in ratios.ACCUMULATED]
    each.append(f"select user_id, '{ratios.PLANT_AGE}', case when coalesce({', '.join(parts)}) is not null then ({' + '.join(f'coalesce(cast({p} as double), 0)' for p in parts)}) / nullif(cast(depreciation_expense as double), 0) end from w")
    return f"with w as (select user_id, {wide} from {_METRICS_SQL} group by 1) select user_id, ratio, round(x, 4) as value from ({' union all '.join(each)}) where x is not null"


@query(_ratio_sql())
def hcris_ratios(spark, sf_dir):
    """Every ratio of every report that can be computed."""
    found = cost_reports.report_ratios(_metrics(spark, sf_dir), ("user_id",))
    return found.select("user_id", "ratio", F.round("value", 4).alias("value"))


@query("""select l_orderkey, l_linenumber, arg_max(l_partkey, l_shipdate + to_milliseconds(l_partkey)) as l_partkey from lineitem group by 1, 2""")
def latest_reports(spark, sf_dir):
    """the last row of each (vintage, record number)."""
    rows = _read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("vintage_year"), F.col("l_linenumber").alias("rpt_rec_num"), F.struct("l_shipdate", "l_partkey").alias("row_seq"), "l_partkey")
    out = cost_reports.latest_reports(rows)
    return out.select(F.col("vintage_year").alias("l_orderkey"), F.col("rpt_rec_num").alias("l_linenumber"), "l_partkey")


# --- names and links --------------------------------------------------------------------

_NOISE = ", ".join(f"'{w}'" for w in names.NAME_NOISE)
_KEY = f"array_to_string([w for w in regexp_split_to_array(regexp_replace(upper(name), '[^A-Z0-9]+', ' ', 'g'), ' ') if w <> '' and w not in ({_NOISE})], ' ')"


@query(f"select ccn, link_ccn from (select ccn, {_KEY} as key, state from v_parts) p join (select {_KEY} as key, state, min(ccn) as link_ccn from v_parts group by 1, 2 having count(distinct ccn) = 1) u on p.key = u.key and p.state = u.state")
def name_link(spark, sf_dir):
    """Links by a name that is unique in its state."""
    parts = contract.view(spark, sf_dir, "v_parts")
    files = parts.select(F.col("ccn").alias("source_file"), F.col("name").alias("hospital_name"), F.col("state").alias("license_state"), F.lit(None).cast("string").alias("hospital_address"))
    return linkage.by_name(files, parts.withColumn("state", F.upper("state"))).select(F.col("source_file").alias("ccn"), F.col("ccn").alias("link_ccn"))


@query(f"select key, upper(state) as state, ccns from (select {_KEY} as key, state, count(distinct ccn) as ccns from v_parts group by 1, 2) where ccns > 1")
def name_link_ambiguous(spark, sf_dir):
    """Names that several hospitals of a state share."""
    return linkage.ambiguous_names(contract.view(spark, sf_dir, "v_parts"))


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as charge files: some stamped, some with NPIs, some named, some nothing."""
    p = contract.view(spark, sf_dir, "v_parts").withColumn("k", F.col("ccn").cast("int"))
    stamp = F.concat(F.lit("ccn-"), F.col("ccn"), F.lit("_x_standardcharges.csv"))
    npi = F.concat(F.lit("1"), F.lpad(F.col("ccn"), 9, "0"))
    return p.select(
        F.when(F.col("k") % 4 == 0, stamp).otherwise(F.concat(F.lit("x"), F.col("ccn"), F.lit(".csv"))).alias("source_file"), F.col("name").alias("hospital_name"), F.lit(None).cast("string").alias("hospital_address"),
        F.col("state").alias("license_state"), F.when(F.col("k") % 4 == 1, F.array(F.lit("1999999999"), npi)).alias("npis"), F.when(F.col("k") % 8 == 2, npi).alias("primary_npi"), F.lit(None).cast("string").alias("ccn"),
        F.when(F.col("k") % 16 == 3, "manual_review").alias("link_method"), (F.col("k") % 7).cast("long").alias("charge_count"),
    )


def _linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = contract.view(spark, sf_dir, "v_parts")
    npis = parts.select(F.concat(F.lit("1"), F.lpad("ccn", 9, "0")).alias("npi"), "ccn")
    return linkage.link(_files(spark, sf_dir), parts.withColumn("state", F.upper("state")), npis)


_UNIQUE = f"(select {_KEY} as key, upper(state) as state, min(ccn) as u from v_parts group by 1, 2 having count(distinct ccn) = 1)"
_LINKED_SQL = f"""(select p.ccn as part, cast(p.ccn as int) % 7 as charge_count,
case when cast(p.ccn as int) % 16 = 3 then null when cast(p.ccn as int) % 4 in (0, 1) or cast(p.ccn as int) % 8 = 2 then p.ccn else u.u end as ccn,
case when cast(p.ccn as int) % 16 = 3 then 'manual_review' when cast(p.ccn as int) % 4 = 0 then 'filename_ccn' when cast(p.ccn as int) % 4 = 1 or cast(p.ccn as int) % 8 = 2 then 'crosswalk_npi' when u.u is not null then 'name_state' end as link_method
from (select *, {_KEY} as key from v_parts) p left join {_UNIQUE} u on p.key = u.key and upper(p.state) = u.state)"""


@query(f"select part, ccn as link_ccn, link_method from {_LINKED_SQL}")
def link_charges(spark, sf_dir):
    """The strongest rule links each file; reviewed decisions stay."""
    return _linked(spark, sf_dir).select(F.regexp_extract("source_file", r"(\d{6})", 1).alias("part"), F.col("ccn").alias("link_ccn"), "link_method")


@query(f"select coalesce(link_method, 'unlinked') as link_method, count(*) as files, cast(sum(charge_count) as bigint) as charge_rows from {_LINKED_SQL} group by 1")
def link_method_counts(spark, sf_dir):
    """Files and rows by method."""
    return linkage.method_counts(_linked(spark, sf_dir))


_STOP = ", ".join(f"'{w}'" for w in names.STOP_WORDS)


def _tokens(c: str) -> str:
    long = f"list_distinct([w for w in regexp_extract_all(lower({c}), '[a-z0-9]+') if length(w) > 2])"
    kept = f"[w for w in {long} if w not in ({_STOP})]"
    return f"case when len({kept}) > 0 then {kept} else {long} end"


@query(f"""with t as (select ccn, name, state, {_tokens('name')} as t from v_parts),
f as (select ccn as file, state, {_tokens('name')} as t, cast(ccn as int) % 50 as charge_count from v_parts),
c as (select distinct f.file, t.ccn, len(list_intersect(f.t, t.t)) / len(list_distinct(list_concat(f.t, t.t))) as score from f join t on f.state = t.state and list_has_any(f.t, t.t)),
r as (select *, row_number() over (partition by file order by score desc, ccn) as place from c where score >= 0.3)
select file, cast(place as int) as place, ccn, round(score, 3) as score from r where place <= 3""")
def probable_matches(spark, sf_dir):
    """The three likeliest hospitals of files without one."""
    parts = contract.view(spark, sf_dir, "v_parts")
    files = parts.select(F.col("ccn").alias("source_file"), F.col("name").alias("hospital_name"), "state", (F.col("ccn").cast("int") % 50).cast("long").alias("charge_count"))
    found = linkage.probable(files.withColumn("source_file", F.concat(F.lit("z"), F.col("source_file"))), parts)
    return found.select(F.substring("source_file", 2, 6).alias("file"), "place", "ccn", "score")


# --- gaps and coverage ------------------------------------------------------------------

_TOK = f"[w for w in regexp_split_to_array(regexp_replace(upper(name), '[^A-Z0-9]+', ' ', 'g'), ' ') if w <> '' and w not in ({_NOISE})]"
_GEN, _SEC = (", ".join(f"'{w}'" for w in x) for x in (names.GENERIC, names.NEEDS_SECOND))
_BRAND = f"""case when len({_TOK}) = 0 then null when {_TOK}[1] in ({_SEC}) and len({_TOK}) > 1 then {_TOK}[1] || ' ' || {_TOK}[2]
when {_TOK}[1] in ({_GEN}) then ([w for w in {_TOK}[2:] if w not in ({_GEN}) and length(w) >= 4])[1]
when length({_TOK}[1]) < 4 then case when len({_TOK}) > 1 then {_TOK}[1] || ' ' || {_TOK}[2] end else {_TOK}[1] end"""
_PART_COVERED = "select distinct lpad(cast(l_partkey as varchar), 6, '0') as ccn from lineitem where l_shipdate < timestamp '1995-06-01'"


def _covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "lineitem").where("l_shipdate < timestamp '1995-06-01'")
    return rows.select(F.lpad(F.col("l_partkey").cast("string"), 6, "0").alias("ccn")).distinct()


def _universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.view(spark, sf_dir, "v_parts").withColumn("is_active", F.lit(True))


@query(f"""with g as (select ccn, name, upper(state) as state, {_BRAND} as system from v_parts where ccn not in ({_PART_COVERED}))
select system, count(*) as remaining, list_sort(list(distinct state)) as states, list_sort(list(distinct name))[1:3] as examples from g where system is not null group by 1 having count(*) >= 2""")
def system_clusters(spark, sf_dir):
    """Brands with several hospitals left."""
    return gaps.systems(gaps.remaining(_universe(spark, sf_dir), _covered(spark, sf_dir)))


@query(f"""select upper(p.state) as state, count(*) as total, count(c.ccn) as covered, count(*) - count(c.ccn) as remaining, round(100.0 * count(c.ccn) / count(*), 1) as pct, count(c.ccn) = 0 as not_started
from v_parts p left join ({_PART_COVERED}) c on p.ccn = c.ccn group by 1""")
def state_coverage(spark, sf_dir):
    """Hospitals with data by state."""
    return gaps.state_coverage(_universe(spark, sf_dir), _covered(spark, sf_dir))


@query(f"select ccn, name, upper(state) as state from v_parts where ccn not in ({_PART_COVERED})")
def uncovered(spark, sf_dir):
    """Hospitals without data."""
    return gaps.remaining(_universe(spark, sf_dir), _covered(spark, sf_dir)).select("ccn", "name", "state")


_FILES_SQL = """(select concat('f', o_orderkey) as source_file, concat('h', o_custkey) as hospital_name, cast(o_custkey % 40 as varchar) as ein, case when o_orderstatus = 'F' then lpad(cast(o_custkey as varchar), 6, '0') end as ccn, cast(o_orderkey % 25 as bigint) as charge_count from orders)"""


def _order_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "orders").select(F.concat(F.lit("f"), "o_orderkey").alias("source_file"), F.concat(F.lit("h"), "o_custkey").alias("hospital_name"), (F.col("o_custkey") % 40).cast("string").alias("ein"), F.lit(None).cast("string").alias("primary_npi"), F.when(F.col("o_orderstatus") == "F", F.lpad(F.col("o_custkey").cast("string"), 6, "0")).alias("ccn"), (F.col("o_orderkey") % 25).cast("long").alias("charge_count"))


@query(f"""with f as (select * from {_FILES_SQL}), s as (select ein, charge_count, min(source_file) as sf from f where ccn is not null and charge_count > 0 group by 1, 2)
select f.source_file, f.charge_count, case when f.ccn is not null then 'linked' when s.sf is not null then 'shared' else 'missing' end as class, case when f.ccn is null then s.sf end as shares_with from f left join s on f.ein = s.ein and f.charge_count = s.charge_count""")
def coverage_classes(spark, sf_dir):
    """Files that are linked, shared with a linked sibling, or missing."""
    return coverage.file_classes(_order_files(spark, sf_dir)).select("source_file", "charge_count", "class", "shares_with")


@query(f"""with f as (select * from {_FILES_SQL}), s as (select distinct ein, charge_count from f where ccn is not null and charge_count > 0)
select case when f.ccn is not null then 'linked' when s.ein is not null then 'shared' else 'missing' end as class, count(*) as files, cast(sum(f.charge_count) as bigint) as charge_rows from f left join s on f.ein = s.ein and f.charge_count = s.charge_count group by 1""")
def coverage_class_totals(spark, sf_dir):
    """Files and rows of each class."""
    return coverage.class_totals(coverage.file_classes(_order_files(spark, sf_dir)))


@query(f"""select lpad(cast(c_custkey as varchar), 6, '0') as ccn, c_name as name, coalesce(n, 0) as source_count, cast(coalesce(r, 0) as bigint) as charge_rows, coalesce(n, 0) > 0 as covered
from customer left join (select ccn, count(*) as n, sum(charge_count) as r from {_FILES_SQL} where ccn is not null group by 1) on ccn = lpad(cast(c_custkey as varchar), 6, '0') where regexp_matches(lower(c_name), '(^|[^a-z0-9])customer')""")
def hospital_coverage(spark, sf_dir):
    """Hospitals that match a name, with their files counted."""
    people = _read(spark, sf_dir, "customer").select(F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("ccn"), F.col("c_name").alias("name"), F.col("c_nationkey").cast("string").alias("state"))
    return coverage.hospital_coverage(people, _order_files(spark, sf_dir), "customer").drop("state")


# --- duplicates, merges, upserts --------------------------------------------------------

_DOC_FILES = "(select *, concat('d', doc_id, '/', case when doc_id % 3 = 0 then 'set' else 'set' || (doc_id % 5) end, case when doc_id % 2 = 0 then ' (1)' else '' end, '.csv') as source_file from documents)"


def _doc_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _read(spark, sf_dir, "documents")
    name = F.concat(F.lit("d"), "doc_id", F.lit("/"), F.when(F.col("doc_id") % 3 == 0, "set").otherwise(F.concat(F.lit("set"), (F.col("doc_id") % 5).cast("string"))), F.when(F.col("doc_id") % 2 == 0, " (1)").otherwise(""), F.lit(".csv"))
    return d.select("doc_id", name.alias("source_file"), F.col("source").alias("ein"), F.lit(None).cast("string").alias("primary_npi"), F.col("lang").alias("hospital_name"), F.col("n_chars").alias("charge_count"))


@query(f"""select source as key, n_chars as charge_count, count(*) as copies, count(distinct lang) as names, count(distinct regexp_replace(source_file, '^.*/| \\(1\\)\\.csv$|\\.csv$', '', 'g')) as canonical_names,
cast((count(*) - 1) * n_chars as bigint) as redundant_rows from {_DOC_FILES} group by 1, 2 having count(*) > 1""")
def duplicate_groups(spark, sf_dir):
    """Groups of equal identifier and size."""
    return duplicates.groups(_doc_files(spark, sf_dir)).drop("is_redownload")


@query(f"""select source_file, cast(row_number() over (partition by source, n_chars, regexp_replace(source_file, '^.*/| \\(1\\)\\.csv$|\\.csv$', '', 'g') order by (source_file like '%(1)%')::int, length(source_file), source_file) as int) as place from {_DOC_FILES} where n_chars > 0""")
def duplicate_keepers(spark, sf_dir):
    """the place of each copy of a download; the first is kept."""
    return duplicates.keepers(_doc_files(spark, sf_dir)).select("source_file", "place")


@query(f"""with g as (select source, n_chars, count(*) - 1 as more from {_DOC_FILES} where n_chars > 0 group by 1, 2)
select cast(sum(more) as bigint) as redundant_files, cast(sum(more * n_chars) as bigint) as redundant_rows from g where more > 0""")
def duplicate_totals(spark, sf_dir):
    """Redundant files and rows."""
    return duplicates.totals(_doc_files(spark, sf_dir)).select("redundant_files", "redundant_rows")


@query("""select concat('f', o_orderkey) as source_file, cast(o_custkey as bigint) as charge_count, case when o_orderkey % 3 = 0 then 'skip_duplicate' else 'add' end as action from orders""")
def merge_plan(spark, sf_dir):
    """What a merge of two stores adds and skips."""
    o = _read(spark, sf_dir, "orders").select(F.concat(F.lit("f"), "o_orderkey").alias("source_file"), "o_orderkey", F.col("o_custkey").alias("charge_count"))
    return store.merge_plan(o.where("o_orderkey % 3 = 0"), o)


@query("""select o_orderkey, case when o_orderkey % 2 = 0 then o_totalprice else -1 end as o_totalprice from orders""")
def merge_stores(spark, sf_dir):
    """H4: the target's own rows and the other store's new ones."""
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return store.merge(o.where("o_orderkey % 2 = 0"), o.withColumn("o_totalprice", F.lit(-1.0)), "o_orderkey")


@query("""select user_id, arg_max(event_type, event_id) as event_type, arg_max(value, event_id) as value, max(event_id) as event_id from events group by 1""")
def upsert_latest(spark, sf_dir):
    """Later rows replace earlier ones by key."""
    e = _read(spark, sf_dir, "events").select("user_id", "event_type", "value", "event_id")
    half = e.where("event_id % 2 = 0")
    first = store.latest(half, ["user_id"], "event_id")
    return store.upsert(first, e, ["user_id"], "event_id")


@query("""select * from (select o_orderkey, o_custkey, 1 as edition from orders where o_orderstatus <> 'F' union all select o_orderkey, o_custkey, 2 from orders where o_orderstatus = 'F')""")
def replace_groups(spark, sf_dir):
    """An incoming group replaces the stored group whole."""
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.lit(1).alias("edition"))
    return store.replace_groups(o, o.where("o_orderstatus = 'F'").withColumn("edition", F.lit(2)), ["o_orderstatus"]).drop("o_orderstatus")


@query("""select s_suppkey, count(l_orderkey) as charge_count from supplier left join lineitem on s_suppkey = l_suppkey group by 1""")
def charge_counts(spark, sf_dir):
    """Row counts of every source, 0 where it has none."""
    s = _read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("source_file"), F.lit(0).cast("long").alias("charge_count"))
    f = _read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("source_file"))
    return store.with_charge_counts(s, f).withColumnRenamed("source_file", "s_suppkey")


@query("""select o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem where l_quantity > 30)""")
def not_loaded(spark, sf_dir):
    """Files without loaded rows are tried again; lines of large quantity are loaded."""
    o = _read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("source_file"))
    done = _read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("source_file")).agg(F.count_if(F.col("l_quantity") > 30).alias("charge_count"))
    return store.not_loaded(o, done).withColumnRenamed("source_file", "o_orderkey")


@query("""select n_name as state, count(*) as rows from supplier join nation on s_nationkey = n_nationkey group by 1""")
def stats(spark, sf_dir):
    """Rows by state."""
    s, n = _read(spark, sf_dir, "supplier"), _read(spark, sf_dir, "nation")
    return store.counts_by(s.join(n, s.s_nationkey == n.n_nationkey).withColumnRenamed("n_name", "state"), "state")


@query("""with d as (select o_orderkey, o_custkey, lpad(cast(o_custkey as varchar), 6, '0') as ccn, case o_orderstatus when 'F' then 'yes' when 'O' then 'x' else '' end as confirm from orders)
select o_orderkey, case when confirm = '' then 'skipped' when o_orderkey % 5 = 0 then 'unknown_file' when o_custkey % 4 = 0 then 'unknown_ccn' when o_orderkey % 7 = 0 and ccn <> '000001' then 'already_linked' else 'applied' end as status from d""")
def review_decisions(spark, sf_dir):
    """The status of every reviewed link."""
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderkey").cast("string").alias("source_file"), F.lpad(F.col("o_custkey").cast("string"), 6, "0").alias("ccn"))
    sheet = o.withColumn("confirm", F.when(F.col("o_orderstatus") == "F", "yes").when(F.col("o_orderstatus") == "O", "x").otherwise(""))
    held = o.where("o_orderkey % 5 <> 0").select("source_file", F.when(F.col("o_orderkey") % 7 == 0, "000001").alias("ccn"))
    known = o.where("o_custkey % 4 <> 0").select("ccn").distinct()
    return linkage.decide(sheet, held, known).select(F.col("source_file").cast("long").alias("o_orderkey"), "status")


# --- benchmarks and scores --------------------------------------------------------------


@query("""with c as (select c_custkey, c_nationkey, c_mktsegment, c_acctbal as x from customer),
p as (select a.c_custkey, count(b.x) as n, count(b.x) filter (b.x < a.x) as below, count(b.x) filter (b.x = a.x) as same, min(b.x) as lo, max(b.x) as hi, quantile_cont(b.x, 0.25) as q1, quantile_cont(b.x, 0.5) as q2, quantile_cont(b.x, 0.75) as q3
from c a left join c b on a.c_nationkey = b.c_nationkey and a.c_mktsegment = b.c_mktsegment and a.c_custkey <> b.c_custkey group by 1),
s as (select *, case when n < 5 then 'none' when n < 11 or lo = hi then 'rank_only' else 'band' end as disclosure from p)
select c_custkey, n as cohort_size, disclosure, cast(case when disclosure <> 'none' then floor((below + same / 2) / n * 100 + 0.5) end as int) as percentile_rank,
case when disclosure = 'band' then floor(round(q1 * 100, 6) + 0.5) / 100 end as p25, case when disclosure = 'band' then floor(round(q2 * 100, 6) + 0.5) / 100 end as p50, case when disclosure = 'band' then floor(round(q3 * 100, 6) + 0.5) / 100 end as p75 from s""")
def peer_benchmark(spark, sf_dir):
    """Each hospital against its peers, without disclosing one."""
    rows = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    return benchmarking.peer_benchmark(rows, ("c_nationkey", "c_mktsegment"), "c_acctbal").drop("c_nationkey", "c_mktsegment", "c_acctbal")


@query("""with o as (select * from supplier where s_nationkey = 3), p as (select s_acctbal as x from supplier where s_nationkey <> 3),
f as (select count(*) as n, case when count(*) < 5 then 'none' when count(*) < 11 or min(x) = max(x) then 'rank_only' else 'band' end as disclosure, floor(round(quantile_cont(x, 0.25) * 100, 6) + 0.5) / 100 as q1, floor(round(quantile_cont(x, 0.5) * 100, 6) + 0.5) / 100 as q2, floor(round(quantile_cont(x, 0.75) * 100, 6) + 0.5) / 100 as q3 from p)
select s_suppkey, (select count(*) from supplier) as rank_of, n as peer_count, disclosure,
cast(case when disclosure <> 'none' then floor(((select count(*) from p where x < s_acctbal) + (select count(*) from p where x = s_acctbal) / 2) / n * 100 + 0.5) end as int) as percentile_rank,
case when disclosure = 'band' then q1 end as p25, case when disclosure = 'band' then q2 end as p50, case when disclosure = 'band' then q3 end as p75 from o, f""")
def org_summary(spark, sf_dir):
    """One organisation's rows among all others."""
    s = _read(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_suppkey").cast("string").alias("ccn"), "s_acctbal", "s_nationkey")
    orgs = s.select(F.col("s_nationkey").cast("string").alias("org"), "ccn")
    return benchmarking.org_summary(s, orgs, "3", "s_acctbal").select("s_suppkey", "rank_of", "peer_count", "disclosure", "percentile_rank", "p25", "p50", "p75")


#: (item, dimension, kind, objective, correct keys) over the event types.
ITEMS = [("click", "D1", "likert", False, []), ("view", "D2", "ladder", False, []), ("purchase", "D4", "scenario", True, ["B"]), ("signup", "D4", "likert", False, []), ("error", "D6", "likert", False, [])]
DIMENSIONS = [("D1", "individual", 0.4, 3), ("D2", "individual", 0.3, 2), ("D4", "individual", 0.3, 1), ("D6", "organizational", 1.0, None)]
_ANSWERS_SQL = """(select user_id as respondent, event_type as item, cast(floor(arg_max(value, event_id)) as bigint) % 6 as v from events group by 1, 2)"""
_SCORES_SQL = f"""(with i(item, dimension, kind, objective) as (values ('click', 'D1', 'likert', false), ('view', 'D2', 'ladder', false), ('purchase', 'D4', 'scenario', true), ('signup', 'D4', 'likert', false), ('error', 'D6', 'likert', false)),
a as (select p.respondent, i.*, nullif(x.v, 0) as v from (select distinct respondent from {_ANSWERS_SQL}) p cross join i left join {_ANSWERS_SQL} x on x.respondent = p.respondent and x.item = i.item),
s as (select *, case kind when 'scenario' then case when v >= 5 then 5.0 when v is not null then 1.0 end when 'ladder' then 1 + (v - 1) * 4 / 3.0 when 'likert' then case when v is not null then least(5.0, greatest(1.0, v)) end end as score from a),
d as (select respondent, dimension, avg(score) filter (not objective) as own, avg(score) filter (objective) as facts, count(score) as answered, count(*) as total from s group by 1, 2),
r as (select *, round(case when own is not null and facts is not null then 0.7 * own + 0.3 * facts else coalesce(own, facts) end, 6) as raw from d)
select respondent, dimension, raw, cast(floor(round((raw - 1) / 4 * 100, 6) + 0.5) as int) as score, answered = 0 or total - answered > total / 2 as insufficient, answered, total from r)"""


def _answers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    e = _read(spark, sf_dir, "events").groupBy(F.col("user_id").alias("respondent"), F.col("event_type").alias("item")).agg(F.max_by("value", "event_id").alias("x"))
    v = F.floor("x") % 6
    said = e.where(F.col("item").isin(*[i[0] for i in ITEMS])).select("respondent", "item", v.cast("string").alias("value"), (v == 0).alias("na"))
    people = e.select("respondent").distinct()
    said = people.join(said, "respondent", "left").fillna({"item": ITEMS[0][0], "na": True})
    return said, spark.createDataFrame(ITEMS, "item string, dimension string, kind string, objective boolean, correct array<string>"), spark.createDataFrame(DIMENSIONS, "dimension string, axis string, weight double, prerequisite_rank int")


@query(f"select respondent, dimension, round(raw, 4) as raw, score, insufficient, answered, total from {_SCORES_SQL}")
def readiness_scores(spark, sf_dir):
    """Dimension scores of every respondent."""
    found = readiness.readiness(*_answers(spark, sf_dir))["dimensions"]
    return found.withColumn("raw", F.round("raw", 4))


@query(f"""with s as (select * from {_SCORES_SQL}), w(dimension, axis, weight) as (values ('D1', 'individual', 0.4), ('D2', 'individual', 0.3), ('D4', 'individual', 0.3), ('D6', 'organizational', 1.0)),
x as (select respondent, cast(floor(round(sum(weight * score) filter (axis = 'individual' and score is not null) / sum(weight) filter (axis = 'individual' and score is not null), 6) + 0.5) as int) as ici, max(score) filter (axis = 'organizational') as oei,
coalesce(max(case when dimension = 'D4' and score < 50 then 1 else 0 end), 0) = 1 as gated from s join w using (dimension) group by 1),
y as (select *, case when coalesce(ici >= 60, false) and coalesce(oei >= 60, false) then 'frontier' when coalesce(ici >= 60, false) then 'blocked_agency' when coalesce(oei >= 60, false) then 'emergent' else 'early' end as placement_ungated from x)
select respondent, ici, oei, gated, placement_ungated, case when gated and placement_ungated = 'frontier' then 'emergent' else placement_ungated end as placement from y""")
def readiness_placements(spark, sf_dir):
    """Indexes and placement of every respondent."""
    return readiness.readiness(*_answers(spark, sf_dir))["placements"]


@query(f"""with s as (select * from {_SCORES_SQL} where dimension <> 'D6' and score is not null and not insufficient), r as (select *, case dimension when 'D4' then 1 when 'D2' then 2 else 3 end as pr from s),
o as (select *, row_number() over (partition by respondent order by case when dimension = 'D4' and score < 50 then 0 when score < 50 then 1 else 2 end, case when score < 50 then pr else score end, pr, dimension) as place from r)
select respondent, cast(place as int) as place, dimension, score from o where place <= 2""")
def readiness_targets(spark, sf_dir):
    """The two dimensions to work on."""
    return readiness.readiness(*_answers(spark, sf_dir))["targets"]


# --- documents, pages, nested rows ------------------------------------------------------


@query(r"select doc_id, len(regexp_extract_all(text, '(?is)lorem\s+ipsum.{0,40}?dolor|\bthe\s+of\b')) as n from documents")
def boilerplate_count(spark, sf_dir):
    """I8: how often a phrase over line ends occurs in each text."""
    return _read(spark, sf_dir, "documents").select("doc_id", F.regexp_count("text", F.lit(r"(?is)lorem\s+ipsum.{0,40}?dolor|\bthe\s+of\b")).cast("long").alias("n"))


@query(r"""select doc_id, len(regexp_extract_all(text, '[0-9]+(?:[.,][0-9]+)*')) as mentions, regexp_extract(text, '[0-9]+(?:[.,][0-9]+)*') as first_amount from documents where regexp_matches(text, '[0-9]')""")
def amount_mentions(spark, sf_dir):
    """I9, in part: amounts in each text."""
    amount = F.lit(r"[0-9]+(?:[.,][0-9]+)*")
    d = _read(spark, sf_dir, "documents").where(F.col("text").rlike("[0-9]"))
    return d.select("doc_id", F.regexp_count("text", amount).cast("long").alias("mentions"), F.regexp_extract("text", r"[0-9]+(?:[.,][0-9]+)*", 0).alias("first_amount"))


@query(r"select doc_id, case when contains(lower(text), 'vvv consultants') or contains(lower(text), 'vvv research') or contains(lower(text), 'vandehaar') then 'vvv' end as template from documents")
def document_templates(spark, sf_dir):
    """The known house format of each text."""
    return _read(spark, sf_dir, "documents").select("doc_id", community.template(F.col("text")).alias("template"))


@query(r"""select page_id, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)), '^www\.', '') as root from pages""")
def site_roots(spark, sf_dir):
    """The host of each page, without www."""
    return _read(spark, sf_dir, "pages").select("page_id", names.site_root("url").alias("root"))


@query(r"""with r as (select distinct regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)), '^www\.', '') as root from pages)
select root, unnest(['https://' || root || '/cms-hpt.txt', 'https://www.' || root || '/cms-hpt.txt', 'https://' || root || '/CMS-HPT.txt']) as url from r where root <> ''""")
def index_urls(spark, sf_dir):
    """Where each site's index may be, each site once."""
    roots = _read(spark, sf_dir, "pages").select(names.site_root("url").alias("root")).distinct()
    return roots.select("root", F.explode(names.index_urls(F.col("root"))).alias("url"))


@query("""select event_id, cast(json_extract_string(props, '$.k') as int) as k from events""")
def json_lines(spark, sf_dir):
    """A12, in part: fields of nested rows, read by a schema of strings."""
    return _read(spark, sf_dir, "events").select("event_id", F.from_json("props", "k string")["k"].try_cast("int").alias("k"))


@query(r"""select page_id, 'https://www.google.com/search?q=' || replace(replace(replace(replace('"' || regexp_extract(url, '://([^/]*)', 1) || '" price transparency machine readable standard charges', '%', '%25'), '"', '%22'), ':', '%3A'), ' ', '+') as search from pages""")
def search_urls(spark, sf_dir):
    """A web search for each host."""
    p = _read(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "://([^/]*)", 1).alias("h"))
    return p.select("page_id", names.search_url(F.col("h"), F.lit(None).cast("string"), F.lit(None).cast("string")).alias("search"))


@query("""select c_custkey, c_name || ' (' || n_name || ', ' || c_nationkey || ')' as label, case when c_acctbal < 0 then true else false end as negative from customer join nation on c_nationkey = n_nationkey""")
def hospital_labels(spark, sf_dir):
    """Display labels."""
    c, n = _read(spark, sf_dir, "customer"), _read(spark, sf_dir, "nation")
    rows = c.join(n, c.c_nationkey == n.n_nationkey)
    return rows.select("c_custkey", names.hospital_label(F.col("c_custkey").cast("string"), F.col("c_name"), F.col("n_name"), F.col("c_nationkey").cast("string")).alias("label"), (F.col("c_acctbal") < 0).alias("negative"))


@query("""with d as (select doc_id, case doc_id % 6 when 0 then '*' when 1 then '0' when 2 then ' 12 ' when 3 then '3.9' when 4 then 'abc' else '-' end as raw from documents)
select doc_id, case raw when '0' then 0 when ' 12 ' then 12 when '3.9' then 3 end as value, raw not in ('0', ' 12 ', '3.9') as suppressed from d""")
def parsed_counts(spark, sf_dir):
    """Counts, with suppression told apart from zero."""
    k = F.col("doc_id") % 6
    raw = F.when(k == 0, "*").when(k == 1, "0").when(k == 2, " 12 ").when(k == 3, "3.9").when(k == 4, "abc").otherwise("-")
    return _read(spark, sf_dir, "documents").select("doc_id", T.parse_count(raw).alias("p")).select("doc_id", "p.value", "p.suppressed")
