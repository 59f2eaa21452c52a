"""Queries that write files in the shapes that are published, and read them back.

The shared tables are written to the shared folder as charge files, cost-report members,
documents and profile maps; the readers then take them from there."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import benchmarking, coverage, duplicates, linkage, store
from ..session import shared_folder
from ..sources import batch, charges, cost_files, roster, texts
from ..streaming import arrivals
from . import catalog, contract, loading, sheets  # noqa: F401, their queries join the catalog's
from .catalog import _read, query
from .derived import _roster

#: (kind, encoding, compression) of the charge files, dealt by supplier.
KINDS = (("plain", "UTF-8", "none"), ("zipped", "UTF-8", "gzip"), ("western", "ISO-8859-1", "none"), ("wide", "UTF-16LE", "none"))


@query("""select 'c' || l_partkey as code, 'caf' || chr(233) || ' ' || l_linenumber as description, round(l_extendedprice, 2) as gross_charge, case when l_returnflag <> 'R' then 'P' || l_linenumber end as payer_name from lineitem""")
def charge_files(spark, sf_dir):
    """Charge files in several encodings, plain and compressed."""
    root = shared_folder(spark, "charge-files")
    i = _read(spark, sf_dir, "lineitem")
    row = i.select(
        "l_suppkey", F.concat(F.lit("caf\u00e9 "), "l_linenumber").alias("description"), F.concat(F.lit("c"), "l_partkey").alias("code|1"), F.lit("CPT").alias("code|1|type"),
        F.format_string("%.2f", F.round("l_extendedprice", 2)).alias("standard_charge|gross"), F.when(F.col("l_returnflag") == "R", "N/A").otherwise(F.concat(F.lit("P"), "l_linenumber")).alias("payer_name"),
    )
    for k, (kind, encoding, compression) in enumerate(KINDS):
        row.where(F.col("l_suppkey") % len(KINDS) == k).drop("l_suppkey").write.options(header=True, encoding=encoding, compression=compression).csv(f"{root}/{kind}")
    lines = charges.read_lines(spark, root)
    found = charges.charges(lines, charges.headers(lines))
    return found.select("code", "description", F.col("gross_charge").cast("double").alias("gross_charge"), "payer_name")


@query("""select 'plain' as kind, 'loaded' as status, count(*) as rows, cast(coalesce(sum(cast(round(l_extendedprice, 2) as decimal(14, 2))), 0) as double) as gross, '' as reason from lineitem where l_suppkey % 4 = 0
union all select 'zipped', 'loaded', count(*), cast(coalesce(sum(cast(round(l_extendedprice, 2) as decimal(14, 2))), 0) as double), '' from lineitem where l_suppkey % 4 = 1
union all select 'damaged', 'failed', 0, 0, 'damaged gzip' from lineitem where l_suppkey % 4 = 2 having count(*) > 0
union all select 'headless', 'failed', 0, 0, 'no data header' from lineitem where l_suppkey % 4 = 3 having count(*) > 0""")
def charge_batch(spark, sf_dir):
    """A batch in which some files are damaged: the others load, each failure
    is a row of the ledger, and plain files are read in ranges."""
    root = shared_folder(spark, "charge-batch")
    i = _read(spark, sf_dir, "lineitem")
    row = i.select("l_suppkey", F.concat(F.lit("two\nlines, "), "l_linenumber").alias("description"), F.concat(F.lit("c"), "l_partkey").alias("code|1"), F.format_string("%.2f", F.round("l_extendedprice", 2)).alias("standard_charge|gross"), F.lit("P").alias("payer_name"))
    kinds = (("plain", "none", True), ("zipped", "gzip", True), ("damaged", "none", True), ("headless", "none", False))
    for k, (kind, compression, header) in enumerate(kinds):
        store.write_files(row.where(F.col("l_suppkey") % len(kinds) == k).drop("l_suppkey"), root, kind, header=header, compression=compression, escape='"')
    store.rename_files(spark, store.files_of(root, "damaged"), ".csv", ".csv.gz")  # files that only say that they are zipped
    kind = F.substring_index(F.element_at(F.split("path", "/"), -2), "=", -1)
    listed = batch.files(spark, root)
    staged = batch.stage(spark, root, f"{root}-staged", 1 << 16)
    lines = batch.lines(staged)
    heads = charges.headers(lines)
    facts = charges.charges(lines, heads)
    gross = facts.groupBy("source_file").agg(F.sum("gross_charge").alias("gross"))
    found = batch.ledger(listed, staged, heads, facts).join(listed.select("source_file", kind.alias("kind")), "source_file").join(gross, "source_file", "left")
    found = found.groupBy("kind", "status", F.substring_index("reason", ":", 1).alias("reason")).agg(F.sum("rows").alias("rows"), F.coalesce(F.sum("gross"), F.lit(0)).cast("double").alias("gross"))
    return found.select("kind", "status", "rows", "gross", "reason")


@query("""select 'c' || l_partkey as code, cast(l_extendedprice as double) as gross_charge, case when l_returnflag <> 'R' then l_returnflag end as payer_name from lineitem""")
def charge_files_json(spark, sf_dir):
    """Nested charge files, one for each supplier."""
    root = shared_folder(spark, "charge-json")
    i = _read(spark, sf_dir, "lineitem")
    payers = F.when(F.col("l_returnflag") != "R", F.array(F.struct(F.col("l_returnflag").alias("payer_name"), F.lit(1).alias("standard_charge_dollar"))))
    item = F.struct(F.lit("x").alias("description"), F.array(F.struct(F.concat(F.lit("c"), "l_partkey").alias("code"), F.lit("CPT").alias("type"))).alias("code_information"), F.array(F.struct(F.col("l_extendedprice").cast("decimal(14,2)").alias("gross_charge"), payers.alias("payers_information"))).alias("standard_charges"))
    files = i.groupBy("l_suppkey").agg(F.to_json(F.struct(F.lit("H").alias("hospital_name"), F.collect_list(item).alias("standard_charge_information"))).alias("value"))
    files.select("value").write.option("maxRecordsPerFile", 1).text(root)  # a file each in one folder, which one listing shows
    raw = charges.read_json(spark, root, "*.txt")
    return charges.json_charges(raw).select("code", F.col("gross_charge").cast("double").alias("gross_charge"), "payer_name")


@query("""select o.o_orderkey as rpt_rec_num, lpad(cast(o_custkey as varchar), 6, '0') as ccn, o_orderstatus as status_code, n.total, a.lines from orders o
left join (select l_orderkey, round(sum(l_extendedprice), 2) as total from lineitem group by 1) n on o_orderkey = n.l_orderkey left join (select l_orderkey, count(*) as lines from lineitem where l_returnflag <> 'R' group by 1) a on o_orderkey = a.l_orderkey""")
def cost_report_files(spark, sf_dir):
    """The three members of a vintage, told apart by their names."""
    root = shared_folder(spark, "cost-reports")
    paths = [f"{root}/HOSP10_2023_{m}.CSV" for m in ("RPT", "NMRC", "ALPHA")]
    o, i = _read(spark, sf_dir, "orders"), _read(spark, sf_dir, "lineitem")
    line = F.lpad(F.col("l_linenumber").cast("string"), 5, "0")
    o.select(F.concat_ws(",", "o_orderkey", F.lit("1"), F.lpad(F.col("o_custkey").cast("string"), 6, "0"), F.lit("x"), "o_orderstatus")).write.text(paths[0])
    i.select(F.concat_ws(",", "l_orderkey", F.lit("G300000"), line, F.lit("00100"), F.format_string("%.2f", "l_extendedprice"))).write.text(paths[1])
    i.select(F.concat_ws(",", "l_orderkey", F.lit("S200001"), line, F.lit("00100"), F.when(F.col("l_returnflag") == "R", "N/A").otherwise(F.col("l_returnflag")))).write.text(paths[2])
    v = cost_files.read_vintage(spark, paths, 2023)
    totals = v["numeric"].groupBy("rpt_rec_num").agg(F.round(F.sum("value").cast("double"), 2).alias("total"))
    lines = v["alpha"].groupBy("rpt_rec_num").agg(F.count("*").alias("lines"))
    out = v["reports"].join(totals, "rpt_rec_num", "left").join(lines, "rpt_rec_num", "left")
    return out.select("rpt_rec_num", "ccn", "status_code", "total", "lines")


@query("""select p_partkey % 50 as bucket, cast(sum(strlen(p_name) + 1) as bigint) as n_bytes, count(*) as n_lines from part group by 1""")
def document_files(spark, sf_dir):
    """Text documents, whole."""
    root = shared_folder(spark, "documents")
    p = _read(spark, sf_dir, "part").select(F.concat(F.col("p_partkey") % 50, F.lit("|"), "p_name").alias("value"), (F.col("p_partkey") % 50).alias("bucket"))
    p.repartition("bucket").write.partitionBy("bucket").text(root)
    docs = texts.read_documents(spark, root)
    bucket = F.substring_index("text", "|", 1)
    rows = docs.select(bucket.cast("long").alias("bucket"), "text", F.regexp_count("text", F.lit("\n")).cast("long").alias("n_lines"), F.length(bucket).alias("k"))
    return rows.groupBy("bucket").agg(F.sum(F.octet_length("text") - F.col("n_lines") * (F.col("k") + 1)).alias("n_bytes"), F.sum("n_lines").alias("n_lines"))


@query("""select lpad(cast(s_suppkey as varchar), 6, '0') as ccn, 'h' || s_suppkey || '.org' as website from supplier""")
def website_files(spark, sf_dir):
    """Web sites of profile maps, one map for each nation."""
    root = shared_folder(spark, "websites")
    s = _read(spark, sf_dir, "supplier")
    entry = F.struct(F.col("s_suppkey").cast("string").alias("k"), F.struct(F.concat(F.lit("h"), "s_suppkey", F.lit(".org")).alias("web")).alias("v"))
    maps = s.groupBy("s_nationkey").agg(F.to_json(F.struct(F.map_from_entries(F.collect_list(entry)).alias("hospitals"))).alias("value"))
    maps.select("value", "s_nationkey").repartition("s_nationkey").write.partitionBy("s_nationkey").text(root)
    return roster.websites(spark, root)


@query("""select l_suppkey % 10 as source_file, count(*) as rows, cast(sum(case when l_suppkey % 10 < 5 then 2 else 1 end) as bigint) as versions from lineitem group by 1""")
def arrived_files(spark, sf_dir):
    """K1: files that land in two rounds; the second replaces what it brings again."""
    root = shared_folder(spark, "arrivals")
    landing, target, mark = (f"{root}/{x}" for x in ("in", "out", "mark"))
    rows = _read(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 10).cast("string").alias("source_file"), "l_orderkey")
    schema = "source_file string, l_orderkey long, version int"
    for k, part in enumerate((rows, rows.where("cast(source_file as int) < 5"))):
        part.select("source_file", F.col("l_orderkey").cast("long").alias("l_orderkey"), F.lit(k + 1).alias("version")).write.parquet(f"{landing}/{k}")
        arrivals.ingest_available(arrivals.arrivals(spark, landing, schema), target, mark)
    out = spark.read.parquet(target)
    return out.groupBy(F.col("source_file").cast("long").alias("source_file")).agg(F.count("*").alias("rows"), F.sum("version").cast("long").alias("versions"))


@query("""select s_suppkey, s_name, coalesce(cast(case when s_acctbal >= 0 then s_nationkey end as varchar), '') as nation from supplier""")
def worklist_sheets(spark, sf_dir):
    """A sheet is written without nulls, and read back as strings."""
    path = shared_folder(spark, "sheet")
    s = _read(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("S_Name"), F.when(F.col("s_acctbal") >= 0, F.col("s_nationkey")).alias("nation"))
    store.write_sheet(s, path)
    back = store.read_sheet(spark, path)
    return back.select(F.col("s_suppkey").cast("long").alias("s_suppkey"), "s_name", F.coalesce("nation", F.lit("")).alias("nation"))


@query("""select 'pos' as source, 'loaded' as status, count(*) as records_read, count(*) filter (c_custkey % 10 < 8 and c_acctbal >= 0) as records_loaded from customer""")
def run_records(spark, sf_dir):
    """The record of a run, with the counts of its load."""
    counts = roster.load_statistics(_roster(spark, sf_dir)).first()
    run = store.run_record(spark, "pos", "loaded", counts.read, counts.active, datetime(2024, 1, 1))
    return run.select("source", "status", F.col("records_read").cast("long").alias("records_read"), F.col("records_loaded").cast("long").alias("records_loaded"))


# --- ordered answers --------------------------------------------------------------------


@query(f"""select key, charge_count, copies, redundant_rows from (select source as key, n_chars as charge_count, count(*) as copies, cast((count(*) - 1) * n_chars as bigint) as redundant_rows
from {catalog._DOC_FILES} group by 1, 2 having count(*) > 1) order by redundant_rows desc, key, charge_count limit 5""")
def duplicate_order(spark, sf_dir):
    """The duplicate groups with most redundant rows."""
    return duplicates.ordered(duplicates.groups(catalog._doc_files(spark, sf_dir)), 5).select("key", "charge_count", "copies", "redundant_rows")


@query("""select concat('f', o_orderkey) as source_file, cast(o_custkey as bigint) as charge_count, case when o_orderkey % 3 = 0 then 'skip_duplicate' else 'add' end as action from orders order by 2 desc, 1 limit 20""")
def merge_order(spark, sf_dir):
    """The largest files of a merge."""
    o = _read(spark, sf_dir, "orders").select(F.concat(F.lit("f"), "o_orderkey").alias("source_file"), "o_orderkey", F.col("o_custkey").alias("charge_count"))
    return store.ordered_plan(store.merge_plan(o.where("o_orderkey % 3 = 0"), o), 20)


@query("""select c_custkey, n as cohort_size, disclosure, cast(case when disclosure <> 'none' then floor((below + same / 2) / n * 100 + 0.5) end as int) as percentile_rank from (select *, case when n < 5 then 'none' when n < 11 or kinds = 1 or (kinds = 2 and same = 0) then 'rank_only' else 'band' end as disclosure from (
select c_custkey, count(*) over (partition by c_nationkey) - 1 as n, count(*) over (partition by c_nationkey, c_acctbal) - 1 as same, rank() over (partition by c_nationkey order by c_acctbal) - 1 as below, k.kinds from customer join (select c_nationkey as nk, count(distinct c_acctbal) as kinds from customer group by 1) k on c_nationkey = nk))""")
def peer_benchmark_by_state(spark, sf_dir):
    """One of the cohorts that may be asked for."""
    c = _read(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("state"), F.lit("x").alias("provider_subtype"), F.col("c_acctbal").alias("value"))
    return benchmarking.peer_benchmark(c, benchmarking.cohort("state_all")).select("c_custkey", "cohort_size", "disclosure", "percentile_rank")


def _coverage(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    known = contract.view(spark, sf_dir, "v_hospitals")
    files = contract.view(spark, sf_dir, "v_sources").join(known.select("ccn", F.col("name").alias("hospital_name")), "ccn")
    linked = F.when(F.col("ccn").cast("int") % 3 != 0, F.col("ccn"))
    return coverage.coverage(known, files.select("source_file", "hospital_name", F.col("source_file").alias("ein"), linked.alias("ccn"), "charge_count"), "supplier", limit=20)


@query("""with f as (select l_suppkey % 3 <> 0 as linked from lineitem group by l_suppkey) select count(*) as files, count(*) filter (linked) as linked, count(*) filter (not linked) as missing, (select count(*) from supplier) as hospitals, count(*) filter (linked) as covered, 'partly' as diagnosis from f""")
def coverage_question(spark, sf_dir):
    """What is held for a name, in one row."""
    return _coverage(spark, sf_dir)["diagnosis"].drop("sentence")


@query("""select source_file, charge_count, case when cast(ccn as int) % 3 <> 0 then 'linked' else 'missing' end as class from v_sources order by charge_count desc, source_file limit 20""")
def coverage_files(spark, sf_dir):
    """The largest files of a name."""
    return _coverage(spark, sf_dir)["files"].select("source_file", "charge_count", "class")


@query("""with f as (select lpad(cast(s_suppkey as varchar), 6, '0') as ccn, s_name as name, s_suppkey in (select l_suppkey from lineitem where l_suppkey % 3 <> 0) as covered from supplier) select * from f order by covered, name, ccn limit 20""")
def coverage_hospitals(spark, sf_dir):
    """Hospitals of a name, those without data first."""
    return _coverage(spark, sf_dir)["hospitals"].select("ccn", "name", "covered")


@query(f"""select 'z' || file as source_file, ccn, score, cast(file as int) % 50 as charge_rows from ({catalog.SQL["probable_matches"]}) order by 4 desc, score desc, 1, ccn limit 25""")
def suggestion_order(spark, sf_dir):
    """The review sheet, largest files first."""
    parts = contract.view(spark, sf_dir, "v_parts")
    files = parts.select(F.concat(F.lit("z"), "ccn").alias("source_file"), F.col("name").alias("hospital_name"), "state", (F.col("ccn").cast("int") % 50).cast("long").alias("charge_count"))
    return linkage.suggestions(linkage.probable(files, parts), 25).select("source_file", "ccn", "score", "charge_rows")


QUERIES, SQL = catalog.QUERIES, catalog.SQL
