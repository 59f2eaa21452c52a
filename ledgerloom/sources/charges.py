"""Price-transparency files, delimited: profile, header, metadata, tall and wide rows.

All files go through one plan.  A file's header becomes one row of a small table (a map
of column positions and an array of payer groups) that data rows join by file; rows are
then plain projections, and wide ones one ``explode_outer``.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.names import file_ein, file_npi, source_name

HEAD_BYTES, MAX_PREAMBLE = 256 * 1024, 8
SUPPORTED = r"(?i)\.(csv|json)(\.gz)?$"
# Column names that decide which row is the data header.
STRONG = ("description", "code|1", "payer_name", "plan_name")
WEAK = ("setting", "billing_class", "modifiers", "drug_unit_of_measurement", "drug_type_of_measurement")
METADATA = ("hospital_name", "last_updated_on", "version", "location_name", "hospital_location", "hospital_address", "type_2_npi")
# vendors' names of the standard columns.
ALIASES = {
    "insurance name": "payer_name",
    "plan name": "plan_name",
    "bill code description": "description",
    "bill code": "code|1",
    "bill code type": "code|1|type",
    "alternate bill code": "code|2",
    "gross charge": "standard_charge|gross",
    "payor rate": "standard_charge|negotiated_dollar",
    "minimum charge": "standard_charge|min",
    "maximum charge": "standard_charge|max",
    "cdm item number": "code|1",
    "revenue code": "code|2",
    "service description": "description",
    "discounted cash price": "standard_charge|discounted_cash",
    "minimum negotiated charge": "standard_charge|min",
    "maximum negotiated charge": "standard_charge|max",
}
RATE_FIELDS = ("negotiated_dollar", "negotiated_percentage", "negotiated_algorithm", "methodology")
METRIC_FIELDS = ("median_amount", "10th_percentile", "90th_percentile", "count", "additional_payer_notes")
PAYER_IN_NAME = r"(?i)^payer negotiated charge:\s*(.+?)\s*\(plan:\s*(.+?)\)\s*$"
#: The characters 0x80 to 0x9F as Latin-1 and as Windows-1252 has them.
WESTERN = tuple("".join(s) for s in zip(*((chr(k), bytes([k]).decode("cp1252")) for k in range(0x80, 0xA0) if k not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)), strict=True))
#: Heads that are read at once; most fields of a record (Spark's CSV reader wants a bound).
HEADS_AT_ONCE, MOST_FIELDS = 16, 200_000


def detect_encoding(sample: bytes) -> str:
    """Charset of a file's first bytes, by Java name."""
    if sample[:2] in (b"\xff\xfe", b"\xfe\xff") and sample[:4] not in (b"\xff\xfe\x00\x00", b"\x00\x00\xfe\xff"):
        return "UTF-16"
    if sample.startswith(b"\xef\xbb\xbf"):
        return "UTF-8"
    head = sample[:4096]
    if head.count(0) * 4 > len(head):
        return "UTF-16LE" if head[1:2] == b"\x00" else "UTF-16BE"
    try:
        sample.decode("utf-8")
    except UnicodeDecodeError as e:
        return "UTF-8" if e.start >= len(sample) - 4 else "windows-1252"
    return "UTF-8"


def detect_delimiter(line: str) -> str:
    """What separates a line's columns: another sign only if it is more frequent than commas."""
    best = max(("\t", ";", "|"), key=line.count)
    return best if line.count(best) > line.count(",") else ","


def _head(spark: SparkSession, path: str) -> bytes:
    """The first ``HEAD_BYTES`` of a file's text, whatever its size; only they are read."""
    jvm = spark._jvm  # Hadoop's file systems, so any store that Spark reads will do
    at = jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark._jsc.hadoopConfiguration()).open(at)
    try:
        if path.lower().endswith(".gz"):
            stream = jvm.java.util.zip.GZIPInputStream(stream)
        return bytes(stream.readNBytes(HEAD_BYTES))
    finally:
        stream.close()


def profile(head: bytes) -> tuple[str, str, int]:
    """(encoding, delimiter, most fields of a line) of a file's first bytes."""
    encoding = detect_encoding(head)
    lines = head.decode(encoding, "ignore").lstrip("\ufeff").splitlines() or [""]
    sep = detect_delimiter(lines[0])
    return encoding, sep, max(x.count(sep) for x in lines) + 1


def profiles(spark: SparkSession, path: str) -> DataFrame:
    """``(path, encoding, delimiter, columns)`` of every CSV below ``path``.

    The heads are read through Hadoop's streams, several at a time, and only what they say
    is kept; a file's size does not matter.  ``columns`` is the most fields of a line of
    the head: rows with more are read all the same (``read_lines``)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv*").load(path)
    paths = [r[0] for r in files.select("path").collect()]  # names only: no content is read
    with ThreadPoolExecutor(HEADS_AT_ONCE) as pool:
        rows = list(pool.map(lambda p: (p, *profile(_head(spark, p))), paths))
    return spark.createDataFrame(rows, "path string, encoding string, delimiter string, columns int")


def _fields_of(record: Column, delimiter: str) -> Column:
    """All fields of a raw record, for the few that have more than the schema."""
    sep = "\\" + delimiter
    quoted, plain = rf'"[^"]*+(?:""[^"]*+)*+"[^{sep}]*', rf"[^{sep}]*"
    fields = F.regexp_extract_all(F.concat(F.lit(delimiter), record), F.lit(f"{sep}({quoted}|{plain})"), F.lit(1))
    return F.transform(fields, lambda c: F.when(c.startswith('"'), F.replace(F.regexp_replace(c, r'(?s)^"(.*)"[^"]*$', "$1"), F.lit('""'), F.lit('"'))).otherwise(c))


def read_lines(spark: SparkSession, path: str, profile: DataFrame | None = None) -> DataFrame:
    """``(source_file, line, row)`` of all CSVs: fields as an array, in file order.

    ``profile`` has the columns of ``profiles``, for files whose profile is known.

    There is one scan for each distinct (encoding, delimiter), however many files; a file
    is one partition, so its line numbers are in order.  Spark cuts a record at the
    schema's width, but keeps its raw text: such records are split anew, so no field is
    lost, wherever in a file the widest row is."""
    found = (profiles(spark, path) if profile is None else profile).groupBy("encoding", "delimiter").agg(F.collect_list("path").alias("paths"), F.max("columns").alias("n")).collect()
    parts = []
    for encoding, delimiter, paths, n in found:
        schema = ", ".join(f"_c{k} string" for k in range(n)) + ", _raw string"
        western = encoding == "windows-1252"  # Spark reads Latin-1; its control characters are Windows' signs
        raw = spark.read.schema(schema).options(sep=delimiter, encoding="ISO-8859-1" if western else encoding, multiLine=True, escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord="_raw", maxColumns=MOST_FIELDS).csv(paths)
        fields = F.array(*[F.coalesce(f"_c{k}", F.lit("")) for k in range(n)])
        # a raw text is kept for shorter records too; only as many signs can make a longer one
        longer = F.col("_raw").isNotNull() & (F.length("_raw") - F.length(F.replace("_raw", F.lit(delimiter))) >= n)
        row = F.when(longer, _fields_of(F.col("_raw"), delimiter)).otherwise(fields)
        if western:
            row = F.transform(row, lambda c: F.translate(c, *WESTERN))
        marked = F.when(F.col("_c0").startswith("\ufeff"), F.transform(row, lambda c, k: F.when(k == 0, F.substring(c, F.lit(2), F.length(c))).otherwise(c))).otherwise(row)
        parts.append(raw.select(source_name(F.col("_metadata.file_name")).alias("source_file"), F.monotonically_increasing_id().alias("line"), marked.alias("row")))
    out = parts[0] if parts else spark.createDataFrame([], "source_file string, line long, row array<string>")
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def telling(aliases: dict[str, str] = ALIASES) -> tuple[str, ...]:
    """Every row that names data columns has one of these somewhere."""
    return (*STRONG, *WEAK[1:], "standard_charge|", "payer negotiated charge:", *(k for k, v in aliases.items() if v in STRONG))


def canonical_header(row: Column, aliases: dict[str, str] = ALIASES) -> Column:
    """Known vendor names (``aliases``, lower-cased) rewritten; ``Payer Negotiated Charge: P (Plan: L)`` becomes a
    column of payer P and plan L."""
    table = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])

    def one(c: Column) -> Column:
        t = F.trim(c)
        wide = F.concat(F.lit("standard_charge|"), F.regexp_extract(t, PAYER_IN_NAME, 1), F.lit("|"), F.regexp_extract(t, PAYER_IN_NAME, 2), F.lit("|negotiated_dollar"))
        return F.coalesce(F.try_element_at(table, F.lower(t)), F.when(t.rlike(PAYER_IN_NAME), wide), c)

    return F.transform(row, one)


def is_data_header(row: Column, aliases: dict[str, str] = ALIASES) -> Column:
    """Evidence that a row names the data's columns, not the metadata's."""
    names = F.transform(canonical_header(row, aliases), lambda c: F.lower(F.trim(c)))
    listed = lambda words: F.array(*map(F.lit, words))
    meta = F.arrays_overlap(names, listed(METADATA)) | F.exists(names, lambda c: c.startswith("license_number"))
    wide = F.exists(names, lambda c: c.startswith("standard_charge|") & (F.size(F.split(c, r"\|")) >= 3))
    weak = F.size(F.array_intersect(F.array_distinct(names), listed(WEAK))) >= 2
    return ~meta & (F.arrays_overlap(names, listed(STRONG)) | wide | weak)


def headers(lines: DataFrame, aliases: dict[str, str] = ALIASES) -> DataFrame:
    """One row for each file with a data header: its line, names, layout, positions and
    payer groups, and the metadata from the two rows above it.

    The header is the first row that names data columns, and at most 8 rows with any
    content stand above it.  One look at the joined cells tells almost all data rows, so
    the evidence is weighed for a few rows only and no file is put in order."""
    joined = F.lower(F.array_join("row", "\n"))
    may_be = reduce(or_, (F.contains(joined, F.lit(w)) for w in telling(aliases)))
    able = lines.where(F.when(may_be, is_data_header(F.col("row"), aliases)))  # weighed in no other row
    first = able.groupBy("source_file").agg(F.min("line").alias("header_line"), F.min_by("row", "line").alias("raw"))
    filled = F.array_join("row", "").rlike(r"(?U)[^\s\x00-\x1f\x7f]")
    above = lines.join(first.select("source_file", "header_line"), "source_file").where(F.col("line") < F.col("header_line")).where(filled)
    # of more than 8 rows the file has no header; the last two are the metadata
    meta = above.groupBy("source_file").agg(F.max_by(F.struct("line", "row"), "line").alias("last"), F.count("*").alias("above"))
    before = above.join(meta.select("source_file", F.col("last.line").alias("last_line")), "source_file").where(F.col("line") < F.col("last_line"))
    names_row = before.groupBy("source_file").agg(F.max_by("row", "line").alias("meta_header"))
    meta = meta.join(names_row, "source_file", "left")
    names = canonical_header(F.col("raw"), aliases)
    lowered = F.transform("header", lambda c: F.lower(F.trim(c)))
    out = first.join(meta, "source_file", "left").where(F.coalesce("above", F.lit(0)) <= MAX_PREAMBLE)
    out = out.select("source_file", "header_line", names.alias("header"), "meta_header", F.when(F.col("meta_header").isNotNull(), F.col("last.row")).alias("meta_values"))
    wide = F.exists(lowered, lambda c: c.startswith("standard_charge|") & (F.size(F.split(c, r"\|")) == 4))
    layout = F.when(F.array_contains(lowered, "payer_name"), "tall").when(wide, "wide").otherwise("tall")
    index = F.map_from_entries(F.transform(lowered, lambda c, k: F.struct(c.alias("k"), k.alias("v"))))
    out = out.withColumns({"layout": layout, "idx": index})
    groups = F.when(F.col("layout") == "tall", tall_group(F.col("idx"))).otherwise(payer_groups(F.col("header")))
    return out.select("source_file", "header_line", "header", "layout", "idx", code_positions(F.col("idx")).alias("codes"), groups.alias("groups"), "meta_header", "meta_values")


def tall_group(index: Column) -> Column:
    """The columns of a tall header that name and price a payer, as the one group it has."""
    place = lambda name: F.try_element_at(index, F.lit(name))
    known = [*((f, f"standard_charge|{f}") for f in RATE_FIELDS), *((f, f) for f in METRIC_FIELDS[:-1]), ("payer_name", "payer_name"), ("plan_name", "plan_name")]
    cols = F.map_from_entries(F.array(*[F.struct(F.lit(field).alias("k"), place(name).alias("v")) for field, name in known]))
    none = F.lit(None).cast("string")
    return F.array(F.struct(none.alias("payer"), none.alias("plan"), cols.alias("cols")))


def payer_groups(header: Column) -> Column:
    """``array<struct<payer, plan, cols map>>`` of the per-payer columns of a wide header."""

    def parsed(c: Column, k: Column) -> Column:
        p = F.split(F.trim(c), r"\|")
        rate = (p[0] == "standard_charge") & (F.size(p) == 4)
        field = F.when(rate & F.get(p, F.lit(3)).isin(*RATE_FIELDS), F.get(p, F.lit(3))).when(p[0].isin(*METRIC_FIELDS) & (F.size(p) == 3), p[0])
        return F.struct(F.get(p, F.lit(1)).alias("payer"), F.get(p, F.lit(2)).alias("plan"), field.alias("field"), k.alias("at"))

    cells = F.filter(F.transform(header, parsed), lambda x: x["field"].isNotNull())
    keys = F.array_distinct(F.transform(cells, lambda x: F.struct(x["payer"].alias("payer"), x["plan"].alias("plan"))))
    cols = lambda key: F.map_from_entries(F.transform(F.filter(cells, lambda x: (x["payer"] == key["payer"]) & (x["plan"] == key["plan"])), lambda x: F.struct(x["field"].alias("k"), x["at"].alias("v"))))
    return F.transform(keys, lambda key: F.struct(key["payer"].alias("payer"), key["plan"].alias("plan"), cols(key).alias("cols")))


def metadata(heads: DataFrame) -> DataFrame:
    """Rows of ``charge_sources`` (before counting and linking) of each file."""
    names = F.transform("meta_header", lambda c: F.lower(F.trim(c)))
    get = F.map_from_entries(F.transform(F.arrays_zip(names.alias("n"), F.col("meta_values").alias("v")), lambda x: F.struct(x["n"].alias("k"), x["v"].alias("v"))))
    rows = heads.withColumn("_m", get).withColumn("_lic", F.get(F.filter(names, lambda c: c.startswith("license_number")), F.lit(0)))
    val = lambda name: T.clean_str(F.try_element_at("_m", F.lit(name)))
    npis = F.filter(F.split(F.coalesce(val("type_2_npi"), F.lit("")), r"[|,/;\s]+"), lambda t: t.rlike(r"^\d+$"))
    npis = F.when(F.size(npis) > 0, npis).otherwise(F.array_compact(F.array(file_npi("source_file"))))
    lic = F.trim(F.regexp_replace(T.clean_str(F.try_element_at("_m", F.col("_lic"))), r'^[\s"]+|[\s"]+$', ""))
    parts = F.split(lic, r"\|", 2)
    in_name = T.empty_to_null(F.upper(F.regexp_extract("_lic", r"\|(.*)$", 1)))
    return rows.select(
        "source_file", val("hospital_name").alias("hospital_name"), val("location_name").alias("location_name"), val("hospital_address").alias("hospital_address"),
        file_ein("source_file").alias("ein"), F.get(npis, F.lit(0)).alias("primary_npi"), npis.alias("npis"), T.empty_to_null(F.trim(parts[0])).alias("license_number"),
        F.coalesce(in_name, F.upper(F.trim(F.get(parts, F.lit(1))))).alias("license_state"), val("version").alias("mrf_version"), "layout", T.parse_date(val("last_updated_on")).alias("last_updated_on"),
    )


def _cell(name: str, idx: str = "idx") -> Column:
    return F.get("row", F.try_element_at(idx, F.lit(name)))


def code_positions(index: Column) -> Column:
    """``array<struct<at, type_at>>`` of ``code|1``, ``code|2`` ... up to the first that is
    missing.  Worked out once for a header, so rows look at their own codes only."""
    numbers = F.sequence(F.lit(1), F.size(index) + 1)  # one more than there can be
    name = lambda k: F.concat(F.lit("code|"), k.cast("string"))
    missing = F.array_position(F.transform(numbers, lambda k: F.try_element_at(index, name(k)).isNull()), True)
    return F.transform(F.slice(numbers, F.lit(1), (missing - 1).cast("int")), lambda k: F.struct(F.try_element_at(index, name(k)).alias("at"), F.try_element_at(index, F.concat(name(k), F.lit("|type"))).alias("type_at")))


def _codes() -> dict[str, Column]:
    """The first code that is given, its type, and the others as ``type:code;...``."""
    get = lambda at: T.clean_cell(F.get("row", at))
    each = F.transform("codes", lambda x: F.struct(get(x["at"]).alias("code"), F.coalesce(get(x["type_at"]), F.lit("")).alias("type")))
    return {"_given": F.filter(each, lambda x: x["code"].isNotNull())}


def _code_columns() -> dict[str, Column]:
    given = F.col("_given")
    rest = F.array_join(F.transform(F.slice(given, F.lit(2), F.size(given)), lambda x: F.concat(x["type"], F.lit(":"), x["code"])), ";")
    return {"code": F.get(given, F.lit(0))["code"], "code_type": T.empty_to_null(F.get(given, F.lit(0))["type"]), "additional_codes": T.empty_to_null(rest)}


def charges(lines: DataFrame, heads: DataFrame, limit: int | None = None) -> DataFrame:
    """Charge rows of all files, in one pass.  ``limit`` is a number of items of each file,
    for trials.

    The header table has one row a file; Spark decides by its size whether to broadcast.
    A tall row has one group of payer columns, a wide row those that state a rate; an item
    without any keeps one row, which ``explode_outer`` gives by itself."""
    rows = lines.join(heads.select("source_file", "header_line", "layout", "idx", "codes", "groups"), "source_file").where("line > header_line")
    if limit is not None:
        rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy("source_file").orderBy("line"))).where(F.col("_n") <= limit).drop("_n")
    clean = ("description", "billing_class", "setting", "drug_unit_of_measurement", "drug_type_of_measurement", "modifiers")
    item = {c: T.clean_cell(_cell(c)) for c in clean}
    item |= {c: T.cell_decimal(_cell(f"standard_charge|{n}")) for c, n in (("gross_charge", "gross"), ("discounted_cash", "discounted_cash"), ("min_charge", "min"), ("max_charge", "max"))}
    item["generic_notes"] = T.clean_cell(_cell("additional_generic_notes"))
    rows = rows.withColumns(_codes()).withColumns(item | _code_columns()).where("description is not null or code is not null")
    base = ["source_file", "code", "code_type", "additional_codes", *[c for c in item if c != "generic_notes"]]
    percent, tall = "decimal(9,4)", F.col("layout") == "tall"

    def has_rate(g: Column) -> Column:
        cell = lambda f: F.get("row", F.try_element_at(g["cols"], F.lit(f)))
        return T.cell_decimal(cell("negotiated_dollar")).isNotNull() | T.cell_decimal(cell("negotiated_percentage"), percent).isNotNull() | T.clean_cell(cell("negotiated_algorithm")).isNotNull()

    each = rows.withColumn("g", F.explode_outer(F.when(tall, F.col("groups")).otherwise(F.filter("groups", has_rate))))
    at = lambda f: F.get("row", F.try_element_at("g.cols", F.lit(f)))
    return each.select(
        *base, F.when(tall, T.clean_text(at("payer_name"))).otherwise(F.col("g.payer")).alias("payer_name"), F.when(tall, T.clean_text(at("plan_name"))).otherwise(F.col("g.plan")).alias("plan_name"),
        T.cell_decimal(at("negotiated_dollar")).alias("negotiated_dollar"), T.cell_decimal(at("negotiated_percentage"), percent).alias("negotiated_percentage"),
        T.clean_cell(at("negotiated_algorithm")).alias("negotiated_algorithm"), T.clean_cell(at("methodology")).alias("methodology"), T.cell_decimal(at("median_amount")).alias("median_amount"),
        T.cell_decimal(at("10th_percentile")).alias("percentile_10"), T.cell_decimal(at("90th_percentile")).alias("percentile_90"), T.to_int(at("count")).alias("count"), F.coalesce(T.clean_cell(at("additional_payer_notes")), "generic_notes").alias("additional_notes"),
    )


def with_identifiers(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Facts with their source's EIN and primary NPI, as stored."""
    return rows.join(sources.select("source_file", "ein", "primary_npi"), "source_file")


PAYER = "payer_name:string,plan_name:string,standard_charge_dollar:string,standard_charge_percentage:string,standard_charge_algorithm:string,methodology:string,estimated_amount:string,additional_payer_notes:string"
CHARGE = f"setting:string,billing_class:string,gross_charge:string,discounted_cash:string,minimum:string,maximum:string,modifiers:array<string>,payers_information:array<struct<{PAYER}>>"
ITEM = f"description:string,drug_information:struct<unit:string,type:string>,code_information:array<struct<code:string,type:string>>,standard_charges:array<struct<{CHARGE}>>"
JSON_SCHEMA = f"""hospital_name string, last_updated_on string, version string, hospital_location array<string>,
hospital_address array<string>, license_information struct<license_number:string,state:string>,
type_2_npi array<string>, standard_charge_information array<struct<{ITEM}>>"""


#: As ``JSON_SCHEMA``, with amounts as variants, which hold a string or an exact number.  Spark
#: takes the text of a number that it reads as a string from the file anew, a seek for each.
AMOUNTS = ("gross_charge", "discounted_cash", "minimum", "maximum", "standard_charge_dollar", "standard_charge_percentage", "estimated_amount")
READ_SCHEMA = re.sub(rf"\b({'|'.join(AMOUNTS)}):string", r"\1:variant", JSON_SCHEMA)


def read_json(spark: SparkSession, path: str, names: str = "*.json*") -> DataFrame:
    """Nested charge files, one row a file; amounts are strings or exact numbers, so none is lost."""
    raw = spark.read.schema(READ_SCHEMA).options(multiLine=True, recursiveFileLookup=True, pathGlobFilter=names).json(path)
    return raw.select(source_name(F.col("_metadata.file_name")).alias("source_file"), "*")


def is_charge_file() -> Column:
    return F.col("standard_charge_information").isNotNull() | F.col("hospital_name").isNotNull()


def json_metadata(raw: DataFrame) -> DataFrame:
    npis = F.filter(F.coalesce("type_2_npi", F.array().cast("array<string>")), lambda t: F.trim(t).rlike(r"^\d+$"))
    npis = F.when(F.size(npis) > 0, npis).otherwise(F.array_compact(F.array(file_npi("source_file"))))
    return raw.where(is_charge_file()).select(
        "source_file", "hospital_name", F.coalesce(F.get("hospital_location", F.lit(0)), "hospital_name").alias("location_name"), T.empty_to_null(F.array_join("hospital_address", "; ")).alias("hospital_address"),
        file_ein("source_file").alias("ein"), F.get(npis, F.lit(0)).alias("primary_npi"), npis.alias("npis"), F.col("license_information.license_number").alias("license_number"), F.upper("license_information.state").alias("license_state"),
        F.col("version").alias("mrf_version"), F.lit("json").alias("layout"), T.parse_date("last_updated_on").alias("last_updated_on"),
    )


def json_charges(raw: DataFrame, limit: int | None = None) -> DataFrame:
    """Charge rows of nested files: items, their charges, and their payers or none."""
    items = F.col("standard_charge_information") if limit is None else F.slice("standard_charge_information", 1, limit)
    rows = raw.where(is_charge_file()).select("source_file", F.explode(items).alias("i"))
    codes = F.filter("i.code_information", lambda x: x["code"] != "")
    rows = rows.select("source_file", "i", codes.alias("codes"), F.explode("i.standard_charges").alias("c")).select("source_file", "i", "codes", "c", F.explode_outer("c.payers_information").alias("p"))
    amounts = {"gross_charge": "c.gross_charge", "discounted_cash": "c.discounted_cash", "min_charge": "c.minimum", "max_charge": "c.maximum", "negotiated_dollar": "p.standard_charge_dollar", "negotiated_percentage": "p.standard_charge_percentage", "median_amount": "p.estimated_amount"}
    # cells as columns, so that cleaning looks at what is there, not at how it is found
    rows = rows.select("source_file", "i", "c", "p", "codes", F.get("codes", F.lit(0)).alias("first"), F.array_join("c.modifiers", ";").alias("modifiers"), *[F.col(at).cast("string").alias(f"_{name}") for name, at in amounts.items()])
    extra = F.array_join(F.transform(F.slice("codes", F.lit(2), F.size("codes")), lambda x: F.concat(F.coalesce(x["type"], F.lit("")), F.lit(":"), x["code"])), ";")
    cell, amount = lambda c: T.clean_cell(F.col(c)), lambda name, kind="decimal(14,2)": T.cell_decimal(F.col(f"_{name}"), kind).alias(name)
    return rows.select(
        "source_file", cell("i.description").alias("description"), cell("c.billing_class").alias("billing_class"), cell("c.setting").alias("setting"),
        cell("i.drug_information.unit").alias("drug_unit_of_measurement"), cell("i.drug_information.type").alias("drug_type_of_measurement"), cell("modifiers").alias("modifiers"),
        cell("first.code").alias("code"), cell("first.type").alias("code_type"), T.empty_to_null(extra).alias("additional_codes"),
        *map(amount, ("gross_charge", "discounted_cash", "min_charge", "max_charge")),
        cell("p.payer_name").alias("payer_name"), cell("p.plan_name").alias("plan_name"), amount("negotiated_dollar"), amount("negotiated_percentage", "decimal(9,4)"),
        cell("p.standard_charge_algorithm").alias("negotiated_algorithm"), cell("p.methodology").alias("methodology"), amount("median_amount"),
        F.lit(None).cast("decimal(14,2)").alias("percentile_10"), F.lit(None).cast("decimal(14,2)").alias("percentile_90"), F.lit(None).cast("int").alias("count"), cell("p.additional_payer_notes").alias("additional_notes"),
    )


def listing(spark: SparkSession, path: str) -> DataFrame:
    """Every file below ``path``, and whether its kind can be read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(source_name(F.element_at(F.split("path", "/"), -1)).alias("source_file"), "path", F.col("path").rlike(SUPPORTED).alias("supported"))
