"""Names of hospitals, brands, files and web sites as matching keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import column, empty_to_null

# Words of legal form that no name key holds.
NAME_NOISE = ("THE", "INC", "LLC", "LP", "LLP", "PC", "PA", "CORP", "CORPORATION", "CO", "COMPANY", "OF", "AND")
# Words that describe a hospital instead of naming its owner.
GENERIC = (
    "HOSPITAL", "HOSPITALS", "MEDICAL", "CENTER", "CENTRE", "HEALTH", "HEALTHCARE", "REGIONAL", "MEMORIAL",
    "COMMUNITY", "COUNTY", "GENERAL", "SYSTEM", "CLINIC", "CARE", "DISTRICT", "AREA", "VALLEY", "SERVICES",
    "CHILDRENS", "REHABILITATION", "BEHAVIORAL", "SURGICAL", "SPECIALTY", "UNIVERSITY", "CITY", "COUNTRY", "STATE",
)
# First words that need a second one to tell brands apart.
NEEDS_SECOND = (
    "SAINT", "ST", "NORTH", "SOUTH", "EAST", "WEST", "NEW", "GOOD", "HOLY", "GREATER", "CENTRAL", "FIRST",
    "MOUNT", "LAKE", "PORT", "FORT", "SAN", "SANTA", "LOS", "LAS", "EL", "LA",
)
# Words too common to tell hospital names apart.
STOP_WORDS = (
    "inc", "llc", "lp", "the", "of", "and", "at", "dba", "co", "corp", "corporation", "company", "hospital",
    "hospitals", "medical", "center", "centre", "health", "healthcare", "regional", "memorial", "community",
    "district", "county", "clinic", "clinics", "campus", "system", "systems", "services", "service", "group",
    "associates",
)


def _listed(words: tuple[str, ...]) -> Column:
    return F.array(*map(F.lit, words))


def name_tokens(c: Column | str) -> Column:
    """Upper-case words without apostrophes, other punctuation or legal noise."""
    x = F.regexp_replace(F.upper(F.coalesce(column(c), F.lit(""))), "[’ʼ']", "")
    words = F.split(F.regexp_replace(x, "[^A-Z0-9]+", " "), " ")
    return F.filter(words, lambda w: (w != "") & ~w.isin(*NAME_NOISE))


def name_key(c: Column | str) -> Column:
    return F.array_join(name_tokens(c), " ")


def source_state(license_state: Column, address: Column) -> Column:
    """State of a source: of its license, else of a ``, XX 99999`` in the address."""
    found = F.upper(F.regexp_extract(F.coalesce(address, F.lit("")), r",\s*([A-Za-z]{2})\s+\d{5}", 1))
    return F.coalesce(empty_to_null(F.upper(license_state)), empty_to_null(found))


def system_key(c: Column | str) -> Column:
    """Brand in a hospital's name, or null for an independent one."""
    words = name_tokens(c)
    first, second = F.get(words, F.lit(0)), F.get(words, F.lit(1))
    two = F.concat_ws(" ", first, second)
    naming = F.get(F.filter(F.slice(words, 2, 1000), lambda w: ~w.isin(*GENERIC) & (F.length(w) >= 4)), F.lit(0))
    return (
        F.when(first.isNull(), F.lit(None))
        .when(first.isin(*NEEDS_SECOND) & second.isNotNull(), two)
        .when(first.isin(*GENERIC), naming)
        .when(F.length(first) < 4, F.when(second.isNotNull(), two))
        .otherwise(first)
    )


def significant_tokens(c: Column | str) -> Column:
    """Distinct words of over two letters that tell names apart; all of them where every
    one is common."""
    words = F.regexp_extract_all(F.lower(F.coalesce(column(c), F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))
    long = F.array_distinct(F.filter(words, lambda w: F.length(w) > 2))
    kept = F.array_except(long, _listed(STOP_WORDS))
    return F.when(F.size(kept) > 0, kept).otherwise(long)


def jaccard(a: Column, b: Column) -> Column:
    """Overlap of two token arrays, 0 where either is empty."""
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_union(a, b)))), F.lit(0.0))


def name_similarity(a: Column | str, b: Column | str) -> Column:
    return jaccard(significant_tokens(a), significant_tokens(b))


COUNTER = r"[ _]?\(\d+\)$"


def _base(c: Column | str) -> Column:
    return F.substring_index(column(c), "/", -1)


def without_extension(c: Column | str) -> Column:
    """File name without its last extension; a leading dot starts none."""
    return F.regexp_replace(_base(c), r"(?<=[^.])\.[^.]*$", "")


def canonical_name(c: Column | str) -> Column:
    """Download name: no extensions, no ``(n)`` counter, lower case."""
    stem = without_extension(c)
    stem = F.when(F.lower(stem).rlike(r"\.(csv|json|xlsx|xlsm|zip)$"), without_extension(stem)).otherwise(stem)
    return F.lower(F.trim(F.regexp_replace(F.trim(stem), COUNTER, "")))


def has_counter(c: Column | str) -> Column:
    return F.trim(without_extension(c)).rlike(COUNTER)


def readable_name(c: Column | str) -> Column:
    """File name as words: each known suffix goes once, in this order."""
    x = _base(F.coalesce(column(c), F.lit("")))
    for suffix in ("json", "csv", "xlsx", "xlsm", "zip", "gz"):
        x = F.regexp_replace(x, rf"(?i)\.{suffix}$", "")
    return F.translate(x, "_-", "  ")


def _identity(c: Column | str) -> Column:
    """Base name without an upload hash; a hash holds a letter, so no number is one."""
    return F.regexp_replace(_base(c), r"^(?=[0-9a-f]*[a-f])[0-9a-f]{6,}-", "")


def source_name(c: Column | str) -> Column:
    return _identity(c)


def file_npi(c: Column | str) -> Column:
    """NPI in the leading block of digits and dashes of a file name."""
    block = F.split(F.regexp_extract(_identity(c), r"^[\d-]+", 0), "-")
    return F.get(F.filter(block, lambda t: t.rlike(r"^[12]\d{9}$")), F.lit(0))


def file_ein(c: Column | str) -> Column:
    """EIN of a file name; ten digits of an NPI are never read as one."""
    base = _identity(c)
    block = F.regexp_extract(base, r"^[\d-]+", 0)
    tokens = F.filter(F.split(block, "-"), lambda t: ~t.rlike(r"^[12]\d{9}$") & t.rlike(r"^\d{9}$"))
    joined = F.translate(block, "-", "")
    rejoined = F.when(~joined.rlike(r"^[12]\d{9}$") & joined.rlike(r"^\d{9}"), F.substring(joined, 1, 9))
    inside = empty_to_null(F.concat(F.regexp_extract(base, r"(\d{2})-?(\d{7})", 1), F.regexp_extract(base, r"(\d{2})-?(\d{7})", 2)))
    return F.when(block != "", F.coalesce(F.get(tokens, F.lit(0)), rejoined)).otherwise(inside)


def file_ccn(c: Column | str) -> Column:
    """CCN that a downloader stamped on a file (``ccn-XXXXXX_``)."""
    return empty_to_null(F.upper(F.regexp_extract(_identity(c), r"(?i)^ccn-(\d{2}[0-9a-z]{4})[_.]", 1)))


def site_root(c: Column | str) -> Column:
    """Host of a web site without ``www.``, empty where there is none."""
    raw = F.trim(F.coalesce(column(c), F.lit("")))
    rest = F.regexp_replace(raw, r"^[^/]*//", "")
    host = F.regexp_extract(F.regexp_extract(rest, r"^[^/?#]*", 0), r"^(?:[^@]*@)?([^:]*)", 1)
    return F.regexp_replace(F.lower(host), r"^www\.", "")


def index_urls(root: Column) -> Column:
    """Where a site's index of files may be, in order."""
    three = F.array(F.concat(F.lit("https://"), root, F.lit("/cms-hpt.txt")), F.concat(F.lit("https://www."), root, F.lit("/cms-hpt.txt")), F.concat(F.lit("https://"), root, F.lit("/CMS-HPT.txt")))
    return F.when(root != "", three).otherwise(F.array().cast("array<string>"))


def absolute_url(url: Column, page: Column) -> Column:
    """``url`` seen from ``page``: absolute, protocol-relative, from the root, or beside it."""
    u, site = F.trim(url), F.regexp_extract(page, r"^([a-z]+://[^/]*)", 1)
    folder = F.regexp_replace(F.regexp_replace(page, r"[?#].*$", ""), r"(?<=[^/:]/)[^/]*$", "")
    return (
        F.when(u.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), u)
        .when(u.startswith("//"), F.concat(F.regexp_extract(page, r"^([a-z]+:)", 1), u))
        .when(u.startswith("/"), F.concat(site, u))
        .otherwise(F.concat(folder, u))
    )


def search_url(name: Column, city: Column, state: Column) -> Column:
    """A web search for a hospital's list of charges."""
    words = F.concat_ws(" ", F.concat(F.lit('"'), name, F.lit('"')), empty_to_null(city), empty_to_null(state), F.lit("price transparency machine readable standard charges"))
    return F.concat(F.lit("https://www.google.com/search?q="), F.url_encode(words))


def hospital_label(ccn: Column, name: Column, city: Column, state: Column) -> Column:
    """``NAME (City, ST)``, or the CCN of an unknown hospital."""
    place = empty_to_null(F.concat_ws(", ", empty_to_null(city), empty_to_null(state)))
    return F.coalesce(F.concat(empty_to_null(name), F.coalesce(F.concat(F.lit(" ("), place, F.lit(")")), F.lit(""))), ccn)
