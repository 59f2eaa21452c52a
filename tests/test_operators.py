"""Operators on small tables whose answers are known."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import benchmarking, community, coverage, discovery, duplicates, gaps, linkage, prices, ranks, readiness, service_area, strategies

HOSPITAL = "ccn string, name string, city string, state string, is_active boolean"
SOURCE = "source_file string, hospital_name string, hospital_address string, license_state string, ein string, primary_npi string, npis array<string>, ccn string, link_method string, charge_count long"


@pytest.fixture(scope="module")
def hospitals(spark):
    rows = [("170001", "Mercy Hospital Onaga", "Onaga", "KS", True), ("170002", "Mercy Clinic Topeka", "Topeka", "KS", True), ("170003", "St Lukes Hospital", "Salina", "KS", True), ("260001", "St Lukes Hospital", "Joplin", "MO", True), ("170004", "Bluestem Center", "Derby", "KS", True), ("170005", "Bluestem Center", "Pratt", "KS", False)]
    return spark.createDataFrame(rows, HOSPITAL)


def source(name, hospital=None, state=None, ein=None, npi=None, npis=None, ccn=None, method=None, n=10, address=None):
    return (name, hospital, address, state, ein, npi, npis, ccn, method, n)


def test_links(spark, hospitals):
    rows = [
        source("ccn-170004_x.csv", "St. Luke's Hospital", "KS"),
        source("a.csv", npis=["9", "1111111111"], npi="2222222222"),
        source("b.csv", "ST LUKES HOSPITAL", address="1 Main, Salina, KS 67401"),
        source("c.csv", "St Lukes Hospital"),
        source("d.csv", ccn="260001", method="manual_review", npi="1111111111"),
        source("ccn-999999_x.csv", "Nobody", "KS"),
    ]
    sources = spark.createDataFrame(rows, SOURCE)
    crosswalk = spark.createDataFrame([("1111111111", "170001"), ("2222222222", "170002")], "npi string, ccn string")
    linked = linkage.link(sources, hospitals, crosswalk)
    got = {r.source_file: (r.ccn, r.link_method) for r in linked.collect()}
    assert got == {"ccn-170004_x.csv": ("170004", "filename_ccn"), "a.csv": ("170001", "crosswalk_npi"), "b.csv": ("170003", "name_state"), "c.csv": (None, None), "d.csv": ("260001", "manual_review"), "ccn-999999_x.csv": (None, None)}
    assert linkage.link(sources, hospitals, crosswalk, name_fallback=False).where("source_file = 'b.csv' and ccn is null").count() == 1
    sheet = spark.createDataFrame([("y", "c.csv", "170003"), ("", "c.csv", "170003"), ("y", "zz", "170003"), ("y", "c.csv", "1"), ("y", "a.csv", "170003"), ("y", "a.csv", "170001")], "confirm string, source_file string, ccn string")
    status = linkage.decide(sheet, linked, hospitals)
    assert sorted((r.source_file, r.ccn, r.status) for r in status.collect()) == sorted([("c.csv", "170003", "applied"), ("c.csv", "170003", "skipped"), ("zz", "170003", "unknown_file"), ("c.csv", "1", "unknown_ccn"), ("a.csv", "170003", "already_linked"), ("a.csv", "170001", "applied")])
    after = {r.source_file: (r.ccn, r.link_method) for r in linkage.apply_links(linked, status).collect()}
    assert after["c.csv"] == ("170003", "manual_review")
    relinked = {(r.source_file, r.ccn): r.status for r in linkage.decide(sheet.where("ccn = '170003' and source_file = 'a.csv'"), linked, hospitals, relink=True).collect()}
    assert relinked == {("a.csv", "170003"): "applied"}


def test_gap_report(spark, hospitals):
    sources = spark.createDataFrame([source("m.csv", "Mercy System", ccn="170001"), source("bluestem-derby.csv", "Bluestem Derby", "KS", n=99), source("e.csv", "Bluestem", n=0)], SOURCE)
    report = gaps.gap_report(hospitals, sources)
    systems = report["systems"].collect()
    assert [(r.system, r.remaining, r.already_publishing) for r in systems] == [("ST LUKES", 2, False)]
    assert sorted(r.ccn for r in report["independents"].collect()) == ["170002", "170004"]
    assert [(r.ccn, r.source_file, r.same_state) for r in report["probable"].collect()] == [("170004", "bluestem-derby.csv", True)]
    assert [(r.state, r.total, r.covered, r.pct) for r in report["coverage"].collect()] == [("MO", 1, 0, 0.0), ("KS", 4, 1, 25.0)]
    t = report["totals"].first()
    assert (t.hospitals, t.covered, t.remaining, t.states_not_started, t.recoverable_rows) == (5, 1, 4, 1, 99)
    assert linkage.suggestions(report["probable"]).first().state_known == "yes"


def test_coverage(spark, hospitals):
    sources = spark.createDataFrame([source("mercy.csv", "Mercy", ein="1", ccn="170001"), source("mercy-er.csv", "Mercy ER", ein="1"), source("mercy-x.csv", "Mercy X", ein="2"), source("commercy.csv", "Commercy", ein="9")], SOURCE)
    found = coverage.coverage(hospitals, sources, "mercy")
    assert {r.source_file: r["class"] for r in found["files"].collect()} == {"mercy.csv": "linked", "mercy-er.csv": "shared", "mercy-x.csv": "missing"}
    assert [(r.ccn, r.covered) for r in found["hospitals"].collect()] == [("170002", False), ("170001", True)]
    assert found["diagnosis"].first().diagnosis == "partly"
    for pattern, want in (("zzz", "nothing"), ("bluestem", "no_files"), ("commercy", "none_linked")):
        assert coverage.coverage(hospitals, sources, pattern)["diagnosis"].first().diagnosis == want


def test_duplicates(spark):
    rows = [source("x.zip", ein="1"), source("x (1).zip", ein="1"), source("x (2).zip", ein="1"), source("er.csv", ein="1"), source("z.csv", ein="2")]
    sources = spark.createDataFrame(rows, SOURCE)
    charges = sources.select("source_file")
    g = duplicates.groups(sources).first()
    assert (g.copies, g.canonical_names, g.redundant_rows, g.is_redownload) == (4, 2, 30, False)
    left, facts, gone = duplicates.prune(sources, charges)
    assert sorted(r.source_file for r in gone.collect()) == ["x (1).zip", "x (2).zip"]
    assert facts.count() == left.count() == 3 and duplicates.prune(left, facts)[2].count() == 0
    t = duplicates.totals(sources).first()
    assert (t.redundant_files, t.redundant_rows, t.redownload_rows, t.per_facility_rows, t.redundant_share) == (3, 30, 20, 10, 60.0)


def test_prices(spark, hospitals):
    charges = spark.createDataFrame([("a", "1", "MRI", v, None, n, p) for v, n, p in ((10.0, 0.0, "A"), (20.0, 5.0, " "), (30.0, 7.0, "A"), (40.0, -1.0, None))], "source_file string, code string, description string, gross_charge double, discounted_cash double, negotiated_dollar double, payer_name string")
    sources = spark.createDataFrame([source("a", ccn="170001")], SOURCE)
    found = prices.price(charges, sources, hospitals, "1", state="KS")
    s = found["spread"].first()
    assert (s.charge_rows, s.hospitals, s.gross_median, s.gross_p25, s.cash_count, s.cash_median, s.negotiated_count) == (4, 1, 25.0, 17.5, 0, None, 2)
    assert sorted(map(tuple, found["payers"].collect())) == [("(unnamed)", 1, 5.0), ("A", 1, 7.0)]
    unlinked = spark.createDataFrame([source("a")], SOURCE)
    assert [prices.matching(charges, unlinked, hospitals, "1", linked_only=x).count() for x in (True, False)] == [0, 4]
    assert prices.matching(charges, unlinked, hospitals, "1", state="KS", linked_only=False).count() == 0


def test_service_area(spark):
    cells = spark.createDataFrame([("a", "1", "2023", 30, False), ("b", "1", "2023", 10, False), ("b", "2", "2023", None, True), ("a", "1", "2022", 99, False)], "ccn string, zip5 string, edition string, cases int, suppressed boolean")
    latest = service_area.edition(cells)
    assert {(r.ccn, r.zip5): r.share for r in service_area.draw(latest).collect()} == {("a", "1"): 0.75, ("b", "1"): 0.25}
    assert service_area.edition(cells, "2022").count() == 1


def test_benchmark_discloses_nothing(spark):
    rows = [("small", float(k)) for k in range(5)] + [("rank", float(k)) for k in range(8)] + [("same", 1.0)] * 20 + [("band", 10.0 * k) for k in range(12)] + [("band", None)]
    df = spark.createDataFrame(rows, "g string, value double")
    got = benchmarking.peer_benchmark(df, ("g",)).collect()
    by = {}
    for r in got:
        by.setdefault(r.g, set()).add(r.disclosure)
    assert by == {"small": {"none"}, "rank": {"rank_only"}, "same": {"rank_only"}, "band": {"band"}}
    assert {r.percentile_rank for r in got if r.g == "same"} == {50}
    zero = next(r for r in got if r.g == "band" and r.value == 0)
    assert (zero.p25, zero.p50, zero.p75, zero.percentile_rank) == (35.0, 60.0, 85.0, 0)
    with pytest.raises(ValueError):
        benchmarking.cohort("beds")
    with pytest.raises(ValueError):
        benchmarking.owners(spark.createDataFrame([("x", "1"), ("y", "1")], "org string, ccn string"))
    own = benchmarking.org_summary(df.withColumn("ccn", F.col("g")), spark.createDataFrame([("o", "small")], "org string, ccn string"), "o").collect()
    assert len(own) == 5 and {r.disclosure for r in own} == {"band"} and {r.rank_of for r in own} == {46}
    assert benchmarking.org_summary(df.withColumn("ccn", F.col("g")), spark.createDataFrame([("o", "small")], "org string, ccn string"), "p").count() == 0


def test_readiness(spark):
    items = [("a", "D1", "likert", False, []), ("b", "D4", "ladder", False, []), ("c", "D4", "scenario", True, ["B"]), ("d", "D6", "likert", False, [])]
    said = [("p", "a", "9", False), ("p", "b", "1", False), ("p", "c", " b", False), ("p", "d", "5", False), ("q", "a", "3", True)]
    dims = [("D1", "individual", 0.5, 2), ("D4", "individual", 0.5, 1), ("D6", "organizational", 1.0, None)]
    got = readiness.readiness(spark.createDataFrame(said, "respondent string, item string, value string, na boolean"), spark.createDataFrame(items, "item string, dimension string, kind string, objective boolean, correct array<string>"), spark.createDataFrame(dims, "dimension string, axis string, weight double, prerequisite_rank int"))
    scores = {(r.respondent, r.dimension): (r.score, r.insufficient) for r in got["dimensions"].collect()}
    assert scores["p", "D1"] == (100, False) and scores["p", "D4"] == (30, False) and scores["q", "D1"] == (None, True)
    place = {r.respondent: (r.ici, r.oei, r.placement_ungated, r.placement) for r in got["placements"].collect()}
    assert place["p"] == (65, 100, "frontier", "emergent") and place["q"] == (None, None, "early", "early")
    assert [(r.place, r.dimension) for r in got["targets"].orderBy("place").collect()] == [(1, "D4"), (2, "D1")]


CHNA = """Community Health Needs Assessment 2024
prepared by VVV Consultants LLC on behalf of Patterson Health Center, Anthony, KS
Harper Co, KS
CHNA Round #5
Town Hall - 04/04/24  (Attendees 27 / 108 Total Votes)
1 Substance Abuse (Drugs & Alcohol) 21 19.4% 19%
2 Mental Health (Diagnos is , Placement)
Aftercare 20 18.5% 38%
6H o m e  H e a l t h 7 6 . 5 % 7 7 %
Total Votes 108
1 Obesity 80 10.4% 3
Lack of Visiting Specialists: Derm, Ped and
Urol.
Community social determinants are not part
of hospital's mission"""


def test_assessments(spark, hospitals):
    docs = spark.createDataFrame([("a.txt", CHNA), ("b.txt", "Prepared by: Acme Health Group in Ohio\nnothing"), ("c.txt", None)], "source_file string, text string")
    heads = {r.source_file: r for r in community.header(docs).collect()}
    a = heads["a.txt"]
    assert (a.hospital_name, a.county, a.state, a.cycle_label, a.year, a.townhall_date, a.attendees, a.total_votes, a.consultant) == ("Patterson Health Center", "Harper", "KS", "Round #5", 2024, "04/04/24", 27, 108, "vvv")
    assert heads["b.txt"].consultant_hint == "Acme Health Group" and heads["c.txt"].consultant is None
    needs = {r["rank"]: r for r in community.needs(docs).collect()}
    assert (needs[1].label, needs[1].votes, needs[1].pct, needs[1].accum, needs[1].recovered) == ("Substance Abuse (Drugs & Alcohol)", 21, 19.4, 19.0, False)
    assert needs[2].label == "Mental Health (Diagnosis, Placement) Aftercare"
    assert (needs[6].label, needs[6].votes, needs[6].pct, needs[6].accum, needs[6].recovered) == ("Home Health", 7, 6.5, 77.0, True)
    assert [(r["rank"], r.label, r.prior_rank, r.moved) for r in community.trends(docs).collect()] == [(1, "Obesity", 3, -2)]
    assert sorted(r.specialty for r in community.shortages(docs).collect()) == ["dermatology", "pediatrics", "urology"]
    assert {(r.kind, r.producer): r.documents for r in community.survey(community.header(docs)).collect()} == {("template", "vvv"): 1, ("hint", "Acme Health Group"): 1, ("unidentified", ""): 1}
    status = {r.source_file: r.status for r in community.attribute(community.header(docs).withColumn("hospital_name", F.when(F.col("source_file") == "a.txt", "St. Luke's Hospital")), hospitals).collect()}
    assert status == {"a.txt": "loaded", "b.txt": "unattributed", "c.txt": "unattributed"}
    have = spark.createDataFrame([("a.txt", "170001")], "source_file string, ccn string")
    new, refused = community.cover(have, spark.createDataFrame([("a.txt", "170001"), ("a.txt", "170002"), ("z", "170001"), ("a.txt", "1")], "source_file string, ccn string"), docs, hospitals)
    assert [tuple(r) for r in new.collect()] == [("a.txt", "170002")] and sorted(r.reason for r in refused.collect()) == ["already_covered", "unknown_ccn", "unknown_document"]


PLAN = """1 Substance Abuse (Drugs & Alcohol) a
a Continue to support programs Ongoing 4 $320
b Hire a counselor 2025 $1,700
2
Mental Health
Services
a Expand access to care 2026 2 $1,100
3 EMS (Staffing, Coverage) a Continue to support the crews
$700
$750
median household income is $51,000
We will contribute $50,000 annually in FY 2025 to subsidize a salary
Overall Total Contributions 256 $23,250
9 Not in order a"""


def test_strategies(spark):
    docs = spark.createDataFrame([("p", PLAN), ("e", None)], "source_file string, text string")
    rows = strategies.strategy_rows(docs)
    got = rows.collect()
    assert [(r.need_rank, r.text) for r in got if r.kind == "need"] == [(1, "Substance Abuse (Drugs & Alcohol)"), (2, "Mental Health Services"), (3, "EMS (Staffing, Coverage)")]
    assert [(r.need_rank, r.letter, r.timeframe, r.hours, r.dollars, r.tabulated) for r in got if r.kind == "commitment"] == [(1, "a", "Ongoing", 4, 320, True), (1, "b", "2025", None, 1700, True), (2, "a", "2026", 2, 1100, True), (3, None, None, None, 50000, False)]
    assert [r.fiscal_years for r in got if r.dollars == 50000] == [["2025"]]
    up = strategies.roll_up(rows).first()
    assert (up.committed_dollars, up.committed_hours, up.stated_dollars, up.reconciles) == (53120, 6, 23250, False)


def test_discovery(spark):
    body = "location-name: Kaiser Hospital Fresno\r\nmrf-url: /f.csv\r\n\r\nlocation_name = Kaiser Hospital Anaheim\r\nmrf_url = a.csv\r\nlocation-name: No Url Here\r\n"
    pages = spark.createDataFrame([("https://k.org/cms-hpt.txt", body), ("https://www.one.org/cms-hpt.txt", "mrf-url: https://o.org/x.json")], "url string, body string")
    assert discovery.index_blocks(pages).count() == 3
    wanted = spark.createDataFrame([("1", "Kaiser Foundation Hospital", "Fresno", "CA", "https://www.k.org"), ("2", "Kaiser Hospital", None, "CA", "k.org"), ("3", "Any", None, "KS", "one.org"), ("4", "None", None, "KS", None), ("5", "Gone", None, "KS", "gone.org")], "ccn string, name string, city string, state string, website string")
    got = {}
    for r in discovery.match_pages(wanted, pages).collect():
        got.setdefault(r.ccn, []).append((r.status, r.mrf_url))
    assert got["1"] == [("found", "https://k.org/f.csv")] and got["3"] == [("found", "https://o.org/x.json")]
    assert {s for s, _ in got["2"]} == {"ambiguous"} and len(got["2"]) == 2 and got["4"] == [("no_website", None)] and got["5"] == [("no_hpt", None)]
    manifest = discovery.match_pages(wanted, pages)
    assert sorted(r.file_name for r in discovery.ready(manifest).collect()) == ["ccn-1_kaiser-foundation-hospital_standardcharges.csv", "ccn-3_any_standardcharges.json"]
    assert discovery.manifest_sheet(manifest).where("mrf_url is null or score is null").count() == 0


def test_ranks(spark):
    """Places and quantiles against numpy, with one range of values and with many."""
    rng = np.random.default_rng(1)
    values = {g: np.round(rng.normal(0, 10, n), digits).tolist() for g, n, digits in (("a", 4000, 1), ("b", 3, 1), (None, 700, 2), ("c", 1, 1), ("d", 1500, 0))}
    df = spark.createDataFrame([(g, float(x)) for g, xs in values.items() for x in [*xs, float("nan")]], "g string, v double")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for ranges in (1, 9):
            spark.conf.set("spark.sql.shuffle.partitions", ranges)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            counts = ranks.counted(df, ["g"], F.col("v"))
            assert (counts.select(ranks.PART).distinct().count() > 5) == (ranges > 1)
            places = ranks.placed(counts, ["g"]).collect()
            assert len(places) == sum(len(set(xs)) for xs in values.values())
            for r in places:
                own = np.array(values[r.g])
                assert r.below == (own < r.x).sum() and r.same == (own == r.x).sum()
            found = ranks.quantiles(counts, ["g"], {"low": 0.25, "mid": 0.5, "high": 0.9}).collect()
            assert len(found) == 5
            for r in found:
                own = np.array(values[r.g])
                assert np.allclose([r.low, r.mid, r.high, r.min, r.max, r.n], [*np.quantile(own, [0.25, 0.5, 0.9]), own.min(), own.max(), len(own)])
        assert ranks.quantiles(ranks.counted(df.where("false"), ["g"], F.col("v")), ["g"], {"mid": 0.5}).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_probable_matches_by_brute_force(spark):
    """The rarest words lose no match that has the similarity."""
    rng = random.Random(2)
    words = ["mercy", "onaga", "valdez", "corbin", "lukes", "norway", "rivera", "greene", "stone", "oakley"]
    name = lambda: " ".join(rng.choices(words, [9, 9, 5, 3, 2, 1, 1, 1, 1, 1], k=rng.randint(1, 5)))
    gaps_ = [(f"{k:06d}", name(), rng.choice(["KS", "MO"])) for k in range(150)]
    files = [(f"z{k:04d}q.csv", name(), rng.choice(["KS", "MO", None]), k) for k in range(120)]
    found = linkage.probable(spark.createDataFrame(files, "source_file string, hospital_name string, state string, charge_count long"), spark.createDataFrame(gaps_, "ccn string, name string, state string")).collect()
    got = {}
    for r in found:
        got.setdefault(r.source_file, []).append((-r.score, r.ccn))
    want = {}
    for source_file, n, state, _ in files:
        score = lambda other, n=n: len(set(n.split()) & set(other.split())) / len(set(n.split()) | set(other.split()))
        best = sorted((-round(score(o), 3), ccn) for ccn, o, s in gaps_ if score(o) >= 0.3 and state in (None, s))[:3]
        if best:
            want[source_file] = best
    assert {k: sorted(v) for k, v in got.items()} == want


def test_letter_spaced_text(spark):
    spaced = re.compile(r"(?<![A-Za-z])\S(?: {1,2}\S){3,}")
    slow = lambda t: spaced.sub(lambda m: " ".join(w.replace(" ", "") for w in m[0].split("  ")), t)
    rng = random.Random(1)
    texts = ["".join(rng.choice(["a", " ", "b", " ", "  ", "\n", "1", ".", "cd", "   ", "\u00e9"]) for _ in range(rng.randint(0, 60))) for _ in range(2000)] + ["6H o m e  H e a l t h 7 6 . 5 %"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, t string").select("i", community.dekern("t").alias("t")).orderBy("i").collect()
    assert [r.t for r in rows] == [slow(t) for t in texts] and any(slow(t) != t for t in texts)


def test_shortages_near_cues(spark):
    far = "x" * 120
    texts = {
        "near": "There is a shortage of nurses here.", "far": f"There is a shortage {far} of nurses here.", "first": "nurses, a shortage", "part": "a shortage of nursesx",
        "recruiting": f"We recruit. A dermatologist {far} {far} vacancy for a podiatrist.", "second": f"counselor {far} {far} lack of therapists .", "none": None,
    }
    found = community.shortages(spark.createDataFrame(list(texts.items()), "source_file string, text string")).collect()
    got = {(r.source_file, r.specialty): r for r in found}
    assert set(got) == {("near", "nursing"), ("recruiting", "dermatology"), ("recruiting", "podiatry"), ("second", "behavioral health")}
    assert got["recruiting", "dermatology"].recruiting and not got["recruiting", "podiatry"].recruiting
    assert got["near", "nursing"].verbatim == "There is a shortage of nurses here." and got["second", "behavioral health"].verbatim.endswith("lack of therapists .")


def test_headings_in_sequence(spark):
    text = "2\n1 Access to Care a\n3\n2\nMental\nHealth\nServices\nand\nMore\nwords\n$5 to provide and support many things\n2 Again Not a\n3\nb Tactic\n4\nLast"
    rows = strategies.strategy_rows(spark.createDataFrame([("d", text), ("e", "7\n$3")], "source_file string, text string")).collect()
    assert [(r.need_rank, r.text) for r in rows if r.kind == "need"] == [(1, "Access to Care"), (2, "Mental Health Services and")]
    assert [(r.need_rank, r.dollars, r.tabulated) for r in rows if r.kind == "commitment"] == [(2, 5, False)]


def test_movements(spark):
    """A printed rank stands; else a label alike in the hospital's cycle before gives it."""
    ranked = [("a", 1, "Mental Health", None), ("a", 2, "Obesity", None), ("a", 4, "obesity", None), ("b", 1, "OBESITY.", None), ("b", 2, "mental  health", 7), ("b", 3, "Dental", None), ("c", 3, "Dental", None), ("d", 2, "Mental Health", None), ("x", 1, "Obesity", 4), ("x", 2, None, None)]
    held = [("a", "1", 2015), ("b", "1", 2018), ("c", "1", 2021), ("d", "1", 2021), ("d", "2", 2021), ("x", None, 2018), ("y", "1", None)]
    rows = spark.createDataFrame(ranked, "source_file string, rank int, label string, prior_rank int")
    found = community.movements(rows, spark.createDataFrame(held, "source_file string, ccn string, year int")).collect()
    got = sorted((r.source_file, r.ccn or "", r["rank"], r.prior_rank, r.moved) for r in found)
    assert got == [("a", "1", 1, None, None), ("a", "1", 2, None, None), ("a", "1", 4, None, None), ("b", "1", 1, 2, -1), ("b", "1", 2, 7, -5), ("b", "1", 3, None, None), ("c", "1", 3, 3, 0), ("d", "1", 2, 2, 0), ("d", "2", 2, None, None), ("x", "", 1, 4, -3), ("x", "", 2, None, None)]
    assert community.movements(rows.where("false"), spark.createDataFrame(held, "source_file string, ccn string, year int")).count() == 0


def test_long_and_odd_documents(spark):
    """Work grows with the length of a text, not with its square; odd rows have results."""
    cued = "lack of urology here. recruit nurses; " * 60_000
    tabled = "Town Hall - 04/04/24 (Attendees 27 / 108 Total Votes)\n" + "7 Food\n  more 21 19.4% 19%\nplain words\n" * 60_000 + "8 Home Care 30 20% 39%"
    docs = spark.createDataFrame([("cued", cued), ("tabled", tabled), ("none", None), ("empty", ""), (None, "3 Air 4 5% 6%"), (None, "3 Air 4 5% 6%")], "source_file string, text string")
    assert sorted((r.specialty, r.recruiting) for r in community.shortages(docs).collect()) == [("nursing", True), ("urology", True)]
    got = sorted((r.source_file or "", r["rank"], r.label, r.votes) for r in community.needs(docs).collect())
    assert got == [("", 3, "Air", 4), ("tabled", 7, "Food more", 21), ("tabled", 8, "Home Care", 30)]
    heads = {r.source_file: r for r in community.header(docs).collect()}
    assert community.header(docs).count() == 6 and heads["tabled"].total_votes == 108 and heads["empty"].year is None
    costs = spark.createDataFrame([("s", "1 Access to Care a\n" + "2 Food Supply\n3\nlabel\na Continue to support item 5 $1,000\n" * 60_000)], "source_file string, text string")
    assert strategies.strategy_rows(costs).where("kind = 'commitment'").count() == 60_000
    plan = community.need_rows(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


@pytest.mark.parametrize("sizes", [(1024, 4096, 256), (2, 3, 1)])
def test_rivals_in_tiles(spark, monkeypatch, sizes):
    """Tiles of any size give the rivals that a join of all cells gives, ties and all."""
    rng = random.Random(5)
    cells = [(f"{rng.randrange(30):02d}", f"z{rng.choice([0, 1, 2, rng.randrange(40)])}", rng.choice([0, 1, 5, 5, -2, None]), rng.random() < 0.1) for _ in range(400)] + [(None, "z1", 3, False), ("01", None, 3, False)]
    df = spark.createDataFrame(cells, "ccn string, zip5 string, cases int, suppressed boolean").cache()
    subjects = df.select("ccn").where("cast(ccn as int) % 3 = 0")
    for name, value in zip(("SUBJECTS", "RIVALS", "ZIPS_AT_ONCE"), sizes, strict=True):
        monkeypatch.setattr(service_area, name, value)
    asked = df.where("not suppressed").join(subjects.distinct(), "ccn", "left_semi").select("ccn", "zip5").distinct()
    pairs = asked.join(service_area.published(df).withColumnRenamed("ccn", "rival"), "zip5").where("ccn <> rival").groupBy("ccn", "rival").agg(F.sum("cases").alias("overlap_cases"), F.count("*").alias("shared_zips"))
    want = sorted(map(tuple, pairs.collect()), key=lambda r: (r[0], -r[2], r[1]))
    want = [(*r, k + 1) for c in sorted({r[0] for r in want}) for k, r in enumerate([r for r in want if r[0] == c][:4])]
    assert sorted(map(tuple, service_area.competitors(df, subjects, 4).collect()), key=lambda r: (r[0], r[4])) == want


def test_rivals_leave_their_tile_only_as_the_largest(spark):
    """Pairs of subjects and rivals are neither joined nor grouped as rows."""
    df = spark.range(40).selectExpr("cast(id as string) as ccn", "'z' as zip5", "1 as cases", "false as suppressed")
    plan = service_area.competitors(df, df.select("ccn"))._jdf.queryExecution().optimizedPlan().toString()
    assert "rival" in plan and "FlatMapCoGroupsInArrow" in plan and "Inner" not in plan
