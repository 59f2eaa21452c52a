"""Where a hospital's patients come from, and who else serves those places."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Subjects and rivals that are compared at once, and ZIPs of a product of matrices.
SUBJECTS, RIVALS, ZIPS_AT_ONCE = 1024, 4096, 256
TOP = pa.schema([("ccn", pa.string()), ("rival", pa.string()), ("overlap_cases", pa.int64()), ("shared_zips", pa.int64())])


def edition(cells: DataFrame, name: str | None = None) -> DataFrame:
    """One edition of the cells, the latest where none is named, so no total counts twice."""
    if name is not None:
        return cells.where(F.col("edition") == name)
    return cells.join(F.broadcast(cells.agg(F.max("edition").alias("edition"))), "edition")


def published(cells: DataFrame) -> DataFrame:
    return cells.where(~F.col("suppressed") & F.col("cases").isNotNull())


def first_cells(cells: DataFrame, order: str) -> DataFrame:
    """The first row of each (ccn, zip5, edition)."""
    w = Window.partitionBy("ccn", "zip5", "edition").orderBy(order)
    return cells.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def draw(cells: DataFrame) -> DataFrame:
    """Each hospital's ZIPs: its cases, the ZIP's total, and its share of it."""
    rows = published(cells).groupBy("ccn", "zip5").agg(F.sum("cases").alias("cases"))
    # partial sums by ZIP, not a window, so that one very large ZIP needs no task of its own
    totals = rows.groupBy("zip5").agg(F.sum("cases").alias("zip_total"))
    share = F.coalesce(F.round(F.try_divide(F.col("cases").cast("double"), F.col("zip_total")), 4), F.lit(1.0))
    return rows.join(totals, "zip5").select("ccn", "zip5", "cases", "zip_total", share.alias("share"))


def draw_of(cells: DataFrame, ccn: str, n: int = 25) -> DataFrame:
    """The ZIPs of one hospital, largest first."""
    mine = published(cells).where(F.col("ccn") == ccn).select("zip5").distinct()
    near = published(cells).join(F.broadcast(mine), "zip5", "left_semi")  # ZIPs of one hospital
    return draw(near).where(F.col("ccn") == ccn).orderBy(F.desc("cases"), "zip5").limit(n)


def competitors_of(cells: DataFrame, hospitals: DataFrame, ccn: str, n: int = 15) -> DataFrame:
    """Others in the ZIPs of one hospital, by the cases they take there."""
    mine = cells.where((F.col("ccn") == ccn) & ~F.col("suppressed")).select("zip5").distinct()
    rivals = published(cells).where(F.col("ccn") != ccn).join(mine, "zip5", "left_semi")
    ranked = rivals.groupBy("ccn").agg(F.sum("cases").alias("overlap_cases"), F.count("*").alias("shared_zips"))
    return ranked.join(hospitals.select("ccn", "name", "state"), "ccn", "left").orderBy(F.desc("overlap_cases"), "ccn").limit(n)


def _tile(asked: pa.Table, cells: pa.Table, n: int) -> pa.Table:
    """The ``n`` largest of these rivals for each of these subjects, from ``asked(ccn, zip5)`` and
    ``cells(rival, zip5, cases, cells)``; rivals that are alike go by their number.

    ZIPs that many of both have are summed as a product of matrices, the others one by one."""
    zips = pc.unique(asked["zip5"])
    cells = cells.filter(pc.is_in(cells["zip5"], zips))
    if not cells.num_rows:
        return TOP.empty_table()
    subjects, rivals = (names.take(pc.sort_indices(names)) for names in (pc.unique(asked["ccn"]), pc.unique(cells["rival"])))
    at = lambda column, names: pc.index_in(column, names).to_numpy()
    s, sz, r, rz = at(asked["ccn"], subjects), at(asked["zip5"], zips), at(cells["rival"], rivals), at(cells["zip5"], zips)
    cases, count = cells["cases"].to_numpy().astype(float), cells["cells"].to_numpy().astype(float)
    s, places = s[(o := np.argsort(sz, kind="stable"))], np.arange(len(zips) + 1)
    s_from, o = np.searchsorted(sz[o], places), np.argsort(rz, kind="stable")
    r, cases, count, r_from = r[o], cases[o], count[o], np.searchsorted(rz[o], places)
    overlap, shared = np.zeros((len(subjects), len(rivals))), np.zeros((len(subjects), len(rivals)))  # whole numbers, exact below 2^53
    many = np.diff(s_from) * np.diff(r_from) * 64 > overlap.size
    for k in np.flatnonzero(~many):
        theirs = slice(r_from[k], r_from[k + 1])
        cross = np.ix_(s[s_from[k] : s_from[k + 1]], r[theirs])
        overlap[cross] += cases[theirs]
        shared[cross] += count[theirs]
    for part in np.array_split(np.flatnonzero(many), -(-int(many.sum()) // ZIPS_AT_ONCE) or 1):
        has, theirs, cell = np.zeros((len(subjects), len(part))), np.zeros((len(part), len(rivals))), np.zeros((len(part), len(rivals)))
        for j, k in enumerate(part):
            has[s[s_from[k] : s_from[k + 1]], j] = 1
            theirs[j, r[r_from[k] : r_from[k + 1]]] = cases[r_from[k] : r_from[k + 1]]
            cell[j, r[r_from[k] : r_from[k + 1]]] = count[r_from[k] : r_from[k + 1]]
        overlap += has @ theirs
        shared += has @ cell
    itself = pc.index_in(subjects, rivals)
    shared[np.flatnonzero(pc.is_valid(itself).to_numpy(zero_copy_only=False)), itself.drop_null().to_numpy()] = 0
    key = overlap.astype(np.int64) * len(rivals) + np.arange(len(rivals))[::-1]
    key[shared == 0] = -np.iinfo(np.int64).max
    best = np.argpartition(-key, n - 1, axis=1)[:, :n] if n < len(rivals) else np.broadcast_to(np.arange(len(rivals)), key.shape)
    row = np.repeat(np.arange(len(subjects)), best.shape[1])
    keep = shared[row, best.ravel()] > 0
    row, col = row[keep], best.ravel()[keep]
    return pa.table([subjects.take(pa.array(row)), rivals.take(pa.array(col)), overlap[row, col].astype(np.int64), shared[row, col].astype(np.int64)], schema=TOP)


def competitors(cells: DataFrame, subjects: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` largest rivals of each hospital of ``subjects(ccn)``, by the cases they
    take in its ZIPs.

    Every subject is compared with every rival, in tiles of some ``SUBJECTS`` by ``RIVALS``, and
    only the largest of a tile leave it, so pairs are neither shuffled nor written.  ``cells``
    are read several times: give a stored table."""
    asked = cells.where(~F.col("suppressed")).join(subjects.select("ccn").distinct(), "ccn", "left_semi").select("ccn", "zip5").where("zip5 is not null").distinct()
    rival = published(cells).where("ccn is not null and zip5 is not null").groupBy(F.col("ccn").alias("rival"), "zip5").agg(F.sum("cases").cast("long").alias("cases"), F.count("*").alias("cells"))
    tiles = lambda df, most: -(-df.distinct().count() // most) or 1
    across, down = tiles(asked.select("ccn"), SUBJECTS), tiles(published(cells).select("ccn"), RIVALS)
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    own = lambda df: [F.col(c).alias(c) for c in df.columns]  # noqa: E731, both sides come from the same cells
    left = asked.select(*own(asked), F.pmod(F.xxhash64("ccn"), F.lit(across)).cast("int").alias("s"), every(down).alias("r"))
    right = rival.select(*own(rival), every(across).alias("s"), F.pmod(F.xxhash64("rival"), F.lit(down)).cast("int").alias("r"))

    def run(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        return _tile(mine, theirs, n) if mine.num_rows and theirs.num_rows else TOP.empty_table()

    ranked = left.groupBy("s", "r").cogroup(right.groupBy("s", "r")).applyInArrow(run, "ccn string, rival string, overlap_cases long, shared_zips long")
    order = Window.partitionBy("ccn").orderBy(F.desc("overlap_cases"), "rival")
    return ranked.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)
