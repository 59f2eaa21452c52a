"""N-gram Jaccard join: exact links between documents whose sets of word shingles are alike.

Two sets whose Jaccard similarity is at least a / b differ in at most H = (b - a) / (a + b)
of their summed sizes.  For a band of sizes the universe of shingles is hashed to m
segments; a segment with threshold 0 is indexed by the subset of the set that falls into
it, one with threshold 1 also by that subset without any one of its shingles.  With
thresholds v, sum(v + 1) = H + 1 + E, two such sets agree within the threshold in segments
of summed v + 1 of at least E + 1 (pigeonhole).  So a set may leave out its E keys of
threshold 0 that most sets share: the rarest key that two sets share is one that both
keep.  How many segments, deletions and spare keys a band has is chosen by a model of what
they cost for the sizes that were counted.  Candidates are then compared exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil, exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import components, cut, with_defaults
from .simhash import LEAST_TILE, _bytes, _lists, _runs, alike, band_groups, forest, known_parts, shingle_hashes
from .textbytes import mix

#: Words of a shingle; the similarity a / b; how far a band's sizes reach.
WORDS, SIMILARITY, GROWTH = 3, (9, 10), 1.4
#: What comparing two candidates costs, when a key costs 1.
COMPARE_COST = 8.0
#: Spare keys and segments with deletions that the model may choose; -1: all segments.
SPARES, DELETIONS = (0, 1, 2, 3), (0, 1, 2, -1)


def most_differences(a_size: int, b_size: int, similarity: tuple[int, int] = SIMILARITY) -> int:
    """The most elements that only one of two sets of these sizes has, if they are alike."""
    a, b = similarity
    return (b - a) * (a_size + b_size) // (a + b)


def band_edges(most: int, similarity: tuple[int, int] = SIMILARITY, growth: float = GROWTH) -> list[int]:
    """Where bands of sizes begin: 1, the first size that may link with another, and so on;
    a set of size ``most`` has a whole band above its own."""
    a, b = similarity
    edges = [1, ceil((a + b) / (b - a) / 2)]
    while len(edges) < 3 or edges[-2] <= most:
        edges.append(max(edges[-1] + 1, int(edges[-1] * growth)))
    return edges


class Allocation:
    """Of one band: ``segments``, of which the first ``deletions`` have threshold 1, and
    ``spare`` keys of threshold 0 that a set may leave out."""

    def __init__(self, differences: int, deletions: int, spare: int):
        need = differences + 1 + spare
        self.deletions = min(-(-need // 2) if deletions < 0 else deletions, need // 2 if deletions >= 0 else need)
        self.segments = max(self.deletions, need - self.deletions)
        self.spare = spare

    def cost(self, sets: float, size: float) -> float:
        """Keys of a set of this size, and the unrelated sets that share one: those whose
        segments are empty, or hold one shingle where a deletion may drop it."""
        per = size / self.segments
        keys = (self.segments - self.deletions) + self.deletions * (1 + per)
        empty, tail, term = self.segments * exp(-per), 1.0, exp(-self.segments * exp(-per))
        for k in range(self.spare + 1):  # the chance of more empty segments than spare keys
            tail -= term
            term *= empty / (k + 1)
        exact = (self.segments - self.deletions) * exp(-2 * per) * (max(tail, 0.0) / max(empty, 1e-300) if self.spare else 1.0)
        return keys + COMPARE_COST * sets * (exact + self.deletions * exp(-2 * per) * (1 + 2 * per))


def allocate(counted: dict[int, tuple[int, float]], edges: list[int], similarity: tuple[int, int] = SIMILARITY) -> list[Allocation | None]:
    """The cheapest allocation of each band; ``counted`` has its number of sets and their
    mean size.  None where only equal sets can be alike."""
    out: list[Allocation | None] = []
    for k, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
        differences = most_differences(hi - 1, hi - 1, similarity)
        sets, size = counted.get(k, (0, float(lo)))
        options = [Allocation(differences, d, e) for e in SPARES for d in DELETIONS]
        out.append(min(options, key=lambda x: (x.cost(sets, size), x.segments)) if differences else None)
    return out


def set_keys(h: np.ndarray, band: int, plan: Allocation) -> tuple[np.ndarray, np.ndarray]:
    """Keys of threshold 0 and of threshold 1 of one set in one band."""
    x = mix(h ^ mix(np.array([band + 1], np.uint64)))
    segment = ((x >> np.uint64(32)) % np.uint64(plan.segments)).astype(np.int64)
    token = mix(x + np.uint64(0x9E3779B97F4A7C15))
    sums = np.zeros(plan.segments, np.uint64)
    np.add.at(sums, segment, token)
    salt = mix((np.uint64(band + 1) << np.uint64(40)) + np.arange(plan.segments, dtype=np.uint64))
    keys = mix(sums ^ salt)
    if not plan.deletions:
        return keys, keys[:0]
    some = segment < plan.deletions
    without = mix((sums[segment[some]] - token[some]) ^ salt[segment[some]])
    return keys[plan.deletions :], np.unique(np.concatenate([keys[: plan.deletions], without]))


def parity(h: np.ndarray, differences: int) -> np.ndarray:
    """A bit for each of some 8 times as many cells as differences are allowed: whether an odd
    number of the set's elements falls there.  Bits in which two sets differ are at most as
    many as elements in which they do."""
    width = 1 << max(6, (8 * differences - 1).bit_length())
    cells = np.bincount((mix(h) & np.uint64(width - 1)).astype(np.int64), minlength=width)
    return np.packbits((cells & 1).astype(bool), bitorder="little").view(np.uint64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """The same parities for fewer cells, a smaller power of two."""
    return np.bitwise_xor.reduce(bits.reshape(-1, words), axis=0)


def may_link(bits: list[np.ndarray], sizes: np.ndarray, left: np.ndarray, right: np.ndarray, similarity: tuple[int, int], at_once: int = 64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For some rows of ``left`` at a time: which of ``right`` may be alike, by sizes and parities."""
    words = min(len(b) for b in bits)
    own = np.stack([folded(b, words) for b in bits])
    a, b = similarity
    for lo in range(0, len(left), at_once):
        some = left[lo : lo + at_once]
        apart = np.zeros((len(some), len(right)), np.int64)
        for k in range(words):
            apart += np.bitwise_count(own[some, k][:, None] ^ own[right, k][None, :])
        x, y = sizes[some][:, None], sizes[right][None, :]
        yield some, ((a + b) * apart <= (b - a) * (x + y)) & (b * np.minimum(x, y) >= a * np.maximum(x, y))


def bands_of(size: int, edges: list[int], similarity: tuple[int, int] = SIMILARITY) -> list[int]:
    """A set's own band, and the next one where a set of it may be alike."""
    a, b = similarity
    own = int(np.searchsorted(edges, size, "right")) - 1
    return [own, own + 1] if b * size >= a * edges[own + 1] else [own]


def described(rows: DataFrame, plans: list[Allocation | None], edges: list[int], words: int, similarity: tuple[int, int]) -> DataFrame:
    """``(row, doc_id, version, size, same, sketch, keys)`` of ``rows(row, doc_id, text,
    version)``: the set's size, its digest (null without words), its parities, and its keys
    with their bands, negative (-1 - band) for keys of threshold 1."""
    key = pa.struct([("key", pa.int64()), ("band", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in batches:
            size, same, sketch, found, kinds, ends = [], [], [], [], [], [0]
            for text in map(_bytes, batch.column("text")):
                h = np.unique(shingle_hashes(text, words))
                size.append(len(h))
                same.append(xxh3_128_digest(h.tobytes()) if len(h) else None)
                sketch.append(parity(h, most_differences(len(h), len(h), similarity)).tobytes())
                n = ends[-1]
                for band in bands_of(len(h), edges, similarity) if len(h) else ():
                    if plans[band] is None:
                        continue
                    for keys, kind in zip(set_keys(h, band, plans[band]), (band, -1 - band), strict=True):
                        found.append(keys.view(np.int64))
                        kinds.append(np.full(len(keys), kind, np.int32))
                        n += len(keys)
                ends.append(n)
            values = [pa.array(np.concatenate(x) if x else np.zeros(0, kind)) for x, kind in ((found, np.int64), (kinds, np.int32))]
            keys = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(values, fields=list(key)))
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), batch.column("version"), pa.array(size, pa.int64()), pa.array(same, pa.binary()), pa.array(sketch, pa.binary()), keys], ["row", "doc_id", "version", "size", "same", "sketch", "keys"])

    return rows.mapInArrow(run, "row long, doc_id long, version long, size long, same binary, sketch binary, keys array<struct<key:bigint,band:int>>")


def shared_keys(keyed: DataFrame, plans: list[Allocation | None]) -> DataFrame:
    """``(key, doc_id, size)``: the keys that several sets share, without the spare keys of
    each set, those that most sets share.  ``keyed(key, band, doc_id, size)``.

    Counts are partial sums, and a set's keys are ordered among themselves only."""
    many = cut(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "many")
    found = keyed.join(many, "key")
    if any(p and p.spare for p in plans):
        spare = F.element_at(F.array(*[F.lit(p.spare if p else 0) for p in plans]), F.col("band") + 1)
        place = F.row_number().over(Window.partitionBy("doc_id", "band").orderBy(F.desc("n"), "key"))
        exact = found.where("band >= 0").withColumn("place", place).where(F.col("place") > spare).drop("place")
        found = exact.unionByName(found.where("band < 0"))
    return found.select("key", "doc_id", "size").distinct()


def set_links(keyed: DataFrame, sketches: DataFrame, shingles: Callable[[DataFrame], DataFrame], similarity: tuple[int, int] = SIMILARITY, least_tile: int = LEAST_TILE) -> DataFrame:
    """Links ``(a, b)`` of sets of ``keyed(key, doc_id, size)`` that share a key and are
    alike, enough of them to reach whatever all such links reach.

    ``sketches(doc_id, size, sketch)`` has the sets' parities, ``shingles`` gives
    ``(doc_id, shingles)`` for a table of ids.  A set is first compared with the two sets
    of each of its keys that come first and last by a hash, mostly the same ones; then
    every pair of a key that those links leave apart is compared, tile by tile, so a group
    is bounded and no pair is lost.  Parities rule out most pairs before shingles travel."""
    fraction = similarity[0] / similarity[1]
    entry = F.struct(F.xxhash64("doc_id").alias("h"), F.col("doc_id").alias("leader"))
    keys = cut(keyed.groupBy("key").agg(F.array(F.min(entry), F.max(entry)).alias("l"), F.count("*").alias("n")).where("n > 1"), "keys")
    lead = keys.select("key", F.explode("l.leader").alias("leader"))
    pairs = keyed.join(lead, "key").where(F.col("doc_id") != F.col("leader"))
    pairs = pairs.select(F.least("leader", "doc_id").alias("leader"), F.greatest("leader", "doc_id").alias("doc_id")).distinct()
    of = lambda name: sketches.select(F.col("doc_id").alias(name), F.struct("size", "sketch").alias(f"of_{name}"))

    def plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("of_leader").to_pylist(), batch.column("of_doc_id").to_pylist(), strict=True):
                bits = [np.frombuffer(s["sketch"], np.uint64) for s in (x, y)]
                ((_, found),) = may_link(bits, np.array([x["size"], y["size"]]), np.array([0]), np.array([1]), similarity)
                keep.append(bool(found[0, 0]))
            yield batch.select(["leader", "doc_id"]).filter(pa.array(keep, pa.bool_()))

    pairs = cut(pairs.join(of("leader"), "leader").join(of("doc_id"), "doc_id").mapInArrow(plausible, "leader long, doc_id long"), "pairs")
    many = cut(keyed.join(keys.where("n > 3").select("key"), "key"), "many")  # of three sets the leaders' pairs are all
    wanted = pairs.select(F.col("leader").alias("doc_id")).unionByName(pairs.select("doc_id")).unionByName(many.select("doc_id")).distinct()
    known = cut(shingles(wanted), "shingles")
    side = lambda name: known.select(F.col("doc_id").alias(name), F.col("shingles").alias(f"of_{name}"))
    both = pairs.join(side("leader").hint("merge"), "leader").join(side("doc_id").hint("merge"), "doc_id")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(_lists(batch.column("of_leader")), _lists(batch.column("of_doc_id")), strict=True):
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(common >= fraction * (len(x) + len(y) - common) and common > 0)
            yield pa.RecordBatch.from_arrays([batch.column("leader"), batch.column("doc_id")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a group that may link with a row of another part (and tile)."""
        for group in _runs(batches):
            bits = [np.frombuffer(s, np.uint64) for s in group.column("sketch").to_pylist()]
            sizes, part, tile = (group.column(c).to_numpy() for c in ("size", "part", "tile"))
            split = int(np.argmax(tile != tile[0]))
            left, right = (np.arange(split), np.arange(split, len(bits))) if split else (np.arange(len(bits)),) * 2
            keep = np.zeros(len(bits), bool)
            for some, found in may_link(bits, sizes, left, right, similarity):
                found &= part[some][:, None] != part[right][None, :]
                keep[some] |= found.any(axis=1)
                keep[right] |= found.any(axis=0)
            if keep.any():
                yield from group.select(["grp", "tile", "doc_id"]).filter(pa.array(keep)).to_batches()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches):
            a, b = forest(alike(_lists(group.column("shingles")), group.column("tile").to_numpy(), fraction), group.column("doc_id").to_numpy())
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    led = cut(both.mapInArrow(verify, "a long, b long"), "led")
    parts = cut(known_parts(led), "parts")
    members = cut(many.join(parts, "doc_id", "left").select("key", "doc_id", "size", F.coalesce("part", "doc_id").alias("comp")), "members")
    of_part = sketches.join(parts, "doc_id", "left").select("doc_id", "size", "sketch", F.coalesce("part", "doc_id").alias("part"))
    near = band_groups(members, least_tile).join(of_part.hint("merge"), "doc_id").repartition("grp").sortWithinPartitions("grp", "tile")
    groups = cut(near.mapInArrow(sift, "grp string, tile string, doc_id long"), "groups")
    grown = groups.join(known.hint("merge"), "doc_id").repartition("grp").sortWithinPartitions("grp", "tile")
    return led.unionByName(grown.mapInArrow(compare, "a long, b long"))


def join(docs: DataFrame, words: int = WORDS, similarity: tuple[int, int] = SIMILARITY, plans: list[Allocation | None] | None = None, edges: list[int] | None = None, least_tile: int = LEAST_TILE) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row of ``docs(doc_id, text)``.

    Rows link when the Jaccard similarity of their distinct word shingles (of the whole
    sequence, where there are fewer words) is at least ``similarity``, a fraction;
    ``component_id`` is the smallest doc_id that links reach.  Null texts and texts without
    words have no shingles and no links.  Rows are told apart by themselves, not by their
    doc_id: rows that share one, or have none, link by their texts only; a component whose
    rows all lack an id has none.  Repeated rows each come back, other columns are ignored,
    an empty table gives none.  Sets are of 64-bit hashes.  ``plans`` and ``edges``
    (both or none) take the place of what the model chooses."""
    rows = with_defaults(docs, doc_id="long", text="string")
    version = F.xxhash64(F.coalesce("text", F.lit("")))
    if plans is None:
        sizes = F.greatest(F.lit(1), F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")) - (words - 1)).cast("long")
        logs = rows.select(sizes.alias("size")).groupBy(F.floor(F.log("size") / log(GROWTH) * 2).alias("k")).agg(F.count("*").alias("n"), F.sum("size").alias("size"), F.max("size").alias("most")).collect()  # two rows a band at most
        edges = band_edges(max([1, *(r.most for r in logs)]) + 1, similarity)
        counted: dict[int, tuple[int, float]] = {}
        for r in logs:
            k = bands_of(int(r["size"] / r.n), edges, similarity)[0]
            n, mean = counted.get(k, (0, 0.0))
            counted[k] = n + r.n, (n * mean + r["size"]) / (n + r.n)
        plans = allocate(counted, edges, similarity)
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", version.alias("version"))
    own = cut(described(numbered, plans, edges, words, similarity), "described")  # row numbers are written once
    full = own.where("same is not null")
    sets = cut(full.groupBy("same").agg(F.min(F.struct("row", "doc_id", "version", "size", "sketch", "keys")).alias("r"), F.min("doc_id").alias("low")).select("same", "low", "r.*"), "sets")
    keyed = sets.select(F.explode("keys").alias("k"), F.col("row").alias("doc_id"), "size").select("k.key", "k.band", "doc_id", "size")
    keyed = cut(shared_keys(keyed, plans), "shared")

    def shingles_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(shingle_hashes(t, words)).view(np.int64) for t in map(_bytes, batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, pa.list_(pa.int64()))], ["doc_id", "shingles"])

    id_ = F.coalesce("doc_id", F.lit(-(1 << 63)))
    texts = rows.select(id_.alias("id"), "text", version.alias("version"))

    def shingles(ids: DataFrame) -> DataFrame:
        wanted = sets.join(ids.withColumnRenamed("doc_id", "row"), "row", "left_semi").select("row", id_.alias("id"), "version")
        return texts.join(wanted, ["id", "version"]).dropDuplicates(["row"]).select("row", "text").mapInArrow(shingles_of, "doc_id long, shingles array<long>")

    found = components(set_links(keyed, sets.select(F.col("row").alias("doc_id"), "size", "sketch"), shingles, similarity, least_tile))
    reach = found.join(sets.select(F.col("row").alias("node"), "low"), "node")
    lows = reach.groupBy("root").agg(F.min("low").alias("least"))
    least = reach.join(lows, "root").select(F.col("node").alias("row"), "least")
    known = cut(sets.select("row", "same", "low").join(least, "row", "left").select("same", F.coalesce("least", "low").alias("component")), "components")
    out = own.select("doc_id", "size", "same").join(known, "same", "left")
    return out.select("doc_id", F.col("size").alias("n_shingles"), F.when(F.col("same").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"))


def op11_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Components of all documents by shingle sets at least 0.9 alike."""
    return join(spark.read.parquet(f"{sf_dir}/documents.parquet"))
