"""SimHash near-duplicates: exact links within a Hamming radius, found tile by tile.

Fingerprints that differ in at most ``radius`` bits agree on one of ``radius + 1`` blocks
of bits (pigeonhole), so only fingerprints that share a block are dealt to one tile.
Within tiles numpy compares pairs by exclusive-or and bit counts; rows and tiles whose
population counts differ beyond the radius are skipped.  Large blocks are split into
many tiles and every pair of their tiles is a group of its own, so a group is bounded
and no pair is lost.  Only spanning links leave a tile, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import components, cut, with_defaults

SHINGLE_WORDS = 3
RADIUS = 2
#: Fingerprints of a tile: at least this many, about the root of a large block's size, and
#: at most this many, so two tiles and their comparison fit in memory whatever the block.
LEAST_TILE, MOST_TILE = 128, 4096
#: Fingerprints that are compared at once: rows of the tile with the rest of it.
AT_ONCE = 256


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of one text (UTF-8): bit set if set in over half the shingle hashes."""
    return fingerprint_of(shingle_hashes(text, words))


def fingerprint_of(h: np.ndarray) -> int:
    if not len(h):
        return 0
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int.from_bytes(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(h), bitorder="little").tobytes(), "little")


def shingle_hashes(text: bytes, words: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 (seed 42) of each run of ``words`` words, repeats included; of the whole
    sequence where there are fewer words; none where there are no words.

    Words are separated by ASCII white space; A-Z count as lower case.
    """
    return word_shingles(text.lower().split(), words)  # of bytes: ASCII letters and ASCII white space only


def word_shingles(found: list[bytes], words: int) -> np.ndarray:
    from xxhash import xxh64_intdigest

    if not found:
        return np.zeros(0, np.uint64)
    runs = zip(*(found[k:] for k in range(words)), strict=False) if len(found) >= words else [found]
    join = b" ".join
    return np.array([xxh64_intdigest(join(run), 42) for run in runs], np.uint64)


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, fp)`` of every row; ``fp`` is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t, words) for t in map(_bytes, batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.array(fps, np.uint64).view(np.int64))], ["doc_id", "fp"])

    return with_defaults(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, fp long")


def _bytes(value: pa.Scalar) -> bytes:
    return value.as_buffer().to_pybytes() if value.is_valid else b""


def block_bounds(radius: int) -> list[tuple[int, int]]:
    """(first bit, bits) of ``radius + 1`` blocks that cover all 64 bits."""
    edges = [64 * k // (radius + 1) for k in range(radius + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def tile_groups(fps: DataFrame, radius: int = RADIUS, least_tile: int = LEAST_TILE) -> DataFrame:
    """``(grp, tile, fp)``: every pair of distinct fingerprints within the radius shares a
    group.  A group has the rows of one tile, or of two tiles of one block."""
    blocks = F.explode(F.array(*[F.struct(F.lit(k).alias("no"), F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << n) - 1)).alias("bits")) for k, (a, n) in enumerate(block_bounds(radius))]))
    dealt = fps.select("fp", F.bit_count("fp").cast("int").alias("pop"), blocks.alias("x")).select("fp", "pop", F.col("x.no").alias("no"), F.col("x.bits").alias("bits"))
    counts = dealt.groupBy("no", "bits", "pop").count()
    per_block = counts.groupBy("no", "bits").agg(F.sum("count").alias("n"), F.map_from_entries(F.collect_list(F.struct("pop", "count"))).alias("pops")).where("n > 1")
    per_block = cut(per_block, "blocks")  # one row for each shared block, at most 65 entries in its map
    side = F.least(F.lit(MOST_TILE), F.greatest(F.lit(least_tile), F.ceil(2 * F.sqrt("n")))).cast("int")
    rows = dealt.join(per_block, ["no", "bits"]).withColumn("side", side)
    block = F.concat_ws(":", "no", "bits")
    small = rows.where("n <= side").select(block.alias("grp"), F.lit("0").alias("tile"), "fp")
    # large blocks: tile = (population count, salt); groups = pairs of tiles not too far apart
    tiles_of = lambda pop: F.ceil(F.coalesce(F.element_at("pops", pop), F.lit(0)) / F.col("side")).cast("int")
    large = rows.where("n > side").withColumn("salt", F.pmod(F.xxhash64("fp", F.lit("tile")), tiles_of(F.col("pop"))).cast("int"))
    own = F.format_string("%03d/%08d", F.col("pop"), F.col("salt"))
    near = F.filter(F.sequence(F.col("pop") - radius, F.col("pop") + radius), lambda p: tiles_of(p) > 0)
    others = F.flatten(F.transform(near, lambda p: F.transform(F.sequence(F.lit(0), tiles_of(p) - 1), lambda s: F.format_string("%03d/%08d", p, s))))
    large = large.select(block.alias("block"), own.alias("tile"), "fp", F.explode(others).alias("other"))
    large = large.select(F.concat_ws(":", "block", F.least("tile", "other"), F.greatest("tile", "other")).alias("grp"), "tile", "fp")
    return small.unionByName(large)


def links(groups: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Spanning links ``(a, b)`` among the fingerprints of each group."""
    grown = groups.repartition("grp").sortWithinPartitions("grp", "tile")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches):
            a, b = spanning(group.column("fp").to_numpy().view(np.uint64), group.column("tile").to_numpy(), radius)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return grown.mapInArrow(run, "a long, b long")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each group of a partition sorted by group."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        grp = batch.column("grp").dictionary_encode()
        codes = grp.indices.to_numpy()
        edges = np.flatnonzero(np.diff(codes)) + 1
        if held and held[-1].column("grp")[0].as_py() != grp[0].as_py():
            yield _group(held)
            held = []
        at = [0, *edges.tolist(), batch.num_rows]
        for lo, hi in zip(at, at[1:], strict=False):
            if lo:
                yield _group(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield _group(held)


def _group(held: list[pa.RecordBatch]) -> pa.Table:
    return pa.Table.from_batches(held).combine_chunks()


def spanning(fps: np.ndarray, tiles: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within one tile or between two tiles.

    Rows are put in order of their population counts and compared a few at a time, with
    the others of near counts only."""
    split = int(np.argmax(tiles != tiles[0]))  # 0: all of one tile
    pops = np.bitwise_count(fps).astype(np.int64)
    left = np.arange(split) if split else np.arange(len(fps))
    right = np.arange(split, len(fps)) if split else left
    left, right = left[np.argsort(pops[left], kind="stable")], right[np.argsort(pops[right], kind="stable")]
    heads, tails = [], []
    for lo in range(0, len(left), AT_ONCE):
        rows = left[lo : lo + AT_ONCE]
        i, j = np.searchsorted(pops[right], [pops[rows[0]] - radius, pops[rows[-1]] + radius + 1])
        if i == j:
            continue
        a, b = np.nonzero(np.bitwise_count(fps[rows][:, None] ^ fps[right[i:j]][None, :]) <= radius)
        a, b = rows[a], right[i:j][b]
        heads.append(a[a != b])
        tails.append(b[a != b])
    if not heads:
        return fps[:0], fps[:0]
    return spanning_forest(np.concatenate(heads), np.concatenate(tails), fps)


def spanning_forest(a: np.ndarray, b: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links ``(smallest place, place)`` of each component of the links between places."""
    label = np.arange(len(nodes))
    while True:  # each round a place takes the least label around it, then its label's label
        low = label.copy()
        np.minimum.at(low, a, label[b])
        np.minimum.at(low, b, label[a])
        low = low[low]
        if (low == label).all():
            break
        label = low
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[label[moved]], nodes[moved]


def forest(near: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of a symmetric matrix of links between nodes."""
    seen, a, b = np.zeros(len(nodes), bool), [], []
    for root in np.flatnonzero(near.sum(axis=1) > near.diagonal()):
        if seen[root]:
            continue
        seen[root] = True
        front = np.array([root])
        while len(front):
            front = np.flatnonzero(near[front].any(axis=0) & ~seen)
            seen[front] = True
            a.append(np.full(len(front), nodes[root]))
            b.append(nodes[front])
    return (np.concatenate(a), np.concatenate(b)) if a else (nodes[:0], nodes[:0])


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` of every row of ``docs(doc_id, text)``.

    Rows whose fingerprints differ in at most ``radius`` bits are linked;
    ``component_id`` is the smallest doc_id that links reach, the row's own included.
    Texts without words (null, empty, white space) have fingerprint zero and link like any
    other.  Repeated rows each come back; other columns are ignored; an empty table gives
    none.  Equal fingerprints meet in one row by a partial minimum, so copies cost no pairs.
    """
    own = cut(fingerprints(docs, words), "fingerprints")
    first = own.groupBy("fp").agg(F.min("doc_id").alias("first"))
    first = cut(first, "first")
    found = components(links(tile_groups(first.select("fp"), radius), radius))
    reach = found.join(first.withColumnRenamed("fp", "node"), "node")
    root = reach.groupBy("root").agg(F.min("first").alias("low"))
    known = reach.join(root, "root").selectExpr("node as fp", "low")
    known = cut(first.join(known, "fp", "left").select("fp", F.coalesce("low", "first").alias("component_id")), "known")
    return own.join(known, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_simhash(spark, sf_dir: str) -> DataFrame:
    """SimHash components of all documents."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


# --- near copies by word shingles -------------------------------------------------------

COPY_WORDS = 5
SIMILARITY = 0.8
#: MinHash bands of two rows: at the similarity above all are missed with 4e-5.
BANDS = 10
#: Shingles that a tile of a large band may hold, about: 8 bytes each; sets that it may hold
#: at least, since parities make comparing cheap and each tile that a set meets sends it again.
TILE_SHINGLES, TILE_SETS = 1 << 21, 1024
#: Words of 64 bits of a set's parities; sets that are held against all others at once.
PARITY_WORDS, SETS_AT_ONCE = 16, 128


def shingle_set(text: bytes, words: int = COPY_WORDS) -> set[bytes]:
    found = text.lower().split()
    if len(found) < words:
        return {b" ".join(found)} if found else set()
    return {b" ".join(run) for run in zip(*(found[k:] for k in range(words)), strict=False)}


def signatures(docs: DataFrame, words: int = COPY_WORDS, bands: int = BANDS, fp_words: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, version, fp, same, size, keys)`` of every row, in one look at its text: a
    hash of the text, the SimHash fingerprint, a digest of its distinct shingles (null
    without words), their number, and the band keys.  Rows that share a doc_id are one
    document, the row whose text has the smallest hash."""
    seeds = np.random.default_rng(11).integers(1, 1 << 63, 2 * bands, dtype=np.uint64) | np.uint64(1)
    salt = np.arange(bands, dtype=np.uint64) << np.uint64(56)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in batches:
            fps, same, size, keys = [], [], [], []
            for text in map(_bytes, batch.column("text")):
                found = text.lower().split()
                fps.append(fingerprint_of(word_shingles(found, fp_words)))
                h = np.unique(word_shingles(found, words))
                size.append(len(h))
                if not len(h):
                    same.append(None)
                    keys.append([])
                    continue
                same.append(xxh3_128_digest(h.tobytes()))
                lows = np.array([(h * s ^ (h >> np.uint64(29)) * s).min() for s in seeds]).reshape(bands, 2)
                keys.append((((lows[:, 0] * np.uint64(0x9E3779B97F4A7C15)) ^ lows[:, 1]) ^ salt).view(np.int64))
            columns = [batch.column("doc_id"), batch.column("version"), pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(same, pa.binary()), pa.array(size, pa.int64()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "version", "fp", "same", "size", "keys"])

    rows = versions(docs).mapInArrow(run, "doc_id long, version long, fp long, same binary, size long, keys array<long>")
    return rows.groupBy("doc_id").agg(F.min_by(F.struct("version", "fp", "same", "size", "keys"), "version").alias("r")).select("doc_id", "r.*")


def versions(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, version)``: a null doc_id is the smallest long, so it has a place."""
    rows = with_defaults(docs, doc_id="long", text="string")
    return rows.select(node().alias("doc_id"), "text", version().alias("version"))


def node() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))


def version() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def shingles(texts: DataFrame, words: int = COPY_WORDS) -> DataFrame:
    """``(doc_id, shingles)``: the sorted distinct shingle hashes of ``texts(doc_id, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(shingle_hashes(t, words)).view(np.int64) for t in map(_bytes, batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(pa.int64()))], ["doc_id", "shingles"])

    return texts.select("doc_id", "text").mapInArrow(run, "doc_id long, shingles array<long>")


def _lists(column: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    at, values = column.offsets.to_numpy(), column.values.to_numpy()
    return [values[lo:hi] for lo, hi in zip(at, at[1:], strict=False)]


def shared_counts(sets: list[np.ndarray], split: int, most: int = 1 << 22) -> np.ndarray:
    """Elements that each of the first ``split`` sets shares with each of the others; of
    all sets with each other where ``split`` is 0."""
    left, right = (slice(None), slice(None)) if not split else (slice(split), slice(split, None))
    sizes = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # an element of one set only is shared with none; the own counts are the sizes
    column, owner = (np.cumsum(times > 1) - 1)[column][times[column] > 1], owner[times[column] > 1]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    total = np.zeros((len(sets), len(sets)), np.int64)[left, right]
    step = max(256, most // len(sets))
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        i, j = np.searchsorted(column, [lo, lo + step])
        block = np.zeros((len(sets), step), np.float32)
        block[owner[i:j], column[i:j] - lo] = 1
        total += (block[left] @ block[right].T).astype(np.int64)
    if not split:
        np.fill_diagonal(total, sizes)
    return total


def alike(sets: list[np.ndarray], tiles: np.ndarray, similarity: float) -> np.ndarray:
    """Which pairs of sets have this Jaccard similarity; of two tiles only pairs across."""
    split = int(np.argmax(tiles != tiles[0]))
    sizes = np.array([len(x) for x in sets])
    shared = shared_counts(sets, split)
    if not split:
        return (shared >= similarity * (sizes[:, None] + sizes[None, :] - shared)) & (shared > 0)
    near = np.zeros((len(sets), len(sets)), bool)
    near[:split, split:] = (shared >= similarity * (sizes[:split, None] + sizes[None, split:] - shared)) & (shared > 0)
    return near | near.T


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """Of each set, in how many elements each value of the last ten bits comes, as odd or
    even: two sets differ in at least as many elements as their parities differ in bits."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    place = (np.concatenate(sets).view(np.uint64) % np.uint64(64 * PARITY_WORDS)).astype(np.int64)
    odd = np.bincount(owner * (64 * PARITY_WORDS) + place, minlength=len(sets) * 64 * PARITY_WORDS) % 2
    return np.packbits(odd.astype(bool)).view(np.uint64).reshape(len(sets), PARITY_WORDS)


def set_links(sets: list[np.ndarray], tiles: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Links between places of sets that have this Jaccard similarity, enough of them to
    reach what all reach; of two tiles only links across.

    Pairs whose parities or sizes rule it out are not counted, nor are pairs that links
    already reach; what is left is counted exactly."""
    split = int(np.argmax(tiles != tiles[0]))  # 0: all of one tile
    sizes, odd = np.array([len(x) for x in sets]), parities(sets)
    label, heads, tails = np.arange(len(sets)), [], []
    for lo in range(0, split or len(sets), SETS_AT_ONCE):
        rows, cols = np.arange(lo, min(lo + SETS_AT_ONCE, split or len(sets))), np.arange(split or lo, len(sets))
        apart = np.zeros((len(rows), len(cols)), np.int64)
        for word in odd.T:
            apart += np.bitwise_count(word[rows, None] ^ word[None, cols])
        both = sizes[rows, None] + sizes[None, cols]
        apart = np.maximum(apart, np.abs(sizes[rows, None] - sizes[None, cols]))
        # shared = (both - apart) / 2 at most; a little more passes than rounding could lose
        may = (both - apart) * (1 + similarity) >= 2 * similarity * both - 1e-6
        may &= (label[rows, None] != label[None, cols]) & (rows[:, None] < cols[None, :])
        if not may.any():
            continue
        i, j = rows[may.any(axis=1)], cols[may.any(axis=0)]
        shared = shared_counts([sets[k] for k in (*i, *j)], len(i))
        total = sizes[i, None] + sizes[None, j] - shared
        near = (shared >= similarity * total) & (shared > 0) & (i[:, None] < j[None, :])
        for a, row in zip(i, near, strict=True):
            for b in j[row & (label[j] != label[a])]:
                if label[a] != label[b]:
                    label[label == label[b]] = label[a]
                    heads.append(a)
                    tails.append(b)
    return np.array(heads, np.int64), np.array(tails, np.int64)


def band_groups(members: DataFrame, least_tile: int = LEAST_TILE, most_shingles: int = TILE_SHINGLES) -> DataFrame:
    """``(grp, tile, doc_id)`` of ``members(key, doc_id, size, comp)``: every two of a key
    share a group unless both are known to be of one component.

    The key's largest component has tiles of its own, which meet only the other tiles.  A
    row goes along once for each tile that its own meets, so tiles are as large as leaves
    enough of them to share the work, and at most what a task can hold."""
    per = members.groupBy("key", "comp").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    keys = per.groupBy("key").agg(
        F.max_by("comp", F.struct("n", "comp")).alias("most"), F.max("n").alias("n_most"), F.max_by("size", F.struct("n", "comp")).alias("size_most"),
        F.sum("n").alias("n"), F.sum("size").alias("all_size"), F.count("*").alias("comps"),
    )
    rows = members.join(cut(keys.where("comps > 1"), "bands"), "key").withColumn("side", F.least(F.lit(MOST_TILE), F.greatest(F.lit(least_tile), F.ceil(4 * F.sqrt("n")))))
    small = (F.col("n") <= F.col("side")) & (F.col("all_size") <= most_shingles)
    tiles_of = lambda n, size: F.ceil(F.greatest(n / F.col("side"), size / most_shingles)).cast("int")
    rows = rows.withColumn("p", tiles_of(F.col("n_most"), F.col("size_most"))).withColumn("q", tiles_of(F.col("n") - F.col("n_most"), F.col("all_size") - F.col("size_most")))
    whole = rows.where(small).select(F.col("key").cast("string").alias("grp"), F.lit("0").alias("tile"), "doc_id")
    large = rows.where(~small).withColumn("main", F.col("comp") == F.col("most"))
    name = lambda kind, salt: F.format_string("%s%08d", F.lit(kind), salt)
    salt = lambda n: F.pmod(F.xxhash64("doc_id", F.lit("tile")), F.col(n)).cast("int")
    names = lambda kind, n: F.transform(F.sequence(F.lit(0), F.col(n) - 1), lambda k: name(kind, k))
    own = F.when(F.col("main"), name("m", salt("p"))).otherwise(name("a", salt("q")))
    others = F.when(F.col("main"), names("a", "q")).otherwise(F.concat(names("a", "q"), names("m", "p")))
    large = large.select("key", "doc_id", own.alias("tile"), F.explode(others).alias("other"))
    return whole.unionByName(large.select(F.concat_ws(":", F.col("key").cast("string"), F.least("tile", "other"), F.greatest("tile", "other")).alias("grp"), "tile", "doc_id"))


def near_copies(docs: DataFrame, among: DataFrame | None = None, words: int = COPY_WORDS, similarity: float = SIMILARITY, least_tile: int = TILE_SETS) -> DataFrame:
    """``(doc_id, class_id)`` of documents whose word shingles are a copy's, by Jaccard
    similarity; only rows of classes of two or more come back.

    ``docs(doc_id, text)``; ``among(doc_id)`` says which of them to compare, all where it
    is not given.  Documents with equal shingles count as one, texts without words have no
    copies, and rows without a doc_id are left out.  Every pair of a band is compared
    (``copy_links``); comparisons are exact, on 64-bit hashes of the shingles.
    """
    own = signatures(docs, words)
    if among is not None:
        own = own.join(among.select("doc_id").distinct(), "doc_id", "left_semi")
    own = cut(own.where(F.col("doc_id") > -(1 << 63)), "signatures")
    found = components(same_links(own, "same").unionByName(copy_links(docs, own, words, similarity, least_tile)))
    low = found.groupBy("root").agg(F.min("node").alias("class_id"))
    return found.join(low, "root").select(F.col("node").alias("doc_id"), "class_id")


def same_links(own: DataFrame, key: str) -> DataFrame:
    """Links of rows of equal ``key`` to the smallest of them, by a partial minimum."""
    first = own.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("doc_id").alias("a"))
    return own.join(first, key).where("a <> doc_id").selectExpr("a", "doc_id as b")


def fingerprint_links(own: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links of documents whose fingerprints differ in at most ``radius`` bits, enough of
    them to reach whatever all links reach."""
    first = cut(own.groupBy("fp").agg(F.min("doc_id").alias("first")), "first")
    found = links(tile_groups(first.select("fp"), radius), radius)
    side = lambda fp, name: first.select(F.col("fp").alias(fp), F.col("first").alias(name))
    near = found.select(F.col("a").alias("fa"), F.col("b").alias("fb")).join(side("fa", "a"), "fa").join(side("fb", "b"), "fb").select("a", "b")
    return near.unionByName(same_links(own, "fp"))


def copy_links(docs: DataFrame, own: DataFrame, words: int = COPY_WORDS, similarity: float = SIMILARITY, least_tile: int = TILE_SETS) -> DataFrame:
    """Links ``(a, b)`` of documents of ``own`` (``signatures``, written) that share a band
    and are alike, enough of them to reach whatever all such links reach.

    Each set of shingles is first compared with two leaders of each of its bands, chosen
    by a hash that differs from band to band.  Then every pair of a band that those links
    leave apart is compared, tile by tile, so a group is bounded and no pair is lost."""
    sets = cut(own.where("same is not null").groupBy("same").agg(F.min(F.struct("doc_id", "version", "size", "keys")).alias("r")).select("r.*"), "sets")
    keyed = sets.select(F.explode("keys").alias("key"), "doc_id", "size")
    entry = F.struct(F.xxhash64("doc_id", "key").alias("h"), F.col("doc_id").alias("leader"))
    bands = cut(keyed.groupBy("key").agg(F.array(F.min(entry), F.max(entry)).alias("l"), F.count("*").alias("n")).where("n > 1"), "shared")
    lead = bands.select("key", F.explode("l.leader").alias("leader"))
    pairs = keyed.join(lead, "key").where(F.col("doc_id") != F.col("leader"))
    pairs = cut(pairs.select(F.least("leader", "doc_id").alias("leader"), F.greatest("leader", "doc_id").alias("doc_id")).distinct(), "pairs")
    wanted = pairs.select(F.col("leader").alias("doc_id")).unionByName(pairs.select("doc_id")).distinct()
    wanted = sets.select("doc_id", "version").join(wanted, "doc_id", "left_semi")
    # ids and shingles grow with the input, so these joins never broadcast, at any size
    texts = versions(docs).join(wanted.hint("merge"), ["doc_id", "version"], "left_semi").dropDuplicates(["doc_id", "version"])
    known = cut(shingles(texts, words), "shingles")
    side = lambda name: known.select(F.col("doc_id").alias(name), F.col("shingles").alias(f"of_{name}"))
    both = pairs.join(side("leader").hint("merge"), "leader").join(side("doc_id").hint("merge"), "doc_id")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(_lists(batch.column("of_leader")), _lists(batch.column("of_doc_id")), strict=True):
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(shared >= similarity * (len(x) + len(y) - shared) and shared > 0)
            yield pa.RecordBatch.from_arrays([batch.column("leader"), batch.column("doc_id")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches):
            a, b = set_links(_lists(group.column("shingles")), group.column("tile").to_numpy(), similarity)
            if len(a):
                ids = group.column("doc_id").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], ["a", "b"])

    led = cut(both.mapInArrow(verify, "a long, b long"), "led")
    # of up to three documents the leaders' comparisons are all
    members = keyed.join(bands.where("n > 3").select("key"), "key").join(known_parts(led), "doc_id", "left")
    members = cut(members.select("key", "doc_id", "size", F.coalesce("part", "doc_id").alias("comp")), "members")
    groups = cut(band_groups(members, least_tile), "groups")
    grown = groups.join(known.hint("merge"), "doc_id").repartition("grp").sortWithinPartitions("grp", "tile")
    return led.unionByName(grown.mapInArrow(compare, "a long, b long"))


def known_parts(edges: DataFrame, rounds: int = 3) -> DataFrame:
    """``(doc_id, part)``: documents of one part are linked.  The least id travels a few
    links far, which joins most of a group whose leaders know each other; documents of
    several parts may be linked as well, so they are compared."""
    both = edges.selectExpr("a as doc_id", "b as other").unionByName(edges.selectExpr("b as doc_id", "a as other"))
    part = both.groupBy("doc_id").agg(F.least(F.min("other"), F.col("doc_id")).alias("part"))
    for _ in range(rounds - 1):
        near = both.join(part.withColumnRenamed("doc_id", "other"), "other").select("doc_id", "part")
        part = near.unionByName(part).groupBy("doc_id").agg(F.min("part").alias("part"))
    return part


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest doc_id.

    A group is all that links of near equal fingerprints and links of five-word shingles
    at least 0.8 alike reach together; texts without words are one group, since their
    fingerprints are equal.  Rows are told apart by a number that is written once, not by
    their doc_id: unlike texts that share an id, or have none, all stay, and repeated rows
    are copies.  A null doc_id counts as the smallest; of equal ids the first row counts.
    Other columns pass through; an empty table gives none."""
    numbered = cut(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("whole")), "numbered")
    named = numbered.select(F.col("row").alias("doc_id"), F.col("whole.text").alias("text"))
    own = cut(signatures(named), "signatures")
    found = components(fingerprint_links(own).unionByName(same_links(own, "same")).unionByName(copy_links(named, own)))
    ids = numbered.select(F.col("row").alias("node"), F.coalesce(F.col("whole.doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"))
    low = found.join(ids, "node").groupBy("root").agg(F.min(F.struct("id", "node")).alias("low"))
    later = found.join(low, "root").where("node <> low.node").select(F.col("node").alias("row"))
    return numbered.join(later.hint("merge"), "row", "left_anti").select("whole.*")  # it grows with the input, so it is never broadcast
