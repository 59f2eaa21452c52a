"""Source divergence audit: how the words of each source of a language differ.

Terms are first counted exactly and filtered by the documents that hold them.  The kept
terms of a language are dealt to shards, each a minimal perfect hash with its keys stored
by slot.  The shards are broadcast, as many at a time as a bound allows, and a second pass
over the texts increments one dense row of slots for each group; a word counts only where
the stored key is that very word.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut
from .textbytes import LOWER, Rolling, buffers, chunks, mix, word_spans

#: Documents of a language that a kept term is in, at least; rows of a group's report.
LEAST_DOCS, MOST_RANKS = 30, 50
#: What is added to every count, and what shares are a part of.
SMOOTHING, UNIT = 5, 1_000_000_000
#: Keys of a shard, about; keys of a bucket, about; sources of a tile of pairs, about.
SHARD_KEYS, BUCKET_KEYS, TILE_SOURCES = 4096, 4, 64
#: Bytes of shards that are broadcast at once, of dense rows that a task holds, and the
#: distinct terms that a task counts before it passes them on.
BROADCAST_BYTES, DENSE_BYTES, HELD_TERMS = 64 << 20, 256 << 20, 300_000

TERM = np.zeros(256, bool)
TERM[97:123] = TERM[128:] = True
_TERM = re.compile(rb"[a-z\x80-\xff]+")
_STEP = np.uint64(0x9E3779B97F4A7C15)


def hashes_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return Rolling(data).spans(starts, ends)


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def _buckets(h: np.ndarray, n: np.ndarray | int) -> np.ndarray:
    return (mix(h ^ _STEP) % np.asarray(n, np.uint64)).astype(np.int64)


def _place(h: np.ndarray, turn: np.ndarray | int, n: np.ndarray | int) -> np.ndarray:
    return (mix(h + (np.asarray(turn, np.uint64) + np.uint64(1)) * _STEP) % np.asarray(n, np.uint64)).astype(np.int64)


def perfect_hash(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(moves, slots)`` for n distinct or repeated hashes: a bucket's move says which of
    a row of hash functions sends all its keys to slots of their own; a bucket of one key
    names its slot (-1 - slot).  Of keys of equal hash only the first gets its place so;
    the others take the last slots, where only their stored keys find them."""
    _, first = np.unique(h, return_index=True)
    own = np.zeros(len(h), bool)
    own[first] = True
    n = len(first)
    slots = np.full(len(h), -1, np.int64)
    slots[~own] = np.arange(n, len(h))
    moves = np.zeros(max(1, -(-n // BUCKET_KEYS)), np.int32)
    keys = np.flatnonzero(own)
    bucket = _buckets(h[keys], len(moves))
    order = np.argsort(bucket, kind="stable")
    keys, edges = keys[order], np.searchsorted(bucket[order], np.arange(len(moves) + 1))
    free = np.ones(n, bool)
    for b in np.argsort(-np.diff(edges), kind="stable"):
        held = keys[edges[b] : edges[b + 1]]
        if len(held) < 2:
            break
        turn, width = 0, 16
        while True:
            at = _place(h[held][None, :], np.arange(turn, turn + width)[:, None], n)
            fits = free[at].all(axis=1)
            if len(held) > 1:
                fits &= (np.diff(np.sort(at, axis=1), axis=1) > 0).all(axis=1)
            if fits.any():
                k = int(np.argmax(fits))
                moves[b], slots[held] = turn + k, at[k]
                free[at[k]] = False
                break
            turn, width = turn + width, min(4 * width, 1024)
    left, k = np.flatnonzero(free), 0
    for b in np.flatnonzero(np.diff(edges) == 1):
        slots[keys[edges[b]]], moves[b] = left[k], -1 - left[k]
        k += 1
    return moves, slots


class Shards:
    """The shards of one language as numpy arrays, looked up for many words at once."""

    def __init__(self, rows: list[dict]):
        self.shards = rows[0]["shards"]
        self.index = np.full(self.shards, -1, np.int64)
        self.index[[r["shard"] for r in rows]] = np.arange(len(rows))
        self.shard = np.array([r["shard"] for r in rows], np.int64)
        self.n = np.array([len(r["terms"]) for r in rows], np.int64)
        self.placed = np.array([r["placed"] for r in rows], np.int64)
        self.base = np.append(0, np.cumsum(self.n))
        moves = [np.frombuffer(r["moves"], np.int32) for r in rows]
        self.buckets = np.array([len(m) for m in moves], np.int64)
        self.first = np.append(0, np.cumsum(self.buckets))[:-1]
        self.moves = np.concatenate(moves)
        terms = [t.encode() if isinstance(t, str) else t for r in rows for t in r["terms"]]
        self.keys = np.frombuffer(b"".join(terms), np.uint8)
        self.key_ends = np.cumsum([len(t) for t in terms])
        self.key_starts = np.append(0, self.key_ends)[:-1]
        # keys without a place of their own, of all shards: (keys of equal hash are very rare)
        self.rest = {terms[s]: int(s) for k in range(len(rows)) for s in range(self.base[k] + self.placed[k], self.base[k + 1])}

    @property
    def slots(self) -> int:
        return int(self.base[-1])

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, h: np.ndarray) -> np.ndarray:
        """The slot of each word among all of these shards, -1 for a word that is no key."""
        at = self.index[shard_of(h, self.shards)]
        some = np.flatnonzero(at >= 0)
        at, h = at[some], h[some]
        move = self.moves[self.first[at] + _buckets(h, self.buckets[at])].astype(np.int64)
        local = np.where(move < 0, -1 - move, _place(h, np.maximum(move, 0), self.placed[at]))
        slot = self.base[at] + local
        a, n = starts[some], ends[some] - starts[some]
        same = n == self.key_ends[slot] - self.key_starts[slot]
        same[same] = equal_spans(data, a[same], self.keys, self.key_starts[slot[same]], n[same])
        found = np.full(len(starts), -1, np.int64)
        found[some[same]] = slot[same]
        if self.rest:
            for k in some[~same].tolist():
                found[k] = self.rest.get(data[starts[k] : ends[k]].tobytes(), -1)
        return found


def equal_spans(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether spans of equal lengths (at least 1) of two byte arrays are equal."""
    if not len(n):
        return np.zeros(0, bool)
    first = np.append(0, np.cumsum(n))
    step = np.arange(first[-1]) - np.repeat(first[:-1], n)
    return np.logical_and.reduceat(a[np.repeat(a_at, n) + step] == b[np.repeat(b_at, n) + step], first[:-1])


def _text(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).view(pa.string())


def _source_rows(docs: DataFrame) -> DataFrame:
    """``(lang, source, text)`` with '' for null."""
    return docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def document_counts(rows: DataFrame, held: int = HELD_TERMS) -> DataFrame:
    """``(lang, term, docs)``: in how many texts of its language each term is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}

        def passed() -> Iterator[pa.RecordBatch]:
            for lang, found in counts.items():
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), _text(list(found)), pa.array(list(found.values()), pa.int64())], ["lang", "term", "docs"])
            counts.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                counts.setdefault(lang, Counter()).update(set(_TERM.findall(text.as_buffer().to_pybytes().lower())))
                if sum(map(len, counts.values())) > held:
                    yield from passed()
        yield from passed()

    return rows.select("lang", "text").mapInArrow(run, "lang string, term string, docs long").groupBy("lang", "term").agg(F.sum("docs").alias("docs"))


def perfect_shards(kept: DataFrame, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """``(lang, shard, shards, placed, moves, terms)`` of ``kept(lang, term)``: each shard's
    perfect hash, and its terms in the order of their slots."""
    sizes = kept.groupBy("lang").agg(F.ceil(F.count("*") / shard_keys).cast("int").alias("shards"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("term"))
            h = hashes_of(data, offsets[:-1], offsets[1:])
            shard = np.array([shard_of(x, n) for x, n in zip(h, batch.column("shards").to_pylist(), strict=True)], np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("shards"), pa.array(shard, pa.int32()), batch.column("term")], ["lang", "shards", "shard", "term"])

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("term").combine_chunks()
        data, offsets = buffers(table.column("term"))
        h = hashes_of(data, offsets[:-1], offsets[1:])
        moves, slots = perfect_hash(h)
        terms = table.column("term").take(pa.array(np.argsort(slots)))
        row = {"lang": table.column("lang")[0].as_py(), "shard": table.column("shard")[0].as_py(), "shards": table.column("shards")[0].as_py(), "placed": len(np.unique(h)), "moves": moves.tobytes(), "terms": terms.to_pylist()}
        return pa.Table.from_pylist([row], pa.schema([("lang", pa.string()), ("shard", pa.int32()), ("shards", pa.int32()), ("placed", pa.int32()), ("moves", pa.binary()), ("terms", pa.list_(pa.string()))]))

    dealt = kept.select("lang", "term").join(sizes, "lang").mapInArrow(number, "lang string, shards int, shard int, term string")
    return dealt.groupBy("lang", "shard").applyInArrow(build, "lang string, shard int, shards int, placed int, moves binary, terms array<string>")


def recount(rows: DataFrame, shards: DataFrame, most_bytes: int = BROADCAST_BYTES, dense_bytes: int = DENSE_BYTES) -> DataFrame:
    """``(lang, source, shard, slot, n)``: occurrences of each kept term in each group that
    has any.  ``shards`` is a written table of ``perfect_shards``.

    Shards are broadcast in rounds of at most ``most_bytes`` (one shard at least), and
    each round is a pass over the texts, so what is broadcast is bounded whatever the
    number of terms.  A task's dense rows are passed on before they exceed
    ``dense_bytes``; sums of what tasks pass on are the counts."""
    spark = rows.sparkSession
    weight = F.aggregate("terms", F.lit(0).cast("long"), lambda a, t: a + F.octet_length(t) + 24) + F.octet_length("moves")
    sized = shards.select("lang", "shard", weight.alias("bytes"))
    upto = F.sum("bytes").over(Window.partitionBy("part").orderBy("lang", "shard"))  # one row for thousands of terms
    rounds = cut(sized.withColumn("part", F.lit(0)).select("lang", "shard", F.floor(upto / most_bytes).alias("turn")), "rounds")
    parts = []
    for (turn,) in rounds.select("turn").distinct().orderBy("turn").collect():
        mine = shards.join(rounds.where(F.col("turn") == turn), ["lang", "shard"], "left_semi").toArrow().to_pylist()
        by_lang: dict[str, list[dict]] = {}
        for row in sorted(mine, key=lambda r: (r["lang"], r["shard"])):
            by_lang.setdefault(row["lang"], []).append(row)
        held = spark.sparkContext.broadcast({k: Shards(v) for k, v in by_lang.items()})  # its size is bounded by the round

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            known, dense = held.value, {}

            def passed() -> Iterator[pa.RecordBatch]:
                for (lang, source), counts in dense.items():
                    of, slot = known[lang], np.flatnonzero(counts)
                    at = np.searchsorted(of.base, slot, "right") - 1
                    cols = [pa.array([x] * len(slot), pa.string()) for x in (lang, source)]
                    yield pa.RecordBatch.from_arrays([*cols, pa.array(of.shard[at].astype(np.int32)), pa.array((slot - of.base[at]).astype(np.int32)), pa.array(counts[slot])], ["lang", "source", "shard", "slot", "n"])
                dense.clear()

            for batch in batches:
                groups = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True))
                data, offsets = buffers(batch.column("text"))
                for lo, hi in chunks(offsets):
                    part = LOWER[data[offsets[lo] : offsets[hi]]]
                    starts, ends, row = word_spans(part, offsets[lo : hi + 1] - offsets[lo], TERM)
                    h = hashes_of(part, starts, ends)
                    for group in set(groups[lo:hi]):
                        if group[0] not in known:
                            continue
                        of = known[group[0]]
                        mine = np.flatnonzero(np.array([g == group for g in groups[lo:hi]])[row]) if hi - lo > 1 else np.arange(len(row))
                        if not len(mine):
                            continue
                        if group not in dense:
                            if sum(x.nbytes for x in dense.values()) + 8 * of.slots > dense_bytes:
                                yield from passed()
                            dense[group] = np.zeros(of.slots, np.int64)
                        slot = of.find(part, starts[mine], ends[mine], h[mine])
                        np.add.at(dense[group], slot[slot >= 0], 1)
            yield from passed()

        parts.append(rows.mapInArrow(run, "lang string, source string, shard int, slot int, n long"))
    if not parts:
        return spark.createDataFrame([], "lang string, source string, shard int, slot int, n long")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.groupBy("lang", "source", "shard", "slot").agg(F.sum("n").alias("n"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (count + 5) / (total + 5 terms)), exact at any size."""
    return F.expr("1L") + F.call_function("div", (count + SMOOTHING).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(11,0)"), (total + SMOOTHING * terms).cast("decimal(20,0)"))


def pair_distances(counts: DataFrame, totals: DataFrame, widths: DataFrame, tile_sources: int = TILE_SOURCES) -> DataFrame:
    """``(lang, a, b, value)`` with a < b: the summed difference of the shares of every two
    sources of a language over all its kept terms.

    ``counts(lang, source, shard, slot, p)`` has the terms that occur; ``totals(lang,
    source, p0)`` every group with the share of a term that does not; ``widths(lang,
    shard, width)`` the terms of each shard.  Sources are dealt to tiles, and a task
    compares the rows of two tiles in one shard, so it is bounded in both directions."""
    tiles = totals.groupBy("lang").agg(F.ceil(F.count("*") / tile_sources).cast("int").alias("tiles"))
    tile = F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int")
    numbered = cut(totals.join(tiles, "lang").select("lang", "source", "p0", "tiles", tile.alias("tile")), "tiles")
    dealt = F.explode(F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda k: F.struct(F.least("tile", k).alias("lo"), F.greatest("tile", k).alias("hi")))).alias("g")
    empty = numbered.join(widths, "lang").select("lang", "source", "tile", "tiles", "shard", F.lit(-1).alias("slot"), F.col("p0").alias("p"), "width")
    full = counts.join(numbered.select("lang", "source", "tile", "tiles"), ["lang", "source"]).select("lang", "source", "tile", "tiles", "shard", "slot", "p", F.lit(0).alias("width"))
    rows = empty.unionByName(full).select("lang", "shard", "source", "tile", "slot", "p", "width", dealt).select("lang", "shard", "g.lo", "g.hi", "source", "tile", "slot", "p", "width")
    schema = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("value", pa.int64())])

    def compare(table: pa.Table) -> pa.Table:
        slot, p, tile = (table.column(c).to_numpy() for c in ("slot", "p", "tile"))
        names = table.column("source").combine_chunks().dictionary_encode()
        codes, names = names.indices.to_numpy(), names.dictionary.to_pylist()
        lang, lo, hi = (table.column(c)[0].as_py() for c in ("lang", "lo", "hi"))
        mark = slot < 0
        of_tile, first = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
        of_tile[codes[mark]], first[codes[mark]] = tile[mark], p[mark]
        dense = np.repeat(first[:, None], int(table.column("width").to_numpy().max()), axis=1)
        dense[codes[~mark], slot[~mark]] = p[~mark]
        a, b, value = [], [], []
        right = np.flatnonzero(of_tile == hi)
        for i in np.flatnonzero(of_tile == lo):
            others = right[right > i] if lo == hi else right
            for j, d in zip(others.tolist(), np.abs(dense[others] - dense[i]).sum(axis=1).tolist(), strict=True):
                x, y = sorted((names[i], names[j]))
                a.append(x)
                b.append(y)
                value.append(d)
        return pa.table([pa.array([lang] * len(a), pa.string()), pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(value, pa.int64())], schema=schema)

    found = rows.groupBy("lang", "shard", "lo", "hi").applyInArrow(compare, "lang string, a string, b string, value long")
    return found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, most_ranks: int = MOST_RANKS, shard_keys: int = SHARD_KEYS, most_bytes: int = BROADCAST_BYTES, dense_bytes: int = DENSE_BYTES, tile_sources: int = TILE_SOURCES) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` of ``docs(text, lang, source)``.

    Part ``pair`` has every other source of the language with the summed difference of
    shares; part ``term`` the ``most_ranks`` terms that the source uses most above its
    language.  Null text, lang and source are ''.  A group without terms, and every group
    of a language without kept terms, still has its pairs (value 0 in the latter); a lone
    source has none.  Repeated rows count each; ties go by the item's bytes; other columns
    are ignored; an empty table gives none."""
    rows = _source_rows(docs)
    groups = cut(rows.select("lang", "source").distinct(), "groups")
    kept = cut(document_counts(rows).where(F.col("docs") >= least_docs).select("lang", "term"), "kept")
    shards = cut(perfect_shards(kept, shard_keys), "shards")
    counts = cut(recount(rows, shards, most_bytes, dense_bytes), "counts")
    terms = shards.select("lang", "shard", F.posexplode("terms").alias("slot", "term"))
    widths = shards.select("lang", "shard", F.size("terms").alias("width"))
    sizes = widths.groupBy("lang").agg(F.sum("width").alias("v"))
    totals = groups.join(counts.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left").join(sizes, "lang")
    totals = cut(totals.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), "v"), "totals")
    whole = totals.groupBy("lang").agg(F.sum("total").alias("lang_total"))

    shares = counts.join(totals, ["lang", "source"]).select("lang", "source", "shard", "slot", share(F.col("n"), F.col("total"), F.col("v")).alias("p"))
    pairs = pair_distances(shares, totals.select("lang", "source", share(F.lit(0), F.col("total"), F.col("v")).alias("p0")), widths, tile_sources)
    none = groups.join(sizes, "lang", "left_anti")  # of languages without kept terms
    none = none.join(none.withColumnRenamed("source", "item"), "lang").where("source <> item").select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    pairs = pairs.selectExpr("lang", "a as source", "b as item", "value").unionByName(pairs.selectExpr("lang", "b as source", "a as item", "value")).unionByName(none)

    per_lang = counts.groupBy("lang", "shard", "slot").agg(F.sum("n").alias("n")).join(whole, "lang").join(sizes, "lang")
    per_lang = per_lang.join(terms, ["lang", "shard", "slot"]).select("lang", "shard", "slot", "term", share(F.col("n"), F.col("lang_total"), F.col("v")).alias("q"))
    above = shares.join(per_lang, ["lang", "shard", "slot"]).where("p > q").selectExpr("lang", "source", "term as item", "p - q as value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return ranked(pairs, "pair").unionByName(ranked(above, "term").where(F.col("rank") <= most_ranks))


def op12_source_divergence(spark, sf_dir: str) -> DataFrame:
    """How the words of each source differ, over all documents."""
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP12_SQL = rf"""
with d as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
w as (select r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
kept as (select lang, term from w group by 1, 2 having count(distinct r) >= {LEAST_DOCS}),
v as (select lang, count(*) as v from kept group by 1),
g as (select distinct lang, source from d),
c as (select g.lang, g.source, term, coalesce(n, 0) as n from g join kept using (lang) left join (select lang, source, term, count(*) as n from w group by 1, 2, 3) using (lang, source, term)),
p as (select c.*, 1 + ({UNIT}::hugeint * (n + {SMOOTHING})) // (sum(n) over (partition by lang, source) + {SMOOTHING} * v) as p from c join v using (lang)),
lc as (select lang, term, sum(n) as n from c group by 1, 2),
q as (select lc.*, 1 + ({UNIT}::hugeint * (n + {SMOOTHING})) // (sum(n) over (partition by lang) + {SMOOTHING} * v) as q from lc join v using (lang)),
pair as (select a.lang, a.source, b.source as item, coalesce(value, 0) as value from g a join g b on a.lang = b.lang and a.source <> b.source
left join (select x.lang, x.source, y.source as item, sum(abs(x.p - y.p)) as value from p x join p y on x.lang = y.lang and x.term = y.term and x.source <> y.source group by 1, 2, 3) s on s.lang = a.lang and s.source = a.source and s.item = b.source),
term as (select p.lang, source, term as item, p - q as value from p join q using (lang, term) where p.n > 0 and p > q),
ranked as (select lang, source, 'pair' as part, item, value, row_number() over (partition by lang, source order by value desc, item) as rank from pair
union all select lang, source, 'term' as part, item, value, row_number() over (partition by lang, source order by value desc, item) as rank from term)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as int) as rank from ranked where part = 'pair' or rank <= {MOST_RANKS}
"""
