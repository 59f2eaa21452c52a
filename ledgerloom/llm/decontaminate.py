"""Benchmark decontamination: windows of benchmark words, broadcast as a hash set, are
looked up in every window of the documents; hits are verified word by word."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import carried, cut, passed_on, with_defaults
from .textbytes import LOWER, Rolling, buffers, chunks, one_row_windows, word_spans

WINDOW_WORDS = 13
#: A window set of at most this many bytes, as built, is broadcast; a larger one is joined.
#: Bytes that a word takes in it.
BROADCAST_BYTES, WORD_BYTES = 128 << 20, 48
#: Hit words of a contaminated document: at least one in this many.
SHARE = 20


class WindowSet:
    """The windows of all benchmark items as sorted hashes, each with the places where it
    occurs, and the items' words, by which a hit is proved.  All are numpy arrays, about
    ``WORD_BYTES`` a word, so they are built once and broadcast as they are."""

    def __init__(self, items: list[tuple[int, str | None]], window: int = WINDOW_WORDS):
        data, offsets = buffers(pa.array([t for _, t in items], pa.string()))
        self.data = LOWER[data]
        starts, ends, rows, hashes = hashed_words(self.data, offsets)
        self.starts, self.ends, self.rows = starts.astype(np.int32), ends.astype(np.int32), rows.astype(np.int32)
        self.ids = np.array([k for k, _ in items], np.int64)
        self.windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for n, at, h in item_windows(hashes, rows, len(items), window):
            order = np.argsort(h, kind="stable")
            hashes, first = np.unique(h[order], return_index=True)
            self.windows[n] = hashes, np.append(first, len(h)).astype(np.int32), at[order].astype(np.int32)
        self.known: dict[tuple[int, int], dict[bytes, tuple[int, ...]]] = {}

    def maybe(self, n: int) -> np.ndarray:
        """Whether any window of n words has a hash that begins with these 20 bits."""
        if ("maybe", n) not in self.known:
            bits = np.zeros(1 << 20, bool)
            bits[self.windows[n][0] >> np.uint64(44)] = True
            self.known["maybe", n] = bits
        return self.known["maybe", n]

    def items_of(self, n: int, place: int, words: bytes) -> tuple[int, ...]:
        """The items with a window of these very words, whose hash has this place.

        What a hash stands for is worked out at its first hit and remembered."""
        found = self.known.get((n, place))
        if found is None:
            _, edges, at = self.windows[n]
            texts: dict[bytes, set[int]] = {}
            for k in at[edges[place] : edges[place + 1]].tolist():
                texts.setdefault(joined(self.data, self.starts, self.ends, k, n), set()).add(int(self.ids[self.rows[k]]))
            found = self.known[n, place] = {t: tuple(sorted(x)) for t, x in texts.items()}
        return found.get(words, ())

    def hits(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, tuple[int, ...]]], tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Words and hit words of each row, and the verified (first word, words, items)."""
        data = LOWER[data]
        starts, ends, rows = word_spans(data, offsets)
        found: list[tuple[int, int, tuple[int, ...]]] = []
        if len(starts) and self.windows:
            roll = Rolling(Rolling(data).spans(starts, ends))
            for n, (hashes, _, _) in self.windows.items():
                at = one_row_windows(rows, n)
                h = roll.spans(at, at + n)
                keep = self.maybe(n)[h >> np.uint64(44)]
                at, h = at[keep], h[keep]
                place = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                same = hashes[place] == h
                for k, at_hash in zip(at[same].tolist(), place[same].tolist(), strict=True):
                    items = self.items_of(n, at_hash, joined(data, starts, ends, k, n))
                    if items:
                        found.append((k, n, items))
        return np.bincount(rows, minlength=len(offsets) - 1), hit_words(found, rows, len(offsets) - 1), found, (starts, ends, rows)


def hashed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, row and hash of every word, worked out a stretch of rows at a time."""
    parts = []
    for lo, hi in chunks(offsets):
        part = data[offsets[lo] : offsets[hi]]
        starts, ends, rows = word_spans(part, offsets[lo : hi + 1] - offsets[lo])
        parts.append((starts + offsets[lo], ends + offsets[lo], rows + lo, Rolling(part).spans(starts, ends)))
    none = [(np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)]
    return tuple(np.concatenate(c) for c in zip(*(parts or none), strict=True))


def item_windows(words: np.ndarray, rows: np.ndarray, n_items: int, window: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words, first words, hashes) of the windows of items, by their number of words."""
    if not len(words):
        return
    roll = Rolling(words)
    edges = np.searchsorted(rows, np.arange(n_items + 1))
    counts = np.diff(edges)
    for n in np.unique(np.minimum(counts[counts > 0], window)).tolist():
        at = one_row_windows(rows, n) if n == window else edges[:-1][counts == n]
        yield n, at, roll.spans(at, at + n)


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: int, n: int) -> bytes:
    return b" ".join(data[s:e].tobytes() for s, e in zip(starts[first : first + n].tolist(), ends[first : first + n].tolist(), strict=True))


def hit_words(found: list, rows: np.ndarray, n_rows: int) -> np.ndarray:
    """Of each row the words that lie in any found window."""
    step = np.zeros(len(rows) + 1, np.int64)
    for k, n, *_ in found:
        step[k] += 1
        step[k + n] -= 1
    return np.bincount(rows[np.cumsum(step[:-1]) > 0], minlength=n_rows)


def hit_spans(found: list, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, edges: np.ndarray) -> dict[int, list[dict]]:
    """By row, the found windows merged to runs, as byte offsets in the row's text."""
    spans_of: dict[int, list[dict]] = {}
    for k, n, *_ in sorted(found, key=lambda x: x[:2]):
        row = int(rows[k])
        spans, base = spans_of.setdefault(row, []), int(edges[row])
        s, e = int(starts[k]) - base, int(ends[k + n - 1]) - base
        if spans and s <= spans[-1]["end"] + 1:
            spans[-1]["end"] = max(spans[-1]["end"], e)
        else:
            spans.append({"start": s, "end": e})
    return spans_of


def benchmark_items(benchmark: DataFrame, most_bytes: int = BROADCAST_BYTES) -> list[tuple[int, str | None]] | None:
    """The benchmark's rows, or None if their window set would exceed the broadcast bound."""
    rows = with_defaults(benchmark, item_id="long", text="string")
    size = rows.agg(F.sum(F.coalesce(F.octet_length("text") + WORD_BYTES * F.regexp_count("text", F.lit(r"[\w\u0080-\uffff]+")), F.lit(0)) + 64).cast("long")).first()[0] or 0
    return None if size > most_bytes else [tuple(r) for r in rows.collect()]


WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
RESULT = "doc_id long, n_words long, n_hit long, items array<long>, spans array<struct<start:int,end:int>>"


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, most_bytes: int = BROADCAST_BYTES, carry: bool = False) -> DataFrame:
    """``(doc_id, n_words, n_hit, items, spans)`` of every row of ``docs(doc_id, text)``.

    A window is ``window`` consecutive words of an item (all of them for a shorter item
    that has any).  ``items`` are the items with a window in the document, ``spans`` the
    hit words merged to character runs (UTF-8 byte offsets, end exclusive).  Null and
    empty texts have no words, an empty benchmark hits nothing, repeated rows each come
    back and other columns are ignored.  A window set beyond ``most_bytes`` is not
    broadcast: ``scan_by_join`` shuffles hashes instead, with the same results.  With
    ``carry`` each result holds its whole input row as the struct ``whole``.
    """
    items = benchmark_items(benchmark, most_bytes)
    if items is None:
        return scan_by_join(docs, benchmark, window, carry)
    return _scan_items(docs, items, window, carry)


def _scan_items(docs: DataFrame, items: list[tuple[int, str | None]], window: int, carry: bool) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(WindowSet(items, window))  # its size is checked

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            for lo, hi in chunks(offsets):
                part, edges = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                n_words, n_hit, found, (starts, ends, rows) = known.hits(part, edges)
                items_of: dict[int, set[int]] = {}
                for k, _, item_ids in found:
                    items_of.setdefault(int(rows[k]), set()).update(item_ids)
                spans_of = hit_spans(found, starts, ends, rows, edges)
                columns = [
                    batch.column("doc_id").slice(lo, hi - lo), pa.array(n_words.astype(np.int64)), pa.array(n_hit.astype(np.int64)),
                    pa.array([sorted(items_of.get(k, ())) for k in range(hi - lo)], pa.list_(pa.int64())), pa.array([spans_of.get(k, []) for k in range(hi - lo)], SPANS),
                ]
                yield passed_on(batch, lo, hi - lo, columns, ["doc_id", "n_words", "n_hit", "items", "spans"])

    src = with_defaults(docs, carry, doc_id="long", text="string")
    return src.mapInArrow(run, carried(src, RESULT))


def scan_by_join(docs: DataFrame, benchmark: DataFrame, window: int, carry: bool = False) -> DataFrame:
    """As ``scan``, with the same results, for a benchmark of any size.

    Window hashes of documents and items meet in a shuffled join; hits go back to their
    documents with the item's words, and are proved there.  Items are looked up by the
    proved words, so an item list is gathered for a document only, never for a window."""
    items = with_defaults(benchmark, item_id="long", text="string")
    lengths = sorted(r[0] for r in items.select(F.least(F.size(F.regexp_extract_all(_low(), F.lit(WORD), F.lit(0))), F.lit(window)).alias("n")).where("n > 0").distinct().collect())  # at most ``window`` values

    def item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            data, ids = LOWER[data], batch.column("item_id").to_pylist()
            starts, ends, rows, hashes = hashed_words(data, offsets)
            for n, at, h in item_windows(hashes, rows, len(ids), window):
                words = [joined(data, starts, ends, k, n).decode() for k in at.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array([ids[r] for r in rows[at].tolist()], pa.int64()), pa.array([n] * len(at), pa.int32()), pa.array(h.view(np.int64)), pa.array(words, pa.string())], ["item", "n", "h", "w"])

    def document_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            for lo, hi in chunks(offsets):
                part = LOWER[data[offsets[lo] : offsets[hi]]]
                starts, ends, rows = word_spans(part, offsets[lo : hi + 1] - offsets[lo])
                own = batch.column("row").slice(lo, hi - lo).to_numpy()
                if not len(starts):
                    continue
                roll, first = Rolling(Rolling(part).spans(starts, ends)), np.searchsorted(rows, rows)
                for n in lengths:
                    at = one_row_windows(rows, n)
                    yield pa.RecordBatch.from_arrays([pa.array(own[rows[at]]), pa.array(np.full(len(at), n, np.int32)), pa.array((at - first[at]).astype(np.int32)), pa.array(roll.spans(at, at + n).view(np.int64))], ["row", "n", "at", "h"])

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text, hits in zip(*(batch.column(c) for c in ("row", "text", "hits")), strict=True):
                data, offsets = buffers(pa.array([text.as_py()], pa.string()))
                data = LOWER[data]
                starts, ends, rows = word_spans(data, offsets)
                found = [(x["at"], x["n"], x["w"]) for x in hits.as_py() if joined(data, starts, ends, x["at"], x["n"]) == x["w"].encode()]
                spans = hit_spans(found, starts, ends, rows, offsets).get(0, [])
                yield pa.RecordBatch.from_arrays([pa.array([row.as_py()], pa.int64()), pa.array(hit_words(found, rows, 1), pa.int64()), pa.array([spans], SPANS), pa.array([sorted({w for _, _, w in found})], pa.list_(pa.string()))], ["row", "n_hit", "spans", "words"])

    listed = cut(items.mapInArrow(item_rows, "item long, n int, h long, w string").distinct(), "windows")
    # row numbers are written once, so every use of them sees the same
    base = cut(with_defaults(docs, carry, doc_id="long", text="string").withColumn("row", F.monotonically_increasing_id()), "rows")
    every = base.select("row", "text").mapInArrow(document_rows, "row long, n int, at int, h long")
    hits = every.join(listed.select("n", "h", "w").distinct(), ["n", "h"])
    of_row = hits.groupBy("row").agg(F.collect_list(F.struct("at", "n", "w")).alias("hits"))  # one document's own windows
    proved = cut(base.select("row", "text").join(of_row, "row").mapInArrow(prove, "row long, n_hit long, spans array<struct<start:int,end:int>>, words array<string>"), "proved")
    per_item = proved.select("row", F.explode("words").alias("w")).join(listed.select("w", "item").distinct(), "w").select("row", "item").distinct().groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    out = base.withColumn("n_words", F.regexp_count(_low(), F.lit(WORD)).cast("long")).drop("text").join(proved.drop("words"), "row", "left").join(per_item, "row", "left")
    none = lambda kind: F.expr(f"cast(array() as {kind})")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", none("array<long>")).alias("items"), F.coalesce("spans", none("array<struct<start:int,end:int>>")).alias("spans"), *(["whole"] if carry else []))


def _low() -> Column:
    return F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def contaminated(n_hit="n_hit", n_words="n_words", share: int = SHARE):
    """The rule: some word is hit, and at least one in ``share`` of the words is."""
    return (F.col(n_hit) > 0) & (share * F.col(n_hit) >= F.col(n_words))


def op6_decontamination(spark, sf_dir: str) -> DataFrame:
    """Contamination of all documents by all benchmark items."""
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), contaminated().alias("contaminated"))


_LOW = "translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOW + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP6_SQL = f"""
with d as (select doc_id, coalesce({_WORDS.format(t="text")}, []) as w from documents),
b as (select item_id, w, least(len(w), 13) as n from (select item_id, coalesce({_WORDS.format(t="text")}, []) as w from benchmark) where len(w) > 0),
bw as (select distinct item_id, n, array_to_string(w[i + 1 : i + n], ' ') as g from (select item_id, n, w, unnest(range(len(w) - n + 1)) as i from b)),
dw as (select doc_id, n, i, array_to_string(w[i + 1 : i + n], ' ') as g
       from (select doc_id, w, n, unnest(range(len(w) - n + 1)) as i from d, (select distinct n from bw) where len(w) >= n)),
h as (select distinct dw.doc_id, dw.n, dw.i, bw.item_id from dw join bw on dw.g = bw.g and dw.n = bw.n),
words as (select doc_id, count(distinct k) as n_hit from (select doc_id, unnest(range(i, i + n)) as k from h) group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(s, ',' order by s) as s from (select distinct doc_id, cast(item_id as varchar) as s from h) group by doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
       sha256(coalesce(s, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(d.w) as contaminated
from d left join words using (doc_id) left join items using (doc_id)
"""
