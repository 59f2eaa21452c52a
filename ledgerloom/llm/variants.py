"""Spelling variants: words that differ by one inserted, deleted or replaced letter, found by
walking a distributed trie level by level.

The words, read forwards and backwards, are the paths of two tries, kept as one table of
edges.  Chains of nodes without a branch are one edge with a longer label.  A state
(word, position, node, edits) stands for a word whose first letters lead to a node with
that many edits; each round joins the states with the edges that leave their nodes.  Two
words one edit apart share their first or their last half, so a forward and a backward
walk that each begin at the middle find every neighbour, where tries branch little.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import ceil, log
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .divergence import equal_spans
from .shared import cut, with_defaults
from .textbytes import Rolling, buffers

#: One run in so many loses a letter; letters and occurrences of a word, at least; how
#: many times as frequent a word's form is, at least.
ONE_IN, LEAST_LETTERS, LEAST_COUNT, FORM_TIMES = 199, 6, 5, 5
#: Distinct words that a task counts before it passes them on; words that are looked at in one go.
HELD_WORDS, WORDS_AT_ONCE = 300_000, 5000
_BACKWARDS = np.uint64(0x5851F42D4C957F2D)


def worn(run: str, doc: int, one_in: int = ONE_IN) -> str:
    """The run of this document, without one letter where its checksum says so."""
    h = crc32(run.encode(), doc)
    if h % one_in:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, least_letters: int = LEAST_LETTERS, one_in: int = ONE_IN, held: int = HELD_WORDS) -> DataFrame:
    """``(word, n)``: how often each word of at least ``least_letters`` occurs in all texts."""
    runs = re.compile(rf"[A-Za-zÀ-ÿ]{{{least_letters},}}")  # a shorter run can't give such a word

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def passed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                if not text.is_valid:
                    continue
                doc = crc32(f"{'' if doc_id is None else doc_id}:".encode())
                own = Counter(runs.findall(text.as_buffer().to_pybytes().lower().decode("utf-8", "replace")))  # of bytes: A-Z only
                for found, n in own.items():
                    word = worn(found, doc, one_in)
                    if len(word) >= least_letters:
                        counts[word] += n
                if len(counts) > held:
                    yield passed()
        yield passed()

    return with_defaults(docs, doc_id="long", text="string").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def prefixes(words: DataFrame, first_at: int) -> DataFrame:
    """``(path, at, node, next)``: of each word (``path`` is twice its number) and of the word
    backwards (one more) every beginning of ``first_at`` letters or more, by length and
    hash, and the code point that follows, -1 at the end.  Equal beginnings have equal
    hashes; that a hash may stand for several is mended where neighbours are proved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, WORDS_AT_ONCE):
                batch = whole.slice(lo, WORDS_AT_ONCE)
                texts = batch.column("word").to_pylist()
                n = np.array([len(t) for t in texts], np.int64)
                codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
                for back in (0, 1):
                    size, own = (n[::-1], codes[::-1]) if back else (n, codes)
                    first = np.append(0, np.cumsum(size))[:-1]
                    times = size + 1 - first_at
                    row = np.repeat(np.arange(len(size)), times)
                    at = first_at + np.arange(len(row)) - np.repeat(np.append(0, np.cumsum(times))[:-1], times)
                    node = Rolling(own).spans(first[row], first[row] + at) ^ (_BACKWARDS * np.uint64(back))
                    follows = np.where(at < size[row], np.append(own, 0).astype(np.int64)[np.minimum(first[row] + at, len(own))], -1)
                    ids = batch.column("id").to_numpy()
                    path = 2 * (ids[::-1] if back else ids)[row] + back
                    yield pa.RecordBatch.from_arrays([pa.array(path), pa.array(at.astype(np.int32)), pa.array(node.view(np.int64)), pa.array(follows.astype(np.int32))], ["path", "at", "node", "next"])

    return words.select("id", "word").mapInArrow(run, "path long, at int, node long, next int")


def trie(words: DataFrame, first_at: int) -> tuple[DataFrame, DataFrame]:
    """``paths(path, s, steps)`` and ``nodes(node, edges)`` of ``words(id, word)``, both
    written; an edge is (child, label, ends, nexts, rests), and no two of a node begin with
    the same letter, so they are as many as the alphabet has.  Words are bytes, one a letter.

    A node is a beginning of ``first_at`` letters (of which each has a trie of its own), an
    end of a word, or where words part.  ``ends`` says that a word ends at the child; the bits of ``nexts`` are the code points that follow it, and those
    of ``rests`` the numbers of letters that do, both modulo 64."""
    every = prefixes(words, first_at)
    nodes = every.groupBy("node").agg(F.min("next").alias("lo"), F.max("next").alias("hi"), F.min("at").alias("at")).where(f"lo <> hi or lo = -1 or at = {first_at}").select("node")
    steps = every.join(nodes.hint("merge"), "node").groupBy("path").agg(F.array_sort(F.collect_list(F.struct("at", "node", "next"))).alias("steps"))  # of one word
    s = F.when(F.col("path") % 2 == 0, F.col("word")).otherwise(F.reverse("word"))
    s = F.encode(s, "ISO-8859-1").alias("s")
    paths = cut(steps.withColumn("id", F.expr("path div 2")).join(words.select("id", "word"), "id").select("path", s, "steps"), "paths")
    pair = F.explode(F.arrays_zip(F.slice("steps", F.lit(1), F.size("steps") - 1).alias("a"), F.slice("steps", F.lit(2), F.size("steps") - 1).alias("b"))).alias("e")
    each = paths.select("s", pair).select(
        F.col("e.a.node").alias("parent"), F.col("e.b.node").alias("child"), F.expr("substring(s, e.a.at + 1, e.b.at - e.a.at)").alias("label"), (F.col("e.b.next") == -1).alias("ends"),
        F.expr("if(e.b.next = -1, 0L, shiftleft(1L, e.b.next % 64))").alias("nexts"), F.expr("shiftleft(1L, (octet_length(s) - e.b.at) % 64)").alias("rests"),
    )
    edges = each.groupBy("parent", "child", "label").agg(F.max("ends").alias("ends"), F.bit_or("nexts").alias("nexts"), F.bit_or("rests").alias("rests"))
    nodes = edges.groupBy(F.col("parent").alias("node")).agg(F.collect_list(F.struct("child", "label", "ends", "nexts", "rests")).alias("edges"))
    return paths, cut(nodes, "nodes")


def one_edit(a: bytes, b: bytes) -> bool:
    """Whether exactly one byte inserted, deleted or replaced makes one the other; their
    lengths differ by one at most."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    at = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[at:] == b[at + 1 :]


def _moves(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The states of a batch one edge further: with the label's letters, or with one edit
    among them.  A state with its edit spent must find all the rest of its word, so letters
    are only compared where the child has such a rest: as many letters, and this one first."""
    data, first = buffers(batch.column("s"))
    edges = batch.column("edges")
    k = np.repeat(np.arange(batch.num_rows), edges.value_lengths().to_numpy())
    flat = edges.flatten()
    child, nexts, rests = (flat.field(c).to_numpy().view(np.uint64) for c in ("child", "nexts", "rests"))
    ends = flat.field("ends").to_numpy(zero_copy_only=False)
    letters, begin = buffers(flat.field("label"))
    n, at, edits = np.diff(begin), batch.column("at").to_numpy().astype(np.int64)[k], batch.column("edits").to_numpy()[k]
    here, left = first[k] + at, np.diff(first)[k] - at
    bit = lambda mask, place: (mask >> (place % 64).astype(np.uint64)) & np.uint64(1) > 0

    def goes_on(more: int) -> np.ndarray:
        rest = left - n - more
        follows = data[np.minimum(here + n + more, len(data) - 1)]
        return (rest == 0) & ends | (rest > 0) & bit(rests, np.maximum(rest, 0)) & bit(nexts, follows.astype(np.int64))

    fits = (left >= n) & ((edits == 0) | goes_on(0))
    fits[fits] = equal_spans(data, here[fits], letters, begin[:-1][fits], n[fits])
    found = [(np.flatnonzero(fits), 0, edits[fits])]
    for more in (0, -1, 1):
        some = np.flatnonzero((edits == 0) & (left >= n + more) & goes_on(more))
        if more == -1:  # a label of one letter is inserted whole
            sure, some = some[n[some] == 1], some[n[some] > 1]
        else:
            sure = some[:0]
        kept = [j for j, x, w, y, m in zip(some.tolist(), here[some].tolist(), (n[some] + more).tolist(), begin[some].tolist(), n[some].tolist(), strict=True) if one_edit(data[x : x + w].tobytes(), letters[y : y + m].tobytes())]
        at_ = np.concatenate([sure, np.array(kept, np.int64)])
        found.append((at_, more, np.ones(len(at_), np.int32)))
    edge = np.concatenate([x for x, _, _ in found])
    moved = at[edge] + n[edge] + np.repeat([more for _, more, _ in found], [len(x) for x, _, _ in found])
    rows = pa.array(k[edge])
    columns = [batch.column("path").take(rows), batch.column("s").take(rows), pa.array(moved.astype(np.int32)), pa.array(child[edge].view(np.int64)), pa.array(np.concatenate([e for _, _, e in found]).astype(np.int32)), pa.array(ends[edge])]
    return pa.RecordBatch.from_arrays(columns, ["path", "s", "at", "node", "edits", "ends"])


def neighbours(words: DataFrame, least_letters: int = 1) -> DataFrame:
    """``(word, other)``: every two different words of ``words(id, word)``, a written table of
    distinct words of ``least_letters`` or more, that are one edit apart, in both orders.
    Letters are those of Latin-1."""
    paths, nodes = trie(words, (least_letters - 1) // 2)  # no walk begins before
    begin = F.element_at(F.expr("filter(steps, x -> x.at <= (octet_length(s) - 1) div 2)"), -1)
    states = paths.select("path", "s", begin["at"].alias("at"), begin["node"].alias("node"), F.lit(0).alias("edits"))
    found = None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _moves(batch)

    while True:  # a round for each node on the longest way from a word's middle to its end
        met = states.join(nodes, "node").select("path", "s", "at", "edits", "edges")
        states = cut(met.mapInArrow(run, "path long, s binary, at int, node long, edits int, ends boolean"), "states")
        done = states.where("ends and octet_length(s) - at + edits = 1").select("path", "s", "node")
        found = done if found is None else found.unionByName(done)
        states = states.where("edits = 0 or octet_length(s) > at").drop("ends")
        if states.isEmpty():
            break
    ends = paths.select("path", F.element_at("steps", -1)["node"].alias("node"), F.col("s").alias("t"))
    met = found.distinct().join(ends.drop("path"), "node")
    text = lambda c: F.decode(F.col(c), "ISO-8859-1")
    way = lambda c: F.when(F.col("path") % 2 == 0, text(c)).otherwise(F.reverse(text(c)))
    return met.select(way("s").alias("word"), way("t").alias("other")).distinct().where(F.levenshtein("word", "other", 1) == 1)


def variants(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, form_times: int = FORM_TIMES, one_in: int = ONE_IN) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of the words of ``docs(doc_id, text)``.

    ``form`` is the most frequent word one edit away (the first in code-point order of
    equals) if it is ``form_times`` as frequent, ``root`` the last of the chain of forms.
    Null and empty texts have no words; a null doc_id counts as ''; repeated rows count
    each; other columns are ignored; an empty table gives none.  Words of any length are
    handled: nothing is quadratic in it."""
    counted = word_counts(docs, least_letters, one_in).where(F.col("n") >= least_count)
    words = cut(counted.withColumn("id", F.monotonically_increasing_id()), "words")  # numbered once
    near = neighbours(words, least_letters).join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("low"), F.col("other").alias("other"))).alias("b"))
    rows = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("b.other").alias("other"), (-F.col("b.low")).alias("other_n"))
    like = F.col("other_n") >= form_times * F.col("n")
    rows = cut(rows.select("word", "n", "n_near", F.when(like, F.col("other")).alias("form"), F.when(like, F.col("other_n")).alias("form_n")), "forms")
    roots = rows.where("form is not null").select("word", F.col("form").alias("root"))
    most = rows.agg(F.max("n")).first()[0] or 1
    links = max(1.0, log(most / least_count, form_times)) if form_times > 1 else 64  # each is form_times as frequent as the last
    for _ in range(ceil(log(links + 1, 2))):  # each round doubles the way to the root
        roots = cut(roots, "roots")
        later = roots.select(F.col("word").alias("root"), F.col("root").alias("later"))
        roots = roots.join(later, "root", "left").select("word", F.coalesce("later", "root").alias("root"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))
