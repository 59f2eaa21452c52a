"""Language identification with hyperdimensional profiles.

Every letter has a random bipolar vector, fixed by its code point.  An n-gram's vector
binds the permuted (rotated) vectors of its letters, a text's vector bundles (adds) those
of its n-grams, and a language's prototype bundles those of its training texts.  A text
gets the language whose prototype has the largest cosine with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import carried, passed_on, with_defaults
from .textbytes import buffers, chunks

DIMENSIONS = 1024
SEED = 20_011
#: Training texts expected of each language (a bounded sample, chosen by hash).
TRAIN_PER_LANGUAGE = 2000
UNKNOWN = "und"
#: Rows, bytes and letters of text that are counted at once, trigrams that are bundled at
#: once, letter vectors that a worker remembers.
ROWS_AT_ONCE, BYTES_AT_ONCE, CHARS_AT_ONCE, NGRAMS_AT_ONCE, MEMO_LETTERS = 256, 1 << 20, 1 << 20, 4096, 1 << 15


@cache
def letter_table() -> np.ndarray:
    """Per code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


class Encoder:
    """Hypervectors of texts: trigrams are counted, and bound and bundled a block at a time."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = SEED):
        self.dimensions, self.seed = dimensions, seed
        self.letters: dict[int, np.ndarray] = {}

    def letter(self, code: int) -> np.ndarray:
        """The random vector of a code point (0: anything that is no letter)."""
        found = self.letters.get(code)
        if found is None:
            rng = np.random.default_rng([self.seed, code])
            found = rng.integers(0, 2, self.dimensions, np.int8) * 2 - 1
            if len(self.letters) >= MEMO_LETTERS:
                self.letters.clear()
            self.letters[code] = found
        return found

    def bundle(self, code: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
        """Sums of the vectors of all trigrams of each row of code points.

        A trigram belongs to the row of its middle letter; one around a space between two
        rows belongs to none."""
        out = np.zeros((n_rows, self.dimensions), np.float32)
        if len(code) < 3:
            return out
        present, small = np.unique(code, return_inverse=True)
        n = len(present)
        key = (small[:-2] * n + small[1:-1]) * n + small[2:]
        ok = (code[1:-1] != 0) | (row[:-2] == row[2:])
        at = np.where(code[1:-1] != 0, row[1:-1], row[:-2])[ok]
        key = key[ok]
        order = np.argsort(key)
        key, at = key[order], at[order]
        used, first = np.unique(key, return_index=True)
        place = np.repeat(np.arange(len(used)), np.diff(np.append(first, len(key))))
        base = np.stack([self.letter(c) for c in present.tolist()])
        once, twice = np.roll(base, 1, axis=1), np.roll(base, 2, axis=1)
        for lo in range(0, len(used), NGRAMS_AT_ONCE):
            part = used[lo : lo + NGRAMS_AT_ONCE]
            i, j = np.searchsorted(place, [lo, lo + len(part)])
            times = np.bincount(at[i:j] * len(part) + (place[i:j] - lo), minlength=n_rows * len(part)).reshape(n_rows, len(part))
            grams = twice[part // (n * n)] * once[part // n % n] * base[part % n]
            out += times.astype(np.float32) @ grams.astype(np.float32)
        return out

    def vectors(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Hypervectors (rows x dimensions) and letters of each row.

        Letters are lower-cased; each run of other characters, and each end, is one space.
        """
        if len(texts) == 1 and len(texts[0]) > CHARS_AT_ONCE:
            return self._long(texts[0])
        rows = [t.lower() for t in texts]
        code = _letters(" " + " ".join(rows) + " ")
        row = np.repeat(np.arange(len(rows)), np.array([len(r) + 1 for r in rows]))
        row = np.concatenate([[0], row])
        keep = _single(code)
        code, row = code[keep], row[keep]
        return self.bundle(code, row, len(rows)), np.bincount(row[code != 0], minlength=len(rows))

    def _long(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """One long text, a stretch at a time; two letters of each lead into the next."""
        low, lead = text.lower(), np.zeros(1, np.uint32)
        total, n_letters = np.zeros((1, self.dimensions), np.float32), 0
        for lo in range(0, len(low), CHARS_AT_ONCE):
            new = _letters(low[lo : lo + CHARS_AT_ONCE])
            n_letters += int((new != 0).sum())
            code = np.concatenate([lead, new, np.zeros(int(lo + CHARS_AT_ONCE >= len(low)), np.uint32)])
            code = code[_single(code)]
            total += self.bundle(code, np.zeros(len(code), np.int64), 1)
            lead = code[-2:]
        return total, np.array([n_letters])


def _letters(text: str) -> np.ndarray:
    """Code points, 0 for those that are no letters."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(letter_table()[code], code, np.uint32(0))


def _single(code: np.ndarray) -> np.ndarray:
    """Which code points stay, so that no two spaces are together."""
    keep = np.ones(len(code), bool)
    keep[1:] = (code[1:] != 0) | (code[:-1] != 0)
    return keep


def _text_groups(column: pa.Array) -> Iterator[tuple[int, int, list[str]]]:
    _, offsets = buffers(column)
    for lo, hi in chunks(offsets, BYTES_AT_ONCE):
        for a in range(lo, hi, ROWS_AT_ONCE):
            b = min(a + ROWS_AT_ONCE, hi)
            yield a, b, [t or "" for t in column.slice(a, b - a).to_pylist()]


def train(labelled: DataFrame, per_language: int = TRAIN_PER_LANGUAGE, dimensions: int = DIMENSIONS, seed: int = SEED) -> dict[str, np.ndarray]:
    """Unit prototypes from ``labelled(doc_id, text, lang)``.

    A sample of about ``per_language`` rows of each language, chosen by the hash of
    doc_id, is bundled; rows without text or lang teach nothing.  The driver gets one sum
    per language and dimension, so its memory grows with languages alone.
    """
    rows = with_defaults(labelled, doc_id="long", text="string", lang="string").where("lang is not null and text is not null")
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return {}
    share = F.create_map(*[x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(1.0, per_language / n)))])
    unit = F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(1 << 30)) / float(1 << 30)
    chosen = rows.where(unit < F.element_at(share, F.col("lang")))

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, sums = Encoder(dimensions, seed), {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for lo, hi, texts in _text_groups(batch.column("text")):
                vectors, _ = enc.vectors(texts)
                norms = np.linalg.norm(vectors, axis=1, keepdims=True)
                unit_vectors = vectors / np.maximum(norms, 1e-9)
                for lang in set(langs[lo:hi]):
                    part = unit_vectors[[x == lang for x in langs[lo:hi]]].sum(axis=0)
                    sums[lang] = sums.get(lang, 0) + part
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([list(map(float, v)) for v in sums.values()], pa.list_(pa.float64()))], ["lang", "vector"])

    parts = chosen.select("lang", "text").mapInArrow(bundle, "lang string, vector array<double>")
    summed = parts.select("lang", F.posexplode("vector").alias("at", "x")).groupBy("lang", "at").agg(F.sum("x").alias("x"))
    found: dict[str, np.ndarray] = {}
    for lang, at, x in summed.collect():
        found.setdefault(lang, np.zeros(dimensions))[at] = x
    # the part that all languages share says nothing about any of them
    mean = np.mean([v / max(np.linalg.norm(v), 1e-9) for v in found.values()], axis=0)
    centred = {k: v / max(np.linalg.norm(v), 1e-9) - (mean if len(found) > 1 else 0) for k, v in sorted(found.items())}
    return {k: v / max(np.linalg.norm(v), 1e-9) for k, v in centred.items()} | {"": mean if len(found) > 1 else np.zeros(dimensions)}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], dimensions: int = DIMENSIONS, seed: int = SEED, carry: bool = False) -> DataFrame:
    """``(doc_id, lang_pred, score)`` of every row of ``docs(doc_id, text)``.

    ``score`` is the cosine with the language's prototype, cut to 0..1; ties go to the
    first language by name.  ``und`` with score 0 where the text is null or has no letter,
    or where there is nothing to compare with.  Repeated rows each come back, other
    columns are ignored, and an empty table gives none.  With
    ``carry`` each result holds its whole input row as the struct ``whole``.
    """
    langs = [k for k in sorted(prototypes) if k]
    matrix = np.array([prototypes[k] for k in langs], np.float32) if langs else np.zeros((0, dimensions), np.float32)
    mean = np.asarray(prototypes.get("", np.zeros(dimensions)), np.float32)
    held = docs.sparkSession.sparkContext.broadcast((langs, matrix, mean))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, rows, centre = held.value
        enc = Encoder(dimensions, seed)
        for batch in batches:
            for lo, hi, texts in _text_groups(batch.column("text")):
                vectors, n_letters = enc.vectors(texts)
                vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
                vectors -= centre
                vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
                if len(names):
                    cosines = vectors @ rows.T
                    best = cosines.argmax(axis=1)
                    score = np.clip(cosines[np.arange(len(best)), best], 0, 1).astype(float)
                    langs_of = [names[k] if n else UNKNOWN for k, n in zip(best.tolist(), n_letters.tolist(), strict=True)]
                else:
                    score, langs_of = np.zeros(hi - lo), [UNKNOWN] * (hi - lo)
                score[n_letters == 0] = 0.0
                yield passed_on(batch, lo, hi - lo, [batch.column("doc_id").slice(lo, hi - lo), pa.array(langs_of, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    src = with_defaults(docs, carry, doc_id="long", text="string")
    return src.mapInArrow(run, carried(src, "doc_id long, lang_pred string, score double"))


def held_out():
    """Rows that are kept for testing: crc32 of doc_id as text, modulo 4, is 2."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from those that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = predict(docs, train(docs.where(~held_out())))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
