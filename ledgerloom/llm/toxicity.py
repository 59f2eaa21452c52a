"""Toxicity: a linear-chain conditional random field tags toxic words; forward-backward
marginals give the spans and, aggregated, the score of a document.

Document labels are turned into token labels first: a greedy cover picks words and word
beginnings that occur in toxic training texts and hardly in others, until every toxic
text that can be explained is.  The field then learns from those labelled tokens, with
hashed features of each word, so it also tags words it has not seen.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import carried, passed_on, with_defaults
from .textbytes import LOWER, Rolling, buffers, chunks, word_spans

#: Training texts of each label, chosen by hash; longer texts teach nothing.
TRAIN_PER_LABEL = 1200
TRAIN_TEXT_BYTES = 1 << 18
#: Bytes of training texts of each label; texts beyond teach nothing.
TRAIN_BYTES = 12 << 20
#: Hashed feature weights.
WEIGHTS = 1 << 18
#: Bytes from the start or the end of a word that are features beside the word itself.
PREFIXES, SUFFIXES = (3, 4, 5, 6), (3, 4)
THRESHOLD = 0.3
SPAN_MARGINAL = 0.5
FAINT = 0.1
#: A feature tells if its rate in clean texts is at most this share of that in toxic ones,
#: and is frequent if it occurs in this share of those.
TELLING, FREQUENT = 0.01, 0.01
BLOCK = 64


def features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit feature hashes (words x features): the word, its beginnings, its ends."""
    roll = Rolling(data)
    cols = [roll.spans(starts, ends)]
    cols += [roll.spans(starts, np.minimum(starts + k, ends)) ^ np.uint64(k) for k in PREFIXES]
    cols += [roll.spans(np.maximum(ends - k, starts), ends) ^ np.uint64(64 + k) for k in SUFFIXES]
    return np.stack(cols, axis=1)


def slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(20)).astype(np.int64) & (WEIGHTS - 1)


def _directed(psi: np.ndarray, first: np.ndarray, move: np.ndarray, start: np.ndarray, back: bool) -> np.ndarray:
    """Normalised forward (or backward) vectors of one long chain in which every row
    starts anew at ``first``; blocks run side by side, so steps do not grow with texts."""
    n = len(psi)
    width = -(-n // BLOCK)
    m = np.empty((width * BLOCK, 2, 2))
    m[n:] = np.eye(2)
    step = np.where(first[:, None, None], start[None, None, :], move[None])
    m[:n] = step * np.stack([np.ones(n), psi], axis=1)[:, None, :]
    if back:
        m = m[::-1].transpose(0, 2, 1)
    m = m.reshape(width, BLOCK, 2, 2)
    whole = np.broadcast_to(np.eye(2), (width, 2, 2)).copy()
    for k in range(BLOCK):
        whole = whole @ m[:, k]
        whole /= whole.sum(axis=(1, 2), keepdims=True)
    enter, (u, v) = np.empty((width, 2)), (0.5, 0.5)
    for b, ((p, q), (r, s)) in enumerate(whole.tolist()):
        enter[b] = u, v
        u, v = u * p + v * r, u * q + v * s
        z = u + v
        u, v = u / z, v / z
    out = np.empty((width, BLOCK, 2))
    for k in range(BLOCK):
        if back:
            out[:, k] = enter
        enter = (enter[:, None, :] @ m[:, k])[:, 0]
        enter /= enter.sum(axis=1, keepdims=True)
        if not back:
            out[:, k] = enter
    out = out.reshape(-1, 2)
    return out[::-1][:n] if back else out[:n]


def marginals(score: np.ndarray, first: np.ndarray, move: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """P(toxic) of each token, and the normalised forward and backward vectors."""
    psi = np.exp(np.clip(score, -30, 30))
    fore = _directed(psi, first, move, start, False)
    aft = _directed(psi, first, move, start, True)
    both = fore * aft
    return both[:, 1] / both.sum(axis=1), fore, aft


@dataclass
class Model:
    weights: np.ndarray  # of hashed features
    bias: float
    move: np.ndarray  # transition potentials
    start: np.ndarray
    scale: np.ndarray  # of the document score

    def tag(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, rows, P(toxic)) of all words of lower-cased rows."""
        starts, ends, rows = word_spans(data, offsets)
        if not len(starts):
            return starts, ends, rows, np.zeros(0)
        score = self.weights[slots(features(data, starts, ends))].sum(axis=1) + self.bias
        first = np.diff(rows, prepend=-1) != 0
        return starts, ends, rows, marginals(score, first, self.move, self.start)[0]

    def documents(self, rows: np.ndarray, p: np.ndarray, n: int) -> np.ndarray:
        x = aggregate(rows, p, n)
        return 1 / (1 + np.exp(-np.clip(x @ self.scale, -30, 30)))


def aggregate(rows: np.ndarray, p: np.ndarray, n: int) -> np.ndarray:
    """Of each document: constant, log of the expected toxic words, log-odds of any.

    Marginals below ``FAINT`` count as none, so that very many of them, in a very long
    text, do not add up to a toxic word."""
    p = np.where(p >= FAINT, p, 0.0)
    total = np.bincount(rows, p, n)
    none = np.bincount(rows, np.log1p(-np.clip(p, 0, 1 - 1e-6)), n)
    anything = np.clip(-np.expm1(none), 1e-6, 1 - 1e-6)
    return np.column_stack([np.ones(n), np.log(total + 0.05), np.log(anything / (1 - anything))])


def label_tokens(hashes: np.ndarray, rows: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Token labels from document labels: words that are frequent in toxic texts and hardly
    occur in others, and a greedy cover of the toxic texts that they leave unexplained."""
    n_toxic = int((toxic == 1).sum())
    n_clean = max(1, int((toxic == 0).sum()))
    names, codes, docs, length, surely = [], [], [], [], []
    for k in range(1 + len(PREFIXES)):  # one kind at a time, and only features that may do
        found, code = np.unique(hashes[:, k], return_inverse=True)
        pair = np.unique(code.astype(np.int64) * len(toxic) + rows)
        code, doc = pair // len(toxic), pair % len(toxic)
        a = np.bincount(code[toxic[doc] == 1], minlength=len(found))
        b = np.bincount(code[toxic[doc] == 0], minlength=len(found))
        able = (a >= max(3, 0.002 * n_toxic)) & (b * max(1, n_toxic) <= TELLING * a * n_clean)
        sure = a >= max(5, FREQUENT * n_toxic)
        use = able[code] & (toxic[doc] == 1)
        index = np.cumsum(able) - 1 + sum(map(len, names))
        names.append(found[able])
        surely.append(sure[able] & (k == 0))
        length.append(np.full(able.sum(), (7, *PREFIXES)[k]))  # the longer of features that explain alike
        codes.append(index[code[use]])
        docs.append(doc[use])
    names, code, doc, length, surely = map(np.concatenate, (names, codes, docs, length, surely))
    open_, chosen = toxic == 1, surely  # frequent telling words count, whether the cover needs them or not
    open_[doc[chosen[code]]] = False
    while len(code):
        gain = np.where(chosen, 0, np.bincount(code[open_[doc]], minlength=len(names)) * 16 + length)
        best = int(gain.argmax())
        if gain[best] < 16 * max(2, 0.001 * n_toxic):
            break
        chosen[best] = True
        open_[doc[code == best]] = False
    hit = np.isin(hashes[:, : 1 + len(PREFIXES)], names[chosen]).any(axis=1)
    return (hit & (toxic[rows] == 1)).astype(np.float32)


def fit(texts: list[str], labels: list[int], prior: float, epochs: int = 6, rate: float = 0.5, decay: float = 1e-6) -> Model:
    """Train on labelled texts; a third of them sets the document score."""
    known: dict[str, int] = {}
    for t, y in zip(texts, labels, strict=True):
        known.setdefault(t, int(y))  # copies teach once
    texts, toxic = list(known), np.array(list(known.values()), np.int64)
    move, start = np.array([[1.0, 0.02], [1.0, 0.2]]), np.array([1.0, 0.02])
    blank = Model(np.zeros(WEIGHTS), -1.0, move, start, np.array([np.log(max(prior, 1e-4) / (1 - min(prior, 0.9999))), 0.0, 0.0]))
    if not texts or not 0 < toxic.sum() < len(toxic):
        return blank
    data, offsets = buffers(pa.array(texts))
    data = LOWER[data]
    starts, ends, rows = word_spans(data, offsets)
    if not len(starts):
        return blank
    hashes = features(data, starts, ends)
    del data
    spare = np.arange(len(texts)) % 3 == 2
    if len(np.unique(toxic[spare])) < 2 or len(np.unique(toxic[~spare])) < 2:
        spare[:] = False
    y = label_tokens(hashes, rows, np.where(spare, -1, toxic))
    index = slots(hashes).astype(np.int32)
    del hashes
    w, g2, bias, b2 = np.zeros(WEIGHTS), np.full(WEIGHTS, 1e-3), -4.0, 1e-3
    log_move, m2 = np.log(move), np.full((2, 2), 1.0)
    order = np.random.default_rng(7).permutation(np.flatnonzero(~spare))
    edges = np.searchsorted(rows, np.arange(len(texts) + 1))
    for _ in range(epochs):
        for part in np.array_split(order, max(1, len(order) // 64)):
            at = np.concatenate([np.arange(edges[d], edges[d + 1]) for d in part])
            if not len(at):
                continue
            x, t = index[at], y[at]
            first = np.diff(rows[at], prepend=-1) != 0
            score = w[x].sum(axis=1) + bias
            p, fore, aft = marginals(score, first, np.exp(log_move), start)
            slope = p - t
            grad = np.bincount(x.ravel(), np.repeat(slope, x.shape[1]), WEIGHTS) + decay * w
            g2 += grad * grad
            w -= rate * grad / np.sqrt(g2)
            gb = slope.sum()
            b2 += gb * gb
            bias -= rate * gb / np.sqrt(b2)
            inner = np.flatnonzero(~first)  # expected against labelled transitions
            joint = fore[inner - 1][:, :, None] * np.exp(log_move)[None] * (np.stack([np.ones(len(inner)), np.exp(np.clip(score[inner], -30, 30))], 1) * aft[inner])[:, None, :]
            joint /= joint.sum(axis=(1, 2), keepdims=True)
            was, now = t[inner - 1].astype(int), t[inner].astype(int)
            gm = joint.sum(axis=0) - np.bincount(was * 2 + now, minlength=4).reshape(2, 2)
            m2 += gm * gm
            log_move -= 0.1 * gm / np.sqrt(m2)
            log_move -= log_move[0, 0]
    model = Model(w, float(bias), np.exp(log_move), start, blank.scale)
    p = np.zeros(len(rows))
    for part in np.array_split(np.arange(len(texts)), 1 + len(rows) // 100_000):
        at = slice(edges[part[0]], edges[part[-1] + 1]) if len(part) else slice(0, 0)
        if at.stop > at.start:
            first = np.diff(rows[at], prepend=-1) != 0
            p[at] = marginals(w[index[at]].sum(axis=1) + bias, first, model.move, start)[0]
    use = spare if spare.any() else np.ones(len(texts), bool)
    x, z = aggregate(rows, p, len(texts))[use], toxic[use].astype(float)
    weight = np.where(z == 1, prior / max(z.mean(), 1e-9), (1 - prior) / max(1 - z.mean(), 1e-9))
    beta = np.zeros(x.shape[1])
    for _ in range(50):  # Newton steps of a logistic regression with a small ridge
        q = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hess = (x * (weight * q * (1 - q))[:, None]).T @ x + np.diag([1e-3, 0.05, 0.05])
        beta = np.clip(beta - np.linalg.solve(hess, x.T @ (weight * (q - z)) + np.array([1e-3, 0.05, 0.05]) * beta), -50, 50)
    model.scale = beta
    return model


def train(docs: DataFrame, labels: DataFrame, per_label: int = TRAIN_PER_LABEL, text_bytes: int = TRAIN_TEXT_BYTES, train_bytes: int = TRAIN_BYTES) -> Model:
    """Fit on a bounded sample: of each label the ``per_label`` doc_ids with the smallest
    hash, their texts of at most ``text_bytes`` bytes each, and of these as many in that
    order as fit ``train_bytes``.

    ``labels(doc_id, toxic)``; a doc_id with several labels counts as toxic if one does,
    one with several texts teaches the smallest by bytes, null texts teach nothing.  The
    fit runs in one task; the driver gets the ids and the model, no text.  Without texts
    of both labels the model knows only how frequent toxic ones are.
    """
    marks = with_defaults(labels, doc_id="long", toxic="int").where("toxic in (0, 1) and doc_id is not null")
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r[0]: r[1] for r in marks.groupBy("toxic").count().collect()}
    prior = sizes.get(1, 0) / max(1, sum(sizes.values())) if sizes else 0.1
    order = F.xxhash64("doc_id", F.lit("toxicity"))
    ids = [(r[0], y, k) for y in (0, 1) for k, r in enumerate(marks.where(F.col("toxic") == y).orderBy(order, "doc_id").limit(per_label).collect())]
    if not ids:
        return fit([], [], prior)
    wanted = docs.sparkSession.createDataFrame(ids, "doc_id long, toxic int, place int")  # at most 2 * per_label rows
    rows = with_defaults(docs, doc_id="long", text="string").where(F.octet_length("text") <= text_bytes)
    one = rows.join(F.broadcast(wanted), "doc_id").groupBy("doc_id", "toxic", "place").agg(F.min("text").alias("text"))
    sample = one.repartition(1).sortWithinPartitions("place", "toxic")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, texts = {0: train_bytes, 1: train_bytes}, []
        for batch in batches:
            for doc_id, toxic, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "toxic", "text")), strict=True):
                left[toxic] -= len(text.encode())
                if left[toxic] >= 0:
                    texts.append((doc_id, text, toxic))
        texts.sort()
        model = fit([t for _, t, _ in texts], [y for _, _, y in texts], prior)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    found = sample.mapInArrow(run, "model binary").collect()
    return pickle.loads(found[0][0]) if found else fit([], [], prior)


def score(docs: DataFrame, model: Model, carry: bool = False) -> DataFrame:
    """``(doc_id, score, n_toxic, spans)`` of every row of ``docs(doc_id, text)``.

    ``spans`` are UTF-8 byte offsets (end exclusive) of words with a marginal of at least
    one half, ``n_toxic`` the expected number of toxic words.  Null and empty texts get
    the score of a text without toxic words.  Repeated rows each come back.  With
    ``carry`` each result holds its whole input row as the struct ``whole``.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            for lo, hi in chunks(offsets):
                n, edges = hi - lo, offsets[lo : hi + 1] - offsets[lo]
                starts, ends, rows, p = known.tag(LOWER[data[offsets[lo] : offsets[hi]]], edges)
                spans: list[list[dict]] = [[] for _ in range(n)]
                for k in np.flatnonzero(p >= SPAN_MARGINAL).tolist():
                    base = int(edges[rows[k]])
                    spans[int(rows[k])].append({"start": int(starts[k]) - base, "end": int(ends[k]) - base})
                yield passed_on(
                    batch,
                    lo,
                    n,
                    [batch.column("doc_id").slice(lo, n), pa.array(known.documents(rows, p, n)), pa.array(np.bincount(rows, p, n).astype(float)), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                    ["doc_id", "score", "n_toxic", "spans"],
                )

    src = with_defaults(docs, carry, doc_id="long", text="string")
    return src.mapInArrow(run, carried(src, "doc_id long, score double, n_toxic double, spans array<struct<start:int,end:int>>"))


def held_out():
    """Rows that are kept for testing: crc32 of doc_id as text, modulo 4, is 2."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from the labels of those not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = score(docs, train(docs, labels.where(~held_out())))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
