"""Copies of images by local descriptors: cropped, turned, resized or otherwise edited
copies share corners.

Corners are found at several scales, a few in each cell of a grid, described by 128 binary
tests turned to the corner's orientation, and put in Hamming tables: a table's key is one
quarter of the descriptors of a corner and of two of its three nearest neighbours, with
the neighbours' places in its frame.  Images that share a key are compared: descriptors
are matched within a Hamming radius, and enough matches must agree on one turn, scale and
shift.  Agreements are links, and classes are their connected components.

Scales are halves, so copies are found at half, equal and double size, and a little around
those.  All images of a key are compared, those of keys that very many share in bounded tiles."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import components, cut
from .simhash import LEAST_TILE, _lists, _runs, band_groups, known_parts
from .textbytes import mix

#: Corners kept in each cell of a grid and its side, at each scale; pixels to the border,
#: half-width of a patch, most scales.
PER_CELL, CELL, MARGIN, PATCH, SCALES = 5, 24, 9, 7, 6
TESTS, TURNS, TABLES = 128, 16, 2
#: Neighbours of a corner that its keys choose from; bits that a key's own quarter has set.
NEIGHBOURS, SAYING = 3, 4
#: Least difference of brightness that a test counts, so flat patches give stable bits.
CONTRAST = 4.0
HAMMING, INLIERS, PIXELS = 20, 6, 3.0
#: Images of a key that are compared pair by pair; corners of a tile of larger keys.
SMALL_KEY, TILE_CORNERS = 16, 1 << 16
#: Corners of an image that are held against all corners of two tiles at once; matches of
#: two images up to which the pairs of many images are looked at together.
AT_ONCE, MOST_MATCHES = 16, 64


def _patterns() -> np.ndarray:
    """Test points (turns, tests, 2 ends, y and x), turned in steps."""
    rng = np.random.default_rng(5)
    points = np.clip(rng.normal(0, PATCH / 2.2, (TESTS, 2, 2)), -PATCH + 1, PATCH - 1)
    out = []
    for k in range(TURNS):
        a = 2 * np.pi * k / TURNS
        turn = np.array([[np.cos(a), np.sin(a)], [-np.sin(a), np.cos(a)]])  # of (y, x)
        out.append(np.clip(np.rint(points @ turn.T), -PATCH, PATCH))
    return np.array(out).astype(np.int64)


PATTERNS = _patterns()
_BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def decode(blob: bytes | None) -> np.ndarray | None:
    """Grey image of a binary PGM or PPM (P5 or P6, at most 255 levels), or None."""
    if not blob or blob[:2] not in (b"P5", b"P6"):
        return None
    head = re.match(rb"P[56](?:\s+(?:#[^\n]*\n\s*)*(\d+))(?:\s+(?:#[^\n]*\n\s*)*(\d+))(?:\s+(?:#[^\n]*\n\s*)*(\d+))\s", blob)
    if not head:
        return None
    width, height, top = map(int, head.groups())
    depth = 3 if blob[:2] == b"P6" else 1
    body = np.frombuffer(blob, np.uint8, offset=head.end())
    if len(body) != width * height * depth or top > 255 or min(width, height) < 2 * MARGIN + 3:
        return None
    if depth == 1:
        return body.reshape(height, width)
    return (body.reshape(height, width, 3) @ np.array([0.299, 0.587, 0.114])).astype(np.uint8)


def encode(image: np.ndarray) -> bytes:
    return b"P5 %d %d 255\n" % (image.shape[1], image.shape[0]) + np.ascontiguousarray(image, np.uint8).tobytes()


def _box(x: np.ndarray) -> np.ndarray:
    """3 x 3 mean of each image of a stack, edges repeated."""
    p = np.pad(x, ((0, 0), (1, 1), (1, 1)), mode="edge")
    rows = p[:, :-2] + p[:, 1:-1] + p[:, 2:]
    return (rows[:, :, :-2] + rows[:, :, 1:-1] + rows[:, :, 2:]) / 9


def _corners(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(image, y, x) of the corners of a stack: the strongest of each cell of the grid, so
    their number grows with the area and a crop keeps its share."""
    n, h, w = x.shape
    gy, gx = np.zeros_like(x), np.zeros_like(x)
    gy[:, 1:-1] = x[:, 2:] - x[:, :-2]
    gx[:, :, 1:-1] = x[:, :, 2:] - x[:, :, :-2]
    a, b, c = _box(gy * gy), _box(gx * gx), _box(gy * gx)
    r = a * b - c * c - 0.05 * (a + b) ** 2
    inner = r[:, MARGIN : h - MARGIN, MARGIN : w - MARGIN]
    top = inner > 1e3
    for dy in (-2, -1, 0, 1, 2):
        for dx in (-2, -1, 0, 1, 2):
            if dy or dx:
                other = r[:, MARGIN + dy : h - MARGIN + dy, MARGIN + dx : w - MARGIN + dx]
                top &= (inner > other) if (dy, dx) < (0, 0) else (inner >= other)
    image, cy, cx = np.nonzero(top)
    strength = inner[image, cy, cx]
    cell = (image * (h // CELL + 1) + cy // CELL) * (w // CELL + 1) + cx // CELL
    order = np.lexsort((cx, cy, -strength, cell))
    _, first, counts = np.unique(cell[order], return_index=True, return_counts=True)
    kept = np.sort(order[np.arange(len(order)) - np.repeat(first, counts) < PER_CELL])
    return image[kept], cy[kept] + MARGIN, cx[kept] + MARGIN


def describe(stack: np.ndarray) -> list[dict[str, np.ndarray]]:
    """Corners of each image of a stack of equal size: ``y``, ``x`` (in full pixels),
    ``level``, ``turn`` (orientation in steps) and ``code`` (two 64-bit words)."""
    parts = []
    x = stack.astype(np.float32)
    dy, dx = np.mgrid[-PATCH : PATCH + 1, -PATCH : PATCH + 1]
    disc = dy * dy + dx * dx <= PATCH * PATCH
    dy, dx = dy[disc], dx[disc]
    for level in range(SCALES):
        if level:
            h, w = x.shape[1] // 2 * 2, x.shape[2] // 2 * 2
            x = (x[:, :h:2, :w:2] + x[:, 1:h:2, :w:2] + x[:, :h:2, 1:w:2] + x[:, 1:h:2, 1:w:2]) / 4
        if min(x.shape[1:]) < 2 * MARGIN + 3:
            break
        soft = _box(x)
        image, cy, cx = _corners(soft)
        patch = soft[image[:, None], cy[:, None] + dy, cx[:, None] + dx]
        patch = patch - patch.mean(axis=1, keepdims=True)
        angle = np.arctan2((patch * dy).sum(axis=1), (patch * dx).sum(axis=1))
        turn = np.rint(angle / (2 * np.pi) * TURNS).astype(np.int64) % TURNS
        at = PATTERNS[turn]
        first = soft[image[:, None], cy[:, None] + at[:, :, 0, 0], cx[:, None] + at[:, :, 0, 1]]
        second = soft[image[:, None], cy[:, None] + at[:, :, 1, 0], cx[:, None] + at[:, :, 1, 1]]
        bits = (first + CONTRAST < second).reshape(len(image), 2, 64)
        code = (bits * _BITS).sum(axis=2, dtype=np.uint64)
        # the middle of the pixels that a corner of a coarser scale stands for
        middle = (1 << level) // 2
        parts.append((image, (cy << level) + middle, (cx << level) + middle, np.full(len(image), level), turn, code))
    if not parts:
        parts = [tuple(np.zeros((0, 2) if k == 5 else 0, np.uint64 if k == 5 else np.int64) for k in range(6))]
    image, y, x_, level, turn, code = (np.concatenate(c) for c in zip(*parts, strict=True))
    return [{"y": y[m], "x": x_[m], "level": level[m], "turn": turn[m], "code": code[m]} for m in (image == k for k in range(len(stack)))]


def table_keys(found: dict[str, np.ndarray]) -> np.ndarray:
    """Keys of all Hamming tables of one image, as uint64.  A key comes once.

    A key takes one quarter of the descriptors of a corner and of two of its three nearest
    neighbours of the same scale, with their places in the corner's frame, in pixels of
    that scale: turned and halved copies have the same keys.  Corners whose quarter says
    next to nothing (flat patches) give none in that table."""
    out = []
    for level in np.unique(found["level"]):
        m = found["level"] == level
        y, x, turn, code = found["y"][m] / 2.0**level, found["x"][m] / 2.0**level, found["turn"][m], found["code"][m]
        n = len(y)
        if n < 3:
            continue
        quarters = np.stack([code[:, t % 2] >> np.uint64(32) if t < 2 else code[:, t % 2] & np.uint64(0xFFFFFFFF) for t in range(TABLES)], axis=1)
        near = np.empty((n, min(NEIGHBOURS, n - 1)), np.int64)
        for lo in range(0, n, 512):  # rows at a time, so memory grows with the corners only
            d = np.hypot(y[lo : lo + 512, None] - y, x[lo : lo + 512, None] - x)
            d[np.arange(len(d)), lo + np.arange(len(d))] = np.inf
            near[lo : lo + 512] = np.argsort(d, axis=1, kind="stable")[:, : near.shape[1]]
        spots = []
        for j in near.T:
            r = np.hypot(y[j] - y, x[j] - x)
            bearing = np.arctan2(y[j] - y, x[j] - x) - turn * (2 * np.pi / TURNS)
            spots.append(np.rint(r / 2).astype(np.uint64) * np.uint64(24) + (np.rint(bearing / (2 * np.pi) * 24).astype(np.int64) % 24).astype(np.uint64))
        said = np.bitwise_count(quarters) >= SAYING
        # any two of the nearest, so one lost neighbour does not lose all keys
        for a in range(near.shape[1]):
            for b in range(a + 1, near.shape[1]):
                place = mix(spots[a] * np.uint64(4096) + spots[b])
                salted = place[:, None] ^ (np.arange(TABLES, dtype=np.uint64) << np.uint64(40))
                keys = mix(mix(mix(salted ^ quarters) ^ quarters[near[:, a]]) ^ quarters[near[:, b]])
                out.append(keys[said])
    return np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)


def agreement(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> int:
    """Most matches that one turn, scale and shift agrees with."""
    if not len(a["y"]) or not len(b["y"]):
        return 0
    best, least = np.empty(len(a["y"]), np.int64), np.empty(len(a["y"]), np.int64)
    back, low = np.zeros(len(b["y"]), np.int64), np.full(len(b["y"]), 1 << 20)
    for lo in range(0, len(best), 256):  # rows at a time
        d = np.bitwise_count(a["code"][lo : lo + 256, None, :] ^ b["code"][None, :, :]).sum(axis=2, dtype=np.int64)
        best[lo : lo + 256], least[lo : lo + 256] = d.argmin(axis=1), d.min(axis=1)
        closer = d.min(axis=0) < low
        back[closer], low[closer] = d.argmin(axis=0)[closer] + lo, d.min(axis=0)[closer]
    i = np.flatnonzero((least <= HAMMING) & (back[best] == np.arange(len(best))))
    if not len(i):
        return 0
    j = best[i]
    pa_, pb = a["x"][i] + 1j * a["y"][i], b["x"][j] + 1j * b["y"][j]
    scale = 2.0 ** (b["level"][j] - a["level"][i])
    turn = np.exp(2j * np.pi * (b["turn"][j] - a["turn"][i]) / TURNS) * scale
    turn, slack = np.concatenate([turn, np.ones(len(i))]), PIXELS * np.maximum(1, np.concatenate([scale, np.ones(len(i))]))
    base = np.tile(np.arange(len(i)), 2)
    most = 0
    for lo in range(0, len(base), 512):  # each match's own turn, and none
        k = base[lo : lo + 512]
        guess = pb[k, None] + (pa_[None, :] - pa_[k, None]) * turn[lo : lo + 512, None]
        most = max(most, int((np.abs(guess - pb[None, :]) <= slack[lo : lo + 512, None]).sum(axis=1).max()))
    return most


def agreements(one: dict[str, np.ndarray], others: dict[str, np.ndarray], starts: np.ndarray) -> np.ndarray:
    """``agreement`` of one image with each of many, whose corners follow each other in
    ``others``, image by image from ``starts``; less than INLIERS counts as 0.  Every image
    has corners."""
    own = np.arange(len(others["y"])) - np.repeat(starts, np.diff([*starts, len(others["y"])]))
    back, low, found = np.zeros(len(own), np.int64), np.full(len(own), 255, np.uint8), []
    for lo in range(0, len(one["y"]), AT_ONCE):  # rows at a time
        code = one["code"][lo : lo + AT_ONCE]
        d = np.bitwise_count(code[:, :1] ^ others["code"][:, 0]) + np.bitwise_count(code[:, 1:] ^ others["code"][:, 1])
        best = np.minimum.reduceat((d.astype(np.int32) << 23) + own.astype(np.int32), starts, axis=1)
        i, k = np.nonzero(best < (HAMMING + 1) << 23)
        found.append((i + lo, k, starts[k] + (best[i, k] & ((1 << 23) - 1))))
        closer = d.min(axis=0) < low
        back[closer], low[closer] = d.argmin(axis=0)[closer] + lo, d.min(axis=0)[closer]
    i, k, j = (np.concatenate(x) for x in zip(*found, strict=True))
    mutual = back[j] == i
    i, k, j = i[mutual], k[mutual], j[mutual]
    times, out = np.bincount(k, minlength=len(starts)), np.zeros(len(starts), np.int64)
    edges = np.append(starts, len(own))
    for x in np.flatnonzero(times > MOST_MATCHES):
        out[x] = agreement(one, {name: v[edges[x] : edges[x + 1]] for name, v in others.items()})
    inner = (times >= INLIERS) & (times <= MOST_MATCHES)
    i, k, j = i[inner[k]], k[inner[k]], j[inner[k]]
    order = np.argsort(k, kind="stable")
    i, k, j = i[order], (np.cumsum(inner) - 1)[k[order]], j[order]
    counts = times[inner]
    at = np.arange(len(k)) - np.repeat(np.cumsum(counts) - counts, counts)
    # a row of matches an image, filled up with what agrees with nothing
    width = int(counts.max(initial=0))
    p, q, turn, slack = (np.full((len(counts), width), np.nan, kind) for kind in (complex, complex, complex, float))
    scale = 2.0 ** (others["level"][j] - one["level"][i])
    p[k, at], q[k, at] = one["x"][i] + 1j * one["y"][i], others["x"][j] + 1j * others["y"][j]
    turn[k, at] = np.exp(2j * np.pi * (others["turn"][j] - one["turn"][i]) / TURNS) * scale
    slack[k, at] = PIXELS * np.maximum(1, scale)
    step, most = max(1, (1 << 18) // max(1, width * width)), np.zeros(len(counts), np.int64)
    for lo in range(0, len(counts), step):
        m = slice(lo, lo + step)
        apart, there = p[m, None, :] - p[m, :, None], q[m, None, :] - q[m, :, None]
        for guess, room in ((apart * turn[m, :, None], slack[m, :, None]), (apart, PIXELS)):  # each match's own turn, and none
            most[m] = np.maximum(most[m], (np.abs(guess - there) <= room).sum(axis=2).max(axis=1))
    out[inner] = most
    return np.where(out >= INLIERS, out, 0)


def _joined(images: list[dict[str, np.ndarray]]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The corners of images after each other, and where each image's begin, and the last's end."""
    return {name: np.concatenate([f[name] for f in images]) for name in images[0]}, np.cumsum([0, *(len(f["y"]) for f in images)])


def image_links(images: list[dict[str, np.ndarray]], tiles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between places of images that agree, enough of them to reach what all reach; of
    two tiles only links across.  Every image has corners."""
    split = int(np.argmax(tiles != tiles[0]))  # 0: all of one tile
    whole, edges = _joined(images)
    label, heads, tails = np.arange(len(images)), [], []
    for i in range(split or len(images) - 1):
        first = split or i + 1
        if (label[first:] == label[i]).all():
            continue
        rest = {name: v[edges[first] :] for name, v in whole.items()}
        for j in first + np.flatnonzero(agreements(images[i], rest, edges[first:-1] - edges[first])):
            if label[i] != label[j]:
                label[label == label[j]] = label[i]
                heads.append(i)
                tails.append(j)
    return np.array(heads, np.int64), np.array(tails, np.int64)


FEATURES = "media_id long, y array<int>, x array<int>, level array<int>, turn array<int>, code array<long>, keys array<long>"


def features(media: DataFrame) -> DataFrame:
    """Corners, descriptors and table keys of ``media(media_id long, image binary)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                batch = whole.slice(lo, 256)
                images = [decode(b) for b in batch.column("image").to_pylist()]
                found: list[dict | None] = [None] * len(images)
                shapes: dict[tuple, list[int]] = {}
                for k, image in enumerate(images):
                    if image is not None:
                        shapes.setdefault(image.shape, []).append(k)
                for at in shapes.values():
                    for k, f in zip(at, describe(np.stack([images[k] for k in at])), strict=True):
                        found[k] = f
                cols = [[[] if f is None else f[name].astype(np.int32) for f in found] for name in ("y", "x", "level", "turn")]
                code = [[] if f is None else f["code"].reshape(-1).view(np.int64) for f in found]
                keys = [[] if f is None else table_keys(f).view(np.int64) for f in found]
                longs = [pa.array(c, pa.list_(pa.int64())) for c in (code, keys)]
                yield pa.RecordBatch.from_arrays([batch.column("media_id"), *(pa.array(c, pa.list_(pa.int32())) for c in cols), *longs], ["media_id", "y", "x", "level", "turn", "code", "keys"])

    return media.select(F.col("media_id").cast("long").alias("media_id"), "image").mapInArrow(run, FEATURES)


def copies(media: DataFrame, most: int = SMALL_KEY) -> DataFrame:
    """``(media_id, class_id, n_corners)`` of every row of ``media(media_id, image)``.

    ``class_id`` is the smallest media_id of the row's class.  Equal bytes are one class
    at once.  Images that cannot be read (only binary PGM and PPM can), null ones
    included, and images with too few corners stand alone (null images each by their id).
    Repeated rows each come back, of a media_id with several images each by its own; other
    columns are ignored, and an empty table gives none.
    """
    own = media.select(F.col("media_id").cast("long").alias("media_id"), "image", F.coalesce(F.sha2("image", 256), F.concat(F.lit("null:"), F.coalesce(F.col("media_id").cast("string"), F.lit("")))).alias("content"))
    rows = cut(own, "media")
    # a class is known by the smallest media_id of its bytes; several contents of one id are told apart
    reps = cut(rows.groupBy("content").agg(F.min("media_id").alias("first")).withColumn("node", F.xxhash64("content")), "contents")
    base = rows.join(reps, "content").where("media_id <=> first").dropDuplicates(["content"]).select(F.col("node").alias("media_id"), "image")
    feats = cut(features(base), "features")
    edges = key_links(feats, most)
    found = components(edges)
    whole = reps.join(found.select("node", "root"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    low = whole.groupBy("root").agg(F.min("first").alias("class_id"))
    known = cut(whole.join(low, "root").join(feats.selectExpr("media_id as node", "size(y) as n_corners"), "node", "left").select("content", "class_id", "n_corners"), "classes")
    return rows.select("media_id", "content").join(known, "content").select("media_id", "class_id", "n_corners")


def key_links(feats: DataFrame, most: int = SMALL_KEY, least_tile: int = LEAST_TILE) -> DataFrame:
    """Links ``(a, b)`` of images that share a key and agree, enough of them to reach
    whatever all such links reach.

    All images of a key of at most ``most`` are compared pair by pair.  Of a larger key,
    each image is compared with two leaders, then all pairs that those links leave apart,
    tile by tile, so a group is bounded and no pair is lost."""
    keyed = feats.select("media_id", F.explode("keys").alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    member = cut(keyed.join(sizes, "key"), "shared")
    few, many = member.where(F.col("n") <= most), member.where(F.col("n") > most)
    near = few.select("key", F.col("media_id").alias("a")).join(few.select("key", F.col("media_id").alias("b")), "key").where("a < b").select("a", "b")
    entry = F.struct(F.xxhash64("media_id", "key").alias("h"), F.col("media_id").alias("leader"))
    lead = many.groupBy("key").agg(F.array(F.min(entry), F.max(entry)).alias("l")).select("key", F.explode("l.leader").alias("leader"))
    led = many.join(lead, "key").where("media_id <> leader").select(F.least("leader", "media_id").alias("a"), F.greatest("leader", "media_id").alias("b"))
    pairs = cut(near.unionByName(led).distinct(), "pairs")
    fields = ("y", "x", "level", "turn", "code")
    side = lambda name: feats.select(F.col("media_id").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in fields])
    both = pairs.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b")

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = _features(batch, fields, "_a"), _features(batch, fields, "_b")
            ids, keep = batch.column("b").to_numpy(), []
            runs = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
            for lo, hi in zip(runs, runs[1:], strict=False):  # rows of one image follow each other
                whole, edges = _joined(left[lo:hi])
                keep += (agreements(right[lo], whole, edges[:-1]) > 0).tolist()
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches):
            a, b = image_links(_features(group, fields), group.column("tile").to_numpy())
            if len(a):
                ids = group.column("doc_id").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], ["a", "b"])

    linked = cut(both.mapInArrow(agree, "a long, b long"), "linked")
    large = many.join(known_parts(linked).withColumnRenamed("doc_id", "media_id"), "media_id", "left")
    corners = feats.select("media_id", F.size("y").cast("long").alias("size"))
    large = cut(large.join(corners, "media_id").select("key", F.col("media_id").alias("doc_id"), "size", F.coalesce("part", "media_id").alias("comp")), "members")
    groups = cut(band_groups(large, least_tile, TILE_CORNERS), "groups")
    grown = groups.join(feats.select(F.col("media_id").alias("doc_id"), *fields).hint("merge"), "doc_id").repartition("grp").sortWithinPartitions("grp", "tile")
    return linked.unionByName(grown.mapInArrow(compare, "a long, b long"))


def _features(batch: pa.RecordBatch | pa.Table, fields: tuple[str, ...], suffix: str = "") -> list[dict[str, np.ndarray]]:
    lists = [_lists(batch.column(c + suffix)) for c in fields]
    out = [dict(zip(fields, row, strict=True)) for row in zip(*lists, strict=True)]
    return [{k: v.astype(np.int64) if k != "code" else v.view(np.uint64).reshape(-1, 2) for k, v in f.items()} for f in out]


SIDE, SHAPES = 96, 16


def draw(vectors: np.ndarray) -> np.ndarray:
    """Grey pictures (SIDE x SIDE) of 64-dimensional vectors: each four numbers are the
    centre, the size and the brightness of a box, drawn one over the other."""
    u = 1 / (1 + np.exp(-12 * vectors.reshape(len(vectors), SHAPES, 4)))
    cx, cy = 6 + u[:, :, 0] * (SIDE - 12), 6 + u[:, :, 1] * (SIDE - 12)
    half = (4 + u[:, :, 2] * 9) * SIDE / 64
    shade = 20 + 215 * u[:, :, 3]
    out = np.full((len(vectors), SIDE, SIDE), 128, np.uint8)
    at = np.arange(SIDE)
    for k in range(SHAPES):
        across = np.abs(at - cx[:, k, None]) < half[:, k, None]
        down = np.abs(at - cy[:, k, None]) < half[:, k, None] * (0.6 + 0.05 * k)
        np.copyto(out, shade[:, k, None, None].astype(np.uint8), where=down[:, :, None] & across[:, None, :])
    return out


#: Ways in which pictures of the query are edited.
EDITS = ("crop", "quarter turn", "double", "half", "hard crop")


def edited(image: np.ndarray, how: int) -> np.ndarray:
    """A copy in the way that ``how`` says, with other brightness and contrast."""
    way, n = EDITS[how % len(EDITS)], how // len(EDITS)
    part = image.astype(np.float32)
    side = len(image)
    if way == "crop":
        a, b = 1 + n % 5, 2 + n % 4
        part = part[a : side - 6 + a, b : side - 8 + b]
    elif way == "quarter turn":
        part = np.rot90(part, 1 + n % 3)
    elif way == "double":
        part = np.kron(part, np.ones((2, 2), np.float32))
    elif way == "half":
        part = (part[::2, ::2] + part[1::2, ::2] + part[::2, 1::2] + part[1::2, 1::2]) / 4
    else:  # about half of the area stays
        a, b, keep = n % 3 * side // 8, (n + 1) % 3 * side // 8, side * 3 // 4
        part = part[a : a + keep, b : b + keep]
    return np.clip(part * (0.85 + 0.02 * (n % 10)) + 8 - n % 7, 0, 255).astype(np.uint8)


def pictures(embeddings: DataFrame) -> DataFrame:
    """``(media_id, image)``: a picture of every vector; each id that ends in 7 shows an
    edited copy of its predecessor's picture instead."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("media_id"), "embedding")
    earlier = rows.select((F.col("media_id") + 1).alias("media_id"), F.col("embedding").alias("other")).where("media_id % 10 = 7")
    joined = rows.join(earlier, "media_id", "left").select("media_id", F.coalesce("other", "embedding").alias("embedding"), F.col("other").isNotNull().alias("is_edit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                batch = whole.slice(lo, 256)
                ids = batch.column("media_id").to_pylist()
                vectors = np.array([np.resize(np.asarray(v if v is not None and len(v) else [0.0], np.float32), 64) for v in batch.column("embedding").to_pylist()])
                shown = zip(ids, draw(vectors), batch.column("is_edit").to_pylist(), strict=True)
                yield pa.RecordBatch.from_arrays([batch.column("media_id"), pa.array([encode(edited(p, k // 10) if e else p) for k, p, e in shown], pa.binary())], ["media_id", "image"])

    return joined.mapInArrow(run, "media_id long, image binary")


def op10_media_copies(spark, sf_dir: str) -> DataFrame:
    """Classes of copies among the pictures of all embeddings."""
    found = copies(pictures(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))
    return found.select(F.col("media_id").alias("doc_id"), "class_id", "n_corners")
