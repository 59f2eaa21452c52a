"""Joins of alike sets, differences of sources and spelling variants against brute force."""

import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from ledgerloom.llm import divergence, set_join, variants
from ledgerloom.llm.textbytes import buffers

from ..conftest import rows_of

ODD = "doc_id long, text string, lang string, source string, term string, word string, size long, row string, same string, n long"


def odd(spark, rows):
    """Rows (doc_id, text, lang, source) with other columns whose names clash."""
    return spark.createDataFrame([(*r, "t", "w", 1, "r", "s", 2) for r in rows], ODD)


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", low(text))
    return frozenset(" ".join(words[k : k + 3]) for k in range(len(words) - 2)) if len(words) > 2 else frozenset([" ".join(words)] if words else [])


# --- sets -------------------------------------------------------------------------------


def brute_join(rows):
    """Sorted (doc_id, size, component) of rows (doc_id, text)."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    ids = {}
    for k, (doc_id, _) in enumerate(rows):
        ids.setdefault(find(k), []).extend([] if doc_id is None else [doc_id])
    return sorted(((d, len(sets[k]), min(ids[find(k)], default=None) if sets[k] else d) for k, (d, _) in enumerate(rows)), key=str)


def families(seed=4):
    rng = random.Random(seed)
    rows, ids = [], iter(range(100, 9999))
    for size, members in ((9, 6), (10, 12), (14, 12), (20, 20), (45, 20), (130, 25), (400, 10)):
        base = [f"w{size}x{k}" for k in range(size + 2)]
        for _ in range(members):
            words = list(base)
            for _ in range(rng.choice((0, 1, 1, 2, max(1, size // 60)))):
                at = rng.randrange(len(words))
                words[at : at + rng.choice((0, 1, 1))] = [f"e{rng.randrange(50)}"] * rng.choice((0, 1, 1))
            rows.append((next(ids), " ".join(words)))
    return rows


FIXED = [(1, None), (2, ""), (3, " \n\t"), (4, "One Two"), (4, "one two"), (5, "two one"), (6, "a b c a b c"), (7, "A b c a b"), (None, "a b c a b c a"), (None, None), (8, "same id, two texts"), (8, "which are not alike at all"), (9, "word " * 60_000), (10, "word " * 30_000), (11, "é x y z"), (12, "É x y z")]


@pytest.mark.parametrize("deletions,spare,tile", [(None, 0, 128), (0, 0, 4), (-1, 0, 8), (1, 2, 8), (0, 3, 8)])
def test_jaccard_join(spark, deletions, spare, tile):
    rows = [*FIXED, *families()]
    docs = odd(spark, [(d, t, None, None) for d, t in rows])
    edges = set_join.band_edges(500) if deletions is not None else None
    plans = [set_join.Allocation(n, deletions, spare) if (n := set_join.most_differences(hi - 1, hi - 1)) else None for hi in edges[1:]] if edges else None
    found = set_join.join(docs, plans=plans, edges=edges, least_tile=tile)
    assert sorted(map(tuple, found.collect()), key=str) == brute_join(rows)


def test_jaccard_join_of_nothing(spark):
    assert set_join.join(odd(spark, []).where("false")).collect() == []


def test_allocations_reach_the_bound():
    for differences in range(1, 40):
        for spare in set_join.SPARES:
            for deletions in set_join.DELETIONS:
                plan = set_join.Allocation(differences, deletions, spare)
                assert plan.segments + plan.deletions >= differences + 1 + spare and plan.deletions <= plan.segments


def test_parities_never_exceed_differences():
    rng = np.random.default_rng(3)
    for n in (3, 40, 300, 3000):
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        b = np.concatenate([a[n // 10 :], rng.integers(0, 1 << 63, n // 12).astype(np.uint64)])
        x, y = (set_join.parity(h, set_join.most_differences(len(h), len(h))) for h in (a, b))
        words = min(len(x), len(y))
        assert np.bitwise_count(set_join.folded(x, words) ^ set_join.folded(y, words)).sum() <= len(np.setxor1d(a, b))


# --- differences of sources -------------------------------------------------------------


def brute_audit(rows, least):
    rows = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low(text))) for text, lang, source in rows]
    out = []
    for lang in {r[0] for r in rows}:
        docs = Counter(t for a, _, words in rows if a == lang for t in set(words))
        kept = {t for t, n in docs.items() if n >= least}
        counts = {s: Counter() for a, s, _ in rows if a == lang}
        for a, s, words in rows:
            if a == lang:
                counts[s].update(t for t in words if t in kept)
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in counts.items()}, share(sum(counts.values(), Counter()))
        for s in counts:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in counts if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, 50)):
                for rank, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                    out.append((lang, s, part, item, value, rank))
    return out


@pytest.mark.parametrize("bounds", [{}, {"shard_keys": 3, "most_bytes": 200, "dense_bytes": 100, "tile_sources": 2}])
def test_audit(spark, bounds):
    rng = random.Random(6)
    vocabulary = [f"t{'abcdefghij'[k % 10]}{'xyz'[k % 3]}{'é' * (k % 4)}" for k in range(60)] + ["Über", "über", "ß"]
    rows = [(" ".join(rng.choices(vocabulary, k=rng.randint(0, 40))) + "1,2", rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", "d", "e", None])) for _ in range(160)]
    rows += [(None, "en", "lone"), ("", "xx", "one"), (None, "xx", "two"), ("word " * 20_000, "yy", "s"), ("ties ties", "en", "a")]
    docs = odd(spark, [(None, *r) for r in rows])
    found = divergence.audit(docs, least_docs=4, **bounds)
    names = ["lang", "source", "part", "item", "value", "rank"]
    assert found.columns == names
    assert rows_of(names, found.collect()) == rows_of(names, brute_audit(rows, 4))
    assert divergence.audit(docs.where("false")).collect() == []


def test_perfect_hash():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 100, 4000):
        h = rng.integers(0, 1 << 63, n).astype(np.uint64)
        assert sorted(divergence.perfect_hash(h)[1]) == list(range(n))
    terms = [f"term{k}" for k in range(50)]
    data, at = buffers(__import__("pyarrow").array(terms))
    h = divergence.hashes_of(data, at[:-1], at[1:])
    h[7] = h[3]  # two keys of equal hash: both are found, by the stored keys
    moves, slots = divergence.perfect_hash(h)
    shards = divergence.Shards([{"shards": 1, "shard": 0, "terms": [terms[k] for k in np.argsort(slots)], "placed": 49, "moves": moves.tobytes()}])
    assert (shards.find(data, at[:-1], at[1:], h) == slots).all()
    other, to = buffers(__import__("pyarrow").array(["term51", "x"]))
    assert (shards.find(other, to[:-1], to[1:], h[:2]) == -1).all()


# --- spelling variants ------------------------------------------------------------------


def brute_variants(rows, one_in=199):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = low(run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    others = {w: [o for o in n if near(w, o)] for w in n}
    best = {w: min(o, key=lambda x: (-n[x], x), default=None) for w, o in others.items()}
    form = {w: b if b and n[b] >= 5 * n[w] else None for w, b in best.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return [(w, form[w], root(w), n[w], len(others[w]), n.get(form[w])) for w in n]


@pytest.mark.parametrize("one_in", [199, 3])
def test_variants(spark, one_in):
    rng = random.Random(8)
    words = ["letter", "letters", "lettre", "ledger", "ledgers", "aaaaaa", "aaaaaaa", "aaaaaaaa", "abababab", "babababa", "ababababa", "Übermut", "übermut", "ÿÿÿÿÿÿ", "straße×", "xxxxxx" * 40, "xxxxxx" * 40 + "y", "short"]
    for w in list(words):
        for _ in range(4):
            k = rng.randrange(len(w))
            words.append(w[:k] + rng.choice(["", "a", "é"]) + w[k + rng.choice((0, 1)) :])
    rows = [(rng.choice([k, None]), " ".join(rng.choices(words, weights=[rng.choice((1, 8, 60)) for _ in words], k=60)) + " 12-34") for k in range(120)]
    rows += [(1, None), (1, ""), (2, "chaina " * 5 + "chainb " * 25 + "chaincb " * 125), (3, "w" * 70_000 + " " + "w" * 70_000), *[(4, "v" * 5000 + "x"), (4, "v" * 5000)] * 6]
    found = variants.variants(odd(spark, [(*r, None, None) for r in rows]), one_in=one_in)
    names = ["word", "form", "root", "n", "n_near", "form_n"]
    assert found.columns == names
    assert rows_of(names, found.collect()) == rows_of(names, brute_variants(rows, one_in))


def test_variants_of_nothing(spark):
    assert variants.variants(odd(spark, []).where("false")).collect() == []
