"""The training-data operators against brute force, and their edge cases."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import decontaminate, langid, licenses, media, packing, registry, sharding, simhash, token_counts, toxicity, url_filter
from ledgerloom.llm.shared import components
from ledgerloom.llm.textbytes import buffers

from ..conftest import DATA, rows_of

SF = f"{DATA}/sf0.001"
needs_data = pytest.mark.skipif(not DATA.exists(), reason="no shared tables here")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, spans string, whole string, fp string"
LONG = "word " * 60_000


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows, clashing names."""
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "Hello world"), (4, "Hello world"), (5, LONG), (None, "no id"), (6, "1234 5678 !!"), (7, "漢字テキスト " * 50), (8, "é\u00a0<|endoftext|> x")]
    return spark.createDataFrame([(a, b, None, None, None, 0.5, "x", "y", "z") for a, b in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts_of(df):
    return [(r[0], r[1]) for r in df.select("doc_id", "text").collect()]


@needs_data
@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql(spark, duck, name):
    found = registry.queries()[name](spark, SF)
    want = duck("sf0.001").sql(registry.oracle_sql()[name])
    assert rows_of(found.columns, found.collect()) == rows_of(want.columns, want.fetchall())


# --- tokens -----------------------------------------------------------------------------

PARTS = ["a", "b ", "  ", "\n", " \n", "<|endoftext|>", "é", "1", "'s", "' ", " ", " x", "\x1c", " !!", "漢字", "\t", "word ", " The", "\u00a0", "\u3000", " é", "é "]


def random_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_piece_table_is_exact():
    texts = random_texts(3000)
    tok, table = token_counts.tokenizer(), token_counts.PieceTable(slots=1 << 8, flat=1 << 12)
    want = [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):  # cold and warm, with a table that overflows
        got = []
        for k in range(0, len(texts), 500):
            data, offsets = buffers(pa.array(texts[k : k + 500]))
            ids, edges = table.ids(data, offsets)
            got += [ids[a:b].tolist() for a, b in zip(edges, edges[1:], strict=False)]
        assert got == want


def test_splice_is_exact():
    tok = token_counts.tokenizer()
    for text in random_texts(400, 2) + ["x" * 500, "ab " * 300, " " * 90]:
        for chunk, overlap in ((20, 4), (7, 2), (64, 16)):
            got = [i for run in token_counts.spliced_ids(text, tok, chunk, overlap) for i in run]
            assert got == tok.encode(text, add_special_tokens=False).ids


def test_other_splitters_are_refused():
    import json

    file = json.loads(token_counts.tokenizer().to_str())
    assert token_counts.has_stable_boundaries(file)
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"added_tokens": [file["added_tokens"][0] | {"content": "a b"}]}):
        assert not token_counts.has_stable_boundaries(file | change)


def test_other_tokenizer_file_and_huge_texts():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    table = token_counts.PieceTable(path)
    texts = [*random_texts(100, 3), LONG]
    got = token_counts.row_counts(pa.array(texts), table, huge=200)
    assert got.tolist() == [len(e.ids) for e in table.tok.encode_batch(texts, add_special_tokens=False)]


@needs_data
def test_counts_and_packing(spark, docs, odd):
    tok = token_counts.tokenizer()
    for df in (docs, odd):
        want = sorted((k or -1, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for k, t in texts_of(df))
        assert sorted((r[0] or -1, r[1], r[2]) for r in token_counts.count_tokens(df).collect()) == want
        rows = packing.pack_documents(df).collect()
        assert len({r.sequence_id for r in rows}) == len(rows) and all(r.offset == 0 and r.length & (r.length - 1) == 0 and r.length <= 2048 and 1 << r.bucket == r.length for r in rows)
        back: dict = {}
        for r in sorted(rows, key=lambda r: (r.doc_id or -1, r.start)):
            back.setdefault(r.doc_id, {}).setdefault(r.start, []).append(np.frombuffer(r.ids, "<u4").tolist())
        for k, t in texts_of(df):
            ids = [i for start in sorted(back[k]) for i in back[k][start][0]]
            assert ids == [*tok.encode(t or "", add_special_tokens=False).ids, 1]
    own = {(r.doc_id, r.start): r for r in registry.queries()["op5_packing"](spark, SF).collect()}
    for r in packing.pack_documents(docs).limit(50).collect():
        assert own[r.doc_id, r.start].ids_crc32 == zlib.crc32(r.ids)
    with pytest.raises(ValueError):
        packing.pack_documents(docs, max_tokens=1000)
    assert packing.pack_documents(odd.where("false")).count() == token_counts.count_tokens(odd.where("false")).count() == 0


def test_binary_pieces():
    row, start, length = packing.binary_pieces(np.array([1, 5, 4097]), 2048)
    assert list(zip(row.tolist(), start.tolist(), length.tolist(), strict=True)) == [(0, 0, 1), (1, 0, 4), (1, 4, 1), (2, 0, 2048), (2, 2048, 2048), (2, 4096, 1)]


# --- SimHash ----------------------------------------------------------------------------


def slow_fingerprint(text):
    import xxhash

    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(x, 42) for x in [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(fps, radius):
    near = np.bitwise_count(fps[:, None] ^ fps[None]) <= radius
    label = np.full(len(fps), -1)
    for i in range(len(fps)):
        stack = [i] if label[i] < 0 else []
        while stack:
            u = stack.pop()
            if label[u] < 0:
                label[u] = i
                stack += np.flatnonzero(near[u] & (label < 0)).tolist()
    return label


@needs_data
def test_simhash(spark, docs, odd):
    for df in (docs, odd):
        pairs = sorted(texts_of(df), key=lambda x: (x[0] is None, x[0] or 0))
        fps = np.array([slow_fingerprint(t) for _, t in pairs], np.uint64)
        label = slow_components(fps, 2)
        want = sorted((k if k is not None else -1, format(int(f), "016x"), pairs[c][0]) for (k, _), f, c in zip(pairs, fps, label, strict=True))
        got = sorted((r[0] if r[0] is not None else -1, r[1], r[2]) for r in simhash.near_duplicates(df).collect())
        assert got == want


def test_tiles_lose_no_link(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    fps = np.unique(np.concatenate([b ^ (np.uint64(1) << rng.integers(0, 64, 60, dtype=np.uint64)) for b in base] + [base]))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    roots = {r.node: r.root for r in components(simhash.links(simhash.tile_groups(df, 2, least_tile=4), 2)).collect()}
    label = slow_components(fps, 2)
    for a in range(len(fps)):
        x, y = int(fps[a].view(np.int64)), int(fps[label[a]].view(np.int64))
        assert roots.get(x, x) == roots.get(y, y)
    assert len({roots.get(int(x), int(x)) for x in fps.view(np.int64)}) == len(set(label.tolist()))


def test_components(spark):
    chain = [(k, k + 1) for k in range(200)] + [(500, 501), (501, 502), (7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert len({found[k] for k in range(201)}) == 1 and len({found[k] for k in (500, 501, 502)}) == 1 and len(set(found.values())) == 2
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- decontamination --------------------------------------------------------------------


def slow_scan(text, items):
    word = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(ASCII_LOWER))
    w, hit, found = word(text), set(), set()
    for item, t in items:
        x = word(t)
        n = min(13, len(x))
        keys = {tuple(x[i : i + n]) for i in range(len(x) - n + 1)} if x else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in keys:
                hit |= set(range(i, i + n))
                found.add(item)
    return len(w), len(hit), sorted(found)


@needs_data
def test_decontamination(spark, odd):
    bench = [(1, "One two three"), (2, " ".join(f"w{k}" for k in range(20))), (3, None), (4, "!!"), (5, "hello WORLD"), (12, "Hello, world")]
    b = spark.createDataFrame(bench, "item_id long, text string")
    extra = [(20, "x " + " ".join(f"W{k}" for k in range(3, 17)) + ". one, two; three four"), (21, "one two"), (22, "one two three " * 3)]
    df = odd.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    want = sorted((k or -1, *slow_scan(t, bench)) for k, t in texts_of(df))
    for most in (1 << 20, 0):  # broadcast, and joined
        got = decontaminate.scan(df, b, most_bytes=most).collect()
        assert sorted((r[0] or -1, r[1], r[2], list(r[3])) for r in got) == want
    spans = {r.doc_id: r.spans for r in decontaminate.scan(df, b).collect()}
    joined = {r.doc_id: r.spans for r in decontaminate.scan(df, b, most_bytes=0).collect()}
    assert joined == spans
    assert extra[2][1].encode()[spans[22][0].start : spans[22][0].end] == b"one two three one two three one two three"
    none = decontaminate.scan(df, b.where("false")).collect()
    assert all(r.n_hit == 0 for r in none) and len(none) == len(want)
    own = {r.doc_id: r for r in registry.queries()["op6_decontamination"](spark, SF).collect()}
    assert all(r.items_sha256 == hashlib.sha256(b"").hexdigest() for r in own.values() if r.n_items == 0)


# --- licenses ---------------------------------------------------------------------------


def test_licenses(spark, odd):
    rng = random.Random(4)
    vocab = [f"v{k}" for k in range(500)]
    rows, want = [], set()
    for k in range(400):
        words = rng.choices(vocab, k=rng.randint(0, 300))
        if k % 2:
            name, _, notice = rng.choice(licenses.TEMPLATES)
            at = rng.randint(0, len(words))
            words[at:at] = [notice]
            want.add((k, name))
        rows.append((k, " ".join(words)))
    found = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.license) for r in found} == want
    texts = dict(rows)
    for r in found:
        assert r.containment == 1.0 and len(texts[r.doc_id].encode()[r.start : r.end]) > 10
    assert licenses.scan_licenses(odd).count() == 0 and licenses.scan_licenses(odd.where("false")).count() == 0
    changed = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and the documentation files (the Software), to deal in the Software without restriction"
    near = licenses.scan_licenses(spark.createDataFrame([(1, "x y " * 50 + changed)], "doc_id long, text string")).collect()
    assert [(r.license, 0.8 <= r.containment < 1) for r in near] == [("MIT", True)]
    with pytest.raises(ValueError):
        licenses.scan_licenses(odd, templates=[("X", "y", "two words")])


def test_license_beside_a_stronger_sibling(spark):
    by_name = {}
    for name, _, notice in licenses.TEMPLATES:
        by_name.setdefault(name, []).append(notice)
    filler = " ".join(f"w{k}" for k in range(200))
    weak = "under the GNU General Public License, version 2."
    strong = next(t for t in by_name["GPL-3.0"] if "General Public License" in t)
    texts = {1: f"{strong} {filler} {weak}", 2: f"{weak} {filler} {strong}", 3: f"{filler} {weak}"}
    found = licenses.scan_licenses(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    got = {(r.doc_id, r.license): r for r in found}
    assert {(1, "GPL-3.0"), (1, "GPL-2.0"), (2, "GPL-3.0"), (2, "GPL-2.0"), (3, "GPL-2.0")} == set(got)
    for k in (1, 2, 3):
        assert abs(got[k, "GPL-2.0"].start - texts[k].index(weak)) < 10 and got[k, "GPL-2.0"].containment < 1


def slow_licenses(text, templates, stretch, containment=0.8):
    """Matches by a window at every word, ``stretch`` times a template long, without bands."""
    word = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(ASCII_LOWER))
    grams = lambda w: [" ".join(w[i : i + 3]) for i in range(len(w) - 2)]
    own, found = grams(word(text)), []
    for name, _, notice in templates:
        want = set(grams(word(notice)))
        n = int(stretch * len(grams(word(notice))))
        for i in range(len(own)):
            share = len(want & set(own[i : i + n])) / len(want)
            if share >= containment - 1e-9 and own[i] in want:
                last = max(j for j in range(i, min(i + n, len(own))) if own[j] in want)
                found.append((share, i, last + 2, name))
    return found


def test_licenses_by_brute_force(spark):
    """Notices with words changed, dropped or added, against windows at every word."""
    rng = random.Random(11)
    vocab = [f"v{k}" for k in range(60)] + ["license", "the", "software", "under", "version"]
    texts = []
    for _ in range(150):
        words = rng.choices(vocab, k=rng.randint(0, 80))
        for _ in range(rng.randint(0, 2)):
            notice = rng.choice(licenses.TEMPLATES)[2].split()
            for _ in range(rng.randint(0, 2)):
                at = rng.randrange(len(notice))
                notice[at : at + rng.randint(0, 1)] = rng.choice([[], ["changed"]])
            at = rng.randint(0, len(words))
            words[at:at] = notice
        texts.append(" ".join(words))
    got = {k: set() for k in range(len(texts))}
    for r in licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        got[r.doc_id].add(r.license)
    # a class of templates shares windows, so a match may be somewhat longer than its template
    sure, most = ([slow_licenses(t, licenses.TEMPLATES, stretch) for t in texts] for stretch in (1, 1.8))
    n = 0
    for k in got:
        top = max((share for share, *_ in most[k]), default=0)
        strongest = {name for share, _, _, name in sure[k] if share == top}  # overlapped by nothing stronger
        assert strongest <= got[k] <= {name for *_, name in most[k]}
        n += len(strongest)
    assert n > 50


def test_band_guarantee():
    for j in (0.2, 0.5, 0.9):
        assert (1 - j) ** licenses.bands_needed(j, 1e-4) <= 1e-4


# --- sharding ---------------------------------------------------------------------------


def test_minimax():
    rng = random.Random(3)
    for _ in range(150):
        n, shards = rng.randint(1, 60), rng.randint(1, 8)
        groups = [(h, rng.choice([8, 9, 20, 100, 1000])) for h in sorted({rng.getrandbits(64) for _ in range(n)})]

        def ranges(bits, within=None, groups=groups):
            out = {}
            for h, s in groups:
                if within is None or h >> (64 - within[0].bits) in {r.prefix for r in within}:
                    out.setdefault(h >> (64 - bits), []).append((h, s))
            return [sharding.Range(p, bits, sum(s for _, s in v), v[0][0], v[-1][0]) for p, v in sorted(out.items())]

        def refine(rs):
            return [x for b in sorted({r.bits for r in rs}) for x in ranges(b + 2, [r for r in rs if r.bits == b])]

        def cuts(c, groups=groups):
            out, fill = [], 0
            for h, s in groups:
                if s > c:
                    return None
                if fill + s > c:
                    out.append(h)
                    fill = 0
                fill += s
            return out

        sums = sorted({sum(s for _, s in groups[i:j]) for i in range(n) for j in range(i + 1, n + 1)})
        best = next(c for c in sums if cuts(c) is not None and len(cuts(c)) < shards)
        assert sharding.minimax(refine, ranges(2), shards) == (best, cuts(best))


@needs_data
def test_sharding(spark, docs, odd):
    for df in (docs, odd, odd.where("false")):
        rows = sharding.shard_documents(df, 5).collect()
        pairs = texts_of(df)
        want = sorted((k or -1, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for k, t in pairs)
        assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in rows) == want
        slots: dict = {}
        for r in rows:
            slots.setdefault(r.shard, []).append(r.slot)
            assert 0 <= r.shard < 5
        assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    shard = {r.doc_id: r.shard for r in sharding.shard_documents(docs, 5).collect()}
    by_text: dict = {}
    for k, t in texts_of(docs):
        by_text.setdefault(t, set()).add(shard[k])
    assert all(len(v) == 1 for v in by_text.values())


# --- language ---------------------------------------------------------------------------


@needs_data
def test_language(spark, docs, odd):
    prototypes = langid.train(docs.where(~langid.held_out()))
    found = {r.doc_id: r for r in langid.predict(docs, prototypes).collect()}
    truth = [(r.doc_id, r.lang) for r in docs.where(langid.held_out()).collect() if r.lang]
    assert np.mean([found[k].lang_pred == lang for k, lang in truth]) > 0.97
    rows = langid.predict(odd, prototypes, carry=True).collect()
    assert len(rows) == 10 and {r.doc_id for r in rows if r.lang_pred == "und"} == {1, 2, 3, 6}
    assert all(0 <= r.score <= 1 for r in rows) and all(r.score == 0 for r in rows if r.lang_pred == "und") and rows[0].whole.fp == "z"
    assert langid.train(odd) == {} and all(r.lang_pred == "und" for r in langid.predict(odd, {}).collect())


def test_hypervectors():
    enc = langid.Encoder()
    (v, w), n = enc.vectors(["ab", "AB ba"])
    keys = [(0, ord("a"), ord("b")), (ord("a"), ord("b"), 0)]
    slow = sum(np.roll(enc.letter(a), 2) * np.roll(enc.letter(b), 1) * enc.letter(c) for a, b, c in keys)
    assert (v == slow).all() and n.tolist() == [2, 4] and not (v == w).all()


def test_long_texts_in_a_large_script():
    """A long text is bundled a stretch at a time, with the same sum, in little memory."""
    rng = random.Random(7)
    text = "".join(rng.choice("abcé .,1漢字テ") for _ in range(5000)) + "  . "
    enc = langid.Encoder()
    want, n = enc.vectors([text])
    old, langid.CHARS_AT_ONCE = langid.CHARS_AT_ONCE, 37
    try:
        got, m = enc.vectors([text])
    finally:
        langid.CHARS_AT_ONCE = old
    assert (got == want).all() and n.tolist() == m.tolist()
    import tracemalloc

    large = "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(100_000))
    tracemalloc.start()
    enc.vectors([large])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20


# --- toxicity ---------------------------------------------------------------------------


def slow_marginals(score, first, move, start):
    """By enumeration, chain by chain."""
    from itertools import product

    out, at = [], 0
    edges = [*np.flatnonzero(first).tolist(), len(score)]
    for lo, hi in zip(edges, edges[1:], strict=False):
        n, total, on = hi - lo, 0.0, np.zeros(hi - lo)
        for ys in product((0, 1), repeat=n):
            p = start[ys[0]]
            for k, y in enumerate(ys):
                p *= np.exp(score[lo + k]) if y else 1.0
                p *= move[ys[k - 1], y] if k else 1.0
            total += p
            on += p * np.array(ys)
        out += (on / total).tolist()
        at = hi
    assert at == len(score)
    return np.array(out)


def test_marginals():
    rng = np.random.default_rng(2)
    first = np.zeros(150, bool)
    first[[0, 1, 9, 12, 20, 29, 38, 47, 56, 60, 70, 79, 88, 97, 106, 115, 124, 133, 142]] = True
    score = rng.normal(0, 2, 150)
    move, start = np.array([[1.0, 0.3], [0.7, 1.4]]), np.array([1.0, 0.2])
    assert np.allclose(toxicity.marginals(score, first, move, start)[0], slow_marginals(score, first, move, start))


def toxic_rows(n=1500, seed=5):
    rng = random.Random(seed)
    syllables = ["tha", "in", "er", "sho", "re", "li", "ot", "mi", "ka"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    rows = []
    for k in range(n):
        words, bad = [word() for _ in range(rng.randint(5, 80))], int(k % 6 == 0)
        if bad:
            for _ in range(rng.randint(1, 5)):
                words.insert(rng.randint(0, len(words)), rng.choice(["Zilch", "vexu" + word(), "gronk!"]))
        rows.append((k, " ".join(words), bad))
    return rows


def test_toxicity(spark, odd):
    rows = toxic_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(df, df.where(~toxicity.held_out()))
    found = {r.doc_id: r for r in toxicity.score(df, model).collect()}
    test = [(k, y) for k, t, y in rows if zlib.crc32(str(k).encode()) % 4 == 2]
    got = np.array([(found[k].score >= toxicity.THRESHOLD, y) for k, y in test])
    assert got[got[:, 1] == 1, 0].mean() > 0.97 and got[got[:, 1] == 0, 0].mean() < 0.02
    k = next(k for k, y in test if y and found[k].spans)
    marked = [rows[k][1].encode()[s.start : s.end].decode() for s in found[k].spans]
    assert marked and all(m.startswith(("Zilch", "vexu", "gronk")) for m in marked)
    out = toxicity.score(odd, model, carry=True).collect()
    assert len(out) == 10 and all(0 <= r.score < toxicity.THRESHOLD for r in out) and out[0].whole.fp == "z"
    empty = toxicity.train(df, df.where("false"))
    assert all(0 <= r.score <= 1 for r in toxicity.score(odd, empty).collect())


# --- urls -------------------------------------------------------------------------------

URLS = ["http://example.com/en/1", "https://a.Example.COM/en/", "http://www.example.com/en/x?q", "http://www.example.com/fr", "http://x.net/es/1", "http://x.net/es", "http://xnet/es/", "http://com", "http://com/", None, "", "no url", "ftp://b.net/fr/#a", "://net/fr/", "http://example.com:80/en/", "http://u@example.com/en/a\nb", "http://İ.com/x", "http://a//b://c.net/es/"]


def slow_judge(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.translate(ASCII_LOWER)
    fits = [(len(r), r, v) for v, r in rules if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return (host, path, *(max(fits)[1:] if fits else (None, default)))


def test_urls(spark):
    rng = random.Random(6)
    many = tuple({f"{h}{p}": (rng.choice(["allow", "block"]), f"{h}{p}") for h in ("com", "a.com", "b.a.com", "net") for p in ("/", "/x", "/x/", "/x/y", "/xy/z/")}.values())
    urls = URLS + [f"http://{h}{p}" for h in ("com", "a.com", "c.a.com", "b.a.com", "q.b.a.com", "net") for p in ("", "/", "/x", "/x/", "/xy/z/w", "/x/yz", "/x/y/z", "/w")]
    df = spark.createDataFrame([(k, u, "page", "clash") for k, u in enumerate(urls)] + [(0, urls[0], None, None)], "page_id long, url string, html string, rule string")
    twice = (("block", "a.com/x"), ("allow", "a.com/x"), ("allow", "net/"), ("block", "net/"))
    for rules in (url_filter.RULES, many, twice, ()):
        want = sorted((k, *slow_judge(u, rules)) for k, u in [*enumerate(urls), (0, urls[0])])
        for most in (100, 0) if rules else (100,):
            got = sorted(tuple(r) for r in url_filter.judge(df, rules, most=most).collect())
            assert [tuple(x or "" for x in g) for g in got] == [tuple(x or "" for x in w) for w in want]
    assert url_filter.judge(df.where("false")).count() == 0
    long = spark.createDataFrame([(1, "http://" + "a." * 5000 + "com/" + "x/" * 50_000)], "page_id long, url string")
    assert [url_filter.judge(long, most=m).first().verdict for m in (100, 0)] == ["allow", "allow"]


def test_urls_of_a_host_with_many_rules(spark):
    """Rules of one host cost a url no more than the lengths that they have."""
    rules = tuple(("block", f"example.com/x{k:05d}") for k in range(50_000)) + (("allow", "example.com/x0001"),)
    trie = url_filter.Trie(rules)
    began = time.perf_counter()
    found = [trie.match("www.example.com", f"/x{k:05d}/page") for k in range(2000)]
    assert (time.perf_counter() - began) / 2000 < 0.0005 and all(v == "block" for _, v in found)
    assert trie.match("example.com", "/x0001") == ("example.com/x0001", "allow") and trie.match("example.com", "/y") is None
    urls = [f"http://{'a.' * (k % 2)}example.com/x{k % 400:05d}/{k}" for k in range(4000)] + ["http://example.com/x0001", "http://other.com/x00001"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    want = sorted((k, *(trie.match(*url_parts) or (None, "allow"))) for k, url_parts in ((k, (u[7:].split("/")[0], "/" + u[7:].split("/", 1)[1])) for k, u in enumerate(urls)))
    got = sorted((r.page_id, r.rule, r.verdict) for r in url_filter.judge(df, rules, most=10).collect())
    assert got == want


# --- media ------------------------------------------------------------------------------


def test_media(spark):
    rng = np.random.default_rng(8)
    vectors = rng.normal(0, 0.13, (120, 64)).astype(np.float32)
    plain = media.draw(vectors)
    rows = [(k, media.encode(plain[k])) for k in range(120)]
    for way in range(len(media.EDITS)):  # every kind of edit, each of a dozen pictures
        rows += [(1000 + 100 * way + k, media.encode(media.edited(plain[k], len(media.EDITS) * k + way))) for k in range(0, 96, 8)]
    rows += [(2000 + k, media.encode(plain[k])) for k in range(0, 120, 10)] + [(5, media.encode(plain[5]))]  # equal bytes, a repeated row
    colour = np.repeat(plain[7][:, :, None], 3, axis=2)
    rows += [(2500, b"P6\n# by hand\n%d %d\n255\n" % plain[7].shape[::-1] + colour.tobytes())]
    rows += [(3000, None), (3001, None), (3002, b"no image"), (3003, b"P5 9 9 255\n" + bytes(81)), (3004, media.encode(np.full((64, 64), 7)))]
    rows += [(4000, media.encode(plain[100])), (4000, media.encode(plain[101]))]  # one id, two images
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "media_id long, image binary, key string, n_corners int")
    found: dict = {}
    for r in media.copies(df).collect():
        found.setdefault(r.media_id, []).append(r.class_id)
    assert len(found[5]) == 2 and sorted(found[4000]) == [100, 101]
    one = {k: v[0] for k, v in found.items()}
    for way, name in enumerate(media.EDITS):
        assert np.mean([one[1000 + 100 * way + k] == k for k in range(0, 96, 8)]) >= 0.9, name
    assert all(one[2000 + k] == k for k in range(0, 120, 10)) and one[2500] == 7
    assert all(one[k] == k for k in [*range(120), 3000, 3001, 3002, 3003, 3004])
    assert media.copies(df.where("false")).count() == 0


def brute_classes(images):
    """Classes of all pairs that agree, whether they share a key or not."""
    found = [media.describe(x[None])[0] for x in images]
    label = list(range(len(images)))
    for i in range(len(images)):
        for j in range(i):
            if media.agreement(found[i], found[j]) >= media.INLIERS and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label


@pytest.mark.parametrize(("most", "tile"), [(16, 128), (3, 4)])
def test_media_against_all_pairs(spark, most, tile):
    """Also where most keys are hot: a mark of its own on a third of the pictures."""
    rng = np.random.default_rng(4)
    images = list(media.draw(rng.normal(0, 0.13, (36, 64)).astype(np.float32)))
    mark = (np.add.outer(np.arange(20) // 5, np.arange(20) // 5) % 2 * 200 + 20).astype(np.uint8)
    for k in range(0, 36, 3):
        images[k][10:30, 10:30] = mark
    images += [media.edited(images[k], 5 * k + k % 5) for k in range(1, 36, 3)]
    want = brute_classes(images)
    base = spark.createDataFrame([(k, media.encode(x)) for k, x in enumerate(images)], "media_id long, image binary")
    links = media.key_links(media.features(base), most, tile)
    root = {r.node: r.root for r in components(links).collect()}
    got = [root.get(k, k) for k in range(len(images))]
    same = [(got[a] == got[b], want[a] == want[b]) for a in range(len(images)) for b in range(a)]
    assert all(y for x, y in same if x)  # nothing is linked that does not agree
    assert np.mean([x for x, y in same if y]) >= 0.95


@pytest.mark.parametrize(("most", "tile"), [(16, 128), (3, 4), (64, 4)])
def test_every_pair_of_a_large_key(spark, most, tile):
    """Copies whose only shared key is one that all images have, though their corners differ."""
    rng = np.random.default_rng(6)
    images = list(media.draw(rng.normal(0, 0.13, (24, 64)).astype(np.float32)))
    images += [media.edited(images[k], 5 * k + k % 5) for k in range(0, 24, 2)]
    want = brute_classes(images)
    base = spark.createDataFrame([(k, media.encode(x)) for k, x in enumerate(images)], "media_id long, image binary")
    feats = media.features(base).selectExpr("*", "array(1L) as one").drop("keys").withColumnRenamed("one", "keys")
    root = {r.node: r.root for r in components(media.key_links(feats, most, tile)).collect()}
    got = [root.get(k, k) for k in range(len(images))]
    assert all((got[a] == got[b]) == (want[a] == want[b]) for a in range(len(images)) for b in range(a))
    assert len(set(want)) <= 25  # nearly all copies agree with their originals


def test_agreement():
    rng = np.random.default_rng(9)
    stack = media.draw(rng.normal(0, 0.13, (2, 64)).astype(np.float32))
    a, b = media.describe(stack)
    turned = media.describe(np.rot90(stack, axes=(1, 2)))[0]
    assert media.agreement(a, a) >= 10 and media.agreement(a, b) < media.INLIERS and media.agreement(a, turned) >= media.INLIERS


def test_agreements():
    """One image against many at once, with few matches and with many."""
    rng = np.random.default_rng(9)
    images = list(media.draw(rng.normal(0, 0.13, (12, 64)).astype(np.float32)))
    images += [media.edited(images[0], way) for way in range(20)]
    images += [np.kron(rng.integers(0, 255, (40, 40)), np.ones((8, 8))).astype(np.uint8)]
    found = [media.describe(x[None])[0] for x in images]
    found.append(found[-1])
    whole, edges = media._joined(found)
    for x in (*found[:3], found[15], found[-1]):
        want = [media.agreement(y, x) for y in found]
        assert media.agreements(x, whole, edges[:-1]).tolist() == [n if n >= media.INLIERS else 0 for n in want]
    assert max(want) > media.MOST_MATCHES


def test_corners_grow_with_the_area():
    rng = np.random.default_rng(10)
    large = np.kron(rng.integers(0, 255, (64, 64)), np.ones((8, 8))).astype(np.uint8)
    whole, quarter = media.describe(large[None])[0], media.describe(large[None, :256, :256])[0]
    assert 3 * len(quarter["y"]) < len(whole["y"]) < 6 * len(quarter["y"])
    assert media.agreement(whole, quarter) >= 50
