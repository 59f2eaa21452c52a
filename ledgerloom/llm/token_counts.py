"""Exact token counts and ids of a byte-level BPE vocabulary, in bounded memory.

Two exact shortcuts carry the work.  Both rest on one fact about the byte-level
splitter: a space between two characters that are no white space always starts a new
pre-token, merges never cross pre-tokens, and the vocabulary's special strings hold no
space.  Such a space is a *stable boundary*: the ids on its two sides do not depend on
each other.

* ``PieceTable`` encodes texts piece by piece between stable boundaries and remembers
  the ids of recent short pieces, which are most of any text.
* ``spliced_ids`` encodes a huge text as overlapping chunks and splices neighbours at a
  stable boundary at which both have a token boundary; where an overlap has none, it is
  widened until one is found or the chunk reaches the text's end.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import with_defaults
from .textbytes import buffers, chunks, mix

#: Texts of more bytes than this are encoded in overlapping chunks.
HUGE_BYTES = 65_536
CHUNK_CHARS = 32_768
OVERLAP_CHARS = 256
#: Slots of a worker's table of pieces (40 bytes each) and ids it may hold.
SLOTS = 1 << 21
FLAT_IDS = 1 << 24
#: Pieces of at most this many bytes are remembered.
KEY_BYTES = 32


@cache
def tokenizer(path: str | None = None):
    """The tokenizer file at ``path`` (the 50k byte-level BPE where none is given)."""
    import public_tokenizers
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path or public_tokenizers.path("byte_bpe_50k.json"))
    found.no_padding()
    found.no_truncation()
    if not has_stable_boundaries(json.loads(found.to_str())):
        raise ValueError("the file needs the byte-level splitter, no normalizer, and special strings without white space")
    return found


def has_stable_boundaries(file: dict) -> bool:
    """Whether a space between two characters that are no white space always parts pre-tokens."""
    splitter = file.get("pre_tokenizer") or {}
    known = splitter.get("type") == "ByteLevel" and splitter.get("use_regex") and not splitter.get("add_prefix_space")
    plain = all(not t["lstrip"] and not t["rstrip"] and not t["single_word"] and not any(map(str.isspace, t["content"])) for t in file["added_tokens"])
    return bool(known and plain and not file.get("normalizer"))


@cache
def encoder(path: str | None = None):
    """A function from texts to id arrays, with the results of ``tokenizer(path)``.

    For the default vocabulary tiktoken does it: the same vocabulary as ranks, with the
    same splitter and special strings, gives the same ids in about a fifth of the time
    (tests hold both against each other).  Other files go through tokenizers.
    """
    tok = tokenizer(path)
    if path:
        return lambda texts: [np.asarray(x.ids, np.uint32) for x in tok.encode_batch_fast(texts, add_special_tokens=False)]
    import base64

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    special = {t.content: k for k, t in tok.get_added_tokens_decoder().items()}
    fast = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return lambda texts: [fast.encode_to_numpy(t, allowed_special="all") for t in texts]


def token_widths(tok) -> np.ndarray:
    """Bytes that each id of a byte-level vocabulary stands for."""
    vocab = tok.get_vocab(with_added_tokens=True)
    special = {t.content: len(t.content.encode()) for t in tok.get_added_tokens_decoder().values()}
    out = np.zeros(max(vocab.values()) + 1, np.int64)
    for token, k in vocab.items():  # one character of a token's name stands for one byte
        out[k] = special.get(token, len(token))
    return out


def _byte_sets() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First bytes that surely begin, last bytes that surely end, and leads of two-byte
    characters that surely are no white space."""
    begin, end, lead = (np.zeros(256, bool) for _ in range(3))
    begin[0x21:0x7F] = end[0x21:0x7F] = lead[0xC3:0xE0] = True
    begin[0xC3:0xE0] = begin[0xE4:0xF5] = True  # none of U+0085, U+00A0, U+1680, U+2000.., U+3000
    return begin, end, lead


_BEGIN, _END, _LEAD = _byte_sets()
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def stable_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per byte, whether a row or a stable boundary begins there."""
    n = len(data)
    mark = np.zeros(n + 1, bool)
    if n > 2:
        at = np.flatnonzero(data[1:-1] == 32) + 1
        before = data[at - 1]
        ends = _END[before] | ((before >= 0x80) & (before < 0xC0) & _LEAD[data[np.maximum(at - 2, 0)]])
        row_first = np.zeros(n + 1, bool)
        row_first[offsets] = True
        at = at[ends & _BEGIN[data[at + 1]] & ~row_first[at] & ~row_first[at + 1]]
        mark[at] = True
    mark[offsets[:-1]] = True
    return mark[:n]


class PieceTable:
    """Token ids of texts, with a direct-mapped table of recent pieces.

    A slot keeps a piece's bytes themselves, so a hit is exact, not probable.  Memory is
    bounded: slots are overwritten, and the table starts afresh when its ids are full.
    """

    def __init__(self, path: str | None = None, slots: int = SLOTS, flat: int = FLAT_IDS):
        self.tok, self.encode, self.slots, self.most = tokenizer(path), encoder(path), slots, flat
        self.width = token_widths(self.tok)
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros((self.slots, KEY_BYTES // 8), np.uint64)
        self.at = np.zeros(self.slots, np.int64)
        self.size = np.zeros(self.slots, np.int32)
        self.flat, self.used = np.zeros(self.most, np.uint32), 0

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, and row offsets into them."""
        n = len(data)
        starts = np.flatnonzero(stable_starts(data, offsets))
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        ends = np.append(starts[1:], n)
        sizes = ends - starts
        padded = np.concatenate([data, np.zeros(KEY_BYTES + 8, np.uint8)])
        wide = np.ndarray((n + KEY_BYTES,), "<u8", padded, strides=(1,))
        keys = np.empty((len(starts), KEY_BYTES // 8), np.uint64)
        h = np.zeros(len(starts), np.uint64)
        for k in range(KEY_BYTES // 8):
            keys[:, k] = wide[np.minimum(starts + 8 * k, n)] & _MASKS[np.clip(sizes - 8 * k, 0, 8)]
            h = mix(h ^ keys[:, k])
        slot = (h & np.uint64(self.slots - 1)).astype(np.int64)
        short = sizes <= KEY_BYTES
        hit = short & (self.size[slot] > 0) & (self.keys[slot] == keys).all(axis=1)
        miss = np.flatnonzero(~hit)
        at, count = self.at[slot], self.size[slot].astype(np.int64)
        fresh, counts = self._encode(data, starts, ends, miss, offsets)
        if self.used + len(fresh) > self.most:
            kept, self.most = self.flat[: self.used].copy(), max(self.most, 2 * len(fresh))
            self.clear()
            source = np.concatenate([kept, fresh])
            base = len(kept)
        else:
            self.flat[self.used : self.used + len(fresh)] = fresh
            source, base = self.flat, self.used
            first = base + np.cumsum(counts) - counts
            keep = short[miss]
            put = miss[keep]
            self.keys[slot[put]], self.at[slot[put]], self.size[slot[put]] = keys[put], first[keep], counts[keep]
            self.used += len(fresh)
        at[miss], count[miss] = base + np.cumsum(counts) - counts, counts
        reach = np.cumsum(count)
        index = np.arange(reach[-1]) + np.repeat(at - (reach - count), count)
        edges = np.concatenate([[0], reach])[np.searchsorted(starts, offsets)]
        return source[index], edges

    def _encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, miss: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces ``miss`` one after the other, and how many each has.

        Pieces that follow a stable boundary are encoded many at once, since each would
        follow one again; the first piece of a row starts a text of its own.
        """
        if not len(miss):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        raw, s, e = data.tobytes(), starts[miss], ends[miss]
        apart = np.isin(s, offsets)  # begins a row
        tail = ~_END[data[e - 1]] & np.isin(e, offsets)  # ends a row, perhaps in white space
        cut = apart.copy()
        cut[1:] |= tail[:-1]
        cut[::2000] = True
        first = np.flatnonzero(cut)
        parts = [raw[x:y] for x, y in zip(s.tolist(), e.tolist(), strict=True)]
        texts = [b"".join(parts[x:y]).decode() for x, y in zip(first.tolist(), [*first[1:].tolist(), len(parts)], strict=True)]
        ids = np.concatenate(self.encode(texts)).astype(np.uint32)
        edges = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum(e - s), "left") + 1
        return ids, np.diff(edges, prepend=0)


def stable(text: str, at: int) -> bool:
    """True if a stable boundary lies before character ``at``."""
    return 0 < at < len(text) - 1 and text[at] == " " and not text[at - 1].isspace() and not text[at + 1].isspace()


def spliced_ids(text: str, tok, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> Iterator[list[int]]:
    """Runs of ids whose concatenation is the ids of the whole text.

    ``tok.encode`` gives ids and character offsets.  At most two chunks are held.
    """
    n, begin = len(text), 0  # text[:begin] is done and begin is 0 or a stable boundary
    while begin < n:
        end, wide = min(n, begin + chunk), overlap
        while True:
            left = tok.encode(text[begin:end], add_special_tokens=False)
            if end == n:
                yield left.ids
                return
            meet = _splice(text, tok, left, begin, end, wide)
            if meet:
                count, begin = meet
                yield left.ids[:count]
                break
            wide *= 2
            end = min(n, end + wide)


def _splice(text: str, tok, left, begin: int, end: int, wide: int) -> tuple[int, int] | None:
    """(ids of ``left`` to keep, where the next chunk begins), or None if nothing aligns."""
    low = max(begin + 1, end - wide)
    marks = [p for p in range(low, end) if stable(text, p)]
    if not marks:
        return None
    right = tok.encode(text[marks[0] : min(len(text), end + wide)], add_special_tokens=False)
    starts = {s + marks[0] for s, _ in right.offsets}
    at = {s + begin: k for k, (s, _) in reversed(list(enumerate(left.offsets)))}
    for p in marks:  # a boundary counts only if both encodings start a token there
        if p in starts and p in at:
            return at[p], p
    return None


def row_counts(column: pa.Array, table: PieceTable, huge: int = HUGE_BYTES) -> np.ndarray:
    """Tokens of each text of a column: huge ones spliced, the others from the table."""
    data, offsets = buffers(column)
    sizes = np.diff(offsets)
    out = np.zeros(len(sizes), np.int64)
    for k in np.flatnonzero(sizes > huge):
        text = data[offsets[k] : offsets[k + 1]].tobytes().decode()
        out[k] = sum(map(len, spliced_ids(text, table.tok)))
    for lo, hi in chunks(offsets):
        small = np.flatnonzero(sizes[lo:hi] <= huge) + lo
        if len(small):
            part = np.concatenate([data[offsets[k] : offsets[k + 1]] for k in small])
            out[small] = np.diff(table.ids(part, np.concatenate([[0], np.cumsum(sizes[small])]))[1])
    return out


def count_tokens(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens)`` of every row of ``docs(doc_id, text)``.

    Narrow: one Python pass, no shuffle.  A null or empty text has 0 of both; repeated
    rows give repeated results; other columns are ignored; an empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = PieceTable(tokenizer_path)
        for batch in batches:
            counts = row_counts(batch.column("text"), table)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    src = with_defaults(docs, doc_id="long", text="string").withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    return src.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")


def op9_token_counts(spark, sf_dir: str) -> DataFrame:
    """Token counts of all documents, with the 1024-token limit."""
    counted = count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)
