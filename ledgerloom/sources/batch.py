"""Charge files in bulk: heads, ranges and records are read in tasks, and what is wrong with a
file is a row, not the end of the batch.

A plan of ranges (file, start, end) is dealt to tasks.  A delimited file of many ranges is
first scanned for quotes: each range says in which state (inside a quoted cell or not) it
ends for either state in which it may begin; the states are composed per file, so each range
then starts at a true record.  A nested file is split at its items while it is streamed.
Gzip and UTF-16 files are one range.  No bytes of a file pass the driver, and a task holds
one record, or a piece of a file, at a time.
"""

from __future__ import annotations

import csv
import re
import sys
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import source_name
from .charges import HEAD_BYTES, ITEM, JSON_SCHEMA, SUPPORTED, profile

#: Bytes of a range, of a piece that is read at once, and of the longest record: a file with
#: a longer one (a quote that is never closed) is refused.
RANGE_BYTES, PIECE_BYTES, RECORD_BYTES = 128 << 20, 1 << 20, 64 << 20
#: Rows of a result batch; fields of the widest record that is not taken for damage.
ROWS_AT_ONCE, MOST_FIELDS = 2000, 200_000
ITEMS = b"standard_charge_information"


class BadFile(Exception):
    """What is wrong with a file, in words."""


def opened(path: str):
    """A seekable stream of a file, by Arrow's file systems (local, HDFS, S3, GCS, Azure)."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file(re.sub("^file:/*", "/", path))
    system, at = fs.FileSystem.from_uri(path)
    return system.open_input_file(at)


def pieces(path: str, start: int = 0) -> Iterator[bytes]:
    """The bytes of a file from ``start`` on, unzipped where its name says so."""
    with opened(path) as stream:
        zipped = path.lower().endswith(".gz")
        if start:
            stream.seek(start)
        inflate = zlib.decompressobj(31) if zipped else None
        try:
            while raw := stream.read(PIECE_BYTES):
                while raw:
                    if inflate is None:
                        yield raw
                        break
                    if inflate.eof:  # several members one after the other
                        inflate = zlib.decompressobj(31)
                    yield inflate.decompress(raw, PIECE_BYTES)
                    raw = inflate.unconsumed_tail or inflate.unused_data
                    if inflate.eof and not raw.strip(b"\0"):
                        break
            while inflate is not None and (more := inflate.decompress(inflate.unconsumed_tail, PIECE_BYTES)):
                yield more
        except zlib.error as e:
            raise BadFile(f"damaged gzip: {e}") from e
        if inflate is not None and not inflate.eof:
            raise BadFile("gzip is cut short")


def lines_of(parts: Iterator[bytes], at: int) -> Iterator[tuple[int, bytes]]:
    """(place, line with its end) of a stream that begins at ``at``."""
    held: list[bytes] = []
    size = 0
    for part in parts:
        lines = part.split(b"\n")
        for k, line in enumerate(lines[:-1]):
            whole = b"".join([*held, line]) + b"\n" if k == 0 else line + b"\n"
            held, size = [], 0
            yield at, whole
            at += len(whole)
        held.append(lines[-1])
        size += len(lines[-1])
        if size > RECORD_BYTES:
            raise BadFile(f"a line of over {RECORD_BYTES} bytes")
    if last := b"".join(held):
        yield at, last


def range_lines(path: str, start: int, end: int | None) -> Iterator[tuple[int, bytes]]:
    """The lines that begin in ``[start, end)``, and those after them, which the caller may
    leave.  A line belongs to the range that holds its first byte."""
    lines = lines_of(pieces(path, max(0, start - 1)), max(0, start - 1))
    if start:
        next(lines, None)  # what ends here, or the line end alone, is the former range's
    yield from lines


def _patterns(sep: str) -> tuple[re.Pattern, re.Pattern]:
    s = re.escape(sep.encode())
    cell = rb'(?:"[^"]*+(?:""[^"]*+)*+"[^' + s + rb"]*+|[^\"" + s + rb"][^" + s + rb"]*+|)"
    return re.compile(rb"(?:" + cell + s + rb")*+" + cell + rb"\Z"), re.compile(rb'[^"]*+(?:""[^"]*+)*+"([^' + s + rb"]*+)")


def goes_inside(line: bytes, inside: bool, sep: str, patterns: tuple[re.Pattern, re.Pattern] | None = None) -> bool:
    """Whether the line, begun in this state, ends inside a quoted cell."""
    if b'"' not in line:
        return inside
    outside, closing = patterns or _patterns(sep)
    if inside:
        closed = closing.match(line)
        if not closed:
            return True
        line = line[closed.end() + 1 :]  # after the separator that ends the cell
    return not outside.match(line)


def scan_quotes(path: str, start: int, end: int, sep: str) -> tuple[bool, bool]:
    """The states in which a range ends, if it begins outside a quoted cell, or inside."""
    state, patterns = (False, True), _patterns(sep)
    for at, line in range_lines(path, start, end):
        if at >= end:
            break
        if b'"' in line:
            ends = {s: goes_inside(line, s, sep, patterns) for s in set(state)}
            state = ends[state[0]], ends[state[1]]
    return state


def records(path: str, start: int, end: int | None, inside: bool, encoding: str, sep: str) -> Iterator[tuple[int, list[str]]]:
    """(place, fields) of the records that begin in a range."""
    csv.field_size_limit(sys.maxsize)
    if encoding.startswith("UTF-16"):
        yield from _wide_records(path, encoding, sep)
        return
    charset, patterns = {"windows-1252": "cp1252"}.get(encoding, encoding), _patterns(sep)
    lines, state, next_at = range_lines(path, start, end), inside, start
    first: tuple[int, bytes] | None = None
    for at, line in lines:
        if not state:
            first = at, line
            break
        state = goes_inside(line, True, sep, patterns)

    def text() -> Iterator[str]:
        nonlocal next_at
        held = first
        while held:
            at, line = held
            next_at = at + len(line)
            if next_at - begun_at[0] > RECORD_BYTES:
                raise BadFile(f"a record of over {RECORD_BYTES} bytes, from byte {begun_at[0]}")
            try:
                yield line.decode(charset)
            except UnicodeDecodeError as e:
                if charset != "cp1252":
                    raise BadFile(f"not {encoding} at byte {at + e.start}") from e
                yield line.decode("latin-1")  # the five bytes that the charset leaves out
            held = next(lines, None)

    if first is None:
        return
    begun_at = [first[0]]
    next_at = first[0]
    rows = csv.reader(text(), delimiter=sep)
    while end is None or next_at < end:
        begun_at[0] = at = next_at
        try:
            row = next(rows)
        except StopIteration:
            return
        except csv.Error as e:
            raise BadFile(f"not a table at byte {at}: {e}") from e
        if len(row) > MOST_FIELDS:
            raise BadFile(f"a record of over {MOST_FIELDS} fields, at byte {at}")
        if row and at == 0 and row[0].startswith("\ufeff"):
            row[0] = row[0][1:]
        if row:
            yield at, row


def _wide_records(path: str, encoding: str, sep: str) -> Iterator[tuple[int, list[str]]]:
    """Records of a file of two bytes a sign, in one range; places count records."""
    import codecs
    import io

    class Stream(io.RawIOBase):
        def __init__(self) -> None:
            self.parts, self.rest = pieces(path), b""

        def readable(self) -> bool:
            return True

        def readinto(self, into) -> int:  # noqa: ANN001
            while not self.rest:
                part = next(self.parts, None)
                if part is None:
                    return 0
                self.rest = part
            n = min(len(into), len(self.rest))
            into[:n], self.rest = self.rest[:n], self.rest[n:]
            return n

    try:
        for at, row in enumerate(csv.reader(codecs.getreader(encoding)(io.BufferedReader(Stream())), delimiter=sep)):
            if row and at == 0:
                row[0] = row[0].lstrip("\ufeff")
            if row:
                yield at, row
    except UnicodeDecodeError as e:
        raise BadFile(f"not {encoding}: {e.reason}") from e
    except csv.Error as e:
        raise BadFile(f"not a table: {e}") from e


_TOKEN = re.compile(rb'"[^"\\]*+(?:\\.[^"\\]*+)*+"|[\[\]{}]', re.DOTALL)
_OPEN = re.compile(rb'"[^"\\]*+(?:\\.[^"\\]*+)*+\\?\Z', re.DOTALL)


def items(parts: Iterator[bytes]) -> Iterator[tuple[int, str | None, bytes]]:
    """(place, kind, text) of a nested file that is streamed: ``item`` for each element of
    the charges, and last ``head``, the file without them."""
    buf, base, depth, key, inside, begun, head, headed = b"", 0, 0, b"", False, 0, [], 0
    pos = 0
    for part in parts:
        buf += part
        while True:
            token = _TOKEN.search(buf, pos)
            cut = _OPEN.search(buf, pos, token.start() if token else len(buf))
            if token is None or (cut and cut.start() < token.start()):
                break
            t, pos = token.group(), token.end()
            if t[:1] == b'"':
                if depth == 1:
                    key = t[1:-1]
                continue
            if t in b"[{":
                depth += 1
                if t == b"[" and depth == 2 and key == ITEMS:
                    inside = True
                    head.append(buf[headed - base : pos])
                elif inside and depth == 3:
                    begun = token.start() + base
                continue
            depth -= 1
            if depth < 0:
                raise BadFile("not JSON: a bracket too many")
            if inside and depth == 2:
                yield begun, "item", buf[begun - base : pos]
            elif inside and depth == 1:
                inside, headed, key = False, base + token.start(), b""
        # what has been looked at goes, but for an item that has begun, the head and an open string
        keep = begun if inside and depth >= 3 else base + pos if inside else headed
        keep = min(keep, base + pos)
        buf, pos, base = buf[keep - base :], base + pos - keep, keep
        if len(buf) > RECORD_BYTES:
            raise BadFile(f"an item of over {RECORD_BYTES} bytes, from byte {base}")
    if depth or inside:
        raise BadFile("JSON is cut short")
    head.append(buf[headed - base :])
    yield base + len(buf), "head", b"".join(head)


def files(spark: SparkSession, path: str) -> DataFrame:
    """``(path, source_file, size)`` of the files below ``path`` that can be read: names only.

    Spark's listing leaves out files of no bytes, so they have no row here."""
    return named(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path))


def named(listed: DataFrame) -> DataFrame:
    """``(path, source_file, size)`` of a listing, or of a stream of files that land."""
    return listed.where(F.col("path").rlike(SUPPORTED)).select("path", source_name(F.element_at(F.split("path", "/"), -1)).alias("source_file"), F.col("length").alias("size"))


def heads(listed: DataFrame, tasks: int | None = None) -> DataFrame:
    """``listed(path, ...)`` with ``encoding``, ``delimiter``, ``columns`` of each file's first
    bytes, and ``error`` where they can't be had.  Read in tasks; the driver sees none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                row = {"path": path, "encoding": None, "delimiter": None, "columns": None, "error": None}
                try:
                    held = b""
                    for part in pieces(path):
                        held += part
                        if len(held) >= HEAD_BYTES:
                            break
                    row["encoding"], row["delimiter"], row["columns"] = profile(held[:HEAD_BYTES])
                except (BadFile, OSError) as e:
                    row["error"] = str(e)
                yield pa.RecordBatch.from_pylist([row], pa.schema([("path", pa.string()), ("encoding", pa.string()), ("delimiter", pa.string()), ("columns", pa.int32()), ("error", pa.string())]))

    paths = listed.select("path").repartition(tasks or listed.sparkSession.sparkContext.defaultParallelism, "path")
    return listed.join(paths.mapInArrow(run, "path string, encoding string, delimiter string, columns int, error string"), "path")


def ranges(headed: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``headed`` dealt to ranges ``(start, stop, many)`` with the state ``inside`` in which
    each begins.  Only files of several ranges are scanned for quotes."""
    nested = F.col("path").rlike(r"(?i)\.json(\.gz)?$")
    whole = nested | F.col("path").rlike(r"(?i)\.gz$") | F.col("encoding").startswith("UTF-16") | F.col("error").isNotNull()
    size = F.when(whole, F.lit(1)).otherwise(F.greatest(F.lit(1), F.ceil(F.col("size") / range_bytes))).cast("int")
    each = headed.withColumns({"nested": nested, "many": size}).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("many") - 1)))
    each = each.withColumns({"start": F.col("k") * F.lit(range_bytes).cast("long"), "stop": F.when(F.col("many") > 1, (F.col("k") + 1) * F.lit(range_bytes).cast("long"))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, k, start, stop, sep in zip(*(batch.column(c).to_pylist() for c in ("path", "k", "start", "stop", "delimiter")), strict=True):
                try:
                    outside, inside = scan_quotes(path, start, stop, sep)
                except (BadFile, OSError):  # the reading of the records says so
                    outside, inside = False, True
                yield pa.RecordBatch.from_pylist([{"path": path, "k": k, "outside": outside, "inner": inside}], pa.schema([("path", pa.string()), ("k", pa.int32()), ("outside", pa.bool_()), ("inner", pa.bool_())]))

    large = each.where("many > 1").select("path", "k", "start", "stop", "delimiter").repartition("path", "k")
    scanned = large.mapInArrow(run, "path string, k int, outside boolean, inner boolean")
    # states of a file's ranges, one after the other: a range is 128 MB, so they are few
    ordered = scanned.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("k", "outside", "inner"))).alias("steps"))
    begin = lambda n: F.aggregate(F.slice("steps", F.lit(1), n), F.lit(False), lambda s, x: F.when(s, x["inner"]).otherwise(x["outside"]))
    states = ordered.select("path", F.explode(F.transform(F.sequence(F.lit(0), F.size("steps") - 1), lambda n: F.struct(n.alias("k"), begin(n).alias("inside")))).alias("s")).select("path", "s.k", "s.inside")
    return each.join(states, ["path", "k"], "left").withColumn("inside", F.coalesce("inside", F.lit(False)))


ROWS = pa.schema([("source_file", pa.string()), ("line", pa.int64()), ("row", pa.list_(pa.string())), ("kind", pa.string()), ("text", pa.string()), ("error", pa.string())])


def _range_rows(r: dict) -> Iterator[dict]:
    """What one range gives: its rows, and at last what is wrong, if anything."""
    blank = dict.fromkeys(ROWS.names) | {"source_file": r["source_file"]}
    if r["error"]:
        yield blank | {"error": r["error"]}
        return
    try:
        if r["nested"]:
            charset = {"windows-1252": "cp1252"}.get(r["encoding"], r["encoding"])
            parts = pieces(r["path"])
            if charset.startswith("UTF-16"):
                import codecs

                decode = codecs.getincrementaldecoder(charset)().decode
                parts, charset = (decode(p).encode() for p in parts), "utf-8"
            for at, kind, text in items(parts):
                yield blank | {"line": at, "kind": kind, "text": text.decode(charset).lstrip("\ufeff")}
        else:
            for at, row in records(r["path"], r["start"], r["stop"], r["inside"], r["encoding"], r["delimiter"]):
                yield blank | {"line": at, "row": row, "kind": "row"}
    except UnicodeDecodeError as e:
        yield blank | {"error": f"not {r['encoding']}: {e.reason}"}
    except (BadFile, OSError) as e:
        yield blank | {"error": str(e)}


def read_ranges(dealt: DataFrame) -> DataFrame:
    """``(source_file, line, row, kind, text, error)`` of every range: records with their byte
    places, items and heads of nested files, and what went wrong, a row for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                held: list[dict] = []
                for row in _range_rows(r):
                    held.append(row)
                    if len(held) >= ROWS_AT_ONCE:
                        yield pa.RecordBatch.from_pylist(held, ROWS)
                        held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, ROWS)

    tasks = dealt.select("path", "source_file", "start", "stop", "inside", "encoding", "delimiter", "nested", "error").repartition("path", "start")
    return tasks.mapInArrow(run, "source_file string, line long, row array<string>, kind string, text string, error string")


def stage_listed(listed: DataFrame, target: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Read every file of ``listed(path, source_file, size)`` once, and write what it gives to
    ``target``; the written table, of which ``lines``, ``nested`` and ``ledger`` make facts and
    outcomes."""
    read_ranges(ranges(heads(listed), range_bytes)).write.mode("overwrite").parquet(target)
    return listed.sparkSession.read.parquet(target)


def stage(spark: SparkSession, path: str, target: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """As ``stage_listed``, of every file below ``path``."""
    return stage_listed(files(spark, path), target, range_bytes)


def failures(staged: DataFrame) -> DataFrame:
    """``(source_file, reason)`` of the files that can't be read to their end."""
    return staged.where("error is not null").groupBy("source_file").agg(F.min("error").alias("reason"))


def lines(staged: DataFrame) -> DataFrame:
    """The records of the delimited files that were read to their end: nothing of a file that
    failed is loaded, so it can be taken again."""
    return staged.where("kind = 'row'").join(failures(staged), "source_file", "left_anti").select("source_file", "line", "row")


def nested(staged: DataFrame) -> DataFrame:
    """Rows as ``charges.read_json`` gives them, one for each item and one for each head."""
    good = staged.where("kind in ('item', 'head')").join(failures(staged), "source_file", "left_anti")
    head = F.from_json(F.when(F.col("kind") == "head", F.col("text")), JSON_SCHEMA.replace("\n", " "))
    item = F.from_json(F.when(F.col("kind") == "item", F.col("text")), f"struct<{ITEM}>")
    parsed = good.select("source_file", "line", head.alias("h"), item.alias("i"))
    names = ["hospital_name", "last_updated_on", "version", "hospital_location", "hospital_address", "license_information", "type_2_npi"]
    charges = F.when(F.col("i").isNotNull(), F.array("i")).otherwise(F.col("h.standard_charge_information"))
    return parsed.select("source_file", *[F.col(f"h.{n}").alias(n) for n in names], charges.alias("standard_charge_information"))


def ledger(listed: DataFrame, staged: DataFrame, headed: DataFrame, facts: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """``(source_file, status, rows, reason)`` of every file: ``skipped`` if it is among the
    loaded ``sources``, ``failed`` with what was wrong with it, ``empty`` or ``loaded``.

    ``headed(source_file)`` are the files with a data header, ``facts(source_file)`` the rows."""
    known = lambda df, name: df.select("source_file", F.lit(True).alias(name)).distinct()
    out = listed.select("source_file").distinct().join(failures(staged), "source_file", "left").join(known(headed, "_h"), "source_file", "left")
    out = out.join(facts.groupBy("source_file").agg(F.count("*").alias("rows")), "source_file", "left")
    skipped: Column = F.lit(False)
    if sources is not None:
        out, skipped = out.join(known(sources.where("charge_count > 0"), "_s"), "source_file", "left"), F.col("_s").isNotNull()
    n = F.coalesce("rows", F.lit(0))
    why = F.when(skipped, "loaded before").when(F.col("reason").isNotNull(), F.col("reason")).when(F.col("_h").isNull(), "no data header").when(n == 0, "no rows").otherwise("")
    status = F.when(skipped, "skipped").when(F.col("reason").isNotNull() | F.col("_h").isNull(), "failed").when(n == 0, "empty").otherwise("loaded")
    return out.select("source_file", status.alias("status"), n.cast("long").alias("rows"), why.alias("reason"))
