"""Batches of charge files: cuts at every byte, damaged files beside good ones, nested items."""

import csv
import gzip
import io
import json
import random

import pytest

from ledgerloom.sources import batch, charges

HEAD = "description,code|1,code|1|type,payer_name,standard_charge|gross\n"


def put(folder, name, content):
    path = folder / name
    path.write_bytes(content)
    return f"file://{path}"


def table(rng, rows, end="\n"):
    out = io.StringIO()
    cells = ["a", "", 'q"x', "l1\nl2", "é", "a,b", '"', 'x"\n"y', "\n", "plain"]
    csv.writer(out, lineterminator=end).writerows([rng.choice(cells) for _ in range(rng.randint(1, 4))] for _ in range(rows))
    return out.getvalue()


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_a_cut_at_every_byte(tmp_path, end):
    """Ranges of any size give the records that one reader gives, each once."""
    rng = random.Random(2)
    for trial in range(25):
        text = table(rng, rng.randint(0, 7), end)
        path, size = put(tmp_path, f"{trial}.csv", text.encode()), len(text.encode())
        whole = list(batch.records(path, 0, None, False, "UTF-8", ","))
        assert [r for _, r in whole] == [r for r in csv.reader(io.StringIO(text, newline="")) if r]
        for step in (1, 2, 3, 5, 8, 13):
            found, inside = [], False
            for start in range(0, size, step):
                found += batch.records(path, start, start + step, inside, "UTF-8", ",")
                inside = batch.scan_quotes(path, start, start + step, ",")[inside]
            assert found == whole, (step, text)


def test_items_in_pieces_of_any_size():
    doc = {"hospital_name": 'H [x] "é', "standard_charge_information_": [1], "a": {"standard_charge_information": [2]}, "standard_charge_information": [{"d": 'x"}]', "n": [1, {"z": 2}]}, {"d": "y\\"}, {}], "tail": "t"}
    raw = json.dumps(doc, ensure_ascii=False).encode()
    for n in range(1, 60):
        found = list(batch.items(raw[k : k + n] for k in range(0, len(raw), n)))
        assert [json.loads(t) for _, k, t in found if k == "item"] == doc["standard_charge_information"]
        assert [json.loads(t) for _, k, t in found if k == "head"] == [{**doc, "standard_charge_information": []}]
    for end in (len(raw) // 2, len(raw) - 1):
        with pytest.raises(batch.BadFile, match="cut short"):
            list(batch.items([raw[:end]]))


def test_bad_files_are_rows(spark, tmp_path):
    """Every kind of damage beside good files: good rows load, and the ledger has each reason."""
    good = HEAD + "".join(f'"item {k}, of\nmany",c{k},CPT,P,{k}.50\n' for k in range(400))
    plain = HEAD + "".join(f"item {k},c{k},CPT,P,{k}.50\n" for k in range(12_000))
    zipped = gzip.compress(random.Random(1).randbytes(0) + good.encode())
    files = {
        "good.csv": good.encode(), "zipped.csv.gz": zipped, "twice.csv.gz": zipped + gzip.compress(b"last,c9,CPT,P,1\n"), "western.csv": good.replace("item", "Öl").encode("cp1252"), "wide.csv": good.encode("utf-16"),
        "magic.csv.gz": b"nonsense" + zipped, "cut.csv.gz": zipped[:-30], "fields.csv": (good + "x," * (batch.MOST_FIELDS + 5) + "\n").encode(), "late.csv": plain.encode() + "Öl,c1,CPT,P,1\n".encode("cp1252"),
        "headless.csv": b"1,2\n3,4\n", "only.csv": HEAD.encode(),
        "good.json": json.dumps({"hospital_name": "H", "standard_charge_information": [{"description": f"d{k}", "code_information": [{"code": f"c{k}", "type": "CPT"}], "standard_charges": [{"gross_charge": k}]} for k in range(30)]}).encode(),
        "cut.json": b'{"hospital_name": "H", "standard_charge_information": [{"description": "d"}', "other.json": b'{"x": 1}',
    }
    for name, content in files.items():
        put(tmp_path, name, content)
    listed = batch.files(spark, f"file://{tmp_path}")
    staged = batch.stage(spark, f"file://{tmp_path}", f"file://{tmp_path}/../staged-{tmp_path.name}", 700)
    lines, raw = batch.lines(staged), batch.nested(staged)
    heads = charges.headers(lines)
    facts = charges.charges(lines, heads).unionByName(charges.json_charges(raw))
    headed = heads.select("source_file").unionByName(raw.where(charges.is_charge_file()).select("source_file"))
    found = {r.source_file: (r.status, r.rows, r.reason) for r in batch.ledger(listed, staged, headed, facts).collect()}
    assert set(found) == set(files)
    for name, rows in (("good.csv", 400), ("zipped.csv.gz", 400), ("twice.csv.gz", 401), ("western.csv", 400), ("wide.csv", 400), ("good.json", 30)):
        assert found[name] == ("loaded", rows, ""), (name, found[name])
    for name, reason in (("magic.csv.gz", "damaged gzip"), ("cut.csv.gz", "gzip is cut short"), ("fields.csv", "a record of over"), ("late.csv", "not UTF-8 at byte"), ("headless.csv", "no data header"), ("cut.json", "JSON is cut short"), ("other.json", "no data header")):
        assert found[name][:2] == ("failed", 0) and found[name][2].startswith(reason), (name, found[name])
    assert found["only.csv"] == ("empty", 0, "no rows")
    texts = {r.description for r in facts.where("source_file = 'western.csv'").collect()}
    assert "Öl 7, of many" in texts or "Öl 7, of\nmany" in texts
    loaded = spark.createDataFrame([("good.csv", 400), ("only.csv", 0)], "source_file string, charge_count long")
    again = {r.source_file: r.status for r in batch.ledger(listed, staged, headed, facts, loaded).collect()}
    assert again["good.csv"] == "skipped" and again["only.csv"] == "empty"  # a file without rows is tried again


def test_heads_are_read_in_tasks(spark, tmp_path):
    put(tmp_path, "a.csv", "x;y;z\n1;2;3\n".encode("utf-16"))
    put(tmp_path, "b.csv.gz", gzip.compress("é|b\n1|2\n".encode()))
    put(tmp_path, "c.csv.gz", b"no gzip")
    found = {r.source_file: (r.encoding, r.delimiter, r.columns, r.error is None) for r in batch.heads(batch.files(spark, f"file://{tmp_path}")).collect()}
    assert found == {"a.csv": ("UTF-16", ";", 3, True), "b.csv.gz": ("UTF-8", "|", 2, True), "c.csv.gz": (None, None, None, False)}
