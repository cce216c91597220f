"""CSV files in one scan, and runs over file catalogues."""

import csv
import gzip
import io
import random

import pytest
from pyspark.sql import functions as F

from tidelog.operators.rules import Rule
from tidelog.sources.backfill import backfill
from tidelog.sources.csv_files import read_event_log_csv
from tidelog.sources.file_runs import FilePlan, TypeFields, current_entries, read_ledger
from tidelog.sources.orgs import Org
from tidelog.sources.polling import Cycle, poll_files


@pytest.fixture
def small_splits(spark):
    """Files are cut every few hundred bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "301", "spark.sql.files.openCostInBytes": "1"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def read(spark, folder):
    return {
        (r.path.rsplit("/", 1)[1], r.row): r.payload for r in read_event_log_csv(spark, [str(folder)]).collect()
    }


def plainly(folder):
    out = {}
    for path in folder.iterdir():
        if path.suffix == ".crc":
            continue
        records = [r for r in csv.reader(io.StringIO(path.read_bytes().decode(), newline="")) if r]
        for n, cells in enumerate(records[1:]):
            header = records[0]
            row = dict(zip(header, [*cells, *[""] * len(header)], strict=False))
            extra = cells[len(header) :]
            out[path.name, n] = {**row, "_extra": ",".join(extra)} if extra else row
    return out


def test_splits_cut_anywhere(spark, tmp_path, small_splits):
    """Long quoted cells with line breaks over several splits, against the csv module."""
    rng = random.Random(3)
    cells = ["", "x", "a,b", 'say "hi"', "two\nlines", "\n\n", '"', "é" * 40, "w " * 300, 'l\n"' * 120, "\r\n"]
    for n in range(12):
        header = [f"C{i}" for i in range(rng.randrange(1, 5))]
        header += ["line\nbreak"] if n % 3 == 0 else []
        with (tmp_path / f"{n}.csv").open("w", newline="") as file:
            write = csv.writer(file, quoting=rng.choice([csv.QUOTE_ALL, csv.QUOTE_MINIMAL]), lineterminator=rng.choice(["\n", "\r\n"]))
            write.writerow(header)
            for _ in range(rng.randrange(0, 40)):
                write.writerow([f"r{rng.randrange(99)}", *(rng.choice(cells) for _ in range(rng.randrange(0, len(header) + 2)))])
    got = read(spark, tmp_path)
    assert got == plainly(tmp_path) and len(got) > 50


def test_malformed_quotes_and_blank_lines_stay_in_their_row(spark, tmp_path, small_splits):
    body = '\nA,B\n\n5" pipe,x\n"a"b,c"d"\n\r\n'
    (tmp_path / "a.csv").write_text(body + "1,2\n" * 300)
    got = read(spark, tmp_path)
    assert [got["a.csv", n] for n in range(3)] == [{"A": '5" pipe', "B": "x"}, {"A": '"a"b', "B": 'c"d"'}, {"A": "1", "B": "2"}]
    assert len(got) == 302


def test_many_files_of_many_headers_and_a_very_wide_row(spark, tmp_path):
    for n in range(2_000):
        width = n % 40 + 1
        names = ",".join(f"H{n % 40}_{i}" for i in range(width))
        (tmp_path / f"{n}.csv").write_text(f"{names}\n{','.join(['v'] * width)}\n")
    (tmp_path / "wide.csv").write_text("A\n" + "x," * 1_200_000 + "x\n3\n")
    rows = read_event_log_csv(spark, [str(tmp_path)])
    narrow = rows.filter("path NOT LIKE '%wide%'")
    assert narrow.agg(F.count("*"), F.sum(F.size("payload"))).first() == (2_000, sum(n % 40 + 1 for n in range(2_000)))
    wide = rows.filter("path LIKE '%wide%'").select("row", F.size(F.split(F.col("payload")["_extra"], ","))).collect()
    assert sorted(map(tuple, wide)) == [(0, 1_200_000), (1, -1)] or sorted(map(tuple, wide), key=str) == [(0, 1_200_000), (1, None)]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Scan text" not in plan and "Scan csv" not in plan


CATALOGUE = "Id string, EventType string, Interval string, CreatedDate string, LogFileLength string, Sequence string, Path string"


class Files:
    """A folder of event-log files and the catalogue of them."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.rows = spark, folder, []

    def add(self, name, event_type, created, lines, path=None, length=None):
        body = "TIMESTAMP_DERIVED,ID,EMAIL,REQUEST_ID\n" + "".join(f"{created},{line},{line}@x.org,r{line}\n" for line in lines)
        target = self.folder / (path or f"{name}.csv")
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(body)
        self.rows.append((name, event_type, "Hourly", created, str(length or len(body)), "1", str(target)))
        return target

    def catalogue(self):
        return self.spark.createDataFrame(self.rows, CATALOGUE)


@pytest.fixture
def files(spark, tmp_path):
    return Files(spark, tmp_path / "files")


def ids(spark, out):
    return sorted(r[0] for r in current_entries(spark, out).select(F.get_json_object("line", "$.ID")).collect())


WINDOW = {"since": "2024-01-01", "until": "2024-02-01", "now": "2024-02-01"}


def test_nothing_clear_is_stored_and_positions_move_over_dropped_files(spark, tmp_path, files):
    files.add("f1", "Login", "2024-01-01T01:00:00.000Z", ["a1", "a2"])
    files.add("f2", "Login", "2024-01-01T02:00:00.000Z", ["x1", "x2"])
    files.add("f3", "API", "2024-01-01T03:00:00.000Z", ["b1"])
    files.add("f4", "API", "2024-01-01T04:00:00.000Z", [])
    plan = FilePlan(
        rules=[Rule("mask", ["EMAIL"]), Rule("drop_row", match={"ID": "x*"}), Rule("hash", ["REQUEST_ID"])], salt="s",
        types={"Login": TypeFields(["EMAIL"], ["REQUEST_ID"]), "API": TypeFields(labels=["EMAIL"])}, metadata_fields=["ID"],
    )
    out = str(tmp_path / "out")
    assert backfill(spark, files.catalogue(), out, plan=plan, **WINDOW) == ["API", "Login"]
    stored = current_entries(spark, out).collect()
    assert sorted(r.labels["event_type"] for r in stored) == ["API", "Login", "Login"]
    for row in stored:
        text = row.line + str(row.metadata) + str(row.labels)
        assert "a1@" not in text and "a2@" not in text and "b1@" not in text and "ra1" not in text
    by_type = {r.labels["event_type"]: r for r in stored}
    assert by_type["API"].labels["EMAIL"] == "***@x.org" and set(by_type["API"].metadata) == {"ID", "level"}
    assert by_type["Login"].metadata["EMAIL"] == "***@x.org" and len(by_type["Login"].labels["REQUEST_ID"]) == 16
    # The file whose rows were all dropped is done; the one without rows is looked at again.
    assert sorted(r.key for r in read_ledger(spark, out).collect()) == ["backfill:f1", "backfill:f2", "backfill:f3"]
    assert spark.read.parquet(f"{out}/rejects").count() == 0


def test_rates_by_type_and_their_check(spark, tmp_path, files):
    files.add("f1", "Login", "2024-01-01T01:00:00.000Z", [f"a{i}" for i in range(200)])
    files.add("f2", "API", "2024-01-01T01:00:00.000Z", [f"b{i}" for i in range(50)])
    backfill(spark, files.catalogue(), str(tmp_path / "out"), plan=FilePlan(rates={"Login": 0.5}), **WINDOW)
    got = ids(spark, str(tmp_path / "out"))
    assert sum(i[0] == "b" for i in got) == 50 and 60 < sum(i[0] == "a" for i in got) < 140
    with pytest.raises(ValueError, match="rates"):
        FilePlan(rates={"Login": 1.5})
    with pytest.raises(ValueError, match="labels"):
        FilePlan(rules=[Rule("drop_field", ["EMAIL"])], types={"Login": TypeFields(labels=["EMAIL"])})


def test_a_regenerated_file_takes_the_place_of_the_old_one(spark, tmp_path, files):
    out = str(tmp_path / "out")
    files.add("f1", "Login", "2024-01-01T01:00:00.000Z", ["a", "b"])
    files.add("f2", "Login", "2024-01-01T01:00:00.000Z", ["c"])
    backfill(spark, files.catalogue(), out, **WINDOW)
    assert backfill(spark, files.catalogue(), out, **WINDOW) == []
    files.add("f1", "Login", "2024-01-02T01:00:00.000Z", ["a", "b2", "d"], path="again/f1.csv")
    files.add("f0", "Login", "2024-01-01T01:00:00.000Z", ["late"])
    assert backfill(spark, files.catalogue(), out, **WINDOW) == ["Login"]
    assert ids(spark, out) == ["a", "b2", "c", "d", "late"]


def test_batches_resume_where_a_run_ended(spark, tmp_path, files, monkeypatch):
    out = str(tmp_path / "out")
    for n in range(5):
        files.add(f"f{n}", "Login", f"2024-01-01T0{n}:00:00.000Z", [f"{n}a", f"{n}b"])
    import tidelog.sources.backfill as module

    real, calls = module.deliver_files, []

    def ends_in_the_second_batch(*args, **kwargs):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(*args, **kwargs)

    monkeypatch.setattr(module, "deliver_files", ends_in_the_second_batch)
    with pytest.raises(RuntimeError):
        backfill(spark, files.catalogue(), out, batch_files=2, mode="ingest", **WINDOW)
    monkeypatch.undo()
    assert ids(spark, out) == ["0a", "0b", "1a", "1b"]
    backfill(spark, files.catalogue(), out, batch_files=2, mode="ingest", **WINDOW)
    rows = current_entries(spark, out).select(F.get_json_object("line", "$.ID"), F.unix_micros("ts") % 1_000_000, "metadata").collect()
    # Each run has a clock of its own, which goes on from batch to batch.
    assert sorted((r[0], r[1]) for r in rows) == [(f"{n}{x}", (n * 2 if n < 2 else (n - 2) * 2) + (x == "b")) for n in range(5) for x in "ab"]
    assert rows[0].metadata["event_time"].startswith("2024-01-01T")


def test_orgs_keep_their_own_positions(spark, tmp_path, files):
    out = str(tmp_path / "out")
    files.add("f1", "Login", "2024-01-01T01:00:00.000Z", ["a"])
    backfill(spark, files.catalogue(), out, **WINDOW)
    files.add("f2", "Login", "2024-01-01T02:00:00.000Z", ["b"])
    for name, first in (("east", True), ("west", False)):
        backfill(spark, files.catalogue(), out, plan=FilePlan(org=Org(name, "prod", None)), take_unprefixed=first, **WINDOW)
    keys = sorted(r.key for r in read_ledger(spark, out).collect())
    assert keys == ["backfill:f1", "backfill:org=east:f2", "backfill:org=west:f1", "backfill:org=west:f2"]
    assert sorted(map(str, (r.labels.get("org") for r in current_entries(spark, out).collect()))) == ["None", "east", "west", "west"]


def findings(spark, out):
    return sorted((r.Id, r.error, r.state) for r in spark.read.parquet(f"{out}/findings").collect())


def test_broken_files_fail_neither_the_run_nor_the_others(spark, tmp_path, files):
    out = str(tmp_path / "out")
    files.add("good", "Login", "2024-01-01T01:00:00.000Z", ["a"])
    files.add("cut", "Login", "2024-01-01T02:00:00.000Z", ["b"], length=500)
    files.add("gone", "API", "2024-01-01T03:00:00.000Z", ["c"]).unlink()
    files.add("no-folder", "API", "2024-01-01T03:00:00.000Z", ["c"], path="sub/x.csv").unlink()
    (files.folder / "sub").rmdir()
    packed = files.add("packed", "API", "2024-01-01T04:00:00.000Z", [f"p{i}" for i in range(3000)], path="p.csv.gz")
    whole = gzip.compress(packed.read_bytes())
    packed.write_bytes(whole[: len(whole) // 2])
    assert backfill(spark, files.catalogue(), out, **WINDOW) == ["Login"]
    assert findings(spark, out) == [
        ("cut", "truncated", "failed"), ("gone", "missing", "failed"), ("no-folder", "missing", "failed"), ("packed", "truncated", "failed"),
    ]
    packed.write_bytes(whole)
    backfill(spark, files.catalogue(), out, **WINDOW)
    assert len(ids(spark, out)) == 3001


def test_cycles_hold_young_broken_files_and_give_up_old_ones(spark, tmp_path, files):
    out = str(tmp_path / "out")
    files.add("a1", "A", "2024-01-01T01:00:00.000Z", ["1"])
    hole = files.add("a2", "A", "2024-01-01T02:00:00.000Z", ["2"])
    files.add("a3", "A", "2024-01-01T03:00:00.000Z", ["3"])
    files.add("b1", "B", "2024-01-01T02:00:00.000Z", ["4"])
    files.add("b2", "B", "2024-01-01T04:59:00.000Z", ["5"])
    files.add("c1", "C", "2024-01-01T02:00:00.000Z", [])
    body = hole.read_bytes()
    hole.unlink()

    def cycle(now, batch_files=10):
        return poll_files(spark, files.catalogue(), out, FilePlan(), now=now, max_age_hours=6, batch_files=batch_files)

    assert cycle("2024-01-01 05:00:00", 2) == Cycle(read=2, held=2, abandoned=0, empty=1)
    assert ids(spark, out) == ["1", "4"] and findings(spark, out) == [("a2", "missing", "held")]
    # The unsettled file is read a cycle later; the held ones are still held.
    assert cycle("2024-01-01 06:00:00") == Cycle(read=1, held=2, abandoned=0, empty=1)
    assert cycle("2024-01-01 09:00:00") == Cycle(read=1, held=0, abandoned=1, empty=1)
    assert ids(spark, out) == ["1", "3", "4", "5"]
    # Given up means done, even when it arrives after all.
    hole.write_bytes(body)
    assert cycle("2024-01-01 09:30:00") == Cycle(read=0, held=0, abandoned=0, empty=1)
    assert ids(spark, out) == ["1", "3", "4", "5"]


def test_a_held_file_is_read_when_it_arrives(spark, tmp_path, files):
    out = str(tmp_path / "out")
    hole = files.add("a2", "A", "2024-01-01T02:00:00.000Z", ["2"])
    files.add("a3", "A", "2024-01-01T03:00:00.000Z", ["3"])
    body = hole.read_bytes()
    hole.unlink()
    run = {"now": "2024-01-01 05:00:00", "plan": FilePlan(org=Org("east", "prod", "00D1"))}
    assert poll_files(spark, files.catalogue(), out, **run).held == 2
    hole.write_bytes(body)
    assert poll_files(spark, files.catalogue(), out, **run) == Cycle(2, 0, 0, 0)
    row = current_entries(spark, out).first()
    assert row.labels["org"] == "east" and row.labels["sf_org_id"] == "00D1" and "backfill" not in row.labels
