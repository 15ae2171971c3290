import os
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from roadcast.operators.quality import find_violations, first_violation, header_report
from roadcast.plans import staging_job
from roadcast.plans.staging_job import RowError, load_snapshots
from roadcast.sources import csv_snapshots as csvs
from roadcast.sources import releases
from roadcast.sources.files import SourceMissing, list_files, path_exists
from roadcast.sources.sinks import create_tables, jdbc_options
from roadcast.specs import BASIC, DETAILS, DatasetSpec

DAY = "2026-02-19"
STAMP = datetime(2026, 2, 19, 12, 0, tzinfo=timezone.utc)


def basic_row(i, **changes):
    row = {c: f"{c}{i}" for c in BASIC.columns}
    row.update(report_id=f"R{i}", date_time=f"2026-01-0{i % 9 + 1} 10:00:00", police_beat=str(100 + i), injured="0", killed="")
    return {**row, **changes}


def details_row(i, **changes):
    row = {c: f"{c}{i}" for c in DETAILS.columns}
    row.update(report_id=f"R{i}", date_time="2026-01-05 10:00:00", police_beat="7", injured="", killed="", address_no_primary="")
    return {**row, **changes}


def quoted(value):
    return '"' + value.replace('"', '""') + '"' if any(ch in value for ch in ',"\n\r') else value


def write_csv(folder, spec, rows, columns=None, header=None, raw=None):
    os.makedirs(folder, exist_ok=True)
    columns = columns or spec.columns
    path = os.path.join(folder, spec.file_name)
    if raw is None:
        lines = [",".join(header or columns)] + [",".join(quoted(r[c]) for c in columns) for r in rows]
        raw = ("\n".join(lines) + "\n").encode()
    with open(path, "wb") as out:
        out.write(raw)
    return path


@pytest.fixture()
def specs(tmp_path):
    """The two datasets with tables of their own, so that tests do not meet."""
    schema = "t_" + tmp_path.name.replace("-", "_")

    def own(spec, name):
        return DatasetSpec(spec.name, f"{schema}.{name}", spec.file_name, spec.columns, spec.required, spec.integers, spec.timestamps)

    return own(BASIC, "basic"), own(DETAILS, "details")


def load(spark, tmp_path, specs, **kw):
    return load_snapshots(spark, str(tmp_path / "in") + "/", str(tmp_path / "wh"), DAY, specs, load_ts=STAMP, **kw)


def folder(tmp_path):
    return str(tmp_path / "in" / DAY)


def test_load_types_lineage_and_metrics(spark, tmp_path, specs):
    columns = list(reversed(BASIC.columns))
    rows = [basic_row(i) for i in range(1, 4)]
    rows[0].update(injured="\t 　", charge_desc='said "no", left\r\nquickly', hit_run_lvl="  MISD ")
    write_csv(folder(tmp_path), BASIC, rows, columns, header=[f" {c} " for c in columns])
    write_csv(folder(tmp_path), DETAILS, [details_row(1), details_row(1), details_row(2)])
    metrics = load(spark, tmp_path, specs)
    assert [(m.dataset, m.rows_replaced, m.rows_inserted) for m in metrics] == [(BASIC.name, 0, 3), (DETAILS.name, 0, 3)]
    table = spark.table(specs[0].table)
    assert table.columns == [*BASIC.columns, "snapshot_dt", "source_file", "load_ts"]
    assert dict(table.dtypes)["date_time"] == "timestamp_ntz" and dict(table.dtypes)["police_beat"] == "int"
    first = table.filter("report_id = 'R1'").first()
    assert first.injured is None and first.killed is None and first.police_beat == 101
    assert first.charge_desc == 'said "no", left\nquickly' and first.hit_run_lvl == "MISD"
    assert first.snapshot_dt == date(2026, 2, 19) and first.source_file == BASIC.file_name
    stamps = spark.table(specs[0].table).select("load_ts").union(spark.table(specs[1].table).select("load_ts")).distinct()
    assert stamps.count() == 1


def test_rerun_replaces_rows(spark, tmp_path, specs):
    write_csv(folder(tmp_path), BASIC, [basic_row(i) for i in range(3)])
    write_csv(folder(tmp_path), DETAILS, [details_row(1)])
    load(spark, tmp_path, specs)
    write_csv(folder(tmp_path), BASIC, [basic_row(i) for i in range(5)])
    assert [m.rows_replaced for m in load(spark, tmp_path, specs)] == [3, 1]
    assert spark.table(specs[0].table).count() == 5


def test_missing_files_are_all_named_and_nothing_is_written(spark, tmp_path, specs):
    write_csv(folder(tmp_path), DETAILS, [details_row(1)])
    with pytest.raises(SourceMissing, match="staging_collisions_basic") as error:
        load(spark, tmp_path, specs)
    assert "staging_collisions_details" not in str(error.value)
    assert not spark.catalog.tableExists(specs[1].table)


def test_second_dataset_bad_leaves_first_table_unchanged(spark, tmp_path, specs):
    write_csv(folder(tmp_path), BASIC, [basic_row(1)])
    write_csv(folder(tmp_path), DETAILS, [details_row(1)])
    load(spark, tmp_path, specs)
    write_csv(folder(tmp_path), BASIC, [basic_row(i) for i in range(4)])
    write_csv(folder(tmp_path), DETAILS, [details_row(1), details_row(2, injured="1.0"), details_row(3, report_id=" ")])
    with pytest.raises(RowError, match="row 3, column injured: not a valid integer: '1.0'"):
        load(spark, tmp_path, specs)
    assert spark.table(specs[0].table).count() == 1
    left = [p.name for p in tmp_path.rglob("run-*")]
    assert len(left) == 2  # the two tables' content; the failed run's folders are gone


def test_first_bad_row_is_reported_by_file_row(spark, tmp_path, specs):
    rows = [basic_row(1), basic_row(2), basic_row(3, address_no_primary="  "), basic_row(4, injured="x")]
    rows[1]["charge_desc"] = "two\nlines"
    write_csv(folder(tmp_path), BASIC, rows)
    write_csv(folder(tmp_path), DETAILS, [details_row(1)])
    with pytest.raises(RowError, match="row 4, column address_no_primary"):
        load(spark, tmp_path, specs)
    rows[3].update(police_beat="", injured="x")
    write_csv(folder(tmp_path), BASIC, rows[:2] + rows[3:])
    with pytest.raises(RowError, match="row 4, column police_beat"):
        load(spark, tmp_path, specs)


@pytest.mark.parametrize(
    "header, message",
    [
        (["report_id", "report_id", *BASIC.columns[2:]], r"duplicates columns \['report_id'\]"),
        (list(BASIC.columns[:-2]), r"missing columns \['hit_run_lvl', 'killed'\]"),
        ([*BASIC.columns, "zeta", "alpha"], r"unexpected columns \['alpha', 'zeta'\]"),
        (["Report_ID", *BASIC.columns[1:]], r"missing columns \['report_id'\]"),
    ],
)
def test_header_rules(spark, tmp_path, header, message):
    path = write_csv(str(tmp_path), BASIC, [], raw=(",".join(header) + "\n1,2\n").encode())
    with pytest.raises(csvs.HeaderError, match=message):
        csvs.check_header(spark, path, BASIC)


@pytest.mark.parametrize("raw", [b"", b"\nreport_id\n"])
def test_empty_header(spark, tmp_path, raw):
    path = write_csv(str(tmp_path), BASIC, [], raw=raw)
    with pytest.raises(csvs.HeaderError, match="no CSV header"):
        csvs.check_header(spark, path, BASIC)


def test_byte_order_mark_breaks_the_first_name(spark, tmp_path):
    path = write_csv(str(tmp_path), BASIC, [], raw=b"\xef\xbb\xbf" + ",".join(BASIC.columns).encode() + b"\n")
    with pytest.raises(csvs.HeaderError, match=r"missing columns \['report_id'\]"):
        csvs.check_header(spark, path, BASIC)


def test_short_and_long_rows(spark, tmp_path):
    full = basic_row(1)
    long = ",".join(full[c] for c in BASIC.columns) + ",extra,cells"
    raw = "\n".join([",".join(BASIC.columns), long, "R2,2026-01-01 00:00:00,5,12", "", ""]).encode()
    path = write_csv(str(tmp_path), BASIC, [], raw=raw)
    rows = csvs.read_typed(spark, path, BASIC).orderBy("report_id").collect()
    assert len(rows) == 2 and rows[0].hit_run_lvl == "hit_run_lvl1"
    assert rows[1].address_no_primary == "12" and rows[1].hit_run_lvl is None


def test_invalid_utf8_is_a_violation(spark, tmp_path):
    raw = (",".join(BASIC.columns) + "\nR1,2026-01-01,5,12,").encode() + b"\xff\xfe\n"
    path = write_csv(str(tmp_path), BASIC, [], raw=raw)
    found = find_violations(csvs.read_raw(spark, path, BASIC), BASIC, keep=()).collect()
    assert [(v.column_name, v.rule) for v in found] == [("address_pd_primary", "invalid_utf8")]


def test_row_numbers_across_splits_and_files(spark, tmp_path):
    spec = DatasetSpec("d", "x.d", "d.csv", ("k", "v"), frozenset())
    for name, count in (("a.csv", 3000), ("b.csv", 10)):
        with open(tmp_path / name, "w") as out:
            out.write("k,v\n" + "".join(f"{i},{'z' * 20}\n" for i in range(count)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        states = csvs.read_states(spark, str(tmp_path))
        raw = csvs.read_raw(spark, str(tmp_path), spec, ["k", "v"], states=states)
        assert raw.rdd.getNumPartitions() > 3
        numbered = csvs.with_row_numbers(raw, states)
        assert numbered.count() == 3010
        assert numbered.filter(F.col("row_num") != F.col("k").cast("long") + 2).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_accepted_and_broken_rows_add_up(spark):
    spec = DatasetSpec("d", "x.d", "d.csv", ("k", "n", "t"), frozenset({"k"}), frozenset({"n"}), frozenset({"t"}))
    rows = [(2, "a", "1", "2026-01-01"), (3, None, "x", "bad"), (4, " ", "", None), (5, "b", "1.0", "2026-01-01")]
    raw = spark.createDataFrame(rows, "row_num int, k string, n string, t string")
    found = find_violations(raw, spec)
    assert sorted((v.row_num, v.column_name, v.rule) for v in found.collect()) == [
        (3, "k", "required"), (3, "n", "integer"), (3, "t", "timestamp"), (4, "k", "required"), (5, "n", "integer"),
    ]
    first = first_violation(found).first()
    assert (first.row_num, first.column_name) == (3, "k")


def test_header_report_rows(spark):
    frame = spark.createDataFrame([(["a", " b"],), (["a", "a"],), ([],)], "names array<string>")
    got = [r.problem for r in header_report(frame, ["a", "b"]).collect()]
    assert got == [None, "duplicates", "empty"]


def test_create_tables_and_listing(spark, tmp_path, specs):
    create_tables(spark, specs)
    create_tables(spark, specs)
    assert spark.table(specs[1].table).columns[-3:] == ["snapshot_dt", "source_file", "load_ts"]
    write_csv(folder(tmp_path), BASIC, [basic_row(1)])
    paths = [r.path for r in list_files(spark, str(tmp_path / "in"), "*.csv").collect()]
    assert len(paths) == 1 and paths[0].endswith(BASIC.file_name)
    assert path_exists(spark, paths[0]) and not path_exists(spark, paths[0] + "x")


def test_jdbc_options():
    assert jdbc_options() == {"truncate": "true", "batchsize": "2000"}
    for bad in ("x", 0, -1):
        with pytest.raises(ValueError):
            jdbc_options(bad)


def test_replacement_characters_and_other_letters_are_legal_text(spark, tmp_path, specs):
    rows = [basic_row(1, charge_desc="was \ufffd here"), basic_row(2, charge_desc="\u3000Straße 日本\u3000")]
    write_csv(folder(tmp_path), BASIC, rows)
    write_csv(folder(tmp_path), DETAILS, [details_row(1)])
    load(spark, tmp_path, specs)
    found = {r.report_id: r.charge_desc for r in spark.table(specs[0].table).collect()}
    assert sorted(found.values()) == ["Straße 日本", "was \ufffd here"]


class Killed(BaseException):
    """Ends a load as a lost driver would: nothing is cleaned up."""


STEPS = [("write_run", 2, "after"), ("register_run", 1, "after"), ("register_run", 2, "after")]
STEPS += [("release", 1, "before_rename"), ("release", 1, "after"), ("install", 1, "after")]


@pytest.mark.parametrize("step, nth, when", STEPS)
def test_killed_load_leaves_all_tables_on_one_day(spark, tmp_path, specs, monkeypatch, step, nth, when):
    for i, day in enumerate(("2026-02-18", DAY)):
        write_csv(str(tmp_path / "in" / day), BASIC, [basic_row(k) for k in range(i + 1)])
        write_csv(str(tmp_path / "in" / day), DETAILS, [details_row(k) for k in range(i + 1)])
    run = lambda day: load_snapshots(spark, str(tmp_path / "in"), str(tmp_path / "wh"), day, specs, load_ts=STAMP)
    run("2026-02-18")
    original, calls = getattr(staging_job, step), []

    def failing(*args, **kwargs):
        calls.append(1)
        if len(calls) == nth and when == "before":
            raise Killed
        if when == "before_rename":
            monkeypatch.setattr(releases, "_hadoop_path", lambda s, p: (_ for _ in ()).throw(Killed) if "release-" in p else files_path(s, p))
        result = original(*args, **kwargs)
        if len(calls) == nth:
            raise Killed
        return result

    files_path = releases._hadoop_path
    monkeypatch.setattr(staging_job, step, failing)
    with pytest.raises(Killed):
        run(DAY)
    monkeypatch.undo()
    days = [{r.snapshot_dt.isoformat() for r in spark.table(s.table).collect()} for s in specs]
    expected = DAY if (step, when) == ("release", "after") else "2026-02-18"
    assert days == [{expected}, {expected}]
    assert [m.rows_replaced for m in run(DAY)] == ([2, 2] if expected == DAY else [1, 1])
    assert {r.snapshot_dt.isoformat() for s in specs for r in spark.table(s.table).collect()} == {DAY}


def test_of_two_loads_at_once_one_fails(spark, tmp_path, specs, monkeypatch):
    write_csv(folder(tmp_path), BASIC, [basic_row(1)])
    write_csv(folder(tmp_path), DETAILS, [details_row(1)])
    load(spark, tmp_path, specs)
    stale = releases.latest(spark, str(tmp_path / "wh"))
    load(spark, tmp_path, specs)
    monkeypatch.setattr(staging_job, "latest", lambda *_: stale)
    with pytest.raises(releases.ReleaseConflict):
        load(spark, tmp_path, specs)
    assert spark.table(specs[0].table).count() == 1
    assert len([p for p in tmp_path.rglob("run-*")]) == 4  # two releases of two tables


def test_bad_file_is_read_once_more_for_nothing(spark, tmp_path, specs, monkeypatch):
    """The first broken row comes from the load's own pass, whichever file, split and task it is in."""
    target = tmp_path / "in" / DAY / BASIC.file_name
    for name, bad in (("b.csv", 3), ("a.csv", 40)):
        rows = [basic_row(i, charge_desc="two\nlines") for i in range(50)]
        rows[bad]["injured"] = f"x{name[0]}"
        rows[bad + 1]["report_id"] = ""
        os.makedirs(target, exist_ok=True)
        os.rename(write_csv(str(tmp_path / "made"), BASIC, rows), target / name)
    write_csv(folder(tmp_path), DETAILS, [details_row(1)])
    monkeypatch.setattr(staging_job, "counted_splits", None)
    with pytest.raises(RowError, match="row 42, column injured: not a valid integer: 'xa'"):
        load(spark, tmp_path, specs)


def test_tables_of_their_own_are_not_replaced(spark, tmp_path, specs):
    schema = specs[0].table.split(".")[0]
    spark.sql(f"CREATE SCHEMA {schema}")
    spark.sql(specs[0].create_table_sql())
    with pytest.raises(RuntimeError, match="table of its own"):
        create_tables(spark, specs)
