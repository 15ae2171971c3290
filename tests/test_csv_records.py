import csv
import io
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadcast.sources import csv_records as recs
from roadcast.sources import csv_snapshots as csvs
from roadcast.sources import splits
from roadcast.specs import DatasetSpec


def plain(raw):
    """Records as the usual reader gives them from a text stream with translated line ends."""
    reader = csv.reader(io.TextIOWrapper(io.BytesIO(raw), encoding="latin-1"))
    return [row for row in reader if row]


@pytest.fixture()
def small_splits(spark):
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    yield lambda size: spark.conf.set(key, str(size))
    spark.conf.set(key, old)


def random_files(folder, count, seed):
    rng = random.Random(seed)
    made = {}
    for i in range(count):
        alphabet = rng.choice(['ab,"\n', 'a,"\n\r', '"\n', 'é,""\n\n ', 'abc,\n', '""",\n"a'])
        raw = "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 120))).encode()
        made[f"f{i:03d}.csv"] = raw
        (folder / f"f{i:03d}.csv").write_bytes(raw)
    return made


@pytest.mark.parametrize("size, sent", [(16, 1_000_000), (40, 0), (1 << 20, 1_000_000)])
def test_any_split_gives_the_records_of_one_reader(spark, tmp_path, small_splits, monkeypatch, size, sent):
    monkeypatch.setattr(splits, "MOST_SENT", sent)
    made = random_files(tmp_path, 60, size + sent)
    small_splits(size)
    states = csvs.read_states(spark, str(tmp_path))
    found = csvs.with_row_numbers(recs.records(spark, str(tmp_path), states), states)
    rows = found.select(F.regexp_extract("_file", "[^/]+$", 0), "row_num", recs.cells(F.col("record"))).collect()
    got = {name: [] for name in made}
    for name, number, cells in sorted(rows, key=lambda r: r[:2]):
        assert number == len(got[name]) + 1
        got[name].append(cells)
    # an open cell at the end of a file keeps no trace of the line end behind it
    trimmed = lambda records: [[*r[:-1], r[-1].rstrip("\n")] for r in records[-1:]]
    for name, raw in made.items():
        expected = plain(raw)
        assert got[name][:-1] == expected[:-1] and trimmed(got[name]) == trimmed(expected), (name, raw)
    if size < 20:
        assert states.filter("inside").count() > 10


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.booleans()), min_size=1, max_size=30), st.booleans())
def test_composed_states(lines, inside):
    opens, stays = (np.array([x[i] for x in lines]) for i in range(2))
    state, expected = inside, []
    for from_record, from_cell in lines:
        state = from_cell if state else from_record
        expected.append(state)
    assert recs.end_states(opens, stays, inside).tolist() == expected


def test_without_line_breaks_no_states_are_needed(spark, tmp_path, small_splits):
    spec = DatasetSpec("d", "x.d", "d.csv", ("k", "v"), frozenset())
    (tmp_path / "d.csv").write_text("k,v\n" + "".join(f'{i},"a ""{i}"" b"c\n\n' for i in range(500)))
    small_splits(700)
    raw = csvs.read_raw(spark, str(tmp_path / "d.csv"), spec, multi_line=False)
    assert raw.rdd.getNumPartitions() > 3
    numbered = csvs.with_row_numbers(raw, csvs.counted_splits(raw))
    rows = sorted((int(r.k), r.v, r.row_num) for r in numbered.collect())
    assert rows == [(i, f'a "{i}" bc', i + 2) for i in range(500)]


def test_one_record_over_many_splits(spark, tmp_path, small_splits):
    spec = DatasetSpec("d", "x.d", "d.csv", ("k", "v"), frozenset())
    text = "".join(f"line {i}, \"\"quoted\"\"\n" for i in range(300))
    (tmp_path / "d.csv").write_text(f'k,v\n1,"{text}"\n2,x\n3,"open\nend')
    small_splits(64)
    rows = {r.k: r.v for r in csvs.read_raw(spark, str(tmp_path / "d.csv"), spec).collect()}
    assert rows == {"1": text.replace('""', '"'), "2": "x", "3": "open\nend"}


def test_another_header_in_a_folder_fails_the_read(spark, tmp_path):
    spec = DatasetSpec("d", "x.d", "d.csv", ("k", "v"), frozenset())
    (tmp_path / "a.csv").write_text("k,v\n1,2\n")
    (tmp_path / "b.csv").write_text("v , k\n1,2\n")
    with pytest.raises(Exception, match="another header in .*b.csv"):
        csvs.read_raw(spark, str(tmp_path), spec).collect()


def test_splits_of_another_read_are_refused(spark, tmp_path, small_splits):
    spec = DatasetSpec("d", "x.d", "d.csv", ("k", "v"), frozenset())
    (tmp_path / "d.csv").write_text("k,v\n" + "1,2\n" * 200)
    states = csvs.read_states(spark, str(tmp_path))
    small_splits(100)
    with pytest.raises(Exception, match="no state for this split"):
        csvs.read_raw(spark, str(tmp_path), spec, states=states).collect()


def test_empty_folder_and_header_alone(spark, tmp_path):
    spec = DatasetSpec("d", "x.d", "d.csv", ("k", "v"), frozenset())
    (tmp_path / "d.csv").write_text("k,v")
    assert csvs.read_raw(spark, str(tmp_path), spec).count() == 0
    (tmp_path / "none").mkdir()
    assert csvs.read_header(spark, str(tmp_path / "none")) == []
