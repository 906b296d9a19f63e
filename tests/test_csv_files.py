"""Header CSV files: folders of differing headers, globs, and reading in splits."""

from __future__ import annotations

import csv
import datetime as dt
import io

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tremor.plans import jobs
from tremor.session import size_for
from tremor.sources import read_catalog, read_feed
from tremor.sources.csv_files import JOIN, SPLIT, WHOLE, BrokenCsvError, file_ways, read_csv_text, split_profile


def write(path, text):
    with open(path, "w", newline="") as fh:
        fh.write(text)


@pytest.fixture()
def small_splits(spark):
    """Files fall into splits of about two kilobytes."""
    keys = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


FIRST = "time,latitude,longitude,depth,mag,place\n2024-01-01T00:00:00Z,31,71,11,6.6,One\n"
SECOND = "time,mag,latitude,longitude,depth,place,felt\n2024-01-02T00:00:00Z,3.3,32,72,12,Two,9\n"


@pytest.mark.parametrize("multi_line", [None, True, False])
def test_columns_in_another_order_stay_with_their_names(spark, tmp_dir, multi_line):
    write(f"{tmp_dir}/a.csv", FIRST)
    write(f"{tmp_dir}/b.csv", SECOND)
    write(f"{tmp_dir}/c.csv", "time,mag\n")
    write(f"{tmp_dir}/d.csv", "")
    for path in (tmp_dir, f"{tmp_dir}/*.csv", f"{tmp_dir}/[ab].csv"):
        rows = {r["place"]: r for r in read_feed(spark, path, "f", multi_line=multi_line).collect()}
        one, two = rows["One"], rows["Two"]
        assert (one["mag"], one["latitude"], one["longitude"], one["depth"], one["felt"]) == (6.6, 31, 71, 11, None)
        assert (two["mag"], two["latitude"], two["longitude"], two["depth"], two["felt"]) == (3.3, 32, 72, 12, "9")
        assert two["time"] == dt.datetime(2024, 1, 2) and len(rows) == 2


def test_a_given_schema_goes_by_name(spark, tmp_dir):
    write(f"{tmp_dir}/a.csv", FIRST)
    write(f"{tmp_dir}/b.csv", SECOND)
    schema = spark.createDataFrame([], "mag double, place string, time string, latitude double").schema
    rows = {r["place"]: r for r in read_catalog(spark, tmp_dir, fmt="csv", schema=schema).collect()}
    assert (rows["One"]["mag"], rows["One"]["latitude"], rows["Two"]["mag"], rows["Two"]["latitude"]) == (6.6, 31, 3.3, 32)


def test_odd_file_names(spark, tmp_dir):
    import os

    for name, text in [("a b [1].csv", FIRST), ("50% {x}.csv", SECOND), ("ü, *.csv", SECOND.replace("Two", "Three"))]:
        write(os.path.join(tmp_dir, name), text)
    assert sorted(r["place"] for r in read_csv_text(spark, tmp_dir).collect()) == ["One", "Three", "Two"]


def test_no_lines_at_all(spark, tmp_dir):
    write(f"{tmp_dir}/a.csv", "")
    assert read_csv_text(spark, tmp_dir).count() == 0


def test_job_over_a_glob(spark, tmp_dir):
    write(f"{tmp_dir}/a.csv", FIRST)
    write(f"{tmp_dir}/b.csv", SECOND)
    assert jobs.main(["--multi-line", "never", "build-catalog", "--feed", f"{tmp_dir}/*.csv", "--out", f"{tmp_dir}/cat"]) == 0
    assert {(r["place"], r["mag"], r["region"]) for r in spark.read.parquet(f"{tmp_dir}/cat").collect()} == {
        ("One", 6.6, "Pakistan"), ("Two", 3.3, "Pakistan")}


def test_sizing_of_globs_and_of_what_is_not_there(spark, tmp_dir):
    write(f"{tmp_dir}/a.csv", FIRST)
    from tremor.session import input_bytes

    before = {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")}
    assert input_bytes(spark, [f"{tmp_dir}/*.csv"]) == len(FIRST)
    assert input_bytes(spark, [f"{tmp_dir}/*.csv", f"{tmp_dir}/none", "nosuchfs://x/y"]) == len(FIRST)
    assert size_for(spark, [f"{tmp_dir}/none"])["spark.sql.shuffle.partitions"]
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def csv_text(rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    return out.getvalue()


def plain(n):
    return [["time", "place", "mag"], *([f"2024-01-01T00:00:{i % 60:02d}Z", f"{i} km, of Town", f"{i % 9}.5"] for i in range(n))]


def crossing(n):
    return [["id", "place", "note"], *([str(i), f"line {i}\nnext \"{'x' * (i % 40)}\"\n\n  last," if i % 7 == 3 else f"place {i}",
                                       "\r\n" * (i % 11 == 5) + f"note {i}"] for i in range(n))]


def ways(spark, path):
    return [r["way"] for r in file_ways(split_profile(spark, path)).collect()]


def test_a_large_file_is_read_by_several_tasks(spark, tmp_dir, small_splits):
    write(f"{tmp_dir}/a.csv", csv_text(plain(600)))
    assert ways(spark, tmp_dir) == [SPLIT]
    split = read_csv_text(spark, tmp_dir)
    assert split.rdd.getNumPartitions() > 5
    assert rows_of(split) == rows_of(read_csv_text(spark, tmp_dir, multi_line=True)) == sorted(map(tuple, plain(600)[1:]), key=str)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_that_cross_lines_and_splits(spark, tmp_dir, small_splits, end):
    rows = crossing(700)
    write(f"{tmp_dir}/a.csv", csv_text(rows, end))
    assert ways(spark, tmp_dir) == [JOIN]
    got = read_csv_text(spark, tmp_dir)
    want = [tuple(v or None for v in r) for r in rows[1:]]
    assert rows_of(got) == sorted(want, key=str)
    assert got.columns == rows[0]
    with pytest.raises(BrokenCsvError):
        read_csv_text(spark, tmp_dir, multi_line=False)


def test_a_field_longer_than_a_split(spark, tmp_dir, small_splits):
    rows = [["id", "place"], ["1", "a"], ["2", "\n".join(f"line {i}" for i in range(2000))], ["3", "b"], ["4", "x\ny"]]
    write(f"{tmp_dir}/a.csv", csv_text(rows))
    assert ways(spark, tmp_dir) == [JOIN]
    assert rows_of(read_csv_text(spark, tmp_dir)) == sorted(map(tuple, rows[1:]), key=str)


def test_irregular_quotes_are_left_to_the_reader(spark, tmp_dir, small_splits):
    text = "id,place\n" + "".join(f'{i},5" pipe {i}\n' if i == 300 else f"{i},place {i}\n" for i in range(600))
    write(f"{tmp_dir}/a.csv", text)
    assert ways(spark, tmp_dir) == [WHOLE]
    assert rows_of(read_csv_text(spark, tmp_dir)) == rows_of(read_csv_text(spark, tmp_dir, multi_line=True))


def test_quotes_that_only_look_regular_fail_the_read(spark, tmp_dir, small_splits):
    text = "id,place\n" + "".join(f'{i},"a",pipe"\n' if i in (300, 400) else f"{i},place {i}\n" for i in range(600))
    write(f"{tmp_dir}/a.csv", text)
    assert ways(spark, tmp_dir) == [JOIN]
    with pytest.raises(Exception, match="irregular quotes"):
        read_csv_text(spark, tmp_dir).collect()


def test_old_line_ends(spark, tmp_dir):
    write(f"{tmp_dir}/a.csv", "id,place\r1,a\r2,b\r")
    assert ways(spark, tmp_dir) == [WHOLE]
    assert rows_of(read_csv_text(spark, tmp_dir)) == [("1", "a"), ("2", "b")]


FIELD = st.text(alphabet='ab,"\n ', max_size=12)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(FIELD, FIELD), min_size=20, max_size=60), st.sampled_from(["\n", "\r\n"]), st.integers(0, 2**32))
def test_splits_equal_whole_files(spark, small_splits, rows, end, seed):
    import tempfile

    folder = tempfile.mkdtemp(prefix="tremor-csv-")
    table = [["id", "p", "q"], *([str(i), *rows[i % len(rows)]] for i in range(max(len(rows), 160)))]
    write(f"{folder}/a.csv", csv_text(table, end))
    assert rows_of(read_csv_text(spark, folder)) == rows_of(read_csv_text(spark, folder, multi_line=True))
