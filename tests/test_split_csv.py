"""Files with line breaks in cells, cut at any byte, against the reader that takes a file whole."""

import csv
import random

import pytest

from parcelworks.sources import csv_files, split_csv

CELLS = ["", "a", "1.5", "two words", "line\nbreak", "\n", "\n\n", 'say "hi"', '"', "a,b", 'x"\n"y', "é\r\nß", " ", '""']
NAMES = ["A", "B", "C,1", "D\nE"]


def written(path, r, rows, end="\n", blank=0.0):
    with open(path, "w", newline="", encoding="utf-8") as sink:
        writer = csv.writer(sink, lineterminator=end, quoting=r.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
        writer.writerow(NAMES)
        for _ in range(rows):
            writer.writerow(["k", *[r.choice(CELLS) for _ in NAMES[1:]]])
            if r.random() < blank:
                sink.write(end)


def whole(spark, paths):
    frame = spark.read.options(**csv_files.DIALECT).schema(csv_files.text_schema(NAMES)).csv(paths)
    return sorted(map(repr, map(tuple, frame.collect())))


def plain(paths):
    """What Python's own reader finds below the headers; an empty cell is null, a blank line no row."""
    found = []
    for path in paths:
        with open(path, newline="", encoding="utf-8") as source:
            found += [tuple(cell or None for cell in row) for row in list(csv.reader(source))[1:] if row]
    return sorted(map(repr, found))


def split(spark, paths):
    return sorted(repr(tuple(row)) for row in split_csv.read_split(spark, NAMES, paths, csv_files.DIALECT).drop("path").collect())


@pytest.fixture
def small_ranges(spark):
    """Ranges of so many bytes, for a test."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {name: spark.conf.get(name, None) for name in names}

    def cut(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "0")
        spark.conf.set(names[2], "1")

    yield cut
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("seed", range(6))
def test_any_cut_gives_the_rows_of_the_whole_file(spark, tmp_path, small_ranges, seed):
    r = random.Random(seed)
    paths = [str(tmp_path / f"Sold2024{n:02}.csv") for n in (1, 2)]
    end = r.choice(["\n", "\r\n"])
    for path in paths:
        written(path, r, r.randint(0, 60), end=end, blank=0.1)
    # with such lines Spark's reader takes a blank one for a row
    expected = plain(paths)
    assert end == "\r\n" or expected == whole(spark, paths)
    small_ranges(r.choice([7, 23, 64, 150, 400]))
    assert split(spark, paths) == expected
    counts = {row.path.rpartition("/")[2]: row.rows for row in split_csv.records_per_file(spark, paths).collect()}
    assert counts == {path.rpartition("/")[2]: len(plain([path])) for path in paths}


def test_one_file_is_many_tasks(spark, tmp_path, small_ranges):
    path = str(tmp_path / "Sold202401.csv")
    written(path, random.Random(9), 400)
    small_ranges(2000)
    table = split_csv.read_split(spark, NAMES, [path], csv_files.DIALECT)
    assert split_csv._lines(spark, [path]).rdd.getNumPartitions() > 5
    assert table.count() == 400
    assert split_csv.ranges(spark, [path]).filter("within").count() > 0


def test_a_cell_left_open_ends_with_the_file(spark, tmp_path):
    path = tmp_path / "Sold202401.csv"
    path.write_text('A,B,"C,1","D\nE"\n1,2,3,4\n5,6,7,"open\nuntil the end')
    assert split(spark, [str(path)]) == sorted([repr(("1", "2", "3", "4")), repr(("5", "6", "7", "open\nuntil the end"))])
    assert split_csv.records_per_file(spark, [str(path)]).first().rows == 2


def test_files_without_rows(spark, tmp_path):
    path = tmp_path / "Sold202401.csv"
    path.write_text('A,B,"C,1","D\nE"')
    assert split(spark, [str(path)]) == [] and split_csv.records_per_file(spark, [str(path)]).first().rows == 0


def test_too_many_open_ranges_fall_back_to_whole_files(spark, tmp_path, small_ranges, monkeypatch):
    path = str(tmp_path / "Sold202401.csv")
    written(path, random.Random(4), 200)
    expected = sorted(map(repr, map(tuple, csv_files.read_csv(spark, [path]).collect())))
    monkeypatch.setattr(split_csv, "OPEN_RANGES", 0)
    small_ranges(300)
    assert split_csv.records(spark, [path]) is None
    assert sorted(map(repr, map(tuple, csv_files.read_csv(spark, [path]).collect()))) == expected
