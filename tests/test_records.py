"""S1's record scan against ``csv.reader``, with splits of a few bytes."""

import csv
import os
import random

import pytest
from pyspark.sql import functions as F

from fleetscope.sources import records as R


@pytest.fixture()
def small_splits(spark):
    """Files are cut every 96 bytes."""
    old = {k: spark.conf.get(k) for k in R.SPLITS}
    for k in R.SPLITS:
        spark.conf.set(k, "96")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def write(folder, name, text):
    os.makedirs(os.path.dirname(f"{folder}/{name}"), exist_ok=True)
    with open(f"{folder}/{name}", "w", newline="", encoding="utf-8") as f:
        f.write(text)


def plain(folder, name):
    with open(f"{folder}/{name}", encoding="utf-8") as f:
        return list(csv.reader(f))


def read(spark, folder):
    rows = R.read_records(spark, folder).withColumn("name", F.substring_index("file", "/", -1)).orderBy("name", "block", "record").collect()
    out = {}
    for r in rows:
        out.setdefault(r["name"], []).append(r["cells"])
    return out, rows


def test_stray_quotes_are_ordinary_characters(spark, tmp_dir):
    write(tmp_dir, "a", 'd1,A"1,x,5\nd2,B-2,y,6\nd3,C"3,z,7\n"q"r"s,"t""u",\n""\n\n,\n')
    got, _ = read(spark, tmp_dir)
    assert got == {"a": plain(tmp_dir, "a")}
    assert got["a"][:4] == [["d1", 'A"1', "x", "5"], ["d2", "B-2", "y", "6"], ["d3", 'C"3', "z", "7"], ['qr"s', 't"u', ""]] and got["a"][5] == []


@pytest.mark.parametrize("seed", range(4))
def test_random_files_equal_csv_reader(small_splits, tmp_dir, seed):
    rng = random.Random(seed)
    parts = ["a", "bc", ",", ",", '"', '"', '""', "\n", "\n", "\r\n", "é", " ", "\x85", "\\", "#", "\x00"]
    for k in range(6):
        text = "".join(rng.choices(parts, [5, 5, 4, 4, rng.choice([0.2, 2, 4]), 1, 1, 2, 2, 1, 1, 1, 0.2, 0.2, 0.2, 0.1], k=rng.randint(0, 500)))
        write(tmp_dir, f"f{k:02}", text + rng.choice(["", "\n", '"\n']))
    got, rows = read(small_splits, tmp_dir)
    for name in sorted(os.listdir(tmp_dir)):
        want, mine = plain(tmp_dir, name), got.get(name, [])
        if mine != want:  # only a quote left open at the end: the last line break is not known
            assert len(mine) == len(want) and mine[:-1] == want[:-1] and mine[-1][:-1] == want[-1][:-1] and mine[-1][-1] + "\n" == want[-1][-1]
    assert len({(r["file"], r["block"]) for r in rows}) > 6


def test_one_file_comes_from_many_tasks_and_records_cross_many_borders(small_splits, tmp_dir):
    body = "".join(f'{i},"x{i}\n{"long line of text " * (i % 12)}\n\nend",{i}\n' if i % 5 == 0 else f"{i},plain,{i}\n" for i in range(60))
    write(tmp_dir, "one", body)
    got, rows = read(small_splits, tmp_dir)
    assert got["one"] == plain(tmp_dir, "one")
    assert len({r["block"] for r in rows}) > 10


def test_borders_are_few_and_lines_without_quotes_leave_no_work(small_splits, tmp_dir):
    write(tmp_dir, "clean", "a,b,c\n" * 100)
    write(tmp_dir, "quoted", '"a,b",c\n' * 100)
    lines = R.lines_of(R.split_session(small_splits), tmp_dir)
    assert R.open_borders(lines) == {}
    write(tmp_dir, "open", 'a,"b\n' + "x\n" * 200 + '",c\n')
    borders = R.open_borders(R.lines_of(R.split_session(small_splits), tmp_dir))
    assert [s for _, s in borders.values()] == [[True, False]]


def test_long_lines_do_not_recurse(spark, tmp_dir):
    line = '"' + 'a""' * 300_000 + '",' + '"x"y,' * 100_000 + "z"
    write(tmp_dir, "a", line + "\n" + line + "\n")
    got, _ = read(spark, tmp_dir)
    csv.field_size_limit(1 << 30)
    assert got["a"] == plain(tmp_dir, "a")
