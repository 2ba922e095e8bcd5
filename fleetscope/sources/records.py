r"""CSV records of files that are read in splits, with the rows that Python's ``csv.reader`` gives.

A quote opens a quoted section only at the start of a cell; elsewhere it is an ordinary
character. Whether a line break ends a record therefore depends on all that stands
before it in the file. At a line break there are two states, outside and inside a quoted
section, and a line is a function from the state before it to the state behind it. So is
a block of lines (a split of a file):

1. Lines with a quote give two flags, found by a regular expression: whether they end
   inside when begun outside (``opens``), and when begun inside (``stays``). Other lines
   change nothing and leave the plan before any Python.
2. Each task composes the lines of its blocks; one small row a block comes out.
3. A running composition over the blocks of a file gives the state at every border. Only
   the borders at which it changes are kept.
4. Every task then knows where the records of its blocks begin. It cuts lines without
   quotes at their commas in Arrow, gives the others to ``csv.reader``, and sends the two
   ends of a record that crosses a border to be joined.

No file is read whole, nothing but borders crosses a shuffle, and the records of one
large file come from many tasks. The splits of steps 2 and 4 must be the same, so both
run in a session of their own with the settings of splits held fast, and the records are
stored.

Defined results: line breaks are \n, \r\n or \r and come out as \n inside cells, as
from a file opened as text; an empty line is a record without cells; a quote left open at
the end of a file ends there, without the last line break; a byte order mark is left out.
The files must not change while they are read.
"""

from __future__ import annotations

import csv
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetscope.session import scratch_path, ship_package

# All quantifiers are possessive: no backtracking, whatever a line holds.
_INSIDE = '(?:[^"]++|"")*+'
_CELL = f'(?:"{_INSIDE}"[^,]*+|(?!")[^,]*+)'
_LEFT_OPEN = rf'(?:{_CELL},)*+"{_INSIDE}\z'
OPENS = rf"\A{_LEFT_OPEN}"
STAYS = rf'\A{_INSIDE}(?:\z|"[^,]*+,{_LEFT_OPEN})'
#: Settings that decide how files are cut.
SPLITS = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
_RECORDS = "file string, block long, record long, cells array<string>, owner long, part string"


def split_session(spark: SparkSession) -> SparkSession:
    """A session on the same context whose splits stay the same from scan to scan."""
    own = spark.newSession()
    for key in SPLITS:
        own.conf.set(key, spark.conf.get(key))
    own.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    return own


def lines_of(spark: SparkSession, path: str | list[str], glob: str = "*", which: Column | None = None) -> DataFrame:
    """(file, block, value, quoted, opens, stays): the lines of every file below ``path`` in order, with the byte at
    which their split begins. ``which`` filters files by ``_metadata``."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path)
    if which is not None:
        lines = lines.filter(which)
    value = F.col("value")
    quoted = value.contains('"')
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value",
                        quoted.alias("quoted"), (quoted & value.rlike(OPENS)).alias("opens"), (~quoted | value.rlike(STAYS)).alias("stays"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """The parts of a batch that come from one block."""
    if not batch.num_rows:
        return
    file = batch.column("file").dictionary_encode().indices.to_numpy()
    block = batch.column("block").to_numpy()
    edges = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows], strict=True):
        yield (batch.column("file")[a].as_py(), int(block[a])), batch.slice(a, b - a)


def _states(run: pa.RecordBatch, state: bool) -> tuple[np.ndarray, bool]:
    """(whether each line begins inside a quoted section, whether the last one ends inside)."""
    opens, stays = (run.column(c).to_numpy(zero_copy_only=False) for c in ("opens", "stays"))
    n = len(opens)
    turns = np.cumsum(opens & ~stays)
    fixed = np.maximum.accumulate(np.where(opens == stays, np.arange(n), -1))
    known = np.maximum(fixed, 0)
    after = np.where(fixed >= 0, opens[known] ^ ((turns - turns[known]) & 1).astype(bool), bool(state) ^ (turns & 1).astype(bool))
    return np.append(bool(state), after[:-1]), bool(after[-1])


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, opens, stays, begins): the function of each block that has lines with quotes, and whether
    a record begins in it when it is begun inside."""
    out: dict[tuple[str, int], tuple[bool, bool, bool]] = {}
    for batch in batches:
        for key, run in _runs(batch):
            opens, stays, begins = out.get(key, (False, True, False))
            before, stays = _states(run, stays)
            out[key] = (_states(run, opens)[1], stays, begins or not before.all())
    yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in out], pa.string()), pa.array([b for _, b in out], pa.int64()),
                                      *(pa.array([v[i] for v in out.values()], pa.bool_()) for i in range(3))],
                                     names=["file", "block", "opens", "stays", "begins"])


def open_borders(lines: DataFrame) -> dict[str, tuple[list[int], list[bool]]]:
    """Per file the blocks behind which another record is open than at the border before, or none any more.

    At most a row per split, as Spark's driver holds the splits themselves; mostly none."""
    blocks = lines.filter("quoted").select("file", "block", "opens", "stays").mapInArrow(
        _compose, "file string, block long, opens boolean, stays boolean, begins boolean")
    bit = lambda c: F.col(c).cast("int")
    order = Window.partitionBy("file").orderBy("block")
    turns = F.sum((F.col("opens") & ~F.col("stays")).cast("int")).over(order)
    fixed = blocks.withColumn("turns", turns).withColumn(
        "base", F.last(F.when(F.col("opens") == F.col("stays"), bit("opens") + F.col("turns")), ignorenulls=True).over(order))
    state = fixed.withColumn("state", F.pmod(F.coalesce("base", F.lit(0)) + F.col("turns"), F.lit(2)) == 1)
    changed = state.withColumn("before", F.lag("state", 1, False).over(order)).filter("state <> before OR (state AND begins)")
    found: dict[str, tuple[list[int], list[bool]]] = {}
    for r in changed.select("file", "block", "state").orderBy("file", "block").collect():
        blocks_of, states = found.setdefault(r["file"], ([], []))
        blocks_of.append(r["block"])
        states.append(r["state"])
    return found


def _rows(lines: list[str]) -> list[list[str]]:
    csv.field_size_limit(sys.maxsize)
    return list(csv.reader(lines))


def _row(text: str) -> list[str]:
    """The cells of one record."""
    lines = text.split("\n")
    return _rows([*(x + "\n" for x in lines[:-1]), lines[-1] or "\n"])[0]


def _cut(run: pa.RecordBatch, at: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The cells of the records that begin at the lines ``at`` and have ``sizes`` lines."""
    values = run.column("value")
    plain = ~run.column("quoted").to_numpy(zero_copy_only=False)[at] & (sizes == 1) & (pc.binary_length(values).to_numpy()[at] > 0)
    kind = pa.list_(pa.string())
    simple = pc.split_pattern(values.take(pa.array(at[plain])), ",").cast(kind)
    if plain.all():
        return simple
    rest = np.flatnonzero(~plain)
    mine = np.repeat(at[rest], sizes[rest]) + np.arange(int(sizes[rest].sum())) - np.repeat(np.cumsum(sizes[rest]) - sizes[rest], sizes[rest])
    parsed = _rows([v + "\n" for v in values.take(pa.array(mine)).to_pylist()])
    if len(parsed) != len(rest):
        raise RuntimeError(f"{len(parsed)} records where the borders say {len(rest)}")
    place = np.empty(len(at), np.int64)
    place[np.flatnonzero(plain)] = np.arange(int(plain.sum()))
    place[rest] = int(plain.sum()) + np.arange(len(rest))
    return pa.concat_arrays([simple, pa.array(parsed, kind)]).take(pa.array(place))


class _Block:
    """The records of one block as its lines come."""

    def __init__(self, key: tuple[str, int], borders: dict[str, tuple[list[int], list[bool]]]) -> None:
        self.file, self.block = key
        blocks, states = borders.get(self.file, ([], []))
        at = int(np.searchsorted(blocks, self.block)) - 1
        self.inside = at >= 0 and states[at]
        #: The block in which the record that is open here began.
        self.owner = blocks[at] if self.inside else self.block
        self.open: list[str] = []
        self.number = 0

    def _out(self, record: list[int | None], cells: pa.Array | None, owner: int | None = None, part: str | None = None) -> pa.RecordBatch:
        n = len(record)
        return pa.RecordBatch.from_arrays([
            pa.array([self.file] * n), pa.array([self.block] * n, pa.int64()), pa.array(record, pa.int64()),
            pa.nulls(n, pa.list_(pa.string())) if cells is None else cells, pa.array([owner] * n, pa.int64()), pa.array([part] * n, pa.string())],
            names=["file", "block", "record", "cells", "owner", "part"])

    def _close(self) -> pa.RecordBatch:
        """What was open has come to its end: a record of this block, or the end of another's."""
        text, self.open = "\n".join(self.open), []
        if self.owner != self.block:
            owner, self.owner = self.owner, self.block
            return self._out([None], None, owner, text)
        self.number += 1
        return self._out([self.number - 1], pa.array([_row(text)], pa.list_(pa.string())))

    def add(self, run: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        begun = self.inside
        before, self.inside = _states(run, begun)
        starts = np.flatnonzero(~before)
        head = int(starts[0]) if len(starts) else run.num_rows
        if begun:
            self.open += run.column("value").slice(0, head).to_pylist()
        if not len(starts):
            return
        if begun:
            yield self._close()
        sizes = np.diff(np.append(starts, run.num_rows))
        if self.inside:
            self.open = run.column("value").slice(int(starts[-1])).to_pylist()
            starts, sizes = starts[:-1], sizes[:-1]
        if len(starts):
            numbers = list(range(self.number, self.number + len(starts)))
            self.number += len(starts)
            yield self._out(numbers, _cut(run, starts, sizes))

    def end(self) -> Iterator[pa.RecordBatch]:
        if not self.open:
            return
        if not self.inside:
            yield self._close()
        else:
            yield self._out([self.number if self.owner == self.block else None], None, self.owner, "\n".join(self.open))


def _records(borders: dict[str, tuple[list[int], list[bool]]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now = None, None
        for batch in batches:
            for k, part in _runs(batch):
                if k != key:
                    if now is not None:
                        yield from now.end()
                    key, now = k, _Block(k, borders)
                yield from now.add(part)
        if now is not None:
            yield from now.end()

    return run


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cells = [_row(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("block"), batch.column("record"), pa.array(cells, pa.list_(pa.string()))],
                                         names=["file", "block", "record", "cells"])


def read_records(spark: SparkSession, path: str | list[str], glob: str = "*", which: Column | None = None) -> DataFrame:
    """(file, block, record, cells): every record of every file below ``path``; stored.

    ``block`` is the byte at which the split begins in which the record does, ``record`` its number there, so
    (block, record) is the order of a file's records."""
    ship_package(spark)
    own = split_session(spark)
    lines = lines_of(own, path, glob, which)
    borders = open_borders(lines)
    out = scratch_path(spark, "records")
    lines.mapInArrow(_records(borders), _RECORDS).write.parquet(out)
    found = spark.read.schema(_RECORDS).parquet(out)
    whole = found.filter("owner IS NULL").select("file", "block", "record", "cells")
    if not borders:
        return whole
    parts = found.filter("owner IS NOT NULL").groupBy("file", "owner").agg(
        F.max("record").alias("record"), F.sort_array(F.collect_list(F.struct("block", "part"))).alias("parts"))
    texts = parts.select("file", F.col("owner").alias("block"), "record", F.array_join("parts.part", "\n").alias("text"))
    return whole.unionByName(texts.mapInArrow(_joined, "file string, block long, record long, cells array<string>"))
