"""CSV files of any size: line breaks inside cells do not keep a file from being read by many tasks.

A file is scanned as lines, in byte ranges.  Whether a range begins inside a quoted cell is not known from the range alone, but
what it does to either state is: every range reports where it ends if it begins inside and if it begins outside a cell, and
putting these together in order (one small row per range) gives every range its state.  Then each task cuts its own records;
the few that cross a range's end are put together from their parts.  The cells are read by Spark's own CSV parser.

Columns go by name: every file is read by its own header, so the order of columns may differ from file to file.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from modlens.session import stored_table

#: the rest of a quoted cell, up to its closing quote; a doubled quote is a quote
CLOSING = re.compile(r'[^"]*+(?:""[^"]*+)*+"')
PARSER = {"escape": '"', "multiLine": "true"}
#: what a cut piece of text is
WHOLE, END, BEGINNING, MIDDLE = range(4)
MARK = "\ufeff"
#: lines that are made into Python's texts at once, and characters of records (or one record) that are given back at once
HELD_LINES, HELD_CHARS = 512, 1 << 20


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line ends inside a quoted cell; a quote opens a cell only as its first character."""
    at = 0
    if not inside and '"' not in line:
        return False
    while True:
        if inside or line.startswith('"', at):
            closing = CLOSING.match(line, at if inside else at + 1)
            if closing is None:
                return True
            inside, at = False, closing.end()
        at = line.find(",", at)
        if at < 0:
            return False
        at += 1


def header_names(header: str) -> tuple[str, ...]:
    """Column names of a header record; empty and repeated ones get their place, as Spark's own reader does it."""
    cells = next(csv.reader(io.StringIO(header.strip("\r\n").removeprefix(MARK), newline="")), [])
    low = [c.lower() for c in cells]
    return tuple(f"_c{i}" if not c else f"{c}{i}" if low.count(c.lower()) > 1 else c for i, c in enumerate(cells))


def read_csv(spark: SparkSession, path: str | list[str], path_column: str | None = None) -> DataFrame:
    """All columns of all files as text, by each file's own header; columns that a file lacks are null, and so are empty cells.

    Cells may hold line breaks; lines end in ``\\n`` or ``\\r\\n``.  A file may be compressed, and is one task then.  Empty
    records are left out, files without a record give no rows, and one that ends inside a cell ends its record there.  Columns
    stand in the order of their first file, files sorted by path; columns of partition folders (``name=value``) come last, as text.  The files are read once when the query is built (twice where
    a byte range begins inside a cell) and once when it runs; only a few values per byte range come to the driver.
    """
    source = F.col("_metadata")
    place = F.xxhash64(source["file_path"], source["file_block_start"]).alias("range")
    lines = spark.read.option("lineSep", "\n").text(path)
    folders = [c for c in lines.columns if c != "value"]
    folder_cells = [F.col(f"`{c}`").cast("string").alias(f"_f{i}") for i, c in enumerate(folders)]
    surveyed = lines.select(place, "value", source["file_path"].alias("path"), source["file_block_start"].alias("start"), *folder_cells)
    schema = "range bigint, path string, start bigint, from_outside boolean, from_inside boolean, header string"
    ranges = sorted(surveyed.mapInArrow(_survey, schema).collect(), key=lambda r: (r["path"], r["start"]))

    inside, groups, of_range, heads = {}, {}, {}, set()
    state = group = None
    open_ends = False
    for r in ranges:
        if r["start"] == 0:
            open_ends |= bool(state)
            state = False
            names = header_names(r["header"])
            group = groups.setdefault(names, len(groups)) if names else None
            heads.add(r["range"])
        inside[r["range"]], of_range[r["range"]] = state, group
        state = r["from_inside"] if state else r["from_outside"]
    open_ends |= bool(state)
    named = {names: i for names, i in groups.items()}
    columns = list(dict.fromkeys(c for names in named for c in names if c not in folders))
    if not columns:
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in [*folders, path_column or "_c0"]))

    beside = ["path", *(f"_f{i}" for i in range(len(folders)))]
    schema = "grp int, record string, " + ", ".join(f"{c} string" for c in beside)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        chars = 0
        for key, part, held, row in _cut(batches, inside, heads):
            if part == WHOLE:
                made.append((of_range[key], "\n".join(held).removesuffix("\r"), *row))
                chars += len(made[-1][1])
            if len(made) >= 4096 or chars >= HELD_CHARS:
                yield _batch(made, schema_names)
                made, chars = [], 0
        yield _batch(made, schema_names)

    schema_names = ["grp", "record", *beside]
    records = lines.select(place, "value", source["file_path"].alias("path"), *folder_cells).mapInArrow(whole, schema)
    if open_ends or any(inside.values()):
        crossing = _crossing(surveyed, inside, heads, of_range, beside[1:])
        records = records.unionByName(crossing.select(*records.columns))
    parsed = records.select(
        *(
            F.when(F.col("grp") == i, F.from_csv("record", ", ".join(f"_{k} string" for k in range(len(names))), PARSER)).alias(f"_p{i}")
            for names, i in named.items()
        ),
        *beside,
    )
    cells = {c: [F.col(f"_p{i}._{names.index(c)}") for names, i in named.items() if c in names] for c in columns}
    made = [F.coalesce(*found).alias(c) for c, found in cells.items()]
    made += [F.col(f"_f{i}").alias(c) for i, c in enumerate(folders)]
    return parsed.select(*made, *([F.col("path").alias(path_column)] if path_column else []))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Stretches of rows of one range."""
    ranges = batch.column(0).to_numpy()
    cuts = [0, *(np.flatnonzero(ranges[1:] != ranges[:-1]) + 1).tolist(), len(ranges)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield int(ranges[a]), batch.slice(a, b - a)


def _texts(column: pa.Array) -> Iterator[str]:
    """A column's texts, few of them as Python's at a time."""
    for at in range(0, len(column), HELD_LINES):
        yield from column.slice(at, HELD_LINES).to_pylist()


def _survey(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range of lines: its file and start, how it ends from either state, and the file's first record if it is there."""
    names = ["range", "path", "start", "from_outside", "from_inside", "header"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
    now: list | None = None
    reading = False

    def told() -> pa.RecordBatch:
        row = [*now[:5], "\n".join(now[5]) if now[2] == 0 else None]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names)

    for batch in batches:
        for key, rows in _runs(batch):
            if now is None or now[0] != key:
                if now:
                    yield told()
                now = [key, rows.column(2)[0].as_py(), rows.column(3)[0].as_py(), False, True, []]
                reading = now[2] == 0
            if reading:
                for i, line in enumerate(_texts(rows.column(1))):
                    if now[5] or line.strip("\r" + MARK):
                        now[5].append(line)
                        now[3] = ends_inside(line.removeprefix(MARK) if len(now[5]) == 1 else line, now[3])
                        if not now[3]:
                            reading, rows = False, rows.slice(i + 1)
                            break
                if reading:
                    continue
            for line in _texts(rows.column(1).filter(pc.match_substring(rows.column(1), '"'))):
                same = now[3] == now[4]
                now[3] = ends_inside(line, now[3])
                # a file does not begin inside a cell
                now[4] = now[3] if same or now[2] == 0 else ends_inside(line, now[4])
    if now:
        yield told()


def _cut(batches: Iterable[pa.RecordBatch], begins_inside: dict[int, bool], heads: set[int]) -> Iterator[tuple[int, int, list[str], list]]:
    """(range, part, lines, what stands beside them) of every record and part of a record, in order, without the header."""
    key, inside, part, head = None, False, WHOLE, False
    held: list[str] = []
    extra: list = []
    for batch in batches:
        for now, rows in _runs(batch):
            if now != key:
                if held:
                    yield key, MIDDLE if part == END else BEGINNING, held, extra
                if now not in begins_inside:
                    raise ValueError("other byte ranges than when the query was built: leave the settings for reading files as they were")
                key, inside, held, head = now, begins_inside[now], [], now in heads
                part = END if inside else WHOLE
                extra = [c[0].as_py() for c in rows.columns[2:]]
            for line in _texts(rows.column(1)):
                if '"' in line:
                    inside = ends_inside(line.removeprefix(MARK) if head and not held else line, inside)
                held.append(line)
                if inside:
                    continue
                if part == END or len(held) > 1 or line.strip("\r" + MARK if head else "\r"):
                    if head:
                        head = False
                    else:
                        yield key, part, held, extra
                held, part = [], WHOLE
    if held:
        yield key, MIDDLE if part == END else BEGINNING, held, extra


def _batch(made: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = [pa.array([m[i] for m in made], pa.string() if i else pa.int32()) for i in range(len(names))]
    return pa.RecordBatch.from_arrays(columns, names)


def _crossing(surveyed: DataFrame, inside: dict[int, bool], heads: set[int], of_range: dict[int, int | None], folders: list[str]) -> DataFrame:
    """(grp, record, path, folders) of the records that cross a range's end; also one that a file's end leaves open."""
    names = ["path", "start", *folders, "grp", "part", "text"]
    types = [pa.string(), pa.int64(), *([pa.string()] * len(folders)), pa.int32(), pa.int32(), pa.string()]
    schema = ", ".join(["path string", "start bigint", *(f"{c} string" for c in folders), "grp int", "part int", "text string"])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, part, held, beside in _cut(batches, inside, heads):
            if part != WHOLE:
                row = [*beside, of_range[key], part, "\n".join(held)]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names)

    found = stored_table(surveyed.mapInArrow(parts, schema), "crossing-records")
    # at most two parts per byte range of a file; a range's end part comes before its beginning part
    number = F.sum((F.col("part") == BEGINNING).cast("int")).over(W.partitionBy("path").orderBy("start", "part"))
    joined = found.withColumn("number", number).groupBy("grp", "path", *folders, "number")
    parts_in_order = F.array_sort(F.collect_list(F.struct("start", "part", "text")))
    text = F.array_join(F.transform(parts_in_order, lambda p: p["text"]), "\n")
    return joined.agg(F.regexp_replace(text, r"\r\z", "").alias("record")).select("grp", "record", "path", *folders)
