"""Records of CSV files whose quoted fields hold line breaks, cut in parallel from any number of blocks of one file (SRC-1)."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from venuelens.operators.materialize import materialize

#: The rest of a quoted field: up to a quote that is not doubled.
_CLOSE = re.compile(r'(?:[^"]|"")*+"')

_PLACE = "path string, start long"


def ends_inside(line: str, inside: bool, separator: str = ",") -> bool:
    """Whether a quoted field is open after a line, given whether one was open before it.

    A quote opens a field only as its first character, and a doubled quote stays inside; what follows a closing quote up to the
    separator belongs to the field.
    """
    if '"' not in line:
        return inside
    at = 0
    while True:
        if inside or line.startswith('"', at):
            closed = _CLOSE.match(line, at if inside else at + 1)
            if closed is None:
                return True
            inside, at = False, closed.end()
        at = line.find(separator, at)
        if at < 0:
            return False
        at += len(separator)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, start, line): the lines of each block in their order; Spark deals files to tasks in blocks that begin at a line."""
    text = spark.read.text(path, lineSep="\n")
    return text.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list[str]]]:
    """Runs of lines of one block. A block may come in several runs, one after another."""
    for batch in batches:
        paths, starts, lines = (batch.column(i).to_pylist() for i in range(3))
        begin = 0
        for i in range(1, len(lines) + 1):
            if i == len(lines) or starts[i] != starts[begin] or paths[i] != paths[begin]:
                yield (paths[begin], starts[begin]), lines[begin:i]
                begin = i


def _open_blocks(lines: DataFrame, separator: str) -> DataFrame:
    """(path, starts) of each file: where the blocks begin that start inside a quoted field.

    A block says how it ends if it begins outside, and how if inside. One small row for each block is put
    together in the order of the file; the state before each block follows from those of the blocks before it.
    """

    def run(batches):
        at, ends = None, [False, True]
        for place, some in _blocks(batches):
            if place != at:
                if at is not None:
                    yield _row(at, ends)
                at, ends = place, [False, True]
            for line in some:
                if '"' in line:
                    ends = [ends_inside(line, e, separator) for e in ends] if ends[0] != ends[1] else [ends_inside(line, ends[0], separator)] * 2
        if at is not None:
            yield _row(at, ends)

    def _row(place, ends):
        return pa.RecordBatch.from_pydict({"path": [place[0]], "start": [place[1]], "outside": [ends[0]], "inside": [ends[1]]})

    blocks = lines.mapInArrow(run, f"{_PLACE}, outside boolean, inside boolean")
    ordered = F.sort_array(F.collect_list(F.struct("start", "outside", "inside")))
    nothing = F.struct(F.lit(False).alias("open"), F.array().cast("array<long>").alias("starts"))
    walk = F.aggregate(
        ordered,
        nothing,
        lambda seen, b: F.struct(
            F.when(seen["open"], b["inside"]).otherwise(b["outside"]).alias("open"),
            F.when(seen["open"], F.concat(seen["starts"], F.array(b["start"]))).otherwise(seen["starts"]).alias("starts"),
        ),
    )
    return blocks.groupBy("path").agg(walk.alias("walk")).select("path", F.col("walk.starts").alias("starts"))


def _cut(lines: DataFrame, begins_inside: dict[str, list[int]], separator: str) -> DataFrame:
    """(path, start, record, fragment): the records that lie within a block, and the first and last pieces of those that do not.

    `opens` tells a fragment that begins a record from those that go on with one. Blank lines between records are no records.
    """
    spark = lines.sparkSession
    shared = spark.sparkContext.broadcast({path: frozenset(starts) for path, starts in begins_inside.items()})

    def run(batches):
        at, inside, kept, whole, number = None, False, [], True, 0
        for place, some in _blocks(batches):
            out = []
            if place != at:
                if kept:
                    out.append((*at, number, None, "\n".join(kept), whole))
                at, inside, kept, number = place, place[1] in shared.value.get(place[0], ()), [], 0
                whole = not inside  # whether what is kept begins a record
            for line in some:
                inside = ends_inside(line, inside, separator)
                kept.append(line)
                if inside:
                    continue
                text = "\n".join(kept) if len(kept) > 1 else line
                if whole and text in ("", "\r"):
                    kept = []
                    continue
                out.append((*at, number, text, None, True) if whole else (*at, number, None, text, False))
                kept, whole, number = [], True, number + 1
            if out:
                yield _batch(out)
        if kept:
            yield _batch([(*at, number, None, "\n".join(kept), whole)])

    def _batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    names = ["path", "start", "number", "record", "fragment", "opens"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_()]
    return lines.mapInArrow(run, f"{_PLACE}, number long, record string, fragment string, opens boolean")


def _joined(fragments: DataFrame) -> DataFrame:
    """(path, start, record) of the records that reach over block borders, at most one for each block."""
    pieces = F.sort_array(F.collect_list(F.struct("start", "number", "opens", "fragment")))
    # A record is an opening fragment and all that follow it up to the next one.
    grouped = F.aggregate(
        pieces,
        F.array().cast("array<struct<start:bigint,number:bigint,record:string>>"),
        lambda seen, p: F.when(
            p["opens"] | (F.size(seen) == 0), F.concat(seen, F.array(F.struct(p["start"].alias("start"), p["number"].alias("number"), p["fragment"].alias("record"))))
        ).otherwise(
            F.concat(
                F.slice(seen, 1, F.size(seen) - 1),
                F.array(
                    F.struct(
                        F.element_at(seen, -1)["start"].alias("start"),
                        F.element_at(seen, -1)["number"].alias("number"),
                        F.concat_ws("\n", F.element_at(seen, -1)["record"], p["fragment"]).alias("record"),
                    )
                ),
            )
        ),
    )
    return fragments.groupBy("path").agg(grouped.alias("records")).select("path", F.inline("records"))


def read_records(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """(path, start, number, record): every record of the CSV files at `path`, line breaks inside quotes kept, read by as many tasks as there are blocks.

    Lines end with a line feed, with or without a carriage return before it. Two passes: in the first each block reports whether a quoted field is open at its end, for both
    states it may begin in; in the second, records are cut where none is open. Records are kept in Parquet; of a record that
    reaches over a border its pieces meet by file, at most two for each block. The driver holds one number for each block
    that begins inside quotes (8 MB for 100 TB at 100 MB a block). Blank lines between records are left out. The first record of a
    file, its header, has start 0 and number 0.
    """
    lines = _lines(spark, path)
    # Both passes must cut the files in the same way, whatever number of cores there is by then.
    key = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(key, None)
    spark.conf.set(key, before or str(spark.sparkContext.defaultParallelism))
    try:
        begins_inside = {r["path"]: r["starts"] for r in _open_blocks(lines, separator).where("size(starts) > 0").toLocalIterator()}
        cut = materialize(_cut(lines, begins_inside, separator))
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    columns = ["path", "start", "number", "record"]
    records = cut.where("record is not null").select(*columns).union(_joined(cut.where("fragment is not null")).select(*columns))
    return records.withColumn("record", F.regexp_replace("record", r"\r\z", "")).where("record <> ''")


def parse_records(records: DataFrame, schema: T.StructType, separator: str = ",") -> DataFrame:
    """The fields of each record as text columns named by `schema`; headers are left out."""
    texts = ", ".join(f"`{f.name}` STRING" for f in schema.fields)
    options = {"sep": separator, "quote": '"', "escape": '"', "multiLine": "true"}
    return records.where("not (start = 0 and number = 0)").select(F.from_csv("record", texts, options).alias("_csv")).select("_csv.*")
