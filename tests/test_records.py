from __future__ import annotations

import csv
import io
import random

import pytest
from pyspark.sql import types as T

from venuelens.sources import readers, records

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "title", "text", "last")])


def written(seed: int, n: int, end: str = "\n") -> tuple[str, list[tuple]]:
    """CSV of n records whose texts hold line breaks, separators and quotes; some fields are only quotes or empty. And the records."""
    rng, out, rows = random.Random(seed), io.StringIO(), []
    write = csv.writer(out, lineterminator=end)
    write.writerow(["id", "title", "a\nheader"[: 1 + 7 * (seed % 2)], "last"])
    for i in range(n):
        bits = ["word", ",", "\n", '"', "é", " ", "\n\n", '""', "x" * rng.randrange(40), end]
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(25)))
        row = (str(seed * 10_000 + i), rng.choice(["", 'say "so"', "\n", "plain", '"', ",,,"]), text, rng.choice(["z", "", "5 o'clock"]))
        write.writerow(row)
        rows.append(tuple(x or None for x in row))
        if rng.random() < 0.1:
            out.write(end)  # a blank line between records
    return out.getvalue(), rows


@pytest.fixture
def block(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def whole(spark, path):
    return sorted(map(tuple, spark.read.schema(SCHEMA).csv(path, header=True, multiLine=True, quote='"', escape='"').collect()), key=str)


def cut(spark, path):
    return sorted(map(tuple, records.parse_records(records.read_records(spark, path), SCHEMA).collect()), key=str)


@pytest.mark.parametrize("size", [37, 101, 1000, 4096, 1 << 20])
def test_rows_do_not_depend_on_blocks(spark, tmp_path, block, size):
    want = []
    for name, seed, end in (("a", 1, "\n"), ("b", 2, "\n"), ("c", 3, "\r\n")):
        text, rows = written(seed, size // 4 if size < 150 else 300, end)
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
        want += rows
    block(size)
    assert cut(spark, str(tmp_path)) == sorted(want, key=str)


@pytest.mark.parametrize("size", [400, 3000])
def test_rows_are_those_of_the_one_task_reader(spark, tmp_path, block, size):
    for seed in (5, 6):
        (tmp_path / f"{seed}.csv").write_text(written(seed, 150)[0])
    want = whole(spark, str(tmp_path))
    block(size)
    assert len(want) == 300 and cut(spark, str(tmp_path)) == want


def test_one_file_is_read_by_many_tasks(spark, tmp_path, block):
    path = tmp_path / "one.csv"
    text, rows = written(7, 3000)
    path.write_text(text)
    block(16384)
    assert records._lines(spark, str(path)).rdd.getNumPartitions() > 10
    assert cut(spark, str(path)) == sorted(rows, key=str)


def test_one_field_over_many_blocks(spark, tmp_path, block):
    path = tmp_path / "long.csv"
    long = "\n".join(f"line {i}, ""quoted""" for i in range(60))
    path.write_text(f'id,title,text,last\n1,a,"{long}",z\n2,b,"\n\n",y\n3,"{long}{long}",c,x')
    block(64)
    got = cut(spark, str(path))
    assert got == whole(spark, str(path)) and [len(r[2]) for r in got] == [len(long), 2, 1]


def test_odd_files(spark, tmp_path, block):
    block(16)
    for name, text in (("empty", ""), ("header", "id,title,text,last\n"), ("blank", "\n\nid,title,text,last\n\n1,a,b,c\n\n"), ("mid", 'id,title,text,last\n1,5" pipe,"a"b,c\n2,x"y"z,\'"\',"d"\n')):
        (tmp_path / name).mkdir()
        (tmp_path / name / "f.csv").write_text(text)
        assert cut(spark, str(tmp_path / name)) == whole(spark, str(tmp_path / name)), name


def test_open_fields():
    inside = records.ends_inside
    assert inside('a,"b', False) and not inside('a,"b"', False) and not inside('a,b"', False) and not inside('5" pipe,x', False)
    assert inside('b",c,"d', True) and not inside('b"",c', False) and inside('b"",c', True) and not inside('b"",c",', True)
    assert inside('"""', False) and not inside('""""', False) and inside('x;"y', False, ";") and not inside('x,"y', False, ";")


def test_typed_reader_uses_blocks(spark, tmp_path, block):
    path = tmp_path / "reviews.csv"
    body = "".join(f'{i},1,30,t{i},"line\nof {i}, ""said""",{i % 5 + 1},1,{i},D,E,F\n' for i in range(200))
    path.write_text("row,c,a,t,x,r,rec,p,d,e,f\n" + body)
    block(512)
    rows = readers.read_reviews(spark, str(path)).orderBy("row_id").collect()
    assert [r.row_id for r in rows] == list(range(200)) and rows[7].review_text == 'line\nof 7, "said"' and rows[7].rating == 3
