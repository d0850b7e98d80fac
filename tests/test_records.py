from __future__ import annotations

import random
import re

import pytest
from conftest import plan_of
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyhouse.sources import records
from tallyhouse.sources.files import read_utf16_csv
from tallyhouse.sources.records import read_split_csv

SCHEMA = StructType().add("id", "integer").add("name", "string").add("note", "string").add("price", "double")


def file_of(rows, end):
    """CSV text with quoted fields that hold line ends, quotes, commas and non-ASCII text."""
    lines = ["id,name,note,price"]
    for row in rows:
        cells = ['"' + str(x).replace('"', '""') + '"' if isinstance(x, str) else "" if x is None else str(x) for x in row]
        lines.append(",".join(cells))
    return end.join(lines) + end


def invented(n, end, quotes):
    rng = random.Random(n)
    parts = ["plain", f"two{end}lines", f"{end}", f"a,b{end}{end}c", "улица ё", "😀", f"x{end}1,2,3"]
    if quotes:
        parts += ['say "hi"', f'"{end}"', '""']
    return [
        (i, "".join(rng.choices(parts, k=rng.randint(1, 4))), rng.choice([None, "n", *parts]), rng.choice([None, i / 4]))
        for i in range(n)
    ]


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("encoding,mark", [("UTF-16LE", b"\xff\xfe"), ("UTF-16BE", b"\xfe\xff")])
def test_many_splits_equal_the_whole_file_mode(spark, settings, tmp_path, encoding, mark, end):
    path = str(tmp_path / "f.csv")
    text = file_of(invented(400, end, quotes=False), end)
    (tmp_path / "f.csv").write_bytes(mark + text.encode(encoding))
    whole = sorted_rows(read_utf16_csv(spark, path, SCHEMA))
    assert len(whole) == 400
    for size in ("701", "4096", "1g"):
        settings(spark__sql__files__maxPartitionBytes=size, spark__sql__files__openCostInBytes="1")
        assert sorted_rows(read_split_csv(spark, path, SCHEMA, encoding=encoding)) == whole


def test_doubled_quotes_and_several_files(spark, settings, tmp_path):
    rows = {}
    (tmp_path / "in").mkdir()
    for name, n in (("a", 150), ("b", 1), ("c", 60)):
        rows[name] = [(i + 1000 * n, *row[1:]) for i, row in enumerate(invented(n, "\n", quotes=True))]
        (tmp_path / "in" / f"{name}.csv").write_bytes(file_of(rows[name], "\n").encode())
    (tmp_path / "in" / "d.csv").write_bytes(b"id,name,note,price\n")
    path = str(tmp_path / "in")
    options = {"header": True, "multiLine": True, "escape": '"'}
    whole = sorted_rows(spark.read.schema(SCHEMA).options(**options).csv(path))
    settings(spark__sql__files__maxPartitionBytes="300", spark__sql__files__openCostInBytes="1")
    found = read_split_csv(spark, path, SCHEMA, encoding="UTF-8", escape='"')
    assert sorted_rows(found) == whole and len(whole) == 211
    assert "Python" not in plan_of(found)


def test_a_record_over_many_splits_and_bad_numbers(spark, settings, tmp_path):
    long = "\n".join(f"line {i}" for i in range(2000))
    text = f'id,name,note,price\n1,"{long}",x,2.5\n\nno number,"b","c",?\n3,short\n'
    (tmp_path / "f.csv").write_bytes(b"\xff\xfe" + text.encode("utf-16-le"))
    settings(spark__sql__files__maxPartitionBytes="1000", spark__sql__files__openCostInBytes="1")
    found = sorted_rows(read_split_csv(spark, str(tmp_path / "f.csv"), SCHEMA))
    assert found == sorted_rows(read_utf16_csv(spark, str(tmp_path / "f.csv"), SCHEMA))
    assert (1, long, "x", 2.5) in found and len(found) == 3


def test_a_line_cut_inside_a_character_is_an_error(spark, tmp_path):
    text = "id,name,note,price\n1,੡Ā\u000ax,b,1\n2,Ċ਀,c,2\n"
    (tmp_path / "f.csv").write_bytes(b"\xff\xfe" + text.encode("utf-16-le"))
    with pytest.raises(Exception, match="inside a character"):
        read_split_csv(spark, str(tmp_path / "f.csv"), SCHEMA).collect()


def test_a_task_gets_no_more_lines_as_the_file_grows(spark, settings, tmp_path):
    """Split of 16 KB; the session's own 4 shuffle partitions would each get four times the lines."""
    settings(spark__sql__files__maxPartitionBytes="16KB", spark__sql__files__openCostInBytes="1")
    most, plans = [], []
    for n in (2000, 8000):
        path = tmp_path / f"{n}.csv"
        path.write_bytes(b"\xff\xfe" + file_of([(i, f"two\nlines {i}", "n", 1.5) for i in range(n)], "\n").encode("utf-16-le"))
        found = read_split_csv(spark, str(path), SCHEMA)
        counts = found.groupBy(F.spark_partition_id().alias("task")).count()
        assert counts.agg(F.sum("count")).head()[0] == n
        most.append(counts.agg(F.max("count")).head()[0])
        plans.append(plan_of(found))
    assert most[1] < 1.5 * most[0]
    by_chunk = r"hashpartitioning\(file#\w+, block#\w+, chunk#\w+, (\d+)\), REPARTITION_BY_NUM"
    few, many = (int(re.search(by_chunk, plan)[1]) for plan in plans)
    assert many >= 3 * few


@pytest.mark.parametrize("size", ["2000", "1g"])
def test_chunks_of_few_lines_and_of_several_files(spark, settings, tmp_path, monkeypatch, size):
    """Chunks inside a split, records over many chunks, and files that share a task and its line numbers."""
    monkeypatch.setattr(records, "CHUNK_BITS", 3)
    (tmp_path / "in").mkdir()
    for name, n in (("a", 300), ("b", 2), ("c", 90), ("d", 0)):
        rows = [(i + 1000 * n, *row[1:]) for i, row in enumerate(invented(n, "\n", quotes=True))]
        rows += [(-n, "\n".join(map(str, range(100))), "long", None)]
        (tmp_path / "in" / f"{name}.csv").write_bytes(file_of(rows, "\n").encode())
    # An open quote takes the rest of its own file only.
    (tmp_path / "in" / "e.csv").write_bytes(b'id,name,note,price\n5,"open\nrest,of\nthe file\n')
    path = str(tmp_path / "in")
    options = {"header": True, "multiLine": True, "escape": '"'}
    whole = sorted_rows(spark.read.schema(SCHEMA).options(**options).csv(path).filter("id <> 5"))
    settings(spark__sql__files__maxPartitionBytes=size, spark__sql__files__openCostInBytes="1")
    found = read_split_csv(spark, path, SCHEMA, encoding="UTF-8", escape='"')
    files = records.lines_of(spark, path, "UTF-8", '"').groupBy("chunk").agg(F.count_distinct("file").alias("n"))
    assert files.filter("n > 1").count() > 0
    assert sorted_rows(found.filter("id <> 5")) == whole and len(whole) == 396
    assert found.filter("id = 5").count() == 1
