"""CSV with quoted line breaks read in splits, against Spark's reader of whole files."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F, types as T

from orderloom.sources import csv, records


@pytest.fixture()
def split_bytes(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}

    def set_to(n: int) -> None:
        spark.conf.set(names[0], str(n))
        spark.conf.set(names[1], "0")

    yield set_to
    for name, value in before.items():
        spark.conf.set(name, value)


def cell(dice: random.Random, breaks: float) -> str:
    kind = dice.random()
    if kind < 0.15:
        return dice.choice(("", '""', " ", "  x "))
    if kind < 0.6:
        return f"w{dice.randint(0, 99)}"
    text = "".join(dice.choice(["a", ",", '""', " ", "é", "\n" if dice.random() < breaks else "b"]) for _ in range(dice.randint(0, 30)))
    return f'"{text}"'


def write(path, dice: random.Random, n: int, breaks: float = 0.6, end: str = "\n", last: bool = True) -> None:
    lines = ["id,note,score"]
    for k in range(n):
        lines += [""] * (dice.random() < 0.03)
        lines.append(",".join((str(k), cell(dice, breaks), str(dice.randint(0, 5)) if dice.random() < 0.9 else "")))
    path.write_bytes((end.join(line.replace("\n", end) for line in lines) + end * last).encode())


def same(spark, path, **options) -> list:
    want = csv.read_csv(spark, path, multi_line=True, **options)
    got = records.read_records(spark, path, **options)
    assert got.schema == want.schema
    rows = [tuple(r) for r in got.collect()]
    assert Counter(rows) == Counter(tuple(r) for r in want.collect())
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_random_files(spark, tmp_path, split_bytes, seed):
    dice = random.Random(seed)
    for n, name in enumerate(("b.csv", "a.csv", "c.csv")):
        write(tmp_path / name, dice, 150 * n + 5, end="\r\n" if (seed, n) == (1, 1) else "\n", last=n != 2)
    split_bytes((64, 300, 2000, 1 << 20)[seed])
    same(spark, str(tmp_path))


def test_types_and_schema(spark, tmp_path, split_bytes):
    write(tmp_path / "a.csv", random.Random(9), 200)
    split_bytes(500)
    rows = same(spark, str(tmp_path), types={"score": "double"})
    assert {type(r[2]) for r in rows} == {float, type(None)}
    same(spark, str(tmp_path), infer=True)
    schema = T.StructType.fromDDL("id bigint, note string, score int")
    same(spark, str(tmp_path), schema=schema)


def test_one_large_file_is_read_by_several_tasks(spark, tmp_path, split_bytes):
    dice = random.Random(5)
    lines = ["id,note,score"]
    for k in range(75_000):
        note = "\n".join(f'"" said {dice.random()}' for _ in range(dice.randint(1, 9)))
        lines.append(f'{k},"{note}",{k % 6}')
    path = tmp_path / "big.csv"
    path.write_text("\n".join(lines) + "\n")
    assert path.stat().st_size > 10_000_000
    split_bytes(1 << 20)
    found = records.records(spark, str(path))
    assert found.select("file", "start").distinct().count() >= 10
    assert found.select(F.spark_partition_id().alias("p")).distinct().count() >= 8
    whole = csv.read_csv(spark, str(path), multi_line=True)
    got = records.read_records(spark, str(path))
    assert got.count() == whole.count() == 75_000
    assert got.exceptAll(whole).isEmpty()


def test_rows_are_in_file_order(spark, tmp_path, split_bytes):
    dice = random.Random(6)
    for name in ("a.csv", "b.csv"):
        write(tmp_path / name, dice, 300)
    split_bytes(700)
    got = records.read_records(spark, str(tmp_path), order="seq").orderBy("seq").collect()
    assert [r["id"] for r in got] == [str(k) for _ in range(2) for k in range(300)]


def test_records_longer_than_a_split(spark, tmp_path, split_bytes):
    long = "\n".join(f"line {k}" for k in range(200))
    (tmp_path / "a.csv").write_text(f'id,note\n1,"{long}"\n2,x\n3,"{long}\n"\n')
    split_bytes(100)
    assert len(same(spark, str(tmp_path))) == 3


def test_files_without_quoted_breaks_are_left_to_the_reader(spark, tmp_path, split_bytes, capsys):
    write(tmp_path / "a.csv", random.Random(7), 300, breaks=0)
    split_bytes(1000)
    assert records.records(spark, str(tmp_path)) is None
    rows = records.read_records(spark, str(tmp_path), order="seq")
    rows.explain()
    assert "FileScan csv" in capsys.readouterr().out
    assert [r["id"] for r in rows.orderBy("seq").collect()] == [str(k) for k in range(300)]
    assert rows.rdd.getNumPartitions() > 1


@pytest.mark.parametrize("text", ["id,note\n1,5\" disk\n2,x\n", 'id,note\n1,a\n2,"open\n3,c\n'])
def test_a_file_that_ends_inside_quotes_is_an_error(spark, tmp_path, text):
    (tmp_path / "a.csv").write_text(text)
    with pytest.raises(ValueError, match="ends inside quotes"):
        records.read_records(spark, str(tmp_path))


def test_quotes_inside_unquoted_cells_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,note\n1,5" disk\n2,7" disk\n3,x\n')
    with pytest.raises(Exception, match="quotes inside an unquoted cell"):
        records.read_records(spark, str(tmp_path)).collect()


def test_header_only(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,note\n")
    assert same(spark, str(tmp_path)) == []
    (tmp_path / "b.csv").write_text('id,note\n1,"a\nb"\n')
    assert same(spark, str(tmp_path)) == [("1", "a\nb")]
