"""Quoted CSV in splits against the reader that takes a file in one task."""

import random
import re

import pytest
from pyspark.sql import functions as F

from encore.sources import quoted_csv
from encore.sources.raw import load_table, read_csv_text
from encore.schemas import RAW

NAMES = ["id", "note", "x"]


@pytest.fixture
def splits(spark):
    """Splits of some bytes, set for one test."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {name: spark.conf.get(name, None) for name in names}

    def set_to(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], str(size))
        spark.conf.set(names[2], "1000")

    yield set_to
    for name, value in before.items():
        spark.conf.set(name, value) if value else spark.conf.unset(name)


def both(spark, path):
    """The rows read in splits and read whole, both sorted, and the number of splits."""
    got = [tuple(r) for r in read_csv_text(spark, path, multi_line=True).collect()]
    want = [tuple(r) for r in read_csv_text(spark, path, multi_line=True, whole_files=True).collect()]
    return sorted(got, key=repr), sorted(want, key=repr), spark.read.text(path).rdd.getNumPartitions()


def field(chance, breaks=True):
    parts = ["a", "é", ",", '"', "\n", "\n\n", " ", "x y", "\r\n", "''", "日"] if breaks else ["b", "1", " ", "z"]
    text = "".join(chance.choices(parts, k=chance.randint(0, 6)))
    return '"' + text.replace('"', '""') + '"' if re.search('[,"\n\r]', text) or chance.random() < 0.2 else text


def made(chance, rows):
    lines = [f"{i},{field(chance)},{field(chance, False)}" for i in range(rows)]
    return "\n".join([",".join(NAMES), *lines]) + chance.choice(["", "\n"])


@pytest.mark.parametrize("size", [1 << 20, 64, 17, 5])
def test_same_rows_as_read_whole(spark, tmp_path, splits, size):
    chance = random.Random(size)
    (tmp_path / "a.csv").write_text(made(chance, 60), encoding="utf-8", newline="")
    (tmp_path / "b.csv").write_text(made(chance, 25), encoding="utf-8", newline="")
    (tmp_path / "c.csv").write_text("id,note,x\n", encoding="utf-8")
    splits(size)
    got, want, n = both(spark, str(tmp_path))
    assert got == want and len(got) == 85
    assert n > 15 or size > 100


def test_a_break_at_every_place_of_a_split(spark, tmp_path, splits):
    """The quoted break moves byte by byte over the border of a split."""
    for pad in range(0, 40, 3):
        text = f'id,note,x\n1,{"p" * pad},y\n2,"two\nlines, ""and"" a\n\nthird",z\n3,"",w\n'
        path = tmp_path / f"{pad}.csv"
        path.write_text(text, newline="")
    splits(32)
    got, want, _ = both(spark, str(tmp_path))
    assert got == want and len(got) == 14 * 3


def test_a_record_over_many_splits(spark, tmp_path, splits):
    long = "\n".join(f'line {i}, ""quoted""' for i in range(300))
    (tmp_path / "t.csv").write_text(f'id,note,x\n1,a,b\n2,"{long}",c\n3,d,e\n4,"f\ng",h\n', newline="")
    splits(100)
    got, want, n = both(spark, str(tmp_path / "t.csv"))
    assert got == want and len(got) == 4 and n > 40


@pytest.mark.parametrize(
    "body",
    [
        '1,5" pipe,a\n2,6" and 7" pipes,b\n3,"8"" pipe\nand more",c\n',
        '1,"ab"cd,a\n2,"q"" r"s,b\n3,x""y,c\n4,"k\nl",m\n',
        '1, "not quoted,a\n2,b"",c\n',
        "\n\n1,a,b\n\n\n2,c,d\n\n",
        '1,"","x"\n2,,\n3,short\n4,a,b,too long\n',
        '"1","a","b"',
        "",
    ],
)
@pytest.mark.parametrize("size", [1 << 20, 6])
def test_odd_files(spark, tmp_path, splits, body, size):
    (tmp_path / "t.csv").write_text("id,note,x\n" + body, newline="")
    splits(size)
    got, want, _ = both(spark, str(tmp_path / "t.csv"))
    assert got == want


@pytest.mark.parametrize("size", [1 << 20, 6])
def test_carriage_returns(spark, tmp_path, splits, size):
    (tmp_path / "t.csv").write_text('id,note,x\r\n1,a,b\r\n2,"c, ""q""\r\nd",e\r\n\r\n3,f,"g"\r\n4,h,i', newline="")
    splits(size)
    got, want, _ = both(spark, str(tmp_path / "t.csv"))
    assert got == want and len(got) == 4


def test_quotes_of_all_kinds(spark, tmp_path, splits):
    """Random characters, quotes that are no field's quotes included."""
    chance = random.Random(8)
    for i in range(12):
        lines = ["".join(chance.choices('",ab \n', weights=[4, 3, 3, 1, 1, 1], k=12)) for _ in range(12)]
        # what an open text at the end of a file means is left to the reader
        closed = "\n".join(lines) + '\n1,"\n",\n'
        path = tmp_path / f"{i}.csv"
        path.write_text("id,note,x\n" + closed, newline="")
        rows = [r._line for r in quoted_csv.records(spark, str(path)).collect()]
        splits(9)
        assert sorted(r._line for r in quoted_csv.records(spark, str(path)).collect()) == sorted(rows)


def test_one_file_is_read_by_many_tasks(spark, tmp_path, splits):
    path = tmp_path / "reviews.csv"
    body = "".join(f'r{i},o{i},{i % 5},"line one\nline ""two"" of {i}"\n' for i in range(4000))
    path.write_text("review_id,order_id,review_score,review_comment\n" + body, newline="")
    splits(8192)
    table = load_table(spark, str(path), RAW["reviews"], multi_line=True)
    assert table.count() == 4000
    assert table.agg(F.sum("review_score")).first()[0] == sum(i % 5 for i in range(4000))
    text = table._jdf.queryExecution().executedPlan().toString()
    # the text is shuffled by split and never gathered; the running states take one row per split
    assert "SinglePartition" not in text and "BroadcastNestedLoop" not in text and "Python" not in text
    assert spark.read.text(str(path)).rdd.getNumPartitions() > 15
    assert "review_comment" not in text and "CsvToStructs" in text.replace("from_csv", "CsvToStructs")


@pytest.mark.parametrize("lines", [1, 2, 7])
def test_chunks_of_few_lines(spark, tmp_path, splits, monkeypatch, lines):
    """Records, blank lines and headers at every place of a chunk."""
    monkeypatch.setattr(quoted_csv, "CHUNK_LINES", lines)
    chance = random.Random(lines)
    (tmp_path / "a.csv").write_text(made(chance, 60), encoding="utf-8", newline="")
    (tmp_path / "b.csv").write_text("\n" * 9 + "id,note,x\n\n\n1,a,b\n", newline="")
    splits(200)
    got, want, n = both(spark, str(tmp_path))
    assert got == want and len(got) == 61 and n > 3


def test_only_chunks_with_breaks_are_shuffled(spark, tmp_path, monkeypatch):
    """Lines that are records go on where they are read, also such with quotes."""
    monkeypatch.setattr(quoted_csv, "CHUNK_LINES", 16)
    joined, met = quoted_csv._joined, []

    def counted(lines, sep):
        met.append(lines.count())
        return joined(lines, sep)

    monkeypatch.setattr(quoted_csv, "_joined", counted)
    rows = [f'{i},"note, {i}",x' for i in range(1000)]
    (tmp_path / "t.csv").write_text("id,note,x\n" + "\n".join(rows) + "\n")
    got, want, _ = both(spark, str(tmp_path))
    assert got == want and met == [0]
    rows[500] = '500,"note\n500",x'
    (tmp_path / "t.csv").write_text("id,note,x\n" + "\n".join(rows) + "\n")
    got, want, _ = both(spark, str(tmp_path))
    assert got == want and 2 <= met[1] <= 32


def test_a_cast_meets_records_only(spark, tmp_path):
    """Neither a header nor a line of a longer text, wherever the filter is moved."""
    (tmp_path / "t.csv").write_text('id,note,x\n1,"a\nb\nc",y\n2,d,z\n')
    text = read_csv_text(spark, str(tmp_path), multi_line=True)
    numbers = text.select(F.col("id").cast("int").alias("id")).where("id IS NOT NULL")
    keys = spark.range(5).withColumnRenamed("id", "key")
    assert sorted(r.id for r in numbers.join(keys, F.col("id") == F.col("key")).collect()) == [1, 2]


def test_splits_that_move_between_scans_are_an_error(spark, tmp_path, monkeypatch):
    (tmp_path / "t.csv").write_text("id,note,x\n1,a,b\n2,c,d\n")
    chunks = quoted_csv._chunks
    monkeypatch.setattr(quoted_csv, "_chunks", lambda steps: chunks(steps).withColumn("_to", F.col("_to") - 1))
    with pytest.raises(Exception, match="cut into other splits"):
        read_csv_text(spark, str(tmp_path), multi_line=True).collect()


def test_a_line_is_parsed_once(spark, tmp_path):
    """Filters and casts of many fields read the parsed fields."""
    (tmp_path / "t.csv").write_text("id,note,x\n1,a,b\n2,c,d\n")
    text = read_csv_text(spark, str(tmp_path), multi_line=True)
    kept = text.where("id > 0 AND note <> 'c' AND x IS NOT NULL").select(F.col("id").cast("int"), "note", "x")
    assert [tuple(r) for r in kept.collect()] == [(1, "a", "b")]
    plan = kept._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("from_csv") + plan.count("csvtostructs") == 1
