"""Landing of CSV files in byte ranges: the rows of Spark's own reader, from many tasks for one file."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from textpulse import storage
from textpulse.sources import files, landing

SCHEMA = StructType([StructField(c, StringType()) for c in "abc"])


@pytest.fixture
def small_ranges(spark):
    held = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "257")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for key, value in held.items():
        spark.conf.set(key, value) if value else spark.conf.unset(key)


def rows_of(df):
    return sorted(tuple("\0" if v is None else v for v in row) for row in df.collect())


def by_reader(spark, path, header=False):
    return spark.read.options(**files.CSV_OPTIONS).csv(path, schema=SCHEMA, header=header)


def field(rng):
    kind = rng.random()
    word = "".join(rng.choice("abc xyz") for _ in range(rng.randrange(1, 12))).strip() or "w"
    if kind < 0.3:
        return word
    if kind < 0.4:
        return word + '5" wide'
    inner = "".join(rng.choice(["a", "b c", "\n", '""', ",", "\n\n", '"",""', "long " * 8]) for _ in range(rng.randrange(0, 9)))
    return f'"{inner}"' + ("tail" if kind > 0.95 else "")


@pytest.mark.parametrize("seed", range(4))
def test_equals_the_reader_on_random_files(spark, tmp_path, small_ranges, seed):
    rng = random.Random(seed)
    for n in range(3):
        text = "\n".join(",".join(field(rng) for _ in range(3)) for _ in range(120))
        (tmp_path / f"f{n}.csv").write_text(text + ("\n" if n else ""))
    read = landing.lines(spark, str(tmp_path))
    assert read.select("file", "range").distinct().count() > 20
    for header in (False, True):
        got = landing.land_csv(spark, str(tmp_path), storage.fresh_dir(spark, "landed"), SCHEMA, header)
        assert rows_of(got) == rows_of(by_reader(spark, str(tmp_path), header))


@pytest.mark.parametrize("text", ["", "\n\n", 'a,b,c', '"', 'a,"b\n\nc', '"",,\n\n"a""",b,"""c"\n', 'a,b,c\r\n"x\r\ny",d,e\r\n'])
def test_edges(spark, tmp_path, text):
    (tmp_path / "f.csv").write_bytes(text.encode())
    got = landing.records(landing.lines(spark, str(tmp_path))).orderBy("range", "place")
    want = {
        "": [], "\n\n": [], "a,b,c": ["a,b,c"], '"': ['"'], 'a,"b\n\nc': ['a,"b\n\nc'],
        '"",,\n\n"a""",b,"""c"\n': ['"",,', '"a""",b,"""c"'],
        'a,b,c\r\n"x\r\ny",d,e\r\n': ["a,b,c", '"x\r\ny",d,e'],
    }[text]
    assert [r.record for r in got.collect()] == want


def test_long_record_over_many_ranges_and_many_quotes(spark, tmp_path, small_ranges):
    long = '"' + "line of a text\n" * 400 + '""' * 30_000 + '"'
    (tmp_path / "f.csv").write_text(f"a,b,c\nx,{long},z\nd,e,f\n")
    got = landing.land_csv(spark, str(tmp_path), storage.fresh_dir(spark, "landed"), SCHEMA)
    assert rows_of(got) == rows_of(by_reader(spark, str(tmp_path))) and got.count() == 3


def test_text_is_shuffled_once_and_no_file_is_one_group(spark, tmp_path):
    (tmp_path / "f.csv").write_text("a,b,c\n")
    read = landing.lines(spark, str(tmp_path))
    known = read.select("*", F.lit(False).alias("ends_outside"), F.lit(True).alias("ends_inside"))
    plan = landing._with_state(known, "place", ["file", "range"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan


def test_only_records_of_several_lines_are_shuffled_once_read(spark, tmp_path):
    """Ranges and files are met by broadcasts of a row each, however long the texts are; no window and no sort is left."""
    (tmp_path / "f.csv").write_text('h,"i\nj",k\na,"b\nc",d\ne,f,g\n')
    plan = landing.records(landing.lines(spark, str(tmp_path)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Window" not in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("text", ["\n\nh,i,j\na,b,c\n", ' \n"h\ni",j,k\n"a\nb",c,d\n', "h,i,j\r\n\r\na,b,c\r\n", "\n", "h,i,j"])
def test_first_record_that_is_not_blank_is_the_header(spark, tmp_path, text):
    (tmp_path / "f.csv").write_bytes(text.encode())
    (tmp_path / "g.csv").write_text("h,i,j\nx,y,z\n")
    got = landing.land_csv(spark, str(tmp_path), storage.fresh_dir(spark, "landed"), SCHEMA, True)
    want = {"\n\nh": ("a", "b", "c"), ' \n"': ("a\nb", "c", "d"), "h,i,j\r": ("a", "b", "c")}
    first = [row for start, row in want.items() if text.startswith(start)]
    assert rows_of(got) == sorted([*first, ("x", "y", "z")])
