"""Quoted CSV cut in parallel: the same rows as one task reads, wherever byte ranges end."""

import csv
import io
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reviewlens.schema import RAW_REVIEWS
from reviewlens.sources import csv_records, reviews

FIELDS = RAW_REVIEWS.fieldNames()
TEXTS = ["plain", 'with "quotes"', "two\nlines", "\n\nblank lines\n\n", "comma, and\r\nreturn", '"', '""\n""', "é ü\n漢字 \"x\"", "", None, "x" * 90, "a\n" * 40]


def made(n, seed, end="\n"):
    """CSV text as Python's own writer quotes it."""
    draw, out = random.Random(seed), io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(FIELDS)
    for i in range(n):
        writer.writerow([i, f"p{i % 3}", i % 4, 4, 1 + i % 5, 1000 * i, draw.choice(TEXTS), draw.choice(TEXTS)])
    return out.getvalue()


def in_one_task(spark, path):
    """The reader that takes a whole file in one task."""
    texts = ", ".join(f"{n} string" for n in FIELDS)
    return spark.read.options(**reviews.CSV_DIALECT).option("multiLine", True).schema(texts).csv(path)


@pytest.fixture
def ranges(spark):
    name, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda size: spark.conf.set(name, str(size))
    spark.conf.set(name, before)


def rows(df):
    return sorted((tuple(map(str, r)) for r in df.collect()))


@pytest.mark.parametrize("size,end", [(40, "\n"), (90, "\r\n"), (500, "\n"), (100_000, "\r\n")])
def test_equals_the_reader_of_one_task(spark, folder, ranges, size, end):
    with open(f"{folder}/a.csv", "w", newline="", encoding="utf-8") as file:
        file.write(made(12, size, end))
    expected = rows(in_one_task(spark, folder).select(*[F.col(f.name).cast(f.dataType) for f in RAW_REVIEWS.fields]))
    ranges(size)
    found = reviews.read_reviews(spark, folder)
    assert rows(found) == expected and len(expected) == 12
    if size < 100:
        assert csv_records._lines(spark, folder).select("start").distinct().count() > 5


def cut(body, size, chunk):
    """The records of a text in ranges of ``size``, its lines fed ``chunk`` at a time."""
    starts = [0] + [i + 1 for i, c in enumerate(body) if c == "\n"]
    lines = body.split("\n")
    if not lines[-1]:
        starts, lines = starts[:-1], lines[:-1]
    ranges = {}
    for at, line in zip(starts, lines):
        ranges.setdefault(at // size * size, []).append(line)
    out, pieces, quotes = [], [], 0
    for start, own in ranges.items():
        cutter = csv_records.RangeCutter("f", start, quotes % 2 == 1)
        quotes += "".join(own).count('"')
        for k in range(0, len(own), chunk):
            out += cutter.feed(pa.array(own[k : k + chunk]))
        out += cutter.finish()
    joined = []
    for text, kind, header, _, start in out:
        if kind == csv_records.BEGINNING:
            pieces.append(([text], header))
        elif kind != csv_records.RECORD:
            pieces[-1][0].append(text)
        else:
            joined.append((text, header))
    return sorted(joined + [("\n".join(p), header) for p, header in pieces])


@pytest.mark.parametrize("text", ['a,"b\n"', 'a,b""', '"a\n","b""\n"\n1', 'a,""""\nx', '"",""\n""', 'a,"\n\n\n"\n2', '"\n"\n"\n"\n"\n"', 'ü"\né"', '"open\nto the end'])
def test_quotes_at_every_range_end(text):
    """Every cut of a short file in ranges, also where a quote is first or last in its range."""
    body = f"x,y\n{text}"
    records, held = [], []
    for line in body.split("\n"):
        held.append(line)
        if "\n".join(held).count('"') % 2 == 0:
            records.append("\n".join(held))
            held = []
    records += ["\n".join(held)] * bool(held)
    expected = sorted((r, k == 0) for k, r in enumerate(records))
    for size in range(1, len(body) + 2):
        for chunk in (1, 2, 100):
            assert cut(body, size, chunk) == expected, (size, chunk)


def test_many_files_in_many_ranges(spark, folder, ranges):
    for i in range(5):
        with open(f"{folder}/{i}.csv", "w", newline="", encoding="utf-8") as file:
            file.write(made(3 * i, i))
    expected = rows(in_one_task(spark, folder).select(*[F.col(f.name).cast(f.dataType) for f in RAW_REVIEWS.fields]))
    ranges(200)
    assert rows(reviews.read_reviews(spark, folder)) == expected and len(expected) == 30


def test_ranges_that_changed_are_an_error(spark, folder, ranges):
    with open(f"{folder}/a.csv", "w", newline="", encoding="utf-8") as file:
        file.write(made(25, 1))
    ranges(100)
    _, found = csv_records.records(spark, folder)
    ranges(64)
    with pytest.raises(Exception, match="byte ranges"):
        found.collect()


def test_a_record_of_many_ranges(spark, folder, ranges):
    text = "line\n" * 300
    with open(f"{folder}/a.csv", "w", newline="") as file:
        file.write(f'h\n"{text}"\nlast')
    ranges(50)
    headers, got = csv_records.records(spark, folder)
    assert sorted(r.record for r in got.collect()) == sorted([f'"{text}"', "last"])
    assert [r.record for r in headers.collect()] == ["h"]


def test_a_header_of_many_ranges(spark, folder, ranges):
    name = "a \"name\"\nof lines" * 9
    with open(f"{folder}/a.csv", "w", newline="") as file:
        csv.writer(file).writerows([[name, "b"], ["1", "2\n"], ["3", ""]])
    ranges(40)
    assert sorted(map(tuple, reviews._csv_table(spark, folder).select(f"`{name}`", "b").collect()), key=repr) == [("1", "2\n"), ("3", None)]
