"""Baskets from CSV records: quoted line breaks, splits inside records, positions as ids."""

import csv
import io
import random

import pytest

from quarry.sources.baskets import line_ends, read_baskets


def brute(text):
    rows = [frozenset(x.strip() for x in row if x.strip()) for row in csv.reader(io.StringIO(text, newline=""))]
    return [sorted(r) for r in rows if r]


def made(seed, rows=150):
    rnd = random.Random(seed)
    words = ["milk", "rye bread", 'a "big" one', "two\nlines", "x,y", "", "  tea ", "молоко", 'he said ""', "three\n\nmore\n"]
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator="\n")
    for _ in range(rows):
        if rnd.random() < 0.1:
            out.write(rnd.choice(["\n", ",,\n", 'stray 5" nail,b\n', 'a,b "c" d\n', '"",""\n']))
        else:
            writer.writerow([rnd.choice(words) for _ in range(rnd.randint(1, 6))])
    return out.getvalue()


@pytest.mark.parametrize("seed,split", [(1, 1 << 20), (2, 97), (3, 400)])
def test_records_across_splits(spark, tmp_path, seed, split):
    text = made(seed) + ('"one\nrecord ' + "\n".join(f"line {i}" for i in range(60)) + '",tail\nlast')  # a record over many splits, no line end
    (tmp_path / "b.csv").write_bytes(b"\xef\xbb\xbf" + text.encode())
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    try:
        spark.conf.set(names[0], str(split))
        spark.conf.set(names[1], "1")
        got = {r.basket_id: list(r["items"]) for r in read_baskets(spark, str(tmp_path / "b.csv")).collect()}
    finally:
        for n, v in zip(names, before):
            spark.conf.set(n, v)
    want = brute(text)
    assert got == dict(enumerate(want)) and any("\n" in x for b in want for x in b)


def test_files_in_name_order(spark, tmp_path):
    (tmp_path / "2.csv").write_text('c,"d\ne"\n')
    (tmp_path / "1.csv").write_text('a\n\n"open at the end\n')  # does not go on in the next file
    got = {r.basket_id: list(r["items"]) for r in read_baskets(spark, str(tmp_path)).collect()}
    assert got == {0: ["a"], 1: ["open at the end"], 2: ["c", "d\ne"]}


def test_line_states():
    assert line_ends("a,b") == (0, 1) and line_ends('"a') == (1, 0) and line_ends('a"b') == (0, 0)
    assert line_ends('"a""b') == (1, 0) and line_ends('x","y') == (1, 1) and line_ends("") == (0, 1)


def test_no_baskets(spark, tmp_path):
    (tmp_path / "e.csv").write_text("\n,,\n")
    with pytest.raises(ValueError):
        read_baskets(spark, str(tmp_path / "e.csv"))
    with pytest.raises(LookupError):
        read_baskets(spark, str(tmp_path / "e.csv"), encoding="no-such-encoding")
