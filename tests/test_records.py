"""Multi-line CSV in splits, against Spark's own reader and a plain scan."""

import csv
import io
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tramline import sources
from tramline.sources import records


def plain_pieces(text, inside):
    """Records of a text, character by character."""
    out, held, state = [], "", "quoted" if inside else "start"
    for c in text + "\n":
        if c == "\n" and state != "quoted":
            out.append(held)
            held, state = "", "start"
            continue
        held += c
        if state == "start":
            state = "quoted" if c == '"' else "start" if c == "," else "plain"
        elif state == "quoted":
            state = "closing" if c == '"' else "quoted"
        elif state == "closing":
            state = "quoted" if c == '"' else "start" if c == "," else "plain"
        elif c == ",":
            state = "start"
    return out, held.removesuffix("\n")


@given(st.text('",\na', max_size=30), st.booleans())
def test_pieces(text, inside):
    whole, rest = plain_pieces(text, inside)
    found = list(records.pieces(text, inside, ","))
    open_end = text.count("\n") + 1 > sum(v.count("\n") + 1 for v in whole)
    assert [v for _, v in found] == whole + [rest] * open_end
    kinds = [k for k, _ in found]
    assert kinds == (["end"] if inside else []) + ["whole"] * (len(found) - inside - (open_end and not (inside and not whole))) + (
        ["start"] if open_end and not (inside and not whole) else []
    )


@given(st.lists(st.text('",a', max_size=6), max_size=12), st.integers(1, 20))
def test_chunk_functions(lines, size):
    made = list(records.chunks([("f", 0, line) for line in lines], ",", size))
    assert "\n".join(c[3] for c in made) == "\n".join(lines)
    for start in (False, True):
        state, seen = start, 0
        for _, _, number, text, out_before, in_before, out_after, in_after, leaves in made:
            assert (in_before if start else out_before) == state and number == seen
            ends, now = [], True
            for line in text.split("\n"):
                state = records.ends_inside(line, state, ",")
                now = records.ends_inside(line, now, ",")
                ends.append(now)
            assert (in_after if start else out_after) == state and leaves == (not all(ends))
            seen += 1


@pytest.mark.parametrize("seed", range(3))
def test_scan(spark, seed):
    pick = random.Random(seed)
    functions = [(False, True)] * 3 + [(True, False), (False, False), (True, True)]
    rows = [(f, i, *pick.choice(functions)) for f in "xyz" for i in range(40)]
    frame = spark.createDataFrame(rows, "file string, block long, out_after boolean, in_after boolean")
    state = {}
    for f, i, out, inn in rows:
        before = state.get(f, (False, False))[0] if i else False
        state[f] = (inn if before else out, before)
        state[f, i] = before
    found = {(r.file, r.block): r.inside for r in records.scanned(frame, "file", "block").collect()}
    assert found == {k: v for k, v in state.items() if isinstance(k, tuple)}


def text_of(pick):
    return "".join(pick.choice(['"', ",", "\n", "a", "é", " ", "\n\n", '""']) for _ in range(pick.randint(0, 30)))


@pytest.fixture
def files(folder):
    """Files with texts full of quotes and breaks; one record is longer than several splits."""
    import pathlib

    pick, wanted = random.Random(7), []
    for name, rows in (("a", 300), ("b", 40), ("c", 0)):
        out = io.StringIO()
        writer = csv.writer(out, lineterminator="\n")
        writer.writerow(["id", "text", "n"])
        for i in range(rows):
            row = (f"{name}{i}", "x\n" * 9000 if i == 20 else "t" + text_of(pick), str(i))
            writer.writerow(row)
            wanted.append((row[0], row[1], i))
        pathlib.Path(folder, f"{name}.csv").write_text(out.getvalue(), encoding="utf-8")
    return folder, wanted


def test_splits(spark, files):
    path, wanted = files
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        found = records.read_multiline_csv(spark, path, chunk_chars=700)
        assert found.dtypes == [("id", "string"), ("text", "string"), ("n", "int")]
        assert sorted(map(tuple, found.collect())) == sorted(wanted)
        blocks = records._chunked(spark, path, ",", 700).groupBy("file", "block").count().collect()
        assert len(blocks) > 10  # no task has a whole file
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    typed = sources.read_csv(spark, path, spark.createDataFrame([], "id string, text string, n long").schema, multiline=True)
    assert sorted(map(tuple, typed.collect())) == sorted(wanted)


def test_like_sparks_reader(spark, folder):
    import pathlib

    text = '﻿id,text\r\n1,"a\r\nb"\r\n\r\n2,plain "quoted" text\r\n3,"closed" rest\r\n4,\r\n5,"last ""one"""'
    pathlib.Path(folder, "a.csv").write_bytes(text.encode())
    options = {"header": True, "multiLine": True, "escape": '"', "inferSchema": True}
    theirs = spark.read.options(**options).csv(folder)
    ours = sources.read_csv(spark, folder, multiline=True)
    assert ours.schema == theirs.schema
    assert sorted(map(str, ours.collect())) == sorted(map(str, theirs.collect()))
