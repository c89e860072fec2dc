"""Native text expressions against plain Python."""

import random
import re
import unicodedata

import pytest
from pyspark.ml.feature import RegexTokenizer
from pyspark.sql import functions as F

from tramline import fixed_values as fv
from tramline.functions import causes, text

PIECES = [
    "bus", "BUS", "Métro", "métro", "ligne", "tram", "tramway", "rer", "RER", "train", "ébus", "bus_",
    "12", "٣٤", "7a", "A", "b", "é", "gare de ", "Gare de ", "lyon", "Saint-Lazare", ",", ".", ":", ";",
    "<", ">", "<b>", "</p>", "<br/>", "&nbsp;", "&nb<i>sp;", " ", "  ", "\t", "\n", "\x0b", "\r\n",
    " ", " ", "\x1c", "fermé", "FERMÉE", "soirée", "jusqu'au", "retard", "week-end", "|", "œ", "ß",
]


def random_texts(n=600, seed=7):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25))) for _ in range(n)] + [None, ""]


def evaluate(spark, texts, **columns):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4)
    rows = df.select("i", *[c(F.col("t")).alias(n) for n, c in columns.items()]).collect()
    return [r for r in sorted(rows, key=lambda r: r["i"])]


def py_clean(t):
    t = re.sub(r"<[^>]+>", " ", t)
    t = t.replace("&nbsp;", " ")
    return re.sub("[ \t\n\x0b\f\r]+", " ", t)


def is_word(c):
    return c == "_" or c.isalnum() or unicodedata.category(c) in ("Mn", "Mc", "Me")


def scan_lines(t):
    """Walks a text: a whole-word mode, any blanks, then digits."""
    t, at, out = t.lower(), 0, []
    while at < len(t):
        modes = [m for m in fv.TRANSPORT_MODES if t.startswith(m, at) and not (at and is_word(t[at - 1]))]
        for mode in modes:
            end = at + len(mode)
            if end < len(t) and is_word(t[end]):
                continue
            start = end
            while start < len(t) and t[start].isspace():
                start += 1
            stop = start
            while stop < len(t) and t[stop].isdecimal():
                stop += 1
            if stop > start:
                out.append(f"{mode} {t[start:stop]}")
                at = stop - 1
                break
        at += 1
    return out


def scan_stations(t):
    """Cuts a text at each prefix and each name at the first stopper."""
    t, out = t.lower(), []
    while fv.STATION_PREFIX in t:
        t = t[t.index(fv.STATION_PREFIX) + len(fv.STATION_PREFIX) :]
        ends = [t.index(c) for c in fv.STATION_STOPPERS if c in t]
        end = min(ends, default=len(t))
        if end:
            out.append(t[:end].strip())
            t = t[end:]
    return out


def test_strip_html(spark):
    texts = random_texts()
    rows = evaluate(spark, texts, clean=text.strip_html)
    assert [r["clean"] for r in rows] == [None if t is None else py_clean(t) for t in texts]


def test_strip_html_keeps_edges(spark):
    rows = evaluate(spark, ["<p>a</p>", "a <b>b</b>\n\nc", "x < y"], clean=text.strip_html)
    assert [r["clean"] for r in rows] == [" a ", "a b c", "x < y"]


def test_tokens_equal_spark_tokenizer(spark):
    texts = [t for t in random_texts() if t is not None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("c", text.strip_html(F.col("t")))
    both = RegexTokenizer(inputCol="c", outputCol="theirs", pattern="\\s+").transform(df)
    ours = both.withColumn("ours", text.tokens(F.col("c"))).withColumn("fast", text.clean_tokens(F.col("c")))
    assert ours.filter("ours <> theirs OR fast <> theirs").count() == 0


def test_transport_lines(spark):
    texts = random_texts()
    rows = evaluate(spark, texts, lines=text.transport_lines)
    assert [r["lines"] for r in rows] == [[] if t is None else scan_lines(t) for t in texts]
    assert any(r["lines"] for r in rows)


@pytest.mark.parametrize(
    "message,found",
    [
        ("Le bus 12 et le bus  7a", ["bus 12", "bus 7"]),
        ("Tramway 3 / Métro\t4", ["tramway 3", "métro 4"]),
        ("autobus 5, busx 6, bus six, ligne13", []),
        ("RER 1 RER A train", ["rer 1"]),
        ("", []),
    ],
)
def test_transport_line_cases(spark, message, found):
    assert evaluate(spark, [message], lines=text.transport_lines)[0]["lines"] == found


def test_letter_lines_are_off_by_default(spark):
    rows = evaluate(
        spark,
        ["RER B et bus 12", "ligne accès"],
        default=text.transport_lines,
        letters=lambda t: text.transport_lines(t, letter_lines=True),
    )
    assert rows[0]["default"] == ["bus 12"]
    assert rows[0]["letters"] == ["rer b", "bus 12"]
    assert rows[1]["letters"] == []


def test_stations(spark):
    texts = random_texts()
    rows = evaluate(spark, texts, names=text.stations)
    assert [r["names"] for r in rows] == [[] if t is None else scan_stations(t) for t in texts]
    assert any(r["names"] for r in rows)


def test_station_edges(spark):
    texts = ["gare de  , gare de  lyon ,", "gare de lyon sera fermée", "gare de |a|b."]
    rows = evaluate(spark, texts, names=text.stations)
    assert [r["names"] for r in rows] == [["", "lyon"], ["lyon sera fermée"], ["|a|b"]]


@pytest.mark.parametrize("name", fv.FLAG_PATTERNS)
def test_flags(spark, name):
    pattern = fv.FLAG_PATTERNS[name]
    hits = [f"avant {w.upper()} après" for w in pattern.split("|")]
    texts = random_texts(200) + hits
    rows = evaluate(spark, texts, flag=lambda t: text.flag(t, pattern))
    expected = [int(t is not None and bool(re.search(pattern, t.lower()))) for t in texts]
    assert [r["flag"] for r in rows] == expected
    assert sum(expected) >= len(hits)


def test_flag_with_a_real_regex(spark):
    rows = evaluate(spark, ["Bus 12", "bus", None], flag=lambda t: text.flag(t, r"bus\s\d+"))
    assert [r["flag"] for r in rows] == [1, 0, 0]


def test_length_bands(spark):
    df = spark.createDataFrame([(0,), (29,), (30,), (99,), (100,), (None,)], "n int")
    bands = [r[0] for r in df.select(text.length_band(F.col("n"))).collect()]
    assert bands == ["short", "short", "medium", "medium", "long", "short"]


def test_null_text_is_no_text(spark):
    (row,) = evaluate(
        spark, [None], words=text.tokens, n=text.word_count, lines=text.transport_lines, names=text.stations
    )
    assert (row["words"], row["n"], row["lines"], row["names"]) == ([], 0, [], [])


def test_severity_and_urgency(spark):
    values = [("INFORMATION", 1.0), ("PERTURBATION", 1.0), ("TRAVAUX", 24.0), ("TRAVAUX", 24.1),
              ("ACCIDENT", None), ("travaux", 1.0), (None, 1.0)]
    df = spark.createDataFrame(values, "cause string, h double").coalesce(1)
    level = causes.severity(F.col("cause"))
    rows = df.select(level.alias("s"), causes.is_urgent(level, F.col("h")).alias("u")).collect()
    assert [r["s"] for r in rows] == [1, 2, 3, 3, 4, 2, 2]
    assert [r["u"] for r in rows] == [0, 0, 1, 0, 0, 0, 0]
