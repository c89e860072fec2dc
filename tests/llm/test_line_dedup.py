"""Line dedup and union-find against brute force."""

import random
import time

import pyarrow.compute  # noqa: F401
import pytest
from brute import parts_of

from tramline import session
from tramline.llm import common, graph, line_dedup


def grams(line):
    n = line_dedup.EXACT
    return {line} if len(line) < n else {line[i : i + n] for i in range(len(line) - n + 1)}


def near(x, y):
    a, b = grams(x), grams(y)
    return len(a & b) >= line_dedup.SIMILARITY * len(a | b)


def brute(rows):
    """(id, place) of removed lines."""
    where = {}
    for i, text in rows:
        for place, raw in enumerate((text or "").split("\n")):
            if line := raw.strip(" \t\r\f"):
                where.setdefault(line, set()).add((i, place))
    first = {line: min(places) for line, places in where.items()}
    lines = sorted(where)
    links = [(first[x], first[y]) for k, x in enumerate(lines) for y in lines[k + 1 :] if near(x, y)]
    part = parts_of(set(first.values()), links)
    return {p for line, places in where.items() for p in places if p != part[first[line]]}


@pytest.fixture(scope="module")
def corpus():
    pick = random.Random(5)
    words = ["".join(pick.choice("abcdefgh") for _ in range(pick.randint(2, 9))) for _ in range(400)]

    def line(n):
        return " ".join(pick.choice(words) for _ in range(n))

    def edited(text):
        at = pick.randrange(len(text))
        return text[:at] + "Q" + text[at + 1 :]

    base = [line(pick.randint(8, 40)) for _ in range(60)]
    rows = []
    for i in range(60):
        picked = [pick.choice(base) for _ in range(3)]
        own = [line(12), edited(picked[0]), picked[1], edited(edited(picked[2])), "", " " + picked[0] + "\t"]
        rows.append((i, "\n".join(own)))
    rows += [(200, None), (201, ""), (202, "\n\n"), (203, "short"), (204, "short"), (204, "short"), (205, "a b c")]
    return rows + [(206, line(3_000) + "\n" + line(5))]


def places(df):
    return {(r.id, p) for r in df.collect() for p in r.places}


def test_recall_and_precision(spark, corpus):
    docs = spark.createDataFrame(corpus, "doc_id long, text string").repartition(5)
    found, wanted = places(line_dedup.removed_places(docs)), brute(corpus)
    assert found <= wanted
    assert len(found) >= 0.97 * len(wanted)


def missed_share(spark, lines):
    """Of the pairs of lines that are similar, the share that has no band in common."""
    rows = spark.createDataFrame(list(enumerate(sorted(set(lines)))), "doc_id long, text string")
    hashed = line_dedup.lines_of(rows, "doc_id", "text").select("a", "line")
    text = {r.a: r.line for r in hashed.collect()}
    held = {}
    for r in line_dedup._buckets(line_dedup.lines_of(rows, "doc_id", "text")).collect():
        held.setdefault(text[r.a], set()).add(r.band)
    known = sorted(text.values())
    pairs = [(x, y) for k, x in enumerate(known) for y in known[k + 1 :] if near(x, y)]
    assert len(pairs) > 20
    return sum(not held.get(x, set()) & held.get(y, set()) for x, y in pairs) / len(pairs)


def variants(pick, line, alphabet, edits=1):
    """The line with a character put in, changed or lost at each end and inside."""
    out = [line]
    for at in (0, len(line), pick.randrange(len(line)), pick.randrange(len(line))):
        for drop, put in ((0, 1), (1, 1), (1, 0)):
            now = line[:at] + pick.choice(alphabet) * put + line[at + drop :]
            for _ in range(edits - 1):
                at = pick.randrange(len(now))
                now = now[:at] + pick.choice(alphabet) + now[at + 1 :]
            out.append(now)
    return [x for x in out if x == x.strip()]


@pytest.mark.parametrize("words", [1, 2, 3, 4, 5])
def test_short_lines(spark, words):
    pick = random.Random(words)
    lines = ["Read more", "Read more.", "Subscribe now", "Subscribe now!", "Advertisement below", "Advertisement below:"]
    for _ in range(40):
        line = " ".join("".join(pick.choice("abcdefgh") for _ in range(pick.randint(3, 14))) for _ in range(words))
        lines += variants(pick, line[:36].strip(), "xyz.:!")
    assert missed_share(spark, lines) == 0


def long_words(pick):
    return "".join(pick.choice("abcdefghij0123456789") for _ in range(pick.randint(40, 60)))


def unspaced(pick):
    return "".join(chr(pick.randrange(0x4E00, 0x5800)) for _ in range(pick.choice((50, 100))))


@pytest.mark.parametrize("make", [long_words, lambda pick: "See https://" + long_words(pick), unspaced])
def test_lines_of_few_words(spark, make):
    pick = random.Random(2)
    lines = [x for _ in range(25) for x in variants(pick, make(pick), "XYZ ")]
    assert missed_share(spark, lines) < 0.01


def test_rulers(spark):
    lines = [c * n for c in ("-", "=-", "ab ") for n in (20, 30, 31, 32, 39, 40, 41, 70, 200)]
    assert missed_share(spark, [x.strip() for x in lines]) == 0


def test_texts(spark):
    long = "some words that make a line long enough to be compared with others here"
    rows = [(1, f"{long}\nfirst", "x"), (2, f"{long[:-1]}\n\n second \n{long}", "y"), (3, None, "z"), (4, "third\n", None), (None, "third", "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, places string")
    found = {r.doc_id: (r.text, r.places, r.n_lines, r.n_removed) for r in line_dedup.deduplicate(docs).collect()}
    assert found == {
        1: (f"{long}\nfirst", "x", 2, 0),
        2: ("\n second ", "y", 4, 2),
        3: (None, "z", 0, 0),
        4: ("", None, 2, 1),
        None: ("third", "n", 1, 0),
    }
    empty = spark.createDataFrame([], docs.schema)
    assert line_dedup.deduplicate(empty).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    pick = random.Random(seed)
    links = [(pick.randrange(300), pick.randrange(300)) for _ in range(180)]
    links += [(k, k + 1) for k in range(1000, 1060)] + [(5000, k) for k in range(4000, 4050)] + [(7, 7)]
    nodes = {n for a, b in links if a != b for n in (a, b)}
    found = graph.components(spark.createDataFrame(links, "x long, y long"))
    assert {r.node: r.component for r in found.collect()} == parts_of(nodes, [x for x in links if x[0] != x[1]])
    assert found.count() == len(nodes)


def test_no_links(spark):
    assert graph.components(spark.createDataFrame([], "x long, y long")).count() == 0


def test_rulers_of_any_length_are_one_line(spark):
    lines = ["-" * n for n in (10, 70, 200, 900)] + ["ab " * 30 + "ab", "ab " * 200 + "ab"]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    assert places(line_dedup.removed_places(docs)) == brute(list(enumerate(lines))) == {(1, 0), (2, 0), (3, 0), (5, 0)}


def test_column_names(spark):
    rows = [(1, "a line of text\nb", "x", 1), (2, "a line of text", "y", 2)]
    docs = spark.createDataFrame(rows, "`doc.id` long, text string, _places string, _id int")
    found = line_dedup.deduplicate(docs, "doc.id")
    assert found.columns == [*docs.columns, "n_lines", "n_removed"]
    assert sorted(map(tuple, found.collect())) == [(1, "a line of text\nb", "x", 1, 2, 0), (2, "", "y", 2, 1, 1)]


def test_crowded_buckets(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "CROWD", 4)
    pick = random.Random(9)

    def name():
        return "".join(pick.choice("abcdefghij") for _ in range(8))

    posts = [f"This article was posted by {name()} on the {name()} day of the month" for _ in range(80)]
    rows = list(enumerate(posts + [x.replace("article", "Article") for x in posts[::3]] + [x + "!" for x in posts[::5]]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert places(line_dedup.removed_places(docs)) == brute(rows)


def test_bands_travel_as_bytes(spark):
    # 18 pairs of band and line took a row each: a shuffle of one and a half times the texts.
    lines = [f"line {k} of some text that has its own words {k * k}" for k in range(2_000)]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").coalesce(1)
    hashed = line_dedup.lines_of(docs, "doc_id", "text").select("a", "line").toArrow()
    dealt = list(line_dedup._banded(iter(hashed.to_batches())))
    assert sum(b.num_rows for b in dealt) == line_dedup.PARTS
    held = sum(len(x) for b in dealt for c in (1, 2, 3) for x in b.column(c).to_pylist())
    assert held == len(lines) * (12 * line_dedup.BANDS + 24)


@pytest.mark.parametrize("held", [1, 7])
def test_any_number_of_lines_at_a_time(spark, corpus, monkeypatch, held):
    docs = spark.createDataFrame(corpus, "doc_id long, text string").coalesce(1)
    batches = line_dedup.lines_of(docs, "doc_id", "text").filter("length(line) >= 5").select("a", "line").toArrow().to_batches(100)

    def found():
        rows = line_dedup.pa.Table.from_batches(line_dedup._banded(iter(batches)))
        out = set()
        for part in range(line_dedup.PARTS):
            some = line_dedup._bucketed(rows.filter(line_dedup.pa.compute.equal(rows["part"], part)))
            out |= set(zip(*some.to_pydict().values(), strict=True))
        return out

    whole = found()
    assert len(whole) > 100
    monkeypatch.setattr(line_dedup, "HELD_LINES", held)
    assert found() == whole


@pytest.mark.parametrize("bits", [1 << 10, 1 << 15, 1 << 27])
def test_lines_by_bitmaps(spark, monkeypatch, bits):
    monkeypatch.setattr(line_dedup, "SENT_IDS", 5)
    monkeypatch.setattr(line_dedup, "MAP_BITS", bits)
    lines = spark.range(3_000).selectExpr("xxhash64(id) AS a", "id AS line")
    ids = lines.filter("line % 7 = 3").select("a")
    assert {r.line for r in line_dedup._held(lines, ids).collect()} == set(range(3, 3_000, 7))
    few = ids.limit(3)
    assert {r.a for r in line_dedup._held(lines, few).collect()} == {r.a for r in few.collect()}


def test_workers_let_go_of_earlier_stages():
    common.held("an earlier stage", 1, lambda: "its store")
    assert list(line_dedup._banded(iter([]))) == [] and not common._held


def test_buckets_of_unlike_lines_end_in_their_task(spark):
    # Every member met its bucket's first in a join, which grew with the square of the buckets.
    pick = random.Random(3)

    def word():
        return pick.getrandbits(64) - (1 << 63)

    same = (word(), word())
    sketches = [(a, *(same if a in (40, 41) else (word(), word()))) for a in range(60)]
    members = [(band, a) for band in (5, 7, 1 << 33) for a in range(60)] + [(9, 3), (9, 40), (9, 41)]
    frames = spark.createDataFrame(members, "band long, a long"), spark.createDataFrame(sketches, "a long, s long, t long")
    rows = [tuple(r)[:4] for r in line_dedup._near_rows(*frames).collect()]
    assert sorted(rows) == sorted((band, a, 3 if band == 9 else 0, 3 if band == 9 else 60) for band in (5, 7, 9, 1 << 33) for a in (40, 41))


@pytest.mark.parametrize("most", [1, 1 << 18])
def test_pairs_of_buckets(monkeypatch, most):
    monkeypatch.setattr(line_dedup, "PAIR_ROWS", most)
    pick = random.Random(4)
    bases = [pick.getrandbits(128) for _ in range(3)]
    rows = {}
    for _ in range(120):
        sketch = pick.choice(bases)
        for _ in range(pick.randrange(25)):
            sketch ^= 1 << pick.randrange(128)
        s, t = ((sketch >> k & (1 << 64) - 1) - (1 << 63) for k in (0, 64))
        rows[pick.randrange(8), pick.randrange(-50, 50)] = (pick.randrange(4), s, t)
    columns = zip(*((band, a, *x) for (band, a), x in rows.items()), strict=True)
    table = line_dedup.pa.table(dict(zip(("band", "a", "root", "s", "t"), map(list, columns), strict=True)))
    found = {tuple(sorted(x.values())) for b in line_dedup._paired(iter(table.to_batches(30))) for x in b.to_pylist()}

    def differ(x, y):
        return sum(((p ^ q) & (1 << 64) - 1).bit_count() for p, q in zip(x[1:], y[1:], strict=True))

    wanted = {
        (a, o)
        for (band, a), x in rows.items()
        for (band_o, o), y in rows.items()
        if band == band_o and a < o and x[0] != y[0] and differ(x, y) <= line_dedup.SKETCH_DIFFER
    }
    assert found == wanted and len(wanted) > 20


def test_verdicts_by_hashes(corpus):
    pick = random.Random(8)
    lines = [x.strip() for _, text in corpus[:60] for x in text.split("\n") if x.strip()] + ["-" * 40, "-" * 70, "日本" * 9]
    pairs = [(x, y) for x in lines[:80] for y in pick.sample(lines, 40)]
    for x in lines[:150]:
        y = x
        for _ in range(pick.randrange(12)):
            at = pick.randrange(len(y))
            y = y[:at] + "Z" + y[at + 1 :]
            pairs.append((x, y))
    wanted = [line_dedup.similar(line_dedup.shingles(x), line_dedup.shingles(y)) for x, y in pairs]
    assert list(line_dedup._verdicts(pairs)) == wanted and 100 < sum(wanted) < len(wanted) - 100


def test_shuffles_are_let_go(spark):
    known = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    session.let_go(spark)
    time.sleep(1)
    before = known.size()
    found = line_dedup._settled(spark.range(1000).repartition(7, "id"), "some-rows")
    until = time.time() + 20
    while known.size() > before and time.time() < until:
        time.sleep(0.2)
    assert known.size() <= before and len(found.collect()) == 1000
