"""Phrases that stand together more often than their parts would by chance.

The words with at least `least` occurrences get ids by falling frequency; texts become
blocks of word ids, cut at punctuation. A frequent phrase is a frequent phrase with one more
word, so phrases are counted as pairs (phrase id, word id), length by length:

* A block counts its pairs in tiles of TILE x TILE ids. Ids being ranks, few tiles hold
  most pairs: those are counted by a dense bincount, the others as sorted coordinates.
* Blocks' counts are added up by Spark; the frequent pairs are ranked by frequency again,
  and their ranks are the ids of the next length's phrases.
* Blocks learn ids from a broadcast table if that was counted to have at most KNOWN_WORDS
  words or KNOWN_PAIRS pairs; beyond that, blocks carry their own numbers, and each gets
  back the ids of its own words or pairs by a join.

Every part of a frequent phrase is frequent, so all counts that a score needs are known,
and a phrase lies inside a longer one as frequent only if one of one more word is so.

Defined results: a null text is empty; a null language is UNKNOWN; case is folded for A-Z
only; equal rows count as often as they are there; no documents give no phrases; other
columns are not read.
"""

import re
from collections import Counter, defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.llm import common
from tramline.session import materialise

LONGEST = 5
LEAST = 100
TOP = 2_000
UNKNOWN = "und"
TILE = 512
# A tile with pairs for so large a share of its cells is counted densely.
DENSE_SHARE = 1 / 16
BLOCK_WORDS = 1 << 18
TEXT_BYTES = 1 << 20
# Blocks of so many words together are counted at once.
COUNT_WORDS = 1 << 19
# What may be broadcast: some 20 and 50 MB.
KNOWN_WORDS = 200_000
KNOWN_PAIRS = 2_000_000
# Distinct words a task counts before it passes the counts on.
COUNTED_WORDS = 50_000

_TOKEN = re.compile(rb"[.,;:!?\x0a-\x0d]|[^\x20\x09.,;:!?\x0a-\x0d]+")
_CUT = re.compile(rb"[.,;:!?\x0a-\x0d]")
_NONE = -1


_PUNCTUATION = {bytes([c]): _NONE for c in b".,;:!?\n\x0b\x0c\r"}


class _Block:
    """Words of one language as numbers in order, _NONE where a phrase cannot go on."""

    def __init__(self, known: dict[bytes, int] | None = None):
        """With the words' ids, or to number the words itself."""
        self.own = known is None
        if known is None:
            known = defaultdict(count().__next__, _PUNCTUATION)
        self.number = known
        self.parts, self.size = [], 0

    def add(self, tokens: list[bytes]) -> None:
        numbers = map(self.number.__getitem__, tokens) if self.own else (self.number.get(t, _NONE) for t in tokens)
        self.parts += [np.fromiter(numbers, np.int32, len(tokens)), np.array([_NONE], np.int32)]
        self.size += len(tokens) + 1

    def row(self, lang: str) -> tuple:
        words = [w.decode() for w, i in self.number.items() if i != _NONE] if self.own else None
        return lang, words, np.concatenate(self.parts).tobytes()


def _slices(text: bytes):
    """A text in parts of about TEXT_BYTES that end at punctuation."""
    begin = 0
    while len(text) - begin > TEXT_BYTES and (cut := _CUT.search(text, begin + TEXT_BYTES)):
        yield text[begin : cut.end()]
        begin = cut.end()
    yield text[begin:]


def _tokens(rows):
    """(lang, words and punctuation) of parts of texts."""
    for lang, text in rows:
        for part in _slices((text or "").encode().lower()):  # bytes fold A-Z only
            yield lang, _TOKEN.findall(part)


def _block_rows(rows, known: dict[str, dict[bytes, int]] | None = None):
    blocks: dict[str, _Block] = {}
    size = 0
    for lang, tokens in _tokens(rows):
        if lang not in blocks:
            blocks[lang] = _Block(known and known.get(lang, {}))
        before = blocks[lang].size
        blocks[lang].add(tokens)
        size += blocks[lang].size - before
        if blocks[lang].size >= BLOCK_WORDS or size >= 4 * BLOCK_WORDS:
            largest = max(blocks, key=lambda k: blocks[k].size)
            size -= blocks[largest].size
            yield blocks.pop(largest).row(largest)
    for lang, block in blocks.items():
        yield block.row(lang)


def _texts(docs: DataFrame, lang_column: str, text_column: str) -> DataFrame:
    lang, text = (F.col(common.quoted(c)) for c in (lang_column, text_column))
    return docs.select(F.coalesce(lang.cast("string"), F.lit(UNKNOWN)).alias("lang"), text.alias("text"))


def _word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, n), some words several times; a null word has the number of all words."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])

    def counted(rows):
        counts: dict[str, Counter] = defaultdict(Counter)
        for lang, tokens in _tokens(rows):
            counts[lang].update(tokens)
            if sum(map(len, counts.values())) > COUNTED_WORDS:
                yield from counts.items()
                counts.clear()
        yield from counts.items()

    def words(rows):
        for lang, found in counted(rows):
            for c in _PUNCTUATION:
                found.pop(c, None)
            yield lang, None, found.total()
            for word, n in found.items():
                yield lang, word.decode(), n

    def run(stream):
        yield from common.batches(words(common.records(stream, "lang", "text")), schema, lambda r: 64)

    return texts.mapInArrow(run, "lang string, word string, n long")


def _blocks(texts: DataFrame, known=None) -> DataFrame:
    """(block, lang, words, ids); `known` is a broadcast of words' ids, else blocks number their own."""
    schema = pa.schema(
        [("block", pa.int64()), ("lang", pa.string()), ("words", pa.list_(pa.string())), ("ids", pa.large_binary())]
    )

    def run(stream):
        # Unique in the one job that writes the blocks, whichever attempt of a task it is.
        own = TaskContext.get().partitionId() << 32
        rows = _block_rows(common.records(stream, "lang", "text"), known and known.value)
        rows = ((own + k, *row) for k, row in enumerate(rows))
        yield from common.batches(rows, schema, lambda r: 4 * len(r[3]) + 64 * len(r[2] or ()))

    return texts.mapInArrow(run, "block long, lang string, words array<string>, ids binary")


def ranked(counts: DataFrame, *keys: str) -> DataFrame:
    """Adds `id`: the place by falling `n`, then by the keys, from 0.

    A sort over all partitions; a row's place is its partition's first place plus its
    place there.
    """
    order = [F.desc("n"), *keys]
    spread = counts.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialise(spread.withColumn("at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftrightunsigned("at", 33).alias("part")
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias("many"))  # one row for a partition
    before = F.sum("many").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    firsts = sizes.select("part", F.coalesce(before, F.lit(0)).alias("first"))
    own = placed.select("*", part).join(F.broadcast(firsts), "part")
    return own.withColumn("id", F.col("first") + F.col("at") % (1 << 33)).drop("part", "first", "at")


def count_pairs(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(left, right, n) of the distinct pairs."""
    across = int(right.max()) // TILE + 1 if len(right) else 1
    tile = left // TILE * across + right // TILE
    cell = left % TILE * TILE + right % TILE
    order = np.argsort(tile, kind="stable")
    tile, cell = tile[order], cell[order]
    first = np.flatnonzero(np.r_[True, tile[1:] != tile[:-1]]) if len(tile) else np.zeros(0, int)
    size = np.diff(np.r_[first, len(tile)])
    dense = size >= DENSE_SHARE * TILE * TILE
    tiles, cells, counts = [], [], []
    for begin, many in zip(first[dense], size[dense], strict=True):
        sums = np.bincount(cell[begin : begin + many], minlength=TILE * TILE)
        cells.append(np.flatnonzero(sums))
        counts.append(sums[cells[-1]])
        tiles.append(np.full(len(cells[-1]), tile[begin]))
    rest = np.repeat(~dense, size)
    codes, many = np.unique(tile[rest] * (TILE * TILE) + cell[rest], return_counts=True)
    tile = np.concatenate([*tiles, codes // (TILE * TILE)])
    cell = np.concatenate([*cells, codes % (TILE * TILE)])
    return tile // across * TILE + cell // TILE, tile % across * TILE + cell % TILE, np.concatenate([*counts, many])


def _pairs(words: np.ndarray, phrases: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, phrase ids, word ids) where phrases of a length can go on by a word.

    `phrases` has the phrase that starts at each place. Both the phrase and the one a
    word further must be frequent.
    """
    goes_on = phrases[: -1 or None] >= 0
    goes_on &= phrases[1:] >= 0
    places = np.flatnonzero(goes_on[: len(words) - length])
    return places, phrases[places].astype(np.int64), words[places + length].astype(np.int64)


class Table:
    """Ids of the frequent pairs, for look-ups."""

    def __init__(self, left: np.ndarray, right: np.ndarray, ids: np.ndarray):
        self.wide = int(right.max(initial=0)) + 1
        codes = left.astype(np.int64) * self.wide + right
        order = np.argsort(codes)
        self.codes, self.ids = codes[order], ids[order].astype(np.int32)

    def longer(self, words: np.ndarray, phrases: np.ndarray, length: int) -> np.ndarray:
        """The phrases of one more word, from those of a length."""
        out = np.full(len(words), _NONE, np.int32)
        places, left, right = _pairs(words, phrases, length)
        fits = right < self.wide
        places, wanted = places[fits], left[fits] * self.wide + right[fits]
        if len(self.codes):
            at = np.minimum(np.searchsorted(self.codes, wanted), len(self.codes) - 1)
            found = self.codes[at] == wanted
            out[places[found]] = self.ids[at[found]]
        return out


def _numbers(batch, column: str) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), np.int32) for x in batch.column(column)]


def _phrases(batch) -> list[np.ndarray]:
    """Each block's phrases; where there are none yet, its words."""
    column = "words" if batch.column("phrases").null_count else "phrases"
    return _numbers(batch, column)


def _joint(stream, by_block: bool):
    """(block, words, phrases) of single blocks, or of blocks with COUNT_WORDS words together."""
    held, size = [], 0
    for batch in stream:
        for row in zip(batch.column("block").to_pylist(), _numbers(batch, "words"), _phrases(batch)):
            if by_block:
                yield row
                continue
            held.append(row)
            size += len(row[1])
            if size >= COUNT_WORDS:
                yield None, *(np.concatenate([x[c] for x in held]) for c in (1, 2))
                held, size = [], 0
    if held:
        yield None, *(np.concatenate([x[c] for x in held]) for c in (1, 2))


def _counted(blocks: DataFrame, length: int, tables: list, by_block: bool = False) -> DataFrame:
    """(block, left, right, n) of pairs, where blocks have phrases of a length and `tables`
    lead to longer ones. Without `by_block` a block is null and pairs come from several."""

    def run(stream):
        for block, words, phrases in _joint(stream, by_block):
            now = length
            for table in tables:
                phrases = table.value.longer(words, phrases, now)
                now += 1
            _, left, right = _pairs(words, phrases, now)
            left, right, n = count_pairs(left, right)
            for a in range(0, len(n), 100_000):
                part = slice(a, a + 100_000)
                own = pa.array(np.full(len(n[part]), block)) if by_block else pa.nulls(len(n[part]), pa.int64())
                arrays = [own, *(pa.array(x[part], pa.int64()) for x in (left, right, n))]
                yield pa.RecordBatch.from_arrays(arrays, ["block", "left", "right", "n"])

    return blocks.mapInArrow(run, "block long, left long, right long, n long")


def _lookup(batch, row: int) -> list[np.ndarray]:
    """The numbers of a list of structs, by field."""
    values = batch.column("known")[row].values
    return [values.field(i).to_numpy(zero_copy_only=False) for i in range(values.type.num_fields)]


_SCHEMA = "block long, words binary, phrases binary"


def _row(name: int, *numbers: np.ndarray):
    data = [pa.array([x.astype(np.int32).tobytes()], pa.binary()) for x in numbers]
    return pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), *data], ["block", "words", "phrases"][: 1 + len(data)])


def _numbered(texts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(block, words, phrases): blocks by word ids, rare words being _NONE; no phrases yet."""
    if vocabulary.count() <= KNOWN_WORDS:
        known: dict[str, dict[bytes, int]] = defaultdict(dict)
        for lang, word, i in vocabulary.collect():
            known[lang][word.encode()] = i
        held = texts.sparkSession.sparkContext.broadcast(dict(known))
        return _blocks(texts, held).select("block", F.col("ids").alias("words"), F.lit(None).cast("binary").alias("phrases"))

    blocks = materialise(_blocks(texts), "phrase-texts")
    own = blocks.select("block", "lang", F.posexplode("words").alias("number", "word"))
    joined = own.join(vocabulary, ["lang", "word"]).groupBy("block")
    known = joined.agg(F.collect_list(F.struct("number", "id")).alias("known"))

    def run(stream):
        for batch in stream:
            for row, ids in enumerate(_numbers(batch, "ids")):
                number, word = _lookup(batch, row)
                # Numbers without an id, and _NONE as the last place, stay _NONE.
                place = np.full(max(ids.max(initial=0), number.max(initial=0)) + 2, _NONE, np.int32)
                place[number] = word
                yield _row(batch.column("block")[row].as_py(), place[ids])

    found = blocks.select("block", "ids").join(known, "block").mapInArrow(run, "block long, words binary")
    return found.withColumn("phrases", F.lit(None).cast("binary"))


def _extended(blocks: DataFrame, length: int, tables: list, frequent: DataFrame) -> DataFrame:
    """Blocks with phrases of the frequent pairs, by a join of each block's own pairs."""
    pairs = _counted(blocks, length, tables, by_block=True).join(frequent.select("left", "right", "id"), ["left", "right"])
    known = pairs.groupBy("block").agg(F.collect_list(F.struct("left", "right", "id")).alias("known"))

    def run(stream):
        for batch in stream:
            numbers = zip(_numbers(batch, "words"), _phrases(batch))
            for row, (words, phrases) in enumerate(numbers):
                now = length
                for table in [*(t.value for t in tables), Table(*_lookup(batch, row))]:
                    phrases = table.longer(words, phrases, now)
                    now += 1
                yield _row(batch.column("block")[row].as_py(), words, phrases)

    return blocks.join(known, "block").mapInArrow(run, _SCHEMA)


def _broadcast(pairs: DataFrame):
    found = pairs.select("left", "right", "id").toArrow()
    table = Table(*(found.column(c).to_numpy() for c in ("left", "right", "id")))
    return pairs.sparkSession.sparkContext.broadcast(table)


def frequent_phrases(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, lang_column: str = "lang", text_column: str = "text"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(vocabulary, phrases, totals): (lang, word, n, id) of the frequent words, (words, n)
    of the phrases of one word and more as arrays of word ids, (lang, n) of all words."""
    common.ship(docs.sparkSession)
    texts = _texts(docs, lang_column, text_column)
    counts = _word_counts(texts).groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counts = materialise(counts.filter((F.col("n") >= least) | F.col("word").isNull()), "phrase-counts")
    totals = counts.filter("word IS NULL").select("lang", "n")
    vocabulary = materialise(ranked(counts.filter("word IS NOT NULL"), "lang", "word"), "phrase-words")

    level = vocabulary.select(F.array("id").alias("words"), "n", "id")
    phrases = [level]
    blocks = materialise(_numbered(texts, vocabulary.select("lang", "word", "id")), "phrase-blocks")
    reached, tables = 1, []  # the length of the blocks' phrases, and what leads to longer ones
    for length in range(1, longest):
        sums = _counted(blocks, reached, tables).groupBy("left", "right").agg(F.sum("n").alias("n"))
        frequent = materialise(ranked(sums.filter(F.col("n") >= least), "left", "right"), "phrase-frequent")
        shorter = level.select(F.col("id").alias("left"), F.col("words").alias("start"))
        level = frequent.join(shorter, "left").select(F.concat("start", F.array("right")).alias("words"), "n", "id")
        level = materialise(level, "phrases")
        phrases.append(level)
        if length + 1 == longest:
            break
        if frequent.count() <= KNOWN_PAIRS:
            tables.append(_broadcast(frequent))
        else:
            blocks = materialise(_extended(blocks, reached, tables, frequent), "phrase-blocks")
            reached, tables = length + 1, []
    every_length = phrases[0].select("words", "n")
    for level in phrases[1:]:
        every_length = every_length.unionByName(level.select("words", "n"))
    return vocabulary, every_length, totals


def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(38,0)")


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    top: int = TOP,
    lang_column: str = "lang",
    text_column: str = "text",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `top` phrases.

    `a`, `l`, `r` count the phrase, its first part and its rest at the cut that scores
    least (the first of equals), `n` all words; score is 1000 * a * n / (l * r) rounded
    down. Phrases that a longer one as frequent contains are left out.
    """
    vocabulary, counted, totals = frequent_phrases(docs, least, longest, lang_column, text_column)
    found = counted.filter(F.size("words") > 1).withColumnRenamed("n", "a")

    size = F.size("words")
    inner = F.explode(F.array(F.slice("words", 1, size - 1), F.slice("words", F.lit(2), size - 1)))
    within = found.filter(size > 2).select(inner.alias("words"), "a").groupBy("words").agg(F.max("a").alias("longer"))
    found = found.join(within, "words", "left").filter("longer IS NULL OR longer < a").drop("longer")

    cuts = found.select("*", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    first = counted.select(F.col("words").alias("first"), F.col("n").alias("l"))
    rest = counted.select(F.col("words").alias("rest"), F.col("n").alias("r"))
    cuts = cuts.withColumns({"first": F.slice("words", F.lit(1), F.col("k")), "rest": F.slice("words", F.col("k") + 1, size - F.col("k"))})
    cuts = cuts.join(first, "first").join(rest, "rest")
    cuts = cuts.withColumn("word_id", F.get("words", F.lit(0)))
    langs = vocabulary.select(F.col("id").alias("word_id"), "lang").join(totals, "lang")
    cuts = cuts.join(langs, "word_id")
    thousand = F.lit(1000).cast("decimal(38,0)")
    cuts = cuts.withColumns({"top": thousand * _exact("a") * _exact("n"), "under": _exact("l") * _exact("r")})
    cuts = cuts.withColumn("score", F.expr("top div under"))
    best = cuts.groupBy("words").agg(
        F.first("lang").alias("lang"), F.first("a").alias("a"), F.first("n").alias("n"), F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    spelled = best.select("words", F.posexplode("words").alias("at", "id")).join(vocabulary.select("id", "word"), "id")
    spelled = spelled.groupBy("words").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w"))
    named = best.join(spelled, "words").withColumn("phrase", F.array_join("w.word", " "))
    rows = named.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    columns = ("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    return rows.withColumn("rank", place).filter(F.col("rank") <= top).select(*columns)
