"""Top documents for each query by best-first search over range maxima.

Documents are scored by summed impacts: a term's weight times how much the document is
about it, in whole numbers. A shard of documents keeps one posting list for each query
term, by document, with a sparse table over its impacts: the maximum of any range of a
list is the larger of two table cells. A query starts with the interval of all the shard's
documents, bounded by the sum of its terms' weighted range maxima. The interval with the
largest bound is split at the document with the most impact of the term that counts most
there; that document is scored whole, the two rest intervals are bounded anew. An interval
with at most LEAF_POSTINGS postings of the query is scored at once. When no bound reaches
the worst of the documents held, they are the shard's best; the next shard of the task
starts with them.

A task indexes one shard at a time: at most SHARD_DOCS documents or SHARD_POSTINGS
postings. Queries are searched in rounds of about ROUND_TERMS terms, the bound of what is
broadcast; a round reads the documents once and shuffles each task's best only.

Defined results: a null or empty text has no terms and does not count as a document;
queries without terms, and documents with a score of 0, give no rows; rows with one item
id are one query with the terms of all; equal rows of documents rank each, ties by id,
a null id last; other columns are not read.
"""

import heapq
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramline.llm import common
from tramline.session import materialise

TOP = 10
SHARD_DOCS = 1 << 15
SHARD_POSTINGS = 1 << 21
LEAF_POSTINGS = 1 << 10
ROUND_TERMS = 200_000
# Score parameters, in units of a thousandth and a billionth.
LENGTH_SHARE = 90
DAMPING = 8
UNIT = 1_000_000_000

_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def terms(text: str | None) -> list[bytes]:
    """Runs of letters, digits and whatever is not ASCII; only A-Z are folded."""
    return _TERM.findall((text or "").encode().lower())


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class Shard:
    """Posting lists of some documents, which are numbered by their order."""

    def __init__(self, docs: int, term: np.ndarray, doc: np.ndarray, impact: np.ndarray):
        """The postings, in any order; `docs` is the number of documents."""
        self.docs = docs
        order = np.lexsort((doc, term))
        term, self.doc = term[order], doc[order]
        self.key = term.astype(np.int64) * docs + self.doc
        start = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.zeros(0, int)
        end = np.r_[start[1:], len(term)].astype(int) if len(term) else start
        self.lists = {t: (a, b) for t, a, b in zip(term[start].tolist(), start.tolist(), end.tolist(), strict=True)}
        # Row j has the largest of 2**j impacts from each place on.
        self.table = [impact[order].astype(np.int64)]
        longest = int((end - start).max(initial=1))
        while 2 << (len(self.table) - 1) <= longest:
            last, step = self.table[-1], 1 << (len(self.table) - 1)
            row = last.copy()
            row[:-step] = np.maximum(last[:-step], last[step:])
            self.table.append(row)
        self.table = np.stack(self.table)

    def range_max(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The largest impact in places low to high, none of which is empty."""
        level = np.frexp(high - low)[1] - 1
        return np.maximum(self.table[level, low], self.table[level, high - (1 << level)])

    def _score(self, first: int, end: int, weights, low, high, ids: list, best: "Best") -> None:
        """Offers all documents from first to end."""
        many = high - low
        places = np.repeat(low - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum())
        scores = np.zeros(end - first, np.int64)
        np.add.at(scores, self.doc[places] - first, np.repeat(weights, many) * self.table[0, places])
        likely = np.flatnonzero(scores >= best.least())
        for k in likely[np.argsort(-scores[likely], kind="stable")][: best.top]:
            best.take(int(scores[k]), ids[first + k])

    def search(self, query: list[tuple[int, int]], ids: list, best: "Best") -> None:
        """Offers documents to `best` until no other can be among them; query: (term, weight)."""
        held = [(t, w, *self.lists[t]) for t, w in query if w > 0 and t in self.lists]
        if not held:
            return
        term, weights, low, high = (np.array(c, np.int64) for c in zip(*held, strict=True))
        waiting: list = []

        def wait(first, end, term, weights, low, high):
            there = low < high
            if first >= end or not there.any():
                return
            term, weights, low, high = (x[there] for x in (term, weights, low, high))
            bounds = weights * self.range_max(low, high)
            bound = int(bounds.sum())
            if best.may_take(bound, ids[first]):
                heapq.heappush(waiting, (-bound, first, end, int(bounds.argmax()), term, weights, low, high))

        wait(0, self.docs, term, weights, low, high)
        while waiting:
            bound, first, end, most, term, weights, low, high = heapq.heappop(waiting)
            if not best.may_take(-bound, ids[first]):
                if -bound < best.least():
                    return
                continue
            if (high - low).sum() <= LEAF_POSTINGS:
                self._score(first, end, weights, low, high, ids, best)
                continue
            a, b = low[most], high[most]
            doc = int(self.doc[a + self.table[0, a:b].argmax()])
            place = np.searchsorted(self.key, term * self.docs + doc)
            found = place < high
            found[found] = self.doc[place[found]] == doc
            best.take(int((weights[found] * self.table[0, place[found]]).sum()), ids[doc])
            wait(first, doc, term, weights, low, place)
            wait(doc + 1, end, term, weights, place + found, high)


def _id_key(document) -> tuple:
    return document is None, document


class _Latest:
    """Orders a document after those with smaller ids, the other way round for a heap."""

    __slots__ = ("key",)

    def __init__(self, document):
        self.key = _id_key(document)

    def __lt__(self, other):
        return self.key > other.key

    def __eq__(self, other):
        return self.key == other.key


class Best:
    """The `top` documents of largest score, equal scores by smallest id."""

    def __init__(self, top: int):
        self.top, self.held = top, []

    def least(self) -> int:
        """The smallest score that may still be taken."""
        return self.held[0][0] if len(self.held) >= self.top else 1

    def may_take(self, score: int, document) -> bool:
        if score <= 0 or len(self.held) < self.top:
            return score > 0
        return (score, _Latest(document)) > self.held[0][:2]

    def take(self, score: int, document) -> None:
        if not self.may_take(score, document):
            return
        entry = (score, _Latest(document), document)
        if len(self.held) < self.top:
            heapq.heappush(self.held, entry)
        else:
            heapq.heapreplace(self.held, entry)


def _counted(docs: DataFrame, known, id_column: str, text_column: str) -> DataFrame:
    """(id, n, terms, times): each document's words and its occurrences of known terms."""
    id_type = dict(docs.dtypes)[id_column]

    def run(stream):
        number = known.value
        for batch in stream:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                n, which, times = [], [], []
                for text in part.column(1).to_pylist():
                    words = terms(text)
                    counts = Counter(map(number.get, words))
                    counts.pop(None, None)
                    n.append(len(words))
                    which.append(list(counts))
                    times.append(list(counts.values()))
                arrays = [part.column(0), pa.array(n, pa.int64()), pa.array(which, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "n", "terms", "times"])

    columns = [docs[common.quoted(id_column)].alias("id"), docs[common.quoted(text_column)].alias("text")]
    counted = docs.select(*columns).mapInArrow(run, f"id {id_type}, n long, terms array<int>, times array<long>")
    return counted.filter("n > 0")


def _shards(stream):
    """(ids, term, doc, times, n of the posting's document) of bounded parts of a task's rows."""
    held, docs, postings = [], 0, 0

    def shard():
        ids = [i for part in held for i in part[0]]
        order = sorted(range(len(ids)), key=lambda k: _id_key(ids[k]))
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        many = np.concatenate([part[2] for part in held])
        own = np.repeat(np.arange(len(ids)), many)
        n = np.concatenate([part[1] for part in held])
        return [ids[k] for k in order], *(np.concatenate([part[c] for part in held]) for c in (3, 4)), place[own], n[own]

    for batch in stream:
        for start in range(0, batch.num_rows, 1000):
            part = batch.slice(start, 1000)
            many = np.array([len(t) for t in part.column("terms")], np.int64)
            lists = [part.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("terms", "times")]
            held.append((part.column("id").to_pylist(), part.column("n").to_numpy(), many, *lists))
            docs, postings = docs + part.num_rows, postings + many.sum()
            if docs >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                yield shard()
                held, docs, postings = [], 0, 0
    if held:
        yield shard()


def impacts(times: np.ndarray, n: np.ndarray, documents: int, words: int) -> np.ndarray:
    """How much each posting's document is about its term."""
    length = 100 - LENGTH_SHARE + LENGTH_SHARE * n * documents // words
    return UNIT * times // (1000 * times + DAMPING * length)


def _searched(counted: DataFrame, queries, top: int) -> DataFrame:
    """(item, id, score): the best of each task for each query."""
    id_type = counted.schema["id"].dataType

    def run(stream):
        documents, words, items = queries.value
        best = defaultdict(lambda: Best(top))
        for ids, term, times, doc, n in _shards(stream):
            shard = Shard(len(ids), term, doc, impacts(times, n, documents, words))
            for number, query in enumerate(items):
                shard.search(query, ids, best[number])
        rows = [(k, document, score) for k, b in best.items() for score, _, document in b.held]
        if rows:
            number, found, scores = zip(*rows, strict=True)
            arrays = [pa.array(number, pa.int64()), pa.array(found, arrow_type), pa.array(scores, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["item", "id", "score"])

    from pyspark.sql.pandas.types import to_arrow_type

    arrow_type = to_arrow_type(id_type)
    return counted.mapInArrow(run, f"item long, id {id_type.simpleString()}, score long")


def _query_terms(items: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(item, term) of the distinct terms of each item."""
    id_type = dict(items.dtypes)[id_column]

    def run(stream):
        for batch in stream:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                found = [sorted(set(terms(t))) for t in part.column(1).to_pylist()]
                own = [i for i, f in enumerate(found) for _ in f]
                words = pa.array([w.decode() for f in found for w in f], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(own, pa.int64())), words], ["item", "term"])

    columns = [items[common.quoted(c)] for c in (id_column, text_column)]
    named = items.select(columns[0].alias("item"), columns[1].alias("text"))
    return named.mapInArrow(run, f"item {id_type}, term string").distinct()


def _round(docs: DataFrame, own: DataFrame, item_type, top: int, id_column: str, text_column: str) -> DataFrame:
    """(item, id, score) of the best documents of each task for one round's queries."""
    spark = docs.sparkSession
    pairs = own.collect()  # about ROUND_TERMS
    number: dict[bytes, int] = {}
    wanted: dict = defaultdict(list)
    for item, term in pairs:
        wanted[item].append(number.setdefault(term.encode(), len(number)))
    known = spark.sparkContext.broadcast(number)
    counted = materialise(_counted(docs, known, id_column, text_column), "search-counts")
    documents, words = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = dict(counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect())  # a row for a term at most
    weights = {t: weight(documents, holding[t]) for t in number.values() if t in holding}
    names = list(wanted)
    queries = [[(t, weights[t]) for t in wanted[i] if t in weights] for i in names]
    held = spark.sparkContext.broadcast((documents, words, queries))
    numbered = spark.createDataFrame(list(enumerate(names)), f"number long, item {item_type}")
    found = _searched(counted, held, top).withColumnRenamed("item", "number")
    return materialise(found.join(F.broadcast(numbered), "number").select("item", "id", "score"), "search-best")


def search(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    round_terms: int = ROUND_TERMS,
) -> DataFrame:
    """(item, rank, id, score): the `top` documents of each item of `items`."""
    common.ship(docs.sparkSession)
    queries = materialise(_query_terms(items, item_column, item_text_column), "search-terms")
    item_type = dict(queries.dtypes)["item"]
    rounds = max(1, -(-queries.count() // round_terms))
    in_round = F.pmod(F.xxhash64(F.col("item").cast("string")), F.lit(rounds))
    found = None
    for k in range(rounds):
        part = _round(docs, queries.filter(in_round == k), item_type, top, id_column, text_column)
        found = part if found is None else found.unionByName(part)
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id")))
    ranked = found.withColumn("rank", place.cast("int")).filter(F.col("rank") <= top)
    return ranked.select("item", "rank", "id", "score")
