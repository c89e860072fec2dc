"""Quality rules by repetition coverage: how much of a text repeats itself.

Words get numbers; a rolling hash (differences of prefix sums of a polynomial, modulo
2**64) gives every window of n words its value, for several n at once, and equal values
next to each other in sorted order are compared word by word, so that a collision counts
for nothing. Characters of words inside a window that its document has twice or more, the
first occurrence included, are that n's coverage; characters of lines that equal an
earlier line are the lines' coverage. A document fails by its base rules (too few words,
or too many inside repeated windows of three) or if a coverage exceeds its share.

Texts are measured in batches of about BATCH_CHARS characters, each in numpy; a longer
text is a batch of its own.

Defined results: a null or empty text has no words and fails; equal rows are measured
each; a null id is an id like any other; text is taken as it is, without case folding.
`measure` returns the id and the measures, `keep` the documents with all their columns.
"""

import re
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tramline.llm import common

LEAST_WORDS = 50
REPEAT_WORDS = 3
REPEAT_PERCENT = 50
# Words in a window, and the percentage of a text's word characters that windows found
# twice or more may cover.
COVERAGE_PERCENT = {5: 30, 6: 28, 7: 26, 8: 24, 9: 22, 10: 20}
LINE_PERCENT = 30
BATCH_CHARS = 1 << 20

_WORD = re.compile("[^\x20\x09-\x0d]+")
_SYMBOLS = "#*$%&|<>"
_BASE = 0x9E3779B97F4A7C15
_MIX = 0xD6E8FEB86659FD93
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars")


def _mixed(numbers: np.ndarray) -> np.ndarray:
    """Numbers spread over 64 bits."""
    x = numbers.astype(np.uint64) + np.uint64(1)
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(_MIX)
    return x ^ (x >> np.uint64(32))


class Windows:
    """The words of some texts one after another, by number, with hashes of all windows."""

    def __init__(self, words: np.ndarray, text: np.ndarray):
        self.words, self.text = words, text
        power = np.full(len(words), _BASE, np.uint64)
        inverse = np.full(len(words), pow(_BASE, -1, 1 << 64), np.uint64)
        if len(words):
            power[0] = inverse[0] = 1
        self.inverse = np.cumprod(inverse)
        self.sums = np.r_[np.uint64(0), np.cumsum(_mixed(words) * np.cumprod(power))]

    def _same(self, a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
        same = self.text[a] == self.text[b]
        for k in range(n):
            same &= self.words[a + k] == self.words[b + k]
        return same

    def repeated(self, n: int) -> np.ndarray:
        """Starts of the windows of n words that their text has twice or more."""
        starts = np.arange(max(0, len(self.words) - n + 1))
        starts = starts[self.text[starts] == self.text[starts + n - 1]]
        hashes = (self.sums[starts + n] - self.sums[starts]) * self.inverse[starts]
        hashes ^= _mixed(self.text[starts])
        order = np.argsort(hashes)
        starts, hashes = starts[order], hashes[order]
        equal = np.flatnonzero(hashes[1:] == hashes[:-1])
        if not self._same(starts[equal], starts[equal + 1], n).all():  # a collision: compare words
            rows = np.column_stack([self.text[starts], *(self.words[starts + k] for k in range(n))])
            _, group, many = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
            return starts[many[group.ravel()] > 1]
        twice = np.zeros(len(starts), bool)
        twice[equal] = twice[equal + 1] = True
        return starts[twice]

    def covered(self, n: int) -> np.ndarray:
        """Whether each word is inside such a window."""
        starts = self.repeated(n)
        steps = np.zeros(len(self.words) + 1, np.int32)
        steps[starts] += 1
        steps[starts + n] -= 1
        return np.cumsum(steps[:-1]) > 0


def _lines(text: str) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and their words' characters."""
    seen, found, chars = set(), 0, 0
    for line in text.split("\n"):
        if line in seen:
            found += 1
            chars += sum(map(len, _WORD.findall(line)))
        elif _WORD.search(line):
            seen.add(line)
    return found, chars


def measured(texts: list[str]) -> dict[str, np.ndarray]:
    """MEASURES and the covered characters of each n, by text."""
    number = defaultdict(count().__next__)
    words = [_WORD.findall(t) for t in texts]
    many = np.array([len(w) for w in words], np.int64)
    ids = np.fromiter((number[w] for ws in words for w in ws), np.int64, many.sum())
    chars = np.fromiter((len(w) for ws in words for w in ws), np.int64, many.sum())
    of = np.repeat(np.arange(len(texts)), many)
    windows = Windows(ids, of)

    def by_text(values):
        return np.bincount(of, values, len(texts)).astype(np.int64)

    lines = [_lines(t) for t in texts]
    out = {
        "n_words": many,
        "word_chars": by_text(chars),
        "n_symbols": np.array([sum(map(t.count, _SYMBOLS)) for t in texts], np.int64),
        "n_dup_lines": np.array([n for n, _ in lines], np.int64),
        "n_repeat_words": by_text(windows.covered(REPEAT_WORDS)),
        "dup_line_chars": np.array([c for _, c in lines], np.int64),
    }
    return out | {f"dup_chars_{n}": by_text(chars * windows.covered(n)) for n in COVERAGE_PERCENT}


def verdicts(found: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(base_failed, kept) of measured texts."""
    words, chars = found["n_words"], found["word_chars"]
    failed = (words < LEAST_WORDS) | (100 * found["n_repeat_words"] > REPEAT_PERCENT * words)
    kept = ~failed & (100 * found["dup_line_chars"] <= LINE_PERCENT * chars)
    for n, percent in COVERAGE_PERCENT.items():
        kept &= 100 * found[f"dup_chars_{n}"] <= percent * chars
    return failed, kept


def _parts(texts: list[str]):
    """Ranges of texts with about BATCH_CHARS characters together."""
    begin = size = 0
    for i, text in enumerate(texts):
        if i > begin and size + len(text) > BATCH_CHARS:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def _judged(docs: DataFrame, keep: list[str], text_column: str, measures: list[str]) -> DataFrame:
    """The columns `keep` as they are, numbered so that names cannot clash, and results."""
    common.ship(docs.sparkSession)
    types = dict(docs.dtypes)
    names = [f"c{i}" for i in range(len(keep))]
    columns = [docs[common.quoted(c)].alias(n) for c, n in zip(keep, names, strict=True)]
    results = [*measures, "base_failed", "kept"]

    def run(stream):
        for batch in stream:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                texts = [t or "" for t in part.column(part.num_columns - 1).to_pylist()]
                for a, b in _parts(texts):
                    found = measured(texts[a:b])
                    failed, kept = verdicts(found)
                    values = [pa.array(found[m], pa.int64()) for m in measures] + [pa.array(failed), pa.array(kept)]
                    held = part.slice(a, b - a).columns[:-1]
                    yield pa.RecordBatch.from_arrays([*held, *values], [*names, *results])

    schema = [f"{n} {types[c]}" for c, n in zip(keep, names, strict=True)]
    schema += [f"{m} long" for m in measures] + ["base_failed boolean", "kept boolean"]
    return docs.select(*columns, docs[common.quoted(text_column)].alias("t")).mapInArrow(run, ", ".join(schema))


def measure(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id_column, MEASURES, dup_chars_n, base_failed, kept) of every row."""
    measures = [*MEASURES, *(f"dup_chars_{n}" for n in COVERAGE_PERCENT)]
    return _judged(docs, [id_column], text_column, measures).withColumnRenamed("c0", id_column)


def keep(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The documents that pass, with all their columns."""
    judged = _judged(docs, docs.columns, text_column, [])
    return judged.filter("kept").drop("base_failed", "kept").toDF(*docs.columns)
