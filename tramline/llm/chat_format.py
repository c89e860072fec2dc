"""Chat formatting: every assistant turn becomes an example of its own.

An example holds all turns up to one assistant turn, marked by a template; only that
turn's text is trainable. Where turns follow the last assistant turn, or there is none,
one more example holds the whole conversation with nothing to train on, so no turn is
lost. Examples of a conversation are made in one pass over its sorted turns: a task
keeps the marked text so far and yields it at each assistant turn.

Template: <|im_start|>role<|im_sep|>text<|im_end|>. Control strings (CONTROLS, also those
of other templates) are escaped inside roles and texts: a backslash is doubled, and a
backslash goes after a control string's first character, so none is left in a text and
`unescape` gives back the original.

Defined results: null roles and texts count as empty; turns are ordered by turn, role
and text, null turns first; repeated turns all stay; a null conversation id is a
conversation like any other; other columns are dropped.
"""

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm import common

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
# Control strings of this and other chat templates.
CONTROLS = (START, SEPARATOR, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TRAINED_ROLE = "assistant"

_CONTROL = re.compile("|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROLS))
_TURN = re.compile(f"{re.escape(START)}(.*?){re.escape(SEPARATOR)}(.*?){re.escape(END)}", re.DOTALL)
_EXAMPLE = pa.schema(
    [
        ("example", pa.int64()),
        ("text", pa.large_string()),
        ("loss_start", pa.int64()),
        ("loss_chars", pa.int64()),
        ("last", pa.bool_()),
    ]
)

_DIGEST = ("id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0] + "\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def marked(role: str, text: str) -> str:
    return f"{START}{escape(role)}{SEPARATOR}{escape(text)}{END}"


def turns_of(formatted: str):
    """The (role, text) pairs of a formatted example."""
    for m in _TURN.finditer(formatted):
        yield unescape(m[1]), unescape(m[2])


def expanded(turns):
    """(example, text, loss_start, loss_chars, last) of one conversation's (role, text) turns.

    An example is held back until it is known whether it is the last.
    """
    text, number, held = "", 0, None
    open_turns = False  # turns since the held example
    for role, content in turns:
        start = len(text) + len(START) + len(escape(role)) + len(SEPARATOR)
        text += marked(role, content)
        open_turns = True
        if role == TRAINED_ROLE:
            if held:
                yield (*held, False)
            held = (number, text, start, len(escape(content)))
            number, open_turns = number + 1, False
    if held:
        yield (*held, not open_turns)
    if open_turns:
        yield number, text, 0, 0, True


def format_examples(conversations: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """(id_column, example, text, loss_start, loss_chars, last), places in characters.

    Ids that are not whole numbers come out as text.
    A conversation's examples come one after another in one partition, in order.
    """
    common.ship(conversations.sparkSession)
    whole = dict(conversations.dtypes)[id_column] in ("tinyint", "smallint", "int", "bigint")
    kind = "long" if whole else "string"
    schema = pa.schema([("id", pa.int64() if whole else pa.string()), *_EXAMPLE])

    def conversations_of(rows):
        """(id, turns) with the turns as an iterator that has to be used up."""
        row = next(rows, None)
        while row is not None:
            conv = row[0]

            def turns(first=row):
                nonlocal row
                row = first
                while row is not None and row[0] == conv:
                    yield row[1], row[2]
                    row = next(rows, None)

            yield conv, turns()

    def run(stream):
        rows = common.records(stream, "id", "role", "text")
        examples = ((conv, *e) for conv, turns in conversations_of(rows) for e in expanded(turns))
        yield from common.batches(examples, schema, lambda e: len(e[2]))

    columns = [F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")]
    turns = conversations.select(F.col(id_column).alias("id"), "turn", *columns)
    ordered = turns.repartition("id").sortWithinPartitions("id", "turn", "role", "text")
    out = f"id {kind}, example long, text string, loss_start long, loss_chars long, last boolean"
    rows = ordered.selectExpr(f"CAST(id AS {kind}) AS id", "role", "text")
    return rows.mapInArrow(run, out).withColumnRenamed("id", id_column)


def read_back(examples: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """Digests of conversations, read from their formatted examples in order."""
    id_type = dict(examples.dtypes)[id_column]

    def run(stream):
        held, found = None, []
        for batch in stream:
            for conv, text, start, chars, last in common.records([batch], "id", "text", "loss_start", "loss_chars", "last"):
                if held is None:
                    held = [conv, 0, None, 0, hashlib.sha256(), 0]
                trained = unescape(text[start : start + chars])
                held[3] += len(trained)
                held[4].update(trained.encode())
                held[5] += len(text)
                if last:
                    turns = hashlib.sha256()
                    for role, content in turns_of(text):
                        held[1] += 1
                        turns.update(f"{role}\n{content}\n".encode())
                    found.append((conv, held[1], turns.hexdigest(), held[3], held[4].hexdigest(), held[5]))
                    held = None
            if found:
                yield pa.RecordBatch.from_pydict(dict(zip(_DIGEST, map(list, zip(*found, strict=True)), strict=True)))
            found = []

    out = f"id {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    rows = examples.withColumnRenamed(id_column, "id")
    return rows.mapInArrow(run, out).withColumnRenamed("id", id_column)
