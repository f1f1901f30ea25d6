"""Table functions for SQL: ``LATERAL sentence_rows(text)`` and the like.

They give the rows of the Column forms to users of ``spark.sql``. Rows reach
Python in Arrow batches; a function over a whole table takes it by partition and
holds a few numbers of the partition at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql import functions as F

#: A sentence with its closing marks; white space around a text, which the four ASCII separators are not.
SENTENCE = re.compile(r"[^.!?…\n]+[.!?…]*")
SPACE = re.compile(r"^[^\S\x1c-\x1f]+|[^\S\x1c-\x1f]+$")


def _stripped(text: str) -> str:
    return SPACE.sub("", text)


@F.udtf(returnType="pos int, sentence string", useArrow=True)
class SentenceRows:
    """The sentences of a text, positions from 0; a null text has none."""

    def eval(self, text: str | None) -> Iterator[tuple[int, str]]:
        found = (_stripped(s) for s in SENTENCE.findall(text or ""))
        yield from enumerate(s for s in found if s)


@F.udtf(returnType="pos int, name string, reason string", useArrow=True)
class NumberedRows:
    """The lines "1. name - reason" of a text; without exactly one " - " the whole line is the name."""

    def eval(self, text: str | None) -> Iterator[tuple[int, str, str]]:
        lines = (_stripped(line) for line in (text or "").split("\n"))
        for pos, line in enumerate(line for line in lines if line):
            body = line.split(". ", 1)[-1]
            parts = body.split(" - ")
            yield (pos, _stripped(parts[0]), _stripped(parts[1])) if len(parts) == 2 else (pos, _stripped(body), "")


@F.udtf(returnType="part string, texts long, letters long, vowels long", useArrow=True)
class LetterCounts:
    """Texts, ASCII letters and vowels of a partition. Takes TABLE(part, text) PARTITION BY part."""

    def __init__(self) -> None:
        self.part, self.texts, self.letters, self.vowels = None, 0, 0, 0

    def eval(self, row: Row) -> None:
        text = row["text"] or ""
        self.part = row["part"]
        self.texts += 1
        self.letters += len(re.findall("[a-zA-Z]", text))
        self.vowels += len(re.findall("[aeiou]", text))

    def terminate(self) -> Iterator[tuple]:
        if self.texts:
            yield self.part, self.texts, self.letters, self.vowels


def register_table_functions(spark: SparkSession) -> None:
    """Makes the table functions known to ``spark.sql`` under their SQL names."""
    for name, function in (("sentence_rows", SentenceRows), ("numbered_rows", NumberedRows), ("letter_counts", LetterCounts)):
        spark.udtf.register(name, function)
