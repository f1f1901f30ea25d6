"""License scans by template markup.

A template is wording with marked regions: ``<<beginOptional>>`` to
``<<endOptional>>`` may be missing, ``<<var;name=N;words=A-B>>`` stands for A to
B words of any wording. Everything else is mandatory. Templates are compiled to
automata over words; a text carries the template's label where the automaton
accepts a run of its words, so mandatory wording has to match word for word.

Words are runs of ASCII letters and digits and of all characters beyond ASCII,
after lower-casing A-Z. Base phrases are counted beside the templates.

Defined cases: null text counts as empty; a text without words has no labels,
null first and last word and score 0; repeated rows are scanned each. Score: 1
where a template is accepted, 0.5 where only a base phrase stands, else 0.
Other columns are never looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# The wording of public licenses and of the notices that name them.
_COPYRIGHT = "<<beginOptional>>copyright <<var;name=holder;words=0-20>> all rights reserved<<endOptional>> "
_BSD_CLAUSES = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met <<var;name=bullet;words=0-1>> redistributions of source code must retain the above "
    "copyright notice this list of conditions and the following disclaimer <<var;name=bullet;words=0-1>> redistributions "
    "in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in "
    "the documentation and or other materials provided with the distribution ")
_BSD_DISCLAIMER = (
    "this software is provided by <<var;name=holder;words=1-12>> as is and any express or implied warranties including but not "
    "limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall "
    "<<var;name=holder;words=1-12>> be liable for any direct indirect incidental special exemplary or consequential damages "
    "including but not limited to procurement of substitute goods or services loss of use data or profits or business "
    "interruption however caused and on any theory of liability whether in contract strict liability or tort including "
    "negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage")
TEMPLATES = {
    "apache-2.0-notice": "licensed under <<beginOptional>>the<<endOptional>> apache license <<beginOptional>>version<<endOptional>> 2.0",
    "bsd-2-clause": _COPYRIGHT + _BSD_CLAUSES + _BSD_DISCLAIMER,
    "bsd-3-clause": _COPYRIGHT + _BSD_CLAUSES + (
        "<<var;name=bullet;words=0-1>> neither the name of <<var;name=holder;words=1-12>> nor the names of its contributors "
        "may be used to endorse or promote products derived from this software without specific prior written permission ") + _BSD_DISCLAIMER,
    "cc-by-4.0-notice": "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> creative commons attribution 4.0 international <<beginOptional>>public<<endOptional>> license",
    "gpl-2.0-notice": "licensed under <<beginOptional>>the<<endOptional>> <<beginOptional>>terms of the<<endOptional>> gnu general public license <<beginOptional>>version<<endOptional>> 2",
    "gpl-3.0-notice": "licensed under <<beginOptional>>the<<endOptional>> <<beginOptional>>terms of the<<endOptional>> gnu general public license <<beginOptional>>version<<endOptional>> 3",
    "isc": (
        "permission to use copy modify and <<beginOptional>>or<<endOptional>> distribute this software for any purpose with or "
        "without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies "
        "the software is provided as is and <<var;name=holder;words=1-8>> disclaims all warranties with regard to this software "
        "including all implied warranties of merchantability and fitness in no event shall <<var;name=holder;words=1-8>> be liable "
        "for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or "
        "profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use "
        "or performance of this software"),
    "mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of <<var;name=subject;words=1-6>> and associated "
        "documentation files the <<var;name=software;words=1-2>> to deal in the <<var;name=software;words=1-2>> without restriction "
        "including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the "
        "<<var;name=software;words=1-2>> and to permit persons to whom the <<var;name=software;words=1-2>> is furnished to do so "
        "subject to the following conditions the above copyright notice and this permission notice <<beginOptional>>including the "
        "next paragraph<<endOptional>> shall be included in all copies or substantial portions of the <<var;name=software;words=1-2>> "
        "the <<var;name=software;words=1-2>> is provided as is without warranty of any kind express or implied including but not "
        "limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall "
        "<<var;name=holder;words=1-8>> be liable for any claim damages or other liability whether in an action of contract tort or "
        "otherwise arising from out of or in connection with the <<var;name=software;words=1-2>> or the use or other dealings in the "
        "<<var;name=software;words=1-2>>"),
    "mit-notice": "<<var;name=verb;words=1-1>> under <<beginOptional>>the<<endOptional>> <<beginOptional>>terms of the<<endOptional>> mit license",
}

SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
_LOWER_OR_SPACE = bytes(
    i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i >= 128 else 32 for i in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER_OR_SPACE).split()


@dataclass
class Automaton:
    """States 0 to ``final``; ``step`` by word, ``any`` by any word, ``skip`` without one."""

    label: str
    final: int = 0
    step: dict[int, bytes] = field(default_factory=dict)
    any: set[int] = field(default_factory=set)
    skip: dict[int, list[int]] = field(default_factory=dict)
    anchor: bytes = b""

    def closure(self, states: set[int]) -> set[int]:
        todo, seen = list(states), set(states)
        while todo:
            for s in self.skip.get(todo.pop(), ()):
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return seen

    def accepts_at(self, tokens: Sequence[bytes], start: int) -> int:
        """The number of words of the shortest accepted run that starts here, 0 if there is none."""
        states = self.closure({0})
        for at in range(start, len(tokens)):
            word = tokens[at]
            states = self.closure({s + 1 for s in states if s in self.any or self.step.get(s) == word})
            if self.final in states:
                return at - start + 1
            if not states:
                return 0
        return 0

    def accepts(self, tokens: Sequence[bytes]) -> bool:
        first = {self.step[s] for s in self.closure({0}) if s in self.step}
        free = bool(self.closure({0}) & self.any)
        return any((free or w in first) and self.accepts_at(tokens, i) for i, w in enumerate(tokens))


def compile_template(label: str, template: str) -> Automaton:
    """The automaton of a template; its anchor is the longest mandatory word."""
    made, begun, mandatory = Automaton(label), [], []
    for part in re.split(r"(<<[^>]*>>)", template):
        if part == "<<beginOptional>>":
            begun.append(made.final)
        elif part == "<<endOptional>>":
            made.skip.setdefault(begun.pop(), []).append(made.final)
        elif variable := re.fullmatch(r"<<var;name=[^;]*;words=(\d+)-(\d+)>>", part):
            least, most = map(int, variable.groups())
            first = made.final
            for _ in range(most):
                made.any.add(made.final)
                made.final += 1
            for s in range(first + least, made.final):
                made.skip.setdefault(s, []).append(made.final)
        elif part.startswith("<<"):
            raise ValueError(f"unknown mark {part} in template {label}")
        else:
            for word in words(part):
                made.step[made.final] = word
                made.final += 1
                if not begun:
                    mandatory.append(word)
    if begun or not mandatory:
        raise ValueError(f"template {label} has an open region or no mandatory word")
    made.anchor = max(mandatory, key=len)
    return made


def base_places(tokens: Sequence[bytes], phrases: dict[tuple[bytes, ...], str]) -> list[tuple[int, str]]:
    """Start and label of every place where a phrase's words stand."""
    last = {p[-1] for p in phrases}
    found = []
    for end, word in enumerate(tokens):
        if word in last:
            found += [(end - len(p) + 1, label) for p, label in phrases.items() if end >= len(p) - 1 and tuple(tokens[end - len(p) + 1:end + 1]) == p]
    return sorted(found)


def scan(docs: DataFrame, templates: dict[str, str] | None = None, base: dict[str, str] | None = None,
         id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with its words, base phrases and labels."""
    automata = [compile_template(k, v) for k, v in (TEMPLATES if templates is None else templates).items()]
    phrases = {tuple(words(p)): label for p, label in (BASE_PHRASES if base is None else base).items()}
    needed = {p[-1] for p in phrases}

    def one(doc: int | None, value: str | None) -> tuple:
        plain = (value or "").encode("utf-8", "surrogatepass").translate(_LOWER_OR_SPACE)
        tokens = plain.split()
        places = base_places(tokens, phrases) if any(w in plain for w in needed) else []
        found = {a.label for a in automata if a.anchor in plain and a.accepts(tokens)}
        named = {label for _, label in places}
        starts = [p for p, _ in places]
        return (doc, len(tokens), len(places), min(starts, default=None), max(starts, default=None),
                ",".join(sorted(named)), ",".join(sorted(named | found)), 1.0 if found else 0.5 if named else 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64()]
        for batch in batches:
            rows = [one(d, t.as_py()) for d, t in zip(batch.column(0).to_pylist(), batch.column(1))]
            yield pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, SCHEMA)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
