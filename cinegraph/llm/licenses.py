"""License scans: phrases, and license templates matched as token automata.

A template is written in markup: mandatory words, ``<<beginOptional>>`` ...
``<<endOptional>>`` regions that may be missing, and ``<<var;words=lo-hi>>`` regions that
stand for lo to hi words of any kind.  It compiles to a non-deterministic automaton over
words; a text is accepted where the mandatory wording follows exactly.  The automaton
starts only where the template's first mandatory words stand.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import texts

# The base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# License wordings (words as the scan reads them), with optional and replaceable regions.
TEMPLATES = {
    "apache-2.0": "licensed under <<beginOptional>>the terms of<<endOptional>> the apache license "
                  "<<beginOptional>>version<<endOptional>> 2 0",
    "apache-2.0-notice": "you may not use this file except in compliance with the license you may obtain a copy of "
                         "the license at <<var;words=1-12>> unless required by applicable law",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided "
           "that the following conditions are met <<var;words=0-12>> redistributions of source code must retain the "
           "above copyright notice",
    "cc-by-4.0": "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>creative commons"
                 "<<endOptional>> cc by 4 0",
    "cc-by-nc-4.0": "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>creative commons"
                    "<<endOptional>> cc by nc <<beginOptional>>sa<<endOptional>> <<beginOptional>>nd"
                    "<<endOptional>> 4 0",
    "cc-by-sa-4.0": "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>creative commons"
                    "<<endOptional>> cc by sa 4 0",
    "cc-attribution": "licensed under a creative commons attribution <<var;words=0-6>> license",
    "gpl-2.0": "licensed under <<beginOptional>>the terms of<<endOptional>> the <<beginOptional>>gnu<<endOptional>> "
               "general public license <<var;words=0-8>> version 2",
    "gpl-3.0": "licensed under <<beginOptional>>the terms of<<endOptional>> the <<beginOptional>>gnu<<endOptional>> "
               "general public license <<var;words=0-8>> version 3",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                  "general public license as published by the free software foundation",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is "
           "hereby granted",
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
           "associated documentation files <<beginOptional>>the software<<endOptional>> to deal in the software "
           "without restriction",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "public-domain": "this is free and unencumbered software released into the public domain",
    "rights-reserved": "all rights reserved <<var;words=0-3>> no part of this <<var;words=1-3>> may be reproduced",
}

_MARK = re.compile(r"<<(.*?)>>")
#: every ASCII byte that is no digit or letter to a space, A-Z to a-z
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
_ANY = None


@dataclass(frozen=True)
class Automaton:
    """States are numbers; ``step[state]`` lists (word or any, next), ``free`` the states
    reached without a word."""
    start: bytes
    step: tuple
    free: tuple
    accept: int

    def closure(self, states: set[int]) -> set[int]:
        todo, seen = list(states), set(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return seen

    def accepts(self, words: Iterator[bytes]) -> bool:
        """Whether the words from a start on complete the mandatory wording."""
        now = self.closure({0})
        for word in words:
            now = self.closure({t for s in now for w, t in self.step[s] if w is _ANY or w == word})
            if self.accept in now:
                return True
            if not now:
                return False
        return False


def compile_template(markup: str) -> Automaton:
    step, free = [[]], [[]]

    def state() -> int:
        step.append([])
        free.append([])
        return len(step) - 1

    at, opened, lead, leading = 0, [], [], True
    for i, part in enumerate(_MARK.split(markup)):
        if i % 2 == 0:
            for word in part.encode().translate(_WORD_BYTES).split():
                to = state()
                step[at].append((word, to))
                at = to
                if leading:
                    lead.append(word)
            continue
        leading = leading and not lead
        if part == "beginOptional":
            opened.append(at)
        elif part == "endOptional":
            free[opened.pop()].append(at)
        else:
            lo, hi = map(int, re.search(r"words=(\d+)-(\d+)", part).groups())
            waits = []
            for n in range(hi):
                if n >= lo:
                    waits.append(at)
                to = state()
                step[at].append((_ANY, to))
                at = to
            for s in waits:
                free[s].append(at)
    if len(lead) < 2 or opened:
        raise ValueError("a template begins with two mandatory words and closes its regions")
    return Automaton(b" " + b" ".join(lead) + b" ", tuple(map(tuple, step)), tuple(map(tuple, free)), at)


def _starts(joined: bytes, phrase: bytes) -> list[int]:
    """Word numbers at which ``phrase`` (with its spaces) stands in `` word word ``."""
    out, at, seen, n = [], joined.find(phrase), 0, 0
    while at >= 0:
        n += joined.count(b" ", seen, at)
        seen = at
        out.append(n)
        at = joined.find(phrase, at + 1)
    return out


class Scanner:
    def __init__(self, phrases: dict[str, str], templates: dict[str, str]):
        self.phrases = [(b" " + p.encode() + b" ", label) for p, label in phrases.items()]
        self.templates = [(label, compile_template(m)) for label, m in templates.items()]

    def __call__(self, text: str) -> tuple:
        words = text.encode("utf-8").translate(_WORD_BYTES).split()
        joined = b" " + b" ".join(words) + b" "
        places, base, matched = [], set(), set()
        for phrase, label in self.phrases:
            if phrase in joined:
                places += _starts(joined, phrase)
                base.add(label)
        for label, automaton in self.templates:
            if automaton.start in joined and any(
                    automaton.accepts(iter(words[s:])) for s in _starts(joined, automaton.start)):
                matched.add(label)
        score = 1.0 - 1.0 / (1.0 + len(places) + 3.0 * len(matched))
        return (len(words), len(places), min(places, default=None), max(places, default=None),
                ",".join(sorted(base)), ",".join(sorted(base | matched)), score)


def scan_licenses(docs: DataFrame, phrases: dict[str, str] | None = None,
                  templates: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score), one
    row per document row, over the whole text.

    score is 1 - 1 / (1 + phrase places + 3 * accepted templates).  Null and empty texts
    have no words, no labels (empty strings) and score 0; repeated rows each keep their
    row; only ``doc_id`` and ``text`` are read; an empty table gives none."""
    phrases, templates = PHRASES if phrases is None else phrases, TEMPLATES if templates is None else templates
    kinds = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
             ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scanner(phrases, templates)
        for b in batches:
            rows = [scan(t) for t in texts(b.column(1))]
            columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, t) for c, (_, t) in zip(columns, kinds, strict=True))],
                names=["doc_id", *(n for n, _ in kinds)])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
             "labels string, score double")
