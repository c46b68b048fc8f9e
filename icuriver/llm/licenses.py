"""License scans: phrases, and templates with optional and replaceable regions as token automata."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuriver.llm.common import SLICE_BYTES, SpanHash, prepare, returning, slices, text_bytes

# Phrases and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: Notices as templates. ``<<optional>> ... <<end>>`` may be missing; ``<<words a b>>`` stands for a to b
#: words of any kind and ``<<numbers a b>>`` for a to b words of digits. All other wording is mandatory.
TEMPLATES = {
    "apache-2.0": ["licensed under the apache license <<optional>>version<<end>> 2 <<optional>>0<<end>>"],
    "mit": [
        "released under <<optional>>the terms of<<end>> the mit license",
        "licensed under <<optional>>the terms of<<end>> the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software <<words 0 6>> to deal in the software without restriction",
    ],
    "gpl-notice": [
        "licensed under <<optional>>the terms of<<end>> the gnu general public license <<optional>>as published by the free software foundation<<end>> <<optional>>version <<numbers 1 2>><<end>>",
        "redistribute it and or modify it under the terms of the gnu <<words 0 1>> general public license",
    ],
    "creative-commons": [
        "licensed under <<optional>>a<<end>> cc by <<words 0 2>> <<numbers 1 2>>",
        "licensed under <<optional>>a<<end>> creative commons attribution <<words 0 3>> <<numbers 1 2>> <<optional>>international<<end>> <<optional>>license<<end>>",
    ],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "copyright": ["copyright <<optional>>c<<end>> <<numbers 1 4>> <<words 0 8>> all rights reserved"],
}

_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words(text: str) -> list[str]:
    """Words of a text after lower-casing A to Z."""
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


class TemplateAutomaton:
    """A template as a set-of-states automaton over words.

    A state is a place in the template. ``steps[s]`` holds (word or None for any, digits only, next) and
    ``free[s]`` the places reached without a word.
    """

    def __init__(self, markup: str):
        self.steps: list[list[tuple[str | None, bool, int]]] = [[]]
        self.free: list[list[int]] = [[]]
        at, open_from = 0, []
        for sign, word in re.findall(r"<<([^<>]*)>>|([^\s<>]+)", markup):
            if word:
                at = self._step(at, word, False)
            elif sign == "optional":
                open_from.append(at)
            elif sign == "end":
                self.free[open_from.pop()].append(at)
            else:
                kind, low, high = sign.split()
                for k in range(int(high)):
                    after = self._step(at, None, kind == "numbers")
                    if k >= int(low):
                        self.free[at].append(after)
                    at = after
        if open_from:
            raise ValueError("an optional region has no end")
        self.last = at
        self.starts = self._reach({0})
        self.heads = {w for s in self.starts for w, _, _ in self.steps[s]}
        if None in self.heads or self.last in self.starts:
            raise ValueError("a template begins with mandatory wording")

    def _step(self, at: int, word: str | None, digits: bool) -> int:
        self.steps.append([])
        self.free.append([])
        self.steps[at].append((word, digits, len(self.steps) - 1))
        return len(self.steps) - 1

    def _reach(self, states: set[int]) -> set[int]:
        todo, found = list(states), set(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in found:
                    found.add(s)
                    todo.append(s)
        return found

    def longest(self, ids: np.ndarray, digits: np.ndarray, start: int, end: int, number: Mapping[str, int]) -> int:
        """End of the longest accepted stretch from ``start``, or -1. Words are given by number, 0 for others."""
        states, found = self.starts, -1
        for k in range(start, end):
            word, numeric = ids[k], digits[k]
            states = {n for s in states for w, d, n in self.steps[s] if (w is None or number[w] == word) and (numeric or not d)}
            if not states:
                break
            states = self._reach(states)
            if self.last in states:
                found = k + 1
        return found


class Scanner:
    def __init__(self, phrases: Mapping[str, str], templates: Mapping[str, list[str]]):
        self.phrases = [(p.split(), label) for p, label in phrases.items()]
        self.automata = [(TemplateAutomaton(m), label) for label, many in templates.items() for m in many]
        vocabulary = {w for p, _ in self.phrases for w in p} | {w for a, _ in self.automata for s in a.steps for w, _, _ in s if w}
        listed = sorted(vocabulary)
        raw = np.frombuffer("".join(listed).encode(), np.uint8)
        ends = np.cumsum([len(w.encode()) for w in listed])
        hashes = SpanHash(raw).of(np.concatenate(([0], ends[:-1])), ends)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.number = {listed[k]: i + 1 for i, k in enumerate(order)}

    def scan(self, data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, list[list[tuple[str, int, int, bool]]], np.ndarray]:
        """For each text: number of words; (label, first word, last word, by a template); words covered by any."""
        low = _LOWER[data]
        inside = np.concatenate(([False], _IN_WORD[low], [False]))
        edge = np.zeros(len(data) + 1, bool)
        edge[borders] = True
        start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
        end = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
        among = np.searchsorted(start, borders)
        n = np.diff(among)
        hashes = SpanHash(low).of(start, end)
        spot = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        ids = np.where(self.hashes[spot] == hashes, spot + 1, 0)
        spans: list[list[tuple[str, int, int, bool]]] = [[] for _ in n]
        for phrase, label in self.phrases:
            here = np.ones(max(0, len(ids) - len(phrase) + 1), bool)
            for k, w in enumerate(phrase):
                here &= ids[k : k + len(here)] == self.number[w]
            for at in np.flatnonzero(here).tolist():
                doc = int(np.searchsorted(among, at, "right")) - 1
                if at + len(phrase) <= among[doc + 1]:
                    spans[doc].append((label, at - int(among[doc]), at - int(among[doc]) + len(phrase) - 1, False))
        numeric = np.concatenate(([0], np.cumsum((data >= 48) & (data <= 57))))
        for automaton, label in self.automata:
            heads = [self.number[w] for w in automaton.heads]
            at_heads = np.flatnonzero(np.isin(ids, heads))
            digits_of = {}
            for at in at_heads.tolist():
                doc = int(np.searchsorted(among, at, "right")) - 1
                if doc not in digits_of:
                    s, e = start[among[doc] : among[doc + 1]], end[among[doc] : among[doc + 1]]
                    digits_of = {doc: numeric[e] - numeric[s] == e - s}
                base = int(among[doc])
                stop = automaton.longest(ids[base : among[doc + 1]], digits_of[doc], at - base, int(n[doc]), self.number)
                if stop >= 0:
                    spans[doc].append((label, at - base, stop - 1, True))
        covered = np.zeros(len(n), np.int64)
        for doc, found in enumerate(spans):
            upto = -1
            found.sort(key=lambda x: (x[1], x[2], x[0]))
            for _, a, b, _ in found:
                covered[doc] += max(0, b - max(a, upto + 1) + 1)
                upto = max(upto, b)
        return n, spans, covered


def scan_licenses(
    docs: DataFrame,
    phrases: Mapping[str, str] = PHRASES,
    templates: Mapping[str, list[str]] = TEMPLATES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(id, n_words, spans, score) of every whole text.

    Words are runs of digits, letters and non-ASCII signs after lower-casing A to Z. spans are (label,
    first, last, template), words counted from 0: every place of a phrase, and for every template and
    place where its wording begins the longest stretch that it accepts. score is the share of the
    text's words inside a span, 0 without words. A null text counts as empty. Rows are independent, so
    null or repeated ids and other columns change nothing.
    """
    prepare(docs.sparkSession)
    phrases, templates = dict(phrases), {k: list(v) for k, v in templates.items()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, templates)
        kind = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("template", pa.bool_())]))
        for batch in batches:
            data, borders = text_bytes(batch.column(1))
            counts, lists, scores = [], [], []
            for a, b in slices(borders, SLICE_BYTES):
                n, spans, covered = scanner.scan(data[borders[a] : borders[b]], borders[a : b + 1] - borders[a])
                counts.append(n)
                lists += [[dict(zip(("label", "first", "last", "template"), s, strict=True)) for s in x] for x in spans]
                scores.append(covered / np.maximum(n, 1))
            columns = [batch.column(0), pa.array(np.concatenate(counts or [[]]), pa.int64()), pa.array(lists, kind), pa.array(np.concatenate(scores or [[]]), pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [id_column, "n_words", "spans", "score"])

    kind = docs.select(id_column).schema[0].dataType.simpleString()
    schema = f"`{id_column}` {kind}, n_words long, spans array<struct<label:string,first:long,last:long,template:boolean>>, score double"
    return docs.select(F.col(id_column), F.col(text_column).cast("string")).mapInArrow(returning(work), schema)
