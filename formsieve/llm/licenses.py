"""Short license notices, exact and with a bounded number of errors.

A notice that may have k errors is split into k + 1 pieces. Any occurrence with at most k edits holds one piece unchanged
(pigeonhole), so one pass with an automaton over all pieces finds every place to look at; there the regex library's
bounded-error matching decides, and gives the edits and the span.
"""
from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PIECE, batches, texts, word_pieces

#: Phrases that count as places when their words stand consecutively.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Notices searched with errors, words in lower case, and the label of each.
NOTICES = {
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "licensed under the apache license version 2 0": "apache",
    "apache license": "apache",
    "licensed under cc by": "cc-by",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "released under the mit license": "mit",
    "mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "bsd 3 clause license": "bsd",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "isc license": "isc",
    "boost software license": "bsl",
    "free and unencumbered software": "unlicense",
    "all rights reserved": "reserved",
}
#: Characters per error, and the most errors of any notice.
PER_ERROR, MOST = 10, 3
#: ASCII that is no letter or digit ends a word, A-Z become a-z; all other bytes belong to words.
WORDS = bytes(ord(chr(i).lower()) if i < 128 and chr(i).isalnum() else 32 if i < 128 else i for i in range(256))


def errors_of(notice: str) -> int:
    return min(MOST, len(notice) // PER_ERROR)


def pieces_of(notice: str, errors: int) -> list[tuple[int, str]]:
    """(offset, piece): `errors` + 1 pieces of nearly equal length."""
    n, k = len(notice), errors + 1
    cuts = [n * i // k for i in range(k + 1)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


def _between(line: str, low: int, high: int, start: bool) -> list[int]:
    """Places from `low` to `high` where a word of the line starts, or ends."""
    edge = -1 if start else 0
    return [i for i in range(max(low, 0), min(high, len(line)) + 1) if not 0 <= i + edge < len(line) or line[i + edge] == " "]


class Searcher:
    """All notices of a table, prepared once per task."""

    def __init__(self, notices: dict[str, str], base: dict[str, str]) -> None:
        self.base = [(f" {p} ".encode(), label, p.count(" ") + 1) for p, label in base.items()]
        self.notices = [(n, label, errors_of(n), regex.compile(rf"(?b)(?:{n}){{e<={errors_of(n)}}}")) for n, label in notices.items()]
        self.reach = max([n.count(" ") + 1 + errors_of(n) for n in (*notices, *base)], default=1)
        self.automaton, found = ahocorasick.Automaton(), {}
        for number, (notice, _, errors, _) in enumerate(self.notices):
            for offset, piece in pieces_of(notice, errors):
                found.setdefault(piece, []).append((number, offset))
        for piece, where in found.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def fuzzy(self, line: str) -> Iterator[tuple[int, int, int, int]]:
        """(notice number, first and last character, edits) of every verified occurrence in words joined by blanks."""
        last: dict[int, int] = {}
        for end, (size, where) in self.automaton.iter(line):
            for number, offset in where:
                notice, _, errors, pattern = self.notices[number]
                if end - size + 1 < last.get(number, 0):
                    continue  # a piece of an occurrence that is known
                exact = end - size + 1 - offset
                stop = exact + len(notice)
                if exact >= 0 and line.startswith(notice, exact) and (exact == 0 or line[exact - 1] == " ") and line[stop:stop + 1] in ("", " "):
                    last[number] = stop
                    yield number, exact, stop, 0
                    continue
                best = None
                for begin in _between(line, end - size + 1 - offset - errors, end - size + 1 - offset + errors, start=True):
                    for stop in _between(line, begin + len(notice) - errors, begin + len(notice) + errors, start=False):
                        if (hit := pattern.fullmatch(line, begin, stop)) and (best is None or sum(hit.fuzzy_counts) < best[2]):
                            best = begin, stop, sum(hit.fuzzy_counts)
                if best:
                    last[number] = best[1]
                    yield number, *best

    def scan(self, text: bytes | None, size: int = PIECE) -> tuple:
        """(words, base places, first and last base word, base labels, labels, score, spans) of a whole text."""
        n_words, n_base, first, last, base_labels, labels, score, spans = 0, 0, None, None, set(), set(), 0.0, []
        tail: list[bytes] = []
        for new in word_pieces((text or b"").translate(WORDS), size):
            words = tail + new
            line, at = b" ".join(words), n_words - len(tail)
            n_words += len(new)
            framed = b" " + line + b" "
            blanks = np.flatnonzero(np.frombuffer(framed, np.uint8) == 32)
            for phrase, label, length in self.base:
                place = framed.find(phrase)
                while place >= 0:
                    word = int(np.searchsorted(blanks, place))
                    if word + length > len(tail):
                        n_base += 1
                        first = at + word if first is None else min(first, at + word)
                        last = at + word if last is None else max(last, at + word)
                        base_labels.add(label)
                        spans.append((label, at + word, at + word + length - 1, 0))
                    place = framed.find(phrase, place + 1)
            plain = line.decode()
            signs = np.flatnonzero(np.frombuffer(plain.encode("utf-32-le"), np.uint32) == 32)
            for number, begin, end, edits in self.fuzzy(plain):
                start, stop = int(np.searchsorted(signs, begin)), int(np.searchsorted(signs, end))
                if stop >= len(tail):
                    notice, label = self.notices[number][:2]
                    labels.add(label)
                    score = max(score, 1 - edits / len(notice))
                    spans.append((label, at + start, at + stop, edits))
            tail = words[-self.reach:]
        if base_labels:
            score = 1.0
        return n_words, n_base, first, last, ",".join(sorted(base_labels)), ",".join(sorted(labels | base_labels)), score, sorted(set(spans), key=lambda s: (s[1], s[2], s[0]))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", notices: dict[str, str] | None = None, base: dict[str, str] | None = None) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) for every row.

    A null text is an empty one. Without a place `first_word` and `last_word` are null, without a label the lists are empty
    and the score is 0; it is 1 for an unchanged notice and falls by the edited share of its characters. Spans are words.
    Repeated rows give repeated results and a null id stays null; no rows give none; other columns are ignored, whatever
    their names. Work grows in proportion to the text, also where a notice stands thousands of times.
    """
    notices, base = NOTICES if notices is None else notices, BASE if base is None else base
    span = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int32())])
    schema = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                        ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(span))])
    made: list[Searcher] = []

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not made:
            made.append(Searcher(notices, base))
        rows = [made[0].scan(t) for t in texts(batch.column(1))]
        columns = [*zip(*rows)]
        spans = [[dict(zip(("label", "first_word", "last_word", "edits"), s)) for s in row] for row in columns[-1]]
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64())] + [pa.array(c, t) for c, t in zip([*columns[:-1], spans], schema.types[1:])], schema=schema)

    kinds = ("id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
             "spans array<struct<label:string,first_word:long,last_word:long,edits:int>>")
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")).mapInArrow(batches(work), kinds)
