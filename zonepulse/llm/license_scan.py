"""Short licence notices in texts, allowing a few errors.

Texts become lower-case words with one space between. A notice that may hold ``errors`` errors is cut into one part more than that,
so an occurrence holds at least one part unchanged (the pigeonhole principle); a notice with a fixed beginning has that as
its part. Exact search for the parts gives candidates. A candidate that equals the notice word by word is a place without
errors; the others go to the regex library, whose bounded-error match counts the edits and gives the span.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from zonepulse.llm.arrays import slices, small_batches, utf8


@dataclass(frozen=True)
class Notice:
    """``fixed`` must stand unchanged, before ``loose`` with at most ``errors`` insertions, deletions or substitutions."""

    label: str
    fixed: str
    loose: str
    errors: int
    base: bool = False

    @property
    def phrase(self) -> str:
        return self.fixed + self.loose

    def parts(self) -> list[tuple[int, str]]:
        """Offsets and texts of which an occurrence holds one unchanged."""
        if self.fixed:
            return [(0, self.fixed)]
        n, k = len(self.loose), self.errors + 1
        at = [n * i // k for i in range(k + 1)]
        return [(s, self.loose[s:e]) for s, e in zip(at[:-1], at[1:], strict=True)]


#: Base phrases with their labels, then further short notices. Words of three letters take no errors in short ones.
NOTICES = (
    Notice("gpl", "gnu ", "general public license", 2, True),
    Notice("apache", "", "apache license", 1, True),
    Notice("cc-by", "cc by", "", 0, True),
    Notice("mit", "mit ", "license", 1, True),
    Notice("agpl", "gnu ", "affero general public license", 2),
    Notice("lgpl", "gnu ", "lesser general public license", 2),
    Notice("mpl", "", "mozilla public license", 2),
    Notice("epl", "", "eclipse public license", 2),
    Notice("bsd", "bsd ", "license", 1),
    Notice("isc", "isc ", "license", 1),
    Notice("cc-by", "", "creative commons attribution", 2),
    Notice("apache", "", "licensed under the apache license version 2 0", 4),
    Notice("mit", "", "permission is hereby granted free of charge to any person obtaining a copy", 6),
    Notice("bsd", "", "redistribution and use in source and binary forms with or without modification", 6),
    Notice("unlicense", "", "this is free and unencumbered software released into the public domain", 6),
)

GAP, END = 0x20, 0x0A


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Bytes of words are digits, letters and all beyond ASCII; the fold lower-cases A to Z."""
    word = np.zeros(256, bool)
    word[48:58] = word[65:91] = word[97:123] = word[128:] = True
    fold = np.arange(256, dtype=np.uint8)
    fold[65:91] += 32
    return word, fold


WORD, FOLD = _tables()


class Words:
    """The words of some texts: each text's words with one space after each that more follows, then a line end."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        ends = offsets[1:]
        marked = np.insert(FOLD[data], ends, END)
        ends = ends + np.arange(len(ends))
        word = WORD[marked]
        word[ends] = False
        marked[~word] = GAP
        marked[ends] = END
        keep = word.copy()
        keep[1:] |= word[:-1]
        keep[ends] = True
        flat = marked[keep]
        self.raw = flat.tobytes()
        self.ends = np.flatnonzero(flat == END)
        self.begins = np.append(0, self.ends[:-1] + 1)[: len(self.ends)]
        inside = flat > GAP
        self.at = np.flatnonzero(inside & np.append(True, ~inside[:-1]))
        self.first = np.searchsorted(self.at, self.begins)
        self.count = np.searchsorted(self.at, self.ends) - self.first

    def row(self, place: int) -> int:
        return int(np.searchsorted(self.ends, place))

    def number(self, row: int, place: int) -> int:
        """How many words of the row begin before a place."""
        return int(np.searchsorted(self.at, place) - self.first[row])

    def free(self, place: int) -> bool:
        """No word stands on both sides of the place."""
        return place <= 0 or place >= len(self.raw) or self.raw[place - 1] <= GAP or self.raw[place] <= GAP


def _compiled(notice: Notice):
    """The notice between word borders, the match with fewest errors first."""
    import regex

    if not notice.loose or not notice.errors:
        return None
    return regex.compile(rf"(?b)(?<![^ ]){regex.escape(notice.fixed, literal_spaces=True)}(?:{regex.escape(notice.loose, literal_spaces=True)}){{e<={notice.errors}}}(?![^ ])")


def find(words: Words, notices: tuple[Notice, ...], patterns: list) -> Iterator[tuple[int, int, int, int, int, str]]:
    """(row, notice, first word, words, edits, text) of every place; a place with errors only where none with fewer overlaps it."""
    raw = words.raw
    for number, (notice, pattern) in enumerate(zip(notices, patterns, strict=True)):
        phrase = notice.phrase.encode()
        exact: set[int] = set()
        loose: set[tuple[int, int]] = set()
        for offset, part in notice.parts():
            sought, at = part.encode(), -1
            while (at := raw.find(sought, at + 1)) >= 0:
                start = at - offset
                if start >= 0 and raw.startswith(phrase, start) and words.free(start) and words.free(start + len(phrase)):
                    exact.add(start)
                elif pattern:
                    loose.add((words.row(at), start))
        spans = [(0, s, s + len(phrase)) for s in exact]
        for row, start in sorted(loose):
            spans.extend(_verified(words, notice, pattern, row, start))
        taken: dict[int, list[tuple[int, int]]] = {}
        for edits, s, e in sorted(set(spans)):
            row = words.row(s)
            held = taken.setdefault(row, [])
            if edits and any(s < y and x < e for x, y in held):
                continue
            held.append((s, e))
            first = words.number(row, s)
            yield row, number, first, words.number(row, e) - first, edits, raw[s:e].decode("utf-8", "replace")


def _verified(words: Words, notice: Notice, pattern, row: int, start: int) -> Iterator[tuple[int, int, int]]:
    """(edits, start, end) of the best match around a candidate, whole words only."""
    raw, k = words.raw, notice.errors
    begin, end = int(words.begins[row]), int(words.ends[row])
    lo, hi = max(begin, start - k), min(end, start + len(notice.phrase.encode()) + k)
    if not words.free(lo):
        lo = max(begin, raw.rfind(b" ", begin, lo) + 1)
    if not words.free(hi):
        after = raw.find(b" ", hi, end)
        hi = after if after >= 0 else end
    found = pattern.search(raw[lo:hi].decode())
    if found:
        text = found.string
        yield sum(found.fuzzy_counts), lo + len(text[: found.start()].encode()), lo + len(text[: found.end()].encode())


SPANS = "array<struct<label:string,phrase:string,base:boolean,first:long,words:long,edits:int,text:string>>"


def license_spans(docs: DataFrame, notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """(doc_id, n_words, spans) of every row of (doc_id, text).

    Words are runs of ASCII digits and letters and of characters beyond ASCII, A-Z lower-cased. Each span has the notice's label and
    phrase, whether it is a base phrase without errors, its first word (from 0), its number of words, the edits, and its
    words. Spans are in order of their first word. A null, empty or wordless text has none. Every row, repeated ones
    and those without doc_id included, is searched whole and by itself; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    kind = to_arrow_type(DataType.fromDDL(SPANS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [_compiled(n) for n in notices]
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                words = Words(*utf8(part, "text"))
                spans: list[list[dict]] = [[] for _ in range(part.num_rows)]
                for row, number, first, n, edits, text in find(words, notices, patterns):
                    notice = notices[number]
                    spans[row].append({"label": notice.label, "phrase": notice.phrase, "base": notice.base and not edits, "first": first, "words": n, "edits": edits, "text": text})
                for found in spans:
                    found.sort(key=lambda x: (x["first"], x["words"], x["phrase"]))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(words.count, pa.int64()), pa.array(spans, kind)], names=["doc_id", "n_words", "spans"])

    bare = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return bare.mapInArrow(run, f"doc_id long, n_words long, spans {SPANS}")


def _joined(spans: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")


def license_labels(docs: DataFrame, notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) of every row, from its spans.

    ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` are about base phrases without errors (nulls and '' where there are none);
    ``labels`` are those of all spans. The score is the greatest share of a found phrase's letters that no edit touched, 0 without a span.
    """
    base = F.filter("spans", lambda s: s["base"])
    firsts = F.transform(base, lambda s: s["first"])
    kept = F.transform("spans", lambda s: F.greatest(F.lit(0.0), 1 - s["edits"] / F.char_length(s["phrase"])))
    return license_spans(docs, notices).select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(firsts).alias("first_word"), F.array_max(firsts).alias("last_word"),
        _joined(base).alias("base_labels"), _joined(F.col("spans")).alias("labels"), F.coalesce(F.array_max(kept), F.lit(0.0)).alias("score"), "spans",
    )
