"""Short licence notices in documents, exact phrases and notices with a few edits."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlens.llm import batches

EDIT_EVERY = 12


@dataclass(frozen=True)
class Notice:
    """Words in lower case with one space between, and the licence they stand for."""

    words: str
    label: str


# the phrases that count as they are; fixed values
PHRASES = (
    Notice("mit license", "mit"),
    Notice("apache license", "apache"),
    Notice("general public license", "gpl"),
)

# opening or naming lines of common licences, as their texts have them; fixed values
NOTICES = (
    Notice("released under the mit license", "mit"),
    Notice("licensed under the mit license", "mit"),
    Notice("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    Notice("licensed under the apache license version 2 0", "apache"),
    Notice("you may not use this file except in compliance with the license", "apache"),
    Notice("licensed under the gnu general public license", "gpl"),
    Notice("released under the gnu general public license", "gpl"),
    Notice("this program is free software you can redistribute it and or modify", "gpl"),
    Notice("gnu lesser general public license", "lgpl"),
    Notice("gnu affero general public license", "agpl"),
    Notice("redistribution and use in source and binary forms", "bsd"),
    Notice("released under the bsd license", "bsd"),
    Notice("licensed under the bsd license", "bsd"),
    Notice("subject to the terms of the mozilla public license", "mpl"),
    Notice("permission to use copy modify and or distribute this software for any purpose", "isc"),
    Notice("this is free and unencumbered software released into the public domain", "unlicense"),
    Notice("licensed under cc by 4 0", "cc-by"),
    Notice("licensed under cc by sa 4 0", "cc-by-sa"),
    Notice("licensed under cc by nc 4 0", "cc-by-nc"),
    Notice("licensed under cc by nd 4 0", "cc-by-nd"),
    Notice("licensed under cc by nc sa 4 0", "cc-by-nc-sa"),
    Notice("licensed under cc by nc nd 4 0", "cc-by-nc-nd"),
    Notice("creative commons attribution 4 0 international license", "cc-by"),
    Notice("creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    Notice("creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
)

# other ASCII characters than letters and digits end a word
_FOLDED = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_IN_WORD = np.array([c != 32 for c in _FOLDED[:128]])


def edits_of(notice: Notice) -> int:
    """How many characters of a notice may be missing, added or wrong."""
    return len(notice.words) // EDIT_EVERY


def seeds(notice: Notice) -> list[tuple[int, str]]:
    """The notice cut into one piece more than it may have edits, each with its place.

    An edit spoils one piece at most, so a copy with that many edits holds a piece as it is.
    """
    n = edits_of(notice) + 1
    cuts = [len(notice.words) * i // n for i in range(n + 1)]
    return [(a, notice.words[a:b]) for a, b in zip(cuts, cuts[1:])]


@dataclass(frozen=True)
class Hit:
    """A span of the text in single-spaced words; ``kind`` is ``phrase`` or ``notice``."""

    kind: str
    label: str
    start: int
    end: int
    edits: int
    likeness: float


class Scanner:
    """Finds phrases and notices in texts of single-spaced words."""

    def __init__(self, phrases: Sequence[Notice], notices: Sequence[Notice]):
        self.phrases, self.notices = phrases, notices
        found: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for number, phrase in enumerate(phrases):
            found[f" {phrase.words} "].append((-1, number))
        for number, notice in enumerate(notices):
            for place, seed in seeds(notice):
                found[seed].append((place, number))
        self.automaton = ahocorasick.Automaton()
        for text, uses in found.items():
            self.automaton.add_word(text, (len(text), uses))
        if found:
            self.automaton.make_automaton()
        self.patterns = [regex.compile(f"(?b)(?:{regex.escape(n.words)}){{e<={edits_of(n)}}}") for n in notices]

    def candidates(self, padded: str) -> list[Hit]:
        """All phrases, and every notice around each of its seeds; ``padded`` has a space at either end."""
        hits, around = [], defaultdict(list)
        for last, (size, uses) in self.automaton.iter(padded) if len(self.automaton) else ():
            at = last + 1 - size
            for place, number in uses:
                if place < 0:
                    hits.append(Hit("phrase", self.phrases[number].label, at, at + size - 2, 0, 1.0))
                else:
                    around[number].append((at, place))
        text = padded[1:-1]
        for number, found in around.items():
            notice, room, done = self.notices[number], edits_of(self.notices[number]), 0
            for at, place in found:
                begin = at - 1 - place  # where the notice would begin without any edit
                if begin + place < done:
                    continue
                low, high = max(done, begin - room), begin + len(notice.words) + room
                match = self.patterns[number].search(text, low, max(low, min(high, len(text))))
                if match:
                    done, edits = match.end(), sum(match.fuzzy_counts)
                    hits.append(Hit("notice", notice.label, match.start(), done, edits, 1 - edits / len(notice.words)))
        return hits

    def scan(self, padded: str) -> list[Hit]:
        """All phrases, and of notices that overlap the likest (then the longest, the first, by label)."""
        hits = self.candidates(padded)
        kept = [h for h in hits if h.kind == "phrase"]
        rivals = sorted((h for h in hits if h.kind == "notice"), key=lambda h: (h.start, h.end))
        for cluster in _clusters(rivals):
            taken: list[Hit] = []
            for hit in sorted(cluster, key=lambda h: (-h.likeness, h.start - h.end, h.start, h.label)):
                if all(hit.end <= t.start or t.end <= hit.start for t in taken):
                    taken.append(hit)
            kept.extend(taken)
        return sorted(kept, key=lambda h: (h.start, h.end, h.kind, h.label))


def _clusters(rivals: list[Hit]) -> Iterator[list[Hit]]:
    """Hits in the order of their start, cut where nothing reaches over."""
    cluster, reach = [], 0
    for hit in rivals:
        if cluster and hit.start >= reach:
            yield cluster
            cluster = []
        cluster.append(hit)
        reach = max(reach, hit.end)
    if cluster:
        yield cluster


def folded(text: bytes) -> tuple[str, int]:
    """The words of a UTF-8 text in lower case with a space between and at both ends, and their number."""
    words = text.translate(_FOLDED).split()
    return f" {b' '.join(words).decode()} ", len(words)


class Places:
    """Where places of the single-spaced words lie in the text, and in which word."""

    def __init__(self, text: bytes):
        codes = np.frombuffer(text.decode().encode("utf-32-le"), np.uint32)
        inside = (codes >= 128) | _IN_WORD[np.minimum(codes, 127)]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
        self.starts = edges[0::2]
        self.spaced = np.concatenate([[0], np.cumsum(edges[1::2] - self.starts + 1)[:-1]])

    def word(self, place: int) -> int:
        return int(np.searchsorted(self.spaced, place, side="right")) - 1

    def original(self, place: int) -> int:
        word = self.word(place)
        return int(self.starts[word] + place - self.spaced[word])


_SPAN = pa.struct(
    [
        ("kind", pa.string()),
        ("label", pa.string()),
        ("word", pa.int64()),
        ("start", pa.int64()),
        ("end", pa.int64()),
        ("edits", pa.int32()),
        ("likeness", pa.float64()),
    ]
)


def _scanned(phrases: Sequence[Notice], notices: Sequence[Notice]):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, notices)
        for piece in batches.pieces(stream, "text"):
            counts, spans = [], []
            for text in batches.encoded(piece.column("text")):
                padded, n = folded(text)
                hits = scanner.scan(padded) if n else []
                places = Places(text) if hits else None
                counts.append(n)
                spans.append(
                    [
                        (h.kind, h.label, places.word(h.start), places.original(h.start), places.original(h.end - 1) + 1, h.edits, h.likeness)
                        for h in hits
                    ]
                )
            found = [[dict(zip((f.name for f in _SPAN), s)) for s in row] for row in spans]
            yield pa.RecordBatch.from_arrays(
                [piece.column("_id"), pa.array(counts, pa.int64()), pa.array(found, pa.list_(_SPAN))], names=["_id", "n_words", "spans"]
            )

    return run


def find_notices(
    df: DataFrame,
    phrases: Sequence[Notice] = PHRASES,
    notices: Sequence[Notice] = NOTICES,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``id, n_words, spans`` of every row: where the text names a licence.

    Texts are read as words, runs of ASCII letters (A-Z as a-z), digits and characters
    beyond ASCII. A phrase counts wherever its words stand in a row. A notice counts
    where the words, one space between, differ from it by at most one character in
    ``EDIT_EVERY``: the notice is cut into one piece more than it may have edits, one
    pass of an Aho-Corasick automaton finds all pieces, and the best match with bounded
    errors (``regex``) is looked for around each. Of notices that overlap, the likest
    stays. A span has its kind, label, first word (from 0), code points in the text (end
    exclusive), edits and likeness, 1 less the edits by the notice's length.

    The work for a text grows with its length and its pieces; texts are taken whole and
    one by one, so a very long one needs memory for itself alone. Null and empty texts
    have no words. Repeated rows and rows without an id are scanned each; an empty table
    gives an empty result. Other columns are not read.
    """
    rows = df.select(F.col(id).alias("_id"), F.col(text).alias("text"))
    span = "struct<kind:string,label:string,word:bigint,start:bigint,end:bigint,edits:int,likeness:double>"
    kind = dict(rows.dtypes)["_id"]
    found = rows.mapInArrow(_scanned(phrases, notices), f"_id {kind}, n_words bigint, spans array<{span}>")
    return found.withColumnRenamed("_id", id)
