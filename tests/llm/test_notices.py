"""Licence notices against plain searches: phrases word by word, notices by full edit tables."""

import random
import re

import pytest

from hazardlens.llm import notices
from hazardlens.llm.notices import NOTICES, PHRASES, Notice, Scanner, edits_of, folded, seeds
from hazardlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def phrase_places(words):
    return [
        (i, p.label) for i in range(len(words)) for p in PHRASES if words[i : i + len(p.words.split())] == p.words.split()
    ]


def least_edits(notice, text):
    """The fewest edits between the notice and any part of the text."""
    row = list(range(len(notice) + 1))
    best = row[-1]
    for c in text:
        above, row[0] = row[0], 0
        for i, x in enumerate(notice, 1):
            above, row[i] = row[i], min(above + (x != c), row[i] + 1, row[i - 1] + 1)
        best = min(best, row[-1])
    return best


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            above, row[j] = row[j], min(above + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def spoiled(rng, text, n):
    out = list(text)
    for _ in range(n):
        at = rng.randrange(len(out))
        what = rng.randrange(3)
        if what == 0:
            out[at] = rng.choice("abcdefgh ")
        elif what == 1:
            del out[at]
        else:
            out.insert(at, rng.choice("abcdefghé"))
    return "".join(out)


@pytest.mark.parametrize("seed", range(4))
def test_candidates_are_those_of_the_edit_table(seed):
    rng = random.Random(seed)
    scanner = Scanner(PHRASES, NOTICES)
    for _ in range(40):
        notice = rng.choice(NOTICES)
        filler = [" ".join(rng.choice(["the", "license", "under", "licensed", "é", "x"]) for _ in range(rng.randrange(8))) for _ in range(2)]
        text = f"{filler[0]} {spoiled(rng, notice.words, rng.randrange(edits_of(notice) + 3))} {filler[1]}"
        padded, _ = folded(text.encode())
        plain = padded[1:-1]
        found = {}
        for hit in scanner.candidates(padded):
            if hit.kind == "notice":
                found.setdefault(hit.label, []).append(hit)
        want = {n.label for n in NOTICES if least_edits(n.words, plain) <= edits_of(n)}
        assert set(found) == want, text
        for hits in found.values():
            for h in hits:
                near = min((distance(plain[h.start : h.end], n.words), n.words) for n in NOTICES if n.label == h.label)
                assert near[0] <= h.edits <= max(map(edits_of, NOTICES))


def test_query_equals_plain_search(spark):
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op12_license_notices"](spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(rows)
    for r in got:
        words = words_of(rows[r["doc_id"]])
        places = phrase_places(words)
        starts = [p for p, _ in places] or [None]
        labels = ",".join(sorted({label for _, label in places}))
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (len(words), len(places), labels)
        assert (r["first_word"], r["last_word"]) == (min(starts), max(starts))
        text = " ".join(words)
        near = {n.label for n in NOTICES if any(s in text for _, s in seeds(n)) and least_edits(n.words, text) <= edits_of(n)}
        assert set(labels.split(",")) <= set(r["labels"].split(",")) | {""} <= near | set(labels.split(",")) | {""}
        assert (r["labels"] == "") == (not near and not labels) and (r["score"] > 0) == bool(r["labels"])


def test_spans_lie_in_the_text(spark):
    text = "É x — Licensed  under THE\nApache-License, Version 2.0! Then Relesed under the MIT Licence. cc"
    (row,) = notices.find_notices(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    got = [(s["kind"], s["label"], s["word"], text[s["start"] : s["end"]], s["edits"]) for s in row["spans"]]
    assert got == [
        ("notice", "apache", 3, "Licensed  under THE\nApache-License, Version 2.0", 0),
        ("phrase", "apache", 6, "Apache-License", 0),
        ("notice", "mit", 12, "Relesed under the MIT Licence", 2),
    ]


def test_the_likest_of_overlapping_notices_stays():
    scanner = Scanner(PHRASES, NOTICES)
    for variant in ("cc by", "cc by nc", "cc by nd", "cc by sa", "cc by nc sa"):
        hits = scanner.scan(f" x licensed under {variant} 4 0 y ")
        assert [(h.label, h.edits) for h in hits] == [(variant.replace(" ", "-"), 0)]


def test_odd_rows(spark):
    many = "released under the mit license " * 3000
    wrong = "released under the mjt license " * 3000
    rows = [(1, None), (2, ""), (3, " .,; "), (None, "MIT License"), (5, many), (6, wrong), (6, wrong), (7, "a" * 3_000_000), (8, "license " * 50000)]
    df = spark.createDataFrame([(i, t, 1, "z", 2) for i, t in rows], "doc_id long, text string, n_words int, spans string, _id int")
    got = notices.find_notices(df).collect()
    shown = sorted((str(r["doc_id"]), r["n_words"], len(r["spans"])) for r in got)
    assert shown == sorted(
        [("1", 0, 0), ("2", 0, 0), ("3", 0, 0), ("None", 2, 1), ("5", 15000, 6000), ("6", 15000, 3000), ("6", 15000, 3000), ("7", 1, 0), ("8", 50000, 0)]
    )
    assert notices.find_notices(df.limit(0)).collect() == []
    assert notices.find_notices(df, phrases=(), notices=()).where("size(spans) > 0").count() == 0


def test_own_notices(spark):
    df = spark.createDataFrame([("a", "This file is in the publik domain, as is.")], "key string, body string")
    own = (Notice("this file is in the public domain", "public"),)
    (row,) = notices.find_notices(df, phrases=(), notices=own, id="key", text="body").collect()
    assert row["key"] == "a" and [(s["label"], s["edits"]) for s in row["spans"]] == [("public", 1)]
