"""Line rules against plain Python."""

import random
import re

from hazardlens.llm import line_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    inside = {i + j for places in windows.values() if len(places) > 1 for i in places for j in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(inside),
        len(words) < 20 or 100 * len(inside) > 30 * len(words),
    )


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def run(spark, texts):
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, n_words int")
    return {r["doc_id"]: r for r in line_rules.clean_lines(df).collect()}


def test_counts_equal_brute_force(spark):
    rng = random.Random(2)
    texts = [None, "", " \n\t ", "a", "é" * 5, "a\u00a0b \x0b c\r\nd", "x " * 3000, "tail \U0001f600 | < > #"]
    for _ in range(60):
        block = " ".join(rng.choice("ab") for _ in range(rng.randint(1, 14)))
        texts.append("\n".join(rng.choice([block, block + ".", "q w e r t", "", "ab #"]) for _ in range(rng.randint(1, 12))))
    got = run(spark, texts)
    assert [tuple(got[i][n] for n in NAMES) for i in range(len(texts))] == [brute(t) for t in texts]


def test_lines_go_first_then_texts(spark):
    good = "\n".join(f"This {w}1 line {w}2 says {w}3 things {w}4 quite its own." for w in "abcdefgh")
    menu = "Home | News | Sport | About | Contact us and many other things to see"
    got = run(spark, [good, f"{good}\n{menu}\nAll rights reserved to the owner.\nMore", "\n".join(" | ".join(f"{x}{i}" for i in range(9)) for x in "abcdefg") + "\n" + good[:60]])
    assert got[0]["kept"] and got[0]["clean_text"] == good and got[0]["lost_chars"] == 0
    assert got[1]["kept"] and got[1]["clean_text"] == good and got[1]["n_lines_removed"] == 3
    assert not got[2]["kept"] and not got[2]["base_failed"]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert line_rules.clean_lines(df).count() == 0
