"""Suffix arrays and removal of repeats against brute force."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hazardlens.llm import suffix_dedup
from hazardlens.llm.suffix_order import suffix_array


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=60))
def test_suffix_array_equals_sorting(symbols):
    whole = [*symbols, 0]
    assert suffix_array(np.array(whole)) == sorted(range(len(whole)), key=lambda i: whole[i:])


@pytest.mark.parametrize("period", [1, 2, 3, 7])
def test_suffix_array_of_periodic_text(period):
    whole = [1 + i % period for i in range(2000)] + [0]
    assert suffix_array(np.array(whole)) == sorted(range(len(whole)), key=lambda i: whole[i:])


def brute(rows, length):
    seen, out = set(), []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - length + 1):
            part = data[at : at + length]
            if part in seen:
                gone[at : at + length] = b"\1" * length
            seen.add(part)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((i, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_bytes int")
    return sorted((tuple(r) for r in suffix_dedup.remove_repeats(df, **options).collect()), key=str)


def texts(seed, n):
    rng = random.Random(seed)
    passage = "".join(rng.choice("abcdef ") for _ in range(260))
    rows = []
    for i in range(n):
        own = "".join(rng.choice("abcdef ") for _ in range(rng.randint(0, 300)))
        a = rng.randint(0, 150)
        cut = passage[a : a + rng.randint(60, 260)]
        if rng.random() < 0.4:
            at = rng.randrange(len(cut))
            cut = cut[:at] + "é" + cut[at + 1 :]
        rows.append((i * 3, own[:150] + cut * rng.randint(0, 2) + own[150:]))
    return rows


EDGES = [(1000, None), (1001, ""), (1002, "x" * 99), (1003, "x" * 100), (1004, "x" * 450), (1005, "ab" * 400), (1006, "ü" * 60)]


@pytest.mark.parametrize("large", [2, 5, 2048])
def test_equal_to_brute_force(spark, large):
    rows = texts(large, 60) + EDGES
    assert run(spark, rows, large=large) == brute(rows, 100)


def test_nulls_and_repeated_ids(spark):
    long = "".join(chr(97 + i * i % 26) for i in range(150)) + "tail of it"
    rows = [(None, long), (5, long), (5, long), (5, long + "b"), (7, "q" + long)]
    assert run(spark, rows) == brute(rows, 100)


def test_blocks_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 130)
    rows = [(i, t) for i, t in texts(9, 20)]
    got = []
    for batch in suffix_dedup._anchored(100, 24)(iter([_batch(rows)])):
        got += list(zip(batch["doc"].to_pylist(), batch["start"].to_pylist(), batch["windows"].to_pylist()))
    windows = {(d, a + i) for d, a, w in got for i in range(w)}
    assert windows >= {(i, a) for i, t in rows for a in range(len(t.encode()) - 99)}


def _batch(rows):
    import pyarrow as pa

    return pa.RecordBatch.from_pydict({"doc": [i for i, _ in rows], "text": [t for _, t in rows]})


def test_empty_table(spark):
    assert run(spark, []) == []


def test_hot_copies(spark):
    text = " ".join(f"word{i}" for i in range(40))
    got = run(spark, [(i, text) for i in range(400)])
    assert sum(r[2] for r in got) == 399 * len(text)


def test_a_replaced_byte_stays(spark):
    rng, rows, touching = random.Random(4), [], 0
    for pair in range(40):
        text = "".join(rng.choice("abcdefghijklmnop ") for _ in range(700))
        for at in range(120, 580):
            copy = text[:at] + "#" + text[at + 1 :]
            (batch,) = suffix_dedup._anchored(100, 24)(iter([_batch([(0, text), (1, copy)])]))
            settled = [(a, w) for a, w, c in zip(*(batch[k].to_pylist() for k in ("start", "windows", "context"))) if c is None]
            assert all(not a <= at < a + w + 99 for a, w in settled), (pair, at)
            ends = {a + w + 99 for a, w in settled}
            if any(a - 1 in ends for a, _ in settled) and touching < 8:
                touching += 1
                rows += [(2 * len(rows), text), (2 * len(rows) + 1, copy)]
    assert rows
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert sorted((tuple(r) for r in suffix_dedup.remove_repeats(df).collect()), key=str) == brute(rows, 100)


def _sorted_symbols(monkeypatch, parts, **rows):
    """Spans of one anchor's contexts, and how many symbols were sorted to find them."""
    import pyarrow as pa

    sizes = []
    monkeypatch.setattr(suffix_dedup, "suffix_array", lambda s: sizes.append(len(s)) or suffix_array(s))
    n = len(parts)
    batch = pa.RecordBatch.from_pydict({"anchor": [7] * n, "doc": list(range(n)), "start": [10] * n, "lead": [60] * n, "bytes": parts})
    spans = [r for b in suffix_dedup._settled(100, 2048)(iter([batch])) for r in b.to_pylist()]
    return sorted((r["doc"], r["start"], r["end"]) for r in spans), sum(sizes)


def test_equal_strings_are_sorted_once(monkeypatch):
    rng = random.Random(8)
    shared = bytes(rng.choices(range(97, 123), k=140))
    parts = [bytes([65 + i]) * 5 + shared + bytes([75 + i]) * 5 for i in range(6)]
    spans, symbols = _sorted_symbols(monkeypatch, parts)
    assert spans == [(i, 15, 155) for i in range(1, 6)]
    assert symbols == 0
    # a context that shares less brings a second string, and each of the two goes in once
    other = b"Z" * 25 + shared[20:] + b"Z" * 5
    spans, symbols = _sorted_symbols(monkeypatch, [*parts, other])
    assert spans == [(i, 15, 155) for i in range(1, 6)] + [(6, 35, 155)]
    assert symbols == 140 + 1 + 120 + 1 + 1


def test_anchors_do_not_depend_on_chunks(monkeypatch):
    rng = random.Random(3)
    texts = [bytes(rng.choices(b"ab", k=rng.choice((0, 5, 99, 100, 101, 700)))) for _ in range(30)] + [b"x" * 500]
    data = np.frombuffer(b"".join(texts), np.uint8)
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    values = suffix_dedup.anchor_values(data, 24)
    whole = suffix_dedup.contexts(data, first, 100, 24)
    windows = {}
    for text, start, n, place, value in zip(*(x.tolist() for x in whole)):
        for at in range(start, start + n):
            assert value == values[place] and place == at + int(np.argmin(values[at : at + 77]))
            windows[at] = text
    assert windows == {int(first[i]) + at: i for i, t in enumerate(texts) for at in range(len(t) - 99)}
    monkeypatch.setattr(suffix_dedup, "CHUNK", 64)
    for a, b in zip(whole, suffix_dedup.contexts(data, first, 100, 24)):
        assert a.tolist() == b.tolist()


def test_no_text_holds_a_window():
    (batch,) = suffix_dedup._anchored(100, 24)(iter([_batch([(1, "a" * 60), (2, "b" * 60)])]))
    assert batch.num_rows == 0
