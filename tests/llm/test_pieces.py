"""SentencePiece coding against a plain search over all cuts and against the library's decoder."""

import os
import random

import numpy as np
import pytest

from hazardlens.llm import pieces

pytestmark = pytest.mark.skipif(not os.path.exists(pieces.MODEL), reason="no vocabulary here")


@pytest.fixture(scope="module")
def encoder():
    vocabulary = pieces.Pieces.read()
    return pieces.Encoder(vocabulary, pieces.Trie.build(vocabulary.texts))


def brute(encoder, text):
    """Best cut by trying every piece at every place, without cutting the text into parts."""
    vocabulary = encoder.pieces
    ids = {}
    for i, piece in enumerate(vocabulary.texts):
        if piece:
            ids.setdefault(piece, i)
    whole = " " + text
    best = [None] * (len(whole) + 1)
    best[0] = (0.0, [])
    for a in range(len(whole)):
        known = False
        for b in range(a + 1, min(len(whole), a + 48) + 1):
            i = ids.get(whole[a:b].encode())
            if i is not None:
                known = known or b == a + 1
                total = best[a][0] + vocabulary.scores[i]
                if best[b] is None or total > best[b][0]:
                    best[b] = (total, best[a][1] + [i])
        if not known:
            total = best[a][0] + encoder.unknown_score
            if best[a + 1] is None or total > best[a + 1][0]:
                best[a + 1] = (total, best[a][1] + [int(vocabulary.byte_ids[c]) for c in whole[a].encode()])
    return best[-1][1]


TEXTS = [
    "a",
    " ",
    "    ",
    "two  spaces and a\nline\n\n end ",
    "▁ the marker itself ▁▁",
    "日本語 🎉🎉 ünïcödé \x00\x01",
    "x" * 300 + " " + "ab" * 120,
    "é" * 250,
]


def test_equal_to_brute_force(encoder):
    rng = random.Random(1)
    words = ["the", "thinking", "of", "ções", "12", "!!", "\n", "zz\nq", "Straße"]
    texts = TEXTS + [" ".join(rng.choice(words) for _ in range(rng.randint(1, 12))) for _ in range(60)]
    got = encoder.encode([t.encode() for t in texts])
    assert [g.tolist() for g in got] == [brute(encoder, t) for t in texts]


def test_long_and_short_search_agree(encoder):
    part = " ".join(["thermal", "understanding"]).encode().replace(b" ", b"")
    assert encoder._one(part) == encoder._many([part])[0]


def test_round_trip_and_library_decoder(encoder):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    table = encoder.pieces.table()
    for text, ids in zip(TEXTS, encoder.encode([t.encode() for t in TEXTS])):
        assert pieces.decode(ids, table).decode() == text
        if "▁" not in text and "\x00" not in text:
            assert library.decode(ids.tolist()) == text


def test_trie_finds_what_it_holds():
    texts = [b"a", b"ab", b"abc", b"b", b"", b"zz"]
    trie = pieces.Trie.build(texts)
    for number, text in enumerate(texts):
        state = 0
        for c in text:
            nxt = int(trie.base[state]) + c
            assert trie.check[nxt] == state
            state = nxt
        assert not text or trie.piece[state] == number


def test_unigram_beats_greedy():
    vocabulary = pieces.Pieces([b" ab", b" a", b"bc", b"c", b"b"], np.array([-1.0, -1.2, -1.0, -9.0, -9.0]), np.full(256, -1), 9)
    encoder = pieces.Encoder(vocabulary, pieces.Trie.build(vocabulary.texts))
    assert encoder.encode([b"abc"])[0].tolist() == [1, 2]
    assert encoder.encode([b"abx"])[0].tolist() == [0, 9]


def test_rows(spark):
    rows = [(1, "some words"), (None, None), (1, "some words"), (2, ""), (3, "w " * 100_000)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, ids int")
    coded = pieces.encode(df)
    back = {(r["doc_id"], r["text"]) for r in pieces.decode_ids(coded).collect()}
    assert back == {(i, t or "") for i, t in rows}
    got = pieces.encode_and_check(df).collect()
    assert len(got) == 5 and all(r["round_trip"] for r in got)
    assert pieces.encode(df.limit(0)).count() == 0
    odd = spark.createDataFrame([(1, None), (2, [0, 1, -5, 99_999_999, None])], "doc_id long, ids array<int>")
    assert {(r["doc_id"], r["text"]) for r in pieces.decode_ids(odd).collect()} == {(1, None), (2, "")}
