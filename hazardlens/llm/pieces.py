"""SentencePiece encoding by Viterbi search over a double-array trie, and decoding."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hazardlens.llm import batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁"
UNKNOWN_PENALTY = 10.0
CACHED = 200_000
LONG = 192


@dataclass
class Pieces:
    """Piece texts with a plain space for the whitespace marker, their log scores, and special ids."""

    texts: list[bytes]
    scores: np.ndarray
    byte_ids: np.ndarray
    unknown: int

    @staticmethod
    def read(path: str = MODEL) -> Pieces:
        """The pieces of a model file; control pieces never match text and decode to nothing."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        texts, byte_ids = [], np.full(256, -1, np.int32)
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
            plain = not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
            texts.append(piece.replace(MARKER, " ").encode() if plain else b"")
        scores = np.array([model.get_score(i) for i in range(len(texts))], np.float64)
        return Pieces(texts, scores, byte_ids, model.unk_id())

    def table(self) -> list[bytes]:
        """What each id decodes to."""
        out = list(self.texts)
        for byte, i in enumerate(self.byte_ids.tolist()):
            if i >= 0:
                out[i] = bytes([byte])
        return out


@dataclass
class Trie:
    """A double-array trie: the child of ``s`` by byte ``c`` is ``base[s] + c`` if ``check`` there is ``s``."""

    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray

    @staticmethod
    def build(texts: list[bytes]) -> Trie:
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for number, text in enumerate(texts):
            if not text:
                continue
            node = 0
            for c in text:
                nxt = children[node].get(c)
                if nxt is None:
                    nxt = len(children)
                    children[node][c] = nxt
                    children.append({})
                    ends.append(-1)
                node = nxt
            if ends[node] < 0:
                ends[node] = number
        size = 4 * len(children) + 1024
        taken = bytearray(size)
        base, check, piece = [0] * size, [-1] * size, [-1] * size
        # a first byte always leaves room for a base above zero
        check[0], taken[0], slot, lowest, frontier = 0, 1, {0: 0}, 256, 256
        for node, kids in enumerate(children):
            at = slot.pop(node)
            piece[at] = ends[node]
            if not kids:
                continue
            codes = sorted(kids)
            first = lowest if len(codes) == 1 else frontier
            seen = first = taken.find(0, first)
            while any(taken[seen - codes[0] + c] for c in codes):
                seen = taken.find(0, seen + 1)
                if seen + 512 > len(taken):
                    grow = len(taken)
                    taken += bytearray(grow)
                    base, check, piece = base + [0] * grow, check + [-1] * grow, piece + [-1] * grow
            if len(codes) == 1:
                lowest = seen
            elif seen - first > 512:
                frontier = seen - 256  # what lies before is too dense for nodes of several children
            base[at] = start = seen - codes[0]
            for c in codes:
                taken[start + c] = 1
                check[start + c] = at
                slot[kids[c]] = start + c
        base, check, piece = (np.array(x, np.int32) for x in (base, check, piece))
        used = int(np.flatnonzero(check != -1)[-1]) + 257
        return Trie(base[:used], check[:used], piece[:used])


@dataclass
class Encoder:
    """Viterbi search for the pieces of highest total score.

    Text is cut where no piece can reach across: before a run of spaces and around
    characters that occur in no longer piece. Each part is searched once and
    remembered. Of equal sums the one found first wins, going by the last piece's
    start from left to right, so the longer last piece. A character that is no piece
    costs the lowest score less ``UNKNOWN_PENALTY`` and becomes its bytes, or the unknown id if the
    vocabulary lacks them.
    """

    pieces: Pieces
    trie: Trie
    cache: dict[bytes, bytes] = field(default_factory=dict)

    def __post_init__(self) -> None:
        plain = [t for t in self.pieces.texts if t]
        self.scores = self.pieces.scores
        matched = [i for i, t in enumerate(self.pieces.texts) if t]
        self.unknown_score = (self.scores[matched].min() if matched else 0.0) - UNKNOWN_PENALTY
        inner = any(b" " in t.lstrip(b" ") for t in plain)
        breaks = not any(b"\n" in t for t in plain if len(t) > 1)
        if inner:
            self.cut = re.compile(rb"\n|[^\n]+" if breaks else rb"(?s).+")
        else:
            self.cut = re.compile(rb" +[^ \n]*|\n|[^ \n]+" if breaks else rb" +[^ ]*|[^ ]+")

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of every text, with a space put before a text that is not empty."""
        parts = [self.cut.findall(b" " + t) if t else [] for t in texts]
        if len(self.cache) > CACHED:
            self.cache.clear()
        new = list({p for part in parts for p in part if p not in self.cache})
        self._search(new)
        found = self.cache
        return [np.frombuffer(b"".join([found[p] for p in part]), np.int32) for part in parts]

    def _search(self, parts: list[bytes]) -> None:
        parts.sort(key=len)
        start = 0
        while start < len(parts):
            size = len(parts[start])
            stop = start
            most = max(4, size + size // 4)
            while stop < len(parts) and stop - start < 50_000 and len(parts[stop]) <= most:
                stop += 1
            group = parts[start:stop]
            if most > LONG:
                ids = [self._one(p) for p in group]
            else:
                ids = self._many(group)
            self.cache.update(zip(group, ids))
            start = stop

    def _many(self, parts: list[bytes]) -> list[bytes]:
        """All parts at once, one byte position after the other."""
        n, width = len(parts), max(map(len, parts))
        lengths = np.fromiter(map(len, parts), np.int64, n)
        text = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), np.uint8).reshape(n, width).T.copy()
        best = np.full((width + 1, n), -np.inf)
        source = np.zeros((width + 1, n), np.int32)
        chosen = np.zeros((width + 1, n), np.int32)
        best[0] = 0
        base, check, piece = self.trie.base, self.trie.check, self.trie.piece
        for at in range(width):
            alive = np.flatnonzero((lengths > at) & (best[at] > -np.inf))
            if not len(alive):
                continue
            here = best[at, alive]
            first = text[at, alive]
            step = np.where(first < 0x80, 1, np.where(first < 0xE0, 2, np.where(first < 0xF0, 3, 4)))
            covered = np.zeros(len(alive), bool)
            rows, state, order = alive, np.zeros(len(alive), np.int32), np.arange(len(alive))
            for to in range(at, width):
                nxt = base[state] + text[to, rows]
                good = (check[nxt] == state) & (lengths[rows] > to) & ((base[state] > 0) | (state == 0))
                rows, state, order = rows[good], nxt[good], order[good]
                if not len(rows):
                    break
                ends = piece[state]
                hit = np.flatnonzero(ends >= 0)
                if len(hit):
                    r, p = rows[hit], ends[hit]
                    total = here[order[hit]] + self.scores[p]
                    better = total > best[to + 1, r]
                    r, p = r[better], p[better]
                    best[to + 1, r], source[to + 1, r], chosen[to + 1, r] = total[better], at, p
                    covered[order[hit[step[order[hit]] == to + 1 - at]]] = True
            for size in (1, 2, 3, 4):
                lone = np.flatnonzero(~covered & (step == size))
                if len(lone) and at + size <= width:
                    r, total = alive[lone], here[lone] + self.unknown_score
                    better = total > best[at + size, r]
                    r = r[better]
                    best[at + size, r], source[at + size, r], chosen[at + size, r] = total[better], at, -1
        ends = [len(part) + 1 for part in parts]
        return [self._trace(parts[i], source[:e, i].tolist(), chosen[:e, i].tolist()) for i, e in enumerate(ends)]

    def _one(self, part: bytes) -> bytes:
        """One long part, with lists."""
        base, check, piece = self.trie.base, self.trie.check, self.trie.piece
        scores, n = self.scores, len(part)
        best, source, chosen = [-np.inf] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        best[0] = 0.0
        for at in range(n):
            if best[at] == -np.inf:
                continue
            c = part[at]
            step = 1 if c < 0x80 else 2 if c < 0xE0 else 3 if c < 0xF0 else 4
            state, covered = 0, False
            for to in range(at, n):
                nxt = int(base[state]) + part[to]
                if check[nxt] != state or (state and not base[state]):
                    break
                state = nxt
                p = int(piece[state])
                if p >= 0:
                    total = best[at] + scores[p]
                    if total > best[to + 1]:
                        best[to + 1], source[to + 1], chosen[to + 1] = total, at, p
                    covered = covered or to + 1 - at == step
            if not covered and best[at] + self.unknown_score > best[at + step]:
                best[at + step], source[at + step], chosen[at + step] = best[at] + self.unknown_score, at, -1
        return self._trace(part, source, chosen)

    def _trace(self, part: bytes, source: list[int], chosen: list[int]) -> bytes:
        ids, at = [], len(part)
        while at:
            start = source[at]
            if chosen[at] >= 0:
                ids.append(chosen[at])
            else:
                own = self.pieces.byte_ids[list(part[start:at])].tolist()
                ids.extend(own[::-1] if min(own) >= 0 else [self.pieces.unknown])
            at = start
        return np.array(ids[::-1], np.int32).tobytes()


def decode(ids: np.ndarray, table: list[bytes]) -> bytes:
    """The bytes of the pieces one after the other, markers as spaces, without the first added one."""
    whole = b"".join([table[i] for i in ids.tolist()])
    return whole[1:] if whole.startswith(b" ") else whole


_ENCODERS: dict[int, Encoder] = {}


def _encoder(shared) -> Encoder:
    """One encoder, with its memory of parts, per Python worker and vocabulary."""
    if shared.value["key"] not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[shared.value["key"]] = Encoder(shared.value["pieces"], shared.value["trie"])
    return _ENCODERS[shared.value["key"]]


def _share(df: DataFrame, path: str):
    """The vocabulary with its trie, a few MB whatever the input."""
    pieces = Pieces.read(path)
    key = zlib.crc32(b"\0".join(pieces.texts) + pieces.scores.tobytes())
    return df.sparkSession.sparkContext.broadcast({"key": key, "pieces": pieces, "trie": Trie.build(pieces.texts)})


def encode(df: DataFrame, id: str = "doc_id", text: str = "text", path: str = MODEL) -> DataFrame:
    """``doc_id, ids, n_tokens, n_byte_tokens`` of every row's whole text.

    Unigram Viterbi over the pieces of the model file at ``path``. A text is read as it
    is: no normalization, one space put before it, spaces as the whitespace marker. The
    marker character itself, where a text holds it, goes through its bytes like any
    character that is no piece, so that decoding gives back every text.

    Null and empty texts have no tokens. Ids may be null or repeated; rows are encoded
    one by one. An empty table gives an empty result; other columns are not read.
    """
    shared = _share(df, path)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        is_byte = np.zeros(len(encoder.pieces.texts), bool)
        is_byte[encoder.pieces.byte_ids[encoder.pieces.byte_ids >= 0]] = True
        for piece in batches.pieces(stream, text):
            ids = encoder.encode(batches.encoded(piece.column(text)))
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(flat, pa.int32()))
            own = [int(is_byte[i].sum()) for i in ids]
            columns = [piece.column(id), lists, pa.array(sizes), pa.array(own, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "n_tokens", "n_byte_tokens"])

    rows = df.selectExpr(f"cast(`{id}` as bigint) as `{id}`", f"`{text}`") if id != text else df.select(text)
    return rows.mapInArrow(run, "doc_id long, ids array<int>, n_tokens long, n_byte_tokens long")


def decode_ids(df: DataFrame, id: str = "doc_id", ids: str = "ids", path: str = MODEL) -> DataFrame:
    """``doc_id, text`` from lists of ids; null ids give null, unknown numbers and control pieces nothing.

    Bytes that are not valid UTF-8 together become the replacement character.
    """
    shared = _share(df, path)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value["pieces"].table()
        for batch in stream:
            texts = []
            for row in batch.column(ids):
                if not row.is_valid:
                    texts.append(None)
                    continue
                known = [i for i in row.as_py() if i is not None and 0 <= i < len(table)]
                texts.append(decode(np.array(known, np.int64), table).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column(id), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return df.selectExpr(f"cast(`{id}` as bigint) as `{id}`", f"`{ids}`").mapInArrow(run, "doc_id long, text string")


def encode_and_check(df: DataFrame, id: str = "doc_id", text: str = "text", path: str = MODEL) -> DataFrame:
    """``doc_id, n_tokens, n_byte_tokens, ids_crc, round_trip``: the encoding in short, decoded again.

    ``ids_crc`` is the crc32 of the ids as little-endian 32-bit numbers; ``round_trip``
    says whether decoding gives the text's bytes back. Otherwise as ``encode``.
    """
    shared = _share(df, path)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        table = encoder.pieces.table()
        is_byte = np.zeros(len(table), bool)
        is_byte[encoder.pieces.byte_ids[encoder.pieces.byte_ids >= 0]] = True
        for piece in batches.pieces(stream, text):
            texts = batches.encoded(piece.column(text))
            rows = [
                (len(ids), int(is_byte[ids].sum()), zlib.crc32(ids.astype("<i4").tobytes()), decode(ids, table) == t)
                for t, ids in zip(texts, encoder.encode(texts))
            ]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.bool_()))]
            names = ["doc_id", "n_tokens", "n_byte_tokens", "ids_crc", "round_trip"]
            yield pa.RecordBatch.from_arrays([piece.column(id), *columns], names=names)

    rows_in = df.selectExpr(f"cast(`{id}` as bigint) as `{id}`", f"`{text}`")
    return rows_in.mapInArrow(run, "doc_id long, n_tokens long, n_byte_tokens long, ids_crc long, round_trip boolean")
