"""SentencePiece encoding and decoding: distinct marked words are sorted into a trie and walked depth-first."""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inventrace.llm.common import SLICE_BYTES, flat, per_text, releasing, slices

SPACE = "▁"
#: Words whose ids a task remembers from slice to slice (some 200 bytes each), and the longest of them in bytes.
MEMO_WORDS, MEMO_BYTES = 150_000, 64
#: Pairs of pieces of which a worker remembers whether they stay apart (some 100 bytes each).
KNOWN_PAIRS = 300_000
#: Ids that are decoded at a time.
SLICE_IDS = 1 << 18
#: ASCII signs; what stands behind a letter.
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_BEHIND_LETTER = re.compile(r"(?<=[^\W\d_])(.)", re.DOTALL)
#: Below the lowest score by this much: an unknown character in a unigram model.
UNKNOWN_PENALTY = 10.0

#: Fixed values of the model file format: field numbers and enumerations.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of one protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(key & 7)
        if size is None:
            size = varint()
        yield key >> 3, data[at : at + size]
        at += size


class PieceModel:
    """A SentencePiece model file: pieces with scores and kinds, and how text is prepared.

    Read are unigram and BPE models with identity normalization that keep white space as it is; others are refused.
    """

    def __init__(self, data: bytes):
        self.names: list[str] = []
        self.scores: list[float] = []
        kinds: list[int] = []
        self.kind, self.dummy_prefix = UNIGRAM, True
        rules = b""
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                self.names.append(piece.get(1, b"").decode())
                self.scores.append(struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0])
                kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                self.kind = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                spec = dict(_fields(value))
                rules, self.dummy_prefix = spec.get(2, b""), bool(spec.get(3, 1))
                if rules or spec.get(4, 1) or not spec.get(5, 1):
                    raise ValueError("only models with identity normalization that keep white space are read")
        if self.kind not in (UNIGRAM, BPE) or USER_DEFINED in kinds or UNUSED in kinds:
            raise ValueError("only unigram and BPE models of normal pieces are read")
        self.ids = {n: i for i, (n, k) in enumerate(zip(self.names, kinds, strict=True)) if k == NORMAL}
        self.unknown = kinds.index(UNKNOWN)
        self.bytes_ = [i for i, k in enumerate(kinds) if k == BYTE]
        self.low = min(self.scores[i] for i in self.ids.values()) - UNKNOWN_PENALTY
        self.raw = [b"" if k == CONTROL else b" \xe2\x81\x87 " if k == UNKNOWN else bytes([int(n[3:5], 16)]) if k == BYTE else n.replace(SPACE, " ").encode() for n, k in zip(self.names, kinds, strict=True)]
        if any(SPACE in n.lstrip(SPACE) for n in self.ids):
            raise ValueError("pieces that go over a word's end are not read")
        self.line_alone = not any("\n" in n for n in self.ids if len(n) > 1)
        # Signs that no piece has behind a letter begin a word of their own, as in "word###".
        behind = {m[1] for n in self.ids for m in _BEHIND_LETTER.finditer(n)}
        self.apart = np.zeros(256, bool)
        self.apart[[ord(c) for c in _SIGNS if c not in behind]] = True
        self.step: dict[int, int] = {}
        self.pool, self.pool_ends = np.frombuffer(b"".join(self.raw), np.uint8), np.cumsum([0, *map(len, self.raw)])
        self.known: dict[int, bool] = {}

    def _automaton(self) -> None:
        """Pieces as a trie with failure links: from the state of a prefix, all pieces that end there, longest first.

        ``step`` leads from a state by a character, ``fail`` to the state of the longest proper suffix, ``shorter`` to the nearest suffix that is
        a piece (0: none). ``piece`` and ``depth`` are a state's piece (-1: none) and length. Decoding does without.
        """
        self.piece, self.depth = [-1], [0]
        parents = [(0, 0)]
        for name, i in self.ids.items():
            state = 0
            for c in map(ord, name):
                key = state << 21 | c
                if key not in self.step:
                    self.step[key] = len(self.piece)
                    self.piece.append(-1)
                    self.depth.append(self.depth[state] + 1)
                    parents.append((state, c))
                state = self.step[key]
            self.piece[state] = i
        self.fail, self.shorter = [0] * len(self.piece), [0] * len(self.piece)
        for state in sorted(range(1, len(self.piece)), key=self.depth.__getitem__):
            before, c = parents[state]
            at = self.fail[before]
            while at and at << 21 | c not in self.step:
                at = self.fail[at]
            if before:
                self.fail[state] = self.step.get(at << 21 | c, 0)
            own = self.fail[state]
            self.shorter[state] = own if self.piece[own] >= 0 else self.shorter[own]

    def cuts(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """(words of all texts one after the other as UTF-8 with plain spaces, words per text).

        No piece goes over a word's end, so each is encoded by itself: spaces begin a word, a line end is one alone unless pieces hold it, and
        signs that no piece has behind a letter begin one behind ASCII and accented letters.
        """
        data, offsets = flat(texts)
        if SPACE.encode() in data.tobytes():  # a mark in the text counts as a space
            data, offsets = flat(pc.replace_substring(texts.cast(pa.string()), SPACE, " "))
        if self.dummy_prefix:
            filled = np.diff(offsets) > 0
            data = np.insert(data, offsets[:-1][filled], 0x20)
            offsets = offsets + np.concatenate([[0], np.cumsum(filled)])
        start = data == 0x20
        if len(data):
            low = data | 0x20
            letter = (low >= 0x61) & (low <= 0x7A) & (data < 0x80)
            letter[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
            start[1:] &= ~start[:-1]
            start[1:] |= letter[:-1] & self.apart[data[1:]]
            if self.line_alone:
                line = data == 0x0A
                start |= line
                start[1:] |= line[:-1]
        start[offsets[:-1][np.diff(offsets) > 0]] = True
        begin = np.append(np.flatnonzero(start), len(data))
        words = pa.Array.from_buffers(pa.large_binary(), len(begin) - 1, [None, pa.py_buffer(begin), pa.py_buffer(np.ascontiguousarray(data))])
        return words, per_text(start, offsets)

    def words(self, text: str) -> list[str]:
        """The marked words of a text."""
        return [_marked(w) for w in self.cuts(pa.array([text]))[0].to_pylist()]

    def merged(self, text: str) -> list[str]:
        """The pieces that merging by score leaves of a text: best score first, then leftmost."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.scores[i] > best):
                    best, at = self.scores[i], k
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, before: int, piece: int) -> bool:
        """Whether merging leaves ``piece`` whole, and apart from the piece ``before`` it (-1: nothing that merges)."""
        own = self.names[piece]
        left = [self.names[before]] if before >= 0 else []
        found = self.merged("".join(left) + own) == [*left, own]
        if len(self.known) >= KNOWN_PAIRS:
            self.known.clear()
        self.known[before << 32 | piece] = found
        return found

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids (int32, little-endian) of distinct marked words.

        Sorted words are a trie in depth-first order: from word to word, the forward entries of the common prefix
        stay and the others are computed anew. An entry for a prefix is its last piece and where that starts, and for unigram
        models the best score. In a BPE model the pieces of a prefix are the only chain of vocabulary pieces in which
        each neighbouring pair stays as it is under merging, so one entry is enough there too.
        """
        if not self.step:
            self._automaton()
        scores, bpe, known, fits = self.scores, self.kind == BPE, self.known, self.fits
        step, fail, shorter, piece, depth = self.step, self.fail, self.shorter, self.piece, self.depth
        last, begin, total, states = [-1], [0], [0.0], [0]
        out, previous = {}, ""
        for word in sorted(words):
            common = 0
            for a, b in zip(previous, word):
                if a != b:
                    break
                common += 1
            del last[common + 1 :], begin[common + 1 :], total[common + 1 :], states[common + 1 :]
            state, end = states[-1], common
            for c in map(ord, word[common:]):
                end += 1
                after = step.get(state << 21 | c)
                while after is None:
                    if not state:
                        after = 0
                        break
                    state = fail[state]
                    after = step.get(state << 21 | c)
                state = after
                best, start, score = -1, end - 1, 0.0
                own = state if piece[state] >= 0 else shorter[state]
                if bpe:
                    while own:
                        at, i = end - depth[own], piece[own]
                        stays = known.get(last[at] << 32 | i)
                        if fits(last[at], i) if stays is None else stays:
                            best, start = i, at
                            break
                        own = shorter[own]
                else:
                    score = total[-1] + self.low
                    while own:
                        at, i = end - depth[own], piece[own]
                        if total[at] + scores[i] > score or best < 0 and at == end - 1:
                            best, start, score = i, at, total[at] + scores[i]
                        own = shorter[own]
                last.append(best)
                begin.append(start)
                total.append(score)
                states.append(state)
            found, end = [], len(word)
            while end:
                if last[end] >= 0:
                    found.append(last[end])
                elif self.bytes_:
                    found += [self.bytes_[b] for b in reversed(word[end - 1].encode())]
                else:
                    found.append(self.unknown)
                end = begin[end]
            found.reverse()
            out[word] = array("i", found).tobytes()
            previous = word
        return out

    def encode_flat(self, texts: pa.Array, memo: dict[bytes, bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, n + 1 offsets); null counts as empty. ``memo`` keeps words between calls."""
        words, per = self.cuts(texts)
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new = {w: _marked(w) for w in distinct if w not in memo}
        found = self.encode_words(list(new.values()))
        ids = [memo[w] if w in memo else found[new[w]] for w in distinct]
        pool = np.frombuffer(b"".join(ids), "<i4")
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first = np.cumsum(size) - size
        use = coded.indices.to_numpy(zero_copy_only=False)
        sizes = size[use]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        flat_ids = pool[np.repeat(first[use] - ends[:-1], sizes) + np.arange(ends[-1])]
        ends = ends[np.concatenate([[0], np.cumsum(per)])]
        if len(memo) + len(new) > MEMO_WORDS:  # words that are still in use stay
            kept = {w: memo[w] for w in distinct if w in memo}
            memo.clear()
            memo.update(kept)
        room = MEMO_WORDS - len(memo)
        memo.update((w, found[m]) for w, m in islice(new.items(), max(room, 0)) if len(w) <= MEMO_BYTES)
        return (flat_ids, ends) if self.bytes_ else self._one_unknown(flat_ids, ends)

    def encode(self, texts: list[str], memo: dict[bytes, bytes]) -> list[np.ndarray]:
        """Ids of each text."""
        ids, ends = self.encode_flat(pa.array(texts, pa.string()), memo)
        return np.split(ids, ends[1:-1]) if texts else []

    def _one_unknown(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Neighbouring unknowns of a text count as one, as in models without byte pieces."""
        again = np.zeros(len(ids), bool)
        again[1:] = (ids[1:] == self.unknown) & (ids[:-1] == self.unknown)
        again[ends[:-1][np.diff(ends) > 0]] = False
        return ids[~again], ends - np.concatenate([[0], np.cumsum(again)])[ends]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.raw.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text

    def decode_flat(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The text of each range of ids, as UTF-8."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.raw)):
            raise ValueError("ids outside the model")
        size = np.diff(self.pool_ends)[ids]
        at = np.concatenate([[0], np.cumsum(size)])
        data = self.pool[np.repeat(self.pool_ends[:-1][ids] - at[:-1], size) + np.arange(at[-1])].tobytes()
        try:
            data.decode()
        except UnicodeDecodeError:  # byte pieces that are no text: replaced as the library does it
            return [self.decode(ids[a:b]).encode() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        cut = at[ends].tolist()
        texts = [data[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
        return [t[1:] if t[:1] == b" " else t for t in texts] if self.dummy_prefix else texts


def _marked(word: bytes) -> str:
    return word.decode().replace(" ", SPACE)


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


_LOADED: dict[bytes, PieceModel] = {}


def _loaded(data: bytes) -> PieceModel:
    """The model; a worker process keeps the last one, with the pairs it knows, from task to task. Words are kept for one task."""
    if data not in _LOADED:
        _LOADED.clear()
        _LOADED[data] = PieceModel(data)
    return _LOADED[data]


def _row_type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def encode(docs: DataFrame, model: bytes, text_col: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """row (the columns ``keep`` of ``docs``, all by default) and ids (array<int>) of every whole text; null texts have null ids, empty texts none.

    Equal texts have equal ids, repeated rows each theirs; an empty table gives no rows. Columns of ``docs`` may have any names. The model file
    (some 100 KB, whatever the data) is sent to the tasks once; a task holds one slice of texts and a bounded
    memo of words. Nothing is shuffled.
    """
    packed = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, memo = _loaded(packed.value), {}
        for batch in batches:
            for part in slices(batch, "__text", SLICE_BYTES // 2):
                texts = part.column("__text")
                found, ends = pieces.encode_flat(texts, memo)
                ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(found), mask=texts.is_null())
                yield pa.RecordBatch.from_arrays([part.column("row"), ids], ["row", "ids"])

    rows = docs.select(F.col(text_col).cast("string").alias("__text"), F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]).alias("row"))
    return rows.mapInArrow(releasing(run), f"row {_row_type(rows, 'row')}, ids array<int>")


def decode(encoded: DataFrame, model: bytes, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """``encoded`` with the text of the ids as last column ``name``; null ids give null, no ids the empty text. Ids outside the model fail.

    Repeated rows each get theirs; an empty table gives no rows. A column of that name in ``encoded`` is an error.
    """
    if name in encoded.columns:
        raise ValueError(f"the rows have a column {name!r} already")
    packed = encoded.sparkSession.sparkContext.broadcast(model)
    names = encoded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _loaded(packed.value)
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column(ids_col)), 0).to_numpy(zero_copy_only=False)
            total, start = np.cumsum(sizes), 0
            while start < len(total):
                stop = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + SLICE_IDS, "right")))
                part = batch.slice(start, stop - start)
                ids = part.column(ids_col)
                texts = pieces.decode_flat(ids.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(sizes[start:stop])]))
                text = pa.array(texts, pa.binary(), mask=ids.is_null().to_numpy(zero_copy_only=False)).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, text], [*names, name])
                start = stop

    kinds = ", ".join(f"`{c}` {_row_type(encoded, c)}" for c in names)
    return encoded.mapInArrow(releasing(run), f"{kinds}, `{name}` string")
