"""Byte-level BPE of the tokenizers library over distinct chunks of text.

The pre-tokenizer of such a tokenizer never joins what stands on the two sides of a single space between two visible characters: the
space belongs to the piece after it, and nothing looks further back. Nor does a piece go on from a letter to a sign. Texts are cut there, and each
distinct chunk of a slice is encoded once. A chunk of letters is one piece, which goes straight to the library's merge model.
"""

from __future__ import annotations

import json
import os
from array import array

import numpy as np
import pyarrow as pa

from inventrace.llm.common import flat, per_text
from inventrace.llm.tokenfile import byte_letters

#: Bytes of chunks and ids that are remembered from slice to slice, and of the longest chunk among them.
MEMO_BYTES, MEMO_CHUNK = 8 << 20, 48
#: Chunks that the library gets at a time.
ASK = 4096
#: Below this character letters are the same to Python and to the library.
_PLAIN_LETTERS = "\u0180"


def cuts(data: np.ndarray, offsets: np.ndarray, signs: bool = True) -> np.ndarray:
    """First bytes of chunks: of texts, single spaces between visible characters and, with ``signs``, ASCII signs after letters.

    Visible are printable ASCII and characters of two bytes from C3 on; after the space also those of three bytes from E4 on and of
    four. All others (white space is among them) do not make a cut, which is always safe.
    """
    plain = (data > 0x20) & (data < 0x7F)
    two = (data >= 0xC3) & (data <= 0xDF)
    before = plain.copy()
    before[1:] |= two[:-1] & (data[1:] >= 0x80) & (data[1:] < 0xC0)
    after = plain | two | ((data >= 0xE4) & (data <= 0xF4))
    start = data == 0x20
    if len(data):
        start[0] = start[-1] = False
        start[1:] &= before[:-1]
        start[:-1] &= after[1:]
    if signs and len(data):
        letter = ((data | 0x20) >= 0x61) & ((data | 0x20) <= 0x7A) & (data < 0x80)
        sign = plain & ~letter & ~((data >= 0x30) & (data <= 0x39))
        accented = np.zeros(len(data), bool)  # the characters of lead byte C3 are letters but for two
        accented[1:] = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        start[1:] |= sign[1:] & (letter | accented)[:-1]
    # A text's last byte has the next text's first one behind it, and its first byte always starts a chunk.
    ends = offsets[1:][np.diff(offsets) > 0]
    start[ends - 1] &= data[ends - 1] != 0x20
    start[offsets[:-1][np.diff(offsets) > 0]] = True
    return start


def cuttable(definition: str) -> bool:
    """Whether a tokenizer's rules allow :func:`cuts`: plain byte-level BPE without normalizer, and added tokens without spaces."""
    d = json.loads(definition)
    pre = d.get("pre_tokenizer") or {}
    own = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
    added = all(" " not in t["content"] and not t["lstrip"] and not t["rstrip"] and not t["single_word"] for t in d.get("added_tokens", []))
    return bool(own and added and not d.get("normalizer") and d["model"]["type"] == "BPE" and not d["model"].get("dropout"))


class ByteTokenizer:
    """Ids of texts by a tokenizer definition of the tokenizers library (add_special_tokens=False).

    Definitions that :func:`cuttable` refuses are applied to whole texts.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(definition)
        self.cuttable = cuttable(definition)
        self.added = [t["content"].encode() for t in json.loads(definition).get("added_tokens", [])]
        self.letters = byte_letters()
        self.memo: dict[bytes, bytes] = {}
        self.held = 0

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, n + 1 offsets); null counts as empty."""
        data, offsets = flat(texts)
        if not self.cuttable:
            found = self._ask([data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)])
            ends = np.concatenate([[0], np.cumsum([len(f) // 4 for f in found])]).astype(np.int64)
            return np.frombuffer(b"".join(found), "<u4"), ends
        whole = data.tobytes()
        start = cuts(data, offsets, signs=not any(t in whole for t in self.added))
        begin = np.append(np.flatnonzero(start), len(data))
        chunks = pa.Array.from_buffers(pa.large_binary(), len(begin) - 1, [None, pa.py_buffer(begin), pa.py_buffer(np.ascontiguousarray(data))])
        coded = chunks.dictionary_encode()
        found = self._look_up(coded.dictionary.to_pylist())
        pool = np.frombuffer(b"".join(found), "<u4")
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first = np.cumsum(size) - size
        use = coded.indices.to_numpy(zero_copy_only=False)
        sizes = size[use]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = pool[np.repeat(first[use] - ends[:-1], sizes) + np.arange(ends[-1])]
        return ids, ends[np.concatenate([[0], np.cumsum(per_text(start, offsets))])]

    def _look_up(self, chunks: list[bytes]) -> list[bytes]:
        memo = self.memo
        new = [c for c in chunks if c not in memo]
        got = self._merged(new)
        rest = [c for c in new if c not in got]
        got |= zip(rest, self._ask(rest), strict=True)
        found = [memo[c] if c in memo else got[c] for c in chunks]
        if self.held > MEMO_BYTES:
            memo.clear()
            self.held = 0
        for c, ids in got.items():
            if len(c) <= MEMO_CHUNK:
                memo[c] = ids
                self.held += len(c) + len(ids)
        return found

    def _merged(self, chunks: list[bytes]) -> dict[bytes, bytes]:
        """The ids of the chunks that are letters only, with or without a space before them."""
        merge, letters, out = self.library.model.tokenize, self.letters, {}
        for c in chunks:
            word = c.decode()
            core = word[1:] if word[0] == " " else word
            if core.isalpha() and max(core) < _PLAIN_LETTERS:
                out[c] = array("I", [t.id for t in merge(c.decode("latin-1").translate(letters))]).tobytes()
        return out

    def _ask(self, chunks: list[bytes]) -> list[bytes]:
        out = []
        for at in range(0, len(chunks), ASK):
            coded = self.library.encode_batch_fast([c.decode() for c in chunks[at : at + ASK]], add_special_tokens=False)
            out += [array("I", e.ids).tobytes() for e in coded]
        return out
