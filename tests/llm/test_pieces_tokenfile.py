"""SentencePiece coding and token files, against the libraries."""

from __future__ import annotations

import random
import zlib
from functools import cache

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from inventrace.llm import pieces, tokenfile
from tests.llm.conftest import ROWS, frame

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def odd_texts(n, letters, seed=0):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(n)]


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(pieces.read_model(MODEL))


def test_ids_are_those_of_the_library(model):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = odd_texts(1500, "ab the in\n ▁é😀0.ñ") + ["", " ", "a" * 300, " " * 90, "The quick brown fox. 12345 ))) 漢字\x00"]
    got = model.encode(texts, {})
    assert [list(x) for x in got] == [sp.encode(t) for t in texts]
    assert [model.decode(x) for x in got] == [sp.decode(sp.encode(t)) for t in texts]


def test_common_prefixes_do_not_change_words(model):
    words = sorted({w for t in odd_texts(400, "abthein ", 4) for w in model.words(t)})
    together = model.encode_words(words)
    assert all(model.encode_words([w])[w] == together[w] for w in words)


def tiny_unigram(scores: dict[str, float]) -> bytes:
    """A model file of the unigram kind, made of protocol-buffer fields."""
    import struct

    field = lambda n, b: bytes([n << 3 | 2, len(b)]) + b
    piece = lambda s, x, kind: field(1, field(1, s.encode()) + b"\x15" + struct.pack("<f", x) + bytes([3 << 3, kind]))
    return piece("<unk>", 0, 2) + b"".join(piece(s, x, 1) for s, x in scores.items()) + field(2, bytes([3 << 3, 1])) + field(3, bytes([3 << 3, 1, 4 << 3, 0, 5 << 3, 1]))


def test_unigram_takes_the_best_path():
    rng = random.Random(2)
    scores = {s: -rng.randint(1, 40) / 4 for s in ["▁", "a", "b", "▁a", "ab", "ba", "aab", "bb", "▁ab", "abab"]}
    model = pieces.PieceModel(tiny_unigram(scores))

    def best(word: str) -> float:
        @cache
        def at(i: int) -> float:
            if i == len(word):
                return 0.0
            known = [scores[word[i:j]] + at(j) for j in range(i + 1, len(word) + 1) if word[i:j] in scores]
            return max([*known, *([] if word[i] in scores else [model.low + at(i + 1)])])

        return at(0)

    for text in odd_texts(300, "ab c", 3):
        for word in set(model.words(text)):
            ids = np.frombuffer(model.encode_words([word])[word], "<i4")
            assert sum(model.scores[i] if i else model.low for i in ids) == pytest.approx(best(word))


def test_whole_rows_keep_their_columns(odd, empty):
    data = pieces.read_model(MODEL)
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    coded = pieces.encode(odd, data)
    got = pieces.decode(coded, data).collect()
    assert coded.select("row.*").columns == odd.columns and len(got) == len(ROWS)
    for r in got:
        text = r["row"].text
        assert r.ids == (None if text is None else sp.encode(text)) and r.decoded == text
    assert pieces.decode(pieces.encode(empty, data), data).count() == 0


def test_words_of_the_tokenizer_are_those_of_the_library():
    with open(WORDS) as f:
        own = tokenfile.WordTokenizer(f.read())
    library = Tokenizer.from_file(WORDS)
    texts = odd_texts(1500, "ab'sTé.,́ Σİ1\n\x85😀<|>\x1c") + ["<|endoftext|> x", "a<|endoftext|>b", "it's IT'S we'll...", "", "x" * 5000]
    texts += odd_texts(1500, "aBéÑßŁđǅŉſ.,%%!?*#|'1 ɐ", 5) + [chr(c) + "a " + chr(c).upper() + "." for c in range(0x80, 0x260)]
    got = own.encode([t.encode() for t in texts])
    assert [list(x) for x in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("seed,letters", [(0, 3), (1, 50), (2, 1)])
def test_shards_restore_any_part(seed, letters):
    rng = np.random.default_rng(seed)
    ids = [np.append(rng.integers(3, 3 + letters, rng.integers(0, 400)), 2).astype("<u4") for _ in range(60)]
    shard = tokenfile.Shard.from_bytes(tokenfile.Shard.pack([None, *range(1, 60)], ids).to_bytes())
    whole = np.concatenate(ids)
    assert (shard.ids() == whole).all() and shard.doc_ids == [None, *range(1, 60)]
    assert all((shard.document(k) == ids[k]).all() for k in range(60))
    for a, b in rng.integers(0, len(whole), (50, 2)):
        a, b = sorted((int(a), int(b)))
        assert (shard.slice(a, b + 1) == whole[a : b + 1]).all()
    if letters < 50:
        assert len(shard.symbols) < len(whole) / 3
    assert all(a < shard.base + k and b < shard.base + k for k, (a, b) in enumerate(shard.rules.tolist()))


@pytest.mark.parametrize("shard_ids", [50, 1 << 20])
def test_files_hold_every_document_in_order(odd, empty, shard_ids):
    with open(WORDS) as f:
        definition = f.read()
    library = Tokenizer.from_file(WORDS)
    got = sorted(tokenfile.round_trip(odd, definition, shard_ids=shard_ids).collect(), key=lambda r: r.start)
    rows = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    start = 0
    for r, want in zip(got, rows, strict=True):
        ids = np.array([*library.encode(want[1] or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (want[0], start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert tokenfile.round_trip(empty, definition).count() == 0


def test_a_null_text_is_the_end_id(spark):
    with open(WORDS) as f:
        got = tokenfile.round_trip(frame(spark, [(1, None)]), f.read()).collect()
    assert [(r.doc_id, r.start, r.n_tokens) for r in got] == [(1, 0, 1)]


def test_words_are_cut_where_no_piece_goes(model):
    text = "mot### été,*** don't (a) x1,b2  ##a\n\n漢字, ×, é×"
    words = model.words(text)
    assert "".join(words) == "▁" + text.replace(" ", "▁") and {"###", "\n"} <= set(words)
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert [i for w in words for i in np.frombuffer(model.encode_words([w])[w], "<i4")] == sp.encode(text)


def test_memo_may_overflow(model, monkeypatch):
    monkeypatch.setattr(pieces, "MEMO_WORDS", 7)
    monkeypatch.setattr(pieces, "KNOWN_PAIRS", 5)
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    memo = {}
    for k in range(6):
        texts = [f"word{chr(97 + j + k)} of, the {chr(97 + j)} x" for j in range(9)]
        assert [x.tolist() for x in model.encode(texts, memo)] == [sp.encode(t) for t in texts]
        assert len(memo) <= 7 + 40


def test_bytes_that_are_no_text(spark, model):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = [(1, [model.bytes_[0xC3]]), (2, [model.bytes_[0xC3], model.bytes_[0xA9]]), (3, []), (4, None), (5, sp.encode("a b"))]
    df = spark.createDataFrame(rows, "id long, ids array<int>")
    got = {r.id: r.decoded for r in pieces.decode(df, pieces.read_model(MODEL)).collect()}
    assert got == {1: sp.decode(rows[0][1]), 2: "é", 3: "", 4: None, 5: "a b"}
    with pytest.raises(ValueError):
        pieces.decode(df, pieces.read_model(MODEL), name="id")


def test_other_tokenizers_get_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path) as f, open(WORDS) as g:
        other, own = f.read(), g.read()
    assert tokenfile.cuttable(own) and not tokenfile.cuttable(other)
    texts = ["The quick  brown fox, it's", "", "A\nB 漢字"]
    lib = Tokenizer.from_file(path)
    assert [x.tolist() for x in tokenfile.WordTokenizer(other).encode([t.encode() for t in texts])] == [lib.encode(t, add_special_tokens=False).ids for t in texts]


def test_plain_words_go_straight_to_the_merges(monkeypatch):
    definition = open(public_tokenizers.path("word_bpe_49k.json")).read()
    texts = ["Plain words and Again plain", "", "words\nAGAIN"]
    want = [Tokenizer.from_str(definition).encode(t, add_special_tokens=False).ids for t in texts]
    monkeypatch.setattr(tokenfile, "_PLAIN_LETTERS", None)  # what sorts out the other words fails
    found = tokenfile.WordTokenizer(definition).encode([t.encode() for t in texts])
    assert [x.tolist() for x in found] == want


def test_small_latin_letters_go_straight_to_the_merges(monkeypatch):
    definition = open(public_tokenizers.path("word_bpe_49k.json")).read()
    latin = "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
    texts = ["naïve été Été", " ".join(f"a{c} {c} b{c}c" for c in latin), latin]
    want = [Tokenizer.from_str(definition).encode(t, add_special_tokens=False).ids for t in texts]
    monkeypatch.setattr(tokenfile, "_PLAIN_LETTERS", None)  # what sorts out the other words fails
    found = tokenfile.WordTokenizer(definition).encode([t.encode() for t in texts])
    assert [x.tolist() for x in found] == want
