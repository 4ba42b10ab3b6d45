"""Packing: ids against the library, fillings against all multisets, pieces whole and in place."""

from __future__ import annotations

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from inventrace.llm import bytetokens, packing, queries
from inventrace.llm.common import stored
from tests.llm.conftest import ROWS, frame

SF = "/root/testdata/sf0.001"
BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def definition(path=BYTES):
    with open(path) as f:
        return f.read()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTES)


def encoded(tokenizer, texts):
    ids, ends = tokenizer.encode(pa.array(texts))
    return [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_ids_are_those_of_the_library(path):
    rng = random.Random(1)
    letters = "ab' 's're  \n\t　   é ßñ×÷ªº漢字😀İΣ1 2.,!\x1c\x1f\x7f\x85"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(6000)]
    texts += ["<|endoftext|>", "a <|endoftext|> b", "x<|endoftext|>y", "", " ", "don't ##'s ab'll c'", *[r[1] or "" for r in ROWS]]
    lib = Tokenizer.from_file(path)
    for some in (texts[:6000], texts[6000:]):
        assert encoded(bytetokens.ByteTokenizer(definition(path)), some) == [e.ids for e in lib.encode_batch(some, add_special_tokens=False)]
    assert bytetokens.cuttable(definition()) and not bytetokens.cuttable(definition(WORDS))


def test_memo_may_overflow(monkeypatch, library):
    monkeypatch.setattr(bytetokens, "MEMO_BYTES", 50)
    tokenizer = bytetokens.ByteTokenizer(definition())
    texts = [f"word{chr(97 + k % 26)} of the {chr(97 + k % 7)}" for k in range(60)] * 2
    assert [x for t in texts for x in encoded(tokenizer, [t, None])] == [x for t in texts for x in (library.encode(t).ids, [])]


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 9), st.integers(1, 3), max_size=5), st.integers(0, 30))
def test_filling_is_the_best_multiset(counts, capacity):
    chosen = packing.filling(counts, capacity)
    assert all(0 < c <= counts[n] for n, c in chosen.items())
    sums = {sum(n * k for n, k in zip(counts, ks)) for ks in itertools.product(*[range(c + 1) for c in counts.values()])}
    assert sum(n * c for n, c in chosen.items()) == max(s for s in sums if s <= capacity)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 16), st.integers(0, 40), max_size=8))
def test_plan_places_every_piece_once(counts):
    plan = packing.plan(counts, 16)
    taken = defaultdict(list)
    for length, n in counts.items():
        if n:
            for sequence, offset in zip(*plan.place(length, np.arange(n))):
                taken[int(sequence)].append((int(offset), length))
    assert sorted(taken) == list(range(plan.sequences))
    for parts in taken.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= 16
    assert Counter(n for parts in taken.values() for _, n in parts) == Counter({n: c for n, c in counts.items() if c})


def test_plan_leaves_little_slack_and_stays_small():
    rng = np.random.default_rng(0)
    lengths = np.minimum(2048, rng.lognormal(5.5, 1.2, 300_000).astype(int) + 1)
    counts = dict(Counter(lengths.tolist()))
    plan = packing.plan(counts)
    assert plan.sequences <= -(-lengths.sum() // 2048) + 1
    more = packing.plan({n: c * 1000 for n, c in counts.items()})
    assert sum(map(len, more.begin.values())) < 4 * sum(map(len, plan.begin.values())) + 40_000
    with pytest.raises(ValueError):
        packing.plan({17: 1}, 16)


def check_pieces(rows, texts, library, window):
    """Rows (doc_id, start, length, crc, doc_tokens, sequence_id, offset): each document's ids once, sequences gapless."""
    want = Counter()
    for doc_id, text in texts:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for at in range(0, len(ids), window):
            part = np.array(ids[at : at + window], "<u4")
            want[(doc_id, at, len(part), zlib.crc32(part.tobytes()), len(ids))] += 1
    assert Counter(tuple(r[:5]) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r[5]].append((r[6], r[2]))
    for parts in by.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= window
    return len(by)


NAMES = ("doc_id", "start", "length", "crc", "doc_tokens", "sequence_id", "offset")


def packed_rows(docs, window):
    found = packing.pack(docs, definition(), window=window)
    found = found.select(F.col("row.doc_id"), "start", "length", F.crc32("ids").alias("crc"), "doc_tokens", "sequence_id", "offset")
    return [tuple(r[c] for c in NAMES) for r in found.collect()]


@pytest.mark.parametrize("window", [16, 2048])
def test_odd_rows(spark, odd, library, window):
    rows = packed_rows(odd, window)
    n = check_pieces(rows, [(r[0], r[1]) for r in ROWS], library, window)
    assert n <= -(-sum(r[2] for r in rows) // window) + 2


def test_no_rows(spark, empty):
    assert packed_rows(empty, 2048) == []
    assert packing.sequences(packing.pack(empty, definition())).collect() == []


def test_copies_with_one_length_are_ranked_in_buckets(spark, library, monkeypatch):
    monkeypatch.setattr(packing, "RANKED", 16)
    texts = [(k % 5, "the same words again") for k in range(200)] + [(k, "word " * k) for k in range(60)]
    rows = packed_rows(frame(spark, texts).repartition(7), 64)
    assert check_pieces(rows, texts, library, 64) <= -(-sum(r[2] for r in rows) // 64) + 1


def test_sequences_hold_the_ids(spark, library):
    texts = [(k, f"text {k} of some words") for k in range(40)]
    packed = stored(packing.pack(frame(spark, texts), definition(), window=32), "packed")
    rows = packing.sequences(packed, 32, pad_id=9).collect()
    at = {(r.sequence_id, r.offset): (r.row.doc_id, r.start, r.length) for r in packed.collect()}
    want = {k: [*library.encode(t).ids, 1] for k, t in texts}
    for r in rows:
        assert len(r.tokens) == 32 and set(r.tokens[r.n_tokens :]) <= {9} and r.ends[-1] == r.n_tokens
        for offset in [0, *r.ends[:-1]]:
            doc, start, length = at[(r.sequence_id, offset)]
            assert r.tokens[offset : offset + length] == want[doc][start : start + length]


def test_texts_alone_can_be_packed(spark):
    assert packing.pack(spark.createDataFrame([("a b c",)], "text string"), definition()).count() == 1


def test_registered_query(spark, library):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = [tuple(r) for r in queries.QUERIES["op11_packing"](spark, SF).collect()]
    assert check_pieces(rows, texts, library, 2048) <= -(-sum(r[2] for r in rows) // 2048) + 1
