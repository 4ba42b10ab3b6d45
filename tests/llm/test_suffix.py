"""Suffix dedup against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from inventrace.llm import suffix
from inventrace.llm.common import flat
from tests.llm import brute
from tests.llm.conftest import ROWS, frame


def corpus(seed, n=120):
    rng = random.Random(seed)
    sentence = lambda k: " ".join("".join(rng.choice(["an", "th", "er", "é", "re"]) for _ in range(rng.randint(1, 4))) for _ in range(k))
    shared = [sentence(rng.randint(4, 30)) for _ in range(6)]
    docs = []
    for i in range(n):
        if docs and rng.random() < 0.3:
            text = list(rng.choice(docs)[1])
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = "X"
            docs.append((i, "".join(text)))
        else:
            docs.append((i, " ".join([sentence(rng.randint(1, 40)), rng.choice(shared), sentence(rng.randint(1, 9))])))
    return docs + [(n, "ab" * 60), (n + 1, "x" + "ab" * 60), (n + 2, "a" * 200), (n + 3, "a" * 49), (n + 4, docs[3][1]), (n, "ba" * 60)]


def check(got, docs):
    want = {}
    for (doc, text), hit in zip(docs, brute.covered([(d, (t or "").encode()) for d, t in docs]), strict=True):
        raw = np.frombuffer((text or "").encode(), np.uint8)
        spans = int((np.diff(np.concatenate([[0], hit.astype(int)])) == 1).sum())
        want.setdefault(doc, []).append((len(raw), int(hit.sum()), spans, hashlib.sha256(raw[~hit].tobytes()).hexdigest()))
    found: dict = {}
    for r in got:
        found.setdefault(r.doc_id, []).append((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}


@pytest.mark.parametrize("seed", [0, 1])
def test_spans_match_brute_force(spark, seed):
    docs = corpus(seed)
    check(suffix.repeated_spans(frame(spark, docs).repartition(4)).collect(), docs)


@pytest.mark.parametrize("crowd,local", [(1, 64), (2048, 1), (0, 1)])
def test_crowded_buckets_give_the_same_spans(monkeypatch, crowd, local):
    """The steps run one after the other in this process, so that the limits can be lowered."""
    monkeypatch.setattr(suffix, "CROWD", crowd)
    monkeypatch.setattr(suffix, "LOCAL_CROWD", local)
    docs = corpus(7)
    table = lambda part: pa.RecordBatch.from_pydict({"doc": [d for d, _ in part], "body": [hash(t) & 0xFFFFFFF for _, t in part], "text": [t for _, t in part]})
    sent = [b for part in (docs[::3], docs[1::3], docs[2::3]) for b in suffix._send(5)(iter([table(part)]))]
    sent = pa.Table.from_batches(sent).sort_by("part").to_batches(max_chunksize=7)
    told: dict = {}
    for r in pa.Table.from_batches(list(suffix._meet(iter(sent)))).to_pylist():
        lists = told.setdefault((r["doc"], r["body"]), {"done": [], "open": [], "crowd": []})
        for k in lists:
            if r[k] is not None:
                lists[k].append(r[k])
    texts = pa.Table.from_batches(list(suffix._pack_texts(iter([table(docs)])))).to_pylist()
    rows = [{**t, **told[t["doc"], t["body"]]} for t in texts if (t["doc"], t["body"]) in told]
    lists = [(c, pa.list_(pa.binary())) for c in ("done", "open", "crowd")]
    schema = pa.schema([("doc", pa.int64()), ("body", pa.int64()), ("size", pa.int64()), ("packed", pa.binary()), *lists])
    opened = pa.Table.from_batches(list(suffix._open(iter(pa.Table.from_pylist(rows, schema).to_batches()))))
    assert 2 in opened.column("kind").to_pylist()
    strings = opened.filter(pa.compute.greater(opened.column("kind"), 0)).sort_by("key")
    spans: dict = {}
    refined = [r for b in suffix._refine_all(iter(strings.to_batches())) for r in b.to_pylist()]
    for r in refined + opened.filter(pa.compute.equal(opened.column("kind"), 0)).to_pylist():
        spans.setdefault((r["doc"], r["body"]), []).append(r["spans"])
    for (d, t), hit in zip(docs, brute.covered([(d, t.encode()) for d, t in docs]), strict=True):
        own = np.zeros(len(t.encode()), bool)
        for a, b in np.frombuffer(b"".join(spans.get((d, hash(t) & 0xFFFFFFF), [])), "<i8").reshape(-1, 2):
            own[a:b] = True
        assert (own == hit).all(), d


def test_refine_groups_equal_strings():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 2, 4000).astype(np.uint8)
    data[1000:1300] = data[200:500]
    data[3000:3200] = 7
    starts = np.arange(len(data) - suffix.SPAN + 1)
    rank = suffix.refine(data, starts)
    names: dict[bytes, int] = {}
    for s, r in zip(starts, rank, strict=True):
        assert names.setdefault(data[s : s + suffix.SPAN].tobytes(), r) == r
    assert len(names) == len(set(rank.tolist()))


def test_long_texts_are_looked_at_in_pieces(monkeypatch):
    monkeypatch.setattr(suffix, "_PIECE", 300)
    text = ("".join(random.Random(1).choice("abcd ") for _ in range(2000))).encode()
    got = suffix._all_runs(*flat(pa.array([text], pa.binary())))
    at = np.concatenate([np.arange(a, b + 1) for a, b in zip(got["first"], got["last"], strict=True)])
    assert sorted(at.tolist()) == list(range(len(text) - suffix.SPAN + 1))
    assert got["ordinal"].tolist() == list(range(len(got["ordinal"])))


def test_suffix_takes_odd_and_no_rows(odd, empty):
    got = suffix.repeated_spans(odd).collect()
    assert len(got) == len(ROWS)
    assert sorted(r.n_bytes for r in got) == sorted(len((r[1] or "").encode()) for r in ROWS)
    low = [(-(1 << 63) if r[0] is None else r[0], r[1]) for r in ROWS if len(r[1] or "") < 1000]  # a null id is below all others
    short = [r for r in got if r.n_bytes < 1000]
    removed = sorted(int(hit.sum()) for hit in brute.covered([(d, (t or "").encode()) for d, t in low]))
    assert sorted(r.n_removed for r in short) == removed
    assert suffix.repeated_spans(empty).count() == 0

