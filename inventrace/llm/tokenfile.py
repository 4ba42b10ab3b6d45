"""Token-id output: documents' ids in Re-Pair compressed shards that can be read as a whole or one document at a time."""

from __future__ import annotations

import json
import os
import string
import zlib
from array import array
from codecs import charmap_decode
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import accumulate, chain, pairwise
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inventrace.llm.common import flat, keep_freed, releasing, slices, stored, word_starts

END_ID = 2
#: A shard is closed when it has this many ids.
SHARD_IDS = 1 << 20
#: Pairs are replaced in rounds: all that are at least 1 / STEP as frequent as the most frequent one, down to LEAST.
STEP, LEAST, ROUNDS = 5, 6, 9
#: Words whose ids a worker remembers, and the longest of them in bytes.
MEMO_WORDS, MEMO_BYTES = 400_000, 48

_MAGIC = b"RPS1"
_ID = attrgetter("id")
_PUNCTUATION = string.punctuation.replace("'", "")
#: Letters below this code point are their own NFC form and have lower-case forms of their own.
_PLAIN_LETTERS = "\u0250"


_OTHER, _LETTER, _SIGN = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[list(string.ascii_letters.encode())] = _LETTER
_KIND[list(_PUNCTUATION.encode())] = _SIGN
#: Letters of two bytes whose first is LEAD, by their second: U+00C0 to U+00FF without the signs for times and divided by.
_LEAD = 0xC3
_LATIN = np.zeros(256, bool)
_LATIN[[b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)]] = True
#: The bytes of lower-case letters up to U+00FF; text in UTF-8 that has no others is such letters only.
_SMALL = string.ascii_lowercase.encode() + bytes([_LEAD, *(b for b in range(0x9F, 0xC0) if b != 0xB7)])


def split_pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(pieces of the texts in order, number of pieces of each text).

    A word of letters with or without punctuation at its end gives the letters, in lower case, and the punctuation; any other word is
    one piece as it stands.
    """
    sep, start = word_starts(data, offsets)
    kind = _KIND[data]
    lead = np.flatnonzero(data[:-1] == _LEAD)
    lead = lead[_LATIN[data[lead + 1]]]
    kind[lead] = kind[lead + 1] = _LETTER
    letter, sign = kind == _LETTER, kind == _SIGN
    bad = (kind == _OTHER) & ~sep
    bad |= start & sign
    bad[1:] |= letter[1:] & sign[:-1] & ~start[1:]
    first = np.flatnonzero(start)
    bounds = np.append(first, len(data))
    own = np.ones(len(first), bool)
    own[np.searchsorted(first, np.flatnonzero(bad), "right") - 1] = False
    plain = np.zeros(len(data), bool)
    plain[bounds[0] :] = np.repeat(own, np.diff(bounds))
    capital = (data >= 0x41) & (data <= 0x5A) & plain
    low = data | (capital.view(np.uint8) << 5)
    second = lead[plain[lead]] + 1
    low[second[data[second] < 0x9F]] += 0x20
    start[1:] |= plain[1:] & sign[1:] & letter[:-1]
    solid, last = ~sep, np.ones(len(data), bool)
    last[:-1] = sep[1:] | start[1:]
    first = np.flatnonzero(start)
    lengths = np.flatnonzero(solid & last) - first + 1
    ends = np.concatenate([[0], np.cumsum(lengths)])
    words = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(low[solid])])
    return words, np.diff(np.searchsorted(first, offsets))


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones stand for themselves, the others follow from 256."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


#: The text rules of the one kind of tokenizer whose words :func:`split_pieces` may cut.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLIT = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}


def cuttable(definition: str) -> bool:
    """Whether a tokenizer has the rules that the short ways of :class:`WordTokenizer` rest on."""
    d = json.loads(definition)
    pre = d.get("pre_tokenizer") or {}
    rules = pre.get("pretokenizers", [])
    level = rules[1] if len(rules) == 2 else {}
    byte_level = level.get("type") == "ByteLevel" and not level.get("add_prefix_space") and not level.get("use_regex")
    added = all(not set(t["content"]) & set(string.whitespace) and not t["lstrip"] and not t["rstrip"] and not t["single_word"] for t in d.get("added_tokens", []))
    return bool(d.get("normalizer") == _NORMALIZER and rules and rules[0] == _SPLIT and byte_level and added and d["model"]["type"] == "BPE" and not d["model"].get("dropout"))


class WordTokenizer:
    """A tokenizer of the tokenizers library, with a memo of words where its rules never look over ASCII white space.

    Tokenizers with other rules than :func:`cuttable` asks for get whole texts. Else every text is split at white space. A word of plain letters, with or without punctuation at its end, is one piece of such a tokenizer
    in lower case and one of the punctuation: the letters go straight to the library's merge model. All other words go
    through the whole tokenizer. The memo has two halves: when the young one is full it becomes the old one, and words that are
    still in use move back.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(definition)
        self.cuttable = cuttable(definition)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.letters = "".join(letter for _, letter in sorted(byte_letters().items()))

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text."""
        ids, offsets = self.encode_flat(pa.array(texts, pa.large_binary()))
        return np.split(ids, offsets[1:-1]) if texts else []

    def encode_flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, n + 1 offsets); null counts as empty. Only distinct pieces are looked up."""
        data, offsets = flat(texts)
        if not self.cuttable:
            whole = [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            ids = [np.array(e.ids, "<u4") for e in self.library.encode_batch_fast(whole, add_special_tokens=False)]
            return np.concatenate([np.zeros(0, "<u4"), *ids]), np.cumsum([0, *map(len, ids)])
        words, per = split_pieces(data, offsets)
        words = words.dictionary_encode()
        found = self._look_up(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids, ends = flat(pa.array(found, pa.large_binary()).take(words.indices))
        return ids.view("<u4"), ends[np.concatenate([[0], np.cumsum(per)])] // 4

    def _look_up(self, words: list[bytes]) -> list[bytes]:
        """The ids of each of some distinct words."""
        young, old = self.young, self.old
        found = list(map(young.get, words))
        missing = [k for k, ids in enumerate(found) if ids is None]
        if old:
            for k in missing:
                ids = old.get(words[k])
                if ids is not None:
                    young[words[k]] = found[k] = ids
            missing = [k for k in missing if found[k] is None]
        learned = self._words([words[k] for k in missing])
        young.update(learned)
        for k in missing:
            found[k] = learned[words[k]]
        for w in [w for w in learned if len(w) > MEMO_BYTES]:
            del young[w]
        if len(young) > MEMO_WORDS // 2:
            self.young, self.old = {}, young
        return found

    def _words(self, new: list[bytes]) -> dict[bytes, bytes]:
        young, old, merge, letters = self.young, self.old, self.library.model.tokenize, self.letters
        small = [w for w in new if not w.translate(None, _SMALL)]  # most are: letters that :func:`split_pieces` has cut out
        got = dict(zip(small, _merged(map(merge, [w.decode() if w.isascii() else charmap_decode(w, "strict", letters)[0] for w in small])), strict=True))
        cut: dict[bytes, tuple[bytes, bytes]] = {}
        ask: set[bytes] = set()
        for w in new:
            if w in got:
                continue
            low = w.decode().lower()
            core = low.rstrip(_PUNCTUATION)
            if not core.isalpha() or max(core) >= _PLAIN_LETTERS:
                ask.add(w)
                continue
            end, own = low[len(core) :].encode(), core.encode()
            if own not in got and own not in young and own not in old:
                got[own] = array("I", map(_ID, merge(core if core.isascii() else charmap_decode(own, "strict", letters)[0]))).tobytes()
            if end and end not in young and end not in old:
                ask.add(end)
            if w != own:
                cut[w] = own, end
        asked = list(ask)
        for at in range(0, len(asked), 4096):
            some = asked[at : at + 4096]
            for w, e in zip(some, self.library.encode_batch_fast([w.decode() for w in some], add_special_tokens=False), strict=True):
                got[w] = array("I", e.ids).tobytes()
        get = lambda w: got[w] if w in got else young[w] if w in young else old[w]
        for w, (own, end) in cut.items():
            got[w] = get(own) + get(end) if end else get(own)
        return got


def _merged(tokens: Iterable[list]) -> list[bytes]:
    """The ids of each list of the library's tokens."""
    lists = list(tokens)
    ids = array("I", map(_ID, chain.from_iterable(lists))).tobytes()
    return [ids[4 * a : 4 * b] for a, b in pairwise(accumulate(map(len, lists), initial=0))]


#: Pairs are counted by hashed slots first, few enough for a core's cache; pairs over a document's end are in the slot behind the last.
_SLOTS = 1 << 18


def _slot(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The slot of each pair; symbols are of 32 bits, and so is the arithmetic."""
    out = left.astype(np.uint32, copy=False) * np.uint32(0x9E3779B1)
    out += right.astype(np.uint32, copy=False) * np.uint32(0x85EBCA77)
    out &= np.uint32(_SLOTS - 1)
    return out.astype(np.intp)


def _apart(where: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which of the pairs at ascending places to replace: of pairs that overlap the better one, in a run of one pair each second."""
    n = len(where)
    touch = np.zeros(n + 1, bool)
    touch[1:n] = where[1:] == where[:-1] + 1
    left, right = np.append(rank[:1], rank[:-1]), np.append(rank[1:], rank[-1:])
    again = touch[:n] & (left == rank)
    index = np.arange(n)
    begin = np.maximum.accumulate(np.where(again, 0, index))
    even = (index - begin) % 2 == 0
    return np.flatnonzero(even & (again | ~touch[:n] | (rank < left)) & (~touch[1:] | (rank <= right)))


def _counted(seq: np.ndarray, slot: np.ndarray, full: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(pairs, their counts, places, pair at each place) of the slots with at least ``least`` places; a pair fills no more than its slot."""
    ok = np.append(full >= least, False)
    at = np.flatnonzero(ok.take(slot, mode="clip"))  # every slot is in range; numpy need not look
    keys = seq[at].astype(np.int64) << 32 | seq[at + 1]
    ordered = np.sort(keys)
    cut = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
    return ordered[cut], np.diff(np.append(cut, len(ordered))), at, keys


def repair(ids: np.ndarray, heads: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, heads, rules): pairs replaced by nonterminals base, base + 1, ... whose rules are pairs of earlier symbols.

    ``heads`` are the places of first ids of documents, the first of them 0; no pair goes over a document's end. A round counts the pairs, takes the frequent
    ones in order of frequency and replaces each occurrence that no better neighbour overlaps.
    """
    seq, rules, n_rules = ids.astype(np.uint32), [], 0
    for _ in range(ROUNDS):
        if len(seq) < 2:
            break
        slot = _slot(seq[:-1], seq[1:])
        slot[heads[1:] - 1] = _SLOTS
        full = np.bincount(slot, minlength=_SLOTS + 1)[:_SLOTS]
        pairs, counts, at, keys = _counted(seq, slot, full, max(LEAST, full.max() // STEP))
        if len(counts) and counts.max() < full.max():  # the fullest slot holds several pairs: the bar is lower than it told
            pairs, counts, at, keys = _counted(seq, slot, full, max(LEAST, counts.max() // STEP))
        if not len(counts) or counts.max() < LEAST:
            break
        often = counts >= max(LEAST, counts.max() // STEP)
        pairs, often = pairs[often], counts[often]
        order = np.argsort(-often, kind="stable")
        pairs = pairs[order]
        table = np.full(_SLOTS, -1, np.int32)
        table[_slot(pairs[::-1] >> 32, pairs[::-1] & 0xFFFFFFFF)] = np.arange(len(pairs) - 1, -1, -1)  # of pairs in one slot, the most frequent
        place = table[slot[at]]
        hit = (place >= 0) & (pairs[place] == keys)
        where, here = at[hit], place[hit]
        chosen = _apart(where, here)
        taken = np.zeros(len(pairs), bool)
        taken[here[chosen]] = True
        used, compact = np.flatnonzero(taken), (np.cumsum(taken) - 1)[here[chosen]]
        chosen = where[chosen]
        made = pairs[used]
        rules.append(np.stack([made >> 32, made & 0xFFFFFFFF], axis=1))
        seq[chosen] = (base + n_rules + compact).astype(np.uint32)
        n_rules += len(used)
        keep = np.ones(len(seq), bool)
        keep[chosen + 1] = False
        seq, heads = seq[keep], heads - np.searchsorted(chosen, heads - 1)
    return seq.astype(np.int64), heads, np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)


def expand(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids that symbols stand for."""
    while len(symbols) and symbols.max() >= base:
        pair = symbols >= base
        ends = np.cumsum(1 + pair)
        out = np.empty(ends[-1], np.int64)
        out[ends - 1] = np.where(pair, rules[np.where(pair, symbols - base, 0), 1] if len(rules) else symbols, symbols)
        out[ends[pair] - 2] = rules[symbols[pair] - base, 0]
        symbols = out
    return symbols


@dataclass
class Shard:
    """One shard: rules with their expansion lengths, symbols, and where each document's symbols begin.

    File format, little-endian: magic, then u8 counts (base, rules, symbols, documents), i8 document ids with i8 validity,
    u4 rule pairs, u4 expansion lengths, u4 symbols, u8 first symbol and u8 first id of each document with the totals at the end.
    """

    base: int
    rules: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray
    doc_ids: list[int | None]
    first_symbol: np.ndarray
    first_id: np.ndarray

    @classmethod
    def pack(cls, doc_ids: list[int | None], ids: list[np.ndarray]) -> Shard:
        """From the ids of documents; every document has one at least."""
        counts = np.array([len(x) for x in ids])
        first_id = np.concatenate([[0], np.cumsum(counts)])
        flat = np.concatenate(ids)
        base = int(flat.max()) + 1
        symbols, heads, rules = repair(flat, first_id[:-1], base)
        lengths = np.ones(base + len(rules), np.int64)
        for k, (a, b) in enumerate(rules.tolist()):
            lengths[base + k] = lengths[a] + lengths[b]
        return cls(base, rules, lengths[base:], symbols, doc_ids, np.append(heads, len(symbols)), first_id)

    def to_bytes(self) -> bytes:
        ids = np.array([0 if d is None else d for d in self.doc_ids], "<i8")
        valid = np.array([d is not None for d in self.doc_ids], "<i8")
        counts = np.array([self.base, len(self.rules), len(self.symbols), len(ids)], "<u8")
        arrays = [counts, ids, valid, self.rules.astype("<u4"), self.lengths.astype("<u4"), self.symbols.astype("<u4"), self.first_symbol.astype("<u8"), self.first_id.astype("<u8")]
        return _MAGIC + b"".join(a.tobytes() for a in arrays)

    @classmethod
    def from_bytes(cls, data: bytes) -> Shard:
        if data[:4] != _MAGIC:
            raise ValueError("not a shard")
        base, n_rules, n_symbols, n_docs = np.frombuffer(data, "<u8", 4, 4).astype(int).tolist()
        at = 36

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at).astype(np.int64)
            at += out.size * int(kind[2:])
            return out

        ids, valid = take("<i8", n_docs), take("<i8", n_docs)
        rules, lengths, symbols = take("<u4", 2 * n_rules).reshape(-1, 2), take("<u4", n_rules), take("<u4", n_symbols)
        named = [d if ok else None for d, ok in zip(ids.tolist(), valid.tolist(), strict=True)]
        return cls(base, rules, lengths, symbols, named, take("<u8", n_docs + 1), take("<u8", n_docs + 1))

    def ids(self) -> np.ndarray:
        """All ids: each rule is expanded once, and its expansion copied to wherever its nonterminal stands."""
        pool = expand(self.base + np.arange(len(self.rules)), self.rules, self.base)
        begin = np.cumsum(self.lengths) - self.lengths
        where = np.flatnonzero(self.symbols >= self.base)
        rule = self.symbols[where] - self.base
        size = np.ones(len(self.symbols), np.int64)
        size[where] = self.lengths[rule]
        ends = np.cumsum(size)
        out = np.repeat(self.symbols, size)
        long = size[where]
        past = np.cumsum(long)
        inside = np.arange(past[-1] if len(past) else 0) - np.repeat(past - long, long)
        out[np.repeat(ends[where] - long, long) + inside] = pool[np.repeat(begin[rule], long) + inside]
        return out

    def document(self, k: int) -> np.ndarray:
        """Ids of the k-th document; only its own symbols are expanded."""
        return expand(self.symbols[self.first_symbol[k] : self.first_symbol[k + 1]], self.rules, self.base)

    def slice(self, start: int, stop: int) -> np.ndarray:
        """Ids start to stop of the shard: expansion lengths find the symbols that hold them."""
        size = np.ones(len(self.symbols), np.int64)
        pair = self.symbols >= self.base
        size[pair] = self.lengths[self.symbols[pair] - self.base]
        ends = np.cumsum(size)
        a = int(np.searchsorted(ends, start, "right"))
        b = int(np.searchsorted(ends, stop, "left")) + 1
        before = int(ends[a - 1]) if a else 0
        return expand(self.symbols[a:b], self.rules, self.base)[start - before : stop - before]


SHARDS = "part int, seq int, n_ids long, body binary"
_LOADED: dict[str, WordTokenizer] = {}


def _tokenizer(definition: str) -> WordTokenizer:
    """A worker process keeps its last tokenizer, and what that remembers, from task to task."""
    if definition not in _LOADED:
        _LOADED.clear()
        _LOADED[definition] = WordTokenizer(definition)
    return _LOADED[definition]


def write_shards(docs: DataFrame, definition: str, id_col: str = "doc_id", text_col: str = "text", shard_ids: int = SHARD_IDS, end_id: int = END_ID) -> DataFrame:
    """(part, seq, n_ids, body): the ids of all whole texts, ``end_id`` after each document, in ascending doc_id order.

    Documents are range-partitioned and sorted by doc_id (null first; equal ids by text); a task cuts its range into shards and
    holds one at a time. (part, seq) is the order of the shards. Null texts count as empty: the end id only. Repeated
    rows are documents of their own. An empty table has no shards. The tokenizer's definition goes to the tasks once.
    """
    packed = docs.sparkSession.sparkContext.broadcast(definition)

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed()
        tokenizer, part = _tokenizer(packed.value), TaskContext.get().partitionId()
        names: list[int | None] = []
        ids: list[np.ndarray] = []
        size = seq = 0
        for batch in batches:
            for some in slices(batch):
                found, offsets = tokenizer.encode_flat(some.column("text"))
                found = np.insert(found, offsets[1:], end_id)
                offsets = (offsets + np.arange(len(offsets))).tolist()
                for name, a, b in zip(some.column("doc_id").to_pylist(), offsets[:-1], offsets[1:], strict=True):
                    names.append(name)
                    ids.append(found[a:b])
                    size += b - a
                    if size >= shard_ids:
                        yield _shard(part, seq, size, names, ids)
                        names, ids, size, seq = [], [], 0, seq + 1
        if names:
            yield _shard(part, seq, size, names, ids)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(run, SHARDS)


def _shard(part: int, seq: int, size: int, names: list, ids: list) -> pa.RecordBatch:
    body = Shard.pack(names, ids).to_bytes()
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([size], pa.int64()), pa.array([body], pa.binary())], ["part", "seq", "n_ids", "body"])


_READ = "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long"


def read_shards(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the shards, from their decoded ids."""

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed()
        for batch in batches:
            for r in range(len(batch)):
                shard = Shard.from_bytes(batch.column("body")[r].as_py())
                ids = shard.ids().astype("<u4").tobytes()
                bounds = shard.first_id
                crcs = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                n = len(crcs)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column("part")[r].as_py()] * n, pa.int32()),
                        pa.array([batch.column("seq")[r].as_py()] * n, pa.int32()),
                        pa.array(shard.doc_ids, pa.int64()),
                        pa.array(bounds[:-1]),
                        pa.array(np.diff(bounds)),
                        pa.array(crcs, pa.int64()),
                    ],
                    ["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"],
                )

    sizes = shards.select("part", "seq", "n_ids")
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(whole), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(parts, "part").select("part", "seq", (F.col("before") + F.col("inside")).alias("base"))
    found = shards.select("part", "seq", "body").mapInArrow(run, _READ)
    return found.join(starts, ["part", "seq"]).select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, definition: str, **options) -> DataFrame:
    """Shards written to the shared folder and read back."""
    return read_shards(stored(write_shards(docs, definition, **options), "shards"))
