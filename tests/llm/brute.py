"""Plain single-process forms of what the operators compute."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rules(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(grams)
    inside = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


def fingerprint(text: str | None) -> int:
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reach(items: list[int], near) -> dict[int, int]:
    """Index of each item's component: the smallest index it reaches."""
    root = list(range(len(items)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(items)):
        for j in range(i):
            if near(items[i], items[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in range(len(items))}


def covered(texts: list[tuple[int, bytes]], span: int = 50) -> list[np.ndarray]:
    """Per text, which bytes lie in strings that also start in a text with a smaller id."""
    low: dict[bytes, int] = {}
    for doc, t in texts:
        for s in range(len(t) - span + 1):
            w = t[s : s + span]
            low[w] = min(low.get(w, doc), doc)
    out = []
    for doc, t in texts:
        hit = np.zeros(len(t), bool)
        for s in range(len(t) - span + 1):
            if low[t[s : s + span]] < doc:
                hit[s : s + span] = True
        out.append(hit)
    return out


def line_dedup(docs: list[tuple[int, str]], window: int = 3, min_words: int = 50) -> list[str]:
    """Texts in order without lines of runs that occur earlier."""
    units: dict[tuple[str, ...], tuple[int, int]] = {}
    listed = []
    for d, (_, text) in enumerate(docs):
        lines = text.split("\n")
        at = [i for i, x in enumerate(lines) if WORD.search(x)]
        for i in range(len(at)):
            for n in (1, 2, window):
                if i + n > len(at):
                    continue
                run = tuple(lines[j] for j in at[i : i + n])
                counts = [len(WORD.findall(x)) for x in run]
                if n == window or n == 1 and counts[0] >= min_words or n == 2 and max(counts) < min_words <= sum(counts):
                    first = units.setdefault(run, (d, i))
                    listed.append((d, i, n, at, first))
    gone = {(d, at[i + k]) for d, i, n, at, (fd, fi) in listed for k in range(n) if (i >= fi + n if fd == d else True)}
    return ["\n".join(x for i, x in enumerate(text.split("\n")) if (d, i) not in gone) for d, (_, text) in enumerate(docs)]
