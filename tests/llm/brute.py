"""Plain Python versions of the operators' results, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def simhash(text: str | None) -> int:
    words = WORD.findall(lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(links: list[tuple], nodes) -> dict:
    """Smallest node reachable from each node."""
    label = {n: n for n in nodes}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            label[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def simhash_rows(docs: list[tuple]) -> list[tuple]:
    """(doc_id, fingerprint, component_id) of (doc_id, text) rows."""
    fps = [simhash(t) for _, t in docs]
    distinct = sorted(set(fps))
    x = np.array(distinct, np.uint64)
    links = []
    for i in range(len(x)):
        near = np.flatnonzero(np.bitwise_count(x ^ x[i]) <= 3)
        links += [(distinct[i], distinct[j]) for j in near if j > i]
    comp = components(links, distinct)
    ids = defaultdict(list)
    for (doc_id, _), fp in zip(docs, fps):
        if doc_id is not None:
            ids[comp[fp]].append(doc_id)
    return [(d, f"{fp:016x}", min(ids[comp[fp]], default=None)) for (d, _), fp in zip(docs, fps)]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text: str | None) -> list[tuple[int, int, int, str]]:
    """(start, order, end, kind) of confirmed base spans, sorted."""
    out = []
    for order, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            s, digits = m[0], re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": all(int(p) <= 255 for p in s.split(".")) if kind == "ip" else False,
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), order, m.end(), kind))
    return sorted(out)


def told(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in spans)


def pii_row(doc_id, text) -> tuple:
    spans = base_spans(text)
    n = Counter(s[3] for s in spans)
    return (doc_id, *(n[k] for k in BASE), hashlib.sha256(told(spans).encode()).hexdigest())


def quality_row(doc_id, text) -> tuple:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered.update(range(i, i + 5))
    n, symbols = len(words), len(re.findall(r"[#*$%&|<>]", text))
    base = n < 10 or 100 * len(covered) > 20 * n
    letters = sum(c.isalpha() for c in text)
    capitals = sum(c.isupper() for c in text)
    echoes = sum(a == b for a, b in zip(words, words[1:]))
    bad = 10 * symbols > n or (10 * capitals > 4 * letters and letters >= 40) or 10 * echoes > 3 * n
    return (doc_id, n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), base, not (base or bad))


def crc(text: str) -> int:
    return zlib.crc32(text.encode())
