"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re

_KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def _valid(kind: str, value: str) -> bool:
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and _luhn(digits)
    if kind == "phone":
        return 10 <= len(digits) <= 15
    return True


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    found = [
        (m.start(), place, m.end(), kind)
        for place, (kind, pattern) in enumerate(_KINDS.items())
        for m in re.finditer(pattern, text or "")
        if _valid(kind, m.group())
    ]
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def fingerprint(text: str | None, shingle: int = 4) -> int:
    import xxhash

    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def components(prints: list[int], distance: int) -> list[int]:
    """For each fingerprint the first place of its component."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(prints):
        for j in range(i):
            if (x ^ prints[j]).bit_count() <= distance:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


def words_of(text: str | None) -> list[str]:
    import string

    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for mark in string.punctuation:
        lower = lower.replace(mark, " ")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def tiling(doc: list[str], item: list[str], least: int) -> int:
    """Covered words of the item by greedy string tiling, straight from its definition."""
    in_doc, in_item, covered = [False] * len(doc), [False] * len(item), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while (
                    i + n < len(item) and d + n < len(doc) and item[i + n] == doc[d + n]
                    and not in_item[i + n] and not in_doc[d + n]
                ):
                    n += 1
                if n > best[0]:
                    best = (n, i, d)
        n, i, d = best
        if n < least:
            return covered
        covered += n
        in_item[i : i + n] = in_doc[d : d + n] = [True] * n


def kept_of_equal(rows: list[tuple]) -> set[int]:
    """Places of the rows (doc_id, text) that exact dedup keeps."""
    best = {}
    for place, (doc_id, text) in enumerate(rows):
        text = text or ""
        rank = (-len(text), doc_id is None, doc_id or 0, place)
        key = re.sub(r"[\x20\x09-\x0D]", "", text)
        best[key] = min(best.get(key, rank), rank)
    return {rank[-1] for rank in best.values()}
