"""Plain Python versions of the operators' fixed parts, for comparison in tests."""

import hashlib
import re

KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal(text: str | None) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of every valid match, sorted."""
    out = []
    for i, kind in enumerate(KINDS):
        for m in re.finditer(PATTERNS[kind], text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip":
                ok = all(int(p) <= 255 for p in m[0].split("."))
            elif kind == "card":
                ok = 14 <= len(digits) <= 19 and luhn(digits)
            else:
                ok = kind == "email" or 10 <= len(digits) <= 15
            if ok:
                out.append((m.start(), i, m.end()))
    return sorted(out)


def personal_text(text: str | None) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in personal(text))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))


def ascii_lower(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def license_places(text: str | None) -> tuple[int, list[int], str]:
    """Number of words, places of base phrases, base labels."""
    words = LICENSE_WORD.findall(ascii_lower(text or ""))
    places, labels = [], set()
    for phrase, label in PHRASES:
        p = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), sorted(places), ",".join(sorted(labels))


def shingles(text: str | None, k: int) -> frozenset:
    words = ascii_lower(text or "").encode().split()
    if not words:
        return frozenset()
    if len(words) < k:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def components(texts: dict, k: int, percent: int) -> dict:
    """Smallest id reachable by links, per id, from all pairs."""
    ids = sorted(texts)
    sets = {i: shingles(texts[i], k) for i in ids}
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def class_links(texts: dict, k: int, percent: int) -> dict:
    """The number of other distinct sets that each id's set is linked to, from all pairs."""
    sets = {i: shingles(t, k) for i, t in texts.items()}
    distinct = list(set(sets.values()))
    many = {s: 0 for s in distinct}
    for n, a in enumerate(distinct):
        for b in distinct[:n]:
            both = len(a & b)
            if both and 100 * both >= percent * (len(a) + len(b) - both):
                many[a] += 1
                many[b] += 1
    return {i: many[s] for i, s in sets.items()}
