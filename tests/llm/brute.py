"""Plain versions of the contracts, for small inputs."""

import hashlib
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def fingerprint(text):
    words = WORD.findall(lower(text))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(fingerprints, radius=4):
    """Place -> smallest place reachable."""
    parent = list(range(len(fingerprints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(fingerprints):
        for j in range(i):
            if bin(a ^ fingerprints[j]).count("1") <= radius:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(fingerprints))]


def quality_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if twice[w] > 1:
            covered.update(range(i, i + 5))
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            duplicates += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), duplicates, len(covered)


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return [(a, k, b) for a, _, k, b in sorted(out)]


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()


def contamination(docs, items, window=10):
    """[(n_words, n_hit, sorted item ids)] per text."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for item, text in items:
        words = word.findall(lower(text))
        for i in range(max(1, len(words) - window + 1) if words else 0):
            windows.setdefault(tuple(words[i : i + window]), set()).add("" if item is None else str(item))
    out = []
    for text in docs:
        words, hit, found = word.findall(lower(text)), set(), set()
        for w, owners in windows.items():
            for i in range(len(words) - len(w) + 1):
                if tuple(words[i : i + len(w)]) == w:
                    hit.update(range(i, i + len(w)))
                    found |= owners
        out.append((len(words), len(hit), sorted(found)))
    return out
