"""Plain versions of what the operators compute."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def rule_counts(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    many = Counter(grams)
    repeated = {j for i, g in enumerate(grams) if many[g] > 1 for j in range(i, i + 5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    n = len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = n < 10 or 100 * len(repeated) > 20 * n
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated), failed


def components(rows, size, percent):
    """{doc_id: (set size, smallest id reachable)} of rows with an id."""
    sets = defaultdict(list)
    for i, text in rows:
        words = WORD.findall((text or "").translate(LOWER))
        if len(words) >= size:
            own = frozenset(tuple(words[p : p + size]) for p in range(len(words) - size + 1))
        else:
            own = frozenset([tuple(words)]) if words else frozenset()
        sets[i].append(own)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}, {i: sorted(len(s) for s in sets[i]) for i in ids}


def substrings(rows, k=13):
    docs = [(i, WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, words in docs:
        if i is not None:
            for p in range(len(words) - k + 1):
                key = tuple(words[p : p + k])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, words in docs:
        gone = set()
        if i is not None:
            for p in range(len(words) - k + 1):
                if first[tuple(words[p : p + k])] < i:
                    gone.update(range(p, p + k))
        kept = " ".join(w for j, w in enumerate(words) if j not in gone)
        out.append((i, len(words), len(gone), kept))
    return out


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def pii_spans(text):
    out = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text or ""):
            value = m.group()
            digits = re.sub("[^0-9]", "", value)
            ok = {
                "email": lambda: True,
                "ip": lambda value=value: all(int(p) <= 255 for p in value.split(".")),
                "card": lambda digits=digits: 16 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda digits=digits: 8 <= len(digits) <= 15,
            }[kind]()
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
