"""Plain versions of the operators' contracts, one document at a time."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def leaks(text, items, window=10):
    """(n_words, n_hit, items found) of a document."""
    w = words(text)
    hit, found = set(), set()
    for name, item in items:
        x = words(item)
        n = min(window, len(x))
        windows = {tuple(x[k : k + n]) for k in range(len(x) - n + 1)} if n else set()
        for k in range(len(w) - n + 1) if n else ():
            if tuple(w[k : k + n]) in windows:
                hit.update(range(k, k + n))
                found.add(str(name))
    return len(w), len(hit), sorted(found)


def licenses(text):
    w = words(text)
    phrases = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
    places = [(k, label) for label, p in phrases.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
    at = [k for k, _ in places]
    return len(w), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


KINDS = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile("[0-9a-f]+"), 0, 32),
)


def secrets(text):
    spans = [(m.start(), k, name, m.end()) for k, (name, p, g, least) in enumerate(KINDS) for m in p.finditer(text or "") if len(m.group(g)) >= least]
    return [sum(s[1] == k for s in spans) for k in range(3)], ",".join(f"{n}:{a}:{b}" for a, _, n, b in sorted(spans))


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = text or ""
    w = TOKEN.findall(text)
    lines = [x for x in text.split("\n") if TOKEN.search(x)]
    grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    seen = Counter(grams)
    covered = {k + j for k, g in enumerate(grams) if seen[g] > 1 for j in range(3)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def near(docs, threshold=0.8, gram=5):
    """{doc_id: (class_id, links)} over (doc_id, text), all pairs."""
    content, ids = {}, {}
    for i, text in docs:
        w = words(text)
        key = frozenset(tuple(w[k : k + gram]) for k in range(max(1, len(w) - gram + 1))) if w else (text or "")
        content.setdefault(key, []).append(i)
        ids[i] = key
    keys = list(content)
    parent = {k: k for k in keys}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = Counter()
    for a in range(len(keys)):
        for b in range(a + 1, len(keys)):
            x, y = keys[a], keys[b]
            if isinstance(x, frozenset) and isinstance(y, frozenset) and len(x & y) >= threshold * len(x | y) - 1e-12:
                links[x] += 1
                links[y] += 1
                parent[root(x)] = root(y)
    smallest = {}
    for i, k in ids.items():
        r = root(k)
        smallest[r] = min(smallest.get(r, i), i)
    return {i: (smallest[root(k)], links[k]) for i, k in ids.items()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
