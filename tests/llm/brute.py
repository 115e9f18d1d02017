"""Brute-force versions of the training-data operators, and documents with every odd case."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def invented(n, seed, words=400):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(words)]
    return " ".join(rng.choice(vocab) for _ in range(n))


def odd_documents():
    """(doc_id, text, lang, source, n_chars): nulls, empty and long texts, repeated rows, shared passages."""
    shared = invented(60, 1)
    rows = [(1, None, "en", "a", 0), (2, "", None, None, None), (3, " \n\t\r\x0b ", "en", "a", 6), (4, "Word", "en", "a", 4),
            (5, invented(20_000, 2, 5000), "de", "b", 0), (6, invented(80, 3) + "\n" + shared, "en", "a", 0),
            (6, invented(80, 3) + "\n" + shared, "en", "a", 0), (7, shared.upper() + " " + invented(30, 4), "en", "a", 0),
            (8, "Tail " + shared + " tail. " + invented(50, 5), "en", None, 0), (None, invented(40, 6) + " " + shared, "en", "a", 0),
            (None, None, None, None, None), (9, "a a a a a a a a a a a a a a a a a a a a", "en", "a", 0),
            (10, "Ünïcode — tëxt, naïve café x y é ǅ İ 日本語 🙂 ok.", "fr", "b", 0),
            (11, "a b c\na b c\nx\n\nx\n \n", "en", "a", 0), (12, invented(200, 7), "en", "a", 0), (13, invented(200, 7), "en", "a", 0)]
    rows += [(100 + i, invented(120, 50 + i) + ("\n" + shared if i % 4 == 0 else ""), "en", "big", 0) for i in range(60)]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def base_statistics(text):
    words = SPACED.findall(text or "")
    triples = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i in range(len(words) - 2):
        if triples[tuple(words[i:i + 3])] > 1:
            covered.update((i, i + 1, i + 2))
    lines = [x for x in (text or "").split("\n") if SPACED.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def windows(item_text, size=10):
    words = ALNUM.findall(low(item_text))
    return [tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))] if words else []


def occurrences(text, items):
    """(words, hit words, ids) of a text against items (id, text)."""
    words, hit, ids = ALNUM.findall(low(text)), set(), set()
    for item, item_text in items:
        for w in windows(item_text):
            for i in range(len(words) - len(w) + 1):
                if tuple(words[i:i + len(w)]) == w:
                    hit.update(range(i, i + len(w)))
                    if item is not None:
                        ids.add(str(item))
    return len(words), hit, sorted(ids)


def repeats(rows, size=13):
    """Removed word positions of each (doc_id, text) row."""
    first = {}
    for doc, text in rows:
        words = SPACED.findall(text or "")
        for i in range(len(words) - size + 1):
            if doc is not None:
                k = tuple(words[i:i + size])
                first[k] = min(first.get(k, doc), doc)
    out = []
    for doc, text in rows:
        words, gone = SPACED.findall(text or ""), set()
        for i in range(len(words) - size + 1):
            least = first.get(tuple(words[i:i + size]))
            if least is not None and (doc is None or least < doc):
                gone.update(range(i, i + size))
        out.append((words, gone))
    return out


def components(fingerprints, bits=3):
    """Component number of each fingerprint by comparing all pairs."""
    parent = list(range(len(fingerprints)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a
    for i, a in enumerate(fingerprints):
        for j in range(i):
            if ((a ^ fingerprints[j]) & (2 ** 64 - 1)).bit_count() <= bits:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(fingerprints))]


class Katz:
    """Dictionary version of the backoff model over tokenised training texts."""

    def __init__(self, texts, discounts, count_classes, cut):
        import numpy as np
        self.c, self.b, self.x, self.cut = Counter(), Counter(), Counter(), cut
        for t in texts:
            self.c.update(t)
            pairs = list(zip(["<s>", *t], t))
            self.b.update(pairs)
            self.x.update(u for u, _ in pairs)
        classes = lambda c: count_classes(np.array(list(c.values()) or [0]))
        self.d1, self.d2 = discounts(classes(self.c)), discounts(classes(self.b))
        self.n, self.v = sum(self.c.values()), len(self.c)
        kept = sum(self.less(self.d1, r) for r in self.c.values())
        self.total = self.n + (self.n - kept < 1e-9)
        self.unknown = (self.total - kept) / self.total
        mass, seen = Counter(), Counter()
        for (u, w), r in self.b.items():
            mass[u] += self.less(self.d2, r)
            seen[u] += self.one(w)
        self.den = {u: r + (r - mass[u] < 1e-9 * r) for u, r in self.x.items()}
        self.alpha = {u: (self.den[u] - mass[u]) / self.den[u] / (1 - seen[u]) for u in self.x}

    def less(self, d, r):
        return r * (d[r] if r <= self.cut else 1)

    def one(self, w):
        return self.less(self.d1, self.c[w]) / self.total if self.c[w] else self.unknown

    def p(self, u, w):
        if u not in self.x:
            return self.one(w)
        r = self.b[(u, w)]
        return self.less(self.d2, r) / self.den[u] if r else self.alpha[u] * self.one(w)

    def score(self, text):
        return sum(math.log10(self.p(u, w)) for u, w in zip(["<s>", *text], text))

    def base(self, text):
        return sum(math.log10((self.c[w] + 1) / (self.n + self.v + 1)) for w in text)
