"""Plain re-statements of what the operators compute, for small fixtures."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, lower=True):
    text = text or ""
    return WORD.findall(text.translate(UPPER) if lower else text)


def shingles(text, n):
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))}


def components(docs, n, percent):
    """{row: smallest id reachable} of [(id, text)] by comparing all pairs; ids may repeat."""
    sets = [shingles(t, n) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    ids = {}
    for i, (doc, _) in enumerate(docs):
        ids.setdefault(root(i), []).append(doc)
    low = {r: min((x for x in found if x is not None), default=None) for r, found in ids.items()}
    return [low[root(i)] for i in range(len(docs))]


def crc(doc):
    return zlib.crc32(str(doc).encode())


def unigram(train, text):
    """(tokens, known, training tokens, score) of the add-one unigram."""
    counts = Counter(t for x in train for t in [*words(x), None])
    n, v = sum(counts.values()), len(counts)
    tokens = [*words(text), None]
    return len(tokens), sum(t in counts for t in tokens), n, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)


def repetition(text, window=8):
    text = text or ""
    w = words(text, lower=False)
    where = {}
    for i in range(len(w) - window + 1):
        where.setdefault(tuple(w[i : i + window]), []).append(i)
    marked = {j for at in where.values() if len(at) > 1 for i in at for j in range(i, i + window)}
    seen, again, again_chars = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            again_chars += len(line) if line in seen else 0
            seen.add(line)
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": again,
        "n_repeat_words": len(marked),
        "repeat_chars": sum(len(w[j]) for j in marked),
        "dup_line_chars": again_chars,
        "chars": len(text),
    }


def smith_waterman(a, b, match=2, mismatch=-1, gap=-1):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(max(0, row[j - 1] + (match if x == y else mismatch), row[j] + gap, new[-1] + gap))
            best = max(best, new[-1])
        row = new
    return best


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def personal(text):
    """[(start, kind, end)] of the base kinds by the patterns as they are."""
    out = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else False,
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), rank, kind, m.end()))
    return [(s, k, e) for s, _, k, e in sorted(out)]
