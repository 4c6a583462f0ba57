"""Plain-Python versions of the operators, for small inputs."""

from __future__ import annotations

import re
from collections import Counter, defaultdict


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def spaced(text):
    return [w for w in re.split(r"[\x20\x09-\x0d]+", lower(text)) if w]


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def shingles(text):
    w = spaced(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def linked(x, y):
    return bool(x) and bool(y) and 100 * len(x & y) >= 75 * len(x | y)


def near_components(rows):
    """[(doc_id, text)] -> [(doc_id, n_shingles, component_id)]"""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    at = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            at[g].append(i)
    for i, s in enumerate(sets):
        for j in {j for g in s for j in at[g] if j < i}:
            if linked(s, sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def windows(items, width=10):
    out = defaultdict(set)
    for item_id, text in items:
        w = alnum(text)
        for i in range(max(1, len(w) - width + 1)):
            if w:
                out[tuple(w[i:i + width])].add(item_id)
    return out


def contamination(text, found):
    w, hit, items = alnum(text), set(), set()
    for size in {len(k) for k in found}:
        for i in range(len(w) - size + 1):
            if own := found.get(tuple(w[i:i + size])):
                hit |= set(range(i, i + size))
                items |= own
    return len(w), len(hit), sorted(map(str, items))


def term_matches(text, found, corpus, width=10):
    """(terms, start, kind) of each window: at every posting of its rarest term (ties: the earliest) the exact
    phrase, or else a neighbourhood of ``width`` - 1 words on either side that holds all its terms."""
    count, w, out = Counter(x for t in corpus for x in alnum(t)), alnum(text), set()
    for terms in found:
        off = min(range(len(terms)), key=lambda i: (count[terms[i]], i))
        for pos in (p for p, x in enumerate(w) if x == terms[off]):
            lo = max(0, pos - width + 1)
            if pos >= off and tuple(w[pos - off:pos - off + len(terms)]) == terms:
                out.add((terms, pos - off, "phrase"))
            elif set(terms) <= set(w[lo:pos + width]):
                out.add((terms, lo, "proximity"))
    return out


def bigram_model(texts, discounts):
    """p(w | u), unigram counts, N and V of the training texts; 0 is the end, 1 the start."""
    toks = [spaced(t) + [0] for t in texts]
    uni = Counter(w for x in toks for w in x)
    pairs = Counter(p for x in toks for p in zip([1] + x[:-1], x))
    total, kinds, before = Counter(), defaultdict(lambda: [0] * 4), Counter()
    for (u, w), c in pairs.items():
        total[u] += c
        kinds[u][min(c, 3)] += 1
        before[w] += 1
    of = lambda c: discounts(*(sum(v == k for v in c.values()) for k in (1, 2, 3, 4)))
    d, e, n, v = of(pairs), of(before), len(pairs), len(uni)
    mass = sum(e[min(x, 3)] for x in before.values()) / n

    def p(u, w):
        low = max(before[w] - e[min(before[w], 3)], 0) / n + mass / (v + 1)
        if u not in total:
            return low
        c, k = pairs[u, w], kinds[u]
        return (max(c - d[min(c, 3)], 0) + (d[1] * k[1] + d[2] * k[2] + d[3] * k[3]) * low) / total[u]

    return p, uni, sum(uni.values()), v
