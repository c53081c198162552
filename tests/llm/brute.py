"""Slow, plain versions of the operators, for comparison."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^ \t-\r]+")


def words(text):
    return WORD.findall(text or "")


def exact(rows):
    """{doc_id: (keep_id, group_size, sha)} of (doc_id, text) with different ids."""
    groups = defaultdict(list)
    for d, t in rows:
        groups[re.sub(r"[ \t-\r]+", " ", t or "")].append(d)
    return {d: (min(ids), len(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for d in ids}


def grams(text, n=5):
    w = words(text)
    if 0 < len(w) < n:
        return {tuple(w)}
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def jaccard_classes(rows, up=5, down=4):
    """{doc_id: (class_id, n_links)}: links where up * common >= down * union."""
    sets = [(d, grams(t)) for d, t in rows]
    links, edges = Counter(), []
    holders = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for g in s:
            holders[g].append(i)
    for i, (d, s) in enumerate(sets):
        common = Counter(j for g in s for j in holders[g] if j > i)
        for j, c in common.items():
            e, t = sets[j]
            if up * c >= down * (len(s) + len(t) - c):
                links[d] += 1
                links[e] += 1
                edges.append((d, e))
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {d: (find(d), links[d]) for d, _ in sets}


def line_facts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    w = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    counts, marked = Counter(windows), set()
    for i, x in enumerate(windows):
        if counts[x] > 1:
            marked.update(range(i, i + 5))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(marked)


def line_verdicts(rows, least, most=50, min_words=10):
    """{doc_id: (base_failed, removed_words, kept)} of (doc_id, text, source)."""
    norm = lambda x: " ".join(words(x.lower()))
    docs = defaultdict(set)
    for _, t, s in rows:
        for line in (t or "").split("\n"):
            if words(line):
                docs[s, norm(line)].add(t or "")
    out = {}
    for d, t, s in rows:
        n, _, _, _, r = line_facts(t)
        failed = n < min_words or 100 * r > 20 * n
        gone = sum(
            len(words(x))
            for x in (t or "").split("\n")
            if words(x) and len(docs[s, norm(x)]) > least
        )
        out[d] = (failed, gone, not failed and n - gone >= min_words and 100 * gone <= most * n)
    return out


def pieces(text, tokenizer, capacity=2048):
    ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
    return [
        (k, at, len(part), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part)))
        for k, at in enumerate(range(0, len(ids), capacity))
        for part in [ids[at : at + capacity]]
    ]


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """{source: target} by resharing, sources by code point, null last."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in full]
        if not rest:
            return full
        free = total - sum(full.values())
        got = {s: free * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = [s for s in rest if got[s] > most * sizes[s]]
        if not over:
            return full | got
        full |= {s: float(most * sizes[s]) for s in over}
