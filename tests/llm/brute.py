"""Plain one-process statements of what the operators must return."""

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def line_measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = Counter(zip(w, w[1:], w[2:]))
    inside = {j for i in range(len(w) - 2) if n[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


def components(links, nodes):
    """Smallest node reachable from each node."""
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for start in sorted(nodes):
        todo = [start]
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = start
                todo += near[x]
    return out


BASE = [
    ("assign", re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"""
                          r"""[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
]


def base_secrets(text):
    """Sorted (start, kind number, end) of the base patterns."""
    return sorted((m.start(), k, m.end()) for k, (_, p, g, n) in enumerate(BASE) for m in p.finditer(text or "") if len(m[g]) >= n)


def base_text(spans):
    return ",".join(f"{BASE[k][0]}:{s}:{e}" for s, k, e in spans)


def simhash(text, n=3):
    import xxhash

    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    w = words(low)
    grams = [w] if 0 < len(w) < n else [w[i:i + n] for i in range(len(w) - n + 1)]
    h = [xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def remove_repeats(texts, n=50):
    """Kept words of each document of ``{doc_id: text}`` and how many went."""
    first = {}
    for d in sorted(texts):
        w = words(texts[d])
        for i in range(len(w) - n + 1):
            first.setdefault(tuple(w[i:i + n]), d)
    out = {}
    for d, text in texts.items():
        w = words(text)
        gone = {j for i in range(len(w) - n + 1) if first[tuple(w[i:i + n])] < d for j in range(i, i + n)}
        out[d] = len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)
    return out
