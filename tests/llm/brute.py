"""Plain-Python statements of the results that the operators must give."""

import hashlib
import re
from collections import Counter

import xxhash

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def substring(rows, width=13):
    """rows (doc_id, text) -> [(doc_id, n_words, n_removed, kept_sha256)]"""
    words = [(i, SPACE_WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        if i is not None:
            for k in range(len(w) - width + 1):
                x = tuple(w[k: k + width])
                first[x] = min(i, first.get(x, i))
    out = []
    for i, w in words:
        gone = [False] * len(w)
        if i is not None:
            for k in range(len(w) - width + 1):
                if first[tuple(w[k: k + width])] < i:
                    gone[k: k + width] = [True] * width
        out.append((i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    return out


def fingerprint(text, n=4):
    w = SPACE_WORD.findall(lower(text))
    if not w:
        return 0
    shingles = [" ".join(w[k: k + n]) for k in range(max(1, len(w) - n + 1))]
    ones = Counter()
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        ones.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def near(rows, bits=4):
    """rows (doc_id, text) -> [(doc_id, fingerprint, component_id)]"""
    prints = [fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    names = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            names[find(k)] = min(i, names.get(find(k), i))
    return [(i, f"{prints[k]:016x}", names.get(find(k))) for k, (i, _) in enumerate(rows)]


def quality_base(text):
    text = text or ""
    w = SPACE_WORD.findall(text)
    windows = Counter(tuple(w[k: k + 3]) for k in range(len(w) - 2))
    covered = {k + j for k in range(len(w) - 2) if windows[tuple(w[k: k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if SPACE_WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def hits(rows, items, width=13):
    """-> [(doc_id, n_words, n_hit, items, contaminated)]"""
    strings = {}
    for item, text in items:
        w = LOW_WORD.findall(lower(text))
        size = min(width, len(w))
        if item is not None and size:
            for k in range(len(w) - size + 1):
                strings.setdefault(tuple(w[k: k + size]), set()).add(str(item))
    out = []
    for i, text in rows:
        w = LOW_WORD.findall(lower(text))
        hit, found = [False] * len(w), set()
        for size in {len(s) for s in strings}:
            for k in range(len(w) - size + 1):
                if (got := strings.get(tuple(w[k: k + size]))):
                    found |= got
                    hit[k: k + size] = [True] * size
        n = sum(hit)
        out.append((i, len(w), n, sorted(found), n > 0 and 20 * n >= len(w)))
    return out


def spread_lines(rows, limit=10):
    """rows (doc_id, text, site) -> [(doc_id, n_lines, n_removed, kept text)]"""
    sites, first, nameless = {}, {}, set()
    for i, text, site in rows:
        for line in (text or "").split("\n"):
            if SPACE_WORD.search(line):
                sites.setdefault(line, set()).update([] if site is None else [site])
                if i is not None:
                    first[line] = min(i, first.get(line, i))
    out = []
    for i, text, _ in rows:
        if text is None:
            out.append((i, 0, 0, None))
            continue
        lines = text.split("\n")
        lost = [SPACE_WORD.search(x) is not None and len(sites[x]) >= limit and (i is None or first.get(x) != i) for x in lines]
        out.append((i, sum(SPACE_WORD.search(x) is not None for x in lines), sum(lost), "\n".join(x for x, g in zip(lines, lost, strict=True) if not g)))
    return out


def key(row):
    return tuple((x is None, str(x)) for x in row)
