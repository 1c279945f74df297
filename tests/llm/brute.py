"""Plain versions of the operators' contracts, over Python lists."""

import hashlib
import math
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, size):
    w = words(lower(text))
    if not w:
        return set()
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if len(w) >= size else {tuple(w)}


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_duplicates(docs, size, percent=80):
    """docs: [(doc_id, text)] with distinct ids. {doc_id: (n_shingles, component)}"""
    sets = {i: shingles(t, size) for i, t in docs}
    links, by_item = [], {}
    for i, s in sets.items():
        seen = {}
        for x in s:
            for j in by_item.setdefault(x, []):
                seen[j] = seen.get(j, 0) + 1
            by_item[x].append(i)
        links += [(i, j) for j, c in seen.items() if 100 * c >= percent * (len(s) + len(sets[j]) - c)]
    root = components(list(sets), links)
    return {i: (len(s), root[i]) for i, s in sets.items()}


def linked_vectors(rows, cosine=0.98):
    """rows: [(vec_id, vector or None, label)] with distinct ids. {vec_id: (n_links, component)}"""
    def valid(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    good = [(i, [float(x) for x in v], label) for i, v, label in rows if label is not None and valid(v)]
    count, links = {i: 0 for i, _, _ in rows}, []
    for a, (i, v, x) in enumerate(good):
        for j, w, y in good[:a]:
            if x == y and len(v) == len(w):
                dot = sum(p * q for p, q in zip(v, w))
                if dot / math.sqrt(sum(p * p for p in v) * sum(q * q for q in w)) >= cosine:
                    links.append((i, j))
                    count[i] += 1
                    count[j] += 1
    root = components(list(count), links)
    return {i: (count[i], root[i]) for i in count}


def secrets(text):
    """(kind, start, end) of the three known kinds, ordered."""
    text = text or ""
    out = []
    key = re.compile(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out += [(m.start(), 0, m.end()) for m in key.finditer(text) if len(m.group(1)) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 32]
    return [(["assign", "access", "hex"][k], s, e) for s, k, e in sorted(out)]


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)"""
    text = text or ""
    w = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    places = {}
    for i in range(len(w) - 7):
        places.setdefault(tuple(w[i : i + 8]), []).append(i)
    covered = {i + k for p in places.values() if len(p) > 1 for i in p for k in range(8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def sha256(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()
