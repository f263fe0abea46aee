"""Plain versions of the operators for small inputs."""

import hashlib
import re


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def roots(nodes, links):
    """Smallest reachable node of each node."""
    near = {n: {n} for n in nodes}
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for n in nodes:
        seen, todo = {n}, [n]
        while todo:
            for m in near[todo.pop()] - seen:
                seen.add(m)
                todo.append(m)
        out[n] = min(seen)
    return out


def shingles(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", fold(text))
    if not w:
        return set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or {tuple(w)}


def jaccard(rows):
    """[(doc_id, n_shingles, component)] of rows (doc_id, text)."""
    sets = [(d, shingles(t)) for d, t in rows]
    links = [
        (a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i]
        if x and y and 100 * len(x & y) >= 80 * len(x | y)
    ]
    comp = roots([d for d, _ in rows], links)
    return sorted((d, len(s), comp[d]) for d, s in sets)


def repeats(rows, length=100):
    """[(doc_id, n_bytes, n_removed, n_spans, kept)] of rows (doc_id, text)."""
    seen, hit = {}, {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        raw = (t or "").encode()
        hit[d] = [False] * len(raw)
        for p in range(len(raw) - length + 1):
            if seen.setdefault(raw[p : p + length], (d, p)) != (d, p):
                hit[d][p : p + length] = [True] * length
    out = []
    for d, t in rows:
        raw, h = (t or "").encode(), hit[d]
        spans = sum(1 for i, x in enumerate(h) if x and (i == 0 or not h[i - 1]))
        out.append((d, len(raw), sum(h), spans, bytes(b for b, x in zip(raw, h, strict=True) if not x)))
    return sorted(out)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(text))


def contamination(rows, items, window=13):
    """[(doc_id, n_words, n_hit, items, contaminated)] of rows and items (id, text)."""
    out = []
    for d, t in rows:
        w, hit, found = words(t), set(), set()
        for item, text in items:
            v = words(text)
            k = min(window, len(v))
            grams = {tuple(v[i : i + k]) for i in range(len(v) - k + 1)} if k else set()
            for i in range(len(w) - k + 1) if k else ():
                if tuple(w[i : i + k]) in grams:
                    hit.update(range(i, i + k))
                    found.add(item)
        names = sorted(str(i) for i in found if i is not None)
        out.append((d, len(w), len(hit), names, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=lambda r: str(r))


def sha(data):
    return hashlib.sha256(data).hexdigest()
