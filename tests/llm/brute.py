"""Plain versions of the contracts, row by row, to hold the queries against."""

import hashlib
import re
import zlib
from collections import Counter

import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(s):
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


def out(doc_id, m, r):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % m == r


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def quality(t):
    w, t = words(t), t or ""
    win = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    c = Counter(win)
    hit = set()
    for i, x in enumerate(win):
        if c[x] > 1:
            hit |= set(range(i, i + 8))
    seen, dup = set(), 0
    for line in t.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(x in "#*$%&|<>" for x in t), "n_dup_lines": dup, "n_repeat_words": len(hit), "base_failed": len(w) < 20 or 100 * len(hit) > 30 * len(w)}


ASSIGN = re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def secrets(t):
    t = t or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 32]
    c = Counter(s[1] for s in spans)
    text = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))
    return {"n_assign": c[0], "n_access": c[1], "n_hex": c[2], "base_sha256": sha(text), "_text": text}


def plain_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))


def contamination(t, items):
    w = plain_words(t)
    hit, names = set(), set()
    for name, text in items:
        iw = plain_words(text)
        if not iw:
            continue
        size = min(10, len(iw))
        wins = {tuple(iw[i : i + size]) for i in range(len(iw) - size + 1)}
        for i in range(len(w) - size + 1):
            if tuple(w[i : i + size]) in wins:
                hit |= set(range(i, i + size))
                names |= {str(name)} - {"None"}
    return {"n_words": len(w), "n_hit": len(hit), "n_items": len(names), "items_sha256": sha(",".join(sorted(names))), "contaminated": bool(hit)}


def fingerprint(t):
    w = words((t or "").translate(LOWER))
    if not w:
        return 0
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(fps):
    """{fingerprint: set of ids} to {fingerprint: smallest reachable id}."""
    left, name = set(fps), {}
    while left:
        todo = [left.pop()]
        group = set(todo)
        while todo:
            x = todo.pop()
            near = {y for y in left if (x ^ y).bit_count() <= 2}
            left -= near
            group |= near
            todo += near
        least = min((i for x in group for i in fps[x] if i is not None), default=None)
        name |= dict.fromkeys(group, least)
    return name


def repeats(docs, size=100):
    """docs: (id, text) rows; what 100-byte strings seen earlier cover."""
    seen, res = set(), []
    for key, t in docs:
        b = (t or "").encode()
        cover = bytearray(len(b))
        for i in range(len(b) - size + 1):
            s = b[i : i + size]
            if s in seen:
                cover[i : i + size] = b"\1" * size
            seen.add(s)
        kept = bytes(x for x, c in zip(b, cover, strict=True) if not c)
        res.append((key, len(b), sum(cover), len(re.findall(b"\1+", bytes(cover))), sha(kept)))
    return res
