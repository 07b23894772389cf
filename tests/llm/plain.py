"""Plain versions of the operators, for comparison."""

import base64
import hashlib
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def words(text, lower=True, pattern=WORD):
    raw = (text or "").encode()
    return pattern.findall(raw.translate(LOWER) if lower else raw)


def shingles(text, size=5):
    found = words(text)
    if len(found) < size:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i:i + size]) for i in range(len(found) - size + 1))


def components(docs, percent=75):
    """(doc_id, n_shingles, component) of rows with distinct ids."""
    sets = {d: shingles(t) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for d in sorted(sets):
        shared = Counter()
        for s in sets[d]:
            for e in holders[s]:
                shared[e] += 1
            holders[s].append(d)
        for e, n in shared.items():
            if 100 * n >= percent * (len(sets[d]) + len(sets[e]) - n):
                a, b = find(d), find(e)
                root[max(a, b)] = min(a, b)
    return {(d, len(s), find(d)) for d, s in sets.items()}


def repeats(docs, size=50):
    """(doc_id, n_words, n_removed, digest of what is kept), a list."""
    last = 1 << 62
    rows = [(d if d is not None else last, words(t, lower=False)) for d, t in docs]
    least = {}
    for d, w in rows:
        for i in range(len(w) - size + 1):
            key = tuple(w[i:i + size])
            least[key] = min(d, least.get(key, d))
    out = []
    for d, w in rows:
        gone = bytearray(len(w))
        for i in range(len(w) - size + 1):
            if least[tuple(w[i:i + size])] < d:
                gone[i:i + size] = b"\1" * size
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((None if d == last else d, len(w), sum(gone), sha(kept)))
    return out


def contamination(docs, items, size=10):
    windows = defaultdict(set)
    for item, text in items:
        w = words(text, pattern=ALNUM)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[i:i + size])].add(item)
    lengths = sorted({len(k) for k in windows})
    out = []
    for d, text in docs:
        w = words(text, pattern=ALNUM)
        hit, found = bytearray(len(w)), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                key = tuple(w[i:i + n])
                if key in windows:
                    hit[i:i + n] = b"\1" * n
                    found |= windows[key]
        ids = sorted(str(x) for x in found if x is not None)
        out.append((d, len(w), sum(hit), len(ids), sha(",".join(ids).encode()), any(hit)))
    return out


def unigrams(docs, learns):
    """(doc_id, n_tokens, n_known, train_tokens, base score), a list."""
    counts = Counter()
    for (_, text), learn in zip(docs, learns, strict=True):
        if learn:
            counts.update(words(text))
            counts[None] += 1
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, text in docs:
        tokens = words(text) + [None]
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
        out.append((d, len(tokens), sum(counts[t] > 0 for t in tokens), n, round(base, 6)))
    return out


def archive(pages):
    """(page_id, bytes, digest, type, refers_to) of rows (page_id, html)."""
    last = {}
    for p, html in pages:
        if p is not None:
            last[html or ""] = max(p, last.get(html or "", p))
    out = []
    for p, html in pages:
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        to = last.get(html or "")
        out.append((p, len(raw), digest, *(("response", None) if to is None or to == p
                                           else ("revisit", to))))
    return out


def conversations(rows):
    """{conv_id: (n_turns, digest of turns, learned characters, their digest)}."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        learned = "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, _, r, t in turns).encode()),
                     len(learned), sha(learned.encode()))
    return out
