"""Plain versions of the operators, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def repeated_strings(texts, depth):
    """(n_bytes, n_removed, n_spans, kept_sha256) per text."""
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + depth] for r in raws for i in range(len(r) - depth + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - depth + 1):
            if seen[r[i:i + depth]] > 1:
                gone[i:i + depth] = b"\1" * depth
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(r), sum(gone), spans, sha(bytes(b for b, g in zip(r, gone) if not g))))
    return out


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_secrets(text):
    """(n_assign, n_access, n_hex, base_sha256, spans)"""
    text = text or ""
    spans = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    spans.sort()
    kinds = Counter(s[2] for s in spans)
    line = ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)
    return kinds["assign"], kinds["access"], kinds["hex"], sha(line.encode()), line


def quality_counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)"""
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = text.split("\n")
    dups = sum(1 for i, x in enumerate(lines) if WORD.search(x) and x in lines[:i])
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(covered)


def shingles(text, n):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text or "")]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) or frozenset([tuple(words)])


def near_groups(rows, n, percent):
    """{doc_id: (n_shingles, component_id)} of (doc_id, text) rows with distinct ids."""
    sets = {i: shingles(t, n) for i, t in rows}
    name = {i: i for i in sets}

    def root(i):
        while name[i] != i:
            i = name[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                name[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def ranked(docs, items, top):
    """[(item_id, rank, doc_id, score)] of (id, text) rows on both sides."""
    terms = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    terms = [(i, c) for i, c in terms if c]
    count, words = len(terms), sum(sum(c.values()) for _, c in terms)
    df = Counter(t for _, c in terms for t in c)
    out = []
    for item, text in items:
        wanted = set(TERM.findall((text or "").translate(LOWER)))
        scores = []
        for i, c in terms:
            m = 50 + 50 * sum(c.values()) * count // words
            score = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                        for t in wanted if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        scores.sort(key=lambda s: s[:3])
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(scores[:top])]
    return out


def spellings(docs, min_length=6, min_times=5, rate=199, ratio=5):
    """{word: (form, root, n, n_near, form_n)}"""
    found = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            found[run[:h % len(run)] + run[h % len(run) + 1:] if h % rate == 0 else run] += 1
    words = {w: n for w, n in found.items() if len(w) >= min_length and n >= min_times}
    forms, near = {}, Counter()

    def close(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))

    for w, n in words.items():
        others = [o for o in words if abs(len(o) - len(w)) <= 1 and close(w, o)]
        near[w] = len(others)
        best = min(others, key=lambda o: (-words[o], o), default=None)
        if best and words[best] >= ratio * n:
            forms[w] = best
    out = {}
    for w, n in words.items():
        root = w
        while root in forms:
            root = forms[root]
        out[w] = (forms.get(w), root, n, near[w], words[forms[w]] if w in forms else None)
    return out
