"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def quality_counts(text):
    w = words(text)
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def links(rows, similarity=0.8):
    """{id: (class, links)} for (id, text) rows with different ids."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    count, ids = Counter(), sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            both = len(sets[i] & sets[j])
            if both and both >= similarity * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                count[i] += 1
                count[j] += 1
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (root(i), count[i]) for i in ids}


def without_repeats(rows, size=50):
    """{id: (words, removed, kept)} for (id, text) rows."""
    first = defaultdict(lambda: None)
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - size + 1):
            g = tuple(w[k : k + size])
            first[g] = i if first[g] is None else min(first[g], i)
    out = {}
    for i, t in rows:
        w = words(t)
        gone = set()
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < i:
                gone.update(range(k, k + size))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out[i] = (len(w), len(gone), " ".join(kept))
    return out


def runs(w, least=12):
    """(start, length, period) of all runs of the words, by start, then period."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            begin = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - begin >= max(least, 2 * q):
                found.setdefault((begin, i + q - begin), q)
            i = max(i, begin + 1) if i == begin else i
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def with_repeats(doc_id, text):
    """The words of a document as the contract of op11 plants them."""
    w = words(text)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not w:
        return w
    g = h // 10
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]


def without_runs(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def damaged(rows):
    """Rows (conv_id, turn, role, text) with the damage that the contract of op13 names."""
    out = []
    for c, t, role, text in rows:
        show = lambda x: " " if x is None else str(x)
        h = zlib.crc32(f"{show(c)}:{show(t)}".encode()) % 20
        role, text = show(role), show(text)
        if h == 0:
            continue
        if h == 1:
            text = ""
        if h == 2:
            text = re.sub("[.!?]", "", text)
        if h == 4:
            role = "user"
        out += [(c, t, role, text)] * (2 if h == 3 else 1)
    return out


def repaired(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired rows) of one conversation, by search over all paths."""
    digest = lambda text: hashlib.md5(text.encode()).digest()
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", digest(r[3] or "")))
    rows = [(c, t, role or "", text or "") for c, t, role, text in rows]
    turns = {t for _, t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    faults, seen = [], set()
    for _, _, role, text in rows:
        solid = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated"
        seen.add((role, text))
        faults.append(fault)
    letters = [role[:1] for _, _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:]))
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {("", 0): (0, "", ())}
    # Cheapest, then least audit, over states (last role, rows taken): audits only grow, by inserts at most twice in a row.
    for i in range(len(rows) + 1):
        for _ in range(3):
            for (q, k), (cost, audit, out) in list(best.items()):
                if k == i:
                    for to in "ua":
                        if (q, to) in step:
                            name = "user" if to == "u" else "assistant"
                            put = (cost + 3, audit + "I", (*out, (name, "")))
                            if (to, i) not in best or put[:2] < best[to, i][:2]:
                                best[to, i] = put
        if i == len(rows):
            break
        _, _, role, text = rows[i]
        for (q, k), (cost, audit, out) in list(best.items()):
            if k != i:
                continue
            options = [(cost + 4, audit + "D", out, q)]
            if faults[i] not in ("blank", "duplicate"):
                more = 3 if faults[i] == "truncated" else 0
                if (q, role[:1]) in step:
                    options.append((cost + more, audit + "K", (*out, (role, text)), step[q, role[:1]]))
                for to in "ua":
                    if (q, to) in step:
                        name = "user" if to == "u" else "assistant"
                        options.append((cost + 3 + more, audit + "R", (*out, (name, text)), to))
            for c, a, o, to in options:
                if (to, i + 1) not in best or (c, a) < best[to, i + 1][:2]:
                    best[to, i + 1] = (c, a, o)
    cost, audit, out = min((best[q, len(rows)] for q in ("", "a") if (q, len(rows)) in best), key=lambda x: x[:2])
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, list(out))


def vector_links(rows, limit):
    """Per row (key, n_links, component, kept) of (key, vector, group) rows; all pairs in plain Python floats."""

    def unit(v):
        if not v or any(x is None or x != x or abs(x) == float("inf") for x in v) or not any(v):
            return None
        size = math.sqrt(math.fsum(x * x for x in v))
        return [x / size for x in v]

    units = [unit(v) if g is not None and k is not None else None for k, v, g in rows]
    links, parent = [0] * len(rows), list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(units):
        for j in range(i):
            b = units[j]
            if a and b and rows[i][2] == rows[j][2] and len(a) == len(b) and math.fsum(x * y for x, y in zip(a, b)) >= limit:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    least = {}
    for i, (k, _, _) in enumerate(rows):
        r = root(i)
        least[r] = k if r not in least or (k is not None and k < least[r]) else least[r]
    return [(k, links[i], least[root(i)], k == least[root(i)]) for i, (k, _, _) in enumerate(rows)]


BYTE_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def quality_statistics(text):
    """What ``quality.statistics`` counts, from plain lists of words."""
    data = (text or "").encode()
    words = BYTE_WORD.findall(data)
    sizes = [len(w.decode()) for w in words]
    count, chars = len(words), sum(sizes)
    mean = chars / max(count, 1)
    spread = math.sqrt(max(sum(s * s for s in sizes) / max(count, 1) - mean**2, 0))
    of = lambda signs: sum(chr(b) in signs for b in data if b < 128)
    share = lambda part, whole: math.log((part + 0.5) / (max(whole - part, 0) + 0.5))
    triples = list(zip(words, words[1:], words[2:]))
    lines = [tuple(found) for found in map(BYTE_WORD.findall, data.split(b"\n")) if found]
    return [
        math.log1p(count), math.log1p(mean), math.log1p(spread),
        share(of("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), chars), share(of("0123456789"), chars), share(of("#*$%&|<>@^~{}[]\\=+_`"), chars),
        share(of("!?"), chars), share(of(".,;:"), chars), share(len(set(words)), count), share(len(set(triples)), len(triples)),
        share(sum(a == b for a, b in zip(words, words[1:])), count), math.log1p(count / max(len(lines), 1)),
        share(len(set(lines)), len(lines)), share(max(Counter(words).values(), default=0), count),
    ]


def discriminant_scores(labelled, rows, shrinkage, least, most):
    """Scores of ``rows`` by class densities: determinants and solved systems instead of factors."""
    x = np.array(rows)
    logs = []
    for label in (0, 1):
        part = np.array([s for s, y in labelled if y == label])
        covariance = np.cov(part.T, bias=True)
        shrunk = (1 - shrinkage) * covariance + shrinkage * np.diag(np.maximum(np.diag(covariance), least)) + least * np.eye(x.shape[1])
        centred = x - part.mean(0)
        squared = (centred * np.linalg.solve(shrunk, centred.T).T).sum(1)
        logs.append(-0.5 * squared - 0.5 * np.linalg.slogdet(shrunk)[1] + math.log(len(part) / len(labelled)))
    return 1 / (1 + np.exp(-np.clip(logs[1] - logs[0], -most, most)))


def language_grams(text):
    """Every run of four folded bytes that does not end in three spaces."""
    fold = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in (text or "").encode())
    return [g for g in (fold[i : i + 4] for i in range(len(fold) - 3)) if g[1:] != b"   "]


def language_sets(rows, least, share):
    """The n-grams that each language keeps: met often, and not far below its rate in another language."""
    counts = {}
    for text, lang in rows:
        counts.setdefault(lang, Counter()).update(language_grams(text))
    rates = {lang: {g: n / sum(c.values()) for g, n in c.items()} for lang, c in counts.items()}
    top = {}
    for found in rates.values():
        for g, r in found.items():
            top[g] = max(r, top.get(g, 0))
    return {lang: {g for g, n in c.items() if n >= least and rates[lang][g] >= share * top[g]} for lang, c in counts.items()}
