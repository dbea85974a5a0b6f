"""Plain single-threaded versions of what the operators compute."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from xxhash import xxh64_intdigest

SPACE = r"[\x20\x09-\x0D]+"


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(SPACE, low) if w]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def exact_groups(rows):
    """doc_id -> (keep_id, group_size, sha) of (doc_id, text) rows with distinct ids."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(SPACE, " ", t or "")].append(i)
    return {i: (min(ids), len(ids), sha(t)) for t, ids in groups.items() for i in ids}


KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal(text):
    """Sorted (start, rank, end, kind) of the pattern spans."""
    out = []
    for rank, (kind, pattern) in enumerate(KINDS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


def base_scores(rows, held):
    """doc_id -> (n_tokens, n_known, train_tokens, base_score)."""
    tokens = {i: [*words(t), None] for i, t in rows}
    count = Counter(w for i, ws in tokens.items() if not held(i) for w in ws)
    n, v = sum(count.values()), len(count)
    below = n + 0.5 * (v + 1)
    return {i: (len(ws), sum(w in count for w in ws), n, sum(math.log10((count[w] + 0.5) / below) for w in ws)) for i, ws in tokens.items()}


def crc(i):
    return zlib.crc32(str(i).encode())


def simhash(text):
    ws = words(text)
    shingles = [" ".join(ws[i : i + 3]) for i in range(len(ws) - 2)] or ([" ".join(ws)] if ws else [])
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(fps, radius=3):
    """key -> smallest key reachable, keys linked when their fingerprints differ in at most ``radius`` bits."""
    keys = sorted(fps)
    a = np.array([fps[k] for k in keys], np.uint64)
    parent = list(range(len(keys)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(keys)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1 :] ^ a[i]) <= radius) + i + 1:
            x, y = find(i), find(int(j))
            parent[max(x, y)] = min(x, y)
    return {k: keys[find(i)] for i, k in enumerate(keys)}


def nearest(vectors, queries, k=5):
    """query -> [(id, cosine)] over {id: vector}."""
    ids = np.array(sorted(vectors))
    v = np.array([vectors[i] for i in ids], float)
    out = {}
    for q in queries:
        x = np.array(vectors[q], float)
        s = (v * x).sum(1) / (np.sqrt((v * v).sum(1)) * np.sqrt((x * x).sum()))
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(s[i])) for i in order]
    return out


def tree_scores(rows, held, module):
    """doc_id -> score of the suffix tree, with plain dictionaries; constants and the ending of a word come from ``module``."""
    tokens = {i: [w.encode() for w in words(t)] for i, t in rows}
    train = [ws for i, ws in tokens.items() if not held(i)]
    count = Counter(w for ws in train for w in ws)
    n, ends = sum(count.values()) + len(train), len(train)
    unseen = (sum(c == 1 for c in count.values()) + 0.5) / (n + 1)
    least_word, least = module.least_count(n, module.WORD_SHARE), module.least_count(n, module.CONTEXT_SHARE)
    symbol = lambda w: w if count[w] >= least_word else module._ending(w)
    mass = Counter({"end": ends + 0.5})
    for w, c in count.items():
        mass[symbol(w)] += c + 0.5
    root = {s: m / sum(mass.values()) for s, m in mass.items()}
    laid = lambda ws: ["start", *map(symbol, ws), "end"]

    def after(contexts, k):
        found = defaultdict(Counter)
        for ws in train:
            line = laid(ws)
            for i in range(k, len(line)):
                if tuple(line[i - k : i]) in contexts:
                    found[tuple(line[i - k : i])][line[i]] += 1
        return {c: {s: m for s, m in nexts.items() if m >= 2} for c, nexts in found.items() if max(nexts.values()) >= 2}

    often = Counter(s for ws in train for s in laid(ws))
    contexts, levels = {(s,) for s, c in often.items() if c >= least and s != "end"}, []
    while contexts and len(levels) < module.DEPTH:
        levels.append(after(contexts, len(levels) + 1))
        contexts = {(*c, s) for c, nexts in levels[-1].items() for s, m in nexts.items() if m >= least and s != "end"}
    bits, kept, needed = module.COST * math.log2(max(n, 2)), {}, set()
    for k in range(len(levels) - 1, -1, -1):
        for c, nexts in levels[k].items():
            total = sum(nexts.values())
            short = levels[k - 1].get(c[1:]) if k else None
            q = {s: short[s] / sum(short.values()) for s in nexts} if k else root
            if sum(m * math.log2(m / total / q[s]) for s, m in nexts.items()) >= bits * len(nexts) or c in needed:
                kept[c] = nexts
                needed.add(c[1:])

    def chance(line, i):
        p = root.get(line[i], 0)
        for k in range(1, min(i, module.DEPTH) + 1):
            nexts = kept.get(tuple(line[i - k : i]))
            if nexts is None:
                break
            p = (nexts.get(line[i], 0) + len(nexts) * p) / (sum(nexts.values()) + len(nexts))
        return p

    out = {}
    for i, ws in tokens.items():
        line, log = laid(ws), 0.0
        for j, w in enumerate([*ws, None], 1):
            if w is not None and not count[w]:
                log += math.log10(unseen)
            else:
                inner = 1 if w is None else (count[w] + 0.5) / mass[symbol(w)]
                log += math.log10(chance(line, j) * inner * (1 - unseen))
        out[i] = log
    return out, len(kept)
