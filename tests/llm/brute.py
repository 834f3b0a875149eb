"""Plain Python versions of the operators, for small inputs."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

WORD = re.compile("[^\x20\x09-\x0d]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def substring_dedup(docs):
    """[(doc_id, n_words, n_removed, sha256)] for (doc_id, text) rows."""
    words = [(d, WORD.findall(t or "")) for d, t in docs]
    first = {}
    for d, w in words:
        for i in range(len(w) - 12):
            key = tuple(w[i : i + 13])
            if d is not None:
                first[key] = min(first.get(key, d), d)
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - 12):
            if d is not None and first[tuple(w[i : i + 13])] < d:
                gone.update(range(i, i + 13))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), sha(kept)))
    return out


def fingerprint(text: str) -> int:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    bits = [2 * sum(h >> b & 1 for h in hashes) > len(hashes) for b in range(64)]
    return sum(1 << b for b in range(64) if bits[b])


def linked(prints, most=2):
    """Root position of each fingerprint, all pairs compared."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= most:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def near_duplicates(docs):
    prints = [fingerprint(t) for _, t in docs]
    roots = linked(prints)
    least = defaultdict(list)
    for (d, _), r in zip(docs, roots, strict=True):
        if d is not None:
            least[r].append(d)
    return [
        (d, f"{p:016x}", min(least[r], default=None))
        for (d, _), p, r in zip(docs, prints, roots, strict=True)
    ]


def rule_measures(text: str):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            covered.update(range(i, i + 5))
    return (
        sum(map(len, words)),
        len(words),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


def line_dedup(docs):
    """[(doc_id, n_lines, n_dropped, kept text)]."""

    def key(line):
        out = re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
        return out if len(out) >= 10 else None

    first = {}
    for d, t in docs:
        for line in (t or "").split("\n"):
            if d is not None and key(line) is not None:
                first[key(line)] = min(first.get(key(line), d), d)
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if d is None or key(x) is None or first[key(x)] >= d]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def runs(words, least=12):
    """Maximal repetitions as (start, length, period), every period tried at every place."""
    found = {}
    for p in range(1, len(words) // 2 + 1):
        s = 0
        while s + p < len(words):
            e = s
            while e + p < len(words) and words[e] == words[e + p]:
                e += 1
            if e + p - s >= max(least, 2 * p):
                found.setdefault((s, e + p), p)
            s = e + 1
    return sorted((s, e - s, p) for (s, e), p in found.items())


def collapsed(words, found):
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def spelling_variants(counts):
    """[(word, form, root, n, n_near, form_n)] with near words found by deleting letters."""
    shorter = defaultdict(set)
    for w in counts:
        for x in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            shorter[x].add(w)
    near = {w: set() for w in counts}
    for group in shorter.values():
        for a in group:
            near[a].update(b for b in group if a != b and one_edit(a, b))
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= 2 * counts[w]:
            form[w] = best
    out = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        out.append((w, f, root, n, len(near[w]), counts[f] if f else None))
    return out


MARKS = ".,!?#*$%&|<>@:/-_(){}[]\"'=+\\~^;"


def quality_features(text):
    """Sizes and shares of a text, one by one."""
    text = text or ""
    data = text.encode()
    words = [w.encode() for w in WORD.findall(text)]
    lines = [line.encode() for line in text.split("\n") if WORD.search(line)]
    n, k = max(1, len(data)), max(1, len(words))
    sizes = [len(w) for w in words] or [0]
    mean = sum(sizes) / len(sizes)
    spread = math.sqrt(sum((s - mean) ** 2 for s in sizes) / len(sizes))
    count = Counter(words)
    line_sizes = [len(line) for line in lines] or [0]
    marks = [text.count(m) for m in MARKS]

    def share(test):
        return sum(map(test, data)) / n

    return [
        math.log(1 + len(data)), math.log(1 + len(words)), math.log(1 + len(lines)), mean,
        math.log(1 + spread), math.log(1 + max(sizes)), len(count) / k,
        max(count.values(), default=0) / k, sum(v for v in count.values() if v > 2) / k,
        sum(a == b for a, b in zip(words, words[1:])) / k,
        (len(lines) - len(set(lines))) / max(1, len(lines)),
        math.log(1 + sum(line_sizes) / len(line_sizes)),
        share(lambda b: 65 <= b <= 90), share(lambda b: 97 <= b <= 122), share(lambda b: 48 <= b <= 57),
        share(lambda b: b in (32, 9, 11, 12, 13)), share(lambda b: b == 10), share(lambda b: b > 127),
        share(lambda b: b < 32 and b not in (9, 10, 11, 12, 13)), sum(marks) / n, *[m / k for m in marks],
    ]


def preference_scores(good, bad, others, penalty=1e-2, bins=8, each=4, seed=0):
    """Raw Bradley-Terry scores of ``others``: the same loss, made small by plain descent."""
    good, bad, others = (np.array(x, dtype=float) for x in (good, bad, others))
    both = np.concatenate([good, bad])
    mean, scale = both.mean(axis=0), both.std(axis=0)
    edges = [[np.quantile(part[:, f], i / bins) for part in (good, bad) for i in range(1, bins)]
             for f in range(both.shape[1])]

    def expand(rows):
        out = []
        for row in rows:
            straight = [min(5, max(-5, (x - m) / (s if s > 0 else 1))) for x, m, s in zip(row, mean, scale)]
            # The edges of the good first, then those of the bad, as one list for each feature.
            out.append(straight + [float(x > e) for x, own in zip(row, edges) for e in own])
        return np.array(out)

    rng = np.random.default_rng(seed)
    n = each * max(len(good), len(bad))
    first = np.resize(rng.permutation(len(good)), n)
    differences = expand(good)[first] - expand(bad)[rng.integers(0, len(bad), n)]
    step = 1 / (np.linalg.norm(differences, 2) ** 2 / (4 * n) + penalty)
    weights = ahead = np.zeros(differences.shape[1])
    for t in range(6000):
        lost = 1 / (1 + np.exp(differences @ ahead))
        after = ahead - step * (penalty * ahead - differences.T @ lost / n)
        ahead = after + t / (t + 3) * (after - weights)
        weights = after
    return expand(others) @ weights
