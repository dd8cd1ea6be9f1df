"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def near_dedup(rows, words: int = 5, percent: int = 85) -> dict:
    sets = {}
    for i, text in rows:
        w = SPACED.findall((text or "").translate(LOWER))
        sets[i] = {tuple(w[j: j + words]) for j in range(max(1, len(w) - words + 1))} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def substring_dedup(rows, length: int = 35) -> list:
    parsed = [(i, SPACED.findall(t or "")) for i, t in rows]
    times = Counter(tuple(w[j: j + length]) for _, w in parsed for j in range(len(w) - length + 1))
    out = []
    for i, w in parsed:
        gone = [False] * len(w)
        for j in range(len(w) - length + 1):
            if times[tuple(w[j: j + length])] > 1:
                gone[j: j + length] = [True] * length
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def contamination(rows, items, length: int = 10) -> list:
    windows = defaultdict(set)
    for name, text in items:
        w = PLAIN.findall((text or "").translate(LOWER))
        for j in range(max(1, len(w) - length + 1) if w else 0):
            windows[tuple(w[j: j + length])].add(str(name))
    sizes = {len(k) for k in windows}
    out = []
    for i, text in rows:
        w, hit, names = PLAIN.findall((text or "").translate(LOWER)), set(), set()
        for size in sizes:
            for j in range(len(w) - size + 1):
                if found := windows.get(tuple(w[j: j + size])):
                    hit.update(range(j, j + size))
                    names |= found
        out.append((i, len(w), hit, sorted(names)))
    return out


def base_secrets(text: str | None) -> list:
    text, spans = text or "", []
    assign = r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(assign, text):
        if len(m[2]) >= 12:
            spans.append((m.start(), 0, m.end()))
    for kind, pattern, least in ((1, "AKIA[A-Z0-9]+", 18), (2, "[0-9a-f]+", 16)):
        spans += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return sorted(spans)


def least_padding(lengths: list[int], buckets: int) -> int:
    """Smallest padded total over all choices of boundaries among the lengths."""
    edges = sorted(set(lengths))
    best = {0: 0}
    for _ in range(buckets):
        step = dict(best)
        for i, cost in best.items():
            for j in range(i + 1, len(edges) + 1):
                new = cost + edges[j - 1] * sum(edges[i] <= n <= edges[j - 1] for n in lengths)
                step[j] = min(step.get(j, new), new)
        best = step
    return best[len(edges)]


def exact_groups(rows) -> list:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row."""
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(i)
    out = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, sha(text)) for i in ids]
    return out


def phrase_counts(rows, longest: int = 5) -> tuple[Counter, Counter]:
    """Occurrences of (lang, words) up to `longest` words, and words by lang, of rows of (lang, text)."""
    found, totals = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for i in range(len(words)):
                for m in range(1, min(longest, len(words) - i) + 1):
                    found[lang, tuple(words[i: i + m])] += 1
    return found, totals


def collocations(rows, least: int, top: int) -> list:
    """(lang, rank, phrase, a, l, r, n, score)."""
    found, totals = phrase_counts(rows)
    candidates = {k: a for k, a in found.items() if a >= least and len(k[1]) > 1}
    outer = Counter()
    for (lang, words), a in candidates.items():
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                outer[lang, words[i: i + m]] = max(outer[lang, words[i: i + m]], a)
    by_lang = defaultdict(list)
    for (lang, words), a in candidates.items():
        if outer[lang, words] >= a:
            continue
        cuts = [(1000 * a * totals[lang] // (found[lang, words[:k]] * found[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        by_lang[lang].append((-score, -a, " ".join(words).encode(), found[lang, words[:k]], found[lang, words[k:]]))
    return [(lang, rank, phrase.decode(), -a, left, right, totals[lang], -score)
            for lang, scored in by_lang.items()
            for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], start=1)]


def lloyd(rows, clusters: int, rounds: int, dims: int, scale: int = 1024, seed: int = 3) -> list:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable row."""
    import math

    used = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    place = lambda row: (row[0] is None, sha(f"{seed}:{row[0]}"), row[1])
    centroids = [v for _, v in sorted(used, key=place)[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        own = defaultdict(list)
        for _, v in used:
            own[nearest(v)[1]].append(v)
        centroids = [[sum(column) // len(own[j]) for column in zip(*own[j], strict=True)] if own[j] else c
                     for j, c in enumerate(centroids)]
    last = [(i, *reversed(nearest(v))) for i, v in used]
    inertia = Counter()
    for _, j, d in last:
        inertia[j] += d
    return [(i, j, d, inertia[j], sum(inertia.values()), sha(",".join(map(str, centroids[j])))) for i, j, d in last]
