"""The operators' results in plain Python, by the shortest way, for comparison."""

import hashlib
import re
import zlib
from collections import defaultdict
from itertools import combinations

SPACES = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def folded(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def exact(rows, keep):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[folded(text)].append(doc_id)
    out = []
    for doc_id, text in rows:
        own = groups[folded(text)]
        best = keep([i for i in own if i is not None], default=None)
        out.append((doc_id, best, len(own), sha(folded(text))))
    return out


def reachable(nodes, links):
    label = {n: n for n in nodes}

    def root(n):
        while label[n] != n:
            n = label[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        label[b] = a
    return {n: root(n) for n in nodes}


def shingles(text, size):
    words = SPACES.findall(folded(text))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def jaccard(rows, size, percent):
    """``doc_id -> (size of the set, smallest id reachable)`` by comparing all pairs."""
    sets = {i: shingles(t, size) for i, t in rows}
    links = []
    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        small, large = sorted((len(x), len(y)))
        if small and small * 100 >= large * percent:
            both = len(x & y)
            if 100 * both >= percent * (len(x) + len(y) - both):
                links.append((a, b))
    label = reachable(sets, links)
    return {i: (len(sets[i]), label[i]) for i in sets}


def secrets(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    n = [sum(k == i for _, k, _ in found) for i in range(3)]
    return (*n, ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found)))


def repeats(rows, window):
    """``doc_id -> (words, removed, SHA-256 of what is left)``; ids are not null."""
    first = {}
    words = [(i, SPACES.findall(t or "")) for i, t in rows]
    for i, w in words:
        for p in range(len(w) - window + 1):
            key = tuple(w[p : p + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] < i:
                gone.update(range(p, p + window))
        out.append((i, len(w), len(gone), sha(" ".join(x for p, x in enumerate(w) if p not in gone))))
    return out


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def sha_of(*parts):
    return sha("".join(parts))


def merkle_levels(nodes):
    """All levels of a tree, the given one first."""
    levels = [list(nodes)]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([sha_of(*low[i : i + 2]) for i in range(0, len(low), 2)])
    return levels


def merkle_path(levels, place):
    path = []
    for low in levels[:-1]:
        other = place ^ 1
        path.append((low[other] if other < len(low) else "", place & 1))
        place >>= 1
    return path


def merkle(rows, tampered):
    """``doc_id, leaf, subroot, root, proof, folded root`` of rows (doc_id, source, lang, n_chars, text)."""

    def leaf(values):
        return sha_of(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])

    by_lang = defaultdict(list)
    for row in rows:
        tried = row if row[3] is None or not tampered(row[0]) else (*row[:3], row[3] + 1, row[4])
        by_lang[row[2]].append((row[0] is not None, row[0] or 0, leaf(row), leaf(tried)))
    langs = sorted(by_lang, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: merkle_levels([x[2] for x in sorted(by_lang[g])]) for g in langs}
    top = merkle_levels([trees[g][-1][0] for g in langs]) if langs else []
    out = []
    for k, g in enumerate(langs):
        for place, (named, doc_id, own, tried) in enumerate(sorted(by_lang[g])):
            path = merkle_path(trees[g], place) + merkle_path(top, k)
            node = tried
            for sibling, left in path:
                node = sha_of(sibling, node) if left else sha_of(node, sibling)
            ends = trees[g][-1][0], top[-1][0]
            out.append((doc_id if named else None, own, *ends, sha_of(*[s for s, _ in path]), node))
    return out


def phrase_counts(rows, longest):
    """Counts of words by language, and of runs of up to ``longest`` words in a piece."""
    totals, runs = defaultdict(int), defaultdict(int)
    for _, lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    runs[lang, tuple(words[i : i + n])] += 1
    return totals, runs


def collocations(rows, longest=3, least=10, within=50, most=2000):
    totals, runs = phrase_counts(rows, longest)
    frequent = {k: a for k, a in runs.items() if a >= least and len(k[1]) > 1}
    hidden = defaultdict(int)
    for (lang, words), a in frequent.items():
        for n in range(2, len(words)):
            for i in range(len(words) - n + 1):
                part = lang, words[i : i + n]
                hidden[part] = max(hidden[part], a)
    by_lang = defaultdict(list)
    for (lang, words), a in frequent.items():
        if 100 * hidden[lang, words] >= within * a:
            continue
        cuts = []
        for k in range(1, len(words)):
            x, y = runs[lang, words[:k]], runs[lang, words[k:]]
            cuts.append((1_000_000 * a * a // (x * y), k, x, y))
        score, _, x, y = min(cuts)
        by_lang[lang].append((-score, -a, " ".join(words).encode(), x, y))
    out = []
    for lang, found in by_lang.items():
        for rank, (score, a, phrase, x, y) in enumerate(sorted(found)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, x, y, totals[lang], -score))
    return out
