"""Plain versions of the operators, for small inputs."""

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return WORD.findall(text or "")


def repeats(rows, window=50):
    """[(id, n_words, n_removed, kept)] of (id, text) rows; a null id comes last."""
    key = lambda i: (i is None, i if i is not None else 0)
    first = {}
    for i, text in rows:
        w = words(text)
        for k in range(len(w) - window + 1):
            run = tuple(w[k : k + window])
            if run not in first or key(i) < first[run]:
                first[run] = key(i)
    out = []
    for i, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < key(i):
                gone[k : k + window] = [True] * window
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, width=2):
    w = words(lower_ascii(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1)))


def components(rows, width=2, least=80):
    """{id: (n_shingles, smallest id reachable)} of (id, text) rows with distinct ids."""
    sets = {i: shingles(t, width) for i, t in rows}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in sets:
        met = defaultdict(int)
        for x in sets[i]:
            for j in holders[x]:
                if j > i:
                    met[j] += 1
        for j, n in met.items():
            if 100 * n >= least * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}
