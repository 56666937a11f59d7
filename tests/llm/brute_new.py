"""Plain versions of the byte-level encoding, the source audit and the conversation trie."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def divergence(rows, min_docs=30, top=50):
    """rows: (text, lang, source)."""
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = [ascii_lower(t) for t in TERM.findall(text or "")]
        groups[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = []
    for lang in docs:
        kept = {t for t, n in docs[lang].items() if n >= min_docs}
        here = {s: {t: c[t] for t in kept} for (l, s), c in groups.items() if l == lang}
        whole = {t: sum(c[t] for c in here.values()) for t in kept}

        def shares(counts):
            total = sum(counts.values()) + 5 * len(kept)
            return {t: 1 + 10**9 * (n + 5) // total for t, n in counts.items()}

        q, p = shares(whole), {s: shares(c) for s, c in here.items()}
        for s in here:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in here if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if here[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(items[:most])]
    return sorted(out)


def trie(rows):
    """rows: (conv_id, turn, role, text), turns of one conversation with different numbers."""
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    nodes = defaultdict(list)
    ends = defaultdict(list)
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        seq = tuple(own.get(base, [])[:h] + mine[h:])
        for d in range(len(seq) + 1):
            nodes[seq[:d]].append(c)
        ends[seq].append(c)
    children = Counter(seq[:-1] for seq in nodes if seq)
    leaves, saved = Counter(), Counter()
    for seq, members in nodes.items():
        spared = (len(members) - 1) * len(seq[-1][1].encode()) if seq else 0
        for d in range(len(seq) + 1):
            saved[seq[:d]] += spared
            leaves[seq[:d]] += not children[seq]
    return sorted(
        (min(m), len(s), min(nodes[s[:-1]]) if s else None, len(m), children[s], leaves[s], saved[s],
         hashlib.sha256(",".join(map(str, sorted(ends[s]))).encode()).hexdigest())
        for s, m in nodes.items()
    )
