"""Plain versions of the operators, for small tables."""

import hashlib
import math
import re

import xxhash

SPACE = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def simhash(text, words=3):
    parts = [w for w in WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))]
    if not parts:
        return 0
    shingles = [" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    """The smallest node each node reaches; `linked` says whether two nodes are linked."""
    label = {n: n for n in nodes}

    def root(n):
        while label[n] != n:
            n = label[n]
        return n

    nodes = list(label)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {n: root(n) for n in nodes}


def near_copies(texts):
    """doc_id → component, for texts by doc_id."""
    prints = {i: simhash(t) for i, t in texts.items()}
    return components(texts, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)


def repeated_lines(texts, min_words=50):
    """doc_id → positions of lines in runs of min_words words or more that occurred before."""
    lines = {
        i: [(p, s.strip(" \t\x0b\x0c\r")) for p, s in enumerate(t.split("\n")) if s.strip(" \t\x0b\x0c\r")]
        for i, t in texts.items()
        if t is not None
    }
    seen, gone = set(), {i: set() for i in texts}
    for i in sorted(lines):
        own = lines[i]
        for a in range(len(own)):
            for b in range(a, len(own)):
                run = tuple(s for _, s in own[a : b + 1])
                if sum(len(WORD.findall(s)) for s in run) < min_words:
                    continue
                if run in seen:
                    gone[i] |= set(range(own[a][0], own[b][0] + 1))
                seen.add(run)
    return gone


def without_repeats(texts, min_words=50):
    gone = repeated_lines(texts, min_words)
    return {
        i: t if not gone[i] else "\n".join(s for p, s in enumerate(t.split("\n")) if p not in gone[i])
        for i, t in texts.items()
    }


def mix(rows, weights=(5, 2, 1), share=1.5, most=2.0, seed=17):
    """doc_id → (size, source_size, target, copies), for (doc_id, source, text) rows."""
    sized = [(i, s, len(WORD.findall(t or ""))) for i, s, t in rows]
    names = sorted({s for _, s, _ in sized}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(n for _, x, n in sized if x == s) for s in names}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, rest = {}, share * sum(total.values())
    open_ = list(names)
    while open_:
        level = rest / sum(weight[s] for s in open_)
        full = [s for s in open_ if most * total[s] <= level * weight[s]]
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in full:
            target[s] = most * total[s]
            rest -= target[s]
            open_.remove(s)
    out = {}
    for s in names:
        own = sorted((x for x in sized if x[1] == s), key=lambda x: (-x[2], hashlib.md5(str(x[0]).encode()).hexdigest()))
        key = "n" if s is None else "s" + s
        offset = int(hashlib.md5(f"{seed}:{key}".encode()).hexdigest()[:8], 16) / 2**32
        rate = target[s] / total[s] if total[s] else 0.0
        for r, (i, _, n) in enumerate(own, 1):
            out[i] = (n, total[s], target[s], math.floor(r * rate + offset) - math.floor((r - 1) * rate + offset))
    return out
