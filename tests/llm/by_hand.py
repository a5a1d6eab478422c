"""Plain versions of what several tests compare with."""

from collections import defaultdict

import xxhash


def roots(links, nodes):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def simhash_by_hand(text):
    words = text.encode().lower().split()
    parts = [b" ".join(words[n : n + 3]) for n in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def line_key(line):
    bare = line.strip(" \t\n\x0b\x0c\r")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in bare)


def lines_kept(texts):
    """The lines of each text without those that three texts or more hold, save in the largest id."""
    holders = defaultdict(set)
    for i, text in texts.items():
        for line in text.split("\n"):
            holders[line_key(line)].add(i)
    gone = {k: max(h) for k, h in holders.items() if len(k) >= 20 and len(h) >= 3}
    return {
        i: [x for x in text.split("\n") if gone.get(line_key(x), i) == i] for i, text in texts.items()
    }


def targets_by_hand(totals):
    names = sorted((s for s in totals if s is not None), key=lambda s: s.encode()) + [None] * (None in totals)
    weight = {s: (5, 2, 1)[n % 3] for n, s in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    rest, still = 1.5 * sum(totals.values()), list(names)
    while still:
        share = {s: rest * weight[s] / sum(weight[x] for x in still) for s in still}
        above = [s for s in still if share[s] > 2 * totals[s]]
        if not above:
            target.update(share)
            break
        for s in above:
            target[s] = 2.0 * totals[s]
            rest -= target[s]
            still.remove(s)
    return target
