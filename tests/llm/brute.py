"""Plain versions of what the operators compute, for small inputs."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, width):
    words = WORD.findall(lower(text))
    if not words:
        return frozenset()
    width = min(width, len(words))
    return frozenset(tuple(words[k : k + width]) for k in range(len(words) - width + 1))


def components(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near_duplicates(texts, width, percent):
    """{id: (n_shingles, component)} for {id: text}."""
    sets = {k: shingles(t, width) for k, t in texts.items()}
    where = {}
    for k, s in sets.items():
        for shingle in s:
            where.setdefault(shingle, []).append(k)
    common = {}
    for ids in where.values():
        for x, a in enumerate(ids):
            for b in ids[x + 1 :]:
                common[a, b] = common.get((a, b), 0) + 1
    links = [(a, b) for (a, b), n in common.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]
    found = components(texts, links)
    return {k: (len(s), found[k]) for k, s in sets.items()}
