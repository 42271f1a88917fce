"""Plain versions of the operators, for comparison on small inputs."""

import hashlib
import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = 2**63 - 1


def id_of(doc_id):
    return LAST if doc_id is None else doc_id


def words(text):
    return WORD.findall(text or "")


def remove_repeats(rows, window=13):
    """[(doc_id, n_words, n_removed, sha256)] for [(doc_id, text)]."""
    first = {}
    for doc_id, text in rows:
        own = words(text)
        for i in range(len(own) - window + 1):
            key = tuple(own[i : i + window])
            first[key] = min(first.get(key, LAST), id_of(doc_id))
    out = []
    for doc_id, text in rows:
        own = words(text)
        gone = set()
        for i in range(len(own) - window + 1):
            if first[tuple(own[i : i + window])] < id_of(doc_id):
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(own) if i not in gone)
        out.append((doc_id, len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    own = words(lower)
    shingles = [" ".join(own[i : i + 4]) for i in range(max(1, len(own) - 3))] if own else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    """The smallest node reachable from each, by linked(a, b)."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {n: root(n) for n in nodes}


def near_duplicate_groups(rows):
    """{(doc_id, fingerprint, component_id)} for [(doc_id, text)]."""
    marks = [(id_of(doc_id), fingerprint(text)) for doc_id, text in rows]
    lowest = {}
    for doc_id, mark in marks:
        lowest[mark] = min(lowest.get(mark, LAST), doc_id)
    found = components(sorted(lowest), lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for mark, root in found.items():
        least[root] = min(least.get(root, LAST), lowest[mark])

    def known(doc_id):
        return None if doc_id == LAST else doc_id

    return sorted(
        (known(d) is None, d, f"{mark:016x}", known(least[found[mark]])) for d, mark in marks
    )
