"""Plain versions of the operators, by brute force over small inputs."""

import hashlib
import re

import numpy as np


def shingle_set(text, words):
    if text is None:
        return frozenset()
    found = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1)))


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def components(ids, links):
    top = {i: i for i in ids}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_links(texts, words, percent=80):
    """Pairs of ids with similar enough sets, from {id: text}."""
    sets = {i: shingle_set(t, words) for i, t in texts.items()}
    return [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and sets[b]
        and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]


def vector_links(vectors, threshold=0.95):
    unit = {}
    for i, v in vectors.items():
        if v and None not in v and np.isfinite(v).all() and np.linalg.norm(v):
            unit[i] = np.array(v, float) / np.linalg.norm(v)
    return [
        (a, b)
        for a in unit
        for b in unit
        if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold
    ]


def repeats(texts, length=200):
    """(bytes, removed, spans, digest of the rest) per text."""
    datas = [(t or "").encode() for t in texts]
    seen = {}
    for data in datas:
        for i in range(len(data) - length + 1):
            seen[data[i : i + length]] = seen.get(data[i : i + length], 0) + 1
    out = []
    for data in datas:
        covered = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            if seen[data[i : i + length]] > 1:
                covered[i : i + length] = True
        begins = covered & ~np.append(False, covered[:-1])[: len(covered)]
        rest = np.frombuffer(data, np.uint8)[~covered].tobytes()
        out.append((len(data), int(covered.sum()), int(begins.sum()), hashlib.sha256(rest).hexdigest()))
    return out
