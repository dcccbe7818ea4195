"""Plain Python forms of what the operators compute, for small inputs."""

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def shingles(text, k=5):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def components(docs):
    """The smallest id that links reach, by id."""
    ids = [i for i, _ in docs]
    sets, root = {i: shingles(t) for i, t in docs}, {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x in ids:
        for y in ids:
            both = len(sets[x] & sets[y])
            if x < y and both and 100 * both >= 75 * len(sets[x] | sets[y]):
                a, b = sorted((find(x), find(y)))
                root[b] = a
    return {i: find(i) for i in ids}


def without_repeats(docs, k=20):
    """``(removed, kept words)`` by id."""
    seen, out = set(), {}
    for i, text in sorted(docs):
        w = words(text)
        gone = set()
        for at in range(len(w) - k + 1):
            run = tuple(w[at:at + k])
            if run in seen:
                gone.update(range(at, at + k))
            seen.add(run)
        out[i] = len(gone), [x for p, x in enumerate(w) if p not in gone]
    return out


def counts(text):
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    runs = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    repeated = {p for i in range(len(w) - 7) if runs[tuple(w[i:i + 8])] > 1 for p in range(i, i + 8)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(repeated))
