"""Small tables and plain versions the tests compare with."""

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, *rows, extra=""):
    """A documents table of (doc_id, text) or (doc_id, text, lang) rows."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, words=3):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", lower_ascii(text)) if x]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1)))


def component_ids(sets, percent):
    """Smallest reachable key, over a dict of key to set, by comparing all pairs."""
    keys = sorted(sets)
    best = {k: k for k in keys}

    def root(k):
        while best[k] != k:
            k = best[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = sorted((root(a), root(b)))
                best[y] = x
    return {k: root(k) for k in keys}
