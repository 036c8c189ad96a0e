"""Plain versions of the operators' definitions, for small inputs."""

from __future__ import annotations

import hashlib
import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SPACE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
A_TO_Z = {c: c + 32 for c in range(65, 91)}


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def alnum(text: str | None) -> list[str]:
    return ALNUM_WORDS.findall((text or "").translate(A_TO_Z))


def docs_frame(spark, rows):
    """Documents from (doc_id, text) pairs."""
    return spark.createDataFrame([(i, t, "en", "src0", len(t) if t is not None else None) for i, t in rows], SCHEMA)


def substring_dedup(rows, width=50):
    words = [(i, SPACE_WORDS.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        if i is None:
            continue
        for k in range(len(w) - width + 1):
            key = tuple(w[k : k + width])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        if i is not None:
            for k in range(len(w) - width + 1):
                if first[tuple(w[k : k + width])] < i:
                    gone.update(range(k, k + width))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), sha(kept)))
    return out


def decontaminate(rows, items, ngram=10):
    windows = {}
    for item, text in items:
        w = alnum(text)
        if item is None or not w:
            continue
        n = min(ngram, len(w))
        for k in range(len(w) - n + 1):
            windows.setdefault(tuple(w[k : k + n]), set()).add(str(item))
    lengths = sorted({len(k) for k in windows})
    out = []
    for i, text in rows:
        w, hit, found = alnum(text), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                own = windows.get(tuple(w[k : k + n]))
                if own:
                    hit.update(range(k, k + n))
                    found |= own
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def shingles(text):
    words = [w.translate(A_TO_Z) for w in SPACE_WORDS.findall(text or "")]
    n = min(5, len(words))
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if words else set()


def near_classes(rows, threshold=0.8):
    """Smallest id of each document's class; rows without id or words stand alone."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and len(a & b) >= threshold * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i, _ in sets}


def line_words(line):
    """Leaf and words of a line, digits masked."""
    words = SPACE_WORDS.findall(line)
    if not re.search("[A-Za-z]|[^\\x00-\\x7f]", line):
        return (len(words), *words[:2]), words
    lead = ["<*>" if re.search("[0-9]", w) else w for w in words[:2]]
    return (len(words), *lead), [re.sub("[0-9]+", "<*>", w) for w in words]


def line_dedup(rows):
    """A plain log-template tree, line by line in order of ids."""
    leaves, first = {}, {}
    for i, t in sorted((r for r in rows if None not in r), key=lambda r: r[0]):
        for line in t.split("\n"):
            leaf, words = line_words(line)
            templates = leaves.setdefault(leaf, [])
            for lead, doc in templates:
                if 5 * sum(a != b for a, b in zip(lead, words)) <= len(words):
                    break
            else:
                templates.append((words, doc := i))
            first[line, i] = doc
    out = []
    for i, t in rows:
        lines = t.split("\n") if t is not None else []
        kept = [x for x in lines if i is None or not SPACE_WORDS.findall(x) or first[x, i] == i]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def cosine_classes(rows, threshold=0.98):
    """(id, links, class, kept) of (id, vector, label) rows with distinct ids, all pairs compared."""
    import numpy as np

    good = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float64)
            good[i] = (label, x / np.sqrt((x * x).sum()))
    links = {i: 0 for i, _, _ in rows}
    parent = dict.fromkeys(good)
    parent = {i: i for i in good}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (li, a) in good.items():
        for j, (lj, b) in good.items():
            if i < j and li == lj and len(a) == len(b) and float(a @ b) >= threshold:
                links[i] += 1
                links[j] += 1
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [(i, links[i], root(i) if i in parent else i, (root(i) if i in parent else i) == i) for i, _, _ in rows]


def licence_base(text):
    words, places = alnum(text), []
    for phrase, label in (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")):
        want = phrase.split()
        places += [(k, label) for k in range(len(words)) if words[k : k + len(want)] == want]
    return len(words), places
