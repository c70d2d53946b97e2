"""Plain versions of the operators, for small tables."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def quality_measures(text):
    own = words(text)
    windows = [tuple(own[i : i + 3]) for i in range(len(own) - 2)]
    often = Counter(windows)
    again = set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            again |= {i, i + 1, i + 2}
    lines, seen = 0, set()
    for line in (text or "").split("\n"):
        if words(line):
            lines += line in seen
            seen.add(line)
    n = len(own)
    return {
        "n_words": n, "word_chars": sum(map(len, own)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": lines, "n_repeat_words": len(again), "base_failed": n < 50 or 100 * len(again) > 50 * n,
    }


def removed_words(docs):
    """docs: (doc_id, text) -> {row: (doc_id, n_words, n_removed, kept_sha256)}"""
    least = {}
    for doc_id, text in docs:
        own = words(text)
        for i in range(len(own) - 12):
            w = tuple(own[i : i + 13])
            key = float("inf") if doc_id is None else doc_id
            least[w] = min(least.get(w, key), key)
    rows = []
    for doc_id, text in docs:
        own = words(text)
        gone = set()
        for i in range(len(own) - 12):
            if least[tuple(own[i : i + 13])] < (float("inf") if doc_id is None else doc_id):
                gone.update(range(i, i + 13))
        kept = " ".join(w for i, w in enumerate(own) if i not in gone)
        rows.append((doc_id, len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return rows


def shingles(text):
    own = words(fold(text))
    if not own:
        return frozenset()
    return frozenset(tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4)))


def jaccard_groups(docs):
    """docs: (doc_id, text) with unique ids -> [(doc_id, n_shingles, component_id)]"""
    sets = {d: shingles(t) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = {}
    for d, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(d)
    shared = Counter()
    for ids in holders.values():
        ids = sorted(ids)
        for i, a in enumerate(ids):
            for b in ids[i + 1 :]:
                shared[a, b] += 1
    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return [(d, len(s), find(d)) for d, s in sets.items()]


def encoded(tokenizer, text, end):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def base_scores(docs):
    """[(doc_id, held_out, n_tokens, n_known, train_tokens, base_score)]"""
    held = {i: zlib.crc32(b"" if d is None else str(d).encode()) % 7 == 2 for i, (d, _) in enumerate(docs)}
    tokens = [[*words(fold(t)), None] for _, t in docs]
    counts = Counter(w for i, own in enumerate(tokens) if not held[i] for w in own)
    total, distinct = sum(counts.values()), len(counts)
    return [
        (d, held[i], len(own), sum(counts[w] > 0 for w in own), total,
         sum(np.log10((counts[w] + 1) / (total + distinct + 1)) for w in own))
        for i, ((d, _), own) in enumerate(zip(docs, tokens))
    ]


def nearest(rows, k=10):
    """rows: (vec_id, vector) -> [(query_id, rank, vec_id, score)]"""
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v
            and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float) != 0)]
    out = []
    for q, v in good:
        if q % 100 == 0:
            near = sorted((float(np.sqrt(((w - v) ** 2).sum())), i) for i, w in good if i != q)[:k]
            out += [(q, r, i, d) for r, (d, i) in enumerate(near, 1)]
    return out


def linked_groups(docs, width=4, similar=80):
    """docs: (doc_id, text); rows of one id are one node -> sorted [(doc_id, n_shingles, component_id, kept)]"""

    def shingled(text):
        own = words(fold(text))
        return frozenset(tuple(own[i : i + width]) for i in range(max(1, len(own) - width + 1))) if own else frozenset()

    sets = [(d, shingled(t)) for d, t in docs]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = {}
    for i, (d, s) in enumerate(sets):
        for g in s if d is not None else ():
            holders.setdefault(g, []).append(i)
    shared = Counter()
    for rows in holders.values():
        for n, i in enumerate(rows):
            for j in rows[n + 1 :]:
                shared[i, j] += 1
    for (i, j), n in shared.items():
        if 100 * n >= similar * (len(sets[i][1]) + len(sets[j][1]) - n):
            x, y = sorted((find(sets[i][0]), find(sets[j][0])))
            root[y] = x
    return Counter((d, len(s), None if d is None else find(d), d is None or find(d) == d) for d, s in sets)


def phrase_rows(docs, least, longest=4, top=2000):
    """docs: (lang, text) -> [(lang, rank, phrase, a, l, r, n, score)]"""
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", fold(text)):
            own = re.findall("[^ \t]+", piece)
            n[lang] += len(own)
            for k in range(1, longest + 1):
                f.update((lang, tuple(own[i : i + k])) for i in range(len(own) - k + 1))
    found = {}
    often = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    inside = {}
    for (lang, p), a in often.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                inside[lang, p[i : i + k]] = max(a, inside.get((lang, p[i : i + k]), 0))
    for (lang, p), a in often.items():
        if 100 * inside.get((lang, p), 0) >= 80 * a:
            continue
        cuts = []
        for k in range(1, len(p)):
            left, right = f[lang, p[:k]], f[lang, p[k:]]
            cuts.append((2000000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return Counter(
        (lang, rank, p.decode(), -a, left, right, n[lang], -score)
        for lang, rows in found.items() for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1)
    )


def negatives(rows, positives=5, wanted=10):
    """rows: (vec_id, label, vector) with unique ids -> Counter of result rows"""
    good = {}
    for i, label, v in rows:
        if None in (i, label, v) or not v or None in v or not np.isfinite(np.array(v, float)).all():
            continue
        good[i] = ((label + 1) % 10 if i % 7 == 0 else label, [int(np.floor(256 * float(x))) for x in v])
    out = Counter()
    for anchor, (label, v) in good.items():
        if anchor % 100:
            continue
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, (_, w) in good.items() if i != anchor)
        for s, p in [x for x in scores if good[x[1]][0] == label][:positives]:
            fit = [(t, i) for t, i in scores if good[i][0] != label and 30 * -s <= 100 * -t <= 90 * -s][:wanted]
            out.update((anchor, p, rank, i, -s, -t) for rank, (t, i) in enumerate(fit, 1))
    return out
