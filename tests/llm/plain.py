"""Brute-force versions of the operators, over lists of rows."""

from __future__ import annotations

import hashlib
import math
import os
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def fold(doc_id, folds: int):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % folds


def fingerprints(rows):
    """doc_id, n_chars, edited_sha256, code points in common with the edited and the next text."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for k, (doc, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        out.append((doc, len(text), sha(edited), len(os.path.commonprefix([text, edited])), len(os.path.commonprefix([text, after]))))
    return out


def bag(text: str | None) -> Counter:
    w = words(low(text))
    if len(w) >= 5:
        return Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    return Counter([tuple(w)]) if w else Counter()


def classes(rows, similar=0.8):
    """For each row the number of its class."""
    bags, parent = [bag(t) for _, t in rows], list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    having = defaultdict(list)
    for k, b in enumerate(bags):
        for shingle in b:
            having[shingle].append(k)
    empty = [k for k, b in enumerate(bags) if not b]
    for k in empty:
        parent[root(k)] = root(empty[0])
    for k, b in enumerate(bags):
        both = Counter()
        for shingle, n in b.items():
            for j in having[shingle]:
                if j < k:
                    both[j] += min(n, bags[j][shingle])
        for j, n in both.items():
            if n / (sum(b.values()) + sum(bags[j].values()) - n) >= similar:
                parent[root(k)] = root(j)
    return [root(k) for k in range(len(rows))]


def near(rows):
    """doc_id, class_id, class_size."""
    number = classes(rows)
    members = defaultdict(list)
    for k, c in enumerate(number):
        members[c].append((rows[k][0] is None, rows[k][0] or 0))
    least = {c: (None if min(m)[0] else min(m)[1]) for c, m in members.items()}
    return [(r[0], least[c], len(members[c])) for r, c in zip(rows, number, strict=True)]


def equal(rows):
    """doc_id, keep_id, group_size, text_sha256."""
    groups = defaultdict(list)
    for doc, text in rows:
        groups[low(text)].append(doc)
    known = {t: max((d for d in ids if d is not None), default=None) for t, ids in groups.items()}
    return [(d, known[low(t)], len(groups[low(t)]), sha(low(t))) for d, t in rows]


def cut(rows, width=50):
    """doc_id, words, removed words, what is left."""
    first, split = {}, [words(t) for _, t in rows]
    for (doc, _), w in zip(rows, split, strict=True):
        for k in range(len(w) - width + 1) if doc is not None else ():
            key = tuple(w[k : k + width])
            first[key] = min(first.get(key, doc), doc)
    out = []
    for (doc, _), w in zip(rows, split, strict=True):
        gone = [False] * len(w)
        for k in range(len(w) - width + 1) if doc is not None else ():
            if first[tuple(w[k : k + width])] < doc:
                gone[k : k + width] = [True] * width
        left = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((doc, len(w), sum(gone), left))
    return out


def ppm(rows, order=5):
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    counts, after = Counter(), defaultdict(Counter)
    for doc, text in rows:
        if fold(doc, 7) == 2:
            continue
        w = words(low(text))
        counts.update(w)
        counts[None] += 1  # the end
        s = [256] * order + list(" ".join(w).encode()) + [256]
        for k in range(order, len(s)):
            for n in range(order + 1):
                after[tuple(s[k - n : k])][s[k]] += 1
    total, kinds = sum(counts.values()), len(counts)

    def log(history, x):
        value, excluded = 0.0, set()
        for n in range(order, -1, -1):
            live = {a: c for a, c in after.get(tuple(history[order - n :]), {}).items() if a not in excluded}
            if not live:
                continue
            under = sum(live.values())
            if x in live:
                return value + math.log10((live[x] - 0.5) / under)
            value += math.log10(len(live) / 2 / under)
            excluded |= set(live)
        return value - math.log10(257 - len(excluded))

    out = []
    for doc, text in rows:
        w = words(low(text))
        tokens = [*w, None]
        s = [256] * order + list(" ".join(w).encode()) + [256]
        base = sum(math.log10((counts[x] + 1) / (total + kinds + 1)) for x in tokens)
        score = sum(log(s[k - order : k], s[k]) for k in range(order, len(s)))
        out.append((doc, fold(doc, 7) == 2, len(tokens), sum(counts[x] > 0 for x in tokens), total, base, score))
    return out


def digest(*parts) -> str:
    return sha("".join(parts))


def merkle(rows, fan=16):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of (doc_id, source, lang, n_chars, text)."""
    def leaf(row):
        return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])

    def climb(nodes):
        """The node that remains, and for each one below it the siblings before and after, level by level."""
        below, paths = [[k] for k in range(len(nodes))], [[] for _ in nodes]
        while len(nodes) > 1:
            runs = [range(k, min(k + fan, len(nodes))) for k in range(0, len(nodes), fan)]
            for run in runs:
                for k in run:
                    step = ("".join(nodes[j] for j in run if j < k), "".join(nodes[j] for j in run if j > k))
                    for leaf_of in below[k]:
                        paths[leaf_of].append(step)
            nodes = [digest(*[nodes[k] for k in run]) for run in runs]
            below = [[x for k in run for x in below[k]] for run in runs]
        return nodes[0], paths

    sources = defaultdict(list)
    for row in rows:
        sources[row[1]].append((row[0] is not None, row[0] or 0, leaf(row), row))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = [(sorted(sources[s], key=lambda x: x[:3])) for s in names]
    climbed = [climb([x[2] for x in tree]) for tree in trees]
    if not climbed:
        return []
    root, above = climb([subroot for subroot, _ in climbed])
    out = []
    for tree, (subroot, paths), rest in zip(trees, climbed, above, strict=True):
        for (_, _, own, row), path in zip(tree, paths, strict=True):
            shown = own
            if row[0] is not None and fold(row[0], 5) == 0 and row[4] is not None:
                shown = leaf((*row[:4], low(row[4])))
            for before, after in path + rest:
                shown = digest(before, shown, after)
            proof = digest(*[before + after for before, after in path + rest])
            out.append((row[0], own, subroot, root, proof, shown, shown == root))
    return out


def simhash(text: str | None) -> int:
    w = words(low(text))
    found = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in found]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def hamming(rows, near=3):
    """doc_id, fingerprint, component_id."""
    prints = [simhash(t) for _, t in rows]
    nodes, parent = sorted(set(prints)), {}

    def root(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for k, a in enumerate(nodes):
        for b in nodes[:k]:
            if (a ^ b).bit_count() <= near:
                parent[root(a)] = root(b)
    least = {}
    for (doc, _), p in zip(rows, prints, strict=True):
        if doc is not None:
            least[root(p)] = min(doc, least.get(root(p), doc))
    return [(doc, f"{p:016x}", least.get(root(p))) for (doc, _), p in zip(rows, prints, strict=True)]


def edits_apart(a: str, b: str) -> bool:
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def spelling(rows):
    """word, form, root, n, n_near, form_n."""
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = low(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            counts[word if h % 97 else word[: h % len(word)] + word[h % len(word) + 1 :]] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: [x for x in words if abs(len(x) - len(w)) < 2 and edits_apart(w, x)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return [(w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()]
