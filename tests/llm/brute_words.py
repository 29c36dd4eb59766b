"""Plain single-process versions of the spelling, prefix trie and packing operators."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {i: i + 32 for i in range(65, 91)}
SPACED = re.compile("[^\x20\x09-\x0d]+")


def vocabulary(rows, drop=True):
    """rows: (id, text). Words of at least 5 letters and 3 occurrences."""
    n = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if drop and h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def spelling(words):
    """words: {word: n}. {word: (form, root, n, n_near, form_n)}; near words by their deletion neighbours."""
    places = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            places[w[:i] + "\0" + w[i + 1 :]].add(w)
            places[w[:i] + w[i + 1 :]].add(w)
        places[w].add(w)
    found = defaultdict(set)
    for group in places.values():
        for a in group:
            found[a] |= {b for b in group if near(a, b)}
    form = {}
    for w, n in words.items():
        best = min(found[w], key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(found[w]), words.get(form[w]))
    return out


def rebuilt(rows):
    """rows: (conv, turn, role, text). {conv: [(role, text)]} after the heads are exchanged."""

    def digest(r):
        role, text = r[2] or "", r[3] or ""
        return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()

    own = defaultdict(list)
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, digest(r))):
        own[r[0]].append((r[2] or "", r[3] or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def trie(conversations):
    """{(smallest member, depth): (parent, n_convs, n_children, n_leaves, saved, ends)}"""
    members = defaultdict(list)
    for c, turns in sorted(conversations.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids, leaves, saved = Counter(), Counter(), Counter()
    for path in members:
        if path:
            kids[path[:-1]] += 1
    for path, who in members.items():
        own = (len(who) - 1) * len(SPACED.findall(path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += own
            leaves[path[:d]] += kids[path] == 0
    out = {}
    for path, who in members.items():
        ends = ",".join(str(c) for c in who if len(conversations[c]) == len(path))
        parent = members[path[:-1]][0] if path else None
        out[who[0], len(path)] = (parent, len(who), kids[path], leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest())
    return out


def token_ids(texts, path, end_id=2):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return [np.array([*e.ids, end_id], "<u4") for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
