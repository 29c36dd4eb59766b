"""Plain single-process versions of the operators, to hold their results against."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text, lower=False):
    data = (text or "").encode()
    return WORD.findall(data.lower() if lower else data)


def components(nodes, links):
    label = {n: n for n in nodes}

    def root(n):
        while label[n] != n:
            n = label[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        label[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def pieces(texts, model):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    for t in texts:
        ids = sp.encode(t or "", add_bos=True, add_eos=True)
        packed = np.array(ids, "<u4").tobytes()
        yield ids, hashlib.sha256(packed).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def line_dedup(rows, min_sites):
    """rows: (id, text, site), in order of id."""
    sites, first = defaultdict(set), {}
    for i, text, site in rows:
        for pos, line in enumerate((text or "").split("\n") if text is not None else []):
            key = line.strip(" \t\r")
            if key:
                if site is not None:
                    sites[key].add(site)
                first[key] = min(first.get(key, (i, pos)), (i, pos))
    out = []
    for i, text, _ in rows:
        if text is None:
            out.append((i, None, 0, 0))
            continue
        lines = text.split("\n")
        key = lambda line: line.strip(" \t\r")
        kept = [x for pos, x in enumerate(lines) if not key(x) or len(sites[key(x)]) < min_sites or first[key(x)] == (i, pos)]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def fingerprint(text):
    from xxhash import xxh64_intdigest

    w = words(text, lower=True)
    grams = [b" ".join(w[i : i + 4]) for i in range(max(len(w) - 3, 1))] if w else []
    hashes = [xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def simhash(rows, max_bits=4):
    prints = {i: fingerprint(t) for i, t in rows}
    distinct = sorted(set(prints.values()))
    values = np.array(distinct, np.uint64)
    links = []
    for n, v in enumerate(values):
        links += [(n, n + 1 + int(j)) for j in np.flatnonzero(np.bitwise_count(values[n + 1 :] ^ v) <= max_bits)]
    label = components(range(len(distinct)), links)
    at = {v: i for i, v in enumerate(distinct)}
    smallest = {}
    for i, v in prints.items():
        c = label[at[v]]
        smallest[c] = min(smallest.get(c, i), i)
    return {i: (f"{v:016x}", smallest[label[at[v]]]) for i, v in prints.items()}


def vectors(rows, min_cosine=0.95):
    """rows: (id, list or None) -> {id: (n_links, component)}"""
    good = [(i, np.array(v, float)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, count = [], Counter()
    for n, (i, v) in enumerate(good):
        for j, u in good[n + 1 :]:
            if len(u) == len(v) and u @ v / np.sqrt(u @ u) / np.sqrt(v @ v) >= min_cosine:
                links.append((i, j))
                count.update((i, j))
    label = components([i for i, _ in rows], links)
    return {i: (count[i], label[i]) for i, _ in rows}


def substrings(rows, window=20):
    """rows: (id, text) with distinct ids -> {id: (n_words, n_removed, sha256)}"""
    seen, out = set(), {}
    for i, text in sorted(rows):
        w = words(text)
        gone = set()
        for p in range(len(w) - window + 1):
            key = tuple(w[p : p + window])
            if key in seen:
                gone.update(range(p, p + window))
            seen.add(key)
        kept = [x for p, x in enumerate(w) if p not in gone]
        out[i] = (len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


def base_scores(rows):
    """rows: (id, text) -> {id: (n_tokens, n_known, N, base score)}"""
    tokens = {i: [*words(t, lower=True), None] for i, t in rows}
    count = Counter(w for i, ws in tokens.items() if fold(i, 5) != 1 for w in ws)
    total, kinds = sum(count.values()), len(count)
    den = total + 0.5 * (kinds + 1)
    return {
        i: (len(ws), sum(count[w] > 0 for w in ws), total, sum(np.log10((count[w] + 0.5) / den) for w in ws)) for i, ws in tokens.items()
    }


def tiling(item, doc, min_match):
    """Covered words of an item: the longest common run of free words is marked again and again."""
    free_item, free_doc = [True] * len(item), [True] * len(doc)
    covered = 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and free_item[i + n] and free_doc[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < min_match or not n:
            return covered
        free_item[i : i + n] = free_doc[j : j + n] = [False] * n
        covered += n


def contaminated(docs, items, min_match=5, min_coverage=0.8):
    """{(doc, item): covered words} of the pairs that reach the coverage."""
    out = {}
    for item_id, item in items:
        w = words(item, lower=True)
        for doc_id, doc in docs:
            own = words(doc, lower=True)
            size = min(min_match, len(w))
            runs = {tuple(x[p : p + size]) for x in (w,) for p in range(len(x) - size + 1)}
            if w and any(tuple(own[p : p + size]) in runs for p in range(len(own) - size + 1)):
                n = tiling(w, own, size)
                if n / len(w) >= min_coverage:
                    out[doc_id, item_id] = n
    return out


def languages(net, texts, window=256):
    """(label, mean probability) of each text by the network, one window of bytes at a time."""
    import regex

    from barframe.llm.words import lower_latin

    for text in texts:
        if text is None or not regex.search(r"\p{L}", text):
            yield None, 0.0
            continue
        data = lower_latin(np.frombuffer(text.encode(), np.uint8)).astype(np.int64)
        total = np.zeros(len(net.labels))
        for a in range(0, len(data), window):
            part = data[a : a + window]
            total += net.forward(np.pad(part, (0, window - len(part)), constant_values=256)[None])[0][0] * len(part)
        yield net.labels[int(total.argmax())], float(total.max() / len(data))


def pipeline(rows, items, net, model, min_score, min_sites):
    """rows: (id, text, site) with distinct ids -> {id: (text, n_tokens, sha256 of the ids)} of what all five stages keep."""
    rows = [r for r, (label, p) in zip(rows, languages(net, [r[1] for r in rows])) if label is not None and p >= min_score]
    rows = [(i, text) for i, text, _, _ in line_dedup(sorted(rows), min_sites)]
    classes = simhash(rows)
    rows = [(i, text) for i, text in rows if classes[i][1] == i]
    leaked = {i for i, _ in contaminated(rows, items)}
    rows = [(i, text) for i, text in rows if i not in leaked]
    return {i: (text, len(ids), digest) for (i, text), (ids, digest, _) in zip(rows, pieces([t for _, t in rows], model))}
