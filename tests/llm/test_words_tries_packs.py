import random
import zlib
from collections import Counter, defaultdict

import brute_words as brute
import numpy as np
import pytest
from cases import ROWS, docs, empty, odd, passage  # noqa: F401

from barframe.llm import packing, prefix_trie, scan, spelling
from barframe.llm.queries import QUERIES, model_path
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
TURNS = "conv_id bigint, turn bigint, role string, text string, a bigint, digest string, place int"


def nodes(df):
    return {
        (r["conv_id"], r["depth"]): (r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"])
        for r in df.collect()
    }


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], TURNS)


def built(spark, rows, **kw):
    turns = prefix_trie.turn_digests(conversations(spark, rows))
    fold = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    spliced = prefix_trie.splice_heads(turns, F.col("conv_id") - F.col("conv_id") % 20, fold, 4)
    return nodes(prefix_trie.prefix_trie(spliced, turns.select("conv_id").distinct(), **kw))


def test_scan_over_split_groups(spark):
    rng = random.Random(1)
    rows = [(g, i, rng.randrange(10), bytes([rng.randrange(3)])) for g, n in enumerate([1, 500, 0, 3, 40, 200]) for i in range(n)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g long, i long, v long, d binary")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = scan.segmented_scan(df, ["g"], ["i"], sums=["v"], lead=["i"], chain="d").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(out) == len(rows)
    by_group, keys = defaultdict(list), {}
    for r in sorted(out, key=lambda r: (r["g"], r["i"])):
        before = by_group[r["g"]]
        before.append(r)
        assert r["index"] == len(before) - 1 and r["v_upto"] == sum(x["v"] for x in before)
        path = tuple(bytes(x["d"]) for x in before)
        assert keys.setdefault(path, (r["key_hi"], r["key_lo"])) == (r["key_hi"], r["key_lo"])
        assert (r["before_hi"], r["before_lo"]) == (keys[path[:-1]] if path[:-1] else (None, None))
    assert len(set(keys.values())) == len(keys)
    for group in by_group.values():
        assert [r["i_next"] for r in group] == [r["i"] for r in group[1:]] + [None]
        assert [r["last"] for r in group] == [False] * (len(group) - 1) + [True]


def test_list_rank(spark):
    n = 300
    order = list(range(n))
    random.Random(2).shuffle(order)
    rows = [(a, a % 2, b, None if b is None else b % 2) for a, b in zip(order, [*order[1:], None])]
    arcs = spark.createDataFrame(rows, "a long, b long, na long, nb long")
    for tail in (1, 50, 1000):
        got = {r["a"]: r["rank"] for r in prefix_trie.list_rank(arcs, tail).collect()}
        assert [got[a] for a in order] == list(range(n - 1, -1, -1))


def test_trie_edge_cases(spark):
    rows = [
        (0, 0, "user", "hello there"), (0, 1, "bot", "good day to you"), (0, 2, "user", "thanks"), (0, 3, "bot", "bye"),
        *[(i, t, "user", f"turn {t}") for i in range(1, 20) for t in range(i % 5 + 1)],
        (20, None, "user", "null turn first"), (20, 0, None, None), (20, 0, None, None), (20, 1, "user", ""),
        *[(i, t, "user" if t % 2 else None, "same") for i in range(21, 40) for t in range(3)],
        *[(45, t, "x", "y") for t in range(60)], (67, 0, "a", "b"), (68, 5, "a", "b"), (None, 0, "user", "no conversation"),
        (-3, 0, "n", "negative"), (-3, 1, "n", "two words"), (0, 9, "a\x1c", "b c\x85d"),
    ]
    fixed = [r for r in rows if r[0] is None or r[0] >= 0]
    assert built(spark, fixed, tail=4) == brute.trie(brute.rebuilt(fixed))
    turns = prefix_trie.turn_digests(conversations(spark, rows))
    own = defaultdict(list)
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None and r[0] != 20), key=lambda r: r[1]):
        own[c].append((role or "", text or ""))
    assert nodes(prefix_trie.prefix_trie(turns.where("conv_id <> 20"))) == brute.trie(own)


def test_trie_of_no_conversation(spark):
    assert built(spark, []) == {}
    assert built(spark, [(None, 0, "user", "x")]) == {}
    one = built(spark, [(67, 0, "a", "b")])
    assert one == brute.trie(brute.rebuilt([(67, 0, "a", "b")]))


def test_member_digests_of_many_chunks(spark):
    ids = [-5, -1, 0, *range(7, 400)]
    df = spark.createDataFrame([(1, 2, i) for i in ids] + [(1, 3, 9)], "key_hi long, key_lo long, conv_id long")
    import hashlib

    got = {r["key_lo"]: r["ends_sha256"] for r in prefix_trie.member_digests(df, chunk_ids=10).collect()}
    assert got == {2: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), 3: hashlib.sha256(b"9").hexdigest()}


def test_trie_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert nodes(QUERIES["op12_prefix_trie"](spark, SF)) == brute.trie(brute.rebuilt(rows))


def forms(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def variants(rng, count, letters="abcé"):
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(5, 10))) for _ in range(count)]
    out = set(base)
    for w in base:
        i = rng.randrange(len(w))
        out |= {w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :], w + "z", "z" + w}
    return {w: rng.randrange(3, 60) for w in out if len(w) >= 5}


@pytest.mark.parametrize("block_words", [4, 64, 2048])
def test_spelling_equals_brute_force(spark, block_words):
    words = variants(random.Random(block_words), 250)
    words |= {"verein" * 20 + x: 5 + i for i, x in enumerate(["", "a", "b", "ab", "ba", "é"])} | {"aaaaa": 9, "aaaaaa": 9, "aaaaaaa": 20}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert forms(spelling.spelling_forms(df, block_words=block_words)) == brute.spelling(words)


def test_near_in_one_index():
    words = sorted(variants(random.Random(5), 80, "ab"), key=lambda w: (len(w), w))
    n = np.arange(len(words))
    for m in {len(w) for w in words}:
        here = [w for w in words if len(w) in (m, m + 1)]
        size = len(here)
        full = np.zeros(size, int), np.full(size, m), np.zeros(size, int), np.full(size, m + 1)
        counts, best = spelling.near_in_index(here, n[:size], *full)
        for i, w in enumerate(here):
            near = [j for j, o in enumerate(here) if brute.near(w, o) and min(len(w), len(o)) == m]
            assert counts[i] == len(near) and best[i] == (near[0] if near else -1)


def test_word_counts(docs, odd, empty):
    # noqa: F811
    rows = [(r[0], r[1]) for r in ROWS]
    for df, own in ((docs, rows), (odd, [*rows[:5], *rows[:2], (None, passage(0, 60)), (None, None)])):
        got = {r["word"]: r["n"] for r in spelling.word_counts(df, "doc_id", "text", drop=True).collect()}
        assert got == brute.vocabulary(own)
    assert spelling.word_counts(empty, "doc_id", "text").count() == 0
    assert spelling.spelling_forms(spelling.word_counts(empty, "doc_id", "text")).count() == 0


def test_word_counts_of_odd_letters(spark):
    texts = ["ÀÉÎõü×÷ÿé Straße STRASSE naïve", "ÀÉÎõü×÷ÿé" * 30, "x" * 70 + " " + "y" * 64 + " " + "z" * 65, "éa éb ēabcd ēabcd Āabcde abcdē", "abcdéfghij"] * 40
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["word"]: r["n"] for r in spelling.word_counts(df, "doc_id", "text", drop=True).collect()} == brute.vocabulary(rows)


def test_joined_crc():
    rng = random.Random(3)
    for size in (0, 1, 5, 63, 64):
        a, b = rng.randbytes(7), rng.randbytes(size)
        got = spelling.joined_crc(*(np.array([x], np.uint32) for x in (zlib.crc32(a), zlib.crc32(b))), np.array([size]))
        assert got[0] == zlib.crc32(a + b)


def test_spelling_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert forms(QUERIES["op11_spelling"](spark, SF)) == brute.spelling(brute.vocabulary(rows))


def check_packing(rows, pieces, window):
    """rows: (id, text); pieces: rows of ``pack``. Documents with one id may stand in any order."""
    ids = brute.token_ids([t for _, t in rows], model_path("word_bpe_49k.json", "WORD_MODEL"))
    line = defaultdict(dict)
    for p in pieces:
        assert p["length"] > 0 and p["offset"] not in line[p["sequence_id"]]
        line[p["sequence_id"]][p["offset"]] = p
    lengths = []
    for i in range(len(line)):  # gapless from 0, in sequences and within them
        at = 0
        for offset in sorted(line[i]):
            assert offset == at
            at += line[i][offset]["length"]
        lengths.append(at)
    assert sum(lengths) == sum(map(len, ids))
    full = sum(lengths) // window
    assert lengths[:full] == [window] * full
    assert all(n & (n - 1) == 0 and n < window for n in lengths[full:]) and len(set(lengths[full:])) == len(lengths) - full
    want, got = Counter(), Counter()
    for (i, _), x in zip(rows, ids):
        want[i, x.tobytes()] += 1
    held = None
    for s in range(len(line)):
        for offset in sorted(line[s]):
            p = line[s][offset]
            if held is None:
                assert p["start"] == 0
                held = [p["doc_id"], b"", p["doc_tokens"]]
            assert (held[0], held[2], len(held[1]) // 4) == (p["doc_id"], p["doc_tokens"], p["start"])
            held[1] += bytes(p["ids"])
            if len(held[1]) == 4 * held[2]:
                got[held[0], held[1]] += 1
                held = None
    assert held is None and got == want


@pytest.mark.parametrize("window", [16, 4096])
def test_packing(docs, odd, empty, window):
    path = model_path("word_bpe_49k.json", "WORD_MODEL")
    rows = [(r[0], r[1]) for r in ROWS]
    check_packing(rows, packing.pack(docs, path, window=window).collect(), window)
    check_packing(rows, packing.pack(docs, path, window=window, order_by="doc_id").collect(), window)
    check_packing([*rows[:5], *rows[:2], (None, passage(0, 60)), (None, None)], packing.pack(odd, path, window=window).collect(), window)
    assert packing.pack(empty, path, window=window).count() == 0


def test_packing_of_odd_texts(spark):
    texts = [
        "a\x1cb \x85 c d e\tf", "<|endoftext|> x<|startoftext|>y", "I'll it's\n'S 'll", "é ́e a\ńb", "ΣΑΣ İstanbul ẞ", "  \n\n  ",
        "x" * 3000, "123 45٠ ½", "日本語 テスト", "퟿ \U0001f600‍", "a\r\nb\r\n c\x00d",
    ]
    rng = random.Random(4)
    parts = [" ", "\n", "\t", "\x1c", "́", "a", "B", "é", "'s", "7", "!", "<|endoftext|>", "ŉ", "　", "ǆ"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 30))) for _ in range(400)]
    plain = [*map(chr, range(33, 127)), *map(chr, range(0xC0, 0x100)), *"'sStTrReEvVmMlLdD" * 3, "'ll", "'re", "<|", " ", " ", " "]
    texts += ["".join(rng.choice(plain) for _ in range(rng.randrange(1, 200))) for _ in range(400)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check_packing(rows, packing.pack(df, model_path("word_bpe_49k.json", "WORD_MODEL"), window=64).collect(), 64)


def test_packing_refuses_tokens_that_cross_whitespace():
    with pytest.raises(ValueError, match="whitespace"):
        packing.ChunkTokenizer(model_path("byte_bpe_50k.json", "OTHER_MODEL"))


def test_packing_with_a_small_table(monkeypatch):
    monkeypatch.setattr(packing, "TABLE_CHUNKS", 3)
    path = model_path("word_bpe_49k.json", "WORD_MODEL")
    tokenizer = packing.ChunkTokenizer(path)
    texts = [r[1] or "" for r in ROWS] * 2
    got = [np.frombuffer(p, tokenizer.kind).tolist() for t in texts for p in tokenizer.packed([t], 2)]
    assert got == [x.tolist() for x in brute.token_ids(texts, path)]


def test_packing_query_and_sequences(spark):
    out = QUERIES["op13_packing"](spark, SF)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    texts = dict(map(tuple, spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()))
    path = model_path("word_bpe_49k.json", "WORD_MODEL")
    ids = dict(zip(texts, brute.token_ids(texts.values(), path)))
    for p in out.collect():
        piece = ids[p["doc_id"]][p["start"] : p["start"] + p["length"]]
        assert (p["length"], p["ids_crc32"], p["doc_tokens"]) == (len(piece), zlib.crc32(piece.tobytes()), len(ids[p["doc_id"]]))
    sums = packing.sequences(out).agg(F.sum("length"), F.sum("padded")).first()
    assert sums[0] == sums[1] == sum(map(len, ids.values()))
