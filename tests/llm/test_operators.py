import hashlib
import random
import types

import brute
import numpy as np
import pyarrow as pa
import pytest
from cases import ROWS, docs, empty, odd, passage  # noqa: F401

from barframe.llm import (
    components,
    decontaminate,
    keyed_sums,
    language_id,
    line_dedup,
    lm_scoring,
    piece_codec,
    sharding,
    simhash,
    substring_dedup,
    vector_dedup,
    warc,
)
from barframe.llm import words as word_module
from barframe.llm.queries import QUERIES, model_path
from pyspark.sql import functions as F

TEXTS = [(r[0], r[1]) for r in ROWS]


def by_id(df, *cols, key="doc_id"):
    return {r[key]: tuple(r[c] for c in cols) for r in df.select(key, *cols).collect()}


def test_pieces_equal_the_library(docs):
    got = by_id(piece_codec.encode_digests(docs, model_path()), "n_tokens", "ids_sha256", "decoded_sha256")
    for (i, _), (ids, a, b) in zip(TEXTS, brute.pieces([t for _, t in TEXTS], model_path())):
        assert got[i] == (len(ids), a, b), i
    round_trip = piece_codec.decode(piece_codec.encode(docs, model_path()), model_path())
    assert all(r["decoded"] == (r["text"] or "") or "▁" in r["text"] for r in round_trip.collect())


def test_pieces_with_a_small_table(monkeypatch):
    monkeypatch.setattr(piece_codec, "TABLE_CHUNKS", 3)
    table = piece_codec.ChunkTable(model_path())
    texts = [t or "" for _, t in TEXTS] * 2
    packed = [p for t in texts for p in table.encode_packed([t])]
    assert [hashlib.sha256(p).hexdigest() for p in packed] == [a for _, a, _ in brute.pieces(texts, model_path())]


@pytest.mark.parametrize("min_sites", [2, 12, 13])
def test_line_dedup(docs, min_sites):
    out = line_dedup.dedup_lines(docs, min_sites=min_sites)
    assert out.columns == [*docs.columns, "n_lines", "n_removed_lines"]
    got = by_id(out, "text", "n_lines", "n_removed_lines")
    want = brute.line_dedup([(r[0], r[1], r[3]) for r in ROWS], min_sites)
    assert got == {i: (t, n, r) for i, t, n, r in want}


def test_simhash_fingerprints_and_classes(docs):
    out = simhash.simhash_classes(docs).withColumn("hex", F.lower(F.lpad(F.hex("fp"), 16, "0")))
    assert by_id(out, "hex", "component_id") == brute.simhash(TEXTS)


@pytest.mark.parametrize("max_bits", [0, 2, 4])
def test_trie_join_finds_every_link(spark, max_bits):
    rng = np.random.default_rng(max_bits)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    near = [b ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, k).astype(np.uint64)) for b in base for k in (1, 2, 3, 4, 5, 6)]
    values = np.unique(np.concatenate([base, np.array(near, np.uint64)]))
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp bigint")
    links = [(np.int64(r["src"]).view(np.uint64), np.int64(r["dst"]).view(np.uint64)) for r in simhash.near_links(frame, max_bits).collect()]
    index = {v: i for i, v in enumerate(values)}
    truth = [(i, j) for i in range(len(values)) for j in range(i + 1, len(values)) if int(values[i] ^ values[j]).bit_count() <= max_bits]
    got = brute.components(range(len(values)), [(index[a], index[b]) for a, b in links])
    assert got == brute.components(range(len(values)), truth)


def test_components(spark):
    pairs = [(i, i + 1) for i in range(30) if i % 7] + [(50, 3), (50, 50), (90, 80)] + [(100, 100 + i) for i in range(1, 40)]
    frame = spark.createDataFrame([*pairs, (None, 4)], "src bigint, dst bigint")
    got = {r["node"]: r["component"] for r in components.connected_components(frame).collect()}
    want = brute.components({n for p in pairs for n in p}, pairs)
    assert got == {n: want[n] for n in got} and {n for p in pairs if p[0] != p[1] for n in p} == set(got)


def test_substrings(docs):
    out = substring_dedup.dedup_substrings(docs, kept="sha256")
    assert by_id(out, "n_words", "n_removed", "kept") == brute.substrings(TEXTS)


@pytest.mark.parametrize("seed", range(3))
def test_substrings_of_few_words(spark, seed):
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choice("aab") for _ in range(rng.randint(0, 60)))) for i in range(80)]
    out = substring_dedup.dedup_substrings(spark.createDataFrame(rows, "doc_id bigint, text string"), window=8, kept="sha256")
    assert by_id(out, "n_words", "n_removed", "kept") == brute.substrings(rows, 8)


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_shared_passages_meet_once_a_slice(spark, kind):
    """Whatever the order of the ids, no task gets a row for each document of a passage that all share."""
    rng = random.Random(4)
    rows = [(f"{i:03d}" if kind == "string" else i, f"{passage(300 * i, rng.randint(0, 9))} {passage(0, 30)} {passage(300 * i + 50, 9)}") for i in range(1, 200)]
    shuffled = rng.sample(rows, len(rows))
    frame = spark.createDataFrame(shuffled, f"doc_id {kind}, text string")
    assert by_id(substring_dedup.dedup_substrings(frame, kept="sha256"), "n_words", "n_removed", "kept") == brute.substrings(rows)
    shared = types.SimpleNamespace(value=substring_dedup.shared_symbols(frame.coalesce(1), "doc_id", "text"))
    ids, texts = (pa.array([c[k] for c in shuffled]) for k in (0, 1))
    batch = pa.RecordBatch.from_arrays([ids, pa.array(range(len(ids)), pa.int64()), texts], names=["id", "mark", "text"])
    largest = [pa.Table.from_batches(substring_dedup._anchors(20, 2, hot)([batch])).to_pandas().groupby("name").size().max() for hot in (None, shared)]
    assert largest[0] > 64 > largest[1]


def test_windows_are_told_apart_by_all_64_bits(monkeypatch):
    def unmix(x):
        for shift, factor in ((31, 0x94D049BB133111EB), (27, 0xBF58476D1CE4E5B9), (30, 1)):
            x = (x ^ (x >> np.uint64(shift)) ^ (x >> np.uint64(2 * shift))) * np.uint64(pow(factor, -1, 1 << 64))
        return x

    whole = substring_dedup.span_hashes

    def alike(values, starts, ends):
        """Hashes of windows that differ in half of their bits only, also after mixing."""
        out = whole(values, starts, ends)
        return unmix(out >> np.uint64(32) | np.uint64(7 << 32))

    monkeypatch.setattr(substring_dedup, "span_hashes", alike)
    texts = [" ".join([*(f"a{i}b{j}" for j in range(15)), passage(0, 9), *(f"c{i}d{j}" for j in range(15))]) for i in range(50)]
    batch = pa.RecordBatch.from_pydict({"id": list(range(50)), "mark": list(range(50)), "text": texts})
    ((_, _, _, starts, name, at, _, _, _, again),) = substring_dedup._slices(batch, 20, 2)
    assert len(set(zip(name.tolist(), (at - starts).tolist()))) < len(starts) and not again.any()


def thue_morse(n=1024):
    """Two words that agree under every polynomial hash modulo 2 ** 64 with an odd base."""
    ones = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[i] for i in ones), "".join("ba"[i] for i in ones)


def test_different_words_have_different_hashes():
    rng = random.Random(6)
    some = [*thue_morse(), *thue_morse(64), "", "a", "a\x00", "b" * 8, "b" * 9, "b" * 64, "b" * 65, *("".join(rng.choice("ab") for _ in range(rng.randrange(1, 90))) for _ in range(3000))]
    some = sorted(set(some) - {""})
    data = np.frombuffer("  ".join(some).encode(), np.uint8)
    starts, ends, _ = word_module.find_words(data, np.array([0, len(data)]))
    hashes = word_module.word_hashes(data, starts, ends)
    assert len(set(hashes.tolist())) == len(some)
    order = rng.sample(range(len(some)), len(some))
    assert (word_module.word_hashes(data, starts[order], ends[order]) == hashes[order]).all()


def test_words_that_polynomials_confuse(spark):
    a, b = thue_morse()
    around = [f"p{i}" for i in range(10)], [f"q{i}" for i in range(9)]
    rows = [(i, " ".join([*around[0], w, *around[1]])) for i, w in enumerate((a, b))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert by_id(substring_dedup.dedup_substrings(df, kept="sha256"), "n_words", "n_removed", "kept") == brute.substrings(rows)
    model = lm_scoring.train(spark.createDataFrame([(0, a)], "doc_id bigint, text string"), "text", F.lit(True))
    known = by_id(lm_scoring.score(spark.createDataFrame([(0, a), (1, b)], "doc_id bigint, text string"), model, "text", {"doc_id": F.col("doc_id")}), "n_known")
    assert known == {0: (2,), 1: (1,)}


def test_rows_of_one_id_are_cleaned_each_by_itself(spark):
    clean = " ".join(f"clean{i}" for i in range(60))
    rows = [(1, passage(0, 60)), (5, passage(0, 60)), (5, clean), (None, passage(300, 60)), (None, passage(500, 60)), (7, passage(500, 60)), (7, passage(500, 60))]
    out = substring_dedup.dedup_substrings(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    got = sorted((str(r["doc_id"]), r["n_removed"], r["kept"]) for r in out)
    assert got == sorted([("1", 0, passage(0, 60)), ("5", 60, ""), ("5", 0, clean), ("None", 0, passage(300, 60)), ("None", 0, passage(500, 60)), ("7", 60, ""), ("7", 60, "")])


def test_lines_of_one_id_are_cleaned_each_by_itself(spark):
    rows = [(i, f"boiler\nown {i}", f"s{i}") for i in range(1, 12)]
    rows += [(99, "x1\nboiler\nq", "a"), (99, "x2\nclean unique line\ny", "b"), (None, "z1\nclean too\nboiler", "c"), (None, "z2\nboiler\nother", "d")]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    got = sorted(r["text"] for r in out.where("doc_id is null or doc_id = 99").collect())
    first = [t for t in got if "boiler" in t]
    assert [t.replace("boiler\n", "").replace("\nboiler", "") for t in got] == ["x1\nq", "x2\nclean unique line\ny", "z1\nclean too", "z2\nother"]
    assert len(first) == 1 and first[0].startswith("z2")  # NULL comes first, and then the earlier line


def test_leaks_of_rows_that_share_an_id(spark, empty):
    item = passage(0, 40)
    half = passage(0, 20), passage(20, 20)
    docs = spark.createDataFrame([(None, half[0]), (None, half[1]), (None, "clean text of no item"), (None, f"before {item}"), (3, half[0]), (3, half[1])], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    out = decontaminate.contaminated_pairs(docs, items)
    found = [(r["doc_id"], r["item_id"], r["coverage"]) for r in out.collect()]
    assert found == [(None, 1, 1.0)]
    left = docs.join(out.select(F.col("text_mark")), F.xxhash64("text") == F.col("text_mark"), "left_anti")
    assert left.count() == 5 and left.where("text like 'before%'").count() == 0
    no_items = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.contaminated_pairs(docs, no_items).count() == 0
    assert decontaminate.contaminated_pairs(empty, items).count() == 0


def test_a_full_filter_of_names_changes_nothing(docs, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BLOOM_BITS", 6)
    out = substring_dedup.dedup_substrings(docs, kept="sha256")
    assert by_id(out, "n_words", "n_removed", "kept") == brute.substrings(TEXTS)


def test_vectors(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i, v in enumerate(rng.standard_normal((40, 16))):
        size = 60 if i == 0 else 1 + i % 4
        rows += [[float(x) for x in (v + 0.05 * rng.standard_normal(16))] for _ in range(size)]
    rows += [rows[0], rows[0], None, [], [0.0] * 16, [float("nan")] * 16, [None] * 16, [float("inf")] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0]]
    rows = list(enumerate(rows))
    out = vector_dedup.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    got = by_id(out, "n_links", "component_id", "kept", key="vec_id")
    want = brute.vectors(rows)
    assert got == {i: (n, c, i == c) for i, (n, c) in want.items()}


def test_vectors_of_dense_groups_that_link_with_each_other(spark):
    rng = np.random.default_rng(7)
    rows = []
    for family in rng.standard_normal((5, 24)):
        for group in family + 0.15 * rng.standard_normal((6, 24)):
            rows += [[float(x) for x in v] for v in group + 0.005 * rng.standard_normal((16, 24))]
    rows = list(enumerate(rows))
    out = vector_dedup.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    want = brute.vectors(rows)
    assert max(n for n, _ in want.values()) > 60  # links beyond the own group of 16
    assert by_id(out, "n_links", "component_id", "kept", key="vec_id") == {i: (n, c, i == c) for i, (n, c) in want.items()}


def test_vectors_of_extreme_size(spark):
    rows = [(0, [1e-200, 0.0]), (1, [1e-200, 1e-201]), (2, [1e200, 1e199]), (3, [0.0, 1e-320]), (4, [0.0, 1e300]), (5, [-1.0, 0.0])]
    out = vector_dedup.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    assert by_id(out, "n_links", "component_id", key="vec_id") == {0: (2, 0), 1: (2, 0), 2: (2, 0), 3: (1, 3), 4: (1, 3), 5: (0, 5)}


def test_rounds_go_on_until_the_recall_is_reached(spark, monkeypatch):
    rng = np.random.default_rng(9)
    rows = [[float(x) for x in v + 0.05 * rng.standard_normal(8)] for v in rng.standard_normal((6, 8)) for _ in range(4)]
    vectors = spark.createDataFrame(list(enumerate(rows)), "vec_id bigint, embedding array<double>")
    monkeypatch.setattr(vector_dedup, "MAX_ROUNDS", 2)
    shares, real = [0.1, 0.1, 0.2, 0.2], vector_dedup.recall
    monkeypatch.setattr(vector_dedup, "recall", lambda *a, **k: shares.pop(0) if shares else real(*a, **k))
    want = brute.vectors(list(enumerate(rows)))
    assert by_id(vector_dedup.near_vectors(vectors), "n_links", "component_id", key="vec_id") == want and not shares
    monkeypatch.setattr(vector_dedup, "recall", lambda *a, **k: 0.5)
    with pytest.raises(RuntimeError, match="0.5000 of the audited links"):
        vector_dedup.near_vectors(vectors)


def test_links_of_a_block_stay_connected():
    near = np.array([[False, True], [True, True]])
    rows, columns = vector_dedup._block_roots(near, np.array([1, 2]), np.array([3, 4]))
    assert rows.tolist() == [1, 1] and columns.tolist() == [1, 1]


def test_sharding_moves_records_into_the_new_shard_only(docs):
    rows = sharding.assign_shards(docs, "doc_id", "text", [1.0] * 5).collect()
    grown = {r["doc_id"]: r["shard"] for r in sharding.assign_shards(docs, "doc_id", "text", [1.0] * 6).collect()}
    assert all(r["grown_shard"] == grown[r["doc_id"]] and r["grown_shard"] in (r["shard"], 5) for r in rows)
    for s in range(5):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))


def test_sharding_follows_the_weights(spark):
    frame = spark.range(4000).withColumn("text", F.lit("x"))
    sizes = {r["shard"]: r["count"] for r in sharding.assign_shards(frame, "id", "text", [1.0, 3.0]).groupBy("shard").count().collect()}
    assert abs(sizes[1] / 4000 - 0.75) < 0.04


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def test_warc_round_trip(spark, tmp_dir):
    long = "<p>é</p>" * 5000
    rows = [(5, "u v", long), (2, "u", long), (9, None, None), (1, "x", "short"), (3, "x", "short"), (4, "x", long), (4, "x", long), (None, "n", "null key")]
    rows += [(100 + i, "z", f"page {i} " * 200) for i in range(50)]
    folders = [f"{tmp_dir}/{n}" for n in "ab"]
    manifests = [
        sorted(map(tuple, warc.write_archives(pages(spark, r), f, roll_bytes=4000, shard_bytes=40_000).collect()))
        for f, r in zip(folders, (rows, rows[::-1]))
    ]
    assert manifests[0] == manifests[1] and len(manifests[0]) > 3
    back = warc.read_archives(spark, folders[0], with_payload=True).collect()
    assert len(back) == len(rows)
    kinds = {(r["key"], r["record_type"], r["refers_to"]) for r in back}
    assert {("2", "response", None), ("4", "revisit", "2"), ("5", "revisit", "2"), ("1", "response", None), ("3", "response", None)} <= kinds
    full = len(long.encode())
    assert all(r["payload_bytes"] == full for r in back if r["key"] in ("2", "4", "5"))
    assert {r["key"]: r["payload"] for r in back if r["record_type"] == "response"}["9"] == ""


def test_warc_of_an_empty_table(spark, tmp_dir):
    assert warc.write_archives(pages(spark, []), tmp_dir).count() == 0
    assert warc.read_archives(spark, tmp_dir).count() == 0


def test_tiles_mark_the_longest_first_and_each_word_once():
    item, doc = list("abcdefghij"), [*"fghij", None, *"abcde", "x", *"cdefg"]
    tiles = decontaminate.greedy_tiles(item, doc, 3)
    assert sum(n for _, _, n in tiles) == 10
    used = [p for i, _, n in tiles for p in range(i, i + n)]
    assert len(used) == len(set(used))


def test_decontamination_catches_reordered_passages(spark):
    item = passage(0, 30).split()
    halves = " ".join(item[15:] + ["between"] + item[:15]).upper()
    rows = [(1, passage(0, 30)), (2, "x " * 50 + halves), (3, " ".join(item[:20])), (4, passage(500, 40)), (5, None), (None, passage(0, 30)), (7, "a b")]
    items = [(1, passage(0, 30)), (2, None), (3, ""), (4, "A  b"), (5, passage(900, 9)), (5, passage(900, 9))]
    out = decontaminate.contaminated_pairs(
        spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    )
    got = {(r["doc_id"], r["item_id"]): r["n_covered"] for r in out.collect()}
    assert got == {(1, 1): 30, (2, 1): 30, (None, 1): 30, (7, 4): 2}


@pytest.mark.parametrize("seed", range(4))
def test_tiles_equal_plain_greedy_tiling(seed):
    rng = random.Random(seed)
    for _ in range(60):
        item, doc = ([rng.choice("abcd"[: 2 + seed]) for _ in range(rng.randint(1, 40))] for _ in range(2))
        size = min(rng.randint(1, 6), len(item))
        tiles = decontaminate.greedy_tiles(item, doc, size)
        assert all(item[i : i + n] == doc[j : j + n] and n >= size for i, j, n in tiles)
        assert sum(n for _, _, n in tiles) == brute.tiling(item, doc, size), (item, doc, size)


def test_decontamination_equals_brute_force(spark):
    """Items and documents of a few shared phrases, which no pair may be lost or found by."""
    rng = random.Random(8)
    phrases = [passage(20 * i, rng.randint(3, 12)) for i in range(12)]
    make = lambda n: " ".join(rng.choice(phrases) for _ in range(rng.randint(1, n)))
    items, docs = [(i, make(5)) for i in range(25)], [(i, make(9)) for i in range(60)]
    items += [(100, passage(0, 4)), (101, "A single"), (102, None)]
    docs += [(200, items[3][1].upper() + " a  SINGLE"), (201, None), (202, "")]
    out = decontaminate.contaminated_pairs(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    )
    want = brute.contaminated(docs, items)
    assert {(r["doc_id"], r["item_id"]): r["n_covered"] for r in out.collect()} == want and 40 < len(want) < 1500


def test_probe_seeds_leave_out_frequent_seeds_only_as_far_as_sound():
    seeds = [(100 - p, f"s{p}", [p]) for p in range(16)]  # 20 words, places 0 to 15, 16 words needed
    assert decontaminate.probe_seeds(20, 5, seeds, 0.8) == ["s11", "s12", "s13", "s14", "s15"]
    assert decontaminate.probe_seeds(3, 3, [(9, "s", [0])], 0.8) == ["s"]


def test_language_id_edge_cases(docs):
    net = language_id.fit(docs, "doc_id", "text", "lang")
    got = by_id(language_id.predict(docs, net), "lang_pred", "score")
    assert all(got[i] == ("und", 0.0) for i in (5, 6, 7, 9))
    assert all(p in ("de", "en", "fr") and 0 < s <= 1 for i, (p, s) in got.items() if i not in (5, 6, 7, 9))


def test_language_id_held_out_accuracy(spark):
    out = QUERIES["op9_language_id"](spark, "/root/testdata/sf0.01").where("held_out")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    right, total = out.join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert total > 200 and right > 0.95


def test_lm_base_scores_and_held_out_gain(spark, docs):
    def scored(df):
        held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
        model = lm_scoring.train(df, "text", ~held)
        return lm_scoring.score(df, model, "text", {"doc_id": F.col("doc_id"), "held_out": held})

    got = by_id(scored(docs), "n_tokens", "n_known", "train_tokens", "base_score")
    for i, want in brute.base_scores(TEXTS).items():
        assert got[i][:3] == want[:3] and abs(got[i][3] - want[3]) < 1e-6 * max(1, abs(want[3]))
    real = scored(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    base, score = real.where("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert score > base


def test_lm_automaton_is_a_distribution(monkeypatch):
    """Over all known words and one unknown, every state's probabilities add up to 1."""
    rng = np.random.default_rng(0)
    words = np.sort(rng.integers(1, 1 << 62, 30, dtype=np.uint64))
    text = rng.choice(30, 4000, p=np.arange(1, 31) / 465)
    counts = np.bincount(text, minlength=30)
    dictionary = lm_scoring.Dictionary.of(words, counts)
    rank = dictionary.ranks[text]
    first = np.array([0])
    pairs, pair_n = np.unique(lm_scoring.pair_codes(rank, first, 30, 30), return_counts=True)
    pairs, pair_n = pairs[pair_n > 1], pair_n[pair_n > 1]
    at = lm_scoring._indices(pairs, lm_scoring.pair_codes(rank, first, 30, 30))
    both = (at[:-1] >= 0) & (at[1:] >= 0)
    triples, triple_n = np.unique((at[:-1] * 31 + rank[1:])[both], return_counts=True)
    model = lm_scoring.build_automaton(dictionary, pairs, pair_n, triples[triple_n > 1], triple_n[triple_n > 1], 1, 4000, 30)
    assert len(model.failure) > 100  # the root, 30 words, the begin and pairs
    denominator = 4000 + 0.5 * 31
    for state in range(len(model.failure)):
        p, _ = model.step(np.full(30, state), np.arange(30), dictionary.ranks)
        unknown, _ = model.step(np.array([state]), np.array([-1]), np.array([1 << 40]))
        assert abs((10**p).sum() + 10 ** unknown[0] * 0.5 / denominator - 1) < 1e-9


def test_lm_scores_equal_a_plain_backoff_model(spark):
    """Counts, cutoff, smoothing and traversal against dictionaries of word tuples."""
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(12)]
    texts = [" ".join(rng.choice(words, int(n), p=np.arange(12, 0, -1) / 78)) for n in rng.integers(0, 60, 40)]
    texts.append(" ".join(rng.choice(words, 2500)) + " never seen before")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = lm_scoring.train(df, "text", F.col("doc_id") < 30)
    got = {r["doc_id"]: r["score"] for r in lm_scoring.score(df, model, "text", {"doc_id": F.col("doc_id")}).collect()}

    grams: dict[tuple, int] = {}
    for text in texts[:30]:
        own = ["<s>", *text.split(), "</s>"]
        for n in (1, 2, 3):
            for i in range(len(own) - n + 1):
                grams[tuple(own[i : i + n])] = grams.get(tuple(own[i : i + n]), 0) + 1
    known = {g[0]: c for g, c in grams.items() if len(g) == 1 and g[0] != "<s>"}
    total, kinds = sum(known.values()), len(known)
    kept = {g: c for g, c in grams.items() if len(g) > 1 and c >= 2}

    def probability(word: str, context: tuple) -> float:
        if not context:
            return (known.get(word, 0) + 0.5) / (total + 0.5 * (kinds + 1))
        arcs = {g[-1]: c for g, c in kept.items() if g[:-1] == context}
        shorter = probability(word, context[1:])
        if not arcs:
            return shorter
        seen = {w: (c - 0.75) / grams[context] for w, c in arcs.items()}
        return seen.get(word, 0) + (1 - sum(seen.values())) * shorter

    for i, text in enumerate(texts):
        own = ["<s>", *text.split(), "</s>"]
        want = sum(np.log10(probability(own[j], tuple(own[max(j - 2, 0) : j]))) for j in range(1, len(own)))
        assert abs(got[i] - want) < 1e-6 * max(1, abs(want)), i


def test_lm_keeps_a_twice_seen_phrase_in_a_large_corpus(spark):
    rows = [(i, "filler " * 2_200_000) for i in range(4)] + [(4, "rare phrase"), (5, "rare phrase"), (6, "rare phrase")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = lm_scoring.train(df, "text", F.col("doc_id") < 6)
    assert model.total > 8_000_000
    got = lm_scoring.score(df.where("doc_id = 6"), model, "text", {"doc_id": F.col("doc_id")}).first()
    assert got["score"] > got["base_score"] + 5


def test_lm_scores_do_not_depend_on_the_slices(spark):
    """Many slices, each with a part of the automaton, score as one; a train and a score call as one pass over the rows."""
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{min(w, 90)}" for w in rng.zipf(1.4, int(n)))) for i, n in enumerate(rng.integers(0, 200, 90))]
    keep, learn = {"doc_id": F.col("doc_id")}, F.col("doc_id") % 3 != 0
    results = []
    for parts in (1, 9):
        df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts, "doc_id").select("doc_id", "text")
        model = lm_scoring.train(df, "text", learn, keep)
        assert spark.read.parquet(model.slices).count() >= parts // 2 + 1
        results += [by_id(out, "n_tokens", "n_known", "base_score", "score") for out in (
            lm_scoring.score_own(spark, model), lm_scoring.score(df, lm_scoring.train(df, "text", learn), "text", keep)
        )]
    for i, want in results[0].items():
        assert all(np.allclose(r[i], want, rtol=1e-12) for r in results[1:]), i


def test_lm_slice_follows_the_automaton(monkeypatch):
    """A slice's arcs by place give what the automaton finds by searching, text by text."""
    rng = np.random.default_rng(2)
    words = np.sort(np.append(rng.integers(1, 1 << 62, 40, dtype=np.uint64), lm_scoring.END))
    end, lengths = int(np.searchsorted(words, lm_scoring.END)), rng.integers(1, 60, 50)
    weights = np.arange(41, 0, -1.0) ** 5
    at = rng.choice(41, lengths.sum(), p=weights / weights.sum())
    at[np.cumsum(lengths) - 1] = end
    row = {"slice": 0, "words": keyed_sums.pack_sorted(words), "at": keyed_sums.pack(at), "lengths": keyed_sums.pack(lengths)}
    own = lm_scoring.Slice(row | {"learn": keyed_sums.pack((np.arange(50) % 5 != 1).astype(np.uint64))})
    replies = {}
    monkeypatch.setattr(lm_scoring, "answers", lambda path, _: replies[path])

    def ask(path, asked, answer):
        replies[path] = []
        for b, *sent in asked:
            (blobs,), _, _ = answer(b, [{"slice": 0, "bucket": b, **dict(zip("abcd", sent))}])
            replies[path].append({"bucket": b, **dict(zip("abc", blobs))})

    ask("words", own.ask_words(64), lm_scoring.word_totals)
    own.read_words("words")
    ask("pairs", own.ask_pairs(64), lm_scoring.pair_totals)
    own.read_pairs("pairs")
    ask("triples", own.ask_triples(64), lm_scoring.context_totals)
    own.read_triples("triples", 64, int(own.learn.sum()), 41)
    assert (own.triple >= 0).sum() > 100 and (own.pair < 0).sum() > 10
    assert np.allclose(own.score(), own.automaton.score(own.at, own.rank, own.first), rtol=1e-12)


def test_lm_model_does_not_go_through_the_driver(spark, monkeypatch):
    """Neither counts nor arcs are collected or broadcast, whatever the corpus."""
    df = spark.createDataFrame([(i, f"a b{i % 7} c d{i}") for i in range(300)], "doc_id bigint, text string")

    def refuse(*args, **kwargs):
        raise AssertionError("the model grows with the corpus")

    monkeypatch.setattr(type(df), "toArrow", refuse)
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", refuse)
    model = lm_scoring.train(df, "text", F.lit(True))
    out = lm_scoring.score(df, model, "text", {"doc_id": F.col("doc_id")}).agg(F.sum("base_score"), F.sum("score")).first()
    assert out[0] < out[1] < 0


def test_lm_answers_come_back_in_the_order_asked():
    """Sums by key over the rows of a bucket; packing keeps every integer."""
    keys = [np.sort(np.random.default_rng(i).integers(0, 1 << 63, 50, dtype=np.uint64)) for i in range(3)]
    keys[2][:20] = keys[0][:20]
    keys[2].sort()
    asked = [{"a": keyed_sums.pack_sorted(k), "b": keyed_sums.pack(np.arange(50) + (1 << 40) * i)} for i, k in enumerate(keys)]
    blobs, total, kinds = lm_scoring.word_totals(0, asked)
    want = {}
    for i, k in enumerate(keys):
        for j, x in enumerate(k.tolist()):
            want[x] = want.get(x, 0) + j + (1 << 40) * i
    for k, blob in zip(keys, blobs):
        assert keyed_sums.unpack(blob[0]).tolist() == [want[x] for x in k.tolist()]
    assert (total, kinds) == (sum(want.values()), len(want) - (0 in want.values()))


def test_empty_tables_and_odd_ids(spark, empty, odd):
    assert piece_codec.encode_digests(empty, model_path()).count() == 0
    assert line_dedup.dedup_lines(empty).count() == 0 and line_dedup.dedup_lines(odd, min_sites=2).count() == odd.count()
    assert simhash.simhash_classes(empty).count() == 0
    rows = simhash.simhash_classes(odd).collect()
    assert len(rows) == odd.count() or any(r["doc_id"] is None for r in rows)
    assert substring_dedup.dedup_substrings(empty).count() == 0
    first = [r for r in substring_dedup.dedup_substrings(odd).collect() if r["doc_id"] is None and r["n_words"]]
    assert [r["n_removed"] for r in first] == [0]  # NULL comes first
    assert sharding.assign_shards(empty, "doc_id", "text", [1.0] * 3).count() == 0
    assert sharding.assign_shards(odd, "doc_id", "text", [1.0] * 3).select("shard", "slot").distinct().count() == odd.count()
    assert language_id.predict(empty, language_id.fit(empty, "doc_id", "text", "lang")).count() == 0
    model = lm_scoring.train(empty, "text", F.lit(True))
    assert lm_scoring.score(empty, model, "text", {"doc_id": F.col("doc_id")}).count() == 0
    assert [r["score"] for r in lm_scoring.score(odd, model, "text", {"doc_id": F.col("doc_id")}).select("score").distinct().collect()] == [0.0]
    vectors = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert vector_dedup.near_vectors(vectors).count() == 0
