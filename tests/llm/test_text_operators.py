"""Operators that scan texts, held against plain versions (brute.py) and the tokenizers library."""

import hashlib
import math
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import brute
from viewgrid.llm import chunk_bpe, contamination, near_dedup, pieces, quality_rules, sharding, simple8b, substring, token_counts, token_files
from viewgrid.llm import textscan as ts
from viewgrid.session import scratch_path

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, tag string, sig int, slot int, SHARD string, n_chars long, starts string"
ODD = [
    None, "", " \n\t ", "one", "one two three", "a\x0bb\x0cc\x1cd\x85e f", "x" * 5000, "café 　　 naïve  \n\n z  ",
    "don't 've <|endoftext|> q<|endoftext|>r", "\U0001f600 \U0001f469‍\U0001f467 12,3 4\t\t5!", "word, word. word; word? word! w:w",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def frame(spark, rows):
    """Rows (doc_id, text) with extra columns named like what the operators use inside."""
    return spark.createDataFrame([(d, t, "x", 1, 7, "mine", len(t or ""), "s") for d, t in rows], SCHEMA)


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def mixed():
    """Odd texts, exact and near copies, shared passages, a phrase in many contexts, and a long text."""
    r = random.Random(5)
    rows = list(enumerate(ODD))
    base = prose(1, 300)
    passage, phrase = prose(2, 60, 10**6), prose(3, 8, 10**6)
    for k in range(100, 140):
        w = list(base)
        for _ in range(r.randrange(12)):
            w[r.randrange(len(w))] = f"new{k}"
        rows.append((k, " ".join(w)))
    rows += [(k, "\n".join(base)) for k in range(140, 150)]
    for k in range(150, 190):
        w = prose(k, 80, 10**6)
        at = r.randrange(80)
        rows.append((k, " ".join(w[:at] + (passage if k % 2 else phrase) + w[at:])))
    rows.append((190, " ".join(prose(190, 30000, 10**6) + passage + passage[:25])))
    return rows


@pytest.fixture(scope="module")
def real(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def collected(df, *columns):
    return {r[0]: tuple(r)[1:] for r in df.select("doc_id", *columns).collect()}


@pytest.mark.parametrize("high", [1, 2, 300, 50257, 1 << 40, 1 << 63])
@pytest.mark.parametrize("n", [0, 1, 5, 3000])
def test_simple8b_round_trip(n, high):
    ids = np.random.default_rng(n).integers(0, high, n, dtype=np.uint64)
    if n > 4 and high > 50257:
        ids[[2, 3]] = (1 << 64) - 1  # escapes side by side
    words = simple8b.pack(ids)
    assert (simple8b.unpack(words, n) == ids).all()
    if n > 100:
        at, before = simple8b.marks(words)
        assert (simple8b.unpack_slice(words, at, before, 57, 1500) == ids[57:1557]).all()


def test_pieces_give_the_library_ids(library):
    texts = [t or "" for t in ODD] + ["".join(random.Random(k).choices("ab \n\t.,'s|<>é 　5\x1c", k=200)) for k in range(200)]
    for encode in (pieces.PieceEncoder(PATH).documents, chunk_bpe.ChunkCoder(PATH).encode):
        for _, _, buf, offs in ts.text_chunks(pa.array(texts)):
            ids, sizes = encode(buf, offs)
            at = np.concatenate([[0], np.cumsum(sizes)])
            for k, t in enumerate(texts):
                assert ids[at[k] : at[k + 1]].tolist() == library.encode(t, add_special_tokens=False).ids, t


def test_a_full_piece_memory_starts_again(library):
    own = pieces.PieceEncoder(PATH)
    own.memory.most_spans = 50
    for k in range(5):
        text = " ".join(prose(k, 200, 10**6))
        buf = np.frombuffer(text.encode(), np.uint8)
        ids, _ = own.documents(buf, np.array([0, len(buf)]))
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(own.memory.keys) <= 250


def test_chunk_bpe(spark, library, mixed):
    out = chunk_bpe.digest(frame(spark, mixed), PATH, with_ids=True)
    got = collected(out, "n_tokens", "ids_sha256", "decoded_sha256")
    packed = collected(out, "ids")
    back = collected(chunk_bpe.decoded(frame(spark, mixed), PATH), "text")
    for d, t in mixed:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), text)]
        assert got[d] == (len(ids), *sha) and bytes(packed[d][0]) == np.array(ids, "<u4").tobytes()
        assert back[d] == (text,) == (t or "",)


def test_token_files(spark, library, mixed):
    path = scratch_path(spark, "test-tokens")
    rows = mixed + [(190, "again")] + [(3, "one two")]
    token_files.write(frame(spark, rows[::-1]), path, PATH, end_id=0, block_ids=500)
    got = sorted(tuple(r) for r in token_files.read_digest(spark, path).collect())
    ids = {t: [*library.encode(t or "", add_special_tokens=False).ids, 0] for _, t in rows}
    assert sorted(g[0] for g in got) == sorted(d for d, _ in rows)
    assert sorted(g[1] for g in got) == [0, *np.cumsum([g[2] for g in sorted(got, key=lambda g: g[1])]).tolist()][:-1]
    by = {}
    for d, t in rows:
        by.setdefault(d, []).append((len(ids[t]), zlib.crc32(np.array(ids[t], "<u4").tobytes())))
    assert {d: sorted((g[2], g[3]) for g in got if g[0] == d) for d in by} == {d: sorted(x) for d, x in by.items()}
    whole = [(r.doc_id, r.ids) for r in token_files.read_ids(spark, path).collect()]
    assert sorted(whole) == sorted((d, ids[t]) for d, t in rows)


def test_token_counts(spark, library, real):
    sums = token_counts.suffix_sums(token_counts.histogram(frame(spark, real + [(900, None)]), PATH)).cache()
    n = np.array([len(library.encode(t or "", add_special_tokens=False).ids) for _, t in [*real, (900, "")]])
    for r in sums.collect():
        k = r.n_tokens
        want = ((n == k).sum(), (n >= k).sum(), n[n >= k].sum(), (n <= k).sum(), np.minimum(n, k).sum(), len(n), n.sum())
        assert tuple(r)[1:] == tuple(int(x) for x in want)
    assert sums.count() == len(set(n.tolist()))
    limits = [0, 1, 100, 777, 5000, 10**7]
    assert {r.limit: r.truncated_tokens for r in token_counts.truncated_totals(sums, limits).collect()} == {x: int(np.minimum(n, x).sum()) for x in limits}
    ranked = np.sort(n)
    for r in token_counts.quantiles(sums, [0.0, 0.25, 0.5, 0.99, 1.0]).collect():
        assert r.n_tokens == ranked[max(1, int(np.ceil(len(n) * r.share))) - 1]


@pytest.mark.parametrize("spread", [1, 8])
def test_substring_spans(spark, mixed, spread):
    spans = {r.doc_id: {i for a, b in zip(r.starts, r.ends) for i in range(a, b)} for r in substring.repeated_spans(frame(spark, mixed), spread=spread).collect()}
    want = brute.substring(mixed)
    assert {d: len(x) for d, x in spans.items()} == {d: x[1] for d, x in want.items() if x[1]}


def test_substring(spark, mixed, real):
    for rows in (mixed, real):
        got = collected(substring.digest(frame(spark, rows)), "n_words", "n_removed", "kept_sha256")
        assert got == brute.substring(rows)


def test_substring_repeated_and_unnamed_rows(spark):
    text, other = " ".join(prose(7, 50)), " ".join(prose(8, 40))
    rows = [(5, text), (5, text), (None, text), (6, text), (5, other), (None, None)]
    got = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in substring.digest(frame(spark, rows)).collect())
    assert got == sorted([("5", 50, 0), ("5", 50, 0), ("5", 40, 0), ("6", 50, 50), ("None", 50, 0), ("None", 0, 0)])


def test_without_repeats_keeps_rows_columns_and_space(spark, mixed):
    docs = frame(spark, mixed)
    out = substring.without_repeats(docs)
    assert out.columns == docs.columns
    want, before = brute.substring(mixed), dict(mixed)
    rows = out.collect()
    assert len(rows) == len(mixed)
    for r in rows:
        kept = " ".join(brute.words(r.text))
        assert hashlib.sha256(kept.encode()).hexdigest() == want[r.doc_id][2]
        assert r.tag == "x" and r.starts == "s" and r.n_chars == (None if r.text is None else len(r.text))
        if not want[r.doc_id][1]:
            assert r.text == before[r.doc_id]


@pytest.mark.parametrize("block", [3, 2048])
def test_near_dedup(spark, mixed, real, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    for rows in (mixed, real):
        got = collected(near_dedup.groups(frame(spark, rows), shingle=4), "n_shingles", "component_id", "kept")
        assert got == brute.near(rows)


def test_near_dedup_searches_whole_buckets(spark):
    """A chain of texts, each a link of the next only: the smallest of a bucket is no link of most."""
    r, w, rows = random.Random(3), prose(11, 400, 10**6), []
    for k in range(60):
        rows.append((1000 - k if k % 2 else k, " ".join(w)))
        for _ in range(9):
            w[r.randrange(400)] = f"c{r.randrange(10**6)}"
    assert collected(near_dedup.groups(frame(spark, rows), shingle=4), "n_shingles", "component_id", "kept") == brute.near(rows)


def test_near_dedup_bounds_follow_the_similarity():
    for percent in (10, 30, 50, 60, 70, 80, 90, 95):
        s, b = percent / 100, near_dedup.bounds(percent)
        assert b.rows * b.bands <= near_dedup.SLOTS and (1 - s**b.rows) ** b.bands <= near_dedup.MISS
        below = sum(math.comb(near_dedup.WIDTH, k) * s**k * (1 - s) ** (near_dedup.WIDTH - k) for k in range(b.agree))
        assert below <= near_dedup.MISS and b.agree > 0
    assert near_dedup.bounds(80)[:2] == (5, 36)
    with pytest.raises(ValueError):
        near_dedup.bounds(1)


def test_near_dedup_finds_links_of_lower_similarity(spark):
    """In round 2: of two clusters that share buckets only pairs at 60 to 66 % link them."""
    rows = []
    for k in range(40):  # words in a chain: neighbours share some 62 % of the shingles, others far less
        words = prose(100 + k // 4, 400, 10_000)
        rows.append((k, " ".join(words[k % 4 * 35 : k % 4 * 35 + 150])))
    want = brute.near(rows, percent=60)
    assert len({c for _, c, _ in want.values()}) == 10
    assert collected(near_dedup.groups(frame(spark, rows), shingle=4, percent=60), "n_shingles", "component_id", "kept") == want


def test_near_dedup_repeated_and_unnamed_rows(spark):
    a, b = " ".join(prose(1, 50)), " ".join(prose(2, 50))
    rows = frame(spark, [(4, a), (4, a), (2, a), (None, a), (7, b), (8, None)])
    got = sorted((str(x.doc_id), x.component_id, x.kept) for x in near_dedup.groups(rows).collect())
    assert got == sorted([("4", 2, False), ("4", 2, False), ("2", 2, True), ("None", None, True), ("7", 7, True), ("8", 8, True)], key=str)
    kept = near_dedup.one_of_each(rows)
    assert kept.columns == rows.columns
    assert sorted(str(x.doc_id) for x in kept.collect()) == ["2", "7", "8", "None"]


def test_super_minhash_estimates_similarity():
    rng = np.random.default_rng(4)
    for share in (0.2, 0.5, 0.8, 0.95):
        common, own = int(1000 * share), (1000 - int(1000 * share)) // 2
        x = rng.integers(0, 1 << 63, common + 2 * own, dtype=np.uint64)
        sets = np.concatenate([x[: common + own], x[:common], x[common + own :]])
        sig = near_dedup.super_minhash(sets, np.array([0, common + own, 2 * common + 2 * own]))
        assert abs((sig[0] == sig[1]).mean() - common / (common + 2 * own)) < 0.13
    few = near_dedup.super_minhash(np.array([5], dtype=np.uint64), np.array([0, 1]))
    assert (np.sort(few[0] >> np.uint64(32)) == np.arange(near_dedup.SLOTS)).all()  # one element's ranks are a permutation


@pytest.mark.parametrize("mean", [2, 16, 256])
def test_chunk_joins_are_repaired(library, real, mixed, monkeypatch, mean):
    """Joins everywhere, in words, numbers, white space, special tokens and long runs without any safe place."""
    monkeypatch.setattr(chunk_bpe, "MEAN_CHUNK", mean)
    own = chunk_bpe.ChunkCoder(PATH)
    texts = [t or "" for _, t in real[:60] + mixed] + ["日本語" * 300, "ab" * 2000, "<|endoftext|>" * 40, "1234567890 " * 90, " \n" * 300]
    buf = np.frombuffer("".join(texts).encode(), np.uint8)
    offs = np.cumsum([0] + [len(t.encode()) for t in texts])
    ids, sizes = own.encode(buf, offs)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    edges = chunk_bpe.rolling_cuts(buf, offs)
    plain, _ = own.memory.spans(buf, edges[:-1], edges[1:])
    assert plain.tolist() != ids.tolist()  # there was something to repair


def test_chunk_joins_widen_until_both_sides_agree(library):
    """Chunk ids that are wrong next to their cuts, further than one piece, are found out and replaced."""
    own = chunk_bpe.ChunkCoder(PATH)
    text = " ".join(prose(7, 900, 10**6))
    buf = np.frombuffer(text.encode(), np.uint8)
    offs = np.array([0, len(buf)])
    edges = chunk_bpe.rolling_cuts(buf, offs)
    at = [library.token_to_id(c) for c in pieces.byte_alphabet()]
    wrong = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        ids = own.encode_spans(buf, np.array([a]), np.array([b]))[0]
        ends = own.token_edges(ids)
        if len(ids) < 40:
            wrong += ids.tolist()
            continue
        head, tail = (0, 0) if a == 0 else (0, 12), (len(ids), len(ids)) if b == len(buf) else (len(ids) - 12, len(ids))
        for k, i in enumerate(ids.tolist()):
            inside = head[0] <= k < head[1] or tail[0] <= k < tail[1]
            wrong += [at[x] for x in buf[a + ends[k] : a + ends[k + 1]].tolist()] if inside else [i]
    want = library.encode(text, add_special_tokens=False).ids
    assert len(edges) > 5 and wrong != want
    assert own.repaired(buf, offs, edges, np.array(wrong, np.uint32)).tolist() == want


def test_chunks_shared_across_documents(spark, library, real, monkeypatch):
    """Repeated chunks against a plain count; the dictionary holds their library ids, within its bounds; results don't depend on it."""
    rows = real[:80] + [(3000 + d, "x " + (t or "")) for d, t in real[:80]] + [(d, ODD[7]) for d in range(5)] + [(None, None)]
    docs = frame(spark, rows).repartition(6)
    count = {}
    for _, t in rows:
        buf = np.frombuffer((t or "").encode(), np.uint8)
        edges = chunk_bpe.rolling_cuts(buf, np.array([0, len(buf)])).tolist()
        for a, b in zip(edges, edges[1:]):
            count[buf[a:b].tobytes()] = count.get(buf[a:b].tobytes(), 0) + 1
    common = {c: n for c, n in count.items() if n > 1}
    got = chunk_bpe.repeated(docs).collect()
    assert sorted((r.size, r.n) for r in got) == sorted((len(c), n) for c, n in common.items()) and len(got) > 50
    whole = chunk_bpe.shared_chunks(docs, PATH)
    ids = [whole.flat[a : a + n].tolist() for a, n in zip(whole.first.tolist(), whole.sizes.tolist())]
    assert sorted(ids) == sorted(library.encode(c.decode(), add_special_tokens=False).ids for c in common)
    want = sorted(chunk_bpe.digest(docs, PATH).collect(), key=str)
    for bytes_, chunks in ((0, 9), (3000, 10**6), (10**6, 7)):
        monkeypatch.setattr(chunk_bpe, "SHARED_BYTES", bytes_)
        monkeypatch.setattr(chunk_bpe, "SHARED_CHUNKS", chunks)
        assert len(chunk_bpe.shared_chunks(docs, PATH).keys) <= min(chunks * 2, bytes_)
        assert sorted(chunk_bpe.digest(docs, PATH).collect(), key=str) == want
    for r in want:
        if r.doc_id is not None and r.doc_id >= 3000:
            t = library.encode("x " + (dict(real)[r.doc_id - 3000] or ""), add_special_tokens=False).ids
            assert r.ids_sha256 == hashlib.sha256(",".join(map(str, t)).encode()).hexdigest()


def test_contamination(spark, real):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = list(real) + [(None, items[0][1]), (990, "one two three"), (991, None)]
    r = random.Random(9)
    for k, (_, t) in enumerate(items):  # items inside long texts, whole, cut short, or taken apart
        w, more = t.split(), prose(k, 6000)
        half = len(w) // 2
        rows += [
            (2000 + k, " ".join(more[:4000] + w + more[4000:])),
            (3000 + k, " ".join(more[:77] + w[: int(len(w) * r.uniform(0.6, 1))] + more[77:900])),
            (4000 + k, " ".join(more[:1000] + w[: half + 4] + more[1000:3000] + w[half:] + more[3000:])),
        ]
    queries = [*items, (900, "One two THREE"), (901, ""), (None, None), (902, "x y")]
    bench = spark.createDataFrame(queries, "item_id long, text string")
    got = {(x.doc_id, x.item_id): x.n_shared for x in contamination.search(frame(spark, rows), bench).collect()}
    want = brute.contaminated(rows, [q for q in queries if q[0] is not None])
    assert got == want and (990, 900) in got and (None, items[0][0]) in got
    docs = frame(spark, rows)
    clean = contamination.clean(docs, bench)
    assert clean.columns == docs.columns
    bad = {d for d, _ in want}
    assert sorted(str(x.doc_id) for x in clean.collect()) == sorted(str(d) for d, _ in rows if d not in bad)


def test_contamination_in_blocks(spark, real, monkeypatch):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = contamination.search(frame(spark, real), bench).collect()
    monkeypatch.setattr(contamination, "BLOCK_ITEMS", 15)
    assert sorted(contamination.search(frame(spark, real), bench).collect()) == sorted(whole)


def test_contamination_of_items_with_a_common_heading():
    """5,000 items that share a heading, and a document that holds the heading often: settled once, not for each item and hit."""
    heading = " ".join(prose(1, 12, 10**6))
    items = [heading + " " + " ".join(prose(1000 + k, 30, 10**6)) for k in range(5000)]
    index = contamination.Index(list(range(5000)), items)
    text = " ".join(f"{heading} {' '.join(prose(20_000 + k, 20, 10**6))}" for k in range(100)) + " " + items[77]
    buf = np.frombuffer(text.encode(), np.uint8)
    offs = np.array([0, len(buf)])
    began = time.perf_counter()
    found = list(index.matches(buf, offs))
    assert time.perf_counter() - began < 0.5  # a loop over hits and items takes seconds
    assert [(d, i) for d, i, _ in found] == [(0, 77)]


@pytest.mark.parametrize("size", [300, 2000, 9000])
def test_contamination_finds_long_and_scattered_items(size):
    r = random.Random(size)
    items = [prose(size + k, size, 10**6) for k in range(10)]
    index = contamination.Index(list(range(10)), [" ".join(w) for w in items])
    for k, w in enumerate(items):
        parts = [w[a : a + 100] for a in range(0, size, 96)]  # runs that overlap by a shingle
        text = []
        for n, part in enumerate(parts):
            text += part + prose(n, r.randrange(10), 10**6)
        buf = np.frombuffer(" ".join(text).encode(), np.uint8)
        assert [i for _, i, _ in index.matches(buf, np.array([0, len(buf)]))] == [k]


def test_quality_rules_base_figures(spark, mixed, real):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = real + [(5000 + d, t) for d, t in mixed] + [(None, "loop " * 30)]
    got = collected(quality_rules.rules(frame(spark, rows), labels), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got == {d: brute.base_rules(t) for d, t in rows}


def test_quality_rules_ratios(spark):
    """The table and the verdict against plain counts over the same hashes."""
    rows = [(k, " ".join(prose(k, 60)) + ("" if k % 4 else " *** $$$ !!" * 20)) for k in range(60)]
    labels = spark.createDataFrame([(k, 1 if k % 4 else 0) for k in range(40)] + [(None, 1), (3, None)], "doc_id long, quality int")
    docs = frame(spark, rows)
    grams = {r.doc_id: r.grams for r in quality_rules.with_grams(docs.select("doc_id", "text")).collect()}
    size = quality_rules.BUCKETS
    raw = np.bincount([g % size for x in grams.values() for g in x], minlength=size)
    good = np.bincount([g % size for d, x in grams.items() if d < 40 and d % 4 for g in x], minlength=size)
    want = np.round(1e6 * (np.log((good + 1) / (good.sum() + size)) - np.log((raw + 1) / (raw.sum() + size))))
    ratios = quality_rules.log_ratios(docs.select("doc_id", "text"), labels)
    assert (np.array(ratios)[raw > 0] == want[raw > 0]).all()
    for r in quality_rules.judged(docs, ratios).collect():
        total = sum(ratios[g % size] for g in grams[r.doc_id])
        assert r.kept == (not r.base_failed and total >= -250_000 * len(grams[r.doc_id]))
    none = quality_rules.rules(docs, labels.where("quality = 2")).collect()
    assert all(r.kept == (not r.base_failed) for r in none)


@pytest.mark.parametrize("most", [2_000_000, 0])
def test_quality_rules_count_all_good_documents(spark, monkeypatch, most):
    """25,000 labelled good, by a broadcast and by an ordinary join: all counts are target counts too, so every ratio is 0."""
    monkeypatch.setattr(quality_rules, "MOST_BROADCAST_IDS", most)
    docs = spark.range(25_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.col("id")).alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    assert not any(quality_rules.log_ratios(docs, labels.union(labels)))


def test_sharding(spark, duck, mixed):
    shards = [f"s{k}" for k in range(7)]
    rows = mixed + [(None, "a"), (None, "b"), (3, "c")]
    docs = frame(spark, rows)
    out = sharding.placed(docs, "doc_id", shards)
    assert sorted(out.columns) == sorted([c for c in docs.columns if c not in ("slot", "SHARD")] + ["slot", "shard"])
    table = sharding.lookup_table(shards)
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.slot == sharding.text_hash("" if r.doc_id is None else str(r.doc_id)) % len(table) and r.shard == table[r.slot]
    counts = np.bincount(table)
    assert len(counts) == 7 and counts.max() - counts.min() <= 1
    fewer = sharding.lookup_table(shards[:-1], len(table))
    kept = [a == b for a, b in zip(table, fewer) if a != 6]
    assert np.mean(kept) > 0.8  # most slots of the other shards stay
    want = duck(SF).execute(sharding.placement_sql("documents", "doc_id", shards)).fetchall()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id")
    assert sorted(tuple(r) for r in sharding.placed(docs, "doc_id", shards).collect()) == sorted(want)
    path = scratch_path(spark, "test-shards")
    sharding.write_shards(frame(spark, rows), "doc_id", shards, path)
    assert sum(sharding.read_shard(spark, path, k).count() for k in range(7)) == len(rows)


def test_empty_tables(spark):
    docs = frame(spark, [])
    items = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    path = scratch_path(spark, "test-none")
    token_files.write(docs, path, PATH)
    made = [
        sharding.placed(docs, "doc_id", ["a", "b"]), token_counts.suffix_sums(token_counts.histogram(docs, PATH)), token_files.read_digest(spark, path),
        substring.digest(docs), substring.without_repeats(docs), near_dedup.groups(docs), near_dedup.one_of_each(docs),
        contamination.search(docs, items), contamination.clean(docs, items), chunk_bpe.digest(docs, PATH), quality_rules.rules(docs, labels),
    ]
    assert [df.count() for df in made] == [0] * len(made)
    one = frame(spark, [(1, "a b c")])
    assert contamination.search(one, items).count() == 0 and contamination.clean(one, items).count() == 1
