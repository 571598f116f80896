"""Every operator against a brute-force version, on awkward rows."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stayframe.llm import (attention_lm, bitplane, jump_shard, mixing, packing, quality_mil, quality_rules, simhash, suffix_dedup,
                           weighted_sampling)
from stayframe.llm.components import components
from stayframe.llm.suffix_sort import sort_suffixes
from stayframe.llm.tokens import default_path, piece_encoder

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode())


def ids_of(rows, end):
    tokenizer = Tokenizer.from_file(default_path())
    return [np.array(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [end], "<u4") for r in rows]


# -- tokens, 9, 10 -----------------------------------------------------------

def test_encoder_equals_tokenizer_on_random_text():
    import random

    rng = random.Random(1)
    encoder, letters = piece_encoder(default_path()), list("ab'sStd're \n\t\x0b\x0c\x1c\x85\xa0́éÉİßΣσ1٣!?.,|<>中🙂​ÀÿŸ×÷ªµ")
    for _ in range(3000):
        s = "".join(rng.choice(letters) for _ in range(rng.randint(0, 30)))
        assert np.frombuffer(encoder.encode(s), "<u4").tolist() == encoder.tokenizer.encode(s, add_special_tokens=False).ids


@pytest.mark.parametrize("capacity,bins", [(64, 3), (2048, 512)])
def test_packing(docs, rows, empty, capacity, bins):
    got = packing.pack_documents(docs, capacity=capacity, open_bins=bins).collect()
    pieces = collections.Counter()
    for r, ids in zip(rows, ids_of(rows, 0)):
        for k, at in enumerate(range(0, len(ids), capacity)):
            pieces[(r[0], k, at, ids[at:at + capacity].tobytes())] += 1
    assert pieces == collections.Counter((g.doc_id, g.piece, g.start, bytes(g.ids)) for g in got)
    by = collections.defaultdict(list)
    for g in got:
        by[g.sequence_id].append((g.offset, g.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    assert packing.pack_documents(empty).count() == 0


def test_best_fit_takes_the_fullest_that_fits_and_closes_the_fullest():
    bins = packing.BestFit(10, 2)
    assert [bins.place(n) for n in (6, 7, 3, 4, 8)] == [(0, 0), (1, 0), (1, 7), (0, 6), (2, 0)]
    bins = packing.BestFit(10, 2)
    [bins.place(n) for n in (5, 6, 7)]  # 6 is the fullest of two open ones and closes
    assert bins.place(4) == (3, 0) or bins.place(4)[0] != 1


@pytest.mark.parametrize("planes,block", [("byte", 100), ("bit", 77), ("byte", 1 << 16)])
def test_bitplane_files(spark, docs, rows, empty, planes, block):
    folder = bitplane.ids_folder(docs)
    manifest = bitplane.write_ids(docs, folder, planes=planes, block_ids=block, files=5)
    got = sorted(bitplane.read_ids(manifest, folder).collect(), key=lambda g: g.start)
    keys = [(g.doc_id is not None, g.doc_id or 0) for g in got]
    assert keys == sorted(keys)
    at = 0
    for g in got:
        assert g.start == at and g.n_tokens * 4 == len(g.ids)
        at += g.n_tokens
    expected = collections.Counter((r[0], ids.tobytes()) for r, ids in zip(rows, ids_of(rows, 1)))
    assert expected == collections.Counter((g.doc_id, bytes(g.ids)) for g in got)
    folder = bitplane.ids_folder(docs)
    assert bitplane.read_ids(bitplane.write_ids(empty, folder), folder).count() == 0


# -- 3 -------------------------------------------------------------------------

def jump(key, shards):
    key, b, j = key & (1 << 64) - 1, -1, 0
    while j < shards:
        b, key = j, (key * 2862933555777941757 + 1) & (1 << 64) - 1
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("shards", [1, 8, 100])
def test_jump_shards(docs, rows, empty, shards):
    got = jump_shard.shard_documents(docs, shards, rows_per_block=2).collect()
    assert len(got) == len(rows)
    expected = collections.Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode()), jump(r[0] or 0, shards),
                                    jump(r[0] or 0, shards + 1)) for r in rows)
    assert expected == collections.Counter((g.doc_id, g["size"], g.text_crc32, g.shard, g.grown_shard) for g in got)
    by = collections.defaultdict(list)
    for g in got:
        by[g.shard].append(g.slot)
        assert g.grown_shard in (g.shard, shards)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert jump_shard.shard_documents(empty, shards).count() == 0


# -- 4 -------------------------------------------------------------------------

def bag(text):
    return collections.Counter(w for w in re.split("[\x20\x09-\x0D]+", (text or "").lower()) if w)


def jaccard(a, b):
    most = sum(max(a[w], b[w]) for w in a | b)
    return sum(min(a[w], b[w]) for w in a | b) / most if most else 1.0


def test_weighted_sampling(spark, docs, rows, empty):
    unique = {r[0]: r[1] or "" for r in rows}  # ids that repeat are looked at apart
    frame = spark.createDataFrame(list(unique.items()), "doc_id long, text string")
    got = {g.doc_id: g for g in weighted_sampling.fingerprint_documents(frame, 24).collect()}
    order = sorted((k for k in unique if k is not None), reverse=True) + [None]
    off = []
    for k, after in zip(order, order[1:] + order[:1]):
        text, following = unique[k], unique[after]
        third = len(text) // 3
        edited = text[:len(text) - third] + following[:third]
        assert got[k].n_chars == len(text) and got[k].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        off += [got[k].near_edited - jaccard(bag(text), bag(edited)), got[k].near_next - jaccard(bag(text), bag(following))]
    assert abs(np.mean(off)) < 0.03 and np.std(off) < 0.12
    assert len({got[60 + k].fingerprint for k in range(8)}) == 1 and got[61].near_next == 1.0
    assert got[80].fingerprint == got[81].fingerprint == got[82].fingerprint != got[83].fingerprint
    assert weighted_sampling.fingerprint_documents(docs).count() == len(rows)
    assert weighted_sampling.fingerprint_documents(empty).count() == 0


def test_likeness_of_the_default_samples(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").dropDuplicates(["doc_id"])
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = {g.doc_id: g.near_edited for g in weighted_sampling.fingerprint_documents(docs).collect()}
    order, off = sorted(texts, reverse=True), []
    for k, after in zip(order, order[1:] + order[:1]):
        third = len(texts[k]) // 3
        off.append(abs(got[k] - jaccard(bag(texts[k]), bag(texts[k][:len(texts[k]) - third] + texts[after][:third]))))
    assert np.mean(np.array(off) > 0.15) < 0.06


# -- 5 -------------------------------------------------------------------------

def brute_fingerprint(text):
    w = [x.lower() for x in words(text)]
    shingles = [b" ".join(w[k:k + 4]) for k in range(len(w) - 3)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def least_reachable(fps, distance):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(k) for k in range(len(fps))]


def test_simhash(docs, rows, empty):
    fps = [brute_fingerprint(r[1]) for r in rows]
    root = least_reachable(fps, 4)
    least = {}
    for r, c in zip(rows, root):
        if r[0] is not None:
            least[c] = min(least.get(c, r[0]), r[0])
    expected = collections.Counter((r[0], f, least.get(c)) for r, f, c in zip(rows, fps, root))
    got = simhash.near_duplicates(docs).collect()
    assert expected == collections.Counter((g.doc_id, g.fp & (1 << 64) - 1, g.component_id) for g in got)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(root)) and simhash.keep_one(empty).count() == 0
    assert {r.doc_id for r in kept.collect()} == {least.get(c) for c in set(root)}


@pytest.mark.parametrize("tile", [3, 1000])
def test_links_of_a_dense_block(spark, tile):
    rng = np.random.default_rng(2)
    centre = int(rng.integers(1 << 62))
    near = {centre ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False)) for _ in range(60)}
    fps = sorted(near | {int(x) for x in rng.integers(1 << 62, size=40)})
    frame = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    found = {r.node: r.label for r in components(simhash.links(frame, tile=tile)).collect()}
    groups = collections.defaultdict(set)
    for x in fps:
        signed = x - (1 << 64) if x >> 63 else x
        groups[found.get(signed, signed)].add(x)
    expected = collections.defaultdict(set)
    for x, c in zip(fps, least_reachable(fps, 4)):
        expected[c].add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(5, 5), (None, 3), (7, None)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {100 + k: 100 for k in range(30)}


# -- 6 -------------------------------------------------------------------------

def test_sorted_suffixes():
    import random

    for seed in range(60):
        rng = random.Random(seed)
        text = bytes(rng.choice((b"a", b"ab", b"abcd")[seed % 3]) for _ in range(rng.randint(60, 400)))
        text, depth = text + text[:150] + text, rng.choice([5, 8, 16, 17, 24, 50])
        starts = np.array(rng.sample(range(len(text) - depth + 1), len(text) - depth + 1))
        order, group = sort_suffixes(np.frombuffer(text, np.uint8), starts, depth)
        found = [text[starts[k]:starts[k] + depth] for k in order]
        assert found == sorted(found)
        assert all((a == b) == (p == q) and p <= q for a, b, p, q in zip(found, found[1:], group, group[1:]))


def test_suffix_dedup(docs, rows, empty, monkeypatch):
    last = 1 << 62
    first = {}
    for r in rows:
        text = (r[1] or "").encode()
        for p in range(len(text) - 49):
            s = text[p:p + 50]
            first[s] = min(first.get(s, last), last if r[0] is None else r[0])
    expected = collections.Counter()
    for r in rows:
        text = (r[1] or "").encode()
        gone = bytearray(len(text))
        for p in range(len(text) - 49):
            if first[text[p:p + 50]] < (last if r[0] is None else r[0]):
                gone[p:p + 50] = b"\1" * 50
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        expected[(r[0], len(text), sum(gone), spans, bytes(b for b, g in zip(text, gone) if not g))] += 1
    for chunk in (1, 3000, 2 << 20):
        monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", chunk)
        monkeypatch.setattr(suffix_dedup, "STEP_BYTES", max(chunk, 997))
        got = suffix_dedup.remove_repeats(docs, ["doc_id", "row"]).collect()
        assert expected == collections.Counter((g.row.doc_id, g.n_bytes, g.n_removed, g.n_spans, bytes(g.kept)) for g in got)
    assert suffix_dedup.remove_repeats(empty, ["doc_id"]).count() == 0


# -- 7 -------------------------------------------------------------------------

def test_quality_counts(docs, rows, empty):
    expected = collections.Counter()
    for r in rows:
        text = r[1] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = [tuple(w[k:k + 8]) for k in range(len(w) - 7)]
        times, covered = collections.Counter(windows), set()
        for k, x in enumerate(windows):
            if times[x] > 1:
                covered.update(range(k, k + 8))
        failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
        expected[(r[0], len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed)] += 1
    got = quality_rules.judge(docs).collect()
    assert expected == collections.Counter((g.row.doc_id, g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed) for g in got)
    assert not any(g.kept and g.base_failed for g in got)
    assert quality_rules.judge(empty).count() == 0
    assert quality_rules.judge(docs).filter("kept").select("row.*").columns == docs.columns


def test_adaptive_fences_follow_the_group(spark):
    plain = [(k, " ".join(f"word{(k * 31 + j) % 97}" for j in range(60)), lang, "s") for lang in ("en", "de") for k in range(300)]
    marked = [(900 + k, t.replace("word", "wo&d"), "de", s) for k, (_, t, _, s) in enumerate(plain[:300])]  # usual in de
    odd = [(5000, plain[0][1].replace("word", "wo&d"), "en", "s")]  # unusual in en
    got = {g.row.doc_id: g.kept for g in quality_rules.judge(spark.createDataFrame(plain[:300] + marked + odd, "doc_id long, text string, lang string, source string")).collect()}
    assert got[0] and got[900] and not got[5000]


def test_fences_move_with_the_spread_and_small_groups_lean_on_wider_ones(spark):
    def fence(lengths, n):  # documents of one word length each; a small group b beside them
        rows = [(k, " ".join(["x" * lengths[k % len(lengths)]] * 30 + [f"y{k}{j}" for j in range(20)]), "en", "a") for k in range(n)]
        rows += [(9000 + k, " ".join(["x" * 40] * 10 + [f"z{k}{j}" for j in range(20)]), "en", "b") for k in range(3)]
        m = quality_rules.measure(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), ["doc_id"]).withColumn("base_failed", F.lit(False))
        found = quality_rules.thresholds(quality_rules.sketches(m)).collect()
        return {t.source: t.fences for t in found}

    narrow, wide = fence([5, 5, 6], 400), fence([3, 6, 9, 12], 400)
    assert wide["a"].word_length_most > narrow["a"].word_length_most + 300 and wide["a"].word_length_least < narrow["a"].word_length_least
    assert narrow["b"].word_length_most < 1200  # three odd rows do not make their own measure


def test_rules_by_the_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = [g for g in quality_rules.judge(docs).join(labels.withColumnRenamed("doc_id", "k"), F.col("row.doc_id") == F.col("k")).collect() if not g.base_failed]
    good, bad = [g.kept for g in got if g.quality == 1], [g.kept for g in got if g.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.2 * len(bad)


# -- 1, 2, 8 ----------------------------------------------------------------------

def test_quality_scores(spark, docs, rows, labels, empty):
    model = quality_mil.fit(docs, labels)
    got = quality_mil.score(docs, model).collect()
    assert collections.Counter(g.doc_id for g in got) == collections.Counter(r[0] for r in rows)
    for g in got:
        assert 0 <= g.score <= 1 and g.predicted == int(g.score >= 0.3)
        assert g.held_out == (g.doc_id is not None and zlib.crc32(str(g.doc_id).encode()) % 5 == 0)
    by = collections.defaultdict(set)
    for g in quality_mil.score(spark.createDataFrame([(1, None), (2, ""), (3, " "), (4, rows[3][1]), (5, rows[3][1])], "doc_id long, text string"), model).collect():
        by[round(g.score, 5)].add(g.doc_id)
    assert {1, 2} in by.values() and {4, 5} in by.values()
    assert quality_mil.score(empty, model).count() == 0
    assert quality_mil.score(docs, quality_mil.fit(docs, labels.limit(0))).agg(F.max("score")).first()[0] == 0.5


def test_attention_gradients():
    rng = np.random.default_rng(0)
    model = quality_mil.AttentionMIL()
    x, counts, y = rng.standard_normal((7, quality_mil.passages.SIZE)).astype(np.float32), np.array([3, 1, 3]), np.array([1.0, 0.0, 1.0])

    def loss():
        p = model.forward(x.astype(float), counts)[0]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    model.p = {k: v.astype(float) for k, v in model.p.items()}
    grads = model.gradients(x.astype(float), counts, y)
    for name, w in model.p.items():
        at = tuple(0 for _ in w.shape)
        keep = w[at]
        w[at] = keep + 1e-5
        up = loss()
        w[at] = keep - 1e-5
        down = loss()
        w[at] = keep
        assert abs((up - down) / 2e-5 - grads[name][at]) < 1e-4, name


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality_mil.score(docs, quality_mil.fit(docs, labels)).join(labels, "doc_id").filter("held_out").collect()
    assert sum(g.predicted == g.quality for g in got) > 0.93 * len(got)


@pytest.mark.parametrize("max_rate", [5.0, None])
def test_rates_reach_the_targets(spark, max_rate):
    rng = np.random.default_rng(1)
    p = rng.dirichlet([4, 1, 1], 400)
    tokens = rng.integers(1, 500, 400)
    cells = spark.createDataFrame([(x.tolist(), float(t)) for x, t in zip(p, tokens)], "p array<double>, tokens double")
    weights = (0.7, 0.2, 0.1)
    steps, size = mixing.fit_rates(cells, weights, max_rate)
    rate = np.array([r[0] for r in cells.select(mixing.replay(F.col("p"), steps, size, max_rate)["rate"]).collect()])
    assert (rate >= 0).all() and len(steps) < 150
    mass = (p * tokens[:, None]).sum(0)
    assert np.allclose((p * (tokens * rate)[:, None]).sum(0) / tokens.sum(), np.array(weights) / 0.7 * mass[0] / tokens.sum(), atol=2e-4)


def test_mix_of_the_documents_reaches_its_targets(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = mixing.mix(docs, labels).join(labels.withColumnRenamed("doc_id", "k"), F.col("row.doc_id") == F.col("k"), "left").collect()
    shares = np.array([sum(g.tokens * g.rate * g[f"p_{x}"] for g in got) for x in mixing.DOMAINS])
    assert np.abs(shares / shares.sum() - np.array(mixing.WEIGHTS)).max() < 1e-3
    # the classifier: labelled toxic documents weigh more in the toxic domain than the others
    toxic = [g.p_toxic for g in got if g.toxic == 1]
    clean = [g.p_toxic for g in got if g.toxic == 0]
    assert np.mean(toxic) > 0.4 and np.mean(clean) < 0.1


def test_mixing(docs, rows, labels, empty):
    got = mixing.mix(docs, labels).collect()
    assert collections.Counter(g.row.doc_id for g in got) == collections.Counter(r[0] for r in rows)
    for g in got:
        assert g.tokens == len(words(g.row.text)) and abs(g.p_clean + g.p_low + g.p_toxic - 1) < 1e-9
        assert 0 <= g.rate and math.floor(g.rate) <= g.copies <= math.ceil(g.rate)
    assert all(g.rate <= 1 for g in mixing.mix(docs, labels, max_rate=mixing.ONCE).collect())
    drawn = mixing.draw(mixing.mix(docs, labels))
    assert drawn.columns == docs.columns and drawn.count() == sum(g.copies for g in got)
    assert mixing.mix(empty, labels).count() == 0
    assert {g.copies for g in mixing.mix(docs, labels.limit(0)).collect()} == {1}


def test_language_model(docs, rows, empty):
    train = [r for r in rows if r[0] is None or zlib.crc32(str(r[0]).encode()) % 7 != 2]
    counts = collections.Counter(w.lower() for r in train for w in words(r[1]))
    n, v = sum(counts.values()) + len(train), len(counts) + 1
    expected = collections.Counter()
    for r in rows:
        found = [w.lower() for w in words(r[1])]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in found) + math.log10((len(train) + 1) / (n + v + 1))
        expected[(r[0], r not in train, len(found) + 1, sum(counts[w] > 0 for w in found) + 1, n, round(base, 4))] += 1
    got = attention_lm.score_documents(docs).collect()
    assert expected == collections.Counter((g.doc_id, g.held_out, g.n_tokens, g.n_known, g.train_tokens, round(g.base_score, 4)) for g in got)
    assert all(g.score < 0 and math.isfinite(g.score) for g in got)
    assert attention_lm.score_documents(empty).count() == 0


def test_language_model_scores_each_token_once():
    from stayframe.llm import attention

    rng = np.random.default_rng(0)
    counts = rng.integers(0, 50, 40)
    windows = rng.integers(0, 40, (50, attention.WINDOW + 1))
    model = attention.AttentionModel(counts, attention.token_classes(counts, windows))
    texts = [rng.integers(0, 40, n) for n in (1, 2, 15, 16, 17, 33, 100)]
    sizes = np.array([len(t) for t in texts])
    together = model.log10(np.concatenate(texts), sizes, 39)
    for t, s in zip(texts, together):  # one id at a time, each seen in its own window
        total = 0.0
        for k in range(len(t)):
            block = k // attention.STRIDE * attention.STRIDE
            place = np.arange(attention.WINDOW) + block - (attention.WINDOW - attention.STRIDE) - 1
            x = np.where(place < 0, 39, t[np.clip(place, 0, len(t) - 1)])
            x[place >= k] = 0  # what comes later must not matter
            z = model.forward(x[None], (place < -1)[None])
            total += z.reshape(attention.STRIDE, -1)[k - block, model.classes[t[k]]] + model.within[t[k]]
        assert abs(total / math.log(10) - s) < 1e-3
    total = np.exp(model.within)
    assert np.allclose(np.bincount(model.classes, weights=total)[np.unique(model.classes)], 1)


def test_language_model_gradients_and_windows():
    from stayframe.llm import attention

    rng = np.random.default_rng(2)
    counts = rng.integers(1, 50, 40)
    model = attention.AttentionModel(counts, attention.token_classes(counts, rng.integers(0, 40, (50, attention.WINDOW + 1))))
    model.table = model.table.astype(float)
    model.p = {k: model.table[:, 16 * i:16 * i + 16] for i, k in enumerate("QKVE")} | {k: model.p[k].astype(float) for k in attention.DENSE}
    x, y, inside, first, _ = attention._blocks(rng.integers(0, 40, 120), np.array([40, 1, 50, 29]), 39)
    at = np.arange(1, 9).reshape(2, 4)
    run, classes = x[np.concatenate((at[:, :1] - 1, at), axis=1)], model.classes[y[at]]
    dense, rows = model.gradients(run, first[at], classes, inside[at])
    table = np.zeros(model.table.shape)
    np.add.at(table, run.ravel(), rows.reshape(-1, table.shape[1]))

    def loss():  # window by window
        windows = np.concatenate((x[at - 1], x[at]), axis=2).reshape(-1, attention.WINDOW)
        absent = np.zeros(windows.shape, bool)
        absent[first[at].ravel(), :attention.STRIDE] = True
        z = model.forward(windows, absent)[np.arange(classes.size), classes.ravel()]
        return -z[inside[at].ravel()].mean()

    places = [(model.p[k], g, (0,) * g.ndim) for k, g in dense.items()] + [(model.p["kp"], dense["kp"], (20, 3))]
    places += [(model.table, table, (int(run[0, 1, 3]), c)) for c in (1, 17, 33, 49)]
    for w, grad, k in places:
        keep = w[k]
        w[k] = keep + 1e-4
        up = loss()
        w[k] = keep - 1e-4
        down = loss()
        w[k] = keep
        assert abs((up - down) / 2e-4 - grad[k]) < 1e-4

    for sizes in ([700, 1, 30], [5], [129, 128, 127]):  # over all rounds, each place is an input once
        ids = rng.integers(0, 39, sum(sizes))
        got = sum(attention.AttentionModel(counts, model.classes).learn(ids, np.array(sizes), 39, k, 3) for k in range(3))
        inputs = np.append(39, ids)[:-1]
        inputs[np.cumsum(sizes) - sizes] = 39
        assert (got == np.bincount(inputs, minlength=40)).all()


def test_language_model_scores_are_the_same_for_every_split(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    one, other = ({r["doc_id"]: r["score"] for r in attention_lm.score_documents(d).collect()}
                  for d in (docs.coalesce(1), docs.repartition(5, "text")))
    assert one.keys() == other.keys() and all(abs(one[k] - other[k]) < 1e-6 * abs(one[k]) for k in one)


def test_language_model_learns_from_every_training_id(spark, monkeypatch):
    from stayframe.llm import attention

    encoder = piece_encoder(default_path())
    size, end = len(encoder.ends), len(encoder.ends) - 1
    rng = np.random.default_rng(5)
    names = ["".join(rng.choice(list("abcdefghiklmnoprstu"), 6)) for _ in range(3000)]
    rows = [(0, " ".join(names[:2000]))] + [(k, names[1000 + k]) for k in range(1, 2000)]  # one long, many short
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(attention_lm, "CHUNK_BYTES", 10_000)
    corpus = attention_lm._read_corpus(frame, default_path(), 8, 5, 3)
    train = [t for r, t in zip(rows, ids_of(rows, end)) if zlib.crc32(str(r[0]).encode()) % 7 != 2]
    assert len(train[0]) > 1500
    counts = np.bincount(np.concatenate(train).astype(int), minlength=size)
    assert (attention_lm._subword_counts(corpus, size) == counts).all()
    slot, expected = attention.frequent_slots(counts), np.zeros((size, attention.SINGLES + 1))
    for t in train:
        np.add.at(expected, (t.astype(int), slot[np.append(end, t[:-1]).astype(int)]), 1)
    assert (attention_lm._contexts(corpus, counts, end) == expected).all()
    model = attention_lm._fit(corpus, size, end)
    first = attention.AttentionModel(counts, model.classes)
    inputs = np.unique(np.concatenate([t[:-1] for t in train])).astype(int)
    assert (model.p["E"][inputs] != first.p["E"][inputs]).any(1).all()
    unseen = np.setdiff1d(np.flatnonzero(counts == 0), [end])
    assert (model.p["E"][unseen] == first.p["E"][unseen]).all()
    before, after = (m.log10(np.concatenate(train), np.array([len(t) for t in train]), end).sum() for m in (first, model))
    assert after > before
