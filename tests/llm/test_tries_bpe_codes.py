"""Operators 11 to 13 against brute-force versions, on awkward rows."""

import base64
import collections
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from stayframe.llm import byte_bpe, prefix_trie, vector_codes

# -- 11 ------------------------------------------------------------------------


def slow_nodes(rows):
    """rows: (conv_id, turn, role, text). Every node from its members."""
    turns = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}/{role}{text}".encode()).hexdigest()
            turns[c].append((turn is not None, turn or 0, digest, len(text), (role, text)))
    own = {c: [t[4] for t in sorted(ts)] for c, ts in turns.items()}
    paths = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        paths[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + ts[h:]
    members = collections.defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[tuple(p[:d])].append(c)
    children = collections.defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    out = []
    sums = {}
    for p in sorted(members, key=len, reverse=True):
        leaves, saved = sum(sums[k][0] for k in children[p]), sum(sums[k][1] for k in children[p])
        sums[p] = (leaves or 1, saved + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0))
        ends = ",".join(str(c) for c in sorted(members[p]) if len(paths[c]) == len(p))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]), *sums[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def conversation_rows():
    rng = random.Random(11)
    texts = ["", "a", "hello", "é🙂 long", "x" * 40, None]
    rows = []
    for c in [*range(0, 30), *range(100, 130), 205, -3, -150, -100, 2**40, 307]:
        rows += [(c, t, rng.choice(["user", "assistant", None]), rng.choice(texts)) for t in range(rng.randint(1, 9))]
    rows += [(c, t, "user", f"same {t}") for c in range(400, 440) for t in range(12)]              # copies
    rows += [(c, t, "user", f"same {t}" if t < 7 else f"own {c} {t % 2}") for c in range(440, 460) for t in range(12)]
    rows += [(7, None, "user", "nothing"), (7, None, None, None), (7, 2, "user", "twice"), (7, 2, "user", "twice"), (None, 1, "user", "lost"), (None, None, None, None)]
    rows += [(600, t, "user", f"far {t // 2}") for t in range(40)] + [(601, t, "user", f"far {t // 2}") for t in range(38)] + [(699, t, "user", f"far {t // 2}") for t in range(40)]
    return rows


@pytest.fixture(scope="module")
def talks(spark):
    rows = conversation_rows()
    schema = "conv_id long, turn long, role string, text string, depth string, a string, node string"
    return rows, spark.createDataFrame([(*r, "x", "y", "z") for r in rows], schema).repartition(3)


@pytest.mark.parametrize("levels,shard", [(256, 4096), (3, 4), (1, 1), (5, 7)])
def test_prefix_nodes(talks, levels, shard):
    rows, frame = talks
    found = sorted((tuple(r) for r in prefix_trie.prefix_nodes(frame, levels, shard).collect()), key=repr)
    assert found == slow_nodes(rows)


def test_prefix_nodes_without_turns(spark, talks):
    assert prefix_trie.prefix_nodes(talks[1].limit(0)).collect() == []
    one = spark.createDataFrame([(105, 1, "user", "gone")], "conv_id long, turn long, role string, text string")
    assert zlib.crc32(b"105") % 6 > 0  # its head is that of conversation 100, which is absent
    assert [tuple(r)[:7] for r in prefix_trie.prefix_nodes(one).collect()] == [(105, 0, None, 1, 0, 1, 0)]


def test_double_array_holds_exactly_its_paths():
    rng = np.random.default_rng(3)
    paths = np.unique(rng.integers(1, 9, (200, 5)), axis=0)
    for row in paths[::3]:
        row[rng.integers(1, 5):] = 0
    trie = prefix_trie.build(paths, 8)
    prefixes = {tuple(p[:k].tolist()) for p in paths for k in range(6) if (p[:k] > 0).all()}
    for length in range(1, 5):
        for p in list(prefixes):
            if len(p) == length - 1:
                state = np.zeros(1, np.int64)
                for i in p:
                    state = trie.step(state, np.array([i]))
                for i in range(1, 9):
                    assert (trie.step(state, np.array([i]))[0] >= 0) == ((*p, i) in prefixes)


# -- 12 ------------------------------------------------------------------------

def library():
    with open(byte_bpe.default_path(), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("chunk,overlap", [(byte_bpe.CHUNK, byte_bpe.OVERLAP), (64, 24), (40, 40), (9, 9)])
def test_byte_bpe_equals_the_library(docs, rows, empty, chunk, overlap):
    merges = library()
    want = sorted(((r[0], np.array(merges.encode_ordinary(r[1] or ""), "<u4").tobytes(), (r[1] or "").encode()) for r in rows), key=repr)
    found = byte_bpe.decode_documents(byte_bpe.encode_documents(docs, chunk=chunk, overlap=overlap))
    assert sorted(((r["doc_id"], bytes(r["ids"]), bytes(r["decoded"])) for r in found.collect()), key=repr) == want
    assert byte_bpe.decode_documents(byte_bpe.encode_documents(empty, chunk=chunk, overlap=overlap)).collect() == []


def test_chunks_of_white_space_contractions_and_endless_words(spark):
    rng = random.Random(12)
    bits = ["  ", "\n", " \t ", "'re", "'", "ll", "it's", "don't've", "x" * 30, " ", "42", "  7", "...", "中文", "é", " ", " ", "?!", "é", "🙂🙂"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 150))) for _ in range(150)] + [" " * 300, "y" * 500, "a b" * 200, "1" * 99 + " " * 80 + "z"]
    merges = library()
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: bytes(r["ids"]) for r in byte_bpe.encode_documents(frame, chunk=16, overlap=12).collect()}
    assert found == {i: np.array(merges.encode_ordinary(t), "<u4").tobytes() for i, t in enumerate(texts)}


def test_chunks_meet_in_prose(spark):
    """Ordinary text is stitched, not passed on as one run."""
    text = " ".join(f"word{k % 97}, and" for k in range(5000))
    frame = spark.createDataFrame([("d", text)], "doc string, text string")
    path, pattern = byte_bpe.default_path(), byte_bpe.default_pattern()
    spans = byte_bpe._stitched(byte_bpe._edges(byte_bpe._chunks(frame, 4096, 128), 4096, 128, path, pattern)).collect()
    assert len(spans) > 10 and not any(s["loose"] or s["open"] for s in spans)
    assert all(0 <= s["start"] - 4096 * s["k"] <= 128 for s in spans)


# -- 13 ------------------------------------------------------------------------

def slow_codes(rows, parts=8, entries=16, rounds=6):
    kept = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * w:(p + 1) * w]
    books = [[cut(r[1], p) for r in kept[:entries]] for p in range(parts)]

    def near(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            own = collections.defaultdict(list)
            for _, v, _ in kept:
                own[near(v, p)[1]].append(cut(v, p))
            books[p] = [[sum(c) // len(own[k]) for c in zip(*own[k])] if k in own else e for k, e in enumerate(books[p])]
    out = [(i, "".join(f"{near(v, p)[1]:02x}" for p in range(parts)), sum(near(v, p)[0] for p in range(parts)), lab) for i, v, lab in kept]
    total = collections.Counter()
    for _, _, e, lab in out:
        total[lab] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, total[lab], digest) for i, c, e, lab in out), key=repr)


def vector_rows(n=120, dim=16, scale=1.0):
    rng = np.random.default_rng(13)
    rows = [(k, (scale * rng.normal(size=dim)).astype(np.float32).tolist(), int(k % 5) if k % 7 else None) for k in range(n)]
    bad = [None, [None] * dim, [float("nan")] * dim, [1.0] * (dim - 1) + [float("inf")], [1.0] * (dim - 1) + [float("-inf")]]
    rows += [(1000 + k, v, 1) for k, v in enumerate(bad)]
    rows += [(2000, rows[0][1], 3), (2000, rows[0][1], 3), (1, rows[2][1], 2), (None, rows[1][1], None), (-1, [0.0] * dim, 4), (-2, [0.0] * dim, 4)]
    return rows


@pytest.mark.parametrize("n,scale", [(120, 1.0), (3, 1.0), (60, 9000.0)])
def test_vector_codes(spark, monkeypatch, n, scale):
    from stayframe.llm.queries import op13_vector_codes

    rows = vector_rows(n, scale=scale)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    monkeypatch.setattr(vector_codes, "embeddings", lambda *_: frame)
    assert sorted((tuple(r) for r in op13_vector_codes(spark, "").collect()), key=repr) == slow_codes(rows)


def test_vector_codes_of_no_vectors_and_odd_lengths(spark):
    schema = "vec_id long, embedding array<float>, row string, v string, codes string"
    for rows in ([], [(1, None, "", "", "")], [(1, [], "", "", "")]):
        coded, books = vector_codes.compress(spark.createDataFrame(rows, schema))
        assert [r["codes"] for r in coded.collect()] == [None for r in rows if r[1] is not None] and books.digest() == hashlib.sha256(b"").hexdigest()
    coded, _ = vector_codes.compress(spark.createDataFrame([(0, [1.0], "", "", ""), (1, [1.0] * 8, "", "", ""), (2, [2.0] * 16, "", "", "")], schema))
    assert {r["row"]["vec_id"]: (r["codes"], r["error"]) for r in coded.collect()} == {0: (None, None), 1: (b"\0" * 8, 0), 2: (None, None)}
    with pytest.raises(ValueError):
        vector_codes.compress(spark.createDataFrame([(0, [1e20] * 8, "", "", "")], schema))


def test_limbs_and_exact_products():
    rng = np.random.default_rng(1)
    for bits, width in ((12, 8), (28, 8), (29, 2), (20, 300)):
        a, b = (rng.integers(-2**bits, 2**bits, (50, width)) for _ in range(2))
        want = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
        assert vector_codes.exact_dot(a, b).tolist() == want
        for size in (5, 13, 26):
            assert (sum(limb.astype(np.int64) << (size * k) for k, limb in enumerate(vector_codes.limbs(a, size))) == a).all()
