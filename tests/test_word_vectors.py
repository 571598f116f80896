"""Word vectors against a dense version, and their independence of partitions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayframe.operators import word_vectors as W


def corpus():
    rng = np.random.default_rng(5)
    topics = [[f"t{t}w{k}" for k in range(14)] for t in range(4)]
    notes = [[str(w) for w in rng.choice(topics[k % 4], 40)] + (["glue"] if k % 3 else []) for k in range(120)]
    # planted analogues: left and right never meet, but both keep the company of topic 0
    notes += [[str(w) for w in rng.choice(topics[0], 6)] + ["left" if k % 2 else "right"] + [str(w) for w in rng.choice(topics[0], 6)] for k in range(60)]
    return notes + [[], ["rare"], ["t0w0"], notes[0], None]


@pytest.fixture(scope="module")
def notes(spark):
    return spark.createDataFrame([(k, n) for k, n in enumerate(corpus())], "row_id long, tokens array<string>")


def table(model):
    return {r["word"]: np.array(r["vector"]) for r in model.vectors().collect()}


def slow_information(notes, window, min_count):
    counts = {}
    for n in notes:
        for w in n or []:
            counts[w] = counts.get(w, 0) + 1
    words = sorted(w for w, n in counts.items() if n >= min_count)
    at = {w: k for k, w in enumerate(words)}
    c = np.zeros((len(words), len(words)))
    for n in notes:
        for i, x in enumerate(n or []):
            for d in range(1, window + 1):
                if i + d < len(n) and x in at and n[i + d] in at:
                    c[at[x], at[n[i + d]]] += window + 1 - d
                    c[at[n[i + d]], at[x]] += window + 1 - d
    rows = c.sum(1, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        m = np.log(c * c.sum() / (rows * rows.T))
    return words, np.where(np.isfinite(m) & (m > 0), m, 0)


def test_vectors_factorise_the_information_of_pairs(spark, notes, monkeypatch):
    words, m = slow_information(corpus(), 5, 5)
    monkeypatch.setattr(W, "BLOCK", 16)
    monkeypatch.setattr(W, "GRAMS", 2)
    monkeypatch.setattr(W, "STEP_TOKENS", 50)
    got = table(W.train(notes, size=6, window=5, min_count=5, passes=12))
    assert sorted(got) == words
    v = np.array([got[w] for w in words])
    values, basis = np.linalg.eigh(m)
    top = np.argsort(-values)[:6]
    top = top[values[top] > 0]
    want = (basis[:, top] * values[top]) @ basis[:, top].T
    close = v @ v.T
    # the planted topics' eigenvalues stand far above the rest; the last few dimensions turn slowly
    assert np.abs(close - want).max() < 0.25 * np.abs(want).max() and np.corrcoef(close.ravel(), want.ravel())[0, 1] > 0.99


def test_the_same_vectors_whatever_the_partitions(notes):
    found = [table(W.train(notes.repartition(n), size=8, min_count=2)) for n in (1, 2, 4)]
    for other in found[1:]:
        assert found[0].keys() == other.keys()
        assert max(np.abs(found[0][w] - other[w]).max() for w in other) < 1e-6


def test_words_of_like_company_are_alike(notes):
    got = table(W.train(notes, size=8, min_count=5))
    like = lambda a, b: got[a] @ got[b] / np.linalg.norm(got[a]) / np.linalg.norm(got[b])
    assert like("left", "right") > 0.8
    assert like("left", "right") > max(like("left", f"t{t}w{k}") for t in (1, 2, 3) for k in range(14)) + 0.3


def test_note_sums_saving_and_small_inputs(spark, notes, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "BLOCK", 16)
    monkeypatch.setattr(W, "NOTES_PER_COPY", 30)
    model = W.train(notes, size=4, min_count=5, passes=2)
    got, vectors = {r["key"]: r for r in W.note_sums(notes.select(F.col("row_id").cast("string").alias("key"), "tokens"), model).collect()}, table(model)
    for k, n in enumerate(corpus()):
        own = [vectors[w] for w in n or [] if w in vectors]
        assert (str(k) in got) == bool(own)
        if own:
            assert got[str(k)]["n_in"] == len(own) and np.allclose(got[str(k)]["total"], np.sum(own, 0), atol=1e-9)
    model.save(str(tmp_path / "v"))
    loaded = W.WordVectors.load(spark, str(tmp_path / "v"))
    assert loaded.size == 4 and {w: v.tolist() for w, v in table(loaded).items()} == {w: v.tolist() for w, v in vectors.items()}
    none = W.train(notes.limit(0), size=4)
    assert table(none) == {} and W.note_sums(notes.select(F.col("row_id").cast("string").alias("key"), "tokens"), none).collect() == []
    alone = W.train(spark.createDataFrame([(["a"],), (["a"],)], "tokens array<string>"), size=4, min_count=1)
    assert {w: v.tolist() for w, v in table(alone).items()} == {"a": [0.0] * 4}


def test_notes_meet_their_vectors_without_a_shuffle(spark, monkeypatch):
    from pyspark.ml.functions import vector_to_array

    from stayframe.operators import text as N
    monkeypatch.setattr(W, "BLOCK", 4)
    monkeypatch.setattr(W, "NOTES_PER_COPY", 3)
    monkeypatch.setattr(W, "TOKENS_PER_COPY", 5)
    monkeypatch.setattr(W, "STEP_ENTRIES", 2)
    words = [f"w{k}" for k in range(23)]
    model = W.from_table(spark.createDataFrame([(w, [float(k), 0.25]) for k, w in enumerate(words)], "word string, vector array<double>"), 2)
    rows = [(k % 7, 1, None, [f"w{(k * j) % 30}" for j in range(k % 9)]) for k in range(40)] + [(None, 2, 3, None), (None, 2, 3, ["w1", None, "w1"])]
    found = N.note_vectors(spark.createDataFrame(rows, "row_id long, subject_id long, admission_id long, tokens array<string>").coalesce(2), model)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    got = sorted(repr(tuple(r)) for r in found.withColumn("vec", vector_to_array("vec")).collect())
    mean = lambda own: [sum(x) / len(own) for x in zip(*own)] if own else [0.0, 0.0]
    assert got == sorted(repr((*r[:3], mean([[float(w[1:]), 0.25] for w in r[3] or [] if w in words]))) for r in rows)


def test_tokens_in_one_pass_are_those_of_the_cleaned_text(spark):
    from stayframe.functions.expressions import clean_text, text_tokens, tokens
    texts = ["", None, " A b\tC\n", "x[**PHI 1**]y", "[**a\nb**] q", "Ünï-cödé 𝒜𝒷 3four5 six seven", "İSTANBUL ß", "áb", "--", "日本 語"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(text_tokens("text").alias("a"), tokens(clean_text("text")).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in rows) and ["x", "y"] in [r["a"] for r in rows]


def test_a_fit_holds_little_more_than_one_copy_of_its_vectors(spark, notes, monkeypatch):
    from pathlib import Path
    whole = table(W.train(notes, size=12, min_count=2))
    for name, value in dict(BLOCK=4, GROUP_BLOCKS=1, SLAB=3, BATCHES=4, GRAMS=3, MERGED=16, PRODUCT_ENTRIES=5, STEP_TOKENS=64).items():
        monkeypatch.setattr(W, name, value)
    remove, held, roots = W._remove, [], set()

    def watched(session, path):
        root = Path(path.removeprefix("file:")).parent
        held.append(sum(f.stat().st_size for f in root.glob("[qy][0-9]*/*")))
        roots.update([root] if held[-1] else [])
        remove(session, path)

    monkeypatch.setattr(W, "_remove", watched)
    parts = table(W.train(notes, size=12, min_count=2))
    a, b = (np.array([t[w] for w in sorted(whole)]) for t in (whole, parts))
    assert parts.keys() == whole.keys() and np.abs(a @ a.T - b @ b.T).max() < 1e-9  # a dimension's sign hangs on rounding
    one = len(whole) * 12 * 8
    assert one <= max(held) < 1.8 * one  # products and vectors are never both whole
    assert len(roots) == 1 and not next(iter(roots)).exists()


def test_cells_are_packed_and_added():
    rng = np.random.default_rng(2)
    for most in (3, 300, 1 << 20, 1 << 40):
        cells = np.unique(rng.integers(0, most, 200))
        counts = rng.integers(1, most + 1, len(cells))
        a, b = W.unpacked_cells(W.packed_cells(cells, counts))
        assert np.array_equal(a, cells) and np.array_equal(b, counts)
        a, b = W._added([(cells, counts), (cells[:1], counts[:1]), (cells, counts)])
        assert np.array_equal(a, cells) and b.tolist() == [3 * int(counts[0]), *(2 * counts[1:]).tolist()]
