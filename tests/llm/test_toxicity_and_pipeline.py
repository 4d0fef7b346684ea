"""The network's gradients and held-out accuracy; the pipeline against its stages in plain Python."""

import zlib

import numpy as np
import pytest

import corpus_pipeline
from colloquy.llm import lengths, pareto_mix, toxicity
from colloquy.llm.queries import BYTE_BPE, PATTERN
from colloquy.staging import stage
from tests.llm.test_partition_join import naive


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    net = toxicity.Network.new(1)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    embedded = rng.normal(size=(6, toxicity.CHAR_DIM + toxicity.WORD_DIM))
    numbers = [np.array([0, 1, 2, 3, 4, 5] * 7), np.array([2, 0])]
    windows, real, _ = toxicity._windows(numbers, 6)
    slope = rng.normal(size=len(windows))

    def loss(inputs=embedded):
        return float(net.forward(net.project(inputs).astype(np.float64), windows, real) @ slope)

    projected = net.project(embedded).astype(np.float64)
    _, kept = net.forward(projected, windows, real, keep=True)
    grads, d_projected = net.backward(projected, windows, kept, slope)
    grads["input"] = embedded.T[None] @ d_projected[:, :-1]
    for name in ("out", "attend", "attend_out", "attend_bias", "state", "input"):
        flat = net.weights[name].reshape(-1)
        for at in rng.choice(flat.size, min(4, flat.size), replace=False):
            before = flat[at]
            flat[at] = before + 1e-4
            up = loss()
            flat[at] = before - 1e-4
            down = loss()
            flat[at] = before
            assert grads[name].reshape(-1)[at] == pytest.approx((up - down) / 2e-4, rel=2e-2, abs=2e-4), name


def test_windows_overlap_and_cover_every_word():
    for size in (0, 1, 16, 31, 32, 33, 48, 49, 500):
        windows, real, begins = toxicity._windows([np.arange(size), np.arange(5)], 999)
        first = windows[: begins[1]][real[: begins[1]]]
        assert set(first.tolist()) == (set(range(size)) or {999})
        assert begins[1] == max(1, size - toxicity.WINDOW + 1)


def test_every_window_is_scored():
    """Against ``forward`` on each window by itself; moving a passage by words moves no score."""
    net = toxicity.Network.new(3)
    words = [f"w{i * i % 97}" for i in range(150)]
    scorer = toxicity.Scorer(net)
    bodies = [" ".join(words[:n]) for n in (150, toxicity.WINDOW - 1, toxicity.WINDOW, toxicity.WINDOW + 1, 0, 5, 64)]
    got = scorer.scores(bodies)
    for body, score in zip(bodies, got, strict=True):
        split = body.split()
        parts = [split[at : at + toxicity.WINDOW] for at in range(max(1, len(split) - toxicity.WINDOW + 1))]
        windows, real, _ = toxicity._windows([scorer.row_of[[scorer.written[w] for w in part]] for part in parts], 0)
        assert score == pytest.approx(toxicity._gate(net.forward(scorer.rows, windows, real).astype(float)).max(), abs=1e-5)
    # Each window of a text, as a text of its own, scores no more than the text.
    alone = scorer.scores([" ".join(words[at : at + toxicity.WINDOW]) for at in range(len(words) - toxicity.WINDOW + 1)])
    assert alone.max() == pytest.approx(got[0], abs=1e-5)
    assert alone[::16].max() < got[0] - 1e-3


def test_training_reads_long_texts_and_misses_no_label(spark):
    ids = [i for i in range(300) if zlib.crc32(str(i).encode()) % 3 != 1]
    long_text = " ".join(f"w{i}" for i in range(1000))
    docs = spark.createDataFrame([(i, f"d{i} {long_text}" if i % 2 else f" d{i} short ") for i in ids[:100]] + [(ids[100], "x" * 100_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids[:100]] + [(ids[100], 0)] + [(-i, 1) for i in range(1, 4000)], "doc_id long, toxic int")
    sample = toxicity.training_sample(docs, labels)
    assert len(sample) == 101 and {label for _, label in sample} == {0, 1}
    bodies = {r.text for r in docs.collect()}
    assert all(body in bodies for body, _ in sample)
    assert sum(len(body.split()) == 1001 for body, label in sample if label) == sum(label for _, label in sample) > 20
    # Toxic labels there are, but none with a text.
    with pytest.raises(ValueError, match="labelled 0"):
        toxicity.score(docs.filter("doc_id % 2 = 0"), labels)


def test_words_are_hashed_alike_however_they_are_grouped():
    words = ["a", "idiot", "größe", "_", "x" * 5000, "語", "ab", "ba"]
    rows, begins, whole = toxicity._rows_of(words)
    ends = [*begins[1:], len(rows)]
    for i, word in enumerate(words):
        alone, _, own = toxicity._rows_of([word])
        assert rows[begins[i] : ends[i]].tolist() == alone.tolist() and own[0] == whole[i]
        assert len(alone) == sum(max(len(word) + 3 - n, 0) for n in toxicity.ORDERS) > 0
    assert len(set(whole.tolist())) == len(words)


def test_held_out_accuracy(spark):
    """Trained on two thirds of the labelled documents of the large test table, scored on the rest."""
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = toxicity.score(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    judged = [(truth[r.doc_id], r.predicted, r.score) for r in rows if r.held_out and r.doc_id in truth]
    positive = [p for t, p, _ in judged if t]
    negative = [p for t, p, _ in judged if not t]
    # Some labels of this table follow no word of the text; most of the others must be found.
    assert sum(positive) >= 0.8 * len(positive)
    assert sum(negative) <= 0.03 * len(negative)


def test_near_copies_go_by_row(spark):
    one, other, third = (" ".join(f"{c}{i}" for i in range(60)) for c in "abc")
    rows = [(9, one), (5, one + " x"), (5, other), (None, one + " y"), (None, third), (None, third + " z"), (7, "alone")]
    docs = spark.createDataFrame([(i, text, "en", "a", len(text)) for i, text in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((r.doc_id or 0, r.text[:2]) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect())
    assert got == [(0, "c0"), (5, "a0"), (5, "b0"), (7, "al")]


def test_pipeline_stages_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    toxic = {r.doc_id for r in toxicity.score(docs.select("doc_id", "text"), labels).filter("predicted = 1").collect()}
    results = {}
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, sf_dir), f"test-{name}")
        results[name] = docs.collect()
    original = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}

    kept = {i for i in original if i not in toxic}
    assert {r.doc_id for r in results["toxicity"]} == kept
    assert all(r == original[r.doc_id] for r in results["toxicity"])

    first = {}
    for i in sorted(kept):
        first.setdefault(original[i].text.encode().lower(), i)
    assert sorted(r.doc_id for r in results["exact_dedup"]) == sorted(first.values())

    left = sorted(first.values())
    named = naive([original[i].text for i in left])
    stays = [left[i] for i, _, root in named if i == root]
    assert sorted(r.doc_id for r in results["ngram_jaccard_join"]) == stays

    copies = {}
    for r in results["mix_sources"]:
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
        assert r == original[r.doc_id]
    mixed = pareto_mix.mix(spark.createDataFrame(results["ngram_jaccard_join"])).collect()
    assert copies == {r.doc_id: r.copies for r in mixed if r.copies}

    library = lengths._encoding(BYTE_BPE, PATTERN)
    assert sorted((r.doc_id, r.n_tokens) for r in results["byte_bpe"]) == sorted(
        (i, len(library.encode_ordinary(original[i].text))) for i, n in copies.items() for _ in range(n)
    )
