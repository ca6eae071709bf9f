"""More brute force: scores of the toxicity model, both sides of the mix, its flow, likeness of fingerprints."""

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from trackledger import session
from trackledger.llm import fingerprints, mixing, near_dups, toxicity
from trackledger.llm.words import text_column


def _slots(text):
    data = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in (text or "").encode())
    found = set()
    for size in toxicity.SIZES:
        for k in range(len(data) - size + 1):
            value = 0
            for byte in data[k : k + size]:
                value = (value * 0x01000193 + byte + 1) & 0xFFFFFFFF
            found.add((((value ^ (size << 24)) * 0x9E3779B1) & 0xFFFFFFFF) >> (32 - toxicity.SLOT_BITS))
    return found


def test_toxicity_scores_are_sums_over_the_texts_own_ngrams(odd):
    draw = np.random.default_rng(1)
    texts = [r["text"] for r in odd.collect()] + ["abcde", "ABCDE\tf", "x" * 9, "ñandú ñandú", "stupid " * 30]
    every = sorted(set().union(*map(_slots, texts)))
    slots = np.array(sorted(draw.choice(every, len(every) // 2, replace=False)))
    model = toxicity.Model(slots, draw.normal(size=len(slots)) / 50, -0.3)
    weight = dict(zip(slots.tolist(), model.weights.tolist()))
    want = [sum(weight.get(s, 0) for s in _slots(t)) + model.intercept for t in texts]
    got = model.scores(text_column(pa.array(texts)))
    assert got == pytest.approx(1 / (1 + np.exp(-np.clip(want, -500, 500))), abs=1e-9)


def test_a_very_long_text_is_scored_whole(shared):
    """The telling words stand at the end of 3 MB, beyond what is read at a time."""
    texts = ["calm words " * 300_000 + "vile rotten trash", "calm words " * 300_000]
    slots = np.array(sorted(_slots("vile rotten trash") - _slots("calm words calm words ")))
    model = toxicity.Model(slots, np.full(len(slots), 1.0), -3.0)
    docs = shared.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("score", F.lit("own"))
    assert [r["doc_id"] for r in toxicity.reject(docs, model).collect()] == [1]
    assert toxicity.reject(docs, model).columns == docs.columns


def test_taken_words_come_near_the_targets_from_both_sides(shared, sf_dir):
    docs = shared.read.parquet(f"{sf_dir}/documents.parquet")
    rows = mixing.mix_by_source(docs)
    assert rows.where("taken > 2 * size OR taken < 0").isEmpty()
    name = docs.select(F.col("doc_id").alias("id"), "source")
    joined = rows.join(name, F.col("doc_id") == F.col("id")).groupBy("source")
    found = joined.agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.first("source_size").alias("size")).collect()
    assert len(found) > 5
    for r in found:
        assert abs(r["taken"] - r["target"]) <= 2 and r["target"] <= 2 * r["size"] + 1e-6
    total = sum(r["size"] for r in found)
    assert sum(r["target"] for r in found) == pytest.approx(min(1.5 * total, 2 * total))


def _best_flow(patterns, quotas, copies):
    """(words routed, least cost) by trying all splits."""
    choices = []
    for sources, words in patterns:
        limit = copies * words
        choices.append([x for x in itertools.product(range(limit + 1), repeat=len(sources)) if sum(x) <= limit])
    best = None
    for split in itertools.product(*choices):
        used = [0] * len(quotas)
        for (sources, _), x in zip(patterns, split):
            for s, n in zip(sources, x):
                used[s] += n
        if any(u > q for u, q in zip(used, quotas)):
            continue
        cost = 0
        for (_, words), x in zip(patterns, split):
            left = sum(x)
            for k in range(copies):
                cost += min(left, words) * (k + 1) ** 2
                left -= min(left, words)
        key = (-sum(map(sum, split)), cost)
        best = key if best is None or key < best else best
    return -best[0], best[1]


@pytest.mark.parametrize("seed", range(6))
def test_flow_is_the_cheapest(seed):
    draw = np.random.default_rng(seed)
    n_sources = 2
    patterns = []
    for sources in ([0], [1], [0, 1]):
        patterns.append((sources, int(draw.integers(0, 4))))
    quotas = [int(q) for q in draw.integers(0, 8, n_sources)]
    flow = mixing.route(patterns, quotas, 2)
    routed = sum(map(sum, flow))
    cost = sum(n * (k + 1) ** 2 for words in flow for k, n in enumerate(words))
    assert (routed, cost) == _best_flow(patterns, quotas, 2)


def test_likeness_follows_what_two_texts_share(shared):
    draw = np.random.default_rng(3)
    base = " ".join(f"w{int(k)}" for k in draw.integers(0, 900, 400))
    other = " ".join(f"v{int(k)}" for k in draw.integers(0, 900, 400))
    texts = [base, "shift " + base, base[: len(base) // 2] + other[: len(other) // 2], other]
    docs = shared.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    near = {r["doc_id"]: r["near_next"] for r in fingerprints.fingerprint_with_next(docs).collect()}
    assert near[0] > 0.9  # a word before it moves all offsets and changes little else
    assert 0.1 < near[1] < 0.8 and 0.1 < near[2] < 0.8
    assert all(0 <= x <= 1 for x in near.values())


def test_two_texts_of_one_id_and_null_ids_in_the_join(shared):
    words = [f"t{k}" for k in range(100)]
    near = [*words[:50], "edit", *words[51:]]
    docs = [(5, " ".join(words)), (5, "something else entirely of five words"), (6, " ".join(words)), (8, " ".join(near)), (None, " ".join(words)), (9, None)]
    frame = shared.createDataFrame(docs, "doc_id long, text string").repartition(2)
    found = near_dups.documents(frame)
    assert found.count() == len(docs)
    top = {r["doc_id"]: r["component_id"] for r in found.collect()}
    assert top[6] == 5 and top[9] == 9 and top[None] is None


def test_documents_that_share_too_few_shingles_are_never_paired(spark):
    size = 146  # two sets of it link only if their prefixes share 17 shingles

    def rows(doc_id, part, shingles):
        return [(s, doc_id, (size << 32) + s, part) for s in shingles]

    group = [row for k in range(60) for row in rows(k, 0, range(k % 3 * 8, k % 3 * 8 + 18))]
    # The group has all 16 of the first one, a document of it 9 at most; all 17 of the other one are in a third of them.
    few, enough = rows(100, 100, range(0, 32, 2)), rows(101, 101, range(1, 18))
    open_ = spark.createDataFrame(group + few + enough, "shingle long, doc_id long, place long, part long")
    found = {(r["a"], r["b"]) for r in near_dups._crossing(open_).collect()}
    assert found == {(k, 101) for k in range(0, 60, 3)}


def test_texts_fetched_for_pairs_do_not_stay(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    words = [f"w{k}" for k in range(80)]
    docs = [(k, " ".join([*words, f"end{k}"])) for k in range(8)]
    found = near_dups.documents(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r["component_id"] for r in found.collect()} == {0}
    left = [pq.read_schema(f).names for f in tmp_path.rglob("part-*.parquet")]
    assert left and not [names for names in left if {"text", "hub_place"} & set(names)]
