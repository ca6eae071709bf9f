"""Search, whitening and the quality classifier against plain brute-force versions."""

import collections
import math
import re

import numpy as np
import oracle
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from trackledger.llm import catalog, quality, search, whitening
from trackledger.llm.words import text_column

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(docs, items, top=search.TOP):
    """(item_id, rank, doc_id, score) by scoring every document for every item."""
    held = [(i, collections.Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, total = len(held), sum(n for _, _, n in held)
    df = collections.Counter(t for _, c, _ in held for t in c)
    wanted = collections.defaultdict(list)
    for i, t in items:
        wanted[i] += terms(t)
    found = []
    for item, own in wanted.items():
        scores = []
        for doc_id, count, n in held:
            m = 100 - 25 + (25 * n * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((1000000000 * count[t]) // (1000 * count[t] + 12 * m))
                for t in own
                if count[t]
            )
            if score > 0 and doc_id is not None:
                scores.append((-score, doc_id))
        found += [(item, k + 1, i, -s) for k, (s, i) in enumerate(sorted(scores)[:top])]
    return sorted(found, key=repr)


@pytest.fixture(scope="module")
def library(shared):
    """Ties, repeated rows, null ids and texts, one very long text, all under clashing names."""
    draw = np.random.default_rng(3)
    vocabulary = [f"w{k}" for k in range(400)] + ["Éa", "ß", "中文", "x9"]
    weights = 1 / np.arange(1, len(vocabulary) + 1)
    texts = [" ".join(draw.choice(vocabulary, n, p=weights / weights.sum())) for n in draw.integers(1, 120, 300)]
    docs = [(k, t) for k, t in enumerate(texts)]
    docs += [(1000 + k, texts[7]) for k in range(60)] + [(500, texts[3])] * 3
    docs += [(600, "w1-W1_w1,w399 " * 30_000), (601, None), (602, ""), (603, "!?\x00 \x7f"), (None, texts[5]), (604, "É é ÉA")]
    rows = [(i, t, 1, 2, "q", b"r") for i, t in docs]
    schema = "doc_id long, text string, query long, rank int, bound string, bits binary"
    return docs, shared.createDataFrame(rows, schema).repartition(5)


ITEMS = [
    (1, "w0 w1 w2"), (2, "W399 w300"), (2, "w300 w17"), (3, None), (4, "nowhere to be found"), (5, ""),
    (6, "中文, Éa! ß x9"), (None, "w5 w6"), (7, "w7 " * 50 + "w8"), (8, "é"),
]


def test_search_is_brute_force(shared, library, none):
    docs, frame = library
    items = shared.createDataFrame([(i, t, 9) for i, t in ITEMS], "item_id long, text string, score int")
    index = search.build(frame)
    assert rows(search.search(frame, index, items)) == ranked(docs, ITEMS)
    assert rows(search.search(frame, index, items, 3)) == ranked(docs, ITEMS, 3)
    assert search.search(none, search.build(none), items).count() == 0
    assert search.search(frame, index, items.limit(0)).count() == 0


def test_queries_in_parts(shared, library, monkeypatch):
    docs, frame = library
    monkeypatch.setattr(search, "PART", 4)
    items = shared.createDataFrame(ITEMS, "item_id long, text string")
    assert rows(search.search(frame, search.build(frame), items)) == ranked(docs, ITEMS)


def test_a_tied_top_has_the_smallest_ids(shared, library):
    docs, frame = library
    item = next(t for i, t in docs if i == 7)
    found = rows(search.search(frame, search.build(frame), shared.createDataFrame([(1, item)], "item_id long, text string")))
    assert found == ranked(docs, [(1, item)])
    ids = [r[2] for r in sorted(found, key=lambda r: r[1]) if r[3] == found[0][3]]
    assert len(ids) > 10 and ids == sorted(ids)


def test_bounds_are_never_too_low(library):
    docs, frame = library
    index = search.build(frame)
    whole = search.corpus(index)
    held = [(i, collections.Counter(terms(t))) for i, t in docs if terms(t)]
    assert (whole.documents, whole.terms) == (len(held), sum(sum(c.values()) for _, c in held))
    vocabulary = sorted({t.encode() for _, c in held for t in c})
    starts = np.arange(len(vocabulary) + 1)
    every = search.Queries(vocabulary, starts, starts[:-1], np.ones(len(vocabulary), np.int64), whole)
    exact, seen, slack = collections.defaultdict(list), 0, 0
    for i, c in held:
        if i is not None:
            n = sum(c.values())
            values = {t: whole.saturation(np.array([k]), np.array([n]))[0] for t, k in c.items()}
            exact[i].append([values.get(t.decode(), 0) for t in vocabulary])
    for block in index.collect():
        sizes = np.array(block["sizes"])
        found = every.bounds(sizes, block["height"], bytes(block["bits"]))
        for k, i in enumerate(block["ids"]):
            if i is not None:
                want = np.array(exact[i]).max(axis=0)
                assert (found[:, k] >= want).all()
                seen, slack = seen + 1, slack + int((found[:, k][want == 0] > 0).sum())
    assert seen == sum(len(v) for v in exact.values())
    assert slack < seen * len(vocabulary) / 200  # and seldom too high where a term is missing


def test_search_query_matches_sql(shared, sf_dir):
    query = catalog.QUERIES["op12_search"]
    assert oracle.compare(query.run(shared, sf_dir), oracle.connect(sf_dir), query.sql) is None


def _whitened(vectors, count=8):
    """x, n, S, eigenvalues and whitened coordinates by numpy."""
    x = np.floor(np.array(vectors, dtype=np.float64) * 1024).astype(np.int64) + 100000
    centred = x - x.mean(axis=0)
    covariance = centred.T @ centred / len(x)
    values, components = np.linalg.eigh(covariance)
    values, components = values[::-1][:count], components[:, ::-1][:, :count]
    return x, values, centred @ components / np.sqrt(values), np.trace(covariance)


def test_whitening_is_numpys(shared):
    draw = np.random.default_rng(5)
    good = (draw.normal(size=(200, 12)) * np.linspace(2, 0.2, 12)).astype(np.float32).astype(float)
    good[150:] = good[3]  # one vector that many rows share
    vectors = [v.tolist() for v in good]
    odd = [None, [], [1.0] * 11, [float("nan")] + [0.0] * 11, [float("inf")] + [0.0] * 11, [None] + [0.0] * 11]
    data = [(k if k % 50 else None, v, "n", 1) for k, v in enumerate(vectors)] + [(7, v, "o", 2) for v in odd]
    frame = shared.createDataFrame(data, "vec_id long, embedding array<float>, n string, component int").repartition(4)
    found = whitening.whiten(frame)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = found.collect()
    x, values, want, trace = _whitened(good)
    assert len(got) == 200 * 8 and {r["n"] for r in got} == {200}
    assert max(r["identity_error"] for r in got) < 1e-9
    for r in got:
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / trace, rel=1e-9)
    total = x.sum(axis=0)
    deviation = ((200 * x - total) ** 2).sum(axis=1)
    by_id = collections.defaultdict(list)
    for r in got:
        by_id[r["vec_id"]].append(r)
    for k in range(1, 200):
        if k % 50:
            own = sorted(by_id[k], key=lambda r: r["component"])
            assert [int(r["deviation"]) for r in own] == [int(deviation[k])] * 8
            assert np.abs([r["whitened"] for r in own]) == pytest.approx(np.abs(want[k]), abs=1e-8)
    assert len(by_id[None]) == 4 * 8
    same = {tuple(r["whitened"] for r in sorted(by_id[k], key=lambda r: r["component"])) for k in (3, 160, 161)}
    assert len(same) == 1


def test_whitening_of_few_wide_and_no_vectors(shared):
    schema = "vec_id int, embedding array<double>"
    one = whitening.whiten(shared.createDataFrame([(1, [0.5, 0.25])], schema)).collect()
    assert [(r["component"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [
        (1, 0, None, 0.0, None), (2, 0, None, 0.0, None),
    ]
    line = whitening.whiten(shared.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 1.0])], schema)).collect()
    assert {(r["component"], r["whitened"] is None) for r in line} == {(1, False), (2, True)}
    assert sorted(abs(r["whitened"]) for r in line if r["component"] == 1) == pytest.approx([1, 1])
    assert [r["explained"] for r in line if r["component"] == 1] == pytest.approx([1, 1])
    wide = [[3e9, 1.0], [-2e9, 2.0], [1e9, 5.0]]  # squares outgrow 64 bits
    x = [[int(v * 1024) + 100000 for v in row] for row in wide]
    total = [sum(c) for c in zip(*x)]
    want = [sum((3 * v - s) ** 2 for v, s in zip(row, total)) for row in x]
    got = whitening.whiten(shared.createDataFrame(list(enumerate(wide)), schema)).where("component = 1")
    assert [int(r["deviation"]) for r in got.orderBy("vec_id").collect()] == want
    huge = whitening.whiten(shared.createDataFrame([(1, [1e300]), (2, [-1e300])], schema)).collect()
    assert len(huge) == 2 and all(np.isfinite(r["whitened"]) for r in huge)
    assert whitening.whiten(shared.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(shared.createDataFrame([(1, None), (2, [])], schema)).count() == 0


def _matrices():
    draw = np.random.default_rng(7)
    for n in (1, 2, 3, 10, 64):
        a = draw.normal(size=(n, n))
        yield a @ a.T * 1e4
    yield np.diag([5.0] * 20 + [1.0] * 20)
    low = draw.normal(size=(40, 5))
    yield low @ low.T
    yield np.zeros((6, 6))
    yield np.full((2, 2), 262144.0)  # a first pivot of 0 on the way
    yield np.ones((9, 9))
    q = np.linalg.qr(draw.normal(size=(60, 60)))[0]
    yield (q * np.array([7, 7, 7, 6.999999999, 6.9999, 3, 3, 3] + [1] * 52)) @ q.T


@pytest.mark.parametrize("matrix", list(_matrices()), ids=lambda m: f"{len(m)}")
def test_components_are_numpys(matrix):
    values, vectors = whitening.principal(matrix, 8)
    want = np.linalg.eigvalsh(matrix)[::-1][:8]
    scale = max(np.abs(want).max(), 1e-300)
    assert np.abs(values - want).max() <= 1e-13 * scale
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-13
    assert np.abs(matrix @ vectors.T - vectors.T * values).max() <= 1e-13 * scale


def test_whitening_query(shared, sf_dir):
    got = catalog.QUERIES["op11_whitening"].run(shared, sf_dir)
    assert dict(got.dtypes)["deviation"] == "bigint"
    table = shared.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    x, values, want, trace = _whitened([r["embedding"] for r in table])
    deviation = ((len(x) * x - x.sum(axis=0)) ** 2).sum(axis=1)
    found = got.orderBy("vec_id", "component").collect()
    assert len(found) == len(table) * 8
    assert [r["deviation"] for r in found[::8]] == deviation.tolist()
    assert np.abs([r["whitened"] for r in found]) == pytest.approx(np.abs(want).ravel(), abs=1e-8)
    assert max(r["identity_error"] for r in found) < 1e-9


@pytest.fixture(scope="module")
def labelled(shared):
    docs = shared.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return docs, shared.read.parquet("/root/testdata/sf0.01/labels.parquet")


def test_quality_is_right_on_held_out_documents(labelled):
    docs, labels = labelled
    model = quality.train(docs, labels)
    scored = quality.score(docs, model).withColumn("held_out", quality.held_out(F.col("doc_id")))
    got = scored.join(labels.where("quality IS NOT NULL"), "doc_id").where("held_out").collect()
    right = [(r["score"] >= quality.THRESHOLD) == bool(r["quality"]) for r in got]
    assert len(right) > 60 and np.mean(right) > 0.9
    bad = [r["score"] for r in got if not r["quality"]]
    good = [r["score"] for r in got if r["quality"]]
    assert np.mean([g > b for g in good for b in bad]) > 0.9
    assert quality.train(docs.repartition(3), labels) == model  # whatever the order of rows


def test_held_out_labels_change_nothing(labelled):
    docs, labels = labelled
    turned = F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality"))
    assert quality.train(docs, labels.withColumn("quality", turned)) == quality.train(docs, labels)


def test_difference_is_the_compressors():
    draw = np.random.default_rng(2)
    bad = b"".join(b"$$$ %%% " + bytes(draw.integers(97, 123, 6).astype(np.uint8)) for _ in range(400))
    good = b"".join(b"word " + bytes(draw.integers(97, 123, 6).astype(np.uint8)) for _ in range(400))
    texts = ["", None, "word abc", "$$$ %%% " * 400, "word " * 1000 + "é中😀" * 300]
    model = quality.Model(bad, good, (2.0, 0.5), -0.25)
    got = model.features()(text_column(pa.array(texts)))
    for text, (difference, shortness) in zip(texts, got):
        data, sizes = (text or "").encode(), []
        for dictionary in (bad, good):
            own = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            own.precompute_compress(level=1)
            compressor = zstandard.ZstdCompressor(level=1, dict_data=own, write_content_size=False, write_dict_id=False)
            sizes.append(sum(len(compressor.compress(data[k : k + 512])) for k in range(0, len(data), 512)))
        assert difference == ((sizes[0] - sizes[1]) / len(data) if data else 0)
        assert shortness == 512 / (512 + len(data))
    assert got[3, 0] < 0 < got[4, 0]
    want = 1 / (1 + np.exp(-(got @ [2.0, 0.5] - 0.25)))
    assert model.scorer()(text_column(pa.array(texts))) == pytest.approx(want)


def test_quality_of_odd_rows(odd, none, shared, labelled):
    model = quality.train(*labelled)
    got = quality.score(odd, model)
    assert got.count() == odd.count() and got.where("score IS NULL OR score < 0 OR score > 1").isEmpty()
    empty = {r["score"] for r in got.where("doc_id IN (1, 2)").collect()}
    assert len(empty) == 1
    kept = quality.keep_good(odd, model, 0.0)
    assert kept.columns == odd.columns and rows(kept) == rows(odd)
    assert quality.score(none, model).count() == quality.keep_good(none, model).count() == 0
    schema = "doc_id long, quality int"
    nothing = quality.train(odd, shared.createDataFrame([(None, 1), (4, None)], schema))
    assert {r["score"] for r in quality.score(odd, nothing).collect()} == {0.5}
    one_kind = quality.train(odd, shared.createDataFrame([(k, 1) for k in range(14)], schema))
    assert quality.score(odd, one_kind).where("score < 0.99").isEmpty()
    few = quality.train(odd, shared.createDataFrame([(k, k % 2) for k in range(14)] + [(4, 1), (4, 0)], schema))
    assert quality.score(odd, few).where("score < 0 OR score > 1").isEmpty()
    assert quality.train(none, shared.createDataFrame([(1, 1)], schema)).intercept == 0
