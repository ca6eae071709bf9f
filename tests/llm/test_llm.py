"""Every operator against a plain brute-force version, and its defined results."""

import base64
import collections
import contextlib
import hashlib
import os
import re
import time
import zlib

import numpy as np
import oracle
import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from trackledger import session
from trackledger.llm import (
    bpe, catalog, exact_dedup, fingerprints, lm, mixing, near_dups, token_files, toxicity, warc, words,
)
from trackledger.session import scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def texts(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", ["op6_exact_dedup", "op8_ngram_jaccard", "op9_warc"])
def test_query_matches_sql(shared, sf_dir, name):
    query = catalog.QUERIES[name]
    assert oracle.compare(query.run(shared, sf_dir), oracle.connect(sf_dir), query.sql) is None


def test_pretokens_are_the_patterns_matches():
    pattern, found = regex.compile(public_tokenizers.PATTERN), []
    signs = "'stmrevldx 1²\n　 \u0085é中😀!Á\x1c"
    draw = np.random.default_rng(1)
    cases = ["".join(draw.choice(list(signs), n)) for n in draw.integers(0, 14, 5000)]
    cut, first = words.pretokens(words.text_column(__import__("pyarrow").array(cases)))
    found = [w.decode() for w in cut.to_pylist()]
    assert [found[a:b] for a, b in zip(first, first[1:])] == [pattern.findall(c) for c in cases]


def _encoding():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return path, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_is_the_librarys(odd, none):
    path, encoding = _encoding()
    encoded = bpe.encode_ids(odd, path)
    assert rows(encoded) == sorted(((i, encoding.encode_ordinary(t)) for i, t in texts(odd)), key=repr)
    assert rows(bpe.decode(encoded, path)) == sorted(texts(odd), key=repr)
    # The same when a task forgets its words with every chunk, and when none are folded before.
    forgetful = bpe.encode(odd.coalesce(1), path, bpe._id_rows, "doc_id long, ids array<int>", remembered=0, first=0)
    assert rows(forgetful) == rows(encoded)
    assert bpe.digests(none).count() == 0


def test_token_files_are_in_order_and_random_access(odd, none, shared):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    manifest = token_files.write_sequences(odd, scratch_path(shared, "t"), path, 2, 64)
    want, start, all_ids = [], 0, []
    for i, t in sorted(texts(odd), key=lambda x: (x[0] is not None, x[0] or 0, x[1])):
        ids = tokenizer.encode(t, add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start, all_ids = start + len(ids), all_ids + ids
    assert rows(token_files.read_documents(manifest)) == sorted(want, key=repr)
    for file in manifest.collect():
        ids, mask = token_files.SequenceReader(file["sequences"]).sequence(0)
        assert len(ids) == len(mask) == 64 and ids[mask].tolist() == all_ids[file["first"] :][: mask.sum()]
    empty = token_files.write_sequences(none, scratch_path(shared, "t"), path, 2)
    assert token_files.read_documents(empty).count() == 0


def test_token_files_know_added_tokens():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    cases = ["plain text", "a<|endoftext|>b", "", "é <|endoftext|><|endoftext|> x", "end"]
    ids, counts = token_files.word_encoder(path)(words.text_column(__import__("pyarrow").array(cases)))
    want = [library.encode(t, add_special_tokens=False).ids for t in cases]
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want


def test_exact_duplicates_keep_the_largest_id(odd, none):
    groups = collections.defaultdict(list)
    for i, t in texts(odd):
        groups[t].append(i)
    want = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    assert rows(exact_dedup.duplicates(odd)) == sorted(want, key=repr)
    kept = exact_dedup.drop_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(t for _, t in texts(kept)) == sorted(groups)
    assert exact_dedup.drop_duplicates(none).count() == exact_dedup.duplicates(none).count() == 0


def _sets(docs):
    found = {}
    for i, t in docs:
        own = WORD.findall(t.translate(LOWER))
        few = {tuple(own)} if own else set()
        found[i] = {tuple(own[k : k + 5]) for k in range(len(own) - 4)} if len(own) >= 5 else few
    return found


def _components(sets):
    parent = {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            shared = len(sets[a] & sets[b])
            if a < b and shared and 100 * shared >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((top(a), top(b)))
                parent[high] = low
    return {i: top(i) for i in sets}


def test_near_duplicates_are_all_components(shared, odd, none, sf_dir):
    for docs in (odd, shared.read.parquet(f"{sf_dir}/documents.parquet")):
        sets = _sets([x for x in texts(docs) if x[0] is not None])
        top = _components(sets)
        found = near_dups.documents(docs).where("doc_id IS NOT NULL").distinct()
        assert rows(found) == sorted(((i, len(sets[i]), top[i]) for i in sets), key=repr)
        kept = near_dups.keep_one(docs)
        assert kept.columns == docs.columns
        assert {i for i, _ in texts(kept)} - {None} == set(top.values())
    assert near_dups.documents(none).count() == 0


def test_chain_of_near_copies_is_one_component(shared):
    """The ends of a chain don't link, its neighbours do; a hub does not reach all."""
    base = [f"w{k}" for k in range(120)]
    docs = [(100 + n, " ".join([f"new{n}x{k}" if k < 4 * n else w for k, w in enumerate(base)])) for n in range(12)]
    docs += [(n, " ".join(f"{n}z{k}" for k in range(50))) for n in range(5)]
    frame = shared.createDataFrame(docs, "doc_id long, text string")
    top = _components(_sets(docs))
    assert len({top[i] for i in top if i >= 100}) < 12
    assert dict(near_dups.documents(frame).select("doc_id", "component_id").collect()) == top


def test_mix_meets_targets(shared, odd, none, sf_dir):
    for docs in (odd, shared.read.parquet(f"{sf_dir}/documents.parquet")):
        mixed = mixing.mix_by_source(docs)
        found = mixed.collect()
        sizes = collections.Counter((i, len(WORD.findall(t))) for i, t in texts(docs))
        assert collections.Counter((r["doc_id"], r["size"]) for r in found) == sizes
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in found)
        taken = collections.Counter()
        for r in found:
            taken[r["source_size"], r["target"]] += r["taken"]
        for (size, target), words_taken in taken.items():
            alike = sum(len(s) for s in [{r["doc_id"] for r in found if r["target"] == target}]) and 1
            assert target <= 2 * size and (words_taken + 1 >= target * alike)
        assert rows(mixing.mix_by_source(docs)) == rows(mixed)
    assert mixing.mix_by_source(none).count() == 0
    assert mixing.draw_by_source(odd).columns == odd.columns


def test_flow_repeats_evenly_and_serves_overlaps():
    # Source 1 can only be served by the shared pattern, so source 0 takes its own.
    assert mixing.route([([0], 10), ([0, 1], 10)], [10, 10], 2) == [[10, 0], [10, 0]]
    assert mixing.route([([0], 10), ([0, 1], 10)], [30, 0], 2) in ([[10, 5], [10, 5]], [[10, 10], [10, 0]], [[10, 0], [10, 10]])
    assert mixing.targets([10, 100, 0], [3, 1, 2], 165, 2) == [20.0, 145.0, 0.0]


def test_toxic_documents_are_found(shared, none, sf_dir):
    wide = sf_dir.replace("sf0.001", "sf0.01")
    scored = toxicity.query(shared, wide)
    labelled = scored.join(shared.read.parquet(f"{wide}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["toxic"] for r in labelled) >= 0.95 * len(labelled)
    assert scored.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    docs = shared.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    model = toxicity.train(docs, shared.createDataFrame([(1, None), (2, 0)], "doc_id long, toxic int"))
    assert [r["score"] < 0.5 for r in toxicity.score(docs, model).collect()] == [True, True]
    assert toxicity.reject(none, model).columns == none.columns


def test_toxicity_takes_one_row_of_a_labelled_id(shared):
    docs = [(i, f"{'vile nasty' if i % 2 else 'kind nice'} word{i % 7} text") for i in range(60)]
    labels = shared.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    copies = [(i, "a vile nasty row") for i in (2, 4, 6, 8) for _ in range(40)]  # smaller than the ids' own texts
    one, two = (toxicity.train(shared.createDataFrame(d, "doc_id long, text string"), labels) for d in (docs, docs + copies))
    assert all(np.array_equal(a, b) for a, b in zip(vars(one).values(), vars(two).values()))
    assert len(one.slots)


def test_language_model_counts_and_beats_unigrams(shared, odd, none, sf_dir):
    for docs in (odd.where("doc_id IS NOT NULL"), shared.read.parquet(f"{sf_dir}/documents.parquet")):
        found = lm.score(*lm.fit(docs)).collect()
        cut = [(i, [*WORD.findall(t.translate(LOWER)), None]) for i, t in texts(docs)]
        counts = collections.Counter(t for i, own in cut if zlib.crc32(str(i).encode()) % 5 != 1 for t in own)
        total, known = sum(counts.values()), len(counts)
        want = sorted((i, len(own), sum(counts[t] > 0 for t in own), total) for i, own in cut)
        assert sorted((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in found) == want
        base = {i: sum(np.log10((counts[t] + 0.5) / (total + 0.5 * (known + 1))) for t in own) for i, own in cut}
        assert all(abs(r["base_score"] - base[r["doc_id"]]) < 1e-6 * max(1, r["n_tokens"]) for r in found)
        assert all(r["score"] <= 0 for r in found)
    assert sum(r["score"] for r in found) > sum(r["base_score"] for r in found)
    assert lm.score(*lm.fit(none)).count() == 0


def test_language_model_tells_words_of_a_class_apart_by_context(shared, monkeypatch):
    """Words of one class share no context; features are not folded, whatever the number of buckets."""
    # Held-out texts: those whose crc32 falls into the fold.
    ids = [i for i in range(9000) if zlib.crc32(str(i).encode()) % 5 != 1]
    other = [i for i in range(9000) if zlib.crc32(str(i).encode()) % 5 == 1]
    docs = [(i, f"before{k % 500:03} behind{k % 500:03}") for k, i in enumerate(ids[:5000])]
    seen, changed = [(i, k, k) for k, i in enumerate(other[:400])], [(i, k, k + 1) for k, i in enumerate(other[400:800])]
    docs += [(i, f"before{a:03} behind{b:03}") for i, a, b in seen + changed]
    docs.append((ids[5000], " ".join(f"c{k % lm.FREQUENT}" for k in range(2400))))  # classes of their own
    docs.append((other[800], " ".join(f"w{k % 1000}" for k in range(lm.PART + 5))))  # a text of two parts
    frame = shared.createDataFrame(docs, "doc_id long, text string")
    found = []
    for size in (lm.BUCKET, 1 << 12):
        monkeypatch.setattr(lm, "BUCKET", size)
        found.append({r["doc_id"]: r for r in lm.score(*lm.fit(frame)).collect()})
    one, two = found
    assert len(one) == len(docs) and one[other[800]]["n_tokens"] == lm.PART + 6
    assert all(abs(one[i]["score"] - two[i]["score"]) < 1e-4 * one[i]["n_tokens"] for i in one)
    assert all(one[i]["score"] > one[j]["score"] + 0.5 for (i, *_), (j, *_) in zip(seen, changed))


def test_language_model_packs_its_messages(shared, sf_dir):
    draw = np.random.default_rng(4)
    for values in (draw.integers(0, 1 << 63, 999).astype("<u8"), np.ones(50, "<i4"), draw.random(7).astype("<f4"), np.zeros(0, "u1")):
        assert (lm._unpacked(lm._packed(values), values.dtype.str) == values).all()
    hashes = np.unique(draw.integers(0, 1 << 64, 5000, dtype=np.uint64))
    assert (np.cumsum(lm._gaps(hashes), dtype=np.uint64) == hashes).all()
    _, parts, replies = lm.fit(shared.read.parquet(f"{sf_dir}/documents.parquet"))
    size = replies.select(*[F.sum(F.octet_length(c)).alias(c) for c in ("n", "classes")]).first()
    assert size["n"] < 3 * size["classes"]  # eight bytes a number if plain, and one


def test_language_model_sends_one_message_for_all_parts_of_a_unit(shared, monkeypatch):
    draw = np.random.default_rng(5)
    monkeypatch.setattr(lm, "PART", 700)
    at, target = draw.integers(0, 300, (lm.KINDS, 2000)) ** 2 // 300, draw.integers(0, lm.CLASSES, 2000)
    training = draw.random(2000) < 0.8
    model = lm.Model((), np.full(lm.CLASSES, 9.0), np.ones(lm.CLASSES), 90, 9)
    found = lm._learned(model, at, target, training, 300)
    n, weights, seen = collections.Counter(), collections.Counter(), collections.Counter()
    for a in range(0, 2000, 700):
        own, wanted = at[:, a : a + 700][:, training[a : a + 700]], target[a : a + 700][training[a : a + 700]]
        entries, m = np.unique(own * lm.CLASSES + wanted, return_counts=True)
        lists = lm.Lists(
            lm._first(np.bincount(entries // lm.CLASSES, minlength=300)), (entries % lm.CLASSES).astype("u1"), m, np.zeros(len(m), "<f4")
        )
        lm._steps(lists, own, wanted, model.prior())
        of_part = collections.Counter(own.ravel().tolist())
        for e, k, w in zip(entries.tolist(), m.tolist(), lists.weights.tolist()):
            n[e] += k
            weights[e] += w * of_part[e // lm.CLASSES]
        seen.update(of_part)
    owner = np.repeat(np.arange(300), np.diff(found.first))
    entries = (owner * lm.CLASSES + found.classes).tolist()
    assert entries == sorted(n) and found.n.tolist() == [n[e] for e in entries]
    assert np.allclose(found.weights, [weights[e] / seen[e // lm.CLASSES] for e in entries], atol=1e-5)

    words = " ".join(f"w{k % 900}" for k in range(9 * (1 << 16)))  # of nine parts
    frame = shared.createDataFrame([(3, words)], "doc_id long, text string")
    _, units, replies = lm.fit(frame)
    assert units.count() == 2 and replies.select("chunk", "unit").distinct().count() == 2


def test_language_model_finds_distinct_hashes_by_one_sort():
    draw = np.random.default_rng(6)
    hashes = draw.integers(0, 1 << 64, 3000, dtype=np.uint64)
    cases = [
        hashes[draw.integers(0, 3000, 9000)], np.append(hashes, hashes[:9] ^ np.uint64(1)), np.zeros(0, np.uint64),
        draw.integers(0, 700, 5000), np.array([5], np.uint64), np.full(4, (1 << 64) - 1, np.uint64), np.arange(1 << 12)[::-1].astype(np.uint64),
        np.arange((1 << 64) - 4096, 1 << 64, dtype=object).astype(np.uint64)[::-1].copy(),
    ]
    for values in cases:
        own, at = lm._unique(values)
        want, place = np.unique(values, return_inverse=True)
        assert own.dtype == values.dtype and (own == want).all() and (at == place).all() and len(own) == len(want)


def test_language_model_answers_common_features_once(shared, sf_dir, monkeypatch):
    """One list for all units, or one for each: the scores are the same, and so they are whatever the number of rounds."""
    docs = shared.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    frame = session.materialize(docs.repartitionByRange(12, "doc_id"))  # a unit for each file at least
    found, sizes = [], []
    for least, rounds in ((2, 4), (1000, 1)):
        monkeypatch.setattr(lm, "LEAST", least)
        monkeypatch.setattr(lm, "ROUNDS", rounds)
        model, units, replies = lm.fit(frame)
        assert units.count() > 3 and replies.where("chunk < 0").isEmpty()
        named, lists = model.common.value
        assert (np.diff(named.astype(object)) > 0).all() and len(lists.first) == len(named) + 1
        sizes.append((len(named), replies.agg(F.sum(F.octet_length("weights"))).first()[0]))
        found.append(sorted((r["doc_id"], r["n_tokens"], r["score"]) for r in lm.score(model, units, replies).collect()))
    assert sizes[0][0] > 100 and sizes[1][0] == 0 and sizes[0][1] < sizes[1][1]
    assert all(a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-6 * a[1] for a, b in zip(*found)) and len(found[0]) == len(found[1])


def test_language_model_leaves_only_scores(shared, sf_dir):
    root = session._scratch(shared).removeprefix("file:")

    def tables():
        return {f"{where}/{d}" for where, folders, _ in os.walk(root) for d in folders if not d.startswith("_")}

    before = tables()
    scores = catalog.QUERIES["op4_lm_scoring"].run(shared, sf_dir)
    left = [shared.read.parquet(f"file://{path}").columns for path in tables() - before]
    assert left == [[f.split()[0] for f in lm.UNIT_SCORES.split(", ")]] * lm.ROUNDS and scores.count() > 0


def test_shuffle_files_go_with_their_query(shared):
    manager = shared.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def left(free):
        before = {str(f) for f in str(manager.getAllFiles().mkString("|")).split("|")}
        with session.shuffles_go(shared) if free else contextlib.nullcontext():
            rows = session.materialize(shared.range(50_000).groupBy((F.col("id") % 999).alias("k")).count())
        for _ in range(50):
            new = [f for f in str(manager.getAllFiles().mkString("|")).split("|") if f not in before and "shuffle_" in f]
            if not new or not free:
                break
            time.sleep(0.2)
        assert rows.count() == 999
        return len(new)

    assert left(False) > 0 and left(True) == 0


def test_fingerprints(odd, none):
    found = fingerprints.fingerprint_with_next(odd).collect()
    order = sorted(texts(odd), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    want = []
    for (i, t), (_, following) in zip(order, order[1:] + order[:1]):
        changed = t[: len(t) - len(t) // 2] + following[: len(t) // 2]
        want.append((i, len(t), hashlib.sha256(changed.encode()).hexdigest()))
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found), key=repr) == sorted(want, key=repr)
    one, two = fingerprints.sketches(["alpha beta " * 30 + "x", "alpha beta " * 30 + "x"])
    assert (one == two).all() and fingerprints.likeness(one, two) == 1
    assert fingerprints.fingerprint_with_next(none).count() == 0


def test_equal_substrings_share_their_phrases():
    draw = np.random.default_rng(2)
    middle = "".join(draw.choice(list("abcdefgh "), 2000))
    for shift in (0, 1, 7, 100):
        parts = ["q" * 0 + "".join(draw.choice(list("xyz"), shift)) + middle, middle + " tail"]
        owner, name = fingerprints.phrases(parts)
        one, two = set(name[owner == 0].tolist()), set(name[owner == 1].tolist())
        assert len(one & two) > 0.6 * len(two)


def test_warc_survives_splits_and_edge_cases(shared):
    pages = [(1, "u", "same"), (2, None, "same"), (3, "v", None), (4, "w", ""), (5, "x", "é" * 50_000), (6, "y", "\x1f\x08 gz")]
    frame = shared.createDataFrame(pages, "page_id long, url string, html string").withColumn("path", F.lit("own"))
    for split in (64, 1000, 1 << 20):
        files = warc.write_archives(frame, scratch_path(shared, "warc"), file_bytes=500)
        found = {r["page_id"]: tuple(r)[1:] for r in warc.read_records(files, split).collect()}
        for i, _, html in pages:
            payload = (html or "").encode()
            refers = {1: 2, 3: 4}.get(i)
            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            assert found[i] == (len(payload), digest, "revisit" if refers else "response", refers)
    files = warc.write_archives(frame, scratch_path(shared, "warc"), revisit_from=1)
    assert warc.read_records(files).where("record_type = 'revisit'").count() == 1
    empty = warc.write_archives(frame.limit(0), scratch_path(shared, "warc"))
    assert warc.read_records(empty).count() == 0


def test_pipeline_is_its_stages_by_brute_force(shared, sf_dir):
    docs = shared.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.train(docs, shared.read.parquet(f"{sf_dir}/labels.parquet"))
    toxic = {r["doc_id"] for r in toxicity.score(docs, model).where("score >= 0.5").collect()}
    clean = [x for x in texts(docs) if x[0] not in toxic]
    last = {t: i for i, t in sorted(clean)}
    single = [(i, t) for t, i in last.items()]
    top = _components(_sets(single))
    kept = {i: t for i, t in single if top[i] == i}
    found = collections.Counter(r["doc_id"] for r in corpus_pipeline.run(shared, sf_dir).select("doc_id").collect())
    stay = docs.where(F.col("doc_id").isin(list(kept)))
    times = {r["doc_id"]: int(r["taken"] / r["size"] + 0.5) for r in mixing.mix_by_source(stay).collect() if r["size"]}
    assert found == collections.Counter({i: n for i, n in times.items() if n})


def test_rank_tables_are_made_when_they_are_used():
    table = bpe.Ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    assert not {"slots", "ids", "pieces", "decimals"} & set(vars(table))
    assert b"".join(table.pieces[k] for k in table.merged(b"wordless " * 40)) == b"wordless " * 40
    assert "slots" in vars(table) and "decimals" not in vars(table)


def test_the_rank_map_is_no_part_of_a_plan(odd):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.digests(odd, path, first=0)
    plan = encoded._jdf.queryExecution().optimizedPlan()
    assert len(plan.toJSON()) < 1_000_000


def test_variants_meet_through_the_text_they_come_from(shared, monkeypatch):
    # Each variant links with the base, which has the largest id, and with no other variant.
    base = [f"w{k}" for k in range(200)]
    docs = [(1000, " ".join(base))]
    for v in range(60):
        own = list(base)
        for k in range(5):
            own[(v * 7 + k * 37 + 5) % 190 + 5] = f"own{v}x{k}"
        docs.append((v + 1, " ".join(own)))
    made, crossing = [], near_dups._crossing
    monkeypatch.setattr(near_dups, "_crossing", lambda open_: made.append(crossing(open_)) or made[-1])
    frame = shared.createDataFrame(docs, "doc_id long, text string")
    assert [r["doc_id"] for r in near_dups.keep_one(frame).collect()] == [1]
    assert sum(pairs.count() for pairs in made) <= len(docs)
