"""Operator 8: n-gram Jaccard join by rare-first prefix filtering.

A document's set is its distinct shingles of ``SHINGLE`` words, as 64-bit
hashes. All sets are sorted by one order, rare shingles first: by the number
of documents in the shingle's slot of a table of 2^18 counts over the whole
corpus, then by hash. Two sets with a Jaccard similarity of ``PERCENT`` or more
share a shingle among their first ``n - ceil(PERCENT n / 100) + 1``, so only
these prefixes are shuffled, by shingle.

Texts with the same set are one class, of which one stands for all. Pairs within
the documents of a shingle are made in two rounds:

1. every document is paired with the smallest one; filters by length, position
   and suffix (a histogram of the whole set) drop pairs that can't reach the
   overlap, each pair left is checked once against whole texts, and links are
   gathered into components;
2. documents that still share shingles across components look for partners of
   each band of sizes, but only under their rarest shingles: two sets of about
   a size link only if their prefixes share many shingles, so all but the most
   frequent ones of that number find every partner (``_crossing``). The shingles
   that two prefixes share bound the overlap; then pairs are filtered and checked
   as before.

Every pair that could link is then either checked or inside one component, so
the components are exact. No step caps a shingle's documents. Texts are
fetched for the pairs only, by a Bloom filter over their ids.

Defined results: a null or empty text, or one of white space, has no set and is
linked with nothing; a shorter text than a shingle is one shingle; of rows that
share a ``doc_id`` each is returned with its own size, they are in one
component, and where their texts differ pairs are checked on the text that is
last in order; rows without ``doc_id`` are returned with a null component; an
empty table gives no rows. Other columns
are not read and pass through ``keep_one``.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackledger.llm.bloom import members, tested, with_ids, without_ids, words_for
from trackledger.llm.components import components
from trackledger.llm.words import distinct, release, slices, text_column, tokens
from trackledger.session import materialize, passing

SHINGLE = 5
PERCENT = 75
SLOT_BITS = 18
BUCKETS = 256
BANDS = 12  # of sizes, between a size and the largest that can link with it
CHUNK = 1 << 18  # bytes of text that a worker holds as numbers at once
_ODD = 0x9E3779B97F4A7C15
_BASE = np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(_ODD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


@functools.lru_cache(maxsize=1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, for 2^bits places."""
    found = []
    for base in (int(_BASE), pow(int(_BASE), -1, 1 << 64)):
        power = np.ones(1, dtype=np.uint64)
        for k in range(bits):
            power = np.concatenate([power, power * np.uint64(pow(base, 1 << k, 1 << 64))])
        found.append(power)
    return found[0], found[1]


def _word_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word's bytes: a polynomial from sums over all bytes, mixed."""
    power, inverse = _powers(max(18, int(len(data)).bit_length()))
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_mix(np.arange(1, 257, dtype=np.uint64))[data] * power[: len(data)], out=total[1:])
    return _mix((total[ends] - total[begins]) * inverse[begins] + (ends - begins).astype(np.uint64))


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    data, begins, ends, first = tokens(texts)
    if not len(begins):
        return [np.zeros(0, np.uint64)] * len(texts)
    word = _word_hashes(data, begins, ends)
    weight = [_mix(np.array([k + 1], dtype=np.uint64))[0] | np.uint64(1) for k in range(SHINGLE)]
    count = max(0, len(word) - SHINGLE + 1)
    total = np.zeros(count, dtype=np.uint64)
    for k in range(SHINGLE):
        total += word[k : k + count] * weight[k]
    shingle = _mix(total)
    sets = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= SHINGLE:
            sets.append(distinct(shingle[a : b - SHINGLE + 1]))
        elif b > a:
            parts = word[a:b] * np.array(weight[: b - a]) + np.uint64(b - a)
            sets.append(_mix(parts.sum(keepdims=True, dtype=np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _count_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << SLOT_BITS, dtype=np.int64)
    for batch in batches:
        for part in slices(batch, "text", CHUNK):
            sets = shingle_sets(text_column(part.column(0)))
            counts += np.bincount(_slots(np.concatenate(sets)), minlength=1 << SLOT_BITS)
    if counts.any():
        block = 1 << 9
        rows = counts.reshape(-1, block)
        offsets = pa.array(np.arange(len(rows) + 1) * block, pa.int32())
        yield pa.record_batch(
            [pa.array(np.arange(len(rows)), pa.int32()), pa.ListArray.from_arrays(offsets, pa.array(counts))],
            names=["block", "counts"],
        )
    release()


def slot_counts(docs: DataFrame) -> np.ndarray:
    """Documents per slot of shingles over all ``docs``: 2^18 numbers, whatever the input."""
    parts = docs.select("text").mapInArrow(_count_slots, "block int, counts array<long>")
    added = parts.select("block", F.posexplode("counts").alias("at", "n")).groupBy("block", "at").agg(F.sum("n").alias("n"))
    rows = added.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("at", "n"))).alias("rows")).select("block", "rows.n").collect()
    counts = np.zeros((1 << SLOT_BITS - 9, 1 << 9), dtype=np.int64)
    for row in rows:
        counts[row["block"]] = row["n"]
    return counts.ravel()


def _rarity(counts: np.ndarray) -> np.ndarray:
    """Order of slots as small numbers: equal for counts within a twentieth of each other."""
    return np.minimum(np.log1p(counts) * 14, 255).astype(np.uint8)


def _prefixes(rarity: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", CHUNK):
                sets = shingle_sets(text_column(part.column(1)))
                sizes, digests, prefixes, histograms = [], [], [], []
                for own in sets:
                    n = len(own)
                    sizes.append(n)
                    digest = np.array([own.sum(dtype=np.uint64), _mix(own).sum(dtype=np.uint64), n], dtype=np.uint64)
                    digests.append(digest.tobytes())
                    keep = n - -(-PERCENT * n // 100) + 1 if n else 0
                    rare = rarity[_slots(own)]
                    prefixes.append(own[np.argsort(rare, kind="stable")[:keep]].view(np.int64))
                    cells = np.bincount((own & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
                    histograms.append(np.minimum(cells, 0xFFFF).astype("<u2").tobytes())
                ends = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])])
                yield pa.record_batch(
                    [
                        part.column(0),
                        pa.array(sizes, pa.int64()),
                        pa.array(digests, pa.binary()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(prefixes))),
                        pa.array(histograms, pa.binary()),
                    ],
                    names=["doc_id", "n", "digest", "prefix", "histogram"],
                )
        release()

    return rows


def _can_link(na: Column, pa_: Column, nb: Column, pb: Column) -> Column:
    """Length and positional filter for a shingle at places ``pa_``, ``pb`` of the sets."""
    length = 100 * F.least(na, nb) >= PERCENT * F.greatest(na, nb)
    overlap = F.least(pa_, pb) + 1 + F.least(na - pa_ - 1, nb - pb - 1)
    return length & ((100 + PERCENT) * overlap >= PERCENT * (na + nb))


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text_b", CHUNK):
            heads = part.column(2).dictionary_encode()  # a text that many pairs share is cut once
            left = shingle_sets(text_column(heads.dictionary))
            right = shingle_sets(text_column(part.column(3)))
            linked = []
            for k, own in zip(heads.indices.to_pylist(), right):
                other = left[k]
                both = np.sort(np.concatenate([other, own]))
                shared = int((both[1:] == both[:-1]).sum())
                linked.append(shared > 0 and 100 * shared >= PERCENT * (len(other) + len(own) - shared))
            yield part.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))
    release()


def _suffix_filter(pairs: DataFrame, sets: DataFrame, folder: str) -> DataFrame:
    """Pairs whose histograms allow the overlap: no more than the smaller count per bucket."""
    ids = materialize(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), folder)
    own = materialize(with_ids(sets.select("doc_id", "n", "histogram"), ids), folder)
    one = own.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("histogram").alias("ha"))
    two = own.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("histogram").alias("hb"))

    @F.pandas_udf("long")
    def bound(ha, hb):
        tables = (np.frombuffer(b"".join(h), "<u2").reshape(-1, BUCKETS) for h in (ha, hb))
        return type(ha)(np.minimum(*tables).sum(axis=1, dtype=np.int64))

    joined = pairs.join(two, "b").join(one, "a")
    return joined.where((100 + PERCENT) * bound("ha", "hb") >= PERCENT * (F.col("na") + F.col("nb"))).select("a", "b").distinct()


def verified(pairs: DataFrame, docs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that link, each checked once against whole texts."""
    with passing(docs.sparkSession) as folder:
        pairs = materialize(_suffix_filter(pairs, sets, folder), folder)
        ids = materialize(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), folder)
        texts = with_ids(docs, ids).join(ids, F.col("doc_id") == F.col("id")).groupBy("id").agg(F.max("text").alias("text"))
        texts = materialize(texts, folder)
        whole = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
        whole = whole.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
        return materialize(whole.select("a", "b", "text_a", "text_b").mapInArrow(_verify, "a long, b long"))


def _size(place: str) -> Column:
    return F.shiftright(place, 32)


def _at(place: str) -> Column:
    return F.col(place).bitwiseAND(F.lit((1 << 32) - 1))


def _needed(one: Column, two: Column) -> Column:
    """So many shingles, less one for rounding, two prefixes share at least if sets of these sizes link."""
    overlap = (one + two) * PERCENT / (100 + PERCENT)
    return F.greatest(F.lit(1), F.ceil(overlap - F.ceil(F.greatest(one, two) * PERCENT / 100)))


def _can_share(shared: Column, na: Column, nb: Column) -> Column:
    """Whether sets can link whose prefixes share no more than ``shared``: that number and the longer suffix bound the overlap."""
    overlap = shared + F.ceil(PERCENT * F.greatest(na, nb) / 100) - 1
    return (100 + PERCENT) * overlap >= PERCENT * (na + nb)


def _open(postings: DataFrame, found: DataFrame) -> DataFrame:
    """Postings (shingle, doc_id, place, part) of shingles that are held in several components."""
    placed = postings.select("shingle", "doc_id", "place").join(found, F.col("doc_id") == F.col("id"), "left")
    placed = placed.select("shingle", "doc_id", "place", F.coalesce("component", "doc_id").alias("part"))
    group = Window.partitionBy("shingle")
    several = placed.select("*", F.min("part").over(group).alias("low"), F.max("part").over(group).alias("high"))
    return several.where("low <> high").drop("low", "high")


def _middles(open_: DataFrame) -> DataFrame:
    """Pairs (a, b) of each open shingle's foremost document and those of other components that may link with it.

    A text that others were made from has none of their own rare words before the
    words that they share, so it has these foremost.
    """
    foremost = F.min(F.struct(_at("place").alias("at"), "doc_id", "place", "part")).over(Window.partitionBy("shingle"))
    pairs = open_.select("doc_id", "place", "part", foremost.alias("hub"))
    pairs = pairs.select("*", F.col("hub.place").alias("hub_place")).where(
        (F.col("part") != F.col("hub.part"))
        & _can_link(_size("hub_place"), _at("hub_place"), _size("place"), _at("place"))
    )
    return pairs.select(F.col("hub.doc_id").alias("a"), F.col("doc_id").alias("b")).distinct()


def _crossing(open_: DataFrame) -> DataFrame:
    """Pairs (a, b) of documents of different components (shingle, doc_id, place, part) that may link.

    Two prefixes share several shingles if their sets link, the more the closer
    their sizes are. So a document looks for partners of a band of sizes, in
    components of smaller numbers, under its rarest shingles only: of k that such
    documents have, too, and of which it must share n or more, under all but the
    n - 1 most frequent ones. That n is the least of the band; where two meet, their
    own sizes say it again: under the first shingle that they share, no more are left
    for them than this one and those behind it.
    """
    size = _size("place").cast("double")
    step = math.log(100 / PERCENT) / BANDS
    open_ = open_.withColumn("band", F.floor(F.log(size) / step))
    held = open_.groupBy("shingle", F.col("band").alias("other")).agg(F.count("*").alias("docs"), F.min("part").alias("least"))
    reach = BANDS + 1
    near = (F.col("other") - F.col("band")).between(-reach, reach) & (F.col("least") < F.col("part"))
    looking = open_.join(held, "shingle").where(near).select("shingle", "doc_id", "place", "part", "other", "docs")
    mine = Window.partitionBy("doc_id", "other")
    ranked = looking.select(
        "*", F.row_number().over(mine.orderBy("docs", "shingle")).alias("rank"), F.count("*").over(mine).alias("k")
    )
    ends = [F.exp(F.col("other") * step), F.exp((F.col("other") + 1) * step)]
    low, high = F.greatest(ends[0], size * PERCENT / 100), F.least(ends[1], size * 100 / PERCENT)
    needed = F.least(_needed(size, low), _needed(size, high))
    probes = ranked.where(F.col("rank") <= F.col("k") - needed + 1).withColumn("left", F.col("k") - F.col("rank") + 1)
    probes = probes.select(
        "shingle", F.col("other").alias("band"), "left", *[F.col(c).alias(f"{c}_1") for c in ("doc_id", "place", "part")]
    )
    pairs = open_.join(probes, ["shingle", "band"]).where(
        (F.col("part") < F.col("part_1"))
        & _can_link(_size("place"), _at("place"), _size("place_1"), _at("place_1"))
        & _can_share(F.col("left"), _size("place"), _size("place_1"))
    )
    ids = [F.least("doc_id", "doc_id_1").alias("a"), F.greatest("doc_id", "doc_id_1").alias("b")]
    return materialize(pairs.select(*ids).distinct())


def _enough_shared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose prefixes share enough."""
    with passing(pairs.sparkSession) as folder:
        ids = materialize(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), folder)
        own = materialize(with_ids(sets.select("doc_id", "n", "prefix"), ids), folder)
        one = own.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("prefix").alias("pa"))
        two = own.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("prefix").alias("pb"))
        both = pairs.join(two, "b").join(one, "a")
        kept = both.where(_can_share(F.size(F.array_intersect("pa", "pb")), F.col("na"), F.col("nb")))
        return materialize(kept.select("a", "b").distinct())


def linked(docs: DataFrame, foremost: bool = False) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles of every row; id, component of every linked id).

    ``foremost`` adds a round between the two (``_middles``): it shuffles more, and
    spares pairs where the smallest id of a group is not that of its source. The
    links found are the same.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rarity = _rarity(slot_counts(docs))
    schema = "doc_id long, n long, digest binary, prefix array<long>, histogram binary"
    sets = materialize(docs.mapInArrow(_prefixes(rarity), schema))
    known = sets.where("doc_id IS NOT NULL AND n > 0")
    classes = materialize(known.groupBy("digest").agg(F.min("doc_id").alias("rep")))
    others = known.select("digest", "doc_id").join(classes, "digest").where("doc_id <> rep")
    others = materialize(others.select("digest", "doc_id", "rep").distinct())
    # Rows of one id are one document: the classes of all its texts hang together.
    same = others.select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    # Representatives pass without a shuffle; the few that a filter can't tell are looked up.
    words = words_for(others.count())
    row = F.xxhash64("doc_id", "digest")
    ruled_out = members(others.select(row.alias("hash")), "hash", words)
    flagged = tested(known, row, ruled_out, words, "maybe")
    first = flagged.where("NOT maybe").unionByName(
        flagged.where("maybe").join(others.select("doc_id", "digest"), ["doc_id", "digest"], "left_anti").select(flagged.columns)
    )
    first = first.select("doc_id", "n", "prefix", "histogram")
    # Shingles in one prefix only meet nothing: a filter of the others spares moving their postings.
    several = first.select(F.explode("prefix").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("docs"))
    several = materialize(several.where("docs > 1").select(F.xxhash64("shingle").alias("hash")))
    words = words_for(several.count())
    # Place and size share a number: a posting is three numbers wide.
    postings = first.select(F.posexplode("prefix").alias("at", "shingle"), "doc_id", "n").select(
        "shingle", "doc_id", (F.shiftleft("n", 32) + F.col("at")).alias("place")
    )
    kept = tested(postings, F.xxhash64("shingle"), members(several, "hash", words), words, "maybe")
    postings = kept.where("maybe").drop("maybe")
    group = Window.partitionBy("shingle")
    hub = F.min(F.struct("doc_id", "place")).over(group)
    shared = postings.select("*", F.count("*").over(group).alias("docs"), hub.alias("hub")).where("docs > 1")
    shared = shared.select("shingle", "doc_id", "place", F.col("hub.doc_id").alias("hub"), F.col("hub.place").alias("hub_place"))
    with passing(docs.sparkSession) as later:
        with passing(docs.sparkSession) as folder:
            shared = materialize(shared, folder)
            stars = shared.where("doc_id <> hub").where(_can_link(_size("hub_place"), _at("hub_place"), _size("place"), _at("place")))
            stars = materialize(stars.select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct(), folder)
            links = same.unionByName(verified(stars, docs, first))
            found = components(links)

            # Later rounds: what one shingle still holds in several components.
            open_ = materialize(_open(shared, found), later)
        middle = verified(materialize(_middles(open_), later), docs, first) if foremost else None
        if foremost and not middle.isEmpty():
            links = links.unionByName(middle)
            found = components(links)
            open_ = materialize(_open(open_, found), later)
        more = verified(_enough_shared(_crossing(open_), first), docs, first)
    if not more.isEmpty():
        found = components(links.unionByName(more))
    return sets.select("doc_id", F.col("n").alias("n_shingles")), found


def documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text)."""
    sizes, found = linked(docs)
    return sizes.join(found, F.col("doc_id") == F.col("id"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with the document of the smallest id of each component; all columns stay."""
    _, found = linked(docs, foremost=True)
    return without_ids(docs, materialize(found.where("id <> component").select("id")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: near-duplicate component of every document."""
    return documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' '))) END AS s
  FROM words
),
shingles AS (SELECT doc_id, unnest(s) AS shingle FROM sets),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id
),
links AS (
  SELECT a, b FROM pairs JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
  WHERE 100 * common >= 75 * (len(x.s) + len(y.s) - common)
),
reached AS (
  SELECT doc_id, doc_id AS other FROM sets UNION SELECT r.doc_id, l.b AS other FROM reached r JOIN links l ON l.a = r.other
)
SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, min(other) AS component_id
FROM sets JOIN reached ON reached.doc_id = sets.doc_id GROUP BY sets.doc_id, s
"""
