"""Mixing against a plain apportionment, packing against round trips and bounds."""

import heapq
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cyclerlake.llm import mixing, packing
from cyclerlake.llm.common import landed

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, quota string, shard string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, "x", "y", "z") for i, t, s in rows], DOCS)


def plain_targets(sizes):
    """Water is poured until no source is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            return share | capped
        capped |= {s: 3 * sizes[s] for s in over}


SIZES = {"a": 100, "b": 5, "B": 40_000, "c": 900, "é": 700, "zz": 0, None: 300, "d": 12_000, "e": 3}


def test_targets(spark):
    frame = spark.createDataFrame(list(SIZES.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(frame).collect()}
    assert got == pytest.approx(plain_targets(SIZES))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 500), min_size=1, max_size=30), st.integers(0, 400))
def test_sainte_lague(spark, weights, seats):
    if not sum(weights):
        seats = 0
    frame = spark.createDataFrame([("g", i, float(w), seats) for i, w in enumerate(weights)], "g string, unit long, weight double, seats long")
    got = {r.unit: r.quota for r in mixing.sainte_lague(frame, ["g"], "unit", "weight", "seats").collect()}
    want = dict.fromkeys(range(len(weights)), 0)
    heap = [(-w, i) for i, w in enumerate(weights) if w]
    heapq.heapify(heap)
    for _ in range(seats):
        _, i = heapq.heappop(heap)
        want[i] += 1
        heapq.heappush(heap, (-weights[i] / (2 * want[i] + 1), i))
    assert got == want


def mix_rows():
    rng = random.Random(2)
    rows = [(i, " ".join("w" * rng.randint(1, 4) for _ in range(rng.randint(0, 60))), rng.choice(["a", "b", "c", None])) for i in range(400)]
    rows += [(400 + i, "only few", "small") for i in range(5)] + [(None, "no id here", "a"), (1, None, "b"), (1, "", "b")]
    rows += [(500 + i, "hot " * 30, "hot") for i in range(600)] + [(2000, "long " * 20_000, "c")] + [(3000, "same row", "a")] * 3
    return rows


@pytest.mark.parametrize("shard_words", [250_000, 700])
def test_mix(spark, shard_words):
    rows = mix_rows()
    docs = docs_of(spark, rows).repartition(3)
    taken = mixing.mix(docs, shard_words=shard_words).select("doc.doc_id", "doc.source", mixing.word_count("doc.text").alias("n"), "source_size", "target", "taken", F.struct("*")["size"].alias("size"))
    got = taken.collect()
    assert len(got) == len(rows)
    sizes, took = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.size == r.n and 0 <= r.taken <= 3 * r.size
        sizes[r.source] += r.size
        took[r.source] += r.taken
    targets = plain_targets(sizes)
    assert {r.source: r.source_size for r in got} == sizes
    assert {r.source: r.target for r in got} == pytest.approx(targets)
    for source, target in targets.items():
        assert abs(took[source] - target) <= 2 * mixing.BLOCK_WORDS
    again = mixing.mix(docs.repartition(7), shard_words=shard_words)
    assert Counter((r.doc.doc_id, r.taken) for r in again.collect()) == Counter((r.doc_id, r.taken) for r in got)


def test_mixed_documents(spark):
    docs = docs_of(spark, mix_rows())
    got = mixing.mixed(docs)
    assert got.columns == docs.columns
    counts = Counter(r.doc_id for r in got.where("source = 'small'").collect())
    assert counts == dict.fromkeys(range(400, 405), 3)
    assert got.where("text is null or text = ''").count() == 0


def test_mix_empty(spark):
    assert mixing.mix(docs_of(spark, [])).count() == 0
    nothing = mixing.mix(docs_of(spark, [(1, None, "a"), (2, " ", None)])).select("taken", "target").collect()
    assert [tuple(r) for r in nothing] == [(0, 0.0)] * 2


# -- packing ------------------------------------------------------------------------------------


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40) | st.text(alphabet="aB \n\t\r\x1c\x85 é's.1<|endoftext|>", max_size=40) | st.just("x <|endoftext|> y"))
def test_ids_are_those_of_the_file(text):
    encode = packing.encoder(PATH)
    assert np.frombuffer(encode(text), "<u4").tolist() == encode.slow.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["ab" * 3000, " " * 5000, "word " * 3000, "\n" * 2500 + "x", "é" * 2100])
def test_ids_of_long_stretches(text):
    encode = packing.encoder(PATH)
    assert np.frombuffer(encode(text), "<u4").tolist() == encode.slow.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300), max_size=25), st.integers(1, 8))
def test_plan_is_a_packing(counts, groups):
    runs = packing.plan(counts, capacity=64, groups=groups)
    placed, filled = Counter(), defaultdict(list)
    numbers = defaultdict(set)
    for length, number, sequence, offset, n in runs:
        placed[length] += n
        for i in range(n):
            assert number + i not in numbers[length]
            numbers[length].add(number + i)
            filled[sequence + i].append((offset, length))
    assert placed == counts
    assert all(numbers[x] == set(range(n)) for x, n in counts.items())
    assert sorted(filled) == list(range(len(filled)))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64


def test_plan_is_near_the_bound():
    rng = random.Random(4)
    counts = Counter(rng.randint(1, 1024) for _ in range(20_000))
    runs = packing.plan(counts)
    used = max(r[2] + r[4] for r in runs)
    assert used <= 1.02 * sum(k * v for k, v in counts.items()) / 1024
    # the plan does not grow with the number of documents
    assert len(packing.plan({k: v * 1000 for k, v in counts.items()})) < 3 * len(runs)


def pack_rows():
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "é", "1234", "."]) for _ in range(rng.randint(0, 900))), "s") for i in range(250)]
    rows += [(300, None, "s"), (301, "", "s"), (None, "no id", "s"), (5, "twice", "s"), (5, "twice", "s"), (302, "long text " * 30_000, "s")]
    return rows + [(400 + i, "hot", "s") for i in range(300)]


def test_pack_round_trip(spark):
    rows = pack_rows()
    pieces = landed(packing.token_pieces(docs_of(spark, rows).repartition(4), PATH, with_ids=True), "test-pieces")
    packed = packing.pack(pieces, bucket_rows=100)
    got = packed.collect()
    tokenizer = Tokenizer.from_file(PATH)
    want = Counter()
    for i, text, _ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        first = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[i, piece, a, tuple(ids[a:b])] += 1
    assert Counter((r.doc_id, r.piece, r.start, tuple(r.ids)) for r in got) == want
    filled = defaultdict(list)
    for r in got:
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        filled[r.sequence_id].append(r)
    for parts in filled.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert len(filled) <= 1.05 * sum(r.length for r in got) / 1024 + 1
    whole = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    assert {s: len(ids) for s, ids in whole.items()} == {s: sum(r.length for r in parts) for s, parts in filled.items()}
    for s, parts in filled.items():
        for r in parts:
            assert whole[s][r.offset : r.offset + r.length] == r.ids


def test_pack_empty(spark):
    assert packing.pack_documents(docs_of(spark, []), PATH).count() == 0
    assert [(r.length, r.offset) for r in packing.pack_documents(docs_of(spark, [(1, None, "s")]), PATH).collect()] == [(1, 0)]


def test_equal_pieces_fill_no_bucket(spark):
    # half of all pieces are one row
    pieces = spark.range(20_000).selectExpr("CASE WHEN id % 2 = 0 THEN 7 ELSE id END AS doc_id", "0 AS piece", "CASE WHEN id % 2 = 0 THEN 100L ELSE id % 1024 + 1 END AS length", "id % 2 * id AS ids_crc32")
    numbered = packing.count_within(pieces.withColumn(packing.ROW, F.monotonically_increasing_id()), 1000)
    rows = numbered.where("length = 100").select("number", packing.ROW).collect()
    assert sorted(r.number for r in rows) == list(range(len(rows)))
    buckets = Counter(r.b for r in spark.range(20_000).selectExpr(f"pmod(xxhash64(id), 20) AS b").collect())
    assert max(buckets.values()) < 1300
    packed = packing.pack(pieces, bucket_rows=1000).collect()
    filled = {}
    for r in packed:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in filled.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [a for a, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 1024


@pytest.mark.parametrize("hot", ["8", None])
def test_one_id_on_half_of_all_rows_fills_no_shard(spark, hot):
    some = f"'{hot}'" if hot else "CAST(NULL AS string)"
    rows = spark.range(24_000).selectExpr(f"CASE WHEN id % 2 = 0 THEN {some} ELSE CAST(id AS string) END AS id", "id % 9 AS size")
    spun = mixing.with_spin(rows.repartition(5), 7, 1000)
    counts = [r["count"] for r in spun.groupBy((F.col("spin") % 24).alias("shard")).count().collect()]
    assert sum(counts) == 24_000 and max(counts) < 1300
    plain = mixing.with_spin(rows.where("id % 2 = 1"), 7, 1000)
    assert plain.where(F.col("spin") != mixing.seeded(7, F.col("id"))).count() == 0


def test_mix_with_a_hot_id(spark):
    rows = spark.range(6000).selectExpr("CASE WHEN id % 2 = 0 THEN 7 ELSE id END AS doc_id", "concat_ws(' ', array_repeat('w', CAST(id % 5 AS int))) AS text", "CASE WHEN id % 3 = 0 THEN 'a' ELSE 'b' END AS source")
    got = mixing.mix(rows, shard_rows=500, shard_words=2000).collect()
    sizes, took, target = Counter(), Counter(), {}
    for r in got:
        sizes[r.doc.source] += r.size
        took[r.doc.source] += r.taken
        target[r.doc.source] = r.target
        assert 0 <= r.taken <= 3 * r.size
    assert len(got) == 6000
    for source, want in plain_targets(sizes).items():
        assert abs(target[source] - want) < 1e-6 and abs(took[source] - want) <= 16
