"""Neighbours, licence scans and toxicity."""

import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cyclerlake.llm import licences, neighbours, toxicity

# -- neighbours ---------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, id string, v string, score string"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, 0, "a", "b", "c") for i, v in rows], VECTORS)


def vector_rows():
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(30)]  # ties
    rows += [(340, None), (341, []), (342, [0.0] * 8), (343, [float("nan")] * 8), (344, [None] * 8), (345, [float("inf")] * 8), (None, rows[1][1])]
    rows += [(360, [1e30] * 8), (361, [1e-30] * 8), (380, [1.0, 2.0]), (381, [2.0, 1.0]), (382, [1.0] * 3), (40, rows[41][1]), (60, rows[60][1])]
    return rows


def plain_nearest(rows, best):
    ok = [(i, np.array(v, np.float32).astype(np.float64)) for i, v in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    out, seen = [], set()
    for q, x in ok:
        if q % 20 or (q, x.tobytes()) in seen:
            continue
        seen.add((q, x.tobytes()))
        scored = []
        for i, y in ok:
            if i != q and len(x) == len(y):
                total = 0.0
                for a, b in zip(x.tolist(), y.tolist()):
                    total += a * b
                scored.append((-total, i))
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:best])]
    return sorted(out)


@pytest.mark.parametrize(("block", "cell"), [(8192, 8), (16, 2)])
def test_nearest(spark, block, cell):
    rows = vector_rows()
    frame = vectors_of(spark, rows).repartition(3)
    got = neighbours.nearest(frame, F.col("vec_id") % 20 == 0, best=20, query_block=block // 2, candidate_block=block, cell_blocks=cell)
    assert sorted(map(tuple, got.collect())) == plain_nearest(rows, 20)


def test_nearest_empty_and_few(spark):
    assert neighbours.nearest(vectors_of(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    few = vectors_of(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [0.0, 1.0])])
    got = neighbours.nearest(few, F.col("vec_id") % 20 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == [(0, 1, 1), (0, 2, 20), (20, 1, 1), (20, 2, 0)]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 2000), st.integers(0, 2**32 - 1))
def test_bounds_hold(dim, seed):
    """The product of codes is exact and the true product lies within the bounds."""
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(6, dim)) * 10.0 ** rng.integers(-6, 6, size=(6, 1))
    codes = np.rint(v / (np.abs(v).max(axis=1, keepdims=True) / 127)).astype(np.int8)
    c = neighbours.Coded(dim, np.arange(6).tobytes(), codes.tobytes(), v.tobytes())
    whole = c.codes @ c.codes.T
    assert (whole == codes.astype(np.int64) @ codes.astype(np.int64).T).all()
    near = whole.astype(np.float64) * c.scale[:, None] * c.scale
    room = c.norm[:, None] * c.error + c.error[:, None] * c.coded_norm + 1e-12 * c.norm[:, None] * c.norm
    assert (np.abs(near - v @ v.T) <= room).all()


def plain_products(rows, best):
    """The largest inner products in double precision, ties to the smaller id."""
    with np.errstate(all="ignore"):
        v = {i: np.array(x, np.float64) for i, x in rows}
        out = {}
        for q in (i for i in v if i % 20 == 0):
            scored = []
            for c in v:
                if c != q:
                    total = 0.0
                    for a, b in zip(v[q], v[c]):
                        total += float(a * b)
                    scored.append((-np.inf if np.isnan(total) else -total, c))
            out[q] = [(rank, c, -s) for rank, (s, c) in enumerate(sorted(scored)[:best], 1)]
    return out


@pytest.mark.parametrize("powers", [(160, 0), (-170, 0), (-170, -170), (160, -160), (150, 150), (0, 0), (300, -320)])
def test_neighbours_of_all_finite_vectors(spark, powers):
    rng = np.random.default_rng(abs(powers[0]))
    rows = []
    for i in range(400):
        v = rng.normal(size=6) * 10.0 ** (powers[0] if i % 20 == 0 else powers[1]) * (10.0 ** rng.integers(-3, 3))
        rows.append((i, v.tolist()))
    rows += [(1001, [5e-324] + [0.0] * 5), (1003, [0.0, 0.0, 1.0, 0.0, 0.0, 0.0]), (1020, [0.0, 0.0, 127.0, 1e-300, 0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest(frame, F.col("vec_id") % 20 == 0, query_block=8, candidate_block=64, cell_blocks=2).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert {q: sorted(x) for q, x in got.items()} == plain_products(rows, 20)


def test_overflowing_query_finds_all(spark):
    rows = [(20, [1e160, 0.0, 0.0]), (1, [1.0, 0.0, 0.0]), (2, [0.3, 0.7, 0.1]), (3, [127.0, 0.0, 0.0])]
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 20).collect()
    assert sorted((r.rank, r.vec_id) for r in got) == [(1, 3), (2, 1), (3, 2)]


# -- licences -----------------------------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, line string, dice string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0, "r", "l", "d") for i, t in rows], DOCS)


def plain_scan(rows, threshold):
    known = {}
    for name, pair, _ in licences.template_bigrams(licences.TEMPLATES):
        known.setdefault(name, set()).add(pair)
    out = []
    for i, text in rows:
        for number, line in enumerate((text or "").replace("\r\n", "\n").replace("\r", "\n").split("\n"), 1):
            words = licences.words_of(line)
            pairs = {f"{a} {b}" for a, b in zip(words, words[1:])}
            found = [(-2 * len(pairs & t) / (len(pairs) + len(t)), name) for name, t in known.items() if pairs]
            if found and -min(found)[0] >= threshold:
                out.append((i, number, min(found)[1], -min(found)[0]))
    return sorted(out, key=str)


def test_licences(spark):
    mit = licences.TEMPLATES["MIT"]
    rows = [(1, f"some prose\n{mit}\r\nmore"), (2, "RELEASED under  the -- MIT license"), (3, None), (4, ""), (5, "word"), (None, mit), (1, mit), (1, mit)]
    rows += [(6, "This work is licensed under the GNU General Public License, version 2 or 3."), (7, "all rights reserved"), (8, "rights reserved all"), (9, "x " * 100_000)]
    rows += [(10 + k, t + " extra" * k) for k, t in enumerate(licences.TEMPLATES.values())] + [(40, f"{mit} " * 9)] + [(50 + i, mit) for i in range(100)]
    for threshold in (0.8, 0.5):
        got = licences.scan(docs_of(spark, rows).repartition(3), threshold=threshold)
        assert sorted(map(tuple, got.collect()), key=str) == plain_scan(rows, threshold)


def test_licences_empty(spark):
    assert licences.scan(docs_of(spark, [])).count() == 0
    assert licences.scan(docs_of(spark, [(1, "All rights reserved.")]), templates={}).count() == 0


def plain_find(rows, threshold, templates):
    """All passages from a template's bigram to the last one within as many positions as the template has."""
    known = {}
    for name, pair, _ in licences.template_bigrams(templates):
        known.setdefault(name, set()).add(pair)
    out = []
    for i, text in rows:
        words = licences.words_of(text or "")
        pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
        best = []
        for name, t in known.items():
            found = []
            for p, pair in enumerate(pairs):
                if pair in t:
                    part = pairs[p : p + len(t)]
                    length = max(k for k, x in enumerate(part) if x in t) + 1
                    found.append((-2 * len(t & set(part)) / (length + len(t)), p, length, len(t & set(part))))
            if found and -min(found)[0] >= threshold:
                dice, p, length, shared = min(found)
                best.append((-shared, dice, name, p, length))
        for h in best:
            if not any(g[:3] < h[:3] and g[3] < h[3] + h[4] and h[3] < g[3] + g[4] for g in best):
                out.append((i, h[2], -h[1], h[3] + 1, h[4] + 1))
    return sorted(out, key=str)


def found(spark, rows, **options):
    return sorted(map(tuple, licences.find(docs_of(spark, rows).repartition(3), **options).collect()), key=str)


def test_licences_anywhere_in_a_text(spark):
    """First lines of a licence text, a whole one, a wrapped notice, notices with words around them."""
    every = licences.EVERY
    bsd = "Copyright (c) 2024, A. Person\nAll changes are listed below.\n\n" + every["BSD-3-Clause-text"].replace(" ", "\n", 7)
    wrapped = "\n * ".join(every["Apache-2.0-notice"].split(" "))
    rows = [
        (1, "The MIT License\n\nCopyright (c) 2020 B. Person\n\n" + every["MIT-grant"] + ", and so on."),
        (2, bsd), (3, f"/*\n * {wrapped}\n */"), (4, "Copyright 2024 Example Ltd. All rights reserved."),
        (5, "The text of this page was released under the MIT License."), (6, "Note: this text is licensed under CC BY 4.0. More follows here."),
        (7, "Prose. " * 900 + every["MIT-text"] + " Prose." * 900), (8, "the software is provided as is"),
    ]
    got = found(spark, rows)
    assert [(i, name) for i, name, *_ in got] == [(1, "MIT-grant"), (2, "BSD-3-Clause-text"), (3, "Apache-2.0-notice"), (4, "Proprietary"), (5, "MIT"), (6, "CC-BY-4.0"), (7, "MIT-text")]
    assert {i: dice for i, _, dice, *_ in got}[7] > 0.9
    assert [first for i, *_, first, _ in got if i == 7] == [901]


@pytest.mark.parametrize("threshold", [0.8, 0.5])
def test_licences_by_brute_force(spark, threshold):
    rng = random.Random(6)
    rows = [(None, licences.EVERY["MIT"]), (1, None), (1, ""), (2, "word"), (3, "x " * 50_000), (4, licences.EVERY["MIT"]), (4, licences.EVERY["MIT"])]
    templates = {k: licences.EVERY[k] for k in ("MIT", "GPL-2.0", "GPL-3.0", "Proprietary", "ISC", "ISC-text", "Apache-2.0", "Apache-2.0-notice", "MIT-grant")}
    for i in range(150):
        parts = []
        for _ in range(rng.randrange(4)):
            words = licences.words_of(rng.choice(list(templates.values())))
            for _ in range(rng.randrange(3)):
                at = rng.randrange(len(words))
                words[at : at + rng.randrange(3)] = rng.choice([[], ["extra"], ["of", "the"], words[:3]])
            parts += words + rng.choices(["the", "license", "under", "all", "rights", "reserved", "software", "version"], k=rng.randrange(9))
        rows.append((10 + i, " ".join(parts)))
    assert found(spark, rows, templates=templates, threshold=threshold) == plain_find(rows, threshold, templates)


def test_licences_anywhere_of_nothing(spark):
    assert found(spark, []) == [] and found(spark, [(1, "All rights reserved.")], templates={}) == []


# -- toxicity -----------------------------------------------------------------------------------

TEXTS = "doc_id long, text string, lang string, source string, n_chars long, score string, label string, id string"


def texts_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0, "x", "y", "z") for i, t in rows], TEXTS)


def toxic_rows(n=800):
    rng = random.Random(4)
    prose = ["".join(rng.choices("etaoinshr", k=rng.randint(2, 7))) for _ in range(500)]
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(prose, k=rng.randint(10, 120))
        toxic = rng.random() < 0.2
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["Idiot", "moron!", "scumbag", "scumling"])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def labels_of(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_documents(spark):
    rows, labels = toxic_rows()
    hard = [(None, "idiot"), (900, None), (901, ""), (902, "word " * 300_000), (903, "idiot"), (903, "idiot")]
    told = labels + [(5000, 1, 1), (1, 1, None), (2, 1, 7), (None, 1, 1)]
    got = toxicity.score(texts_of(spark, rows + hard).repartition(4), labels_of(spark, told)).collect()
    assert len(got) == len(rows) + len(hard)
    truth = {i: toxic for i, _, toxic in labels}
    for r in got:
        i = r.doc.doc_id
        assert r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [r for r in got if r.held_out and r.doc.doc_id in truth]
    assert sum(r.predicted == truth[r.doc.doc_id] for r in held) >= 0.97 * len(held)
    by = {r.doc.text: r.score for r in got}
    assert by[""] == by[None]
    assert len({r.score for r in got if r.doc.text == "idiot"}) == 1
    again = toxicity.score(texts_of(spark, rows).repartition(9), labels_of(spark, told).repartition(3)).collect()
    assert {r.doc.doc_id: r.score for r in again} == {r.doc.doc_id: r.score for r in got if r.doc.doc_id in truth}


def test_toxicity_learns_nothing_from_the_held_out_fold(spark):
    rows, labels = toxic_rows(300)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    docs = texts_of(spark, rows)
    scores = [toxicity.score(docs, labels_of(spark, x)).select("doc.doc_id", "score").collect() for x in (labels, flipped)]
    assert sorted(scores[0]) == sorted(scores[1])


def test_toxicity_without_examples(spark):
    docs = texts_of(spark, [(1, "idiot"), (2, None)])
    none = labels_of(spark, [])
    assert [r.score for r in toxicity.score(docs, none).collect()] == [0.0, 0.0]
    assert toxicity.score(texts_of(spark, []), none).count() == 0
    kept = toxicity.accepted(docs, none)
    assert kept.columns == docs.columns and kept.count() == 2


def test_sample_is_bounded(spark):
    rows, labels = toxic_rows(800)
    some = toxicity.sample(texts_of(spark, rows), labels_of(spark, labels), 100, "doc_id", "text", "toxic")
    assert 60 <= some.count() <= 140
    # one id on most rows, with equal texts and with different ones, and both labels
    rows = rows + [(1, f"text {i % 500}") for i in range(3000)] + [(3, "same") for _ in range(3000)]
    labels = labels + [(1, 1, 0), (1, 1, 1)]
    every = toxicity.sample(texts_of(spark, rows), labels_of(spark, labels), 10**6, "doc_id", "text", "toxic").collect()
    assert len(every) == len({(i, t) for i, _, t in labels if zlib.crc32(str(i).encode()) % 4 != 2})


def plain_features(text, size):
    """Places of words, beginnings of words, pairs and skip-pairs, word by word."""
    words, mask = re.findall(r"\w+", text.lower()), 2**64 - 1
    hashed = [xxhash.xxh64_intdigest(w) for w in words]
    found = set(hashed)
    for w in words:
        found |= {xxhash.xxh64_intdigest(w[:k] + "*") for k in toxicity.STEMS if len(w) > k}
    one, two = map(int, toxicity.Features.mix)
    found |= {(a * one + b) & mask for a, b in zip(hashed, hashed[1:])}
    found |= {(a * two + b) & mask for a, b in zip(hashed, hashed[2:])}
    return sorted({x >> (64 - size) for x in found})


def plain_ftrl(examples, size, passes, alpha, beta, l1, l2):
    """The update of McMahan et al., coordinate by coordinate; the bias has no L1."""
    z, n = {}, {}
    bias = 2**size

    def weight(i):
        s = z.get(i, 0.0)
        pull = s if i == bias else math.copysign(max(abs(s) - l1, 0.0), s)
        return -pull / ((beta + math.sqrt(n.get(i, 0.0))) / alpha + l2)

    for _ in range(passes):
        for places, toxic in examples:
            at = [*places, bias]
            w = {i: weight(i) for i in at}
            g = 1 / (1 + math.exp(-sum(w.values()))) - toxic
            for i in at:
                old = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / alpha * w[i]
                n[i] = old + g * g
    return {i: w for i in z if (w := weight(i))}


def test_ftrl_against_a_plain_one(spark):
    rows, labels = toxic_rows(250)
    told = {i: t for i, _, t in labels if zlib.crc32(str(i).encode()) % 4 != 2}
    order = sorted(told, key=lambda i: (spark_hash(spark, told)[i], told[i]))
    texts = dict(rows)
    examples = [(plain_features(texts[i], toxicity.BITS), told[i]) for i in order]
    want = plain_ftrl(examples, toxicity.BITS, toxicity.PASSES, toxicity.ALPHA, toxicity.BETA, toxicity.L1, toxicity.L2)
    at, weights = toxicity.train(texts_of(spark, rows).repartition(3), labels_of(spark, labels))
    got = dict(zip(at.tolist(), weights.tolist()))
    assert set(got) == set(want) and all(abs(got[i] - want[i]) < 1e-9 for i in want)
    scored = {r.doc.doc_id: r.score for r in toxicity.score(texts_of(spark, rows), labels_of(spark, labels)).collect()}
    for i, text in rows:
        total = sum(want.get(p, 0.0) for p in [*plain_features(text, toxicity.BITS), 2**toxicity.BITS])
        assert abs(scored[i] - 1 / (1 + math.exp(-total))) < 1e-9


_hashes: dict[int, int] = {}


def spark_hash(spark, ids):
    if not _hashes:
        frame = spark.createDataFrame([(i,) for i in ids], "id long")
        _hashes.update({r.id: r.place for r in frame.selectExpr("id", "xxhash64(CAST(id AS string)) AS place").collect()})
    return _hashes


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["ab", "c", "défg", "longer", "1", "Under_score"]), max_size=30))
def test_pieces_of_a_text_give_the_same_features(words):
    text = " ".join(words)
    whole = toxicity.Features().of_text(text)
    before, toxicity.PIECE = toxicity.PIECE, 7
    try:
        assert set(toxicity.Features().of_text(text)) == set(whole)
    finally:
        toxicity.PIECE = before
