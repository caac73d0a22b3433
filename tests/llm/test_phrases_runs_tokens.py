"""Collocations, periodic runs and token counts against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cyclerlake.llm import collocations, queries, runs, token_counts

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, phrase string, part string, f long, route long, block string, _text2 string, start string"
WORD = r"[^\x20\x09-\x0D]+"


def docs_of(spark, rows):
    """Documents with extra columns whose names clash with helper columns."""
    return spark.createDataFrame([(i, t, lang, "p", "p", 0, 0, "b", "t", "s") for i, t, lang in rows], DOCS)


# -- collocations -------------------------------------------------------------------------------


def plain_counts(rows, longest=5):
    count, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    count[lang, tuple(words[i : i + size])] += 1
    return count, n


def plain_phrases(rows, least, top=2000):
    count, n = plain_counts(rows)
    often = {p: f for p, f in count.items() if f >= least}
    found = {}
    for (lang, words), a in often.items():
        if len(words) < 2:
            continue
        held = any(
            len(w) > len(words) and x == lang and f >= a and any(w[i : i + len(words)] == words for i in range(len(w) - len(words) + 1)) for (x, w), f in often.items()
        )
        if held:
            continue
        cuts = [(1000 * a * n[lang] // (count[lang, words[:k]] * count[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        found.setdefault(lang, []).append((" ".join(words), a, count[lang, words[:k]], count[lang, words[k:]], n[lang], score))
    out = []
    for lang, listed in found.items():
        listed.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        out += [(lang, rank, *x) for rank, x in enumerate(listed[:top], 1)]
    return sorted(out)


def texts(seed, n):
    chance = random.Random(seed)
    words = ["a", "b", "B", "c\x01", "c", "\x00", "é", "É", "d e", "\U0001f600", '"', "zz"]
    rows = []
    for i in range(n):
        text = "".join(chance.choice(words) + chance.choice([" ", " ", " ", "\t", "  ", ". ", "\n", "!", ", "]) for _ in range(chance.randrange(30)))
        rows.append((i, text, chance.choice(["en", "en", "de", None, "und", "e"])))
    return rows


HARD = [(None, None, "en"), (1, "", None), (2, " . , \n", "en"), (3, "a b c a b c a b c", "xx"), (3, "a b c a b c a b c", "xx"), (4, "one two", "en")]


@pytest.mark.parametrize("least, top", [(3, 2000), (8, 3)])
def test_collocations(spark, least, top):
    # a passage that a third of all documents share, and copies
    rows = texts(1, 300) + HARD + [(1000 + i, "the very same passage is here, and the very same one there", "en") for i in range(150)]
    got = collocations.mine(docs_of(spark, rows).repartition(5), min_count=least, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain_phrases(rows, least, top)


def test_phrase_counts_do_not_depend_on_ranges(spark):
    rows = texts(2, 200)
    count, n = plain_counts(rows)
    want = {(lang, " ".join(words)): f for (lang, words), f in count.items() if f >= 5} | {(lang, ""): f for lang, f in n.items() if f}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for ranges in ("1", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", ranges)
            got = collocations.phrase_counts(docs_of(spark, rows).repartition(3), min_count=5).collect()
            assert {(r.lang, r.phrase): r.f for r in got if r.f} == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_collocations_of_nothing(spark):
    assert collocations.mine(docs_of(spark, [])).collect() == []
    assert collocations.mine(docs_of(spark, [(1, "", "en"), (2, None, None)])).collect() == []


def test_suffixes_sent_in_parts_of_a_text():
    words = [random.Random(i).choice([b"a", b"b", b".", b"c"]) for i in range(400)]
    cuts = [(0, (b"a", b"b")), (1, (b"a", b"bb")), (2, (b"b",)), (3, (b"zz",))]
    total = Counter()
    held = collocations.Suffixes(5)
    for at in range(0, 400, 37):
        held.add(words[at : at + 37])
        for _, block in held.blocks(cuts, 4, at + 37 >= 400):
            listed, local, weights = collocations._unpack(block, 5)
            for suffix, weight in zip(local.T.tolist(), weights.tolist()):
                total[tuple(listed[i - 1] for i in suffix if i)] += weight
    want = Counter()
    for i, w in enumerate(words):
        if w != b".":
            rest = words[i : i + 5]
            want[tuple(rest[: rest.index(b".")] if b"." in rest else rest)] += 1
    assert total == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(*[st.integers(0, 3)] * 3), min_size=1, max_size=60), st.integers(1, 6), st.sampled_from([2, 4096]))
def test_quicksort_counts_phrases(rows, least, leaf):
    before, collocations.LEAF = collocations.LEAF, leaf
    try:
        # nothing follows the end of a suffix
        rows = [tuple(x if all(row[:k]) else 0 for k, x in enumerate(row)) for row in rows]
        weights = np.arange(1, len(rows) + 1) % 3 + 1
        got = {tuple(p): f for p, f in collocations.frequent(np.array(rows).T, weights, least)}
    finally:
        collocations.LEAF = before
    want = Counter()
    for row, weight in zip(rows, weights.tolist()):
        for k in range(1, 4):
            if all(row[:k]):
                want[row[:k]] += weight
    assert got == {p: f for p, f in want.items() if f >= least}


def test_tokens_of_long_texts(monkeypatch):
    text = "Some words, and\tmore. Né!".encode() * 50
    whole = [w for part in collocations.tokens(text) for w in part]
    monkeypatch.setattr(collocations, "PIECE", 64)
    assert [w for part in collocations.tokens(text) for w in part] == whole
    assert len(list(collocations.tokens(text))) > 10


def test_products_beyond_64_bits(spark):
    a, n = 3 * 10**12, 10**13
    rows = [("en", "", n), ("en", "x", 4 * 10**12), ("en", "y", 5 * 10**12), ("en", "x y", a)]
    got = collocations.score(spark.createDataFrame(rows, "lang string, phrase string, f long")).collect()
    assert [r.score for r in got] == [1000 * a * n // (4 * 10**12 * 5 * 10**12)]


# -- periodic runs ------------------------------------------------------------------------------


def plain_runs(words, least=6, repeats=4):
    found = {}
    for period in range(1, len(words) // repeats + 1):
        i = 0
        while i + period < len(words):
            j = i
            while j + period < len(words) and words[j] == words[j + period]:
                j += 1
            if j + period - i >= max(least, repeats * period):
                found.setdefault((i, j + period - i), period)
            i = j + 1
    return sorted([(s, n, p) for (s, n), p in found.items()], key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text, plant=True):
    words = re.findall(WORD, text or "")
    n, h = len(words), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if plant and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    listed = plain_runs(words)
    best = min(listed, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    gone = {i for s, length, p in listed for i in range(s + p, s + length)}
    share = None if best[0] is None else 1000 * best[1] // best[2]
    lines = "".join(f"{s},{length},{p}\n" for s, length, p in listed)
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(listed), *best, share, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest()), listed, left


word_lists = st.lists(st.tuples(st.lists(st.integers(0, 2), max_size=14), st.integers(1, 7)), min_size=1, max_size=5)


@settings(max_examples=300, deadline=None)
@given(st.lists(word_lists, min_size=1, max_size=3))
def test_runs(batch):
    # repeated stretches, side by side and nested
    held = [(i, [str(x).encode() for stretch, times in parts for x in stretch * times]) for i, parts in enumerate(batch)]
    for (key, found, left), (i, words) in zip(runs._batch(held), held):
        assert key == i and found == plain_runs(words)
        gone = {at for s, n, p in found for at in range(s + p, s + n)}
        assert left == [w for at, w in enumerate(words) if at not in gone]


def test_runs_of_periodic_words():
    chance = random.Random(5)
    fib = ["a", "ab"]
    while len(fib[-1]) < 2000:
        fib.append(fib[-1] + fib[-2])
    long = [chance.randrange(400) for _ in range(300)]
    for words in (["x"] * 3000, list(fib[-1][:2000]), long * 6 + long[:17], (["a"] * 20 + ["b"]) * 40, list("ab" * 50 + "c" + "ab" * 50) * 6):
        number = {w: i for i, w in enumerate(dict.fromkeys(words))}
        found = runs.find_runs(np.array([number[w] for w in words] + [len(number)]))
        assert [tuple(r) for r in found.tolist()] == plain_runs(words)
    with pytest.raises(ValueError):
        runs.find_runs(np.arange(3), repeats=3)


def test_best_run_is_exact():
    near = [(0, 10**15 + 1, 10**14), (5, 10 * 10**14, 10**14), (9, 10**15 + 1, 10**14)]
    assert runs.best_run(near) == near[0]
    assert runs.best_run([]) is None


def test_scan(spark):
    rows = [(None, "a a a a a a a", "en"), (0, None, "en"), (1, "", "en"), (2, " \t\n", "en"), (3, "x y " * 9, "en"), (3, "x y " * 9, "en")]
    rows += [(10 + i, " ".join(random.Random(i).choice("abcd") for _ in range(random.Random(i).randrange(60))), "en") for i in range(200)]
    rows += [(9999, " ".join(f"w{i % 61}" for i in range(300_000)), "en")]
    docs = docs_of(spark, rows).repartition(3)
    got = runs.scan(docs, rewrite=queries.planted).collect()
    small = sorted(str(tuple(r)[:8]) for r in got if r.doc_id != 9999)
    assert small == sorted(str(plain_row(i, t)[0]) for i, t, _ in rows if i != 9999)
    assert [(r.n_runs, r.start, r.length, r.period) for r in got if r.doc_id == 9999] == [(1, 0, 300_000, 61)]
    plain = {r.doc_id: ([tuple(x) for x in r.runs], r.collapsed) for r in runs.scan(docs).collect() if r.doc_id is not None and r.doc_id != 9999}
    assert plain == {i: plain_row(i, t, False)[1:] for i, t, _ in rows if i is not None and i != 9999}
    assert runs.scan(docs.limit(0)).collect() == []


def test_runs_query(spark):
    got = queries.QUERIES["op12_runs"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert sorted(map(tuple, got.collect())) == sorted(plain_row(r.doc_id, r.text)[0] for r in docs)


# -- token counts -------------------------------------------------------------------------------

ODD = [
    None, "", " ", "\n\t\x0b\x0c\r", "it's IT'S we'll 'tis '", "don't stop", "a\x1cb \x85 x y", "<|endoftext|> x<|startoftext|>y <|ENDOFTEXT|>",
    "<|endof text|>", "é ́ é ẛ̣ İ ŞŠ ß ς Σ ΟΔΟΣ", "123 4.5 ½ ² Ⅷ", "\U0001f600\U0001f468‍\U0001f469 漢字かな 한글", "x" * 300_000, "ab1" * 9000 + " end",
    "\x00 \x01a ﻿ ​", "!!!??? ... --- '''s", "very " * 5000, "End. end, END; it's, it', a.b, a., é, x?! 1: K. Ⅷ. <|endoftext|>. İ, <|EndOfText|>,",
]


def library_counts(rows):
    tokenizer = token_counts.tokenizer(queries.tokenizer_path(queries.WORD_TOKENIZER))
    return sorted((i, len(t.encode()), n := len(tokenizer.encode(t, add_special_tokens=False).ids), n > 2048) for i, t in ((i, t or "") for i, t in rows))


def test_token_counts(spark):
    rows = [(i, t, "en") for i, t in enumerate(ODD)] + [(3, "twice", "en")] * 2
    got = token_counts.count(docs_of(spark, rows).repartition(3), queries.tokenizer_path(queries.WORD_TOKENIZER))
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(map(tuple, got.collect())) == library_counts([(i, t) for i, t, _ in rows])
    empty = token_counts.count(docs_of(spark, []), queries.tokenizer_path(queries.WORD_TOKENIZER))
    assert empty.collect() == []


def test_token_counts_query(spark):
    got = queries.QUERIES["op13_tokens"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert sorted(map(tuple, got.collect())) == library_counts([(r.doc_id, r.text) for r in docs])


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aB1.,;?'st \t\n\x0b  ́é.!1<|endoftext>\x1c　"), max_size=40))
def test_pre_tokens_are_separate(text):
    path = queries.tokenizer_path(queries.WORD_TOKENIZER)
    parts = [p for found in token_counts.pieces(text.encode()) for p in found]
    whole = len(token_counts.tokenizer(path).encode(text, add_special_tokens=False).ids)
    assert sum(token_counts.lengths(path, parts)) == whole
    bare = [token_counts.bare(p) for p in parts]
    marks = [p[len(b) :] for p, b in zip(parts, bare) if p != b]
    assert sum(token_counts.lengths(path, bare + marks)) == whole


def test_misra_gries():
    summary = Counter({"a": 9, "b": 5, "c": 3, "d": 3, "e": 1})
    assert token_counts.reduce_summary(summary, 2) == {"a": 6, "b": 2}
    assert token_counts.reduce_summary(summary, 9) == summary


def test_long_texts_in_pieces(monkeypatch):
    text = b"some words and more " * 30
    whole = text.split()
    monkeypatch.setattr(token_counts, "PIECE", 50)
    assert [w for found in token_counts.pieces(text) for w in found] == whole
