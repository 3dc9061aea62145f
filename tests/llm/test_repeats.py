"""Repeated windows, near-duplicates and suffix arrays, against plain versions."""

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from tests.llm.conftest import passage
from weir.llm import minhash, substring_dedup, suffix_dedup
from weir.llm.components import components
from weir.llm.repeats import repeated, sliding_least

BLANK = b" \t\n\x0b\x0c\r"


def words(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_suffix_array():
    r = random.Random(3)
    for _ in range(1500):
        text = bytes(r.choice(b"abc"[: r.randint(1, 3)]) for _ in range(r.randint(0, 40)))
        assert suffix_dedup.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_sliding_least():
    r = np.random.default_rng(1)
    for width in (1, 2, 3, 7, 8, 20):
        values = r.integers(0, 9, 100).astype(np.uint64)
        plain = [i + int(values[i : i + width].argmin()) for i in range(100 - width + 1)]
        assert sliding_least(values, width).tolist() == plain
    assert len(sliding_least(values, 101)) == 0


def plain_words(rows, length):
    windows = Counter()
    split = [words(t) for _, t in rows]
    for w in split:
        windows.update(tuple(w[i : i + length]) for i in range(len(w) - length + 1))
    out = []
    for (doc_id, _), w in zip(rows, split, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if windows[tuple(w[i : i + length])] > 1:
                gone[i : i + length] = [True] * length
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((doc_id, len(w), sum(gone), sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def plain_bytes(rows, length):
    seen, out = set(), []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if data[i : i + length] in seen:
                gone[i : i + length] = b"\1" * length
            else:
                seen.add(data[i : i + length])
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(data), sum(gone), spans, sha256(kept).hexdigest()))
    return sorted(out, key=str)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def by_id(docs):
    return sorted(((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=lambda r: (r[0] is None, r[0]))


@pytest.mark.parametrize("length,gram", [(35, 8), (5, 2)])
def test_word_windows(docs, length, gram):
    some = docs.where("length(text) < 100000 OR text IS NULL")
    assert collected(substring_dedup.remove_repeated(some, length, gram)) == plain_words(by_id(some), length)


@pytest.mark.parametrize("length,gram", [(100, 32), (20, 6)])
def test_byte_windows(docs, length, gram):
    some = docs.where("length(text) < 100000 OR text IS NULL").dropDuplicates(["doc_id"])
    assert collected(suffix_dedup.remove_repeated(some, length, gram)) == plain_bytes(by_id(some), length)


def test_repeated_rows_stay_alike(spark):
    rows = [(1, "abc" * 60), (1, "abc" * 60), (2, "abc" * 60)]
    found = suffix_dedup.remove_repeated(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"))
    n = {r.doc_id: r.n_removed for r in found.collect()}
    assert n == {1: 177, 2: 180}


def test_crowded_minimisers(docs):
    """The way for minimisers with very many runs gives the same rows."""
    some = docs.where("length(text) < 100000 OR text IS NULL").dropDuplicates(["doc_id"])
    units = substring_dedup.word_units(5, 2)
    got = repeated(some, units, substring_dedup.count_windows(5), False, gathered=0).select("doc_id", "n", "n_removed", "kept_sha256")
    assert collected(got) == plain_words(by_id(some), 5)
    units = suffix_dedup.byte_units(20, 6)
    got = repeated(some, units, suffix_dedup.first_windows(20), True, gathered=0)
    assert collected(got) == plain_bytes(by_id(some), 20)


def test_empty_tables(no_docs):
    assert collected(substring_dedup.remove_repeated(no_docs)) == []
    assert collected(suffix_dedup.remove_repeated(no_docs)) == []
    assert collected(minhash.near_duplicates(no_docs)) == []


def test_very_long_text(docs):
    found = {r.doc_id: r for r in substring_dedup.remove_repeated(docs.where("doc_id IN (15, 30)")).collect()}
    assert found[15].n_words == 30_000 and found[30].n_words == 30_001


# --- near-duplicates --------------------------------------------------------------------------


def plain_components(rows, size, percent=80):
    sets = {}
    for doc_id, text in rows:
        w = words((text or "").translate({i: i + 32 for i in range(65, 91)}))
        sets[doc_id] = {tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1))} if w else set()
    part = {i: i for i in sets}

    def top(i):
        while part[i] != i:
            i = part[i]
        return i

    ids = sorted(i for i in sets if i is not None)
    for a in ids:
        for b in ids:
            x, y = sets[a], sets[b]
            if a < b and x and y and 100 * len(x & y) >= percent * len(x | y):
                lo, hi = sorted((top(a), top(b)))
                part[hi] = lo
    return {i: (len(sets[i]), top(i)) for i in ids}


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates(docs, size):
    want = plain_components(by_id(docs), size)
    found = minhash.near_duplicates(docs, size).collect()
    assert len(found) == docs.count()
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
            assert r.kept == (r.doc_id == r.component_id)


def test_chains_and_many_small_sets(spark):
    r = random.Random(9)
    pool = [f"w{i}" for i in range(40)]
    rows, base = [], [r.choice(pool) for _ in range(60)]
    for i in range(80):  # each changes a word of the one before: far ends differ, all are linked
        base = list(base)
        base[r.randrange(60)] = f"n{i}"
        rows.append((i, " ".join(base)))
    rows += [(100 + i, " ".join(r.choice(pool[:3]) for _ in range(r.randint(1, 7)))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    want = plain_components(rows, 4)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs).collect()}
    assert found == want


def test_links_in_a_large_bucket(spark):
    """600 texts around one template, 0.754 alike, and among them 40 pairs of 0.802 that must all be found."""
    template, tail = passage(40, 89), lambda i: [f"eigen{i}n{k}" for k in range(14)]
    tails = [tail(i) for i in range(600)]
    for i in range(40):
        tails[599 - i][:3] = tails[200 + i][:3]
    docs = spark.createDataFrame([(i, f"{template} {' '.join(t)}") for i, t in enumerate(tails)], "doc_id BIGINT, text STRING")
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    assert found == {i: i for i in range(560)} | {599 - i: 200 + i for i in range(40)}


def variants(n, shared):
    """Texts around one template that are mutually below 0.8: with tails of their own, or all of whose words many others have too."""
    template, r = passage(41, 89), random.Random(n)
    if shared:
        return [" ".join([template, *[f"teil{k}x{r.randrange(6)}" for k in range(14)]]) for _ in range(n)]
    return [" ".join([template, *[f"eigen{i}n{k}" for k in range(14)]]) for i in range(n)]


@pytest.mark.parametrize("shared", [False, True])
def test_rows_grow_with_a_group_not_with_its_square(spark, monkeypatch, shared):
    found = {}
    for n in (300, 900):
        rows, plain = Counter(), minhash.sealed

        def counting(df, name):
            out = plain(df, name)
            rows[name] += out.count()
            return out

        monkeypatch.setattr(minhash, "sealed", counting)
        docs = spark.createDataFrame(list(enumerate(variants(n, shared))), "doc_id BIGINT, text STRING")
        got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
        monkeypatch.setattr(minhash, "sealed", plain)
        if n == 300:
            assert got == {i: c for i, (_, c) in plain_components(by_id(docs), 4).items()}
        found[n] = rows
    for name, n in found[900].items():
        assert n <= 4 * found[300][name] + 1000, (name, n, found[300][name])


def test_blocks_of_a_large_bucket(spark, monkeypatch):
    """The links between and within many blocks are those of one block."""
    docs = spark.createDataFrame(list(enumerate(variants(150, True) + ["a b c d e f"] * 2)), "doc_id BIGINT, text STRING")
    monkeypatch.setattr(minhash, "BLOCK_SETS", 20)
    monkeypatch.setattr(minhash, "COLUMNS", 7)
    want = {i: c for i, (_, c) in plain_components(by_id(docs), 4).items()}
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()} == want


def test_without_copies(docs):
    left = minhash.without_copies(docs, 4)
    ids = [r.doc_id for r in left.select("doc_id").collect()]
    want = {i for i, (_, c) in plain_components(by_id(docs), 4).items() if i == c}
    assert set(ids) == want | {None} and set(left.columns) == set(docs.columns)


def test_densified_bins():
    hashes, first = minhash.shingle_sets([b"a b c d e", b"", b"x"], 4)
    table = minhash.signatures(hashes, first)
    for row in (0, 2):
        assert set(table[row].tolist()) <= set((minhash.mixed(hashes + minhash._STEP) // np.uint64(minhash.BINS)).tolist())


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(200, i) for i in range(201, 260)] + [(5, 5), (300, 301), (301, 300), (None, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a BIGINT, b BIGINT")).collect()}
    want = {i: 0 for i in range(61)} | {i: 200 for i in range(200, 260)} | {300: 300, 301: 300}
    assert found == want
