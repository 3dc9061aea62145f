"""SimHash near-duplicates against all pairs."""

import random

import numpy as np
import xxhash

from weir.llm import simhash


def plain_fingerprint(text, size=3):
    words = text.lower().split()
    shingles = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum((2 * sum(h >> k & 1 for h in hashes) > len(hashes)) << k for k in range(64)) if hashes else 0


def plain_classes(marks):
    """The class of each mark, its least member, from all pairs."""
    marks = sorted(set(marks))
    part = list(range(len(marks)))

    def top(i):
        while part[i] != i:
            i = part[i]
        return i

    for i in range(len(marks)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= 3:
                lo, hi = sorted((top(i), top(j)))
                part[hi] = lo
    return {m: top(i) for i, m in enumerate(marks)}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def check(docs, df):
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    marks = [plain_fingerprint(t) for _, t in rows]
    part = plain_classes([m for (i, _), m in zip(rows, marks) if i is not None])
    least = {}
    for (i, _), m in zip(rows, marks):
        if i is not None:
            least[part[m]] = min(i, least.get(part[m], i))
    want = [(i, f"{m:016x}", None if i is None else least[part[m]]) for (i, _), m in zip(rows, marks)]
    assert df.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr)


def test_documents(docs, no_docs):
    check(docs, simhash.near_duplicates(docs))
    assert simhash.near_duplicates(no_docs).collect() == []


def test_near_texts(spark):
    r = random.Random(7)
    rows = []
    for group in range(12):
        base = [f"w{r.randrange(400)}" for _ in range(r.randint(30, 300))]
        for _ in range(10):
            own = list(base)
            own[r.randrange(len(own))] = f"n{r.randrange(50)}"
            rows.append((len(rows), " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    check(df, simhash.near_duplicates(df))


def test_texts_in_pieces(monkeypatch):
    r = random.Random(8)
    texts = [" ".join(r.choice(["A", "b", "Ü", "word"]) for _ in range(n)).encode() for n in (0, 1, 2, 3, 4, 50, 400)]
    texts += [b"  \t\n", b" x", b"x" * 90 + b" y z", b"a\x0bb\x0cc\rd", "a b c".encode()]
    want = [plain_fingerprint(t) for t in texts]
    for piece in (1, 7, 64, 1 << 20):
        monkeypatch.setattr(simhash, "PIECE", piece)
        assert [simhash.fingerprint(t) for t in texts] == want


def clustered(r, n, base, bits):
    return {base ^ sum(1 << b for b in r.sample(range(64), r.randint(0, bits))) for _ in range(n)}


def test_links_reach_what_all_pairs_reach(spark):
    """Random fingerprints, tight groups, and a crowd of one list that is dealt out by five bytes."""
    r = random.Random(9)
    marks = {r.getrandbits(64) for _ in range(300)}
    for _ in range(30):
        marks |= clustered(r, 12, r.getrandbits(64), 6)
    base = r.getrandbits(64)
    marks |= {base ^ sum(1 << b for b in r.sample(range(24, 64), 5)) for _ in range(simhash.CROWD + 400)}  # three bytes alike
    df = spark.createDataFrame([(signed(m),) for m in marks], "mark BIGINT")
    edges = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(df).collect()]
    part = {m: m for m in marks}

    def top(i):
        while part[i] != i:
            i = part[i]
        return i

    for a, b in edges:
        lo, hi = sorted((top(a), top(b)))
        part[hi] = lo
    want = plain_classes(marks)
    classes = {}
    for m in marks:
        classes.setdefault(want[m], set()).add(top(m))
    assert all(len(tops) == 1 for tops in classes.values())
    assert len({next(iter(t)) for t in classes.values()}) == len(classes)


def test_neighbours_and_tally_agree():
    r = random.Random(10)
    base = r.getrandbits(64)
    marks = np.array(sorted({base ^ (r.getrandbits(24) << 40) for _ in range(60)} | clustered(r, 1, base, 0)), np.uint64)
    marks = np.unique(np.concatenate([marks, marks ^ np.uint64(1 << 41), marks ^ np.uint64(7 << 50)]))
    pairs = {tuple(sorted(p)) for p in zip(*[x.tolist() for x in simhash.neighbours(marks, (5, 6, 7))])}
    zeros = np.zeros(len(marks), np.int64)
    tallied = {tuple(sorted(p)) for p in zip(*[x.tolist() for x in simhash.tallied(marks, zeros, zeros)])}
    plain = {(i, j) for j in range(len(marks)) for i in range(j) if int(marks[i] ^ marks[j]).bit_count() <= 3}
    assert pairs == tallied == plain and plain


def test_every_five_bytes_hold_a_triple():
    subsets = simhash._subsets()
    assert sum(map(len, subsets)) == 56 and all(set(t) <= set(s) for t, own in zip(simhash.TRIPLES, subsets) for s in own)
