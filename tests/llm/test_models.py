"""Decontamination, language models and neighbours, against plain versions, brute force and held-out labels."""

import math
import random
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

from tests.llm.conftest import passage
from weir.llm import decontam, neighbours, quality, toxicity
from weir.llm.common import read


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, passage(1, 20)), (2, passage(50, 30)), (2, passage(50, 30)), (3, None), (4, "too short"), (5, "")]
    return spark.createDataFrame(rows, "item_id BIGINT, text STRING")


def leaks(docs, benchmark, **more):
    return {(r.doc_id, r.item_id): (r.place, r.n_matched, r.n_item) for r in decontam.leaks(docs, benchmark, **more).collect()}


def test_substituted_passages_are_found(spark, benchmark):
    item = passage(50, 30).split()
    one, many, half = list(item), list(item), item[:15]
    one[7] = one[20] = "anders"
    for i in range(0, 30, 3):
        many[i] = "anders"
    rows = [
        (1, passage(60, 40) + " " + passage(50, 30).upper() + " " + passage(61, 9)),
        (2, passage(60, 12) + ", " + "; ".join(one)), (3, " ".join(many)), (4, " ".join(half)), (5, None), (6, ""),
        (7, " ".join(item[4:])), (7, " ".join(item[4:])), (None, " ".join(item)), (8, " ".join(item[:10])), (9, " ".join(item[9:20])),
    ]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    found = leaks(docs, benchmark)
    assert found == {(1, 2): (40, 30, 30), (2, 2): (12, 28, 30), (4, 2): (0, 15, 30), (7, 2): (-4, 26, 30), (None, 2): (0, 30, 30), (9, 2): (-9, 11, 30)}
    left = [r.doc_id for r in decontam.without_leaks(docs, benchmark).collect()]
    assert sorted(left, key=str) == [3, 5, 6, 8, None]
    assert leaks(docs, benchmark, block_seeds=20) == found


def test_quoted_inserted_and_short_items(spark):
    forty, twenty, eight, seven = (passage(70 + n, n).split() for n in (40, 20, 8, 7))
    items = [(1, " ".join(forty)), (2, " ".join(twenty)), (3, " ".join(eight)), (4, " ".join(seven)), (5, "only four words here"), (6, "yes")]
    benchmark = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    before, after = passage(80, 30), passage(81, 30)

    def around(words):
        return f"{before} {' '.join(words)} {after}"

    rows = [
        (1, around(forty[:31])), (2, around(forty[:20] + ["neu"] + forty[20:])), (3, around(twenty[:10] + ["neu", "er"] + twenty[10:])),
        (4, around(twenty[:9] + twenty[10:])), (5, around(["neu"] + eight[1:])), (6, around(seven)), (7, around(seven[:3] + ["neu"] + seven[4:])),
        (8, "Only four words, here!"), (9, around(["only", "four", "words", "here"])), (10, "Yes."), (11, "yes yes"), (12, around(eight[:6])),
    ]
    found = leaks(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), benchmark)
    assert found == {
        (1, 1): (30, 31, 40), (2, 1): (30, 40, 40), (3, 2): (30, 20, 20), (4, 2): (29, 19, 20), (5, 3): (30, 7, 8), (6, 4): (30, 7, 7),
        (8, 5): (0, 4, 4), (10, 6): (0, 1, 1),
    }


def test_no_overlap_is_without_a_seed():
    """Whatever a fifth of the tokens is substituted, some seed of eight tokens or more is left."""
    from itertools import combinations

    for n in range(decontam.PIECE, 2 * decontam.PIECE):
        places = [sum(1 << (i + k) for k in mask) for mask in decontam.MASKS for i in range(n - mask[-1])]
        for gone in combinations(range(n), n * (100 - decontam.OVERLAP) // 100):
            bits = sum(1 << g for g in gone)
            assert any(not place & bits for place in places), (n, gone)


def test_random_edits_against_all_alignments(spark, tmp_path):
    """The oracle looks at every alignment, without seeds."""
    from tests import oracle

    r = random.Random(12)
    items = [(i, passage(300 + i, r.randint(1, 45))) for i in range(25)] + [(30, "na " * 20)]
    rows = []
    for i in range(150):
        words = items[r.randrange(len(items))][1].split()
        for _ in range(r.randint(0, len(words) // 4)):
            kind, at = r.random(), r.randrange(len(words) + 1)
            words[at : at + (kind > 0.2)] = [passage(r.randrange(10**6), 1)] * (kind < 0.8)
        if r.random() < 0.3:
            words = words[r.randrange(len(words) + 1) :]
        rows.append((i, " ".join([passage(1000 + i, r.randint(0, 20)), *words, passage(2000 + i, r.randint(0, 20))]).strip()))
    benchmark = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(3)
    docs.toPandas().to_parquet(tmp_path / "documents.parquet")
    benchmark.toPandas().to_parquet(tmp_path / "benchmark.parquet")
    for table in set(oracle.TABLES) - {"documents", "benchmark"}:
        benchmark.toPandas().to_parquet(tmp_path / f"{table}.parquet")
    assert oracle.assert_same(decontam.leaks(docs, benchmark), decontam.leaks_sql(), str(tmp_path)) > 60


def test_no_benchmark(docs, no_docs, benchmark):
    assert decontam.leaks(docs, benchmark.where("false")).count() == 0
    assert decontam.leaks(no_docs, benchmark).count() == 0
    assert decontam.leaks(docs, benchmark).count() > 0  # extra columns and long texts pass


def test_no_python_in_the_plan(docs, benchmark):
    plan = decontam.leaks(docs, benchmark)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- toxicity ---------------------------------------------------------------------------------


def test_held_out_accuracy(spark):
    docs = read(spark, "/root/testdata/sf0.1", "documents", "doc_id", "text")
    labels = read(spark, "/root/testdata/sf0.1", "labels", "doc_id", "toxic")
    found = toxicity.score(docs, labels)
    rows = found.where("held_out").join(labels, "doc_id").select("score", "predicted", "toxic").collect()
    hits = sum(r.predicted and r.toxic for r in rows)
    assert hits / sum(r.predicted for r in rows) > 0.95 and hits / sum(r.toxic for r in rows) > 0.85
    assert all(0 < r.score < 1 and r.predicted == (r.score >= 0.5) for r in rows)


def plain_toxicity(rows, labels):
    """Mean and strongest ratio of each text, from dictionaries of words."""
    from weir.llm.text_arrays import separator_table

    gap = separator_table(toxicity._MARKS)

    def words(text):
        data = bytes(32 if gap[b] else b for b in (text or "").encode().lower())
        return data.split()

    cls = {"toxic": Counter(), "ordinary": Counter()}
    before = defaultdict(set)
    for i, text in rows:
        if i in labels and crc32(str(i).encode()) % 5 not in (0, toxicity.SCALE_FOLD):
            own = words(text)
            cls["toxic" if labels[i] else "ordinary"].update(set(own))
            for a, b in zip([None, *own], own):
                before[b].add(a)
    pairs, v = sum(map(len, before.values())), max(len(before), 1)
    parts = []
    for counts in cls.values():
        cut = [0, *toxicity._discounts([sum(c == k for c in counts.values()) for k in (1, 2, 3, 4)])]
        parts.append((counts, cut, sum(counts.values()), sum(cut[min(c, 3)] for c in counts.values())))

    def p(word, counts, cut, size, left):
        low = (len(before[word]) + toxicity.FLOOR) / (pairs + toxicity.FLOOR * v)
        c = counts[word]
        return (c - cut[min(c, 3)]) / size + left / size * low if size else low

    ratio = {w: math.log(p(w, *parts[0])) - math.log(p(w, *parts[1])) for w in list(before)}
    n = {w: cls["toxic"][w] + cls["ordinary"][w] for w in ratio}
    others = [w for w in ratio if not cls["toxic"][w]]
    rest = sum(ratio[w] * n[w] for w in others) / sum(n[w] for w in others) if others else 0.0
    out = []
    for i, text in rows:
        own = [ratio[w] if cls["toxic"][w] else rest for w in words(text)]
        out.append((i, len(own), sum(own) / len(own) if own else 0.0, max(own, default=0.0)))
    return out


def test_evidence_is_that_of_dictionaries(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(100 + i, passage(i, 30) + (" Übel! schlimm" if i % 3 == 0 else "")) for i in range(60)]
    labels = {i: int(i % 3 == 1) for i in range(10, 45)} | {100 + i: int(i % 3 == 0) for i in range(60)}
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(3)
    taught = spark.createDataFrame(list(labels.items()), "doc_id BIGINT, toxic INT")
    found = sorted((tuple(r) for r in toxicity.score(df, taught).select("doc_id", "n_words", "mean", "strongest").collect()), key=repr)
    want = sorted(plain_toxicity(rows, labels), key=repr)
    assert [f[:2] for f in found] == [w[:2] for w in want]
    for f, w in zip(found, want):
        assert f[2:] == pytest.approx(w[2:], rel=1e-4, abs=1e-5)


def test_held_out_labels_teach_nothing(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents", "doc_id", "text")
    labels = read(spark, "/root/testdata/sf0.01", "labels", "doc_id", "toxic")
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    one = {r.doc_id: r.score for r in toxicity.score(docs, labels).collect()}
    assert one == {r.doc_id: r.score for r in toxicity.score(docs, turned).collect()}


def test_toxicity_rows(spark, docs, no_docs):
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(10, 45)] + [(12, None), (None, 1), (13, 1)], "doc_id BIGINT, toxic INT")
    found = toxicity.score(docs, labels).collect()
    assert len(found) == docs.count()
    assert all(r.held_out == (r.doc_id is not None and crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert toxicity.score(no_docs, labels).count() == 0
    assert {r.score for r in toxicity.score(docs, labels.where("false")).collect()} == {0.5}


# --- quality ----------------------------------------------------------------------------------


def plain_model(texts, alphabet=None):
    """Interpolated modified Kneser-Ney by dictionaries; the same cuts and limits as the operator's."""
    counts = [Counter() for _ in range(quality.ORDER + 1)]
    for t in texts:
        counts[quality.ORDER].update(map(int, quality.codes([t], alphabet)[0]))
    bits = quality.BITS
    for k in range(quality.ORDER - 1, 0, -1):
        for code in counts[k + 1]:
            counts[k][code & ((1 << bits * k) - 1)] += 1
    parts = []
    for k in range(1, quality.ORDER + 1):
        n = [max(sum(c == j for c in counts[k].values()), 0.5) for j in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        cuts = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]]
        cuts = [max(min(d, 0.95 * j), 0.05) for j, d in enumerate(cuts, 1)]
        total, left = defaultdict(float), defaultdict(float)
        for code, c in counts[k].items():
            total[code >> bits] += c
            left[code >> bits] += cuts[min(c, 3) - 1]
        parts.append((counts[k], cuts, total, left))

    def p(code, k):
        if k == 0:
            return 1 / quality.SYMBOLS
        seen, cuts, total, left = parts[k - 1]
        low = p(code & ((1 << bits * (k - 1)) - 1), k - 1)
        h = code >> bits
        if h not in total:
            return low
        c = seen.get(code, 0)
        return (c - (cuts[min(c, 3) - 1] if c else 0)) / total[h] + left[h] / total[h] * low

    return lambda code: -math.log(p(code, quality.ORDER))


def test_model_is_the_plain_one(spark):
    texts = [passage(i, 40) + " Éa 12, (x)!" for i in range(30)]
    rows = spark.createDataFrame([("xx", t) for t in texts], "lang STRING, text STRING").repartition(4)
    table = quality.dense(quality.probabilities(quality.count_ngrams(rows)))["xx"]
    want = plain_model([t.encode() for t in texts])
    r = random.Random(1)
    seen = quality.codes([t.encode() for t in texts])[0].tolist()
    for code in r.sample(seen, 300) + [r.randrange(1 << 20) for _ in range(300)]:
        assert table[code] == pytest.approx(want(code), rel=1e-4)
    context = r.randrange(1 << 15) << 5
    assert np.exp(-table[context : context + 32].astype(float)).sum() == pytest.approx(1, rel=1e-4)


def test_symbols():
    code, first = quality.codes(["aé".encode(), b"", b"B 1"])
    assert first.tolist() == [0, 2, 2, 5]
    assert code.tolist() == [1, 1 << 5 | quality.kinds()[ord("é")], 27, 27 << 5 | 0, 27 << 10 | 0 << 5 | 28]


def test_alphabet_deals_letters_by_frequency():
    counts = {0x410 + 32 + i: 1000 - 25 * i for i in range(33)}  # small letters of an alphabet of 33
    table = quality.alphabet(counts)
    first = [table[c] for c in list(counts)[:20]]
    assert sorted(first) == sorted(set(first)) and set(table[list(counts)]) == set(range(1, 27))
    assert table[ord("A")] == table[0x410] == quality.CAPITAL and table[ord("7")] == quality.DIGIT and table[ord("\n")] == quality.SPACE
    many = {0x4E00 + i: 10 for i in range(2600)}
    assert set(np.bincount(quality.alphabet(many)[list(many)])[1:27]) == {100}
    assert quality.codes(["\U00020000x"])[0].tolist() == [quality.symbols(np.array([0x20000], np.uint32), quality.kinds())[0], (0x20000 - 97) % 26 + 1 << 5 | 24]


def language(seed, letters, n_words):
    """Words of a vocabulary made of the letters; one seed is one language."""
    r = random.Random(seed)
    syllables = ["".join(r.sample(letters, r.randint(1, 3))) for _ in range(60)]
    return lambda k: " ".join("".join(random.Random(f"{k} {i}").choices(syllables, k=2)) for i in range(n_words))


def junk(text, letters, seed):
    r = random.Random(seed)
    return "".join(c if c == " " else r.choice(letters) for c in text)


def test_junk_is_rejected_in_every_script(spark):
    scripts = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": [chr(0x430 + i) for i in range(32)],
               "greek": [chr(0x3B1 + i) for i in range(24)], "han": [chr(0x4E00 + 7 * i) for i in range(400)]}
    rows, good, bad = [], [], []
    for k, (name, letters) in enumerate(scripts.items()):
        text = language(k, letters, 120)
        rows += [(1000 * k + i, name, text(f"{k} {i}")) for i in range(200)]
        rows += [(1000 * k + 500 + i, name, junk(text(f"{k} {i}"), letters, i)) for i in range(50)]
        good += range(1000 * k + 150, 1000 * k + 200)
        bad += range(1000 * k + 500, 1000 * k + 550)
    docs = spark.createDataFrame(rows, "doc_id BIGINT, lang STRING, text STRING").repartition(4)
    labels = spark.createDataFrame([(i, 1) for i, _, _ in rows if i % 1000 < 150], "doc_id BIGINT, quality INT")
    keep = {r.doc_id: r.keep for r in quality.classify(docs, labels).collect()}
    assert sum(keep[i] for i in good) >= 0.97 * len(good)
    for k, name in enumerate(scripts):
        assert not any(keep[i] for i in bad if i // 1000 == k), name


def plain_classes(rows, trusted):
    """The decision from dictionaries: a model and a quantile for each language, one of all for the rest."""
    letters, every = defaultdict(Counter), Counter()
    own_kind = quality.kinds()
    for _, lang, text in rows:
        for c in text or "":
            if ord(c) < quality.CHARACTERS and 1 <= own_kind[ord(c)] <= 26:
                letters[lang or "*"][ord(c)] += 1
                every[ord(c)] += 1
    tables = {lang: quality.alphabet(n) for lang, n in letters.items()} | {"*": quality.alphabet(every)}
    known = [r for r in rows if r[0] in trusted and r[2] is not None]
    models = {lang: plain_model([t for _, x, t in known if x == lang], tables[lang]) for lang in {x for _, x, _ in known if x}}
    models["*"] = plain_model([t for _, _, t in known], tables["*"])
    scored = []
    for i, lang, text in rows:
        name = lang if lang in models else "*"
        code = quality.codes([text], tables[name])[0].tolist()
        scored.append((i, name, len(code), sum(map(models[name], code))))
    own = [s for s in scored if s[0] in trusted and s[2]]
    out = {}
    for i, name, n, nats in scored:
        group = [s for s in own if name in ("*", s[1])]
        mean = sum(s[3] for s in group) / sum(s[2] for s in group)
        bins = sorted(math.floor((s[3] + quality.PRIOR * mean) / (s[2] + quality.PRIOR) / quality.GRID) for s in group)
        at = bins[math.ceil(len(bins) * quality.QUANTILE) - 1]
        limit = (at + 1) * quality.GRID * quality.MARGIN
        drawn = (nats + quality.PRIOR * mean) / (n + quality.PRIOR)
        out[i] = (n, math.exp(drawn), math.exp(limit), drawn <= limit)
    return out


def test_decision_is_the_plain_one(spark):
    rows = [(10 * k + i, lang, language(k, letters, 12 + i)(i)) for k, (lang, letters) in enumerate([("a", "abcdefg"), ("b", "αβγδε"), (None, "xyz"), ("none", "pqr")]) for i in range(8)]
    rows += [(90, "a", None), (91, "b", ""), (92, "a", "Zq 7?! %")]
    trusted = {i for i, lang, _ in rows if lang in ("a", "b") and i % 3}
    docs = spark.createDataFrame(rows, "doc_id BIGINT, lang STRING, text STRING").repartition(3)
    labels = spark.createDataFrame([(i, 1) for i in trusted], "doc_id BIGINT, quality INT")
    found = {r.doc_id: (r.n_symbols, r.perplexity, r.threshold, r.keep) for r in quality.classify(docs, labels).collect()}
    want = plain_classes(rows, trusted)
    assert found.keys() == want.keys()
    for i, (n, perplexity, threshold, keep) in want.items():
        assert found[i][0] == n and found[i][3] == keep
        assert found[i][1:3] == pytest.approx((perplexity, threshold), rel=2e-3)


def test_many_languages_cost_no_more_reads(spark, tmp_path):
    """Three blocks of languages: tasks change between their tables, and the documents are scanned as often as for one."""
    def scans(n):
        rows = [(100 * k + i, f"l{k:02}", passage(k, 30)) for k in range(n) for i in range(4)]
        path = str(tmp_path / f"docs-{n}")
        spark.createDataFrame(rows, "doc_id BIGINT, lang STRING, text STRING").repartition(2).write.parquet(path)
        docs = spark.read.parquet(path)
        labels = spark.createDataFrame([(i, 1) for i, _, _ in rows], "doc_id BIGINT, quality INT")
        seen, plain = [], quality.surprise
        quality.surprise = lambda d, *more: seen.append(d) or plain(d, *more)
        try:
            found = quality.classify(docs, labels).collect()
        finally:
            quality.surprise = plain
        assert len(found) == len(rows) and all(r.keep for r in found)
        return len(seen), len({r.threshold for r in found})

    passes, thresholds = scans(40)
    assert passes == 1 and thresholds >= 30  # a language has its own but where steps of the quantile coincide


def test_clean_documents_stay(spark):
    docs = read(spark, "/root/testdata/sf0.1", "documents")
    labels = read(spark, "/root/testdata/sf0.1", "labels", "doc_id", "quality")
    found = quality.classify(docs, labels).join(labels, "doc_id").groupBy("quality").agg({"*": "count", "keep": "max"})
    kept = {r.quality: r.n for r in quality.classify(docs, labels).where("keep").join(labels, "doc_id").groupBy("quality").count().withColumnRenamed("count", "n").collect()}
    total = {r.quality: r["count(1)"] for r in found.collect()}
    assert kept[1] / total[1] > 0.99 and kept[0] / total[0] < 0.2


def test_every_language_has_its_own_model(spark):
    """Twenty languages; the smallest has trusted text of its own, unlike that of the others."""
    rows = [(100 * k + i, f"l{k:02}", passage(100 * k + i, 60)) for k in range(19) for i in range(20)]
    rows += [(5000 + i, "z", "quux vyk zzyx kwj " * 8) for i in range(3)]
    rows += [(6000, None, passage(6000, 60)), (6001, "none", passage(6001, 60)), (6002, None, None)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, lang STRING, text STRING").repartition(4)
    labels = spark.createDataFrame([(i, 1) for i, lang, _ in rows if lang not in (None, "none")], "doc_id BIGINT, quality INT")
    found = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert sorted(found) == sorted(i for i, _, _ in rows)
    assert all(found[i].keep and found[i].perplexity < 3 for i in range(5000, 5003))
    limits = {lang: {found[i].threshold for i, own, _ in rows if own == lang} for lang in {own for _, own, _ in rows}}
    assert all(len(x) == 1 for x in limits.values()) and limits[None] == limits["none"]
    assert limits["z"].isdisjoint(limits[None]) and max(limits["z"]) < 3.5


def test_quality_rows(spark, docs, no_docs):
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(10, 45)] + [(12, None), (None, 1)], "doc_id BIGINT, quality INT")
    found = quality.classify(docs, labels)
    assert found.count() == docs.count()
    assert quality.classify(no_docs, labels).count() == 0
    assert quality.classify(docs, labels.where("false")).where("keep").count() == docs.count()
    assert found.where("doc_id IN (10, 11) AND keep").count() == 2
    assert quality.kept(docs, labels).columns == docs.columns or set(quality.kept(docs, labels).columns) == set(docs.columns)


# --- neighbours -------------------------------------------------------------------------------


def plain_nearest(rows, k=20, every=20):
    rows = sorted({(i, tuple(v)) for i, v in rows})
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    out = []
    for q in np.flatnonzero(ids % every == 0):
        scores = neighbours.products(x[q : q + 1], x)[0]
        best = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[q]][:k]
        out += [(int(ids[q]), r, int(ids[j]), float(scores[j])) for r, j in enumerate(best, 1)]
    return sorted(out)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id BIGINT, embedding ARRAY<FLOAT>, list STRING").repartition(3)


def test_small_tables_are_exact(spark):
    r = np.random.default_rng(4)
    rows = [(i, [float(np.float32(v)) for v in r.normal(size=8)]) for i in range(150)]
    rows += [(200 + i, rows[0][1]) for i in range(60)] + [rows[3], (301, [0.0] * 8), (302, None), (303, []), (304, [float("nan")] + [1.0] * 7)]
    rows += [(305, [None] + [1.0] * 7), (306, [float("inf")] * 8), (307, [1.0, 2.0]), (None, [1.0] * 8)]
    found = sorted(tuple(x) for x in neighbours.nearest(vectors(spark, rows)).collect())
    assert found == plain_nearest(rows[:210])


@pytest.mark.parametrize("n", [0, 1, 2, 15])
def test_few_vectors(spark, n):
    rows = [(20 * i, [1.0 + i, 2.0]) for i in range(n)]
    assert sorted(tuple(x) for x in neighbours.nearest(vectors(spark, rows)).collect()) == plain_nearest(rows)[: n * n]


def test_blocks_of_a_list(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    r = np.random.default_rng(5)
    rows = [(i, [float(np.float32(v)) for v in r.normal(size=4)]) for i in range(120)]
    assert sorted(tuple(x) for x in neighbours.nearest(vectors(spark, rows)).collect()) == plain_nearest(rows)


def test_recall(spark):
    table = read(spark, "/root/testdata/sf0.1", "embeddings", "vec_id", "embedding")
    found = {(r.query_id, r.vec_id) for r in neighbours.nearest(table).collect()}
    want = {(q, v) for q, _, v, _ in plain_nearest([(r.vec_id, r.embedding) for r in table.collect()])}
    assert len(found & want) >= 0.9 * len(want) and len(found) == len(want)


def test_graph_search_finds_the_nearest_centres():
    r = np.random.default_rng(6)
    x = r.normal(size=(4000, 16))
    length = float(np.sqrt((x**2).sum(1)).max())
    index = neighbours.Index.fit(x, length, 300)
    points = neighbours.lifted(x[:200], length)
    at, far = index.search(points, 10, 40)
    d = np.sqrt(((points[:, None] - index.centres[None]) ** 2).sum(2))
    want = np.argsort(d, axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) for a, b in zip(at, want, strict=True)]) > 9
    assert np.allclose(far, np.take_along_axis(d, at, 1))
    sizes = [len(p) for p in neighbours._halves(x, np.arange(len(x)), 300)]
    assert max(sizes) - min(sizes) <= 2 and sum(sizes) == len(x)


def test_the_most_telling_words_are_taken(spark):
    rated = spark.createDataFrame([(i, i % 5, 3, (i - 40) / 10) for i in range(100)], "word BIGINT, toxic BIGINT, ordinary BIGINT, ratio DOUBLE")
    word, ratio, rest = toxicity.telling(rated, 10**6)
    assert sorted(word.tolist()) == [i for i in range(100) if i % 5] and list(word) == sorted(word)
    few, own, mean = toxicity.telling(rated, 12)
    weight = {i: abs(i - 40) / 10 * (i % 5) for i in range(100)}
    assert 0 < len(few) <= 12 and min(weight[w] for w in few.tolist()) >= max(w for i, w in weight.items() if i not in few.tolist())
    left = [i for i in range(100) if i not in few.tolist()]
    assert mean == pytest.approx(sum((i - 40) / 10 * (i % 5 + 3) for i in left) / sum(i % 5 + 3 for i in left))


def test_words_beyond_the_tables_of_tasks_are_looked_up(spark, docs):
    from pyspark.sql import functions as F

    rows = docs.select("doc_id", "text").unionByName(docs.limit(3).select(F.lit(None).cast("bigint").alias("doc_id"), "text"))
    labels = spark.createDataFrame([(i, int(i % 3 == 1)) for i in range(10, 45)], "doc_id BIGINT, toxic INT")

    def found(words):
        return sorted((tuple(r) for r in toxicity.score(rows, labels, words).collect()), key=repr)

    every = found(toxicity.WORDS)
    for words in (0, 4):
        few = found(words)
        assert [f[:2] for f in few] == [f[:2] for f in every]
        for f, w in zip(few, every, strict=True):
            assert f[2:] == pytest.approx(w[2:], rel=1e-5, abs=1e-6)


def test_letters_of_all_planes_are_dealt_by_frequency(spark):
    import unicodedata

    assert not any(unicodedata.category(chr(c))[0] in "LN" for c in range(quality.CHARACTERS, 0x110000))
    letters = [0x10400 + 40 + i for i in range(0, 27)]  # Deseret small letters; the first and the last share a number modulo 26
    text = "".join(chr(c) * (40 - i) for i, c in enumerate(letters[:26]))
    rows = spark.createDataFrame([("x", text + "\U0001F600\U000E0101")], "lang STRING, text STRING")
    counted = {r.letter: r.n for r in quality.count_letters(rows).collect()}
    assert counted == {c: 40 - i for i, c in enumerate(letters[:26])}
    table = quality.alphabet(counted)
    data = np.array([*letters[:26], 0x1F600, 0xE0101, 0xF0000], np.uint32)
    found = quality.symbols(data, table).tolist()
    assert found[:26] == list(range(1, 27)) and found[26:] == [quality.SIGN, quality.MARK, quality.SIGN]
