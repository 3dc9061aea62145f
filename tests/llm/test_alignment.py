"""Cross-tokenizer alignment against a walk over both token lists."""

from collections import Counter, defaultdict
from hashlib import sha256

import pytest
import sentencepiece
from tokenizers import Tokenizer

from weir.llm import alignment

TEXTS = [
    "Hello world, it's a test.", "  two  spaces\n\n\tand tabs ", "Zürich Straße – “quoted” … 100%", "日本語のテキスト", "emoji 👩‍👩‍👧 ﬁ ①", "a▁b",
    "<s> </s> <unk> <0x41> <|endoftext|>", "\x00\x01 \x85   　x", "x" * 300, "don't we'll ''s 'S", "Привет мир", " ", "\n", "’tis", "a\r\nb", "\xad soft", "é é",
]


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(alignment.BYTE_BPE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_BPE)


def walk(text, a, b):
    """Ids of both, groups as text and all links, or nothing."""
    first, second = alignment.cutters(alignment.BYTE_BPE, alignment.PIECE_BPE)[:2]
    if not text:
        return None
    x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    p, q = [first.parts[i] for i in x], [second.parts[i] for i in y]
    if b"".join(p) != (" " + text).encode() or b"".join(q) != (" " + text).encode():
        return None
    i = j = end_a = end_b = 0
    groups, links, own = [], [], ([], [])
    while i < len(x):
        if end_a == end_b:
            own = ([x[i]], [y[j]])
            end_a, end_b = end_a + len(p[i]), end_b + len(q[j])
        elif end_a < end_b:
            i += 1
            own[0].append(x[i])
            end_a += len(p[i])
        else:
            j += 1
            own[1].append(y[j])
            end_b += len(q[j])
        links.append((own[0][-1], own[1][-1]))
        if end_a == end_b:
            groups.append("|".join(",".join(map(str, ids)) for ids in own))
            i, j = i + 1, j + 1
    return x, y, groups, links


def plain(texts, a, b):
    walked = [walk(t, a, b) for t in texts]
    held = Counter(link for w in walked if w for link in set(w[3]))
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for w in walked:
        if w is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            x, y, groups, links = w
            best = sum(held[link] == most[link[0]] for link in links)
            out.append((len(x), len(y), len(groups), len(links), best, sum(held[link] for link in links), sha256(";".join(groups).encode()).hexdigest()))
    return out


def check(df, rows, tokenizers):
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = [(i, *values) for (i, _), values in zip(rows, plain([t for _, t in rows], *tokenizers))]
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr)


def test_unusual_texts(spark, tokenizers):
    rows = [(i, t) for i, t in enumerate(TEXTS * 2)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(3)
    check(alignment.alignments(df), rows, tokenizers)


def test_documents(docs, no_docs, tokenizers):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(alignment.alignments(docs), rows, tokenizers)
    assert alignment.alignments(no_docs).collect() == []


def test_ids_are_what_the_tokenizers_give(spark, sf_dir, tokenizers):
    a, b, *_ = alignment.cutters(alignment.BYTE_BPE, alignment.PIECE_BPE)
    assert a.ranks is not None
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect() if r.text] + TEXTS
    assert b.ids([" " + t for t in texts]) == tokenizers[1].encode(texts)
    for text, ids in zip(texts, a.ids([" " + t for t in texts])):
        assert ids == tokenizers[0].encode(" " + text, add_special_tokens=False).ids, text


def test_small_blocks(spark, monkeypatch):
    """Documents are split over many blocks and their pairs counted over all of them."""
    texts = ["the cat sat", "the dog sat", "a cat and a dog", "", None, "the the the"] * 5

    def rows():
        return [tuple(r) for r in alignment.alignments(spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING").coalesce(1)).collect()]

    whole = rows()
    monkeypatch.setattr(alignment, "BLOCK", 4)
    monkeypatch.setattr(alignment, "PIECE", 10)
    assert sorted(rows()) == sorted(whole)


def test_numbers_by_planes():
    import numpy as np

    for values in ([], [0], [1, 255, 256, 70000, 2**31]):
        assert alignment._numbers(alignment._planes(np.array(values, np.int64))).tolist() == values
