"""Two tokenizers' cuts of the same texts, laid over each other.

Tokens of both are intervals of bytes. All intervals of a batch are sorted by start and their ends accumulated to a running
maximum; where a start reaches that maximum both tokenizers cut, and a group begins. Within the groups, overlapping
intervals are links. How many documents hold a link of two ids is counted over the whole corpus: tasks number the
different id pairs of a block of documents, so a pair is sent once for a block, not once for a document, to be counted and to
bring its count back.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weir.llm.common import sealed, small_batches
from weir.llm.token_counts import CUT

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"

SPACE = "▁"

# Texts of these characters are cut into words alike by any version of Unicode.
_SETTLED = re.compile("[\t\n\r\x20-\x7e¡-¬®-ɏ–—‘-”…]*")

# Bytes of text that are aligned at once, and different id pairs of documents that a block holds before it is closed.
PIECE = 1 << 18
BLOCK = 1 << 20
BLOCK_DOCS = 1 << 16

_DOC = "doc_id BIGINT, n_a BIGINT, n_b BIGINT, n_groups BIGINT, n_links BIGINT"
_RESULT = f"{_DOC}, n_best BIGINT, count_sum BIGINT, groups_sha256 STRING"
_TABLE = f"block BIGINT, {_DOC}, groups_sha256 STRING, pairs BINARY, times BINARY, a ARRAY<INT>, b ARRAY<INT>, docs ARRAY<INT>"


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it prints, else the next from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteCutter:
    """A byte-level tokenizer: ids of texts, and the bytes of each id.

    A vocabulary whose ids are in the order of its merges is also one of ranks, and a faster encoder of ranks gives the same ids for
    texts that both cut alike.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        letters, vocabulary = _byte_letters(), self.tokenizer.get_vocab(with_added_tokens=False)
        self.parts = [b""] * self.tokenizer.get_vocab_size()
        for piece, i in vocabulary.items():
            self.parts[i] = bytes([letters[x] for x in piece])
        with open(path, encoding="utf-8") as file:  # the vocabulary is on every machine
            merges = [m if isinstance(m, str) else " ".join(m) for m in json.load(file)["model"]["merges"]]
        order = [vocabulary[m.replace(" ", "")] for m in merges]
        ranks = {part: i for i, part in enumerate(self.parts) if part}
        in_order = order == sorted(order) and len(ranks) == len(vocabulary)
        self.ranks = tiktoken.Encoding("own", pat_str=CUT, mergeable_ranks=ranks, special_tokens={}) if in_order else None

    def ids(self, texts: list[str]) -> list[list[int]]:
        alike = [self.ranks is not None and bool(_SETTLED.fullmatch(t)) for t in texts]
        other = [t for t, same in zip(texts, alike, strict=True) if not same]
        whole = iter(self.tokenizer.encode_batch_fast(other, add_special_tokens=False))
        return [self.ranks.encode_ordinary(t) if same else next(whole).ids for t, same in zip(texts, alike, strict=True)]


class PieceCutter:
    """A tokenizer of pieces that puts a space in front of each text."""

    def __init__(self, path: str):
        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(i) for i in range(model.vocab_size())]
        self.parts = [
            bytes([int(p[3:-1], 16)]) if model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)
        ]

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode([t[1:] for t in texts], num_threads=1)


def encode(cutter: ByteCutter | PieceCutter, texts: list[str]) -> list[np.ndarray | None]:
    """Ids of texts that begin with a space; None where the ids' bytes are not those of the text."""
    parts = cutter.parts
    return [
        np.array(ids, np.int32) if b"".join([parts[i] for i in ids]) == text.encode() else None
        for text, ids in zip(texts, cutter.ids(texts), strict=True)
    ]


@lru_cache(maxsize=2)
def cutters(a_path: str, b_path: str) -> tuple[ByteCutter, PieceCutter, np.ndarray, np.ndarray, list[str]]:
    """Both tokenizers, the bytes of their ids, and every id as text before each of the three separators."""
    a, b = ByteCutter(a_path), PieceCutter(b_path)
    sizes = [np.array([len(p) for p in cutter.parts], np.int64) for cutter in (a, b)]
    most = max(map(len, sizes))
    return a, b, *sizes, [f"{i}{mark}" for mark in ",|;" for i in range(most)]


def align(texts: list[str | None], a_path: str = BYTE_BPE, b_path: str = PIECE_BPE) -> list[tuple]:
    """``(n_a, n_b, n_groups, n_links, groups, codes, times)`` of each text.

    ``codes`` are its different linked id pairs, ``a * ids of B + b`` in order, ``times`` how many links each has.
    """
    a, b, size_a, size_b, names = cutters(a_path, b_path)
    out: list[tuple] = [(0, 0, 0, 0, "", np.empty(0, np.int64), np.empty(0, np.uint32))] * len(texts)
    at = [i for i, t in enumerate(texts) if t]
    spaced = [" " + texts[i] for i in at]
    both = [(i, x, y) for i, x, y in zip(at, encode(a, spaced), encode(b, spaced), strict=True) if x is not None and y is not None]
    if not both:
        return out
    where, ids_a, ids_b = zip(*both, strict=True)
    n_a, n_b = np.array([len(x) for x in ids_a]), np.array([len(x) for x in ids_b])
    ids_a, ids_b = np.concatenate(ids_a), np.concatenate(ids_b)
    # Both cut each text to its last byte, so offsets run on from text to text.
    ends_a, ends_b = np.cumsum(size_a[ids_a]), np.cumsum(size_b[ids_b])
    starts_a, starts_b = ends_a - size_a[ids_a], ends_b - size_b[ids_b]

    side = np.repeat(np.arange(2), [len(ids_a), len(ids_b)])
    start, end = np.concatenate([starts_a, starts_b]), np.concatenate([ends_a, ends_b])
    order = np.lexsort((side, start))
    reached = np.maximum.accumulate(end[order])
    begins = np.ones(len(order), bool)
    begins[1:] = start[order][1:] >= reached[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(begins)

    doc = np.concatenate([np.repeat(np.arange(len(where)), n) for n in (n_a, n_b)])
    n_groups = np.bincount(doc[order[begins]], minlength=len(where))
    # Groups are apart, so the tokens of B that lie over one of A are those of its group from the first that ends behind its start.
    low, high = np.searchsorted(ends_b, starts_a, "right"), np.searchsorted(starts_b, ends_a, "left")
    n = high - low
    x = np.repeat(np.arange(len(ids_a)), n)
    y = np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
    n_links = np.bincount(doc[x], minlength=len(where))
    pairs = len(size_a) * len(size_b)
    codes, times = np.unique(doc[x] * pairs + ids_a[x].astype(np.int64) * len(size_b) + ids_b[y], return_counts=True)
    first = np.searchsorted(codes, np.arange(len(where) + 1) * pairs)
    codes, times = codes % pairs, times.astype(np.uint32)

    key = 2 * group + side
    order = np.argsort(key, kind="stable")
    step = np.diff(key[order], append=key[order[-1]] + 2)
    mark = np.where(step == 0, 0, np.where((step == 1) & (key[order] % 2 == 0), 1, 2))
    named = mark * (len(names) // 3) + np.concatenate([ids_a, ids_b])[order]
    last = np.cumsum(n_a + n_b)
    for k, i in enumerate(where):
        text = "".join([names[j] for j in named[last[k] - n_a[k] - n_b[k] : last[k]].tolist()])[:-1]
        part = slice(first[k], first[k + 1])
        out[i] = (int(n_a[k]), int(n_b[k]), int(n_groups[k]), int(n_links[k]), text, codes[part], times[part])
    return out


def _planes(values: np.ndarray) -> bytes:
    """Numbers by bytes of equal weight: of small ones all but the lowest are zeros, which compress to nothing."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.frombuffer(planes, np.uint8).reshape(4, -1).T.copy().view("<u4")[:, 0]


def _pieces(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of :data:`PIECE` characters or one text."""
    first = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= PIECE:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def _aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """A row for each document, its id pairs by their place in its block, and a row for each block: its pairs and their documents."""
    schema = pa.schema(
        [("block", pa.int64()), ("doc_id", pa.int64()), *[(n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")]]
        + [("groups_sha256", pa.string()), ("pairs", pa.binary()), ("times", pa.binary())]
        + [(n, pa.list_(pa.int32())) for n in ("a", "b", "docs")]
    )

    def closed(block: int, rows: list[tuple], codes: list[np.ndarray], n_b: int) -> Iterator[pa.RecordBatch]:
        different, place = np.unique(np.concatenate(codes), return_inverse=True)
        last = 0
        out = []
        for row, own in zip(rows, codes, strict=True):
            places = place[last : last + len(own)]
            last += len(own)
            out.append((block, *row[:-1], _planes(np.diff(places, prepend=0)), _planes(row[-1]), None, None, None))
        numbered = [different // n_b, different % n_b, np.bincount(place, minlength=len(different))]
        out.append((block, *[None] * 8, *[x.astype(np.int32) for x in numbered]))
        for i in range(0, len(out), 4096):
            part = zip(*out[i : i + 4096], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(part, schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, rows, codes, n_b = TaskContext.get().partitionId() << 32, 0, [], [], 1
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            n_b = len(cutters(a_path, b_path)[3])
            for low, high in _pieces(texts):
                for doc_id, found in zip(ids[low:high], align(texts[low:high], a_path, b_path), strict=True):
                    *counts, groups, own, times = found
                    digest = sha256(groups.encode()).hexdigest() if groups else ""
                    rows.append((doc_id, *counts, digest, times))
                    codes.append(own)
                    held += len(own)
                if held >= BLOCK or len(rows) >= BLOCK_DOCS:
                    yield from closed(number, rows, codes, n_b)
                    number, held, rows, codes = number + 1, 0, [], []
        if rows:
            yield from closed(number, rows, codes, n_b)

    small_batches(docs.sparkSession)
    return sealed(docs.select("doc_id", "text").mapInArrow(run, _TABLE), "alignment-blocks")


def _summed(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """Counts of a block's pairs, brought to its documents."""
    n, best = np.zeros(counts.num_rows, np.int64), np.zeros(counts.num_rows, bool)
    place = counts["place"].to_numpy()
    n[place], best[place] = counts["n"].to_numpy(), counts["best"].to_numpy(zero_copy_only=False)
    sums, bests = [], []
    for pairs, times in zip(docs["pairs"].to_pylist(), docs["times"].to_pylist(), strict=True):
        places, times = np.cumsum(_numbers(pairs), dtype=np.int64), _numbers(times).astype(np.int64)
        sums.append(int(n[places] @ times))
        bests.append(int(best[places] @ times))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    columns = [*[docs[c] for c in names], pa.array(bests, pa.int64()), pa.array(sums, pa.int64()), docs["groups_sha256"]]
    return pa.Table.from_arrays(columns, [*names, "n_best", "count_sum", "groups_sha256"])


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``(a, b, n, best)``: documents that hold each linked id pair, and whether no pair of ``a`` has more."""
    rows = blocks.where("a IS NOT NULL").select(F.inline(F.arrays_zip("a", "b", "docs")))
    counted = sealed(rows.groupBy("a", "b").agg(F.sum("docs").alias("n")), "alignment-counts")
    most = sealed(counted.groupBy("a").agg(F.max("n").alias("most")), "alignment-most")
    return counted.join(most, "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def alignments(docs: DataFrame, a_path: str = BYTE_BPE, b_path: str = PIECE_BPE) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``, one row for every row of ``docs``.

    Texts are encoded with a space in front, as both tokenizers want it, and special tokens are plain text in them. A text that
    is NULL or empty, or whose tokens do not give its bytes back (a text with U+2581), has no tokens: zeros and an empty
    digest. NULL and repeated ids are carried along, each row counts as a document; other columns are not read.

    A block holds :data:`BLOCK` different pairs of documents or one text's, so what meets in a task is bounded by these and by
    the longest text, and a pair that stands in most documents costs one row for a block.
    """
    blocks = _aligned(docs, a_path, b_path)
    pairs = blocks.where("a IS NOT NULL").select(F.col("block").alias("asked_by"), F.posexplode(F.arrays_zip("a", "b")).alias("place", "pair"))
    asked = pairs.select("asked_by", "place", "pair.a", "pair.b").join(sealed(pair_counts(blocks), "alignment-pairs"), ["a", "b"])
    answers = asked.select("asked_by", "place", "n", "best").groupBy("asked_by")
    rows = blocks.where("a IS NULL").drop("a", "b", "docs").groupBy("block")
    return rows.cogroup(answers).applyInArrow(_summed, _RESULT)
