"""Near-duplicates by SimHash: an inverted index of byte positions, with count filtering.

Fingerprints that differ in at most three bits differ in at most three of their eight bytes, so they share at least five
bytes at their positions. Of any five positions three lie in the same half, so the index lists fingerprints by
three bytes of a half. Within a list the bytes at the other five positions are listed again, shared ones are tallied for each
pair, and pairs that reach five are verified on all bits. A crowded list is dealt out by five bytes, which
leaves 24 bits and so at most 2**24 different fingerprints, looked up by their neighbours, not by pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from weir.llm.common import byte_texts, map_batches, sealed
from weir.llm.components import components, forest

SEED = 42

# Fingerprints are linked at this many differing bits or fewer, and then share this many bytes at least.
BITS = 3
SHARED = 8 - BITS

# Fingerprints of a list that are tallied pair by pair; pairs held at once.
CROWD = 1024
PAIRS = 1 << 21

# Bytes of a text that are cut into words at once.
PIECE = 1 << 20

_SEPARATOR = re.compile(rb"[ \t-\r]")

TRIPLES = [*combinations(range(4), 3), *combinations(range(4, 8), 3)]


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text with A-Z lower-cased, piece by piece."""
    start = 0
    while start < len(text):
        cut = _SEPARATOR.search(text, start + PIECE)
        end = cut.start() if cut else len(text)
        yield text[start:end].lower().split()  # Python splits bytes at space and TAB to CR
        start = end


def _shingle_hashes(text: bytes, size: int) -> Iterator[np.ndarray]:
    """XXH64 of the shingles of a text, repeats included; fewer words than ``size`` are one shingle."""
    before: list[bytes] = []
    short = True
    for words in _words(text):
        words = before + words
        if len(words) >= size:
            short = False
            line = b" ".join(words)
            ends = list(accumulate([len(w) + 1 for w in words]))
            starts = [0, *ends]
            hashes = [xxh64_intdigest(line[a : b - 1], SEED) for a, b in zip(starts, ends[size - 1 :], strict=False)]
            yield np.array(hashes, np.uint64)
        before = words[-(size - 1) :] if size > 1 else []
    if short and before:
        yield np.array([xxh64_intdigest(b" ".join(before), SEED)], np.uint64)


def fingerprint(text: bytes, size: int = 3) -> int:
    """A bit is 1 if set in over half the hashes of the shingles; a text without words has 0."""
    ones, n = np.zeros(64, np.int64), 0
    for hashes in _shingle_hashes(text, size):
        n += len(hashes)
        for i in range(0, len(hashes), 1 << 14):
            bits = np.unpackbits(hashes[i : i + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """``(doc_id, fingerprint BIGINT)`` of whole texts; a NULL text counts as empty."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        marks = np.array([fingerprint(t, size) for t in byte_texts(batch.column(1))], np.uint64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks.view(np.int64))], ["doc_id", "fingerprint"])

    return map_batches(docs.select("doc_id", "text"), run, "doc_id BIGINT, fingerprint BIGINT")


def _mask(positions: tuple[int, ...]) -> int:
    """The bits of some bytes, as a signed number."""
    bits = sum(0xFF << (8 * p) for p in positions)
    return bits - (1 << 64) if bits >> 63 else bits


@lru_cache(maxsize=1)
def _subsets() -> list[list[tuple[int, ...]]]:
    """The choices of :data:`SHARED` positions, each with the first triple in it: a pair is looked for there alone."""
    out: list[list[tuple[int, ...]]] = [[] for _ in TRIPLES]
    for chosen in combinations(range(8), SHARED):
        out[next(i for i, t in enumerate(TRIPLES) if set(t) <= set(chosen))].append(chosen)
    return out


def _bit_count(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _same_list(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ``i < j`` with equal keys."""
    order = np.argsort(keys, kind="stable")
    ordered, left, right = keys[order], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    at = np.arange(len(keys))
    step = 1
    while len(at := at[at + step < len(keys)]) and len(at := at[ordered[at] == ordered[at + step]]):
        left.append(order[at])
        right.append(order[at + step])
        step += 1
    return np.concatenate(left), np.concatenate(right)


def tallied(marks: np.ndarray, lists: np.ndarray, triple: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of members of the same list that share :data:`SHARED` bytes and differ in :data:`BITS` bits at most.

    All members of a list have the bytes of its triple in common; the others are counted.
    """
    rest = np.array([[p for p in range(8) if p not in t] for t in TRIPLES])[triple]
    octets = marks.astype("<u8").view(np.uint8).reshape(-1, 8)
    codes = []
    for k in range(rest.shape[1]):
        i, j = _same_list(lists.astype(np.int64) * 256 + octets[np.arange(len(marks)), rest[:, k]])
        codes.append(i * len(marks) + j)
    codes, shared = np.unique(np.concatenate(codes), return_counts=True)
    codes = codes[shared + 3 >= SHARED]
    i, j = codes // len(marks), codes % len(marks)
    near = _bit_count(marks[i] ^ marks[j]) <= BITS
    return i[near], j[near]


def neighbours(marks: np.ndarray, free: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that differ in at most :data:`BITS` bits of the ``free`` bytes and nowhere else, by looking up every change of each."""
    order = np.argsort(marks)
    ordered = marks[order]
    places = [8 * p + b for p in free for b in range(8)]
    left, right = [], []
    for n in range(1, BITS + 1):
        for bits in combinations(places, n):
            other = ordered ^ np.uint64(sum(1 << b for b in bits))
            at = np.searchsorted(ordered, other)
            at[at == len(ordered)] = 0
            hit = np.flatnonzero((ordered[at] == other) & (ordered < other))
            left.append(order[hit])
            right.append(order[at[hit]])
    return np.concatenate(left), np.concatenate(right)


def _edges(marks: np.ndarray, label: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(label != np.arange(len(label)))
    columns = [pa.array(marks[x].view(np.int64)) for x in (at, label[at])]
    return pa.RecordBatch.from_arrays(columns, ["a", "b"])


def _list_edges(lists: DataFrame) -> DataFrame:
    """``(a, b)`` of ``(triple, marks)``: members of a list with one that they are linked to, straight or by others of the list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            triple = batch.column(0).to_numpy()
            sizes = batch.column(1).value_lengths().to_numpy()
            marks = batch.column(1).flatten().to_numpy().view(np.uint64)
            first = np.concatenate([[0], np.cumsum(sizes)])
            start = 0
            work = np.cumsum(sizes.astype(np.int64) ** 2)
            while start < len(sizes):
                done = work[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(work, done + PAIRS, "right")))
                own, n = marks[first[start] : first[stop]], sizes[start:stop]
                at = np.repeat(np.arange(stop - start), n)
                yield _edges(own, forest(len(own), *tallied(own, at, np.repeat(triple[start:stop], n))))
                start = stop

    return lists.mapInArrow(run, "a BIGINT, b BIGINT")


def _dense_edges(lists: DataFrame) -> DataFrame:
    """The same of ``(free, marks)``, lists that have all bytes in common but the ``free`` ones."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for free, marks in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            own = marks.values.to_numpy().view(np.uint64)
            out.append(_edges(own, forest(len(own), *neighbours(own, tuple(free)))))
        return pa.Table.from_batches(out).combine_chunks().to_batches()[0] if any(b.num_rows for b in out) else out[0]

    return map_batches(lists, run, "a BIGINT, b BIGINT")


def links(marks: DataFrame) -> DataFrame:
    """``(a, b)`` over different fingerprints ``(mark)``: enough pairs to reach from each all that links lead to.

    A list of more than :data:`CROWD` members is never gathered; its members go on by every choice of five bytes that
    holds its three.
    """
    keyed = [F.struct(F.lit(i).alias("triple"), F.col("mark").bitwiseAND(F.lit(_mask(t))).alias("key")) for i, t in enumerate(TRIPLES)]
    rows = marks.select("mark", F.inline(F.array(*keyed)))
    sizes = sealed(rows.groupBy("triple", "key").agg(F.count("*").alias("n")).where("n > 1"), "simhash-lists")
    members = sealed(rows.join(sizes, ["triple", "key"]), "simhash-members")
    gathered = members.where(F.col("n") <= CROWD).groupBy("triple", "key").agg(F.collect_list("mark").alias("marks"))
    found = _list_edges(gathered.select("triple", "marks"))

    choices = []
    for i, subsets in enumerate(_subsets()):
        own = [
            F.struct(
                F.array(*[F.lit(p) for p in range(8) if p not in s]).alias("free"),
                F.col("mark").bitwiseAND(F.lit(_mask(s))).alias("five"),
            )
            for s in subsets
        ]
        choices.append(F.when(F.col("triple") == i, F.array(*own)))
    crowded = members.where(F.col("n") > CROWD).select("mark", F.inline(F.coalesce(*choices)))
    dense = crowded.groupBy("free", "five").agg(F.collect_list("mark").alias("marks")).where("size(marks) > 1")
    return sealed(found.unionByName(_dense_edges(dense.select("free", "marks"))).distinct(), "simhash-links")


def near_duplicates(docs: DataFrame, size: int = 3) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row for every row of ``docs``.

    The fingerprint has 16 lower-case hexadecimal digits; texts without words, empty or NULL, have zeros and are linked like
    any other. Equal fingerprints are one node, so copies cost a row each. Of repeated ids each row is looked at. A NULL
    id gives no component its name and has none: NULL. Other columns are not read.
    """
    found = sealed(fingerprints(docs, size), "simhash-fingerprints")
    marks = sealed(
        found.where("doc_id IS NOT NULL").groupBy(F.col("fingerprint").alias("mark")).agg(F.min("doc_id").alias("least")),
        "simhash-marks",
    )
    label = components(links(marks.select("mark"))).withColumnRenamed("node", "mark")
    named = marks.join(label, "mark", "left").select("mark", "least", F.coalesce("component", "mark").alias("component"))
    classes = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_mark = sealed(named.join(classes, "component").select(F.col("mark").alias("fingerprint"), "component_id"), "simhash-classes")
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    own = F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return found.join(of_mark, "fingerprint", "left").select("doc_id", digits.alias("fingerprint"), own.alias("component_id"))
