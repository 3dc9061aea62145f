"""Windows that stand more than once in a corpus, found in buckets of equal minimisers.

Shared by the deduplication of word windows and of byte windows. A unit is a word or a byte.

* Consecutive windows with the same minimiser (the gram of least hash in them) form a run. A run's units
  are what its windows cover together; equal windows have equal minimisers.
* Only runs whose minimiser stands elsewhere too can hold a repeated window; they are packed and sent to the
  bucket of their minimiser. Equal packed runs travel once, with their number and their first place.
* In a bucket, windows of different runs are compared; the callers say how.
* A minimiser with very many different runs is not gathered: its windows are grouped one by one.

Equal texts are looked at once. Results are rows for texts, joined to documents by the text's digest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import md5, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm.common import byte_texts, lists, map_batches, sealed, small_batches

# Different runs of one minimiser a task compares together; more go window by window.
GATHERED = 20_000

_LAST = (1 << 63) - 1

EMPTY_SHA256 = sha256(b"").hexdigest()


@dataclass(frozen=True)
class Units:
    """How texts fall into units.

    ``grams(texts)`` gives a hash for each unit (of the gram that begins there) and where each text's units begin,
    ``body(text)`` the bytes that digests are made of, ``count(body)`` the number of units. ``slicer(text)(start, n)`` gives the
    bytes of ``n`` units; ``glue`` stands between parts that are put together again.
    """

    length: int
    gram: int
    grams: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]
    body: Callable[[bytes], bytes]
    count: Callable[[bytes], int]
    slicer: Callable[[bytes], Callable[[int, int], bytes]]
    glue: bytes = b""


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """For each place the place of the least of ``width`` values from there on, the first among equals."""
    n = len(values)
    if n < width:
        return np.empty(0, np.int64)
    at, best, size = np.arange(n), values, 1

    def joined(best, at, step):
        left, right = best[:-step], best[step:]
        take = left <= right
        return np.where(take, left, right), np.where(take, at[:-step], at[step:])

    while 2 * size <= width:
        best, at = joined(best, at, size)
        size *= 2
    if size < width:
        best, at = joined(best, at, width - size)
    return at


def runs_of_windows(hashes: np.ndarray, first: np.ndarray, units: Units):
    """Runs of all texts: text, start in it, number of windows, distance of the minimiser from the start, its hash."""
    n = np.diff(first)
    least = sliding_least(hashes, units.length - units.gram + 1)
    doc = np.repeat(np.arange(len(n)), n)[: len(least)]
    place = np.arange(len(least)) - first[doc]
    inside = place + units.length <= n[doc]
    doc, place, least = doc[inside], place[inside], least[inside]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (least[1:] != least[:-1])
    at = np.flatnonzero(new)
    windows = np.diff(np.append(at, len(doc)))
    return doc[at], place[at], windows, least[at] - first[doc[at]] - place[at], hashes[least[at]]


def survey(docs: DataFrame, units: Units) -> DataFrame:
    """``(doc_id, did, key, n, sha, h, start, windows, off)``: a row for a document, arrays over its runs.

    ``did`` stands for the id, with NULL as the largest; ``key`` is the text's digest.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = byte_texts(batch.column(1))
        bodies = [units.body(t) for t in texts]
        hashes, first = units.grams(texts)
        doc, start, windows, off, h = runs_of_windows(hashes, first, units)
        offsets = np.searchsorted(doc, np.arange(batch.num_rows + 1))
        columns = [
            batch.column(0),
            batch.column(0).fill_null(_LAST),
            pa.array([md5(b).digest() for b in bodies], pa.binary()),
            pa.array(np.diff(first), pa.int64()),
            pa.array([sha256(b).hexdigest() for b in bodies]),
            lists(h.view(np.int64), offsets, pa.int64()),
            *[lists(x, offsets, kind) for x, kind in ((start, pa.int32()), (windows, pa.int16()), (off, pa.int16()))],
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "did", "key", "n", "sha", "h", "start", "windows", "off"])

    schema = (
        "doc_id BIGINT, did BIGINT, key BINARY, n BIGINT, sha STRING, "
        "h ARRAY<BIGINT>, start ARRAY<INT>, windows ARRAY<SMALLINT>, off ARRAY<SMALLINT>"
    )
    return map_batches(docs.select("doc_id", "text"), run, schema)


def _packed(docs: DataFrame, wanted: DataFrame, units: Units) -> DataFrame:
    """``(key, did, start, windows, off, h, pid, pack)`` of the runs in ``wanted (did, key, runs)``."""
    names = ["key", "did", "start", "windows", "off", "h", "pid", "pack"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        runs = batch.column(3)
        bounds = (runs.offsets.to_numpy() - runs.offsets[0].as_py()).tolist()
        parts = dict(zip(("h", "start", "windows", "off"), runs.flatten().flatten(), strict=True))
        start = parts["start"].to_numpy()
        units_of = (parts["windows"].to_numpy().astype(np.int64) + (units.length - 1)).tolist()
        start = start.tolist()
        packs: list[bytes | None] = []
        for text, key, a, b in zip(
            byte_texts(batch.column(1)), batch.column(2).to_pylist(), bounds[:-1], bounds[1:], strict=True
        ):
            body = units.body(text)
            if md5(body).digest() != key:  # another text under the same id
                packs += [None] * (b - a)
                continue
            cut = units.slicer(body)
            packs += [cut(i, n) for i, n in zip(start[a:b], units_of[a:b], strict=True)]
        owner = pa.array(np.repeat(np.arange(batch.num_rows), np.diff(bounds)))
        pids = [None if p is None else md5(p).digest() for p in packs]
        columns = [batch.column(2).take(owner), batch.column(0).take(owner)]
        columns += [parts[name] for name in ("start", "windows", "off", "h")] + [pa.array(pids, pa.binary()), pa.array(packs, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names)

    did = F.coalesce("doc_id", F.lit(_LAST))
    chosen = docs.select(did.alias("did"), "text").join(wanted, "did").select("did", "text", "key", "runs")
    schema = "key BINARY, did BIGINT, start INT, windows SMALLINT, off SMALLINT, h BIGINT, pid BINARY, pack BINARY"
    return map_batches(chosen, run, schema).where("pid IS NOT NULL")


def order_text() -> Column:
    """A minimiser's place as a text that sorts like it: by id, then by place, then by 48 bits of the digest."""
    number = F.lpad(F.hex(F.col("did").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    return F.concat(number, F.lpad(F.hex((F.col("start") + F.col("off")).cast("bigint")), 8, "0"), F.substring(F.hex("key"), 1, 12))


Bucket = list[tuple[bytes, int, str, bytes, int, int]]  # pid, copies, first place, packed run, windows, off


def _compared(packs: DataFrame, compare: Callable[[Bucket], list[tuple[bytes, bytes]]]) -> DataFrame:
    """Apply ``compare`` to the runs of every minimiser; it gives ``(pid, a byte for each window)``."""
    small_batches(packs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket: Bucket = []
        done: list[tuple[bytes, bytes]] = []
        current = None

        def out() -> pa.RecordBatch:
            pids, flags = zip(*done, strict=True)
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(pids, pa.binary()), pa.array(flags, pa.binary())], ["pid", "flags"])

        for batch in batches:
            for h, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if h != current:
                    if len(bucket) > 1 or (bucket and bucket[0][1] > 1):
                        done += compare(bucket)
                    bucket, current = [], h
                bucket.append(tuple(row))
            if len(done) > 10_000:
                yield out()
        if len(bucket) > 1 or (bucket and bucket[0][1] > 1):
            done += compare(bucket)
        if done:
            yield out()

    columns = packs.select("h", "pid", "copies", "place", "pack", "windows", "off")
    return columns.repartition("h").sortWithinPartitions("h", "pid").mapInArrow(run, "pid BINARY, flags BINARY")


def _one_by_one(packs: DataFrame, units: Units, first_stays: bool) -> DataFrame:
    """The same for minimisers with very many runs: their windows are grouped by digest, combined before the shuffle."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for pid, copies, place, pack, windows in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            cut = units.slicer(pack)
            rows += [(md5(cut(j, units.length)).digest(), pid, j, copies, place) for j in range(windows)]
        kinds = [pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.string()]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 5, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["window", "pid", "j", "copies", "place"])

    schema = "window BINARY, pid BINARY, j INT, copies BIGINT, place STRING"
    windows = map_batches(packs.select("pid", "copies", "place", "pack", "windows"), run, schema)
    windows = sealed(windows, "repeats-windows")
    totals = windows.groupBy("window").agg(F.sum("copies").alias("all_copies"), F.min("place").alias("least"))
    flag = F.col("place") > F.col("least") if first_stays else F.col("all_copies") > 1
    flagged = windows.join(totals, "window").where(flag).groupBy("pid").agg(F.collect_set("j").alias("places"))
    bits = F.transform(
        F.sequence(F.lit(0), F.array_max("places")), lambda i: F.when(F.array_contains("places", i), "01").otherwise("00")
    )
    return flagged.select("pid", F.unhex(F.array_join(bits, "")).alias("flags"))


def repeated(
    docs: DataFrame,
    units: Units,
    compare: Callable[[Bucket], list[tuple[bytes, bytes]]],
    first_stays: bool,
    gathered: int = GATHERED,
) -> DataFrame:
    """``(doc_id, n, n_removed, n_spans, kept_sha256)``, one row for every row of ``docs``.

    Every unit covered by a window that stands elsewhere too is removed; with ``first_stays`` only if the other place is
    earlier: a smaller id, or an earlier place of the same text.
    """
    found = sealed(survey(docs, units), "repeats-survey")
    texts = sealed(found.groupBy("key").agg(F.min("did").alias("first"), F.count("*").alias("same")), "repeats-texts")
    place = F.explode(F.arrays_zip("h", "start", "windows", "off")).alias("r")
    runs = found.select("key", place).select("key", "r.h", "r.start", "r.windows", "r.off")
    # Equal texts name the same places, so they do not make a minimiser repeated.
    name = F.xxhash64("key", "start")
    ends = runs.select("h", name.alias("o")).groupBy("h").agg(F.min("o").alias("low"), F.max("o").alias("high"))
    twice = sealed(ends.where("low <> high").select("h"), "repeats-minimisers")
    hits = runs.join(twice, "h").groupBy("key").agg(F.collect_set(F.struct("h", "start", "windows", "off")).alias("runs"))
    wanted = sealed(hits.join(texts, "key").select(F.col("first").alias("did"), "key", "runs"), "repeats-wanted")
    packed = sealed(_packed(docs, wanted, units).withColumn("place", order_text()), "repeats-runs")
    packs = sealed(
        packed.groupBy("h", "pid").agg(
            F.count("*").alias("copies"), F.min("place").alias("place"),
            F.any_value("pack").alias("pack"), F.any_value("windows").alias("windows"), F.any_value("off").alias("off"),
        ),
        "repeats-packs",
    )
    many = sealed(packs.groupBy("h").agg(F.count("*").alias("c")).where(F.col("c") > gathered).select("h"), "repeats-many")
    marks = _compared(packs.join(many, "h", "left_anti"), compare)
    if not many.isEmpty():
        marks = marks.unionByName(_one_by_one(packs.join(many, "h"), units, first_stays))
    marks = sealed(marks, "repeats-marks")
    # Written before they are joined with all places: Spark splits a crowded key only between two plain shuffles.
    known = packs.select("pid", F.col("copies"), F.col("place").alias("least")).join(marks, "pid", "left")
    known = sealed(known, "repeats-known")
    everything = F.col("place") > F.col("least") if first_stays else F.col("copies") > 1
    spans = (
        packed.select("key", "pid", "start", "windows", "place").join(known, "pid")
        .select("key", "start", "windows", everything.alias("whole"), "flags").where("whole OR flags IS NOT NULL")
        .groupBy("key").agg(F.collect_list(F.struct("start", "windows", "whole", "flags")).alias("spans"))
    )
    wanted_texts = sealed(
        wanted.select("did", "key").join(spans, "key").select("did", "key", "spans"), "repeats-spans"
    )
    left = sealed(_removed(docs, wanted_texts, units).dropDuplicates(["key"]), "repeats-left")
    result = found.select("doc_id", "did", "key", "n", "sha").join(sealed(texts.join(left, "key", "left"), "repeats-results"), "key")
    copied = (F.col("did") > F.col("first")) if first_stays else F.col("same") > 1
    gone = copied & (F.col("n") >= units.length)
    return result.select(
        "doc_id",
        "n",
        F.when(gone, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(gone, F.lit(EMPTY_SHA256)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
    )


def covered(n: int, start: list[int], windows: list[int], whole: list[bool], flags: list[bytes | None], length: int) -> np.ndarray:
    """Which of ``n`` units the marked windows cover."""
    steps = np.zeros(n + 1, np.int64)
    for at, count, every, marks in zip(start, windows, whole, flags, strict=True):
        if every:
            steps[at] += 1
            steps[at + count + length - 1] -= 1
        else:
            places = at + np.flatnonzero(np.frombuffer(marks, np.uint8))
            np.add.at(steps, places, 1)
            np.add.at(steps, places + length, -1)
    return np.cumsum(steps[:-1]) > 0


def _removed(docs: DataFrame, wanted: DataFrame, units: Units) -> DataFrame:
    """``(key, n_removed, n_spans, kept_sha)`` of texts with marked windows."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = batch.column(3)
        bounds = (spans.offsets.to_numpy() - spans.offsets[0].as_py()).tolist()
        parts = [part.to_pylist() for part in spans.flatten().flatten()]
        rows = []
        for text, key, a, b in zip(
            byte_texts(batch.column(1)), batch.column(2).to_pylist(), bounds[:-1], bounds[1:], strict=True
        ):
            body = units.body(text)
            if md5(body).digest() != key:
                continue
            n = units.count(body)
            gone = covered(n, *[part[a:b] for part in parts], units.length)
            edges = np.flatnonzero(np.diff(gone.view(np.int8), prepend=0, append=0))
            cut = units.slicer(body)
            ends = [0, *edges.tolist(), n]
            left = [cut(i, j - i) for i, j in zip(ends[::2], ends[1::2], strict=True) if j > i]
            rows.append((key, int(gone.sum()), len(edges) // 2, sha256(units.glue.join(left)).hexdigest()))
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string()]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 4, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["key", "n_removed", "n_spans", "kept_sha"])

    did = F.coalesce("doc_id", F.lit(_LAST))
    chosen = docs.select(did.alias("did"), "text").join(wanted, "did").select("did", "text", "key", "spans")
    return map_batches(chosen, run, "key BINARY, n_removed BIGINT, n_spans BIGINT, kept_sha STRING")
