"""Repeated byte strings, by suffix arrays: see :mod:`weir.llm.repeats` for how texts are partitioned.

In a bucket the packed strings are put together and their suffixes sorted by linear grouping. Suffixes
that begin with the same bytes of a window stand next to each other then; of each such stretch the earliest place stays.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from weir.llm.repeats import Bucket, Units, repeated
from weir.llm.text_arrays import mixed

LENGTH = 100

# Bytes of a minimiser.
GRAM = 32

# Stands in no UTF-8 text.
_END = b"\xff"


def suffix_array(text: bytes) -> list[int]:
    """Start places of all suffixes in their order, in two linear passes.

    First, suffixes are grouped by their first byte and groups are taken from the highest to the lowest. Each
    suffix of a group finds the nearest suffix before it that stands in a lower group, along the pointers of those
    already done. Suffixes found by as many of the group form a new group right above their own: their Lyndon
    prefix grows by as many copies of the group's. In the end a group holds the suffixes with one longest Lyndon prefix.

    Then suffixes are emitted in ascending order. What follows the Lyndon prefix of a suffix is a smaller suffix, so
    once that one is emitted, the suffixes that it follows take the next free places of their groups.
    """
    n = len(text)
    members: list[set[int]] = []
    above, below = [-1], [-1]
    members.append(set())  # the bottom of the list
    group = [0] * n
    by_byte: dict[int, list[int]] = {}
    for i, byte in enumerate(text):
        by_byte.setdefault(byte, []).append(i)
    for byte in sorted(by_byte):
        g = len(members)
        members.append(set(by_byte[byte]))
        above.append(-1)
        below.append(g - 1)
        above[g - 1] = g
        for i in by_byte[byte]:
            group[i] = g
    previous = [-1] * n
    done = [False] * len(members)
    order = []
    g = len(members) - 1
    while g > 0:
        done[g] = True
        order.append(g)
        found: dict[int, int] = {}
        for i in sorted(members[g]) if len(members[g]) > 1 else members[g]:
            j = i - 1
            while j >= 0 and done[group[j]]:
                j = previous[j]
            previous[i] = j
            if j >= 0:
                found[j] = found.get(j, 0) + 1
        if found:
            by_count: dict[int, dict[int, list[int]]] = {}
            for j, count in found.items():
                by_count.setdefault(count, {}).setdefault(group[j], []).append(j)
            for count in sorted(by_count, reverse=True):
                for old, moved in by_count[count].items():
                    if len(moved) == len(members[old]):
                        continue  # all of it grows alike
                    new = len(members)
                    members.append(set(moved))
                    members[old].difference_update(moved)
                    done.append(False)
                    above.append(above[old])
                    below.append(old)
                    below[above[old]] = new
                    above[old] = new
                    for j in moved:
                        group[j] = new
        g = below[g]
    free = [0] * len(members)
    at = 0
    for g in reversed(order):
        free[g] = at
        at += len(members[g])
    out = [-1] * n
    placed = [False] * n
    j, k = n - 1, 0
    while True:
        while j >= 0 and not placed[j]:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            placed[j] = True
            j = previous[j]
        if k == n:
            return out
        j = out[k] - 1
        k += 1


def _common(a: bytes, b: bytes) -> int:
    """How many bytes two strings have in common at their start."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def _most_common(sides: list[bytes]) -> list[int]:
    """For each string the longest start it has in common with another one: with a neighbour in sorted order."""
    order = sorted(range(len(sides)), key=sides.__getitem__)
    out = [0] * len(sides)
    for x, y in zip(order[:-1], order[1:], strict=True):
        n = _common(sides[x], sides[y])
        out[x], out[y] = max(out[x], n), max(out[y], n)
    return out


def first_windows(length: int):
    def compare(bucket: Bucket) -> list[tuple[bytes, bytes]]:
        """Windows that stand in a run with an earlier place.

        Equal windows have their minimiser at the same distance, so the places of runs compare like theirs. What a run shares
        with no other, on either side of its minimiser, is cut off before suffixes are sorted; what is left is often equal.
        """
        if len(bucket) < 2:
            return []
        rank = [0] * len(bucket)
        for k, r in enumerate(sorted(range(len(bucket)), key=lambda r: bucket[r][2])):
            rank[r] = k
        left = _most_common([row[3][: row[5]][::-1] for row in bucket])
        right = _most_common([row[3][row[5] :] for row in bucket])
        flags = [bytearray(row[4]) for row in bucket]
        pieces: dict[tuple[bytes, int], list[int]] = {}
        for r, row in enumerate(bucket):
            if left[r] + right[r] >= length:
                pieces.setdefault((row[3][row[5] - left[r] : row[5] + right[r]], left[r]), []).append(r)
        ahead = []
        for (piece, before), owners in pieces.items():
            first = min(owners, key=rank.__getitem__)
            ahead.append((piece, first))
            for r in owners:
                if r != first:
                    at = bucket[r][5] - before
                    n = len(piece) - length + 1
                    flags[r][at : at + n] = b"\1" * n
        if len(ahead) > 1:
            _mark(ahead, [bucket[r][5] - left[r] for _, r in ahead], rank, flags)
        return [(row[0], bytes(f)) for row, f in zip(bucket, flags, strict=True) if any(f)]

    def _mark(ahead: list[tuple[bytes, int]], shift: list[int], rank: list[int], flags: list[bytearray]) -> None:
        text = _END.join([piece for piece, _ in ahead] + [b""])
        owner: list[tuple[int, int] | None] = []
        for (piece, r), at in zip(ahead, shift, strict=True):
            n = len(piece) - length + 1
            owner += [(r, at + j) for j in range(n)] + [None] * (length - 1 + len(_END))
        stretch: list[tuple[int, int]] = []
        window = None

        def close() -> None:
            if len(stretch) > 1:
                least = min(rank[r] for r, _ in stretch)
                for r, j in stretch:
                    if rank[r] > least:
                        flags[r][j] = 1

        for i in suffix_array(text):
            if (here := owner[i]) is None:
                continue
            if text[i : i + length] != window:
                close()
                stretch, window = [], text[i : i + length]
            stretch.append(here)
        close()

    return compare


def _grams(gram: int):
    def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        state = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64) + np.uint64(1)
        step, wrap = 0x9E3779B97F4A7C15, 1 << 64
        total, done, size = np.zeros(len(state), np.uint64), 0, 1
        while True:  # polynomials of doubled length, those that make up the gram's put together
            if gram & size:
                total = total + np.roll(state, -done) * np.uint64(pow(step, done, wrap))
                done += size
            size *= 2
            if size > gram:
                break
            state = state + np.roll(state, -(size // 2)) * np.uint64(pow(step, size // 2, wrap))
        return mixed(total), first

    return grams


def _slicer(body: bytes):
    return lambda start, n: body[start : start + n]


def byte_units(length: int = LENGTH, gram: int = GRAM) -> Units:
    return Units(length, min(gram, length), _grams(min(gram, length)), bytes, len, _slicer)


def remove_repeated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)``, one row for every row of ``docs``.

    A byte goes when a string of ``length`` bytes that covers it also starts earlier: in a document of smaller id, or
    earlier in the same text. Texts are UTF-8; NULL and empty ones have no bytes. A NULL id counts as the largest. Rows
    that repeat id and text are one document and stay alike; different texts under one id are ordered by digest.
    Other columns are not read.
    """
    units = byte_units(length, gram)
    found = repeated(docs, units, first_windows(length), first_stays=True)
    return found.selectExpr("doc_id", "n AS n_bytes", "n_removed", "n_spans", "kept_sha256")


def remove_repeated_sql(length: int = LENGTH) -> str:
    """The same rows in DuckDB's SQL, every string of ``length`` bytes as hexadecimal digits."""
    return f"""
    WITH d AS MATERIALIZED (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
    w AS MATERIALIZED (SELECT doc_id, i, md5(substr(h, 2 * i + 1, {2 * length})) AS s
        FROM (SELECT doc_id, h, unnest(range(0, greatest(len(h) // 2 - {length - 1}, 0))) AS i FROM d)),
    f AS (SELECT s, min(struct_pack(d := doc_id, i := i)) AS first FROM w GROUP BY s HAVING count(*) > 1),
    c AS MATERIALIZED (SELECT doc_id, i FROM w JOIN f USING (s) WHERE struct_pack(d := doc_id, i := i) <> first),
    g AS (SELECT doc_id, i, sum(apart) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM
        (SELECT *, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= {length} THEN 0 ELSE 1 END AS apart FROM c)),
    r AS MATERIALIZED (SELECT doc_id, span, min(i) AS low, max(i) + {length} AS high FROM g GROUP BY doc_id, span),
    k AS (SELECT r.doc_id, lag(high, 1, 0) OVER (PARTITION BY r.doc_id ORDER BY low) AS low, low AS high, h FROM r JOIN d USING (doc_id)
        UNION ALL SELECT d.doc_id, coalesce(max(high), 0), any_value(len(h) // 2), any_value(h) FROM d LEFT JOIN r USING (doc_id) GROUP BY d.doc_id),
    j AS (SELECT doc_id, string_agg(substr(h, 2 * low + 1, 2 * (high - low)), '' ORDER BY low) AS kept FROM k GROUP BY doc_id),
    n AS (SELECT doc_id, count(*) AS n_spans, sum(high - low) AS n_removed FROM r GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
           CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(from_hex(kept)) AS kept_sha256
    FROM d JOIN j USING (doc_id) LEFT JOIN n USING (doc_id)
    """
