"""Repeated word windows, by super-k-mers: see :mod:`weir.llm.repeats` for how they travel.

In a bucket the windows of all packed runs are sorted; equal neighbours are counted, each with the copies of
its run. Windows are compared as words, not as hashes.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame

from weir.llm.repeats import Bucket, Units, repeated
from weir.llm.text_arrays import joined, mixed, run_hashes, runs, separator_table

LENGTH = 35

# Words of a minimiser.
GRAM = 8

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _grams(gram: int):
    def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = joined(texts)
        starts, ends = runs(separator_table()[data])
        words = run_hashes(data, starts, ends)
        state = np.zeros(len(words), np.uint64)
        for k in range(gram):  # grams that leave their text are in no window of it
            state = mixed(state * np.uint64(0x9E3779B97F4A7C15) + np.roll(words, -k))
        return state, np.searchsorted(starts, offsets)

    return grams


def _body(text: bytes) -> bytes:
    return b" ".join(_WORD.findall(text))


def _count(body: bytes) -> int:
    return body.count(b" ") + 1 if body else 0


def _slicer(body: bytes):
    """Words ``start`` to ``start + n`` of words joined by spaces."""
    at = np.concatenate([[0], np.flatnonzero(np.frombuffer(body, np.uint8) == 32) + 1, [len(body) + 1]]).tolist()
    return lambda start, n: body[at[start] : at[start + n] - 1]


def word_units(length: int = LENGTH, gram: int = GRAM) -> Units:
    return Units(length, min(gram, length), _grams(min(gram, length)), _body, _count, _slicer, b" ")


def count_windows(length: int):
    def compare(bucket: Bucket) -> list[tuple[bytes, bytes]]:
        windows = []
        for r, (_, _, _, pack, n, _) in enumerate(bucket):
            cut = _slicer(pack)
            windows += [(cut(j, length), r, j) for j in range(n)]
        windows.sort()
        flags = [bytearray(row[4]) for row in bucket]
        i = 0
        while i < len(windows):
            window, k = windows[i][0], i
            copies = 0
            while k < len(windows) and windows[k][0] == window:
                copies += bucket[windows[k][1]][1]
                k += 1
            if copies > 1:
                for _, r, j in windows[i:k]:
                    flags[r][j] = 1
            i = k
        return [(row[0], bytes(f)) for row, f in zip(bucket, flags, strict=True) if any(f)]

    return compare


def remove_repeated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)``, one row for every row of ``docs``.

    A word goes when a window of ``length`` words that covers it starts anywhere else too, in the same text or
    in another row's. Words are runs without white space, unchanged. NULL and empty texts have no words. A NULL
    id is carried along; rows that repeat an id are documents of their own; other columns are not read.
    """
    units = word_units(length, gram)
    found = repeated(docs, units, count_windows(length), first_stays=False)
    return found.selectExpr("doc_id", "n AS n_words", "n_removed", "kept_sha256")


def remove_repeated_sql(length: int = LENGTH) -> str:
    """The same rows in DuckDB's SQL."""
    return rf"""
    WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS MATERIALIZED (SELECT doc_id, i, array_to_string(w[i:i + {length - 1}], ' ') AS s FROM
        (SELECT doc_id, w, unnest(generate_series(1, len(w) - {length - 1})) AS i FROM d WHERE len(w) >= {length})),
    r AS (SELECT doc_id, i FROM s WHERE s IN (SELECT s FROM s GROUP BY s HAVING count(*) > 1)),
    g AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(generate_series(i, i + {length - 1})) AS p FROM r),
    p AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM d),
    k AS (SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.p) AS kept FROM p ANTI JOIN g ON p.doc_id = g.doc_id AND p.p = g.p GROUP BY 1),
    c AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1)
    SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n, 0) AS BIGINT) AS n_removed,
           sha256(coalesce(k.kept, '')) AS kept_sha256
    FROM d LEFT JOIN k ON k.doc_id = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id
    """
