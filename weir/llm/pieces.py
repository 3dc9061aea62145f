"""SentencePiece encoding and decoding.

The pieces of a vocabulary are compiled into an Aho-Corasick automaton. One pass over a text
follows it; at each character the pieces that end there, found along the output links, relax
the best score of a segmentation up to that place (Viterbi), so the result has the highest sum of
piece scores. Among equal sums the longest last piece wins. Characters no piece covers become byte pieces.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache
from hashlib import sha256
from math import inf

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from weir.llm.common import map_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"

# The mark of a space inside pieces.
SPACE = "▁"

# How far below the worst regular piece a character without a piece scores.
UNKNOWN_PENALTY = 10.0

# Segmented words a Python worker remembers; some 250 bytes each. Forgetting costs time only.
REMEMBERED = 400_000


class Vocabulary:
    """``pieces``: ``(text, score)`` or NULL for pieces texts are not made of, by id; ``byte_ids``: 256 ids."""

    def __init__(self, pieces: list[tuple[str, float] | None], byte_ids: list[int]):
        self.byte_ids = byte_ids
        self.parts = [p[0].encode() if p else b"" for p in pieces]
        for byte, i in enumerate(byte_ids):
            self.parts[i] = bytes([byte])
        known = {p[0]: (i, p[1]) for i, p in enumerate(pieces) if p}
        scores = [s for text, (_, s) in known.items() if text.strip(SPACE)]
        self.unknown = min(scores, default=0.0) - UNKNOWN_PENALTY
        self._automaton(known)
        self._units(known)
        self.words: dict[str, bytes] = {}

    def _automaton(self, known: dict[str, tuple[int, float]]) -> None:
        """Trie moves, failure links, and for each node the pieces along its output links, longest first:
        ``(size, score, (size, id))``."""
        self.moves: list[dict[str, int]] = [{}]
        own: list[tuple[int, float, tuple[int, int]] | None] = [None]
        for text, (i, score) in known.items():
            node = 0
            for c in text:
                node = self.moves[node].setdefault(c, len(self.moves))
                if node == len(self.moves):
                    self.moves.append({})
                    own.append(None)
            own[node] = (len(text), score, (len(text), i))
        self.fails = [0] * len(self.moves)
        self.outputs: list[tuple[tuple[int, float, tuple[int, int]], ...]] = [()] * len(self.moves)
        todo = list(self.moves[0].values())
        for node in todo:
            mine = (own[node],) if own[node] else ()
            self.outputs[node] = mine + self.outputs[self.fails[node]]
        for node in todo:  # breadth first: failure links lead to nodes done before
            for c, to in self.moves[node].items():
                todo.append(to)
                at = self.fails[node]
                while at and c not in self.moves[at]:
                    at = self.fails[at]
                self.fails[to] = self.moves[at].get(c, 0)
                self.outputs[to] = ((own[to],) if own[to] else ()) + self.outputs[self.fails[to]]

    def _units(self, known) -> None:
        """Cuts no piece crosses: before a space mark behind another character, and around
        characters no piece has. Texts fall apart there into units that are segmented alone."""
        letters = {c for text in known for c in text}
        words = all(SPACE not in text.lstrip(SPACE) for text in known)
        letters.discard(SPACE)
        inside = "".join(re.escape(c) for c in sorted(letters))
        word = f"{SPACE}*[{inside}]+|{SPACE}+" if words else f"[{SPACE}{inside}]+"
        self.unit = re.compile(f"{word}|.", re.DOTALL)

    def segment(self, text: str) -> bytes:
        """Ids of the best segmentation as 32-bit numbers."""
        moves, fails, outputs, unknown = self.moves, self.fails, self.outputs, self.unknown
        best, back = [0.0], [(0, -1)]
        node = end = 0
        for c in text:
            end += 1
            to = moves[node].get(c)
            while to is None and node:
                node = fails[node]
                to = moves[node].get(c)
            node = to or 0
            found = outputs[node]
            if found and found[-1][0] == 1:  # a character with a piece of its own is never unknown
                top = -inf
            else:
                top, link = best[-1] + unknown, (1, -1)
            for size, score, piece in found:
                s = best[end - size] + score
                if s > top:
                    top, link = s, piece
            best.append(top)
            back.append(link)
        ids = []
        while end:
            size, i = back[end]
            if i >= 0:
                ids.append(i)
            else:
                ids += [self.byte_ids[b] for b in reversed(text[end - 1].encode())]
            end -= size
        ids.reverse()
        return array("i", ids).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a text, which gets a space in front; an empty text has none."""
        if not text:
            return b""
        words, out = self.words, []
        for unit in self.unit.findall(SPACE + text.replace(" ", SPACE)):
            ids = words.get(unit)
            if ids is None:
                ids = self.segment(unit)
                if len(unit) < 64:
                    if len(words) >= REMEMBERED:
                        words.clear()
                    words[unit] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        parts = self.parts
        text = b"".join([parts[i] for i in ids]).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text[:1] == " " else text


@lru_cache(maxsize=2)
def vocabulary(path: str = MODEL) -> Vocabulary:
    """The pieces of a model file; its file is on every machine of the cluster."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces: list[tuple[str, float] | None] = []
    byte_ids = [0] * 256
    for i in range(model.vocab_size()):
        text = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(text[1:-1], 16)] = i
        usable = not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
        pieces.append((text, model.get_score(i)) if usable else None)
    return Vocabulary(pieces, byte_ids)


def encode(docs: DataFrame, model: str = MODEL, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, ids ARRAY<INT>)``, one row for every row of ``docs``.

    Whole texts, no shuffle. An empty text has no ids, a NULL text has NULL ids; NULL keys and
    repeated rows are carried along; other columns are not read. The space mark U+2581 in a text
    is taken for a space.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        v = vocabulary(model)
        texts = batch.column(1).to_pylist()
        ids = [None if t is None else np.frombuffer(v.encode(t), np.int32) for t in texts]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], [key, "ids"])

    id_type = docs.select(key).schema[0].dataType.simpleString()
    return map_batches(docs.select(key, text), run, f"`{key}` {id_type}, ids ARRAY<INT>")


def decode(tokens: DataFrame, model: str = MODEL, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``(key, text)`` of ``(key, ids)``. No ids give an empty text, NULL ids a NULL text.

    Bytes that are not UTF-8 become U+FFFD; control pieces give nothing. A NULL inside ids is left out.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        v = vocabulary(model)
        rows = batch.column(1).to_pylist()
        texts = [None if r is None else v.decode([i for i in r if i is not None]) for r in rows]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [key, "text"])

    id_type = tokens.select(key).schema[0].dataType.simpleString()
    return map_batches(tokens.select(key, ids), run, f"`{key}` {id_type}, text STRING")


def round_trip(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """``(doc_id, n_ids, ids_sha256, decoded_sha256, restored)`` of whole texts, in one Python stage.

    ``ids_sha256`` is over the ids as little-endian 32-bit numbers; ``restored`` says that decoding
    gave the text back. A NULL text counts as empty.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        v = vocabulary(model)
        rows = []
        for text in batch.column(1).to_pylist():
            packed = v.encode(text or "")
            ids = np.frombuffer(packed, "<i4")
            back = v.decode(ids.tolist())
            rows.append(
                (len(ids), sha256(packed).hexdigest(), sha256(back.encode()).hexdigest(), back == (text or ""))
            )
        n, a, b, same = zip(*rows, strict=True)
        columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(a), pa.array(b), pa.array(same)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_ids", "ids_sha256", "decoded_sha256", "restored"])

    schema = "doc_id BIGINT, n_ids BIGINT, ids_sha256 STRING, decoded_sha256 STRING, restored BOOLEAN"
    return map_batches(docs.select("doc_id", "text"), run, schema)
