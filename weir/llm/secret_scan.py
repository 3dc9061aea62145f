"""Secrets in texts, found by one automaton for all rules in one pass over the bytes.

A rule is a prefix (a regular expression), a class of value bytes and a least length of the
value. Its matches are leftmost, greedy and do not overlap: a value runs as far as its class
goes, and the search goes on behind it even when the value was too short to count. Matches of
different rules may overlap.

:func:`compile_rules` makes a nondeterministic automaton of each prefix, joins all rules by subset
construction and merges equal states. Scanning is then one table lookup for a byte. The states
that matter report the byte where a value is known to have begun; the ends are found there.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256
from re import _parser as regex_parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from weir.llm.common import byte_texts, map_batches


@dataclass(frozen=True)
class Rule:
    """``least`` counts value bytes; ``sure`` of them must be seen before a match is looked at.

    With an empty prefix every value byte may begin a match, so ``sure`` should be ``least``.
    """

    kind: str
    prefix: str
    value: str
    least: int
    sure: int = 1


# The rules of the contract, in the order of their kinds.
BASE_RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", r"[A-Za-z0-9+/_.=-]", 12),
    Rule("access", r"AKIA", r"[A-Z0-9]", 14),
    Rule("hex", r"", r"[0-9a-f]", 16, sure=16),
)

EXTRA_RULES = (
    Rule("code_host", r"gh[opsur]_", r"[A-Za-z0-9]", 36),
    Rule("chat", r"xox[abprs]-", r"[A-Za-z0-9-]", 10),
    Rule("cloud", r"AIza", r"[A-Za-z0-9_-]", 35),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ", r"[A-Za-z0-9_.-]", 16),
    Rule("private_key", r"-----BEGIN\x20", r"[A-Z\x20]", 11),
)

RULES = BASE_RULES + EXTRA_RULES


def _byte_set(items, fold: bool) -> frozenset[int]:
    """The bytes of a character class, as the standard library parses it."""
    found: set[int] = set()
    for op, value in items:
        name = str(op)
        if name == "LITERAL":
            found.add(value)
        elif name == "RANGE":
            found.update(range(value[0], value[1] + 1))
        else:
            raise ValueError(f"a rule may not use {name} in a class")
    if fold:
        found |= {ord(c) for x in found for c in (chr(x).lower(), chr(x).upper()) if ord(c) < 128}
    if max(found) > 127:
        raise ValueError("rules are over ASCII")
    return frozenset(found)


class _Prefix:
    """Nondeterministic automaton of a regular expression: byte edges and empty moves."""

    def __init__(self, pattern: str):
        self.edges: list[list[tuple[frozenset[int], int]]] = []
        self.moves: list[list[int]] = []
        self.start = self._state()
        parsed = regex_parser.parse(pattern)
        self.final = self._add(parsed, self.start, bool(parsed.state.flags & re.IGNORECASE))

    def _state(self) -> int:
        self.edges.append([])
        self.moves.append([])
        return len(self.edges) - 1

    def _add(self, items, at: int, fold: bool) -> int:
        for op, value in items:
            at = self._add_one(str(op), value, at, fold)
        return at

    def _add_one(self, name: str, value, at: int, fold: bool) -> int:
        if name in ("LITERAL", "IN"):
            to = self._state()
            accepted = _byte_set(value if name == "IN" else [("LITERAL", value)], fold)
            self.edges[at].append((accepted, to))
            return to
        if name == "BRANCH":
            to = self._state()
            for branch in value[1]:
                self.moves[self._add(branch, at, fold)].append(to)
            return to
        if name == "SUBPATTERN":
            _, added, removed, inner = value
            return self._add(inner, at, (fold or bool(added & re.IGNORECASE)) and not removed & re.IGNORECASE)
        if name == "MAX_REPEAT":
            low, high, inner = value
            for _ in range(low):
                at = self._add(inner, at, fold)
            if str(high) == "MAXREPEAT":
                loop = self._state()
                self.moves[at].append(loop)
                self.moves[self._add(inner, loop, fold)].append(loop)
                return loop
            to = self._state()
            self.moves[at].append(to)
            for _ in range(high - low):
                at = self._add(inner, at, fold)
                self.moves[at].append(to)
            return to
        raise ValueError(f"a rule may not use {name}")

    def closed(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for to in self.moves[todo.pop()]:
                if to not in seen:
                    seen.add(to)
                    todo.append(to)
        return frozenset(seen)

    def reversed_edges(self) -> tuple[list[list[tuple[frozenset[int], int]]], list[list[int]]]:
        edges, moves = [[] for _ in self.edges], [[] for _ in self.edges]
        for a, out in enumerate(self.edges):
            for accepted, b in out:
                edges[b].append((accepted, a))
        for a, out in enumerate(self.moves):
            for b in out:
                moves[b].append(a)
        return edges, moves


class Scanner:
    """The joint automaton. ``table[state][byte]`` is the next state, ``found[state]`` the rules
    whose value has just become sure."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.prefixes = [_Prefix(rule.prefix) for rule in rules]
        self.values = [_byte_set(regex_parser.parse(rule.value)[0][1], False) for rule in rules]
        self._classes()
        self._subsets()
        self._minimise()
        self.runs = [re.compile(f"{rule.value}+".encode()) for rule in rules]
        rows: list[list] = [[] for _ in self.found]
        for state, row in enumerate(rows):  # rows hold rows: one lookup takes a byte to the next state
            row.extend(rows[to] for to in self.table[state][self.class_of].tolist())
            row.append(self.found[state])
        self.rows = rows

    def _classes(self) -> None:
        """Bytes that no rule tells apart share a column."""
        sets = {accepted for p in self.prefixes for out in p.edges for accepted, _ in out} | set(self.values)
        marks: dict[tuple[bool, ...], int] = {}
        ordered = sorted(sets, key=sorted)
        self.class_of = np.array([marks.setdefault(tuple(b in s for s in ordered), len(marks)) for b in range(256)])
        self.samples = [int(np.flatnonzero(self.class_of == c)[0]) for c in range(len(marks))]

    def _step(self, k: int, config, byte: int):
        """One rule's next configuration: a set of prefix states, or the count of value bytes."""
        prefix, start = self.prefixes[k], self.starts[k]
        if isinstance(config, int):
            if byte in self.values[k]:
                return min(config + 1, self.rules[k].sure + 1)
            config = start
        if prefix.final in config and byte in self.values[k]:
            return 1
        to = [b for a in config for accepted, b in prefix.edges[a] if byte in accepted]
        return prefix.closed(to) | start

    def _subsets(self) -> None:
        self.starts = [p.closed([p.start]) for p in self.prefixes]
        first = tuple(self.starts)
        numbers, todo, table, found = {first: 0}, [first], [], []
        steps: dict = {}
        for configs in todo:
            found.append(tuple(k for k, c in enumerate(configs) if c == self.rules[k].sure and isinstance(c, int)))
            row = []
            for c, byte in enumerate(self.samples):
                to = []
                for k, config in enumerate(configs):
                    if (k, config, c) not in steps:
                        steps[k, config, c] = self._step(k, config, byte)
                    to.append(steps[k, config, c])
                to = tuple(to)
                if to not in numbers:
                    numbers[to] = len(todo)
                    todo.append(to)
                row.append(numbers[to])
            table.append(row)
        self.table, self.found = np.array(table), found

    def _minimise(self) -> None:
        """Refine the partition by outputs until no byte tells states of one part apart."""
        outputs = sorted(set(self.found))
        part, parts = np.array([outputs.index(f) for f in self.found]), 0
        while True:
            _, part = np.unique(np.column_stack([part, part[self.table]]), axis=0, return_inverse=True)
            part = part.reshape(-1)
            if part.max() + 1 == parts:
                break
            parts = int(part.max()) + 1
        order = np.concatenate([[part[0]], np.setdiff1d(np.arange(parts), part[0])])
        place = np.argsort(order)  # the start state stays the first
        _, samples = np.unique(part, return_index=True)
        self.table = place[part[self.table[samples[order]]]]
        self.found = [self.found[i] for i in samples[order]]

    @lru_cache(maxsize=None)  # noqa: B019  one scanner lives as long as its process
    def _back(self, k: int):
        return self.prefixes[k].reversed_edges()

    def _begin(self, k: int, data: bytes, at: int) -> int:
        """Where the prefix that ends before ``at`` begins: the longest one read backwards."""
        prefix = self.prefixes[k]
        edges, moves = self._back(k)

        def closed(states):
            seen, todo = set(states), list(states)
            while todo:
                for to in moves[todo.pop()]:
                    if to not in seen:
                        seen.add(to)
                        todo.append(to)
            return seen

        states, best = closed([prefix.final]), at
        while states:
            if prefix.start in states:
                best = at
            at -= 1
            if at < 0:
                break
            states = closed([a for s in states for accepted, a in edges[s] if data[at] in accepted])
        return best

    def scan(self, data: bytes) -> list[tuple[int, int, int]]:
        """``(start, rule, end)`` of all matches in bytes, by start, then rule."""
        spans = []
        row = self.rows[0]
        for i, byte in enumerate(data):
            row = row[byte]
            if row[256]:
                for k in row[256]:
                    rule = self.rules[k]
                    begin = i + 1 - rule.sure
                    end = self.runs[k].match(data, begin).end()
                    if end - begin >= rule.least:
                        spans.append((self._begin(k, data, begin), k, end))
        return sorted(spans)


@lru_cache(maxsize=4)
def compile_rules(rules: tuple[Rule, ...] = RULES) -> Scanner:
    return Scanner(rules)


def text_spans(scanner: Scanner, data: bytes) -> list[tuple[int, int, int]]:
    """Matches of UTF-8 bytes with their places in code points."""
    spans = scanner.scan(data)
    if not spans or data.isascii():
        return spans
    head = np.frombuffer(data, np.uint8) & 0xC0 != 0x80
    place = np.concatenate([[0], np.cumsum(head)])
    return [(int(place[a]), k, int(place[b])) for a, k, b in spans]


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, spans ARRAY<STRUCT<kind, start, end>>)``: one row for every row of ``docs``.

    Places count code points, the end is exclusive; order is by start, then by rule. Texts are
    scanned whole. A NULL or empty text has no spans; a NULL key is carried along; repeated rows
    give repeated results; columns other than the two are not read. Nothing is shuffled.
    """
    kinds = [rule.kind for rule in rules]
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        scanner = compile_rules(rules)
        rows = [
            [{"kind": kinds[k], "start": a, "end": b} for a, k, b in text_spans(scanner, data)]
            for data in byte_texts(batch.column(1))
        ]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], [key, "spans"])

    id_type = docs.select(key).schema[0].dataType.simpleString()
    schema = f"`{key}` {id_type}, spans ARRAY<STRUCT<kind STRING, start BIGINT, end BIGINT>>"
    return map_batches(docs.select(key, text), scan, schema)


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` (``doc_id, text, lang, source, n_chars``) with every secret replaced by ``mask``.

    Overlapping matches are replaced together. Other texts, NULLs included, stay as they are.
    """
    names = docs.columns

    def clean(batch: pa.RecordBatch) -> pa.RecordBatch:
        scanner = compile_rules(rules)
        at, count = names.index("text"), names.index("n_chars")
        texts, sizes = batch.column(at).to_pylist(), batch.column(count).to_pylist()
        for i, text in enumerate(texts):
            if text and (spans := text_spans(scanner, text.encode())):
                parts, done = [], 0
                for a, _, b in spans:
                    if a >= done:
                        parts += [text[done:a], mask]
                    done = max(done, b)
                texts[i] = "".join([*parts, text[done:]])
                sizes[i] = len(texts[i])
        columns = list(batch.columns)
        columns[at], columns[count] = pa.array(texts, columns[at].type), pa.array(sizes, columns[count].type)
        return pa.RecordBatch.from_arrays(columns, names)

    return map_batches(docs, clean, docs.schema)


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns, made of :func:`find_secrets` with all rules."""
    base = {rule.kind for rule in BASE_RULES}

    def summed(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = {kind: [] for kind in ("assign", "access", "hex")}
        digests, all_spans = [], []
        for spans in batch.column(1).to_pylist():
            texts = [(s["kind"], f"{s['kind']}:{s['start']}:{s['end']}") for s in spans]
            for kind, column in counts.items():
                column.append(sum(k == kind for k, _ in texts))
            digests.append(sha256(",".join(t for k, t in texts if k in base).encode()).hexdigest())
            all_spans.append(",".join(t for _, t in texts))
        columns = [pa.array(c, pa.int64()) for c in counts.values()] + [pa.array(digests), pa.array(all_spans)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *columns], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
        )

    schema = "doc_id BIGINT, n_assign BIGINT, n_access BIGINT, n_hex BIGINT, base_sha256 STRING, spans STRING"
    return map_batches(find_secrets(docs), summed, schema)
