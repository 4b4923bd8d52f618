"""Secret scanning with one combined deterministic automaton.

All rules are compiled together: Thompson automata, subset construction over byte classes with a
restart at every byte, minimisation by partition refinement, and one transition array that is
walked once per text. Where a rule accepts, its reversed automaton finds the leftmost start and
its anchored automaton the longest end, both only over the match itself. The automata are built
on the driver and travel with the task; their size depends on the rules alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

SPAN = StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())])

# Patterns: nested tuples over sets of byte values.
Pattern = tuple


def one_of(*parts: str) -> Pattern:
    """A byte of the given characters or ranges such as ``a-z``."""
    values: set[int] = set()
    for p in parts:
        values |= set(range(ord(p[0]), ord(p[2]) + 1)) if len(p) == 3 and p[1] == "-" else {ord(c) for c in p}
    return ("set", frozenset(values))


def seq(*parts: Pattern) -> Pattern:
    return ("seq", parts)


def alt(*parts: Pattern) -> Pattern:
    return ("alt", parts)


def star(part: Pattern) -> Pattern:
    return ("star", part)


def maybe(part: Pattern) -> Pattern:
    return alt(part, seq())


def at_least(part: Pattern, n: int) -> Pattern:
    return seq(*[part] * n, star(part))


def word(text: str, fold: bool = False) -> Pattern:
    return seq(*[one_of(c.lower() + c.upper() if fold else c) for c in text])


def backwards(p: Pattern) -> Pattern:
    if p[0] == "seq":
        return ("seq", tuple(backwards(x) for x in reversed(p[1])))
    if p[0] == "alt":
        return ("alt", tuple(backwards(x) for x in p[1]))
    return ("star", backwards(p[1])) if p[0] == "star" else p


@dataclass(frozen=True)
class Rule:
    """A kind, its pattern, and a test that a match (its bytes) must pass to be kept."""

    kind: str
    pattern: Pattern
    keep: Callable[[bytes], bool] | None = None


VALUE_LENGTH = 6
VALUE = one_of("A-Z", "a-z", "0-9", "+/_.=-")
ALNUM = one_of("A-Z", "a-z", "0-9")
SPACES = star(one_of(" "))
QUOTE = maybe(one_of("\"'"))


def long_value(match: bytes) -> bool:
    """The assigned value, behind the first separator, has the least length."""
    at = min(i for i in (match.find(b":"), match.find(b"=")) if i >= 0)
    value = match[at + 1 :].lstrip(b" ")
    return len(value) - value.startswith((b'"', b"'")) >= VALUE_LENGTH


def of_length(least: int) -> Callable[[bytes], bool]:
    return lambda match: len(match) >= least


BASE_RULES = (
    Rule(
        "assign",
        seq(
            alt(*[word(w, fold=True) for w in ("password", "passwd", "secret", "token")], seq(word("api", True), maybe(one_of("_")), word("key", True))),
            QUOTE, SPACES, one_of(":="), SPACES, QUOTE, at_least(VALUE, 1),
        ),
        long_value,
    ),
    Rule("access", seq(word("AKIA"), at_least(one_of("A-Z", "0-9"), 1)), of_length(20)),
    # every letter a to f would accept here, so this length is part of the pattern
    Rule("hex", at_least(one_of("0-9", "a-f"), 24)),
)
#: Kinds found beyond the base ones.
MORE_RULES = (
    Rule("github", seq(word("gh"), one_of("pousr"), word("_"), at_least(ALNUM, 1)), of_length(24)),
    Rule("slack", seq(word("xox"), one_of("abprs"), word("-"), at_least(one_of("A-Z", "a-z", "0-9", "-"), 1)), of_length(15)),
    Rule("pem", seq(word("-----BEGIN "), star(one_of("A-Z", " ")), word("PRIVATE KEY-----"))),
)
BASE_KINDS = tuple(r.kind for r in BASE_RULES)


class _Nfa:
    """Thompson automaton: empty moves and byte-set moves."""

    def __init__(self) -> None:
        self.empty: list[list[int]] = []
        self.moves: list[tuple[frozenset, int] | None] = []

    def state(self) -> int:
        self.empty.append([])
        self.moves.append(None)
        return len(self.empty) - 1

    def add(self, p: Pattern) -> tuple[int, int]:
        start, end = self.state(), self.state()
        if p[0] == "set":
            self.moves[start] = (p[1], end)
        elif p[0] == "seq":
            at = start
            for part in p[1]:
                a, b = self.add(part)
                self.empty[at].append(a)
                at = b
            self.empty[at].append(end)
        elif p[0] == "alt":
            for part in p[1]:
                a, b = self.add(part)
                self.empty[start].append(a)
                self.empty[b].append(end)
        else:
            a, b = self.add(p[1])
            self.empty[start] += [a, end]
            self.empty[b] += [a, end]
        return start, end

    def closure(self, states: set[int]) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for n in self.empty[todo.pop()]:
                if n not in seen:
                    seen.add(n)
                    todo.append(n)
        return frozenset(seen)


@dataclass
class Automaton:
    """Minimal automaton. Rows of ``table`` are states, columns byte classes; state 0 starts.

    States from ``first_accepting`` on accept; ``accepts`` holds the bits of their rules.
    """

    table: np.ndarray
    classes: np.ndarray
    accepts: np.ndarray
    first_accepting: int
    start: int

    def flat(self) -> list[int]:
        """Next state times 256, indexed by state times 256 plus byte."""
        return (self.table[:, self.classes].astype(np.int64) * 256).ravel().tolist()

    def dead(self) -> int:
        """The state that no byte leaves and that does not accept; -1 if there is none."""
        stuck = np.flatnonzero((self.table == np.arange(len(self.table))[:, None]).all(axis=1) & (self.accepts == 0))
        return int(stuck[0]) if len(stuck) else -1


def determinise(patterns: list[Pattern], restart: bool) -> Automaton:
    """Subset construction over byte classes. With ``restart`` a match may begin at any byte."""
    nfa = _Nfa()
    ends, starts = {}, set()
    for bit, p in enumerate(patterns):
        a, b = nfa.add(p)
        starts.add(a)
        ends[b] = 1 << bit
    sets = sorted({m[0] for m in nfa.moves if m}, key=sorted)
    codes: dict[tuple, int] = {}
    classes = np.array([codes.setdefault(tuple(b in s for s in sets), len(codes)) for b in range(256)], dtype=np.int32)
    examples = [int(np.argmax(classes == c)) for c in range(len(codes))]
    first = nfa.closure(starts)
    numbers, todo, rows = {first: 0}, [first], []
    while todo:
        current = todo.pop(0)
        row = []
        for byte in examples:
            target = {nfa.moves[s][1] for s in current if nfa.moves[s] and byte in nfa.moves[s][0]}
            reached = nfa.closure(target | starts) if restart else nfa.closure(target)
            if reached not in numbers:
                numbers[reached] = len(numbers)
                todo.append(reached)
            row.append(numbers[reached])
        rows.append(row)
    accepts = np.zeros(len(numbers), dtype=np.int64)
    for states, n in numbers.items():
        accepts[n] = sum({ends[s] for s in states if s in ends})
    return _minimise(np.array(rows, dtype=np.int32), classes, accepts)


def _minimise(table: np.ndarray, classes: np.ndarray, accepts: np.ndarray) -> Automaton:
    """Moore's refinement, then accepting states are numbered last."""
    block = np.unique(accepts, return_inverse=True)[1].reshape(-1)
    while True:
        refined = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)[1].reshape(-1)
        if refined.max() == block.max():
            break
        block = refined
    count = int(block.max()) + 1
    member = np.zeros(count, dtype=np.int64)
    member[block] = np.arange(len(block))
    order = np.argsort(accepts[member] > 0, kind="stable")
    rank = np.empty(count, dtype=np.int32)
    rank[order] = np.arange(count)
    small = rank[block[table[member[order]]]]
    marks = accepts[member[order]]
    return Automaton(small, classes, marks, int((marks == 0).sum()), int(rank[block[0]]))


class Scanner:
    """The combined automaton of all rules, with start and end finders for each."""

    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.rules = rules
        self.combined = determinise([r.pattern for r in rules], restart=True)
        self.ends = [determinise([r.pattern], restart=False) for r in rules]
        self.starts = [determinise([backwards(r.pattern)], restart=False) for r in rules]
        self._flat = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_flat": None}

    def _arrays(self) -> tuple:
        if self._flat is None:
            single = lambda a: (a.flat(), a.first_accepting * 256, a.start * 256, a.dead() * 256)
            self._flat = (self.combined.flat(), [single(a) for a in self.ends], [single(a) for a in self.starts])
        return self._flat

    def scan(self, data: bytes) -> list[tuple[int, int, int]]:
        """(rule, start, end) in bytes: per rule leftmost, longest, not overlapping."""
        table, ends, starts = self._arrays()
        state, accepting, marks = self.combined.start * 256, self.combined.first_accepting * 256, self.combined.accepts
        free = [0] * len(self.rules)
        found = []
        for at, byte in enumerate(data):
            state = table[state + byte]
            if state >= accepting:
                bits = int(marks[state >> 8])
                for r in range(len(free)):
                    if bits >> r & 1 and at >= free[r]:
                        start = self._reach(starts[r], data, at, free[r] - 1, -1)
                        if start is None:
                            continue
                        end = self._reach(ends[r], data, start, len(data), 1) + 1
                        free[r] = end
                        if self.rules[r].keep is None or self.rules[r].keep(data[start:end]):
                            found.append((r, start, end))
        return found

    @staticmethod
    def _reach(automaton: tuple, data: bytes, begin: int, stop: int, step: int) -> int | None:
        """Place of the last byte at which a walk from ``begin`` accepts."""
        table, accepting, state, dead = automaton
        last = None
        for at in range(begin, stop, step):
            state = table[state + data[at]]
            if state >= accepting:
                last = at
            elif state == dead:
                break
        return last


def _characters(data: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Byte places to code points, counting each stretch of text once."""
    places, at, count = {}, 0, 0
    for p in sorted({x for _, a, b in spans for x in (a, b)}):
        count += len(data[at:p].decode("utf-8"))
        places[p], at = count, p
    return [(r, places[a], places[b]) for r, a, b in spans]


def find_secrets(documents: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES) -> DataFrame:
    """(doc_id, spans): kind, start and end (exclusive) in code points, by start, then rule order.

    Whole texts are scanned. NULL and empty texts have no spans; a NULL id and repeated rows are
    kept; other columns are ignored.
    """
    scanner = Scanner(rules)
    source = documents.select("doc_id", "text")
    schema = StructType([source.schema["doc_id"], StructField("spans", ArrayType(SPAN))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                data = (text.as_py() or "").encode("utf-8")
                spans = _characters(data, scanner.scan(data))
                spans.sort(key=lambda s: (s[1], s[0]))
                rows.append([{"kind": rules[r].kind, "start": a, "end": b} for r, a, b in spans])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, type=span)], names=["doc_id", "spans"])

    return source.mapInArrow(scan, schema)
