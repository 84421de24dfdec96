"""Secrets by one deterministic automaton for all rules, in one pass over the bytes of a text.

Rules are regular expressions of literals, classes, groups, alternation and the repeats ``? * + {n,}``. Each
becomes a non-deterministic automaton; its subset construction keeps the attempts of a search apart by their starts, so
that the leftmost match wins and a match swallows the attempts inside it. The rules are then run side by side as
one automaton, which is minimised and written out as one row of 256 next states per state. A match's
start is found backwards from its end, and capturing groups are read in the few matches found.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.llm.batches import bounded_batches, frugal, valid_text


class Rule(NamedTuple):
    """``pattern`` finds, ``least`` is the shortest ``group`` that counts; ``fold`` ignores the case of letters."""

    kind: str
    pattern: str
    least: int
    group: int = 0
    fold: bool = False


# The rules every report counts, then further kinds of credentials.
BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        6, 2, True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{24,}", 24),
)
MORE_RULES = (
    Rule("github", r"gh[opsu]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1),
)
RULES = BASE_RULES + MORE_RULES

Nfa = list[list[tuple[frozenset[int] | None, int]]]


class _Parser:
    """Regular expression to a non-deterministic automaton (state 0 starts, state 1 accepts)."""

    def __init__(self, pattern: str, fold: bool) -> None:
        self.text, self.at, self.fold = pattern, 0, fold
        self.moves: Nfa = [[], []]
        start, end = self._choice()
        if self.at != len(pattern):
            raise ValueError(f"unexpected {pattern[self.at]!r} in {pattern}")
        self.moves[0].append((None, start))
        self.moves[end].append((None, 1))

    def _state(self) -> int:
        self.moves.append([])
        return len(self.moves) - 1

    def _peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def _choice(self) -> tuple[int, int]:
        start, end = self._state(), self._state()
        while True:
            a, b = self._sequence()
            self.moves[start].append((None, a))
            self.moves[b].append((None, end))
            if self._peek() != "|":
                return start, end
            self.at += 1

    def _sequence(self) -> tuple[int, int]:
        start = end = self._state()
        while self._peek() not in ("", "|", ")"):
            begin = self.at
            a, b = self._atom()
            again = self.at
            least, most = self._repeat()
            after = self.at
            for k in range(max(least, 1)):
                if k:  # another copy of the same atom
                    self.at = begin
                    a, b = self._atom()
                    assert self.at == again
                self.moves[end].append((None, a))
                last, end = a, b
            self.at = after
            if most is None:
                self.moves[end].append((None, last))
            if least == 0:
                skip = self._state()
                self.moves[last].append((None, skip))
                self.moves[end].append((None, skip))
                end = skip
        return start, end

    def _repeat(self) -> tuple[int, int | None]:
        mark = self._peek()
        if mark and mark in "?*+":
            self.at += 1
            return {"?": (0, 1), "*": (0, None), "+": (1, None)}[mark]
        if mark == "{":
            found = re.compile(r"\{(\d+),\}").match(self.text, self.at)
            if not found:
                raise ValueError(f"only {{n,}} is known: {self.text}")
            self.at = found.end()
            return int(found[1]), None
        return 1, 1

    def _atom(self) -> tuple[int, int]:
        mark = self._peek()
        if mark == "(":
            self.at += 1
            inner = self._choice()
            self.at += 1
            # An own state on either side, so that a repeat's way back or past does not meet the inner choice's.
            start, end = self._state(), self._state()
            self.moves[start].append((None, inner[0]))
            self.moves[inner[1]].append((None, end))
            return start, end
        if mark == "[":
            end = self.text.index("]", self.at + 2)
            codes = self._class(self.text[self.at + 1 : end])
            self.at = end + 1
        else:
            codes = {self._char()}
        if self.fold:
            codes = {x for c in codes for x in (ord(chr(c).lower()), ord(chr(c).upper())) if x < 128}
        a, b = self._state(), self._state()
        self.moves[a].append((frozenset(codes), b))
        return a, b

    def _char(self) -> int:
        if self.text.startswith("\\x", self.at):
            self.at += 4
            return int(self.text[self.at - 2 : self.at], 16)
        if self._peek() == "\\":
            self.at += 1
        self.at += 1
        return ord(self.text[self.at - 1])

    @staticmethod
    def _class(inner: str) -> set[int]:
        codes: set[int] = set()
        for a, b in re.findall(r"(.)(?:-(.))?", inner):
            codes.update(range(ord(a), ord(b or a) + 1))
        return codes


def _closure(moves: Nfa, states: set[int]) -> frozenset[int]:
    seen, todo = set(states), list(states)
    while todo:
        for codes, to in moves[todo.pop()]:
            if codes is None and to not in seen:
                seen.add(to)
                todo.append(to)
    return frozenset(seen)


def _step(moves: Nfa, states: frozenset[int], code: int) -> frozenset[int]:
    return _closure(moves, {to for s in states for codes, to in moves[s] if codes and code in codes})


def _search_table(moves: Nfa) -> tuple[list[list[int]], list[list[bool]]]:
    """Next state and "a match ended before this byte" for each state and byte of a search.

    A state is a row of attempts, the earliest first, each a set of automaton states not held by an earlier one.
    """
    begin = _closure(moves, {0})
    if 1 in begin:
        raise ValueError("a rule must not match the empty text")

    def advance(state: tuple[frozenset[int], ...], code: int) -> tuple[frozenset[int], ...]:
        held: set[int] = set()
        row = []
        for attempt in (*state, begin):
            found = _step(moves, attempt, code) - held
            if found:
                row.append(frozenset(found))
                held |= found
                if 1 in found:
                    break  # later attempts start inside this match
        return tuple(row)

    def accepts(state: tuple[frozenset[int], ...]) -> bool:
        return bool(state) and 1 in state[-1]

    ids, rows, ends, todo = {(): 0}, [], [], [()]
    while todo:
        state = todo.pop(0)
        row, end = [], []
        for code in range(256):
            if accepts(state):
                if len(state) > 1:
                    raise ValueError("this rule needs a second look at its matches")
                found = _step(moves, state[0], code)
                over = not found
                after = advance((), code) if over else (found,)
                if found and 1 not in found:
                    raise ValueError("this rule needs a second look at its matches")
            else:
                over, after = False, advance(state, code)
            if after not in ids:
                ids[after] = len(ids)
                todo.append(after)
            row.append(ids[after])
            end.append(over)
        rows.append(row)
        ends.append(end)
    return rows, ends


class Automaton(NamedTuple):
    """``next[s]`` has 256 states; a state ``s >= quiet`` is entered where matches of ``ended[s]`` end before the byte."""

    next: list[list[int]]
    quiet: int
    ended: dict[int, tuple[int, ...]]
    rules: tuple[Rule, ...]
    backward: list[tuple[Nfa, frozenset[int]]]


def _minimised(rows: list[list[tuple[int, int]]]) -> tuple[list[list[tuple[int, int]]], int]:
    """Moore's partition refinement: states with equal outputs and successors for all bytes are one."""
    part = [0] * len(rows)
    while True:
        keys = [(part[s], tuple((part[to], out) for to, out in row)) for s, row in enumerate(rows)]
        names = {k: n for n, k in enumerate(dict.fromkeys(keys))}
        found = [names[k] for k in keys]
        if len(names) == len(set(part)):
            break
        part = found
    first = {p: s for s, p in reversed(list(enumerate(part)))}
    order = sorted(first)
    place = {p: n for n, p in enumerate(order)}
    return [[(place[part[to]], out) for to, out in rows[first[p]]] for p in order], place[part[0]]


@cache
def compile_rules(rules: tuple[Rule, ...]) -> Automaton:
    """One minimised automaton for all rules; made once per Python worker."""
    nfas = [_Parser(r.pattern, r.fold).moves for r in rules]
    tables = [_search_table(m) for m in nfas]
    # Bytes that no rule tells apart are one column of the construction.
    columns: dict[tuple, int] = {}
    kind = [columns.setdefault(tuple((row[c], end[c]) for t in tables for row, end in zip(*t, strict=True)), len(columns)) for c in range(256)]
    sample = [kind.index(k) for k in range(len(columns))]
    start = (0,) * len(rules)
    ids, rows, todo = {start: 0}, [], [start]
    while todo:
        state = todo.pop(0)
        row = []
        for code in sample:
            after = tuple(t[0][s][code] for t, s in zip(tables, state, strict=True))
            out = sum(t[1][s][code] << k for k, (t, s) in enumerate(zip(tables, state, strict=True)))
            if after not in ids:
                ids[after] = len(ids)
                todo.append(after)
            row.append((ids[after], out))
        rows.append(row)
    rows, first = _minimised(rows)
    assert first == 0
    # A state entered at the end of a match is a copy of its own, so that the scan sees it by its number.
    copies = {pair: len(rows) + n for n, pair in enumerate(dict.fromkeys(p for row in rows for p in row if p[1]))}
    table = [[copies.get(row[k], row[k][0]) for k in kind] for row in rows]
    ended = {n: tuple(k for k in range(len(rules)) if out >> k & 1) for (_, out), n in copies.items()}
    table += [table[to] for to, _ in copies]
    return Automaton(table, len(rows), ended, rules, [_reversed(m) for m in nfas])


def _reversed(moves: Nfa) -> tuple[Nfa, frozenset[int]]:
    back: Nfa = [[] for _ in moves]
    for s, row in enumerate(moves):
        for codes, to in row:
            back[to].append((codes, s))
    return back, _closure(back, {1})


def _start_of(backward: tuple[Nfa, frozenset[int]], data: bytes, end: int, least: int) -> int:
    """The leftmost start, not before ``least``, of a match that ends at ``end``."""
    moves, states = backward
    found, at = end, end
    while at > least and states:
        at -= 1
        states = _step(moves, states, data[at])
        if 0 in states:
            found = at
    return found


def find_secrets(text: str, automaton: Automaton) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all matches in code points, by start, then the order of the rules."""
    data = text.encode("utf-8", "surrogatepass") + b"\n"
    table, quiet, state = automaton.next, automaton.quiet, 0
    ends: list[tuple[int, int]] = []
    for at, byte in enumerate(data):
        state = table[state][byte]
        if state >= quiet:
            ends += [(at, k) for k in automaton.ended[state]]
    if not ends:
        return []
    free = [0] * len(automaton.rules)
    found = []
    for end, k in ends:
        rule = automaton.rules[k]
        start = _start_of(automaton.backward[k], data, end, free[k])
        free[k] = end
        match = re.fullmatch(rule.pattern, data[start:end].decode(), re.ASCII | (re.IGNORECASE if rule.fold else 0))
        if match and len(match[rule.group]) >= rule.least:
            found.append((start, end, k))
    found.sort(key=lambda x: (x[0], x[2]))
    plain = len(data) == len(text) + 1
    point = (lambda b: b) if plain else (lambda b: len(data[:b].decode("utf-8", "surrogatepass")))
    return [(point(a), point(b), automaton.rules[k].kind) for a, b, k in found]


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: int = len(BASE_RULES)) -> DataFrame:
    """Per document: doc_id, the count of each of the first ``base`` rules, their digest and all spans.

    ``base_sha256`` is that of ``kind:start:end`` of the base rules, joined by commas; ``spans`` lists those of all rules
    likewise (code points, end exclusive). Null counts as empty: no spans and the digest of the empty text. Whole texts are
    scanned; repeated rows and null ids are returned as they come; an empty table gives none; other columns are not read.
    """
    names = [r.kind for r in rules[:base]]
    schema = ", ".join(["doc_id bigint", *[f"n_{n} bigint" for n in names], "base_sha256 string", "spans string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = compile_rules(rules)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                spans = find_secrets(text or "", automaton)
                plain = [s for s in spans if s[2] in names]
                joined = ",".join(f"{k}:{a}:{b}" for a, b, k in plain).encode()
                rows.append((
                    *[sum(s[2] == n for s in plain) for n in names],
                    hashlib.sha256(joined).hexdigest(),
                    ",".join(f"{k}:{a}:{b}" for a, b, k in spans),
                ))
            columns = list(zip(*rows, strict=True)) or [()] * (len(names) + 2)
            kinds = [pa.int64()] * len(names) + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]],
                ["doc_id", *[f"n_{n}" for n in names], "base_sha256", "spans"],
            )

    bounded_batches(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), valid_text().alias("text"))
    return narrow.mapInArrow(frugal(run), schema)
