"""Many byte patterns as one minimal deterministic automaton in transition arrays.

A pattern is a regular expression of literals, ``[...]``, ``(...)``, ``|``, ``?``, ``*``, ``+`` and ``{m,n}``, followed
by a ``tail``: a class of which one byte or more must follow.  Matches are leftmost, do not overlap within a rule, and
take all of the tail.  Subset construction keeps the begun matches of a rule in the order of their starts and drops
the later ones once the first is accepted; where a match ends, the search starts afresh in the same step.  The rules'
automata are minimised, multiplied (reachable states only) and minimised again.

Rules must not need to look back: a match, once accepted, grows or ends with each byte, and no earlier start may still
be open when a later one is accepted.  ``compiled`` raises ``ValueError`` for others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Rule:
    name: str
    pattern: str
    tail: str = ""
    #: Bytes of the tail, and of the whole match, that a find must have; shorter matches are consumed and dropped.
    tail_least: int = 1
    least: int = 0


class _Parser:
    def __init__(self, pattern: str):
        self.text, self.at = pattern, 0

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def whole(self):
        tree = self.either()
        if self.at != len(self.text):
            raise ValueError(f"unexpected {self.peek()!r} in {self.text!r}")
        return tree

    def either(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.take()
            options.append(self.sequence())
        return ("either", options)

    def sequence(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.repeated())
        return ("sequence", parts)

    def repeated(self):
        part = self.single()
        mark = self.peek()
        if mark and mark in "?*+":
            self.take()
            return ("repeat", part, int(mark == "+"), 1 if mark == "?" else None)
        if mark == "{":
            bounds = self.text[self.at + 1 : self.text.index("}", self.at)]
            self.at += len(bounds) + 2
            low, comma, high = bounds.partition(",")
            return ("repeat", part, int(low), (int(high) if high else None) if comma else int(low))
        return part

    def single(self):
        c = self.take()
        if c == "(":
            tree = self.either()
            if self.peek() != ")":
                raise ValueError(f"open group in {self.text!r}")
            self.take()
            return tree
        if c == "[":
            chosen: set[int] = set()
            while self.peek() != "]":
                low = self.byte(self.take())
                if self.peek() == "-" and self.text[self.at + 1] != "]":
                    self.take()
                    chosen.update(range(low, self.byte(self.take()) + 1))
                else:
                    chosen.add(low)
            self.take()
            return ("set", frozenset(chosen))
        return ("set", frozenset([self.byte(c)]))

    def byte(self, c: str) -> int:
        if c == "\\":
            c = self.take()
            if c == "x":
                self.at += 2
                return int(self.text[self.at - 2 : self.at], 16)
        return ord(c)


class Nfa:
    """A rule as a machine with free moves; ``loud`` states are finds, ``silent`` ones only consume."""

    def __init__(self, rule: Rule):
        self.free: list[set[int]] = []
        self.moves: list[list[tuple[frozenset[int], int]]] = []
        self.start = self.state()
        end = self.build(_Parser(rule.pattern).whole(), self.start)
        self.silent: set[int] = set()
        if rule.tail:
            (kind, tail) = _Parser(rule.tail).single()
            for k in range(rule.tail_least):
                following = self.state()
                self.moves[end].append((tail, following))
                end = following
                if k < rule.tail_least - 1:
                    self.silent.add(end)
            self.moves[end].append((tail, end))
        self.loud = end

    def state(self) -> int:
        self.free.append(set())
        self.moves.append([])
        return len(self.free) - 1

    def build(self, tree, begin: int) -> int:
        kind = tree[0]
        if kind == "set":
            end = self.state()
            self.moves[begin].append((tree[1], end))
            return end
        if kind == "sequence":
            for part in tree[1]:
                begin = self.build(part, begin)
            return begin
        if kind == "either":
            end = self.state()
            for part in tree[1]:
                self.free[self.build(part, begin)].add(end)
            return end
        _, part, low, high = tree
        for _ in range(low):
            begin = self.build(part, begin)
        if high is None:
            loop = self.state()
            self.free[begin].add(loop)
            self.free[self.build(part, loop)].add(loop)
            return loop
        end = self.state()
        self.free[begin].add(end)
        for _ in range(high - low):
            begin = self.build(part, begin)
            self.free[begin].add(end)
        return end

    def closed(self, states) -> frozenset[int]:
        found, open_ = set(states), list(states)
        while open_:
            for s in self.free[open_.pop()]:
                if s not in found:
                    found.add(s)
                    open_.append(s)
        return frozenset(found)

    def step(self, states: frozenset[int], byte: int) -> frozenset[int]:
        return self.closed({t for s in states for chosen, t in self.moves[s] if byte in chosen})

    def code(self, states: frozenset[int]) -> int:
        """0: open, 1: consumed if it ends here, 3: found if it ends here."""
        return 3 if self.loud in states else int(bool(self.silent & states))


def deterministic(nfa: Nfa, samples: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Transitions (states x byte classes) and codes, by subset construction over ordered starts."""
    begin = nfa.closed({nfa.start})
    if nfa.code(begin):
        raise ValueError("a rule may not match nothing")
    known: dict[tuple, int] = {(): 0}
    order: list[tuple] = [()]
    table: list[list[int]] = []
    for state in order:
        row = []
        accepted = bool(state) and nfa.code(state[0]) > 0
        for byte in samples:
            seen: set[int] = set()
            moved = []
            for thread in state if accepted else (*state, begin):
                to = nfa.step(thread, byte) - seen
                if to:
                    seen |= to
                    moved.append(to)
            if accepted and not moved:
                fresh = nfa.step(begin, byte)
                moved = [fresh] if fresh else []
                if fresh and nfa.code(fresh):
                    raise ValueError("a rule may not match a single byte")
            elif accepted and not nfa.code(moved[0]):
                raise ValueError("a match that was accepted may not open again")
            for place, thread in enumerate(moved):
                if nfa.code(thread):
                    if place:
                        raise ValueError("a later start was accepted before an earlier one")
                    moved = [thread]
                    break
            to = tuple(moved)
            if to not in known:
                known[to] = len(order)
                order.append(to)
            row.append(known[to])
        table.append(row)
    codes = [nfa.code(s[0]) if s else 0 for s in order]
    return np.array(table, np.int64), np.array(codes, np.int64)


def minimal(table: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same automaton with equivalent states merged; the first state stays the first."""
    _, group = np.unique(codes, return_inverse=True)
    while True:
        _, finer = np.unique(np.column_stack([group, group[table]]), axis=0, return_inverse=True)
        if finer.max() == group.max():
            break
        group = finer
    lead = np.unique(group, return_index=True)[1]
    place = np.empty(len(lead), np.int64)
    order = np.argsort(lead)
    place[order] = np.arange(len(lead))  # numbered by first member, so state 0 keeps its number
    return place[group[table[lead[order]]]], codes[lead[order]]


def product(machines: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """All rules side by side: reachable states only; two code bits a rule."""
    known: dict[tuple, int] = {(0,) * len(machines): 0}
    order = list(known)
    table: list[list[int]] = []
    for state in order:
        rows = np.stack([t[s] for (t, _), s in zip(machines, state)], axis=1)
        row = []
        for to in map(tuple, rows.tolist()):
            if to not in known:
                known[to] = len(order)
                order.append(to)
            row.append(known[to])
        table.append(row)
    states = np.array(order)
    codes = sum(c[states[:, k]] << (2 * k) for k, (_, c) in enumerate(machines))
    return np.array(table, np.int64), codes


class Backward:
    """From the end of a match to its start: the reversed rule, its sets of states kept as they come up."""

    def __init__(self, rule: Rule):
        self.nfa = nfa = Nfa(rule)
        self.into: dict[int, list[tuple[frozenset[int], int]]] = {}
        for a, moves in enumerate(nfa.moves):
            for chosen, b in moves:
                self.into.setdefault(b, []).append((chosen, a))
        self.free: dict[int, set[int]] = {}
        for a, ends in enumerate(nfa.free):
            for b in ends:
                self.free.setdefault(b, set()).add(a)
        self.steps: dict[tuple[frozenset[int], int], frozenset[int]] = {}

    def closed(self, states) -> frozenset[int]:
        found, open_ = set(states), list(states)
        while open_:
            for s in self.free.get(open_.pop(), ()):
                if s not in found:
                    found.add(s)
                    open_.append(s)
        return frozenset(found)

    def start(self, data: memoryview, end: int, bound: int) -> int:
        """The smallest start at or after ``bound`` of a match that ends at ``end``."""
        states, found, at = self.closed({self.nfa.loud}), -1, end
        while states and at > bound:
            at -= 1
            key = (states, data[at])
            states = self.steps.get(key)
            if states is None:
                found_to = {a for s in key[0] for chosen, a in self.into.get(s, ()) if key[1] in chosen}
                states = self.steps[key] = self.closed(found_to)
            if self.nfa.start in states:
                found = at
        return found


class Automaton:
    """Transition arrays of a set of rules, and the pass over bytes.  Bytes of no rule (such as 0xFF) end all matches."""

    #: Bytes that a lane takes in a row, and bytes of a block of lanes.
    LANE = 1024
    BLOCK = 4 << 20
    #: Fewer lanes than this are stepped one by one.
    FEW = 24

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        nfas = [Nfa(r) for r in rules]
        marks = np.zeros((256, 0), bool)
        for chosen in {c for n in nfas for moves in n.moves for c, _ in moves}:
            column = np.zeros((256, 1), bool)
            column[list(chosen)] = True
            marks = np.hstack([marks, column])
        _, first, classes = np.unique(marks, axis=0, return_index=True, return_inverse=True)
        samples = first.tolist()
        machines = [minimal(*deterministic(n, samples)) for n in nfas]
        table, codes = minimal(*product(machines))
        self.shift = max(1, (len(samples) - 1).bit_length())
        self.classes = classes.reshape(-1).astype(np.int32)
        wide = np.zeros((len(table), 1 << self.shift), np.int32)
        wide[:, : len(samples)] = table << self.shift
        self.table, self.codes = wide.ravel(), codes.astype(np.uint32)
        self.accepts = np.uint32(sum(1 << (2 * k) for k in range(len(rules))))
        self.backward = [Backward(r) for r in rules]

    def states(self, classes: np.ndarray, carried: int) -> np.ndarray:
        """The state after each byte, beginning in state ``carried``.

        The block is cut into lanes that step side by side, each from a guessed state; a lane whose guess was wrong
        goes again until it meets the states it had, which most do within a few bytes.
        """
        count = len(classes)
        lanes = -(-count // self.LANE)
        padded = np.zeros(lanes * self.LANE, np.int32)
        padded[:count] = classes
        padded = np.ascontiguousarray(padded.reshape(lanes, self.LANE).T)
        out = np.empty((self.LANE, lanes), np.int32)
        start = np.zeros(lanes, np.int32)
        start[0] = carried
        now = start
        for k in range(self.LANE):
            np.take(self.table, now + padded[k], out=out[k], mode="clip")
            now = out[k]
        while True:
            true = np.concatenate([[np.int32(carried)], out[-1, :-1]])
            lane = np.flatnonzero(true != start)
            if not len(lane):
                return out.T.ravel()[:count]
            start[lane] = now = true[lane]
            k = 0
            while k < self.LANE and len(lane) >= self.FEW:
                now = self.table[now + padded[k, lane]]
                new = now != out[k, lane]
                lane, now = lane[new], now[new]
                out[k, lane] = now
                k += 1
            for one, state in zip(lane.tolist(), now.tolist()):
                self.again(padded[:, one], out[:, one], state, k)

    def again(self, classes: np.ndarray, states: np.ndarray, state: int, begin: int) -> None:
        """Step one lane from its byte ``begin`` until it meets the states it had."""
        table, new = memoryview(self.table), []
        for byte, old in zip(classes[begin:].tolist(), states[begin:].tolist()):
            state = table[state + byte]
            if state == old:
                break
            new.append(state)
        states[begin : begin + len(new)] = new

    def ends(self, data: np.ndarray) -> Iterator[tuple[int, int, bool]]:
        """(end, rule, found) of every match in order, consumed ones included."""
        state, before = 0, np.zeros(1, np.uint32)
        for begin in range(0, len(data), self.BLOCK):
            states = self.states(self.classes[data[begin : begin + self.BLOCK]], state)
            codes = np.concatenate([before, self.codes[states >> self.shift]])
            ended = codes[:-1] & ~codes[1:] & self.accepts
            for at in np.flatnonzero(ended).tolist():
                marks, code = int(ended[at]), int(codes[at])
                for rule in range(len(self.rules)):
                    if marks >> (2 * rule) & 1:
                        yield begin + at, rule, bool(code >> (2 * rule) & 2)
            state, before = int(states[-1]), codes[-1:]

    def finds(self, data: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(rule, start, end) of every find, by end; the last byte of ``data`` must be of no rule."""
        view = memoryview(data)
        consumed = [0] * len(self.rules)
        for end, rule, found in self.ends(data):
            if found:
                start = self.backward[rule].start(view, end, consumed[rule])
                if end - start >= self.rules[rule].least:
                    yield rule, start, end
            consumed[rule] = end
