"""Deterministic byte automata from rule regexes: parsing, subset construction, minimisation.

The rules know literals, ``.``, classes, escapes, groups, ``|`` and the repeats ``? * + {m} {m,} {m,n}`` over
bytes. ``(?i)`` at the start of a rule lets ASCII letters match in either case. Nothing is anchored.
"""

from __future__ import annotations

from collections.abc import Iterable

# The escapes that stand for classes or control characters.
_CLASS_ESCAPES = {"d": frozenset(b"0123456789"), "s": frozenset(b" \t\n\r\f\v")}
_CLASS_ESCAPES["w"] = frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_")
_CONTROL_ESCAPES = {"n": 10, "t": 9, "r": 13, "f": 12, "v": 11}
_ALL = frozenset(range(256))


class Rule:
    """A parsed rule: a tree of ("set", bytes), ("seq", parts), ("alt", parts) and ("rep", part, least, most)."""

    def __init__(self, pattern: str):
        self.fold = pattern.startswith("(?i)")
        self._text = pattern[4:] if self.fold else pattern
        self._at = 0
        self.tree = self._alternatives()
        if self._at != len(self._text):
            raise ValueError(f"cannot read rule at {self._text[self._at:]!r}")

    def _next(self) -> str:
        return self._text[self._at : self._at + 1]

    def _take(self) -> str:
        self._at += 1
        return self._text[self._at - 1]

    def _alternatives(self):
        parts = [self._sequence()]
        while self._next() == "|":
            self._take()
            parts.append(self._sequence())
        return parts[0] if len(parts) == 1 else ("alt", parts)

    def _sequence(self):
        parts = []
        while self._next() not in ("", "|", ")"):
            part = self._atom()
            while (repeat := self._repeat()) is not None:
                part = ("rep", part, *repeat)
            parts.append(part)
        return ("seq", parts)

    def _repeat(self) -> tuple[int, int | None] | None:
        c = self._next()
        if c and c in "?*+":
            self._take()
            return {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
        if c == "{":
            end = self._text.index("}", self._at)
            least, comma, most = self._text[self._at + 1 : end].partition(",")
            self._at = end + 1
            return int(least), (int(most) if most else None) if comma else int(least)
        return None

    def _atom(self):
        c = self._take()
        if c == "(":
            if self._text.startswith("?:", self._at):
                self._at += 2
            inner = self._alternatives()
            if self._take() != ")":
                raise ValueError("unclosed group")
            return inner
        if c == "[":
            return ("set", self._class())
        if c == ".":
            return ("set", _ALL - {10})
        if c == "\\":
            return ("set", self._folded(self._escape()))
        raw = c.encode()
        return ("seq", [("set", self._folded({b})) for b in raw])

    def _escape(self) -> frozenset[int]:
        c = self._take()
        if c in _CLASS_ESCAPES:
            return _CLASS_ESCAPES[c]
        if c == "x":
            self._at += 2
            return frozenset([int(self._text[self._at - 2 : self._at], 16)])
        return frozenset([_CONTROL_ESCAPES.get(c, ord(c))])

    def _class(self) -> frozenset[int]:
        negated = self._next() == "^"
        if negated:
            self._take()
        found: set[int] = set()
        first = True
        while (c := self._take()) != "]" or first:
            first = False
            low = self._escape() if c == "\\" else frozenset([ord(c)])
            if self._next() == "-" and self._text[self._at + 1] != "]" and len(low) == 1:
                self._take()
                c = self._take()
                high = self._escape() if c == "\\" else frozenset([ord(c)])
                low = frozenset(range(min(low), max(high) + 1))
            found |= low
        folded = self._folded(found)
        return _ALL - folded if negated else folded

    def _folded(self, found: Iterable[int]) -> frozenset[int]:
        found = frozenset(found)
        return found | frozenset(b"".join(bytes([b]).swapcase() for b in found)) if self.fold else found


class _Nfa:
    def __init__(self):
        self.empty: list[list[int]] = []
        self.moves: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.moves.append([])
        return len(self.empty) - 1

    def add(self, tree, start: int, backwards: bool) -> int:
        """Builds what matches the tree from a state on; the state where it ends."""
        kind = tree[0]
        if kind == "set":
            end = self.state()
            self.moves[start].append((tree[1], end))
            return end
        if kind == "seq":
            for part in reversed(tree[1]) if backwards else tree[1]:
                start = self.add(part, start, backwards)
            return start
        if kind == "alt":
            end = self.state()
            for part in tree[1]:
                first = self.state()
                self.empty[start].append(first)
                self.empty[self.add(part, first, backwards)].append(end)
            return end
        _, part, least, most = tree
        for _ in range(least):
            start = self.add(part, start, backwards)
        if most is None:
            loop, end = self.state(), self.state()
            self.empty[start].append(loop)
            self.empty[self.add(part, loop, backwards)].append(loop)
            self.empty[loop].append(end)
            return end
        ends = [start]
        for _ in range(most - least):
            start = self.add(part, start, backwards)
            ends.append(start)
        end = self.state()
        for e in ends:
            self.empty[e].append(end)
        return end


class Automaton:
    """A minimal automaton: ``rows[state][byte]`` is the next state, ``accepts[state]`` the rules that match there.

    States from ``first_accepting`` on accept. State 0 is the start; ``dead``, where there is one, leads nowhere.
    """

    def __init__(self, rules: list[Rule], floating: bool, backwards: bool = False):
        nfa = _Nfa()
        root = nfa.state()
        ends = {}
        for k, rule in enumerate(rules):
            first = nfa.state()
            nfa.empty[root].append(first)
            ends[nfa.add(rule.tree, first, backwards)] = k
        if floating:
            nfa.moves[root].append((_ALL, root))
        rows, accepts = _minimised(*_subsets(nfa, root, ends))
        order = [0, *sorted(range(1, len(rows)), key=lambda s: bool(accepts[s]))]
        place = {s: k for k, s in enumerate(order)}
        self.rows = [[place[t] for t in rows[s]] for s in order]
        self.accepts = [accepts[s] for s in order]
        self.first_accepting = next((k for k, a in enumerate(self.accepts) if a), len(order))
        self.dead = next((k for k, r in enumerate(self.rows) if not self.accepts[k] and set(r) == {k}), -1)


def _subsets(nfa: _Nfa, root: int, ends: dict[int, int]) -> tuple[list[list[int]], list[frozenset[int]], list[int]]:
    """Subset construction over classes of bytes that no rule tells apart: rows by class, what accepts, class of each byte."""
    sets = list(dict.fromkeys(s for moves in nfa.moves for s, _ in moves))
    signatures: dict[tuple[bool, ...], int] = {}
    class_of = [signatures.setdefault(tuple(b in s for s in sets), len(signatures)) for b in range(256)]
    shown = [class_of.index(c) for c in range(len(signatures))]

    def closed(states: Iterable[int]) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for t in nfa.empty[todo.pop()]:
                if t not in found:
                    found.add(t)
                    todo.append(t)
        return frozenset(s for s in found if nfa.moves[s] or s in ends)

    closures = [closed([s]) for s in range(len(nfa.empty))]
    targets = [[(c, closures[t]) for s, t in moves for c, b in enumerate(shown) if b in s] for moves in nfa.moves]
    number = {closures[root]: 0}
    todo, rows = [closures[root]], []
    for states in todo:
        by_class: list[set[int]] = [set() for _ in shown]
        for s in states:
            for c, reached in targets[s]:
                by_class[c] |= reached
        row = []
        for reached in map(frozenset, by_class):
            if reached not in number:
                number[reached] = len(todo)
                todo.append(reached)
            row.append(number[reached])
        rows.append(row)
    return rows, [frozenset(ends[s] for s in states if s in ends) for states in todo], class_of


def _minimised(rows: list[list[int]], accepts: list[frozenset[int]], class_of: list[int]) -> tuple[list[list[int]], list[frozenset[int]]]:
    """States that no input tells apart become one; rows by byte. The start keeps number 0."""
    blocks: dict = {}
    block = [blocks.setdefault(a, len(blocks)) for a in accepts]
    while True:
        finer: dict = {}
        refined = [finer.setdefault((block[s], *(block[t] for t in row)), len(finer)) for s, row in enumerate(rows)]
        if len(finer) == len(blocks):
            break
        block, blocks = refined, finer
    shown = [block.index(b) for b in range(len(blocks))]
    return [[block[rows[s][c]] for c in class_of] for s in shown], [accepts[s] for s in shown]
