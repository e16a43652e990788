"""Secret scans by one combined automaton.

The regexes of all rules become one minimal deterministic automaton, kept as transition arrays. One pass over the
bytes of a text tells which rules match somewhere; most texts end there. For a rule that does match, an
automaton of the whole rule reversed, run from the end, marks where its matches begin, and an anchored one takes the
longest match from the first of them, then from the first behind that one, and so on. Every marked place has a match,
and from a match the rules either go on matching or end, so the time is in proportion to the text, whatever it holds.

The combined automaton holds the beginnings of the rules, without open repeats at their ends, which would multiply
its states; added rules end at their first repeat. That can only let more texts through to the exact step, and
what the exact step finds is decided by the whole rules.

Defined results: a null or empty text has no spans; spans of one kind never overlap, those of different kinds may; spans
count code points, the end exclusive, ordered by start and then kind as listed; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from clinlake.llm.automaton import Automaton, Rule

# Kinds and rules, the base kinds first.
ASSIGN = r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
BASE_RULES = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{12,}", "hex": r"[0-9a-f]{32,}"}
ADDED_RULES = {
    "private_key": r"-----BEGIN [A-Z ]*PRIVATE KEY-----",
    "github": r"gh[pousr]_[A-Za-z0-9]{36,}",
    "slack": r"xox[abprs]-[A-Za-z0-9-]{10,}",
    "jwt": r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}",
    "google": r"AIza[0-9A-Za-z_-]{35,}",
    "stripe": r"sk_live_[0-9A-Za-z]{16,}",
}
LEAST_ASSIGNED = 8
#: The first repeat of an added rule counts no further than this in the combined automaton.
SHORT_REPEAT = 3


def beginning(tree, short_repeat: int | None = None):
    """A weaker rule for the combined automaton: whatever the rule matches begins with a match of this one.

    An open repeat at the end is cut to its least count. With short_repeat the rule ends at its first open or longer
    repeat, cut to at most that count.
    """
    parts = tree[1] if tree[0] == "seq" else [tree]
    kept = []
    for k, part in enumerate(parts):
        if part[0] == "rep" and (k == len(parts) - 1 or short_repeat is not None):
            least = part[2] if short_repeat is None else min(part[2], short_repeat)
            kept.append(("rep", part[1], least, least))
            break
        kept.append(beginning(part) if k == len(parts) - 1 and part[0] == "seq" else part)
    return ("seq", kept)


class SecretScanner:
    def __init__(self):
        self.kinds = [*BASE_RULES, *ADDED_RULES]
        exact = [Rule(p) for p in (*BASE_RULES.values(), *ADDED_RULES.values())]
        weak = [Rule(p) for p in (*BASE_RULES.values(), *ADDED_RULES.values())]
        for k, rule in enumerate(weak):
            rule.tree = beginning(rule.tree, None if k < len(BASE_RULES) else SHORT_REPEAT)
        self.combined = Automaton(weak, floating=True)
        self._forward = [Automaton([r], floating=False) for r in exact]
        self._backward = [Automaton([r], floating=True, backwards=True) for r in exact]
        self._assign = re.compile(ASSIGN.encode())

    def matching_rules(self, data: bytes) -> frozenset[int]:
        """The rules that match somewhere, from one pass over the bytes."""
        rows, first, state, seen = self.combined.rows, self.combined.first_accepting, 0, set()
        for byte in data:
            state = rows[state][byte]
            if state >= first:
                seen.add(state)
        return frozenset().union(*(self.combined.accepts[s] for s in seen))

    def matches(self, rule: int, data: bytes) -> Iterator[tuple[int, int]]:
        """The leftmost, longest, non-overlapping matches of a rule, in bytes."""
        backward = self._backward[rule]
        rows, first, state, starts = backward.rows, backward.first_accepting, 0, []
        for at in range(len(data) - 1, -1, -1):
            state = rows[state][data[at]]
            if state >= first:
                starts.append(at)
        forward, end = self._forward[rule], 0
        rows, first, dead = forward.rows, forward.first_accepting, forward.dead
        for start in reversed(starts):
            if start < end:
                continue
            state, found = 0, -1
            for at in range(start, len(data)):
                state = rows[state][data[at]]
                if state == dead:
                    break
                if state >= first:
                    found = at + 1
            if found >= 0:
                yield start, found
                end = found

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """(kind, start, end) of a whole text."""
        data = text.encode()
        found = []
        for rule in sorted(self.matching_rules(data)):
            for start, end in self.matches(rule, data):
                if self.kinds[rule] == "assign" and len(self._assign.fullmatch(data[start:end])[2]) < LEAST_ASSIGNED:
                    continue
                found.append((start, rule, end))
        found.sort()
        if len(data) == len(text):
            return [(self.kinds[rule], start, end) for start, rule, end in found]
        points, at = 0, 0
        spans = []
        for start, rule, end in found:
            points, at = points + len(data[at:start].decode()), start
            spans.append((self.kinds[rule], points, points + len(data[start:end].decode())))
        return spans


@lru_cache(maxsize=1)
def scanner() -> SecretScanner:
    """One scanner per worker."""
    return SecretScanner()


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its first kind in angle brackets."""
    parts, end = [], 0
    for kind, start, stop in spans:
        if start >= end:
            parts += [text[end:start], f"<{kind}>"]
        end = max(end, stop)
    return "".join([*parts, text[end:]])


def scanned(text: Column) -> Column:
    """struct of spans (array of kind, start, end) and redacted, the text without them (null where there are none)."""

    @F.pandas_udf("spans array<struct<kind: string, start: long, end: long>>, redacted string")
    def scan(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = scanner()
        for series in texts:
            found = [own.spans(t) for t in series]
            yield pd.DataFrame({
                "spans": [[{"kind": k, "start": s, "end": e} for k, s, e in spans] for spans in found],
                "redacted": [redact(t, spans) if spans else None for t, spans in zip(series, found, strict=True)],
            })

    return scan(F.coalesce(text, F.lit("")))
