"""Detectors that stand in for a text-detection service: they find a pattern in the whole text."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping


def pattern_detector(pattern: str) -> Callable[[], Callable[[str], Mapping]]:
    """A detector factory, as ``annotate`` takes it."""

    def open_client() -> Callable[[str], Mapping]:
        compiled = re.compile(pattern)

        def detect(text: str) -> Mapping:
            return {
                "Entities": [
                    {"Id": i, "Text": m.group(), "Score": 1.0, "BeginOffset": m.start(), "EndOffset": m.end()}
                    for i, m in enumerate(compiled.finditer(text))
                ]
            }

        return detect

    return open_client


def failing_detector(pattern: str) -> Callable[[], Callable[[str], Mapping]]:
    """A detector factory whose detector refuses texts that hold the pattern, and finds nothing in others."""

    def open_client() -> Callable[[str], Mapping]:
        compiled = re.compile(pattern)

        def detect(text: str) -> Mapping:
            if compiled.search(text):
                raise ValueError("refused")
            return {"Entities": []}

        return detect

    return open_client


def identified(factory: Callable[[], Callable[[str], Mapping]]) -> Callable[[], Callable[[str], Mapping]]:
    """The same detector, with an id of its own in the response to every call."""

    def open_client() -> Callable[[str], Mapping]:
        detect = factory()
        return lambda text: {**detect(text), "CallId": uuid.uuid4().hex}

    return open_client


NUMBERS = "[0-9]+"
WORDS_IN_CAPITALS = "[A-Z][A-Z]+"
