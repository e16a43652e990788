"""Personal data by a character-level bidirectional LSTM with CRF transitions.

Base rules find what has a fixed form. The model, trained in numpy on labelled spans, reads every text whole, as
overlapping windows: each window is decoded by its best path, every character takes its tag from the window in which
it stands farthest from an edge, and runs of one tag in the text so joined are spans. Spans of the model are
added where no base span stands and where they hold what their kind needs at the least.

Labelled spans come from pieces of the corpus, at most ``SAMPLE_PIECES`` of ``PIECE_CHARS`` characters (those with the
smallest hashes), labelled by the base rules, into which personal data written in many ways, and numbers, dates
and keys that are none, are set.

Defined results: a null or empty text has no spans; spans count code points, the end exclusive, ordered by start and
then kind as listed; base spans of one kind never overlap, those of different kinds may; other columns are ignored.
"""

from __future__ import annotations

import pickle
import re
import string
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinlake.llm.tagger import Tagger, symbols

KINDS = ("email", "ip", "card", "phone")
SAMPLE_PIECES, PIECE_CHARS = 2000, 160
TRAIN_STEPS, TRAIN_WINDOWS, TRAIN_CHARS = 260, 128, 72
#: Different examples; the windows of a step are drawn from them.
TRAIN_EXAMPLES = 6000
WINDOW, OVERLAP = 256, 32
#: Windows read at once by a worker.
AT_ONCE = 1024
_SEED = 11

# The base rules.
_AT, _LOCAL, _DOMAIN = "@", re.compile(r"[A-Za-z0-9._%+-]"), re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Possessive, and from the first digit of a run only: the same matches, in time linear in the text.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (14, 19), (10, 15)

#: The part of a span of the model that is added: what its kind is at the least, however it is written.
_ADDED = {
    "email": re.compile(
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:@| ?[(\[]at[)\]] ?| at )[A-Za-z0-9-]++(?:(?:\.| ?[(\[]dot[)\]] ?| dot )[A-Za-z0-9-]++)+"
    ),
    "ip": re.compile(r"[0-9]{1,3}(?: ?[\[(]?\.[\])]? ?[0-9]{1,3}){3}"),
    "card": re.compile(r"[0-9](?:[ .-]?[0-9]){12,18}"),
    "phone": re.compile(r"(?:\+|00|\()?[0-9](?:[ ().-]{0,2}[0-9]){7,14}"),
}


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base rules' matches."""
    found, end, at = [], 0, text.find(_AT)
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text, start - 1):
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            end = match.end()
            found.append((start, 0, end))
        at = text.find(_AT, max(at + 1, end))
    found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(int(p[-4:]) <= 255 and len(p.lstrip("0")) <= 3 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = re.sub(r"[^0-9]", "", m[0])
        if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if PHONE_DIGITS[0] <= sum(c in string.digits for c in m[0]) <= PHONE_DIGITS[1]:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def written(kind: int, rng: np.random.Generator) -> str:
    """Personal data of a kind, written in one of many ways."""

    def digits(n: int) -> str:
        return "".join(map(str, rng.integers(0, 10, n)))

    def word(low: int = 3, high: int = 9) -> str:
        return "".join(rng.choice(list(string.ascii_lowercase), rng.integers(low, high)))

    if kind == 0:
        local = word() + rng.choice(["", "." + word(), "_" + word(), "." + digits(2), "+" + word(), digits(3)])
        host = word() + rng.choice(["", digits(1), "-" + word(), "." + word()])
        end = rng.choice(["com", "org", "net", "de", "fr", "es", "co.uk", "example.com"])
        at, dot = rng.choice([("@", "."), ("@", "."), ("@", "."), (" (at) ", "."), (" [at] ", " [dot] "), (" at ", " dot ")])
        return f"{local}{at}{host}{dot}{end.replace('.', dot)}"
    if kind == 1:
        parts = [str(p) for p in rng.integers(0, 256, 4)]
        return rng.choice([".", ".", ".", " . ", "[.]"]).join(parts)
    if kind == 2:
        body = rng.choice(["4", "51", "37", "6011"]) + digits(12)
        body = body[:15]
        number = next(body + d for d in string.digits if luhn(body + d))
        between = rng.choice(["", "", " ", "-", "."])
        return between.join(number[k : k + 4] for k in range(0, 16, 4))
    code, area, first, last = rng.integers(1, 99), digits(3), digits(3), digits(4)
    forms = [
        f"+{code} ({area}) {first}-{last}", f"+{code} {area} {first} {last}", f"+{code}-{area}-{first}-{last}", f"+{code}{area}{first}{last}",
        f"({area}) {first}-{last}", f"{area}-{first}-{last}", f"00{code} {area} {first}{last}", f"+{code} ({area}) {first}-{last}",
    ]
    return str(rng.choice(forms))


def harmless(rng: np.random.Generator) -> str:
    """A number, date, key or the like that is not personal data."""

    def from_set(letters: str, low: int, high: int) -> str:
        return "".join(rng.choice(list(letters), rng.integers(low, high)))

    forms = [
        lambda: str(rng.integers(0, 5000)),
        lambda: f"{rng.integers(1900, 2100)}-{rng.integers(1, 13):02}-{rng.integers(1, 29):02}",
        lambda: f"{rng.integers(0, 24):02}:{rng.integers(0, 60):02}:{rng.integers(0, 60):02}",
        lambda: f"{rng.integers(0, 100)}.{rng.integers(0, 100)}",
        lambda: f"v{rng.integers(0, 10)}.{rng.integers(0, 20)}.{rng.integers(0, 20)}",
        lambda: f"${rng.integers(1, 999)},{rng.integers(100, 999)}.{rng.integers(10, 99)}",
        lambda: from_set("0123456789abcdef", 16, 42),
        lambda: f'token = "{from_set("0123456789abcdef", 20, 42)}"',
        lambda: f"password={from_set('0123456789abcdef', 10, 20)}",
        lambda: "AKIA" + from_set(string.ascii_uppercase + string.digits, 12, 20),
        lambda: from_set(string.digits, 2, 9),
        lambda: f"#{from_set(string.digits, 3, 7)} ***",
        lambda: f"https://www.{from_set(string.ascii_lowercase, 4, 9)}.com/{from_set(string.digits, 2, 7)}",
        lambda: f"@{from_set(string.ascii_lowercase, 4, 9)}",
        lambda: f"{rng.integers(1, 100)} %, {rng.integers(1, 100)} $ & <{from_set(string.ascii_lowercase, 2, 5)}>",
    ]
    return forms[rng.integers(len(forms))]()


def example(piece: str, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and tags of TRAIN_CHARS characters of a piece with labelled and harmless strings set in."""
    words = re.split(r"(?<=\s)", piece)
    while sum(map(len, words)) < TRAIN_CHARS:
        words += [" ", *words[:20], "the "]
    text, tags = "", []
    for word in words:
        chance = rng.random()
        if chance < 0.06:
            kind = int(rng.integers(len(KINDS)))
            data = written(kind, rng)
            text, tags = text + data, tags + [kind + 1] * len(data)
            word = rng.choice([" ", ", ", ". ", "\n"]) + word
        elif chance < 0.10:
            word = harmless(rng) + " " + word
        elif chance < 0.11:
            word = str(rng.choice(["at ", "dot ", "at the dot ", "the at "])) * int(rng.integers(1, 6)) + word
        own = np.zeros(len(word), dtype=np.int64)
        for start, kind, end in base_spans(word):
            own[start:end] = kind + 1
        text, tags = text + word, tags + own.tolist()
    start = int(rng.integers(0, max(1, len(text) - TRAIN_CHARS)))
    return symbols(text)[start : start + TRAIN_CHARS], np.array(tags[start : start + TRAIN_CHARS])


def trained(pieces: Sequence[str]) -> Tagger:
    """The model of these pieces of text and the strings set into them."""
    rng = np.random.default_rng(_SEED)
    pieces = [p for p in pieces if p.strip()] or ["the text of no document at all stands here, so these words do. "]

    rows = [example(pieces[rng.integers(len(pieces))], rng) for _ in range(TRAIN_EXAMPLES)]
    x, y = (np.stack(part, axis=1) for part in zip(*rows, strict=True))

    def batches() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for _ in range(TRAIN_STEPS):
            drawn = rng.integers(0, TRAIN_EXAMPLES, TRAIN_WINDOWS)
            yield x[:, drawn], y[:, drawn]

    model = Tagger(len(KINDS) + 1, _SEED)
    model.train(batches())
    return model


def fit(docs: DataFrame) -> Tagger:
    """The model for a corpus, from a bounded sample of pieces of its texts.

    Trained in one task, whose worker Spark holds to one thread: the products are too small for more.
    """

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = [piece for batch in batches for piece in batch["_piece"]]
        yield pd.DataFrame({"model": [pickle.dumps(trained(sorted(own)))]})

    text = F.coalesce(F.col("text"), F.lit(""))
    order = F.xxhash64("doc_id", "text")
    start = F.pmod(F.xxhash64("text"), F.greatest(F.length(text) - PIECE_CHARS, F.lit(1))).cast("int") + 1
    pieces = docs.select(order.alias("_order"), F.substring(text, start, F.lit(PIECE_CHARS)).alias("_piece"))
    sample = pieces.orderBy("_order", "_piece").limit(SAMPLE_PIECES).coalesce(1)
    models = sample.mapInPandas(train, "model binary").collect()
    return pickle.loads(models[0]["model"]) if models else trained([])


def tagged(texts: Sequence[str], model: Tagger) -> list[np.ndarray | None]:
    """The reconciled tags of each whole text, None where all are 0."""
    read = [symbols(t) for t in texts]
    step = WINDOW - OVERLAP
    places = [(k, start) for k, s in enumerate(read) for start in range(0, max(len(s) - OVERLAP, 1), step) if len(s)]
    tags: list[np.ndarray | None] = [None] * len(texts)
    for first in range(0, len(places), AT_ONCE):
        part = places[first : first + AT_ONCE]
        x = np.full((len(part), WINDOW), 95, dtype=np.uint8)
        for row, (k, start) in enumerate(part):
            own = read[k][start : start + WINDOW]
            x[row, : len(own)] = own
        emissions = model.emissions(np.ascontiguousarray(x.T))
        loud = np.flatnonzero(~model.quiet(emissions))
        if not len(loud):
            continue
        paths = model.decode(np.ascontiguousarray(emissions[:, :, loud]))
        for row, path in zip(loud, paths.T, strict=True):
            if not path.any():
                continue
            k, start = part[row]
            n = len(read[k])
            if tags[k] is None:
                tags[k] = np.zeros(n, dtype=np.int8)
            # A window's own part ends in the middle of what it shares with the next.
            low = start + OVERLAP // 2 if start else 0
            high = n if start + WINDOW >= n else start + WINDOW - OVERLAP // 2
            tags[k][low:high] = path[low - start : high - start]
    return tags


def spans(texts: Sequence[str], model: Tagger) -> list[list[tuple[str, int, int, bool]]]:
    """(kind, start, end, whether of the base rules) of every whole text."""
    found = []
    for text, tags in zip(texts, tagged(texts, model), strict=True):
        base = base_spans(text)
        own, cover = [(s, k, e, True) for s, k, e in base], _cover(base)
        if tags is not None:
            edges = np.flatnonzero(np.diff(tags, prepend=0, append=0))
            for start, end in zip(edges, edges[1:], strict=False):
                if tags[start]:
                    own += [(*added, False) for added in _added(text, int(start), int(end), int(tags[start]) - 1, cover)]
        found.append([(KINDS[k], s, e, b) for s, k, e, b in sorted(own)])
    return found


#: Starts of the base spans in order, and how far the spans up to each of them reach.
Cover = tuple[list[int], list[int]]


def _cover(base: list[tuple[int, int, int]]) -> Cover:
    ordered = sorted(base)
    return [s for s, _, _ in ordered], list(accumulate((e for _, _, e in ordered), max))


def _added(text: str, start: int, end: int, kind: int, cover: Cover) -> Iterator[tuple[int, int, int]]:
    """All items of a kind in a run of its tag, one behind the other; after a match that fails, from its next character on."""
    rule, at = _ADDED[KINDS[kind]], start
    while match := rule.search(text, at, end):
        first, last = match.span()
        # The longest card may hold the beginning of the next one, which the run does not tell apart.
        ends = [last, *_group_ends(text, first, last)] if KINDS[kind] == "card" else [last]
        last = next((e for e in ends if _holds(text, first, e, kind, cover)), None)
        if last is None:
            at = first + 1
        else:
            yield first, kind, last
            at = last


def _group_ends(text: str, first: int, last: int) -> list[int]:
    """Where a shorter card may end in a match, the last place first: at the end of a group of digits, with 13 digits or more."""
    groups = [m.end() + first for m in re.finditer(r"[0-9]+", text[first:last])]
    return [e for e in reversed(groups[:-1]) if sum(c.isdigit() for c in text[first:e]) >= 13]


def _holds(text: str, start: int, end: int, kind: int, cover: Cover) -> bool:
    numbers = re.findall(r"[0-9]+", text[start:end])
    if kind == 1 and max(map(int, numbers)) > 255 or kind == 2 and not luhn("".join(numbers)):
        return False
    if (start and text[start].isalnum() and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum()):
        return False  # a part of a longer word or number
    before = bisect_left(cover[0], end)
    return not before or cover[1][before - 1] <= start


def found_spans(text: Column, model: Tagger) -> Column:
    """array of kind, start, end and is_base of a text column."""

    @F.pandas_udf("array<struct<kind: string, start: long, end: long, is_base: boolean>>")
    def find(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in series:
            rows = []
            for first in range(0, len(texts), 200):
                rows += spans(texts.iloc[first : first + 200].tolist(), model)
            yield pd.Series([[{"kind": k, "start": s, "end": e, "is_base": b} for k, s, e, b in row] for row in rows], dtype=object)

    return find(F.coalesce(text, F.lit("")))
