"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols: insults from a weighted lexicon of words and stems that is learnt from labels, threats, targets,
negations and reporting words from short fixed lists. Transducers are composed over the symbols of a clause:
negation turns an insult or threat in its scope into a denied one, reported speech turns what follows into a reported
one, and the collectors of insult, threat and target read what is left. The composed table is run once a clause, and
its outcome at the clause's end, weighed by the strongest lexicon arc, adds to one of a few sums of the text. A
logistic regression over these sums gives the score.

The lexicon and the regression are fitted on at most ``FIT_ROWS`` labelled rows of each class, those with the
smallest hashes of doc_id among rows the caller allows; everything else reads whole tables.

Defined results: a null or empty text scores the bias alone; a doc_id without label, or with a null one, is not
fitted on, one with several labels counts as toxic if any is; without rows of a class the fixed lists alone decide;
repeated rows score alike; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinlake.session import stored

FIT_ROWS = 2000
LEXICON_ENTRIES = 2000
STEM_LENGTHS = (4, 5, 6)
#: An entry is learnt when this share of the toxic rows (and so many) hold it, and by these log odds more often than clean ones.
LEAST_SHARE, LEAST_COUNT, LEAST_LOG_ODDS = 0.02, 4, 3.5
NEGATION_SCOPE = 3
_REMEMBERED = 200_000

# Words of each kind in English, German, French and Spanish.
THREATS = "kill murder stab shoot strangle umbringen töten erschießen tuer assassiner poignarder matar asesinar apuñalar"
TARGETS = "you your you're u yours he she they them her him du dich dir dein ihr euch sie tu te toi ton vous votre tú ti usted ustedes vosotros"
NEGATIONS = "not no never isn't aren't don't without nicht kein keine nie niemals ohne pas jamais sans aucun nunca ningún sin"
REPORTS = "said says wrote called claimed quoted sagte schrieb nannte behauptete disait écrivait appelait dijo escribió llamó"

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END = "other", "insult", "threat", "target", "negation", "report", "end"
SYMBOLS = (OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END)
#: What a clause can come to: threat or insult, said of a target or of nobody, or only denied, or only reported.
OUTCOMES = ("threat at target", "threat", "insult at target", "insult", "denied", "reported")
#: Where the regression is pulled to: the bias, then a weight for each outcome.
PRIOR = np.array([-3.0, 3.0, 1.5, 2.5, 2.5, 0.0, 0.5])
PULL = 0.05

_TOKEN = re.compile(r"\w+(?:'\w+)?|[.!?;:\n]+")


@dataclass
class Transducer:
    """``step(state, symbol)`` gives the next state and the symbol passed on."""

    start: object
    step: Callable[[object, str], tuple[object, str]]


def negation() -> Transducer:
    def step(left: int, symbol: str) -> tuple[int, str]:
        if symbol == NEGATION:
            return NEGATION_SCOPE, OTHER
        if symbol == END:
            return 0, END
        return max(left - 1, 0), f"denied {symbol}" if left and symbol in (INSULT, THREAT) else symbol

    return Transducer(0, step)


def reported_speech() -> Transducer:
    def step(reporting: bool, symbol: str) -> tuple[bool, str]:
        if symbol == REPORT:
            return True, OTHER
        if symbol == END:
            return False, END
        return reporting, f"reported {symbol}" if reporting and symbol in (INSULT, THREAT) else symbol

    return Transducer(False, step)


def collector(read: str, mark: str) -> Transducer:
    """Remembers that a symbol was read and marks the clause's end with it."""

    def step(seen: bool, symbol: str) -> tuple[bool, str]:
        if symbol.startswith(END):
            return False, f"{symbol} {mark}" if seen else symbol
        return seen or symbol == read, symbol

    return Transducer(False, step)


def composed(first: Transducer, second: Transducer) -> Transducer:
    def step(state: tuple, symbol: str) -> tuple[tuple, str]:
        a, between = first.step(state[0], symbol)
        b, out = second.step(state[1], between)
        return (a, b), out

    return Transducer((first.start, second.start), step)


def _outcome(end: str) -> int:
    """The place in OUTCOMES of a clause's marked end, -1 for none."""
    marks = set(end.split())
    for kind in (THREAT, INSULT):
        if kind in marks:
            return OUTCOMES.index(f"{kind} at target" if TARGET in marks else kind)
    return OUTCOMES.index("reported") if "reported" in marks else OUTCOMES.index("denied") if "denied" in marks else -1


@lru_cache(maxsize=1)
def grammar() -> tuple[list[list[int]], list[list[int]]]:
    """Tables of the composed grammar: next state by state and symbol, and outcome of ending a clause."""
    machine = composed(negation(), reported_speech())
    for read, mark in (
        (INSULT, INSULT),
        (THREAT, THREAT),
        (TARGET, TARGET),
        (f"denied {INSULT}", "denied"),
        (f"denied {THREAT}", "denied"),
        (f"reported {INSULT}", "reported"),
        (f"reported {THREAT}", "reported"),
    ):
        machine = composed(machine, collector(read, mark))
    number, todo, rows, outcomes = {machine.start: 0}, [machine.start], [], []
    for state in todo:
        row = []
        for symbol in SYMBOLS:
            reached, out = machine.step(state, symbol)
            if reached not in number:
                number[reached] = len(todo)
                todo.append(reached)
            row.append(number[reached])
        rows.append(row)
        outcomes.append(_outcome(out))
    return rows, outcomes


class Symbols(dict):
    """Word -> (symbol number, weight); a word is looked up whole, then by its stems, and remembered."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon
        self.fixed = {
            word: SYMBOLS.index(symbol)
            for symbol, words in ((REPORT, REPORTS), (NEGATION, NEGATIONS), (TARGET, TARGETS), (THREAT, THREATS))
            for word in words.split()
        }

    def __missing__(self, token: str) -> tuple[int, float]:
        if not (token[0].isalnum() or token[0] == "_"):
            found = (SYMBOLS.index(END), 0.0)
        else:
            weight = max((self.lexicon.get(f, 0.0) for f in features(token)), default=0.0)
            found = (SYMBOLS.index(INSULT), weight) if weight else (self.fixed.get(token, 0), 1.0)
        if len(self) >= _REMEMBERED:
            self.clear()
        self[token] = found
        return found


def features(word: str) -> list[str]:
    """What of a word the lexicon may hold: the word, and its stems with a star."""
    return [word, *(f"{word[:n]}*" for n in STEM_LENGTHS if len(word) > n)]


@dataclass
class ToxicityModel:
    lexicon: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=PRIOR.copy)

    def __post_init__(self):
        self._symbols = Symbols(self.lexicon)

    def __reduce__(self):
        return ToxicityModel, (self.lexicon, self.weights)

    def sums(self, text: str) -> list[float]:
        """The weights of a text's clauses, summed by outcome and damped."""
        found = [0.0] * len(OUTCOMES)
        read = [self._symbols[token] for token in _TOKEN.findall(text.lower())]
        scored = {SYMBOLS.index(INSULT), SYMBOLS.index(THREAT)}
        if scored.isdisjoint({symbol for symbol, _ in read}):
            return found
        rows, outcomes = grammar()
        end, state, strongest = SYMBOLS.index(END), 0, 0.0
        for symbol, weight in [*read, (end, 0.0)]:
            if symbol == end:
                if strongest and outcomes[state] >= 0:
                    found[outcomes[state]] += strongest
                strongest = 0.0
            elif symbol in scored:
                strongest = max(strongest, weight)
            state = rows[state][symbol]
        return [math.log1p(f) for f in found]

    def score(self, text: str) -> float:
        z = float(self.weights[0] + np.dot(self.weights[1:], self.sums(text)))
        return 1 / (1 + math.exp(-max(min(z, 30.0), -30.0)))


def fit(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """The model of the rows of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) marks."""
    by_id = labels.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic is not null")
    chosen = [by_id.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS) for c in (0, 1)]
    picked = F.broadcast(chosen[0].unionByName(chosen[1]))  # FIT_ROWS rows of two integers for each class
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(picked, "doc_id").dropDuplicates(["doc_id"])
    rows = stored(texts, "toxicity-fit")
    n = dict.fromkeys((0, 1), 0) | {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}

    def held(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pairs = [
                (f, toxic)
                for text, toxic in zip(batch["text"], batch["toxic"], strict=True)
                for f in {f for token in set(_TOKEN.findall(text.lower())) if token[0].isalnum() for f in features(token)}
            ]
            yield pd.DataFrame(pairs, columns=["feature", "toxic"])

    counts = rows.mapInPandas(held, "feature string, toxic int").groupBy("feature").agg(
        F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")
    )
    odds = F.log((F.col("t") + 0.5) / (n[1] + 1)) - F.log((F.col("c") + 0.5) / (n[0] + 1))
    entries = counts.select("feature", "t", odds.alias("w")).filter(
        (F.col("t") >= max(LEAST_COUNT, LEAST_SHARE * n[1])) & (F.col("w") >= LEAST_LOG_ODDS)
    )
    lexicon = {r["feature"]: r["w"] for r in entries.orderBy(F.desc("w"), "feature").limit(LEXICON_ENTRIES).collect()}
    model = ToxicityModel(lexicon)

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"toxic": batch["toxic"], "sums": [model.sums(t) for t in batch["text"]]})

    sums = rows.mapInPandas(summed, "toxic int, sums array<double>").orderBy("toxic", "sums").collect()  # at most 2 * FIT_ROWS
    x = np.array([[1.0, *r["sums"]] for r in sums]).reshape(-1, len(PRIOR))
    y = np.array([float(r["toxic"]) for r in sums])
    model.weights = regression(x, y)
    return model


def regression(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, each class weighing the same, pulled to PRIOR."""
    w = PRIOR.copy()
    if not len(y) or y.min() == y.max():
        return w
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (share * (p - y)) + PULL / 10 * (w - PRIOR)
        hessian = (x * (share * p * (1 - p) + 1e-9)[:, None]).T @ x + PULL / 10 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w - step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    return w


def scored(text: Column, model: ToxicityModel) -> Column:
    """The score of a text column, from 0 to 1."""

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            yield pd.Series([model.score(t) for t in series], dtype="float64")

    return score(F.coalesce(text, F.lit("")))
