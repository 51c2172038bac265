"""Toxicity by a weighted grammar of finite-state transducers.

A text is read as tokens. The lexicon transducer writes a symbol for each: end of
clause, colon, end of line, target, negation, report, quote, threat, or an insult with
its weight. A colon ends a clause, but what follows it is still reported; a quotation
holds over clauses to its closing mark, and a mark that no other closes in its line
(inches, a stray one) opens none.
Four small transducers read the symbols: whether a target was named in the clause,
whether a negation stands at most ``NEGATION_REACH`` tokens back, whether the
clause is reported or quoted speech, and which matches count. Their composition is
one table, and each clause gets the weight of its matches under it: an insult
counts more with a target, less when negated or reported; a threat word counts
only in a clause with a target. The target may stand before or after the match,
so it is settled at the end of the clause. A text is scored by its strongest clause
and the sum over clauses, calibrated on labelled rows.

Insults are learned: words, and beginnings of words, whose contexts (the pair of
neighbours, so that copies of a text count once) lie in toxic texts more often
than chance explains among so many entries; the weight is the log-odds less one
standard error. At most ``SAMPLE_ROWS`` labelled rows of each label are read, and
at most ``LEXICON`` entries kept, the heaviest. The calibration sees each half of
the rows under a lexicon of the other half. Scoring is one pass over whole texts
without a shuffle.

Null and empty texts score as texts without a match. With one label or none to
learn from, every text scores that label's share (0.5 for none).
"""

from __future__ import annotations

import math
import re
import zlib
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm import tokens
from tideline.llm.samples import Logistic, labelled_rows
from tideline.session import materialise

SAMPLE_ROWS, LEXICON = 4000, 20_000
PREFIX_LENGTHS = range(4, 9)
LEAST_WEIGHT = 1.0
NEGATION_REACH = 3
NEGATED, REPORTED, TARGETED, THREAT_WEIGHT = 0.4, 0.5, 1.25, 2.0

# Symbols of the lexicon transducer; insults are FIRST_INSULT + their place.
OTHER, END, COLON, LINE, TARGET, NEGATION, REPORT, QUOTE, THREAT, FIRST_INSULT = range(10)

_TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)*|[.!?;:\n\"“”„«»]")
#: The closed classes of words, with the inflected forms of threats.
_CLOSED = {
    END: ". ! ? ;",
    COLON: ":",
    QUOTE: '" “ ” „ « »',
    TARGET: "you your yours he she him her they them du dich dir ihr ihn sie euch tu toi te vous ton ta "
    "ils elles lui eux tú ti usted ustedes vosotros ellos ellas él ella",
    NEGATION: "not no never nor isn't aren't wasn't weren't don't doesn't didn't won't can't cannot wouldn't "
    "shouldn't couldn't nicht kein keine keinen nie niemals ne pas jamais aucun nunca jamás ningún ninguna",
    REPORT: "said says wrote reported claimed quoted sagte sagt schrieb behauptete berichtete dit écrit "
    "affirme déclaré dijo dice escribió afirmó",
    THREAT: "kill kills killed killing hurt hurts hurting destroy destroys destroyed destroying beat beats "
    "beaten beating shoot shoots shot shooting stab stabs stabbed stabbing burn burns burned burnt burning "
    "töten töte tötest tötet tötete umbringen verletzen verletze verletzt erschießen erschieße erschießt "
    "tuer tue tues tuent tuerai tuera frapper frappe frappes frapperai brûler brûle brûlerai détruire détruis "
    "détruirai matar mato mata matas mataré matará golpear golpeo golpeas golpearé quemar quemo quemaré "
    "disparar disparo dispararé",
}


def tokens_of(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower().replace("’", "'"))


def _closed_words() -> dict[str, int]:
    words = {w: s for s, text in _CLOSED.items() for w in text.split(" ")}
    words["\n"] = LINE
    return words


# Each transducer: state, symbol -> state. Insult stands for all insults.
_CLAUSE_ENDS = (END, COLON, LINE)


def _target(state: int, symbol: int) -> int:
    return 0 if symbol in _CLAUSE_ENDS else max(state, int(symbol == TARGET))


def _negation(state: int, symbol: int) -> int:
    if symbol in _CLAUSE_ENDS:
        return 0
    return NEGATION_REACH if symbol == NEGATION else max(state - 1, 0)


def _report(state: int, symbol: int) -> int:
    """Bit 1: a verb of saying, up to the end of the clause after its colon; bit 2: inside quotation marks."""
    if symbol == LINE:
        return 0
    if symbol == END:
        return state & 2
    if symbol == REPORT:
        return state | 1
    return state ^ 2 if symbol == QUOTE else state


def without_strays(read: list[int]) -> list[int]:
    """The symbols, where the last quotation mark of a line with an odd number of them is none."""
    opened = None
    for i, symbol in enumerate((*read, LINE)):
        if symbol == QUOTE:
            opened = i if opened is None else None
        elif symbol == LINE and opened is not None:
            read[opened], opened = OTHER, None
    return read


def _factor(negation: int, report: int) -> float:
    return (NEGATED if negation else 1.0) * (REPORTED if report else 1.0)


def compose() -> tuple[list[list[int]], list[float], list[tuple[float, float]]]:
    """Next state by state and symbol, the factor of a match by the state in which it is read,
    and the factors of a clause's insults and of its threats by the state at its end."""
    states = list(product(range(2), range(NEGATION_REACH + 1), range(4)))
    place = {s: i for i, s in enumerate(states)}
    following = [
        [place[_target(t, x), _negation(n, x), _report(r, x)] for x in range(FIRST_INSULT + 1)]
        for t, n, r in states
    ]
    return (
        following,
        [_factor(n, r) for _, n, r in states],
        [(TARGETED, TARGETED) if t else (1.0, 0.0) for t, _, _ in states],
    )


class _Symbols(dict):
    """Token to symbol, remembered; the longest lexicon entry that fits a word wins."""

    LIMIT = 300_000

    def __init__(self, words: dict[str, int], prefixes: dict[str, int]):
        super().__init__(words)
        self.words, self.prefixes = words, prefixes
        self.lengths = sorted({len(p) for p in prefixes}, reverse=True)

    def __missing__(self, token: str) -> int:
        if len(self) > self.LIMIT:
            self.clear()
            self.update(self.words)
        n = len(token)
        fits = (self.prefixes.get(token[:k]) for k in self.lengths if k <= n)
        symbol = self[token] = next((s for s in fits if s is not None), OTHER)
        return symbol


class ToxicityModel:
    """Lexicon entries (ending in * for beginnings of words) with weights, and a calibration."""

    def __init__(self, entries: dict[str, float], calibration: Logistic | None = None):
        self.entries, self.calibration = entries, calibration
        self._ready = None

    def __getstate__(self):
        return self.entries, self.calibration

    def __setstate__(self, state):
        self.entries, self.calibration = state
        self._ready = None

    def _machine(self):
        if self._ready is None:
            words, prefixes, weights = {}, {}, []
            for i, (entry, weight) in enumerate(self.entries.items()):
                kind, key = (prefixes, entry[:-1]) if entry.endswith("*") else (words, entry)
                kind[key] = FIRST_INSULT + i
                weights.append(weight)
            self._ready = _Symbols({**words, **_closed_words()}, prefixes), weights, *compose()
        return self._ready

    def clauses(self, text: str | None) -> tuple[list[tuple[int, float]], int]:
        """(clause number, weight) of the clauses with a match, and the number of tokens."""
        symbols, weights, following, match, end = self._machine()
        read = list(map(symbols.__getitem__, tokens_of(text)))
        if not read or max(read) < THREAT:
            return [], len(read)
        read = without_strays(read)
        found, state, number, insults, threats = [], 0, 0, 0.0, 0.0
        for symbol in (*read, END):
            if symbol >= FIRST_INSULT:
                insults += weights[symbol - FIRST_INSULT] * match[state]
                symbol = FIRST_INSULT
            elif symbol == THREAT:
                threats += THREAT_WEIGHT * match[state]
            elif symbol in _CLAUSE_ENDS:
                insult, threat = end[state]
                weight = insults * insult + threats * threat
                if weight:
                    found.append((number, weight))
                number, insults, threats = number + 1, 0.0, 0.0
            state = following[state][symbol]
        return found, len(read)

    def features(self, text: str | None) -> tuple[float, float, float]:
        """Strongest clause, log of the sum over clauses, and log of that sum for each token."""
        found, n = self.clauses(text)
        total = math.fsum(w for _, w in found)
        return max((w for _, w in found), default=0.0), math.log1p(total), math.log1p(1000 * total / max(n, 20))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return self.calibration.predict(np.array([self.features(t) for t in texts]).reshape(-1, 3))


def _contexts(batches):
    """(half, word, context, y) of labelled rows, with few repeats."""
    names, types = ("half", "word", "context", "y"), (pa.int32(), pa.string(), pa.int64(), pa.int32())

    def flush(rows):
        columns = zip(*sorted(rows), strict=True) if rows else ((),) * 4
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        rows.clear()
        return pa.RecordBatch.from_arrays(arrays, names=names)

    out = set()
    for batch in tokens.small(batches):
        columns = (batch[c].to_pylist() for c in ("half", "text", "y"))
        for half, text, y in zip(*columns, strict=True):
            read = ["\n", *tokens_of(text), "\n"]
            for before, word, after in zip(read, read[1:], read[2:]):
                if len(word) > 1:
                    out.add((half, word, zlib.crc32(f"{before} {after}".encode()), y))
            if len(out) > 50_000:
                yield flush(out)
    yield flush(out)


def _count(rows: DataFrame) -> DataFrame:
    """Contexts in toxic and other texts of each word and beginning of a word, by half."""
    seen = rows.select("half", "text", "y").mapInArrow(
        _contexts, "half int, word string, context bigint, y int"
    )
    counts = materialise(
        seen.distinct().groupBy("half", "word").agg(F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("other"))
    )
    prefixes = (
        counts.withColumn("n", F.explode(F.array(*(F.lit(n) for n in PREFIX_LENGTHS))))
        .where(F.col("n") < F.length("word"))
        .groupBy("half", F.concat(F.expr("left(word, n)"), F.lit("*")).alias("word"))
        .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    )
    return materialise(counts.unionByName(prefixes))


def _lexicon(counts: DataFrame, entries: int) -> dict[str, float]:
    """Entries whose toxic contexts are no chance among so many entries, with their weights."""
    counts = counts.groupBy("word").agg(F.sum("toxic").alias("a"), F.sum("other").alias("b"))
    whole = F.col("word").endswith("*")
    toxic, other, n = (
        counts.agg(
            F.sum(F.when(~whole, F.col("a"))), F.sum(F.when(~whole, F.col("b"))), F.count("*")
        ).first()
    )
    if not toxic or not other:
        return {}
    share = toxic / (toxic + other)
    a, b = F.col("a"), F.col("b")
    excess = a * F.log(a / ((a + b) * share)) + F.when(b > 0, b * F.log(b / ((a + b) * (1 - share)))).otherwise(0.0)
    weight = F.log((a + 0.5) / toxic) - F.log((b + 0.5) / other) - F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
    kept = (
        counts.where(a > (a + b) * share)
        .where(excess >= math.log(n) + 1)
        .where(~F.col("word").isin(list(_closed_words())))
        .select("word", weight.alias("weight"))
        .where(F.col("weight") >= LEAST_WEIGHT)
    )
    return {r.word: r.weight for r in kept.orderBy(F.desc("weight"), "word").limit(entries).collect()}


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    label: str = "toxic",
    doc_id: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    entries: int = LEXICON,
) -> ToxicityModel:
    """Lexicon from all sampled rows; each half calibrates under the lexicon of the other."""
    rows = labelled_rows(docs, labels, label, sample_rows, doc_id=doc_id, text=text)
    # by text, so that copies do not reach both halves
    half = F.pmod(F.xxhash64(F.lit("half"), "text"), F.lit(2)).cast("int")
    rows = materialise(rows.select("text", "y", half.alias("half")))
    counts = _count(rows)
    halves = [ToxicityModel(_lexicon(counts.where(F.col("half") != h), entries)) for h in (0, 1)]

    def measure(batches):
        for batch in tokens.small(batches):
            pairs = zip(batch["text"].to_pylist(), batch["half"].to_pylist(), strict=True)
            found = np.array([halves[h].features(t) for t, h in pairs]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(found[:, i]) for i in range(3)), batch["y"]], names=["a", "b", "c", "y"]
            )

    seen = sorted(rows.mapInArrow(measure, "a double, b double, c double, y int").collect())
    x = np.array([(r.a, r.b, r.c) for r in seen]).reshape(-1, 3)
    return ToxicityModel(_lexicon(counts, entries), Logistic(x, np.array([r.y for r in seen], float)))


def score(docs: DataFrame, model: ToxicityModel, *, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability of toxicity in column ``name`` (in place of one so named)."""
    docs = docs.drop(name)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])

    def run(batches):
        for batch in tokens.small(batches):
            yield batch.append_column(name, pa.array(model.scores(batch[text].to_pylist())))

    return docs.mapInArrow(run, schema)
