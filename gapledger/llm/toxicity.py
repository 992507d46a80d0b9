"""Toxicity by a weighted finite-state pattern grammar.

Every word becomes a symbol: insult (of three strengths), threat, target, negation, reported
speech or other; a symbol also tells whether the word ends a clause. One small transducer each
follows insults, threats, targets, negation and reported speech; their product reads a
clause once and ends in a state that names the kind of clause and its weight. A text is scored by
its matched clauses, not by single words: negated or reported clauses have weights of their own.

The insult lexicon (words, and stems that many words share) and the weights are learned from
labelled rows. A word's evidence is the number of different neighbourhoods it
occurs in, so a group of copies counts once, however large it is.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapledger.llm.frames import WordMemory, crc_mod, hash64
from gapledger.llm.langid import sample
from gapledger.sources.shared import write_once

#: Labelled rows, over both labels, that the lexicon and the weights are learned from.
MAX_ROWS = 12_000
#: Toxic rows in the sample below which terms and weights share all rows.
FEW = 400
#: Entries of the learned lexicon, strongest first.
MAX_TERMS = 5_000
STEMS = (4, 5, 6)
THRESHOLD = 0.3
#: Evidence (log likelihood ratio) that a term needs, and that makes it middling or strong.
EVIDENCE = (18.0, 40.0, 80.0)
#: How much more often than in clean rows it has to occur.
TIMES = 8

# Closed classes of words in the languages at hand.
THREATS = "kill hurt destroy beat burn shoot stab töten schlagen vernichten tuer frapper détruire matar golpear destruir".split()
TARGETS = (
    "you your you're youre he she they him her them his their du dich dir dein ihr euch sie er "
    "tu te toi ton vous votre il elle ils tú ti usted ustedes él ella ellos"
).split()
NEGATIONS = "not no never none isn't aren't don't nicht kein keine nie ne pas jamais ningún nunca jamás".split()
REPORTS = (
    "said says say wrote writes claimed claims reported quoted according sagte sagt schrieb laut "
    "dit disait écrit selon dijo dice escribió según"
).split()
#: Symbols; a capital letter is a word that ends its clause.
INSULTS, THREAT, TARGET, NEGATION, REPORT, OTHER = "ijk", "t", "y", "n", "r", "o"
_ENDS = re.compile(r"[.!?;:,)\]\"”»]$")
_EDGES = re.compile(r"^\W+|\W+$")


class Transducer:
    """States 0, 1, …; on a symbol listed in ``moves[state]`` it moves, else it stays."""

    def __init__(self, moves: list[dict[str, int]]):
        self.moves = moves

    def step(self, state: int, symbol: str) -> int:
        return self.moves[state].get(symbol, state)


#: Strongest insult so far: 0 none, 1 weak, 2 middling, 3 strong.
insult = Transducer([{s: max(k, n) for n, s in enumerate("kji", 1)} for k in range(4)])
threat = Transducer([{THREAT: 1}, {}])
target = Transducer([{TARGET: 1}, {}])
#: Negation counts if it stands before the first insult or threat.
negation = Transducer([{NEGATION: 1} | dict.fromkeys("ijkt", 2), {}, {}])
#: Reported speech anywhere in the clause.
report = Transducer([{REPORT: 1}, {}])


def compose(*parts: Transducer) -> tuple[list[tuple[int, ...]], list[dict[str, int]]]:
    """The product machine: its states as tuples, and its moves for every symbol."""
    states = list(product(*[range(len(p.moves)) for p in parts]))
    place = {s: i for i, s in enumerate(states)}
    symbols = INSULTS + THREAT + TARGET + NEGATION + REPORT + OTHER
    moves = [{a: place[tuple(p.step(x, a) for p, x in zip(parts, s))] for a in symbols} for s in states]
    return states, moves


STATES, MOVES = compose(insult, threat, target, negation, report)
#: Features of a text: clauses by kind, and a constant.
FEATURES = ("strong", "middling", "weak", "directed", "threat", "negated", "reported", "constant")
PRIOR = np.array([4.0, 2.5, 1.0, 1.0, 3.0, -1.0, -0.5, -3.0])


def clause_kind(state: int) -> np.ndarray:
    """What a clause that ends in ``state`` adds to a text's features."""
    level, threatened, aimed, negated, reported = STATES[state]
    f = np.zeros(len(FEATURES))
    if level:
        f[3 - level] = 1
        f[3] = aimed
    f[4] = threatened and aimed
    if f.any():
        f[5], f[6] = negated == 1, reported
    return f


KINDS = np.stack([clause_kind(s) for s in range(len(STATES))])
_CLAUSES = re.compile(rb"[a-z]*[A-Z]|[a-z]+")
_HIT = re.compile(rb"[ijktIJKT]")


@dataclass
class ToxicityModel:
    terms: dict[str, str] = field(default_factory=dict)  # word, or stem with * behind it -> symbol
    weights: np.ndarray = field(default_factory=lambda: PRIOR.copy())

    def symbol(self, word: bytes) -> int:
        """Symbol of one word, as a byte."""
        raw = word.decode("utf-8", "replace")
        low = _EDGES.sub("", raw).lower()
        found = self.terms.get(low)
        if found is None:
            stems = [self.terms.get(low[:n] + "*") for n in STEMS if len(low) > n]
            found = min((s for s in stems if s), default=None)
        if found is None:
            found = next(
                (s for s, words in ((THREAT, _THREATS), (TARGET, _TARGETS), (NEGATION, _NEGATIONS), (REPORT, _REPORTS)) if low in words),
                OTHER,
            )
        return ord(found.upper() if _ENDS.search(raw) else found)

    def memory(self) -> WordMemory:
        return WordMemory(self.symbol)

    def features(self, text: str, memory: WordMemory) -> np.ndarray:
        f = np.zeros(len(FEATURES))
        symbols = bytes(map(memory.__getitem__, text.encode("utf-8", "replace").split()))
        if _HIT.search(symbols):
            for clause in _CLAUSES.findall(symbols):
                if _HIT.search(clause):
                    state = 0
                    for a in clause.decode().lower():
                        state = MOVES[state][a]
                    f += KINDS[state]
        f = np.log2(1 + f)
        f[-1] = 1
        return f

    def scores(self, texts: list[str], memory: WordMemory) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        return sigmoid(np.stack([self.features(t, memory) for t in texts]) @ self.weights)


_THREATS, _TARGETS, _NEGATIONS, _REPORTS = map(frozenset, (THREATS, TARGETS, NEGATIONS, REPORTS))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def learn_terms(rows: DataFrame, max_terms: int = MAX_TERMS) -> dict[str, str]:
    """Words and stems that mark label 1 in ``rows`` (label, text), with their symbols.

    A term's neighbourhoods (the words beside it) are counted in 64 slots per label; slots are merged by
    OR, so a task sends one row per term.
    """

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[int]] = {}
        for b in batches:
            for label, text in zip(b.column("label").to_pylist(), b.column("text").to_pylist()):
                words = [_EDGES.sub("", w).lower() for w in text.split()]
                for before, word, after in zip(["", *words], words, [*words[1:], ""]):
                    if not word:
                        continue
                    place = hash64(f"{before} {word} {after}".encode()) & 63
                    seen.setdefault(word, [0, 0])[label] |= 1 << place
                    # a stem needs several words: one word, however common, fills 8 of its slots at most
                    bit = 1 << ((place & 7) | (hash64(word.encode()) & 7) << 3)
                    for n in STEMS:
                        if len(word) > n:
                            seen.setdefault(word[:n] + "*", [0, 0])[label] |= bit
        terms = pa.array(list(seen), pa.string())
        bits = np.array(list(seen.values()), np.uint64).reshape(-1, 2).view(np.int64)
        yield pa.RecordBatch.from_arrays([terms, pa.array(bits[:, 0]), pa.array(bits[:, 1])], ["term", "clean", "toxic"])

    found = (
        rows.select("label", "text").mapInArrow(slots, "term string, clean long, toxic long")
        .groupBy("term")
        .agg(F.bit_count(F.bit_or("clean")).alias("clean"), F.bit_count(F.bit_or("toxic")).alias("toxic"))
    )
    sizes = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    ratio = max(sizes.get(1, 0), 1) / max(sizes.get(0, 0), 1)
    # slots taken -> neighbourhoods (linear counting); expected: as often as in clean rows
    many = [64 * math.log(64 / (64 - min(n, 63.5))) for n in range(65)]
    table = F.array(*map(F.lit, many))
    toxic, clean = (F.element_at(table, F.col(c) + 1) for c in ("toxic", "clean"))
    found = found.filter("toxic >= 4 AND toxic > clean").select("term", toxic.alias("x"), ((clean + 1) * ratio).alias("e"))
    found = found.select("term", (F.col("x") * F.log(F.col("x") / F.col("e")) - F.col("x") + F.col("e")).alias("llr"), "x", "e")
    kept = found.filter((F.col("llr") >= EVIDENCE[0]) & (F.col("x") >= TIMES * F.col("e")))
    best = kept.orderBy(F.desc("llr"), "term").limit(max_terms).collect()
    return {r.term: INSULTS[2 - sum(r.llr >= e for e in EVIDENCE[1:])] for r in best}


def fit_weights(x: np.ndarray, y: np.ndarray, rate: np.ndarray, pull: float = 0.02) -> np.ndarray:
    """Logistic regression by Newton's method, drawn towards PRIOR; rows weigh ``rate``."""
    w, n = PRIOR.copy(), rate.sum()
    for _ in range(50):
        p = sigmoid(x @ w)
        gradient = x.T @ (rate * (p - y)) / n + pull * (w - PRIOR) / 10
        curve = (x * (rate * p * (1 - p))[:, None]).T @ x / n + pull / 10 * np.eye(len(w))
        move = np.linalg.solve(curve, gradient)
        w -= np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-6:
            break
    w[:5] = np.maximum(w[:5], 0)  # more matched clauses never make a text less toxic
    return w


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, seed: int = 23) -> ToxicityModel:
    """Learns from the rows of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) marks 0 or 1.

    ``max_rows`` bounds the sample over both labels; half of it finds the terms, the other
    half the weights. Without labelled rows only the built-in classes and weights are used.
    """
    marks = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("toxic IN (0, 1)").distinct()
    # ids alone are joined and drawn; only then are the texts of the drawn ids, a bounded number, fetched
    ids = docs.select("doc_id").distinct().join(marks, "doc_id").select("doc_id", F.col("toxic").alias("label"))
    ids = write_once("labelled_ids", ids)
    counts = {r.label: r.n for r in ids.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return ToxicityModel()
    drawn = write_once("drawn_ids", sample(ids, max_rows, seed))
    texts = docs.select("doc_id", "text").filter("text IS NOT NULL").join(F.broadcast(drawn), "doc_id")
    chosen = write_once("labelled", texts.select("label", "text", F.pmod(F.hash("text"), F.lit(2)).alias("part")))
    few = chosen.filter("label = 1").count() < FEW
    model = ToxicityModel(learn_terms(chosen.filter(F.lit(few) | (F.col("part") == 0)).drop("part")))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = model.memory()
        for b in batches:
            f = [model.features(t, memory).tolist() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("label"), pa.array(f, pa.list_(pa.float64()))], ["label", "f"])

    tried = chosen.filter(F.lit(few) | (F.col("part") == 1)).select("label", "text").mapInArrow(measured, "label int, f array<double>").toArrow()
    y = tried["label"].to_numpy().astype(float)
    if len(np.unique(y)) == 2:
        share = {k: counts[k] / max(1, (y == k).sum()) for k in (0, 1)}
        model.weights = fit_weights(np.array(tried["f"].to_pylist()), y, np.where(y == 1, share[1], share[0]))
    return model


def score(docs: DataFrame, model: ToxicityModel, keep: tuple[str, ...] = ("doc_id",), threshold: float = THRESHOLD) -> DataFrame:
    """Score of every whole text: the ``keep`` columns, score (0 to 1), predicted (1 from ``threshold``).

    Null and empty texts get the score of a text without matched clauses. Null ids and
    repeated rows give a row each; an empty table gives an empty one.
    """
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").cast("string").alias("_text_"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = model.memory()
        for b in batches:
            s = model.scores([t or "" for t in b.column("_text_").to_pylist()], memory)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))],
                [*b.schema.names[:-1], "score", "predicted"],
            )

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(scored, f"{kept}, score double, predicted int")


def score_held_out(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Fits on rows whose crc32 of the id modulo 4 is not 2; scores every row, with held_out."""
    held: Column = crc_mod(F.col("doc_id"), 4) == 2
    model = fit(docs.filter(~held), labels, max_rows)
    return score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


def keep_clean(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score lies below ``threshold``, with all their columns."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = model.memory()
        for b in batches:
            s = model.scores([t or "" for t in b.column("text").to_pylist()], memory)
            yield b.filter(pa.array(s < threshold, pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)
