"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text is the mean of the embeddings of its letter sequences of two to four letters (word
edges count as letters), hashed into a table. Embeddings and softmax weights are trained by
stochastic gradient descent in numpy on a bounded sample. As the mean is linear,
prediction needs one table of class scores per subword, so whole texts are read at
memory speed. Confidence is calibrated by a temperature on held-back rows; a text is rejected
if it has no letters, or if its confidence or its share of known subwords lies below
what nearly all held-back texts reach.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapledger.llm.frames import crc_mod

#: Labelled rows, over all languages, that training looks at.
MAX_ROWS = 2_000
BUCKETS = 1 << 17
DIM = 16
EPOCHS, LEAST_STEPS = 6, 1_000
UNKNOWN = "und"
#: Share of held-back texts that rejection may lose.
LOST = 0.001
#: Characters worked on at a time.
BLOCK = 1 << 20

_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def subwords(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(start of each text, bucket at each character) for lengths 2, 3 and 4; BUCKETS where there is none."""
    # the edge before a text belongs to it, so an empty text has no subwords
    joined = "".join("\n" + t for t in texts) + "\n\n\n\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "replace"), "<u4")
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    starts = np.cumsum(sizes) - sizes
    letter = _letter_table()[codes]
    codes = np.where(letter, codes, 0).astype(np.uint32)
    n = len(joined) - 4
    for size in (2, 3, 4):
        h = np.full(n, size, np.uint32)
        for i in range(size):
            h = (h + codes[i : i + n]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
        inner = letter[1 : n + 1].copy() if size > 2 else letter[:n] | letter[1 : n + 1]
        for i in range(2, size - 1):
            inner &= letter[i : i + n]
        yield starts, np.where(inner, h & np.uint32(BUCKETS - 1), BUCKETS)


def _blocks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about BLOCK characters: (place of the first, texts)."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > BLOCK:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(t)
    if texts:
        yield first, texts[first:]


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # class scores of each bucket, then a row of zeros
    bias: np.ndarray
    known: np.ndarray  # buckets seen in training
    temperature: float = 1.0
    least_score: float = 0.0
    least_known: float = 0.0

    def totals(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Summed class scores, number of subwords and of known ones, for each text."""
        sums = np.zeros((len(texts), len(self.languages)))
        count, seen = np.zeros(len(texts)), np.zeros(len(texts))
        for first, some in _blocks(texts):
            part = slice(first, first + len(some))
            for starts, bucket in subwords([t.lower() for t in some]):
                for k in range(len(self.languages)):
                    sums[part, k] += np.add.reduceat(self.table[:, k][bucket], starts, dtype=np.float64)
                count[part] += np.add.reduceat(bucket < BUCKETS, starts, dtype=np.int64)
                seen[part] += np.add.reduceat(self.known[bucket], starts, dtype=np.int64)
        return sums, count, seen

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, confidence and acceptance of each text."""
        if not self.languages or not texts:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.array([any(map(str.isalpha, t)) for t in texts], bool)
        sums, count, seen = self.totals(texts)
        logits = sums / np.maximum(count, 1)[:, None] + self.bias
        p = softmax(logits / self.temperature)
        best = p.argmax(1)
        # a letter whose lower case is no letter cannot hide: letters are asked for in the text itself
        lettered = np.array([bool(n) or any(map(str.isalpha, t)) for n, t in zip(count, texts)])
        names = [self.languages[k] if ok else UNKNOWN for k, ok in zip(best, lettered)]
        score = np.where(lettered, p.max(1), 0.0)
        good = lettered & (score >= self.least_score) & (seen >= self.least_known * count) & (count > 0)
        return names, score, good


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _units(text: str, salt: int) -> list[str]:
    """The whole text and a few short runs of its words, so that short texts are learned too."""
    words = text.split()
    r = np.random.default_rng(salt)
    out = [text]
    for size in (1, 3, 8, 20):
        if len(words) > size:
            at = int(r.integers(len(words) - size))
            out.append(" ".join(words[at : at + size]))
    return out


def sample(rows: DataFrame, max_rows: int, seed: int) -> DataFrame:
    """About ``max_rows`` of ``rows`` in all, evenly over their labels (column label)."""
    counts = rows.groupBy("label").count()
    each = max_rows / F.greatest(F.lit(1), F.count("*").over(_everything()))
    share = counts.select("label", (each / F.col("count")).alias("share"))
    return rows.join(F.broadcast(share), "label").filter(F.rand(seed) < F.col("share")).drop("share")


def _everything():
    from pyspark.sql import Window

    # over one row per label
    return Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def fit(docs: DataFrame, lang_column: str = "lang", max_rows: int = MAX_ROWS, seed: int = 17) -> LanguageModel:
    """Trains on a sample of the rows of ``docs`` whose text and language are not null.

    ``max_rows`` bounds the sample over all languages. Subwords are counted by tasks; the driver
    gets their counts and trains. Without rows the model knows no
    language and rejects only texts without letters.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for label, text in zip(b.column("label").to_pylist(), b.column("text").to_pylist()):
                held = len(text) % 5 == 0
                for i, unit in enumerate(_units(text, len(text))):
                    found = np.concatenate([x for _, x in subwords([unit.lower()])])
                    ids, n = np.unique(found[found < BUCKETS], return_counts=True)
                    if len(ids):
                        out.append((label, held, i == 0, ids.astype(np.int32), n.astype(np.int32)))
            label, held, whole, ids, n = zip(*out) if out else ((),) * 5
            lists = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(label, pa.string()), pa.array(held, pa.bool_()), pa.array(whole, pa.bool_()),
                 pa.array(ids, lists), pa.array(n, lists)],
                ["label", "held", "whole", "ids", "n"],
            )

    labelled = docs.select(F.col(lang_column).cast("string").alias("label"), "text").filter(
        "label IS NOT NULL AND text IS NOT NULL"
    )
    rows = (
        sample(labelled, max_rows, seed)
        .mapInArrow(counted, "label string, held boolean, whole boolean, ids array<int>, n array<int>")
        .toArrow()
    )
    languages = sorted(rows["label"].unique().to_pylist())
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS + 1, 0), np.float32), np.zeros(0), np.zeros(BUCKETS + 1, bool))
    y = np.searchsorted(languages, rows["label"].to_pylist())
    ids = _views(rows["ids"])
    weights = [x / np.float32(x.sum()) for x in _views(rows["n"])]
    apart, whole = (np.array(rows[c].to_pylist(), bool) for c in ("held", "whole"))
    train = np.flatnonzero(~apart)
    if not len(train):
        train = np.arange(len(y))
    embed, out, bias = _train(ids, weights, y, train, len(languages), seed)
    known = np.zeros(BUCKETS + 1, bool)
    for i in train:
        known[ids[i]] = True
    table = np.zeros((BUCKETS + 1, len(languages)), np.float32)
    table[:BUCKETS] = embed @ out
    table[~known] = 0
    model = LanguageModel(languages, table, bias, known)
    held = np.flatnonzero(apart)
    if len(held):
        _calibrate(model, ids, weights, y, held, whole)
    return model


def _views(lists: pa.ChunkedArray) -> list[np.ndarray]:
    """The lists of a column as arrays, without a copy."""
    out = []
    for chunk in lists.chunks:
        ends, flat = chunk.offsets.to_numpy(), chunk.values.to_numpy()
        out += [flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
    return out


def _train(ids, weights, y, train, classes, seed):
    r = np.random.default_rng(seed)
    embed = r.uniform(-1, 1, (BUCKETS, DIM)).astype(np.float32) / DIM
    out, bias = np.zeros((DIM, classes), np.float32), np.zeros(classes, np.float32)
    batch, step = 16, 0
    # few rows are seen more often
    epochs = max(EPOCHS, -(-LEAST_STEPS * batch // len(train)))
    steps = epochs * -(-len(train) // batch)
    for _ in range(epochs):
        for some in np.array_split(r.permutation(train), -(-len(train) // batch)):
            rate = 0.5 * (1 - step / steps)
            step += 1
            flat, weight = np.concatenate([ids[i] for i in some]), np.concatenate([weights[i] for i in some])
            row = np.repeat(np.arange(len(some)), [len(ids[i]) for i in some])
            first = np.searchsorted(row, np.arange(len(some)))
            hidden = np.add.reduceat(embed[flat] * weight[:, None], first)
            error = softmax(hidden @ out + bias)
            error[np.arange(len(some)), y[some]] -= 1
            back = error @ out.T
            out -= rate * hidden.T @ error / len(some)
            bias -= 0.1 * rate * error.mean(0)
            # the mean spreads a text's gradient over its subwords: it is scaled up by their number
            own = weight * np.repeat([min(len(ids[i]), 20) for i in some], [len(ids[i]) for i in some])
            np.add.at(embed, flat, (-rate * own[:, None] * back[row]).astype(np.float32))
    return embed, out, bias


def _calibrate(model: LanguageModel, ids, weights, y, held, whole) -> None:
    logits = np.stack([weights[i] @ model.table[ids[i]] for i in held]) + model.bias
    losses = {}
    for t in np.geomspace(0.05, 20, 60):
        p = softmax(logits / t)
        losses[t] = -np.log(np.maximum(p[np.arange(len(held)), y[held]], 1e-12)).mean()
    model.temperature = float(min(losses, key=losses.get))
    p = softmax(logits / model.temperature)
    texts = whole[held] & (p.argmax(1) == y[held])
    if texts.any():
        known = np.array([weights[i] @ model.known[ids[i]] for i in held])
        # below what held-back texts reach, and never above one half: a text is only rejected if another answer
        # is as likely, or if it is made of subwords that training has hardly seen
        model.least_score = float(min(0.5, 0.7 * np.quantile(p.max(1)[texts], LOST)))
        model.least_known = float(min(0.5, 0.5 * np.quantile(known[texts], LOST)))


def identify(docs: DataFrame, model: LanguageModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Language of every whole text: the ``keep`` columns, lang_pred, score, accepted.

    Null texts and texts without letters are ``und`` with score 0 and are rejected. Repeated
    rows and null ids give a row each; an empty table gives an empty one.
    """
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").cast("string").alias("_text_"))

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column("_text_").to_pylist()]
            names, score, good = model.predict(texts)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(good, pa.bool_())],
                [*b.schema.names[:-1], "lang_pred", "score", "accepted"],
            )

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(predicted, f"{kept}, lang_pred string, score double, accepted boolean")


def identify_held_out(docs: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Fits on rows whose crc32 of the id modulo 4 is not 2; predicts every row, with held_out."""
    held = crc_mod(F.col("doc_id"), 4) == 2
    model = fit(docs.filter(~held), max_rows=max_rows)
    found = identify(docs, model)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "accepted")


def keep_accepted(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of ``docs`` whose text the model accepts, with all their columns."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = model.predict([t or "" for t in b.column("text").to_pylist()])[2]
            yield b.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)
