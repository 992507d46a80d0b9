"""Language-model scores: a log-bilinear model trained with noise-contrastive estimation.

Token counts of the whole training part give a smoothed unigram base. The neural model predicts a token's
class from the two tokens before it: a class is one of the commonest tokens, the end, or a group of
other tokens (by their last bytes), inside which a token has its share of the group's smoothed counts; so
the model is normalised over all tokens, seen or not. The score of class w after classes a, b is
(C1 r_a + C2 r_b) . q_w + bias_w. Every task trains on all training tokens of its partition with noise shared by
a batch, from one start, and the weights are averaged. As the score is a sum of a term of a and w and one of b
and w, one matrix product of their exponentials gives the normaliser of every context.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from gapledger.llm.frames import WordMemory, crc_mod, text_blocks
from gapledger.sources.shared import write_once

#: Commonest tokens with a class of their own, groups of the others, and dimensions.
COMMON, GROUPS, DIM = 1023, 256, 32
#: Tokens in a training batch, noise draws it shares, and the step.
BATCH, NOISE, RATE = 2048, 64, 0.15
#: Smoothing of counts, as in the base.
ALPHA = 0.1
#: Tokens with at least 1 / SHARE of all training tokens are broadcast: at most SHARE of them (24 MB).
SHARE = 1_000_000
#: Characters cut into tokens at a time, and tokens trained on or scored at a time.
BLOCK, BLOCK_TOKENS = 4 << 20, 1 << 20
#: Distinct tokens a task counts before it passes them on.
HELD = 500_000
END = b" "


def token_key(word: bytes) -> int:
    """56 bits of hash, then the group of the token in the low byte."""
    return (xxh3_64_intdigest(word) & ~0xFF) | (xxh3_64_intdigest(word[-3:], 1) & 0xFF)


END_KEY = token_key(END)


def _tokens(texts: list[str], memory: WordMemory) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all tokens of the texts in a row, an end behind each text, and tokens per text."""
    parts, sizes = [], []
    end = np.array([END_KEY], np.uint64)
    for t in texts:
        words = t.encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII white space only
        parts += [np.fromiter(map(memory.__getitem__, words), np.uint64, len(words)), end]
        sizes.append(len(words) + 1)
    return np.concatenate(parts), np.array(sizes, np.int64)


def tokenise(docs: DataFrame) -> DataFrame:
    """doc_id, held and keys (8 bytes a token, the end last) for every row of ``docs`` (doc_id, held, text); written once.

    Counting, training and scoring read these keys, so texts are cut into tokens once. Null texts count as empty.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordMemory(token_key)
        for batch in batches:
            for part, some in text_blocks(batch, "text", BLOCK):
                keys, sizes = _tokens(some, memory)
                ends = np.cumsum(sizes)
                data = keys.tobytes()
                rows = [data[8 * a : 8 * b] for a, b in zip((ends - sizes).tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held"), pa.array(rows, pa.binary())], ["doc_id", "held", "keys"])

    rows = docs.select("doc_id", "held", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return write_once("lm_tokens", rows.mapInArrow(cut, f"doc_id {kind}, held boolean, keys binary"))


def _key_blocks(batch: pa.RecordBatch, limit: int = BLOCK_TOKENS) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch of about ``limit`` tokens, with the keys of all their rows and tokens per row."""
    sizes = pc.binary_length(batch.column("keys")).to_numpy(zero_copy_only=False).astype(np.int64) // 8
    ends, at = np.cumsum(sizes), 0
    while at < len(ends):
        before = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        part = batch.slice(at, stop - at)
        yield part, np.frombuffer(b"".join(part.column("keys").to_pylist()), np.uint64), sizes[at:stop]
        at = stop


def _added_up(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of several lists and the sums of their counts."""
    keys, counts = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    head = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[head], np.add.reduceat(counts, head)


def count_tokens(tokens: DataFrame) -> DataFrame:
    """key and c, the number of its occurrences, for every token of ``tokens`` (column keys)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            keys, n = held[0]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["key", "c"])

        for b in batches:
            for _, keys, _ in _key_blocks(b):
                held.append(np.unique(keys, return_counts=True))
                held[:] = [_added_up(held)]
                if len(held[0][0]) > HELD:
                    yield flush()
        if held:
            yield flush()

    rows = tokens.select("keys").mapInArrow(counted, "key long, c long")
    return rows.groupBy("key").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """What every task needs to know of the counts; its size is bounded by SHARE."""

    total: int
    distinct: int
    keys: np.ndarray  # frequent tokens, sorted
    counts: np.ndarray
    classes: np.ndarray  # class of each of them
    group_mass: np.ndarray  # smoothed count of all tokens of a group, with one unseen
    prior: np.ndarray  # probability of each class in the training part

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class of every token, and its count or -1 where it is not frequent."""
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        group = COMMON + 1 + (keys & np.uint64(0xFF)).astype(np.int64)
        if not len(self.keys):
            return np.where(keys == np.uint64(END_KEY), COMMON, group), np.full(len(keys), -1)
        hit = self.keys[at] == keys
        known = np.where(hit, self.classes[at], group)
        return np.where(keys == np.uint64(END_KEY), COMMON, known), np.where(hit, self.counts[at], -1)


#: Classes: COMMON tokens, the end, GROUPS groups; as a context also the start.
CLASSES, START = COMMON + 1 + GROUPS, COMMON + 1 + GROUPS


def learn_vocabulary(counts: DataFrame) -> Vocabulary:
    sums = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    total, distinct = sums.n or 0, sums.v
    # at most SHARE tokens can have this many
    found = counts.filter(F.col("c") >= max(1.0, total / SHARE)).toArrow()
    keys, often = found["key"].to_numpy(), found["c"].to_numpy()
    order = np.lexsort((keys, -often))
    keys, often = keys[order].view(np.uint64), often[order]
    classes = COMMON + 1 + (keys & np.uint64(0xFF)).astype(np.int64)
    common = np.flatnonzero(keys != np.uint64(END_KEY))[:COMMON]
    classes[common] = np.arange(len(common))
    group = F.pmod(F.col("key").bitwiseAND(255), F.lit(256)).cast("int")
    held = counts.filter(F.col("key") != int(np.array([END_KEY], np.uint64).view(np.int64)[0]))
    per_group = {r.g: (r.c, r.n) for r in held.groupBy(group.alias("g")).agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect()}
    mass, plain = np.full(GROUPS, ALPHA), np.zeros(GROUPS)
    for g, (c, n) in per_group.items():
        mass[g] += c + ALPHA * n
        plain[g] += c
    own = (keys[common] & np.uint64(0xFF)).astype(np.int64)
    np.subtract.at(mass, own, often[common] + ALPHA)
    np.subtract.at(plain, own, often[common])
    prior = np.zeros(CLASSES)
    prior[: len(common)] = often[common]
    prior[COMMON] = max(total - prior.sum() - plain.sum(), 0)
    prior[COMMON + 1 :] = np.maximum(plain, 0)
    prior = (prior + 1) / (prior + 1).sum()
    order = np.argsort(keys, kind="stable")
    return Vocabulary(total, distinct, keys[order], often[order], classes[order], np.maximum(mass, ALPHA), prior)


class LogBilinear:
    """Context vectors r, target vectors q, position weights and biases."""

    def __init__(self, prior: np.ndarray, dim: int = DIM, seed: int = 5):
        r = np.random.default_rng(seed)
        n = len(prior)
        self.r = r.normal(0, 0.1, (n + 1, dim)).astype(np.float32)
        self.q = r.normal(0, 0.1, (n, dim)).astype(np.float32)
        self.c = np.ones((2, dim), np.float32)
        self.bias = np.log(prior).astype(np.float32)
        self.noise = prior
        self.cumulative = np.cumsum(prior)
        self.sums = [np.full((n + 1, 1), 1e-2, np.float32), np.full((n, 1), 1e-2, np.float32)]

    def flat(self) -> np.ndarray:
        return np.concatenate([x.reshape(-1) for x in (self.r, self.q, self.c, self.bias)])

    def load(self, flat: np.ndarray) -> LogBilinear:
        at = 0
        for x in (self.r, self.q, self.c, self.bias):
            x[...] = flat[at : at + x.size].reshape(x.shape)
            at += x.size
        return self

    def train(self, a: np.ndarray, b: np.ndarray, w: np.ndarray, random: np.random.Generator) -> None:
        """One pass over tokens ``w`` after ``a`` (the last) and ``b`` (the one before)."""
        offset = np.log(NOISE * self.noise).astype(np.float32)
        for i in range(0, len(w), BATCH):
            x, y, t = a[i : i + BATCH], b[i : i + BATCH], w[i : i + BATCH]
            ra, rb = self.r[x], self.r[y]
            hidden = ra * self.c[0] + rb * self.c[1]
            z = np.minimum(np.searchsorted(self.cumulative, random.random(NOISE)), len(self.noise) - 1)
            qt, qz = self.q[t], self.q[z]
            # how sure the model is that the token, and each noise draw, is data
            data = _sigmoid((hidden * qt).sum(1) + self.bias[t] - offset[t]) - 1
            noise = _sigmoid(hidden @ qz.T + self.bias[z] - offset[z])
            back = data[:, None] * qt + noise @ qz
            self._step(1, np.concatenate([t, z]), np.concatenate([data[:, None] * hidden, noise.T @ hidden]), np.r_[data, noise.sum(0)])
            self._step(0, np.concatenate([x, y]), np.concatenate([back * self.c[0], back * self.c[1]]))
            self.c[0] -= RATE * (back * ra).mean(0)
            self.c[1] -= RATE * (back * rb).mean(0)

    def _step(self, which: int, rows: np.ndarray, gradient: np.ndarray, bias: np.ndarray | None = None) -> None:
        """Adagrad on the rows of r or q that a batch touches."""
        # few rows: sorted by radix in 16 bits
        order = np.argsort(rows.astype(np.uint16) if len(self.r) < 1 << 16 else rows, kind="stable")
        rows, gradient = rows[order], gradient[order]
        head = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        own, total = rows[head], np.add.reduceat(gradient, head, axis=0)
        table, sums = (self.r, self.q)[which], self.sums[which]
        sums[own] += (total * total).mean(1, keepdims=True)
        rate = RATE / np.sqrt(sums[own])
        table[own] -= rate * total
        if bias is not None:
            self.bias[own] -= 0.1 * rate[:, 0] * np.add.reduceat(bias[order], head)

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A[a, w], B[b, w] (with the bias) and log Z[a, b] for every context, by matrix products."""
        first = (self.r * self.c[0]).astype(np.float64) @ self.q.T.astype(np.float64)
        second = (self.r * self.c[1]).astype(np.float64) @ self.q.T.astype(np.float64) + self.bias
        m, n = first.max(1, keepdims=True), second.max(1, keepdims=True)
        z = np.log(np.exp(first - m) @ np.exp(second - n).T) + m + n.T
        return first.astype(np.float32), second.astype(np.float32), z.astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-x)), in place."""
    np.clip(x, -30, 30, out=x)
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _contexts(classes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last class and the one before it for every token; the start before a text."""
    first = np.cumsum(sizes) - sizes
    a = np.r_[START, classes[:-1]]
    a[first] = START
    b = np.r_[START, a[:-1]]
    b[first] = START
    return a, b


def train(tokens: DataFrame, vocabulary: Vocabulary) -> LogBilinear:
    """Every partition trains on all its tokens; the averages, weighted by tokens, are the model."""
    shared = tokens.sparkSession.sparkContext.broadcast(vocabulary)

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        model, seen = LogBilinear(v.prior), 0
        random = np.random.default_rng(TaskContext.get().partitionId())
        for batch in batches:
            for _, keys, sizes in _key_blocks(batch):
                w, _ = v.look_up(keys)
                model.train(*_contexts(w, sizes), w, random)
                seen += len(w)
        flat = model.flat().astype(np.float64) if seen else np.zeros(0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat * seen), pa.array(np.full(len(flat), float(seen)))], ["i", "x", "n"]
        )

    model = LogBilinear(vocabulary.prior)
    rows = tokens.select("keys").mapInArrow(trained, "i int, x double, n double")
    mean = rows.groupBy("i").agg((F.sum("x") / F.sum("n")).alias("x")).toArrow()
    if mean.num_rows:
        flat = np.zeros(mean.num_rows)
        flat[mean["i"].to_numpy()] = mean["x"].to_numpy()
        model.load(flat)
    return model


def score(tokens: DataFrame, vocabulary: Vocabulary, model: LogBilinear, counts: DataFrame) -> DataFrame:
    """n_tokens, n_known, train_tokens, base_score and score for every row of ``tokens`` (doc_id, keys).

    Counts of frequent tokens are at hand in each task; the others, of which none is frequent, are
    joined by key. Null ids and repeated rows give a row each.
    """
    kind = tokens.schema["doc_id"].dataType.simpleString()
    first, second, z = model.tables()
    shared = tokens.sparkSession.sparkContext.broadcast((vocabulary, first, second, z))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, first, second, z = shared.value
        number = TaskContext.get().partitionId() << 40
        mass = np.log10(v.group_mass)
        for batch in batches:
            for part, keys, sizes in _key_blocks(batch):
                w, c = v.look_up(keys)
                a, b = _contexts(w, sizes)
                starts = np.cumsum(sizes) - sizes
                logp = (first[a, w] + second[b, w] - z[a, b]).astype(np.float64) / np.log(10)
                grouped = w > COMMON
                logp[grouped] -= mass[w[grouped] - COMMON - 1]
                near = c >= 0
                own = np.where(near, np.log10(np.maximum(c, 0) + ALPHA), 0.0)
                # rare tokens of each text, with the times they occur in it
                doc = np.repeat(np.arange(len(sizes)), sizes)[~near]
                rare = keys[~near]
                order = np.lexsort((rare, doc))
                doc, rare = doc[order], rare[order]
                head = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (rare[1:] != rare[:-1])]) if len(doc) else np.zeros(0, np.int64)
                times = np.diff(np.r_[head, len(doc)])
                offsets = pa.array(np.r_[np.searchsorted(doc[head], np.arange(len(sizes))), len(head)].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(number + np.arange(len(sizes))), pa.array(sizes),
                        pa.array(np.add.reduceat((near & (c > 0)).astype(np.int64), starts)),
                        pa.array(np.add.reduceat(own, starts)), pa.array(np.add.reduceat(logp + np.where(grouped, own, 0), starts)),
                        pa.ListArray.from_arrays(offsets, pa.array(rare[head].view(np.int64))),
                        pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
                    ],
                    ["doc_id", "row", "n_tokens", "n_known", "own", "model", "rare", "times"],
                )
                number += len(sizes)

    heads = write_once("lm_heads", tokens.select("doc_id", "keys").mapInArrow(
        scored,
        f"doc_id {kind}, row long, n_tokens long, n_known long, own double, model double, rare array<long>, times array<int>",
    ))
    rare = heads.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("row", F.col("r.rare").alias("key"), F.col("r.times").alias("times"))
    found = rare.join(counts.filter(F.col("c") < max(1.0, vocabulary.total / SHARE)), "key", "left")
    log = F.log10(F.coalesce(F.col("c"), F.lit(0)) + ALPHA) * F.col("times")
    sums = found.groupBy("row").agg(
        F.sum(log).alias("more"), F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("known")
    )
    out = heads.drop("rare", "times").join(sums, "row", "left")
    more, known = F.coalesce("more", F.lit(0.0)), F.coalesce("known", F.lit(0))
    space = float(np.log10(vocabulary.total + ALPHA * (vocabulary.distinct + 1)))
    return out.select(
        "doc_id", "n_tokens", (F.col("n_known") + known).alias("n_known"), F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        (F.col("own") + more - F.col("n_tokens") * space).alias("base_score"), (F.col("model") + more).alias("score"),
    )


def score_held_out(docs: DataFrame) -> DataFrame:
    """Learns from the rows whose crc32 of the id modulo 10 is not 0 and scores every row.

    Rows without id are held out. An empty table gives an empty one; without training rows every
    token is unseen.
    """
    held: Column = crc_mod(F.col("doc_id"), 10) == 0
    tokens = tokenise(docs.select("doc_id", "text", held.alias("held")))
    learned = tokens.filter("NOT held")
    counts = write_once("token_counts", count_tokens(learned))
    vocabulary = learn_vocabulary(counts)
    model = train(learned, vocabulary)
    found = score(tokens, vocabulary, model, counts)
    return found.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
