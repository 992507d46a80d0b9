"""Scores of a block of queries against documents, batch by batch, inside one task.

A task sees the documents of its bucket in the order of their ids, a batch at a time, and the words of
all queries of a block. It holds one batch's postings, the scores of as many queries as ``SCORES`` allows against the batch,
and the best k so far of each query, so its memory does not grow with the pairs that share a word, and no pair leaves
it that is not among its best k or above the minimum.

Scores of a batch are first taken roughly, in single precision and for many queries at once: words that many pairs share
by a product of two matrices, all others posting by posting. Only pairs that may count by their rough score are
added up exactly. Where a score is known that a query's best reach (``Block.bars``), its frequent words are left out of the
rough scores as far as they cannot matter; documents of like length are scored together, so that this can be told.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Rows that a task hands on at a time.
OUT_ROWS = 200_000
# Rough scores that a task holds at a time, query words that it looks at for them, and words that it multiplies as a matrix at most.
SCORES = 1 << 17
QUERY_WORDS = 1 << 19
DENSE_WORDS = 1_024
# Share of all pairs that have to share a word before the product of matrices is the cheaper way.
DENSE_SHARE = 1 / 250
# Postings and documents of a batch that are scored together, about.
PART_POSTINGS = 1 << 17
PART_DOCUMENTS = 1_024
# Share of the score to reach that frequent words which are left out may add.
LEFT_OUT = 0.3
# Units below this are raised to it in rough scores, so that no product of two is lost.
LEAST_UNIT = 1e-18
# Cells of one term inside a shard: the levels of prefix norms and the one of infrequent terms.
CELLS = 64


@dataclass(frozen=True)
class Block:
    """Words of some queries, a query's side by side, the most frequent first; ``codes`` are places in ``words``.

    ``bars``: for a search by scores that are known to be reached, the least that a document of a query's best can have.
    """

    ids: pa.Array
    words: pa.Array
    starts: np.ndarray
    codes: np.ndarray
    units: np.ndarray
    rests: np.ndarray | None = None
    floors: np.ndarray | None = None
    bars: np.ndarray | None = None

    @cached_property
    def longest(self) -> float:
        """The greatest norm of a query's known words."""
        query = np.repeat(np.arange(len(self.ids)), np.diff(self.starts))
        return float(np.sqrt(np.bincount(query, self.units**2, 1).max()))

    @cached_property
    def asked(self) -> np.ndarray:
        """How many queries hold a word."""
        return np.bincount(self.codes, minlength=len(self.words))


def _encoded(column: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """Distinct values, null among them, and each row's place in them."""
    coded = column.combine_chunks()
    coded = (coded if isinstance(coded, pa.Array) else pa.concat_arrays(coded.chunks)).dictionary_encode("encode")
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def block_of(rows: pa.Table, query_id: str) -> Block:
    """``rows``: query id, term, query_unit, df if it is known and, for a pruned search, query_rest and floor."""
    ids, mine = _encoded(rows[query_id])
    words, codes = _encoded(rows["term"])
    often = np.zeros(len(words))
    often[codes] = rows["df"].to_numpy() if "df" in rows.column_names else np.bincount(codes)[codes]
    order = np.lexsort((codes, -often[codes], mine))
    mine, codes = mine[order], codes[order]
    starts = np.searchsorted(mine, np.arange(len(ids) + 1))

    def numbers(name: str) -> np.ndarray:
        return rows[name].to_numpy().astype(np.float64)[order]

    if "floor" not in rows.column_names:
        return Block(ids, words, starts, codes.astype(np.int32), numbers("query_unit"))
    return Block(
        ids, words, starts, codes, numbers("query_unit"), numbers("query_rest"), numbers("floor")[starts[:-1]]
    )


class Entries:
    """One batch's documents with their words, each different word once, whatever queries they will meet."""

    def __init__(self, batch: pa.RecordBatch):
        self.ids, lists = batch.column(0), batch.column(1)
        self.n = len(lists)
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        self.columns = dict(zip((f.name for f in lists.type.value_type), lists.flatten().flatten()))
        terms = self.columns.pop("term").dictionary_encode("encode")
        self.terms, self.term = terms.dictionary, terms.indices.to_numpy(zero_copy_only=False)
        self.places = np.repeat(np.arange(self.n, dtype=np.int32), sizes)


def _entries(batches: Iterable[pa.RecordBatch | Entries]) -> Iterator[Entries]:
    return (batch if isinstance(batch, Entries) else Entries(batch) for batch in batches)


class Postings:
    """One batch's documents by term: places in the batch and units; for a pruned search bounds per cell."""

    def __init__(self, batch: Entries, words: pa.Array, bounds: bool):
        self.n, entries = batch.n, batch.columns
        places = batch.places.astype(np.int64)
        known = pc.fill_null(pc.index_in(batch.terms, value_set=words), -1).to_numpy(zero_copy_only=False)
        codes = known[batch.term] if len(known) else np.zeros(0, np.int64)
        units = entries["unit"].to_numpy(zero_copy_only=False)
        order = np.lexsort((places, codes))
        order = order[np.searchsorted(codes[order], 0) :]
        codes, places, units = codes[order], places[order], units[order]
        new = np.ones(len(codes), bool)
        new[1:] = (codes[1:] != codes[:-1]) | (places[1:] != places[:-1])
        if bounds:
            rest, shard, cell = (entries[c].to_numpy(zero_copy_only=False)[order] for c in ("rest", "shard", "cell"))
            self.rows = np.searchsorted(codes, np.arange(len(words) + 1)), places, units, rest
            self._bound(codes, units, rest, shard.astype(np.int64) * CELLS + cell + 1, len(words))
        if not new.all():
            # a document that is there twice has a word twice; its units add up
            at = np.flatnonzero(new)
            units, codes, places = np.add.reduceat(units, at), codes[at], places[at]
        self.codes, self.places, self.units = codes, places, units
        self.starts = np.searchsorted(codes, np.arange(len(words) + 1))

    def _bound(self, codes, units, rest, cell, n_words: int) -> None:
        order = np.lexsort((cell, codes))
        c, x = codes[order], cell[order]
        at = np.flatnonzero(np.r_[True, (c[1:] != c[:-1]) | (x[1:] != x[:-1])]) if len(c) else np.zeros(0, int)
        if len(at):
            self.top_unit = np.maximum.reduceat(units[order], at)
            self.top_rest = np.maximum.reduceat(rest[order], at)
        self.cells = np.searchsorted(c[at], np.arange(n_words + 1))

    def reached(self, codes, units, rests, floor: float) -> np.ndarray | None:
        """Which documents have a word whose bound reaches ``floor``; None if no cell of any word does."""
        mask = None
        for c, unit, rest in zip(codes, units, rests):
            a, b = self.cells[c], self.cells[c + 1]
            if a < b and (unit * self.top_unit[a:b] + rest * self.top_rest[a:b]).max() >= floor:
                at, places, own, others = self.rows
                part = slice(at[c], at[c + 1])
                mask = np.zeros(self.n, bool) if mask is None else mask
                mask[places[part][unit * own[part] + rest * others[part] >= floor]] = True
        return mask


def rounded(scores: np.ndarray, digits: int) -> np.ndarray:
    return np.floor(scores * 10.0**digits + 0.5) / 10.0**digits


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each run, one run after the other."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


class Rough:
    """Scores of a block's queries against some documents of a batch, those of ``part`` of its postings.

    Words that many pairs share are multiplied as matrices, others added up posting by posting. Of these, a query that has
    a score to reach leaves out the most frequent ones, as long as all that they can add, their units times the
    greatest ones here, stays below ``LEFT_OUT`` of it; that much counts for every document.
    """

    def __init__(self, block: Block, lists: Postings, part: np.ndarray, documents: np.ndarray, slots: np.ndarray):
        """``documents``: their places in the batch, numbered here in that order; ``slots``, -1 for every word, is lent until ``done``."""
        self.block, self.n = block, len(documents)
        codes, self.units = lists.codes[part], lists.units[part]
        number = np.empty(lists.n, np.int64)
        number[documents] = np.arange(self.n)
        self.places = number[lists.places[part]]
        self.first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
        self.words, self.held = codes[self.first], np.diff(np.r_[self.first, len(codes)])
        self.slots = slots
        slots[self.words] = np.arange(len(self.words))
        self.raised = np.maximum(self.units, LEAST_UNIT)
        self.top = np.maximum.reduceat(self.raised, self.first)
        self.keys = np.repeat(np.arange(len(self.words)), self.held) * self.n + self.places
        # where a posting with these bits lies; -1 tells that there is none, as for most pairs of a word and a document
        self.bits = len(codes).bit_length() + 2
        self.where = np.full(1 << self.bits, -1, np.int32)
        self.where[self._hashed(self.keys)] = np.arange(len(codes))
        pairs = self.held * block.asked[self.words]
        dense = np.flatnonzero(pairs > DENSE_SHARE * len(block.ids) * self.n)
        dense = dense[np.argsort(-pairs[dense], kind="stable")[:DENSE_WORDS]]
        self.row = np.full(len(self.words), -1)
        self.row[dense] = np.arange(len(dense))
        counts = self.held[dense]
        at = _spread(self.first[dense], counts)
        self.matrix = np.zeros((len(dense), self.n), np.float32)
        self.matrix[np.repeat(np.arange(len(dense)), counts), self.places[at]] = self.raised[at]
        # what single precision may be off by; norms are over 1 only where ids come twice
        longest = np.sqrt(np.bincount(self.places, self.units**2, 1).max())
        self.slack = (len(dense) + 64) * 2.0**-22 * max(1.0, longest) * max(1.0, block.longest)

    def _hashed(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)

    def done(self) -> None:
        self.slots[self.words] = -1

    def near(self, a: int, b: int, bars: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of queries ``a`` to ``b`` that share a word, score over ``bars`` and are among a query's best ``k`` here; and some others."""
        block, n, width = self.block, self.n, len(self.matrix)
        some = slice(block.starts[a], block.starts[b])
        slots = self.slots[block.codes[some]]
        here = np.flatnonzero(slots >= 0)
        slots, units = slots[here], np.maximum(block.units[some][here], LEAST_UNIT)
        query = np.repeat(np.arange(b - a), np.diff(np.searchsorted(here, block.starts[a : b + 1] - block.starts[a])))
        row = self.row[slots]
        many, few = np.flatnonzero(row >= 0), np.flatnonzero(row < 0)
        asked = np.bincount(query[many] * width + row[many], units[many], (b - a) * width).reshape(b - a, width)
        total = asked.astype(np.float32) @ self.matrix

        bar = bars[a:b] - self.slack
        query, slots, units = query[few], slots[few], units[few]
        upto = np.r_[0.0, np.cumsum(units * self.top[slots])]
        upto = upto[1:] - upto[np.searchsorted(query, np.arange(b - a))][query]
        out = upto < LEFT_OUT * bar[query] if block.bars is not None else np.zeros(len(query), bool)
        rest = np.zeros(b - a)
        # sums grow within a query: the last is the greatest
        rest[query[out]] = upto[out]
        query, slots, units = query[~out], slots[~out], units[~out]
        counts = self.held[slots]
        at = _spread(self.first[slots], counts)
        flat = self.places[at]
        flat += np.repeat(query * n, counts)
        found = self.raised[at].astype(np.float32)
        found *= np.repeat(units.astype(np.float32), counts)
        np.add.at(total.ravel(), flat, found)

        if block.bars is None and n >= 2 * k:
            # of documents in groups, the k-th greatest of the groups' best is no more than the k-th best of all
            groups = min(16 * k, n)
            tops = total[:, : n - n % groups].reshape(b - a, -1, groups).max(1)
            bar = np.maximum(bar, np.partition(tops, groups - k)[:, groups - k] - 2 * self.slack)
        # no pair without a shared word; a bar rounded to single precision may only fall
        least = np.nextafter((bar - rest).astype(np.float32), np.float32(-1))
        least = np.maximum(least, np.finfo(np.float32).tiny)
        rows = np.flatnonzero(total.max(1) >= least)
        flat = np.flatnonzero(total[rows] >= least[rows, None])
        return rows[flat // n] + a, flat % n

    def exact(self, queries: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Scores of pairs, added up word by word."""
        block = self.block
        counts = block.starts[queries + 1] - block.starts[queries]
        at = _spread(block.starts[queries], counts)
        pair, slots, units = np.repeat(np.arange(len(queries)), counts), self.slots[block.codes[at]], block.units[at]
        some = np.flatnonzero(slots >= 0)
        keys = slots[some] * self.n + places[pair[some]]
        at = self.where[self._hashed(keys)]
        there = np.flatnonzero(at >= 0)
        at, some, keys = at[there], some[there], keys[there]
        other = np.flatnonzero(self.keys[at] != keys)
        at[other] = np.minimum(np.searchsorted(self.keys, keys[other]), len(self.keys) - 1)
        met = self.keys[at] == keys
        at, some = at[met], some[met]
        return np.bincount(pair[some], units[some] * self.units[at], len(queries))


def _parts(lists: Postings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The batch's documents from those with the fewest words on, cut by postings: places of postings, places of documents.

    Units of documents of one length are alike, so that the greatest of a word bounds them well.
    """
    sizes = np.bincount(lists.places, minlength=lists.n)
    order = np.argsort(sizes, kind="stable")
    order = order[np.searchsorted(sizes[order], 1) :]
    if not len(order):
        return
    before = np.cumsum(sizes[order]) - sizes[order]
    part = np.maximum(before // PART_POSTINGS, np.arange(len(order)) // PART_DOCUMENTS)
    # where both rules cut, numbers may leave gaps
    part = np.r_[0, np.cumsum(part[1:] != part[:-1])]
    of = np.empty(lists.n, np.int64)
    of[order] = part
    mine = of[lists.places]
    by_part = np.argsort(mine, kind="stable")
    cuts = np.searchsorted(mine[by_part], np.arange(part[-1] + 2))
    ends = np.searchsorted(part, np.arange(part[-1] + 2))
    for i in range(part[-1] + 1):
        yield by_part[cuts[i] : cuts[i + 1]], np.sort(order[ends[i] : ends[i + 1]])


def _search_together(
    block: Block, batches: Iterator[pa.RecordBatch], names: list[str], digits: int, k: int, least: float | None
) -> Iterator[pa.RecordBatch]:
    """``search`` for the best ``k`` of queries without a floor."""
    # where a score to reach is known, documents are met by their length, and of equal scores a later one may count
    half = 0.5 * 10.0**-digits
    above = 0.8 * half if block.bars is None else -1.2 * half
    n_queries = len(block.ids)
    bars = np.full(n_queries, 0.0 if least is None else max(0.0, least - 2 * half))
    if block.bars is not None:
        bars = np.maximum(bars, block.bars - 1.2 * half)
    # the best so far: query, place among the task's documents, score
    best = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    documents, seen, found, waiting = [], 0, [], 0
    slots = np.full(len(block.words), -1)

    def rows(queries, places, ids: pa.Array, values) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(queries), OUT_ROWS):
            part = slice(i, i + OUT_ROWS)
            columns = [block.ids.take(pa.array(queries[part])), ids.take(pa.array(places[part])), pa.array(values[part])]
            yield pa.RecordBatch.from_arrays(columns, names)

    def merged() -> tuple:
        top = _merged([best, *found], k)
        # any other document has to score as much as the k-th, and more where all others come after it
        last = np.flatnonzero(np.arange(len(top[0])) - np.searchsorted(top[0], top[0]) == k - 1)
        bars[top[0][last]] = np.maximum(bars[top[0][last]], top[2][last] + above)
        return top

    for batch in _entries(batches):
        lists = Postings(batch, block.words, False)
        whole = [(np.arange(len(lists.codes)), np.arange(lists.n))] if len(lists.codes) else []
        for part, places in whole if block.bars is None else _parts(lists):
            rough = Rough(block, lists, part, places, slots)
            step = max(1, SCORES // rough.n)
            b = 0
            while b < n_queries:
                a = b
                b = np.searchsorted(block.starts, block.starts[a] + QUERY_WORDS, "right") - 1
                b = min(max(a + 1, b), a + step, n_queries)
                queries, near = rough.near(a, b, bars, k)
                for i in range(0, len(queries), OUT_ROWS):
                    q, p = queries[i : i + OUT_ROWS], near[i : i + OUT_ROWS]
                    values = rough.exact(q, p)
                    over = values > bars[q]
                    q, p, values = q[over], places[p[over]], rounded(values[over], digits)
                    if least is not None:
                        over = values >= least
                        q, p, values = q[over], p[over], values[over]
                    found.append((q, p + seen, values))
                    waiting += len(q)
                if waiting > OUT_ROWS:
                    best, found, waiting = merged(), [], 0
            rough.done()
            if waiting > n_queries // 2:
                best, found, waiting = merged(), [], 0
        documents.append(batch.ids)
        seen += lists.n
    if documents:
        best = merged()
        yield from rows(best[0], best[1], pa.concat_arrays(documents), best[2])


def bars_of(block_ids: pa.Array, ids: pa.ChunkedArray, scores: pa.ChunkedArray) -> np.ndarray:
    """``Block.bars``: the score of each of a block's queries that has one among ``ids``, 0 of others."""
    at = pc.index_in(block_ids, value_set=ids.combine_chunks())
    return pc.fill_null(scores.combine_chunks().take(at), 0.0).to_numpy(zero_copy_only=False)


def _merged(lots: list[tuple], k: int) -> tuple:
    """The ``k`` best per query of lots of (query, place, score); equal scores go to the first place."""
    queries, places, values = (np.concatenate(x) for x in zip(*lots))
    order = np.lexsort((places, -values, queries))
    queries = queries[order]
    keep = np.arange(len(order)) - np.searchsorted(queries, queries) < k
    return queries[keep], places[order][keep], values[order][keep]


def search(
    block: Block, batches: Iterator[pa.RecordBatch], names: list[str], digits: int, k: int | None, least: float | None
) -> Iterator[pa.RecordBatch]:
    """(query, document, score) of the best ``k`` per query, of all scores from ``least`` on, or of all that share a word.

    ``batches``: documents in the order of their ids, each with its postings. Equal scores go to the first document.
    """
    if block.floors is None and k is not None:
        yield from _search_together(block, batches, names, digits, k, least)
        return
    half = 0.5 * 10.0**-digits
    n_queries = len(block.ids)
    scores = [np.zeros(0)] * n_queries
    found = [np.zeros(0, np.int64)] * n_queries
    bars = np.full(n_queries, 0.0 if least is None else max(0.0, least - 2 * half))
    pruned, mask = block.floors is not None, None
    starts, all_codes, all_units = block.starts.tolist(), block.codes.tolist(), block.units.tolist()
    documents, seen, waiting = [], 0, []

    def rows(queries, places, ids: pa.Array, values) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([block.ids.take(pa.array(queries)), ids.take(pa.array(places)), pa.array(values)], names)

    for batch in _entries(batches):
        lists = Postings(batch, block.words, pruned)
        at, places, units = lists.starts.tolist(), lists.places, lists.units
        total = np.zeros(lists.n)
        for q in range(n_queries):
            a, b = starts[q], starts[q + 1]
            bar = bars[q]
            if pruned:
                mask = lists.reached(all_codes[a:b], all_units[a:b], block.rests[a:b], block.floors[q])
                if mask is None:
                    continue
            total.fill(0.0)
            for c, unit in zip(all_codes[a:b], all_units[a:b]):
                x, y = at[c], at[c + 1]
                if x < y:
                    total[places[x:y]] += unit * units[x:y]
            hits = np.flatnonzero(total > bar if mask is None else (total > bar) & mask)
            if not len(hits):
                continue
            if k is None:
                values = rounded(total[hits], digits)
                if least is not None:
                    hits, values = hits[values >= least], values[values >= least]
                waiting.append((np.full(len(hits), q), hits, values))
                if sum(len(w[0]) for w in waiting[-64:]) > OUT_ROWS or len(waiting) >= 4096:
                    yield rows(*(np.concatenate(x) for x in list(zip(*waiting))[:2]), batch.ids, np.concatenate([w[2] for w in waiting]))
                    waiting = []
                continue
            reached = total[hits]
            if len(hits) > 4 * k:
                keep = reached >= np.partition(reached, len(hits) - k)[len(hits) - k] - 2 * half
                hits, reached = hits[keep], reached[keep]
            values = np.concatenate([scores[q], rounded(reached, digits)])
            order = np.argsort(-values, kind="stable")[:k]
            scores[q], found[q] = values[order], np.concatenate([found[q], hits + seen])[order]
            if len(order) == k:
                # a later document has to score more than the k-th
                bars[q] = max(bar, scores[q][-1] + 0.8 * half)
        if waiting:
            yield rows(*(np.concatenate(x) for x in list(zip(*waiting))[:2]), batch.ids, np.concatenate([w[2] for w in waiting]))
            waiting = []
        if k is not None:
            documents.append(batch.ids)
        seen += lists.n
    if k is None or not documents:
        return
    ids = pa.concat_arrays(documents)
    sizes = np.fromiter(map(len, found), np.int64, n_queries)
    queries, places, values = np.repeat(np.arange(n_queries), sizes), np.concatenate(found), np.concatenate(scores)
    for i in range(0, len(queries), OUT_ROWS):
        part = slice(i, i + OUT_ROWS)
        yield rows(queries[part], places[part], ids, values[part])


def search_blocks(
    blocks: list[Callable[[], Block]], batches: Iterator[pa.RecordBatch], names: list[str], digits: int, k: int
) -> Iterator[pa.RecordBatch]:
    """``search`` for the best ``k`` of several blocks of queries, one block after the other.

    With more than one, a task's documents, a bucket's postings, are held meanwhile; a block only while it is searched.
    """
    held = batches if len(blocks) == 1 else list(_entries(batches))
    for block in blocks:
        yield from search(block(), iter(held), names, digits, k, None)
