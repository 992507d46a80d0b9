"""Removal of repeated passages by Relative Lempel-Ziv parsing.

Documents are parsed against reference blocks into factors: stretches that also stand, word for word,
in a document with a smaller id. A factor counts from ``WINDOW`` words on, so the head of every
factor is a window of that many words found in an index of all blocks. A task first parses
its own block, so of a passage that many documents of a block share only the first occurrence goes
on to the index. The index is cut by the rarest (smallest hashed) run of ``ANCHOR`` words inside a window:
equal windows have equal anchors, and neighbouring windows mostly share theirs, so
windows travel in runs of a few bytes each. Windows of anchors that are frequent in a sample are dealt by the window
instead, everywhere alike, so equal windows still meet and no anchor fills an index part. Every window is looked up. A
document's matched windows are then parsed greedily into factors (``factors``): each is as long as its head's reference goes on,
the next starts behind it, and windows that straddle the boundary are checked there, so no repeated window is missed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapledger.llm.frames import WordMemory, free_name, hash64, mix, parts_for, shingle_hashes, text_blocks, word_hashes
from gapledger.sources.shared import write_once

WINDOW, ANCHOR = 13, 5
#: Characters in a reference block, and characters whose windows one index part holds.
BLOCK, PART = 5 << 20, 16 << 20
#: Least number of index parts, so that small inputs keep many cores busy too.
LEAST_PARTS = 64
#: Characters of the sample in which windows are counted per anchor, and counters per index part.
SAMPLE, SLOTS = 64 << 20, 256
#: Anchors that share a counter with more windows than this, and than an eighth of a part, are dealt by window.
HEAVY = 20_000
#: Place of rows without id: after all others.
LAST = (1 << 63) - 1
#: Bytes of a window's hash that travel beside its 64-bit anchor.
TAIL = 5
#: A factor piece: first word, number of windows, and where the reference has them.
PIECE = np.dtype([("start", "<u4"), ("windows", "<u4"), ("ref", "<i8"), ("ref_start", "<u4")])
_ONE = np.uint64(0x9E3779B97F4A7C15)


def _flat(texts: list[str], memory: WordMemory) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in a row, and each text's number of words."""
    parts = [word_hashes(memory, t.encode("utf-8", "replace").split()) for t in texts]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.array([len(p) for p in parts], np.int64)


def _pieces(doc, start, ref, ref_start) -> tuple[np.ndarray, np.ndarray]:
    """Joins windows (in order of doc and start) whose references continue: (doc of a piece, pieces)."""
    if not len(doc):
        return np.zeros(0, np.int64), np.zeros(0, PIECE)
    goes_on = (np.diff(doc) == 0) & (np.diff(start) == 1) & (np.diff(ref) == 0) & (np.diff(ref_start) == 1)
    first = np.flatnonzero(np.r_[True, ~goes_on])
    out = np.zeros(len(first), PIECE)
    out["start"], out["windows"] = start[first], np.diff(np.r_[first, len(doc)])
    out["ref"], out["ref_start"] = ref[first], ref_start[first]
    return doc[first], out


def _windows(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Place, text, hash and anchor of every window that lies in one text."""
    ends, doc_of = np.cumsum(sizes), np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(max(0, len(words) - WINDOW + 1))
    at = at[at + WINDOW <= ends[doc_of[at]]]
    if not len(at):
        return at, at, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    runs = shingle_hashes(words, ANCHOR)
    anchor = np.lib.stride_tricks.sliding_window_view(runs, WINDOW - ANCHOR + 1).min(1)[at]
    return at, doc_of[at], shingle_hashes(words, WINDOW)[at], anchor


def heavy_slots(rows: DataFrame, size: int, parts: int, least: int = HEAVY) -> np.ndarray:
    """Which of SLOTS * ``parts`` or more counters of anchors (anchor modulo their number) have too many windows for one part.

    Different windows are counted in a sample of ``rows`` (text) of ``size`` bytes. What is found decides
    only where windows are looked up, never whether.
    """
    slots = 1 << (SLOTS * parts - 1).bit_length()
    share = min(1.0, SAMPLE / max(1, size))
    some = rows.select("text").sample(share, seed=29) if share < 1 else rows.select("text")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, n = WordMemory(hash64), np.zeros(slots, np.int64)
        for b in batches:
            for _, texts in text_blocks(b, "text", BLOCK):
                _, _, window, anchor = _windows(*_flat(texts, memory))
                _, first = np.unique(window, return_index=True)
                n += np.bincount((anchor[first] % np.uint64(slots)).astype(np.int64), minlength=slots)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n[at], pa.int64())], ["slot", "n"])

    counts = write_once("anchors", some.mapInArrow(counted, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")))
    most = max(least * share, (counts.agg(F.sum("n")).first()[0] or 0) / (8 * parts))
    heavy = np.zeros(slots, bool)
    heavy[[r.slot for r in counts.filter(F.col("n") > most).select("slot").collect()]] = True
    return heavy


def parse_block(
    ids: np.ndarray, checks: np.ndarray, texts: list[str], memory: WordMemory, parts: int, heavy: np.ndarray | None = None
) -> list[dict]:
    """Parses a block against itself; one row per index part with the windows that are left.

    ids and checks (of the texts) name the rows. ``own`` holds the factor pieces found in the block.
    ``heavy`` tells the anchors (modulo its length) whose windows are dealt one by one.
    """
    order = np.argsort(ids, kind="stable")
    ids, checks, texts = ids[order], checks[order], [texts[i] for i in order]
    words, sizes = _flat(texts, memory)
    at, doc, window, anchor = _windows(words, sizes)
    if not len(at):
        return []
    start = at - (np.cumsum(sizes) - sizes)[doc]
    _, first, which = np.unique(window, return_index=True, return_inverse=True)
    first = first[which]  # the occurrence with the smallest id, then the first one in it
    known = ids[doc[first]] < ids[doc]
    own_doc, own = _pieces(doc[known], start[known], ids[doc[first[known]]], start[first[known]])
    left = np.flatnonzero(~known)
    doc, start, window, anchor, at = doc[left], start[left], window[left], anchor[left], at[left]
    # runs of neighbouring windows with one anchor, at most 256 long
    new = np.r_[True, (np.diff(at) != 1) | (np.diff(anchor.view(np.int64)) != 0) | (np.diff(doc) != 0)] if len(at) else np.zeros(0, bool)
    new |= start % 200 == 0
    alone = np.zeros(len(at), bool) if heavy is None else heavy[(anchor % np.uint64(len(heavy))).astype(np.int64)]
    new |= alone
    head = np.flatnonzero(new)
    length = np.diff(np.r_[head, len(at)])
    part = (np.where(alone, mix(window), anchor)[head] % np.uint64(parts)).astype(np.int64)
    by_part = np.argsort(part, kind="stable")
    own_part = own_doc % parts
    tails = window.view(np.uint8).reshape(-1, 8)[:, :TAIL]
    rows = []
    for p in np.unique(np.concatenate([part, own_part])).tolist():
        some = by_part[slice(*np.searchsorted(part[by_part], [p, p + 1]))]
        mine = np.flatnonzero(own_part == p)
        docs, place = np.unique(np.concatenate([doc[head[some]], own_doc[mine]]), return_inverse=True)
        h, n = head[some], length[some]
        each = np.repeat(h, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        rows.append({
            "part": p, "ids": ids[docs].astype("<i8").tobytes(), "checks": checks[docs].astype("<i8").tobytes(),
            "run_doc": place[: len(some)].astype("<u4").tobytes(), "run_start": start[h].astype("<u4").tobytes(),
            "run_length": n.astype("<u2").tobytes(), "anchors": anchor[h].astype("<u8").tobytes(),
            "tails": tails[each].tobytes(), "own_doc": place[len(some) :].astype("<u4").tobytes(), "own": own[mine].tobytes(),
        })
    return rows


BLOB = ("ids", "checks", "run_doc", "run_start", "run_length", "anchors", "tails", "own_doc", "own")


def look_up(blobs: pd.DataFrame) -> pd.DataFrame:
    """Factor pieces of all rows of one index part: (doc_key, check, pieces)."""
    ids, checks, doc, start, key, own_doc, own, base = [], [], [], [], [], [], [], 0
    for b in blobs.itertuples(index=False):
        n = np.frombuffer(b.run_length, "<u2").astype(np.int64)
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        tail = np.zeros((len(inside), 8), np.uint8)
        tail[:, :TAIL] = np.frombuffer(b.tails, np.uint8).reshape(-1, TAIL)
        key.append(mix(np.repeat(np.frombuffer(b.anchors, "<u8"), n) * _ONE + tail.view(np.uint64)[:, 0]))
        doc.append(np.repeat(np.frombuffer(b.run_doc, "<u4").astype(np.int64), n) + base)
        start.append(np.repeat(np.frombuffer(b.run_start, "<u4").astype(np.int64), n) + inside)
        own_doc.append(np.frombuffer(b.own_doc, "<u4").astype(np.int64) + base)
        own.append(np.frombuffer(b.own, PIECE))
        ids.append(np.frombuffer(b.ids, "<i8"))
        checks.append(np.frombuffer(b.checks, "<i8"))
        base += len(ids[-1])
    ids, checks, doc, start, key, own_doc, own = map(np.concatenate, (ids, checks, doc, start, key, own_doc, own))
    found_doc, found = np.zeros(0, np.int64), np.zeros(0, PIECE)
    if len(key):
        order = np.argsort(key, kind="stable")
        same = np.r_[False, np.diff(key[order].view(np.int64)) == 0]
        twice = order[same | np.r_[same[1:], False]]  # windows that stand alone are done with
        del order, same
        if len(twice):
            key, doc, start = key[twice], doc[twice], start[twice]
            order = np.lexsort((start, ids[doc], key))
            key, doc, start = key[order], doc[order], start[order]
            head = np.r_[True, key[1:] != key[:-1]]
            first = np.flatnonzero(head)[np.cumsum(head) - 1]
            known = np.flatnonzero(ids[doc[first]] < ids[doc])
            known = known[np.lexsort((start[known], doc[known]))]
            found_doc, found = _pieces(doc[known], start[known], ids[doc[first[known]]], start[first[known]])
    every_doc, every = np.concatenate([own_doc, found_doc]), np.concatenate([own, found])
    order = np.argsort(every_doc, kind="stable")
    every_doc, every = every_doc[order], every[order]
    head = np.flatnonzero(np.r_[True, every_doc[1:] != every_doc[:-1]]) if len(every_doc) else np.zeros(0, np.int64)
    cuts = np.split(every, head[1:]) if len(head) else []
    return pd.DataFrame({
        "doc_key": ids[every_doc[head]], "check": checks[every_doc[head]], "pieces": [c.tobytes() for c in cuts],
    })


def matched(pieces: list[bytes]) -> np.ndarray:
    """All windows that have a reference, as pieces in the order of the text; what continues a reference is one piece.

    A window has one reference, so the pieces of different index parts share none.
    """
    p = np.concatenate([np.frombuffer(b, PIECE) for b in pieces]) if pieces else np.zeros(0, PIECE)
    p = np.sort(p, order=["start", "windows"])
    _, out = _pieces(*[np.repeat(p[c], p["windows"]).astype(np.int64) + (_inside(p) if c in ("start", "ref_start") else 0) for c in ("ref", "start", "ref", "ref_start")])
    return out


def factors(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A document's greedy parse: its factors, and the matched windows that straddle the end of one.

    The first matched window at or behind the end of a factor heads the next; it takes all words along which its
    reference goes on. A matched window that starts inside a factor and ends behind it is checked at that boundary:
    its words repeat too, though it is part of no factor. Both are rows of PIECE; words between them have no reference.
    """
    found, joints, end = [], [], 0
    for start, windows, ref, ref_start in matched(pieces).tolist():
        inside = min(max(end - start, 0), windows)
        if inside:
            joints.append((start, inside, ref, ref_start))
        if inside < windows:
            found.append((start + inside, windows - inside, ref, ref_start + inside))
            end = start + windows + WINDOW - 1
    return np.array(found, PIECE), np.array(joints, PIECE)


def _inside(p: np.ndarray) -> np.ndarray:
    n = p["windows"].astype(np.int64)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def covered(n_words: int, pieces: list[bytes]) -> np.ndarray:
    """Which words lie in a factor of the document's parse, or in a window that straddles the end of one."""
    edge = np.zeros(n_words + 1, np.int64)
    for p in factors(pieces):
        np.add.at(edge, p["start"].astype(np.int64), 1)
        np.add.at(edge, p["start"].astype(np.int64) + p["windows"] + WINDOW - 1, -1)
    return np.cumsum(edge[:-1]) > 0


def _keyed(docs: DataFrame) -> DataFrame:
    """Columns doc_key and check, which name a row: its id (rows without one come last) and a hash of its text."""
    return docs.withColumns({
        "doc_key": F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)),
        "check": F.xxhash64(F.coalesce(F.col("text"), F.lit(""))),
    })


def find_pieces(docs: DataFrame, block: int = BLOCK, part: int = PART) -> DataFrame:
    """Factor pieces of every row of ``docs`` (doc_id, text) that has any: doc_key, check, pieces array<binary>."""
    rows = _keyed(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))).select("doc_key", "check", "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = parts_for(size, part, LEAST_PARTS)
    heavy = heavy_slots(rows, size, parts, HEAVY)

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordMemory(hash64)
        for b in batches:
            for some, texts in text_blocks(b, "text", block):
                ids, checks = (some.column(c).to_numpy() for c in ("doc_key", "check"))
                made = parse_block(ids, checks, texts, memory, parts, heavy)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["part"] for r in made], pa.int32()), *[pa.array([r[c] for r in made], pa.binary()) for c in BLOB]],
                    ["part", *BLOB],
                )

    blobs = rows.mapInArrow(parsed, "part int, " + ", ".join(f"{c} binary" for c in BLOB))
    found = blobs.groupBy("part").applyInPandas(look_up, "doc_key long, check long, pieces binary")
    # a row's pieces come from different parts; equal rows have equal pieces
    return found.groupBy("doc_key", "check").agg(F.collect_list("pieces").alias("pieces"))


def remove_repeats(docs: DataFrame, texts: bool = True, block: int = BLOCK, part: int = PART) -> DataFrame:
    """Every row of ``docs`` without the words that windows of a smaller doc_id cover.

    Returns the columns of ``docs`` with the kept words, joined by spaces, as text (where nothing is removed
    the text stays as it is) and n_words, n_removed; with ``texts`` false: doc_id, n_words, n_removed, kept_sha256.
    Null texts have no words. A row without doc_id comes after all others and is no reference; rows of
    equal id do not remove each other. Repeated rows give a row each; an empty table an empty one.
    """
    pieces = find_pieces(docs, block, part)
    columns = docs.columns if texts else ["doc_id", "text"]
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), "doc_id", "text")
    rows = _keyed(given).join(pieces, ["doc_key", "check"], "left").select("row", "pieces")
    words = {"n_words": pa.int64(), "n_removed": pa.int64()}

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, n_removed, out = [], [], []
            row = b.column("row")
            for text, found in zip(row.field("text").to_pylist(), b.column("pieces").to_pylist()):
                w = (text or "").encode("utf-8", "replace").split()
                gone = int(0)
                kept = w
                if found:
                    mask = covered(len(w), found)
                    gone = int(mask.sum())
                    kept = [w[i] for i in np.flatnonzero(~mask).tolist()]
                n_words.append(len(w))
                n_removed.append(gone)
                if texts:
                    out.append(b" ".join(kept).decode("utf-8", "replace") if gone else text)
                else:
                    out.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            counts = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
            if texts:
                kinds = [pa.array(out, pa.string()) if c == "text" else row.field(i) for i, c in enumerate(columns)]
                yield pa.RecordBatch.from_arrays([*kinds, *counts], [*columns, "n_words_", "n_removed_"])
            else:
                yield pa.RecordBatch.from_arrays([row.field("doc_id"), *counts, pa.array(out, pa.string())], ["doc_id", *words, "kept_sha256"])

    if not texts:
        kind = docs.schema["doc_id"].dataType.simpleString()
        return rows.mapInArrow(removed, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    done = rows.mapInArrow(removed, f"{schema}, n_words_ long, n_removed_ long")
    return done.withColumnsRenamed({"n_words_": free_name(docs, "n_words"), "n_removed_": free_name(docs, "n_removed")})
