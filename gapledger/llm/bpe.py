"""BPE encoding and decoding by tree concatenation.

The ids of a text depend on its words only: white space ends a word for this tokenizer, so
a text is encoded word by word, and words are remembered. A long text is cut into pieces
that separate tasks encode; where a piece had to be cut inside an unsplit run, the joins are
mended afterwards: a window around the join is encoded anew and grows until its ids agree
with what both sides have there. BPE is local (a sequence of tokens is an encoding
if every two neighbours are), so agreement of a token on either side makes the result exact.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from unicodedata import category

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapledger.llm.frames import MEMORY, WordMemory

#: Characters beyond which a text is encoded in pieces by several tasks.
PIECE = 65_536
#: An unsplit run longer than this is encoded as a tree of leaves.
LEAF = 4_096
#: Neighbouring tokens on which a window has to agree with each side.
AGREE = 4
#: First window, in characters on either side of a join. Longer than any special token.
WINDOW = 64
#: ASCII and Latin letters and signs for which lower case and normal form are plain.
_PLAIN = re.compile("[!-~¡-¬®-įı-ňŊ-ſ]*")
#: The same with ASCII white space, which ends words.
_PLAIN_TEXT = re.compile("[\\x20\\x09-\\x0D!-~¡-¬®-įı-ňŊ-ſ]*")


def _plain_rule() -> re.Pattern:
    """The rule that cuts plain lower-case texts into parts, in terms of the built-in module."""
    chars = [chr(c) for c in range(33, 0x180)]
    letters = "".join(c for c in chars if category(c)[0] == "L")
    numbers = "".join(c for c in chars if category(c)[0] == "N")
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^\s{letters}{numbers}]+")


def _byte_letters() -> dict[int, str]:
    """The visible letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Codec:
    """Encodes and decodes with one tokenizer file; one instance per Python worker."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.plain_rule = _plain_rule()
        self.rule = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.marks, self.mark_texts = tuple(t.encode() for t in added), tuple(added)
        self.long_run = re.compile(rf"[^\x20\x09-\x0D]{{{LEAF + 1}}}")
        self.parts = WordMemory(self._part, 2 * MEMORY)
        self.words = WordMemory(self._word)
        self.shown = WordMemory(self._show)

    def _part(self, part: str) -> bytes:
        text = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.model.tokenize(text)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: bytes) -> bytes:
        """Ids of a run without ASCII white space."""
        text = word.decode()
        if len(text) > LEAF:
            return self.encode_run(text)[0].astype("<u4").tobytes()
        if _PLAIN.fullmatch(text) and not any(m in word for m in self.marks):
            return b"".join(map(self.parts.__getitem__, self.rule.findall(text.lower())))
        return np.array(self._offsets(text)[0], "<u4").tobytes()

    def _offsets(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the tokenizers library itself, with the characters where tokens start and end."""
        e = self.tokenizer.encode(text, add_special_tokens=False)
        spans = np.array(e.offsets, np.int64).reshape(-1, 2)
        return np.array(e.ids, np.int64), spans[:, 0], spans[:, 1]

    def _pieces(self, text: str) -> Iterator[bytes]:
        """Ids of the parts or words of a text, in order.

        A plain text without long runs is cut into parts at once; the parts of its words are the same.
        """
        if _PLAIN_TEXT.fullmatch(text) and not any(m in text for m in self.mark_texts) and not self.long_run.search(text):
            return map(self.parts.__getitem__, self.plain_rule.findall(text.lower()))
        return map(self.words.__getitem__, text.encode("utf-8", "replace").split())

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        return b"".join(self._pieces(text))

    def encode_run(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tree concatenation over leaves of one long unsplit run."""
        if len(text) <= LEAF:
            return self._offsets(text)
        half = len(text) // 2
        left, right = text[:half], text[half:]
        return self.join(left, self.encode_run(left), right, self.encode_run(right))

    def join(self, left: str, a, right: str, b) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Encoding of ``left + right`` from the encodings of both.

        The window starts at a token of ``left`` and ends anywhere in ``right``. Its first
        ``AGREE`` tokens have to be those of ``left``; then the first ``AGREE`` tokens in a
        row that ``right`` has at the same characters end the search. A window that
        reaches over both sides is the encoding.
        """
        (ai, as_, ae), (bi, bs, be) = a, b
        bs, be, cut = bs + len(left), be + len(left), len(left)
        width = WINDOW
        while True:
            # tokens of one character share its place: a clean start is after every earlier end
            clean = np.flatnonzero((as_ <= cut - width) & (as_ >= np.r_[0, ae[:-1]]))
            i = int(clean[-1]) if len(clean) else 0
            start = int(as_[i]) if len(clean) else 0
            stop = min(len(right), width)
            wi, ws, we = self._offsets(left[start:] + right[:stop])
            ws, we = ws + start, we + start
            whole_left, whole_right = not len(clean), stop == len(right)
            agrees = whole_left or (
                i + AGREE <= len(ai) and len(wi) >= AGREE
                and np.array_equal(wi[:AGREE], ai[i : i + AGREE])
                and np.array_equal(we[:AGREE], ae[i : i + AGREE])
            )
            if agrees:
                ends = None
                if whole_right:
                    ends = (len(wi), len(bi))
                else:
                    at = {int(s): k for k, s in reversed(list(enumerate(bs))) if s < cut + stop}
                    for j in range(len(wi) - 2 * AGREE):
                        k = at.get(int(ws[j])) if ws[j] >= cut else None
                        if (
                            k is not None and (j == 0 or ws[j] >= we[j - 1])
                            and (k == 0 or bs[k] >= be[k - 1])
                            and np.array_equal(wi[j : j + AGREE], bi[k : k + AGREE])
                            and np.array_equal(we[j : j + AGREE], be[k : k + AGREE])
                        ):
                            ends = (j, k)
                            break
                if ends:
                    j, k = ends
                    keep = 0 if whole_left else i
                    return tuple(
                        np.concatenate([x[:keep], w[:j], y[k:]])
                        for x, w, y in ((ai, wi, bi), (as_, ws, bs), (ae, we, be))
                    )
            width *= 2

    def _show(self, id_bytes: bytes) -> bytes:
        """The decoded text of one word's ids, in UTF-8."""
        ids = np.frombuffer(id_bytes, "<u4").tolist()
        return self.tokenizer.decode(ids, skip_special_tokens=False).encode()

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids and of the decoded text."""
        ids = list(filter(None, self._pieces(text)))
        joined = b"".join(ids)
        # this tokenizer decodes to its tokens with a space between them, so words and their parts can be decoded apart
        shown = b" ".join(map(self.shown.__getitem__, ids))
        return len(joined) // 4, hashlib.sha256(joined).hexdigest(), hashlib.sha256(shown).hexdigest()


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def cut(text: str, size: int) -> list[tuple[str, bool]]:
    """Halves a text until no piece is longer than ``size``; (piece, cut inside a run before it).

    A cut is made at the white space nearest to the middle if half a piece's reach has any.
    """
    if len(text) <= size:
        return [(text, False)]
    middle, reach = len(text) // 2, size // 4
    found = [m.start() for m in re.finditer(r"[\x20\x09-\x0D]", text[middle - reach : middle + reach])]
    at = middle - reach + min(found, key=lambda i: abs(i - reach)) if found else middle
    left, right = cut(text[:at], size), cut(text[at:], size)
    return left + [(right[0][0], not found), *right[1:]]


def encode_documents(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", piece: int = PIECE
) -> DataFrame:
    """Number of ids and digests of ids and decoded text for every row of ``docs``.

    Returns id_column, n_tokens long, ids_sha256, decoded_sha256. Null texts count as
    empty; null ids and repeated rows give a row each; other columns are not read.
    """
    key = F.col(f"`{id_column}`").alias("id")
    rows = docs.select(key, F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            done = [c.digests(t) for t in b.column("text").to_pylist()]
            n, ids, shown = zip(*done) if done else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(shown, pa.string())],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for row, text in zip(f.row, f.text):
                made = cut(text, piece)
                yield pd.DataFrame({
                    "row": row, "n": np.arange(len(made), dtype=np.int32),
                    "text": [t for t, _ in made], "ragged": [r for _, r in made],
                    "open": [r for _, r in made[1:]] + [False],
                })

    def encoded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(path)
        for f in frames:
            ids, spans, texts = [], [], []
            for text, ragged, open_ in zip(f.text, f.ragged, f.open):
                if ragged or open_:
                    i, s, e = c.encode_run(text)
                    ids.append(i.astype("<u4").tobytes())
                    spans.append(np.concatenate([s, e]).astype("<i8").tobytes())
                    texts.append(text)
                else:
                    ids.append(c.encode(text))
                    spans.append(b"")
                    texts.append("")
            yield pd.DataFrame({"row": f.row, "n": f.n, "ragged": f.ragged, "text": texts, "ids": ids, "spans": spans})

    def joined(pdf: pd.DataFrame) -> pd.DataFrame:
        c = codec(path)
        pdf = pdf.sort_values("n")
        done, run = [], []
        for text, ragged, ids, spans in zip(pdf.text, pdf.ragged, pdf.ids, pdf.spans):
            if run and not ragged:
                done.append(_tree(c, run))
                run = []
            if spans:
                both = np.frombuffer(spans, "<i8")
                half = len(both) // 2
                run.append((text, (np.frombuffer(ids, "<u4").astype(np.int64), both[:half], both[half:])))
            else:
                done.append(ids)
        if run:
            done.append(_tree(c, run))
        joined_ids = b"".join(done)
        shown = c._show(joined_ids) if joined_ids else b""
        return pd.DataFrame({
            "row": [pdf.row.iloc[0]], "n_tokens": [len(joined_ids) // 4],
            "ids_sha256": [hashlib.sha256(joined_ids).hexdigest()],
            "decoded_sha256": [hashlib.sha256(shown).hexdigest()],
        })

    size = F.char_length("text")
    near = rows.filter(size <= piece).mapInArrow(short, out)
    # Equal rows give equal results: long texts are keyed by a digest and counted back in.
    long = rows.filter(size > piece).select("id", "text", F.sha2("text", 256).alias("row"))
    cuts = long.select("row", "text").mapInPandas(pieces, "row string, n int, text string, ragged boolean, open boolean")
    spread = cuts.repartition(F.col("row"), F.col("n"))
    done = (
        spread.mapInPandas(encoded, "row string, n int, ragged boolean, text string, ids binary, spans binary")
        .dropDuplicates(["row", "n"])
        .groupBy("row")
        .applyInPandas(joined, "row string, n_tokens long, ids_sha256 string, decoded_sha256 string")
    )
    far = long.select("id", "row").join(done, "row").select("id", "n_tokens", "ids_sha256", "decoded_sha256")
    return near.unionByName(far).withColumnRenamed("id", id_column)


def _tree(c: Codec, run: list) -> bytes:
    """Joins neighbouring pieces pairwise until one is left."""
    while len(run) > 1:
        pairs = [run[i : i + 2] for i in range(0, len(run), 2)]
        run = [p[0] if len(p) == 1 else (p[0][0] + p[1][0], c.join(*p[0], *p[1])) for p in pairs]
    return run[0][1][0].astype("<u4").tobytes()


__all__ = ["Codec", "codec", "cut", "encode_documents"]
