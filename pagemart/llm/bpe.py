"""Byte-level BPE encoding and decoding by dynamic programming over prefixes.

For each byte prefix of a piece exactly one token can end its encoding. That
token is stored per prefix; the encoding is read off backwards from the end. The
tokens that could end a prefix are found by an automaton of all tokens.
A token fits behind the last token of a shorter prefix if merging the two
tokens' bytes afresh gives those two tokens again. Because a prefix's entry
depends only on the bytes before it, bytes can be appended exactly, and after an
edit only the entries near it are computed again.

Cases: null text is encoded as the empty text; empty text gives no tokens; texts
of any length are encoded whole; repeated rows are encoded each; an input column
that has the name of an output column is replaced by it.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bounds of the per-process memories; they hold results that can be computed again.
MAX_PIECES, MAX_PAIRS = 150_000, 250_000


def merge_bytes(data: bytes, ranks: dict[bytes, int], until: int = 1) -> list[int]:
    """Merges by lowest rank, leftmost first, until so many parts are left: the
    definition, for short inputs.
    """
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > until:
        best, at = None, -1
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1])
            if rank is not None and (best is None or rank < best):
                best, at = rank, i
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


class Vocabulary:
    """Ranks of a tiktoken file, and which token may follow which."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split = ranks, regex.compile(pattern).findall
        self.pattern = regex.compile(pattern)
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.text_of = [str(i) for i in range(len(self.bytes_of))]
        self.longest = max(map(len, ranks), default=1)
        #: Finds the tokens that end at each place, the longest first; bytes are written as characters.
        self._ending = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self._ending.add_word(token.decode("latin-1"), (rank, len(token)))
        self._ending.make_automaton()
        self._pairs: dict[int, bool] = {}
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._pieces: dict[str, list[int]] = {}
        self._older: dict[str, list[int]] = {}

    @classmethod
    def load(cls, path: str, pattern: str) -> Vocabulary:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, pattern)

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for one byte."""
        if token not in self._halves:
            data = self.bytes_of[token]
            self._halves[token] = tuple(merge_bytes(data, self.ranks, 2)) if len(data) > 1 else None
        return self._halves[token]

    def fits(self, left: int, right: int) -> bool:
        """Whether right may follow left in an encoding; left -1 is the start.

        While left's bytes merge to left and right's to right, one token of each
        touches the border at a time. The two tokens fit unless such a pair would
        merge before either is merged into a larger token of its own side (at
        equal rank the merge further left comes first). Going back from the
        finished tokens, the one of higher rank was made later.
        """
        if left < 0:
            return merge_bytes(self.bytes_of[right], self.ranks) == [right]
        ranks, bytes_of, a, b = self.ranks, self.bytes_of, left, right
        into_a = into_b = len(bytes_of)
        while True:
            across = ranks.get(bytes_of[a] + bytes_of[b])
            if across is not None and across < into_a and across <= into_b:
                return False
            of_a, of_b = self.halves(a), self.halves(b)
            if of_a and (a > b or not of_b):
                into_a, a = a, of_a[1]
            elif of_b:
                into_b, b = b, of_b[0]
            else:
                return True

    def extend(self, data: bytes, last: list[int]) -> None:
        """Adds the entries of data's prefixes that last does not have yet.

        last[i] is the last token of the encoding of data[:i]; last[0] is -1.
        """
        pairs, fits, done = self._pairs, self.fits, len(last) - 1
        first = max(0, done + 1 - self.longest)  # no token that ends behind done begins before it
        for end, (token, size) in self._ending.iter(data[first:].decode("latin-1")) if self.ranks and data else ():
            end += first + 1
            if end <= done:
                continue
            if end > done + 1:
                break
            before = last[end - size]
            pair = before << 24 | token
            known = pairs.get(pair)
            if known is None:
                if len(pairs) >= MAX_PAIRS:
                    pairs.clear()
                known = pairs[pair] = fits(before, token)
            if known:
                last.append(token)
                done = end
        if done < len(data):
            raise ValueError("the vocabulary lacks a byte")

    def walk_back(self, last: list[int]) -> list[int]:
        """The tokens, from the entries of all prefixes."""
        out, at = [], len(last) - 1
        while at:
            out.append(last[at])
            at -= len(self.bytes_of[last[at]])
        return out[::-1]

    def encode_piece(self, piece: str) -> list[int]:
        """The tokens of one match of the pattern."""
        out = self._older.get(piece)
        if out is None:
            data = piece.encode()
            whole = self.ranks.get(data)
            if whole is not None:
                out = [whole]
            else:
                last = [-1]
                self.extend(data, last)
                out = self.walk_back(last)
        if len(piece) <= 64:
            if len(self._pieces) >= MAX_PIECES:
                self._older, self._pieces = self._pieces, {}
            self._pieces[piece] = out
        return out

    def encode(self, text: str) -> list[int]:
        """The tokens of a text."""
        fresh, out = self.encode_piece, []
        for piece in self.split(text):
            out += self._pieces.get(piece) or fresh(piece)
        return out

    def decode(self, ids) -> bytes:
        """The bytes of tokens."""
        return b"".join(map(self.bytes_of.__getitem__, ids))


class PrefixTable:
    """The entries of one piece; it can grow at its end and be edited."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last, self.computed = vocabulary, b"", [-1], 0
        self.append(data)

    def append(self, more: bytes) -> None:
        """Exact: the entries of the old prefixes stay as they are."""
        self.data += more
        self.computed += len(more)
        self.vocabulary.extend(self.data, self.last)

    def edit(self, start: int, stop: int, new: bytes) -> None:
        """data[start:stop] becomes new. Entries are computed until as many in a
        row as the longest token has bytes are as before; from there on all are.
        """
        old, tail = self.last, self.data[stop:]
        self.data = self.data[:start] + new + tail
        last, settled, shift = old[: start + 1], 0, len(old) - 1 - len(self.data)
        while len(last) <= len(self.data) and settled < self.vocabulary.longest:
            at = len(last)
            self.vocabulary.extend(self.data[:at], last)
            self.computed += 1
            settled = settled + 1 if at > start + len(new) and last[at] == old[at + shift] else 0
        self.last = last + old[len(last) + shift :]

    def tokens(self) -> list[int]:
        return self.vocabulary.walk_back(self.last)


class EncodedText:
    """A text with its pieces' tokens, kept up to date through appends and edits."""

    def __init__(self, vocabulary: Vocabulary, text: str = ""):
        self.vocabulary, self.text, self.pieces = vocabulary, "", []
        self.edit(0, 0, text)

    def append(self, more: str) -> None:
        self.edit(len(self.text), len(self.text), more)

    def edit(self, start: int, stop: int, new: str) -> None:
        """text[start:stop] becomes new. Pieces that end two or more characters
        before the edit stay; behind it, splitting goes on only until a piece
        starts where one started before.
        """
        ends, at = [], 0
        for piece, _ in self.pieces:
            at += len(piece)
            ends.append(at)
        keep = 0
        while keep < len(ends) and ends[keep] + 1 < start:
            keep += 1
        text = self.text[:start] + new + self.text[stop:]
        at, grown = ends[keep - 1] if keep else 0, len(text) - len(self.text)
        starts = {e + grown: i + 1 for i, e in enumerate(ends) if e >= stop}
        pieces = self.pieces[:keep]
        while at < len(text):
            if at >= start + len(new) and at in starts:
                pieces += self.pieces[starts[at] :]
                break
            piece = self.vocabulary.pattern.match(text, at).group()
            pieces.append((piece, self.vocabulary.encode_piece(piece)))
            at += len(piece)
        self.text, self.pieces = text, pieces

    def tokens(self) -> list[int]:
        return [t for _, ids in self.pieces for t in ids]


@lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    """One per process; path must be there on every node, as an installed file is."""
    return Vocabulary.load(path, pattern)


def encoded(text: Column, path: str, pattern: str) -> Column:
    """array<int> of a text's tokens."""

    @F.pandas_udf("array<int>")
    def encode_texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        v = vocabulary(path, pattern)
        for texts in batches:
            yield pd.Series([np.array(v.encode(t or ""), dtype=np.int32) for t in texts], index=texts.index)

    return encode_texts(F.coalesce(text, F.lit("")))


def decoded(ids: Column, path: str, pattern: str) -> Column:
    """The bytes (binary) of an array of tokens; null for null."""

    @F.pandas_udf("binary")
    def decode_ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        v = vocabulary(path, pattern)
        for arrays in batches:
            yield pd.Series([None if a is None else v.decode(a.tolist()) for a in arrays], index=arrays.index)

    return decode_ids(ids)


def encode(df: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """df with the tokens of each whole text in ids_col."""
    return df.withColumn(ids_col, encoded(F.col(text_col), path, pattern))


def decode(df: DataFrame, path: str, pattern: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """df with the bytes of each row's tokens in out_col."""
    return df.withColumn(out_col, decoded(F.col(ids_col), path, pattern))


def round_trip(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes each text and decodes its tokens, in one pass that keeps only digests.

    Columns: the id, n_tokens long, ids_sha256 (of the decimal ids joined by
    commas) and decoded_sha256 (of the decoded bytes), both lower-case hex. For
    checking a vocabulary against a corpus without storing the tokens.
    """

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path, pattern)
        number = v.text_of.__getitem__
        for batch in batches:
            counts, ids_hex, bytes_hex = [], [], []
            for text in batch.column(1):
                ids = v.encode(text.as_py() or "")
                counts.append(len(ids))
                ids_hex.append(hashlib.sha256(",".join(map(number, ids)).encode()).hexdigest())
                bytes_hex.append(hashlib.sha256(v.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(bytes_hex, pa.string())], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(digests, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
