"""Byte-level BPE by longest matches and backtracking, and its inverse.

Bytes are written as the characters 0 to 255, so one automaton over strings finds
every token in a piece of text in one run. Encoding goes from left to right: it
takes the longest token at each place that is compatible with the token before
it, and steps back to a shorter one where none is. Two tokens are compatible if
merging the bytes of both by rank yields just these two; this is remembered per
pair. A sequence in which all neighbours are compatible is the one that merging by
rank gives, and no place is tried again once it is known to lead nowhere, so the
work is linear in the length of a piece, however long.

A short piece takes its longest matches in one run of the automaton as long as they are
compatible, which is often its end; from there on, matches are looked up where they are needed.

Each match of the pattern is encoded on its own, and one that is itself a token
stays whole. Pieces repeat more than texts do, so the short ones that were met last are remembered.
A very long text is taken apart into parts of whole segments first: ``segment`` must cover the text
without cutting a match, as the default does for patterns that never pass from a character that is
not white space to one that is. Null texts count as empty. Repeated rows and null doc_ids keep their
rows; an empty table gives an empty result; further columns are left alone.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
import sys
from array import array
from collections.abc import Callable, Iterator
from itertools import chain, islice

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from cabrank.llm.common import text_of
from cabrank.llm.token_counts import SEGMENT

#: Bytes whose matches are looked up at a time.
WINDOW = 4096
#: Long pieces of the part at hand, short pieces and pairs of tokens that a worker remembers at most; together about 100 MB.
REMEMBERED_SEGMENTS = 100_000
REMEMBERED_PIECES = 250_000
REMEMBERED_PAIRS = 200_000
#: Tokens and documents in a batch of results, about.
TOKENS_OUT, ROWS_OUT = 1 << 19, 2_000
#: Characters, and bytes, of a piece that is short, and characters of a part of a text, about.
SHORT, PART = 64, 1 << 20
NEVER = sys.maxsize


def merge(data: bytes, ranks: dict[bytes, int], until: int = 1) -> list[bytes]:
    """Merging by rank as it is defined, for the few bytes of a token; stops at ``until`` pieces."""
    pieces = [data[i : i + 1] for i in range(len(data))]
    while len(pieces) > until:
        rank, at = min((ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(pieces, pieces[1:])))
        if rank == NEVER:
            break
        pieces[at : at + 2] = [pieces[at] + pieces[at + 1]]
    return pieces


def trim(remembered: dict, most: int) -> None:
    """Forgets the older half of what is remembered once it is too much."""
    if len(remembered) >= most:
        for key in list(islice(remembered, len(remembered) // 2)):
            del remembered[key]


class Remembered(dict):
    """What ``find`` gives for pieces; of the short ones, those that were asked for last are remembered."""

    def __init__(self, find: Callable[[str], tuple[int, ...]]):
        self.find, self.before = find, {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        found = self.before.get(piece)
        if found is None:
            found = self.find(piece)
        if len(piece) <= SHORT:
            if len(self) >= REMEMBERED_PIECES // 2:
                self.before = dict(self)
                super().clear()
            self[piece] = found
        return found

    def clear(self) -> None:
        super().clear()
        self.before = {}


class Codec:
    """Encoder and decoder of one vocabulary; made once per worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, segment: str | None = None):
        self.ranks = ranks
        self.tokens = {i: token for token, i in ranks.items()}
        self.lengths = {i: len(token) for token, i in ranks.items()}
        self.longest = max(self.lengths.values())
        self.split = regex.compile(pattern).findall
        self.matcher = ahocorasick.Automaton()
        for token, i in ranks.items():
            self.matcher.add_word(token.decode("latin-1"), (len(token) - 1, i))
        self.matcher.make_automaton()
        self.edges = functools.lru_cache(len(ranks))(self._edges)
        self.shorter = functools.lru_cache(len(ranks))(self._shorter)
        self.segment = re.compile(segment).finditer if segment else None
        self.paths: dict[str, int] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pieces = Remembered(self._piece)
        self.segments: dict[str, tuple[int, ...]] = {}

    def _edges(self, token: int) -> tuple[list, list] | None:
        """What stands at the left and at the right end of a token while it is merged, each with the rank that ends it.

        None for a token that merging never produces; it can only stand for a whole piece.
        """
        data = self.tokens[token]
        halves = merge(data, self.ranks, 2)
        if len(halves) == 1:
            return [(data, NEVER)], [(data, NEVER)]
        if len(halves) != 2 or halves[0] + halves[1] not in self.ranks:
            return None
        first, last = self.edges(self.ranks[halves[0]]), self.edges(self.ranks[halves[1]])
        if first is None or last is None:
            return None
        ended = lambda edge: [*edge[:-1], (edge[-1][0], token), (data, NEVER)]
        return ended(first[0]), ended(last[1])

    def compatible(self, left: int, right: int) -> bool:
        found = self.pairs.get((left, right))
        if found is None:
            trim(self.pairs, REMEMBERED_PAIRS)
            found = self.pairs[left, right] = self._compatible(left, right)
        return found

    def _compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens never joins what meets between them.

        Two neighbours meet if each begins before the other ends; they are joined if their
        own rank comes before both ends. At equal ranks the leftmost merge comes first.
        """
        if self.edges(left) is None or self.edges(right) is None:
            return False
        begins, rank_of = -1, self.ranks.get
        for a, a_ends in self.edges(left)[1]:
            b_begins = -1
            for b, b_ends in self.edges(right)[0]:
                if b_begins > a_ends:
                    break
                if begins < b_ends:
                    rank = rank_of(a + b, NEVER)
                    if rank < a_ends and rank <= b_ends and rank != NEVER:
                        return False
                b_begins = b_ends
            begins = a_ends
        return True

    def _shorter(self, token: int) -> int | None:
        """The longest token that this one begins with, other than itself."""
        data = self.tokens[token]
        prefixes = (self.ranks.get(data[:n]) for n in range(len(data) - 1, 0, -1))
        return next((t for t in prefixes if t is not None), None)

    def _longest(self, text: str, start: int) -> list[int]:
        """The longest token at each place of a window; places behind the window may have shorter ones."""
        end = min(len(text), start + WINDOW + self.longest)
        found = [-1] * (end - start)
        # Matches come in the order of their ends, so the longest one at a place is the last.
        for last, (before, token) in self.matcher.iter(text, start, end):
            found[last - before - start] = token
        return found

    def _path(self, path: str) -> int:
        """The longest token that a path of the automaton begins with; there are no more paths than bytes in all tokens."""
        tokens = (self.ranks.get(path[:n].encode("latin-1")) for n in range(len(path), 0, -1))
        token = self.paths[path] = next(t for t in tokens if t is not None)
        return token

    def _short(self, text: str) -> list[int]:
        """The tokens of a short piece: longest matches in one run while they are compatible, then as ``backtrack`` does."""
        n, lengths, pairs, paths, prefix = len(text), self.lengths, self.pairs, self.paths, self.matcher.longest_prefix
        out: list[int] = []
        at, left = 0, None
        for _, (_, token) in self.matcher.iter_long(text):
            if left is None:
                fits = self.edges(token) is not None
            else:
                fits = pairs.get((left, token))
                if fits is None:
                    fits = self.compatible(left, token)
            if not fits:
                break
            out.append(token)
            at += lengths[token]
            left = token
        if at == n:
            return out
        dead = bytearray(n + 1)
        while True:
            path = text[at:]
            path = path[: prefix(path)]
            token = paths.get(path)
            if token is None:
                token = self._path(path)
            while True:
                end = at + lengths[token]
                if dead[end]:
                    fits = False
                elif not out:
                    fits = self.edges(token) is not None
                else:
                    fits = pairs.get((out[-1], token))
                    if fits is None:
                        fits = self.compatible(out[-1], token)
                if fits:
                    break
                token = self.shorter(token)
                while token is None:
                    dead[at] = 1
                    token = out.pop()
                    at -= lengths[token]
                    token = self.shorter(token)
            out.append(token)
            at = end
            if at == n:
                return out

    def backtrack(self, data: bytes) -> list[int]:
        """The tokens of one piece, which is not empty."""
        text, n, lengths, pairs = data.decode("latin-1"), len(data), self.lengths, self.pairs
        windows: dict[int, list[int]] = {}
        start, found = 0, self._longest(text, 0)
        dead = bytearray(n + 1)
        out: list[int] = []
        at, token = 0, found[0]
        while True:
            end = at + lengths[token]
            if dead[end]:
                fits = False
            elif not out:
                fits = self.edges(token) is not None
            else:
                fits = pairs.get((out[-1], token))
                if fits is None:
                    fits = self.compatible(out[-1], token)
            if fits:
                out.append(token)
                at = end
                if at == n:
                    return out
                if not start <= at < start + WINDOW:
                    start, found = self._window(text, at, windows)
                token = found[at - start]
                continue
            token = self.shorter(token)
            while token is None:
                dead[at] = 1
                token = out.pop()
                at -= lengths[token]
                token = self.shorter(token)
            if not start <= at < start + WINDOW:
                start, found = self._window(text, at, windows)

    def _window(self, text: str, at: int, windows: dict[int, list[int]]) -> tuple[int, list[int]]:
        """The window of a place; the last few are kept for steps back."""
        start = at - at % WINDOW
        if start not in windows:
            trim(windows, 4)
            windows[start] = self._longest(text, start)
        return start, windows[start]

    def _piece(self, piece: str) -> tuple[int, ...]:
        data = piece.encode("utf-8")
        whole = self.ranks.get(data)
        if whole is not None:
            return (whole,)
        if len(data) <= SHORT:
            return tuple(self._short(data.decode("latin-1")))
        found = self.segments.get(piece)
        if found is None:
            trim(self.segments, REMEMBERED_SEGMENTS)
            found = self.segments[piece] = tuple(self.backtrack(data))
        return found

    def parts(self, text: str) -> Iterator[str]:
        """The text in parts of bounded length, where a segment ends in time."""
        start = 0
        if self.segment and len(text) > PART:
            for segment in self.segment(text):
                if segment.end() - start >= PART:
                    yield text[start : segment.end()]
                    start = segment.end()
        yield text[start:]

    def encode(self, text: str) -> array:
        """The ids of a whole text."""
        ids = array("I")
        for part in self.parts(text):
            ids.extend(chain.from_iterable(map(self.pieces.__getitem__, self.split(part))))
            self.segments.clear()
        return ids

    def forget(self) -> None:
        """Gives back the memory of what was remembered; a worker may live on in stages that need it for other things."""
        for remembered in (self.segments, self.pieces, self.pairs):
            remembered.clear()

    def decode(self, ids: array) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def codec(path: str, pattern: str, segment: str | None = SEGMENT.pattern) -> Codec:
    """The codec of a file of ranks; a worker builds it once."""
    with open(path, "rb") as lines:
        return Codec({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}, pattern, segment)


def little(ids: array) -> bytes:
    if sys.byteorder == "big":
        ids = array("I", ids)
        ids.byteswap()
    return ids.tobytes()


class Packer:
    """Collects the results of documents and hands them on in batches of bounded size."""

    def __init__(self, with_ids: bool):
        self.with_ids = with_ids
        self.doc_ids: list[pa.Scalar] = []
        self.ids = array("I")
        self.rows: list[tuple[int, str, str]] = []

    def add(self, doc_id: pa.Scalar, ids: array, decoded: bytes) -> None:
        self.doc_ids.append(doc_id)
        self.rows.append((len(ids), hashlib.sha256(little(ids)).hexdigest(), hashlib.sha256(decoded).hexdigest()))
        if self.with_ids:
            self.ids.extend(ids)

    def full(self) -> bool:
        return len(self.ids) >= TOKENS_OUT or len(self.rows) >= ROWS_OUT

    def batch(self, kind: pa.DataType) -> pa.RecordBatch:
        """What was collected, which is then forgotten."""
        sizes, *digests = zip(*self.rows)
        columns = {"doc_id": pa.array([i.as_py() for i in self.doc_ids], kind)}
        if self.with_ids:
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            columns["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.array(self.ids, np.int32)))
        columns["n_tokens"] = pa.array(sizes, pa.int64())
        columns |= {name: pa.array(values, pa.string()) for name, values in zip(("ids_sha256", "decoded_sha256"), digests)}
        self.__init__(self.with_ids)
        return pa.RecordBatch.from_pydict(columns)


def _checked(documents: DataFrame, path: str, pattern: str, with_ids: bool) -> DataFrame:
    listed = [T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []
    found = [T.StructField("n_tokens", T.LongType()), *(T.StructField(n, T.StringType()) for n in ("ids_sha256", "decoded_sha256"))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, packer = codec(path, pattern), Packer(with_ids)
        try:
            for batch in batches:
                kind = batch.column(0).type
                for doc_id, text in zip(batch.column(0), batch.column(1)):
                    ids = own.encode(text.as_py())
                    packer.add(doc_id, ids, own.decode(ids))
                    if packer.full():
                        yield packer.batch(kind)
                if packer.rows:
                    yield packer.batch(kind)
        finally:
            own.forget()
            pa.default_memory_pool().release_unused()

    schema = T.StructType([documents.schema["doc_id"], *listed, *found])
    return documents.select("doc_id", text_of().alias("text")).mapInArrow(run, schema)


def encoded_and_checked(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: doc_id, ids, n_tokens, and digests of the ids and of the bytes they decode to."""
    return _checked(documents, path, pattern, with_ids=True)


def round_trip(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """The same without the ids, which then stay in the Python workers."""
    return _checked(documents, path, pattern, with_ids=False)


def encode(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: doc_id and ids (the tokens of the text)."""
    return encoded_and_checked(documents, path, pattern).select("doc_id", "ids")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: doc_id and text; the inverse of ``encode``. Null ids give a null text."""

    @F.pandas_udf(T.StringType())
    def texts(ids: pd.Series) -> pd.Series:
        own = codec(path, pattern)
        return pd.Series([None if i is None else own.decode(i).decode("utf-8", "replace") for i in ids], dtype=object)

    return encoded.select("doc_id", texts("ids").alias("text"))
