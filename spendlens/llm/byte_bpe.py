"""Byte-level BPE by a backtracking longest-match encoder, and streaming decode.

A sequence of tokens is what BPE gives for its bytes exactly if every two
neighbours are what BPE gives for their own bytes. So the last token decides which
tokens may come next. Which tokens a lookahead of ``LOOK`` bytes (``FAR`` where longer
tokens start so) allows, and which of them can follow another, is worked out from the
merges when it first comes up and kept; nothing is determinised, and tokens come out
at the end of a word only. At most one path leads to any position of a word.
The longest token that may follow is taken; where a path ends without going on,
that position is closed for good and the next shorter token is tried, so each
position is left once and the work follows the length of the word. Each distinct
word is read once per worker process as long as it stays in the word table.

Decoding maps ids to bytes in chunks and feeds them to an incremental UTF-8
decoder, so a character split over tokens or chunks comes out whole.

Null texts are empty and give no tokens; repeated rows get a row each; an empty
table gives no rows; other columns are not looked at. The tables of words,
arcs and pairs are emptied when they reach a bound, which changes no result.
"""

from __future__ import annotations

import base64
import codecs
import gc
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_slices, table, text_of

RANKS = "byte_bpe_50k.tiktoken"
# Workers are used again by other stages, which share an executor's memory with these tables.
MAX_WORDS = 300_000
MAX_ARCS = 200_000
CHUNK = 4096
LOOK = 6
FAR = 14
NEVER = 1 << 60


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


class Transducer:
    """Bytes in, token ids out."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.starts = {token[:n] for token in ranks for n in (LOOK, FAR) if n < len(token)}
        self.edges: tuple[dict[int, list], dict[int, list]] = ({}, {})
        self.arcs: dict[bytes, tuple[tuple[int, int], ...]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    def merge(self, word: bytes, until: int = 1) -> list[bytes]:
        """Plain BPE: join the neighbours of lowest rank, leftmost first."""
        rank = self.ranks.get
        parts = [word[i:i + 1] for i in range(len(word))]
        while len(parts) > until:
            costs = [rank(a + b, NEVER) for a, b in zip(parts, parts[1:])]
            best = min(costs)
            if best == NEVER:
                break
            at = costs.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _edge(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """The parts that lie at an edge of the token (0 left, 1 right) while it is
        built, from a byte up to itself, each with the rank of the merge that ends it."""
        known = self.edges[side].get(token)
        if known is None:
            word = self.bytes_of[token]
            if len(word) == 1:
                known = [(word, NEVER)]
            else:
                part = self.merge(word, 2)[side]
                known = self._edge(self.ranks[part], side)[:-1] + [(part, token), (word, NEVER)]
            self.edges[side][token] = known
        return known

    def follows(self, left: int, right: int) -> bool:
        """Whether BPE leaves the two tokens side by side: no merge over their border
        comes before the merges that build them."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= MAX_WORDS:
                self.pairs.clear()
            rank, lefts, rights = self.ranks.get, self._edge(left, 1), self._edge(right, 0)
            i = j = 0
            while True:
                (a, ends_a), (b, ends_b) = lefts[i], rights[j]
                across = rank(a + b, NEVER)
                # Of equal merges the leftmost comes first.
                if across < ends_a and across <= ends_b:
                    known = False
                    break
                if ends_a == ends_b == NEVER:
                    known = True
                    break
                if ends_a <= ends_b:
                    i += 1
                else:
                    j += 1
            self.pairs[left, right] = known
        return known

    def _compile(self, window: bytes) -> tuple[tuple[int, int], ...]:
        """The tokens that the window starts with, longest first, with their sizes."""
        found = tuple((size, self.ranks[window[:size]]) for size in range(len(window), 0, -1)
                      if window[:size] in self.ranks)
        if len(window) <= FAR:
            if len(self.arcs) >= MAX_ARCS:
                self.arcs.clear()
            self.arcs[window] = found
        return found

    def encode(self, word: bytes) -> list[int]:
        arcs, pairs, starts = self.arcs, self.pairs, self.starts
        end, at, last, skip = len(word), 0, -1, 0
        path: list[int] = []
        taken: list[tuple[int, int]] = []  # per token: its size, and its place among the arcs
        closed: set[int] = set()
        while at < end:
            window = word[at:at + LOOK]
            if window in starts:  # longer tokens are possible
                window = word[at:at + FAR]
                if window in starts:
                    window = word[at:at + self.longest]
            choices = arcs.get(window) or self._compile(window)
            for place in range(skip, len(choices)):
                size, token = choices[place]
                if at + size in closed:
                    continue
                if last < 0 or (fits := pairs.get((last, token))) or fits is None and self.follows(last, token):
                    path.append(token)
                    taken.append((size, place))
                    at, last, skip = at + size, token, 0
                    break
            else:
                closed.add(at)
                path.pop()
                size, place = taken.pop()
                at, last, skip = at - size, path[-1] if path else -1, place + 1
        return path


class Words(dict):
    """Token ids of a word as text, each id with a space before it."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer

    def __missing__(self, word: str) -> str:
        if len(self) >= MAX_WORDS:
            self.clear()
        found = "".join(f" {i}" for i in self.transducer.encode(word.encode("utf-8", "surrogatepass")))
        if len(word) <= 256:
            self[word] = found
        return found


@lru_cache(maxsize=2)
def _codec(path: str, pattern: str):
    import regex
    ranks = read_ranks(path)
    return regex.compile(pattern).findall, Words(Transducer(ranks)), {str(r): t for t, r in ranks.items()}


def decode_stream(ids: Iterable[str], bytes_of: dict[str, bytes], digest=None) -> Iterator[str]:
    """Text pieces of a stream of ids; an incremental UTF-8 state machine holds
    back what a chunk leaves unfinished. ``digest`` is fed the decoded bytes."""
    machine = codecs.getincrementaldecoder("utf-8")("replace")
    ids = list(ids)
    for start in range(0, len(ids), CHUNK):
        chunk = b"".join(map(bytes_of.__getitem__, ids[start:start + CHUNK]))
        if digest is not None:
            digest.update(chunk)
        yield machine.decode(chunk)
    yield machine.decode(b"", final=True)


OUTPUTS = {
    "n_tokens": ("long", pa.int64()),
    "ids": ("array<int>", pa.list_(pa.int32())),
    "ids_sha256": ("string", pa.string()),
    "decoded": ("string", pa.string()),
    "decoded_sha256": ("string", pa.string()),
    "round_trip": ("boolean", pa.bool_()),
}


def _row(text: str, findall, words: Words, bytes_of: dict[str, bytes], wanted: list[str]) -> list:
    joined = "".join(map(words.__getitem__, findall(text)))
    ids = joined.split()
    got: dict[str, object] = {"n_tokens": len(ids)}
    if "ids" in wanted:
        got["ids"] = list(map(int, ids))
    if "ids_sha256" in wanted:
        got["ids_sha256"] = hashlib.sha256(joined[1:].encode()).hexdigest()
    if {"decoded", "decoded_sha256", "round_trip"} & set(wanted):
        digest = hashlib.sha256()
        decoded = "".join(decode_stream(ids, bytes_of, digest))
        got |= {"decoded": decoded, "decoded_sha256": digest.hexdigest(), "round_trip": decoded == text}
    return [got[name] for name in wanted]


def encode_decode(docs: DataFrame, outputs: list[str], ranks_path: str | None = None,
                  pattern: str = public_tokenizers.PATTERN, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Encode every text and decode the ids again: the id and the columns of
    ``OUTPUTS`` that are asked for."""
    path = ranks_path or public_tokenizers.path(RANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        findall, words, bytes_of = _codec(path, pattern)
        # The tables hold no cycles, and walking them over and over costs half the time.
        collects = gc.isenabled()
        gc.disable()

        def make(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [_row(text, findall, words, bytes_of, outputs) for text in batch.column(1).to_pylist()]
            columns = list(zip(*rows)) or [()] * len(outputs)
            return pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(values, OUTPUTS[name][1]) for name, values in zip(outputs, columns)]],
                [id_col, *outputs])

        try:
            yield from by_slices(batches, make)
        finally:
            if collects:  # the worker serves other jobs later
                gc.enable()

    kind = docs.schema[id_col].dataType.simpleString()
    schema = ", ".join([f"`{id_col}` {kind}", *[f"{name} {OUTPUTS[name][0]}" for name in outputs]])
    return docs.select(F.col(id_col), text_of(text_col).alias("text")).mapInArrow(run, schema)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the token ids and of the decoded bytes of all documents."""
    return encode_decode(table(spark, sf_dir, "documents"), ["n_tokens", "ids_sha256", "decoded_sha256", "round_trip"])
