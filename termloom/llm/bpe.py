"""Byte-level BPE encoding and decoding with a segment tree per piece.

A text is split by the tokenizer's pattern.  Each piece starts as single bytes; leaf ``i`` of
a segment tree holds the rank of the pair that starts at byte ``i`` and the byte position,
packed into one number, so that the root names the leftmost pair of the lowest rank.  A
merge joins two live neighbours and updates three leaves: O(log n) each, O(n log n) in all,
also for a piece of a million bytes.  A node has ``FAN`` children: their minimum is one call.

Defined cases: a null or empty text has no ids and decodes to no bytes; null ids decode to
no bytes; an unknown id is an error.  Special tokens are ordinary text.  Repeated rows each
get a row; other columns pass through.  Texts of any length are encoded whole; a lone surrogate
cannot occur in a Spark string.
"""

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Children of a node of the segment tree, and a rank that no pair has.
FAN = 16
NEVER = 1 << 40
# Pieces remembered per worker and generation; results do not depend on it.
CACHE_PIECES = 300_000
CACHED_BYTES = 64
# Rows coded at a time, so that lists of ids are held for a part of an Arrow batch only.
SLICE = 200


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    """The rank of each token, from lines of base64 token and rank."""
    with open(path, "rb") as file:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in file if line.strip())}


@lru_cache(maxsize=4)
def load_tokens(path: str) -> dict[int, bytes]:
    return {rank: token for token, rank in load_ranks(path).items()}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: lowest rank first, leftmost on a tie."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    symbols = [piece[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    get = ranks.get
    leaves = [get(piece[i : i + 2], NEVER) * n + i for i in range(n - 1)]
    leaves.append(NEVER * n)
    levels = [leaves]
    while len(levels[-1]) > FAN:
        lower = levels[-1]
        levels.append([min(lower[k : k + FAN]) for k in range(0, len(lower), FAN)])
    top, upper, none = levels[-1], levels[1:], NEVER * n
    while (least := min(top)) < none:
        i = least % n
        j = after[i]
        merged = symbols[i] = symbols[i] + symbols[j]
        symbols[j] = b""
        after[i] = k = after[j]
        leaves[j] = none
        if k < n:
            before[k] = i
            leaves[i] = get(merged + symbols[k], NEVER) * n + i
        else:
            leaves[i] = none
        h = before[i]
        if h >= 0:
            leaves[h] = get(symbols[h] + merged, NEVER) * n + h
        if upper:
            for at in (i, j, h) if h >= 0 else (i, j):
                lower = leaves
                for level in upper:
                    at //= FAN
                    found = min(lower[at * FAN : at * FAN + FAN])
                    if level[at] == found:
                        break
                    level[at] = found
                    lower = level
    return [ranks[x] for x in symbols if x]


class Encoder:
    """Remembers pieces in two generations: a full young one becomes the old one."""

    def __init__(self, path: str, pattern: str):
        self.ranks, self.find = load_ranks(path), regex.compile(pattern).findall
        self.young: dict[str, list[int]] = {}
        self.old: dict[str, list[int]] = {}

    def _new(self, piece: str) -> list[int]:
        found = self.old.get(piece)
        if found is None:
            found = merge_piece(piece.encode(), self.ranks)
        if len(piece) <= CACHED_BYTES:
            if len(self.young) >= CACHE_PIECES:
                self.old, self.young = self.young, {}
            self.young[piece] = found
        return found

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        young = self.young
        for piece in self.find(text):
            found = young.get(piece)
            if found is None:
                found = self._new(piece)
                young = self.young
            ids += found
        return ids


def decode_ids(ids, tokens: dict[int, bytes]) -> bytes:
    return b"" if ids is None else b"".join([tokens[i] for i in ids])


def encode(
    df: DataFrame,
    path: str,
    pattern: str,
    text_column: str = "text",
    out: str = "ids",
    decoded: str | None = None,
) -> DataFrame:
    """``df`` with the ids of each whole text, ``array<int>``, in place of the text.

    ``decoded`` names a further column for the bytes decoded from those ids.
    """
    kept = [f for f in df.schema.fields if f.name not in {text_column, out, decoded}]
    made = [T.StructField(out, T.ArrayType(T.IntegerType()))]
    made += [T.StructField(decoded, T.BinaryType())] if decoded else []

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, tokens = Encoder(path, pattern), load_tokens(path) if decoded else {}
        for part in _slices(batches):
            ids = [encoder.encode(t) if isinstance(t, str) else [] for t in part[text_column]]
            found = part[[f.name for f in kept]].assign(**{out: pd.Series(ids, part.index, object)})
            if decoded:
                back = [decode_ids(i, tokens) for i in ids]
                found[decoded] = pd.Series(back, part.index, object)
            yield found

    return df.mapInPandas(run, T.StructType([*kept, *made]))


def _slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for start in range(0, len(batch), SLICE):
            yield batch.iloc[start : start + SLICE]


def decode(df: DataFrame, path: str, ids_column: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the bytes that the ids stand for."""
    kept = [f for f in df.schema.fields if f.name != out]
    schema = T.StructType([*kept, T.StructField(out, T.BinaryType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = load_tokens(path)
        for part in _slices(batches):
            made = [decode_ids(i, tokens) for i in part[ids_column]]
            yield part[[f.name for f in kept]].assign(**{out: pd.Series(made, part.index, object)})

    return df.mapInPandas(run, schema)
