"""Byte-level BPE encoding and decoding as a tree reduction.

The encoding of a text is an element of a monoid: halves are encoded on their own and joined by encoding a window around
the joint anew. The window grows until the tokens outside it provably keep their places:

* Pieces (matches of the split pattern). The pattern has no look-behind, so from any match boundary on the matches do not
  depend on what stands before. A match depends on no more than two characters behind its end. So the matches of the left
  half that end two characters before the joint stay, and the matches of the right half stay from the first boundary that
  the new matches of the window share with it.
* Tokens inside a piece. A token row is the encoding of its bytes exactly if each pair of neighbours is (a pair is, if
  encoding its joined bytes gives the pair again). So it is enough that the pairs at both edges of the window are.

Decoding concatenates the tokens' bytes up the tree.
"""

from __future__ import annotations

import heapq
import re
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ribolith.llm.common import with_arrow

#: Characters of a leaf of the text tree, and bytes of a leaf inside a piece.
LEAF_CHARS, LEAF_BYTES = 8192, 4
#: Entries that a worker's memo holds, twice at most.
MEMO = 100_000
_loaded: dict = {}
#: ASCII and Latin letters: texts of these alone are cut by the standard library's faster engine, where the letters and
#: digits among them stand for the two Unicode classes of a split pattern.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
PLAIN = re.compile(f"[\t-\r -~{LETTERS}]*").fullmatch


def plain_pattern(pattern: str) -> str:
    """`pattern`, with the letters and digits of plain texts in place of its classes of letters and numbers."""
    inside = lambda m: m[0].replace(r"\p{L}", LETTERS).replace(r"\p{N}", "0-9")
    bare = re.sub(r"\[[^\]]*\]", inside, pattern)
    return re.sub(r"\\p\{([LN])\}", lambda m: "[" + {"L": LETTERS, "N": "0-9"}[m[1]] + "]", bare)


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a ``.tiktoken`` file: a base64 token and its rank on each line."""
    import base64

    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Codec:
    """Encoder and decoder over the ranks of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.any_split, self.plain_split = regex.compile(pattern).findall, re.compile(plain_pattern(pattern)).findall
        self.pieces, self.halves, self.pairs = _Memo(self._piece), _Memo(self._half), _Memo(self._pair)
        self.windows = _Memo(self._merge)

    # -- inside a piece

    def _merge(self, data: bytes) -> tuple:
        """Repeatedly merges the leftmost neighbours of least rank."""
        ranks, n = self.ranks, len(data)
        if n > 48:
            return self._merge_long(data)
        cuts = list(range(n + 1))
        low = [ranks.get(data[i : i + 2], 1 << 60) for i in range(n - 1)]
        while low:
            least = min(low)
            if least == 1 << 60:
                break
            i = low.index(least)
            del cuts[i + 1], low[i]
            if i < len(low):
                low[i] = ranks.get(data[cuts[i] : cuts[i + 2]], 1 << 60)
            if i:
                low[i - 1] = ranks.get(data[cuts[i - 1] : cuts[i + 1]], 1 << 60)
        return tuple(ranks[data[a:b]] for a, b in zip(cuts, cuts[1:]))

    def _merge_long(self, data: bytes) -> tuple:
        """The same with a heap of candidate merges, for long windows."""
        ranks, n = self.ranks, len(data)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        alive = bytearray([1]) * n
        while heap:
            _, i, end = heapq.heappop(heap)
            if not alive[i] or after[i] >= n or after[after[i]] != end:
                continue
            j = after[i]
            alive[j] = 0
            after[i] = end
            if end < n:
                before[end] = i
                if (r := ranks.get(data[i : after[end]])) is not None:
                    heapq.heappush(heap, (r, i, after[end]))
            if (h := before[i]) >= 0 and (r := ranks.get(data[h:end])) is not None:
                heapq.heappush(heap, (r, h, end))
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i : after[i]]])
            i = after[i]
        return tuple(out)

    def _pair(self, pair: tuple) -> tuple:
        """The encoding of two tokens' bytes; the tokens can be neighbours if it is the pair itself."""
        return self._merge(self.bytes_of[pair[0]] + self.bytes_of[pair[1]])

    def join(self, left: tuple, right: tuple) -> tuple:
        """The encoding of the joined bytes of two encodings."""
        if not left or not right:
            return left + right
        pairs, i, j, step = self.pairs, len(left) - 1, 1, 1
        middle = pairs[left[i], right[0]]
        while True:
            left_ok = not i or pairs[p := (left[i - 1], middle[0])] == p
            right_ok = j >= len(right) or pairs[p := (middle[-1], right[j])] == p
            if left_ok and right_ok:
                return left[:i] + middle + right[j:]
            i, j, step = (i if left_ok else max(0, i - step)), (j if right_ok else min(len(right), j + step)), step * 2
            middle = self.windows[b"".join(map(self.bytes_of.__getitem__, left[i:] + right[:j]))]

    def _half(self, data: bytes) -> tuple:
        if len(data) <= LEAF_BYTES:
            return self._merge(data)
        half = len(data) // 2
        if len(data) <= 64:
            return self.join(self.halves[data[:half]], self.halves[data[half:]])
        return self.join(self._half(data[:half]), self._half(data[half:]))

    def _piece(self, piece: str) -> tuple:
        data = piece.encode("utf-8", "surrogatepass")
        rank = self.ranks.get(data)
        return self._half(data) if rank is None else (rank,)

    # -- over a text

    def split(self, text: str) -> list[str]:
        return self.plain_split(text) if PLAIN(text) else self.any_split(text)

    def join_pieces(self, left: list[str], right: list[str]) -> list[str]:
        """The pieces of the joined text of two lists of pieces."""
        keep, room = len(left), 0
        while keep and room < 2:
            keep -= 1
            room += len(left[keep])
        tail = "".join(left[keep:])
        take = 4
        while True:
            whole = take >= len(right)
            ends, at = {len(tail): 0}, len(tail)
            for k, piece in enumerate(right[:take], 1):
                at += len(piece)
                ends[at] = k
            made = self.split(tail + "".join(right[:take]))
            end = 0
            for k, piece in enumerate(made, 1):
                end += len(piece)
                if end in ends and (end + 2 <= at or whole):
                    return left[:keep] + made[:k] + right[ends[end] :]
            take *= 2

    def split_text(self, text: str) -> list[str]:
        if len(text) <= LEAF_CHARS:
            return self.split(text)
        half = len(text) // 2
        return self.join_pieces(self.split_text(text[:half]), self.split_text(text[half:]))

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.pieces.__getitem__, self.split_text(text))))

    def decode(self, ids) -> bytes:
        if len(ids) > 1 << 16:
            half = len(ids) // 2
            return self.decode(ids[:half]) + self.decode(ids[half:])
        return b"".join(map(self.bytes_of.__getitem__, ids))


class _Memo(dict):
    """Values of a function by argument. Of more than `size` the older half is forgotten, so memory is bounded."""

    def __init__(self, fn, size: int = MEMO):
        super().__init__()
        self.fn, self.size, self.older = fn, size, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.fn(key)
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        if len(key) <= 64:
            self[key] = value
        return value


def codec(path: str, pattern: str) -> Codec:
    """The worker's codec for a rank file; the file is read once in a worker."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = Codec(read_ranks(path), pattern)
    return _loaded[path, pattern]


def _lists(rows: list[list[int]]):
    """An Arrow list column of the rows."""
    import numpy as np
    import pyarrow as pa

    ends = np.cumsum([0, *map(len, rows)]).astype("int32")
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.fromiter(chain.from_iterable(rows), "int32", int(ends[-1]))))


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "token_ids", keep_text: bool = True) -> DataFrame:
    """`df` with the token ids (array<int>) of the whole `text`. A null or empty text has no tokens."""

    def run(column):
        own = codec(path, pattern)
        return _lists([[] if x is None else own.encode(x) for x in column.to_pylist()])

    return with_arrow(df, text, ids, T.ArrayType(T.IntegerType()), run, keep_text)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """`df` with the bytes (binary) that the ids stand for. Null ids give no bytes."""

    def run(column):
        import pyarrow as pa

        own = codec(path, pattern)
        return pa.array([own.decode(x or []) for x in column.to_pylist()], pa.binary())

    return with_arrow(df, ids, out, T.BinaryType(), run)


def round_trip(df: DataFrame, path: str, pattern: str, text: str = "text", keep_text: bool = True) -> DataFrame:
    """`df` with token_ids and the bytes `decoded` from them, in one pass and thus one Python worker for a task."""
    kind = T.StructType([T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())])

    def run(column):
        import pyarrow as pa

        own = codec(path, pattern)
        rows = [[] if x is None else own.encode(x) for x in column.to_pylist()]
        return pa.StructArray.from_arrays([_lists(rows), pa.array(map(own.decode, rows), pa.binary())], names=["token_ids", "decoded"])

    coded = with_arrow(df, text, "__coded", kind, run, keep_text)
    others = [c for c in coded.columns if c not in ("__coded", "token_ids", "decoded")]
    return coded.select(*others, "__coded.token_ids", "__coded.decoded")


def digests(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256 of the ids in decimal, decoded_sha256 of the decoded bytes."""
    return _digests(round_trip(df.select("doc_id", "text"), path, pattern, keep_text=False), ["doc_id"])


def encoded(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """The columns of `df`, the token ids and their digests; columns of these names are replaced."""
    made = ("token_ids", "decoded", "n_tokens", "ids_sha256", "decoded_sha256")
    return _digests(round_trip(df, path, pattern), [*(c for c in df.columns if c not in made), "token_ids"])


def _digests(coded: DataFrame, keep: list[str]) -> DataFrame:
    return coded.select(
        *keep,
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
