"""Byte-level BPE as a monoid over byte strings.

A piece (one match of the pre-tokenizer's pattern) is encoded as a tree: the two
halves are encoded on their own, then joined. A join re-encodes a window around the
boundary, one token from each side at first; a side is doubled until the pair at its
edge is stable. A pair (a, b) is stable if the bytes of a followed by those of b
encode to exactly [a, b]. A token sequence whose neighbours are all stable is the
encoding of its bytes, so tokens outside the window are then proven final; the pairs
inside the halves are stable because the halves are encodings.

Pieces themselves are joined without re-encoding, as the pattern keeps them apart.
Decoding concatenates token bytes up the same tree.

Null and empty texts have no ids. Equal texts and repeated rows have equal ids. A very long
text or piece (a line of 100,000 equal characters) is encoded whole, in time in proportion
to its length times its logarithm at worst. Empty tables give no rows. Other columns pass
through ``encode`` and ``decode`` unchanged; a column with the name of the result is replaced.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from loamworks.llm.common import whole, wider

#: Bytes up to which a piece is encoded directly; such leaves and join windows are remembered by their bytes.
LEAF = 8
#: Pieces that a worker keeps; then it starts anew.
KEPT = 250_000
#: Longest leaf or window that is remembered.
KEPT_BYTES = 24
NO_RANK = 1 << 60


#: Characters that ``re`` and ``regex`` put in the same classes.
SAME = frozenset(
    c
    for c in map(chr, [9, 10, 13, *range(32, 127), *range(161, 0x2000)])
    if (unicodedata.category(c)[0] == "L") == bool(re.match(r"[^\W\d_]", c)) and (unicodedata.category(c)[0] == "N") == bool(re.match(r"\d", c)) and bool(regex.match(r"\s", c)) == c.isspace()
)


def splitter(pattern: str):
    """All matches of ``pattern``; texts of common characters go to the faster ``re`` with the same classes."""
    slow = regex.compile(pattern).findall
    if not pattern:
        return slow
    # among SAME, \w is a letter, a number or an underscore
    like = pattern.replace(r"[^\s\p{L}\p{N}]", r"(?:_|[^\s\w])").replace(r"\p{L}", r"[^\W\d_]").replace(r"\p{N}", r"\d")
    if r"\p" in like:
        return slow
    fast = re.compile(like).findall
    return lambda text: fast(text) if SAME.issuperset(text) else slow(text)


class Codec:
    """Encoder and decoder over a table of token bytes -> rank."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {r: t for t, r in ranks.items()}
        self.pieces = splitter(pattern)
        # the lengths of the tokens that begin with these two bytes, longest first
        begun: dict[bytes, set[int]] = {}
        for token in ranks:
            begun.setdefault(token[:2], set()).add(len(token))
        singles = [token for token in ranks if len(token) == 1]
        self.lengths = {a + b: tuple(sorted(begun.get(a + b, set()) | {1}, reverse=True)) for a in singles for b in [b"", *singles]}
        self._stable: dict[tuple[int, int], bool] = {}
        self._short: dict[bytes, list[int]] = {}

    @classmethod
    @functools.lru_cache(maxsize=4)
    def from_file(cls, path: str, pattern: str) -> Codec:
        """One codec for all tasks of a worker, with what it remembers."""
        with open(path, "rb") as lines:
            return cls({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}, pattern)

    def encode_short(self, data: bytes) -> list[int]:
        """The encoding of a leaf or window; short ones are remembered."""
        if len(data) > KEPT_BYTES:
            return self.search(data)
        found = self._short.get(data)
        if found is None:
            if len(self._short) >= KEPT:
                self._short.clear()
            found = self._short[data] = self.search(data)
        return found

    def search(self, data: bytes) -> list[int]:
        """The one sequence of tokens whose neighbours are all stable, longest tokens tried first.

        Such a sequence is the encoding of its bytes, so an end is only ever reached by one chain; an end from which the
        chain cannot go on is never tried again. The time grows with the bytes times the lengths that tokens have.
        """
        ranks, known, lengths, n = self.ranks, self._stable, self.lengths, len(data)
        whole = ranks.get(data)
        if whole is not None and (n == 1 or self.merge(data) == [whole]):
            return [whole]
        ids, ends, at, limit, dead = [], [], 0, n - 1 if n > 1 else n, set()
        while at < n:
            for length in lengths[data[at : at + 2]]:
                end = at + length
                if end > limit or end in dead:
                    continue
                token = ranks.get(data[at:end])
                if token is None:
                    continue
                if ids:
                    pair = (ids[-1], token)
                    ok = known.get(pair)
                    if not (self.stable(*pair) if ok is None else ok):
                        continue
                ids.append(token), ends.append(end)
                at, limit = end, n
                break
            else:  # nothing fits here: the token before must be shorter
                dead.add(at)
                ids.pop()
                limit = ends.pop() - 1
                at = ends[-1] if ends else 0
        return ids

    def merge(self, data: bytes) -> list[int]:
        """Direct encoding of a few tokens' bytes: the pair of lowest rank merges first, the leftmost of equals."""
        ranks = self.ranks
        parts = [data[i : i + 1] for i in range(len(data))]
        scores = [ranks.get(a + b, NO_RANK) for a, b in zip(parts, parts[1:], strict=False)]
        while scores and (low := min(scores)) < NO_RANK:
            i = scores.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i < len(scores):
                scores[i] = ranks.get(parts[i] + parts[i + 1], NO_RANK)
            if i:
                scores[i - 1] = ranks.get(parts[i - 1] + parts[i], NO_RANK)
        return [ranks[p] for p in parts]

    def stable(self, a: int, b: int) -> bool:
        """Whether token a followed by token b is the encoding of their bytes."""
        found = self._stable.get((a, b))
        if found is None:
            if len(self._stable) > KEPT:
                self._stable.clear()
            found = self._stable[a, b] = self.merge(self.tokens[a] + self.tokens[b]) == [a, b]
        return found

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of two encodings."""
        if not left or not right:
            return left or right
        before = after = 1
        while True:
            i, j = max(0, len(left) - before), min(len(right), after)
            window = self.encode_short(b"".join(map(self.tokens.__getitem__, left[i:] + right[:j])))
            left_final = not i or self.stable(left[i - 1], window[0])
            right_final = j == len(right) or self.stable(window[-1], right[j])
            if left_final and right_final:
                return left[:i] + window + right[j:]
            before, after = before * (1 if left_final else 2), after * (1 if right_final else 2)

    def tree(self, data: bytes) -> list[int]:
        """Cut at the greatest power of two below the length: runs of one character then mostly join at token ends."""
        if len(data) <= LEAF:
            return self.encode_short(data)
        half = 1 << (len(data) - 1).bit_length() - 1
        return self.join(self.tree(data[:half]), self.tree(data[half:]))

    def encode_piece(self, data: bytes) -> list[int]:
        """A piece that is itself a token stays whole, even where merging would not reach it."""
        return [self.ranks[data]] if data in self.ranks else self.tree(data)

    def encode(self, text: str) -> list[int]:
        return [i for p in self.pieces(text) for i in self.encode_piece(p.encode("utf-8"))]

    def decode(self, ids: list[int]) -> bytes:
        """Token bytes, halves concatenated up the tree."""
        if len(ids) <= 64:
            return b"".join(map(self.tokens.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


class Pieces(dict):
    """Piece -> what ``make`` gives for its ids, kept for ``KEPT`` pieces."""

    def __init__(self, codec: Codec, make):
        super().__init__()
        self.codec, self.make = codec, make

    def __missing__(self, piece: str):
        if len(self) >= KEPT:
            self.clear()
        made = self.make(self.codec.encode_piece(piece.encode("utf-8")))
        if len(piece) <= 256:
            self[piece] = made
        return made


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """All columns of ``docs`` and ``ids`` (array of int) of each whole text; ``path`` is a rank file that every executor has."""
    kept = docs.drop(ids)
    schema = wider(kept, f"{ids} array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.from_file(path, pattern)
        look = Pieces(codec, lambda found: found).__getitem__
        for batch in batches:
            out = [[i for p in codec.pieces(t or "") for i in look(p)] for t in batch[text].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int32()))], [*batch.schema.names, ids])

    return kept.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All columns of ``df`` and ``decoded`` (binary) of each id list; null ids decode to no bytes."""
    kept = df.drop(text)
    schema = wider(kept, f"{text} binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.from_file(path, "")
        for batch in batches:
            out = [codec.decode(x or []) for x in batch[ids].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, text])

    return kept.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: each text is encoded and its ids are decoded, both joined up from the pieces."""
    schema = wider(docs.select("doc_id"), "n_tokens long, ids_sha256 string, decoded_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.from_file(path, pattern)
        look = Pieces(codec, lambda found: (len(found), ",".join(map(str, found)).encode(), codec.decode(found))).__getitem__
        for batch in batches:
            counts, ids, decoded = [], [], []
            for t in batch["text"].to_pylist():
                found = list(map(look, codec.pieces(t)))
                n, listed, data = zip(*found, strict=True) if found else ((), (), ())
                counts.append(sum(n))
                ids.append(hashlib.sha256(b",".join(listed)).hexdigest())
                decoded.append(hashlib.sha256(b"".join(data)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", whole().alias("text")).mapInArrow(run, schema)
