"""Byte-level BPE encoding by longest matches with backtracking, and decoding.

Bytes are mapped to Latin-1 characters so that an Aho-Corasick automaton over
the vocabulary finds every token in a piece in one pass. The encoder walks the
piece with the longest match at each position; a token may follow another only
if the two are compatible, that is if merging their joined bytes by rank gives
exactly these two tokens. If no compatible token fits, the position is marked
dead and the walk goes one token back and tries the next shorter match. As a
sequence whose neighbours are all compatible is the one that merging produces,
the result equals the merge procedure, and as each position dies at most once
the walk takes linear time. Compatibility is memoised per token pair.

Texts are split into pieces by the tokenizer's pattern, whole; a bounded memo
keeps the encodings of frequent pieces.

Defined results. Null and empty text: no tokens; the digests are those of the
empty string. Repeated rows are returned each; extra columns are ignored. Every
byte string can be encoded, since the vocabulary holds every single byte.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Pieces whose encodings a worker remembers, in each of two generations.
MEMO_PIECES = 100_000
#: Token pairs whose compatibility a worker remembers.
MEMO_PAIRS = 400_000
_LOADED: dict[tuple[str, str], "Tokenizer"] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file with lines of base64 token and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def merge_by_rank(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The plain merge procedure: used on token pairs and as the tests' reference."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            r = ranks.get(parts[i] + parts[i + 1])
            if r is not None and (best is None or r < best):
                best, at = r, i
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Tokenizer:
    """One vocabulary with its automaton and memos."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.token = {r: b for b, r in ranks.items()}
        self.longest = max(map(len, ranks))
        self.split = regex.compile(pattern).findall
        self.machine = ahocorasick.Automaton()
        for b, r in ranks.items():
            self.machine.add_word(b.decode("latin-1"), (len(b), r))
        self.machine.make_automaton()
        self.pairs: dict[int, bool] = {}  # by left << 32 | right
        self.whole: dict[int, bool] = {}
        self.memo: dict[str, tuple[int, str, bytes]] = {}
        self.older: dict[str, tuple[int, str, bytes]] = {}

    def reachable(self, token: int) -> bool:
        """Whether merging the token's own bytes gives that token."""
        ok = self.whole.get(token)
        if ok is None:
            ok = self.whole[token] = len(merge_by_rank(self.token[token], self.ranks)) == 1
        return ok

    def compatible(self, left: int, right: int) -> bool:
        pair = left << 32 | right
        ok = self.pairs.get(pair)
        if ok is None:
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs.clear()
            a, b = self.token[left], self.token[right]
            ok = self.pairs[pair] = merge_by_rank(a + b, self.ranks) == [a, b]
        return ok

    def encode_piece(self, piece: bytes) -> list[int]:
        """Token ids of one piece."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        starts: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, (size, rank) in self.machine.iter(piece.decode("latin-1")):
            starts[end - size + 1].append((size, rank))  # shortest first, as ends grow
        dead = bytearray(n + 1)
        out: list[int] = []
        places: list[tuple[int, int]] = []  # position and next choice to try there
        at, choice = 0, len(starts[0]) - 1
        while at < n:
            here, found = starts[at], False
            last = out[-1] if out else -1
            while choice >= 0:
                size, rank = here[choice]
                choice -= 1
                if (
                    not dead[at + size]
                    and (size == 1 or self.reachable(rank))
                    and (last < 0 or self.compatible(last, rank))
                ):
                    found = True
                    break
            if found:
                out.append(rank)
                places.append((at, choice))
                at += size
                choice = len(starts[at]) - 1 if at < n else -1
            else:
                dead[at] = 1
                out.pop()
                at, choice = places.pop()
        return out

    def piece(self, text: str) -> tuple[int, str, bytes]:
        """Number of tokens, ids joined by commas, and the bytes they decode to."""
        got = self.older.get(text)
        if got is None:
            ids = self.encode_piece(text.encode())
            got = (len(ids), ",".join(map(str, ids)), self.decode(ids))
        if len(text) <= 64:
            if len(self.memo) >= MEMO_PIECES:
                self.older, self.memo = self.memo, {}
            self.memo[text] = got
        return got

    def pieces(self, text: str) -> list[tuple[int, str, bytes]]:
        known, new = self.memo.get, self.piece
        return [known(p) or new(p) for p in self.split(text)]

    def encode(self, text: str) -> list[int]:
        return [i for p in self.split(text) for i in self.encode_piece(p.encode())]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.token[i] for i in ids])


def load(path: str, pattern: str) -> Tokenizer:
    """The tokenizer of a vocabulary file, built once per worker process."""
    key = (path, pattern)
    if key not in _LOADED:
        _LOADED[key] = Tokenizer(read_ranks(path), pattern)
    return _LOADED[key]


def digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = load(path, pattern)
        for batch in batches:
            count, ids, decoded = [], [], []
            for text in batch.column(1):
                parts = tok.pieces(text.as_py()) if text.is_valid else []
                count.append(sum([p[0] for p in parts]))
                ids.append(hashlib.sha256(",".join([p[1] for p in parts]).encode()).hexdigest())
                decoded.append(hashlib.sha256(b"".join([p[2] for p in parts])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(count, pa.int64()), pa.array(ids), pa.array(decoded)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids (array of int) of every row: the operator's real output."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = load(path, pattern)
        for batch in batches:
            ids = [tok.encode(t.as_py()) if t.is_valid else [] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"]
            )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and text of every row of (doc_id, ids); bytes that are no UTF-8 become U+FFFD."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = load(path, pattern)
        for batch in batches:
            text = [tok.decode(x.as_py() or []).decode(errors="replace") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string())], names=["doc_id", "text"])

    kind = dict(encoded.dtypes)["doc_id"]
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")
