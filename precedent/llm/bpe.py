"""BPE encoding and decoding as streaming transducers.

A merge list has a *sufficient lookahead*: a number of bytes after which a token can no
longer change, whatever follows. Two continuations of one text are merged alike up to a
frontier that starts where they differ. A merge (a, b) moves the frontier left over ``a``
only where ``a`` ends at it, and then ``b`` begins with the symbol that the last move went
over. Ranks rise along such a chain of moves, so the longest chain, weighted by the length of
``a``, is found by one pass over the merges in rank order. The encoder keeps that many bytes
and one block, emits every token that ends before them, and drops its text: memory is constant
however long a run without a break is. Decoding is a state machine from bytes to text that
holds at most the three bytes of an unfinished character.

Edge cases: a null text is the empty text and has no ids; the special token's string in a text
is that token, as in the tokenizers library; ids that are not UTF-8 together decode to U+FFFD.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType

from precedent.llm.common import slices
from precedent.session import ship_package

#: Fixed value: the byte-level pre-token pattern of the vocabulary.
PATTERN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: A text may be cut before a space that a non-space follows: a pre-token always begins there.
CUT = re.compile(r" (?=\S)")
#: Characters of a pre-token that are fed to the transducer at once.
BLOCK = 1024
#: Pieces remembered per worker (about 80 MB); the memory is emptied when full.
CACHE_PIECES = 400_000
#: Text that is encoded at a time where the ids are returned as rows.
ENCODE_BYTES = 2_000_000
#: Longer pieces are not remembered.
CACHE_CHARS = 64
_NEVER = 1 << 60


def byte_alphabet() -> dict[str, int]:
    """Character of the vocabulary file for each byte: printable ones stand for themselves,
    the others follow from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = sorted(set(range(256)) - set(plain))
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class MergeTable:
    """Vocabulary and merges of a byte-level BPE file, and the lookahead that suffices."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        alphabet = byte_alphabet()

        def raw(text: str) -> bytes:
            return bytes(alphabet[c] for c in text)

        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.id_of = {raw(k): v for k, v in data["model"]["vocab"].items() if k not in self.special}
        self.bytes_of = {v: k for k, v in self.id_of.items()}
        self.bytes_of |= {v: k.encode() for k, v in self.special.items()}
        self.single = [self.id_of[bytes([b])] for b in range(256)]
        self.rank: dict[tuple[int, int], int] = {}
        self.merged: list[int] = []
        pairs = []
        for entry in data["model"]["merges"]:
            left, right = map(raw, entry if isinstance(entry, list) else entry.split(" "))
            pairs.append((left, right))
            self.rank[self.id_of[left], self.id_of[right]] = len(self.merged)
            self.merged.append(self.id_of[left + right])
        self.lookahead = sufficient_lookahead(pairs)

    def merge(self, word: bytes) -> list[int]:
        """Ids of one whole pre-token."""
        ids = [self.single[b] for b in word]
        return self._merge_long(ids) if len(ids) > 48 else self._merge_short(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        rank = self.rank.get
        while len(ids) > 1:
            ranks = [rank(pair, _NEVER) for pair in zip(ids, ids[1:])]
            best = min(ranks)
            if best == _NEVER:
                break
            at = ranks.index(best)
            ids[at : at + 2] = [self.merged[best]]
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap of pairs: n log n."""
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.rank.get
        heap = [(r, i) for i in range(n - 1) if (r := rank((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            best, i = heapq.heappop(heap)
            j = after[i]
            # Entries of symbols that have changed since are stale.
            if ids[i] < 0 or j >= n or rank((ids[i], ids[j])) != best:
                continue
            ids[i], ids[j] = self.merged[best], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                if (r := rank((ids[i], ids[after[j]]))) is not None:
                    heapq.heappush(heap, (r, i))
            if before[i] >= 0 and (r := rank((ids[before[i]], ids[i]))) is not None:
                heapq.heappush(heap, (r, before[i]))
        return [x for x in ids if x >= 0]


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes after which a token is final, from the merges in rank order.

    Refuses a list in which a merge uses a symbol that is made only later: the argument
    needs symbols to be made in the order of their use.
    """
    made = {bytes([b]) for b in range(256)}
    reach: dict[bytes, int] = {}
    longest = 0
    for left, right in merges:
        if left not in made or right not in made:
            raise ValueError("a merge uses a symbol that no earlier merge makes")
        made.add(left + right)
        before = max((reach.get(right[:k], 0) for k in range(1, len(right) + 1)), default=0)
        moved = before + len(left)
        reach[left] = max(reach.get(left, 0), moved)
        longest = max(longest, moved)
    return longest


class Transducer:
    """Ids of one pre-token that arrives in blocks of bytes."""

    def __init__(self, table: MergeTable):
        self.table, self.held = table, b""

    def feed(self, block: bytes) -> list[int]:
        """The ids that are stable now."""
        self.held += block
        if len(self.held) <= self.table.lookahead + BLOCK:
            return []
        stable, end = [], 0
        limit = len(self.held) - self.table.lookahead
        for token in self.table.merge(self.held):
            size = len(self.table.bytes_of[token])
            if end + size > limit:
                break
            stable.append(token)
            end += size
        self.held = self.held[end:]
        return stable

    def finish(self) -> list[int]:
        held, self.held = self.held, b""
        return self.table.merge(held)


class StreamDecoder:
    """Text of ids that arrive in any portions."""

    def __init__(self, table: MergeTable):
        self.bytes_of = table.bytes_of
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.state.decode(b"".join(map(self.bytes_of.__getitem__, ids)))

    def finish(self) -> str:
        return self.state.decode(b"", True)


def pre_token_ids(table: MergeTable, text: str) -> Iterator[list[int]]:
    """Ids of a text without special tokens, portion by portion."""
    for match in PATTERN.finditer(text):
        begin, end = match.span()
        if end - begin <= BLOCK:
            yield table.merge(match[0].encode())
            continue
        run = Transducer(table)
        for at in range(begin, end, BLOCK):
            yield run.feed(text[at : min(end, at + BLOCK)].encode())
        yield run.finish()


def stream_ids(table: MergeTable, text: str) -> Iterator[list[int]]:
    """Ids of a whole text with its special tokens, portion by portion."""
    if not table.special:
        yield from pre_token_ids(table, text)
        return
    for part in re.split("(" + "|".join(map(re.escape, table.special)) + ")", text):
        if part in table.special:
            yield [table.special[part]]
        elif part:
            yield from pre_token_ids(table, part)


class BatchEncoder:
    """Ids of many texts, each distinct piece between spaces encoded once. Little-endian machines.

    ``encode_piece`` gives the ids of one piece, ``encode_whole`` those of a text with special
    tokens or runs of white space, whose pieces do not stand alone.
    """

    def __init__(
        self,
        encode_piece: Callable[[str], list[int]],
        encode_whole: Callable[[str], list[int]],
        special: Iterable[str],
    ):
        self.encode_piece, self.encode_whole = encode_piece, encode_whole
        self.special = list(special)
        self.known: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        """Pre-tokens always end before a stop after a letter and around a line end between
        non-spaces, so the parts of such a piece are looked up, not the piece."""
        found = self.known.get(piece)
        if found is not None:
            return found
        if not piece[1:].isalpha():  # else there is nothing to cut
            if piece[-1:] in (".", ",") and piece[-2:-1].isalpha():
                return self._piece(piece[:-1]) + self._piece(piece[-1])
            if "\n" in piece:
                head, _, rest = piece.partition("\n")
                if head and rest and not head[-1].isspace() and not rest[0].isspace():
                    return self._piece(head) + self._piece("\n") + self._piece(rest)
        found = array("I", self.encode_piece(piece)).tobytes()
        if len(piece) <= CACHE_CHARS:
            if len(self.known) >= CACHE_PIECES:
                self.known.clear()
            self.known[piece] = found
        return found

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if not len(texts):
            return []
        texts = pc.fill_null(texts.cast(pa.string()), "")
        lists = pc.split_pattern(texts, pattern=" ")
        starts = lists.offsets.to_numpy()
        encoded = lists.flatten().dictionary_encode()
        index = encoded.indices.to_numpy().astype(np.int64)
        starts = starts - starts[0]
        distinct = encoded.dictionary.to_numpy(zero_copy_only=False).tolist()
        first = [distinct[i] for i in index[starts[:-1]]]
        index[starts[:-1]] = len(distinct) + np.arange(len(first))
        pieces = [*map(" ".__add__, distinct), *first]
        ids = list(map(self.known.get, pieces))
        for i, found in enumerate(ids):
            if found is None:
                ids[i] = self._piece(pieces[i])
        ids = pa.array(ids, pa.large_binary()).take(pa.array(index))
        ends = ids.buffers()[1]
        bounds = np.frombuffer(ends, np.int64)[ids.offset + starts]
        data = memoryview(ids.buffers()[2]) if ids.buffers()[2] else memoryview(b"")
        # A piece that is empty or begins with white space belongs to the piece before it.
        odd = np.array([not p or p[0].isspace() for p in distinct] + [False] * len(first))
        odd_rows = np.add.reduceat(odd[index], starts[:-1]) > 0
        for string in self.special:
            odd_rows |= pc.match_substring(texts, string).to_numpy(zero_copy_only=False)
        out = [bytes(data[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
        for row in np.nonzero(odd_rows)[0]:
            out[row] = np.array(self.encode_whole(texts[row].as_py()), "<u4").tobytes()
        return out


def transducer_encoder(table: MergeTable) -> BatchEncoder:
    def piece(text: str) -> list[int]:
        return [i for ids in pre_token_ids(table, text) for i in ids]

    def whole(text: str) -> list[int]:
        return [i for ids in stream_ids(table, text) for i in ids]

    return BatchEncoder(piece, whole, table.special)


_workers: dict[str, tuple[MergeTable, BatchEncoder]] = {}


def _worker(path: str) -> tuple[MergeTable, BatchEncoder]:
    """The table and encoder of this Python worker, made once."""
    if path not in _workers:
        table = MergeTable(path)
        _workers[path] = table, transducer_encoder(table)
    return _workers[path]


def decoded_text(table: MergeTable, ids: np.ndarray) -> Iterator[str]:
    """Text of ids, in portions."""
    decoder = StreamDecoder(table)
    for at in range(0, len(ids), 65536):
        yield decoder.feed(ids[at : at + 65536].tolist())
    yield decoder.finish()


def encode_documents(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``token_ids`` (array of int) instead of the text column.

    A column of that name that is there already is replaced.
    """
    kept = [c for c in docs.columns if c not in (text, "token_ids")]
    ship_package(docs.sparkSession)
    schema = docs.select(*kept).schema.add("token_ids", ArrayType(IntegerType()), False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, encoder = _worker(tokenizer)
        # A worker that ran other stages may still hold their freed buffers.
        pa.default_memory_pool().release_unused()
        for batch in slices(batches, text, ENCODE_BYTES):
            ids = encoder.encode(batch.column(text))
            ends = np.cumsum([0, *(len(b) // 4 for b in ids)]).astype(np.int32)
            flat = pa.array(np.frombuffer(b"".join(ids), "<i4"))
            lists = pa.ListArray.from_arrays(pa.array(ends), flat)
            columns = [batch.column(c) for c in kept] + [lists]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "token_ids"])

    return docs.select(*kept, text).mapInArrow(run, schema)


DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Encode every text, decode its ids again, and return the digests of both.

    Columns: doc_id, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256 (UTF-8).
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, encoder = _worker(tokenizer)
        for batch in slices(batches, "text"):
            n, ids_sha, text_sha = [], [], []
            for raw in encoder.encode(batch.column("text")):
                ids = np.frombuffer(raw, "<u4")
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest())
                digest = hashlib.sha256()
                for portion in decoded_text(table, ids):
                    digest.update(portion.encode())
                text_sha.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.selectExpr("cast(doc_id as long) as doc_id", "text")
    return rows.mapInArrow(run, DIGEST)
