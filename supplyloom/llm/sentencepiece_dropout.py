"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

The vocabulary is a public byte-fallback BPE model; nothing is trained. A text is split into chunks (word marks and the
letters, or the other characters, that follow) that no piece of the vocabulary crosses; this is checked on the
vocabulary when it is loaded. Within a chunk an agenda holds the candidate merges by score and
position. When a candidate comes up, a hash keyed by seed, document id, place of the chunk, position and merged piece decides
whether it is skipped; a pair that changes its neighbours may come up again. So every occurrence of a word is cut on its
own, and every run gives the same cut. The agendas of the chunks of many texts advance side by side over arrays; nothing is kept
from one text to the next.
"""

from __future__ import annotations

import heapq
import re
import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
LETTER = r"[^\W\d_¹²³]"
CHUNK = re.compile(rf"\n|{MARK}*{LETTER}+|{MARK}*(?:[^\w\n{MARK}]|[\d_¹²³])+|{MARK}+")
CROSSING = re.compile(rf"[^{MARK}]{MARK}|\n.|.\n|{LETTER}(?!{LETTER}).|(?!{LETTER})[^{MARK}]{LETTER}", re.DOTALL)
DROPOUT = 0.1
WIDTHS = (6, 9, 13, 19, 33)  # chunks shorter than one of these, but not than the one before, advance together
NO_RANK = 1 << 30
FULL = (1 << 64) - 1
SPREAD, MIX, MIX2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
PLACE_BITS = 32
LAST_PLACE = (1 << PLACE_BITS) - 1
LONGEST = 32  # longer chunks are cut anew each time
ROUND = 1 << 17  # characters of the texts that are encoded together


class Vocabulary:
    """Pieces, the order in which merges come up, and byte pieces of a model file."""

    def __init__(self, model: str = MODEL):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        special = {i for i in range(len(self.pieces)) if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if sp.is_byte(i)}
        normal = [i for i in range(len(self.pieces)) if i not in special and not sp.is_byte(i)]
        self.ids = {self.pieces[i]: i for i in normal}
        self.by_rank = [self.pieces[i] for i in sorted(normal, key=lambda i: (-sp.get_score(i), i))]
        self.ranks = {piece: rank for rank, piece in enumerate(self.by_rank)}
        if len(self.bytes) != 256 or any(CROSSING.search(p) for p in self.ids):
            raise ValueError(f"{model} has no byte fallback, or pieces that cross a chunk")
        self.raw = [b""] * len(self.pieces)
        for value, i in self.bytes.items():
            self.raw[i] = bytes([value])
        for piece, i in self.ids.items():
            self.raw[i] = piece.replace(MARK, " ").encode()
        # the rank of every character that is a piece, -1 for all others
        self.symbols = np.full(sys.maxunicode + 1, -1, dtype=np.int32)
        for piece, rank in self.ranks.items():
            if len(piece) == 1:
                self.symbols[ord(piece)] = rank
        self.rank_ids = np.array([self.ids[p] for p in self.by_rank], dtype=np.int32)
        # the rank of the piece that two pieces make, by the ranks of both
        made = {
            self.ranks[piece[:k]] * len(self.by_rank) + self.ranks[piece[k:]]: rank
            for rank, piece in enumerate(self.by_rank)
            for k in range(1, len(piece))
            if piece[:k] in self.ranks and piece[k:] in self.ranks
        }
        self.pairs = np.array(sorted(made), dtype=np.int64)
        self.made = np.array([made[p] for p in self.pairs.tolist()], dtype=np.int32)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of the piece that each pair of symbols makes, NO_RANK where there is none."""
        wanted = left.astype(np.int64) * len(self.by_rank) + right
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return np.where((self.pairs[at] == wanted) & (left >= 0) & (right >= 0), self.made[at], NO_RANK)

    def fallback(self, symbol: str) -> list[int]:
        return [self.bytes[b] for b in symbol.encode("utf-8", "surrogatepass")]


@lru_cache(maxsize=2)
def vocabulary_of(model: str) -> Vocabulary:
    return Vocabulary(model)


def mixed(keys: np.ndarray) -> np.ndarray:
    """Keys whose bits depend on all bits of the given ones (64 bits, unsigned)."""
    keys = (keys ^ (keys >> np.uint64(30))) * np.uint64(MIX)
    keys = (keys ^ (keys >> np.uint64(27))) * np.uint64(MIX2)
    return keys ^ (keys >> np.uint64(31))


def chunk_keys(document: int, places: np.ndarray, seed: int) -> np.ndarray:
    """The keys of chunks at these places of the document with this key."""
    first = np.uint64((document + seed * MIX) & FULL)
    return mixed(first + places.astype(np.uint64) * np.uint64(SPREAD))


def skips(key: int, code: int, limit: int) -> bool:
    """Whether the candidate is skipped in the chunk with this key."""
    x = (key ^ code * SPREAD) & FULL
    x = (x ^ x >> 30) * MIX & FULL
    x = (x ^ x >> 27) * MIX2 & FULL
    return x ^ x >> 31 < limit


def merge(chunk: str, vocabulary: Vocabulary, skip) -> tuple[list[int], list[int]]:
    """Piece ids of one chunk by agenda-driven merging, and the candidates taken; ``skip(code)`` tells what is left out."""
    ids, ranks, by_rank = vocabulary.ids, vocabulary.ranks, vocabulary.by_rank
    symbols: list[str | None] = list(chunk)
    size = len(symbols)
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    taken = []
    # a candidate is its rank and the place of its left symbol, in one number
    agenda = [
        rank << PLACE_BITS | at
        for at in range(size - 1)
        if (rank := ranks.get(symbols[at] + symbols[at + 1])) is not None
    ]
    heapq.heapify(agenda)
    while agenda:
        code = heapq.heappop(agenda)
        left, rank = code & LAST_PLACE, code >> PLACE_BITS
        right = after[left]
        merged = by_rank[rank]
        if symbols[left] is None or right == size or symbols[left] + symbols[right] != merged:
            continue
        if skip(code):
            continue
        taken.append(code)
        symbols[left], symbols[right] = merged, None
        right = after[left] = after[right]
        if right < size:
            before[right] = left
            rank = ranks.get(merged + symbols[right])
            if rank is not None:
                heapq.heappush(agenda, rank << PLACE_BITS | left)
        at = before[left]
        if at >= 0:
            rank = ranks.get(symbols[at] + merged)
            if rank is not None:
                heapq.heappush(agenda, rank << PLACE_BITS | at)
    out: list[int] = []
    for symbol in symbols:
        if symbol is not None:
            found = ids.get(symbol)
            out.extend([found] if found is not None else vocabulary.fallback(symbol))
    return out, taken


def cut(chunk: str, vocabulary: Vocabulary, key: int = 0, seed: int = 0, dropout: float = 0.0, place: int = 0) -> list[int]:
    """Piece ids of the chunk at one place of the document with this key."""
    limit = int(dropout * 2**64)
    own = int(chunk_keys(key, np.array([place]), seed)[0])
    return merge(chunk, vocabulary, lambda code: limit and skips(own, code, limit))[0]


def document_key(key: int | None) -> int:
    return xxhash.xxh64_intdigest(str(key))


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All indices start, start + 1, ... of runs of these sizes, one run after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def merge_all(symbols: np.ndarray, sizes: np.ndarray, own: np.ndarray, limit: int, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The ids of many chunks in a row, and how many each has; their agendas advance side by side.

    ``symbols`` holds the symbols (ranks of pieces) of all chunks in a row, ``sizes`` how many each has, ``own`` its key. In a step
    every chunk takes the first candidate of its agenda, the one of lowest rank and then leftmost, and merges or skips it.
    """
    n, width = len(sizes), int(sizes.max())
    inside = np.arange(width) < sizes[:, None]
    sym = np.full((n, width + 1), -1, dtype=np.int32)  # the last column stands behind the last symbol
    sym[:, :width][inside] = symbols
    after = np.minimum(np.arange(1, width + 2, dtype=np.int32), sizes[:, None].astype(np.int32))
    before = np.tile(np.arange(-1, width, dtype=np.int32), (n, 1))
    rank = np.full((n, width + 1), NO_RANK, dtype=np.int32)
    pair = inside[:, 1:]
    rank[:, : width - 1][pair] = vocabulary.pair_ranks(sym[:, : width - 1][pair], sym[:, 1:width][pair])
    rows = np.arange(n)
    while len(rows):
        left = rank[rows].argmin(axis=1)
        best = rank[rows, left]
        left_over = best < NO_RANK
        rows, left, best = rows[left_over], left[left_over], best[left_over]
        code = best.astype(np.uint64) << np.uint64(PLACE_BITS) | left.astype(np.uint64)
        skipped = mixed(own[rows] ^ code * np.uint64(SPREAD)) < np.uint64(min(limit, FULL))
        rank[rows[skipped], left[skipped]] = NO_RANK
        at, here, merged = rows[~skipped], left[~skipped], best[~skipped]
        right = after[at, here]
        behind = after[at, right]
        sym[at, here], sym[at, right] = merged, -1
        rank[at, right] = NO_RANK
        after[at, here] = behind
        before[at, behind] = here
        rank[at, here] = np.where(behind < sizes[at], vocabulary.pair_ranks(merged, sym[at, behind]), NO_RANK)
        front = before[at, here]
        some = front >= 0
        rank[at[some], front[some]] = vocabulary.pair_ranks(sym[at[some], front[some]], merged[some])
    kept = sym >= 0
    return vocabulary.rank_ids[sym[kept]], kept.sum(axis=1)


class Encoder:
    """Encodes whole texts. Texts of ``together`` characters are cut at a time, which changes no result."""

    def __init__(self, model: str, seed: int, dropout: float, together: int = ROUND):
        self.vocabulary = vocabulary_of(model)
        self.seed, self.dropout, self.together = seed, dropout, together
        self.limit = int(dropout * 2**64)
        self.literal_mark = np.array(self.vocabulary.fallback(MARK), dtype=np.int32)

    def encode(self, text: str | None, key: int | None) -> bytes:
        """Packed int32 ids; NULL and empty texts have none. A word mark that is in the text itself becomes bytes."""
        return self.encode_all([text], [key])[0]

    def encode_all(self, texts: list[str | None], keys: list[int | None]) -> list[bytes]:
        out: list[bytes] = []
        begin = length = 0
        for i, text in enumerate(texts):
            length += len(text or "")
            if length >= self.together or i == len(texts) - 1:
                out += self._encoded(texts[begin : i + 1], keys[begin : i + 1])
                begin, length = i + 1, 0
        return out

    def _alone(self, chunk: str, key: int) -> np.ndarray:
        ids, _ = merge(chunk, self.vocabulary, lambda code: self.limit and skips(key, code, self.limit))
        return np.array(ids, dtype=np.int32)

    def _encoded(self, texts: list[str | None], keys: list[int | None]) -> list[bytes]:
        chunks: list[str] = []
        literal: list[int] = []  # places of word marks of the text itself
        ends, marks = [], []
        for text, key in zip(texts, keys, strict=True):
            begin = len(chunks)
            for number, part in enumerate(text.split(MARK) if text else ()):  # nearly always one part
                if number:
                    literal.append(len(chunks))
                    chunks.append("")
                chunks += CHUNK.findall(part.replace(" ", MARK) if number else MARK + part.replace(" ", MARK))
            ends.append(len(chunks))
            marks.append(chunk_keys(document_key(key), np.arange(len(chunks) - begin), self.seed))
        if not chunks:
            return [b""] * len(texts)
        own = np.concatenate(marks)
        # character by character: the symbols of all chunks in a row
        code_points = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        symbols = self.vocabulary.symbols[code_points]
        sizes = np.fromiter(map(len, chunks), dtype=np.int64, count=len(chunks))
        starts = np.cumsum(sizes) - sizes
        unknown = np.concatenate([[0], np.cumsum(symbols < 0)])
        together = (sizes > 0) & (sizes <= LONGEST) & (unknown[starts + sizes] == unknown[starts])
        cuts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # places, how many ids each has, the ids
        for low, high in zip((1, *WIDTHS), WIDTHS, strict=False):
            mine = np.flatnonzero(together & (sizes >= low) & (sizes < high))
            if len(mine):
                ids, counts = merge_all(symbols[_spread(starts[mine], sizes[mine])], sizes[mine], own[mine], self.limit, self.vocabulary)
                cuts.append((mine, counts, ids))
        # long chunks, and those with a character that is no piece
        for i in np.flatnonzero(~together & (sizes > 0)).tolist():
            ids = self._alone(chunks[i], int(own[i]))
            cuts.append((np.array([i]), np.array([len(ids)]), ids))
        cuts += [(np.array([i]), np.array([len(self.literal_mark)]), self.literal_mark) for i in literal]
        counts = np.zeros(len(chunks), dtype=np.int64)
        for mine, n, _ in cuts:
            counts[mine] = n
        first = np.concatenate([[0], np.cumsum(counts)])
        out = np.empty(first[-1], dtype=np.int32)
        for mine, n, ids in cuts:
            out[_spread(first[mine], n)] = ids
        bounds = first[[0, *ends]].tolist()
        return [out[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def decode(self, ids: list[int] | np.ndarray) -> str:
        pieces = map(self.vocabulary.raw.__getitem__, ids if isinstance(ids, list) else ids.tolist())
        return b"".join(pieces)[1:].decode("utf-8", "surrogatepass")


def encode(text: Column, key: Column, model: str = MODEL, seed: int = 0, dropout: float = DROPOUT) -> Column:
    """``array<int>`` of piece ids of every whole text. ``key`` (the document id) keys the hashes."""
    return encode_checked(text, key, model, seed, dropout)["pieces"]


def encode_checked(text: Column, key: Column, model: str = MODEL, seed: int = 0, dropout: float = DROPOUT) -> Column:
    """``struct<pieces: array<int>, lossless: boolean>``: piece ids of every whole text, and whether they decode to it.

    ``key`` (the document id) keys the hashes. NULL and empty texts have no pieces. Only the vocabulary stays with a worker.
    """

    @F.arrow_udf("struct<pieces: array<int>, lossless: boolean>")
    def coded(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        mine = Encoder(model, seed, dropout)
        for texts, keys in batches:
            listed = texts.to_pylist()
            packed = mine.encode_all(listed, keys.to_pylist())
            ids = [np.frombuffer(p, dtype=np.int32) for p in packed]
            lossless = pa.array([mine.decode(i) == (t or "") for i, t in zip(ids, listed, strict=True)], type=pa.bool_())
            offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
            values = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), type=pa.int32())
            yield pa.StructArray.from_arrays([pa.ListArray.from_arrays(pa.array(offsets), values), lossless], names=["pieces", "lossless"])

    return coded(text, key)


def decode(pieces: Column, model: str = MODEL) -> Column:
    """The text of piece ids; no ids give the empty text."""

    @F.arrow_udf("string")
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        mine = Encoder(model, 0, 0.0)
        for batch in batches:
            offsets, values = batch.offsets.to_numpy(), batch.values.to_numpy()
            yield pa.array([mine.decode(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], type=pa.string())

    return texts(pieces)
