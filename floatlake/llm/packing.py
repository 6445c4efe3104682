"""Hierarchical packing of tokenised documents into sequences of several lengths."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floatlake.llm.common import blocks, record_batch

END_OF_TEXT = "<|endoftext|>"
#: Documents of about this many tokens are packed together before their sequences leave the task.
WINDOW_TOKENS = 1 << 20
#: White space in a row from which on a text goes to the slower encoder.
LONG_GAP = 100_000

_PIECES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("tier", pa.int64()), ("step_group", pa.int64()),
])
_GAP = re.compile(r"\s+")


class Encoder:
    """Byte-level BPE ids as `tokenizers` gives them, by a faster encoder of the same ranks and pattern.

    Texts that spell a special token, and texts with so long a gap that the faster one's pattern
    runs out of stack, go to `tokenizers` itself.
    """

    def __init__(self, vocabulary: str, ranks: str, pattern: str) -> None:
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(x): int(y) for x, y in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("byte-bpe", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.vocabulary = vocabulary

    @cached_property
    def full(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.vocabulary)

    def __call__(self, text: str) -> np.ndarray:
        """Ids as little-endian 32-bit numbers."""
        if END_OF_TEXT in text or (len(text) >= LONG_GAP and any(x.end() - x.start() >= LONG_GAP for x in _GAP.finditer(text))):
            ids = self.full.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.array(ids, "<u4")


_encoders: dict[tuple[str, str, str], Encoder] = {}


def encoder(vocabulary: str, ranks: str, pattern: str) -> Encoder:
    """One encoder per Python worker."""
    key = (vocabulary, ranks, pattern)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


@dataclass
class Piece:
    """`length` ids of a document from `start` on."""

    doc: int
    start: int
    length: int


@dataclass
class Packer:
    """Fills sequences of `tiers` (powers of two, longest first) with pieces.

    Whole windows of the longest tier are cut from long documents. Each rest belongs to the
    shortest tier that holds it. Per tier, longest first, a rest opens a sequence; the gap is
    filled with the largest fitting rests of the shorter tiers, and what is still open by cutting one.
    """

    tiers: tuple[int, ...]
    queues: dict[int, list[Piece]] = field(default_factory=dict)
    tokens: dict[int, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.queues = {t: [] for t in self.tiers}
        self.tokens = dict.fromkeys(self.tiers, 0)

    def _put(self, piece: Piece) -> None:
        tier = min(t for t in self.tiers if t >= piece.length)
        self.queues[tier].append(piece)
        self.tokens[tier] += piece.length

    def _take(self, tier: int) -> Piece:
        piece = self.queues[tier].pop()
        self.tokens[tier] -= piece.length
        return piece

    def _fill(self, sequence: list[Piece], gap: int, tier: int) -> int:
        """Fill the gap of a sequence from the queues of `tier` and shorter ones; what stays open."""
        usable = [t for t in self.tiers if t <= tier]
        for own in usable:
            while self.queues[own] and self.queues[own][-1].length <= gap:
                sequence.append(self._take(own))
                gap -= sequence[-1].length
        for own in reversed(usable):
            while gap and self.queues[own]:
                piece = self._take(own)
                if piece.length > gap:
                    self._put(Piece(piece.doc, piece.start + gap, piece.length - gap))
                    piece = Piece(piece.doc, piece.start, gap)
                sequence.append(piece)
                gap -= piece.length
        return gap

    def pack(self, documents: list[tuple[int, int]], last: bool) -> Iterator[tuple[int, list[Piece]]]:
        """`(tier, pieces)` of each sequence, from `(document, tokens)`; open rests wait unless `last`."""
        longest = self.tiers[0]
        for doc, tokens in documents:
            for start in range(0, tokens - longest + 1, longest):
                yield longest, [Piece(doc, start, longest)]
            if rest := tokens % longest:
                self._put(Piece(doc, tokens - rest, rest))
        for tier in self.tiers:
            # Sorted so that the longest of a queue is taken first to open, and to fill while it fits.
            for queue in self.queues.values():
                queue.sort(key=lambda x: x.length)
            while self.queues[tier] and sum(n for t, n in self.tokens.items() if t <= tier) >= tier:
                first = self._take(tier)
                sequence = [first]
                self._fill(sequence, tier - first.length, tier)
                yield tier, sequence
        if last:
            yield from self._close()

    def _close(self) -> Iterator[tuple[int, list[Piece]]]:
        """The last rests, in sequences of falling powers of two; the very last may need padding."""
        rests = [piece for queue in self.queues.values() for piece in queue]
        self.__post_init__()
        left = sum(x.length for x in rests)
        while left:
            size = min(self.tiers[0], 1 << (left.bit_length() - 1))
            sequence, gap = [], size
            while gap:
                piece = rests.pop()
                if piece.length > gap:
                    rests.append(Piece(piece.doc, piece.start + gap, piece.length - gap))
                    piece = Piece(piece.doc, piece.start, gap)
                sequence.append(piece)
                gap -= piece.length
            left -= size
            yield size, sequence


class StepGroups:
    """Numbers for steps of equally many tokens, each made of sequences of one tier."""

    def __init__(self, step_tokens: int) -> None:
        self.step_tokens = step_tokens
        self.open: dict[int, tuple[int, int]] = {}
        self.used = 0

    def number(self, tier: int) -> int:
        group, filled = self.open.get(tier, (-1, self.step_tokens))
        if filled + tier > self.step_tokens:
            group, filled = self.used, 0
            self.used += 1
        self.open[tier] = group, filled + tier
        return group


def _pack_partition(files: tuple[str, str, str], tiers: tuple[int, ...], separator: int, step_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(*files)
        context = TaskContext.get()
        base = (context.partitionId() if context else 0) << 33
        packer, groups = Packer(tiers), StepGroups(step_tokens)
        held: dict[int, tuple[int | None, np.ndarray]] = {}
        state = {"next": 0, "sequence": 0}

        def sequences(new: list[int], last: bool) -> pa.RecordBatch:
            rows: dict[str, list] = {name: [] for name in _PIECES.names}
            for tier, pieces in packer.pack([(d, len(held[d][1])) for d in new], last):
                offset, group = 0, base + groups.number(tier)
                for piece in pieces:
                    doc_id, ids = held[piece.doc]
                    values = (
                        doc_id, piece.start, piece.length, ids[piece.start : piece.start + piece.length].tobytes(), len(ids),
                        base + state["sequence"], offset, tier, group,
                    )
                    for name, value in zip(_PIECES.names, values, strict=True):
                        rows[name].append(value)
                    offset += piece.length
                state["sequence"] += 1
            waiting = {x.doc for queue in packer.queues.values() for x in queue}
            for doc in [d for d in held if d not in waiting]:
                del held[doc]
            return record_batch(_PIECES, **rows)

        new, size = [], 0
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for doc_id, text in zip(ids, texts, strict=True):
                tokens = np.append(encode(text.as_py() or ""), np.uint32(separator))
                held[state["next"]] = doc_id, tokens
                new.append(state["next"])
                state["next"] += 1
                size += len(tokens)
                if size >= WINDOW_TOKENS:
                    yield sequences(new, False)
                    new, size = [], 0
        if held:
            yield sequences(new, True)

    return run


def pack_documents(
    docs: DataFrame, vocabulary: str, ranks: str, pattern: str, id_column: str = "doc_id", text_column: str = "text",
    tiers: tuple[int, ...] = (1024, 512, 256), separator: int = 0, step_tokens: int = 16_384,
) -> DataFrame:
    """`doc_id, start, length, ids, doc_tokens, sequence_id, offset, tier, step_group` per piece.

    A document is its token ids and one `separator`; a null or empty text is the separator
    alone. Each id lies in one piece; `ids` holds a piece as little-endian 32-bit numbers.
    Sequences are full (`tier` tokens) but for no more than what a partition can't make up; the
    last rests of a partition go to sequences of falling powers of two, so none needs padding.
    A step group holds sequences of one tier and at most `step_tokens` tokens.

    Every partition is packed by itself, without a shuffle: memory is bounded by WINDOW_TOKENS
    and the longest document. Sequence and group numbers start with the partition number.
    Repeated rows are packed each; null ids stay null; an empty table gives no row.
    """
    if any(t & (t - 1) for t in tiers) or list(tiers) != sorted(tiers, reverse=True):
        raise ValueError("tiers must be powers of two, longest first")
    run = _pack_partition((vocabulary, ranks, pattern), tiers, separator, step_tokens)
    schema = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, tier long, step_group long"
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")).mapInArrow(run, schema)
