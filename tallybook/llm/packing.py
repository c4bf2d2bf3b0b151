"""Best-fit packing of token pieces into sequences of fixed length.

Bounded-space online best fit. A task keeps at most a fixed number of open bins; a bitset has
the bit ``f`` set while some open bin has ``f`` tokens free, so the tightest bin that takes a
piece is the lowest set bit at or above its length. When a piece needs a new bin and all
places are taken, the fullest open bin closes. Pieces come longest first within a task.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.words import parts

SEQUENCE_TOKENS = 4096
#: Open bins of a task; more of them waste less and cost no time.
OPEN_BINS = 16_384
END_ID = 1
_CACHED_WORDS = 600_000
_PART_BYTES = 4 << 20
_JOINED_WORDS = 500
_MARKS = bytes(k for k in range(33, 127) if not chr(k).isalnum())
_CACHED_BYTES = 64  # longer words are rare and not kept


class WordEncoder:
    """Token ids of a text, word by word; frequent words are encoded once.

    The tokenizer drops white space and never joins across it, so the ids of a text are those of
    its words in order. A-Z may be lowered first, as the tokenizer does so itself. Texts
    that may hold special tokens go to the tokenizer whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.bar = int(np.frombuffer(self._encode(["|"])[0], "<u4")[0])

    def _encode(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def _encode_letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters alone, many in one call with a bar between them."""
        out = []
        for k in range(0, len(words), _JOINED_WORDS):
            ids = np.frombuffer(self._encode([" | ".join(words[k : k + _JOINED_WORDS])])[0], "<u4")
            ends = np.append(np.flatnonzero(ids == self.bar), len(ids)).tolist()
            starts = [0, *(e + 1 for e in ends[:-1])]
            out += [ids[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
        return out

    def _learn(self, words: set[bytes]) -> list[bytes]:
        """Adds the ids of unknown words; returns the words and parts of words that were added.

        Marks after a last letter or digit never join with it, so such a word is two parts.
        """
        known, split, new = self.known, {}, set()
        for word in words:
            body = word.rstrip(_MARKS)
            if len(body) < len(word) and body[-1:].isalnum():
                split[word] = body, word[len(body) :]
                new.update(split[word])
            else:
                new.add(word)
        new.difference_update(known)
        texts = {w: w.decode() for w in new}
        letters = [w for w, t in texts.items() if t.isalpha()]
        known.update(zip(letters, self._encode_letters([texts[w] for w in letters]), strict=True))
        others = [w for w, t in texts.items() if not t.isalpha()]
        known.update(zip(others, self._encode([texts[w] for w in others]), strict=True))
        known.update((w, known[a] + known[b]) for w, (a, b) in split.items())
        return [*new, *split]

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each UTF-8 text."""
        known = self.known
        split = [None if b"<|" in t else t.lower().split() for t in texts]
        words = set()
        for own in split:
            words.update(own or ())
        unknown = words.difference(known)
        if len(known) + len(unknown) > _CACHED_WORDS:
            known.clear()
            unknown = words
        learned = self._learn(unknown)
        out = [
            self._encode([t.decode()])[0] if own is None else b"".join(map(known.__getitem__, own))
            for t, own in zip(texts, split, strict=True)
        ]
        for word in learned:
            if len(word) > _CACHED_BYTES:
                del known[word]
        return out


_encoders: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _cut(path: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        end = np.array([END_ID], "<u4").tobytes()
        for part, texts in parts(batches, _PART_BYTES):
            rows = []
            encoded = encoder.ids(texts)
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoded, strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * size)):
                    cut = ids[at : at + 4 * size]
                    rows.append((doc_id, piece, at // 4, len(cut) // 4, cut))
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            names = ["doc_id", "piece", "start", "length", "ids"]
            columns = zip(types, zip(*rows, strict=True), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for t, c in columns], names)

    return run


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    size: int = SEQUENCE_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of every text: doc_id, piece, start, length, ids (binary, little-endian uint32).

    Null text counts as empty and is one piece with the end id alone. Only texts longer
    than ``size`` are cut. A null id stays null; rows that repeat are tokenized each.
    """
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids binary"
    return slim.mapInArrow(_cut(tokenizer_path, size), schema)


class OpenBins:
    """Places for pieces; ``place`` returns the bin's number and the offset there."""

    def __init__(self, size: int, limit: int) -> None:
        self.size, self.limit = size, limit
        self.by_free: dict[int, list[int]] = {}
        self.bits = self.open = self.made = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        bin_ = bins.pop()
        if not bins:
            self.bits ^= 1 << free
        self.open -= 1
        return bin_

    def place(self, length: int) -> tuple[int, int]:
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            bin_ = self._take(free)
        else:
            if self.open >= self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            bin_, free = self.made, self.size
            self.made += 1
        left = free - length
        if left:
            self.by_free.setdefault(left, []).append(bin_)
            self.bits |= 1 << left
            self.open += 1
        return bin_, self.size - free


def _pack(size: int, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 36
        bins = OpenBins(size, limit)
        for batch in batches:
            placed = [bins.place(n) for n in batch.column("length").to_pylist()]
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            columns["sequence_id"] = pa.array([base + b for b, _ in placed], pa.int64())
            columns["offset"] = pa.array([o for _, o in placed], pa.int64())
            yield pa.RecordBatch.from_pydict(columns)

    return run


def pack_pieces(
    pieces: DataFrame, size: int = SEQUENCE_TOKENS, open_bins: int = OPEN_BINS
) -> DataFrame:
    """``pieces`` (doc_id, piece, length and others) with sequence_id and offset.

    Pieces are dealt by a hash of their place, so no key is hot, and sorted by length, which makes a
    task that runs again pack the same. Offsets of a sequence have no gaps.
    """
    place = F.xxhash64("doc_id", "piece", "length")
    dealt = pieces.repartition(place)
    ordered = dealt.sortWithinPartitions(F.desc("length"), "doc_id", "piece")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    schema += ", sequence_id bigint, offset bigint"
    return ordered.mapInArrow(_pack(size, open_bins), schema)


def assemble(packed: DataFrame) -> DataFrame:
    """Token ids of every sequence: sequence_id, length, ids (binary), from packed pieces with ids."""
    rows = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    ids = F.aggregate(rows, F.lit(b""), lambda done, x: F.concat(done, x["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), ids.alias("ids"))
