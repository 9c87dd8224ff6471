"""First-fit decreasing packing of tokenized documents, in randomised groups.

The texts are dealt out once by a hash; each task then works through its rows as a stream: it
tokenizes, cuts long documents into full sequences, collects pieces up to a bounded number of
tokens and packs that group by itself with a tournament tree of the room left in each sequence.
Nothing is ever gathered beyond one group, and token ids are never shuffled. A packed group leaves
in small batches, and a Python worker keeps one bounded cache of words for all its tasks.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache
from unicodedata import is_normalized

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlog.llm.common import small_batches

#: Punctuation that may be cut off the end of a word of letters without changing its token ids.
TAIL = b".,!*&$%#|?;:"
#: Bytes of the words and ids that a Python worker keeps; when there are as many, it begins anew.
CACHED_BYTES = 56_000_000
#: Bytes that a kept word takes besides its own and those of its ids.
ENTRY = 120
#: Words that take more than this are not kept.
LONGEST = 10_000
#: Bytes of token ids, at most, that leave a task at a time.
OUT_BYTES = 1 << 20


def _byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it can be seen, else
    the next one from 256 on."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in seen]
    return [chr(b) if b in seen else chr(256 + hidden.index(b)) for b in range(256)]


class WordIds(dict):
    """Token ids of a word (UTF-8, without white space) as little-endian 32-bit numbers.

    The tokenizer drops white space before it looks for words, so a text's ids are those of its
    words in turn. Its own model is asked directly for words of letters in lower case, which its
    normalizer leaves as they are and which are one piece for it.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.held = 0

    def __missing__(self, word: bytes) -> bytes:
        stem = word.rstrip(TAIL)
        text = stem.decode()
        plain = text.isalpha() and text == text.lower() and is_normalized("NFC", text)
        if plain and len(stem) < len(word):
            ids = self[stem] + self[word[len(stem):]]
        elif plain:
            if not text.isascii():
                text = "".join([self.letters[b] for b in word])
            ids = array("I", [t.id for t in self.model.tokenize(text)]).tobytes()
        else:
            ids = array("I", self.tokenizer.encode(word.decode(), add_special_tokens=False).ids).tobytes()
        size = len(word) + len(ids) + ENTRY
        if size <= LONGEST:
            if self.held + size > CACHED_BYTES:
                self.clear()
                self.held = 0
            self.held += size
            self[word] = ids
        return ids

    def of(self, text: bytes) -> bytes:
        if b"<|" not in text:  # else a special token's name may occur, in its own letter case
            text = text.lower()
        return b"".join([self[w] for w in text.split()])


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """The ids of words, loaded once in a Python worker and shared by its tasks."""
    return WordIds(path)


class Room:
    """Tournament tree over sequences: each inner node knows the most room below it."""

    def __init__(self, most: int, length: int):
        self.size = 1
        while self.size < max(1, most):
            self.size *= 2
        self.room = [length] * (2 * self.size)

    def take(self, need: int) -> tuple[int, int]:
        """The first sequence with room for ``need`` tokens, and where its free part begins."""
        room, at = self.room, 1
        while at < self.size:
            at *= 2
            if room[at] < need:
                at += 1
        left, place = room[at], at - self.size
        room[at] = left - need
        while at > 1:
            at //= 2
            room[at] = max(room[2 * at], room[2 * at + 1])
        return place, left


def first_fit_decreasing(lengths: list[int], length: int) -> list[tuple[int, int]]:
    """(sequence, offset) of each piece; longer pieces first, equal ones in the given order."""
    tree = Room(len(lengths), length)
    placed: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        sequence, left = tree.take(lengths[i])
        placed[i] = (sequence, length - left)
    return placed


def pack(
    docs: DataFrame,
    tokenizer: str,
    length: int = 4096,
    end_id: int = 2,
    group_tokens: int = 4_194_304,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``ids``, ``doc_tokens``, ``sequence_id``, ``offset``.

    ``ids`` are the piece's token ids as little-endian 32-bit numbers. A document is cut only
    where it fills whole sequences of ``length`` tokens; what is left of it is one piece. A group
    closes as soon as it holds ``group_tokens`` tokens (one document may go beyond).

    A null or empty text is one piece with the end id alone. Null ids and repeated rows are packed
    like any other row, each row on its own. No rows give no rows. Other columns are ignored.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    body = F.coalesce(F.col(text), F.lit(""))
    dealt = small_batches(docs).select(
        F.col(doc_id).alias("_id"), body.cast("binary").alias("_text")
    ).repartition(F.xxhash64("_id", "_text"))
    end = array("I", [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer)
        task, group, tokens = TaskContext.get().partitionId(), 0, 0
        pieces: list[tuple] = []

        def packed() -> Iterator[pa.RecordBatch]:
            places = first_fit_decreasing([len(p[2]) // 4 for p in pieces], length)
            base = (task << 40) + (group << 20)
            rows = max(1, OUT_BYTES // (4 * length))
            for first in range(0, len(pieces), rows):
                some, at = pieces[first : first + rows], places[first : first + rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([p[0] for p in some], id_type),
                        pa.array([p[1] for p in some], pa.int64()),
                        pa.array([len(p[2]) // 4 for p in some], pa.int64()),
                        pa.array([p[2] for p in some], pa.binary()),
                        pa.array([p[3] for p in some], pa.int64()),
                        pa.array([base + s for s, _ in at], pa.int64()),
                        pa.array([o for _, o in at], pa.int64()),
                    ],
                    names=[doc_id, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
                )

        for batch in batches:
            id_type = batch.schema.field(0).type
            for key, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = words.of(body.as_py()) + end
                count = len(ids) // 4
                for start in range(0, count, length):
                    pieces.append((key, start, ids[4 * start : 4 * (start + length)], count))
                tokens += count
                if tokens >= group_tokens:
                    yield from packed()
                    group, tokens = group + 1, 0
                    pieces.clear()
        if pieces:
            yield from packed()

    return dealt.mapInArrow(
        run,
        f"`{doc_id}` {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long",
    )
