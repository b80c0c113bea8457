"""Packing of tokenised documents into sequences of a fixed length by minimum bin slack.

Each document is tokenised once and cut into full windows and a rest; only lengths, places and
checksums go on. Rests are dealt by a hash into blocks of about ``BLOCK`` pieces. In a block
the multiset of remaining lengths fills one window after the other: the longest piece left
opens the window, and a subset-sum over bit sets (one bit per fill level, the counts of a length
split into powers of two) finds the fill closest to the capacity; walking the bit sets back
gives how many pieces of each length were taken. So a window is filled as well as its block
allows and memory is bounded by the block.

A sequence is padded to the capacity unless its length is a power of two.

Cases: a null text has no tokens, so its document is the end token alone; a null doc_id is
passed through; rows equal in doc_id and text are documents of their own; an empty table gives
no pieces. Only doc_id and text are read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.llm.common import stored, text_of

CAPACITY = 2048
#: Ends every document.
END = 1
#: Pieces that are packed together, on average.
BLOCK = 4096
#: Bytes of the words and of the runs whose tokens a task remembers, and what an entry takes besides.
REMEMBERED, ENTRY = 48 << 20, 200
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = f"{PIECES}, sequence_id long, offset long"


class Tokens(dict[bytes, bytes]):
    """Token ids of words, as little-endian unsigned 32-bit integers.

    For tokenizers that split at white space, keep runs of letters together, lower-case them and
    know them by their bytes. Words of Latin letters, perhaps with marks behind them, go to the
    model directly, as a run of letters and a run of marks are tokenised apart; all others take
    the tokenizer's whole way.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(x) for x in range(0x180) if chr(x).isalpha() and len(chr(x).lower()) == 1]
        #: how the model writes each letter, upper-case ones as lower-case
        self.written = {ord(x): level.pre_tokenize_str(x.lower())[0][0] for x in letters}
        # marks are one run too; an apostrophe may begin a contraction
        self.latin = re.compile("([" + "".join(letters) + r"]+)([!-&(-/:-@\[-`{-~]*)")
        self.runs: dict[str, bytes] = {}
        self.held = self.held_runs = 0
        self.written_ids = [x.to_bytes(4, "little") for x in range(self.tokenizer.get_vocab_size())]

    def of(self, text: bytes) -> bytes:
        """The ids of a text."""
        if self.held > REMEMBERED:
            self.clear()
            self.held = 0
        if self.held_runs > REMEMBERED:
            self.runs.clear()
            self.held_runs = 0
        return b"".join(map(self.__getitem__, text.split()))

    def __missing__(self, word: bytes) -> bytes:
        plain = word.decode()
        found = self.latin.fullmatch(plain)
        if found:
            run, mark = found.groups()
            ids = self._run(run.translate(self.written)) + (self._run(mark) if mark else b"")
        else:
            ids = np.array(self.tokenizer.encode(plain, add_special_tokens=False).ids, "<u4").tobytes()
        self[word] = ids
        self.held += len(word) + len(ids) + ENTRY
        return ids

    def _run(self, written: str) -> bytes:
        ids = self.runs.get(written)
        if ids is None:
            ids = self.runs[written] = b"".join(
                [self.written_ids[x.id] for x in self.model.tokenize(written)]
            )
            self.held_runs += len(written) + len(ids) + ENTRY
        return ids


_TOKENS: dict[str, Tokens] = {}


def tokens_of(path: str) -> Tokens:
    """One per Python worker."""
    if path not in _TOKENS:
        _TOKENS[path] = Tokens(path)
    return _TOKENS[path]


def pieces(documents: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Each document's tokens with the end token, cut after every ``capacity`` of them."""
    end = np.array([END], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(path)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = tokens.of(text.as_py()) + end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    part = ids[4 * start : 4 * (start + capacity)]
                    rows.append((doc, start, len(part) // 4, zlib.crc32(part), total))
            if rows:
                columns = [pa.array(x, pa.int64()) for x in zip(*rows, strict=True)]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = documents.select(documents["doc_id"].cast("long").alias("doc_id"), text_of(documents).cast("binary").alias("text"))
    return rows.mapInArrow(run, PIECES)


def best_fill(lengths: list[int], counts: list[int], capacity: int) -> dict[int, int]:
    """How many of each length to take for the largest sum that fits into ``capacity``.

    ``lengths`` are distinct and fall; earlier, longer ones are preferred among equal sums.
    """
    mask = (1 << (capacity + 1)) - 1
    reach = 1
    steps = []
    for length, count in zip(lengths, counts, strict=True):
        if length > capacity:
            continue
        count = min(count, capacity // length)
        part = 1
        while count:
            part = min(part, count)
            grown = (reach | reach << length * part) & mask
            if grown != reach:
                steps.append((reach, length, part))
                reach = grown
            count -= part
            part *= 2
        if reach >> capacity:
            break
    level = reach.bit_length() - 1
    taken: dict[int, int] = {}
    for before, length, part in reversed(steps):
        if not before >> level & 1:
            level -= length * part
            taken[length] = taken.get(length, 0) + part
    return taken


def fill_windows(lengths: list[int], capacity: int) -> Iterator[list[int]]:
    """Windows as lists of indices of the given lengths; every index once."""
    left: dict[int, list[int]] = {}
    for index, length in enumerate(lengths):
        left.setdefault(length, []).append(index)
    falling = sorted(left, reverse=True)
    while falling:
        longest = falling[0]
        window = [left[longest].pop()]
        sizes = [len(left[x]) for x in falling]
        for length, count in best_fill(falling, sizes, capacity - longest).items():
            window += [left[length].pop() for _ in range(count)]
        falling = [x for x in falling if left[x]]
        yield window


def pack(documents: DataFrame, path: str, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """The pieces of all documents with the sequence that holds them and their place in it."""
    # stored with a number per row: the blocks must not change if a task runs again
    cut = stored(pieces(documents, path, capacity).withColumn("row", F.monotonically_increasing_id()))
    full = cut.where(F.col("length") == capacity)
    rests = cut.where(F.col("length") < capacity)
    blocks = max(1, -(-rests.count() // block))

    def windows(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row", ignore_index=True)
        order, sequence, offset = [], [], []
        for number, window in enumerate(fill_windows(rows["length"].tolist(), capacity)):
            at = 0
            for index in window:
                order.append(index)
                sequence.append(number)
                offset.append(at)
                at += int(rows["length"][index])
        rows = rows.iloc[order].reset_index(drop=True)
        # ids of full windows are even, those of filled ones odd
        rows["sequence_id"] = (np.array(sequence, np.int64) * blocks + rows["block"]) * 2 + 1
        rows["offset"] = np.array(offset, np.int64)
        return rows[[x.split()[0] for x in PACKED.split(", ")]]

    dealt = rests.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    filled = dealt.groupBy("block").applyInPandas(windows, PACKED)
    whole = full.select(*cut.columns[:-1], (F.col("row") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return whole.unionByName(filled)


def padded_length(length: int, capacity: int = CAPACITY) -> int:
    """What a sequence of ``length`` tokens takes."""
    return length if length & (length - 1) == 0 else capacity
