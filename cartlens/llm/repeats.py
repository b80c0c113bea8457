"""Removal of repeated byte strings with an enhanced suffix array.

Every string of ``length`` bytes has an anchor: the smallest of the hashed short strings in
it. Equal strings have equal anchors at equal places, so all starts of strings that share an
anchor form a window, and windows can only share strings where their anchors are equal.

1. A scan turns each document into its windows: (anchor hash, window hash, document, place).
   Windows that are alike inside a batch of rows are combined there, so the shuffle sees a
   frequent window once per batch.
2. Shuffled by anchor, windows without a partner go. Windows with equal bytes are a repeat
   with all its occurrences at once; only the first of them goes on, and only if other
   windows share its anchor.
3. Those few windows get their bytes from the documents and enter suffix arrays, one for
   some anchors at a time. A stack scan over the common prefixes of neighbours walks the
   tree of prefix intervals; an interval whose occurrences are preceded by different bytes
   is a maximal repeat. The tree itself is the output: a row per repeat with its parent, and each
   occurrence once, at the longest repeat that holds it, so it grows with the windows and not
   with the pairs of nested repeats and occurrences. Occurrences in equal windows follow by a join.
   An anchor with more than ``most_windows`` different windows is compared string by string in a
   grouping instead, which names repeats of ``length`` bytes.
4. Occurrences other than the first cover bytes; covered bytes go.

Repeats are reported as far as a window reaches (up to ``2 * length`` bytes); a longer one is
a chain of overlapping groups, which cover the same bytes.

Cases: a null text is empty, texts shorter than ``length`` are left alone; a null doc_id sorts
first; rows equal in doc_id and text are one document (each gets its result), rows that share
only the doc_id are different documents, in the order of a checksum of their texts. Only the
columns doc_id and text are read; others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartlens.llm.common import flat, id_of, shown_id, stored, text_of

#: Bytes of the short strings from which anchors are chosen.
GRAM = 32
#: Bytes of text handled at a time, and of windows in one suffix array.
SLICE = 1 << 20
#: Low bits that hold the place inside a slice.
PLACE = (1 << 21) - 1
TAG_BITS = 24

WINDOWS = "salt int, h long, c long, doc long, at long, n int, copies int"
TEXTS = "h long, c long, doc long, at long, n int, bytes binary"
GROUPS = (
    "repeat long, length int, parent long, h long, c long, place int, doc long, at long, covered int"
)
#: Windows of an anchor in one suffix array: with 69 starts of 168 bytes each, under 100 MB of suffixes.
MOST_WINDOWS = 8192
REPORT = "doc long, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    return x


class _Rolling:
    """Hashes of all substrings of a slice, from sums of weighted byte values."""

    def __init__(self, base: int, longest: int):
        self.values = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(base | 1))
        self.up = self._powers(base, longest)
        self.down = self._powers(pow(base, -1, 2**64), longest)

    @staticmethod
    def _powers(base: int, count: int) -> np.ndarray:
        factors = np.full(count, base, np.uint64)
        factors[0] = 1
        return np.multiply.accumulate(factors)

    def sums(self, data: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.up[: len(data)], out=sums[1:])
        return sums

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (sums[end] - sums[start]) * self.down[start]


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of ``width`` values, by doubling."""
    reach = 1
    while reach * 2 <= width:
        values = np.minimum(values[: len(values) - reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _windows(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    gram = min(GRAM, length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = _Rolling(0xD1342543DE82EF95, SLICE + length + 1)
        whole = _Rolling(0xAF251AF3B0F025B5, SLICE + length + 1)

        def of_slice(data, ends, begin):
            """Anchor, window hash, start and number of starts of the windows of a slice."""
            count = min(SLICE, len(data) - begin)
            part = data[begin : begin + count + length - 1]
            if len(part) < length:
                return None
            sums = anchors.sums(part)
            grams = len(part) - gram + 1
            hashes = _mixed((sums[gram:] - sums[:-gram]) * anchors.down[:grams])
            keys = hashes & np.uint64(~PLACE & (2**64 - 1))
            keys |= np.arange(grams, dtype=np.uint64)
            chosen = _smallest(keys, length - gram + 1) & np.uint64(PLACE)
            starts = np.flatnonzero(
                np.arange(begin + length, begin + length + len(chosen)) <= ends[begin : begin + len(chosen)]
            )
            if not len(starts):
                return None
            chosen = chosen[starts].astype(np.int64)
            heads = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
            n = np.diff(np.r_[heads, len(chosen)])
            low = starts[heads]
            sums = whole.sums(part)
            c = whole.of(sums, low, low + n + length - 1)
            c = _mixed(c + n.astype(np.uint64))
            return hashes[chosen[heads]].view(np.int64), c.view(np.int64), low + begin, n

        for batch in batches:
            data, offsets = flat(batch.column("bytes"))
            sizes = np.diff(offsets)
            ends = np.repeat(offsets[1:].astype(np.int32), sizes)
            found = [x for b in range(0, len(data), SLICE) if (x := of_slice(data, ends, b))]
            if not found:
                continue
            h, c, low, n = (np.concatenate(x) for x in zip(*found, strict=True))
            row = np.searchsorted(offsets, low, "right") - 1
            doc = batch.column("doc").to_numpy()[row]
            at = ((low - offsets[row]) << TAG_BITS) | batch.column("tag").to_numpy()[row]
            order = np.lexsort((at, at & ((1 << TAG_BITS) - 1), doc, c, h))
            h, c, doc, at, n = (x[order] for x in (h, c, doc, at, n))
            head = np.r_[True, (h[1:] != h[:-1]) | (c[1:] != c[:-1])]
            group = np.cumsum(head) - 1
            size = np.bincount(group)
            place = np.flatnonzero(head)[group]
            same = ~head & (doc == doc[place]) & (at == at[place])  # repeated rows
            copies = np.where(head, size[group], 0)
            # a local copy needs no partner elsewhere, so its key is spread
            salt = np.where(head, 0, 1 + (doc ^ at) % 1009)
            keep = ~same
            columns = (salt.astype(np.int32), h, c, doc, at, n.astype(np.int32), copies.astype(np.int32))
            names = ["salt", "h", "c", "doc", "at", "n", "copies"]
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in columns], names)

    return run


def _texts(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The bytes of the windows wanted from each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, doc, wanted in zip(
                *(batch.column(x).to_pylist() for x in ("bytes", "doc", "wanted")), strict=True
            ):
                for x in wanted or ():
                    start = x["at"] >> TAG_BITS
                    rows.append((x["h"], x["c"], doc, x["at"], x["n"], text[start : start + x["n"] + length - 1]))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
                columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["h", "c", "doc", "at", "n", "bytes"])

    return run


class Tree(NamedTuple):
    """Maximal repeats as nodes, and the suffixes that lie in one."""

    size: np.ndarray
    parent: np.ndarray  # the next shorter one that holds all its occurrences, or -1
    first: np.ndarray  # the suffix that comes before all others
    node: np.ndarray  # of each suffix, the longest node that holds it, or -1
    text: np.ndarray
    place: np.ndarray
    covered: np.ndarray  # of each suffix, the size of the longest node in which it is not the first


def maximal_repeats(texts: list[bytes], starts: list[int], length: int, rank: Callable | None = None) -> Tree:
    """The tree of maximal repeats of at least ``length`` bytes.

    Of ``texts[i]`` the first ``starts[i]`` suffixes are entered. A suffix at the very start of
    its text counts as preceded by a byte of its own. An interval of the suffix array holds those
    inside it, and if different bytes precede its suffixes, so they do in the intervals around it: what
    is kept is the upper part of the tree, a row per interval, and each suffix once, at its deepest
    one. The occurrences of a node are its own suffixes and those of the nodes below. ``rank`` gives the
    order of (text, place) pairs; by default they are ordered as they are.
    """
    sizes = np.array([len(x) for x in texts])
    counts = np.array(starts)
    width = int(sizes.max())
    room = width + int(counts.max())
    data = np.frombuffer(b"".join([x.ljust(room, b"\0") for x in texts]), np.uint8)
    origin = np.arange(len(texts)) * room
    text = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    rows = np.lib.stride_tricks.sliding_window_view(data, width)[origin[text] + place]
    left_of = sizes[text] - place
    order = np.argsort(np.ascontiguousarray(rows).view(f"S{width}").ravel(), kind="stable")
    rows, text, place, left_of = rows[order], text[order], place[order], left_of[order]
    differs = rows[1:] != rows[:-1]
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
    common = np.minimum(common, np.minimum(left_of[1:], left_of[:-1]))
    before = np.where(place > 0, data[origin[text] + place - 1], -1 - np.arange(len(text)))
    node = np.full(len(text), -1)
    covered = np.zeros(len(text), np.int64)
    size: list[int] = []
    parent: list[int] = []
    firsts: list[int] = []
    long = np.r_[False, common >= length, False]
    first, last = np.flatnonzero(~long[:-1] & long[1:]), np.flatnonzero(long[:-1] & ~long[1:])
    bounds = np.c_[first, last + 1].ravel()
    bounds = bounds[:-1] if len(bounds) and bounds[-1] == len(before) else bounds
    if len(first):
        diverse = np.minimum.reduceat(before, bounds)[::2] != np.maximum.reduceat(before, bounds)[::2]
        first, last = first[diverse], last[diverse]
        place_in_order = np.empty(len(text), np.int64)
        place_in_order[np.lexsort((place, text)) if rank is None else rank(text, place)] = np.arange(len(text))
    #: the next suffix that has no node yet, found by following and shortening the way
    free = list(range(len(text) + 1))

    def next_free(i: int) -> int:
        while free[i] != i:
            free[i] = free[free[i]]
            i = free[i]
        return i

    for begin, end in zip(first, last + 1, strict=True):
        # open intervals: common prefix, first place, the one byte before all or None, earliest, nodes inside
        stack: list[list] = []
        for i in range(begin + 1, end + 1):
            height = int(common[i - 1]) if i < end else 0
            low, byte, early, inside = i - 1, int(before[i - 1]), i - 1, []
            while stack and stack[-1][0] > height:
                own_size, low, own_byte, own_early, own_inside = stack.pop()
                byte = byte if own_byte == byte else None
                early = min(early, own_early, key=place_in_order.__getitem__)
                inside = own_inside + inside
                if byte is None:
                    new = len(size)
                    size.append(own_size)
                    parent.append(-1)
                    firsts.append(early)
                    for x in inside:
                        parent[x] = new
                    j = next_free(low)
                    while j < i:
                        node[j], free[j] = new, j + 1
                        j = next_free(j)
                    inside = [new]
            if height and (not stack or stack[-1][0] < height):
                stack.append([height, low, byte, early, inside])
            elif height:
                top = stack[-1]
                top[2] = top[2] if top[2] == byte else None
                top[3] = min(top[3], early, key=place_in_order.__getitem__)
                top[4] = top[4] + inside
    tree = Tree(np.array(size, np.int64), np.array(parent, np.int64), np.array(firsts, np.int64), node, text, place, covered)
    if len(size):
        held = node >= 0
        covered[held] = tree.size[node[held]]
        # the first of a node is covered only by a node above in which another one is the first
        covered[tree.first] = 0
        up = np.flatnonzero(tree.parent >= 0)
        up = up[tree.first[tree.parent[up]] != tree.first[up]]
        covered[tree.first[up]] = tree.size[tree.parent[up]]
    return tree


def _arrays(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Suffix arrays over windows sorted by anchor, some whole anchors at a time.

    A row per maximal repeat (doc is null) and per suffix in one: both grow with the windows alone.
    """

    def groups(rows: list[tuple]) -> pa.RecordBatch | None:
        h, c, doc, at = (np.array([x[i] for x in rows], np.int64) for i in range(4))
        texts = [x[5] for x in rows]

        def order(text: np.ndarray, place: np.ndarray) -> np.ndarray:
            where = at[text]
            return np.lexsort(((where >> TAG_BITS) + place, where & ((1 << TAG_BITS) - 1), doc[text]))

        tree = maximal_repeats(texts, [x[4] for x in rows], length, order)
        if not len(tree.size):
            return None
        name = np.empty(len(tree.size), np.int64)
        for i, (size, early) in enumerate(zip(tree.size, tree.first, strict=True)):
            start = tree.place[early]
            digest = xxhash.xxh64_intdigest(texts[tree.text[early]][start : start + size])
            name[i] = digest - 2**64 if digest >= 2**63 else digest
        member = np.flatnonzero(tree.node >= 0)
        own, text, place = tree.node[member], tree.text[member], tree.place[member]
        anchor = h[tree.text[tree.first]]
        parent = pa.array(name[np.maximum(tree.parent, 0)], mask=tree.parent < 0)
        nothing = len(tree.size)

        def column(nodes: np.ndarray, members: np.ndarray | None, kind: pa.DataType) -> pa.Array:
            below = pa.nulls(len(member), kind) if members is None else pa.array(members).cast(kind)
            return pa.concat_arrays([pa.nulls(nothing, kind) if nodes is None else pa.array(nodes).cast(kind), below])

        columns = {
            "repeat": column(name, name[own], pa.int64()),
            "length": column(tree.size, tree.size[own], pa.int32()),
            "parent": pa.concat_arrays([parent, pa.nulls(len(member), pa.int64())]),
            "h": column(anchor, h[text], pa.int64()),
            "c": column(None, c[text], pa.int64()),
            "place": column(None, place, pa.int32()),
            "doc": column(None, doc[text], pa.int64()),
            "at": column(None, at[text] + (place << TAG_BITS), pa.int64()),
            "covered": column(None, tree.covered[member], pa.int32()),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            for row in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if rows and row[:4] == rows[-1][:4]:  # repeated rows are one document
                    continue
                if held >= SLICE and row[0] != rows[-1][0]:
                    if found := groups(rows):
                        yield found
                    rows, held = [], 0
                rows.append(row)
                held += len(row[5])
        if rows and (found := groups(rows)):
            yield found

    return run


def _documents(documents: DataFrame) -> DataFrame:
    text = text_of(documents).cast("binary")
    tag = F.crc32(text).bitwiseAND((1 << TAG_BITS) - 1)
    return documents.select(id_of(documents).alias("doc"), tag.alias("tag"), text.alias("bytes"))


def _tag() -> Column:
    return F.col("at").bitwiseAND((1 << TAG_BITS) - 1)


def _order() -> Column:
    """Earlier documents and places first."""
    return F.struct("doc", _tag().alias("tag"), "at")


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def repeat_groups(documents: DataFrame, length: int = 100, most_windows: int = MOST_WINDOWS) -> tuple[DataFrame, DataFrame]:
    """All maximal repeats of at least ``length`` bytes, and where they occur.

    The first table has repeat (names the bytes), length and parent: a shorter repeat that occurs
    wherever this one does, at the same places. The second has repeat, doc and at (place and checksum
    of the text): every occurrence once, at the longest repeat that holds it. So a repeat occurs
    where it and those below it do, and both tables grow with the windows of the documents.
    """
    found = _Repeats(_by_document(documents), _documents(documents), length, most_windows)
    return found.groups(), found.occurrences()


def _by_document(documents: DataFrame) -> DataFrame:
    texts = _documents(documents)
    return texts.repartition(_partitions(documents), "doc", "tag")


class _Repeats:
    """The windows of documents and what is found by comparing those of equal anchors."""

    def __init__(self, dealt: DataFrame, texts: DataFrame, length: int, most_windows: int):
        self.length = length
        same = Window.partitionBy("salt", "h", "c").orderBy("doc", _tag(), "at")
        anchor = Window.partitionBy("salt", "h")
        windows = (
            texts.mapInArrow(_windows(length), WINDOWS)
            .repartition(_partitions(texts), "salt", "h")
            .withColumn("first", (F.col("salt") == 0) & (F.rank().over(same) == 1))
            .withColumn("different", F.sum(F.col("first").cast("int")).over(anchor))
            .withColumn("windows", F.count("*").over(anchor))
            .where("salt > 0 or windows > 1 or copies > 1")
            .withColumn("compared", F.expr("first and different > 1"))
            .select("h", "c", "doc", "at", "n", "first", "compared", "different")
        )
        self.windows = stored(windows)
        wanted = (
            self.windows.where("compared")
            .groupBy("doc", _tag().alias("tag"))
            .agg(F.collect_list(F.struct("h", "c", "at", "n")).alias("wanted"))
        )
        bytes_of = (
            dealt.join(wanted, ["doc", "tag"], "left")
            .select("doc", "bytes", "wanted")
            .mapInArrow(_texts(length), TEXTS)
        )
        crowded = self.windows.where(F.col("compared") & (F.col("different") > most_windows)).select("h").distinct()
        self.crowded = not crowded.isEmpty()
        few = bytes_of.join(crowded, "h", "left_anti") if self.crowded else bytes_of
        self.trees = (
            few.repartition(_partitions(texts), "h")
            .sortWithinPartitions("h", "doc", "at")
            .mapInArrow(_arrays(length), GROUPS)
        )
        self.strings = _by_string(bytes_of.join(crowded, "h", "left_semi"), length) if self.crowded else None

    def _places(self) -> DataFrame:
        """The windows, those of repeated rows once."""
        return self.windows.dropDuplicates(["h", "c", "doc", "at"])

    def _alike(self) -> DataFrame:
        """Windows of equal bytes, which are a repeat in full: h, c, length and the repeat they start with.

        Unless the tree has a repeat of just these bytes, which other windows hold inside them.
        """
        counts = self._places().groupBy("h", "c").agg(
            F.count(F.lit(1)).alias("places"), (F.min("n") + self.length - 1).alias("length")
        )
        starts = self.trees.where("place = 0").select(
            "h", "c", F.col("repeat").alias("parent"), F.col("length").alias("inside")
        )
        several = counts.where("places > 1").join(starts, ["h", "c"], "left")
        return several.where("inside is null or inside < length").select("h", "c", "length", "parent")

    def groups(self) -> DataFrame:
        trees = self.trees.where("doc is null").select("repeat", "length", "parent")
        found = trees.unionByName(self._alike().select(F.col("c").alias("repeat"), "length", "parent"))
        if self.strings is None:
            return found
        single = self.strings.select("repeat", F.lit(self.length).alias("length"), F.lit(None).cast("long").alias("parent"))
        return found.unionByName(single.distinct())

    def occurrences(self) -> DataFrame:
        # a suffix stands for the same place in all windows that equal its own
        members = self.trees.where("doc is not null").select("repeat", "h", "c", "place")
        alike = self._alike().select("h", "c")
        # the start of a repeated window is held by the window, which is longer
        members = members.join(alike.withColumn("place", F.lit(0)), ["h", "c", "place"], "left_anti")
        whole = alike.select(F.col("c").alias("repeat"), "h", "c", F.lit(0).alias("place"))
        shift = F.shiftleft(F.col("place").cast("long"), TAG_BITS)
        found = (
            members.unionByName(whole)
            .join(self._places().select("h", "c", "doc", "at"), ["h", "c"])
            .select("repeat", "doc", (F.col("at") + shift).alias("at"))
        )
        return found if self.strings is None else found.unionByName(self.strings.select("repeat", "doc", "at"))

    def covered(self) -> DataFrame:
        """doc, at, covered: occurrences that are not the first of theirs, and how many bytes they cover."""
        trees = self.trees.where("covered > 0").select("doc", "at", "covered")
        copies = self.windows.where("not first").select("doc", "at", (F.col("n") + self.length - 1).alias("covered"))
        found = trees.unionByName(copies)
        if self.strings is None:
            return found
        return found.unionByName(self.strings.where("not first").select("doc", "at", F.lit(self.length).alias("covered")))


def _by_string(windows: DataFrame, length: int) -> DataFrame:
    """The repeats of ``length`` bytes of anchors with very many windows, by grouping."""
    strings = windows.select(
        "doc",
        "at",
        F.posexplode(
            F.expr(f"transform(sequence(0, n - 1), i -> substring(bytes, i + 1, {length}))")
        ).alias("i", "string"),
    ).select("doc", (F.col("at") + F.shiftleft(F.col("i").cast("long"), TAG_BITS)).alias("at"), "string")
    earliest = (
        strings.groupBy("string")
        .agg(F.min(_order()).alias("earliest"), F.count("*").alias("places"))
        .where("places > 1")
    )
    return strings.join(earliest, "string").select(
        F.xxhash64("string").alias("repeat"), "doc", "at", (_order() == F.col("earliest")).alias("first")
    )


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted maximal runs of the ranges."""
    runs: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if runs and start <= runs[-1][1]:
            if end > runs[-1][1]:
                runs[-1] = (runs[-1][0], end)
        else:
            runs.append((start, end))
    return runs


def _report(digest: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64()]
        kinds.append(pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
        kinds.append(pa.string() if digest else pa.binary())
        names = ["doc", "n_bytes", "n_removed", "spans", "kept_sha256" if digest else "kept"]
        for batch in batches:
            rows = []
            for text, doc, covered in zip(
                *(batch.column(x).to_pylist() for x in ("bytes", "doc", "covered")), strict=True
            ):
                spans = merged([(x["start"], x["end"]) for x in covered or ()])
                edges = [0, *(x for span in spans for x in span), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                rows.append(
                    (
                        doc,
                        len(text),
                        len(text) - len(kept),
                        [{"start": a, "end": b} for a, b in spans],
                        hashlib.sha256(kept).hexdigest() if digest else kept,
                    )
                )
            columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else []
            if rows:
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def remove_repeats(
    documents: DataFrame, length: int = 100, most_windows: int = MOST_WINDOWS, digest: bool = False
) -> DataFrame:
    """Documents without the bytes of strings of ``length`` bytes that also start earlier.

    Columns: doc_id, n_bytes, n_removed, spans (the removed runs) and kept, the remaining
    bytes, or with ``digest`` only their SHA-256.
    """
    dealt = _by_document(documents)
    found = _Repeats(dealt, _documents(documents), length, most_windows).covered()
    start = F.shiftright("at", TAG_BITS)
    covered = found.groupBy("doc", _tag().alias("tag")).agg(
        F.collect_set(F.struct(start.alias("start"), (start + F.col("covered")).alias("end"))).alias("covered")
    )
    schema = REPORT + (", kept_sha256 string" if digest else ", kept binary")
    report = (
        dealt.join(covered, ["doc", "tag"], "left")
        .select("doc", "bytes", "covered")
        .mapInArrow(_report(digest), schema)
    )
    return report.select(shown_id("doc").alias("doc_id"), *report.columns[1:])
