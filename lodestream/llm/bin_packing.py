"""Packing documents into fixed-size sequences by bin completion.

Pieces of the same length are interchangeable, so the search runs on the counts
of the (at most ``capacity``) lengths: a table whose size does not depend on the
corpus. Its answer is a list of fillings with multiplicities, which is dealt to
the pieces by their position among the pieces of their length.
"""

from __future__ import annotations

import sys
import types
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lodestream.llm.shared import cut, positions

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
# Branches looked at before the best solution so far is taken.
NODES = 40
BRANCHES = 6
_CACHED_WORDS = 1_000_000
_CACHED_LENGTH = 48


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: a printable character per byte, applied to Latin-1 text."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in printable]
    letters = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
    return {i: "".join(letters[b] for b in chr(i).encode()) for i in range(256)}


_LETTERS = _byte_letters()


class Chunks(dict):
    """Packed ids (little-endian unsigned 32-bit) of the chunks seen first.

    The vocabulary splits a chunk into runs of letters, digits and marks and never
    joins across them; so a plain chunk is put together from its runs.
    """

    def __init__(self, path: str):
        super().__init__()
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.plain = regex.compile(r"[\x21-\x7e\xa1-\xac\xae-\xff]+")
        self.runs = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")

    def __missing__(self, chunk: str) -> bytes:
        runs = self.runs.findall(chunk.lower()) if "<|" not in chunk and self.plain.fullmatch(chunk) else ()
        if len(runs) > 1:
            packed = b"".join([self[run] for run in runs])
        elif runs:
            # What the tokenizer's earlier steps make of a plain run: bytes as letters.
            ids = [token.id for token in self.model.tokenize(runs[0].translate(_LETTERS))]
            packed = np.array(ids, "<u4").tobytes()
        else:
            packed = np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self) < _CACHED_WORDS and len(chunk) <= _CACHED_LENGTH:
            self[chunk] = packed
        return packed


class Encoder:
    """Encodes a text chunk by chunk.

    The vocabulary drops white space, never joins across it and is lower case, so
    blank-separated chunks can be encoded by themselves, and frequent ones are
    remembered. Lower-casing first is left to the tokenizer where the text has
    characters outside Latin-1, whose case mapping depends on their neighbours.
    """

    def __init__(self, path: str):
        self.known = Chunks(path)

    @staticmethod
    def kept(path: str) -> Encoder:
        """The worker process's encoder, so that its tasks share what is remembered."""
        store = sys.modules.setdefault("lodestream_worker_store", types.ModuleType("lodestream_worker_store"))
        encoders = store.__dict__.setdefault("encoders", {})
        if path not in encoders:
            encoders[path] = Encoder(path)
        return encoders[path]

    def encode(self, text: str) -> bytes:
        try:
            text.encode("latin-1")
            text = text.lower() if "<|" not in text else text
        except UnicodeEncodeError:
            pass
        return b"".join(map(self.known.__getitem__, text.replace("\n", " ").split(" ")))


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: its place in the document and the checksum of its ids.

    A null text counts as empty; every document ends with id 0, so it has at
    least one piece. Only documents longer than ``capacity`` are cut. ``tokenizer``
    is the file's path on the executors (default: the installed public one).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.kept(tokenizer or tokenizer_path())
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.encode(text.as_py() or "") + b"\0\0\0\0"
                for k, start in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[start : start + 4 * capacity]
                    for column, value in zip(rows, (doc_id, k, start // 4, len(part) // 4, zlib.crc32(part))):
                        column.append(value)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


Filling = tuple[int, ...]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins needed at least: by total, and with items too large to share a bin."""
    by_size = np.zeros(capacity + 1, np.int64)
    for size, n in counts.items():
        by_size[size] = n
    below = np.concatenate([[0], np.cumsum(by_size)])
    mass = np.concatenate([[0], np.cumsum(by_size * np.arange(capacity + 1))])
    best = -(-int(mass[-1]) // capacity)
    half = capacity // 2
    for k in range(half + 1):
        alone = int(below[-1] - below[capacity - k + 1])
        large = int(below[capacity - k + 1] - below[half + 1])
        free = large * capacity - int(mass[capacity - k + 1] - mass[half + 1])
        rest = int(mass[half + 1] - mass[k])
        best = max(best, alone + large + max(0, -(-(rest - free) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """Best-fit decreasing, a length at a time: fullest bins that still fit first."""
    open_bins: dict[int, list[list]] = {}
    for size in sorted(counts, reverse=True):
        n = counts[size]
        while n:
            room = next((r for r in range(size, capacity + 1) if open_bins.get(r)), None)
            if room is None:
                each = capacity // size
                full, odd = divmod(n, each)
                for much, times in ((each, full), (odd, 1 if odd else 0)):
                    if times:
                        open_bins.setdefault(capacity - size * much, []).append([(size,) * much, times])
                n = 0
                continue
            filling, times = open_bins[room].pop()
            each = room // size
            use = min(times, n // each)
            if use:
                open_bins.setdefault(room - each * size, []).append([filling + (size,) * each, use])
                n -= use * each
                if times > use:
                    open_bins[room].append([filling, times - use])
            else:
                open_bins.setdefault(room - n * size, []).append([filling + (size,) * n, 1])
                n = 0
                if times > 1:
                    open_bins[room].append([filling, times - 1])
    return [(tuple(f), t) for bins in open_bins.values() for f, t in bins]


def _dominated(filling: Filling, other: Filling) -> bool:
    """Whether the items of ``filling`` fit, grouped, into single items of ``other``."""
    if filling == other or sum(filling) > sum(other):
        return False
    rooms = list(other)

    def place(k: int) -> bool:
        if k == len(filling):
            return True
        tried = set()
        for i, room in enumerate(rooms):
            if room >= filling[k] and room not in tried:
                tried.add(room)
                rooms[i] -= filling[k]
                if place(k + 1):
                    return True
                rooms[i] += filling[k]
        return False

    return place(0)


def completions(left: np.ndarray, room: int, most: int) -> list[Filling]:
    """Undominated fillings of ``room`` by the remaining lengths, fullest first."""
    if left[room]:
        return [(room,)]
    first = _fill(left, room)
    if most == 1 or not first:
        return [first]
    found = {first}
    for a in np.flatnonzero(left[: room + 1])[::-1][: 4 * most].tolist():
        left[a] -= 1
        found.add(tuple(sorted((a, *_fill(left, room - a)), reverse=True)))
        left[a] += 1
    kept: list[Filling] = []
    for filling in sorted(found, key=lambda f: (-sum(f), len(f))):
        if not any(_dominated(filling, k) for k in kept):
            kept.append(filling)
            if len(kept) == most:
                break
    return kept


def _pair(left: np.ndarray, room: int) -> Filling:
    """The fullest filling by one or two items, the larger item as large as can be."""
    if room < 1:
        return ()
    sizes = np.arange(room + 1)
    there = left[: room + 1] > 0
    # The largest item that fits beside each a; beside its own length only if there are two.
    below = np.maximum.accumulate(np.where(there, sizes, 0))
    partner = below[np.minimum(sizes, room - sizes)]
    alike = (partner == sizes) & (left[: room + 1] < 2)
    partner = np.where(alike, np.concatenate([[0], below[:-1]])[partner], partner)
    sums = np.where(there, sizes + partner, 0)
    a = room - int(np.argmax(sums[::-1]))
    if not sums[a]:
        return ()
    return (a, int(partner[a])) if partner[a] else (a,)


def _fill(left: np.ndarray, room: int, tries: int = 16) -> Filling:
    """The fullest filling found: an exact one of up to three items if the first
    tries show one, else the fullest of these, with what still fits beside it."""
    best = _pair(left, room)
    if sum(best) < room:
        for a in np.flatnonzero(left[: room + 1])[::-1][:tries].tolist():
            left[a] -= 1
            filling = (a, *_pair(left, room - a))
            left[a] += 1
            if sum(filling) > sum(best):
                best = filling
                if sum(best) == room:
                    break
    rest = room - sum(best)
    if best and rest and left[: rest + 1].any():
        for a in best:
            left[a] -= 1
        more = _fill(left, rest, 1)
        for a in best:
            left[a] += 1
        best = (*best, *more)
    return tuple(sorted(best, reverse=True))


def _times(left: np.ndarray, filling: Filling) -> int:
    sizes, counts = np.unique(filling, return_counts=True)
    return int((left[sizes] // counts).min())


def bin_completion(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> list[tuple[Filling, int]]:
    """Fillings and how often each is used; every item is used exactly once.

    Depth-first over the fillings of the largest item left. A filling is used as
    often as it can be at once. A branch is left when its waste exceeds what a
    better solution than the incumbent may waste. Best-fit decreasing is the first
    incumbent; the search ends when the lower bound is met or after ``nodes``
    returns to an earlier choice.
    """
    counts = {s: n for s, n in counts.items() if n}
    if not counts:
        return []
    if max(counts) > capacity or min(counts) < 1:
        raise ValueError("lengths must lie between 1 and the capacity")
    bound, total = lower_bound(counts, capacity), sum(s * n for s, n in counts.items())
    incumbent = best_fit(counts, capacity)
    bins = sum(n for _, n in incumbent)
    left = np.zeros(capacity + 1, np.int64)
    for s, n in counts.items():
        left[s] = n

    @dataclass
    class Step:
        options: list[Filling]
        all: bool = False
        at: int = 0
        used: int = 0
        times: int = 0
        filling: Filling = field(default=())

    path: list[Step] = []
    waste = used = returns = 0

    def descend() -> bool:
        """Try the next option of the last step; False if none is left or allowed."""
        nonlocal waste, used
        step = path[-1]
        if step.at == len(step.options) and not step.all:
            # The other fillings are only listed when the first one is taken back.
            step.options += [f for f in options(BRANCHES) if f not in step.options]
            step.all = True
        while step.at < len(step.options):
            filling = step.options[step.at]
            step.at += 1
            times = _times(left, filling)
            # A better solution has at most bins - 1 bins.
            if waste + (capacity - sum(filling)) * times > (bins - 1) * capacity - total:
                times = int(((bins - 1) * capacity - total - waste) // max(1, capacity - sum(filling)))
                if times < 1:
                    continue
            for s in filling:
                left[s] -= times
            waste += (capacity - sum(filling)) * times
            used += times
            step.filling, step.times = filling, times
            return True
        return False

    def undo() -> None:
        nonlocal waste, used
        step = path[-1]
        for s in step.filling:
            left[s] += step.times
        waste -= (capacity - sum(step.filling)) * step.times
        used -= step.times
        step.times, step.filling = 0, ()

    def options(most: int) -> list[Filling]:
        largest = int(np.flatnonzero(left)[-1])
        left[largest] -= 1
        out = [(largest, *f) for f in completions(left, capacity - largest, most)]
        left[largest] += 1
        return out

    while bins > bound:
        if not left.any():
            if used < bins:
                incumbent, bins = [(s.filling, s.times) for s in path], used
        else:
            path.append(Step(options(1)))
            if descend():
                continue
            path.pop()
        # Go back to the nearest choice with another option.
        while path:
            undo()
            returns += 1
            if returns <= nodes and descend():
                break
            path.pop()
        if not path or returns > nodes:
            break
    return incumbent


def pack(rows: DataFrame, capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` of 1..capacity.

    Needs the columns ``doc_id, piece, start, length, ids_crc32``. Repeated rows
    are packed as often as they occur.
    """
    placed = positions(rows, ["length"], ["doc_id", "piece"])
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}
    dealt: dict[int, list[tuple[int, int, int, int]]] = {}
    taken = dict.fromkeys(counts, 0)
    sequence = 0
    for filling, times in bin_completion(counts, capacity, nodes):
        at = 0
        for size in sorted(set(filling), reverse=True):
            each = filling.count(size)
            dealt.setdefault(size, []).append((taken[size], each, sequence, at))
            taken[size] += each * times
            at += each * size
        sequence += times
    # At most one entry per length and filling: bounded by the lengths there are.
    tables = {size: np.array(t, np.int64) for size, t in dealt.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, pos = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "_pos"))
            sequence_id, offset = np.zeros(len(pos), np.int64), np.zeros(len(pos), np.int64)
            for size in np.unique(length).tolist():
                own = np.flatnonzero(length == size)
                table = tables[size]
                row = table[np.searchsorted(table[:, 0], pos[own], "right") - 1]
                k = pos[own] - row[:, 0]
                sequence_id[own] = row[:, 2] + k // row[:, 1]
                offset[own] = row[:, 3] + k % row[:, 1] * size
            keep = [i for i, n in enumerate(batch.schema.names) if n != "_pos"]
            arrays = [*(batch.column(i) for i in keep), pa.array(sequence_id), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*(batch.schema.names[i] for i in keep), "sequence_id", "offset"])

    return placed.mapInArrow(run, f"{PIECES}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Cut, tokenize and pack whole documents (doc_id, text)."""
    return pack(cut(pieces(docs, tokenizer, capacity)), capacity)
