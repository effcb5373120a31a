"""Removal of long repeated byte strings with suffix arrays built by induced sorting.

Equal strings of ``length`` bytes have the same smallest gram (by hash) at the
same place, so every document's grams that are smallest in some window are its
anchors, and a repeated string lies around equal anchors. Around each anchor the
bytes that such strings can reach are its context. Contexts that occur twice as a
whole are repeated throughout. The different contexts of an anchor meet in a
shard, named after the first document that has the anchor and the stretch of it
where it lies, so that neighbouring anchors share shards. There contexts are cut
to what they share with any other, those of a document are joined where they
touch, and the suffix array (SA-IS) with permuted common prefixes says which
positions start a string that also starts elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.llm.shared import cut, present, whole

LENGTH = 400
GRAM = 128
# Stretch of a document that names a shard, and the number of different contexts of
# one anchor beyond which its strings are compared by hash instead, which splits them.
STRETCH = 2048
CROWD = 4096
_SEGMENT = 1 << 22
_OVER = np.uint64((1 << 24) - 1)


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    out = np.ones(n, np.uint64)
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out)


def window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of the ``width`` bytes from each position that has them: differences
    of prefix sums of a polynomial, scaled back to the window's start and mixed."""
    n = len(data) - width + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_powers(_BASE, len(data)) * (data.astype(np.uint64) + np.uint64(7)), out=sums[1:])
    out = (sums[width:] - sums[:n]) * _powers(_INVERSE, n)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xFF51AFD7ED558CCD)
    out ^= out >> np.uint64(32)
    return out * np.uint64(0xC4CEB9FE1A85EC53)


def anchors(data: bytes, length: int = LENGTH) -> np.ndarray:
    """Positions of the grams that are first smallest in some window of ``length`` bytes."""
    span = length - GRAM + 1
    found = []
    for at in range(0, max(1, len(data) - length + 1), _SEGMENT):
        part = np.frombuffer(data, np.uint8, count=min(len(data) - at, _SEGMENT + length - 1), offset=at)
        n = len(part) - GRAM + 1
        if n < span:
            continue
        ranked = (window_hashes(part, GRAM) & ~_OVER) | np.arange(n, dtype=np.uint64)
        # Minimum of each run of ``span`` values: of the end of one block and the start of the next.
        padded = np.full(-(-n // span) * span, np.iinfo(np.uint64).max, np.uint64)
        padded[:n] = ranked
        blocks = padded.reshape(-1, span)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[: n - span + 1], ahead[span - 1 : n])
        changes = np.concatenate([[True], least[1:] != least[:-1]])
        found.append((least[changes] & _OVER).astype(np.int64) + at)
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def context(data: bytes, at: int, length: int = LENGTH) -> tuple[int, bytes]:
    """Start and bytes of what strings of ``length`` bytes around an anchor can reach."""
    start = max(0, at - (length - GRAM))
    return start, data[start : at + length]


def suffix_array(text: list[int], symbols: int) -> list[int]:
    """Suffix array by induced sorting; ``text`` ends with a unique smallest 0."""
    n = len(text)
    if n == 1:
        return [0]
    values = np.array(text, np.int64)
    # Classify: S-type (True) if smaller than the suffix to its right.
    change = np.flatnonzero(values[:-1] != values[1:])
    stype = np.zeros(n, bool)
    runs = np.concatenate([change, [n - 1]])
    starts = np.concatenate([[0], change + 1])
    up = np.zeros(len(runs), bool)
    up[:-1] = values[change] < values[change + 1]
    up[-1] = True
    stype = np.repeat(up, runs - starts + 1)
    lms = np.flatnonzero(stype[1:] & ~stype[:-1]) + 1
    sizes = np.bincount(values, minlength=symbols)
    ends = np.cumsum(sizes)
    heads_of, tails_of = (ends - sizes).tolist(), ends.tolist()
    # Symbol before each position where that is larger (or smaller) than its follower, else -1;
    # the last entry answers for places of the array that are still empty (-1).
    larger, smaller = np.full(n + 1, -1, np.int64), np.full(n + 1, -1, np.int64)
    larger[1:n] = np.where(stype[:-1], -1, values[:-1])
    smaller[1:n] = np.where(stype[:-1], values[:-1], -1)
    before_l, before_s = larger.tolist(), smaller.tolist()

    def induce(order: list[int]) -> list[int]:
        sa = [-1] * n
        tails = tails_of.copy()
        for i in reversed(order):
            c = text[i]
            tails[c] -= 1
            sa[tails[c]] = i
        heads = heads_of.copy()
        # Both scans read places that they have filled ahead of themselves.
        for i in sa:
            c = before_l[i]
            if c >= 0:
                at = heads[c]
                sa[at] = i - 1
                heads[c] = at + 1
        tails = tails_of.copy()
        for i in reversed(sa):
            c = before_s[i]
            if c >= 0:
                at = tails[c] = tails[c] - 1
                sa[at] = i - 1
        return sa

    if len(lms) == 0:
        return induce([])
    first = induce(lms.tolist())
    # Name the leftmost-smaller substrings in their sorted order.
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    ordered = np.array(first, np.int64)
    ordered = ordered[is_lms[ordered]]
    upto = np.full(n, n - 1, np.int64)
    upto[lms[:-1]] = lms[1:]
    raw = values.astype("<u4").tobytes()
    names = np.zeros(n, np.int64)
    name, last = 0, b""
    for k, i in enumerate(ordered.tolist()):
        piece = raw[4 * i : 4 * (int(upto[i]) + 1)]
        if k and piece != last:
            name += 1
        names[i] = name
        last = piece
    reduced = names[lms]
    if name + 1 == len(lms):
        order = lms[np.argsort(reduced, kind="stable")]
    else:
        order = lms[np.array(suffix_array(reduced.tolist(), name + 1), np.int64)]
    return induce(order.tolist())


def permuted_prefixes(text: bytes, sa: list[int]) -> np.ndarray:
    """For each position, the bytes it shares with the suffix before it in the array."""
    n = len(text)
    before = np.full(n + 1, -1, np.int64)
    places = np.array(sa, np.int64)
    before[places[1:]] = places[:-1]
    out = [0] * n
    shared = 0
    for i, j in enumerate(before[:n].tolist()):
        if j < 0:
            shared = 0
            continue
        stop = n - max(i, j)
        # Mostly nothing is gained; else equal stretches are compared in steps before single bytes.
        if shared < stop and text[i + shared] == text[j + shared]:
            shared += 1
            while shared + 64 <= stop and text[i + shared : i + shared + 64] == text[j + shared : j + shared + 64]:
                shared += 64
            while shared < stop and text[i + shared] == text[j + shared]:
                shared += 1
        out[i] = shared
        shared = shared - 1 if shared else 0
    return np.array(out, np.int64)


def repeated_starts(regions: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """Per region, the offsets whose ``length`` bytes also start at another place of the regions."""
    # Bytes become 1..256; 257 parts regions; 0 ends the text.
    sizes = np.array([len(r) for r in regions])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    joined = np.full(int(starts[-1]) + 1, 257, np.int64)
    for region, at in zip(regions, starts.tolist()):
        joined[at : at + len(region)] = np.frombuffer(region, np.uint8).astype(np.int64) + 1
    joined[-1] = 0
    sa = suffix_array(joined.tolist(), 258)
    # Parting symbols look like a byte here: strings that reach one are left out below.
    common = permuted_prefixes(np.where((joined == 0) | (joined == 257), 0, joined - 1).astype(np.uint8).tobytes(), sa)
    owner = np.repeat(np.arange(len(regions)), sizes + 1)
    offset = np.arange(len(owner)) - starts[:-1][owner]
    order = np.array(sa, np.int64)[1:]
    fits = (offset + length <= sizes[owner])[order]
    linked = common[order] >= length
    # A string repeats if it shares enough with the one before or after it in the array;
    # both are whole strings then, as shared bytes cannot run past a parting symbol of one.
    linked &= fits & np.concatenate([[False], fits[:-1]])
    hit = np.zeros(len(owner), bool)
    hit[order] = linked | np.concatenate([linked[1:], [False]])
    return [np.flatnonzero(hit[a : a + s]) for a, s in zip(starts[:-1].tolist(), sizes.tolist())]


def _shared_with_others(rows: np.ndarray) -> np.ndarray:
    """For each row of bytes, the longest prefix it shares with any other row."""
    packed = np.ascontiguousarray(rows).view(np.dtype((np.void, rows.shape[1]))).ravel()
    order = np.argsort(packed, kind="stable")
    differ = rows[order][1:] != rows[order][:-1]
    prefix = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    out = np.zeros(len(rows), np.int64)
    out[order[1:]] = prefix
    out[order[:-1]] = np.maximum(out[order[:-1]], prefix)
    return out


def merged(intervals: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(intervals):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def shard_repeats(regions: list[tuple], length: int = LENGTH) -> list[tuple[int, int, int, int]]:
    """(d, h, start, end) of repeated bytes in a shard.

    ``regions`` holds (d, h, start, bytes, keys, places): a stretch of a document
    and the anchors in it whose contexts it covers.
    """
    by_key: dict[int, list[tuple[int, int]]] = {}
    for r, region in enumerate(regions):
        for key, at in zip(region[4], region[5]):
            by_key.setdefault(key, []).append((r, at))
    reach = length - GRAM
    useful: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for members in by_key.values():
        if len(members) < 2:
            continue
        left, right = np.zeros((len(members), reach), np.uint8), np.zeros((len(members), length), np.uint8)
        has = np.zeros((2, len(members)), np.int64)
        for i, (r, at) in enumerate(members):
            start, data = regions[r][2], regions[r][3]
            before = np.frombuffer(data[max(0, at - start - reach) : at - start], np.uint8)[::-1]
            after = np.frombuffer(data[at - start : at - start + length], np.uint8)
            left[i, : len(before)], right[i, : len(after)] = before, after
            has[:, i] = len(before), len(after)
        more, less = np.minimum(_shared_with_others(left), has[0]), np.minimum(_shared_with_others(right), has[1])
        for i in np.flatnonzero(more + less >= length).tolist():
            r, at = members[i]
            useful.setdefault(regions[r][:2], []).append((at - int(more[i]), at + int(less[i])))
    data_of: dict[tuple[int, int], list[tuple[int, bytes]]] = {}
    for d, h, start, data, _, _ in regions:
        data_of.setdefault((d, h), []).append((start, data))
    strings, origins = [], []
    for document, spans in useful.items():
        for start, end in merged(spans):
            # A span lies in one region: regions of a document that touch are joined already.
            at, data = next((s, b) for s, b in data_of[document] if s <= start and end <= s + len(b))
            strings.append(data[start - at : end - at])
            origins.append((*document, start))
    if len(strings) == 0:
        return []
    out = []
    for (d, h, start), hits in zip(origins, repeated_starts(strings, length)):
        for a, b in merged([(int(p), int(p) + length) for p in hits]):
            out.append((d, h, start + a, start + b))
    return out


def documents(docs: DataFrame) -> DataFrame:
    """(d, h, data): id (null as the smallest), 31 bits of the text's hash, and its bytes."""
    h = F.xxhash64(F.col("doc_id").isNull(), whole()).bitwiseAND(F.lit((1 << 31) - 1))
    return docs.select(F.coalesce(F.col("doc_id"), F.lit(-(2**63))).alias("d"), h.alias("h"), whole().cast("binary").alias("data"))


def anchor_rows(rows: DataFrame, length: int) -> DataFrame:
    """(key, c, d, la): hashes of each anchor's gram and context, and its place: the
    document's h above, the position below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [])
            for d, h, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if len(data.as_buffer()) < length:
                    continue
                data = data.as_py()
                places = anchors(data, length).tolist()
                view = memoryview(data)
                out[0].extend([xxhash.xxh3_64_intdigest(view[a : a + GRAM]) for a in places])
                out[1].extend([xxhash.xxh3_64_intdigest(view[max(0, a - length + GRAM) : a + length], 1) for a in places])
                out[2].extend([d] * len(places))
                out[3].extend([h << 32 | a for a in places])
            arrays = [pa.array(np.array(c, np.uint64).view(np.int64)) for c in out[:2]] + [pa.array(c, pa.int64()) for c in out[2:]]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "c", "d", "la"])

    return rows.mapInArrow(run, "key bigint, c bigint, d bigint, la bigint")


def _regions(asked: DataFrame, length: int) -> DataFrame:
    """The bytes around the asked anchors (d, h, data, asks), per shard and document."""
    kind = "hd bigint, hl bigint, d bigint, h bigint, start bigint, data binary, keys array<bigint>, places array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in range(batch.num_rows):
                row = batch.slice(one, 1).to_pylist()[0]
                shards: dict[tuple[int, int], list[tuple[int, int]]] = {}
                for ask in row["asks"]:
                    shards.setdefault((ask["hd"], ask["hl"]), []).append((ask["key"], ask["at"]))
                out: list[tuple] = []
                for shard, wanted in shards.items():
                    spans = merged([(max(0, a - length + GRAM), min(len(row["data"]), a + length)) for _, a in wanted])
                    for start, end in spans:
                        own = [(k, a) for k, a in wanted if start <= a < end]
                        out.append((*shard, row["d"], row["h"], start, row["data"][start:end], [k for k, _ in own], [a for _, a in own]))
                columns = list(zip(*out))
                types = [pa.int64()] * 5 + [pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["hd", "hl", "d", "h", "start", "data", "keys", "places"])

    return asked.mapInArrow(run, kind)


_SPANS = "d bigint, h bigint, start bigint, end bigint"


def _span_batch(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[], [], [], []]
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=["d", "h", "start", "end"])


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(d, h, start, end): bytes covered by repeated strings; ends may lie past a document's."""
    rows = documents(docs)
    found = anchor_rows(rows, length)
    groups = found.groupBy("key", "c").agg(F.count("*").alias("n"), F.min(F.struct("d", "la")).alias("first"))
    # Both uses of the groups need the same columns, so that they share one shuffle.
    keys = groups.groupBy("key").agg(F.count("*").alias("m"), F.min("first").alias("home"), F.max("n").alias("most")).where("m > 1 OR most > 1")
    kept = cut(groups.join(keys, "key").where("n > 1 OR m > 1"))

    # Contexts that occur twice as a whole.
    low = F.lit((1 << 32) - 1)
    twice = found.join(kept.where("n > 1").select("key", "c"), ["key", "c"])
    at = F.col("la").bitwiseAND(low)
    full = twice.select("d", F.shiftright("la", 32).alias("h"), F.greatest(F.lit(0), at - (length - GRAM)).alias("start"), (at + length).alias("end"))

    # Different contexts of an anchor: their bytes go to the shards.
    asks = kept.where("m > 1").select(
        "key", "m", F.col("first.d").alias("d"), F.shiftright("first.la", 32).alias("h"), F.col("first.la").bitwiseAND(low).alias("at"),
        F.col("home.d").alias("hd"), F.expr(f"((home.la >> 32) << 32) | ((home.la & 4294967295) DIV {STRETCH})").alias("hl"),
    )
    few, crowded = asks.where(F.col("m") <= CROWD), asks.where(F.col("m") > CROWD)
    wanted = cut(few.groupBy("d", "h").agg(F.collect_list(F.struct("key", "at", "hd", "hl")).alias("asks")))
    asked = rows.where(present(wanted, "d")).dropDuplicates(["d", "h"]).join(wanted, ["d", "h"])

    def shard(table: pa.Table) -> pa.Table:
        return _span_batch(shard_repeats([tuple(r.values())[2:] for r in table.to_pylist()], length))

    spans = full.union(_regions(asked.select("d", "h", "data", "asks"), length).groupBy("hd", "hl").applyInArrow(shard, _SPANS))
    if not crowded.isEmpty():
        spans = spans.union(_crowded(rows, crowded, length))
    return spans


def _crowded(rows: DataFrame, asks: DataFrame, length: int) -> DataFrame:
    """Spans around anchors with very many different contexts: every string that
    covers the anchor is hashed, and strings are counted instead of sorted."""
    wanted = cut(asks.groupBy("d", "h").agg(F.collect_list(F.struct("key", "at")).alias("asks")))
    asked = rows.where(present(wanted, "d")).dropDuplicates(["d", "h"]).join(wanted, ["d", "h"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in range(batch.num_rows):
                row = batch.slice(one, 1).to_pylist()[0]
                for ask in row["asks"]:
                    start, data = context(row["data"], ask["at"], length)
                    if len(data) < length:
                        continue
                    view = memoryview(data)
                    n = len(data) - length + 1
                    hashes = [xxhash.xxh3_64_intdigest(view[p : p + length]) for p in range(n)]
                    again = [xxhash.xxh3_64_intdigest(view[p : p + length], 7) for p in range(n)]
                    arrays = [pa.array(np.array(c, np.uint64).view(np.int64)) for c in (hashes, again)]
                    arrays += [pa.array(np.full(n, v, np.int64)) for v in (row["d"], row["h"])] + [pa.array(np.arange(start, start + n))]
                    yield pa.RecordBatch.from_arrays(arrays, names=["w", "v", "d", "h", "start"])

    windows = asked.select("d", "h", "data", "asks").mapInArrow(run, "w bigint, v bigint, d bigint, h bigint, start bigint")
    place = F.struct("d", "h", "start")
    repeated = windows.groupBy("w", "v").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a <> b").select("w", "v")
    return windows.join(repeated, ["w", "v"]).select("d", "h", "start", (F.col("start") + length).alias("end"))


def deduplicated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, kept, n_bytes, n_removed, n_spans) per row of ``docs`` (doc_id, text).

    ``kept`` is the text's bytes (UTF-8; null as empty) without every byte covered
    by a string of ``length`` bytes that also starts elsewhere in ``docs``, judged
    on the input. Repeated rows are copies of each other. Rows that share an id
    are told apart by their texts. Texts shorter than ``length`` stay as they are.
    """
    spans = cut(repeated_spans(docs, length).groupBy("d", "h").agg(F.collect_set(F.struct("start", "end")).alias("spans")))
    rows = documents(docs).withColumn("doc_id", F.when(F.col("d") != -(2**63), F.col("d")))
    hit = present(spans, "d")
    kind = "doc_id bigint, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, data, found in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                data = data.as_py()
                kept, at, removed = [], 0, 0
                runs = merged([(s["start"], min(s["end"], len(data))) for s in found or ()])
                for start, end in runs:
                    kept.append(data[at:start])
                    removed += end - start
                    at = end
                out.append((doc_id, b"".join(kept) + data[at:], len(data), removed, len(runs)))
            columns = list(zip(*out)) if out else [[]] * 5
            types = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    size = F.octet_length("data").cast("bigint")
    none = F.lit(0).cast("bigint")
    clean = rows.where(~hit).select("doc_id", F.col("data").alias("kept"), size.alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"))
    met = rows.where(hit).join(spans, ["d", "h"], "left").select("doc_id", "data", "spans")
    return clean.union(met.mapInArrow(run, kind))
