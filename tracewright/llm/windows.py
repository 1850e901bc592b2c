"""Search for repeated windows: strings of a fixed number of items (bytes or words) that start in more than one place.

Each window elects its least gram (hash of ``gram`` items, leftmost at ties) as its anchor. Equal windows elect equal
anchors at equal offsets, so only windows of anchors with equal hashes need comparing, and about one gram in
``(length - gram) / 2`` becomes an anchor. An anchor with the text of all windows that elected it is an occurrence;
occurrences are counted by (anchor hash ``f``, text hash ``g``) before anything is gathered, so that a passage with any
number of copies is a row a batch from the start and one row from then on. Only anchors with two or more different texts are
contested: a text for each (f, g) goes to shards of bounded size, where a resolver compares texts themselves and finds which
of their windows are also in others. The texts of an anchor with too many of them for a shard are split until they fit.

Rows are identified by (document id, 64-bit hash of the text): repeated rows count as that many occurrences.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import drop_caches, dropped, id_key, text_or_empty, written

_BASE = np.uint64(0x9E3779B97F4A7C15)
_POSITION_BITS = 28
#: Windows of a document that are worked on at once; bounds the memory that a long document takes.
BLOCK = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def grams_of(values: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` values in a row, from running sums of a polynomial in an odd base.

    It elects anchors and nothing else: different grams with one hash only share an anchor, whose texts are compared anyway.
    """
    up, down = _powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * down[: len(values)], out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * up[: len(values) - size + 1])


_known_powers: list[tuple[np.ndarray, np.ndarray]] = []


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; sizes are at most those of a block, so the table is bounded."""
    if not _known_powers or len(_known_powers[0][0]) < size:
        n = max(1 << 16, 1 << (size - 1).bit_length())
        both = []
        for b in (int(_BASE), pow(int(_BASE), -1, 2**64)):
            steps = np.full(n, b, np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        _known_powers[:] = [(both[0], both[1])]
    return _known_powers[0]


#: Bytes of a text whose words are hashed at once, about; longer words than LONG bytes are hashed by a library.
PART, LONG = 1 << 22, 256
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_WHITE = np.zeros(256, bool)
_WHITE[[32, *range(9, 14)]] = True


def _parts(raw: bytes) -> Iterator[bytes]:
    """A text cut at white space, about PART bytes at a time."""
    at = 0
    while len(raw) - at > PART and (cut := _SPACE.search(raw, at + PART)):
        yield raw[at : cut.start()]
        at = cut.end()
    yield raw[at:]


def word_parts(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text in order, those of about PART bytes at a time. bytes.split() splits at ASCII white space alone."""
    return (part.split() for part in _parts(raw))


def _word_hashes(raw: bytes) -> np.ndarray:
    padded = np.frombuffer(raw + bytes(8), np.uint8)
    white = _WHITE[padded[: len(raw)]]
    inside = np.zeros(len(raw) + 2, bool)
    np.logical_not(white, out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, sizes = edges[::2], np.diff(edges)[::2]
    lanes = np.ndarray((len(raw) + 1,), "<u8", padded.data, 0, (1,))  # the eight bytes from each place on
    out = mix(sizes.astype(np.uint64) + np.uint64(1))
    word = np.flatnonzero(sizes <= LONG)
    left, at = sizes[word], starts[word]
    while len(word):
        eight = lanes[at]
        short = np.flatnonzero(left < 8)
        eight[short] &= (np.uint64(1) << (left[short].astype(np.uint64) << np.uint64(3))) - np.uint64(1)
        out[word] = mix(out[word] * _BASE + eight)
        more = np.flatnonzero(left > 8)
        word, left, at = word[more], left[more] - 8, at[more] + 8
    for k in np.flatnonzero(sizes > LONG).tolist():
        out[k] = xxhash.xxh3_64_intdigest(raw[starts[k] : starts[k] + sizes[k]])
    return out


def word_items(raw: bytes) -> np.ndarray:
    """A 64-bit hash of each word: its bytes, eight at a time, are mixed in one after the other."""
    return np.concatenate([_word_hashes(part) for part in _parts(raw)])


@dataclass(frozen=True)
class Kind:
    """What a window is: ``length`` items of ``stored``, which texts are compared by, elected by grams of ``gram`` items' 64-bit ``values``."""

    length: int
    gram: int
    stored: Callable[[bytes], np.ndarray]
    values: Callable[[np.ndarray], np.ndarray]
    dtype: type


def bytes_kind(length: int, gram: int) -> Kind:
    return Kind(length, gram, lambda raw: np.frombuffer(raw, np.uint8), lambda stored: BYTE_VALUES[stored], np.uint8)


def words_kind(length: int, gram: int) -> Kind:
    return Kind(length, gram, word_items, lambda stored: stored, np.uint64)


def occurrences(raw: bytes, kind: Kind) -> tuple[np.ndarray, ...]:
    """(f, g, m, lo, hi) of each anchor of a text: the windows that start at lo..hi elected the gram at m; g is a library's hash of all that they cover."""
    stored = kind.stored(raw)
    windows = len(stored) - kind.length + 1
    size, whole, digest = stored.itemsize, memoryview(stored).cast("B") if len(stored) else b"", xxhash.xxh3_64_intdigest
    found = []
    for at in range(0, max(windows, 0), BLOCK):
        part = kind.values(stored[at : at + BLOCK + kind.length - 1])
        f = grams_of(part, kind.gram)
        starts = np.arange(len(f))
        least = f >> np.uint64(_POSITION_BITS) << np.uint64(_POSITION_BITS) | starts.astype(np.uint64)
        span, width = 1, kind.length - kind.gram + 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
        elected = (least & np.uint64((1 << _POSITION_BITS) - 1)).astype(np.int64)
        new = np.ones(len(elected) + 1, bool)
        np.not_equal(elected[1:], elected[:-1], out=new[1:-1])
        bounds = np.flatnonzero(new)
        lo, hi = bounds[:-1], bounds[1:] - 1
        m = elected[lo]
        asked = zip(((lo + at) * size).tolist(), ((hi + at + kind.length) * size).tolist(), (m - lo).tolist(), strict=True)
        g = np.fromiter((digest(whole[a:b], shift) for a, b, shift in asked), np.uint64, len(lo))
        found.append((f[m], g, m + at, lo + at, hi + at))
    if not found:
        return (np.zeros(0, np.uint64), np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


#: An anchor's span: its position * 2**24 + (m - lo) * 2**12 + (m - hi).
_FAR, _NEAR = 1 << 24, 1 << 12
#: An occurrence as bytes that sort as it does: document, text hash and span, big-endian, the signs turned.
_PLACE = np.dtype([("dk", ">u8"), ("rk", ">u8"), ("span", ">u8")])
_SIGN = 1 << 63


def _places(dk: np.ndarray, rk: np.ndarray, span: np.ndarray) -> np.ndarray:
    out = np.empty(len(span), _PLACE)
    out["dk"] = dk.astype(np.int64).view(np.uint64) ^ np.uint64(_SIGN)
    out["rk"] = rk.astype(np.int64).view(np.uint64) ^ np.uint64(_SIGN)
    out["span"] = span
    return out


def _place_part(place: str, at: int, size: int, sign: int) -> Column:
    """A number of a place, by SQL."""
    return (F.conv(F.hex(F.substring(place, at, size)), 16, 10).cast("decimal(20,0)") - F.lit(str(sign)).cast("decimal(20,0)")).cast("long")


def _anchors(docs: DataFrame, kind: Kind) -> DataFrame:
    """(f, g, places): the anchors of all documents; those with equal f and g in a batch are one row, their places in order."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        for batch in batches:
            dk, rk = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            raws, parts, sizes = batch.column(2), [], []
            order = np.lexsort((rk, dk))
            for k in order.tolist():
                f, g, m, lo, hi = occurrences(raws[k].as_py(), kind)
                parts.append((f, g, m * _FAR + (m - lo) * _NEAR + (m - hi)))
                sizes.append(len(f))
            if not sum(sizes):
                continue
            f, g, span = (np.concatenate(x) for x in zip(*parts, strict=True))
            places = _places(np.repeat(dk[order], sizes), np.repeat(rk[order], sizes), span)
            # equal anchors side by side, their places in order: by some bits of both hashes, then by place
            bits = np.uint64(len(f).bit_length())
            key = mix(f + g * _BASE) >> bits << bits | np.arange(len(f), dtype=np.uint64)
            key.sort()
            alike = (key & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
            f, g = f[alike], g[alike]
            first = np.flatnonzero(np.r_[True, (f[1:] != f[:-1]) | (g[1:] != g[:-1])])
            ends = np.r_[first, len(f)].astype(np.int32) * np.int32(_PLACE.itemsize)
            packed = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(places[alike].tobytes())])
            yield pa.RecordBatch.from_arrays([pa.array(f[first].view(np.int64)), pa.array(g[first].view(np.int64)), packed], ["f", "g", "places"])

    return docs.select("dk", "rk", "raw").mapInArrow(work, "f long, g long, places binary")


#: resolve(values of each text, copies of each, where each first stands) -> for each text the runs [a, b, a, b, ...] of window offsets that count as repeats
Resolve = Callable[[list[np.ndarray], np.ndarray, np.ndarray], list[list[int]]]


def runs_of(marked: np.ndarray) -> list[int]:
    edge = np.diff(np.r_[0, marked.astype(np.int8), 0])
    return np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1], 1).ravel().tolist()


_PIECE = "cell long, g long, n long, dk long, rk long, start long, far int, near int, low int, high int, text binary"
_NAMES = [x.split()[0] for x in _PIECE.split(", ")]
_TYPES = [{"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[x.split()[1]] for x in _PIECE.split(", ")]


def _texts(docs: DataFrame, wanted: DataFrame, kind: Kind) -> DataFrame:
    """A piece for each wanted (f, g): the text of its windows, which start far..near items before the anchor, in the cell of its f.

    A cell is what texts share: windows whose anchor is low..high items from their start, and all that is in each such window.
    """
    lists = wanted.groupBy("dk", "rk").agg(F.collect_list(F.struct("f", "g", "span", "n")).alias("asked"))
    rows = docs.join(lists, ["dk", "rk"]).select("dk", "rk", "raw", "asked")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dk, rk, raw, asked in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                stored, out = kind.stored(raw), []
                for a in asked:
                    far, near = a["span"] % _FAR // _NEAR, a["span"] % _NEAR
                    start = a["span"] // _FAR - far
                    out.append((a["f"], a["g"], a["n"], dk, rk, start, far, near, 0, kind.length - kind.gram, stored[start : start + far - near + kind.length].tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _TYPES, strict=True)], _NAMES)

    return rows.mapInArrow(work, _PIECE)


#: Parts that the windows of a cell with too many pieces are split into.
PARTS = 8


def _split(kind: Kind) -> Callable:
    """Up to PARTS pieces of each: its windows in each part of low..high, in a cell that shares more."""
    size, digest = np.dtype(kind.dtype).itemsize, xxhash.xxh3_64_intdigest

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for cell, g, n, dk, rk, start, far, near, low, high, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                bounds = [low + (high - low + 1) * k // PARTS for k in range(PARTS + 1)]
                for lower, upper in zip(bounds[:-1], (x - 1 for x in bounds[1:]), strict=True):
                    a, b = min(far, upper), max(near, lower)
                    if a >= b:
                        part = text[(far - a) * size : (far - b + kind.length) * size]
                        core = part[(a - upper) * size + (upper - lower) * size :][: (kind.length - upper + lower) * size]
                        out.append((cell, g, digest(core, lower << 16 | upper), digest(part, a), n, dk, rk, start + far - a, a, b, lower, upper, part, far - a))
            columns = list(zip(*out, strict=True)) or [()] * (len(_NAMES) + 3)
            types = [pa.int64(), pa.int64(), *_TYPES, pa.int32()]
            arrays = [pa.array([x - (x >> 63 << 64) if k in (2, 3) else x for x in c] if k in (2, 3) else c, t) for k, (c, t) in enumerate(zip(columns, types, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, ["above", "g_above", *_NAMES, "shift"])

    return work


def _resolved(texts: DataFrame, rows: int, shard_rows: int, resolve: Resolve, dtype: type) -> DataFrame:
    """(cell, g, runs) of the pieces of cells, dealt to shards of about shard_rows pieces each; a cell is never split."""

    def work(table: pa.Table) -> pa.Table:
        # all texts of a cell are here, each once (rows of equal id and text bring theirs again); in the order of their first places
        rows = {(r[0], r[4]): r for r in zip(*(table.column(c).to_pylist() for c in ("cell", "dk", "rk", "start", "g", "n", "text")), strict=True)}
        rows = sorted(rows.values(), key=lambda r: r[:4])
        values = [np.frombuffer(r[6], dtype) for r in rows]
        runs = resolve(values, np.array([r[5] for r in rows]), np.array([r[0] for r in rows]))
        return pa.table({"cell": pa.array([r[0] for r in rows], pa.int64()), "g": pa.array([r[4] for r in rows], pa.int64()), "runs": pa.array(runs, pa.list_(pa.int64()))})

    keyed = texts.select("cell", "dk", "rk", "start", "g", "n", "text", F.pmod(F.xxhash64("cell"), F.lit(max(1, -(-rows // shard_rows)))).alias("shard"))
    return keyed.groupBy("shard").applyInArrow(work, "cell long, g long, runs array<long>").filter(F.size("runs") > 0)


def _decided(pieces: Callable[[DataFrame], DataFrame], kinds: DataFrame, kind: Kind, resolve: Resolve, spare_first: bool, shard_rows: int) -> DataFrame:
    """(cell, g, runs): for each piece the runs of window offsets that count as repeats of its first place, of those pieces that have any.

    kinds: (cell, kinds), how many pieces there are of the cells with two or more; pieces: of a table of such cells, their pieces.

    A cell with more pieces than a shard takes is split again and again: each part's cells share more items, and pieces that are
    alike there become one. At the end a cell is one window. So every cell comes to a shard, whatever its size was.
    """
    small, large = F.col("kinds") <= shard_rows, F.col("kinds") > shard_rows
    n_small, n_large = (int(x or 0) for x in kinds.agg(F.sum(F.when(small, F.col("kinds"))), F.sum(F.when(large, F.col("kinds")))).first())
    told = _resolved(pieces(kinds.filter(small).select("cell")), n_small, shard_rows, resolve, kind.dtype) if n_small else None
    if n_large:
        # written before they are split, so that a stage holds one Python worker a task
        whole = written(pieces(kinds.filter(large).select("cell")).select(*_NAMES).dropDuplicates(["cell", "g"]), "pieces")
        parts = written(whole.mapInArrow(_split(kind), f"above long, g_above long, {_PIECE}, shift int"), "parts")
        place = F.struct("dk", "rk", "start")
        same = [F.first(c).alias(c) for c in ("far", "near", "low", "high", "text")]  # equal in all
        below = parts.groupBy("cell", "g").agg(F.sum("n").alias("n"), F.min(place).alias("place"), *same)
        below = written(below.select("cell", "g", "n", "place.dk", "place.rk", "place.start", "far", "near", "low", "high", "text"), "below")
        fewer = written(below.groupBy("cell").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1"), "kinds")
        runs = _decided(lambda cells: below.join(cells, "cell"), fewer, kind, resolve, spare_first, shard_rows)
        of = below.select("cell", "g", F.col("n").alias("all"), place.alias("first"))
        links = parts.select("above", "g_above", "cell", "g", "shift", (F.col("far") - F.col("near")).alias("width"), place.alias("place"))
        links = links.join(written(of.join(runs, ["cell", "g"], "left"), "verdicts"), ["cell", "g"])
        again = F.col("place") != F.col("first") if spare_first else F.col("all") > 1
        shifted = F.when(again, F.array(F.lit(0), F.col("width"))).otherwise(F.col("runs"))
        up = links.select(F.col("above").alias("cell"), F.col("g_above").alias("g"), F.transform(shifted, lambda x: x + F.col("shift")).cast("array<long>").alias("runs")).filter("runs IS NOT NULL")
        up = up.groupBy("cell", "g").agg(F.flatten(F.collect_list("runs")).alias("runs"))
        told = up if told is None else told.unionByName(up)
    return kinds.sparkSession.createDataFrame([], "cell long, g long, runs array<long>") if told is None else told


def repeated_windows(docs: DataFrame, kind: Kind, resolve: Resolve, spare_first: bool, shard_rows: int = 500) -> DataFrame:
    """(dk, rk, repeats array<struct<los, width, runs>>) of the documents that hold repeated windows.

    docs: (dk, rk, raw). For each lo of a repeat, its window starts are lo..lo + width where runs is null, else lo plus the
    offsets in runs.
    With spare_first the occurrence that comes first by (dk, rk, start) isn't a repeat.
    """
    size = _PLACE.itemsize
    anchors = written(_anchors(docs, kind), "anchors")
    # what is joined on an anchor is written first: between two tables Spark can split the partition of a frequent anchor
    often = written(anchors.groupBy("f").agg(F.sum(F.length("places")).alias("bytes")).filter(F.col("bytes") > size).select("f"), "often")
    shared = written(anchors.join(often, "f", "left_semi"), "shared")
    dropped(anchors, often)  # most anchors stand once; nothing reads them again
    groups = shared.groupBy("f", "g").agg((F.sum(F.length("places")) / size).cast("long").alias("n"), F.min(F.substring("places", 1, size)).alias("first"))
    groups = written(groups, "groups")
    kinds = written(groups.groupBy(F.col("f").alias("cell")).agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1"), "kinds")
    dk, rk, span = _place_part("first", 1, 8, _SIGN), _place_part("first", 9, 8, _SIGN), _place_part("first", 17, 8, 0)
    wanted = lambda cells: groups.join(cells.withColumnRenamed("cell", "f"), "f").select("f", "g", "n", dk.alias("dk"), rk.alias("rk"), span.alias("span"))
    runs = _decided(lambda cells: _texts(docs, wanted(cells), kind), kinds, kind, resolve, spare_first, shard_rows).withColumnRenamed("cell", "f")
    verdicts = written(groups.join(runs, ["f", "g"], "left").filter("n > 1 OR runs IS NOT NULL"), "verdicts")
    dropped(groups, kinds)
    told = shared.join(verdicts, ["f", "g"]).select("places", "first", "n", "runs").mapInArrow(_settled(spare_first), "dk long, rk long, los array<long>, width long, runs array<long>")
    return told.groupBy("dk", "rk").agg(F.collect_set(F.struct("los", "width", "runs")).alias("repeats"))


def _settled(spare_first: bool) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, runs = batch.column(2).to_numpy(), batch.column(3)
            packed = [np.frombuffer(x, _PLACE) for x in batch.column(0).to_pylist()]
            if not packed:
                continue
            places, owner = np.concatenate(packed), np.repeat(np.arange(len(packed)), [len(p) for p in packed])
            if spare_first:
                first = np.frombuffer(b"".join(batch.column(1).to_pylist()), _PLACE)[owner]
                whole = (places["dk"] != first["dk"]) | (places["rk"] != first["rk"]) | (places["span"] != first["span"])
            else:
                whole = n[owner] > 1
            kept = whole | runs.is_valid().to_numpy(zero_copy_only=False)[owner]
            places, owner, whole = places[kept], owner[kept], whole[kept]
            if not len(places):
                continue
            dk, rk = ((places[n].astype(np.uint64) ^ np.uint64(_SIGN)).view(np.int64) for n in ("dk", "rk"))
            span = places["span"].astype(np.int64)
            lo, width = span // _FAR - span % _FAR // _NEAR, span % _FAR // _NEAR - span % _NEAR
            # a row for each anchor text and document: its places in a document stand together
            new = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (dk[1:] != dk[:-1]) | (rk[1:] != rk[:-1]) | (whole[1:] != whole[:-1])])
            ends = pa.array(np.r_[new, len(places)].astype(np.int32))
            asked = pa.array(owner[new], mask=whole[new])
            arrays = [pa.array(dk[new]), pa.array(rk[new]), pa.ListArray.from_arrays(ends, pa.array(lo)), pa.array(width[new]), runs.take(asked)]
            yield pa.RecordBatch.from_arrays(arrays, ["dk", "rk", "los", "width", "runs"])

    return work


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(dk, rk, raw): what the functions above take."""
    return df.select(id_key(id_col).alias("dk"), F.xxhash64(text_or_empty(text_col)).alias("rk"), text_or_empty(text_col).cast("binary").alias("raw"))


def intervals(repeats: pa.ListArray) -> list[tuple[np.ndarray, np.ndarray] | None]:
    """Of each row of ``repeats`` the first and last starts of its runs of repeated windows; None where there are none."""
    counts = repeats.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    each = repeats.flatten()
    los, width, runs = each.field("los"), each.field("width").to_numpy(zero_copy_only=False), each.field("runs")
    n_los = los.value_lengths().to_numpy(zero_copy_only=False)
    none = runs.is_null().to_numpy(zero_copy_only=False)
    n_runs = np.where(none, 1, runs.value_lengths().fill_null(0).to_numpy(zero_copy_only=False) // 2)
    flat = runs.flatten().to_numpy(zero_copy_only=False).reshape(-1, 2)
    # the runs of each struct side by side, a whole one where runs is null
    begin = np.cumsum(n_runs) - n_runs
    a, b = np.zeros(int(n_runs.sum()), np.int64), np.zeros(int(n_runs.sum()), np.int64)
    given = np.repeat(~none, n_runs)
    a[given], b[given] = flat[:, 0], flat[:, 1]
    b[begin[none]] = width[none]
    # each start of a struct with each of its runs
    lo = los.flatten().to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(n_los)), n_los)
    times = n_runs[owner]
    at = np.repeat(begin[owner] - np.cumsum(times) + times, times) + np.arange(int(times.sum()))
    start = np.repeat(lo, times)
    first, last = start + a[at], start + b[at]
    sizes = n_los * n_runs
    ends = np.cumsum(np.bincount(np.repeat(np.arange(len(counts)), counts), sizes, len(counts))).astype(np.int64)
    return [(first[i:j], last[i:j]) if j > i else None for i, j in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


def covered(size: int, repeats: tuple[np.ndarray, np.ndarray] | None, length: int) -> np.ndarray:
    """Which of ``size`` items a repeated window covers."""
    if repeats is None:
        return np.zeros(size, bool)
    edge = np.bincount(repeats[0], minlength=size + 1) - np.bincount(repeats[1] + length, minlength=size + 1)
    return np.cumsum(edge[:-1]) > 0


def applied(docs: DataFrame, repeats: DataFrame, work: Callable, schema: str) -> DataFrame:
    """work(dk, raw, repeats) -> a row's values, for each document with or without repeats."""
    names = [x.split()[0] for x in schema.split(", ")]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"long": pa.int64(), "string": pa.string(), "int": pa.int32(), "binary": pa.binary()}
        types = [kinds[x.split()[1]] for x in schema.split(", ")]
        for batch in batches:
            rows = [work(*r) for r in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), intervals(batch.column(2)), strict=True)]
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return docs.join(repeats, ["dk", "rk"], "left").select("dk", "raw", "repeats").mapInArrow(each, schema)
