"""Near-duplicate classes by Order MinHash, verified by alignment.

A sketch takes, under one of ``BANDS`` hash orders, the ``KEPT`` least k-mers of a text (five words, labelled with their
occurrence number, so that repeats count) and keeps them in text order; texts at a small edit distance often agree in it.
Equal texts are one row throughout. In each bucket of texts with equal sketches members are compared with a few leaders,
not with each other: the member that stands in the largest buckets (the original of a group of edited copies does) and a
random one. Then every two members of a bucket that are in different classes still are compared, so no pair that shares a
sketch is left out: lengths and counts of words, which bound the edit similarity from above, decide most, alignments the rest.
A pair is near if its edit similarity in words is 0.8 or more, found by an alignment of as many edits as that allows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import drop_caches, dropped, id_key, shown_id, text_or_empty, written
from tracewright.llm.windows import mix, word_items

BANDS, KEPT, SHINGLE, LEAST = 24, 3, 5, 0.8
#: One changed word may leave a short text no five words in a row, so texts of 4 (a fifth of 5 is a word) to SHORT words are also
#: sketched by grams of two words, two a sketch.
LEAST_SHORT, SHORT, SHORT_SHINGLE, SHORT_KEPT = 4, 40, 2, 2
#: Random leaders of a bucket, beside the most famous member.
LEADERS = 1
#: Members of a bucket in one block, about, when what leaders left open is compared (two blocks are one group); bins of the counts of words.
BLOCK, BINS = 1024, 2048
#: Stands for a diagonal that no alignment has come to.
OUT = np.int64(-(2**40))
#: Words that are compared at once, at most, when a diagonal is followed.
LOOK = 1024
#: And words over all diagonals, about.
AT_ONCE = 1_000_000
#: Stands for no bucket, above all of them.
NO_BUCKET = np.int64(2**63 - 1)
_SEEDS = mix(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25)) | np.uint64(1)
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


def shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """A hash of each run of ``size`` words; of all words, if there are fewer; none of none."""
    size = min(size, len(words))
    if not size:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        out = mix(out + words[k : len(words) - size + 1 + k])
    return out


def labelled(grams: np.ndarray) -> np.ndarray:
    """grams with the number of their occurrence worked in."""
    order = np.argsort(grams, kind="stable")
    ordered = grams[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    number = np.arange(len(grams)) - np.repeat(first, np.diff(np.r_[first, len(grams)]))
    out = np.empty_like(grams)
    out[order] = ordered + number.astype(np.uint64) * _STEP
    return out


def order_sketches(words: np.ndarray) -> np.ndarray:
    """A number a band, and for short texts a further one of shorter grams. Texts without words have none."""
    out = _sketches(shingles(words), KEPT, _SEEDS)
    if LEAST_SHORT <= len(words) <= SHORT:
        out = np.r_[out, _sketches(shingles(words, SHORT_SHINGLE), SHORT_KEPT, mix(_SEEDS) | np.uint64(1))]
    return out


def _sketches(grams: np.ndarray, kept: int, every: np.ndarray) -> np.ndarray:
    """Of each of the seeds, the ``kept`` least grams in text order as one number. Long texts take fewer bands at a time, so that AT_ONCE numbers are held, or one band."""
    if not len(grams):
        return np.zeros(0, np.int64)
    base = mix(labelled(grams))
    kept, some = min(kept, len(grams)), max(1, AT_ONCE // len(grams))
    out = every.copy()
    for at in range(0, BANDS, some):
        seeds = every[at : at + some]
        drawn = base * seeds[:, None]  # base is mixed; an odd factor is another order of it
        least = np.argpartition(drawn, kept, axis=1)[:, :kept] if len(grams) > kept else np.tile(np.arange(kept), (len(seeds), 1))
        least = np.sort(least, axis=1)
        for k in range(kept):
            out[at : at + some] = mix(out[at : at + some] * _STEP + grams[least[:, k]])
    return out.view(np.int64)


def _binned(words: np.ndarray) -> np.ndarray:
    """Numbers of words by bins of their hashes, repeats counted, in the least type that holds them."""
    counts = np.bincount((words % np.uint64(BINS)).astype(np.int64), minlength=BINS)
    return counts.astype(np.min_scalar_type(counts.max()))


def possible(bins: np.ndarray, label: np.ndarray, side: np.ndarray, across: bool, own: np.ndarray, least: float, before: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """(i, js): the members with which member i may be near, each pair once: of other labels, ``across`` sides or not, one of the two ``own``.

    An alignment keeps at most the lesser count of each bin, and ``least`` of the longer text's words at least, so no pair with
    an edit similarity of ``least`` is missed. ``before``: a row of numbers a member, NO_BUCKET for none; members with one in common
    at the same place meet elsewhere.
    """
    sizes = bins.sum(axis=1, dtype=np.int64)
    order = np.argsort(sizes, kind="stable")
    bins, label, side, own, sizes = bins[order], label[order], side[order], own[order], sizes[order]
    before = np.zeros((len(order), 0), np.int64) if before is None else before[order]
    ends = np.searchsorted(sizes, sizes / (least * (1 - 1e-9)), "right")
    for i, end in enumerate(ends):
        rest = slice(i + 1, end)
        js = i + 1 + np.flatnonzero((label[rest] != label[i]) & ((side[rest] != side[i]) == across) & (own[rest] | own[i]))
        places = np.flatnonzero(before[i] != NO_BUCKET)
        if len(js) and len(places):
            js = js[~(before[js][:, places] == before[i, places]).any(axis=1)]
        if len(js):
            shared = np.minimum(bins[js], bins[i]).sum(axis=1, dtype=np.int64)
            js = js[shared >= least * sizes[js] * (1 - 1e-9)]
            if len(js):
                yield int(order[i]), order[js]


def edit_similarity(a: np.ndarray, b: np.ndarray, least: float = LEAST) -> float:
    """1 - edits / longer length of the best alignment; 0 if it is below ``least``.

    For each number of edits, the farthest row that each diagonal reaches, until the last row is reached or the edits that
    ``least`` allows are spent. Diagonals join as edits come to them and leave when too few edits are left to come back, so
    no alignment within ``least`` is out of reach. Equal beginnings and ends are cut off first.
    """
    longest = max(len(a), len(b))
    if not longest:
        return 1.0
    n = min(len(a), len(b))
    same = a[:n] == b[:n]
    start = n if same.all() else int(np.argmin(same))
    a, b = a[start:], b[start:]
    n = min(len(a), len(b))
    same = a[len(a) - n :][::-1] == b[len(b) - n :][::-1]
    end = n if same.all() else int(np.argmin(same))
    a, b = a[: len(a) - end], b[: len(b) - end]
    most = int((1 - least) * longest + 1e-9)
    goal = len(b) - len(a)
    if abs(goal) > most:
        return 0.0
    if not len(a) or not len(b):
        return 1 - max(len(a), len(b)) / longest
    rows, columns = len(a), len(b)
    numbers = np.unique(np.r_[a, b], return_inverse=True)[1]
    a, b = _ended(numbers[:rows], -1), _ended(numbers[rows:], -2)
    low, reach = 0, _slid(a, b, np.zeros(1, np.int64), 0)  # reach[i]: rows of diagonal low + i
    for edits in range(most + 1):
        if edits:
            # a diagonal's neighbours on both sides; of them those from which the edits left lead to the goal
            first, last = max(low - 1, goal - (most - edits)), min(low + len(reach), goal + (most - edits))
            wide = np.full(len(reach) + 4, OUT)
            wide[2:-2] = reach
            i, j = first - low + 2, last - low + 3
            far = np.maximum(np.maximum(wide[i:j] + 1, wide[i - 1 : j - 1]), wide[i + 1 : j + 1] + 1)  # a word changed; one more in b; one more in a
            low, diagonal = first, np.arange(first, last + 1)
            far = np.minimum(far, np.minimum(rows, columns - diagonal))
            far[(far < 0) | (far + diagonal < 0)] = OUT
            reach = _slid(a, b, far, low)
        if 0 <= goal - low < len(reach) and reach[goal - low] >= rows:
            return 1 - edits / longest
    return 0.0


def _ended(words: np.ndarray, end: int) -> np.ndarray:
    """words with an end that equals no word, as long as the longest look ahead."""
    return np.r_[words.astype(np.int64), np.full(LOOK, end)]


def _slid(a: np.ndarray, b: np.ndarray, rows: np.ndarray, low: int) -> np.ndarray:
    """rows of the diagonals from low on, each moved past the equal words that follow it."""
    going = np.flatnonzero(rows >= 0)
    at = rows[going]
    equal = a[at] == b[at + going + low]
    going, step = going[equal], 8
    rows[going] += 1
    while len(going):
        ahead = rows[going][:, None] + np.arange(step)
        equal = a[ahead] == b[ahead + going[:, None] + low]
        whole = equal.all(axis=1)
        rows[going] += np.where(whole, step, np.argmin(equal, axis=1))
        going = going[whole]
        step = max(8, min(2 * step, LOOK, AT_ONCE // max(1, len(going))))
    return rows


def near(a: np.ndarray, b: np.ndarray, least: float = LEAST) -> bool:
    return bool(len(a) and len(b)) and edit_similarity(a, b, least) >= least


def _sketched(docs: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        for batch in batches:
            sketches = [order_sketches(word_items(x)) for x in batch.column(2).to_pylist()]
            arrays = [batch.column(0), batch.column(1), pa.array(sketches, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["dk", "digest", "sketches"])

    return docs.select("dk", "digest", "raw").mapInArrow(work, "dk long, digest binary, sketches array<long>")


def _with_words(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(tid, words, n_words, bins, sketches): 32-bit word hashes of the wanted texts (tid, dk, digest, sketches), each taken from its first document, and the counts of their words by bins."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [(word_items(x) >> np.uint64(32)).astype(np.uint32) for x in batch.column(1).to_pylist()]
            bins = [_binned(x.astype(np.uint64)).tobytes() for x in words]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in words], pa.binary()), pa.array([len(x) for x in words], pa.int64()), pa.array(bins, pa.binary()), batch.column(2)], ["tid", "words", "n_words", "bins", "sketches"])

    rows = docs.join(wanted, ["dk", "digest"])
    return rows.select("tid", "raw", "sketches").mapInArrow(work, "tid long, words binary, n_words long, bins binary, sketches array<long>")


def _verified(pairs: DataFrame, words: DataFrame, least: float) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, np.ndarray] = {}  # the words of texts in order of their hashes; a leader stands in many pairs
        held = 0

        def of(words: bytes) -> np.ndarray:
            nonlocal held
            if words not in known:
                if held > AT_ONCE:
                    known.clear()
                    held = 0
                known[words] = np.sort(labelled(np.frombuffer(words, np.uint32).astype(np.uint64)))
                held += len(known[words])
            return known[words]

        def alike(a: bytes, b: bytes) -> bool:
            most = max(len(a), len(b)) // 4 * least * (1 - 1e-9)
            if not a or not b or min(len(a), len(b)) // 4 < most:
                return False
            x, y = of(a), of(b)  # an alignment keeps no more words than both have
            if (y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum() < most:
                return False
            return edit_similarity(np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32), least) >= least

        for batch in batches:
            kept = [alike(a, b) for a, b in zip(*(batch.column(c).to_pylist() for c in ("wa", "wb")), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    first = pairs.join(words.select(F.col("tid").alias("a"), F.col("words").alias("wa")), "a")
    both = first.join(words.select(F.col("tid").alias("b"), F.col("words").alias("wb")), "b")
    return both.select("a", "b", "wa", "wb").mapInArrow(work, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of the nodes of edges (a, b): the least node that it is connected to.

    Each round hands every node's larger neighbours, then every node's smaller ones, to its least neighbour; a table is written
    a round, and the rounds end when the edges are stars around the least nodes, after about as many rounds as the logarithm of the nodes.
    """

    lows: list[DataFrame] = []

    def least(rows: DataFrame, larger: bool) -> DataFrame:
        # of each node with its neighbours: u's neighbours v (only larger or only smaller ones than u) move to the least
        both = rows.union(rows.select(F.col("v").alias("u"), F.col("u").alias("v"))) if larger else rows
        lows.append(written(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "lows"))
        joined = both.join(lows[-1], "u")
        moved = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")) if larger else joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(lows[-1].select("u", F.col("m").alias("v")))
        return moved.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    now = written(edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while True:
        # done when no least neighbour has a lesser one itself, and no node has two
        chained = now.join(now.select(F.col("u").alias("v")), "v", "left_semi").isEmpty()
        if chained and now.groupBy("u").count().filter("count > 1").isEmpty():
            break
        after = written(least(least(now, True), False), "links")
        dropped(now, *lows)
        now = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def _pairs(buckets: DataFrame) -> DataFrame:
    """(a, b) with a > b: each bucket's members with its leaders, the most famous one and LEADERS drawn ones."""
    ranks = [F.struct(-F.col("fame"), F.col("tid"))] + [F.xxhash64("bucket", "tid", F.lit(k)) for k in range(LEADERS)]
    least = [F.min(F.struct(rank.alias("rank"), F.col("tid").alias("tid"))).alias(f"l{k}") for k, rank in enumerate(ranks)]
    chosen = buckets.groupBy("bucket").agg(*least)
    chosen = written(chosen.select("bucket", F.array_distinct(F.array(*[F.col(f"l{k}.tid") for k in range(len(ranks))])).alias("leaders")), "leaders")
    both = buckets.join(chosen, "bucket").select("tid", F.explode("leaders").alias("leader")).filter("tid != leader")
    return both.select(F.greatest("tid", "leader").alias("a"), F.least("tid", "leader").alias("b")).distinct()


def _smaller(sketches: pa.ChunkedArray, bucket: np.ndarray) -> np.ndarray:
    """A row a text: those of its sketches that are less than the bucket it stands in, each at its place, NO_BUCKET elsewhere."""
    lists = sketches.combine_chunks()
    counts = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.full((len(counts), int(counts.max(initial=0))), NO_BUCKET)
    out[np.arange(out.shape[1]) < counts[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    out[out >= bucket[:, None]] = NO_BUCKET
    return out


def _left_pairs(named: DataFrame, words: DataFrame, least: float) -> DataFrame:
    """(a, b) with a > b of named (bucket, tid, label): the pairs of a bucket with different labels that may be near.

    A bucket's members are parted by length: near ones are in the same band of lengths or in neighbouring ones, so each member
    stands in the pool of its own band and in the next. In a pool, members of the label that most have need no comparison with
    each other. They are dealt to blocks, and so are all others; a cell takes a block of the one kind and a block of the
    others, or two blocks of others. So a pool of n members of which m have other labels makes about n + n * m / BLOCK rows,
    and a large one isn't one task's. Where words has the texts' sketches, a pair comes from the least of the buckets that both are
    in and from no other, so it is compared and made once, however many buckets it shares.
    """
    told = ["bins", *(c for c in words.columns if c == "sketches")]
    band = F.floor(F.log(F.col("n_words").cast("double")) / F.log(F.lit(1 / least)))
    sized = named.join(words.select("tid", F.col("n_words")), "tid").withColumn("band", band)
    rows = sized.select("bucket", "tid", "label", F.explode(F.array(F.struct(F.col("band").alias("pool"), F.lit(True).alias("own")), F.struct((F.col("band") + 1).alias("pool"), F.lit(False).alias("own")))).alias("p")).select("bucket", "tid", "label", "p.*")
    labels = rows.groupBy("bucket", "pool", "label").agg(F.count(F.lit(1)).alias("n"), F.bool_or("own").alias("own"))
    pools = labels.groupBy("bucket", "pool").agg(F.max(F.struct("n", "label")).alias("main"), F.sum("n").alias("n"), F.bool_or("own").alias("own"))
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    mixed = pools.filter("own AND main.n < n").select("bucket", "pool", F.col("main.label").alias("main"), blocks(F.col("main.n")).alias("mains"), blocks(F.col("n") - F.col("main.n")).alias("others"))
    rows = rows.join(written(mixed, "mixed"), ["bucket", "pool"]).withColumn("is_main", F.col("label") == F.col("main"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("tid"), F.when(F.col("is_main"), F.col("mains")).otherwise(F.col("others"))).cast("int"))
    # cells are (low, high): a block of the main label is numbered from -1 down, and always the low one
    cell = lambda low, high: F.struct(low.alias("low"), high.alias("high"), (F.col("block") == high).alias("high_side"))
    to = lambda n: F.sequence(F.lit(0), n - 1)
    main_cells = F.transform(to(F.col("others")), lambda o: F.struct((-1 - F.col("block")).alias("low"), o.alias("high"), F.lit(False).alias("high_side")))
    other_cells = F.concat(
        F.transform(to(F.col("mains")), lambda m: F.struct((-1 - m).alias("low"), F.col("block").alias("high"), F.lit(True).alias("high_side"))),
        F.transform(to(F.col("others")), lambda o: cell(F.least(F.col("block"), o), F.greatest(F.col("block"), o))),
    )
    rows = rows.withColumn("cell", F.explode(F.when(F.col("is_main"), main_cells).otherwise(other_cells))).select("bucket", "pool", "cell.*", "tid", "label", "own")
    rows = rows.join(words.select("tid", *told), "tid")
    cell = ["bucket", "pool", "low", "high"]

    def compared(cells: pa.Table) -> pa.RecordBatch:
        tid, label = (cells.column(c).to_numpy() for c in ("tid", "label"))
        side, own = (np.asarray(cells.column(c).combine_chunks().to_numpy(zero_copy_only=False), bool) for c in ("high_side", "own"))
        bins = np.array([np.frombuffer(x, f"u{len(x) // BINS}") for x in cells.column("bins").to_pylist()])
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        keys = np.stack([cells.column(c).to_numpy() for c in cell])
        before = _smaller(cells.column("sketches"), keys[0]) if "sketches" in told else np.zeros((len(tid), 0), np.int64)
        starts = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
        for i, j in zip(starts, np.r_[starts[1:], len(tid)], strict=True):
            ids = tid[i:j]
            for m, others in possible(bins[i:j], label[i:j], side[i:j], keys[2, i] != keys[3, i], own[i:j], least, before[i:j]):
                a.append(np.maximum(ids[m], ids[others]))
                b.append(np.minimum(ids[m], ids[others]))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of the last cell so far, which may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            keys = np.stack([rows.column(c).to_numpy() for c in cell])
            last = int(np.argmax((keys == keys[:, -1:]).all(axis=0)))
            if last:
                yield compared(rows.slice(0, last))
            held = rows.slice(last)
        if held is not None:
            yield compared(held)

    return rows.repartition(*cell).sortWithinPartitions(*cell).mapInArrow(work, "a long, b long").distinct()


def near_duplicate_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """Per row: (dk, digest, class_id, class_size, first): class_id is the least document id of its class, first whether the row is that document.

    Equal texts are of one class, texts without words only with equal ones. A null text is empty; a null id comes before all
    others (as class_id it is null); repeated rows are documents of one class, all ``first`` if any is; an empty table gives
    none; other columns are ignored. Classes are what links join: two members may be less alike than ``least``.
    """
    docs = df.select(id_key(id_col).alias("dk"), F.unhex(F.md5(text_or_empty(text_col).cast("binary"))).alias("digest"), text_or_empty(text_col).cast("binary").alias("raw"))
    rows = written(_sketched(docs), "sketches")
    first = rows.groupBy("digest").agg(F.min(F.struct("dk", "sketches")).alias("f"))
    texts = written(first.select(F.monotonically_increasing_id().alias("tid"), "digest", "f.dk", "f.sketches"), "texts")
    members = texts.select("tid", F.explode("sketches").alias("bucket"))
    sizes = written(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "sizes")
    shared = members.join(sizes, "bucket")
    fame = written(shared.groupBy("tid").agg(F.sum("size").alias("fame")), "fame")
    buckets = written(shared.join(fame, "tid").select("bucket", "tid", "fame"), "buckets")
    words = written(_with_words(docs.dropDuplicates(["dk", "digest"]) if _repeats(rows) else docs, fame.join(texts, "tid").select("tid", "dk", "digest", "sketches")), "words")
    dropped(sizes, fame)
    pairs = written(_pairs(buckets), "pairs")
    edges = written(_verified(pairs, words, least), "edges")
    labels = components(edges)
    # what no leader decided: pairs of texts that share a bucket and are in different classes still
    now = buckets.join(labels.withColumnRenamed("node", "tid"), "tid", "left").select("bucket", "tid", F.coalesce("label", "tid").alias("label"))
    left = written(_left_pairs(now, words, least).join(pairs, ["a", "b"], "left_anti"), "pairs")
    more = written(_verified(left, words, least), "edges")
    dropped(left, words, buckets, pairs)
    if not more.isEmpty():
        labels = components(edges.union(more))
    labels = written(labels, "labels")
    dropped(edges, more)
    tids = texts.join(labels.withColumnRenamed("node", "tid"), "tid", "left").select("digest", "dk", F.coalesce("label", "tid").alias("label"))
    counted = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"))
    tids = written(tids.join(counted, "digest"), "classes")
    classes = written(tids.groupBy("label").agg(F.min("dk").alias("class"), F.min(F.struct("dk", "digest")).alias("f"), F.sum("copies").alias("class_size")), "named")
    named = written(tids.join(classes, "label").select("digest", "class", "class_size", F.col("f.digest").alias("d"), F.col("f.dk").alias("k")), "named")
    dropped(texts, labels, tids, classes)
    told = rows.select("dk", "digest").join(named, "digest")
    told = told.select("dk", "digest", F.col("class").alias("class_key"), "class_size", ((F.col("dk") == F.col("k")) & (F.col("digest") == F.col("d"))).alias("first"))
    # what is left of all tables is this one, a row a document
    told = written(told, "told")
    dropped(rows, named)
    return told


def _repeats(rows: DataFrame) -> bool:
    return bool(rows.groupBy("dk", "digest").count().filter("count > 1").limit(1).count())


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """Per row: id, class_id (the least id of its class), class_size and representative (whether it is that document).

    Odd rows are treated as in ``near_duplicate_classes``: null and empty texts are equal to each other, equal texts are of one
    class, texts are aligned whole whatever their length, a null id stays null and comes first, an empty table gives none.
    """
    found = near_duplicate_classes(df, id_col, text_col, least)
    return found.select(shown_id(F.col("dk")).alias(id_col), shown_id(F.col("class_key")).alias("class_id"), "class_size", F.col("first").alias("representative"))


def one_of_each_class(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """The rows of df, with all their columns, that stand for their class: one row a class.

    That is the document of the least id (a null id comes first; of equal ids the least digest), and one of its rows where rows
    are repeated. Null, empty and blank texts are near to equal ones only; texts are aligned whole, whatever their length; columns
    of any name pass; an empty table gives none.
    """
    names = [f"c{k}" for k in range(len(df.columns))]  # no name of df can clash with the keys
    key, text = (names[df.columns.index(c)] for c in (id_col, text_col))
    kept = near_duplicate_classes(df, id_col, text_col, least).filter("first").select("dk", "digest").distinct()
    rows = df.toDF(*names).withColumn("dk", id_key(key)).withColumn("digest", F.unhex(F.md5(text_or_empty(text).cast("binary")))).join(written(kept, "kept"), ["dk", "digest"])
    alone = rows.groupBy("dk", "digest").agg(F.first(F.struct(*names)).alias("row"))
    return alone.select("row.*").toDF(*df.columns)
