"""Document fingerprints: bottom-k sketches of word shingles, with DataFrame functions only.

A sketch is the ascending array of the k least distinct 64-bit hashes of a text's five-word shingles. The sketch of a union
is the bottom k of the union of sketches, so sketches of parts merge; two sketches estimate resemblance, containment and
the number of distinct shingles.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.llm.common import id_key, shown_id, text_or_empty, written

K = 128
SHINGLE = 5
#: Rows of a range of ids that is sorted in one piece, and how many ranges the driver knows the bounds of; beyond, each is split again.
RANGE_ROWS, MOST_RANGES = 250, 10_000


def word_hashes(text: Column) -> Column:
    """A 64-bit hash of each word, in order."""
    return F.transform(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), ""), lambda w: F.xxhash64(w))


def shingle_hashes(words: str, size: int = SHINGLE) -> Column:
    """Hashes of ``size`` words in a row, of a column of word hashes; a shorter text is one shingle, an empty one has none."""
    w = F.col(words)
    whole = F.transform(F.sequence(F.lit(0), F.size(w) - size), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)]))
    return F.when(F.size(w) >= size, whole).when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))


def bottom(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def with_sketch(df: DataFrame, text_col: str, out: str, k: int = K, size: int = SHINGLE) -> DataFrame:
    """df with the sketch of a text column. The word hashes are a column of their own, so they are computed once a row."""
    words = f"{out}__words"
    return df.withColumn(words, word_hashes(F.coalesce(F.col(text_col), F.lit("")))).withColumn(out, bottom(shingle_hashes(words, size), k)).drop(words)


def merged(df: DataFrame, group_cols: list[str], sketch_col: str, k: int = K) -> DataFrame:
    """One sketch a group, of the union of its rows' sketches. Hashes are made distinct before they meet and only the k least of a group are gathered."""
    each = df.select(*group_cols, F.explode(sketch_col).alias("hash__")).distinct()
    least = each.withColumn("rank__", F.row_number().over(Window.partitionBy(*group_cols).orderBy("hash__"))).filter(F.col("rank__") <= k)
    return least.groupBy(*group_cols).agg(F.sort_array(F.collect_list("hash__")).alias(sketch_col))


def resemblance(a: str, b: str, k: int = K) -> Column:
    """Estimated share of shingles that both have among those that either has; 1 for two empty texts."""
    both = F.slice(F.sort_array(F.array_union(F.col(a), F.col(b))), 1, k)
    shared = F.size(F.array_intersect(F.array_intersect(both, F.col(a)), F.col(b)))
    return F.when(F.size(both) == 0, 1.0).otherwise(shared / F.size(both))


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k, else from the place of the k-th least hash in the 64-bit range."""
    place = (F.element_at(sketch, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / place)


def containment(a: str, b: str, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too; 1 for an empty a."""
    union = bottom(F.array_union(F.col(a), F.col(b)), k)
    share = resemblance(a, b, k) * distinct_shingles(union, k) / distinct_shingles(F.col(a), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), share))


def as_text(sketch: Column) -> Column:
    """A sketch as one string: 16 hexadecimal digits a hash."""
    return F.array_join(F.transform(sketch, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def with_next(df: DataFrame, key_col: str, carried: list[str], then: str = "next_", prepare=lambda d: d) -> DataFrame:
    """df with ``next_`` columns: those of the row that follows by (key, carried[0]), cyclically. Keys must not be null.

    Rows are dealt to ranges of keys whose bounds are keys of the table; the row at a bound goes to both sides, the first row
    also behind the last range. So each range is sorted on its own. Rows of more than MOST_RANGES ranges are dealt to ranges of
    ranges, so ranges don't grow with the table; rows of one key stay in one range. prepare, a function on the dealt rows, runs
    after the shuffle (what it adds isn't shuffled).
    """
    count, least = df.agg(F.count(F.lit(1)), F.min(key_col)).first()
    ranges = min(MOST_RANGES, -(-count // RANGE_ROWS)) or 1
    bounds: list[int] = []
    if ranges > 1:
        asked = [i / ranges for i in range(1, ranges)]
        bounds = sorted(set(df.agg(F.percentile_approx(key_col, asked, 20 * ranges)).first()[0]) - {least})
    known = F.from_json(F.lit(json.dumps(bounds)), "array<bigint>")
    key = F.col(key_col)
    placed, last = df.withColumn("bucket__", _below(known, len(bounds), key).cast("long")), F.lit(len(bounds)).cast("long")
    begins = (F.col("bucket__") > 0) & (F.get(known, (F.col("bucket__") - 1).cast("int")) == key)
    if count > MOST_RANGES * RANGE_ROWS:
        # ranges of ranges: the inner bounds are a table, a row an outer range, that rows are joined with
        inner = min(MOST_RANGES, -(-count // (RANGE_ROWS * ranges)))
        asked = [i / inner for i in range(1, inner)]
        cut = placed.groupBy("bucket__").agg(F.array_sort(F.array_distinct(F.percentile_approx(key_col, asked, 20 * inner))).alias("inner__"), F.min(key_col).alias("least__"))
        cut = cut.withColumn("inner__", F.filter("inner__", lambda x: x > F.col("least__")))
        before = Window.orderBy("bucket__").rowsBetween(Window.unboundedPreceding, -1)  # a row an outer range
        cut = written(cut.select("bucket__", "inner__", F.coalesce(F.sum(F.size("inner__") + 1).over(before), F.lit(0)).alias("base__")), "ranges")
        last = F.lit(cut.agg(F.max(F.col("base__") + F.size("inner__"))).first()[0]).cast("long")
        nth = _counted(F.col("inner__"), key, lambda at, bound, key: F.when(bound <= key, at + 1).otherwise(at))
        placed = placed.withColumn("begins__", begins).join(cut, "bucket__").withColumn("nth__", nth)
        begins = F.when(F.col("nth__") > 0, F.get("inner__", F.col("nth__") - 1) == key).otherwise(F.col("begins__"))
        placed = placed.select(*df.columns, (F.col("base__") + F.col("nth__")).alias("bucket__"), begins.alias("begins__"))
        begins = F.col("begins__")
    places = F.array_compact(
        F.array(
            F.struct(F.col("bucket__").alias("bucket"), F.lit(0).alias("after"), F.lit(True).alias("own")),
            F.when(begins & (F.col("bucket__") > 0), F.struct((F.col("bucket__") - 1).alias("bucket"), F.lit(0).alias("after"), F.lit(False).alias("own"))),
            F.when(key == F.lit(least), F.struct(last.alias("bucket"), F.lit(1).alias("after"), F.lit(False).alias("own"))),
        )
    )
    dealt = placed.withColumn("place__", F.explode(places)).select(*df.columns, "place__.*").repartition("bucket")
    order = Window.partitionBy("bucket").orderBy("after", key_col, carried[0])
    rows = prepare(dealt)
    return rows.select("*", *[F.lead(c).over(order).alias(f"{then}{c}") for c in carried]).filter("own").drop("bucket", "after", "own")


def _below(bounds: Column, most: int, key: Column) -> Column:
    """How many of at most ``most`` ascending bounds, a constant, are at or below the key, by bisection.

    The key goes with the accumulator, since the lambda must name no column of the table. Spark compares expressions by forms
    whose lambda variables are numbered from 0; a column that has one of these numbers, as in the first query of a session, is
    taken for such a variable there, and a join on the result then filters its other side by a column that side lacks.
    """
    halves = [1 << k for k in range(max(most, 1).bit_length() - 1, -1, -1)]
    return _counted(F.array(*[F.lit(h) for h in halves]), key, lambda at, h, key: F.when(F.get(bounds, at + h - 1) <= key, at + h).otherwise(at))


def _counted(over: Column, key: Column, step) -> Column:
    """The number that step(number so far, element, key) makes of 0 over the elements of an array."""
    state = lambda at, key: F.struct(at.alias("at"), key.alias("key"))
    return F.aggregate(over, state(F.lit(0), key), lambda s, x: state(step(s["at"], x, s["key"]), s["key"]), lambda s: s["at"])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """Fingerprints of each text, of the text whose latter half is exchanged for the next document's beginning, and their likeness.

    Rows: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_shingles (how many different ones
    the text has, estimated) and held_by_edited (the share of them that the edited text holds, estimated). A null text is empty; a null id
    comes first and stays null; rows of equal id follow each other by text; a single row follows itself; an empty table gives
    none; very long texts are shingled whole; other columns are ignored.
    """
    rows = df.select(id_key(id_col).alias("dk"), text_or_empty(text_col).alias("text"))
    rows = with_next(rows, "dk", ["text", "sketch"], prepare=lambda d: with_sketch(d, "text", "sketch", k))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn("edited", edited).drop("text", "next_text")
    rows = with_sketch(rows.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)), "edited", "edited_sketch", k)
    return rows.select(
        shown_id(F.col("dk")).alias(id_col),
        "n_chars",
        "edited_sha256",
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance("sketch", "edited_sketch", k).alias("near_edited"),
        resemblance("sketch", "next_sketch", k).alias("near_next"),
        distinct_shingles(F.col("sketch"), k).alias("n_shingles"),
        containment("sketch", "edited_sketch", k).alias("held_by_edited"),
    )
