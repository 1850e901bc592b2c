"""Segmented scans: context over ordered lines, for documents of any length.

A document's lines are cut into blocks of ``BLOCK`` lines, and a block, not a document, is the unit of parallelism. What looks back
or ahead a bounded number of lines gets copies of the neighbouring blocks' nearest lines. What looks back to the beginning is
scanned in two steps: inside each block, and over one summary row a block (how many matches, the last value), which is carried
into the blocks that follow. Summaries are made before rows are shuffled, so a document of n lines is one task's only as
n / BLOCK rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Lines of a block.
BLOCK = 8192


@dataclass(frozen=True)
class Carry:
    """The last value that isn't null: of all lines so far, or of the last ``back`` lines; inclusive of the line itself or not."""

    value: Column
    back: int | None = None
    inclusive: bool = True


@dataclass(frozen=True)
class Total:
    """start and the sum of a number over all lines up to and including the line."""

    value: Column
    start: int = 0


@dataclass(frozen=True)
class Ahead:
    """The values of the next ``most`` lines, in order, nulls left out."""

    value: Column
    most: int


def context(df: DataFrame, wanted: dict[str, Carry | Total | Ahead], key: str = "doc_id", order: str = "line_no", size: int = BLOCK) -> DataFrame:
    """df with a column for each wanted context.

    ``order`` numbers the lines of a document in steps of one, from any beginning. Null keys are one document; an empty table gives
    none. All columns come from one shuffle of the rows; bounds of more than a block raise.
    """
    near = [w for w in wanted.values() if isinstance(w, Carry) and w.back is not None]
    back = max((w.back for w in near), default=0)
    ahead = max((w.most for w in wanted.values() if isinstance(w, Ahead)), default=0)
    if max(back, ahead) > size:
        raise ValueError(f"bounds of {max(back, ahead)} lines need blocks of as many, not {size}")
    names = {out: f"_w{k}" for k, out in enumerate(wanted)}
    far = {out: w for out, w in wanted.items() if isinstance(w, Total) or isinstance(w, Carry) and w.back is None}
    rows = df.select("*", F.floor(F.col(order) / size).alias("_block"), *[w.value.alias(names[out]) for out, w in wanted.items()])
    blocked = _with_neighbours(rows, order, size, back, ahead)
    w = Window.partitionBy(key, "_block").orderBy(order)
    before = lambda inclusive: w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    own = lambda c: F.when(F.col("_own"), F.col(c))
    made = {}
    for out, what in wanted.items():
        c = names[out]
        if isinstance(what, Ahead):
            made[out] = F.collect_list(c).over(w.rowsBetween(1, what.most))
        elif isinstance(what, Total):
            made[out] = F.sum(own(c)).over(before(True))
        elif what.back is None:
            made[out] = F.last(own(c), True).over(before(what.inclusive))
        else:
            made[out] = F.last(c, True).over(w.rowsBetween(-what.back, 0 if what.inclusive else -1))
    kept = [c for c in df.columns if c not in wanted]
    found = blocked.select(*kept, "_block", "_own", *[col.alias(names[out]) for out, col in made.items()]).filter("_own")
    if far:
        found = _carried(found, rows, far, names, key, order)
    shown = lambda out, what: (F.coalesce(F.col(names[out]), F.lit(0)) + what.start if isinstance(what, Total) else F.col(names[out])).alias(out)
    return found.select(*kept, *[shown(out, what) for out, what in wanted.items()])


def _with_neighbours(rows: DataFrame, order: str, size: int, back: int, ahead: int) -> DataFrame:
    """rows with ``_own``, and copies of the lines near a block's end in the block after it, and of those near its beginning in the block before it."""
    if not back and not ahead:
        return rows.withColumn("_own", F.lit(True))
    at, block = F.pmod(F.col(order), F.lit(size)), F.col("_block")
    to = lambda b, own: F.struct(b.alias("_block"), F.lit(own).alias("_own"))
    copies = F.array_compact(F.array(to(block, True), F.when(at >= size - back, to(block + 1, False)), F.when(at < ahead, to(block - 1, False))))
    return rows.withColumn("_to", F.explode(copies)).drop("_block").select("*", "_to.*").drop("_to")


def _carried(found: DataFrame, rows: DataFrame, far: dict[str, Carry | Total], names: dict[str, str], key: str, order: str) -> DataFrame:
    """found with what the blocks before a row's block hand on."""
    each = {}
    for out, what in far.items():
        c = names[out]
        # a value in a struct, since the greatest line decides, not the value
        each[out] = F.sum(c) if isinstance(what, Total) else F.max_by(F.struct(c), F.when(F.col(c).isNotNull(), F.col(order)))[c]
    blocks = rows.groupBy(F.col(key).alias("_k"), F.col("_block").alias("_b")).agg(*[e.alias(f"_in{names[out]}") for out, e in each.items()])
    earlier = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    hand = {out: (F.sum if isinstance(what, Total) else lambda c: F.last(c, True))(f"_in{names[out]}").over(earlier) for out, what in far.items()}
    blocks = blocks.select("_k", "_b", *[h.alias(f"_in{names[out]}") for out, h in hand.items()])
    joined = found.join(blocks, (F.col("_block") == F.col("_b")) & F.col(key).eqNullSafe(F.col("_k")), "left")
    for out, what in far.items():
        inner, handed = F.col(names[out]), F.col(f"_in{names[out]}")
        whole = F.coalesce(inner, F.lit(0)) + F.coalesce(handed, F.lit(0)) if isinstance(what, Total) else F.coalesce(inner, handed)
        joined = joined.withColumn(names[out], whole)
    return joined
