"""Differences of large tables that are almost the same, from sketches.

Each row adds its hash to three cells of an invertible Bloom table, with a plus for the one side and a minus for the other; what
both sides hold cancels out. Cells are sums, so partitions' tables merge, and a shuffle carries cells instead of rows. A cell
that holds one row's hash only, however often, shows it; taking that hash out of its other cells lays more of them bare. If
that ends with empty cells, the hashes that differ are known, and only rows with those are compared. If it stalls, more
differs than the table can show, and the ranges of hashes whose sums differ are compared whole.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.operators.release import row_hash

#: Cells of each of the three parts of a table, and ranges of hashes for what it can't show. At most 2 ** 20 and 2 ** 12.
CELLS, RANGES = 4096, 1024
PARTS = 3


def _key(cols: list[str]) -> Column:
    """60 bits of a row: equal for equal rows, nulls and empty texts told apart."""
    return row_hash(F.to_json(F.struct(*[F.col(c).alias(f"c{k}") for k, c in enumerate(cols)]), {"ignoreNullFields": "false"}))


def _places(key: int, cells: int) -> tuple[int, list[tuple[int, int]]]:
    """(check number, cells) of a key, as ``sketch`` has them."""
    digits = hashlib.md5(str(key).encode()).hexdigest()
    return int(digits[:15], 16), [(part, int(digits[15 + 5 * part : 20 + 5 * part], 16) % cells) for part in range(PARTS)]


def sketch(df: DataFrame, cols: list[str] | None = None, sign: int = 1, cells: int = CELLS) -> DataFrame:
    """(part, cell, n, keys, checks): a table of at most PARTS * cells rows; those of parts of a table add up to that of the whole."""
    rows = df.select(_key(cols or df.columns).alias("key"))
    digits = F.md5(F.col("key").cast("string"))
    number = lambda at, n: F.conv(F.substring(digits, at, n), 16, 10).cast("long")
    places = F.array(*[F.struct(F.lit(part).alias("part"), (number(16 + 5 * part, 5) % cells).alias("cell")) for part in range(PARTS)])
    each = rows.select("key", number(1, 15).alias("check"), F.explode(places).alias("at"))
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)") * sign).cast("decimal(38,0)").alias(f"{c}s")
    return each.groupBy("at.part", "at.cell").agg((F.count(F.lit(1)) * sign).alias("n"), exact("key"), exact("check"))


def merged(*sketches: DataFrame) -> DataFrame:
    """The sum of sketches, without cells in which everything cancels out."""
    out = sketches[0]
    for s in sketches[1:]:
        out = out.unionByName(s)
    total = out.groupBy("part", "cell").agg(F.sum("n").alias("n"), F.sum("keys").alias("keys"), F.sum("checks").alias("checks"))
    return total.filter("n <> 0 OR keys <> 0 OR checks <> 0")


def peeled(table: dict[tuple[int, int], tuple[int, int, int]], cells: int) -> dict[int, int] | None:
    """{key: how often more on the plus side} of a sketch {(part, cell): (n, keys, checks)}; None if it stalls."""
    table, found = dict(table), {}
    going = list(table)
    while going:
        at = going.pop()
        n, keys, checks = table.get(at, (0, 0, 0))
        if not n or keys % n:
            continue
        key = keys // n
        check, places = _places(key, cells)
        if checks != n * check or at not in places:
            continue
        found[key] = found.get(key, 0) + n
        for p in places:
            left = tuple(x - y for x, y in zip(table.get(p, (0, 0, 0)), (n, n * key, n * check), strict=True))
            if any(left):
                table[p] = left
                going.append(p)
            else:
                table.pop(p, None)
    return {k: n for k, n in found.items() if n} if not table else None


def sparse_difference(new: DataFrame, stored: DataFrame, cells: int = CELLS, ranges: int = RANGES) -> DataFrame:
    """(side, ...): rows that only one of two tables has, repeats counted, for tables that differ little.

    Rows are told apart by 60 bits of their hash until those that differ are known; rows themselves decide among them. At most
    PARTS * cells cells and as many hashes, or ``ranges`` numbers, reach the driver.
    """
    cols = new.columns
    stored = stored.select(cols)
    rows = merged(sketch(new, cols, 1, cells), sketch(stored, cols, -1, cells)).collect()
    found = peeled({(r["part"], r["cell"]): (int(r["n"]), int(r["keys"]), int(r["checks"])) for r in rows}, cells)
    if found is None:
        at = F.pmod(_key(cols), F.lit(ranges))
        sums = [d.groupBy(at.alias("range")).agg(F.sum(_key(cols).cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n"), F.bit_xor(_key(cols)).alias("x")) for d in (new, stored)]
        other = sums[1].toDF("range", "s2", "n2", "x2")
        differ = sums[0].join(other, "range", "full").filter("NOT (s <=> s2 AND n <=> n2 AND x <=> x2)").select("range")
        keep = at.isin([r["range"] for r in differ.collect()])
    else:
        keep = _key(cols).isin(list(found))
    a, b = new.filter(keep), stored.filter(keep)
    return a.exceptAll(b).select(F.lit("new").alias("side"), "*").union(b.exceptAll(a).select(F.lit("stored").alias("side"), "*"))
