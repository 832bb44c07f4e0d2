"""Running numbers within keys, over rows that lie in ranges of (key, order).

A window sends all rows of a key to one task.  Here rows are sorted into ranges,
a key may lie in many of them, each task numbers its own rows in one pass, and
what a range takes over from earlier ones is one row per range.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelathe.llm.common import staged

#: Odd factor: running sums of a * FACTOR^position tell sequences apart, where a is a hash.
FACTOR = 0x9E3779B97F4A7C15


def _power(factor: int, n: np.ndarray | int) -> np.ndarray:
    """factor ** n modulo 2^64."""
    n = np.asarray(n, np.uint64).copy()
    out, base = np.ones(n.shape, np.uint64), np.uint64(factor)
    with np.errstate(over="ignore"):
        while n.any():
            out = np.where(n & np.uint64(1), out * base, out)
            base, n = base * base, n >> np.uint64(1)
    return out


class _Run:
    """The scan of one range: what the last key has reached so far."""

    def __init__(self, factors: Sequence[int]):
        self.factors, self.key, self.count = factors, None, 0
        self.sums = [np.uint64(0)] * len(factors)

    def add(self, key: np.ndarray, terms: Sequence[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """Positions and, for each factor, running sums without and with the row itself."""
        n = len(key)
        opens = np.ones(n, bool)
        opens[1:] = key[1:] != key[:-1]
        opens[0] = self.key is None or key[0] != self.key
        first = np.flatnonzero(opens)
        # Rows before the first opening carry on with the key of the batch before.
        start = np.concatenate([[0], first]) if not opens[0] else first
        run = np.searchsorted(start, np.arange(n), side="right") - 1
        carried = np.zeros(len(start), np.int64)
        if not opens[0]:
            carried[0] = self.count
        position = np.arange(n) - start[run] + 1 + carried[run]
        before, upto = [], []
        with np.errstate(over="ignore"):
            for i, (factor, term) in enumerate(zip(self.factors, terms, strict=True)):
                own = term.view(np.uint64) * (_power(factor, position) if factor != 1 else np.uint64(1))
                total = np.cumsum(own, dtype=np.uint64)
                base = np.where(start > 0, total[start - 1], np.uint64(0))
                if not opens[0]:
                    base[0] -= self.sums[i]
                reached = total - base[run]
                before.append((reached - own).view(np.int64))
                upto.append(reached.view(np.int64))
                self.sums[i] = reached[-1]
        self.key, self.count = key[-1], int(position[-1])
        return position, before, upto


def scanned(rows: DataFrame, key: str, order: Sequence[Column], running: dict[str, tuple[str, int]], name: str) -> DataFrame:
    """The rows with ``position`` (from 1) and running sums within their key.

    ``key`` is a bigint column without nulls; ``order`` makes the order of a
    key's rows definite.  ``running`` names a bigint column and a factor for each
    new column: ``new`` is the sum of column * factor^position up to the row,
    modulo 2^64, ``new_before`` the same without the row.
    """
    spark = rows.sparkSession
    new, columns, factors = list(running), [c for c, _ in running.values()], [f for _, f in running.values()]
    added = ["position", *[f"{n}{end}" for n in new for end in ("", "_before")]]
    ranged = rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order).select(F.spark_partition_id().alias("part"), "*")
    fields = [*ranged.schema.fields, T.StructField("opens", T.BooleanType()), *[T.StructField(a, T.LongType()) for a in added]]
    schema = T.StructType(fields)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, opening = _Run(factors), None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key).to_numpy()
            opening = keys[0] if opening is None else opening
            position, before, upto = run.add(keys, [batch.column(c).to_numpy() for c in columns])
            sums = [x for pair in zip(upto, before, strict=True) for x in pair]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys == opening), *map(pa.array, [position, *sums])], schema.names)

    found = staged(ranged.mapInArrow(scan, schema), name)
    carries = _carries(found, key, new, factors)
    shared = spark.sparkContext.broadcast(carries)

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = {n: c for n, c in zip(batch.schema.names, batch.columns, strict=True)}
            at, local = batch.column("part").to_numpy(), batch.column("position").to_numpy()
            counts = np.array([shared.value.get(p, (0,))[0] for p in at.tolist()], np.int64)
            with np.errstate(over="ignore"):
                for i, (n, factor) in enumerate(zip(new, factors, strict=True)):
                    start = np.array([shared.value[p][1 + i] if p in shared.value else 0 for p in at.tolist()], np.uint64)
                    moved = _power(factor, counts) if factor != 1 else np.uint64(1)
                    for c in (n, f"{n}_before"):
                        table[c] = pa.array((start + batch.column(c).to_numpy().view(np.uint64) * moved).view(np.int64))
            table["position"] = pa.array(local + counts)
            yield pa.RecordBatch.from_arrays(list(table.values()), list(table))

    whole = found.where("NOT opens").unionByName(found.where("opens").mapInArrow(carry, schema)) if carries else found
    return whole.drop("part", "opens")


def _carries(found: DataFrame, key: str, new: Sequence[str], factors: Sequence[int]) -> dict[int, tuple[int, ...]]:
    """What each range's first key has reached in earlier ranges; one row per range comes to the driver."""
    last = F.max(F.struct(key, "position", *new)).alias("last")
    ranges = found.groupBy("part").agg(F.min(key).alias("first"), last).orderBy("part").collect()
    out, held, mask = {}, None, (1 << 64) - 1
    for r in ranges:
        total = [r.last["position"], *[r.last[n] & mask for n in new]]
        if held is not None and held[0] == r.first:
            out[r.part] = tuple(held[1])
            if r.last[key] == r.first:
                count = held[1][0]
                total = [count + total[0], *[(s + x * pow(f, count, 1 << 64)) & mask for s, x, f in zip(held[1][1:], total[1:], factors, strict=True)]]
        held = (r.last[key], total)
    return out
