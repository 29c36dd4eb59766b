"""Segmented scans: running values within groups of any size, in two passes.

Rows are sorted by group and order over range partitions, so a group may span many of them. The
first pass scans each partition by itself. The driver gets two rows of each partition, its first
and its last, and works out what is carried into the next; the second pass adds that. Memory in a
task follows the batch, not the group, and what the driver gets follows the number of partitions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barframe.plans.workspace import scratch_path

#: Fingerprints are values of a polynomial over this prime field; its coefficients are digests.
PRIME = (1 << 127) - 1
BASE = 0x2B7E151628AED2A6ABF7158809CF4F3C
_LOW = (1 << 64) - 1


def _signed(values: list[int]) -> np.ndarray:
    return np.array([v & _LOW for v in values], np.uint64).view(np.int64)


def _joined(high: int, low: int) -> int:
    return (high << 64) | (low & _LOW)


def _changes(batch: pa.RecordBatch, group: Sequence[str]) -> np.ndarray:
    """Whether a row's group differs from that of the row before it (the first row: True)."""
    out = np.zeros(batch.num_rows, bool)
    out[:1] = True
    for name in group:
        column = batch.column(name)
        out[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    return out


def segmented_scan(
    df: DataFrame, group: Sequence[str], order: Sequence[str], *, sums: Sequence[str] = (), lead: Sequence[str] = (),
    chain: str | None = None,
) -> DataFrame:
    """``df`` with running values of each row within its group (columns without NULLs), by ``order``.

    ``index``: rows of the group before this one. ``last``: whether no row follows. For each of
    ``sums`` (bigint columns), ``<name>_upto``: the sum up to this row, itself included. For each of
    ``lead``, ``<name>_next``: the next row's value (NULL for the last). With ``chain``, a binary
    column: ``key_hi, key_lo``, a 127-bit fingerprint of the sequence of its values up to this row,
    and ``before_hi, before_lo``, that of the rows before it (NULL for the first).

    Rows equal in all of ``order`` are put in any order. An empty table gives an empty result.
    """
    spark = df.sparkSession
    names = list(df.columns)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    group, sums, lead = list(group), list(sums), list(lead)
    added = {"__part": "int", "__row": "bigint", "__run": "bigint", "__open": "boolean", "last": "boolean", "index": "bigint"}
    added |= {f"{s}_upto": "bigint" for s in sums} | {f"{c}_next": kinds[c] for c in lead}
    if chain:
        added |= {c: "bigint" for c in ("key_hi", "key_lo", "before_hi", "before_lo")}
    schema = ", ".join(f"`{n}` {k}" for n, k in {**kinds, **added}.items())
    all_names = [*names, *added]

    def finished(batch: pa.RecordBatch, own: dict, following: pa.RecordBatch | None, goes_on: bool) -> pa.RecordBatch:
        """The batch with its running values; ``following`` is the next batch of the partition, if any."""
        n = batch.num_rows
        last = np.ones(n, bool)
        last[:-1] = own["new"][1:]
        last[-1] = following is None or not goes_on
        own["__open"] = np.zeros(n, bool)
        own["__open"][-1] = following is None
        own["last"] = last
        columns = [batch.column(c) for c in names]
        for c in added:
            if c.endswith("_next") and c[:-5] in lead:
                after = pa.nulls(1, batch.column(c[:-5]).type) if following is None else following.column(c[:-5]).slice(0, 1)
                shifted = pa.concat_arrays([batch.column(c[:-5]).slice(1), after])
                columns.append(pc.if_else(pa.array(last), pa.scalar(None, shifted.type), shifted))
            else:
                values = own[c]
                mask = own["index"] == 0 if c.startswith("before_") else None
                columns.append(pa.array(values, pa.int32() if c == "__part" else None, mask=mask))
        return pa.RecordBatch.from_arrays(columns, names=all_names)

    def local(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        row, run, tail, state = 0, 0, None, 0
        before = {s: 0 for s in sums}  # sum of the current group's rows so far
        pending = None
        for batch in found:
            n = batch.num_rows
            if not n:
                continue
            new = _changes(batch, group)
            here = [batch.column(c)[0].as_py() for c in group]
            goes_on = tail is not None and here == tail
            new[0] = not goes_on
            if pending is not None:
                yield finished(*pending, batch, goes_on)
            at = np.arange(row, row + n)
            begin = np.maximum.accumulate(np.where(new, at, run))
            own = {"new": new, "__part": np.full(n, part, np.int32), "__row": at, "__run": begin, "index": at - begin}
            for s in sums:
                values = batch.column(s).to_numpy(zero_copy_only=False).astype(np.int64)
                total = np.cumsum(values)
                inside = begin >= row  # the group begins in this batch
                first = np.where(inside, begin - row, 0)
                own[f"{s}_upto"] = np.where(inside, total - total[first] + values[first], total + before[s])
                before[s] = int(own[f"{s}_upto"][-1])
            if chain:
                keys, olds = [], []
                # The first group of a partition begins at 0 and is mended by what is carried in.
                for digest, fresh, k in zip(batch.column(chain).to_pylist(), new.tolist(), at.tolist()):
                    if fresh:
                        state = 1 if k else 0
                    olds.append(state)
                    state = (state * BASE + int.from_bytes(digest, "big")) % PRIME
                    keys.append(state)
                own |= {"key_hi": _signed([k >> 64 for k in keys]), "key_lo": _signed(keys)}
                own |= {"before_hi": _signed([k >> 64 for k in olds]), "before_lo": _signed(olds)}
            pending = batch, own
            row, run, tail = row + n, int(begin[-1]), [batch.column(c)[n - 1].as_py() for c in group]
        if pending is not None:
            yield finished(*pending, None, False)

    path = scratch_path(spark, "scan")
    dealt = df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    dealt.mapInArrow(local, schema).write.parquet(path)
    scanned = spark.read.parquet(path)

    edges = scanned.where("__row = 0 or __open").select(
        *dict.fromkeys([*group, *lead, "__part", "__row", "__run", "__open", "index"]), *[f"{s}_upto" for s in sums],
        *(["key_hi", "key_lo"] if chain else []),
    )
    ends = sorted(edges.toArrow().to_pylist(), key=lambda r: (r["__part"], r["__row"]))
    parts = 1 + max((r["__part"] for r in ends), default=-1)
    carried = {c: np.zeros(parts, np.int64) for c in ["index", *(f"{s}_upto" for s in sums)]}
    states = [1] * parts
    nexts: dict[int, list] = {}
    before = None  # the last row of the partition before
    for r in ends:
        p = r["__part"]
        if r["__row"] == 0 and before is not None and [r[c] for c in group] == [before[c] for c in group]:
            q, whole = before["__part"], before["__run"] == 0
            for c in carried:
                carried[c][p] = before[c] + (carried[c][q] if whole else 0) + (c == "index")
            if chain:
                key = _joined(before["key_hi"], before["key_lo"])
                states[p] = (states[q] * pow(BASE, before["index"] + 1, PRIME) + key) % PRIME if whole else key
            nexts[q] = [r[c] for c in lead]
        if r["__open"]:
            before = r
    shared = spark.sparkContext.broadcast((carried, states if chain else [], nexts))

    def carry(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums_in, states_in, nexts_in = shared.value
        for batch in found:
            columns = dict(zip(batch.schema.names, batch.columns))
            part = columns["__part"].to_numpy()
            head = columns["__run"].to_numpy() == 0
            old = columns["index"].to_numpy()
            for c, by_part in sums_in.items():
                columns[c] = pa.array(columns[c].to_numpy() + np.where(head, by_part[part], 0))
            if chain:
                where = np.flatnonzero(head)
                for kind, steps in (("key", 1), ("before", 0)):
                    high, low = (columns[f"{kind}_{x}"].fill_null(0).to_numpy().copy() for x in ("hi", "lo"))
                    whole = [
                        (states_in[part[i]] * pow(BASE, int(old[i]) + steps, PRIME) + _joined(int(high[i]), int(low[i]))) % PRIME
                        for i in where
                    ]
                    high[where], low[where] = _signed([v >> 64 for v in whole]), _signed(whole)
                    first = columns["index"].to_numpy() == 0 if kind == "before" else None
                    columns[f"{kind}_hi"], columns[f"{kind}_lo"] = pa.array(high, mask=first), pa.array(low, mask=first)
            for i in np.flatnonzero(columns["__open"].to_numpy(zero_copy_only=False)):
                if int(part[i]) in nexts_in:
                    mask = pa.array(np.arange(batch.num_rows) == i)
                    columns["last"] = pc.if_else(mask, False, columns["last"])
                    for c, value in zip(lead, nexts_in[int(part[i])]):
                        name = f"{c}_next"
                        columns[name] = pc.if_else(mask, pa.scalar(value, columns[name].type), columns[name])
            yield pa.RecordBatch.from_arrays([columns[c] for c in kept], names=kept)

    kept = [n for n in all_names if not n.startswith("__")]
    return scanned.mapInArrow(carry, ", ".join(f"`{n}` {k}" for n, k in {**kinds, **added}.items() if n in kept))


def partition_offsets(table: DataFrame, part_col: str, size_col: str) -> tuple[np.ndarray, int]:
    """The sum of ``size_col`` in all parts before each part, and the whole sum; a row for each part goes to the driver."""
    totals = table.groupBy(part_col).agg(F.sum(size_col).alias("size")).toArrow()
    parts = totals.column(0).to_numpy()
    sizes = np.zeros(int(parts.max()) + 1 if len(parts) else 0, np.int64)
    sizes[parts] = totals.column(1).to_numpy()
    ends = np.cumsum(sizes)
    return ends - sizes, int(ends[-1]) if len(ends) else 0
