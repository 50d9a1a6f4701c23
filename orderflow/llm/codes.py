"""Vector code compression (operator 13).

Vectors are cut into equal parts, and each part position learns a codebook by rounds of
assignment and averaging, in whole numbers throughout. A part is assigned anew without looking
at every entry: it keeps an upper bound of the distance to its entry and a lower bound for each
group of the other entries, each with the round it was computed in. The codebooks of all rounds
are retained, so a bound is carried on by how far an entry lies now from where it lay in that
round: the norm of the sum of its moves, never more than the sum of their norms. Only groups
that the bounds cannot rule out are scanned again, exactly.

The bounds travel with the vectors from round to round in Spark's cache, one narrow step a
round: a lost executor's share is computed again from the table. The driver gets the sums of a
round, whose number is that of the codebooks' components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.llm.common import import_here

SCALE = 4096
# What rounding may take from a bound, as a share of it; far more than float32 loses.
SLACK = 1e-6
_LIMB = (1 << 32) - 1


@dataclass(frozen=True)
class Shape:
    """How vectors are cut, and how large their whole numbers are."""

    parts: int
    width: int
    groups: int
    largest: int

    @property
    def exact(self) -> type:
        """int64 where squared distances fit, otherwise Python's integers."""
        small = (2 * self.largest + 2) ** 2 * max(1, self.width) < 1 << 62
        return np.int64 if small and self.largest < 1 << 31 else object

    @property
    def limbs(self) -> int:
        """32-bit digits of a sum over a partition."""
        return 2 if self.exact is np.int64 else (self.largest.bit_length() + 48) // 32 + 1

    def whole(self, column: pa.Array) -> np.ndarray:
        """floor(SCALE * x) of vectors, as (row, part, position)."""
        values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        if self.exact is np.int64:
            scaled = np.floor(values * SCALE).astype(np.int64)
        else:
            scaled = np.array([_whole(x) for x in values.tolist()] + [None], object)[:-1]
        return scaled.reshape(len(column), self.parts, self.width)


def _whole(x: float) -> int:
    up, down = x.as_integer_ratio()
    return SCALE * up // down


def distances(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared, of each row to each entry."""
    gap = rows[:, None, :] - entries[None, :, :]
    return (gap * gap).sum(axis=2)


class Round:
    """One assignment: what the codebooks of this round and the ones before say of a batch.

    A state is one byte string a row: for each part its entry (u1), the upper bound's stamp (u1)
    and value (f4), and for each group the lower bound's stamp and value.
    """

    def __init__(self, shape: Shape, history: list[np.ndarray]):
        self.shape, self.history = shape, history
        self.books, self.now = history[-1], len(history) - 1
        k = self.books.shape[1]
        self.groups = [g for g in np.array_split(np.arange(k), min(shape.groups, max(1, k))) if len(g)]
        self.record = np.dtype(
            [("a", "u1"), ("us", "u1"), ("u", "f4"), ("ls", "u1", len(self.groups)), ("l", "f4", len(self.groups))]
        )
        if shape.exact is np.int64:
            # moved[t, p, j]: how far entry j lies now from where it lay in round t.
            gaps = np.stack([self.books - then for then in history]).astype(np.float64)
            self.moved = np.sqrt((gaps * gaps).sum(axis=3)) * (1 + SLACK)
            far = [self.moved[:, :, g].max(axis=2, keepdims=True) for g in self.groups]
            self.farthest = np.concatenate([self.moved[:, :, :0], *far], axis=2)

    def first(self, n: int) -> np.ndarray:
        """A state that rules nothing out."""
        state = np.zeros((n, self.shape.parts), self.record)
        state["u"], state["us"], state["ls"] = np.inf, self.now, self.now
        return state

    def assign(self, rows: np.ndarray, state: np.ndarray) -> None:
        """Bring the state up to this round; ties go to the lower index."""
        for p in range(self.shape.parts):
            self._assign(rows[:, p], state[:, p], p)

    def _assign(self, rows: np.ndarray, state: np.ndarray, p: int) -> None:
        books, bounded = self.books[p], self.shape.exact is np.int64
        if bounded:
            upper = state["u"] + self.moved[state["us"], p, state["a"]]
            lower = state["l"] - np.stack(
                [self.farthest[state["ls"][:, g], p, g] for g in range(len(self.groups))], axis=1
            )
            open_rows = np.flatnonzero((lower <= upper[:, None] * (1 + SLACK)).any(axis=1))
        else:
            lower, open_rows = np.zeros((len(rows), len(self.groups))), np.arange(len(rows))
        if not len(open_rows):
            return
        part, had = rows[open_rows], state["a"][open_rows].astype(np.int64)
        gap = part - books[had]
        own = (gap * gap).sum(axis=1)
        lower = lower[open_rows]
        reach = _root(own, 1 + SLACK) if bounded else np.full(len(own), np.inf)
        best, entry = own.copy(), had.copy()
        scanned = {}
        for g, members in enumerate(self.groups):
            at = np.flatnonzero(lower[:, g] <= reach)
            if len(at):
                found = distances(part[at], books[members])
                scanned[g] = at, found
                place = found.argmin(axis=1)
                least, index = found[np.arange(len(at)), place], members[place]
                better = (least < best[at]) | ((least == best[at]) & (index < entry[at]))
                best[at[better]], entry[at[better]] = least[better], index[better]
        new = state[open_rows]
        if bounded:
            changed = entry != had
            for g, members in enumerate(self.groups):
                # An entry that is left is one of its group's others from now on.
                left = np.flatnonzero(changed & (had >= members[0]) & (had <= members[-1]))
                kept = np.minimum(lower[left, g], _root(own[left], 1 - SLACK))
                new["l"][left, g], new["ls"][left, g] = _below(kept), self.now
                if g in scanned:
                    at, found = scanned[g]
                    roots = _root(found, 1 - SLACK)
                    roots[members[None, :] == entry[at][:, None]] = np.inf
                    new["l"][at, g], new["ls"][at, g] = _below(roots.min(axis=1)), self.now
            new["u"], new["us"] = np.nextafter(_root(best, 1 + SLACK).astype(np.float32), np.float32(np.inf)), self.now
        new["a"] = entry
        state[open_rows] = new

    def errors(self, rows: np.ndarray, state: np.ndarray) -> list[int | None]:
        """Squared distances to the assigned entries, summed over parts; None beyond 64 bits."""
        total = np.zeros(len(rows), object)
        for p in range(self.shape.parts):
            gap = rows[:, p] - self.books[p][state["a"][:, p]]
            total = total + (gap * gap).sum(axis=1)
        return [int(e) if e < 1 << 63 else None for e in total]

    def add_to(self, sums: np.ndarray, counts: np.ndarray, rows: np.ndarray, state: np.ndarray) -> None:
        for p in range(self.shape.parts):
            np.add.at(sums[p], state["a"][:, p], rows[:, p])
            counts[p] += np.bincount(state["a"][:, p], minlength=counts.shape[1])


def _root(squares: np.ndarray, factor: float) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64)) * factor


def _below(values: np.ndarray) -> np.ndarray:
    return np.nextafter(values.astype(np.float32), np.float32(-np.inf))


@dataclass(frozen=True)
class Coded:
    """codebooks[part, entry, position] in units of 1 / SCALE, and a row for each vector."""

    codebooks: np.ndarray
    rows: DataFrame


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    carry_col: str | None = None,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    groups: int = 4,
) -> Coded:
    """Codebooks, and id, carried (of carry_col), code (an entry's index for each part, one byte
    each) and error for each kept row of vectors.

    Rows whose vector is null or holds null or non-finite components are dropped. Codebooks start
    as the vectors of the smallest ids; of repeated ids the smallest vector counts once, rows
    with a null id are coded but start nothing, and with fewer ids than entries there are as
    many entries as ids (without any id, without a row). Entries that no part is nearest to
    stay. Equal vectors have equal codes. An error of more than 64 bits is null. Vectors of
    different lengths, or of one that the parts do not divide, are a ValueError; an empty table
    has no codes and empty codebooks; other columns are left out.
    """
    import_here(vectors.sparkSession)
    kind = vectors.schema[vector_col].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    carried = vectors[carry_col] if carry_col else F.lit(None).cast("int")
    kept = vectors.select(
        vectors[id_col].cast("long").alias("id"),
        carried.alias("carried"),
        vectors[vector_col].cast("array<float>" if single else "array<double>").alias("vector"),
    )
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    kept = kept.where(F.col("vector").isNotNull() & ~F.exists("vector", odd))
    length = F.size("vector")
    facts = kept.agg(
        F.min(length).alias("shortest"),
        F.max(length).alias("longest"),
        F.max(F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double"))))).alias("largest"),
    ).first()
    if facts["shortest"] != facts["longest"]:
        raise ValueError(f"vectors have from {facts['shortest']} to {facts['longest']} components")
    size = facts["longest"] or 0
    if size % parts:
        raise ValueError(f"{parts} parts do not divide {size} components")
    shape = Shape(parts, size // parts, groups, _whole(facts["largest"] or 0.0) + 1)
    history = [_first_books(kept, shape, entries)]
    if not history[0].shape[1]:
        kept = kept.where("false")
        rounds = 0
    state = kept.withColumn("state", F.lit(None).cast("binary")).withColumn("sums", F.lit(None).cast("array<long>"))
    held = None
    for _ in range(rounds):
        step = _step(state, shape, history, final=False).persist()
        history.append(_averaged(step, shape, history[-1]))
        if held is not None:
            held.unpersist()
        held = step
        state = step.where("sums IS NULL")
    return Coded(history[-1], _step(state, shape, history, final=True))


def _first_books(kept: DataFrame, shape: Shape, entries: int) -> np.ndarray:
    ids: list[int] = []
    while len(ids) < entries:
        rest = kept.select("id").where(F.col("id") > ids[-1]) if ids else kept.select("id").where("id IS NOT NULL")
        found = [r["id"] for r in rest.orderBy("id").limit(entries).collect()]
        if not found:
            break
        ids = sorted(set(ids) | set(found))[:entries]
    rows = kept.where(F.col("id").isin(ids)).groupBy("id").agg(F.min("vector").alias("vector"))
    vectors = [r["vector"] for r in sorted(rows.collect(), key=lambda r: r["id"])]
    column = pa.array(vectors, pa.list_(pa.float64()))
    return shape.whole(column).transpose(1, 0, 2)


def _step(state: DataFrame, shape: Shape, history: list[np.ndarray], final: bool) -> DataFrame:
    """id, carried, vector, state, sums: rows with their new state, and a row for each partition
    with the sums and counts of the parts by entry; if final, id, carried, code and error."""
    books = state.sparkSession.sparkContext.broadcast(list(history))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = Round(shape, books.value)
        k = now.books.shape[1]
        sums = np.zeros((shape.parts, k, shape.width), shape.exact)
        counts = np.zeros((shape.parts, k), np.int64)
        for batch in batches:
            if not len(batch):
                continue
            rows = shape.whole(batch["vector"])
            known = batch["state"]
            if known.null_count:
                bounds = now.first(len(batch))
            else:
                bounds = np.frombuffer(b"".join(known.to_pylist()), now.record).copy()
                bounds = bounds.reshape(len(batch), shape.parts)
            now.assign(rows, bounds)
            if final:
                code = [c.tobytes() for c in np.ascontiguousarray(bounds["a"])]
                columns = [pa.array(code, pa.binary()), pa.array(now.errors(rows, bounds), pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [batch["id"], batch["carried"], *columns], ["id", "carried", "code", "error"]
                )
                continue
            now.add_to(sums, counts, rows, bounds)
            blobs = [row.tobytes() for row in bounds]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["carried"], batch["vector"], pa.array(blobs, pa.binary()), batch["sums"]], fields
            )
        if not final:
            digits = [(sums >> 32 * i) & _LIMB for i in range(shape.limbs - 1)] + [sums >> 32 * (shape.limbs - 1)]
            flat = np.concatenate([np.array(d, np.int64).ravel() for d in digits] + [counts.ravel()])
            nothing = [pa.nulls(1, kind) for kind in arrow[:-1]]
            yield pa.RecordBatch.from_arrays([*nothing, pa.array([flat], pa.list_(pa.int64()))], fields)

    from pyspark.sql.pandas.types import to_arrow_type

    schema = T.StructType([state.schema[name] for name in ("id", "carried", "vector", "state", "sums")])
    fields = schema.names
    arrow = [to_arrow_type(field.dataType) for field in schema]
    if final:
        schema = T.StructType([schema["id"], schema["carried"]]).add("code", "binary").add("error", "long")
    return state.select(*fields).mapInArrow(run, schema)


def _averaged(step: DataFrame, shape: Shape, books: np.ndarray) -> np.ndarray:
    """The entries' new places: floor(sum / count) of their parts, or where they were."""
    total = F.sum(F.col("col").cast("decimal(38,0)")).alias("total")
    found = step.where("sums IS NOT NULL").select(F.posexplode("sums")).groupBy("pos").agg(total).collect()
    n = books.size
    flat = np.zeros(shape.limbs * n + books.shape[0] * books.shape[1], object)
    for row in found:
        flat[row["pos"]] = int(row["total"])
    sums = sum(flat[i * n : (i + 1) * n] << 32 * i for i in range(shape.limbs)).reshape(books.shape)
    counts = flat[shape.limbs * n :].reshape(books.shape[:2])
    fresh = books.copy()
    for p, j in np.argwhere(counts > 0):
        fresh[p, j] = sums[p, j] // counts[p, j]
    return fresh


def approximate(codes: DataFrame, codebooks: np.ndarray, code_col: str = "code") -> DataFrame:
    """codes with a column vector: what each code stands for, the entries its bytes name."""
    entries = F.array(*[
        F.array(*[F.array(*[F.lit(float(x) / SCALE) for x in entry]) for entry in book]) for book in codebooks
    ])
    byte = lambda p: F.conv(F.hex(F.substring(F.col(code_col), p + 1, 1)), 16, 10).cast("int")
    parts = [F.get(F.get(entries, F.lit(p)), byte(p)) for p in range(len(codebooks))]
    return codes.withColumn("vector", F.flatten(F.array(*parts)))
