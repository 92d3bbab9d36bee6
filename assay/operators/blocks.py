"""Vectors in blocks: what is most similar to many queries at once, by products of matrices in tasks.

`packed` puts runs of rows into one row each, with the vectors as one matrix; a pair of such rows, one of vectors and one of
queries, is a unit of work of bounded size, whatever the tables' sizes. `nearest` finds with the product of the two matrices which
pairs can be among the best of the block, and scores only these, term by term as the column expression `retrieval.cosine` does: the
product's own sums differ from that in their last digits, so it decides nothing by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows and bytes of a block, queries that meet a block at once, and pairs that are scored at once.
BLOCK, BYTES, SLICE, PAIRS = 8192, 2 << 20, 256, 1 << 15
#: No sum of products of smaller numbers overflows.
LARGE = 1e150


def plain(embedding: Column | str, size: int) -> Column:
    """Whether a vector has that many elements, all of them numbers of moderate size."""
    x = F.col(embedding) if isinstance(embedding, str) else embedding
    return F.coalesce(F.lit(size > 0) & (F.size(x) == size) & F.forall(x, lambda e: F.coalesce(F.abs(e) < LARGE, F.lit(False))), F.lit(False))


def packed(rows: DataFrame, ids: str, by: str | None = None, copies: int | None = None) -> DataFrame:
    """(by, every other column as an array, embedding as the bytes of a matrix) of plain vectors.

    With `by`, a block has rows of one value of it, which come together. With `copies`, equal vectors of a block stay only with
    that many least ids.
    """
    kinds = dict(rows.dtypes)
    others = [c for c in rows.columns if c not in (by, "embedding")]
    schema = ", ".join([*([f"`{by}` {kinds[by]}"] if by else []), *[f"`{c}` array<{kinds[c]}>" for c in others], "embedding binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            if by:
                of = batch.column(by).to_numpy(zero_copy_only=False)
                edges = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), n]
            else:
                edges = [0, n]
            each = batch.column("embedding").flatten().nbytes // n
            step = max(1, min(BLOCK, BYTES // max(1, each)))
            for begin, end in zip(edges[:-1], edges[1:], strict=True):
                for at in range(begin, end, step):
                    part = batch.slice(at, min(step, end - at))
                    matrix = part.column("embedding").flatten().to_numpy().reshape(part.num_rows, -1)
                    if copies is not None and matrix.shape[1]:
                        order = pc.sort_indices(part.column(ids), null_placement="at_start").to_numpy()
                        _, which = np.unique(np.ascontiguousarray(matrix[order]).view(f"V{matrix.shape[1] * matrix.itemsize}").ravel(), return_inverse=True)
                        together = np.argsort(which, kind="stable")
                        first = np.searchsorted(which[together], which[together])
                        kept = order[together[np.arange(len(order)) - first < copies]]
                        part, matrix = part.take(pa.array(kept)), matrix[kept]
                    made = [pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(c)) for c in others]
                    yield pa.RecordBatch.from_arrays([*([part.column(by).slice(0, 1)] if by else []), *made, pa.array([matrix.tobytes()], pa.binary())], names=[*([by] if by else []), *others, "embedding"])

    return rows.mapInArrow(run, schema)


def summed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dot products of the rows of a with those of b, summed from the first element to the last."""
    out = np.zeros(len(a))
    for x, y in zip(a.T, b.T, strict=True):
        out += x * y
    return out


def open_to(q: np.ndarray, least: np.ndarray, centre: pa.Scalar, radius: pa.Scalar, slack: float) -> np.ndarray:
    """Which queries can find a score of at least `least` within a radius: angles between unit vectors keep the triangle inequality."""
    angle = np.arccos(np.clip(q @ np.array(centre.as_py()), -1, 1))
    return np.flatnonzero(np.cos(np.maximum(0.0, angle - radius.as_py() - slack)) >= least)


def reached(pairs: DataFrame, by: str, double: bool, slack: float) -> DataFrame:
    """The values of `by`, each with a centre and a radius, that are open to a query of a block (packed _q and floor)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for n in range(batch.num_rows):
                row = {c: batch.column(c)[n] for c in batch.schema.names}
                q = np.frombuffer(row["_q"].as_buffer(), np.float64 if double else np.float32).reshape(len(row["floor"].values), -1).astype(np.float64)
                found.append(len(open_to(q, row["floor"].values.fill_null(-np.inf).to_numpy(), row["centre"], row["radius"], slack)) > 0)
            yield pa.RecordBatch.from_arrays([batch.column(by).filter(pa.array(found, pa.bool_()))], names=[by])

    return pairs.mapInArrow(run, f"`{by}` {dict(pairs.dtypes)[by]}").distinct()


def nearest(pairs: DataFrame, key: str, query: str, top: int, double: tuple[bool, bool], slack: float = 0.0) -> DataFrame:
    """(query, key, score): of each pair of blocks the `top` best of each query, and what equals the last of them.

    pairs has the packed columns `key` and embedding, `query` and _q. With a packed column `floor`, what scores less is left out,
    null being no floor. With `centre` and `radius`, within which the block's vectors lie by their angles, so are queries that
    are too far from it to find anything above their floor. double says of both embeddings whether their elements are doubles.
    """
    kinds = dict(pairs.dtypes)
    inner = lambda c: kinds[c].removeprefix("array<")[:-1]
    floors, ball = "floor" in kinds, "centre" in kinds
    types = [np.float64 if d else np.float32 for d in double]

    def found(row: dict[str, pa.Scalar]) -> Iterator[pa.RecordBatch]:
        ids, asked = row[key].values, row[query].values
        v, q = (np.frombuffer(row[c].as_buffer(), t).reshape(n, -1).astype(np.float64) for c, t, n in (("embedding", types[0], len(ids)), ("_q", types[1], len(asked))))
        least = row["floor"].values.fill_null(-np.inf).to_numpy() if floors else np.full(len(asked), -np.inf)
        which = open_to(q, least, row["centre"], row["radius"], slack) if ball else np.arange(len(asked))
        # both sums are this far from the true one at most, with room to spare
        error = 4 * v.shape[1] * np.finfo(float).eps * np.sqrt((v * v).sum(1).max(initial=0.0)) * np.sqrt((q * q).sum(1))
        for at in range(0, len(which), SLICE):
            some = which[at : at + SLICE]
            near = q[some] @ v.T
            limit = least[some]
            if len(ids) > top:
                limit = np.maximum(limit, np.partition(near, len(ids) - top, axis=1)[:, len(ids) - top])
            i, j = np.nonzero(near >= (limit - 2 * error[some])[:, None])
            for a in range(0, len(i), PAIRS):
                qi, vj = some[i[a : a + PAIRS]], j[a : a + PAIRS]
                yield pa.RecordBatch.from_arrays([asked.take(pa.array(qi)), ids.take(pa.array(vj)), pa.array(summed(v[vj], q[qi]))], names=[query, key, "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                yield from found({c: batch.column(c)[n] for c in batch.schema.names})

    return pairs.mapInArrow(run, f"`{query}` {inner(query)}, `{key}` {inner(key)}, score double")
