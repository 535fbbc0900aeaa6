"""Near-duplicate vectors: spherical k-means cells, and blocked cosines within a cell.

The cells make no pair get lost. Cells c and h are parted by the plane halfway between their
centres. If x lives in c and y in h, at most an angle t apart, then y is at most t away from
that plane. So a vector also visits, as a guest, every cell beyond a plane so near whose
number is below its own cell's: each pair meets in exactly one cell, that of the lower number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridledger.llm.links import Forest, components
from gridledger.llm.vectors import matrix, usable
from gridledger.session import Workspace

COSINE = 0.98
#: Vectors a cell should hold, cells there are at most, vectors the centres are fitted on,
#: rounds of the fit, and vectors of a cell that meet in one task at a time.
CELL_ROWS, MAX_CELLS, SAMPLE_ROWS, ROUNDS, BLOCK_ROWS = 2000, 1024, 20_000, 10, 2048


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def fit_centres(sample: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centres of a spherical k-means; empty cells keep their former centre."""
    points = _unit(sample)
    centres = points[np.linspace(0, len(points) - 1, min(cells, len(points))).astype(int)]
    for _ in range(rounds):
        own = np.argmax(points @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 0, sums / np.where(size > 0, size, 1), centres)
    return centres


def _assign(centres: dict[int, np.ndarray], cosine: float):
    """Adds the cell and whether the vector is a guest there; a length that wasn't sampled is one cell."""
    reach = np.sqrt(1 - cosine * cosine) if cosine >= 0 else 1.0
    apart = {w: np.sqrt(np.maximum(0, 2 - 2 * at @ at.T)) for w, at in centres.items()}

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column("width").to_numpy()
            for width in np.unique(widths):
                part = batch.filter(pa.array(widths == width))
                at = centres.get(int(width))
                if at is None:
                    row, cell, guest = np.arange(len(part)), np.zeros(len(part), np.int32), np.zeros(len(part), bool)
                else:
                    close = _unit(matrix(part.column("vector"), width)) @ at.T
                    home = np.argmax(close, axis=1)
                    behind = close[np.arange(len(home)), home][:, None] - close
                    near = behind <= reach * apart[int(width)][home] + 1e-9
                    near &= np.arange(len(at))[None, :] <= home[:, None]
                    row, cell = np.nonzero(near)
                    guest = cell != home[row]
                out = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [*out.columns, pa.array(cell.astype(np.int32)), pa.array(guest)], [*out.schema.names, "cell", "guest"]
                )

    return each


def _compare(cosine: float):
    """Within one pair of a cell's blocks: each vector's number of links, and a tree of links."""

    def each(key: tuple, rows: pa.Table) -> pa.Table:
        width, i, j = key[1].as_py(), key[3].as_py(), key[4].as_py()
        block, guest = rows["block"].to_numpy(), rows["guest"].to_numpy()
        rep, copies = rows["rep"].to_numpy(), rows["copies"].to_numpy()
        vectors = matrix(rows["vector"], width).astype(np.float64)
        size = np.linalg.norm(vectors, axis=1)
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        forest, links = Forest(len(rep)), np.zeros(len(rep), np.int64)
        for at in range(0, len(left), 256):
            a = left[at : at + 256]
            near = (vectors[a] @ vectors[right].T) / (size[a][:, None] * size[right][None, :]) >= cosine
            near &= ~(guest[a][:, None] & guest[right][None, :])
            if i == j:
                near &= a[:, None] < right[None, :]
            x, y = np.nonzero(near)
            np.add.at(links, a[x], copies[right[y]])
            np.add.at(links, right[y], copies[a[x]])
            forest.join(a[x], right[y])
        linked = np.flatnonzero(links)
        member, lead = forest.tree()
        return pa.table(
            [np.concatenate(z) for z in ((rep[linked], rep[member]), (rep[linked], rep[lead]), (links[linked], np.zeros(len(member), np.int64)))],
            ["a", "b", "links"],
        )

    return each


def near_duplicate_vectors(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", group_col: str = "label",
    cosine: float = COSINE, cell_rows: int = CELL_ROWS, block_rows: int = BLOCK_ROWS, space: Workspace | None = None,
) -> DataFrame:
    """``id_col``, ``n_links``, ``component_id`` and ``kept`` for every row.

    Vectors link when their ``group_col`` values are equal and their cosine, in double
    precision, is at least ``cosine``. Copies count as links too. ``component_id`` is the
    smallest id reachable and ``kept`` marks the row that bears it.

    Vectors that are null, zero, empty, or hold null, NaN or infinite components, and rows
    with a null group, link with nothing: no links, their own id, kept. Vectors of different
    length don't link. A row with a null id links like any other, but a null id is never a
    component's id unless all ids in it are null: such a row is kept only then. Rows that
    repeat an id are vectors of their own. Other columns aren't read. No rows give no rows.

    Equal vectors of a group are counted first and compared once. The centres are fitted on
    ``SAMPLE_ROWS`` vectors at most (the bound of what the driver sees) and all vectors are
    assigned. A large cell is compared in pairs of blocks of ``block_rows``.
    """
    space = space or Workspace(vectors.sparkSession)
    vector = F.col(vector_col)
    rows = space.stage(
        vectors.select(F.col(id_col).alias("id"), F.col(group_col).alias("grp"), vector.alias("vector"), (
            usable(vector) & F.exists(vector, lambda x: x != 0) & F.col(group_col).isNotNull()
        ).alias("takes")).withColumn("hash", F.xxhash64("vector")),
        "vectors",
    )
    classes = space.stage(
        rows.where("takes").groupBy("hash", "grp", "vector")
        .agg(F.min("id").cast("long").alias("least"), F.count("*").alias("copies"))
        .withColumns({"width": F.size("vector"), "rep": F.monotonically_increasing_id()}),
        "classes",
    )
    n = classes.count()
    cells = int(min(MAX_CELLS, max(1, -(-n // cell_rows))))
    sampled = classes.orderBy("hash", "grp").limit(SAMPLE_ROWS).select("width", "vector").collect()
    centres = {
        w: fit_centres(np.array([r.vector for r in sampled if r.width == w], np.float64), cells)
        for w in {r.width for r in sampled}
    }
    schema = f"rep long, copies long, grp {classes.schema['grp'].dataType.simpleString()}, width int, " + (
        f"vector {classes.schema['vector'].dataType.simpleString()}, cell int, guest boolean"
    )
    placed = space.stage(
        classes.select("rep", "copies", "grp", "width", "vector").mapInArrow(_assign(centres, cosine), schema), "cells"
    )
    key = ["grp", "width", "cell"]
    sizes = space.stage(placed.groupBy(*key).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks")), "sizes")
    dealt = placed.join(sizes, key).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    paired = dealt.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).withColumns(
        {"i": F.least("block", "other"), "j": F.greatest("block", "other")}
    )
    found = space.stage(
        paired.select(*key, "i", "j", "block", "guest", "rep", "copies", "vector").groupBy(*key, "i", "j")
        .applyInArrow(_compare(cosine), "a long, b long, links long"),
        "found",
    )
    counts = space.stage(found.groupBy("a").agg(F.sum("links").alias("links")), "counts")
    roots = components(found.select("a", "b"), space, "links")
    # Classes are numbered; a component is named by the smallest id of its classes.
    members = classes.select("rep", "least").join(roots, F.col("rep") == F.col("node"), "left").join(
        counts, F.col("rep") == F.col("a"), "left")
    members = space.stage(members.select("rep", "least", "links", F.coalesce("root", "rep").alias("root")), "members")
    names = members.groupBy("root").agg(F.min("least").alias("name"))
    named = classes.drop("least").join(members.join(names, "root").drop("root", "least"), "rep")
    named = space.stage(
        named.select("hash", "grp", "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
                     F.col("name").alias("root")),
        "named",
    )
    return rows.join(named, ["hash", "grp", "vector"], "left").select(
        F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("root", F.col("id")).cast("long").alias("component_id"),
    ).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
