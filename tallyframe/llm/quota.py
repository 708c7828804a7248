"""A sample with given shares of categories in several dimensions at once.

Categories are counted; in each dimension integer quotas are allocated by largest remainder, with minimum floors and
capped by what is available. The joint cells of all dimensions are fitted to the quotas (iterative proportional fitting
from the counts, capped), rounded by largest remainder and brought nearer by moves between any two cells; each cell then
takes the rows with the smallest random keys. What couldn't be met is reported, and which targets stand in its way.

Defined cases
* A null category of the targets means a null value; rows of categories without a target aren't sampled.
* Targets of a dimension whose shares don't sum to one are taken in proportion; a null share or minimum is 0.
* Rows are sampled as they are (repeated entries too), ties of random keys go to the lower row_no.
* An empty table, or targets for no available category, give an empty sample and a report of full shortfalls.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def largest_remainder(size: int, shares: list[float], floors: list[int], available: list[int]) -> list[int]:
    """Integer quotas that sum to size where possible: in proportion to shares, at least the floor and at most what is
    available (availability goes before the floor). What capped categories leave goes to the others in proportion."""
    n = len(shares)
    floors = [min(f, a) for f, a in zip(floors, available)]
    size = min(size, sum(available))
    fixed: dict[int, int] = {}
    while True:
        free = [i for i in range(n) if i not in fixed]
        left, weight = size - sum(fixed.values()), sum(shares[i] for i in free)
        ideal = {i: (left * shares[i] / weight if weight > 0 else 0.0) for i in free}
        low = [i for i in free if ideal[i] < floors[i]]
        high = [i for i in free if ideal[i] > available[i]]
        if sum(floors[i] - ideal[i] for i in low) >= sum(ideal[i] - available[i] for i in high) and low:
            fixed |= {i: floors[i] for i in low}
        elif high:
            fixed |= {i: available[i] for i in high}
        else:
            break
    quota = {**fixed, **{i: int(ideal[i]) for i in free}}
    rest = max(0, size - sum(quota.values()))
    for i in sorted(free, key=lambda i: (int(ideal[i]) - ideal[i], i)):
        if rest and quota[i] < available[i]:
            quota[i] += 1
            rest -= 1
    for i in sorted(range(n), key=lambda i: (-shares[i], i)):  # shares of what is left are all zero
        more = min(rest, available[i] - quota[i]) if shares[i] > 0 else 0
        quota[i] += more
        rest -= more
    return [quota[i] for i in range(n)]


def fit_cells(counts: np.ndarray, margins: list[np.ndarray], rounds: int = 500) -> np.ndarray:
    """Integer cells, at most counts, whose sums along each axis come as near to the margins as moves can bring them."""
    x = counts.astype(float)
    cap = counts.astype(float)
    axes = range(counts.ndim)
    others = [tuple(b for b in axes if b != a) for a in axes]
    for _ in range(rounds):
        for a in axes:
            have = x.sum(axis=others[a])
            scale = np.divide(margins[a], have, out=np.zeros_like(have), where=have > 0)
            x = np.minimum(x * scale.reshape([-1 if b == a else 1 for b in axes]), cap)
    whole = np.floor(x + 1e-9).astype(int)
    flat, total = (x - whole).ravel(), int(min(m.sum() for m in margins))
    for i in np.argsort(-flat, kind="stable")[: max(0, total - whole.sum())]:
        if flat[i] > 1e-9:
            whole.ravel()[i] += 1
    whole = np.minimum(whole, counts)

    return _nearest(whole, counts, margins)


def _nearest(whole: np.ndarray, counts: np.ndarray, margins: list[np.ndarray]) -> np.ndarray:
    """Moves rows while the summed deviation from all margins falls: one more, one less, or one from a cell to another.

    Each step looks at every such move (all pairs of the cells, of which there are few) and takes the best one."""
    axes = range(counts.ndim)
    others = [tuple(b for b in axes if b != a) for a in axes]
    at = np.indices(counts.shape).reshape(counts.ndim, -1)
    cells, most = whole.ravel().copy(), counts.ravel()
    while cells.size:
        have = [margins[a] - cells.reshape(counts.shape).sum(axis=others[a]) for a in axes]
        plus = [(np.abs(g - 1) - np.abs(g))[at[a]] for a, g in enumerate(have)]
        minus = [(np.abs(g + 1) - np.abs(g))[at[a]] for a, g in enumerate(have)]
        can_add, can_take = np.flatnonzero(cells < most), np.flatnonzero(cells > 0)
        moves: list[tuple[float, int, int]] = [(0.0, -1, -1)]
        if can_add.size:
            one = sum(p[can_add] for p in plus)
            moves.append((float(one.min()), int(can_add[one.argmin()]), -1))
        if can_take.size:
            one = sum(m[can_take] for m in minus)
            moves.append((float(one.min()), -1, int(can_take[one.argmin()])))
        if can_add.size and can_take.size:
            # Within one category of an axis a move leaves that axis as it is.
            both = sum((plus[a][can_add][:, None] + minus[a][can_take][None, :]) * (at[a][can_add][:, None] != at[a][can_take][None, :]) for a in axes)
            i, j = np.unravel_index(both.argmin(), both.shape)
            moves.append((float(both[i, j]), int(can_add[i]), int(can_take[j])))
        gain, add, take = min(moves, key=lambda m: m[0])
        if gain >= 0:
            break
        if add >= 0:
            cells[add] += 1
        if take >= 0:
            cells[take] -= 1
    return cells.reshape(counts.shape)


def _labels(targets: DataFrame) -> dict[str, list[tuple[str | None, float, int]]]:
    """{dimension: [(category, share, minimum)]}. The targets are as many rows as there are categories to sample."""
    out: dict = {}
    for d, c, s, m in targets.select("dimension", "category", "target_share", "min_rows").distinct().collect():
        out.setdefault(d, []).append((c, max(0.0, float(s or 0)), max(0, int(m or 0))))
    return {d: sorted(v, key=lambda x: (x[0] is None, str(x[0]))) for d, v in sorted(out.items())}


def plan(rows: DataFrame, dimensions: Mapping[str, Column], targets: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """(cells: a column of each dimension and quota; report: a row for the size, under the dimension `sample`, and one for
    each target; limited_by names what keeps a row below its target)."""
    spark = rows.sparkSession
    labels = {d: v for d, v in _labels(targets).items() if d in dimensions}
    names = list(labels)
    place = {d: {c: i for i, (c, _, _) in enumerate(v)} for d, v in labels.items()}
    shape = [len(labels[d]) for d in names]
    counts = np.zeros(shape, dtype=np.int64) if names else np.zeros(0, np.int64)
    marginal = {d: np.zeros(len(labels[d]), np.int64) for d in names}
    # At most as many rows as there are combinations of targeted categories.
    wanted = rows.select(*(dimensions[d].alias(d) for d in names))
    for d in names:
        known = [c for c in place[d] if c is not None]
        wanted = wanted.withColumn(f"{d}_in", F.coalesce(F.col(d).isin(known) if known else F.lit(False), F.lit(False)) | (F.col(d).isNull() & F.lit(None in place[d])))
    cells = wanted.groupBy(*(F.when(F.col(f"{d}_in"), F.col(d)).alias(d) for d in names), *(f"{d}_in" for d in names)).count()
    for r in cells.collect() if names else []:
        at = tuple(place[d][r[d]] if r[f"{d}_in"] else None for d in names)
        for d, i in zip(names, at):
            if i is not None:
                marginal[d][i] += r["count"]
        if None not in at:
            counts[at] += r["count"]
    others = {a: tuple(b for b in range(len(names)) if b != a) for a in range(len(names))}
    quotas = []
    for a, d in enumerate(names):
        available = counts.sum(axis=others[a])
        quotas.append(np.array(largest_remainder(size, [s for _, s, _ in labels[d]], [m for _, _, m in labels[d]], available.tolist())))
    taken = fit_cells(counts, quotas) if names and counts.size else counts
    chosen = [(*(labels[d][i][0] for d, i in zip(names, at)), int(taken[at])) for at in zip(*np.nonzero(taken))] if names else []
    cell_schema = ", ".join([*(f"`{d}` string" for d in names), "quota int"])
    total = int(taken.sum())
    # Rows that could still be taken, and the categories that have as many as they should.
    spare = counts - taken
    full = [taken.sum(axis=others[a]) >= quotas[a] for a in range(len(names))]

    def limits(a: int, i: int) -> str:
        """What keeps a category below its target: its own rows, or full categories of the other dimensions."""
        left = np.argwhere(np.take(spare, i, axis=a) > 0)
        if not len(left):
            return "available rows"
        rest = [b for b in range(len(names)) if b != a]
        barred = {(names[b], str(labels[names[b]][cell[k]][0])) for cell in left for k, b in enumerate(rest) if full[b][cell[k]]}
        return ", ".join(f"{d}={c}" for d, c in sorted(barred)) or "sample size"

    report = [("sample", None, 1.0, None, int(counts.sum()), float(size), total, 1.0 if total else 0.0, max(0, size - total), False, ("available rows" if counts.sum() < size else "targets that exclude each other") if total < size else None)]
    for a, d in enumerate(names):
        got = taken.sum(axis=others[a])
        for i, (c, s, m) in enumerate(labels[d]):
            ideal = s * size / (sum(x for _, x, _ in labels[d]) or 1)
            short = max(0, int(np.ceil(max(ideal, m) - 1 + 1e-9)) - int(got[i]))
            report.append((d, c, s, m, int(marginal[d][i]), round(ideal, 6), int(got[i]), float(got[i] / total) if total else 0.0, short, int(got[i]) < m, limits(a, i) if short else None))
    report_schema = "dimension string, category string, target_share double, min_rows int, available long, target_rows double, sampled int, sampled_share double, shortfall int, below_minimum boolean, limited_by string"
    return spark.createDataFrame(chosen, cell_schema), spark.createDataFrame(report, report_schema)


def draw(rows: DataFrame, dimensions: Mapping[str, Column], targets: DataFrame, size: int, key: str = "row_no", seed: str = "0") -> DataFrame:
    """The sampled rows: key and the dimensions.

    The rank filter by the largest quota is applied within the input partitions already, so a cell that holds a third of
    all rows sends few of them through the shuffle."""
    cells, _ = plan(rows, dimensions, targets, size)
    names = [c for c in cells.columns if c != "quota"]
    if not names:
        return rows.select(key).limit(0)
    cells = cells.select(*(F.col(c).alias(f"cell_{c}") for c in names), "quota")
    most = cells.agg(F.max("quota")).first()[0] or 0
    keyed = rows.select(F.col(key), *(dimensions[d].cast("string").alias(d) for d in names)).withColumn("u", F.sha2(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")), 256))
    same = [F.col(d).eqNullSafe(F.col(f"cell_{d}")) for d in names]
    fitting = keyed.join(F.broadcast(cells), same)  # as many rows as there are cells
    order = Window.partitionBy(*names).orderBy("u", key)
    ranked = fitting.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most).where("rank <= quota")
    return ranked.select(key, *names)
