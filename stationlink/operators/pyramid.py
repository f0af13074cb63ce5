"""Pyramid of occupied cells over points, and the nearest point (L1) by descent.

Points fall into cells that halve both axes twice a level. Only occupied cells exist:
each level is a Parquet table of (parent cell, cell, points, bounds of the points, lowest
order). A cell of at most ``capacity`` points is a leaf and is not split further; levels
that split hardly any cell are left out, so far clusters cost no rounds in between.

A query goes down twice, each level a join of cells with their children: first to the
child with the lowest bound only, to a leaf, for a good distance; then to every child
whose bound does not exceed that distance. The bound is the larger of the distance to the
bounding box and the distance in the axes x + y and x - y, in which L1 is a maximum. No
query meets a cell without points, and a leaf costs at most ``capacity`` comparisons.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_folder

BITS = 40          # halvings of an axis, two a level
CAPACITY = 16      # points of a leaf
FEW = 100_000      # cells (about 100 bytes each) of a level that are broadcast
STEPS = 4          # joins in a row before the plan is cut
GROWTH = 2         # a level is kept if it has so many times the cells of the one kept before


@dataclass
class Level:
    cells: DataFrame
    points: DataFrame
    n: int


class Pyramid:
    """Levels over ``points`` (``_x``, ``_y`` finite doubles, ``_ord``, payload); distances
    are ``wx * |dx| + wy * |dy|``."""

    def __init__(self, points: DataFrame, capacity: int = CAPACITY, wx: float = 1.0, wy: float = 1.0):
        self.spark, self.wx, self.wy = points.sparkSession, float(wx), float(wy)
        self.root = scratch_folder(self.spark, "pyramid")
        self.levels: list[Level] = []
        self.payload = points.columns
        x, y = self._scaled("_x", "_y")
        at = points.agg(F.count("*").alias("n"), F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1"),
                        F.coalesce(F.bool_and(_whole(x) & _whole(y)), F.lit(True)).alias("whole")).first()
        self.n, self.whole = at.n, at.whole and self.wx.is_integer() and self.wy.is_integer()
        self.reach = max(abs(at.x0), abs(at.x1)) + max(abs(at.y0), abs(at.y1)) if self.n else 0.0
        if self.n:
            self._build(points, at, max(int(capacity), 1))

    def _scaled(self, x: str, y: str) -> tuple[Column, Column]:
        return F.lit(self.wx) * F.col(x), F.lit(self.wy) * F.col(y)

    def _save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _build(self, points: DataFrame, at, capacity: int) -> None:
        side = max(at.x1 - at.x0, at.y1 - at.y0) or 1.0
        # bounds come from the points, so rounding here moves a point to a neighbouring cell at worst
        x, y = self._scaled("_x", "_y")
        cell = [F.least(F.floor((c - F.lit(lo)) / F.lit(side) * float(1 << BITS)), F.lit((1 << BITS) - 1)).cast("long") for c, lo in ((x, at.x0), (y, at.y0))]
        rest = points.select("*", cell[0].alias("_ci"), cell[1].alias("_cj"))
        shifts = list(range(BITS - 2, -1, -2))
        if self.n > capacity:
            seen = rest.agg(*[F.approx_count_distinct(F.struct(F.shiftright("_ci", s), F.shiftright("_cj", s))).alias(str(s)) for s in shifts]).first()
            kept, last = [], 1
            for s in shifts:
                if seen[str(s)] >= GROWTH * last or s == 0:
                    kept.append(s)
                    last = seen[str(s)]
        else:
            kept = [0]
        above = BITS
        for k, s in enumerate(kept):
            place = {"_pi": F.shiftright("_ci", above), "_pj": F.shiftright("_cj", above), "_i": F.shiftright("_ci", s), "_j": F.shiftright("_cj", s)}
            keyed = rest.select("*", *[c.alias(n) for n, c in place.items()])
            if self.n <= capacity:
                keyed = keyed.withColumns({n: F.lit(0).cast("long") for n in place})
            cells = keyed.groupBy(*place).agg(
                F.count("*").alias("_n"), F.min("_ord").alias("_first"),
                *[f(c).alias(f"_{n}{i}") for n, c in (("x", x), ("y", y), ("u", x + y), ("v", x - y)) for i, f in enumerate((F.min, F.max))])
            # points that no level tells apart stay in a leaf together
            cells = self._save(cells.withColumn("_leaf", (F.col("_n") <= capacity) | F.lit(s == 0)), f"level-{k:02d}")
            leaves, n = cells.agg(F.count_if("_leaf"), F.count("*")).first()
            if leaves < n:
                keyed = keyed.join(_few(cells.select("_i", "_j", "_leaf"), n), ["_i", "_j"])
                keyed = self._save(keyed, f"points-{k:02d}")
                inside, rest = keyed.where("_leaf"), keyed.where("NOT _leaf").select(*self.payload, "_ci", "_cj")
            else:
                inside = self._save(keyed, f"points-{k:02d}")
            self.levels.append(Level(cells, inside.select("_i", "_j", *self.payload), n))
            if leaves == n:
                break
            above = s

    # ---- search ---------------------------------------------------------------------

    def nearest(self, queries: DataFrame) -> DataFrame:
        """``queries`` (distinct ``_qx``, ``_qy``, finite) with ``_m``: a struct of the
        distance ``_d``, the lowest ``_ord`` at it, and the payload."""
        # the root is cell (0, 0); not literals, of which the optimizer would make a join without keys
        start = queries.select("_qx", "_qy", (F.col("_qx") * 0).cast("long").alias("_pi"), (F.col("_qy") * 0).cast("long").alias("_pj"))
        first = self._down(start, None)
        best = first.groupBy("_qx", "_qy").agg(F.min_by(F.struct("_d", "_ord"), F.struct("_d", "_ord")).alias("_b")).checkpoint(eager=True)
        exact = self.whole and best.agg(F.bool_and(_whole(F.col("_qx")) & _whole(F.col("_qy")))).first()[0]
        found = self._down(start.join(best, ["_qx", "_qy"]), bool(exact))
        cols = ["_d", *self.payload]
        return found.groupBy("_qx", "_qy").agg(F.min_by(F.struct(*cols), F.struct("_d", "_ord")).alias("_m"))

    def _bound(self) -> Column:
        """No point of a cell is nearer to the query than this."""
        def off(q: Column, n: str) -> Column:
            return F.greatest(F.col(f"_{n}0") - q, q - F.col(f"_{n}1"), F.lit(0.0))
        x, y = self._scaled("_qx", "_qy")
        return F.greatest(off(x, "x") + off(y, "y"), off(x + y, "u"), off(x - y, "v"))

    def _down(self, front: DataFrame, exact: bool | None) -> DataFrame:
        """Pairs of queries and points. ``exact`` None: along the lowest bound only; else all
        within the distance ``_b`` of a query (exact: sums are, so equal bounds are ties)."""
        out = []
        keep = [c for c in front.columns if c not in ("_pi", "_pj")]
        for k, level in enumerate(self.levels):
            x = front.join(_few(level.cells, level.n), ["_pi", "_pj"]).withColumn("_low", self._bound())
            if exact is None:
                x = x.groupBy("_qx", "_qy").agg(F.min_by(F.struct("_i", "_j", "_leaf"), F.struct("_low", "_first")).alias("_c")).select("_qx", "_qy", "_c.*")
            else:
                best = F.col("_b._d")
                # rounding must not lose a point: the bound is lowered by more than it can be off,
                # which grows with the coordinates, however small the distance
                x0, y0 = self._scaled("_qx", "_qy")
                near = F.col("_low") - (F.abs(x0) + F.abs(y0) + F.lit(self.reach)) * 1e-14 <= best
                x = x.where(near if not exact else (F.col("_low") < best) | ((F.col("_low") == best) & (F.col("_first") <= F.col("_b._ord"))))
            x = x.select(*keep, "_i", "_j", "_leaf")
            last = k == len(self.levels) - 1
            if not last and k % STEPS == STEPS - 1:
                x = x.checkpoint(eager=True)
            pairs = (x if last else x.where("_leaf")).join(level.points, ["_i", "_j"])
            d = F.lit(self.wx) * F.abs(F.col("_qx") - F.col("_x")) + F.lit(self.wy) * F.abs(F.col("_qy") - F.col("_y"))
            out.append(pairs.select(*keep, d.alias("_d"), *self.payload))
            front = x.where("NOT _leaf").select(*keep, F.col("_i").alias("_pi"), F.col("_j").alias("_pj"))
        found = out[0]
        for o in out[1:]:
            found = found.unionByName(o)
        return found


def _whole(c: Column) -> Column:
    return (c == F.floor(c)) & (F.abs(c) < float(1 << 50))


def _few(cells: DataFrame, n: int) -> DataFrame:
    return F.broadcast(cells) if n <= FEW else cells
