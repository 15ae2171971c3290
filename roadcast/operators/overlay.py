"""Union of the polygons of each area, as a plan over edges.

The union's outline is found without ever assembling an area in one place:

1. every polygon part (a *piece*) gives its segments, interior on the left;
2. corners are rounded to a fixed grid, and segments that meet are cut at the meeting
   points, rounded too (grid equi-join on cells). A corner within ``TOUCH`` of a segment
   cuts it. Cutting is repeated for areas where a rounded point lies off its segment,
   until none does, so that edges meet at shared grid points only;
3. for every cut edge, the number of pieces covering either side is read from the
   edges in its own cell plus a running total along the row of cells;
4. an edge is outline if exactly one side is covered;
5. pieces that touch along a line or overlap form one part of the union; they are
   linked at the vertices where a covered wedge joins their edges.

Rows are edges; the largest group any single task sees is a grid cell, a row of
occupied cells, one segment or one vertex. Areas with a single piece skip all of it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadcast.functions.polygon import oriented_segments
from roadcast.operators.components import component_labels
from roadcast.session import checkpointed

SEG = ("ax", "ay", "bx", "by")
MEAN_CELLS = 64  # cells an edge of mean extent crosses at most
RUN = 1024  # cells per run of a running total
PAD = 1e-9  # share of a cell added around edges, so rounding never loses a cell
UNITS = 1e11  # grid points a degree: outlines of merged areas are rounded to a micrometre
TOUCH = 1.0  # in grid units; more than half a grid square's diagonal
ROUNDS = 30


def pieces(features: DataFrame, feature_id: Sequence[str] = ("feature_index",)) -> DataFrame:
    """One row per distinct polygon part of an area; exact copies are one piece.

    The columns ``feature_id`` identify a feature.
    """
    identity = F.struct(*feature_id).alias("feature_id")
    exploded = features.select("beat", identity, F.posexplode("parts").alias("part_no", "part"))
    return exploded.groupBy("beat", "part").agg(
        F.min(F.struct("feature_id", "part_no")).alias("piece")
    )


def _piece_edges(pieces_df: DataFrame) -> DataFrame:
    return pieces_df.select("beat", "piece", F.explode(oriented_segments(F.col("part"))).alias("s")).select(
        "beat", "piece", "s.*"
    )


def union_outline(features: DataFrame, feature_id: Sequence[str] = ("feature_index",)) -> DataFrame:
    """Outline edges of the union per area: ``beat, part, x0, y0, x1, y1``.

    The interior is on the left of every edge. ``part`` names the connected part of
    the union by its least piece.
    """
    all_pieces = checkpointed(pieces(features, feature_id))
    crowded = all_pieces.groupBy("beat").agg(F.count("*").alias("n")).filter("n > 1").select("beat")
    lone = _piece_edges(all_pieces.join(crowded, "beat", "left_anti")).withColumnRenamed("piece", "part")
    shared = _piece_edges(all_pieces.join(crowded, "beat", "left_semi"))
    return lone.unionByName(_merge(shared))


def _before(px: Column, py: Column, qx: Column, qy: Column) -> Column:
    return (px < qx) | ((px == qx) & (py < qy))


def _canonical(df: DataFrame, *keep: str | Column) -> DataFrame:
    """Undirected form a < b of directed edges, with ``way`` +1 along it and -1 against."""
    forward = _before(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))
    pick = lambda yes, no, name: F.when(forward, F.col(yes)).otherwise(F.col(no)).alias(name)
    return df.select(
        *keep,
        pick("x0", "x1", "ax"),
        pick("y0", "y1", "ay"),
        pick("x1", "x0", "bx"),
        pick("y1", "y0", "by"),
        F.when(forward, F.lit(1)).otherwise(F.lit(-1)).alias("way"),
    )


def _on_grid(edges: DataFrame) -> DataFrame:
    """Coordinates as whole numbers of grid units (still doubles, exact below 2**53); collapsed edges go."""
    return edges.select(
        "beat", "piece", *[F.rint(F.col(c) * UNITS).alias(c) for c in ("x0", "y0", "x1", "y1")]
    ).filter((F.col("x0") != F.col("x1")) | (F.col("y0") != F.col("y1")))


def _merged(edges: DataFrame) -> DataFrame:
    return checkpointed(edges.groupBy("beat", *SEG).agg(F.sum("net").alias("net"), F.min("piece").alias("piece")))


def _planar(segments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges that meet at their ends only (``beat, g, *SEG, net, piece``), and links of pieces on one edge.

    An area is cut again while a cut has bent one of its segments: a bent segment may meet
    others that it missed before. Unbent cuts lie on their segments and need no second look.
    """
    finished, links = [], []
    for _ in range(ROUNDS):
        # The geometric mean suits the bulk of the edges. Held above a share of the plain
        # mean, it keeps the cells entered by all edges below a multiple of their number.
        extent = F.greatest(F.abs(F.col("bx") - F.col("ax")), F.abs(F.col("by") - F.col("ay")))
        size = F.greatest(F.exp(F.avg(F.log(extent))), F.avg(extent) / MEAN_CELLS)
        grid = segments.groupBy("beat").agg(size.alias("g"))
        cuts = checkpointed(_cut(segments.join(grid, "beat")))
        edges = _merged(cuts)
        links.append(_owner_links(cuts, edges))
        bent = cuts.groupBy("beat").agg(F.max("bent").alias("again"), F.min("g").alias("g"))
        finished.append(edges.join(bent.filter("NOT again").select("beat", "g"), "beat"))
        again = bent.filter("again").select("beat")
        if again.isEmpty():
            break
        segments = checkpointed(edges.join(again, "beat", "left_semi"))
    else:
        raise RuntimeError(f"edges still cross after {ROUNDS} rounds of cutting")
    union = lambda frames: reduce(DataFrame.unionByName, frames)
    return checkpointed(union(finished)), union(links)


def _merge(edges: DataFrame) -> DataFrame:
    owned = _canonical(_on_grid(edges), "beat", "piece").withColumn("net", F.col("way"))
    segments = _merged(owned)
    cut_edges, cut_links = _planar(segments)
    sided = checkpointed(_coverage(cut_edges))
    same_edge = _owner_links(owned, segments).unionByName(cut_links).unionByName(_wedge_links(sided))
    labels = component_labels(same_edge)
    outline = sided.filter((F.col("left_cover") > 0) != (F.col("right_cover") > 0))
    interior_left = F.col("left_cover") > 0
    pick = lambda yes, no, name: (
        F.when(interior_left, F.col(yes)).otherwise(F.col(no)) / UNITS
    ).alias(name)
    directed = outline.select(
        "beat",
        F.struct("beat", "piece").alias("node"),
        "piece",
        pick("ax", "bx", "x0"),
        pick("ay", "by", "y0"),
        pick("bx", "ax", "x1"),
        pick("by", "ay", "y1"),
    )
    return directed.join(labels, "node", "left").select(
        "beat",
        F.coalesce(F.col("component.piece"), F.col("piece")).alias("part"),
        "x0",
        "y0",
        "x1",
        "y1",
    )


def _owner_links(rows: DataFrame, grouped: DataFrame) -> DataFrame:
    """Pieces on the same edge belong together: link each to the edge's least piece."""
    least = grouped.select("beat", *SEG, F.col("piece").alias("least"))
    return (
        rows.join(least, ["beat", *SEG])
        .filter(F.col("piece") != F.col("least"))
        .select(F.struct("beat", "piece").alias("a"), F.struct("beat", F.col("least").alias("piece")).alias("b"))
        .distinct()
    )


def _cells(df: DataFrame) -> DataFrame:
    """Register every edge in each grid cell it passes, column by column; ``g`` is the cell size."""
    pad = f"(g * {PAD!r} + {2 * TOUCH!r})"
    columns = df.selectExpr("*", f"explode(sequence(floor((ax - {pad}) / g), floor((bx + {pad}) / g))) AS cx")

    def height_at(x: str) -> str:
        """Ordinate of the edge at x, taken at its nearer end when x lies outside."""
        return f"(ay + (least(greatest({x}, ax), bx) - ax) * ((by - ay) / nullif(bx - ax, 0D)))"

    left, right = height_at(f"(cx * g - {pad})"), height_at(f"((cx + 1) * g + {pad})")
    spans = columns.selectExpr(
        "*",
        f"CASE WHEN ax = bx THEN ay ELSE least({left}, {right}) END AS low",
        f"CASE WHEN ax = bx THEN by ELSE greatest({left}, {right}) END AS high",
    )
    return spans.selectExpr(
        *df.columns, "cx", f"explode(sequence(floor((low - {pad}) / g), floor((high + {pad}) / g))) AS cy"
    )


def _side(px: Column, py: Column, qx: Column, qy: Column, rx: Column, ry: Column) -> Column:
    """+1, 0 or -1: r left of, within ``TOUCH`` of, or right of the line p to q."""
    off = (qx - px) * (ry - py) - (qy - py) * (rx - px)
    return F.when(F.abs(off) <= TOUCH * F.hypot(qx - px, qy - py), F.lit(0)).otherwise(F.signum(off).cast("int"))


def _cut(segments: DataFrame) -> DataFrame:
    """Split every segment where another one of the area touches or crosses it."""
    cells = _cells(segments.select("beat", "g", *SEG)).drop("g")
    ax, ay, bx, by = (F.col(c) for c in SEG)
    ox, oy, px, py = (F.col(f"o{c}") for c in SEG)
    # both sides are the same plan, so the cells are computed and shuffled once
    same_cell = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("beat", "cx", "cy")]
    met = (
        cells.alias("l")
        .join(cells.alias("r"), same_cell)
        .select("l.beat", *[f"l.{c}" for c in SEG], *[F.col(f"r.{c}").alias(f"o{c}") for c in SEG])
        .filter(
            (F.struct(ax, ay, bx, by) < F.struct(ox, oy, px, py))
            & (ox <= bx + TOUCH)
            & (px >= ax - TOUCH)
            & (F.least(oy, py) <= F.greatest(ay, by) + TOUCH)
            & (F.greatest(oy, py) >= F.least(ay, by) - TOUCH)
        )
    )
    sided = met.select(
        "beat",
        *SEG,
        *[f"o{c}" for c in SEG],
        _side(ax, ay, bx, by, ox, oy).alias("s_o"),
        _side(ax, ay, bx, by, px, py).alias("s_p"),
        _side(ox, oy, px, py, ax, ay).alias("s_a"),
        _side(ox, oy, px, py, bx, by).alias("s_b"),
    )

    def inside(x: Column, y: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
        """Beside the inner part of a segment: its foot lies strictly between the ends, and it is neither end."""
        foot = (x - x0) * (x1 - x0) + (y - y0) * (y1 - y0)
        whole = (x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)
        return (foot > 0) & (foot < whole) & ~((x == x0) & (y == y0)) & ~((x == x1) & (y == y1))

    cross = (F.col("s_o") * F.col("s_p") < 0) & (F.col("s_a") * F.col("s_b") < 0)
    along = ((ox - ax) * (py - oy) - (oy - ay) * (px - ox)) / F.nullif(
        (bx - ax) * (py - oy) - (by - ay) * (px - ox), F.lit(0.0)
    )
    meeting = F.struct(F.rint(ax + along * (bx - ax)).alias("x"), F.rint(ay + along * (by - ay)).alias("y"))
    first = F.struct(ax.alias("ax"), ay.alias("ay"), bx.alias("bx"), by.alias("by"))
    second = F.struct(ox.alias("ax"), oy.alias("ay"), px.alias("bx"), py.alias("by"))
    at = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    cut = lambda seg, point: F.struct(seg.alias("seg"), point.alias("p"))
    found = F.array_compact(
        F.array(
            F.when((F.col("s_o") == 0) & inside(ox, oy, ax, ay, bx, by), cut(first, at(ox, oy))),
            F.when((F.col("s_p") == 0) & inside(px, py, ax, ay, bx, by), cut(first, at(px, py))),
            F.when((F.col("s_a") == 0) & inside(ax, ay, ox, oy, px, py), cut(second, at(ax, ay))),
            F.when((F.col("s_b") == 0) & inside(bx, by, ox, oy, px, py), cut(second, at(bx, by))),
            F.when(cross, cut(first, meeting)),
            F.when(cross, cut(second, meeting)),
        )
    )
    points = sided.select("beat", F.explode(found).alias("f")).select("beat", "f.seg.*", "f.p.x", "f.p.y").distinct()
    starts = segments.select("beat", *SEG, ax.alias("x"), ay.alias("y"))
    ends = segments.select("beat", *SEG, bx.alias("x"), by.alias("y"))
    stops = starts.unionByName(ends).unionByName(points)
    # repeated stops sort together and give zero-length pieces, which drop out
    along_segment = Window.partitionBy("beat", *SEG).orderBy(
        (F.col("x") - ax) * (bx - ax) + (F.col("y") - ay) * (by - ay), "x", "y"
    )
    off = (bx - ax) * (F.col("y") - ay) - (by - ay) * (F.col("x") - ax)
    spans = (
        stops.select(
            "beat",
            *SEG,
            F.col("x").alias("x0"),
            F.col("y").alias("y0"),
            F.lead("x").over(along_segment).alias("x1"),
            F.lead("y").over(along_segment).alias("y1"),
            (off != 0).alias("bent"),
        )
        .filter(F.col("x1").isNotNull() & ((F.col("x0") != F.col("x1")) | (F.col("y0") != F.col("y1"))))
        .join(segments, ["beat", *SEG])
    )
    return _canonical(spans, "beat", "g", "piece", "net", "bent").select(
        "beat", "g", "piece", *SEG, (F.col("net") * F.col("way")).alias("net"), "bent"
    )


def _coverage(edges: DataFrame) -> DataFrame:
    """Add how many pieces cover the left and the right side of every edge a to b.

    The count at an edge's middle follows a path inside its cell: east to the cell's
    border, north to its corner, then a running total of signed crossings along the
    top line of the row of cells. Points are taken a hair up and right, so a path
    never runs through a vertex or along an edge.
    """
    cells = checkpointed(_cells(edges.select("beat", "g", *SEG, "net")))
    east, north, west = "((cx + 1) * g)", "((cy + 1) * g)", "(cx * g)"

    # The tests are SQL text because each is used several times with other points.
    def turn(x: str, y: str) -> str:
        """Side of the edge on which the point just above and right of (x, y) lies; never 0."""
        d = f"((bx - ax) * ({y} - ay) - (by - ay) * ({x} - ax))"
        return f"(CASE WHEN {d} > 0 THEN 1 WHEN {d} < 0 THEN -1 WHEN bx > ax THEN 1 ELSE -1 END)"

    def is_west(x: str, y: str) -> str:
        return f"({turn(x, y)} = CASE WHEN by > ay THEN 1 ELSE -1 END)"

    def spans_height(y: str) -> str:
        return f"((ay > {y}) <> (by > {y}))"

    upward = "CASE WHEN by > ay THEN net ELSE -net END"
    on_top = f"CASE WHEN {spans_height(north)} AND {is_west(west, north)} AND NOT {is_west(east, north)} THEN {upward} ELSE 0 END"
    per_cell = cells.groupBy("beat", "cx", "cy").agg(F.sum(F.expr(on_top)).alias("passing"))
    corners = _running_cover(per_cell)
    middles = edges.selectExpr(
        "beat",
        *[f"{c} AS m{c}" for c in SEG],
        "net AS m_net",
        "piece",
        "(ax + bx) / 2 AS mx",
        "(ay + by) / 2 AS my",
        "floor((ax + bx) / 2 / g) AS cx",
        "floor((ay + by) / 2 / g) AS cy",
    )
    own = " AND ".join(f"m{c} = {c}" for c in SEG)
    to_border = f"CASE WHEN {spans_height('my')} AND {is_west('mx', 'my')} AND NOT {is_west(east, 'my')} THEN {upward} ELSE 0 END"
    # going up across an edge adds its net cover, so the lower point has that much less
    to_corner = f"CASE WHEN (ax > {east}) <> (bx > {east}) AND {turn(east, 'my')} < 0 AND {turn(east, north)} > 0 THEN net ELSE 0 END"
    step = F.expr(f"CASE WHEN {own} THEN 0 ELSE {to_border} END - {to_corner}")
    keys = ["beat", "max", "may", "mbx", "mby", "m_net", "piece", "cx", "cy"]
    summed = middles.join(cells, ["beat", "cx", "cy"]).groupBy(*keys).agg(F.sum(step).alias("inner_cover"))
    one_side = summed.join(corners, ["beat", "cx", "cy"]).select(
        "beat",
        *[F.col(f"m{c}").alias(c) for c in SEG],
        F.col("m_net").alias("net"),
        "piece",
        (F.col("inner_cover") + F.col("corner_cover")).alias("cover"),
    )
    # `cover` is the east side, or the upper side of a level edge
    return one_side.selectExpr(
        "beat",
        *SEG,
        "piece",
        "CASE WHEN by > ay THEN cover + net ELSE cover END AS left_cover",
        "CASE WHEN by > ay THEN cover ELSE cover - net END AS right_cover",
    )


def _running_cover(per_cell: DataFrame) -> DataFrame:
    """Sum of ``passing`` over the cells east of each cell in its row, as ``corner_cover``.

    Rows are summed in runs of cells first, so that a very long row is not one task's work.
    """
    runs = per_cell.withColumn("run", F.floor(F.col("cx") / RUN))
    before = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    total = lambda value, window: F.coalesce(F.sum(value).over(window), F.lit(0))
    ahead = (
        runs.groupBy("beat", "cy", "run")
        .agg(F.sum("passing").alias("run_passing"))
        .select("beat", "cy", "run", total("run_passing", before("beat", "cy").orderBy(F.desc("run"))).alias("ahead"))
    )
    within = runs.select(
        "beat", "cx", "cy", "run", total("passing", before("beat", "cy", "run").orderBy(F.desc("cx"))).alias("inner")
    )
    return within.join(ahead, ["beat", "cy", "run"]).select(
        "beat", "cx", "cy", (F.col("inner") + F.col("ahead")).alias("corner_cover")
    )


def _wedge_links(sided: DataFrame) -> DataFrame:
    """Link the pieces of neighbouring edges around a vertex when the wedge between them is covered."""
    rays = sided.select(
        "beat",
        "piece",
        F.explode(
            F.array(
                F.struct(
                    F.col("ax").alias("vx"),
                    F.col("ay").alias("vy"),
                    F.atan2(F.col("by") - F.col("ay"), F.col("bx") - F.col("ax")).alias("angle"),
                    (F.col("left_cover") > 0).alias("covered"),
                ),
                F.struct(
                    F.col("bx").alias("vx"),
                    F.col("by").alias("vy"),
                    F.atan2(F.col("ay") - F.col("by"), F.col("ax") - F.col("bx")).alias("angle"),
                    (F.col("right_cover") > 0).alias("covered"),
                ),
            )
        ).alias("r"),
    ).select("beat", "piece", "r.*")
    around = Window.partitionBy("beat", "vx", "vy").orderBy("angle")
    whole = Window.partitionBy("beat", "vx", "vy").orderBy("angle").rowsBetween(Window.unboundedPreceding, 0)
    return (
        rays.select(
            "beat",
            "piece",
            "covered",
            F.coalesce(F.lead("piece").over(around), F.first("piece").over(whole)).alias("next_piece"),
        )
        .filter(F.col("covered") & (F.col("piece") != F.col("next_piece")))
        .select(F.struct("beat", "piece").alias("a"), F.struct("beat", F.col("next_piece").alias("piece")).alias("b"))
        .distinct()
    )


def open_vertices(outline: DataFrame) -> DataFrame:
    """Vertices where the outline does not close (edges in and out differ); none for a sound union."""
    ends = outline.select(
        "beat",
        F.explode(
            F.array(
                F.struct(F.col("x0").alias("x"), F.col("y0").alias("y"), F.lit(1).alias("d")),
                F.struct(F.col("x1").alias("x"), F.col("y1").alias("y"), F.lit(-1).alias("d")),
            )
        ).alias("e"),
    ).select("beat", "e.*")
    return ends.groupBy("beat", "x", "y").agg(F.sum("d").alias("imbalance")).filter("imbalance <> 0")
