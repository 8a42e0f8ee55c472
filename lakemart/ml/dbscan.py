"""Density clusters (DBSCAN) on a grid, exact and without comparing all rows of a neighbourhood.

Equal vectors fold to one point with a weight. Points fall into cells so small that all points
of a cell lie within ``eps`` of each other. Then

* a cell with ``min_samples`` rows or more is dense: all its points are core, and none is
  compared with another of its cell. The cell is one node of the cluster graph, as is any
  other cell with a core point;
* a point of a sparse cell is first counted against a bounded number of leaders of its coarse
  cell. Only where these do not make it core, it is compared with all points near it;
* core cells are first linked by a bounded number of leaders per coarse cell. Components that
  come out of this, one for most cells where rows lie dense, are folded per coarse cell, and only
  cells of different components are compared. Both steps decide nothing by a sample: what leaders
  leave open is judged by all points;
* two dense cells touch when their closest pair does. Both cells are halved, level by level,
  into tight boxes: a pair of boxes farther apart than ``eps`` goes, one pair of points within
  ``eps`` settles the cells, what is left goes on. Points of settled cells are not read again.

Neighbouring cells are found over coarse cells of side ``eps`` by an equi-join on their leading
coordinates; cells meet with their bounding boxes and the join keeps those within ``eps``.

Numbers follow the order of rows by key: clusters are counted by their first core row, and a
border point belongs to the first cluster that has a core point within ``eps``; -1 is noise.

Defined results: a row with a null or non-finite feature is noise; rows with equal features
share their label; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart import config
from lakemart.functions.graph import components
from lakemart.functions.ranks import dense_key
from lakemart.session import work_dir
from lakemart.sinks.tables import write_table

NOISE = -1
KEY_DIMENSIONS = 3       # leading coordinates of a coarse cell that the neighbour join runs on
LEADERS = 64             # points of a coarse cell that its points are counted against first
LINKS = 32               # core points of a coarse cell that its core points are linked by first
ACROSS = 4               # of these, those that link neighbouring coarse cells
SHARES = 64              # parts of a coarse cell in which its leaders are sought


def _written(df: DataFrame, name: str) -> DataFrame:
    return write_table(df, work_dir(df.sparkSession, "dbscan", f"{name}-{uuid.uuid4().hex}"))


def _total(terms: list[Column]) -> Column:
    out = terms[0]
    for term in terms[1:]:
        out = out + term
    return out


def _squared(a: str, b: str, d: int) -> Column:
    """Squared distance of two points."""
    return _total([(F.col(f"{a}.x{i}") - F.col(f"{b}.x{i}")) * (F.col(f"{a}.x{i}") - F.col(f"{b}.x{i}")) for i in range(d)])


def _apart(a: str, b: str, d: int, far: bool = False) -> Column:
    """Squared distance of two boxes: of their nearest points, or of their farthest."""
    terms = []
    for i in range(d):
        one, other = F.col(f"{b}.lo{i}") - F.col(f"{a}.hi{i}"), F.col(f"{a}.lo{i}") - F.col(f"{b}.hi{i}")
        gap = F.greatest(-one, -other) if far else F.greatest(F.lit(0.0), one, other)
        terms.append(gap * gap)
    return _total(terms)


def _box(d: int) -> list[Column]:
    return [x for i in range(d) for x in (F.min(f"x{i}").alias(f"lo{i}"), F.max(f"x{i}").alias(f"hi{i}"))]


def _grid(rows: DataFrame, columns: list[str], key: str, eps: float, min_samples: int) -> tuple[DataFrame, DataFrame]:
    """Points (pid, cid, dense, coarse, n, first, x0..) and cells (cid, dense, weight, coarse, box) as written tables."""
    d = len(columns)
    per_side = math.ceil(math.sqrt(d))
    side = eps / per_side
    x = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)]
    # -0.0 and 0.0 are one value
    points = rows.select(F.col(key).alias("first"), *x).groupBy(*[f"x{i}" for i in range(d)]).agg(
        F.count(F.lit(1)).alias("n"), F.min("first").alias("first")
    ).withColumn("cell", F.array(*[F.floor(F.col(f"x{i}") / side) for i in range(d)]))
    points = _written(points.withColumn("pid", F.monotonically_increasing_id()), "points")
    cells = points.groupBy("cell").agg(F.sum("n").alias("weight"), *_box(d)).withColumns({
        "cid": F.monotonically_increasing_id(),
        "dense": F.col("weight") >= min_samples,
        "coarse": F.transform("cell", lambda c: F.floor(c / F.lit(per_side))),
    })
    cells = _written(cells, "cells")
    keyed = points.join(cells.select("cell", "cid", "dense", "coarse"), "cell").drop("cell")
    return _written(keyed, "keyed"), cells.drop("cell")


def _coarse_pairs(coarse: DataFrame, d: int, of: DataFrame | None = None) -> DataFrame:
    """(one, other): neighbouring coarse cells both ways, each with itself too; ``of`` limits ``one``."""
    lead = min(d, KEY_DIMENSIONS)
    steps = F.array(*[F.array(*[F.lit(s).cast("long") for s in step]) for step in itertools.product((-1, 0, 1), repeat=lead)])
    near = (of if of is not None else coarse).withColumn("step", F.explode(steps)).select(
        F.col("coarse").alias("one"), F.zip_with(F.slice("coarse", 1, lead), "step", lambda c, s: c + s).alias("at"))
    others = coarse.select(F.col("coarse").alias("other"), F.slice("coarse", 1, lead).alias("at"))
    pairs = near.join(others, "at").drop("at")
    for i in range(lead, d):
        pairs = pairs.where(F.abs(F.get("one", F.lit(i)) - F.get("other", F.lit(i))) <= 1)
    return pairs


def _leaders(points: DataFrame, most: int) -> DataFrame:
    """At most ``most`` points of each coarse cell, the first of a hash order that does not follow from place."""
    mixed = points.withColumn("h", F.xxhash64("pid"))
    # a coarse cell may hold very many points: each of SHARES parts gives its first ones, then the cell its own
    share = Window.partitionBy("coarse", F.pmod("h", F.lit(SHARES))).orderBy("h", "pid")
    few = mixed.withColumn("k", F.row_number().over(share)).where(F.col("k") <= most)
    whole = Window.partitionBy("coarse").orderBy("h", "pid")
    return few.withColumn("k", F.row_number().over(whole)).where(F.col("k") <= most).drop("h")


def _early_cores(points: DataFrame, weights: DataFrame, d: int, eps: float, min_samples: int) -> DataFrame:
    """(pid): points of sparse cells that are core by their own cell and the leaders of their coarse cell alone."""
    leaders = _written(_leaders(points, LEADERS), "leaders")
    met = points.where("NOT dense").alias("p").join(leaders.alias("q"), (F.col("p.coarse") == F.col("q.coarse"))
                                                    & (F.col("p.cid") != F.col("q.cid")) & (_squared("p", "q", d) <= eps * eps))
    around = met.groupBy(F.col("p.pid").alias("pid"), F.col("p.cid").alias("cid")).agg(F.sum("q.n").alias("around"))
    seen = points.where("NOT dense").select("pid", "cid").join(weights, "cid").join(around.select("pid", "around"), "pid", "left")
    return seen.where(F.col("weight") + F.coalesce("around", F.lit(0)) >= min_samples).select("pid")


def _contacts(own: DataFrame, cells: DataFrame, points: DataFrame, d: int, eps: float) -> DataFrame:
    """The points ``own`` with what lies within ``eps`` in other cells: (pid, cid, other, q, n).

    ``q`` is the other point, or null for all points of a dense cell together.
    """
    around = _coarse_pairs(cells.select("coarse").distinct(), d, own.select("coarse").distinct())
    near = cells.where("TRUE").join(around, F.col("coarse") == F.col("other"))
    inside = _total([F.pow(F.greatest(F.lit(0.0), F.col(f"c.lo{i}") - F.col(f"p.x{i}"), F.col(f"p.x{i}") - F.col(f"c.hi{i}")), 2)
                     for i in range(d)])
    # a little room, so that a rounded box distance loses no pair of points that are judged by their own distance
    towards = own.alias("p").join(near.alias("c"), (F.col("p.coarse") == F.col("c.one")) & (F.col("p.cid") != F.col("c.cid"))
                                  & (inside <= eps * eps * (1 + 1e-9))).select(
        "p.pid", "p.cid", *[f"p.x{i}" for i in range(d)], F.col("c.cid").alias("b"), F.col("c.dense").alias("b_dense"))
    met = towards.alias("p").join(points.alias("q"), (F.col("p.b") == F.col("q.cid")) & (_squared("p", "q", d) <= eps * eps))
    return met.groupBy(
        F.col("p.pid").alias("pid"), F.col("p.cid").alias("cid"), F.col("p.b").alias("other"),
        F.when(~F.col("p.b_dense"), F.col("q.pid")).alias("q"),
    ).agg(F.sum("q.n").alias("n"))


def _sure_edges(cores: DataFrame, d: int, eps: float) -> DataFrame:
    """Some edges (a, b) between cells with core points within ``eps``: by leaders among the core points."""
    leaders = _written(_leaders(cores, LINKS), "links")
    far = eps * eps
    met = cores.alias("p").join(leaders.alias("q"), (F.col("p.coarse") == F.col("q.coarse")) & (_squared("p", "q", d) <= far))
    held = met.groupBy(F.col("p.cid").alias("a")).agg(F.array_sort(F.collect_set("q.cid")).alias("to"))
    held = _written(held, "held")
    own = held.select("a", F.col("to")[0].alias("b"))
    between = held.select(F.explode(F.arrays_zip(
        F.slice("to", F.lit(1), F.size("to") - 1).alias("a"), F.slice("to", F.lit(2), F.size("to")).alias("b"))).alias("e")
    ).select("e.a", "e.b").distinct()
    first = leaders.where(F.col("k") <= ACROSS)
    pairs = _coarse_pairs(first.select("coarse").distinct(), d)
    across = first.alias("p").join(pairs, F.col("p.coarse") == F.col("one")).join(
        first.alias("q"), (F.col("q.coarse") == F.col("other")) & (F.col("p.cid") < F.col("q.cid")) & (_squared("p", "q", d) <= far)
    ).select(F.col("p.cid").alias("a"), F.col("q.cid").alias("b")).distinct()
    return own.union(between).union(across)


def _open_pairs(cells: DataFrame, member: DataFrame, d: int, eps: float) -> DataFrame:
    """(a, b, a_dense, b_dense): pairs of cells of different components, each once, whose boxes are within ``eps``.

    Cells of one component in one coarse cell form a group; pairs of groups of one component go at once.
    """
    placed = _written(cells.join(member.withColumnRenamed("node", "cid"), "cid"), "placed")
    groups = _written(placed.groupBy("coarse", "component").agg(
        *[x for i in range(d) for x in (F.min(f"lo{i}").alias(f"lo{i}"), F.max(f"hi{i}").alias(f"hi{i}"))]), "groups")
    # a coarse cell that meets one component only, all around, has no open pair
    pairs = _coarse_pairs(groups.select("coarse").distinct(), d)
    # each pair of groups once: by component
    met = groups.alias("a").join(pairs, F.col("a.coarse") == F.col("one")).join(
        groups.alias("b"), (F.col("b.coarse") == F.col("other")) & (F.col("a.component") < F.col("b.component"))
        & (_apart("a", "b", d) <= eps * eps)
    ).select(F.col("a.coarse").alias("one"), F.col("a.component").alias("c1"), F.col("b.coarse").alias("other"),
             F.col("b.component").alias("c2"))
    met = _written(met, "met")
    return met.join(placed.alias("a"), (F.col("a.coarse") == F.col("one")) & (F.col("a.component") == F.col("c1"))).join(
        placed.alias("b"), (F.col("b.coarse") == F.col("other")) & (F.col("b.component") == F.col("c2"))
        & (_apart("a", "b", d) <= eps * eps)
    ).select(F.col("a.cid").alias("a"), F.col("b.cid").alias("b"), F.col("a.dense").alias("a_dense"), F.col("b.dense").alias("b_dense"))


def _linked(cores: DataFrame, pairs: DataFrame, d: int, eps: float) -> DataFrame:
    """The pairs (a, b) of cells, one of them sparse, with core points within ``eps``."""
    own = cores.join(pairs.where("NOT (a_dense AND b_dense)").select("a", "b"), F.col("cid") == F.col("a"))
    return own.alias("p").join(cores.alias("q"), (F.col("p.b") == F.col("q.cid")) & (_squared("p", "q", d) <= eps * eps)).select(
        "p.a", "p.b").distinct()


def _touching(points: DataFrame, pairs: DataFrame, d: int, eps: float) -> DataFrame:
    """The pairs (a, b) of dense cells that hold two points within ``eps``, found by halving both cells."""
    members = points.select("cid", F.lit("").alias("path"), "pid", *[f"x{i}" for i in range(d)])
    open_pairs = pairs.select("a", F.lit("").alias("pa"), "b", F.lit("").alias("pb"))
    settled = None
    while True:
        open_pairs = _written(open_pairs, "open")
        boxes = open_pairs.select(F.col("a").alias("cid"), F.col("pa").alias("path")).union(
            open_pairs.select("b", "pb")).distinct()
        members = _written(members.join(boxes, ["cid", "path"], "left_semi"), "members")
        widest = F.greatest(*[F.col(f"hi{i}") - F.col(f"lo{i}") for i in range(d)]) if d > 1 else F.col("hi0") - F.col("lo0")
        axis = F.array_position(F.array(*[F.col(f"hi{i}") - F.col(f"lo{i}") for i in range(d)]), widest).cast("int") - 1
        stats = members.groupBy("cid", "path").agg(
            *_box(d), F.min(F.struct("pid", *[f"x{i}" for i in range(d)])).alias("rep")
        ).select("*", axis.alias("axis"), (widest > 0).alias("splits"))
        stats = _written(stats, "boxes")
        at = lambda side, path: (F.col(f"{side}.cid") == F.col(f"o.{side}")) & (F.col(f"{side}.path") == F.col(f"o.{path}"))
        reps = [F.col(f"a.rep.x{i}") - F.col(f"b.rep.x{i}") for i in range(d)]
        judged = _written(
            open_pairs.alias("o").join(stats.alias("a"), at("a", "pa")).join(stats.alias("b"), at("b", "pb")).select(
                "o.*", F.col("a.splits").alias("sa"), F.col("b.splits").alias("sb"), (_apart("a", "b", d) <= eps * eps).alias("near"),
                ((_apart("a", "b", d, far=True) <= eps * eps) | (_total([r * r for r in reps]) <= eps * eps)).alias("touch")),
            "judged")
        found = judged.where("touch").select("a", "b").distinct()
        settled = found if settled is None else settled.union(found)
        rest = _written(judged.where("near AND NOT touch").join(found, ["a", "b"], "left_anti"), "rest")
        if rest.isEmpty():
            return settled
        children = lambda path, splits: F.explode(F.when(F.col(splits), F.array(F.concat(path, F.lit("0")), F.concat(path, F.lit("1"))))
                                                  .otherwise(F.array(F.concat(path, F.lit("0")))))
        open_pairs = rest.withColumn("ca", children("pa", "sa")).withColumn("cb", children("pb", "sb")).select(
            "a", F.col("ca").alias("pa"), "b", F.col("cb").alias("pb"))
        x, low, high = (F.get(F.array(*[F.col(f"{name}{i}") for i in range(d)]), F.col("axis")) for name in ("x", "lo", "hi"))
        upper = F.col("splits") & ((x > (low + high) / 2) | (x == high))
        members = members.join(stats, ["cid", "path"]).select(
            "cid", F.concat("path", F.when(upper, "1").otherwise("0")).alias("path"), "pid", *[f"x{i}" for i in range(d)])


def labels(rows: DataFrame, key: str, columns: list[str], eps: float = 0.5, min_samples: int = 5) -> DataFrame:
    """(key, Segment) of every row. ``key`` is unique; ``rows`` come from a written table."""
    d = len(columns)
    finite = F.lit(True)
    for c in columns:
        value = F.col(c).cast("double")
        finite = finite & value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))
    usable = rows.where(finite)
    points, cells = _grid(usable, columns, key, eps, min_samples)
    weights = cells.select("cid", "weight")
    sparse = points.where("NOT dense")
    early = _written(_early_cores(points, weights, d, eps, min_samples), "early")
    # the points that leaders leave open are counted against all that is near; few where rows lie dense
    left = sparse.join(early, "pid", "left_anti")
    contacts = _written(_contacts(left, cells, points, d, eps), "contacts")
    degree = _written(left.join(weights, "cid").join(
        contacts.groupBy("pid").agg(F.sum("n").alias("around")), "pid", "left"
    ).select("pid", "cid", (F.col("weight") + F.coalesce("around", F.lit(0)) >= min_samples).alias("core")), "degree")
    cores = _written(points.where("dense").union(sparse.join(
        early.union(degree.where("core").select("pid")), "pid", "left_semi").select(points.columns)), "cores")
    firsts = cores.groupBy("cid").agg(F.min("first").alias("first"))

    # most cells come together by a few sure edges; only cells still apart are looked at pair by pair
    nodes = firsts.select(F.col("cid").alias("node"))
    sure = _written(components(nodes, _sure_edges(cores, d, eps)), "sure")
    pairs = _written(_open_pairs(cells, sure, d, eps), "pairs")
    edges = _linked(cores, pairs, d, eps).union(_touching(points.where("dense"), pairs.where("a_dense AND b_dense"), d, eps))
    of = lambda side: sure.select(F.col("node").alias(side), F.col("component").alias(f"c_{side}"))
    joined = edges.join(of("a"), "a").join(of("b"), "b").select(F.col("c_a").alias("a"), F.col("c_b").alias("b")).distinct()
    whole = components(sure.select(F.col("component").alias("node")).distinct(), joined)
    member = _written(sure.join(whole.select(F.col("node").alias("component"), F.col("component").alias("all")), "component")
                      .select("node", F.col("all").alias("component")), "components")
    of_cell = firsts.join(member.withColumnRenamed("node", "cid"), "cid")
    numbered = dense_key(of_cell.groupBy("component").agg(F.min("first").alias("first")), "first", "number")
    cluster = _written(of_cell.select("cid", "component").join(numbered.select("component", "number"), "component").select(
        "cid", (F.col("number") - 1).cast("int").alias("Segment")), "clusters")

    # border points: fewer than ``min_samples`` rows lie around them
    edge = degree.where("NOT core").select("pid", F.col("cid").alias("own"))
    met = contacts.join(edge, "pid")
    border = edge.select("pid", F.col("own").alias("at")).union(
        met.where("q IS NULL").select("pid", "other")).union(
        met.where("q IS NOT NULL").join(cores.select(F.col("pid").alias("q")), "q", "left_semi").select("pid", "other"))
    border = border.join(cluster, F.col("at") == F.col("cid")).groupBy("pid").agg(F.min("Segment").alias("Segment"))
    per_point = cores.select("pid", "cid").join(cluster, "cid").select("pid", "Segment").union(border)
    named = points.join(per_point, "pid").select("Segment", *[f"x{i}" for i in range(d)])
    same = F.lit(True)
    for i, c in enumerate(columns):
        same = same & (F.col(f"r.{c}").cast("double") == F.col(f"p.x{i}"))
    return rows.alias("r").join(named.alias("p"), same, "left").select(
        f"r.{key}", F.coalesce("p.Segment", F.lit(NOISE)).alias("Segment"))


def segment(features: DataFrame, scaled: DataFrame, eps: float = 0.5, min_samples: int = 5, key: str = "CustomerKey",
            columns: list[str] | None = None) -> DataFrame:
    """Customer features with the density segment found on their scaled values."""
    columns = columns or [f"{c}_scaled" for c in config.SEGMENT_FEATURES]
    return features.join(labels(scaled, key, columns, eps, min_samples), key)
