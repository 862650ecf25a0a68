"""Queries over shapes: parts, holes, overlaps, slivers and audits of a layer of cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import shapes
from ..sources.tables import table
from .registry import registry

QUERIES, ORACLE_SQL, query = registry()

#: A layer of cells made of the orders: a shape for each customer's block of keys, a few claimed by two.
CELLS = """c AS (SELECT DISTINCT shape, "row", col FROM (SELECT (o_orderkey // 100) * 20 + (o_orderkey % 100) // 6 AS shape, (o_orderkey // 100)::INT AS "row", (o_orderkey % 100)::INT AS col FROM orders WHERE o_orderstatus <> 'F'
UNION ALL SELECT (o_orderkey // 200) * 40 + (o_orderkey % 100) // 10 + 7 AS shape, (o_orderkey // 100)::INT, (o_orderkey % 100)::INT FROM orders WHERE o_orderpriority < '2'))"""


def _cells(spark, d):
    o = table(spark, d, "orders")
    key = F.col("o_orderkey")
    row, col = F.floor(key / 100).cast("int"), (key % 100).cast("int")
    a = o.where("o_orderstatus <> 'F'").select((row * 20 + F.floor(col / 6)).cast("long").alias("shape"), row.alias("row"), col.alias("col"))
    b = o.where("o_orderpriority < '2'").select((F.floor(key / 200) * 40 + F.floor(col / 10) + 7).cast("long").alias("shape"), row.alias("row"), col.alias("col"))
    return a.unionByName(b).distinct()


_FOUR = "(VALUES (0, 1), (0, -1), (1, 0), (-1, 0)) AS x(dr, dc)"
_EIGHT = "(SELECT a AS dr, b AS dc FROM (SELECT unnest(range(-1, 2)) AS a), (SELECT unnest(range(-1, 2)) AS b))"


@query(f"""WITH {CELLS}, i AS (SELECT a.shape, count(*) AS n FROM c a CROSS JOIN {_FOUR} JOIN c b ON b.shape = a.shape AND b."row" = a."row" + dr AND b.col = a.col + dc GROUP BY a.shape),
s AS (SELECT shape, count(*) AS cells, max("row") - min("row") + 1 AS height, max(col) - min(col) + 1 AS width FROM c GROUP BY shape)
SELECT s.shape, cells, 4 * cells - coalesce(n, 0) AS sides, least(height, width)::INT AS short_side, round(4 * pi() * cells / (4 * cells - coalesce(n, 0)) ** 2, 4) AS compactness, cells / ((4 * cells - coalesce(n, 0)) / 2 / 2) <= 1.2 AND (4 * cells - coalesce(n, 0)) / 2 / 2 >= 1.5 * (cells / ((4 * cells - coalesce(n, 0)) / 2 / 2)) AS strip FROM s LEFT JOIN i USING (shape)""")
def shape_outlines(spark, d):
    """Area, outline, short side and compactness of every shape, and whether it is a strip."""
    o = shapes.outline(_cells(spark, d), "shape")
    return o.select("shape", "cells", "sides", "short_side", F.round("compactness", 4).alias("compactness"), shapes.strips(o, 1.2, 1.5).alias("strip"))


@query(f"""WITH RECURSIVE {CELLS}, r AS (SELECT shape, "row", col, "row"::BIGINT * 2147483648 + col AS root FROM c UNION SELECT b.shape, b."row", b.col, r.root FROM r CROSS JOIN {_EIGHT} JOIN c b ON b.shape = r.shape AND b."row" = r."row" + dr AND b.col = r.col + dc WHERE r.root < b."row"::BIGINT * 2147483648 + b.col),
p AS (SELECT shape, "row", col, min(root) AS patch FROM r GROUP BY ALL), z AS (SELECT shape, patch, count(*) AS n FROM p GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY shape ORDER BY n DESC, patch) - 1 AS part FROM z)
SELECT shape, part::INT AS part, "row", col FROM p JOIN k USING (shape, patch) WHERE part = 0 OR n >= 2""")
def split_parts(spark, d):
    """Connected parts: the largest keeps the name, others of two cells become shapes."""
    return shapes.split_parts(_cells(spark, d), "shape", 2)


@query(f"""WITH {CELLS}, s AS (SELECT shape, count(*) AS n FROM c GROUP BY shape), r AS (SELECT c.*, row_number() OVER (PARTITION BY "row", col ORDER BY n, shape) AS k FROM c JOIN s USING (shape)) SELECT shape, "row", col FROM r WHERE k = 1""")
def cut_overlaps(spark, d):
    """Contested cells go to the smaller shape."""
    return shapes.cut_overlaps(_cells(spark, d), "shape")


@query(f"""WITH {CELLS} SELECT x.shape AS a, y.shape AS b, count(*) AS cells FROM c x JOIN c y ON x."row" = y."row" AND x.col = y.col AND x.shape < y.shape GROUP BY ALL""")
def overlapping_pairs(spark, d):
    return shapes.overlaps(_cells(spark, d), "shape")


@query(f"""WITH RECURSIVE {CELLS}, e AS (SELECT DISTINCT x.shape AS a, y.shape AS b FROM c x JOIN c y ON x."row" = y."row" AND x.col = y.col), r AS (SELECT DISTINCT shape, shape AS root FROM c UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.shape WHERE r.root < e.b),
m AS (SELECT shape, min(root) AS root FROM r GROUP BY shape) SELECT DISTINCT root AS shape, "row", col FROM c JOIN m USING (shape)""")
def dissolved(spark, d):
    """Shapes that overlap become one."""
    return shapes.dissolve(_cells(spark, d), "shape")


@query(f"""WITH {CELLS}, h AS (SELECT a.shape, a."row" + dr AS "row", a.col + dc AS col, count(*) AS n FROM c a CROSS JOIN {_EIGHT} x GROUP BY ALL), e AS (SELECT shape, "row", col FROM h WHERE n = 9), g AS (SELECT DISTINCT e.shape, e."row" + dr AS "row", e.col + dc AS col FROM e CROSS JOIN {_EIGHT} x)
SELECT c.shape, c."row", c.col FROM c JOIN g USING (shape, "row", col) UNION ALL SELECT shape, "row", col FROM c WHERE shape NOT IN (SELECT shape FROM g)""")
def without_tails(spark, d):
    """What a box of three cells cannot cover goes."""
    return shapes.remove_tails(_cells(spark, d), "shape")


@query(f"""WITH o AS (SELECT (o_orderkey // 100)::INT AS "row", (o_orderkey % 100)::INT AS col FROM orders WHERE o_totalprice > 100000), g AS (SELECT DISTINCT "row" + dr AS "row", col + dc AS col FROM o CROSS JOIN {_EIGHT} x),
s AS (SELECT "row" + dr AS "row", col + dc AS col FROM g CROSS JOIN {_EIGHT} x GROUP BY ALL HAVING count(*) = 9), t AS (SELECT "row" + dr AS "row", col + dc AS col, count(*) AS n FROM s CROSS JOIN {_EIGHT} x GROUP BY ALL) SELECT "row"::INT AS "row", col::INT AS col FROM t WHERE n > 4""")
def closing_then_majority(spark, d):
    o = table(spark, d, "orders").where("o_totalprice > 100000").select(F.floor(F.col("o_orderkey") / 100).cast("int").alias("row"), (F.col("o_orderkey") % 100).cast("int").alias("col"))
    return shapes.close_then_majority(o)


@query(f"""WITH RECURSIVE {CELLS}, r AS (SELECT shape, "row", col, "row"::BIGINT * 2147483648 + col AS root FROM c UNION SELECT b.shape, b."row", b.col, r.root FROM r CROSS JOIN {_EIGHT} JOIN c b ON b.shape = r.shape AND b."row" = r."row" + dr AND b.col = r.col + dc WHERE r.root < b."row"::BIGINT * 2147483648 + b.col),
p AS (SELECT shape, "row", col, min(root) AS patch FROM r GROUP BY ALL), s AS (SELECT shape, count(DISTINCT patch) AS parts, count(*) AS n FROM p GROUP BY shape), t AS (SELECT count(*) AS claimed_twice FROM (SELECT "row", col FROM c GROUP BY ALL HAVING count(*) > 1))
SELECT count(*) AS shapes, count(*) FILTER (parts > 1) AS in_parts, count(*) FILTER (n < 3) AS crumbs, any_value(claimed_twice) AS claimed_twice FROM s, t""")
def layer_audit(spark, d):
    return shapes.audit(_cells(spark, d), "shape", 3)


@query(f"""WITH {CELLS}, l AS (SELECT (o_orderkey // 100)::INT AS "row", (o_orderkey % 100)::INT AS col, substr(o_orderpriority, 1, 1)::INT AS label FROM orders WHERE o_totalprice > 150000), n AS (SELECT shape, label, count(*) AS n FROM c JOIN l USING ("row", col) GROUP BY ALL),
t AS (SELECT shape, arg_max(label, [n, -label]) AS label, max(n) / sum(n) AS share FROM n GROUP BY shape) SELECT s.shape, coalesce(label, -1) AS label, round(share, 6) AS share FROM (SELECT DISTINCT shape FROM c) s LEFT JOIN t USING (shape)""")
def shape_labels(spark, d):
    """Most common label of each shape's cells, -1 without one."""
    o = table(spark, d, "orders").where("o_totalprice > 150000")
    labels = o.select(F.floor(F.col("o_orderkey") / 100).cast("int").alias("row"), (F.col("o_orderkey") % 100).cast("int").alias("col"), F.substring("o_orderpriority", 1, 1).cast("int").alias("label"))
    return shapes.majority_labels(_cells(spark, d), labels, "shape", "label").withColumn("share", F.round("share", 6))


@query()
def filled_holes(spark, d):
    """Shapes of ten by ten blocks with holes of up to four cells filled; no SQL, held against brute force in the tests."""
    o = table(spark, d, "orders").where("o_totalprice > 60000")
    row, col = F.floor(F.col("o_orderkey") / 100).cast("int"), (F.col("o_orderkey") % 100).cast("int")
    return shapes.fill_holes(o.select((F.floor(row / 10) * 10 + F.floor(col / 10)).cast("long").alias("shape"), row.alias("row"), col.alias("col")), "shape", 4)


@query()
def absorbed_slivers(spark, d):
    """Shapes under three cells join the neighbour of their longest common side; held against brute force in the tests."""
    return shapes.absorb_slivers(shapes.cut_overlaps(_cells(spark, d), "shape"), "shape", 3)


@query()
def free_ground(spark, d):
    """New shapes where finished orders lie on no shape; held against brute force in the tests."""
    wanted = table(spark, d, "orders").select(F.floor(F.col("o_orderkey") / 100).cast("int").alias("row"), (F.col("o_orderkey") % 100).cast("int").alias("col"))
    return shapes.free_ground(wanted, _cells(spark, d), 3)
