"""The scalar functions for SQL text: temporary SQL functions, which Catalyst inlines."""

from __future__ import annotations

from pyspark.sql import SparkSession

_FUNCTIONS = {
    "bbox_area(l DOUBLE, t DOUBLE, r DOUBLE, b DOUBLE)": ("DOUBLE", "(r - l + 1) * (b - t + 1)"),
    "bbox_aspect_ratio(l DOUBLE, t DOUBLE, r DOUBLE, b DOUBLE)": ("DOUBLE", "(r - l + 1) / (b - t + 1)"),
    "homography_x(x DOUBLE, y DOUBLE, h ARRAY<DOUBLE>)": ("DOUBLE", "try_divide(h[0] * x + h[1] * y + h[2], h[6] * x + h[7] * y + h[8])"),
    "homography_y(x DOUBLE, y DOUBLE, h ARRAY<DOUBLE>)": ("DOUBLE", "try_divide(h[3] * x + h[4] * y + h[5], h[6] * x + h[7] * y + h[8])"),
    "vec_dot(a ARRAY<DOUBLE>, b ARRAY<DOUBLE>)": ("DOUBLE", "aggregate(zip_with(a, b, (x, y) -> x * y), CAST(0 AS DOUBLE), (s, x) -> s + x)"),
    "cosine_half(a ARRAY<DOUBLE>, b ARRAY<DOUBLE>)": (
        "DOUBLE",
        "greatest(CAST(0 AS DOUBLE), least(CAST(4 AS DOUBLE), 2 - 2 * aggregate(zip_with(a, b, (x, y) -> x * y), CAST(0 AS DOUBLE), (s, x) -> s + x))) / 4",
    ),
    "point_in_polygon(px DOUBLE, py DOUBLE, p ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>)": (
        "BOOLEAN",
        "size(filter(zip_with(p, concat(slice(p, 2, size(p)), slice(p, 1, 1)), (a, b) -> ((a.y > py) <> (b.y > py)) AND px < (b.x - a.x) * (py - a.y) / (b.y - a.y) + a.x), c -> c)) % 2 = 1",
    ),
    "behavior_id(sensor STRING, obj STRING)": ("STRING", "concat(sensor, ' #-# ', obj)"),
}


def register(spark: SparkSession) -> None:
    """Create the functions in a session, under their names."""
    for signature, (kind, body) in _FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {kind} RETURN {body}")


def vec_sum_sql(table: str, keys: str, vector: str) -> str:
    """SQL text for the element-wise sum of a key's vectors."""
    return (
        f"SELECT {keys}, transform(array_sort(collect_list(struct(i, s))), e -> e.s) AS total FROM "
        f"(SELECT {keys}, i, sum(CAST(x AS DOUBLE)) AS s FROM {table} LATERAL VIEW posexplode({vector}) e AS i, x GROUP BY {keys}, i) GROUP BY {keys}"
    )
