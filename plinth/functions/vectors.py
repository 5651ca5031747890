"""3-vectors, quaternions, poses and triangle geometry as Column expressions.

A vector is a tuple of three Columns and a quaternion a tuple of four (x, y, z, w), so every
formula stays a flat arithmetic expression inside whole-stage codegen: no arrays, no lambdas.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Vec = tuple[Column, Column, Column]
Quat = tuple[Column, Column, Column, Column]


def vec(prefix: str, axes: str = "xyz") -> Vec:
    return tuple(F.col(f"{prefix}{a}") for a in axes)


def literal(v) -> Vec:
    return tuple(F.lit(float(c)) for c in v)


def sub(a: Vec, b: Vec) -> Vec:
    return tuple(p - q for p, q in zip(a, b))


def add(a: Vec, b: Vec) -> Vec:
    return tuple(p + q for p, q in zip(a, b))


def scaled(a: Vec, k) -> Vec:
    return tuple(p * k for p in a)


def times(a: Vec, b: Vec) -> Vec:
    return tuple(p * q for p, q in zip(a, b))


def dot(a, b) -> Column:
    out = a[0] * b[0]
    for p, q in zip(a[1:], b[1:]):
        out = out + p * q
    return out


def cross(a: Vec, b: Vec) -> Vec:
    return (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Vec, eps: float = 1e-9) -> Vec:
    """Unit vector, null components when the length is about zero."""
    length = norm(a)
    return tuple(F.when(length > eps, c / length) for c in a)


def rotate(q: Quat, v: Vec) -> Vec:
    axis = q[:3]
    t = scaled(cross(axis, v), 2.0)
    return add(add(v, scaled(t, q[3])), cross(axis, t))


def rotation_matrix(q: Quat, k: Column) -> list[list[Column]]:
    """Rotation by unit ``q`` times ``k`` as rows of a matrix: nine products per turned point."""
    x, y, z, w = q
    return [
        [(1 - (y * y + z * z) * 2) * k, (x * y - z * w) * 2 * k, (x * z + y * w) * 2 * k],
        [(x * y + z * w) * 2 * k, (1 - (x * x + z * z) * 2) * k, (y * z - x * w) * 2 * k],
        [(x * z - y * w) * 2 * k, (y * z + x * w) * 2 * k, (1 - (x * x + y * y) * 2) * k],
    ]


def conjugate(q: Quat) -> Quat:
    return (-q[0], -q[1], -q[2], q[3])


def rotate_back(q: Quat, v: Vec) -> Vec:
    return rotate(conjugate(q), v)


def multiply(a: Quat, b: Quat) -> Quat:
    x, y, z = add(add(scaled(b[:3], a[3]), scaled(a[:3], b[3])), cross(a[:3], b[:3]))
    return (x, y, z, a[3] * b[3] - dot(a[:3], b[:3]))


def normalised(q: Quat) -> Quat:
    length = norm(q)
    length = F.when(length == 0, F.lit(1.0)).otherwise(length)
    return tuple(c / length for c in q)


def angle_degrees(q: Quat) -> Column:
    return F.degrees(2 * F.acos(F.least(F.lit(1.0), F.abs(q[3]))))


def from_euler(pitch: Column, yaw: Column, roll: Column) -> Quat:
    """Intrinsic yaw (+Y), pitch (+X), roll (+Z), in degrees."""
    def about(axis: int, degrees: Column) -> Quat:
        half = F.radians(degrees) / 2
        zero = F.lit(0.0)
        return tuple(F.sin(half) if i == axis else zero for i in range(3)) + (F.cos(half),)

    return multiply(multiply(about(1, yaw), about(0, pitch)), about(2, roll))


def apply_pose(position: Vec, rotation: Quat, scale: Vec, v: Vec) -> Vec:
    return add(rotate(rotation, times(v, scale)), position)


def undo_pose(position: Vec, rotation: Quat, scale: Vec, v: Vec) -> Vec:
    back = rotate_back(rotation, sub(v, position))
    return tuple(c / s for c, s in zip(back, scale))


def triangle_cross(a: Vec, b: Vec, c: Vec) -> Vec:
    return cross(sub(b, a), sub(c, a))


def with_closest(df: DataFrame, p: Vec, a: Vec, b: Vec, c: Vec, names: tuple[str, str] = ("_v", "_w")) -> DataFrame:
    """Adds the weights (v, w) of b and c for the point of triangle abc closest to p.

    The plane splits into seven Voronoi regions: three vertices, three edges, the face. Dot
    products and areas are columns of their own first; inlined into every region test they would
    outgrow the size limit of generated code.
    """
    ab, ac = sub(b, a), sub(c, a)
    corner = {"a": sub(p, a), "b": sub(p, b), "c": sub(p, c)}
    dots = {f"_{side}_{k}": dot(edge, v) for k, v in corner.items() for side, edge in (("ab", ab), ("ac", ac))}
    ab_a, ac_a, ab_b, ac_b, ab_c, ac_c = (F.col(n) for n in dots)
    areas = {
        "_area_a": ab_b * ac_c - ab_c * ac_b,
        "_area_b": ab_c * ac_a - ab_a * ac_c,
        "_area_c": ab_a * ac_b - ab_b * ac_a,
    }
    area_a, area_b, area_c = (F.col(n) for n in areas)
    zero, one = F.lit(0.0), F.lit(1.0)
    region = (
        F.when((ab_a <= 0) & (ac_a <= 0), "a")
        .when((ab_b >= 0) & (ac_b <= ab_b), "b")
        .when((area_c <= 0) & (ab_a >= 0) & (ab_b <= 0), "ab")
        .when((ac_c >= 0) & (ab_c <= ac_c), "c")
        .when((area_b <= 0) & (ac_a >= 0) & (ac_c <= 0), "ac")
        .when((area_a <= 0) & (ac_b - ab_b >= 0) & (ab_c - ac_c >= 0), "bc")
        .otherwise("face")
    )
    along_bc = (ac_b - ab_b) / F.nullif((ac_b - ab_b) + (ab_c - ac_c), zero)
    total = F.nullif(area_a + area_b + area_c, zero)
    at = F.col("_region")
    v = F.when(at == "b", one).when(at == "ab", ab_a / F.nullif(ab_a - ab_b, zero)).when(at == "bc", 1 - along_bc).when(
        at == "face", area_b / total).otherwise(zero)
    w = F.when(at == "c", one).when(at == "ac", ac_a / F.nullif(ac_a - ac_c, zero)).when(at == "bc", along_bc).when(
        at == "face", area_c / total).otherwise(zero)
    staged = df.withColumns(dots).withColumns(areas).withColumn("_region", region)
    return staged.withColumns(dict(zip(names, (v, w)))).drop(*dots, *areas, "_region")


def blend(a: Vec, b: Vec, c: Vec, v: Column, w: Column) -> Vec:
    return add(a, add(scaled(sub(b, a), v), scaled(sub(c, a), w)))
