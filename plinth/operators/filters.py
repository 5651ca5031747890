"""Row predicates, guards and small projections of the placement tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.functions import text as T
from plinth.plans import dimensions as D


def is_placed() -> Column:
    return F.col("combined_size").isNotNull()


def is_meshed() -> Column:
    return F.col("anchor_mesh").isNotNull() & F.col("placed_mesh").isNotNull()


def has_images() -> Column:
    return F.col("anchor_image").isNotNull() & F.col("placed_image").isNotNull()


def finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))


def finite_vector(values: Column, size: int = 3) -> Column:
    return F.coalesce(F.size(values) == size, F.lit(False)) & F.coalesce(F.forall(values, finite), F.lit(False))


def answer_ok(scale: Column, angles: list[Column], center: Column, contact: Column, direction: Column,
              fraction: Column) -> Column:
    """Whether a placement answer is usable."""
    tests = [finite(scale), scale > 0, *[finite(a) for a in angles], finite_vector(center),
             F.coalesce(contact.isin(D.CONTACTS), F.lit(False)), finite_vector(direction), finite(fraction)]
    out = F.lit(True)
    for test in tests:
        out = out & test
    return F.coalesce(out, F.lit(False))


def filled(*fields: Column) -> Column:
    """Every field present and non-empty."""
    out = F.lit(True)
    for field in fields:
        out = out & (F.coalesce(field, F.lit("")) != "")
    return out


def clean_tags(tags: Column, junk: Column) -> Column:
    """Known category ids without repeats, in order; junk assets get none."""
    known = F.array_distinct(F.filter(tags, lambda t: t.isin(D.CATEGORY_IDS)))
    return F.when(junk, F.array().cast("array<string>")).otherwise(known)


def clamp_resolution(value: Column) -> Column:
    """Rounded voxel resolution when it is between 4 and 128, else null."""
    n = T.js_round(value)
    return F.when(finite(value) & n.between(4, 128), n)


def one_of(value: Column, allowed: list[str], default: str | None = None) -> Column:
    return F.when(value.isin(allowed), value).otherwise(F.lit(default))


def intent_contact(override: Column, recorded: Column, previous: Column) -> Column:
    """Contact to act on: override, then recorded intent, then the last report's, then attach."""
    return F.coalesce(override, recorded, previous, F.lit("attach"))


def without_key(maps: Column, key: str) -> Column:
    """An array of maps with one optional key dropped from each."""
    return F.transform(maps, lambda m: F.map_filter(m, lambda k, _: k != key))


def reference_view(role: Column, u1: Column, u2: Column) -> tuple[Column, Column]:
    """Azimuth and elevation of a reference image: fixed for the anchor, drawn for the placed one."""
    azimuth = F.when(role == "anchor", 0).otherwise(T.js_round((u1 * 2 - 1) * 160))
    elevation = F.when(role == "anchor", 10).otherwise(T.js_round(5 + u2 * 30))
    return azimuth, elevation


def view_sentence(azimuth: Column, elevation: Column) -> Column:
    side = F.when(azimuth > 0, "right").otherwise("left")
    aim = F.when(azimuth == 0, "of the front").otherwise(
        F.concat(F.lit("turned "), F.abs(azimuth).cast("string"), F.lit(" degrees to the "), side)
    )
    return F.concat(
        F.lit("View "), aim, F.lit(", camera "), elevation.cast("string"),
        F.lit(" degrees up."),
    )


def lane(role: Column) -> Column:
    """Processing lane of a role, null for an unknown role."""
    out = F.lit(None).cast("string")
    for name, value in D.LANE_OF_ROLE.items():
        out = F.when(role == name, value).otherwise(out)
    return out


def staging(jobs: DataFrame, image: str = "image", role: str = "role") -> DataFrame:
    """Jobs with extension, lane and a verdict: ``ok``, ``image ignored`` or ``unknown role``."""
    ext = T.extension(F.col(image))
    staged = jobs.withColumn("extension", ext).withColumn("lane", lane(F.col(role)))
    verdict = F.when(~F.col("extension").isin(D.ACCEPTED_IMAGES), "image ignored").when(
        F.col("lane").isNull(), "unknown role"
    ).otherwise("ok")
    return staged.withColumn("verdict", verdict)


def changed_pose(before: Column, after: Column, eps: float = 1e-6) -> Column:
    """Whether any component of two equally long arrays differs by more than ``eps``."""
    return F.exists(F.zip_with(before, after, lambda a, b: F.abs(a - b) > eps), lambda x: x)


def close(a: Column, b: Column, eps: float = 1e-4) -> Column:
    """Elementwise agreement of two arrays of the same length."""
    near = F.forall(F.zip_with(a, b, lambda x, y: F.abs(x - y) < eps), lambda x: F.coalesce(x, F.lit(False)))
    return F.coalesce((F.size(a) == F.size(b)) & near, F.lit(False))
