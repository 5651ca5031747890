"""String, JSON, date and rounding expressions (Column in, Column out)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(text: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def words(text: Column) -> Column:
    """Non-empty white-space separated words."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def slug(name: Column) -> Column:
    """Lower case, runs of other characters to ``_``, trimmed; ``object`` when nothing is left."""
    body = F.regexp_replace(F.lower(name), "[^a-z0-9]+", "_")
    return F.coalesce(F.nullif(F.regexp_replace(body, "^_+|_+$", ""), F.lit("")), F.lit("object"))


def stem(slug_col: Column, uuid: Column) -> Column:
    return F.concat_ws("_", slug_col, uuid)


def placed_slug(anchor: Column, placed: Column) -> Column:
    """The placed role's slug, suffixed when both roles would share one file name."""
    return F.when(slug(anchor) == slug(placed), F.concat(slug(placed), F.lit("_b"))).otherwise(slug(placed))


def image_name(stem_col: Column) -> Column:
    return F.concat(stem_col, F.lit(".png"))


def uid_from_url(url: Column) -> Column:
    """The 32-hex tail of an asset URL, or null."""
    return F.nullif(F.regexp_extract(url, "([0-9a-f]{32})/?$", 1), F.lit(""))


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]*)$", 1)


def safe_dir_name(name: Column) -> Column:
    """A folder name with anything unsafe collapsed to ``_``; empty when nothing usable remains."""
    body = F.regexp_replace(strip(F.regexp_extract(name, r"([^/]*)/*$", 1)), r"[^a-zA-Z0-9._-]+", "_")
    return F.when(body.isin(".", ".."), F.lit("")).otherwise(body)


def asset_base(name: Column) -> Column:
    """File name without a mesh extension, unsafe runs to ``_``; ``asset`` when empty."""
    body = F.regexp_replace(base_name(name), r"(?i)\.(glb|gltf)$", "")
    return F.coalesce(F.nullif(F.regexp_replace(body, r"[^a-zA-Z0-9._-]+", "_"), F.lit("")), F.lit("asset"))


def is_corpus_name(name: Column) -> Column:
    return name.rlike(r"^generated[A-Za-z0-9._-]*$")


def is_model_id(name: Column) -> Column:
    return name.rlike(r"^[~A-Za-z0-9_.:/-]{1,128}$")


def key_of_file(path: Column) -> Column:
    """Delivery key: the file stem's text after the last ``__``."""
    stem_col = F.regexp_replace(base_name(path), r"\.[^.]*$", "")
    return F.element_at(F.split(stem_col, "__"), -1)


def extension(path: Column) -> Column:
    """Lower-cased extension with its dot, empty when there is none."""
    return F.lower(F.regexp_extract(base_name(path), r".(\.[^.]*)$", 1))


def pad_id(number: Column, width: int = 4, prefix: str = "sample_") -> Column:
    """Zero-padded id; longer numbers keep all their digits."""
    text = number.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0")))


def dashed_stamp(ts: Column) -> Column:
    """ISO stamp with ``:`` and ``.`` replaced by ``-``, so that text order is time order."""
    return F.regexp_replace(iso_stamp(ts), "[:.]", "-")


def iso_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def from_dashed(stamp: Column) -> Column:
    """Inverse of ``dashed_stamp`` (zone-free timestamp), null when the text does not fit."""
    iso = F.regexp_replace(stamp, r"^(\d{4}-\d\d-\d\dT\d\d)-(\d\d)-(\d\d)-(\d{3})Z$", "$1:$2:$3.$4")
    return F.try_to_timestamp(iso, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSS")).cast("timestamp_ntz")


def fixed(value: Column, digits: int = 6) -> Column:
    """Rounded double without negative zero."""
    return F.round(value, digits) + F.lit(0.0)


def md5_order(seed: str, key: Column) -> Column:
    """Seeded pseudo-random sort key that every SQL engine can reproduce."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def md5_uniform(seed: str, key: Column) -> Column:
    """Seeded uniform draw in [0, 1) from the first 32 bits of the digest."""
    return F.conv(F.substring(md5_order(seed, key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def plain_number(value: Column, digits: int = 6) -> Column:
    """Decimal text of a double without trailing zeros."""
    return F.regexp_replace(value.cast(f"decimal(24,{digits})").cast("string"), r"\.?0+$", "")


def js_round(value: Column) -> Column:
    """Nearest integer, halves upward (also below zero)."""
    return F.floor(value + 0.5).cast("long")
