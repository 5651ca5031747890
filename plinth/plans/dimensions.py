"""Small fixed tables of the placement dataset and the DataFrames built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Categories in their defining order with weight and relations per complexity.
CATEGORIES = [
    ("rigid", 2.0,
     ["on top of", "leaning against"],
     ["on top of", "leaning against", "hanging on", "under"]),
    ("soft", 1.5,
     ["laid over", "hanging over"],
     ["laid over", "hanging over", "wrapped around"]),
    ("penetrative", 1.0,
     ["inserted into", "pushed into"],
     ["inserted into", "pushed into"]),
    ("containment", 1.0,
     ["inside", "dropped into"],
     ["inside", "dropped into", "slid into", "plugged into", "snapped onto"]),
    ("bonded", 1.0,
     ["attached to", "taped to"],
     ["attached to", "taped to", "glued to", "pinned to", "clipped to"]),
    ("noncontact", 1.0,
     ["floating above", "floating next to"],
     ["floating above", "floating next to", "floating in front of", "floating behind",
      "floating below", "hovering above"]),
]
CATEGORY_IDS = [c[0] for c in CATEGORIES]

# Complexities and their detail levels. The prompt text of a level is our own.
COMPLEXITIES = ["simple", "complex"]
LEVELS = {"simple": ["bare", "position"], "complex": ["position", "part"]}
LEVEL_TEXT = {
    "bare": "leave the place open",
    "position": "say roughly where",
    "part": "name the part of the anchor that it touches",
}

# Phrasing kinds, contact kinds, roles, lanes, image extensions, loss counters.
PHRASINGS = ["both", "anchor", "object", "bare"]
CONTACTS = ["rest", "lean", "attach", "embed", "drape", "none"]
ROLES = ["anchor", "placed"]
LANE_OF_ROLE = {"anchor": "geo", "placed": "tex"}
ACCEPTED_IMAGES = [".png", ".jpg", ".jpeg", ".webp", ".bmp"]
PERMANENT_LOSS = ["dropped_oversize", "dropped_degenerate", "dropped_oom", "geom_failures"]

# Words a multi-word name may not carry, and verb stems a phrase may not use.
STYLE_WORDS = [
    "red", "orange", "yellow", "green", "blue", "purple", "pink", "black", "white", "brown",
    "gray", "grey", "golden", "gold", "silver", "colorful", "colourful", "striped", "spotted",
    "dark", "pale", "bright", "shiny", "rusty", "vintage", "stylized", "fancy",
]
FORCEFUL_STEMS = ["stab", "stuck", "stick", "jam", "shov", "wedg", "cram", "smash", "slam",
                  "stak", "pierc", "embed"]

# Batch sizes and limits.
SCENE_BATCH, TAG_BATCH, PUBLISH_BATCH = 20, 40, 250
PHRASE_MAX_WORDS = 15
AVOID_ANCHORS, AVOID_PLACED = 60, 40
PLACED_OFFER = 30
FILL_ROUNDS = 6


def categories(spark: SparkSession) -> DataFrame:
    """One row per category (six rows, so always safe to broadcast)."""
    rows = [(i, c[0], c[1], c[2], c[3]) for i, c in enumerate(CATEGORIES)]
    return spark.createDataFrame(
        rows, "ord int, category string, weight double, simple array<string>, complex array<string>"
    )


def kinds(spark: SparkSession) -> DataFrame:
    """The complete category x complexity grid with relations and levels (twelve rows)."""
    rows = [
        (i, c[0], c[1], k, kind, c[2] if kind == "simple" else c[3], LEVELS[kind])
        for i, c in enumerate(CATEGORIES)
        for k, kind in enumerate(COMPLEXITIES)
    ]
    return spark.createDataFrame(
        rows,
        "ord int, category string, weight double, kind_ord int, complexity string, "
        "relations array<string>, levels array<string>",
    )
