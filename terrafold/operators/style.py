"""Style rules: reading them and matching the best rule of each entity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as S

# The order in which tag keys are tried, and the default style.
KEY_ORDER = ("highway", "railway", "aeroway", "aerialway", "waterway", "water", "natural", "landuse", "building", "amenity", "leisure", "man_made", "boundary", "admin_level", "place", "bridge", "tunnel", "surface", "layer")
DEFAULT = {"zoom": 6, "color565": 0xFFFF, "priority": 50}
#: Rule tables up to this many rows are broadcast; larger ones join by shuffle.
BROADCAST_RULES = 20000


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules of a style file: ``{"key=value" or "key": {zoom, color, priority}}``.

    Names that begin with ``_`` are comments; absent fields take the defaults;
    of repeated selectors the last one counts.
    """
    kind = "map<string,string>"
    text = spark.read.text(path, wholetext=True)
    rows = text.select(F.posexplode(F.map_entries(F.from_json("value", kind, {"mode": "PERMISSIVE"}))).alias("i", "e"))
    rows = rows.select("i", F.col("e.key").alias("selector"), F.from_json("e.value", "zoom int, color string, priority int").alias("r")).filter("selector NOT LIKE '\\\\_%'")
    rows = rows.groupBy("selector").agg(F.max_by("r", "i").alias("r"))
    key = F.split("selector", "=", 2)
    return rows.select("selector", key[0].alias("key"), F.when(F.size(key) > 1, key[1]).alias("value"), F.coalesce("r.zoom", F.lit(DEFAULT["zoom"])).alias("zoom"), F.coalesce("r.color", F.lit("#ffffff")).alias("color"), F.coalesce("r.priority", F.lit(DEFAULT["priority"])).alias("priority"))


def _sized(rules: DataFrame) -> DataFrame:
    few = rules.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES
    return F.broadcast(rules) if few else rules


def best_rule(entities: DataFrame, rules: DataFrame, id_col: str) -> DataFrame:
    """``id, selector, min_zoom, color565, priority, interesting`` for each entity with tags.

    An exact ``key=value`` rule beats every generic one; among equals the key
    that comes first in ``KEY_ORDER`` wins.  Entities without a match get the
    defaults; interesting says whether any rule names one of the tags at all.
    """
    keys = F.array(*[F.lit(k) for k in KEY_ORDER])
    rules = _sized(rules.select("selector", F.col("key").alias("rule_key"), F.col("value").alias("rule_value"), "zoom", S.hex_to_rgb565("color").alias("color565"), "priority"))
    tags = entities.select(id_col, F.explode_outer("tags").alias("key", "value"))
    met = tags.join(rules, (F.col("key") == F.col("rule_key")) & (F.col("rule_value").isNull() | (F.col("value") == F.col("rule_value"))), "left")
    rank = F.array_position(keys, F.col("key"))
    order = F.when(F.col("selector").isNotNull() & (rank > 0), F.struct(F.col("rule_value").isNull().cast("int").alias("generic"), rank.alias("rank")))
    best = met.groupBy(id_col).agg(F.min_by(F.struct("selector", "zoom", "color565", "priority"), order).alias("r"), F.count("selector").alias("hits"))
    known = F.col("r.selector").isNotNull()
    pick = lambda name, other: F.when(known, F.col(f"r.{name}")).otherwise(F.lit(other))
    return best.select(id_col, F.when(known, F.col("r.selector")).alias("selector"), pick("zoom", DEFAULT["zoom"]).cast("long").alias("min_zoom"), pick("color565", DEFAULT["color565"]).cast("long").alias("color565"), pick("priority", DEFAULT["priority"]).cast("long").alias("priority"), (F.col("hits") > 0).alias("interesting"))


def tags_of_colors(rules: DataFrame) -> DataFrame:
    """``color_hex, tags``: of each drawn color the selectors that use it, in order."""
    rules = rules.filter(F.col("color").rlike("^#[0-9A-Fa-f]{6}"))
    return rules.groupBy(S.rgb565_hex(S.hex_to_rgb565("color")).alias("color_hex")).agg(F.array_sort(F.collect_list("selector")).alias("tags"))
