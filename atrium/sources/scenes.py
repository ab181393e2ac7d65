"""Readers of raw scene folders: objects, rooms, walls, portals and height bounds, one row per entity.

A scene is a folder with labels.json, and structure.json and occupancy.json beside it. Files are read
with explicit schemas, malformed entries are left out, and the folder's name is the scene's id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from atrium.functions.labels import STRUCTURAL

POINT = "struct<x:double,y:double,z:double>"
LABELS = f"ins_id string, label string, bounding_box array<{POINT}>, front_normal array<double>, label_side string, label_face_text string"
OUTLINE = "array<array<double>>"
ROOM = f"struct<id:string,profile:{OUTLINE},polygon:{OUTLINE},vertices:{OUTLINE},contour:{OUTLINE}>"
WALL = f"struct<location:{OUTLINE},thickness:double,height:double>"
HOLE = f"struct<type:string,thickness:double,profile:{OUTLINE}>"
DOOR = f"struct<id:string,type:string,location:{OUTLINE},width:double,height:double,room_a:string,room_b:string>"
STRUCTURE = f"rooms array<{ROOM}>, walls array<{WALL}>, holes array<{HOLE}>, doors array<{DOOR}>"
#: Defaults of walls and the least size of an opening: fixed values.
THICKNESS, HEIGHT = 0.2, 2.8
LEAST_WIDTH, LEAST_HEIGHT = 0.10, 1.0


def scene_id() -> Column:
    return F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1)


def read_json(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    """Each scene's file of that name, of the folder itself or of its children."""
    return spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", name).json(folder)


def read_scenes(spark: SparkSession, folder: str) -> DataFrame:
    return read_json(spark, folder, "labels.json", LABELS).select(scene_id().alias("scene_id")).distinct()


def read_objects(spark: SparkSession, folder: str, structural: tuple[str, ...] = STRUCTURAL) -> DataFrame:
    """Boxes from corner points; structural labels and entries with fewer than eight corners are left out."""
    raw = read_json(spark, folder, "labels.json", LABELS).select(scene_id().alias("scene_id"), "*")
    side = lambda f, a: f(F.transform("bounding_box", lambda p: p[a]))
    kept = raw.where((F.size("bounding_box") >= 8) & F.col("label").isNotNull()).withColumn("label", F.lower("label"))
    boxes = [side(f, a).alias(f"{n}_{a}") for a in "xyz" for n, f in (("min", F.array_min), ("max", F.array_max))]
    return kept.where(~F.col("label").isin(*structural)).select("scene_id", F.col("ins_id").alias("object_id"), "label", *boxes, "front_normal", "label_side", "label_face_text")


def read_rooms(spark: SparkSession, folder: str) -> DataFrame:
    """Outlines of at least three points, under whichever key they stand; unnamed rooms are r0, r1 ..."""
    raw = read_json(spark, folder, "structure.json", STRUCTURE).select(scene_id().alias("scene_id"), F.posexplode("rooms").alias("room_idx", "r"))
    outline = F.coalesce("r.profile", "r.polygon", "r.vertices", "r.contour")
    poly = F.transform(outline, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    return raw.where(F.size(outline) >= 3).select("scene_id", F.coalesce("r.id", F.concat(F.lit("r"), F.col("room_idx").cast("string"))).alias("room_id"), "room_idx", poly.alias("poly"))


def read_walls(spark: SparkSession, folder: str) -> DataFrame:
    """Walls as boxes: the segment widened by half its thickness along its shorter side; a point becomes a square."""
    raw = read_json(spark, folder, "structure.json", STRUCTURE).select(scene_id().alias("scene_id"), F.posexplode("walls").alias("i", "w"))
    at = lambda n, axis: F.get(F.get("w.location", F.lit(n)), F.lit(axis))
    half = F.coalesce("w.thickness", F.lit(THICKNESS)) / 2
    dx, dy = F.abs(at(1, 0) - at(0, 0)), F.abs(at(1, 1) - at(0, 1))
    none = (dx == 0) & (dy == 0)
    wide_x, wide_y = F.when(none | (dy > dx), half).otherwise(F.lit(0.0)), F.when(none | (dx >= dy), half).otherwise(F.lit(0.0))
    return raw.where(F.size("w.location") >= 2).select(
        "scene_id", F.concat(F.lit("wall_"), F.col("i").cast("string")).alias("object_id"), F.lit("wall").alias("label"),
        (F.least(at(0, 0), at(1, 0)) - wide_x).alias("min_x"), (F.greatest(at(0, 0), at(1, 0)) + wide_x).alias("max_x"),
        (F.least(at(0, 1), at(1, 1)) - wide_y).alias("min_y"), (F.greatest(at(0, 1), at(1, 1)) + wide_y).alias("max_y"),
        F.lit(0.0).alias("min_z"), F.coalesce("w.height", F.lit(HEIGHT)).alias("max_z"),
    )


def read_portals(spark: SparkSession, folder: str) -> DataFrame:
    """Openings of both schemas, doors and holes with an outline; too narrow or too low ones are left out."""
    raw = read_json(spark, folder, "structure.json", STRUCTURE).select(scene_id().alias("scene_id"), "doors", "holes")
    d = raw.select("scene_id", F.posexplode("doors").alias("i", "d"))
    mid = lambda p, axis: F.aggregate(p, F.lit(0.0), lambda s, x: s + x[axis]) / F.size(p)
    doors = d.select("scene_id", F.coalesce("d.id", F.concat(F.lit("door_"), F.col("i").cast("string"))).alias("portal_id"), F.coalesce(F.upper("d.type"), F.lit("DOOR")).alias("type"), mid(F.col("d.location"), 0).alias("x"), mid(F.col("d.location"), 1).alias("y"), F.col("d.width").alias("width"), F.col("d.height").alias("height"), F.col("d.room_a").alias("room_a"), F.col("d.room_b").alias("room_b"))
    h = raw.select("scene_id", F.posexplode("holes").alias("i", "h"))
    span = lambda axis: F.array_max(F.transform("h.profile", lambda p: p[axis])) - F.array_min(F.transform("h.profile", lambda p: p[axis]))
    holes = h.where(F.size("h.profile") >= 3).select("scene_id", F.concat(F.lit("hole_"), F.col("i").cast("string")).alias("portal_id"), F.upper("h.type").alias("type"), mid(F.col("h.profile"), 0).alias("x"), mid(F.col("h.profile"), 1).alias("y"), F.greatest(span(0), span(1)).alias("width"), span(2).alias("height"))
    return doors.unionByName(holes, allowMissingColumns=True).where((F.col("width") >= LEAST_WIDTH) & (F.col("height") >= LEAST_HEIGHT))


def read_bounds(spark: SparkSession, folder: str) -> DataFrame:
    raw = read_json(spark, folder, "occupancy.json", "lower array<double>, upper array<double>, min array<double>, max array<double>")
    z = lambda a, b: F.coalesce(F.get(a, F.lit(2)), F.get(b, F.lit(2)))
    return raw.select(scene_id().alias("scene_id"), z("lower", "min").alias("min_z"), z("upper", "max").alias("max_z"))
