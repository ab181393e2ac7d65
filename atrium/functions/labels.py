"""Labels of objects: fixed tables, and Columns that match labels with them.

Every table is a parameter of the functions that use it; the defaults are the fixed values below.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Label tables that results depend on.
STRUCTURAL = ("wall", "floor", "ceiling", "room")
#: Labels that questions leave out (structure, carpets, lights, unclear, small and numerous things, parts of sets, food).
BLACKLIST = tuple(x.strip() for x in """
wall, floor, ceiling, room, carpet, rug, chandelier, ceiling lamp, spotlight, lamp, light, downlights, wall lamp, table lamp, strip light, track light, linear lamp, decorative pendant,
other, curtain, bread, cigar, wine, fresh food, pen, medicine bottle, toiletries, chocolate, paper, book, boxed food, bagged food, medicine box, vegetable, fruit, drinks, canned food,
ice cubes, cigarette, straw, candy, chopsticks, spoon, fork, knife, lipstick, nail polish, hand cream, cosmetic bottles, makeup, jewelry, ring, earrings, bracelet, necklace, glasses, watch, key, matches,
lighter, candle, soap, toothpaste, brush, razor, perfume, medicines, business card, envelope, cd, dice, rubiks cube, toy blocks, stapler, paper clip, pushpin, eraser, ruler, pen holder, tea scoop, tea caddy,
tea clips, tea needle, chopstick holder, cup lid, bottle opener, dropper, test tube, cruet, spatula, skimmer, rolling pin, peeler, scissors, clamp, pliers, hammer, screwdriver, knife sharpener, track, power strip,
mouse pad, keyboard tray, socket, floor drain, hanging hanger combination, walnut, hazelnut, almond, pistachio, pinecone, stone, seal, crucible, stethoscope, candle snuffer, candle extinguisher,
aromatherapy, sandalwood, bow tie, gloves, laundry detergent, canned beverage, delicatessen, meat product, doughnut, dessert, biscuit, flour, paint, washing and care combination,
toiletries combination, cosmetics combination, tool combination, bottle combination, cultural items, couple, pair, set, combination, decorative painting, wall design, trappings, tray, storage rack,
wine glass, apple, pear, peach, cherry, strawberry, banana, lemon, lime, orange, kiwifruit, mango, pomegranate, red jujube, tomato, cucumber, potato, onion, garlic, chili, carrot,
chicken leg, egg, sushi, broad bean, coffee bean
""".replace("\n", " ").split(",") if x.strip())
GENERIC = ("other", "others", "object", "objects", "unknown", "misc", "miscellaneous")
FINE = ("book", "bottle", "cup", "mug", "plate", "bowl", "pen", "remote", "phone", "candle", "clock", "ornament", "fruit", "glass")
#: Groups of labels that are alike in use or look.
SEMANTIC = {
    "flat_wall_visual": ("decorative painting", "wall painting", "painting", "picture", "poster", "photo", "frame", "window", "mirror", "tv", "television", "screen", "curtain"),
    "storage": ("cabinet", "wall cabinet", "basin cabinet", "shoe cabinet", "wardrobe", "bookshelf", "bookcase", "shelf", "sideboard", "dresser", "chest of drawers", "cupboard"),
    "seating": ("chair", "armchair", "stool", "bench", "ottoman", "sofa", "couch"),
    "tables": ("table", "desk", "coffee table", "dining table", "side table", "nightstand", "bedside table"),
    "bedroom_large": ("bed", "wardrobe", "bedside table", "dresser"),
    "plants_decor": ("plant", "flowerpot", "flowers", "vase", "ornament", "trappings", "candle", "candle combination", "tray"),
    "lighting": ("lamp", "table lamp", "floor lamp", "chandelier", "downlights"),
    "appliances": ("washing machine", "washing_machine", "refrigerator", "fridge", "stove", "oven", "microwave"),
    "bathroom": ("basin", "basin cabinet", "toilet", "bathtub", "shower", "shower room partition", "shower head", "towel", "niche"),
    "small_objects": ("book", "box", "bottle", "cup", "mug", "bowl", "plate", "pan", "pot", "remote", "phone", "yarn"),
}
#: The groups whose members look alike.
APPEARANCE = {g: SEMANTIC[g] for g in ("flat_wall_visual", "storage", "seating", "tables", "plants_decor", "lighting", "bathroom")}
CONFUSABLE = {
    "cabinets": ("cabinet", "wardrobe", "bookshelf", "bookcase", "sideboard", "dresser", "piano"),
    "seats": ("chair", "armchair", "stool", "bench", "ottoman"),
    "tops": ("table", "desk", "coffee table", "dining table", "side table", "nightstand", "bedside table"),
    "couches": ("sofa", "couch", "settee", "bed", "bench"),
    "stands": ("lamp", "floor lamp", "table lamp", "vase", "plant", "flowerpot"),
}
LANDMARK = tuple(sorted({x for g in ("storage", "tables", "seating", "bedroom_large", "bathroom") for x in SEMANTIC[g]} | {"door", "pillar", "partition", "window", "tv"}))
OCCLUDERS = tuple(sorted({x for g in ("storage", "tables", "seating", "bedroom_large") for x in SEMANTIC[g]} | {"shower room partition", "curtain"}))
#: Names of rooms by the labels in them, in the order of preference.
ROOM_NAMES = {
    "master bedroom": ("bed", "wardrobe", "dresser", "bedside table", "mirror", "closet"),
    "bedroom": ("bed", "wardrobe", "dresser", "bedside table"),
    "bathroom": ("shower", "shower head", "toilet", "basin", "bathtub", "towel", "floor mold", "bidet", "niche"),
    "living room": ("sofa", "tv", "television", "floor lamp", "couch", "coffee table", "candle combination", "toy_animals", "toy animals"),
    "kitchen": ("fridge", "refrigerator", "stove", "oven", "microwave", "kitchen sink", "cupboard", "tuyere"),
    "laundry room": ("washing machine", "washing_machine", "flowerpot", "storage basket", "faucet", "basin", "laundry"),
    "hallway": ("shoe cabinet", "tuyere", "hanger", "coat rack"),
    "dining room": ("dining table", "chair", "stool"),
    "storage room": ("box", "shelf", "bookshelf", "storage"),
    "balcony": ("window", "balcony", "outdoor"),
}
OBVIOUSLY_LARGE = ("cabinet", "wardrobe", "sofa", "bed", "bookshelf", "table", "desk", "bathtub", "shower", "refrigerator", "washing machine", "dining table", "coffee table", "sideboard", "chest of drawers", "dresser")
OBVIOUSLY_SMALL = ("book", "bottle", "cup", "mug", "phone", "remote", "pen", "vase", "ornament", "fruit", "toy", "bowl", "plate", "lamp", "candle", "glass", "kettle", "clock")
MOVEABLE = (
    "sofa", "couch", "settee", "table", "coffee table", "dining table", "desk", "chair", "armchair", "stool", "bench", "wardrobe", "cabinet", "sideboard",
    "bed", "bunk bed", "bookshelf", "bookcase", "dresser", "chest of drawers", "nightstand", "bedside table", "refrigerator", "washing machine",
    "dishwasher", "dryer", "luggage", "suitcase", "trolley",
)
SUPPORTS = ("table", "desk", "coffee table", "dining table", "side table", "nightstand", "bedside table", "cabinet", "sideboard", "dresser", "chest of drawers", "shelf", "bookshelf", "bookcase", "counter", "sink")
SUPPORTED = ("lamp", "table lamp", "vase", "plant", "flowerpot", "book", "bottle", "cup", "mug", "bowl", "plate", "clock", "candle", "box", "remote", "phone", "ornament")
BESIDE = ("chair", "armchair", "stool", "bench", "ottoman", "sofa", "couch", "bed", "table", "desk", "coffee table", "dining table", "side table", "nightstand", "cabinet", "wardrobe", "dresser", "bookshelf", "bookcase", "plant", "floor lamp")
#: Pairs of groups whose members stand beside each other.
BESIDE_GROUPS = (("seating", "tables"), ("plants_decor", "tables"), ("bedroom_large", "tables"), ("bedroom_large", "storage"), ("storage", "tables"), ("seating", "seating"), ("storage", "storage"), ("tables", "tables"))
#: Groups of what an occluder of a group may hide, for counting.
HIDES = {
    "tables": ("seating", "small_objects", "plants_decor"),
    "storage": ("small_objects", "plants_decor", "storage"),
    "seating": ("small_objects", "plants_decor"),
    "bedroom_large": ("small_objects", "plants_decor", "tables"),
}
#: Widths of what passes a door, in metres.
AGENTS = {"wheelchair": 0.65, "person": 0.55, "large_box": 0.80}
#: Labels that never match the shorter name inside them.
#: Lists that templates ask for beside the groups.
MARKS = {"landmark": LANDMARK, "occluder": OCCLUDERS}
NOT_INSIDE = {"table lamp": ("table", "floor"), "floor lamp": ("table", "floor")}


def normal(label: Column) -> Column:
    return F.replace(F.lower(F.trim(F.coalesce(label, F.lit("")))), F.lit("_"), F.lit(" "))


def among(label: Column, names) -> Column:
    """The label is one of the names, without regard to case."""
    return F.lower(label).isin(*names)


def matches(label: Column, names) -> Column:
    """Some name is the label or stands in it as a word of its own, between spaces, slashes and hyphens."""
    lab, plain = normal(label), sorted({n.replace("_", " ").lower() for n in names})
    inside = "|".join(map(re.escape, plain)).replace(r"\ ", " ")
    word = lab.rlike(rf"(^|[\s/\-])({inside})($|[\s/\-])")
    for whole, hidden in NOT_INSIDE.items():
        rest = [n for n in plain if n not in hidden]
        kept = "|".join(map(re.escape, rest)).replace(r"\ ", " ")
        word = F.when(lab == whole, lab.rlike(rf"(^|[\s/\-])({kept})($|[\s/\-])") if rest else F.lit(False)).otherwise(word)
    return lab.isin(*plain) | word


def groups(label: Column, table: dict[str, tuple[str, ...]] = SEMANTIC) -> Column:
    """Names of the groups that a label matches, in order."""
    return F.filter(F.array(*(F.when(matches(label, names), F.lit(g)) for g, names in sorted(table.items()))), lambda g: g.isNotNull())


def mask(found: dict[str, Column]) -> Column:
    """One bit for each group, in the order of their names."""
    bits = (F.when(found[g], F.lit(1 << i)).otherwise(F.lit(0)) for i, g in enumerate(sorted(found)))
    return sum(bits, F.lit(0))


def bits(names, table: dict[str, tuple[str, ...]] = SEMANTIC) -> int:
    """The mask of the groups named, of those in a table."""
    return sum(1 << i for i, g in enumerate(sorted(table)) if g in names)


def with_groups(objects: DataFrame) -> DataFrame:
    """Objects with bit masks of their label's groups: g_ (semantic), ap_ (looks), cf_ (confusion) and mk_ (see MARKS).

    Labels are few: each distinct one is matched once and joined back, a null label as none of all groups.
    """
    label = F.col("label_")
    known = objects.select(F.col("label").alias("label_")).distinct().withColumns({"lab_": normal(label), "cf_": mask({g: F.coalesce(among(label, names), F.lit(False)) for g, names in CONFUSABLE.items()})})
    # What stands between spaces, slashes and hyphens in a label, one to three words long, meets the names by equality.
    parts = F.regexp_extract_all("lab_", F.lit(r"[^\s/\-]+|[\s/\-]"), F.lit(0))
    phrase = lambda at, n: F.array_join(F.slice("parts_", at, n), "")
    phrases = F.flatten(F.transform(F.sequence(F.lit(1), F.size("parts_")), lambda i: F.array(*(phrase(i, n) for n in (1, 3, 5)))))
    spoken = known.withColumn("parts_", parts).where(F.size("parts_") > 0).select("label_", "lab_", F.explode(F.array_distinct(F.array_append(phrases, F.col("lab_")))).alias("name"))
    names = objects.sparkSession.createDataFrame(names_of_groups(), "name string, g_ int, ap_ int, mk_ int")
    met = spoken.join(F.broadcast(names), "name")
    for whole, hidden in NOT_INSIDE.items():
        met = met.where((F.col("lab_") != whole) | (F.col("name") == whole) | ~F.col("name").isin(*hidden))
    found = met.groupBy("label_").agg(F.bit_or("g_").alias("g_"), F.bit_or("ap_").alias("ap_"), F.bit_or("mk_").alias("mk_"))
    table = known.select("label_", "cf_").join(found, "label_", "left").na.fill(0, ["g_", "ap_", "mk_"])
    return objects.join(table, F.col("label").eqNullSafe(label)).drop("label_")


def names_of_groups() -> list[tuple[str, int, int, int]]:
    """Each name of the tables with the masks of the semantic groups, the groups of looks and the marks that have it."""
    rows: dict[str, list[int]] = {}
    for at, table in enumerate((SEMANTIC, APPEARANCE, MARKS)):
        for group, names in table.items():
            for name in {n.replace("_", " ").lower() for n in names}:
                rows.setdefault(name, [0, 0, 0])[at] |= bits((group,), table)
    return [(n, *m) for n, m in sorted(rows.items())]


def shares(a: str, b: str) -> Column:
    """Two masks have a bit in common."""
    return F.col(a).bitwiseAND(F.col(b)) != 0


def holds(column: str, names, table: dict[str, tuple[str, ...]] = SEMANTIC) -> Column:
    """A mask has the bit of some group named."""
    return F.col(column).bitwiseAND(F.lit(bits(names, table))) != 0


def _overlap(a: str, b: str, column: str) -> Column:
    return shares(f"{a}{column}", f"{b}{column}")


def confusable(a: str = "a_", b: str = "b_") -> Column:
    """Both labels are named in one confusion group, or match one group of looks; prefixes name objects with groups."""
    return _overlap(a, b, "cf_") | _overlap(a, b, "ap_")


def comparable(a: str = "a_", b: str = "b_") -> Column:
    """Different labels of a shared group."""
    return (normal(F.col(f"{a}label")) != normal(F.col(f"{b}label"))) & _overlap(a, b, "g_")


def close(a: str = "a_", b: str = "b_") -> Column:
    """Equal labels, confusable ones, or ones of a shared group."""
    return (F.lower(f"{a}label") == F.lower(f"{b}label")) | confusable(a, b) | _overlap(a, b, "g_")
