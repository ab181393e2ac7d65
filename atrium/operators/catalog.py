"""The catalog of task templates as dimension tables: answers, coverage, triggers, evidence slots and their predicates.

A specification is a dictionary as its file holds it; `checks` tagged scene, init or target are merged into its
requirements, triggers and predicates, where keys that are written out already win. Specifications are few, so
their rows are made on the driver; everything that joins them is a DataFrame.
"""

from __future__ import annotations

import json
import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: The parameters of the 22 templates. A line of a template: id, answer type, choices, coverage (aggregate,
#: mode, least), most steps and move / turn of an action, trigger fields. Below it its slots, their generator and
#: [quality check], and below these their predicates. Names in arguments are bindings of an instance.
TEMPLATES = """
T01 | categorical | similar_aabb_labels | all, submit, 1.0 | 8, 0.5/45 | 
  identity_view: around_object(target=target_id, dist_min=1.0, dist_max=3.0, height_min=1.0, height_max=1.8)
    Visible(obj=target_id, min_corners=4, max_occ=0.4)
    DistanceBand(obj=target_id, d_min=1.0, d_max=3.0)
    AspectExposed(obj=target_id, min_ratio=0.3)
    Centered(obj=target_id, theta_deg=25)
    ScaleBand(obj=target_id, s_min=0.08, s_max=0.6)
T04 | categorical | pair_labels | all, submit, 1.0 | 10, 0.5/45 | min_true_volume_ratio=1.15, max_true_volume_ratio=1.5, init_apparent_size_ratio_min=0.7, init_apparent_size_ratio_max=1.4
  equidistant_pair_view: equidistant_to_pair(obj_a=obj_a_id, obj_b=obj_b_id, dist_min=0.8, dist_max=4.0, max_log_dist_ratio=0.5) [distance_balance_check]
    PairVisible(obj_a=obj_a_id, obj_b=obj_b_id, min_corners=4, max_occ=0.3)
    AspectExposed(obj=obj_a_id, min_ratio=0.25)
    AspectExposed(obj=obj_b_id, min_ratio=0.25)
    DistanceBand(obj=obj_a_id, d_min=0.8, d_max=4.0)
    DistanceBand(obj=obj_b_id, d_min=0.8, d_max=4.0)
T05 | categorical | pair_from_triple | mean, trajectory, 1.0 | 12, 0.5/45 | min_dist_ratio=1.3, max_both_pairs_visible_at_init=False
  AB_view: around_pair(obj_a=subject_id, obj_b=ref_b_id, dist_min=0.8, dist_max=4.0)
    PairVisible(obj_a=subject_id, obj_b=ref_b_id, min_corners=4, max_occ=0.3)
    Centered(obj=subject_id, theta_deg=40)
  AC_view: around_pair(obj_a=subject_id, obj_b=ref_c_id, dist_min=0.8, dist_max=4.0)
    PairVisible(obj_a=subject_id, obj_b=ref_c_id, min_corners=4, max_occ=0.3)
    Centered(obj=subject_id, theta_deg=40)
T06 | binary | binary_yes_no | mean, trajectory, 0.8 | 20, 0.3/15 | min_clearance_margin_m=-0.3, max_clearance_margin_m=0.5
  bottleneck_{i}: orthogonal_to_portal(portal=bottleneck_{i}_id, dist_min=0.4, dist_max=1.5, ortho_max_deg=15)
    Visible(obj=bottleneck_{i}_left_id, min_corners=4, max_occ=0.3)
    Visible(obj=bottleneck_{i}_right_id, min_corners=4, max_occ=0.3)
    DistanceBand(obj=bottleneck_{i}_id, d_min=0.4, d_max=1.5)
    OrthogonalToPlane(plane=bottleneck_{i}_plane, theta_max_deg=15)
    SeparationOnImage(obj_a=bottleneck_{i}_left_id, obj_b=bottleneck_{i}_right_id, s_min_frac=0.15)
T08 | binary | binary_yes_no | all, submit, 1.0 | 10, 0.5/30 | min_projection_ambiguity_deg=70, group_size_min=3, group_size_max=5
  config_view: view_breaking_projection(group=group_ids, axis_angle_min_deg=30, axis_angle_max_deg=75) [axis_view_angle_check]
    Visible(obj=member_id, min_corners=4, max_occ=0.3)
    Centered(obj=group_centroid_proxy, theta_deg=40)
T11 | categorical | count_and_arrangement | all, submit, 1.0 | 10, 0.3/30 | min_true_instance_count=2, max_init_separation_frac=0.03
  separation_view: view_with_separation(group=group_ids, target_separation_frac=0.05)
    Visible(obj=member_id, min_corners=4, max_occ=0.3)
    SeparationOnImage(obj_a=pair_a_id, obj_b=pair_b_id, s_min_frac=0.04)
    DistanceBand(obj=group_centroid_proxy, d_min=0.5, d_max=2.5)
T13 | binary | binary_continuous_separate | all, submit, 1.0 | 8, 0.5/45 | min_init_occlusion_fraction=0.5
  unoccluded_side_view: behind_front_object(front_obj=front_id, back_obj=back_id, side_angle_min_deg=30)
    Visible(obj=front_id, min_corners=4, max_occ=0.3)
    Visible(obj=back_id, min_corners=4, max_occ=0.3)
    NotBlockedBy(obj=back_id, blocker=front_id)
    SeparationOnImage(obj_a=front_id, obj_b=back_id, s_min_frac=0.04)
T14 | categorical | back_face_property_choices | all, submit, 1.0 | 10, 0.5/45 | max_init_back_angle_deg=60
  back_face_view: behind_object_face(target=target_id, face=back, side_theta_deg=45, dist_min=0.5, dist_max=2.5)
    SideView(obj=target_id, side=back, theta_deg=45)
    Visible(obj=target_id, min_corners=4, max_occ=0.2)
    DistanceBand(obj=target_id, d_min=0.5, d_max=2.5)
    Centered(obj=target_id, theta_deg=30)
T15 | categorical | label_face_choices | all, submit, 1.0 | 10, 0.5/45 | label_side_visible_at_init=False
  label_face_view: behind_object_face(target=target_id, face=label_side, side_theta_deg=40, dist_min=0.5, dist_max=2.5)
    SideView(obj=target_id, side=label_side, theta_deg=40)
    Visible(obj=target_id, min_corners=4, max_occ=0.2)
    DistanceBand(obj=target_id, d_min=0.5, d_max=2.5)
    Centered(obj=target_id, theta_deg=30)
    ScaleBand(obj=target_id, s_min=0.05, s_max=0.6)
T16 | binary | binary_same_different | mean, trajectory, 1.0 | 12, 0.5/45 | only_one_face_visible_at_init=True
  front_face_view: behind_object_face(target=target_id, face=front, side_theta_deg=45, dist_min=0.5, dist_max=2.5)
    SideView(obj=target_id, side=front, theta_deg=45)
    Visible(obj=target_id, min_corners=4, max_occ=0.2)
    DistanceBand(obj=target_id, d_min=0.5, d_max=2.5)
    Centered(obj=target_id, theta_deg=30)
  back_face_view: behind_object_face(target=target_id, face=back, side_theta_deg=45, dist_min=0.5, dist_max=2.5)
    SideView(obj=target_id, side=back, theta_deg=45)
    Visible(obj=target_id, min_corners=4, max_occ=0.2)
    DistanceBand(obj=target_id, d_min=0.5, d_max=2.5)
    Centered(obj=target_id, theta_deg=30)
T17 | binary | binary_yes_no | all, submit, 1.0 | 8, 0.5/45 | target_invisible_at_init=True, min_target_occlusion_at_init=0.7
  unoccluded_view: around_occluder_back(occluder=occluder_id, target_region=hidden_region, dist_min=0.5, dist_max=3.0) [hidden_region_visibility_check]
    NotBlockedBy(obj=occluder_id, blocker=None)
    Visible(obj=occluder_id, min_corners=2, max_occ=0.8)
T18 | categorical | similar_aabb_labels | all, submit, 1.0 | 10, 0.5/45 | target_invisible_at_init=True, min_target_occlusion_at_init=0.7
  identification_view: around_occluder_back(occluder=occluder_id, target=target_id, dist_min=0.8, dist_max=3.0)
    Visible(obj=target_id, min_corners=6, max_occ=0.2)
    NotBlockedBy(obj=target_id, blocker=occluder_id)
    DistanceBand(obj=target_id, d_min=0.8, d_max=3.0)
    AspectExposed(obj=target_id, min_ratio=0.3)
    Centered(obj=target_id, theta_deg=25)
    ScaleBand(obj=target_id, s_min=0.05, s_max=0.6)
T19 | binary | binary_complete_incomplete | all, submit, 1.0 | 10, 0.5/45 | target_invisible_at_init=True, min_target_occlusion_at_init=0.7
  full_extent_view: around_occluder_back(occluder=occluder_id, target=target_id, dist_min=0.8, dist_max=3.5)
    Visible(obj=target_id, min_corners=8, max_occ=0.1)
    NotBlockedBy(obj=target_id, blocker=occluder_id)
    DistanceBand(obj=target_id, d_min=0.8, d_max=3.5)
    ScaleBand(obj=target_id, s_min=0.06, s_max=0.7)
    AspectExposed(obj=target_id, min_ratio=0.25)
T20 | categorical | property_choices | all, submit, 1.0 | 8, 0.5/45 | target_invisible_at_init=True, bearing_hint_accuracy_deg=45
  target_in_view: bearing_sector_in_room(target=target_id, room=room_id, bearing_sector_deg=45)
    Visible(obj=target_id, min_corners=4, max_occ=0.3)
    BearingWithin(obj=target_id, theta_deg=45)
    Centered(obj=target_id, theta_deg=35)
    DistanceBand(obj=target_id, d_min=0.5, d_max=5.0)
T21 | categorical | pair_labels | all, submit, 1.0 | 10, 0.5/45 | min_dist_difference_m=0.4, min_dist_ratio=1.25, init_ordering_ambiguous=True
  comparison_view: view_of_triple(obj_a=obj_a_id, obj_b=obj_b_id, reference=reference_id, dist_min=0.8, dist_max=5.0)
    PairVisible(obj_a=obj_a_id, obj_b=obj_b_id, min_corners=4, max_occ=0.3)
    Visible(obj=reference_id, min_corners=2, max_occ=0.5)
    Centered(obj=group_centroid_proxy, theta_deg=40)
T23 | binary | binary_yes_no | all, trajectory, 1.0 | 14, 0.5/45 | rooms_count_min=2, target_invisible_from_room_a=True
  room_b_scan: inside_room(room=room_b_id, dist_from_centroid_max=5.0) [cross_room_existence_check]
    InRoom(room=room_b_id)
T24 | categorical | directional_choices | all, submit, 1.0 | 10, 0.5/45 | portal_invisible_at_init=True
  portal_in_view: near_portal_in_room_a(portal=portal_id, room_a=room_a_id, dist_min=0.5, dist_max=3.0)
    InRoom(room=room_a_id)
    BearingWithin(obj=portal_proxy_id, theta_deg=30)
    DistanceBand(obj=portal_proxy_id, d_min=0.5, d_max=3.0)
    OrthogonalToPlane(plane=portal_plane, theta_max_deg=30)
T26 | ordinal | count_range | mean, trajectory, 1.0 | 14, 0.5/45 | min_init_occluded_count=1, min_total_count=2
  hidden_instance_{i}: around_occluder_to_expose(occluder=occluder_id, target=hidden_instance_{i}_id, dist_min=0.5, dist_max=3.0)
    Visible(obj=hidden_instance_{i}_id, min_corners=4, max_occ=0.3)
    NotBlockedBy(obj=hidden_instance_{i}_id, blocker=occluder_id)
T27 | ordinal | count_range_or_zone_comparison | mean, trajectory, 1.0 | 18, 0.5/45 | min_zones=2, zones_mutually_non_visible=True, min_zones_invisible_at_init=1
  zone_a_scan: inside_room(room=zone_a_id) [zone_count_check]
    InRoom(room=zone_a_id)
  zone_b_scan: inside_room(room=zone_b_id) [zone_count_check]
    InRoom(room=zone_b_id)
T29 | categorical | contact_relations | all, submit, 1.0 | 8, 0.5/30 | max_init_lateral_angle_deg=20
  lateral_view: orthogonal_to_segment(obj_a=obj_a_id, obj_b=obj_b_id, min_lateral_angle_deg=60, dist_min=0.5, dist_max=3.0)
    PairVisible(obj_a=obj_a_id, obj_b=obj_b_id, min_corners=4, max_occ=0.3)
    OrthogonalToPlane(plane=ab_vertical_plane, theta_max_deg=30)
    DistanceBand(obj=midpoint_proxy, d_min=0.5, d_max=3.0)
    SeparationOnImage(obj_a=obj_a_id, obj_b=obj_b_id, s_min_frac=0.04)
T32 | binary | binary_yes_no | mean, trajectory, 0.8 | 20, 0.5/45 | min_rooms=3, path_portals_not_all_visible_at_init=True
  portal_{i}_facing: near_portal_facing(portal=portal_{i}_id, dist_min=0.3, dist_max=2.0)
    BearingWithin(obj=portal_{i}_proxy_id, theta_deg=30)
    DistanceBand(obj=portal_{i}_proxy_id, d_min=0.3, d_max=2.0)
    OrthogonalToPlane(plane=portal_{i}_plane, theta_max_deg=30)
T33 | binary | binary_yes_no | all, submit, 1.0 | 14, 0.3/15 | min_passage_width_m=0.5, max_passage_width_m=2.0, passage_not_orthogonally_visible_at_init=True
  orthogonal_passage_view: orthogonal_to_portal(portal=passage_id, dist_min=0.3, dist_max=2.0, ortho_max_deg=15)
    DistanceBand(obj=passage_proxy_id, d_min=0.3, d_max=2.0)
    OrthogonalToPlane(plane=passage_plane, theta_max_deg=15)
    SeparationOnImage(obj_a=left_wall_proxy, obj_b=right_wall_proxy, s_min_frac=0.1)
"""
GAMMA = 0.95
#: Arguments of predicates that are numbers, with the values where a slot gives none: fixed values.
NUMBERS = {"min_corners": {"PairVisible": 3.0, "": 4.0}, "max_occ": {"PairVisible": 0.4, "": 0.3}, "d_min": {"": 0.0}, "d_max": {"": 1e9}, "min_ratio": {"": 0.3}, "theta_deg": {"BearingWithin": 180.0, "": 25.0}, "s_min": {"": 0.05}, "s_max": {"": 0.7}, "s_min_frac": {"": 0.1}, "theta_max_deg": {"": 15.0}}
#: Arguments that name one object, the first of two, and the second: fixed values.
FIRST, SECOND = ("obj", "obj_a", "plane", "room"), ("obj_b", "blocker")


def value(text: str):
    """A number, a truth value, none, or else the text itself."""
    known = {"True": True, "False": False, "None": None}
    if text in known:
        return known[text]
    return float(text) if re.fullmatch(r"-?[0-9.]+", text) else text


def arguments(text: str) -> dict:
    return {k: value(v) for k, v in re.findall(r"(\w+)=([^,]+)", text)}


def called(text: str) -> tuple[str, dict]:
    """Name and arguments of `name(key=value, ...)`."""
    name, inside = re.fullmatch(r"(\w+)\((.*)\)", text).groups()
    return name, arguments(inside)


def parse(text: str = TEMPLATES) -> list[dict]:
    """Specifications from the short form."""
    specs: list[dict] = []
    for line in filter(str.strip, text.splitlines()):
        depth, line = len(line) - len(line.lstrip()), line.strip()
        if not depth:
            template, kind, choices, cover, steps, *trigger = (x.strip() for x in (line + " ").split(" |"))
            aggregate, mode, least = cover.split(", ")
            most, sizes = steps.split(", ")
            move, turn = sizes.split("/")
            specs.append({"template_id": template, "answer_type": kind, "answer_choices_generator": choices, "coverage_aggregator": aggregate, "coverage_mode": mode, "min_coverage_for_credit": float(least), "max_steps": int(most), "action_config": {"move_m": float(move), "turn_deg": float(turn)}, "gamma": GAMMA, "trigger": arguments(trigger[0]), "evidence_slots": []})
        elif depth == 2:
            slot, generator, quality = re.fullmatch(r"([\w{}]+): (\w+\(.*\))(?: \[(\w+)\])?", line).groups()
            name, args = called(generator)
            specs[-1]["evidence_slots"].append({"slot_id": slot, "region_generator": name, "region_args": args, "predicates": [], "threshold": 1.0, "tier2_override": quality})
        else:
            name, args = called(line)
            specs[-1]["evidence_slots"][-1]["predicates"].append({"name": name, "args": args})
    return specs


def merged(spec: dict) -> dict:
    """The specification without `checks`: each went where its `when` says, behind what is there already.

    Raises ValueError for a check without a name, with another `when`, or for a slot that doesn't exist.
    """
    slots = [dict(s, predicates=list(s.get("predicates") or [])) for s in spec.get("evidence_slots") or []]
    flat = {"scene": dict(spec.get("scene_requirements") or {}), "init": dict(spec.get("trigger") or {})}
    for check in spec.get("checks") or []:
        when, name, args = check.get("when"), check.get("name"), check.get("args", {})
        if not name:
            raise ValueError(f"{spec.get('template_id')}: a check has no name")
        if when in flat:
            flat[when].setdefault(name, args)
        elif when == "target":
            wanted = check.get("slot")
            home = next((s for s in slots if wanted is None or s.get("slot_id") == wanted), None)
            if home is None:
                raise ValueError(f"{spec.get('template_id')}: no slot {wanted} for check {name}")
            home["predicates"].append({"name": name, "args": args})
        else:
            raise ValueError(f"{spec.get('template_id')}: unknown when {when!r}")
    return {k: v for k, v in spec.items() if k != "checks"} | {"scene_requirements": flat["scene"], "trigger": flat["init"], "evidence_slots": slots}


def read_specs(folder: str) -> list[dict]:
    """Specifications of a folder's .json files, and of .yaml files where the yaml package is there; in order of their ids."""
    found = [json.loads(p.read_text(encoding="utf-8")) for p in sorted(Path(folder).rglob("*.json"))]
    if paths := sorted(Path(folder).rglob("*.yaml")):
        import yaml

        found += [yaml.safe_load(p.read_text(encoding="utf-8")) for p in paths]
    return sorted(found, key=lambda s: s["template_id"])


def plain(name: str) -> str:
    """A binding's name without the braces that files write around it."""
    return re.sub(r"^\{\{\s*|\s*\}\}$", "", name)


def tables(spark: SparkSession, specs: list[dict] | None = None) -> dict[str, DataFrame]:
    """templates, requirements, triggers, slots, regions and predicates of specifications (the 22 of this module if none are given).

    regions holds a generator's arguments, one a row: `number`, or else `name` (a binding or a word). predicates has
    the bindings of its first and second object and its numbers, with defaults filled in. A slot whose id holds {i}
    is a pattern for as many slots as an instance has (`repeat`).
    """
    rows: dict[str, list[tuple]] = {n: [] for n in SCHEMAS}
    for spec in map(merged, parse() if specs is None else specs):
        t, action = spec["template_id"], spec.get("action_config") or {}
        mode = str(spec.get("coverage_mode", "submit")).strip().lower()
        if mode not in ("submit", "trajectory"):
            raise ValueError(f"{t}: coverage_mode must be submit or trajectory")
        rows["templates"].append((t, spec.get("answer_type", "categorical"), spec.get("answer_choices_generator", ""), spec.get("coverage_aggregator", "all"), mode, float(spec.get("min_coverage_for_credit", 1.0)), int(spec.get("max_steps", 10)), float(action.get("move_m", 0.5)), float(action.get("turn_deg", 45.0)), float(spec.get("gamma", 0.95)), len(spec["evidence_slots"])))
        rows["requirements"] += [(t, k, json.dumps(v)) for k, v in spec["scene_requirements"].items()]
        rows["triggers"] += [(t, k, json.dumps(v)) for k, v in spec["trigger"].items()]
        for place, slot in enumerate(spec["evidence_slots"]):
            s = slot["slot_id"]
            rows["slots"].append((t, s, place, "{i}" in s, slot.get("region_generator", ""), float(slot.get("threshold", 1.0)), slot.get("tier2_override")))
            for k, v in (slot.get("region_args") or {}).items():
                number = isinstance(v, (int, float)) and not isinstance(v, bool)
                rows["regions"].append((t, s, k, float(v) if number else None, None if number or v is None else plain(str(v))))
            for k, p in enumerate(slot["predicates"]):
                name, args = p["name"], p.get("args") or {}
                of = lambda keys: next((plain(str(args[a])) for a in keys if args.get(a) is not None), None)  # noqa: E731, B023
                numbers = [float(args.get(n, d.get(name, d[""]))) for n, d in NUMBERS.items()]
                rows["predicates"].append((t, s, k, name, of(FIRST), of(SECOND), *numbers))
    return {n: spark.createDataFrame(r, SCHEMAS[n]) for n, r in rows.items()}


SCHEMAS = {
    "templates": "template_id string, answer_type string, choices string, aggregator string, mode string, least double, max_steps int, move_m double, turn_deg double, gamma double, n_slots int",
    "requirements": "template_id string, field string, value string",
    "triggers": "template_id string, field string, value string",
    "slots": "template_id string, slot_id string, place int, repeat boolean, generator string, threshold double, quality string",
    "regions": "template_id string, slot_id string, argument string, number double, name string",
    "predicates": "template_id string, slot_id string, pred int, predicate string, first string, second string, " + ", ".join(f"{n} double" for n in NUMBERS),
}
