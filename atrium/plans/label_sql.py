"""SQL of what labels match, for the oracles: one row per distinct label."""

from atrium.functions import labels as L


def listed(names):
    return ", ".join(f"'{n}'" for n in sorted({x.replace("_", " ") for x in names}))


def named(names):
    return ", ".join(f"'{n}'" for n in names)


def matches(names):
    """SQL over the normal label n: equal to a name, or holding it as a word of its own; lamps never match table or floor."""
    word = lambda some: f"regexp_matches(n, '(^|[ /-])({'|'.join(sorted({x.replace('_', ' ') for x in some}))})($|[ /-])')" if some else "FALSE"
    rest = [x for x in names if x not in ("table", "floor")]
    return f"(n IN ({listed(names)}) OR CASE WHEN n IN ('table lamp', 'floor lamp') THEN {word(rest)} ELSE {word(names)} END)"


def groups(table):
    return "list_filter([" + ", ".join(f"CASE WHEN {matches(names)} THEN '{g}' END" for g, names in sorted(table.items())) + "], lambda g: g IS NOT NULL)"


CF = "list_filter([" + ", ".join(f"CASE WHEN LOWER(label) IN ({named(names)}) THEN '{g}' END" for g, names in L.CONFUSABLE.items()) + "], lambda g: g IS NOT NULL)"
#: lab: every label of the objects with its groups; lp: every pair of labels with what they are to each other.
LAB = f"""lab AS (SELECT label, {groups(L.SEMANTIC)} AS g, {groups(L.APPEARANCE)} AS ap, {CF} AS cf, {matches(L.LANDMARK)} AS mark, {matches(L.OCCLUDERS)} AS occ, {matches(L.SEMANTIC['flat_wall_visual'])} AS flat,
  LOWER(label) IN ({named(L.FINE)}) AS fine FROM (SELECT DISTINCT label, lower(trim(replace(label, '_', ' '))) AS n FROM {{objects}} WHERE LOWER(label) NOT IN ({named((*L.STRUCTURAL, *L.GENERIC))}))),
lp AS (SELECT a.label AS la, b.label AS lb, a.label <> b.label AND list_has_any(a.g, b.g) AS comparable, list_has_any(a.cf, b.cf) OR list_has_any(a.ap, b.ap) AS confusable, list_has_any(a.ap, b.ap) AS alike,
  a.label = b.label OR list_has_any(a.cf, b.cf) OR list_has_any(a.ap, b.ap) OR list_has_any(a.g, b.g) AS close FROM lab a CROSS JOIN lab b)"""
