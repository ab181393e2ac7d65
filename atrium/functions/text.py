"""Text of questions and answers as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pluralize(word: Column) -> Column:
    """The English plural; words that end in s stay as they are."""
    cut = lambda n, end: F.concat(F.substring(word, F.lit(1), F.length(word) - n), F.lit(end))
    w = F.lower(word)
    return (
        F.when((word == "") | w.endswith("s"), word)
        .when(w.rlike("(x|z|ch|sh)$"), F.concat(word, F.lit("es")))
        .when(w.endswith("fe"), cut(2, "ves"))
        .when(w.endswith("f") & ~w.endswith("ff"), cut(1, "ves"))
        .when(w.rlike("[^aeiou]y$"), cut(1, "ies"))
        .otherwise(F.concat(word, F.lit("s")))
    )


def looks_plural(noun: Column) -> Column:
    n = F.lower(F.trim(F.coalesce(noun, F.lit(""))))
    return n.endswith("s") & ~n.rlike("(ss|us|is)$")


def safe_label(label: Column) -> Column:
    """A label as part of a file name."""
    return F.regexp_replace(F.trim(label), r"[^A-Za-z0-9_\-]+", "_")


def normalize_label(label: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(label, "_", " ")), " +", " "))


def ordinal(n: Column) -> Column:
    last, two = n % 10, n % 100
    suffix = F.when(two.between(11, 13), "th").when(last == 1, "st").when(last == 2, "nd").when(last == 3, "rd").otherwise("th")
    return F.concat(n.cast("string"), suffix)


def action_class(action: Column) -> Column:
    return (
        F.when(action.isin("move_forward", "move_backward"), "forward")
        .when(action.isin("turn_left", "turn_right"), "turn")
        .when(action.isin("move_left", "move_right"), "strafe")
        .otherwise("other")
    )


#: Action names and their descriptions: fixed values.
ACTION_TEXT = {
    "move_forward": "move forward",
    "move_backward": "move backward",
    "move_left": "move left",
    "move_right": "move right",
    "turn_left": "turn left",
    "turn_right": "turn right",
    "look_up": "look up",
    "look_down": "look down",
    "stop": "stop",
}


def describe_actions(actions: Column) -> Column:
    table = F.create_map(*(F.lit(x) for pair in ACTION_TEXT.items() for x in pair))
    return F.array_join(F.transform(actions, lambda a: F.coalesce(F.element_at(table, a), F.regexp_replace(a, "_", " "))), ", ")


def difficulty(steps: Column, limits: tuple[tuple[int, str], ...] = ((1, "easy"), (3, "medium"), (5, "hard")), beyond: str = "expert") -> Column:
    """The first limit that holds the steps; fixed values by default."""
    out = F.when(steps <= limits[0][0], limits[0][1])
    for most, name in limits[1:]:
        out = out.when(steps <= most, name)
    return out.otherwise(beyond)


def answer_choice(choices: Column, answer: Column) -> Column:
    at = F.array_position(choices, answer)
    return F.when(at > 0, F.char(F.lit(64) + at))


def render(template: Column, bindings: Column) -> Column:
    """Replace {name} and {{name}} by the value bound to name."""
    return F.aggregate(
        F.map_entries(bindings),
        template,
        lambda q, e: F.replace(F.replace(q, F.concat(F.lit("{{"), e["key"], F.lit("}}")), e["value"]), F.concat(F.lit("{"), e["key"], F.lit("}")), e["value"]),
    )


def text_issues(text: Column) -> Column:
    """Names of what is wrong with a question's wording: "that", an article before a plural, a generic other."""
    nouns = F.regexp_extract_all(F.lower(text), F.lit(r"(?<![a-z0-9_])an? ([a-z0-9_]+)(?![a-z0-9_])"), F.lit(1))
    word = lambda w: F.lower(text).rlike(rf"(?<![a-z0-9_]){w}(?![a-z0-9_])")
    flags = [("deictic_that", word("that")), ("article_plural", F.exists(nouns, looks_plural)), ("generic_other", word("other"))]
    return F.filter(F.array(*(F.when(flag, F.lit(name)) for name, flag in flags)), lambda x: x.isNotNull())


def clean_question(q: Column) -> Column:
    """Deictic phrases replaced, plural existential questions reworded, and articles made to fit their nouns."""
    for pattern, put in (
        (r"(?i)\bWhat type of object is that\?", "What type of object is shown here?"),
        (r"(?i)\bIs that one\b", "Is the object"),
        (r"(?i)\bIs that\b", "Is the object"),
        (r"(?i)\bthat narrow\b", "the narrow"),
        # A plural noun ends in s, and not in ss, us or is.
        (r"(?i)\bIs there\s+(?:a|an)\s+((?=[A-Za-z])[A-Za-z\-]*(?<!s|u|i)s)(?![A-Za-z\-])\b", "Are there any $1"),
        (r"(?i)\b(?:a|an)\s+((?=[A-Za-z])[A-Za-z\-]*(?<!s|u|i)s)(?![A-Za-z\-])\b", "$1"),
        (r"(?i)\b(?:a|an)\s+(?=[aeiou])(?![A-Za-z\-]*(?<!s|u|i)s(?![A-Za-z\-]))", "an "),
        (r"(?i)\b(?:a|an)\s+(?=[b-df-hj-np-tv-z])(?![A-Za-z\-]*(?<!s|u|i)s(?![A-Za-z\-]))", "a "),
    ):
        q = F.regexp_replace(q, pattern, put)
    return q


def extract_answer(said: Column) -> Column:
    """What stands behind answer in {'answer': x}, else the whole text, without outer spaces and quotes."""
    text = F.trim(said)
    inner = F.regexp_extract(text, r"""\{['"]answer['"]:\s*([^}]+)\}""", 1)
    return F.when(inner != "", F.regexp_replace(F.trim(inner), r"""^(['"])(.*)\1$""", "$2")).otherwise(text)


def compare_answers(truth: Column, said: Column, tolerance: float = 0.3) -> tuple[Column, Column]:
    """(exact, close): lists member by member within the tolerance, numbers within 0.1 and the tolerance, else texts where one holds the other."""
    a, b = extract_answer(truth), extract_answer(said)
    listed = lambda x: x.rlike(r"^[\[(].*[\])]$")
    members = lambda x: F.transform(F.split(F.regexp_replace(x, r"^[\[(]|[\])]$", ""), ","), lambda m: F.lower(F.regexp_replace(F.trim(m), r"^'|'$", "")))

    def near(x, y):
        gap = F.abs(x.try_cast("double") - y.try_cast("double"))
        return F.when(gap.isNotNull(), gap <= tolerance).otherwise(F.coalesce(x == y, F.lit(False)))

    both = listed(a) & listed(b)
    all_near = (F.size(members(a)) == F.size(members(b))) & F.forall(F.zip_with(members(a), members(b), near), lambda x: x)
    gap = F.abs(a.try_cast("double") - b.try_cast("double"))
    x, y = F.lower(F.trim(a)), F.lower(F.trim(b))
    held = F.coalesce(F.contains(x, y) | F.contains(y, x), F.lit(False))
    pick = lambda most: F.when(both, all_near).when(gap.isNotNull(), gap <= most).otherwise(held)
    return pick(0.1), pick(tolerance)
