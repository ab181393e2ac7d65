"""Chat formatting: a sandboxed template language compiled to Python closures.

A template is parsed into a syntax tree, constant parts are folded, and every node becomes a closure
over (scope, output). The language has `{{ expression }}`, `{% for x in y %}`, `{% if %}` with `elif`
and `else`, `{% set x = expression %}` and `{% generation %} ... {% endgeneration %}`; expressions have
literals, names, members, indexing, arithmetic, `~`, comparison, `and`, `or`, `not`, `in` and filters.
There are no calls, no access to Python attributes and no names but those given: members are looked up
in dictionaries only, and filters come from a fixed table.

`{% generation %}` marks what the loss is taken over: the output records (start, end) in code points.
"""

from __future__ import annotations

import hashlib
import itertools
import operator
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Marks turns with control strings; texts and roles are escaped, so control strings stay control strings.
DEFAULT_TEMPLATE = (
    "{% for m in messages %}{{ '<|im_start|>' ~ (m.role | escape_role) ~ '\n' }}"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}{{ '<|im_end|>' ~ '\n' }}{% endfor %}"
)
#: An opening of a control string, with any number of escapes in it.
OPENING = re.compile(r"<(\\*)\|")
ESCAPED = re.compile(r"<\\(\\*)\|")
TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)


class TemplateError(ValueError):
    """The template is malformed or asks for something outside the sandbox."""


def escape(text: str) -> str:
    """One more backslash between `<` and `|`: afterwards the text holds no `<|`."""
    return OPENING.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """As escape, on one line: line ends become `\\n`, backslashes are doubled first."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def text_of(value) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    return value if isinstance(value, str) else str(value)


FILTERS: dict[str, Callable] = {
    "escape": lambda v: escape(text_of(v)),
    "escape_role": lambda v: escape_role(text_of(v)),
    "trim": lambda v: text_of(v).strip(),
    "upper": lambda v: text_of(v).upper(),
    "lower": lambda v: text_of(v).lower(),
    "length": len,
    "string": text_of,
    "first": lambda v: v[0],
    "last": lambda v: v[-1],
}
BINARY: dict[str, Callable] = {
    "+": operator.add, "-": operator.sub, "*": operator.mul, "/": operator.truediv, "%": operator.mod,
    "~": lambda a, b: text_of(a) + text_of(b),
    "==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge,
    "in": lambda a, b: a in b,
}
LEVELS = [("in", "==", "!=", "<=", ">=", "<", ">"), ("~",), ("+", "-"), ("*", "/", "%")]
NAMES = {"true": True, "false": False, "none": None}
TOKEN = re.compile(r"\s*(?:(\d+\.\d+|\d+)|('(?:\\.|[^'\\])*'|\"(?:\\.|[^\"\\])*\")|([A-Za-z_]\w*)|(==|!=|<=|>=|[-+*/%~<>.|()\[\],=]))")
PIECE = re.compile(r"\{\{(.*?)\}\}|\{%-?(.*?)-?%\}|\{#.*?#\}", re.DOTALL)


class Expression:
    """A recursive-descent parser of one expression; nodes are tuples, constants are ("const", value)."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, object]] = []
        at, source = 0, source.rstrip()
        while at < len(source):
            m = TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"unexpected {source[at:at + 10]!r}")
            number, string, name, sign = m.groups()
            if number:
                self.tokens.append(("const", float(number) if "." in number else int(number)))
            elif string:
                self.tokens.append(("const", re.sub(r"\\(.)", lambda e: {"n": "\n", "t": "\t"}.get(e[1], e[1]), string[1:-1], flags=re.DOTALL)))
            else:
                self.tokens.append(("name", name) if name else ("sign", sign))
            at = m.end()
        self.at = 0

    def peek(self) -> tuple[str, object]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", None)

    def take(self, *values) -> object:
        kind, value = self.peek()
        if kind in ("name", "sign") and value in values:
            self.at += 1
            return value
        return None

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"expected {value!r}, found {self.peek()[1]!r}")

    def name(self) -> str:
        kind, value = self.peek()
        if kind != "name":
            raise TemplateError(f"expected a name, found {value!r}")
        self.at += 1
        return value

    def whole(self):
        node = self.either()
        if self.peek()[0] != "end":
            raise TemplateError(f"unexpected {self.peek()[1]!r}")
        return node

    def either(self):
        node = self.both()
        while self.take("or"):
            node = fold("or", node, self.both())
        return node

    def both(self):
        node = self.negated()
        while self.take("and"):
            node = fold("and", node, self.negated())
        return node

    def negated(self):
        return fold("not", self.negated()) if self.take("not") else self.level(0)

    def level(self, n: int):
        if n == len(LEVELS):
            return self.postfix()
        node = self.level(n + 1)
        while sign := self.take(*LEVELS[n]):
            node = fold("binary", sign, node, self.level(n + 1))
        return node

    def postfix(self):
        if self.take("-"):
            return fold("binary", "-", ("const", 0), self.postfix())
        node = self.atom()
        while sign := self.take(".", "[", "|"):
            if sign == ".":
                node = fold("item", node, ("const", self.name()))
            elif sign == "[":
                node = fold("item", node, self.either())
                self.need("]")
            else:
                if (name := self.name()) not in FILTERS:
                    raise TemplateError(f"no filter {name!r}")
                node = fold("filter", name, node)
        return node

    def atom(self):
        kind, value = self.peek()
        self.at += 1
        if kind == "const":
            return (kind, value)
        if kind == "name":
            return ("const", NAMES[value]) if value in NAMES else ("name", value)
        if value == "(":
            node = self.either()
            self.need(")")
            return node
        if value == "[":
            items = []
            while not self.take("]"):
                items.append(self.either())
                if not self.take(","):
                    self.need("]")
                    break
            return fold("list", *items)
        raise TemplateError(f"unexpected {value!r}")


def fold(kind: str, *parts):
    """The node, or its value as a constant if all it depends on is constant."""
    node = (kind, *parts)
    inner = [p for p in parts if isinstance(p, tuple)]
    if inner and all(p[0] == "const" for p in inner):
        try:
            return ("const", compiled(node)({}))
        except (TypeError, ValueError, LookupError, ZeroDivisionError) as wrong:
            raise TemplateError(f"{kind} on constants: {wrong}") from wrong
    return node


def compiled(node) -> Callable[[dict], object]:
    """An expression's closure over the scope."""
    kind, *parts = node
    if kind == "const":
        value = parts[0]
        return lambda scope: value
    if kind == "name":
        name = parts[0]

        def load(scope):
            if name not in scope:
                raise TemplateError(f"no name {name!r}")
            return scope[name]

        return load
    if kind == "item":
        of, key = map(compiled, parts)

        def item(scope):
            value, k = of(scope), key(scope)
            if isinstance(value, dict):
                return value.get(k)
            if isinstance(value, (list, tuple, str)) and isinstance(k, int):
                return value[k]
            raise TemplateError(f"no member {k!r}")

        return item
    if kind == "filter":
        use, of = FILTERS[parts[0]], compiled(parts[1])
        return lambda scope: use(of(scope))
    if kind == "binary":
        use, a, b = BINARY[parts[0]], compiled(parts[1]), compiled(parts[2])
        return lambda scope: use(a(scope), b(scope))
    if kind == "list":
        items = [compiled(p) for p in parts]
        return lambda scope: [i(scope) for i in items]
    if kind == "not":
        of = compiled(parts[0])
        return lambda scope: not of(scope)
    a, b = map(compiled, parts)
    if kind == "and":
        return lambda scope: a(scope) and b(scope)
    return lambda scope: a(scope) or b(scope)


class Output:
    """Pieces of text with the code-point spans written under generation marks."""

    def __init__(self):
        self.pieces: list[str] = []
        self.length, self.spans, self.begun = 0, [], None

    def write(self, piece: str) -> None:
        self.pieces.append(piece)
        self.length += len(piece)

    def begin(self) -> None:
        if self.begun is not None:
            raise TemplateError("generation inside generation")
        self.begun = self.length

    def end(self) -> None:
        self.spans.append((self.begun, self.length))
        self.begun = None


class Template:
    """A parsed and compiled template; render(scope) gives the text and the generation spans."""

    def __init__(self, source: str):
        self.queue = self._lex(source)
        self.tree = self._block(())
        if self.queue:
            raise TemplateError(f"unexpected {self.queue[0][1]!r}")
        self.write = self._statements(self.tree)

    @staticmethod
    def _lex(source: str) -> list[tuple[str, str]]:
        out, at = [], 0
        for m in PIECE.finditer(source):
            out.append(("text", source[at : m.start()]))
            if m[1] is not None:
                out.append(("expr", m[1]))
            elif m[2] is not None:
                out.append(("tag", m[2].strip()))
            at = m.end()
        return [x for x in [*out, ("text", source[at:])] if x[1]]

    def _block(self, ends: tuple[str, ...]) -> list:
        """Statements up to a tag whose word is in ends, which stays in the queue."""
        out: list = []
        while self.queue:
            kind, value = self.queue[0]
            word, _, rest = value.partition(" ") if kind == "tag" else ("", "", "")
            if word in ends:
                return out
            self.queue.pop(0)
            if kind == "text":
                self._add(out, value)
            elif kind == "expr":
                node = Expression(value).whole()
                if node[0] == "const":
                    self._add(out, text_of(node[1]))
                else:
                    out.append(("print", node))
            elif word == "for":
                m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.DOTALL)
                if not m:
                    raise TemplateError(f"malformed for: {rest!r}")
                body = self._block(("endfor",))
                self._close("endfor")
                out.append(("for", m[1], Expression(m[2]).whole(), body))
            elif word == "if":
                arms, test = [], Expression(rest).whole()
                while True:
                    arms.append((test, self._block(("elif", "else", "endif"))))
                    if not self.queue:
                        raise TemplateError("if without endif")
                    word, _, rest = self.queue.pop(0)[1].partition(" ")
                    if word == "endif":
                        break
                    test = Expression(rest).whole() if word == "elif" else ("const", True)
                self._arms(out, arms)
            elif word == "set":
                name, _, value = rest.partition("=")
                if not re.fullmatch(r"[A-Za-z_]\w*", name.strip()):
                    raise TemplateError(f"malformed set: {rest!r}")
                out.append(("set", name.strip(), Expression(value).whole()))
            elif word == "generation":
                body = self._block(("endgeneration",))
                self._close("endgeneration")
                out.append(("generation", body))
            else:
                raise TemplateError(f"no tag {word!r}")
        if ends:
            raise TemplateError(f"expected {' or '.join(ends)}")
        return out

    def _close(self, word: str) -> None:
        if not self.queue or self.queue.pop(0)[1] != word:
            raise TemplateError(f"expected {word}")

    @staticmethod
    def _add(out: list, text: str) -> None:
        """Constant text joins the constant text before it."""
        if out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + text)
        elif text:
            out.append(("text", text))

    def _arms(self, out: list, arms: list) -> None:
        """Arms that can't be reached go; a constant first arm replaces the statement."""
        kept = []
        for test, body in arms:
            if test[0] == "const" and not test[1]:
                continue
            kept.append((test, body))
            if test[0] == "const":
                break
        if kept and kept[0][0][0] == "const":
            for s in kept[0][1]:
                self._add(out, s[1]) if s[0] == "text" else out.append(s)
        elif kept:
            out.append(("if", kept))

    def _statements(self, tree: list) -> Callable[[dict, Output], None]:
        steps = [self._statement(s) for s in tree]
        if len(steps) == 1:
            return steps[0]

        def run(scope, out):
            for step in steps:
                step(scope, out)

        return run

    def _statement(self, node) -> Callable[[dict, Output], None]:
        kind, *parts = node
        if kind == "text":
            text = parts[0]
            return lambda scope, out: out.write(text)
        if kind == "print":
            value = compiled(parts[0])
            return lambda scope, out: out.write(text_of(value(scope)))
        if kind == "set":
            name, value = parts[0], compiled(parts[1])
            return lambda scope, out: scope.__setitem__(name, value(scope))
        if kind == "generation":
            body = self._statements(parts[0])

            def mark(scope, out):
                out.begin()
                body(scope, out)
                out.end()

            return mark
        if kind == "if":
            arms = [(compiled(test), self._statements(body)) for test, body in parts[0]]

            def choose(scope, out):
                for test, body in arms:
                    if test(scope):
                        return body(scope, out)

            return choose
        name, items, body = parts[0], compiled(parts[1]), self._statements(parts[2])

        def loop(scope, out):
            # Items may come one by one: only one item is looked at ahead, for loop.last.
            stream, index = iter(items(scope) or ()), 0
            inner = dict(scope)
            for item, following in pairs_ahead(stream):
                inner[name] = item
                inner["loop"] = {"index": index + 1, "index0": index, "first": index == 0, "last": following is END}
                body(inner, out)
                index += 1

        return loop

    def render(self, scope: dict) -> tuple[str, list[tuple[int, int]]]:
        out = Output()
        self.write(dict(scope), out)
        return "".join(out.pieces), out.spans


END = object()


def pairs_ahead(stream: Iterator) -> Iterator[tuple[object, object]]:
    item = next(stream, END)
    while item is not END:
        following = next(stream, END)
        yield item, following
        item = following


FORMATTED = "conv_id long, n_turns long, formatted string, spans array<struct<start:long,end:long>>"


def format_conversations(conversations: DataFrame, template: str = DEFAULT_TEMPLATE) -> DataFrame:
    """Render each conversation of (conv_id, turn, role, text) through the template.

    Returns conv_id, n_turns, formatted and spans, the generation spans in code points of formatted.
    Turns go by turn (nulls first), ties by role, then text; repeated rows are turns of their own. Null
    roles and texts are empty strings, rows with a null conv_id form one conversation. Other columns
    are ignored, and an empty table gives an empty result. Rows are dealt by conv_id and sorted inside a
    partition, and a task streams them: it holds one Arrow batch and one conversation's output.
    """
    Template(template)  # a malformed template fails here, not in a task

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        write = Template(template)

        def rows():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        out, size = [], 0
        for conv_id, turns in itertools.groupby(rows(), key=lambda r: r[0]):
            n = itertools.count()
            messages = ({"role": role, "text": text} for _, _, role, text in turns if next(n) >= 0)
            text, spans = write.render({"messages": messages})
            for _ in turns:  # a template need not read all turns
                next(n)
            out.append((conv_id, next(n), text, [{"start": a, "end": b} for a, b in spans]))
            size += len(text)
            if size > 4_000_000:
                yield formatted_batch(out)
                out, size = [], 0
        if out:
            yield formatted_batch(out)

    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text").mapInArrow(render, FORMATTED)


FORMATTED_ARROW = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def formatted_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), FORMATTED_ARROW)], schema=FORMATTED_ARROW)


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn that the default template wrote."""
    return [(unescape_role(m[1]), unescape(m[2])) for m in TURN.finditer(formatted)]


READ_BACK = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what formatted conversations hold, parsed from their text and spans alone."""

    def digest(batches):
        for batch in batches:
            out = []
            for conv_id, text, spans in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "spans"))):
                turns, loss, n = hashlib.sha256(), hashlib.sha256(), 0
                parsed = parse_turns(text)
                for role, said in parsed:
                    turns.update(f"{role}\n{said}\n".encode())
                for span in spans:
                    said = unescape(text[span["start"] : span["end"]])
                    loss.update(said.encode())
                    n += len(said)
                out.append((conv_id, len(parsed), turns.hexdigest(), n, loss.hexdigest(), len(text)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 6, READ_BACK_TYPES)], names=READ_BACK_NAMES)

    return formatted.mapInArrow(digest, READ_BACK)


READ_BACK_NAMES = [x.split()[0] for x in READ_BACK.split(", ")]
READ_BACK_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
