"""Name-literal pairs of source and configuration texts, for operator 10.

One pass over the text finds, outside other strings:

* assignments, mappings and key-value lines: ``a.b = "x"``, ``"k": 'x'``, ``k: T = x``, ``export K=x``, ``k := x``,
  ``k => x``, subscripts as names (``os.environ["K"] = "x"``), attributes of tags;
* calls that set: ``set_pwd("x")``, ``with_token("x")``, and calls whose first arguments are a name and a literal
  (``put("pwd", "x")``);
* elements (``<pwd>x</pwd>``) and a key or name next to its value (``name: K`` / ``value: x``).

A value is a string in any quotes (escapes, prefixes, triple quotes, templates with placeholders), strings joined by
``+``, ``.``, ``..``, ``&`` or nothing, the arguments of a call, a word without quotes, a YAML block, or any of these
on the line after the operator.  Names inside a value are references.

Every pattern is possessive and reads on where it stopped, and a quote that opens no string is never tried twice,
so the pass is linear in the text.
"""

from __future__ import annotations

import re
from typing import NamedTuple


class Pair(NamedTuple):
    name: str
    value: str
    start: int
    end: int
    argument: bool  # of a call, where a string may also be a name


_PATH = r"[A-Za-z_][\w-]*+(?:(?:\.|->|::)[\w-]++)*+"
#: A string opens where no word or backslash stands before it; an apostrophe between letters closes none.
_STRING = (
    r"""(?<![\w\\])(?:[rbfuRBFU]{1,2}(?=["'])|[@$](?="))?+(?:"""
    r'''"""(?P<t1>(?:[^"\\]++|\\.|"(?!""))*+)"""|'''
    r"""'''(?P<t2>(?:[^'\\]++|\\.|'(?!''))*+)'''|"""
    r'''"(?P<dq>(?:[^"\\\n]++|\\.)*+)"|'''
    r"""'(?P<sq>(?:[^'\\\n]++|\\.|(?<=\w)'(?=\w))*+)'|"""
    r"""`(?P<bt>(?:[^`\\]++|\\.)*+)`)""")
_OPERATOR = r"(?::=|=>|=(?![=~>])|:(?!:))"
_FLAGS = re.ASCII | re.DOTALL

#: What the pass stops at or steps over, in this order.
_NEXT = re.compile(
    r"(?:[A-Za-z]++[ ,]++(?=[A-Za-z]))++|"
    rf"""(?<![\w.-])(?:(?P<quote>["'])(?P<key>[\w.$-]++)(?P=quote)|"""
    rf"""(?P<name>{_PATH}(?P<index>(?:\[[ ]*+["']?[\w.-]*+["']?[ ]*+\])*+)))(?P<type>\?|!)?\s*+{_OPERATOR}|"""
    rf"(?P<call>(?<![\w.-]){_PATH})(?=\()|"
    rf"{_STRING}|"
    r"<(?P<tag>[A-Za-z_][\w.:-]*+)(?P<attributes>(?:\s[^<>]*+)?)>(?P<body>[^<>]*+)</(?P=tag)\s*+>|"
    r"\w[\w.-]*+", _FLAGS)

#: One step of an expression.
_STEP = re.compile(
    rf"(?P<blank>[ \t]++)|(?P<newline>\\?\r?\n)|(?P<new>(?:new|await|return)[ \t]++(?=[A-Za-z_\"'`]))|{_STRING}|"
    rf"(?P<dollar>\$(?:\{{\w++\}}|\w++)(?![\w+/=-]))|"
    rf"(?P<ref>{_PATH})(?![\w+/=~!@#$-])(?P<open>\()?|(?P<bare>[\w+/=.~!@#$%^*-]{{8,}})|"
    r"(?P<group>\()|(?P<close>\))|(?P<comma>,)|(?P<join>\+|\.\.?|&)", _FLAGS)
_STRINGS = ("t1", "t2", "dq", "sq", "bt")
_MORE = re.compile(rf"\s*+{_OPERATOR}")
_BLOCK = re.compile(r"[ \t]*+[|>][+-]?\d?[+-]?[ \t]*+(?:#[^\n]*+)?\r?\n")
_BLOCK_LINE = re.compile(r"(?P<indent>[ \t]*+)(?P<text>[^\n]*+)\n?")
_ALONE = re.compile(r"[ \t]*+\r?\n(?P<indent>[ \t]*+)(?P<bare>[\w+/=.~!@#$%^*-]{8,})[ \t]*+\r?(?:\n|\Z)")
_TYPE = re.compile(rf"[ \t]*+{_PATH}(?:\[[\w., ]*+\])?+[ \t]*+=(?![=~>])", re.ASCII)
_FIRST_NAME = re.compile(rf"[ \t]*+[\"']?({_PATH})", re.ASCII)
_KEYWORD = re.compile(rf"{_PATH}=(?!=)", re.ASCII)
_QUOTES = ("'", '"', "`")
_SETTER = re.compile(r"(?:.*[.>:])?(?:set|with)(?=[A-Z_])", re.DOTALL)
_LABELS = frozenset(("key", "name"))
_INDEX = re.compile(r"[\w.-]+")


def plain(value: str, opening: str = "") -> str:
    """A literal's characters: escapes undone, placeholders left out where its opening says that it has some."""
    if "{" in value and any(c in opening for c in "fF$`"):
        value = re.sub(r"\$?\{[^{}]*\}", "", value)
    return re.sub(r"\\(.)", r"\1", value, flags=re.DOTALL) if "\\" in value else value


def _lines(text: str, start: int, end: int):
    """(value, start, end) of each line that holds something."""
    at = start
    for line in text[start:end].split("\n"):
        inner = line.strip()
        if inner:
            first = at + line.index(inner)
            yield plain(inner), first, first + len(inner)
        at += len(line) + 1


def _dotted(name: str) -> str:
    """A path with dots only: ``a->b["c"]`` is ``a.b.c``."""
    return re.sub(r"->|[^\w.-]+", ".", name).strip(".")


class _Reader:
    def __init__(self, text: str):
        self.text = text
        self.pairs: list[Pair] = []
        self.flows: list[tuple[str, str]] = []  # (reference, name that it is assigned to)
        self.label: str | None = None  # the value of the key or name just read

    def put(self, name: str | None, value: str, start: int, end: int, argument: bool = False):
        if name:
            self.pairs.append(Pair(name, value, start, end, argument))

    def expression(self, name: str | None, at: int, stop_at_line: bool = True) -> int:
        """Read the value of ``name`` at ``at``; returns where to read on."""
        text, begin = self.text, at
        run: list[tuple[str, int, int]] = []  # (value, start, end) of the strings joined so far
        # Open parentheses: [argument number, name given by the first argument] of a call, None for grouping.
        opened: list[list | None] = []
        calls: list[list] = []  # those of calls
        joined, seen, below = True, False, False  # may an operand follow; was there any; is it on a later line

        def end_run():
            if run:
                if len(run) == 1 and "\n" in text[run[0][1]:run[0][2]]:
                    values = list(_lines(text, run[0][1], run[0][2]))
                else:
                    values = [("".join(r[0] for r in run), run[0][1], run[-1][2])]
                call = opened[-1] if opened else None
                for value in values:
                    self.put(name, *value, argument=bool(calls))
                    if call and call[0] == 1 and call[1]:
                        self.put(call[1], *value)
                if call and call[0] == 0 and values and _INDEX.fullmatch(values[0][0]):
                    call[1] = values[0][0]
                run.clear()

        while m := _STEP.match(text, at):
            kind = m.lastgroup if m.lastgroup != "open" else "ref"
            if kind == "newline":
                if not (opened or joined and seen or text.startswith("\\", at) or not seen and not stop_at_line):
                    break
                below |= not seen
            elif kind in _STRINGS:
                if not (joined or run) or _MORE.match(text, m.end()) and (opened or not seen):
                    break  # a key of its own
                run.append((plain(m[kind], text[m.start():m.start(kind)]), m.start(kind), m.end(kind)))
                joined, seen = False, True
            elif kind in ("ref", "bare", "dollar"):
                if not joined or below and not seen and not opened and not m["open"]:
                    break
                if kind == "bare" and _KEYWORD.match(text, at) and (opened or text[m.end():m.end() + 1] in _QUOTES):
                    break  # the name of the next pair
                if kind == "ref":
                    if _MORE.match(text, m.end()) and not m["open"]:
                        if not opened and name:
                            self.flows.append((_dotted(m["ref"]), name))
                        break  # the name of the next pair
                    if m["open"]:
                        calls.append([0, None])
                        opened.append(calls[-1])
                        seen = True
                        at = m.end()
                        continue
                if kind != "bare" and name:
                    self.flows.append((_dotted(m[kind].strip("${}")), name))
                if kind != "dollar" and not seen and len(m[kind]) >= 8:
                    self.put(name, m[kind], m.start(kind), m.end(kind))
                joined, seen = False, True
            elif kind == "group":
                if not joined:
                    break
                opened.append(None)
            elif kind == "close":
                if not opened:
                    break
                end_run()
                if opened.pop():
                    calls.pop()
                joined = False
            elif kind == "comma":
                if not opened:
                    break
                end_run()
                if opened[-1]:
                    opened[-1][0] += 1
                joined = True
            elif kind == "join":
                if not seen:
                    break
                joined = True
            at = m.end()
        end_run()
        return max(at, begin)

    def value(self, name: str, at: int) -> int:
        text = self.text
        if m := _BLOCK.match(text, at):
            line = text.rfind("\n", 0, at) + 1
            outer, at = _BLOCK_LINE.match(text, line)["indent"], m.end()
            while at < len(text):
                row = _BLOCK_LINE.match(text, at)
                if row["text"].strip():
                    if len(row["indent"]) <= len(outer):
                        break
                    for found in _lines(text, row.start("text"), row.end("text")):
                        self.put(name, *found)
                at = row.end()
            return at
        if m := _ALONE.match(text, at):
            line = text.rfind("\n", 0, at) + 1
            if len(m["indent"]) > len(_BLOCK_LINE.match(text, line)["indent"]):
                self.put(name, m["bare"], m.start("bare"), m.end("bare"))
                return m.end("bare")
        first, begin = len(self.pairs), at
        at = self.expression(name, at, stop_at_line=False)
        word = name.rsplit(".", 1)[-1].lower()
        if word == "value" and self.label:
            for pair in self.pairs[first:]:
                self.put(self.label, *pair[1:])
        self.label = None
        if word in _LABELS:
            if len(self.pairs) > first:
                self.label = self.pairs[-1].value
            elif m := _FIRST_NAME.match(text, begin):
                self.label = m[1]
        return at

    def read(self):
        text, at = self.text, 0
        while m := _NEXT.search(text, at):
            at = m.end()
            if m["key"] or m["name"]:
                if text[at - 1] == ":" and (typed := _TYPE.match(text, at)):
                    at = typed.end()
                at = max(self.value(m["key"] or _dotted(m["name"]), at), at)
            elif m["call"]:
                name = _dotted(m["call"]) if _SETTER.match(m["call"]) else None
                at = max(self.expression(name, m.start("call")), at)
            elif m["tag"]:
                for found in _lines(text, m.start("body"), m.end("body")):
                    self.put(m["tag"], *found)
                    if label := re.search(r"""\s(?:key|name)\s*=\s*["']([\w.-]+)""", m["attributes"]):
                        self.put(label[1], *found)
                at = m.end("tag")
        return self.pairs, self.flows


def assignments(text: str) -> tuple[list[Pair], list[tuple[str, str]]]:
    """(pairs of names and literals in the order of the text, (reference, assigned name) pairs)."""
    return _Reader(text).read()
