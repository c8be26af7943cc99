"""Typed job arguments.

The original jobs take predicates, aggregates, group keys and join steps as
free text on the command line. Here they are small dataclasses; text is still
accepted where a Spark SQL expression is natural (``F.expr`` per fragment, never
a spliced statement).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import Union

from pyspark.sql import Column

Expr = Union[str, Column]

# Join types reachable through the free-text ``how`` argument, with Spark's
# spellings folded onto one name each.
JOIN_TYPES = {
    "inner": "inner",
    "cross": "cross",
    "left": "left",
    "leftouter": "left",
    "left_outer": "left",
    "right": "right",
    "rightouter": "right",
    "right_outer": "right",
    "full": "full",
    "outer": "full",
    "fullouter": "full",
    "full_outer": "full",
    "semi": "left_semi",
    "leftsemi": "left_semi",
    "left_semi": "left_semi",
    "anti": "left_anti",
    "leftanti": "left_anti",
    "left_anti": "left_anti",
}


def normalize_how(how: str) -> str:
    key = how.strip().lower()
    if key not in JOIN_TYPES:
        raise ValueError(
            f"unsupported join type {how!r}; expected one of {sorted(set(JOIN_TYPES))}"
        )
    return JOIN_TYPES[key]


@dataclass(frozen=True)
class JoinStep:
    """Join list entry ``left`` with entry ``right`` on column ``on``.

    Results are appended to the list, so a later step can address them by
    index (n tables → first result is index n).
    """

    left: int
    right: int
    on: str
    how: str = "inner"

    @classmethod
    def parse(cls, text: str) -> "JoinStep":
        """Accept the ``"left right column how"`` form of the original jobs."""
        parts = text.split()
        if len(parts) not in (3, 4):
            raise ValueError(f"join step needs 'left right column [how]', got {text!r}")
        how = parts[3] if len(parts) == 4 else "inner"
        return cls(int(parts[0]), int(parts[1]), parts[2], how)


@dataclass(frozen=True)
class AggSpec:
    """One grouped aggregate: ``SELECT keys, aggs FROM df WHERE where GROUP BY keys HAVING having``."""

    keys: tuple[Expr, ...]
    aggs: tuple[Expr, ...]
    where: Expr | None = None
    having: Expr | None = None
    name: str = "agg"

    @classmethod
    def of(cls, keys, aggs, where=None, having=None, name="agg") -> "AggSpec":
        return cls(_as_tuple(keys), _as_tuple(aggs), where or None, having or None, name)


def split_list(text: str) -> list[str]:
    """Split ``"a, upper(b), c"`` at top-level commas (not inside () or quotes)."""
    out, depth, quote, cur = [], 0, None, []
    for ch in text:
        if quote:
            cur.append(ch)
            if ch == quote:
                quote = None
            continue
        if ch in "'\"`":
            quote = ch
        elif ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        elif ch == "," and depth == 0:
            out.append("".join(cur).strip())
            cur = []
            continue
        cur.append(ch)
    if "".join(cur).strip():
        out.append("".join(cur).strip())
    return out


def _call(text: str, names: str) -> tuple[str, str] | None:
    """(function, arguments) if ``text`` is one call of one of ``names`` and nothing else."""
    m = re.fullmatch(rf"({names})\s*\((.*)\)", text.strip(), re.I | re.S)
    if not m:
        return None
    depth = 0
    for ch in m[2]:
        depth += (ch == "(") - (ch == ")")
        if depth < 0:  # the last parenthesis closes another call
            return None
    return m[1].lower(), m[2]


@dataclass(frozen=True)
class Measure:
    """One aggregate of one row expression: ``fn(input)``, optionally rounded.

    What the jobs' aggregates are (count, sum, rounded avg). Unlike free text
    its input is known, so it can be limited to some of the rows.
    """

    fn: str
    input: str
    digits: int | None = None
    distinct: bool = False

    FUNCTIONS = "count|sum|avg|mean|min|max"

    @classmethod
    def parse(cls, text: Expr) -> "Measure | None":
        """The measure that a text like ``round(avg(x), 2) AS y`` states, or None."""
        if not isinstance(text, str):
            return None
        body = re.sub(r"\s+AS\s+(\w+|`[^`]+`)\s*$", "", text.strip(), flags=re.I)
        digits = None
        if rounded := _call(body, "round"):
            parts = split_list(rounded[1])
            if len(parts) != 2 or not re.fullmatch(r"\d+", parts[1]):
                return None
            body, digits = parts[0], int(parts[1])
        call = _call(body, cls.FUNCTIONS)
        if not call or len(split_list(call[1])) != 1:
            return None
        inner = call[1].strip()
        distinct = re.match(r"distinct\b(.*)", inner, re.I | re.S)
        inner = distinct[1].strip() if distinct else inner
        return cls(call[0], "1" if inner == "*" else inner, digits, bool(distinct))

    def sql(self, guard: str | None = None) -> str:
        """The aggregate over the rows for which ``guard`` holds; of the others no
        input is evaluated."""
        value = f"CASE WHEN {guard} THEN ({self.input}) END" if guard else self.input
        out = f"{self.fn}({'DISTINCT ' if self.distinct else ''}{value})"
        return out if self.digits is None else f"round({out}, {self.digits})"


@dataclass(frozen=True)
class JdbcConf:
    """Connection to one relational database.

    ``password_env`` names an environment variable; secrets never live in code
    or on the command line.
    """

    rdbms: str
    database: str
    host: str = "localhost"
    port: int | None = None
    user: str | None = None
    password_env: str | None = None
    url: str | None = None
    extra: dict[str, str] = field(default_factory=dict)


def _as_tuple(value) -> tuple:
    if value is None:
        return ()
    if isinstance(value, (str, Column)):
        return (value,)
    return tuple(value)
