"""Expressions that know how many earlier rows they rest on.

``F`` has the functions of ``pyspark.sql.functions`` by the same names. What they return carries, beside the column,
which columns it reads and how many rows before the current one it reads them: :meth:`Series.lag` and windows add
their rows to what is inside them, everything else takes the larger of its parts. So the reach of nested calls,
quoted names and windows over windows is counted when an expression is built, and nothing is read off its text.

A plain column is taken to read every column of the series, in the current row. A typed expression inside a plain function is an error.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as plain

ANY = "*"  # a column that isn't known: whichever of the series reaches furthest


@dataclass(frozen=True)
class Frame:
    """A window that takes in ``rows`` rows before the current one."""

    spec: WindowSpec
    rows: int


class Expr:
    """A column, and the rows before the current one in which it reads others, by their names."""

    __slots__ = ("column", "needs")
    __hash__ = object.__hash__

    def __init__(self, column: Column, needs: dict[str, int]):
        self.column, self.needs = column, needs

    def __getattr__(self, method: str):
        found = getattr(self.column, method)

        def call(*args, **kwargs):
            return _built(found, args, kwargs, self.needs)

        return call if callable(found) and not isinstance(found, Column) else Expr(found, self.needs)

    def over(self, frame: Frame) -> "Expr":
        if not isinstance(frame, Frame):
            raise TypeError("windows of a series come from its window()")
        return Expr(self.column.over(frame.spec), {name: rows + frame.rows for name, rows in self.needs.items()})

    def __bool__(self):
        raise ValueError("a column has no truth value: use & | ~")

    def __iter__(self):
        raise TypeError("a column can't be iterated")

    def __repr__(self) -> str:
        return f"Expr<{self.column}, {self.needs}>"


def _operator(method: str):
    def call(self: Expr, *args):
        return _built(getattr(self.column, method), args, {}, self.needs)

    return call


for _name in (
    "add sub mul truediv mod pow radd rsub rmul rtruediv rmod rpow eq ne lt le gt ge and or rand ror invert neg getitem"
).split():
    setattr(Expr, f"__{_name}__", _operator(f"__{_name}__"))


def raw(x: Any) -> Any:
    """The plain column of an expression; anything else as it is."""
    if isinstance(x, (list, tuple)):
        return type(x)(map(raw, x))
    return x.column if isinstance(x, Expr) else x


def needs_of(x: Any) -> dict[str, int]:
    """What an argument reads. A text may name a column; if it doesn't, nothing is known by that name."""
    if isinstance(x, Expr):
        return x.needs
    if isinstance(x, Column):
        return {ANY: 0}
    if isinstance(x, str):
        return {x: 0}
    return together(*x) if isinstance(x, (list, tuple)) else {}


def together(*parts: Any) -> dict[str, int]:
    needs: dict[str, int] = {}
    for part in parts:
        for name, rows in (part if isinstance(part, dict) else needs_of(part)).items():
            needs[name] = max(rows, needs.get(name, 0))
    return needs


def _built(function, args: tuple, kwargs: dict, *more: dict[str, int]) -> Any:
    """Call a plain function on expressions; lambdas get and give expressions."""
    inside: list[dict[str, int]] = []

    def argument(x):
        if callable(x) and not isinstance(x, (Column, Expr)):
            @functools.wraps(x)
            def body(*columns):
                out = x(*[Expr(c, {}) for c in columns])
                inside.append(needs_of(out))
                return raw(out)

            return body
        return raw(x)

    out = function(*map(argument, args), **{k: argument(v) for k, v in kwargs.items()})
    return Expr(out, together(*more, *inside, *args, *kwargs.values())) if isinstance(out, Column) else out


class _Functions:
    """The functions of ``pyspark.sql.functions`` for expressions."""

    def __getattr__(self, name: str):
        function = getattr(plain, name)

        def call(*args, **kwargs):
            return _built(function, args, kwargs)

        return call

    @staticmethod
    def lit(value: Any) -> Expr:
        return value if isinstance(value, Expr) else Expr(plain.lit(value), needs_of(value) if isinstance(value, Column) else {})

    @staticmethod
    def expr(text: str) -> Expr:
        """SQL text may read any column of the series, in the current row; it holds no windows."""
        if " over " in f" {text.lower()} ".replace("(", " "):
            raise TypeError("a window in SQL text has no known reach: build it with lag(), rolling() or window()")
        return Expr(plain.expr(text), {ANY: 0})


F = _Functions()


def reach(needs: dict[str, int], known: dict[str, int]) -> int:
    """Rows before the current one, what the columns rest on themselves included."""
    return max([0, *(rows + _rests(name, known) for name, rows in needs.items())])


def _rests(name: str, known: dict[str, int]) -> int:
    if name == ANY:
        return max([0, *known.values()])
    if name in known:
        return known[name]
    bare = name.replace("`", "")
    # a field of a struct, or a name that holds dots
    return max([0, *(rows for column, rows in known.items() if bare == column or bare.startswith(f"{column}."))])
