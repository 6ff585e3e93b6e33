"""Syntax trees of source files by pluggable parsers, Python's own at hand.

A parser takes a source text and gives its nodes, the whole file's first, with places in
bytes; None if it cannot parse the text. register() adds one for further languages; it must
be importable where tasks run.
"""

from __future__ import annotations

import ast
from collections.abc import Callable
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Node:
    """A syntax node: kind (statement kinds are `block`, others `inline` or `other`), type, byte places, depth."""

    kind: str
    type: str
    start: int
    end: int
    depth: int = 0
    names: tuple[str, ...] = field(default=())


Parser = Callable[[str], list[Node] | None]
_PARSERS: dict[str, Parser] = {}

#: Statements that make multi-line middles, and expressions that make inline ones.
BLOCKS = (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef, ast.If, ast.For, ast.While, ast.With, ast.Try)
INLINE = (ast.Call, ast.BinOp, ast.Compare, ast.BoolOp, ast.Subscript, ast.Dict, ast.List, ast.Return, ast.Assign)


def register(lang: str, parser: Parser) -> None:
    """Use a parser for a language's name, whatever its case; a later one takes the place of an earlier."""
    _PARSERS[lang.lower()] = parser


def parser_of(lang: str | None) -> Parser | None:
    return _PARSERS.get((lang or "").lower())


def languages() -> list[str]:
    return sorted(_PARSERS)


def python_nodes(source: str) -> list[Node] | None:
    """Nodes of a Python file in source order, outer before inner."""
    try:
        tree = ast.parse(source)
    except (SyntaxError, ValueError, RecursionError):
        return None
    starts = [0]
    for line in source.split("\n"):
        starts.append(starts[-1] + len(line.encode()) + 1)
    out, stack = [Node("other", "Module", 0, len(source.encode()))], [(n, 1) for n in ast.iter_child_nodes(tree)]
    while stack:
        node, depth = stack.pop()
        stack += [(n, depth + 1) for n in ast.iter_child_nodes(node)]
        if getattr(node, "end_lineno", None) is not None:
            kind = "block" if isinstance(node, BLOCKS) else "inline" if isinstance(node, INLINE) else "other"
            names = (node.name,) if isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)) else ()
            out.append(Node(kind, type(node).__name__, starts[node.lineno - 1] + node.col_offset, starts[node.end_lineno - 1] + node.end_col_offset, depth, names))
    return sorted(out, key=lambda n: (n.start, -n.end, n.depth))


register("python", python_nodes)
