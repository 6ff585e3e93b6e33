"""Imports, functions and calls of source files, and comment shares, each by language."""

from __future__ import annotations

import ast
import io
import re
import tokenize

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions import text as T

#: Import statements by language.
IMPORT_PATTERNS = {
    "c": r'(?m)^[ \t]*#[ \t]*include[ \t]*["<]([^">]+)[">]',
    "javascript": r"""(?m)(?:\bfrom\s+|\brequire\(\s*|^\s*import\s+)['"]([^'"]+)['"]""",
    "go": r'(?m)^\s*(?:import\s+)?(?:[\w.]+\s+)?"([^"]+)"\s*$',
}
SAME_AS = {"c++": "c", "cpp": "c", "typescript": "javascript", "tsx": "javascript", "vue": "javascript", "ts": "javascript", "js": "javascript"}
LEAST_BYTES, MOST_BYTES, LEAST_LINES = 10, 10_000, 3


def python_imports(source: str) -> list[str]:
    """Modules that a file imports; none if it does not parse."""
    try:
        tree = ast.parse(source)
    except (SyntaxError, ValueError, RecursionError):
        return []
    out: list[str] = []
    for node in ast.walk(tree):
        if isinstance(node, ast.Import):
            out += [a.name for a in node.names]
        elif isinstance(node, ast.ImportFrom):
            out.append("." * node.level + (node.module or ""))
    return list(dict.fromkeys(x for x in out if x))


def imports(source: Column | str, lang: Column | str) -> Column:
    """Imported names of a file: by syntax tree for Python, by pattern for C, C++, JavaScript, TypeScript and Go."""

    @F.pandas_udf("array<string>")
    def found(sources: pd.Series, langs: pd.Series) -> pd.Series:
        out = []
        for s, name in zip(sources, langs):
            name = (name or "").lower()
            name = SAME_AS.get(name, name)
            if not s:
                out.append([])
            elif name == "python":
                out.append(python_imports(s))
            else:
                out.append(list(dict.fromkeys(re.findall(IMPORT_PATTERNS[name], s))) if name in IMPORT_PATTERNS else [])
        return pd.Series(out, dtype=object)

    return found(T.col(source), T.col(lang))


def with_sibling_sources(names: Column) -> Column:
    """C and C++ headers also bring the source file of their name."""
    def more(n: Column) -> Column:
        stem = F.regexp_replace(n, r"\.(h|hpp)$", "")
        return F.when(F.endswith(n, F.lit(".hpp")), F.array(n, F.concat(stem, F.lit(".cpp")))).when(F.endswith(n, F.lit(".h")), F.array(n, F.concat(stem, F.lit(".c")))).otherwise(F.array(n))

    return F.array_distinct(F.flatten(F.transform(names, more)))


def _called(node: ast.AST) -> list[str]:
    out = []
    for n in ast.walk(node):
        if isinstance(n, ast.Assert):
            out.append("assert")
        if isinstance(n, ast.Call):
            f = n.func
            out.append(f.id if isinstance(f, ast.Name) else f.attr if isinstance(f, ast.Attribute) else "")
    return list(dict.fromkeys(x for x in out if x))


def python_functions(source: str) -> list[dict]:
    """Functions of a file: name, signature, body and callees; private, tiny and huge ones left out, the last of a name kept."""
    try:
        tree = ast.parse(source)
    except (SyntaxError, ValueError, RecursionError):
        return []
    found = {}
    for node in ast.walk(tree):
        if isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef)) and not node.name.startswith("_"):
            body = ast.get_source_segment(source, node) or ""
            if LEAST_BYTES <= len(body.encode()) <= MOST_BYTES and body.count("\n") + 1 >= LEAST_LINES:
                signature = f"{node.name}({', '.join(a.arg for a in node.args.args)})"
                found[node.name] = {"name": node.name, "signature": signature, "body": body, "calls": [c for c in _called(node) if c != node.name]}
    return list(found.values())


def functions(source: Column | str) -> Column:
    """Functions of Python files as array<struct<name, signature, body, calls>>."""

    @F.pandas_udf("array<struct<name:string,signature:string,body:string,calls:array<string>>>")
    def found(sources: pd.Series) -> pd.Series:
        return pd.Series([python_functions(s) if s else [] for s in sources], dtype=object)

    return found(T.col(source))


def python_comment_size(source: str) -> int:
    """Characters of comments and doc strings."""
    total = 0
    try:
        for t in tokenize.generate_tokens(io.StringIO(source).readline):
            if t.type == tokenize.COMMENT:
                total += len(t.string)
        for node in ast.walk(ast.parse(source)):
            if isinstance(node, (ast.Module, ast.ClassDef, ast.FunctionDef, ast.AsyncFunctionDef)):
                total += len(ast.get_docstring(node, clean=False) or "")
    except (SyntaxError, ValueError, tokenize.TokenError, RecursionError):
        pass
    return total


_C_COMMENTS = re.compile(r"//[^\n]*|/\*.*?\*/", re.S)
_HASH_COMMENTS = re.compile(r"(?m)#[^\n]*$")


def comment_share(source: Column | str, lang: Column | str) -> Column:
    """Characters of comments over all; 0 for empty files."""

    @F.pandas_udf("double")
    def share(sources: pd.Series, langs: pd.Series) -> pd.Series:
        out = []
        for s, name in zip(sources, langs):
            if not s:
                out.append(0.0)
            elif (name or "").lower() == "python":
                out.append(python_comment_size(s) / len(s))
            else:
                pattern = _HASH_COMMENTS if (name or "").lower() in ("ruby", "perl", "shell", "r", "yaml", "makefile", "dockerfile") else _C_COMMENTS
                out.append(sum(map(len, pattern.findall(s))) / len(s))
        return pd.Series(out, dtype="float64")

    return share(T.col(source), T.col(lang))


def notebook_script(content: Column | str) -> Column:
    """The code cells of a notebook's JSON as one script; null if it is no notebook."""
    cells = F.from_json(T.col(content), "struct<cells:array<struct<cell_type:string,source:array<string>>>>")
    single = F.from_json(T.col(content), "struct<cells:array<struct<cell_type:string,source:string>>>")

    def code(of: Column) -> Column:
        return F.filter(of["cells"], lambda c: c["cell_type"] == "code")

    lists = F.transform(code(cells), lambda c: F.array_join(c["source"], ""))
    texts = F.transform(code(single), lambda c: c["source"])
    picked = F.zip_with(lists, texts, lambda a, b: F.coalesce(a, b))
    return F.array_join(F.filter(picked, lambda c: c.isNotNull() & (c != "")), "\n\n")
