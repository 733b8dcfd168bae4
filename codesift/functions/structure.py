"""Structure of Python sources: syntax-tree depth and cyclomatic complexity.

Spark has no expression for a syntax tree, so one Arrow-batched function parses
each text once and gives both numbers. Text that does not parse gives nulls,
and the caller falls back to built-in columns.

Complexity counts decision points after McCabe (1976), by a rule of our own. Blocks are
functions and classes of the module, also those inside its statements (``if``, ``try``
and so on), and the methods of classes. A function counts one plus its decision points;
functions, classes and lambdas within it count for themselves or not at all. A class
counts the mean of its methods, rounded down, plus one; a class without methods counts
one plus its decision points. The result is the mean over blocks and null when there is
no block.
"""

from __future__ import annotations

import ast
import warnings
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codesift.functions.text import brace_depth

_ONE_POINT = (ast.If, ast.IfExp, ast.Assert, ast.With, ast.AsyncWith)
_LOOPS = (ast.For, ast.AsyncFor, ast.While)
_FUNCTIONS = (ast.FunctionDef, ast.AsyncFunctionDef)
_SCOPES = (*_FUNCTIONS, ast.ClassDef, ast.Lambda)


def _depth(tree: ast.AST) -> int:
    depth, level = 0, [tree]
    while level:
        depth += 1
        level = [child for node in level for child in ast.iter_child_nodes(node)]
    return depth


def _points(node: ast.AST) -> int:
    if isinstance(node, _ONE_POINT):
        return 1
    if isinstance(node, _LOOPS):
        return 1 + bool(node.orelse)
    if isinstance(node, ast.comprehension):
        return 1 + len(node.ifs)
    if isinstance(node, ast.BoolOp):
        return len(node.values) - 1
    if isinstance(node, (ast.Try, ast.TryStar)):
        return len(node.handlers) + bool(node.orelse)
    if isinstance(node, ast.Match):
        return len(node.cases)
    return 0


def _within(node: ast.AST) -> Iterator[ast.AST]:
    """What stands in a node, scopes included but not entered."""
    waiting = list(ast.iter_child_nodes(node))
    while waiting:
        inner = waiting.pop()
        yield inner
        if not isinstance(inner, _SCOPES):
            waiting.extend(ast.iter_child_nodes(inner))


def _decisions(node: ast.AST) -> int:
    return sum(map(_points, _within(node)))


def _complexity(tree: ast.Module) -> float | None:
    blocks = []
    for node in _within(tree):
        if isinstance(node, _FUNCTIONS):
            blocks.append(1 + _decisions(node))
        elif isinstance(node, ast.ClassDef):
            methods = [1 + _decisions(m) for m in _within(node) if isinstance(m, _FUNCTIONS)]
            if methods:
                blocks.append(sum(methods) // len(methods) + 1)
            else:
                blocks.append(1 + _decisions(node))
            blocks.extend(methods)
    return sum(blocks) / len(blocks) if blocks else None


def measure(code: str | None) -> tuple[int | None, float | None]:
    """(syntax-tree depth, mean complexity), nulls if the text does not parse."""
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            tree = ast.parse(code or "")
        return _depth(tree), _complexity(tree)
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return None, None


_MEASURED = T.StructType([
    T.StructField("depth", T.IntegerType()), T.StructField("complexity", T.DoubleType()),
])


@F.pandas_udf(_MEASURED)
def python_structure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for codes in batches:
        measured = [measure(code) for code in codes]
        yield pd.DataFrame({
            "depth": pd.array([m[0] for m in measured], dtype="Int32"),
            "complexity": pd.array([m[1] for m in measured], dtype="Float64"),
        })


def with_structure(df: DataFrame, code: str = "code") -> DataFrame:
    """Add ``ast_depth`` (braces where the text is not Python) and ``complexity``."""
    measured = F.col("_structure")
    text: Column = F.coalesce(F.col(code), F.lit(""))
    return (
        df.withColumn("_structure", python_structure(text))
        .withColumn("ast_depth", F.coalesce(measured["depth"], brace_depth(F.col(code))))
        .withColumn("complexity", F.coalesce(measured["complexity"], F.lit(1.0)))
        .drop("_structure")
    )
