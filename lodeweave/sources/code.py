"""Facts from source files: what they define, import and call."""

from __future__ import annotations

import ast

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# what declares and imports in languages that are not parsed, one name each
DECLARES = r"(?m)^\s*(?:pub\s+)?(?:fn|func|class|struct|interface|export\s+(?:const|function))\s+(\w+)"
IMPORTS = r"(?m)^\s*(?:import|use|require)\s+[\"']?([\w.:/]+)"


def _python_facts(text: str) -> list[tuple[str, str]]:
    """(predicate, object) of a Python module; one that does not parse has none."""
    try:
        tree = ast.parse(text)
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return []
    out = set()
    for node in ast.walk(tree):
        if isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)):
            out.add(("defines", node.name))
        elif isinstance(node, ast.Import):
            out |= {("imports", a.name) for a in node.names}
        elif isinstance(node, ast.ImportFrom):
            out.add(("imports", "." * node.level + (node.module or "")))
        elif isinstance(node, ast.Call):
            callee = node.func
            if name := callee.id if isinstance(callee, ast.Name) else callee.attr if isinstance(callee, ast.Attribute) else "":
                out.add(("calls", name))
        elif isinstance(node, ast.Raise) and node.exc is not None:
            exc = node.exc.func if isinstance(node.exc, ast.Call) else node.exc
            if isinstance(exc, ast.Name):
                out.add(("raises", exc.id))
    return sorted(out)


def code_facts(files: DataFrame) -> DataFrame:
    """files(path, content) -> (path, predicate, object): Python by its syntax tree, other languages by patterns on the JVM."""

    def parse(batches):
        for batch in batches:
            rows = [(path, *fact) for path, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for fact in _python_facts(text)]
            cols = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()) for c in cols], names=["path", "predicate", "object"])

    known = files.where("path is not null and content is not null").select("path", "content")
    python = F.lower("path").endswith(".py")
    parsed = known.where(python).mapInArrow(parse, "path string, predicate string, object string")
    found = lambda predicate, pattern: known.where(~python).select("path", F.lit(predicate).alias("predicate"), F.explode(F.regexp_extract_all("content", F.lit(pattern), F.lit(1))).alias("object"))
    return parsed.unionByName(found("defines", DECLARES)).unionByName(found("imports", IMPORTS)).distinct()
