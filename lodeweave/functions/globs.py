"""Path patterns with * ? [] and ** as regular expressions."""

from __future__ import annotations

import re


def glob_regex(pattern: str) -> str:
    """A pattern as in ignore and attribute files, as a regular expression over a path with slashes."""
    anchored = "/" in pattern.rstrip("/") and not pattern.startswith("**/")
    body = pattern.lstrip("/")
    out, i = [], 0
    while i < len(body):
        if body.startswith("**/", i):
            out.append("(?:.*/)?")
            i += 3
        elif body.startswith("**", i):
            out.append(".*")
            i += 2
        elif body[i] == "*":
            out.append("[^/]*")
            i += 1
        elif body[i] == "?":
            out.append("[^/]")
            i += 1
        elif body[i] == "[" and "]" in body[i + 2 :]:
            end = body.index("]", i + 2)
            inner = body[i + 1 : end].replace("\\", "\\\\")
            out.append("[" + ("^" + inner[1:] if inner[0] in "!^" else inner) + "]")
            i = end + 1
        else:
            out.append(re.escape(body[i]))
            i += 1
    return ("^" if anchored else "^(?:.*/)?") + "".join(out) + "$"


def any_of(patterns: list[str]) -> str:
    """One expression for several patterns; no pattern matches nothing."""
    return "|".join(f"(?:{glob_regex(p)})" for p in patterns) or r"[^\s\S]"
