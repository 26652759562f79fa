"""Registered queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from .credentials import p3_found, p3_redacted
from .handwritten import p5_found, p5_report
from .leakage import p7_found, p7_removed
from .neardup import p2_found
from .overlap import p4_found, p4_report
from .packing import p6_assignment, p6_fill
from .stuffing import p8_found

QUERIES = {"p2_found": p2_found, "p3_found": p3_found, "p3_redacted": p3_redacted, "p4_found": p4_found, "p4_report": p4_report, "p5_found": p5_found, "p5_report": p5_report, "p6_assignment": p6_assignment, "p6_fill": p6_fill, "p7_found": p7_found, "p7_removed": p7_removed, "p8_found": p8_found}
SQL: dict[str, str] = {}
