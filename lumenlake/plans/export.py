"""Report files: CSV with a byte-order mark, and one Markdown document.

Reports in the document are small by construction (one row per group); the
caller says how many rows it takes, and a longer one is refused, not cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BOM = "﻿"
NO_DATA = "(sem dados)"
REPORT_LIMIT = 10_000


def write_csv(rows: DataFrame, path: str) -> None:
    """CSV with header; nulls are blank and the header starts with a byte-order mark."""
    names = rows.columns
    marked = rows.select(
        *(F.col(n).cast("string").alias(BOM + n if i == 0 else n) for i, n in enumerate(names))
    )
    marked.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def markdown_table(rows: DataFrame, limit: int = REPORT_LIMIT) -> str:
    names = rows.columns
    found = rows.limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"the table has more than the {limit} rows asked for; export it as CSV")
    lines = ["| " + " | ".join(names) + " |", "| " + " | ".join("---" for _ in names) + " |"]
    for row in found or [[NO_DATA] * len(names)]:
        lines.append("| " + " | ".join("" if v is None else str(v) for v in row) + " |")
    return "\n".join(lines)


def markdown_report(title: str, sections: dict[str, DataFrame], limit: int = REPORT_LIMIT) -> str:
    blocks = [f"# {title}"]
    for heading, rows in sections.items():
        blocks += ["", f"## {heading}", "", markdown_table(rows, limit)]
    return "\n".join(blocks) + "\n"
