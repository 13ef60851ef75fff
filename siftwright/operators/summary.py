"""A summary in Markdown, of the latest load of each dataset and the head of a report, and its place in a text that is otherwise left alone."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The lines between which a text holds the summary, and the titles of its tables.
START, END = "<!-- EXEC-SUMMARY:START -->", "<!-- EXEC-SUMMARY:END -->"
LOAD_TITLES = {"dataset": "Dataset", "file_name": "File Name", "total_rows": "Total Rows", "valid_rows": "Valid Rows", "invalid_rows": "Invalid Rows", "status": "Status", "processed_at": "Processed At (UTC)"}
REPORT_TITLES = {"region": "Region", "order_month": "Order Month", "order_count": "Order Count", "total_amount": "Total Amount", "avg_amount": "Avg Amount"}


def cell(value: object, months: bool = False) -> str:
    """A value as one cell: instants in ISO format, days as months if asked, and nothing that would end the cell or the line."""
    if isinstance(value, datetime) and not months:
        return value.isoformat()
    if isinstance(value, date):
        return f"{value:%Y-%m}" if months else value.isoformat()
    return " ".join(str(value).replace("|", "\\|").splitlines())


def table(df: DataFrame, titles: dict[str, str], rows: int = 10, months: tuple[str, ...] = (), empty: str = "no rows yet") -> str:
    """The first rows of ``df``, in its order, under their titles."""
    lines = [[cell(r[c], c in months) for c in titles] for r in df.select(*titles).limit(rows).collect()]  # as many as asked for
    lines = lines or [[f"_({empty})_", *[""] * (len(titles) - 1)]]
    return "\n".join(f"| {' | '.join(x)} |" for x in ([*titles.values()], *lines)).replace("\n", "\n|" + "---|" * len(titles) + "\n", 1)


def latest_loads(ledger: DataFrame) -> DataFrame:
    """The latest entry of each dataset, in order of their names."""
    last = Window.partitionBy("dataset").orderBy(F.desc("processed_at"), F.desc("id"))
    return ledger.withColumn("_n", F.row_number().over(last)).filter("_n = 1").drop("_n").orderBy("dataset")


def render(ledger: DataFrame, report: DataFrame, at: datetime, datasets: int = 100) -> str:
    """The summary's text. ``report`` has its order."""
    return "\n".join(
        (
            "# Executive Summary",
            "",
            f"Last regenerated: `{at.isoformat()}`.",
            "",
            "### Latest ingestion per dataset",
            "",
            table(latest_loads(ledger), LOAD_TITLES, datasets),
            "",
            "### Business report (top 10)",
            "",
            table(report, REPORT_TITLES, 10, ("order_month",), "no rows yet: load both datasets first"),
            "",
        )
    )


def splice(text: str, body: str) -> str:
    """``text`` with ``body`` between the marked lines; where they are missing, they come first. The same body again changes nothing."""
    before, start, rest = text.partition(START)
    _, end, after = rest.partition(END)
    block = f"{START}\n\n{body}\n{END}"
    return before + block + after if start and end else f"{block}\n\n{text}"
