"""Files out: CSV in a contract's dialect, staged and renamed, so that whoever watches the folder sees whole files only."""

from __future__ import annotations

import csv
import gzip
import io
import os
from collections.abc import Iterable

from siftwright.contract import DatasetContract


def write_csv(rows: Iterable[Iterable[str]], contract: DatasetContract, path: str, header: bool = True, compress: bool = False) -> None:
    """One file, quoted where needed, under its name only when complete."""
    d = contract.csv
    staged = os.path.join(os.path.dirname(path) or ".", f".staging-{os.path.basename(path)}")
    with (gzip.open(staged, "wb") if compress else open(staged, "wb")) as raw, io.TextIOWrapper(raw, encoding=d.encoding, newline="") as text:
        w = csv.writer(text, delimiter=d.delimiter, quotechar=d.quotechar, escapechar=d.escapechar, doublequote=d.doublequote, lineterminator=d.lineterminator, quoting=csv.QUOTE_MINIMAL)
        if header and d.header:
            w.writerow(contract.names)
        w.writerows(rows)
    os.replace(staged, path)
