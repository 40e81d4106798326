"""Order-dependent folds: where each step depends on what the step before decided."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from ..session import ship_package


def cut_files(batches: pd.DataFrame, limit: int, default_row_bytes: int = 128) -> list[int]:
    """File numbers of batches in order: the buffer is sealed as a whole as soon as its estimated size reaches
    the limit. The estimate is rows times the bytes per row of the file before (the default at first)."""
    out, number, rows, bytes_, per_row = [], 0, 0, 0, float(default_row_bytes)
    for n, size in zip(batches["n_rows"], batches["n_bytes"], strict=True):
        out.append(number)
        rows, bytes_ = rows + n, bytes_ + size
        if rows * per_row >= limit:
            per_row = bytes_ / rows if rows else per_row
            number, rows, bytes_ = number + 1, 0, 0
    return out


def rotation(batches: DataFrame, limit: int, group: str = "serial_group", order: str = "batch_start") -> DataFrame:
    """batches (group, order, n_rows, n_bytes) with the number of the file that each falls in. One group's
    batches, not its rows, are folded by one task."""
    ship_package(batches.sparkSession)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        return pdf.assign(file_no=cut_files(pdf, limit))

    return batches.groupBy(group).applyInPandas(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in batches.schema) + ", file_no long")


def accepted_offsets(ranges: Iterator[tuple[int, int]], top: int | None = None) -> list[bool]:
    """Whether each range is taken: valid, and beyond the end of all that were taken before; gaps may be."""
    out = []
    for start, end in ranges:
        good = 0 <= start <= end and (top is None or start > top)
        out.append(good)
        if good:
            top = end
    return out


def rewind_check(ranges: DataFrame, group: str = "serial_group", order: str = "arrival") -> DataFrame:
    """ranges (group, order, start_offset, end_offset) with `accepted`; a refused range leaves the high mark."""
    ship_package(ranges.sparkSession)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        return pdf.assign(accepted=accepted_offsets(zip(pdf["start_offset"], pdf["end_offset"], strict=True)))

    return ranges.groupBy(group).applyInPandas(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranges.schema) + ", accepted boolean")
