"""How the log is cut into slices for the stream."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from test_scale import FOLDER, optimized
from wireloom.plans import queries


def test_slices_are_the_records_of_their_days(spark):
    """What cannot be of a slice is left out before its text is made, and nothing else."""
    log, (first, second) = queries._with_day(queries.records(spark, FOLDER)), queries.SLICE_DAYS
    day = F.col("day")
    whole = [log.filter(day < first), log.filter((day >= first) & (day < second)), log.filter(day >= second)]
    for part, rows in zip(queries._slices(spark, FOLDER), whole):
        rows = rows.drop("day")
        assert part.exceptAll(rows).count() == rows.exceptAll(part).count() == 0 < rows.count()
        assert any("Filter" in step and "timestamp_micros(" in step for step in optimized(part).splitlines())


@pytest.mark.parametrize("cores, files", [(1, 4), (12, 12), (200, 16)])
def test_files_of_a_slice_follow_the_cores(cores, files):
    assert queries._slice_files(SimpleNamespace(sparkContext=SimpleNamespace(defaultParallelism=cores))) == files
