import re

import pytest
from pyspark.sql import functions as F

from roadcast.operators.quality import normalize_and_find
from roadcast.sources.csv_records import cells
from roadcast.specs import BASIC, DETAILS


@pytest.mark.parametrize("spec", [BASIC, DETAILS])
def test_generated_methods_stay_small(spark, capsys, spec):
    """One method that trims and checks every column (5,361 and 6,831 bytes) made a load's rows over twice as dear."""
    raw = spark.range(1, numPartitions=1).select(*[F.col("id").cast("string").alias(c) for c in spec.columns])
    normalize_and_find(raw, spec).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 4000


@pytest.mark.parametrize(
    "record, expected",
    [
        ("", [""]), (",", ["", ""]), ("a,b,,", ["a", "b", "", ""]), (" a ,b\r", [" a ", "b\r"]),
        ('a"b,c', ['a"b', "c"]), ('"a,b",c', ["a,b", "c"]), ('"a""b"c,', ['a"bc', ""]), ("é,\t", ["é", "\t"]),
    ],
)
def test_cells_with_and_without_quotes(spark, record, expected):
    rows = spark.createDataFrame([(bytearray(record.encode()),)], "record binary").select(cells(F.col("record")).alias("c"))
    assert [c.encode("latin-1").decode() for c in rows.first()["c"]] == expected
