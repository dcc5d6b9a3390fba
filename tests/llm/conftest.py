from __future__ import annotations

import pytest
from pyspark.sql import DataFrame, SparkSession

SF = "/root/testdata/sf0.001"


def documents(spark: SparkSession, rows: list[tuple[int | None, str | None]]) -> DataFrame:
    """A documents table with extra columns whose names clash with those that the operators use inside."""
    ddl = (
        "doc_id long, text string, lang string, source string, n_chars long, score double, held_out boolean, kind int, "
        "token string, h long, n int, _id long, component_id long, length long, _bucket long, page long, host string, w long"
    )
    filled = [(k, t, None, None, None if t is None else len(t), 0.5, None, 1, "x", 1, 1, 1, 1, 1, 1, 1, "h", 1) for k, t in rows]
    return spark.createDataFrame(filled, ddl)


@pytest.fixture(scope="session")
def odd_rows() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and blank texts, repeated rows, one very long text, many near copies, odd characters."""
    base = [f"w{i} common{i % 7} of the" for i in range(60)]
    prose = " ".join(base)
    near = [prose.replace(f"w{i} ", f"v{i} ") for i in range(40)]
    far = [" ".join(f"u{j}{i}" for i in range(50)) for j in range(5)]
    return [
        (None, None), (None, prose), (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "One two"), (6, "one"), (6, "one"),
        (7, prose), (7, prose), (8, prose.upper()), *((10 + i, t) for i, t in enumerate(near)), *((60 + i, t) for i, t in enumerate(far)),
        (70, "x y " * 60_000), (71, "é ñ ü ß     中文 🙂 á"), (72, "line one\nline one\nline one\n\nline two"),
        (73, " ".join(f"q{i}" for i in range(30)) + "\n# * $ % & | < >"),
    ]
