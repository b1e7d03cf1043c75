"""Design rules of the library, checked on its source text."""
import pathlib
import re

LIB = pathlib.Path(__file__).resolve().parents[1] / "tierwise"
# The llm subpackage chooses its style freely and has tests of its own.
SOURCES = {p: p.read_text() for p in LIB.rglob("*.py") if "llm" not in p.parts}


def offenders(pattern: str) -> list[str]:
    rx = re.compile(pattern)
    return [f"{p.relative_to(LIB)}:{i}" for p, text in SOURCES.items()
            for i, line in enumerate(text.splitlines(), 1) if rx.search(line) and not line.lstrip().startswith("#")]


def test_no_local_checkpoint():
    assert offenders(r"localCheckpoint") == []


def test_no_driver_collection_in_library():
    # only the command line prints the quality summary, one row per check (bounded)
    hits = offenders(r"\.(collect|toPandas|toLocalIterator|take|head)\(")
    assert len(hits) == 1 and hits[0].startswith("__main__.py:")
    assert "wh.quality.collect()" in (LIB / "__main__.py").read_text()


def test_no_python_udfs():
    assert offenders(r"\b(udf|pandas_udf|mapInPandas|applyInPandas|mapPartitions)\b") == []


def test_no_cross_joins():
    assert offenders(r"crossJoin|\"cross\"|'cross'") == []


def test_no_rdd():
    assert offenders(r"\.rdd\b") == []


def test_no_plan_depends_on_a_size_or_partition_count():
    assert offenders(r"sizeInBytes|getNumPartitions|MAX_BYTES|default_parallelism") == []
