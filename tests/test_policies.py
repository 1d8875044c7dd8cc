"""Static guards on the library source: the patterns the design rules out."""

import pathlib
import re

SOURCE = pathlib.Path(__file__).resolve().parent.parent / "folio"
FORBIDDEN = {
    "localCheckpoint": r"localCheckpoint",
    "cross join": r"crossJoin|how=[\"']cross[\"']",
    "python udf": r"@F\.udf|F\.udf\(|pandas_udf|\budf\(",
    "rdd": r"\.rdd\b",
    "pandas collect": r"toPandas\(",
}
# Driver-side reads that return bounded results (scalars, counts per frame,
# one version row).
COLLECT_ALLOWED = {"joins.py", "numbering.py", "snapshots.py", "keyed.py", "gram_index.py"}


def sources():
    # The training-data operators are an optional part with rules of their own.
    return [p for p in SOURCE.rglob("*.py") if p.name != "__main__.py" and "llm" not in p.relative_to(SOURCE).parts]


def test_no_forbidden_patterns():
    for path in sources():
        text = path.read_text()
        for name, pattern in FORBIDDEN.items():
            assert not re.search(pattern, text), f"{name} in {path.name}"


def test_collects_only_where_bounded():
    for path in sources():
        if re.search(r"\.collect\(\)|\.first\(\)", path.read_text()):
            assert path.name in COLLECT_ALLOWED, path.name
