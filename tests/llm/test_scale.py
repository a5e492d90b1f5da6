from __future__ import annotations

from pathlib import Path

import pytest

FOLDER = Path(__file__).resolve().parents[2] / "leaseload" / "llm"


@pytest.mark.parametrize("source", sorted(FOLDER.glob("*.py")), ids=lambda p: p.name)
def test_nothing_that_does_not_hold_at_scale(source):
    code = source.read_text()
    for word in ("localCheckpoint", "crossJoin", ".rdd", "except ImportError", "F.udf("):
        assert word not in code, word


def test_native_operators_have_no_python_in_them():
    for name in ("chat.py", "pii.py"):
        code = (FOLDER / name).read_text()
        for word in ("udf", "pandas", "InArrow", "pyarrow", "collect()"):
            assert word not in code, f"{word} in {name}"
