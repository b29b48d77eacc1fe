"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.skipif(os.environ.get("PICKWISE_ORACLES") != "1",
                    reason="slow (about 10 minutes); set PICKWISE_ORACLES=1 to run")
def test_all_oracles_sf0001():
    out = subprocess.run([sys.executable, os.path.join(ROOT, "tools", "oracle_check.py"),
                          "--sf", "/root/testdata/sf0.001"], capture_output=True, text=True, timeout=3000)
    lines = [l for l in out.stdout.splitlines() if l[:1].isalpha() and " " in l]
    bad = [l for l in lines if not (" OK " in l or " rows-only " in l)]
    assert lines and not bad, "\n".join(bad)
