"""Workers that cannot import ``feedlens`` run the alignment, the search and the spelling walk."""

from __future__ import annotations

import os
import subprocess
import sys

import public_tokenizers


def test_workers_need_no_package(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    script = f"""
import sys
sys.path.insert(0, {root!r})
from feedlens.session import local_session
from feedlens.llm import alignment, neighbours, spelling
spark = local_session(cores=2, shuffle_partitions=2)
docs = spark.createDataFrame([(i, "wonderful wonderfull words") for i in range(6)], "doc_id bigint, text string")
vectors = spark.createDataFrame([(i, [float(i % 7), 1.0, float(i % 3)]) for i in range(120)], "vec_id bigint, embedding array<float>")
print("ROWS", alignment.token_alignment(docs, {a!r}, {b!r}).count(), neighbours.nearest_neighbours(vectors).count(), spelling.spelling_variants(docs).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-3000:]
    assert "ROWS 6 15 2" in out.stdout
