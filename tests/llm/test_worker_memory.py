"""What Python workers hold from one step to the next: an executor pays for it in every later step."""

from __future__ import annotations

import gc
import subprocess
import sys

import numpy as np
import pyarrow as pa

from tests.conftest import ROOT
from tests.llm.helpers import documents
from tidewatch.llm import toxicity
from tidewatch.llm.common import map_batches
from tidewatch.llm.packing import ChunkEncoder, RankEncoder, pack, public_vocabulary


def holders(spark, kinds: tuple) -> int:
    """How many objects of these kinds the workers hold, as tasks of another step see it."""
    def run(batch: pa.RecordBatch) -> dict:
        return {"n": [sum(isinstance(o, kinds) for o in gc.get_objects())]}

    rows = spark.range(0, 32, numPartitions=32)
    return sum(r.n for r in map_batches(rows, run, "n long").collect())


def test_scorers_and_encoders_go_with_their_step(spark):
    model = np.linspace(-1, 1, toxicity.BUCKETS, dtype=np.float32), 0.0
    docs = documents(spark).repartition(8)
    kept = toxicity.without_toxic(docs, model, 2.0)
    assert kept.count() == docs.count()
    assert holders(spark, (toxicity.Scorer,)) == 0
    assert pack(docs, *public_vocabulary()).count() >= docs.count()
    assert holders(spark, (ChunkEncoder, RankEncoder)) == 0


def test_a_known_word_has_the_score_of_a_new_one():
    weights = np.random.default_rng(1).normal(size=toxicity.BUCKETS).astype(np.float32)
    scorer = toxicity.Scorer(weights, 0.25)
    text = "one two two three three three, four"
    first = scorer.score(text)
    rows, share = toxicity.bag(text)
    assert scorer.score(text) == first
    assert abs(first - 1 / (1 + np.exp(-0.25 - float(weights[rows] @ share)))) < 1e-6
    assert scorer.score("...") == toxicity.Scorer(weights, 0.25).score("")


FREED = """
import re
from pathlib import Path
import numpy as np
from tidewatch.llm.common import give_back

def mb():
    return int(re.search(r"RssAnon:\\s+(\\d+)", Path("/proc/self/status").read_text())[1]) / 1024

held = [np.ones(8_000) for _ in range(3_000)]  # blocks of the C heap, some 190 MB
last = held.pop()
full = mb()
del held
give_back()
print(full, mb())
"""


def test_freed_memory_goes_back():
    said = subprocess.run([sys.executable, "-c", FREED], cwd=ROOT, capture_output=True, text=True, check=True).stdout
    full, left = map(float, said.split())
    assert full - left > 150
