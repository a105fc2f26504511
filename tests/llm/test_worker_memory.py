"""Python workers stay small: they share an executor's memory and outlive their tasks."""

import subprocess
import sys

RUN = r'''
import random, re

import public_tokenizers as P
import pyarrow as pa
from pyspark.sql.types import StringType, StructField, StructType

from strandloom.llm import bpe


class Frame:
    """Hands out the function that workers run."""

    columns, schema = ["text"], StructType([StructField("text", StringType())])
    transform = lambda self, f: self
    mapInArrow = lambda self, run, fields: run


def held():
    return sum(map(int, re.findall(r"\nPss_(?:Anon|Shmem):\s+(\d+)", open("/proc/self/smaps_rollup").read()))) / 1024


def batches(n):
    rng = random.Random(3)
    for _ in range(n):
        texts = [" ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(4, 12))) for _ in range(350)) for _ in range(1400)]
        yield pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])


path = P.path("byte_bpe_50k.tiktoken")
run = bpe.encode(Frame(), path, P.PATTERN)
rows, at_first, most = 0, None, 0
bpe.encoder(path, P.PATTERN)
at_first = held()
for i, block in enumerate(run(batches(2))):
    rows += block.num_rows
    most = max(most, held())
del block
print(rows, most - at_first, held() - at_first)
'''


def test_encoding_holds_a_bounded_share_of_memory():
    """980,000 different words in 8 MB of text."""
    done = subprocess.run([sys.executable, "-c", RUN], capture_output=True, text=True, timeout=300)
    assert not done.returncode, done.stderr
    rows, most, after = map(float, done.stdout.split())
    assert rows == 2800
    assert most < 350 and after < 200, (most, after)
