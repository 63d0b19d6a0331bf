"""A byte-level BPE vocabulary read once by the driver and shared with all tasks."""

import base64
from collections.abc import Callable

import tiktoken
from pyspark.sql import SparkSession

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that splits text before this vocabulary's merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_built: dict[int, tiktoken.Encoding] = {}


def vocabulary(spark: SparkSession, path: str = VOCABULARY) -> Callable[[], tiktoken.Encoding]:
    """A function for tasks that gives the tokenizer; each Python worker builds it once.

    The file is read here and broadcast (about a megabyte, as the vocabulary is fixed), so
    executors need no copy of it."""
    with open(path, "rb") as file:
        held = spark.sparkContext.broadcast(file.read())

    def build() -> tiktoken.Encoding:
        data = held.value
        key = hash(data)
        if key not in _built:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
            _built[key] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return _built[key]

    return build
