"""Token counts (operator 7): batch encoding that returns lengths only.

Texts are cut at safe boundaries (see ``wordpieces``), so a long text is counted
in parts like any other; batches go to the tokenizer by bytes, not by rows, and
only the number of tokens of each part is kept. Counts equal those of encoding the
whole text with the library's default handling of special strings.

Cases: a null text counts as empty (0 bytes, 0 tokens); repeated rows and ties get
equal results; a text of any length is counted whole; an empty table gives an
empty result; an input column named like a new one is replaced, others stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import added, runs, texts, with_columns, workers_import
from .wordpieces import PartEncoder

MODEL = "byte_bpe_50k.json"
LIMIT = 512
BATCH_BYTES = 1 << 20


@cache
def _counter(path: str) -> PartEncoder:
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    special = {i: t.content for i, t in model.get_added_tokens_decoder().items()}
    # A special string stands for its own bytes, any other token has a character for each byte.
    size = lambda i: len(special[i].encode()) if i in special else len(model.id_to_token(i) or "")
    return PartEncoder(model, size, model.get_vocab_size(with_added_tokens=True), len)


def token_counts(docs: DataFrame, model: str = MODEL, text_col: str = "text") -> DataFrame:
    """Adds ``n_bytes`` and ``n_tokens``; ``model`` is a byte-level .json file."""
    workers_import(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(public_tokenizers.path(model))
        for b in batches:
            data, at = texts(b[text_col])
            for lo, hi in runs(at, BATCH_BYTES):
                n = [sum(v) for v in counter([bytes(data[at[i] : at[i + 1]]).decode() for i in range(lo, hi)])]
                size = [at[i + 1] - at[i] for i in range(lo, hi)]
                yield with_columns(b.slice(lo, hi - lo), {"n_bytes": pa.array(size, pa.int64()), "n_tokens": pa.array(n, pa.int64())})

    return docs.mapInArrow(run, added(docs, {"n_bytes": "long", "n_tokens": "long"}))


def counted(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return token_counts(given).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
