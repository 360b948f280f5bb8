"""Token counts of whole texts with a whole-token shortcut.

Ahead of the data, every string of the vocabulary is encoded alone; those that come out
as one pre-token and one token form the shortcut list (at most the vocabulary, so it is
broadcast).  In a text, a pre-token on the list counts one; only the rest is merged, each
distinct one once per worker.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType

from .bpe import whole_tokens
from .pretokens import pre_tokens


def count_tokens(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8) and ``n_tokens`` of every whole text, as the
    tokenizers library counts them without added special tokens, padding or truncation.

    ``tokenizer`` is the path of a byte-level BPE file present on every executor.  Null
    and empty texts have no bytes and no tokens; repeated rows each keep their row;
    columns of these two names give way; an empty table stays empty."""
    known = docs.sparkSession.sparkContext.broadcast(whole_tokens(tokenizer))

    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = pre_tokens(tokenizer, known=known.value)
        for batch in batches:
            counts = [n for _, _, n, _ in tokens.batches(batch)]
            yield pa.array(np.concatenate(counts) if counts else np.zeros(0, np.int64))
    counted = F.arrow_udf(count, "long", ArrowUDFType.SCALAR_ITER)
    return (docs.drop("n_bytes", "n_tokens")
            .withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
            .withColumn("n_tokens", counted("text")))
